"""Column functions over names, file names, durations, grades and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import GROUP_WORDS, NULL_WORDS, UNRATED

BLANK = ""


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cleaned(c: Column | str) -> Column:
    """Trimmed text, null where nothing is left."""
    t = F.trim(_col(c))
    return F.when(t != BLANK, t)


def null_like(c: Column | str) -> Column:
    """Whether a text is null, blank or one of the words that stand for null."""
    t = cleaned(c)
    return t.isNull() | F.upper(t).isin(*NULL_WORDS)


def sanitize_name(c: Column | str, default: str = "unknown_species") -> Column:
    """A name safe for folders: forbidden characters and runs of white space become _; blank and null the default."""
    safe = F.regexp_replace(F.regexp_replace(F.trim(_col(c)), r'[/\\:*?"<>|]', "_"), r"\s+", "_")
    return F.coalesce(F.when(safe != BLANK, safe), F.lit(default))


def url_extension(c: Column | str, default: str = ".mp3") -> Column:
    """Extension of the decoded last path part of a URL; the default where it has none, or the URL is null."""
    path = F.regexp_extract(_col(c), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    # Only sound escapes are decoded, the way a lenient decoder leaves the others alone.
    decoded = F.coalesce(F.try_url_decode(F.regexp_replace(path, r"\+", "%2B")), path)
    base = F.regexp_extract(decoded, r"([^/]*)$", 1)
    ext = F.regexp_extract(base, r"^\.*[^.].*(\.[^.]*)$", 1)
    return F.coalesce(F.when(F.length(ext) > 1, ext).when(ext == ".", ext), F.lit(default))


def seconds_loose(c: Column | str) -> Column:
    """M:SS or a bare number of seconds; everything else, H:MM:SS too, is 0."""
    t = F.trim(_col(c))
    parts = F.split(t, ":")
    two = F.try_add(F.element_at(parts, 1).try_cast("int") * F.lit(60), F.try_element_at(parts, F.lit(2)).try_cast("int")).cast("double")
    return F.coalesce(F.when(F.size(parts) == 2, two).when(F.size(parts) == 1, t.try_cast("double")), F.lit(0.0))


def seconds_clock(c: Column | str) -> Column:
    """M:SS or H:MM:SS; everything else is null, a bare number too."""
    parts = F.split(F.trim(_col(c)), ":")
    at = lambda k: F.try_element_at(parts, F.lit(k)).try_cast("int")
    return F.when(F.size(parts) == 2, at(1) * 60 + at(2)).when(F.size(parts) == 3, at(1) * 3600 + at(2) * 60 + at(3)).cast("double")


def known_seconds(c: Column | str) -> Column:
    """seconds_clock, with 0 as unknown."""
    s = seconds_clock(c)
    return F.when(s != 0, s)


def grade_of(c: Column | str) -> Column:
    """Upper first letter of a grade; U for null, blank and unrated."""
    t = F.trim(_col(c))
    return F.when(t.isNull() | (t == BLANK) | F.lower(t).isin(*UNRATED), "U").otherwise(F.upper(F.substring(t, 1, 1)))


def grade_score(c: Column | str, first: int = 4, missing: int = 0) -> Column:
    """A, B, C, D (and E) as first, first - 1, ...; others as missing. (4, 0) is the older scale; (5, 3) the newer."""
    g = _col(c)
    out = F.when(g == "A", first)
    for k, letter in enumerate("BCDE"[: first - 1], 1):
        out = out.when(g == letter, first - k)
    return out.otherwise(missing)


def canonical_id(c: Column | str) -> Column:
    """Whole number of an id ("12.0" is 12), else its digits, else the id itself."""
    t = F.trim(_col(c))
    number = F.when(t.rlike(r"^[+-]?\d+(\.\d*)?([eE][+-]?\d+)?$"), t.try_cast("double"))
    digits = F.regexp_replace(t, "[^0-9]", "")
    return F.coalesce(number.try_cast("long").cast("string"), F.when(digits != BLANK, digits), t)


def output_name(id_col: Column | str, grade_col: Column | str, ext: str = "flac") -> Column:
    return F.concat(F.lit("xc"), canonical_id(id_col), F.lit("_"), grade_of(grade_col), F.lit(f".{ext}"))


def base_name(c: Column | str) -> Column:
    return F.regexp_extract(_col(c), r"([^/]*)$", 1)


def stem(c: Column | str) -> Column:
    """Last path part without its extension."""
    return F.regexp_replace(base_name(c), r"(?<=.)\.[^.]*$", "")


def folder(c: Column | str) -> Column:
    """Name of the folder a path lies in; empty at the top."""
    return F.regexp_extract(_col(c), r"([^/]*)/[^/]*$", 1)


def top_folder(path: Column | str, root: str) -> Column:
    """First folder of a path below root; empty for files in root itself."""
    return F.regexp_extract(F.replace(_col(path), F.lit(root.rstrip("/") + "/"), F.lit("")), r"^([^/]+)/", 1)


def record_number(c: Column | str) -> Column:
    """Number behind xc in the first part of a file stem; 0 where there is none."""
    return F.coalesce(F.regexp_extract(F.lower(stem(c)), r"^xc(\d+)(?:_|$)", 1).try_cast("long"), F.lit(0).cast("long"))


def source_key(c: Column | str) -> Column:
    """First two _ parts of the stem: the recording a file comes from."""
    return F.substring_index(stem(c), "_", 2)


def record_id(c: Column | str) -> Column:
    """Digits behind xc anywhere in a name, of either case; null where there are none."""
    found = F.regexp_extract(_col(c), r"(?i)xc(\d+)", 1)
    return F.when(found != BLANK, found)


def name_grade(c: Column | str, letters: str = "A-DU") -> Column:
    """Grade in a name; U where there is none of the letters."""
    found = F.upper(F.regexp_extract(_col(c), rf"(?i)xc\d+_([{letters}])", 1))
    return F.when(found != BLANK, found).otherwise("U")


CLIP_NAME = r"^xc(\d+)_([A-Ea-e])_(\d+)\.wav$"


def clip_parts(c: Column | str, pattern: str = CLIP_NAME) -> Column:
    """Struct (id, grade, onset_ms) of a clip's file name; null where the name doesn't fit."""
    t = _col(c)
    part = lambda k: F.regexp_extract(t, pattern, k)
    return F.when(t.rlike(pattern), F.struct(part(1).alias("id"), part(2).alias("grade"), part(3).try_cast("long").alias("onset_ms")))


def source_file_parts(c: Column | str) -> Column:
    """Struct (id, grade) of a source file's name, matched at its start; null where it doesn't fit."""
    t, pattern = _col(c), r"^xc(\d+)_([A-Ea-eUun])\.flac"
    return F.when(t.rlike(pattern), F.struct(F.regexp_extract(t, pattern, 1).try_cast("long").alias("id"), F.regexp_extract(t, pattern, 2).alias("grade")))


def grades_match(a: Column, b: Column) -> Column:
    """Whether two spellings of a grade are the same; N and NO SCORE are U."""
    norm = lambda g: F.when(F.upper(F.trim(g)).isin("N", "NO SCORE"), "U").otherwise(F.upper(F.trim(g)))
    return norm(a) == norm(b)


def onset_ms(start: Column | str, rate: int = 16_000) -> Column:
    """Milliseconds of a sample position, half to even."""
    return F.bround(_col(start).cast("double") * 1000 / rate, 0).cast("long")


def onset_ms_floor(start: Column | str, rate: int = 16_000) -> Column:
    """Milliseconds of a sample position, cut off, in whole numbers."""
    return F.floor(_col(start).cast("long") * 1000 / F.lit(rate)).cast("long")


def clip_name(stem_col: Column | str, onset: Column | str) -> Column:
    return F.concat(_col(stem_col), F.lit("_"), _col(onset).cast("string"), F.lit(".wav"))


def negative_name(prefix: str, key: Column | str, onset: Column | str, width: int = 5, padded: Column | None = None) -> Column:
    """{prefix}-{key}-{onset}[_padded].wav, the onset filled with zeros to width."""
    text = _col(onset).cast("string")
    digits = F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))
    tail = F.lit(".wav") if padded is None else F.when(padded, "_padded.wav").otherwise(".wav")
    return F.concat(F.lit(f"{prefix}-"), _col(key), F.lit("-"), digits, tail)


def mentions(cols: list[Column | str], words=GROUP_WORDS) -> Column:
    """Whether any of the fields holds any of the words; null fields hold none."""
    fields = F.array(*[F.coalesce(F.lower(F.trim(_col(c).cast("string"))), F.lit("")) for c in cols])
    return F.exists(fields, lambda x: x.rlike("|".join(words)))


def not_in(c: Column | str, values) -> Column:
    """NOT IN that keeps nulls."""
    return F.coalesce(~_col(c).isin(*values), F.lit(True))


def clamp_start(start: Column | str, duration: Column | str, window: float = 3.0) -> Column:
    return F.greatest(F.lit(0.0), F.least(_col(start).cast("double"), _col(duration) - window))


def resolved_issue(issue: Column | str, onset: Column | str) -> Column:
    """noise_dominated is wrong_onset where an onset is given, else no_bird; other issues stay."""
    kind = F.lower(F.trim(_col(issue)))
    return F.when(kind == "noise_dominated", F.when(cleaned(onset).isNotNull(), "wrong_onset").otherwise("no_bird")).otherwise(kind)


def spoken_time(seconds: Column | str) -> Column:
    """1h 2m 3s, 2m 3s or 3s."""
    s = F.floor(_col(seconds)).cast("long")
    h, m, r = F.floor(s / 3600).cast("string"), F.floor(s % 3600 / 60), (s % 60).cast("string")
    return F.when(s >= 3600, F.concat(h, F.lit("h "), m.cast("string"), F.lit("m "), r, F.lit("s"))).when(m > 0, F.concat(m.cast("string"), F.lit("m "), r, F.lit("s"))).otherwise(F.concat(r, F.lit("s")))


def first_field(cols: list[Column | str]) -> Column:
    """The first of several spellings of a field that is there."""
    return F.coalesce(*[_col(c) for c in cols])


def hop_for_frames(samples: int, frames: int, n_fft: int = 512) -> int:
    """Hop that gives about so many frames."""
    return max(1, (samples - n_fft) // (frames - 1))


def cosine_decay(step: Column | str, total: int, base: float, least: float = 0.0) -> Column:
    """Value of a rate that falls from base to least along half a cosine over total steps."""
    part = F.least(_col(step) / total, F.lit(1.0))
    return least + (base - least) * 0.5 * (1 + F.cos(F.lit(3.141592653589793) * part))


def cache_key(path: Column | str) -> Column:
    """Key of a file in a feature table."""
    return F.md5(_col(path).cast("binary"))
