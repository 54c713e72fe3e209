"""Settings of the curation operators; every operator takes its own as arguments with these defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Audio:
    rate: int = 16_000
    window_s: float = 3.0
    hop_s: float = 0.1
    min_rms: float = 0.001
    separation_s: float = 1.5

    @property
    def window(self) -> int:
        return int(self.rate * self.window_s)

    @property
    def hop(self) -> int:
        return int(self.rate * self.hop_s)


@dataclass(frozen=True)
class Duplicates:
    neighbours: int = 6
    candidate: float = 0.985
    mean: float = 0.997
    least: float = 0.985
    low: float = 0.992
    perfect: float = 0.999
    seconds: float = 1.0


@dataclass(frozen=True)
class Balance:
    target: int = 25_000
    clusters: int = 5
    bonus: float = 100.0


# Species that are excluded, texts that stand for a missing value, words for the group looked for, folders that hold no species.
UNKNOWN_SPECIES = ("Identity unknown", "identity unknown", "Unknown", "unknown")
NULL_WORDS = ("NULL", "NONE", "NAN", "NA")
UNRATED = ("no score", "unrated", "unknown")
GROUP_WORDS = ("bird", "aves", "avian")
GROUP_FIELDS = ("grp", "group", "animal", "type", "kind")
# Classes and categories of source corpora that hold the wanted sound and so are no negatives.
EXCLUDED_CLASS_IDS = (23, 24)
EXCLUDED_CATEGORIES = ("rooster", "hen", "crow", "chirping_birds")
# Columns of the metadata tables that are written, and those that are dropped after a fetch.
OUTPUT_COLUMNS = ("id", "en", "rec", "cnt", "lat", "lon", "lic", "q", "length", "smp")
HEAVY_COLUMNS = ("sono", "osci")
AUDIO = Audio()
DUPLICATES = Duplicates()
BALANCE = Balance()
