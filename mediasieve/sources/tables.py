"""Scans of metadata tables and of file trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..operators.hygiene import keep_last, require

CSV = {"header": "true", "escape": '"', "multiLine": "true"}
AUDIO_GLOB = "*.{wav,WAV,flac,FLAC,mp3,MP3,ogg,OGG}"
# Files that systems leave in folders.
SYSTEM_FILES = (".ds_store", "thumbs.db", "desktop.ini")


def csv_text(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV with a header, every column as text; blank fields are null. With columns the file isn't read for its header."""
    reader = spark.read.options(**CSV)
    return (reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])) if columns else reader).csv(path)


def csv_typed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.options(**CSV).schema(schema).csv(path)


def csv_checked(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV as text that must have the columns."""
    return require(csv_text(spark, path), columns)


def keyed(df: DataFrame, key: str, order: list[str], numeric: bool = True) -> DataFrame:
    """One row a key, the last in order; keys that aren't numbers, or blank ones, are left out."""
    own = df.withColumn(key, F.trim(key).try_cast("long") if numeric else X.cleaned(key)).where(F.col(key).isNotNull())
    return keep_last(own, [key], order)


def optional(spark: SparkSession, read, schema: str) -> DataFrame:
    """What read() gives, or an empty table where its path doesn't exist."""
    try:
        return read()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def saved_pages(spark: SparkSession, path: str, record: str) -> DataFrame:
    """Records of saved pages of a REST answer, JSON documents with an array of recordings; record is the schema of one. Bad documents give none."""
    one = f"recordings array<struct<{record}>>, numPages string, num_pages string, page_count string, pages string"
    raw = spark.read.text(path, wholetext=True)
    parsed = raw.select(F.from_json("value", one).alias("p"))
    return parsed.select(X.first_field(["p.numPages", "p.num_pages", "p.page_count", "p.pages"]).try_cast("int").alias("num_pages"), F.explode("p.recordings").alias("r")).select("num_pages", "r.*")


def files(spark: SparkSession, root: str, glob: str = AUDIO_GLOB, content: bool = False, recursive: bool = True) -> DataFrame:
    """(path, length, folder, name[, content]) of files below root; without content only the listing is read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    df = (reader.option("recursiveFileLookup", "true") if recursive else reader).load(root)
    out = df.select("path", "length", X.folder("path").alias("folder"), X.base_name("path").alias("name"), *(["content"] if content else []))
    return out


def without_folders(df: DataFrame, folders: list[str]) -> DataFrame:
    return df.where(X.not_in("folder", folders))


def valid_audio(name: Column, length: Column) -> Column:
    """Neither hidden nor a system's own, of a known extension, and not empty."""
    low = F.lower(name)
    return ~name.startswith(".") & ~low.isin(*SYSTEM_FILES) & low.rlike(r"\.(wav|flac|mp3|ogg|m4a)$") & (length > 0)


def labelled(spark: SparkSession, root: str, classes: dict[str, int]) -> DataFrame:
    """(path, label, subdir) of the valid audio files below root/<class>; files straight in a class folder only count where it has no folders."""
    base = root.rstrip("/")
    df = files(spark, base, "*").where(valid_audio(F.col("name"), F.col("length")))
    below = F.regexp_extract("path", rf"{base.removeprefix('file:').lstrip('/')}/(.*)$", 1)
    parts = F.split(below, "/")
    label = F.element_at(F.create_map(*[F.lit(x) for kv in classes.items() for x in kv]), parts[0])
    out = df.select("path", label.alias("label"), F.when(F.size(parts) > 2, parts[1]).otherwise("").alias("subdir")).where("label is not null")
    nested = out.groupBy(F.col("label").alias("_l")).agg(F.max((F.col("subdir") != "").cast("int")).alias("_nested"))
    return out.join(F.broadcast(nested), F.col("label") == F.col("_l")).where("_nested = 0 or subdir <> ''").drop("_l", "_nested")  # one row a class is broadcast


def with_source(clips: DataFrame, sources: DataFrame) -> DataFrame:
    """clips (id, grade, ...) with source_path, the first path among sources (path) of that id and grade; null where there is none."""
    own = sources.select("path", X.source_file_parts(X.base_name("path")).alias("p")).where("p is not null")
    first = own.groupBy(F.col("p.id").cast("string").alias("_id"), F.upper("p.grade").alias("_g")).agg(F.min("path").alias("source_path"))
    return clips.join(first, (F.col("id") == F.col("_id")) & (F.upper("grade") == F.col("_g")), "left").drop("_id", "_g")


def durations(df: DataFrame) -> DataFrame:
    """Files with content, with seconds from the header; null where it can't be read."""

    @F.pandas_udf("double")
    def seconds(content):
        from ..functions.dsp import duration

        return content.map(lambda b: duration(bytes(b)))

    return df.withColumn("seconds", seconds("content"))


def negatives(manifest: DataFrame, kind: str) -> DataFrame:
    """Rows of a labelled corpus that hold none of the wanted sound, by the corpus' own kind of manifest: flags, classes, categories, or folders."""
    from ..config import EXCLUDED_CATEGORIES, EXCLUDED_CLASS_IDS

    if kind == "flags":
        key = "itemid" if "itemid" in manifest.columns else "filename"
        return manifest.where(F.col("hasbird").cast("int") == 0).withColumn("key", F.col(key))
    if kind == "classes":
        return manifest.where(X.not_in(F.col("Class ID").cast("int"), EXCLUDED_CLASS_IDS)).withColumn("key", X.stem("Dataset File Name"))
    if kind == "categories":
        return manifest.where(X.not_in("category", EXCLUDED_CATEGORIES)).withColumn("key", X.stem("filename"))
    raise ValueError("kind: flags, classes or categories")
