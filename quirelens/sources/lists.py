"""Side tables kept as text files, and concept records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelens.settings import CONCEPT_DDL
from quirelens.sources.listed import file_paths, read_paths


def pos_map_lines(files: DataFrame) -> DataFrame:
    """(lang, tag, upos) out of (file, content), one file a language: that is the first two letters of the file name.

    Blank and ``#`` lines are skipped, as are lines that do not have exactly two tab-separated parts; trailing tabs do
    not count. A repeated tag keeps its last line.
    """
    lang = F.substr(F.col("file"), F.lit(1), F.lit(2))
    lines = files.select(lang.alias("lang"), F.posexplode_outer(F.split("content", "\r?\n")).alias("line_no", "line"))
    parts = F.split(F.regexp_replace("line", r"\t+$", ""), "\t")
    return (
        lines.filter(~F.rlike("line", F.lit(r"^\s*$")) & ~F.startswith("line", F.lit("#")))
        .select("lang", "line_no", parts.alias("parts"))
        .filter(F.size("parts") == 2)
        .groupBy("lang", F.get("parts", F.lit(0)).alias("tag"))
        .agg(F.max_by(F.get("parts", F.lit(1)), "line_no").alias("upos"))
    )


def pos_map_paths(spark: SparkSession, path: str) -> DataFrame:
    """(lang, path): of each language's ``*.map`` files below a folder the one with the greatest name, then path; no file is opened."""
    listing = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.map").load(path)
    names = listing.select(F.substring_index("path", "/", -1).alias("file"), file_paths(path).alias("path"))
    lang = F.substr(F.col("file"), F.lit(1), F.lit(2)).alias("lang")
    return names.groupBy(lang).agg(F.max(F.struct("file", "path")).alias("last")).select("lang", "last.path")


def read_pos_maps(spark: SparkSession, path: str) -> DataFrame:
    """(lang, tag, upos) of all ``*.map`` files below a folder. Of several files of one language the greatest name wins as
    a whole; which one that is shows in the names, so only those files are read."""
    chosen = pos_map_paths(spark, path).select("path")
    files = read_paths(chosen, path).select(F.substring_index("path", "/", -1).alias("file"), F.col("json").alias("content"))
    return pos_map_lines(files)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, as it stands."""
    return spark.read.text(path).select(F.col("value").alias("word")).distinct()


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("id"))


def read_concepts(spark: SparkSession, path: str) -> DataFrame:
    """One JSON concept record per line."""
    return spark.read.schema(CONCEPT_DDL).json(path)


def read_concept_array(spark: SparkSession, path: str) -> DataFrame:
    """Files holding one JSON array of concept records each: one row per element."""
    return spark.read.schema(CONCEPT_DDL).json(path, multiLine=True)


def to_oneliners(records: DataFrame) -> DataFrame:
    """Each record as one line of JSON."""
    return records.select(F.to_json(F.struct("*")).alias("line"))
