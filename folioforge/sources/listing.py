"""Which input files can be extracted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: file types with an extractor.
SUFFIXES = (".pdf",)


def decoded(location: str) -> Column:
    """A file's name or path from the scan's metadata, percent signs resolved."""
    return F.url_decode(F.replace(location, F.lit("+"), F.lit("%2B")))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Names and sizes of the files in a folder; their content is not read."""
    return (
        spark.read.format("binaryFile")
        .load(folder)
        .select(F.substring_index("path", "/", -1).alias("file_name"), "length")
    )


def route_by_suffix(files: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Add the lower-cased suffix and whether files of that kind can be extracted."""
    suffix = F.lower(F.regexp_extract("file_name", r"(\.[^.]+)$", 1))
    return files.withColumn("suffix", suffix).withColumn(
        "supported", F.col("suffix").isin(*suffixes)
    )
