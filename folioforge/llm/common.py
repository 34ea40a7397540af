"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters between words, for Java's and Spark's regular expressions.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text in order; none of a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def fresh(rows: DataFrame, *names: str) -> list[str]:
    """Names like `names` that no column of `rows` has, whatever the case."""
    taken, given = {c.lower() for c in rows.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        given.append(name)
    return given


def utf8(values: pd.Series) -> Iterator[bytes]:
    """The texts of a column of binary or string values; null gives an empty text."""
    for value in values:
        if value is None:
            yield b""
        else:
            yield value.encode("utf-8", "surrogatepass") if isinstance(value, str) else bytes(value)
