"""Question catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.text import strip
from folioforge.schemas import KPI_MAPPING_CSV


def kpi_mapping_table(raw: DataFrame) -> DataFrame:
    """Allowed data types as an array instead of a ", "-separated string; one row per question id.

    Of rows with equal ids, as numbers, the last one counts. Rows without an id go.
    """
    number = F.col("kpi_id").cast("double")
    others = ["question", "sectors", "add_year", "kpi_category"]
    last = (
        raw.select(number.alias("kpi_id"), *others, F.monotonically_increasing_id().alias("__row"))
        .where("kpi_id is not null")
        .groupBy("kpi_id")
        .agg(F.max_by(F.struct(*others), "__row").alias("__last"))
        .select("kpi_id", "__last.*")
    )
    categories = F.transform(F.split("kpi_category", ", "), strip)
    return last.withColumn("kpi_category", categories)


def read_kpi_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Read the catalogue by the names in its header; other columns are ignored, questions may span lines."""
    raw = spark.read.csv(path, header=True, escape='"', multiLine=True)
    missing = [name for name in KPI_MAPPING_CSV if name not in raw.columns]
    if missing:
        raise ValueError(f"question catalogue lacks columns: {', '.join(missing)}")
    return kpi_mapping_table(
        raw.select(*(F.col(name).try_cast(kind).alias(name) for name, kind in KPI_MAPPING_CSV.items()))
    )
