"""What was extracted and what was not."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def extraction_report(files: DataFrame, page_paragraphs: DataFrame) -> DataFrame:
    """One row per file: whether its type is known, its paragraphs, and success.

    `files` has `pdf_name` and `supported`; success means at least one paragraph.
    """
    counts = page_paragraphs.groupBy("pdf_name").agg(
        F.sum(F.size("paragraphs")).alias("n_paragraphs")
    )
    found = F.coalesce(F.col("n_paragraphs"), F.lit(0))
    return files.join(counts, "pdf_name", "left").select(
        "pdf_name",
        "supported",
        found.cast("bigint").alias("n_paragraphs"),
        (F.col("supported") & (found > 0)).alias("extracted"),
    )


def extraction_totals(report: DataFrame) -> DataFrame:
    """Counts and percentages over a report; the names stay in the report's rows."""
    n = F.count("*")
    done = F.count_if("extracted")

    def percent(part):
        return F.round(100 * part / n, 2)

    return report.agg(
        n.alias("n_files"),
        done.alias("n_extracted"),
        (n - done).alias("n_not_extracted"),
        percent(done).alias("percent_extracted"),
        percent(n - done).alias("percent_not_extracted"),
    )
