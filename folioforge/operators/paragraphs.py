"""Pages into cleaned, numbered paragraphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import alnum_count, clean_page_text, document_stem
from folioforge.operators.running import running_total_before

# Defaults of paragraph extraction.
MIN_PARAGRAPH_LENGTH = 20
BLANK_LINE = "\n\n"


def split_paragraphs(
    pages: DataFrame,
    min_paragraph_length: int = MIN_PARAGRAPH_LENGTH,
    separator: str = BLANK_LINE,
) -> DataFrame:
    """One row per page with an array of its cleaned paragraphs, in order.

    Paragraphs with too few letters and numerals are table cells and dropped. A
    page may be left with none; it is kept here, because a filter on the array
    would clean every text twice. Nothing is shuffled.
    """
    pieces = F.split("text", f"\\Q{separator}\\E")
    cleaned = F.transform(pieces, clean_page_text)
    kept = F.filter(cleaned, lambda p: alnum_count(p) > min_paragraph_length)
    return pages.select("pdf_name", "page", kept.alias("paragraphs"))


def number_paragraphs(page_paragraphs: DataFrame) -> DataFrame:
    """Paragraph table with ids running over the whole document.

    (`pdf_name`, `page`) must be unique. Only the pages' paragraph counts are
    summed up; the place within a page comes from the array.
    """
    numbered = running_total_before(
        page_paragraphs, ["pdf_name"], "page", F.size("paragraphs"), "start_index_page"
    )
    return numbered.select(
        "pdf_name",
        "page",
        F.col("page").cast("string").alias("page_key"),
        "start_index_page",
        (F.col("start_index_page") + F.size("paragraphs") - 1).alias("last_index_page"),
        F.posexplode("paragraphs").alias("place", "paragraph"),
    ).select(
        "pdf_name",
        "page",
        "page_key",
        (F.col("start_index_page") + F.col("place")).alias("unique_paragraph_id"),
        "paragraph",
        "start_index_page",
        "last_index_page",
    )


def skip_extracted(pages: DataFrame, extracted: DataFrame) -> DataFrame:
    """Leave out documents that `extracted` already holds (by name without suffix)."""
    stem = document_stem(F.col("pdf_name"))
    done = extracted.select(document_stem(F.col("pdf_name")).alias("__stem")).distinct()
    return (
        pages.withColumn("__stem", stem).join(done, "__stem", "left_anti").drop("__stem")
    )


def annotated_only(pages: DataFrame, annotations: DataFrame) -> DataFrame:
    """Keep only documents an annotation names."""
    named = annotations.select(F.col("source_file").alias("pdf_name")).distinct()
    return pages.join(named, "pdf_name", "left_semi")
