"""Pages to paragraph table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.operators.paragraphs import (
    BLANK_LINE,
    MIN_PARAGRAPH_LENGTH,
    annotated_only,
    number_paragraphs,
    skip_extracted,
    split_paragraphs,
)
from folioforge.operators.report import extraction_report
from folioforge.session import cut_lineage
from folioforge.sources.listing import route_by_suffix


def extract(
    pages: DataFrame,
    min_paragraph_length: int = MIN_PARAGRAPH_LENGTH,
    separator: str = BLANK_LINE,
    already_extracted: DataFrame | None = None,
    only_annotated: DataFrame | None = None,
) -> DataFrame:
    """Split, clean, filter and number the paragraphs of paged documents.

    `already_extracted` is an earlier paragraph table whose documents are
    skipped; `only_annotated` an annotation table whose documents are the only
    ones kept.
    """
    pages = _chosen(pages, already_extracted, only_annotated)
    return number_paragraphs(split_paragraphs(pages, min_paragraph_length, separator))


def _chosen(
    pages: DataFrame, already_extracted: DataFrame | None, only_annotated: DataFrame | None
) -> DataFrame:
    if already_extracted is not None:
        pages = skip_extracted(pages, already_extracted)
    if only_annotated is not None:
        pages = annotated_only(pages, only_annotated)
    return pages


def extract_files(
    files: DataFrame,
    pages: DataFrame,
    min_paragraph_length: int = MIN_PARAGRAPH_LENGTH,
    separator: str = BLANK_LINE,
    already_extracted: DataFrame | None = None,
    only_annotated: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The paragraph table of all files of a known type, and the report on all files.

    `files` has `file_name`, as `list_files` gives it; `pages` belong to files by `pdf_name`.
    Files that `already_extracted` or `only_annotated` leave out are not in the report. Texts
    are cleaned once: both results read the same written table.
    """
    named = _chosen(files.withColumn("pdf_name", F.col("file_name")), already_extracted, only_annotated)
    routed = route_by_suffix(named).select("pdf_name", "supported")
    known = pages.join(routed.where("supported").select("pdf_name"), "pdf_name", "left_semi")
    split = cut_lineage(split_paragraphs(known, min_paragraph_length, separator))
    return number_paragraphs(split), extraction_report(routed, split)
