"""Annotation tables: cleaning, questions, one row per passage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.literals import parse_page_list, split_passages
from folioforge.functions.questions import question_in_year
from folioforge.functions.text import normalise_pdf_name, single_line, strip
from folioforge.schemas import ANNOTATION_COLUMNS, ANNOTATION_PROVENANCE

# Columns a usable row needs, and companies left out by default.
NEEDED = ["company", "source_file", "source_page", "kpi_id", "year"]
EXCLUDED_COMPANIES = ("CEZ",)
TEXT = "TEXT"


def kpi_number(kpi_id: Column) -> Column:
    return kpi_id.try_cast("double")


def drop_empty_rows(annotations: DataFrame) -> DataFrame:
    """Drop rows without company, document, page, question id or year."""
    return annotations.na.drop("any", subset=NEEDED)


def exclude_companies(
    annotations: DataFrame, companies: Sequence[str] = EXCLUDED_COMPANIES
) -> DataFrame:
    return annotations.where(~F.col("company").isin(*companies)) if companies else annotations


def invalid_pages(annotations: DataFrame) -> DataFrame:
    """The distinct page entries that are not lists of integers."""
    return (
        annotations.where(
            F.col("source_page").isNotNull() & parse_page_list(F.col("source_page")).isNull()
        )
        .select("source_page")
        .distinct()
    )


def valid_kpi_data_type(annotations: DataFrame, kpi_mapping: DataFrame) -> DataFrame:
    """Keep rows whose data type the question allows; unknown questions are dropped."""
    allowed = kpi_mapping.select(
        F.col("kpi_id").alias("__kpi"), F.explode("kpi_category").alias("__type")
    ).distinct()
    return annotations.join(
        allowed,
        (F.col("kpi_id") == F.col("__kpi")) & (F.col("data_type") == F.col("__type")),
        "left_semi",
    )


def _prepared(annotations: DataFrame, exclude: Sequence[str]) -> DataFrame:
    rows = exclude_companies(drop_empty_rows(annotations), exclude)
    return rows.select(
        "company",
        normalise_pdf_name(F.col("source_file")).alias("source_file"),
        parse_page_list(F.col("source_page")).alias("source_page"),
        kpi_number(F.col("kpi_id")).alias("kpi_id"),
        "year",
        "answer",
        strip(F.col("data_type")).alias("data_type"),
        "relevant_paragraphs",
        "annotator",
        "sector",
        *ANNOTATION_PROVENANCE,
    )


def clean_annotations(
    annotations: DataFrame,
    kpi_mapping: DataFrame,
    exclude: Sequence[str] = EXCLUDED_COMPANIES,
) -> DataFrame:
    """Usable rows only: pages as an array, names and types normalised."""
    rows = _prepared(annotations, exclude).where(F.col("source_page").isNotNull())
    return valid_kpi_data_type(rows, kpi_mapping)


def annotation_rejects(
    annotations: DataFrame,
    kpi_mapping: DataFrame,
    exclude: Sequence[str] = EXCLUDED_COMPANIES,
) -> DataFrame:
    """How many rows `clean_annotations` drops, by the first reason that applies."""
    complete = F.lit(True)
    for name in NEEDED:
        complete = complete & F.col(name).isNotNull()
    allowed = kpi_mapping.select(F.col("kpi_id").alias("__kpi"), "kpi_category")
    known = annotations.withColumn("__number", kpi_number(F.col("kpi_id"))).join(
        allowed, F.col("__number") == F.col("__kpi"), "left"
    )
    right_type = F.array_contains("kpi_category", strip(F.col("data_type")))
    reason = (
        F.when(~complete, "missing value")
        .when(F.col("company").isin(*exclude), "excluded company")
        .when(parse_page_list(F.col("source_page")).isNull(), "invalid page")
        .when(F.col("__kpi").isNull(), "unknown question")
        .when(~F.coalesce(right_type, F.lit(False)), "data type not allowed")
    )
    return (
        known.select(reason.alias("reason"))
        .where(F.col("reason").isNotNull())
        .groupBy("reason")
        .agg(F.count("*").alias("n_rows"))
    )


def text_only(annotations: DataFrame) -> DataFrame:
    return annotations.where(F.col("data_type") == TEXT)


def map_questions(annotations: DataFrame, kpi_mapping: DataFrame) -> DataFrame:
    """Add `question`, dated where the catalogue says so; null if the id is unknown."""
    catalogue = kpi_mapping.select("kpi_id", "question", "add_year")
    return (
        annotations.join(catalogue, "kpi_id", "left")
        .withColumn(
            "question", question_in_year(F.col("question"), F.col("add_year"), F.col("year"))
        )
        .drop("add_year")
    )


def split_multi_paragraph(annotations: DataFrame) -> DataFrame:
    """One row per (page, passage) from the arrays `source_page`, `relevant_paragraphs`.

    A single passage goes with the first page; several go with the page at the
    same place, and places that lack a page or a passage are dropped.
    """
    pages, passages = F.col("source_page"), F.col("relevant_paragraphs")
    n_pairs = F.when(F.size(passages) == 1, F.lit(1)).otherwise(
        F.least(F.size(pages), F.size(passages))
    )
    pairs = F.transform(
        F.sequence(F.lit(0), n_pairs - 1),
        lambda i: F.struct(F.get(pages, i).alias("page"), F.get(passages, i).alias("passage")),
    )
    others = [c for c in annotations.columns if c not in ("source_page", "relevant_paragraphs")]
    return annotations.select(
        *others,
        (F.size(passages) > 1).alias("several"),
        F.posexplode(pairs).alias("item", "pair"),
    ).select(
        *others,
        F.col("pair.page").alias("source_page"),
        F.col("pair.passage").alias("relevant_paragraphs"),
        "several",
        "item",
    )


def clean(annotations: DataFrame, kpi_mapping: DataFrame) -> DataFrame:
    """Cleaned annotations -> one row per question and passage."""
    rows = (
        map_questions(annotations, kpi_mapping)
        .na.drop("any", subset=["question", "relevant_paragraphs", "answer"])
        .withColumn("answer", single_line(F.col("answer")))
        .withColumn("relevant_paragraphs", split_passages(F.col("relevant_paragraphs")))
        .where(F.col("relevant_paragraphs").isNotNull())
    )
    ordered = [*ANNOTATION_COLUMNS, *ANNOTATION_PROVENANCE, "question", "several", "item"]
    return split_multi_paragraph(rows).select(*ordered)


def passage_rejects(annotations: DataFrame, kpi_mapping: DataFrame) -> DataFrame:
    """What `clean` drops, by the first reason that applies; (reason, n_rows).

    Of several passages and pages of a row, those without a counterpart are counted singly.
    """
    rows = map_questions(annotations, kpi_mapping).withColumn(
        "__passages", split_passages(F.col("relevant_paragraphs"))
    )
    surplus = F.when(F.size("__passages") > 1, F.size("__passages") - F.size("source_page")).otherwise(0)

    def lost(reason: str, n_rows: Column) -> Column:
        return F.struct(F.lit(reason).alias("reason"), n_rows.cast("bigint").alias("n_rows"))

    found = (
        F.when(F.col("question").isNull(), lost("unknown question", F.lit(1)))
        .when(F.col("relevant_paragraphs").isNull(), lost("missing passage", F.lit(1)))
        .when(F.col("answer").isNull(), lost("missing answer", F.lit(1)))
        .when(F.col("__passages").isNull(), lost("unreadable passage list", F.lit(1)))
        .when(surplus > 0, lost("passage without page", surplus))
        .when(surplus < 0, lost("page without passage", -surplus))
    )
    return (
        rows.select(found.alias("lost"))
        .where("lost is not null")
        .groupBy("lost.reason")
        .agg(F.sum("lost.n_rows").alias("n_rows"))
    )
