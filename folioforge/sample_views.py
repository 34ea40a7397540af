"""Input tables of the library, derived by Spark from a general `documents` table.

Used by the registered queries, the benchmark and the tests: every document
becomes a paged report, every paragraph gets one annotation and one relevance
score.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.questions import question_in_year
from folioforge.plans.extraction import extract
from folioforge.session import cut_lineage
from folioforge.sources.kpi_mapping import kpi_mapping_table

LINES_PER_PAGE = 8
LINE = "\n"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """(pdf_name, page, text): runs of eight lines of each document."""
    split = documents(spark, folder).select("doc_id", F.split("text", LINE).alias("lines"))
    n_pages = F.ceil(F.size("lines") / LINES_PER_PAGE).cast("int")
    page_texts = F.transform(
        F.sequence(F.lit(0), n_pages - 1),
        lambda page: F.array_join(
            F.slice("lines", page * LINES_PER_PAGE + 1, LINES_PER_PAGE), LINE
        ),
    )
    return split.select(
        F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".pdf")).alias("pdf_name"),
        F.posexplode(page_texts).alias("page", "text"),
    )


def paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    return extract(pages(spark, folder), separator=LINE)


def kpi_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """A question catalogue: one question about every passage of `benchmark`."""
    item = F.col("item_id")
    raw = spark.read.parquet(f"{folder}/benchmark.parquet").select(
        item.cast("double").alias("kpi_id"),
        F.concat(F.lit("What about "), F.col("text"), F.lit(" no. "), item, F.lit("?")).alias(
            "question"
        ),
        F.lit("OG, CM, CU").alias("sectors"),
        (item % 3 == 0).alias("add_year"),
        F.when(item % 4 == 1, "TEXT").otherwise("TEXT, TABLE").alias("kpi_category"),
    )
    return kpi_mapping_table(raw)


def _pick(number: Column, *cases: tuple[int, int, Column], otherwise: Column) -> Column:
    """The value of the first (modulus, remainder, value) that fits `number`."""
    chosen = F
    for modulus, remainder, value in cases:
        chosen = chosen.when(number % modulus == remainder, value)
    return chosen.otherwise(otherwise)


def annotations(paragraph_table: DataFrame) -> DataFrame:
    """One raw annotation per paragraph, some faulty the way hand-made tables are."""
    doc = F.substring_index(F.substring_index("pdf_name", ".pdf", 1), "_", -1).cast("bigint")
    v = F.col("v")
    page = (F.col("page") + 1).cast("string")
    rows = paragraph_table.select(
        "pdf_name",
        "page",
        "unique_paragraph_id",
        "paragraph",
        doc.alias("doc"),
        (doc + F.col("unique_paragraph_id")).alias("v"),
        F.translate("paragraph", '"[]{}\\', "").alias("plain"),
    )
    rows = rows.withColumn("w", F.split("plain", " "))
    stem = F.substring_index("pdf_name", ".pdf", 1)

    def word(n: int) -> Column:
        return F.coalesce(F.get("w", F.lit(n - 1)), F.lit("none"))

    number = F.nullif(F.regexp_extract("plain", "[0-9]+", 0), F.lit(""))
    inner = _pick(
        v,
        (19, 0, F.coalesce(number, F.col("plain"))),
        (6, 0, F.replace("plain", F.lit("an"), F.lit("na"))),
        (6, 1, F.concat(F.lit("no such passage "), F.md5("paragraph"))),
        otherwise=F.array_join(F.slice("w", F.lit(2), F.greatest(F.size("w") - 2, F.lit(1))), " "),
    )
    quoted = F.concat(F.lit('"'), F.col("inner"), F.lit('"'))
    whole = F.concat(F.lit('"'), F.col("plain"), F.lit('"'))
    return rows.withColumn("inner", inner).select(
        F.when(v % 50 == 7, "CEZ")
        .otherwise(F.concat(F.lit("company_"), F.col("doc") % 7))
        .alias("company"),
        _pick(
            v,
            (11, 0, stem),
            (11, 1, F.concat(stem, F.lit(",pdf"))),
            (11, 2, F.concat(stem, F.lit(" .pdf"))),
            otherwise=F.col("pdf_name"),
        ).alias("source_file"),
        _pick(
            v,
            (23, 0, page),
            (29, 0, F.concat(F.lit("["), page, F.lit(", x]"))),
            (13, 0, F.concat(F.lit("["), page, F.lit(", "), page, F.lit("]"))),
            otherwise=F.concat(F.lit("["), page, F.lit("]")),
        ).alias("source_page"),
        _pick(v, (31, 0, F.lit("n/a")), (31, 1, F.lit("999")), otherwise=(v % 25).cast("string")).alias(
            "kpi_id"
        ),
        _pick(
            v,
            (41, 0, F.lit(None).cast("string")),
            (37, 0, F.lit("FY20")),
            (4, 0, F.concat(2015 + v % 8, F.lit(".0"))),
            otherwise=(2015 + v % 8).cast("string"),
        ).alias("year"),
        _pick(
            v,
            (43, 0, F.lit(None).cast("string")),
            (4, 0, F.concat_ws(" ", word(2), word(3))),
            (4, 1, F.coalesce(number, word(4))),
            (4, 2, F.concat_ws("\n", word(3), word(4), word(5))),
            otherwise=word(2),
        ).alias("answer"),
        _pick(v, (10, 0, F.lit("TABLE")), (10, 1, F.lit(" TEXT ")), otherwise=F.lit("TEXT")).alias(
            "data_type"
        ),
        _pick(
            v,
            (47, 0, F.lit(None).cast("string")),
            (17, 0, F.concat(F.lit("{"), quoted, F.lit("]"))),
            (13, 0, F.concat(F.lit("["), quoted, F.lit(", "), whole, F.lit("]"))),
            (13, 1, F.concat(F.lit("["), quoted, F.lit(","), whole, F.lit("]"))),
            otherwise=F.concat(F.lit("["), quoted, F.lit("]")),
        ).alias("relevant_paragraphs"),
        F.concat(F.lit("annotator_"), F.col("doc") % 3).alias("annotator"),
        F.when(F.col("doc") % 2 == 0, "OG").alias("sector"),
        F.concat(F.lit("annotation_"), F.col("doc"), F.lit(".csv")).alias("annotation_file_name"),
        F.col("unique_paragraph_id").alias("annotation_row"),
    )


def relevance_scores(spark: SparkSession, folder: str, paragraph_table: DataFrame) -> DataFrame:
    """A detector's verdict on every paragraph for the question annotated there."""
    doc = F.substring_index(F.substring_index("pdf_name", ".pdf", 1), "_", -1).cast("bigint")
    v = F.col("v")
    scored = paragraph_table.select(
        "page",
        "pdf_name",
        "unique_paragraph_id",
        "paragraph",
        doc.alias("doc_id"),
        (doc + F.col("unique_paragraph_id")).alias("v"),
        ((doc + F.col("unique_paragraph_id")) % 25).cast("double").alias("kpi_id"),
    )
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    flag = F.coalesce("quality", (F.col("unique_paragraph_id") % 2).cast("int"))
    dated = question_in_year(F.col("question"), F.col("add_year"), (2015 + v % 8).cast("string"))
    return (
        scored.join(labels, "doc_id", "left")
        .join(kpi_mapping(spark, folder).select("kpi_id", "question", "add_year"), "kpi_id")
        .select(
            "page",
            "pdf_name",
            "unique_paragraph_id",
            "paragraph",
            "kpi_id",
            F.when(v % 2 == 0, dated).otherwise(F.col("question")).alias("question"),
            flag.alias("paragraph_relevance_flag"),
            (0.5 + 0.5 * flag).alias("paragraph_relevance_score(for_label=1)"),
        )
    )


class Stored(NamedTuple):
    """The derived inputs, written once so that every operator reads plain tables."""

    paragraphs: DataFrame
    annotations: DataFrame
    kpi_mapping: DataFrame
    relevance_scores: DataFrame | None


def stored(spark: SparkSession, folder: str, with_scores: bool = False) -> Stored:
    paragraph_table = cut_lineage(paragraphs(spark, folder))
    scores = None
    if with_scores:
        scores = cut_lineage(relevance_scores(spark, folder, paragraph_table))
    return Stored(
        paragraph_table,
        cut_lineage(annotations(paragraph_table)),
        kpi_mapping(spark, folder),
        scores,
    )
