"""Extraction documents as nested JSON: page -> paragraph id -> record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.schemas import EXTRACTION_JSON
from folioforge.sources.listing import decoded

RECORD = [
    "pdf_name",
    "unique_paragraph_id",
    "paragraph",
    "page",
    "start_index_page",
    "last_index_page",
]


def _map_in_order(order: str, key: str, value: str) -> Column:
    """Map from the group's keys to values, entries sorted by `order`."""
    entries = F.array_sort(
        F.collect_list(F.struct(order, key, value)),
        lambda a, b: F.when(a[order] < b[order], -1).when(a[order] > b[order], 1).otherwise(0),
    )
    return F.map_from_entries(
        F.transform(entries, lambda e: F.struct(e[key].alias("key"), e[value].alias("value")))
    )


def nest_paragraphs(paragraphs: DataFrame) -> DataFrame:
    """(pdf_name, json): one JSON text per document, as the format has it."""
    records = paragraphs.select(
        "pdf_name",
        "page",
        "page_key",
        "unique_paragraph_id",
        F.col("unique_paragraph_id").cast("string").alias("id_key"),
        F.struct(*RECORD).alias("record"),
    )
    pages = records.groupBy("pdf_name", "page", "page_key").agg(
        _map_in_order("unique_paragraph_id", "id_key", "record").alias("content")
    )
    return (
        pages.groupBy("pdf_name")
        .agg(_map_in_order("page", "page_key", "content").alias("pages"))
        .select("pdf_name", F.to_json("pages").alias("json"))
    )


def unnest_paragraphs(documents: DataFrame) -> DataFrame:
    """Paragraph table from (pdf_name, json); `pdf_name` overrides the name in the records."""
    return (
        documents.select("pdf_name", F.from_json("json", EXTRACTION_JSON).alias("pages"))
        .select("pdf_name", F.explode("pages").alias("page_key", "content"))
        .select("pdf_name", "page_key", F.explode("content").alias("id_key", "record"))
        .select(
            "pdf_name",
            "record.page",
            "page_key",
            F.col("id_key").cast("bigint").alias("unique_paragraph_id"),
            "record.paragraph",
            "record.start_index_page",
            "record.last_index_page",
        )
    )


def write_extraction_json(
    paragraphs: DataFrame, path: str, mode: str = "error", buckets: int = 1024
) -> None:
    """JSON of documents, one a line, in at most `buckets` folders; empty documents have none.

    A folder is written by one task, so the number of files does not grow with the documents.
    """
    bucket = F.pmod(F.hash("pdf_name"), F.lit(buckets))
    (
        nest_paragraphs(paragraphs)
        .select(F.col("json").alias("value"), bucket.alias("bucket"))
        .repartition("bucket")
        .write.partitionBy("bucket")
        .mode(mode)
        .text(path)
    )


def read_extraction_json(spark: SparkSession, path: str) -> DataFrame:
    """Read documents written above, or files named `<document>[_output].json`.

    A file's own name says which document it is; in the files written above, which hold many
    documents, the records do.
    """
    file_name = decoded("_metadata.file_name")
    stem = F.regexp_replace(F.replace(file_name, F.lit("_output"), F.lit("")), r"\.json$", "")
    recorded = F.regexp_extract("value", r'"pdf_name"\s*:\s*"((?:[^"\\]|\\.)*)"', 1)
    text = spark.read.option("recursiveFileLookup", "true")
    single = text.option("pathGlobFilter", "*.json").text(path, wholetext=True)
    many = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").text(path)
    files = single.select(F.concat(stem, F.lit(".pdf")).alias("pdf_name"), F.col("value").alias("json"))
    return unnest_paragraphs(files.unionAll(many.select(recorded.alias("pdf_name"), F.col("value").alias("json"))))
