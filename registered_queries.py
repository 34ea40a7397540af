"""Every operator as a query over the sample tables, run over whole tables and texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge import sample_views as views
from folioforge.functions.answers import answer_offsets, shifted_offsets, shifted_paragraph
from folioforge.functions.text import clean_qa_text, clean_relevance_text
from folioforge.operators import annotations as ann
from folioforge.operators import answerable, matching, negatives, passages, unanswerable
from folioforge.operators.containment import containing_texts
from folioforge.operators.paragraphs import annotated_only, skip_extracted, split_paragraphs
from folioforge.operators.report import extraction_report, extraction_totals
from folioforge.operators.splitting import train_val_split
from folioforge.plans.question_answering import curate_qa
from folioforge.plans.relevance import curate_relevance
from folioforge.schemas import ANNOTATION_PROVENANCE, ANNOTATION_REQUIRED, QA_COLUMNS
from folioforge.session import cut_lineage, drop_table, new_folder
from folioforge.sources import exports, extraction_json
from folioforge.sources.annotations import (
    aggregate_tables,
    read_aggregated,
    read_annotation_csv,
    read_annotation_json,
)
from folioforge.sources.extraction_json import nest_paragraphs, unnest_paragraphs
from folioforge.sources.kpi_mapping import read_kpi_mapping
from folioforge.sources.listing import route_by_suffix
from folioforge.sources.published import published

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SCORE_DIGITS = 6
# Fuzzy scores have short decimals, which would often lie between two of six digits.
FINE_DIGITS = 8


def register(query: Callable[[SparkSession, str], DataFrame]):
    REGISTRY[query.__name__] = query
    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(REGISTRY)


def _joined(array: str) -> Column:
    """Arrays as text, so that every engine compares them alike."""
    return F.array_join(array, ",").alias(array)


def _cleaned(v: views.Stored) -> DataFrame:
    return ann.clean(ann.text_only(ann.clean_annotations(v.annotations, v.kpi_mapping)), v.kpi_mapping)


def _full(v: views.Stored) -> DataFrame:
    rows = passages.full_paragraphs(_cleaned(v), v.paragraphs)
    drop_table(v.annotations)  # written to a table of their own by now
    return rows


@register
def extract_paragraphs(spark, folder):
    return views.paragraphs(spark, folder)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    suffix = (
        F.when(F.col("doc_id") % 10 == 3, ".docx").when(F.col("doc_id") % 10 == 4, ".PDF").otherwise(".pdf")
    )
    name = F.concat(F.lit("doc_"), F.col("doc_id"), suffix)
    return views.documents(spark, folder).select("doc_id", name.alias("file_name"))


def _report(spark: SparkSession, folder: str) -> DataFrame:
    routed = route_by_suffix(_files(spark, folder)).withColumn("pdf_name", F.col("file_name"))
    stem = F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".pdf"))
    pages = (
        views.pages(spark, folder)
        .withColumnRenamed("pdf_name", "stem")
        .join(routed.where("supported").select(stem.alias("stem"), "pdf_name"), "stem")
    )
    page_paragraphs = split_paragraphs(pages, separator=views.LINE)
    return extraction_report(routed.select("pdf_name", "supported"), page_paragraphs)


@register
def extraction_report_files(spark, folder):
    return _report(spark, folder)


@register
def extraction_report_totals(spark, folder):
    return extraction_totals(_report(spark, folder))


@register
def crowded_containment(spark, folder):
    """Thousands of strings in one group: pieces of paragraphs sought in all paragraphs of a language."""
    languages = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    doc = F.substring_index(F.substring_index("pdf_name", ".pdf", 1), "_", -1).cast("bigint")
    texts = views.paragraphs(spark, folder).withColumn("doc_id", doc).join(languages, "doc_id")
    # read several times
    texts = cut_lineage(texts.select("lang", "pdf_name", "unique_paragraph_id", "paragraph"))
    strings = texts.select("lang", F.substring("paragraph", 11, 24).alias("piece")).distinct()
    place = F.xxhash64("pdf_name", "unique_paragraph_id")
    hits = containing_texts(strings, texts, ["lang"], "piece", "paragraph", place)
    return hits.groupBy("pdf_name", "unique_paragraph_id").agg(F.count("*").alias("n_pieces"))


@register
def short_containment(spark, folder):
    """Strings of one and two characters sought in all paragraphs of their document."""
    texts = views.paragraphs(spark, folder).select("pdf_name", "unique_paragraph_id", "paragraph")
    # read several times
    texts = cut_lineage(texts)
    pieces = F.explode(F.array(F.substring("paragraph", 4, 1), F.substring("paragraph", 9, 2)))
    strings = texts.select("pdf_name", pieces.alias("piece")).distinct()
    hits = containing_texts(strings, texts, ["pdf_name"], "piece", "paragraph", F.col("unique_paragraph_id"))
    return hits.groupBy("pdf_name", "piece").agg(
        F.count("*").alias("n_paragraphs"), F.min("unique_paragraph_id").alias("first_paragraph")
    )


@register
def skip_extracted_documents(spark, folder):
    """Documents with a label count as extracted before."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    done = labels.select(F.concat(F.lit("doc_"), "doc_id", F.lit(".pdf")).alias("pdf_name"))
    return skip_extracted(views.pages(spark, folder), done)


@register
def annotated_documents_only(spark, folder):
    """Documents with a label count as annotated."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    named = labels.select(F.concat(F.lit("doc_"), "doc_id", F.lit(".pdf")).alias("source_file"))
    return annotated_only(views.pages(spark, folder), named)


@register
def nested_roundtrip(spark, folder):
    return unnest_paragraphs(nest_paragraphs(views.paragraphs(spark, folder)))


@register
def clean_text_qa(spark, folder):
    """Applied twice, because the second pass may change the text again."""
    once = views.documents(spark, folder).select("doc_id", clean_qa_text(F.col("text")).alias("once"))
    return once.withColumn("twice", clean_qa_text(F.col("once")))


@register
def clean_text_relevance(spark, folder):
    return views.documents(spark, folder).select(
        "doc_id", clean_relevance_text(F.col("text")).alias("cleaned")
    )


@register
def kpi_mapping(spark, folder):
    return views.kpi_mapping(spark, folder).withColumn("kpi_category", _joined("kpi_category"))


@register
def aggregate_annotations(spark, folder):
    """Two tables of different columns: one with a `Sector`, one without annotators."""
    rows = views.stored(spark, folder).annotations
    even = F.col("annotation_row") % 2 == 0
    first = rows.where(even).withColumnRenamed("sector", "Sector")
    second = rows.where(~even).drop("sector", "annotator")
    third = rows.drop("answer")
    return aggregate_tables([first, second, third])


@register
def clean_annotations(spark, folder):
    v = views.stored(spark, folder)
    return ann.clean_annotations(v.annotations, v.kpi_mapping).withColumn(
        "source_page", _joined("source_page")
    )


@register
def annotation_rejects(spark, folder):
    v = views.stored(spark, folder)
    return ann.annotation_rejects(v.annotations, v.kpi_mapping)


@register
def passage_rejects(spark, folder):
    v = views.stored(spark, folder)
    rows = ann.text_only(ann.clean_annotations(v.annotations, v.kpi_mapping))
    return ann.passage_rejects(rows, v.kpi_mapping)


@register
def invalid_pages(spark, folder):
    return ann.invalid_pages(views.stored(spark, folder).annotations)


@register
def clean(spark, folder):
    return _cleaned(views.stored(spark, folder))


@register
def answer_positions(spark, folder):
    """Each annotation's answer in its own paragraph, with the shift of answers at 0."""
    v = views.stored(spark, folder)
    pairs = v.annotations.join(
        v.paragraphs.select(
            F.concat(
                F.lit("annotation_"),
                F.substring_index(F.substring_index("pdf_name", ".pdf", 1), "_", -1),
                F.lit(".csv"),
            ).alias("annotation_file_name"),
            F.col("unique_paragraph_id").alias("annotation_row"),
            clean_qa_text(F.col("paragraph")).alias("paragraph"),
        ),
        ["annotation_file_name", "annotation_row"],
    ).select(
        "annotation_file_name",
        "annotation_row",
        "paragraph",
        clean_qa_text(F.replace("answer", F.lit("\n"), F.lit(" "))).alias("answer"),
    )
    found = pairs.where(F.col("answer").isNotNull()).withColumn(
        "answer_start", answer_offsets(F.col("answer"), F.col("paragraph"))
    )
    return found.select(
        "annotation_file_name",
        "annotation_row",
        "answer",
        F.length(shifted_paragraph(F.col("paragraph"), F.col("answer_start"))).alias("length"),
        F.array_join(shifted_offsets(F.col("answer_start")), ",").alias("answer_start"),
    )


@register
def full_paragraph(spark, folder):
    return _full(views.stored(spark, folder)).withColumn("answer_start", _joined("answer_start"))


@register
def extra_answerable(spark, folder):
    v = views.stored(spark, folder)
    return answerable.extra_answerable(cut_lineage(_full(v)), v.paragraphs).withColumn(
        "answer_start", _joined("answer_start")
    )


@register
def create_answerable(spark, folder):
    v = views.stored(spark, folder)
    rows = cut_lineage(_full(v))
    return answerable.annotated_examples(rows, True, v.paragraphs).select(
        *QA_COLUMNS[:-1], _joined("answer_start")
    )


@register
def relevance_join(spark, folder):
    v = views.stored(spark, folder, with_scores=True)
    scores = unanswerable.relevance_scores(v.relevance_scores)
    # written, as the join would work paragraphs out anew for each filter and key
    return unanswerable.relevance_annotation_join(scores, cut_lineage(_full(v))).drop(
        "paragraph_relevance_score(for_label=1)"
    )


def _unanswerable(spark, folder, mode):
    v = views.stored(spark, folder, with_scores=True)
    rows = cut_lineage(_full(v))
    return unanswerable.create_unanswerable(rows, v.relevance_scores, mode).select(
        *QA_COLUMNS[:-1], _joined("answer_start")
    )


@register
def create_unanswerable(spark, folder):
    return _unanswerable(spark, folder, "answers")


@register
def unanswerable_pages(spark, folder):
    return _unanswerable(spark, folder, "pages")


@register
def train_val_parts(spark, folder):
    key = ["pdf_name", "unique_paragraph_id"]
    rows = cut_lineage(views.paragraphs(spark, folder))
    return train_val_split(rows.select(*key, F.md5("paragraph").alias("paragraph_md5")), key)


@register
def match_paragraphs(spark, folder):
    v = views.stored(spark, folder)
    return matching.match_paragraphs(matching.page_sentences(v.annotations), v.paragraphs)


@register
def tfidf_cosine(spark, folder):
    v = views.stored(spark, folder)
    sentences = matching.page_sentences(v.annotations)
    return matching.page_cosines(sentences, v.paragraphs).withColumn(
        "cosine", F.round("cosine", SCORE_DIGITS)
    )


@register
def closest_paragraph(spark, folder):
    v = views.stored(spark, folder)
    return matching.closest_paragraph(
        matching.page_sentences(v.annotations), v.paragraphs
    ).withColumn(
        "score", F.round("score", SCORE_DIGITS)
    )


@register
def similar_paragraphs(spark, folder):
    v = views.stored(spark, folder)
    return negatives.similar_paragraphs(v.annotations, v.paragraphs).withColumn(
        "score", F.round("score", FINE_DIGITS)
    )


@register
def negative_candidates(spark, folder):
    v = views.stored(spark, folder)
    return negatives.negative_candidates(v.annotations, v.paragraphs)


@register
def negative_sample(spark, folder):
    v = views.stored(spark, folder)
    return negatives.negative_sample(v.annotations, v.paragraphs, neg_sample_rate=2)


def _relevance(spark, folder, **options):
    v = views.stored(spark, folder)
    return curate_relevance(v.paragraphs, v.annotations, v.kpi_mapping, **options).withColumn(
        "source_page", _joined("source_page")
    )


@register
def curate_relevance_exact(spark, folder):
    return _relevance(spark, folder, exact_only=True)


@register
def curate_relevance_full(spark, folder):
    return _relevance(spark, folder, create_neg_samples=True)


@register
def curate_question_answering(spark, folder):
    v = views.stored(spark, folder, with_scores=True)
    train, val = curate_qa(v.annotations, v.paragraphs, v.kpi_mapping, v.relevance_scores)
    both = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val")))
    return both.withColumn("answer_start", _joined("answer_start"))


@register
def nested_files(spark, folder):
    """Extraction files written and read back."""
    place = new_folder(spark)
    extraction_json.write_extraction_json(views.paragraphs(spark, folder), place, buckets=16)
    return extraction_json.read_extraction_json(spark, place)


@register
def kpi_mapping_file(spark, folder):
    """The question catalogue written as the CSV file it is kept in, and read."""
    place = new_folder(spark)
    rows = views.kpi_mapping(spark, folder).withColumn("kpi_category", F.array_join("kpi_category", ", "))
    exports.write_table(rows, place)
    return read_kpi_mapping(spark, place).withColumn("kpi_category", _joined("kpi_category"))


@register
def relevance_score_files(spark, folder):
    """Detector scores written as CSV, and read by name."""
    place = new_folder(spark)
    scores = views.relevance_scores(spark, folder, views.paragraphs(spark, folder))
    exports.write_table(scores.select(*reversed(scores.columns), F.lit("x").alias("further")), place)
    return exports.read_relevance_scores(spark, place).drop("paragraph_relevance_score(for_label=1)")


def _annotation_files(spark: SparkSession, folder: str) -> str:
    """Annotation files of three layouts: with a `Sector`, without annotators, and without answers."""
    place = new_folder(spark)
    rows = views.stored(spark, folder).annotations
    even = F.col("annotation_row") % 2 == 0
    layouts = {
        "first": rows.where(even).withColumnRenamed("sector", "Sector").drop(*ANNOTATION_PROVENANCE),
        "second": rows.where(~even).select(*reversed(ANNOTATION_REQUIRED), F.lit("1").alias("further")),
        "third": rows.drop("answer", *ANNOTATION_PROVENANCE),
    }
    for name, table in layouts.items():
        exports.write_table(table, f"{place}/{name}")
    return place


@register
def annotation_files(spark, folder):
    """CSV annotation files read; the numbers of each file's rows run from 0 without a gap."""
    rows = read_annotation_csv(spark, f"{_annotation_files(spark, folder)}/*", "part-*.csv")
    in_file = F.count("*").over(Window.partitionBy("annotation_file_name"))
    dense = (F.col("annotation_row") >= 0) & (F.col("annotation_row") < in_file)
    own = F.col("annotator").startswith("part-")
    return rows.select(
        *ANNOTATION_REQUIRED, F.when(~own, F.col("annotator")).alias("annotator"), "sector", dense.alias("dense")
    )


@register
def saved_aggregate(spark, folder):
    """Clean annotations saved by a first run; the second reads them and not the annotation folder."""
    v = views.stored(spark, folder)
    place = new_folder(spark)
    v.annotations.drop(*ANNOTATION_PROVENANCE).write.json(f"{place}/files")
    tables = read_annotation_json(spark, f"{place}/files", "part-*.json")
    ann.clean_annotations(tables, v.kpi_mapping).write.parquet(f"{place}/saved")
    again = read_aggregated(spark, f"{place}/saved", f"{place}/none", v.kpi_mapping)
    return again.drop(*ANNOTATION_PROVENANCE).withColumn("source_page", _joined("source_page"))


@register
def relevance_export(spark, folder):
    """Relevance rows published twice as CSV; the newest complete result is read back."""
    v = views.stored(spark, folder)
    rows = cut_lineage(curate_relevance(v.paragraphs, v.annotations, v.kpi_mapping, exact_only=True))
    place = new_folder(spark)
    exports.write_relevance(rows.limit(0), place, "first")
    exports.write_relevance(rows, place, "second")
    (path,) = published(spark, place).values()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return exports.read_table(spark, path, columns).withColumn("source_page", _joined("source_page"))


@register
def train_val_export(spark, folder):
    """Both parts of the answerable examples published as JSON, and read back."""
    v = views.stored(spark, folder)
    train, val = curate_qa(v.annotations, v.paragraphs, v.kpi_mapping)
    place = new_folder(spark)
    exports.write_train_val(train, val, place)
    return exports.read_train_val(spark, place).withColumn("answer_start", _joined("answer_start"))
