"""What queries write and work out on the way: few columns, small files, nothing twice."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import registered_queries
from folioforge import sample_views
from folioforge.operators import passages
from folioforge.session import cut_lineage


@pytest.fixture
def sample(spark, folder):
    """A small folder of the tables that queries read."""
    docs = [
        (i, "\n".join(f"the plan {i % 3} of line {j} holds an answer of {j * 7} tonnes a year" for j in range(11))) for i in range(6)
    ]
    tables = {
        "documents": (docs, "doc_id long, text string"),
        "labels": ([(i, 1) for i in range(6)], "doc_id long, quality int"),
        "benchmark": ([(i, f"passage {i}") for i in range(25)], "item_id int, text string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def files(table):
    return [f.removeprefix("file://") for f in table.inputFiles()]


def test_intermediate_tables_are_packed_well(spark):
    (file, *_) = files(cut_lineage(spark.range(9)))
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"


def test_full_paragraphs_writes_no_text_of_small_pages(spark, sample, monkeypatch):
    written = []
    monkeypatch.setattr(passages, "cut_lineage", lambda rows: written.append(rows.columns) or cut_lineage(rows))
    v = sample_views.stored(spark, sample)
    (annotation_file, *_) = files(v.annotations)
    found = registered_queries._full(v)
    assert found.count() == found.where("relevant_paragraphs is not null").count() > 30
    names = {name for columns in written for name in columns}
    assert "passage" in names and not names & {"text", "relevant_paragraphs"}
    with pytest.raises(FileNotFoundError):
        pq.ParquetFile(annotation_file)


def test_long_pairs_are_dealt_out_and_measured_right(rows):
    page = ("d", "0")
    texts = [(*page, i, "xyz"[i % 3] * 50 + "ab" * 800 + "q" * (i * 9)) for i in range(40)]
    sought = rows("__passage long, passage string", (0, "ab" * 800))
    pairs = rows("__passage long, source_file string, page_key string, unique_paragraph_id long", *[(0, *t[:3]) for t in texts])
    table = rows("source_file string, page_key string, unique_paragraph_id long, text string", *texts)
    met = passages._with_texts(pairs, sought, table)
    assert met.rdd.getNumPartitions() >= passages.SPREAD
    for most in (0, 50, 64, 65, 300, 1024, 1500, 5000):
        got = passages._with_distance(met, F.lit(most)).withColumn("plain", F.levenshtein("passage", "text")).collect()
        assert len(got) == 40 and all(r["__distance"] == (r.plain if r.plain <= most else -1) for r in got)


def test_relevance_join_works_paragraphs_out_once(spark, sample):
    found = registered_queries.relevance_join(spark, sample)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() > 0 and "levenshtein" not in plan


def test_negative_candidates_counts_from_a_written_table(spark, sample):
    found = registered_queries.negative_candidates(spark, sample)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert found.where("n_similar > 0").count() > 0 and "n_similar" in plan and "cosine" not in plan


def test_hits_are_written_before_rows_meet_them(spark, sample):
    found = registered_queries.extra_answerable(spark, sample)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() > 0 and "collect_list" not in plan
