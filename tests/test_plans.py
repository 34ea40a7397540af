import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check_sql import compare
from folioforge import sample_views
from folioforge.operators import annotations as ann
from folioforge.operators import answerable, passages
from folioforge.plans.question_answering import curate_qa, qa_examples
from folioforge.schemas import ANNOTATIONS, PARAGRAPHS, QA_COLUMNS, RELEVANCE_SCORES
from folioforge.sources.kpi_mapping import kpi_mapping_table

FOLDER = "/root/testdata/sf0.001"


def annotation(row, page, answer, passage, kpi_id="2"):
    return (
        "c",
        "a.pdf",
        f"[{page}]",
        kpi_id,
        "2016",
        answer,
        "TEXT",
        f'["{passage}"]',
        "me",
        None,
        "f.csv",
        row,
    )


@pytest.fixture
def small(rows):
    texts = ["Net (scope) target of 25 percent", "Alpha beta gamma", "In 2025 the target", "25 it is"]
    paragraphs = rows(
        PARAGRAPHS,
        *[("a.pdf", i // 2, str(i // 2), i, t, i // 2 * 2, i // 2 * 2 + 1) for i, t in enumerate(texts)],
    )
    annotations = rows(
        ANNOTATIONS,
        annotation(0, 1, "25", "scope target"),
        annotation(1, 1, "Alpha", "Alpho beto gammo"),
        annotation(2, 1, "zeta", "nothing like it"),
        annotation(3, 9, "own", "its own passage"),
        annotation(4, 1, "target", "scope", kpi_id="9"),
    )
    mapping = kpi_mapping_table(
        rows(
            "kpi_id double, question string, sectors string, add_year boolean, kpi_category string",
            (2.0, "What?", "OG", False, "TEXT"),
            (9.0, "Which company?", "OG", False, "TEXT"),
        )
    )
    return paragraphs, annotations, mapping


def test_answerable_by_hand(small):
    paragraphs, annotations, mapping = small
    cleaned = ann.clean(ann.clean_annotations(annotations, mapping), mapping)
    full = passages.full_paragraphs(cleaned, paragraphs)
    got = {r.annotation_row: (r.relevant_paragraphs, r.answer_start) for r in full.collect()}
    assert got == {
        # contained in the cleaned paragraph, brackets gone
        0: ("net scope target of 25 percent", [20]),
        # nearest by edits and holds the answer, which moves off 0
        1: (" alpha beta gamma", [1]),
        # nearest does not hold the answer
        2: ("nothing like it", []),
        # no such page
        3: (" its own passage".strip(), [4]),
        4: ("net scope target of 25 percent", [10]),
    }
    extra = answerable.extra_answerable(full, paragraphs).collect()
    # "25" in "2025 " has a non-digit behind it; question 9 gets no further rows
    assert sorted((r.annotation_row, r.relevant_paragraphs, r.answer_start) for r in extra) == [
        (0, " 25 it is", [1]),
        (0, "in 2025 the target", [5]),
    ]
    assert {r.annotator for r in extra} == {"1QBit"}
    examples = answerable.create_answerable(cleaned, paragraphs)
    assert examples.columns == QA_COLUMNS
    assert examples.count() == 6
    assert answerable.create_answerable(cleaned, paragraphs, find_new=False).count() == 4


def test_unanswerable_by_hand(small, rows):
    paragraphs, annotations, mapping = small
    schema = ", ".join(f"`{c}` {t}" for c, t in RELEVANCE_SCORES.items())
    text = "Net (scope) target of 25 percent"
    scores = rows(
        schema,
        (0, "a.pdf", 0, text, 2.0, "What?", 1, 0.9),
        (0, "a.pdf", 0, text, 2.0, "What else?", 1, 0.9),
        (0, "a.pdf", 0, text, 2.0, "What else?", 1, 0.9),
        (0, "z.pdf", 0, text, 2.0, "What else?", 1, 0.9),
        (0, "a.pdf", 0, text, 2.0, "Why?", 0, 0.1),
        (1, "a.pdf", 2, "In 2025 the target", 2.0, "What?", 1, 0.9),
    )
    examples = qa_examples(annotations, paragraphs, mapping, scores).where("answer = ''").collect()
    assert [tuple(r) for r in examples] == [
        ("a.pdf", "net scope target of 25 percent", "What else?", "", [-1])
    ]
    pages = qa_examples(annotations, paragraphs, mapping, scores, unanswerable_mode="pages")
    assert {(r.source_file, r.question, r.paragraph) for r in pages.where("answer = ''").collect()} == {
        ("a.pdf", "What else?", "net scope target of 25 percent"),
        ("a.pdf", "What?", "in 2025 the target"),
    }
    train, val = curate_qa(annotations, paragraphs, mapping, scores)
    assert (train.count(), val.count()) == (6, 1)
    assert train.intersect(val).count() == 0


def test_crowded_documents_give_the_same(spark):
    v = sample_views.stored(spark, FOLDER)
    cleaned = ann.clean(ann.text_only(ann.clean_annotations(v.annotations, v.kpi_mapping)), v.kpi_mapping)
    usual = answerable.create_answerable(cleaned, v.paragraphs)
    crowded = answerable.create_answerable(cleaned, v.paragraphs)
    assert usual.count() == crowded.count() > 0
    assert usual.exceptAll(crowded).count() == 0
    for r in usual.where(F.size("answer_start") > 0).collect():
        assert all(r.paragraph[s : s + len(r.answer)] == r.answer and s > 0 for s in r.answer_start)


def test_every_query_has_a_name_in_both(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
    assert duckdb.__version__


@pytest.mark.parametrize("name", ["extraction_report_files", "clean", "create_unanswerable", "match_paragraphs"])
def test_query_equals_sql(spark, name):
    assert "equal" in compare(spark, FOLDER, name)
