import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from folioforge.operators import annotations as ann
from folioforge.operators import running
from folioforge.operators.containment import containing_texts
from folioforge.operators.dedup import dedup_keep_first
from folioforge.operators.paragraphs import number_paragraphs
from folioforge.operators.splitting import train_val_split
from folioforge.plans.extraction import extract
from folioforge.schemas import ANNOTATIONS
from folioforge.sources.kpi_mapping import kpi_mapping_table


def test_extract_numbers_over_pages(rows):
    long, other = "a paragraph of more than twenty letters", "another paragraph of sufficient length"
    pages = rows(
        "pdf_name string, page int, text string",
        ("a.pdf", 0, f"{long}\n\nshort\n\n{other}"),
        ("a.pdf", 1, "short"),
        ("a.pdf", 2, f"{other}"),
        ("b.pdf", 3, f"{long}"),
    )
    got = extract(pages).orderBy("pdf_name", "unique_paragraph_id").collect()
    assert [tuple(r) for r in got] == [
        ("a.pdf", 0, "0", 0, long, 0, 1),
        ("a.pdf", 0, "0", 1, other, 0, 1),
        ("a.pdf", 2, "2", 2, other, 2, 2),
        ("b.pdf", 3, "3", 0, long, 0, 0),
    ]
    assert extract(pages, already_extracted=rows("pdf_name string", ("a.pdf",))).count() == 1
    assert extract(pages, only_annotated=rows("source_file string", ("a.pdf",))).count() == 3
    # exactly twenty is too few
    assert extract(rows("pdf_name string, page int, text string", ("c.pdf", 0, "x" * 20))).count() == 0


def test_numbering_over_many_blocks(rows, monkeypatch):
    monkeypatch.setattr(running, "BLOCK_BITS", 1)
    pick = random.Random(5)
    sizes = {page: pick.randint(0, 3) for page in random.Random(6).sample(range(100), 40)}
    frame = rows(
        "pdf_name string, page int, paragraphs array<string>",
        *[("a.pdf", page, [f"{page}-{i}" for i in range(n)]) for page, n in sizes.items()],
    )
    got = number_paragraphs(frame).orderBy("unique_paragraph_id").collect()
    expected = [f"{page}-{i}" for page in sorted(sizes) for i in range(sizes[page])]
    assert [r.paragraph for r in got] == expected
    assert [r.unique_paragraph_id for r in got] == list(range(len(expected)))


def test_containing_texts(rows):
    pick = random.Random(7)

    def string(low, high):
        return "".join(pick.choice("ab c") for _ in range(pick.randint(low, high)))

    texts = [("d1" if i % 3 else "d2", i, string(0, 40)) for i in range(60)]
    probes = {(pick.choice(["d1", "d2", "d3"]), string(0, 12)) for _ in range(60)} | {("d1", "")}
    got = containing_texts(
        rows("k string, p string", *probes),
        rows("k string, id long, t string", *texts),
        ["k"],
        "p",
        "t",
        F.col("id"),
    ).collect()
    expected = [(k, p, i, t) for k, p in probes for k2, i, t in texts if k == k2 and p in t]
    assert sorted((r.k, r.p, r.id, r.t) for r in got) == sorted(expected)


def annotation(**changed):
    row = {
        "company": "c",
        "source_file": "a.pdf",
        "source_page": "[1]",
        "kpi_id": "2.1",
        "year": "2016",
        "answer": "yes\nno ",
        "data_type": "TEXT",
        "relevant_paragraphs": '["p"]',
        "annotator": "x",
        "sector": None,
        "annotation_file_name": "f.csv",
        "annotation_row": 0,
    }
    return tuple({**row, **changed}.values())


@pytest.fixture
def mapping(rows):
    return kpi_mapping_table(
        rows(
            "kpi_id double, question string, sectors string, add_year boolean, kpi_category string",
            (2.1, "What?", "OG", True, "TEXT, TABLE"),
            (3.0, "Who?", "OG", False, "TEXT"),
        )
    )


def test_clean_annotations(rows, mapping):
    kinds = {
        0: {},
        1: {"source_file": "a,pdf", "data_type": " TEXT "},
        2: {"source_file": " b "},
        10: {"company": None},
        11: {"year": None},
        12: {"company": "CEZ"},
        13: {"source_page": "3"},
        14: {"source_page": "[1"},
        15: {"source_page": "[]"},
        16: {"kpi_id": "99"},
        17: {"kpi_id": "n/a"},
        18: {"kpi_id": "3", "data_type": "TABLE"},
        19: {"data_type": None},
    }
    raw = rows(ANNOTATIONS, *[annotation(annotation_row=i, **k) for i, k in kinds.items()])
    got = ann.clean_annotations(raw, mapping).orderBy("annotation_row").collect()
    assert [(r.annotation_row, r.source_file, r.source_page, r.data_type) for r in got] == [
        (0, "a.pdf", ["1"], "TEXT"),
        (1, "a.pdf", ["1"], "TEXT"),
        (2, "b.pdf", ["1"], "TEXT"),
    ]
    rejects = {r.reason: r.n_rows for r in ann.annotation_rejects(raw, mapping).collect()}
    assert rejects == {
        "missing value": 2,
        "excluded company": 1,
        "invalid page": 3,
        "unknown question": 2,
        "data type not allowed": 2,
    }
    assert {r.source_page for r in ann.invalid_pages(raw).collect()} == {"3", "[1", "[]"}
    assert ann.clean_annotations(raw, mapping, exclude=()).count() == 4


def test_clean_splits_passages(rows, mapping):
    raw = rows(
        ANNOTATIONS,
        annotation(annotation_row=0),
        annotation(annotation_row=1, source_page="[1, 2]", relevant_paragraphs='["p", "q","r"]'),
        annotation(annotation_row=2, source_page="[1, 2]", relevant_paragraphs='["p"]', kpi_id="3"),
        annotation(annotation_row=3, source_page="[1, 2, 3]", relevant_paragraphs='["p","q"]'),
        annotation(annotation_row=4, relevant_paragraphs="p"),
        annotation(annotation_row=5, answer=None),
    )
    got = ann.clean(ann.clean_annotations(raw, mapping), mapping).collect()
    assert sorted((r.annotation_row, r.source_page, r.relevant_paragraphs, r.several) for r in got) == [
        (0, "1", "p", False),
        (1, "1", "p", True),
        (1, "2", "q", True),
        (2, "1", "p", False),
        (3, "1", "p", True),
        (3, "2", "q", True),
    ]
    assert {r.question for r in got} == {"What in year 2016?", "Who?"}
    assert {r.answer for r in got} == {"yes no"}


def test_dedup_keeps_first(rows):
    frame = rows("k string, o int, v string", ("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only"))
    got = dedup_keep_first(frame, ["k"], [F.col("o")]).collect()
    assert sorted(tuple(r) for r in got) == [("a", 1, "early"), ("b", 5, "only")]


@pytest.mark.parametrize("n, train", [(0, 0), (1, 1), (2, 2), (3, 2), (5, 4), (12, 10), (13, 10), (700, 560)])
def test_split_is_exact_and_in_hash_order(rows, n, train):
    got = train_val_split(rows("k string", *[(str(i),) for i in range(n)]), ["k"]).collect()
    order = sorted((str(i) for i in range(n)), key=lambda k: hashlib.md5(f"42|{k}".encode()).hexdigest())
    assert {r.k for r in got if r.split == "train"} == set(order[:train])
    assert len(got) == n


def test_split_with_few_buckets(rows, monkeypatch):
    monkeypatch.setattr("folioforge.operators.splitting.BUCKET_DIGITS", 1)
    for ratio in (0.0, 0.35, 1.0):
        got = train_val_split(rows("k string", *[(str(i),) for i in range(400)]), ["k"], ratio)
        counts = defaultdict(int, {r.split: r["count"] for r in got.groupBy("split").count().collect()})
        assert counts["train"] == round(400 * (1 - ratio))
