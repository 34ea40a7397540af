"""CSV records that many tasks read, against Spark's reader of whole files."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from folioforge.sources.annotations import read_annotation_csv
from folioforge.sources.csv_records import csv_records

PIECES = ["a", "b c", ",", '""', '"', "\n", "\r\n", " ", "", "\n\n", "é"]


def value(draw):
    kind = draw.random()
    if kind < 0.3:
        return draw.choice(["plain", "", "x 1", 'inch 5" wide', '""', " lead"])
    inner = "".join(draw.choice([p for p in PIECES if p != '"']) for _ in range(draw.randint(0, 12)))
    return f'"{inner}"'


def csv_text(seed, rows=200):
    draw = random.Random(seed)
    ending = "\n" if seed % 2 else "\r\n"
    lines = ["c1,c2,c3"]
    for _ in range(rows):
        lines.append(",".join(value(draw) for _ in range(3)))
        if draw.random() < 0.1:
            lines.append("")
    return ending.join(lines) + ending


@pytest.fixture
def small_blocks(spark):
    """Blocks of 100 bytes, so that records begin in one and end in another."""
    names = {"spark.sql.files.maxPartitionBytes": "100", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, size in names.items():
        spark.conf.set(name, size)
    yield
    for name, size in before.items():
        spark.conf.set(name, size)


def test_records_equal_those_of_whole_files(spark, folder, small_blocks):
    for seed in range(4):
        Path(folder, f"t{seed}.csv").write_bytes(csv_text(seed).encode())
    paths = [f"{folder}/t{seed}.csv" for seed in range(4)]
    records = csv_records(spark, paths)
    options = {"escape": '"', "multiLine": "true", "lineSep": "\n"}
    schema = "c1 string, c2 string, c3 string"
    rows = records.where("record > 0").select("file", "record", F.from_csv("value", schema, options).alias("r"))
    got = {}
    for row in rows.orderBy("file", "record").collect():
        got.setdefault(row.file[-6:], []).append(tuple(row.r))
    for path in paths:
        whole = spark.read.csv(path, schema=schema, header=True, multiLine=True, escape='"')
        wanted = [tuple(v if v is None else v.replace("\r\n", "\n") for v in r) for r in whole.collect()]
        assert got[path[-6:]] == wanted
    blocks = spark.read.text(paths).select("_metadata.file_path", "_metadata.file_block_start").distinct()
    assert blocks.count() > 40
    numbers = records.groupBy("file").agg(F.max("record").alias("last"), F.count("*").alias("n")).collect()
    assert all(r.last == r.n - 1 for r in numbers)


def test_a_large_annotation_file_is_numbered_over_its_blocks(spark, folder, small_blocks):
    names = "company,source_file,source_page,kpi_id,year,answer,data_type,relevant_paragraphs"
    row = 'c,a.pdf,[1],2,2016,"answer\n, ""{}""",TEXT,x'
    Path(folder, "annotation.csv").write_text("\n".join([names, *(row.format(i) for i in range(300))]))
    table = read_annotation_csv(spark, folder).orderBy("annotation_row").collect()
    assert [(r.annotation_row, r.answer) for r in table] == [(i, f'answer\n, "{i}"') for i in range(300)]


def test_empty_file_and_header_alone(spark, folder):
    Path(folder, "empty.csv").write_text("")
    Path(folder, "header.csv").write_text("c1,c2\n")
    got = csv_records(spark, [f"{folder}/empty.csv", f"{folder}/header.csv"]).collect()
    assert [(r.record, r.value) for r in got] == [(0, "c1,c2")]
