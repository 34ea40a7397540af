import json
import os
from datetime import date
from pathlib import Path

from folioforge.plans.extraction import extract_files
from folioforge.schemas import PARAGRAPHS
from folioforge.sources import annotations as source
from folioforge.sources.exports import (
    read_relevance_scores,
    write_relevance,
    write_train_val,
)
from folioforge.sources.extraction_json import (
    nest_paragraphs,
    read_extraction_json,
    write_extraction_json,
)
from folioforge.sources.kpi_mapping import read_kpi_mapping
from folioforge.sources.listing import list_files, route_by_suffix

HEADER = "company,source_file,source_page,kpi_id,year,answer,data_type,relevant_paragraphs"


def paragraph_rows():
    return [
        ("my report.pdf", 0, "0", 0, 'said "so"\\', 0, 0),
        ("my report.pdf", 2, "2", 1, "second", 1, 2),
        ("my report.pdf", 2, "2", 2, "third", 1, 2),
        ("my report.pdf", 5000, "5000", 3, "far away", 3, 3),
        ("b.pdf", 10, "10", 0, "other", 0, 0),
    ]


def test_json_round_trip(spark, rows, folder):
    table = rows(PARAGRAPHS, *paragraph_rows())
    nested = {r.pdf_name: json.loads(r.json) for r in nest_paragraphs(table).collect()}
    assert list(nested["my report.pdf"]) == ["0", "2", "5000"]
    assert nested["my report.pdf"]["2"]["1"] == {
        "pdf_name": "my report.pdf",
        "unique_paragraph_id": 1,
        "paragraph": "second",
        "page": 2,
        "start_index_page": 1,
        "last_index_page": 2,
    }
    assert set(nested) == {"my report.pdf", "b.pdf"}
    write_extraction_json(table, f"{folder}/out")
    back = read_extraction_json(spark, f"{folder}/out").collect()
    assert sorted(tuple(r) for r in back) == sorted(paragraph_rows())


def test_json_file_name_names_the_document(spark, folder):
    record = {
        "pdf_name": "inner.pdf",
        "unique_paragraph_id": 14,
        "paragraph": "text",
        "page": 0,
        "start_index_page": 0,
        "last_index_page": 17,
    }
    for name in ("a b+c_output.json", "plain.json"):
        Path(folder, name).write_text(json.dumps({"1": {"14": record}}, indent=4))
    got = read_extraction_json(spark, folder).orderBy("pdf_name").collect()
    assert [tuple(r) for r in got] == [
        ("a b+c.pdf", 0, "1", 14, "text", 0, 17),
        ("plain.pdf", 0, "1", 14, "text", 0, 17),
    ]


def mapping_file(folder):
    path = f"{folder}/mapping.csv"
    Path(path).write_text(
        "kpi_id,question,sectors,add_year,kpi_category,,\n"
        '2.1,What is it?,"OG, CM",TRUE,"TEXT, TABLE",,\n'
        "3,Who is it?,OG,FALSE,TEXT,,\n"
    )
    return path


def test_kpi_mapping(spark, folder):
    got = read_kpi_mapping(spark, mapping_file(folder)).orderBy("kpi_id").collect()
    assert [tuple(r) for r in got] == [
        (2.1, "What is it?", "OG, CM", True, ["TEXT", "TABLE"]),
        (3.0, "Who is it?", "OG", False, ["TEXT"]),
    ]


def test_kpi_mapping_by_name_and_last_of_equal_ids(spark, folder):
    path = f"{folder}/other.csv"
    Path(path).write_text(
        "question,kpi_category,kpi_id,extra,add_year,sectors\nOld?,TEXT,2,x,FALSE,OG\nNew?,TEXT,2.0,y,TRUE,CM\n"
    )
    got = [tuple(r) for r in read_kpi_mapping(spark, path).collect()]
    assert got == [(2.0, "New?", "CM", True, ["TEXT"])]
    Path(path).write_text("kpi_id,question\n1,What?\n")
    try:
        read_kpi_mapping(spark, path)
    except ValueError as error:
        assert "add_year" in str(error)
    else:
        raise AssertionError("missing columns must be refused")


def annotation_folder(folder):
    path = Path(folder, "in put")
    path.mkdir()
    row = 'c,a.pdf,"[1, 2]",2.1,2016,"two\nlines",TEXT,"[""p"", ""q""]"'
    (path / "one annotation.csv").write_text(f"{HEADER},Sector,extra\n{row},OG,1\n{row},CM,2\n")
    (path / "annotation_two.csv").write_text(f"annotator,{HEADER}\nme,{row}\n")
    (path / "annotation_bad.csv").write_text("company,year\nc,2016\n")
    (path / "ignored.csv").write_text(f"{HEADER}\n{row}\n")
    return str(path)


def test_annotation_files(spark, folder):
    table = source.read_annotation_csv(spark, annotation_folder(folder))
    got = sorted(
        (os.path.basename(r.annotation_file_name), r.annotation_row, r.sector, r.annotator, r.answer)
        for r in table.collect()
    )
    assert got == [
        ("annotation_two.csv", 0, None, "me", "two\nlines"),
        ("one annotation.csv", 0, "OG", "one annotation.csv", "two\nlines"),
        ("one annotation.csv", 1, "CM", "one annotation.csv", "two\nlines"),
    ]
    assert table.first().relevant_paragraphs == '["p", "q"]'


def test_files_of_equal_names_are_told_apart(spark, folder):
    for place in ("one", "two"):
        Path(folder, place).mkdir()
        Path(folder, place, "annotation.csv").write_text(f"{HEADER}\n{place},a.pdf,[1],2,2016,x,TEXT,y\n")
    table = source.read_annotation_csv(spark, f"{folder}/*").collect()
    assert sorted((r.company, r.annotation_row, r.annotator) for r in table) == [
        ("one", 0, "annotation.csv"), ("two", 0, "annotation.csv")
    ]
    assert len({r.annotation_file_name for r in table}) == 2


def test_aggregate_is_saved_and_used_again(spark, folder):
    mapping = read_kpi_mapping(spark, mapping_file(folder))
    saved = f"{folder}/saved.parquet"
    first = source.read_aggregated(spark, saved, annotation_folder(folder), mapping)
    assert first.count() == 3 and os.path.isdir(saved)
    again = source.read_aggregated(spark, saved, f"{folder}/nowhere", mapping)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, first.collect()))


def test_annotation_parquet_rows_are_numbered(spark, rows, folder):
    names = HEADER.split(",")
    frame = rows(", ".join(f"{n} string" for n in names), *[tuple([str(i)] * 8) for i in range(5)])
    frame.coalesce(1).write.parquet(f"{folder}/raw")
    target = Path(folder, "tables")
    target.mkdir()
    part = next(Path(folder, "raw").glob("*.parquet"))
    (target / "annotation.parquet").write_bytes(part.read_bytes())
    got = source.read_annotation_parquet(spark, str(target)).orderBy("annotation_row").collect()
    assert [(r.annotation_row, r.company) for r in got] == [(i, str(i)) for i in range(5)]
    assert {r.annotator for r in got} == {"annotation.parquet"}


def test_annotations_of_every_format(spark, rows, folder):
    names = HEADER.split(",")
    good = rows(", ".join(f"{n} string" for n in names), *[tuple(str(i) * 8) for i in range(2)])
    bad = rows("company string, year string, note string", ("c", "2016", "x"))
    target = Path(folder, "tables")
    target.mkdir()
    for name, frame in (("good annotation", good), ("annotation_bad", bad)):
        frame.coalesce(1).write.parquet(f"{folder}/{name}")
        part = next(Path(folder, name).glob("part-*.parquet"))
        (target / f"{name}.parquet").write_bytes(part.read_bytes())
    lines = [dict.fromkeys(names, "a") | {"sector": "OG"}, dict.fromkeys(names, "b") | {"annotator": "me"}]
    (target / "annotation.json").write_text("\n".join(map(json.dumps, lines)))
    (target / "annotation_other.json").write_text(json.dumps({"company": "c"}))
    (target / "annotation.csv").write_text(f"{HEADER}\n" + ",".join("z" * 8) + "\n")
    got = {
        (os.path.basename(r.annotation_file_name), r.annotation_row, r.company, r.annotator, r.sector)
        for r in source.read_annotations(spark, str(target)).collect()
    }
    assert got == {
        ("good annotation.parquet", 0, "0", "good annotation.parquet", None),
        ("good annotation.parquet", 1, "1", "good annotation.parquet", None),
        ("annotation.json", 0, "a", "annotation.json", "OG"),
        ("annotation.json", 1, "b", "me", None),
        ("annotation.csv", 0, "z", "annotation.csv", None),
    }


def test_extraction_of_files_with_its_report(spark, rows):
    files = rows("file_name string, length long", ("a.pdf", 1), ("b.docx", 1), ("c.PDF", 1), ("d.pdf", 1))
    text = "a paragraph that is long enough\n\nanother one that is long enough\n\nshort"
    pages = rows("pdf_name string, page int, text string", ("a.pdf", 0, text), ("b.docx", 0, text), ("c.PDF", 0, "x"))
    paragraphs, report = extract_files(files, pages)
    assert [r.unique_paragraph_id for r in paragraphs.orderBy("unique_paragraph_id").collect()] == [0, 1]
    got = {r.pdf_name: (r.supported, r.n_paragraphs, r.extracted) for r in report.collect()}
    assert got == {
        "a.pdf": (True, 2, True), "b.docx": (False, 0, False), "c.PDF": (True, 0, False), "d.pdf": (True, 0, False)
    }


def test_listing(spark, folder):
    for name in ("a.PDF", "b.docx", "c"):
        Path(folder, name).write_text("x")
    got = {r.file_name: (r.suffix, r.supported) for r in route_by_suffix(list_files(spark, folder)).collect()}
    assert got == {"a.PDF": (".pdf", True), "b.docx": (".docx", False), "c": ("", False)}


def test_exports(spark, rows, folder):
    schema = "source_file string, paragraph string, question string, answer string, answer_start array<int>"
    train = rows(schema, ("a.pdf", "p", "q", "a", [1, 2]))
    val = rows(schema, ("b.pdf", "p", "q", "", [-1]))
    paths = write_train_val(train, val, folder, date(2024, 2, 1))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["train_kpi_data_01-02-2024", "val_kpi_data_01-02-2024"]
    got = spark.read.json(paths[0]).first()
    assert (got.context, got.annotation_answer, got.answer_start) == ("p", "a", [1, 2])
    path = write_relevance(rows("source_page array<string>, label int", (["0", "1"], 1)), folder, "x")
    assert spark.read.csv(path, header=True, escape='"').first().source_page == '["0","1"]'


def test_relevance_scores(spark, folder):
    Path(folder, "scores.csv").write_text(
        "extra,kpi_id,page,pdf_name,unique_paragraph_id,paragraph,question,"
        "paragraph_relevance_flag,paragraph_relevance_score(for_label=1)\n"
        'x,2.1,3,a.pdf,7,"(Some) Text\nhere",Who?,1,0.9\n'
    )
    got = read_relevance_scores(spark, f"{folder}/scores.csv").first()
    assert tuple(got) == (3, "a.pdf", 7, "some text here", 2.1, "Who?", 1, 0.9)
    Path(folder, "bad.csv").write_text("page,pdf_name\n1,a.pdf\n")
    try:
        read_relevance_scores(spark, f"{folder}/bad.csv")
    except ValueError as error:
        assert "kpi_id" in str(error)
    else:
        raise AssertionError("missing columns must be refused")
