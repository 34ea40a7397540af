import random
import re

import pytest
from pyspark.sql import functions as F

from folioforge.functions import literals, text
from folioforge.functions.answers import answer_offsets, shifted_offsets, shifted_paragraph
from folioforge.functions.questions import question_in_year
from folioforge.functions.similarity import fuzzy_ratio, lcs_length


def apply(spark, function, *values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r.y for r in frame.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]


def test_clean_page_text(spark):
    assert apply(
        spark,
        text.clean_page_text,
        "[“a”] b|c\n\td",
        "café  au\x07 lait",
        "“kept” too",
        "  wide  gap",
        " edge ",
    ) == ['["a"] bc d', "caf au lait", "“kept” too", " wide gap", " edge "]


def test_clean_qa_text(spark):
    assert apply(spark, text.clean_qa_text, "[“A”] “B” (c)?", "x\ty\nz", "end... a.b", "a  (  b") == [
        '"a" b c',
        "x\ty z",
        "end a.b",
        "a  b",
    ]


def test_clean_relevance_text(spark):
    assert apply(spark, text.clean_relevance_text, None, "", "“q” 10 BOE\\ é\n\nx") == [
        "",
        "",
        '"q" 10  x',
    ]


def test_names_and_counts(spark):
    assert apply(
        spark, text.normalise_pdf_name, "a.pdf", "a,pdf", " a ", "a.pdf ", "a.pdf.pdf"
    ) == ["a.pdf", "a.pdf", "a.pdf", "a.pdf.pdf", "a.pdf"]
    assert apply(spark, text.alnum_count, "a1 é-ß!", "...") == [4, 0]
    assert apply(spark, text.words, "A bb_1 Café x", "") == [["bb_1", "café"], []]
    assert apply(spark, text.single_line, " a\nb \n") == ["a b"]


def test_page_lists(spark):
    assert apply(spark, literals.parse_page_list, "[1, 2]", "3", "[1", "[]", "[a]", "[") == [
        ["1", "2"],
        None,
        None,
        None,
        None,
        None,
    ]
    assert apply(spark, literals.pages_zero_based, "[1, 12]", "3", "x") == [["0", "11"], None, None]
    assert apply(spark, literals.zero_based_page_key, "7", "x") == ["6", None]


def test_parse_passages(spark):
    assert apply(
        spark,
        literals.parse_passages,
        '["a", "b"]',
        "['a',]",
        '"one"',
        "12",
        '["a"',
        "[]",
        "word",
        None,
        '{"text"}',
        '("a", "b")',
        '{"a": 1}',
        "()",
        '{"a"]',
        '("a" "b"',
    ) == [
        ["a", "b"], ["a"], ['"one"'], ["12"], None, None, None, None,
        ['{"text"}'], ['("a", "b")'], ['{"a": 1}'], ["()"], None, None,
    ]


def test_split_passages(spark):
    assert apply(
        spark,
        literals.split_passages,
        '["a", "b","c"]',
        '{"a"]',
        '["a"}',
        '["a"[',
        "plain",
        ' ["a"] ',
        '{"a"}',
    ) == [["a", "b", "c"], ["a"], ["a"], ["a"], None, ["a"], None]


def expected_offsets(answer, par):
    answer = answer.replace(".", r"\.")
    if answer.isnumeric():
        one = [m.start() + 1 for m in re.finditer(f"[^0-9]{answer}", par)]
        two = [m.start() for m in re.finditer(f"{answer}[^0-9]", par)]
        return sorted(set(one + two))
    return [m.start() for m in re.finditer(answer, par)]


def test_answer_offsets_against_rule(spark):
    pick = random.Random(3)
    cases = [("", "ab"), ("11", " 111 "), ("2", "2"), ("2", "a 2016"), ("0", "2016"), ("a.b", "a.b axb")]
    for _ in range(1500):
        letters = pick.choice(["12 a", "ab.", "1", "19-"])
        par = "".join(pick.choice(letters) for _ in range(pick.randint(0, 14)))
        answer = "".join(pick.choice(letters) for _ in range(pick.randint(0, 3)))
        cases.append((answer, par))
    frame = spark.createDataFrame(cases, "a string, p string").select(
        "a", "p", answer_offsets(F.col("a"), F.col("p")).alias("s")
    )
    for r in frame.collect():
        # a lone "." matches literally; Python's rule never sees other specials
        assert r.s == expected_offsets(r.a, r.p), (r.a, r.p)


def test_shift(rows):
    frame = rows("p string, s array<int>", ("ab", [0, 1]), ("ab", [1]), ("ab", []))
    got = frame.select(
        shifted_paragraph(F.col("p"), F.col("s")).alias("p"), shifted_offsets(F.col("s")).alias("s")
    ).collect()
    assert [tuple(r) for r in got] == [(" ab", [1, 2]), ("ab", [1]), ("ab", [])]


def test_question_in_year(rows):
    frame = rows(
        "q string, d boolean, y string",
        ("What? Why?", True, "2016.0"),
        ("What?", True, "FY20"),
        ("What?", False, "2016"),
    )
    got = frame.select(question_in_year(F.col("q"), F.col("d"), F.col("y")).alias("q")).collect()
    assert [r.q for r in got] == ["What in year 2016?", "What in year FY20?", "What?"]


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(max(new[-1], row[j], row[j - 1] + (x == y)))
        row = new
    return row[-1]


def test_bit_rows_against_tables():
    pick = random.Random(1)
    for _ in range(2000):
        a, b = ("".join(pick.choice("abcé") for _ in range(pick.randint(0, 20))) for _ in "ab")
        assert lcs_length(a, b, {}) == plain_lcs(a, b)


def test_similarity_functions(rows):
    frame = rows("a string, b string", ("kitten", "sitting"), ("", ""), ("", "ab"), ("é", "é"))
    got = frame.select(fuzzy_ratio("a", "b").alias("r")).collect()
    assert [r.r for r in got] == pytest.approx([8 / 13, 1, 0, 1])
