"""Row-wise operators against the libraries and against plain Python."""

import collections
import hashlib
import random
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folioforge.llm import bpe_codec, pairwise, quality_rules, secret_scan, token_counts
from folioforge.llm.automata import Automaton, shape
from folioforge.llm.common import table
from folioforge.llm.vocabulary import default_path, load

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, row string, fp string"
EDGES = [
    None, "", " \n\t ", "x", "Ääß Σίσυφος İstanbul", "<|endoftext|>a<|endoftext|>", "don't it'll 12345 !!??",
    "=" * 5000, "ab" * 4000, "word " * 300, "tab\x0bseparated\x1cnot here", "🙂🙂 é ‍",
]


def build(spark, texts, first=0):
    rows = [(first + i, t, "en", "s", None if t is None else len(t), "w", "r", "f") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed, n, size=60):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choices("abcdefgh", k=draw.randint(1, 5))) for _ in range(200)]
    return [" ".join(draw.choices(vocabulary, k=size)) for _ in range(n)]


def test_encoding_equals_the_library(spark):
    tokenizer = Tokenizer.from_file(default_path(bpe_codec.VOCABULARY))
    texts = EDGES + prose(1, 5)
    got = {r.doc_id: r for r in bpe_codec.encoding_digests(build(spark, texts)).collect()}
    for i, text in enumerate(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        back = tokenizer.decode(ids, skip_special_tokens=False)
        assert got[i].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


@pytest.mark.parametrize("alphabet", ["a", "ab", "aab", "etaoinshr", "=-", "0123456789", "éà中"])
def test_tree_concatenation_is_exact(alphabet):
    vocabulary = load(default_path(bpe_codec.VOCABULARY))
    draw = random.Random(alphabet)
    for leaf in (4, 16, 256):
        encoder = bpe_codec.Encoder(vocabulary, leaf)
        for _ in range(40):
            symbols = vocabulary.in_symbols("".join(draw.choices(alphabet, k=draw.randint(1, 700))))
            assert [i for i, _ in encoder.tree(symbols)] == [t.id for t in vocabulary.tokenizer.model.tokenize(symbols)]


def test_long_pieces_are_dealt_out_in_shares(spark):
    """Unsplit pieces longer than a share are joined over rounds of rows, with the library's ids."""
    tokenizer = Tokenizer.from_file(default_path(bpe_codec.VOCABULARY))
    draw = random.Random(8)
    long = lambda letters, n: "".join(draw.choices(letters, k=n))
    texts = [
        long("abcdefgh", 3_000),
        "short words, then " + long("etaoin", 900) + " and " + long("日本語é", 400) + " 12 " + long("01", 700),
        "a" * 2_000 + "<|endoftext|>" + "ab" * 700,
        "many short words " * 60,
        long(" ", 500) + long("xyz", 65),
        "x",
        "",
        None,
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    path = default_path(bpe_codec.VOCABULARY)
    parts = bpe_codec._in_parts(docs.where("octet_length(text) > 64"), path, 64)
    assert parts.where("part = 0").agg({"share": "max"}).first()[0] == 46
    got = bpe_codec.encode_documents(docs, share=64).collect()
    found = sorted((r.doc_id is None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist(), r.text) for r in got)
    expected = []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id is None, doc_id or 0, ids, tokenizer.decode(ids, skip_special_tokens=False)))
    assert found == sorted(expected)


def test_tree_is_entered_on_usual_words():
    vocabulary = load(default_path(bpe_codec.VOCABULARY))
    encoder, seen = bpe_codec.Encoder(vocabulary), []
    join = encoder._join
    encoder._join = lambda *a: seen.append(1) or join(*a)
    text = "an internationalisation of responsibilities"
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == vocabulary.tokenizer.encode(text).ids and seen


def test_counts_equal_the_library(spark):
    tokenizer = Tokenizer.from_file(default_path(token_counts.VOCABULARY))
    texts = EDGES + prose(2, 5) + ["word " * 3000]
    got = {r.doc_id: r for r in token_counts.token_counts(build(spark, texts)).collect()}
    for i, text in enumerate(texts):
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((text or "").encode()), n, n > 2048)


def test_row_operators_take_empty_tables(spark):
    none = build(spark, [])
    assert bpe_codec.encoding_digests(none).count() == token_counts.token_counts(none).count() == 0
    assert secret_scan.span_digests(secret_scan.secret_spans(none)).count() == 0
    assert quality_rules.judged(none, none.select("doc_id")).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert pairwise.quality_scores(none, pairwise.learn(none, labels)).count() == 0


def _grams(text):
    w = [x.encode() for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in w]
    hashes += [xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42)) for a, b in zip(w, w[1:])]
    return [h % quality_rules.BUCKETS if h < 1 << 63 else (h - (1 << 64)) % quality_rules.BUCKETS for h in hashes]


def test_quality_rules_by_brute_force(spark):
    import math

    texts = EDGES + prose(3, 30, 80) + ["a b c " * 40 + "d", "same line\nsame line\n \nother\nsame line", "| x1%% " * 60]
    texts += [texts[20], texts[20]]
    trusted = spark.createDataFrame([(i,) for i in range(12, 40)] + [(None,), (12,)], "doc_id long")
    raw, target = collections.Counter(), collections.Counter()
    for i, text in enumerate(texts):
        raw.update(_grams(text))
        if 12 <= i < 40:
            target.update(_grams(text))
    prior, share = quality_rules.PRIOR, sum(target.values()) / sum(raw.values())
    ratio = lambda g: math.log((target[g] + prior * share) / (raw[g] + prior)) - math.log(share)
    got = quality_rules.judged(build(spark, texts), trusted).select("row.doc_id", "*").collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r.doc_id] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = list(zip(w, w[1:], w[2:]))
        often = collections.Counter(windows)
        covered = {j for i, x in enumerate(windows) if often[x] > 1 for j in (i, i + 1, i + 2)}
        assert r.n_words == len(w) and r.word_chars == sum(map(len, w))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert r.n_dup_lines == len(lines) - len(set(lines)) and r.n_repeat_words == len(covered)
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        grams = _grams(text)
        score = sum(map(ratio, grams)) / max(1, len(grams))
        assert r.score == pytest.approx(score, abs=1e-9)
        assert r.kept == (not r.base_failed and r.score >= quality_rules.THRESHOLD)


def test_quality_rules_keep_good_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = table(spark, folder, "labels")
    judged = quality_rules.judged(table(spark, folder, "documents"), quality_rules.trusted_by_labels(labels))
    seen = judged.where("not base_failed").select("row.doc_id", "kept").join(labels, "doc_id")
    counts = {(r.quality, r.kept): r["count"] for r in seen.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) == 0 and counts.get((0, True), 0) <= 1


def test_documents_are_scored_by_the_counts_of_others(spark):
    import math

    texts = EDGES + prose(3, 30, 80) + ["a b c " * 40 + "d"]
    texts += [texts[20]]
    grams = [_grams(t) for t in texts]
    raw = collections.Counter(g for x in grams for g in x)
    target = collections.Counter(g for x in grams[12:30] for g in x)
    trusted = spark.createDataFrame([(i,) for i in range(12, 30)] + [(None,)], "doc_id long")
    got = quality_rules.judged(build(spark, texts), trusted, leave_out=True).collect()
    assert len(got) == len(texts) and got[0].row.asDict().keys() == set(build(spark, []).columns)
    for row in got:
        own = collections.Counter(grams[row.row.doc_id])
        r, t = raw.copy(), target.copy()
        r.subtract(own)
        if 12 <= row.row.doc_id < 30:
            t.subtract(own)
        share = sum(t.values()) / sum(r.values())
        ratio = lambda g: math.log((t[g] + quality_rules.PRIOR * share) / (r[g] + quality_rules.PRIOR) / share)
        assert row.score == pytest.approx(sum(n * ratio(g) for g, n in own.items()) / max(1, sum(own.values())), abs=1e-9)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_good_documents_outside_the_target_fare_like_those_in_it(spark, size):
    labels = table(spark, f"/root/testdata/{size}", "labels")
    trusted = quality_rules.trusted_by_labels(labels).where("doc_id % 2 = 0")
    judged = quality_rules.judged(table(spark, f"/root/testdata/{size}", "documents"), trusted, leave_out=True)
    good = judged.where("not base_failed").select("row.doc_id", "kept").join(labels.where("quality = 1"), "doc_id")
    kept = {r[0]: r[1] for r in good.groupBy(good.doc_id % 2).agg({"kept": "count_if", "*": "count"}).selectExpr(
        "`(doc_id % 2)`", "`count_if(kept)` / `count(1)`").collect()}
    assert kept[0] < 1 and abs(kept[0] - kept[1]) < 0.15


def test_target_is_counted_over_all_trusted_documents(spark):
    many = spark.range(20_500).selectExpr("id AS doc_id", "'w' || id AS text")
    ratios = quality_rules.ratio_table(many, many.select("doc_id")).first()["ratios"]
    assert max(map(abs, ratios)) < 1e-12  # target and corpus are the same
    few = build(spark, prose(5, 40))
    trusted = spark.createDataFrame([(i,) for i in range(0, 40, 3)] + [(None,)], "doc_id int")
    whole, sliced = (quality_rules.ratio_table(few, trusted, 64, n).first()["ratios"] for n in (100, 4))
    assert whole == pytest.approx(sliced, abs=1e-12) and max(map(abs, whole)) > 0


def _secrets_plainly(text):
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A | re.I):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_base_secrets_stay(spark):
    key = "0123456789abcdef" * 2
    texts = EDGES + [
        f'token = "{key}" and Password:hunter22x', "é AKIA" + "Z9" * 10 + " AKIAshort", "toKen=abc secret: 'abcdefg'",
        'password="token: abcdefgh', "apikey=aaaaaaa API_KEY = bbbbbbb ſecret=cccccccc", key + key,
    ]
    got = {r.doc_id: r for r in secret_scan.span_digests(secret_scan.secret_spans(build(spark, texts))).collect()}
    for i, text in enumerate(texts):
        base = _secrets_plainly(text or "")
        written = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert got[i].base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert set(written.split(",")) - {""} <= set(got[i].spans.split(","))
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(k == j for _, k, _ in base) for j in range(3)]


def test_inferred_formats_find_unnamed_secrets(spark):
    draw = random.Random(9)
    secret = lambda: "sk_" + "".join(draw.choices("0123456789ABCDEFGHIJKLMNOPQRSTUV", k=30))
    plain = lambda: "-".join("".join(draw.choices("abcdefghijklmnop", k=6)) for _ in range(4)) + "-2024"
    texts = [f"token={secret()} then {plain()}" for _ in range(300)]
    hidden, harmless = secret(), plain()
    texts += [f"look here {hidden} end", f"look here {harmless} end"]
    docs = build(spark, texts)
    got = {r.doc_id: r.spans for r in secret_scan.span_digests(secret_scan.secret_spans(docs)).collect()}
    assert got[300] == f"format:10:{10 + len(hidden)}" and got[301] == ""
    masked = {r.doc_id: r for r in secret_scan.mask_secrets(docs).collect()}
    assert masked[300].text == "look here [SECRET] end" and masked[300].n_chars == len(masked[300].text)
    assert masked[301].text == texts[301] and secret_scan.mask_secrets(docs).columns == docs.columns


def test_unnamed_secrets_among_clean_identifiers(spark):
    """Eight unnamed secrets of two labelled formats among 3,000 clean strings of six kinds: recall, false alarms."""
    draw = random.Random(17)
    text_of = lambda letters, n: "".join(draw.choices(letters, k=n))
    hexed = lambda: "a1" + text_of("0123456789abcdef", 16)
    coded = lambda: "key-" + text_of("ABCDEFGHJKLMNPQRSTUVWXYZ23456789", 18) + "7Q"
    clean = [
        lambda: text_of("abcdefghijklmnop", draw.randint(6, 14)),
        lambda: f"{draw.randint(1, 255)}.{draw.randint(1, 255)}.{draw.randint(1, 255)}.{draw.randint(1, 255)}",
        lambda: f"555-{draw.randint(1000, 9999)}",
        lambda: text_of("0123456789", 16),
        lambda: f"www.{text_of('abcdefg', 7)}.com/{text_of('hijkl', 6)}/{draw.randint(1, 99)}",
        lambda: f"Item{draw.randint(1, 99_999)}",
    ]
    texts = [f"secret={draw.choice([hexed, coded])()} {draw.choice(clean)()}" for _ in range(200)]
    hidden = [kind() for kind in (hexed, coded) for _ in range(4)]
    texts += [f"{draw.choice(clean)()} {value} {draw.choice(clean)()}." for value in hidden]
    texts += [" ".join(draw.choice(clean)() for _ in range(10)) for _ in range(300)] + ["", None]
    rows = secret_scan.secret_spans(build(spark, texts)).orderBy("doc_id").collect()
    found = [[texts[i][s.start : s.end] for s in r.found if s.kind == 3] for i, r in enumerate(rows)]
    right = sum(value in some for value, some in zip(hidden, found[200:208]))
    false = sum(map(len, found)) - right
    assert right == 8 and false == 0


def test_candidates_are_all_strings_outside_the_rules_spans():
    text = "x token=abcdefg/tail. path/to+it== short a.b.c.d. end"
    spans = secret_scan.base_spans(text)
    assert [text[a:b] for a, b in secret_scan.candidates(text, spans)] == ["path/to+it==", "a.b.c.d"]
    assert secret_scan.candidates("", []) == [] == secret_scan.candidates("......", [])


def test_no_labelled_credential_gives_no_format(spark):
    docs = build(spark, ["1beb58b8af68854f0e", "AKIA short", "", None])
    assert all(r.found == [] for r in secret_scan.secret_spans(docs).collect())


def test_automaton_tells_formats_apart():
    draw = random.Random(3)
    codes = ["".join(draw.choices("0123456789abcdef", k=16)) for _ in range(300)]
    automaton = Automaton([shape(c) for c in codes])
    assert automaton.states < 60
    assert automaton.log_likelihood(shape("0a1b2c3d4e5f6071")) > automaton.log_likelihood(shape("hello-world-text")) + 10


def test_pairwise_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = pairwise.quality_scores(docs, pairwise.learn(docs, labels))
    seen = scored.where("held_out").join(labels, "doc_id").select("quality", "score", "predicted").collect()
    good, poor = [r.score for r in seen if r.quality == 1], [r.score for r in seen if r.quality == 0]
    assert sum(a > b for a in good for b in poor) >= 0.98 * len(good) * len(poor)
    assert sum(r.quality == r.predicted for r in seen) >= 0.97 * len(seen)


def test_ids_with_both_labels_are_left_out(spark):
    docs = build(spark, prose(3, 60))
    labels = [(i, i % 2) for i in range(60)]
    both = labels + [(i, 1 - i % 2) for i in (1, 2, 3)]
    schema = "doc_id int, quality int"
    one, other = (
        pairwise.learn(docs, spark.createDataFrame(some, schema))
        for some in ([x for x in labels if x[0] not in (1, 2, 3)], both)
    )
    assert np.array_equal(one.weights, other.weights) and one.cut == other.cut


def test_pairwise_quality_without_labels_of_a_kind(spark):
    docs = build(spark, EDGES + EDGES)
    labels = spark.createDataFrame([(i, 1) for i in range(12)] + [(3, None), (None, 0)], "doc_id long, quality int")
    got = pairwise.quality_scores(docs, pairwise.learn(docs, labels)).collect()
    assert len(got) == 24 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)


def test_scoring_builds_no_state_for_each_ngram(spark):
    docs = build(spark, EDGES + ["a b a b a", "z " * 7])
    judged = quality_rules.judged(docs, docs.select("doc_id").where("doc_id % 2 = 0"), leave_out=True)
    plan = judged.select("score")._jdf.queryExecution().optimizedPlan().toString()
    folds = re.findall(r"aggregate\(.{0,200}", plan)
    assert folds and not any("struct" in fold for fold in folds)
    # runs of one and of many n-grams, and none
    assert [r.score is not None for r in judged.collect()] == [True] * docs.count()


def test_words_are_hashed_outside_array_functions_when_counted(spark):
    docs = build(spark, EDGES + ["a b a b a", "z " * 7])
    plan = quality_rules.count_table(docs, docs.select("doc_id"))._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan and "transform(" not in plan
    got = quality_rules.count_table(docs, docs.select("doc_id").where("doc_id >= 3")).first()
    grams = [_grams(t) for t in EDGES + ["a b a b a", "z " * 7]]
    raw, target = (collections.Counter(g for x in grams[k:] for g in x) for k in (0, 3))
    assert {x.bucket: (x.r, x.t) for x in got["each"] if x.r} == {g: (n, target[g]) for g, n in raw.items()}
    assert (got.all_r, got.all_t) == (sum(raw.values()), sum(target.values()))


def test_buckets_that_stand_once_are_not_cut_into_runs(spark):
    docs = build(spark, [" ".join(f"w{i}" for i in range(60)), "a b " * 30, "one", "", None])
    judged = quality_rules.judged(docs, docs.select("doc_id").where("doc_id < 2"), leave_out=True)
    plan = judged.select("score")._jdf.queryExecution().optimizedPlan().toString()
    # one fold over the buckets that stand once, another over the runs of the others
    assert "aggregate(zip_with" in plan and re.search(r"aggregate\((?!zip_with)", plan)
    assert [r.score is not None for r in judged.collect()] == [True] * 5


def test_windows_alike_in_their_first_bits_are_told_apart(spark):
    words = [f"w{i}" for i in range(300_000)]
    docs = build(spark, [" ".join([*words, *words[7:10]])])
    (row,) = quality_rules.measures(docs).select("n_words", "n_repeat_words", "hashes").collect()
    assert (row.n_words, row.n_repeat_words) == (300_003, 6)
    hashes = spark.createDataFrame([(row.hashes,)], "hashes array<long>")
    windows = hashes.select(quality_rules._windows(F.col("hashes")).alias("w"))
    alike = windows.selectExpr("explode(w) AS h").distinct().groupBy(F.shiftright("h", 31)).count().where("count > 1")
    assert alike.count() > 0
