"""Operators over whole tables against brute force."""

import collections
import hashlib
import itertools
import math
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from folioforge.llm import chat, mixing, queries, simhash, suffix_dedup, topk
from folioforge.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, key string, place string"


def build(spark, texts, source=lambda i: f"s{i % 4}"):
    rows = [(i, t, "en", source(i), None if t is None else len(t), "f", "k", "p") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(seed, n, size=60):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choices("abcdefgh", k=draw.randint(1, 6))) for _ in range(400)]
    return [" ".join(draw.choices(vocabulary, k=size)) for _ in range(n)]


def _roots(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def _plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def _near_copies():
    texts = prose(4, 25, 400)
    draw = random.Random(5)
    for t in list(texts[:8]):
        for _ in range(4):
            w = t.split()
            w[draw.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    return texts + [None, "", "  ", "One", "two words", texts[3], texts[3], texts[0].upper(), "ÄB c " * 3000]


def test_near_duplicates_by_brute_force(spark):
    texts = _near_copies()
    fps = [_plain_fingerprint(t) for t in texts]
    links = [(a, b) for a, b in itertools.combinations(range(len(fps)), 2) if (fps[a] ^ fps[b]).bit_count() <= 3]
    roots = _roots(len(fps), links)
    got = {r.doc_id: r for r in simhash.near_duplicate_classes(build(spark, texts)).collect()}
    assert len(got) == len(texts) and len(set(roots)) < len(texts) - 10
    for i in range(len(texts)):
        assert (got[i].fingerprint, got[i].component_id) == (f"{fps[i]:016x}", roots[i])
    kept = simhash.keep_one_per_class(build(spark, texts).unionAll(build(spark, texts).where("doc_id < 3")))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots)) and kept.columns == build(spark, []).columns


@pytest.mark.parametrize("block", [2, 512])
def test_links_of_fingerprints(spark, block):
    draw = random.Random(6)
    fps = {draw.getrandbits(64) for _ in range(300)}
    for f in list(fps)[:60]:
        for _ in range(5):
            for b in draw.sample(range(64), draw.randint(1, 4)):
                f ^= 1 << b
            fps.add(f)
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    links = [(a, b) for a, b in itertools.combinations(range(len(signed)), 2) if ((signed[a] ^ signed[b]) % (1 << 64)).bit_count() <= 3]
    want = _roots(len(signed), links)
    rows = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = simhash.fingerprint_links(rows, block).collect()
    index = {f: i for i, f in enumerate(signed)}
    assert _roots(len(signed), [(index[r.a], index[r.b]) for r in found]) == want
    whole = {r.node: r.root for r in connected_components(simhash.fingerprint_links(rows, block)).collect()}
    assert [index[whole.get(f, f)] for f in signed] == want


def test_near_duplicates_of_nothing_and_of_null_ids(spark):
    assert simhash.near_duplicate_classes(build(spark, [])).count() == 0
    assert simhash.keep_one_per_class(build(spark, [])).count() == 0
    text = prose(8, 1)[0]
    rows = [(None, text, *"abcde"[:1], "s", 1, "f", "k", "p"), (None, text, "a", "s", 1, "f", "k", "p")]
    assert simhash.keep_one_per_class(spark.createDataFrame(rows, DOCS)).count() == 1


def _best(vectors, every, top):
    q = {i: [math.floor(256 * x) for x in v] for i, v in vectors}
    out = {}
    for a in q:
        if a % every == 0:
            rest = sorted((-sum(x * y for x, y in zip(q[a], q[b])), b) for b in q if b != a and len(q[a]) == len(q[b]))
            out.update({(a, r + 1): (b, -s) for r, (s, b) in enumerate(rest[:top])})
    return out


def test_top_k_by_brute_force(spark):
    draw = np.random.default_rng(1)
    vectors = [(i, draw.normal(0, 0.125, 16).round(3).tolist()) for i in range(400)]
    vectors += [(1000 + i, vectors[50][1]) for i in range(20)] + [(2000, [0.0] * 16), (2050, [3.0, -2.5]), (2051, [1.0, 1.0]), (2100, [])]
    bad = [(3000, None), (3050, [float("nan")] * 16), (3100, [None] * 16), (3150, [float("inf")] * 16), (None, [0.5] * 16)]
    rows = spark.createDataFrame([*vectors, *bad], "vec_id long, embedding array<double>")
    want = _best(vectors, 50, 5)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_neighbours(rows).collect()}
    assert got == want
    q = rows.where(topk.usable(rows.embedding)).select("vec_id", topk.quantised(rows.embedding).alias("q"))
    small = topk.top_inner_products(q.where("vec_id % 50 = 0"), q, 5, block_rows=37, lanes=2)
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in small.collect()} == want
    assert topk.top_neighbours(rows.limit(0)).count() == 0


def test_top_k_with_repeated_ids_equals_the_sql(spark):
    draw = np.random.default_rng(2)
    vectors = [(i, draw.normal(0, 0.125, 8).round(3).tolist()) for i in range(160)]
    vectors += [(i, draw.normal(0, 0.2, 8).round(3).tolist()) for i in (7, 7, 50, 50, 50, 100)]
    vectors += [vectors[7]] * 9 + [vectors[50]] * 9 + [(None, vectors[3][1])]
    rows = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in vectors], "vec_id long, embedding array<double>, q string, dims int, n int")
    embeddings = rows.toPandas()  # noqa: F841, read by the SQL
    want = duckdb.sql(queries.oracle_sql()["op2_bit_sliced_top_k"]).fetchall()
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_neighbours(rows).collect()]
    assert sorted(got) == sorted((q, r, v, s) for q, r, v, s in want) and len(got) == 20


def test_top_k_holds_a_block_and_some_queries_at_a_time(spark, monkeypatch):
    """No row of the plan holds a block, and lanes of few queries give the same rows."""
    monkeypatch.setattr(topk, "LANE_QUERIES", 3)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 2)
    draw = np.random.default_rng(3)
    vectors = [(i, draw.normal(0, 0.125, 8).round(3).tolist()) for i in range(300)]
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    q = rows.select("vec_id", topk.quantised(rows.embedding).alias("q"))
    found = topk.top_inner_products(q.where("vec_id % 10 = 0"), q, 5, block_rows=50, lanes=1)
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in found.collect()} == _best(vectors, 10, 5)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroupsInArrow" in plan and "collect_list" not in plan


def test_top_k_refuses_components_that_do_not_fit(spark):
    rows = spark.createDataFrame([(0, [1e18]), (1, [0.5]), (2, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="or more"):
        topk.top_neighbours(rows).collect()


def _repair_cost(roles):
    """Shortest path over single steps: insert an empty turn, or take the next turn."""
    follows = {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    best = {("", 0): 0}
    edge = [("", 0)]
    while edge:
        state, i = edge.pop()
        steps = [((then, i), chat.INSERT) for then in follows[state]]
        if i < len(roles):
            steps += [((then, i + 1), 0 if then == roles[i] else chat.RELABEL) for then in follows[state]]
            if state:
                steps.append(((state, i + 1), chat.MERGE_SAME if state == roles[i] else chat.MERGE_OTHER))
        for node, cost in steps:
            if best[state, i] + cost < best.get(node, 1 << 30):
                best[node] = best[state, i] + cost
                edge.append(node)
    return best["assistant", len(roles)]


def test_role_repair_is_cheapest_and_legal(spark, monkeypatch):
    monkeypatch.setattr(chat, "_BITS", 2)  # short stretches, so that many are joined
    draw = random.Random(7)
    names = ["system", "user", "assistant", "tool", None]
    conversations = {c: draw.choices(names, [1, 5, 5, 1, 1], k=draw.randint(1, 40)) for c in range(60)}
    conversations[60] = ["user", "assistant"] * 300
    rows = [(c, i, r, f"t{i}", "x", 1) for c, roles in conversations.items() for i, r in enumerate(roles)]
    rows += [(None, 0, "USER ", None, "x", 1), (None, None, "assistant", "last", "x", 1)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq string, cost int").repartition(5)
    got = collections.defaultdict(list)
    for r in chat.repaired_turns(frame).collect():
        got[r.conv_id].append(r)
    assert len(got) == 62
    for c, turns in got.items():
        turns.sort(key=lambda r: r.position)
        assert [r.position for r in turns] == list(range(1, len(turns) + 1))
        whole = "".join(r.rendered for r in turns)
        roles = re.findall(r"<\|im_start\|>(\w+)\n", whole)
        assert re.fullmatch("s?(ua)+", "".join(r[0] for r in roles))
        if c is not None:
            assert [r.turn for r in turns] == list(range(len(turns)))
            assert re.findall(r"t\d+", whole) == [f"t{i}" for i in range(len(turns))]
            assert {r.cost for r in turns} == {_repair_cost(conversations[c])}
    assert "".join(r.rendered for r in got[None]) == "<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\nlast<|im_end|>\n"
    assert chat.repaired_turns(frame.limit(0)).count() == 0


def _targets(sizes, most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > most * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        target |= {s: float(most * sizes[s]) for s in over}
        left, free = left - sum(most * sizes[s] for s in over), free - over
    return target


def test_mixing_by_brute_force(spark):
    draw = random.Random(10)
    texts = [" ".join(["w1"] * draw.randint(1, 90)) for _ in range(600)] + [None, "", "# # #"]
    names = ["a", "a", "a", "a", "a", "b", "ß", "c", None, "tiny"]
    rows = build(spark, texts, lambda i: names[i % 10] if i % 10 < 9 or i < 30 else "a")
    got = mixing.mix(rows).collect()
    assert len(got) == len(texts)
    sizes, taken = collections.Counter(), collections.Counter()
    for r in got:
        assert r.size == len((texts[r.doc_id] or "").split()) and r.taken == r.copies * r.size <= 3 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    targets = _targets(sizes)
    for r in got:
        assert r.target == pytest.approx(targets[r.source]) and r.source_size == sizes[r.source]
    assert all(abs(taken[s] - targets[s]) <= 45.5 for s in sizes)
    for s in sizes:  # complete epochs first, then by key
        copies = {r.copies for r in got if r.source == s and r.size}
        assert max(copies) - min(copies) <= 1
    assert {(r.doc_id, r.taken) for r in mixing.mix(rows.repartition(7)).collect()} == {(r.doc_id, r.taken) for r in got}
    times = collections.Counter(r.doc_id for r in mixing.mixed_documents(rows).collect())
    assert times == {r.doc_id: r.copies for r in got if r.copies}
    assert mixing.mix(rows.limit(0)).count() == 0 and mixing.mixed_documents(rows.limit(0)).columns == rows.columns


def _repeats_plainly(texts, length=400):
    octets = [(t or "").encode() for t in texts]
    seen = collections.Counter(o[i : i + length] for o in octets for i in range(len(o) - length + 1))
    out = []
    for o in octets:
        gone = np.zeros(len(o), bool)
        for i in range(len(o) - length + 1):
            if seen[o[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(o, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(o), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_by_brute_force(spark):
    draw = random.Random(12)
    texts = prose(13, 12, 400)
    passage = prose(14, 3, 150)
    for i in range(12):
        p = passage[i % 3]
        low = draw.randint(0, 60)
        texts.append(texts[i][: draw.randint(0, 700)] + p[low : low + draw.choice([399, 400, 401, 415, 416, 470])] + prose(30 + i, 1, 60)[0])
    near = list(texts[5])
    near[700] = "#"
    texts += ["".join(near), "".join(near[:300]), texts[2], texts[2], "a" * 1500, "ab " * 500, passage[0] + passage[0], "é" * 450]
    texts += [None, "", "x" * 399, "x" * 399, prose(15, 1, 50)[0] + passage[1][:402] + "tail"]
    frame = build(spark, texts)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(frame.repartition(4)).collect()}
    want = _repeats_plainly(texts)
    assert len(got) == len(texts)
    for i, row in enumerate(want):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == row, (i, row, r)
    assert suffix_dedup.remove_repeats(frame.limit(0)).count() == 0


def test_anchors_do_not_depend_on_the_step(monkeypatch):
    octets = np.frombuffer(" ".join(prose(16, 4, 900)).encode() + b"z" * 2000, np.uint8)
    whole = suffix_dedup.anchors(octets)
    monkeypatch.setattr(suffix_dedup, "_STEP", 701)
    parts = suffix_dedup.anchors(octets)
    assert all((whole[k] == parts[k]).all() for k in whole)
    covered = sum(whole["last"] - whole["first"] + 1)
    assert covered == len(octets) - 399


def test_copies_of_one_text_are_dealt_over_tasks(spark, folder):
    shared = prose(17, 1, 150)[0]
    texts = [*(f"{t} {shared}" for t in prose(19, 300, 120)), *prose(18, 1, 120) * 1500]
    build(spark, texts).repartition(12).write.parquet(folder + "/documents.parquet")
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "8k",
        "spark.sql.files.maxPartitionBytes": "8k",
        "spark.sql.files.openCostInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = suffix_dedup.remove_repeats(spark.read.parquet(folder + "/documents.parquet"))
        got = rows.withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(got) == 1800 and all(r.n_kept == 0 if r.doc_id >= 300 else 0 < r.n_kept <= r.n_bytes - len(shared) for r in got)
    assert max(collections.Counter(r.task for r in got if r.doc_id >= 300).values()) <= 750


def test_pipeline_stages(spark, folder):
    good = [" ".join(prose(20 + i, 1, 120)) for i in range(30)]
    texts = [*good, good[0], good[1] + " extra", "| x%% " * 80, "short", None, prose(77, 1, 120)[0] + ' token = "' + "0a" * 20 + '"']
    docs = build(spark, texts).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, 0) for i in [*range(30), 35]], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, folder)
        assert now.columns == docs.columns, name
        rows = {r.doc_id: r for r in now.collect()}
        assert not rows.keys() & {32, 33, 34}, name
        if name != "quality rules":
            assert not rows.keys() & {30}, name
        if name == "secret scans":
            assert {*range(2, 30), 35} <= rows.keys() and rows[35].text.endswith('[SECRET]"') and all("0a0a" not in r.text for r in rows.values())
            assert all(r.n_chars == len(r.text) for r in rows.values())
    out = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "ids", "n_tokens"} <= set(out.columns) and out.count() > 0


def test_pipeline_takes_empty_tables_and_nulls(spark, folder):
    nothing = (None,) * 5
    good = " ".join(prose(50, 1, 120))
    rows = [nothing, nothing, (None, good, None, None, None), (None, good, None, None, None), (7, good + " end", None, None, 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    labels = spark.createDataFrame([(7, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    for name, documents in (("some", rows), ("none", [])):
        spark.createDataFrame(documents, schema).write.parquet(f"{folder}/{name}/documents.parquet")
        labels.write.parquet(f"{folder}/{name}/labels.parquet")
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, f"{folder}/some")
        assert out.count() >= 1, name
    assert corpus_pipeline.run(spark, f"{folder}/some").count() >= 1
