"""Pivot clustering, periodic runs and token files against brute force, the library and round trips."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from folioforge.llm import periodic_runs, pivot_clusters, token_files
from folioforge.llm.elias_fano import EliasFano
from folioforge.llm.suffix_tree import SuffixTree
from folioforge.llm.vocabulary import default_path
from folioforge.session import new_folder

DOCS = "doc_id long, text string, code long, listed string, n long, a long, runs string, row long, digest long, ids string, part int"


def build(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2, 3, "r", 4, 5, "i", 6) for i, t in rows], DOCS)


# --- clusters ---

VECTORS = "vec_id long, embedding array<float>, q string, id long, away string, cluster string, distance string"


def _clusters_plainly(rows, rounds=3, clusters=16):
    kept = [
        (i, [int(np.floor(64 * float(np.float32(x)))) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)
    ]
    first = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), q) for i, q in kept)
    centroids = [q for _, q in first[:clusters]]

    def assign():
        out = []
        for _, q in kept:
            squares = [sum((a - b) ** 2 for a, b in zip(q, c)) for c in centroids]
            out.append((squares.index(min(squares)), min(squares)))
        return out

    for _ in range(rounds):
        members = {}
        for (_, q), (c, _) in zip(kept, assign()):
            members.setdefault(c, []).append(q)
        for c, qs in members.items():
            centroids[c] = [sum(x) // len(qs) for x in zip(*qs)]
    last = assign()
    inertia, total = {}, sum(d for _, d in last)
    for c, d in last:
        inertia[c] = inertia.get(c, 0) + d
    code = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, d, inertia[c], total, code[c]) for (i, _), (c, d) in zip(kept, last)]


def _order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, *[str(x) for x in r]))


def _vectors(seed, n, groups=20):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(groups, 64)) * 2
    return [(i, (centres[i % groups] + draw.normal(size=64) * 0.2).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("n", [0, 5, 400])
def test_clusters_by_brute_force(spark, n):
    rows = _vectors(1, n)
    if n > 5:  # ties, copies, repeated and null ids, and vectors that take no part
        rows += [(i, rows[0][1]) for i in range(400, 460)] + [(7, rows[9][1]), (7, rows[7][1]), (None, rows[3][1])]
        odd = [None, [], [1.0] * 63, [1.0] * 65, [None] + [0.0] * 63, [float("nan")] * 64, [float("inf")] + [0.0] * 63]
        rows += [(1000 + i, v) for i, v in enumerate(odd)]
    data = spark.createDataFrame([(i, v, "q", 1, "a", "c", "d") for i, v in rows], VECTORS).repartition(3)
    got = pivot_clusters.cluster_digests(pivot_clusters.cluster(data))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert _order(map(tuple, got.collect())) == _order(_clusters_plainly(rows))


def test_pivots_spare_distances():
    rows = np.array([np.floor(64 * np.array(v)) for _, v in _vectors(2, 2000)], np.int64)
    centroids, pivots = rows[:16], pivot_clusters.spread(rows[:256], 8)
    away = np.sqrt(((rows[:, None] - pivots[None]) ** 2).sum(axis=2))
    number, distance, measured = pivot_clusters.nearest(rows, away, centroids, pivots)
    squares = ((rows[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (number == squares.argmin(axis=1)).all() and (distance == squares.min(axis=1)).all()
    assert measured < 0.4 * squares.size


def test_vectors_too_large_are_refused(spark):
    data = spark.createDataFrame([(1, [3e30] + [0.0] * 63)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="or more"):
        pivot_clusters.cluster(data).collect()


# --- periodic runs ---


def _runs_plainly(words):
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length, run = j - i + q, words[i : j + q]
            least = next(d for d in range(1, q + 1) if all(run[k] == run[k + d] for k in range(length - d)))
            if length >= max(24, 3 * q) and least == q:
                found.append((i, q, length))
            i = j + 1
    return sorted(found)


def _cycled_plainly(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _run_row(doc_id, text):
    words = _cycled_plainly(doc_id, (text or "").encode().split())
    runs = _runs_plainly(words)
    best = min(runs, key=lambda r: (-r[2] / r[1], r[0], r[1])) if runs else None
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, q, n in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    figures = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    return (doc_id, len(runs), *figures, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def _periodic_texts():
    draw = random.Random(3)
    texts = []
    for i in range(150):
        words = [f"w{draw.randrange(draw.choice([1, 2, 3, 300]))}" for _ in range(draw.randint(0, 150))]
        if i % 3 == 0 and len(words) > 40:
            p, a = draw.randint(1, 12), draw.randrange(len(words) - 30)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, len(words))] + words[:20]
        texts.append(draw.choice([" ", "\n", "\t ", "\x0b"]).join(words))
    return texts + [None, "", " \n ", "same " * 400, "ä b c " * 30, "x y " * 12, "x y " * 11 + "x"]


def test_runs_by_brute_force(spark):
    rows = list(enumerate(_periodic_texts())) + [(None, "a b c " * 9), (3, "a a " * 40), (3, "a a " * 40)]
    docs = periodic_runs.with_cycles(build(spark, rows))
    assert docs.columns == build(spark, []).columns
    got = periodic_runs.run_digests(periodic_runs.collapse_runs(docs)).collect()
    want = [_run_row(i, t) for i, t in rows]
    assert _order(map(tuple, got)) == _order(want) and sum(r[1] > 0 for r in want) > 30
    assert sum(1 for (i, t), r in zip(rows, want) if i is not None and zlib.crc32(str(i).encode()) % 10 == 0 and r[1]) > 5


def test_runs_of_a_long_text(spark):
    draw = random.Random(8)
    period = [f"w{draw.randrange(500)}" for _ in range(9000)]
    words = ["before", *(period * 4)[:30_000], "after"]
    (row,) = periodic_runs.collapse_runs(build(spark, [(1, " ".join(words))])).collect()
    assert [tuple(r) for r in row.runs] == [(1, 30_000, 9000)] and row.collapsed.split() == ["before", *period, "after"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=60))
def test_suffix_tree(numbers):
    tree, n = SuffixTree(np.array(numbers)), len(numbers)
    assert tree.order.tolist() == sorted(range(n + 1), key=lambda i: numbers[i:])
    falling = sorted(range(n + 1), key=lambda i: [-x for x in numbers[i:]])
    assert np.argsort(tree.falling_rank()).tolist() == falling
    a, b = (x.ravel() for x in np.meshgrid(np.arange(n + 1), np.arange(n + 1)))
    a, b = a[a != b], b[a != b]
    shared = [next((k for k in range(n) if numbers[i + k : i + k + 1] != numbers[j + k : j + k + 1] or i + k >= n), n) for i, j in zip(a, b)]
    assert tree.common(a, b).tolist() == shared


def test_runs_never_leave_their_stretch():
    draw = random.Random(5)
    for _ in range(200):
        numbers = np.array([draw.randrange(2) for _ in range(draw.randint(24, 90))])
        whole = [tuple(r) for r in periodic_runs.runs_of(numbers).tolist()]
        assert whole == _runs_plainly(numbers.tolist())
        assert whole == [tuple(r) for r in periodic_runs.runs_of_words([b"%d" % x for x in numbers]).tolist()]


# --- token files ---


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 50), max_size=200), st.integers(0, 40))
def test_rising_numbers_come_back(values, gap):
    numbers = np.sort(np.array(values, np.uint64))
    data = bytes(gap) + EliasFano.of(numbers).to_bytes()
    read, end = EliasFano.read(memoryview(data), gap)
    assert end == len(data) and (read.at(np.arange(len(numbers))) == numbers).all()
    assert (read.at(np.arange(len(numbers))[::-1]) == numbers[::-1]).all()


def test_rising_numbers_take_little_space():
    starts = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000).astype(np.uint64))
    assert 8 * len(EliasFano.of(starts).to_bytes()) < 100_000 * (np.log2(1000) + 3)


def _file_texts():
    odd = [None, "", "  \n", "Größe ΣΑΣ é é ẛ̣", "<|endoftext|> a<|startoftext|>b", "don't it's I'LL 1234 ½", "日本語 　 x y z"]
    draw = random.Random(2)
    return odd + ["".join(draw.choices("abAB é\n\t1.-'ßİſ\x1c\x85 ", k=draw.randint(1, 90))) for _ in range(120)] + ["word " * 30_000]


def _documents_plainly(rows):
    library = Tokenizer.from_file(default_path(token_files.VOCABULARY))
    coded = [(i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows]
    return {(i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in coded}, coded


@pytest.mark.parametrize("limits", [{}, {"file_ids": 64, "file_docs": 3, "task_bytes": 4096}])
def test_token_files_hold_the_ids_of_the_library(spark, limits):
    texts = _file_texts()
    rows = [(7 * i - 40, t) for i, t in enumerate(texts)] + [(None, "none"), (None, "none"), (2, "two a"), (2, "two b"), (2, "two a")]
    path = new_folder(spark)
    token_files.write_token_files(build(spark, rows).repartition(5), path, **limits)
    got = token_files.document_digests(token_files.read_token_files(spark, path)).collect()
    want, coded = _documents_plainly(rows)
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got} == want and len(got) == len(rows)
    got.sort(key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()


def test_no_documents_give_no_files(spark):
    path = new_folder(spark)
    token_files.write_token_files(build(spark, []), path)
    assert token_files.read_token_files(spark, path).count() == 0


def test_files_of_lost_tasks_are_not_read(spark):
    path = new_folder(spark)
    token_files.write_token_files(build(spark, [(1, "one"), (2, "two")]), path)
    with open(f"{path}/files/00000000-000009-left.ids", "wb") as left:
        left.write(token_files.file_bytes([9], [1], b"\2\0"))
    assert sorted(r.doc_id for r in token_files.read_token_files(spark, path).collect()) == [1, 2]


def test_a_file_opens_anywhere():
    file = token_files.TokenFile(token_files.file_bytes([None, None, -5, 9, 9], [1, 2, 3, 1, 2], np.arange(9, dtype="<u2").tobytes()))
    assert file.starts(np.arange(6)).tolist() == [0, 1, 3, 6, 7, 9] and file.starts(np.array([4, 2])).tolist() == [7, 3]
    assert file.doc_ids(0, 5) == [None, None, -5, 9, 9] and file.doc_ids(3, 5) == [9, 9] and file.doc_ids(1, 2) == [None]
    assert file.ids(3, 6).tolist() == [3, 4, 5]
