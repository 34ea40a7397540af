"""Periodic runs of words by longest common extensions in suffix trees.

A run is a stretch of words that repeats a period, cannot be extended on either side, and is long
enough. Every run holds a Lyndon root: the longest Lyndon word that starts at its place, in the order
of the words or in the opposite one. So each place gives two candidates, from the next smaller suffix
in either order. The tree of the words extends a candidate to the right, the tree of the reversed words
to the left; both are Ukkonen's, with constant-time answers from their tours.

Every nine words of a run occur in it a second time, one period away. Trees are therefore grown only
over the stretches in which all nine-word windows repeat within the stretch itself; no run leaves one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import fresh, words
from folioforge.llm.suffix_tree import SuffixTree, next_smaller

LEAST_WORDS = 24
LEAST_REPEATS = 3
#: All windows of this many words repeat within a run of at least 24 words and three periods.
WINDOW = 9
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Texts whose results a task holds at a time.
_AT_ONCE = 256
_RUN = "struct<start:bigint,length:bigint,period:bigint>"

Runs = np.ndarray  # rows of (start, period, length), in order


def _windows(numbers: np.ndarray) -> np.ndarray:
    """A hash of the nine numbers from each place on."""
    mixed = (numbers.astype(np.uint64) + np.uint64(1)) * _FACTOR
    mixed ^= mixed >> np.uint64(29)
    n, total = len(numbers) - WINDOW + 1, np.zeros(len(numbers) - WINDOW + 1, np.uint64)
    for k in range(WINDOW):
        total = total * _FACTOR + mixed[k : k + n]
    return total


def stretches(numbers: np.ndarray) -> list[tuple[int, int]]:
    """Parts (start, end) that hold all runs: every window of a part occurs in it at least twice."""
    if len(numbers) < LEAST_WORDS:
        return []
    hashes, found = _windows(numbers), []
    open_ = [(0, len(hashes))]
    while open_:
        low, high = open_.pop()
        _, inverse, counts = np.unique(hashes[low:high], return_inverse=True, return_counts=True)
        twice = counts[inverse] > 1
        if twice.all():
            found.append((low, high + WINDOW - 1))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([0], twice, [0]))))
        parts = zip((edges[::2] + low).tolist(), (edges[1::2] + low).tolist())
        open_ += [(a, b) for a, b in parts if b - a + WINDOW - 1 >= LEAST_WORDS]
    return sorted(found)


def runs_of(numbers: np.ndarray) -> Runs:
    """All runs of a sequence of numbers >= 0 by suffix trees."""
    n = len(numbers)
    ahead, back = SuffixTree(numbers), SuffixTree(numbers[::-1])
    starts, ends = np.arange(n), []
    for rank in (ahead.rank, ahead.falling_rank()):
        ends.append(next_smaller(rank))
    start, end = np.concatenate([starts, starts]), np.concatenate(ends)
    period = end - start
    few = LEAST_REPEATS * period <= n
    start, end, period = start[few], end[few], period[few]
    # the text's end is the end mark's suffix, which shares nothing; so is the place before its start
    right = ahead.common(start, end)
    left = back.common(n - start, n - end)
    first, length = start - left, left + period + right
    enough = length >= np.maximum(LEAST_WORDS, LEAST_REPEATS * period)
    return np.unique(np.stack([first, period, length], axis=1)[enough], axis=0)


def runs_of_words(listed: list[bytes]) -> Runs:
    """All runs of a list of words."""
    if len(listed) < LEAST_WORDS:
        return np.empty((0, 3), np.int64)
    known: dict[bytes, int] = {}
    numbers = np.array([known.setdefault(w, len(known)) for w in listed], np.int64)
    parts = [runs_of(_numbered(numbers[a:b])) + np.array([a, 0, 0]) for a, b in stretches(numbers)]
    return np.concatenate(parts) if parts else np.empty((0, 3), np.int64)


def _numbered(numbers: np.ndarray) -> np.ndarray:
    return np.unique(numbers, return_inverse=True)[1]


def strongest(runs: Runs) -> tuple[int, int, int]:
    """Of the runs the one with the greatest length by period; of equals the first, then the shortest period."""
    # quotients of numbers below 2**26 are equal as floating-point numbers only if they are equal
    first = np.lexsort((runs[:, 1], runs[:, 0], -(runs[:, 2] / runs[:, 1])))[0]
    return tuple(runs[first].tolist())


def collapsed(listed: list[bytes], runs: Runs) -> bytes:
    """The words without those that a run holds after its first period, joined by blanks."""
    if not len(runs):
        return b" ".join(listed)
    change = np.zeros(len(listed) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 1], 1)
    np.add.at(change, runs[:, 0] + runs[:, 2], -1)
    return b" ".join([w for w, c in zip(listed, np.cumsum(change).tolist()) if not c])


def _struct(row: tuple[int, int, int]) -> dict[str, int]:
    return {"start": row[0], "length": row[2], "period": row[1]}


def collapse_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id; runs, an array of (start, length, period) by start and period;
    strongest, the run with the greatest length by period (null if there is none); collapsed, the words
    that stay, joined by one blank.

    Words are `[^\\x20\\x09-\\x0D]+`, numbered from 0. A run is a longest stretch of at least 24 words and
    three of its smallest periods; what it holds after its first period goes. A null or empty text has no
    words, no runs and an empty result. Each text is handled whole in the task that reads it, without a
    shuffle, in time in proportion to its length but for sorting; repeated rows stay repeated, a null id
    stays null, other columns do not matter, no rows give no rows.
    """
    texts = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text")
    )
    run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, _AT_ONCE):
                part = batch.slice(low, _AT_ONCE)
                listed = [bytes(t).split() for t in part.column("text").to_pylist()]
                found = [runs_of_words(w) for w in listed]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([[_struct(r) for r in runs.tolist()] for runs in found], pa.list_(run)),
                        pa.array([_struct(strongest(runs)) if len(runs) else None for runs in found], run),
                        pa.array([collapsed(w, runs).decode("utf-8", "replace") for w, runs in zip(listed, found)], pa.string()),
                    ],
                    names=["doc_id", "runs", "strongest", "collapsed"],
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, runs array<{_RUN}>, strongest {_RUN}, collapsed string"
    return texts.mapInArrow(find, schema)


def with_cycles(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` with periodic ends in the texts of some rows, told by h, the CRC-32 of the decimal id, and
    g, a tenth of it: where h ends in 0, the n words from word a = g mod n on repeat the first
    1 + (n - a) / (3 + g mod 8) of them. A null id or a text without words stays as it is."""
    code, g, listed, n, a, p = fresh(docs, "code", "g", "listed", "n", "a", "p")
    chosen = docs.withColumn(code, F.crc32(F.col(id_column).cast("string").cast("binary")))
    chosen = chosen.withColumn(listed, F.when(F.col(code) % 10 == 0, words(F.col(text_column))))
    chosen = chosen.withColumns({g: F.floor(F.col(code) / 10), n: F.size(listed)})
    chosen = chosen.withColumn(a, F.when(F.col(n) > 0, F.col(g) % F.col(n)).cast("int"))
    chosen = chosen.withColumn(p, (1 + F.floor((F.col(n) - F.col(a)) / (3 + F.col(g) % 8))).cast("int"))
    times = F.ceil((F.col(n) - F.col(a)) / F.col(p)).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice(listed, F.col(a) + 1, F.col(p)), times))
    whole = F.slice(F.concat(F.slice(listed, F.lit(1), F.col(a)), cycle), F.lit(1), F.col(n))
    text = F.when(F.col(a).isNotNull(), F.array_join(whole, " ")).otherwise(F.col(text_column))
    return chosen.withColumn(text_column, text).select(*docs.columns)


def run_digests(found: DataFrame) -> DataFrame:
    """Of `collapse_runs`: doc_id, n_runs, the strongest run with its exponent in thousandths, and
    digests of all runs and of what stays. A text without runs has four nulls."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
