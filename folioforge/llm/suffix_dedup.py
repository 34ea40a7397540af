"""Removal of long repeated passages with a logarithmic family of suffix arrays.

A byte goes if a string of 400 bytes that covers it also starts anywhere else. Not every suffix
is indexed. Among the 273 strings of 128 bytes inside a string of 400, the one with the smallest
hash is its anchor, so equal strings have equal anchors in the same place; about one suffix in
a hundred starts at an anchor. An anchor answers for the stretch of strings that it anchors.

The suffixes are sorted by the fingerprint of their first 128 bytes. New batches of documents get
sorted arrays of their own, which are merge-scanned against every level of the index for
beginnings found twice; then levels of equal size are merged, so that the index is a family of
arrays whose sizes double. What follows looks only at suffixes whose beginning was found twice:

* suffixes whose whole stretch is equal to another's: all of the stretch repeats;
* the others of a beginning with several different stretches are compared in blocks of 16
  starts. The bytes common to all strings of a block must be found twice, else none repeats; if the
  bytes that cover them all are found twice, all of them repeat; only blocks between
  these two, at the ends of a match, are compared string by string.

All comparisons are counts of fingerprints of 128 bits, which are summed before a shuffle, so
a passage in very many documents is no hot spot, and no pairs are listed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import utf8
from folioforge.session import cut_lineage, drop_table

LENGTH = 400
GRAM = 128
BLOCK = 16
BATCHES = 4
_SALTS = 16
_STEP = 1 << 17
_POSITION_BITS = np.uint64((1 << 20) - 1)
_ROOM = _STEP + 4 * LENGTH + 4 * BLOCK


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BASE = 0x9E3779B97F4A7C15
_POWERS = _powers(_BASE, _ROOM)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), _ROOM)
_OCTETS = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Prints:
    """Fingerprints of the substrings of up to about 130,000 bytes."""

    def __init__(self, octets: np.ndarray):
        self.sums = np.zeros(len(octets) + 1, np.uint64)
        np.cumsum(_OCTETS[octets] * _POWERS[: len(octets)], out=self.sums[1:])

    def of(self, start, end) -> np.ndarray:
        """Of [start, end), element by element."""
        return _mixed((self.sums[end] - self.sums[start]) * _INVERSE[start])

    def all_of(self, length: int) -> np.ndarray:
        """Of every substring of a length."""
        n = len(self.sums) - length
        return _mixed((self.sums[length:] - self.sums[:-length]) * _INVERSE[:n])


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every `width` neighbours."""
    n = len(values)
    rows = np.full(-(-n // width) * width, np.uint64(2**64 - 1))
    rows[:n] = values
    rows = rows.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])


def anchors(octets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Anchors of a text's bytes: position, first and last string start they answer for, and the
    fingerprints of the anchor's first bytes and of the stretch. A text below `length` has none."""
    found: dict[str, list] = {k: [] for k in ("position", "first", "last", "gram", "stretch")}
    starts, width = len(octets) - length + 1, length - gram + 1
    for begin in range(0, max(0, starts), _STEP):
        # strings that start up to `width` before and after, to see every stretch that begins here whole
        low = max(0, begin - width)
        high = min(starts, begin + _STEP + width)
        prints = Prints(octets[low : high + length - 1])
        grams = prints.all_of(gram)
        marked = (grams & ~_POSITION_BITS) | np.arange(len(grams), dtype=np.uint64)
        anchor = (_sliding_minimum(marked, width) & _POSITION_BITS).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        last = np.concatenate([first[1:] - 1, [len(anchor) - 1]])
        here = (first + low >= begin) & (first + low < begin + _STEP)
        first, last = first[here], last[here]
        at = anchor[first]
        place = ((at - first) * 1024 + (last - first)).astype(np.uint64)
        found["position"].append(at + low)
        found["first"].append(first + low)
        found["last"].append(last + low)
        found["gram"].append(grams[at].view(np.int64))
        found["stretch"].append(_mixed(prints.of(first, last + length) + place).view(np.int64))
    return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in found.items()}


def block_prints(octets: np.ndarray, anchor: int, first: int, last: int, length: int = LENGTH):
    """Fingerprints of the blocks of an anchor: number, of the bytes common to its strings, and of
    the bytes that cover all of them (None where the text is too short for it)."""
    prints, n = Prints(octets), len(octets)
    blocks = range((anchor - last) // BLOCK, (anchor - first) // BLOCK + 1)
    end = anchor - np.array(blocks, np.int64) * BLOCK  # last start of a block
    start = end - BLOCK + 1
    salt = np.arange(blocks.start, blocks.stop, dtype=np.uint64) * np.uint64(2)
    common = _mixed(prints.of(end, start + length) + salt).view(np.int64)
    fits = (start >= 0) & (end + length <= n)
    whole = _mixed(prints.of(np.maximum(start, 0), np.minimum(end + length, n)) + salt + np.uint64(1)).view(np.int64)
    return list(blocks), common.tolist(), [int(w) if f else None for w, f in zip(whole, fits)]


def removed_runs(starts: list[tuple[int, int]], length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by strings that start in these stretches (both ends included)."""
    runs: list[list[int]] = []
    for first, last in sorted(starts):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], last + length)
        else:
            runs.append([first, last + length])
    return [(a, b) for a, b in runs]


class SuffixIndex:
    """A family of sorted arrays of suffixes, (gram, n), whose sizes double from level to level."""

    def __init__(self):
        self.levels: list[DataFrame | None] = []
        self.matches: list[DataFrame] = []

    def add(self, suffixes: DataFrame) -> None:
        """A batch: `suffixes` has the gram of every suffix. Notes grams found twice, in the batch or
        in the batch and a level; then merges levels of equal size."""
        run = self._sorted(suffixes.groupBy("gram").agg(F.count("*").alias("n")))
        twice = run.where("n > 1").select("gram")
        for level in filter(None, self.levels):
            twice = twice.unionAll(run.join(level, "gram", "left_semi").select("gram"))
        self.matches.append(cut_lineage(twice.distinct()))
        rank = 0
        while rank < len(self.levels) and self.levels[rank] is not None:
            both = self.levels[rank].unionAll(run).groupBy("gram").agg(F.sum("n").alias("n"))
            merged = self._sorted(both)
            drop_table(self.levels[rank])
            drop_table(run)
            self.levels[rank], run = None, merged
            rank += 1
        self.levels += [None] * (rank + 1 - len(self.levels))
        self.levels[rank] = run

    @staticmethod
    def _sorted(rows: DataFrame) -> DataFrame:
        return cut_lineage(rows.sortWithinPartitions("gram"))

    def repeated(self) -> DataFrame:
        """Distinct grams found twice or more. The index itself is given up."""
        out = self.matches[0]
        for more in self.matches[1:]:
            out = out.unionAll(more)
        found = cut_lineage(out.distinct())
        for rows in (*filter(None, self.levels), *self.matches):
            drop_table(rows)
        return found


def _text_key(text: Column) -> list[Column]:
    """Two hashes that tell texts apart."""
    return [F.xxhash64(text).alias("k1"), F.hash(text).alias("k2")]


def _suffixes(texts: DataFrame) -> DataFrame:
    """Anchors of every text: k1, k2, place (position and stretch in one number), gram, stretch."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for k1, k2, text in zip(batch["k1"], batch["k2"], utf8(batch["text"])):
                if len(text) >= LENGTH:
                    a = anchors(np.frombuffer(text, np.uint8))
                    place = a["position"] << 20 | (a["position"] - a["first"]) << 10 | (a["last"] - a["first"])
                    parts.append((np.full(len(place), k1), np.full(len(place), k2), place, a["gram"], a["stretch"]))
            if parts:
                columns = map(np.concatenate, zip(*parts))
                yield pd.DataFrame(dict(zip(("k1", "k2", "place", "gram", "stretch"), columns)))

    return texts.mapInPandas(find, "k1 long, k2 int, place long, gram long, stretch long")


def _unpacked() -> tuple[Column, Column, Column]:
    """position, first and last start of a place."""
    position = F.shiftright("place", 20)
    first = position - F.shiftright("place", 10).bitwiseAND(F.lit(1023))
    return position, first, first + F.col("place").bitwiseAND(F.lit(1023))


def _contexts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Bytes around the stretch of each wanted suffix, and the fingerprints of its blocks.

    `wanted` has k1, k2, id and items: gram, stretch, n, place. Columns: gram, stretch, n, anchor, first,
    last (counted in bytes), bytes, blocks, common, whole.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            columns = (batch[c] for c in ("gram", "stretch", "n", "place"))
            for text, *items in zip(utf8(batch["text"]), *columns):
                for gram, stretch, n, place in zip(*items):
                    at = int(place) >> 20
                    first = at - (int(place) >> 10 & 1023)
                    last = first + (int(place) & 1023)
                    low, high = max(0, first - BLOCK), last + LENGTH + BLOCK
                    part = text[low:high]
                    prints = block_prints(np.frombuffer(part, np.uint8), at - low, first - low, last - low)
                    rows.append((gram, stretch, n, at - low, first - low, last - low, part, *prints))
            names = ["gram", "stretch", "n", "anchor", "first", "last", "bytes", "blocks", "common", "whole"]
            yield pd.DataFrame(rows, columns=names)

    fields = (F.col(f"items.{c}").alias(c) for c in ("gram", "stretch", "n", "place"))
    joined = texts.join(wanted, ["k1", "k2", "id"]).select("text", *fields)
    schema = (
        "gram long, stretch long, n long, anchor int, first int, last int, bytes binary, "
        "blocks array<int>, common array<long>, whole array<long>"
    )
    return joined.mapInPandas(cut, schema)


def _strings(contexts: DataFrame) -> DataFrame:
    """Fingerprints of every string that starts in the wanted blocks: gram, stretch, start (before the anchor), code."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for r in batch.itertuples(index=False):
                octets = np.frombuffer(bytes(r.bytes), np.uint8)
                back = (np.asarray(r.wanted, np.int64)[:, None] * BLOCK + np.arange(BLOCK)).ravel()
                at = r.anchor - back
                back, at = back[(at >= r.first) & (at <= r.last)], at[(at >= r.first) & (at <= r.last)]
                code = Prints(octets).of(at, at + LENGTH).view(np.int64)
                parts.append((np.full(len(at), r.gram), np.full(len(at), r.stretch), back.astype(np.int32), code))
            if parts:
                yield pd.DataFrame(dict(zip(("gram", "stretch", "back", "code"), map(np.concatenate, zip(*parts)))))

    return contexts.mapInPandas(cut, "gram long, stretch long, back int, code long")


def _found_twice(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("times")).where("times > 1").select(*keys)


def repeated_starts(texts: DataFrame, first_ids: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Stretches of string starts that repeat: k1, k2, first, last, for each different text.

    `texts` has id, k1, k2 and text (binary), `first_ids` k1, k2 and the id of the row that stands
    for all with this text.
    """
    suffixes = cut_lineage(_suffixes(texts.select("k1", "k2", "text")))
    index = SuffixIndex()
    for batch in range(batches):
        index.add(suffixes.where(F.pmod("k1", F.lit(batches)) == batch).select("gram"))
    repeated = index.repeated()
    # copies of a text give the same rows
    shared = cut_lineage(suffixes.join(repeated, "gram", "left_semi").dropDuplicates(["k1", "k2", "place"]))
    drop_table(suffixes)
    drop_table(repeated)

    member = F.min(F.struct("k1", "k2", "place")).alias("member")
    stretches = cut_lineage(shared.groupBy("gram", "stretch").agg(F.count("*").alias("n"), member))
    position, first, last = _unpacked()
    equal = shared.join(stretches.where("n > 1").select("gram", "stretch"), ["gram", "stretch"], "left_semi")
    equal = equal.select("k1", "k2", first.alias("first"), last.alias("last"))

    # a passage in very many surroundings is one gram with as many stretches, so these are salted
    every = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    several = _found_twice(stretches, "gram").select("gram", every.alias("salt"))
    salted = stretches.withColumn("salt", F.pmod("stretch", F.lit(_SALTS)).cast("int"))
    items = salted.join(several, ["gram", "salt"], "left_semi").select("gram", "stretch", "n", "member.*")
    wanted = items.groupBy("k1", "k2").agg(F.collect_list(F.struct("gram", "stretch", "n", "place")).alias("items"))
    contexts = _contexts(texts, wanted.join(first_ids, ["k1", "k2"]))
    contexts = cut_lineage(contexts.dropDuplicates(["gram", "stretch"]))

    zipped = F.explode(F.arrays_zip("blocks", "common", "whole")).alias("b")
    blocks = contexts.select("gram", "stretch", "n", zipped).select("gram", "stretch", "n", "b.*").withColumnRenamed("blocks", "block")
    blocks = blocks.join(_found_twice(blocks, "gram", "common"), ["gram", "common"], "left_semi")
    blocks = cut_lineage(blocks)
    covering = _found_twice(blocks.where("whole is not null"), "gram", "whole").withColumn("all", F.lit(True))
    blocks = blocks.join(covering, ["gram", "whole"], "left")
    blocks = cut_lineage(blocks.withColumn("all", F.coalesce("all", F.lit(False))))

    open_ = blocks.where("not all and n = 1").select("gram", "common").distinct()
    one_each = blocks.where("all").groupBy("gram", "common", "whole").agg(F.min(F.struct("stretch", "block")).alias("m"))
    sources = blocks.where("not all").select("gram", "common", "stretch", "block").unionAll(
        one_each.select("gram", "common", "m.stretch", "m.block")
    )
    asked = sources.join(open_, ["gram", "common"], "left_semi")
    asked = asked.groupBy("gram", "stretch").agg(F.collect_list("block").alias("wanted"))
    strings = cut_lineage(_strings(contexts.join(asked, ["gram", "stretch"])))
    twice = strings.join(_found_twice(strings, "gram", "code"), ["gram", "code"], "left_semi")

    by_block = blocks.where("all and n = 1").select(
        "gram", "stretch", (F.col("block") * BLOCK).alias("low"), (F.col("block") * BLOCK + BLOCK - 1).alias("high")
    )
    by_string = twice.select("gram", "stretch", F.col("back").alias("low"), F.col("back").alias("high"))
    own = stretches.where("n = 1").select("gram", "stretch", "member.*")
    apart = own.join(by_block.unionAll(by_string), ["gram", "stretch"]).select(
        "k1",
        "k2",
        F.greatest(first, position - F.col("high")).alias("first"),
        F.least(last, position - F.col("low")).alias("last"),
    )
    return equal.unionAll(apart)


def remove_repeats(
    docs: DataFrame, batches: int = BATCHES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_removed, n_spans, n_kept (bytes that stay), kept (what
    stays, where something goes; null where the text stays as it is), kept_sha256.

    A null text counts as empty. Matches never cross texts. A text of 400 bytes or more with a copy
    goes whole; so do repeated rows of that size. Shorter texts stay. No rows give no rows.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    raw = text.cast("binary")
    texts = docs.select(F.coalesce(F.col(id_column), F.lit(-1)).alias("id"), *_text_key(text), raw.alias("text"))
    narrow = cut_lineage(
        docs.select(
            F.col(id_column).alias("doc_id"), *_text_key(text), F.octet_length(text).cast("long").alias("n_bytes"),
            F.unhex(F.sha2(raw, 256)).alias("sha"),
        )
    )
    groups = narrow.groupBy("k1", "k2").agg(
        F.count("*").alias("copies"), F.min(F.coalesce("doc_id", F.lit(-1))).alias("id"), F.max("n_bytes").alias("n_bytes")
    )
    groups = cut_lineage(groups.where(F.col("n_bytes") >= LENGTH))
    starts = repeated_starts(texts.where(F.octet_length("text") >= LENGTH), groups.select("k1", "k2", "id"), batches)
    single = groups.where("copies = 1").select("k1", "k2")
    runs = starts.join(single, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(
        F.collect_list("first").alias("first"), F.collect_list("last").alias("last")
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                body, at, kept = bytes(r.text), 0, []
                spans = removed_runs(list(zip(map(int, r.first), map(int, r.last))))
                for a, b in spans:
                    kept.append(body[at:a])
                    at = b
                rest = b"".join([*kept, body[at:]])
                rows.append((r.k1, r.k2, len(body) - len(rest), len(spans), rest, hashlib.sha256(rest).digest()))
            yield pd.DataFrame(rows, columns=["k1", "k2", "n_removed", "n_spans", "kept", "kept_sha"])

    joined = texts.drop("id").join(runs, ["k1", "k2"])
    done = joined.mapInPandas(cut, "k1 long, k2 int, n_removed long, n_spans long, kept binary, kept_sha binary")
    # one join with one row for each text, so that the rows of a text with very many copies can be split
    doubles = groups.where("copies > 1").select("k1", "k2", F.lit(True).alias("double"))
    changed = done.withColumn("double", F.lit(False)).unionByName(doubles, allowMissingColumns=True)
    out = narrow.join(changed, ["k1", "k2"], "left")
    whole = F.coalesce("double", F.lit(False))
    empty = F.unhex(F.lit(hashlib.sha256(b"").hexdigest()))
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(0)).otherwise(F.col("n_bytes") - F.coalesce(F.col("n_removed"), F.lit(0))).cast("long").alias("n_kept"),
        F.when(whole, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"),
        F.lower(F.hex(F.when(whole, empty).otherwise(F.coalesce("kept_sha", "sha")))).alias("kept_sha256"),
    )
