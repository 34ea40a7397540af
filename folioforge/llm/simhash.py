"""Near-duplicates by SimHash fingerprints and pigeonring filtering.

The 64 bits of a fingerprint are a ring of eight segments of one byte. If two
fingerprints differ in at most 3 bits, some segment starts a chain in which the first
l segments differ in at most 3 * l / 8 bits together, for every l from 1 to 8: none in
the first two, one in the next three, two in the next two. So two of the segments are
equal and, of the three after them, at least two: one of 8 * 3 keys of 32 bits is shared.
Pairs that share a key are tested along the chain before all 64 bits are compared.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm.common import fresh, utf8
from folioforge.llm.components import connected_components
from folioforge.session import cut_lineage

SEED = 42
SEGMENTS = 8
MOST_BITS = 3
#: Fingerprints of a key that one task compares with each other.
BLOCK = 512
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_AT_ONCE = 1 << 18
#: Of the lowest five bytes of a turned fingerprint: two, and two of the three after them.
_KEY_BYTES = [0xFF_FF_00_FF_FF, 0xFF_00_FF_FF_FF, 0x00_FF_FF_FF_FF]


def fingerprint_of(text: bytes) -> int:
    """SimHash over the 3-word shingles of one text, as a signed 64-bit number."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - 2)
    shingles = map(b" ".join, zip(words, words[1:], words[2:])) if len(words) > 2 else [b" ".join(words)]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, n)
    for start in range(0, n, _AT_ONCE):
        octets = hashes[start : start + _AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


@F.pandas_udf(T.LongType())
def _fingerprint(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint_of(t) for t in utf8(texts)], dtype=np.int64)


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text; a null counts as an empty text, whose fingerprint is 0."""
    return _fingerprint(F.coalesce(text, F.lit("")).cast("binary"))


def _turned(fp: Column, segment: int) -> Column:
    """`fp` with `segment` turned to the lowest byte."""
    shift = 8 * segment
    return fp if not shift else F.shiftrightunsigned(fp, shift).bitwiseOR(F.shiftleft(fp, 64 - shift))


def _keys(fp: Column) -> Column:
    """The 24 keys of a fingerprint; bits 40 and up tell which."""
    return F.array(
        *(
            _turned(fp, s).bitwiseAND(F.lit(kept)).bitwiseOR(F.lit((s * 3 + k) << 40))
            for s in range(SEGMENTS)
            for k, kept in enumerate(_KEY_BYTES)
        )
    )


def linked(members: np.ndarray, segment: int) -> np.ndarray:
    """Which of some fingerprints (uint64) are alike, as a matrix: chain from `segment` first, then all bits."""
    differ = members[:, None] ^ members[None, :]
    turned = (differ >> np.uint64(8 * segment)) | (differ << np.uint64((64 - 8 * segment) % 64))
    fit = np.ones(differ.shape, bool)
    for length in range(2, SEGMENTS):
        head = turned & np.uint64((1 << (8 * length)) - 1)
        fit &= np.bitwise_count(head) <= MOST_BITS * length // SEGMENTS
    return fit & (np.bitwise_count(differ) <= MOST_BITS)


def _forest(members: list[int], segment: int) -> list[tuple[int, int]]:
    """Links (member, smaller member) that join what the pairs of these members join."""
    values = np.unique(np.asarray(members, dtype=np.int64))
    fit = linked(values.view(np.uint64), segment)
    label = np.arange(len(values))
    while True:
        least = np.where(fit, label[None, :], len(values)).min(axis=1)
        least = np.minimum(label, least)
        least = least[least]
        if (least == label).all():
            break
        label = least
    return [(int(values[i]), int(values[r])) for i, r in enumerate(label) if i != r]


@F.pandas_udf(T.ArrayType(T.StructType().add("a", T.LongType()).add("b", T.LongType())))
def _links(segments: pd.Series, members: pd.Series) -> pd.Series:
    return pd.Series([[{"a": a, "b": b} for a, b in _forest(m, s)] for s, m in zip(segments, members)])


def fingerprint_links(fingerprints: DataFrame, block: int = BLOCK) -> DataFrame:
    """`fingerprints` has distinct longs fp. Returns links (a, b): the components of these are
    those of all pairs that differ in at most 3 bits.

    A key with many fingerprints is dealt out in blocks of about `block`, and every two
    blocks meet in a task of their own, which returns no more links than it has members.
    """
    keyed = fingerprints.select("fp", F.explode(_keys(F.col("fp"))).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    spread = keyed.join(shared, "key").withColumn("of", F.ceil(F.col("n") / block).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("of")).cast("int")
    other = F.explode(
        F.when(F.col("of") == 1, F.array(F.lit(0))).otherwise(
            F.filter(F.sequence(F.lit(0), F.col("of") - 1), lambda b: b != F.col("own"))
        )
    )
    met = spread.withColumn("own", own).select("key", "fp", "own", other.alias("other"))
    groups = (
        met.groupBy("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
        .agg(F.collect_list("fp").alias("members"))
        .where(F.size("members") > 1)
    )
    segment = F.floor(F.shiftright("key", 40) / 3).cast("int")
    return groups.select(F.explode(_links(segment, F.col("members"))).alias("link")).select("link.*").distinct()


def classes(fingerprinted: DataFrame) -> DataFrame:
    """`fingerprinted` has doc_id and fp. Returns (fp, root, component_id), one row per distinct
    fingerprint: root tells the classes apart, component_id is the smallest id of the class."""
    first = cut_lineage(fingerprinted.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = connected_components(fingerprint_links(first.select("fp")))
    rooted = first.join(roots, first.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicate_classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hex digits), component_id.

    Documents are linked when their fingerprints differ in at most 3 bits; component_id is
    the smallest id reachable over links, itself included. Null and empty texts have
    fingerprint zero and are linked like any other; repeated rows stay repeated; a null id
    takes its class's smallest id (null if all are null); no rows give no rows.
    """
    marked = cut_lineage(
        docs.select(F.col(id_column).alias("doc_id"), fingerprint(F.col(text_column)).alias("fp"))
    )
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marked.join(classes(marked), "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_one_per_class(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` that stand for their class of near-duplicates: those of its smallest id.

    Of several rows with that id one stays, by the smallest hash of its text. A class
    without any id keeps one row as well. All columns of `docs` are returned, whatever
    their names; no rows give no rows.
    """
    content = F.xxhash64(F.coalesce(F.col(text_column), F.lit("")))
    marked = cut_lineage(
        docs.select(
            F.col(id_column).alias("doc_id"), fingerprint(F.col(text_column)).alias("fp"), content.alias("code")
        )
    )
    return rows_of_classes(docs, marked, classes(marked), id_column, text_column)


def rows_of_classes(
    docs: DataFrame, marked: DataFrame, classed: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """`marked` has doc_id, fp and code of each row of `docs`, `classed` is (fp, root, component_id).
    Returns the rows of `docs` that `keep_one_per_class` tells of."""
    content = F.xxhash64(F.coalesce(F.col(text_column), F.lit("")))
    best = marked.join(classed, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    code, some, id_, place = fresh(docs, "code", "has_id", "known_id", "place")
    known = [F.coalesce("doc_id", F.lit(0)).alias(id_), F.col("doc_id").isNotNull().alias(some), F.col("code").alias(code)]
    winners = best.groupBy("root", "doc_id").agg(F.min("code").alias("code")).select(*known).distinct()
    rows = docs.withColumns(
        {id_: F.coalesce(F.col(id_column), F.lit(0)), some: F.col(id_column).isNotNull(), code: content}
    )
    order = Window.partitionBy(id_, some, code).orderBy(F.lit(0))
    kept = rows.join(winners, [id_, some, code], "left_semi")
    return kept.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).select(*docs.columns)
