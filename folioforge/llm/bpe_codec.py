"""Byte-pair encoding by tree concatenation, and decoding.

A text is cut into pieces where the vocabulary's pattern cuts it. A long unsplit piece is
halved down to leaves, which are encoded independently of each other, all leaves of a piece
in one go. Two neighbours are joined by encoding a window around the join anew: it starts
with some tokens of the left side and ends with some of the right. If it begins with the
same token as the left side's part and ends with the same as the right side's, both sides
agree and the window takes the place of these tokens; else it grows. An encoding is the
only token sequence of a string in which every two neighbours are the encoding of the two,
so agreement at one token on either side makes the whole exact.

Above 65,536 symbols a piece's upper tree is spread over tasks: its shares are rows, each encoded
by a tree of its own, and neighbours are joined in rounds until one row is left.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm.vocabulary import Vocabulary, default_path, load
from folioforge.session import cut_lineage

VOCABULARY = "byte_bpe_50k.json"
#: Symbols of a leaf; words of the usual tables are longer now and then.
LEAF = 16
#: Symbols of a share; longer pieces are dealt out in shares.
SHARE = 1 << 16
#: Tokens on either side of a join that the first window takes.
FIRST_WINDOW = 4
REMEMBERED = 400_000
_SHORT = 48
#: Texts whose results a task holds at a time.
_AT_ONCE = 256
_CODED = (T.StructField("ids", T.BinaryType()), T.StructField("text", T.StringType()))

Tokens = list[tuple[int, int]]  # (id, symbols covered)
Node = tuple[str, Tokens]


class Encoder:
    """Encodes and decodes texts with one vocabulary."""

    def __init__(self, vocabulary: Vocabulary, leaf: int = LEAF):
        self.vocabulary, self.leaf = vocabulary, leaf
        self._model = vocabulary.tokenizer.model
        self._known: dict[str, bytes] = {}
        octet = {c: b for b, c in enumerate(vocabulary.symbols)}
        self._bytes = {i: bytes(octet[c] for c in token) for token, i in vocabulary.ids.items()}
        self._bytes |= {i: token.encode() for token, i in vocabulary.special.items()}

    def _leaf(self, symbols: str) -> Tokens:
        return [(t.id, len(t.value)) for t in self._model.tokenize(symbols)]

    def tree(self, symbols: str) -> Tokens:
        """Tokens of one unsplit piece, given in symbols."""
        count = 1
        while len(symbols) > self.leaf * count:
            count *= 2
        edges = [len(symbols) * i // count for i in range(count + 1)]
        nodes = [(a, self._leaf(symbols[a:b])) for a, b in zip(edges, edges[1:]) if b > a]
        while len(nodes) > 1:
            pairs = zip(nodes[::2], nodes[1::2])
            joined = [(a, self._join(symbols, start, left, right)) for (a, left), (start, right) in pairs]
            nodes = joined + nodes[len(joined) * 2 :]
        return nodes[0][1] if nodes else []

    def _join(self, symbols: str, seam: int, left: Tokens, right: Tokens) -> Tokens:
        """`left` ends and `right` starts at `seam`."""
        width = FIRST_WINDOW
        while True:
            tail, head = left[-width:], right[:width]
            start = seam - sum(n for _, n in tail)
            end = seam + sum(n for _, n in head)
            window = self._leaf(symbols[start:end])
            agreed_left = len(tail) == len(left) or window[0] == tail[0]
            agreed_right = len(head) == len(right) or window[-1] == head[-1]
            if agreed_left and agreed_right:
                return left[: -len(tail)] + window + right[len(head) :]
            width *= 2

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece as little-endian 32-bit numbers."""
        symbols = self.vocabulary.in_symbols(piece)
        tokens = self._leaf(symbols) if len(symbols) <= self.leaf else self.tree(symbols)
        packed = np.fromiter((i for i, _ in tokens), "<u4", len(tokens)).tobytes()
        if len(piece) <= _SHORT:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            self._known[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit numbers."""
        out, known = [], self._known
        for special, part in self.vocabulary.parts(text):
            if special:
                out.append(self.vocabulary.special[part].to_bytes(4, "little"))
            else:
                part = self.vocabulary.normalise(part)
                out += [known.get(p) or self._piece(p) for p in self.vocabulary.pieces(part)]
        return b"".join(out)

    def encode_around(self, text: str, share: int) -> Iterator[bytes | str]:
        """The text in order: ids of what has pieces up to `share` symbols, and the symbols of each longer piece."""
        out = []
        for special, part in self.vocabulary.parts(text):
            if special:
                out.append(self.vocabulary.special[part].to_bytes(4, "little"))
                continue
            for piece in self.vocabulary.pieces(self.vocabulary.normalise(part)):
                symbols = self.vocabulary.in_symbols(piece) if len(piece) * 4 > share else ""
                if len(symbols) <= share:
                    out.append(self._known.get(piece) or self._piece(piece))
                    continue
                if out:
                    yield b"".join(out)
                    out = []
                yield symbols
        if out:
            yield b"".join(out)

    def join(self, left: Node, right: Node) -> Node:
        """The encoding of two neighbouring shares' symbols from their own."""
        symbols = left[0] + right[0]
        return symbols, self._join(symbols, len(left[0]), left[1], right[1])

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """Made once per process, for functions that are called group by group."""
    return Encoder(load(path))


def encoded(text: Column, vocabulary_path: str | None = None) -> Column:
    """Ids of a text, as binary of little-endian 32-bit numbers; none of a null."""
    path = vocabulary_path or default_path(VOCABULARY)

    @F.pandas_udf("binary")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(load(path))
        for texts in batches:
            yield pd.Series([encoder.encode(t) for t in texts], dtype=object)

    return ids(F.coalesce(text, F.lit("")))


def decoded(ids: Column, vocabulary_path: str | None = None) -> Column:
    """The text of such ids; a null counts as no ids. Bytes that are no UTF-8 become U+FFFD."""
    path = vocabulary_path or default_path(VOCABULARY)

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(load(path))
        for packed in batches:
            yield pd.Series([encoder.decode(p) for p in packed], dtype=object)

    return texts(F.coalesce(ids, F.lit(b"")))


#: A part of a text: ids, or a share of a long piece as symbols. `row` tells equal texts apart.
_PARTS = T.StructType().add("row", "string").add("part", "integer").add("share", "integer").add("symbols", "string")
_PARTS = _PARTS.add("ids", "binary").add("lengths", "binary")
_NAMES = _PARTS.names


def _packed(tokens: Tokens) -> tuple[bytes, bytes]:
    table = np.array(tokens, dtype="<u4").reshape(-1, 2)
    return table[:, 0].tobytes(), table[:, 1].tobytes()


def _tokens(ids: bytes, lengths: bytes) -> Tokens:
    return list(zip(np.frombuffer(ids, "<u4").tolist(), np.frombuffer(lengths, "<u4").tolist()))


def _shares(symbols: str, share: int) -> list[str]:
    count = -(-len(symbols) // share)
    edges = [len(symbols) * i // count for i in range(count + 1)]
    return [symbols[a:b] for a, b in zip(edges, edges[1:])]


def _in_parts(texts: DataFrame, path: str, share: int) -> DataFrame:
    """doc_id and `_PARTS`: what has no long piece is encoded, long pieces are cut into shares."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load(path))
        for batch in batches:
            for i, text in enumerate(batch.column("text").to_pylist()):
                row, found = uuid.uuid4().hex, []
                for number, part in enumerate(encoder.encode_around(text, share)):
                    if isinstance(part, bytes):
                        found.append((row, number, 0, None, part, None))
                    else:
                        found += [(row, number, k, s, None, None) for k, s in enumerate(_shares(part, share))]
                found = found or [(row, 0, 0, None, b"", None)]
                doc_id = batch.column("doc_id").slice(i, 1).take(pa.array([0] * len(found), pa.int64()))
                types = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary())
                columns = [pa.array(c, t) for c, t in zip(zip(*found), types)]
                yield pa.RecordBatch.from_arrays([doc_id, *columns], names=["doc_id", *_NAMES])

    return texts.mapInArrow(cut, T.StructType([texts.schema["doc_id"], *_PARTS]))


def _share_tokens(shares: DataFrame, path: str) -> DataFrame:
    """`_PARTS` of shares with their ids and lengths; each share is dealt out on its own."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load(path))
        for batch in batches:
            for r in batch.to_pylist():
                r["ids"], r["lengths"] = _packed(encoder.tree(r["symbols"]))
                yield pa.RecordBatch.from_pylist([r], schema=batch.schema)

    return shares.repartition("row", "part", "share").mapInArrow(code, _PARTS)


def _joined_once(nodes: DataFrame, path: str) -> DataFrame:
    """Neighbours 2k and 2k + 1 become node k; a last one without a neighbour stays."""

    def join(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["share"])
        node = rows[0] | {"share": rows[0]["share"] // 2}
        if len(rows) > 1:
            sides = [(r["symbols"], _tokens(r["ids"], r["lengths"])) for r in rows]
            node["symbols"], tokens = _encoder(path).join(*sides)
            node["ids"], node["lengths"] = _packed(tokens)
        return pa.Table.from_pylist([{n: node[n] for n in _NAMES}], schema=group.select(_NAMES).schema)

    above = F.floor(F.col("share") / 2).alias("above")
    return nodes.groupBy("row", "part", above).applyInArrow(join, _PARTS)


def _encode_long(texts: DataFrame, path: str, share: int) -> DataFrame:
    """`encode_documents` for texts that may hold pieces of over `share` symbols."""
    # written: the names of rows must stay what they are, whoever reads them
    parts = cut_lineage(_in_parts(texts, path, share))
    last = parts.agg(F.max("share")).first()[0] or 0
    long = F.col("symbols").isNotNull()
    nodes = _share_tokens(parts.where(long).select(*_NAMES), path) if last else None
    for _ in range(last.bit_length()):
        nodes = _joined_once(nodes, path)
    ready = parts.where(~long).select(*_NAMES)
    whole = ready.unionByName(nodes) if last else ready
    ids = parts.select("row", "doc_id").distinct()
    schema = T.StructType([texts.schema["doc_id"], *_CODED])

    def together(group: pa.Table) -> pa.Table:
        order = group.select(["part", "ids"]).sort_by("part")
        ids = b"".join(order.column("ids").to_pylist())
        back = _encoder(path).decode(ids)
        columns = [group.column("doc_id").slice(0, 1), pa.array([ids], pa.binary()), pa.array([back], pa.string())]
        return pa.table(columns, names=["doc_id", "ids", "text"])

    return whole.select("row", "part", "ids").join(ids, "row").groupBy("row").applyInArrow(together, schema)


def encode_documents(
    docs: DataFrame,
    vocabulary_path: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    share: int = SHARE,
) -> DataFrame:
    """One row per row of `docs`: doc_id, ids (binary, little-endian 32-bit), text decoded from them.

    A null text counts as an empty one and gives no ids. Special strings inside a text get
    their own id, as the library has it by default. Whole texts are encoded; repeated rows stay
    repeated, other columns do not matter. Texts of up to `share` bytes are each encoded in one
    task without a shuffle, which holds the results of a few hundred at a time. Of longer ones
    the unsplit pieces of over `share` symbols are dealt out in shares; this runs a job when called.
    """
    path = vocabulary_path or default_path(VOCABULARY)
    texts = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load(path))
        for batch in batches:
            for start in range(0, batch.num_rows, _AT_ONCE):
                part = batch.slice(start, _AT_ONCE)
                ids = [encoder.encode(t) for t in part.column("text").to_pylist()]
                back = [encoder.decode(i) for i in ids]
                columns = [part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(back, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "text"])

    schema = T.StructType([texts.schema["doc_id"], *_CODED])
    long = F.octet_length("text") > share
    short = texts.where(~long).mapInArrow(code, schema)
    return short.unionByName(_encode_long(texts.where(long), path, share))


def encoding_digests(
    docs: DataFrame,
    vocabulary_path: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of `encode_documents`, and the ids if wished."""
    return encode_documents(docs, vocabulary_path, id_column, text_column).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
        *(["ids"] if with_ids else []),
    )
