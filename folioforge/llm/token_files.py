"""Token ids in binary files, documents in order of their ids.

A file holds the ids of consecutive documents as one array of 16- or 32-bit numbers. Where each document
starts, and its doc_id, are rising numbers and stored in Elias-Fano form (`elias_fano`), in some two bits
above their logarithm each instead of 64.

Layout, little-endian: the mark, the bytes of an id (2 or 4), the documents without a doc_id (they stand
first), the first doc_id, the number of ids; the doc_ids less the first; the starts and the end of the last
document; the ids.
"""

from __future__ import annotations

import functools
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.llm.elias_fano import EliasFano
from folioforge.llm.vocabulary import Vocabulary, default_path, load
from folioforge.session import write_table

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
#: A file is closed after so many ids or documents; a longer document has a file of its own.
FILE_IDS, FILE_DOCS = 1 << 23, 1 << 18
#: Bytes of text of one sorting and writing task, about.
TASK_BYTES = 1 << 27
REMEMBERED = 400_000
_SHORT = 48
_MARK = b"RISINGID"
_HEAD = struct.Struct("<8sBQqQ")
_IDS_AT_ONCE = 1 << 21
#: Texts that a task turns into strings at a time.
_AT_ONCE = 256
_MANIFEST = "part int, shard int, file string, n_docs long, n_ids long"


class _Ids(dict):
    """Ids of the text between two blanks, packed; made when first asked for."""

    def __init__(self, vocabulary: Vocabulary, width: int):
        super().__init__()
        self.vocabulary, self.width, self._tokenize = vocabulary, width, vocabulary.tokenizer.model.tokenize
        known = [*vocabulary.ids.values(), *vocabulary.special.values()]
        self.packed = [i.to_bytes(width, "little") for i in range(max(known) + 1)]

    def _piece(self, symbols: str) -> bytes:
        return b"".join([self.packed[t.id] for t in self._tokenize(symbols)])

    def __missing__(self, chunk: str) -> bytes:
        v = self.vocabulary
        if chunk.isascii() and chunk.isalpha():  # a single piece, whose letters stand for themselves
            ids = self._piece(chunk.lower())
        else:
            ids = b"".join([self._piece(v.in_symbols(p)) for p in v.pieces(v.normalise(chunk))])
        if len(chunk) <= _SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[chunk] = ids
        return ids


@functools.lru_cache(maxsize=2)
def _remembered(path: str, width: int) -> _Ids:
    """Kept by the worker process, so its later tasks find what the earlier ones have made."""
    return _Ids(load(path), width)


def packed_ids(text: str, known: _Ids) -> bytes:
    """Ids of one text. The vocabulary drops white space, so blanks and line ends cut a text anywhere."""
    v, out = known.vocabulary, []
    for special, part in v.parts(text):
        if special:
            out.append(known.packed[v.special[part]])
        else:
            out += map(known.__getitem__, part.replace("\n", " ").split(" "))
    return b"".join(out)


def _id_bytes(vocabulary: Vocabulary, end_id: int) -> int:
    return 2 if max(max(vocabulary.ids.values()), *vocabulary.special.values(), end_id) < 1 << 16 else 4


def file_bytes(doc_ids: list[int | None], lengths: list[int], ids: bytes) -> bytes:
    """One file. `doc_ids` rise, those without one stand first; `ids` are packed."""
    some = [i for i in doc_ids if i is not None]
    first = some[0] if some else 0
    starts = np.concatenate(([0], np.cumsum(np.array(lengths, np.int64))))
    width = len(ids) // int(starts[-1])
    head = _HEAD.pack(_MARK, width, len(doc_ids) - len(some), first, int(starts[-1]))
    return b"".join([head, EliasFano.of(np.array([i - first for i in some], np.uint64)).to_bytes(), EliasFano.of(starts).to_bytes(), ids])


class TokenFile:
    """A file of `file_bytes`, read where it is asked."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        mark, self.width, self._without, self._first, self.n_ids = _HEAD.unpack_from(view)
        if mark != _MARK:
            raise ValueError("no file of token ids")
        self._doc_ids, at = EliasFano.read(view, _HEAD.size)
        self._starts, at = EliasFano.read(view, at)
        self.n_docs = len(self._starts) - 1
        self._ids = np.frombuffer(view[at : at + self.n_ids * self.width], f"<u{self.width}")

    def starts(self, k: np.ndarray) -> np.ndarray:
        """Where documents k start; n_docs gives the end of the last."""
        return self._starts.at(k).astype(np.int64)

    def doc_ids(self, low: int, high: int) -> list[int | None]:
        held = np.arange(max(low, self._without), high) - self._without
        return [None] * (min(high, self._without) - low) + [int(x) + self._first for x in self._doc_ids.at(held).tolist()]

    def ids(self, start: int, end: int) -> np.ndarray:
        return self._ids[start:end]


def _files(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def qualified(spark: SparkSession, path: str) -> str:
    """`path` with the scheme of its file system, as tasks need it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary_path: str | None = None,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
    file_ids: int = FILE_IDS,
    file_docs: int = FILE_DOCS,
    task_bytes: int = TASK_BYTES,
) -> None:
    """Encode every whole text, append `end_id`, and write the ids to files in `path`, by rising doc_id.

    A null text counts as an empty one; a null doc_id stands before all others; rows of equal doc_id stand
    in the order of a digest of their texts, so repeated rows stay repeated and reruns agree. Other columns do
    not matter; no rows give no files. doc_id is a whole number.

    Texts are dealt out by ranges of (doc_id, digest, row), so copies of a row or id do not meet in one task,
    and encoded where they arrive. A task writes its files under names of its own and returns what it has
    written; the manifest, a Parquet table beside them, names the files of the tasks that Spark accepted, so
    what a lost or repeated task has left is never read.
    """
    spark = docs.sparkSession
    vocabulary_file = vocabulary_path or default_path(VOCABULARY)
    text = F.coalesce(F.col(text_column), F.lit(""))
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // task_bytes))
    order = [F.col("doc_id").asc_nulls_first(), "digest", "row"]
    dealt = texts.withColumn("digest", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("doc_id", "text")
    place = qualified(spark, path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(vocabulary_file)
        width = _id_bytes(vocabulary, end_id)
        known, end = _remembered(vocabulary_file, width), end_id.to_bytes(width, "little")
        store, folder = _files(f"{place}/files")
        part, done = TaskContext.get().partitionId(), []
        doc_ids, lengths, held = [], [], []

        def close() -> None:
            name = f"{part:08d}-{len(done):06d}-{uuid.uuid4().hex}.ids"
            with store.open_output_stream(f"{folder}/{name}") as out:
                out.write(file_bytes(doc_ids, lengths, b"".join(held)))
            done.append((part, len(done), name, len(doc_ids), sum(lengths)))
            doc_ids.clear(), lengths.clear(), held.clear()

        gathered = 0
        for batch in batches:
            if not done and not doc_ids:
                store.create_dir(folder, recursive=True)
            for i, text in _rows(batch):
                ids = packed_ids(text, known) + end
                n = len(ids) // width
                if doc_ids and (gathered + n > file_ids or len(doc_ids) >= file_docs):
                    close()
                    gathered = 0
                doc_ids.append(i), lengths.append(n), held.append(ids)
                gathered += n
        if doc_ids:
            close()
        columns = list(zip(*done)) or [[]] * 5
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        names = ["part", "shard", "file", "n_docs", "n_ids"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    write_table(dealt.mapInArrow(write, _MANIFEST), f"{path}/manifest")


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int | None, str]]:
    for low in range(0, batch.num_rows, _AT_ONCE):
        part = batch.slice(low, _AT_ONCE)
        yield from zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist())


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of `write_token_files`: doc_id, start (ids of all documents before it), ids
    (binary, little-endian 32-bit), in no order. One task reads a file; starts come from its boundaries."""
    listed = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
    parts = listed.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    # a row a sorting task
    parts = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("base"))
    upto = F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_ids")
    based = listed.withColumn("upto", upto).join(parts, "part").select("file", (F.col("base") + F.col("upto")).alias("base"))
    tasks = max(1, min(based.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    place = qualified(spark, path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _files(f"{place}/files")
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                with store.open_input_stream(f"{folder}/{name}") as source:
                    data = TokenFile(source.read())
                yield from _documents(data, base)

    return based.repartition(tasks, "file").mapInArrow(read, "doc_id long, start long, ids binary")


def _documents(data: TokenFile, base: int) -> Iterator[pa.RecordBatch]:
    """The documents of a file, some at a time."""
    edges = data.starts(np.arange(data.n_docs + 1))
    low = 0
    while low < data.n_docs:
        high = max(low + 1, int(np.searchsorted(edges, edges[low] + _IDS_AT_ONCE, side="right")) - 1)
        offsets = (4 * (edges[low : high + 1] - edges[low])).astype(np.int32)
        body = data.ids(int(edges[low]), int(edges[high])).astype("<u4")
        packed = pa.BinaryArray.from_buffers(pa.binary(), high - low, [None, pa.py_buffer(offsets), pa.py_buffer(body)])
        columns = [pa.array(data.doc_ids(low, high), pa.int64()), pa.array(edges[low:high] + base), packed]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "ids"])
        low = high


def document_digests(read: DataFrame) -> DataFrame:
    """Of `read_token_files`: doc_id, start, n_tokens (with the end id), ids_crc32."""
    return read.select(
        "doc_id",
        "start",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
