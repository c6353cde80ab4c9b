"""Token ids in fixed-width bit-packed files.

Layout of a file (little endian): the header ``TMBP``, version, bits per id, ids per block; the blocks, each a whole
number of bytes; then the index: byte offset of every block (uint64), doc_id of every document (int64), whether it is
null (uint8), its first id in the file (uint64); and a footer with the counts and the place of the index. Blocks are
independent, so any range of ids is read by seeking to its blocks and unpacking them with numpy.

Documents are dealt to files by ranges of doc_id and sorted inside, so files in order hold ascending doc_ids (null ids
first; rows with one id ordered by a hash of their text, equal rows by where they stand in the table, so that any number
of them spreads over files). The number of files follows from the bytes of the texts. Every task writes under a name of its own and reports it;
only reported files belong to the store, so a repeated or lost task leaves nothing that is ever read. Files go through
``pyarrow.fs``, which knows local paths and the usual object stores and HDFS by their URI.

Defined results: a null or empty text has its end id only; a text of any length is one document of one file; an empty
table gives a store without files. Only the named id and text columns are read, whatever else a table has.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.encoder import encoder_for
from tidemark.llm.tables import new_folder, staged

BLOCK_IDS = 8192
#: Bytes of text a file holds at most, but for its last document.
FILE_BYTES = 256 << 20
_HEAD, _FOOT = struct.Struct("<4sHHI"), struct.Struct("<QQQQ4s")
_MANIFEST = "part int, path string, n_docs bigint, n_ids bigint"
_READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    spread = np.unpackbits(np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(spread[:, :bits], bitorder="little").tobytes()


def unpack_bits(raw: bytes, bits: int, n: int) -> np.ndarray:
    flat = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    out = np.zeros((n, 32), np.uint8)
    out[:, :bits] = flat
    return np.packbits(out, axis=1, bitorder="little").view("<u4").ravel()


def _filesystem(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


class StoreWriter:
    """Appends documents to one file; holds one block and the document index."""

    def __init__(self, uri: str, bits: int, block_ids: int = BLOCK_IDS):
        filesystem, path = _filesystem(uri)
        filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out, self.bits, self.block_ids = filesystem.open_output_stream(path), bits, block_ids
        self.out.write(_HEAD.pack(b"TMBP", 1, bits, block_ids))
        self.at, self.pending, self.n_ids = _HEAD.size, np.zeros(0, np.int32), 0
        self.blocks: list[int] = []
        self.doc_ids, self.null, self.starts = array("q"), array("B"), array("Q")

    def add(self, doc_ids: list[int | None], ids: np.ndarray, where: np.ndarray) -> None:
        """Documents with these ids; ``where`` has the first id of each and the total."""
        self.doc_ids.extend(d or 0 for d in doc_ids)
        self.null.extend(d is None for d in doc_ids)
        self.starts.frombytes((np.asarray(where[: len(doc_ids)]) + self.n_ids).astype(np.uint64).tobytes())
        self.n_ids += len(ids)
        self.pending = np.concatenate([self.pending, ids])
        whole = len(self.pending) // self.block_ids * self.block_ids
        for a in range(0, whole, self.block_ids):
            self._block(self.pending[a: a + self.block_ids])
        self.pending = self.pending[whole:]

    def _block(self, ids: np.ndarray) -> None:
        raw = pack_bits(ids, self.bits)
        self.blocks.append(self.at)
        self.out.write(raw)
        self.at += len(raw)

    def close(self) -> None:
        if len(self.pending):
            self._block(self.pending)
        for column, kind in ((self.blocks, "<u8"), (self.doc_ids, "<i8"), (self.null, "u1"), (self.starts, "<u8")):
            self.out.write(np.asarray(column, kind).tobytes())
        self.out.write(_FOOT.pack(self.at, len(self.blocks), len(self.doc_ids), self.n_ids, b"TMBP"))
        self.out.close()


class StoreReader:
    """Random access to the ids of one file."""

    def __init__(self, uri: str):
        filesystem, path = _filesystem(uri)
        self.file = filesystem.open_input_file(path)
        size = self.file.size()
        index, n_blocks, n_docs, self.n_ids, magic = _FOOT.unpack(self.file.read_at(_FOOT.size, size - _FOOT.size))
        head, _, self.bits, self.block_ids = _HEAD.unpack(self.file.read_at(_HEAD.size, 0))
        if magic != b"TMBP" or head != b"TMBP":
            raise ValueError(f"not a token file: {uri}")
        raw = self.file.read_at(size - _FOOT.size - index, index)
        self.blocks = np.append(np.frombuffer(raw, "<u8", n_blocks), np.uint64(index)).astype(np.int64)
        at = 8 * n_blocks
        self.doc_ids = np.frombuffer(raw, "<i8", n_docs, at)
        self.null = np.frombuffer(raw, "u1", n_docs, at + 8 * n_docs).astype(bool)
        self.starts = np.append(np.frombuffer(raw, "<u8", n_docs, at + 9 * n_docs).astype(np.int64), self.n_ids)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """The ids at positions [begin, end) of the file, from their blocks alone."""
        if end <= begin:
            return np.zeros(0, "<u4")
        first, last = begin // self.block_ids, (end - 1) // self.block_ids
        raw = self.file.read_at(self.blocks[last + 1] - self.blocks[first], self.blocks[first])
        out = []
        for b in range(first, last + 1):
            n = min(self.block_ids, self.n_ids - b * self.block_ids)
            a = self.blocks[b] - self.blocks[first]
            out.append(unpack_bits(raw[a: a + -(-n * self.bits // 8)], self.bits, n))
        return np.concatenate(out)[begin - first * self.block_ids: end - first * self.block_ids]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


def _write(folder: str, tokenizer: str, bits: int, end_id: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, task, writer = encoder_for(tokenizer), TaskContext.get(), None
        path = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.ids"
        for batch in batches:
            docs = [None if d is None else int(d) for d in batch["doc_id"]]
            for begin, end, ids, where, _ in encoder.each(batch["text"]):
                if writer is None:
                    writer = StoreWriter(path, bits)
                whole = np.insert(ids, where[1:], end_id)
                writer.add(docs[begin:end], whole, where[:-1] + np.arange(end - begin))
        if writer is not None:
            writer.close()
            yield pd.DataFrame({"part": [task.partitionId()], "path": [path], "n_docs": [len(writer.doc_ids)],
                                "n_ids": [writer.n_ids]})
    return run


def write_tokens(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", folder: str | None = None, partitions: int | None = None) -> DataFrame:
    """Write the store and return its manifest: part, path, n_docs, n_ids, and start (ids of all files before)."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    if partitions is None:
        held = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        # no fewer than the session's tasks, so that a small table is not encoded by one
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held // FILE_BYTES))
    as_text = F.col("doc_id").cast("string")  # pandas has no integers with nulls
    place = ["doc_id", F.xxhash64("text"), "row"]
    ordered = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(partitions, *place).sortWithinPartitions(
        *place).select(as_text.alias("doc_id"), "text")
    written = staged(ordered.mapInPandas(_write(folder, tokenizer, bits_for(vocabulary), end_id), _MANIFEST), "manifest")
    # one row per file
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return written.withColumn("start", F.coalesce(before, F.lit(0)))


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples(index=False):
            reader = StoreReader(row.path)
            n, a = len(reader.doc_ids), 0
            while a < n:  # about a million ids at a time; a longer document alone
                b = max(a + 1, int(np.searchsorted(reader.starts, reader.starts[a] + (1 << 20), side="right")) - 1)
                b = min(b, n)
                raw = reader.ids(int(reader.starts[a]), int(reader.starts[b])).tobytes()
                place = (reader.starts[a: b + 1] - reader.starts[a]) * 4
                yield pd.DataFrame({
                    "doc_id": pd.array(reader.doc_ids[a:b], "Int64").copy() if not reader.null[a:b].any()
                    else pd.array([None if m else int(d) for d, m in zip(reader.doc_ids[a:b], reader.null[a:b])], "Int64"),
                    "start": reader.starts[a:b] + row.start, "n_tokens": np.diff(reader.starts[a: b + 1]),
                    "ids_crc32": [zlib.crc32(raw[p:q]) for p, q in zip(place[:-1].tolist(), place[1:].tolist())]})
                a = b


def read_digests(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    files = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(files).mapInPandas(_read, _READ)  # one row per file
