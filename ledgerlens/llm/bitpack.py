"""Token-id files: fixed-width bit packing with block offsets.

``write_ids`` sorts documents by id over shards (range partitioning), encodes
them and writes one file a shard; ``read_documents`` reads the files back.

File layout (little-endian): ``LLBITS01``, u32 bits, u32 ids a block; blocks of
``block`` ids, each id in ``bits`` bits, every block starting on a byte (the
last block may hold fewer); then the footer: u64 byte offset of each block and
of the end of the last, i64 doc id, u8 whether it is not null, u64 id count of
each document; then u64 blocks, u64 documents, u64 ids, ``LLBITSND``. ``bits``
is the least width that holds every id of the vocabulary. A reader finds any id
range from the block offsets alone and unpacks whole blocks with numpy.

Files carry a name of their own per attempt; the manifest, a Parquet table that
Spark commits, says which of them count, so lost or repeated tasks do no harm.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import wordids
from ledgerlens.llm.common import text_slices, written
from ledgerlens.session import scratch_path

START, END = b"LLBITS01", b"LLBITSND"
BLOCK_IDS = 4096
READ_IDS = 1 << 20  # ids that a reader holds at a time

MANIFEST = "shard long, path string, n_docs long, n_ids long"
READ_BACK = "doc_id long, start long, n_tokens long, ids_crc32 long"


def bits_for(vocabulary: int) -> int:
    """Least width in bits for ids 0 .. vocabulary - 1 (1 at least)."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, the lowest bit first, padded to a byte."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if bits in (8, 16, 32):
        return np.ascontiguousarray(ids, dtype=f"<u{bits // 8}").tobytes()
    wide = np.unpackbits(np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(wide[:, :bits].ravel(), bitorder="little").tobytes()


def unpack(raw: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of a packed block (uint32)."""
    if bits in (8, 16, 32):
        return np.frombuffer(raw, dtype=f"<u{bits // 8}", count=n).astype(np.uint32)
    narrow = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = narrow
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


class Writer:
    """Writes documents' ids to a stream, block by block."""

    def __init__(self, out, bits: int, block: int = BLOCK_IDS):
        self.out, self.bits, self.block = out, bits, block
        self.at = out.write(START + np.array([bits, block], "<u4").tobytes())
        self.offsets, self.waiting, self.docs, self.counts, self.ids = [self.at], [], [], [], 0
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.counts.append(len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        self.ids += len(ids)
        if self.held >= 64 * self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        end = len(ids) if last else len(ids) - len(ids) % self.block
        for lo in range(0, end, self.block):
            self.at += self.out.write(pack(ids[lo : min(lo + self.block, end)], self.bits))
            self.offsets.append(self.at)
        self.waiting, self.held = [ids[end:]], len(ids) - end

    def close(self) -> None:
        self._flush(True)
        there = np.array([d is not None for d in self.docs], np.uint8)
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        self.out.write(np.array([d or 0 for d in self.docs], "<i8").tobytes())
        self.out.write(there.tobytes())
        self.out.write(np.array(self.counts, "<u8").tobytes())
        self.out.write(np.array([len(self.offsets) - 1, len(self.docs), self.ids], "<u8").tobytes() + END)
        self.out.close()


class Reader:
    """Random access to the ids of one file."""

    def __init__(self, file):
        self.file, size = file, file.size()
        tail = self._at(size - 32, 32)
        head = self._at(0, 16)
        if head[:8] != START or tail[24:] != END:
            raise ValueError("not a packed id file")
        self.bits, self.block = (int(x) for x in np.frombuffer(head[8:], "<u4"))
        blocks, docs, self.n_ids = (int(x) for x in np.frombuffer(tail[:24], "<u8"))
        foot = self._at(size - 32 - 17 * docs - 8 * (blocks + 1), 17 * docs + 8 * (blocks + 1))
        cut = 8 * (blocks + 1)
        self.offsets = np.frombuffer(foot[:cut], "<u8").astype(np.int64)
        ids = np.frombuffer(foot[cut : cut + 8 * docs], "<i8")
        there = np.frombuffer(foot[cut + 8 * docs : cut + 9 * docs], np.uint8)
        self.doc_ids = [int(d) if t else None for d, t in zip(ids, there, strict=True)]
        self.starts = np.concatenate([[0], np.cumsum(np.frombuffer(foot[cut + 9 * docs :], "<u8").astype(np.int64))])

    def _at(self, offset: int, n: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(n)

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo .. hi - 1 of the file: only their blocks are read."""
        if hi <= lo:
            return np.zeros(0, np.uint32)
        first, last = lo // self.block, (hi - 1) // self.block
        raw = self._at(int(self.offsets[first]), int(self.offsets[last + 1] - self.offsets[first]))
        base = int(self.offsets[first])
        parts = [
            unpack(raw[int(self.offsets[b]) - base : int(self.offsets[b + 1]) - base], self.bits, min(self.block, self.n_ids - b * self.block))
            for b in range(first, last + 1)
        ]
        return np.concatenate(parts)[lo - first * self.block : hi - first * self.block]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc id, start in the file, ids) of every document, in file order."""
        i, n = 0, len(self.doc_ids)
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.starts, self.starts[i] + READ_IDS, side="right")) - 1)
            base = int(self.starts[i])
            held = self.ids(base, int(self.starts[j]))
            for k in range(i, j):
                yield self.doc_ids[k], int(self.starts[k]), held[self.starts[k] - base : self.starts[k + 1] - base]
            i = j


def open_fs(uri: str):
    """(filesystem, path) of a path in any store that pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def as_uri(path: str) -> str:
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


def write_ids(
    docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 2, vocabulary: int = wordids.VOCABULARY, block: int = BLOCK_IDS
) -> DataFrame:
    """Encode ``docs`` (doc_id, text; other columns are ignored) and write them
    in ascending doc id (null ids first, ties by text); returns the manifest.

    A null text is empty and holds ``end_id`` only; an empty table writes no
    file. ``folder`` must be reachable by every executor.
    """
    path, bits, where = tokenizer or wordids.default_path(), bits_for(vocabulary), as_uri(folder)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, writer, n = wordids.word_ids(path), None, TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for lo, hi in text_slices(batch):
                part = batch.slice(lo, hi - lo)
                if writer is None:
                    name = f"shard-{n:07d}-{uuid.uuid4().hex[:12]}.bits"
                    store, base = open_fs(where)
                    store.create_dir(base, recursive=True)
                    writer = Writer(store.open_output_stream(f"{base}/{name}"), bits, block)
                flat, at = coder.encode_column(part.column("text"))
                for d, a, b in zip(part.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                    writer.add(d, np.concatenate([flat[a:b], end]))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": [n], "path": [f"{where}/{name}"], "n_docs": [len(writer.docs)], "n_ids": [writer.ids]}
            )

    ordered = (
        docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text", "xxhash64(text) AS _tie")
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie", "text")
        .select("doc_id", "text")
    )
    return written(ordered.mapInArrow(shard, MANIFEST), "id-manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """One row a document from the files of a manifest: doc_id, start (ids of
    all documents before it), n_tokens, ids_crc32 (of its ids as u32)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, base = open_fs(row["path"])
                rows: list[tuple] = []
                with store.open_input_file(base) as file:
                    for doc, start, ids in Reader(file).documents():
                        rows.append((doc, row["base"] + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # One row a file: a running sum over the shards' sizes, not over documents.
    bases = manifest.selectExpr(
        "shard", "path",
        "coalesce(sum(n_ids) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS base",
    )
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return bases.repartition(parts, "shard").mapInArrow(read, READ_BACK)


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write and read back under the shared folder (see above)."""
    return read_documents(write_ids(docs, scratch_path(spark, "token-ids"), tokenizer))
