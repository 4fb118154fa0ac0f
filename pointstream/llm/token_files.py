"""Token ids in files of fixed-width bit packing.

An id takes the fewest bits that hold every id of the vocabulary. A file is

    magic ``TBP1`` | bits, ids per block, blocks, documents (32 bits each) |
    ids (64 bits) | byte offset of each block, and of the end (64 bits each) |
    document ids, -1 << 63 for null (64 bits each) | first id of each document, and the
    number of all (64 bits each) | blocks

all little-endian; in a block, ids follow each other from the highest bit on, and its end
is filled to a whole byte. Any range of ids is read by unpacking only its blocks.

Files are rows of a Parquet table in the shared folder, so that they can lie in any store
that Spark writes to: a row has the shard, the file's number in it, the ids of the shard
before it, and the file. Documents are in ascending order of id (null first), then text;
shards are ranges of that order. A file ends at the first document's end at or beyond
``FILE_IDS`` ids.

A null text is empty, and each document ends with ``END``. Repeated rows are repeated
documents. An empty table gives no files. Other columns are ignored.
"""

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from pointstream.llm.cached_tokens import byte_level, release
from pointstream.llm.frames import kept, tidied

END = 0
BLOCK_IDS = 1 << 14
FILE_IDS = 1 << 18
_MAGIC = b"TBP1"
_NULL = -(1 << 63)


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def packed(ids: np.ndarray, bits: int) -> bytes:
    raw = ids.astype(">u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:
        return raw[:, 4 - bits // 8 :].tobytes()
    return np.packbits(np.unpackbits(raw, axis=1)[:, 32 - bits :]).tobytes()


def unpacked(body: bytes, bits: int, count: int) -> np.ndarray:
    raw = np.frombuffer(body, dtype=np.uint8)
    out = np.zeros((count, 4), dtype=np.uint8)
    if bits % 8 == 0:
        out[:, 4 - bits // 8 :] = raw.reshape(count, bits // 8)
    else:
        wide = np.zeros((count, 32), dtype=np.uint8)
        wide[:, 32 - bits :] = np.unpackbits(raw, count=count * bits).reshape(count, bits)
        out = np.packbits(wide, axis=1)
    return out.view(">u4").reshape(-1).astype("<u4")


def file_of(documents: list[int | None], ids: list[np.ndarray], bits: int) -> bytes:
    """A file of some documents and their ids."""
    starts = np.cumsum([0] + [len(i) for i in ids]).astype("<u8")
    flat = np.concatenate([*ids, np.zeros(0, dtype="<u4")])
    blocks = [packed(flat[a : a + BLOCK_IDS], bits) for a in range(0, len(flat), BLOCK_IDS)]
    names = np.array([_NULL if d is None else d for d in documents], dtype="<i8")
    head = 4 + 16 + 8 + 8 * (len(blocks) + 1) + 8 * len(names) + 8 * len(starts)
    offsets = head + np.cumsum([0] + [len(b) for b in blocks]).astype("<u8")
    counts = struct.pack("<IIIIQ", bits, BLOCK_IDS, len(blocks), len(names), len(flat))
    parts = [_MAGIC, counts, offsets.astype("<u8").tobytes(), names.tobytes(), starts.tobytes()]
    return b"".join(parts + blocks)


class TokenFile:
    """Random access to a file: documents, and any range of ids."""

    def __init__(self, body: bytes):
        if body[:4] != _MAGIC:
            raise ValueError("not a token file")
        self.body = body
        self.bits, self.block, blocks, documents, self.count = struct.unpack_from("<IIIIQ", body, 4)
        at = 28
        self.offsets = np.frombuffer(body, "<u8", blocks + 1, at).astype(np.int64)
        at += 8 * (blocks + 1)
        self.documents = np.frombuffer(body, "<i8", documents, at)
        at += 8 * documents
        self.starts = np.frombuffer(body, "<u8", documents + 1, at).astype(np.int64)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids from ``begin`` to ``end``, unpacking only the blocks they are in."""
        if begin >= end:
            return np.zeros(0, dtype="<u4")
        first, last = begin // self.block, (end - 1) // self.block
        out = []
        for b in range(first, last + 1):
            count = min(self.block, self.count - b * self.block)
            out.append(unpacked(self.body[self.offsets[b] : self.offsets[b + 1]], self.bits, count))
        return np.concatenate(out)[begin - first * self.block : end - first * self.block]


def write_token_files(
    docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Writes the files and returns their table: shard, file, first, ids, body."""
    ordered = (
        docs.select(F.col(id_column).cast("bigint").alias("doc"), F.col(text).alias("text"))
        .repartitionByRange("doc", F.xxhash64("text"))
        .sortWithinPartitions("doc", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_level(vocabulary, special=True)
        bits = bits_for(encoder.vocabulary_size())
        shard = TaskContext.get().partitionId()
        end = np.array([END], dtype="<u4")
        names, bodies, size, number, first = [], [], 0, 0, 0

        def row() -> pa.RecordBatch:
            body = file_of(names, bodies, bits)
            columns = [[shard], [number], [first], [size], [body]]
            types = pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["shard", "file", "first", "ids", "body"],
            )

        try:
            for batch in batches:
                for at, found in encoder.encode_parts(batch.column("text")):
                    rows = batch.column("doc").slice(at, len(found)).to_pylist()
                    for doc, ids in zip(rows, found):
                        names.append(doc)
                        bodies.append(np.concatenate([ids, end]))
                        size += len(ids) + 1
                        if size >= FILE_IDS:
                            yield row()
                            first, number = first + size, number + 1
                            names, bodies, size = [], [], 0
            if names:
                yield row()
        finally:
            release()

    files = ordered.mapInArrow(write, "shard int, file int, first bigint, ids bigint, body binary")
    return kept(docs.sparkSession, files, "token-files")


def read_documents(files: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per document, from the files: its first id's place among all, its ids' number and crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards, firsts = (batch.column(n).to_pylist() for n in ("shard", "first"))
            for shard, first, body in zip(shards, firsts, batch.column("body")):
                file = TokenFile(body.as_py())
                ids = file.ids(0, file.count)
                ends = zip(file.starts[:-1], file.starts[1:])
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in ends]
                names = pa.array(file.documents, mask=file.documents == _NULL)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard] * len(names), pa.int32()),
                        names,
                        pa.array(file.starts[:-1] + first),
                        pa.array(np.diff(file.starts)),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["shard", id_column, "at", "n_tokens", "ids_crc32"],
                )

    found = files.select("shard", "first", "body").mapInArrow(
        tidied(read), f"shard int, `{id_column}` bigint, at bigint, n_tokens bigint, ids_crc32 bigint"
    )
    # One row per shard, that is, per partition of the writing job.
    sizes = files.groupBy("shard").agg(F.sum("ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    return found.join(F.broadcast(shards), "shard").select(
        id_column, (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
