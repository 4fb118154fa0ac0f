"""Benchmark decontamination by a broadcast hash set of test n-grams.

A word is a run of ASCII letters (lower-cased), digits and non-ASCII characters. A
window is ten consecutive words of a benchmark item; an item of fewer, but not none, is
one window. Documents are scanned once: the hashes of their windows are looked up in the
broadcast set, and every hit is verified on the words themselves.

The set is bounded: a benchmark of more than ``BLOCK_WINDOWS`` windows is cut by window
hash into blocks of about that size, and the documents are scanned once per block, the
table being written in between. No shuffle of documents, whatever the sizes.

A null or empty text has no words and no hits; a benchmark item without words has no
windows, and an empty benchmark hits nothing. Items are told apart by id, so repeated
rows count once; a null id reads as an empty text. Document rows are independent of each
other and repeated rows give repeated results. Other columns stay; one named like a result
gives way to it in ``contamination`` and stays in the two operators that remove.
"""

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from pointstream.llm.frames import kept, set_aside, tidied, without
from pointstream.llm.words import ALNUM_WORDS, Part, Tokens, lowered, parts

WINDOW = 10
# Windows of one broadcast set; with the words of a window about 100 MB.
BLOCK_WINDOWS = 500_000

_FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def _window_text(part: Part, found: Tokens, at: int, size: int) -> bytes:
    return b" ".join(
        lowered(part.data[a:b].tobytes())
        for a, b in zip(found.start[at : at + size], found.end[at : at + size])
    )


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct windows of all items: item, size, hash and words."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, sizes, hashes, texts = [], [], [], []
            for part in parts(batch.column("text")):
                found = part.tokens(ALNUM_WORDS)
                counts = np.diff(found.first)
                for size in range(1, WINDOW + 1):
                    at, h = found.windows(size)
                    row = found.row()[at]
                    if size < WINDOW:
                        at, h, row = (x[counts[row] == size] for x in (at, h, row))
                    items += [batch.column("item")[part.row + int(r)].as_py() for r in row]
                    sizes += [size] * len(at)
                    hashes += h.astype(np.int64).tolist()
                    texts += [_window_text(part, found, int(a), size) for a in at]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(items, pa.string()),
                    pa.array(sizes, pa.int32()),
                    pa.array(hashes, pa.int64()),
                    pa.array(texts, pa.binary()),
                ],
                names=["item", "size", "hash", "words"],
            )

    item = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    rows = benchmark.select(item.alias("item"), "text")
    return rows.mapInArrow(tidied(windows), "item string, size int, hash bigint, words binary").distinct()


class WindowSet:
    """Windows of a block: sorted hashes by size, and the items of each window."""

    def __init__(self, rows):
        by_size = defaultdict(set)
        self.items = defaultdict(set)
        for row in rows:
            by_size[row["size"]].add(row["hash"])
            self.items[bytes(row["words"])].add(row["item"])
        self.hashes = {
            size: np.sort(np.array(list(found), dtype=np.int64).astype(np.uint64))
            for size, found in by_size.items()
        }

    def hits(self, part: Part, found: Tokens) -> list[tuple[int, int, set[str]]]:
        """Verified occurrences: first word, size and items."""
        hits = []
        for size, known in self.hashes.items():
            at, h = found.windows(size)
            near = np.minimum(np.searchsorted(known, h), len(known) - 1)
            for a in at[known[near] == h]:
                items = self.items.get(_window_text(part, found, int(a), size))
                if items:
                    hits.append((int(a), size, items))
        return hits


def _joined(ranges: list[list[int]]) -> list[list[int]]:
    """Ranges of words in order, those that touch or overlap as one."""
    out = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def _scan(docs: DataFrame, text: str, known: Broadcast, first: bool) -> DataFrame:
    """Adds hits of one block, or joins them to those of the blocks before."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, hits, items = [], [], []
            for part in parts(batch.column(text)):
                found = part.tokens(ALNUM_WORDS)
                words += np.diff(found.first).tolist()
                ranges, names = defaultdict(list), defaultdict(set)
                row = found.row()
                for a, size, which in known.value.hits(part, found):
                    r = int(row[a])
                    a -= int(found.first[r])
                    ranges[r].append([a, a + size])
                    names[r] |= which
                for r in range(len(part)):
                    old_hits, old_items = [], set()
                    if not first:
                        old_hits = batch.column("hits")[part.row + r].as_py()
                        old_items = set(batch.column("items")[part.row + r].as_py())
                    hits.append(_joined(old_hits + ranges[r]) if ranges[r] else old_hits)
                    items.append(sorted(old_items | names[r]))
            made = [
                pa.array(words, pa.int64()),
                pa.array(hits, pa.list_(pa.list_(pa.int32()))),
                pa.array(items, pa.list_(pa.string())),
            ]
            given = [n for n in batch.schema.names if first or n not in _FOUND.names]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in given] + made, names=given + _FOUND.names
            )

    given = [f for f in docs.schema.fields if first or f.name not in _FOUND.names]
    return docs.mapInArrow(tidied(scan), T.StructType(given + _FOUND.fields))


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", block: int = BLOCK_WINDOWS
) -> DataFrame:
    """Adds ``n_words``, ``hits`` (ranges of hit words, end exclusive) and ``items``."""
    docs = docs.select(*(f"`{c}`" for c in without(docs.columns, _FOUND.names)))
    spark = docs.sparkSession
    windows = kept(spark, benchmark_windows(benchmark), "benchmark-windows")
    blocks = max(1, -(-windows.count() // block))
    found = docs
    for number in range(blocks):
        rows = windows.filter(F.pmod(F.xxhash64("hash"), F.lit(blocks)) == number)
        known = spark.sparkContext.broadcast(WindowSet(rows.toLocalIterator()))
        if number:
            found = kept(spark, found, "contamination")
        found = _scan(found, text, known, first=number == 0)
    return found


def n_hit() -> F.Column:
    """Number of hit words."""
    return F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, r: n + r[1] - r[0])


def without_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without a hit, columns unchanged."""
    aside, back = set_aside(docs, _FOUND.names)
    return back(contamination(aside, benchmark, text).filter(F.size("hits") == 0))


def without_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """All documents, the hit words and what stands between them cut out of the texts."""
    aside, back = set_aside(docs, _FOUND.names)
    found = contamination(aside, benchmark, text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column(text)
            texts = given.to_pylist()
            hits = batch.column("hits").to_pylist()
            for part in parts(given):
                where = part.tokens(ALNUM_WORDS)
                for r in range(len(part)):
                    ranges = hits[part.row + r]
                    if not ranges:
                        continue
                    at, out = int(part.offsets[r]), []
                    for low, high in ranges:
                        low, high = low + where.first[r], high + where.first[r] - 1
                        out.append(part.data[at : where.start[low]].tobytes())
                        at = int(where.end[high])
                    out.append(part.data[at : part.offsets[r + 1]].tobytes())
                    texts[part.row + r] = b"".join(out).decode()
            columns = [
                pa.array(texts, given.type) if name == text else batch.column(name)
                for name in names
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = aside.columns
    return back(found.mapInArrow(tidied(cut), aside.schema))
