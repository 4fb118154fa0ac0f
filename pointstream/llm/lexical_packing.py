"""Packing by lexical retrieval: documents that share rare words share a sequence.

Documents are tokenized once. Of a long one, full windows are sequences of their own. The
rests of all documents are sorted by content and cut into shards of ``SHARD_TOKENS``
tokens. They are sorted by key: the first ``KEY_TERMS`` of a rest's token ids in a random
order in which rare ids tend to come first, of those that another document holds too. Two
rests have the same first id by the chance that their weighted ids overlap, whatever the
number of shards; a key of very many documents is split by its next ids and at last by
row, and small ones share a shard. Neighbours whose keys differ may still lie in
different shards.

A shard is an inverted index: for each token id the documents
that hold it, with BM25 weights from document frequencies and the mean length over all
documents, whole ones; a seed's own ids are all looked up. The longest
unused document is the seed of a sequence; the index returns unused neighbours, best
first, which fill the window. The last one is cut to fit and what is left of it is the
next seed, so only a shard's last sequence is padded.

A shard's size does not grow with the corpus. Rows are dealt by ranges of key and row, so
a hot source or many copies do not gather in one task.

A very long text is tokenized whole, and only its rest, less than a window, goes on to a
shard. A null text is empty: one end token. Repeated rows are repeated documents; a null id is
carried along. Equal scores go by row. An empty table gives an empty one; other columns
are ignored.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from pointstream.llm.cached_tokens import release, word_level
from pointstream.llm.frames import kept, tidied

END = 1
WINDOW = 2048
SHARD_TOKENS = 1 << 20
# Shards that a task makes, one after the other.
TASK_SHARDS = 4
# Ids by which rests are sorted.
KEY_TERMS = 4
# An id that one of so many of a shard's documents holds has a full row, if there are not
# more such ids than that; the others have lists.
COMMON, MOST_ROWS = 8, 1024
# BM25 saturation and length normalisation.
K1, B = 1.2, 0.75

_TOKENIZED = "doc bigint, row bigint, size bigint, full array<bigint>, rest binary, held int"
_PIECES = "doc bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokenized(
    docs: DataFrame, vocabulary: str, id_column: str, text: str, **memory: int | None
) -> DataFrame:
    """Per row: ids' number, crc32 of each full window, and the ids of the rest.

    The rest is kept in 16 bits where the vocabulary allows it; ``held`` is its tokens. A
    task's last row is none of a document: its ``full`` has the ids that the task's
    documents hold, each followed by the number of those documents; ``row`` is null.
    """

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_level(vocabulary, special=True, **memory)
        size = encoder.vocabulary_size()
        width = "<u2" if size <= 1 << 16 else "<u4"
        row = TaskContext.get().partitionId() << 40
        end = np.array([END], dtype="<u4")
        seen = np.zeros(size, dtype=np.int64)
        # Of the documents of a part, which are fewer than 16 bits can count.
        some, mark = np.zeros(size, dtype=np.uint16), np.zeros(size, dtype=np.uint16)
        try:
            for batch in batches:
                for at, found in encoder.encode_parts(batch.column("text")):
                    sizes, full, rest, held = [], [], [], []
                    for body in found:
                        ids = np.concatenate([body, end])
                        mark[ids] = 1
                        some += mark
                        mark[ids] = 0
                        whole = len(ids) // WINDOW * WINDOW
                        sizes.append(len(ids))
                        full.append([_crc(ids[a : a + WINDOW]) for a in range(0, whole, WINDOW)])
                        rest.append(ids[whole:].astype(width).tobytes())
                        held.append(len(ids) - whole)
                    seen += some
                    some[:] = 0
                    rows = np.arange(row, row + len(found))
                    yield _rows(batch.column("doc").slice(at, len(found)), rows, sizes, full, rest, held)
                    row += len(found)
            ids = np.flatnonzero(seen)
            pairs = np.stack([ids, seen[ids]], axis=1).ravel()
            yield _rows(pa.nulls(1, pa.int64()), [None], [0], [pairs], [b""], [0])
        finally:
            release()

    given = docs.select(F.col(id_column).cast("bigint").alias("doc"), F.col(text).alias("text"))
    return given.mapInArrow(tokenize, _TOKENIZED)


def _rows(docs: pa.Array, rows, sizes: list, full: list, rest: list, held: list) -> pa.RecordBatch:
    columns = [
        docs,
        pa.array(rows, pa.int64()),
        pa.array(sizes, pa.int64()),
        pa.array(full, pa.list_(pa.int64())),
        pa.array(rest, pa.binary()),
        pa.array(held, pa.int32()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["doc", "row", "size", "full", "rest", "held"])


def _width(table) -> str:
    """Type of the ids of the rests, from their sizes."""
    body, held = table.column("rest"), table.column("held")
    for b, n in zip(body, held):
        if n.as_py():
            return "<u2" if len(b.as_py()) == 2 * n.as_py() else "<u4"
    return "<u2"


def _document_frequencies(rows: DataFrame) -> dict[int, int]:
    """Documents that hold each token id; at most one entry per id of the vocabulary."""
    pairs = F.transform(F.sequence(F.lit(0), F.size("full") - 1, F.lit(2)), lambda i: F.struct(
        F.get("full", i).alias("id"), F.get("full", i + 1).alias("n")
    ))
    each = rows.filter("row IS NULL AND size(full) > 0").select(F.inline(pairs))
    return {r["id"]: r["n"] for r in each.groupBy("id").agg(F.sum("n").alias("n")).collect()}


_KEY = [f"key_{i}" for i in range(KEY_TERMS)]


def _order(idf: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Places of all ids in one random order, in which rare ones tend to come first.

    The first id of a document in this order is a min-hash weighted by squared IDF. Ids
    that are not shared come last.
    """
    draw = np.random.default_rng(0).exponential(size=len(idf))
    draw = np.where(shared, draw / np.maximum(idf.astype(float), 1e-9) ** 2, np.inf)
    order = np.empty(len(idf), dtype=np.uint16 if len(idf) <= 1 << 16 else np.uint32)
    order[np.argsort(draw, kind="stable")] = np.arange(len(idf))
    return order


def _key(ids: np.ndarray, order: np.ndarray, shared: int) -> list[int]:
    """The first places that a document's shared ids have; -1 where there are no more."""
    places, key = order[ids], []
    while len(key) < KEY_TERMS:
        places = places[places < shared]
        if not len(places):
            break
        key.append(int(places.min()))
        places = places[places != key[-1]]
    return key + [-1] * (KEY_TERMS - len(key))


def _keyed(rows: DataFrame, order, shared: int) -> DataFrame:
    """Adds the key of each rest; ``order`` is broadcast."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = _width(batch)
            bodies = [np.frombuffer(b, dtype=width) for b in batch.column("rest").to_pylist()]
            keys = [_key(ids, order.value, shared) for ids in bodies]
            made = np.array(keys, dtype=np.int32).reshape(-1, KEY_TERMS).T
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(np.ascontiguousarray(k)) for k in made)],
                names=[*batch.schema.names, *_KEY],
            )

    return rows.mapInArrow(tidied(add), ", ".join([_TOKENIZED, *(f"{k} int" for k in _KEY)]))


class Index:
    """Inverted index of a shard's documents, with BM25 weights.

    The postings of ids that many of the documents hold are kept as full rows, a weight
    for every document, so that those of a seed are added up at once.
    """

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean_length: float):
        held = [np.unique(i, return_counts=True) for i in ids]
        self.terms = [t for t, _ in held]
        term = np.concatenate(self.terms)
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), [len(t) for t in self.terms])
        tf = np.concatenate([n for _, n in held]).astype(np.float32)
        length = np.array([len(i) for i in ids], dtype=np.float32)
        norm = K1 * (1 - B + B * length / mean_length)
        weight = (idf[term] * tf * (K1 + 1) / (tf + norm[doc])).astype(np.float32)
        holders = np.bincount(term, minlength=len(idf))
        common = np.flatnonzero(holders * COMMON >= len(ids))[:MOST_ROWS]
        self.row = np.full(len(idf), -1, dtype=np.int32)
        self.row[common] = np.arange(len(common))
        rows = self.row[term]
        full = rows >= 0
        self.full = np.zeros((len(common), len(ids)), dtype=np.float32)
        self.full[rows[full], doc[full]] = weight[full]
        #: Documents of the full rows' columns.
        self.columns = np.arange(len(ids))
        order = np.flatnonzero(~full)
        order = order[np.argsort(term[order], kind="stable")]
        self.term, self.doc, self.weight = term[order], doc[order], weight[order]
        self.ids = np.arange(len(idf) + 1)
        self.begin = np.searchsorted(self.term, self.ids).tolist()
        self.free = np.ones(len(ids), dtype=bool)

    def _shrunk(self) -> None:
        """Take used documents out of the postings, once a quarter of them are used."""
        if 4 * int(self.free.sum()) > 3 * len(self.columns):
            return
        stay = self.free[self.doc]
        self.term, self.doc, self.weight = self.term[stay], self.doc[stay], self.weight[stay]
        self.begin = np.searchsorted(self.term, self.ids).tolist()
        stay = self.free[self.columns]
        self.full, self.columns = self.full[:, stay], self.columns[stay]

    def neighbours(self, seed: int) -> Iterator[int]:
        """Unused documents that share a token with the seed, best first."""
        self._shrunk()
        terms, begin = self.terms[seed], self.begin
        rows = self.row[terms]
        asked = np.zeros(len(self.full), dtype=np.float32)
        asked[rows[rows >= 0]] = 1
        rare = terms[rows < 0].tolist()
        places = [slice(begin[t], begin[t + 1]) for t in rare if begin[t] < begin[t + 1]]
        score = np.zeros(len(self.free))
        if places:
            doc = np.concatenate([self.doc[p] for p in places])
            weight = np.concatenate([self.weight[p] for p in places])
            score = np.bincount(doc, weight, minlength=len(self.free))
        score[self.columns] += asked @ self.full
        score[~self.free] = 0
        found = np.flatnonzero(score)
        yield from found[np.argsort(-score[found], kind="stable")].tolist()


def _pack(docs: list[tuple], index: Index | None, sequence: int) -> list[tuple]:
    """Pieces of a shard: document, start, length, crc, document's tokens, sequence, offset.

    Sequences are numbered from the given one; the last piece has the highest number.
    """
    out = []
    for doc, size, full, _ in docs:
        for number, crc in enumerate(full):
            out.append((doc, number * WINDOW, WINDOW, crc, size, sequence, 0))
            sequence += 1
    if index is None:
        return out
    free = index.free
    free[[not len(ids) for *_, ids in docs]] = False
    by_length = sorted(range(len(docs)), key=lambda i: (-len(docs[i][3]), i))
    room, at = WINDOW, 0

    def place(i: int, begin: int, length: int) -> None:
        nonlocal room
        doc, size, full, ids = docs[i]
        crc = _crc(ids[begin : begin + length])
        start = len(full) * WINDOW + begin
        out.append((doc, start, length, crc, size, sequence, WINDOW - room))
        room -= length

    left = None  # what is left of a document that was cut: its number and first id
    while True:
        if left is None:
            while at < len(by_length) and not free[by_length[at]]:
                at += 1
            if at == len(by_length):
                return out
            seed, begin = by_length[at], 0
            free[seed] = False
        else:
            (seed, begin), left = left, None
        length = min(room, len(docs[seed][3]) - begin)
        place(seed, begin, length)
        if room:
            for i in index.neighbours(seed):
                free[i] = False
                length = min(room, len(docs[i][3]))
                place(i, 0, length)
                if length < len(docs[i][3]):
                    left = (i, length)
                if not room:
                    break
        elif begin + length < len(docs[seed][3]):
            left = (seed, begin + length)
        if not room:
            sequence, room = sequence + 1, WINDOW


def packed(
    docs: DataFrame,
    vocabulary: str,
    id_column: str = "doc_id",
    text: str = "text",
    cache_bytes: int | None = None,
    part_bytes: int | None = None,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``WINDOW`` tokens.

    ``cache_bytes`` and ``part_bytes`` bound what a worker holds for tokenizing.
    """
    spark = docs.sparkSession
    every = kept(spark, tokenized(
        docs, vocabulary, id_column, text, cache_bytes=cache_bytes, part_bytes=part_bytes
    ), "tokenized")
    seen = _document_frequencies(every)
    rows = every.filter("row IS NOT NULL")
    total = rows.agg(
        F.sum("held").alias("held"), F.sum("size").alias("size"), F.count("*").alias("n")
    ).first()
    held, documents = total["held"] or 0, max(1, total["n"])
    shards = max(1, -(-held // SHARD_TOKENS))
    n = np.zeros(max(seen, default=0) + 1)
    n[list(seen)] = list(seen.values())
    idf = np.log1p((documents - n + 0.5) / (n + 0.5)).astype(np.float32)
    known = spark.sparkContext.broadcast(idf)
    mean_length = max(1.0, (total["size"] or 0) / documents)
    # An id that one document holds alone brings it to no other.
    order = spark.sparkContext.broadcast(_order(idf, n >= 2))
    shared = int((n >= 2).sum())
    most = SHARD_TOKENS

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 44

        def shard(given: list[tuple]) -> pa.RecordBatch:
            nonlocal sequence
            ids = [i for *_, i in given]
            index = Index(ids, known.value, mean_length) if any(map(len, ids)) else None
            pieces = _pack(given, index, sequence)
            sequence = pieces[-1][5] + 1
            types = [pa.int64()] * 7
            names = [f.split()[0] for f in _PIECES.split(", ")]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*pieces), types)], names=names
            )

        given, size = [], 0
        for batch in batches:
            width = _width(batch)
            columns = [batch.column(n).to_pylist() for n in ("doc", "size", "full", "rest")]
            for doc, tokens, full, body in zip(*columns):
                ids = np.frombuffer(body, dtype=width)
                given.append((doc, tokens, full, ids))
                size += len(ids) + len(full)
                if size >= most:
                    yield shard(given)
                    given, size = [], 0
        if given:
            yield shard(given)

    # Written, so that finding the ranges reads the keys only.
    keyed = kept(spark, _keyed(rows, order, shared), "keyed")
    by = [*_KEY, "row"]
    dealt = keyed.repartitionByRange(-(-shards // TASK_SHARDS), *by)
    packed_rows = dealt.sortWithinPartitions(*by).mapInArrow(tidied(pack), _PIECES)
    return packed_rows.withColumnRenamed("doc", id_column)
