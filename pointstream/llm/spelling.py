"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

A word's letters, counted, are a point. One edit moves it little: a replaced letter by an
L1 distance of two, an inserted or deleted one by one. So near words of the same length
lie within two of each other, and near words of neighbouring lengths within one. Words of
each length have a k-d tree: nodes split on a letter's count, and a search prunes every
node whose box is farther than its radius. What is left is verified by letter order, as
words with like counts may be far apart.

The upper part of each tree is made of a bounded sample of words (``SAMPLE`` at most) and
cuts the space into cells of about ``CELL_WORDS`` words; it is small and goes to every
task. All words are dealt to their cells, and each as a query to every cell that its
search reaches: its own length's with radius two, the next longer one's with radius one.
A cell is one group; its own tree goes on down to ``LEAF_WORDS`` words. Every pair of near
words is found in the cell of one of them, so a cell's size follows from the number of
words beside it, not from the corpus, and no length or letter is a group of its own. Words
of equal counts cannot be parted by a tree and share a cell.

Null texts have no words, an empty table gives an empty result. Repeated rows count as
often as they occur; null ids are read as empty text where typos are made. Texts are read whole. Ties
between forms go to the smallest word in code-point order. Other columns are ignored.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pointstream.llm.frames import kept

LETTERS = "A-Za-zÀ-ÿ"
MIN_CHARS, MIN_COUNT = 6, 5
# How many times more frequent a word's form must be.
FORM_TIMES = 5
# Words that the upper trees are made of, words of a cell, of a leaf, and the letters
# that the words of a cell may have together.
SAMPLE = 1 << 17
CELL_WORDS = 2048
CELL_LETTERS = 1 << 22
LEAF_WORDS = 16
# Queries compared with a leaf at a time.
_CHUNK = 4096

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Dimension of each letter: a to z, then the letters from U+00C0 to U+00FF.
_DIMENSIONS = 26 + 64


def one_in(n: int) -> Callable[[Column, Column], Column]:
    """Typos in one of ``n`` pairs of id and word: the letter at a hashed place is lost."""

    def typo(name: Column, word: Column) -> Column:
        h = F.crc32(F.concat(F.coalesce(name.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
        at = (h % F.length(word)).cast("int")
        lost = F.concat(F.left(word, at), word.substr(at + 2, F.length(word)))
        return F.when(h % n == 0, lost).otherwise(word)

    return typo


def word_counts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    typos: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, of at least ``MIN_CHARS`` letters and
    ``MIN_COUNT`` occurrences in all texts.

    ``typos`` gives from the id and a word what stands for it. Counts are added up in the
    tasks that read the texts; only words are shuffled.
    """
    # Shorter runs cannot become words: typos only take letters.
    runs = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"[{LETTERS}]{{{MIN_CHARS},}}"), F.lit(0))
    each = docs.select(F.col(f"`{id_column}`").alias("id"), F.explode(runs).alias("run"))
    # lower() is quick on most words, but also lowers letters beyond Z.
    same = F.col("run") == F.lower("run")
    lowered = each.select("id", F.when(same, F.col("run")).otherwise(F.translate("run", _UPPER, _LOWER)).alias("word"))
    if typos is not None:
        lowered = lowered.select(typos(F.col("id"), F.col("word")).alias("word"))
    counted = lowered.filter(F.length("word") >= MIN_CHARS).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= MIN_COUNT)


def _codes(words: list[str]) -> np.ndarray:
    """Letters of words of one length, a row each, as dimensions."""
    body = "".join(words).encode("latin-1")
    codes = np.frombuffer(body, dtype=np.uint8).reshape(len(words), -1)
    return np.where(codes < 192, codes - 97, codes - (192 - 26)).astype(np.uint8)


def points(codes: np.ndarray) -> np.ndarray:
    """Letter counts of words."""
    rows, length = codes.shape
    at = np.arange(rows, dtype=np.int64)[:, None] * _DIMENSIONS + codes
    counts = np.bincount(at.ravel(), minlength=rows * _DIMENSIONS).reshape(rows, _DIMENSIONS)
    return counts.astype(np.int16 if length < 1 << 15 else np.int32)


def split_of(given: np.ndarray) -> tuple[int, int] | None:
    """Letter and count that part points most evenly: left are those up to the count."""
    varied = np.flatnonzero(given.max(axis=0) > given.min(axis=0))
    best, found = 0, None
    for letter in varied[np.argsort(-given[:, varied].var(axis=0), kind="stable")[:8]]:
        column = given[:, letter]
        middle = int(np.median(column))
        for count in (middle, middle - 1):
            left = int((column <= count).sum())
            if min(left, len(given) - left) > best:
                best, found = min(left, len(given) - left), (int(letter), count)
    return found


class UpperTree:
    """Splits of the words of one length into cells, as arrays: node by node."""

    def __init__(self, given: np.ndarray, most: int):
        self.letter, self.count, self.left, self.right, self.cell = [], [], [], [], []
        self.cells = 0
        self._grow(given, most)

    def _grow(self, given: np.ndarray, most: int) -> int:
        node = len(self.letter)
        for column in (self.letter, self.count, self.left, self.right, self.cell):
            column.append(-1)
        split = split_of(given) if len(given) > most else None
        if split is None:
            self.cell[node] = self.cells
            self.cells += 1
            return node
        self.letter[node], self.count[node] = split
        left = given[:, split[0]] <= split[1]
        self.left[node] = self._grow(given[left], most)
        self.right[node] = self._grow(given[~left], most)
        return node

    def reached(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each cell, and the queries from which it is at most ``radius`` away."""
        every = np.arange(len(queries))
        # The distance of a query to a box is kept letter by letter: a letter that is
        # split again below counts once.
        todo = [(0, every, np.zeros(len(queries), dtype=np.int32), {})]
        while todo:
            node, some, far, own = todo.pop()
            if not len(some):
                continue
            if self.cell[node] >= 0:
                yield self.cell[node], some
                continue
            letter, count = self.letter[node], self.count[node]
            values = queries[some, letter].astype(np.int32)
            low, high = own.get(letter, (None, None))
            for child, bounds in ((self.left[node], (low, count)), (self.right[node], (count + 1, high))):
                before = _beyond(values, low, high)
                away = far - before + _beyond(values, *bounds)
                near = away <= radius
                todo.append((child, some[near], away[near], {**own, letter: bounds}))


def _beyond(values: np.ndarray, low: int | None, high: int | None) -> np.ndarray:
    """How far values lie outside a range."""
    out = np.zeros(len(values), dtype=np.int32)
    if low is not None:
        out = np.maximum(out, low - values)
    if high is not None:
        out = np.maximum(out, values - high)
    return out


def near_pairs(
    given: np.ndarray, queries: np.ndarray, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, point) of rows at most ``radius`` apart, by a k-d tree over the points."""
    todo = [(np.arange(len(given)), np.arange(len(queries)))]
    while todo:
        own, some = todo.pop()
        box = given[own]
        low, high = box.min(axis=0), box.max(axis=0)
        asked = queries[some]
        away = np.maximum(np.maximum(low - asked, asked - high), 0).sum(axis=1)
        some = some[away <= radius]
        if not len(some):
            continue
        split = split_of(box) if len(own) > LEAF_WORDS else None
        if split is None:
            # More than a leaf holds only where the words have equal counts.
            for a in range(0, len(own), LEAF_WORDS):
                part = own[a : a + LEAF_WORDS]
                for b in range(0, len(some), _CHUNK):
                    asked = some[b : b + _CHUNK]
                    apart = np.abs(queries[asked][:, None, :] - given[part][None, :, :]).sum(axis=2)
                    q, p = np.nonzero(apart <= radius)
                    yield asked[q], part[p]
            continue
        left = box[:, split[0]] <= split[1]
        todo += [(own[left], some), (own[~left], some)]


def one_replaced(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether words of one length differ in exactly one place."""
    return (one != two).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether words become words one longer by inserting a letter."""
    length = short.shape[1]
    same, shifted = short == long[:, :-1], short == long[:, 1:]
    head = np.where(same.all(axis=1), length, np.argmin(same, axis=1))
    tail = np.where(shifted.all(axis=1), length, np.argmin(shifted[:, ::-1], axis=1))
    return head + tail >= length


_DEALT = "length int, cell int, word string, n bigint, query int"
_PAIRS = "word string, near string, near_n bigint"


def _upper_trees(words: DataFrame) -> dict[int, UpperTree]:
    """A tree for each length that needs more than one cell, from a bounded sample."""
    sizes = words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n"))
    # A length with few words has one cell and needs no tree.
    large = {r["length"]: r["n"] for r in sizes.filter(F.col("n") * F.col("length") > F.least(
        F.lit(CELL_LETTERS), F.col("length") * CELL_WORDS)).collect()}
    if not large:
        return {}
    total = sum(large.values())
    share = min(1 << 20, (SAMPLE << 20) // total)
    drawn = words.filter(F.length("word").isin(list(large)) & (F.expr(f"pmod(xxhash64(word), {1 << 20})") < share))
    by_length: dict[int, list[str]] = {}
    for row in drawn.select("word").limit(2 * SAMPLE).collect():
        by_length.setdefault(len(row["word"]), []).append(row["word"])
    trees = {}
    for length, some in by_length.items():
        cells = large[length] / max(1, min(CELL_WORDS, CELL_LETTERS // length))
        trees[length] = UpperTree(points(_codes(sorted(some))), max(1, int(len(some) / cells)))
    return trees


def _dealt(words: DataFrame, trees) -> DataFrame:
    """Every word in its cell (query 0), and as a query in the cells that it reaches."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = trees.value
        for batch in batches:
            word = np.array(batch.column("word").to_pylist(), dtype=object)
            count = np.array(batch.column("n").to_pylist(), dtype=np.int64)
            lengths = np.array([len(w) for w in word], dtype=np.int64)
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                # Very long words are few to a part, so that their points stay small.
                for part in np.array_split(own, -(-len(own) * int(length) // CELL_LETTERS)):
                    given = points(_codes(word[part].tolist()))
                    for query, at, radius in ((0, length, 0), (1, length, 2), (2, length + 1, 1)):
                        tree = known.get(int(at))
                        found = tree.reached(given, radius) if tree else [(0, np.arange(len(part)))]
                        for cell, some in found:
                            rows = part[some]
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(np.full(len(rows), at), pa.int32()),
                                    pa.array(np.full(len(rows), cell), pa.int32()),
                                    pa.array(word[rows].tolist(), pa.string()),
                                    pa.array(count[rows]),
                                    pa.array(np.full(len(rows), query), pa.int32()),
                                ],
                                names=["length", "cell", "word", "n", "query"],
                            )

    return words.mapInArrow(deal, _DEALT)


def _search(table: pa.Table) -> pa.Table:
    """Near words of a cell's queries among its words, both ways for shorter queries."""
    kind = table.column("query").to_numpy()
    word = np.array(table.column("word").to_pylist(), dtype=object)
    count = table.column("n").to_numpy()
    own = np.flatnonzero(kind == 0)
    out = [[], [], []]
    if len(own):
        codes = _codes(word[own].tolist())
        given = points(codes)
        for query, radius, same in ((1, 2, one_replaced), (2, 1, one_inserted)):
            asked = np.flatnonzero(kind == query)
            if not len(asked):
                continue
            spelled = _codes(word[asked].tolist())
            for q, p in near_pairs(given, points(spelled), radius):
                right = same(spelled[q], codes[p])
                a, b = asked[q[right]], own[p[right]]
                for one, two in [(a, b)] if query == 1 else [(a, b), (b, a)]:
                    out[0] += word[one].tolist()
                    out[1] += word[two].tolist()
                    out[2] += count[two].tolist()
    columns = [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())]
    return pa.Table.from_arrays(columns, names=["word", "near", "near_n"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): each two words that one edit parts, both ways."""
    trees = words.sparkSession.sparkContext.broadcast(_upper_trees(words))
    return _dealt(words, trees).groupBy("length", "cell").applyInArrow(_search, _PAIRS)


def variants(words: DataFrame) -> DataFrame:
    """Per word of (word, n): form, root, n, ``n_near`` and ``form_n``.

    The form is the most frequent near word, if it is ``FORM_TIMES`` as frequent as the
    word; the root is reached by following forms. Each form is more frequent than its
    word by that factor, so a chain is short, and doubling its steps takes few rounds.
    """
    spark = words.sparkSession
    words = kept(spark, words, "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    formed = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(-F.col("best.less") >= FORM_TIMES * F.col("n"), F.col("best")).alias("best"),
    )
    formed = kept(
        spark,
        formed.select("word", F.col("best.near").alias("form"), "n", "n_near", (-F.col("best.less")).alias("form_n")),
        "forms",
    )
    steps = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    steps = kept(spark, steps, "steps")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = steps.join(on, "root", "left")
        moved = longer.select("word", F.coalesce("further", "root").alias("root"), F.isnotnull("further").alias("moved"))
        moved = kept(spark, moved, "steps")
        steps = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            break
    found = formed.join(steps, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
