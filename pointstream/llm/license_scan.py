"""Licence scan by a positional rare-token index.

The licence texts (``licence_texts.py``, and those a caller adds) are templates. Their
words form one vocabulary; postings give, for a word, the templates and positions where
it stands. One scan of the documents keeps, per file, the positions of vocabulary words
only. Document frequencies over all files give each word's IDF. Per file, its words of
highest IDF are looked up: those that a template cannot all miss and still reach
``LEAST_SCORE``. Where one stands, the template's postings of all words are intersected
with the file by relative position. Words may be put in or left out: positions agree if
they lie within one band of shifts, as wide as a tenth to a fifth of the template
(``Template.slack``). A place counts when the words in its band weigh at least
``LEAST_SCORE`` of the template's IDF and all mandatory key phrases stand consecutively
within the place. No posting and no candidate is left out.

A word is a run of ASCII letters (lower-cased), digits and non-ASCII characters. A base
phrase counts at every place where its words stand consecutively.

A null or empty text has no words, no labels and score 0. Rows are independent; repeated
rows give repeated results. Of equal scores all labels count. Very long texts are scanned
whole. An empty table gives an empty one. Other columns stay; one named like a result
gives way to it.
"""

import math
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from pointstream.llm.frames import given_and_text, kept
from pointstream.llm.licence_texts import licences
from pointstream.llm.words import ALNUM_WORDS, lowered, parts, tokens

# Phrases whose every place counts, and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Function words, left out of the index where no phrase needs them.
FUNCTION_WORDS = "a an and any are as at be code for has in is it may not of on or other that the this to use with you".split()

# The share of a template's IDF that must agree.
LEAST_SCORE = 0.6

# Label, words and key phrases of a licence text.
Licence = tuple[str, str, list[str]]


@dataclass(frozen=True)
class Template:
    label: str
    words: list[str]
    keys: list[list[str]]
    base: bool

    @property
    def slack(self) -> int:
        """How far apart the shifts of a place's words may lie."""
        n = len(self.words)
        return 0 if self.base else max(n // 10, min(4, n // 5))


def templates(more: Sequence[Licence] = ()) -> list[Template]:
    base = [Template(label, p.split(), [p.split()], True) for p, label in BASE_PHRASES.items()]
    rest = [Template(label, t.split(), [k.split() for k in keys], False) for label, t, keys in [*licences(), *more]]
    return base + rest


def vocabulary(known: list[Template]) -> list[str]:
    needed = {w for t in known for key in t.keys for w in key}
    return sorted(needed | ({w for t in known for w in t.words} - set(FUNCTION_WORDS)))


def _vocabulary_hashes(vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the vocabulary and the word each belongs to."""
    words = [w.encode() for w in vocabulary]
    offsets = np.cumsum([0] + [len(w) + 1 for w in words])
    found = tokens(np.frombuffer(b"".join(w + b" " for w in words), dtype=np.uint8), offsets, ALNUM_WORDS)
    if len(found.hash) != len(words):
        raise ValueError("licence texts are words of letters and digits, parted by spaces")
    order = np.argsort(found.hash)
    return found.hash[order], order


_PLACES = "n_words bigint, at array<int>, word array<int>"


def _licence_words(given: DataFrame, text: str, keep: list[str], vocabulary: list[str]) -> DataFrame:
    """The columns to keep, the number of words, and the vocabulary words.

    ``at`` are word positions from 0, ``word`` numbers in ``vocabulary``.
    """
    made = T.StructType.fromDDL(_PLACES)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, numbers = _vocabulary_hashes(vocabulary)
        words = [w.encode() for w in vocabulary]
        for batch in batches:
            counts, places, which = [], [], []
            for part in parts(batch.column(text)):
                found = part.tokens(ALNUM_WORDS)
                near = np.minimum(np.searchsorted(hashes, found.hash), len(hashes) - 1)
                hit = np.flatnonzero(hashes[near] == found.hash)
                number = numbers[near[hit]]
                same = [
                    lowered(part.data[found.start[h] : found.end[h]].tobytes()) == words[w]
                    for h, w in zip(hit, number)
                ]
                hit, number = hit[same], number[same]
                counts += np.diff(found.first).tolist()
                cut = np.searchsorted(hit, found.first)
                for r in range(len(part)):
                    low, high = cut[r], cut[r + 1]
                    places.append((hit[low:high] - found.first[r]).tolist())
                    which.append(number[low:high].tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in keep]
                + [pa.array(counts, pa.int64())]
                + [pa.array(x, pa.list_(pa.int32())) for x in (places, which)],
                names=keep + made.names,
            )

    fields = [f for f in given.schema.fields if f.name in keep]
    return given.mapInArrow(scan, T.StructType(fields + made.fields))


class Index:
    """Postings of all templates' words, and what the words weigh."""

    def __init__(self, known: list[Template], idf: list[float]):
        number = {w: i for i, w in enumerate(vocabulary(known))}
        self.templates, self.idf = known, idf
        self.body, self.total, self.keys = [], [], []
        # Word -> template -> positions; and the words that are looked up first.
        self.postings = defaultdict(lambda: defaultdict(list))
        self.anchors = defaultdict(list)
        for t, template in enumerate(known):
            body = [(p, number[w]) for p, w in enumerate(template.words) if w in number]
            for p, w in body:
                self.postings[w][t].append(p)
            total = math.fsum(idf[w] for _, w in body)
            self.body.append(body)
            self.total.append(total)
            self.keys.append([[number[w] for w in key] for key in template.keys])
            # The rest of the words would weigh too little without one of these.
            need, had = (1.0 if template.base else LEAST_SCORE), 0.0
            for p, w in sorted(body, key=lambda pw: (-idf[pw[1]], pw[0])):
                self.anchors[w].append((t, p))
                had += idf[w]
                if had > (1 - need) * total * (1 + 1e-9):
                    break
        self.looked_up = np.isin(np.arange(len(idf)), list(self.anchors))

    def places(self, at: np.ndarray, word: np.ndarray) -> list[tuple[int, int, float]]:
        """Template, first word and score of every verified place in a file."""
        rare = np.flatnonzero(self.looked_up[word])
        if not len(rare):
            return []
        seen = defaultdict(set)
        for p, w in zip(at[rare].tolist(), word[rare].tolist()):
            for t, q in self.anchors[w]:
                seen[t].add(p - q)
        there = dict(zip(at.tolist(), word.tolist()))
        found = []
        for t in sorted(seen):
            shifts = sorted(seen[t])
            if self.templates[t].base:
                found += [(t, s, 1.0) for s in shifts if self._keys_stand(t, s, there)]
                continue
            slack = self.templates[t].slack
            begin = 0
            for i, s in enumerate(shifts):
                if i + 1 == len(shifts) or shifts[i + 1] - s > 2 * slack:
                    found += self._bands(t, shifts[begin] - slack, s, at, word, there)
                    begin = i + 1
        return found

    def _bands(
        self, t: int, low: int, high: int, at: np.ndarray, word: np.ndarray, there: dict[int, int]
    ) -> list[tuple[int, int, float]]:
        """Verified places of a template whose bands begin between two shifts."""
        template = self.templates[t]
        slack = template.slack
        i, j = np.searchsorted(at, [low, high + slack + len(template.words)])
        hits = [
            (p - q, q, self.idf[w])
            for p, w in zip(at[i:j].tolist(), word[i:j].tolist())
            for q in self.postings[w].get(t, ())
            if low <= p - q <= high + slack
        ]
        hits.sort()
        counted, weight, end, found = defaultdict(int), 0.0, 0, []
        for n, (shift, q, idf) in enumerate(hits):
            if shift > high:
                break
            while end < len(hits) and hits[end][0] <= shift + slack:
                weight += hits[end][2] if not counted[hits[end][1]] else 0.0
                counted[hits[end][1]] += 1
                end += 1
            if n == 0 or hits[n - 1][0] != shift:  # the band holds all hits of its first shift
                score = self._score(t, counted) if weight > 0.99 * LEAST_SCORE * self.total[t] else 0
                if score >= LEAST_SCORE and self._keys_stand(t, shift, there):
                    found.append((t, shift, score))
            counted[q] -= 1
            weight -= idf if not counted[q] else 0.0
        return found

    def _score(self, t: int, counted: dict[int, int]) -> float:
        """The share of a template's weight at the positions that are counted, without drift."""
        return math.fsum(self.idf[w] for p, w in self.body[t] if counted[p]) / self.total[t]

    def _keys_stand(self, t: int, shift: int, there: dict[int, int]) -> bool:
        end = shift + len(self.templates[t].words) + self.templates[t].slack

        def stands(key: list[int]) -> bool:
            starts = range(shift, end - len(key) + 1)
            return any(all(there.get(s + i) == w for i, w in enumerate(key)) for s in starts)

        return all(map(stands, self.keys[t]))


_RESULT = "n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"


def licence_scan(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, more: Sequence[Licence] = ()
) -> DataFrame:
    """The columns to keep, ``n_words``, base places and all labels with the best score.

    ``more`` are further licence texts: label, lower-cased words and key phrases, each
    parted by spaces.
    """
    known = templates(more)
    words = vocabulary(known)
    made = T.StructType.fromDDL(_RESULT)
    given, text, keep, back = given_and_text(
        docs, text, keep, ["n_words", *made.names], ["at", "word"]
    )
    spark = docs.sparkSession
    rows = kept(spark, _licence_words(given, text, keep, words), "licence-words")
    files = rows.count()
    seen = rows.select(F.explode(F.array_distinct("word")).alias("word")).groupBy("word").count()
    df = {r["word"]: r["count"] for r in seen.collect()}  # one row per vocabulary word at most
    idf = [
        math.log1p((max(files, 1) - held + 0.5) / (held + 0.5))
        for held in (df.get(w, 1) for w in range(len(words)))  # as if one file held a word that none does
    ]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(known, idf)
        for batch in batches:
            out = []
            columns = [batch.column(n) for n in ("at", "word")]
            for r in range(batch.num_rows):
                at, word = (c[r].values.to_numpy(zero_copy_only=False) for c in columns)
                found = index.places(at, word) if len(at) else []
                base = [f for f in found if index.templates[f[0]].base]
                names = lambda fs: ",".join(sorted({index.templates[f[0]].label for f in fs}))
                out.append(
                    {
                        "n_base": len(base),
                        "first_word": min((f[1] for f in base), default=None),
                        "last_word": max((f[1] for f in base), default=None),
                        "base_labels": names(base),
                        "labels": names(found),
                        "score": min(1.0, max((f[2] for f in found), default=0.0)),
                    }
                )
            table = pa.Table.from_pylist(out, schema=result).combine_chunks()
            made_columns = [
                c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in table.columns
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in keep] + [batch.column("n_words")] + made_columns,
                names=keep + ["n_words"] + made.names,
            )

    result = pa.schema(
        [
            ("n_base", pa.int64()),
            ("first_word", pa.int64()),
            ("last_word", pa.int64()),
            ("base_labels", pa.string()),
            ("labels", pa.string()),
            ("score", pa.float64()),
        ]
    )
    fields = [f for f in rows.schema.fields if f.name in [*keep, "n_words"]]
    found = rows.mapInArrow(look_up, T.StructType(fields + made.fields))
    return back(found, "n_words", *made.names)
