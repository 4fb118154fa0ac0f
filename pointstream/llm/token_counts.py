"""Token counts of a unigram tokenizer, without making tokens.

The vocabulary is that of a public sentencepiece file: its pieces with their scores. The
text's spaces become ``▁`` and one is put before it. Aho-Corasick finds all pieces in it;
the best segmentation is the one with the highest sum of scores. Per position only the
best score and its number of pieces are carried.

Ties are resolved as unigram tokenizers do: of segmentations that end at the same place
with the same score, the one whose last piece is longest stays. A character that is no
piece costs the lowest score less ten, and counts as its bytes where the vocabulary has
all of them, else runs of such characters count as one.

No piece goes over the start of a run of ``▁`` or holds a line feed, so a text is the sum
of its parts between those; counts of parts are cached, in a cache of bounded size.

A null or empty text has no tokens and score 0. Rows are independent; repeated rows give
repeated results; an empty table gives an empty one. Other columns stay; one named like a
result gives way to it.
"""

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from pointstream.llm.cached_tokens import CACHED_CHARS, Generations
from pointstream.llm.frames import given_and_text
from pointstream.llm.words import parts

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
_PARTS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n+")


def vocabulary(path: str) -> tuple[list[tuple[str, float]], bool]:
    """Pieces with scores, and whether all 256 bytes are among the tokens."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    numbers = range(model.get_piece_size())
    plain = [
        i
        for i in numbers
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))
    ]
    pieces = [(model.id_to_piece(i), float(model.get_score(i))) for i in plain]
    return pieces, sum(model.is_byte(i) for i in numbers) == 256


class Counter:
    """Best score and number of pieces of any text."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece, _ in pieces if len(piece) == 1}
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.byte_fallback = byte_fallback
        inner = any(SPACE in p.lstrip(SPACE) or "\n" in p for p, _ in pieces)
        self.parts = None if inner else _PARTS
        self.known = Generations()

    def _best(self, text: str) -> tuple[float, int]:
        """Dynamic programming over the ends of pieces."""
        size = len(text)
        score: list[float | None] = [None] * (size + 1)
        count = [0] * (size + 1)
        # Whether the best way to a place ends with an unknown character.
        open_run = [False] * (size + 1)
        score[0] = 0.0
        found = self.automaton.iter(text)
        step = next(found, None)
        for end in range(1, size + 1):
            best, pieces, run = None, 0, False
            # The longest piece comes first, so an equal score does not replace it.
            while step is not None and step[0] == end - 1:
                length, value = step[1]
                before = score[end - length]
                if before is not None and (best is None or before + value > best):
                    best, pieces = before + value, count[end - length] + 1
                step = next(found, None)
            letter = text[end - 1]
            if letter not in self.single:
                value = score[end - 1] + self.unknown
                if best is None or value > best:
                    best, run = value, True
                    if self.byte_fallback:
                        pieces = count[end - 1] + len(letter.encode())
                    else:
                        pieces = count[end - 1] + (not open_run[end - 1])
            score[end], count[end], open_run[end] = best, pieces, run
        return score[size], count[size]

    def count(self, texts: list[str]) -> list[tuple[float, int]]:
        marked = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        if self.parts is None or not self.byte_fallback:
            return [self._best(t) for t in marked]
        cut = [self.parts.findall(t) for t in marked]
        new = self.known.missing(set().union(*cut))
        long = {}
        for part in new:
            (self.known.young if len(part) <= CACHED_CHARS else long)[part] = self._best(part)
        look = self.known.young
        out = []
        for pieces in cut:
            found = [long[p] if p in long else look[p] for p in pieces]
            out.append((sum(f[0] for f in found), sum(f[1] for f in found)))
        self.known.turn()
        return out


@cache
def counter(path: str) -> Counter:
    return Counter(*vocabulary(path))


def token_counts(
    docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The columns to keep (all unless given), ``n_tokens`` and ``token_score``."""
    made = T.StructType.fromDDL("n_tokens bigint, token_score double")
    given, text, keep, back = given_and_text(docs, text, keep, made.names, [])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(path)
        for batch in batches:
            found = []
            column = batch.column(text)
            for part in parts(column):
                texts = column.slice(part.row, len(part)).to_pylist()
                found += known.count([t or "" for t in texts])
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in keep]
                + [pa.array([f[1] for f in found], pa.int64())]
                + [pa.array([float(f[0]) for f in found], pa.float64())],
                names=keep + made.names,
            )

    fields = [f for f in given.schema.fields if f.name in keep]
    found = given.mapInArrow(count, T.StructType(fields + made.fields))
    return back(found, *made.names)
