"""Quality by weak supervision: rules vote or abstain, EM weighs them.

Each rule looks at a few measures of a text and votes good, bad or abstains. Over all
documents the votes are counted by pattern (at most ``3 ** len(RULES)`` of them, whatever
the corpus); expectation-maximisation on these counts estimates how often each rule votes
how on good and on bad documents, and which share of all is good, without labels. A document's posterior chance
of being good follows from its pattern: a vote counts for as much as its rule has proved
to tell, and one bad vote of a rule that often errs is outweighed by the good ones. The
rules overlap on purpose, as only agreement shows which of them is right.

A null or empty text has no words: all measures are 0 and it fails the base rule. Very
long texts are measured whole. Measures
of a document do not depend on other rows, so repeated rows give repeated results; an
empty table gives an empty one. Other columns stay; one named like a result gives way to
it.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from pointstream.llm.frames import given_and_text, kept, set_aside, without
from pointstream.llm.words import LINES, PLAIN_WORDS, Part, Tokens, parts

SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 3
GOOD, BAD = 1, 2
ABSTAIN = 0

MEASURES = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_letters",
    "n_upper",
    "n_stops",
]


def _table(test) -> np.ndarray:
    return np.array([int(test(b)) for b in range(256)], dtype=np.uint8)


_WORD_CHARS = _table(lambda b: PLAIN_WORDS.member[b] and b & 0xC0 != 0x80)
_SYMBOL = _table(lambda b: b in SYMBOLS)
_LETTERS = _table(lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 0xC3)
_UPPER = _table(lambda b: 65 <= b <= 90)
_STOPS = _table(lambda b: b in b".!?")


def _repeats(part: Part) -> tuple[np.ndarray, np.ndarray, Tokens]:
    """Words by text, those in three-word windows that it holds twice or more, and where."""
    found = part.tokens(PLAIN_WORDS)
    row = found.row()
    at, h = found.windows(REPEAT_WINDOW)
    key = h ^ (row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), dtype=bool)
    equal = key[order][1:] == key[order][:-1]
    same[order[1:][equal]] = True
    same[order[:-1][equal]] = True
    steps = np.zeros(len(found.hash) + 1, dtype=np.int64)
    np.add.at(steps, at[same], 1)
    np.add.at(steps, at[same] + REPEAT_WINDOW, -1)
    covered = np.cumsum(steps[:-1]) > 0
    counts = np.diff(found.first)
    return counts, np.bincount(row[covered], minlength=len(part)), found


def _lines(part: Part, word_start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines that hold a word, and those of them equal to an earlier one, by text."""
    lines = part.tokens(LINES)
    filled = np.searchsorted(word_start, lines.start) < np.searchsorted(word_start, lines.end)
    row = lines.row()[filled]
    key = lines.hash[filled] ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    total = np.bincount(row, minlength=len(part))
    _, one = np.unique(key, return_index=True)
    return total, total - np.bincount(row[one], minlength=len(part))


def measured(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns to keep (all unless given) with ``MEASURES``, counted over whole texts."""
    given, text, keep, back = given_and_text(docs, text, keep, MEASURES, [])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for part in parts(batch.column(text)):
                words, repeats, found = _repeats(part)
                lines, dups = _lines(part, found.start)
                sums = [part.count(t) for t in (_WORD_CHARS, _SYMBOL, _LETTERS, _UPPER, _STOPS)]
                rows.append(
                    np.stack([words, sums[0], sums[1], dups, repeats, lines, *sums[2:]], axis=1)
                )
            table = np.concatenate(rows) if rows else np.zeros((0, len(MEASURES)), dtype=np.int64)
            made = [pa.array(table[:, i].astype(np.int64)) for i in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in keep] + made, names=keep + MEASURES
            )

    fields = [f for f in given.schema.fields if f.name in keep]
    schema = T.StructType(fields + [T.StructField(n, T.LongType()) for n in MEASURES])
    return back(given.mapInArrow(measure, schema), *MEASURES)


def _rule(measure: str, bad: str, good: str | None = None) -> str:
    """SQL vote: bad and good are conditions on the measure, written after it."""
    praise = f"WHEN {measure} {good} THEN {GOOD} " if good else ""
    return f"CASE WHEN {measure} {bad} THEN {BAD} {praise}ELSE {ABSTAIN} END"


def _per(name: str, of: str) -> str:
    return f"({name} / greatest({of}, 1))"


# Votes from the measures: bad beyond a wide bound, good well inside it, else none.
RULES = {
    "length": _rule("n_words", "< 30", ">= 100"),
    "word_length": _rule(_per("word_chars", "n_words"), "NOT BETWEEN 4 AND 7", "BETWEEN 4.2 AND 6.5"),
    "symbols": _rule(_per("n_symbols", "n_words"), "> 0.2", "< 0.02"),
    # In a short text one line said twice is no defect.
    "dup_lines": _rule("(n_dup_lines / greatest(n_lines, 10))", "> 0.3", "< 0.05"),
    "repeats": _rule(_per("n_repeat_words", "n_words"), "> 0.2", "< 0.05"),
    "capitals": _rule(_per("n_upper", "n_letters"), "> 0.3", "< 0.05"),
    "letters": _rule(_per("n_letters", "word_chars"), "< 0.92", "> 0.95"),
    "sentences": _rule(_per("n_stops", "n_words"), "NOT BETWEEN 0.01 AND 0.4", "BETWEEN 0.02 AND 0.2"),
}
PATTERNS = 3 ** len(RULES)


def votes() -> Column:
    """All votes as one number, a base-3 digit for each rule."""
    code = F.lit(0)
    for rule in RULES.values():
        code = code * 3 + F.expr(rule)
    return code


def _digits(pattern: np.ndarray) -> np.ndarray:
    powers = 3 ** np.arange(len(RULES))[::-1]
    return pattern[:, None] // powers % 3


# EM starts from, and leans to, these chances of a vote (abstain, good, bad) on good and
# on bad documents, and this share of good ones. The leans weigh as much as so many
# documents, whatever the size of the corpus.
LEAN = np.array([[0.2, 0.75, 0.05], [0.2, 0.4, 0.4]])
PRIOR_DOCUMENTS = 200.0
PRIOR_GOOD, SHARE_DOCUMENTS = 0.8, 10.0
ROUNDS = 200


@dataclass(frozen=True)
class Estimate:
    """The chance of each vote by rule and class (good, bad), and the share of good documents."""

    chance: np.ndarray
    good: float


def estimate(pattern: np.ndarray, count: np.ndarray, good: float | None = None) -> Estimate:
    """Chances and share by expectation-maximisation; the share stays as it is if given."""
    digits = _digits(pattern)
    chance, share = np.repeat(LEAN[None], len(RULES), axis=0), PRIOR_GOOD if good is None else good
    for _ in range(ROUNDS):
        likely = posterior(digits, Estimate(chance, share))
        mass = np.stack([count * likely, count * (1 - likely)])
        if good is None:
            share = (mass[0].sum() + SHARE_DOCUMENTS * PRIOR_GOOD) / (mass.sum() + SHARE_DOCUMENTS)
        for rule in range(len(RULES)):
            seen = np.stack([np.bincount(digits[:, rule], m, minlength=3) for m in mass])
            seen = seen + PRIOR_DOCUMENTS * LEAN
            chance[rule] = seen / seen.sum(axis=1, keepdims=True)
    return Estimate(chance, float(share))


def posterior(digits: np.ndarray, known: Estimate) -> np.ndarray:
    """Chance of good for each pattern of votes. An abstention says nothing."""
    odds = np.full(len(digits), np.log(known.good) - np.log1p(-known.good))
    for rule in range(digits.shape[1]):
        ratio = np.log(known.chance[rule][0]) - np.log(known.chance[rule][1])
        ratio[ABSTAIN] = 0.0
        odds += ratio[digits[:, rule]]
    return 1 / (1 + np.exp(-odds))


def base_failed() -> Column:
    """Too short, or more than half of it repeated three-word windows."""
    words = F.col("n_words")
    return (words < 50) | (100 * F.col("n_repeat_words") > 50 * words)


def judged(
    docs: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    good: float | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """Adds measures, ``quality`` (posterior chance of good), ``base_failed`` and ``kept``.

    ``good`` is the share of good documents, estimated unless given; kept are documents of
    at least the ``threshold`` that do not fail the base rule. The measures are written once to the shared folder; counting patterns and judging
    read that table.
    """
    spark = docs.sparkSession
    verdict = ["quality", "base_failed", "kept"]
    keep = without(docs.columns if keep is None else keep, [*MEASURES, *verdict])
    aside, back = set_aside(measured(docs, text, keep), ["pattern"])
    rows = kept(spark, aside.withColumn("pattern", votes()), "quality")
    counted = rows.groupBy("pattern").count().collect()
    pattern = np.array([r["pattern"] for r in counted], dtype=np.int64)
    known = estimate(pattern, np.array([r["count"] for r in counted], dtype=float), good)
    share = posterior(_digits(pattern), known)
    known = spark.createDataFrame(
        list(zip(pattern.tolist(), share.tolist())), "pattern int, quality double"
    )
    # At most PATTERNS rows.
    joined = rows.join(F.broadcast(known), "pattern").withColumn("base_failed", base_failed())
    passed = ~F.col("base_failed") & (F.col("quality") >= threshold)
    return back(joined.withColumn("kept", passed), *verdict)
