"""Language identification by nearest centroid.

A text's vector counts its byte 3-grams (ASCII and Latin letters lower-cased, runs of
other ASCII characters as one space), hashed to ``SIZE`` features, weighted by log term
frequency and inverse document frequency and normalised. Every language has a few
centroids, found by clustering its training vectors; a text takes the language of the
centroid with the greatest cosine, and is rejected if it is farther from it than the
language's training texts are, by a margin.

Training clusters a bounded sample: about ``SAMPLE_PER_LANGUAGE`` rows of each language,
chosen by a hash of id and text, rows equal in both once. Every language is learned, and
document frequencies are counted over all training rows. A model takes ``CENTROIDS *
SIZE`` numbers a language (48 KB), and is broadcast. Prediction reads the whole text, very
long ones too, and nothing else.

A text that is null or has no letter is ``und`` with score 0. With no training rows every
text is ``und``. Equal cosines go to the language first in order of name. Rows are
independent; repeated rows give repeated results. Other columns stay; one named like a
result gives way to it.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from pointstream.llm.frames import given_and_text, kept, tidied
from pointstream.llm.words import Part, parts

UNDETERMINED = "und"
SIZE = 4096
GRAM = 3
CENTROIDS = 3
SAMPLE_PER_LANGUAGE = 600
# Texts of one matrix.
ROWS = 256
# A text of fewer 3-grams is too short to be rejected for its distance.
JUDGED_GRAMS = 60
# The rejection distance: this share of the low percentile of the training cosines.
LOW_PERCENTILE = 1.0
REJECT_SHARE = 0.5


def _letter_code() -> np.ndarray:
    """Letters and non-ASCII bytes as they are, lower-cased; all else as a space."""
    code = np.full(256, 32, dtype=np.int64)
    code[97:123] = np.arange(97, 123)
    code[65:91] = np.arange(97, 123)
    code[128:] = np.arange(128, 256)
    return code


_CODE = _letter_code()


def _counts(part: Part) -> np.ndarray:
    """Feature counts, a row for each text."""
    n = len(part)
    code = _CODE[part.data]
    row = np.repeat(np.arange(n), np.diff(part.offsets))
    # Latin capitals (C3 80 to C3 9E) as their small letters.
    capital = np.flatnonzero((code[:-1] == 0xC3) & (code[1:] >= 0x80) & (code[1:] <= 0x9E)) + 1
    code[capital] += 0x20
    space = code == 32
    stay = np.ones(len(code), dtype=bool)
    stay[1:] = ~(space[1:] & space[:-1] & (row[1:] == row[:-1]))
    code, row = code[stay], row[stay]
    if len(code) < GRAM:
        return np.zeros((n, SIZE), dtype=np.float32)
    gram = (code[:-2] * 65_537 + code[1:-1] * 257 + code[2:]) * 2_654_435_761
    feature = (gram >> 15) % SIZE
    inside = row[:-2] == row[2:]
    flat = row[:-2][inside] * SIZE + feature[inside]
    return np.bincount(flat, minlength=n * SIZE).reshape(n, SIZE).astype(np.float32)


def _normal(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(counts) * idf
    length = np.linalg.norm(weighted, axis=1, keepdims=True)
    return np.divide(weighted, length, out=weighted, where=length > 0)


def _clusters(x: np.ndarray) -> np.ndarray:
    """Spherical k-means from the farthest points; the same for the same rows in any order."""
    x = x[np.lexsort(x[:, :16].T)]
    mean = x.mean(axis=0)
    chosen = [x[int(np.argmax(x @ mean))]]
    while len(chosen) < min(CENTROIDS, len(x)):
        nearest = np.max(x @ np.stack(chosen).T, axis=1)
        chosen.append(x[int(np.argmin(nearest))])
    centroids = np.stack(chosen)
    for _ in range(12):
        own = np.argmax(x @ centroids.T, axis=1)
        for c in range(len(centroids)):
            if (own == c).any():
                centroids[c] = x[own == c].mean(axis=0)
        centroids /= np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-9)
    return centroids


@dataclass
class Model:
    """``languages`` in order of name; row ``i`` of the centroids is of ``language[i]``."""

    languages: list[str]
    language: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray
    farthest: np.ndarray


def _sample(labelled: DataFrame) -> DataFrame:
    """Rows (_id, _text, _lang) of the sample."""
    counts = labelled.groupBy("_lang").agg(F.count("*").alias("_n"))
    shares = counts.select("_lang", F.least(F.lit(1.0), F.lit(SAMPLE_PER_LANGUAGE) / F.col("_n")).alias("_share"))
    # Written, so that its size is known: a row per language.
    shares = kept(labelled.sparkSession, shares, "language-shares")
    draw = F.pmod(F.xxhash64("_id", "_text"), F.lit(1_000_000)) / 1e6
    drawn = labelled.join(shares, "_lang").filter(draw < F.col("_share"))
    return drawn.select("_id", "_text", "_lang").distinct()


def train(
    labelled: DataFrame, text: str = "text", lang: str = "lang", id_column: str = "doc_id"
) -> Model:
    """Fits a model on rows whose language is known; rows without one are not used."""
    spark = labelled.sparkSession
    given = labelled.select(
        F.col(id_column).cast("string").alias("_id"),
        F.col(text).alias("_text"),
        F.col(lang).cast("string").alias("_lang"),
    )
    given = given.filter(F.col("_lang").isNotNull() & F.col("_text").isNotNull())

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch.column("_text"), ROWS):
                rows = [r.tobytes() for r in _counts(part)]
                langs = batch.column("_lang").slice(part.row, len(part))
                yield pa.RecordBatch.from_arrays([langs, pa.array(rows)], ["lang", "counts"])

    sample = _sample(given)
    rows = kept(spark, sample.mapInArrow(tidied(vectors), "lang string, counts binary"), "language-sample")

    def matrix(column: pa.Array) -> np.ndarray:
        joined = b"".join(column.to_pylist())
        return np.frombuffer(joined, dtype=np.float32).reshape(-1, SIZE)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(SIZE, dtype=np.int64), 0
        for batch in batches:
            for part in parts(batch.column("_text"), ROWS):
                x = _counts(part)
                seen += (x > 0).sum(axis=0)
                n += len(x)
        features = np.append(np.arange(SIZE), -1)
        counts = np.append(seen, n)
        yield pa.RecordBatch.from_arrays([pa.array(features), pa.array(counts)], ["f", "n"])

    seen = given.select("_text").mapInArrow(tidied(frequencies), "f bigint, n bigint")
    seen = {r["f"]: r["n"] for r in seen.groupBy("f").agg(F.sum("n").alias("n")).collect()}
    total = seen.get(-1, 0)
    idf = np.array([np.log((1 + total) / (1 + seen.get(f, 0))) + 1 for f in range(SIZE)])
    idf = idf.astype(np.float32)

    def cluster(table: pa.Table) -> pa.Table:
        x = _normal(matrix(table.column("counts")), idf)
        x = x[np.linalg.norm(x, axis=1) > 0]
        if not len(x):
            return pa.table({"lang": [], "centroids": [], "farthest": []}, schema=out)
        centroids = _clusters(x)
        low = np.percentile(np.max(x @ centroids.T, axis=1), LOW_PERCENTILE)
        return pa.table(
            [table.column("lang").slice(0, 1), [centroids.astype(np.float32).tobytes()], [float(low)]], schema=out
        )

    out = pa.schema([("lang", pa.string()), ("centroids", pa.binary()), ("farthest", pa.float64())])
    # A group is one language's sample, about SAMPLE_PER_LANGUAGE rows.
    groups = rows.groupBy("lang").applyInArrow(
        cluster, "lang string, centroids binary, farthest double"
    )
    found = sorted(groups.collect(), key=lambda r: r["lang"])
    each = [np.frombuffer(bytes(r["centroids"]), dtype=np.float32).reshape(-1, SIZE) for r in found]
    return Model(
        [r["lang"] for r in found],
        np.repeat(np.arange(len(each)), [len(x) for x in each]),
        np.concatenate(each) if each else np.zeros((0, SIZE), dtype=np.float32),
        idf,
        np.array([r["farthest"] * REJECT_SHARE for r in found]),
    )


_ASCII_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)], dtype=np.uint8)
_NOT_ASCII = np.array([b >= 128 for b in range(256)], dtype=np.uint8)


def _has_letter(part: Part) -> np.ndarray:
    found = part.count(_ASCII_LETTER) > 0
    for i in np.flatnonzero(~found & (part.count(_NOT_ASCII) > 0)):
        found[i] = any(map(str.isalpha, part.text(i).decode()))
    return found


def identified(
    docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Adds ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``.

    ``rejected`` marks texts without a letter and those too far from every centroid.
    """
    made = T.StructType.fromDDL("lang_pred string, score double, rejected boolean")
    given, text, keep, back = given_and_text(docs, text, keep, made.names, [])
    known = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = known.value
        for batch in batches:
            names, scores, rejected = [], [], []
            for part in parts(batch.column(text), ROWS):
                counts = _counts(part)
                valid = _has_letter(part)
                if not model.languages:
                    valid[:] = False
                best = np.zeros(len(part), dtype=np.int64)
                score = np.zeros(len(part))
                if valid.any():
                    cosine = _normal(counts.copy(), model.idf) @ model.centroids.T
                    at = np.argmax(cosine, axis=1)
                    best = model.language[at]
                    score = np.clip(cosine[np.arange(len(part)), at].astype(float), 0.0, 1.0)
                    far = (score < model.farthest[best]) & (counts.sum(axis=1) >= JUDGED_GRAMS)
                    rejected += (far | ~valid).tolist()
                else:
                    rejected += [True] * len(part)
                names += [model.languages[b] if v else UNDETERMINED for b, v in zip(best, valid)]
                scores += np.where(valid, score, 0.0).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in keep]
                + [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                + [pa.array(rejected, pa.bool_())],
                names=keep + made.names,
            )

    fields = [f for f in given.schema.fields if f.name in keep]
    found = given.mapInArrow(tidied(predict), T.StructType(fields + made.fields))
    return back(found, *made.names)
