"""The corpus pipeline: documents through five of the training-data operators.

Every stage takes (session, documents, data folder) and gives the documents that go on,
with the columns of ``documents``; the last gives the packed pieces. ``run`` writes each
stage's result to the shared folder and reads it back for the next.

Null or empty texts have no letter and go in the first stage; an empty table gives an
empty result; further columns are carried up to the last stage. Of repeated rows one
stays; rows that share an id, or have none, are documents of their own, and go only where
their texts are linked. Very long texts are read whole in every stage.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from pointstream.llm import decontaminate, jaccard_join, language, lexical_packing, pii
from pointstream.llm.frames import importable, kept, set_aside


# What a worker may hold for tokenizing, less than the operator's own bounds: executors
# that have run the other stages have less to spare.
CACHE_BYTES, PART_BYTES = 12 << 20, 1 << 20


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; a missing ``lang`` is filled with it."""
    importable(spark)
    aside, back = set_aside(docs, ["lang_pred", "score", "rejected"])
    found = language.identified(aside, language.train(docs)).filter(~F.col("rejected"))
    return back(found.withColumn("lang", F.coalesce("lang", "lang_pred")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of smallest id."""
    importable(spark)
    return jaccard_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    importable(spark)
    return decontaminate.without_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` is that of the new text."""
    redacted = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return redacted
    return redacted.withColumn("n_chars", F.length("text").cast("bigint"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences."""
    import public_tokenizers

    importable(spark)
    return lexical_packing.packed(
        docs, public_tokenizers.path("word_bpe_49k.json"), cache_bytes=CACHE_BYTES, part_bytes=PART_BYTES
    )


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Language identification, tokenizing and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = kept(spark, stage(spark, docs, sf_dir), name)
    return docs
