"""The registered queries against their SQL, and the pipeline stage by stage."""

import pytest

import __spark_entry__ as driver
import corpus_pipeline
import llm_brute as brute
from compare import compare, oracle_connection
from llm_cases import SF_DIR, make, odd_documents, workers_find_the_package  # noqa: F401
from pointstream.llm.oracles import ORACLES
from pointstream.llm.queries import QUERIES

COLUMNS = {
    "op2_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op4_lexical_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op5_token_counts": "doc_id n_tokens token_score",
    "op6_token_files": "doc_id start n_tokens ids_crc32",
    "op7_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op9_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept quality",
    "op10_language_id": "doc_id lang_pred score rejected held_out",
    "op13_document_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
}


def test_all_are_registered():
    assert QUERIES.keys() | {"pipeline"} <= driver.queries().keys()
    assert ORACLES.items() <= driver.oracle_sql().items() and ORACLES.keys() <= QUERIES.keys()
    assert COLUMNS.keys() | ORACLES.keys() == QUERIES.keys()


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_its_oracle(spark, name):
    rows, problems = compare(spark, oracle_connection(SF_DIR), QUERIES[name], ORACLES[name], SF_DIR)
    assert rows > 0 and not problems


@pytest.mark.parametrize("name", COLUMNS)
def test_query_covers_all_documents(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    assert found.columns == COLUMNS[name].split()
    ids = {r.doc_id for r in found.select("doc_id").collect()}
    assert ids == {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_pipeline_stage_by_stage_against_brute_force(spark):
    stages = [f for _, f in corpus_pipeline.STAGES]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()
    one = stages[0](spark, docs, SF_DIR).cache()
    letters = [r for r in docs.collect() if any(map(str.isalpha, r.text or ""))]
    assert rows_of(one) == sorted(map(tuple, letters), key=str)
    two = stages[1](spark, one, SF_DIR).cache()
    component = brute.components((r.doc_id, r.text) for r in one.collect())
    assert rows_of(two) == sorted((tuple(r) for r in one.collect() if component[r.doc_id] == r.doc_id), key=str)
    three = stages[2](spark, two, SF_DIR).cache()
    windows = brute.windows_of((r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect())
    clean = [tuple(r) for r in two.collect() if not brute.contamination(r.text, windows)[1]]
    assert rows_of(three) == sorted(clean, key=str) and len(clean) < two.count()
    four = stages[3](spark, three, SF_DIR).cache()
    before = {r.doc_id: r for r in three.collect()}
    assert four.columns == docs.columns and four.count() == len(before)
    for r in four.collect():
        assert not brute.pii(r.text) and r.n_chars == len(r.text)
        assert (r.text == before[r.doc_id].text) == (not brute.pii(before[r.doc_id].text))
    five = stages[4](spark, four, SF_DIR)
    assert {r.doc_id for r in five.collect()} == {r.doc_id for r in four.collect()}
    whole = corpus_pipeline.run(spark, SF_DIR)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    tokens = lambda frame: frame.groupBy("doc_id", "doc_tokens").agg({"length": "sum"})
    assert rows_of(tokens(whole)) == rows_of(tokens(five)) and set(key) < set(whole.columns)


def test_stages_take_odd_rows(spark, odd_documents):
    docs = odd_documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, SF_DIR)
        assert found.columns == odd_documents.columns, name
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0, name
        docs = found.cache()
    ids = sorted(r.doc_id if r.doc_id is not None else -1 for r in docs.collect())
    assert ids == [-1, 3, 4, 5, 8] and {r.hits for r in docs.collect()} == {"own hits"}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r.doc_id for r in pieces.collect()} == {None, 3, 4, 5, 8}
