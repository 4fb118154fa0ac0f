"""Decontamination and the Jaccard join against brute force."""

import random

import pytest
from pyspark.sql import functions as F

import llm_brute as brute
from llm_cases import SF_DIR, make, odd_documents, workers_find_the_package  # noqa: F401
from pointstream.llm import decontaminate, jaccard_join
from pointstream.llm.components import components

BENCH = "item_id bigint, text string"


def contaminated(docs, benchmark, **options):
    found = decontaminate.contamination(docs, benchmark, **options)
    rows = found.select("doc_id", "n_words", "hits", decontaminate.n_hit().alias("n"), "items")
    return sorted(
        ((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n, sorted(r["items"])) for r in rows.collect()),
    )


def expected(docs, benchmark):
    windows = brute.windows_of((r.item_id, r.text) for r in benchmark.collect())
    out = []
    for r in docs.select("doc_id", "text").collect():
        n, hit, items = brute.contamination(r.text, windows)
        out.append((r.doc_id if r.doc_id is not None else -1, n, len(hit), sorted(items)))
    return sorted(out)


@pytest.mark.parametrize("block", [100_000, 150])
def test_contamination_matches_brute_force_in_any_number_of_blocks(spark, block):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    got = contaminated(docs.select("doc_id", "text"), benchmark, block=block)
    assert got == expected(docs, benchmark) and any(row[2] for row in got)


def test_contamination_of_odd_rows(spark, odd_documents):
    benchmark = spark.createDataFrame(
        [(1, "same ROW twice"), (1, "same ROW twice"), (2, ""), (3, None), (None, "ok"), (4, "word1 tail1 word2 tail2 word3 tail3 word4 tail4 word5 tail5 word6")],
        BENCH,
    )
    got = contaminated(odd_documents, benchmark)
    assert got == expected(odd_documents, benchmark)
    assert [r for r in got if r[0] == 5] == [(5, 7, 3, ["1"])] * 2
    stay = decontaminate.without_documents(odd_documents, benchmark)
    assert stay.columns == odd_documents.columns
    assert {r.hits for r in stay.collect()} == {"own hits"} and stay.count() == 7
    empty = odd_documents.limit(0)
    assert decontaminate.without_documents(empty, benchmark).count() == 0
    assert decontaminate.without_documents(odd_documents, benchmark.limit(0)).count() == 12


def test_spans_are_cut_out(spark, make):
    docs = make(["Keep this. One TWO three! And this é.", "nothing", None, "one two three"])
    benchmark = spark.createDataFrame([(1, "one two three")], BENCH)
    cut = decontaminate.without_spans(docs, benchmark)
    assert [r.text for r in cut.orderBy("doc_id").collect()] == ["Keep this. ! And this é.", "nothing", None, ""]


def near(docs):
    found = jaccard_join.near_duplicates(docs).collect()
    return {r.doc_id: r.component_id for r in found if r.doc_id is not None}, found


def test_join_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got, rows = near(docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got == brute.components(texts.items())
    assert all(r.n_shingles == len(brute.shingles(texts[r.doc_id])) for r in rows)


def family_texts(seed):
    """Families of near copies around the threshold, shared passages, short texts."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for size in (3, 6, 8, 12, 20, 40, 90, 200):
        base = [f"w{rng.randrange(4000)}" for _ in range(size)]
        if size > 80:
            base[5:5] = passage
        texts.append(" ".join(base))
        for _ in range(9):
            copy = list(base)
            for _ in range(rng.randrange(1, 2 + size // 25)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(50)}"
            texts.append(" ".join(copy if rng.random() < 0.8 else base))
            base = copy if rng.random() < 0.5 else base
    for _ in range(20):
        own = [f"q{rng.randrange(4000)}" for _ in range(rng.randrange(20, 120))]
        texts.append(" ".join(own[:10] + passage + own[10:]))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("chunk, ids, hot, sample", [(2048, 1_000_000, 2048, 64), (3, 100, 2, 1), (3, 100, 4, 2)])
def test_families_match_brute_force_in_chunks_of_any_size(make, monkeypatch, chunk, ids, hot, sample):
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", ids)
    monkeypatch.setattr(jaccard_join, "HOT_ROWS", hot)
    monkeypatch.setattr(jaccard_join, "HOT_SAMPLE", sample)
    texts = family_texts(chunk)
    got, _ = near(make(texts))
    assert got == brute.components(enumerate(texts))


def test_hot_signatures_are_counted_and_ranked_over_their_salts(spark, monkeypatch):
    rows = [(sig, doc, 5 << jaccard_join._INSTANCE_AT | jaccard_join._ZERO_SPARE << jaccard_join._SPARE_AT | 9)
            for sig, docs in ((1, range(40, 10, -1)), (2, [7, 8]), (3, [9]), (4, [50])) for doc in docs]
    rows = spark.createDataFrame(rows, "sig bigint, doc bigint, tag bigint")
    hot = spark.createDataFrame([(1, 6), (4, 2)], "sig bigint, salts int")
    several = jaccard_join._several(rows, hot)
    held = {(r.sig, r.held) for r in several.collect()}
    assert held == {(1, 30), (2, 2)}
    assert several.filter("sig = 1").select("key").distinct().count() > 2
    # A place beyond what a set may spare: every row stays.
    monkeypatch.setattr(jaccard_join, "_short", lambda *sizes: "-1 - 2000000")
    met = jaccard_join._meetings(several).collect()
    one = [r for r in met if r.sig == 1]
    assert sorted(r["rank"] for r in one) == list(range(1, 31))
    assert {(r.hub, r.many) for r in one} == {(11, 30)} and len({r.doc for r in one}) == 30
    assert sorted((r.doc, r["rank"], r.hub, r.many) for r in met if r.sig == 2) == [(7, 1, 7, 2), (8, 2, 7, 2)]


@pytest.mark.parametrize("least", [2, 1000])
def test_hot_keys_join_by_broadcast_with_the_same_rows(spark, monkeypatch, least):
    monkeypatch.setattr(jaccard_join, "HOT_ROWS", least)
    left = spark.createDataFrame([(k, v) for k in (1, 2, 3, None) for v in range(5 if k == 1 else 1)], "k int, v int")
    right = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    got = sorted(jaccard_join._joined(left, right, ["k"]).select("k", "v", "name").collect(), key=str)
    assert got == sorted(left.join(right, "k", "left").select("k", "v", "name").collect(), key=str)


def test_signatures_meet_for_all_linked_pairs():
    import numpy as np

    rng = np.random.default_rng(5)
    for size in [*range(1, 40), 64, 100, 333, 900]:
        for _ in range(12):
            one = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            out = rng.integers(0, max(1, size // 5) + 1)
            other = np.append(one[: len(one) - out], rng.integers(0, 1 << 63, rng.integers(0, 2 + size // 6), dtype=np.uint64))
            other = np.unique(other)
            common = len(np.intersect1d(one, other))
            if not len(other) or not jaccard_join.linked(len(one), len(other), common):
                continue
            a = {i: (spare, set(s.tolist())) for i, spare, s in jaccard_join.signatures(one)}
            b = {i: (spare, set(s.tolist())) for i, spare, s in jaccard_join.signatures(other)}
            both = a.keys() & b.keys()
            meet = {i: len(a[i][1] & b[i][1]) for i in both}
            sizes = jaccard_join._difference(len(one) + len(other))
            for i in both:
                # What the sizes take off the difference allowed adds to what they share.
                short = jaccard_join._difference(2 * jaccard_join.BANDS[i // jaccard_join.VARIANTS][1]) - sizes
                assert meet[i] > max(a[i][0], b[i][0]) + short
            assert any(meet.values()), (len(one), len(other), common)


@pytest.mark.parametrize("chunks", [1, 2])
def test_sketches_hold_all_pairs_of_a_group_that_may_link(chunks):
    import numpy as np

    rng = np.random.default_rng(chunks)
    base = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = [np.unique(np.append(base[rng.integers(0, 60) :], rng.integers(0, 1 << 63, 5, dtype=np.uint64))) for _ in range(90)]
    n = len(sets)
    group = {
        "doc": np.arange(n), "component": np.arange(n) % 7, "size": np.array([len(s) for s in sets]),
        "chunk": np.arange(n) * chunks // n, "instance": np.full(n, 5),
        "sketch": np.stack([np.frombuffer(jaccard_join.sketch(s), dtype=np.uint64) for s in sets]),
    }
    found = set()
    jaccard_join._against(group, found)
    for a in range(n):
        for b in range(a + 1, n):
            met = chunks == 1 or group["chunk"][a] != group["chunk"][b]
            common = len(np.intersect1d(sets[a], sets[b]))
            if met and a % 7 != b % 7 and jaccard_join.linked(len(sets[a]), len(sets[b]), common):
                assert (a, b, 5) in found
            assert met or (a, b, 5) not in found


def test_a_pair_comes_out_of_the_first_of_its_signatures():
    import numpy as np

    none = jaccard_join._NO_SIGNATURE
    lists = [[-7, 3, 9, none], [3, 9, 11, none], [9, 11, none, none], [-7, 11, none, none]]
    found = {}
    for sig in (-7, 3, 9, 11):
        docs = np.array([d for d, own in enumerate(lists) if sig in own])
        group = {
            "doc": docs, "component": docs, "size": np.full(len(docs), 50), "chunk": 0 * docs,
            "instance": 0 * docs + 5, "sketch": np.zeros((len(docs), 8), dtype=np.uint64),
            "sig": 0 * docs + sig, "first": np.array(lists)[docs],
        }
        found[sig] = set()
        jaccard_join._against(group, found[sig])
    assert found == {
        -7: {(0, 3, 5)}, 3: {(0, 1, 5)}, 9: {(0, 2, 5), (1, 2, 5)}, 11: {(1, 3, 5), (2, 3, 5)}
    }


def test_join_of_odd_rows(odd_documents):
    got, rows = near(odd_documents)
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 8}
    assert len(rows) == 12 and [r.component_id for r in rows if r.doc_id is None] == [None] * 2
    assert jaccard_join.near_duplicates(odd_documents.limit(0)).count() == 0
    stay = jaccard_join.one_of_each(odd_documents)
    assert stay.columns == odd_documents.columns
    ids = sorted(r.doc_id if r.doc_id is not None else -1 for r in stay.collect())
    assert ids == [-1, -1, 0, 1, 2, 3, 4, 5, 7, 8]
    assert jaccard_join.one_of_each(odd_documents.limit(0)).count() == 0


def test_rows_that_share_an_id_but_not_a_text_stay(make):
    one, two = "a b c d e f g h i j", "k l m n o p q r s t"
    rows = [(1, one), (1, two), (2, one), (None, one), (None, "u v w x y z"), (3, None), (3, None), (5, two), (5, two + " u")]
    stay = jaccard_join.one_of_each(make([(i, t, "en", "s", 0) for i, t in rows]))
    found = sorted(((r.doc_id, r.text) for r in stay.collect()), key=str)
    assert found == sorted([(1, one), (1, two), (None, "u v w x y z"), (3, None), (3, None)], key=str)
    # With an id for each row, the same rows of the same groups stay.
    numbered = [(i, t) for i, (_, t) in enumerate(rows)]
    stay = jaccard_join.one_of_each(make([(i, t, "en", "s", 0) for i, t in numbered]))
    assert sorted(r.doc_id for r in stay.collect()) == [0, 1, 4, 5, 6]


def test_rows_of_one_id_are_one_document(make):
    texts = ["a b c d e f g h i j", "k l m n o p q r s t"]
    rows = [(1, texts[0]), (2, texts[1]), (3, texts[0]), (3, texts[1])]
    got, _ = near(make([(i, t, "en", "s", 0) for i, t in rows]))
    assert got == {1: 1, 2: 1, 3: 1} == brute.components(rows)


def test_components_of_paths_and_random_graphs(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, 7)]
    links += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)]
    parent = {n: n for link in links for n in link}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    linked = {n for a, b in links if a != b for n in (a, b)}
    found = components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert {r.node: r.component for r in found.collect()} == {n: root(n) for n in linked}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
