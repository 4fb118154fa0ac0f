"""Spelling variants, Merkle manifests and fingerprints against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import llm_brute as brute
from llm_cases import SF_DIR, make, odd_documents, workers_find_the_package  # noqa: F401
from pointstream.llm import fingerprints, merkle, spelling
from pointstream.llm.queries import QUERIES

VALUES = ["doc_id", "source", "lang", "n_chars", "text"]


# Spelling variants


def words_frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n bigint")


def made_up_words(rng, number, letters="abcé", length=(6, 9)):
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(*length))) for _ in range(number)}
    return {w: 5 + int(rng.paretovariate(0.5)) for w in sorted(words)}


def found_variants(frame):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


def test_variants_match_brute_force(spark):
    counts = made_up_words(random.Random(1), 3000)
    assert found_variants(spelling.variants(words_frame(spark, counts))) == brute.variants(counts)


def test_cells_change_nothing(spark, monkeypatch):
    """Upper trees of many cells, from a sample of some of the words."""
    monkeypatch.setattr(spelling, "CELL_WORDS", 60)
    monkeypatch.setattr(spelling, "SAMPLE", 700)
    counts = made_up_words(random.Random(2), 2500, "abcdeéÿ×")
    trees = spelling._upper_trees(words_frame(spark, counts))
    assert max(tree.cells for tree in trees.values()) > 8
    dealt = spelling._dealt(words_frame(spark, counts), spark.sparkContext.broadcast(trees)).filter("query = 0")
    assert dealt.count() == len(counts) and dealt.groupBy("length", "cell").count().agg(F.max("count")).first()[0] < 400
    assert found_variants(spelling.variants(words_frame(spark, counts))) == brute.variants(counts)


def test_chains_and_ties(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "zzzzzz": 50, "zzzzzy": 250, "zzzzzx": 250, "qqqqqq": 9}
    found = found_variants(spelling.variants(words_frame(spark, counts)))
    assert found == brute.variants(counts)
    assert found["aaaaaa"] == ("aaaaab", "aaabbb", 5, 1, 25)
    assert found["zzzzzz"][0] == "zzzzzx" and found["qqqqqq"] == (None, "qqqqqq", 9, 0, None)


def test_letter_order_is_verified():
    """Words of equal letter counts are no neighbours for that."""
    one, two = spelling._codes(["stressed", "stressed"]), spelling._codes(["desserts", "stresses"])
    assert (spelling.points(one)[0] == spelling.points(two)[0]).all()
    assert spelling.one_replaced(one, two).tolist() == [False, True]
    short, long = spelling._codes(["abcabc", "abcabc", "aaaaaa", "abcabc"]), spelling._codes(["abcabcd", "xabcabc", "aaaaaaa", "cbacbaa"])
    assert spelling.one_inserted(short, long).tolist() == [True, True, True, False]


def test_range_search_against_all_pairs():
    rng = np.random.default_rng(0)
    given, queries = rng.integers(0, 4, (300, 90)).astype(np.int16), rng.integers(0, 4, (100, 90)).astype(np.int16)
    given[:, 4:] = queries[:, 4:] = 0
    for radius in (1, 2):
        pairs = {(int(a), int(b)) for q, p in spelling.near_pairs(given, queries, radius) for a, b in zip(q, p)}
        apart = np.abs(given[None] - queries[:, None]).sum(axis=2)
        assert pairs == {tuple(map(int, x)) for x in np.argwhere(apart <= radius)}


def test_words_of_odd_rows(odd_documents):
    counts = spelling.word_counts(odd_documents, typos=spelling.one_in(2))
    rows = [(r.doc_id, r.text) for r in odd_documents.select("doc_id", "text").collect()]
    expected = brute.word_counts(rows, 2)
    assert {r.word: r.n for r in counts.collect()} == expected and "x" * 100_000 not in expected
    assert found_variants(spelling.variants(counts)) == brute.variants(expected)
    assert spelling.variants(spelling.word_counts(odd_documents.limit(0))).collect() == []


def test_very_long_and_upper_case_words(make):
    long = "é" * 5000
    texts = [f"{long} {long}a WÖRTERÉ wÖrterÉ wÖrteré Wörter2x"] * 5
    found = found_variants(spelling.variants(spelling.word_counts(make(texts))))
    assert found == brute.variants({long: 5, long + "a": 5, "wÖrterÉ": 10, "wÖrteré": 5, "wörter": 5})
    assert found[long][3] == 1


# Merkle manifests


def manifest_rows(docs, changed=None, **how):
    manifest = merkle.write_manifest(docs, VALUES, changed=changed, **how)
    made = merkle.versions(manifest).withColumn("folded", merkle.folded_root())
    return manifest, made


def third(docs):
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return F.when(chosen, merkle.lower_cased(VALUES)(docs))


def group_sizes():
    """Around every border of levels and blocks."""
    return [1, 2, 7, 8, 9, 63, 64, 65, 511, 512, 513, 1100, 4097]


def made_up_documents(spark, sizes):
    ids = iter(range(10**6))
    rows = [(next(ids), f"Text {i} of {g}", None if g == 0 else f"l{g}", "s", i) for g, n in enumerate(sizes) for i in range(n)]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_manifest_matches_brute_force(spark):
    docs = made_up_documents(spark, group_sizes()).cache()
    _, made = manifest_rows(docs, third)
    expected = brute.merkle([r.asDict() for r in docs.collect()])
    got = {r.id: (r.leaf, r.subroot, r.root, r.proof_sha256, r.folded) for r in made.collect()}
    assert got == expected


@pytest.mark.parametrize("sizes", [[1], [3], [9] * 1, [600], [1] * 70])
def test_few_and_many_groups(spark, sizes):
    docs = made_up_documents(spark, sizes).cache()
    _, made = manifest_rows(docs, third)
    got = {r.id: (r.leaf, r.subroot, r.root, r.proof_sha256, r.folded) for r in made.collect()}
    assert got == brute.merkle([r.asDict() for r in docs.collect()])


def test_more_tiers(spark):
    """Blocks of 64 leaves put a tree of 5,000 leaves on three tiers."""
    docs = made_up_documents(spark, [5000, 64, 65, 1, *[1] * 70]).cache()
    _, made = manifest_rows(docs, third, levels=2)
    got = {r.id: (r.leaf, r.subroot, r.root, r.proof_sha256, r.folded) for r in made.collect()}
    assert got == brute.merkle([r.asDict() for r in docs.collect()])


def test_versions_share_all_but_the_changed_path(spark):
    docs = made_up_documents(spark, [700, 20]).cache()
    manifest, made = manifest_rows(docs, third)
    made = made.filter("changed IS NOT NULL").orderBy("id").limit(12).cache()
    nodes = merkle.version_nodes(manifest, made).collect()
    by_id = {r.doc_id: r for r in docs.collect()}
    for row in made.collect():
        rows = [r for r in by_id.values() if r.lang == by_id[row.id].lang]
        levels = brute.levels([brute.leaf(r.asDict(), r.doc_id == row.id) for r in sorted(rows, key=lambda r: r.doc_id)])
        mine = [n for n in nodes if n.id == row.id]
        assert {(n.level, n.place): n.digest for n in mine} == {
            (k, i): d for k, level in enumerate(levels) for i, d in enumerate(level)
        }
        assert sum(not n.shared for n in mine) == len(levels)


def test_odd_rows_of_a_manifest(odd_documents):
    manifest, made = manifest_rows(odd_documents, third)
    rows = made.collect()
    assert len(rows) == odd_documents.count() and len({r.root for r in rows}) == 1
    # Both rows of id 5 are leaves of their own; a missing id is never changed.
    assert sorted(r.id for r in rows if r.id is not None).count(5) == 2
    assert all(r.changed is None for r in rows if r.id is None)
    empty, none = manifest_rows(odd_documents.limit(0))
    assert none.collect() == [] and empty.root is None


def test_a_wrong_digest_shows(spark):
    docs = made_up_documents(spark, [100])
    _, made = manifest_rows(docs, third)
    rows = made.collect()
    assert all((r.folded == r.root) == (r.changed is None or r.changed == r.leaf) for r in rows)
    assert {r.folded == r.root for r in rows} == {True, False}


# Fingerprints


def prints(make, texts):
    rows = fingerprints.fingerprints(make(texts)).orderBy("doc_id").collect()
    return [r.fingerprint for r in rows]


def near(spark, pairs):
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    return [r[0] for r in frame.orderBy("i").select(fingerprints.likeness("a", "b")).collect()]


def prose(rng, words):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(words))


def test_fingerprints_match_brute_force(spark, make):
    """Which k-mers a component stands for, from the same hashes taken one by one."""
    rng = random.Random(5)
    texts = ["", " \n", "one", "one two", "a b c", "a " * 500, prose(rng, 40), prose(rng, 900), "w" * 100, "ab cd " * 30 + prose(rng, 50)]
    texts += [" ".join(rng.choice("xyz") for _ in range(rng.randrange(300))) for _ in range(20)]
    got = prints(make, texts)

    def hashed(kmers):
        names = [f"k{i}" for i in range(fingerprints.KMER)]
        rows = spark.createDataFrame([k + (None,) * (3 - len(k)) for k in kmers], ", ".join(f"{n} string" for n in names))
        return {tuple(x for x in r[:3] if x is not None): r[3] for r in rows.select(*names, F.xxhash64(*names)).collect()}

    cut = [brute.pieces(t, fingerprints.PIECE_CHARS) for t in texts]
    kmers = {tuple(w[i : i + 3]) for w in cut for i in range(max(1, len(w) - 2)) if w}
    mask = -(1 << 24)
    first = {k: h & mask for k, h in hashed(sorted(kmers)).items()}
    again = spark.createDataFrame([(h, n) for h in set(first.values()) for n in range(1, 500)], "h bigint, n int")
    later = {(r.h, r.n): r[2] & mask for r in again.select("h", "n", F.xxhash64("h", "n")).collect()}
    tuples, expected = set(), []
    for words in cut:
        seen, elements = {}, []
        for i in range(max(1, len(words) - 2) if words else 0):
            h = first[tuple(words[i : i + 3])]
            n = seen[h] = seen.get(h, -1) + 1
            elements.append((later[h, n] if n else h, i))
        components = {}
        for e in sorted(elements):
            components.setdefault(e[0] >> 58, []).append(e)
        components = {p: tuple(h for h, _ in sorted(es[: fingerprints.TUPLE], key=lambda e: e[1])) for p, es in components.items()}
        tuples |= set(components.values())
        expected.append(components)
    listed = spark.createDataFrame([(list(t),) for t in tuples], "t array<bigint>")
    code = {tuple(r.t): f"{r[1] & 0xFFFFFFFF:08X}" for r in listed.select("t", F.hash("t")).collect()}
    assert got == ["".join(code[c[p]] if p in c else "-" * 8 for p in range(-32, 32)) for c in expected]


def test_likeness_follows_edits_and_order(spark, make):
    rng = random.Random(6)
    words = prose(rng, 2000).split()
    few = [w if i % 50 else "changed" for i, w in enumerate(words)]
    moved = words[1000:] + words[:1000]
    texts = [words, words, few, words[:1000] + prose(rng, 1000).split(), prose(rng, 2000).split(), moved]
    found = prints(make, [" ".join(t) for t in texts])
    same, little, half, other, order = near(spark, [(found[0], f) for f in found[1:]])
    assert same == 1 and other == 0 and 0.6 < little < 1 and 0.02 < half < 0.3
    # The same k-mers in another order: a set's sketch would call these equal.
    assert 0.2 < order < 0.8


def test_likeness_of_empty_texts(spark, make):
    found = prints(make, ["", None, "a b c d e"])
    assert found[0] == found[1] == "-" * 512
    assert near(spark, [(found[0], found[1]), (found[0], found[2]), (found[0], None)]) == [1.0, 0.0, None]


def test_next_documents_over_many_ranges(spark, make):
    texts = [f"text {i}" for i in range(900)]
    docs = make(texts).withColumn("doc_id", F.expr("doc_id * doc_id * 7 - 100")).repartition(5)
    found = fingerprints.next_documents(docs, carried=("n_chars",), range_rows=20, sample=300)
    ids = sorted((r.doc_id for r in docs.collect()), reverse=True)
    text = {r.doc_id: r.text for r in docs.collect()}
    after = dict(zip(ids, ids[1:] + ids[:1]))
    rows = found.collect()
    assert len(rows) == 900 and all(r.next_text == text[after[r.doc_id]] for r in rows)
    assert found.columns == [*docs.columns, "next_text", "next_n_chars"]


def test_edits_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = sorted(docs.collect(), key=lambda r: -r.doc_id)
    after = dict(zip((r.doc_id for r in rows), rows[1:] + rows[:1]))
    found = {r.doc_id: r for r in QUERIES["op13_document_fingerprints"](spark, SF_DIR).collect()}
    assert found.keys() == after.keys()
    for r in rows:
        text, more = r.text or "", after[r.doc_id].text or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + more[:half]
        got = found[r.doc_id]
        assert got.n_chars == len(text)
        assert got.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if text == more:
            assert got.fingerprint == found[after[r.doc_id].doc_id].fingerprint and got.near_next == 1
    spread = [r.near_edited - r.near_next for r in found.values() if r.n_chars > 400]
    assert sum(spread) / len(spread) > 0.08


def test_odd_rows_of_fingerprints(spark, odd_documents):
    docs = odd_documents.withColumn("fingerprint", F.lit("own")).withColumn("next_text", F.lit("own"))
    found = fingerprints.fingerprints(docs)
    assert found.columns == [c for c in docs.columns if c != "fingerprint"] + ["fingerprint"]
    assert found.count() == docs.count()
    assert fingerprints.next_documents(docs).filter("next_text = 'own'").count() == 0
    made = fingerprints.edit_likeness(docs)
    rows = made.collect()
    assert len(rows) == docs.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert fingerprints.edit_likeness(docs.limit(0)).collect() == []
    (alone,) = fingerprints.edit_likeness(docs.filter("doc_id = 7")).collect()
    assert alone.near_next == 1


def test_fingerprints_run_no_python(spark, plan_text):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = plan_text(fingerprints.edit_likeness(docs))
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hash") + plan.count("\n(") > 0
    assert plan.count("hashpartitioning") == plan.count("hashpartitioning(_range")


def test_crc_of_the_sql_matches():
    import duckdb
    from pointstream.llm.oracles import _CRC_TABLE, _crc

    for text in ("", "0", "123456789", "7:größe", "-5"):
        found = duckdb.sql(f"SELECT {_crc('x')} FROM (SELECT '{text}' AS x) CROSS JOIN {_CRC_TABLE} AS crc_table").fetchall()
        assert found == [(zlib.crc32(text.encode()),)]
