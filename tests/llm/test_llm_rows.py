"""Operators that work row by row against brute force: personal data, quality, licences."""

import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import llm_brute as brute
from llm_cases import SF_DIR, make, odd_documents, workers_find_the_package  # noqa: F401
from pointstream.llm import licence_texts, license_scan, pii, quality


def spans(frame):
    return [r[0] for r in frame.select(pii.span_text(pii.BASE_KINDS)).collect()]


def test_spans_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").cache()
    expected = [",".join(brute.pii(r.text)) for r in docs.collect()]
    assert spans(pii.pii_spans(docs).orderBy("doc_id")) == expected and any(expected)


def test_made_up_texts_match_brute_force(make):
    rng = random.Random(8)
    bits = ["a", "é", "\U0001f600", "@", ".", "..", "-", "+", " ", "\n", "1", "25", "256", "007", "(", ")", "_", "%",
            "a@b.c", "x@y.z_w@v.u", "1.2.3.4", "+1 (988) 555-2485", "4041894974608795", "4041 8949-7460 8795"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(400)]
    got = spans(pii.pii_spans(make(texts)).orderBy("doc_id"))
    assert got == [",".join(brute.pii(t)) for t in texts]


def test_checksums_and_context(make):
    texts = [
        "IBAN GB82 WEST 1234 5698 7654 32 ok",
        "pay DE89370400440532013000.",
        "wrong DE89370400440532013001.",
        "his social security number 123-45-6789",
        "part number 123-45-6789",
    ]
    found = pii.pii_spans(make(texts)).orderBy("doc_id").select(pii.span_text()).collect()
    assert [r[0] for r in found] == ["iban:5:32", "iban:4:26", "", "ssn:27:38", ""]
    (score,) = [r.pii[0].score for r in pii.pii_spans(make(texts[:1])).collect()]
    assert score == pytest.approx(0.9)


def test_context_is_on_both_sides_and_beyond_other_matches(make):
    filler = "x" * 5000
    texts = [
        "SSN: 123-45-6789, 987-65-4321",
        "123-45-6789 is the SSN",
        "123-45-6789 and, much later on in this very text, a remark on security",
        f"{filler} 123-45-6789 {filler}",
        f"{filler} social 123-45-6789 {filler}",
        filler[:4090] + " 123-45-6789 is for insurance " + filler,
        "insurance " + "y" * 30 + "123-45-6789, 987-65-4321",
    ]
    found = pii.pii_spans(make(texts)).orderBy("doc_id").select(pii.span_text()).collect()
    assert [r[0] for r in found] == [
        "ssn:5:16,ssn:18:29", "ssn:0:11", "", "", "ssn:5008:5019", "ssn:4091:4102", "ssn:40:51"
    ]
    got = [r.text for r in pii.redact(make(texts[:2])).orderBy("doc_id").collect()]
    assert got == ["SSN: [SSN], [SSN]", "[SSN] is the SSN"]


def test_account_numbers_before_other_words(make):
    texts = [
        "ES91 2100 0418 4502 0005 1332 BIC X",
        "PL61 1090 1014 0000 0712 1981 2874 VAT 1",
        "SE45 5000 0000 0583 9825 7466 2024",
    ]
    found = pii.pii_spans(make(texts)).orderBy("doc_id").select(pii.span_text()).collect()
    assert [r[0] for r in found] == ["iban:0:29", "iban:0:34", "iban:0:29"]


def test_redaction(make):
    long = "é" * 5000 + " a@b.cc " + "z" * 9000 + " 1.2.3.4 " + "y" * 100
    texts = ["no data", None, "", "a@b.cc", "call +1 (988) 555-2485 or 1.2.3.4!", "+12 1.2.3.4 5678901", long]
    got = [r.text for r in pii.redact(make(texts)).orderBy("doc_id").collect()]
    assert got[:4] == ["no data", None, "", "[EMAIL]"]
    assert got[4] == "call [PHONE] or [IP]!"
    # Spans that overlap become one, named for the first.
    assert got[5] == "[PHONE]"
    assert got[6] == long.replace("a@b.cc", "[EMAIL]").replace("1.2.3.4", "[IP]")


def test_long_runs_take_linear_time(make):
    texts = ["x" * 300_000, "1" * 300_000, "1." * 100_000, "a@" + "b." * 100_000, "+" * 100_000, "+1" + " " * 200_000]
    start = time.time()
    got = spans(pii.pii_spans(make(texts)).orderBy("doc_id"))
    assert time.time() - start < 60
    assert got[0] == got[1] == got[4] == got[5] == "" and got[3] == "email:0:200001"
    assert got[2].startswith("ip:0:7,ip:8:15,")


def test_odd_rows_of_personal_data(odd_documents):
    found = pii.pii_spans(odd_documents)
    assert found.columns == [c for c in odd_documents.columns if c != "pii"] + ["pii"]
    assert {len(r.pii) for r in found.collect()} == {0}
    redacted = pii.redact(odd_documents)
    assert redacted.columns == odd_documents.columns
    assert sorted(map(str, redacted.collect())) == sorted(map(str, odd_documents.collect()))
    assert pii.redact(odd_documents.limit(0)).count() == 0


def test_measures_match_brute_force(spark, odd_documents):
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for frame in (docs, odd_documents.drop(*base)):
        got = quality.judged(frame, keep=["doc_id", "text"]).collect()
        assert len(got) == frame.count()
        for r in got:
            assert tuple(r[n] for n in base) == brute.measures(r.text)
            failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
            assert r.base_failed == failed and not (failed and r.kept) and 0 <= r.quality <= 1
    kept = quality.judged(odd_documents)
    assert kept.count() == 12 and kept.columns.count("n_words") == 1
    assert {r.pattern for r in kept.collect()} == {"own pattern"}
    assert quality.judged(odd_documents.limit(0)).count() == 0


def test_verdicts_agree_with_labels(spark):
    sf = SF_DIR.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    judged = quality.judged(docs, keep=["doc_id"]).join(labels, "doc_id").filter("NOT base_failed")
    rows = judged.select("label", "kept").collect()
    assert all(r.kept for r in rows if r.label == 1)
    assert np.mean([not r.kept for r in rows if r.label == 0]) > 0.9


def bad_votes(pattern):
    return (quality._digits(pattern) == quality.BAD).sum(axis=1)


def test_the_verdict_is_not_that_all_must_pass(spark):
    """Documents with one bad vote are kept where their other votes outweigh it."""
    sf = SF_DIR.replace("0.001", "0.1")
    judged = quality.judged(spark.read.parquet(f"{sf}/documents.parquet"), keep=["doc_id"])
    voted = judged.filter("NOT base_failed").withColumn("pattern", quality.votes())
    rows = voted.groupBy("pattern", "kept").count().collect()
    one = {k: sum(r["count"] for r in rows if r.kept == k and bad_votes(np.array([r.pattern]))[0] == 1) for k in (True, False)}
    assert one[True] > 20
    assert not any(r.kept for r in rows if bad_votes(np.array([r.pattern]))[0] > 2)
    assert all(r.kept for r in rows if bad_votes(np.array([r.pattern]))[0] == 0)


def made_up_votes(rng, alarms, hits, share=0.85, size=40_000):
    """Votes of independent rules with the given rates of bad votes on good and bad documents."""
    good = rng.random(size) < share
    rate = np.where(good[:, None], alarms, hits)
    votes = np.where(rng.random((size, len(quality.RULES))) < rate, quality.BAD, quality.GOOD)
    code = votes @ (3 ** np.arange(votes.shape[1])[::-1])
    pattern, count = np.unique(code, return_counts=True)
    return good, code, pattern, count.astype(float)


def test_estimation_finds_the_accuracies_of_made_up_rules():
    """Precise rules, noisy ones, and one that says nothing."""
    alarms = np.array([0.01, 0.02, 0.01, 0.05, 0.2, 0.3, 0.1, 0.3])
    hits = np.array([0.5, 0.6, 0.8, 0.7, 0.7, 0.8, 0.4, 0.3])
    good, code, pattern, count = made_up_votes(np.random.default_rng(1), alarms, hits)
    found = quality.estimate(pattern, count)
    assert np.allclose(found.chance[:, 0, quality.BAD], alarms, atol=0.02)
    assert np.allclose(found.chance[:, 1, quality.BAD], hits, atol=0.05)
    assert abs(found.good - 0.85) < 0.02
    verdict = quality.posterior(quality._digits(pattern), found)[np.searchsorted(pattern, code)] >= 0.5
    assert np.mean(verdict == good) > 0.95
    # Documents with one bad vote of a noisy rule are kept, which the rules alone would not.
    single = bad_votes(code) == 1
    assert verdict[single].mean() > 0.9 and good[single].mean() > 0.9


def test_the_share_of_good_documents_can_be_given():
    _, _, pattern, count = made_up_votes(np.random.default_rng(2), 0.1, 0.5, size=5000)
    strict, kind = (quality.estimate(pattern, count, good=share) for share in (0.3, 0.99))
    assert (strict.good, kind.good) == (0.3, 0.99)
    digits = quality._digits(pattern)
    kept = [count[quality.posterior(digits, e) >= 0.5].sum() for e in (strict, kind)]
    assert kept[0] < kept[1]


def test_posterior_against_bayes_by_hand():
    chance = np.repeat(quality.LEAN[None], len(quality.RULES), axis=0)
    known = quality.Estimate(chance, 0.6)
    digits = np.array([[quality.BAD, quality.GOOD] + [quality.ABSTAIN] * 6])
    (a,), (one, two) = quality.posterior(digits, known), (0.6 * 0.05 * 0.75, 0.4 * 0.4 * 0.4)
    assert a == pytest.approx(one / (one + two))


def base_places(text):
    words, found = brute.alnum_words(text), []
    for phrase, label in license_scan.BASE_PHRASES.items():
        phrase = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(phrase)] == phrase]
    return len(words), found


def check_licences(frame):
    rows = license_scan.licence_scan(frame, keep=["doc_id", "text"]).collect()
    for r in rows:
        words, found = base_places(r.text)
        places = [i for i, _ in found]
        labels = ",".join(sorted({label for _, label in found}))
        assert (r.n_words, r.n_base, r.base_labels) == (words, len(found), labels)
        assert (r.first_word, r.last_word) == (min(places, default=None), max(places, default=None))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    return {r.doc_id: r for r in rows}


def test_base_phrases_match_brute_force(spark, make, odd_documents):
    check_licences(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    check_licences(odd_documents)
    rng = random.Random(2)
    words = "cc by general public license all rights reserved x, CC, All by.".split()
    check_licences(make([" ".join(rng.choices(words, k=rng.randrange(40))) for _ in range(300)]))
    found = license_scan.licence_scan(odd_documents)
    assert {r["at"] for r in found.collect()} == {"own at"} and found.columns.count("n_words") == 1
    assert license_scan.licence_scan(odd_documents.limit(0)).count() == 0


def test_every_template_is_found_where_it_stands(make):
    templates = [t for t in license_scan.templates() if not t.base]
    texts = ["some words before. " + " ".join(t.words).upper() + ", and after" for t in templates]
    texts += ["Licensed under CC BY-NC 4.0.", "license apache the under licensed version", "mit license"]
    texts += ["permission hereby something granted to nobody"] + ["plain words only"] * 200
    found = check_licences(make(texts))
    for i, t in enumerate(templates):
        assert t.label in found[i].labels.split(","), t
    n = len(templates)
    assert found[n].labels == "cc-by,cc-by-nc-4.0" and found[n].score == 1.0
    assert [found[n + i].labels for i in (1, 3, 4)] == ["", "", ""]


def brute_licences(texts):
    """Labels and best score of each text: every shift of every template, all words compared."""
    known = license_scan.templates()
    vocabulary = set(license_scan.vocabulary(known))
    files = [brute.alnum_words(t) for t in texts]
    df = Counter(w for words in files for w in set(words) & vocabulary)
    held = {w: max(df[w], 1) for w in vocabulary}
    idf = {w: math.log1p((len(files) - n + 0.5) / (n + 0.5)) for w, n in held.items()}

    def place(t, words, s):
        n, slack = len(t.words), t.slack
        keys = all(
            any(words[i : i + len(k)] == k for i in range(max(s, 0), s + n + slack - len(k) + 1)) for k in t.keys
        )
        if not keys:
            return 0.0
        body = [(q, w) for q, w in enumerate(t.words) if w in vocabulary]
        same = [w for q, w in body if w in words[max(s + q, 0) : max(s + q + slack + 1, 0)]]
        return sum(idf[w] for w in same) / sum(idf[w] for _, w in body)

    out = []
    for words in files:
        best = {}
        for t in known:
            shifts = {p - q for p, w in enumerate(words) for q, v in enumerate(t.words) if v == w and w in vocabulary}
            scores = [place(t, words, s) for s in shifts]
            least = 1.0 if t.base else license_scan.LEAST_SCORE
            if max(scores, default=0.0) >= least - 1e-12:
                best[t.label] = max(best.get(t.label, 0.0), max(scores))
        out.append((",".join(sorted(best)), max(best.values(), default=0.0)))
    return out


def test_alignment_matches_brute_force(make):
    rng = random.Random(5)
    known = [t for t in license_scan.templates() if not t.base]
    texts = []
    for t in known * 3:
        words = list(t.words)
        for _ in range(rng.randrange(1 + len(words) // 4)):
            i = rng.randrange(len(words))
            words[i : i + rng.randrange(2)] = rng.choice([[], ["and"], ["license", "version"], ["word"] * 3])
        texts.append(" ".join(["before", "the"] * rng.randrange(3) + words + rng.choice(known).words[:6]))
    texts += ["nothing of the kind here"] * 100
    found = check_licences(make(texts))
    for i, (labels, score) in enumerate(brute_licences(texts)):
        assert found[i].labels == labels, texts[i]
        assert found[i].score == pytest.approx(min(score, 1.0))
    assert sum(1 for i in range(len(known) * 3) if found[i].labels) > 2 * len(known)


def test_versions_headers_and_usual_wordings(make):
    gpl = (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, "
        "or (at your option) any later version."
    )
    isc = (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice appear in all copies."
    )
    kernel = (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License version 2 as published by the Free Software Foundation."
    )
    lesser = gpl.replace("GNU General", "GNU Lesser General").replace("version 2 of", "version 2.1 of")
    whole = {label: text for label, text, _ in licence_texts.WHOLE_TEXTS}
    expected = {
        "Licensed under the GNU Affero General Public License, version 1": "agpl-1.0,gpl",
        "Licensed under the GNU Lesser General Public License, version 2.1": "gpl,lgpl-2.1",
        gpl: "gpl,gpl-2.0",
        gpl.replace("version 2", "version 3"): "gpl,gpl-3.0",
        kernel: "gpl,gpl-2.0",
        lesser: "gpl,lgpl-2.1",
        isc: "isc",
        "// SPDX-License-Identifier: MIT": "mit",
        "# SPDX-License-Identifier: GPL-3.0-or-later": "gpl-3.0",
        whole["bsd-2-clause"]: "bsd,bsd-2-clause",
        whole["bsd-3-clause"]: "bsd,bsd-3-clause",
        whole["mit"].replace("the software", "the material"): "mit",
        "a version of the software under some license": "",
        "GNU General Public License": "gpl",
    }
    found = check_licences(make([*expected, *["plain words only"] * 100]))
    assert [found[i].labels for i in range(len(expected))] == list(expected.values())


def test_licence_texts_can_be_added(make):
    house = ("house", "you may read this text in this house only on rainy days", ["rainy days"])
    frame = make(["You may read this text in our house, on rainy days.", "on sunny days"])
    rows = license_scan.licence_scan(frame, more=[house]).orderBy("doc_id").collect()
    assert [r["labels"] for r in rows] == ["house", ""]
    with pytest.raises(ValueError, match="words"):
        license_scan._vocabulary_hashes(["two words"])
