"""Token ids, counts, files, packing, chat and languages."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

import llm_brute as brute
from llm_cases import SF_DIR, make, odd_documents, workers_find_the_package  # noqa: F401
from pointstream.llm import cached_tokens, chat, language, lexical_packing, token_counts, token_files

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def encoded(path, texts):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


ALPHABET = "aBzé ß'ts.,;!|*#0 12\n\t\r  語é́İ<|>end　​\x1c"


@pytest.mark.parametrize("path, encoder", [(BYTES, cached_tokens.byte_level), (WORDS, cached_tokens.word_level)])
def test_cached_ids_are_those_of_the_library(path, encoder, monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randrange(60))) for _ in range(3000)]
    texts += ["Word.\nNext, it's 'the don't  two\n\nlines <|endoftext|> x" * 3, " lead", "trail ", "\n", "a" * 500]
    monkeypatch.setattr(cached_tokens, "PART_BYTES", 2000)
    own = encoder.__wrapped__(path)
    own.words.limit = 50_000  # so that generations turn
    expected = encoded(path, texts)
    for _ in range(2):
        assert [ids.tolist() for ids in own.encode(texts)] == expected
        assert len(own.words.young) <= 1000
    assert [ids.tolist() for ids in own.encode(["", None, "\n"])][:2] == [[], []]
    column = pa.array([None, *texts[:20]])
    assert [ids.tolist() for ids in own.encode(column.slice(3))] == expected[2:20]


@pytest.mark.parametrize("path, encoder", [(BYTES, cached_tokens.byte_level), (WORDS, cached_tokens.word_level)])
def test_ids_of_all_documents_are_those_of_the_library(spark, path, encoder):
    texts = [r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    texts += [chr(n) + " a" + chr(n) + "b " + chr(n) for n in (*range(0x500), *range(0x1680, 0x3100, 3), 0xFEFF)]
    assert [ids.tolist() for ids in encoder.__wrapped__(path).encode(texts)] == encoded(path, texts)


SPECIAL = ["a <|endoftext|> b", "<|startoftext|>Word.\n<|endoftext|>", "x<|endoftext|>", "plain words, no more"]


@pytest.mark.parametrize("path, encoder", [(BYTES, cached_tokens.byte_level), (WORDS, cached_tokens.word_level)])
def test_special_tokens_in_texts_are_those_of_an_untouched_library(path, encoder):
    expected = [e.ids for e in Tokenizer.from_file(path).encode_batch(SPECIAL, add_special_tokens=False)]
    got = [ids.tolist() for ids in encoder.__wrapped__(path, special=True).encode(SPECIAL)]
    assert got == expected


def test_files_and_packing_read_special_tokens(make):
    docs = make(SPECIAL)
    for path, end, rows in (
        (BYTES, 0, [(r.doc_id, r.n_tokens, r.ids_crc32) for r in read_back(docs)]),
        (WORDS, 1, [(r.doc_id, r.doc_tokens, r.ids_crc32) for r in lexical_packing.packed(docs, WORDS).collect()]),
    ):
        found = Tokenizer.from_file(path).encode_batch(SPECIAL, add_special_tokens=False)
        ids = [np.array(e.ids + [end], dtype="<u4") for e in found]
        assert sorted(rows) == [(i, len(own), zlib.crc32(own.tobytes())) for i, own in enumerate(ids)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, (1 << 17) - 1), max_size=300), st.integers(17, 24))
def test_packing_of_bits_round_trips(ids, bits):
    ids = np.array(ids, dtype="<u4")
    body = token_files.packed(ids, bits)
    assert len(body) == (len(ids) * bits + 7) // 8
    assert token_files.unpacked(body, bits, len(ids)).tolist() == ids.tolist()


def test_files_give_any_range(monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 7)
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 1000, n).astype("<u4") for n in (0, 1, 7, 30, 2)]
    for bits in (10, 16):
        body = token_files.file_of([5, None, 7, 8, 9], docs, bits)
        file, flat = token_files.TokenFile(body), np.concatenate(docs)
        for _ in range(100):
            a, b = sorted(rng.integers(0, len(flat) + 1, 2))
            assert file.ids(a, b).tolist() == flat[a:b].tolist()
        assert file.starts.tolist() == [0, 0, 1, 8, 38, 40]
    assert token_files.bits_for(50257) == 16 and token_files.bits_for(1) == 1


def read_back(docs):
    files = token_files.write_token_files(docs, BYTES)
    return token_files.read_documents(files).orderBy("start").collect()


def test_written_files_hold_all_ids(spark, odd_documents, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_IDS", 5000)
    for docs in (spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(3), odd_documents):
        rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        start, expected = 0, []
        for (doc, _), ids in zip(rows, encoded(BYTES, [t for _, t in rows])):
            ids = ids + [0]
            expected.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
            start += len(ids)
        got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in read_back(docs)]
        assert [g[1:3] for g in got] == [e[1:3] for e in expected]
        assert sorted(map(str, got)) == sorted(map(str, expected))
    assert read_back(odd_documents.limit(0)) == []


def check_packing(docs):
    pieces = lexical_packing.packed(docs, WORDS).collect()
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    ids = [i + [1] for i in encoded(WORDS, [t for _, t in rows])]
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    wanted = defaultdict(list)
    for (doc, _), own in zip(rows, ids):
        wanted[doc].append(own)
    for doc, texts in wanted.items():
        assert sum(p.length for p in by_doc[doc]) == sum(map(len, texts))
        if len(texts) > 1:
            continue
        (own,), at = texts, 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            body = np.array(own[p.start : p.start + p.length], dtype="<u4").tobytes()
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(own), zlib.crc32(body))
            at += p.length
    for placed in by_sequence.values():
        at = 0
        for p in sorted(placed, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= lexical_packing.WINDOW
    assert by_doc.keys() == wanted.keys()
    return by_sequence


def test_packing_keeps_every_id_once(spark, odd_documents, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sequences = check_packing(docs)
    filled = sum(p.length for ps in sequences.values() for p in ps)
    assert filled / lexical_packing.WINDOW / len(sequences) > 0.98
    check_packing(odd_documents)
    monkeypatch.setattr(lexical_packing, "SHARD_TOKENS", 20_000)
    check_packing(docs)
    assert lexical_packing.packed(odd_documents.limit(0), WORDS).count() == 0


def test_neighbours_share_words(make):
    def text(topic, i):
        return " ".join(f"{topic}{(i * 7 + j) % 40}" for j in range(150))

    topics = ["alpha", "omega", "sigma", "kappa"]
    sequences = check_packing(make([text(t, i) for i in range(12) for t in topics]))
    mixed = [len({p.doc_id % 4 for p in ps}) for ps in sequences.values()]
    assert np.mean(mixed) < 2.5


def test_neighbours_meet_in_many_shards(make, monkeypatch):
    """Topics and near copies, dealt far apart: their documents still share shards."""
    rng = random.Random(11)
    common = [f"word{i}" for i in range(300)]
    texts = []
    for topic in range(60):
        own = ["".join(rng.choices("bcdfghjklmnpqrstvwxz", k=7)) for _ in range(8)]
        for _ in range(6):
            texts.append(" ".join(rng.choices(common, k=60) + rng.choices(own, k=40)))
    copies = []
    for i in range(100):
        words = [rng.choice(common) + "".join(rng.choices("aeiou", k=3)) for _ in range(120)]
        for _ in range(2):
            words[rng.randrange(120)] = rng.choice(common)
            copies.append(" ".join(words))
    order = list(range(len(texts) + len(copies)))
    rng.shuffle(order)
    group = [i // 6 if i < len(texts) else 60 + (i - len(texts)) // 2 for i in order]
    monkeypatch.setattr(lexical_packing, "SHARD_TOKENS", 6000)
    sequences = check_packing(make([(texts + copies)[i] for i in order]))
    assert len(sequences) > 30
    where = defaultdict(list)
    for sequence, pieces in sequences.items():
        for doc in {p.doc_id for p in pieces}:
            where[group[doc]].append(sequence)
    # A shard holds three sequences or four, numbered one after the other.
    def met(group, least):
        return any(sum(abs(s - t) < 4 for t in where[group]) >= least for s in where[group])

    assert np.mean([met(g, 4) for g in range(60)]) > 0.8
    assert np.mean([met(g, 2) for g in range(60, 160)]) > 0.6


def test_counts_are_those_of_a_unigram_tokenizer(spark, make, odd_documents):
    pieces, fallback = token_counts.vocabulary(PIECES)
    assert fallback
    every = [("<unk>", 0.0)] + [(f"<0x{i:02X}>", 0.0) for i in range(256)] + pieces
    tokenizer = Tokenizer(models.Unigram(every, 0, True))
    rng = random.Random(6)
    made = make(["".join(rng.choices("aeinst  \n▁ßé語\U0001f600.", k=rng.randrange(50))) for _ in range(500)])
    for docs in (spark.read.parquet(f"{SF_DIR}/documents.parquet"), made, odd_documents):
        for r in token_counts.token_counts(docs, PIECES, keep=["doc_id", "text"]).collect():
            marked = "▁" + r.text.replace(" ", "▁") if r.text else ""
            assert r.n_tokens == len(tokenizer.encode(marked).ids), r.text[:60]
    assert token_counts.token_counts(odd_documents, PIECES).columns.count("n_tokens") == 1
    assert token_counts.token_counts(odd_documents.limit(0), PIECES).count() == 0


def test_ties_and_unknown_characters():
    ties = token_counts.Counter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("c", -5.0)], False)
    assert ties.count(["ab"]) == [(-2.0 - 15.0, 2)]  # the mark is unknown, the longest tie stays
    assert ties._best("xyab") == (-32.0, 2) and ties._best("axxb")[1] == 3
    assert token_counts.Counter([("a", -1.0), ("▁", -1.0)], True).count(["é\na", "", "a a"]) == [
        (-1.0 - 11 - 11 - 1, 5), (0, 0), (-4.0, 4)]




def test_chat_round_trips(spark):
    rng = random.Random(9)
    bits = chat.CONTROL + ["<", "|", "\\", "[", "]", "/", "\n", "x", "é", "im_end|>", "s>", "INST]"]
    roles = ["user", "assistant", "system", "", None, "a\\n\nb\\b", "<|im_end|>", "<\\|im_end|>"]
    rows = []
    for conv in range(150):
        for turn in range(rng.randrange(1, 7)):
            text = "".join(rng.choices(bits, k=rng.randrange(8))) if rng.random() < 0.9 else None
            rows.append((conv, turn, rng.choice(roles), text))
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    formatted = chat.transcripts(frame)
    examples = chat.prefix_examples(formatted)
    back = {r.conv_id: r for r in chat.read_conversations(examples).collect()}
    given_turns = defaultdict(list)
    for conv, _, role, text in rows:
        given_turns[conv].append((role or "", text or ""))
    for conv, turns in given_turns.items():
        assert [tuple(t) for t in back[conv].turns] == turns
        assert back[conv].loss_text == "".join(t for r, t in turns if r == "assistant")
    by_conv = defaultdict(list)
    for e in examples.collect():
        by_conv[e.conv_id].append(e)
    for conv, turns in given_turns.items():
        replies = [t for r, t in turns if r == "assistant"]
        trained = [e for e in by_conv[conv] if e.loss_start < e.loss_end]
        assert len(trained) == sum(bool(t) for t in replies)
        assert all(back[conv].formatted.startswith(e.text) for e in by_conv[conv])
        assert sum(e.last for e in by_conv[conv]) == 1


def test_odd_conversations(spark):
    rows = [(None, 1, "user", "x"), (None, None, "assistant", "y"), (1, 0, None, None), (2, 0, "assistant", "same"),
            (2, 0, "assistant", "same"), (3, 0, "user", "u" * 200_000)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    frame = frame.withColumn("formatted", F.lit("own")).withColumn("turns", F.lit(1))
    back = {r.conv_id: r for r in chat.read_conversations(chat.prefix_examples(chat.transcripts(frame))).collect()}
    turns = {k: [tuple(t) for t in r.turns] for k, r in back.items()}
    assert turns == {None: [("assistant", "y"), ("user", "x")], 1: [("", "")], 2: [("assistant", "same")] * 2,
                     3: [("user", "u" * 200_000)]}
    assert back[2].loss_text == "samesame" and back[3].loss_text == ""
    empty = chat.read_conversations(chat.prefix_examples(chat.transcripts(frame.limit(0))))
    assert empty.count() == 0


def test_languages_of_held_out_documents(spark, odd_documents):
    docs = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = language.train(docs.filter(~held_out))
    rows = language.identified(docs.filter(held_out), model, keep=["doc_id", "lang"]).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert not any(r.rejected for r in rows) and all(0 <= r.score <= 1 for r in rows)
    again = language.train(docs.filter(~held_out).repartition(7))
    assert again.languages == model.languages and np.allclose(again.centroids, model.centroids, atol=1e-4)
    odd = language.identified(odd_documents, model).collect()
    assert {r.lang_pred for r in odd if r.text is None or not any(map(str.isalpha, r.text))} == {"und"}
    assert all(r.lang_pred in model.languages for r in odd if r.text and any(map(str.isalpha, r.text)))
    assert next(r for r in odd if r.doc_id == 4).rejected  # one letter, 100,000 times
    assert language.identified(odd_documents.limit(0), model).count() == 0


def test_every_language_is_learned(make):
    """300 languages, each with words of its own."""
    rng = random.Random(8)
    rows = []
    for number in range(300):
        words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in range(30)]
        rows += [(len(rows) + i, " ".join(rng.choices(words, k=60)), f"l{number:03d}", "s", 0) for i in range(4)]
    docs = make(rows)
    model = language.train(docs.filter("doc_id % 4 != 0"))
    assert len(model.languages) == 300
    found = language.identified(docs.filter("doc_id % 4 = 0"), model).collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.97


def test_rows_of_one_id_are_drawn_apart(spark, make, monkeypatch):
    """An id that all rows share does not make the sample all or none; equal rows come once."""
    monkeypatch.setattr(language, "SAMPLE_PER_LANGUAGE", 100)
    rows = [(None, f"some words of text {i % 1500}", "en", "s", 0) for i in range(3000)]
    given = make(rows).selectExpr("CAST(doc_id AS STRING) AS _id", "text AS _text", "lang AS _lang")
    assert 20 < language._sample(given).count() < 100


def plain_counts(text):
    """Byte 3-grams of a text by feature, one by one."""
    data, codes = text.encode(), []
    for at, byte in enumerate(data):
        code = byte if byte >= 128 else ord(chr(byte).lower()) if chr(byte).isalpha() else 32
        if at and data[at - 1] == 0xC3 and 0x80 <= byte <= 0x9E:
            code += 0x20
        if not (code == 32 and codes and codes[-1] == 32):
            codes.append(code)
    counts = defaultdict(int)
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        counts[((a * 65_537 + b * 257 + c) * 2_654_435_761 >> 15) % language.SIZE] += 1
    return counts


def test_predictions_match_brute_force(spark, make):
    """Weights, cosines and the nearest centroid, one by one."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = [r.text or "" for r in docs.collect() if r.lang is not None and r.text is not None]
    model = language.train(docs)
    held = defaultdict(int)
    for text in texts:
        for feature in plain_counts(text):
            held[feature] += 1
    idf = [np.log((1 + len(texts)) / (1 + held[f])) + 1 for f in range(language.SIZE)]
    assert np.allclose(idf, model.idf, atol=1e-5)
    odd = ["Ünd ÉTÉ là", "a", "ab", "  x  y  ", "日本語 text", "ÀÉÎÕÜ"]
    rows = language.identified(make(texts[:60] + odd), model).orderBy("doc_id").collect()
    for text, row in zip(texts[:60] + odd, rows):
        weights = {f: np.log1p(n) * idf[f] for f, n in plain_counts(text).items()}
        length = np.sqrt(sum(w * w for w in weights.values())) or 1.0
        cosine = [sum(w * c[f] for f, w in weights.items()) / length for c in model.centroids.astype(float)]
        best = max(cosine)
        if any(map(str.isalpha, text)):
            near = {model.languages[model.language[i]] for i, c in enumerate(cosine) if c > best - 1e-4}
            assert row.lang_pred in near and row.score == pytest.approx(max(best, 0), abs=1e-3)


def test_plain_version_of_the_centroid_rule(spark, make):
    texts = ["the cat and the dog " * 5, "der hund und die katze " * 5, "les chats et le chien " * 5, "x"]
    docs = make([(i, t, l, "s", 0) for i, (t, l) in enumerate(zip(texts, ["en", "de", "fr", None]))])
    model = language.train(docs)
    assert model.languages == ["de", "en", "fr"]
    got = language.identified(docs, model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got[:3]] == ["en", "de", "fr"] and got[0].score == pytest.approx(1, abs=1e-5)
    none = language.train(docs.limit(0))
    assert {(r.lang_pred, r.score, r.rejected) for r in language.identified(docs, none).collect()} == {("und", 0.0, True)}


def test_neighbours_are_in_the_order_of_their_scores():
    """Against BM25 taken pair by pair, over every id of the seed."""
    rng = np.random.default_rng(3)
    docs = [rng.zipf(1.4, rng.integers(1, 120)) % 200 for _ in range(60)]
    idf = rng.random(200).astype(np.float32) * 5
    index = lexical_packing.Index(docs, idf, 40.0)
    k1, b = lexical_packing.K1, lexical_packing.B

    def score(seed, doc):
        norm = k1 * (1 - b + b * len(doc) / 40.0)
        tf = {t: int((doc == t).sum()) for t in set(seed.tolist()) & set(doc.tolist())}
        return sum(idf[t] * n * (k1 + 1) / (n + norm) for t, n in tf.items())

    for seed in range(60):
        index.free[:] = True
        index.free[[seed, (seed + 1) % 60]] = False
        found = list(index.neighbours(seed))
        expected = {i: score(docs[seed], docs[i]) for i in range(60) if index.free[i]}
        assert set(found) == {i for i, s in expected.items() if s > 0}
        scores = [expected[i] for i in found]
        assert all(x >= y - 1e-3 for x, y in zip(scores, scores[1:]))


def test_frequencies_are_of_whole_documents(spark, make):
    """Also of the full windows of long ones."""
    texts = ["alpha " * 5000 + "beta", "beta gamma", None, "alpha"]
    rows = lexical_packing.tokenized(make(texts).coalesce(1), WORDS, "doc_id", "text").cache()
    tokenizer = Tokenizer.from_file(WORDS)
    expected = defaultdict(int)
    for t in texts:
        for i in {*tokenizer.encode(t or "", add_special_tokens=False).ids, lexical_packing.END}:
            expected[i] += 1
    assert lexical_packing._document_frequencies(rows) == expected
    assert rows.filter("row IS NULL").count() == 1 and rows.filter("row IS NOT NULL").count() == 4
