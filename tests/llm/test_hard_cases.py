"""Crafted words, very long words and texts, and ids that several rows share."""

import hashlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinesia.llm import bpe, langid, ngram_join, pii, suffix_dedup, window_dedup
from kinesia.llm.queries import tokenizer_path
from kinesia.llm.text import word_hashes

ROW = "doc_id long, text string"


def _opposites(letters):
    """Two words that differ in every letter and collide in any polynomial hash modulo 2**64."""
    ones = [bin(i).count("1") % 2 for i in range(letters)]
    return "".join("ab"[x] for x in ones), "".join("ba"[x] for x in ones)


@pytest.mark.parametrize("letters", [8, 32, 64, 512, 1024, 2048])
def test_crafted_words_have_hashes_of_their_own(letters):
    a, b = _opposites(letters)
    _, _, h = word_hashes(np.frombuffer(f"{a} {b} {a}".encode(), np.uint8))
    assert h[0] == h[2] != h[1]


def test_crafted_words_are_not_linked(spark):
    a, b = _opposites(1024)
    rest = " ".join(f"w{i}" for i in range(11))
    docs = spark.createDataFrame([(1, a), (2, b), (3, f"{a} {rest}"), (4, f"{b} {rest}")], ROW)
    out = {r["doc_id"]: r["component_id"] for r in ngram_join.similar_sets(spark, docs, words=4, percent=85).collect()}
    assert out == {1: 1, 2: 2, 3: 3, 4: 4}


def test_crafted_words_make_other_windows(spark):
    a, b = _opposites(1024)
    rest = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"{a} {rest}"), (2, f"{b} {rest}"), (3, f"{a} {rest}")], ROW)
    out = {r["doc_id"]: r["n_removed"] for r in window_dedup.window_digests(spark, docs).collect()}
    assert out == {1: 0, 2: 0, 3: 13}


def test_ngram_join_of_ids_with_several_texts(spark):
    rng = random.Random(3)
    one, two, three = (" ".join(f"t{rng.randrange(10**6)}" for _ in range(60)) for _ in range(3))
    rows = [(5, one), (5, two), (2, one), (7, two), (9, three), (9, three), (4, None), (4, three), (None, one), (8, "")]
    out = ngram_join.similar_sets(spark, spark.createDataFrame(rows, ROW), words=4, percent=85)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect()), key=str)
    # 2 - 5 - 7 through the two texts of 5, 4 - 9 through the second text of 4
    want = [(5, 57, 2), (5, 57, 2), (2, 57, 2), (7, 57, 2), (9, 57, 4), (9, 57, 4), (4, 0, 4), (4, 57, 4), (None, 57, None), (8, 0, 8)]
    assert got == sorted(want, key=str)


def test_suffix_dedup_of_ids_with_several_texts(spark):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared, own = text(300), text(500)
    rows = [(1, "short"), (1, shared + "!"), (2, own + shared), (3, own[:150]), (None, shared), (1, "short")]
    out = suffix_dedup.suffix_digests(spark, spark.createDataFrame(rows, ROW), 200).collect()
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in out), key=str)
    want = [(1, 5, 0, 0), (1, 5, 0, 0), (1, 301, 300, 1), (2, 800, 300, 1), (3, 150, 0, 0), (None, 300, 0, 0)]
    assert got == sorted(want, key=str)


def test_long_words_equal_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    library.no_truncation()
    library.no_padding()
    ours = bpe.load(tokenizer_path())
    rng = random.Random(5)
    for n in (63, 64, 65, 66, 127, 400, 3000):
        for letters in ("ab", "etaoinshrdlu", "a", "éßñ漢x"):
            word = "".join(rng.choice(letters) for _ in range(n))
            text = f"so {word} {word[:64]} it"
            want = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ours.encode(text), "<u4").tolist() == want


def test_a_word_of_a_million_letters_ends():
    rng = random.Random(6)
    word = "".join(rng.choice("etaoinshrdlu") for _ in range(10**6))
    start = time.monotonic()
    ours = bpe.load(tokenizer_path())
    ids = ours.encode(word)
    assert ours.decode(ids).replace(" ", "").replace("</w>", "") == word
    assert time.monotonic() - start < 120


def test_many_addresses_in_one_text(spark):
    n = 50_000
    text = " ".join(f"é{i} u{i}@host{i % 7}.org," for i in range(n))
    want, at = [], 0
    for i in range(n):
        mail = f"u{i}@host{i % 7}.org"
        start = at + len(f"é{i} ")
        want.append((start, start + len(mail), mail))
        at = start + len(mail) + 2
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], ROW)
    out = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", pii.base_spans(F.col("text"), "email").alias("s"))
    got = {r["doc_id"]: [(s["start"], s["end"], s["value"]) for s in r["s"]] for r in out.collect()}
    assert got == {1: want, 2: [], 3: []}


def test_texts_longer_than_a_block(spark):
    """Texts of several blocks through the operators that cut texts: shingles, windows, letters."""
    rng = random.Random(8)
    words = [f"w{rng.randrange(5000)}" for _ in range(300_000)]
    long = " ".join(words)
    near = " ".join(words[:-1000])
    docs = spark.createDataFrame([(1, long), (2, near), (3, " ".join(words[1000:1100]))], ROW)
    sets = {i: len({tuple(w[j : j + 4]) for j in range(len(w) - 3)}) for i, w in ((1, words), (2, words[:-1000]), (3, words[1000:1100]))}
    out = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar_sets(spark, docs, words=4, percent=85).collect()}
    assert out == {1: (sets[1], 1), 2: (sets[2], 1), 3: (sets[3], 3)}
    kept = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in window_dedup.window_digests(spark, docs).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert kept[1][:2] == (300_000, 0)
    assert kept[2] == (299_000, 299_000, nothing) and kept[3] == (100, 100, nothing)
    parts = [langid.Bundler().counts(t)[0] for t in (long, long[: 1 << 20])]
    assert parts[0].sum() > parts[1].sum() > 0


def test_word_table_goes_with_the_task():
    with bpe.task_encoder(tokenizer_path()) as coder:
        coder.encode("some words to keep")
        assert coder.encoded.cache_info().currsize
    assert not coder.encoded.cache_info().currsize
