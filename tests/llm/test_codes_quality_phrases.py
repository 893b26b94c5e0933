"""Vector codes, quality rules and collocations on small tables of hard cases, against brute force and their SQL."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import pytest

from kinesia.llm import collocations, quality, vector_codes
from kinesia.llm.sql import collocations_sql, quality_sql, vector_codes_sql

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n long, phrase string, ws int, _l string, rank int"


# ---------------------------------------------------------------- vector codes


def _codes(rows, rounds=6):
    """(code, error) per row, and the digest, of rows (id, vector, label) in plain integers."""
    kept = [(i, [Fraction(c) * 4096 // 1 for c in v], lab) for i, v, lab in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    step = len(kept[0][1]) // 8
    codes, errors, flat = [""] * len(kept), [0] * len(kept), []
    near = lambda y, cb: min((sum((a - b) ** 2 for a, b in zip(y, c)), e) for e, c in enumerate(cb))
    for p in range(8):
        parts = [v[p * step : (p + 1) * step] for _, v, _ in kept]
        book = [list(y) for y in parts[:16]]
        for _ in range(rounds):
            at = [near(y, book)[1] for y in parts]
            for e in range(len(book)):
                own = [y for y, a in zip(parts, at) if a == e]
                if own:
                    book[e] = [sum(c) // len(own) for c in zip(*own)]
        for k, y in enumerate(parts):
            d, e = near(y, book)
            codes[k] += f"{e:02x}"
            errors[k] += d
        flat += [str(c) for e in book for c in e]
    sums = Counter()
    for (_, _, lab), e in zip(kept, errors):
        sums[lab] += e
    digest = hashlib.sha256(",".join(flat).encode()).hexdigest()
    return Counter((i, c, e, sums[lab], digest) for (i, _, lab), c, e in zip(kept, codes, errors))


VECTORS = "vec_id long, embedding array<double>, label int, x int, code string, owner string"


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, lab, 1, "c", "o") for i, v, lab in rows], VECTORS).repartition(3)


def _coded(spark, rows, **options):
    out = vector_codes.vector_codes(spark, _vectors(spark, rows), **options)
    return Counter((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in out.collect())


def _random_vectors(n, size, seed, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.choice([-1, 1]) * rng.random() * spread for _ in range(size)], rng.choice([0, 1, 2, None])) for i in range(n)]


def test_vector_codes_hard_rows(spark):
    rows = _random_vectors(150, 16, 3)
    rows += [(7, rows[7][1], 1), (7, rows[9][1], 2), (None, rows[3][1], None)]  # repeated and null ids
    rows += [(900, None, 1), (901, [float("nan")] + [0.0] * 15, 1), (902, [float("inf")] * 16, 1), (903, [None] + [0.5] * 15, 0)]
    rows += [(1000 + i, [0.25] * 16, 5) for i in range(80)]  # a third of all rows in one entry
    assert _coded(spark, rows) == _codes(rows)


def test_vector_codes_few_rows_ties_and_large_components(spark):
    few = _random_vectors(5, 8, 1)
    assert _coded(spark, few) == _codes(few)
    ties = [(i, [float(i % 4)] * 8, 1) for i in range(40)]  # equal entries: the lower index
    assert _coded(spark, ties) == _codes(ties)
    large = _random_vectors(40, 8, 2, spread=1e12) + [(50, [1e300] * 8, 9)]
    got, want = _coded(spark, large), _codes(large)
    assert {r[:2] for r in got} == {r[:2] for r in want}
    assert all(g[2] == (w[2] if w[2] < 2**63 else None) for g, w in zip(sorted(got), sorted(want)))


def test_vector_codes_empty_and_other_sizes(spark):
    assert _coded(spark, []) == Counter()
    rows = _random_vectors(30, 8, 4)
    got = _coded(spark, rows + [(99, [1.0] * 4, 0)])
    assert (99, None, None) in {r[:3] for r in got} and len(got) == 31
    with pytest.raises(ValueError):
        vector_codes.vector_codes(spark, _vectors(spark, [(1, [1.0] * 7, 0)]))


def test_only_changed_parts_move(spark):
    """Members that keep their entry stay in their partition: the union of a round is narrow."""
    rows = _random_vectors(400, 8, 5)
    kept = _vectors(spark, rows).selectExpr("vec_id", "embedding AS x")
    book = vector_codes.initial_codebook(kept, 8)
    dealt = vector_codes._dealt(kept, 8, book, 3, 6)
    book = vector_codes._updated(book, vector_codes._sums(dealt, 3))
    placed = vector_codes._placed(dealt, book, 3)
    settled = vector_codes._settled(placed, 6)
    assert settled.getNumPartitions() == 6
    moved = placed.filter(lambda x: x[0] != x[1][0]).map(lambda x: len(x[1][1])).sum()
    assert 0 < moved < 400 * 8 / 2
    homes = settled.map(lambda x: x[0]).mapPartitionsWithIndex(lambda i, it: [(o, i) for o in set(it)]).collect()
    assert len({o for o, _ in homes}) == len(homes)  # an owner lives in one partition
    assert settled.map(lambda x: len(x[1])).sum() == 400 * 8


def test_vector_codes_equal_the_sql(spark):
    rows = _random_vectors(60, 16, 6)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[], label INT)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", [*rows, (70, None, 1), (71, [float("inf")] * 16, 1)])
    assert Counter(con.sql(vector_codes_sql()).fetchall()) == _coded(spark, rows)


# ---------------------------------------------------------------- quality rules


def _quality_rows():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghé") for _ in range(rng.randint(2, 8)))
    clean = lambda n=60: " ".join(word() for _ in range(n))
    texts = [None, "", " \t\n ", "one", clean(7), clean(8), clean(19), clean(20)]
    phrase = clean(8)
    texts += [phrase + " " + clean(40) + "\x0b" + phrase, " ".join([phrase] * 6), "a " * 300, "x" * 5000 + " " + clean(30)]
    texts += ["\n".join([clean(9), "same line", clean(9), "same line", " same line", "", "", clean(9)]), clean(40) + " #*$%&|<>" * 12, "\x00 " + clean(30)]
    rows = [(t, "en", "a") for t in texts]
    rows += [(clean(), lang, src) for lang, src, n in [("en", "a", 130), ("en", "b", 12), ("de", "a", 40), (None, None, 3), ("de", None, 5)] for _ in range(n)]
    rows += [(clean(30).replace(" ", " %%% "), "en", "a") for _ in range(3)] + [(" ".join("w" * 25 for _ in range(40)) + clean(5), "en", "b")]
    rows += [(clean(20) + "\n" + "\n".join(["again and again"] * 12) + "\n" + clean(30), "de", "a")]
    return [(i, t, lang, src) for i, (t, lang, src) in enumerate(rows)] + [(3, "twice the id " + clean(30), "en", "a"), (None, clean(), "en", "b")]


def _plain_counts(text):
    ws = WORD.findall(text or "")
    wins = [tuple(ws[i : i + 8]) for i in range(len(ws) - 7)]
    n = Counter(wins)
    hit = {i + j for i, w in enumerate(wins) if n[w] > 1 for j in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def test_quality_counts_and_verdicts(spark):
    rows = _quality_rows()
    docs = spark.createDataFrame([(i, t, lang, src, 0, "p", 1, "l", 2) for i, t, lang, src in rows], DOCS).repartition(4)
    got = quality.quality(spark, docs).select("doc_id", *quality.COUNTS, "base_failed", "kept").collect()
    counts = Counter((r[0], *r[1:6], r[6]) for r in got)
    want = Counter()
    for i, t, _, _ in rows:
        c = _plain_counts(t)
        want[(i, *c, c[0] < 20 or 100 * c[4] > 30 * c[0])] += 1
    assert counts == want
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    distinct = [r for r in rows if r[0] is not None and "twice" not in (r[1] or "")]
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", distinct)
    few = spark.createDataFrame([(i, t, lang, src, 0, "p", 1, "l", 2) for i, t, lang, src in distinct], DOCS)
    verdicts = Counter(tuple(r) for r in quality.quality(spark, few).select("doc_id", *quality.COUNTS, "base_failed", "kept").collect())
    assert verdicts == Counter(con.sql(quality_sql()).fetchall())
    kept = {r["doc_id"]: r["kept"] for r in got if r["doc_id"] is not None}
    assert not any(kept[i] for i, t, _, _ in rows if i is not None and " %%% " in (t or ""))  # symbols beyond the group's fence
    assert sum(not k for k in kept.values()) < 25


def test_quality_long_text_and_empty_table(spark):
    rng = random.Random(5)
    long = " ".join(str(rng.randrange(10**6)) for _ in range(400_000))  # 2.7 MB
    repeated = "b c d e f g h i j " * 60_000
    docs = spark.createDataFrame([(1, long, "en", "a", 0, "", 0, "", 0), (2, repeated, "en", "a", 0, "", 0, "", 0)], DOCS)
    got = {r["doc_id"]: r for r in quality.quality(spark, docs).collect()}
    assert (got[1]["n_words"], got[1]["n_repeat_words"], got[1]["base_failed"]) == (400_000, 0, False)
    assert (got[2]["n_words"], got[2]["n_repeat_words"], got[2]["kept"]) == (540_000, 540_000, False)
    assert quality.quality(spark, docs.limit(0)).count() == 0


def test_sketches_merge_and_bound_the_error():
    values = [0, 1, 127, 128, 255, 1000, 123_456_789]
    kept = [v >> max(v.bit_length() - 7, 0) << max(v.bit_length() - 7, 0) for v in values]
    assert all(k <= v < k * (1 + 2**-6) or v == k for k, v in zip(kept, values))


def test_sketch_value_in_spark(spark):
    values = [0, 1, 127, 128, 255, 1000, 123_456_789]
    got = spark.createDataFrame([(v,) for v in values], "v long").select(quality.sketch_value(quality.F.col("v")).alias("s")).collect()
    assert [r["s"] for r in got] == [v >> max(v.bit_length() - 7, 0) << max(v.bit_length() - 7, 0) for v in values]


# ---------------------------------------------------------------- collocations

LOWER = {c: c + 32 for c in range(65, 91)}


def _phrases(rows, top, least=30):
    f = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, 5):
                f[lang or "und"].update(tuple(ws[i : i + m]) for i in range(len(ws) - m + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for k, v in c.items() if len(k) == 1)
        cand = {k: v for k, v in c.items() if len(k) > 1 and v >= least}
        gone = {k[i : i + m] for k, v in cand.items() for m in range(2, len(k)) for i in range(len(k) - m + 1) if 100 * v >= 80 * c[k[i : i + m]]}
        found = []
        for k, a in cand.items():
            if k not in gone:
                score, j = min((2_000_000 * a // (c[k[:j]] + c[k[j:]]), j) for j in range(1, len(k)))
                found.append((-score, -a, " ".join(k).encode(), j, c[k[:j]], c[k[j:]]))
        out += [(lang, i + 1, p.decode(), -a, j, x, y, n, -s) for i, (s, a, p, j, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out)


def _phrase_rows(seed=21):
    rng = random.Random(seed)
    common = [f"w{i}" for i in range(30)]
    texts = []
    for _ in range(160):
        words = [rng.choice(common) for _ in range(rng.randint(5, 60))]
        for fixed in ("New York", "united states of america", "a b c d e", "x X x X x", "ß Ñ É", "rare\tpair"):
            if rng.random() < 0.5:
                at = rng.randrange(len(words))
                words[at:at] = fixed.split(" ")
        texts.append("".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\r\n", "! ", "\x0b"]) for w in words))
    rows = [(t, rng.choice(["en", "en", "de", None, "und"])) for t in texts]
    rows += [(None, "en"), ("", "en"), (" \n", "xx"), ("...", None), ("once only here", "fr")]
    rows += [("the same copied text, with its own odd words" + " zig zag zog", "es")] * 45  # ties at the highest score
    return rows


def _found(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, lang, "s", 5, "p", 1, "l", 2) for i, (t, lang) in enumerate(rows)], DOCS).repartition(5)
    return sorted(tuple(r) for r in collocations.collocations(spark, docs, **options).collect())


@pytest.mark.parametrize("top", [2000, 3])
def test_collocations(spark, top):
    """With few places the search stops above the lowest threshold; the rows are the same."""
    rows = _phrase_rows()
    assert _found(spark, rows, top=top) == _phrases(rows, top)


def test_collocations_over_block_borders(spark, monkeypatch):
    """Small blocks and buckets: long texts are cut where pieces end, a phrase is spoken for by one block."""
    monkeypatch.setattr(collocations, "BUCKET_WORDS", 300)
    rows = _phrase_rows(22)
    rows.append((" ".join(t or "" for t, _ in rows) * 3, "en"))
    docs = spark.createDataFrame([(i, t, lang, "s", 5, "p", 1, "l", 2) for i, (t, lang) in enumerate(rows)], DOCS).repartition(7)
    assert sorted(tuple(r) for r in collocations.collocations(spark, docs, top=50).collect()) == _phrases(rows, 50)
    parts = list(collocations._cut(b"a b\n" * (3 << 20)))
    assert b"".join(parts) == b"a b\n" * (3 << 20) and len(parts) > 1


def test_collocations_equal_the_sql_and_empty_table(spark):
    rows = _phrase_rows(23)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert [r[:4] + r[5:] for r in _found(spark, rows)] == sorted(con.sql(collocations_sql()).fetchall())
    assert _found(spark, []) == [] and _found(spark, [(None, "en"), ("!", None)]) == []
