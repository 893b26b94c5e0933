"""The ten operators on a small table of hard cases, against brute force."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from kinesia.llm import bpe, embed_dedup, exact_dedup, langid, mixing, ngram_join, pii, suffix_dedup, warc, window_dedup
from kinesia.llm.queries import tokenizer_path
from kinesia.llm.text import word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, part int, keep_id string"


def _texts():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeéñß.") for _ in range(rng.randint(1, 6)))
    base = [" ".join(word() for _ in range(rng.randint(20, 120))) for _ in range(12)]
    texts = [None, "", " \t\n", "one", "two words", "É" * 90, "\x00 nul \x00", "aaaa " * 400, base[0], base[0], base[0].replace(" ", "  ")]
    for t in base:
        w = t.split()
        texts += [t, " ".join(w[:-1] + ["changed"]), " ".join(w[:10] + base[1].split()[:30] + w[10:])]
    texts += [t.upper() for t in base[:3]] + [base[2] + " " + base[2], " ".join(base) * 12]
    texts += ["mail a.b+c@ex-am.ple.org, x@y._z@w.q 10.0.0.255 1.2.3.4.5.6.7.8 300.1.1.1 4111 1111 1111 1111 +49 (30) 123-4567 😀 +1"] * 2
    return texts


@pytest.fixture(scope="module")
def rows():
    return [(i, t, ["en", "de", None][i % 3], ["a", "b", "c", None][min(i % 7, 3)], 0, 1, 2, "x") for i, t in enumerate(_texts())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def _components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def _sets(rows, k):
    out = {}
    for i, t, *_ in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        out[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    return out


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80)])
def test_ngram_join(spark, docs, rows, k, percent):
    sets = _sets(rows, k)
    edges = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = _components(sets, edges)
    got = _by_id(ngram_join.similar_sets(spark, docs, k, percent))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(sets[i]), want[i]) for i in sets}


def test_signatures_lose_no_link():
    rng = np.random.default_rng(3)
    for _ in range(400):
        n = int(rng.integers(1, 300))
        a = rng.choice(2**40, n, replace=False).astype(np.uint64)
        drop = int(rng.integers(0, n // 6 + 1))
        b = np.concatenate([a[drop:], rng.choice(2**40, int(rng.integers(0, n // 12 + 1)), replace=False).astype(np.uint64) + np.uint64(2**41)])
        a, b = np.unique(a), np.unique(b)
        both = len(np.intersect1d(a, b))
        if 100 * both < 85 * (len(a) + len(b) - both) or np.array_equal(a, b):
            continue
        count = lambda t: (t % np.uint64(97)).astype(np.int64) + 2
        for frequent in (0, 20, 1000):
            x, y = (ngram_join.signatures(t, count(t), frequent, 85) for t in (a, b))
            assert len(np.intersect1d(x, y)), (len(a), len(b), frequent)


def test_suffix_dedup(spark, docs, rows):
    for length in (200, 24):
        data = {i: (t or "").encode() for i, t, *_ in rows}
        count = Counter(d[p : p + length] for d in data.values() for p in range(len(d) - length + 1))
        got = _by_id(suffix_dedup.suffix_digests(spark, docs, length))
        for i, d in data.items():
            cover = bytearray(len(d))
            for p in range(len(d) - length + 1):
                if count[d[p : p + length]] > 1:
                    cover[p : p + length] = b"\1" * length
            kept = bytes(x for x, y in zip(d, cover) if not y)
            want = (len(d), sum(cover), len(re.findall(b"\1+", bytes(cover))), hashlib.sha256(kept).hexdigest())
            assert tuple(got[i])[1:] == want, (length, i)


def test_loser_tree_orders_and_measures():
    rng = random.Random(1)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 30))) for _ in range(5)]
    coded = [suffix_dedup.decode_run(suffix_dedup.encode_run([(s, b"")  for s in run], [b""] * len(run))) for run in runs]
    merged = list(suffix_dedup.merge_runs(coded))
    assert [m[1] for m in merged] == sorted(s for run in runs for s in run)
    for a, b in zip(merged, merged[1:]):
        assert b[0] == suffix_dedup.common(a[1], b[1], 0)


def test_exact_dedup(docs, rows):
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t, *_ in rows}
    got = _by_id(exact_dedup.exact_dedup(docs))
    for i, t in norm.items():
        same = [j for j in norm if norm[j] == t]
        assert tuple(got[i])[1:] == (min(same), len(same), i == min(same), hashlib.sha256(t.encode()).hexdigest())
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(norm.values()))


def test_warc_round_trip(spark, tmp_path):
    html = ["<p>one</p>", None, "", "<p>one</p>", "é" * 5000, "x", "x", "x"]
    pages = spark.createDataFrame([(i, None if i == 2 else f"http://h/{i}\r\nX: y", h, 1) for i, h in enumerate(html)], "page_id long, url string, html string, k int")
    folder = f"file://{tmp_path}/w"
    warc.make_folder(spark, folder)
    warc.write_archives(pages, folder, archive_limit=6000).collect()
    got = _by_id(warc.read_archives(spark, folder), "page_id")
    for i, h in enumerate(html):
        data, first = (h or "").encode(), next(j for j, x in enumerate(html) if (x or "") == (h or ""))
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if first == i else ("revisit", first))
        assert r.payload == (bytearray(data) if first == i else None)
    files = list((tmp_path / "w").glob("*.warc.zst"))
    assert files and all(f.read_bytes()[:4] == (0x184D2A5D).to_bytes(4, "little") for f in files)


def test_pii(spark, docs, rows):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0
    digits = lambda v: re.sub("[^0-9]", "", v)
    good = {
        "email": lambda v: True, "ip": lambda v: all(int(x) <= 255 for x in v.split(".")),
        "card": lambda v: 12 <= len(digits(v)) <= 19 and luhn(digits(v)), "phone": lambda v: 9 <= len(digits(v)) <= 15,
    }
    got = _by_id(pii.span_digests(spark, docs))
    for i, t, *_ in rows:
        spans = [(m.start(), k, m.end()) for k, p in enumerate(patterns.values()) for m in re.finditer(p, t or "") if list(good.values())[k](m.group())]
        shown = ",".join(f"{list(patterns)[k]}:{a}:{b}" for a, k, b in sorted(spans))
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert set(filter(None, shown.split(","))) <= set(r.spans.split(","))


def test_pii_terms(spark):
    rows = [(i, f"Zorblax wrote to me@ex.org, not to {c * 4}") for i, c in enumerate("bcde")] + [(i, "not to wrote here") for i in range(10, 60)]
    out = _by_id(pii.sanitise(spark, spark.createDataFrame(rows, "doc_id long, text string")))
    assert out[0].sanitised == "[TERM] wrote to [EMAIL], not to bbbb" and out[10].sanitised == "not to wrote here"


def test_pii_terms_of_rare_entities(spark):
    rows = [(0, "Quixby wrote to a@ex.org and b@ex.org"), (1, "Vortle wrote to c@ex.org"), (2, "wrote to c@ex.org, Vortle"), (3, "Vortle wrote")]
    rows += [(4, "Plugh wrote to d@ex.org"), (5, "Plugh wrote to d@ex.org"), *((i, "wrote to nobody") for i in range(6, 1100))]
    out = _by_id(pii.sanitise(spark, spark.createDataFrame(rows, "doc_id long, text string")))
    assert out[0].sanitised == "[TERM] wrote to [EMAIL] [TERM] [EMAIL]"
    assert out[4].sanitised == out[5].sanitised == "[TERM] wrote to [EMAIL]"
    # a third document with the term and without the entity: PMI = ln(2 N / (3 * 2)) = 0.94 IC, 0.91 smoothed
    assert out[1].sanitised == "[TERM] wrote to [EMAIL]" and out[3].sanitised == "Vortle wrote"


def test_mixing(docs, rows):
    size = {i: len(WORD.findall(t or "")) for i, t, *_ in rows}
    source = {r[0]: r[3] for r in rows}
    sizes = Counter()
    for i, s in source.items():
        sizes[s] += size[i]
    order = sorted(s for s in sizes if s is not None) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free = {}, set(order)
    while True:
        left = 1.5 * sum(sizes.values()) - sum(target.values())
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        free -= set(over)
    target |= {s: left * weight[s] / total for s in free}
    first, again = (_by_id(mixing.mix_sources(docs)) for _ in range(2))
    assert first == again
    taken = Counter()
    for i, r in first.items():
        taken[source[i]] += r.taken
        assert (r["size"], r.source_size) == (size[i], sizes[source[i]]) and 0 <= r.taken <= 2 * size[i]
        assert r.target == pytest.approx(target[source[i]])
    assert all(abs(taken[s] - target[s]) <= 16 for s in order)


@pytest.mark.parametrize("texts", [["", None, " \t"], ["", None, "one two three"]])
def test_mixing_of_a_source_without_words(spark, texts):
    rows = [(i, t, "blank" if i < 2 else "other") for i, t in enumerate(texts)]
    out = _by_id(mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), block=1))
    assert [(out[i]["size"], out[i].source_size, out[i].target, out[i].taken) for i in (0, 1)] == [(0, 0, 0.0, 0)] * 2
    n = out[2]["size"]
    assert out[2].target == 1.5 * n and abs(out[2].taken - 1.5 * n) <= 1


def test_mixing_of_a_shard_without_words(spark):
    rows = [(0, "word " * 40, "a"), *((i, None, "a") for i in range(1, 30))]
    out = _by_id(mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), shard_tokens=4))
    assert abs(out[0].taken - 60) <= 8 and all(out[i].taken == 0 for i in range(1, 30))


def test_bpe_equals_the_library(docs, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    got = _by_id(bpe.encode_documents(docs, tokenizer_path()))
    digests = _by_id(bpe.encode_digests(docs, tokenizer_path()))
    for i, t, *_ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        assert got[i].ids == ids and got[i].decoded == tokenizer.decode(ids, skip_special_tokens=False)
        assert digests[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    coder = bpe.load(tokenizer_path())
    for t in ("ΑΣ ΟΔΟΣ", "<|endoftext|>x<|startoftext|>", "İi don't 'LL", "é ½ 한국 \x85"):
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        assert list(np.frombuffer(coder.encode(t), "<u4")) == ids and coder.decode(coder.encode(t)) == tokenizer.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("bits, block, part", [(None, None, None), (16, None, None), (None, 2000, 3000), (34, 2000, 10**6), (4, 2000, 10**6)])
def test_window_dedup(spark, docs, rows, bits, block, part, monkeypatch):
    if block:  # many blocks, and many parts of the cells
        monkeypatch.setattr(window_dedup, "BLOCK_BYTES", block)
        monkeypatch.setattr(window_dedup, "SKETCH_PART_BYTES", part)
    words = {i: WORD.findall(t or "") for i, t, *_ in rows}
    first = {}
    for i in sorted(words):
        for p in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][p : p + 13]), i)
    got = _by_id(window_dedup.window_digests(spark, docs, 13, bits))
    for i, w in words.items():
        gone = {p + k for p in range(len(w) - 12) if first[tuple(w[p : p + 13])] < i for k in range(13)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        assert tuple(got[i])[1:] == (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()), i


def test_sketch_counts_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(window_dedup, "BLOCK_BYTES", 100)
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefghij") for _ in range(60)) for _ in range(40)] + ["a b c a b c", "", "x"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    blocks = window_dedup.stored(spark, window_dedup.text_blocks(rows), "test-blocks")
    packed = {r["block"]: r for r in blocks.collect()}
    assert len(packed) > 10 and sum(len(r["ids"]) // 8 for r in packed.values()) == len(texts)
    got = {}
    for r in window_dedup.sketch_cells(blocks, 3, 40, 10).collect():
        cells = window_dedup._unpack_numbers(r["cells"]).astype(np.uint64) + np.uint64(r["part"] << 30)
        got.setdefault((r["block"], r["row"]), set()).update(cells.tolist())
    count, own = Counter(), {}
    for block, r in packed.items():
        i = 0
        for n in np.frombuffer(r["lengths"], "<i8").tolist():
            data = window_dedup.zstandard.ZstdDecompressor().decompress(r["text"])[i : i + n]
            i += n
            for _, _, h, _, _ in window_dedup._windows([data], 3):
                for row, cells in enumerate(window_dedup._cells(h, 40)):
                    count.update((row, c) for c in cells.tolist())
                    own.setdefault((block, row), set()).update(cells.tolist())
    want = {(b, row): {c for c in cells if count[row, c] > 1} for (b, row), cells in own.items()}
    assert got == {k: v for k, v in want.items() if v}


def test_embedding_links(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 16)).astype(np.float32)
    near = base[:30] + 0.11 * rng.normal(size=(30, 16)).astype(np.float32)
    vectors = [*base.tolist(), *near.tolist(), *base[:5].tolist(), *(2 * base[5:8]).tolist(), [0.0] * 16, [float("nan")] * 16, [float("inf")] * 16, None, [], [1.0, None], [1.0, 2.0], [2.0, 4.0]]
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, copies int")
    got = _by_id(embed_dedup.embedding_links(spark, df, 0.9, tile=16), "vec_id")
    ok = {i: np.array(v, np.float32).astype(float) for i, v in enumerate(vectors) if v and None not in v and np.isfinite(v).all() and any(v)}
    edges = [(a, b) for a in ok for b in ok if a != b and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] / np.linalg.norm(ok[a]) / np.linalg.norm(ok[b]) >= 0.9]
    want, links = _components(range(len(vectors)), edges), Counter(a for a, _ in edges)
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in got.items()} == {i: (links[i], want[i], want[i] == i) for i in range(len(vectors))}


def test_language_id(spark, docs, rows):
    train = [(100 + i, f"{'the house is here and' if i % 2 else 'das haus ist hier und'} {i}", "en" if i % 2 else "de") for i in range(40)]
    df = spark.createDataFrame(train + [(1, None, "en"), (2, "12 ?", "de"), (3, "das haus", None)], "doc_id long, text string, lang string")
    got = _by_id(langid.identify(spark, df))
    assert all(got[i].lang_pred == lang for i, _, lang in train) and got[3].lang_pred == "de"
    assert got[1].lang_pred == got[2].lang_pred == "und"
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in got.items())
    assert len(_by_id(langid.identify(spark, docs))) == len(rows)


def test_bundling_without_tables_is_the_same():
    text = "über ñandú 한국 " * 50
    small, counts = langid.Bundler(), None
    counts, vector = small.counts(text)
    assert vector is None and np.array_equal(small.bundle([counts])[0], small._bundle(text))
    many = "".join(map(chr, range(0x4E00, 0x4F00)))
    assert langid.Bundler().counts(many)[1] is not None


def test_empty_tables(spark, empty, tmp_path):
    assert ngram_join.similar_sets(spark, empty).count() == 0
    assert suffix_dedup.suffix_digests(spark, empty).count() == 0
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert pii.span_digests(spark, empty).count() == 0
    assert mixing.mix_sources(empty).count() == 0
    assert bpe.encode_digests(empty, tokenizer_path()).count() == 0
    assert window_dedup.window_digests(spark, empty).count() == 0
    assert langid.identify(spark, empty).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embed_dedup.embedding_links(spark, vectors).count() == 0
    warc.make_folder(spark, str(tmp_path / "w"))
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w")).collect()
    assert warc.read_archives(spark, str(tmp_path / "w")).count() == 0


def test_null_and_repeated_ids(spark):
    rows = [(None, "some text here"), (None, "some text here"), (4, "some text here"), (4, "some text here"), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for out in (
        ngram_join.similar_sets(spark, df), suffix_dedup.suffix_digests(spark, df), exact_dedup.exact_dedup(df), pii.span_digests(spark, df),
        mixing.mix_sources(df.selectExpr("*", "null as source")), window_dedup.window_digests(spark, df), bpe.encode_digests(df, tokenizer_path()),
    ):
        assert out.count() == len(rows)
    kept = exact_dedup.exact_dedup(df).filter("kept").select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == [4, 4, 9]


def test_word_hashes_depend_on_the_bytes_only():
    buf = np.frombuffer(b"  abc\tx abc\n\xc3\xa9 abc", np.uint8)
    starts, ends, h = word_hashes(buf)
    assert [bytes(buf[a:b]) for a, b in zip(starts, ends)] == [b"abc", b"x", b"abc", "é".encode(), b"abc"]
    assert h[0] == h[2] == h[4] and len(set(h.tolist())) == 3


def test_pipeline_against_a_plain_version(spark, tmp_path, rows):
    import corpus_pipeline

    table = [(i, t, lang, source, n) for i, t, lang, source, n, *_ in rows]
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    left = {i: t for i, t, *_ in rows if t and any(c.isalpha() for c in t)}
    first = {}
    for i, t in left.items():
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), i)
    left = {i: left[i] for i in first.values()}
    sets = _sets(left.items(), 5)
    edges = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    left = {i for i, c in _components(sets, edges).items() if i == c}
    times = Counter(r.doc_id for r in got)
    assert set(times) <= left and max(times.values()) <= 2 and len(times) > len(left) / 3
    kept = [r for r in rows if r[0] in left]
    mix = _by_id(mixing.mix_sources(spark.createDataFrame(kept, SCHEMA)))
    # to the nearest whole time, a half up
    assert times == Counter({i: int(r.taken / r["size"] + 0.5) for i, r in mix.items() if r["size"] and int(r.taken / r["size"] + 0.5)})


def test_exact_copies_with_repeated_and_null_ids(spark):
    rows = [(3, "b", 1), (5, "a", 2), (5, "b", 3), (None, "b", 4), (None, "zzz", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _kept_id int")
    got = exact_dedup.drop_exact_copies(df)
    assert got.columns == df.columns and sorted(r["_kept_id"] for r in got.collect()) == [1, 2, 5]


def test_pipeline_stages_with_clashing_names(spark, docs):
    import corpus_pipeline

    df = docs.selectExpr("*", "doc_id AS _id", "1 AS _copy", "'s' AS _size", "2 AS _times", "3 AS _row", "4 AS _gone")
    for _, stage in corpus_pipeline.STAGES[1:4:2]:
        out = stage(spark, df, None)
        assert out.columns == df.columns and out.count() > 0
        assert {(r["_copy"], r["_times"], r["_row"]) for r in out.collect()} == {(1, 2, 3)}
