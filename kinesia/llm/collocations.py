"""Collocations: phrases whose words belong together, grown best first from their prefixes.

Texts are cut into blocks of one language; a block's words are numbers into its own
word list. Phrases are counted level by level (1 to 4 words):

* a block sends the hash and count of its distinct phrases of the level, an owner of a
  range of hashes adds them up and returns to each block the phrases of at least
  ``MIN_COUNT`` occurrences that this block holds, with their count. No task needs any
  other phrase, so nothing is broadcast and no list of phrases reaches the driver;
* a phrase is counted only if its parts were returned, and from three words on only if
  a bound of its score, or of that of any phrase it could grow into, reaches the
  language's threshold. The score of a phrase of count ``a`` whose first word occurs
  ``f`` times is at most 2000000 * a / (f + a), because the rest occurs at least ``a``
  times; ``a`` is at most the count of each part. So is it from the right.
  Longer phrases that could drop a phrase above the threshold are counted too;
* the threshold starts where a few times ``top`` two-word phrases lie above it. If
  fewer than ``top`` phrases above it survive, the search is not settled there: the
  frontier widens, down to 0, for that language alone. All survivors above a
  threshold are known, ties included, so the first ``top`` are exact.

A phrase inside a much longer one is inside a phrase one word longer that is as
frequent, so only such phrases are looked at to drop it. Phrases are told apart by
64-bit hashes of xxh3 word hashes; two of n distinct phrases share one with a
probability of about n**2 / 2**65.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinesia.llm.graph import stored
from kinesia.llm.text import LOWER, as_bytes, mix

MIN_COUNT = 30
TOP = 2000
LONGEST = 4
SCALE = 2_000_000
DROP_PERCENT = 80
BLOCK_BYTES = 8 << 20
BUCKET_WORDS = 1 << 20
WIDEN = (4, 64, None)  # bigrams above the threshold, in multiples of ``top``; None: all
SALTS = 64
_U = np.uint64
_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_table = LOWER.copy()
_table[list(_SEPARATORS)] = 10
_table[9] = 32
PIECES = _table.tobytes()
BLOCK_SCHEMA = "block long, lang string, words long, payload binary"
EMITTED = "kind int, lang string, phrase string, a long, cut int, l long, r long, score long"


# ---------------------------------------------------------------- blocks


def _payload(data: bytes) -> tuple[int, bytes]:
    """(words, packed block) of translated text: word numbers, which words are neighbours in a piece, the word list."""
    tokens = pa.array(data.split(), pa.binary()).dictionary_encode()
    buf = np.frombuffer(data, np.uint8)
    space = (buf == 32) | (buf == 10)
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    piece = np.searchsorted(np.flatnonzero(buf == 10), starts)
    codes = tokens.indices.to_numpy().astype(np.int32)
    packed = pickle.dumps((codes, np.packbits(piece[1:] == piece[:-1]), b"\n".join(tokens.dictionary.to_pylist())), 5)
    return len(codes), zstandard.ZstdCompressor(level=1).compress(packed)


def _cut(data: bytes) -> Iterator[bytes]:
    """Parts of about a block, cut where a piece ends."""
    while len(data) > BLOCK_BYTES:
        at = data.rfind(b"\n", 0, BLOCK_BYTES)
        at = at if at > 0 else data.find(b"\n", BLOCK_BYTES)
        if at < 0:
            break
        yield data[:at]
        data = data[at:]
    yield data


def blocks(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The texts as blocks of one language each."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def flush(name: str) -> Iterator[pa.RecordBatch]:
            nonlocal number
            size.pop(name)
            n, packed = _payload(b"\n".join(held.pop(name)))
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([name], pa.string()), pa.array([n], pa.int64()), pa.array([packed], pa.binary())], ["block", "lang", "words", "payload"])
                number += 1

        for batch in batches:
            for name, raw in zip(batch.column(1).to_pylist(), as_bytes(batch.column(0))):
                for part in _cut(raw.translate(PIECES)):
                    held.setdefault(name, []).append(part)
                    size[name] = size.get(name, 0) + len(part)
                    if size[name] >= BLOCK_BYTES:
                        yield from flush(name)
                    elif sum(size.values()) > 4 * BLOCK_BYTES:
                        yield from flush(max(size, key=size.get))
        for name in list(held):
            yield from flush(name)

    rows = docs.select(F.col(text).cast("string").alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    return rows.filter("text is not null").mapInArrow(pack, BLOCK_SCHEMA)


class Block:
    """One block with what the owners returned so far: counts of its frequent phrases, 0 for the others.

    ``ids[m]`` holds the number of the phrase of ``m`` words that starts at each word,
    -1 if there is none or it is not counted; ``first[m]`` a place of each phrase,
    ``f[m]`` its count and ``told[m]`` whether this block speaks for it.
    """

    def __init__(self, lang: str, payload: bytes, returned: dict[int, tuple], threshold: int | None):
        self.codes, near, words = pickle.loads(zstandard.ZstdDecompressor().decompress(payload))
        self.lang, self.words, self.returned, self.threshold = lang, words.split(b"\n"), returned, threshold
        self.near = np.unpackbits(near, count=max(len(self.codes) - 1, 0)).astype(bool)
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        self.word_hashes = np.array([xxhash.xxh3_64_intdigest(w, seed) for w in self.words], _U)
        self.ids, self.first, self.count, self.f, self.told = {}, {}, {}, {}, {}

    def grow(self, level: int) -> Block:
        """Phrases up to ``level`` words; the counts of the last one are those that were returned."""
        for m in range(1, level + 1):
            at, key = self._places(m)
            keys, first, of, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            self.first[m], self.count[m] = at[first], count
            self.ids[m] = np.full(len(self.codes), -1, np.int64)
            self.ids[m][at] = of
            self.f[m], self.told[m] = self._looked_up(m)
        return self

    def _places(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the phrases to count at a level, and a number that tells them apart."""
        n = len(self.codes) - m + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        if m == 1:
            return np.arange(n), self.codes.astype(np.int64)
        if m == 2:
            f = self.f[1][self.codes]
            at = np.flatnonzero(self.near & (f[:-1] > 0) & (f[1:] > 0))
            return at, self.codes[at].astype(np.int64) * len(self.words) + self.codes[at + 1]
        pairs = self.ids[2]
        f2 = lambda i: self.f[2][pairs[i]]
        ok = pairs[:n] >= 0
        for i in range(1, m - 1):
            ok &= pairs[i : i + n] >= 0
        at = np.flatnonzero(ok)
        for i in range(m - 1):
            at = at[f2(at + i) > 0]
        t = self.threshold / SCALE * (1 - 1e-9)
        word = lambda i: self.f[1][self.codes[i]].astype(np.float64)
        if m == 3:
            left, right = f2(at).astype(np.float64), f2(at + 1).astype(np.float64)
            a = np.minimum(left, right)
            grows = (a >= t * (word(at) + a)) | (a >= t * (word(at + 2) + a))
            above = self.above(2)
            drops = (above[pairs[at]] & (100 * a >= DROP_PERCENT * left)) | (above[pairs[at + 1]] & (100 * a >= DROP_PERCENT * right))
            at = at[grows | drops]
            return at, pairs[at] * len(self.words) + self.codes[at + 2]
        left, right, above = self.ids[3][at], self.ids[3][at + 1], self.above(3)
        p, q, ends = (x.astype(np.float64) for x in (self._count(3, at), self._count(3, at + 1), f2(at + 2)))
        a = np.minimum(p, q)
        grows = (a > 0) & (a >= t * (word(at) + q)) & (a >= t * (p + word(at + 3))) & (a >= t * (f2(at) + ends))
        is_above = lambda k: (k >= 0) & above[k] if len(above) else np.zeros(len(k), bool)
        drops = (is_above(left) & (100 * ends >= DROP_PERCENT * p)) | (is_above(right) & (100 * f2(at).astype(np.float64) >= DROP_PERCENT * q))
        at = at[grows | drops]
        return at, pairs[at] * max(len(self.first[2]), 1) + pairs[at + 2]

    def hashes(self, m: int) -> np.ndarray:
        """Hash of each phrase of a level, by its words."""
        h = np.full(len(self.first[m]), m, _U)
        for i in range(m):
            h = mix((h ^ (h >> _U(29))) * _U(0xD1342543DE82EF95) + self.word_hashes[self.codes[self.first[m] + i]])
        return h

    def _looked_up(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        f, told = np.zeros(len(self.first[m]), np.int64), np.zeros(len(self.first[m]), bool)
        if m in self.returned and len(f):
            known, counts, speaks = self.returned[m]
            own = self.hashes(m)
            at = np.minimum(np.searchsorted(known, own), max(len(known) - 1, 0))
            hit = known[at] == own if len(known) else np.zeros(len(own), bool)
            f[hit], told[hit] = counts[at[hit]], speaks[at[hit]]
        return f, told

    def _count(self, m: int, at: np.ndarray) -> np.ndarray:
        """Count of the phrase of ``m`` words at each place, 0 where it is not known to be frequent."""
        number = self.ids[m][at]
        return np.where(number >= 0, self.f[m][number], 0) if len(self.f[m]) else np.zeros(len(at), np.int64)

    def cuts(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        """(l, r) of each phrase of a level, a column for each cut; 0 where a part is not frequent."""
        at = self.first[m]
        sides = [(self._count(k, at), self._count(m - k, at + k)) for k in range(1, m)]
        return np.stack([x for x, _ in sides], 1), np.stack([y for _, y in sides], 1)

    def above(self, m: int) -> np.ndarray:
        """Phrases of a level that may reach the threshold: their score in floating point, with a slack."""
        left, right = self.cuts(m)
        whole = (left + right).astype(np.float64)
        known = (left > 0) & (right > 0)
        score = np.where(known, SCALE * self.f[m][:, None].astype(np.float64) / np.maximum(whole, 1), -1.0).min(1, initial=np.inf)
        return (self.f[m] > 0) & (score >= self.threshold - 1)

    def phrase(self, at: int, m: int) -> str:
        return b" ".join([self.words[c] for c in self.codes[at : at + m].tolist()]).decode("utf-8")

    def emitted(self, level: int) -> Iterator[tuple]:
        """For phrases up to ``level`` words, rows of ``EMITTED``: kind 0 a phrase at or above the threshold, kind 1 one that a longer phrase drops."""
        for m in range(2, level + 1):
            left, right = self.cuts(m)
            for k in np.flatnonzero(self.told[m] & self.above(m)).tolist():
                a = int(self.f[m][k])
                scores = [SCALE * a // (int(x) + int(y)) for x, y in zip(left[k], right[k])]
                cut = scores.index(min(scores))
                if scores[cut] >= self.threshold:
                    yield 0, self.lang, self.phrase(int(self.first[m][k]), m), a, cut + 1, int(left[k][cut]), int(right[k][cut]), scores[cut]
            if m == 2:
                continue
            above, longer = self.above(m - 1), np.flatnonzero(self.told[m] & (self.f[m] > 0))
            for shift in (0, 1):
                at = self.first[m][longer] + shift
                inner = self.ids[m - 1][at]
                if not len(above):
                    continue
                gone = (inner >= 0) & above[inner] & (100 * self.f[m][longer] >= DROP_PERCENT * self.f[m - 1][inner])
                for i in np.unique(at[gone]).tolist():
                    yield 1, self.lang, self.phrase(i, m - 1), 0, 0, 0, 0, 0


# ---------------------------------------------------------------- counting


def _partials(block: Block, number: int, level: int, buckets: int) -> Iterator[tuple]:
    h, n = block.hashes(level), block.count[level].astype(np.int64)
    order = np.argsort(h, kind="stable")
    h, n = h[order], n[order]
    edge = np.searchsorted(h, [_U((b << 64) // buckets) for b in range(buckets)]).tolist() + [len(h)]
    for b in range(buckets):
        x, y = edge[b], edge[b + 1]
        if x < y:
            yield b, number, h[x:y].tobytes(), n[x:y].tobytes()


PARTIAL = "bucket long, block long, hashes binary, counts binary"
RETURNED = "block long, level int, hashes binary, counts binary, told binary"


def _owned(level: int):
    """The owner of a range of hashes: adds up, and returns to each block its frequent phrases."""

    def owner(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("block")
        h = [np.frombuffer(x.as_buffer(), _U) for x in table["hashes"]]
        n = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in table["counts"]])
        whole = np.concatenate(h)
        distinct, first, of = np.unique(whole, return_index=True, return_inverse=True)
        f = np.zeros(len(distinct), np.int64)
        np.add.at(f, of, n)
        rows, at = [], 0
        for number, own in zip(table["block"].to_pylist(), h):
            here = of[at : at + len(own)]
            keep = f[here] >= MIN_COUNT
            if keep.any():
                told = first[here] == np.arange(at, at + len(own))
                rows.append((number, level, own[keep].tobytes(), f[here][keep].tobytes(), told[keep].tobytes()))
            at += len(own)
        return pa.table(list(map(list, zip(*rows))) if rows else [[]] * 5, schema=pa.schema([("block", pa.int64()), ("level", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary()), ("told", pa.binary())]))

    return owner


def _known(table: pa.Table) -> dict[int, tuple]:
    """level: (hashes ascending, counts, told) out of the returned rows of a block."""
    out = {}
    for level in set(table["level"].to_pylist()):
        rows = table.filter(pc.equal(table["level"], level))
        h, f, told = (np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in rows[name]]) for name, kind in (("hashes", _U), ("counts", np.int64), ("told", bool)))
        order = np.argsort(h)
        out[level] = h[order], f[order], told[order]
    return out


def _counted(packed: DataFrame, returned: DataFrame | None, level: int, buckets: int) -> DataFrame:
    """RETURNED rows of a level's frequent phrases; ``packed`` has a threshold from level 3 on."""

    def rows(out: Iterator[tuple]) -> pa.Table:
        data = list(out)
        return pa.table(list(map(list, zip(*data))) if data else [[]] * 4, schema=pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())]))

    if returned is None:

        def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for number, lang, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    yield from rows(_partials(Block(lang, payload, {}, None).grow(1), number, 1, buckets)).to_batches()

        partial = packed.select("block", "lang", "payload").mapInArrow(words, PARTIAL)
    else:

        def phrases(left: pa.Table, right: pa.Table) -> pa.Table:
            found = []
            for number, lang, payload, threshold in zip(*(left[c].to_pylist() for c in ("block", "lang", "payload", "threshold"))):
                found += _partials(Block(lang, payload, _known(right), threshold).grow(level), number, level, buckets)
            return rows(found)

        partial = packed.groupBy("block").cogroup(returned.groupBy("block")).applyInArrow(phrases, PARTIAL)
    return partial.groupBy("bucket").applyInArrow(_owned(level), RETURNED)


def _emitted(packed: DataFrame, returned: DataFrame, level: int) -> DataFrame:
    """EMITTED rows of phrases up to ``level`` words."""

    def emit(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        for lang, payload, threshold in zip(*(left[c].to_pylist() for c in ("lang", "payload", "threshold"))):
            found += Block(lang, payload, _known(right), threshold).grow(level).emitted(level)
        kinds = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*found)) if found else [[]] * len(kinds)
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in EMITTED.split(", ")])

    return packed.groupBy("block").cogroup(returned.groupBy("block")).applyInArrow(emit, EMITTED)


# ---------------------------------------------------------------- search


def _thresholds(pairs: DataFrame, langs: DataFrame, wanted: int | None) -> DataFrame:
    """(lang, threshold): the score that ``wanted`` two-word phrases of a language reach, on a grid of 1,001 steps; else 0."""
    if wanted is None:
        return langs.select("lang", F.lit(0).cast("long").alias("threshold"))
    steps = pairs.groupBy("lang", F.expr("score div 1000").alias("step")).agg(F.count(F.lit(1)).alias("n"))
    ranked = steps.withColumn("upto", F.sum("n").over(Window.partitionBy("lang").orderBy(F.col("step").desc())))
    found = ranked.filter(F.col("upto") >= wanted).groupBy("lang").agg((F.max("step") * 1000).alias("reached"))
    return langs.join(found, "lang", "left").select("lang", F.coalesce("reached", F.lit(0)).cast("long").alias("threshold"))


def collocations(spark: SparkSession, docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, cut, l, r, n, score.

    Null texts are empty; a null language counts as ``und``. Empty texts and texts
    without words add nothing; a language without a phrase has no row. Repeated rows count
    each time. Texts longer than a block are cut where pieces end, which no
    phrase crosses. Equal scores go by count, then by the phrase's UTF-8 bytes. Other
    columns are ignored, whatever their names. An empty table gives an empty result.
    """
    packed = stored(spark, blocks(docs, text, lang), "collocation-blocks")
    total = packed.agg(F.sum("words")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_WORDS))
    sizes = packed.groupBy("lang").agg(F.sum("words").alias("n"))
    words = stored(spark, _counted(packed, None, 1, buckets), "collocation-words")
    all_pairs = packed.withColumn("threshold", F.lit(0).cast("long"))
    pairs = stored(spark, words.unionByName(_counted(all_pairs, words, 2, buckets)), "collocation-pairs")
    scores = stored(spark, _emitted(all_pairs, pairs, 2).select("lang", "score"), "collocation-scores")
    open_langs, settled = sizes.select("lang"), []
    for factor in WIDEN:
        limits = stored(spark, _thresholds(scores, open_langs, factor and factor * top), "collocation-thresholds")
        frontier = packed.join(limits, "lang")
        threes = stored(spark, pairs.unionByName(_counted(frontier, pairs, 3, buckets)), "collocation-threes")
        fours = threes.unionByName(_counted(frontier, threes, 4, buckets))
        rows = stored(spark, _emitted(frontier, fours, LONGEST), "collocation-phrases")
        dropped = rows.filter("kind = 1").select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase")).distinct()
        left = rows.filter("kind = 0").drop("kind")
        left = left.join(dropped, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_phrase")), "left_anti")
        left = stored(spark, left, "collocation-survivors")
        counted = limits.join(left.groupBy("lang").agg(F.count(F.lit(1)).alias("found")), "lang", "left")
        done = counted.filter((F.col("threshold") == 0) | (F.coalesce("found", F.lit(0)) >= top)).select("lang")
        settled.append(left.join(done, "lang", "left_semi"))
        open_langs = stored(spark, open_langs.join(done, "lang", "left_anti"), "collocation-open")
        if open_langs.isEmpty():
            break
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    first = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    best = reduce(DataFrame.unionByName, settled).withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "cut", "l", "r", "n", "score")
