"""Suffix-array dedup by a common-prefix-aware distributed merge sort.

A suffix array of every byte would move the corpus hundreds of times, so only suffixes
at content-chosen places (anchors) are sorted: a window of ``length`` bytes belongs to
the leftmost smallest K-gram hash among its first SPAN starts. That choice depends on
the window's bytes alone, so equal windows have their anchor at the same distance d,
and are equal if and only if the anchors' suffixes agree for ``length - d`` bytes and
the texts before them for d bytes.

1. Anchors whose next ``length - SPAN + 1`` bytes occur once (by hash, which can only
   overstate) are dropped; the others are looked up in their documents.
2. Each task sorts the suffixes of its anchors into runs, one per target partition (by
   hash of those leading bytes), joins equal contexts into one entry, front-codes the
   run (shared prefix length, then the rest) and sends it.
3. A partition merges its runs with a loser tree that keeps, for each run, the length
   of the prefix its head shares with the last winner: heads with different lengths are
   decided without touching a byte, equal ones compare from that length on.
4. In the sorted order with its common-prefix lengths, and a second sort of the texts
   before the anchors, equal windows are runs of both orders; a window found twice
   marks its bytes in every document that has it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinesia.llm.graph import stored
from kinesia.llm.text import BYTE_CODE, as_bytes, doc_blocks, mix, packed_texts

LENGTH = 200
GRAM = 16
PART_ANCHORS = 1 << 14  # contexts a merge partition is planned for
_U = np.uint64
SEGMENT = 1 << 22
BLOCK = 1 << 18  # text handled at once: its arrays stay in cache


def span_of(length: int) -> int:
    """Starts among which a window's anchor is chosen; its gram stays inside the window."""
    return max(1, min(length - gram_of(length) + 1, length * 3 // 5))


def gram_of(length: int) -> int:
    """Bytes of a gram: a power of two that leaves room for a span."""
    return min(GRAM, 1 << max(0, (max(1, length // 4)).bit_length() - 1))


def _grams(buf: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes from each place, k a power of two, by doubling; len(buf) - k + 1 values."""
    have, width = BYTE_CODE[buf], 1
    while width < k:
        n = max(0, len(have) - width)
        have = (have[:n] ^ (have[:n] >> _U(29))) * _U(0xC2B2AE3D27D4EB4F) + have[width : width + n]
        width *= 2
    return have * _U(0x9FB21C651E98DF25)


def _marks(gram: np.ndarray, at: np.ndarray, lead: int, k: int) -> np.ndarray:
    """Hash of the ``lead`` bytes from each of some places, from the k-byte hashes that cover them."""
    out = np.zeros(len(at), _U)
    for offset in [*range(0, lead - k, k), lead - k]:
        out = mix(out) * _U(0xD6E8FEB86659FD93) + gram[at + offset]
    return mix(out)


def anchors(data: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, place, least d, greatest d, hash of the leading bytes) of the anchors of whole texts, in blocks."""
    span = span_of(length)
    lead, k = length - span + 1, gram_of(length)
    for i, j in doc_blocks(data, BLOCK):
        buf = np.frombuffer(b"".join(data[i:j]), np.uint8)
        at = np.zeros(j - i + 1, np.int64)
        np.cumsum([len(t) for t in data[i:j]], out=at[1:])
        docs = np.repeat(np.arange(j - i), np.diff(at))
        ends = at[1:][docs]
        for s in range(0, len(buf), SEGMENT):  # windows that start in this segment
            part = buf[s : s + SEGMENT + length - 1]
            n = len(part) - length + 1
            if n <= 0:
                break
            grams = _grams(part, k)
            gram = grams[: n + span - 1]
            key = (gram >> _U(24) << _U(24)) | np.arange(len(gram), dtype=_U)  # ties: leftmost
            pad = -len(key) % span
            grid = np.concatenate([key, np.full(pad, ~_U(0), _U)]).reshape(-1, span)
            ahead = np.minimum.accumulate(grid, 1).ravel()
            behind = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
            least = np.minimum(behind[:n], ahead[span - 1 : span - 1 + n])
            place = (least & _U((1 << 24) - 1)).astype(np.int64)
            start = np.arange(n) + s
            whole = np.flatnonzero(start + length <= ends[s : s + n])
            if not len(whole):
                continue
            a, p = place[whole] + s, start[whole]
            of = docs[p]
            new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (of[1:] != of[:-1])]))
            last = np.concatenate([new[1:], [len(a)]]) - 1
            yield of[new] + i, a[new] - at[of[new]], a[new] - p[last], a[new] - p[new], _marks(grams, a[new] - s, lead, k)


# ---- front-coded runs


def encode_run(rows: list[tuple[bytes, bytes]], tails: list[bytes]) -> bytes:
    """Sorted (suffix, before) rows with a tail each; suffixes front-coded."""
    out, last = [], b""
    for (suffix, before), tail in zip(rows, tails):
        shared = common(last, suffix, 0)
        for part in (suffix[shared:], before, tail):
            out.append(len(part).to_bytes(4, "little"))
            out.append(part)
        out.append(shared.to_bytes(4, "little"))
        last = suffix
    return b"".join(out)


def decode_run(data: bytes) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """(prefix shared with the row before, suffix, before, tail)."""
    at, last = 0, b""
    while at < len(data):
        parts = []
        for _ in range(3):
            n = int.from_bytes(data[at : at + 4], "little")
            parts.append(data[at + 4 : at + 4 + n])
            at += 4 + n
        shared = int.from_bytes(data[at : at + 4], "little")
        at += 4
        last = last[:shared] + parts[0]
        yield shared, last, parts[1], parts[2]


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known to agree."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    low, high = known, n  # halves: compares slices, not single bytes
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def merge_runs(runs: list[Iterator]) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """Merge sorted runs; yields (prefix shared with the row yielded before, suffix, before, tail).

    A loser tree over the runs' heads. shared[r] is the prefix that head r has in common
    with the last winner: of two heads the one with more in common with it is smaller,
    and with equal lengths the bytes from there on decide.
    """
    k = 1
    while k < len(runs):
        k *= 2
    runs = [iter(r) for r in runs] + [iter(())] * (k - len(runs))
    heads = [next(r, None) for r in runs]
    shared = [0] * k
    losers = [0] * k

    def better(x: int, y: int) -> tuple[int, int]:
        """(winner, loser); the loser's length becomes the prefix shared with the winner."""
        hx, hy = heads[x], heads[y]
        if hx is None or hy is None:
            return (y, x) if hx is None else (x, y)
        if shared[x] != shared[y]:
            # the loser agrees with the winner exactly as far as with the last winner
            return (x, y) if shared[x] > shared[y] else (y, x)
        a, b = hx[1], hy[1]
        n = common(a, b, shared[x])
        if (a[n : n + 1], x) < (b[n : n + 1], y):
            shared[y] = n
            return x, y
        shared[x] = n
        return y, x

    def build(node: int) -> int:
        if node >= k:
            return node - k
        w, losers[node] = better(build(2 * node), build(2 * node + 1))
        return w

    winner = build(1) if k > 1 else 0
    while heads[winner] is not None:
        _, suffix, before, tail = heads[winner]
        yield shared[winner], suffix, before, tail
        heads[winner] = head = next(runs[winner], None)
        # runs are front-coded: the next head's prefix shared with this winner is known
        shared[winner] = head[0] if head else 0
        node = (winner + k) // 2
        while node:
            winner, losers[node] = better(winner, losers[node])
            node //= 2


# ---- equal windows in sorted order


def _run_ids(shared: np.ndarray, least: int) -> np.ndarray:
    """Number of the run each row lies in, where neighbours share at least ``least``."""
    new = shared < least
    new[:1] = True
    return np.cumsum(new)


def repeated_windows(rows: list[tuple[int, bytes, bytes, bytes]], length: int) -> np.ndarray:
    """hit[i, d]: row i's window at distance d has an equal, for merged rows of whole groups.

    A row's tail lists its occurrences; a row with two or more repeats by itself.
    """
    n, span = len(rows), span_of(length)
    right = np.array([r[0] for r in rows], np.int64)
    right_len = np.array([len(r[1]) for r in rows], np.int64)
    left_len = np.array([len(r[2]) for r in rows], np.int64)
    of, t = occurrences(rows)
    low, high = np.full(n, span), np.full(n, -1)
    np.minimum.at(low, of, t["low"])
    np.maximum.at(high, of, t["high"])
    # the texts before the anchors, read backwards, in sorted order
    back = np.zeros((n, span), np.uint8)
    for i, r in enumerate(rows):
        back[i, : len(r[2])] = np.frombuffer(r[2], np.uint8)[::-1]
    order = np.argsort(back.view(f"S{span}").ravel(), kind="stable")
    differs = back[order[1:]] != back[order[:-1]]
    left = np.zeros(n, np.int64)
    left[1:] = np.where(differs.any(1), differs.argmax(1), span)
    several = np.flatnonzero(np.bincount(of, minlength=n)[of] > 1)
    hit = np.zeros((n, span), bool)
    for d in range(int(low.min()), int(high.max()) + 1):
        ok = np.flatnonzero((low <= d) & (d <= high) & (left_len >= d) & (right_len >= length - d))
        by_left = np.empty(n, np.int64)
        by_left[order] = _run_ids(left, d)
        both = _run_ids(right, length - d)[ok] * (n + 1) + by_left[ok]
        _, at, count = np.unique(both, return_inverse=True, return_counts=True)
        mine = several[(t["low"][several] <= d) & (d <= t["high"][several])]
        hit[ok, d] = (count[at] > 1) | (np.bincount(of[mine], minlength=n)[ok] > 1)
    return hit


def occurrences(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """(row, occurrence) of all occurrences of the rows."""
    t = np.frombuffer(b"".join(r[3] for r in rows), OCCURRENCE)
    return np.repeat(np.arange(len(rows)), [len(r[3]) // OCCURRENCE.itemsize for r in rows]), t


OCCURRENCE = np.dtype([("doc", "<i8"), ("place", "<i8"), ("low", "<i4"), ("high", "<i4")])


def repeated_spans(spark: SparkSession, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, starts, ends): byte spans covered by a repeated window, joined per task and document."""
    span = span_of(length)
    lead = length - span + 1

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for doc, place, low, high, mark in anchors(as_bytes(batch.column(1)), length):
                yield pa.RecordBatch.from_arrays([pa.array(ids[doc]), pa.array(place), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)), pa.array(mark.view(np.int64))], ["doc_id", "place", "low", "high", "mark"])

    found = docs.mapInArrow(find, "doc_id long, place long, low int, high int, mark long")
    again = found.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("mark")
    kept = found.join(again, "mark").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("place", "low", "high", "mark"))).alias("at"))
    kept = stored(spark, kept, "suffix-anchors")
    total = kept.agg(F.sum(F.size("at"))).first()[0] or 0
    parts = max(1, -(-total // PART_ANCHORS))

    def sort_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict] = {}
        size = 0
        for batch in batches:
            for doc, packed, at in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                text = zstandard.ZstdDecompressor().decompress(packed.as_buffer())
                for place, low, high, mark in zip(*(at.values.field(i).to_pylist() for i in range(4))):
                    context = (text[place : place + length], text[max(0, place - span + 1) : place])
                    group = held.setdefault(mark % parts, {})
                    if context not in group:
                        group[context] = []
                        size += length + span
                    group[context].append((doc, place, low, high))
                    size += OCCURRENCE.itemsize
                if size > RUN_BYTES:
                    yield from _runs(held)
                    held, size = {}, 0
        yield from _runs(held)

    runs = docs.mapInArrow(packed_texts, PACKED).join(kept, "doc_id").select("doc_id", "text", "at").mapInArrow(sort_runs, "part int, run binary")

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        out, held, group = [], [], []
        for row in merge_runs([decode_run(zstandard.ZstdDecompressor().decompress(r)) for r in pdf["run"]]):
            if row[0] < lead:  # rows that share less than the leading bytes have no equal window
                _close(group, held)
                group = []
                if len(held) >= PART_ANCHORS:
                    out.append(_spans(held, length))
                    held = []
            group.append(row)
        _close(group, held)
        if held:
            out.append(_spans(held, length))
        columns = [np.concatenate([o[i] for o in out]) if out else np.empty(0, np.int64) for i in range(3)]
        return pd.DataFrame(dict(zip(["doc_id", "start", "end"], columns)))

    spans = runs.groupBy("part").applyInPandas(merge, "doc_id long, start long, end long")
    return spans.groupBy("doc_id").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))


RUN_BYTES = 48 << 20
PACKED = "doc_id long, text binary"


def _runs(held: dict[int, dict]) -> Iterator[pa.RecordBatch]:
    for part in sorted(held):
        rows = sorted(held[part])
        run = encode_run(rows, [np.array(held[part][r], OCCURRENCE).tobytes() for r in rows])
        run = zstandard.ZstdCompressor(level=1).compress(run)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([run], pa.binary())], ["part", "run"])


def _close(group: list, held: list) -> None:
    """Add a finished group of rows to those held, rows of equal context as one; a row alone has no equal."""
    if len(group) < 2:
        if group and len(group[0][3]) > OCCURRENCE.itemsize:
            held.append((0, *group[0][1:]))
        return
    tails: dict[tuple[bytes, bytes], list[bytes]] = {}
    for row in group:
        tails.setdefault((row[1], row[2]), []).append(row[3])
    least = 0  # the first row of a group shares nothing that counts with the row before it
    for i, row in enumerate(group):
        if i:
            least = min(least, row[0])
        if (tail := tails.pop((row[1], row[2]), None)) is not None:
            held.append((least, row[1], row[2], b"".join(tail)))
            least = 1 << 30  # of the rows passed over until the next one kept, the least counts


def _spans(rows: list, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, end) of the repeated windows; adjoining ones of an anchor joined."""
    hit = repeated_windows(rows, length)
    edge = np.zeros((len(rows), hit.shape[1] + 2), np.int8)
    edge[:, 1:-1] = hit
    change = np.diff(edge, axis=1)
    row, first = np.nonzero(change == 1)
    last = np.nonzero(change == -1)[1] - 1
    of, t = occurrences(rows)
    begin = np.searchsorted(of, row)
    count = np.searchsorted(of, row, "right") - begin
    pick = np.repeat(begin, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    low = np.maximum(np.repeat(first, count), t["low"][pick])
    high = np.minimum(np.repeat(last, count), t["high"][pick])
    ok = low <= high
    place = t["place"][pick][ok]
    return t["doc"][pick][ok], place - high[ok], place - low[ok] + length


def suffix_dedup(spark: SparkSession, docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, starts, ends (removed spans, sorted, joined), kept (binary).

    Null text is empty. Texts shorter than ``length`` bytes lose nothing. Rows without
    a doc_id keep their text and take no part. Rows that repeat a doc_id are documents
    of their own, whether or not they repeat its text. Very long texts are taken whole.
    An empty table gives an empty result. Other columns are ignored.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    if source.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        return _without_spans(spark, source, length)
    rows = stored(spark, source.withColumn("row", F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())), "suffix-rows")
    out = _without_spans(spark, rows.select(F.col("row").alias("doc_id"), "text"), length).withColumnRenamed("doc_id", "of")
    ids = rows.filter("row is not null").select("row", "doc_id")
    return out.join(ids, F.col("of") == F.col("row"), "left").select("doc_id", "n_bytes", "starts", "ends", "kept")


def _without_spans(spark: SparkSession, source: DataFrame, length: int) -> DataFrame:
    """``suffix_dedup`` of (doc_id, text) with distinct ids."""
    spans = repeated_spans(spark, source.filter("doc_id is not null"), length)
    rows = source.mapInArrow(packed_texts, PACKED).join(spans.withColumnRenamed("doc_id", "_id"), F.col("doc_id") == F.col("_id"), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, firsts, lasts, kept = [], [], [], []
            for packed, starts, ends in zip(batch.column(1), batch.column(2), batch.column(3)):
                data = zstandard.ZstdDecompressor().decompress(packed.as_buffer())
                a, b = joined_spans(starts.values.to_numpy(), ends.values.to_numpy()) if starts.is_valid else ([], [])
                sizes.append(len(data))
                firsts.append(a)
                lasts.append(b)
                edges = [0, *(x for pair in zip(a, b) for x in pair), len(data)]
                kept.append(b"".join(data[x:y] for x, y in zip(edges[0::2], edges[1::2])))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(firsts, longs), pa.array(lasts, longs), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "starts", "ends", "kept"])

    return rows.select("doc_id", "text", "starts", "ends").mapInArrow(cut, "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary")


def joined_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[list[int], list[int]]:
    """Sorted spans, those that overlap or touch joined."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[new].tolist(), reach[np.concatenate([new[1:], [True]])].tolist()


def suffix_digests(spark: SparkSession, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of ``suffix_dedup``."""
    out = suffix_dedup(spark, docs, length)
    removed = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
