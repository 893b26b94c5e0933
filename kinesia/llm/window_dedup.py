"""Substring dedup over windows of words, with a count-min prefilter.

1. Texts are packed into blocks. Each block sketches its windows: ROWS rows of cells that
   saturate at two, kept sparse, as the sorted cells met and a bit for "met again". The
   cells are cut into parts; sketches of all blocks are merged part by part, and
   each block is told which of its own cells count two or more. A cell never counts
   less than a window's occurrences.
2. A second pass sends on only windows whose cells all count two or more; these are
   grouped by 96 bits of hash, and every window whose sequence starts in a
   smaller document is marked. A window that does occur again is never ruled out. Of a
   stretch of documents only the smallest with a window is sent, the others are marked
   on the spot, so a window that all documents have stays a few entries. Windows are
   dealt by the smallest hash among their word groups, as neighbours mostly share it:
   they travel, and come back marked, as stretches.
3. Marked windows go back to their documents, whose covered words are removed.

Cells are in proportion to the text at every size, so the share of windows that pass by
chance stays the same. No task or broadcast holds the whole sketch: a block holds its own
cells, an owner those of one part, and a cell that every block has is one entry a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinesia.llm.graph import stored
from kinesia.llm.text import doc_blocks, joined, mix, run_hashes, word_bounds, word_hashes

WINDOW = 13
CELLS_PER_BYTE = 1  # cells of a row per byte of text, rounded up to a power of two
LEAST_BITS = 16
BLOCK_BYTES = 8 << 20  # text that is sketched together; a longer text is a block of its own
WINDOW_LOG = 23  # bytes that a block's compression looks back, as a power of two
SKETCH_PART_BYTES = 16 << 20  # text whose windows fill a part of the cells, about
DEAL_WORDS = 4
PART_BYTES = 8 << 20  # text whose windows make a partition of the exact pass
ROWS = 2
STRETCH = 1 << 18  # windows that are compared before they are sent
_U = np.uint64


def _windows(texts: list[bytes], width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, place of the first word, hash, second hash, dealing hash) of every window, in blocks of documents."""
    for i, j in doc_blocks(texts):
        buf, at = joined(texts[i:j])
        starts, _, words = word_hashes(buf)
        if len(words) < width:
            continue
        doc = np.searchsorted(at, starts, "right") - 1
        first = np.searchsorted(starts, at[:-1])  # index of each document's first word
        whole = np.flatnonzero(doc[: len(doc) - width + 1] == doc[width - 1 :])
        groups = run_hashes(words, min(DEAL_WORDS, width), 5)
        deal = groups[: len(words) - width + 1].copy()
        for k in range(1, width - min(DEAL_WORDS, width) + 1):
            np.minimum(deal, groups[k : k + len(deal)], out=deal)
        yield doc[whole] + i, whole - first[doc[whole]], run_hashes(words, width, 1)[whole], run_hashes(words, width, 2)[whole], mix(deal[whole])


def _cells(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cell of each hash in each row."""
    return [(h >> _U(64 - bits)), ((h * _U(0x9E6C63D0676A9A99)) >> _U(64 - bits))][:ROWS]


def _pack_numbers(sorted_numbers: np.ndarray) -> bytes:
    """Sorted numbers below 2**32 as compressed differences, like bytes side by side."""
    gaps = np.diff(sorted_numbers.astype(np.uint32), prepend=np.uint32(0)).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(gaps.view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack_numbers(data) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def text_blocks(rows: DataFrame) -> DataFrame:
    """(block, ids, lengths, text): whole texts (doc_id, text), packed in blocks of about BLOCK_BYTES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0

        def done() -> pa.RecordBatch:
            # a window as wide as the block: its copies are near
            how = zstandard.ZstdCompressionParameters.from_level(5, window_log=WINDOW_LOG)
            pack = zstandard.ZstdCompressor(compression_params=how).compress
            columns = [np.array(ids, "<i8").tobytes(), np.array([len(t) for t in texts], "<i8").tobytes(), pack(b"".join(texts))]
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), *(pa.array([c], pa.binary()) for c in columns)], ["block", "ids", "lengths", "text"])

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                t = t.as_py().encode("utf-8")
                if texts and size + len(t) > BLOCK_BYTES:
                    yield done()
                    at += 1
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
        if texts:
            yield done()

    return rows.select("doc_id", "text").mapInArrow(run, "block long, ids binary, lengths binary, text binary")


def _texts(lengths, text) -> list[bytes]:
    """The texts of a block."""
    data = zstandard.ZstdDecompressor().decompress(text.as_buffer())
    ends = np.cumsum(np.frombuffer(lengths.as_buffer(), "<i8")).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def sketch_cells(blocks: DataFrame, width: int, bits: int, part_bits: int) -> DataFrame:
    """(block, row, part, cells): of the cells that each block has met, those that count two or more over all blocks.

    A part is the leading ``part_bits`` of a cell, at least ``bits - 32`` of them.
    """
    low_bits = bits - part_bits
    low = _U((1 << low_bits) - 1)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lengths, text in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                hashes = [h for _, _, h, _, _ in _windows(_texts(lengths, text), width)]
                if not sum(map(len, hashes)):
                    continue
                hashes = np.concatenate(hashes)
                for row in range(ROWS):
                    cells = np.sort(_cells(hashes, bits)[row])
                    first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
                    again = np.diff(np.append(first, len(cells))) > 1
                    cells = cells[first]
                    part = (cells >> _U(low_bits)).astype(np.int64)
                    cells = (cells & low).astype(np.uint32)
                    edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
                    for i in range(0, len(edges) - 1, 1024):
                        cuts = list(zip(edges[i : i + 1024].tolist(), edges[i + 1 : i + 1025].tolist()))
                        n = len(cuts)
                        columns = [np.full(n, block), np.full(n, row, np.int32), part[edges[i : i + n]]]
                        met = pa.array([_pack_numbers(cells[a:b]) for a, b in cuts], pa.binary())
                        twice = pa.array([np.packbits(again[a:b]).tobytes() for a, b in cuts], pa.binary())
                        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), met, twice], ["block", "row", "part", "met", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # sorted by (row, part): the sketches of one part at a time
        key, held = None, []
        for batch in batches:
            for block, row, part, met, twice in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if key != (row, part):
                    if held:
                        yield from _merged(key, held)
                    key, held = (row, part), []
                held.append((block, met, twice))
        if held:
            yield from _merged(key, held)

    parts = blocks.select("block", "lengths", "text").mapInArrow(sketch, "block long, row int, part long, met binary, twice binary")
    return parts.repartition("row", "part").sortWithinPartitions("row", "part").mapInArrow(merge, "block long, row int, part long, cells binary")


def _merged(key: tuple[int, int], held: list[tuple[int, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
    """What each block is told of its cells in one part."""
    met = [_unpack_numbers(m) for _, m, _ in held]
    every = np.sort(np.concatenate(met))
    twice = [m[np.unpackbits(np.frombuffer(t, np.uint8), count=len(m)).astype(bool)] for m, (_, _, t) in zip(met, held)]
    again = np.unique(np.concatenate([every[1:][every[1:] == every[:-1]], *twice]))
    out = [(block, _pack_numbers(m[found])) for m, (block, _, _) in zip(met, held) if (found := _in_sorted(again, m)).any()]
    if out:
        n = len(out)
        columns = [pa.array([b for b, _ in out], pa.int64()), pa.array([key[0]] * n, pa.int32()), pa.array([key[1]] * n, pa.int64())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([c for _, c in out], pa.binary())], ["block", "row", "part", "cells"])


def _in_sorted(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each value is in a sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def window_dedup(spark: SparkSession, docs: DataFrame, width: int = WINDOW, bits: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the words kept, joined by one space).

    Null and empty texts have no words; texts of fewer than ``width`` words lose none.
    Rows without a doc_id are left whole and do not make others lose words. Rows that
    repeat a doc_id are one document to each other: none removes another's words, and
    what is removed from them is told by place, so give documents distinct ids. Other
    columns are ignored. ``bits`` sets the sketch's cells (2 ** bits a row); None takes them
    by the text, however much it is.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    blocks, marked = marked_windows(spark, source, width, bits)
    marked = marked.groupBy("block").agg(F.collect_list("marks").alias("marks")).withColumnRenamed("block", "of")  # at most a block's own windows
    joined_rows = blocks.join(marked, F.col("block") == F.col("of"), "left")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, lengths, text, marks in zip(*(batch.column(i) for i in range(4))):
                ids = np.frombuffer(ids.as_buffer(), "<i8")
                of, place, count = _unpack_marks(marks.as_py() or [])
                begin, end = np.searchsorted(of, ids, "left").tolist(), np.searchsorted(of, ids, "right").tolist()
                out = [_removed(t, (place[a:b], count[a:b]) if b > a else None, width) for t, a, b in zip(_texts(lengths, text), begin, end)]
                yield _kept(pa.array(ids), out)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _kept(batch.column(0), [_removed((t.as_py() or "").encode("utf-8"), None, width) for t in batch.column(1)])

    columns = "doc_id long, n_words long, n_removed long, kept string"
    others = source.filter("doc_id is null or text is null").mapInArrow(whole, columns)
    return joined_rows.select("ids", "lengths", "text", "marks").mapInArrow(remove, columns).unionByName(others)


def _kept(ids: pa.Array, out: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    n_words, n_removed, kept = ([x[k] for x in out] for k in range(3))
    return pa.RecordBatch.from_arrays([ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array([k.decode("utf-8") for k in kept], pa.string())], ["doc_id", "n_words", "n_removed", "kept"])


def _removed(data: bytes, marks: list[np.ndarray] | None, width: int) -> tuple[int, int, bytes]:
    starts, ends = word_bounds(np.frombuffer(data, np.uint8))
    if marks is None:
        return len(starts), 0, b" ".join(data.split())
    place, count = marks
    ok = place + count + width - 1 <= len(starts)  # rows that share a doc_id may be shorter
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, place[ok], 1)
    np.add.at(cover, (place + count + width - 1)[ok], -1)
    keep = np.flatnonzero(np.cumsum(cover[:-1]) == 0)
    return len(starts), len(starts) - len(keep), b" ".join([data[a:b] for a, b in zip(starts[keep].tolist(), ends[keep].tolist())])


def marked_windows(spark: SparkSession, source: DataFrame, width: int, bits: int | None) -> tuple[DataFrame, DataFrame]:
    """The text blocks, and (block, marks): packed stretches of windows that also start in a smaller document."""
    rows = source.filter("doc_id is not null and text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = bits or max((total * CELLS_PER_BYTE).bit_length(), LEAST_BITS)
    part_bits = min((total // SKETCH_PART_BYTES).bit_length(), bits)
    part_bits = max(part_bits, bits - 32)  # a cell's place in its part takes 32 bits
    parts = max(1, -(-total // PART_BYTES))
    blocks = stored(spark, text_blocks(rows), "window-blocks")
    cells = sketch_cells(blocks, width, bits, part_bits).withColumnRenamed("block", "of")
    told = cells.groupBy("of").agg(F.collect_list(F.struct("row", "part", "cells")).alias("told"))  # at most a block's own cells
    told = blocks.join(told, F.col("block") == F.col("of")).select("block", "ids", "lengths", "text", "told")

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, lengths, text, cells in zip(*(batch.column(i) for i in range(5))):
                block = block.as_py()
                tables = _tables(cells.as_py(), bits - part_bits)
                ids, held, size = np.frombuffer(ids.as_buffer(), "<i8"), [], 0
                for doc, place, h, h2, deal in _windows(_texts(lengths, text), width):
                    again = np.ones(len(h), bool)
                    for table, of in zip(tables, _cells(h, bits)):
                        again &= _in_sorted(table, of)
                    at = np.flatnonzero(again)
                    part = (deal[at] % _U(parts)).astype(np.int64)
                    held.append((part, h[at], (h2[at] >> _U(32)).astype(np.uint32), ids[doc[at]], place[at].astype(np.int64)))
                    size += len(at)
                    if size > STRETCH:
                        yield from _sent(block, held)
                        held, size = [], 0
                if size:
                    yield from _sent(block, held)

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # sorted by part: one partition of the windows at a time
        part, held = None, []
        for batch in batches:
            for p, marked, block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                if part is not None and p != part:
                    yield _answered(held)
                    held = []
                part = p
                held.append((marked, block, data.as_py()))
        if held:
            yield _answered(held)

    found = told.mapInArrow(likely, "part long, marked boolean, block long, windows binary")
    return blocks, found.repartition("part").sortWithinPartitions("part").mapInArrow(group, "block long, marks binary")


def _tables(told: list[dict], low_bits: int) -> list[np.ndarray]:
    """The cells of each row that count two or more, sorted, from what a block is told part by part."""
    out = [[np.empty(0, _U)] for _ in range(ROWS)]
    for t in sorted(told, key=lambda t: (t["row"], t["part"])):
        out[t["row"]].append(_unpack_numbers(t["cells"]).astype(_U) + _U(t["part"] << low_bits))
    return [np.concatenate(x) for x in out]


def _first_of_equal(h: np.ndarray, h2: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether a smaller document has the same window, for each window."""
    order = np.lexsort((ids, h2, h))
    new = np.ones(len(h), bool)
    a, b = order[1:], order[:-1]
    new[1:] = (h[a] != h[b]) | (h2[a] != h2[b])
    out = np.empty(len(h), bool)
    if len(h):
        out[order] = ids[order] > ids[order[np.flatnonzero(new)]][np.cumsum(new) - 1]
    return out


def _sent(block: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Packets of one block by part: the windows of the smallest document of each sequence with their hashes, the others as marked places."""
    part, h, h2, ids, place = (np.concatenate(x) for x in zip(*held))
    marked = _first_of_equal(h, h2, ids)
    order = np.lexsort((place, ids, marked, part))
    part, h, h2, ids, place, marked = (x[order] for x in (part, h, h2, ids, place, marked))
    edge = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (marked[1:] != marked[:-1]), [True]]))
    pack = zstandard.ZstdCompressor(level=1).compress
    packets = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        s = slice(a, b)
        columns = [np.diff(ids[s], prepend=0).astype("<i8"), np.diff(place[s], prepend=0).astype("<i4")]
        if not marked[a]:
            columns += [h[s], h2[s]]
        packets.append(pack((b - a).to_bytes(8, "little") + b"".join(c.tobytes() for c in columns)))
    first = edge[:-1]
    yield pa.RecordBatch.from_arrays([pa.array(part[first]), pa.array(marked[first]), pa.array(np.full(len(first), block)), pa.array(packets, pa.binary())], ["part", "marked", "block", "windows"])


def _answered(held: list[tuple[bool, int, bytes]]) -> pa.RecordBatch:
    """The marked windows of one partition by block, neighbours in a document as one stretch."""
    done, todo = [], []
    for marked, block, data in held:
        data = zstandard.ZstdDecompressor().decompress(data)
        n = int.from_bytes(data[:8], "little")
        ids = np.cumsum(np.frombuffer(data, "<i8", n, 8))
        place = np.cumsum(np.frombuffer(data, "<i4", n, 8 + 8 * n).astype(np.int64))
        blocks = np.full(n, block)
        if marked:
            done.append((blocks, ids, place))
        else:
            todo.append((blocks, ids, place, np.frombuffer(data, _U, n, 8 + 12 * n), np.frombuffer(data, np.uint32, n, 8 + 20 * n)))
    if todo:
        blocks, ids, place, h, h2 = (np.concatenate(x) for x in zip(*todo))
        later = _first_of_equal(h, h2, ids)
        done.append((blocks[later], ids[later], place[later]))
    blocks, ids, place = (np.concatenate(x) for x in zip(*done))
    order = np.lexsort((place, ids, blocks))
    blocks, ids, place = blocks[order], ids[order], place[order]
    new = np.ones(len(ids), bool)
    new[1:] = (blocks[1:] != blocks[:-1]) | (ids[1:] != ids[:-1]) | (place[1:] > place[:-1] + 1)
    start = np.flatnonzero(new)
    last = np.append(start[1:], len(ids)) - 1 if len(ids) else start
    blocks, ids, place, count = blocks[start], ids[start], place[start], place[last] - place[start] + 1
    edge = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1], [True]])) if len(ids) else np.zeros(1, int)
    marks = [_pack_marks(ids[a:b], place[a:b], count[a:b]) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
    return pa.RecordBatch.from_arrays([pa.array(blocks[edge[:-1]], pa.int64()), pa.array(marks, pa.binary())], ["block", "marks"])


def _pack_marks(ids: np.ndarray, place: np.ndarray, count: np.ndarray) -> bytes:
    """Stretches sorted by document and place."""
    columns = [np.diff(ids, prepend=0).astype("<i8"), np.diff(place, prepend=0).astype("<i4"), count.astype("<i4")]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.tobytes() for c in columns))


def _unpack_marks(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first place, count) of all stretches, by document."""
    out = [(np.empty(0, np.int64),) * 3]
    for data in packed:
        data = zstandard.ZstdDecompressor().decompress(data)
        n = len(data) // 16
        ids, place = np.cumsum(np.frombuffer(data, "<i8", n)), np.cumsum(np.frombuffer(data, "<i4", n, 8 * n).astype(np.int64))
        out.append((ids, place, np.frombuffer(data, "<i4", n, 12 * n).astype(np.int64)))
    ids, place, count = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(ids, kind="stable")
    return ids[order], place[order], count[order]


def window_digests(spark: SparkSession, docs: DataFrame, width: int = WINDOW, bits: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of ``window_dedup``."""
    out = window_dedup(spark, docs, width, bits)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
