"""Vector codes: product quantisation whose Lloyd rounds keep members where they live.

1. Every component x becomes the integer floor(4096 * x); a vector is cut into
   ``PARTS`` equal parts. All later arithmetic is on integers and exact.
2. Parts are rows of (position, entry, salt): a block of parts of one position that
   are nearest to one entry. Blocks are dealt once, by that owner, over partitions that
   hold about ``MEMBERS`` parts; the salt splits an entry with a third of all parts.
3. A round's owners sum their resident members, which gives the next codebook
   (``PARTS`` * ``ENTRIES`` rows reach the driver, whatever the input). With it they look for
   each member's nearest entry again. Members that stay remain in their partition:
   only parts that changed entry go through the next shuffle, to their new owner.
4. At last every vector is coded from its own row with the final codebooks, so no
   vector id is ever shuffled.

Blocks between rounds are kept on the executors' disks; a lost executor's blocks are
made again from the shuffle files before them, or from the shared checkpoint that
every ``CUT`` rounds write.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinesia.session import ensure_checkpoint_dir

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
MEMBERS = 1 << 18
CUT = 3
SMALL = 1 << 28  # below it a part's squared distance stays below 2**63, up to 2**5 components
SALTS = 16
Codebook = list[list[list[int]]]  # position, entry, component


def integers(values: np.ndarray) -> np.ndarray:
    """floor(4096 * x) of finite doubles: int64 where small, Python integers otherwise."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * float(SCALE))
    if not values.size or np.abs(scaled).max() < SMALL:
        return scaled.astype(np.int64)
    exact = [Fraction(v) * SCALE // 1 for v in values.ravel().tolist()]
    return np.array(exact, object).reshape(values.shape)


def nearest(parts: np.ndarray, entries: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each part's nearest entry, ties to the lower index."""
    small = parts.dtype != object and all(abs(c) < SMALL for e in entries for c in e) and parts.shape[1] <= 32
    kind = np.int64 if small else object
    parts = parts.astype(kind, copy=False)
    best = np.zeros(len(parts), np.int64)
    least = None
    for k, e in enumerate(entries):
        apart = parts - np.array(e, kind)
        distance = (apart * apart).sum(1) if parts.shape[1] else np.zeros(len(parts), kind)
        if least is None:
            least = distance
        else:
            closer = distance < least
            best[closer] = k
            least = np.where(closer, distance, least)
    return best, least


def _usable(vector: str) -> F.Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.col(vector).isNotNull() & F.forall(F.col(vector), finite)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def initial_codebook(kept: DataFrame, size: int) -> Codebook:
    """The parts of the ``ENTRIES`` smallest ids (repeated ids by vector), fewer if the table has fewer."""
    rows = kept.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(ENTRIES).select("x").collect()
    whole = integers(np.array([r["x"] for r in rows], np.float64).reshape(len(rows), size))
    step = size // PARTS
    return [[[int(c) for c in v[p * step : (p + 1) * step]] for v in whole] for p in range(PARTS)]


def _owner(key: int) -> int:
    """Partition number before the modulus: neighbouring owners go to different partitions."""
    return (key * 0x9E3779B97F4A7C15 >> 20) & 0x7FFFFFFF


def _dealt(kept: DataFrame, size: int, book: Codebook, salts: int, partitions: int) -> RDD:
    """(owner, parts) blocks at their owners: the one shuffle that moves every part."""
    step = size // PARTS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() * 7919
        for number, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            whole = integers(_matrix(batch.column(0), size))
            salt, owners, blocks = (first + number) % salts, [], []
            for p in range(PARTS):
                parts = whole[:, p * step : (p + 1) * step]
                entry, _ = nearest(parts, book[p])
                for e in np.unique(entry).tolist():
                    owners.append((p * ENTRIES + e) * salts + salt)
                    blocks.append(pickle.dumps(_narrow(parts[entry == e]), 5))
            yield pa.RecordBatch.from_arrays([pa.array(owners, pa.int64()), pa.array(blocks, pa.binary())], ["owner", "block"])

    rows = kept.select("x").mapInArrow(cut, "owner long, block binary").rdd
    return rows.map(lambda r: (r[0], pickle.loads(r[1]))).partitionBy(partitions, _owner)


def _narrow(parts: np.ndarray) -> np.ndarray:
    """int32 where the integers fit: half the bytes to keep and move."""
    fits = parts.dtype != object and (not parts.size or np.abs(parts).max() < 1 << 31)
    return np.ascontiguousarray(parts.astype(np.int32) if fits else parts)


def _sums(members: RDD, salts: int) -> dict[int, tuple[int, list[int]]]:
    """position * ENTRIES + entry: (members, componentwise sum) over all owners."""

    def partial(blocks: Iterator[tuple[int, np.ndarray]]) -> Iterator[tuple[int, tuple]]:
        found: dict[int, tuple[int, np.ndarray]] = {}
        for owner, parts in blocks:
            n, total = found.get(owner // salts, (0, 0))
            kind = object if parts.dtype == object else np.int64
            found[owner // salts] = n + len(parts), total + parts.astype(kind).sum(0).astype(object)
        return iter(found.items())

    added = members.mapPartitions(partial).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), PARTS)
    return {k: (n, [int(c) for c in total]) for k, (n, total) in added.collect()}  # PARTS * ENTRIES rows at most


def _updated(book: Codebook, sums: dict[int, tuple[int, list[int]]]) -> Codebook:
    out = []
    for p, entries in enumerate(book):
        out.append([])
        for e, old in enumerate(entries):
            n, total = sums.get(p * ENTRIES + e, (0, old))
            out[-1].append([c // n for c in total] if n else old)
    return out


def _placed(members: RDD, book: Codebook, salts: int) -> RDD:
    """(owner, (new owner, parts)): the owners' members by their nearest entry; nothing moves yet."""

    def look(blocks: Iterator[tuple[int, np.ndarray]]) -> Iterator[tuple[int, tuple[int, np.ndarray]]]:
        resident: dict[int, list[np.ndarray]] = {}
        for owner, parts in blocks:
            resident.setdefault(owner, []).append(parts)
        for owner, held in resident.items():
            parts = np.concatenate([h.astype(object) for h in held] if any(h.dtype == object for h in held) else held)
            p, salt = owner // salts // ENTRIES, owner % salts
            entry, _ = nearest(parts.astype(np.int64) if parts.dtype != object else parts, book[p])
            for e in np.unique(entry).tolist():
                yield owner, ((p * ENTRIES + e) * salts + salt, _narrow(parts[entry == e]))

    return members.mapPartitions(look, preservesPartitioning=True)


def _settled(placed: RDD, partitions: int) -> RDD:
    """The members at their owners: those that stay by a narrow step, those that changed entry by a shuffle."""
    stay = placed.filter(lambda x: x[0] == x[1][0]).mapValues(lambda x: x[1])
    move = placed.filter(lambda x: x[0] != x[1][0]).map(lambda x: x[1]).partitionBy(partitions, _owner)
    return stay.union(move)


def fit_codebooks(spark: SparkSession, kept: DataFrame, size: int, rows: int, rounds: int = ROUNDS) -> Codebook:
    """The codebooks after ``rounds`` Lloyd rounds over ``kept`` (vec_id, x), vectors of ``size`` components each."""
    book = initial_codebook(kept, size)
    salts = max(1, -(-rows // MEMBERS))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = min(PARTS * ENTRIES * salts, max(least, -(-rows * PARTS // MEMBERS)))
    ensure_checkpoint_dir(spark)
    members, before = _dealt(kept, size, book, salts, partitions), None
    for number in range(1, rounds + 1):
        if number > 1:
            placed = _placed(members, book, salts).persist(StorageLevel.DISK_ONLY)
            if number % CUT == 0:
                placed.checkpoint()
            members = _settled(placed, partitions)
        book = _updated(book, _sums(members, salts))
        if number > 1:
            if before is not None:
                before.unpersist()
            before = placed
    if before is not None:
        before.unpersist()
    return book


def codebooks_sha256(book: Codebook) -> str:
    return hashlib.sha256(",".join(str(c) for entries in book for e in entries for c in e).encode()).hexdigest()


def encode(rows: DataFrame, book: Codebook, size: int) -> DataFrame:
    """(vec_id, label, code, error) of rows (vec_id, label, x); code and error are null for other sizes."""
    step = size // PARTS

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = np.array([len(v) == size for v in batch.column(2)], bool) if batch.num_rows else np.zeros(0, bool)
            whole = integers(_matrix(batch.column(2).filter(pa.array(fits)), size))
            entries, errors = [], np.zeros(len(whole), object)
            for p in range(PARTS):
                entry, distance = nearest(whole[:, p * step : (p + 1) * step], book[p])
                entries.append(entry.astype(np.uint8))
                errors = errors + distance
            text = np.stack(entries, 1).tobytes().hex()
            codes, sums = np.full(len(fits), None, object), np.full(len(fits), None, object)
            codes[fits] = [text[i : i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)]
            sums[fits] = [int(e) if e < 1 << 63 else None for e in errors]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes.tolist(), pa.string()), pa.array(sums.tolist(), pa.int64())], ["vec_id", "label", "code", "error"])

    kinds = dict(rows.dtypes)
    return rows.select("vec_id", "label", "x").mapInArrow(coded, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def vector_codes(spark: SparkSession, table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """One row per usable vector: vec_id, label, code, error, label_error, codebooks_sha256.

    Rows whose vector is null or holds null or non-finite components are dropped. The
    vector size is the one that most rows have (ties: the smaller); it must be a
    multiple of ``PARTS``, else ValueError. Rows of another size come back with null code
    and error and take no part in the codebooks. Fewer than ``ENTRIES`` rows give as many
    entries. Repeated ids are vectors of their own; of a repeated id the smaller vector
    comes first in the initial codebook, and a null id comes last. Components of any
    finite size are exact; an error beyond 64 bits is null and left out of its
    label's sum, and a sum beyond 64 bits is null. Null labels are one label. Other
    columns are ignored. An empty table gives an empty result.
    """
    source = table.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("x")).filter(_usable("x"))
    sizes = source.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.col("n").desc(), "size").limit(1).collect()
    size, n = (most[0]["size"], most[0]["n"]) if most else (0, 0)
    if size % PARTS:
        raise ValueError(f"vectors of {size} components cannot be cut into {PARTS} equal parts")
    book = fit_codebooks(spark, source.filter(F.size("x") == size).select("vec_id", "x"), size, n, rounds) if n else [[]] * PARTS
    coded = encode(source, book, size)
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    salted = sums.select(F.col("label").alias("_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    rows = coded.withColumn("_n", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int"))
    joined = rows.join(salted, F.col("label").eqNullSafe(F.col("_label")) & (F.col("_n") == F.col("_salt")))
    return joined.select("vec_id", "label", "code", "error", "label_error", F.lit(codebooks_sha256(book)).alias("codebooks_sha256"))
