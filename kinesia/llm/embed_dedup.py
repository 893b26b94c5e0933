"""Embedding near-dedup by int8-quantised tile products with rigorous error bounds.

Distinct vectors are scaled to length 1 and quantised to int8 with a scale of their
own; the length of each rounding error is kept. A tile is a block of vectors, and
each pair of tiles is one product of the int8 codes (exact in float32: a sum of d
products of at most 127 * 127 stays below 2**24 for d <= 1040; wider vectors use
float64). For unit vectors x = x' + dx and y = y' + dy

    |x.y - x'.y'| <= |x'||dy| + |dx||y'| + |dx||dy|

so a pair whose quantised product plus that bound is below the threshold is ruled
out, and every other pair is computed again in double precision from the original
components. Tiles are cut along the vectors' projection on their mean direction u;
as |x.u - y.u| <= |x - y| <= sqrt(2 - 2t) for linked pairs, tile pairs whose
projections lie further apart are never formed.

Of a tile pair only per-vector link counts and a spanning forest of its links come
out, so a dense cluster of any size stays linear in its members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinesia.llm.graph import components, stored

TILE = 2048
SLACK = 1e-9  # above any rounding of the double-precision bound itself


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scale, error length, quantised length) of rows of length 1."""
    scale = np.abs(unit).max(axis=1) / 127.0
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    back = codes.astype(np.float64) * scale[:, None]
    return codes, scale, np.linalg.norm(unit - back, axis=1), np.linalg.norm(back, axis=1)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index connected with each index, by links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def tile_links(left: dict, right: dict, same: bool, threshold: float):
    """(links per left row, links per right row, forest edges): counts weighted by multiplicity."""
    wide = left["codes"].shape[1] > 1040
    kind = np.float64 if wide else np.float32
    estimate = (left["codes"].astype(kind) @ right["codes"].astype(kind).T).astype(np.float64)
    estimate *= left["scale"][:, None]
    estimate *= right["scale"][None, :]
    bound = left["length"][:, None] * right["error"][None, :]
    bound += left["error"][:, None] * (right["length"] + right["error"])[None, :]
    estimate += bound
    possible = estimate >= threshold - SLACK
    if same:
        possible = np.triu(possible, 1)
    a, b = np.nonzero(possible)
    linked = np.empty(len(a), bool)
    for i in range(0, len(a), 1 << 14):
        s = slice(i, i + (1 << 14))
        linked[s] = np.einsum("ij,ij->i", left["unit"][a[s]], right["unit"][b[s]]) >= threshold
    a, b = a[linked], b[linked]
    n, m = len(left["id"]), len(right["id"])
    to_left = np.bincount(a, right["copies"][b], n).astype(np.int64)
    to_right = np.bincount(b, left["copies"][a], m).astype(np.int64)
    if same:
        root = _roots(n, a, b)
        at = np.flatnonzero(root != np.arange(n))
        return to_left + to_right, np.zeros(m, np.int64), (left["id"][at], left["id"][root[at]])
    root = _roots(n + m, a, b + n)
    ids = np.concatenate([left["id"], right["id"]])
    at = np.flatnonzero(root != np.arange(n + m))
    return to_left, to_right, (ids[at], ids[root[at]])


def _tile(block: bytes, ids: bytes, copies: bytes, dim: int) -> dict:
    vectors = np.frombuffer(block, np.float32).reshape(-1, dim).astype(np.float64)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    codes, scale, error, length = quantise(unit)
    return {"id": np.frombuffer(ids, np.int64), "copies": np.frombuffer(copies, np.int64), "unit": unit, "codes": codes, "scale": scale, "error": error, "length": length}


def cut_tiles(spark: SparkSession, vectors: DataFrame, count: int, size: int = TILE) -> DataFrame:
    """(tile, dim, low, high, ids, copies, block) from the ``count`` rows (id, copies, dim, proj, embedding)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held = TaskContext.get().partitionId(), 0, []
        kinds = ["id", "copies", "dim", "proj", "embedding"]

        def close(rows: pd.DataFrame) -> pa.RecordBatch:
            nonlocal made
            made += 1
            block = np.stack([np.asarray(v, np.float32) for v in rows["embedding"]])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + made], pa.int64()), pa.array([block.shape[1]], pa.int32()),
                    pa.array([float(rows["proj"].min())]), pa.array([float(rows["proj"].max())]),
                    pa.array([rows["id"].to_numpy(np.int64).tobytes()], pa.binary()),
                    pa.array([rows["copies"].to_numpy(np.int64).tobytes()], pa.binary()), pa.array([block.tobytes()], pa.binary()),
                ],
                ["tile", "dim", "low", "high", "ids", "copies", "block"],
            )

        left = None
        for batch in batches:
            rows = batch.to_pandas()[kinds]
            left = rows if left is None else pd.concat([left, rows], ignore_index=True)
            while len(left):
                same_dim = int((left["dim"] != left["dim"].iloc[0]).to_numpy().argmax()) or len(left)
                if same_dim == len(left) and same_dim < size:
                    break
                take = min(size, same_dim)
                yield close(left.iloc[:take])
                left = left.iloc[take:].reset_index(drop=True)
        if left is not None and len(left):
            yield close(left)

    # a task cuts several tiles, so that few are left unfilled however finely the range is dealt
    parts = vectors.repartitionByRange("dim", "proj", "id").sortWithinPartitions("dim", "proj", "id")
    parts = parts.coalesce(max(1, count // (4 * size)))
    tiles = parts.mapInArrow(run, "tile long, dim int, low double, high double, ids binary, copies binary, block binary")
    return stored(spark, tiles, "embedding-tiles")


def embedding_links(spark: SparkSession, rows: DataFrame, threshold: float = 0.9, vec_id: str = "vec_id", embedding: str = "embedding", tile: int = TILE):
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero, or hold null or non-finite components link
    with nothing; vectors of different lengths do not link with each other. Equal
    vectors are compared once and counted as many times as they occur. Rows without a
    vec_id link with nothing and have a null component_id; rows that repeat a vec_id
    count as vectors of their own in n_links. Other columns are ignored.
    """
    data = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<float>").alias("embedding"))
    fit = F.exists("embedding", lambda x: x != 0) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    usable = data.filter("vec_id is not null and embedding is not null").filter(F.coalesce(fit, F.lit(False)))
    # -0.0 and 0.0 are one value, so that equal vectors have equal bytes
    usable = usable.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0).cast("float")))
    distinct = usable.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    distinct = stored(spark, distinct.withColumn("dim", F.size("embedding")), "embedding-distinct")
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    scaled = distinct.withColumn("length", length)
    mean = scaled.select("dim", "length", F.posexplode("embedding").alias("i", "x")).groupBy("dim", "i").agg(
        F.avg(F.col("x") / F.col("length")).alias("m")
    )
    # one row per component of the vectors: bounded by their length
    means = mean.groupBy(F.col("dim").alias("mean_dim")).agg(F.sort_array(F.collect_list(F.struct("i", "m"))).alias("c"))
    means = means.select("mean_dim", F.transform("c", lambda s: s["m"]).alias("mean"))
    dot = F.aggregate(F.zip_with("embedding", "mean", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    norm = F.sqrt(F.aggregate("mean", F.lit(0.0), lambda a, x: a + x * x))
    proj = F.when(norm > 0, dot / (F.col("length") * norm)).otherwise(F.lit(0.0))
    placed = scaled.join(F.broadcast(means), F.col("dim") == F.col("mean_dim"))  # a row per vector length
    tiles = cut_tiles(spark, placed.select("id", "copies", "dim", proj.alias("proj"), "embedding"), distinct.count(), tile)

    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    head = tiles.select("tile", "dim", "low", "high")
    other = head.select(F.col("tile").alias("right"), F.col("dim").alias("dim2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    near = (F.col("dim") == F.col("dim2")) & (F.col("right") >= F.col("tile"))
    near = near & (F.col("low2") <= F.col("high") + reach) & (F.col("low") <= F.col("high2") + reach)
    # pairs of tile headers, a few numbers per tile
    pairs = head.join(other, near).select(F.col("tile").alias("left"), "right")
    lefts = tiles.select(F.col("tile").alias("left"), "dim", F.col("ids").alias("ids1"), F.col("copies").alias("copies1"), F.col("block").alias("block1"))
    rights = tiles.select(F.col("tile").alias("right"), F.col("ids").alias("ids2"), F.col("copies").alias("copies2"), F.col("block").alias("block2"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                v = {k: batch.column(i)[r] for i, k in enumerate(batch.schema.names)}
                raw = lambda k: v[k].as_buffer().to_pybytes()  # noqa: E731, B023
                dim, same = v["dim"].as_py(), v["left"].as_py() == v["right"].as_py()
                one = _tile(raw("block1"), raw("ids1"), raw("copies1"), dim)
                two = one if same else _tile(raw("block2"), raw("ids2"), raw("copies2"), dim)
                to_left, to_right, (a, b) = tile_links(one, two, same, threshold)
                ids = np.concatenate([one["id"][to_left > 0], two["id"][to_right > 0], a])
                links = np.concatenate([to_left[to_left > 0], to_right[to_right > 0], np.zeros(len(a), np.int64)])
                to = np.concatenate([np.full(len(ids) - len(a), -1), b])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(to, mask=np.arange(len(to)) < len(ids) - len(a))], ["id", "links", "other"])

    # the tile pairs are dealt out evenly before the blocks are joined to them
    work = pairs.join(lefts, "left").join(rights, "right").select("left", "right", "dim", "ids1", "copies1", "block1", "ids2", "copies2", "block2")
    found = stored(spark, work.mapInArrow(run, "id long, links long, other long"), "embedding-links")
    group = components(spark, found.filter("other is not null"), "id", "other")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    classes = distinct.join(counts, "id", "left").join(group.withColumnRenamed("node", "id"), "id", "left").select(
        F.col("embedding").alias("vector"), F.coalesce("component", "id").alias("class"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
    )
    linked = usable.join(classes, usable["embedding"] == classes["vector"]).select("vec_id", F.col("links").alias("n_links"), F.col("class").alias("component_id"))
    alone = data.filter(F.col("vec_id").isNull() | ~F.coalesce(fit, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
