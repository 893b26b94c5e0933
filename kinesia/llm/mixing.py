"""Mixing sources to target token counts by Sainte-Lague apportionment; DataFrame functions only.

1. Sources get targets: a share by weight of the tokens wanted, none above its cap
   (the excess goes to the others by weight).
2. Equal-token blocks are allotted to sources by highest quotients target / (2s - 1),
   then each source's quota to its shards the same way by shard size. A source is cut
   by hash into as many shards as its size asks for, so a hot source is many shards.
3. In a shard the documents lie in seeded order on a circle of tokens; the shard's
   quota of blocks is taken from a seeded start onwards, round and round, so the
   n-th copy of a block is taken only when all blocks have been taken n - 1 times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)


def count_words(text: Column) -> Column:
    """Number of words; null text has none. Lengths of the runs of spaces are irrelevant."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "w")
    return F.length(F.regexp_replace(spaced, "[^w]+", "")).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, size) rows; one row per source.

    Sources are ordered by code point, null last, and take the weights in turn. The
    level at which share-by-weight meets the caps is found from running sums over the
    sources ordered by cap / weight: windows over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(0))
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1))
    per = per.withColumn("most", F.lit(cap) * F.col("source_size")).withColumn("ratio", F.col("most") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    wanted = F.least(F.lit(share) * F.sum("source_size").over(every), F.sum("most").over(every))
    level = (wanted - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onwards)
    per = per.withColumn("level", level)
    # the first source whose cap is not reached sets the level for all after it
    found = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(every)["level"]
    target = F.when(found.isNull(), F.col("most")).otherwise(F.least(F.col("most"), found * F.col("weight")))
    return per.select("source", "source_size", target.alias("target"))


def apportion(parts: DataFrame, seats: Column, keys: list[str], party: str, votes: str) -> DataFrame:
    """Sainte-Lague: (keys, party, quota) with ``seats`` seats per key, by highest quotients.

    A party's quota lies within k / 2M + 1/2 of its exact share q (k parties, M
    seats, in units of q and 1), so only those few quotients per party are ranked.
    Ties go to the smaller party key. Parties without votes get none.
    """
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    p = parts.filter(F.col(votes) > 0)
    p = p.withColumn("_k", F.count(F.lit(1)).over(group)).withColumn("_m", seats.cast("double"))
    q = F.col("_m") * F.col(votes) / F.sum(votes).over(group)
    spread = F.when(F.col("_m") > 0, F.col("_k") / (2 * F.col("_m"))).otherwise(F.lit(0.0))
    p = p.withColumn("_q", q)
    low = F.greatest(F.lit(0), F.floor(F.col("_q") * (1 - spread) - 0.5) - 1).cast("long")
    high = (F.ceil(F.col("_q") * (1 + spread) + 0.5) + 1).cast("long")
    p = p.withColumn("_low", low).withColumn("_left", F.col("_m").cast("long") - F.sum(low).over(group))
    rows = p.withColumn("_s", F.explode(F.sequence(F.col("_low") + 1, high)))
    best = group.orderBy((F.col(votes) / (2 * F.col("_s") - 1)).desc(), F.col(party).asc_nulls_last(), "_s")
    won = rows.withColumn("_won", (F.row_number().over(best) <= F.col("_left")).cast("long"))
    return won.groupBy(*keys, party).agg((F.first("_low") + F.sum("_won")).alias("quota"))


def mix_sources(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    share: float = 1.5,
    cap: float = 2.0,
    block: int = 8,
    shard_tokens: int = 1 << 21,
    seed: int = 17,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    ``taken`` is the number of tokens the mix takes from a document, repeats counted:
    at most ``cap`` times its size. A source's tokens come within a block per shard of
    its target. Null and empty texts have size 0 and nothing is taken; null source is a
    source of its own, the last. Order and start depend on the seed, doc_id and size
    only, so reruns agree; rows equal in these are interchangeable. Other columns are
    ignored; an empty table gives an empty result.
    """
    sizes = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), count_words(F.col(text)).alias("size")
    )
    targets = source_targets(sizes, weights, share, cap)
    seats = F.round(F.sum("target").over(Window.partitionBy(F.lit(0))) / block)
    quotas = apportion(targets.withColumn("_seats", seats), F.col("_seats"), [], "source", "target")
    plan = targets.join(quotas.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        F.coalesce("quota", F.lit(0)).alias("source_quota"),
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_tokens)).cast("long").alias("shards"),
    )
    draw = F.xxhash64(F.lit(seed), "doc_id", "size")
    placed = sizes.join(plan, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "source_size", "target", "source_quota",
        F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.col("shards")).alias("shard"), draw.alias("draw"),
    )
    shard_sizes = placed.groupBy("source", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("source_quota").alias("source_quota")
    )
    shard_quota = apportion(shard_sizes, F.col("source_quota"), ["source"], "shard", "shard_size").select(
        F.col("source").alias("_source"), F.col("shard").alias("_shard"), F.col("quota")
    )
    ring = Window.partitionBy("source", "shard")
    order = ring.orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a ring without tokens counts as one token around: it is a divisor, and nothing is taken from such a ring
    around = F.greatest(F.sum("size").over(ring), F.lit(1))
    laid = placed.withColumn("end", F.sum("size").over(order)).withColumn("around", around)
    laid = laid.join(
        shard_quota, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")), "left"
    )
    whole = F.least(F.coalesce("quota", F.lit(0)) * block, F.floor(F.lit(cap) * F.col("around")).cast("long"))
    start = F.pmod(F.xxhash64(F.lit(seed + 2), "source", "shard"), F.col("around"))
    laid = laid.withColumn("whole", whole).withColumn("start", start).withColumn("begin", F.col("end") - F.col("size"))
    rest_end = F.col("start") + F.pmod("whole", "around")
    overlap = lambda a, b: F.greatest(F.lit(0), F.least(b, F.col("end")) - F.greatest(a, F.col("begin")))
    taken = (
        F.floor(F.col("whole") / F.col("around")).cast("long") * F.col("size")
        + overlap(F.col("start"), rest_end)
        + overlap(F.lit(0), rest_end - F.col("around"))
    )
    return laid.select(
        "doc_id", "size", "source_size", "target", F.when(F.col("size") > 0, taken).otherwise(F.lit(0)).cast("long").alias("taken")
    )
