"""Signatures: the mean feature vector of a group, and rows that do not look like their group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinesia.schema import FEATURES
from kinesia.session import shared_dir

BROADCAST_BYTES = 32 << 20
SALTS = 16
GRID = 10_000  # cosines are compared on a grid of 1 / GRID


def _added(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def cosine(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Cosine of two vectors given by their components; NULL if one has a NULL component or length 0."""
    length = lambda v: F.sqrt(_added([x * x for x in v]))
    both = length(left) * length(right)
    return F.when(both > 0, _added([a * b for a, b in zip(left, right)]) / both)


def signatures(df: DataFrame, features: Sequence[str] = FEATURES, keys: Sequence[str] = ("user_id", "activity_id")) -> DataFrame:
    """(keys, sig_<feature>): each group's mean vector; NULLs are left out of the means."""
    return df.groupBy(*keys).agg(*[F.avg(F.col(f).cast("double")).alias(f"sig_{f}") for f in features])


def _match(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys])


def join_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the columns of their group; NULL keys are groups of their own.

    ``groups`` is written to the shared folder first, so it is computed once and its size is known. Up
    to ``BROADCAST_BYTES`` it is broadcast; a larger one is shuffled, each group
    ``SALTS`` times, so that a group with a third of all rows is dealt over as many tasks.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "groups")
    groups.write.parquet(path)
    stored = spark.read.schema(groups.schema).parquet(path)
    values = [c for c in groups.columns if c not in set(keys)]
    text = [F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys]
    size = stored.agg(F.sum(_added([F.lit(8 * (len(values) + 2)), *text]))).first()[0] or 0
    renamed = stored.select(*[F.col(k).alias(f"_g_{k}") for k in keys], *values)
    if size <= BROADCAST_BYTES:
        return df.join(F.broadcast(renamed), _match(keys), "left").select(*df.columns, *values)
    salted = renamed.withColumn("_g_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, _match(keys) & (F.col("_salt") == F.col("_g_salt")), "left").select(*df.columns, *values)


def signature_cosine(df: DataFrame, features: Sequence[str] = FEATURES, keys: Sequence[str] = ("user_id", "activity_id")) -> DataFrame:
    """``df`` with ``cosine``: how much each row looks like the mean of its group, -1 to 1.

    NULL for a row with a NULL feature, a row of zeros, and a group whose mean is zero or
    has no value in a feature.
    """
    joined = join_groups(df, signatures(df, features, keys), keys)
    value = cosine([F.col(f).cast("double") for f in features], [F.col(f"sig_{f}") for f in features])
    return joined.withColumn("cosine", value).select(*df.columns, "cosine")


def cosine_cutoffs(scored: DataFrame, keys: Sequence[str], percent: int = 5, fence: float = 1.5) -> DataFrame:
    """(keys, cutoff): cosines on the grid below it are outliers of their group.

    The cutoff lies ``fence`` times the distance from the ``percent`` quantile to the median
    below that quantile, both taken from the group's count per grid point, which merges
    by addition: a group of any size is at most 2 * ``GRID`` + 1 rows.
    """
    cells = scored.where(F.col("cosine").isNotNull()).groupBy(*keys, _cell().alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*keys)
    ranked = cells.select("*", F.sum("_n").over(group.orderBy("_cell")).alias("_upto"), F.sum("_n").over(group).alias("_all"))
    quantile = lambda q: F.min(F.when(100 * F.col("_upto") >= q * F.col("_all"), F.col("_cell")))
    found = ranked.groupBy(*keys).agg(quantile(percent).alias("_low"), quantile(50).alias("_mid"))
    return found.select(*keys, F.floor(F.col("_low") - F.lit(fence) * (F.col("_mid") - F.col("_low"))).cast("long").alias("cutoff"))


def _cell() -> Column:
    return F.round(F.col("cosine") * GRID).cast("long")


def flag_outliers(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    keys: Sequence[str] = ("user_id", "activity_id"),
    *,
    percent: int = 5,
    fence: float = 1.5,
) -> DataFrame:
    """``df`` with ``cosine`` and ``outlier``: rows unlike the signature of their group.

    Thresholds are each group's own (``cosine_cutoffs``). A row without a cosine is no
    outlier: nothing speaks against it. The scored rows are written to the shared folder once
    and read for the thresholds and for the result.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "scored-rows")
    scored = signature_cosine(df, features, keys)
    scored.write.parquet(path)
    scored = spark.read.schema(scored.schema).parquet(path)
    joined = join_groups(scored, cosine_cutoffs(scored, keys, percent, fence), keys)
    flag = F.coalesce(_cell() < F.col("cutoff"), F.lit(False))
    return joined.withColumn("outlier", flag).select(*scored.columns, "outlier")


def drop_outliers(df: DataFrame, features: Sequence[str] = FEATURES, keys: Sequence[str] = ("user_id", "activity_id"), **options) -> DataFrame:
    """``df`` without the rows that do not look like their group: a filter ahead of training."""
    return flag_outliers(df, features, keys, **options).where(~F.col("outlier")).select(*df.columns)


def group_likeness(df: DataFrame, features: Sequence[str] = FEATURES, member: Sequence[str] = ("user_id", "activity_id"), of: Sequence[str] = ("activity_id",)) -> DataFrame:
    """(member, cosine): how much each member's signature looks like that of its wider group.

    The wider signature is the mean of its members' signatures, so that a user with
    a third of all rows weighs as much as any other.
    """
    own = signatures(df, features, member)
    means = [f"sig_{f}" for f in features]
    wide = own.groupBy(*of).agg(*[F.avg(m).alias(f"all_{m}") for m in means])
    joined = join_groups(own, wide, list(of))
    return joined.select(*member, cosine([F.col(m) for m in means], [F.col(f"all_{m}") for m in means]).alias("cosine"))
