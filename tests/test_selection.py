"""Correlation pruning (X4), signatures (X3) and the decision tree."""

import math
import random

import duckdb
import numpy as np
import pytest

from kinesia.ml.correlation import Moments, correlation_ratios, correlations, drop_pruned, prune_features
from kinesia.ml.tree import Tree, fit_tree, load_tree, save_tree, train_tree
from kinesia.operators import signature
from kinesia.plans.jobs import selected_features, tree_job
from kinesia.session import shared_dir


def _table(n=200, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = rng.gauss(1e6, 1), rng.gauss(0, 3)
        rows.append((x, y, 2 * x - 5 if i % 7 else None, -y + rng.gauss(0, 0.01), 4.25, None, float("nan") if i % 5 == 0 else rng.random(), "pq"[i % 2]))
    return rows


COLUMNS = ["a", "b", "c", "d", "same", "none", "e"]
SCHEMA = ", ".join(f"{c} double" for c in COLUMNS) + ", label string"


def _plain_corr(rows, i, j):
    pairs = [(r[i], r[j]) for r in rows if all(v is not None and not math.isnan(v) for v in (r[i], r[j]))]
    if len(pairs) < 2 or any(len({p[k] for p in pairs}) < 2 for k in (0, 1)):
        return len(pairs), None
    return len(pairs), float(np.corrcoef(np.array(pairs).T)[0, 1])


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_correlations_with_gaps_and_constants(spark, parts):
    rows = _table()
    got = correlations(spark.createDataFrame(rows, SCHEMA).repartition(parts), COLUMNS).collect()
    assert len(got) == 21
    for r in got:
        n, want = _plain_corr(rows, COLUMNS.index(r["feature_a"]), COLUMNS.index(r["feature_b"]))
        assert r["n"] == n
        assert (r["correlation"] is None) == (want is None) and (want is None or abs(r["correlation"] - want) < 1e-7)


def test_moments_merge_in_any_grouping_and_empty_table(spark):
    values = np.random.default_rng(1).normal(5, 2, (90, 3))
    values[::4, 1] = np.nan
    whole = Moments(3).add(values)
    parts = [Moments(3).add(values[i : i + 7]) for i in range(0, 90, 7)]
    merged = Moments(3)
    for p in parts[::-1]:
        merged.merge(Moments.unpacked(p.packed(), 3))
    assert np.allclose(merged.correlation(), whole.correlation(), atol=1e-12) and (merged.n == whole.n).all()
    empty = spark.createDataFrame([], SCHEMA)
    assert [r["correlation"] for r in correlations(empty, ["a", "b"]).collect()] == [None]
    assert correlation_ratios(empty, ["a"], "label") == {"a": 0.0}


def test_pruning_drops_without_a_trend_and_the_alike(spark):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        t = rng.gauss(0, 1)
        a = t + rng.gauss(0, 0.5)
        rows.append((t, a, -3 * a + 1, rng.gauss(0, 1), 7.0, float(i % 2) + rng.gauss(0, 0.1), "pq"[i % 2]))
    df = spark.createDataFrame(rows, "t double, a double, twin double, noise double, flat double, by_label double, label string").repartition(4)
    features = ["a", "twin", "noise", "flat", "by_label"]
    found = {p.feature: p for p in prune_features(df, features, target="t", label="label", least_trend=0.2)}
    assert [f for f in features if found[f].kept] == ["a", "by_label"]
    assert found["twin"].reason == "like a" and found["flat"].reason == "no trend" and found["flat"].target_correlation is None
    assert found["by_label"].label_ratio > 0.9 > found["a"].target_correlation > 0.8
    assert drop_pruned(df, found.values()).columns == ["t", "a", "by_label", "label"]
    alike_only = prune_features(df, features)
    assert [p.feature for p in alike_only if not p.kept] == ["twin", "flat"]
    again = prune_features(df.repartition(9), features, target="t", label="label", least_trend=0.2)
    assert again == list(found.values())


def _walks(spark, extra=()):
    rng = random.Random(4)
    rows = [("u" if i % 3 else "v", "walk", 10 + rng.random(), 5 + rng.random(), rng.random(), i) for i in range(300)]
    rows += [("u", "sit", rng.random(), 8 + rng.random(), 3.0, 1000 + i) for i in range(50)]
    return spark.createDataFrame([*rows, *extra], "user_id string, activity_id string, x double, y double, z double, id int").repartition(3)


@pytest.mark.parametrize("limit", [signature.BROADCAST_BYTES, 0])
def test_outliers_are_unlike_their_group(spark, monkeypatch, limit):
    """Both ways to join the signatures give the same rows."""
    monkeypatch.setattr(signature, "BROADCAST_BYTES", limit)
    extra = [("u", "walk", -10.0, 0.0, 9.0, 2001), ("u", "walk", 0.0, 0.0, 0.0, 2002), ("u", "walk", None, 1.0, 1.0, 2003)]
    extra += [(None, None, 1.0, 1.0, 1.0, 4), (None, None, 1.0, 1.0, 1.1, 5), ("u", "nil", 1.0, 0.0, 0.0, 6), ("u", "nil", -1.0, 0.0, 0.0, 7)]
    df = _walks(spark, extra).withColumn("cosines", signature.F.lit(1))
    got = {(r["id"], r["activity_id"]): r for r in signature.flag_outliers(df, ["x", "y", "z"], ["activity_id"]).collect()}
    assert len(got) == df.count()
    assert got[2001, "walk"]["outlier"] and got[2001, "walk"]["cosine"] < 0
    assert sum(r["outlier"] for r in got.values()) <= 6
    for key in [(2002, "walk"), (2003, "walk"), (6, "nil"), (7, "nil")]:  # zero row, NULL feature, zero mean
        assert got[key]["cosine"] is None and not got[key]["outlier"]
    assert got[4, None]["cosine"] > 0.99  # NULL keys are a group
    kept = signature.drop_outliers(df, ["x", "y", "z"], ["activity_id"])
    assert kept.columns == df.columns and kept.count() == sum(not r["outlier"] for r in got.values())
    assert signature.flag_outliers(df.limit(0), ["x"], ["activity_id"]).count() == 0


def test_likeness_names_the_unlike_member(spark):
    extra = [("odd", "walk", 0.1, -9.0, 4.0, i) for i in range(200)]
    got = {(r["user_id"], r["activity_id"]): r["cosine"] for r in signature.group_likeness(_walks(spark, extra), ["x", "y", "z"]).collect()}
    assert min(got, key=got.get) == ("odd", "walk") and got["u", "walk"] > 0.5


def _labelled(n=500, seed=8):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y, w = rng.uniform(-5, 5), rng.uniform(0, 100), rng.choice([1.0, 2.0])
        label = "low" if x <= 0 else ("it's" if y <= 40 else "high")
        rows.append((i, x if i % 50 else None, y, w, label if i % 97 else None))
    return rows


LABELLED = "id int, x double, y double, w double, label string"


def test_tree_finds_planted_rules_and_its_case_agrees(spark):
    rows = _labelled()
    df = spark.createDataFrame(rows, LABELLED).repartition(4)
    tree = fit_tree(df, ["x", "y", "w"], "label", max_depth=4)
    scored = {r["id"]: r["predictedLabel"] for r in tree.transform(df).collect()}
    known = [r for r in rows if r[1] is not None and r[4] is not None]
    assert sum(scored[r[0]] == r[4] for r in known) > 0.95 * len(known)
    assert fit_tree(df.repartition(7), ["x", "y", "w"], "label", max_depth=4) == tree  # a rerun splits alike
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id INT, x DOUBLE, y DOUBLE, w DOUBLE, label VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?)", rows)
    assert dict(con.sql(f"SELECT id, {tree.to_sql()} FROM t").fetchall()) == scored
    leaves = {r["id"]: r["leaf"] for r in df.select("id", tree.leaf().alias("leaf")).collect()}
    assert all(tree.leaves[leaves[i]] == label for i, label in scored.items())
    assert len(tree.rules()) == len(tree.leaves)


def test_tree_edges(spark):
    df = spark.createDataFrame(_labelled(60), LABELLED)
    with pytest.raises(ValueError):
        fit_tree(df.limit(0), ["x"], "label")
    with pytest.raises(ValueError):
        fit_tree(df.where("label is null"), ["x"], "label")
    stump = fit_tree(df.withColumn("same", signature.F.lit(1.0)), ["same"], "label")
    assert stump.splits == {} and set(stump.leaves) == {1}
    assert fit_tree(df, ["x", "y"], "label", max_depth=0).splits == {}
    ties = spark.createDataFrame([(1, 0.0, 0.0, 1.0, "b"), (2, 0.0, 0.0, 1.0, "a")], LABELLED)
    assert fit_tree(ties, ["x"], "label").leaves == {1: "a"}


def test_tree_job_saves_rules_and_scores_the_hold_out(spark):
    data, out = shared_dir(spark, "tree-data"), shared_dir(spark, "tree-out")
    spark.createDataFrame(_labelled(), LABELLED).where("label is not null").write.parquet(data)
    tree, scored = tree_job(spark, data, out, features=["x", "y", "w"], label="label", split_key="id", max_depth=3)
    assert load_tree(spark, f"{out}/tree") == tree == Tree.from_json(tree.to_json())
    stored = spark.read.parquet(f"{out}/test_results")
    assert sorted(map(tuple, stored.collect()), key=repr) == sorted(map(tuple, scored.collect()), key=repr)
    assert 0 < stored.count() < 120
    save_tree(spark, tree, f"{out}/tree")  # replaces
    again, _ = train_tree(spark.read.parquet(data), ["x", "y", "w"], "label", split_key="id", max_depth=3)
    assert again == tree


def test_selected_features_for_training(spark):
    rows = [(float(i), 2.0 * i, float((i * 37) % 11), float(i % 2), "pq"[i % 2]) for i in range(120)]
    df = spark.createDataFrame(rows, "heart_rate double, a double, b double, c double, activity_id string")
    kept, features = selected_features(df, ["heart_rate", "a", "b", "c"], pruned=True, most_alike=0.9, least_trend=0.1)
    assert features == ["heart_rate", "a", "c"] and kept.count() == 120
    kept, features = selected_features(df, ["heart_rate", "a", "b", "c"], without_outliers=True)
    assert features == ["heart_rate", "a", "b", "c"] and 100 < kept.count() <= 120
