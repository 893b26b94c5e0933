"""A decision tree over binned features, grown level by level, with its rules as SQL.

1. Features become whole numbers (``round(x * scale)``). One pass finds their ranges, one
   counts rows per feature and cell of an equal grid; cells join into ``bins`` of about
   equal counts. Both are sums of fixed size, whatever the input.
2. The label and the bins are written to the shared folder. Each level is one aggregate
   over them: rows per open node, feature, bin and label, partial on the map side. Its size is
   set by the parameters and the number of labels; the best splits are taken from it.
3. Splits are chosen by whole-number counts, ties by feature and threshold, so a rerun
   gives the same tree.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinesia.ml.split import hash_split
from kinesia.schema import FEATURES, LABEL
from kinesia.session import shared_dir

CELLS = 1024
BINS = 32
SCALE = 1000
LEAST_GAIN = 1e-9


@dataclass
class Tree:
    """Nodes by number: the root is 1, the children of i are 2i (at most the threshold) and 2i + 1."""

    scale: int
    splits: dict[int, tuple[str, int]]  # node: feature, threshold on round(feature * scale)
    leaves: dict[int, str]

    def _case(self, node: int, leaf) -> str:
        if node not in self.splits:
            return leaf(node)
        feature, threshold = self.splits[node]
        name = '"' + feature.replace('"', '""') + '"'
        return f"CASE WHEN CAST(round({name} * {self.scale}) AS BIGINT) <= {threshold} THEN {self._case(2 * node, leaf)} ELSE {self._case(2 * node + 1, leaf)} END"

    def to_sql(self) -> str:
        """The prediction as an ANSI SQL expression over the feature columns. NULL features go to the ELSE side."""
        return self._case(1, lambda node: "'" + self.leaves[node].replace("'", "''") + "'")

    def _column(self, node: int, leaf) -> Column:
        if node not in self.splits:
            return F.lit(leaf(node))
        feature, threshold = self.splits[node]
        left = F.coalesce(whole(F.col(feature), self.scale) <= threshold, F.lit(False))
        return F.when(left, self._column(2 * node, leaf)).otherwise(self._column(2 * node + 1, leaf))

    def prediction(self) -> Column:
        return self._column(1, lambda node: self.leaves[node])

    def leaf(self) -> Column:
        """Number of the leaf a row falls into."""
        return self._column(1, lambda node: node).cast("long")

    def transform(self, df: DataFrame, output: str = "predictedLabel") -> DataFrame:
        """``df`` with the predicted label: a map of native expressions, in batch and on streams."""
        return df.withColumn(output, self.prediction())

    def rules(self) -> list[tuple[int, str, str]]:
        """(leaf, condition, label) from the left to the right."""
        out = []

        def walk(node: int, path: list[str]) -> None:
            if node in self.splits:
                feature, threshold = self.splits[node]
                at = threshold / self.scale
                walk(2 * node, [*path, f"{feature} <= {at:g}"])
                walk(2 * node + 1, [*path, f"{feature} > {at:g}"])
            else:
                out.append((node, " and ".join(path) or "always", self.leaves[node]))

        walk(1, [])
        return out

    def to_json(self) -> str:
        return json.dumps({"scale": self.scale, "splits": {str(k): list(v) for k, v in self.splits.items()}, "leaves": {str(k): v for k, v in self.leaves.items()}})

    @classmethod
    def from_json(cls, text: str) -> Tree:
        data = json.loads(text)
        return cls(data["scale"], {int(k): (f, int(t)) for k, (f, t) in data["splits"].items()}, {int(k): v for k, v in data["leaves"].items()})


def whole(x: Column, scale: int) -> Column:
    return F.round(x.cast("double") * F.lit(scale)).cast("long")


def _cells(df: DataFrame, features: Sequence[str], scale: int) -> tuple[list[Column], list[tuple[int, int]]]:
    """(cell per feature, NULL where the feature is; (least, most) per feature)."""
    numbers = [whole(F.col(f), scale) for f in features]
    row = df.agg(*[g(x).alias(f"{n}{i}") for i, x in enumerate(numbers) for g, n in ((F.min, "a"), (F.max, "b"))]).first()
    ends = [(row[f"a{i}"] or 0, row[f"b{i}"] or 0) for i in range(len(features))]
    cells = [F.floor((x - F.lit(a)) * F.lit(CELLS) / F.lit(b - a + 1)).cast("int") for x, (a, b) in zip(numbers, ends)]
    return cells, ends


def _bins(counts: dict[int, int], bins: int) -> list[int]:
    """Bin of each cell: cells below which the same share of the rows lies, in ``bins`` steps."""
    total, below, out = sum(counts.values()), 0, []
    for cell in range(CELLS):
        out.append(below * bins // total if total else 0)
        below += counts.get(cell, 0)
    return out


def _per_feature(columns: Sequence[Column]) -> Column:
    return F.posexplode(F.array(*columns)).alias("feature", "value")


def _best_split(counts: dict, features: int, least_rows: int) -> tuple[int, int] | None:
    """(feature, bin) with the purest halves; ``counts``: (feature, bin) -> {label: rows}."""
    pure = lambda c: sum(n * n for n in c.values()) / sum(c.values()) if c else 0.0
    best = None
    for f in range(features):
        own = sorted((b, c) for (g, b), c in counts.items() if g == f)
        whole_node: dict[str, int] = defaultdict(int)
        for _, c in own:
            for label, n in c.items():
                whole_node[label] += n
        left: dict[str, int] = defaultdict(int)
        right = dict(whole_node)
        for b, c in own[:-1]:
            for label, n in c.items():
                left[label] += n
                right[label] -= n
            if min(sum(left.values()), sum(right.values())) < least_rows:
                continue
            score = pure(left) + pure(right)
            if score > pure(whole_node) + LEAST_GAIN * sum(whole_node.values()) and (best is None or score > best[0]):
                best = (score, f, b)
    return best and best[1:]


def fit_tree(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    *,
    max_depth: int = 4,
    bins: int = BINS,
    scale: int = SCALE,
    least_rows: int = 1,
) -> Tree:
    """Fit a tree by Gini impurity; two passes for the bins, one over the binned rows per level.

    Rows without a label are left out. A NULL or NaN feature lies beyond the last bin, on the
    right of every split. Features are told apart to 1 / ``scale``. Leaves carry their
    most frequent label, ties alphabetical. An empty table raises ValueError. The driver holds nodes x features x bins x labels counts.
    """
    features = list(features)
    spark = df.sparkSession
    known = df.where(F.col(label).isNotNull()).select(*[F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")).alias(f) for f in features], F.col(label).cast("string").alias("_label"))
    cells, ends = _cells(known, features, scale)
    grid: dict[int, dict[int, int]] = defaultdict(dict)
    for r in known.select(_per_feature(cells)).where("value is not null").groupBy("feature", "value").count().collect():  # features x CELLS rows
        grid[r["feature"]][r["value"]] = r["count"]
    bin_of = [_bins(grid[i], bins) for i in range(len(features))]
    last_cell = [{b: c for c, b in enumerate(of)} for of in bin_of]
    beyond = bins  # of missing values
    binned = known.select(
        "_label", *[F.coalesce(F.get(F.lit(of), c), F.lit(beyond)).cast("tinyint").alias(f"b{i}") for i, (of, c) in enumerate(zip(bin_of, cells))]
    )
    path = shared_dir(spark, "tree-bins")
    binned.write.parquet(path)
    binned = spark.read.schema(binned.schema).parquet(path)
    splits: dict[int, tuple[int, int]] = {}
    leaves: dict[int, str] = {}
    open_nodes = {1}
    for depth in range(max_depth + 1):

        def node_of(at: int) -> Column:
            if at in splits:
                f, b = splits[at]
                return F.when(F.col(f"b{f}") <= b, node_of(2 * at)).otherwise(node_of(2 * at + 1))
            return F.lit(at if at in open_nodes else None).cast("long")

        placed = binned.withColumn("_node", node_of(1)).where("_node is not null")
        if depth == max_depth:
            rows = placed.groupBy("_node", "_label").count().select("_node", F.lit(0).alias("feature"), F.lit(0).alias("value"), "_label", "count")
        else:
            rows = placed.select("_node", "_label", _per_feature([F.col(f"b{i}") for i in range(len(features))])).groupBy("_node", "feature", "value", "_label").count()
        counts: dict[int, dict] = defaultdict(lambda: defaultdict(dict))
        for r in rows.collect():
            counts[r["_node"]][r["feature"], r["value"]][r["_label"]] = r["count"]
        if not counts and depth == 0:
            raise ValueError("a tree needs at least one row with a label")
        following = set()
        for node in sorted(counts):
            found = _best_split(counts[node], len(features), least_rows) if depth < max_depth else None
            if found:
                splits[node] = found
                following |= {2 * node, 2 * node + 1}
            else:
                sums: dict[str, int] = defaultdict(int)
                for (f, _), c in counts[node].items():
                    for name, n in c.items() if f == 0 else ():
                        sums[name] += n
                leaves[node] = min(sums, key=lambda name: (-sums[name], name))
        open_nodes = following
        if not open_nodes:
            break
    edge = lambda f, b: ends[f][0] + ((last_cell[f][b] + 1) * (ends[f][1] - ends[f][0] + 1) - 1) // CELLS
    return Tree(scale, {k: (features[f], edge(f, b)) for k, (f, b) in splits.items()}, leaves)


def save_tree(spark: SparkSession, tree: Tree, path: str) -> str:
    """The tree as one line of JSON, replacing what is there."""
    spark.createDataFrame([(tree.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def load_tree(spark: SparkSession, path: str) -> Tree:
    return Tree.from_json(spark.read.text(path).first()[0])


def train_tree(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    *,
    split_key: Sequence[str] | str,
    train_fraction: float = 0.9,
    seed: int = 0,
    out_dir: str | None = None,
    **options,
) -> tuple[Tree, DataFrame]:
    """(tree, scored hold-out rows): the training job with a tree in place of the network.

    The split is a hash of ``split_key``; with ``out_dir`` the tree goes to ``<out>/tree`` and the
    hold-out rows with their prediction to ``<out>/test_results``.
    """
    train_df, test_df = hash_split(df, split_key, train_fraction, seed)
    tree = fit_tree(train_df, features, label, **options)
    scored = tree.transform(test_df)
    if out_dir:
        save_tree(df.sparkSession, tree, f"{out_dir}/tree")
        scored.write.mode("overwrite").parquet(f"{out_dir}/test_results")
    return tree, scored
