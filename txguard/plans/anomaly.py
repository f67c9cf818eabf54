"""Isolation forest: trees grown in parallel on small subsamples, rows scored where they are."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txguard.operators.quantiles import exact_quantiles
from txguard.operators.sampling import hash_order, sample_rows

EULER_GAMMA = 0.5772156649015329
NODES = "tree int, node int, feature int, threshold double, size int"


def average_path(n):
    """Expected path length of an unsuccessful search in a binary tree of ``n`` rows."""
    n = np.asarray(n, dtype="float64")
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + EULER_GAMMA) - 2 * (n - 1) / np.maximum(n, 1),
                    np.where(n == 2, 1.0, 0.0))


def draw(seed: int, tree: int, node: int, what: str) -> float:
    """A number in [0, 1) that follows from its arguments alone: 53 bits of an MD5, which any restatement can make."""
    return (int.from_bytes(hashlib.md5(f"{seed}:{tree}:{node}:{what}".encode()).digest()[:8], "big") >> 11) / 2.0 ** 53


def _grow(columns: list[str], depth: int, seed: int):
    """The split of a node takes a column that varies there and a cut between its ends, both drawn for that node."""
    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        values, nodes = rows[columns].to_numpy("float64"), []
        pending = [(0, values, 0)]
        while pending:
            node, part, level = pending.pop()
            spans = part.max(axis=0) - part.min(axis=0)
            if level == depth or len(part) < 2 or not spans.any():
                nodes.append((tree, node, -1, 0.0, len(part)))
                continue
            varying = np.flatnonzero(spans)
            feature = int(varying[int(draw(seed, tree, node, "column") * len(varying))])
            cut = float(part[:, feature].min() + draw(seed, tree, node, "cut") * spans[feature])
            left = part[:, feature] <= cut
            nodes.append((tree, node, feature, cut, len(part)))
            pending += [(2 * node + 1, part[left], level + 1), (2 * node + 2, part[~left], level + 1)]
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "size"])

    return grow


def grow_forest(df: DataFrame, columns: list[str], keys: list[str], *, trees: int = 100, subsample: int = 256,
                seed: int = 42) -> DataFrame:
    """Nodes of all trees. Each tree gets its own share of one hash sample, at most ``subsample`` rows."""
    depth = int(np.ceil(np.log2(max(subsample, 2))))
    sample = sample_rows(df.select(*keys, *columns).na.drop(subset=columns), trees * subsample, keys, seed)
    # At most trees * subsample rows are numbered here, whatever the size of the table.
    position = F.row_number().over(Window.orderBy(hash_order(seed, *keys), *keys)) - 1
    dealt = sample.withColumn("tree", F.pmod(position, F.lit(trees)).cast("int"))
    return dealt.groupBy("tree").applyInPandas(_grow(columns, depth, seed), NODES)


def anomaly_scores(df: DataFrame, forest: DataFrame, columns: list[str], subsample: int = 256) -> DataFrame:
    """``df`` plus ``anomaly_score`` in (0, 1]; the higher, the easier a row is to isolate.

    The forest has a fixed maximum size (trees times twice the subsample), so the nodes travel with the
    task; rows go through in Arrow batches, one vectorised walk per tree level.
    """
    nodes = forest.toPandas()
    width = int(nodes["node"].max()) + 1
    index = {tree: i for i, tree in enumerate(sorted(nodes["tree"].unique()))}
    feature = np.full((len(index), width), -1, dtype="int32")
    cut, path = np.zeros((len(index), width)), np.zeros((len(index), width))
    at = nodes["tree"].map(index).to_numpy(), nodes["node"].to_numpy()
    feature[at], cut[at] = nodes["feature"], nodes["threshold"]
    path[at] = np.floor(np.log2(nodes["node"].to_numpy() + 1)) + average_path(nodes["size"])
    typical = float(nodes.loc[nodes["node"] == 0, "size"].map(lambda n: float(average_path(n))).mean())
    shared = df.sparkSession.sparkContext.broadcast((feature, cut, path))

    @F.pandas_udf("double")
    def score(*series: pd.Series) -> pd.Series:
        split_on, threshold, length = shared.value
        rows = np.column_stack([s.fillna(0).to_numpy("float64") for s in series])
        total = np.zeros(len(rows))
        for tree in range(len(split_on)):
            node = np.zeros(len(rows), dtype="int64")
            while True:
                on = split_on[tree, node]
                inner = np.flatnonzero(on >= 0)
                if not len(inner):
                    break
                right = rows[inner, on[inner]] > threshold[tree, node[inner]]
                node[inner] = 2 * node[inner] + 1 + right
            total += length[tree, node]
        return pd.Series(np.exp2(-total / len(split_on) / typical))

    return df.withColumn("anomaly_score", score(*[F.col(c).cast("double") for c in columns]))


def flag_anomalies(scored: DataFrame, contamination: float = 0.1) -> DataFrame:
    """``is_anomaly`` 1 for scores above the exact ``1 - contamination`` quantile.

    Pass a stored table: the quantile reads the scores twice more.
    """
    limit = exact_quantiles(scored, [], "anomaly_score", [1 - contamination]).select("quantile")
    return scored.withColumn("is_anomaly", (F.col("anomaly_score") > limit.scalar()).cast("int"))
