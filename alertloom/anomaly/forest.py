"""Isolation forest (Liu, Ting and Zhou, 2008): trees fitted in parallel, scoring map-only."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertloom.operators.once import computed_once

NODES = "tree_id int, node_id int, feature int, threshold double, left int, right int, size int, depth int"
_TEXT_OF_NULL = "<null>"
# Tickets are residues of a prime.
PRIME = 2**31 - 1
TERMS = 4


def _text(key: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit(_TEXT_OF_NULL)) for c in key])


def tree_samples(
    rows: DataFrame,
    key: Sequence[str],
    n: int,
    trees: int = 300,
    sample_size: int = 256,
    seed: int = 42,
) -> DataFrame:
    """`sample_size` rows per tree, without replacement, from the `n` rows of `rows`.

    The md5 of seed and key gives each row the coefficients of a polynomial; its value at a tree's number,
    modulo a prime, is the row's ticket for the tree. Tickets of different rows are independent, and so are
    those of one row for any four trees. The trees whose ticket is low enough are found before the row
    is copied, at every size alike; about twice as many rows as needed pass, and each tree keeps
    those with the lowest tickets.
    """
    size = min(sample_size, n)
    wanted = 2 * size + 64  # leaves no real chance that a tree falls short
    limit = min(PRIME, -(-PRIME * wanted // n))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), _text(key)))
    terms = [F.conv(F.substring("_digest", 1 + 8 * i, 8), 16, 10).cast("bigint") % PRIME for i in range(TERMS)]

    def ticket(tree: Column) -> Column:
        value = F.lit(0).cast("bigint")
        for i in range(TERMS):
            value = (value * tree + F.col("_terms")[i]) % PRIME
        return value

    digested = computed_once(computed_once(rows, "_digest", digest), "_terms", F.array(*terms))
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(trees - 1).cast("bigint"))
    chosen = F.filter(numbers, lambda tree: ticket(tree) < limit)
    # The samples are small but growing a tree is not: a fixed number of tasks keeps adaptive
    # execution from merging them.
    tasks = min(trees, rows.sparkSession.sparkContext.defaultParallelism)
    w = Window.partitionBy("tree_id").orderBy("ticket", _text(key))
    return (
        digested.select("*", F.explode(chosen).alias("_tree"))
        .withColumns({"ticket": ticket(F.col("_tree")), "tree_id": F.col("_tree").cast("int")})
        .drop("_digest", "_terms", "_tree")
        .repartition(tasks, "tree_id")
        .withColumn("_n", F.row_number().over(w))
        .filter(F.col("_n") <= size)
        .drop("_n")
    )


def draws(seed: int, tree: int, place: int) -> tuple[int, float]:
    """A number to choose a feature with and a share in [0, 1) to cut at, from the md5 of a node's place.

    The root is at place 1, the children of place p at 2p and 2p + 1.
    """
    digest = hashlib.md5(f"{seed}|{tree}|{place}".encode()).hexdigest()
    return int(digest[:8], 16), int(digest[8:16], 16) / 2**32


def grow_tree(x: np.ndarray, draw: Callable[[int], tuple[int, float]], height: int) -> list[tuple]:
    """Split at random until points are alone, alike or `height` deep. One tuple per node."""
    nodes: list[tuple] = []

    def grow(points: np.ndarray, place: int, depth: int) -> int:
        me = len(nodes)
        nodes.append((-1, 0.0, -1, -1, len(points), depth))
        if depth >= height or len(points) <= 1:
            return me
        low, high = points.min(axis=0), points.max(axis=0)
        varying = np.flatnonzero(high > low)
        if len(varying) == 0:
            return me
        choice, share = draw(place)
        f = int(varying[choice % len(varying)])
        cut = float(low[f] + share * (high[f] - low[f]))
        below = points[:, f] <= cut
        left = grow(points[below], 2 * place, depth + 1)
        right = grow(points[~below], 2 * place + 1, depth + 1)
        nodes[me] = (f, cut, left, right, len(points), depth)
        return me

    grow(x, 1, 0)
    return nodes


def fit_forest(samples: DataFrame, features: Sequence[str], seed: int = 42) -> DataFrame:
    """One row per tree node. A group is one tree's sample, at most `sample_size` rows."""
    features = list(features)

    def grown(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree_id"].iloc[0])
        x = np.nan_to_num(group[features].to_numpy(dtype=float))
        height = int(np.ceil(np.log2(max(len(x), 2))))
        nodes = grow_tree(x, lambda place: draws(seed, tree, place), height)
        out = pd.DataFrame(nodes, columns=["feature", "threshold", "left", "right", "size", "depth"])
        out.insert(0, "node_id", range(len(out)))
        out.insert(0, "tree_id", tree)
        return out

    return samples.select("tree_id", *features).groupBy("tree_id").applyInPandas(grown, NODES)


def expected_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points: c(n) of the paper."""
    n = np.asarray(n, dtype=float)
    m = np.maximum(n, 3.0)
    many = 2.0 * (np.log(m - 1.0) + np.euler_gamma) - 2.0 * (m - 1.0) / m
    return np.where(n > 2, many, np.where(n == 2, 1.0, 0.0))


def pack_forest(nodes: pd.DataFrame) -> dict:
    """Nodes of all trees in flat arrays. Children are interleaved: `child[2 * node + goes_right]`.

    A leaf points to itself, so every row can take the same number of steps.
    """
    nodes = nodes.sort_values(["tree_id", "node_id"]).reset_index(drop=True)
    starts = np.flatnonzero(nodes["node_id"].to_numpy() == 0)
    base = np.repeat(starts, np.diff(np.append(starts, len(nodes))))
    leaf = nodes["feature"].to_numpy() < 0
    own = np.arange(len(nodes))
    left = np.where(leaf, own, base + nodes["left"])
    right = np.where(leaf, own, base + nodes["right"])
    return {
        "starts": starts.astype(np.intp),
        "feature": np.where(leaf, 0, nodes["feature"]).astype(np.intp),
        "threshold": nodes["threshold"].to_numpy(dtype=float),
        "child": np.column_stack([left, right]).ravel().astype(np.intp),
        "path": nodes["depth"].to_numpy() + np.where(leaf, expected_path(nodes["size"]), 0.0),
        "height": int(nodes["depth"].max()),
        "norm": float(expected_path(np.array([nodes.loc[starts[0], "size"]]))[0]),
    }


def forest_scores(x: np.ndarray, forest: dict, block: int = 64) -> np.ndarray:
    """Score in (0, 1], higher is more unusual. A block of rows walks down all trees at once."""
    if forest["norm"] <= 0:
        return np.full(len(x), 0.5)
    mean = np.empty(len(x))
    for i in range(0, len(x), block):
        part = np.ascontiguousarray(x[i : i + block])
        row = (np.arange(len(part)) * x.shape[1])[:, None]
        at = np.broadcast_to(forest["starts"], (len(part), len(forest["starts"])))
        for _ in range(forest["height"]):
            value = part.ravel().take(row + forest["feature"].take(at, mode="clip"), mode="clip")
            right = value > forest["threshold"].take(at, mode="clip")
            at = forest["child"].take(2 * at + right, mode="clip")
        mean[i : i + block] = forest["path"].take(at).mean(axis=1)
    return np.exp2(-mean / forest["norm"])


def score_forest(
    rows: DataFrame, nodes: DataFrame, features: Sequence[str], decimals: int = 9
) -> DataFrame:
    """Append `anomaly_score`. Map-only, and only the features travel to Python.

    Scores are rounded, so that equal rows tie whatever the order in which paths are averaged.

    The model is gathered and broadcast: its size is bounded by the number of trees times twice
    the sample size, whatever the size of the data.
    """
    model = rows.sparkSession.sparkContext.broadcast(pack_forest(nodes.toPandas()))

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            yield pd.Series(forest_scores(np.nan_to_num(x), model.value))

    scored = score(*[F.col(f).cast("double") for f in features])
    return rows.withColumn("anomaly_score", F.round(scored, decimals))


def fit(
    rows: DataFrame, key: Sequence[str], features: Sequence[str], trees: int = 300, sample_size: int = 256, seed: int = 42
) -> DataFrame | None:
    """Nodes of a forest fitted on sub-samples of `rows`, None if there are none. `rows` is read twice: pass a stored table."""
    n = rows.count()
    return fit_forest(tree_samples(rows, key, n, trees, sample_size, seed), features, seed) if n else None


def isolation_forest(
    rows: DataFrame,
    key: Sequence[str],
    features: Sequence[str],
    trees: int = 300,
    sample_size: int = 256,
    seed: int = 42,
) -> DataFrame:
    """Fit on sub-samples of `rows` and score every row. `rows` is read three times: pass a stored table."""
    nodes = fit(rows, key, features, trees, sample_size, seed)
    if nodes is None:
        return rows.withColumn("anomaly_score", F.lit(None).cast("double"))
    return score_forest(rows, nodes, features)


# Changes when a stored node means something else.
VERSION = 1
MODEL = f"{NODES}, version int, features array<string>"


def write_model(nodes: DataFrame, path: str, features: Sequence[str]) -> None:
    """Replace a stored forest: its nodes, with the version of their form and the features in order, in one file."""
    named = F.array(*[F.lit(f) for f in features])
    model = nodes.withColumns({"version": F.lit(VERSION), "features": named})
    model.coalesce(1).write.mode("overwrite").parquet(path)


def read_model(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """(nodes, features) of a stored forest. Another version, or no node at all, is an error."""
    model = spark.read.schema(MODEL).parquet(path)
    kinds = model.select("version", "features").distinct().limit(2).collect()
    if len(kinds) != 1 or kinds[0]["version"] != VERSION:
        raise ValueError(f"no forest of version {VERSION} in {path}: {[k['version'] for k in kinds]}")
    return model.drop("version", "features"), list(kinds[0]["features"])


def score_with_model(rows: DataFrame, path: str) -> DataFrame:
    """Append `anomaly_score` by a stored forest. Nothing is fitted, so new rows get scores that compare with older ones."""
    nodes, features = read_model(rows.sparkSession, path)
    missing = [f for f in features if f not in rows.columns]
    if missing:
        raise ValueError(f"the stored forest needs {missing}")
    return score_forest(rows, nodes, features)
