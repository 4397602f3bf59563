"""Bagged regression forests grown from binned columns (M6).

Spark's ``RandomForestRegressor`` walks each row through each tree as an
object; most of a fit's time goes there.  Here the rows are binned once, into
written chunks of one byte a feature, and each level of all trees is one pass
over the chunks: array operations add up counts, sums and sums of squares by
tree, node, feature and bin.  The rules are Spark's: thresholds from
``max(maxBins^2, 10000)`` sampled rows, Poisson(1) draws by row and tree, a
random subset of features a node, the split that lowers the variance most.  The
result is an ordinary ``RandomForestRegressionModel``, read from its saved form.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.session import scratch_path

#: Rows of a chunk.
CHUNK = 32_768
#: Deepest tree and largest number of features times bins for which the sums by node are held in a task.
MOST_DEPTH, MOST_CELLS = 10, 65_536
#: Poisson(1) by the first 16 random bits, where they decide; the others are drawn again with 53.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])
_LOW = np.searchsorted(_POISSON, np.arange(65_536) / 65_536, side="right").astype(np.uint8)
_OPEN = _LOW != np.searchsorted(_POISSON, np.arange(1, 65_537) / 65_536, side="left")


def poisson_draws(seed: tuple[int, ...], trees: int, n: int) -> np.ndarray:
    """How often each tree draws each of n rows: Poisson(1), the same for a seed."""
    rng = np.random.default_rng(seed)
    first = rng.integers(0, 65_536, size=(trees, n), dtype=np.uint16)
    out = _LOW[first]
    rest = np.flatnonzero(_OPEN[first])
    fine = (first.ravel()[rest] + rng.random(len(rest))) / 65_536
    out.ravel()[rest] = np.searchsorted(_POISSON, fine, side="right")
    return out


def thresholds(values: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` thresholds: between all neighbouring values, or about evenly by their counts."""
    values, n = np.unique(values, return_counts=True)
    if len(values) - 1 <= most:
        return (values[1:] + values[:-1]) / 2
    stride, upto, out = n.sum() / (most + 1), n[0], []
    target = stride
    for k in range(1, len(values)):
        before, upto = upto, upto + n[k]
        if abs(before - target) < abs(upto - target):
            out.append((values[k - 1] + values[k]) / 2)
            target += stride
    return np.array(out)


def _binned(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """(part, chunk, n, bins, y): chunks of rows in order, features one after the other, a byte a bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk = TaskContext.get().partitionId(), 0
        xs, ys, held = [], [], 0

        def flush() -> pa.RecordBatch:
            x, y = np.concatenate(xs), np.concatenate(ys)
            bins = np.stack([np.searchsorted(c, x[:, i], side="left").astype(np.uint8) for i, c in enumerate(cuts)])
            return pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([chunk]), pa.array([len(y)]), pa.array([bins.tobytes()], pa.binary()),
                 pa.array([y.tobytes()], pa.binary())], names=["part", "chunk", "n", "bins", "y"])

        for batch in batches:
            for low in range(0, batch.num_rows, CHUNK):
                piece = batch.slice(low, CHUNK)
                if held and held + piece.num_rows > CHUNK:
                    yield flush()
                    xs, ys, held, chunk = [], [], 0, chunk + 1
                xs.append(piece.column(0).flatten().to_numpy().reshape(piece.num_rows, len(cuts)))
                ys.append(piece.column(1).to_numpy())
                held += piece.num_rows
        if held:
            yield flush()

    return rows.mapInArrow(run, "part bigint, chunk bigint, n bigint, bins binary, y binary")


def _places(bins: np.ndarray, n: int, row: np.ndarray, depth: int, split: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Nodes of a depth that the rows reach in a tree; below a leaf, any of its own."""
    first, at = np.maximum(split, 0) * n, np.zeros(len(row), dtype=np.int64)
    for _ in range(depth):
        right = bins.take(first.take(at) + row) > cut.take(at)
        at += at
        at += right
        at += 1
    return at - ((1 << depth) - 1)


def _sums(chunks: DataFrame, run, trees: int, length: int, seed: int) -> np.ndarray:
    """(trees, length): what ``run`` adds up over all chunks, by tree."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((trees, length))
        for batch in batches:
            for part, chunk, n, bins, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                bins, y = np.frombuffer(bins, dtype=np.uint8), np.frombuffer(y)
                drawn = poisson_draws((seed, part, chunk), trees, n)
                for t in range(trees):
                    row = np.flatnonzero(drawn[t])
                    run(sums[t], t, bins, n, row, drawn[t].take(row).astype(float), y.take(row))
        task = TaskContext.get().partitionId()
        for t in range(trees):
            yield pa.RecordBatch.from_arrays([pa.array([t]), pa.array([task]), pa.array([sums[t].tobytes()], pa.binary())],
                                             names=["t", "task", "sums"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("task")  # rounding doesn't depend on which task was first
        total = sum(np.frombuffer(x) for x in table["sums"].to_pylist())
        return pa.table({"t": table["t"][:1], "sums": pa.array([total.tobytes()], pa.binary())})

    found = chunks.mapInArrow(each, "t bigint, task bigint, sums binary").groupBy("t").applyInArrow(add, "t bigint, sums binary")
    out = np.zeros((trees, length))
    for r in found.toLocalIterator():
        out[r["t"]] = np.frombuffer(r["sums"])
    return out


def _level_sums(chunks: DataFrame, split: np.ndarray, cut: np.ndarray, chosen: np.ndarray, width: int, seed: int) -> np.ndarray:
    """(trees, nodes, features looked at, bins, 2): count and sum of the label in a level's open nodes."""
    trees, nodes, looked = chosen.shape
    level, cells = nodes.bit_length() - 1, looked * width
    sent = chunks.sparkSession.sparkContext.broadcast((split, cut, chosen))

    def run(sums: np.ndarray, t: int, bins: np.ndarray, n: int, row: np.ndarray, w: np.ndarray, y: np.ndarray) -> None:
        split, cut, chosen = sent.value
        node = _places(bins, n, row, level, split[t], cut[t])
        alive = (chosen[t, :, 0] >= 0).take(node)
        if not alive.all():
            row, node, w, y = row[alive], node[alive], w[alive], y[alive]
        wy, count, total = w * y, sums[: nodes * cells], sums[nodes * cells :]
        for j in range(looked):
            place = bins.take((chosen[t, :, j] * n).take(node) + row) + (np.arange(nodes) * cells + j * width).take(node)
            count += np.bincount(place, w, minlength=nodes * cells)
            total += np.bincount(place, wy, minlength=nodes * cells)

    out = _sums(chunks, run, trees, 2 * nodes * cells, seed).reshape(trees, 2, nodes, looked, width)
    sent.destroy()
    return np.moveaxis(out, 1, 4)


def _squares(chunks: DataFrame, split: np.ndarray, cut: np.ndarray, depth: int, seed: int) -> np.ndarray:
    """(trees, nodes): sums of the label's squares, of all nodes from those of the last level."""
    trees, size = split.shape
    last = 1 << depth
    sent = chunks.sparkSession.sparkContext.broadcast((split, cut))

    def run(sums: np.ndarray, t: int, bins: np.ndarray, n: int, row: np.ndarray, w: np.ndarray, y: np.ndarray) -> None:
        split, cut = sent.value
        sums += np.bincount(_places(bins, n, row, depth, split[t], cut[t]), w * y * y, minlength=last)

    out = np.zeros((trees, size))
    out[:, last - 1 :] = _sums(chunks, run, trees, last, seed)
    sent.destroy()
    for at in range(last - 2, -1, -1):
        out[:, at] = out[:, 2 * at + 1] + out[:, 2 * at + 2]
    return out


class BinnedForestRegressor(RandomForestRegressor):
    """``RandomForestRegressor`` whose bagged forests are grown by passes over binned chunks."""

    def _looked(self, features: int) -> int | None:
        return {"auto": -(-features // 3), "onethird": -(-features // 3), "all": features, "sqrt": math.ceil(math.sqrt(features)),
                "log2": max(1, math.ceil(math.log2(features)))}.get(self.getFeatureSubsetStrategy())

    def _fit(self, dataset: DataFrame):
        nominal = "nominal" in json.dumps(dataset.schema[self.getFeaturesCol()].metadata)
        first = dataset.select(vector_to_array(F.col(self.getFeaturesCol()))).first()
        looked = self._looked(len(first[0])) if first else None
        if (not looked or nominal or not self.getBootstrap() or self.getNumTrees() < 2 or self.getSubsamplingRate() != 1.0
                or self.isSet(self.weightCol) or self.getMinWeightFractionPerNode() or self.getMaxDepth() > MOST_DEPTH
                or self.getMaxBins() > 256 or looked * self.getMaxBins() << self.getMaxDepth() > MOST_CELLS * 16):
            return super()._fit(dataset)
        return _model(dataset.sparkSession, self, self._grown(dataset, len(first[0]), looked), len(first[0]))

    def _grown(self, dataset: DataFrame, features: int, looked: int) -> list[list[dict]]:
        spark, depth, trees, seed = dataset.sparkSession, self.getMaxDepth(), self.getNumTrees(), abs(self.getSeed())
        rows = dataset.select(vector_to_array(F.col(self.getFeaturesCol())).alias("x"),
                              F.col(self.getLabelCol()).cast("double").alias("y"))
        n = rows.count()
        wanted = max(self.getMaxBins() ** 2, 10_000)
        sample = rows if n <= wanted else rows.sample(False, wanted / n, seed)
        sample = np.array(sample.select("x").toArrow()["x"].to_pylist()).reshape(-1, features)
        cuts = [thresholds(sample[:, i], min(self.getMaxBins(), n) - 1) for i in range(features)]
        path = scratch_path(spark, "chunks")
        _binned(rows, cuts).write.parquet(path)
        chunks = spark.read.schema("part bigint, chunk bigint, n bigint, bins binary, y binary").parquet(path)
        width = max(len(c) for c in cuts) + 1
        size = (2 << depth) - 1
        split, cut = np.full((trees, size), -1, dtype=np.int64), np.zeros((trees, size), dtype=np.int64)
        stats, gain = np.zeros((trees, size, 2)), np.full((trees, size), -1.0)
        rng = np.random.default_rng(seed)
        is_open = np.zeros((trees, size), dtype=bool)
        is_open[:, 0] = True
        usable = np.arange(width) < np.array([len(c) for c in cuts])[:, None]
        for level in range(max(depth, 1)):
            nodes, low = 1 << level, (1 << level) - 1
            chosen = np.argsort(rng.random((trees, nodes, features)), axis=2)[:, :, :looked]
            chosen[~is_open[:, low:low + nodes]] = -1
            if not (chosen >= 0).any():
                break
            sums = _level_sums(chunks, split, cut, chosen, width, seed)
            whole = sums[:, :, 0].sum(axis=2)  # (trees, nodes, 2)
            if level == 0:
                stats[:, 0] = whole[:, 0]
            left = sums.cumsum(axis=3)
            right = whole[:, :, None, None] - left
            with np.errstate(divide="ignore", invalid="ignore"):
                better = (left[..., 1] ** 2 / left[..., 0] + right[..., 1] ** 2 / right[..., 0]
                          - (whole[..., 1] ** 2 / whole[..., 0])[:, :, None, None]) / whole[..., 0][:, :, None, None]
            least = max(self.getMinInstancesPerNode(), 1)
            good = (left[..., 0] >= least) & (right[..., 0] >= least) & usable[chosen] & (chosen >= 0)[..., None]
            better = np.where(good & (better >= self.getMinInfoGain()) & (better > 0), better, -1.0).reshape(trees, nodes, -1)
            best = better.argmax(axis=2)
            for t, node in zip(*np.nonzero(better.max(axis=2) > 0), strict=True) if depth else ():
                at, j, b = low + node, best[t, node] // width, best[t, node] % width
                split[t, at], cut[t, at], gain[t, at] = chosen[t, node, j], b, better[t, node, best[t, node]]
                stats[t, 2 * at + 1], stats[t, 2 * at + 2] = left[t, node, j, b], right[t, node, j, b]
                is_open[t, 2 * at + 1] = is_open[t, 2 * at + 2] = level + 1 < depth
        stats = np.dstack([stats, _squares(chunks, split, cut, depth, seed)])
        return [_nodes(split[t], cut[t], stats[t], gain[t], cuts) for t in range(trees)]


def _nodes(split: np.ndarray, cut: np.ndarray, stats: np.ndarray, gain: np.ndarray, cuts: list[np.ndarray]) -> list[dict]:
    """A tree's nodes as Spark saves them: a node, its left side, its right side."""
    out: list[dict] = []

    def add(at: int) -> int:
        n, s, q = (float(x) for x in stats[at])
        node = {"id": len(out), "prediction": s / n if n else 0.0, "impurity": max(q / n - (s / n) ** 2, 0.0) if n else 0.0,
                "impurityStats": [n, s, q], "rawCount": int(n), "gain": float(gain[at]), "leftChild": -1, "rightChild": -1,
                "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}}
        out.append(node)
        if split[at] >= 0:
            feature = int(split[at])
            node["split"] = {"featureIndex": feature, "leftCategoriesOrThreshold": [float(cuts[feature][cut[at]])], "numCategories": -1}
            node["leftChild"], node["rightChild"] = add(2 * at + 1), add(2 * at + 2)
        return node["id"]

    add(0)
    return out


_NODE = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
         "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, "
         "numCategories: int>>")


def _model(spark: SparkSession, forest: RandomForestRegressor, trees: list[list[dict]], features: int) -> RandomForestRegressionModel:
    path = scratch_path(spark, "forest")
    own = {p.name: v for p, v in forest._paramMap.items()}
    default = {p.name: v for p, v in forest._defaultParamMap.items()}
    head = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
    for_tree = {"bootstrap", "featureSubsetStrategy", "numTrees", "subsamplingRate"}
    one = {k: {x: y for x, y in v.items() if x not in for_tree} for k, v in (("paramMap", own), ("defaultParamMap", default))}
    kind = "org.apache.spark.ml.regression."
    whole = {"class": kind + "RandomForestRegressionModel", **head, "uid": forest.uid, "paramMap": own, "defaultParamMap": default,
             "numFeatures": features, "numTrees": len(trees)}
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(path + "/metadata")
    each = [(t, json.dumps({"class": kind + "DecisionTreeRegressionModel", **head, "uid": f"{forest.uid}_{t}", **one}), 1.0)
            for t in range(len(trees))]
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(path + "/treesMetadata")
    rows = [(t, node) for t, tree in enumerate(trees) for node in tree]
    spark.createDataFrame(rows, _NODE).coalesce(1).write.parquet(path + "/data")
    return RandomForestRegressionModel.load(path)
