"""Linear models and boosted trees over rows whose inputs a few small factors decide.

A factor is a field with few values, such as the day or the store. Its table has a row of
inputs for each of its codes, and a row's inputs are those of its codes, side by side. So a
row is a handful of codes, and what a pass over the rows has to sum is a count per code or
per pair of codes: tasks sum their blocks of rows, the sums are merged in a tree, and the
driver solves the small system or picks the splits. Blocks take some 30 bytes a row, and no
vector per row is made. The models are those of ``pyspark.ml`` with the same parameters;
boosted trees take their thresholds from all rows instead of a sample of 10,000.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Rows of a block.
BLOCK_ROWS = 1 << 18

# Smallest fitted mean, and the smallest mean that a fit starts from, as in Spark.
LEAST_MEAN = 1e-16
LEAST_START = 0.1


@dataclass(frozen=True)
class Table:
    """Inputs of a factor: one row per code, and the place of each column in the vector."""

    values: np.ndarray
    slots: np.ndarray


def width(tables: Sequence[Table]) -> int:
    return sum(len(t.slots) for t in tables)


def _plain_codes(factors: int) -> list[Column]:
    """Codes as plain columns, which reach Python many times faster than lists."""
    return [F.col("features")[k].alias(f"_code{k}") for k in range(factors)]


def _codes(batch: pa.RecordBatch, factors: int) -> np.ndarray:
    """One row per factor."""
    return np.stack([batch.column(f"_code{k}").to_numpy() for k in range(factors)]).astype(np.uint16)


def blocks(rows: DataFrame, factors: int, weight: str | None) -> RDD:
    """The rows as ``(codes, weight, label)`` arrays of about ``BLOCK_ROWS`` rows."""
    weights = F.col(weight) if weight else F.lit(1.0)
    plain = rows.select(
        *_plain_codes(factors), weights.cast("double").alias("weight"), F.col("label").cast("double").alias("label")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def packed():
            codes = np.concatenate([_codes(b, factors) for b in kept], axis=1)
            weight, label = (np.concatenate([b.column(c).to_numpy() for b in kept]) for c in ("weight", "label"))
            columns = [pa.array([a.tobytes()], pa.binary()) for a in (codes, weight, label)]
            return pa.RecordBatch.from_arrays(columns, ["codes", "weight", "label"])

        for batch in batches:
            if batch.num_rows:
                kept.append(batch)
            if sum(b.num_rows for b in kept) >= BLOCK_ROWS:
                yield packed()
                kept.clear()
        if kept:
            yield packed()

    table = plain.mapInArrow(pack, "codes binary, weight binary, label binary")
    return table.rdd.map(
        lambda r: (
            np.frombuffer(r["codes"], np.uint16).reshape(factors, -1),
            np.frombuffer(r["weight"], np.float64),
            np.frombuffer(r["label"], np.float64),
        )
    )


def _merged(parts: RDD, task) -> np.ndarray:
    """Sum of what ``task`` makes of each partition, merged in a tree of tasks."""
    found = parts.mapPartitions(lambda each: [a for a in (task(each),) if a is not None])
    return found.treeReduce(np.add)


# Linear models


def _eta(scores: Sequence[np.ndarray], codes: np.ndarray) -> np.ndarray:
    total = scores[0][codes[0]]
    for score, code in zip(scores[1:], codes[1:]):
        total = total + score[code]
    return total


def _mean(eta: np.ndarray, link: str) -> np.ndarray:
    return np.exp(eta) if link == "log" else eta


def _projected(mean: np.ndarray, family: str) -> np.ndarray:
    if family != "poisson":
        return mean
    return np.clip(mean, LEAST_MEAN, np.finfo(np.float64).max)


def _working(codes, weight, label, scores, family: str, link: str):
    """Weights and labels of the least squares step that improves on ``scores``."""
    if scores is None:
        mean = np.maximum(label, LEAST_START) if family == "poisson" else label
        return weight, np.log(mean) if link == "log" else mean
    eta = _eta(scores, codes)
    mean = _projected(_mean(eta, link), family)
    slope = 1.0 / mean if link == "log" else 1.0
    variance = mean if family == "poisson" else 1.0
    return weight / (slope**2 * variance), eta + (label - mean) * slope


def _square_sums(parts: RDD, tables: Sequence[Table], scores, family: str, link: str) -> np.ndarray:
    """Weighted sums of products of the inputs, one and the working label, as a square."""

    def task(each):
        values = [t.values for t in tables]
        sizes = [len(v) for v in values]
        pairs = {(a, b): np.zeros(sizes[a] * sizes[b]) for a in range(len(sizes)) for b in range(a)}
        ones, firsts = [np.zeros(n) for n in sizes], [np.zeros(n) for n in sizes]
        plain = np.zeros(3)
        for codes, weight, label in each:
            w, z = _working(codes, weight, label, scores, family, link)
            wz = w * z
            plain += w.sum(), wz.sum(), (wz * z).sum()
            for a, n in enumerate(sizes):
                ones[a] += np.bincount(codes[a], w, n)
                firsts[a] += np.bincount(codes[a], wz, n)
            for (a, b), sums in pairs.items():
                sums += np.bincount(codes[a].astype(np.int64) * sizes[b] + codes[b], w, len(sums))
        if not plain[0]:
            return None
        starts = np.cumsum([0, *[v.shape[1] for v in values]])
        n = starts[-1]
        square = np.zeros((n + 2, n + 2))
        for a, v in enumerate(values):
            own = slice(starts[a], starts[a + 1])
            square[own, own] = v.T @ (ones[a][:, None] * v)
            square[n, own] = square[own, n] = ones[a] @ v
            square[n + 1, own] = square[own, n + 1] = firsts[a] @ v
        for (a, b), sums in pairs.items():
            first, second = slice(starts[a], starts[a + 1]), slice(starts[b], starts[b + 1])
            square[first, second] = values[a].T @ (sums.reshape(sizes[a], sizes[b]) @ values[b])
            square[second, first] = square[first, second].T
        square[n:, n:] = [[plain[0], plain[1]], [plain[1], plain[2]]]
        return square

    return _merged(parts, task)


def _solved(square: np.ndarray, penalty: float, intercept: bool, standardized: bool) -> np.ndarray:
    """Weights of the inputs and the intercept. Inputs that do not vary weigh nothing, as in
    Spark; of weights that fit equally well the shortest are taken."""
    n = len(square) - 2
    means = square / square[n, n]
    bar, target = means[n, :n], means[n, n + 1]
    spread = np.sqrt(np.maximum(np.diag(means)[:n] - bar**2, 0.0))
    # of inputs that are all alike, rounding leaves a little
    varies = spread > 1e-9 * np.maximum(np.abs(bar), 1e-300)
    label_spread = np.sqrt(max(means[n + 1, n + 1] - target**2, 0.0)) or 1.0
    scale = np.where(varies, spread, 1.0)
    products, cross = means[:n, :n], means[:n, n + 1]
    if intercept:
        products, cross = products - np.outer(bar, bar), cross - bar * target
    products = (products / np.outer(scale, scale))[np.ix_(varies, varies)]
    cross = (cross / scale)[varies]
    penalties = penalty / label_spread if standardized else penalty / scale[varies] ** 2
    products = products + np.diag(np.broadcast_to(penalties, len(products)))
    weights = np.zeros(n)
    weights[varies] = np.linalg.lstsq(products, cross, rcond=1e-13)[0]
    weights = weights / scale
    return np.append(weights, target - bar @ weights if intercept else 0.0)


def _fit_linear(parts: RDD, tables: Sequence[Table], like: GeneralizedLinearRegression) -> dict:
    family, link, penalty = like.getFamily(), _link(like), like.getRegParam()
    if family not in ("gaussian", "poisson") or link not in ("identity", "log") or (family, link) == ("gaussian", "log"):
        raise ValueError(f"no factored model of family {family} with link {link}")
    with_intercept = like.getFitIntercept()

    def scores(found):
        cuts = np.split(found[:-1], np.cumsum([len(t.slots) for t in tables])[:-1])
        own = [t.values @ w for t, w in zip(tables, cuts)]
        return [own[0] + found[-1], *own[1:]]

    found = _solved(_square_sums(parts, tables, None, family, link), penalty, with_intercept, standardized=True)
    passes = 0 if family == "gaussian" else like.getMaxIter()
    for _ in range(passes):
        before = found
        sums = _square_sums(parts, tables, scores(before), family, link)
        found = _solved(sums, penalty, with_intercept, standardized=False)
        if np.abs(found - before).max() < like.getTol():
            break
    weights = np.zeros(width(tables))
    weights[np.concatenate([t.slots for t in tables])] = found[:-1]
    return {
        "kind": "linear",
        "family": family,
        "link": link,
        "coefficients": weights.tolist(),
        "intercept": float(found[-1]),
        "scores": [s.tolist() for s in scores(found)],
    }


def _link(like: GeneralizedLinearRegression) -> str:
    return like.getLink() if like.isDefined("link") else {"gaussian": "identity", "poisson": "log"}[like.getFamily()]


# Boosted trees


@dataclass(frozen=True)
class Splits:
    """Every split that is tried, ordered by input and threshold: its factor, input (as a
    column of that factor's table), threshold, and which codes go left."""

    factor: np.ndarray
    column: np.ndarray
    threshold: np.ndarray
    left: list[np.ndarray]


def _thresholds(values: np.ndarray, counts: np.ndarray, most: int) -> list[float]:
    """Spark's rule: every midpoint of neighbouring values, or ``most`` of about equal steps."""
    values, places = np.unique(values[counts > 0], return_inverse=True)
    counts = np.bincount(places, counts[counts > 0])
    middles = (values[:-1] + values[1:]) / 2
    if len(middles) <= most:
        return middles.tolist()
    step = counts.sum() / (most + 1)
    found, wanted, sums = [], step, np.cumsum(counts)
    for i in range(1, len(values)):
        if abs(sums[i - 1] - wanted) < abs(sums[i] - wanted):
            found.append(float(middles[i - 1]))
            wanted += step
    return found


def _splits(parts: RDD, tables: Sequence[Table], most_bins: int) -> Splits:
    sizes = [len(t.values) for t in tables]

    def task(each):
        counts = np.zeros(sum(sizes) + 1)
        for codes, weight, _ in each:
            counts += np.append(np.concatenate([np.bincount(c, weight, n) for c, n in zip(codes, sizes)]), len(weight))
        return counts

    found = _merged(parts, task)
    counts = np.split(found[:-1], np.cumsum(sizes)[:-1])
    most = min(most_bins, int(found[-1])) - 1
    tried = sorted(
        (int(t.slots[j]), cut, a, j)
        for a, t in enumerate(tables)
        for j in range(len(t.slots))
        for cut in _thresholds(t.values[:, j], counts[a], most)
    )
    left = [
        np.array([tables[a].values[:, j] <= cut for _, cut, own, j in tried if own == a], float).reshape(-1, sizes[a]).T
        for a in range(len(tables))
    ]
    factor, column, threshold = (np.array([t[i] for t in tried], dtype=kind) for i, kind in ((2, int), (3, int), (1, float)))
    return Splits(factor, column, threshold, left)


def _reached(tree: dict, tables: Sequence[Table], codes: np.ndarray) -> np.ndarray:
    """The node each row stands at, as far as the tree has grown."""
    factor, column, threshold, first = (np.asarray(tree[k]) for k in ("factor", "column", "threshold", "child"))
    inner = np.flatnonzero(first >= 0)
    at = np.zeros(codes.shape[1], np.int32)
    if not len(inner):
        return at
    right = np.zeros((len(first), max(len(t.values) for t in tables)), bool)
    for node in inner:
        values = tables[factor[node]].values[:, column[node]]
        right[node, : len(values)] = values > threshold[node]
    # a leaf leads to itself: its rows never go right
    step = np.where(first >= 0, first, np.arange(len(first))).astype(np.int32)
    own, rows, flat = np.maximum(factor, 0), np.arange(codes.shape[1]), right.ravel()
    for _ in range(tree["depth"]):
        code = codes[own[at], rows]
        at = step[at] + flat[at.astype(np.int64) * right.shape[1] + code]
    return at


def _split_sums(parts: RDD, tables, splits: Splits, tree: dict, open_nodes: list[int]) -> np.ndarray:
    """Per open node: weight and weighted target of all its rows, then of the rows that each
    split would send left."""
    sizes = [len(t.values) for t in tables]
    order = np.argsort(np.concatenate([np.flatnonzero(splits.factor == a) for a in range(len(tables))]))

    def task(each):
        sums = [np.zeros((2, len(open_nodes) * n)) for n in sizes]
        place = np.full(len(tree["child"]), -1, np.int64)
        place[open_nodes] = np.arange(len(open_nodes))
        for codes, weight, target in each:
            if len(place) == 1:
                own = np.zeros(len(weight), np.int64)
            else:
                own = place[_reached(tree, tables, codes)]
                rows = np.flatnonzero(own >= 0)
                if len(rows) < len(own):
                    own, codes, weight, target = own[rows], codes[:, rows], weight[rows], target[rows]
            weighted = weight * target
            for a, n in enumerate(sizes):
                key = own * n + codes[a]
                sums[a][0] += np.bincount(key, weight, sums[a].shape[1])
                sums[a][1] += np.bincount(key, weighted, sums[a].shape[1])
        shaped = [s.reshape(2, len(open_nodes), n) for s, n in zip(sums, sizes)]
        left = np.concatenate([s @ splits.left[a] for a, s in enumerate(shaped)], axis=2)[:, :, order]
        return np.concatenate([shaped[0].sum(axis=2, keepdims=True), left], axis=2)

    return _merged(parts, task)


def _grown(parts: RDD, tables, splits: Splits, max_depth: int) -> dict:
    """A regression tree by levels. Node 0 is the root; ``child`` is the left child, whose
    neighbour is the right one, or -1."""
    tree = {"factor": [-1], "column": [-1], "threshold": [0.0], "child": [-1], "prediction": [0.0], "depth": 0}
    open_nodes = [0]
    for level in range(max_depth):
        weight, total = _split_sums(parts, tables, splits, tree, open_nodes)
        if level == 0:
            tree["prediction"][0] = float(total[0, 0] / weight[0, 0])
        grown = []
        for i, node in enumerate(open_nodes):
            w, s, wl, sl = weight[i, 0], total[i, 0], weight[i, 1:], total[i, 1:]
            wr, sr = w - wl, s - sl
            # weights are sums of whole numbers or of few others: less than this is none
            valid = (wl > 1e-9 * w) & (wr > 1e-9 * w)
            if not valid.any():
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(valid, sl**2 / wl + sr**2 / wr - s**2 / w, -np.inf)
            best = int(np.argmax(gain))
            if gain[best] <= 1e-12 * (s**2 / w):
                continue
            first = len(tree["child"])
            tree["factor"][node], tree["column"][node] = int(splits.factor[best]), int(splits.column[best])
            tree["threshold"][node], tree["child"][node] = float(splits.threshold[best]), first
            for weight_of, sum_of in ((wl, sl), (wr, sr)):
                for name, value in (("factor", -1), ("column", -1), ("threshold", 0.0), ("child", -1)):
                    tree[name].append(value)
                tree["prediction"].append(float(sum_of[best] / weight_of[best]))
            grown += [first, first + 1]
        if not grown:
            break
        tree["depth"], open_nodes = level + 1, grown
    return tree


def _fit_trees(parts: RDD, tables: Sequence[Table], like: GBTRegressor) -> dict:
    """Squared-loss boosting: each tree after the first is fitted to twice the residuals."""
    if like.getLossType() != "squared" or like.getSubsamplingRate() != 1.0 or like.getFeatureSubsetStrategy() != "all":
        raise ValueError("factored trees take all rows, all inputs and squared loss")
    if like.getMinInstancesPerNode() != 1 or like.getMinWeightFractionPerNode() or like.getMinInfoGain():
        raise ValueError("factored trees have no least size or gain of a node")
    splits = _splits(parts, tables, like.getMaxBins())
    step, trees, held = like.getStepSize(), [], parts
    try:
        for m in range(like.getMaxIter()):
            tree = _grown(held, tables, splits, like.getMaxDepth())
            trees.append(tree)
            if m + 1 == like.getMaxIter():
                break
            first = m == 0

            def rest(block, tree=tree, first=first):
                codes, weight, target = block
                predicted = np.asarray(tree["prediction"])[_reached(tree, tables, codes)]
                left = target - predicted if first else target / 2 - step * predicted
                return codes, weight, 2 * left

            following = held.map(rest).persist(StorageLevel.MEMORY_AND_DISK)
            following.count()
            if held is not parts:
                held.unpersist()
            held = following
    finally:
        if held is not parts:
            held.unpersist()
    return {
        "kind": "trees",
        "trees": trees,
        "weights": [1.0] + [step] * (len(trees) - 1),
        "tables": [{"values": t.values.tolist(), "slots": t.slots.tolist()} for t in tables],
    }


# Estimator and model


def _predictor(found: dict):
    """Predictions of codes."""
    if found["kind"] == "linear":
        scores = [np.asarray(s) for s in found["scores"]]
        return lambda codes: _projected(_mean(_eta(scores, codes), found["link"]), found["family"])
    tables = [Table(np.asarray(t["values"], float).reshape(len(t["values"]), -1), np.asarray(t["slots"])) for t in found["tables"]]

    def predicted(codes):
        total = np.zeros(codes.shape[1])
        for weight, tree in zip(found["weights"], found["trees"]):
            total += weight * np.asarray(tree["prediction"])[_reached(tree, tables, codes)]
        return total

    return predicted


class FactoredModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted model; adds ``prediction`` to rows with codes in ``features``."""

    found = Param(Params._dummy(), "found", "the fitted model as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, found: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def parameters(self) -> dict:
        return json.loads(self.getOrDefault("found"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        text, found, names = self.getOrDefault("found"), self.parameters(), dataset.columns
        factors = len(found["scores"] if found["kind"] == "linear" else found["tables"])

        def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            predictor = _predictor(json.loads(text))
            for batch in batches:
                if batch.num_rows:
                    column = pa.array(predictor(_codes(batch, factors)), pa.float64())
                    yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], column], [*names, "prediction"])

        schema = T.StructType([*dataset.schema.fields, T.StructField("prediction", T.DoubleType())])
        return dataset.select(*names, *_plain_codes(factors)).mapInArrow(predict, schema)


class FactoredRegressor(Estimator):
    """Fits the model that ``like``, an estimator of Spark, describes, on rows with codes in
    ``features``. Parameters are those of ``like``."""

    def __init__(self, like: Estimator, tables: Sequence[Table]):
        super().__init__()
        self.like, self.tables = like, list(tables)

    def getParam(self, paramName: str) -> Param:
        return self.like.getParam(paramName)

    def copy(self, extra=None) -> FactoredRegressor:
        return FactoredRegressor(self.like.copy(extra), self.tables)

    def _fit(self, dataset: DataFrame) -> FactoredModel:
        weight = self.like.getWeightCol() if self.like.isDefined("weightCol") else None
        fit = _fit_trees if isinstance(self.like, GBTRegressor) else _fit_linear
        parts = blocks(dataset, len(self.tables), weight).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return FactoredModel(found=json.dumps(fit(parts, self.tables, self.like)))
        finally:
            parts.unpersist()
