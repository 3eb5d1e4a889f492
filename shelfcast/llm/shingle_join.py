"""N-gram Jaccard join with signature trees.

Documents that may be similar are brought together by bands of minimum hashes. In each
group the documents hang in a tree: leaves hold bitmaps of shingles and set sizes, inner
nodes the OR of the bitmaps and the range of sizes. Two nodes are followed down together
only while the largest overlap that their bitmaps and sizes allow reaches the threshold;
pairs that are left at the leaves are compared exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.common import connected_components, documents, each_batch, key_groups, stage

WORDS = 5
PERCENT = 75
# A pair at the threshold shares none of the bands with a chance of 1e-8, a more similar
# one with less.
BANDS = 48
IN_BAND = 4
# Documents of a group that a task compares with as many others.
BLOCK = 2048
LEAF = 32
BITS = 1024

U = np.uint64
_DRAW = np.random.default_rng(5)
_BYTE = _DRAW.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_BASE = U(0x9E3779B97F4A7C15)
_BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_PLACE = _DRAW.integers(1, 2**63, WORDS, dtype=np.uint64) * U(2) + U(1)
_MULTIPLY = (_DRAW.integers(1, 2**31, BANDS * IN_BAND, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_BAND_MIX = _DRAW.integers(1, 2**63, (BANDS, IN_BAND), dtype=np.uint64) * U(2) + U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(32))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, A-Z lower-cased, all at once."""
    raw = np.frombuffer(text, np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    space = _SPACE[raw]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    start, end = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
    if not len(start):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(raw))
    total = np.concatenate([[U(0)], np.cumsum(_BYTE[_LOWER[raw]] * power, dtype=np.uint64)])
    return mixed((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


_KNOWN = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int):
    if len(_KNOWN[0]) < n:
        size = 1 << int(n).bit_length()
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            row = np.full(size, base, np.uint64)
            row[0] = U(1)
            _KNOWN[k] = np.cumprod(row, dtype=np.uint64)
    return _KNOWN[0][:n], _KNOWN[1][: n + 1]


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's five-word shingles; fewer words make one."""
    words = word_hashes((text or "").encode())
    if not len(words):
        return words
    if len(words) < WORDS:
        return mixed((words * _PLACE[: len(words)]).sum(keepdims=True, dtype=np.uint64) + U(len(words)))
    n = len(words) - WORDS + 1
    total = sum(words[k : k + n] * _PLACE[k] for k in range(WORDS))
    return np.unique(mixed(total + U(WORDS)))


def bands(hashes: np.ndarray) -> np.ndarray:
    low = (hashes >> U(32)).astype(np.uint32)[None, :]
    least = (low * _MULTIPLY).min(axis=1).astype(np.uint64).reshape(BANDS, IN_BAND)
    return mixed((least * _BAND_MIX).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``row``, ``n_shingles``, ``set_a`` and ``set_b`` (a 128-bit name of the
    set) and ``bands`` of every document."""

    def work(batch):
        sizes, first, second, keys = [], [], [], []
        for text in batch["text"].to_pylist():
            found = shingles(text)
            sizes.append(len(found))
            first.append(int(mixed(found).sum(dtype=np.uint64).astype(np.int64)))
            second.append(int(mixed(found ^ _BASE).sum(dtype=np.uint64).astype(np.int64)))
            keys.append(bands(found) if len(found) else None)
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"], batch["row"], pa.array(sizes, pa.int64()), pa.array(first, pa.int64()),
                pa.array(second, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
            ],
            ["doc_id", "row", "n_shingles", "set_a", "set_b", "bands"],
        )

    kind = "doc_id long, row long, n_shingles long, set_a long, set_b long, bands array<long>"
    return each_batch(docs.select("doc_id", "row", "text"), work, kind)


class Tree:
    """Signature tree over sets in a given order; level 0 are the leaves."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = len(sets)
        self.size = np.array([len(s) for s in sets])
        self.bits = np.zeros((self.n, BITS), bool)
        for k, s in enumerate(sets):
            self.bits[k, (s % U(BITS)).astype(np.int64)] = True
        # elements beyond the first under each bit: an overlap counts bits, plus these at most
        self.slack = self.size - self.bits.sum(1)
        starts = np.arange(0, self.n, LEAF)
        level = (
            np.logical_or.reduceat(self.bits, starts),
            np.minimum.reduceat(self.size, starts),
            np.maximum.reduceat(self.size, starts),
            np.maximum.reduceat(self.slack, starts),
        )
        self.levels = [level]
        while len(level[0]) > 1:
            starts = np.arange(0, len(level[0]), 2)
            level = (
                np.logical_or.reduceat(level[0], starts),
                np.minimum.reduceat(level[1], starts),
                np.maximum.reduceat(level[2], starts),
                np.maximum.reduceat(level[3], starts),
            )
            self.levels.append(level)

    def span(self, level: int, node: int) -> tuple[int, int]:
        width = LEAF << level
        return node * width, min(self.n, (node + 1) * width)

    def may_reach(self, level: int, a: int, b: int, percent: int) -> bool:
        """Whether a document of node ``a`` and one of ``b`` can be similar enough."""
        bits, least, most, slack = self.levels[level]
        if 100 * most[a] < percent * least[b] or 100 * most[b] < percent * least[a]:
            return False
        overlap = np.count_nonzero(bits[a] & bits[b]) + min(slack[a], slack[b])
        return (100 + percent) * overlap >= percent * (least[a] + least[b])


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def classes(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Number of the class of each set: sets linked directly or over others share one.

    A pair is compared unless the tree rules it out or both are in one class already.
    """
    order = sorted(range(len(sets)), key=lambda k: (int(sets[k][0]), len(sets[k]), k))
    sets = [sets[k] for k in order]
    label = np.arange(len(sets))

    def join(i, j):
        if label[i] != label[j] and similar(sets[i], sets[j], percent):
            label[label == label[j]] = label[i]

    for i in range(len(sets) - 1):
        join(i, i + 1)
    tree = Tree(sets)
    flat = tree.bits.astype(np.float32)
    stack = [(len(tree.levels) - 1, 0, 0)]
    while stack:
        level, a, b = stack.pop()
        (a0, a1), (b0, b1) = tree.span(level, a), tree.span(level, b)
        if (label[a0:a1] == label[a0]).all() and (label[b0:b1] == label[a0]).all():
            continue
        if not tree.may_reach(level, a, b, percent):
            continue
        if level:
            below = len(tree.levels[level - 1][0])
            left = [k for k in (2 * a, 2 * a + 1) if k < below]
            right = [k for k in (2 * b, 2 * b + 1) if k < below]
            stack += [(level - 1, x, y) for x in left for y in right if x <= y]
            continue
        overlap = flat[a0:a1] @ flat[b0:b1].T
        overlap += np.minimum(tree.slack[a0:a1, None], tree.slack[b0:b1])
        needed = percent * (tree.size[a0:a1, None] + tree.size[b0:b1])
        open_ = ((100 + percent) * overlap >= needed) & (label[a0:a1, None] != label[b0:b1])
        for i, j in zip(*np.nonzero(open_)):
            join(a0 + i, b0 + j)
    out = np.empty(len(sets), np.int64)
    out[order] = label
    return out


def _linked(group: pa.Table, percent: int) -> pa.RecordBatch:
    """Of one group: every document and the smallest name of its class there."""
    ids = group["rep"].to_numpy()
    found = classes([shingles(t) for t in group["text"].to_pylist()], percent)
    least = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(least, found, ids)
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(least[found])], ["rep", "root"])


def join(docs: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs``.

    Two documents link when the Jaccard similarity of their sets of five-word shingles
    reaches ``percent``. A text without words, or null, has no set and links with nothing;
    one with fewer than five words has one shingle. Equal sets are merged before anything
    is compared. Repeated rows of an id count as rows with that id: each links by its own
    text, and a component is called by the smallest id of its rows. A null id is a row of
    its own, without links, and has a null component. Other columns are not read.

    Groups of candidates are cut into blocks of ``block`` sets; every pair of blocks is one
    task's work, so a third of all documents in one group is spread over many.
    """
    return _joined(docs, percent, block).drop("row")


def _named(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row``, a name that rows share only if id and text are the same."""
    return docs.withColumn("row", F.xxhash64("doc_id", "text"))


def _joined(docs: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """What ``join`` gives, and the ``row`` it belongs to."""
    docs = _named(docs.select("doc_id", "text"))
    sketch = stage(sketches(docs), "sketches")
    named = ["n_shingles", "set_a", "set_b"]
    filled = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL")
    one = F.min(F.struct("doc_id", "row")).alias("_one")
    reps = filled.groupBy(*named).agg(one).select(*named, F.col("_one.doc_id").alias("id"), F.col("_one.row").alias("rep"))
    reps = stage(reps, "reps")
    of_rep = filled.join(reps.select(*named, F.col("rep").alias("row")), [*named, "row"], "left_semi")
    entries = of_rep.select(F.col("row").alias("rep"), F.explode("bands").alias("band"))
    repeats = _repeats(sketch)
    entries = entries.distinct() if repeats else entries
    crowded = entries.groupBy("band").agg(F.min("rep").alias("first"), F.count("*").alias("n")).where("n > 1")
    stars = entries.join(crowded, "band").where("rep <> first").select(
        F.col("first").alias("a"), F.col("rep").alias("b")
    ).distinct()
    groups = connected_components(stage(stars, "stars"))
    sizes = groups.groupBy("root").agg(F.count("*").alias("n"))
    placed = groups.join(sizes, "root").select(
        F.col("id").alias("rep"), F.col("root").alias("group"), F.ceil(F.col("n") / block).cast("int").alias("blocks")
    )
    placed = placed.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # with two blocks or more, a block alone is part of every pair it is in
    placed = placed.where("blocks = 1 OR part <> other").select(
        "rep", "group", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
    )
    # merge joins at every size, so that a small table shows what a large one costs
    wanted = placed.select(F.col("rep").alias("row")).distinct().hint("merge")
    texts = docs.join(wanted, "row", "left_semi")
    texts = texts.groupBy("row").agg(F.min("text").alias("text")) if repeats else texts
    met = placed.join(texts.hint("merge"), placed["rep"] == texts["row"]).select("group", "low", "high", "rep", "text")
    linked = key_groups(met, ["group", "low", "high"], lambda t: _linked(t, percent), "rep long, root long")
    edges = linked.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b"))
    roots = connected_components(stage(edges, "edges")).withColumnRenamed("id", "rep")
    # from the names of rows back to ids
    linked_reps = reps.join(roots, "rep")
    smallest = linked_reps.groupBy("root").agg(F.min("id").alias("_least"))
    called = linked_reps.join(smallest, "root").select("rep", "_least")
    component = reps.join(called, "rep", "left").select(*named, F.coalesce("_least", "id").alias("_root"))
    same = [sketch[c] == component[c] for c in named]
    return sketch.join(component, same, "left").select(
        "doc_id",
        sketch["n_shingles"],
        F.when((sketch["n_shingles"] > 0) & F.col("doc_id").isNotNull(), F.col("_root"))
        .otherwise(F.col("doc_id")).alias("component_id"),
        "row",
    )


def _repeats(sketch: DataFrame) -> bool:
    """Whether an id occurs with one text in more than one row."""
    return not sketch.groupBy("row").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def one_of_each_group(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the rows whose component has a smaller id. Rows without words stay."""
    joined = _joined(docs, percent)
    gone = joined.where("doc_id <> component_id").select(F.col("row").alias("_row")).distinct()
    return docs.join(gone, F.xxhash64("doc_id", "text") == F.col("_row"), "left_anti")


def query(spark, sf_dir):
    return join(documents(spark, sf_dir))
