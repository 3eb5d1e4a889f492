"""Embedding near-dedup by spherical-cap filters.

A filter is a direction; a vector passes those it is close enough to. The directions are
the combinations of two random codes, one for each half of the rotated vector, so a vector
finds all the filters it passes by decoding: best codes of one half first, each with as
many codes of the other half as still reach the cap. Vectors that share a filter are
compared exactly. The cap follows the vectors' length, so that a pair at the threshold
shares as many filters at any length; very short vectors have one filter for all.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.common import connected_components, each_batch, key_groups, stage
from shelfcast.llm.vectors import distinct_vectors, matrix, rotation, unit, usable

COSINE = 0.93
# Six times 1024 * 1024 directions. At 64 dimensions and a cap of 0.50 a vector passes about
# 70 of them, and a pair at cosine 0.93 is expected to share 25. Other lengths get the cap
# with which it shares as many.
CODES = 1024
TURNS = 6
SHARED = 25.2
# A length at which vectors would have to pass more filters than this has no cap: all of its
# vectors with one label are compared.
MOST_PASSED = 150
# Vectors of one filter that are compared with as many others at a time.
BLOCK = 2048


def _above(size: int):
    """Chance that a coordinate of a random unit vector is above a cap."""
    reach = min(np.pi / 2, 12 / np.sqrt(size))
    angle = np.linspace(np.pi / 2 - reach, np.pi / 2 + reach, 20_001)
    weight = np.sin(angle) ** (size - 2)
    total = np.concatenate([[0], np.cumsum(weight[1:] + weight[:-1])])
    return lambda cap: np.interp(np.arccos(np.clip(cap, -1, 1)), angle, total / total[-1])


def expected(size: int, cap: float, cosine: float, codes: int = CODES, turns: int = TURNS) -> tuple[float, float]:
    """Mean number of filters that a vector of length ``size`` passes, and that two vectors
    at ``cosine`` share. Any direction is a random one to a vector, so means are exact."""
    passing = turns * codes * codes * float(_above(size)(cap))
    steps = 4_000
    angle = np.arccos(cap) * (np.arange(steps) + 0.5) / steps
    weight = np.sin(angle) ** (size - 2)
    weight = weight / weight.max()
    rest = (cap - cosine * np.cos(angle)) / (np.sqrt(1 - cosine * cosine) * np.sin(angle))
    return passing, passing * float((weight * _above(size - 1)(rest)).sum() / weight.sum())


@lru_cache(maxsize=64)
def cap_of(size: int, cosine: float = COSINE, codes: int = CODES, turns: int = TURNS) -> float | None:
    """The cap with which vectors at ``cosine`` share ``SHARED`` filters, or None where they
    would pass too many."""
    if size < 4 or not 0 < cosine < 1:
        return None
    low, high = 0.0, 1.0 - 1e-9
    for _ in range(50):
        cap = (low + high) / 2
        low, high = (cap, high) if expected(size, cap, cosine, codes, turns)[1] > SHARED else (low, cap)
    passing, shared = expected(size, low, cosine, codes, turns)
    return low if passing <= MOST_PASSED and shared >= 0.99 * SHARED else None


@lru_cache(maxsize=4)
def codebook(size: int, codes: int, seed: int):
    """Rotation, and the codes of both halves, scaled so that their pairs have length 1."""
    draw = np.random.default_rng(seed + 1)
    half = size // 2
    sides = []
    for n in (half, size - half):
        c = draw.standard_normal((codes, max(n, 1)))
        sides.append(c / np.linalg.norm(c, axis=1, keepdims=True) * np.sqrt(0.5))
    return rotation(size, seed), sides[0], sides[1]


def passed(
    vectors: np.ndarray, cap: float | None = None, codes: int = CODES, turns: int = TURNS, cosine: float = COSINE
) -> list[np.ndarray]:
    """Numbers of the filters that each unit vector passes, in rising order.

    Without ``cap``, that of the vectors' length; at lengths without one all pass filter 0.
    Every turn is a set of directions of its own: a vector whose halves are uneven under
    one rotation passes few of its filters, but hardly so under all.
    """
    if cap is None:
        cap = cap_of(vectors.shape[1], cosine, codes, turns)
    if cap is None:
        return [np.zeros(1, np.int32)] * len(vectors)
    sets = [_passed(vectors, cap, codes, 7 * (t + 1)) for t in range(turns)]
    return [
        np.concatenate([f + t * codes * codes for t, f in enumerate(one)]).astype(np.int32)
        for one in zip(*sets)
    ]


def _passed(vectors, cap, codes, seed):
    turn, left, right = codebook(vectors.shape[1], codes, seed)
    turned = vectors @ turn
    half = vectors.shape[1] // 2
    first = turned[:, :half] @ left.T if half else np.zeros((len(vectors), codes))
    second = turned[:, half:] @ right.T
    out = []
    for a, b in zip(first, second):
        order = np.argsort(-b)
        falling = -b[order]
        some = np.nonzero(a - falling[0] >= cap)[0]
        counts = np.searchsorted(falling, a[some] - cap, side="right")
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        place = np.arange(total) - np.repeat(ends - counts, counts)
        out.append(np.sort(np.repeat(some, counts).astype(np.int64) * codes + order[place]))
    return out


def filter_rows(
    vectors: DataFrame, cap: float | None = None, codes: int = CODES, cosine: float = COSINE
) -> DataFrame:
    """``row``, ``rep``, ``label``, ``copies``, ``size``, ``embedding`` and ``filters`` of
    vectors."""

    vector_type = vectors.schema["embedding"].dataType

    def work(batch):
        # vectors of different lengths share no filter numbers: length is part of the key
        sizes = np.diff(batch["embedding"].offsets.to_numpy())
        filters = [None] * batch.num_rows
        for size in np.unique(sizes):
            at = np.nonzero(sizes == size)[0]
            rows = unit(matrix(batch["embedding"].take(pa.array(at))))
            for k, f in zip(at, passed(rows, cap, codes, cosine=cosine)):
                filters[k] = f
        return pa.RecordBatch.from_arrays(
            [
                batch["row"], batch["rep"], batch["label"], batch["copies"], pa.array(sizes.astype(np.int32)),
                batch["embedding"], pa.array(filters, pa.list_(pa.int32())),
            ],
            ["row", "rep", "label", "copies", "size", "embedding", "filters"],
        )

    vectors = vectors.select("row", "rep", "label", "copies", F.col("embedding").cast("array<double>"))
    kind = "row long, rep long, label int, copies long, size int, embedding array<double>, filters array<int>"
    made = each_batch(vectors, work, kind)
    # components that are single numbers stay so where they travel
    return made.withColumn("embedding", F.col("embedding").cast(vector_type))


def owned(close: np.ndarray, mine: int, left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Those of the ``close`` pairs whose smallest shared filter is ``mine``.

    A pair meets under every filter it shares, and counts under one of them.
    """
    rows, columns = np.nonzero(close.any(1))[0], np.nonzero(close.any(0))[0]
    if not len(rows):
        return close
    sides = [[f[f < mine] for f in (side[k] for k in keep)] for side, keep in ((left, rows), (right, columns))]
    both = np.intersect1d(*(np.concatenate(side) if side else np.zeros(0, np.int32) for side in sides))
    if not len(both):
        return close
    flags = []
    for side in sides:
        flag = np.zeros((len(side), len(both)), np.float32)
        for k, f in enumerate(side):
            at = np.searchsorted(both, f)
            at = at[at < len(both)]
            known = at[np.isin(both[at], f)]
            flag[k, known] = 1
        flags.append(flag)
    earlier = flags[0] @ flags[1].T > 0
    out = close.copy()
    out[np.ix_(rows, columns)] &= ~earlier
    return out


def compare(block: pa.Table, cosine: float) -> pa.RecordBatch | None:
    """Links of one filter's block pair: per vector its number of links and a smaller id
    that it reaches."""
    mine = block["filter"][0].as_py()
    low, high = block["low"][0].as_py(), block["high"][0].as_py()
    vectors, reps = unit(matrix(block["embedding"])), block["rep"].to_numpy()
    names = block["row"].to_numpy()
    copies = block["copies"].to_numpy()
    filters = [np.asarray(f, np.int32) for f in block["filters"].to_pylist()]
    part = block["part"].to_numpy()
    a, b = np.nonzero(part == low)[0], np.nonzero(part == high)[0]
    close = vectors[a] @ vectors[b].T >= cosine
    if low == high:
        np.fill_diagonal(close, False)
    if not close.any():
        return None
    counted = owned(close, mine, [filters[k] for k in a], [filters[k] for k in b])
    links = np.zeros(len(reps), np.int64)
    links[a] += counted @ copies[b]
    if low != high:
        links[b] += copies[a] @ counted
    root = reps.copy()
    while True:
        before = root.copy()
        top = np.iinfo(np.int64).max
        root[a] = np.minimum(root[a], np.where(close, root[b][None, :], top).min(1))
        root[b] = np.minimum(root[b], np.where(close, root[a][:, None], top).min(0))
        if (root == before).all():
            break
    seen = (links > 0) | (root != reps)
    return pa.RecordBatch.from_arrays(
        [pa.array(names[seen]), pa.array(reps[seen]), pa.array(links[seen]), pa.array(root[seen])],
        ["row", "rep", "links", "root"],
    )


def link(
    vectors: DataFrame, cosine: float = COSINE, cap: float | None = None, codes: int = CODES, block: int = BLOCK
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row of ``vectors``.

    Two vectors link when their labels are equal and not null, their lengths are equal and
    their cosine reaches ``cosine``. Vectors that are null, empty, zero, or hold null or
    non-finite components link with nothing, as do those without a label: no links, a
    component of their own, kept. Equal vectors link with each other. Repeated rows of an
    id count as rows: they link with each other, and share the id's component. A null id
    stays in the result with null component. Other columns are not read.

    Vectors may have any length: the cap follows it, and vectors too short for one (up to
    11 components at the default threshold) are all compared within their label.

    The rows under one filter are cut into blocks of ``block``, and pairs of blocks are
    the tasks' groups; no pair is written out, only sums and one edge per row and group.
    """
    vectors = vectors.select("vec_id", "label", "embedding")
    good = usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    usable_rows = stage(vectors.where(good), "vectors")
    # an id may have several labels and vectors, so what travels is named by its content
    named = F.xxhash64("label", "embedding").alias("row")
    distinct = stage(distinct_vectors(usable_rows, "label").select(named, "*"), "distinct")
    rows = stage(filter_rows(distinct.repartition("rep"), cap, codes, cosine), "filters")
    key = ["label", "size", "filter"]
    entries = rows.select("row", "label", "size", F.explode("filters").alias("filter"))
    crowded = entries.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    met = stage(entries.join(crowded, key), "met")
    blocks = F.ceil(F.col("n") / block).cast("int")
    placed = met.withColumn("blocks", blocks).withColumn("part", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
    met_rows = placed.join(rows.select("row", "rep", "copies", "embedding", "filters"), "row").select(
        *key, "low", "high", "part", "row", "rep", "copies", "embedding", "filters"
    )
    found = stage(
        key_groups(
            met_rows, [*key, "low", "high"], lambda t: compare(t, cosine), "row long, rep long, links long, root long"
        ),
        "links",
    )
    links = found.groupBy("row").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("rep").alias("a"), F.col("root").alias("b"))
    same_id = usable_rows.join(distinct, ["label", "embedding"]).select("vec_id", "row", "rep", "copies")
    same_id = stage(same_id, "copies")
    copy_edges = same_id.where("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    roots = connected_components(stage(edges.unionAll(copy_edges), "edges"))
    linked = same_id.join(links, "row", "left").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    every = linked.unionAll(vectors.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links")))
    rooted = roots.select(F.col("id").alias("vec_id"), "root")
    return every.join(rooted, "vec_id", "left").select(
        "vec_id",
        "n_links",
        F.coalesce("root", "vec_id").alias("component_id"),
        (F.coalesce("root", "vec_id") == F.col("vec_id")).alias("kept"),
    )


def query(spark, sf_dir):
    return link(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
