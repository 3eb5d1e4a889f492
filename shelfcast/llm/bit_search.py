"""Approximate nearest neighbours by randomly rotated one-bit codes.

A vector is stored as the signs of its rotated direction from a centre, with its distance
from the centre and the inner product of its direction with its code. Those give an
estimate of the distance to a query and a bound of its error; only vectors whose lower
bound beats the tenth best distance so far are measured exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfcast.llm.common import stage
from shelfcast.llm.vectors import matrix, rotation, usable

NEAREST = 10
EVERY = 100
# Candidates and queries that a task holds at a time.
CANDIDATES = 16_384
QUERIES = 1_024
# Bound of the rows that the centre is the mean of, picked by hash.
CENTRE_ROWS = 10_000
# Width of the error bound; an estimate lies outside with a chance of about exp(-4.5 ** 2 / 2).
ERROR = 4.5


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray):
    """Packed signs, distance from the centre, and how well the signs point."""
    offset = vectors - centre
    far = np.linalg.norm(offset, axis=1)
    direction = (offset / np.where(far > 0, far, 1)[:, None]) @ turn
    signs = direction > 0
    points = np.abs(direction).sum(1) / np.sqrt(vectors.shape[1])
    return np.packbits(signs, axis=1), far, np.where(far > 0, points, 1.0)


def estimate(query: np.ndarray, codes, far, points, centre, turn):
    """Lower bounds of the distances from ``query`` to the coded vectors, squared, and the
    estimates themselves."""
    size = len(query)
    offset = query - centre
    own = np.linalg.norm(offset)
    direction = (offset / own if own > 0 else offset) @ turn
    bits = np.unpackbits(codes, axis=1, count=size)
    with_code = (bits @ (2 * direction) - direction.sum()) / np.sqrt(size)
    cosine = with_code / points
    spread = np.sqrt(np.maximum(0.0, 1 / points**2 - 1) / max(1, size - 1)) * ERROR
    middle = far**2 + own**2 - 2 * far * own * cosine
    return middle - 2 * far * own * spread, middle


def search_block(queries: pa.Table, candidates: pa.Table, centre: np.ndarray, seed: int, nearest: int) -> pa.Table:
    """Nearest candidates of each query within one block."""
    points_ = matrix(candidates["embedding"])
    ids = candidates["vec_id"].to_numpy()
    turn = rotation(points_.shape[1], seed)
    codes, far, points = encode(points_, centre, turn)
    rows = []
    own = candidates["own"].to_numpy()
    names = zip(queries["vec_id"].to_numpy(), queries["asked"].to_numpy(), queries["own"].to_numpy())
    for (query_id, asked, self_), query in zip(names, matrix(queries["embedding"])):
        low, middle = estimate(query, codes, far, points, centre, turn)
        low[own == self_] = np.inf
        middle[own == self_] = np.inf
        some = min(4 * nearest, len(ids))
        first = np.argpartition(middle, some - 1)[:some]
        first = first[np.isfinite(middle[first])]
        measured = np.linalg.norm(points_[first] - query, axis=1)
        if len(measured) >= nearest:
            bar = np.partition(measured, nearest - 1)[nearest - 1]
            again = np.nonzero(low <= bar * bar * (1 + 1e-9))[0]
            again = np.setdiff1d(again, first)
        else:
            again = np.setdiff1d(np.nonzero(np.isfinite(middle))[0], first)
        chosen = np.concatenate([first, again])
        score = np.concatenate([measured, np.linalg.norm(points_[again] - query, axis=1)])
        best = np.lexsort((ids[chosen], score))[:nearest]
        rows += [(query_id, asked, int(ids[chosen[k]]), float(score[k])) for k in best]
    query_ids, numbers, vec_ids, scores = zip(*rows) if rows else ((), (), (), ())
    return pa.table(
        {
            "query_id": pa.array(query_ids, pa.int64()),
            "asked": pa.array(numbers, pa.int64()),
            "vec_id": pa.array(vec_ids, pa.int64()),
            "score": pa.array(scores, pa.float64()),
        }
    )


def search(
    queries: DataFrame,
    candidates: DataFrame,
    nearest: int = NEAREST,
    per_block: int = CANDIDATES,
    queries_per_block: int = QUERIES,
    seed: int = 11,
    own: str = "vec_id",
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` (Euclidean distance) of each
    query's nearest candidates; ties go to the smaller id. Candidates with the query's
    value of ``own`` (a column of integers in both tables) are the query itself.

    Both tables have ``vec_id`` and ``embedding``. Rows with null ids, and vectors that are
    null, empty, zero or not finite, take no part. Vectors of different lengths do not
    meet. Every row counts, so a repeated id may come up several times, and every query row
    gets a list of its own. Queries with fewer candidates than ``nearest`` get all of them.
    An empty table gives an empty result.

    Queries and candidates are dealt into blocks by hash, each pair of blocks is one
    group, and only a query's best of each block leave it.
    """
    queries, candidates = (_usable_rows(t, own) for t in (queries, candidates))
    counts = candidates.agg(F.count("*").alias("n")).crossJoin(queries.agg(F.count("*").alias("q"))).first()
    n_blocks = max(1, -(-counts["n"] // per_block))
    q_blocks = max(1, -(-counts["q"] // queries_per_block))
    centres = _centres(candidates)
    number = F.pmod(F.xxhash64("asked"), F.lit(n_blocks)).cast("int")
    of_query = F.pmod(F.xxhash64("asked"), F.lit(q_blocks)).cast("int")
    left = queries.withColumns(
        {"qb": of_query, "cb": F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))), "size": F.size("embedding")}
    )
    right = candidates.withColumns(
        {"cb": number, "qb": F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))), "size": F.size("embedding")}
    )

    def work(asked: pa.Table, offered: pa.Table) -> pa.Table:
        if not asked.num_rows or not offered.num_rows:
            return search_block_empty()
        return search_block(asked, offered, centres[offered["size"][0].as_py()], seed, nearest)

    key = ["size", "qb", "cb"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        work, "query_id long, asked long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id", "asked").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")


def search_block_empty() -> pa.Table:
    whole = pa.array([], pa.int64())
    return pa.table({"query_id": whole, "asked": whole, "vec_id": whole, "score": pa.array([], pa.float64())})


def _usable_rows(vectors: DataFrame, own: str) -> DataFrame:
    """Rows that take part, numbered by ``asked`` in a written table."""
    good = vectors.where(usable("embedding") & F.col("vec_id").isNotNull() & F.col(own).isNotNull())
    named = good.select("vec_id", F.col(own).cast("long").alias("own"), "embedding")
    return stage(named.withColumn("asked", F.monotonically_increasing_id()), "vectors")


def _centres(candidates: DataFrame) -> dict[int, np.ndarray]:
    """Mean of a bounded sample, by vector length. It moves estimates, never results."""
    sample = candidates.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CENTRE_ROWS)
    means = (
        sample.select(F.size("embedding").alias("size"), F.posexplode("embedding").alias("at", "x"))
        .groupBy("size", "at").agg(F.avg(F.col("x").cast("double")).alias("mean")).collect()
    )
    # lengths outside the sample are centred at the origin
    sizes = {r["size"] for r in candidates.select(F.size("embedding").alias("size")).distinct().collect()}
    out = {size: np.zeros(size) for size in sizes}
    for r in means:
        out[r["size"]][r["at"]] = r["mean"]
    return out


def query(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    vectors = stage(vectors.withColumn("row", F.monotonically_increasing_id()), "rows")
    return search(vectors.where(F.col("vec_id") % EVERY == 0), vectors, own="row")
