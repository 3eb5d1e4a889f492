"""Helpers several operators of this folder share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.scratch import stage

# White space as the operators understand it: tab to carriage return, and the blank.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def unit_interval(*columns) -> Column:
    """A number in (0, 1) that depends on the columns alone: a draw that reruns repeat."""
    bits = F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double")
    return (bits + 0.5) / float(1 << 53)


# Rows of an Arrow batch that a worker turns into Python values at a time.
ROWS_AT_ONCE = 1_000


def give_back() -> None:
    """Return a worker's freed memory to the system: it idles between stages, beside others."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def each_batch(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``work`` to slices of every Arrow batch of ``df``, each on its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                made = work(batch.slice(at, ROWS_AT_ONCE))
                if made is not None and made.num_rows:
                    yield made
        give_back()

    return df.mapInArrow(run, schema)


def connected_components(edges: DataFrame) -> DataFrame:
    """``id`` and ``root`` (smallest id reachable) of every end of an edge ``a``, ``b``.

    Each round gives every id the smallest label among its own and its neighbours', then
    follows labels once (label of the label), so that chains shrink by half or more. Edges
    whose ends already share a label are left out of later rounds, and every edge is
    replaced by one between labels, which merges the edges of a large group to few. Labels
    are written to the shared folder after each round; nothing but the number of remaining
    edges reaches the driver.

    Self edges name ids without neighbours. Null ends are ignored. An empty input gives an
    empty result.
    """
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).dropna()
    ids = edges.select(F.col("a").alias("id")).unionAll(edges.select(F.col("b").alias("id"))).distinct()
    labels = stage(ids.select("id", F.col("id").alias("root")), "labels")
    links = stage(_between(edges), "links")
    while not links.isEmpty():
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy(F.col("a").alias("root")).agg(F.min("b").alias("low"))
        best = best.select("root", F.least("root", "low").alias("low"))
        # follow once: the label of the label
        after = best.select(F.col("root").alias("low"), F.col("low").alias("lower"))
        jump = stage(
            best.join(after, "low", "left").select("root", F.coalesce("lower", "low").alias("next")),
            "jump",
        )
        labels = stage(
            labels.join(jump, "root", "left").select("id", F.coalesce("next", "root").alias("root")),
            "labels",
        )
        moved = links
        for end in ("a", "b"):
            to = jump.select(F.col("root").alias(end), F.col("next").alias(f"{end}_to"))
            moved = moved.join(to, end, "left").withColumn(end, F.coalesce(f"{end}_to", end)).drop(f"{end}_to")
        links = stage(_between(moved), "links")
    return labels


def _between(edges: DataFrame) -> DataFrame:
    """Distinct edges between different ids, smaller end first."""
    return edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()


def key_groups(
    df: DataFrame,
    keys: list[str],
    work: Callable[[pa.Table], pa.RecordBatch | None],
    schema: str,
    by_range: bool = False,
) -> DataFrame:
    """Apply ``work`` to the rows of every key, which the caller has bounded in number.

    Rows are dealt by key, or by sampled ranges of it, and sorted; a task reads them as a stream and holds one key's
    rows at a time. Groups of a few rows cost little, unlike one Python call per group with
    its own Arrow stream. Keys are not null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            values = [batch[k].to_numpy(zero_copy_only=False) for k in keys]
            change = np.zeros(batch.num_rows - 1, bool)
            for v in values:
                change |= v[1:] != v[:-1]
            cuts = [0, *(np.nonzero(change)[0] + 1), batch.num_rows]
            if held and any(held[-1][k][0].as_py() != batch[k][0].as_py() for k in keys):
                yield from made(held)
                held = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                held.append(batch.slice(a, b - a))
                if b < batch.num_rows:
                    yield from made(held)
                    held = []
        if held:
            yield from made(held)
        held = []
        give_back()

    def made(parts):
        result = work(pa.Table.from_batches(parts))
        if result is not None and result.num_rows:
            yield result

    dealt = df.repartitionByRange(*keys) if by_range else df.repartition(*keys)
    dealt = dealt.sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, schema)
