"""Joins whose key may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from shelfcast.scratch import stage

SALT = "_salt"

# A lookup of up to this many rows is a few megabytes; Spark broadcasts it by its own
# size check, and no key is shuffled at all.
PLAIN_LOOKUP_ROWS = 100_000

# A key with more than this share of the rows is split; at most its inverse can be.
HOT_SHARE = 1 / 1000


def spread_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    lookup_rows: int,
    how: str = "inner",
    ways: int = 16,
) -> DataFrame:
    """Join ``rows`` to ``lookup`` (one row per key), of which ``lookup_rows`` is a proven
    upper bound on the row count.

    A lookup beyond ``PLAIN_LOOKUP_ROWS`` is repeated ``ways`` times and merge-joined, so
    that the rows of a hot key reach ``ways`` tasks instead of one; the hint keeps the
    repeated lookup from being broadcast. The split follows the hash of ``spread_by``, so
    it is the same in a retried task. Adaptive execution can split further: no later
    grouping by the key alone can rely on this partitioning, which would hold it back.
    """
    if lookup_rows <= PLAIN_LOOKUP_ROWS:
        return rows.join(lookup, list(keys), how)
    left = rows.withColumn(SALT, F.pmod(F.xxhash64(*spread_by), F.lit(ways)))
    salts = F.sequence(F.lit(0), F.lit(ways - 1)).cast("array<bigint>")
    right = lookup.withColumn(SALT, F.explode(salts)).hint("merge")
    return left.join(right, [*keys, SALT], how).drop(SALT)


def measured_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    hot_share: float = HOT_SHARE,
    plain_rows: int | None = None,
    how: str = "inner",
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join of ``rows`` to ``lookup`` (one row per key, keys not null), where any key may be
    hot; ``how`` is ``inner`` or ``left``.

    A lookup of more than ``plain_rows`` rows (``PLAIN_LOOKUP_ROWS``) is merge-joined, and the
    keys of ``rows`` are counted first, unless ``counted`` has them with their numbers of
    rows, ``_n``. A key with more than ``hot_share`` of all rows is split into parts of that
    size, by the hash of ``spread_by``, and only its lookup row is repeated. There are at most
    ``1 / hot_share`` such keys, so their table is small whatever the data hold. Without one
    nothing is repeated.
    """
    plain_rows = PLAIN_LOOKUP_ROWS if plain_rows is None else plain_rows
    if lookup.limit(plain_rows + 1).count() <= plain_rows:
        return rows.join(lookup, list(keys), how)
    if counted is None:
        counted = stage(rows.groupBy(*keys).agg(F.count("*").alias("_n")), "key-counts")
    total = counted.agg(F.sum("_n")).first()[0] or 0
    part = max(1.0, total * hot_share)
    hot = counted.where(F.col("_n") > part).select(*keys, F.ceil(F.col("_n") / part).cast("int").alias("_ways"))
    hot = stage(hot, "hot-keys")
    if hot.isEmpty():
        return rows.join(lookup.hint("merge"), list(keys), how)
    ways = F.coalesce("_ways", F.lit(1))
    salted = rows.join(F.broadcast(hot), list(keys), "left")
    # rows without a key meet none, wherever they are
    keyless = F.when(F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0)) == 1, F.lit(int(1 / hot_share)))
    own_ways = F.coalesce("_ways", keyless, F.lit(1))
    salted = salted.withColumn(SALT, F.pmod(F.xxhash64(*spread_by), own_ways).cast("int")).drop("_ways")
    repeated = lookup.join(F.broadcast(hot), list(keys), "left")
    repeated = repeated.withColumn(SALT, F.explode(F.sequence(F.lit(0), ways - 1))).drop("_ways")
    return salted.join(repeated.hint("merge"), [*keys, SALT], how).drop(SALT)
