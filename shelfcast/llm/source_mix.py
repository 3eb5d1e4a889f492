"""Mixing sources to target weights by exponential keys.

Every source gets a target in words. A target above the source's size is met by whole
epochs first; the rest comes from documents in the order of the keys -ln(u) / weight
(weighted sampling without replacement), summed up to the budget.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.llm.common import WORD_PATTERN, documents, stage, unit_interval

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_EPOCHS = 2.0
# Rows of one source whose keys a task sorts, on average.
ROWS_PER_BIN = 5_000


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def quality_weight(chars: str, size: str) -> Column:
    """1 for words of five letters and a blank on average, falling to 0.1 as they differ."""
    mean = F.coalesce(F.col(chars) / F.greatest(F.col(size), F.lit(1)), F.lit(0.0))
    return F.greatest(F.lit(0.1), 1.0 - F.abs(mean - 6.0) / 12.0)


def targets(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_EPOCHS,
) -> DataFrame:
    """``sizes`` (one row per ``source``, with ``source_size``) with its ``target``.

    Sources in code point order, null last, take the weights in turn. A target stops at
    ``most`` times its source; what is cut off is shared again by weight until no target
    is above. That ends where sources cut off are those with the smallest capacity per
    weight, so one pass over sources in that order finds it. The table has a row per
    source, not per document.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    ranked = sizes.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), turn))
    ranked = ranked.withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.lit(float(share)) * F.sum("source_size").over(whole) - F.coalesce(
        F.sum("_cap").over(before), F.lit(0.0)
    )
    # level of this source if it and all later ones share what the earlier ones leave
    levels = ranked.withColumn("_level", left / F.sum("_weight").over(onward))
    open_ = F.col("_level") * F.col("_weight") < F.col("_cap")
    level = F.min(F.when(open_, F.struct(F.col("_cap") / F.col("_weight"), "_level"))).over(whole)["_level"]
    return levels.withColumn("_final", level).withColumn(
        "target", F.least(F.col("_cap"), F.coalesce(F.col("_final") * F.col("_weight"), F.col("_cap")))
    ).select("source", "source_size", "target")


def mix(
    sized: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_EPOCHS,
    seed: int = 0,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``sized`` (``doc_id``, ``source``, ``size``, ``weight``) with ``source_size``,
    ``target`` and ``taken`` (words taken, a multiple of ``size``).

    Each source gives floor(target / size of the source) whole epochs; then documents in
    the order of their keys while at least half of the document lies within the rest of
    the budget, so the sum misses the target by half a document at most. A null source is
    a source of its own. Documents of size 0 take nothing. Equal keys go by ``doc_id``;
    rows equal in every column are alike, so their order does not matter. A weight that is
    null or not positive counts as the smallest positive one allowed, 1e-6. Reruns draw the
    same keys, since they are hashes of id, size and seed. Columns named in ``carry`` stay
    with their rows and settle what is equal otherwise.

    A source may hold a third of all rows: rows are sorted by source and range of the key,
    and the sums of the ranges come before; no task sorts a whole source.
    """
    weight = F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(1e-6))
    keyed = sized.select(
        "doc_id", "source", "size", *carry,
        (-F.log(unit_interval("doc_id", "size", F.lit(seed))) / weight).alias("_key"),
    )
    sizes = keyed.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("_rows"), F.avg("_key").alias("_mean")
    )
    plan = targets(sizes, weights, share, most).withColumnRenamed("source", "_source")
    spread = sizes.select(F.col("source").alias("_of"), "_rows", "_mean")
    plan = plan.join(spread, F.col("_source").eqNullSafe(F.col("_of"))).drop("_of")
    # keys of a source are spread like an exponential, so this puts about as many in each bin
    bin_ = F.floor(
        (1 - F.exp(-F.col("_key") / F.col("_mean"))) * F.ceil(F.col("_rows") / ROWS_PER_BIN)
    ).cast("int")
    placed = keyed.join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_bin", bin_).drop("_source")
    by_bin = placed.groupBy("source", "_bin").agg(F.sum("size").alias("_words"))
    earlier = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_bin.select(
        F.col("source").alias("_source"),
        F.col("_bin").alias("_at"),
        F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_start"),
    )
    in_bin = Window.partitionBy("source", "_bin").orderBy("_key", "doc_id", "size", *carry)
    before = F.coalesce(F.sum("size").over(in_bin.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("_epochs") * F.col("source_size")
    half = F.col("_start") + F.col("_before") + F.col("size") / 2
    return (
        placed.withColumn("_before", before)
        .join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bin") == F.col("_at")))
        .withColumn("_epochs", epochs.cast("long"))
        .withColumn("taken", F.col("size") * (F.col("_epochs") + (half <= rest).cast("long")))
        .select("doc_id", "source", "size", "source_size", "target", "taken", *carry)
    )


def sized_documents(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``source``, ``size`` in words and ``weight`` of documents, and ``carry``."""
    counted = docs.select(
        "doc_id", "source", word_count("text").alias("size"), F.length("text").alias("_chars"), *carry
    )
    return counted.select("doc_id", "source", "size", quality_weight("_chars", "size").alias("weight"), *carry)


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` as the mix takes them: a row per copy, none for documents left out.

    Documents of size 0 are no part of a word budget and stay once. Columns stay as they
    are, whatever their names. Every row has a decision of its own, rows of one id too.
    Rows get their names in a written table, so a lost executor cannot rename them.
    """
    named = stage(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "named")
    taken = mix(stage(sized_documents(named, ["_mix_row"]), "sizes"), carry=["_mix_row"], **settings)
    copies = F.when(F.col("size") == 0, 1).otherwise(F.col("taken") / F.col("size")).cast("int")
    chosen = taken.select("_mix_row", copies.alias("_mix_copies")).where("_mix_copies > 0")
    return (
        named.join(chosen, "_mix_row")
        .withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))))
        .drop("_mix_row", "_mix_copies", "_mix_copy")
    )


def query(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    return mix(stage(sized_documents(docs), "sizes")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )
