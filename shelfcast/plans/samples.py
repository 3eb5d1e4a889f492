"""Queries for samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.operators import sampling
from shelfcast.plans.registry import HELD_OUT_SQL, PANEL_KEY, over_panel, register
from shelfcast.plans.shared import stored_panel
from shelfcast.scratch import fresh_path, stage
from shelfcast.sources.panel import known_rows
from shelfcast.sources.sinks import write_parquet

# Known rows and rows to predict of the small and the medium sample.
SMALL = (200, 50)
MEDIUM = (2000, 500)


def _sample_sql(known: int, unknown: int) -> str:
    order = "ORDER BY md5(item_id || '|' || store_id || '|' || dn), item_id, store_id, dn"
    return over_panel(
        f""" SELECT * FROM (
        (SELECT item_id, store_id, dn, label FROM panel WHERE label IS NOT NULL {order} LIMIT {known})
        UNION ALL
        (SELECT item_id, store_id, dn, label FROM panel WHERE label IS NULL {order} LIMIT {unknown}))"""
    )


def _stored_sample(spark, sf_dir, sizes):
    sample = sampling.stratified_sample(stored_panel(spark, sf_dir), PANEL_KEY, *sizes)
    path = fresh_path(spark, "sample")
    write_parquet(sample.select("item_id", "store_id", "dn", "label"), path)
    return spark.read.parquet(path)


@register("stratified_sample", _sample_sql(*SMALL))
def stratified_sample(spark, sf_dir):
    return _stored_sample(spark, sf_dir, SMALL)


@register("stratified_sample_medium", _sample_sql(*MEDIUM))
def stratified_sample_medium(spark, sf_dir):
    return _stored_sample(spark, sf_dir, MEDIUM)


@register("stratified_fraction")
def stratified_fraction(spark, sf_dir):
    panel = stored_panel(spark, sf_dir)
    return sampling.stratified_fraction(panel, *MEDIUM).select("item_id", "store_id", "dn", "label")


@register(
    "stratified_fraction_counts",
    over_panel(
        f""" SELECT label IS NOT NULL AS known, count(*) AS n_rows, 0::BIGINT AS n_foreign, TRUE AS near_wanted
        FROM panel GROUP BY 1"""
    ),
)
def stratified_fraction_counts(spark, sf_dir):
    """Per stratum: its rows, sampled rows that are none of its rows, and whether the
    sample's size lies within five standard deviations of the wanted one."""
    panel = stored_panel(spark, sf_dir).select(*PANEL_KEY, "label")
    drawn = stage(sampling.stratified_fraction(panel, *MEDIUM).withColumn("_drawn", F.lit(1)), "drawn-fraction")
    whole = panel.withColumn("_row", F.lit(1))
    both = whole.join(drawn.withColumnRenamed("label", "_label"), PANEL_KEY, "full")
    known = F.coalesce(F.col("label"), F.col("_label")).isNotNull()
    counted = both.groupBy(known.alias("known")).agg(
        F.count("_row").alias("n_rows"), F.count("_drawn").alias("n_drawn"),
        F.count_if(F.col("_row").isNull() | ~F.equal_null("label", "_label") & F.col("_drawn").isNotNull()).alias("n_foreign"),
    )
    share = F.least(F.lit(1.0), F.when(F.col("known"), MEDIUM[0]).otherwise(MEDIUM[1]) / F.col("n_rows"))
    off = F.abs(F.col("n_drawn") - share * F.col("n_rows"))
    near = off <= 5 * F.sqrt(share * (1 - share) * F.col("n_rows"))
    return counted.select("known", "n_rows", "n_foreign", near.alias("near_wanted"))


@register(
    "split_hash_90_10",
    over_panel(
        f""" SELECT item_id, store_id, dn, CASE WHEN {HELD_OUT_SQL} THEN 'test' ELSE 'train' END AS part
        FROM panel WHERE label IS NOT NULL"""
    ),
)
def split_hash_90_10(spark, sf_dir):
    parted = sampling.with_part(known_rows(spark, sf_dir), PANEL_KEY)
    return parted.select("item_id", "store_id", "dn", "part")


@register("split_random_70_30")
def split_random_70_30(spark, sf_dir):
    known = known_rows(spark, sf_dir).select("item_id", "store_id", "dn")
    return sampling.with_random_part(known, 0.7)


@register(
    "split_random_shares",
    over_panel(
        """ SELECT count(*) AS n_rows, count(*) AS n_placed, 0::BIGINT AS n_twice, TRUE AS near_share
        FROM panel WHERE label IS NOT NULL"""
    ),
)
def split_random_shares(spark, sf_dir):
    """Rows before the split, rows in a part, keys in both parts, and whether the larger
    part's share lies within five standard deviations of 0.7."""
    known = known_rows(spark, sf_dir).select(*PANEL_KEY)
    parted = sampling.with_random_part(known, 0.7)
    both = known.withColumn("part", F.lit("before")).unionByName(parted)
    by_key = both.groupBy(*PANEL_KEY).agg(
        *(F.count_if(F.col("part") == part).alias(part) for part in ("before", "train", "test"))
    )
    sums = by_key.agg(
        F.sum("before").alias("n_rows"), F.sum(F.col("train") + F.col("test")).alias("n_placed"),
        F.sum("train").alias("train"), F.count_if((F.col("train") > 0) & (F.col("test") > 0)).alias("n_twice"),
    )
    near = F.abs(F.col("train") - 0.7 * F.col("n_rows")) <= 5 * F.sqrt(0.21 * F.col("n_rows"))
    return sums.select("n_rows", "n_placed", "n_twice", near.alias("near_share"))
