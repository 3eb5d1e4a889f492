"""Queries for single-row column rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.functions import columns as fn
from shelfcast.operators import aggregate, clean
from shelfcast.plans.registry import (
    PANEL_FIELDS,
    VALIDATION_CUT,
    over_panel,
    over_rated,
    register,
)
from shelfcast.sources.panel import labelled_panel, rated_documents, rows_to_predict, sales_panel
from shelfcast.sources.scans import read_named
from shelfcast.sources.schema import feature_columns


@register("panel_label", over_panel(f" SELECT {PANEL_FIELDS}, label FROM panel"))
def panel_label(spark, sf_dir):
    return labelled_panel(spark, sf_dir)


@register("select_subset", over_panel(" SELECT item_id, store_id, dn, sales FROM panel"))
def select_subset(spark, sf_dir):
    return sales_panel(spark, sf_dir).select("item_id", "store_id", "dn", "sales")


@register(
    "feature_subset",
    over_rated(" SELECT lang, source, n_chars, toxic FROM rated"),
)
def feature_subset(spark, sf_dir):
    rated = rated_documents(spark, sf_dir)
    return rated.select(feature_columns(rated, ["doc_id", "quality"]))


@register("drop_columns", over_panel(" SELECT year, month, dn, wday, snap, dept_id, item_id, store_id, sales FROM panel"))
def drop_columns(spark, sf_dir):
    return sales_panel(spark, sf_dir).drop("flag_ram", "Sales_Pred", "no_such_column")


@register(
    "rename_prefixed",
    over_panel(" SELECT item_id, store_id, dn AS Fdn, wday AS Fwday, sales AS Fsales FROM panel"),
)
def rename_prefixed(spark, sf_dir):
    rows = sales_panel(spark, sf_dir).select("item_id", "store_id", "dn", "wday", "sales")
    return fn.prefixed(rows, "F", keep=["item_id", "store_id"])


@register(
    "cast_trunc",
    """SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice - 5000) AS INTEGER) AS whole
       FROM lineitem""",
)
def cast_trunc(spark, sf_dir):
    return read_named(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", fn.truncated_int(F.col("l_extendedprice") - 5000).alias("whole")
    )


@register(
    "horizon_offset",
    over_panel(
        f""" SELECT item_id, store_id, dn, CAST(dn - {VALIDATION_CUT} AS INTEGER) AS day_offset
        FROM panel WHERE label IS NULL"""
    ),
)
def horizon_offset(spark, sf_dir):
    return rows_to_predict(spark, sf_dir).select(
        "item_id", "store_id", "dn", fn.horizon_offset("dn", VALIDATION_CUT).alias("day_offset")
    )


@register(
    "clamp_non_negative",
    over_panel(
        """ SELECT item_id, store_id, dn,
        CASE WHEN Sales_Pred < 0 THEN 0.0::DOUBLE ELSE Sales_Pred END AS clamped FROM panel"""
    ),
)
def clamp_non_negative(spark, sf_dir):
    return sales_panel(spark, sf_dir).select(
        "item_id", "store_id", "dn", fn.non_negative("Sales_Pred").alias("clamped")
    )


@register(
    "composite_id",
    over_panel(" SELECT dn, item_id || '_' || store_id || '_validation' AS id FROM panel"),
)
def composite_id(spark, sf_dir):
    return sales_panel(spark, sf_dir).select(
        "dn", fn.joined_id(["item_id", "store_id"], "validation").alias("id")
    )


@register(
    "composite_key",
    over_panel(
        """ SELECT item_id, dn, store_id || '_' || COALESCE(CAST(CAST(Sales_Pred AS INTEGER) AS VARCHAR), 'None') AS key
        FROM panel"""
    ),
)
def composite_key(spark, sf_dir):
    return sales_panel(spark, sf_dir).select(
        "item_id", "dn", fn.text_key(["store_id", F.col("Sales_Pred").cast("int")]).alias("key")
    )


@register(
    "squared_error_rules",
    over_panel(
        """ SELECT item_id, store_id, dn,
        CASE WHEN Sales_Pred IS NULL THEN 0.0
             WHEN sales IS NULL THEN pow(Sales_Pred, 2)
             ELSE pow(Sales_Pred - sales, 2) END AS sq_error FROM panel"""
    ),
)
def squared_error_rules(spark, sf_dir):
    return sales_panel(spark, sf_dir).select(
        "item_id", "store_id", "dn", fn.squared_error_or_default("Sales_Pred", "sales").alias("sq_error")
    )


@register(
    "squared_error_plain",
    over_panel(" SELECT item_id, store_id, dn, pow(Sales_Pred - sales, 2) AS sq_error FROM panel"),
)
def squared_error_plain(spark, sf_dir):
    return sales_panel(spark, sf_dir).select(
        "item_id", "store_id", "dn", fn.squared_error("Sales_Pred", "sales").alias("sq_error")
    )


@register(
    "row_null_count",
    over_panel(
        """ SELECT item_id, store_id, dn,
        CAST((sales IS NULL)::INT + (Sales_Pred IS NULL)::INT + (label IS NULL)::INT AS INTEGER) AS nullcnt
        FROM panel"""
    ),
)
def row_null_count(spark, sf_dir):
    return clean.with_null_count(labelled_panel(spark, sf_dir)).select(
        "item_id", "store_id", "dn", "nullcnt"
    )


@register(
    "row_as_array",
    over_panel(
        """ SELECT dn || '|' || item_id || '|' || store_id || '|' || COALESCE(CAST(sales AS VARCHAR), 'None')
        || '|' || COALESCE(CAST(Sales_Pred AS VARCHAR), 'None') AS row_values FROM panel"""
    ),
)
def row_as_array(spark, sf_dir):
    values = fn.row_values(["dn", "item_id", "store_id", "sales", "Sales_Pred"])
    return sales_panel(spark, sf_dir).select(F.array_join(values, "|", "None").alias("row_values"))


@register(
    "label_to_class",
    "SELECT p_partkey, CAST(trunc(p_retailprice * 10) AS INTEGER) AS price_class FROM part",
)
def label_to_class(spark, sf_dir):
    return read_named(spark, sf_dir, "part").select(
        "p_partkey", fn.scaled_class("p_retailprice").alias("price_class")
    )


@register(
    "fill_missing",
    over_rated(
        """ SELECT doc_id, lang, source, n_chars, COALESCE(quality, 0) AS quality, COALESCE(toxic, 0) AS toxic
        FROM rated"""
    ),
)
def fill_missing(spark, sf_dir):
    return clean.filled(rated_documents(spark, sf_dir), ["quality", "toxic"])


@register(
    "null_row_count",
    over_panel(" SELECT count(*) AS n_rows FROM panel WHERE sales IS NULL OR Sales_Pred IS NULL"),
)
def null_row_count(spark, sf_dir):
    return clean.rows_with_nulls(labelled_panel(spark, sf_dir))


@register(
    "missing_by_column",
    over_rated(
        """ SELECT * FROM (
        SELECT 'doc_id' AS column_name, count(*) AS n_rows, count(*) - count(doc_id) AS n_missing FROM rated UNION ALL
        SELECT 'lang', count(*), count(*) - count(lang) FROM rated UNION ALL
        SELECT 'source', count(*), count(*) - count(source) FROM rated UNION ALL
        SELECT 'n_chars', count(*), count(*) - count(n_chars) FROM rated UNION ALL
        SELECT 'quality', count(*), count(*) - count(quality) FROM rated UNION ALL
        SELECT 'toxic', count(*), count(*) - count(toxic) FROM rated)"""
    ),
)
def missing_by_column(spark, sf_dir):
    return clean.missing_by_column(rated_documents(spark, sf_dir))


@register(
    "column_profile",
    over_rated(
        """ SELECT * FROM (
        SELECT 'doc_id' AS column_name, 'numeric' AS kind, count(doc_id) AS n_filled,
               count(*) - count(doc_id) AS n_missing, CAST(NULL AS BIGINT) AS n_distinct FROM rated UNION ALL
        SELECT 'lang', 'categorical', count(lang), count(*) - count(lang), count(DISTINCT lang) FROM rated UNION ALL
        SELECT 'source', 'categorical', count(source), count(*) - count(source), count(DISTINCT source) FROM rated UNION ALL
        SELECT 'n_chars', 'numeric', count(n_chars), count(*) - count(n_chars), NULL FROM rated UNION ALL
        SELECT 'quality', 'numeric', count(quality), count(*) - count(quality), NULL FROM rated UNION ALL
        SELECT 'toxic', 'numeric', count(toxic), count(*) - count(toxic), NULL FROM rated)"""
    ),
)
def column_profile(spark, sf_dir):
    return aggregate.column_profile(rated_documents(spark, sf_dir), count_distinct=["lang", "source"])
