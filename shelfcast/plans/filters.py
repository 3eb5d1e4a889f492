"""Queries for row filters, orderings and joins by id."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.functions.columns import joined_id
from shelfcast.operators import clean
from shelfcast.operators.encoding import dummy_columns
from shelfcast.operators.models import fitted_line
from shelfcast.plans.registry import (
    EVALUATION_CUT,
    PANEL_FIELDS,
    over_panel,
    over_rated,
    register,
)
from shelfcast.sources.panel import known_rows, labelled_panel, rated_documents, rows_to_predict, sales_panel
from shelfcast.sources.scans import read_named


@register("filter_known", over_panel(f" SELECT {PANEL_FIELDS}, label FROM panel WHERE label IS NOT NULL"))
def filter_known(spark, sf_dir):
    return known_rows(spark, sf_dir)


@register("filter_unknown", over_panel(f" SELECT {PANEL_FIELDS}, label FROM panel WHERE label IS NULL"))
def filter_unknown(spark, sf_dir):
    return labelled_panel(spark, sf_dir).where(F.col("label").isNull())


@register(
    "filter_key",
    over_panel(
        """ SELECT item_id, store_id, dn, sales FROM panel
        WHERE dept_id || '_' || store_id = 'PROMO_NATION_3'"""
    ),
)
def filter_key(spark, sf_dir):
    # The key as its two parts: each reaches the scan of its table.
    rows = sales_panel(spark, sf_dir, dept_id="PROMO", store_id="NATION_3")
    return rows.select("item_id", "store_id", "dn", "sales")


@register(
    "filter_horizon",
    over_panel(
        f""" SELECT CASE WHEN dn <= {EVALUATION_CUT} THEN 'validation' ELSE 'evaluation' END AS horizon,
        item_id, store_id, dn FROM panel WHERE label IS NULL"""
    ),
)
def filter_horizon(spark, sf_dir):
    rows = rows_to_predict(spark, sf_dir).select("item_id", "store_id", "dn")
    in_validation = F.col("dn") <= EVALUATION_CUT
    return rows.withColumn("horizon", F.when(in_validation, "validation").otherwise("evaluation"))


@register(
    "filter_flag",
    over_rated(" SELECT doc_id, lang, quality FROM rated WHERE toxic = 1"),
)
def filter_flag(spark, sf_dir):
    return rated_documents(spark, sf_dir).where(F.col("toxic") == 1).select("doc_id", "lang", "quality")


@register("distinct_keys", over_panel(" SELECT DISTINCT item_id || '_' || store_id AS key FROM panel WHERE label IS NOT NULL"))
def distinct_keys(spark, sf_dir):
    return known_rows(spark, sf_dir).select(joined_id(["item_id", "store_id"]).alias("key")).distinct()


@register(
    "top_keys",
    over_panel(
        """ SELECT DISTINCT item_id || '_' || store_id AS key FROM panel WHERE label IS NOT NULL
        ORDER BY key LIMIT 200"""
    ),
)
def top_keys(spark, sf_dir):
    return distinct_keys(spark, sf_dir).orderBy("key").limit(200)


@register(
    "limit_ordered",
    over_panel(f" SELECT {PANEL_FIELDS} FROM panel ORDER BY item_id, store_id, dn LIMIT 20"),
)
def limit_ordered(spark, sf_dir):
    return sales_panel(spark, sf_dir).orderBy("item_id", "store_id", "dn").limit(20)


@register(
    "join_encoded_by_id",
    over_rated(
        """ SELECT doc_id, n_chars,
        CAST(COALESCE(lang = 'de', FALSE) AS INTEGER) AS lang_de, CAST(COALESCE(lang = 'en', FALSE) AS INTEGER) AS lang_en,
        CAST(COALESCE(lang = 'es', FALSE) AS INTEGER) AS lang_es, CAST(COALESCE(lang = 'fr', FALSE) AS INTEGER) AS lang_fr,
        quality, toxic FROM rated"""
    ),
)
def join_encoded_by_id(spark, sf_dir):
    documents = read_named(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    ratings = read_named(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return dummy_columns(documents, ["lang"]).join(ratings, "doc_id", "left")


@register(
    "join_predictions_left",
    over_rated(
        """ SELECT r.doc_id, round(f.a + f.b * r.n_chars, 6) AS prediction FROM rated r,
        (SELECT regr_intercept(quality, n_chars) AS a, regr_slope(quality, n_chars) AS b
         FROM rated WHERE quality IS NOT NULL) f
        WHERE r.quality IS NULL"""
    ),
)
def join_predictions_left(spark, sf_dir):
    rated = rated_documents(spark, sf_dir).withColumn("label", F.col("quality").cast("double"))
    line = fitted_line(clean.known(rated), "n_chars")
    unrated = clean.to_predict(rated)
    predicted = line.transform(unrated.select("doc_id", "n_chars"))
    ids = unrated.select("doc_id")
    return ids.join(
        predicted.select("doc_id", F.round("prediction", 6).alias("prediction")), "doc_id", "left"
    )


@register(
    "null_text_filter",
    over_panel(" SELECT item_id, store_id, dn, label FROM panel WHERE label IS NOT NULL"),
)
def null_text_filter(spark, sf_dir):
    rows = labelled_panel(spark, sf_dir)
    return rows.filter("label is not null").select("item_id", "store_id", "dn", "label")
