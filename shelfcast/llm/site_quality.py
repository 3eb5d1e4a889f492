"""Quality classifier by hierarchical empirical Bayes.

A document's own evidence comes from a logistic model on what its text looks like. Sites
(``source``) and their sections (``lang`` within the site) add what the labels of their
*other* documents say: a section's share of good labels is shrunk towards its site's, a
site's towards that of all labels, as means of Beta posteriors whose strengths the data
give. Sites with few labels so say little, sites without any say nothing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.common import documents, stage
from shelfcast.llm.source_mix import word_count
from shelfcast.llm.toxic_spans import fit_logistic

# Bound of the labelled rows the classifier is fitted on, picked by a hash of the id.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.5
FEATURES = ["long", "word", "symbols", "digits", "lines", "upper"]


def share(text: str, pattern: str) -> Column:
    """Share of a text's characters that match ``pattern``."""
    return F.regexp_count(F.col(text), F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))


def features(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id``, ``text``, ``source``, ``lang``) with a column for each of
    ``FEATURES`` in place of the text, from the whole text. Null counts as empty."""
    docs = docs.select("doc_id", "source", "lang", F.coalesce("text", F.lit("")).alias("text"))
    counted = docs.withColumn("_words", word_count("text"))
    return counted.select(
        "doc_id", "source", "lang",
        (F.log1p("_words") / 5).alias("long"),
        (F.length("text") / F.greatest("_words", F.lit(1)) / 10).alias("word"),
        (share("text", r"[^\p{L}\p{N}\s.,]") * 10).alias("symbols"),
        (share("text", r"[0-9]") * 10).alias("digits"),
        (share("text", r"\n") * 100).alias("lines"),
        (share("text", r"\p{Lu}") * 10).alias("upper"),
    )


def fit(table: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights of the classifier, and means and scales of the features, from at most
    ``rows`` labelled documents. Without labels of both kinds all weights are 0."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = table.join(F.broadcast(chosen), "doc_id").select("quality", *FEATURES).collect()
    if len({r["quality"] > 0 for r in sample}) < 2:
        return np.zeros(2 * len(FEATURES) + 1), np.zeros(len(FEATURES)), np.ones(len(FEATURES))
    x = np.array([[r[f] for f in FEATURES] for r in sample], float)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.clip((x - mean) / scale, -5, 5)
    design = np.hstack([np.ones((len(z), 1)), z, z**2])
    return fit_logistic(design, np.array([float(r["quality"] > 0) for r in sample]), ridge=1.0), mean, scale


def evidence(weights: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> Column:
    """Log odds of good quality from the text alone."""
    total = F.lit(float(weights[0]))
    for k, name in enumerate(FEATURES):
        z = F.greatest(F.lit(-5.0), F.least(F.lit(5.0), (F.col(name) - float(mean[k])) / float(scale[k])))
        total = total + float(weights[1 + k]) * z + float(weights[1 + len(FEATURES) + k]) * z * z
    return total


def log_odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def strength(groups: DataFrame, prior: str) -> float:
    """How many labels the prior of a group counts for, by the method of moments: the
    spread of the groups' shares ``good / n`` around ``prior`` beyond what draws explain."""
    share_ = F.col("good") / F.col("n")
    row = groups.where("n > 0").agg(
        F.sum(F.col("n") * F.pow(share_ - F.col(prior), 2)).alias("between"),
        F.sum(F.col("n") * F.col(prior) * (1 - F.col(prior))).alias("within"),
        F.sum("n").alias("n"), F.count("*").alias("groups"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
    ).first()
    if not row["n"] or row["groups"] < 2:
        return 100.0
    within = row["within"] / row["n"]
    size = (row["n"] - row["squares"] / row["n"]) / (row["groups"] - 1)
    variance = (row["between"] / (row["groups"] - 1) - within) / size if size > 0 else 0.0
    return float(min(1e6, max(1.0, within / variance - 1))) if variance > 0 else 1e6


def label_counts(docs: DataFrame) -> DataFrame:
    """``source``, ``lang``, ``n`` and ``good``: labelled rows of each section, and how many
    of them are good. Rows are summed within each task before they are shuffled."""
    return docs.groupBy("source", "lang").agg(
        F.count("_good").alias("n"), F.coalesce(F.sum("_good"), F.lit(0)).alias("good")
    )


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``doc_score`` (text alone), ``site_quality``, ``section_quality``, ``score``
    and ``kept`` of every row of ``docs``.

    Site and section quality are posterior means without the row's own label. The score
    adds to the row's log odds those of its section beyond those of all labels, likewise
    without its own. A null source or lang is a site or section of its own. Empty and null
    texts are scored by their features like others. Repeated rows count as rows; of
    repeated labels of an id the best counts, null labels are none. No labels: every score
    is 0.5. An empty table gives an empty result. Only ``doc_id``, ``text``, ``source`` and
    ``lang`` are read.

    Labels are counted by section within each task before the shuffle and sections summed
    to sites after it, so a large site costs no more than its number of sections.
    """
    table = stage(features(docs), "features")
    model = fit(table, labels)
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
    known = known.agg((F.max("quality") > 0).cast("long").alias("_good"))
    scored = table.select("doc_id", "source", "lang", (1 / (1 + F.exp(-evidence(*model)))).alias("doc_score"))
    scored = stage(scored.join(known, "doc_id", "left"), "scored")
    sections = stage(label_counts(scored), "sections")
    sites = sections.groupBy("source").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    whole = sites.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    n, good = whole["n"] or 0, whole["good"] or 0
    overall = (good + 0.5) / (n + 1)
    site_strength = strength(sites.withColumn("prior", F.lit(overall)), "prior")
    site = sites.select(F.col("source").alias("_source"), F.col("n").alias("_site_n"), F.col("good").alias("_site_good"))
    placed = sections.join(site, F.col("source").eqNullSafe(F.col("_source")))
    shrunk = lambda good, n, k, prior: (good + k * prior) / (n + k)
    placed = placed.withColumn("prior", shrunk(F.col("_site_good"), F.col("_site_n"), site_strength, F.lit(overall)))
    section_strength = strength(placed, "prior")
    section = placed.select("_source", F.col("lang").alias("_lang"), "_site_n", "_site_good", "n", "good")
    same = F.col("source").eqNullSafe(F.col("_source")) & F.col("lang").eqNullSafe(F.col("_lang"))
    own, own_good = F.col("_good").isNotNull().cast("long"), F.coalesce("_good", F.lit(0))
    # what all labels but the row's own say
    base = (F.lit(good + 0.5) - own_good) / (F.lit(n + 1.0) - own)
    within = lambda c: F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), c))
    others = scored.join(section, same).withColumn("_base", within(base))
    others = others.withColumn(
        "site_quality", shrunk(F.col("_site_good") - own_good, F.col("_site_n") - own, site_strength, F.col("_base"))
    )
    others = others.withColumn(
        "section_quality", shrunk(F.col("good") - own_good, F.col("n") - own, section_strength, F.col("site_quality"))
    )
    total = log_odds(within(F.col("doc_score"))) + log_odds(within(F.col("section_quality"))) - log_odds(F.col("_base"))
    return (
        others.withColumn("score", 1 / (1 + F.exp(-total)))
        .withColumn("kept", F.col("score") >= threshold)
        .select("doc_id", "doc_score", "site_quality", "section_quality", "score", "kept")
    )


def query(spark, sf_dir):
    return judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
