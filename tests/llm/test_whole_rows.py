"""Rows of one id, long documents, left-out labels and sketches decide what they should."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from shelfcast.llm import bit_search, line_spread, site_quality, source_mix, suffix_dedup, toxic_spans

VECTOR = "vec_id long, embedding array<double>"


def test_search_returns_every_row_of_an_id(spark):
    rows = [(100, [1.0, 0.0]), (7, [1.0, 0.1]), (7, [1.0, 0.2]), (8, [0.0, 1.0]), (8, [0.0, 1.0]), (None, [1.0, 0.0])]
    table = spark.createDataFrame(rows, VECTOR).selectExpr("*", "1 AS own", "2 AS asked", "3 AS score")
    found = bit_search.search(table.where("vec_id = 100"), table).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"]) for r in found] == [(1, 7), (2, 7), (3, 8), (4, 8)]
    assert math.isclose(found[0]["score"], 0.1) and math.isclose(found[2]["score"], math.sqrt(2))


def test_query_leaves_out_its_own_row_only(spark, tmp_path):
    rows = [(100, [1.0, 0.0]), (100, [1.0, 0.0]), (5, [1.0, 0.5])]
    spark.createDataFrame(rows, VECTOR).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = Counter((r["query_id"], r["rank"], r["vec_id"]) for r in bit_search.query(spark, str(tmp_path)).collect())
    assert found == {(100, 1, 100): 2, (100, 2, 5): 2}


def test_windows_cover_long_documents():
    found = [(3, 1), (399, 2), (400, 3), (950, 1)]
    assert toxic_spans.windows(0, 1000, found) == [(0, 400, [(3, 1), (399, 2)]), (0, 400, [(0, 3)]), (0, 200, [(150, 1)])]
    assert toxic_spans.windows(1, 1300, [(3, 1)]) == [(1, 400, [(3, 1)])]
    assert toxic_spans.windows(1, 30, []) == [(1, 30, [])] and toxic_spans.windows(0, 0, []) == []


def test_field_learns_from_long_documents(spark, make_docs):
    rng = np.random.default_rng(5)
    texts = []
    for k in range(120):
        words = [f"w{rng.integers(400)}" for _ in range(500)]
        if k % 2:
            for at in rng.integers(0, 500, 12):
                words[at] = "nastyword"
        texts.append((k, " ".join(words)))
    labels = spark.createDataFrame([(k, 0, k % 2) for k, _ in texts], "doc_id long, quality int, toxic int")
    model = toxic_spans.fit(make_docs(texts), labels)
    assert np.abs(model.emission[1:]).max() > 0.5 and np.abs(model.transition).max() > 0.5
    scored = {r["doc_id"]: r for r in toxic_spans.score(make_docs(texts), model).collect()}
    assert all((scored[k]["score"] >= 0.7) == (k % 2 == 1) for k, _ in texts)
    span = scored[1]["spans"][0]
    assert "nastyword" in texts[1][1][span["start"] : span["end"]]


def test_mixed_rows_of_an_id_decide_for_themselves(spark, make_docs):
    rows = [(k % 20, " ".join(f"x{k}" for _ in range(3 + k % 7)), f"s{k % 2}") for k in range(400)]
    rows += [(7, "same text here", "s1")] * 5 + [(None, "no id at all", "s0"), (8, None, "s0"), (9, "", None)]
    docs = make_docs(rows)
    written = source_mix.mixed_documents(docs)
    assert written.columns == docs.columns
    words = {r["source"]: r["n"] for r in written.groupBy("source").agg(F.sum(source_mix.word_count("text")).alias("n")).collect()}
    mixed = source_mix.mix(source_mix.sized_documents(docs))
    target = {r["source"]: r["target"] for r in mixed.select("source", "target").distinct().collect()}
    assert all(abs(words[s] - target[s]) <= 9 for s in ("s0", "s1"))
    kept = Counter((r["doc_id"], r["text"]) for r in written.collect())
    had = Counter((i, t) for i, t, _ in rows)
    assert all(n <= 2 * had[key] for key, n in kept.items())
    assert kept[(8, None)] == 1 and kept[(9, "")] == 1
    assert source_mix.mixed_documents(docs.limit(0)).count() == 0


def test_sketch_decides(spark, make_docs, monkeypatch):
    rows = [(k, f"own line number {k}\na line on many sites", f"s{k}") for k in range(8)]
    rows += [(k, f"own line number {k}\na line on five sites", f"s{k % 5}") for k in range(20, 40)]
    rows += [(k, f"own line number {k}\na line of four sites", f"s{k % 4}") for k in range(40, 60)]
    rows += [(70, None, "s1"), (71, "", None), (None, "a line on many sites", "s9")]
    removed = lambda: sum(r["n_removed"] for r in line_spread.without_boilerplate(make_docs(rows)).collect())
    assert removed() == 7 + 19
    monkeypatch.setattr(line_spread, "sites_about", lambda site: F.max(F.lit(0)))
    assert removed() == 0


def by_hand(rows, doc_scores, site_k, section_k):
    """Posterior means without each row's own label, and scores, in plain Python."""
    out = []
    for i, (doc, source, lang, good) in enumerate(rows):
        others = [r for k, r in enumerate(rows) if k != i and r[3] is not None]
        counts = lambda keep: (len(g := [r[3] for r in others if keep(r)]), sum(g))
        n, g = counts(lambda r: True)
        base = (g + 0.5) / (n + 1)
        n, g = counts(lambda r: r[1] == source)
        site = (g + site_k * base) / (n + site_k)
        n, g = counts(lambda r: (r[1], r[2]) == (source, lang))
        section = (g + section_k * site) / (n + section_k)
        odds = lambda p: math.log(p / (1 - p))
        total = odds(doc_scores[doc]) + odds(section) - odds(base)
        out.append((doc, site, section, 1 / (1 + math.exp(-total))))
    return out


def test_site_quality_by_hand(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(90):
        source, lang = [None, "a", "b", "c"][k % 4], ["en", None, "fr"][k % 3]
        good = None if k % 5 == 0 or source == "c" else int(rng.random() < (0.9 if source == "a" else 0.3))
        rows.append((k, source, lang, good))
    texts = [(k, "plain words. " * int(rng.integers(1, 20)), s, l) for k, s, l, _ in rows]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string, lang string").selectExpr("*", "1 AS n", "2 AS good")
    labels = spark.createDataFrame([(k, g, 0) for k, _, _, g in rows], "doc_id long, quality int, toxic int")
    ks = iter([4.0, 2.0])
    monkeypatch.setattr(site_quality, "strength", lambda groups, prior: next(ks))
    found = {r["doc_id"]: r for r in site_quality.judge(docs, labels).collect()}
    scores = {k: r["doc_score"] for k, r in found.items()}
    for doc, site, section, score in by_hand(rows, scores, 4.0, 2.0):
        r = found[doc]
        assert np.allclose([r["site_quality"], r["section_quality"], r["score"]], [site, section, score])
        assert r["kept"] == (r["score"] >= 0.5)


def test_site_quality_helps_on_held_out_rows(spark, make_docs):
    """Texts say nothing here; sites with labels do, for rows whose labels were not given."""
    rng = np.random.default_rng(4)
    rows = [(k, "the same plain words in all", f"s{k % 6}") for k in range(600)]
    good = [int(rng.random() < (0.95 if k % 6 < 3 else 0.05)) for k in range(600)]
    given = spark.createDataFrame([(k, g, 0) for k, g in enumerate(good) if k % 7], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in site_quality.judge(make_docs(rows), given).collect()}
    held = [k for k in range(600) if k % 7 == 0]
    assert np.mean([found[k]["kept"] == (good[k] == 1) for k in held]) >= 0.85
    assert len({round(found[k]["doc_score"], 6) for k in held}) == 1


def test_site_quality_held_out_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = {r["doc_id"]: r["quality"] for r in labels.where(toxic_spans.HELD_OUT).collect()}
    judged = site_quality.judge(docs, labels.where("NOT " + toxic_spans.HELD_OUT)).collect()
    right = [r["kept"] == (held[r["doc_id"]] > 0) for r in judged if held.get(r["doc_id"]) is not None]
    assert len(right) > 10 and np.mean(right) >= 0.9


def test_anchors_of_many_copies_reach_several_tasks(spark):
    every = spark.range(6000).select(
        F.when(F.col("id") < 3000, -1).otherwise(F.floor(F.col("id") / 2)).alias("lead"), F.col("id").alias("row"), F.lit(0).alias("at")
    )
    counted = every.groupBy("lead").agg(F.count("*").alias("_n")).where("_n > 1")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        found = suffix_dedup._meeting(every, counted, ["lead"]).withColumn("task", F.spark_partition_id())
        rows = [r["task"] for r in found.where("lead = -1").select("task").collect()]
        assert found.count() == 6000
    finally:
        spark.conf.set(coalesce, before)
    # the lead with half of all rows does not sit in one task
    assert len(rows) == 3000 and max(rows.count(t) for t in set(rows)) < 1000
