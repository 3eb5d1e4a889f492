"""Ids that occur in several rows with different contents."""

from __future__ import annotations

from shelfcast.llm import cap_links, shingle_join

A = " ".join(f"alpha{k}" for k in range(60))
B = " ".join(f"beta{k}" for k in range(60))
C = " ".join(f"gamma{k}" for k in range(60))


def test_each_text_of_an_id_links(spark, make_docs):
    docs = make_docs([(1, A), (1, B), (2, A + " more"), (3, B + " more"), (4, C), (5, C + " more"), (5, "just these words"),
                      (6, C), (6, C), (5, C + " more")])
    found = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in shingle_join.join(docs).collect()}
    assert found == {(1, 56, 1), (2, 57, 1), (3, 57, 1), (4, 56, 4), (5, 57, 4), (5, 1, 5), (6, 56, 4)}
    kept = sorted((r["doc_id"], r["text"]) for r in shingle_join.one_of_each_group(docs).collect())
    assert kept == [(1, A), (1, B), (4, C), (5, "just these words")]


def test_rows_of_an_id_are_groups_of_their_own(spark, make_docs):
    docs = make_docs([(3, A), (4, B), (5, A + " more"), (5, B + " more")])
    found = sorted((r["doc_id"], r["component_id"]) for r in shingle_join.join(docs).collect())
    assert found == [(3, 3), (4, 4), (5, 3), (5, 4)]


def test_vectors_of_an_id_link_under_their_label(spark):
    rows = [(1, [1.0, 0.0, 0.0], 1), (1, [0.0, 1.0, 0.0], 2), (2, [0.01, 1.0, 0.0], 1), (3, [1.0, 0.01, 0.0], 2),
            (4, [0.01, 1.0, 0.01], 2), (5, [0.0, 1.0, 0.0], 3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in cap_links.link(table).collect())
    assert found == [(1, 0, 1), (1, 1, 1), (2, 0, 2), (3, 0, 3), (4, 1, 1), (5, 0, 5)]
