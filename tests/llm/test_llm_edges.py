"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

from __future__ import annotations

import numpy as np
import pytest

from shelfcast.llm import (
    bit_search,
    cap_links,
    line_spread,
    piece_scan,
    shingle_join,
    site_quality,
    source_mix,
    suffix_dedup,
    toxic_spans,
    url_rules,
)
from shelfcast.llm.common import connected_components

LONG = " ".join(f"word{k % 977}x{k}" for k in range(6000))
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, LONG), (5, "same words here and there again"),
       (6, "same words here and there again"), (6, "same words here and there again"), (7, "two words"), (None, "lost")]
LABELS = "doc_id long, quality int, toxic int"


def labels_of(spark, rows=()):
    return spark.createDataFrame(list(rows), LABELS)


def operators(spark):
    return {
        "toxic": lambda d: toxic_spans.score(d, toxic_spans.fit(d, labels_of(spark))),
        "lines": line_spread.without_boilerplate,
        "join": shingle_join.join,
        "suffix": suffix_dedup.remove,
        "pieces": lambda d: piece_scan.decode(piece_scan.encode(d, chunk=500)),
        "quality": lambda d: site_quality.judge(d, labels_of(spark)),
        "mix": lambda d: source_mix.mix(source_mix.sized_documents(d)),
    }


@pytest.mark.parametrize("name", ["toxic", "lines", "join", "suffix", "pieces", "quality", "mix"])
def test_odd_documents(spark, make_docs, name):
    work = operators(spark)[name]
    assert work(make_docs(ODD)).count() == len(ODD)
    assert work(make_docs(ODD).limit(0)).count() == 0


def test_null_source(spark, make_docs):
    docs = make_docs([(1, "a b c", None), (2, "d e", None), (3, "f", "z")])
    taken = {r["doc_id"]: r for r in source_mix.mix(source_mix.sized_documents(docs)).collect()}
    assert taken[1]["source_size"] == 5 and taken[3]["target"] == 2.0


def test_join_odd_sets(spark, make_docs):
    found = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in shingle_join.join(make_docs(ODD)).collect()]
    assert (6, 2, 5) in found and (2, 0, 2) in found and (7, 1, 7) in found and (None, 1, None) in found


def test_join_in_blocks(spark, make_docs):
    rows = [(k, f"{'shared words of a long line ' * 9} {k} end {k}") for k in range(40)]
    whole = sorted(shingle_join.join(make_docs(rows)).collect())
    assert whole == sorted(shingle_join.join(make_docs(rows), block=7).collect())


def test_suffix_periodic_and_cut_in_blocks(spark, make_docs):
    rows = [(1, "ab" * 400), (2, "c" * 399), (3, LONG[:900]), (4, "x" + LONG[100:800]), (5, "y" + LONG[:850])]
    whole = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove(make_docs(rows)).collect()}
    assert whole == {1: 800, 2: 0, 3: 850, 4: 700, 5: 850}
    cut = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove(make_docs(rows), block=1).collect()}
    assert cut == whole


def chunked(coder, text, size):
    """Ids of a text by the matrices of its chunks, at any size."""
    text = " " + text
    cuts = range(0, len(text), size)
    windows = [text[c : c + size + coder.longest - 1] for c in cuts]
    inside = [min(size, len(text) - c) for c in cuts]
    begun = coder.begun(text, cuts)
    made = [coder.chunk(*x) for x in zip(windows, inside, begun)]
    states = piece_scan.boundary_states([m["matrix"] for m in made])
    fields = ("head", "n_head", "tail", "n_tail")
    ids = [
        coder.trace(*(m[f] for f in fields), g, m["middle"], came, left)
        for m, g, came, left in zip(made, begun, states, states[1:])
    ]
    return np.concatenate(ids)


def test_pieces_do_not_depend_on_chunks(llm_documents):
    """Ids of chunks equal those of the whole text, tied paths included."""
    coder = piece_scan.Pieces(piece_scan.read_vocabulary())
    texts = [r["text"] for r in llm_documents.where("length(text) > 300").orderBy("doc_id").limit(60).collect()]
    mixed = "x" * 70 + "hello" * 20 + " ab▁c\n日本" * 9 + LONG[:3000]
    for text, sizes in [(mixed, (7, 16, 33, 700)), ("a" * 700, (16, 300)), (" " * 700, (16, 300))] + [(t, (300,)) for t in texts]:
        whole = coder.encode([text])[0]
        assert coder.decode(whole) == text
        for size in sizes:
            assert np.array_equal(chunked(coder, text, size), whole)


def test_long_runs_do_not_depend_on_chunks(spark, make_docs):
    rows = [(1, "a" * 20000), (2, " " * 20000), (3, "ab " * 6000)]
    ids = [
        {r["doc_id"]: r["ids"] for r in piece_scan.encode(make_docs(rows), chunk=c).collect()} for c in (300, 16_384, 1 << 20)
    ]
    assert ids[0] == ids[1] == ids[2]


def test_pieces_best_path_by_brute_force():
    coder = piece_scan.Pieces(piece_scan.read_vocabulary())
    score = {}
    for i, (piece, value, byte) in enumerate(piece_scan.read_vocabulary()):
        if piece:
            score[piece] = value
    for text in (" unbelievable thblyer", " the quick brown foxes, jumped 12345 times"):
        best = [0.0] + [-np.inf] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - coder.longest), end):
                if text[start:end] in score:
                    best[end] = max(best[end], best[start] + score[text[start:end]])
        assert coder.score[coder.encode([text[1:]])[0]].sum() == best[-1]


def test_marginals_match_enumeration():
    rng = np.random.default_rng(3)
    model = toxic_spans.Model({}, rng.standard_normal((5, 2)), rng.standard_normal((2, 2)), rng.standard_normal(2), np.zeros(3), 0.5)
    seen = [0, 2, 0, 0, 3, 1]
    found = [(i, c, 0, 0) for i, c in enumerate(seen) if c]
    total = np.zeros((len(seen), 2))
    for code in range(2 ** len(seen)):
        tags = [(code >> k) & 1 for k in range(len(seen))]
        weight = np.exp(model.start[tags[0]] + sum(model.emission[c, t] for c, t in zip(seen, tags))
                        + sum(model.transition[a, b] for a, b in zip(tags, tags[1:])))
        for k, t in enumerate(tags):
            total[k, t] += weight
    expected = total[:, 1] / total.sum(1)
    assert np.allclose(toxic_spans.marginals(model, len(seen), found), expected[[f[0] for f in found]])


VECTOR = "vec_id long, embedding array<float>, label int"


def test_odd_vectors(spark):
    rows = [(1, None, 1), (2, [0.0, 0.0], 1), (3, [1.0, None], 1), (4, [float("nan"), 1.0], 1), (5, [], 1),
            (6, [1.0, 0.0], 1), (7, [1.0, 0.0], 1), (8, [1.0, 0.01], 1), (9, [1.0, 0.0], 2), (10, [1.0, 0.0], None)]
    table = spark.createDataFrame(rows, VECTOR)
    links = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in cap_links.link(table, cap=0.1, codes=16).collect()}
    assert links[6] == (2, 6, True) and links[7] == (2, 6, False) and links[8] == (2, 6, False)
    assert all(links[k] == (0, k, True) for k in (1, 2, 3, 4, 5, 9, 10))
    assert cap_links.link(table.limit(0)).count() == 0
    near = bit_search.search(table.where("vec_id = 6"), table).collect()
    assert [(r["rank"], r["vec_id"]) for r in near][:3] == [(1, 7), (2, 9), (3, 10)]
    assert bit_search.search(table.limit(0), table.limit(0)).count() == 0


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://A.Example.ORG/es/x?q"), (4, "http://x.org"), (5, "http://b.com/de/1#f"),
            (5, "http://b.com/de/1#f"), (6, "http://notexample.org/en/1"), (7, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'r' AS rule", "0 AS host")
    found = sorted((r["page_id"], r["host"], r["rule"], r["verdict"]) for r in url_rules.judge(pages, url_rules.rule_table(spark, url_rules.RULES)).collect() if r["rule"])
    assert found == [(3, "a.example.org", "example.org/es/", "block"), (5, "b.com", "com/de/", "block"),
                     (5, "b.com", "com/de/", "block"), (6, "notexample.org", "org/", "allow")]
    assert url_rules.judge(pages, url_rules.rule_table(spark, [])).count() == len(rows)


def test_components_of_a_chain(spark):
    edges = spark.range(1, 200).selectExpr("id AS a", "id + 1 AS b").unionAll(spark.range(300, 301).selectExpr("id", "id"))
    roots = {r["id"]: r["root"] for r in connected_components(edges).collect()}
    assert all(roots[k] == 1 for k in range(1, 201)) and roots[300] == 300


def test_boilerplate_threshold(spark, make_docs):
    rows = [(k, f"own line number {k}\na line on many sites\na line on four sites" if k < 4 else f"own line number {k}\na line on many sites", f"s{k}") for k in range(6)]
    found = {r["doc_id"]: r["n_removed"] for r in line_spread.without_boilerplate(make_docs(rows)).collect()}
    assert found == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1}
