"""Suffix dedup of texts longer than a segment."""

from __future__ import annotations

from collections import Counter

import numpy as np

from shelfcast.llm import suffix_dedup


def noise(n, seed):
    return "".join(map(chr, np.random.default_rng(seed).integers(97, 123, n)))


def removed(docs, **options):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffix_dedup.remove(docs, **options).collect()}


def test_segments_change_nothing(spark, make_docs):
    a, b = noise(5000, 1), noise(3000, 2)
    rows = [(1, a), (2, "é" + a[700:3900] + b), (3, b[10:420] + "x" + a[:399]), (4, "ab" * 900), (5, b[:2000] + b[:1200]),
            (6, None), (7, a), (8, "z" * 400), (9, "y" * 399)]
    raw = {i: (t or "").encode() for i, t in rows}
    count = Counter(t[k : k + 400] for t in raw.values() for k in range(len(t) - 399))
    expected = {}
    for i, t in raw.items():
        gone = np.zeros(len(t) + 2, bool)
        for k in range(len(t) - 399):
            if count[t[k : k + 400]] > 1:
                gone[k + 1 : k + 401] = True
        expected[i] = (len(t), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum()))
    docs = make_docs(rows)
    for segment in (1, 100, 401, 1 << 20):
        part = docs.where("doc_id IN (3, 5, 8, 9)") if segment == 1 else docs
        if segment > 1:
            assert removed(part, segment=segment) == expected
        else:
            assert removed(part, segment=segment) == removed(part)


def test_text_over_8_mb(spark, make_docs):
    long = noise(9_000_000, 3)
    again = long[8_500_000:8_501_000]
    found = removed(make_docs([(1, long), (2, "A" + again + "B"), (3, "short")]))
    assert found == {1: (9_000_000, 1000, 1), 2: (1002, 1000, 1), 3: (5, 0, 0)}
