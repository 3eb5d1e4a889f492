"""No task of the last stage keeps more than one Python worker beside it."""

from __future__ import annotations

import contextlib
import io

import corpus_pipeline
from shelfcast.llm import piece_scan


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def test_ids_are_written_before_they_are_decoded(make_docs):
    docs = make_docs([(1, "a b a"), (1, "a b a"), (2, None), (None, "ünd"), (4, "long " * 5_000)])
    table = docs.select(*corpus_pipeline.COLUMNS)
    found = corpus_pipeline.pieces(docs.sparkSession, table, "")
    assert plan_of(found).count("MapInArrow") == 1
    whole = piece_scan.decode(piece_scan.encode(table)).selectExpr(
        "doc_id", "ids", "size(ids) AS n_tokens", "sha2(text, 256) AS decoded_sha256"
    )
    assert found.columns == whole.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))
