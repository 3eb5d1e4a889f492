"""Suffix-array dedup: removal of every byte under a long string that occurs twice.

A window of 400 bytes begins a suffix. Sorting the suffixes of all positions would write
many times the text, so suffixes are first sampled by content: every window has one anchor,
the place in it whose leading 200 bytes have the smallest hash. Equal windows have equal
anchors, so only suffixes that share an anchor's leading bytes can be equal. Ranges of
anchors' leading bytes are dealt to tasks by sampled splitters; a task sorts the suffixes
under an anchor by their leading word and then by the fingerprint of their 400 bytes, and
neighbours that are equal are repeated. Anchors with many different surroundings are cut
into blocks, and blocks are compared across their boundaries in pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.common import documents, give_back, key_groups, stage
from shelfcast.llm.shingle_join import _BYTE, _powers, mixed
from shelfcast.operators.skew import measured_join

LENGTH = 400
LEAD = 200
# Bytes whose anchors are found at a time. Positions in them fit into 24 bits, with those of
# one segment more. Longer texts are cut into segments of as many windows.
BYTES_AT_ONCE = 1 << 20
SEGMENT = 1 << 20
# Different surroundings of one anchor that a task compares with as many others.
BLOCK = 4096

U = np.uint64
_PLACE = U((1 << 24) - 1)


def fingerprints(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums and inverse powers: any stretch's hash comes from two of the sums."""
    power, inverse = _powers(len(raw) + 1)
    total = np.concatenate([[U(0)], np.cumsum(_BYTE[raw] * power[: len(raw)], dtype=np.uint64)])
    return total, inverse


def stretch(total, inverse, start, end) -> np.ndarray:
    return mixed((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def anchors(texts: list[bytes], length: int = LENGTH, lead: int = LEAD):
    """For every stretch of windows under one anchor: number of its text, first window,
    number of windows, hash of the anchor's leading bytes, and of all bytes they cover."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    if len(raw) < length or not (sizes >= length).any():
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    total, inverse = fingerprints(raw)
    at = np.arange(len(raw) - lead + 1)
    hashes = stretch(total, inverse, at, at + lead)
    # smallest hash of each window's places, the first of equals
    low = (hashes & ~_PLACE) | at.astype(np.uint64)
    reach, need = 1, length - lead + 1
    while 2 * reach <= need:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    rest = need - reach
    low = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
    owner = (low & _PLACE).astype(np.int64)
    count = np.zeros(len(raw) + 1, np.int32)
    inside = sizes >= length
    count[(ends - sizes)[inside]] += 1
    np.subtract.at(count, (ends - length + 1)[inside], 1)
    valid = np.cumsum(count)[: len(owner)] > 0
    change = np.ones(len(owner), bool)
    change[1:] = (owner[1:] != owner[:-1]) | ~valid[:-1]
    first = np.nonzero(change & valid)[0]
    stop = np.ones(len(owner) + 1, bool)
    stop[:-1] = change | ~valid
    edges = np.nonzero(stop)[0]
    windows = edges[np.searchsorted(edges, first, side="right")] - first
    text = np.searchsorted(ends, first, side="right")
    return (
        text, first - (ends - sizes)[text], windows, hashes[owner[first]].view(np.int64),
        stretch(total, inverse, first, first + windows + length - 1).view(np.int64),
    )


def segments(docs: DataFrame, length: int = LENGTH, segment: int = SEGMENT) -> DataFrame:
    """``row``, ``offset`` and ``bytes`` of every text's segments of ``segment`` windows.

    Segments overlap by ``length`` - 1 bytes, so every window is in one of them. Anchors
    depend on a window's content alone, wherever a text is cut.
    """
    last = F.greatest(F.lit(0), F.ceil((F.octet_length("text") - (length - 1)) / segment).cast("int") - 1)
    cut = docs.where(F.col("text").isNotNull()).select(
        "row", F.col("text").cast("binary").alias("_all"), F.explode(F.sequence(F.lit(0), last)).alias("_number")
    )
    offset = F.col("_number").cast("long") * segment
    part = F.substring("_all", offset.cast("int") + 1, F.lit(segment + length - 1))
    return cut.select("row", offset.alias("offset"), part.alias("bytes"))


def anchor_rows(parts: DataFrame, length: int, lead: int) -> DataFrame:
    """``row``, ``offset``, ``at``, ``windows``, ``lead`` and ``span`` for the anchors of all
    segments; ``at`` counts from the start of the text."""

    def slices(batch) -> Iterator[tuple[list, list, list[bytes]]]:
        rows, offsets, texts, size = [], [], [], 0
        for row, offset, text in zip(batch["row"], batch["offset"], batch["bytes"]):
            rows.append(row.as_py())
            offsets.append(offset.as_py())
            texts.append(text.as_py())
            size += len(texts[-1])
            if size > BYTES_AT_ONCE:
                yield rows, offsets, texts
                rows, offsets, texts, size = [], [], [], 0
        if rows:
            yield rows, offsets, texts

    def run(batches):
        for batch in batches:
            for rows, offsets, texts in slices(batch):
                text, at, windows, leads, spans = anchors(texts, length, lead)
                if len(text):
                    offset = np.array(offsets, np.int64)[text]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.array(rows, np.int64)[text]), pa.array(offset),
                            pa.array(offset + at.astype(np.int64)), pa.array(windows.astype(np.int64)),
                            pa.array(leads), pa.array(spans),
                        ],
                        ["row", "offset", "at", "windows", "lead", "span"],
                    )
        give_back()

    kind = "row long, offset long, at long, windows long, lead long, span long"
    return parts.mapInArrow(run, kind)


def repeated(group: pa.Table, length: int) -> pa.RecordBatch | None:
    """Stretches of a group's spans that are covered by windows found twice in it."""
    texts = group["bytes"].to_pylist()
    sizes = np.array([len(t) for t in texts])
    raw = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    begins = np.cumsum(sizes) - sizes
    windows = sizes - length + 1
    ends = np.cumsum(windows)
    owner = np.repeat(np.arange(len(texts)), windows)
    offset = np.arange(ends[-1]) - np.repeat(ends - windows, windows)
    start = begins[owner] + offset
    total, inverse = fingerprints(raw)
    rest = stretch(total, inverse, start, start + length)
    leading = np.zeros(len(raw) - 7, np.uint64)
    for k in range(8):
        leading = (leading << U(8)) | raw[k : len(raw) - 7 + k]
    word = leading[start]
    order = np.argsort(word, kind="stable")
    # within equal leading words, order by what follows
    order = order[np.lexsort((rest[order], word[order]))]
    equal = (word[order[1:]] == word[order[:-1]]) & (rest[order[1:]] == rest[order[:-1]])
    twice = np.zeros(len(start), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    twice &= ~group["merged"].to_numpy()[owner]
    if not twice.any():
        return None
    fresh = np.ones(len(start), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | ~twice[:-1]
    first = np.nonzero(twice & fresh)[0]
    over = np.ones(len(start) + 1, bool)
    over[:-1] = ~twice | fresh
    edges = np.nonzero(over)[0]
    last = edges[np.searchsorted(edges, first, side="right")] - 1
    row, at = group["row"].to_numpy()[owner[first]], group["at"].to_numpy()[owner[first]]
    return pa.RecordBatch.from_arrays(
        [pa.array(row), pa.array(at + offset[first]), pa.array(at + offset[last] + length)], ["row", "start", "end"]
    )


def _meeting(rows: DataFrame, counted: DataFrame, keys: list[str]) -> DataFrame:
    """Anchors with ``keys`` in ``counted``, which has their numbers of rows, ``_n``; the rows
    of a key that holds many are dealt to several tasks."""
    lookup = counted.select(*keys)
    return measured_join(rows, lookup, keys, ["row", "at"], plain_rows=0, counted=counted)


def covered(
    docs: DataFrame, length: int = LENGTH, lead: int = LEAD, block: int = BLOCK, segment: int = SEGMENT
) -> DataFrame:
    """``row``, ``start`` and ``end`` of stretches covered by repeated strings, which may
    overlap. ``docs`` has ``row`` (equal only for equal texts) and ``text``."""
    parts = segments(docs, length, segment)
    every = stage(anchor_rows(parts, length, lead), "anchors")
    crowded = stage(every.groupBy("lead").agg(F.count("*").alias("_n")).where("_n > 1"), "crowded")
    # copies of one text have the same anchors, so a key may hold many rows
    shared = stage(_meeting(every, crowded, ["lead"]), "shared")
    key = ["lead", "span", "windows"]
    spans = stage(
        shared.groupBy(*key).agg(F.count("*").alias("n"), F.min(F.struct("row", "at", "offset")).alias("_one")), "spans"
    )
    # suffixes with all their surroundings equal are repeated as a whole, and go on as one
    equal = _meeting(shared, spans.where("n > 1").select(*key, F.col("n").alias("_n")), key).select(
        "row", F.col("at").alias("start"), (F.col("at") + F.col("windows") + (length - 1)).alias("end")
    )
    mixed_ = spans.groupBy("lead").agg(F.count("*").alias("m")).where("m > 1")
    placed = spans.join(mixed_, "lead").select(
        "lead", "windows", (F.col("n") > 1).alias("merged"), "_one.row", "_one.at", "_one.offset",
        F.ceil(F.col("m") / block).cast("int").alias("blocks"),
    )
    placed = placed.withColumn("part", F.pmod(F.xxhash64("row", "at"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.where("blocks = 1 OR part <> other").withColumns(
        {"low": F.least("part", "other"), "high": F.greatest("part", "other")}
    )
    inside = (F.col("at") - F.col("offset")).cast("int") + 1
    cut = F.substring("bytes", inside, (F.col("windows") + (length - 1)).cast("int"))
    met = placed.join(parts, ["row", "offset"]).select(
        "lead", "low", "high", "row", "at", "merged", cut.alias("bytes")
    )
    found = key_groups(
        met, ["lead", "low", "high"], lambda t: repeated(t, length), "row long, start long, end long", by_range=True
    )
    return found.unionAll(equal)


def remove(
    docs: DataFrame, length: int = LENGTH, lead: int = LEAD, block: int = BLOCK, segment: int = SEGMENT
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the bytes that remain)
    and ``kept_sha256`` of every row of ``docs``.

    A byte goes when a string of ``length`` bytes that covers it also starts anywhere else,
    in the same text or another; strings are judged on the input and never cross texts.
    Null texts count as empty. Texts shorter than ``length`` stay whole. Repeated rows are
    documents of their own, so they repeat each other. Null ids are no hindrance. Other
    columns are not read. Texts of more than ``segment`` windows are searched in segments.
    """
    docs = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    found = covered(docs, length, lead, block, segment)
    places = found.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("places"))
    joined = docs.join(places.withColumnRenamed("row", "_row"), F.col("row") == F.col("_row"), "left")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"

    def run(batches):
        for batch in batches:
            rows = [_cut(t, p) for t, p in zip(batch["text"].to_pylist(), batch["places"].to_pylist())]
            columns = list(zip(*rows))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
                )

    return joined.select("doc_id", "text", "places").mapInArrow(run, schema)


def _cut(text: str | None, places) -> tuple[int, int, int, bytes, str]:
    raw = (text or "").encode()
    runs: list[list[int]] = []
    for start, end in sorted((p["start"], p["end"]) for p in places or ()):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    kept, at = [], 0
    for start, end in runs:
        kept.append(raw[at:start])
        at = end
    kept = b"".join([*kept, raw[at:]])
    return len(raw), len(raw) - len(kept), len(runs), kept, hashlib.sha256(kept).hexdigest()


def query(spark, sf_dir):
    return remove(documents(spark, sf_dir)).drop("kept")
