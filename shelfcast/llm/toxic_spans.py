"""Toxicity: a linear-chain conditional random field over the words of a document.

Words carry evidence learned from labelled documents (log odds of the word and of its
beginnings). The field has two tags, clean and toxic; its observations are classes of
evidence. Forward-backward gives every word's probability of being toxic; those make the
document's score and the offending offsets.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.common import documents, each_batch

WORD = re.compile(r"\w+")
# Bound of the labelled rows the models are fitted on.
SAMPLE_ROWS = 20_000
# Documents are cut into windows of so many words for the field; of the windows, so many of
# toxic and so many of clean documents train it.
FIELD_ROWS = 300
FIELD_WORDS = 400
THRESHOLD = 0.7
PREFIXES = (4, 5)
# Clean documents every feature counts as seen in, so that rare ones weigh little.
UNSEEN = 3.0
# Log odds that begin an evidence class; below the first is class 0.
CLASS_STARTS = (1.5, 2.5, 3.5, 4.5)
SPANS = "array<struct<start:int,end:int,probability:double>>"


@dataclass
class Model:
    evidence: dict[str, int]
    emission: np.ndarray
    transition: np.ndarray
    start: np.ndarray
    calibration: np.ndarray
    prior: float


def lowered(text: str) -> str:
    """Lower case that keeps every character's offset."""
    low = text.lower()
    if len(low) == len(text):
        return low
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def marks(word: str) -> list[str]:
    """A word's features: itself, and its beginnings if it is longer."""
    return [f"{word}$", *(word[:n] for n in PREFIXES if len(word) >= n)]


def word_class(word: str, evidence: dict[str, int]) -> int:
    return max(evidence.get(m, 0) for m in marks(word))


def observed(text: str, evidence: dict[str, int]) -> tuple[int, list[tuple[int, int, int, int]]]:
    """Number of words, and (word number, class, start, end) of those with evidence."""
    low = lowered(text)
    words = WORD.findall(low)
    hit = {w: c for w in set(words) if (c := word_class(w, evidence))}
    if not hit:
        return len(words), []
    found = (
        (i, hit[m.group()], m.start(), m.end())
        for i, m in enumerate(WORD.finditer(low))
        if m.group() in hit
    )
    return len(words), list(found)


def marginals(model: Model, words: int, found) -> np.ndarray:
    """Probability of the tag toxic for each word with evidence.

    Stretches without evidence are powers of one matrix, so a text of any length costs as
    many steps as it has words with evidence.
    """
    if not found:
        return np.zeros(0)
    emit, move = np.exp(model.emission - model.emission.max(axis=1, keepdims=True)), np.exp(model.transition)
    plain = move * emit[0]

    def through(n):
        """Matrix over ``n`` words without evidence, scaled."""
        out, base = np.eye(2), plain / plain.max()
        while n:
            if n & 1:
                out = out @ base
                out /= out.max()
            base = base @ base
            base /= base.max()
            n >>= 1
        return out

    at = [f[0] for f in found]
    ahead, vector = [], None
    for k, (i, c, _, _) in enumerate(found):
        if vector is None:
            first = np.exp(model.start)
            vector = first * emit[c] if i == 0 else (first * emit[0]) @ through(i - 1) @ move * emit[c]
        else:
            vector = vector @ through(i - at[k - 1] - 1) @ move * emit[c]
        vector = vector / vector.sum()
        ahead.append(vector)
    behind, vector = [None] * len(found), through(words - 1 - at[-1]) @ np.ones(2)
    for k in range(len(found) - 1, -1, -1):
        behind[k] = vector
        if k:
            step = move @ (emit[found[k][1]] * vector)
            vector = through(at[k] - at[k - 1] - 1) @ step
            vector = vector / vector.sum()
    both = np.array(ahead) * np.array(behind)
    return both[:, 1] / both.sum(axis=1)


def summary(chances: np.ndarray) -> np.ndarray:
    """What the document score is made of: a constant, the surest word, the expected count."""
    top = float(chances.max()) if len(chances) else 0.0
    return np.array([1.0, top, math.log1p(float(chances.sum()))])


def logistic(x):
    return 1.0 / (1.0 + np.exp(-x))


def labelled_sample(labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id`` and ``toxic`` of at most ``rows`` labelled rows outside the held-out part,
    picked by a hash of the id. Null labels are no labels; of repeated ids the largest counts."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL AND NOT " + HELD_OUT)
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


HELD_OUT = "(crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1)"


def count_marks(sample: DataFrame) -> DataFrame:
    """For every feature the number of toxic and of clean documents that have it."""

    def work(batch):
        counts = {0: Counter(), 1: Counter()}
        for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
            words = set(WORD.findall(lowered(text or "")))
            counts[int(toxic > 0)].update({m for w in words for m in marks(w)})
        both = list({*counts[0], *counts[1]})
        return pa.RecordBatch.from_arrays(
            [
                pa.array(both),
                pa.array([counts[1][m] for m in both], pa.int64()),
                pa.array([counts[0][m] for m in both], pa.int64()),
            ],
            ["mark", "toxic", "clean"],
        )

    partial = each_batch(sample.select("text", "toxic"), work, "mark string, toxic long, clean long")
    return partial.groupBy("mark").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Evidence, field and calibration from a bounded sample of labelled documents.

    Without labelled documents of both kinds there is no evidence, and every document gets
    the smoothed share of toxic labels as its score.
    """
    chosen = labelled_sample(labels)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    totals = {r["toxic"]: r["n"] for r in sample.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    prior = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
    flat = Model({}, np.zeros((len(CLASS_STARTS) + 1, 2)), np.zeros((2, 2)), np.zeros(2), np.array([math.log(prior / (1 - prior)), 0, 0]), prior)
    if not n_toxic or not n_clean:
        return flat
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + UNSEEN) / (n_clean + UNSEEN))
    strong = count_marks(sample).where(F.col("toxic") >= 3 + 0.002 * n_toxic).withColumn("odds", odds)
    strong = strong.where(F.col("odds") >= CLASS_STARTS[0]).select("mark", "odds").collect()
    evidence = {r["mark"]: int(np.searchsorted(CLASS_STARTS, r["odds"], side="right")) for r in strong}
    if not evidence:
        return flat
    rows = _observations(sample, evidence)
    emission, transition, start = fit_field(rows, len(CLASS_STARTS) + 1)
    model = Model(evidence, emission, transition, start, flat.calibration, prior)
    features = np.array([summary(marginals(model, n, f)) for _, n, f in rows])
    model.calibration = fit_logistic(features, np.array([t for t, _, _ in rows], float))
    return model


def _observations(sample: DataFrame, evidence: dict[str, int]):
    """(toxic, number of words, words with evidence) of the sampled documents, on the driver.

    The sample is bounded, and a row holds only the words with evidence.
    """

    def work(batch):
        seen = [observed(t or "", evidence) for t in batch["text"].to_pylist()]
        return pa.RecordBatch.from_arrays(
            [
                batch["toxic"],
                pa.array([n for n, _ in seen], pa.int32()),
                pa.array([[f[0] for f in found] for _, found in seen], pa.list_(pa.int32())),
                pa.array([[f[1] for f in found] for _, found in seen], pa.list_(pa.int32())),
            ],
            ["toxic", "words", "at", "class"],
        )

    table = each_batch(sample.select("text", "toxic"), work, "toxic int, words int, at array<int>, class array<int>")
    rows = [
        (int(r["toxic"] > 0), r["words"], [(i, c, 0, 0) for i, c in zip(r["at"], r["class"])])
        for r in table.collect()
    ]
    return sorted(rows)


def windows(toxic: int, words: int, found, longest: int = FIELD_WORDS):
    """A document's windows of ``longest`` words, the last one shorter; words of evidence
    are numbered from their window's start. Of a toxic document only windows with evidence
    count, as nothing says what its other windows are."""
    parts = {}
    for i, *rest in found:
        parts.setdefault(i // longest, []).append((i % longest, *rest))
    numbers = sorted(parts) if toxic and words > longest else range(-(-words // longest))
    return [(toxic, min(longest, words - k * longest), parts.get(k, [])) for k in numbers]


def fit_field(rows, classes: int, rounds: int = 50, rate: float = 0.5):
    """Weights of the field by gradient ascent on the likelihood of the labelled words.

    A word is labelled toxic where it has evidence and its document is toxic. Documents of
    any length take part, as windows of at most ``FIELD_WORDS`` words.
    """
    cut = [w for r in rows for w in windows(*r)]
    short = []
    for kind in (0, 1):
        fitting = [w for w in cut if w[0] == kind]
        step = max(1, -(-len(fitting) // FIELD_ROWS))
        short += fitting[::step]
    short = short or [(0, 1, [])]
    length = np.array([r[1] for r in short])
    n, longest = len(short), int(length.max())
    seen = np.zeros((longest, n), np.int64)
    tags = np.zeros((longest, n), np.int64)
    for k, (toxic, _, found) in enumerate(short):
        for i, c, _, _ in found:
            seen[i, k], tags[i, k] = c, toxic
    alive = np.arange(longest)[:, None] < length
    emission, transition, start = np.zeros((classes, 2)), np.zeros((2, 2)), np.zeros(2)
    want_emit, want_move = np.zeros((classes, 2)), np.zeros((2, 2))
    np.add.at(want_emit, (seen[alive], tags[alive]), 1)
    np.add.at(want_move, (tags[:-1][alive[1:]], tags[1:][alive[1:]]), 1)
    want_start = np.bincount(tags[0], minlength=2).astype(float)
    sums = [np.full_like(x, 1e-6) for x in (emission, transition, start)]
    for _ in range(rounds):
        emit, move, first = np.exp(emission), np.exp(transition), np.exp(start)
        ahead = np.empty((longest, n, 2))
        behind = np.ones((longest, n, 2))
        ahead[0] = first * emit[seen[0]]
        ahead[0] /= ahead[0].sum(1, keepdims=True)
        for t in range(1, longest):
            step_ = (ahead[t - 1] @ move) * emit[seen[t]]
            ahead[t] = step_ / step_.sum(1, keepdims=True)
        for t in range(longest - 2, -1, -1):
            step_ = (emit[seen[t + 1]] * behind[t + 1]) @ move.T
            behind[t] = np.where(alive[t + 1][:, None], step_ / step_.sum(1, keepdims=True), 1.0)
        both = ahead * behind
        both /= both.sum(2, keepdims=True)
        got_emit = np.zeros((classes, 2))
        for tag in (0, 1):
            got_emit[:, tag] = np.bincount(seen[alive], weights=both[..., tag][alive], minlength=classes)
        pair = ahead[:-1, :, :, None] * move * (emit[seen[1:]] * behind[1:])[:, :, None, :]
        pair /= pair.sum((2, 3), keepdims=True)
        got_move = pair[alive[1:]].sum(0)
        got_start = both[0].sum(0)
        for x, total, want, got in (
            (emission, sums[0], want_emit, got_emit),
            (transition, sums[1], want_move, got_move),
            (start, sums[2], want_start, got_start),
        ):
            slope = (want - got) - 0.5 * x
            total += slope**2
            x += rate * slope / np.sqrt(total)
    return emission, transition, start


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = logistic(x @ w)
        slope = x.T @ (y - p) - ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(curve, slope)
    return w


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``spans`` (toxic stretches: start and end in
    characters, the surest word's probability) of every row of ``docs``.

    Whole texts are read. A null text counts as empty and gets the score of a text without
    evidence, without spans. Repeated rows get equal results. Only ``doc_id`` and ``text``
    are read, so further columns do no harm.
    """

    def work(batch):
        scores, spans = [], []
        for text in batch["text"].to_pylist():
            words, found = observed(text or "", model.evidence)
            chances = marginals(model, words, found)
            scores.append(float(logistic(summary(chances) @ model.calibration)))
            spans.append(_spans(found, chances))
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(scores, pa.float64()), pa.array(spans, kind)], ["doc_id", "score", "spans"]
        )

    return each_batch(docs.select("doc_id", "text"), work, f"doc_id long, score double, spans {SPANS}")


def _spans(found, chances) -> list[dict]:
    """Words more likely toxic than not; neighbours make one span."""
    out, last = [], None
    for (i, _, start, end), chance in zip(found, chances):
        if chance < 0.5:
            continue
        if last is not None and i == last + 1:
            out[-1]["end"] = end
            out[-1]["probability"] = max(out[-1]["probability"], float(chance))
        else:
            out.append({"start": start, "end": end, "probability": float(chance)})
        last = i
    return out


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` whose text scores below ``threshold``, with their columns."""
    model = fit(docs, labels)
    columns = docs.schema.names
    text_at = columns.index("text")

    def keep(batch):
        texts = batch.column(text_at).to_pylist()
        stay = []
        for text in texts:
            words, found = observed(text or "", model.evidence)
            stay.append(float(logistic(summary(marginals(model, words, found)) @ model.calibration)) < threshold)
        return batch.filter(pa.array(stay))

    return each_batch(docs, keep, docs.schema)


def query(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id",
        F.expr(HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
    )
