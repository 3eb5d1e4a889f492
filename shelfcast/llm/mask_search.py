"""Ranked lexical search by presence masks.

Documents are reduced to the terms that some item asks for, with their counts. Blocks of
documents then answer every item: bitmap operations set one bit per term of the item in
each document's mask, documents of one mask form a group, and groups are evaluated by
descending maximum score until the next maximum is below the last place. A merge of the
blocks' best documents gives the ranking.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfcast.llm.common import documents, give_back
from shelfcast.scratch import stage

TOP = 50
# Item terms that tasks hold at a time; more items take further rounds over the documents.
TERMS_AT_ONCE = 1_000_000
# Characters of texts, and documents of a block, that a task holds at a time.
CHARS_AT_ONCE = 4_000_000
DOCS_AT_ONCE = 20_000

# Bytes of a term: digits, lower-case letters, all beyond ASCII. Others part terms.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """Terms of a text: only A-Z are lower-cased; null has none."""
    return (text or "").encode().translate(_TERM_BYTES).split()


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct ``item_id``, ``term`` of every item. Null texts have no terms; several rows
    of an item count as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for item, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist()):
                own = sorted(set(terms(text)))
                ids += [item] * len(own)
                found += own
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.binary())], ["item_id", "term"])

    return items.select("item_id", "text").mapInArrow(run, "item_id bigint, term binary").distinct()


def _counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id``, number of terms ``n``, and the ``terms`` of the vocabulary with their
    counts ``tfs``, per row."""
    width = max(len(vocabulary), 1)

    def counted(keys: list, texts: list) -> pa.RecordBatch:
        get = vocabulary.get
        sizes, parts = [], []
        for text in texts:
            words = terms(text)
            sizes.append(len(words))
            parts.append(np.array([get(w, -1) for w in words], np.int64))
        row = np.repeat(np.arange(len(texts)), sizes)
        found = np.concatenate(parts)
        row, found = row[found >= 0], found[found >= 0]
        pair, tf = np.unique(row * width + found, return_counts=True)
        offsets = pa.array(np.searchsorted(pair, np.arange(len(texts) + 1) * width).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32))) for v in (pair % width, tf)]
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts, size = [], [], 0
            for key, text in zip(batch["doc_id"], batch["text"]):
                keys.append(key.as_py())
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if size > CHARS_AT_ONCE:
                    yield counted(keys, texts)
                    keys, texts, size = [], [], 0
            if keys:
                yield counted(keys, texts)
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tfs array<int>")


class Block:
    """Counted documents of a block, by document and by term."""

    def __init__(self, doc_id, n, lists, tfs, weights, n_docs, n_terms):
        self.doc_id, self.weights = doc_id, weights
        self.at = lists.offsets.to_numpy().astype(np.int64)
        self.term = lists.flatten().to_numpy().astype(np.int64)
        self.at -= self.at[0]
        tf = tfs.flatten().to_numpy().astype(np.int64)
        m = 50 + (50 * n * n_docs) // max(n_terms, 1)
        doc = np.repeat(np.arange(len(doc_id)), np.diff(self.at))
        self.part = (1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])
        order = np.argsort(self.term, kind="stable")
        self.docs_of = doc[order]
        self.term_at = np.searchsorted(self.term[order], np.arange(len(weights) + 1))
        # the largest part that a term has in this block bounds its share of any score
        self.most = np.zeros(len(weights), np.int64)
        np.maximum.at(self.most, self.term, self.part)
        self.own = np.zeros(len(weights), np.int64)

    def groups(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents in order of their group, where each group begins, and the groups'
        maximum scores, largest first. A group is all documents of one mask."""
        width = -(-len(asked) // 64)
        masks = np.zeros((width, len(self.doc_id)), np.uint64)
        for bit, term in enumerate(asked):
            masks[bit // 64, self.docs_of[self.term_at[term] : self.term_at[term + 1]]] |= np.uint64(1 << (bit % 64))
        some = np.nonzero(masks.any(axis=0))[0]
        order = some[np.lexsort(masks[:, some])]
        ordered = masks[:, order]
        new = np.ones(len(order), bool)
        new[1:] = (ordered[:, 1:] != ordered[:, :-1]).any(axis=0)
        begins = np.nonzero(new)[0]
        heads = ordered[:, begins]
        bound = np.zeros(len(begins), np.int64)
        for bit, term in enumerate(asked):
            holds = (heads[bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)
            bound += holds.astype(np.int64) * self.weights[term] * self.most[term]
        first = np.argsort(-bound, kind="stable")
        sizes = np.diff(np.concatenate([begins, [len(order)]]))[first]
        ends = np.cumsum(sizes)
        moved = np.arange(len(order)) + np.repeat(begins[first] - (ends - sizes), sizes)
        return order[moved], ends - sizes, bound[first]

    def scores(self, docs: np.ndarray) -> np.ndarray:
        """Exact scores of documents for the item whose weights stand in ``own``."""
        sizes = self.at[docs + 1] - self.at[docs]
        ends = np.cumsum(sizes)
        entry = np.arange(ends[-1]) + np.repeat(self.at[docs] - (ends - sizes), sizes)
        return np.add.reduceat(self.own[self.term[entry]] * self.part[entry], ends - sizes)

    def best(self, asked: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The ``top`` documents of an item, their scores, and how many were evaluated."""
        asked = asked[(self.weights[asked] > 0) & (self.most[asked] > 0)]
        none = np.zeros(0, np.int64)
        if not len(asked):
            return none, none, 0
        docs, begins, bound = self.groups(asked)
        self.own[asked] = self.weights[asked]
        kept, score, group, done, step = none, none, 0, 0, 2 * top
        while group < len(begins) and (len(kept) < top or bound[group] >= score[-1]):
            last = np.searchsorted(begins, begins[group] + step, "left")
            # no group past the last place's score is needed
            if len(kept) == top:
                last = min(last, np.searchsorted(-bound, -score[-1], "right"))
            last = max(last, group + 1)
            upto = begins[last] if last < len(begins) else len(docs)
            fresh = docs[begins[group] : upto]
            kept, score = np.concatenate([kept, fresh]), np.concatenate([score, self.scores(fresh)])
            order = np.lexsort((self.doc_id[kept], -score))[:top]
            kept, score = kept[order], score[order]
            group, done, step = last, upto, 2 * step
        self.own[asked] = 0
        return self.doc_id[kept[score > 0]], score[score > 0], int(done)


def _round(docs: DataFrame, asked: DataFrame, top: int) -> DataFrame:
    """Best documents of every block for the items of ``asked``, a bounded number of terms."""
    table = asked.toArrow()
    names = sorted(set(table["term"].to_pylist()))
    vocabulary = {t: k for k, t in enumerate(names)}
    items: dict[int, list[int]] = {}
    for item, term in zip(table["item_id"].to_pylist(), table["term"].to_pylist()):
        items.setdefault(item, []).append(vocabulary[term])
    per_item = {item: np.array(sorted(own), np.int64) for item, own in items.items()}
    counted = stage(_counted(docs, vocabulary), "counted-terms")
    totals = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_docs, n_terms = totals[0], totals[1]
    df = np.zeros(len(names), np.int64)
    found = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
    df[found["term"].to_numpy()] = found["df"].to_numpy()
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _held(batches):
            held = held.filter(held["doc_id"].is_valid())
            if not held.num_rows:
                continue
            columns = [held[c].combine_chunks() for c in ("doc_id", "n", "terms", "tfs")]
            block = Block(columns[0].to_numpy(), columns[1].to_numpy(), *columns[2:], weights, n_docs, n_terms)
            for item, own in per_item.items():
                doc_id, score, _ = block.best(own, top)
                if len(doc_id):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(doc_id), item)), pa.array(doc_id), pa.array(score)], ["item_id", "doc_id", "score"]
                    )
        give_back()

    return counted.mapInArrow(run, "item_id bigint, doc_id bigint, score bigint")


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of ``DOCS_AT_ONCE`` rows or so."""
    parts, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            parts.append(batch)
            rows += batch.num_rows
        if rows >= DOCS_AT_ONCE:
            yield pa.Table.from_batches(parts)
            parts, rows = [], 0
    if parts:
        yield pa.Table.from_batches(parts)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, terms_at_once: int = TERMS_AT_ONCE) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``top`` documents of every item with
    a score above 0, equal scores by ascending doc_id.

    Null and empty texts have no terms; they are no document of the counts, and as items
    have no result. Every row of ``docs`` is a document, so a repeated id can have several
    ranks; rows of one item are one item with the terms of all. Texts of any length are
    searched whole. Items beyond ``terms_at_once`` terms are answered in rounds, each item
    in one. Empty tables give an empty result; further columns are not read. Documents with
    a null id take part in the counts only; items with a null id are left out.
    """
    asked = stage(item_terms(items.where("item_id IS NOT NULL")), "item-terms")
    rounds = -(-asked.count() // terms_at_once)
    spread = F.pmod(F.xxhash64("item_id"), F.lit(max(rounds, 1)))
    found = None
    for k in range(max(rounds, 1)):
        part = _round(docs, asked.where(spread == k), top)
        found = part if found is None else found.unionAll(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def query(spark, sf_dir):
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_WORDS = r"""unnest(regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""

ORACLE_SQL = f"""
WITH words AS (SELECT doc_id, {_WORDS.format(text='text')} AS term FROM documents),
asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {_WORDS.format(text='text')} AS term FROM benchmark)),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
postings AS (
  SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals
),
parts AS (
  SELECT doc_id, p.term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS part
  FROM postings p JOIN sizes USING (doc_id) JOIN weights USING (term), totals
),
scored AS (
  SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM asked JOIN parts USING (term) GROUP BY item_id, doc_id
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0) WHERE rank <= {TOP}"""
