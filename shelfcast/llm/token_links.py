"""Alignment of two tokenizers over a corpus, and the counts of linked ids.

Blocks of documents are encoded both ways and laid flat: parent indices name each token's
document, a segmented cumulative sum its end. A hash join on (document, end) finds the ends
that both share and those of one side; between two neighbouring ends lies one link. Each
block counts its links by id pair, Spark merges the counts, and every block gets back the
counts of the pairs it holds. Links themselves are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.byte_pairs import PATTERN, read_ranks
from shelfcast.llm.common import documents, give_back
from shelfcast.scratch import stage

# The rank file holds the vocabulary of byte_bpe_50k.json and gives the same ids.
BYTE_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PIECE_PATH = "/opt/tokenizers/piece_bpe_32k.model"

# Characters of a block: more make fewer counts of pairs in all, and larger rows.
BLOCK_CHARS = 3_000_000
# Characters that are encoded in one call.
CHARS_AT_ONCE = 300_000
# The key of a pair is A's id * WIDEST + B's id; the key of an end is document << 40 | end.
WIDEST = 1 << 20
END_BITS = 40

BLOCK = (
    "block bigint, doc_ids array<bigint>, n_a array<int>, n_b array<int>, n_groups array<int>, "
    "n_links array<int>, shas array<string>, places binary, pairs array<bigint>, counts array<bigint>"
)
RESULT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups_sha256 string"
)


class Side:
    """A tokenizer's encoder with the bytes and the printed id of every token."""

    def __init__(self, tokens: list[bytes], encode):
        self.tokens, self.encode = tokens, encode
        self.sizes = np.array([len(t) for t in tokens], np.int64)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.encode(texts)

    def spells(self, ids: list[int], wanted: bytes) -> bool:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids]) == wanted


@lru_cache(maxsize=1)
def byte_side(path: str) -> Side:
    import tiktoken

    ranks = read_ranks(path)
    coder = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return Side(tokens, lambda texts: [coder.encode_ordinary(" " + t) for t in texts])


@lru_cache(maxsize=1)
def piece_side(path: str) -> Side:
    from sentencepiece import SentencePieceProcessor

    coder = SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(coder.get_piece_size()):
        piece = coder.id_to_piece(i)
        tokens.append(bytes([int(piece[3:5], 16)]) if coder.is_byte(i) else piece.replace("▁", " ").encode())
    return Side(tokens, lambda texts: coder.encode(texts, num_threads=1))


def _flat(lists: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in lists])]).astype(np.int32)
    values = np.concatenate(lists) if lists else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def _ends(lists: pa.ListArray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids one after the other, and the (document, end) key of each."""
    ids = pc.list_flatten(lists).to_numpy()
    parent = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
    total = np.concatenate([[0], np.cumsum(sizes[ids])])
    begins = total[lists.offsets.to_numpy()[:-1]]
    return ids, (parent << END_BITS) | (total[1:] - begins[parent])


def joined_ends(key_a: np.ndarray, key_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ends in order, and whether each is one of A's and of B's."""
    a, b = pa.table({"key": key_a, "in_a": np.ones(len(key_a), bool)}), pa.table({"key": key_b, "in_b": np.ones(len(key_b), bool)})
    both = a.join(b, keys="key", join_type="full outer", use_threads=False)
    key = both["key"].to_numpy()
    order = np.argsort(key)
    sides = [both[c].is_valid().to_numpy()[order] for c in ("in_a", "in_b")]
    return key[order], *sides


def _printed(side: Side, last: str) -> pa.Array:
    """Ids in decimal with a comma, then again with ``last``, to be taken by number."""
    numbers = [str(i) for i in range(len(side.tokens))]
    return pa.array([n + "," for n in numbers] + [n + last for n in numbers], pa.large_string())


def _shas(flat: list[tuple], docs: int, printed: pa.Array, first_b: int) -> list[str]:
    """Digest of every document's groups, printed as A's ids, a bar, B's ids, a semicolon.

    ``flat`` has ids, document and group of each token for A and for B.
    """
    (ids_a, doc_a, group_a), (ids_b, doc_b, group_b) = flat
    # a token stands after all tokens of earlier groups, and B's after A's of its own
    at_a = np.arange(len(ids_a)) + np.searchsorted(group_b, group_a, "left")
    at_b = np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, "right")
    number = np.empty(len(ids_a) + len(ids_b), np.int64)
    for at, ids, group, base in ((at_a, ids_a, group_a, 0), (at_b, ids_b, group_b, first_b)):
        ends = np.ones(len(ids), bool)
        ends[:-1] = group[1:] != group[:-1]
        width = (first_b if base == 0 else len(printed) - first_b) // 2
        number[at] = base + ids + width * ends
    text = printed.take(pa.array(number))
    offsets = np.frombuffer(text.buffers()[1], np.int64)[: len(text) + 1]
    raw = memoryview(text.buffers()[2])
    counts = np.bincount(doc_a, minlength=docs) + np.bincount(doc_b, minlength=docs)
    cuts = offsets[np.concatenate([[0], np.cumsum(counts)])]
    # the semicolon after the last group does not count
    return [hashlib.sha256(raw[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(cuts[:-1], cuts[1:])]


def _parts(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= CHARS_AT_ONCE:
            yield part
            part, size = [], 0
    if part:
        yield part


def aligned(texts: list[str | None], a: Side, b: Side, printed: pa.Array) -> dict:
    """Counts and digests of documents, and their links as id pairs, document by document."""
    ids_a, ids_b = [], []
    for part in _parts([t or "" for t in texts]):
        # some texts at a time: ids are small as arrays, not as Python numbers
        for text, own_a, own_b in zip(part, a.ids(part), b.ids(part)):
            wanted = (" " + text).encode()
            if not text or not (a.spells(own_a, wanted) and b.spells(own_b, wanted)):
                own_a, own_b = [], []
            ids_a.append(np.array(own_a, np.int32))
            ids_b.append(np.array(own_b, np.int32))
    lists_a, lists_b = _flat(ids_a), _flat(ids_b)
    del ids_a, ids_b
    flat_a, key_a = _ends(lists_a, a.sizes)
    flat_b, key_b = _ends(lists_b, b.sizes)
    key, in_a, in_b = joined_ends(key_a, key_b)
    shared = in_a & in_b
    # what ends here belongs to the token after all that ended before
    link_a = flat_a[np.cumsum(in_a) - in_a].astype(np.int64)
    link_b = flat_b[np.cumsum(in_b) - in_b].astype(np.int64)
    group = np.cumsum(shared) - shared
    of_doc = key >> END_BITS
    sides = [(flat_a, key_a >> END_BITS, group[in_a]), (flat_b, key_b >> END_BITS, group[in_b])]
    n = len(texts)
    return {
        "n_a": np.diff(lists_a.offsets.to_numpy()),
        "n_b": np.diff(lists_b.offsets.to_numpy()),
        "n_groups": np.bincount(of_doc[shared], minlength=n),
        "n_links": np.bincount(of_doc, minlength=n),
        "shas": _shas(sides, n, printed, 2 * len(a.tokens)),
        "pair": link_a * WIDEST + link_b,
    }


def _blocks(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[tuple[list, list]]:
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch["doc_id"], batch["text"]):
            keys.append(key.as_py())
            texts.append(text.as_py())
            size += len(texts[-1] or "")
            if size >= chars:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def _count_blocks(docs: DataFrame, byte_path: str, piece_path: str, chars: int) -> DataFrame:
    """A row per block: its documents' own figures, its id pairs with their counts, and the
    place of every link's pair among them, frequent ones first, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        a, b = byte_side(byte_path), piece_side(piece_path)
        printed = pa.concat_arrays([_printed(a, "|"), _printed(b, ";")])
        codec = pa.Codec("zstd", 1)
        for number, (keys, texts) in enumerate(_blocks(batches, chars)):
            found = aligned(texts, a, b, printed)
            coded = pa.array(found.pop("pair")).dictionary_encode()
            table = pa.table({"place": coded.indices}).group_by("place").aggregate([([], "count_all")])
            counts = np.zeros(len(coded.dictionary), np.int64)
            counts[table["place"].to_numpy()] = table["count_all"].to_numpy()
            order = np.argsort(-counts, kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            places = rank[coded.indices.to_numpy()]
            # equal bytes of neighbouring numbers stand together
            planes = places.view(np.uint8).reshape(-1, 4).T.tobytes()
            ints = [pa.array([found[c].astype(np.int32)], pa.list_(pa.int32())) for c in ("n_a", "n_b", "n_groups", "n_links")]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(TaskContext.get().partitionId() << 32) | number]),
                    pa.array([keys], pa.list_(pa.int64())),
                    *ints,
                    pa.array([found["shas"]], pa.list_(pa.string())),
                    pa.array([codec.compress(planes, asbytes=True) if planes else b""], pa.binary()),
                    pa.array([coded.dictionary.to_numpy()[order]], pa.list_(pa.int64())),
                    pa.array([counts[order]], pa.list_(pa.int64())),
                ],
                ["block", "doc_ids", "n_a", "n_b", "n_groups", "n_links", "shas", "places", "pairs", "counts"],
            )
            del found, coded, places, planes, table
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, BLOCK)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair``, its ``count`` over the corpus, and whether none of its B id is larger."""
    rows = blocks.select(F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("counts").alias("n"))))
    totals = rows.toDF("pair", "n").groupBy("pair").agg(F.sum("n").alias("count"))
    totals = stage(totals.withColumn("b", F.col("pair") % WIDEST), "pair-counts")
    largest = totals.groupBy("b").agg(F.max("count").alias("largest"))
    return totals.join(largest, "b").select("pair", "count", (F.col("count") == F.col("largest")).alias("best"))


def align(
    docs: DataFrame, byte_path: str = BYTE_PATH, piece_path: str = PIECE_PATH, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Per row of ``docs``: tokens, groups, links, links that are the best of their B id,
    the sum of their pairs' counts, and a digest of the groups.

    A encodes a blank and the text, B the text, to which it adds the blank itself. Null and
    empty texts, and those of which a side does not give every byte back, have no tokens:
    zeros and an empty digest. Every row counts, repeated ids and repeated rows too. Texts
    of any length are encoded whole. An empty table gives an empty result; further columns
    are not read.
    """
    blocks = stage(_count_blocks(docs, byte_path, piece_path, block_chars), "token-blocks")
    held = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    scored = held.join(pair_counts(blocks), "pair").select("block", F.struct("place", "count", "best").alias("s"))
    # a block holds a bounded number of pairs
    back = scored.groupBy("block").agg(F.sort_array(F.collect_list("s")).alias("scores"))
    back = back.select("block", F.col("scores.count").alias("score"), F.col("scores.best").alias("best"))
    whole = blocks.drop("pairs", "counts").join(back, "block", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 1)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                keys, n_a, n_b, n_groups, n_links, shas = (
                    row[c].flatten() for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links", "shas")
                )
                links = n_links.to_numpy().astype(np.int64)
                total = int(links.sum())
                sums = [np.zeros(len(links) + 1, np.int64) for _ in range(2)]
                ends = np.concatenate([[0], np.cumsum(links)])
                if total:
                    planes = codec.decompress(row["places"][0].as_buffer(), 4 * total)
                    places = np.frombuffer(planes, np.uint8).reshape(4, total).T.copy().view(np.int32).ravel()
                    values = [row[c].flatten().to_numpy(zero_copy_only=False) for c in ("best", "score")]
                    sums = [np.concatenate([[0], np.cumsum(v.astype(np.int64)[places])]) for v in values]
                best, score = (s[ends[1:]] - s[ends[:-1]] if total else s[:-1] for s in sums)
                plain = [pa.array(x.to_numpy().astype(np.int64)) for x in (n_a, n_b, n_groups, n_links)]
                yield pa.RecordBatch.from_arrays(
                    [keys, *plain, pa.array(best), pa.array(score), shas],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                )
        give_back()

    return whole.mapInArrow(run, RESULT)


def query(spark, sf_dir):
    return align(documents(spark, sf_dir))
