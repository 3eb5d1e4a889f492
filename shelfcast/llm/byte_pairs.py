"""Byte-level BPE encoding and decoding with Spark's higher-order functions.

Texts are split into words by the tokenizer's pattern in blocks of documents; a block names
each different word once. Words that are no tokens are dealt by a hash, so that each is
encoded once in the whole table, however many blocks hold it: a fold over its bytes merges
the adjacent pair of the smallest rank until no pair has one; ranks come from one literal,
an array of small maps that a hash of the piece picks from. The ids of words go back to
their blocks, whose documents take them. Blocks are written in buckets of their number, so
that only words and their ids are shuffled, not the texts.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.common import documents, give_back
from shelfcast.scratch import fresh_path

RANKS_PATH = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Characters of a block; more make fewer words to shuffle, and larger rows.
BLOCK_CHARS = 8_000_000
# Parts that a hash deals words into; a task reads whole parts.
PARTS = 512
# Words of blocks that a row of words to fold stands for, or those of one part.
ROW_WORDS = 500_000
# Bytes of a word from which on a heap merges it: a fold moves the whole word at each merge.
FOLD_BYTES = 512
# Maps of the rank literal: about one piece in each.
RANK_MAPS = 65_537
# The key of two pieces is left * WIDEST + right; ids lie below it.
WIDEST = 1_000_003
# More pieces than a word has: the rest of it.
REST = 1 << 30
# The rank of a pair stands among the ids of a word's pieces less this, so it is below zero;
# a pair that is no token has it as it is.
NO_PAIR = 1 << 30
# Stands before a word's pieces: no id, and in no pair that has a rank.
MARK = 1_000_001


@lru_cache(maxsize=2)
def read_ranks(path: str = RANKS_PATH) -> dict[bytes, int]:
    """Token bytes and their ranks, which are the ids."""
    with open(path, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


@lru_cache(maxsize=2)
def byte_pair_ranks(path: str = RANKS_PATH) -> np.ndarray:
    """Rank of every two bytes that are a token together, else -1: all a task needs to start."""
    of_bytes = np.full((256, 256), -1, np.int32)
    for token, rank in read_ranks(path).items():
        if len(token) == 2:
            of_bytes[token[0], token[1]] = rank
    return of_bytes


@lru_cache(maxsize=2)
def pair_ranks(path: str = RANKS_PATH) -> str:
    """Rank, less ``NO_PAIR``, of every two tokens that are a token together, as text for the
    rank literal.

    It holds ``RANK_MAPS`` maps, of which the remainder of a pair's key names one, so a look-up
    reads a small map and not the vocabulary.
    """
    ranks = read_ranks(path)
    maps: list[dict[int, int]] = [{} for _ in range(RANK_MAPS)]
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                key = left * WIDEST + right
                maps[key % RANK_MAPS][key] = rank - NO_PAIR
    return json.dumps([{"k": list(m), "v": list(m.values())} for m in maps], separators=(",", ":"))


def with_ranks(path: str, use) -> Column:
    """``use(maps)`` with the ranks of pairs as an array of maps, made from one literal once
    a row: a row is a block of documents."""
    buckets = F.from_json(F.lit(pair_ranks(path)), "array<struct<k: array<bigint>, v: array<int>>>")
    return _let(F.transform(buckets, lambda b: F.map_from_arrays(b["k"], b["v"])), use)


def _let(value: Column, use) -> Column:
    """``use(value)``, with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), use), 0)


def folded(word: Column, maps: Column) -> Column:
    """Ids of a word: the fold of ranked merges over its pieces.

    A word is a mark for its beginning and the ids of its bytes, each followed by the rank
    of the pair that it begins. A step merges the first pair of the smallest rank, which is
    the new piece's id, and looks up the two pairs that this changes.
    """

    def rank(left, right):
        key = left.cast("bigint") * WIDEST + right
        return F.coalesce(F.try_element_at(F.get(maps, (key % RANK_MAPS).cast("int")), key), F.lit(NO_PAIR))

    def step(pieces, _):
        def at(k, least):
            # from the rank before the pair, at k - 2, to that behind it, at k + 2
            piece = least + NO_PAIR
            changed = F.array(rank(F.get(pieces, k - 4), piece), piece, rank(piece, F.get(pieces, k + 2)))
            # flatten takes less time than concat
            return F.flatten(F.array(F.slice(pieces, 1, k - 3), changed, F.slice(pieces, k + 3, REST)))

        def merge(least):
            place = F.array_position(pieces, least).cast("int")
            return F.when(least >= 0, pieces).otherwise(_let(place, lambda k: at(k, least)))

        return _let(F.array_min(pieces), merge)

    # a word of n bytes has n - 1 merges at most
    size = (F.size(word) / 2).cast("int")
    steps = F.sequence(F.lit(3), F.greatest(size, F.lit(3)))
    return F.aggregate(steps, word, step, lambda found: F.filter(found, lambda _, i: (i > 0) & (i % 2 == 0)))


def merged_by_heap(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a long word by the same rule, in time that grows with n log n."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(ranks[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    alive = [True] * n

    def push(i):
        j = after[i]
        if j < n:
            rank = ranks.get(word[i : end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[j]))

    while heap:
        _, i, to = heapq.heappop(heap)
        # a pair that has changed since it was put in spans other bytes
        if not alive[i] or after[i] >= n or end[after[i]] != to or end[i] == to:
            continue
        j = after[i]
        alive[j], end[i], after[i] = False, to, after[j]
        if after[i] < n:
            before[after[i]] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def _blocks(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[tuple[list, list]]:
    """Keys and texts of documents, about ``chars`` characters at a time."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch["doc_id"], batch["text"]):
            keys.append(key.as_py())
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if size >= chars:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


PART = "struct<part: int, bytes: binary, sizes: binary>"
BLOCK = f"block bigint, doc_ids array<bigint>, counts array<int>, codes binary, parts array<{PART}>"
FOLD = "blocks array<bigint>, parts array<int>, counts array<int>, places array<int>, words array<array<int>>, done array<array<int>>"


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2^32, all their lowest bytes first: they compress better so."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


class Splitter:
    """Cuts texts by the tokenizer's pattern, with the tokenizer library's own classes.

    Two libraries follow different versions of Unicode. For every character beyond ASCII
    that occurs, the tokenizer library is asked once whether it is a letter or a number;
    where the regular expression says otherwise, a character of the right class stands in
    for it while the text is cut.
    """

    # A letter, a number, and a character that is neither nor a space.
    STAND_INS = ("\u00e9", "\u00b2", "\u00a7")

    def __init__(self):
        base = {bytes([i]): i for i in range(256)}
        kinds = (r"\p{L}", r"\p{N}", r"\s")
        self.theirs = [tiktoken.Encoding("kind", pat_str=k, mergeable_ranks=base, special_tokens={}) for k in kinds]
        self.ours = [regex.compile(k) for k in kinds]
        self.cut, self.known, self.instead = regex.compile(PATTERN), set(map(chr, range(128))), {}

    def words(self, text: str) -> list[str]:
        if not text.isascii():
            for c in set(text) - self.known:
                self.known.add(c)
                theirs = [bool(k.encode_ordinary(c)) for k in self.theirs]
                if theirs != [bool(k.match(c)) for k in self.ours]:
                    letter, number, other = self.STAND_INS
                    self.instead[ord(c)] = " " if theirs[2] else letter if theirs[0] else number if theirs[1] else other
            if self.instead:
                seen = text.translate(self.instead)
                if seen != text:
                    return [text[slice(*m.span())] for m in self.cut.finditer(seen)]
        return self.cut.findall(text)


def _started(words: list[bytes], byte_ids: np.ndarray, of_bytes: np.ndarray) -> pa.ListArray:
    """Words as the fold starts with them: a mark and the ids of their bytes, each with the
    rank of the pair that it begins."""
    flat = np.frombuffer(b"".join(b"\0" + w for w in words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words])
    marks = np.concatenate([[0], ends[:-1]])
    pieces = np.empty((len(flat), 2), np.int32)
    pieces[:, 0] = byte_ids[flat]
    pieces[marks, 0] = MARK
    rank = np.concatenate([of_bytes[flat[:-1], flat[1:]], [-1]])
    # no pair with the mark, nor of a word's last byte with the next word
    rank[marks], rank[ends - 1] = -1, -1
    pieces[:, 1] = np.where(rank < 0, NO_PAIR, rank - NO_PAIR)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], 2 * ends]).astype(np.int32)), pa.array(pieces.ravel()))


class Codes(dict):
    """Code of a word: its id if it is a token, else a number from ``first`` on."""

    def __init__(self, ranks: dict[bytes, int], first: int):
        super().__init__()
        self.ranks, self.first, self.others = ranks, first, []

    def __missing__(self, word: str) -> int:
        raw = word.encode()
        code = self.ranks.get(raw)
        if code is None:
            code = self.first + len(self.others)
            self.others.append(raw)
        self[word] = code
        return code


def _dealt(others: list[bytes], parts: int) -> tuple[np.ndarray, list[dict]]:
    """New number of every word, and the words of each part, in the order of the numbers."""
    if not others:
        return np.zeros(0, np.int64), []
    words = pa.array(others, pa.binary())
    part = np.fromiter((zlib.crc32(w) % parts for w in others), np.int32, len(others))
    order = pc.sort_indices(
        pa.table({"part": part, "word": words}), [("part", "ascending"), ("word", "ascending")]
    ).to_numpy()
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    part, sizes = part[order], np.fromiter(map(len, others), np.int64, len(others))[order]
    edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
    made = []
    for a, b in zip(edges[:-1], edges[1:]):
        raw = b"".join(others[i] for i in order[a:b])
        made.append({"part": int(part[a]), "bytes": raw, "sizes": packed(sizes[a:b])})
    return number, made


def _split(docs: DataFrame, path: str, chars: int) -> DataFrame:
    """One row per block: its documents, their numbers of words, a code for each of these,
    and the block's different words that are no tokens, in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, ranks = Splitter(), read_ranks(path)
        first, task = max(ranks.values()) + 1, TaskContext.get().partitionId()
        for number, (keys, texts) in enumerate(_blocks(batches, chars)):
            named = Codes(ranks, first)
            codes, counts = [], []
            for text in texts:
                words = splitter.words(text)
                codes.append(np.fromiter(map(named.__getitem__, words), np.int32, len(words)))
                counts.append(len(words))
            del texts
            places, parts = _dealt(named.others, PARTS)
            flat = np.concatenate(codes)
            other = flat >= first
            flat[other] = first + places[flat[other] - first]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 32) + number], pa.int64()),
                    pa.array([keys], pa.list_(pa.int64())),
                    pa.array([counts], pa.list_(pa.int32())),
                    pa.array([packed(flat)], pa.binary()),
                    pa.array([parts], pa.list_(pa.struct({"part": pa.int32(), "bytes": pa.binary(), "sizes": pa.binary()}))),
                ],
                ["block", "doc_ids", "counts", "codes", "parts"],
            )
            del named, codes, flat, other, parts
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, BLOCK)


def _bucketed(blocks: DataFrame) -> DataFrame:
    """The blocks, written in buckets of their number and read again: a join by ``block``
    then moves the other side only."""
    spark = blocks.sparkSession
    name, buckets = f"blocks_{uuid.uuid4().hex[:12]}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = blocks.write.bucketBy(buckets, "block").option("compression", "zstd")
    writer.option("path", fresh_path(spark, "blocks")).saveAsTable(name)
    return spark.table(name)


def _different(words: DataFrame, path: str, fold_bytes: int) -> DataFrame:
    """Rows of different words as the fold starts with them, with the ids of those that are
    too long to fold, and the places among them of the words of every block and part."""
    read_ranks(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, of_bytes = read_ranks(path), byte_pair_ranks(path)
        byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)

        def row(held):
            sizes = [unpacked(h["sizes"]) for h in held]
            counts, raw = [len(s) for s in sizes], b"".join(h["bytes"] for h in held)
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)]
            named = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).dictionary_encode()
            different = named.dictionary.to_pylist()
            done = [merged_by_heap(w, ranks) if len(w) > fold_bytes else None for w in different]
            started = _started([b"" if i else w for w, i in zip(different, done)], byte_ids, of_bytes)
            lists = [
                pa.array([[h["block"] for h in held]], pa.list_(pa.int64())),
                pa.array([[h["part"] for h in held]], pa.list_(pa.int32())),
                pa.array([counts], pa.list_(pa.int32())),
                pa.ListArray.from_arrays(pa.array([0, len(named)], pa.int32()), named.indices.cast(pa.int32())),
                pa.ListArray.from_arrays(pa.array([0, len(started)], pa.int32()), started),
                pa.array([done], pa.list_(pa.list_(pa.int32()))),
            ]
            return pa.RecordBatch.from_arrays(lists, ["blocks", "parts", "counts", "places", "words", "done"])

        held, size = [], 0
        for batch in batches:
            for each in batch.to_pylist():
                if size >= ROW_WORDS and each["part"] != held[-1]["part"]:
                    yield row(held)
                    held, size = [], 0
                held.append(each)
                size += len(each["sizes"]) // 4
        if held:
            yield row(held)
        held = []
        give_back()

    return words.repartition("part").sortWithinPartitions("part").mapInArrow(run, FOLD)


def taken(lists: pa.ListArray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the lists at ``places``, one after the other, and the size of each."""
    at, flat = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy()
    sizes = np.diff(at)[places]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(at[:-1][places] - (ends - sizes), sizes)], sizes


def _returned(folds: DataFrame) -> DataFrame:
    """``block``, ``part``, and the ids of its words with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                blocks, parts, counts, places, lists = (batch[c].slice(k, 1).flatten() for c in range(5))
                flat, sizes = taken(lists, places.to_numpy())
                ends = np.concatenate([[0], np.cumsum(counts.to_numpy())])
                id_ends = np.concatenate([[0], np.cumsum(sizes)])[ends]
                ids = [packed(flat[a:b]) for a, b in zip(id_ends[:-1], id_ends[1:])]
                sizes = [packed(sizes[a:b]) for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [blocks, parts, pa.array(ids, pa.binary()), pa.array(sizes, pa.binary())],
                    ["block", "part", "ids", "sizes"],
                )
        give_back()

    return folds.mapInArrow(run, "block bigint, part int, ids binary, sizes binary")


def encode(
    docs: DataFrame, path: str = RANKS_PATH, block_chars: int = BLOCK_CHARS, fold_bytes: int = FOLD_BYTES
) -> DataFrame:
    """``doc_id`` and ``ids`` of every row of ``docs``.

    Every match of the pattern is encoded by itself, without special tokens, whose text is
    plain text here. Null and empty texts have no ids. Repeated rows have equal results.
    Texts of any length are encoded whole; a block ends after the document that fills it.
    Words of more than ``fold_bytes`` bytes are merged by a heap, with the same ids. An
    empty table gives an empty result; further columns are not read. ``docs`` is read once,
    when this is called, and its blocks are written to ``spark.checkpoint.dir``.
    """
    blocks = _bucketed(_split(docs, path, block_chars))
    words = _different(blocks.select("block", F.inline("parts")), path, fold_bytes)

    def word_ids(maps):
        return F.zip_with("words", "done", lambda w, i: F.when(i.isNotNull(), i).otherwise(folded(w, maps)))

    folds = words.select("blocks", "parts", "counts", "places", with_ranks(path, word_ids).alias("word_ids"))
    found = _returned(folds).groupBy("block").agg(F.sort_array(F.collect_list(F.struct("part", "ids", "sizes"))).alias("found"))
    tokens = max(read_ranks(path).values()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                keys, counts = (batch[c].slice(k, 1).flatten() for c in ("doc_ids", "counts"))
                parts = batch["found"][k].as_py() or []
                # a token's code stands for itself, the others follow in the order of the parts
                ids = np.concatenate([np.arange(tokens), *[unpacked(p["ids"]) for p in parts]])
                sizes = np.concatenate([np.ones(tokens, np.int64), *[unpacked(p["sizes"]) for p in parts]])
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
                flat, sizes = taken(lists, unpacked(batch["codes"][k].as_py()))
                word_ends = np.concatenate([[0], np.cumsum(sizes)])
                ends = np.concatenate([[0], np.cumsum(counts.to_numpy())])
                offsets = pa.array(word_ends[ends].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))], ["doc_id", "ids"]
                )
        give_back()

    joined = blocks.select("block", "doc_ids", "counts", "codes").join(found.hint("merge"), "block", "left")
    return joined.mapInArrow(run, "doc_id bigint, ids array<int>")


def decoded(ids: Column, path: str = RANKS_PATH) -> Column:
    """Bytes of ``ids``: the tokens' binary pieces, put together. Null ids give null."""
    ranks = read_ranks(path)
    pieces = [""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token.hex().upper()
    table = F.from_json(F.lit(json.dumps(pieces, separators=(",", ":"))), "array<string>")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), ""))


def with_digest(encoded: DataFrame, path: str = RANKS_PATH) -> DataFrame:
    """Add ``ids_sha256``, the digest of a row's ids in decimal with commas between them."""
    tokens = max(read_ranks(path).values()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimal = pa.array([b"%d," % i for i in range(tokens)], pa.large_binary())
        for batch in batches:
            found = []
            for ids in batch["ids"]:
                text = decimal.take(ids.values)
                size = (pc.sum(pc.binary_length(text)).as_py() or 1) - 1
                found.append(hashlib.sha256(memoryview(text.buffers()[2] or b"")[:size]).hexdigest())
            columns = [batch["doc_id"], batch["ids"], pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "ids_sha256"])
        give_back()

    return encoded.mapInArrow(run, "doc_id bigint, ids array<int>, ids_sha256 string")


def query(spark, sf_dir):
    encoded = with_digest(encode(documents(spark, sf_dir)))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids_sha256",
        F.sha2(decoded(F.col("ids")), 256).alias("decoded_sha256"),
    )
