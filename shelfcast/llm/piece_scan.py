"""SentencePiece encoding and decoding as a max-plus scan.

An encoding is the path of pieces with the largest sum of scores through a text. Giant
documents are cut into chunks at fixed places. A piece may reach over a chunk's end, so
the state between chunks is by how many characters it does. A chunk is then a matrix of
best scores from state to state; matrices combine by (max, +), and once the states are
known every chunk is traced back on its own.

Scores of this kind are whole numbers, and many paths tie. Every piece therefore adds a small number
drawn from its place in its word and its length. Sums then tell tied paths apart in the
same way wherever a text is cut, so ids do not depend on the chunks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.common import documents, each_batch, give_back, key_groups, stage

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 16_384
BLANK = "▁"
WORDS_KEPT = 60_000
CHARS_AT_ONCE = 200_000
DENSE = 255

# A sum is a complex number, which numpy orders by its real part first: the score, and then
# what breaks ties. Scores are multiples of 1 / SCORE_PARTS, so both sums are exact.
SCORE_PARTS = 1024
TIE_PLACES = 4096
TIE_BELOW = 1 << 24
NONE = complex(-np.inf, 0.0)


def read_vocabulary(path: str = MODEL_PATH) -> tuple[tuple[str, float, int], ...]:
    """(piece, score, byte value or -1) by id; control and unknown pieces are empty."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    rows = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            rows.append(("", 0.0, int(piece[3:5], 16)))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            rows.append(("", 0.0, -1))
        else:
            rows.append((piece.replace(BLANK, " "), model.get_score(i), -1))
    return tuple(rows)


class Pieces:
    """A vocabulary as arrays: a trie over characters, scores, and the pieces' bytes.

    The blank stands for the piece mark. The mark itself, and every character without a
    piece, is written as bytes, so any text decodes to itself.
    """

    def __init__(self, rows, encodes: bool = True):
        self.score = np.array([r[1] for r in rows])
        normal = [(p, i) for i, (p, _, _) in enumerate(rows) if p]
        self.longest = max(len(p) for p, _ in normal)
        self.score = np.rint(self.score * SCORE_PARTS) / SCORE_PARTS
        self.unknown = min(self.score[i] for _, i in normal) - 10.0
        self.tie = np.random.default_rng(0).integers(0, TIE_BELOW, (TIE_PLACES, self.longest + 1)).astype(float)
        self.byte_id = np.zeros(256, np.int32)
        self.byte_value = np.array([r[2] for r in rows])
        data = []
        for i, (piece, _, byte) in enumerate(rows):
            if byte >= 0:
                self.byte_id[byte] = i
            data.append(bytes([byte]) if byte >= 0 else piece.encode())
        self.bytes = np.frombuffer(b"".join(data), np.uint8)
        self.bytes_at = np.concatenate([[0], np.cumsum([len(d) for d in data])])
        if not encodes:
            return
        # no piece goes on past a blank that follows something else: words are independent
        self.words_apart = not any(" " in p.lstrip(" ") for p, _ in normal)
        self._trie(normal)
        self.forget()

    def _trie(self, normal):
        nodes, edges, final = [{}], {}, {0: -1}
        used = {}
        for piece, i in normal:
            at = 0
            for c in piece:
                used[c] = used.get(c, 0) + 1
                if c not in nodes[at]:
                    nodes[at][c] = len(nodes)
                    final[len(nodes)] = -1
                    nodes.append({})
                at = nodes[at][c]
            final[at] = i
        order = sorted(used, key=lambda c: (-used[c], c))
        self.chars = np.array(sorted(ord(c) for c in order), np.uint32)
        rank = {ord(c): k + 1 for k, c in enumerate(order)}
        self.char_class = np.array([rank[int(c)] for c in self.chars], np.int32)
        inner = [n for n, kids in enumerate(nodes) if kids]
        row = np.zeros(len(nodes), np.int32)
        row[inner] = np.arange(1, len(inner) + 1)
        self.row = row
        self.dense = np.zeros((len(inner) + 1, DENSE + 1), np.int32)
        rare = {}
        for n in inner:
            for c, to in nodes[n].items():
                k = rank[ord(c)]
                if k <= DENSE:
                    self.dense[row[n], k] = to
                else:
                    rare[int(row[n]) * (len(order) + 1) + k] = to
        self.width = len(order) + 1
        self.rare_key = np.array(sorted(rare), np.int64)
        self.rare_to = np.array([rare[k] for k in sorted(rare)], np.int32)
        self.final = np.array([final[n] for n in range(len(nodes))], np.int32)

    def forget(self):
        """Drop the words solved so far."""
        self.index, self.ids, self.ids_at = {}, np.zeros(0, np.int32), np.zeros(1, np.int64)

    def classes(self, codes):
        at = np.minimum(np.searchsorted(self.chars, codes), len(self.chars) - 1)
        return np.where(self.chars[at] == codes, self.char_class[at], 0)

    def step(self, node, cls):
        """Trie nodes after one more character, 0 where there is none."""
        row = self.row[node]
        out = self.dense[row, np.minimum(cls, DENSE) * (cls <= DENSE)]
        rare = np.nonzero((cls > DENSE) & (row > 0))[0]
        if len(rare) and len(self.rare_key):
            key = row[rare].astype(np.int64) * self.width + cls[rare]
            at = np.minimum(np.searchsorted(self.rare_key, key), len(self.rare_key) - 1)
            out[rare] = np.where(self.rare_key[at] == key, self.rare_to[at], 0)
        return out

    def edges(self, codes, limit):
        """(start, length, id) of every piece in ``codes`` that starts at a character and
        ends by its ``limit``; characters without a piece of their own have id -1."""
        cls = self.classes(codes)
        start = np.nonzero(limit > np.arange(len(codes)))[0].astype(np.int32)
        node = np.zeros(len(start), np.int32)
        single = np.zeros(len(codes), bool)
        parts = []
        for n in range(1, self.longest + 1):
            node = self.step(node, cls[start + n - 1])
            live = node > 0
            start, node = start[live], node[live]
            if not len(start):
                break
            ids = self.final[node]
            full = ids >= 0
            parts.append((start[full], np.full(full.sum(), n, np.int32), ids[full]))
            if n == 1:
                single[start[full]] = True
            more = limit[start] > start + n
            start, node = start[more], node[more]
        lone = np.nonzero(~single & (limit > np.arange(len(codes))))[0].astype(np.int32)
        parts.append((lone, np.ones(len(lone), np.int32), np.full(len(lone), -1, np.int32)))
        return tuple(np.concatenate(x) for x in zip(*parts))

    def edge_scores(self, ids, place, length):
        """What pieces add to a path: their score, and a number of their place in the word."""
        out = np.empty(len(ids), np.complex128)
        out.real = np.where(ids >= 0, self.score[ids], self.unknown)
        out.imag = self.tie[place % TIE_PLACES, length]
        return out

    def solve(self, words: list[str]):
        """Ids of the best path of each word: one array, and where each word's begin."""
        lengths = np.array([len(w) for w in words])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        ends = np.cumsum(lengths)
        begins = ends - lengths
        start, length, ids = self.edges(codes, np.repeat(ends, lengths))
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)[start]
        # edges by depth in their word, then by length, as one number, short where it fits
        step = (start - begins[word]) * (self.longest + 1) + length
        if step.max() < 1 << 16:
            step = step.astype(np.uint16)
        order = np.argsort(step, kind="stable")
        start, length, ids, word, step = (x[order] for x in (start, length, ids, word, step))
        score = self.edge_scores(ids, start - begins[word], length)
        # a word of n characters has n + 1 places
        source = start + word
        del word, order
        best = np.full(len(codes) + len(words), NONE)
        back = np.full(len(best), -1, np.int32)
        best[begins + np.arange(len(words))] = 0.0
        group = np.nonzero(step[1:] != step[:-1])[0] + 1
        for a, b in zip(np.concatenate([[0], group]), np.concatenate([group, [len(start)]])):
            target = source[a:b] + length[a]
            total = best[source[a:b]] + score[a:b]
            better = np.nonzero(total > best[target])[0]
            best[target[better]] = total[better]
            back[target[better]] = a + better
        at, alive = ends + np.arange(len(words)), np.arange(len(words))
        steps = []
        while True:
            edge = back[at]
            going = edge >= 0
            at, alive, edge = at[going], alive[going], edge[going]
            if not len(edge):
                break
            steps.append((alive, edge))
            at = source[edge]
        owner = np.concatenate([s[0] for s in steps])
        chosen = np.concatenate([s[1] for s in steps])
        order = np.argsort(start[chosen], kind="stable")
        owner, chosen = owner[order], chosen[order]
        return self.spelled(ids[chosen], codes[start[chosen]], owner, len(words))

    def spelled(self, ids, codes, owner, owners):
        """Ids with characters that have no piece written as bytes, and where owners begin."""
        lone = ids < 0
        size = np.ones(len(ids), np.int64)
        size[lone] = 1 + (codes[lone] >= 0x80) + (codes[lone] >= 0x800) + (codes[lone] >= 0x10000)
        out = np.repeat(ids, size).astype(np.int32)
        if lone.any():
            raw = np.frombuffer("".join(map(chr, codes[lone])).encode(), np.uint8)
            out[np.repeat(lone, size)] = self.byte_id[raw]
        counts = np.bincount(owner, weights=size, minlength=owners).astype(np.int64)
        return out, np.concatenate([[0], np.cumsum(counts)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; words are solved once and remembered up to a bound."""
        if len(self.index) > WORDS_KEPT:
            self.forget()
        cut = (r" +[^ ]*|[^ ]+" if self.words_apart else r"(?s).+")
        lists = [re.findall(cut, " " + t) if t else [] for t in texts]
        new = list(dict.fromkeys(w for words in lists for w in words if w not in self.index))
        if new:
            ids, at = self.solve(new)
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            self.ids_at = np.concatenate([self.ids_at, at[1:] + len(self.ids)])
            self.ids = np.concatenate([self.ids, ids])
        index = self.index
        return [self._put_together(np.array([index[w] for w in words], np.int64)) for words in lists]

    def _put_together(self, words):
        return gathered(self.ids, self.ids_at, words)

    def decode(self, ids: np.ndarray) -> str:
        raw = gathered(self.bytes, self.bytes_at, np.asarray(ids, np.int64)).tobytes()
        return raw[1:].decode("utf-8", errors="replace")

    def chunk(self, window: str, inside: int, begun: int) -> dict:
        """What a chunk of ``inside`` characters, of which ``window`` has some more, hands
        on: its transfer matrix, the ids between its first and last place between words,
        and the stretches before and after these. ``begun`` characters of its first word
        lie in earlier chunks.

        The matrix has the best sum from ``i`` characters in to ``j`` characters beyond, up
        to one number that all its entries share: all paths pass the places between words,
        so what lies between the first and the last is the same for all. A chunk without
        such a place is one stretch.
        """
        first, last = self._places(window, inside)
        if first is None:
            matrix = self._lanes(window, inside, begun)[0]
            return {"matrix": matrix, "head": window, "n_head": inside, "tail": "", "n_tail": -1, "middle": self.ids[:0]}
        head = self._lanes(window[:first], first, begun)[0][:, 0]
        tail = self._lanes(window[last:], inside - last, 0)[0][0]
        return {
            "matrix": head[:, None] + tail[None, :],
            "head": window[:first],
            "n_head": first,
            "tail": window[last:],
            "n_tail": inside - last,
            "middle": self.encode_words(window[first:last]),
        }

    def trace(self, head, n_head, tail, n_tail, begun, middle, came: int, left: int) -> np.ndarray:
        """Ids of a chunk's pieces, from ``came`` characters in to ``left`` beyond."""
        if n_tail < 0:
            return self._traced(head, n_head, begun, came, left)
        return np.concatenate(
            [self._traced(head, n_head, begun, came, 0), middle, self._traced(tail, n_tail, 0, 0, left)]
        )

    def encode_words(self, text: str) -> np.ndarray:
        """Ids of a stretch that begins at a blank, which is its own first blank."""
        return self.encode([text[1:]])[0] if text[1:] else self.solve([text])[0] if text else self.ids[:0]

    def begun(self, text: str, cuts) -> list[int]:
        """How many characters before each cut its word began."""
        if not self.words_apart:
            return list(cuts)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        blank = codes == ord(" ")
        starts = np.nonzero(blank & ~np.concatenate([[False], blank[:-1]]))[0]
        at = np.searchsorted(starts, np.array(cuts), "right") - 1
        return [int(c - starts[k]) if k >= 0 else int(c) for c, k in zip(cuts, at)]

    def _places(self, window, inside):
        """First and last place between words inside the chunk, or None twice."""
        if not self.words_apart:
            return None, None
        found = [m.start() for m in re.finditer("(?<=[^ ]) ", window[:inside])]
        return (found[0], found[-1]) if found else (None, None)

    def _lanes(self, window, inside, begun):
        """Best sums by entry and exit of a stretch, and what to trace back from."""
        size = self.longest
        codes = np.frombuffer(window.encode("utf-32-le"), np.uint32)
        limit = np.where(np.arange(len(codes)) < inside, len(codes), 0)
        start, length, ids = self.edges(codes, limit)
        order = np.argsort(start, kind="stable")
        start, length, ids = start[order], length[order], ids[order]
        place = np.arange(len(codes)) + begun
        if self.words_apart:
            blank = codes == ord(" ")
            starts = np.nonzero(blank[1:] & ~blank[:-1])[0] + 1
            word = np.searchsorted(starts, np.arange(len(codes)), "right")
            place = np.where(word > 0, np.arange(len(codes)) - np.concatenate([[0], starts])[word], place)
        score = self.edge_scores(ids, place[start], length)
        best = np.full((inside + size, size), NONE)
        back = np.full((inside + size, size), -1, np.int64)
        lanes = np.arange(min(size, inside + size))
        best[lanes, lanes] = 0.0
        first = np.searchsorted(start, np.arange(inside + 1))
        for p in range(inside):
            for e in range(first[p], first[p + 1]):
                total = best[p] + score[e]
                to = p + length[e]
                better = total > best[to]
                best[to, better] = total[better]
                back[to, better] = e
        return best[inside : inside + size].T.copy(), (start, ids, codes, back)

    def _traced(self, window, inside, begun, came, left):
        _, (start, ids, codes, back) = self._lanes(window, inside, begun)
        at, chosen = inside + left, []
        while at > came:
            e = back[at, came]
            chosen.append(e)
            at = start[e]
        chosen = np.array(chosen[::-1], np.int64)
        if not len(chosen):
            return np.zeros(0, np.int32)
        return self.spelled(ids[chosen], codes[start[chosen]], np.zeros(len(chosen), np.int64), 1)[0]


def gathered(values, at, chosen):
    """``values[at[c]:at[c + 1]]`` of every chosen c, one after the other."""
    if not len(chosen):
        return values[:0]
    sizes = at[chosen + 1] - at[chosen]
    ends = np.cumsum(sizes)
    return values[np.arange(ends[-1]) + np.repeat(at[chosen] - (ends - sizes), sizes)]


def combined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two transfer matrices."""
    return (a[:, :, None] + b[None, :, :]).max(1)


def boundary_states(matrices: list[np.ndarray]) -> list[int]:
    """States before, between and after the chunks on the best path.

    One pass takes the first row of the products of all beginnings, so a chunk costs a row
    times a matrix; the way back picks at each boundary the state that the best end came
    from. Rows are brought down to their largest entry, so that sums stay small in texts of
    any length. The last chunk must end exactly.
    """
    size = len(matrices[0])
    row = np.full((1, size), NONE)
    row[0, 0] = 0
    front = [row]
    for m in matrices:
        row = combined(front[-1], m)
        front.append(row - row.max())
    states, at = [0], 0
    for m, f in zip(reversed(matrices), reversed(front[:-1])):
        at = int(np.argmax(f[0] + m[:, at]))
        states.append(at)
    return states[::-1]


@lru_cache(maxsize=2)
def pieces(path: str, encodes: bool = True) -> Pieces:
    """The vocabulary's arrays, built once in each worker; decoding needs no trie."""
    return Pieces(read_vocabulary(path), encodes)


def _in_parts(texts: pa.Array) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        t = text.as_py() or ""
        part.append(t)
        size += len(t)
        if size > CHARS_AT_ONCE:
            yield part
            part, size = [], 0
    if part:
        yield part


def _id_lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def encode(docs: DataFrame, model_path: str = MODEL_PATH, chunk: int = CHUNK) -> DataFrame:
    """``doc_id`` and ``ids`` of every row of ``docs``.

    A blank is put before the text, as the model asks. Null and empty texts have no ids.
    Ties between paths are broken by where pieces stand in their words, the same in every
    run and at any ``chunk``. Repeated rows have equal results. Texts above ``chunk``
    characters are cut, at any place, and their chunks are spread over tasks. Further
    columns are not read.
    """
    docs = docs.select("doc_id", "text")

    def whole(batches):
        coder = pieces(model_path)
        for batch in batches:
            done = 0
            for part in _in_parts(batch["text"]):
                ids = _id_lists(coder.encode(part))
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(done, len(part)), ids], ["doc_id", "ids"])
                done += len(part)
        coder.forget()
        give_back()

    long = F.length("text") > chunk
    small = docs.where(~F.coalesce(long, F.lit(False))).mapInArrow(whole, "doc_id long, ids array<int>")
    return small.unionAll(_encode_giants(docs.where(long), model_path, chunk))


def _encode_giants(docs: DataFrame, path: str, chunk: int) -> DataFrame:
    def split(batches):
        for batch in batches:
            coder = pieces(path)
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                text = " " + text
                cuts = range(0, len(text), chunk)
                windows = [text[c : c + chunk + coder.longest - 1] for c in cuts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc_id] * len(windows), pa.int64()),
                        pa.array(range(len(windows)), pa.int32()),
                        pa.array([min(chunk, len(text) - c) for c in cuts], pa.int32()),
                        pa.array(coder.begun(text, cuts), pa.int32()),
                        pa.array(windows),
                    ],
                    ["doc_id", "chunk", "inside", "begun", "window"],
                )

    # rows may share an id: a name of id and text stands for it until the end
    docs = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("doc_id", "text").alias("doc_id"), "text")
    kind = "doc_id long, chunk int, inside int, begun int, window string"
    chunks = docs.select("doc_id", "text").distinct().mapInArrow(split, kind).repartition("doc_id", "chunk")

    def transfer(batch):
        coder = pieces(path)
        fields = zip(*(batch[c].to_pylist() for c in ("window", "inside", "begun")))
        made = [coder.chunk(*f) for f in fields]
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                batch["chunk"],
                batch["begun"],
                *[pa.array([m[c] for m in made]) for c in ("head", "tail")],
                *[pa.array([m[c] for m in made], pa.int32()) for c in ("n_head", "n_tail")],
                _id_lists([m["middle"] for m in made]),
                pa.array([m["matrix"].tobytes() for m in made], pa.binary()),
            ],
            ["doc_id", "chunk", "begun", "head", "tail", "n_head", "n_tail", "middle", "matrix"],
        )

    kind = (
        "doc_id long, chunk int, begun int, head string, tail string, n_head int, n_tail int, "
        "middle array<int>, matrix binary"
    )
    passed = stage(each_batch(chunks, transfer, kind), "transfer")
    size = pieces(path, False).longest

    def settle(table):
        order = np.argsort(table["chunk"].to_numpy())
        blobs = table["matrix"].to_pylist()
        found = boundary_states([np.frombuffer(blobs[k], np.complex128).reshape(size, size) for k in order])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([table["doc_id"][0].as_py()] * len(order), pa.int64()),
                pa.array(range(len(order)), pa.int32()),
                pa.array(found[:-1], pa.int32()),
                pa.array(found[1:], pa.int32()),
            ],
            ["doc_id", "chunk", "came", "left"],
        )

    states = key_groups(
        passed.select("doc_id", "chunk", "matrix"), ["doc_id"], settle, "doc_id long, chunk int, came int, left int"
    )

    def trace(batch):
        coder = pieces(path)
        texts = [batch[c].to_pylist() for c in ("head", "n_head", "tail", "n_tail", "begun")]
        states = [batch[c].to_pylist() for c in ("came", "left")]
        ids = [coder.trace(*f) for f in zip(*texts, _lists(batch["middle"]), *states)]
        return pa.RecordBatch.from_arrays([batch["doc_id"], batch["chunk"], _id_lists(ids)], ["doc_id", "chunk", "ids"])

    placed = passed.drop("matrix").join(states, ["doc_id", "chunk"])
    traced = each_batch(placed, trace, "doc_id long, chunk int, ids array<int>")
    joined = traced.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("_parts"))
    whole = joined.select("doc_id", F.flatten("_parts.ids").alias("ids"))
    return docs.select("doc_id", "_id").join(whole, "doc_id").select(F.col("_id").alias("doc_id"), "ids")


def decode(encoded: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """``doc_id``, ``ids`` and the ``text`` they stand for. Null ids decode to null."""

    def work(batch):
        coder = pieces(model_path, False)
        flat = [None if i is None else coder.decode(np.array(i, np.int64)) for i in _lists(batch["ids"])]
        return pa.RecordBatch.from_arrays([batch["doc_id"], batch["ids"], pa.array(flat, pa.string())], ["doc_id", "ids", "text"])

    return each_batch(encoded.select("doc_id", "ids"), work, "doc_id long, ids array<int>, text string")


def _lists(column: pa.ListArray):
    """The lists as numpy arrays, without making Python numbers."""
    flat = column.values.to_numpy(zero_copy_only=False)
    at = column.offsets.to_numpy()
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    return [flat[a:b] if ok else None for a, b, ok in zip(at[:-1], at[1:], valid)]


def query(spark, sf_dir):
    decoded = decode(encode(documents(spark, sf_dir)))
    return decoded.select(
        "doc_id",
        F.size("ids").alias("n_tokens"),
        F.xxhash64("ids").alias("ids_hash"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
