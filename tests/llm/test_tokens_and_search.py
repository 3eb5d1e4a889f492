"""The tokenizing operators and the ranked search against libraries and brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import tiktoken
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import __spark_entry__ as entry
from shelfcast.llm import byte_pairs, mask_search, piece_scan, token_links

RUN = "zq" * 900
ODD = [(1, None), (2, ""), (3, " \n\t  x"), (4, "same text <|endoftext|> <s> here"), (4, "same text <|endoftext|> <s> here"),
       (5, "naïve 日本語 ▁mark\U00030fffᲉ ١٢٣ don't"), (6, RUN + " end " + "9" * 700), (7, "a" * 3000), (None, "lost words")]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def coder():
    return tiktoken.Encoding(
        "own", pat_str=byte_pairs.PATTERN, mergeable_ranks=byte_pairs.read_ranks(), special_tokens={}
    )


def test_byte_pairs_as_the_library(spark, sf_dir, llm_documents, coder):
    texts = {r["doc_id"]: r["text"] or "" for r in llm_documents.select("doc_id", "text").collect()}
    found = entry.queries()["op13_byte_pairs"](spark, sf_dir).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = coder.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(",".join(map(str, ids))))
        assert r["decoded_sha256"] == sha(texts[r["doc_id"]])


@pytest.mark.parametrize("options", [{}, {"block_chars": 1}, {"fold_bytes": 4}])
def test_byte_pairs_of_odd_texts(spark, make_docs, coder, options):
    found = byte_pairs.encode(make_docs(ODD), **options)
    rows = [(r["doc_id"], r["ids"]) for r in found.collect()]
    wanted = [(i, coder.encode_ordinary(t or "")) for i, t in ODD]
    assert sorted(rows, key=str) == sorted(wanted, key=str)
    assert byte_pairs.encode(make_docs(ODD).limit(0)).count() == 0
    if not options:
        decoded = found.select("doc_id", byte_pairs.decoded(found["ids"]).alias("raw")).collect()
        assert sorted((str(r["doc_id"]), bytes(r["raw"])) for r in decoded) == sorted((str(i), (t or "").encode()) for i, t in ODD)


def test_heap_merges_like_the_library(coder):
    rng = random.Random(4)
    ranks = byte_pairs.read_ranks()
    for k in range(300):
        word = "".join(rng.choice("aeinorstlé") for _ in range(rng.randrange(1, 80)))
        assert byte_pairs.merged_by_heap(word.encode(), ranks) == coder._encode_single_piece(word)


def links_by_hand(texts):
    """Tokens, groups and links of every text, walking both token lists."""
    side_a = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    side_a.encode_special_tokens = True
    side_b = SentencePieceProcessor(model_file=token_links.PIECE_PATH)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    letters |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in printable)}
    made = []
    for text in texts:
        a = side_a.encode(" " + text, add_special_tokens=False) if text else None
        b = side_b.encode(text) if text else []
        size_a = [bytes(letters[c] for c in t) for t in a.tokens] if a else []
        size_b = [bytes([int(side_b.id_to_piece(i)[3:5], 16)]) if side_b.is_byte(i) else side_b.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(size_a) != whole or b"".join(size_b) != whole:
            made.append(([], [], [], []))
            continue
        spans = []
        for ids, parts in ((a.ids, size_a), (b, size_b)):
            ends = np.cumsum([len(p) for p in parts])
            spans.append([(int(e) - len(p), int(e), i) for p, e, i in zip(parts, ends, ids)])
        common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, links, begin = [], [], 0
        for end in common:
            own = [[x for x in s if begin <= x[0] and x[1] <= end] for s in spans]
            groups.append("|".join(",".join(str(x[2]) for x in side) for side in own))
            links += [(x[2], y[2]) for x in own[0] for y in own[1] if x[0] < y[1] and y[0] < x[1]]
            begin = end
        made.append((a.ids, b, groups, links))
    return made


def check_links(found, rows):
    made = links_by_hand([t for _, t in rows])
    count = Counter(p for m in made for p in m[3])
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    wanted = [
        (i, len(a), len(b), len(g), len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), sha(";".join(g)) if g else "")
        for (i, _), (a, b, g, links) in zip(rows, made)
    ]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, wanted))


def test_token_links_by_hand(spark, sf_dir, llm_documents):
    rows = [(r["doc_id"], r["text"]) for r in llm_documents.select("doc_id", "text").collect() if len(r["text"] or "") < 6000]
    docs = llm_documents.where("length(text) < 6000 OR text IS NULL")
    check_links(token_links.align(docs, block_chars=20_000), rows)


def test_token_links_of_odd_texts(spark, make_docs):
    check_links(token_links.align(make_docs(ODD)), ODD)
    check_links(token_links.align(make_docs(ODD), block_chars=1), ODD)
    assert token_links.align(make_docs(ODD).limit(0)).count() == 0


def ranked_by_hand(docs, items, top):
    word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = [(i, Counter(word.findall((t or "").translate(lower)))) for i, t in docs]
    held = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(word.findall((text or "").translate(lower)))
    rows = []
    for item, terms in asked.items():
        scored = []
        for i, c in held:
            m = 50 + (50 * c.total() * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in terms if c[t]
            )
            if score > 0 and i is not None:
                scored.append((-score, i))
        rows += [(item, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scored)[:top])]
    return sorted(rows)


ITEM = "item_id long, text string, score string"


def test_search_by_hand(spark, make_docs, monkeypatch):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(40)] + ["É", "ß9", "THE"]
    docs = [(k, " ".join(rng.choices(words, weights=[1 / (j + 1) for j in range(len(words))], k=rng.randrange(1, 60)))) for k in range(300)]
    docs += [(300, None), (301, ""), (302, "--"), (303, "The w1 the"), (303, "The w1 the"), (304, "w39 " * 5000), (None, "w38 w38")]
    items = [(k, ", ".join(rng.sample(words, 9))) for k in range(12)] + [(12, None), (13, ""), (14, "nowhere"), (15, " ".join(words) + " " + " ".join(f"x{k}" for k in range(90))), (0, "w39")]
    table = spark.createDataFrame([(*i, "clash") for i in items], ITEM)
    wanted = ranked_by_hand(docs, items, 50)
    assert sorted(map(tuple, mask_search.search(make_docs(docs), table).collect())) == wanted
    # several rounds of items give the same
    assert sorted(map(tuple, mask_search.search(make_docs(docs), table, terms_at_once=150).collect())) == wanted
    assert sorted(map(tuple, mask_search.search(make_docs(docs), table, top=3).collect())) == ranked_by_hand(docs, items, 3)
    assert mask_search.search(make_docs(docs).limit(0), table).count() == 0
    assert mask_search.search(make_docs(docs), table.limit(0)).count() == 0


def test_search_leaves_groups_out():
    """Groups whose maximum lies below the last place are never scored."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    lists = [sorted(set(rng.integers(0, 30, 6).tolist()) | ({30, 31} if k < 40 else set())) for k in range(4000)]
    terms = pa.array(lists, pa.list_(pa.int32()))
    ones = pa.array([[1] * len(x) for x in lists], pa.list_(pa.int32()))
    weights = np.array([50] * 30 + [9000, 9000])
    block = mask_search.Block(np.arange(4000), np.full(4000, 6), terms, ones, weights, 4000, 24000)
    found, _, done = block.best(np.arange(32), 20)
    assert done < 400 and set(found) <= set(range(40))


def test_sentence_pieces_hash_every_id(spark, sf_dir, llm_documents):
    """The registered query's ids, worked out text by text with a coder of its own."""
    own = piece_scan.Pieces(piece_scan.read_vocabulary())
    rows = llm_documents.select("doc_id", "text").collect()
    ids = spark.createDataFrame([(r[0], own.encode([r[1] or ""])[0].tolist()) for r in rows], "doc_id long, ids array<int>")
    hashed = {r[0]: (r[1], r[2]) for r in ids.selectExpr("doc_id", "size(ids)", "xxhash64(ids)").collect()}
    found = entry.queries()["op9_sentencepiece"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_hash"]) for r in found} == hashed


def test_byte_pair_tasks_build_no_rank_maps():
    """A task starts from the ranks of pairs of bytes; the rank literal is the driver's."""
    from shelfcast.llm import byte_pairs

    byte_pairs.pair_ranks.cache_clear()
    table = byte_pairs.byte_pair_ranks()
    ranks = byte_pairs.read_ranks()
    pairs = {t: r for t, r in ranks.items() if len(t) == 2}
    assert (table >= 0).sum() == len(pairs) and all(table[t[0], t[1]] == r for t, r in pairs.items())
    assert byte_pairs.pair_ranks.cache_info().currsize == 0


def test_words_of_many_blocks_are_folded_once(make_docs):
    """Each word that is no token is folded once in the whole table, and blocks stay where they are."""
    texts = [f"qzxvword{i % 7} qzxvtail{i % 5}" for i in range(60)]
    docs = make_docs(list(enumerate(texts)))
    blocks = byte_pairs._bucketed(byte_pairs._split(docs, byte_pairs.RANKS_PATH, 1))
    assert blocks.count() == len(texts)
    words = blocks.selectExpr("block", "inline(parts)")
    folds = byte_pairs._different(words, byte_pairs.RANKS_PATH, byte_pairs.FOLD_BYTES)
    # pieces of the pattern: a word, a number, a blank and a word, a number
    assert folds.selectExpr("sum(size(words)) AS n").collect()[0]["n"] == 2
    assert folds.selectExpr("sum(size(places)) AS n").collect()[0]["n"] == 2 * len(texts)
    plan = byte_pairs.encode(docs, block_chars=1)._jdf.queryExecution().executedPlan().toString()
    # the words go out and their ids come back; codes and texts are not moved
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(moved) == 2 and not any("codes" in line for line in moved)


def test_numbers_are_packed_and_read_again():
    for numbers in ([], [0], [1, 255, 256, 70_000, 2**32 - 1]):
        assert byte_pairs.unpacked(byte_pairs.packed(np.array(numbers, np.int64))).tolist() == numbers
