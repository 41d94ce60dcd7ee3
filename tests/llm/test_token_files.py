from __future__ import annotations

import heapq
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from gaugeline.llm import bpe, token_files as tf


def huffman_cost(counts):
    heap = list(counts)
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a + b
        heapq.heappush(heap, a + b)
    return cost


def limited_cost(counts, limit):
    """The least cost of any code of at most ``limit`` bits, by trying all length sequences (for few symbols)."""
    counts = sorted(counts, reverse=True)
    best = None

    def grow(lengths, left):
        nonlocal best
        if len(lengths) == len(counts):
            cost = sum(c * n for c, n in zip(counts, lengths))
            best = cost if best is None else min(best, cost)
            return
        for n in range(lengths[-1] if lengths else 1, limit + 1):
            if left >= 2 ** (limit - n):
                grow([*lengths, n], left - 2 ** (limit - n))

    grow([], 2**limit)
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10_000), min_size=2, max_size=7), st.integers(3, 5))
def test_lengths_are_optimal_under_the_limit(counts, limit):
    lengths = tf.code_lengths(np.array(counts), limit)
    assert lengths.max() <= limit and sum(2.0 ** -lengths.astype(float)) <= 1
    assert int((lengths * np.array(counts)).sum()) == limited_cost(counts, limit)


def test_without_a_binding_limit_it_is_huffman():
    counts = np.random.default_rng(1).zipf(1.5, 3000).clip(1, 10**9)
    assert int((tf.code_lengths(counts, 40).astype(np.int64) * counts).sum()) == huffman_cost(counts.tolist())
    tight = tf.code_lengths(counts, 12)
    assert tight.max() == 12 and sum(2.0 ** -tight.astype(float)) == 1
    with pytest.raises(ValueError):
        tf.code_lengths(counts, 11)


def test_codes_are_canonical():
    book = tf.make_codebook({5: 100, 9: 3, 2: 50, 7: 3, 1: 40})
    codes = [(int(book.bits[i]), int(book.codes[i])) for i in book.order]
    assert codes == sorted(codes) and codes[0][1] == 0
    for (la, a), (lb, b) in zip(codes, codes[1:]):
        assert b == (a + 1) << (lb - la)
    again = tf.Codebook.load(book.dump())
    assert np.array_equal(again.codes, book.codes) and np.array_equal(again.bits, book.bits)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=700), st.sampled_from([1, 7, 64, 512]), st.integers(9, 25))
def test_bits_come_back(ids, every, limit):
    counts = {i: ids.count(i) for i in set(ids)}
    book, ids = tf.make_codebook(counts, limit), np.array(ids, np.uint32)
    data, checkpoints = tf.put_bits(ids, book, every)
    assert len(checkpoints) == -(-len(ids) // every)
    assert len(data) == (sum(int(book.bits[i]) for i in ids) + 7) // 8
    assert np.array_equal(tf.get_bits(data, len(ids), checkpoints, book.table(), book.longest, every), ids)


def test_a_block_never_holds_the_separator():
    end = tf.SEPARATOR.encode()
    for body in (end * 3, b"x" + end, end[:-1], bytes(b ^ 1 for b in end) + end, b""):
        out = tf.masked(body)
        assert end not in out and (out + end).index(end) == len(out) and tf.unmasked(out) == body
    assert all(not end.startswith(end[k:]) for k in range(1, len(end)))


def test_damage_is_noticed():
    book = tf.make_codebook({1: 3, 2: 1})
    block = bytearray(tf.put_block([4], [np.array([1, 1, 2, 1])], 0, 0, book))
    assert tf.get_block(bytes(block), book, book.table())[4].tolist() == [1, 1, 2, 1]
    with pytest.raises(ValueError):
        tf.get_block(bytes(block), tf.make_codebook({1: 3, 2: 1, 3: 1}), book.table())
    block[30] ^= 4
    with pytest.raises(ValueError):
        tf.get_block(bytes(block), book, book.table())


def texts():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefé日 \n'") for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    out = [None, "", " ", "=ids-block\n" * 40, "<|endoftext|> x", "long " * 60_000]
    return out + [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 200))) for _ in range(120)]


def expected(library, rows):
    """Rows in order of ids, by the library alone: place, number of ids and crc of each."""
    at, out = 0, []
    made = [(i, [*library.encode(t or "", add_special_tokens=False).ids, tf.END_ID]) for i, t in rows]
    for i, ids in sorted(made, key=lambda r: (r[0] is not None, r[0])):
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("block_ids, file_ids", [(1 << 18, 1 << 26), (50, 500), (1, 3000)])
def test_files_equal_the_library(spark, documents, tmp_path, block_ids, file_ids):
    library = Tokenizer.from_file(bpe.default_tokenizer())
    given_texts = texts()
    ids = random.Random(2).sample(range(-50, 10**12), len(given_texts))
    docs = documents(given_texts, ids)
    path = str(tmp_path / "ids")
    tf.write(tf.token_rows(docs), path, block_ids=block_ids, file_ids=file_ids)
    small = spark.newSession()
    small.conf.set("spark.sql.files.maxPartitionBytes", "3000")  # splits that begin inside blocks
    for session in (spark, small):
        rows = tf.read(session, path, ids=True).collect()
        assert sorted((tuple(r)[:4] for r in rows), key=lambda r: r[1]) == expected(library, list(zip(ids, given_texts)))
    by_id = {r["doc_id"]: r["ids"] for r in rows}
    assert all(by_id[i] == [*library.encode(t or "", add_special_tokens=False).ids, tf.END_ID] for i, t in zip(ids, given_texts))


def test_equal_and_missing_ids(spark, documents):
    library = Tokenizer.from_file(bpe.default_tokenizer())
    rows = [(None, "x y"), (None, None), *[(7, "the same text")] * 50, (7, "another"), (3, ""), (9, None)]
    got = sorted(tuple(r) for r in tf.roundtrip(documents([t for _, t in rows], [i for i, _ in rows])).select("start", "doc_id", "n_tokens", "ids_crc32").collect())
    want = expected(library, rows)
    assert [r[1] for r in got] == [r[0] for r in want]
    ends = [0, *np.cumsum([r[2] for r in got]).tolist()]
    assert [r[0] for r in got] == ends[:-1] and ends[-1] == want[-1][1] + want[-1][2]
    assert sorted((r[1] is not None, r[1] or 0, r[2], r[3]) for r in got) == sorted((r[0] is not None, r[0] or 0, r[2], r[3]) for r in want)


def test_no_documents(spark, documents):
    assert tf.roundtrip(documents([])).collect() == []
