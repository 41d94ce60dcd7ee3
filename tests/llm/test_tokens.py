from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gaugeline.llm import bpe, packing


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_tokenizer())


def texts():
    rng = random.Random(5)
    shared = " ".join("".join(rng.choice("abcdeé日 ") for _ in range(9)) for _ in range(600))
    out = [None, "", " ", "a", "a" * 9000, " " * 5000, "<|endoftext|>" * 300, "x <|endoftext|> y", "\n\n a  b\t\tc don't we'll 'S    x" * 60, "؀ؐ ع", "\U0001f600 z"]
    out += [words(rng, 200) + shared + words(rng, 100) for _ in range(4)] + [shared, shared, shared[:2000] + "!" + shared[2000:]]
    return out


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij\n'3") for _ in range(rng.randrange(1, 9))) for _ in range(n)) + " "


def test_ids_and_text_equal_the_library(documents, library):
    given = texts()
    rows = {r["doc_id"]: r for r in bpe.encode(documents(given)).collect()}
    assert len(rows) == len(given) and sum(r["n_reused"] for r in rows.values()) > 20
    for i, text in enumerate(given):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert rows[i]["n_tokens"] == len(ids), text
        assert rows[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_any_cut_is_repaired(library):
    own, rng = bpe.codec(bpe.default_tokenizer()), random.Random(6)
    for text in (t for t in texts() if t):
        cuts = sorted({0, len(text), *(rng.randrange(len(text) + 1) for _ in range(12))})
        pieces = [bpe.piece(text[a:b], own) for a, b in zip(cuts, cuts[1:])]
        assert bpe.join(pieces, own).tolist() == library.encode(text, add_special_tokens=False).ids


def test_windows_widen_until_they_agree(library):
    own = bpe.codec(bpe.default_tokenizer())
    left, right = bpe.piece("one two three four", own), bpe.piece(" five six seven eight", own)
    left.ids, right.ids = left.ids + 1, right.ids + 1  # stored ids that are wrong at the edges
    assert bpe.join([left, right], own).tolist() == library.encode("one two three four five six seven eight", add_special_tokens=False).ids


def test_borders_shift_with_the_text():
    rng = random.Random(7)
    body = words(rng, 4000).encode()
    a, b = bpe.borders(body), bpe.borders(b"some more words in front " + body)
    assert len(set(a[1:]) & {x - 25 for x in b}) >= len(a) - 3


def test_decode_rows(spark):
    rows = bpe.decode(spark.createDataFrame([(1, [31373, 995]), (2, []), (3, None)], "k int, ids array<int>")).orderBy("k").collect()
    assert [r["decoded"] for r in rows] == ["hello world", "", None]


def test_repeated_and_null_ids_and_empty_table(documents):
    assert bpe.encode(documents(["a b", "a b", "c"], [1, 1, None])).count() == 3
    assert bpe.encode(documents([])).count() == 0


def check_packing(rows, given, library, tokens, segments, loss):
    ids_of = {i: np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for i, t in enumerate(given)}
    sequences, placed = {}, Counter()
    for r in rows:
        ids = ids_of[r["doc_id"]]
        part = ids[r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] > 0 and zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids)
        placed.update((r["doc_id"], k) for k in range(r["start"], r["start"] + r["length"]))
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert len(placed) == sum(map(len, ids_of.values())) and set(placed.values()) <= {1}
    for own in sequences.values():
        own.sort(key=lambda r: r["offset"])
        assert own[0]["offset"] == 0 and all(a["offset"] + a["length"] == b["offset"] for a, b in zip(own, own[1:]))
        assert sum(r["length"] for r in own) <= tokens and len(own) <= segments and sum(r["loss"] for r in own) <= loss
    return sequences


def test_packing_keeps_every_id_and_all_limits(documents, library):
    rng = random.Random(8)
    given = [None, "", *(words(rng, rng.randrange(1, 400)) for _ in range(60)), words(rng, 3000)]
    docs = documents(given)
    rows = packing.sequences(docs).collect()
    sequences = check_packing(rows, given, library, 1024, 64, 1024)
    assert sum(r["length"] for r in rows) / (1024 * len(sequences)) > 0.95
    tight = packing.sequences(docs, tokens=256, segments=3, loss=128).collect()
    check_packing(tight, given, library, 256, 3, 128)


def test_packing_of_odd_tables(documents):
    same = packing.sequences(documents(["x y z"] * 50, [None] * 50)).collect()
    assert len(same) == 50 and len({(r["sequence_id"], r["offset"]) for r in same}) == 50
    assert packing.sequences(documents([])).count() == 0


def test_the_loss_limit_binds_on_conversations(spark, library):
    """Turns of the assistant alone bear loss; with a limit below what a sequence could hold, it decides where sequences end."""
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select(F.monotonically_increasing_id().alias("doc_id"), F.when(F.col("role") == "assistant", F.concat(F.lit("A "), "text")).otherwise(F.concat(F.lit("U "), "text")).alias("text"))
    given = {r["doc_id"]: r["text"] for r in turns.collect()}
    bears = lambda text, ids: np.full(len(ids), text.startswith("A "))
    used = {}
    for loss in (None, 200):
        rows = packing.sequences(turns, loss=loss, loss_share=bears).collect()
        own: dict = {}
        for r in rows:
            n, total = own.get(r["sequence_id"], (0, 0))
            own[r["sequence_id"]] = n + r["loss"], total + r["length"]
        assert sum(t for _, t in own.values()) == sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for t in given.values())
        used[loss] = len(own), max(n for n, _ in own.values())
    assert used[None][1] > 200 >= used[200][1] and used[200][0] > used[None][0]


def test_one_text_per_id_in_the_sample(spark, documents):
    from gaugeline.llm.common import labelled_sample

    docs = documents(["a"] * 500 + ["b", "c"], [7] * 501 + [8])
    labels = spark.createDataFrame([(7, 1), (7, 0), (8, 0)], "doc_id bigint, toxic int")
    got = sorted(tuple(r) for r in labelled_sample(docs, labels, "toxic", F.lit(True), 100).collect())
    assert [g[0] for g in got] == [7, 8] and got[0][1] in "ab" and [g[2] for g in got] == [1, 0]
