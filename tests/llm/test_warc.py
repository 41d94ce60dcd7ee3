from __future__ import annotations

import base64
import glob
import hashlib
import random
import struct

import pytest
import zstandard

from gaugeline.llm import warc


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id bigint, url string, html string, payload_digest string")


def some(n=60):
    rng = random.Random(1)
    rows = [(i, f"http://h{i % 7}.example/p?{i}", "<html>" + " ".join(rng.choice(["<p>", "word", "é", "日本", "</p>", "more text"]) for _ in range(rng.randrange(400)))) for i in range(n)]
    return rows + [(n, "http://a/\r\nb", None), (n + 1, None, ""), (n + 2, "u", rows[3][2]), (n + 3, "u", rows[3][2]), (n + 4, "u", "line\r\n\r\nmore" * 5000), (None, "u", rows[3][2])]


def test_round_trip_and_revisits(spark):
    rows = some()
    got = warc.roundtrip(pages(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: r for r in got}
    largest = {}
    for i, _, html in rows:
        if i is not None:
            largest[html or ""] = max(i, largest.get(html or "", -1))
    for i, _, html in rows:
        data, r = (html or "").encode(), by_id[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        first = i is None or largest[html or ""] == i
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first else ("revisit", largest[html or ""]))


def test_files_are_dictionary_first_then_a_frame_per_record(spark, tmp_path):
    rows = some(300)
    warc.write(pages(spark, rows), str(tmp_path / "w"))
    texts = {}
    for path in glob.glob(str(tmp_path / "w" / "part-*")):
        data = open(path, "rb").read()
        magic, size = struct.unpack_from("<II", data, 0)
        assert magic == warc.DICTIONARY_MAGIC and size > 1000
        context = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
        at = 8 + size
        while at < len(data):
            head, length = struct.unpack_from("<II", data, at)
            if head & 0xFFFFFFF0 == 0x184D2A50:
                at += 8 + length
                continue
            part = context.decompressobj()
            record = warc.parse(part.decompress(data[at:]))
            at = len(data) - len(part.unused_data)
            texts[record["page_id"]] = record["payload"]
    assert len(texts) == len(rows) and texts[5] == rows[5][2].encode()
    read = {r["page_id"]: bytes(r["payload"]) for r in warc.read(spark, str(tmp_path / "w"), payloads=True).collect()}
    assert read == texts


def test_damage_is_noticed():
    data = b"payload " * 50
    whole = warc.record(1, "u", data, hashlib.sha1(data).hexdigest(), None)
    assert warc.parse(whole)["payload"] == data
    with pytest.raises(ValueError):
        warc.parse(whole.replace(b"payload payload", b"payload Payload", 1))
    frame = zstandard.ZstdCompressor().compress(whole)
    with pytest.raises(ValueError):
        list(warc.frames(frame[:-4]))


def test_empty_table_and_repeated_ids(spark):
    assert warc.roundtrip(pages(spark, [])).count() == 0
    got = warc.roundtrip(pages(spark, [(1, "a", "x"), (1, "b", "x"), (1, "c", "y")])).collect()
    assert sorted((r["record_type"], r["refers_to"]) for r in got) == [("response", None), ("response", None), ("revisit", 1)]
