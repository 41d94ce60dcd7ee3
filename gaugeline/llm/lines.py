"""Line dedup by content-defined chunks of lines and by windows of whole lines.

A text is cut into chunks of whole lines. A border follows a line where a rolling hash over that line and the one before it
is a multiple of ``BORDER``, whatever came before, so borders move with the lines around them and a passage shared by several texts is
cut alike in each, wherever it stands. A chunk of two lines or more and ``LEAST_WORDS`` words is a passage. So is, whatever the
borders, each shortest run of lines from a line on, or up to a line, that has ``RUN_WORDS`` words: a run of lines of
so many words is the union of such windows, hence a repeated one is removed whole, to its first and last line. A paragraph in
one line is a window by itself. Passages that occur more than once in the corpus are removed but for their first occurrence
(by document id, then place), after their bytes were compared; where an occurrence overlaps the first one, only what follows that goes.

Plan: passage hashes are counted first, without text. Only texts that hold repeated passages are shuffled, by document; only
those passages' bytes are grouped, by hash and bytes, with partial aggregation, so a passage in a third of all documents is a few rows
per task. Nothing grows with a group; a line is in as many windows as ``RUN_WORDS`` words have lines, twice.

Limits: a passage that begins or ends within a line is seen only from line to line.

Defined cases: a null text has no lines and stays null; an empty text stays empty; lines without a word end no passage and
don't count as lines, so blank lines are never a passage; rows with a null id lose nothing and don't count; rows of equal id
and text count as one document, rows of equal id and different texts as different ones; extra columns stay.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from gaugeline.llm.common import saved, slices, split_by_key

#: Lines per border on average.
BORDER = 4
#: Lines and words that a chunk must have to be a passage: short boilerplate is left to other rules.
LEAST_LINES = 2
LEAST_WORDS = 20
#: A run of lines of so many words is a passage wherever borders fall, also a single line.
RUN_WORDS = 50


def passages(text: str) -> list[tuple[int, int]]:
    """Passages as (start, end), end exclusive, in characters: chunks of lines, and windows of ``RUN_WORDS`` words."""
    out: dict[tuple[int, int], int] = {}  # by start and end of the last line with a word, as blank lines after it don't count
    spans: list[tuple[int, int, int]] = []  # start, end and words of the lines with a word
    at = start = lines = words = before = 0

    def close(end: int) -> None:
        if lines >= LEAST_LINES and words >= LEAST_WORDS:
            out[start, spans[-1][1]] = end

    for line in text.split("\n"):
        end = min(len(text), at + len(line) + 1)
        n = len(line.split())
        if n:
            lines, words = lines + 1, words + n
            spans.append((at, end, n))
            h = xxhash.xxh64_intdigest(line.encode())
            if xxhash.xxh64_intdigest(before.to_bytes(8, "little") + h.to_bytes(8, "little")) % BORDER == 0:
                close(end)
                start, lines, words = end, 0, 0
            before = h
        at = end
    close(len(text))
    low = total = 0
    for _, end, n in spans:
        # From each line on the first end that suffices; up to each line the last start that does.
        known, total = total >= RUN_WORDS, total + n
        while total - spans[low][2] >= RUN_WORDS:
            if not known:
                out.setdefault((spans[low][0], end), end)
            known, total, low = False, total - spans[low][2], low + 1
        if total >= RUN_WORDS:
            out.setdefault((spans[low][0], end), end)
    return sorted((start, end) for (start, _), end in out.items())


def _key(text: str) -> bytes:
    """A chunk with and without the line break after its last line is the same passage."""
    return xxhash.xxh3_128_digest(text.rstrip("\n").encode())


def repeated(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, start, end`` of the passages to remove; ``mark`` is a hash of the text they lie in."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def hashes(batches):
        for batch in slices(batches):
            ids, keys, starts = [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                for start, end in passages(text):
                    ids.append(i)
                    keys.append(_key(text[start:end]))
                    starts.append(start)
            take = pa.array(ids, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(keys, pa.binary()), pa.array(starts, pa.int64())], ["doc_id", "mark", "key", "start"])

    def bodies(batches):
        for batch in slices(batches, 128):
            ids, keys, starts, ends, parts = [], [], [], [], []
            for i, (text, wanted) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                wanted = set(wanted)
                for start, end in passages(text):
                    if start in wanted:
                        ids.append(i)
                        keys.append(_key(text[start:end]))
                        starts.append(start)
                        ends.append(end)
                        parts.append(text[start:end].rstrip("\n"))
            take = pa.array(ids, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(keys, pa.binary()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(parts, pa.string())], ["doc_id", "mark", "key", "start", "end", "part"])

    texts = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("mark"), "text")
    places = saved(texts.mapInArrow(hashes, f"doc_id {kind}, mark bigint, key binary, start bigint"), "line-chunks")
    place = F.struct("doc_id", "mark", "start", "end")
    often = saved(places.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "line-keys")
    wanted = saved(places.join(often.hint("merge"), "key").groupBy("doc_id", "mark").agg(F.collect_set("start").alias("starts")), "line-wanted")
    possible, _ = split_by_key(texts, ["doc_id", "mark"], wanted)
    # Merge joins at every size: the plan doesn't change with the input, and a hot document can be split.
    shared = possible.join(wanted.hint("merge"), ["doc_id", "mark"]).select("doc_id", "mark", "text", "starts")
    found = saved(shared.mapInArrow(bodies, f"doc_id {kind}, mark bigint, key binary, start bigint, end bigint, part string"), "line-bodies")
    # Grouped by their bytes: equal keys of unequal parts are different passages, told apart by a second hash from here on.
    own = F.xxhash64("part").alias("own")
    first = saved(found.groupBy("key", "part").agg(F.min(place).alias("first")).select("key", own, "first"), "line-firsts")
    pairs = found.select("doc_id", "mark", "start", "end", "key", own).join(first.hint("merge"), ["key", "own"])
    # A text that repeats itself line by line overlaps its first passage, which stays whole.
    own_text = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
    rest = F.when(own_text, F.greatest("start", "first.end")).otherwise(F.col("start"))
    return pairs.select("doc_id", "mark", rest.alias("start"), "end").where("start < end")


def remove(docs: DataFrame, drop_emptied: bool = False) -> DataFrame:
    """``docs`` without repeated passages. ``drop_emptied`` leaves out documents of which no word remains and one was there."""
    cuts = repeated(docs).groupBy("doc_id", "mark").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("__cuts"))
    cuts = saved(cuts, "line-cuts")
    possible, others = split_by_key(docs.withColumn("__key", F.xxhash64("text")), ["doc_id", "__key"], cuts.withColumnRenamed("mark", "__key"))
    cuts = cuts.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"), "__cuts")

    def step(a, x):
        gap = F.substr(F.col("text"), a["at"] + 1, F.greatest(x["start"].cast("int") - a["at"], F.lit(0)))
        return F.struct(F.greatest(a["at"], x["end"].cast("int")).alias("at"), F.array_append(a["out"], gap).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    rest = F.aggregate("__cuts", start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substr(F.col("text"), a["at"] + 1)))
    joined = possible.join(cuts.hint("merge"), (F.col("doc_id") == F.col("__id")) & (F.col("__key") == F.col("__mark")), "left")
    changed = joined.select(*[F.when(F.col("__cuts").isNull(), F.col("text")).otherwise(rest).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns], F.col("__cuts").isNotNull().alias("__cut"))
    if drop_emptied:
        changed = changed.where(~(F.col("__cut") & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")))
    return changed.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(others.drop("__key"))
