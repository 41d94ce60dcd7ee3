"""Filter interaction audit: what each of five document filters removes, in every order, from a stream with retractions.

The files of a table are a file stream, taken in available-now micro-batches. A document's mask has a bit for every filter that
it fails. Four of them look at the text alone. The fifth (E: the text stands under a smaller id somewhere) can change later:
keyed text state holds the smallest id of every text and what was counted for it, and when a smaller id arrives in a later
batch or row, the earlier mask is retracted from the counters of its part and counted anew with bit E. So after every batch
the counters are those of all rows so far, whatever order the files come in.

Plan of a micro-batch: masks and digests of texts inside the JVM (texts go no further); labels joined by id, broadcast only if
they were counted to be few (a stream's plan goes by the bytes of their files, which are a small part of what they take in the
driver's memory); in every task,
rows of one text are reduced to the smallest id and counts, so a text that a third of all rows share is a few rows per task;
state, grouped by buckets of digests, answers with changes of counters; a sum of these is written under the batch's number, so
a repeated batch replaces its own. State is checkpointed to the shared folder. A bucket holds about
``BUCKET_TEXTS`` texts, because one call of Python for every text costs a millisecond.

The audit itself is arithmetic on 32 masks per part: no document is looked at again.

Defined cases: a null text counts as empty, a null part as ''; a row without id is in no other row's way and never fails E;
rows that share a text's smallest id all pass E (no *smaller* id has the text); repeated rows count each; several labels of
one id count as the largest, rows without labels as neither good nor toxic; an empty table or a missing path gives no rows;
other columns are ignored. Texts are compared whole, by 128 bits of SHA-256.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeline.llm.common import BLANK
from gaugeline.session import empty, path_exists, shared_dir

FILTERS = "ABCDE"
#: Micro-batches that a table's files are dealt into.
BATCHES = 4
#: Texts in a bucket of the state, on average.
BUCKET_TEXTS = 4096
#: Buckets in a partition of the state, at least: a partition is a store of its own, with its own memory and files.
STORE_BUCKETS = 8
#: State of more buckets than this goes to RocksDB, which keeps it on disk, where the session doesn't name a store itself. One
#: such store takes some megabytes of disk however little it holds.
HEAP_BUCKETS = 4096
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_STORES = "org.apache.spark.sql.execution.streaming.state."
ROCKSDB = {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}
#: Rows that a task reduces at once before it passes them on.
HELD_TEXTS = 100_000
#: Copies of an id's labels, so that one id's rows don't meet in one task.
SALTS = 8
#: Labelled ids that are broadcast at most (some MB on the driver); rows meet more of them in a shuffle.
FEW_IDS = 50_000

_COUNTS = "part string, mask int, flags int, n bigint"
_REDUCED = pa.schema([("digest", pa.binary()), ("part", pa.string()), ("bits", pa.int32()), ("flags", pa.int32()), ("doc_id", pa.int64()), ("n_first", pa.int64()), ("n_over", pa.int64())])
_DUPLICATE = 1 << FILTERS.index("E")


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.filter(F.split(text, f"[{BLANK}]+"), lambda w: w != "")  # a blank at either end leaves an empty word
    parts = F.struct(words.alias("words"), text.alias("text"))

    def bits(row: Column) -> Column:
        n, t = F.size(row["words"]), row["text"]
        capitals = F.regexp_count(t, F.lit("[A-Z]"))
        fails = (
            n < 200,
            F.lit(100) * F.size(F.array_distinct(row["words"])) < F.lit(50) * n,
            F.lit(100) * capitals > F.lit(2) * F.length(t),
            F.rlike(t, F.lit("[#$%&*|]")),
        )
        return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0)).cast("int")

    return F.element_at(F.transform(F.array(parts), bits), 1)


def label_flags(labels: DataFrame) -> DataFrame:
    """``key, flags`` of every id with a good (2) or toxic (1) label."""
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("key"))
    flags = known.agg((F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).cast("int") * 2 + F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).cast("int")).alias("flags"))
    return flags.where("flags > 0")


def masked(docs: DataFrame, flags: DataFrame, few: bool) -> DataFrame:
    """``digest, part, bits, flags, doc_id`` of every row; ``flags`` by id, see ``label_flags``.

    ``few`` is the answer of a count of ``flags``, which are broadcast then. Otherwise they lie ``SALTS`` times, so rows of one id
    (chosen by their place in the file) meet them in as many tasks; rows without an id are spread as well.
    """
    at = F.col("_metadata.row_index")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("source"), F.lit("")).alias("part"), text.alias("text"), at.alias("at"))
    rows = rows.select("at", F.substring(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), 1, 16).alias("digest"), "part", failures(F.col("text")).alias("bits"), F.col("doc_id").cast("long").alias("doc_id"))
    found = ["digest", "part", "bits", F.coalesce("flags", F.lit(0)).alias("flags"), "doc_id"]
    if few:
        return rows.withColumn("key", F.col("doc_id")).join(F.broadcast(flags), "key", "left").select(*found)
    salt = F.when(F.col("doc_id").isNull(), SALTS + F.pmod("at", F.lit(1024))).otherwise(F.pmod("at", F.lit(SALTS)))
    rows = rows.withColumns({"key": F.coalesce("doc_id", F.lit(0)), "salt": salt})
    copies = flags.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    return rows.join(copies.hint("merge"), ["key", "salt"], "left").select(*found)


def reduce_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one text in a task to its smallest id there: per part and flags, rows with that id and rows with a larger one."""
    held: dict[bytes, list] = {}  # digest: [smallest id, bits, {(part, flags): [rows with that id, others]}]
    plain: Counter = Counter()  # rows without an id

    def rows() -> pa.RecordBatch:
        out = [(d, p, bits, f, first, n[0], n[1]) for d, (first, bits, counts) in held.items() for (p, f), n in counts.items()]
        out += [(b"", p, bits, f, None, n, 0) for (p, bits, f), n in plain.items()]
        columns = list(zip(*out, strict=True)) or [[]] * len(_REDUCED)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _REDUCED, strict=True)], schema=_REDUCED)

    for batch in batches:
        for digest, part, bits, flags, doc_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if doc_id is None:
                plain[part, bits, flags] += 1
                continue
            text = held.setdefault(digest, [doc_id, bits, {}])
            if doc_id < text[0]:
                text[0] = doc_id
                for n in text[2].values():
                    n[:] = 0, sum(n)
            text[2].setdefault((part, flags), [0, 0])[doc_id > text[0]] += 1
        if len(held) >= HELD_TEXTS:
            yield rows()
            held.clear(), plain.clear()
    yield rows()


def change(texts: dict[bytes, tuple], rows: Iterator[tuple]) -> Counter:
    """Take reduced rows into the state ``texts`` (digest: smallest id, its counts by part and flags); how the counters change.

    Rows with a larger id than the text's smallest count with bit E. A smaller one takes its place: what was counted for the
    former is retracted and counted with the bit.
    """
    moved: Counter = Counter()
    for digest, part, bits, flags, doc_id, n_first, n_over in rows:
        if n_over:
            moved[part, bits | _DUPLICATE, flags] += n_over
        if not n_first:
            continue
        if doc_id is None:
            moved[part, bits, flags] += n_first
            continue
        known = texts.get(digest)
        if known is not None and doc_id > known[0]:
            moved[part, bits | _DUPLICATE, flags] += n_first
            continue
        if known is None or doc_id < known[0]:
            for (p, f), n in known[1].items() if known else ():
                moved[p, bits, f] -= n
                moved[p, bits | _DUPLICATE, f] += n
            known = texts[digest] = (doc_id, {})
        known[1][part, flags] = known[1].get((part, flags), 0) + n_first
        moved[part, bits, flags] += n_first
    return moved


def _on_bucket(key, frames, state):
    """State of a bucket: its texts, pickled. All rows of a batch are gone through; the changes leave as one small frame."""
    texts = pickle.loads(state.get[0]) if state.exists else {}
    moved: Counter = Counter()
    for frame in frames:
        ids = [None if pd.isna(i) else int(i) for i in frame["doc_id"].tolist()]
        rows = zip(frame["digest"].map(bytes).tolist(), frame["part"].tolist(), frame["bits"].tolist(), frame["flags"].tolist(), ids, frame["n_first"].tolist(), frame["n_over"].tolist(), strict=True)
        moved.update(change(texts, rows))  # adds up, below zero as well
    state.update((pickle.dumps(texts),))
    found = [(*k, n) for k, n in moved.items() if n]
    yield pd.DataFrame({name: pd.Series([r[i] for r in found], dtype=kind) for i, (name, kind) in enumerate((("part", object), ("mask", "int32"), ("flags", "int32"), ("n", "int64")))})


def _source(spark: SparkSession, path: str) -> tuple[str, str | None]:
    """A folder that a file stream can watch, and a name to look for where ``path`` is a single file."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at)
    return (path, None) if status.isDirectory() else (at.getParent().toString(), at.getName())


def counters(spark: SparkSession, path: str, labels: DataFrame, checkpoint: str | None = None, batches: int = BATCHES) -> DataFrame:
    """``part, mask, flags, n``: how many documents of the Parquet table at ``path`` fail exactly which filters.

    Given the ``checkpoint`` of an earlier call, only files that came since are read, and earlier masks are retracted where they
    make it necessary.
    """
    home = checkpoint or shared_dir(spark, "audit")
    if not path_exists(spark, path):
        return empty(spark, spark.createDataFrame([], _COUNTS).schema)
    own = spark.newSession()
    # The bucket of a text and the kind of store must stay the same for the life of a checkpoint.
    if not path_exists(spark, f"{home}/buckets"):
        n = max(1, math.ceil(own.read.parquet(path).count() / BUCKET_TEXTS))
        default = _STORES + ("RocksDBStateStoreProvider" if n > HEAP_BUCKETS else "HDFSBackedStateStoreProvider")
        named = spark.conf.get(_PROVIDER, default) if _PROVIDER in spark.conf.getAll else default
        own.createDataFrame([(n, named)], "n bigint, store string").write.parquet(f"{home}/buckets")
    n_buckets, store = own.read.parquet(f"{home}/buckets").first()
    for key, value in {_PROVIDER: store, **ROCKSDB}.items():
        own.conf.set(key, value)
    own.conf.set("spark.sql.shuffle.partitions", min(math.ceil(n_buckets / STORE_BUCKETS), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    folder, name = _source(own, path)
    table = own.read.parquet(path)
    n_files = len(table._jdf.inputFiles())
    stream = own.readStream.schema(table.schema).option("maxFilesPerTrigger", max(1, math.ceil(n_files / batches))).option("maxFileAge", "36500d")
    docs = (stream.option("pathGlobFilter", name) if name else stream).parquet(folder)
    flags = label_flags(labels)
    few = flags.limit(FEW_IDS + 1).count() <= FEW_IDS
    reduced = masked(docs, flags, few).mapInArrow(reduce_task, "digest binary, part string, bits int, flags int, doc_id bigint, n_first bigint, n_over bigint")
    changes = reduced.withColumn("bucket", F.pmod(F.xxhash64("digest", F.when(F.length("digest") == 0, F.col("part"))), F.lit(n_buckets))).groupBy("bucket").applyInPandasWithState(_on_bucket, _COUNTS, "texts binary", "append", "NoTimeout")

    def count(batch: DataFrame, number: int) -> None:
        batch.groupBy("part", "mask", "flags").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{home}/counters/batch={number}")

    changes.writeStream.foreachBatch(count).option("checkpointLocation", f"{home}/stream").trigger(availableNow=True).start().awaitTermination()
    if not path_exists(spark, f"{home}/counters"):
        return empty(spark, spark.createDataFrame([], _COUNTS).schema)
    written = spark.read.schema(_COUNTS).parquet(f"{home}/counters/batch=*")
    return written.groupBy("part", "mask", "flags").agg(F.sum("n").alias("n")).where("n <> 0")


def steps() -> list[tuple[str, int, int, int]]:
    """Every step of every order: order, step, bit of the step's filter, bits of the filters before it."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            out.append(("".join(order), step, bit, before))
            before |= bit
    return out


def report(counts: DataFrame) -> DataFrame:
    """One row per part, order and step from counters of masks."""
    masks = 1 << len(FILTERS)

    def column(condition: Column, name: str) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(condition & (F.col("mask") == m), F.col("n"))), F.lit(0)) for m in range(masks)]).alias(name)

    parts = counts.groupBy("part").agg(column(F.lit(True), "n"), column(F.col("flags") >= 2, "good"), column(F.col("flags") % 2 == 1, "toxic"))
    literal = ", ".join(f"named_struct('filter_order', '{o}', 'step', {s}, 'own', {b}, 'before', {e})" for o, s, b, e in steps())
    rows = parts.select("part", "n", "good", "toxic", F.inline(F.expr(f"array({literal})")))

    def total(array: str, condition: str, weight: str = "1") -> Column:
        return F.expr(f"aggregate(sequence(0, {masks - 1}), 0L, (a, m) -> a + CASE WHEN {condition} THEN get({array}, m) * {weight} ELSE 0L END)")

    removed = "(m & own) <> 0 AND (m & before) = 0"
    orders = math.factorial(len(FILTERS))
    return rows.select(
        "part",
        "filter_order",
        "step",
        total("n", "(m & (own | before)) = 0").alias("kept"),
        total("n", removed).alias("removed"),
        total("n", "(m & own) <> 0 AND (m & before) <> 0").alias("redundant"),
        total("n", "m = own").alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        # In a share of 1 / (bits of the mask) of all orders the filter comes first among those that the document fails.
        total("n", "(m & own) <> 0", f"({orders} div bit_count(m))").alias("shapley"),
    )


def audit(spark: SparkSession, path: str, labels: DataFrame, checkpoint: str | None = None, batches: int = BATCHES) -> DataFrame:
    """``counters`` of the table at ``path``, as a report."""
    return report(counters(spark, path, labels, checkpoint, batches))
