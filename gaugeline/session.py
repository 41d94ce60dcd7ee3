"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Needed by ``decode``: Japanese charsets, and bad bytes replaced by U+FFFD instead of failing the job.
DECODE_CONF = {
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.legacy.codingErrorAction": "true",
}

#: Runtime settings that matter on a cluster; all of them may be overridden by the caller.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the two decode switches on an existing session. Nothing else of the session is changed."""
    for key, value in DECODE_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "gaugeline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **DECODE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    Where that isn't set, the warehouse takes its place; on a cluster it must not be a folder of one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and (base.startswith("file:") or "://" not in base):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/gaugeline/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it isn't there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in system.listStatus(at)] if system.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, read by the driver."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file with this text under a name that isn't taken, complete at once; False if it is taken.

    A link does that on local disks; elsewhere a rename that never replaces, as atomic as the file system's (HDFS, ABFS, GCS; plain S3
    needs a committer of its own).
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(at.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if system.getScheme() == "file":
            local = [system.makeQualified(p).toUri().getPath() for p in (draft, at)]
            os.link(*local)
        else:
            none = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
            options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = none
            spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, at, options)
    except FileExistsError:
        return False
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in str(e.java_exception):
            return False
        raise
    finally:
        system.delete(draft, False)
    return True


#: Rows of file names (some MB) that the planner may broadcast.
FEW_ROWS = 20_000


def sized(side: DataFrame, rows: int) -> DataFrame:
    """A side of a join that holds ``rows`` rows at most; if they are many, the join is one that broadcasts neither side.

    The planner goes by the bytes of the files that a side is read from. Names that differ in a few characters take up to a hundred
    times as many when they are broadcast, all of them in the driver's memory.
    """
    return side.hint("merge") if rows > FEW_ROWS else side


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, in a form the optimizer recognises, so that joins with it fall away."""
    return spark.range(1).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
