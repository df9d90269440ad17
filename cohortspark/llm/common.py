"""What the operators share: scratch tables, the hold-out rule, and joins that bear hot keys."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of every contract: U+0020 and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: A table of at most this many rows may be broadcast; the callers count it first.
BROADCAST_ROWS = 10_000
BATCH_ROWS, BATCH_BYTES = 1000, 32 << 20
ROW_GROUP = 16 << 20

_written: list[tuple[SparkSession, str]] = []
_paths: dict[int, tuple[weakref.ref, str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only in a local session where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="cohortspark-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_sweep)
    _written.append((spark, path))
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)  # small row groups, as every writer holds one in memory
    out = spark.read.schema(df.schema).parquet(path)
    _paths[id(out)] = (weakref.ref(out), path)
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``materialise`` wrote and that nothing will read again."""
    for df in tables:
        ref, path = _paths.pop(id(df), (None, None))
        if ref is not None and ref() is df:
            _written[:] = [w for w in _written if w[1] != path]
            _delete(df.sparkSession, path)


def written() -> int:
    """How many tables ``materialise`` has written that are still there, for ``discard_since``."""
    return len(_written)


def discard_since(count: int, *keep: DataFrame) -> None:
    """Deletes the tables written since ``written`` was ``count``, but for those of ``keep``."""
    kept = {_paths[id(df)][1] for df in keep if id(df) in _paths}
    own = _written[count:]
    _written[count:] = [w for w in own if w[1] in kept]
    for spark, path in own:
        if path not in kept:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext._jsc
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc.hadoopConfiguration()).delete(at, True)


def _sweep() -> None:
    while _written:
        try:
            _delete(*_written.pop())
        except Exception:  # the session has ended; its folder belongs to the cluster
            return


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; null ids count as empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")), F.lit(modulus))


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it has few rows; beyond that Spark joins by shuffle and splits skew."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, its session set to send Python at most ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes at once.

    Without it batches of long texts fill a worker and its executor. Spark has these
    bounds as session settings only; they are tightened, never widened, and change no result.
    """
    conf = df.sparkSession.conf
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        found = conf.get(key)
        if not (found.isdigit() and 0 < int(found) <= most):
            conf.set(key, str(most))
    return df


def freeing(run):
    """``run`` over Arrow batches, the worker's free memory returned to the system when the task ends."""

    def wrapped(batches):
        import ctypes
        import gc

        import pyarrow as pa

        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tasks_for(df: DataFrame, size: int) -> int:
    """Pieces of ``size`` bytes that the input of ``df`` makes by the optimiser's estimate; 1 where it has none."""
    found = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return -(-found // size) if found < 1 << 60 else 1
