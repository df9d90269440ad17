"""Engine: a study's tables under one folder, loaded in batches and queried as DataFrames or SQL.

Counts are partitioned by chromosome, stretch of ``span`` positions and batch; what loads
alone read, region rows and variant keys, by chromosome and batch, since a folder costs
more than the few rows that it may hold. A load adds files and rewrites none: a sample's
numbers at a variant depend on that sample's rows alone, so a batch adds its own samples at
all variants of the stretches it touches, and the other samples at the variants that it
brings. A batch is visible once it is DONE.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.functions.genotype import type_of_id
from cohortspark.operators import merge as M
from cohortspark.operators import regions as R
from cohortspark.operators.joins import small
from cohortspark.schemas import schema

from .query import SLOTS, VariantQuery, slot_columns
from .session import tune

#: Positions of a stretch.
SPAN = 1_000_000
#: Widest and narrowest bin of the merge, and the positions with variants that a bin should hold.
BIN = 128
NARROW = 8
BIN_POINTS = 8
#: Region rows that a task of the merge gets.
TASK_ROWS = 200_000
#: While a batch is written: folders that a task fills side by side (rows of more are sorted
#: by folder first); joins take partitions by chromosome and stretch as they are, and hash
#: the side that has few bytes a partition.
WRITE_SETTINGS = {
    "spark.sql.maxConcurrentOutputFileWriters": "128",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}
#: Folders of tables that are stored with more columns than their record type has.
FOLDERS = {"stored_regions": "call_regions", "stored_counts": "variant_counts"}


def span_of(pos: Column, span: int) -> Column:
    return F.floor(pos / span).cast("int")


class Engine:
    """Incremental loads into one study."""

    def __init__(self, spark: SparkSession, root: str, span: int = SPAN) -> None:
        self.spark, self.root, self.span = tune(spark), root.rstrip("/"), span

    def path(self, name: str) -> str:
        return f"{self.root}/{FOLDERS.get(name, name)}"

    def _folder(self, path: str) -> tuple:
        """The file system that holds ``path``, and the path there."""
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _table(self, name: str) -> DataFrame:
        """A stored table; one that no load has written yet is empty."""
        files, at = self._folder(self.path(name))
        if not files.exists(at):
            return self.spark.createDataFrame([], schema(name))
        return self.spark.read.schema(schema(name)).parquet(self.path(name))

    def _done(self) -> list[str]:
        return [r.batch_id for r in self.batches().where("status = 'DONE'").select("batch_id").collect()]  # a row per load

    def regions(self) -> DataFrame:
        """Region rows of the batches that are DONE, each once: the copy in the stretch of its start."""
        rows = self._table("stored_regions").where(F.col("batch_id").isin(self._done()))
        return rows.where(F.col("span") == span_of(F.least("start", "end"), self.span)).drop("span")

    def counts(self) -> DataFrame:
        """The long count table of the batches that are DONE, without what a later batch of the same sample replaced."""
        done = self._done()
        rows = self._table("stored_counts").where(F.col("batch_id").isin(done))
        old = self._table("superseded").where(F.col("by_batch").isin(done)).drop("by_batch").distinct()
        if not old.isEmpty():
            rows = rows.join(old, ["chrom", "span", "batch_id", "sample_id"], "left_anti")
        return rows.select("chrom", "pos", "ref", "alt", "slot", "allele", "sample_id")

    def batches(self) -> DataFrame:
        """Latest status of each batch: DONE wins over RUNNING and ERROR of earlier tries."""
        rank = F.when(F.col("status") == "DONE", 2).when(F.col("status") == "RUNNING", 1).otherwise(0)
        return self._table("load_batches").groupBy("batch_id").agg(F.max_by(F.struct("file_ids", "status"), rank).alias("x")).select("batch_id", "x.file_ids", "x.status")

    def _mark(self, batch_id: str, file_ids: list[int], status: str) -> None:
        self.spark.createDataFrame([(batch_id, file_ids, status)], schema("load_batches")).write.mode("append").parquet(self.path("load_batches"))

    def _write(self, rows: DataFrame, name: str, batch_id: str, order: str, retry: bool, folders: tuple[str, ...] = ("chrom", "batch_id"), dealt: bool = False) -> None:
        """A batch's files in the folders it touches; a repeated try replaces its own.

        Rows are sorted by position alone, which takes no comparisons, and dealt to the
        folders as they come. A first try has nothing to replace, so its tasks move their
        files themselves, and not the driver one by one. ``dealt``: the rows are partitioned
        by chromosome and stretch already.
        """
        out = rows if dealt else rows.repartition("chrom", "span")
        out = out.withColumn("batch_id", F.lit(batch_id)).sortWithinPartitions(order).write.partitionBy(*folders)
        out = out.mode("overwrite").option("partitionOverwriteMode", "dynamic") if retry else out.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        kept = {key: self.spark.conf.get(key) for key in WRITE_SETTINGS}
        try:
            for key, value in WRITE_SETTINGS.items():
                self.spark.conf.set(key, value)
            out.parquet(self.path(name))
        finally:
            for key, value in kept.items():
                self.spark.conf.set(key, value)

    def load(self, calls: DataFrame, batch_id: str, file_ids: list[int]) -> bool:
        """Loads a batch once: a batch that is DONE is skipped, one that failed is written over. Returns whether it ran."""
        tried = {r.batch_id: r.status for r in self.batches().select("batch_id", "status").collect()}  # a row per load
        if tried.get(batch_id) == "DONE":
            return False
        self._mark(batch_id, file_ids, "RUNNING")
        try:
            rows = R.call_regions(R.file_scan(calls, file_ids))
            ends = F.sequence(span_of(F.least("start", "end"), self.span), span_of(F.greatest("start", "end"), self.span))
            self._write(rows.withColumn("span", F.explode(ends)), "stored_regions", batch_id, "start", batch_id in tried)
            self._merge(batch_id, [b for b, status in tried.items() if status == "DONE"], batch_id in tried)
        except Exception:
            self._mark(batch_id, file_ids, "ERROR")
            raise
        self._mark(batch_id, file_ids, "DONE")
        return True

    def _width(self, keys: DataFrame) -> int:
        """The bin of the merge for variants as dense as ``keys``: by it a row meets few positions that aren't its own."""
        found = keys.select("chrom", "pos", F.floor(F.col("pos") / BIN).alias("bin")).distinct().groupBy("chrom", "bin").count().agg(F.avg("count")).first()[0]
        width = BIN
        while found and width > NARROW and found * width / BIN > BIN_POINTS:
            width //= 2
        return math.gcd(self.span, width)

    def _merge(self, batch_id: str, done: list[str], retry: bool) -> None:
        """What a batch adds to the count table, in the stretches that its rows touch."""
        stored = self._table("stored_regions")
        mine, others = stored.where(F.col("batch_id") == batch_id), stored.where(F.col("batch_id").isin(done))
        new = mine.where(~M.plain_reference())
        touched: dict[str, list[int]] = {}
        n = 0
        told = stored.where(F.col("batch_id").isin(*done, batch_id) & ~M.plain_reference())
        # stretches of the genome: some 3,000 at the default span
        for r in told.groupBy("chrom", "span").agg(F.count("*").alias("n"), F.max(F.col("batch_id") == batch_id).alias("mine")).where("mine").collect():
            touched.setdefault(r.chrom, []).append(r.span)
            n += r.n
        if not touched:
            return
        stretches = F.broadcast(self.spark.createDataFrame([(c, x) for c, xs in touched.items() for x in xs], "chrom string, span int"))
        here = lambda rows: rows.where(F.col("chrom").isin(*touched)).join(stretches, ["chrom", "span"], "left_semi")
        known = here(self._table("variant_keys").where(F.col("batch_id").isin(done))).select(*M.VARIANT)
        at = span_of(F.col("pos"), self.span).alias("span")
        self._write(M.variant_keys(new).join(known, M.VARIANT, "left_anti").select(*M.VARIANT, at), "variant_keys", batch_id, "pos", retry)
        keys = here(self._table("variant_keys").where(F.col("batch_id").isin(*done, batch_id)))
        told = here(others.where(~M.plain_reference()))
        members = small(mine.select("sample_id").distinct())
        returning = bool(done) and not others.select("sample_id").distinct().join(members, "sample_id", "left_semi").isEmpty()
        again = told.join(members, "sample_id", "left_semi") if returning else None
        own = new.unionByName(again) if returning else new
        if done:  # the other samples, at the variants that the batch brings
            rest = told.join(members, "sample_id", "left_anti") if returning else told
            own = own.withColumn("fresh_only", F.lit(False)).unionByName(rest.withColumn("fresh_only", F.lit(True)))
        counts = M.merge(own, width=self._width(keys), variants=keys.select(*M.VARIANT, (F.col("batch_id") == batch_id).alias("fresh")), span=self.span, parts=max(n // TASK_ROWS, int(self.spark.conf.get("spark.sql.shuffle.partitions"))))
        self._write(M.slots(counts).select(*M.VARIANT, "slot", "allele", "sample_id", at), "stored_counts", batch_id, "pos", retry, ("chrom", "span", "batch_id"), True)
        if returning and not again.isEmpty():
            folders = reduce(lambda a, b: a | b, [(F.col("chrom") == c) & F.col("span").isin(xs) for c, xs in touched.items()])
            old = self._table("stored_counts").where(folders & F.col("batch_id").isin(done)).select("sample_id", "chrom", "span", "batch_id").join(members, "sample_id", "left_semi").distinct()
            old.withColumn("by_batch", F.lit(batch_id)).write.mode("append").parquet(self.path("superseded"))

    def drop(self) -> None:
        """Deletes the study's tables."""
        files, at = self._folder(self.root)
        files.delete(at, True)

    def query(self, samples: Sequence[int] = ()) -> VariantQuery:
        """A query over the study's variants, with sample lists (of ``samples`` only, if given).

        Genotype tests read the entries of the asked samples only.
        """
        counts = self.counts()
        table = slot_columns(counts, SLOTS, samples)
        return VariantQuery(table.withColumn("type", type_of_id(F.col("ref"), F.col("alt"))), counts)

    def register_views(self) -> None:
        """The tables as temporary views, for SQL."""
        self.regions().createOrReplaceTempView("call_regions")
        self.counts().createOrReplaceTempView("variant_counts")
        self._table("load_batches").createOrReplaceTempView("load_batches")
