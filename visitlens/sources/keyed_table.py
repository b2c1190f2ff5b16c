"""Keyed upserts (K3 overwrite, K4 add, K5 replace group) whose cost follows the update: merge on read.

Plain Parquet under one folder, written and read by Spark alone:

* ``delta/version=V/bucket=B``: the rows of commit V, nothing else. ``op``: 0 puts a row, 1 adds to one, 2 (a
  tombstone) drops all older rows of a group;
* ``base/upto=V/bucket=B``: rows merged through commit V;
* ``log/version=V``: a row per bucket that commit V touched, ``base_log/upto=V``: a row per bucket of that base.
  They are written last, so data of a commit that didn't finish is never read; they hold numbers only.

A row lives in the bucket of a hash of its group (its key where there are no groups), so a bucket's rows merge among
themselves. Readers take each bucket's newest base and the deltas after it. ``compact`` folds only buckets with enough
deltas, ``vacuum`` removes what newer bases replace. Committing a version again rewrites that version's delta:
a replayed micro-batch changes nothing, also after its commit was folded.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

PUT, ADD, DROP_GROUP = 0, 1, 2


class KeyedTable:
    """``keys`` identify a row; ``values`` are the numeric columns that ``add`` adds to; ``group`` (some of the keys)
    is what ``replace_groups`` replaces. ``buckets`` is fixed for a table's life: about its size over 128 MB."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], values: list[str] | None = None,
                 group: list[str] | None = None, buckets: int = 16):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets
        self.values, self.group = values or [], group or keys
        self.schema = StructType.fromDDL(schema)
        self.columns = self.schema.fieldNames()
        if not set(self.keys + self.values) <= set(self.columns) or not set(self.group) <= set(keys):
            raise ValueError("keys and values must be columns, and group some of the keys")

    # ------------------------------------------------------------- folders

    def _read(self, folder: str, ddl: str) -> DataFrame:
        schema = StructType.fromDDL(ddl) if folder in ("log", "base_log") else StructType(
            [*self.schema.fields, *StructType.fromDDL(ddl).fields])
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
                return self.spark.createDataFrame([], schema)
            raise

    def _deltas(self) -> DataFrame:
        return self._read("delta", "op int, version bigint, bucket int")

    def _bases(self) -> DataFrame:
        return self._read("base", "upto bigint, bucket int")

    def _log(self) -> DataFrame:
        return self._read("log", "bucket int, version bigint")

    def _base_log(self) -> DataFrame:
        return self._read("base_log", "bucket int, upto bigint")

    # ------------------------------------------------------------- commits

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.group), F.lit(self.buckets)).cast("int").alias("bucket")

    def _commit(self, rows: DataFrame, version: int) -> None:
        """Write one commit's rows, then say which buckets it touched. Small buckets share tasks, a large one is split (AQE's rebalancing)."""
        out = f"{self.path}/delta/version={version}"
        rows.select(*self.columns, "op", self._bucket()).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(out)
        self._mark("log", "version", self._written(out), version)

    def _written(self, folder: str) -> list[int]:
        """The buckets that a write made: its own partition folders, no data is read."""
        return sorted(int(name.split("=")[1]) for name in self._children(folder) if name.startswith("bucket="))

    def _mark(self, folder: str, column: str, buckets: list[int], version: int) -> None:
        done = self.spark.createDataFrame([(b,) for b in buckets], "bucket int")
        done.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{folder}/{column}={version}")

    def _op(self, updates: DataFrame, op: int) -> DataFrame:
        return updates.select(*self.columns, F.lit(op).alias("op"))

    def overwrite(self, updates: DataFrame, version: int) -> None:
        """Each row replaces the stored row of its key; ``updates`` holds a key once."""
        self._commit(self._op(updates, PUT), version)

    def add(self, updates: DataFrame, version: int) -> None:
        """Values are added to those stored under the key; other columns take the newest row's."""
        self._commit(self._op(updates, ADD), version)

    def replace_groups(self, updates: DataFrame, version: int) -> None:
        """Every group found in ``updates`` is replaced as a whole."""
        gone = updates.select(*self.group).distinct()
        for field in self.schema.fields:
            if field.name not in self.group:
                gone = gone.withColumn(field.name, F.lit(None).cast(field.dataType))
        self._commit(self._op(updates, PUT).unionByName(self._op(gone, DROP_GROUP)), version)

    # ------------------------------------------------------------- reading

    def _state(self, before: int | None) -> tuple[dict[int, int], dict[int, list[int]]]:
        """(bucket -> its base's version, bucket -> versions of the deltas after it), from the logs: numbers of
        at most ``buckets`` bases and the commits since."""
        bases, log = self._base_log(), self._log()
        if before is not None:
            bases, log = bases.where(F.col("upto") < F.lit(before)), log.where(F.col("version") < F.lit(before))
        newest = bases.groupBy("bucket").agg(F.max("upto").alias("upto"))
        after = (log.join(newest, "bucket", "left").where(F.col("upto").isNull() | (F.col("version") > F.col("upto")))
                 .groupBy("bucket").agg(F.sort_array(F.collect_set("version")).alias("versions")))
        rows = newest.join(after, "bucket", "full_outer").collect()
        return ({r.bucket: r.upto for r in rows if r.upto is not None}, {r.bucket: r.versions for r in rows if r.versions})

    @staticmethod
    def _any(tests: list[Column]) -> Column:
        return reduce(lambda a, b: a | b, tests, F.lit(False))

    def _merged(self, bases: dict[int, int], deltas: dict[int, list[int]]) -> DataFrame:
        """The rows of these buckets, merged. Filters on partition columns only, so nothing else is read."""
        by_base: dict[int, list[int]] = {}
        for bucket, upto in bases.items():
            by_base.setdefault(upto, []).append(bucket)
        kept = self._bases().where(self._any([(F.col("upto") == u) & F.col("bucket").isin(b) for u, b in by_base.items()]))
        by_first: dict[tuple[int, ...], list[int]] = {}
        for bucket, versions in deltas.items():
            by_first.setdefault(tuple(versions), []).append(bucket)
        changes = self._deltas().where(self._any([F.col("bucket").isin(b) & F.col("version").isin(*v) for v, b in by_first.items()]))
        stored = kept.select(*self.columns, F.lit(PUT).alias("op"), F.col("upto").alias("version"), "bucket")
        if not deltas:  # a base is merged already
            return stored.select(*self.columns, "bucket")
        rows = stored.unionByName(changes.select(*self.columns, "op", "version", "bucket"))
        if self.group != self.keys:
            of_group = Window.partitionBy("bucket", *self.group)
            dropped = F.max(F.when(F.col("op") == DROP_GROUP, F.col("version"))).over(of_group)
            rows = (rows.withColumn("dropped", dropped)
                    .where((F.col("op") != DROP_GROUP) & (F.col("dropped").isNull() | (F.col("version") >= F.col("dropped")))))
        # what counts of a key: its newest put and the adds after it
        last_put = F.max(F.when(F.col("op") == PUT, F.col("version"))).over(Window.partitionBy("bucket", *self.keys))
        rows = rows.withColumn("last_put", last_put).where(F.col("last_put").isNull() | (F.col("version") >= F.col("last_put")))
        order = F.struct("version", "op")
        sums = [F.sum(v).cast(self.schema[v].dataType).alias(v) for v in self.values]
        others = [F.max_by(c, order).alias(c) for c in self.columns if c not in self.keys + self.values]
        if not sums and not others:
            return rows.select(*self.keys, "bucket").distinct().select(*self.columns, "bucket")
        return rows.groupBy("bucket", *self.keys).agg(*sums, *others).select(*self.columns, "bucket")

    def current(self, before: int | None = None) -> DataFrame:
        """The table, or as it was before version ``before`` (as far back as ``vacuum`` left it)."""
        return self._merged(*self._state(before)).select(*self.columns)

    # ------------------------------------------------------------- upkeep

    def compact(self, version: int, least: int = 8) -> list[int]:
        """Fold commits through ``version`` into new bases for buckets with at least ``least`` deltas; others stay as
        they are. Gives the buckets. May run again with the same version."""
        bases, deltas = self._state(version + 1)
        full = [b for b, versions in deltas.items() if len(versions) >= least]
        if not full:
            return []
        merged = self._merged({b: u for b, u in bases.items() if b in full}, {b: deltas[b] for b in full})
        merged.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/base/upto={version}")
        self._mark("base_log", "upto", full, version)
        return full

    def vacuum(self, keep_from: int) -> list[str]:
        """Remove bases, deltas and log rows that no reader of version ``keep_from`` or a later one needs. Gives the
        removed folders. For each bucket its newest base before ``keep_from`` and all that follows stay."""
        oldest = {r.bucket: r.upto for r in self._base_log().where(F.col("upto") < F.lit(keep_from))
                  .groupBy("bucket").agg(F.max("upto").alias("upto")).collect()}
        removed = []
        for folder, column in (("base", "upto"), ("delta", "version")):
            for name in self._children(f"{self.path}/{folder}"):
                if not name.startswith(f"{column}="):
                    continue
                at = int(name.split("=")[1])
                written = self._written(f"{self.path}/{folder}/{name}")
                gone = [b for b in written if b in oldest and (at < oldest[b] if folder == "base" else at <= oldest[b])]
                if gone and len(gone) == len(written):
                    removed.append(f"{folder}/{name}")
                else:
                    removed += [f"{folder}/{name}/bucket={b}" for b in gone]
        logs = [f for f in removed if f.count("/") == 1]
        # a log goes after its data: a reader that still sees it finds nothing there, which a newer base holds
        for f in removed + [f.replace("delta/", "log/").replace("base/", "base_log/") for f in logs]:
            self._delete(f"{self.path}/{f}")
        return removed

    def _fs(self, path: str):
        """The path on the store that holds it, through Hadoop's file system API."""
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _children(self, folder: str) -> list[str]:
        fs, p = self._fs(folder)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _delete(self, folder: str) -> None:
        fs, p = self._fs(folder)
        fs.delete(p, True)

    def written_bytes(self, version: int) -> int:
        """Bytes that a commit wrote."""
        fs, p = self._fs(f"{self.path}/delta/version={version}")
        return fs.getContentSummary(p).getLength()
