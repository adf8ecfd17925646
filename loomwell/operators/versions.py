"""Row-level changes and past versions on an append-only change log.

A log has the table's columns plus ``_version`` (bigint), ``_op`` ('U' row is
live, 'D' row is deleted), ``_operation`` and ``_committed_at``. A change appends
the touched rows under the next version and never rewrites old files; the table
as of a version is the newest row of each key up to it. A key occurs at most once
per version and is not NULL, so no key can gather more rows than there are
versions. One writer at a time.
"""

from __future__ import annotations

from functools import reduce
from hashlib import sha256
from operator import and_
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

META = ["_version", "_op", "_operation", "_committed_at"]


def payload(log: DataFrame) -> list[str]:
    return [c for c in log.columns if c not in META]


def as_change(
    df: DataFrame, version: int, op: str, operation: str, committed_at: Column | None = None
) -> DataFrame:
    """Rows of ``df`` as one commit of a log."""
    stamp = committed_at if committed_at is not None else F.current_timestamp()
    return df.withColumns(
        {
            "_version": F.lit(version).cast("long"),
            "_op": F.lit(op),
            "_operation": F.lit(operation),
            "_committed_at": stamp.cast("timestamp"),
        }
    )


def append_rows(log: DataFrame, change: DataFrame) -> DataFrame:
    """Add a commit; columns missing on either side read as NULL."""
    return log.unionByName(change, allowMissingColumns=True)


# ---- whole-table operators ------------------------------------------------


def unique_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows, failing at run time when a key occurs twice; NULL keys are exempt.

    One aggregate counts a key's rows and carries the first of them; it combines on
    the map side, so a key with many rows fails without gathering them.
    """
    rest = [c for c in source.columns if c not in keys]
    full = reduce(and_, [F.col(k).isNotNull() for k in keys])
    fail = F.raise_error(F.lit("a source holds the same key more than once")).cast("boolean")
    once = (
        source.filter(full)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_copies"), F.any_value(F.struct(F.lit(0).alias("_"), *rest)).alias("_row"))
        .filter(F.when(F.col("_copies") > 1, fail).otherwise(F.lit(True)))
        .select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
    )
    return once.unionByName(source.filter(~full)).select(*source.columns)


def refuse_narrower(source: DataFrame, columns: list[str]) -> None:
    """An update by whole rows would erase the columns that its source lacks."""
    missing = [c for c in columns if c not in source.columns]
    if missing:
        raise ValueError(f"merge source lacks the columns {missing}")


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: list[str], when_matched: str = "update", insert: bool = True
) -> DataFrame:
    """MERGE: update, delete or ignore matched rows and insert the others.

    Built from anti joins so that a small change set is broadcast and the large
    target is never shuffled. NULL keys match nothing.
    """
    if when_matched not in {"update", "delete", "ignore"}:
        raise ValueError(f"when_matched is update, delete or ignore, not {when_matched}")
    if when_matched == "update":
        refuse_narrower(source, target.columns)
    source = unique_keys(source, keys)
    kept = target if when_matched == "ignore" else target.join(source.select(*keys), keys, "left_anti")
    if when_matched == "update":
        incoming = source if insert else source.join(target.select(*keys), keys, "left_semi")
        return kept.unionByName(incoming, allowMissingColumns=True)
    if not insert:
        return kept
    fresh = source.join(target.select(*keys), keys, "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


def update_where(df: DataFrame, condition: Column, assignments: dict[str, Column]) -> DataFrame:
    """Set columns where the condition is true; NULL leaves the row alone."""
    chosen = F.coalesce(condition, F.lit(False))
    return df.select(
        *[
            F.when(chosen, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c)
            for c in df.columns
        ]
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop rows where the condition is true; NULL keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


# ---- log operators --------------------------------------------------------


def newest_rows(log: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row of each key, unless that row is a deletion."""
    newest = Window.partitionBy(*keys).orderBy(F.desc("_version"))
    aged = log.withColumn("_age", F.row_number().over(newest))
    return aged.filter((F.col("_age") == 1) & (F.col("_op") == "U")).drop("_age")


def snapshot(
    log: DataFrame, keys: list[str], version: int | None = None, timestamp: str | None = None
) -> DataFrame:
    """The table as of a version, a time, or now."""
    if version is not None:
        log = log.filter(F.col("_version") <= version)
    if timestamp is not None:
        log = log.filter(F.col("_committed_at") <= F.lit(timestamp).cast("timestamp"))
    return newest_rows(log, keys).select(*payload(log))


def history(log: DataFrame) -> DataFrame:
    """One row per commit with its operation and its live and deleted row counts."""
    # a commit has one operation; as a grouping key it needs no sort, as a text minimum it would
    return log.groupBy("_version", F.col("_operation").alias("operation")).agg(
        F.count_if(F.col("_op") == "U").alias("rows_written"),
        F.count_if(F.col("_op") == "D").alias("rows_deleted"),
        F.min("_committed_at").alias("committed_at"),
    )


def row_counts(log: DataFrame, keys: list[str]) -> DataFrame:
    """Live rows after every version, in one pass over the log."""
    by_version = Window.partitionBy(*keys).orderBy("_version")
    live = (F.col("_op") == "U").cast("long")
    was_live = (F.lag("_op").over(by_version) == "U").cast("long")
    steps = (
        log.withColumn("_step", live - F.coalesce(was_live, F.lit(0)))
        .groupBy("_version")
        .agg(F.sum("_step").alias("_step"))
    )
    # one row per version is left here
    so_far = Window.orderBy("_version").rowsBetween(Window.unboundedPreceding, 0)
    return steps.select("_version", F.sum("_step").over(so_far).alias("row_count"))


def vacuum_dry_run(log: DataFrame, keys: list[str], retain_version: int) -> DataFrame:
    """Rows that no read at ``retain_version`` or later can return."""
    following = F.lead("_version").over(Window.partitionBy(*keys).orderBy("_version"))
    replaced = F.coalesce(F.col("_next") <= retain_version, F.lit(False))
    dead = (F.col("_op") == "D") & (F.col("_version") <= retain_version)
    return log.withColumn("_next", following).filter(replaced | dead).drop("_next")


def restore_change(
    log: DataFrame, keys: list[str], version: int, new_version: int, committed_at: Column | None = None
) -> DataFrame:
    """The commit that brings the table back to ``version``: only keys that differ."""
    others = [c for c in payload(log) if c not in keys]
    row = F.struct("_version", "_op", *others)
    ends = log.groupBy(*keys).agg(
        F.max(F.when(F.col("_version") <= version, row)).alias("then"),
        F.max(F.struct("_version", "_op")).alias("now"),
    )
    was_live = F.coalesce(F.col("then._op") == "U", F.lit(False))
    moved = ~F.col("then._version").eqNullSafe(F.col("now._version"))
    changed = ends.filter(moved & (was_live | (F.col("now._op") == "U")))
    rows = changed.select(*keys, *[F.col(f"then.{c}").alias(c) for c in others], was_live.alias("_was_live"))
    return (
        as_change(rows, new_version, "U", "RESTORE", committed_at)
        .withColumn("_op", F.when(F.col("_was_live"), "U").otherwise("D"))
        .drop("_was_live")
    )


# ---- a log on shared storage ----------------------------------------------


class VersionedTable:
    """A change log kept as one Parquet folder per version.

    Spark's own ``_SUCCESS`` marker tells a finished version from a failed one,
    and a failed version is overwritten by the next change.

    With ``buckets``, every commit is written as that many files, dealt by a hash of
    the keys and sorted by them, and a read goes through a catalog table that says
    so. A commit shuffles its own rows; a read, and a join of the log on its keys,
    shuffles nothing of the log, however many versions it holds. Choose at least as
    many buckets as shuffle partitions, and keep the number for the table's life.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int | None = None):
        self.spark, self.path, self.keys, self.buckets = spark, path, keys, buckets

    def versions(self) -> list[int]:
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        done = [
            s.getPath().getName().removeprefix("_version=")
            for s in fs.listStatus(root)
            if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
        ]
        return sorted(int(v) for v in done)

    def schema(self, version: int | None = None) -> StructType:
        """The log's columns as of a version; every commit is written with all of them."""
        at = max(v for v in self.versions() if version is None or v <= version)
        return self.spark.read.parquet(f"{self.path}/_version={at}").schema

    def log(self, version: int | None = None) -> DataFrame:
        """Committed changes up to a version; older folders are pruned by name."""
        last = max(v for v in self.versions() if version is None or v <= version)
        if self.buckets:
            return self.spark.table(self._catalog_table(last)).filter(F.col("_version") <= last)
        schema = StructType(self.schema(last).fields).add("_version", "long")
        return self.spark.read.schema(schema).parquet(self.path).filter(F.col("_version") <= last)

    def _catalog_table(self, last: int) -> str:
        """The name of a table over the commits up to ``last``, which tells Spark how their files are dealt."""
        name = f"log_{sha256(self.path.encode()).hexdigest()[:24]}_{last}"
        if not self.spark.catalog.tableExists(name):
            fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema(last).fields]
            keys = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(
                f"CREATE TABLE {name} ({', '.join(fields)}, _version BIGINT) USING parquet PARTITIONED BY (_version)"
                f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
            )
            parts = " ".join(f"PARTITION (_version = {v})" for v in self.versions() if v <= last)
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
        return name

    def as_of(self, version: int | None = None, timestamp: str | None = None) -> DataFrame:
        return snapshot(self.log(version), self.keys, version, timestamp)

    def history(self) -> DataFrame:
        return history(self.log())

    def _commit(self, change: DataFrame) -> int:
        done = self.versions()
        version = done[-1] + 1 if done else 0
        no_key = reduce(and_, [F.col(k).isNotNull() for k in self.keys])
        fail = F.raise_error(F.lit("a versioned table needs non-NULL keys")).cast("boolean")
        checked = change.filter(F.when(no_key, F.lit(True)).otherwise(fail))
        self._write(checked.drop("_version"), version)
        return version

    def _write(self, rows: DataFrame, version: int) -> None:
        folder = f"{self.path}/_version={version}"
        if not self.buckets:
            rows.write.mode("overwrite").parquet(folder)
            return
        name = f"commit_{uuid4().hex}"
        dealt = rows.repartition(self.buckets, *self.keys).write.mode("overwrite").option("path", folder)
        dealt.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay

    def _aligned(self, df: DataFrame, evolve: bool) -> DataFrame:
        known = {f.name: f.dataType for f in self.schema().fields if f.name not in META}
        given = {f.name: f.dataType for f in df.schema.fields}
        extra = [c for c in given if c not in known]
        changed = [c for c in given if c in known and given[c] != known[c]]
        if changed or (extra and not evolve):
            raise ValueError(f"schema mismatch: new columns {extra}, changed types {changed}")
        missing = {c: F.lit(None).cast(t) for c, t in known.items() if c not in given}
        return df.withColumns(missing).select(*known, *extra)

    def create(self, df: DataFrame, committed_at: Column | None = None) -> bool:
        """Write version 0 if the table is absent; tells whether it did."""
        if self.versions():
            return False
        self._commit(as_change(unique_keys(df, self.keys), 0, "U", "CREATE", committed_at))
        return True

    def insert(self, df: DataFrame, evolve: bool = False, committed_at: Column | None = None) -> int:
        """Append rows with new keys; fails at run time on a key that is there already."""
        rows = unique_keys(self._aligned(df, evolve), self.keys)
        fail = F.raise_error(F.lit("insert of a key that the table holds")).cast("boolean")
        there = self.as_of().select(*self.keys, F.lit(True).alias("_there"))
        new = rows.join(there, self.keys, "left").filter(F.when(F.col("_there"), fail).otherwise(F.lit(True)))
        return self._commit(as_change(new.drop("_there"), 0, "U", "INSERT", committed_at))

    def update(self, condition: Column, assignments: dict[str, Column], committed_at: Column | None = None) -> int:
        touched = self.as_of().filter(condition)
        return self._commit(
            as_change(update_where(touched, F.lit(True), assignments), 0, "U", "UPDATE", committed_at)
        )

    def delete(self, condition: Column, committed_at: Column | None = None) -> int:
        return self._commit(as_change(self.as_of().filter(condition), 0, "D", "DELETE", committed_at))

    def merge(
        self,
        source: DataFrame,
        when_matched: str = "update",
        insert: bool = True,
        evolve: bool = False,
        committed_at: Column | None = None,
    ) -> int:
        """Upsert without reading the target: the newest row of a key wins on read."""
        if when_matched == "update":
            refuse_narrower(source, [c for c in self.as_of().columns])
        source = self._aligned(unique_keys(source, self.keys), evolve)
        present = self.as_of().select(*self.keys)
        parts = []
        if when_matched == "update" and insert:
            parts = [(source, "U")]
        else:
            if when_matched != "ignore":
                matched = source.join(present, self.keys, "left_semi")
                parts.append((matched, "U" if when_matched == "update" else "D"))
            if insert:
                parts.append((source.join(present, self.keys, "left_anti"), "U"))
        changes = [as_change(rows, 0, op, "MERGE", committed_at) for rows, op in parts]
        return self._commit(reduce(DataFrame.unionByName, changes))

    def overwrite(self, df: DataFrame, committed_at: Column | None = None) -> int:
        """Replace all rows; columns may be added or dropped but keep their types."""
        live = self.as_of()
        known = {f.name: f.dataType for f in live.schema.fields}
        changed = [f.name for f in df.schema.fields if known.get(f.name, f.dataType) != f.dataType]
        if changed:
            raise ValueError(f"schema mismatch: changed types {changed}")
        df = unique_keys(df, self.keys)
        gone = live.join(df.select(*self.keys), self.keys, "left_anti").select(*self.keys)
        rows = as_change(df, 0, "U", "OVERWRITE", committed_at)
        dead = as_change(gone, 0, "D", "OVERWRITE", committed_at)
        return self._commit(rows.unionByName(dead, allowMissingColumns=True))

    def restore(self, version: int, committed_at: Column | None = None) -> int:
        return self._commit(restore_change(self.log(), self.keys, version, 0, committed_at))

    def compact_to(self, path: str, retain_version: int) -> VersionedTable:
        """The table as of ``retain_version`` as a new base, with the later commits copied as they are."""
        slim = VersionedTable(self.spark, path, self.keys, self.buckets)
        base = newest_rows(self.log(retain_version), self.keys).withColumn("_operation", F.lit("COMPACT"))
        slim._write(base.drop("_version"), retain_version)
        for v in self.versions():
            if v > retain_version:
                slim._write(self.spark.read.parquet(f"{self.path}/_version={v}"), v)
        return slim
