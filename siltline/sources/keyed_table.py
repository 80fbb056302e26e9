"""Tables of one row per key on Spark's own partitions.

Rows lie in parquet partitions by slot (a date) and by a hash bucket of the key. A merge reads the
buckets of its keys only, through partition filters, and rewrites the (slot, bucket) partitions that
hold an old or a new row of a changed key. Each commit also keeps what it changed as signed rows, from
which facts and metrics are kept up to date.

A commit is prepared beside the table and then decided by one small file; publishing it renames the
written partitions into place, as Spark's own commit of a dynamic overwrite does, and can be repeated, so a driver that is lost half way is made good by the next writer. One writer per table at
a time. Readers that opened the table before a commit must open it again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.changes import kept_rows, merge_in_sequence
from ..operators.joins import is_small
from .files import matching_paths, moved, publish_text, read_text, removed
from .staging import staged

SLOT, BUCKET, VERSION, SIGN, MET = "_slot", "_bucket", "_version", "_sign", "_met"
WHOLE, NO_DATE = "whole", "none"
Pair = tuple[str, int]
Check = Callable[[DataFrame], object]
# Changed keys alone, without their rows, are broadcast up to this number and so many bytes.
KEY_ROWS, KEY_BYTES = 2_000_000, 32 * 1024 * 1024
# A merge into at most so many partitions is written by the tasks that read the rows: as many files of
# Spark's least reckoned size as one task reads, so their number stays bounded from merge to merge.
FEW_PARTITIONS = 32


def _in_pairs(located: DataFrame, pairs: Iterable[Pair]) -> DataFrame:
    """Rows of the given partitions."""
    pairs = list(pairs)
    rows = located.where(F.col(SLOT).isin(sorted({s for s, _ in pairs})) & F.col(BUCKET).isin(sorted({b for _, b in pairs})))
    return rows.where(F.concat_ws("/", SLOT, BUCKET).isin([f"{s}/{b}" for s, b in pairs]))


class KeyedTable:
    def __init__(
        self, spark: SparkSession, root: str, schema: str | StructType, keys: Sequence[str],
        slot: str | None = None, buckets: int = 8,
    ):
        """``slot`` is a SQL expression for the date a row is filed under; without it there are only
        ``buckets``, which stay as they are for the life of the table."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.keys, self.slot, self.buckets = list(keys), slot, buckets
        self.names = self.schema.fieldNames()

    # -- places of rows ---------------------------------------------------------------------

    def slot_of(self) -> Column:
        if self.slot is None:
            return F.lit(WHOLE)
        return F.coalesce(F.expr(f"CAST(CAST({self.slot} AS DATE) AS STRING)"), F.lit(NO_DATE))

    def bucket_of(self) -> Column:
        typed = [F.col(f"`{k}`").cast(self.schema[k].dataType) for k in self.keys]
        return F.pmod(F.xxhash64(*typed), F.lit(self.buckets)).cast("int")

    def _placed(self, rows: DataFrame, *more: str) -> DataFrame:
        typed = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields], *more)
        return typed.withColumns({SLOT: self.slot_of(), BUCKET: self.bucket_of()})

    # -- commits ----------------------------------------------------------------------------

    def _versions(self) -> list[int]:
        return sorted(int(p.split("/")[-1]) for p in matching_paths(self.spark, f"{self.root}/versions/*") if p[-1].isdigit())

    def version(self) -> int:
        """Number of the last published commit, 0 for a table never written."""
        return max(self._versions(), default=0)

    def _commit(self, version: int) -> dict:
        if version == 0:
            return {"marks": {}, "reset": False}
        return json.loads(read_text(self.spark, f"{self.root}/versions/{version:012d}"))

    def marks(self) -> dict[str, int]:
        """For each writer or source the last batch or version that is in the table."""
        return self._commit(self.version())["marks"]

    def last_batch(self, writer: str) -> int:
        return self.marks().get(writer, -1)

    # -- reading ----------------------------------------------------------------------------

    def _read(self, path: str) -> DataFrame:
        located = StructType([*self.schema.fields]).add(SLOT, "string").add(BUCKET, "integer")
        if not matching_paths(self.spark, path):
            return self.spark.createDataFrame([], located)
        return self.spark.read.schema(located).parquet(path)

    def located(
        self, slots: Iterable[str] | None = None, buckets: Iterable[int] | None = None,
        pairs: Iterable[Pair] | None = None,
    ) -> DataFrame:
        """Rows with their ``_slot`` and ``_bucket``, of some partitions only if given."""
        rows = self._read(f"{self.root}/data")
        if slots is not None:
            rows = rows.where(F.col(SLOT).isin(list(slots)))
        if buckets is not None:
            rows = rows.where(F.col(BUCKET).isin(list(buckets)))
        if pairs is not None:
            rows = _in_pairs(rows, pairs)
        return rows

    def read(self, slots: Iterable[str] | None = None) -> DataFrame:
        return self.located(slots).select(self.names)

    def between(self, column: str, low, high) -> DataFrame:
        """Rows whose ``column`` is from ``low`` to ``high``; partitions that cannot hold such rows
        are not read. The slot must follow from this column and grow with it."""
        kind = self.schema[column].dataType
        ends = self.spark.range(1).select(
            *[F.array(*[F.lit(v).cast(kind) for v in (low, high)]).alias("ends")]
        ).select(F.explode("ends").alias(column)).select(self.slot_of().alias("slot"))
        first, last = sorted(r.slot for r in ends.collect())
        rows = self.located().where(F.col(SLOT).between(first, last) & (F.col(SLOT) != NO_DATE))
        return rows.where(F.col(f"`{column}`").between(low, high)).select(self.names)

    def partitions(self) -> set[Pair]:
        """(slot, bucket) of all partitions that hold rows."""
        return self._partitions("data")

    def _partitions(self, below: str) -> set[Pair]:
        found = matching_paths(self.spark, f"{self.root}/{below}/{SLOT}=*/{BUCKET}=*")
        return {(p.split(f"{SLOT}=")[1].split("/")[0], int(p.split(f"{BUCKET}=")[1])) for p in found}

    def changes(self, since: int) -> DataFrame | None:
        """Signed rows of the commits after version ``since``: ``_sign`` -1 for a row that went, +1 for
        one that came, with ``_version``. None if the table was replaced since, or the commits have
        expired; who follows the table then reads it whole."""
        versions = [v for v in self._versions() if v > since]
        if since < 0 or len(versions) != self.version() - since or any(self._commit(v)["reset"] for v in versions):
            return None
        kind = StructType([*self.schema.fields]).add(SIGN, "integer").add(VERSION, "integer")
        if not versions:
            return self.spark.createDataFrame([], kind)
        rows = self.spark.read.schema(kind).parquet(f"{self.root}/changes")
        return rows.where(F.col(VERSION).between(versions[0], versions[-1]) & (F.col(SIGN) != 0))

    # -- writing ----------------------------------------------------------------------------

    def create(self) -> KeyedTable:
        self.recover()
        return self

    def merge(
        self, changes: DataFrame, marks: Mapping[str, int] | None = None,
        sequence: Sequence[str] = (), written: bool = False,
    ) -> int:
        """Apply changes (one per key, with ``is_delete``); the table's new version.

        ``marks`` tell what the commit has worked off. With ``sequence`` a change older than the
        table's row has no effect; the table then keeps those columns and ``is_delete``.
        """
        self.recover()
        base = self.version()
        folder = f"{self.root}/changes/{VERSION}={base + 1}"
        if not sequence:  # written once, as what the commit keeps of them; a key to delete has sign 0
            marked = changes.withColumn(SIGN, F.when(F.col("is_delete"), 0).when(~F.col("is_delete"), 1).otherwise(0))
            marked = self._placed(marked, SIGN)
            marked.write.mode("overwrite").parquet(folder)
            changes = self.spark.read.schema(marked.schema).parquet(folder).withColumn("is_delete", F.col(SIGN) == 0)
        elif not written:
            changes = staged(changes, "changes")
        key = self.keys[0]
        seen = changes.agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high"),
                           F.collect_set(self.bucket_of()).alias("buckets")).first()
        if seen.n == 0 and not marks:
            removed(self.spark, folder)
            return base
        changed = changes.select(*self.keys)
        in_range = F.coalesce(F.col(key).between(seen.low, seen.high), F.lit(False))
        near = self.located(buckets=seen.buckets).where(F.col(key).between(seen.low, seen.high))
        small = is_small(changed, KEY_ROWS, KEY_BYTES)
        if small:
            changed = F.broadcast(changed)
            places = near.select(*self.keys, SLOT, BUCKET).join(changed, self.keys, "left_semi").select(SLOT, BUCKET).distinct()
            held = [(r[SLOT], r[BUCKET]) for r in places.collect()]
            old = self.located(pairs=held).join(changed, self.keys, "left_semi").select(self.names)
        else:
            # The join shuffles, so it is done once, for the rows that go and for those that stay.
            found = changed.dropDuplicates().withColumn(MET, F.lit(True))
            near = staged(near.join(found, self.keys, "left").select(*self.names, SLOT, BUCKET, MET), "near")
            old = near.where(MET).select(self.names)
        signed = self._placed(old.withColumn(SIGN, F.lit(-1)), SIGN)
        if sequence:
            new = merge_in_sequence(old, changes, self.keys, sequence)
            signed = signed.unionByName(self._placed(new.withColumn(SIGN, F.lit(1)), SIGN))
        signed.write.mode("overwrite" if sequence else "append").parquet(folder)
        signed = self.spark.read.schema(signed.schema).parquet(folder).where(f"{SIGN} <> 0")
        touched = {(r[SLOT], r[BUCKET]) for r in signed.select(SLOT, BUCKET).distinct().collect()}
        kept = self.located(pairs=touched)
        if small:
            kept = kept_rows(kept, changed, self.keys)
        else:
            stay = _in_pairs(near.where(F.col(MET).isNull()).drop(MET), touched)
            kept = kept.where(~in_range).unionByName(stay)
        came = signed.where(f"{SIGN} = 1").drop(SIGN)
        # Where there are few partitions, each task may have files in all of them without a shuffle.
        if len(touched) > FEW_PARTITIONS:
            came = self._together(came)
        return self._decide(kept.unionByName(came), touched, marks)

    def replace(self, rows: DataFrame, check: Check | None = None, marks: Mapping[str, int] | None = None) -> int:
        """Make ``rows`` the whole content. ``check`` gets the written rows before they are published;
        if it raises, the table keeps its content."""
        self.recover()
        return self._decide(self._together(self._placed(rows)), self.partitions(), marks, check, reset=True)

    def expire(self, keep: int = 16) -> int:
        """Forget the changes of all but the last ``keep`` commits. Returns the number forgotten."""
        old = [v for v in self._versions() if v <= self.version() - keep]
        for v in old:
            removed(self.spark, f"{self.root}/changes/{VERSION}={v}")
            removed(self.spark, f"{self.root}/versions/{v:012d}")
        return len(old)

    def _together(self, located: DataFrame) -> DataFrame:
        """Rows of a partition in few tasks, those of a heavy one spread."""
        return located.hint("rebalance", SLOT, BUCKET)

    def _decide(
        self, located: DataFrame, touched: set[Pair], marks: Mapping[str, int] | None,
        check: Check | None = None, reset: bool = False,
    ) -> int:
        base = self.version()
        rows = f"{self.root}/pending/rows"
        located.write.partitionBy(SLOT, BUCKET).mode("overwrite").parquet(rows)
        if check is not None:
            check(self._read(rows).select(self.names))
        full = self._partitions("pending/rows")
        publish_text(self.spark, f"{self.root}/pending/commit", json.dumps({
            "version": base + 1, "reset": reset, "emptied": sorted(touched - full),
            "marks": self.marks() | dict(marks or {})}))
        self._publish()
        return base + 1

    def recover(self) -> None:
        """Finish a commit that was decided; forget one that was not."""
        if matching_paths(self.spark, f"{self.root}/pending/commit"):
            self._publish()
        elif matching_paths(self.spark, f"{self.root}/pending"):
            removed(self.spark, f"{self.root}/pending")

    def _publish(self) -> None:
        """Every step can be repeated; the last but one makes the commit known."""
        commit = json.loads(read_text(self.spark, f"{self.root}/pending/commit"))
        for slot, bucket in sorted(self._partitions("pending/rows")):
            place = f"{SLOT}={slot}/{BUCKET}={bucket}"
            moved(self.spark, f"{self.root}/pending/rows/{place}", f"{self.root}/data/{place}")
        for slot, bucket in commit["emptied"]:
            removed(self.spark, f"{self.root}/data/{SLOT}={slot}/{BUCKET}={bucket}")
        name = f"{self.root}/versions/{commit['version']:012d}"
        if not matching_paths(self.spark, name):
            publish_text(self.spark, name, json.dumps({"marks": commit["marks"], "reset": commit["reset"]}))
        removed(self.spark, f"{self.root}/pending")
