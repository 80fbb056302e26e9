"""Layer tables on plain parquet.

Files of a table are written once and never changed. A version is a small listing that names, for
every slot (a day, or the whole table), the folders that hold its rows now. Writers add folders and
then publish the next listing, so readers always see one whole version, and a failed write leaves
nothing behind that anyone reads. The listing has one line per day, so its size follows the
calendar and not the data.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .files import age_seconds, matching_paths, publish_text, read_text, removed

SLOT, FOLDER = "_slot", "_written"
WHOLE = "whole"
NO_DATE = "none"
Check = Callable[[DataFrame], object]


class LayerTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: str | StructType,
        slot: str | None = None,
    ):
        """``slot`` is a SQL expression for the date (a day, or the first day of a longer period)
        that a row is filed under; without it the table is one slot."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.slot = slot

    # -- listings ---------------------------------------------------------------------------

    def version(self) -> int:
        """Number of the last published version, 0 for a table never written."""
        listings = matching_paths(self.spark, f"{self.root}/versions/*.json")
        return max((int(p.split("/")[-1].removesuffix(".json")) for p in listings), default=0)

    def _listing_path(self, version: int) -> str:
        return f"{self.root}/versions/{version:012d}.json"

    def _listing(self, version: int) -> dict[str, dict]:
        if version == 0:
            return {"slots": {}, "batches": {}}
        return json.loads(read_text(self.spark, self._listing_path(version)))

    def slots(self, version: int | None = None) -> dict[str, str]:
        """Slot -> folder of a version, the last one by default."""
        return self._listing(self.version() if version is None else version)["slots"]

    def changed_slots(self, since: int) -> list[str]:
        """Slots whose rows differ between version ``since`` and now: all, if that version's listing
        has expired."""
        known = since == 0 or matching_paths(self.spark, self._listing_path(since))
        old, new = self.slots(since) if known else {}, self.slots()
        return sorted(s for s in old.keys() | new.keys() if old.get(s) != new.get(s))

    def last_batch(self, writer: str) -> int:
        """Number of the last batch a streaming writer has published here, -1 for none."""
        return self._listing(self.version())["batches"].get(writer, -1)

    # -- reading ----------------------------------------------------------------------------

    def slot_of(self) -> Column:
        """Slot of a row as text."""
        if self.slot is None:
            return F.lit(WHOLE)
        return F.coalesce(F.expr(f"CAST(CAST({self.slot} AS DATE) AS STRING)"), F.lit(NO_DATE))

    def read(self, slots: Iterable[str] | None = None) -> DataFrame:
        """Current rows, of some slots only if given; other slots' files are not listed."""
        current = self.slots()
        wanted = current.keys() if slots is None else set(slots) & current.keys()
        return self._read({slot: current[slot] for slot in wanted})

    def between(self, column: str, low, high) -> DataFrame:
        """Current rows whose ``column`` is from ``low`` to ``high``; only the slots that such
        rows can be in are listed. The slot must follow from this column and grow with it."""
        kind = self.schema[column].dataType
        ends = self.spark.createDataFrame([(0,)], "i INT").select(
            F.explode(F.array(F.lit(low).cast(kind), F.lit(high).cast(kind))).alias(column)
        ).select(self.slot_of().alias("slot"))
        first, last = sorted(r.slot for r in ends.collect())
        wanted = [s for s in self.slots() if s != NO_DATE and first <= s <= last]
        return self.read(wanted).where(F.col(f"`{column}`").between(low, high))

    def _read(self, folders: dict[str, str]) -> DataFrame:
        paths = [
            f"{self.root}/data/{SLOT}={slot}/{FOLDER}={folder}"
            for slot in sorted(folders) for folder in folders[slot].split(",")
        ]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    # -- writing ----------------------------------------------------------------------------

    def create(self) -> LayerTable:
        """Publish an empty first version unless the table exists."""
        if self.version() == 0:
            self._publish(0, {})
        return self

    def replace(self, rows: DataFrame, check: Check | None = None) -> int:
        """Make ``rows`` the whole content. ``check`` gets the written rows before they are
        published; if it raises, readers keep the old content."""
        base, written = self.version(), self._write(rows)
        if check is not None:
            check(self._read(written))
        return self._publish(base, written, keep=False)

    def append(
        self, rows: DataFrame, batch: tuple[str, int] | None = None, most_folders: int = 32
    ) -> int:
        """Add rows; a slot that has rows already gets a further folder. A slot of more than
        ``most_folders`` is compacted, so neither its files nor its line in the listing grow."""
        base = self.version()
        slots, written = self.slots(base), self._write(rows)
        joined = {s: f"{slots[s]},{f}" if s in slots else f for s, f in written.items()}
        done = self._publish(base, joined, batch=batch)
        crowded = [s for s, f in joined.items() if f.count(",") >= most_folders]
        return self.compact(crowded) if crowded else done

    def expire(self, versions: int = 1, older_than: float = 7 * 86_400) -> int:
        """Delete what the last ``versions`` listings don't name: older listings, replaced folders
        and what failed writes left. Nothing younger than ``older_than`` seconds goes, which
        must exceed the longest write and the longest read. Returns the number deleted."""
        last = self.version()
        listings = {n: self._listing(n) for n in range(max(1, last - versions + 1), last + 1)}
        named = {(s, f) for one in listings.values() for s, fs in one["slots"].items() for f in fs.split(",")}
        old = [p for p in matching_paths(self.spark, f"{self.root}/versions/*.json")
               if int(p.split("/")[-1].removesuffix(".json")) not in listings]
        for path in matching_paths(self.spark, f"{self.root}/data/{SLOT}=*/{FOLDER}=*"):
            slot, folder = path.split(f"{SLOT}=")[1].split(f"/{FOLDER}=")
            if (slot, folder) not in named:
                old.append(path)
        gone = [p for p in old if age_seconds(self.spark, p) >= older_than]
        for path in gone:
            removed(self.spark, path)
        return len(gone)

    def compact(self, slots: Iterable[str] | None = None) -> int:
        """Rewrite slots made of several folders into one folder each."""
        current = self.slots()
        chosen = current.keys() if slots is None else set(slots) & current.keys()
        split = [s for s in chosen if "," in current[s]]
        return self.rewrite(self.read(split), split) if split else self.version()

    def rewrite(
        self, rows: DataFrame, touched: Iterable[str], batch: tuple[str, int] | None = None,
        check: Check | None = None, arranged: bool = False,
    ) -> int:
        """Put ``rows`` in place of the slots ``touched``; a touched slot without rows is gone.
        ``arranged`` rows have few slots per task already and are written as they come."""
        base, written = self.version(), self._write(rows, arranged)
        if check is not None:
            check(self._read(written))
        return self._publish(base, written, set(touched), batch=batch)

    def by_slot(self, rows: DataFrame) -> DataFrame:
        """Rows shuffled so that a slot gets few files, and a heavy slot is spread over tasks."""
        if self.slot is None:
            return rows
        return rows.withColumn(SLOT, self.slot_of()).hint("rebalance", SLOT).drop(SLOT)

    def _write(self, rows: DataFrame, arranged: bool = False) -> dict[str, str]:
        folder = uuid.uuid4().hex
        typed = rows.select(*[
            F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields
        ])
        out = (typed if arranged else self.by_slot(typed)).select(
            "*", self.slot_of().alias(SLOT), F.lit(folder).alias(FOLDER)
        )
        out.write.partitionBy(SLOT, FOLDER).mode("append").parquet(f"{self.root}/data")
        found = matching_paths(self.spark, f"{self.root}/data/{SLOT}=*/{FOLDER}={folder}")
        return {path.split(f"{SLOT}=")[1].split("/")[0]: folder for path in found}

    def _publish(
        self,
        base: int,
        written: dict[str, str],
        touched: set[str] | None = None,
        keep: bool = True,
        batch: tuple[str, int] | None = None,
    ) -> int:
        listing = self._listing(base)
        slots = listing["slots"] if keep else {}
        slots = {s: f for s, f in slots.items() if s not in (touched or ())} | written
        batches = listing["batches"] | ({batch[0]: batch[1]} if batch is not None else {})
        # One writer per table: a second one is noticed only if it has published before this check.
        publish_text(
            self.spark, self._listing_path(base + 1),
            json.dumps({"slots": slots, "batches": batches}, indent=0, sort_keys=True),
        )
        return base + 1
