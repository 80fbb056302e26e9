"""The fact and the metrics kept up to date by the changes of the tables they are made of."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from ..operators.joins import is_small
from ..sources.keyed_table import KEY_BYTES, KEY_ROWS, SIGN, VERSION, KeyedTable
from ..sources.staging import staged


def net_changes(signed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What commits together made of each key: ``before`` and ``after`` (structs, NULL for no row).
    Keys that ended as they began are left out."""
    names = [c for c in signed.columns if c not in (SIGN, VERSION)]
    row = F.struct(*names)
    went, came = F.col(SIGN) == -1, F.col(SIGN) == 1
    ends = signed.groupBy(*keys).agg(
        F.min_by(F.when(went, row), F.struct(VERSION, SIGN)).alias("before"),
        F.max_by(F.when(came, row), F.struct(VERSION, SIGN)).alias("after"),
    )
    return ends.where(~F.col("before").eqNullSafe(F.col("after")))


def net_rows(signed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The net changes as signed rows: a row that came and went in between is not among them."""
    both = F.array(*[F.struct(F.lit(sign).alias(SIGN), F.col(c).alias("row")) for sign, c in ((-1, "before"), (1, "after"))])
    return net_changes(signed, keys).select(F.inline(both)).where("row IS NOT NULL").select("row.*", SIGN)


@dataclass(frozen=True)
class Dimension:
    """A table that the fact takes ``columns`` from, by ``key``."""

    table: KeyedTable
    key: str
    columns: Sequence[str]

    def changed_keys(self, since: int) -> DataFrame | None:
        """Keys whose columns of interest are others than at version ``since``."""
        signed = self.table.changes(since)
        if signed is None:
            return None
        net = net_changes(signed, [self.key])
        differs = [~F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}")) for c in self.columns]
        gone = F.col("before").isNull() | F.col("after").isNull()
        return net.where(reduce(lambda a, b: a | b, differs, gone)).select(self.key)


def _restricted(rows: DataFrame, keys: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    return rows.join(F.broadcast(keys) if is_small(keys, KEY_ROWS, KEY_BYTES) else keys, key, how)


def maintain_fact(
    facts: KeyedTable, wide: KeyedTable, dimensions: Sequence[Dimension],
    build: Callable[[DataFrame], DataFrame], propagate_deletes: bool = False,
) -> int:
    """Bring ``wide``, which ``build`` makes of fact rows and dimensions, up to date.

    The change of a join: changed facts are built anew, and so are the unchanged facts of changed
    dimension rows, of both sides together. Facts of a changed dimension row are found by a scan of
    its key column; only partitions that hold one are read whole. Rows deleted upstream stay unless
    ``propagate_deletes``. Where changes are not known (first run, replaced or expired), everything
    is built.
    """
    marks = {"facts": facts.version()} | {d.key: d.table.version() for d in dimensions}
    seen = wide.marks()
    if all(seen.get(name) == version for name, version in marks.items()):
        return wide.version()
    signed = facts.changes(seen.get("facts", -1))
    moved = [d.changed_keys(seen.get(d.key, -1)) for d in dimensions]
    if signed is None or any(m is None for m in moved):
        built = build(facts.read())
        if propagate_deletes or wide.version() == 0:
            return wide.replace(built, marks=marks)
        return wide.merge(built.withColumn("is_delete", F.lit(False)), marks)
    net = staged(net_changes(signed, facts.keys).drop("before"), "net")
    rows, earlier = [], []
    for dimension, keys in zip(dimensions, moved):
        keys = staged(keys, "moved")
        if keys.isEmpty():
            continue
        near = _restricted(facts.located().select(dimension.key, "_slot", "_bucket"), keys, dimension.key)
        pairs = [(r[0], r[1]) for r in near.select("_slot", "_bucket").distinct().collect()]
        theirs = _restricted(facts.located(pairs=pairs), keys, dimension.key).select(facts.names)
        # a fact can hang on changed rows of several dimensions; it is built once
        for other, known in earlier:
            theirs = _restricted(theirs, known, other, "left_anti").select(facts.names)
        earlier.append((dimension.key, keys))
        rows.append(theirs)
    affected = net.where("after IS NOT NULL").select("after.*")
    if rows:
        others = reduce(DataFrame.unionByName, rows)
        affected = affected.unionByName(others.join(net.select(*facts.keys), facts.keys, "left_anti").select(facts.names))
    changes = build(staged(affected, "affected")).withColumn("is_delete", F.lit(False))
    if propagate_deletes:
        gone = net.where("after IS NULL").select(*facts.keys).withColumn("is_delete", F.lit(True))
        changes = changes.unionByName(gone, allowMissingColumns=True)
    return wide.merge(changes, marks)


@dataclass(frozen=True)
class Metric:
    """Totals per group of a table's rows: ``n_rows``, sums, smallest and largest values.

    ``keys``, ``sums``, ``lows`` and ``highs`` map columns to SQL expressions over the rows. A sum also
    keeps how many values it has, so that no value gives NULL and not 0.
    """

    keys: Mapping[str, str]
    sums: Mapping[str, str] = field(default_factory=dict)
    lows: Mapping[str, str] = field(default_factory=dict)
    highs: Mapping[str, str] = field(default_factory=dict)

    def _parts(self, sign: Column) -> list[Column]:
        out = [F.sum(sign).cast("bigint").alias("n_rows")]
        for name, expression in self.sums.items():
            value = F.expr(expression)
            out += [F.coalesce(F.sum(value * sign), F.lit(0)).alias(name),
                    F.coalesce(F.sum(F.when(value.isNotNull(), sign)), F.lit(0)).cast("bigint").alias(f"_n_{name}")]
        return out

    def _grouped(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*[F.expr(e).alias(k) for k, e in self.keys.items()])

    def totals(self, rows: DataFrame) -> DataFrame:
        """State of all groups of ``rows``."""
        ends = [F.min(F.expr(e)).alias(n) for n, e in self.lows.items()]
        ends += [F.max(F.expr(e)).alias(n) for n, e in self.highs.items()]
        return self._grouped(rows).agg(*self._parts(F.lit(1)), *ends)

    def deltas(self, signed: DataFrame) -> DataFrame:
        """Change of each group: signed sums, and of the ends those of added and of removed rows."""
        went, came = F.col(SIGN) == -1, F.col(SIGN) == 1
        ends = []
        for names, end in ((self.lows, F.min), (self.highs, F.max)):
            for n, e in names.items():
                ends += [end(F.when(came, F.expr(e))).alias(f"_in_{n}"), end(F.when(went, F.expr(e))).alias(f"_out_{n}")]
        return self._grouped(signed).agg(*self._parts(F.col(SIGN)), *ends)

    def state_schema(self, rows: StructType, spark) -> StructType:
        """Columns of the state; sums are as wide as a sum may get."""
        return self.totals(spark.createDataFrame([], rows)).schema

    def adds_up(self, state: StructType, commits: int) -> bool:
        """Whether the signed rows of so many commits give the deltas as they are, without their net.
        A row that came and went cancels out in exact sums; for smallest and largest values the rows
        must be those before and after, as they are in one commit."""
        exact = not any(isinstance(state[n].dataType, (FloatType, DoubleType)) for n in self.sums)
        return exact and (commits == 1 or not (self.lows or self.highs))

    def presented(self, state: DataFrame) -> DataFrame:
        """The totals, sums without any value as NULL."""
        sums = {n: F.when(F.col(f"_n_{n}") > 0, F.col(n)) for n in self.sums}
        return state.withColumns(sums).drop(*[f"_n_{n}" for n in self.sums]) if sums else state


def maintain_metric(source: KeyedTable, state: KeyedTable, metric: Metric) -> int:
    """Bring a metric's state (keyed by the metric's keys) up to date with its source.

    Counts and sums change by the signed sums of the changes. A smallest or largest value can only
    have been lost where a removed row held it; just those groups are computed anew from the
    source. Groups without rows go. NULL is a group like any other. Where the changes are not known,
    everything is computed.
    """
    version = source.version()
    seen = state.last_batch("source")
    if seen == version:
        return state.version()
    marks = {"source": version}
    signed = source.changes(seen)
    if signed is None:
        return state.replace(_keyed(metric.totals(source.read()), metric), marks=marks)
    if not metric.adds_up(state.schema, commits=version - seen):
        signed = net_rows(signed, source.keys)
    delta = staged(_keyed(metric.deltas(signed), metric), "delta")
    buckets = [r[0] for r in delta.select(state.bucket_of()).distinct().collect()]
    held = state.located(buckets=buckets).select(*[F.col(n).alias(f"_old_{n}") for n in state.names])
    both = delta.join(held, F.col(KEY) == F.col(f"_old_{KEY}"), "left")
    counts = ["n_rows", *[c for n in metric.sums for c in (n, f"_n_{n}")]]
    now = {c: F.coalesce(F.col(f"_old_{c}"), F.lit(0)) + F.col(c) for c in counts}
    lost = F.lit(False)
    for names, end, beyond in ((metric.lows, F.least, lambda a, b: a <= b), (metric.highs, F.greatest, lambda a, b: a >= b)):
        for n in names:
            now[n] = end(f"_old_{n}", f"_in_{n}")
            lost = lost | F.coalesce(beyond(F.col(f"_out_{n}"), F.col(f"_old_{n}")) & ~F.coalesce(beyond(F.col(f"_in_{n}"), F.col(f"_out_{n}")), F.lit(False)), F.lit(False))
    changed = staged(both.select(
        KEY, *metric.keys, *[now[c].cast(state.schema[c].dataType).alias(c) for c in state.names if c in now],
        lost.alias("_lost")), "metric")
    result = changed.where("NOT _lost OR n_rows = 0")
    again = changed.where("_lost AND n_rows > 0")
    if not again.isEmpty():
        groups = again.select(F.col(KEY).alias("_again"))
        if is_small(groups):
            groups = F.broadcast(groups)
            fresh = _keyed(metric.totals(source.read().join(groups, _key_of(metric) == F.col("_again"), "left_semi")), metric)
        else:  # tasks add up their rows before anything is shuffled
            fresh = _keyed(metric.totals(source.read()), metric).join(groups, F.col(KEY) == F.col("_again"), "left_semi")
        result = result.drop("_lost").unionByName(fresh)
    return state.merge(result.withColumn("is_delete", F.col("n_rows") == 0).select(*state.names, "is_delete"), marks)


KEY = "_key"  # the group as one text, NULL keys included


def _key_of(metric: Metric) -> Column:
    return F.to_json(F.struct(*[F.expr(e).cast("string").alias(k) for k, e in metric.keys.items()]))


def _keyed(groups: DataFrame, metric: Metric) -> DataFrame:
    return groups.withColumn(KEY, F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in metric.keys])))


@dataclass(frozen=True)
class KeptMetric:
    """A metric of a table, its state below ``root``, and the ``columns`` it is read as (SQL
    expressions over the totals)."""

    source: KeyedTable
    root: str
    metric: Metric
    columns: Mapping[str, str]
    buckets: int = 8

    @property
    def state(self) -> KeyedTable:
        schema = self.metric.state_schema(self.source.schema, self.source.spark).add(KEY, "string")
        return KeyedTable(self.source.spark, self.root, schema, [KEY], buckets=self.buckets)

    def refresh(self) -> int:
        return maintain_metric(self.source, self.state, self.metric)

    def read(self) -> DataFrame:
        totals = self.metric.presented(self.state.read())
        return totals.select(*[F.expr(e).alias(n) for n, e in self.columns.items()])


def sync(table: KeyedTable, rows: DataFrame) -> int:
    """Make a table hold ``rows`` (one per key) by a merge of those that differ, so that what hangs on
    it sees only them. Both are read once and joined."""
    table.recover()
    if table.version() == 0:
        return table.replace(rows)
    names = table.names
    new = rows.select(F.struct(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in table.schema.fields]).alias("new"))
    old = table.read().select(F.struct(*names).alias("old"))
    same = reduce(lambda a, b: a & b, [F.col(f"new.{k}").eqNullSafe(F.col(f"old.{k}")) for k in table.keys])
    differ = new.join(old, same, "full_outer").where(~F.col("new").eqNullSafe(F.col("old")))
    row = F.coalesce("new", "old")
    return table.merge(differ.select(F.inline(F.array(row)), F.col("new").isNull().alias("is_delete")))
