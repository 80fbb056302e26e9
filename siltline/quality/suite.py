"""Many rules over one table, in as few passes as they allow."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rules import FrameRule, GroupRule, RowRule, Rule, violations


class CheckFailed(Exception):
    """Rules that failed, with their number of failures."""


class Suite:
    """Rules on ``df``.

    All row rules and all rules over the whole table are terms of one aggregation. Rules with the
    same keys share one grouping, whose result is reduced to counts. Only rules that bring their own
    frame run apart.
    """

    def __init__(self, df: DataFrame, rules: Iterable[Rule]):
        self.df = df
        self.rules = list(rules)
        names = [r.name for r in self.rules]
        repeated = sorted({n for n in names if names.count(n) > 1})
        if repeated:
            raise ValueError(f"rules need different names: {', '.join(repeated)}")

    def failures(self) -> DataFrame:
        """``rule``, ``failures``: one row per rule."""
        frames = []
        numbered = list(enumerate(self.rules))
        whole = [
            (i, r) for i, r in numbered
            if isinstance(r, RowRule)
            or (isinstance(r, GroupRule) and not r.keys and not r.where)
        ]
        if whole:
            frames.append(self._whole(whole))
        groups: dict[tuple, list[tuple[int, GroupRule]]] = {}
        for i, rule in numbered:
            if isinstance(rule, GroupRule) and (rule.keys or rule.where):
                groups.setdefault((tuple(rule.keys), rule.where), []).append((i, rule))
        frames += [self._grouped(rules) for rules in groups.values()]
        frames += [
            violations(self.df, r).agg(r.failures.cast("bigint").alias("failures"))
            .select(F.lit(r.name).alias("rule"), "failures")
            for r in self.rules if isinstance(r, FrameRule)
        ]
        return reduce(DataFrame.unionByName, frames)

    def report(self) -> DataFrame:
        """Failures of every rule, set against its thresholds."""
        thresholds = {r.name: (r.warn_if, r.error_if) for r in self.rules}

        def judged(which: int) -> Column:
            test = F.lit(None).cast("boolean")
            for name, limits in thresholds.items():
                test = F.when(
                    F.col("rule") == name, F.expr(f"failures {limits[which]}")
                ).otherwise(test)
            return test

        status = F.when(F.col("should_error"), "error").when(F.col("should_warn"), "warn")
        return self.failures().select(
            "rule", "failures", judged(0).alias("should_warn"), judged(1).alias("should_error")
        ).withColumn("status", status.otherwise("pass"))

    def enforce(self) -> list:
        """Run the suite and raise if a rule is in error; the report's rows otherwise."""
        rows = self.report().collect()  # one row per rule
        failed = [f"{r.rule}: {r.failures}" for r in rows if r.status == "error"]
        if failed:
            raise CheckFailed("; ".join(failed))
        return rows

    def store_failures(self, folder: str) -> dict[str, str]:
        """Write the violations of every rule below ``folder``; rule -> path."""
        paths = {r.name: f"{folder.rstrip('/')}/{i:03d}" for i, r in enumerate(self.rules)}
        for rule in self.rules:
            violations(self.df, rule).write.mode("overwrite").parquet(paths[rule.name])
        return paths

    # -- plans ------------------------------------------------------------------------------

    def _whole(self, rules: list[tuple[int, Rule]]) -> DataFrame:
        measures: list[Column] = []
        counts: list[tuple[str, Column]] = []
        for i, rule in rules:
            if isinstance(rule, RowRule):
                fails = F.expr(rule.where) & rule.fails if rule.where else rule.fails
                measures.append(F.count_if(fails).alias(f"_n{i}"))
                counts.append((rule.name, F.col(f"_n{i}")))
            else:
                measures += self._measures(i, rule)
                counts.append((rule.name, self._fails(i, rule).cast("bigint")))
        return self._rows(self.df.agg(*measures), counts)

    def _grouped(self, rules: list[tuple[int, GroupRule]]) -> DataFrame:
        first = rules[0][1]
        rows = self.df.where(first.where) if first.where else self.df
        grouped = rows.groupBy(*first.key_columns()).agg(
            *[m for i, rule in rules for m in self._measures(i, rule)]
        )
        totals = grouped.agg(*[
            F.count_if(self._fails(i, rule)).alias(f"_n{i}") for i, rule in rules
        ])
        return self._rows(totals, [(rule.name, F.col(f"_n{i}")) for i, rule in rules])

    @staticmethod
    def _measures(i: int, rule: GroupRule) -> list[Column]:
        return [m.alias(f"_m{i}_{n}") for n, m in rule.measures.items()]

    @staticmethod
    def _fails(i: int, rule: GroupRule) -> Column:
        return rule.fails_where(lambda n: f"_m{i}_{n}")

    @staticmethod
    def _rows(totals: DataFrame, counts: list[tuple[str, Column]]) -> DataFrame:
        lines = [
            F.struct(F.lit(name).alias("rule"), n.cast("bigint").alias("failures"))
            for name, n in counts
        ]
        return totals.select(F.inline(F.array(*lines)))
