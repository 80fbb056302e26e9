"""Compares plan forms on line items: ours against the plain ones they replace.

    python -m tests.forms [parquet path]
"""

from __future__ import annotations

import os
import statistics
import sys
import time
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from siltline import quality as dq  # noqa: E402
from siltline.operators import shape  # noqa: E402
from siltline.operators.changes import merge_changes  # noqa: E402
from siltline.operators.latest import latest_per_key  # noqa: E402
from siltline.session import local_session  # noqa: E402

def forms(items: DataFrame) -> dict[str, dict[str, DataFrame]]:
    keys = items.select("l_orderkey", "l_linenumber", "l_partkey")
    other = keys.where("l_partkey % 7 <> 0")
    wide = items.select("l_orderkey", "l_quantity", "l_tax", "l_discount", "l_extendedprice")
    values = wide.columns[1:]

    target = items.groupBy("l_orderkey").agg(F.max("l_partkey").alias("v"))
    changes = target.where("l_orderkey % 5 = 0").select(
        "l_orderkey", (F.col("v") + 1).alias("v"), (F.col("l_orderkey") % 15 == 0).alias("is_delete")
    )
    upserts = changes.where("NOT is_delete").select("l_orderkey", "v")
    two_passes = target.join(upserts, "l_orderkey", "left_anti").unionByName(upserts).join(
        changes.where("is_delete"), "l_orderkey", "left_anti"
    )

    order = Window.partitionBy("l_orderkey").orderBy(F.desc("l_shipdate"), F.desc("l_partkey"))
    numbered = items.withColumn("rn", F.row_number().over(order))
    self_join = items.join(numbered, items.columns).where("rn = 1").select(*items.columns).distinct()

    rules = [
        dq.not_null("l_orderkey"), dq.not_null("l_partkey"), dq.accepted_range("l_quantity", 1, 50),
        dq.accepted_range("l_discount", 0, 1), dq.expression_is_true("l_extendedprice > l_quantity"),
        dq.not_constant("l_tax"), dq.at_least_one("l_tax"), dq.not_null_proportion("l_suppkey", 0.9),
    ]
    one_by_one = [
        dq.violations(items, r).agg(F.count("*").alias("failures")) for r in rules
    ]
    return {
        "equality": {
            "one grouping": dq.equality(keys, other).frame,
            "two EXCEPTs": keys.subtract(other).unionByName(other.subtract(keys)),
        },
        "unpivot": {
            "one scan": shape.unpivot(wide, ["l_orderkey"], cast_to="double"),
            "a scan per column": reduce(DataFrame.unionByName, [
                wide.select("l_orderkey", F.lit(c).alias("field_name"),
                            F.col(c).cast("double").alias("value")) for c in values
            ]),
        },
        "merge": {
            "one join": merge_changes(target, changes, ["l_orderkey"]),
            "upserts, then deletes": two_passes,
        },
        "deduplicate": {
            "one window": latest_per_key(items, ["l_orderkey"], ["l_shipdate", "l_partkey"]),
            "self join": self_join,
        },
        "checks": {
            "fused": dq.Suite(items, rules).failures(),
            "one by one": reduce(DataFrame.unionAll, one_by_one),
        },
    }


def main() -> None:
    path = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1/lineitem.parquet"
    spark = local_session("forms", 8, **{
        "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "32"})
    spark.sparkContext.setLogLevel("ERROR")
    print("| operator | form | seconds | scans | exchanges |\n|---|---|---|---|---|")
    for operator, both in forms(spark.read.parquet(path)).items():
        for form, df in both.items():
            plan = df._jdf.queryExecution().executedPlan().toString()
            seconds = []
            for _ in range(4):
                begun = time.perf_counter()
                df.write.format("noop").mode("overwrite").save()
                seconds.append(time.perf_counter() - begun)
            print(f"| {operator} | {form} | {statistics.median(seconds[1:]):.2f} | "
                  f"{plan.count('FileScan')} | {plan.count(' Exchange ')} |", flush=True)


if __name__ == "__main__":
    main()
