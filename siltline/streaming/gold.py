"""The wide fact and the daily metrics, kept up to date from the cleaned transactions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.changes import merge_changes
from ..plans.feeds import TRANSACTION_KEYS
from ..sources.layer_table import LayerTable
from .merge import merge_into

Build = Callable[[DataFrame], DataFrame]
SOURCE = "source-version"


def merge_fact(
    silver: LayerTable, gold: LayerTable, build: Build, propagate_deletes: bool = False,
    changed_only: bool = False,
) -> int:
    """Update or insert the fact rows that ``build`` makes of silver rows.

    All silver rows are used, since a fact also changes with its dimensions; ``changed_only`` takes
    just the silver slots that changed since the last merge. Rows that silver no longer has stay,
    unless ``propagate_deletes``.
    """
    version = silver.version()
    seen = gold.last_batch(SOURCE)
    mark = (SOURCE, version)
    if not changed_only or seen < 0:
        rows = silver.read()
        facts = build(rows)
        old = gold.slots()
        merged = facts if propagate_deletes else merge_changes(
            gold.read(), facts.withColumn("is_delete", F.lit(False)), TRANSACTION_KEYS,
            rows.select(*TRANSACTION_KEYS),
        )
        return gold.rewrite(merged, old, mark)
    changed = silver.changed_slots(seen)
    if not changed:
        return gold.version()
    facts = build(silver.read(changed))
    if propagate_deletes:
        # Both tables file a transaction under the same slot, so changed slots are replaced whole.
        return gold.rewrite(facts, changed, mark)
    return merge_into(gold, facts.withColumn("is_delete", F.lit(False)), TRANSACTION_KEYS, mark)


def refresh_metrics(silver: LayerTable, metrics: LayerTable, build: Build) -> int:
    """Rebuild a metric table for the silver slots that changed since the last time.

    The metric's groups must not reach across slots, as days do not.
    """
    version, seen = silver.version(), metrics.last_batch(SOURCE)
    changed = silver.changed_slots(max(seen, 0))
    if seen >= 0 and not changed:
        return metrics.version()
    return metrics.rewrite(build(silver.read(changed)), changed, (SOURCE, version))
