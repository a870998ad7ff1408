"""Attach one row per group to the rows of that group, whatever the group sizes.

Means per sensor, statistics per sensor and window, duplicate counts and hourly
context all have this shape: a large table of rows and a table with one line per
group. Which join is right depends on how many groups there are and how the rows
spread over them, and both are known only at run time:

* The table of groups ends in an exchange of its own, so its true size is known
  before the rows move.
* Groups with more than their part of the rows, one ``HEAVY_SHARE``-th of what a
  shuffle partition gets on average, are broadcast. There can be no more of them
  than ``HEAVY_SHARE`` times the shuffle partitions, whatever the data. Their rows
  take the values from there. The broadcast reads the exchange of the groups, so
  the rows wait for it.
* When the groups turn out to be small, adaptive execution broadcasts all of
  them and the rows are not shuffled at all. Otherwise rows and groups meet in
  a shuffled join in which the rows of heavy groups, needing no partner any
  more, are spread over all partitions. No other group outweighs a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_SHARE = 4

_SPREAD_RANGE = 1 << 30


def attach_group_values(
    rows: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    size: str,
    spread: Sequence[str] = (),
    null_safe: bool = False,
    heavy_share: float = HEAVY_SHARE,
) -> DataFrame:
    """Left join ``values`` of ``groups`` onto ``rows``.

    groups      exactly one row per key
    size        column of ``groups`` with the number of rows of the group
    spread      columns that differ within a group; the rows of heavy groups are
                spread by them and by the input partition they come from
    null_safe   NULL keys are a group like any other; else they match nothing
    """
    if not null_safe:
        # Said here so that both uses of the groups get the same scan filters
        # and share one exchange.
        groups = groups.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))

    carried = list(dict.fromkeys([*values, size]))
    groups = groups.selectExpr(
        *[f"`{k}` AS `__key_{k}`" for k in keys],
        # Always 0, but derived from data: a literal would be folded out of the join.
        f"IF(`{size}` < 0, 1, 0) AS __group_slot",
        *[f"`{c}` AS `__other_{c}`" for c in carried],
    ).repartition(*[f"__key_{k}" for k in keys], "__group_slot")

    # All groups together have at least the rows of the heavy ones, which bounds their number.
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = groups.agg(
        (F.sum(f"__other_{size}") / (heavy_share * partitions)).alias("__part"),
        F.max("__group_slot").alias("__part_slot"),
        F.max(F.xxhash64(*groups.columns)).alias("__part_mark"),
    )
    # The one line of ``part`` meets all groups on a slot that is 0 for each. The partition number
    # keeps this join above the exchange of the groups; the mark makes all uses of the groups ask for
    # the same columns, hence share one exchange.
    slot_above = F.col("__group_slot") + F.lit(0) * F.spark_partition_id()
    heavy = groups.withColumn("__slot_above", slot_above).join(
        F.broadcast(part),
        F.expr(f"__slot_above = __part_slot AND `__other_{size}` > __part AND __part_mark IS NOT NULL"),
    ).selectExpr(
        *[f"`__key_{k}` AS `__heavy_key_{k}`" for k in keys],
        *[f"`__other_{c}` AS `__heavy_{c}`" for c in carried],
    )

    # Only the partition number and the row itself enter the slot, so a task
    # that runs again sends each row to the same place.
    scattered = ", ".join(["spark_partition_id()", *[f"`{c}`" for c in spread]])
    partnerless = f"`__heavy_{size}` IS NOT NULL"
    if not null_safe:
        partnerless += "".join(f" OR `{k}` IS NULL" for k in keys)
    slot = (
        f"IF({partnerless}, 1 + CAST(pmod(xxhash64({scattered}), {_SPREAD_RANGE}) AS INT), 0)"
    )

    equal = "<=>" if null_safe else "="
    same_heavy = " AND ".join(f"`{k}` {equal} `__heavy_key_{k}`" for k in keys)
    same_other = " AND ".join(f"`{k}` {equal} `__key_{k}`" for k in keys)
    joined = (
        rows.join(F.broadcast(heavy), F.expr(same_heavy), "left")
        .selectExpr("*", f"{slot} AS __row_slot")
        .join(groups, F.expr(f"{same_other} AND __row_slot = __group_slot"), "left")
    )

    # Tying each value to the group size, which is never negative, keeps the two
    # uses of the groups at the same columns, hence at one exchange.
    known = f"coalesce(`__heavy_{size}`, `__other_{size}`) >= 0"
    return joined.selectExpr(
        *[f"`{c}`" for c in rows.columns],
        *[f"IF({known}, coalesce(`__heavy_{v}`, `__other_{v}`), NULL) AS `{v}`" for v in values],
    )
