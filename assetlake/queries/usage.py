"""Storage, retention and run-log queries."""

from __future__ import annotations


from assetlake.operators import usage as U
from assetlake.queries.registry import inventory, log, query


@query(
    "storage_usage",
    """
    SELECT CASE WHEN grouping(tag, source, tier, is_meta) = 15 THEN 'total'
        WHEN grouping(tag, source, tier, is_meta) = 14 THEN 'meta' ELSE 'cell' END AS scope,
      tag, source, tier, CAST(sum(length) AS BIGINT) AS bytes, count(*) AS files
    FROM inventory GROUP BY GROUPING SETS ((tag, source, tier, is_meta), (is_meta), ())
    HAVING grouping(tag, source, tier, is_meta) = 15
      OR (grouping(tag, source, tier, is_meta) = 14 AND is_meta)
      OR (grouping(tag, source, tier, is_meta) = 0 AND NOT is_meta)""",
    "inventory",
)
def storage_usage(spark, d):
    return U.storage_usage(inventory(spark, d))


@query(
    "over_cap",
    """SELECT CAST(sum(length) AS BIGINT) AS bytes, CAST(1000000 AS BIGINT) AS cap, sum(length) > 1000000 AS over
       FROM inventory""",
    "inventory",
)
def over_cap(spark, d):
    return U.over_cap(inventory(spark, d), 1_000_000)


@query(
    "retention_keep_tags",
    "SELECT file, tag, length FROM inventory WHERE tag NOT IN ('v2026.05.0', 'v2026.05.1')",
    "inventory",
)
def retention_keep_tags(spark, d):
    plan = U.retention_plan(inventory(spark, d), keep_tags=["v2026.05.0", "v2026.05.1"])
    return plan.select("file", "tag", "length")


@query(
    "retention_cell",
    """
    SELECT count(*) AS files, CAST(sum(length) AS BIGINT) AS bytes FROM inventory
    WHERE tag = 'v2026.04.0' OR (NOT is_meta AND source = 'src3' AND tier = '2k')""",
    "inventory",
)
def retention_cell(spark, d):
    plan = U.retention_plan(inventory(spark, d), tag="v2026.04.0", source="src3", tier="2k")
    return U.bytes_freed(plan)


@query(
    "throughput",
    """
    SELECT run, ok, total, bytes, seconds, ok / greatest(seconds, 0.1::DOUBLE) AS per_second FROM (
      SELECT run, count(*) FILTER (WHERE ok) AS ok, count(*) AS total, CAST(sum(bytes) AS BIGINT) AS bytes,
        (epoch_us(max(ts)) - epoch_us(min(ts)))::DOUBLE / 1000000.0::DOUBLE AS seconds
      FROM log GROUP BY run)""",
    "log",
)
def throughput(spark, d):
    return U.throughput(log(spark, d), ["run"])


@query(
    "parse_inventory",
    "SELECT file, tag, source, tier, is_meta, length FROM inventory",
    "inventory",
)
def parse_inventory(spark, d):
    return inventory(spark, d).select("file", "tag", "source", "tier", "is_meta", "length")


