"""Row numbers and running values over ordered groups of any size.

A plain window puts a whole group into one task. Groups that are too large for that are cut into
ranges first: every range gets its local values, and the values of the ranges before it are added
from a small table with one row per group and range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetlake.session import cut

MAX_WINDOW_ROWS = 1_000_000


def largest_group(df: DataFrame, group: list[str]) -> int:
    return df.groupBy(*group).count().agg(F.max("count")).first()[0] or 0


def running(
    df: DataFrame,
    group: list[str],
    order: list[str],
    sums: dict[str, str] | None = None,
    maxes: dict[str, str] | None = None,
    max_window_rows: int = MAX_WINDOW_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """``df`` plus, per group in the given order,

    ``rn`` (from 1), ``n`` (rows of the group), for each ``name: column`` of ``sums`` the sum over
    earlier rows (``name``) and over the group (``name_total``), and for each of ``maxes`` the
    maximum over earlier rows. ``order`` must be unique within a group. ``largest`` is the row
    count of the largest group, counted here when it is not given.
    """
    sums, maxes = sums or {}, maxes or {}
    if largest is None:
        largest = largest_group(df, group)
    if largest <= max_window_rows:
        return _by_window(df, group, order, sums, maxes)
    return _by_ranges(df, group, order, sums, maxes)


def _by_window(df, group, order, sums, maxes) -> DataFrame:
    whole = Window.partitionBy(*group)
    ordered = whole.orderBy(*order)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    cols = {"rn": F.row_number().over(ordered).cast("long"), "n": F.count(F.lit(1)).over(whole)}
    for name, col in sums.items():
        cols[name] = F.coalesce(F.sum(col).over(before), F.lit(0))
        cols[f"{name}_total"] = F.sum(col).over(whole)
    for name, col in maxes.items():
        cols[name] = F.max(col).over(before)
    return df.withColumns(cols)


def _by_ranges(df, group, order, sums, maxes) -> DataFrame:
    n_ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n_ranges, *group, *order)
    # The range bounds come from a sample, so the assignment is frozen before it is used twice.
    ranged = cut(ranged.withColumn("_range", F.spark_partition_id()))

    key = [*group, "_range"]
    per_range = ranged.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(f"_s_{name}") for name, c in sums.items()],
        *[F.max(c).alias(f"_m_{name}") for name, c in maxes.items()],
    )
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = {
        "_rn0": F.coalesce(F.sum("_n").over(before), F.lit(0)),
        "n": F.sum("_n").over(whole),
    }
    for name in sums:
        carried[f"_s0_{name}"] = F.coalesce(F.sum(f"_s_{name}").over(before), F.lit(0))
        carried[f"{name}_total"] = F.sum(f"_s_{name}").over(whole)
    for name in maxes:
        carried[f"_m0_{name}"] = F.max(f"_m_{name}").over(before)
    offsets = per_range.withColumns(carried).drop(
        "_n", *[f"_s_{n}" for n in sums], *[f"_m_{n}" for n in maxes]
    )

    local = Window.partitionBy(*key).orderBy(*order)
    earlier = local.rowsBetween(Window.unboundedPreceding, -1)
    right = offsets.withColumnsRenamed({k: f"_k_{k}" for k in key})
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key]
    joined = ranged.join(right, same)
    cols = {"rn": F.row_number().over(local).cast("long") + F.col("_rn0")}
    for name, col in sums.items():
        cols[name] = F.coalesce(F.sum(col).over(earlier), F.lit(0)) + F.col(f"_s0_{name}")
    for name, col in maxes.items():
        cols[name] = F.greatest(F.max(col).over(earlier), F.col(f"_m0_{name}"))
    out = [*df.columns, "rn", "n"]
    for name in sums:
        out += [name, f"{name}_total"]
    return joined.withColumns(cols).select(*out, *maxes)


def last_before(
    rows: DataFrame, bounds: DataFrame, group: list[str], at: str, columns: list[str],
    max_window_rows: int = MAX_WINDOW_ROWS,
) -> DataFrame:
    """``rows`` with ``columns`` of the last of ``bounds`` in its group whose ``at`` is not larger, else null.

    Of bounds at the same place the one with the largest columns counts. Rows and bounds are sorted
    together and the last bound is carried forward, so neither side is broadcast and no row meets more than
    one bound; groups of any size are cut into ranges.
    """
    bound = F.struct(F.col(at).alias("_at"), *columns).alias("_bound")
    both = rows.withColumn("_side", F.lit(1)).unionByName(
        bounds.select(*group, at, F.lit(0).alias("_side"), bound), allowMissingColumns=True
    )
    out = running(both, group, [at, "_side"], maxes={"_last": "_bound"}, max_window_rows=max_window_rows)
    return out.filter("_side = 1").select(*rows.columns, *[F.col(f"_last.{c}").alias(c) for c in columns])
