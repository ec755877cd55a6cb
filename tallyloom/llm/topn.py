"""The N best items of every group, with a total order, when some groups are huge.

Method: hot-cold split. The first row of every item of a group is found once, spread by group and item, and written. Exact counts
of these (a partial aggregate, one state per group and task) tell the heavy groups. Light groups are ranked by an ordinary
window. Heavy groups are range-partitioned by their sort order, with a salt that also splits ties, so that one
group spreads over many tasks; each task keeps the first N of its range, and a last window ranks those few. Both parts are united.

A group is heavy if it has more rows than a task's equal share of all rows. So there are fewer heavy groups than tasks,
which bounds their list, and a light group fits into a task, whatever the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, parallelism


def heavy_groups(rows: DataFrame, group: str, tasks: int) -> list:
    """The groups with more than ``1 / tasks`` of all rows, by exact counts, largest first; there are fewer than ``tasks``."""
    counts = materialize(rows.groupBy(group).agg(F.count(F.lit(1)).alias("n")), "group-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [r[0] for r in counts.filter(F.col("n") * F.lit(tasks) > F.lit(total)).orderBy(F.desc("n"), group).collect()]


def _ranked(rows: DataFrame, by: list[str], order: list[Column], n: int, out: str = "rank_no") -> DataFrame:
    return rows.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(out) <= n)


def first_of_ranges(rows: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group in each partition of ``rows``.

    Spark does that itself below the next shuffle, as a limit of each group, but only up to a set ``n``. Beyond it the partitions are
    ranked by a window of their own.
    """
    if n <= int(rows.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        return rows
    numbered = rows.withColumn("__range_no", F.spark_partition_id())
    return _ranked(numbered, ["__range_no", group], order, n, "__range_rank").drop("__range_no", "__range_rank")


def top_n(rows: DataFrame, group: str, item: str, order: list[Column], n: int, tasks: int | None = None) -> DataFrame:
    """``rows`` restricted to the first ``n`` items of each group, with ``rank_no`` from 1.

    ``order`` sorts the rows of a group and must end with ``item``, so that equal scores have one
    order; an item with several rows counts once, by its first row. Groups with fewer items keep all
    of them. Rows with a null group or item are dropped; an empty input gives no rows; equal rows
    count once. ``tasks`` is how many parts the rows are meant to be spread over, by default the shuffle partitions.
    """
    tasks = tasks or parallelism(rows.sparkSession)
    rows = rows.filter(F.col(group).isNotNull() & F.col(item).isNotNull())
    once = materialize(_ranked(rows, [group, item], order, 1, "__k").drop("__k"), "first-of-item")
    hot = heavy_groups(once, group, tasks)
    is_hot = F.col(group).isin(hot) if hot else F.lit(False)
    best = _ranked(once.filter(~is_hot), [group], order, n)
    if not hot:
        return best
    salt = F.pmod(F.xxhash64(*once.columns), F.lit(1024))
    ranges = once.filter(is_hot).repartitionByRange(tasks, F.col(group), *order, salt)
    return best.unionByName(_ranked(first_of_ranges(ranges, group, order, n), [group], order, n))
