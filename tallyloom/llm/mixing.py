"""Mixing sources to target weights.

Method: weighted fair queueing. Every source's documents are shuffled by a seeded hash, once for each
time they may appear. The virtual finish time of a document is its source's cumulative tokens, up to
and including it, divided by the source's weight. The mix is all sources merged by virtual finish
time and cut where the total budget is spent: at any point each source has had its share, a small
source comes round again until its documents have appeared ``max_repeats`` times, and what it then
leaves is shared by the others in proportion to their weights.

Both running sums (tokens of a source, tokens of the mix) are taken over ranges: rows are split into
ranges of their order, the sums of the ranges (a bounded number) are accumulated first, and each
range then adds up only its own rows. A source with a third of all rows is spread like any other.
The ranges are computed from the row, not sampled, so a task that runs again gives the same result. At the end the mix is
range-sorted by its order as a whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, parallelism

MAX_SOURCES = 10_000
RANGES_PER_TASK = 4
SUM_ROWS = 1_000_000


def running_sum(rows: DataFrame, lanes: list[str], range_no: str, order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over a lane's rows up to and including this one.

    ``range_no`` is a whole number that rises with the order; within a range, ``order`` sorts. The sums
    of the ranges are one row per lane and range; up to ``SUM_ROWS`` of them are broadcast, more are joined.
    """
    sums = materialize(rows.groupBy(*lanes, range_no).agg(F.sum(value).alias("__own")), "range-sums")
    few = sums.limit(SUM_ROWS + 1).count() <= SUM_ROWS
    before = sums.select(*lanes, range_no, (F.sum("__own").over(Window.partitionBy(*lanes).orderBy(range_no)) - F.col("__own")).alias("__before"))
    within = Window.partitionBy(*lanes, range_no).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("__within", F.sum(value).over(within))
    return summed.join(F.broadcast(before) if few else before, [*lanes, range_no]).withColumn(out, F.col("__before") + F.col("__within")).drop("__before", "__within")


def source_sizes(docs: DataFrame, targets: DataFrame, source: str, size: str) -> list[dict]:
    """The targets with their documents, tokens and capacity, in order of the source. One row a source; more than ``MAX_SOURCES`` is an error.

    A target named twice counts once, with the sum of its weights and the greatest of its repeats. A null
    weight or a null or negative number of repeats is 0.
    """
    goals = targets.filter(F.col("source").isNotNull()).groupBy("source").agg(F.sum(F.coalesce("weight", F.lit(0.0))).alias("weight"), F.max(F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0))).alias("max_repeats"))
    have = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(size).alias("tokens"), F.max(size).alias("largest"))
    found = [r.asDict() for r in goals.join(have, "source", "left").fillna(0, ["n_docs", "tokens", "largest"]).limit(MAX_SOURCES + 1).collect()]
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    total = sum(r["tokens"] for r in found)
    for r in found:
        r["capacity"] = r["tokens"] * r["max_repeats"]
        r["target_tokens"] = r["weight"] * total
        r["is_short"] = r["capacity"] < r["target_tokens"]
    return sorted(found, key=lambda r: r["source"])


def spent_at(sizes: list[dict], budget: float) -> float:
    """The virtual time at which the sources have given ``budget`` tokens; infinite if they can't."""
    left, time = budget, 0.0
    weight = sum(r["weight"] for r in sizes if r["capacity"] and r["weight"])
    for end, w in sorted((r["capacity"] / r["weight"], r["weight"]) for r in sizes if r["capacity"] and r["weight"]):
        if (end - time) * weight >= left:
            return time + left / weight
        left -= (end - time) * weight
        time, weight = end, weight - w
    return math.inf


def mix(docs: DataFrame, targets: DataFrame, doc_id: str = "doc_id", source: str = "source", size: str = "n_tokens", seed: int = 42, budget: int | None = None) -> tuple[DataFrame, list[dict]]:
    """The mix, and the sizes of its sources (``source_sizes``).

    ``docs`` has one row per document: id, source and size; other columns are ignored. Columns of the mix:
    the id, the source, ``copy_no`` from 1, the size, ``finish_time`` and ``mix_end``, the tokens of the mix
    up to and including the row; it ends with the last row whose ``mix_end`` is within the budget (by
    default the tokens of all documents of the listed sources). Sources that aren't listed, with weight 0 or
    with 0 repeats aren't in it. Documents with one id, or none, are told apart by their size, and equal ones are rows of their own;
    documents with a null source or size are left out; empty ones (0 tokens) come with their turn.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(size).cast("bigint").alias("n_tokens")).dropna(subset=["source", "n_tokens"])
    rows = materialize(rows, "mix-sizes")
    sizes = source_sizes(rows, targets, "source", "n_tokens")
    total = sum(r["tokens"] for r in sizes)
    budget = total if budget is None else budget
    used = [r for r in sizes if r["weight"] > 0 and r["capacity"] > 0]
    # At virtual time t the finished documents have at least min(weight * t, capacity) tokens of each source, less
    # the one under way. So the budget is spent by `end`, and nothing that finishes later can be in the mix.
    end = spent_at(sizes, budget + sum(r["largest"] for r in used) + 1)
    end = min(end, max([1.0, *(r["capacity"] / r["weight"] for r in used)]))
    schema = "source string, weight double, copies int, tokens bigint"
    plan = [(r["source"], float(r["weight"]), min(r["max_repeats"], math.floor(end * r["weight"] / r["tokens"]) + 1), r["tokens"]) for r in used]
    lanes = F.broadcast(spark.createDataFrame(plan, schema))

    ranges = max(1, parallelism(spark) * RANGES_PER_TASK)
    copies = rows.join(lanes, "source").select("doc_id", "source", "n_tokens", "weight", "tokens", F.explode(F.sequence(F.lit(1), "copies")).alias("copy_no"))
    turn = F.xxhash64("doc_id", "source", "copy_no", "n_tokens", F.lit(seed))
    shuffled = copies.withColumn("__turn", turn).withColumn("__range", F.floor((turn / F.lit(2.0**64) + F.lit(0.5)) * ranges).cast("int"))
    queued = running_sum(shuffled, ["source", "copy_no"], "__range", ["__turn", "doc_id", "n_tokens"], "n_tokens", "__sum")
    timed = queued.withColumn("finish_time", ((F.col("copy_no") - 1) * F.col("tokens") + F.col("__sum")) / F.col("weight"))
    # Virtual time passes with the tokens of the mix, so equal steps of it are ranges of about equal size.
    ranged = timed.filter(F.col("finish_time") <= F.lit(end)).withColumn("__range", F.floor(F.col("finish_time") / F.lit(end) * ranges).cast("int"))
    ranged = ranged.select("doc_id", "source", "copy_no", "n_tokens", "finish_time", "__turn", "__range", F.lit(0).alias("__lane"))
    order = ["finish_time", "source", "copy_no", "__turn", "doc_id", "n_tokens"]
    merged = running_sum(ranged, ["__lane"], "__range", order, "n_tokens", "mix_end")
    cut = merged.filter(F.col("mix_end") <= F.lit(budget))
    return cut.orderBy(*order).select("doc_id", "source", "copy_no", "n_tokens", "finish_time", "mix_end"), sizes


def report(mixed: DataFrame, sizes: list[dict]) -> DataFrame:
    """One row per listed source: what it has, its target, and what the mix really holds of it.

    ``is_exhausted``: all of its copies are in the mix; ``is_short``: all of its copies are in the mix and it is below its target.
    """
    got = mixed.groupBy("source").agg(F.count(F.lit(1)).alias("mix_docs"), F.sum("n_tokens").alias("mix_tokens"), F.max("copy_no").alias("max_copy"))
    schema = "source string, weight double, max_repeats int, n_docs bigint, tokens bigint, capacity bigint, target_tokens double"
    names = [c.split()[0] for c in schema.split(", ")]
    listed = mixed.sparkSession.createDataFrame([tuple(float(r[n]) if n in ("weight", "target_tokens") else r[n] for n in names) for r in sizes], schema)
    total = F.sum("mix_tokens").over(Window.partitionBy())
    out = listed.join(got, "source", "left").fillna(0, ["mix_docs", "mix_tokens", "max_copy"])  # at most MAX_SOURCES rows
    out = out.withColumn("share", F.try_divide("mix_tokens", total)).withColumn("is_exhausted", F.col("mix_tokens") >= F.col("capacity"))
    return out.withColumn("is_short", F.col("is_exhausted") & (F.col("mix_tokens") < F.col("target_tokens")))
