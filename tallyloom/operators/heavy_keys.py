"""Per-key results when a handful of keys hold most rows.

Method: map-side combining. Each task folds its rows into a bounded hash table of mergeable
states (Spark's partial aggregate, which spills when full), and only one compact state per key
and task is shuffled. A key with a third of all rows therefore costs the final task one state
per map task, not a third of the data. All states are algebraic: counts, sums, minima, maxima.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def count_by_each_key(records: DataFrame, kinds: dict[str, Column], measures: dict[str, Column] | None = None) -> DataFrame:
    """``key_kind, key_value, n_records`` for every value of each of several keys, in one pass.

    ``kinds`` names a key and its column; ``measures`` adds algebraic aggregates over the record.
    A record counts once for each key. A null key is kept as a row with a null ``key_value``, so the
    rows of one kind always add up to the number of records; an empty input gives no rows.
    The key rows are generated next to the records and pre-aggregated in the same stage, so
    neither the records nor the key rows are shuffled.
    """
    measures = measures or {}
    pairs = F.array(*[F.struct(F.lit(k).alias("key_kind"), c.cast("string").alias("key_value")) for k, c in kinds.items()])
    rows = records.select(F.explode(pairs).alias("__k"), *[c.alias(f"__m_{m}") for m, c in measures.items()])
    sums = [F.sum(f"__m_{m}").alias(m) for m in measures]
    return rows.groupBy(F.col("__k.key_kind").alias("key_kind"), F.col("__k.key_value").alias("key_value")).agg(F.count(F.lit(1)).alias("n_records"), *sums)


def mark_heavy(counts: DataFrame, share: float) -> DataFrame:
    """Add ``share`` and ``is_heavy`` (at least ``share`` of all records) to ``count_by_each_key``.

    The counts, already one row per key, are written once to the shared folder; the total is a
    single number read from them. Rows with a null key count towards the total and are not returned.
    """
    kept = materialize(counts, "heavy-keys")
    totals = kept.groupBy("key_kind").agg(F.sum("n_records").alias("n")).agg(F.max("n")).first()
    total = int(totals[0] or 0)
    exact = Fraction(str(share))
    return (
        kept.filter(F.col("key_value").isNotNull())
        .withColumn("share", F.col("n_records") / F.lit(max(total, 1)))
        .withColumn("is_heavy", F.col("n_records") * F.lit(exact.denominator) >= F.lit(exact.numerator * total))
    )
