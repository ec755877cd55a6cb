"""How often every distinct term occurs, and in how many records.

Method: last-seen counters. Tokens are hash-partitioned by term and ordered by record within it; a
scan keeps for each term its occurrences, its records and the record seen last, and adds to the
records only when the record changes. No set of records is held for any term. Tokens reach the scan as they occur,
repeated ones too.

A term with a third of all tokens would fill one task. So the tokens of a heavy term, one with more than a task's equal share of all tokens,
are split by a hash of the record into as many parts as it has shares: all tokens of one (term, record) pair stay together, and the
counters of the parts add up. There are fewer heavy terms than tasks, which bounds their list.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, parallelism


def heavy_terms(tokens: DataFrame, kind: str, term: str, tasks: int) -> list[tuple[str, str, int]]:
    """``kind, term, parts`` of the terms with more than ``1 / tasks`` of all tokens; there are fewer than ``tasks``."""
    counts = materialize(tokens.groupBy(kind, term).agg(F.count(F.lit(1)).alias("n")), "token-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [(r[0], r[1], -(-r[2] * tasks // total)) for r in counts.filter(F.col("n") * F.lit(tasks) > F.lit(total)).collect()]


def laid_out(tokens: DataFrame, kind: str, term: str, record: str, tasks: int) -> DataFrame:
    """``kind, term, record, __part``: the tokens as the scan meets them, partitioned by term and, for heavy terms, by part."""
    kept = tokens.select(F.col(kind).cast("string").alias(kind), F.col(term).cast("string").alias(term), record).dropna()
    heavy = tokens.sparkSession.createDataFrame(heavy_terms(kept, kind, term, tasks), "__kind string, __term string, __parts int")
    joined = kept.join(F.broadcast(heavy), (F.col(kind) == F.col("__kind")) & (F.col(term) == F.col("__term")), "left")
    part = F.pmod(F.xxhash64(record), F.coalesce("__parts", F.lit(1))).alias("__part")
    return joined.select(kind, term, record, part).repartition(kind, term, "__part")


def term_counts(tokens: DataFrame, kind: str, term: str, record: str, tasks: int | None = None) -> DataFrame:
    """``kind, term, occurrences, n_records`` from tokens, by last-seen counters.

    ``kind`` separates vocabularies counted in one pass. A row is one token; the tokens may repeat in any way. Tokens with a null kind, term or
    record don't count; an empty text is a term. No tokens give no rows. Other columns are ignored. The tokens are read twice, so they
    should be cheap to read.
    """
    laid = laid_out(tokens, kind, term, record, tasks or parallelism(tokens.sparkSession))
    scan = Window.partitionBy(kind, term, "__part").orderBy(record)
    seen = laid.withColumn("__new", F.when(F.lag(record).over(scan).eqNullSafe(F.col(record)), 0).otherwise(1))
    parts = seen.groupBy(kind, term, "__part").agg(F.count(F.lit(1)).alias("occurrences"), F.sum("__new").alias("n_records"))
    return parts.groupBy(kind, term).agg(F.sum("occurrences").alias("occurrences"), F.sum("n_records").alias("n_records"))


def mark(counts: DataFrame, kind: str, fewer_than: dict[str, int], more_than: dict[str, tuple[str, str]]) -> DataFrame:
    """Add ``verdict``: ``rare``, ``common`` or null.

    ``fewer_than`` gives for each kind the number of records below which a term is rare; ``more_than``
    gives a share and the kind whose number of terms is the whole. A term that is both is ``rare``.
    The number of terms of each kind is one row a kind, read from the written counts.
    """
    sizes = {r[0]: r[1] for r in counts.groupBy(kind).agg(F.count(F.lit(1)).alias("n")).collect()}
    verdict = F.lit(None).cast("string")
    for k, low in fewer_than.items():
        share, whole = more_than[k]
        exact = Fraction(share)
        of = F.col("n_records")
        common = of * F.lit(exact.denominator) > F.lit(exact.numerator * sizes.get(whole, 0))
        verdict = F.when(F.col(kind) == k, F.when(of < low, "rare").when(common, "common")).otherwise(verdict)
    return counts.withColumn("verdict", verdict)
