"""Keys of molecules: cell labels, cell indexes, gene names and sample tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import sql_strip, strip

# Each of the three label sections has 96 members.
SECTIONS = 96
SQUARE = SECTIONS * SECTIONS


def label_to_index(label: Column) -> Column:
    """``a-b-c`` to ``(a-1)*96*96 + (b-1)*96 + c``; a label without ``-`` passes as a number; others are null."""
    part = F.split(label, "-")
    number = lambda i: F.try_element_at(part, F.lit(i)).try_cast("bigint")
    joined = (number(1) - 1) * SQUARE + (number(2) - 1) * SECTIONS + number(3)
    return F.when(label.contains("-"), joined).otherwise(label.try_cast("bigint"))


def index_to_label(index: Column) -> Column:
    """The inverse of ``label_to_index``; null below 1."""
    zero = index - 1
    text = F.concat_ws(
        "-",
        (F.floor(zero / SQUARE) + 1).cast("string"),
        (F.floor((zero % SQUARE) / SECTIONS) + 1).cast("string"),
        (zero % SECTIONS + 1).cast("string"),
    )
    return F.when(index >= 1, text)


def cell_label_key(col: Column) -> Column:
    """Canonical cell label: ``a-b-c`` without leading zeros or outer white space.

    A bare number is an index and becomes its label. Null, blank, ``x`` and anything that is
    neither shape are null.
    """
    t = strip(col)
    bare = F.when(t.rlike("^[0-9]+$"), index_to_label(t.try_cast("bigint")))
    padded = F.when(t.rlike("^[0-9]+-[0-9]+-[0-9]+$"), F.regexp_replace(t, "(^|-)0+(?=[0-9])", "$1"))
    return F.when(t.rlike("^[1-9][0-9]*-[1-9][0-9]*-[1-9][0-9]*$"), t).otherwise(F.coalesce(padded, bare))


def gene_key(col: Column) -> Column:
    """Gene name: what stands before the first ``|``, trimmed, in upper case; null, blank and ``*`` are null."""
    g = F.upper(strip(F.substring_index(col, "|", 1)))
    return F.when((g != "") & (g != "*"), g)


def sample_tag_key(col: Column) -> Column:
    """``SampleTagNN_species`` in canonical spelling, or null where the text is no such tag."""
    t = F.lower(strip(F.substring_index(strip(col), "|", 1)))
    number = F.regexp_extract(t, "^sampletag([0-9]{1,2})_[a-z]+$", 1)
    species = F.regexp_extract(t, "_([a-z]+)$", 1)
    return F.when(number != "", F.concat(F.lit("SampleTag"), F.lpad(number, 2, "0"), F.lit("_"), species))


def sql_cell_label_key(expr: str) -> str:
    """``cell_label_key`` as a DuckDB expression."""
    t = sql_strip(expr)
    i = f"(try_cast({t} AS BIGINT))"
    return (
        f"CASE WHEN regexp_full_match({t}, '[0-9]+-[0-9]+-[0-9]+') THEN "
        f"concat_ws('-', CAST(split_part({t}, '-', 1) AS BIGINT), CAST(split_part({t}, '-', 2) AS BIGINT), CAST(split_part({t}, '-', 3) AS BIGINT)) "
        f"WHEN regexp_full_match({t}, '[0-9]+') AND {i} >= 1 THEN "
        f"concat_ws('-', ({i} - 1) // {SQUARE} + 1, (({i} - 1) % {SQUARE}) // {SECTIONS} + 1, ({i} - 1) % {SECTIONS} + 1) END"
    )


def sql_gene_key(expr: str) -> str:
    """``gene_key`` as a DuckDB expression."""
    return f"nullif(nullif(upper({sql_strip(f'''split_part({expr}, '|', 1)''')}), ''), '*')"
