"""Entity-attribute-value rows to one typed row per entity.

Method: the rows are partitioned by attribute into typed narrow tables ``(entity, values...)``, each
in its own part of one written table, so that a narrow table reads only its own rows. A spine of the distinct entities and all
narrow tables are co-partitioned by the entity: each is shuffled by it once. Groups of narrow tables are joined to the spine by
left outer joins, which keep the spine's partitioning and order, and the groups meet pairwise on the spine in a balanced tree. Since
every entity of a narrow table is in the spine, the result is that of full outer joins, but no joined row is shuffled again.

An entity with very many rows doesn't unbalance the joins: after the newest version of every
(entity, attribute) is chosen by an aggregate, an entity has one row in each narrow table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .latest import latest_by

MAX_ATTRIBUTES = 500
PLAN_TABLES = 32
GROUP_TABLES = 8


def _named(attribute: str, value: str) -> str:
    return f"{attribute}_{value}"


def narrow_rows(df: DataFrame, entity: Column, attribute: Column, stamp: Column, values: dict[str, Column]) -> DataFrame:
    """``entity, attribute, values...``: the newest row of each entity and attribute; rows without either are dropped."""
    return latest_by(df, {"entity": entity, "attribute": attribute}, stamp, values)


def attributes_of(narrow: DataFrame, limit: int = MAX_ATTRIBUTES) -> list[str]:
    """The attributes that occur, in code point order. They become columns, so more than ``limit`` is an error."""
    found = sorted(r[0] for r in narrow.select("attribute").distinct().limit(limit + 1).collect())
    if len(found) > limit:
        raise ValueError(f"more than {limit} attributes: so many columns make no readable table; use `blocks`, which gives several tables")
    return found


def _cuts(n: int, most: int) -> list[tuple[int, int]]:
    """``range(n)`` in the fewest parts of at most ``most``, about equally long."""
    parts = max(1, -(-n // most))
    at = [n * i // parts for i in range(parts + 1)]
    return [*zip(at, at[1:])]


def joined_on_spine(spine: DataFrame, tables: list[DataFrame], key: str, plan_tables: int = PLAN_TABLES, group_tables: int = GROUP_TABLES) -> DataFrame:
    """One row for each of ``spine``'s distinct keys with the columns of all ``tables``, null where a table lacks the key.

    Groups of ``group_tables`` are joined to the spine, and the groups pairwise. One plan joins at most ``plan_tables`` tables. Of more, equally
    large parts are joined and written first, so that plans stay small however many tables there are, and a lost executor costs one part's work.
    """
    while len(tables) > plan_tables:
        tables = [materialize(joined_on_spine(spine, tables[a:b], key, plan_tables, group_tables), "joined") for a, b in _cuts(len(tables), plan_tables)]
    groups = [reduce(lambda left, t: left.join(t, key, "left"), tables[a:b], spine) for a, b in _cuts(len(tables), group_tables)]
    while len(groups) > 1:
        pairs = [groups[i : i + 2] for i in range(0, len(groups), 2)]
        groups = [p[0].join(p[1], key) if len(p) == 2 else p[0] for p in pairs]
    return groups[0]


def stored_narrow(narrow: DataFrame, values: dict[str, str], entity: str) -> DataFrame:
    """The typed narrow tables as parts of one written table.

    The rows are brought together by attribute before they are written, in files of even size whatever the attributes' sizes, so there
    are about as many files as the data need and not tasks times attributes.
    """
    typed = narrow.select(F.col("entity").alias(entity), "attribute", *[F.col(v).try_cast(t).alias(v) for v, t in values.items()])
    return materialize(typed.hint("rebalance", "attribute"), "narrow", partition_by=["attribute"])


def _wide(stored: DataFrame, spine: DataFrame, names: list[str], values: dict[str, str], column: Callable[[str, str], str], entity: str, plan_tables: int) -> DataFrame:
    tables = [stored.filter(F.col("attribute") == a).select(entity, *[F.col(v).alias(column(a, v)) for v in values]) for a in names]
    return joined_on_spine(spine, tables, entity, plan_tables)


def widen(narrow: DataFrame, values: dict[str, str], column: Callable[[str, str], str] = _named, entity: str = "entity", limit: int = MAX_ATTRIBUTES, plan_tables: int = PLAN_TABLES) -> DataFrame:
    """One row per entity with a column for each attribute and value, of the types in ``values``.

    ``narrow`` is what ``narrow_rows`` gives. A value that doesn't fit its type is null, as is a missing
    one. An entity all of whose values are null still has its row. An empty input gives only the
    entity column. ``column`` names the columns; they are ordered by attribute.
    """
    stored = stored_narrow(narrow, values, entity)
    names = attributes_of(stored, limit)
    if not names:
        return stored.select(entity)
    return _wide(stored, stored.select(entity).distinct(), names, values, column, entity, plan_tables)


def blocks(narrow: DataFrame, values: dict[str, str], column: Callable[[str, str], str] = _named, entity: str = "entity", limit: int = MAX_ATTRIBUTES, plan_tables: int = PLAN_TABLES) -> list[tuple[list[str], DataFrame]]:
    """Like ``widen`` for any number of attributes: several wide tables, each of at most ``limit`` attributes and with all entities.

    Given are the attributes of each table and the table. The list of the attributes is held by the driver, as the names of columns are.
    """
    stored = stored_narrow(narrow, values, entity)
    names = sorted(r[0] for r in stored.select("attribute").distinct().collect())
    spine = materialize(stored.select(entity).distinct(), "entities")
    return [(names[a:b], _wide(stored, spine, names[a:b], values, column, entity, plan_tables)) for a, b in _cuts(len(names), limit) if b > a]


def filled(wide: DataFrame, entity: str, names: list[str], values: list[str], column: Callable[[str, str], str] = _named) -> DataFrame:
    """``entity, attribute`` of the places of a wide table whose values are all given: the wide table read back."""
    if not names:
        return wide.select(entity, F.lit(None).cast("string").alias("attribute")).limit(0)
    given = [F.when(reduce(lambda x, y: x & y, [F.col(column(a, v)).isNotNull() for v in values]), F.lit(a)) for a in names]
    return wide.select(entity, F.explode(F.array_compact(F.array(*given))).alias("attribute"))


def unpivot(wide: DataFrame, keys: list[str], columns: list[str], name: str = "name", value: str = "value") -> DataFrame:
    """Wide to long: one row per key and column, null values included."""
    return wide.unpivot(keys, columns, name, value)
