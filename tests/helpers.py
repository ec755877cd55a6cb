"""Comparison of results, whatever the order of rows and columns."""

from __future__ import annotations


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else ("f", format(v, ".9g"))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def same(df, relation) -> None:
    names = sorted(df.columns)
    assert names == sorted(relation.columns)
    mine = sorted(repr(tuple(plain(r[c]) for c in names)) for r in df.collect())
    at = [relation.columns.index(c) for c in names]
    theirs = sorted(repr(tuple(plain(r[i]) for i in at)) for r in relation.fetchall())
    assert mine == theirs
