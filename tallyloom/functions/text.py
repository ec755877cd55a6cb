"""Trimming and folding of untidy text values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode property White_Space, and the four ASCII separators.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column | str) -> Column:
    """Without white space of any kind at either end."""
    return F.btrim(F.col(col) if isinstance(col, str) else col, F.lit(WHITE_SPACE))


def strip_or_null(col: Column | str) -> Column:
    """Like ``strip``; a blank text is null."""
    return F.nullif(strip(col), F.lit(""))


def digest_number(*cols: Column | str, seed: int = 0) -> Column:
    """A number from 0 below 2 to the power of 32 from the columns' texts, evenly spread and the same everywhere; nulls are skipped."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts, F.lit(str(seed)))), 1, 8), 16, 10).cast("bigint")


def sql_digest_number(*exprs: str, seed: int = 0) -> str:
    """``digest_number`` as a DuckDB expression."""
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(exprs)}, '{seed}')), 1, 8))::BIGINT"


def sql_strip(expr: str) -> str:
    """The same trim as a DuckDB expression, for oracle queries."""
    chars = "||".join(f"chr({ord(c)})" for c in WHITE_SPACE)
    return f"trim({expr}, {chars})"
