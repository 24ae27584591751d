"""Casts that give NULL instead of failing, whatever the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kinds a contract may name; any other kind is a trimmed string.
KINDS = ("string", "int", "bigint", "decimal", "date", "timestamp")
IST = "Asia/Kolkata"


def blank_to_null(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t != "", t)


def to_whole(c: Column, kind: str = "bigint") -> Column:
    """The whole part of a plain decimal number ('1.7' is 1); NULL for anything else."""
    return F.regexp_extract(F.trim(c), r"^([+-]?[0-9]+)([.][0-9]*)?$", 1).try_cast(kind)


def to_date(c: Column, formats: list[str]) -> Column:
    """The first format that parses the whole text, strictly."""
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


def to_instant(c: Column, fmt: str) -> Column:
    return F.try_to_timestamp(c, F.lit(fmt))


def typed(c: Column, kind: str, formats: list[str] | None = None) -> Column:
    """A contract column's text as its type; blank and unreadable values are NULL."""
    v = blank_to_null(c)
    if kind in ("int", "bigint"):
        return to_whole(v, kind)
    if kind == "decimal":
        return v.try_cast("decimal(18,2)")
    if kind == "date":
        return to_date(v, formats or ["yyyy-MM-dd"])
    if kind == "timestamp":
        return to_instant(v, (formats or ["yyyy-MM-dd HH:mm:ss"])[0])
    return v


def source_instant(c: Column, fmt: str = "yyyy-MM-dd HH:mm:ss", zone: str = IST) -> Column:
    """A wall clock of the source's zone as an instant."""
    return F.to_utc_timestamp(to_instant(c, fmt), zone)
