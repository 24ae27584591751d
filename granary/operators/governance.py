"""Column tags, masks as secured views, profiling of columns, and diffs against a catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The masks by name.
MASKS = ("LAST_4", "HASH", "REDACT", "YEAR", "NULL")


def mask(c: Column, kind: str) -> Column:
    """LAST_4: all but four characters hidden; HASH: SHA-256; REDACT: letters x, digits n; YEAR: 1 January; NULL."""
    if kind == "LAST_4":
        hidden = F.regexp_replace(F.regexp_replace(F.substring(c, F.lit(1), F.greatest(F.length(c) - 4, F.lit(0))), "[A-Za-z]", "x"), "[0-9]", "n")
        return F.concat(hidden, F.right(c, F.lit(4)))
    if kind == "HASH":
        return F.sha2(c.cast("string"), 256)
    if kind == "REDACT":
        return F.regexp_replace(F.regexp_replace(c, "[A-Za-z]", "x"), "[0-9]", "n")
    if kind == "YEAR":
        return F.trunc(c, "year")
    if kind == "NULL":
        return F.lit(None)
    raise ValueError(f"no mask {kind}")


def tags(df: DataFrame, rules: dict) -> dict[str, str]:
    """Tag of each column whose name has a rule; a rule may differ by the column's type."""
    out = {}
    for f in df.schema.fields:
        rule = rules.get(f.name)
        if isinstance(rule, dict):
            rule = rule.get(f.dataType.typeName())
        if rule:
            out[f.name] = rule
    return out


def secured(df: DataFrame, column_tags: dict[str, str], masked: bool = True) -> DataFrame:
    """The view that listed users see; others see clear values."""
    if not masked:
        return df
    return df.select(*[(mask(F.col(c), column_tags[c]).cast(df.schema[c].dataType if column_tags[c] in ("YEAR", "NULL") else "string") if c in column_tags else F.col(c)).alias(c) for c in df.columns])


def tag_changes(wanted: dict[str, str], current: dict[str, list[str]], prefix: str) -> tuple[list, list]:
    """(to add, to remove) per column; only tags with the prefix are ours."""
    add = sorted((c, t) for c, t in wanted.items() if t not in current.get(c, []))
    remove = sorted((c, t) for c, ts in current.items() for t in ts if t.startswith(prefix) and wanted.get(c) != t)
    return add, remove


def profile(df: DataFrame, rules: dict[str, dict], least: float = 70.0) -> DataFrame:
    """column_name, tag, share, score for every rule that a text column meets, in one scan.

    A rule has pattern, name (a pattern) and value_weight: score = weight x share of values that match + (100 - weight) if the
    name matches.
    """
    cells = [(c, t) for c in df.columns for t in rules]
    share = [F.avg(F.when(F.col(f"`{c}`").isNotNull(), F.col(f"`{c}`").cast("string").rlike(rules[t]["pattern"]).cast("double"))).alias(f"s{i}") for i, (c, t) in enumerate(cells)]
    one = df.agg(*share)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("tag"), F.coalesce(F.col(f"s{i}"), F.lit(0.0)).alias("share"), F.lit(c).rlike(rules[t]["name"]).alias("named"), F.lit(float(rules[t]["value_weight"])).alias("w")) for i, (c, t) in enumerate(cells)])
    out = one.select(F.explode(rows).alias("r")).select("r.*")
    return out.withColumn("score", F.round(F.col("w") * F.col("share") + F.when(F.col("named"), 100 - F.col("w")).otherwise(0.0), 1)).where(F.col("score") >= least).select("column_name", "tag", F.round("share", 6).alias("share"), "score")


def verdict(by_profile: str | None, by_name: str | None, rows: int) -> str:
    if not rows:
        return "empty"
    if by_profile and by_name:
        return "agree" if by_profile == by_name else "conflict"
    return "profiler only" if by_profile else "names only" if by_name else "left"
