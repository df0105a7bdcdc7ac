"""Row construction from JSON and domain-rule validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import c


def row_from_json(df: DataFrame, json_col: str, schema: str, defaults: Mapping[str, object],
                  keep: Sequence[str] = ()) -> DataFrame:
    """Typed fields parsed from a JSON text column; absent fields take the
    form defaults (one projection, no shuffle)."""
    parsed = F.from_json(c(json_col), schema)
    names = [f.strip().split()[0] for f in schema.split(",")]
    return df.select(*[c(k) for k in keep], *[
        F.coalesce(parsed[n], F.lit(defaults[n])).alias(n) if n in defaults else parsed[n].alias(n)
        for n in names])


def rule_violation(rule) -> tuple[str, object]:
    """(name, Column true when the rule is broken) for ``(col, kind, arg)``:
    kind ``range`` takes (lo, hi) inclusive, kind ``levels`` a level list.
    A null value breaks its rule."""
    col, kind, arg = rule
    x = c(col)
    if kind == "range":
        ok = x.between(F.lit(arg[0]), F.lit(arg[1]))
    elif kind == "levels":
        ok = x.isin(*arg)
    else:
        raise ValueError(f"unknown rule kind {kind}")
    return col, F.coalesce(~ok, F.lit(True))


def check_rules(df: DataFrame, rules: Sequence, keep: Sequence[str] = ()) -> DataFrame:
    """Per row: valid flag, number and names of the broken rules."""
    flags = [rule_violation(r) for r in rules]
    broken = F.array_compact(F.array(*[F.when(b, F.lit(n)) for n, b in flags]))
    return df.select(*[c(k) for k in keep], broken.alias("__b")).select(
        *keep, (F.size("__b") == 0).cast("int").alias("valid"),
        F.size("__b").cast("int").alias("n_broken"),
        F.array_join("__b", ",").alias("broken"))


def split_valid(df: DataFrame, rules: Sequence) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with the broken rule names)."""
    flags = [rule_violation(r) for r in rules]
    broken = F.array_compact(F.array(*[F.when(b, F.lit(n)) for n, b in flags]))
    tagged = df.withColumn("__broken", broken)
    return (tagged.where(F.size("__broken") == 0).drop("__broken"),
            tagged.where(F.size("__broken") > 0).withColumnRenamed("__broken", "broken_rules"))
