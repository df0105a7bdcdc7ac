"""Feature preparation: one-hot encoding, alignment to a frozen feature list,
standard scaling, class weights, dense assembly and splits.

Encoding is split into a *fit* (levels and statistics from training rows; a
few numbers per column reach the driver, bounded by a level-count check) and a
*transform* that is one ``select`` of generated expressions: no shuffle, one
codegen stage, whatever the number of rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import c
from tessera.operators.prefix import global_position

# The level every categorical may carry that never gets a dummy.
UNKNOWN_LEVEL = "unknown"
MAX_LEVELS = 10_000  # a one-hot wider than this is a modelling error


def dummy_name(col: str, level: str) -> str:
    return f"{col}_{level}"


def distinct_levels(df: DataFrame, cols: Sequence[str], max_levels: int = MAX_LEVELS
                    ) -> dict[str, list[str]]:
    """Sorted distinct non-null levels of each column, in one job.

    The (column, level) pairs are a distributed ``groupBy`` (partial
    aggregation, no set held in one buffer); at most ``len(cols) *
    max_levels + 1`` pairs reach the driver, so a column above the limit is
    detected without collecting it.
    """
    if not cols:
        return {}
    long = df.select(*[c(x).cast("string").alias(x) for x in cols]).unpivot(
        [], [c(x) for x in cols], "__col", "__level").where(F.col("__level").isNotNull())
    cap = len(cols) * max_levels + 1
    rows = long.groupBy("__col", "__level").agg(F.count("*").alias("n")).select(
        "__col", "__level").limit(cap).collect()
    if len(rows) >= cap:
        raise ValueError(f"more than {max_levels} levels in one of {list(cols)}")
    out: dict[str, list[str]] = {x: [] for x in cols}
    for r in rows:
        out[r["__col"]].append(r["__level"])
    for x in cols:
        if len(out[x]) > max_levels:
            raise ValueError(f"{x}: {len(out[x])} levels exceed the one-hot limit {max_levels}")
        out[x].sort()
    return out


def onehot_exprs(levels: Mapping[str, Sequence[str]]) -> list[Column]:
    """``col_level`` = 1 when ``col <=> level`` else 0 (null -> 0, never null)."""
    out = []
    for col, lv in levels.items():
        for level in lv:
            out.append(c(col).eqNullSafe(F.lit(level)).cast("int").alias(dummy_name(col, level)))
    return out


def onehot(df: DataFrame, levels: Mapping[str, Sequence[str]], keep: Sequence[str] | None = None
           ) -> DataFrame:
    """Full one-hot (``pd.get_dummies``): the categorical columns are replaced
    by one 0/1 column per level; other columns stay in place."""
    keep_cols = [x for x in df.columns if x not in levels] if keep is None else list(keep)
    _check_names([*keep_cols, *[dummy_name(col, x) for col, lv in levels.items() for x in lv]])
    return df.select(*[c(x) for x in keep_cols], *onehot_exprs(levels))


def drop_first_levels(levels: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
    """Drop ``unknown`` and then the smallest level of every column."""
    out = {}
    for col, lv in levels.items():
        real = sorted(x for x in lv if x != UNKNOWN_LEVEL)
        out[col] = real[1:]
    return out


def onehot_drop_first(df: DataFrame, cat_cols: Sequence[str],
                      levels: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    lv = levels if levels is not None else distinct_levels(df, cat_cols)
    return onehot(df, drop_first_levels(lv))


def _check_names(names: Sequence[str]) -> None:
    """Two columns of one name (``a`` with level ``b_x``, ``a_b`` with level ``x``)
    could not be told apart later."""
    twice = sorted({x for x, n in Counter(names).items() if n > 1})
    if twice:
        raise ValueError(f"columns of one name: {twice}")


def _check_keep(keep: Sequence[str], features: Sequence[str]) -> None:
    both = sorted(set(keep) & set(features))
    if both:
        raise ValueError(f"kept columns are also features: {both}; keep a separate row key")


def align(df: DataFrame, features: Sequence[str], keep: Sequence[str] = (),
          fill=0) -> DataFrame:
    """``reindex(columns=features, fill_value=0)``: present columns pass
    through in frozen order, absent ones become the constant ``fill``, extra
    ones vanish (except ``keep`` columns, put first)."""
    present = set(df.columns)
    _check_keep(keep, features)
    cols = [c(k) for k in keep]
    for f in features:
        if f in present:
            cols.append(c(f).alias(f))
        else:
            cols.append(F.lit(fill).alias(f))
    return df.select(*cols)


def missing_features(spark: SparkSession, expected: Sequence[str], actual: Sequence[str]) -> DataFrame:
    """Names of ``expected`` not in ``actual`` (set difference on name tables)."""
    e = spark.createDataFrame([(i, f) for i, f in enumerate(expected)], "pos int, feature string")
    a = spark.createDataFrame([(f,) for f in actual], "feature string")
    return e.join(a, "feature", "left_anti")


@dataclass
class FeatureSpec:
    """Frozen feature list plus the scaler statistics (the stored artefact)."""

    numeric: list[str]
    levels: dict[str, list[str]]           # kept dummy levels per categorical
    mean: dict[str, float] = field(default_factory=dict)
    std: dict[str, float] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        out = list(self.numeric)
        for col, lv in self.levels.items():
            out += [dummy_name(col, x) for x in lv]
        return out

    def to_df(self, spark: SparkSession) -> DataFrame:
        """Metadata table ``(pos, feature, mean, std, column, level)``: the column a
        feature comes from, and its level where it is a 0/1 entry."""
        origin = [(x, None) for x in self.numeric] + [(col, x) for col, lv in self.levels.items() for x in lv]
        rows = [(i, f, self.mean.get(f), self.std.get(f), *o) for i, (f, o) in enumerate(zip(self.features, origin, strict=True))]
        return spark.createDataFrame(rows, "pos int, feature string, mean double, std double, column string, level string")

    @staticmethod
    def from_df(df: DataFrame, numeric: Sequence[str], cat_cols: Sequence[str]) -> FeatureSpec:
        """The specification a metadata table holds (one row per feature, at most
        ``MAX_LEVELS`` per column)."""
        most = len(numeric) + len(cat_cols) * MAX_LEVELS
        rows = df.orderBy("pos").limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"more than {most} features")
        levels: dict[str, list[str]] = {x: [] for x in cat_cols}
        mean, std = {}, {}
        for r in rows:
            if r["level"] is not None and r["column"] in levels:
                levels[r["column"]].append(r["level"])
            elif r["feature"] in numeric:
                mean[r["feature"]], std[r["feature"]] = r["mean"], r["std"]
        return FeatureSpec(list(numeric), levels, mean, std)


def scaler_stats(train: DataFrame, cols: Sequence[str]) -> tuple[dict, dict]:
    """Mean and population std per column over the training rows (one job,
    one output row)."""
    if not cols:
        return {}, {}
    aggs = []
    for i, x in enumerate(cols):
        aggs += [F.avg(c(x)).alias(f"m{i}"), F.stddev_pop(c(x)).alias(f"s{i}")]
    r = train.agg(*aggs).first()
    return ({x: r[f"m{i}"] for i, x in enumerate(cols)},
            {x: r[f"s{i}"] for i, x in enumerate(cols)})


def fit_spec(train: DataFrame, numeric: Sequence[str], cat_cols: Sequence[str],
                      max_levels: int = MAX_LEVELS) -> FeatureSpec:
    """Levels (drop-first) and scaler statistics of the training rows in one
    scan: ``GROUPING SETS`` ((cat_1), ..., (cat_k), ()) gives one row per level
    of every categorical plus the grand total carrying the statistics.  At
    most ``k * max_levels + 1`` rows reach the driver (checked)."""
    if not cat_cols:
        mean, std = scaler_stats(train, numeric)
        return FeatureSpec(list(numeric), {}, mean, std)
    keys = [c(x).cast("string").alias(f"__k{i}") for i, x in enumerate(cat_cols)]
    base = train.select(*keys, *[c(x).alias(f"__x{i}") for i, x in enumerate(numeric)])
    sets = [[F.col(f"__k{i}")] for i in range(len(cat_cols))] + [[]]
    aggs = [F.grouping_id().alias("__gid")]
    for i in range(len(numeric)):
        aggs += [F.avg(f"__x{i}").alias(f"m{i}"), F.stddev_pop(f"__x{i}").alias(f"s{i}")]
    g = base.groupingSets(sets, *[F.col(f"__k{i}") for i in range(len(cat_cols))]).agg(*aggs)
    cap = len(cat_cols) * (max_levels + 1) + 2   # null is a group of its own, not a level
    rows = g.limit(cap).collect()
    if len(rows) >= cap:
        raise ValueError(f"more than {max_levels} levels in one of {list(cat_cols)}")
    total_gid = (1 << len(cat_cols)) - 1   # every key aggregated away
    levels: dict[str, list[str]] = {x: [] for x in cat_cols}
    total = None
    for r in rows:
        if r["__gid"] == total_gid:
            total = r
            continue
        for i, x in enumerate(cat_cols):
            # grouped by key i alone: its bit is 0, all others are 1
            if r["__gid"] == total_gid & ~(1 << (len(cat_cols) - 1 - i)):
                if r[f"__k{i}"] is not None:
                    levels[x].append(r[f"__k{i}"])
    for x in cat_cols:
        if len(levels[x]) > max_levels:
            raise ValueError(f"{x}: {len(levels[x])} levels exceed the one-hot limit {max_levels}")
        levels[x].sort()
    mean = {x: (total[f"m{i}"] if total else None) for i, x in enumerate(numeric)}
    std = {x: (total[f"s{i}"] if total else None) for i, x in enumerate(numeric)}
    return FeatureSpec(list(numeric), drop_first_levels(levels), mean, std)


def scale_expr(x: Column, mean: float, std: float) -> Column:
    """``(x - mean) / std``; std 0 (constant column) divides by 1."""
    s = std if std not in (None, 0.0) else 1.0
    return (x - F.lit(mean)) / F.lit(s)


def standard_scale(df: DataFrame, stats_mean: Mapping[str, float], stats_std: Mapping[str, float],
                   cols: Sequence[str] | None = None) -> DataFrame:
    """Scale listed columns in place, folding the statistics in as literals."""
    cols = list(stats_mean) if cols is None else list(cols)
    return df.select(*[
        scale_expr(c(x), stats_mean[x], stats_std[x]).alias(x) if x in cols else c(x)
        for x in df.columns])


def encode(df: DataFrame, spec: FeatureSpec, keep: Sequence[str] = (), scale: bool = True
           ) -> DataFrame:
    """Raw rows -> ``keep`` columns + the frozen feature columns, scaled.

    One projection: dummies use null-safe equality so null, ``unknown``, the
    base level and unseen levels all give the zero vector (``get_dummies`` +
    ``reindex``)."""
    present = set(df.columns)
    _check_names(spec.features)
    _check_keep(keep, spec.features)
    cols = [c(k) for k in keep]
    for x in spec.numeric:
        e = c(x).cast("double") if x in present else F.lit(0.0)
        if scale:
            e = scale_expr(e, spec.mean[x], spec.std[x])
        cols.append(e.alias(x))
    for col, lv in spec.levels.items():
        for level in lv:
            name = dummy_name(col, level)
            if col in present:
                cols.append(c(col).eqNullSafe(F.lit(level)).cast("int").alias(name))
            else:
                cols.append(F.lit(0).alias(name))
    return df.select(*cols)


# ---- class weights ----------------------------------------------------------

def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights ``n / (k * n_c)`` (k = classes present), one row per class."""
    counts = df.where(c(label).isNotNull()).groupBy(c(label).alias(label)).agg(
        F.count("*").alias("n_c"))
    # the window runs over one row per class only (already aggregated)
    everything = Window.partitionBy()
    n = F.sum("n_c").over(everything)
    k = F.count("*").over(everything)
    return counts.select(label, "n_c", (n / (k * F.col("n_c"))).alias("weight"))


def class_weight_map(df: DataFrame, label: str) -> DataFrame:
    w = class_weights(df, label)
    return w.agg(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct(F.col(label), F.col("weight"))))).alias("class_weight"))


#: rows of a lookup table that may be sent to every executor
MAX_BROADCAST_ROWS = 100_000


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a table whose row count is checked first (``max_rows``
    is a parameter); a larger table comes back without the hint, so that Spark
    joins it by shuffle."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def attach_row_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Join each row to its class weight (one row per class)."""
    w = class_weights(df, label).select(label, F.col("weight").alias(out))
    return df.join(bounded_broadcast(w), on=label, how="left")


# ---- assembly & splits --------------------------------------------------------

def assemble_array(df: DataFrame, features: Sequence[str], out: str = "features",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Dense feature row as ``array<double>`` (the float matrix of the reference)."""
    return df.select(*[c(k) for k in keep],
                     F.array(*[c(f).cast("double") for f in features]).alias(out))


def holdout_split(df: DataFrame, key: str, mod: int = 5) -> DataFrame:
    """Deterministic hold-out: ``key % mod = 0`` is test (independent of
    partitioning, unlike ``randomSplit``)."""
    return df.withColumn("split", F.when(c(key) % mod == 0, F.lit("test")).otherwise(F.lit("train")))


def stratified_split(df: DataFrame, key: str, label: str, mod: int = 5) -> DataFrame:
    """Per class, every ``mod``-th row by key goes to test.  The in-class row
    number is a distributed prefix count, so a dominant class is not one task."""
    pos = global_position(df, key, partition_by=[label], out="__rn")
    return pos.withColumn(
        "split", F.when(F.col("__rn") % mod == 0, F.lit("test")).otherwise(F.lit("train"))
    ).drop("__rn")


def validation_tail(df: DataFrame, key: str, fraction: float = 0.15) -> DataFrame:
    """Keras ``validation_split``: the last ``fraction`` of rows in key order
    are validation; the first ``floor(n * (1 - fraction))`` are train."""
    n = df.count()
    cut = int(n * (1.0 - fraction))
    pos = global_position(df, key, out="__pos")
    return pos.withColumn(
        "split", F.when(F.col("__pos") <= cut, F.lit("train")).otherwise(F.lit("val"))
    ).drop("__pos")
