"""Filters, imputation, normalization and scaling of a long matrix, and their composition.

All are window or aggregate expressions over (feature, pixel_id, intensity); row statistics partition by feature, column
statistics by pixel_id, global ones are one-row aggregates that are cross-joined (a broadcast of one row). Null is
missing throughout. Deviations from the tool whose results these match are named where documented intent differs from
what it computes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import written

EPS = 1e-14


def v() -> Column:
    return F.col("intensity")


def by_row() -> Window:
    return Window.partitionBy("feature")


def by_column() -> Window:
    return Window.partitionBy("pixel_id")


def put(m: DataFrame, value: Column) -> DataFrame:
    return m.select("feature", "pixel_id", value.alias("intensity"))


def with_scalar(m: DataFrame, **aggs: Column) -> DataFrame:
    """Global aggregates of m as columns."""
    return m.crossJoin(F.broadcast(m.agg(*(a.alias(k) for k, a in aggs.items()))))  # one row


# --- missing values and filters -------------------------------------------------------------------------------------


def flag_missing(m: DataFrame, ignore_weak: bool = False, weak: float = 1e-5) -> DataFrame:
    """Infinite and NaN values become null; with ignore_weak also magnitudes under ``weak`` (the documented bound)."""
    bad = F.isnan(v()) | (F.abs(v()) == float("inf"))
    return put(m, F.when(bad | ((F.abs(v()) < weak) if ignore_weak else F.lit(False)), None).otherwise(v()))


def filter_present(m: DataFrame, share: float, magnitude: float = 0.0) -> DataFrame:
    """Features present (above the magnitude) in at least a share of all pixels.

    If every cell would count and no magnitude is set, data is taken as imputed and the global minimum is the cutoff.
    """
    above = lambda c: F.count_if(v() > F.greatest(c + EPS, F.lit(0.0)))
    n = m.agg(F.countDistinct("pixel_id").alias("n_pixels"), F.min("intensity").alias("low"), F.count_if(v() > max(magnitude + EPS, 0.0)).alias("n_above"), F.countDistinct("feature").alias("n_features"))
    whole = (F.col("n_above") == F.col("n_pixels") * F.col("n_features")) & F.lit(magnitude == 0.0) & (F.col("low") != 0)
    cut = n.select("n_pixels", F.when(whole, F.col("low")).otherwise(F.lit(magnitude)).alias("cut"))
    kept = m.crossJoin(F.broadcast(cut)).groupBy("feature", "n_pixels").agg(above(F.col("cut")).alias("n")).where(F.col("n") / F.col("n_pixels") >= share - EPS)
    return m.join(kept.select("feature"), "feature", "left_semi")


def row_statistics(m: DataFrame) -> DataFrame:
    """Per feature: raw max, mean and population SD, mean and SD of log2, whether a zero is there, and the count."""
    return m.groupBy("feature").agg(
        F.max("intensity").alias("raw_max"), F.avg("intensity").alias("raw_mean"), F.stddev_pop("intensity").alias("raw_sd"),
        F.avg(F.log2(F.when(v() > 0, v()))).alias("log_mean"), F.stddev_pop(F.log2(F.when(v() > 0, v()))).alias("log_sd"), F.coalesce(F.bool_or(v() == 0), F.lit(False)).alias("has_zero"), F.count("intensity").alias("n"),
    )


def filter_statistics(m: DataFrame, raw_max: float = 0, raw_mean: float = 0, raw_sd: float = 0, log_mean: float = 0, log_sd: float = 0) -> DataFrame:
    """Features whose statistics reach every cutoff that is set (not 0).

    A row with a zero has log2 values without a mean and SD: it fails a log mean cutoff and passes a log SD cutoff.
    With mean and SD cutoffs of one scale, mean + 2 SD must reach both.
    """
    ok, z = F.lit(True), F.col("has_zero")
    for name, cut in (("raw_max", raw_max), ("raw_mean", raw_mean), ("raw_sd", raw_sd)):
        if cut:
            ok = ok & (F.col(name) >= cut - EPS)
    if raw_mean and raw_sd:
        ok = ok & (F.col("raw_mean") + 2 * F.col("raw_sd") >= max(raw_mean, raw_sd) - EPS)
    if log_mean:
        ok = ok & ~z & (F.col("log_mean") >= log_mean - EPS)
    if log_sd:
        ok = ok & (z | (F.col("log_sd") >= log_sd - EPS))
    if log_mean and log_sd:
        ok = ok & (z | (F.col("log_mean") + 2 * F.col("log_sd") >= max(log_mean, log_sd) - EPS))
    return m.join(row_statistics(m).where(ok).select("feature"), "feature", "left_semi")


# --- scales ----------------------------------------------------------------------------------------------------------


def log2(m: DataFrame) -> DataFrame:
    return put(m, F.log2(F.when(v() > 0, v())))


def unlog2(m: DataFrame) -> DataFrame:
    """2**v of every value (values up to 0 are logarithms like others)."""
    return put(m, F.pow(F.lit(2.0), v()))


def display_log(m: DataFrame, kind: str = "log2") -> DataFrame:
    return put(m, F.log2(v() + 1)) if kind == "log2" else m


def mean_center(m: DataFrame) -> DataFrame:
    return put(m, v() - F.avg("intensity").over(by_row()))


def unit_variance(m: DataFrame) -> DataFrame:
    """Row z-scores by population SD; constant rows stay centered."""
    d, sd = v() - F.avg("intensity").over(by_row()), F.stddev_pop("intensity").over(by_row())
    return put(m, F.when(sd > 0, d / sd).otherwise(d))


def unit_magnitude(m: DataFrame) -> DataFrame:
    top = F.max(F.abs(v())).over(by_row())
    return put(m, F.when(top > 0, v() / top).otherwise(v()))


def scale_ten_thousand(m: DataFrame) -> DataFrame:
    top = F.max("intensity").over(by_row())
    return put(m, F.when(top != 0, 10000 * v() / top).otherwise(v()))


def stretch(m: DataFrame, share: float) -> DataFrame:
    """The global minimum becomes 0 and the row's value at ``share`` of its sorted columns 1.

    The place counts all columns, missing ones first, as sorting puts them; from there the first value that isn't the
    global minimum is taken, or the row's lowest value if there is none.
    """
    g = with_scalar(m, n=F.countDistinct("pixel_id"), low=F.min("intensity"))
    rows = g.groupBy("feature", "n", "low").agg(F.sort_array(F.collect_list("intensity")).alias("s"))
    missing = F.col("n") - F.size("s")
    place = F.greatest(F.floor(F.lit(share) * (F.col("n") - 1)).cast("int") - missing, F.lit(0)).cast("int")
    beyond = F.filter(F.slice("s", place + 1, F.size("s")), lambda x: x != F.col("low"))
    high = F.coalesce(F.get(beyond, F.lit(0)), F.get("s", F.lit(0)))
    factor = rows.select("feature", "low", F.when(high != F.col("low"), 1 / (high - F.col("low"))).otherwise(0.0).alias("factor"))
    return put(m.join(factor, "feature"), F.col("factor") * (v() - F.col("low")))


def column_medians(m: DataFrame) -> DataFrame:
    """pixel_id and the robust median of its values.

    Where the middle is the column's minimum, which may be noise or imputed, the first larger value is found, and the
    place moves on among the larger ones by half its relative distance from the middle.
    """
    s = m.where(v().isNotNull()).groupBy("pixel_id").agg(F.sort_array(F.collect_list("intensity")).alias("s"))
    n, half = F.size("s"), F.floor(F.size("s") / 2).cast("int")
    at = lambda k: F.get("s", k)
    even = n % 2 == 0
    plain = F.when(even, (at(half - 1) + at(half)) / 2).otherwise(at(half))
    low = at(F.lit(0))
    first = F.size(F.filter("s", lambda x: x <= F.get("s", F.lit(0))))  # place of the first larger value
    stuck = (plain == low) | (even & (at(half - 1) == low))
    nxt = F.when(first < n, first).otherwise(F.when(even, half).otherwise(half + 1))
    place = F.floor(nxt + (n - nxt) * (0.5 * (nxt - half) / F.greatest(half, F.lit(1)))).cast("int")
    return s.select("pixel_id", F.when(stuck & (n > 1), at(F.least(place, n - 1))).otherwise(plain).alias("median"))


def median_normalize(m: DataFrame) -> DataFrame:
    """Columns scaled so that their medians equal the geometric mean of all positive medians."""
    med = column_medians(m)
    target = med.agg(F.exp(F.avg(F.ln(F.when(F.col("median") > 0, F.col("median"))))).alias("target"))
    factor = med.crossJoin(F.broadcast(target)).select("pixel_id", F.when(F.col("median") > 0, F.col("target") / F.col("median")).otherwise(1.0).alias("factor"))
    return put(m.join(factor, "pixel_id"), v() * F.col("factor"))


# --- imputation and floors ---------------------------------------------------------------------------------------------


def empty() -> Column:
    return v().isNull() | (v() == 0)


def complete(m: DataFrame) -> DataFrame:
    """A row for every feature and pixel, null where there was none: what imputation fills."""
    cells = m.select("feature").distinct().crossJoin(m.select("pixel_id").distinct())
    return cells.join(m, ["feature", "pixel_id"], "left")


def positive() -> Column:
    return F.when(v() > 0, v())


def impute_global(m: DataFrame) -> DataFrame:
    """Half the smallest positive value."""
    return put(with_scalar(m, low=F.min(positive())), F.when(empty(), 0.5 * F.col("low")).otherwise(v()))


def impute_column(m: DataFrame) -> DataFrame:
    """Half the column's smallest positive value; null in a column without any."""
    return put(m, F.when(empty(), 0.5 * F.min(positive()).over(by_column())).otherwise(v()))


def impute_column_global(m: DataFrame) -> DataFrame:
    """Half the geometric mean of the global and the column's smallest positive value (the global one alone if none)."""
    low = F.coalesce(F.min(positive()).over(by_column()), F.col("low"))
    return put(with_scalar(m, low=F.min(positive())), F.when(empty(), 0.5 * F.sqrt(F.col("low") * low)).otherwise(v()))


def impute_row_column(m: DataFrame) -> DataFrame:
    """In logarithms: the global minimum averaged with the column's and, where it is below the column's or the upper
    bound (mean + 3 SD of column minima), the row's minimum; the global one alone if neither is there."""
    low = m.groupBy("pixel_id").agg(F.ln(F.min(positive())).alias("c"))
    bound = low.agg((F.avg("c") + 3 * F.stddev_pop("c")).alias("bound"))
    own = with_scalar(m, low=F.ln(F.min(positive()))).crossJoin(F.broadcast(bound))
    g, r, c = F.col("low"), F.ln(F.min(positive()).over(by_row())), F.ln(F.min(positive()).over(by_column()))
    within = F.when(c.isNull(), r < F.col("bound")).otherwise((r < c) | (r < F.col("bound")))
    other = F.when(r.isNotNull() & within, F.coalesce((r + c) / 2, r)).otherwise(F.coalesce(c, g))
    return put(own, F.when(empty(), 0.5 * F.exp((g + other) / 2)).otherwise(v()))


def detection_limits(m: DataFrame) -> DataFrame:
    """One row: lower and upper limit, exp(mean -/+ 3 SD) of the logarithms of column minima; lower at least the global
    minimum."""
    low = m.groupBy("pixel_id").agg(F.ln(F.min(positive())).alias("c"))
    g = low.agg(F.exp(F.avg("c") - 3 * F.stddev_pop("c")).alias("lo"), F.exp(F.avg("c") + 3 * F.stddev_pop("c")).alias("upper"), F.exp(F.min("c")).alias("g"))
    return g.select(F.greatest("lo", "g").alias("lower"), "upper")


def floor_to(m: DataFrame, value: float = 1.0) -> DataFrame:
    return put(m, F.greatest(F.coalesce(v(), F.lit(value)), F.lit(value)))


def floor_to_limit(m: DataFrame, limits: DataFrame, upper: bool = False) -> DataFrame:
    c = F.col("upper" if upper else "lower")
    return put(m.crossJoin(F.broadcast(limits)), F.greatest(F.coalesce(v(), c), c))


# --- the whole order ----------------------------------------------------------------------------------------------------

IMPUTE = {"global": impute_global, "col_min": impute_column, "col_geo": impute_column_global, "row_col": impute_row_column}


@dataclass(frozen=True)
class Config:
    """Options of one pass. Implications: unit variance centers; late imputation follows scaling."""

    transpose_first: bool = False
    transpose_last: bool = False
    ignore_weak: bool = False
    present: tuple[float, float] | None = None
    impute: str | None = None
    impute_later: bool = False
    floor_value: float | None = None
    floor_lod: bool = False
    floor_lod_upper: bool = False
    raw_max: float = 0
    raw_mean: float = 0
    raw_sd: float = 0
    log_mean: float = 0
    log_sd: float = 0
    median: bool = False
    ten_thousand: bool = False
    magnitude: bool = False
    stretch: float | None = None
    log2: bool = False
    center: bool = False
    unit_variance: bool = False
    unlog2: bool = False


def preprocess(m: DataFrame, c: Config) -> DataFrame:
    """Apply a pass in its fixed order: each step's statistics come from what the ones before it have kept.

    A step that reads the matrix more than once writes what it has read first, so that no step before it runs again.
    """
    from ..model import transpose

    m = transpose(m) if c.transpose_first else m
    m = flag_missing(m, c.ignore_weak)
    if c.impute or c.floor_value is not None or c.floor_lod or c.floor_lod_upper:
        m = complete(settled(m))
    statistics = c.raw_max or c.raw_mean or c.raw_sd or c.log_mean or c.log_sd
    limits = None
    if c.floor_lod or c.floor_lod_upper:
        m = settled(m)
        limits = settled(detection_limits(m))
    if c.present:
        m = filter_present(settled(m), *c.present)
    if c.impute and not c.impute_later:
        m = IMPUTE[c.impute](settled(m))
    if c.floor_value is not None:
        m = floor_to(m, c.floor_value)
    if statistics:
        m = filter_statistics(settled(m), c.raw_max, c.raw_mean, c.raw_sd, c.log_mean, c.log_sd)
    m = median_normalize(settled(m)) if c.median else m
    m = scale_ten_thousand(m) if c.ten_thousand else m
    m = unit_magnitude(m) if c.magnitude else m
    m = stretch(settled(m), c.stretch) if c.stretch is not None else m
    m = IMPUTE[c.impute](settled(m)) if c.impute and c.impute_later else m
    m = floor_to_limit(m, limits, c.floor_lod_upper) if limits is not None else m
    m = log2(m) if c.log2 else m
    m = unit_variance(m) if c.unit_variance else mean_center(m) if c.center else m
    m = unlog2(m) if c.unlog2 else m
    return transpose(m) if c.transpose_last else m


def settled(m: DataFrame) -> DataFrame:
    """The matrix as a written table, unless it is one."""
    return m if hasattr(m, "_pw_path") else written(m, "matrix")


#: The two passes of the production filter.
PASSES = (Config(present=(0.01, 0.0), raw_sd=250, floor_lod_upper=True, median=True), Config(log_sd=0.5))


def production_filter(m: DataFrame) -> DataFrame:
    for c in PASSES:
        m = preprocess(m, c)
    return m
