"""Selections, relabelling, display transforms, and aggregates over features, pixels and clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import written


def v() -> Column:
    return F.col("intensity")


def numbered(df: DataFrame, name: str, *order) -> DataFrame:
    """Rows numbered from 1 in an order, without a task that holds them all: rows are dealt by ranges of the order, numbered
    within each, and the ranges' sizes (one row a range) are summed up. Rows equal in the order are numbered at random."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    dealt = written(df.repartitionByRange(*order).withColumn("pw_part", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("pw_part").agg(F.count("*").alias("pw_n"))
    before = F.coalesce(F.sum("pw_n").over(Window.orderBy("pw_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = dealt.join(F.broadcast(sizes.select("pw_part", before.alias("pw_before"))), "pw_part")
    return own.withColumn(name, F.col("pw_before") + F.row_number().over(Window.partitionBy("pw_part").orderBy(*order))).drop("pw_part", "pw_before")



# --- features ---------------------------------------------------------------------------------------------------------


def feature_sd(m: DataFrame) -> DataFrame:
    """feature and sample SD of its values."""
    return m.groupBy("feature").agg(F.stddev_samp("intensity").alias("sd"))


def top_variable(m: DataFrame, n: int) -> DataFrame:
    """The n features of largest SD with their rank, constant ones left out; ties by name (the sorted intent)."""
    top = feature_sd(m).where("sd > 0").orderBy(F.desc("sd"), "feature").limit(n)  # n rows
    return top.select("feature", "sd", F.row_number().over(Window.orderBy(F.desc("sd"), "feature")).alias("rank"))


def top_mean(m: DataFrame, share: float) -> DataFrame:
    """Features among the top ceil(n * share) by mean."""
    means = m.groupBy("feature").agg(F.avg("intensity").alias("mean"))
    n = means.agg(F.ceil(F.count("*") * F.lit(share)).alias("n_top"))
    ranked = numbered(means, "rank", F.desc("mean"), "feature").withColumn("rank", F.col("rank").cast("int"))
    return ranked.crossJoin(F.broadcast(n)).where("rank <= n_top").drop("n_top")


def clean_values(m: DataFrame) -> DataFrame:
    """Missing and non-finite values as 0, as before PCA and correlation."""
    bad = v().isNull() | F.isnan(v()) | (F.abs(v()) == float("inf"))
    return m.select("feature", "pixel_id", F.when(bad, 0.0).otherwise(v()).alias("intensity"))


# --- pixels ---------------------------------------------------------------------------------------------------------------


def pixels_in(p: DataFrame, *labels: str, column: str = "hc_manual") -> DataFrame:
    """Pixels of the labels; all of them for ``All`` or none given."""
    return p if not labels or "All" in labels else p.where(F.col(column).isin(*labels))


def every_nth(p: DataFrame, n: int = 10, least: int = 50_000) -> DataFrame:
    """Every n-th pixel by row_id where there are ``least`` or more."""
    return p.crossJoin(F.broadcast(p.agg(F.count("*").alias("pw_n")))).where((F.col("pw_n") < least) | ((F.col("row_id") - 1) % n == 0)).drop("pw_n")


def hashed_sample(p: DataFrame, n: int, seed: int = 123) -> DataFrame:
    """n pixels by a hash of name and seed: the same ones on every run and partitioning."""
    return p.orderBy(F.md5(F.concat(F.col("pixel_id"), F.lit(f":{seed}")).cast("binary")), "pixel_id").limit(n)


def relabel(p: DataFrame, new: str, pixel_ids: list[str] | None = None, clusters: list[str] | None = None, column: str = "hc_manual") -> DataFrame:
    """Set a label for named pixels or whole clusters."""
    hit = F.col("pixel_id").isin(pixel_ids or []) | F.col("hc_orig").isin(clusters or [])
    return p.withColumn(column, F.when(hit, new).otherwise(F.col(column)))


def row_numbers(p: DataFrame) -> DataFrame:
    """row_id in order of x, then y, then name."""
    return numbered(p.drop("row_id"), "row_id", "x_coord", "y_coord", "pixel_id").withColumn("row_id", F.col("row_id").cast("int"))


def display(m: DataFrame, contrast: float) -> DataFrame:
    """v ** (1 / contrast), contrast within 0.3 and 5, then to 0..1 over a feature (0 if constant)."""
    w = Window.partitionBy("feature")
    y = F.pow(v(), F.lit(1 / min(5.0, max(0.3, contrast))))
    own = m.withColumn("y", y)
    low, high = F.min("y").over(w), F.max("y").over(w)
    return own.select("feature", "pixel_id", F.when(high > low, (F.col("y") - low) / (high - low)).otherwise(0.0).alias("shown"))


def feature_on_pixels(p: DataFrame, m: DataFrame, feature: str) -> DataFrame:
    """Pixels with the value of one feature (0 where missing) and its median over all pixels."""
    one = m.where(F.col("feature") == feature).select("pixel_id", "intensity")
    own = p.join(one, "pixel_id", "left").withColumn("intensity", F.coalesce("intensity", F.lit(0.0)))
    return own.crossJoin(F.broadcast(own.agg(F.median("intensity").alias("median"))))


# --- blocks ------------------------------------------------------------------------------------------------------------------


def blocks(p: DataFrame, size: int) -> DataFrame:
    """Pixels with the block they fall in (floor of coordinates over size)."""
    return p.withColumn("bx", F.floor(F.col("x_coord") / size).cast("int")).withColumn("by", F.floor(F.col("y_coord") / size).cast("int"))


def collapse(m: DataFrame, p: DataFrame, size: int, how: str = "median") -> DataFrame:
    """Median or mean of each feature over the pixels of each block."""
    agg = F.median("intensity") if how == "median" else F.avg("intensity")
    return m.join(blocks(p, size).select("pixel_id", "bx", "by"), "pixel_id").groupBy("feature", "bx", "by").agg(agg.alias("intensity"))


def common_label(p: DataFrame, keys: list[str], column: str = "hc_manual") -> DataFrame:
    """The most frequent label of a group: where all counts are 1 that of the first row_id, else ties by alphabet."""
    n = p.groupBy(*keys, column).agg(F.count("*").alias("n"), F.min("row_id").alias("first"))
    best = n.groupBy(*keys).agg(F.max("n").alias("most"), F.min_by(column, "first").alias("leading"), F.min_by(column, F.struct(-F.col("n"), F.col(column))).alias("mode"))
    return best.select(*keys, F.when(F.col("most") == 1, F.col("leading")).otherwise(F.col("mode")).alias("label"))


def dominant_color(p: DataFrame) -> DataFrame:
    """Colour of a domain by majority, ties by alphabet; grey without any."""
    n = p.groupBy("hc_manual", "color").agg(F.count("color").alias("n"))
    best = n.groupBy("hc_manual").agg(F.min_by("color", F.struct(-F.col("n"), F.col("color"))).alias("color"))
    return best.select(F.col("hc_manual").alias("domain"), clean_color(F.coalesce("color", F.lit(""))).alias("color"))


# --- colours and labels --------------------------------------------------------------------------------------------------


def clean_color(c: Column) -> Column:
    """``xFF0000`` as ``#FF0000``; grey for what isn't six hexadecimal digits."""
    six = F.regexp_replace(c, "^[xX#]", "")
    return F.when(six.rlike("^[0-9A-Fa-f]{6}$"), F.concat(F.lit("#"), six)).otherwise("#CCCCCC")


def palette_index(k: Column, n: Column, reverse: bool = False) -> Column:
    """Place 0 to 255 of item k of n in a palette of 256."""
    at = F.when(n > 1, F.floor(0.5 + 255 * k / (n - 1))).otherwise(F.lit(0)).cast("int")
    return F.lit(255) - at if reverse else at


def rgb_to_hls(r: Column, g: Column, b: Column) -> tuple[Column, Column, Column]:
    """Hue in degrees, lightness and saturation of components 0 to 1."""
    hi, lo = F.greatest(r, g, b), F.least(r, g, b)
    span, light = hi - lo, (hi + lo) / 2
    sat = F.when(span == 0, 0.0).when(light <= 0.5, span / (hi + lo)).otherwise(span / (2 - hi - lo))
    hue = F.when(span == 0, 0.0).when(hi == r, (g - b) / span).when(hi == g, 2 + (b - r) / span).otherwise(4 + (r - g) / span) * 60
    return F.when(hue < 0, hue + 360).otherwise(hue), light, sat


def hls_to_rgb(h: Column, l: Column, s: Column) -> tuple[Column, Column, Column]:
    """Inverse of rgb_to_hls."""
    a = s * F.least(l, 1 - l)

    def part(n: int) -> Column:
        k = F.pmod(F.lit(n) + h / 30, F.lit(12.0))
        return l - a * F.greatest(F.lit(-1.0), F.least(k - 3, 9 - k, F.lit(1.0)))

    return part(0), part(8), part(4)


def significance(fc: Column, p: Column, cut: float, fdr: float) -> Column:
    return F.when((fc >= cut) & (p < fdr), "Up").when((fc <= -cut) & (p < fdr), "Down").otherwise("Not significant")


def volcano_height(stat: Column, p: Column | None) -> Column:
    """-log10 of p (with a floor), or the size of the statistic where there is no p."""
    return -F.log10(p + 1e-300) if p is not None else F.abs(stat)


def stars(p: Column, alpha: float = 0.05) -> Column:
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < alpha, "*")


def volcano(de: DataFrame, cut: float = 1.0, fdr: float = 0.05, top: int = 10) -> DataFrame:
    """DE rows with group, height and a mark for the ``top`` highest."""
    y = volcano_height(F.col("test_statistic"), F.col("adj_p_value"))
    own = de.withColumn("height", y).where(F.col("height").isNotNull() & ~F.isnan("height")).withColumn("group", significance(F.col("log_fc"), F.col("adj_p_value"), cut, fdr))
    highest = own.select("metabolite", "height").orderBy(F.desc("height"), "metabolite").limit(top).agg(F.collect_set("metabolite").alias("pw_top"))  # ``top`` names
    return own.crossJoin(F.broadcast(highest)).withColumn("labelled", F.array_contains("pw_top", F.col("metabolite"))).drop("pw_top")


# --- cluster aggregates ------------------------------------------------------------------------------------------------------


def log_row_statistics(m: DataFrame) -> DataFrame:
    """RowMin, RowMean, RowMax, RowStDev of log2 values, population SD (the true maximum, also below 0)."""
    logs = F.log2(F.when(v() > 0, v()))
    return m.groupBy("feature").agg(F.min(logs).alias("row_min"), F.avg(logs).alias("row_mean"), F.max(logs).alias("row_max"), F.stddev_pop(logs).alias("row_sd"))


def cluster_means(m: DataFrame, p: DataFrame, cluster: str = "hc_orig") -> DataFrame:
    """For each cluster and feature the sum of log2 of positive values over the number of the cluster's pixels."""
    size = p.groupBy(cluster).agg(F.count("*").alias("n"))
    total = m.join(p.select("pixel_id", cluster), "pixel_id").groupBy(cluster, "feature").agg(F.sum(F.when(v() > 0, F.log2(v())).otherwise(0.0)).alias("s"))
    return total.join(size, cluster).select(F.col(cluster).alias("cluster"), "feature", (F.col("s") / F.col("n")).alias("mean"))


def cluster_mean_statistics(means: DataFrame) -> DataFrame:
    return means.groupBy("feature").agg(F.min("mean").alias("c_min"), F.avg("mean").alias("c_mean"), F.max("mean").alias("c_max"), F.stddev_pop("mean").alias("c_sd"))


def feature_cluster_profile(m: DataFrame, f: DataFrame) -> DataFrame:
    """For each feature cluster (f: feature, cluster) and pixel the geometric mean over all its features, and the median."""
    size = f.groupBy("cluster").agg(F.count("*").alias("n"))
    own = m.join(f, "feature").groupBy("cluster", "pixel_id").agg(F.sum(F.ln(F.when(v() > 0, v()))).alias("s"), F.median("intensity").alias("median"))
    return own.join(size, "cluster").select("cluster", "pixel_id", F.exp(F.coalesce("s", F.lit(0.0)) / F.col("n")).alias("geo_mean"), "median")


def cluster_sizes(p: DataFrame, cluster: str = "hc_orig") -> DataFrame:
    return p.groupBy(F.col(cluster).alias("cluster")).agg(F.count("*").alias("cluster_size"))


def palette_reversed(p: DataFrame, cluster: str = "hc_orig") -> DataFrame:
    """One row: whether the first half of clusters (by name) lies nearer to the centroid than the second."""
    c = p.agg(F.avg("x_coord").alias("cx"), F.avg("y_coord").alias("cy"))
    d = F.sqrt(F.pow(F.col("x_coord") - F.col("cx"), 2) + F.pow(F.col("y_coord") - F.col("cy"), 2))
    far = p.crossJoin(F.broadcast(c)).groupBy(cluster).agg(F.avg(d).alias("far"))
    w = Window.orderBy(cluster)
    own = far.select("far", F.row_number().over(w).alias("k"), F.count("*").over(Window.partitionBy()).alias("n"))
    half = F.floor(F.col("n") / 2)
    both = own.agg(F.sum(F.when(F.col("k") <= half, F.col("far")).otherwise(0.0)).alias("first_half"), F.sum(F.when(F.col("k") > F.col("n") - half, F.col("far")).otherwise(0.0)).alias("last_half"))
    return both.select("first_half", "last_half", (F.col("first_half") < F.col("last_half")).alias("reversed"))


def image_scale(m: DataFrame, share: float = 0.99) -> DataFrame:
    """Values as 0..1 between the global minimum and each feature's value at int(share * (n - 1)) of its sorted ones."""
    s = m.where(v().isNotNull()).groupBy("feature").agg(F.sort_array(F.collect_list("intensity")).alias("s"))
    high = s.select("feature", F.get("s", F.floor(F.lit(share) * (F.size("s") - 1)).cast("int")).alias("high"))
    low = m.agg(F.min("intensity").alias("low"))
    own = m.join(high, "feature").crossJoin(F.broadcast(low))
    return own.select("feature", "pixel_id", F.when(F.col("high") > F.col("low"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), (v() - F.col("low")) / (F.col("high") - F.col("low"))))).otherwise(0.0).alias("level"))


def heatmap_scale(means: DataFrame) -> DataFrame:
    """Cluster means within sqrt(2) times their root mean square, over it: -1 to 1."""
    cap = means.agg((F.sqrt(F.lit(2.0)) * F.sqrt(F.avg(F.col("mean") * F.col("mean")))).alias("cap"))
    return means.crossJoin(F.broadcast(cap)).select("cluster", "feature", (F.greatest(-F.col("cap"), F.least(F.col("cap"), F.col("mean"))) / F.col("cap")).alias("level"))


def contact_sheet(features: DataFrame, columns: int) -> DataFrame:
    """Grid places of features in name order."""
    k = F.col("pw_k") - 1
    return numbered(features.select("feature"), "pw_k", "feature").select("feature", F.floor(k / columns).cast("int").alias("row"), (k % columns).cast("int").alias("col"))
