"""Queries of the matrix operators: filters, scales, imputation, selections, blocks, clusters and distances."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..model import SALES_PIXELS_SQL, SALES_SQL, VECTOR_PIXELS_SQL, VECTOR_SQL, sales_matrix, sales_pixels, transpose, vector_matrix, vector_pixels
from ..operators import distance as D
from ..operators import preprocess as P
from ..operators import selection as S

M, PX, VM, VP = f"WITH {SALES_SQL}", SALES_PIXELS_SQL, f"WITH {VECTOR_SQL}", VECTOR_PIXELS_SQL
CELL = "feature, pixel_id, round({}, 6) AS intensity FROM {}"
FULL = "c AS (SELECT feature, pixel_id, intensity FROM (SELECT DISTINCT feature FROM m) CROSS JOIN (SELECT DISTINCT pixel_id FROM m) LEFT JOIN m USING (feature, pixel_id))"
EMPTY = "intensity IS NULL OR intensity = 0"


#: Queries whose operator rounds its distances itself, as it does so some ten times faster than a decimal for each pair.
ROUNDED = {"x12_spatial", "x15_weighted"}


def on_sales(f):
    return lambda s, d: f(sales_matrix(s, d))


def on_vectors(f):
    return lambda s, d: f(vector_matrix(s, d))


def filled(f):
    return lambda s, d: f(P.complete(sales_matrix(s, d)))


def flagship(s, d):
    """Mean log2 intensity by domain of the 20 most variable features that half of all pixels have."""
    m = P.settled(sales_matrix(s, d))
    top = P.settled(S.top_variable(P.log2(P.filter_present(m, 0.5)), 20))
    return S.cluster_means(m.join(F.broadcast(top), "feature", "left_semi"), sales_pixels(s)).join(F.broadcast(top), "feature").select("cluster", "feature", "rank", "mean")


MEDIANS = """s AS (SELECT pixel_id, list_sort(list(intensity)) AS s, len(list(intensity)) AS n, len(list(intensity)) // 2 AS half FROM m WHERE intensity IS NOT NULL GROUP BY pixel_id),
e AS (SELECT *, CASE WHEN n % 2 = 0 THEN (s[half] + s[half + 1]) / 2 ELSE s[half + 1] END AS plain, len(list_filter(s, lambda x: x <= s[1])) AS first FROM s),
f AS (SELECT *, (plain = s[1] OR (n % 2 = 0 AND s[half] = s[1])) AND n > 1 AS stuck, CASE WHEN first < n THEN first WHEN n % 2 = 0 THEN half ELSE half + 1 END AS nxt FROM e),
md AS (SELECT pixel_id, CASE WHEN stuck THEN s[least(floor(nxt + (n - nxt) * (0.5 * (nxt - half) / greatest(half, 1)))::INT, n - 1) + 1] ELSE plain END AS median FROM f)"""

QUERIES = {
    "flagship_domain_profile": (flagship, f"""{M}, {PX},
k AS (SELECT feature FROM m GROUP BY feature HAVING count_if(intensity > 1e-14) / (SELECT count(DISTINCT pixel_id) FROM m) >= 0.5 - 1e-14),
t AS (SELECT feature, stddev_samp(log2(intensity)) AS sd FROM m JOIN k USING (feature) WHERE intensity > 0 GROUP BY feature),
r AS (SELECT feature, row_number() OVER (ORDER BY sd DESC, feature)::INT AS rank FROM t WHERE sd > 0 QUALIFY rank <= 20),
n AS (SELECT hc_orig, count(*) AS n FROM p GROUP BY hc_orig)
SELECT hc_orig AS cluster, feature, rank, round(sum(CASE WHEN intensity > 0 THEN log2(intensity) ELSE 0 END) / any_value(n), 6) AS mean FROM m JOIN r USING (feature) JOIN p USING (pixel_id) JOIN n USING (hc_orig) GROUP BY ALL"""),
    "p1_flag_missing": (on_vectors(lambda m: P.flag_missing(m, True, 0.05).groupBy("feature").agg(F.count("intensity").alias("n"), F.sum("intensity").alias("total"))),
        f"{VM} SELECT feature, count_if(abs(intensity) >= 0.05)::BIGINT AS n, round(sum(intensity) FILTER (WHERE abs(intensity) >= 0.05), 6) AS total FROM v GROUP BY feature"),
    "p2_filter_present": (on_sales(lambda m: P.filter_present(m, 0.95, 20000.0).groupBy("feature").agg(F.count("*").alias("n"))),
        f"{M} SELECT feature, count(*) AS n FROM m GROUP BY feature HAVING count_if(intensity > 20000 + 1e-14) / (SELECT count(DISTINCT pixel_id) FROM m) >= 0.95 - 1e-14"),
    "p2_filter_present_imputed": (filled(lambda m: P.filter_present(P.impute_global(m), 0.9).groupBy("feature").agg(F.count("*").alias("n"))),
        f"""{M}, {FULL}, g AS (SELECT min(intensity) AS low FROM m WHERE intensity > 0), i AS (SELECT feature, pixel_id, CASE WHEN {EMPTY} THEN 0.5 * low ELSE intensity END AS intensity FROM c, g)
SELECT feature, count(*) AS n FROM i GROUP BY feature HAVING count_if(intensity > (SELECT min(intensity) FROM i) + 1e-14) / (SELECT count(DISTINCT pixel_id) FROM i) >= 0.9 - 1e-14"""),
    "p3_row_statistics": (on_sales(P.row_statistics),
        f"{M} SELECT feature, round(max(intensity), 6) AS raw_max, round(avg(intensity), 6) AS raw_mean, round(stddev_pop(intensity), 6) AS raw_sd, round(avg(log2(intensity)) FILTER (WHERE intensity > 0), 6) AS log_mean, round(stddev_pop(log2(intensity)) FILTER (WHERE intensity > 0), 6) AS log_sd, coalesce(bool_or(intensity = 0), false) AS has_zero, count(intensity) AS n FROM m GROUP BY feature"),
    "p3_filter_statistics": (on_sales(lambda m: P.filter_statistics(m, raw_mean=160000, log_sd=0.6).select("feature").distinct()),
        f"{M} SELECT feature FROM m GROUP BY feature HAVING avg(intensity) >= 160000 - 1e-14 AND (bool_or(intensity = 0) OR stddev_pop(log2(intensity)) FILTER (WHERE intensity > 0) >= 0.6 - 1e-14)"),
    "p4_log2": (on_sales(P.log2), f"{M} SELECT {CELL.format('log2(nullif(greatest(intensity, 0), 0))', 'm')}"),
    "p5_unlog2": (on_vectors(P.unlog2), f"{VM} SELECT {CELL.format('pow(2, intensity)', 'v')}"),
    "p6_display_log": (on_sales(P.display_log), f"{M} SELECT {CELL.format('log2(intensity + 1)', 'm')}"),
    "p7_mean_center": (on_vectors(P.mean_center), f"{VM} SELECT {CELL.format('intensity - avg(intensity) OVER (PARTITION BY feature)', 'v')}"),
    "p8_unit_variance": (on_vectors(P.unit_variance), f"{VM} SELECT {CELL.format('(intensity - avg(intensity) OVER (PARTITION BY feature)) / stddev_pop(intensity) OVER (PARTITION BY feature)', 'v')}"),
    "p9_unit_magnitude": (on_vectors(P.unit_magnitude), f"{VM} SELECT {CELL.format('intensity / max(abs(intensity)) OVER (PARTITION BY feature)', 'v')}"),
    "p10_ten_thousand": (on_sales(P.scale_ten_thousand), f"{M} SELECT {CELL.format('10000 * intensity / max(intensity) OVER (PARTITION BY feature)', 'm')}"),
    "p11_stretch": (on_sales(lambda m: P.stretch(m, 0.99)), f"""{M}, g AS (SELECT count(DISTINCT pixel_id) AS n, min(intensity) AS low FROM m),
r AS (SELECT feature, list_sort(list(intensity)) AS s FROM m GROUP BY feature),
h AS (SELECT feature, low, coalesce(list_filter(s[greatest(floor(0.99 * (n - 1))::INT - (n - len(s)), 0) + 1:], lambda x: x <> low)[1], s[1]) AS high FROM r, g)
SELECT feature, pixel_id, round(CASE WHEN high <> low THEN 1 / (high - low) ELSE 0 END * (intensity - low), 6) AS intensity FROM m JOIN h USING (feature)"""),
    "p12_column_medians": (on_sales(P.column_medians), f"{M}, {MEDIANS} SELECT pixel_id, round(median, 6) AS median FROM md"),
    "p12_median_normalize": (filled(lambda m: P.put(P.median_normalize(P.impute_global(m)), F.round("intensity", 3))), f"""{M}, {FULL}, i AS (SELECT feature, pixel_id, CASE WHEN {EMPTY} THEN 0.5 * (SELECT min(intensity) FROM m WHERE intensity > 0) ELSE intensity END AS intensity FROM c),
{MEDIANS.replace('FROM m WHERE', 'FROM i WHERE')}, t AS (SELECT exp(avg(ln(median))) AS target FROM md WHERE median > 0)
SELECT feature, pixel_id, round(intensity * CASE WHEN median > 0 THEN target / median ELSE 1 END, 3) AS intensity FROM i JOIN md USING (pixel_id), t"""),
    "p13_impute_global": (filled(P.impute_global), f"{M}, {FULL} SELECT {CELL.format(f'CASE WHEN {EMPTY} THEN 0.5 * (SELECT min(intensity) FROM m WHERE intensity > 0) ELSE intensity END', 'c')}"),
    "p14_impute_column": (filled(P.impute_column), f"{M}, {FULL} SELECT {CELL.format(f'CASE WHEN {EMPTY} THEN 0.5 * min(intensity) FILTER (WHERE intensity > 0) OVER (PARTITION BY pixel_id) ELSE intensity END', 'c')}"),
    "p15_impute_column_global": (filled(P.impute_column_global), f"{M}, {FULL} SELECT {CELL.format(f'CASE WHEN {EMPTY} THEN 0.5 * sqrt((SELECT min(intensity) FROM m WHERE intensity > 0) * min(intensity) FILTER (WHERE intensity > 0) OVER (PARTITION BY pixel_id)) ELSE intensity END', 'c')}"),
    "p16_impute_row_column": (filled(P.impute_row_column), f"""{M}, {FULL}, k AS (SELECT pixel_id, ln(min(intensity)) AS c FROM m WHERE intensity > 0 GROUP BY pixel_id), b AS (SELECT avg(c) + 3 * stddev_pop(c) AS bound, min(c) AS g FROM k),
r AS (SELECT feature, ln(min(intensity)) AS r FROM m WHERE intensity > 0 GROUP BY feature)
SELECT feature, pixel_id, round(CASE WHEN {EMPTY} THEN 0.5 * exp((g + CASE WHEN r < c OR r < bound THEN (r + c) / 2 ELSE c END) / 2) ELSE intensity END, 6) AS intensity FROM c JOIN k USING (pixel_id) JOIN r USING (feature), b"""),
    "p17_detection_limits": (on_sales(P.detection_limits), f"""{M}, k AS (SELECT ln(min(intensity)) AS c FROM m WHERE intensity > 0 GROUP BY pixel_id)
SELECT round(greatest(exp(avg(c) - 3 * stddev_pop(c)), exp(min(c))), 6) AS lower, round(exp(avg(c) + 3 * stddev_pop(c)), 6) AS upper FROM k"""),
    "p18_floor_to": (filled(lambda m: P.floor_to(m, 50000.0)), f"{M}, {FULL} SELECT {CELL.format('greatest(coalesce(intensity, 50000.0), 50000.0)', 'c')}"),
    "p18_floor_to_limit": (filled(lambda m: P.floor_to_limit(m, P.detection_limits(m), True)), f"""{M}, {FULL}, k AS (SELECT ln(min(intensity)) AS c FROM m WHERE intensity > 0 GROUP BY pixel_id), l AS (SELECT exp(avg(c) + 3 * stddev_pop(c)) AS u FROM k)
SELECT {CELL.format('greatest(coalesce(intensity, u), u)', 'c, l')}"""),
    "p19_transpose": (on_sales(transpose), f"{M} SELECT pixel_id AS feature, feature AS pixel_id, intensity FROM m"),
    "p20_preprocess": (on_sales(lambda m: P.preprocess(m, P.Config(impute="col_geo", log2=True, unit_variance=True))), f"""{M}, {FULL}, i AS (SELECT feature, pixel_id, log2(CASE WHEN {EMPTY} THEN 0.5 * sqrt((SELECT min(intensity) FROM m WHERE intensity > 0) * min(intensity) FILTER (WHERE intensity > 0) OVER (PARTITION BY pixel_id)) ELSE intensity END) AS intensity FROM c)
SELECT {CELL.format('(intensity - avg(intensity) OVER (PARTITION BY feature)) / stddev_pop(intensity) OVER (PARTITION BY feature)', 'i')}"""),
    "p20_floor_and_center": (on_sales(lambda m: P.preprocess(m, P.Config(floor_value=50000.0, ten_thousand=True, center=True))), f"""{M}, {FULL}, f AS (SELECT feature, pixel_id, greatest(coalesce(intensity, 50000.0), 50000.0) AS v FROM c), t AS (SELECT feature, pixel_id, 10000 * v / max(v) OVER (PARTITION BY feature) AS v FROM f)
SELECT feature, pixel_id, round(v - avg(v) OVER (PARTITION BY feature), 6) AS intensity FROM t"""),
    "p20_columns": (on_sales(lambda m: P.preprocess(m, P.Config(transpose_first=True, magnitude=True, transpose_last=True))), f"{M} SELECT feature, pixel_id, round(intensity / max(abs(intensity)) OVER (PARTITION BY pixel_id), 6) AS intensity FROM m"),
    "p20_filter_and_scale": (on_sales(lambda m: P.preprocess(m, P.Config(present=(0.9, 20000.0), impute="col_min", impute_later=True, log2=True))), f"""{M}, {FULL}, k AS (SELECT feature FROM c GROUP BY feature HAVING count_if(intensity > 20000 + 1e-14) / (SELECT count(DISTINCT pixel_id) FROM c) >= 0.9 - 1e-14), f AS (SELECT * FROM c WHERE feature IN (SELECT feature FROM k))
SELECT feature, pixel_id, round(log2(CASE WHEN {EMPTY} THEN 0.5 * min(intensity) FILTER (WHERE intensity > 0) OVER (PARTITION BY pixel_id) ELSE intensity END), 6) AS intensity FROM f"""),
    "p21_production_filter": (on_sales(lambda m: P.put(P.production_filter(m), F.round("intensity", 3))), f"""{M}, {FULL}, k AS (SELECT ln(min(intensity)) AS c FROM m WHERE intensity > 0 GROUP BY pixel_id), u AS (SELECT exp(avg(c) + 3 * stddev_pop(c)) AS u FROM k),
a AS (SELECT feature FROM c GROUP BY feature HAVING count_if(intensity > 1e-14) / (SELECT count(DISTINCT pixel_id) FROM c) >= 0.01 - 1e-14 AND stddev_pop(intensity) >= 250 - 1e-14), f1 AS (SELECT * FROM c WHERE feature IN (SELECT feature FROM a)),
{MEDIANS.replace('FROM m WHERE', 'FROM f1 WHERE')}, t AS (SELECT exp(avg(ln(median))) AS target FROM md WHERE median > 0),
n AS (SELECT feature, pixel_id, greatest(coalesce(intensity * CASE WHEN median > 0 THEN target / median ELSE 1 END, u), u) AS intensity FROM f1 JOIN md USING (pixel_id), t, u)
SELECT feature, pixel_id, round(intensity, 3) AS intensity FROM n WHERE feature IN (SELECT feature FROM n GROUP BY feature HAVING bool_or(intensity = 0) OR stddev_pop(log2(intensity)) FILTER (WHERE intensity > 0) >= 0.5 - 1e-14)"""),
    "p22_top_variable": (on_sales(lambda m: S.top_variable(m, 15)), f"{M} SELECT feature, round(stddev_samp(intensity), 6) AS sd, row_number() OVER (ORDER BY stddev_samp(intensity) DESC, feature)::INT AS rank FROM m GROUP BY feature QUALIFY rank <= 15"),
    "t7_top_mean": (on_sales(lambda m: S.top_mean(m, 0.1)), f"{M} SELECT feature, round(avg(intensity), 6) AS mean, row_number() OVER (ORDER BY avg(intensity) DESC, feature)::INT AS rank FROM m GROUP BY feature QUALIFY rank <= ceil(count(*) OVER () * 0.1)"),
    "p24_pixels_in": (lambda s, d: S.pixels_in(sales_pixels(s), "d0", "d3").select("pixel_id", "hc_orig"), f"WITH {PX} SELECT pixel_id, hc_orig FROM p WHERE hc_orig IN ('d0', 'd3')"),
    "p25_every_nth": (lambda s, d: S.every_nth(sales_pixels(s), 10, 100).select("row_id", "pixel_id"), f"WITH {PX} SELECT row_id, pixel_id FROM p WHERE (row_id - 1) % 10 = 0"),
    "p26_hashed_sample": (lambda s, d: S.hashed_sample(sales_pixels(s), 50).select("pixel_id"), f"WITH {PX} SELECT pixel_id FROM p ORDER BY md5(pixel_id || ':123'), pixel_id LIMIT 50"),
    "p27_relabel": (lambda s, d: S.relabel(sales_pixels(s), "roi", ["y0x0", "y1x3"], ["d2"]).select("pixel_id", "hc_manual"), f"WITH {PX} SELECT pixel_id, CASE WHEN pixel_id IN ('y0x0', 'y1x3') OR hc_orig = 'd2' THEN 'roi' ELSE hc_orig END AS hc_manual FROM p"),
    "p28_display": (on_sales(lambda m: S.display(m, 2.0)), f"{M}, y AS (SELECT *, pow(intensity, 0.5) AS y FROM m) SELECT feature, pixel_id, round((y - min(y) OVER (PARTITION BY feature)) / (max(y) OVER (PARTITION BY feature) - min(y) OVER (PARTITION BY feature)), 6) AS shown FROM y"),
    "p32_clean_color": (lambda s, d: s.createDataFrame([("xFF0000",), ("F00",), ("#00ff7f",), ("",), ("XABCDEF",)], "c string").select("c", S.clean_color(F.col("c")).alias("color")),
        "SELECT c, CASE WHEN regexp_matches(regexp_replace(c, '^[xX#]', ''), '^[0-9A-Fa-f]{6}$') THEN '#' || regexp_replace(c, '^[xX#]', '') ELSE '#CCCCCC' END AS color FROM (VALUES ('xFF0000'), ('F00'), ('#00ff7f'), (''), ('XABCDEF')) AS t(c)"),
    "p33_palette_index": (lambda s, d: s.range(23).select("id", S.palette_index(F.col("id"), F.lit(23)).alias("at"), S.palette_index(F.col("id"), F.lit(23), True).alias("back")), "SELECT id, floor(0.5 + 255 * id / 22)::INT AS at, 255 - floor(0.5 + 255 * id / 22)::INT AS back FROM range(23) AS r(id)"),
    "p34_colours": (lambda s, d: s.range(64).select((F.col("id") % 4 / 3).alias("r"), (F.floor(F.col("id") / 4) % 4 / 3).alias("g"), (F.floor(F.col("id") / 16) / 3).alias("b")).withColumn("h", S.rgb_to_hls(*map(F.col, "rgb"))[0]).withColumn("l", S.rgb_to_hls(*map(F.col, "rgb"))[1]).withColumn("s", S.rgb_to_hls(*map(F.col, "rgb"))[2]).select("r", "g", "b", *(c.alias(n) for c, n in zip(S.hls_to_rgb(F.col("h"), F.col("l"), F.col("s")), ("r2", "g2", "b2"), strict=True))),
        "SELECT round(r, 6) AS r, round(g, 6) AS g, round(b, 6) AS b, round(r, 6) AS r2, round(g, 6) AS g2, round(b, 6) AS b2 FROM (SELECT id % 4 / 3 AS r, id // 4 % 4 / 3 AS g, id // 16 / 3 AS b FROM range(64) AS t(id))"),
    "p35_feature_on_pixels": (lambda s, d: S.feature_on_pixels(sales_pixels(s), sales_matrix(s, d), "mz_7").select("pixel_id", "intensity", "median"), f"{M}, {PX}, o AS (SELECT pixel_id, coalesce(intensity, 0) AS intensity FROM p LEFT JOIN (SELECT * FROM m WHERE feature = 'mz_7') USING (pixel_id)) SELECT pixel_id, intensity, round((SELECT median(intensity) FROM o), 6) AS median FROM o"),
    "a1_log_row_statistics": (on_sales(S.log_row_statistics), f"{M} SELECT feature, round(min(log2(intensity)), 6) AS row_min, round(avg(log2(intensity)), 6) AS row_mean, round(max(log2(intensity)), 6) AS row_max, round(stddev_pop(log2(intensity)), 6) AS row_sd FROM m WHERE intensity > 0 GROUP BY feature"),
    "a2_cluster_means": (lambda s, d: S.cluster_means(sales_matrix(s, d), sales_pixels(s)), f"{M}, {PX}, n AS (SELECT hc_orig, count(*) AS n FROM p GROUP BY hc_orig) SELECT hc_orig AS cluster, feature, round(sum(CASE WHEN intensity > 0 THEN log2(intensity) ELSE 0 END) / any_value(n), 6) AS mean FROM m JOIN p USING (pixel_id) JOIN n USING (hc_orig) GROUP BY ALL"),
    "a3_feature_cluster_profile": (lambda s, d: S.feature_cluster_profile(m := sales_matrix(s, d), m.select("feature").distinct().withColumn("cluster", F.concat(F.lit("c"), (F.regexp_replace("feature", "mz_", "").cast("int") % 5).cast("string")))),
        f"{M}, f AS (SELECT DISTINCT feature, 'c' || (replace(feature, 'mz_', '')::INT % 5) AS cluster FROM m), n AS (SELECT cluster, count(*) AS n FROM f GROUP BY cluster) SELECT cluster, pixel_id, round(exp(sum(ln(intensity)) FILTER (WHERE intensity > 0) / any_value(n)), 6) AS geo_mean, round(median(intensity), 6) AS median FROM m JOIN f USING (feature) JOIN n USING (cluster) GROUP BY ALL"),
    "a5_cluster_sizes": (lambda s, d: S.cluster_sizes(sales_pixels(s)), f"WITH {PX} SELECT hc_orig AS cluster, count(*) AS cluster_size FROM p GROUP BY hc_orig"),
    "a6_cluster_mean_statistics": (lambda s, d: S.cluster_mean_statistics(S.cluster_means(sales_matrix(s, d), sales_pixels(s))), f"{M}, {PX}, n AS (SELECT hc_orig, count(*) AS n FROM p GROUP BY hc_orig), k AS (SELECT hc_orig, feature, sum(CASE WHEN intensity > 0 THEN log2(intensity) ELSE 0 END) / any_value(n) AS mean FROM m JOIN p USING (pixel_id) JOIN n USING (hc_orig) GROUP BY ALL) SELECT feature, round(min(mean), 6) AS c_min, round(avg(mean), 6) AS c_mean, round(max(mean), 6) AS c_max, round(stddev_pop(mean), 6) AS c_sd FROM k GROUP BY feature"),
    "a7_palette_reversed": (lambda s, d: S.palette_reversed(sales_pixels(s)), f"WITH {PX}, c AS (SELECT avg(x_coord) AS cx, avg(y_coord) AS cy FROM p), f AS (SELECT hc_orig, avg(sqrt(pow(x_coord - cx, 2) + pow(y_coord - cy, 2))) AS far FROM p, c GROUP BY hc_orig), k AS (SELECT far, row_number() OVER (ORDER BY hc_orig) AS k, count(*) OVER () AS n FROM f), b AS (SELECT sum(CASE WHEN k <= n // 2 THEN far ELSE 0 END) AS first_half, sum(CASE WHEN k > n - n // 2 THEN far ELSE 0 END) AS last_half FROM k) SELECT round(first_half, 6) AS first_half, round(last_half, 6) AS last_half, first_half < last_half AS reversed FROM b"),
    "a8_collapse_median": (lambda s, d: S.collapse(sales_matrix(s, d), sales_pixels(s), 4), f"{M}, {PX} SELECT feature, x_coord // 4 AS bx, y_coord // 4 AS by, round(median(intensity), 6) AS intensity FROM m JOIN p USING (pixel_id) GROUP BY ALL"),
    "a9_collapse_mean": (lambda s, d: S.collapse(sales_matrix(s, d), sales_pixels(s), 4, "mean"), f"{M}, {PX} SELECT feature, x_coord // 4 AS bx, y_coord // 4 AS by, round(avg(intensity), 6) AS intensity FROM m JOIN p USING (pixel_id) GROUP BY ALL"),
    "a10_common_label": (lambda s, d: S.common_label(S.blocks(sales_pixels(s), 3), ["bx", "by"]), f'WITH {PX}, b AS (SELECT x_coord // 3 AS bx, y_coord // 3 AS b2, hc_orig, count(*) AS n, min(row_id) AS f FROM p GROUP BY ALL) SELECT bx, b2 AS "by", CASE WHEN max(n) = 1 THEN arg_min(hc_orig, f) ELSE (list(hc_orig ORDER BY n DESC, hc_orig))[1] END AS label FROM b GROUP BY bx, b2'),
    "a11_dominant_color": (lambda s, d: S.dominant_color(sales_pixels(s).withColumn("color", F.when(F.col("row_id") % 3 == 0, "xFF0000").otherwise("x00FF00"))), f"WITH {PX}, n AS (SELECT hc_orig AS domain, CASE WHEN row_id % 3 = 0 THEN '#FF0000' ELSE '#00FF00' END AS color, count(*) AS n FROM p GROUP BY ALL) SELECT domain, (list(color ORDER BY n DESC, color))[1] AS color FROM n GROUP BY domain"),
    "k9_image_scale": (on_sales(S.image_scale), f"{M}, h AS (SELECT feature, (list_sort(list(intensity)))[floor(0.99 * (count(*) - 1))::INT + 1] AS high FROM m GROUP BY feature), l AS (SELECT min(intensity) AS low FROM m) SELECT feature, pixel_id, round(least(1, greatest(0, (intensity - low) / (high - low))), 6) AS level FROM m JOIN h USING (feature), l"),
    "k10_heatmap_scale": (lambda s, d: S.heatmap_scale(S.cluster_means(sales_matrix(s, d), sales_pixels(s))), f"{M}, {PX}, n AS (SELECT hc_orig, count(*) AS n FROM p GROUP BY hc_orig), k AS (SELECT hc_orig AS cluster, feature, sum(CASE WHEN intensity > 0 THEN log2(intensity) ELSE 0 END) / any_value(n) AS mean FROM m JOIN p USING (pixel_id) JOIN n USING (hc_orig) GROUP BY ALL), c AS (SELECT sqrt(2.0) * sqrt(avg(mean * mean)) AS cap FROM k) SELECT cluster, feature, round(greatest(-cap, least(cap, mean)) / cap, 6) AS level FROM k, c"),
    "k11_contact_sheet": (on_sales(lambda m: S.contact_sheet(m.select("feature").distinct(), 7)), f"{M}, f AS (SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS k FROM (SELECT DISTINCT feature FROM m)) SELECT feature, (k // 7)::INT AS row, (k % 7)::INT AS col FROM f"),
    "w10_row_numbers": (lambda s, d: S.row_numbers(sales_pixels(s)).select("row_id", "pixel_id"), f"WITH {PX} SELECT row_number() OVER (ORDER BY x_coord, y_coord, pixel_id)::INT AS row_id, pixel_id FROM p"),
}

PAIRS = f"{VM}, j AS (SELECT a.feature AS i, b.feature AS j, a.intensity AS a, b.intensity AS b FROM v a JOIN v b ON a.pixel_id = b.pixel_id AND a.feature > b.feature)"


def distances(metric):
    return lambda s, d: D.pairwise(D.vectors(vector_matrix(s, d)), metric, block=24)


def pair_sql(expr: str) -> str:
    return f"{PAIRS} SELECT i, j, round({expr}, 6) AS dist FROM j GROUP BY i, j"


COS = "sum(a * b) / sqrt(sum(a * a) * sum(b * b))"
RMSD = "sqrt(avg(pow(a - b, 2)))"

def apart(s, d):
    """Suppliers of even number on even pixels only, the others on odd ones: no column in common."""
    k, x = F.regexp_replace("feature", "mz_", "").cast("int"), F.regexp_extract("pixel_id", "x([0-9]+)", 1).cast("int")
    return sales_matrix(s, d).where((k + x) % 2 == 0)


QUERIES |= {
    "x13_no_overlap": (lambda s, d: D.pairwise(D.vectors(apart(s, d)), block=64), f"""{M}, f AS (SELECT *, replace(feature, 'mz_', '')::INT % 2 AS odd FROM m WHERE (replace(feature, 'mz_', '')::INT + regexp_extract(pixel_id, 'x([0-9]+)', 1)::INT) % 2 = 0),
q AS (SELECT a.feature AS i, b.feature AS j, sqrt(avg(pow(a.intensity - b.intensity, 2))) AS dist FROM f a JOIN f b ON a.pixel_id = b.pixel_id AND a.feature > b.feature GROUP BY ALL), n AS (SELECT DISTINCT feature FROM f)
SELECT a.feature AS i, b.feature AS j, round(coalesce(dist, 2 * (SELECT max(dist) FROM q)), 6) AS dist FROM n a JOIN n b ON a.feature > b.feature LEFT JOIN q ON q.i = a.feature AND q.j = b.feature"""),
    "x1_rmsd": (distances(D.Metric()), pair_sql(RMSD)),
    "x2_euclidian": (distances(D.Metric("euclidian")), pair_sql("sqrt(sum(pow(a - b, 2)))")),
    "x3_cityblock": (distances(D.Metric("cityblock")), pair_sql("avg(abs(a - b))")),
    "x4_minkowski": (distances(D.Metric("minkowski", 1.5)), pair_sql("pow(avg(pow(abs(a - b), 1.5)), 1 / 1.5)")),
    "x5_pearson": (distances(D.Metric("pearson")), pair_sql("sqrt((1 - corr(a, b)) / 2)")),
    "x5_pearson_absolute": (distances(D.Metric("pearson", absolute=True)), pair_sql("sqrt(1 - abs(corr(a, b)))")),
    "x6_cosine": (distances(D.Metric("cosine")), pair_sql(f"sqrt((1 - {COS}) / 2)")),
    "x8_geomean": (distances(D.Metric(mix="geomean")), pair_sql(f"sqrt({RMSD} * (1 + sqrt((1 - {COS}) / 2)))")),
    "x8_heuristic": (distances(D.Metric(mix="heuristic")), pair_sql(f"sqrt({RMSD} * (1 + sqrt(1 - abs({COS}))))")),
    "x9_mostly_trig": (distances(D.Metric(mix="mostly")), pair_sql(f"0.001 * {RMSD} + 0.999 * sqrt((1 - {COS}) / 2)")),
    "x14_power": (distances(D.Metric(power=2.0)), pair_sql(f"pow({RMSD}, 2)")),
    "x1_rmsd_missing": (lambda s, d: D.pairwise(D.vectors(sales_matrix(s, d)), block=24), f"{M} SELECT a.feature AS i, b.feature AS j, round(sqrt(avg(pow(a.intensity - b.intensity, 2))), 6) AS dist FROM m a JOIN m b ON a.pixel_id = b.pixel_id AND a.feature > b.feature GROUP BY ALL"),
    "x11_similarity": (lambda s, d: D.pairwise(D.vectors(sales_matrix(s, d)), D.Metric("cosine", similarity=True), block=24), f"""{M}, f AS (SELECT * FROM m), n AS (SELECT feature, count(*) AS n FROM f GROUP BY feature),
q AS (SELECT a.feature AS i, b.feature AS j, count(*) AS c, sum(a.intensity * b.intensity) / sqrt(sum(a.intensity * a.intensity) * sum(b.intensity * b.intensity)) AS r FROM f a JOIN f b ON a.pixel_id = b.pixel_id AND a.feature > b.feature GROUP BY ALL)
SELECT i, j, round(sqrt((1 - r) / 2) / sqrt(c / sqrt(x.n * y.n)), 6) AS dist FROM q JOIN n x ON x.feature = i JOIN n y ON y.feature = j"""),
    "x12_spatial": (lambda s, d: D.pairwise(D.vectors(transpose(vector_matrix(s, d))), D.Metric(spatial=True), coords=vector_pixels(s, d).select(F.col("pixel_id").alias("name"), F.col("x_coord").alias("x"), F.col("y_coord").alias("y")), block=50, digits=6), f"""{VM}, {VP}, w AS (SELECT v.*, x_coord AS x, y_coord AS y FROM v JOIN q USING (pixel_id))
SELECT a.pixel_id AS i, b.pixel_id AS j, round(pow(sqrt(avg(pow(a.intensity - b.intensity, 2))), 1 + pow(0.5, any_value(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))))), 6) AS dist FROM w a JOIN w b ON a.feature = b.feature AND a.pixel_id > b.pixel_id GROUP BY ALL"""),
    "x15_weighted": (lambda s, d: D.pairwise(D.vectors(transpose(vector_matrix(s, d))), weights=[1.0 + k % 3 for k in range(64)], block=50, digits=6), f"""{VM}, f AS (SELECT feature, 1.0 + (row_number() OVER (ORDER BY feature) - 1) % 3 AS w FROM (SELECT DISTINCT feature FROM v))
SELECT a.pixel_id AS i, b.pixel_id AS j, round(sqrt(sum(w * pow(a.intensity - b.intensity, 2)) / sum(w)), 6) AS dist FROM v a JOIN v b ON a.feature = b.feature AND a.pixel_id > b.pixel_id JOIN f ON f.feature = a.feature GROUP BY ALL"""),
}
