"""Queries of the statistics: differential tests, spatial statistics, gradients, networks, enrichment, trees."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..model import SALES_PIXELS_SQL, SALES_SQL, VECTOR_PIXELS_SQL, VECTOR_SQL, read, sales_matrix, sales_pixels, vector_matrix, vector_pixels
from ..operators import annotate as A
from ..operators import preprocess as P
from ..operators import selection as S
from ..operators import statistics as T
from ..operators import tree as H
from ..operators.distance import Metric, pairwise, vectors

M, PX, V, VP = f"WITH {SALES_SQL}", SALES_PIXELS_SQL, f"WITH {VECTOR_SQL}", VECTOR_PIXELS_SQL
TWO = f"{M}, {PX}, l AS (SELECT feature, pixel_id, log2(intensity + 1) AS v, hc_orig = 'd0' AS one FROM m JOIN p USING (pixel_id) WHERE hc_orig IN ('d0', 'd3'))"


def groups(s, d, g2="d3"):
    return T.two_groups(P.display_log(sales_matrix(s, d)), sales_pixels(s), "d0", g2)


def de(method, g2="d3"):
    return lambda s, d: T.de_analysis(P.display_log(sales_matrix(s, d)), sales_pixels(s), method, "d0", g2)


def edges(s, d):
    """Four nearest neighbours on the sales grid, weight 1."""
    return A.nearest(sales_pixels(s), 4).select("i", "j", F.lit(1.0).alias("w"))


NEAR = f"{M}, {PX}, e AS (SELECT i, j FROM (SELECT a.pixel_id AS i, b.pixel_id AS j, row_number() OVER (PARTITION BY a.pixel_id ORDER BY sqrt(pow(a.x_coord - b.x_coord, 2) + pow(a.y_coord - b.y_coord, 2)), b.pixel_id) AS k FROM p a JOIN p b ON a.pixel_id <> b.pixel_id) WHERE k <= 4)"
DIST = f"{M}, {PX}, t AS (SELECT a.pixel_id, avg(sqrt(pow(a.x_coord - b.x_coord, 2) + pow(a.y_coord - b.y_coord, 2))) AS dist FROM p a JOIN p b ON b.hc_orig = 'd0' WHERE a.hc_orig <> 'd0' GROUP BY a.pixel_id)"
RANKS = "rank() OVER (PARTITION BY {0} ORDER BY {1}) + (count(*) OVER (PARTITION BY {0}, {1}) - 1) / 2"
BH = "least(1.0, min(p_value * n / k) OVER (ORDER BY p_value DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"
WSUM = f"""{TWO}, r AS (SELECT feature, v, one, {RANKS.format('feature', 'v')} AS r, count(*) OVER (PARTITION BY feature, v) AS t FROM l),
s AS (SELECT feature, count_if(one)::BIGINT AS n1, count_if(NOT one)::BIGINT AS n2, sum(r) FILTER (WHERE one) AS r1, sum(t::DOUBLE * t - 1) AS ties, avg(v) FILTER (WHERE one) AS mean1, avg(v) FILTER (WHERE NOT one) AS mean2, median(v) FILTER (WHERE one) AS median1, median(v) FILTER (WHERE NOT one) AS median2 FROM r GROUP BY feature),
w AS (SELECT *, r1 - n1 * (n1 + 1) / 2 AS w FROM s), z AS (SELECT *, w - n1 * n2 / 2 AS c, sqrt(n1 * n2 / 12.0 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1.0)))) AS sigma FROM w)"""
MOM = f"{TWO}, s AS (SELECT feature, avg(v) FILTER (WHERE one) AS m1, avg(v) FILTER (WHERE NOT one) AS m2, var_samp(v) FILTER (WHERE one) AS v1, var_samp(v) FILTER (WHERE NOT one) AS v2, count_if(one)::BIGINT AS n1, count_if(NOT one)::BIGINT AS n2 FROM l GROUP BY feature)"


def ora(s, d):
    part = read(s, d, "part")
    sets = part.select(F.col("p_brand").alias("pathway"), F.col("p_partkey").cast("string").alias("metabolite"))
    query = part.where("p_size <= 10").select(F.col("p_partkey").cast("string").alias("metabolite"))
    return T.over_representation(query, sets.select("metabolite"), sets, 2, 100_000)


def cluster_query(s, d):
    root, found = H.cluster_features(vector_matrix(s, d), Metric("pearson"), "upgma", 4)
    return H.cluster_table(s, root, found)


def tree_query(method):
    def run(s, d):
        names, dist = H.distance_matrix(pairwise(vectors(vector_matrix(s, d)), block=8))
        root = H.build_tree(names, dist, method)
        H.clean(root)
        H.flip(root)
        return H.tree_table(s, H.from_newick(H.to_newick(root)))

    return run


def weight_query(s, d):
    names, dist = H.distance_matrix(pairwise(vectors(vector_matrix(s, d)), block=8))
    w, _ = H.gsc_weights(H.build_tree(names, dist))
    c = H.clustalw_weights(H.build_tree(names, dist))
    return s.createDataFrame([(n, float(w[n]), float(c[n])) for n in sorted(w)], "leaf string, gsc double, clustalw double")


def pca_shares(s, d):
    return T.pca(vector_matrix(s, d), 5)[1]


def network_nodes(s, d):
    return T.network(vector_matrix(s, d), 64, 0.05, 2)[0]


def network_totals(s, d):
    return T.network_summary(*T.network(vector_matrix(s, d), 64, 0.05, 2))


NET = f"""{V}, f AS (SELECT * FROM v), e AS (SELECT a.feature AS a, b.feature AS b, corr(a.intensity, b.intensity) AS r FROM f a JOIN f b ON a.pixel_id = b.pixel_id AND a.feature < b.feature GROUP BY ALL HAVING abs(corr(a.intensity, b.intensity)) >= 0.05),
n AS (SELECT feature, count(*) AS degree, sum(w) AS strength FROM (SELECT a AS feature, abs(r) AS w FROM e UNION ALL SELECT b, abs(r) FROM e) GROUP BY feature HAVING count(*) >= 2), k AS (SELECT * FROM e WHERE a IN (SELECT feature FROM n) AND b IN (SELECT feature FROM n))"""


def hypergeometric_sql() -> str:
    """Upper tail from log gammas for each pathway."""
    c = lambda n, r: f"(lgamma({n} + 1) - lgamma({r} + 1) - lgamma({n} - {r} + 1))"
    return f"exp({c('good', 'x')} + {c('bad', '(draws - x)')} - {c('(good + bad)', 'draws')})"


def normal_two_sided(z: str) -> str:
    """2 * (1 - Phi(abs(z))) by the series of Phi in odd powers over double factorials."""
    x = f"greatest(abs({z}), 1e-12)"
    return f"greatest(0.0, 1 - 2 * exp(-pow({x}, 2) / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 300), lambda k: exp((2 * k + 1) * ln({x}) - (k + 1) * ln(2.0) - lgamma(k + 1.5) + 0.5 * ln(pi())))))"


def student_two_sided_sql(t: str, df: str) -> str:
    """1 - I_y(1/2, df/2) at y = t^2 / (df + t^2) by its hypergeometric series."""
    y = f"greatest(pow({t}, 2) / ({df} + pow({t}, 2)), 1e-24)"
    lead = f"2 * exp(0.5 * ln({y}) + {df} / 2 * ln(1 - {y}) + lgamma(({df} + 1) / 2) - lgamma(0.5) - lgamma({df} / 2))"
    return f"greatest(0.0, 1 - {lead} * list_sum(list_transform(range(0, 600), lambda k: exp(lgamma(({df} + 1) / 2 + k) - lgamma(({df} + 1) / 2) - lgamma(1.5 + k) + lgamma(1.5) + k * ln({y})))))"


RATIO = "CASE WHEN ({0} + 1e-6) / ({1} + 1e-6) > 0 THEN log2(({0} + 1e-6) / ({1} + 1e-6)) END"
WELCH_SQL = f"""{MOM}, w AS (SELECT feature AS metabolite, m1, m2, {RATIO.format('m1', 'm2')} AS log_fc, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS t, pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS df FROM s WHERE n1 > 1 AND n2 > 1),
o AS (SELECT *, {student_two_sided_sql('t', 'df')} AS p_value FROM w), k AS (SELECT *, count(*) OVER () AS n, count(*) OVER (ORDER BY p_value) AS k FROM o), de AS (SELECT *, {BH} AS adj_p_value FROM k)"""
RANKED_SQL = f"{WSUM}, o AS (SELECT *, {normal_two_sided('((c - sign(c) * 0.5) / sigma)')} AS p_value FROM z), k AS (SELECT *, count(*) OVER () AS n, count(*) OVER (ORDER BY p_value) AS k FROM o), de AS (SELECT *, {BH} AS adj_p_value FROM k)"
# regression of the group by steps: each column less its mean and its projections on those before
_less = lambda c, e: f"{c} - {e} * sum({c} * {e}) OVER f / nullif(sum({e} * {e}) OVER f, 0)"
OLS_SQL = f"""{TWO}, g0 AS (SELECT l.feature, l.v, CASE WHEN one THEN 1.0 ELSE 0.0 END AS one, x_coord - avg(x_coord) OVER f AS x, y_coord - avg(y_coord) OVER f AS y FROM l JOIN p USING (pixel_id) WINDOW f AS (PARTITION BY feature)),
g1 AS (SELECT feature, v - avg(v) OVER f AS v, one - avg(one) OVER f AS one, x AS a, y AS b, x * y - avg(x * y) OVER f AS c FROM g0 WINDOW f AS (PARTITION BY feature)),
g2 AS (SELECT feature, a, {_less('v', 'a')} AS v, {_less('one', 'a')} AS one, {_less('b', 'a')} AS b, {_less('c', 'a')} AS c FROM g1 WINDOW f AS (PARTITION BY feature)),
g3 AS (SELECT feature, b, {_less('v', 'b')} AS v, {_less('one', 'b')} AS one, {_less('c', 'b')} AS c FROM g2 WINDOW f AS (PARTITION BY feature)),
g4 AS (SELECT feature, {_less('v', 'c')} AS v, {_less('one', 'c')} AS one FROM g3 WINDOW f AS (PARTITION BY feature)),
g5 AS (SELECT feature, sum(v * one) / sum(one * one) AS effect, sum(v * v) - pow(sum(v * one), 2) / sum(one * one) AS rest, sum(one * one) AS s, count(*) - 5.0 AS df FROM g4 GROUP BY feature),
w AS (SELECT feature, effect, effect / sqrt(rest / df / s) AS t, df FROM g5), o AS (SELECT *, {student_two_sided_sql('t', 'df')} AS p_value FROM w), k AS (SELECT *, count(*) OVER () AS n, count(*) OVER (ORDER BY p_value) AS k FROM o)
SELECT feature AS metabolite, round(effect, 6) AS effect, round(t, 6) AS test_statistic, round(p_value, 6) AS p_value, round({BH}, 6) AS adj_p_value FROM k"""
PREF_SQL = f"""{M}, {PX}, l AS (SELECT k.g AS domain, feature, intensity AS v, hc_orig = k.g AS one FROM m JOIN p USING (pixel_id) CROSS JOIN (SELECT DISTINCT hc_orig AS g FROM p) k),
r AS (SELECT domain, feature, v, one, {RANKS.format('domain, feature', 'v')} AS r, count(*) OVER (PARTITION BY domain, feature, v) AS t FROM l),
s AS (SELECT domain, feature, count_if(one)::BIGINT AS n1, count_if(NOT one)::BIGINT AS n2, sum(r) FILTER (WHERE one) AS r1, sum(t::DOUBLE * t - 1) AS ties, median(v) FILTER (WHERE one) AS median1, median(v) FILTER (WHERE NOT one) AS median2 FROM r GROUP BY ALL),
z AS (SELECT *, r1 - n1 * (n1 + 1) / 2 - n1 * n2 / 2 AS c, sqrt(n1 * n2 / 12.0 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1.0)))) AS sigma FROM s WHERE n1 >= 3 AND n2 >= 3),
o AS (SELECT domain, feature AS metabolite, {RATIO.format('median1', 'median2')} AS log2fc, {normal_two_sided('((c - sign(c) * 0.5) / sigma)')} AS raw_p FROM z), k AS (SELECT *, count(*) OVER (PARTITION BY domain) AS n, count(*) OVER (PARTITION BY domain ORDER BY raw_p) AS k FROM o),
e AS (SELECT domain, metabolite, log2fc, raw_p, least(1.0, min(raw_p * n / k) OVER (PARTITION BY domain ORDER BY raw_p DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS adj_p FROM k)"""
STARS = "CASE WHEN {0} < 0.001 THEN '***' WHEN {0} < 0.01 THEN '**' WHEN {0} < 0.05 THEN '*' END"


ORA_SQL = f"""WITH s AS (SELECT DISTINCT p_brand AS pathway, p_partkey::VARCHAR AS metabolite, p_size <= 10 AS hit FROM part),
c AS (SELECT pathway, count(*) AS pathway_size, count_if(hit)::BIGINT AS overlap_count, string_agg(metabolite, ';' ORDER BY metabolite) FILTER (WHERE hit) AS overlap_metabolites FROM s GROUP BY pathway HAVING count(*) BETWEEN 2 AND 100000 AND count_if(hit) > 0),
n AS (SELECT count(*) AS total, count_if(p_size <= 10)::BIGINT AS draws FROM part),
q AS (SELECT pathway, pathway_size, overlap_count, overlap_metabolites, pathway_size AS good, total - pathway_size AS bad, draws, unnest(range(overlap_count, least(pathway_size, draws)::BIGINT + 1)) AS x FROM c, n),
t AS (SELECT pathway, pathway_size, overlap_count, overlap_metabolites, least(1.0, sum({hypergeometric_sql()})) AS p_value FROM q GROUP BY ALL),
k AS (SELECT *, count(*) OVER () AS n, count(*) OVER (ORDER BY p_value) AS k FROM t), o AS (SELECT *, {BH} AS adj_p_value FROM k)"""

G_SQL = f"""WITH {VECTOR_PIXELS_SQL}, l AS (SELECT hc_manual AS label, row_number() OVER (ORDER BY pixel_id) AS k FROM q),
w AS (SELECT pixel_id, x_coord AS x, y_coord AS y, s, row_number() OVER (PARTITION BY s ORDER BY md5(pixel_id || ':' || s), pixel_id) AS k FROM q, range(0, 5) AS r(s)),
e AS (SELECT -1 AS s, hc_manual AS label, pixel_id, x_coord AS x, y_coord AS y FROM q UNION ALL SELECT s, label, pixel_id, x, y FROM w JOIN l USING (k)),
b AS (SELECT s, label, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM e GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT a.s, a.label, a.pixel_id, any_value(a.x) AS x, any_value(a.y) AS y, min(sqrt(pow(a.x - c.x, 2) + pow(a.y - c.y, 2))) AS d FROM e a JOIN e c ON a.s = c.s AND a.label = c.label AND a.pixel_id <> c.pixel_id GROUP BY ALL),
i AS (SELECT s, label, d, least(x - x0, x1 - x, y - y0, y1 - y) AS edge FROM n JOIN b USING (s, label)),
g AS (SELECT s, label, r, count_if(edge >= r AND d <= r) / nullif(count_if(edge >= r), 0) AS g FROM i, (VALUES (1.0), (1.5), (2.0), (2.5), (3.0)) AS t(r) GROUP BY ALL),
m AS (SELECT label, r, avg(g) AS permed FROM g WHERE s >= 0 GROUP BY ALL)
SELECT label, r::DOUBLE AS r, round(g, 6) AS observed, round(permed, 6) AS permed, round(g - permed, 6) AS fundiff, (SELECT count(*) FROM q) AS n_pixels FROM g LEFT JOIN m USING (label, r) WHERE s < 0"""
GRADIENT_SQL = f"""{DIST}, o AS (SELECT feature, intensity AS y, round(dist, 6) AS x, quantile_cont(intensity, 0.25) OVER f AS q1, quantile_cont(intensity, 0.75) OVER f AS q3 FROM m JOIN t USING (pixel_id) WINDOW f AS (PARTITION BY feature)),
k AS (SELECT feature, x, y FROM o WHERE y >= q1 - 1.5 * (q3 - q1) AND y <= q3 + 1.5 * (q3 - q1)), r AS (SELECT feature, x, y, {RANKS.format('feature', 'x')} AS rx, {RANKS.format('feature', 'y')} AS ry FROM k),
s AS (SELECT feature, regr_slope(y, x) AS b, sqrt((regr_syy(y, x) - pow(regr_slope(y, x), 2) * regr_sxx(y, x)) / (count(*) - 2) / regr_sxx(y, x)) AS se, count(*) - 2.0 AS df, corr(rx, ry) AS rho FROM r GROUP BY feature),
u AS (SELECT *, rho * sqrt(df / (1 - rho * rho)) AS t, b / se AS tb FROM s), p2 AS (SELECT feature, b, rho, {student_two_sided_sql('tb', 'df')} AS lm_pval, {student_two_sided_sql('t', 'df')} AS p_value FROM u),
h AS (SELECT *, count(*) OVER () AS n, count(*) OVER (ORDER BY p_value) AS k FROM p2)
SELECT feature AS molecule, round(b, 6) AS lm_coef, round(lm_pval, 6) AS lm_pval, round(rho, 6) AS spearman_r, round(p_value, 6) AS spearman_r_pval, NULL::VARCHAR AS pval_comment, round({BH}, 6) AS spearman_r_pval_adj FROM h"""

QUERIES = {
    "t1_wilcoxon": (de("wilcoxon"), f"{RANKED_SQL} SELECT feature AS metabolite, 'd0_vs_d3' AS cluster, round(mean1, 6) AS avg_log_itx1, round(mean2, 6) AS avg_log_itx2, round({RATIO.format('median1', 'median2')}, 6) AS log_fc, round(w, 6) AS test_statistic, round(p_value, 6) AS p_value, round(adj_p_value, 6) AS adj_p_value FROM de"),
    "t1_rank_sums": (lambda s, d: T.rank_sums(groups(s, d)).select("feature", "n1", "n2", "w", "z", "mean1", "mean2", "median1", "median2"), f"{WSUM} SELECT feature, n1, n2, round(w, 6) AS w, round((c - sign(c) * 0.5) / sigma, 6) AS z, round(mean1, 6) AS mean1, round(mean2, 6) AS mean2, round(median1, 6) AS median1, round(median2, 6) AS median2 FROM z"),
    "t2_welch": (lambda s, d: de("ttest")(s, d).select("metabolite", "avg_log_itx1", "avg_log_itx2", "log_fc", "test_statistic"), f"{MOM} SELECT feature AS metabolite, round(m1, 6) AS avg_log_itx1, round(m2, 6) AS avg_log_itx2, round(log2((m1 + 1e-6) / (m2 + 1e-6)), 6) AS log_fc, round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 6) AS test_statistic FROM s WHERE n1 > 1 AND n2 > 1"),
    "t2_welch_p": (de("ttest"), f"{WELCH_SQL} SELECT metabolite, 'd0_vs_d3' AS cluster, round(m1, 6) AS avg_log_itx1, round(m2, 6) AS avg_log_itx2, round(log_fc, 6) AS log_fc, round(t, 6) AS test_statistic, round(p_value, 6) AS p_value, round(adj_p_value, 6) AS adj_p_value FROM de"),
    "t5_library_wilcoxon": (lambda s, d: T.library_tests(P.display_log(sales_matrix(s, d)), sales_pixels(s), "wilcoxon", "d0", "d3"), f"{RANKED_SQL} SELECT feature, CASE WHEN n1 > 1 AND n2 > 1 THEN round(mean1 - mean2, 6) END AS log_fc, CASE WHEN n1 > 1 AND n2 > 1 THEN round(w, 6) END AS test_statistic, round(p_value, 6) AS p_value, round(adj_p_value, 6) AS adj_p_value, row_number() OVER (ORDER BY round(adj_p_value, 9) NULLS LAST, abs(mean1 - mean2) DESC, feature) AS place FROM de"),
    "t5_library_ttest": (lambda s, d: T.library_tests(P.display_log(sales_matrix(s, d)), sales_pixels(s), "ttest", "d0", "d3"), f"{WELCH_SQL} SELECT metabolite AS feature, round(m1 - m2, 6) AS log_fc, round(t, 6) AS test_statistic, round(p_value, 6) AS p_value, round(adj_p_value, 6) AS adj_p_value, row_number() OVER (ORDER BY round(adj_p_value, 9) NULLS LAST, abs(m1 - m2) DESC, metabolite) AS place FROM de"),
    "t3_hellinger": (lambda s, d: de("hellinger")(s, d).select("metabolite", "test_statistic", "log_fc"), f"{MOM} SELECT feature AS metabolite, round(1 - sqrt(2 * sqrt(v1 * v2) / (v1 + v2)) * exp(-pow(m1 - m2, 2) / (4 * (v1 + v2))), 6) AS test_statistic, round(log2((m1 + 1e-6) / (m2 + 1e-6)), 6) AS log_fc FROM s"),
    "t4_versus_all": (lambda s, d: T.rank_sums(groups(s, d, None)).select("feature", "n1", "n2", "median1", "median2"), f"{M}, {PX}, l AS (SELECT feature, log2(intensity + 1) AS v, hc_orig = 'd0' AS one FROM m JOIN p USING (pixel_id)) SELECT feature, count_if(one)::BIGINT AS n1, count_if(NOT one)::BIGINT AS n2, round(median(v) FILTER (WHERE one), 6) AS median1, round(median(v) FILTER (WHERE NOT one), 6) AS median2 FROM l GROUP BY feature"),
    "t5_hellinger_histogram": (de("hellinger_histogram"), f"""{TWO}, b AS (SELECT feature, v, one, min(v) OVER (PARTITION BY feature) AS lo, (max(v) OVER (PARTITION BY feature) - min(v) OVER (PARTITION BY feature)) / 49 AS w FROM l),
h AS (SELECT feature, least(49, greatest(1, ceil((v - lo) / w))) AS bin, count_if(one)::BIGINT AS c1, count_if(NOT one)::BIGINT AS c2 FROM b GROUP BY ALL), s AS (SELECT feature, count_if(one)::BIGINT AS n1, count_if(NOT one)::BIGINT AS n2, avg(v) FILTER (WHERE one) AS m1, avg(v) FILTER (WHERE NOT one) AS m2 FROM l GROUP BY feature)
SELECT feature, round(any_value(m1 - m2), 6) AS log_fc, round(sqrt(0.5 * sum(pow(sqrt(c1 / n1) - sqrt(c2 / n2), 2))), 6) AS test_statistic FROM h JOIN s USING (feature) GROUP BY feature"""),
    "t6_spatial_regression": (de("spatial"), OLS_SQL),
    "t8_moran_geary": (lambda s, d: T.moran_geary(P.complete(sales_matrix(s, d)), edges(s, d)), f"""{NEAR}, c AS (SELECT feature, pixel_id, coalesce(intensity, 0) AS v FROM (SELECT DISTINCT feature FROM m) CROSS JOIN (SELECT DISTINCT pixel_id FROM m) LEFT JOIN m USING (feature, pixel_id)),
z AS (SELECT feature, pixel_id, v - avg(v) OVER (PARTITION BY feature) AS z FROM c), s AS (SELECT feature, sum(z * z) AS ss, count(*) AS n FROM z GROUP BY feature)
SELECT feature, round(any_value(n) / (SELECT count(*) FROM e) * sum(a.z * b.z) / any_value(ss), 6) AS moran_i, round((any_value(n) - 1) * sum(pow(a.z - b.z, 2)) / (2.0 * (SELECT count(*) FROM e) * any_value(ss)), 6) AS geary_c FROM e JOIN z a ON a.pixel_id = i JOIN z b ON b.pixel_id = j AND a.feature = b.feature JOIN s ON s.feature = a.feature GROUP BY a.feature""".replace("SELECT feature, round(any_value(n)", "SELECT a.feature AS feature, round(any_value(n)")),
    "t11_gradient_reference": (lambda s, d: T.gradient_reference(sales_pixels(s), "d0", 4), f"WITH {PX}, r AS (SELECT * FROM p WHERE hc_orig = 'd0'), k AS (SELECT a.pixel_id AS i, b.pixel_id AS j, sqrt(pow(a.x_coord - b.x_coord, 2) + pow(a.y_coord - b.y_coord, 2)) AS d FROM r a CROSS JOIN r b), c AS (SELECT min(d) FILTER (WHERE i <> j) AS least, quantile_cont(d, 0.2) AS q20 FROM k) SELECT i AS pixel_id FROM k, c WHERE i <> j AND d >= 0.25 * least AND d <= q20 GROUP BY i HAVING count(*) >= 4"),
    "t11_spatial_gradient": (lambda s, d: T.spatial_gradient(sales_matrix(s, d), A.distance_to_domain(sales_pixels(s), "d0"), log_dist=True), None),
    "t12_gradient_lines": (lambda s, d: T.gradient_lines(sales_matrix(s, d), A.distance_to_domain(sales_pixels(s), "d0")), f"{DIST} SELECT feature, round(regr_slope(intensity, dist), 6) AS slope, round(regr_intercept(intensity, dist), 6) AS intercept, round(regr_r2(intensity, dist), 6) AS r2 FROM m JOIN t USING (pixel_id) GROUP BY feature"),
    "t13_gradient_without_outliers": (lambda s, d: T.spatial_gradient(sales_matrix(s, d), A.distance_to_domain(sales_pixels(s), "d0").withColumn("dist", F.round("dist", 6)), robust=False, out_rm=True), GRADIENT_SQL),
    "t15_spearman": (lambda s, d: T.spearman(sales_matrix(s, d), A.distance_to_domain(sales_pixels(s), "d0").select("pixel_id", F.round("dist", 6).alias("dist"))), f"{DIST}, u AS (SELECT pixel_id, round(dist, 6) AS dist FROM t), r AS (SELECT feature, {RANKS.format('feature', 'intensity')} AS a, {RANKS.format('feature', 'dist')} AS b FROM m JOIN u USING (pixel_id)) SELECT feature, round(corr(a, b), 6) AS spearman_r FROM r GROUP BY feature"),
    "t17_pca": (pca_shares, None),
    "t17_pca_scores": (lambda s, d: T.pca(vector_matrix(s, d), 3)[0], None),
    "t18_umap": (lambda s, d: T.umap_layout(vector_matrix(s, d)), None),
    "t19_scatter_fit": (lambda s, d: T.scatter_fit(T.scatter(vector_matrix(s, d), "f0", "f1")), f"{V}, x AS (SELECT pixel_id, max(intensity) FILTER (WHERE feature = 'f0') AS x, max(intensity) FILTER (WHERE feature = 'f1') AS y FROM v GROUP BY pixel_id) SELECT round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept, round(regr_r2(y, x), 6) AS r2, regr_count(y, x)::BIGINT AS n FROM x"),
    "t20_ellipses": (lambda s, d: T.ellipses(T.pca(vector_matrix(s, d), 3)[0], vector_pixels(s, d)), None),
    "t21_distributions": (lambda s, d: T.distributions(vector_matrix(s, d), vector_pixels(s, d)), f"{V}, {VP} SELECT feature, hc_manual AS label, round(min(intensity), 6) AS low, round(quantile_cont(intensity, 0.25), 6) AS q1, round(median(intensity), 6) AS median, round(quantile_cont(intensity, 0.75), 6) AS q3, round(max(intensity), 6) AS high, count(intensity) AS n FROM v JOIN q USING (pixel_id) GROUP BY ALL"),
    "t22_g_curves": (lambda s, d: T.g_curves(vector_pixels(s, d).drop("vec_id"), [0.0, 1.0, 1.5, 2.0, 2.5, 3.0]), G_SQL),
    "t22_curve_components": (lambda s, d: T.curve_components(T.g_curves(vector_pixels(s, d).drop("vec_id"), [0.0, 1.0, 1.5, 2.0, 2.5, 3.0]))[0], None),
    "t23_correlations": (lambda s, d: T.correlations(vector_matrix(s, d), vector_matrix(s, d).select("feature").distinct()), f"{V}, f AS (SELECT * FROM v) SELECT a.feature AS a, b.feature AS b, round(corr(a.intensity, b.intensity), 6) AS r FROM f a JOIN f b ON a.pixel_id = b.pixel_id AND a.feature < b.feature GROUP BY ALL"),
    "t23_correlations_spearman": (lambda s, d: T.correlations(vector_matrix(s, d), vector_matrix(s, d).select("feature").distinct(), "spearman"), f"{V}, f AS (SELECT feature, pixel_id, {RANKS.format('feature', 'intensity')} AS r FROM v) SELECT a.feature AS a, b.feature AS b, round(corr(a.r, b.r), 6) AS r FROM f a JOIN f b ON a.pixel_id = b.pixel_id AND a.feature < b.feature GROUP BY ALL"),
    "t24_network": (network_nodes, f"{NET} SELECT feature, degree, round(strength, 6) AS strength FROM n"),
    "a20_network_summary": (network_totals, f"{NET} SELECT (SELECT count(*) FROM n) AS n_nodes, count(*) AS n_edges, count_if(r > 0)::BIGINT AS n_positive, count_if(r < 0)::BIGINT AS n_negative, round(2 * count(*) / (SELECT count(*) FROM n), 6) AS mean_degree, round(2 * count(*) / ((SELECT count(*) FROM n) * ((SELECT count(*) FROM n) - 1)), 6) AS density FROM k"),
    "t25_circle_layout": (lambda s, d: T.circle_layout(network_nodes(s, d)).select("feature", (F.round(F.col("x"), 5) + 0.0).alias("x"), (F.round(F.col("y"), 5) + 0.0).alias("y")), f"{NET}, o AS (SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS k, count(*) OVER () AS c FROM n) SELECT feature, round(cos({2 * math.pi} * k / c), 5) + 0.0 AS x, round(sin({2 * math.pi} * k / c), 5) + 0.0 AS y FROM o"),
    "t25_force_layout": (lambda s, d: T.force_layout(*T.network(vector_matrix(s, d), 64, 0.05, 2)), None),
    "t25_spring_layout": (lambda s, d: T.force_layout(*T.network(vector_matrix(s, d), 64, 0.05, 2), how="kk"), None),
    "t26_preferential": (lambda s, d: T.preferential(sales_matrix(s, d), sales_pixels(s)).select("domain", "metabolite", "log2fc"), f"{M}, {PX}, l AS (SELECT k.g AS domain, feature, intensity AS v, hc_orig = k.g AS one FROM m JOIN p USING (pixel_id) CROSS JOIN (SELECT DISTINCT hc_orig AS g FROM p) k) SELECT domain, feature AS metabolite, round(log2((median(v) FILTER (WHERE one) + 1e-6) / (median(v) FILTER (WHERE NOT one) + 1e-6)), 6) AS log2fc FROM l GROUP BY ALL HAVING count_if(one) >= 3 AND count_if(NOT one) >= 3"),
    "t27_preferential_permuted": (lambda s, d: T.preferential_permuted(sales_matrix(s, d), sales_pixels(s)), None),
    "t26_preferential_p": (lambda s, d: T.preferential(sales_matrix(s, d), sales_pixels(s)).select("domain", "metabolite", "log2fc", "raw_p", "adj_p"), f"{PREF_SQL} SELECT domain, metabolite, round(log2fc, 6) AS log2fc, round(raw_p, 6) AS raw_p, round(adj_p, 6) AS adj_p FROM e"),
    "t28_occurrence_summary": (lambda s, d: T.occurrence_summary(T.preferential(sales_matrix(s, d), sales_pixels(s)), sales_pixels(s), 0.01, 0.9), f"""{PREF_SQL}, h AS (SELECT *, abs(log2fc) >= 0.01 AND adj_p <= 0.9 AS hit FROM e), n AS (SELECT hc_orig AS domain, count(*) AS n_pixels FROM p GROUP BY hc_orig)
SELECT domain, count_if(hit)::BIGINT AS n_metabolites, round(median(log2fc), 6) AS median_log2fc, round(min(raw_p), 6) AS min_raw_p, round(min(adj_p), 6) AS min_adj_p, coalesce(string_agg(metabolite, '; ' ORDER BY metabolite) FILTER (WHERE hit), '') AS preferential_metabolites, any_value(n_pixels) AS n_pixels, {STARS.format('min(adj_p)').replace('< 0.05', '< 0.9')} AS sig_label FROM h JOIN n USING (domain) GROUP BY domain"""),
    "t30_pathway_lists": (lambda s, d: T.prepare_pathways(read(s, d, "part").select(F.col("p_brand").alias("pathway"), F.when(F.col("p_size") > 45, F.lit("")).otherwise(F.col("p_type")).alias("metabolite"))), "SELECT p_brand AS pathway, string_agg(DISTINCT p_type, ';' ORDER BY p_type) AS metabolites, count(DISTINCT p_type) AS pathway_size FROM part WHERE p_size <= 45 AND p_type <> '' GROUP BY p_brand"),
    "t30_pathway_table": (lambda s, d: T.format_pathways(ora(s, d), 0.999999, 20), f"""{ORA_SQL}, t20 AS (SELECT *, row_number() OVER (ORDER BY round(adj_p_value, 9), overlap_count DESC, pathway) AS place FROM o WHERE adj_p_value <= 0.999999) SELECT place, pathway, pathway_size, overlap_count, round(p_value, 6) AS p_value, round(adj_p_value, 6) AS adj_p_value, round(-log10(adj_p_value), 6) AS height FROM t20 WHERE place <= 20"""),
    "t29_over_representation": (ora, f"{ORA_SQL} SELECT pathway, pathway_size, overlap_count, overlap_metabolites, round(p_value, 6) AS p_value, round(adj_p_value, 6) AS adj_p_value FROM o"),
    "w3_bh": (lambda s, d: T.adjust_bh(read(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_quantity") > 48, None).otherwise(F.col("l_discount") * 9 + 0.001).alias("p_value"))), f"WITH t AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 48 THEN NULL ELSE l_discount * 9 + 0.001 END AS p_value FROM lineitem), k AS (SELECT *, count(p_value) OVER () AS n, count(p_value) OVER (ORDER BY p_value NULLS LAST) AS k FROM t) SELECT l_orderkey, l_linenumber, round(p_value, 6) AS p_value, CASE WHEN p_value IS NOT NULL THEN round(least(1.0, min(p_value * n / k) OVER (ORDER BY p_value DESC NULLS LAST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 6) END AS adj_p_value FROM k"),
    "w2_average_ranks": (lambda s, d: read(s, d, "part").select("p_partkey", T.average_rank("p_size", "p_brand").alias("r")), f"SELECT p_partkey, {RANKS.format('p_brand', 'p_size')} AS r FROM part"),
    "p29_volcano": (lambda s, d: S.volcano(T.de_analysis(P.display_log(sales_matrix(s, d)), sales_pixels(s), "ttest", "d0", "d3"), 0.01, 0.9).select("metabolite", "log_fc", "adj_p_value", "height", "group"), f"""{WELCH_SQL} SELECT metabolite, round(log_fc, 6) AS log_fc, round(adj_p_value, 6) AS adj_p_value, round(-log10(adj_p_value + 1e-300), 6) AS height, CASE WHEN log_fc >= 0.01 AND adj_p_value < 0.9 THEN 'Up' WHEN log_fc <= -0.01 AND adj_p_value < 0.9 THEN 'Down' ELSE 'Not significant' END AS "group" FROM de"""),
    "p31_stars": (lambda s, d: s.range(100).select("id", S.stars(F.col("id") / 1000).alias("mark")), "SELECT id, CASE WHEN id / 1000 < 0.001 THEN '***' WHEN id / 1000 < 0.01 THEN '**' WHEN id / 1000 < 0.05 THEN '*' END AS mark FROM range(100) AS r(id)"),
    "h1_clusters": (cluster_query, None),
    "h11_leaf_weights": (weight_query, None),
} | {f"h2_tree_{m}": (tree_query(m), None) for m in H.METHODS}
