"""Matrix operators on small cases with known results."""

import math

import pytest
from pyspark.sql import functions as F

from pixelweave.model import feature_mz, pixel_x, pixel_y, transpose
from pixelweave.operators import distance as D
from pixelweave.operators import preprocess as P
from pixelweave.operators import selection as S


def matrix(spark, rows):
    return spark.createDataFrame([(f, f"p{k}", v) for f, vs in rows.items() for k, v in enumerate(vs)], "feature string, pixel_id string, intensity double")


def values(m):
    out = {}
    for r in m.orderBy("feature", "pixel_id").collect():
        out.setdefault(r.feature, []).append(r.intensity)
    return out


def test_names(spark):
    r = spark.createDataFrame([("y12x7", "mz_153.0187"), ("abc", "abc_x")], "p string, f string").select(pixel_x(F.col("p")), pixel_y(F.col("p")), feature_mz(F.col("f"))).collect()
    assert [tuple(x) for x in r] == [(7, 12, 153.0187), (-1, -1, None)]


def test_missing_values_never_are_nan(spark):
    m = matrix(spark, {"a": [float("nan"), float("inf"), -2.0, 1e-7]})
    assert values(P.flag_missing(m, True)) == {"a": [None, None, -2.0, None]}


def test_zero_row_passes_log_sd_and_fails_log_mean(spark):
    m = matrix(spark, {"z": [0.0, 4.0, 4.0], "y": [4.0, 4.0, 4.0], "x": [1.0, 4.0, 64.0]})
    assert set(values(P.filter_statistics(m, log_sd=0.5))) == {"z", "x"}
    assert set(values(P.filter_statistics(m, log_mean=1.0))) == {"y", "x"}


def test_present_counts_all_pixels(spark):
    m = matrix(spark, {"a": [1.0, 2.0, None, 0.0], "b": [1.0, 2.0, 3.0, 0.0]})
    assert set(values(P.filter_present(m, 0.75))) == {"b"}


def test_imputed_data_is_filtered_by_its_minimum(spark):
    m = matrix(spark, {"a": [0.5, 0.5, 3.0], "b": [2.0, 3.0, 4.0]})
    assert set(values(P.filter_present(m, 0.9))) == {"b"}


def test_unit_variance(spark):
    out = values(P.unit_variance(matrix(spark, {"a": [1.0, 2.0, 3.0, None], "c": [5.0, 5.0, 5.0, 5.0]})))
    assert out["c"] == [0, 0, 0, 0] and out["a"][3] is None
    assert sum(out["a"][:3]) == pytest.approx(0) and sum(x * x for x in out["a"][:3]) / 3 == pytest.approx(1)


def test_stuck_median_slides(spark):
    m = matrix(spark, {"a": [0.0], "b": [0.0], "c": [0.0], "d": [5.0]})
    assert P.column_medians(m).first().median == 5
    assert P.column_medians(matrix(spark, {"a": [3.0]})).first().median == 3


def test_median_normalization_equalizes_medians(spark):
    m = matrix(spark, {"a": [1.0, 10.0], "b": [2.0, 20.0], "c": [3.0, 30.0]})
    assert [r.median for r in P.column_medians(P.median_normalize(m)).collect()] == pytest.approx([math.sqrt(40)] * 2)


def test_imputation(spark):
    m = matrix(spark, {"a": [4.0, 0.0, None], "b": [8.0, 2.0, None]})
    assert values(P.impute_global(m))["a"] == [4, 1, 1]
    assert values(P.impute_column(m))["a"] == [4, 1, None]
    assert values(P.impute_column_global(m))["a"] == [4, 1, 1]
    assert all(x > 0 for v in values(P.impute_row_column(m)).values() for x in v)


def test_order_of_a_pass(spark):
    m = matrix(spark, {"a": [4.0, None, 16.0], "b": [None, None, 1.0]})
    out = values(P.preprocess(m, P.Config(present=(0.5, 0.0), impute="global", log2=True, center=True)))
    assert set(out) == {"a"} and sum(out["a"]) == pytest.approx(0)
    assert values(transpose(transpose(m))) == values(m)


def test_empty_matrix(spark):
    m = matrix(spark, {"a": [1.0]}).limit(0)
    for f in (P.unit_variance, P.median_normalize, P.impute_global, P.production_filter, lambda x: P.stretch(x, 0.9), lambda x: S.top_variable(x, 3), lambda x: D.pairwise(D.vectors(x))):
        assert f(m).count() == 0


def test_top_variable_is_sorted_by_sd(spark):
    m = matrix(spark, {"a": [1.0, 1.0], "b": [1.0, 9.0], "c": [1.0, 3.0]})
    assert [r.feature for r in S.top_variable(m, 5).orderBy("rank").collect()] == ["b", "c"]


def test_labels_of_blocks(spark):
    p = spark.createDataFrame([(1, "z", 0), (2, "a", 0), (3, "b", 1), (4, "b", 1), (5, "a", 1)], "row_id int, hc_manual string, bx int")
    assert {r.bx: r.label for r in S.common_label(p, ["bx"]).collect()} == {0: "z", 1: "b"}


def test_minkowski_example(spark):
    m = matrix(spark, {"a": [1.0, 2.0], "b": [3.0, 5.0]})
    d = D.pairwise(D.vectors(m), D.Metric("minkowski", 1.5)).first()
    assert (d.i, d.j) == ("b", "a") and d.dist == pytest.approx((8.024579547452822 / 2) ** (2 / 3))


def test_pairs_without_common_columns(spark):
    m = matrix(spark, {"a": [1.0, None], "b": [None, 2.0], "c": [4.0, 2.0]})
    d = {(r.i, r.j): r.dist for r in D.pairwise(D.vectors(m), block=1).collect()}
    assert d[("c", "a")] == pytest.approx(3) and d[("c", "b")] == pytest.approx(0) and d[("b", "a")] == pytest.approx(6)
    assert D.file_weights([2, 4]) == [2, 2, 1, 1, 1, 1]


def test_pearson_of_constant_rows(spark):
    d = D.pairwise(D.vectors(matrix(spark, {"a": [1.0, 1.0, 1.0], "b": [1.0, 2.0, 3.0]})), D.Metric("pearson")).first()
    assert d.dist == pytest.approx(math.sqrt(0.5))
