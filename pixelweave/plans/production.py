"""The batch pipeline: filter a matrix, build trees of features and pixels, cut them, write the result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import transpose
from ..operators import preprocess as P
from ..operators import selection as S
from ..operators import tree as H
from ..operators.distance import Metric
from ..sources import tables as R


@dataclass(frozen=True)
class Production:
    """Options of a run; the linkage is one of ``tree.METHODS``, and names like average, complete, single are mapped."""

    passes: tuple[P.Config, ...] = P.PASSES
    feature_metric: Metric = Metric("pearson")
    pixel_metric: Metric = Metric("pearson")
    linkage: str = "upgma"
    feature_clusters: int = 23
    pixel_clusters: int = 22

    def method(self) -> str:
        return {"average": "upgma", "complete": "clink", "single": "slink"}.get(self.linkage, self.linkage)


def feature_cluster_rows(m: DataFrame, clusters: DataFrame, p: DataFrame) -> DataFrame:
    """m/z, tree order, cluster, size, log2 statistics of the row and of the cluster means, joined by name, and a map of
    the mean by pixel cluster (p: pixel_id, hc_orig)."""
    means = S.cluster_means(m, p)
    by_cluster = means.groupBy("feature").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("cluster", "mean")))).alias("means"))
    own = clusters.select(F.col("leaf").alias("feature"), F.col("leaf_order").alias("tree_order"), "cluster", "cluster_size")
    return own.join(S.log_row_statistics(m), "feature").join(S.cluster_mean_statistics(means), "feature").join(by_cluster, "feature")


def run(spark: SparkSession, m: DataFrame, config: Production | None = None) -> dict[str, DataFrame]:
    """filtered, feature_clusters, pixel_clusters, feature_table, and the two Newick texts as one-row tables."""
    c = config or Production()
    for one in c.passes:
        m = P.preprocess(m, one)
    m = m.persist()
    shown = P.unit_variance(P.log2(m))
    features, f_cut = H.cluster_features(shown, c.feature_metric, c.method(), c.feature_clusters)
    pixels, p_cut = H.cluster_features(transpose(shown), c.pixel_metric, c.method(), c.pixel_clusters)
    f_rows, p_rows = H.cluster_table(spark, features, f_cut), H.cluster_table(spark, pixels, p_cut)
    places = R.pixels_of_names(m)
    labelled = places.join(p_rows.select(F.col("leaf").alias("pixel_id"), F.col("cluster").alias("hc_orig")), "pixel_id")
    text = lambda root: spark.createDataFrame([(H.to_newick(root),)], "newick string")
    return {
        "filtered": m, "feature_clusters": f_rows, "pixel_clusters": R.pixel_cluster_rows(places, p_rows), "feature_table": feature_cluster_rows(m, f_rows, labelled),
        "feature_tree": text(features), "pixel_tree": text(pixels),
    }


def write(results: dict[str, DataFrame], folder: str) -> None:
    """Matrix lines and tables as tab-separated text, trees as text, under a folder."""
    for name, df in results.items():
        if name == "filtered":
            R.matrix_lines(df).select("line").write.mode("overwrite").text(f"{folder}/{name}")
        elif name.endswith("_tree"):
            df.coalesce(1).write.mode("overwrite").text(f"{folder}/{name}")
        elif name == "feature_table":
            R.write_tsv(df.withColumn("means", F.to_json("means")), f"{folder}/{name}")
        else:
            R.write_tsv(df, f"{folder}/{name}")
