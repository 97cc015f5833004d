"""Queries of readers and writers: a table is written as a file of its format in the shared folder and read back."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..model import SALES_PIXELS_SQL, SALES_SQL, VECTOR_SQL, read, sales_matrix, sales_pixels, vector_matrix
from ..functions.strings import newick_name
from ..operators import distance as D
from ..operators import tree as H
from ..shared import shared_dir
from ..sources import imzml
from ..sources import tables as R
from . import production

M, PX = f"WITH {SALES_SQL}", SALES_PIXELS_SQL


def place(s, name: str) -> str:
    return f"{shared_dir(s)}/pixelweave/{s.sparkContext.applicationId}/file-{name}-{uuid.uuid4().hex}"


def text_file(s, lines, name: str) -> str:
    path = place(s, name)
    lines.coalesce(1).write.text(path)
    return path


def tsv(s, df, name: str) -> str:
    path = place(s, name)
    R.write_tsv(df, path)
    return path


def matrix_file(s, d):
    """The wide matrix with its header line, as text."""
    m = sales_matrix(s, d)
    header = m.select("pixel_id").distinct().agg(F.concat_ws("\t", F.lit("feature"), F.array_join(F.sort_array(F.collect_set("pixel_id")), "\t")).alias("value"))
    path = place(s, "matrix")
    header.coalesce(1).write.text(path)
    R.matrix_lines(m).select("line").coalesce(1).write.mode("append").text(f"{path}-rows")
    lines = s.read.text([path]).unionByName(s.read.text([f"{path}-rows"]))
    return R.read_matrix(s, text_file(s, lines, "whole-matrix"))


def distance_file(s, d):
    dist = D.pairwise(D.vectors(vector_matrix(s, d)), block=24).withColumn("dist", F.round("dist", 6))
    return R.read_distances(s, text_file(s, R.triangle_lines(dist).select("line"), "distances"))


def triangle(s, d):
    dist = D.pairwise(D.vectors(vector_matrix(s, d)), block=24).withColumn("dist", F.round("dist", 6))
    return R.triangle_lines(dist)


def pixel_rows(s):
    p = sales_pixels(s)
    clusters = p.select(F.col("pixel_id").alias("leaf"), (201 - F.col("row_id")).alias("leaf_order"), F.concat(F.lit("C0"), (F.substring("hc_orig", 2, 1).cast("int") + 1).cast("string")).alias("cluster"), F.lit(50).alias("cluster_size"))
    return R.pixel_cluster_rows(p, clusters)


CLUSTERS_SQL = f"{PX}, r AS (SELECT pixel_id AS \"Pixel\", x_coord AS \"X\", y_coord AS \"Y\", 201 - row_id AS \"tree order\", '00' || (substr(hc_orig, 2, 1)::INT + 1) AS cluster, 50 AS cluster_size FROM p)"


def pixel_file(s, d):
    return R.read_pixels(s, tsv(s, pixel_rows(s).withColumn("color", F.lit("xFF0000")), "pixels"))


def pipeline_pixel_file(s, d):
    return R.read_pipeline_pixels(s, tsv(s, pixel_rows(s), "clusters"))


def weight_file(s, d):
    n = read(s, d, "nation")
    rows = n.select(F.col("n_name").alias("Leaf"), F.when(F.col("n_nationkey") % 3 == 0, F.lit("none")).otherwise((F.col("n_nationkey") / 4).cast("string")).alias("Weight"))
    return R.read_weights(s, tsv(s, rows, "weights"))


def leaf_weight_rows(s, d):
    return R.weight_rows(read(s, d, "nation").select(F.col("n_name").alias("leaf"), (F.col("n_nationkey") / 7).alias("weight")))


def metabolite_file(s, d):
    p = read(s, d, "part")
    rows = p.select(F.col("p_partkey").cast("string").alias("metabolite_id"), F.col("p_name").alias("metabolite_name"), F.when(F.col("p_size") == 7, F.lit("n/a")).otherwise(F.col("p_retailprice").cast("string")).alias("mass"), F.col("p_brand").alias("pathway"))
    path = place(s, "metabolites")
    rows.write.option("header", True).csv(path)
    return R.read_metabolites(s, path)


def library_file(s, d):
    p = read(s, d, "part")
    rows = p.select(
        F.col("p_partkey").cast("string").alias("LM_ID"), F.when(F.col("p_size") == 7, F.lit("")).otherwise(F.col("p_retailprice").cast("string")).alias("EXACT_MASS"), F.col("p_name").alias("CHOSEN_NAME"), F.lit("I").alias("INCHI"), F.lit("5").alias("PUBCHEM_CID"), F.lit("H1").alias("HMDB_ID"),
        F.lit("K1").alias("KEGG_ID"), F.lit("C6H12O6").alias("FORMULA"), (150 + F.col("p_size")).cast("string").alias("CCS: [M+H]+"), F.when(F.col("p_size") > 9, F.lit("1,234.5")).alias("CCS: [M-H]-"),
    )
    own = R.read_library(s, tsv(s, rows, "library"), "LMAPS")
    return own.select("mol_id", "source", "mass", "name", "formula", "kegg", F.try_element_at("ccs", F.lit("[M+H]+")).alias("h"), F.try_element_at("ccs", F.lit("[M-H]-")).alias("minus_h"))


def peak_file(s, d):
    p = read(s, d, "part")
    rows = p.select(F.when(F.col("p_size") == 7, F.lit("x")).otherwise(F.col("p_retailprice").cast("string")).alias("m/z"), F.lit("0.01").alias("Interval Width"), (150 + F.col("p_size")).cast("string").alias("CCS [A]"), F.lit("[M+H]+").alias("Notation"))
    return R.read_peaks(s, tsv(s, rows, "peaks"))


def csv_file(s, d):
    p = read(s, d, "part")
    rows = p.select(F.col("p_partkey").cast("string").alias("id"), F.concat(F.lit('say "'), F.col("p_name"), F.lit('",\nthen; go')).alias("text"))
    path = place(s, "csv")
    rows.write.option("header", True).option("quote", '"').option("escape", '"').option("quoteAll", True).csv(path)
    return R.read_csv(s, path, unwrap=True)


def sdf_file(s, d):
    p = read(s, d, "part")
    field = lambda k, v: F.concat(F.lit(f"> <{k}>\n"), v, F.lit("\n\n"))
    record = F.concat(field("LM_ID", F.col("p_partkey").cast("string")), field("NAME", F.concat(F.col("p_name"), F.lit(" [iso6]"))), field("SYSTEMATIC_NAME", F.col("p_brand")), field("EXACT_MASS", F.col("p_retailprice").cast("string")), field("FORMULA", F.lit("C2H6O")), F.lit("$$$$"))
    return R.read_sdf(s, text_file(s, p.select(record.alias("value")), "sdf")).select("LM_ID", "CHOSEN_NAME", "EXACT_MASS", "FORMULA")


def hmdb_file(s, d):
    p = read(s, d, "part")
    tag = lambda k, v: F.concat(F.lit(f"<{k}>"), v, F.lit(f"</{k}>"))
    name = F.when(F.col("p_partkey") % 5 == 0, F.col("p_partkey").cast("string")).otherwise(F.concat(F.col("p_name"), F.lit(" &amp; co")))
    record = F.concat(F.lit("<metabolite>"), tag("accession", F.concat(F.lit("H"), F.col("p_partkey").cast("string"))), tag("name", name), tag("iupac_name", F.col("p_type")), tag("chemical_formula", F.lit("CH4")), F.lit("</metabolite>"))
    path = place(s, "hmdb")
    lines = s.createDataFrame([(0, "<hmdb>"), (2, "</hmdb>")], "k int, value string").unionByName(p.select(F.lit(1).alias("k"), record.alias("value")))
    lines.repartition(1).sortWithinPartitions("k").select("value").write.text(path)
    return R.read_hmdb(s, path)


def mapping(s, d):
    p = read(s, d, "part")
    return R.mapping_table(p.select(F.col("p_brand").alias("accession"), F.col("p_type").alias("name"), F.when(F.col("p_size") > 25, F.col("p_name")).otherwise("").alias("iupac_name")))


def ccs(s, d):
    p = read(s, d, "part")
    own = p.select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, F.lit("NaCl")).when(F.col("p_partkey") % 3 == 1, F.lit("C2H6O")).otherwise(F.lit("He")).alias("formula"), F.create_map(F.lit("[M+H]+"), F.col("p_size") + 100.5, F.lit("[M-H]-"), F.col("p_size") + 90.5).alias("ccs"))
    return R.ccs_table(own).withColumnsRenamed({"CCS: [M+H]+": "plus_h", "CCS: [M+Na]+": "plus_na", "CCS: [M-H]-": "minus_h"})


def spectra(s, d):
    """A spectrum a supplier: order numbers modulo 97 as m/z, summed prices as intensities."""
    mz = (F.lit(100.0) + F.col("l_orderkey") % 97).alias("mz")
    cell = read(s, d, "lineitem").groupBy("l_suppkey", mz).agg(F.round(F.sum("l_extendedprice"), 2).alias("v"))
    one = cell.groupBy("l_suppkey").agg(F.sort_array(F.collect_list(F.struct("mz", "v"))).alias("s"))
    return one.select((F.col("l_suppkey") % 10).cast("int").alias("x"), F.floor(F.col("l_suppkey") / 10).cast("int").alias("y"), F.transform("s", lambda c: c["mz"]).alias("mz"), F.transform("s", lambda c: c["v"]).alias("intensity"))


SPECTRA_SQL = """c AS (SELECT l_suppkey, 100.0 + l_orderkey % 97 AS mz, round(sum(l_extendedprice), 2) AS v FROM lineitem GROUP BY ALL),
n AS (SELECT *, lag(v) OVER w AS a, lead(v) OVER w AS b FROM c WINDOW w AS (PARTITION BY l_suppkey ORDER BY mz)), k AS (SELECT l_suppkey, list_sort(list(v))[count(*) // 2 + 1] AS middle FROM c GROUP BY l_suppkey),
pk AS (SELECT (l_suppkey % 10)::INT AS x, (l_suppkey // 10)::INT AS y, mz, v AS intensity FROM n JOIN k USING (l_suppkey) WHERE v > a AND v >= b AND v > 1.5 * middle)"""

def spectrum_file(s, d):
    """The spectra written by the driver, as they are few, and read by ranges."""
    path = imzml.local_path(place(s, "spectra"))
    os.makedirs(os.path.dirname(path), exist_ok=True)
    imzml.write_files(path, [tuple(r) for r in spectra(s, d).collect()])
    return R.read_imzml(s, path).select("x", "y", F.explode(F.arrays_zip("mz", "intensity")).alias("p")).select("x", "y", "p.mz", "p.intensity")


def nation_tree(s, d):
    """Nations below regions below a root, edges by keys, written as Newick text and read back."""
    n, r = read(s, d, "nation"), read(s, d, "region")
    name = lambda c: newick_name(F.col(c))
    leaves = n.groupBy("n_regionkey").agg(F.array_join(F.sort_array(F.collect_list(F.concat(name("n_name"), F.lit(":"), (F.col("n_nationkey") / 8 + 1).cast("string")))), ",").alias("t"))
    inner = leaves.join(r, leaves["n_regionkey"] == r["r_regionkey"]).agg(F.array_join(F.sort_array(F.collect_list(F.concat(F.lit("("), F.col("t"), F.lit(")x:"), (F.col("r_regionkey") / 4 + 2).cast("string")))), ",").alias("t"))
    path = text_file(s, inner.select(F.concat(F.lit("("), F.col("t"), F.lit("):0;")).alias("value")), "tree")
    return H.from_newick(H.to_newick(H.from_newick(s.read.text(path).first()[0])))


def tree_rows(s, d):
    return H.tree_table(s, nation_tree(s, d)).select("name", "edge_length", "avg_length", "clevel", "num_members")


def plain_heights(s, d):
    root = nation_tree(s, d)
    H.depower(root, 2.0)
    return H.tree_table(s, root).where("num_members > 1").select("name", "avg_length", "num_members")


def leaf_rows(s, d):
    leaves = H.tree_table(s, nation_tree(s, d)).where("num_members = 1").select(F.col("name").alias("leaf"), "leaf_order")
    data = read(s, d, "nation").select(newick_name(F.col("n_name")).alias("key"), "n_nationkey", "n_regionkey")
    return H.leaf_table(leaves.repartition(4), data, "key").select("leaf", "n_nationkey", "n_regionkey", (F.col("tree_order") == F.col("leaf_order")).alias("in_order"))


def feature_table(s, d):
    """Rows of the result table of features for clusters by number, pixel clusters by quadrant."""
    m, k = sales_matrix(s, d), F.regexp_replace("feature", "mz_", "").cast("int")
    clusters = m.select("feature").distinct().select(F.col("feature").alias("leaf"), k.alias("leaf_order"), F.concat(F.lit("C0"), (k % 5).cast("string")).alias("cluster"), F.lit(20).alias("cluster_size"))
    return production.feature_cluster_rows(m, clusters, sales_pixels(s)).withColumn("d2", F.try_element_at("means", F.lit("d2"))).drop("means")


TREE_SQL = """l AS (SELECT replace(n_name, ' ', '-') AS name, n_regionkey, n_nationkey / 8 + 1 AS e FROM nation),
r AS (SELECT n_regionkey, min(name) AS name, count(*) AS k, avg(e) AS h, any_value(n_regionkey) / 4 + 2 AS e FROM l GROUP BY n_regionkey),
t AS (SELECT min(name) AS name, sum(k) AS n, sum((h + e) * k) / sum(k) AS h, count(*) AS k FROM r)"""

QUERIES = {
    "s5_newick_file": (tree_rows, f"WITH {TREE_SQL} SELECT name, e::DOUBLE AS edge_length, 0.0::DOUBLE AS avg_length, 0 AS clevel, 1 AS num_members FROM l UNION ALL SELECT name, e, round(h, 6), 1, k FROM r UNION ALL SELECT name, 0.0, round(h, 6), 2, n FROM t"),
    "j7_feature_table": (feature_table, f"""{M}, {PX}, n AS (SELECT hc_orig, count(*) AS n FROM p GROUP BY hc_orig), k AS (SELECT hc_orig, feature, sum(CASE WHEN intensity > 0 THEN log2(intensity) ELSE 0 END) / any_value(n) AS mean FROM m JOIN p USING (pixel_id) JOIN n USING (hc_orig) GROUP BY ALL),
a AS (SELECT feature, min(log2(intensity)) AS row_min, avg(log2(intensity)) AS row_mean, max(log2(intensity)) AS row_max, stddev_pop(log2(intensity)) AS row_sd FROM m WHERE intensity > 0 GROUP BY feature),
b AS (SELECT feature, min(mean) AS c_min, avg(mean) AS c_mean, max(mean) AS c_max, stddev_pop(mean) AS c_sd, max(mean) FILTER (WHERE hc_orig = 'd2') AS d2 FROM k GROUP BY feature)
SELECT feature, replace(feature, 'mz_', '')::INT AS tree_order, 'C0' || replace(feature, 'mz_', '')::INT % 5 AS cluster, 20 AS cluster_size, round(row_min, 6) AS row_min, round(row_mean, 6) AS row_mean, round(row_max, 6) AS row_max, round(row_sd, 6) AS row_sd, round(c_min, 6) AS c_min, round(c_mean, 6) AS c_mean, round(c_max, 6) AS c_max, round(c_sd, 6) AS c_sd, round(d2, 6) AS d2 FROM a JOIN b USING (feature)"""),
    "h8_depower": (plain_heights, f"WITH {TREE_SQL} SELECT name, round(sqrt(h * k) / k, 6) AS avg_length, k AS num_members FROM r UNION ALL SELECT name, round(sqrt(h * k) / k, 6), n FROM t"),
    "h15_selection": (lambda s, d: s.createDataFrame([(t, k) for t in ("1,3-5;7", "9-7 2", "x, 4;4", "") for k in H.parse_selection(t)], "text string, k int"), "SELECT text, k FROM (VALUES ('1,3-5;7', 1), ('1,3-5;7', 3), ('1,3-5;7', 4), ('1,3-5;7', 5), ('1,3-5;7', 7), ('9-7 2', 2), ('9-7 2', 7), ('9-7 2', 8), ('9-7 2', 9), ('x, 4;4', 4)) AS v(text, k)"),
    "j5_leaf_rows": (leaf_rows, "SELECT replace(n_name, ' ', '-') AS leaf, n_nationkey, n_regionkey, true AS in_order FROM nation"),
    "s1_spectrum_file": (spectrum_file, f"WITH {SPECTRA_SQL} SELECT (l_suppkey % 10)::INT AS x, (l_suppkey // 10)::INT AS y, mz, v AS intensity FROM c"),
    "s3_matrix_file": (matrix_file, f"{M} SELECT feature, pixel_id, intensity FROM (SELECT DISTINCT feature FROM m) CROSS JOIN (SELECT DISTINCT pixel_id FROM m) LEFT JOIN m USING (feature, pixel_id)"),
    "s4_distance_file": (distance_file, f"WITH {VECTOR_SQL} SELECT a.feature AS i, b.feature AS j, round(sqrt(avg(pow(a.intensity - b.intensity, 2))), 6) AS dist FROM v a JOIN v b ON a.pixel_id = b.pixel_id AND a.feature > b.feature GROUP BY ALL"),
    "s6_weight_file": (weight_file, "SELECT n_name AS name, n_nationkey / 4 AS weight FROM nation WHERE n_nationkey % 3 <> 0"),
    "s7_pixel_file": (pixel_file, f"WITH {CLUSTERS_SQL} SELECT row_number() OVER (ORDER BY \"Y\", \"X\", \"Pixel\")::INT AS row_id, \"Pixel\" AS pixel_id, \"X\" AS x_coord, \"Y\" AS y_coord, cluster AS hc_orig, 'Default' AS hc_manual, 'Default' AS mz_manual, 'xFF0000' AS color FROM r"),
    "s9_pipeline_pixel_file": (pipeline_pixel_file, f"WITH {CLUSTERS_SQL} SELECT \"Pixel\" AS pixel_id, \"X\" AS x_coord, \"Y\" AS y_coord, cluster AS hc_orig FROM r"),
    "s10_metabolite_file": (metabolite_file, "SELECT p_partkey::VARCHAR AS metabolite_id, p_name AS metabolite_name, CASE WHEN p_size <> 7 THEN p_retailprice END AS mass, p_brand AS pathway FROM part"),
    "s11_hmdb_file": (hmdb_file, "SELECT 'H' || p_partkey AS accession, CASE WHEN p_partkey % 5 = 0 THEN p_type ELSE p_name || ' & co' END AS name, NULL::VARCHAR AS traditional_iupac, p_type AS iupac_name, 'CH4' AS chemical_formula, NULL::VARCHAR AS inchi, NULL::VARCHAR AS kegg_id, NULL::VARCHAR AS pubchem_compound_id, NULL::VARCHAR AS monisotopic_molecular_weight FROM part"),
    "s13_sdf_file": (sdf_file, "SELECT p_partkey::VARCHAR AS \"LM_ID\", CASE WHEN length(p_brand) < length(p_name) + 7 THEN p_brand ELSE p_name END AS \"CHOSEN_NAME\", p_retailprice AS \"EXACT_MASS\", 'C2H6O' AS \"FORMULA\" FROM part"),
    "s14_csv_file": (csv_file, "SELECT p_partkey::VARCHAR AS id, 'say \"' || p_name || '\", then; go' AS text FROM part"),
    "s16_library_file": (library_file, "SELECT p_partkey::VARCHAR AS mol_id, 'LMAPS' AS source, p_retailprice AS mass, p_name AS name, 'C6H12O6' AS formula, 'K1' AS kegg, (150 + p_size)::DOUBLE AS h, CASE WHEN p_size > 9 THEN 1234.5 END AS minus_h FROM part WHERE p_size <> 7"),
    "s16_peak_file": (peak_file, "SELECT p_retailprice AS mz, (150 + p_size)::DOUBLE AS ccs, '[M+H]+' AS adduct FROM part WHERE p_size <> 7"),
    "s2_picked_peaks": (lambda s, d: R.pick_peaks(spectra(s, d), 1.5), f"WITH {SPECTRA_SQL} SELECT x, y, mz, intensity FROM pk"),
    "s2_peak_process": (lambda s, d: R.peak_process(spectra(s, d), 1.5, 10.0), f"WITH {SPECTRA_SQL} SELECT 'mz_' || printf('%.4f', mz) AS feature, 'y' || l_suppkey // 10 || 'x' || l_suppkey % 10 AS pixel_id, v AS intensity FROM c WHERE mz IN (SELECT mz FROM pk)"),
    "k2_triangle_lines": (triangle, f"WITH {VECTOR_SQL}, q AS (SELECT a.feature AS i, b.feature AS j, round(sqrt(avg(pow(a.intensity - b.intensity, 2))), 6) AS dist FROM v a JOIN v b ON a.pixel_id = b.pixel_id AND a.feature > b.feature GROUP BY ALL), n AS (SELECT DISTINCT feature FROM v) SELECT feature AS name, feature || chr(9) || CASE WHEN count(j) > 0 THEN string_agg(format('{{:.13g}}', dist), chr(9) ORDER BY j) || chr(9) ELSE '' END || '0' AS line FROM n LEFT JOIN q ON i = feature GROUP BY feature"),
    "k6_weight_rows": (leaf_weight_rows, "SELECT n_name AS \"Leaf\", format('{:.14g}', n_nationkey / 7) AS \"Weight\" FROM nation"),
    "k8_pixel_clusters": (lambda s, d: pixel_rows(s), f"WITH {CLUSTERS_SQL} SELECT * FROM r"),
    "k14_mapping_table": (mapping, "SELECT p_brand AS accession, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS name, coalesce(string_agg(DISTINCT p_name, '|' ORDER BY p_name) FILTER (WHERE p_size > 25), '') AS iupac_name FROM part GROUP BY p_brand"),
    "k14_ccs_table": (ccs, "SELECT p_partkey, f AS formula, f AS formula_chosen, p_size + 100.5 AS plus_h, NULL::DOUBLE AS plus_na, CASE WHEN f = 'C2H6O' THEN p_size + 90.5 END AS minus_h FROM (SELECT *, CASE p_partkey % 3 WHEN 0 THEN 'NaCl' WHEN 1 THEN 'C2H6O' ELSE 'He' END AS f FROM part)"),
}
