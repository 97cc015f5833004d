"""Queries of joins with libraries and neighbours, of name and formula functions, and of readers and writers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import strings as N
from ..model import SALES_PIXELS_SQL, SALES_SQL, feature_mz, pixel_x, pixel_y, read, sales_matrix, sales_pixels
from ..operators import annotate as A
from ..sources import tables as R

M, PX = f"WITH {SALES_SQL}", SALES_PIXELS_SQL
ADDUCT_SQL = "a(adduct, o) AS (VALUES " + ", ".join(f"('{k}', {o!r}::DOUBLE)" for k, (o, _) in A.ADDUCTS.items()) + ")"


def library(s, d):
    """Parts as molecules: price as mass, a third with a CCS for protonated ones, two sources."""
    k = F.col("p_partkey")
    p = read(s, d, "part")
    return p.select(
        k.cast("string").alias("mol_id"), F.when(k % 2 == 0, "HMDB").otherwise("LMAPS").alias("source"), F.col("p_retailprice").alias("mass"), F.when(k % 17 == 0, 1).otherwise(0).alias("charge"), F.lit("C6H12O6").alias("formula"), F.col("p_name").alias("name"),
        F.concat(F.lit("I"), (k % 50).cast("string")).alias("inchi"), F.when(k % 3 == 0, F.concat(F.lit("K"), k.cast("string"))).alias("kegg"), F.lit(None).cast("string").alias("cid"), F.lit(None).cast("string").alias("hmdb"), F.when(k % 3 == 0, 150.0 + k % 40).alias("ccs_db"),
    )


LIB_SQL = "lib AS (SELECT p_partkey, p_partkey::VARCHAR AS mol_id, CASE WHEN p_partkey % 2 = 0 THEN 'HMDB' ELSE 'LMAPS' END AS source, p_retailprice AS mass, p_name AS name, 'I' || p_partkey % 50 AS inchi, CASE WHEN p_partkey % 3 = 0 THEN 'K' || p_partkey END AS kegg, CASE WHEN p_partkey % 3 = 0 THEN 150.0 + p_partkey % 40 END AS ccs_db FROM part WHERE p_partkey % 17 <> 0)"


def peaks(s, d):
    """Prices of all parts, off by up to 30 ppm, protonated."""
    k = F.col("p_partkey")
    return read(s, d, "part").select(k.alias("peak"), (F.col("p_retailprice") * (1 + (k % 61 - 30) * 1e-6) + A.PROTON).alias("mz"), (150.0 + k % 7 * 10).alias("ccs"))


PEAK_SQL = f"pk AS (SELECT p_partkey AS peak, p_retailprice * (1 + (p_partkey % 61 - 30) * 1e-6) + {A.PROTON!r} AS mz, 150.0 + p_partkey % 7 * 10 AS ccs FROM part)"
# a molecule stands in its whole mass's bin and in both beside it, a peak in one: no product of all peaks and molecules
HIT_SQL = f"""lm AS (SELECT lib.*, adduct, mass + o AS mz_db, unnest([floor(mass + o) - 1, floor(mass + o), floor(mass + o) + 1]) AS bin FROM lib, a),
h AS MATERIALIZED (SELECT peak, mz, ccs, lm.*, 1e6 * abs(mz_db - mz) / mz_db AS ppm FROM pk JOIN lm ON lm.bin = floor(pk.mz) WHERE 1e6 * abs(mz_db - mz) / mz_db <= 20 + 1e-5)"""
STEP_SQL = "CASE WHEN ppm <= 5 + 1e-5 THEN 5 WHEN ppm <= 10 + 1e-5 THEN 10 WHEN ppm <= 15 + 1e-5 THEN 15 ELSE 20 END"
BEST_SQL = f"""t AS (SELECT *, {STEP_SQL} AS tolerance, CASE WHEN coalesce(abs(ccs - ccs_db) / ccs_db <= 0.03 + 1e-5, false) THEN 1 WHEN ccs_db IS NULL THEN 2 END AS pass FROM h),
u AS (SELECT * FROM t WHERE pass IS NOT NULL), b AS MATERIALIZED (SELECT * FROM u QUALIFY pass * 100 + tolerance = min(pass * 100 + tolerance) OVER (PARTITION BY peak))"""


def hits(s, d):
    found = A.band_join(peaks(s, d), A.with_adducts(library(s, d)))
    return found.withColumn("ppm", A.ppm(F.col("mz"), F.col("mz_db"))).withColumn("has_ccs", F.col("ccs_db").isNotNull())


def adducts(s, d):
    return A.with_adducts(library(s, d)).withColumn("has_ccs", F.col("ccs_db").isNotNull())


def best(s, d):
    return A.escalated(peaks(s, d), adducts(s, d), ["peak"])


def preferred(s, d):
    """Peaks with their set of candidates, and the sets without what the first source has too."""
    own, members = A.candidate_sets(peaks(s, d), adducts(s, d), ["peak"])
    return own, A.prefer_first_source(members, ["pw_set"], "HMDB", "LMAPS", ["inchi", "kegg"])


def novel(s, d):
    return A.novel_peaks(peaks(s, d), A.best_classes(peaks(s, d), adducts(s, d), ["peak"]))


def sourced(s, d):
    own, members = preferred(s, d)
    return own.join(members.hint("merge"), "pw_set").select("peak", "mol_id", "adduct")


def matches(s, d):
    p = read(s, d, "part")
    db = p.select(F.col("p_partkey").cast("string").alias("metabolite_id"), F.col("p_name").alias("metabolite_name"), F.col("p_retailprice").alias("mass"), F.col("p_brand").alias("pathway"))
    q = p.select(F.upper("p_name").alias("name")).distinct().union(p.select((F.col("p_retailprice") + 0.004).cast("decimal(12,3)").cast("string"))).union(s.createDataFrame([("mz_153.0187",)], "name string"))
    return A.match_metabolites(q.distinct(), db)


MATCH_SQL = """WITH db AS (SELECT p_partkey::VARCHAR AS metabolite_id, p_name AS metabolite_name, p_retailprice AS mass, p_brand AS pathway FROM part),
q AS (SELECT DISTINCT upper(p_name) AS name FROM part UNION SELECT (p_retailprice + 0.004)::DECIMAL(12,3)::VARCHAR FROM part UNION SELECT 'mz_153.0187'),
n AS (SELECT name, db.*, 'name' AS match_type FROM q JOIN db ON lower(name) = lower(metabolite_name)), r AS (SELECT name, try_cast(name AS DOUBLE) AS mz FROM q WHERE name NOT IN (SELECT name FROM n)),
w AS (SELECT db.*, unnest([floor(mass) - 1, floor(mass), floor(mass) + 1]) AS bin FROM db), m AS (SELECT name, w.* EXCLUDE (bin), 'mass' AS match_type FROM r JOIN w ON bin = floor(mz) WHERE abs(mass - mz) <= 0.01)
SELECT * FROM n UNION ALL SELECT * FROM m UNION ALL SELECT name, NULL, NULL, NULL, NULL, 'no_match' FROM r WHERE name NOT IN (SELECT name FROM m)"""


def priority_sql() -> str:
    return "kegg IS NULL, name IS NULL, length(name), name, mol_id"


def annotated(s, d):
    own, members = preferred(s, d)
    return own.select("peak", "pw_set").join(A.annotation_table(members, ["pw_set"]).hint("merge"), "pw_set").drop("pw_set")


#: Names and the form in which their synonyms meet.
CONFORMED = [
    ("alpha-D-Glucose", "adglucose"), ("L-Glutamic acid", "glutamate"), ("Butanoic acid", "butyrate"), ("2-Aminoethylphosphonate", "baminoethylphosphonate"), ("N-Acetyl_neuraminic acid (NANA)", "nacetylneuraminate"), ("Sulphuric acid", "sulfurate"),
    ("Monomethyl glutaric acid", "methylglutarate"), ("D-(+)-Galactosamine", "dgalactosamine"), ("1-(-)-galacturonate", "a-galacturonate"), ("5-Hydroxy-L-tryptophan", "ehydroxytryptophan"), ("Benzoates", "benzoate"), ("glycineglycine", "glycine"),
    ("Acids, palmitic", "palmitate"), ("β-Alanine", "balanine"), ("(±)-Menthol", "menthol"), ("3,4-Dihydroxy-phenyl", "g,ddihydroxyphenyl"), ("", ""),
]


def conformed(s, d):
    return s.createDataFrame([(a,) for a, _ in CONFORMED], "name string").select("name", N.conform_name(F.col("name")).alias("conformed"))


def formulas(s, d):
    rows = [("C6H12O6",), ("H2O",), ("C10H16N5O13P3",), ("NaCl",), ("CH3CH2OH",), ("C2H5Br",), ("",), ("X?",)]
    return s.createDataFrame(rows, "f string").select("f", *(N.conform_formula(F.col("f"), a).alias(n) for n, a in (("plain", None), ("h", "[M+H]+"), ("minus_h", "[M-H]-"), ("na", "[M+Na]+"))), F.coalesce(N.only_common_elements(F.col("f")), F.lit(False)).alias("common"))


QUERIES = {
    "d4_pixel_names": (lambda s, d: R.pixels_of_names(sales_matrix(s, d)), f"{M} SELECT DISTINCT pixel_id, regexp_extract(pixel_id, 'x([0-9]+)', 1)::INT AS x_coord, regexp_extract(pixel_id, 'y([0-9]+)', 1)::INT AS y_coord FROM m"),
    "d5_feature_numbers": (lambda s, d: sales_matrix(s, d).select("feature").distinct().select("feature", feature_mz(F.col("feature")).alias("mz")), f"{M} SELECT DISTINCT feature, replace(feature, 'mz_', '')::DOUBLE AS mz FROM m"),
    "d10_weights": (lambda s, d: R.weighted(read(s, d, "nation").select(F.col("n_name").alias("name")), read(s, d, "nation").where("n_nationkey < 9").select(F.col("n_name").alias("name"), (F.col("n_nationkey") / 4).alias("weight"))), "SELECT n_name AS name, CASE WHEN n_nationkey < 9 THEN n_nationkey / 4 ELSE 1.0 END AS weight FROM nation"),
    "j1_pixels_with_values": (lambda s, d: sales_pixels(s).join(sales_matrix(s, d), "pixel_id").select("pixel_id", "x_coord", "y_coord", "feature", "intensity"), f"{M}, {PX} SELECT pixel_id, x_coord, y_coord, feature, intensity FROM p JOIN m USING (pixel_id)"),
    "j4_common_pixels": (lambda s, d: sales_pixels(s).join(sales_matrix(s, d).where("feature = 'mz_3'"), "pixel_id", "left_semi").select("pixel_id"), f"{M}, {PX} SELECT pixel_id FROM p WHERE pixel_id IN (SELECT pixel_id FROM m WHERE feature = 'mz_3')"),
    "j8_match_metabolites": (matches, MATCH_SQL),
    "j9_band_join": (lambda s, d: hits(s, d).select("peak", "mol_id", "adduct", "ppm"), f"WITH {PEAK_SQL}, {LIB_SQL}, {ADDUCT_SQL}, {HIT_SQL} SELECT peak, mol_id, adduct, round(ppm, 6) AS ppm FROM h"),
    "j10_escalate": (lambda s, d: best(s, d).select("peak", "mol_id", "adduct", F.col("tolerance"), "ccs_matched"), f"WITH {PEAK_SQL}, {LIB_SQL}, {ADDUCT_SQL}, {HIT_SQL}, {BEST_SQL} SELECT peak, mol_id, adduct, tolerance, pass = 1 AS ccs_matched FROM b"),
    "j11_prefer_source": (sourced, f"WITH {PEAK_SQL}, {LIB_SQL}, {ADDUCT_SQL}, {HIT_SQL}, {BEST_SQL} SELECT peak, mol_id, adduct FROM b x WHERE source = 'HMDB' OR NOT EXISTS (SELECT 1 FROM b y WHERE y.source = 'HMDB' AND y.peak = x.peak AND (y.inchi = x.inchi OR y.kegg = x.kegg))"),
    "j12_rematch": (lambda s, d: A.rematch(peaks(s, d).select(F.col("peak").alias("vendor"), F.col("mz").alias("vendor_mz")), peaks(s, d).select("peak", "mz")).select("peak", "vendor", "ppm"), f"WITH {PEAK_SQL}, v AS (SELECT peak AS vendor, mz AS vendor_mz, unnest([floor(mz) - 1, floor(mz), floor(mz) + 1]) AS bin FROM pk) SELECT peak, vendor, round(1e6 * abs(vendor_mz - mz) / vendor_mz, 6) AS ppm FROM pk JOIN v ON bin = floor(mz) WHERE 1e6 * abs(vendor_mz - mz) / vendor_mz <= 40 + 1e-5"),
    "j13_unannotated": (lambda s, d: novel(s, d).select("peak"), f"WITH {PEAK_SQL}, {LIB_SQL}, {ADDUCT_SQL}, {HIT_SQL}, {BEST_SQL} SELECT peak FROM pk ANTI JOIN (SELECT DISTINCT mz FROM b) k USING (mz)"),
    "j14_novel_peaks": (lambda s, d: A.band_join(novel(s, d), A.with_adducts(library(s, d), ["[M+H]+"])).select("peak", "mol_id"), f"WITH {PEAK_SQL}, {LIB_SQL}, {ADDUCT_SQL}, {HIT_SQL}, {BEST_SQL} SELECT peak, mol_id FROM h ANTI JOIN (SELECT DISTINCT mz FROM b) k USING (mz) WHERE adduct = '[M+H]+'"),
    "j15_nearest": (lambda s, d: A.nearest(sales_pixels(s), 4), f"WITH {PX}, k AS (SELECT a.pixel_id AS i, b.pixel_id AS j, sqrt(pow(a.x_coord - b.x_coord, 2) + pow(a.y_coord - b.y_coord, 2)) AS d FROM p a JOIN p b ON a.pixel_id <> b.pixel_id) SELECT i, j, round(d, 6) AS d FROM k QUALIFY row_number() OVER (PARTITION BY i ORDER BY d, j) <= 4"),
    "j16_inverse_distances": (lambda s, d: A.inverse_distance_weights(sales_pixels(s)), f"WITH {PX}, k AS (SELECT a.pixel_id AS i, b.pixel_id AS j, sqrt(pow(a.x_coord - b.x_coord, 2) + pow(a.y_coord - b.y_coord, 2)) AS d FROM p a JOIN p b ON a.pixel_id <> b.pixel_id) SELECT i, j, round((SELECT max(d) FROM k) / d, 6) AS w FROM k"),
    "j17_distance_to_domain": (lambda s, d: A.distance_to_domain(sales_pixels(s), "d0", "min"), f"WITH {PX} SELECT a.pixel_id, round(min(sqrt(pow(a.x_coord - b.x_coord, 2) + pow(a.y_coord - b.y_coord, 2))), 6) AS dist FROM p a JOIN p b ON b.hc_orig = 'd0' WHERE a.hc_orig <> 'd0' GROUP BY a.pixel_id"),
    "a17_polarity": (lambda s, d: A.polarity(best(s, d)), f"WITH {PEAK_SQL}, {LIB_SQL}, {ADDUCT_SQL}, {HIT_SQL}, {BEST_SQL} SELECT count_if(adduct LIKE '%]+')::BIGINT AS n_pos, count_if(adduct LIKE '%]-')::BIGINT AS n_neg, CASE WHEN count_if(adduct LIKE '%]+') >= count_if(adduct LIKE '%]-') THEN '[M+H]+' ELSE '[M-H]-' END AS assumed FROM b"),
    "a19_annotation_table": (lambda s, d: annotated(s, d).select("peak", "n_matches"), f"WITH {PEAK_SQL}, {LIB_SQL}, {ADDUCT_SQL}, {HIT_SQL}, {BEST_SQL} SELECT peak, count(*) AS n_matches FROM b x WHERE source = 'HMDB' OR NOT EXISTS (SELECT 1 FROM b y WHERE y.source = 'HMDB' AND y.peak = x.peak AND (y.inchi = x.inchi OR y.kegg = x.kegg)) GROUP BY peak"),
    "k12_annotated_peaks": (annotated, f"""WITH {PEAK_SQL}, {LIB_SQL}, {ADDUCT_SQL}, {HIT_SQL}, {BEST_SQL},
x AS (SELECT *, replace(name, ' ', '') AS c FROM b x WHERE source = 'HMDB' OR NOT EXISTS (SELECT 1 FROM b y WHERE y.source = 'HMDB' AND y.peak = x.peak AND (y.inchi = x.inchi OR y.kegg = x.kegg))),
r AS (SELECT *, row_number() OVER (PARTITION BY peak ORDER BY kegg IS NULL, length(c), c, length(name), name, mol_id) AS r, count(*) OVER (PARTITION BY peak) AS n FROM x), first15 AS (SELECT * FROM r WHERE r <= 15),
f AS (SELECT peak, kind, string_agg(v, ' | ' ORDER BY r) AS v FROM (SELECT peak, kind, v, min(r) AS r FROM (SELECT peak, 'name' AS kind, name AS v, r FROM first15 UNION ALL SELECT peak, 'inchi', inchi, r FROM first15 UNION ALL SELECT peak, 'kegg', kegg, r FROM first15) WHERE v <> '' GROUP BY ALL) GROUP BY ALL)
SELECT t.peak, any_value(n) AS n_matches, 'C6H12O6' AS formula, max(v) FILTER (WHERE kind = 'name') AS name, max(v) FILTER (WHERE kind = 'inchi') AS inchi, '' AS hmdb, coalesce(max(v) FILTER (WHERE kind = 'kegg'), '') AS kegg, '' AS cid FROM first15 t JOIN f ON f.peak = t.peak GROUP BY t.peak"""),
    "k13_annotated_matrix": (lambda s, d: A.annotated_table(peaks(s, d).withColumn("mean", F.col("ccs") * 2), adducts(s, d), ["peak"]).select("peak", "mean", F.col("`Number of matches`").alias("n"), F.col("CCS matched").alias("matched"), F.col("`PPM tolerence`").alias("tolerance")), f"WITH {PEAK_SQL}, {LIB_SQL}, {ADDUCT_SQL}, {HIT_SQL}, {BEST_SQL}, c AS (SELECT peak, count(*) AS n, bool_or(pass = 1) AS matched, min(tolerance) AS tolerance FROM b GROUP BY peak) SELECT peak, 2 * ccs AS mean, coalesce(n, 0) AS n, matched, tolerance FROM pk LEFT JOIN c USING (peak)"),
    "f1_conform_name": (conformed, "SELECT name, conformed FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in CONFORMED) + ") AS t(name, conformed)"),
    "f2_conform_formula": (formulas, """SELECT f, plain, h, minus_h, na, common FROM (VALUES ('C6H12O6', 'C6H12O6', 'C6H13O6', 'C6H11O6', 'C6H12NaO6', true), ('H2O', 'H2O', 'H3O', 'HO', 'H2NaO', true), ('C10H16N5O13P3', 'C10H16N5O13P3', 'C10H17N5O13P3', 'C10H15N5O13P3', 'C10H16N5NaO13P3', true),
('NaCl', 'ClNa', 'ClHNa', NULL, 'ClNa2', false), ('CH3CH2OH', NULL, NULL, NULL, NULL, true), ('C2H5Br', 'C2H5Br', 'C2H6Br', 'C2H4Br', 'C2H5BrNa', false), ('', NULL, NULL, NULL, NULL, false), ('X?', NULL, NULL, NULL, NULL, false)) AS t(f, plain, h, minus_h, na, common)"""),
    "f3_natural_key": (lambda s, d: s.createDataFrame([("C2",), ("C10",), ("C1a10",), ("C1a9",), ("x",)], "x string").select("x", N.natural_key(F.col("x")).alias("key")), "SELECT x, key FROM (VALUES ('C2', 'C00000000000000000002'), ('C10', 'C00000000000000000010'), ('C1a10', 'C00000000000000000001a00000000000000000010'), ('C1a9', 'C00000000000000000001a00000000000000000009'), ('x', 'x')) AS t(x, key)"),
    "f4_numbers": (lambda s, d: s.createDataFrame([("1,234.5",), ("12",), ("1e3",), ("abc",), ("",), ("NaN",), ("1,23",), (".5",)], "x string").select("x", N.to_number(F.col("x")).alias("v"), N.is_all_digits(F.col("x")).alias("digits")), "SELECT x, v::DOUBLE AS v, digits FROM (VALUES ('1,234.5', 1234.5, false), ('12', 12, true), ('1e3', 1000, false), ('abc', NULL, false), ('', NULL, false), ('NaN', NULL, false), ('1,23', NULL, false), ('.5', 0.5, false)) AS t(x, v, digits)"),
    "f5_part_names": (lambda s, d: read(s, d, "part").select("p_partkey", N.newick_name(F.col("p_name")).alias("newick"), N.unquote(F.concat(F.lit(' "'), F.col("p_name"), F.lit('"'))).alias("plain")), "SELECT p_partkey, replace(p_name, ' ', '-') AS newick, p_name AS plain FROM part"),
    "f6_entities": (lambda s, d: s.createDataFrame([("a &lt; b &amp;amp; c",), ("&quot;x&quot;",)], "x string").select("x", N.decode_entities(F.col("x")).alias("y")), """SELECT x, y FROM (VALUES ('a &lt; b &amp;amp; c', 'a < b &amp; c'), ('&quot;x&quot;', '"x"')) AS t(x, y)"""),
    "k1_matrix_lines": (lambda s, d: R.matrix_lines(sales_matrix(s, d)), f"{M}, c AS (SELECT feature, pixel_id, intensity FROM (SELECT DISTINCT feature FROM m) CROSS JOIN (SELECT DISTINCT pixel_id FROM m) LEFT JOIN m USING (feature, pixel_id)) SELECT feature, feature || chr(9) || string_agg(coalesce(format('{{:.14g}}', intensity), ''), chr(9) ORDER BY pixel_id) AS line FROM c GROUP BY feature"),
    "s15_repair_fields": (lambda s, d: s.createDataFrame([(["1", "a", "b", "2.5", "x"],), (["1", "a", "2.5", "x"],), (["1", "a", "b"],)], "f array<string>").select(F.array_join("f", "|").alias("f"), F.array_join(R.repair_fields(F.col("f"), 1), "|").alias("g")), "SELECT f, g FROM (VALUES ('1|a|b|2.5|x', '1|a;b|2.5|x'), ('1|a|2.5|x', '1|a|2.5|x'), ('1|a|b', '1|a|b')) AS t(f, g)"),
    "d4_unparsed_names": (lambda s, d: read(s, d, "region").select("r_name", pixel_x(F.col("r_name")).alias("x"), pixel_y(F.col("r_name")).alias("y")), "SELECT r_name, -1 AS x, -1 AS y FROM region"),
}
