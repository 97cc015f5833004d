"""Statistics, joins, trees and strings on small cases with known results."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixelweave.functions import special, strings
from pixelweave.operators import annotate as A
from pixelweave.operators import statistics as T
from pixelweave.operators import tree as H
from pixelweave.sources import tables as R


def test_tail_probabilities():
    assert special.normal_two_sided(np.array([1.959963984540054]))[0] == pytest.approx(0.05)
    assert special.student_two_sided(np.array([2.0, 0.0, 12.706204736432095]), np.array([10.0, 3.0, 1.0])) == pytest.approx([0.07338803477074039, 1.0, 0.05])
    assert special.f_upper(np.array([4.0]), np.array([1.0]), np.array([10.0]))[0] == pytest.approx(0.07338803477074039)
    want = sum(math.comb(10, k) * math.comb(90, 5 - k) for k in range(2, 6)) / math.comb(100, 5)
    assert special.hypergeometric_upper(2, 10, 90, 5) == pytest.approx(want)


def test_bh_leaves_null_out(spark):
    df = spark.createDataFrame([(1, 0.01), (2, 0.04), (3, 0.03), (4, None), (5, 0.04)], "k int, p_value double")
    out = {r.k: r.adj_p_value for r in T.adjust_bh(df).collect()}
    assert out[4] is None and [out[k] for k in (1, 2, 3, 5)] == pytest.approx([0.04] * 4)


def test_rank_sum_with_ties(spark):
    g = spark.createDataFrame([("f", f"p{k}", v, k < 3) for k, v in enumerate([1.0, 2.0, 2.0, 2.0, 3.0, 4.0])], "feature string, pixel_id string, intensity double, one boolean")
    r = T.rank_sums(g).first()
    assert r.w == 1.0
    ties = 27 - 3
    sigma = math.sqrt(9 / 12 * (7 - ties / 30))
    assert r.z == pytest.approx((1 - 4.5 + 0.5) / sigma)


def test_moran_of_a_chessboard(spark):
    rows = [(f"p{k}", k % 4, k // 4, float((k % 4 + k // 4) % 2)) for k in range(16)]
    p = spark.createDataFrame([r[:3] for r in rows], "pixel_id string, x_coord int, y_coord int")
    m = spark.createDataFrame([("f", r[0], r[3]) for r in rows], "feature string, pixel_id string, intensity double")
    edges = A.nearest(p, 2).select("i", "j", F.lit(1.0).alias("w"))
    r = T.moran_geary(m, edges).first()
    assert r.moran_i == pytest.approx(-1) and r.geary_c == pytest.approx(15 / 8)


def test_nearest_equals_all_pairs(spark):
    rng = np.random.default_rng(1)
    pts = [(f"p{k:03d}", float(x), float(y)) for k, (x, y) in enumerate(np.r_[rng.normal(0, 3, (60, 2)), rng.normal(80, 2, (5, 2)), [[500, 500]]])]
    got = {}
    for r in A.nearest(spark.createDataFrame(pts, "pixel_id string, x_coord double, y_coord double"), 4).collect():
        got.setdefault(r.i, set()).add(r.j)
    for n, x, y in pts:
        near = sorted((math.dist((x, y), (a, b)), m) for m, a, b in pts if m != n)[:4]
        assert got[n] == {m for _, m in near}


def test_robust_fit_ignores_an_outlier():
    x = np.arange(30.0)
    y = 2 * x + np.random.default_rng(1).normal(0, 0.1, 30)
    y[5] = 500
    coef, f, dof, done = T.huber_fit(x, y)
    assert done and coef[1] == pytest.approx(2, abs=0.02) and f > 100 and dof == 28


def test_band_join_equals_cross_filter(spark):
    rng = np.random.default_rng(2)
    lib, pk = rng.uniform(100, 104, 300), rng.uniform(100, 104, 80)
    peaks = spark.createDataFrame([(i, float(v)) for i, v in enumerate(pk)], "peak int, mz double")
    library = spark.createDataFrame([(i, float(v)) for i, v in enumerate(lib)], "mol int, mz_db double")
    got = {(r.peak, r.mol) for r in A.band_join(peaks, library, 200).collect()}
    assert got == {(i, j) for i, a in enumerate(pk) for j, b in enumerate(lib) if 1e6 * abs(b - a) / b <= 200 + 1e-5}
    assert A.ADDUCTS["[M-H]-"][0] == -A.ADDUCTS["[M+H]+"][0]


def test_tree_of_two_groups_of_near_copies():
    text = "(((A2:2.74971e-05,A3:2.74971e-05):1.37488e-05,A1:4.12459e-05):0.367125,((B2:2.75335e-05,B3:2.75335e-05):1.37669e-05,B1:4.13003e-05):0.367125):0;"
    root = H.from_newick(text)
    w, n = H.gsc_weights(root)
    assert n == pytest.approx(2, abs=0.01) and len(w) == 6
    again = H.from_newick(H.to_newick(root))
    assert sorted(x.name for x in again.leaves()) == ["A1", "A2", "A3", "B1", "B2", "B3"]
    assert sorted(sorted(x.name for x in c.leaves()) for c in H.best_cut(root, 2)) == [["A1", "A2", "A3"], ["B1", "B2", "B3"]]


def plain_agglomeration(names, dist, single):
    groups = [{n} for n in names]
    at = {n: k for k, n in enumerate(names)}
    heights = []
    while len(groups) > 1:
        pick = min if single else max
        d, a, b = min((pick(dist[at[x], at[y]] for x in groups[a] for y in groups[b]), a, b) for a in range(len(groups)) for b in range(a))
        groups[b] |= groups.pop(a)
        heights.append(d / 2)
    return heights


@pytest.mark.parametrize("method", ["slink", "clink"])
def test_linkage_heights(method):
    x = np.random.default_rng(3).normal(size=(14, 2))
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    names = [f"n{k:02d}" for k in range(14)]
    root = H.build_tree(names, dist, method)
    merged = sorted(n.edge + n.height for n in root.children)
    assert merged[-1] == pytest.approx(max(plain_agglomeration(names, dist, method == "slink")))
    assert root.size == 14 and sum(1 for n in root.post_order() if not n.leaf) == 13


@pytest.mark.parametrize("method", H.METHODS)
def test_every_linkage_merges_all(method):
    x = np.random.default_rng(4).normal(size=(9, 3))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    root = H.build_tree([str(k) for k in range(9)], d, method)
    H.clean(root)
    H.flip(root)
    assert len(root.leaves()) == 9


def test_selection_and_cluster_rows():
    assert H.parse_selection("1,3-5;7 5-3,x") == [1, 3, 4, 5, 7]
    root = H.build_tree(["a", "b", "c"], np.array([[0, 1, 9.0], [1, 0, 9.0], [9.0, 9.0, 0]]))
    assert [(leaf, c, n) for leaf, _, c, n in H.cluster_rows(root, H.cut_at(root, 0.6))] == [("a", "C01", 2), ("b", "C01", 2), ("c", "C02", 1)]


NAMES = [
    ("L-Glutamic acid", "glutamate"), ("Butanoic acid", "butyrate"), ("alpha-D-Glucose", "adglucose"), ("Benzoates", "benzoate"), ("Sulphuric acid", "sulfurate"), ("2-Aminoethylphosphonate", "baminoethylphosphonate"),
    ("D-(+)-Galactosamine", "dgalactosamine"), ("β-Alanine", "balanine"), ("glycineglycine", "glycine"),
]


def test_conformed_names(spark):
    rows = spark.createDataFrame(NAMES, "a string, b string").select("b", strings.conform_name(F.col("a")).alias("c")).collect()
    assert [r.c for r in rows] == [r.b for r in rows]


def test_formulas(spark):
    f = spark.createDataFrame([("H12C6O6",), ("NaCl",), ("CH3CH3",)], "f string")
    assert [r[0] for r in f.select(strings.conform_formula(F.col("f"))).collect()] == ["C6H12O6", "ClNa", None]
    assert [r[0] for r in f.select(strings.conform_formula(F.col("f"), "[M-H]-")).collect()] == ["C6H11O6", None, None]


def test_matrix_files(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("mz_val\ty0x0\ty0x1\ty1x0\nmz_1.5\t2\t\tabc\nmz_2.5\t1e3\t-1\n\n")
    got = {(r.feature, r.pixel_id): r.intensity for r in R.read_matrix(spark, str(tmp_path / "m.tsv")).collect()}
    assert got == {("mz_1.5", "y0x0"): 2.0, ("mz_1.5", "y0x1"): None, ("mz_1.5", "y1x0"): None, ("mz_2.5", "y0x0"): 1000.0, ("mz_2.5", "y0x1"): -1.0, ("mz_2.5", "y1x0"): None}


def test_distance_files(spark, tmp_path):
    (tmp_path / "d.tsv").write_text("a\t0\nb\t1.5\t0\nc\t2\t3\t0\n")
    got = {(r.i, r.j): r.dist for r in R.read_distances(spark, str(tmp_path / "d.tsv")).collect()}
    assert got == {("b", "a"): 1.5, ("c", "a"): 2.0, ("c", "b"): 3.0}
    lines = {r.name: r.line for r in R.triangle_lines(R.read_distances(spark, str(tmp_path / "d.tsv"))).collect()}
    assert lines == {"a": "a\t0", "b": "b\t1.5\t0", "c": "c\t2\t3\t0"}


def test_pixel_tables(spark, tmp_path):
    (tmp_path / "p.tsv").write_text("Pixel\tX\tY\ttree order\tcluster\tcluster_size\tcolor\ny0x1\t1\t0\t1\t001\t2\txFF0000\n")
    (tmp_path / "q.tsv").write_text("name\tu\tv\tgroup\ny0x1\t1\t0\t007\n")
    assert R.read_pixels(spark, str(tmp_path / "p.tsv")).first().asDict() == {"row_id": 1, "pixel_id": "y0x1", "x_coord": 1, "y_coord": 0, "hc_orig": "001", "hc_manual": "Default", "mz_manual": "Default", "color": "xFF0000"}
    assert R.read_pixels(spark, str(tmp_path / "q.tsv")).first().hc_orig == "007"
    assert R.read_pipeline_pixels(spark, str(tmp_path / "q.tsv")).first().hc_orig == "007"


def test_libraries(spark, tmp_path):
    (tmp_path / "l.tsv").write_text('# note\naccession\tname\tmono_mass\tformal_charge\tchemical_formula\tinchi\tkegg_id\tpubchem_compound_id\tCCS: [M+H]+\nH1\t"a ""b"""\t"1,180.5"\t0\tC6H12O6\tI\tK\t5\t150.5\nH2\tx\tnone\t0\t\t\t\t\t\n')
    r = R.read_library(spark, str(tmp_path / "l.tsv"), "HMDB").collect()
    assert len(r) == 1 and r[0].mass == 1180.5 and r[0].ccs == {"[M+H]+": 150.5} and r[0].mol_id == "H1"
    (tmp_path / "s.sdf").write_text("x\n> <LM_ID>\nLM1\n\n> <NAME>\nlong name / other\n\n> <SYSTEMATIC_NAME>\nshort [iso2]\n\n> <EXACT_MASS>\n10.5\n\n$$$$\n")
    s = R.read_sdf(spark, str(tmp_path / "s.sdf")).first()
    assert (s.LM_ID, s.CHOSEN_NAME, s.ISO, s.EXACT_MASS) == ("LM1", "short", "2", 10.5)
    (tmp_path / "h.xml").write_text("<hmdb><metabolite><accession>H1</accession><name>123</name><iupac_name>a &amp;lt; b</iupac_name></metabolite></hmdb>")
    assert R.read_hmdb(spark, str(tmp_path / "h.xml")).first().name == "a < b"
    (tmp_path / "c.csv").write_text('a;b\n"x;1";"say ""hi""\nthere"\n')
    assert tuple(R.read_csv(spark, str(tmp_path / "c.csv"), True, True).first()) == ("x;1", 'say "hi" there')


def test_imzml(spark, tmp_path):
    mz, it = np.array([100.0, 100.5, 101.0, 101.5, 102.0]), np.array([0.1, 9.0, 0.2, 0.1, 0.1], "<f4")
    (tmp_path / "s.ibd").write_bytes(b"\0" * 16 + mz.tobytes() + it.tobytes())
    cv = lambda a, v="": f'<cvParam accession="{a}" value="{v}"/>'
    arr = lambda kind, off: f'<binaryDataArray><referenceableParamGroupRef ref="{kind}"/>{cv("IMS:1000102", off)}{cv("IMS:1000103", 5)}</binaryDataArray>'
    (tmp_path / "s.imzML").write_text(f'<mzML xmlns="http://psi.hupo.org/ms/mzml"><referenceableParamGroup id="m">{cv("MS:1000514")}{cv("MS:1000523")}</referenceableParamGroup><referenceableParamGroup id="i">{cv("MS:1000515")}{cv("MS:1000521")}</referenceableParamGroup><spectrum>{cv("IMS:1000050", 3)}{cv("IMS:1000051", 4)}{arr("m", 16)}{arr("i", 56)}</spectrum></mzML>')
    s = R.read_imzml(spark, str(tmp_path / "s"))
    assert s.first().mz == mz.tolist()
    assert [(r.x, r.y, r.mz) for r in R.pick_peaks(s).collect()] == [(3, 4, 100.5)]
    assert [(r.feature, r.pixel_id) for r in R.align_peaks(R.pick_peaks(s)).collect()] == [("mz_100.5000", "y4x3")]


def test_registry_columns_agree(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0


def test_production_run(spark, tmp_path):
    from pixelweave.model import sales_matrix
    from pixelweave.operators.preprocess import Config
    from pixelweave.plans import production

    m = sales_matrix(spark, "/root/testdata/sf0.001")
    out = production.run(spark, m, production.Production(passes=(Config(impute="global"),), linkage="average", feature_clusters=3, pixel_clusters=4))
    assert out["feature_clusters"].count() == m.select("feature").distinct().count() == out["feature_table"].count()
    assert out["pixel_clusters"].count() == 200
    production.write(out, str(tmp_path))
    assert R.read_pipeline_pixels(spark, f"{tmp_path}/pixel_clusters").count() == 200
    assert H.from_newick(spark.read.text(f"{tmp_path}/pixel_tree").first()[0]).size == 200


def test_queries_without_sql_take_the_whole_matrix(spark):
    from pixelweave.model import sales_matrix
    from pixelweave.plans.registry import queries

    d = "/root/testdata/sf0.001"
    names = {f"f{k}" for k in range(64)}
    assert {r.leaf for r in queries()["h1_clusters"](spark, d).collect()} == names == {r.leaf for r in queries()["h11_leaf_weights"](spark, d).collect()}
    all_features = {r.feature for r in sales_matrix(spark, d).select("feature").distinct().collect()}
    assert {r.metabolite for r in queries()["t27_preferential_permuted"](spark, d).select("metabolite").collect()} == all_features
    assert queries()["h2_tree_upgma"](spark, d).count() == 127


def test_all_parts_are_annotated(spark):
    """Against all pairs by brute force: a peak is there if a molecule of right mass, of no CCS or of a near one, is."""
    from pixelweave.operators import annotate as A
    from pixelweave.plans import table_queries as Q
    from pixelweave.plans.registry import queries

    d = "/root/testdata/sf0.001"
    lib, pk = Q.library(spark, d).where("charge = 0").collect(), Q.peaks(spark, d).collect()
    assert len(pk) == spark.read.parquet(f"{d}/part.parquet").count()
    want = set()
    for p in pk:
        for m in lib:
            fits = m.ccs_db is None or abs(p.ccs - m.ccs_db) / m.ccs_db <= 0.03 + 1e-5
            if fits and any(1e6 * abs(m.mass + o - p.mz) / (m.mass + o) <= 20 + 1e-5 for o, _ in A.ADDUCTS.values()):
                want.add(p.peak)
    got = {r.peak for r in queries()["k12_annotated_peaks"](spark, d).collect()}
    assert got == want and len({k % 10 for k in got}) > 1


def test_permuted_query_shuffles_as_often_as_the_operator_does(spark):
    from pixelweave.plans.registry import queries

    p = [r.raw_p for r in queries()["t27_preferential_permuted"](spark, "/root/testdata/sf0.001").collect()]
    assert p and all(abs(x * 501 - round(x * 501)) < 1e-3 for x in p) and any(abs(x * 51 - round(x * 51)) > 1e-3 for x in p)


def plain_tree(dist, method):
    """Leaves and height of every merge by the textbook coefficients, over a dictionary of pairs."""
    square = method.endswith("2")
    d = {frozenset((frozenset([i]), frozenset([j]))): dist[i][j] ** (2 if square else 1) for i in range(len(dist)) for j in range(i)}
    groups, out = {frozenset([i]) for i in range(len(dist))}, []
    while len(groups) > 1:
        pair = min(d, key=d.get)
        a, b = pair
        low, n = d[pair], len(a) + len(b)
        kind = method.rstrip("2u")
        for c in groups - {a, b}:
            x, y, k = d[frozenset((a, c))], d[frozenset((b, c))], len(c)
            d[frozenset((a | b, c))] = {
                "upgma": (len(a) * x + len(b) * y) / n, "wpgma": (x + y) / 2, "slink": min(x, y), "clink": max(x, y), "upgmc": (len(a) * x + len(b) * y) / n - len(a) * len(b) * low / n**2, "wpgmc": (x + y) / 2 - low / 4,
                "ward": ((len(a) + k) * x + (len(b) + k) * y - k * low) / (n + k),
            }[kind]
        d = {p: v for p, v in d.items() if a not in p and b not in p}
        groups = (groups - {a, b}) | {a | b}
        out.append((a | b, (max(low, 0) ** 0.5 if square else low) / 2))
    return out


@pytest.mark.parametrize("method", H.METHODS)
def test_tree_queries_against_plain_ones(spark, method):
    """The registered query's nodes: leaves and heights by the plain version over distances of the table's own vectors."""
    import duckdb

    from pixelweave.plans.registry import queries

    d = "/root/testdata/sf0.001"
    x = np.array([r[0] for r in duckdb.sql(f"SELECT embedding FROM '{d}/embeddings.parquet'").fetchall()], float).T
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).mean(axis=2))
    want = sorted((len(g), round(h, 5)) for g, h in plain_tree(dist.tolist(), method))
    rows = queries()[f"h2_tree_{method}"](spark, d).collect()
    assert len(rows) == 2 * len(x) - 1 and sorted(r.name for r in rows if r.num_members == 1) == sorted(f"f{k}" for k in range(len(x)))
    got = sorted((r.num_members, r.avg_length) for r in rows if r.num_members > 1)
    assert [g for g, _ in got] == [g for g, _ in want] and np.allclose([h for _, h in got], [h for _, h in want], atol=2e-5)
