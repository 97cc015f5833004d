"""Operators that deal rows by ranges, send bounded tables to every task or have two ways, against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixelweave import shared
from pixelweave.operators import annotate as A
from pixelweave.operators import distance as D
from pixelweave.operators import selection as S
from pixelweave.operators import statistics as T
from pixelweave.operators import tree as H
from pixelweave.sources import tables as R


def cells(spark, rows):
    return spark.createDataFrame(rows, "feature string, pixel_id string, intensity double")


def sparse(spark, seed=1, features=7, pixels=30, share=0.6):
    rnd = random.Random(seed)
    rows = [(f"f{i}", f"p{j:02d}", rnd.choice([rnd.random() * 9, 1.0])) for i in range(features) for j in range(pixels) if rnd.random() < share]
    return cells(spark, rows), rows


def grid(spark, wide=9, high=7, seed=2):
    rnd = random.Random(seed)
    rows = [(f"p{x}_{y}", x, y, rnd.choice(["a", "a", "b", "c"])) for x in range(wide) for y in range(high) if rnd.random() < 0.9]
    return spark.createDataFrame(rows, "pixel_id string, x_coord int, y_coord int, hc_manual string"), rows


def test_vectors_have_gaps_where_cells_are_missing(spark):
    m, rows = sparse(spark)
    pixels = sorted({r[1] for r in rows})
    got = {r.name: list(r["values"]) for r in D.vectors(m.repartition(5)).collect()}
    have = {(a, b): v for a, b, v in rows}
    assert got == {f: [have.get((f, p)) for p in pixels] for f in {r[0] for r in rows}}


def test_numbers_over_ranges(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 50), k) for k in range(500)]
    got = S.numbered(spark.createDataFrame(rows, "a int, k int").repartition(7), "n", F.desc("a"), "k").collect()
    assert [(r.a, r.k) for r in sorted(got, key=lambda r: r.n)] == sorted(rows, key=lambda r: (-r[0], r[1]))
    assert sorted(r.n for r in got) == list(range(1, 501))


def test_adjusted_p_over_ranges(spark):
    rnd = random.Random(4)
    p = [rnd.choice([None, round(rnd.random(), 2), 0.5]) for _ in range(300)]
    got = {r.k: r.adj_p_value for r in T.adjust_bh(spark.createDataFrame(list(enumerate(p)), "k int, p_value double").repartition(6)).collect()}
    some = [x for x in p if x is not None]
    for k, x in enumerate(p):
        if x is None:
            assert got[k] is None
        else:
            assert got[k] == pytest.approx(min(1.0, min(y * len(some) / sum(z <= y for z in some) for y in some if y >= x)))
    assert T.adjust_bh(spark.createDataFrame([], "k int, p_value double")).count() == 0


def test_moran_both_ways(spark, monkeypatch):
    m, rows = sparse(spark, features=5)
    p = sorted({r[1] for r in rows})
    rnd = random.Random(5)
    edges = spark.createDataFrame([(a, b, rnd.random()) for a in p for b in rnd.sample(p, 4) if a != b], "i string, j string, w double")
    first = {r.feature: (r.moran_i, r.geary_c) for r in T.moran_geary(m, edges).collect()}
    monkeypatch.setattr(T, "MOST_EDGES", 0)
    second = {r.feature: (r.moran_i, r.geary_c) for r in T.moran_geary(m, edges).collect()}
    assert first.keys() == second.keys() == {r[0] for r in rows}
    for f in first:
        assert first[f] == pytest.approx(second[f])


def test_gradient_reference_both_ways(spark, monkeypatch):
    for seed in (1, 2, 3):
        p, _ = grid(spark, seed=seed)
        for least in (1, 4, 9):
            monkeypatch.setattr(T, "MOST_CELLS", 1 << 22)
            first = sorted(r.pixel_id for r in T.gradient_reference(p, "a", least).collect())
            monkeypatch.setattr(T, "MOST_CELLS", 0)
            assert first == sorted(r.pixel_id for r in T.gradient_reference(p, "a", least).collect())
    assert T.gradient_reference(p, "none").count() == 0


def test_distances_to_a_domain(spark, monkeypatch):
    p, rows = grid(spark)
    inside = [(x, y) for _, x, y, c in rows if c == "b"]
    want = {n: [math.dist((x, y), q) for q in inside] for n, x, y, c in rows if c != "b"}
    for most in (1_000_000, 0):
        monkeypatch.setattr(A, "MOST_INSIDE", most)
        got = {r.pixel_id: r.dist for r in A.distance_to_domain(p, "b").collect()}
        assert got == pytest.approx({n: sum(d) / len(d) for n, d in want.items()})
    got = {r.pixel_id: r.dist for r in A.distance_to_domain(p, "b", "min").collect()}
    assert got == pytest.approx({n: min(d) for n, d in want.items()})


def test_shuffles_are_the_same_for_every_feature(spark):
    """Two features of equal values, one of them with a gap more, and a plain count of the hits."""
    p, rows = grid(spark, 6, 5)
    rnd = random.Random(6)
    value = {r[0]: rnd.random() * 10 for r in rows}
    names = sorted(value)
    m = cells(spark, [(f, n, value[n]) for f in ("f1", "f2") for n in names] + [("f3", n, value[n]) for n in names[1:]])
    got = {(r.metabolite, r.domain): r for r in T.preferential_permuted(m, p, 40).collect()}
    label = {r[0]: r[3] for r in rows}
    hashes = {r.n: np.uint64(r.h & (1 << 64) - 1) for r in spark.createDataFrame([(n,) for n in names], "n string").select("n", F.xxhash64("n").alias("h")).collect()}
    h = np.array([hashes[n] for n in names], np.uint64)
    for f, have in (("f1", names), ("f3", names[1:])):
        for g in set(label.values()):
            def fold(lab):
                a, b = [value[n] for n in have if lab[n] == g], [value[n] for n in have if lab[n] != g]
                return math.log2((np.median(a) + 1e-6) / (np.median(b) + 1e-6)) if min(len(a), len(b)) >= 2 else -math.inf

            hits = 0
            for r in range(40):
                with np.errstate(over="ignore"):
                    x = (h ^ np.uint64(r + 1)) * np.uint64(0x9E3779B97F4A7C15)
                    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                order = np.argsort(x ^ (x >> np.uint64(32)), kind="stable")
                hits += fold({n: label[names[k]] for n, k in zip(names, order, strict=True)}) >= fold(label) - 1e-12
            assert got[f, g].log2fc == pytest.approx(fold(label)) and got[f, g].raw_p == pytest.approx((hits + 1) / 41)
    assert all(got["f1", g].raw_p == got["f2", g].raw_p for g in set(label.values()))


def test_g_curves_against_all_pairs(spark):
    p, rows = grid(spark, 12, 9)
    radii = [0.0, 1.0, 1.5, 2.0]
    got = {(r.label, r.r): r for r in T.g_curves(p, radii, 2).collect()}
    for g in {r[3] for r in rows}:
        own = [(x, y) for _, x, y, c in rows if c == g]
        if len(own) < 10:
            continue
        box = [f(q[k] for q in own) for k in (0, 1) for f in (min, max)]
        near = [min(math.dist(a, b) for b in own if b != a) for a in own]
        edge = [min(x - box[0], box[1] - x, y - box[2], box[3] - y) for x, y in own]
        for r in radii[1:]:
            inside = [d for d, e in zip(near, edge, strict=True) if e >= r]
            assert got[g, r].observed == pytest.approx(sum(d <= r for d in inside) / len(inside)) if inside else got[g, r].observed is None
            assert got[g, r].permed is None or 0 <= got[g, r].permed <= 1


def test_nearest_rows_are_those_of_all_pairs(spark):
    rng = np.random.default_rng(7)
    v = spark.createDataFrame([(f"r{k:02d}", [float(x) for x in rng.integers(0, 4, 5)]) for k in range(60)], "name string, values array<double>")
    both = {}
    for r in D.pairwise(v, block=16).collect():
        both.setdefault(r.i, []).append((round(r.dist, 9), r.j))
        both.setdefault(r.j, []).append((round(r.dist, 9), r.i))
    got = {}
    for r in D.nearest_rows(v, 4, block=16).collect():
        got.setdefault(r.i, []).append((round(r.dist, 9), r.j))
    assert {k: sorted(x) for k, x in got.items()} == {k: sorted(x)[:4] for k, x in both.items()}


def test_layouts(spark):
    names = [f"n{k}" for k in range(6)]
    nodes = spark.createDataFrame([(n,) for n in names], "feature string")
    path = spark.createDataFrame(list(zip(names, names[1:])), "a string, b string")
    at = {r.feature: (r.x, r.y) for r in T.force_layout(nodes, path, "kk").collect()}
    for i in range(6):  # on a path springs can all have their length
        for j in range(i):
            assert math.dist(at[names[i]], at[names[j]]) == pytest.approx(i - j, rel=0.25)
    at = {r.feature: (r.x, r.y) for r in T.force_layout(nodes, path).collect()}
    linked = [math.dist(at[a], at[b]) for a, b in zip(names, names[1:])]
    others = [math.dist(at[names[i]], at[names[j]]) for i in range(6) for j in range(i - 1)]
    assert np.mean(linked) < np.mean(others)


def test_umap_options(spark):
    a, b = T.layout_curve(0.1)
    assert (a, b) == pytest.approx((1.577, 0.895), rel=0.03)  # published for spread 1 and min_dist 0.1
    rng = np.random.default_rng(8)
    m = cells(spark, [(f"f{d}", f"p{k:02d}", float(rng.normal(8 * (k % 2), 1))) for k in range(40) for d in range(4)])
    got = {r.pixel_id: r for r in T.umap_layout(m, neighbours=6, n_components=3).collect()}
    assert len(got) == 40 and set(got["p00"].asDict()) == {"pixel_id", "umap1", "umap2", "umap3"}
    x = np.array([[r.umap1, r.umap2, r.umap3] for _, r in sorted(got.items())])
    far = lambda i, j: np.sqrt(((x[i::2, None] - x[None, j::2]) ** 2).sum(axis=2)).mean()
    assert far(0, 0) < far(0, 1) and far(1, 1) < far(0, 1)


def test_second_peak_pass_fills_gaps(spark):
    wave = lambda top: [0.0, 1.0, top, 1.0, 0.0, 0.5, 0.0]
    mz = [100.0 + 0.01 * k for k in range(7)]
    spectra = spark.createDataFrame([(0, 0, mz, wave(9.0)), (1, 0, mz, wave(1.2)), (2, 0, [200.0], [5.0])], "x int, y int, mz array<double>, intensity array<double>")
    assert {(r.x, round(r.mz, 2)) for r in R.pick_peaks(spectra, 10).collect()} == {(0, 100.02)}
    got = {r.pixel_id: (r.feature, r.intensity) for r in R.peak_process(spectra, 10, 10.0).collect()}
    assert got == {"y0x0": ("mz_100.0200", 9.0), "y0x1": ("mz_100.0200", 1.2)}


def test_reference_peaks_are_not_split_at_borders(spark):
    width = 10e-6
    border = math.exp(math.floor(math.log(500) / width) * width)
    peaks = spark.createDataFrame([(border * (1 + d),) for d in (-3e-6, -1e-6, 1e-6, 3e-6, 4e-5)], "mz double")
    got = sorted(r.center for r in R.reference_peaks(peaks).collect())
    assert got == pytest.approx([border, border * (1 + 4e-5)], rel=1e-7)


def test_every_peak_stays_in_an_annotated_table(spark):
    lib = spark.createDataFrame([("m1", "HMDB", 100.0, 0, "C", "one", "i1", "", "", "", 150.0), ("m2", "LMAPS", 100.0, 0, "C", "two", "i2", "K", "", "", None)], "mol_id string, source string, mass double, charge int, formula string, name string, inchi string, kegg string, cid string, hmdb string, ccs_db double")
    table = spark.createDataFrame([(1, 100.0 + A.PROTON, 150.0, "x"), (2, 300.0, 150.0, "y")], "peak int, mz double, ccs double, extra string")
    hits = A.band_join(table, A.with_adducts(lib)).withColumn("ppm", A.ppm(F.col("mz"), F.col("mz_db"))).withColumn("has_ccs", F.col("ccs_db").isNotNull())
    got = A.annotated_peaks(table, A.escalate(hits, ["peak"]), ["peak"])
    assert got.columns == [*A.ANNOTATED, "peak", "mz", "ccs (own)", "extra"]
    rows = {r.peak: r for r in got.collect()}
    assert (rows[1]["Name"], rows[1]["Number of matches"], rows[1]["CCS matched"]) == ("one", 1, True)
    assert rows[2]["Number of matches"] == 0 and rows[2]["Name"] is None and rows[2].extra == "y"


def test_random_ties_and_all_equal_distances():
    names = [f"l{k}" for k in range(12)]
    d = np.ones((12, 12)) - np.eye(12)
    trees = {H.to_newick(H.build_tree(names, d, ties="random", seed=s)) for s in range(4)}
    assert len(trees) > 1
    assert all(sorted(x.name for x in H.build_tree(names, d, ties=t).leaves()) == sorted(names) for t in ("fewest", "order", "random"))


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        applicationId, master = "app", "spark://somewhere:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_dir(Session())


def test_spectra_by_ranges_and_whole(spark, tmp_path, monkeypatch):
    from pixelweave.sources import imzml

    rnd = random.Random(9)
    rows = [(k % 7, k // 7, sorted(rnd.random() for _ in range(k % 5)), [rnd.random() for _ in range(k % 5)]) for k in range(40)]
    imzml.write_files(str(tmp_path / "s"), rows)
    monkeypatch.setattr(imzml, "SPECTRA", 9)
    assert len(imzml.Reader(str(tmp_path / "s")).partitions()) == 5
    first = sorted(tuple(r) for r in R.read_imzml(spark, str(tmp_path / "s")).collect())
    monkeypatch.setattr(imzml, "is_file", lambda path: False)
    second = sorted(tuple(r) for r in R.read_imzml(spark, str(tmp_path / "s")).collect())
    assert first == second == sorted(rows)


def test_components_and_ellipses_against_numpy(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(40, 5)) @ rng.normal(size=(5, 5))
    m = cells(spark, [(f"f{d}", f"p{k:02d}", float(x[k, d])) for k in range(40) for d in range(5)])
    scores, parts = T.pca(m, 3)
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    val, vec = np.linalg.eigh(z.T @ z / 39)
    val, vec = val[::-1], vec[:, ::-1]
    vec = vec * np.sign(vec[np.abs(vec).argmax(axis=0), np.arange(5)])
    got = {(r.pixel_id, r.component): r.score for r in scores.collect()}
    for k in range(3):
        want = z @ vec[:, k]
        assert np.allclose([got[f"p{i:02d}", k + 1] for i in range(40)], want, atol=1e-8)
    rows = sorted(parts.collect(), key=lambda r: r.component)
    assert np.allclose([r.sd for r in rows], np.sqrt(val[:3]), atol=1e-8)
    p = spark.createDataFrame([(f"p{k:02d}", "ab"[k % 2]) for k in range(40)], "pixel_id string, hc_manual string")
    for r in T.ellipses(scores, p).collect():
        own = np.array([[got[f"p{i:02d}", c] for c in (1, 2)] for i in range(40) if "ab"[i % 2] == r.label])
        cov = np.cov(own.T)
        assert np.allclose([r.ma, r.mb, r.va, r.vb, r.cab], [*own.mean(axis=0), cov[0, 0], cov[1, 1], cov[0, 1]])


def test_curve_components_against_numpy(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(6, 4))
    curves = spark.createDataFrame([(f"l{i}", float(j), float(x[i, j])) for i in range(6) for j in range(4)], "label string, r double, fundiff double")
    scores, parts = T.curve_components(curves, 1.0)
    c = x - x.mean(axis=0)
    val = np.linalg.svd(c, compute_uv=False) ** 2
    assert np.allclose([r.share for r in sorted(parts.collect(), key=lambda r: r.component)], val / val.sum())
    got = np.zeros((6, 4))
    for r in scores.collect():
        got[int(r.label[1]), r.component - 1] = r.score
    assert np.allclose(got @ got.T, c @ c.T)  # the scores keep all distances


def test_leaf_weights_of_random_trees():
    """Each edge is shared among the leaves below in proportion to what they have; the sum of weights is bounded by the leaves."""
    rng = np.random.default_rng(12)
    for _ in range(5):
        x = rng.normal(size=(9, 3))
        root = H.build_tree([f"l{k}" for k in range(9)], np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)))
        w, n = H.gsc_weights(root)

        def share(node):
            if node.leaf:
                return {node.name: 0.0}
            out = {}
            for c in node.children:
                below = share(c)
                total = sum(below.values())
                out |= {k: v + c.edge * (v / total if total else 1 / len(below)) for k, v in below.items()}
            return out

        own = share(root)
        scale = max(own.values()) / max(w.values())
        assert w.keys() == own.keys() and all(v / scale == pytest.approx(w[k], rel=1e-6) for k, v in own.items())
        assert n == pytest.approx(sum(w.values())) and 1 < n <= 9
