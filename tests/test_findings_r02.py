"""Cases of the findings of round 2, against the SQL or plain versions."""

import math

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from pixelweave.operators import annotate as A
from pixelweave.operators import distance as D
from pixelweave.operators import statistics as T
from pixelweave.plans.registry import oracle_sql, queries


def same(a, b):
    return a == b or isinstance(a, float) and isinstance(b, float) and (math.isnan(a) and math.isnan(b) or math.isclose(a, b, abs_tol=2e-6))


def rows_by_sql(name, folder, *tables):
    c = duckdb.connect()
    for t in tables:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return c.execute(oracle_sql()[name]).fetchall()


def test_summary_of_a_network_without_nodes(spark, tmp_path):
    """Dimensions without any correlation: a mean over no nodes is NaN and a sign of no edges null, as in SQL."""
    h = np.ones((1, 1))
    while len(h) < 128:
        h = np.block([[h, h], [h, -h]])
    e = h[:, 1:65].astype(np.float32)
    pq.write_table(pa.table({"vec_id": np.arange(128), "embedding": pa.array(e.tolist(), pa.list_(pa.float32())), "label": pa.array([0] * 128, pa.int32())}), tmp_path / "embeddings.parquet")
    (want,) = rows_by_sql("a20_network_summary", tmp_path, "embeddings")
    (got,) = queries()["a20_network_summary"](spark, str(tmp_path)).collect()
    assert want[:2] == (0, 0) and all(same(a, b) for a, b in zip(got, want, strict=True)), (got, want)


def molecules(spark, n=400, seed=5):
    """Peaks and molecules on a coarse grid of masses, so that many are equal, some sources and names missing."""
    rnd = np.random.default_rng(seed)
    pick = lambda *of: of[rnd.integers(len(of))]
    mass = lambda: 300.0 + float(rnd.integers(12)) * 0.002
    lib = [(f"m{k}", pick("HMDB", "LMAPS", "other", None), mass(), pick("C6", None), pick("x", "y z", "zz", None), pick("I1", "I2", "", None), pick("K1", None), None, f"H{k}", pick(None, 150.0, 170.0)) for k in range(n)]
    pk = [(k, mass() * (1 + float(rnd.integers(-30, 30)) * 1e-6) + A.PROTON, pick(150.0, 160.0, None)) for k in range(60)] + [(99, None, 150.0)]
    library = spark.createDataFrame(lib, "mol_id string, source string, mass double, formula string, name string, inchi string, kegg string, cid string, hmdb string, ccs_db double")
    return spark.createDataFrame(pk, "peak int, mz double, ccs double"), A.with_adducts(library).withColumn("has_ccs", F.col("ccs_db").isNotNull())


def test_escalated_is_escalation_of_all_hits(spark):
    peaks, lib = molecules(spark)
    hits = A.band_join(peaks, lib).withColumn("ppm", A.ppm(F.col("mz"), F.col("mz_db")))
    key = lambda df: sorted((r.peak, r.mol_id, r.adduct, r.tolerance, r.ccs_matched, round(r.ppm, 9)) for r in df.collect())
    want = key(A.escalate(hits, ["peak"]))
    assert len(want) > 500 and key(A.escalated(peaks, lib, ["peak"])) == want


def test_annotated_table_is_annotation_of_all_hits(spark):
    peaks, lib = molecules(spark)
    hits = A.band_join(peaks, lib).withColumn("ppm", A.ppm(F.col("mz"), F.col("mz_db")))
    key = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
    want = key(A.annotated_peaks(peaks, A.escalate(hits, ["peak"]), ["peak"]))
    assert len(want) == 61 and key(A.annotated_table(peaks, lib, ["peak"])) == want


def test_first_source_by_sets(spark):
    """Sets give each peak what its own hits give, hits without a source stay, and hits of one peak meet once."""
    peaks, lib = molecules(spark)
    hits = A.escalated(peaks, lib, ["peak"]).select("peak", "mol_id", "adduct", "source", "inchi", "kegg").collect()
    known = {(r.peak, c, r[c]) for r in hits for c in ("inchi", "kegg") if r.source == "HMDB" and r[c]}
    want = sorted((r.peak, r.mol_id, r.adduct) for r in hits if r.source != "LMAPS" or not any((r.peak, c, r[c]) in known for c in ("inchi", "kegg")))
    own, members = A.candidate_sets(peaks, lib, ["peak"])
    kept = own.join(A.prefer_first_source(members, ["pw_set"], "HMDB", "LMAPS", ["inchi", "kegg"]), "pw_set")
    assert sorted((r.peak, r.mol_id, r.adduct) for r in kept.collect()) == want and len(want) < len(hits)


def test_band_join_never_sends_the_library(spark):
    """At 60 times sf0.1 the library is estimated small and is not."""
    peaks, lib = molecules(spark)
    joined = A.band_join(peaks, lib)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    wide = spark.range(2000).select(F.col("id").alias("peak"), (900 + F.col("id") / 1000).alias("mz"))
    other = wide.select(F.col("peak").alias("mol"), F.col("mz").alias("mz_db"))
    for how, tolerance in (("ppm", 20), ("abs", 0.01)):
        got = A.band_join(wide, other, tolerance, how)
        x = 900 + np.arange(2000) / 1000
        near = np.abs(x[:, None] - x[None]) <= tolerance if how == "abs" else 1e6 * np.abs(x[None] - x[:, None]) / x[None] <= tolerance + 1e-5
        assert got.count() == near.sum()


def gappy(n, width, seed):
    """Rows with gaps; the first three share no column with the rest."""
    x = np.random.default_rng(seed).normal(5, 2, (n, width))
    x[np.random.default_rng(seed + 1).random((n, width)) < 0.3] = np.nan
    x[:3, width // 2 :], x[3:, : width // 2] = np.nan, np.nan
    x[:, 0], x[:, -1] = np.where(np.arange(n) < 3, 1.0, np.nan), np.where(np.arange(n) < 3, np.nan, 2.0)
    return x


def test_distances_by_packed_blocks_and_slices(spark, monkeypatch):
    """Blocks and slices smaller than the rows, with weights, coordinates and pairs without a common column."""
    monkeypatch.setattr(D, "SLICE", 64)
    n, width = 41, 10
    x, w = gappy(n, width, 7), [1.0 + k % 3 for k in range(width)]
    v = spark.createDataFrame([(f"r{k:02d}", [None if np.isnan(a) else float(a) for a in r]) for k, r in enumerate(x)], "name string, values array<double>")
    at = spark.createDataFrame([(f"r{k:02d}", float(k % 5), float(k // 5)) for k in range(n)], "name string, x double, y double")
    for spatial in (False, True):
        d = D.block_distances(x, x, np.array(w), D.Metric())
        if spatial:
            c = np.array([[k % 5, k // 5] for k in range(n)], float)
            d = d ** (1 + 0.5 ** np.sqrt(((c[:, None] - c[None]) ** 2).sum(axis=2)))
        d = np.where(np.isnan(d), 2 * np.nanmax(d), d)
        got = {(r.i, r.j): r.dist for r in D.pairwise(v, D.Metric(spatial=spatial), weights=w, coords=at if spatial else None, block=6).collect()}
        assert len(got) == n * (n - 1) // 2
        assert all(math.isclose(got[f"r{i:02d}", f"r{j:02d}"], d[i, j], rel_tol=1e-9, abs_tol=1e-7) for i in range(n) for j in range(i))
    d = D.block_distances(x, x, np.ones(width), D.Metric())
    np.fill_diagonal(d, np.nan)
    want = {(f"r{i:02d}", f"r{j:02d}") for i in range(n) for j in np.argsort(d[i], kind="stable")[:4] if not np.isnan(d[i, j])}
    assert {(r.i, r.j) for r in D.nearest_rows(v, 4, block=6).collect()} == want


def test_rows_are_dealt_in_few_blocks(spark):
    """A row goes into as many tiles as there are blocks: 8 or so here, and not a thirtieth of the rows as by block=24."""
    v = spark.createDataFrame([(f"r{k}", [float(k), 1.0]) for k in range(800)], "name string, values array<double>")
    assert D._blocks(v, None, 24).first().parts <= 9


def test_curves_send_no_table_of_pixels(spark):
    p = spark.createDataFrame([(f"p{k}", k % 9, k // 9, "ab"[k % 2]) for k in range(90)], "pixel_id string, x_coord int, y_coord int, hc_manual string")
    g = T.g_function(p, [0.0, 1.0, 2.0])
    plan = g._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert {r.label for r in g.collect()} == {"a", "b"}


def test_layout_in_jobs_is_that_of_the_driver(spark, monkeypatch):
    """More pixels than the driver takes are laid out too, in chunks of few edges: copies have the edges of all."""
    rng = np.random.default_rng(3)
    x = np.concatenate([np.ones((20, 4)), rng.normal(0, 3, (30, 4))])
    m = spark.createDataFrame([(f"f{d}", f"p{k:02d}", float(x[k, d])) for k in range(50) for d in range(4)], "feature string, pixel_id string, intensity double")
    m = m.unionByName(spark.createDataFrame([("f0", "alone", None)], m.schema))
    got = {}
    for most in (1000, 10):
        got[most] = {r.pixel_id: (r.umap1, r.umap2) for r in T.umap_layout(m, neighbours=5, rounds=8, most=most).collect()}
        monkeypatch.setattr(T, "CHUNK", 16)
    assert len(got[10]) == 51 and "alone" in got[10]
    assert all(math.isclose(a, b, abs_tol=1e-6) for k in got[10] for a, b in zip(got[10][k], got[1000][k], strict=True))


def test_moves_of_a_chunk(spark):
    """Pulls along each edge from both ends, pushes only at ends with a slot, whatever the chunks."""
    rng = np.random.default_rng(4)
    y, a, b = rng.normal(0, 2, (30, 2)), 1.577, 0.895
    i, j, w = np.repeat(np.arange(30), 3), rng.integers(0, 30, 90), rng.random(90)
    want = np.zeros((30, 2))
    for s, t, u in zip(i, j, w, strict=True):
        q = max(((y[s] - y[t]) ** 2).sum(), 1e-12)
        pull = np.clip(-2 * a * b * q ** (b - 1) * (y[s] - y[t]) / (1 + a * q**b) * u, -4, 4)
        want[s] += pull
        want[t] -= pull
    x, other, weight = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([w, w])

    def total(slot, size):
        order, out = np.argsort(x, kind="stable"), np.zeros((30, 2), np.int64)
        for s in range(0, len(x), size):
            k = order[s : s + size]
            lo, sums = T._chunk_moves(y, x[k], other[k], slot[k], weight[k], a, b, 5)
            out[lo : lo + len(sums)] += sums
        return out

    none, slots = np.full(180, -1), np.concatenate([np.tile(np.arange(3), 30), np.full(90, -1)])
    assert np.allclose(total(none, 180) / T.POINT, want, atol=1e-7)
    assert (total(slots, 180) == total(slots, 7)).all() and (total(slots, 180) != total(none, 180)).any(axis=1).all()
