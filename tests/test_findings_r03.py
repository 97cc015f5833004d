"""Cases of the findings of round 3, against the SQL or plain versions."""

import math

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from pixelweave.operators import distance as D
from pixelweave.plans.registry import oracle_sql, queries


@pytest.fixture
def vectors(tmp_path):
    """Vectors with copies, so that distances of 0 and pairs on all sides of the names' order occur."""
    e = np.random.default_rng(3).normal(0, 0.2, (130, 64)).astype(np.float32)
    e[100:] = e[:30]
    pq.write_table(pa.table({"vec_id": np.arange(130) * 7, "embedding": pa.array(e.tolist(), pa.list_(pa.float32())), "label": pa.array([0] * 130, pa.int32())}), tmp_path / "embeddings.parquet")
    return str(tmp_path)


def passes(monkeypatch):
    """What the passes over the tiles look for, and how many blocks and rows of blocks each deals out."""
    seen, tiles = [], D._tiles

    def counted(blocks, k, weights, what="all", *a, **b):
        parts = blocks.first().parts
        seen.append((what, parts, sum(len(r.rows) for r in blocks.collect()) * parts))
        return tiles(blocks, k, weights, what, *a, **b)

    monkeypatch.setattr(D, "_tiles", counted)
    return seen


def by_sql(name, folder):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    return {(i, j): d for i, j, d in c.execute(oracle_sql()[name]).fetchall()}


@pytest.mark.parametrize("name", ["x12_spatial", "x15_weighted"])
def test_rows_without_gaps_are_dealt_once(spark, monkeypatch, vectors, name):
    """Blocks are dealt to tiles once, not a second time to look for pairs without a common column; slices smaller than blocks
    give what SQL gives, rounded as there."""
    for n, v in (("COLUMNS", 16), ("PAIRS", 64), ("TASK_PAIRS", 500)):
        monkeypatch.setattr(D, n, v, raising=False)
    seen = passes(monkeypatch)
    rows = queries()[name](spark, vectors).collect()
    got, want = {(r.i, r.j): r.dist for r in rows}, by_sql(name, vectors)
    assert [what for what, *_ in seen] == ["all"]
    assert len(rows) == 130 * 129 // 2 and got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], abs_tol=1.1e-6) for k in want) and sum(got[k] == want[k] for k in want) > 0.999 * len(want)


def test_large_blocks_for_all_pairs(spark):
    """100,000 rows go into 12 blocks at most, and not 25 of 4,096 rows, so that each is shuffled 12 times."""
    v = spark.range(100_000).selectExpr("concat('r', id) AS name", "array(double(id), 1d) AS values")
    b = D._blocks(v, None, 50, ranges=True)
    blocks = sorted((r.b, r.rows[0].name, r.rows[-1].name, len(r.rows)) for r in b.collect())
    assert len(blocks) == blocks[0][0] + b.first().parts <= 12 and sum(x[3] for x in blocks) == 100_000 and not b._pw_gaps
    assert all(x[2] < y[1] for x, y in zip(blocks, blocks[1:])) and max(x[3] for x in blocks) <= D.RANGE_ROWS


def test_rounded_halves_and_missing_pairs(spark):
    """digits round distances and what stands for pairs without a common column; a row without a name has no pairs."""
    rows = [("a", [1.0, None]), ("b", [None, 2.0]), ("c", [4.00000049, 2.0]), (None, [1.0, 1.0])]
    v = spark.createDataFrame(rows, "name string, values array<double>")
    assert {(r.i, r.j): r.dist for r in D.pairwise(v, block=1, digits=6).collect()} == {("c", "a"): 3.0, ("c", "b"): 0.0, ("b", "a"): 6.000001}
