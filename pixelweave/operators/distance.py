"""All-pairs distances between the rows of a matrix, in blocks.

Rows become vectors over the sorted pixels (null: missing). Vectors are packed into blocks of up to MOST_ROWS rows and
MOST_BYTES; each pair of blocks is one row, computed with numpy in slices of SLICE pairs and sent on slice by slice, so no
task grows with the number of rows, a row is shuffled once a block and not once a slice, and no pair is emitted before its
distance is known. The result is the edge list (i, j, dist) with names, j < i in name order. For all pairs the blocks are
ranges of names, few and large, so that little is shuffled and a tile's columns of names are runs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import discard, written
from .selection import numbered

BLOCK = 256
MOST_ROWS, MOST_BYTES, SLICE = 4096, 1 << 24, 1 << 19
# of all pairs: rows and number of blocks, columns and pairs of a slice, pairs of a task at least
RANGE_ROWS, RANGES, COLUMNS, PAIRS, TASK_PAIRS = 16384, 12, 4096, 1 << 18, 1 << 22
# 1 + 0.5**far is 1 from here on
FAR = 54.0


@dataclass(frozen=True)
class Metric:
    """base: rmsd, euclidian, cityblock, minkowski, pearson, cosine. mix: geomean, heuristic, mostly (with trig)."""

    base: str = "rmsd"
    p: float = 2.0
    absolute: bool = False
    mix: str | None = None
    trig: str = "cosine"
    similarity: bool = False
    spatial: bool = False
    power: float = 1.0


def dense(m: DataFrame, value: Column, missing: Column) -> DataFrame:
    """feature and the array of ``value`` over the sorted pixels, ``missing`` where there is none.

    Pixels are numbered once and joined, so that a row is sorted by number and its gaps are filled: time grows with the
    row, not with its square.
    """
    order = m.select("pixel_id").distinct().agg(F.sort_array(F.collect_set("pixel_id")).alias("cols"))
    numbered = order.select(F.posexplode("cols").alias("pos", "pixel_id"))
    own = m.select("feature", "pixel_id", value.alias("value")).join(numbered, "pixel_id")
    rows = own.groupBy("feature").agg(F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("cells")).crossJoin(F.broadcast(order.select(F.size("cols").alias("n"))))
    # before each cell as many missing ones as numbers are left out, and behind the last one
    before = F.transform("cells", lambda _, k: F.when(k == 0, -1).otherwise(F.get("cells", k - 1)["pos"]))
    filled = F.zip_with("cells", before, lambda c, b: F.concat(F.array_repeat(missing, c["pos"] - b - 1), F.array(c["value"])))
    rest = F.array_repeat(missing, F.col("n") - 1 - F.element_at("cells", -1)["pos"])
    return rows.select("feature", F.concat(F.flatten(filled), rest).alias("values"))


def vectors(m: DataFrame) -> DataFrame:
    """name and values over the sorted pixels, null where missing."""
    return dense(m, F.col("intensity"), F.lit(None).cast("double")).withColumnRenamed("feature", "name")


def _moments(a, b, ma, mb, w):
    """Weighted sums over the columns that both rows have."""
    wm = w * ma
    return wm @ mb.T, (wm * a) @ mb.T, wm @ (b * mb).T, (wm * a * a) @ mb.T, wm @ (b * b * mb).T, (wm * a) @ (b * mb).T


def pearson(a, b, ma, mb, w) -> np.ndarray:
    n, sa, sb, saa, sbb, sab = _moments(a, b, ma, mb, w)
    with np.errstate(all="ignore"):
        va, vb = saa - sa * sa / n, sbb - sb * sb / n
        flat = (va <= 1e-12 * np.abs(saa)) | (vb <= 1e-12 * np.abs(sbb)) | (n == 0)
        return np.where(flat, 0.0, np.clip((sab - sa * sb / n) / np.sqrt(va * vb), -1, 1))


def cosine(a, b, ma, mb, w) -> np.ndarray:
    _, _, _, saa, sbb, sab = _moments(a, b, ma, mb, w)
    with np.errstate(all="ignore"):
        return np.where((saa <= 0) | (sbb <= 0), 0.0, np.clip(sab / np.sqrt(saa * sbb), -1, 1))


def trig_distance(r: np.ndarray, absolute: bool) -> np.ndarray:
    return np.sqrt(np.maximum(0, 1 - np.abs(r))) if absolute else np.sqrt(np.maximum(0, (1 - r) / 2))


def block_distances(a: np.ndarray, b: np.ndarray, w: np.ndarray, k: Metric) -> np.ndarray:
    """Distances of all rows of a to all rows of b (NaN: missing); NaN where no column is in both."""
    ma, mb = (~np.isnan(a)).astype(float), (~np.isnan(b)).astype(float)
    a0, b0 = np.nan_to_num(a), np.nan_to_num(b)
    total = (w * ma) @ mb.T
    sim = {"pearson": pearson, "cosine": cosine}
    with np.errstate(all="ignore"):
        if k.base in sim:
            d = trig_distance(sim[k.base](a0, b0, ma, mb, w), k.absolute)
        else:
            p = {"rmsd": 2.0, "euclidian": 2.0, "cityblock": 1.0}.get(k.base, k.p)
            if p == 2.0:
                wm = w * ma
                s = np.maximum(0, (wm * a0 * a0) @ mb.T - 2 * (wm * a0) @ (b0 * mb).T + wm @ (b0 * b0 * mb).T)
            else:
                s = np.zeros(total.shape)
                for r in range(len(a)):  # rows of one block
                    s[r] = (w * ma[r] * mb * np.abs(a0[r] - b0) ** p).sum(axis=1)
            d = np.sqrt(s * w.sum() / total) if k.base == "euclidian" else (s / total) ** (1 / p)
        if k.mix:
            r = sim[k.trig](a0, b0, ma, mb, w)
            t = trig_distance(r, k.absolute or k.mix == "heuristic")
            d = 0.001 * d + 0.999 * t if k.mix == "mostly" else np.sqrt(d * (1 + t))
        if k.similarity:
            have_a, have_b = ma.sum(axis=1)[:, None], mb.sum(axis=1)[None, :]
            d = d / np.sqrt((ma @ mb.T) / np.sqrt(have_a * have_b))
    d[total == 0] = np.nan
    return d


def whole_distances(a: np.ndarray, b: np.ndarray, w: np.ndarray, k: Metric) -> np.ndarray:
    """block_distances of rmsd or euclidian between rows without a missing cell: one product."""
    one = lambda x: np.ones((len(x), 1))
    s = np.hstack([-2 * w * a, (w * a * a).sum(axis=1)[:, None], one(a)]) @ np.hstack([b, one(b), (w * b * b).sum(axis=1)[:, None]]).T
    np.maximum(s, 0, out=s)
    return np.sqrt(s if k.base == "euclidian" else s / w.sum(), out=s)


def pairwise(v: DataFrame, k: Metric | None = None, weights: list[float] | None = None, coords: DataFrame | None = None, block: int = BLOCK, digits: int | None = None) -> DataFrame:
    """i, j, dist of all pairs of v (name, values). coords: name, x, y for spatial distances. digits: decimals that distances
    are rounded to, for a power of 1.

    Pairs without a common column get twice the largest distance.
    """
    k = k or Metric()
    tiles = _blocks(v, coords, block, ranges=True)
    out = _tiles(tiles, k, weights, digits=digits)
    # rows without a gap have all columns in common
    if (tiles._pw_gaps or weights is not None and not sum(weights)) and _tiles(tiles, k, weights, "lack").where("dist > 0").limit(1).count():
        far = _tiles(tiles, k, weights, "far").agg(F.max("dist")).first()[0]
        most = F.lit(None if far is None else 2 * far).cast("double")
        out = out.select("i", "j", F.coalesce("dist", most if digits is None else F.round(most, digits)).alias("dist"))
    return raise_distances(out, k.power)


def nearest_rows(v: DataFrame, n: int, k: Metric | None = None, block: int = BLOCK) -> DataFrame:
    """i, j, dist of the n rows j nearest to each row i, ties by name. A tile keeps n of each of its rows, so that what is
    shuffled grows with rows times tiles, not with pairs."""
    near = Window.partitionBy("i").orderBy("dist", "j")
    return _tiles(_blocks(v, None, block), k or Metric(), None, "near", n).where("dist is not null").withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= n).drop("rank")


def _blocks(v: DataFrame, coords: DataFrame | None, block: int, ranges: bool = False) -> DataFrame:
    """b, names, x, y and packed values (NaN: missing) of the blocks of rows, and the number of blocks; written, as every
    pair of blocks reads two. ranges: blocks are ranges of names, and rows without a name are left out."""
    if ranges:
        v = v.where("name is not null")
    if coords is not None:
        v = v.join(coords.select("name", F.col("x").cast("double"), F.col("y").cast("double")), "name", "left")
    else:
        v = v.select("name", "values", F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))

    def pack(batches):
        for r in batches:
            for s in range(0, r.num_rows, 1024):
                part = r.slice(s, 1024)
                values = part.column("values")
                flat = values.flatten().to_numpy(zero_copy_only=False).astype(float)
                ends = np.concatenate([[0], np.cumsum(values.value_lengths().to_numpy(zero_copy_only=False))]).astype(int)
                packed = pa.array([flat[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())
                gaps = pa.array([bool(np.isnan(flat[a:b]).any()) for a, b in zip(ends, ends[1:])], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("name").cast(pa.string()), part.column("x"), part.column("y"), packed, gaps], ["name", "x", "y", "packed", "gaps"])

    rows = written(v.select("name", "x", "y", "values").mapInArrow(pack, "name string, x double, y double, packed binary, gaps boolean"), "rows")
    n, size, gaps = rows.agg(F.count("*"), F.max(F.length("packed")), F.max("gaps")).first()
    most = max(1, min(RANGE_ROWS if ranges else MOST_ROWS, MOST_BYTES // max(8, size or 0)))
    length = max(min(block, most), min(most, math.ceil(n / (RANGES if ranges else 8))))
    parts = max(1, math.ceil(n / length))
    if ranges:
        begins = numbered(rows.select("name"), "n", "name").where((F.col("n") > 1) & ((F.col("n") - 1) % length == 0)).select("name").collect() if parts > 1 else []  # a name a block
        b = F.size(F.filter(F.array(*(F.lit(r.name) for r in begins)), lambda x: x <= F.col("name"))) if begins else F.lit(0)
    else:
        b = F.pmod(F.xxhash64("name"), F.lit(parts)).cast("int")
    own = rows.withColumn("b", b).groupBy("b").agg(F.sort_array(F.collect_list(F.struct("name", "x", "y", "packed"))).alias("rows"))
    out = written(own.withColumn("parts", F.lit(parts)), "blocks", compression="none")
    discard(rows)
    out._pw_gaps, out._pw_tasks = bool(gaps), max(1, min(parts * (parts + 1) // 2, math.ceil(n * n / 2 / TASK_PAIRS)))
    return out


def _tiles(blocks: DataFrame, k: Metric, weights: list[float] | None, what: str = "all", keep: int = 0, digits: int | None = None) -> DataFrame:
    """i, j, dist (null: no common column) of the pairs of every two blocks; or what 'near': of the keep nearest of each row
    there, 'far': the largest distance of each two, 'lack': 1 for each two with a pair without a common column."""
    pairs = F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.greatest("b", o).cast("int").alias("p"), F.least("b", o).cast("int").alias("q")))).alias("pq")
    halves = blocks.select("b", "rows", pairs)
    if what == "all":  # a tile takes long, so it has a task of its own where there are many pairs
        halves = halves.repartition(blocks._pw_tasks, "pq")
    tiles = halves.groupBy("pq").agg(F.collect_list(F.struct("b", "rows")).alias("sides"))

    def side(rows):
        f = rows.field
        names = f("name").to_pylist()
        values = np.frombuffer(b"".join(x.as_py() for x in f("packed")), float).reshape(len(names), -1)
        return np.array(names, object), values, np.stack([f("x").to_numpy(zero_copy_only=False), f("y").to_numpy(zero_copy_only=False)], axis=1).astype(float)

    def spatial(d, ca, cb):
        far = (ca[:, None, 0] - cb[None, :, 0]) ** 2 + (ca[:, None, 1] - cb[None, :, 1]) ** 2
        near = np.nonzero(far < FAR**2)  # not where coordinates are missing
        d[near] **= 1 + 0.5 ** np.sqrt(far[near])
        return d

    def distances(a, ca, b, cb, w):
        d = block_distances(a, b, w, k)
        return spatial(d, ca, cb) if k.spatial else d

    def rounded(d):
        d = d * 10.0**digits
        r = np.rint(d)
        r += d - r == 0.5  # halves away from 0, as SQL
        return r / 10.0**digits

    def batch(i, j, dist):
        return pa.RecordBatch.from_arrays([pa.array(i, pa.string()), pa.array(j, pa.string()), pa.array(dist, pa.float64(), from_pandas=True)], ["i", "j", "dist"])

    def lists(names, n, others, dist):
        ends = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
        return pa.RecordBatch.from_arrays([names, *(pa.ListArray.from_arrays(ends, x) for x in (others, pa.array(dist, pa.float64(), from_pandas=True)))], ["i", "others", "dists"])

    def tile(p, q, sides):
        if q not in sides or p not in sides:
            return
        (na, a, ca), (nb, b, cb) = sides[p], sides[q]
        w = np.ones(a.shape[1]) if weights is None else np.asarray(weights, float)
        step = max(1, SLICE // len(nb))
        if what in ("far", "lack"):
            most = -np.inf
            for s in range(0, len(na), step):
                with np.errstate(all="ignore"):
                    d = distances(a[s : s + step], ca[s : s + step], b, cb, w) if what == "far" else ((w * ~np.isnan(a[s : s + step])) @ (~np.isnan(b)).astype(float).T == 0) * 1.0
                if p == q:
                    d = d[na[s : s + step, None] != nb[None, :]]
                most = max(most, np.fmax.reduce(d, axis=None, initial=-np.inf))
            yield batch([None], [None], [most if np.isfinite(most) else None])
        elif what == "near":
            whole = k.base in ("rmsd", "euclidian") and not (k.mix or k.similarity or k.spatial or np.isnan(a).any() or np.isnan(b).any())
            for names, x, cx, others, y, cy in ((na, a, ca, nb, b, cb), *(() if p == q else ((nb, b, cb, na, a, ca),))):
                step = max(1, SLICE // len(others))
                for s in range(0, len(names), step):
                    dist = whole_distances(x[s : s + step], y, w, k) if whole else distances(x[s : s + step], cx[s : s + step], y, cy, w)
                    if p == q:  # a name is in one block only
                        own = np.arange(len(dist))
                        dist[own, s + own] = np.nan
                    if keep < dist.shape[1]:
                        most = np.partition(dist, keep - 1, axis=1)[:, keep - 1]
                        row, at = np.nonzero(dist <= np.where(np.isnan(most), np.inf, most)[:, None])
                    else:
                        row, at = np.nonzero(~np.isnan(dist))
                    order = np.lexsort((at, dist[row, at], row))  # others are in order of name
                    row, at = row[order], at[order]
                    first = np.arange(len(row)) - np.searchsorted(row, row) < keep
                    row, at = row[first], at[first]
                    yield batch(names[s + row], others[at], dist[row, at])
        else:
            whole = k.base in ("rmsd", "euclidian") and not (k.mix or k.similarity or np.isnan(a).any() or np.isnan(b).any())
            left, right = product(a, b, w) if whole and w.sum() else (None, None)
            names = pa.array(na, pa.string())
            for c in range(0, len(nb), COLUMNS):
                others, cols = pa.array(nb[c : c + COLUMNS], pa.string()), slice(c, c + COLUMNS)
                step = max(1, min(PAIRS, SLICE) // len(others))
                every = others.take(pa.array(np.tile(np.arange(len(others)), min(step, len(na)))))
                for s in range(c if p == q else 0, len(na), step):
                    own = slice(s, s + step)
                    with np.errstate(all="ignore"):
                        if left is None:
                            d = distances(a[own], ca[own], b[cols], cb[cols], w)
                        else:
                            d = left[own] @ right[:, cols]
                            np.sqrt(np.maximum(d, 0, out=d), out=d)
                            d = spatial(d, ca[own], cb[cols]) if k.spatial else d
                        d = d if digits is None else rounded(d)
                    if p == q and s < c + len(others):
                        before = np.arange(s, s + len(d))[:, None] > np.arange(c, c + len(others))[None]
                        yield lists(names[own], before.sum(axis=1), others.take(pa.array(np.nonzero(before)[1])), d[before])
                    else:
                        yield lists(names[own], np.full(len(d), len(others)), every.slice(0, d.size), d.ravel())

    def product(a, b, w):
        one = lambda x: np.ones((len(x), 1))
        by = w if k.base == "euclidian" else w / w.sum()
        return np.hstack([-2 * by * a, (by * a * a).sum(axis=1)[:, None], one(a)]), np.hstack([b, one(b), (by * b * b).sum(axis=1)[:, None]]).T.copy()

    def run(batches):
        for r in batches:
            for n in range(r.num_rows):
                pq, found = r.column("pq")[n].as_py(), r.column("sides")[n].values
                own = {found.field("b")[m].as_py(): side(found.field("rows")[m].values) for m in range(len(found))}
                yield from tile(pq["p"], pq["q"], own)

    if what == "all":  # a row for each i of a slice, as a list costs less than its elements one by one
        found = tiles.mapInArrow(run, "i string, others array<string>, dists array<double>")
        return found.select("i", "others", F.posexplode("dists").alias("at", "dist")).select("i", F.get("others", F.col("at")).alias("j"), "dist")
    return tiles.mapInArrow(run, "i string, j string, dist double")


def raise_distances(d: DataFrame, power: float) -> DataFrame:
    return d if power in (0.0, 1.0) else d.withColumn("dist", F.pow("dist", F.lit(power)))


def file_weights(counts: list[int]) -> list[float]:
    """Column weights that give files of different widths equal weight: largest width over own width, per column."""
    return [max(counts) / n for n in counts for _ in range(n)]
