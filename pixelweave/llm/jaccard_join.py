"""N-gram Jaccard join by prefix trees, exact up to collisions of 64-bit hashes.

1. Shingles are counted over all documents; the logarithm of each repeated shingle's count goes to a table of bounded
   size. Shingles are ordered globally by (that level, hash), rare ones first.
2. Sets with Jaccard >= t share a shingle among the first n - ceil(t n) + 1 of the larger and the first
   n - ceil(2 t / (1 + t) n) + 1 of the smaller one. Sets are gathered by these shingles. Of a shingle of a few sets
   each pair near enough in size is a candidate, which stays one only if the parities of its sets' shingles in hash
   slots (sketches, a bit a shingle) allow the overlap; of one of many sets all are tied to its first.
   Components of the candidates bound the work.
3. Within a component sets go into a trie, ordered by how many of its sets hold a shingle. A set walks the trie once,
   subtrees sharing the overlap of their common path; a subtree is left as soon as the overlap plus what remains can't
   reach the threshold, or if all its sets are linked with the walking one already.
4. Components above TRIE_SETS sets or TRIE_ITEMS shingles are cut into blocks by set size. Each block is a trie; then a
   few sets of each block's large groups are joined with those of other blocks; then only pairs of blocks near enough in
   size that hold different groups are left, each of which is a trie.

The plan is the same at every size: nothing is broadcast but tables of bounded size (levels, bitmaps of digests).
Equal sets are one class from the start, named by two digests of 64 bits; copies are never paired.

Null, empty and white-space texts have an empty set and stay alone. Rows with equal doc_id are rows of their own with
one set each; a null doc_id never names a component unless all its members are null. Texts of any length are taken
whole. Extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import apart, apply_groups, arrow_batch, bitmap, discard, filter_bits, id_text, map_batches, marked, slices, written
from .components import components
from .hashing import U, mix, set_digest, shingle_sets

SHINGLE = 5
#: Threshold as a fraction of integers.
NUM, DEN = 80, 100
#: The level table has 2**22 to 2**26 slots of a byte, growing with the input, and half as many entries at most.
LEVEL_BITS = (22, 26)
#: Shingles of fewer than 2**LEAST_LEVEL sets aren't told apart from single ones: they are too many for the table once the
#: input is large, and the join should behave alike at every size.
LEAST_LEVEL = 2
#: Bits of a shingle beyond those of its bucket that tell it from others while shingles are counted.
COUNT_BITS = 28
#: Shingles of up to this many sets give pairs, those of more sets a star.
SMALL = 8
#: Sets and shingles that one trie takes; larger components are cut into blocks.
TRIE_SETS, TRIE_ITEMS = 1000, 1 << 21
#: Sets of a block's group that stand for it before blocks are compared, and the least group that they stand for.
STAND_FOR, LEAST_GROUP = 4, 16
FLUSH = 300_000
MAX_BUCKET_BITS = 18

META = "doc_id long, n long, digest long, again long, sketch binary"
META_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.int64()), ("again", pa.int64()), ("sketch", pa.binary())])
SETS_SCHEMA = pa.schema([("digest", pa.int64()), ("again", pa.int64()), ("grams", pa.binary())])
BLOB_SCHEMA = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])
#: Salt of the second digest.
AGAIN = 0x2545F4914F6CDD1D


def sets_of(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for rows, data, offs in slices(batch):
        yield rows, shingle_sets(data, offs, SHINGLE)


def once(sets: list[np.ndarray], seen: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Digest and set of those that this task hasn't had."""
    for s in sets:
        if len(s) and (d := set_digest(s)) not in seen:
            seen.add(d)
            yield d, s


def bucket_bits(docs: DataFrame) -> int:
    """Buckets grow with the input partitions, so that one holds about what a partition does."""
    return min(MAX_BUCKET_BITS, max(5, math.ceil(math.log2(max(1, docs.rdd.getNumPartitions())))))


def flush_size(bits: int) -> int:
    """Entries that a task holds before it cuts them into buckets: some for each."""
    return max(FLUSH, 16 << bits)


def planes(x: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, their lowest bytes first: small numbers leave planes of zeros, which shuffles compress."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(x: bytes, n: int, at: int = 0) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, np.uint8, 4 * n, at).reshape(4, n).T).view("<u4").ravel()


def steps(x: np.ndarray) -> np.ndarray:
    """Differences of ascending numbers, the first from 0."""
    return np.diff(x, prepend=x.dtype.type(0))


def bucketed(bits: int, keys: np.ndarray, pack) -> Iterator[pa.RecordBatch]:
    """One binary value a bucket (top bits of ``keys``, ascending): pack(from, to) of its entries."""
    edges = np.searchsorted(keys >> U(64 - bits), np.arange((1 << bits) + 1, dtype=U))
    some = np.flatnonzero(np.diff(edges))
    yield arrow_batch(BLOB_SCHEMA, bucket=some.astype(np.int32), blob=[pack(a, b) for a, b in zip(edges[some].tolist(), edges[some + 1].tolist(), strict=True)])


def blobs_of(table: pa.Table) -> Iterator[bytes]:
    for chunk in table.column("blob").chunks:
        for x in chunk:
            yield x.as_py()


def gram_levels(docs: DataFrame, bits: int) -> np.ndarray:
    """A table of bytes: for the slot of each repeated shingle, the log2 of its number of sets.

    Counts are of the shingle's first bits + COUNT_BITS bits; of all levels the highest are entered, as many as the table
    can tell apart. Any function of the shingle gives right joins; this one keeps frequent shingles out of the prefixes.
    """

    slot_bits = min(LEVEL_BITS[1], max(LEVEL_BITS[0], bits + 17))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        count = 0

        def flush() -> Iterator[pa.RecordBatch]:
            h = np.sort(np.concatenate(held))
            low = ((h >> U(64 - bits - COUNT_BITS)) & U((1 << COUNT_BITS) - 1)).astype(np.uint32)
            yield from bucketed(bits, h, lambda a, b: planes(steps(low[a:b])))
            held.clear()

        for batch in batches:
            for _, sets in sets_of(batch):
                own = [s for _, s in once(sets, seen)]
                held += own
                count += sum(map(len, own))
                if count > flush_size(bits):
                    yield from flush()
                    count = 0
        if held:
            yield from flush()

    def count(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        h = np.sort(np.concatenate([np.cumsum(from_planes(x, len(x) // 4), dtype=np.uint32) for x in blobs_of(table)]))
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        n = np.diff(np.r_[first, len(h)])
        more = n >= 1 << LEAST_LEVEL
        level = np.minimum(np.log2(n[more]).astype(np.int32), 31)
        slot = ((U(bucket) << U(COUNT_BITS)) + h[first[more]].astype(U)) >> U(bits + COUNT_BITS - slot_bits)
        rows = [(lv, len(s), s.astype(np.uint32).tobytes()) for lv in np.unique(level).tolist() if len(s := slot[level == lv])]
        return pa.table({"level": pa.array([r[0] for r in rows], pa.int32()), "n": pa.array([r[1] for r in rows], pa.int64()), "slots": pa.array([r[2] for r in rows], pa.binary())})

    found = written(apply_groups(map_batches(id_text(docs, "text"), emit, "bucket int, blob binary"), "bucket", count, "level int, n long, slots binary"), "gram-levels")
    levels, total, least = np.zeros(1 << slot_bits, np.uint8), 0, 33
    for r in found.groupBy("level").agg(F.sum("n").alias("n")).orderBy(F.desc("level")).collect():  # at most 32 rows
        total += r["n"]
        if total > 1 << (slot_bits - 1):
            break
        least = r["level"]
    for r in found.where(F.col("level") >= least).select("level", "slots").toLocalIterator():  # 4 bytes an entry, a partition at a time
        slot = np.frombuffer(r["slots"], np.uint32)
        np.maximum.at(levels, slot, np.uint8(r["level"]))
    discard(found)
    return levels


def ordered(grams: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Shingles as sorted keys of the global order: level, then the upper 58 bits of the hash."""
    slot = (grams >> U(65 - len(levels).bit_length())).astype(np.int64)
    return np.sort((levels[slot].astype(U) << U(58)) | (grams >> U(6)))


def prefixes(n: int) -> tuple[int, int]:
    """Shingles in order by which a set of n is found by smaller ones, and by which it finds larger ones."""
    return n - -(-NUM * n // DEN) + 1, n - -(-2 * NUM * n // (DEN + NUM)) + 1


def candidates(key: np.ndarray, digest: np.ndarray, n: np.ndarray, finds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (a, b, sure) of digests for entries of prefix shingles; sure ones need no sketch. Of two sets the smaller
    one must find, if they are equal in size both."""
    order = np.argsort(key, kind="stable")
    s = key[order]
    again = np.zeros(len(s), bool)
    again[1:] = s[1:] == s[:-1]
    again[:-1] |= again[1:]
    order = order[again]  # shingles that occur once, by far the most, go before anything else is sorted
    order = order[np.lexsort((digest[order], finds[order], n[order], key[order]))]
    k, d, m, f = key[order], digest[order], n[order], finds[order]
    own = np.ones(len(k), bool)
    own[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1]) | (m[1:] != m[:-1])
    k, d, m, f = k[own], d[own], m[own], f[own]
    # one that only is found needs a smaller one that finds; among equal sizes these come after it
    at = np.arange(len(k))
    last = np.maximum.accumulate(np.where(f, at, -1))
    use = f | ((last >= 0) & (k[last] == k) & (DEN * m[last] >= NUM * m))
    k, d, m, f = k[use], d[use], m[use], f[use]
    fresh = np.ones(len(k), bool)
    fresh[1:] = (k[1:] != k[:-1]) | (DEN * m[:-1] < NUM * m[1:])
    start = np.maximum.accumulate(np.where(fresh, np.arange(len(k)), 0)) if len(k) else np.zeros(0, np.int64)
    segment = np.cumsum(fresh) - 1
    size = np.bincount(segment)[segment] if len(k) else segment
    big = (size > SMALL) & ~fresh
    a, b, sure = [d[start[big]]], [d[big]], [np.ones(np.count_nonzero(big), bool)]
    for step in range(1, SMALL):
        x, y = np.arange(max(0, len(k) - step)), np.arange(step, max(step, len(k)))
        fit = (segment[x] == segment[y]) & (size[x] <= SMALL) & f[x] & (f[y] | (m[x] < m[y])) & (DEN * m[x] >= NUM * m[y])
        a.append(d[x[fit]])
        b.append(d[y[fit]])
        sure.append(np.zeros(np.count_nonzero(fit), bool))
    a, b, sure = map(np.concatenate, (a, b, sure))
    return np.minimum(a, b), np.maximum(a, b), sure


def candidate_pairs(docs: DataFrame, levels, bits: int) -> DataFrame:
    """a, b, sure: digests of sets that may link, each pair once."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = levels.value
        seen: set[int] = set()
        held: list[tuple[np.ndarray, int, int, int]] = []
        count = 0

        def flush() -> Iterator[pa.RecordBatch]:
            key = mix(np.concatenate([h for h, _, _, _ in held]))
            many = [len(h) for h, _, _, _ in held]
            order = np.argsort(key)
            digest = np.repeat(np.array([d for _, d, _, _ in held], np.int64), many)[order]
            # twice the size, and 1 where the shingle is one by which the set finds larger ones
            code = np.concatenate([2 * n + (np.arange(len(h)) < q) for h, _, n, q in held]).astype(np.uint32)[order]
            key = key[order]
            low = ((key << U(bits)) >> U(32)).astype(np.uint32)
            yield from bucketed(bits, key, lambda a, b: digest[a:b].tobytes() + planes(steps(low[a:b])) + planes(code[a:b]))
            held.clear()

        for batch in batches:
            for _, sets in sets_of(batch):
                for d, s in once(sets, seen):
                    p, q = prefixes(len(s))
                    held.append((ordered(s, own)[:p], d, len(s), q))
                    count += p
                if count > flush_size(bits):
                    yield from flush()
                    count = 0
        if held:
            yield from flush()

    def gather(table: pa.Table) -> pa.Table:
        k, d, c = [], [], []
        for x in blobs_of(table):
            n = len(x) // 16
            d.append(np.frombuffer(x, np.int64, n))
            k.append(np.cumsum(from_planes(x, n, 8 * n), dtype=np.uint32))
            c.append(from_planes(x, n, 12 * n))
        k, d, c = np.concatenate(k), np.concatenate(d), np.concatenate(c)
        a, b, sure = candidates(k, d, (c >> 1).astype(np.int64), (c & 1).astype(bool))
        order = np.lexsort((~sure, b, a))
        a, b, sure = a[order], b[order], sure[order]
        keep = (a != b) & np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(a)]
        return pa.table({"a": pa.array(a[keep], pa.int64()), "b": pa.array(b[keep], pa.int64()), "sure": pa.array(sure[keep])})

    found = apply_groups(map_batches(id_text(docs, "text"), emit, "bucket int, blob binary"), "bucket", gather, "a long, b long, sure boolean")
    return found.groupBy("a", "b").agg(F.bool_or("sure").alias("sure"))


def digest_bitmap(nodes: DataFrame) -> np.ndarray:
    """Marks the top bits of the digests in the one column of ``nodes``."""
    bits = filter_bits(nodes.count())
    return bitmap(nodes.select(F.shiftrightunsigned(nodes.columns[0], 64 - bits).alias("slot")), bits)


def among(digests: list[int], bits: np.ndarray) -> np.ndarray:
    d = np.array(digests, np.int64).view(U)
    return (d != 0) & marked(bits, (d >> U(61 - (len(bits).bit_length() - 1))).astype(np.int64))


def sketch(grams: np.ndarray) -> bytes:
    """Parities of the shingles in 128 to 65,536 slots, about as many as shingles. Two sets differ in no fewer shingles than
    slots; a sketch folds to half its slots by the parity of its halves."""
    bits = min(16, max(7, (len(grams) - 1).bit_length()))
    return np.packbits(np.bincount((grams >> U(64 - bits)).astype(np.int64), minlength=1 << bits) & 1, bitorder="little").tobytes()


def differing(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """For pairs of sketches, slots in which they differ, the larger one folded."""
    out = np.empty(len(x), np.int64)
    for k, (a, b) in enumerate(zip(x, y, strict=True)):
        u, v = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
        if len(u) > len(v):
            u, v = v, u
        if len(v) > len(u):  # neighbouring slots of the larger one are one slot of the smaller one
            wide = np.unpackbits(v, bitorder="little").reshape(8 * len(u), -1)
            v = np.packbits(np.bitwise_xor.reduce(wide, axis=1), bitorder="little")
        out[k] = np.bitwise_count(u ^ v).sum()
    return out


def described(docs: DataFrame, nodes) -> DataFrame:
    """doc_id, set size and digests of every row; the sketch once a task where the digest may be a candidate's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = nodes.value, set()
        for batch in batches:
            for rows, sets in sets_of(batch):
                digests, some = [set_digest(s) for s in sets], []
                for d, s, hit in zip(digests, sets, among(digests, bits), strict=True):
                    some.append(sketch(s) if hit and d not in seen else None)
                    if hit:
                        seen.add(d)
                yield arrow_batch(META_SCHEMA, doc_id=rows.column(0), n=[len(s) for s in sets], digest=digests, again=[set_digest(s, AGAIN) for s in sets], sketch=some)

    return map_batches(id_text(docs), run, META)


def near_pairs(pairs: DataFrame, meta: DataFrame) -> DataFrame:
    """a, b of the sure pairs and of those whose sketches allow a link."""
    of = meta.where("sketch is not null").groupBy("digest").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    side = lambda c: of.select(F.col("digest").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    joined = pairs.where("not sure").join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "s_a", "s_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            both = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            # of both sets' shingles at most (DEN - NUM) / (DEN + NUM) stand in one alone
            keep = (DEN + NUM) * differing(x, y) <= (DEN - NUM) * both
            yield batch.select([0, 1]).filter(pa.array(keep))

    return pairs.where("sure").select("a", "b").unionByName(map_batches(joined, run, "a long, b long"))


def set_table(docs: DataFrame, nodes) -> DataFrame:
    """Digests and shingles (sorted, 8 bytes each) of sets whose digest may be among ``nodes``, once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = nodes.value, set()
        for batch in batches:
            for _, sets in sets_of(batch):
                digests = [set_digest(s) for s in sets]
                hits = among(digests, bits)
                own = [k for k in np.flatnonzero(hits).tolist() if (digests[k], len(sets[k])) not in seen and not seen.add((digests[k], len(sets[k])))]
                if own:
                    yield arrow_batch(SETS_SCHEMA, digest=[digests[k] for k in own], again=[set_digest(sets[k], AGAIN) for k in own], grams=[sets[k].tobytes() for k in own])

    return map_batches(id_text(docs, "text"), run, "digest long, again long, grams binary")


class Trie:
    """Compressed trie of sorted integer arrays. Node k covers sets lo to hi (in lexicographic order) and the items
    start to end of its first set; size bounds of its sets are least and most."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        n = len(sets)
        size = np.array([len(s) for s in sets], np.int64)
        shared = np.zeros(n + 1, np.int64)
        for k in range(1, n):
            m = min(size[k - 1], size[k])
            differ = np.flatnonzero(sets[k - 1][:m] != sets[k][:m])
            shared[k] = differ[0] if len(differ) else m
        self.nodes: list[tuple[int, int, int, int, int, int]] = []
        self.children: list[list[int]] = []
        self.roots = self._build(0, n, 0, size, shared)

    def _build(self, lo: int, hi: int, start: int, size: np.ndarray, shared: np.ndarray) -> list[int]:
        top: list[int] = []
        todo = [(lo, hi, start, top)]
        while todo:
            lo, hi, start, into = todo.pop()
            cuts = [lo, *(np.flatnonzero(shared[lo + 1 : hi] <= start) + lo + 1).tolist(), hi]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                end = int(size[a]) if b == a + 1 else int(min(shared[a + 1 : b].min(), size[a:b].min()))
                k = len(self.nodes)
                self.nodes.append((a, b, start, end, int(size[a:b].min()), int(size[a:b].max())))
                self.children.append([])
                into.append(k)
                if b > a + 1:
                    todo.append((a, b, end, self.children[k]))
        return top


def trie_links(sets: list[np.ndarray], probes: np.ndarray | None = None, targets: np.ndarray | None = None) -> np.ndarray:
    """For sorted distinct arrays, the index of the first set of each one's linked component.

    With probes and targets (booleans) only pairs of a probe and a target are looked at.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    every = np.concatenate(sets)
    vocabulary, ids, counts = np.unique(every, return_inverse=True, return_counts=True)
    rank = np.empty(len(vocabulary), np.int64)
    rank[np.lexsort((vocabulary, -counts))] = np.arange(len(vocabulary))
    flat, edges = rank[ids], np.r_[0, np.cumsum(sizes)]
    own = [np.sort(flat[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    order = sorted(range(n), key=lambda k: own[k].astype(">u4").tobytes())
    own = [own[k] for k in order]
    sizes = sizes[order]
    trie = Trie(own)
    root, joined = np.arange(n), {}
    mask = np.zeros(len(vocabulary), bool)
    is_probe = np.ones(n, bool) if probes is None else probes[order]
    is_target = np.ones(n, bool) if targets is None else targets[order]
    both = is_probe & is_target
    nodes, children = trie.nodes, trie.children
    for x in range(n):
        if not is_probe[x]:
            continue
        mine, nx = own[x], int(sizes[x])
        mask[mine] = True
        todo = [(k, 0) for k in reversed(trie.roots)]
        while todo:
            k, overlap = todo.pop()
            lo, hi, start, end, least, most = nodes[k]
            if DEN * most < NUM * nx or DEN * nx < NUM * least:
                continue
            if hi - lo == 1:
                if lo == x or root[lo] == root[x] or not is_target[lo] or (both[lo] and both[x] and lo < x):
                    continue
            elif (root[lo:hi] == root[x]).all():
                continue
            label = own[lo][start:end]
            if len(label):
                overlap += int(np.count_nonzero(mask[label]))
                left = nx - int(np.searchsorted(mine, label[-1], "right"))
            else:
                left = nx
            # intersection i of sizes a and b links if DEN * i >= NUM * (a + b - i)
            if (DEN + NUM) * (overlap + min(left, most - end)) < NUM * (nx + least):
                continue
            if hi - lo == 1:
                few, many = sorted((int(root[x]), int(root[lo])), key=lambda k: len(joined.get(k, (k,))))
                moved = joined.pop(few, [few])
                root[moved] = many
                joined.setdefault(many, [many]).extend(moved)
            else:
                todo += [(c, overlap) for c in reversed(children[k])]
        mask[mine] = False
    out = np.empty(n, np.int64)
    back = np.array(order)
    first = np.full(n, n, np.int64)
    np.minimum.at(first, root, back)
    out[back] = first[root]
    return out


LINKED = "digest long, again long, root long, root_again long"


def verify(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (digest, again, root, root_again) within each (label, i, j) of cells: label, i, j (blocks), side (0, 1),
    digest, again, n. If i and j differ, only sets of different sides are compared."""

    def run(table: pa.Table) -> pa.Table:
        cols = {c: table.column(c).to_numpy(zero_copy_only=False) for c in ("label", "i", "j", "side", "digest", "again")}
        grams = table.column("grams")
        order = np.lexsort((cols["again"], cols["digest"], cols["j"], cols["i"], cols["label"]))
        same = lambda names: np.r_[False, np.all([cols[c][order][1:] == cols[c][order][:-1] for c in names], axis=0)][: len(order)]
        order = order[~same(("label", "i", "j", "digest", "again"))]
        starts = np.flatnonzero(~same(("label", "i", "j")))
        out: list[tuple[np.ndarray, ...]] = []
        for a, b in zip(starts, np.r_[starts[1:], len(order)], strict=True):
            at = order[a:b]
            if len(at) < 2:
                continue
            d, again, side = cols["digest"][at], cols["again"][at], cols["side"][at]
            cross = cols["i"][at[0]] != cols["j"][at[0]]
            found = trie_links([np.frombuffer(grams[int(k)].as_py(), U) for k in at], side == 0 if cross else None, side == 1 if cross else None)
            moved = found != np.arange(len(found))
            out.append((d[moved], again[moved], d[found[moved]], again[found[moved]]))
        names = ("digest", "again", "root", "root_again")
        return pa.table({c: pa.array(np.concatenate([x[k] for x in out]) if out else np.zeros(0, np.int64), pa.int64()) for k, c in enumerate(names)})

    spark = cells.sparkSession
    total = cells.agg(F.sum("n")).first()[0] or 0
    # 4 MB of sets in a bucket, and no fewer buckets than Spark would have tasks
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism, math.ceil(total / (1 << 19)))
    one = sets.groupBy("digest", "again").agg(F.first("grams").alias("grams"))
    rows = cells.join(one, ["digest", "again"]).select("label", "i", "j", "side", "digest", "again", "grams")
    return apply_groups(rows.withColumn("bucket", F.pmod(F.xxhash64("label", "i", "j"), F.lit(groups))), "bucket", run, LINKED)


def blocks(nodes: DataFrame, *within: str) -> DataFrame:
    """Nodes with their block: sets of near sizes of one (label, within), TRIE_SETS / 2 sets or TRIE_ITEMS / 2 shingles each."""
    sized = nodes.groupBy("label", *within, "n").agg(F.count("*").alias("cnt"))
    # what a set of this size takes of a block; a size with many sets goes to as many blocks by digest
    need = F.col("cnt") * F.greatest(F.lit(2 / TRIE_SETS), F.col("n") * 2 / TRIE_ITEMS)
    before = F.coalesce(F.sum(need).over(Window.partitionBy("label", *within).orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    spread = sized.select("label", *within, "n", F.floor(before).cast("int").alias("at"), F.ceil(need).cast("int").alias("parts"))
    one = nodes.alias("x").join(spread.alias("y"), [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in ("label", *within, "n")])
    return one.select("x.*", (F.col("y.at") + F.pmod(F.xxhash64("x.digest"), F.col("y.parts"))).cast("int").alias("block"))


def struct(d: str, a: str) -> Column:
    return F.struct(F.col(d).alias("d"), F.col(a).alias("a"))


def links(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between sets of one label, as many as join all that are linked. nodes: label, digest, again, n; sets: the
    shingles of these and others. Written tables both."""
    size = nodes.groupBy("label").agg(F.count("*").alias("cnt"), F.sum("n").alias("items"))
    large = written(size.where((F.col("cnt") > TRIE_SETS) | ((F.col("items") > TRIE_ITEMS) & (F.col("cnt") > 2))).select("label"), "large")
    whole = [F.lit(-1).alias("i"), F.lit(-1).alias("j"), F.lit(0).alias("side"), "digest", "again", "n"]
    if large.isEmpty():
        return written(verify(nodes.select("label", *whole), sets), "links")
    cut = written(blocks(nodes.join(large, "label", "left_semi")), "blocks")
    inside = cut.select("label", F.col("block").alias("i"), F.col("block").alias("j"), F.lit(0).alias("side"), "digest", "again", "n")
    inner = written(verify(nodes.join(large, "label", "left_anti").select("label", *whole).unionByName(inside), sets), "inner")
    # a few sets of each block's groups that are large stand for these
    named = cut.join(inner, ["digest", "again"], "left").withColumn("group", F.coalesce(struct("root", "root_again"), struct("digest", "again")))
    own = Window.partitionBy("label", "block", "group")
    named = named.withColumn("members", F.count("*").over(own)).withColumn("rank", F.row_number().over(own.orderBy("digest", "again")))
    some = written(named.where((F.col("members") >= LEAST_GROUP) & (F.col("rank") <= STAND_FOR)).select("label", "digest", "again", "n"), "stand-for")
    outer = links(some, sets)
    edges = inner.unionByName(outer)
    found = components(edges.select(struct("digest", "again").alias("a"), struct("root", "root_again").alias("b")))
    known = cut.drop("block").withColumn("node", struct("digest", "again")).join(found.withColumnRenamed("label", "group"), "node", "left").drop("node")
    # groups of a block or more have blocks of their own, which needn't be compared with each other; the others share blocks
    often = known.where("group is not null").groupBy("label", "group").agg(F.count("*").alias("cnt")).where(F.col("cnt") * 2 >= TRIE_SETS).select("label", "group", F.lit(True).alias("often"))
    known = known.join(often, ["label", "group"], "left").withColumn("group", F.when(F.col("often"), F.col("group"))).drop("often")
    placed = blocks(known, "group").withColumn("at", F.struct("group", "block"))
    placed = written(placed, "blocks")
    ranges = placed.groupBy("label", "group", "at").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    a, b = ranges.alias("a"), ranges.alias("b")
    near = a.join(b, (F.col("a.label") == F.col("b.label")) & (F.col("a.at") <= F.col("b.at")) & (DEN * F.col("a.most") >= NUM * F.col("b.least")) & (DEN * F.col("b.most") >= NUM * F.col("a.least")))
    near = near.where("a.group is null or b.group is null or a.group != b.group").select(F.col("a.label").alias("label"), F.col("a.at").alias("one"), F.col("b.at").alias("two"))
    number = lambda c: F.xxhash64(f"{c}.group.d", f"{c}.group.a", f"{c}.block")
    near = near.withColumn("i", number("one")).withColumn("j", number("two"))
    cell = lambda rows, c, side: placed.join(rows.select("label", F.col(c).alias("at"), "i", "j"), ["label", "at"]).select("label", "i", "j", F.lit(side).alias("side"), "digest", "again", "n")
    cells = written(cell(near, "one", 0).unionByName(cell(near.where("one < two"), "two", 1)), "cells")
    out = written(edges.unionByName(verify(cells, sets)), "links")
    discard(large, cut, inner, some, outer, placed, cells)
    return out


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row (see the module)."""
    spark: SparkSession = docs.sparkSession
    send = spark.sparkContext.broadcast
    bits = bucket_bits(docs)
    levels = send(gram_levels(docs, bits))  # 64 MB at most
    pairs = written(candidate_pairs(docs, levels, bits), "pairs")
    levels.unpersist()
    nodes = send(digest_bitmap(pairs.select(F.explode(F.array("a", "b")).alias("node"))))  # as the next: 64 MB at most
    meta = written(described(docs, nodes), "meta")
    found = written(components(near_pairs(pairs, meta)), "candidates")
    discard(pairs)
    nodes.unpersist()
    nodes = send(digest_bitmap(found.select("node")))
    sets = written(set_table(docs, nodes), "sets")
    rows = meta.where("n > 0").groupBy("digest", "again").agg(F.first("n").alias("n"), F.min("doc_id").alias("low"))
    classes = written(rows, "classes")
    members = written(found.join(classes, F.col("node") == F.col("digest")).select("label", "digest", "again", "n"), "members")
    linked = links(members, sets)
    joint = components(linked.select(struct("digest", "again").alias("a"), struct("root", "root_again").alias("b")))
    joint = written(joint.select(F.col("node.d").alias("digest"), F.col("node.a").alias("again"), F.col("label").alias("root")), "joint")
    discard(found, sets, members, linked)
    least = joint.join(classes, ["digest", "again"]).groupBy("root").agg(F.min("low").alias("least"))
    several = joint.join(least, "root").select("digest", "again", "least")
    names = classes.join(several, ["digest", "again"], "left").select("digest", "again", F.coalesce("least", "low").alias("component_id"))
    alone = meta.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return meta.where("n > 0").join(names, ["digest", "again"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows whose doc_id is the smallest of their component, with their own columns.

    Of rows with equal doc_id and text one stays. Rows without doc_id and documents without words stay. Only rows whose
    id may be among those that go, or that come again, are shuffled.
    """
    found = written(jaccard_classes(docs), "found")
    by = found.where("doc_id is not null").groupBy(F.col("doc_id").alias("pw_id")).agg(F.bool_or(F.col("doc_id") == F.col("component_id")).alias("pw_kept"), F.count("*").alias("pw_rows"))
    odd = written(by.where("not pw_kept or pw_rows > 1"), "odd")
    maybe, sure = apart(docs, docs["doc_id"].cast("long"), odd, "pw_id")
    told = maybe.join(odd, maybe["doc_id"].cast("long") == odd["pw_id"], "left")
    kept = told.where("pw_id is null").drop("pw_id", "pw_kept", "pw_rows")
    one = told.where("pw_kept").drop("pw_id", "pw_kept", "pw_rows").dropDuplicates(["doc_id", "text"])
    return sure.unionByName(kept).unionByName(one)


def op6_jaccard_join(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return jaccard_classes(table(spark, sf_dir, "documents"))
