"""Results against plain versions of the same definitions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("pixelweave.llm")
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from pixelweave.llm import audio, bpe, chunk_dedup, hashing, jaccard_join, packing, pii, qda, quality_rules, reply_trees, sharding

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def odd_texts(n, alphabet, seed=1, most=60):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, most))) for _ in range(n)]


# --- op1 ---------------------------------------------------------------------------------------------------------------


def test_audio_round_trip(spark, texts):
    for codec in ("mulaw", "alaw", None):
        got = {r.doc_id: r for r in audio.read_audio(audio.store_audio(spark.read.parquet(f"{SF}/documents.parquet"), codec)).collect()}
        for k, t in texts.items():
            raw = (t or "").encode()
            want = raw + b"\0" * (max(1, -(-len(raw) // 64)) * 64 - len(raw))
            assert (got[k].n_bytes, got[k].payload_bytes, got[k].payload_sha256, got[k].tail_crc32) == (len(raw), len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-64:]))


def plain_audio(payload):
    """Feature string and PCM, sample by sample."""
    law = audio.LAWS[zlib.crc32(payload) & 1]
    x = [int(audio.EXPAND[law][b]) for b in payload]
    crossings = sum((a < 0) != (b < 0) for a, b in zip(x, x[1:]))
    adpcm = []
    for k in range(0, len(payload), 64):
        b = payload[k : k + 64]
        value, index = int.from_bytes(b[:2], "little", signed=True), min(b[2], 88)
        adpcm.append(value)
        for byte in b[4:]:
            for nib in (byte & 15, byte >> 4):
                step = int(audio.IMA_STEPS[index])
                d = (step >> 3) + (step if nib & 4 else 0) + (step >> 1 if nib & 2 else 0) + (step >> 2 if nib & 1 else 0)
                value = max(-32768, min(32767, value - d if nib & 8 else value + d))
                index = max(0, min(88, index + int(audio.IMA_INDEX[nib])))
                adpcm.append(value)
    pcm = []
    for k, v in enumerate(x):
        at = lambda j: x[min(max(j, 0), len(x) - 1)]
        pcm += [v, max(-32768, min(32767, (9 * (v + at(k + 1)) - at(k - 1) - at(min(k + 1, len(x) - 1) + 1) + 8) >> 4))]
    pcm = np.array(pcm, "<i2").tobytes()
    rms = lambda y: (sum(v * v for v in y) / len(y)) ** 0.5
    return f"law={law};rms={rms(x):.3f};zc={crossings};adpcm_rms={rms(adpcm):.3f};adpcm_peak={max(map(abs, adpcm))};pcm16k={2 * len(x)}:{zlib.crc32(pcm)}", pcm


def test_audio_features_and_stored_pcm(spark, texts):
    some = {k: t for k, t in texts.items() if len(t or "") < 4000}
    docs = spark.createDataFrame(list(some.items()), "doc_id long, text string").repartition(3)
    laws = set()
    for r in audio.telephony_audio(docs).collect():
        raw = (some[r.doc_id] or "").encode()
        feature, pcm = plain_audio(raw + b"\0" * (max(1, -(-len(raw) // 64)) * 64 - len(raw)))
        assert (r.feature, r.pcm, r.pcm_bytes, r.pcm_sha256) == (feature, pcm, len(pcm), hashlib.sha256(pcm).hexdigest())
        laws.add(r.feature.split(";")[0])
    assert len(some) > 100 and len(laws) == 2


def test_g711_tables():
    assert audio.EXPAND["mulaw"][0xFF] == 0 and audio.EXPAND["mulaw"][0x00] == -32124 and audio.EXPAND["mulaw"][0x80] == 32124
    assert audio.EXPAND["alaw"][0xD5] == 8 and audio.EXPAND["alaw"][0x55] == -8 and audio.EXPAND["alaw"][0xAA] == 32256


def test_adpcm_against_sample_loop():
    blocks = np.random.default_rng(1).integers(0, 256, (40, 64)).astype(np.uint8)
    got = audio.decode_adpcm(blocks)
    for b, row in zip(blocks, got, strict=True):
        value, index = int.from_bytes(bytes(b[:2]), "little", signed=True), min(int(b[2]), 88)
        want = [value]
        for byte in b[4:]:
            for nib in (int(byte) & 15, int(byte) >> 4):
                step = int(audio.IMA_STEPS[index])
                d = step >> 3
                d += step if nib & 4 else 0
                d += step >> 1 if nib & 2 else 0
                d += step >> 2 if nib & 1 else 0
                value = max(-32768, min(32767, value - d if nib & 8 else value + d))
                index = max(0, min(88, index + int(audio.IMA_INDEX[nib])))
                want.append(value)
        assert row.tolist() == want


def test_resampled_signals_do_not_touch():
    x = np.array([100, 200, 300, 400, -5, -5, -5, -5], np.int16)
    both = audio.resample_double(x, np.array([0, 4]), np.array([4, 8]))
    assert both[:8].tolist() == audio.resample_double(x[:4], np.array([0]), np.array([4])).tolist()
    assert both[8:].tolist() == [-5] * 8


# --- op2 ---------------------------------------------------------------------------------------------------------------


def test_shards_split_only_what_is_too_large(spark):
    rows = [(k, "x" * (k % 90)) for k in range(2000)]
    limit = 1500
    got = sharding.extendible_shards(spark.createDataFrame(rows, "doc_id long, text string"), limit).collect()
    bits = {k: f"{int(hashlib.md5(str(k).encode()).hexdigest()[:15], 16):060b}" for k, _ in rows}
    start = max(0, int(np.ceil(np.log2(sum(len(t) for _, t in rows) / limit))))

    def leaf(k):
        for d in range(start, 61):
            if sum(len(t) for j, t in rows if bits[j].startswith(bits[k][:d])) <= limit:
                return bits[k][:d]

    for r in random.Random(1).sample(got, 60):
        assert r.shard == leaf(r.doc_id)
    assert all(not r.over_limit for r in got) and len(got) == len(rows)


def test_equal_rows_overflow_into_pages(spark):
    rows = [(1, "a" * 100)] * 50 + [(2, f"c{k}" * 10) for k in range(100)] + [(3, "z" * 900)]
    got = sharding.extendible_shards(spark.createDataFrame(rows, "doc_id long, text string"), 500).collect()
    assert len(got) == len(rows) and {r.doc_id for r in got if r.over_limit} == {3}
    size = {}
    for r in got:
        size[r.shard] = size.get(r.shard, 0) + r.n_bytes
    assert all(size[r.shard] == r.shard_bytes and (r.over_limit or r.shard_bytes <= 500) for r in got)


# --- op3 ---------------------------------------------------------------------------------------------------------------


def test_qda_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    got = qda.op3_quality_qda(spark, d).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 50 and np.mean([r.predicted == r.quality for r in got]) >= 0.95
    assert np.mean([r.predicted for r in got if r.quality == 1]) >= 0.95


def test_discriminant_equals_log_densities():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 3))
    means, covs, prior = [rng.normal(size=3) for _ in "ab"], [np.diag([1, 2, 3.0]), np.diag([2, 1, 0.5])], [0.3, 0.7]
    m = qda.Discriminant(means, [np.linalg.cholesky(c) for c in covs], [np.log(p) - 0.5 * np.log(np.linalg.det(c)) for p, c in zip(prior, covs, strict=True)], 0.5)
    dens = [p * np.exp(-0.5 * np.einsum("ij,jk,ik->i", x - u, np.linalg.inv(c), x - u)) / np.sqrt(np.linalg.det(c)) for p, u, c in zip(prior, means, covs, strict=True)]
    assert np.allclose(m.score(x), dens[1] / (dens[0] + dens[1]))


def plain_statistics(t):
    """NAMES of one text, by counting."""
    raw = (t or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    low = [re.sub(rb"[A-Z]", lambda m: m[0].lower(), w) for w in words]
    n, count = max(1, len(raw)), max(1, len(words))
    length = [len(w) for w in words]
    mean = sum(length) / count
    spread = max(0, sum(x * x for x in length) / count - mean * mean) ** 0.5
    shares = [sum(b in chars for b in raw) / n for chars in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>", b"|", b"!", b".", b",", b"\n", b"\"'()-/:;=?@[\\]^_`{}~+")]
    stop = {w.encode() for ws in quality_rules.STOP_WORDS.values() for w in ws}
    distinct = lambda xs: len(set(xs)) / len(xs) if xs else 1
    lines = [x for x in re.split(rb"(?<=\n)", raw) if x]
    top = max((low.count(w) for w in set(low)), default=0) / count
    joint = [sum(b >> 2 == k for b in raw) / n for k in range(64)]
    entropy = -sum(p * np.log2(p) for p in joint if p)
    return [
        np.log1p(len(raw)), np.log1p(len(words)), np.log1p(mean), np.log1p(spread), *np.sqrt(shares), np.sqrt(sum(w in stop for w in low) / count), np.sqrt(distinct(low)), np.sqrt(distinct(lines)),
        np.sqrt(distinct(list(zip(low, low[1:], low[2:])))), entropy, np.sqrt(sum(x > 15 for x in length) / count), np.sqrt(top),
    ]


def test_statistics_against_counting(texts):
    some = [t or "" for t in texts.values() if len(t or "") < 3000][:60] + odd_texts(60, "aB the \n|.,é日#9!") + ["", " \n", "x" * 700]
    data = np.frombuffer("".join(some).encode(), np.uint8)
    got = qda.statistics(data, np.r_[0, np.cumsum([len(t.encode()) for t in some])])
    for t, row in zip(some, got, strict=True):
        assert np.allclose(row, plain_statistics(t), atol=1e-9), t


def test_moments_and_weights(spark):
    """Scores follow from the labelled rows that aren't held out, by the plain formulas, and from no other label."""
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    feats = qda.features(docs).cache()
    m = qda.fit(feats, labels)
    rows = {r.doc_id: r.x for r in feats.collect()}
    train = [(r.doc_id, r.quality) for r in labels.collect() if r.quality in (0, 1) and zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.doc_id in rows]
    x, q = np.array([rows[k] for k, _ in train]), np.array([c for _, c in train])
    cov = [np.cov(x[q == c].T, bias=True) for c in (0, 1)]
    both = (np.sum(q == 0) * cov[0] + np.sum(q == 1) * cov[1]) / len(q)
    p, r = m.weights
    assert m.weights in qda.GRID
    for c in (0, 1):
        s = (1 - r) * ((1 - p) * cov[c] + p * both) + r * np.diag(np.maximum(np.diag(both), 1e-12)) + 1e-9 * np.eye(len(both))
        assert np.allclose(m.mean[c], x[q == c].mean(axis=0)) and np.allclose(m.factor[c] @ m.factor[c].T, s, atol=1e-6)
        assert np.isclose(m.constant[c], np.log(np.mean(q == c)) - 0.5 * np.linalg.slogdet(s)[1], atol=1e-4)
    other = labels.withColumn("quality", F.when(qda.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert qda.fit(feats, other).constant == pytest.approx(m.constant)
    feats.unpersist()


def test_chosen_weights_are_the_likeliest():
    """The likelihood from moments equals that of the rows."""
    rng, d = np.random.default_rng(2), len(qda.NAMES)
    x = [[rng.normal(c, 1 + c, (40 + 10 * k, d)) for k in range(qda.FOLDS)] for c in (0, 1)]
    sums = np.array([[np.r_[len(y), y.sum(axis=0), (y.T @ y).ravel()] for y in rows] for rows in x])

    def likelihood(w):
        total = 0
        for k in range(qda.FOLDS):
            means, factors, _ = qda.solved(sums.sum(axis=1) - sums[:, k], *w)
            for c in (0, 1):
                y = np.linalg.solve(factors[c], (x[c][k] - means[c]).T)
                total -= 0.5 * (y * y).sum() + len(x[c][k]) * np.log(np.diag(factors[c])).sum()
        return total

    assert qda.chosen(sums) == max(qda.GRID, key=likelihood)


# --- op4 ---------------------------------------------------------------------------------------------------------------


def test_packing_ids_and_padding(spark, texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    ids = {k: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for k, t in texts.items()}
    rows = packing.op4_nnls_packing(spark, SF).collect()
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
    used = sum(r.length for r in rows)
    assert used / (4096 * len({r.sequence_id for r in rows})) > 0.97


def test_run_cache_equals_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    tok, own = Tokenizer.from_file(path), packing.ChunkIds(path)
    for t in [*odd_texts(3000, "abcdeÉéßITS'   \n.,;:!?)|#12µªº日🙂Σ×"), "<|endoftext|>. a", "<|ENDOFTEXT|>", "a\x1cb \x85c", "ﬁ Å x .'s"]:
        assert own.encode_all([t])[0] == np.array(tok.encode(t, add_special_tokens=False).ids, f"<u{own.unit}").tobytes(), t


@pytest.mark.parametrize("counts", [{700: 1000}, {4095: 5, 1: 3}, {2100: 40, 1996: 3}, {17: 1}, {}])
def test_plan_places_each_piece_once(counts):
    h = np.zeros(4096, np.int64)
    for k, n in counts.items():
        h[k] = n
    p = packing.plan(h)
    lengths = np.repeat(np.array(list(counts), np.int64), list(counts.values()))
    ranks = np.concatenate([np.arange(n) for n in counts.values()]) if counts else np.zeros(0, np.int64)
    row, start, size, seq, off = packing.assign(p, lengths, ranks)
    cells = {}
    for r, s, n, q, o in zip(row, start, size, seq, off, strict=True):
        cells.setdefault(int(q), []).append((int(o), int(n)))
    assert sum(map(int, size)) == int(lengths.sum())
    for spans in cells.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 4096
    if lengths.sum():
        assert len(cells) <= lengths.sum() // 4096 + 2 + lengths.sum() // 4096 // 50


@pytest.mark.parametrize(("sf", "share"), [("0.001", 0.75), ("0.01", 0.95)])
def test_most_sequences_come_from_the_solution(spark, sf, share):
    """Also with few documents, whose lengths are nearly all different."""
    path = public_tokenizers.path("word_bpe_49k.json")
    h = np.zeros(4096, np.int64)
    for r in packing.tokenize(spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet"), path).groupBy("rem").count().collect():
        h[r["rem"]] = r["count"] if r["rem"] else 0
    p = packing.plan(h)
    assert p.by_solution >= share * p.sequences
    assert (h * np.arange(4096)).sum() > 0.99 * 4096 * p.sequences


def test_least_squares_is_near_optimal():
    combos = np.array([[3, 1], [2, 2], [1, 0]])
    h = np.array([0, 10.0, 8.0, 6.0])
    x = packing.solve_counts(combos, h, 5000)
    assert np.allclose(x, [6, 4, 4], atol=0.05)


# --- op5 ---------------------------------------------------------------------------------------------------------------


def test_reply_tree_paths_and_ranks(spark):
    nodes = spark.createDataFrame([(1, 1, None, 0.0, "user", "q"), (1, 2, 1, 1.0, "assistant", "a"), (1, 3, 1, 5.0, "assistant", "b"), (1, 4, 2, 9.0, "user", "c"), (1, 5, 4, 0.0, "assistant", "d"), (1, 6, 3, 1.0, "user", "e")], "conv_id long, node long, parent long, score double, role string, text string")
    out = {r.leaf: r for r in reply_trees.read_formatted(reply_trees.format_trees(nodes, 5)).collect()}
    assert {k: [t.text for t in r.turns] for k, r in out.items()} == {5: ["q", "a", "c", "d"], 6: ["q", "b", "e"]}
    assert (out[5].branch, out[6].branch, out[5].loss_text, out[6].loss_text) == (1, 2, "ad", "b")
    assert reply_trees.format_trees(nodes).count() == 1


def test_escapes_are_reversible(spark):
    t = [(x,) for x in odd_texts(500, "\\#h</turn>bt: \n### c", most=30)]
    df = spark.createDataFrame(t, "t string")
    assert df.where(reply_trees.unescape(reply_trees.escape(F.col("t"))) != F.col("t")).count() == 0
    assert df.where(reply_trees.unescape_role(reply_trees.escape_role(F.col("t"))) != F.col("t")).count() == 0
    assert df.where(reply_trees.escape(F.col("t")).contains("</turn>") | reply_trees.escape(F.col("t")).contains("###")).count() == 0


# --- op6 ---------------------------------------------------------------------------------------------------------------


def word_set(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain_components(rows):
    sets = [(i, word_set(t)) for i, t in rows]
    low = {k: k for k in range(len(rows))}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = find(a), find(b)
                low[max(p, q)] = min(p, q)
    least = {}
    for k in range(len(rows)):
        least[find(k)] = min(least.get(find(k), rows[k][0]), rows[k][0])
    return {rows[k][0]: (len(sets[k][1]), least[find(k)]) for k in range(len(rows))}


def near_copies(seed=3, n=150):
    rnd = random.Random(seed)
    base = [f"w{rnd.randint(0, 5000)}" for _ in range(120)]
    rows = [(0, None), (1, ""), (2, " \n "), (3, "one two"), (4, "One  TWO"), (5, "one two three")]
    for i in range(n):
        w = base[: rnd.randint(80, 120)]
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(len(w))] = f"x{rnd.randint(0, 99999)}"
        rows.append((10 + i, " ".join(w)))
        w = [f"v{rnd.randint(0, 9)}" for _ in range(rnd.randint(1, 12))]
        rows += [(1000 + i, " ".join(w)), (2000 + i, " ".join([*w, "z"]))]
    return rows


def test_jaccard_against_all_pairs(spark):
    rows = near_copies()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == plain_components(rows)


def classes_of(spark, rows, parts=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_classes(docs).collect()}


def test_jaccard_in_blocks(spark, monkeypatch):
    """Near copies, and a chain of texts of which only neighbours are alike, in blocks that are too small for them."""
    monkeypatch.setattr(jaccard_join, "TRIE_SETS", 30)
    monkeypatch.setattr(jaccard_join, "LEAST_GROUP", 4)
    words = [f"c{k}" for k in range(400)]
    rows = near_copies(5) + [(5000 + k, " ".join(words[2 * k : 2 * k + 60])) for k in range(150)]
    assert classes_of(spark, rows) == plain_components(rows)


def test_jaccard_of_stars_and_full_bitmaps(spark, monkeypatch):
    rows = near_copies(6)
    want = plain_components(rows)
    monkeypatch.setattr(jaccard_join, "SMALL", 2)
    assert classes_of(spark, rows) == want
    monkeypatch.setattr(jaccard_join, "SMALL", 8)
    monkeypatch.setattr(jaccard_join, "digest_bitmap", lambda nodes: np.full(1 << 12, 255, np.uint8))
    assert classes_of(spark, rows) == want


def thue_morse(bits, first):
    t = first
    for _ in range(bits):
        t += t.translate(str.maketrans("ab", "ba"))
    return t


def test_words_of_one_polynomial_hash_differ(spark):
    """Thue-Morse words and their complements meet under every polynomial modulo a power of two."""
    rows = [(k, thue_morse(b, f)) for k, (b, f) in enumerate((b, f) for b in (8, 10, 11, 12) for f in "ab")]
    assert classes_of(spark, rows) == {k: (1, k) for k, _ in rows}


def test_candidates_against_all_pairs():
    """Every pair that links shares a candidate component, and small segments give no pair out of reach."""
    rnd = np.random.default_rng(4)
    for small in (2, 8):
        sets = []
        for _ in range(60):
            base = rnd.integers(0, 400, rnd.integers(1, 40))
            sets += [np.unique(np.r_[base, rnd.integers(0, 400, k)]) for k in range(4)]
        key, digest, n, finds = [], [], [], []
        for d, s in enumerate(sets):
            p, q = jaccard_join.prefixes(len(s))
            key.append(s[:p]), digest.append(np.full(p, d)), n.append(np.full(p, len(s))), finds.append(np.arange(p) < q)
        before, jaccard_join.SMALL = jaccard_join.SMALL, small
        a, b, sure = jaccard_join.candidates(*map(np.concatenate, (key, digest, n, finds)))
        jaccard_join.SMALL = before
        assert small == 2 or not sure.all()
        low = np.arange(len(sets))
        for x, y in zip(a, b, strict=True):
            low[low == low[y]] = low[x]
        for x in range(len(sets)):
            for y in range(x):
                i = len(np.intersect1d(sets[x], sets[y]))
                if 100 * i >= 80 * (len(sets[x]) + len(sets[y]) - i):
                    assert low[x] == low[y]


def test_sketches_never_differ_more_than_sets():
    rnd = np.random.default_rng(5)
    for n, m in ((5, 90), (100, 130), (700, 900), (3000, 200), (90_000, 80_000)):
        x = np.unique(rnd.integers(0, 1 << 63, n, np.uint64) * np.uint64(2))
        y = np.unique(np.r_[x[: min(n, m) // 2], rnd.integers(0, 1 << 63, m, np.uint64)])
        apart = len(np.setxor1d(x, y))
        got = jaccard_join.differing([jaccard_join.sketch(x)], [jaccard_join.sketch(y)])[0]
        assert 0 < got <= apart
        assert jaccard_join.differing([jaccard_join.sketch(x)], [jaccard_join.sketch(x)])[0] == 0


def test_span_hashes_depend_on_bytes_only():
    data = np.frombuffer(b"abcabcab" * 500, np.uint8)
    h = hashing.span_hashes(data, np.array([0, 3, 8, 1, 0, 8, 3999, 4000]), np.array([3, 6, 11, 3, 700, 708, 4000, 4000]))
    assert h[0] == h[1] == h[2] != h[3] and h[4] == h[5] and len(set(h.tolist())) == 5
    spans = [bytes(data[:k]) + b"\0" * j for k in range(20) for j in range(3)]
    flat, ends = np.frombuffer(b"".join(spans), np.uint8), np.cumsum([len(x) for x in spans])
    assert len(set(hashing.span_hashes(flat, ends - [len(x) for x in spans], ends).tolist())) == len(set(spans))


# --- op7 ---------------------------------------------------------------------------------------------------------------


def test_repeated_passages(spark):
    rnd = random.Random(2)
    fresh = lambda n: " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9))) for _ in range(n))
    passage = fresh(70)
    rows = [(k, f"{fresh(rnd.randint(20, 90))} {passage} {fresh(40)}") for k in range(1, 9)] + [(k, fresh(200)) for k in range(20, 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.doc_id for r in chunk_dedup.repeated_passages(df).collect()} == set(range(1, 9))
    text = dict(rows)
    for r in chunk_dedup.repeated_places(df).collect():
        piece = text[r.doc_id].encode()[r.start : r.start + r["size"]]
        assert text[r.first_doc_id].encode()[r.first_start : r.first_start + len(piece)] == piece
        assert r.removed == ((r.doc_id, r.start) != (r.first_doc_id, r.first_start))
    after = {r.doc_id: r.text for r in chunk_dedup.remove_repeats(df).collect()}
    assert after[1] == text[1] and all(after[k] == text[k] for k in range(20, 30))
    assert all(len(after[k].split()) <= len(text[k].split()) - 45 for k in range(2, 9))


def test_one_intact_copy_of_each_passage_of_common_words(spark):
    """Common words make chunks that stand in many unrelated texts; the first copy of a passage must not lose them."""
    rnd = random.Random(7)
    common = "the of and to a in that it is was for on as with he be at by had not".split()
    some = lambda n: " ".join(rnd.choice(common) for _ in range(n))
    passages = [some(60) for _ in range(30)]
    # each passage stands twice; all are behind texts of the same words, and texts repeat in part what came in part before
    rows = [(k, some(150)) for k in range(40)]
    rows += [(100 + 2 * k + c, f"{some(30)} {p} {some(30)}") for k, p in enumerate(passages) for c in (0, 1)]
    a, b, c = some(40), some(40), some(40)
    rows += [(300, f"{some(9)} {a} {b}"), (301, f"{a} {b} {c} {some(9)}"), (302, f"{some(9)} {b} {c}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    after = {r.doc_id: r.text for r in chunk_dedup.remove_repeats(docs).collect()}
    assert all(after[k] == t for k, t in rows if k < 100 or k == 300)
    for k, p in enumerate(passages):
        assert p in after[100 + 2 * k] and len(after[101 + 2 * k].split()) <= 90
    # each window from a chunk on that stands twice or more still stands whole
    seen, left = {}, "\0".join(after.values())
    for k, t in rows:
        data, offs = np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)])
        starts, ends, own = chunk_dedup.chunks(data, offs)
        p, q = chunk_dedup.windows(chunk_dedup.chunk_words(data, offs, starts, ends), own)
        for i, j in zip(p, q, strict=True):
            seen.setdefault(t[starts[i] : ends[j]], set()).add((k, i))
    again = [w for w, at in seen.items() if len(at) > 1]
    assert len(again) > 100 and all(w in left for w in again)
    for r in chunk_dedup.repeated_places(docs).where("removed").collect():
        t = dict(rows)[r.doc_id].encode()
        assert r.start == 0 or t[r.start - 1 : r.start].isspace()


def plain_removals(rows):
    """Texts after removal, by a dictionary of the windows' bytes. rows: doc_id, text."""
    low, places = -(1 << 63), {}
    found = []
    for d, t in rows:
        raw = (t or "").encode()
        data, offs = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
        key = (low if d is None else d, int.from_bytes(hashlib.md5(raw).digest()[:8], "big", signed=True))
        own = []
        if raw:
            starts, ends, of = chunk_dedup.chunks(data, offs)
            for p, q in zip(*chunk_dedup.windows(chunk_dedup.chunk_words(data, offs, starts, ends), of), strict=True):
                a, b = int(starts[p]), int(ends[q])
                places.setdefault(raw[a:b], []).append((*key, a))
                own.append((a, b))
        found.append((key, raw, own))
    out = []
    for key, raw, own in found:
        again, stays = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
        for a, b in own:
            at = places[raw[a:b]]
            again[a:b] |= len(at) > 1
            stays[a:b] |= len(at) > 1 and min(at) == (*key, a)
        out.append(bytes(np.frombuffer(raw, np.uint8)[~(again & ~stays)]).decode())
    return out


def passages_of_common_words(seed=9):
    rnd = random.Random(seed)
    common = "the of and to a in that it is was for on as with he be at by had not".split()
    some = lambda n: " ".join(rnd.choice(common) for _ in range(n))
    shared = [some(rnd.randint(30, 90)) for _ in range(12)]
    rows = [(k, " ".join(x for _ in range(4) for x in (some(rnd.randint(1, 40)), rnd.choice(shared)))) for k in range(60)]
    # the same texts again under other ids and without, one id for different texts, a passage at the same byte of two
    # texts with one id or none, and scripts without white space
    rows += [(200, rows[0][1]), (200, rows[0][1]), (None, rows[1][1]), (None, rows[2][1]), (201, rows[3][1]), (201, rows[4][1])]
    same = some(160)
    rows += [(i, f"{same} {some(n)}") for i in (None, 300) for n in (50, 51)] + [(None, "a " + some(300))]
    wide = "".join(chr(rnd.randint(0x4E00, 0x9000)) for _ in range(900))
    rows += [(400 + k, "".join(chr(rnd.randint(0x4E00, 0x9000)) for _ in range(300)) + wide[100 * k : 100 * k + 400]) for k in range(4)]
    return rows + [(500, None), (501, ""), (502, " \n")]


@pytest.mark.parametrize("bits", [None, 0, 255])
def test_removals_against_plain_ones(spark, monkeypatch, bits):
    """Equal rows, however full the bitmap is; 0 marks nothing but what is repeated, in the least number of slots."""
    if bits == 255:
        monkeypatch.setattr(chunk_dedup, "repeat_bitmap", lambda docs, bits: np.full(1 << 13, 255, np.uint8))
    elif bits == 0:
        monkeypatch.setattr(chunk_dedup, "filter_bits", lambda n, most: 16)
    rows = passages_of_common_words()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((-1 if r.doc_id is None else r.doc_id), r.text or "") for r in chunk_dedup.remove_repeats(docs).collect())
    want = sorted((-1 if d is None else d, t) for (d, _), t in zip(rows, plain_removals(rows), strict=True))
    assert got == want
    short = {d: len(t) for d, t in got}
    assert all(short[400 + k] < 550 for k in (1, 2, 3))  # of 700 characters 300 are repeated, most of these go


def test_texts_that_share_a_checksum_without_id(spark):
    """Of rows without id only those that hold a repeated passage lose text, even where a third has the CRC of the second."""
    rnd = random.Random(3)
    some = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    passage = some(80)
    first, second, third = f"{some(30)} {passage}", f"{some(40)} {passage}", some(120)
    # letters a or c behind a text change its CRC by fixed patterns: choose those that give the other text's
    crc = lambda tail: zlib.crc32(f"{third} {tail}".encode())
    base, basis = crc("a" * 48), {}
    for k in range(48):
        x, made = crc("a" * k + "c" + "a" * (47 - k)) ^ base, 1 << k
        while x and x.bit_length() in basis:
            y, other = basis[x.bit_length()]
            x, made = x ^ y, made ^ other
        if x:
            basis[x.bit_length()] = x, made
    x, made = zlib.crc32(second.encode()) ^ base, 0
    while x:
        y, other = basis[x.bit_length()]
        x, made = x ^ y, made ^ other
    third += " " + "".join("c" if made >> k & 1 else "a" for k in range(48))
    assert zlib.crc32(second.encode()) == zlib.crc32(third.encode())
    docs = spark.createDataFrame([(None, first), (None, second), (None, third)], "doc_id long, text string")
    after = [r.text for r in chunk_dedup.remove_repeats(docs).collect()]
    assert third in after and sum(map(len, after)) < len(first) + len(second) + len(third) - 300


def test_gear_hash_and_shift_resistance():
    data = np.random.default_rng(1).integers(97, 110, 4000).astype(np.uint8)
    data[::6] = 32
    h = chunk_dedup.gear_hash(data)
    for i in (0, 7, 31, 40, 3999):
        assert sum(int(chunk_dedup.GEAR[data[i - j]]) << j for j in range(min(32, i + 1))) & 0xFFFFFFFF == int(h[i])
    cut = lambda d: {bytes(d[a:b]) for a, b in zip(*chunk_dedup.chunks(d, np.array([0, len(d)]))[:2], strict=True)}
    a, b = cut(data), cut(np.concatenate([data[:1000], np.frombuffer(b"inserted ", np.uint8), data[1000:]]))
    assert len(a & b) >= 0.95 * len(a)


# --- op8 ---------------------------------------------------------------------------------------------------------------


def plain_counts(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    at = {k for i, g in enumerate(grams) if grams.count(g) > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(at)


def test_quality_counts(spark):
    rows = [(0, None), (1, ""), (2, "a b c a b c"), (3, " x  y\n\nx  y\n x  y\t\v\f\r"), (4, "a " * 300), (5, "w1 w2 w3 w4 " * 60 + "é|日 # a"), (6, " ".join(f"w{i % 97} z{i % 13}" for i in range(300)))]
    rows += [(10 + i, t) for i, t in enumerate(odd_texts(200, "ab \n|#", most=80))]
    for r, (_, t) in zip(quality_rules.quality_report(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect(), rows, strict=True):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(t), t


def test_good_documents_stay(spark):
    d = "/root/testdata/sf0.01"
    q = quality_rules.op8_quality_rules(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("not base_failed").collect()
    assert all(r.kept == (r.quality == 1) for r in q)


# --- op9 ---------------------------------------------------------------------------------------------------------------


def luhn(x):
    return sum(v if i % 2 == 0 else (v * 2 - 9 if v > 4 else v * 2) for i, v in enumerate([int(c) for c in x][::-1])) % 10 == 0


def plain_spans(t):
    t, num = t or "", lambda x: re.sub("[^0-9]", "", x)
    return {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(num(m[0])) <= 19 and luhn(num(m[0]))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(num(m[0])) <= 15],
    }


def test_pii_spans(spark):
    rows = [None, "", "a@b.c_d@e.f", "a@b.c+d@e.f g@h", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.0003.04", "4111 1111 1111 1111 🙂 4111-1111-1111-1112", "+49 (0)30 1234567 é +1.2", "1" * 20000, "a" * 20000, "a@b.c " * 300]
    rows = list(enumerate(rows + odd_texts(1500, "0123456789....@@a-+ ()é🙂_%", 5, 80)))
    for r, (_, t) in zip(pii.pii_report(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect(), rows, strict=True):
        want = plain_spans(t)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(v) for v in want.values()], t
        text = ",".join(f"{k}:{a}:{b}" for k, v in want.items() for a, b in v)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.spans.startswith(text)


def test_added_kinds_and_mask(spark):
    rows = [(1, "IBAN DE89370400440532013000 ok"), (2, "DE89370400440532013001"), (3, "my ssn 123-45-6789"), (4, "room 123-45-6789"), (5, "🙂 a@b.cd, call +49 30 1234567 é")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert [r.spans for r in pii.pii_report(df).collect()] == ["iban:5:27", "", "ssn:7:18", "", "email:2:8,phone:15:29"]
    assert [r.scores for r in pii.pii_report(df).collect()] == ["1.0", "", "0.7", "", "0.9,1.0"]
    grouped = spark.createDataFrame([(1, "to DE89 3704 0044 0532 0130 00."), (2, "to DE89 3704 0044 0532 0130 01.")], "doc_id long, text string").coalesce(1)
    assert [r.text for r in pii.mask(grouped).collect()] == ["to [IBAN].", "to DE89 3704 0044 0532 0130 01."]
    assert [r.text for r in pii.mask(df).collect()] == ["IBAN [IBAN] ok", rows[1][1], "my ssn [SSN]", rows[3][1], "🙂 [EMAIL], call [PHONE] é"]


def test_pii_of_long_texts(spark):
    """300,000 matches in a text of 7 MB, and overlapping spans, against plain ones; time grows as the text does."""
    import time

    took = []
    for n in (30_000, 300_000):
        text = "write to 10.0.0.1 and " * n
        df = spark.createDataFrame([(1, text)], "doc_id long, text string").coalesce(1)
        begun = time.time()
        r = pii.pii_report(df).collect()[0]
        assert r.n_ip == n and r.base_sha256 == hashlib.sha256(",".join(f"ip:{9 + 22 * k}:{17 + 22 * k}" for k in range(n)).encode()).hexdigest()
        assert pii.mask(df).collect()[0].text == text.replace("10.0.0.1", "[IP]")
        took.append(time.time() - begun)
    assert took[1] < 30 * took[0]


def test_mask_of_overlapping_spans(spark):
    rnd = random.Random(6)
    bits = ["10.0.0.1", "a@b.cd", "+49 30 1234567", "4111 1111 1111 1111", "é🙂", "1", ".", "@", " ", "DE89370400440532013000", "ssn 123-45-6789", "DE89 3704 0044 0532 0130 00"]
    rows = [(k, "".join(rnd.choices(bits, k=rnd.randint(0, 400)))) for k in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    spans = {r.doc_id: r.spans for r in pii.pii_report(df).collect()}
    after = {r.doc_id: r.text for r in pii.mask(df).collect()}
    for k, t in rows:
        out, at = "", 0
        for a, b, kind in sorted((int(a), -int(b), kind) for kind, a, b in (x.split(":") for x in spans[k].split(",") if x)):
            if a >= at:
                out += t[at:a] + f"[{kind.upper()}]"
            at = max(at, -b)
        assert after[k] == out + t[at:]


# --- op10 --------------------------------------------------------------------------------------------------------------


def test_bpe_equals_tiktoken(texts):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = bpe.load_ranks(path)
    ref = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    odd = [*texts.values(), "", " ", "  a", "a\n b", "x  ", "日本語テスト 漢字　あ", "👩‍👩‍👧 emoji", "don't we'll I'M", "\x00\x01 a\x1c b", "a" * 3000, "=-" * 999, " " * 999, *odd_texts(3000, "abcdethino rst   \n.,'é日🙂0123456789#-_")]
    for t in odd:
        ids = own.encode(t or "")
        assert ids == np.array(ref.encode_ordinary(t or ""), "<u4").tobytes(), t
        assert "".join(bpe.decode_stream(np.frombuffer(ids, "<u4"), own.table, 3)) == (t or "")


def test_tables_start_anew(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_STATES", 50)
    monkeypatch.setattr(bpe, "MEMO_CHUNKS", 10)
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    own = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    ref = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for t in odd_texts(300, "abcdethinorst "):
        assert own.encode(t) == np.array(ref.encode_ordinary(t), "<u4").tobytes()


def test_incremental_utf8():
    data = "aé日🙂".encode() * 20
    for cut in (1, 2, 3, 5, 7):
        m = bpe.Utf8Stream()
        assert "".join(m.feed(data[k : k + cut]) for k in range(0, len(data), cut)) + m.finish() == data.decode()
    m = bpe.Utf8Stream()
    assert m.feed(b"a\xe6\x97") == "a" and m.finish() == "\ufffd"

def test_incremental_utf8_of_any_bytes():
    rnd = random.Random(8)
    some = [0x00, 0x41, 0x7F, 0x80, 0x8F, 0x90, 0x9F, 0xA0, 0xBF, 0xC0, 0xC2, 0xDF, 0xE0, 0xE1, 0xED, 0xEF, 0xF0, 0xF1, 0xF4, 0xF5, 0xFF]
    for _ in range(4000):
        data = bytes(rnd.choice(some) for _ in range(rnd.randint(0, 12)))
        m, k, out = bpe.Utf8Stream(), 0, ""
        while k < len(data):
            n = rnd.randint(1, 4)
            out, k = out + m.feed(data[k : k + n]), k + n
        assert out + m.finish() == data.decode("utf-8", "replace"), data


def test_words_of_megabytes(monkeypatch):
    """Long words take time as they are long, and tables start anew within them."""
    import time

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks, rnd = bpe.load_ranks(path), random.Random(2)
    ref = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(bpe, "MEMO_STATES", 20_000)
    own, took = bpe.Encoder(ranks, public_tokenizers.PATTERN), []
    for n in (50_000, 200_000):
        word = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=n))
        begun = time.process_time()
        ids = own.encode(word)
        took.append(time.process_time() - begun)
        assert len(own.machine.keys) <= 20_002
        # the plain library is quadratic: compare the beginning, up to where a later letter could matter
        if n == 50_000:
            assert ids == np.array(ref.encode_ordinary(word), "<u4").tobytes()
        assert "".join(bpe.decode_stream(np.frombuffer(ids, "<u4"), own.table)) == word
    assert took[1] < 12 * took[0]
    assert "".join(bpe.decode_stream(np.frombuffer(own.encode("ab" * 5_000_000), "<u4"), own.table)) == "ab" * 5_000_000
