"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns for every operator."""

import pytest
from pyspark.sql import functions as F

pytest.importorskip("pixelweave.llm")
import public_tokenizers

from pixelweave.llm import audio, bpe, chunk_dedup, jaccard_join, packing, pii, qda, quality_rules, reply_trees, sharding

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one two", "b"), (4, "one two", "b"), (5, "Wort " * 30_000, "b"), (6, "é🙂 x" * 300, None), (None, "no id here", "c"), (None, None, None)]
CLASH = ["row", "n", "rank", "label", "digest", "bucket", "start", "end", "pw_x", "n_words", "spans", "score", "a", "b", "i", "j", "grams", "h1", "slot"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string, source string").withColumn("n_chars", F.length("text").cast("long"))
    for c in CLASH:
        df = df.withColumn(c, F.lit(c))
    return df.repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2) for k in range(8)] + [(1, None), (None, 1), (3, 7)], "doc_id long, quality int")


ROWWISE = {
    "audio": lambda d, l: audio.telephony_audio(d),
    "sharding": lambda d, l: sharding.extendible_shards(d, 1000),
    "qda": lambda d, l: qda.quality_scores(d, l),
    "jaccard": lambda d, l: jaccard_join.jaccard_classes(d),
    "rules": lambda d, l: quality_rules.quality_report(d),
    "pii": lambda d, l: pii.pii_report(d),
    "bpe": lambda d, l: bpe.round_trip(d, BYTE, public_tokenizers.PATTERN),
}


@pytest.mark.parametrize("name", ROWWISE)
def test_every_row_has_a_result(name, docs, labels):
    assert ROWWISE[name](docs, labels).count() == len(DOCS)


@pytest.mark.parametrize("name", [*ROWWISE, "packing", "chunks", "mask", "keep_good", "keep_one", "remove"])
def test_empty_table(name, docs, labels):
    more = {
        "packing": lambda d, l: packing.pack_documents(d, WORD), "chunks": lambda d, l: chunk_dedup.repeated_passages(d), "mask": lambda d, l: pii.mask(d),
        "keep_good": lambda d, l: quality_rules.keep_good(d), "keep_one": lambda d, l: jaccard_join.keep_one(d), "remove": lambda d, l: chunk_dedup.remove_repeats(d),
    }
    assert (ROWWISE | more)[name](docs.limit(0), labels.limit(0)).count() == 0


def test_packing_covers_every_token(docs):
    rows = packing.pack_documents(docs, WORD, keep_ids=True).collect()
    assert sum(r.length for r in rows if r.start == 0 and r.doc_tokens == r.length) > 0
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)
    by = {}
    for r in rows:
        assert len(r.ids) == 4 * r.length
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= packing.WINDOW


def test_stages_keep_columns_and_rows(docs):
    for f, n in ((pii.mask, len(DOCS)), (chunk_dedup.remove_repeats, len(DOCS))):
        out = f(docs)
        assert out.columns == docs.columns and out.count() == n
    assert quality_rules.keep_good(docs).columns == docs.columns
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.select("doc_id").collect()) == [-1, -1, 1, 2, 3, 4, 5, 6]


def test_conversations(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, None, None), (None, 0, "user", "x"), (2, 5, "assistant", "\\h ### </turn>"), (3, 1, "a:b\n", "q\nw")]
    c = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in reply_trees.read_back(reply_trees.format_trees(reply_trees.linear_nodes(c))).collect()}
    assert {k: v.n_turns for k, v in out.items()} == {1: 3, None: 1, 2: 1, 3: 1}
    assert out[2].loss_chars == len("\\h ### </turn>")
    assert reply_trees.format_trees(reply_trees.linear_nodes(c.limit(0))).count() == 0


def sorted_rows(df):
    return sorted(df.collect(), key=repr)


RESULTS = ROWWISE | {
    "packing": lambda d, l: packing.pack_documents(d, WORD).select("doc_id", "start", "length", "ids_crc32", "doc_tokens"),
    "passages": lambda d, l: chunk_dedup.repeated_passages(d),
    "mask": lambda d, l: pii.mask(d).select("doc_id", "text"),
    "keep_good": lambda d, l: quality_rules.keep_good(d).select("doc_id", "text"),
    "keep_one": lambda d, l: jaccard_join.keep_one(d).select("doc_id", "text"),
    "remove": lambda d, l: chunk_dedup.remove_repeats(d).select("doc_id", "text"),
}
MORE = [(20, "the same passage " * 40, "a"), (21, "before it " + "the same passage " * 40, "a"), (22, "write to x@y.zz or 10.0.0.1 " * 30, "b")]


@pytest.mark.parametrize("name", RESULTS)
def test_clashing_columns_change_no_value(spark, docs, labels, name):
    more = spark.createDataFrame(MORE, "doc_id long, text string, source string").withColumn("n_chars", F.length("text").cast("long"))
    for c in docs.columns[4:]:
        more = more.withColumn(c, F.lit(c))
    whole = docs.unionByName(more)
    drop = {"sharding": ["shard"]}.get(name, [])  # whole rows are hashed there
    got, want = RESULTS[name](whole, labels), RESULTS[name](whole.select("doc_id", "text", "source", "n_chars"), labels)
    columns = [c for c in want.columns if c not in drop]
    if name == "sharding":
        assert got.count() == want.count()
    else:
        assert sorted_rows(got.select(*columns)) == sorted_rows(want.select(*columns))


def test_scores_of_odd_rows(spark, docs, labels):
    got = {}
    for r in qda.quality_scores(docs, labels).collect():
        got.setdefault(r.doc_id, set()).add((r.held_out, r.score, r.predicted))
    assert {s for _, s, _ in got[1]} == {s for _, s, _ in got[2]} and len(got[4]) == 1  # null is empty; equal rows are equal
    assert all(0 <= s <= 1 and p == int(s >= qda.THRESHOLD) for rows in got.values() for _, s, p in rows)
    none = qda.quality_scores(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {0}
    one = qda.quality_scores(docs, spark.createDataFrame([(4, 1)], "doc_id long, quality int")).collect()
    assert {r.score for r in one} <= {0.5, 1.0}


def test_ties_between_branches(spark):
    """Equal scores: the smaller leaf is the better branch; of a score that is missing nothing is added."""
    nodes = spark.createDataFrame([(1, 1, None, 0.0, "user", "q"), (1, 3, 1, 2.0, "assistant", "b"), (1, 2, 1, 2.0, "assistant", "a"), (1, 4, 1, None, "assistant", "c")], "conv_id long, node long, parent long, score double, role string, text string")
    got = {r.branch: r.leaf for r in reply_trees.format_trees(nodes, 3).collect()}
    assert got == {1: 2, 2: 3, 3: 4}


def test_long_conversations(spark):
    n = 3000
    rows = [(1, k, "assistant" if k % 2 else "user", f"t{k}") for k in range(n)]
    r = reply_trees.read_back(reply_trees.format_trees(reply_trees.linear_nodes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))).collect()[0]
    assert (r.n_turns, r.loss_chars) == (n, sum(len(f"t{k}") for k in range(1, n, 2)))


def test_texts_of_megabytes(spark, labels):
    """One text of many words, and one long word, whole in every operator."""
    words = [f"w{k % 5000}" for k in range(200_000)]
    long = [(1, " ".join(words), "a"), (2, "x" * 2_000_000, "a"), (3, "short", "b")]
    d = spark.createDataFrame(long, "doc_id long, text string, source string").repartition(2)
    assert {r.doc_id: r.n_bytes for r in audio.telephony_audio(d).collect()} == {k: len(t) for k, t, _ in long}
    assert {r.doc_id: r.n_shingles for r in jaccard_join.jaccard_classes(d).collect()} == {1: 5000, 2: 1, 3: 1}
    assert {r.doc_id: r.n_words for r in quality_rules.quality_report(d).collect()} == {1: 200_000, 2: 1, 3: 1}
    assert {r.doc_id for r in qda.quality_scores(d, labels).collect()} == {1, 2, 3}
    assert all(r.n_email == 0 for r in pii.pii_report(d).collect())
    import hashlib

    assert {r.doc_id: r.decoded_sha256 for r in bpe.round_trip(d, BYTE, public_tokenizers.PATTERN).collect()} == {k: hashlib.sha256(t.encode()).hexdigest() for k, t, _ in long}
    rows = packing.pack_documents(d, WORD).collect()
    assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())
    # within a text every window of 5000 words comes again: its first copy stays
    assert {r.doc_id: len(r.text) for r in chunk_dedup.remove_repeats(d).collect()}[1] < 0.1 * len(long[0][1])
