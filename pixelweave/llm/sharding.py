"""Extendible hashing of documents into shards under a byte limit, in DataFrame operations.

The directory is indexed by prefix bits of a hash of doc_id. It starts at the depth at which shards would fit if bytes
were spread evenly; only buckets over the limit split on another bit, until each fits. Sizes are pre-aggregated by a
prefix some bits longer than the start, so that a round of splits reads documents once; only what is still too large
takes another round with longer prefixes. Documents with one doc_id share their hash, so after HASH_BITS the bits go on
with a hash of the whole row. Equal rows can't be told apart by bits: where they are too large together, their bucket
overflows into pages (``bits-page``). So only a single row above the limit makes a shard too large (``over_limit``).

The result carries no text: a document's shard is found by joining (doc_id, hash, size) with the leaves of its start
prefix. Null texts have no bytes; a null doc_id hashes as the empty string; an empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SHARD_BYTES = 64 << 20
HASH_BITS = 60
MORE_BITS = 8
DEPTH = 2 * HASH_BITS


def hash60(x: Column) -> Column:
    """The first 60 bits of MD5 as a non-negative long."""
    return F.conv(F.substring(F.md5(x.cast("binary")), 1, 15), 16, 10).cast("long")


def prefix(depth: int) -> Column:
    """The first depth bits of (h1, h2) as a bit string of its own length, 0s and 1s."""
    bits = lambda c: F.lpad(F.bin(c), HASH_BITS, "0")
    if depth <= HASH_BITS:
        return F.substring(bits("h1"), 1, depth)
    return F.concat(bits("h1"), F.substring(bits("h2"), 1, depth - HASH_BITS))


def hashed(docs: DataFrame) -> DataFrame:
    own = sorted(docs.columns)
    row = F.to_json(F.struct(*(F.col(c) for c in own)))
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), hash60(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("h1"), hash60(row).alias("h2"))


def leaves(keys: DataFrame, limit: int) -> DataFrame:
    """bucket (bit string), depth, bytes and docs of every leaf of the directory."""
    total = keys.agg(F.sum("n_bytes")).first()[0] or 0
    start = max(0, math.ceil(math.log2(max(1.0, total / limit))))
    done, open_keys, first = None, keys, start
    while True:
        last = min(DEPTH, first + MORE_BITS)
        fine = written(open_keys.groupBy(prefix(last).alias("p")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs")), "prefixes")
        # every prefix of each fine one with its total; the leaf is the shortest that fits, or the longest there is
        depth = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("depth")
        sizes = fine.select("bytes", "docs", "p", depth).groupBy(F.col("depth"), F.expr("substring(p, 1, depth)").alias("bucket")).agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"))
        sizes = written(sizes, "bucket-sizes")
        over = sizes.where(F.col("bytes") > limit).select(F.col("depth").alias("d"), F.col("bucket").alias("b"))
        fits = sizes.where((F.col("bytes") <= limit) | (F.col("docs") == 1) | ((F.col("depth") == last) & F.lit(last == DEPTH)))
        alone = (F.col("docs") == 1) & (F.col("bytes") > limit)
        parent = (F.col("d") == F.col("depth") - 1) & (F.col("b") == F.expr("substring(bucket, 1, depth - 1)"))
        # a bucket exists if its parent was split: over the limit with more than one document
        split = sizes.where((F.col("bytes") > limit) & (F.col("docs") > 1)).select(F.col("depth").alias("d"), F.col("bucket").alias("b"))
        found = fits.where(F.col("depth") == first).unionByName(fits.where(F.col("depth") > first).join(split, parent, "left_semi"))
        done = found if done is None else done.unionByName(found)
        left = over.join(split, ["d", "b"], "left_semi").where(F.col("d") == last).select("b")
        if last == DEPTH or left.isEmpty():
            return done.select("bucket", "depth", "bytes", "docs")
        open_keys = written(open_keys.join(left, prefix(last) == F.col("b"), "left_semi"), "open")
        # the next round begins one bit below what it has found too large
        first = last + 1


def extendible_shards(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, shard (bits), depth, shard_bytes, shard_docs and over_limit of every row."""
    keys = written(hashed(docs), "hashed")
    tree = written(leaves(keys, limit), "leaves")
    start = tree.agg(F.min("depth")).first()[0] or 0
    slot = F.substring("bucket", 1, start)
    directory = tree.groupBy(slot.alias("slot")).agg(F.collect_list(F.struct("bucket", "depth", "bytes", "docs")).alias("leaves"))
    # sort-merge: a slot's leaves stand in one row, and documents of a slot are spread by the hash
    whole = prefix(DEPTH)
    own = keys.withColumn("bits", whole).withColumn("slot", F.substring("bits", 1, start)).join(directory, "slot")
    leaf = F.element_at(F.filter("leaves", lambda x: F.startswith(F.col("bits"), x["bucket"])), 1)
    out = own.select("doc_id", "n_bytes", leaf.alias("leaf"))
    out = out.select("doc_id", "n_bytes", F.col("leaf.bucket").alias("shard"), F.col("leaf.depth").cast("int").alias("depth"), F.col("leaf.bytes").alias("shard_bytes"), F.col("leaf.docs").alias("shard_docs"), (F.col("leaf.bytes") > limit).alias("over_limit"))
    full = (F.col("depth") == DEPTH) & F.col("over_limit") & (F.col("n_bytes") <= limit)
    if tree.where((F.col("depth") == DEPTH) & (F.col("bytes") > limit)).isEmpty():
        return out
    return out.where(~full).unionByName(paged(out.where(full), limit))


def paged(rows: DataFrame, limit: int) -> DataFrame:
    """Equal rows of full buckets, counted and dealt into pages under the limit; as many rows as before."""
    per = F.floor(F.lit(limit) / F.col("n_bytes"))
    own = rows.groupBy(*rows.columns).agg(F.count("*").alias("pw_copies")).withColumn("pw_per", per)
    pages = own.withColumn("pw_page", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("pw_copies") - 1) / F.col("pw_per")))))
    pages = pages.withColumn("shard_docs", F.least("pw_per", F.col("pw_copies") - F.col("pw_page") * F.col("pw_per")))
    each = pages.withColumn("pw_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("shard_docs"))))
    return each.select("doc_id", "n_bytes", F.concat("shard", F.lit("-"), F.col("pw_page").cast("string")).alias("shard"), "depth", (F.col("shard_docs") * F.col("n_bytes")).alias("shard_bytes"), "shard_docs", F.lit(False).alias("over_limit"))


def op2_extendible_sharding(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return extendible_shards(table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH RECURSIVE k AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes, lpad(bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT), {HASH_BITS}, '0') AS bits FROM documents),
t AS (SELECT greatest(0, ceil(log2(greatest(1.0, sum(n_bytes) / {SHARD_BYTES}.0))))::INT AS start FROM k),
s AS (SELECT substr(bits, 1, d) AS bucket, d AS depth, sum(n_bytes)::BIGINT AS bytes, count(*) AS docs FROM k, t, unnest(range(start, start + 24)) AS u(d) GROUP BY ALL),
r AS (
  SELECT s.* FROM s, t WHERE depth = start
  UNION ALL SELECT s.* FROM r JOIN s ON s.depth = r.depth + 1 AND substr(s.bucket, 1, r.depth::INT) = r.bucket WHERE r.bytes > {SHARD_BYTES} AND r.docs > 1)
SELECT doc_id, n_bytes, bucket AS shard, depth::INT AS depth, bytes AS shard_bytes, docs AS shard_docs, bytes > {SHARD_BYTES} AS over_limit
FROM k JOIN r ON substr(bits, 1, r.depth::INT) = r.bucket WHERE bytes <= {SHARD_BYTES} OR docs = 1
"""
