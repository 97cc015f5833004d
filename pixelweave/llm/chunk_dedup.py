"""Substring deduplication by content-defined chunks.

A gear rolling hash over the last 32 bytes decides where chunks end: after white space where its top bits are zero
(one in ``2**WORD_BITS`` words), or, far from white space, at any character where more of them are (one in
``2**WIDE_BITS``). Chunks depend on nearby bytes only, so an insertion changes the chunks it touches and no others.

What is compared, by digest, are windows: the fewest consecutive chunks from each chunk on that have MIN_WORDS words or
more; far from white space WIDE_WORD characters are a word. A window that stands elsewhere too is repeated; a run of
chunks in repeated windows is a repeated passage. Of each window the first place (smallest doc_id, then a digest of the
text, then position) stays whole: a chunk is removed only if it is in repeated windows and all of these stood earlier.
A bitmap of digests that may be repeated spares the others a shuffle; the result doesn't depend on it.

Null texts have no chunks. Rows of one doc_id count as one document each; equal rows have equal places, so a place that
is first stays in all of them. A null doc_id comes before all others. Texts of any length are taken whole. Extra
columns are ignored by reports and kept by ``remove_repeats``; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import apart, apply_groups, arrow_batch, bitmap, discard, filter_bits, id_text, map_batches, marked, slices, written
from .hashing import U, WHITE, byte_values, mix, span_hashes
from .jaccard_join import COUNT_BITS, blobs_of, bucket_bits, bucketed, flush_size, from_planes, planes, steps
from .pii import bind

WORD_BITS, WIDE_BITS = 2, 3
MIN_WORDS = 16
FAR, FAR_ASCII, WIDE_WORD = 32, 256, 4
GEAR = (byte_values(0x6EA4) >> U(32)).astype(np.uint32)
#: log2 of the most slots of the bitmap. Some 5 million repeated windows a GB fill an eighth of it at 30 GB.
MOST_BITS = 30
#: Text bytes of one step: each takes some seventy bytes while chunks are found.
SLICE = 1 << 18
SEED_A, SEED_B = 0xA11CE, 0xB0B
NONE = -(1 << 63)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[data[i - j]] << j for j < 32, by doubling the window five times."""
    h = GEAR[data]
    k = 1
    while k < 32:
        more = h.copy()
        more[k:] += h[:-k] << np.uint32(k) if k < len(h) else 0
        h, k = more, 2 * k
    return h


def far_from_white(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Bytes that stand FAR bytes (of ASCII: FAR_ASCII) or more behind white space or the start of their text."""
    place = np.arange(len(data))
    white = np.where(WHITE[data], place, -1)
    begin = offs[offs < len(data)]
    white[begin] = np.where(WHITE[data[begin]], begin, begin - 1)
    return place - np.maximum.accumulate(white) >= np.where(data < 0x80, FAR_ASCII, FAR)


def chunks(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document index of the chunks of concatenated texts."""
    h = gear_hash(data)
    new_char = np.ones(len(data), bool)
    new_char[:-1] = (data[1:] & 0xC0) != 0x80
    # no removal shall begin inside a word of spaced text, nor in a long address
    far = far_from_white(data, offs)
    cut = (WHITE[data] & (h >> np.uint32(32 - WORD_BITS) == 0)) | (new_char & far & (h >> np.uint32(32 - WIDE_BITS) == 0))
    at = np.flatnonzero(cut)
    # only where the whole window lies within the text
    own = np.searchsorted(offs, at, "right") - 1
    at = at[at - offs[own] >= 31] + 1
    edges = np.unique(np.concatenate([offs, at]))
    starts, ends = edges[:-1], edges[1:]
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def chunk_words(data: np.ndarray, offs: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words that begin in each chunk, and one for each WIDE_WORD characters far from white space; at least one."""
    first_word = ~WHITE[data]
    first_word[1:] &= WHITE[data[:-1]]
    edge = offs[offs < len(data)]
    first_word[edge] = ~WHITE[data[edge]]
    count = np.r_[0, np.cumsum(first_word)]
    wide = np.r_[0, np.cumsum(far_from_white(data, offs) & ((data & 0xC0) != 0x80))]
    return np.maximum(1, count[ends] - count[starts] + (wide[ends] - wide[starts]) // WIDE_WORD)


def windows(size: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last chunk of every window: from each chunk on the fewest with MIN_WORDS words within its text."""
    n, total = len(size), np.r_[0, np.cumsum(size)]
    last = np.searchsorted(total, total[:-1] + MIN_WORDS) - 1
    fits = (last < n) & (own[np.minimum(last, n - 1)] == own)
    return np.flatnonzero(fits), last[fits]


def repeated_keys(docs: DataFrame, bits: int) -> DataFrame:
    """A hash of the first bits + COUNT_BITS bits of the digests of all windows that occur twice or more in all texts (one
    column, h). Each task first reduces its windows to two entries a key at most, so that a window that is everywhere
    costs two a task."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            key, n = np.unique(np.concatenate(held) >> U(64 - bits - COUNT_BITS), return_counts=True)
            held.clear()
            key = np.repeat(key, np.minimum(n, 2))
            low = (key & U((1 << COUNT_BITS) - 1)).astype(np.uint32)
            yield from bucketed(bits, key << U(64 - bits - COUNT_BITS), lambda a, b: planes(steps(low[a:b])))

        for batch in batches:
            for _, data, offs in slices(batch, limit=SLICE):
                if len(data):
                    starts, ends, own = chunks(data, offs)
                    p, q = windows(chunk_words(data, offs, starts, ends), own)
                    held.append(span_hashes(data, starts[p], ends[q], SEED_A))
                if sum(map(len, held)) > flush_size(bits):
                    yield from flush()
        if held:
            yield from flush()

    def gather(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        low = np.sort(np.concatenate([np.cumsum(from_planes(x, len(x) // 4), dtype=np.uint32) for x in blobs_of(table)]))
        again = np.unique(low[1:][low[1:] == low[:-1]]).astype(U)
        return pa.table({"h": pa.array(mix((U(bucket) << U(COUNT_BITS)) + again).view(np.int64), pa.int64())})

    return apply_groups(map_batches(id_text(docs, "text"), emit, "bucket int, blob binary"), "bucket", gather, "h long")


def repeat_bitmap(docs: DataFrame, bits: int) -> np.ndarray:
    """Marks two slots of each key that may be repeated, the top and the low bits of its hash: 16 slots a key, 128 MB at most."""
    found = written(repeated_keys(docs, bits), "repeats")
    own = filter_bits(found.count(), MOST_BITS)
    out = bitmap(found.select(F.explode(F.array(F.shiftrightunsigned("h", 64 - own), F.col("h").bitwiseAND((1 << own) - 1))).alias("slot")), own)
    discard(found)
    return out


def may_repeat(digest: np.ndarray, bits: int, marks: np.ndarray) -> np.ndarray:
    own = len(marks).bit_length() + 2
    h = mix(digest >> U(64 - bits - COUNT_BITS))
    return marked(marks, (h >> U(64 - own)).astype(np.int64)) & marked(marks, (h & U((1 << own) - 1)).astype(np.int64))


PLACES = pa.schema([(c, pa.int64()) for c in ("row", "doc_id", "text64")] + [(c, pa.int32()) for c in ("ord", "chunks", "word", "words")] + [("start", pa.int64()), ("size", pa.int32()), ("a", pa.int64()), ("b", pa.int32())])


def text64(text: Column) -> Column:
    """The first half of a text's MD5 as a signed number."""
    return F.conv(F.substring(F.md5(text), 1, 16), 16, -10).cast("long")


def candidate_places(docs: DataFrame, marks, bits: int) -> DataFrame:
    """Windows that may be repeated: row (a number of its text in this scan), first chunk, chunks, words before and words,
    place, digests."""
    from pyspark import TaskContext

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for rows, data, offs in slices(batch, limit=SLICE):
                if len(data):
                    starts, ends, own = chunks(data, offs)
                    size = chunk_words(data, offs, starts, ends)
                    p, q = windows(size, own)
                    a = span_hashes(data, starts[p], ends[q], SEED_A)
                    hit = may_repeat(a, bits, marks.value)
                    p, q, a = p[hit], q[hit], a[hit]
                    begun = np.searchsorted(starts, offs[own[p]])
                    total = np.r_[0, np.cumsum(size)]
                    some, raw = np.zeros(len(offs) - 1, np.int64), data.tobytes()
                    for k in np.unique(own[p]).tolist():
                        some[k] = int.from_bytes(hashlib.md5(raw[offs[k] : offs[k + 1]]).digest()[:8], "big", signed=True)
                    yield arrow_batch(
                        PLACES, row=row + own[p], doc_id=rows.column(0).take(pa.array(own[p])), text64=some[own[p]], ord=(p - begun).astype(np.int32), chunks=(q - p + 1).astype(np.int32), word=(total[p] - total[begun]).astype(np.int32), words=(total[q + 1] - total[p]).astype(np.int32),
                        start=(starts - offs[own])[p], size=(ends[q] - starts[p]).astype(np.int32), a=a.view(np.int64), b=(span_hashes(data, starts[p], ends[q], SEED_B) >> U(32)).astype(np.uint32).view(np.int32),
                    )
                row += rows.num_rows

    return map_batches(id_text(docs), emit, "row long, doc_id long, text64 long, ord int, chunks int, word int, words int, start long, size int, a long, b int")


def repeated_places(docs: DataFrame) -> DataFrame:
    """Pieces of repeated passages: row, doc_id, text64, ord, run (its passage), start, size (bytes), chunks, words, the first
    place (its own where it stays), places of its window, removed. A piece goes from the start of a window to that of the next
    one or to its end, cut where windows end that stay."""
    bits = bucket_bits(docs)
    marks = docs.sparkSession.sparkContext.broadcast(repeat_bitmap(docs, bits))  # 128 MB at most
    places = written(candidate_places(docs, marks, bits), "places")
    marks.unpersist()
    place = F.struct(F.coalesce("doc_id", F.lit(NONE)).alias("doc"), "text64", "start")
    firsts = places.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("places")).where("places > 1")
    is_first = place == F.col("first")
    edge = lambda o, w, s: F.struct(o.alias("ord"), w.alias("word"), s.alias("byte"))
    begin, end = edge(F.col("ord"), F.col("word"), F.col("start")), edge(F.col("ord") + F.col("chunks"), F.col("word") + F.col("words"), F.col("start") + F.col("size"))
    found = places.join(firsts, ["a", "b"]).select("row", "doc_id", "text64", "ord", "word", "chunks", "words", "start", "size", "places", F.col("first.doc").alias("to"), (F.col("first.start") - F.col("start")).alias("shift"), is_first.alias("is_first"))
    # windows of a text in order end in order too: one that begins later never ends before
    w = Window.partitionBy("row").orderBy("ord", "chunks")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    found = found.select("row", "doc_id", "text64", "places", "to", "shift", begin.alias("begin"), end.alias("full"), F.max(F.when(F.col("is_first"), end)).over(so_far).alias("stays"), F.lead(begin).over(w).alias("next"), F.lag(end).over(w).alias("before"))
    found = found.withColumn("end", F.least("full", "next")).withColumn("cut", F.least("end", F.greatest("begin", "stays")))
    # a run begins where no window before reaches
    fresh = F.when(F.coalesce(F.col("before.byte") < F.col("begin.byte"), F.lit(True)), F.col("begin.ord"))
    found = found.withColumn("run", F.max(fresh).over(Window.partitionBy("row").orderBy("begin.ord", "full.ord").rowsBetween(Window.unboundedPreceding, 0)))
    piece = lambda x, y, removed: F.struct(F.col(f"{x}.ord").alias("ord"), F.col(f"{x}.byte").alias("start"), (F.col(f"{y}.byte") - F.col(f"{x}.byte")).cast("int").alias("size"), (F.col(f"{y}.ord") - F.col(f"{x}.ord")).alias("chunks"), (F.col(f"{y}.word") - F.col(f"{x}.word")).alias("words"), F.lit(removed).alias("removed"))
    own = found.select("row", "doc_id", "text64", "run", "places", "to", "shift", F.explode(F.array(piece("begin", "cut", False), piece("cut", "end", True))).alias("p")).where("p.size > 0")
    first_doc = F.when(F.col("p.removed"), F.nullif(F.col("to"), F.lit(NONE))).otherwise(F.col("doc_id"))
    first_start = F.col("p.start") + F.when(F.col("p.removed"), F.col("shift")).otherwise(0)
    return own.select("row", "doc_id", "text64", "p.ord", "run", "p.start", "p.size", "p.chunks", "p.words", first_doc.alias("first_doc_id"), first_start.alias("first_start"), "places", "p.removed")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row for each repeated passage of each text: doc_id, place (bytes), chunks, words, removed chunks and bytes,
    the place where its first chunk came first, and in how many places its most frequent window stands."""
    end = F.max(F.col("start") + F.col("size"))
    p = repeated_places(docs).groupBy("row", "run").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start_byte"), end.alias("end_byte"), F.sum("chunks").alias("n_chunks"), F.sum("words").alias("n_words"), F.coalesce(F.sum(F.when(F.col("removed"), F.col("chunks"))), F.lit(0)).alias("removed_chunks"),
        F.coalesce(F.sum(F.when(F.col("removed"), F.col("size"))), F.lit(0)).alias("removed_bytes"), F.min_by(F.struct("first_doc_id", "first_start"), "start").alias("first"), F.max("places").alias("places"),
    )
    return p.select("doc_id", "start_byte", "end_byte", "n_chunks", "n_words", "removed_chunks", "removed_bytes", F.col("first.first_doc_id").alias("first_doc_id"), F.col("first.first_start").alias("first_start_byte"), "places")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Texts without the chunks that are removed, other columns as they are (n_chars, if there, follows the text).

    Places go to rows by doc_id and 64 bits of the text's MD5; of rows in which both are equal each loses what the first
    one does. Only rows that may lose something are shuffled.
    """
    spans = F.sort_array(F.collect_list(F.struct("start", (F.col("start") + F.col("size")).alias("end"))))
    gone = repeated_places(docs).where("removed").groupBy("row").agg(F.first("doc_id").alias("pw_id"), F.first("text64").alias("pw_text"), spans.alias("pw_gone"))
    gone = gone.groupBy("pw_id", "pw_text").agg(F.min_by("pw_gone", "row").alias("pw_gone"))
    key = lambda d, t: F.xxhash64(F.coalesce(d, F.lit(NONE)), t)
    gone = written(gone.withColumn("pw_key", key(F.col("pw_id"), F.col("pw_text"))), "gone")
    own = docs["doc_id"].cast("long")
    maybe, sure = apart(docs, key(own, text64(docs["text"])), gone, "pw_key")
    joined = maybe.join(gone.drop("pw_key"), maybe["doc_id"].cast("long").eqNullSafe(gone["pw_id"]) & (text64(maybe["text"]) == gone["pw_text"]), "left").drop("pw_id", "pw_text")
    # what stays lies between the end of one removed chunk and the start of the next; the bytes are made once a text
    edges = F.concat(F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))), F.col("pw_gone"))
    starts = F.concat(F.transform("pw_gone", lambda x: x["start"]), F.array(F.octet_length("text").cast("long")))
    piece = lambda raw, a, b: F.substr(raw, (a + 1).cast("int"), (b - a).cast("int")).cast("string")
    new = bind(F.col("text").cast("binary"), lambda raw: F.array_join(F.zip_with(edges, starts, lambda e, s: piece(raw, e["end"], s)), ""))
    out = joined.withColumn("text", F.when(F.col("pw_gone").isNotNull() & F.col("text").isNotNull(), new).otherwise(F.col("text"))).drop("pw_gone")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return sure.unionByName(out)


def op7_chunk_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return repeated_passages(table(spark, sf_dir, "documents"))
