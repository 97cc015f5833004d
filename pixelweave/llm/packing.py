"""Packing token sequences by non-negative least squares over shallow length combinations.

Whole windows are cut from long documents first. What remains of each document is one piece shorter than a window;
only the histogram of these lengths (fewer than ``window`` bins) reaches the driver. There ``plan`` enumerates
combinations of at most eight lengths that fill a window, solves repeat counts against the histogram by non-negative
least squares and rounds them, does so again with the residual histogram while that places more, and packs what is left
greedily, cutting a piece where nothing else fills a gap.

The plan maps (length, rank of the piece among those of that length) to (sequence, offset) by ranges of ranks, so its
size depends on the number of lengths and not on the number of documents. Ranks come from counts for each task of the
tokenizing stage and a running total over tasks; both sides of their join are shuffled, at every size, as these counts
grow with the tasks.

A text of any length is tokenized whole.

Null texts are empty and still carry the closing id. Rows with equal or null doc_id are packed as rows of their own.
Extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import CACHES, arrow_batch, id_text, map_batches, slices, written

WINDOW = 4096
END_ID = 2
#: A gap below this is left as padding; a larger one is filled by cutting a piece.
SMALL_GAP = 16
MEMO_CHUNKS = 1_000_000
#: Times that the counts that are left are solved anew.
ROUNDS = 16
#: Sequences that are one whole window of one document are numbered from here.
WHOLE_BASE = 1 << 62


def id_bytes(vocabulary: int) -> int:
    """Bytes that an id is stored in."""
    return 2 if vocabulary <= 1 << 16 else 4


class ChunkIds(dict):
    """Ids of texts by their runs between white space, which the tokenizer drops and never looks across.

    In a Latin-1 text, where composition changes nothing and letters of either case give the same ids, runs are taken
    in lower case; points and commas between letters and white space are pieces of their own to the tokenizer, so they
    become runs too. Unknown words of a batch are encoded together.
    """

    #: A point or comma beside another sign or digit may be part of a longer piece.
    BESIDE = re.compile(r"[.,](?:(?<=[^\sa-zà-öø-ÿ][.,])|(?=[^\sa-zà-öø-ÿ]))").search
    WIDE = re.compile("[^\x00-\xff]").search
    PYTHON_SPACE = "\x1c\x1d\x1e\x1f"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.old: dict[str, bytes] = {}
        self.unit = id_bytes(self.tokenizer.get_vocab_size())
        self.bytes = [k.to_bytes(self.unit, "little") for k in range(self.tokenizer.get_vocab_size())]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, f"<u{self.unit}").tobytes()

    def runs(self, text: str) -> list[str] | None:
        if any(c in text for c in self.PYTHON_SPACE):
            return None
        if "<|" not in text and (text.isascii() or not self.WIDE(text)):
            text = text.lower()
            if not self.BESIDE(text):
                text = text.replace(".", " . ").replace(",", " , ")
        return text.split()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        if len(self) > MEMO_CHUNKS // 2:  # two generations: what is still in use moves to the new one
            self.old = dict(self)
            self.clear()
        split = [self.runs(x) for x in texts]
        new = set().union(*(x for x in split if x)).difference(self)
        if self.old:
            known = new.intersection(self.old)
            self.update(zip(known, map(self.old.__getitem__, known), strict=True))
            new -= known
        # a lower-case ASCII word is one piece, the same before and after normalization: the merges alone remain
        own, merged = self.bytes, self.tokenizer.model.tokenize
        for x in new:
            if x.isascii() and x.isalpha() and x.islower():
                self[x] = b"".join([own[t.id] for t in merged(x)])
        words = [x for x in new if not x.isascii() and x.isalpha() and not self.WIDE(x) and x == x.lower()]
        for k in range(0, len(words), 4096):
            some = words[k : k + 4096]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids, at = np.array(found.ids, f"<u{self.unit}").tobytes(), np.array(found.word_ids)
            edges = (self.unit * np.searchsorted(at, np.arange(len(some) + 1))).tolist()
            self.update(zip(some, [ids[i:j] for i, j in zip(edges[:-1], edges[1:], strict=True)], strict=True))
        get = self.__getitem__
        return [self.whole(t) if x is None else b"".join(map(get, x)) for t, x in zip(texts, split, strict=True)]

    def __missing__(self, chunk: str) -> bytes:
        found = self.whole(chunk)
        if len(chunk) < 64:
            self[chunk] = found
        return found


_chunks: dict[str, ChunkIds] = {}


def chunk_ids(path: str) -> ChunkIds:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    CACHES["packing"] = _chunks.clear
    if path not in _chunks:
        _chunks[path] = ChunkIds(path)
    return _chunks[path]


TOKENIZED = pa.schema([("doc_id", pa.int64()), ("part", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("rem", pa.int32()), ("rank", pa.int64()), ("whole", pa.int64()), ("ids", pa.binary())])
TOKENIZED_DDL = "doc_id long, part long, row long, n long, rem int, rank long, whole long, ids binary"


def tokenize(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Ids of each text and the closing id, the length of its last piece and that piece's rank within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = chunk_ids(path), TaskContext.get().partitionId()
        seen = np.zeros(window, np.int64)
        row = whole = 0
        close = int(end_id).to_bytes(own.unit, "little")
        for batch in batches:
            for rows, _, _ in slices(batch, limit=4 << 20):
                texts = [x or "" for x in rows.column(1).to_pylist()]
                ids = [x + close for x in own.encode_all(texts)]
                n = np.array([len(x) // own.unit for x in ids], np.int64)
                rem, ranks, wholes = n % window, np.empty(len(n), np.int64), np.empty(len(n), np.int64)
                for k, (r, w) in enumerate(zip(rem.tolist(), (n // window).tolist(), strict=True)):
                    ranks[k], wholes[k] = seen[r], whole
                    seen[r] += 1
                    whole += w
                yield arrow_batch(TOKENIZED, doc_id=rows.column(0), part=np.full(len(n), part), row=np.arange(row, row + len(n)), n=n, rem=rem.astype(np.int32), rank=ranks, whole=wholes, ids=ids)
                row += len(n)

    return map_batches(id_text(docs), run, TOKENIZED_DDL, "packing")


def combinations(lengths: np.ndarray, counts: np.ndarray, window: int, slack: int, depth: int = 6, thirds: int = 8, mixed: int = 6) -> np.ndarray:
    """Rows of at most depth + 2 lengths (0: none) whose sum is at most the window and short of it by ``slack`` at most.

    Each length one to ``depth`` times, alone or with one of the most frequent lengths, and the nearest complement of
    what they leave; and each length with one to depth + 1 others, each near an equal share of what is left, in ``mixed``
    variants, the last one again the nearest complement. A bounded number for each length.
    """
    out = []
    common = lengths[np.argsort(-counts, kind="stable")[:thirds]]
    for times in range(1, depth + 1):
        for second in [0, *common.tolist()]:
            left = window - times * lengths - second
            at = np.searchsorted(lengths, left, "right") - 1
            last = np.where((left > 0) & (at >= 0), lengths[np.maximum(at, 0)], 0)
            rows = np.zeros((len(lengths), depth + 2), np.int64)
            rows[:, :times], rows[:, depth], rows[:, depth + 1] = lengths[:, None], second, last
            out.append(rows[(left >= 0) & (rows.sum(axis=1) >= window - slack)])
    for parts in range(2, depth + 3):
        for variant in range(mixed):
            rows = np.zeros((len(lengths), depth + 2), np.int64)
            rows[:, 0] = lengths
            left = window - lengths
            for k in range(1, parts):
                share = left if k == parts - 1 else left // (parts - k)
                at = np.searchsorted(lengths, share, "right") - 1
                if k < parts - 1:  # others beside the nearest one: rows differ, and so do the lengths within one
                    at = at - (variant * (2 * k - 1)) % max(1, len(lengths))
                rows[:, k] = np.where((left > 0) & (at >= 0), lengths[np.maximum(at, 0)], 0)
                left = left - rows[:, k]
            out.append(rows[(left >= 0) & (left <= slack)])
    return np.unique(np.sort(np.concatenate(out), axis=1)[:, ::-1], axis=0)


def solve_counts(combos: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative x with least sum of squares of A x - histogram, by multiplicative updates (A and histogram >= 0)."""
    n = len(histogram)
    if not len(combos):
        return np.zeros(0)
    used = (combos > 0).astype(float)
    spread = lambda x: np.bincount(combos.ravel(), weights=(used * x[:, None]).ravel(), minlength=n)
    gather = lambda y: (y[combos] * used).sum(axis=1)
    x = np.maximum(histogram[combos[:, 0]] / np.maximum(1, np.bincount(combos[:, 0], minlength=n)[combos[:, 0]]), 1e-9)
    want = gather(histogram.astype(float))
    for _ in range(rounds):
        x = x * want / np.maximum(gather(spread(x)), 1e-12)
    return x


@dataclass
class Plan:
    """Ranges of ranks by length. cut 0: the piece stands in sequence base + (rank - start) at offset; otherwise its
    first ``cut`` ids do, and the rest is the piece of rank then + (rank - start) among those of length - cut."""

    key: np.ndarray
    size: np.ndarray
    base: np.ndarray
    offset: np.ndarray
    cut: np.ndarray
    then: np.ndarray
    sequences: int
    by_solution: int


def plan(histogram: np.ndarray, window: int = WINDOW, slack: int = 8, small_gap: int = SMALL_GAP) -> Plan:
    """histogram[length] pieces of each length below the window."""
    left = histogram.astype(np.int64).copy()
    total, used = left.copy(), np.zeros(window, np.int64)
    rules: list[tuple[int, int, int, int, int, int, int]] = []
    sequences = 0

    def place(pattern: list[tuple[int, int]], times: int) -> None:
        nonlocal sequences
        offset = 0
        for length, cut in pattern:
            rules.append((length, used[length], times, sequences, offset, cut, total[length - cut] if cut else 0))
            used[length] += times
            left[length] -= times
            if cut:
                left[length - cut] += times
                total[length - cut] += times
            offset += cut or length
        sequences += times

    for turn in range(ROUNDS):
        lengths = np.flatnonzero(left)
        lengths = lengths[lengths > 0]
        combos = combinations(lengths, left[lengths], window, slack) if len(lengths) else np.zeros((0, 1), np.int64)
        if not len(combos):
            break
        counts = solve_counts(combos, left, 60)
        first = combos[:, 0]
        # of each longest length the combinations with most repeats: rounding then loses little
        order = np.lexsort((-counts, first))
        rank = np.arange(len(order)) - np.searchsorted(first[order], first[order])
        combos = combos[order[rank < (1 if turn == 0 else 4)]]
        counts = solve_counts(combos, left, 200)
        before = sequences
        for k in np.argsort(-counts, kind="stable"):
            # first rounded down, so that large counts are shared as solved; what is left is solved anew and rounded up
            want = int(counts[k]) if turn == 0 else max(1, round(counts[k]))
            if not want:
                break
            pattern = [(int(x), 0) for x in combos[k] if x]
            times = min([want, *(int(left[x]) // sum(y == x for y, _ in pattern) for x, _ in pattern)])
            if times:
                place(pattern, times)
        if turn and sequences == before:
            break
    by_solution = sequences
    while left[1:].any():
        there = np.flatnonzero(left[1:]) + 1
        have = left.copy()
        pattern, gap = [], window
        while gap:
            fit = there[(there <= gap) & (have[there] > 0)]
            if len(fit):
                pattern.append((int(fit[-1]), 0))
                have[fit[-1]] -= 1
                gap -= int(fit[-1])
                continue
            more = there[(there > gap) & (have[there] > 0)]
            if gap >= small_gap and len(more):
                longest = int(more[np.argmax(have[more])])
                pattern.append((longest, gap))
                have[longest] -= 1
            break
        times = min(int(left[x]) // sum(y == x for y, _ in pattern) for x, _ in pattern)
        place(pattern, max(1, times))
    rules.sort()
    cols = np.array(rules, np.int64).reshape(-1, 7)
    return Plan((cols[:, 0] << 40) + cols[:, 1], cols[:, 2], cols[:, 3], cols[:, 4], cols[:, 5], cols[:, 6], sequences, by_solution)


def assign(p: Plan, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pieces of the given remainders: (row, start within the remainder, length, sequence, offset)."""
    row, start = np.arange(len(length)), np.zeros(len(length), np.int64)
    length, rank = length.astype(np.int64), rank.astype(np.int64)
    out = []
    while len(row):
        at = np.searchsorted(p.key, (length << 40) + rank, "right") - 1
        step = rank - (p.key[at] & ((1 << 40) - 1))
        cut = p.cut[at]
        out.append((row, start, np.where(cut > 0, cut, length), p.base[at] + step, p.offset[at]))
        go = cut > 0
        row, start, length, rank = row[go], (start + cut)[go], (length - cut)[go], (p.then[at] + step)[go]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 5


PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])
PIECES_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(tokenized: DataFrame, unit: int, window: int = WINDOW, keep_ids: bool = False) -> DataFrame:
    """Pieces of all tokenized documents (a written table; ids of ``unit`` bytes). With ``keep_ids`` each piece carries its ids."""
    counts = tokenized.where("rem > 0").groupBy("part", "rem").agg((F.max("rank") + 1).alias("cnt"))
    counts = written(counts, "piece-counts")
    histogram = np.zeros(window, np.int64)
    for r in counts.groupBy("rem").agg(F.sum("cnt").alias("cnt")).collect():  # fewer rows than the window is long
        histogram[r["rem"]] = r["cnt"]
    own = plan(histogram, window)
    before = F.sum("cnt").over(Window.partitionBy("rem").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shift = counts.select("part", "rem", F.coalesce(before, F.lit(0)).alias("shift"))
    schema = PIECES if keep_ids else pa.schema([f for f in PIECES if f.name != "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in slices(batch, "ids", 1 << 20):
                doc, part, n, rem, rank, whole = (rows.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3, 4, 5, 6))
                doc = rows.column(1)
                some = np.flatnonzero(rem > 0)
                row, at, size, seq, off = assign(own, rem[some], rank[some])
                row = some[row]
                at = at + (n - rem)[row]
                wholes = n // window
                w_row = np.repeat(np.arange(len(n)), wholes)
                w_k = np.arange(len(w_row)) - np.repeat(np.cumsum(wholes) - wholes, wholes)
                row, at = np.concatenate([w_row, row]), np.concatenate([w_k * window, at])
                size = np.concatenate([np.full(len(w_row), window), size])
                seq = np.concatenate([WHOLE_BASE + (part[w_row] << 36) + whole[w_row] + w_k, seq])
                off = np.concatenate([np.zeros(len(w_row), np.int64), off])
                raw = memoryview(np.frombuffer(data.tobytes(), f"<u{unit}").astype("<u4").tobytes())
                begin = offs[row] // unit * 4 + 4 * at
                spans = [raw[a : a + 4 * m] for a, m in zip(begin.tolist(), size.tolist(), strict=True)]
                more = {"ids": [bytes(x) for x in spans]} if keep_ids else {}
                yield arrow_batch(schema, doc_id=doc.take(pa.array(row)), start=at, length=size, ids_crc32=[zlib.crc32(x) for x in spans], doc_tokens=n[row], sequence_id=seq, offset=off, **more)

    joined = tokenized.join(shift.hint("shuffle_hash"), ["part", "rem"], "left").select("ids", "doc_id", "part", "n", "rem", (F.col("rank") + F.coalesce("shift", F.lit(0))).alias("rank"), "whole")
    return map_batches(joined, run, PIECES_DDL + (", ids binary" if keep_ids else ""))


def pack_documents(docs: DataFrame, path: str, window: int = WINDOW, keep_ids: bool = False) -> DataFrame:
    from tokenizers import Tokenizer

    unit = id_bytes(Tokenizer.from_file(path).get_vocab_size())
    return pack(written(tokenize(docs, path, window), "tokenized"), unit, window, keep_ids)


def op4_nnls_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .common import table

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
