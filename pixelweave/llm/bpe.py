"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

Encoding. A state is (last settled token, bytes that are still open). Every prefix of the open bytes has one last token
of its own encoding, found among those that may stand after the last token of the shorter prefix; these prefixes form a
tree. A byte may still change only tokens behind positions from which some longer vocabulary entry could begin, so once
all such positions share an ancestor, the tokens up to it are emitted. The open part is bounded by the longest token
and states and transitions are made when first met. Memory is bounded: full tables start anew with the present state,
also within a word, so that time grows with the length of a word however long it is.

Two tokens may stand side by side if, as both are merged by rank, no pair across their border is due before the pieces
there have grown on.

Decoding joins token bytes and passes them through an incremental UTF-8 machine: a table of states and bytes runs from
an unfinished character at the end of a piece over the first bytes of the next one; what lies between whole characters
is decoded at once.

Nulls are empty texts (no tokens); every row is kept; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import contextlib
import gc
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CACHES, arrow_batch, id_text, map_batches, slices

MEMO_CHUNKS = 800_000
MEMO_STATES = 700_000
BYTES = [bytes((k,)) for k in range(256)]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The plain procedure: join the adjacent pair of lowest rank, leftmost first, until none is left."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        best = min(((r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None), default=None)
        if best is None:
            break
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.prefixes = {t[:k] for t in ranks for k in range(1, len(t))}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.spines: dict[bytes, tuple | None] = {}
        self.keys: list[tuple[bytes, bytes]] = []
        self.ids: dict[tuple[bytes, bytes], int] = {}
        self.trees: list[tuple[list[bytes], list[int], list[int]]] = []
        self.moves: dict[int, tuple[int, bytes]] = {}
        self.finals: list[bytes | None] = []
        self.reset()

    def reset(self) -> None:
        """Nothing but the first state."""
        for x in (self.keys, self.ids, self.trees, self.moves, self.finals):
            x.clear()
        self.state((b"", b""), ([b""], [-1], []))

    def state(self, key: tuple[bytes, bytes], tree: tuple[list[bytes], list[int], list[int]]) -> int:
        """tree: of each prefix of the open bytes the last token and where it begins, and the places from which on the open
        bytes begin a longer vocabulary entry."""
        to = self.ids[key] = len(self.keys)
        self.keys.append(key)
        self.trees.append(tree)
        self.finals.append(None)
        return to

    def edges(self, token: bytes) -> tuple[list[tuple[bytes, int]], list[tuple[bytes, int]]] | None:
        """The first and the last piece of a token while it is merged, from a byte to the whole, each with the rank
        that forms it; None if its own bytes don't merge to it."""
        if token not in self.spines:
            if len(token) == 1:
                self.spines[token] = [(token, -1)], [(token, -1)]
            elif merge(token, self.ranks) != [token]:
                self.spines[token] = None
            else:
                # the last merge joins two tokens that are encodings of their own bytes
                r = self.ranks[token]
                for k in range(1, len(token)):
                    a, b = token[:k], token[k:]
                    if self.ranks.get(a, r) < r and self.ranks.get(b, r) < r and (x := self.edges(a)) and (y := self.edges(b)) and self.apart(x[1], y[0], r):
                        self.spines[token] = [*x[0], (token, r)], [*y[1], (token, r)]
                        break
        return self.spines[token]

    def apart(self, last: list[tuple[bytes, int]], first: list[tuple[bytes, int]], below: int = 1 << 60) -> bool:
        """Whether no merge of rank under ``below`` joins two neighbours across their border, as both grow by rank."""
        i = j = 0
        while True:
            r = self.ranks.get(last[i][0] + first[j][0], below)
            a = last[i + 1][1] if i + 1 < len(last) else below
            b = first[j + 1][1] if j + 1 < len(first) else below
            if r < a and r <= b and r < below:
                return False
            if a >= below and b >= below:
                return True
            if a <= b:
                i += 1
            else:
                j += 1

    def beside(self, a: bytes, b: bytes) -> bool:
        """Whether b may follow a; each must be an encoding of its own bytes."""
        y = self.edges(b)
        if not y or not a:
            return bool(y)
        if (found := self.pairs.get((a, b))) is None:
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            found = self.pairs[a, b] = self.apart(self.edges(a)[1], y[0])
        return found

    def step(self, state: int, byte: int) -> tuple[int, bytes]:
        """A new transition: where it leads and the ids that it emits."""
        before, opened = self.keys[state]
        opened += BYTES[byte]
        last, parent, live = self.trees[state]
        n, ranks, prefixes = len(opened), self.ranks, self.prefixes
        # an entry that ends here begins where one was begun before this byte, or at it; so does one that goes on
        begins, still = -1, []
        for j in (*live, n - 1):
            token = opened[j:]
            if begins < 0 and token in ranks and self.beside(last[j], token):
                begins, last, parent = j, [*last, token], [*parent, j]
            if token in prefixes:
                still.append(j)
        if begins < 0:
            raise ValueError("a byte is missing from the vocabulary")
        cut = n
        for j in still:
            while j != cut:
                if j > cut:
                    j = parent[j]
                else:
                    cut = parent[cut]
            if not cut:
                break
        emitted, k = b"", cut
        while k > 0:
            emitted = ranks[last[k]].to_bytes(4, "little") + emitted
            k = parent[k]
        key = (last[cut], opened[cut:]) if cut else (before, opened)
        to = self.ids.get(key)
        if to is None:
            # Only positions that hang below the settled one can still be a parent.
            tree = ([key[0], *last[cut + 1 :]], [-1, *[k - cut for k in parent[cut + 1 :]]], [k - cut for k in still]) if cut else (last, parent, still)
            if len(self.keys) > MEMO_STATES:
                self.reset()
                return self.state(key, tree), emitted
            to = self.ids[key] = len(self.keys)
            self.keys.append(key)
            self.trees.append(tree)
            self.finals.append(None)
        self.moves[state << 8 | byte] = found = (to, emitted)
        return found

    def final(self, state: int) -> bytes:
        if (found := self.finals[state]) is None:
            last, parent, _ = self.trees[state]
            out, k = [], len(last) - 1
            while k > 0:
                out.append(self.ranks[last[k]].to_bytes(4, "little"))
                k = parent[k]
            found = self.finals[state] = b"".join(out[::-1])
        return found

    def encode(self, word: bytes) -> bytes:
        """Ids of one match as little-endian unsigned 32-bit integers."""
        if (whole := self.ranks.get(word)) is not None:
            return whole.to_bytes(4, "little")
        # appending to bytes costs least for short words, and the square of the length for long ones
        state, out, move = 0, b"" if len(word) < 256 else bytearray(), self.moves.get
        for byte in word:
            state, emitted = move(state << 8 | byte) or self.step(state, byte)
            out += emitted
        out += self.final(state)
        return bytes(out)


class Encoder(dict):
    """Ids of whole texts: splits into matches of the pattern, remembering what runs between certain matches gave."""

    #: A point or comma that isn't between a letter or digit and one or white space.
    BESIDE = re.compile(r"[.,](?:(?<![^\W_][.,])|(?=[^\w\s]|_))").search

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.machine = Transducer(ranks)
        self.matches = regex.compile(pattern).findall
        self.table = {v: k for k, v in ranks.items()}
        # the runs below are independent under patterns that split like this one
        self.splits = self.matches("ab 12.\ncd, e") == ["ab", " 12", ".", "\n", "cd", ",", " e"]
        self.ragged = regex.compile(r"^\s|\s$|\s\s|\x00").search

    def fresh(self, chunk: str) -> bytes:
        encode = self.machine.encode
        return b"".join(encode(x.encode()) for x in self.matches(chunk))

    def __missing__(self, chunk: str) -> bytes:
        word = chunk[1:] if chunk[:1] == " " else chunk
        found = self.machine.encode(chunk.encode()) if word.isalpha() else self.fresh(chunk)  # letters are one match
        if len(chunk) < 64:
            if len(self) >= MEMO_CHUNKS:
                self.clear()
            self[chunk] = found
        return found

    def encode(self, text: str) -> bytes:
        """A single space begins a match, a single line break is one, and so is a point or comma behind a word: runs
        between these give the same ids wherever they stand."""
        if not self.splits or self.ragged(text):
            return self.fresh(text)
        if not self.BESIDE(text):
            text = text.replace(".", "\0.").replace(",", "\0,")
        return b"".join(map(self.__getitem__, text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")))


def utf8_states() -> list[list[int]]:
    """states[state][byte]: the next state, -1 where the byte can't follow. State 0 stands between characters, 1 to 3 await
    as many bytes; after four first bytes the second one has a smaller range (shortest forms, no surrogates, the last plane)."""
    states = [[-1] * 256 for _ in range(8)]
    allow = lambda state, first, last, to: states[state].__setitem__(slice(first, last + 1), [to] * (last + 1 - first))
    allow(0, 0x00, 0x7F, 0)
    for left, first, last in ((1, 0xC2, 0xDF), (2, 0xE0, 0xEF), (3, 0xF0, 0xF4)):
        allow(0, first, last, left)
        allow(left, 0x80, 0xBF, left - 1)
    for state, byte, first, last, to in ((4, 0xE0, 0xA0, 0xBF, 1), (5, 0xED, 0x80, 0x9F, 1), (6, 0xF0, 0x90, 0xBF, 2), (7, 0xF4, 0x80, 0x8F, 2)):
        states[0][byte] = state
        allow(state, first, last, to)
    return states


class Utf8Stream:
    """Incremental UTF-8: ``feed`` returns the characters that are complete, ``finish`` what was left open. Bytes that can't
    be part of a character give U+FFFD as the codec does."""

    STATES = utf8_states()

    def __init__(self) -> None:
        self.state, self.open = 0, b""

    def feed(self, piece: bytes) -> str:
        states, out, at = self.STATES, [], 0
        while self.state and at < len(piece):
            to = states[self.state][piece[at]]
            if to >= 0:
                self.open += piece[at : at + 1]
                at += 1
            if to <= 0:
                out.append(self.open.decode() if to == 0 else "\ufffd")
                to, self.open = 0, b""
            self.state = to
        cut = len(piece)
        for first in range(cut - 1, max(at, cut - 3) - 1, -1):
            if piece[first] & 0xC0 != 0x80:  # the last byte that may begin a character
                to = 0
                for byte in piece[first:]:
                    to = states[to][byte]
                    if to <= 0:
                        break
                else:
                    self.state, self.open, cut = to, piece[first:], first
                break
        out.append(piece[at:cut].decode("utf-8", "replace"))
        return "".join(out)

    def finish(self) -> str:
        left, self.state, self.open = self.open, 0, b""
        return "\ufffd" if left else ""


def decode_stream(ids: np.ndarray, table: dict[int, bytes], piece: int = 4096) -> Iterator[str]:
    machine = Utf8Stream()
    token = table.__getitem__
    for k in range(0, len(ids), piece):
        yield machine.feed(b"".join(map(token, ids[k : k + piece].tolist())))
    yield machine.finish()


_encoders: dict[tuple[str, str], Encoder] = {}


@contextlib.contextmanager
def without_gc() -> Iterator[None]:
    """The transducer's tables hold no cycles but so many objects that looking for cycles costs a third of the time; those
    that are there are left out of later searches too."""
    gc.disable()
    try:
        yield
    finally:
        gc.freeze()
        gc.enable()


def encoder(path: str, pattern: str) -> Encoder:
    """One for each Python worker."""
    CACHES["bpe"] = _encoders.clear
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(load_ranks(path), pattern)
    return _encoders[path, pattern]


def encode_texts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit) of every text."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            for rows, _, _ in slices(batch):
                with without_gc():
                    ids = [own.encode(x or "") for x in rows.column(1).to_pylist()]
                yield arrow_batch(schema, doc_id=rows.column(0), ids=ids)

    return map_batches(id_text(docs), run, "doc_id long, ids binary", "bpe")


def decode_ids(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and text of encoded rows, decoded piece by piece."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = encoder(path, pattern).table
        for batch in batches:
            for rows, _, _ in slices(batch, "ids"):
                yield arrow_batch(schema, doc_id=rows.column(0), text=["".join(decode_stream(np.frombuffer(x or b"", "<u4"), table)) for x in rows.column(1).to_pylist()])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, text string", "bpe")


DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode and decode every text; digests of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            for rows, _, _ in slices(batch):
                n, ids_sha, text_sha = [], [], []
                with without_gc():
                    encoded = [own.encode(x or "") for x in rows.column(1).to_pylist()]
                for ids in encoded:
                    back = hashlib.sha256("".join(decode_stream(np.frombuffer(ids, "<u4"), own.table)).encode())
                    n.append(len(ids) // 4)
                    ids_sha.append(hashlib.sha256(ids).hexdigest())
                    text_sha.append(back.hexdigest())
                yield arrow_batch(DIGESTS, doc_id=rows.column(0), n_tokens=n, ids_sha256=ids_sha, decoded_sha256=text_sha)

    return map_batches(id_text(docs), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", "bpe")


def op10_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .common import table

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
