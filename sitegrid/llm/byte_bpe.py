"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Texts are split into slices without a regex: each code point gets a class, a small
automaton runs over the classes, and because its transitions are functions from state
to state, the states of all positions come from an associative scan over those
functions. Slice boundaries follow from the states. Each different slice is merged
once per worker and its ids are looked up afterwards; slice and token offsets are kept,
so decoding is a gather of token bytes.

Null and empty texts give no tokens. Input columns other than the id and the text are
left out of the result; repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from sitegrid.llm.text import Block, Hasher, blocks, gather, owners, released, sums_by

U64 = np.uint64
NEVER = np.iinfo(np.int64).max
#: slices of more bytes are merged one by one with a heap
LONG = 64

# Code point classes. Letters that can stand in a contraction have their own class.
OTHER, LETTER, NUMBER, SPACE, BLANK, QUOTE, START = range(7)
CONTRACTION = {c: 7 + i for i, c in enumerate("stmdrvle")}  # fixed values: letters after the apostrophe
CLASSES = 7 + len(CONTRACTION)

# States: what the last code point ended. Q: an apostrophe that begins a slice. QR, QV, QL:
# such an apostrophe and r, v or l. TWO, THREE: a whole contraction of that length.
O, L, N, S, B, Q, QR, QV, QL, TWO, THREE = range(11)
STATES = 11

#: fixed values: code points with the property White_Space
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(1)
def code_point_classes() -> np.ndarray:
    table = np.zeros(sys.maxunicode + 1, np.uint8)
    major = np.frombuffer("".join(unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)).encode(), np.uint8)
    table[major == ord("L")] = LETTER
    table[major == ord("N")] = NUMBER
    table[WHITE_SPACE] = BLANK
    table[0x20] = SPACE
    table[ord("'")] = QUOTE
    for letter, kind in CONTRACTION.items():
        table[ord(letter)] = kind
    return table


def _step(state: int, kind: int) -> int:
    if kind in (OTHER, START):
        return O if kind == OTHER else B  # a text begins like after a line break
    if kind == NUMBER:
        return N
    if kind == SPACE:
        return S
    if kind == BLANK:
        return B
    if kind == QUOTE:  # after another symbol or a space it continues that slice
        return O if state in (O, S, Q) else Q
    letter = {v: k for k, v in CONTRACTION.items()}.get(kind)
    if state == Q and letter in ("s", "t", "m", "d"):
        return TWO
    if state == Q and letter in ("r", "v", "l"):
        return {"r": QR, "v": QV, "l": QL}[letter]
    if (state, letter) in ((QR, "e"), (QV, "e"), (QL, "l")):
        return THREE
    return L


@lru_cache(1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All functions that runs of classes make: of each class, products, images of each state."""
    images = [tuple(_step(s, k) for s in range(STATES)) for k in range(CLASSES)]
    index: dict[tuple, int] = {}
    for f in images:
        index.setdefault(f, len(index))
    of_class = np.array([index[f] for f in images], np.int32)
    todo = list(index)
    while todo:  # close the set under composition
        made = {tuple(g[x] for x in f) for f in list(index) for g in todo} | {tuple(f[x] for x in g) for f in list(index) for g in todo}
        todo = [f for f in made if f not in index]
        for f in todo:
            index.setdefault(f, len(index))
    functions = np.array(list(index), np.uint8)
    keys = {f: i for f, i in index.items()}
    product = np.array([[keys[tuple(g[list(f)])] for g in functions] for f in keys], np.int32)
    return of_class, product.astype(np.uint8 if len(index) <= 256 else np.int32), functions


def scan(classes: np.ndarray, width: int = 128) -> np.ndarray:
    """State after each position, through an associative scan of transition functions.

    Rows of `width` positions are scanned side by side, then the rows' products
    recursively, and each row starts from the state the rows before it end in.
    """
    of_class, product, functions = monoid()
    return functions[_prefixes(of_class[classes], product, width), B]


def _prefixes(f: np.ndarray, product: np.ndarray, width: int) -> np.ndarray:
    n = len(f)
    if n <= 1:
        return f
    rows = -(-n // width) if n > width else 1
    width = -(-n // rows)
    padded = np.zeros(rows * width, f.dtype)
    padded[:n] = f
    grid = np.ascontiguousarray(padded.reshape(rows, width).T)
    for k in range(1, width):
        grid[k] = product[grid[k - 1], grid[k]]
    if rows > 1:
        carried = _prefixes(grid[-1].copy(), product, 128)
        grid[:, 1:] = product[carried[:-1][None, :], grid[:, 1:]]
    return grid.T.reshape(-1)[:n]


def code_points(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Code points of valid UTF-8 and the byte position of each."""
    data = block.data
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.int32)
    points = lead.copy()
    for size, low, mask in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
        long = np.flatnonzero(lead >= low)
        points[long] = lead[long] & mask if size == 2 else points[long]
        if size > 2:
            points[long] = lead[long] & mask
    for k, low in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
        long = np.flatnonzero(lead >= low)
        points[long] = (points[long] << 6) | (data[at[long] + k] & 0x3F)
    return points, at


def slices(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where slices begin, and the first slice of each text."""
    points, at = code_points(block)
    n = len(points)
    if not n:
        return at, np.zeros(block.n + 1, np.int64)
    kinds = code_point_classes()[points]
    begins = np.zeros(n + 1, bool)
    first = np.searchsorted(at, block.offsets)
    begins[first] = True
    begins = begins[:n]
    # one extra element before each text carries the state of its beginning
    filled = np.diff(first) > 0
    heads = first[:-1][filled]
    position = np.arange(n) + np.cumsum(begins)
    with_heads = np.full(n + len(heads), START, np.uint8)
    with_heads[position] = kinds
    all_states = scan(with_heads)
    state, before = all_states[position], all_states[position - 1]
    family = np.array([0, 1, 2, 3, 3, 0, *[1] * (CLASSES - 6)], np.uint8)[kinds]  # symbols, letters, numbers, white space
    white = family == 3
    follows = np.zeros(n, bool)  # a code point that is not white space comes next in the text
    follows[:-1] = ~white[1:] & ~begins[1:]
    before_family = np.zeros(n, np.uint8)
    before_family[1:] = family[:-1]
    before_white = np.zeros(n, bool)
    before_white[1:] = white[:-1]
    starts = before_family != family
    starts[1:] &= ~((kinds[:-1] == SPACE) & ~white[1:])  # one space joins the slice after it
    # the last white space of several stands alone or joins the next slice
    starts |= white & before_white & follows
    # a contraction is one slice, and what follows it begins another
    two, three = np.flatnonzero(state == TWO), np.flatnonzero(state == THREE)
    starts[two] = False
    starts[three] = False
    starts[three - 1] = False
    starts |= (before == TWO) | (before == THREE)
    starts |= begins
    where = np.flatnonzero(starts)
    return at[where], np.searchsorted(where, first)


class Vocabulary:
    """Ranks of a rank file, their bytes, and merged slices seen so far."""

    def __init__(self, path: str, remember: int = 50_000):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        size = max(self.ranks.values()) + 1
        token = [b""] * size
        for piece, rank in self.ranks.items():
            token[rank] = piece
        self.lengths = np.fromiter(map(len, token), np.int64, size)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(token), np.uint8)
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        rank, pairs = self.ranks.get, {}
        for piece, whole in self.ranks.items():
            for i in range(1, len(piece)):
                a, b = rank(piece[:i]), rank(piece[i:])
                if a is not None and b is not None:
                    pairs[(a << 32) | b] = whole
        self.pairs = np.fromiter(sorted(pairs), np.int64, len(pairs))
        self.pair_ranks = np.fromiter((pairs[k] for k in self.pairs.tolist()), np.int64, len(pairs))
        self.remember, self.known = remember, {}

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each merged pair of ids, NEVER where the vocabulary has no such token."""
        keys = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.pair_ranks[at], NEVER)

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each slice: in every round each slice merges its pair of lowest rank, the left one of equals."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        parts = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        done_parts, done_owner = [], []
        rank = None
        while len(parts):
            if rank is None:
                rank = np.full(len(parts), NEVER)
                inner = np.flatnonzero(owner[:-1] == owner[1:])
                rank[inner] = self._pair_ranks(parts[inner], parts[inner + 1])
            begins = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lengths = np.diff(np.append(begins, len(owner)))
            low = np.repeat(np.minimum.reduceat(rank, begins), lengths)
            ready = low == NEVER
            done_parts.append(parts[ready])
            done_owner.append(owner[ready])
            parts, owner, rank, low = (x[~ready] for x in (parts, owner, rank, low))
            if not len(parts):
                break
            lowest = np.flatnonzero(rank == low)
            lowest = lowest[np.append(True, owner[lowest[1:]] != owner[lowest[:-1]])]
            parts[lowest] = low[lowest]
            keep = np.ones(len(parts), bool)
            keep[lowest + 1] = False
            moved = lowest - np.arange(len(lowest))  # one part before each has gone
            parts, owner, rank = parts[keep], owner[keep], rank[keep]
            for at in (moved - 1, moved):
                at = at[at >= 0]
                inside = at[:-1] if len(at) and at[-1] == len(parts) - 1 else at
                same = owner[inside] == owner[inside + 1]
                rank[inside] = np.where(same, self._pair_ranks(parts[inside], parts[inside + 1]), NEVER)
                if len(inside) < len(at):
                    rank[at[-1]] = NEVER
        parts, owner = np.concatenate(done_parts), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        until = [0, *np.cumsum(np.bincount(owner, minlength=len(pieces))).tolist()]
        flat = parts[order].astype(np.uint32)
        return [flat[a:b].copy() for a, b in zip(until, until[1:], strict=False)]

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """The same with a heap, for slices of any length."""
        import heapq

        n = len(piece)
        end = list(range(1, n + 1))  # end[i]: where the part that begins at i ends; 0 once merged away
        before = list(range(-1, n - 1))
        rank = self.ranks.get
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, stop = heapq.heappop(heap)
            if not end[i] or end[i] >= n or not (j := end[i]) or not end[j] or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := rank(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if before[i] >= 0 and (r := rank(piece[before[i] : stop])) is not None:
                heapq.heappush(heap, (r, before[i], stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return np.array(out, np.uint32)

    def ids_of(self, pieces: list[bytes]) -> list[np.ndarray]:
        if len(self.known) > self.remember:
            self.known.clear()
        known = self.known
        new = [p for p in pieces if p not in known]
        short = [p for p in new if len(p) <= LONG]
        if short:
            known.update(zip(short, self.merge(short), strict=True))
        return [known[p] if len(p) <= LONG else self._merge_long(p) for p in pieces]


@lru_cache(2)
def vocabulary_of(path: str) -> Vocabulary:
    """One vocabulary for each worker and file."""
    return Vocabulary(path)


HASH = Hasher(seed=6)
#: bytes of text that a worker encodes at once, or one text if that is longer
BLOCK = 1 << 18


def encode(block: Block, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a block, the first id of each text, and the byte offset of each id."""
    starts, first = slices(block)
    if not len(starts):
        return np.zeros(0, np.uint32), np.zeros(block.n + 1, np.int64), starts
    ends = np.append(starts[1:], len(block.data))
    codes, keys = pd.factorize(HASH.ranges(block.data, starts, ends))
    one = np.empty(len(keys), np.int64)
    one[codes[::-1]] = np.arange(len(codes))[::-1]  # the first slice with each hash
    raw = block.data.tobytes()
    ids = vocabulary.ids_of([raw[s:e] for s, e in zip(starts[one].tolist(), ends[one].tolist(), strict=True)])
    if not _same(block.data, starts, ends - starts, starts[one][codes], (ends - starts)[one][codes]):  # two slices with one hash
        ids = vocabulary.ids_of([raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])
        codes = np.arange(len(starts))
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.concatenate(ids)
    taken = sizes[codes]
    out = gather(flat, (np.cumsum(sizes) - sizes)[codes], taken)
    until = np.append(0, np.cumsum(taken))
    lengths = vocabulary.lengths[out]
    return out, until[first], np.cumsum(lengths) - lengths


def _same(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, others: np.ndarray, other_lengths: np.ndarray) -> bool:
    return bool((lengths == other_lengths).all()) and bool((data == gather(data, others, lengths)).all())


def decode(ids: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    return gather(vocabulary.bytes, vocabulary.begins[ids], vocabulary.lengths[ids])


def _digests(data: np.ndarray, first: np.ndarray) -> list[str]:
    view, at = memoryview(np.ascontiguousarray(data)).cast("B"), (first * data.itemsize).tolist()
    return [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(at, at[1:], strict=False)]


def tokenize(docs: DataFrame, path: str, text: Column | str = "text", doc_id: Column | str = "doc_id") -> DataFrame:
    """One row per text: doc_id, ids (little-endian 32-bit, as binary), offsets (byte offset
    of each id, likewise), decoded (binary). A file at `path` is opened where tasks run."""
    return _run(docs, path, text, doc_id, True)


def token_digests(docs: DataFrame, path: str, text: Column | str = "text", doc_id: Column | str = "doc_id") -> DataFrame:
    """One row per text: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return _run(docs, path, text, doc_id, False)


def _run(docs: DataFrame, path: str, text: Column | str, doc_id: Column | str, whole: bool) -> DataFrame:
    fields = [("doc_id", pa.int64())] + (
        [("ids", pa.binary()), ("offsets", pa.binary()), ("decoded", pa.binary())]
        if whole
        else [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )
    schema = pa.schema(fields)

    def run(batches):
        vocabulary = vocabulary_of(path)
        for batch in batches:
            for block in blocks(batch.column(1), BLOCK):
                ids, first, offsets = encode(block, vocabulary)
                back = decode(ids, vocabulary)
                until = np.append(0, np.cumsum(vocabulary.lengths[ids]))[first]
                rows = batch.column(0).slice(block.start, block.n)
                ids = ids.astype("<u4")
                if whole:
                    inner = (offsets - np.repeat(until[:-1], np.diff(first))).astype("<u4")
                    columns = [[a[x:y].tobytes() for x, y in zip(f, f[1:], strict=False)] for a, f in ((ids, first), (inner, first), (back, until))]
                else:
                    columns = [np.diff(first), _digests(ids, first), _digests(back, until)]
                yield pa.RecordBatch.from_arrays([rows, *(pa.array(c, t) for c, (_, t) in zip(columns, fields[1:], strict=True))], schema=schema)
        vocabulary.known.clear()

    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    narrow = docs.select(as_column(doc_id).cast("long").alias("doc_id"), as_column(text).alias("text"))
    return narrow.mapInArrow(released(run), from_arrow_schema(schema))
