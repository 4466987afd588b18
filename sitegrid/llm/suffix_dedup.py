"""Repeated byte strings through merged Burrows-Wheeler transforms of shards.

A string of `window` bytes is looked for where it can be repeated only. Of the shorter
strings inside it (`BASE` bytes) the one of least hash stands for it, the first of
equals; equal windows have equal ones at equal places. Windows with one representative
in a row make a segment. Segments whose representative occurs once are done. The others
are dealt by representative, so that every copy of a window is in one bucket.

In a task, segments are strings over symbols of `window`/5 bytes, as many as their
phases. They are dealt into shards, and each shard has its own suffix order and
Burrows-Wheeler transform. These are merged by iterative interleave refinement: from an
interleave that is right for d symbols, one stable pass over the transforms gives that
for d+1, and the places where neighbours begin to differ are the common prefixes. After
five rounds the intervals of equal windows are there; no suffix is sorted again. An
interval that counts two occurrences or more is repeated.

Buckets of more than `LIMIT` bytes are counted window by window in a shuffle instead,
so no task holds an unbounded one. Bucket, segment and window are told apart by 128 bits
of hash, symbols in a task by 64.

Null and empty texts, and texts shorter than a window, keep all bytes. Rows that share
an id are treated each by its text; as two rows they count as two occurrences. Rows
without an id take part like others.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from sitegrid.llm.bloom import bloom
from sitegrid.llm.tables import written
from sitegrid.llm.text import Block, Hasher, blocks, gather, listed, lists, mix, owners, released, signed, sliding, strings

WINDOW, BASE, SYMBOLS = 200, 40, 5
BATCH, LIMIT, SHARDS = 1 << 20, 1 << 20, 4
PIECE = 1 << 18  # bytes of texts at once: hashes of all positions, 8 bytes each, stay in the cache
U64 = np.uint64
FIRST, SECOND, INNER = Hasher(seed=5), Hasher(seed=55), Hasher(seed=555)

ANCHOR = pa.schema([("h", pa.int64()), ("row", pa.int64()), ("n", pa.int64())])
SEGMENT = pa.schema([("h", pa.int64()), ("g", pa.int64()), ("segment", pa.binary()), ("n", pa.int64())])
MEMBER = pa.schema([("row", pa.int64()), ("h", pa.int64()), ("g", pa.int64())])
RUNS = pa.schema([("h", pa.int64()), ("g", pa.int64()), ("runs", pa.list_(pa.int32())), ("segment", pa.binary()), ("n", pa.int64())])
SINGLE = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("h", pa.int64()), ("g", pa.int64()), ("at", pa.int32()), ("n", pa.int64())])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("spans", pa.list_(pa.int32())), ("kept", pa.binary())])


def rolling(data: np.ndarray, size: int, hasher: Hasher = FIRST) -> np.ndarray:
    """Hash of the `size` bytes from each position on."""
    at = np.arange(max(0, len(data) - size + 1))
    return hasher.ranges(data, at, at + size)


PLACE = 28  # bits of a position in a block


def segments(block: Block, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first and last window start, and representative hash of each segment."""
    h = rolling(block.data, BASE)
    none = np.zeros(0, np.int64)
    if len(block.data) < window:
        return none, none, none, h[:0]
    # the high bits of the hash order the shorter strings, then their place: the first of equals is the least
    low = U64((1 << PLACE) - 1)
    least = sliding((h & ~low) | np.arange(len(h), dtype=np.uint64), window - BASE + 1, np.minimum)
    chosen = (least & low).astype(np.int64)
    left = np.repeat(block.offsets[1:], np.diff(block.offsets))[: len(chosen)] - np.arange(len(chosen))
    starts = np.flatnonzero(left >= window)
    if not len(starts):
        return none, none, none, h[:0]
    chosen = chosen[starts]
    head = np.flatnonzero(np.append(True, (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)))
    tail = np.append(head[1:], len(starts)) - 1
    return block.text_of(starts[head]), starts[head], starts[tail], h[chosen[head]]


def anchor_rows(window: int, sieve=None):
    """Representatives of each text and how many segments of it they stand for."""

    def run(batches):
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for block in blocks(batch.column(1), PIECE):
                text, _, _, h = segments(block, window)
                if sieve is not None:
                    keep = sieve.value.may(h)
                    text, h = text[keep], h[keep]
                codes, _ = pd.factorize(mix(h + text.astype(np.uint64) * U64(0x9E3779B97F4A7C15)))
                one = np.flatnonzero(~pd.Series(codes).duplicated().to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(signed(h[one])), pa.array(rows[block.start + text[one]]), pa.array(np.bincount(codes, minlength=len(one)))], schema=ANCHOR)

    return run


def chosen_segments(block: Block, window: int, known: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, ...]:
    """Segments whose representative is in the list of their text, with a hash of their bytes."""
    text, low, high, h = segments(block, window)
    keep = listed(h, text, known, until)
    text, low, high, h = text[keep], low[keep], high[keep], h[keep]
    g = np.zeros(0, np.uint64)
    if len(low):
        stop = high + window
        g = _ranges(block.data, low, stop)
    return text, low, high, h, g


def _ranges(data: np.ndarray, low: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of ranges that overlap: even and odd windows apart would not do, so bytes are summed once per block."""
    from sitegrid.llm.text import BLOCK

    out = np.empty(len(low), np.uint64)
    at = 0
    while at < len(low):
        begin = int(low[at])
        to = max(int(np.searchsorted(low, begin + BLOCK)), at + 1)
        end = int(stop[at:to].max())
        size = end - begin
        SECOND._powers(size + 1)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(SECOND.letters[data[begin:end]] * SECOND.up[:size], out=sums[1:])
        s, e = low[at:to] - begin, stop[at:to] - begin
        out[at:to] = (sums[e] - sums[s]) * SECOND.down[s] + (e - s).astype(np.uint64)
        at = to
    return mix(out)


def segment_rows(window: int, with_bytes: bool):
    """Distinct segments of each text; with their bytes and number, or with the row they are in."""

    def run(batches):
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for block in blocks(batch.column(1), PIECE):
                known, until = lists(batch.column(2), block.start, block.n)
                if not len(known):
                    continue
                text, low, high, h, g = chosen_segments(block, window, known, until)
                if not len(low):
                    continue
                codes, _ = pd.factorize(mix(g + (text.astype(np.uint64) * U64(0x9E3779B97F4A7C15) if not with_bytes else U64(0))))
                one = np.flatnonzero(~pd.Series(codes).duplicated().to_numpy())
                if with_bytes:
                    size = (high - low + window)[one]
                    yield pa.RecordBatch.from_arrays([pa.array(signed(h[one])), pa.array(signed(g[one])), strings(gather(block.data, low[one], size), size, pa.binary()), pa.array(np.bincount(codes))], schema=SEGMENT)
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(rows[block.start + text[one]]), pa.array(signed(h[one])), pa.array(signed(g[one]))], schema=MEMBER)

    return run


class Collection:
    """Strings over symbols of `size` bytes. Position p of a string is followed by p + size;
    positions with no whole symbol left end a sequence."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray, size: int):
        self.size = size
        self.places = lengths + 1
        self.begin = np.cumsum(self.places) - self.places
        total = int(self.places.sum())
        string = np.repeat(np.arange(len(lengths)), self.places)
        self.string = string
        inside = np.arange(total) - self.begin[string]
        self.inside = inside
        self.whole = inside + size <= lengths[string]
        h = rolling(data, size, INNER)
        # a string has one place more than bytes, so positions in data shift by the number of strings before
        hashes = h[np.flatnonzero(self.whole) - string[self.whole]]
        _, ids = np.unique(hashes, return_inverse=True)
        self.symbol = np.full(total, -1, np.int64)
        self.symbol[self.whole] = ids

    def suffix_order(self, low: int, high: int) -> np.ndarray:
        """Positions low..high (whole strings) in suffix order, by doubling; ends of sequences come first, in order of place."""
        n = high - low
        whole = self.whole[low:high]
        ends = int((~whole).sum())
        rank = np.empty(n, np.int64)
        rank[~whole] = np.arange(ends)
        rank[whole] = ends + self.symbol[low:high][whole]
        order = stable_order(rank)
        step = 0
        while True:
            ordered = rank[order]
            new = np.append(True, ordered[1:] != ordered[:-1])
            if step:
                ahead_ordered = follows[order]
                new[1:] |= ahead_ordered[1:] != ahead_ordered[:-1]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new) - 1
            if new.all():
                return order + low
            step = 2 * step or self.size
            follows = rank[np.minimum(np.arange(n) + step, n - 1)]
            follows[rank < ends] = 0  # an end is unique already
            order = stable_order(follows)
            order = order[stable_order(rank[order])]


def stable_order(keys: np.ndarray) -> np.ndarray:
    """Stable order of small non-negative numbers, 16 bits at a time, which numpy sorts by counting."""
    order = np.argsort(keys.astype(np.uint16), kind="stable")
    high = keys >> 16
    if len(keys) and high.max():
        order = order[np.argsort(high[order].astype(np.uint16), kind="stable")]
    return order


def merged(collection: Collection, cuts: list[int], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of the whole collection up to `depth` symbols and, for each suffix, the
    number of symbols it shares with the one before it (at most depth).

    Shards are ranges of positions between cuts. Their transforms are merged by interleave
    refinement: `shard` tells which shard gives the next suffix, at first one shard after
    the other."""
    orders = [collection.suffix_order(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]
    suffixes = np.concatenate(orders)
    inner = collection.inside[suffixes] >= collection.size
    # the transform of each shard: the symbol before each suffix, -1 where a sequence begins
    before = np.where(inner, collection.symbol[np.maximum(suffixes - collection.size, 0)], -1)
    ends = [int((~collection.whole[a:b]).sum()) for a, b in zip(cuts, cuts[1:], strict=False)]
    shard = np.repeat(np.arange(len(orders), dtype=np.uint8), [len(o) for o in orders])
    n_ends = sum(ends)
    first_shards = np.repeat(np.arange(len(orders), dtype=np.uint8), ends)
    shared = np.full(len(shard), depth, np.int64)
    boundary = np.zeros(len(shard), bool)
    boundary[0] = True
    for d in range(depth):
        by_shard = np.argsort(shard, kind="stable")
        symbols = np.empty(len(shard), np.int64)
        symbols[by_shard] = before
        block = np.cumsum(boundary)
        has = np.flatnonzero(symbols >= 0)
        order = has[stable_order(symbols[has])]
        shard = np.concatenate([first_shards, shard[order]])
        new = np.ones(len(shard), bool)
        new[n_ends + 1 :] = (symbols[order][1:] != symbols[order][:-1]) | (block[order][1:] != block[order][:-1])
        shared[new & (shared == depth)] = d
        boundary = new
    by_shard = np.argsort(shard, kind="stable")
    out = np.empty(len(shard), np.int64)
    out[by_shard] = suffixes
    return out, np.where(boundary, shared, depth)


def repeated_windows(parts: list[bytes], weights: np.ndarray, window: int, shards: int = SHARDS) -> list[np.ndarray]:
    """Runs [start, stop) of window starts of each string that occur twice or more in all, as flat arrays."""
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    data = np.frombuffer(b"".join(parts), np.uint8)
    collection = Collection(data, lengths, window // SYMBOLS)
    total = np.cumsum(collection.places)
    # shards are whole strings of about equal bytes
    goal = np.linspace(0, total[-1], min(shards, len(parts)) + 1)[1:-1]
    cuts = sorted({0, *(int(total[i]) for i in np.searchsorted(total, goal)), int(total[-1])})
    order, shared = merged(collection, cuts, SYMBOLS)
    string, inside = collection.string[order], collection.inside[order]
    is_window = inside + window <= lengths[string]
    interval = np.cumsum(shared < SYMBOLS) - 1
    count = np.bincount(interval, np.where(is_window, weights[string], 0))
    again = is_window & (count[interval] >= 2)
    marks = np.zeros(len(order) + 1, np.int8)
    marks[order[again]] = 1
    edge = np.diff(marks, prepend=np.int8(0))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    of = collection.string[starts]
    pairs = np.stack([starts - collection.begin[of], stops - collection.begin[of]], axis=1).astype(np.int32)
    bounds = np.searchsorted(of, np.arange(len(parts) + 1))
    return [pairs[a:b].reshape(-1) for a, b in zip(bounds, bounds[1:], strict=False)]


def merged_buckets(window: int, batch_bytes: int = BATCH, limit: int = LIMIT):
    """Repeated runs of segments that come sorted by bucket; whole buckets are merged together
    up to about batch_bytes. Segments of larger buckets go out with their bytes."""

    def done(frame: pd.DataFrame) -> pa.RecordBatch:
        # a bucket of one segment is an interval already
        alone = ~frame["h"].duplicated(keep=False).to_numpy()
        n, parts = frame["n"].to_numpy(), frame["segment"].to_numpy()
        runs = [np.array([0, len(part) - window + 1] if often else [], np.int32) for part, often in zip(parts, n >= 2, strict=True)]
        together = np.flatnonzero(~alone)
        if len(together):
            for k, found in zip(together.tolist(), repeated_windows(parts[together].tolist(), n[together], window), strict=True):
                runs[k] = found
        size = len(frame)
        return pa.RecordBatch.from_arrays([pa.array(frame["h"].to_numpy()), pa.array(frame["g"].to_numpy()), pa.array(runs, pa.list_(pa.int32())), pa.nulls(size, pa.binary()), pa.nulls(size, pa.int64())], schema=RUNS)

    def passed(frame: pd.DataFrame) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(frame["h"].to_numpy()), pa.array(frame["g"].to_numpy()), pa.nulls(len(frame), pa.list_(pa.int32())), pa.array(frame["segment"].tolist(), pa.binary()), pa.array(frame["n"].to_numpy())], schema=RUNS)

    def run(batches):
        held, size, wide = [], 0, None
        for batch in batches:
            frame = batch.to_pandas()
            if wide is not None:  # the rest of a bucket that is too large
                mine = (frame["h"] == wide).to_numpy()
                if mine.any():
                    yield passed(frame[mine])
                    frame = frame[~mine]
                if len(frame):
                    wide = None
            if not len(frame):
                continue
            held.append(frame)
            size += int(frame["segment"].str.len().sum())
            if size < batch_bytes:
                continue
            frame = pd.concat(held, ignore_index=True)
            last = frame["h"].iloc[-1]
            tail = (frame["h"] == last).to_numpy()
            if not tail.all():
                yield done(frame[~tail])
            frame = frame[tail]
            size = int(frame["segment"].str.len().sum())
            held = [frame]
            if size > limit:
                yield passed(frame)
                held, size, wide = [], 0, last
        if held:
            yield done(pd.concat(held, ignore_index=True))

    return run


def single_windows(window: int):
    """Every window of the segments of large buckets, once per segment and place."""

    def run(batches):
        for batch in batches:
            h, g, n = batch.column(0), batch.column(1), batch.column(3).to_numpy()
            for block in blocks(batch.column(2), PIECE):
                sizes = np.diff(block.offsets) - window + 1
                at = gather(np.arange(len(block.data)), block.offsets[:-1], sizes)
                of = np.repeat(np.arange(block.n), sizes) + block.start
                w1, w2 = (signed(hasher.ranges(block.data, at, at + window)) for hasher in (FIRST, INNER))
                yield pa.RecordBatch.from_arrays([pa.array(w1), pa.array(w2), h.take(pa.array(of)), g.take(pa.array(of)), pa.array((at - block.offsets[of - block.start]).astype(np.int32)), pa.array(n[of])], schema=SINGLE)

    return run


def cut(window: int):
    """Kept bytes and removed spans of each text; columns 3 to 5 list its representatives, segments and their runs."""

    def run(batches):
        for batch in batches:
            keys = batch.column(3)
            hs = batch.column(2)
            runs_of = batch.column(4)
            for block in blocks(batch.column(1), PIECE):
                cover = np.zeros(len(block.data) + 1, np.int64)
                known, until = lists(hs, block.start, block.n)
                if len(known):
                    g, _ = lists(keys, block.start, block.n)
                    runs = [r for row in runs_of.slice(block.start, block.n).to_pylist() for r in row or []]
                    by_segment: dict[tuple[int, int], list] = {}
                    for text, key, found in zip(owners(until).tolist(), g.tolist(), runs, strict=True):
                        by_segment.setdefault((text, key), []).extend(found)
                    text, low, _, _, found = chosen_segments(block, window, known, until)
                    for t, begin, key in zip(text.tolist(), low.tolist(), signed(found).tolist(), strict=True):
                        mine = by_segment.get((t, key), ())
                        for i in range(0, len(mine), 2):
                            cover[begin + mine[i]] += 1
                            cover[begin + mine[i + 1] - 1 + window] -= 1
                gone = np.cumsum(cover)[:-1] > 0
                yield _result(batch.column(0).slice(block.start, block.n), block, gone)

    return run


def _result(ids: pa.Array, block: Block, gone: np.ndarray) -> pa.RecordBatch:
    from sitegrid.llm.text import spans

    starts, stops, first = spans(block, gone)
    of = owners(first)
    pairs = np.stack([starts - block.offsets[of], stops - block.offsets[of]], axis=1).astype(np.int32).reshape(-1)
    before = np.append(0, np.cumsum(gone))[block.offsets]
    removed = np.diff(before)
    size = np.diff(block.offsets)
    spans_column = pa.ListArray.from_arrays(pa.array((2 * first).astype(np.int32)), pa.array(pairs))
    return pa.RecordBatch.from_arrays([ids, pa.array(size), pa.array(removed), pa.array(np.diff(first)), spans_column, strings(block.data[~gone], size - removed, pa.binary())], schema=RESULT)


def remove_repeats(docs: DataFrame, window: int = WINDOW, text: Column | str = "text", doc_id: Column | str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans (start and stop of each removed run, flat) and kept bytes of every text."""
    if window % SYMBOLS or window < 2 * BASE:
        raise ValueError(f"window must be a multiple of {SYMBOLS} and at least {2 * BASE}")
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    spark = docs.sparkSession
    texts = docs.select(as_column(doc_id).cast("long").alias("doc_id"), as_column(text).alias("text"))
    # rows of equal id and text share a key, and lists of one key only ever widen what is looked at
    texts = texts.withColumn("row", F.xxhash64("doc_id", "text"))
    anchor = from_arrow_schema(ANCHOR)
    narrow = texts.select("row", "text")
    counted = narrow.mapInArrow(released(anchor_rows(window)), anchor).groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    repeated = written(counted.select("h"), "repeated-representatives")
    sieve = spark.sparkContext.broadcast(bloom(repeated))
    hits = narrow.mapInArrow(released(anchor_rows(window, sieve)), anchor).select("h", "row").join(repeated, "h")
    per_row = written(hits.groupBy("row").agg(F.collect_list("h").alias("hs")), "representatives")
    # the three joins with the texts have one plan below, so the texts are shuffled once
    marked = texts.join(per_row, "row", "left")
    found = marked.select("row", "text", "hs")
    distinct = found.mapInArrow(released(segment_rows(window, True)), from_arrow_schema(SEGMENT)).groupBy("h", "g", "segment").agg(F.sum("n").alias("n"))
    dealt = distinct.repartition("h").sortWithinPartitions("h", "g")
    merged_runs = written(dealt.mapInArrow(released(merged_buckets(window, BATCH, limit)), from_arrow_schema(RUNS)), "runs")
    single = merged_runs.where("segment IS NOT NULL").select("h", "g", "segment", "n").mapInArrow(released(single_windows(window)), from_arrow_schema(SINGLE))
    often = single.groupBy("w1", "w2").agg(F.sum("n").alias("total")).where("total > 1")
    rest = single.join(often, ["w1", "w2"]).groupBy("h", "g").agg(F.flatten(F.collect_list(F.array(F.col("at"), F.col("at") + 1))).alias("runs"))
    runs = merged_runs.where("segment IS NULL AND size(runs) > 0").select("h", "g", "runs").union(rest)
    members = found.mapInArrow(released(segment_rows(window, False)), from_arrow_schema(MEMBER)).join(runs, ["h", "g"])
    lists_of = members.groupBy("row").agg(F.collect_list(F.struct("h", "g", "runs")).alias("found")).select("row", "found.h", "found.g", "found.runs")
    return texts.join(lists_of, "row", "left").select("doc_id", "text", "h", "g", "runs").mapInArrow(released(cut(window)), from_arrow_schema(RESULT))
