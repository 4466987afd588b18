"""Repeated windows of words, found by level-wise doubling.

At the first level windows have half the length, seven words for thirteen. Of the
halves in each whole window the one of least hash stands for it; equal windows have
equal ones, so only these are counted, about a quarter of all. Halves that occur in one
document alone are dropped. What is left is extended to twice the length, the windows
of which such a half is the least, and counted again: windows that a document with a
smaller id has too are removed from the later document.

Hashes of halves have 64 bits and only sort out; whole windows have 128 bits. A window
of many documents is spread over tasks by document; the first of each part then meets
those of the other parts.

Null and empty texts have no words and the empty result. Rows that share an id are
treated each by its text and never remove each other's words. Rows without an id keep
all words. Other columns are left out.
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
from sitegrid.llm.text import Block, Hasher, anchors, blocks, gather, listed, lists, ngrams, owners, released, signed, starts_of, strings, sums_by, words

WINDOW = 13
#: documents of one window that one task takes
SPLIT = 2000

FIRST, SECOND = Hasher(seed=2), Hasher(seed=22)

ANCHOR = pa.schema([("h", pa.int64()), ("doc_id", pa.int64())])
WHOLE = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("part", pa.int32()), ("doc_id", pa.int64())])
REMOVED = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("doc_id", pa.int64()), ("again", pa.bool_())])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])


def halves(h: np.ndarray, base: int) -> np.ndarray:
    """Hash of the half window that begins at each word."""
    out = np.zeros(len(h), np.uint64)
    found = ngrams(h, base)
    out[: len(found)] = found
    return out


def anchor_rows(window: int, sieve=None):
    """The distinct halves that stand for windows of each document."""
    base = -(-window // 2)

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for block in blocks(batch.column(1)):
                starts, ends, first = words(block)
                h = halves(FIRST.ranges(block.data, starts, ends), base)
                _, _, at = anchors(h, first, base, window)
                owner = owners(first)[at]
                h = h[at]
                keep = ~pd.Series(h ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))).duplicated().to_numpy()
                if sieve is not None:
                    keep &= sieve.value.may(h)
                yield pa.RecordBatch.from_arrays([pa.array(signed(h[keep])), pa.array(ids[block.start + owner[keep]], pa.int64())], schema=ANCHOR)

    return run


def window_rows(window: int, split: int):
    """Whole windows whose half is repeated; windows of many documents are dealt into parts."""
    base = -(-window // 2)

    def run(batches):
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy()  # rows without an id list nothing
            for block in blocks(batch.column(1)):
                known, until = lists(batch.column(2), block.start, block.n)
                if not len(known):
                    continue
                counts, _ = lists(batch.column(3), block.start, block.n)
                starts, ends, first = words(block)
                words_1 = FIRST.ranges(block.data, starts, ends)
                at, low, _ = anchors(halves(words_1, base), first, base, window)
                text = owners(first)
                place = _index_in(low, text[at], known, until)
                at, many = at[place >= 0], counts[place[place >= 0]]
                if not len(at):
                    continue
                w1 = ngrams(words_1, window)[at]
                w2 = ngrams(SECOND.ranges(block.data, starts, ends), window, 1)[at]
                docs = ids[block.start + text[at]]
                new = ~pd.DataFrame({"w": w1, "d": text[at]}).duplicated().to_numpy()
                parts = np.maximum(1, -(-many // split))
                part = np.where(parts > 1, docs % parts + 1, 0)
                yield pa.RecordBatch.from_arrays([pa.array(signed(w1[new])), pa.array(signed(w2[new])), pa.array(part[new], pa.int32()), pa.array(docs[new])], schema=WHOLE)

    return run


def _index_in(h: np.ndarray, owner: np.ndarray, values: np.ndarray, until: np.ndarray) -> np.ndarray:
    """Place of each hash in the list of its text, -1 if it is not there."""
    table = pd.MultiIndex.from_arrays([owners(until), values.view(np.uint64)])
    return table.get_indexer(pd.MultiIndex.from_arrays([owner, h]))


def later(batches):
    """Rows after the first document of each window, and the first ones of windows in parts (again).

    Rows come sorted by window, part and document. Only the window at hand is remembered."""
    last = None
    for batch in batches:
        w1, w2, part, doc = (batch.column(i).to_numpy() for i in range(4))
        if not len(w1):
            continue
        begins = np.append(True, (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1]) | (part[1:] != part[:-1]))
        if last is not None and last[:3] == (w1[0], w2[0], part[0]):
            begins[0] = False
        run = np.cumsum(begins)
        heads = doc[begins]
        least = np.append(last[3] if last is not None else 0, heads)[run]
        again = (doc == least) & (part > 0)
        out = (doc > least) | again
        last = (w1[-1], w2[-1], part[-1], least[-1])
        yield pa.RecordBatch.from_arrays([pa.array(w1[out]), pa.array(w2[out]), pa.array(doc[out]), pa.array(again[out])], schema=REMOVED)


def cut(window: int):
    """Word counts and the kept words of each text; column 2 lists its removed windows."""

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(1)):
                starts, ends, first = words(block)
                removed = np.zeros(len(starts), bool)
                known, until = lists(batch.column(2), block.start, block.n)
                if len(known):
                    at = starts_of(first, window)
                    h = ngrams(FIRST.ranges(block.data, starts, ends), window)[at]
                    hits = at[listed(h, owners(first)[at], known, until)]
                    cover = np.zeros(len(starts) + 1, np.int64)
                    np.add.at(cover, hits, 1)
                    np.add.at(cover, hits + window, -1)
                    removed = np.cumsum(cover)[:-1] > 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.start, block.n), pa.array(np.diff(first)), pa.array(sums_by(first, removed.astype(np.int64))), kept_words(block, starts, ends, first, ~removed)],
                    schema=RESULT,
                )

    return run


def kept_words(block: Block, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    size = (ends - starts + 1)[keep]
    data = gather(np.append(block.data, np.uint8(0)), starts[keep], size)
    stop = np.cumsum(size) - 1
    data[stop] = 0x20
    count = sums_by(first, keep.astype(np.int64))
    until = np.append(0, np.cumsum(count))
    size[until[1:][count > 0] - 1] -= 1  # no space after the last word of a text
    drop = np.ones(len(data), bool)
    drop[stop[until[1:][count > 0] - 1]] = False
    return strings(data[drop], sums_by(until, size))


def remove_repeats(docs: DataFrame, window: int = WINDOW, split: int = SPLIT, text: Column | str = "text", doc_id: Column | str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (kept words joined by one space) of every text."""
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    texts = docs.select(as_column(doc_id).cast("long").alias("doc_id"), as_column(text).alias("text"))
    named = texts.where("doc_id IS NOT NULL")
    anchor, spark = from_arrow_schema(ANCHOR), docs.sparkSession
    counted = named.mapInArrow(released(anchor_rows(window)), anchor).groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    repeated = written(counted, "repeated-halves")
    sieve = spark.sparkContext.broadcast(bloom(repeated))
    hits = named.mapInArrow(released(anchor_rows(window, sieve)), anchor).join(repeated, "h")
    per_doc = hits.groupBy("doc_id").agg(F.collect_set(F.struct("h", "n")).alias("found"))
    per_doc = per_doc.select("doc_id", "found.h", "found.n")
    # from here on nothing is written: both joins take the texts from one shuffle, both uses of `first` one as well
    found = texts.join(per_doc, "doc_id", "left").select("doc_id", "text", "h", "n").mapInArrow(released(window_rows(window, split)), from_arrow_schema(WHOLE))
    dealt = found.repartition("w1", "w2", "part").sortWithinPartitions("w1", "w2", "part", "doc_id")
    first = dealt.mapInArrow(released(later), from_arrow_schema(REMOVED))
    again = first.where("again").select("w1", "w2", F.lit(0).alias("part"), "doc_id")
    again = again.repartition("w1", "w2").sortWithinPartitions("w1", "w2", "doc_id").mapInArrow(released(later), from_arrow_schema(REMOVED))
    removed = first.where("NOT again").select("doc_id", "w1").union(again.select("doc_id", "w1"))
    lists_of = removed.groupBy("doc_id").agg(F.collect_list("w1").alias("w1"))
    return texts.join(lists_of, "doc_id", "left").select("doc_id", "text", "w1").mapInArrow(released(cut(window)), from_arrow_schema(RESULT))
