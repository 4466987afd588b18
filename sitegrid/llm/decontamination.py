"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are lower-case runs of letters and digits; in scripts without spaces each code point
is one. N-grams of the test items are counted
over the whole corpus. In each stretch of consecutive n-grams of an item the rarest is
a seed, so every four words in a row of an item have one, however common they are. Seeds
join texts to items; each pair is aligned word by word, which also scores edited copies, and
the pair counts as a leak if the score is a share of that of a perfect copy, or that of
`LONG` equal words, however long the item is. `POINTS` code points count for a word there.

Items of equal words are aligned once and listed together. Null and empty texts, and
items of fewer words than a seed, which could not be told from chance, match nothing.
Texts that share an id are aligned each, and the best score counts. Empty tables give
an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from sitegrid.llm.bloom import bloom
from sitegrid.llm.tables import may_be_in, written
from sitegrid.llm.text import Block, Hasher, blocks, lists, ngrams, owners, released, signed, sliding, spans, starts_of, sums_by

SEED_WORDS, STRETCH = 3, 2
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST = 0.5
LONG, POINTS = 13, 3
PIECE = 1 << 18  # bytes of texts at once

HASH = Hasher(seed=11)
#: bytes of words: digits, letters, and all bytes beyond ASCII
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True
#: first two bytes of code points of scripts without spaces, first byte times 256: Thai to Tibetan,
#: Burmese, Khmer, kana and bopomofo, Han with its compatibility forms and further planes
UNSPACED = np.zeros(1 << 16, bool)
for low, high in ((0xE0B8, 0xE0BF), (0xE180, 0xE182), (0xE19E, 0xE19F), (0xE381, 0xE387), (0xE390, 0xE3BF), (0xE480, 0xE9BF), (0xEFA4, 0xEFAB), (0xF0A0, 0xF0BF)):
    UNSPACED[low : high + 1] = True

SEED = pa.schema([("doc_id", pa.int64()), ("h", pa.int64())])
ITEM = pa.schema([("item_id", pa.int64()), ("at", pa.int32()), ("h", pa.int64()), ("words", pa.list_(pa.int64())), ("long", pa.float64())])
FOUND = pa.schema([("doc_id", pa.int64()), ("class_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("first_char", pa.int64()), ("last_char", pa.int64())])


def word_hashes(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = block.data
    starts, ends, first = spans(block, WORD[data])
    points = unspaced(data)
    if len(points):
        # such a code point is a word of its own, and what follows it begins another
        after = points + np.where(data[points] >= 0xF0, 4, 3)
        after = after[after < len(data)]
        begins = np.union1d(starts, np.concatenate([points, after[WORD[data[after]]]]))
        until = ends[np.searchsorted(starts, begins, "right") - 1]
        starts, ends = begins, np.minimum(until, np.append(begins[1:], len(data)))
        first = np.searchsorted(starts, block.offsets)
    return HASH.ranges(data, starts, ends), first, starts, ends


def unspaced(data: np.ndarray) -> np.ndarray:
    """Where code points of scripts without spaces begin."""
    at = np.flatnonzero(data >= 0xE0)
    at = at[at < len(data) - 2]
    return at[UNSPACED[(data[at].astype(np.int64) << 8) | data[at + 1]]]


def item_rows(seed_words: int):
    """N-grams of each test item, with the item's words."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for block in blocks(batch.column(1), PIECE):
                h, first, starts, _ = word_hashes(block)
                at = starts_of(first, seed_words)
                owner = owners(first)[at]
                n = np.diff(first)
                single = sums_by(first, np.isin(starts, unspaced(block.data)).astype(np.int64))
                long = LONG * n / np.maximum(n - single * (1 - 1 / POINTS), 1)
                grams = ngrams(h, seed_words)[at] if len(at) else h[:0]
                bag = [signed(h[first[i] : first[i + 1]]) for i in owner.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(ids[block.start + owner], pa.int64()), pa.array((at - first[owner]).astype(np.int32)), pa.array(signed(grams)), pa.array(bag, pa.list_(pa.int64())), pa.array(long[owner])], schema=ITEM)

    return run


def corpus_rows(seed_words: int, sieve):
    """N-grams of the corpus that may be those of an item, once per occurrence."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for block in blocks(batch.column(1), PIECE):
                h, first, _, _ = word_hashes(block)
                grams = ngrams(h, seed_words)
                hits = np.flatnonzero(sieve.value.may(grams))
                hits = hits[np.isin(hits, starts_of(first, seed_words), assume_unique=True)] if len(hits) else hits
                yield pa.RecordBatch.from_arrays([pa.array(ids[block.start + owners(first)[hits]], pa.int64()), pa.array(signed(grams[hits]))], schema=SEED)

    return run


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman with a linear gap cost: best score, and the first and last aligned word of the text.

    Rows run over the item; a gap along the text is a running maximum."""
    n = len(text)
    ramp = np.arange(n + 1) * -GAP
    score, origin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    place = np.arange(n + 1)
    for word in item:
        step = np.where(text == word, MATCH, MISMATCH)
        new, source = np.zeros(n + 1, np.int64), place.copy()
        diagonal = score[:-1] + step
        up = score[1:] + GAP
        take = np.maximum(diagonal, up)
        good = take > 0
        new[1:][good] = take[good]
        source[1:][good] = np.where(diagonal >= up, origin[:-1], origin[1:])[good]
        lifted = new + ramp
        lead = np.maximum.accumulate(lifted)
        where = np.maximum.accumulate(np.where(lifted == lead, place, 0))
        new, source = lead - ramp, source[where]
        score, origin = new, source
        top = int(score.argmax())
        if score[top] > best[0]:
            best = (int(score[top]), int(origin[top]), top)
    return best


def aligned(least: float):
    """Leaks of each text among its items; column 2 and 3 list item classes and their words."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            items = batch.column(2).to_pylist()
            out = []
            for block in blocks(batch.column(1), PIECE):
                h, first, starts, ends = word_hashes(block)
                chars = np.append(0, np.cumsum((block.data & 0xC0) != 0x80))
                h = signed(h)
                for i in range(block.n):
                    a, b = int(first[i]), int(first[i + 1])
                    origin = int(chars[block.offsets[i]])
                    for item in items[block.start + i] or []:
                        words = np.array(item["words"], np.int64)
                        score, low, high = align(words, h[a:b])
                        share = score / (MATCH * len(words))
                        if share >= least or score >= MATCH * item["long"]:
                            out.append((ids[block.start + i], item["class_id"], share, low, high, int(chars[starts[a + low]]) - origin, int(chars[ends[a + high - 1]]) - origin))
            yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=FOUND.names), schema=FOUND, preserve_index=False)

    return run


def rare_seeds(grams: DataFrame, counts: DataFrame, stretch: int) -> DataFrame:
    """N-grams that are the rarest of some `stretch` consecutive ones of their item, or of all if it has fewer."""

    def run(batches):
        for batch in batches:
            frame = batch.to_pandas()
            out = []
            for row in frame.itertuples():
                order = sorted(row.grams, key=lambda g: g["at"])
                rank = np.array([g["n"] for g in order], np.uint64)
                width = min(stretch, len(rank))
                low = sliding(rank, width, np.minimum)
                chosen = sorted({i + int(rank[i : i + width].argmin()) for i in range(len(low))})
                out.extend((row.class_id, int(order[i]["h"])) for i in chosen)
            yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["class_id", "h"]).astype("int64"), preserve_index=False)

    counted = grams.join(counts, "h", "left").groupBy("class_id").agg(F.collect_list(F.struct("at", "h", F.coalesce("n", F.lit(0)).alias("n"))).alias("grams"))
    return counted.mapInArrow(released(run), "class_id long, h long").distinct()


def leaks(docs: DataFrame, items: DataFrame, least: float = LEAST, seed_words: int = SEED_WORDS, stretch: int = STRETCH, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """Leaks: doc_id, class_id, score (share of a perfect copy), place in words and in code points.
    Membership: item_id, class_id (the smallest item_id of equal words).

    Texts meet items through seeds only; an n-gram of many texts travels as counts first."""
    lower = lambda c: F.translate(F.lower(F.col(c)), "\u0000", " ")
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), lower(text).alias("text"))
    tests = items.select(F.col(item_id).cast("long").alias("item_id"), lower(item_text).alias("text"))
    rows = written(tests.where("item_id IS NOT NULL").mapInArrow(released(item_rows(seed_words)), from_arrow_schema(ITEM)), "item-grams")
    one = rows.where("at = 0").select("item_id", "words", "long")
    members = one.groupBy("words").agg(F.min("item_id").alias("class_id"), F.collect_set("item_id").alias("ids")).select(F.explode("ids").alias("item_id"), "class_id")
    members = written(members, "item-classes")
    classes = written(one.join(members, "item_id").where("item_id = class_id").dropDuplicates(["class_id"]).select("class_id", "words", "long"), "items")
    grams = rows.join(members, "item_id").where("item_id = class_id").select("class_id", "at", "h").distinct()
    sieve = docs.sparkSession.sparkContext.broadcast(bloom(grams.select("h").distinct()))
    named = texts.where("doc_id IS NOT NULL")
    seen = written(named.mapInArrow(released(corpus_rows(seed_words, sieve)), from_arrow_schema(SEED)).groupBy("doc_id", "h").agg(F.count("*").alias("n")), "seed-hits")
    counts = seen.groupBy("h").agg(F.sum("n").alias("n"))
    seeds = written(rare_seeds(grams, counts, stretch), "seeds")
    pairs = seen.join(seeds, "h").select("doc_id", "class_id").distinct()
    wanted = pairs.join(classes, "class_id").groupBy("doc_id").agg(F.collect_list(F.struct("class_id", "words", "long")).alias("items"))
    wanted = written(wanted, "candidates")
    # only texts that may be candidates are shuffled; sorted out without Python, as each Python step of a stage holds workers of its own
    found = named.where(may_be_in(wanted, "doc_id")).join(wanted, "doc_id").select("doc_id", "text", "items").mapInArrow(released(aligned(least)), from_arrow_schema(FOUND))
    best = found.groupBy("doc_id", "class_id").agg(F.max(F.struct("score", *FOUND.names[3:])).alias("best"))
    return best.select("doc_id", "class_id", "best.*"), members
