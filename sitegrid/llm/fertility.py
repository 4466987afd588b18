"""Quality rules from tokeniser fertility.

A public vocabulary with byte fallback cuts the words of a text into tokens. Three
measures follow: word characters per token, the share of tokens that are byte fallbacks,
and the entropy of the tokens, against that of as many different ones. A second
vocabulary, of byte pairs, adds its own characters per token if its file is given. Each language (or script) has its
own band per measure: its median over all texts that pass the base rule, and a number of
median deviations on either side. A mean over tokens may stray further in a short text,
so its deviations are taken times the root of the number of tokens. Texts outside a band
are rejected, as are short texts and texts of repeats.

Null and empty texts have no words and fail the base rule. Rows are judged one by one;
repeated rows give repeated results. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from sitegrid.llm.byte_bpe import encode, vocabulary_of
from sitegrid.llm.tables import written
from sitegrid.llm.text import Block, Hasher, blocks, gather, ngrams, owners, released, spans, starts_of, sums_by, words

U64 = np.uint64
#: fixed values: the characters counted as symbols
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: measure -> smallest deviation a band assumes
FLOORS = {"chars_per_token": 0.3, "second_chars_per_token": 0.3, "byte_share": 0.1, "entropy": 0.02}
#: means over tokens: their deviations shrink with the root of the number of tokens, and are compared at one token
MEANS = ("chars_per_token", "second_chars_per_token", "byte_share")
WIDTH = 8.0

HASH = Hasher(seed=10)

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SCHEMA = pa.schema([("doc_id", pa.int64()), ("lang", pa.string())] + [(c, pa.int64()) for c in [*COUNTS, "n_tokens"]] + [(m, pa.float64()) for m in FLOORS])


class Pieces:
    """Token ids of words under a vocabulary with byte fallback and one of byte pairs, each word encoded once."""

    def __init__(self, piece_path: str, pair_path: str | None, remember: int = 200_000):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.fallback = np.array([self.model.is_byte(i) for i in range(self.model.vocab_size())])
        self.pairs = vocabulary_of(pair_path) if pair_path else None
        self.remember, self.known = remember, {}

    def of(self, found: list[bytes]) -> list[tuple[list[int], int]]:
        if len(self.known) > self.remember:
            self.known.clear()
        new = [w for w in found if w not in self.known]
        if new:
            ids = self.model.encode([w.decode() for w in new], num_threads=1)
            second = self._second(new) if self.pairs else [len(i) for i in ids]
            self.known.update((w, (i, s)) for w, i, s in zip(new, ids, second, strict=True))
        return [self.known[w] for w in found]

    def _second(self, found: list[bytes]) -> list[int]:
        spaced = [b" " + w for w in found]
        at = np.append(0, np.cumsum(np.fromiter(map(len, spaced), np.int64, len(spaced))))
        return np.diff(encode(Block(np.frombuffer(b"".join(spaced), np.uint8), at, 0), self.pairs)[1]).tolist()


@lru_cache(1)
def pieces_of(piece_path: str, pair_path: str | None) -> Pieces:
    return Pieces(piece_path, pair_path)


def earlier_equal(owner: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element whether an equal one of the same owner comes before it, and whether any other is equal."""
    codes = pd.factorize(h ^ (owner.astype(U64) * U64(0x9E3779B97F4A7C15)))[0]
    seen = pd.Series(codes).duplicated().to_numpy()
    return seen, np.bincount(codes)[codes] > 1 if len(codes) else seen


def base_counts(block: Block, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
    data = block.data
    at = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    chars = sums_by(first, at[ends] - at[starts])
    symbols = np.append(0, np.cumsum(SYMBOLS[data]))[block.offsets]
    begins, stops, lines = spans(block, data != 0x0A)
    with_word = np.searchsorted(starts, stops) > np.searchsorted(starts, begins)
    owner = owners(lines)
    seen, _ = earlier_equal(owner, HASH.ranges(data, begins, stops))
    # a line without words may equal another one, so it never hides one with words
    dup_lines = np.bincount(owner[seen & with_word], minlength=block.n)
    windows = starts_of(first, 3)
    word_owner = owners(first)
    repeat = np.zeros(len(starts) + 1, np.int64)
    if len(windows):
        _, again = earlier_equal(word_owner[windows], ngrams(h, 3)[windows])
        hits = windows[again]
        np.add.at(repeat, hits, 1)
        np.add.at(repeat, hits + 3, -1)
    return [np.diff(first), chars, np.diff(symbols), dup_lines, sums_by(first, (np.cumsum(repeat)[:-1] > 0).astype(np.int64))]


def fertility(block: Block, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, h: np.ndarray, chars: np.ndarray, pieces: Pieces) -> list[np.ndarray]:
    n = block.n
    if not len(starts):
        return [np.zeros(n, np.int64), *[np.zeros(n)] * 4]
    codes, keys = pd.factorize(h)
    one = np.empty(len(keys), np.int64)
    one[codes[::-1]] = np.arange(len(codes))[::-1]
    raw = block.data.tobytes()
    got = pieces.of([raw[s:e] for s, e in zip(starts[one].tolist(), ends[one].tolist(), strict=True)])
    sizes = np.fromiter((len(i) for i, _ in got), np.int64, len(got))
    second = np.fromiter((s for _, s in got), np.int64, len(got))
    flat = np.fromiter(chain.from_iterable(i for i, _ in got), np.int64, int(sizes.sum()))
    ids = gather(flat, (np.cumsum(sizes) - sizes)[codes], sizes[codes])
    until = np.append(0, np.cumsum(sizes[codes]))[first]
    tokens = np.diff(until)
    owner = owners(until)
    fallbacks = sums_by(until, pieces.fallback[ids].astype(np.int64))
    each, kinds = pd.factorize(owner * 2**32 + ids)
    counts = np.bincount(each)
    total = np.maximum(tokens, 1)
    share = counts / total[kinds >> 32]
    entropy = np.bincount(kinds >> 32, -share * np.log2(share), minlength=n) / np.log2(np.maximum(total, 2))
    return [tokens, chars / total, chars / np.maximum(sums_by(first, second[codes]), 1), fallbacks / total, entropy]


def measures(docs: DataFrame, piece_path: str, pair_path: str | None = None, text: Column | str = "text", doc_id: Column | str = "doc_id", group: Column | str = "lang") -> DataFrame:
    """One row per text: doc_id, lang (the group of its bands), the base counts and the measures."""

    def run(batches):
        pieces = pieces_of(piece_path, pair_path)
        for batch in batches:
            for block in blocks(batch.column(2)):
                starts, ends, first = words(block)
                h = HASH.ranges(block.data, starts, ends)
                counts = base_counts(block, starts, ends, first, h)
                rest = fertility(block, starts, ends, first, h, counts[1], pieces)
                rows = [batch.column(i).slice(block.start, block.n) for i in range(2)]
                yield pa.RecordBatch.from_arrays([*rows, *(pa.array(c, f.type) for c, f in zip(counts + rest, list(SCHEMA)[2:], strict=True))], schema=SCHEMA)

    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    narrow = docs.select(as_column(doc_id).cast("long").alias("doc_id"), F.coalesce(as_column(group).cast("string"), F.lit("und")).alias("lang"), as_column(text).alias("text"))
    return narrow.mapInArrow(released(run), from_arrow_schema(SCHEMA))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def deviation(measure: str) -> Column:
    away = F.abs(F.col(measure) - F.col(f"{measure}_mid"))
    return away * F.sqrt("n_tokens") if measure in MEANS else away


def bands(measured: DataFrame) -> DataFrame:
    """Median of each measure and the median deviation from it, per group, over all texts that pass the base rule."""
    fit = measured.where(~base_failed())
    middle = fit.groupBy("lang").agg(*(F.percentile_approx(m, 0.5, 1000).alias(f"{m}_mid") for m in FLOORS))
    spread = fit.join(middle, "lang").groupBy("lang").agg(*(F.percentile_approx(deviation(m), 0.5, 1000).alias(f"{m}_dev") for m in FLOORS))
    return middle.join(spread, "lang")


def judge(docs: DataFrame, piece_path: str, pair_path: str | None = None, text: Column | str = "text", doc_id: Column | str = "doc_id", group: Column | str = "lang", width: float = WIDTH) -> DataFrame:
    """Counts, measures, base_failed and kept for every text. A text is kept if it passes
    the base rule and each measure lies in the band of its group. Measures are written
    to the shared folder once; they are a few numbers per text. Bands are one row per
    group, and Spark broadcasts them only if they are small."""
    measured = written(measures(docs, piece_path, pair_path, text, doc_id, group), "fertility")
    inside = F.lit(True)
    for m, floor in FLOORS.items():
        inside = inside & (deviation(m) <= width * F.greatest(F.col(f"{m}_dev"), F.lit(floor)))
    return measured.join(bands(measured), "lang", "left").select(
        "doc_id", *COUNTS, base_failed().alias("base_failed"), (~base_failed() & F.coalesce(inside, F.lit(True))).alias("kept"), "lang", "n_tokens", *FLOORS
    )
