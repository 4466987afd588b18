"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, a function of its code point. An n-gram
is bound from its letters: their vectors are permuted (rotated) by the place in the
n-gram and multiplied. A text bundles (adds) the vectors of its n-grams, a language
prototype bundles those of all its training texts. A text gets the language whose
prototype, less the mean of all prototypes, has the largest cosine with it.

Runs of characters that are not letters count as one word boundary. Texts that are
null or have no letter get `und` and score 0. Rows are scored one by one; training rows
without a language are left out; an empty training set gives `und` throughout.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from sitegrid.llm.byte_bpe import CONTRACTION, LETTER, code_point_classes, code_points
from sitegrid.llm.text import Block, blocks, owners, released, starts_of

DIMENSIONS, N, SEED = 1024, 3, 7
BITS = 21  # of a code point
BLOCK = 1 << 20


@lru_cache(1)
def letters() -> np.ndarray:
    """Lower-case code point of each letter, 0 for other code points."""
    kinds = code_point_classes()
    table = np.zeros(len(kinds), np.int64)
    found = np.flatnonzero((kinds == LETTER) | np.isin(kinds, list(CONTRACTION.values())))
    table[found] = [ord(low) if len(low := chr(c).lower()) == 1 and not 0xD800 <= c < 0xE000 else c for c in found.tolist()]
    return table


def letter_vectors(points: np.ndarray, dimensions: int) -> np.ndarray:
    """Vectors of code points: bit d of a hash of the code point and d gives the sign."""
    from sitegrid.llm.text import mix

    d = np.arange(dimensions, dtype=np.uint64)
    h = mix(points.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + mix(d + np.uint64(SEED << 32))[None, :])
    return np.where(h >> np.uint64(63), np.float32(1), np.float32(-1))


def grams(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams of a block and the index of their text."""
    points, at = code_points(block)
    letter = letters()[points]
    first = np.searchsorted(at, block.offsets)
    # one boundary before each text and after each run of letters
    owner = owners(first)
    repeat = np.zeros(len(letter), bool)
    repeat[1:] = (letter[1:] == 0) & (letter[:-1] == 0) & (owner[1:] == owner[:-1])
    letter, owner = letter[~repeat], owner[~repeat]
    first = np.searchsorted(owner, np.arange(block.n + 1))
    padded = np.zeros(len(letter) + 2 * block.n, np.int64)
    place = np.arange(len(letter)) + 2 * owner + 1
    padded[place] = letter
    ends = first + 2 * np.arange(block.n + 1)
    pos = starts_of(ends, N)
    packed = np.zeros(len(pos), np.int64)
    for k in range(N):
        packed = (packed << BITS) | padded[pos + k]
    text = owners(ends)[pos]
    real = (padded[pos + 1] != 0) | (padded[pos] != 0) | (padded[pos + 2] != 0)
    return packed[real], text[real]


class Codebook:
    """Vectors of letters and n-grams seen by a worker."""

    def __init__(self, dimensions: int):
        self.dimensions, self.known = dimensions, {}

    def letter(self, point: int, shift: int) -> np.ndarray:
        key = (point, shift)
        if key not in self.known:
            if len(self.known) > 30_000:
                self.known.clear()
            self.known[key] = np.roll(letter_vectors(np.array([point]), self.dimensions)[0], shift).astype(np.int8)
        return self.known[key]

    def vectors(self, packed: np.ndarray) -> np.ndarray:
        """Vectors of packed n-grams: permuted letters multiplied."""
        out = None
        for k in range(N):
            points = (packed >> (BITS * (N - 1 - k))) & ((1 << BITS) - 1)
            codes, found = pd.factorize(points)
            rows = np.stack([self.letter(int(p), N - 1 - k) for p in found])[codes]
            out = rows if out is None else np.multiply(out, rows, out=out)
        return out


@lru_cache(1)
def codebook_of(dimensions: int) -> Codebook:
    return Codebook(dimensions)


def bundles(block: Block, dimensions: int, step: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """The bundled vector of each text and its number of n-grams."""
    packed, text = grams(block)
    out = np.zeros((block.n, dimensions), np.float32)
    if len(packed):
        codes, kinds = pd.factorize(packed)
        book = codebook_of(dimensions)
        order = np.argsort(codes, kind="stable")
        text, codes = text[order], codes[order]
        for low in range(0, len(kinds), step):
            a, b = np.searchsorted(codes, [low, low + step])
            width = min(step, len(kinds) - low)
            counts = np.bincount(text[a:b] * width + codes[a:b] - low, minlength=block.n * width)
            out += counts.reshape(block.n, width).astype(np.float32) @ book.vectors(kinds[low : low + width]).astype(np.float32)
    return out, np.bincount(text, minlength=block.n)


def prototypes(docs: DataFrame, text: Column | str, lang: Column | str, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Sum of the n-gram vectors of all training texts of each language.

    Only sums travel: one vector per task and language, added up by dimension. The
    result has one vector per language."""
    schema = pa.schema([("lang", pa.string()), ("dim", pa.int32()), ("value", pa.float64())])

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for block in blocks(batch.column(1), BLOCK):
                packed, owner = grams(block)
                if not len(packed):
                    continue
                codes, kinds = pd.factorize(packed)
                labels, names = pd.factorize(langs[block.start : block.stop])
                counts = np.bincount(labels[owner] * len(kinds) + codes, minlength=len(names) * len(kinds)).reshape(len(names), -1)
                book = codebook_of(dimensions)
                for low in range(0, len(kinds), 4096):
                    part = counts[:, low : low + 4096].astype(np.float64) @ book.vectors(kinds[low : low + 4096]).astype(np.float64)
                    for name, row in zip(names, part, strict=True):
                        sums[name] = sums[name] + row if name in sums else row
        for name, row in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * dimensions, pa.string()), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(row)], schema=schema)

    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    fit = docs.select(as_column(lang).cast("string").alias("lang"), as_column(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    total = fit.mapInArrow(released(run), from_arrow_schema(schema)).groupBy("lang", "dim").agg(F.sum("value").alias("value")).toPandas()
    if total.empty:
        return [], np.zeros((0, dimensions))
    table = total.pivot(index="lang", columns="dim", values="value").sort_index()
    return table.index.tolist(), table.to_numpy(np.float64)


def centred(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit prototypes less their mean, and that mean."""
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    middle = unit.mean(axis=0) if len(unit) > 1 else np.zeros(unit.shape[1])
    return (unit - middle).astype(np.float32), middle.astype(np.float32)


def identify(docs: DataFrame, names: list[str], vectors: np.ndarray, text: Column | str = "text", doc_id: Column | str = "doc_id") -> DataFrame:
    """doc_id, lang_pred and score: the cosine with the chosen prototype, mapped from -1..1 to 0..1."""
    dimensions = vectors.shape[1]
    rows, middle = centred(vectors)
    norms = np.maximum(np.linalg.norm(rows, axis=1), 1e-9)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(1), BLOCK):
                found, n = bundles(block, dimensions)
                found /= np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-9)
                found -= middle
                length = np.maximum(np.linalg.norm(found, axis=1), 1e-9)
                if names:
                    cosine = (found @ rows.T) / (length[:, None] * norms[None, :])
                    best = cosine.argmax(axis=1)
                    lang = [names[b] if k else "und" for b, k in zip(best.tolist(), n.tolist(), strict=True)]
                    score = np.where(n > 0, np.clip((1 + cosine[np.arange(block.n), best].astype(np.float64)) / 2, 0, 1), 0.0)
                else:
                    lang, score = ["und"] * block.n, np.zeros(block.n)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.start, block.n), pa.array(lang, pa.string()), pa.array(score)], schema=schema)

    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    narrow = docs.select(as_column(doc_id).cast("long").alias("doc_id"), as_column(text).alias("text"))
    return narrow.mapInArrow(released(run), from_arrow_schema(schema))
