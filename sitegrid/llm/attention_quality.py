"""Quality classifier by attention over passages (multiple-instance learning).

A text is a bag of passages of 64 words, or of a 64th of its words if that is more.
Each passage is encoded as shares of character kinds, repetition, word shape and hashed
words. A gated attention, learned from labels of whole texts, weighs the passages; the
weighted representation is scored. The model is fitted with numpy on the driver, on at
most `sample` labelled texts taken in the order of a hash; scoring covers every text.

Null and empty texts are one empty passage and get the score of that. Rows are scored
one by one. A training set without both labels gives a model that scores its base rate.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from sitegrid.llm.text import LOWER, Block, Hasher, blocks, released, words

PASSAGE_WORDS, MAX_PASSAGES = 64, 64
SAMPLE, HIDDEN, ATTENTION = 8000, 16, 8
KINDS, BUCKETS = 14, 32
WIDTH = KINDS + 6 + BUCKETS
THRESHOLD = 0.3

HASH = Hasher(seed=4, lower=True)

#: kind of each byte: letters, capitals, digits, other bytes of letters, marks of their own, the rest
KIND = np.full(256, 13, np.uint8)
KIND[97:123], KIND[65:91], KIND[48:58], KIND[128:] = 0, 1, 2, 3
for _kind, _marks in enumerate((b".,;:", b"!?", b"|", b"#", b"*", b"$%&", b"<>{}[]()", b"'\"-_/\\", b"\n"), 4):
    KIND[list(_marks)] = _kind


def encode(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Passage vectors of a block and the first passage of each text."""
    starts, ends, first = words(block)
    n_words = np.diff(first)
    size = np.maximum(PASSAGE_WORDS, -(-n_words // MAX_PASSAGES))
    n_passages = np.maximum(1, -(-n_words // size))
    until = np.append(0, np.cumsum(n_passages))
    text = np.repeat(np.arange(block.n), n_words)
    passage = until[text] + (np.arange(len(starts)) - first[text]) // size[text]
    total = int(until[-1])
    out = np.zeros((total, WIDTH), np.float32)
    if not len(starts):
        return out, until
    # a passage reaches to the beginning of the next one, white space included
    head = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
    filled = passage[head]
    low = starts[head]
    high = np.append(low[1:], len(block.data))
    high = np.minimum(high, block.offsets[text[head] + 1])
    for k in range(KINDS):
        sums = np.append(0, np.cumsum(KIND[block.data] == k))
        out[filled, k] = (sums[high] - sums[low]) / np.maximum(high - low, 1)
    h = HASH.ranges(block.data, starts, ends)
    count = np.bincount(passage, minlength=total)
    each = np.maximum(count, 1).astype(np.float32)
    mean = lambda x: np.bincount(passage, x, minlength=total) / each
    length = ends - starts
    same = np.append(False, (h[1:] == h[:-1]) & (passage[1:] == passage[:-1]))
    order = np.lexsort((h, passage))
    new = np.append(True, (h[order][1:] != h[order][:-1]) | (passage[order][1:] != passage[order][:-1]))
    capital, mark = KIND[block.data[starts]] == 1, KIND[block.data[ends - 1]]
    out[:, KINDS] = np.minimum(mean(length) / 16, 4)
    out[:, KINDS + 1] = mean(same)
    out[:, KINDS + 2] = np.bincount(passage[order], new, minlength=total) / each
    out[:, KINDS + 3] = mean(capital)
    out[:, KINDS + 4] = mean((mark >= 4) & (mark != 4))
    out[:, KINDS + 5] = mean(length == 1)
    bucket = (h >> np.uint64(8)) % np.uint64(BUCKETS)
    sign = np.where(h >> np.uint64(63), 1.0, -1.0)
    hashed = np.bincount(passage * BUCKETS + bucket.astype(np.int64), sign, minlength=total * BUCKETS)
    out[:, KINDS + 6 :] = hashed.reshape(total, BUCKETS) / np.sqrt(each)[:, None] / 4
    return out, until


@dataclass
class Model:
    """Weights by name, with the mean and spread of the inputs."""

    weights: dict[str, np.ndarray]
    centre: np.ndarray
    spread: np.ndarray

    def forward(self, x: np.ndarray, until: np.ndarray) -> tuple:
        w = self.weights
        x = (x - self.centre) / self.spread
        hidden = np.tanh(x @ w["encode"] + w["encode_0"])
        left, gate = np.tanh(hidden @ w["left"]), 1 / (1 + np.exp(-(hidden @ w["gate"])))
        raw = (left * gate) @ w["attend"]
        text = np.repeat(np.arange(len(until) - 1), np.diff(until))
        raw = np.exp(raw - np.maximum.reduceat(raw, until[:-1])[text])
        share = raw / np.add.reduceat(raw, until[:-1])[text]
        pooled = np.add.reduceat(share[:, None] * hidden, until[:-1])
        score = 1 / (1 + np.exp(-(pooled @ w["score"] + w["score_0"][0])))
        return x, hidden, left, gate, share, text, pooled, score

    def score(self, x: np.ndarray, until: np.ndarray) -> np.ndarray:
        return self.forward(x, until)[-1].astype(np.float64)


def fit(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 40, rate: float = 0.01, batch: int = 256, seed: int = 4) -> Model:
    """Minimise the log loss with Adam; a small decay keeps weights bounded."""
    rng = np.random.default_rng(seed)
    everything = np.concatenate(bags) if bags else np.zeros((1, WIDTH), np.float32)
    centre, spread = everything.mean(0), everything.std(0) + 0.02
    shape = {"encode": (WIDTH, HIDDEN), "encode_0": (HIDDEN,), "left": (HIDDEN, ATTENTION), "gate": (HIDDEN, ATTENTION), "attend": (ATTENTION,), "score": (HIDDEN,), "score_0": (1,)}
    w = {k: (rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 or k in ("attend", "score") else np.zeros(s)) for k, s in shape.items()}
    model = Model(w, centre, spread)
    share = float(np.clip(labels.mean() if len(labels) else 0.5, 0.001, 0.999))
    w["score_0"][0] = np.log(share / (1 - share))
    if len(set(labels.tolist())) < 2:
        w["score"][:] = 0
        return model
    first, second, step = {k: np.zeros(s) for k, s in shape.items()}, {k: np.zeros(s) for k, s in shape.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for low in range(0, len(order), batch):
            chosen = order[low : low + batch]
            until = np.append(0, np.cumsum([len(bags[i]) for i in chosen]))
            x, hidden, left, gate, weight, text, pooled, score = model.forward(np.concatenate([bags[i] for i in chosen]), until)
            d_out = (score - labels[chosen]) / len(chosen)
            d_pooled = d_out[:, None] * w["score"]
            d_hidden = weight[:, None] * d_pooled[text]
            d_share = (d_pooled[text] * hidden).sum(1)
            d_raw = weight * (d_share - np.add.reduceat(weight * d_share, until[:-1])[text])
            d_left = d_raw[:, None] * w["attend"] * gate * (1 - left**2)
            d_gate = d_raw[:, None] * w["attend"] * left * gate * (1 - gate)
            d_hidden += d_left @ w["left"].T + d_gate @ w["gate"].T
            d_in = d_hidden * (1 - hidden**2)
            grads = {"encode": x.T @ d_in, "encode_0": d_in.sum(0), "left": hidden.T @ d_left, "gate": hidden.T @ d_gate, "attend": (left * gate).T @ d_raw, "score": pooled.T @ d_out, "score_0": np.array([d_out.sum()])}
            step += 1
            now = rate * (1 - epoch / epochs)
            for k, g in grads.items():
                g = g + 1e-4 * w[k]
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g**2 - second[k])
                w[k] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "label", sample: int = SAMPLE) -> Model:
    """Fit on the texts of at most `sample` labels, taken in the order of a hash of the id.

    labels: doc_id and label, the rows to learn from. The chosen ones are that few, so
    they travel to the texts, which are not shuffled."""
    schema = pa.schema([("key", pa.int64()), ("label", pa.float64()), ("bag", pa.list_(pa.float32()))])

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(2)):
                x, until = encode(block)
                flat = pa.ListArray.from_arrays(pa.array(until * WIDTH, pa.int32()), pa.array(x.reshape(-1)))
                rows = [batch.column(i).slice(block.start, block.n) for i in range(2)]
                yield pa.RecordBatch.from_arrays([*rows, flat], schema=schema)

    given = labels.select(F.col(doc_id).cast("long").alias("key"), F.col(label).cast("double").alias("label")).where("key IS NOT NULL AND label IS NOT NULL")
    chosen = given.orderBy(F.xxhash64("key"), "key", "label").limit(sample)
    texts = docs.select(F.col(doc_id).cast("long").alias("key"), F.col(text).alias("text"))
    got = texts.join(F.broadcast(chosen), "key").select("key", "label", "text").mapInArrow(released(run), from_arrow_schema(schema)).toPandas()
    got["size"] = got["bag"].str.len()
    got = got.sort_values(["key", "label", "size"], kind="stable").head(sample)
    return fit([np.asarray(b, np.float32).reshape(-1, WIDTH) for b in got["bag"]], got["label"].to_numpy(np.float64))


def score(docs: DataFrame, model: Model, text: Column | str = "text", doc_id: Column | str = "doc_id") -> DataFrame:
    """doc_id and score of every text. The model is a few thousand numbers and travels with the task."""
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    return score_rows(docs.select(as_column(doc_id).cast("long").alias("doc_id"), as_column(text).alias("text")), model).select("doc_id", "score")


def score_rows(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """All columns of docs and a further column `into`, which docs must not have."""
    at = docs.columns.index(text)
    schema = StructType([*docs.schema.fields, StructField(into, DoubleType())])

    def run(batches):
        for batch in batches:
            scores = [model.score(*encode(block)) for block in blocks(batch.column(at))]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, into])

    return docs.mapInArrow(released(run), schema)
