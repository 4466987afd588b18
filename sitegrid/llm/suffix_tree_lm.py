"""Language-model scores from a probabilistic suffix tree.

Symbols are the bytes of the lower-case words of a text, one space between words, a line
break before the first and after the last. Contexts are the last 1 to `DEPTH` symbols. A
context stays in the tree if the symbols after it diverge enough from those after its
suffix: the log-likelihood gained by it over the training text is the test. The next
symbol's distribution is smoothed with that of the longest shorter context in the tree,
and a text is scored with the longest context in the tree at every symbol.

The test alone decides what the tree holds. A tree of up to `MAX_STATES` states and
`MAX_ENTRIES` counts travels to every task. Of a larger one the log probability of every
distinct symbol with its context is worked out once in a table; the commonest `MAX_ENTRIES`
of these travel, and only the others, which are rare, meet the texts in a join. Words, for the
base score, do likewise: the commonest travel, the others are joined. Counts of words and
of symbols cover all training texts.

Null and empty texts have no words, one end and a score for it. Rows are scored one by
one, rows with one id too. Without training rows all probabilities are uniform. Word
counts go by 64-bit hashes of the words.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from sitegrid.llm.tables import gathered, written
from sitegrid.llm.text import LOWER, Block, Hasher, blocks, gather, mix, owners, released, signed, sums_by, words

DEPTH, LEAST_GAIN, LEAST_COUNT = 5, 12.0, 8
#: what travels to every task; the rest is joined
MAX_STATES, MAX_ENTRIES = 100_000, 1_000_000
COMMON = 1 << 17
SYMBOLS = 256
WORD, SYMBOL = 0, 1
SHARED = 2  # last bytes of a context by which the rest of the tree is dealt
END = 0  # stands for the end of a text among the hashes of words

HASH = Hasher(seed=9, lower=True)
U64 = np.uint64

COUNT = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64())])
PART = pa.schema([("row", pa.int64()), ("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64()), ("doc_id", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])


def sequences(block: Block) -> tuple[np.ndarray, np.ndarray, tuple]:
    """Symbols of a block with a line break before and after each text, where each text's begin, and its words."""
    starts, ends, first = words(block)
    size = ends - starts + 1
    n = np.diff(first)
    text_size = sums_by(first, size) + np.where(n == 0, 2, 1)
    until = np.append(0, np.cumsum(text_size))
    out = np.full(int(until[-1]), 0x0A, np.uint8)
    if len(starts):
        data = gather(np.append(LOWER[block.data], np.uint8(0)), starts, size)
        data[np.cumsum(size) - 1] = 0x20
        # texts with words: one place before them; those without hold two line breaks
        owner = owners(first)
        place = until[owner] + 1 + (np.cumsum(size) - size) - (np.append(0, np.cumsum(size))[first[:-1]])[owner]
        shift = np.repeat(place - (np.cumsum(size) - size), size)
        out[shift + np.arange(len(data))] = data
        filled = n > 0
        out[until[1:][filled] - 1] = 0x0A
    return out, until, (starts, ends, first)


def grams(symbols: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each symbol after the first of its text with the DEPTH before it, packed; zeros before a text begins."""
    packed = np.zeros(len(symbols), np.uint64)
    inside = np.arange(len(symbols)) - np.repeat(until[:-1], np.diff(until))
    for back in range(DEPTH, -1, -1):
        part = np.zeros(len(symbols), np.uint64)
        part[back:] = symbols[: len(symbols) - back] if back else symbols
        part[inside < back] = 0
        packed = (packed << U64(8)) | part
    keep = inside > 0
    return packed[keep], until - np.arange(len(until))


class Tally:
    """Counts of keys, merged now and then."""

    def __init__(self, limit: int):
        self.limit, self.keys, self.counts, self.size = limit, [], [], 0

    def add(self, keys: np.ndarray) -> bool:
        codes, found = pd.factorize(keys)
        self.keys.append(found)
        self.counts.append(np.bincount(codes, minlength=len(found)))
        self.size += len(found)
        if self.size > 2 * self.limit:
            self.merge()
        return self.size > self.limit and len(self.keys) == 1

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if self.keys:
            codes, found = pd.factorize(np.concatenate(self.keys))
            total = np.bincount(codes, np.concatenate(self.counts), minlength=len(found)).astype(np.int64)
            self.keys, self.counts, self.size = [found], [total], len(found)
            return found, total
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)


def count_rows(limit: int = 1_000_000):
    """Counts of words and of packed symbols of a task; a full tally goes out and begins anew."""

    def run(batches):
        tallies = {WORD: Tally(limit), SYMBOL: Tally(limit)}

        def flush(kind):
            keys, n = tallies[kind].merge()
            tallies[kind] = Tally(limit)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(signed(keys)), pa.array(n)], schema=COUNT)

        for batch in batches:
            for block in blocks(batch.column(0)):
                symbols, until, (starts, ends, _) = sequences(block)
                packed, _ = grams(symbols, until)
                hashed = np.append(HASH.ranges(block.data, starts, ends), np.full(block.n, END, np.uint64))
                for kind, keys in ((WORD, hashed), (SYMBOL, packed)):
                    if tallies[kind].add(keys):
                        yield flush(kind)
        for kind in tallies:
            yield flush(kind)

    return run


class Tree:
    """States by depth: their keys, totals and numbers of symbols; and the counts after them."""

    def __init__(self, levels: list[tuple[np.ndarray, ...]], root: np.ndarray):
        self.levels, self.root = levels, root

    def log_probability(self, packed: np.ndarray) -> np.ndarray:
        """log10 probability of the last symbol of each packed key after the longest context in the tree."""
        p = self.root[(packed & U64(0xFF)).astype(np.int64)]
        for depth, (states, totals, kinds, keys, counts) in enumerate(self.levels, 1):
            if not len(states):
                continue
            gram = packed & U64((1 << (8 * (depth + 1))) - 1)
            context = gram >> U64(8)
            at = np.minimum(np.searchsorted(states, context), len(states) - 1)
            hit = np.flatnonzero(states[at] == context)
            if not len(hit):
                continue
            at, gram = at[hit], gram[hit]
            place = np.minimum(np.searchsorted(keys, gram), len(keys) - 1)
            n = np.where(keys[place] == gram, counts[place], 0)
            p[hit] = (n + kinds[at] * p[hit]) / (totals[at] + kinds[at])
        return np.log10(p)


def grow(symbols: DataFrame, depth: int = DEPTH, least_gain: float = LEAST_GAIN, least_count: int = LEAST_COUNT, max_states: int = MAX_STATES, max_entries: int = MAX_ENTRIES) -> tuple[Tree, bool, DataFrame]:
    """The tree of packed symbol counts (key, n), through one aggregation per depth.

    Whether it is whole, with no state where it would be beyond the limits; and the counts
    after all states: depth, key, n, total and kinds."""
    levels = {depth: symbols.select("key", "n")}
    for d in range(depth - 1, -1, -1):
        shorter = levels[d + 1].groupBy(F.col("key").bitwiseAND((1 << (8 * (d + 1))) - 1).alias("key")).agg(F.sum("n").alias("n"))
        levels[d] = written(shorter, f"symbols-{d}")
    root_counts = gathered(levels[0])
    root = np.full(SYMBOLS, 0.5)
    root[root_counts["key"]] += root_counts["n"]
    root /= root.sum()
    states = None
    for d in range(1, depth + 1):
        own = levels[d].withColumn("context", F.shiftright("key", 8)).withColumn("shorter", F.col("key").bitwiseAND((1 << (8 * d)) - 1))
        total = own.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).where(F.col("total") >= least_count)
        below = levels[d - 1].select(F.col("key").alias("shorter"), F.col("n").alias("shorter_n"), F.shiftright("key", 8).alias("shorter_context"))
        below_total = below.groupBy("shorter_context").agg(F.sum("shorter_n").alias("shorter_total"))
        tested = own.join(total, "context").join(below, "shorter").join(below_total, "shorter_context")
        gain = F.sum(F.col("n") * (F.log(F.col("n") / F.col("total")) - F.log(F.col("shorter_n") / F.col("shorter_total"))))
        kept = tested.groupBy("context").agg(F.round(gain, 3).alias("gain"), F.first("total").alias("total"), F.first("kinds").alias("kinds")).where(F.col("gain") >= least_gain)
        kept = kept.select(F.lit(d).alias("depth"), "context", "gain", "total", "kinds")
        states = kept if states is None else states.union(kept)
    states = written(states, "states")
    after = None
    for d in range(1, depth + 1):
        own = levels[d].withColumn("context", F.shiftright("key", 8)).join(states.where(F.col("depth") == d).select("context", "total", "kinds"), "context")
        own = own.select(F.lit(d).alias("depth"), "key", "n", "total", "kinds")
        after = own if after is None else after.union(own)
    n_states, n_entries = states.agg(F.count("*"), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    whole = n_states <= max_states and n_entries <= max_entries
    out = []
    for d in range(1, depth + 1) if whole else ():
        rows = gathered(after.where(F.col("depth") == d).select("key", "n", "total", "kinds"))
        out.append(level(rows["key"].view(np.uint64), *(rows[c].astype(np.float64) for c in ("n", "total", "kinds"))))
    return Tree(out, root), whole, after


class Known:
    """Log probabilities of packed keys that are known beforehand, as a tree gives them; the others are not."""

    def __init__(self, keys: np.ndarray, p: np.ndarray):
        by_key = np.argsort(keys)
        self.keys, self.p = keys[by_key], p[by_key]

    def look_up(self, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each packed key, zero for others, and which are others."""
        if not len(self.keys):
            return np.zeros(len(packed)), np.ones(len(packed), bool)
        at = np.minimum(np.searchsorted(self.keys, packed), len(self.keys) - 1)
        there = self.keys[at] == packed
        return np.where(there, self.p[at], 0.0), ~there


def commonest(keys: DataFrame, limit: int) -> int:
    """The least n for which no more than `limit` rows of keys have n or more; by a bounded number of classes of n."""
    bucket = F.floor(F.log2("n") * 8)
    counts = keys.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("rows"), F.min("n").alias("least")).collect()
    total, least = 0, (1 << 63) - 1
    for r in sorted(counts, key=lambda r: -r["bucket"]):
        total += r["rows"]
        if total > limit:
            break
        least = r["least"]
    return least


def level(keys: np.ndarray, n: np.ndarray, totals: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, ...]:
    """States and counts of one depth, as a tree has them, from the rows of its counts."""
    by_key = np.argsort(keys)
    keys, n, totals, kinds = keys[by_key], n[by_key], totals[by_key], kinds[by_key]
    states, at = np.unique(keys >> U64(8), return_index=True)
    return states, totals[at], kinds[at], keys, n


def looked_up(shallow, size: int = 1 << 16):
    """Log probabilities of packed keys. Rows come sorted by group and depth, and the keys to look up after the counts of their group."""

    def run(batches):
        root, first = shallow.value
        held: list[np.ndarray] | None = None
        parts: list[list[np.ndarray]] = []

        def evaluate():
            nonlocal held, parts
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
            parts = []
            ask = columns[1] > DEPTH
            packed, n = columns[2][ask].view(np.uint64), columns[3][ask]
            known = [c[~ask] for c in columns]
            if held is not None:
                known = [np.append(a, b) for a, b in zip(held, known, strict=True)]
            levels = list(first)
            for d in range(SHARED, DEPTH + 1):
                mine = known[1] == d
                levels.append(level(known[2][mine].view(np.uint64), *(c[mine].astype(np.float64) for c in known[3:])))
            # the counts of the last group serve the keys that follow
            held = [c[known[0] == columns[0][-1]] for c in known]
            return pa.RecordBatch.from_arrays([pa.array(signed(packed)), pa.array(n), pa.array(Tree(levels, root).log_probability(packed))], names=["key", "n", "p"])

        for batch in batches:
            if batch.num_rows:
                parts.append([batch.column(i).to_numpy() for i in range(6)])
            if sum(len(p[0]) for p in parts) >= size:
                yield evaluate()
        if parts:
            yield evaluate()

    return run


def log_probabilities(keys: DataFrame, after: DataFrame, root: np.ndarray) -> DataFrame:
    """key, n and p, its log10 probability under the whole tree. keys: distinct packed keys and their n.

    All contexts of a key from two bytes on end in the same two bytes, so counts and keys
    are dealt by these; contexts of one byte, at most 256, go everywhere."""
    few = gathered(after.where(F.col("depth") < SHARED).select("key", "n", "total", "kinds"))
    first = [level(few["key"].view(np.uint64), *(few[c].astype(np.float64) for c in ("n", "total", "kinds")))]
    shallow = keys.sparkSession.sparkContext.broadcast((root, first))
    group = F.shiftright("key", 8).bitwiseAND((1 << (8 * SHARED)) - 1).alias("group")
    counts = after.where(F.col("depth") >= SHARED).select(group, "depth", "key", "n", "total", "kinds")
    zero = F.lit(0).cast("long")
    asked = keys.select(group, F.lit(DEPTH + 1).alias("depth"), "key", "n", zero.alias("total"), zero.alias("kinds"))
    dealt = counts.union(asked).repartition("group").sortWithinPartitions("group", "depth")
    return dealt.mapInArrow(released(looked_up(shallow)), "key long, n long, p double")


def score_rows(tree, common, end: float):
    """One row per text with the score of what travels (a tree, or known log probabilities) and the base score of
    its end and common words; one per other word of it, and one per other symbol with its context."""
    def run(batches):
        names, logs = common.value
        index = pd.Index(names)
        model = tree.value
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for block in blocks(batch.column(2)):
                symbols, until, (starts, ends, first) = sequences(block)
                packed, where = grams(symbols, until)
                codes, kinds = pd.factorize(packed)
                if isinstance(model, Known):
                    p, open_ = model.look_up(kinds)
                    asked = np.flatnonzero(open_[codes])
                    pairs, n = np.unique(owners(where)[asked] * len(kinds) + codes[asked], return_counts=True)
                    if len(pairs):
                        owner, key = np.divmod(pairs, len(kinds))
                        yield counted_part(rows[block.start + owner], SYMBOL, kinds[key], n)
                else:
                    p = model.log_probability(kinds)
                score = sums_by(where, p[codes])
                h = HASH.ranges(block.data, starts, ends)
                at = index.get_indexer(h)
                known = at >= 0
                base = sums_by(first, np.where(known, logs[np.maximum(at, 0)] if len(logs) else 0.0, 0.0)) + end
                n_known = sums_by(first, known.astype(np.int64))
                mine = pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.start, block.n),
                        pa.array(np.full(block.n, WORD, np.int32)),
                        pa.array(signed(_spread(rows[block.start : block.stop]))),
                        pa.array(np.diff(first) + 1),
                        batch.column(1).slice(block.start, block.n),
                        pa.array(n_known),
                        pa.array(base),
                        pa.array(score),
                    ],
                    schema=PART,
                )
                yield mine
                owner, other = owners(first)[~known], h[~known]
                if len(other):
                    frame = pd.DataFrame({"o": owner, "h": other}).groupby(["o", "h"], sort=False).size().reset_index(name="n")
                    yield counted_part(rows[block.start + frame["o"].to_numpy()], WORD, frame["h"].to_numpy(), frame["n"].to_numpy())

    return run


def counted_part(rows: np.ndarray, kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    size = len(rows)
    none, no_score = pa.nulls(size, pa.int64()), pa.nulls(size, pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(rows), pa.array(np.full(size, kind, np.int32)), pa.array(signed(keys)), pa.array(n), none, none, no_score, no_score], schema=PART)


def _spread(rows: np.ndarray) -> np.ndarray:
    """A key of its own for each text, so that rows without a word are dealt evenly."""
    return mix(rows.view(np.uint64) + U64(0x1234567))


def score(docs: DataFrame, training: Column, text: Column | str = "text", doc_id: Column | str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every text; learned from rows where `training` holds."""
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    spark = docs.sparkSession
    counted = docs.where(training).select(as_column(text).alias("text")).mapInArrow(released(count_rows()), from_arrow_schema(COUNT))
    counted = written(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    tokens = counted.where(F.col("kind") == WORD).select("key", "n")
    symbols = counted.where(F.col("kind") == SYMBOL).select("key", "n")
    grown, whole_tree, after = grow(symbols)
    known = tokens.where(F.col("key") != END).select(F.lit(WORD).alias("kind"), "key", F.col("n").alias("c"), F.lit(None).cast("double").alias("p"))
    model = grown
    if not whole_tree:
        others = docs.where(~F.coalesce(training, F.lit(False))).select(as_column(text).alias("text")).mapInArrow(released(count_rows()), from_arrow_schema(COUNT))
        keys = written(symbols.union(others.where(F.col("kind") == SYMBOL).select("key", "n")).groupBy("key").agg(F.sum("n").alias("n")), "symbols")
        least = commonest(keys, MAX_ENTRIES)
        p = written(log_probabilities(keys, after, grown.root), "log-probabilities")
        travel = gathered(p.where(F.col("n") >= least).select("key", "p"))
        model = Known(travel["key"].view(np.uint64), travel["p"])
        known = known.union(p.where(F.col("n") < least).select(F.lit(SYMBOL), "key", F.lit(None).cast("long"), "p"))
    tree = spark.sparkContext.broadcast(model)
    total, distinct = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    log_of = lambda c: np.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))
    ends = tokens.where(F.col("key") == END).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    top = gathered(tokens.where(F.col("key") != END).orderBy(F.desc("n"), "key").limit(COMMON))
    common = spark.sparkContext.broadcast((top["key"].view(np.uint64), log_of(top["n"].astype(np.float64))))
    known_end = int(ends > 0)
    narrow = docs.select(F.monotonically_increasing_id().alias("row"), as_column(doc_id).cast("long").alias("doc_id"), as_column(text).alias("text"))
    parts = narrow.mapInArrow(released(score_rows(tree, common, float(log_of(ends)))), from_arrow_schema(PART))
    # the commonest words are done, so no word left is in many texts
    joined = parts.join(known, ["kind", "key"], "left")
    is_symbol = F.col("kind") == SYMBOL
    is_word = F.col("score").isNull() & ~is_symbol
    seen = F.coalesce("c", F.lit(0))
    scale = float(total + 0.1 * (distinct + 1))
    out = joined.select(
        "row",
        "doc_id",
        F.when(F.col("score").isNotNull(), F.col("n")).alias("n_tokens"),
        F.when(is_symbol, 0).when(is_word, F.when(seen > 0, F.col("n")).otherwise(0)).otherwise(F.col("n_known") + known_end).alias("n_known"),
        F.when(is_symbol, 0.0).when(is_word, F.col("n") * F.log10((seen + 0.1) / scale)).otherwise(F.col("base")).alias("base"),
        F.when(is_symbol, F.col("n") * F.col("p")).otherwise(F.col("score")).alias("score"),
    )
    whole = out.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").cast("long").alias("n_known"), F.sum("base").alias("base_score"), F.sum("score").alias("score"))
    return whole.select("doc_id", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score")
