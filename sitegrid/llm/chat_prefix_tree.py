"""Chat formatting along a prefix tree: initial turns that conversations share come out once.

Every turn is formatted as `<turn:ROLE>\\nTEXT\\n</turn>\\n`. A control string (`<turn:` or
`</turn>`) inside a text gets one more backslash in front, so a bare one is always the
template's; a line break parts the text from the end mark, so a backslash at the end of a
text does not touch it. Roles escape `\\`, `<`, `>` and line breaks.

The distinct beginnings of conversations are the nodes of a tree. Their last turns, in
depth-first order, make up one stream in which each character of the formatted text has a
place; a token here is a code point. A segment of the output is the turn of one node:

* start, size: its place in the stream;
* position: position id of its first token, the tokens of all turns before it in its
  conversations; the others follow one by one;
* attention: the stream ranges of its ancestors, which its tokens may look at besides
  their own segment up to themselves; ranges that touch are merged;
* loss_from, loss_to: the part of the segment, in code points, that is learned (the text of
  a role to learn, null for others);
* conv_id, turn_no: one conversation that has it, and which of its turns it is.

`conversations` of the output list the starts of each conversation's segments.

Paths are dealt into sorted shards (`turns.py`). A first pass gives the size of the stream
in each shard and the places of skeleton nodes, a few numbers a shard; sums over them place
the shards in the stream, and a second pass gives out segments. A shard leaves out the
skeleton nodes that an earlier shard ended with. Texts travel once, to their segments.

Null roles and texts are empty. Turns are ordered by turn (null first), ties by role and a
digest of the text. Rows without an id are one conversation, whose id is null. Repeated rows
are turns of their own. A conversation has to fit a row.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from sitegrid.llm.tables import written
from sitegrid.llm.text import released
from sitegrid.llm.turns import LOWEST, WIDTH, Rows, Skeleton, path_of, role_text, shard_count, shared_turns, sorted_shards, splitters, turn_digest, turn_order, walk

OPEN, CLOSE = "<turn:", "</turn>"
#: what stands in a role for characters that mean something in a header
ROLE_ESCAPES = (("\\", "\\\\"), ("<", "\\l"), (">", "\\g"), ("\n", "\\n"))
#: bare, it ends a turn
END = f"\n{CLOSE}\n"

RANGES = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
SEGMENTS = pa.schema([("conv_id", pa.int64()), ("turn_no", pa.int64()), ("start", pa.int64()), ("size", pa.int64()), ("position", pa.int64()), ("attention", RANGES), ("starts", pa.list_(pa.int64()))])
PLACES = pa.schema([("shard", pa.int64()), ("total", pa.int64()), ("first", pa.list_(pa.int64())), ("last", pa.list_(pa.int64())), ("nodes", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))])


def escaped(text: Column) -> Column:
    for mark in (OPEN, CLOSE):
        text = F.replace(text, F.lit(mark), F.lit("\\" + mark))
    return text


def unescaped(text: Column) -> Column:
    for mark in (OPEN, CLOSE):
        text = F.replace(text, F.lit("\\" + mark), F.lit(mark))
    return text


def escaped_role(role: Column) -> Column:
    for bare, safe in ROLE_ESCAPES:
        role = F.replace(role, F.lit(bare), F.lit(safe))
    return role


def unescaped_role(role: Column) -> Column:
    # pairs of backslashes part the text into stretches in which each backslash begins an escape
    def plain(part: Column) -> Column:
        for bare, safe in ROLE_ESCAPES[1:]:
            part = F.replace(part, F.lit(safe), F.lit(bare))
        return part

    return F.array_join(F.transform(F.split(role, r"\\\\", -1), plain), "\\")


def header(role: Column) -> Column:
    return F.concat(F.lit(OPEN), escaped_role(role), F.lit(">\n"))


def formatted(role: Column, text: Column) -> Column:
    return F.concat(header(role), escaped(text), F.lit(END))


def read_turns(stream: Column) -> Column:
    """array<struct<role, text>> from the formatted turns of a conversation."""
    parts = F.split(stream, END, -1)
    whole = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(part: Column) -> Column:
        at = F.instr(part, F.lit(">\n"))
        role = F.substr(part, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)
        return F.struct(unescaped_role(role).alias("role"), unescaped(F.substr(part, at + 2)).alias("text"))

    return F.transform(whole, turn)


@dataclass
class Output:
    segments: DataFrame
    conversations: DataFrame


class Stack:
    """Open nodes of a shard: stream offset, size, depth-wise position, ancestors' ranges, skeleton number."""

    def __init__(self, skeleton: Skeleton):
        self.skeleton = skeleton
        self.shard, self.before = None, b""

    def begin(self, shard: int) -> None:
        self.shard, self.before, self.total, self.nodes = shard, b"", 0, []

    def opened(self, path: bytes, sizes: list[int]):
        """Move on to a conversation; yields (depth, local offset, size, skeleton number) of nodes that begin with it."""
        keep = shared_turns(self.before, path) if self.nodes else 0
        del self.nodes[keep:]
        for k in range(keep, len(path) // WIDTH):
            sk = self.skeleton.below(self.nodes[-1] if k else 0, path[WIDTH * k : WIDTH * (k + 1)])
            self.nodes.append(sk)
            yield k, self.total, sizes[k], sk
            self.total += sizes[k]
        self.before = path

    def in_skeleton(self) -> list[int]:
        return [sk for sk in self.nodes if sk >= 0]


def _measure(shared):
    """A row for each shard: its stream's size, skeleton nodes of its first and last path, and where skeleton nodes begin."""

    def run(batches):
        stack, out, first, seen = Stack(shared.value), Rows(PLACES), None, []

        def end():
            if stack.shard is not None:
                nodes, offsets, sizes = zip(*seen, strict=True) if seen else ((), (), ())
                out.add(stack.shard, stack.total, first, stack.in_skeleton(), nodes, offsets, sizes)

        for shard, _, path, sizes in walk(batches):
            if shard != stack.shard:
                end()
                stack.begin(shard)
                first, seen = None, []
            seen += [(sk, at, size) for _, at, size, sk in stack.opened(path, sizes) if sk >= 0]
            first = stack.in_skeleton() if first is None else first
            yield from out.batches()
        end()
        yield from out.batches(rest=True)

    return run


def place(measured: list) -> tuple[dict[int, tuple[int, int]], dict[int, int]]:
    """By shard: what to add to its offsets, and how many nodes of its first path belong to
    earlier shards. By skeleton node: where it begins."""
    shards, starts, end, last = {}, {}, 0, []
    for row in sorted(measured, key=lambda r: r.shard):
        mine = 0
        while mine < min(len(last), len(row.first)) and last[mine] == row.first[mine]:
            mine += 1
        size = dict(zip(row.nodes, row.sizes, strict=True))
        before = sum(size[sk] for sk in row.first[:mine])
        shards[row.shard] = (end - before, mine)
        for sk, offset in zip(row.nodes, row.offsets, strict=True):
            starts.setdefault(sk, end - before + offset)
        end, last = end - before + row.total, row.last
    return shards, starts


def _emit(shared, placed):
    """Segments, and for each conversation (turn_no null) the starts of its segments."""

    def run(batches):
        stack, out = Stack(shared.value), Rows(SEGMENTS)
        shards, places = placed.value
        open_: list[tuple[int, int, int, list]] = []  # start, size, position, ranges of the ancestors
        for shard, conv_id, path, sizes in walk(batches):
            fresh = shard != stack.shard
            if fresh:
                stack.begin(shard)
                open_ = []
            shift, mine = shards[shard]
            for k, at, size, sk in stack.opened(path, sizes):
                del open_[k:]
                start = places[sk] if sk >= 0 else shift + at
                position, ranges = 0, []
                if k:
                    above, length, before, ranges = open_[-1]
                    position = before + length
                    ranges = [*ranges[:-1], (ranges[-1][0], above + length)] if ranges and ranges[-1][1] == above else [*ranges, (above, above + length)]
                open_.append((start, size, position, ranges))
                if not fresh or k >= mine:
                    out.add(conv_id, k, start, size, position, [{"from": a, "to": b} for a, b in ranges], None)
            del open_[len(path) // WIDTH :]
            out.add(conv_id, None, None, None, None, None, [x[0] for x in open_])
            yield from out.batches()
        yield from out.batches(rest=True)

    return run


def format_chats(conversations: DataFrame, learn: tuple[str, ...] = ("assistant",)) -> Output:
    """The stream of segments of all conversations, and where each conversation finds its own."""
    spark = conversations.sparkSession
    role, text = role_text(conversations)
    turns = conversations.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(LOWEST)).alias("conv_id"), role.alias("role"), text.alias("text"), turn_digest(role, text).alias("digest"), turn_order(role, text).alias("at"))
    in_order = Window.partitionBy("conv_id").orderBy("at")
    shown = formatted(F.col("role"), F.col("text"))
    turns = turns.withColumn("turn_no", F.row_number().over(in_order).cast("long") - 1)
    turns = written(turns.select("conv_id", "turn_no", "role", "digest", shown.alias("text"), F.length(header(F.col("role"))).cast("long").alias("head"), F.length(shown).cast("long").alias("size")), "turns")

    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn_no", "digest", "size"))).alias("turns"))
    paths = written(rows.select("conv_id", path_of("turns").alias("path"), F.transform("turns", lambda t: t["size"]).alias("size")), "paths")
    shared = spark.sparkContext.broadcast(Skeleton.of(splitters(paths, shard_count(paths))))
    measured = sorted_shards(paths, shared).mapInArrow(released(_measure(shared)), from_arrow_schema(PLACES)).collect()  # a few numbers a shard
    placed = spark.sparkContext.broadcast(place(measured))
    found = written(sorted_shards(paths, shared).mapInArrow(released(_emit(shared, placed)), from_arrow_schema(SEGMENTS)), "segments")

    own_id = F.nullif("conv_id", F.lit(LOWEST)).alias("conv_id")
    learned = F.col("role").isin(*learn)
    learned_part = (F.when(learned, F.col("head")).alias("loss_from"), F.when(learned, F.col("size") - len(END)).alias("loss_to"))
    segments = found.where("turn_no IS NOT NULL").drop("starts", "size").join(turns, ["conv_id", "turn_no"])
    segments = segments.select("start", "size", "position", "attention", *learned_part, own_id, "turn_no", "role", "text")
    return Output(written(segments, "stream"), found.where("turn_no IS NULL").select(own_id, "starts"))


def read_back(out: Output) -> DataFrame:
    """conv_id, `stream` (its formatted text) and `learned` (its text under the loss mask, unescaped), from the segments alone."""
    part = F.substr("text", F.col("loss_from").cast("int") + 1, (F.col("loss_to") - F.col("loss_from")).cast("int"))
    segments = out.segments.select("start", "text", F.coalesce(unescaped(part), F.lit("")).alias("learned"))
    wanted = out.conversations.select(F.coalesce("conv_id", F.lit(LOWEST)).alias("conv_id"), F.posexplode("starts").alias("k", "start"))
    joined = wanted.join(segments, "start").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("k", "text", "learned"))).alias("s"))
    whole = lambda c: F.array_join(F.transform("s", lambda x: x[c]), "")
    return joined.select(F.nullif("conv_id", F.lit(LOWEST)).alias("conv_id"), whole("text").alias("stream"), whole("learned").alias("learned"))
