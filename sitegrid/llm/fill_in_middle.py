"""Fill-in-the-middle texts with exact cuts, through a sparse index of the multibyte characters.

A text is cut into units (`[A-Za-z]+|[^A-Za-z]`) and two of the unit borders become the
ends of prefix and middle. Units are found on UTF-8 bytes: a byte begins one unless it
continues a character or follows another letter as a letter. The index of a block holds
an entry only for each character of two to four bytes: its byte position and the bytes
that characters up to it have in excess of one. A search in it turns a byte cut into code
points and back; between entries, that is in ASCII spans, both differ by a constant, so
texts are never decoded. Counts of units are kept per stretch of bytes, so the k-th unit
of a very long text is found without a list of all its units.

Null texts and texts without a character are plain and stay empty. Equal rows give equal
results, rows without an id are drawn as if the id were an empty text. Other columns of
the input are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from sitegrid.llm.text import Block, blocks, released, strings

#: bytes per counted stretch
STRETCH = 4096

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
#: bytes 10xxxxxx continue a character
CONTINUES = (np.arange(256) & 0xC0) == 0x80
EXCESS = np.select([np.arange(256) >= 0xF0, np.arange(256) >= 0xE0, np.arange(256) >= 0xC0], [3, 2, 1], 0)


@dataclass(frozen=True)
class Format:
    """Sentinels, how many of 100 texts are cut, how many of 100 of these put the suffix
    first, and whether cuts fall between tokens or, with `units="chars"`, between code points."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    rate: int = 90
    spm_rate: int = 20
    seed: int = 1
    units: str = "tokens"

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        if len(set(marks)) < 3 or any(len(m) < 2 or m[0] in m[1:] or not m.isascii() or not m.startswith(self.prefix[0]) for m in marks):
            raise ValueError("sentinels are three ASCII texts that share a first character found nowhere else in them")


class Exceptions:
    """The multibyte characters of a block: byte positions and running excess."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        self.excess = np.cumsum(EXCESS[data[self.at]])
        # code points before each entry, were the block one text
        self.points = self.at - self.excess + EXCESS[data[self.at]]

    def before(self, byte: np.ndarray) -> np.ndarray:
        """Code points before byte positions where characters begin."""
        k = np.searchsorted(self.at, byte, "left")
        return byte - np.append(0, self.excess)[k]

    def byte_of(self, point: np.ndarray) -> np.ndarray:
        """Byte positions of code points; the inverse of `before`."""
        k = np.searchsorted(self.points, point, "left")
        return point + np.append(0, self.excess)[k]


class Units:
    """Beginnings of units in a block, counted per stretch of bytes."""

    def __init__(self, block: Block):
        self.block = block
        counts = [np.count_nonzero(self._begins(a)) for a in range(0, len(block.data), STRETCH)]
        self.until = np.append(0, np.cumsum(counts)).astype(np.int64)

    def _begins(self, start: int) -> np.ndarray:
        data, stop = self.block.data, min(start + STRETCH, len(self.block.data))
        letter = LETTER[data[max(start - 1, 0) : stop]]
        if not start:
            letter = np.append(False, letter)
        begins = ~CONTINUES[data[start:stop]] & ~(letter[1:] & letter[:-1])
        edges = self.block.offsets
        inner = edges[np.searchsorted(edges, start) : np.searchsorted(edges, stop)]
        begins[inner - start] = True
        return begins

    def ranks(self, at: np.ndarray) -> np.ndarray:
        """Units that begin before each of these ascending byte positions."""
        stretch = at // STRETCH
        out = self.until[stretch]
        for k, here in zip(*_groups(stretch, np.arange(len(at))), strict=True):
            if k < len(self.until) - 1:
                out[here] += np.append(0, np.cumsum(self._begins(int(k) * STRETCH)))[at[here] - k * STRETCH]
        return out

    def select(self, rank: np.ndarray) -> np.ndarray:
        """Bytes where the units of these ranks begin; the end of the block past the last."""
        out = np.full(len(rank), len(self.block.data), np.int64)
        stretch = np.searchsorted(self.until, rank, "right") - 1
        order = np.argsort(stretch, kind="stable")
        for k, here in zip(*_groups(stretch[order], order), strict=True):
            if k < len(self.until) - 1:
                out[here] = k * STRETCH + np.flatnonzero(self._begins(int(k) * STRETCH))[rank[here] - self.until[k]]
        return out


def _groups(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    if not len(keys):
        return keys, []
    edges = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[edges], np.split(values, edges[1:])


def cut(block: Block, draws: tuple[np.ndarray, np.ndarray], units: str = "tokens") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text, the bytes where its prefix and middle end, and their lengths in code points.

    draws: two whole numbers a text, each taken modulo the number of borders."""
    index, starts, stops = Exceptions(block.data), block.offsets[:-1], block.offsets[1:]
    begin = index.before(starts)
    if units == "chars":
        n = index.before(stops) - begin
        at = [index.byte_of(begin + d % (n + 1)) for d in draws]
    else:
        found = Units(block)
        first = found.ranks(block.offsets)
        n = np.diff(first)
        # a cut past the last unit is the end of the text
        at = [np.where((c := d % (n + 1)) == n, stops, found.select(first[:-1] + c)) for d in draws]
    low, high = np.minimum(*at), np.maximum(*at)
    points = index.before(low), index.before(high)
    return n, low, high, points[0] - begin, points[1] - points[0]


def fill_in_middle(docs: DataFrame, form: Format = Format(), text: Column | str = "text", doc_id: Column | str = "doc_id") -> DataFrame:
    """One row per text: doc_id, n (units), form (plain, psm or spm), prefix_chars,
    middle_chars (null if plain), output.

    Which form a text takes and where it is cut follows from its id and the seed alone."""
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    digest = F.sha2(F.concat(F.lit(f"{form.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    narrow = docs.select(as_column(doc_id).cast("long").alias("doc_id"), F.coalesce(as_column(text), F.lit("")).alias("text"))
    draws = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    taken = [F.col("text").contains(m) for m in (form.prefix, form.suffix, form.middle)]
    plain = (F.length("text") == 0) | taken[0] | taken[1] | taken[2] | (F.col("h3") % 100 >= form.rate)
    chosen = F.when(plain, "plain").when(F.col("h4") % 100 < form.spm_rate, "spm").otherwise("psm")
    ready = narrow.select("*", *draws).select("doc_id", "text", "h1", "h2", chosen.alias("form"))
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])
    marks = [np.frombuffer(m.encode(), np.uint8) for m in (form.prefix, form.suffix, form.middle)]

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column("text")):
                rows = batch.slice(block.start, block.n)
                n, a, b, prefix, middle = cut(block, tuple(rows.column(h).to_numpy() for h in ("h1", "h2")), form.units)
                forms = rows.column("form").to_pylist()
                pieces, sizes = [], []
                for f, start, p, m, stop in zip(forms, block.offsets[:-1].tolist(), a.tolist(), b.tolist(), block.offsets[1:].tolist(), strict=True):
                    if f == "plain":
                        own = [block.data[start:stop]]
                    else:
                        head, tail = (marks[0], block.data[start:p]), (marks[1], block.data[m:stop])
                        own = [*(head + tail if f == "psm" else tail + head), marks[2], block.data[p:m]]
                    pieces += own
                    sizes.append(sum(map(len, own)))
                out = strings(np.concatenate(pieces), np.array(sizes, np.int64))
                hidden = np.array([f == "plain" for f in forms])
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(n), rows.column("form"), pa.array(prefix, mask=hidden), pa.array(middle, mask=hidden), out], schema=schema)

    return ready.mapInArrow(released(run), from_arrow_schema(schema))


def restored(output: Column, kind: Column, form: Format = Format()) -> Column:
    """The text again, from output and form alone. A text with a sentinel in it is plain, and
    two pieces cannot make one up at their border, so the first of each is the one put there."""
    first = F.when(kind == "psm", F.lit(form.prefix)).otherwise(F.lit(form.suffix))
    second = F.when(kind == "psm", F.lit(form.suffix)).otherwise(F.lit(form.prefix))
    body = F.substr(output, F.length(first) + 1)
    at = F.instr(body, second)
    one, rest = F.substr(body, F.lit(1), at - 1), F.substr(body, at + F.length(second))
    at = F.instr(rest, F.lit(form.middle))
    two, middle = F.substr(rest, F.lit(1), at - 1), F.substr(rest, at + len(form.middle))
    prefix, suffix = F.when(kind == "psm", one).otherwise(two), F.when(kind == "psm", two).otherwise(one)
    return F.when(kind == "plain", output).otherwise(F.concat(prefix, middle, suffix))
