"""A set of 64-bit hashes as a bit field of fixed size, built without gathering the hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from sitegrid.llm.text import released

U64 = np.uint64
#: 256 blocks of 2**18 bits: 8 MB, whatever the number of hashes
BLOCKS, BITS = 256, 18


def _places(h: np.ndarray) -> list[np.ndarray]:
    """Two bits of the block that the low byte names.

    Callers put in least hashes of a window too, whose high bits are near zero; low bits of
    a mixed hash are even in any case.
    """
    block, mask = (h & U64(BLOCKS - 1)).astype(np.int64) << BITS, U64((1 << BITS) - 1)
    return [block | ((h >> U64(shift)) & mask).astype(np.int64) for shift in (8, 26)]


class Bloom:
    """`may` is true for all members, and for few others while members are below some ten million."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def may(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for place in _places(h):
            out &= ((self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1).astype(bool)
        return out


def bloom(hashes: DataFrame, column: str = "h") -> Bloom:
    """One task fills each block, so 8 MB in all reach the driver."""
    schema = pa.schema([("block", pa.int64()), ("bits", pa.binary())])

    def run(batches):
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            for place in _places(batch.column(0).to_numpy().view(np.uint64)):
                for block in np.unique(place >> BITS).tolist():
                    inside = place[place >> BITS == block] & ((1 << BITS) - 1)
                    blocks.setdefault(block, np.zeros(1 << BITS, bool))[inside] = True
        for block, bits in blocks.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], schema=schema)

    dealt = hashes.select(F.col(column).alias("h")).repartition(F.col("h").bitwiseAND(BLOCKS - 1))
    bits = np.zeros(BLOCKS << (BITS - 3), np.uint8)
    for row in dealt.mapInArrow(released(run), from_arrow_schema(schema)).collect():
        part = np.frombuffer(row["bits"], np.uint8)
        bits[row["block"] * len(part) : (row["block"] + 1) * len(part)] = part
    return Bloom(bits)
