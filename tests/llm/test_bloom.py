"""The bit field: no member is missed, and least hashes of windows fill its blocks evenly."""

import numpy as np
from pyspark.sql import types as T

from sitegrid.llm.bloom import BITS, BLOCKS, _places, bloom
from sitegrid.llm.text import mix, signed


def least(n, seed, window=100):
    hashes = mix(np.random.default_rng(seed).integers(0, 2**64, (n, window), np.uint64))
    return hashes.min(axis=1)


def test_members_are_found_and_few_others(spark):
    inside, outside = least(20_000, 1), least(20_000, 2)
    rows = [(int(h),) for h in signed(inside)]
    field = bloom(spark.createDataFrame(rows, T.StructType([T.StructField("h", T.LongType())])))
    assert field.may(inside).all()
    assert field.may(outside).mean() < 0.001
    empty = bloom(spark.createDataFrame([], T.StructType([T.StructField("h", T.LongType())])))
    assert not empty.may(outside).any()


def test_least_hashes_fill_all_blocks_alike():
    first, second = _places(least(51_200, 3))
    counts = np.bincount(first >> BITS, minlength=BLOCKS)
    assert counts.min() > 100 and counts.max() < 320
    assert ((first >> BITS) == (second >> BITS)).all()
    # the bits within a block are spread, too
    assert len(np.unique(first)) > 50_000 and len(np.unique(second)) > 50_000
