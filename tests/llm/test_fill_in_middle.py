"""Cuts, forms and round trips against plain string code."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from samples import clashing, docs, empty, frame, rows  # noqa: F401
from pyspark.sql import functions as F

from sitegrid.llm import fill_in_middle as fim
from sitegrid.llm.text import blocks

ODD = ["<", "P>", "a<P", "<P>", "x<S>y", "<M>", "é", "日本", "\U0001f600", "abc", "\n", "\x00", "É1a", "a" * 30, "ß" * 9]


def units_of(text, units="tokens"):
    return re.findall(r"(?s)[A-Za-z]+|[^A-Za-z]", text) if units == "tokens" else list(text)


def plain_code(doc_id, text, units="tokens"):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    u = units_of(text, units)
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, len(u), "plain", None, None, text)
    if h[3] % 100 < 20:
        return (doc_id, len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def made(df, form=fim.Format()):
    return sorted(map(tuple, fim.fill_in_middle(df, form).collect()), key=str)


@pytest.mark.parametrize("units", ["tokens", "chars"])
def test_equals_plain_code(docs, rows, units):  # noqa: F811
    assert made(docs, fim.Format(units=units)) == sorted((plain_code(i, t, units) for i, t in rows), key=str)


def test_odd_and_long_texts_and_round_trip(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(ODD) for _ in range(rng.randrange(12)))) for i in range(600)]  # noqa: F811
    rows += [(1000, "é" * 700_000), (1001, "word, " * 400_000), (1002, "a" * 1_500_000), (1003, "日" + "b" * 4095 + "é" * 4096)]
    got = fim.fill_in_middle(frame(spark, rows))
    back = got.select("doc_id", *(c for c in got.columns if c != "doc_id"), fim.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert sorted(tuple(r)[:-1] for r in back) == sorted(plain_code(i, t) for i, t in rows)
    assert {r.doc_id: r.back for r in back} == dict(rows)


def test_empty_table_and_clashing_columns(spark, empty):  # noqa: F811
    assert made(empty) == []
    taken = frame(spark, [(1, "some text here")]).select("*", *(F.lit("x").alias(c) for c in ("form", "h1", "h3", "n", "output")))
    assert made(taken) == [plain_code(1, "some text here")]


def test_bad_sentinels():
    for bad in (("<P>", "<P>", "<M>"), ("<P>", "[S]", "<M>"), ("<P<", "<S>", "<M>"), ("<", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fim.Format(*bad)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=6))
def test_index_is_exact(texts):
    (block,) = blocks(pa.array(texts))
    index, units, joined = fim.Exceptions(block.data), fim.Units(block), "".join(texts)
    places = np.cumsum([0] + [len(c.encode()) for c in joined])
    assert index.before(places).tolist() == list(range(len(joined) + 1))
    assert index.byte_of(np.arange(len(joined) + 1)).tolist() == places.tolist()
    want = [len(units_of(t)) for t in texts]
    assert np.diff(units.ranks(block.offsets)).tolist() == want
    begins = np.cumsum([0] + [len(u.encode()) for t in texts for u in units_of(t)])
    assert units.select(np.arange(len(begins))).tolist() == begins.tolist()
