"""Small inputs with the awkward cases, and brute-force helpers."""

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = ["the", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "to", "it"]


def prose(rng, n, sep=" "):
    return sep.join("".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def texts():
    """(doc_id, text): nulls, empty and blank texts, copies, near copies, repeated rows, a long text, odd characters, no id."""
    rng = random.Random(7)
    long = prose(rng, 6000)
    shared = prose(rng, 60)
    base = prose(rng, 150)
    edited = base.split()
    edited[40] = "changed"
    rows = [
        (0, None),
        (1, ""),
        (2, " \n\t "),
        (3, "one two"),
        (4, long),
        (5, long + " tail"),
        (6, base),
        (7, base),
        (7, base),
        (8, " ".join(edited)),
        (9, base.upper().replace(" ", "\n")),
        (10, prose(rng, 40) + " " + shared + " " + prose(rng, 30)),
        (11, prose(rng, 20) + "\n" + shared + "\n" + shared + " " + prose(rng, 10)),
        (12, "der " * 300),
        (13, "a" * 900 + " don't 's 'LL été 日本語 \U0001f600\U0001f600 \x00\x1c end"),
        (14, "line one here\nline one here\n\n\nline one here\n"),
        (None, base),
        (None, "without an id " + shared),
        (2**60, shared + " far id"),
    ]
    for i in range(20, 60):
        rows.append((i, prose(rng, rng.randrange(5, 200))))
    return rows


#: names that operators use inside
CLASHES = ("row", "h", "g", "key", "n", "found", "blob", "path", "spans", "score", "kind", "fp", "root", "a", "b", "lang")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "src", len(t or "")) for i, t in rows], "doc_id long, text string, source string, n_chars long").repartition(3)


def clashing(df):
    return df.select("*", *(F.lit("x").alias(c) for c in CLASHES if c not in df.columns))


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


@pytest.fixture(scope="module")
def rows():
    return texts()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return clashing(frame(spark, rows))


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")
