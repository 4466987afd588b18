"""Byte BPE, tokeniser fertility and language profiles."""

import base64
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from samples import WORDS, crc, frame
from samples import docs, empty, rows  # noqa: F401  fixtures
from pyspark.sql import functions as F

from sitegrid.llm import byte_bpe, fertility, hd_language
from sitegrid.llm.queries import BYTE_VOCABULARY, PIECE_VOCABULARY
from sitegrid.llm.text import blocks


def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE_VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_of_rows(docs, rows):
    theirs = reference()
    got = byte_bpe.tokenize(docs, BYTE_VOCABULARY).collect()
    want = Counter((i, tuple(theirs.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist()), bytes(r.decoded)) for r in got) == want
    for r in got:
        lengths = [len(theirs.decode_single_token_bytes(x)) for x in np.frombuffer(r.ids, "<u4").tolist()]
        assert np.frombuffer(r.offsets, "<u4").tolist() == [sum(lengths[:k]) for k in range(len(lengths))][: len(lengths)]


def test_encoding_of_random_texts_in_small_blocks():
    theirs, own, rng = reference(), byte_bpe.vocabulary_of(BYTE_VOCABULARY), random.Random(1)
    letters = list("''''strevlldmST abc  \n\t\r\xa0 　é日本12½Ⅷ!?.-_\U0001f600́\x00\x1c\x85​б")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(3000)]
    texts += ["x" * 500 + "'s" * 200 + " " * 300 + "!" * 200, "", "'", " ", "'s", " 's", "\n's"]
    for size in (1 << 20, 64):
        for block in blocks(pa.array(texts), size):
            ids, first, _ = byte_bpe.encode(block, own)
            for k in range(block.n):
                assert ids[first[k] : first[k + 1]].tolist() == theirs.encode_ordinary(texts[block.start + k])
            assert byte_bpe.decode(ids, own).tobytes() == block.data.tobytes()


def test_scan_is_associative():
    of_class, product, functions = byte_bpe.monoid()
    rng = np.random.default_rng(2)
    kinds = rng.integers(0, byte_bpe.CLASSES, 1000)
    state, states = byte_bpe.B, []
    for k in kinds:
        state = byte_bpe._step(state, int(k))
        states.append(state)
    for width in (3, 16, 5000):
        assert byte_bpe.scan(kinds, width).tolist() == states
    a, b, c = (rng.integers(0, len(functions), 500) for _ in range(3))
    assert (product[product[a, b], c] == product[a, product[b, c]]).all()


def base_counts(text):
    w = WORDS.findall(text or "")
    windows = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    hit = [False] * len(w)
    for k in range(len(w) - 2):
        if windows[tuple(w[k : k + 3])] > 1:
            hit[k : k + 3] = [True] * 3
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        dup += line in seen and bool(WORDS.search(line))
        seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, sum(hit)


def test_fertility_measures(docs, rows):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_VOCABULARY)
    theirs = reference()
    got = fertility.measures(docs.drop("lang"), PIECE_VOCABULARY, BYTE_VOCABULARY, group=F.lit(None)).collect()
    want = {}
    for i, t in rows:
        w = WORDS.findall(t or "")
        ids = [x for word in w for x in model.encode(word)]
        second = sum(len(theirs.encode_ordinary(" " + word)) for word in w)
        chars, n = sum(map(len, w)), max(len(ids), 1)
        entropy = -sum(c / n * math.log2(c / n) for c in Counter(ids).values()) / math.log2(max(n, 2))
        want[i] = (*base_counts(t), len(ids), chars / n, chars / max(second, 1), sum(map(model.is_byte, ids)) / n, entropy)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert r.lang == "und" and tuple(r)[2:8] == want[r.doc_id][:6]
            assert np.allclose(tuple(r)[8:], want[r.doc_id][6:])


def test_fertility_verdict(spark, empty):
    rng = random.Random(4)
    letters = "etaoinshrdlu"
    good = [(i, " ".join("".join(rng.choice(["the", "and", "house", "over", "water", "little"])) + rng.choice(["", "s", "ly"]) for _ in range(120))) for i in range(60)]
    odd = [(100, " ".join("".join(rng.choice("XQZJKWVB#") for _ in range(9)) for _ in range(300))), (101, " ".join(rng.choice(["ᚠᚢ", "ᚦᚨᚱ"]) + rng.choice(letters) for _ in range(300)))]
    short = [(102, "too short"), (103, None), (104, "again and " * 100)]
    got = {r.doc_id: r for r in fertility.judge(frame(spark, good + odd + short).withColumn("lang", F.lit("en")), PIECE_VOCABULARY, BYTE_VOCABULARY).collect()}
    assert all(got[i].kept for i, _ in good)
    assert not any(got[i].kept or got[i].base_failed for i, _ in odd)
    assert all(got[i].base_failed and not got[i].kept for i, _ in short)
    assert fertility.judge(empty, PIECE_VOCABULARY).count() == 0


def test_languages(spark, docs, rows, empty):
    rng = random.Random(6)
    kinds = {"aa": ["bana", "lomi", "tuna"], "bb": ["schtr", "knurz", "pfelk"], "cc": ["élève", "ça", "oùt"]}
    sample = [(i, " ".join(rng.choice(kinds[k]) + rng.choice(kinds[k]) for _ in range(30)), k) for i, k in enumerate(list(kinds) * 20)]
    fit = spark.createDataFrame([*sample, (900, "bana", None), (901, None, "aa")], "doc_id long, text string, lang string")
    names, vectors = hd_language.prototypes(fit.where((F.crc32(F.col("doc_id").cast("string")) % 3) != 1), "text", "lang")
    assert names == sorted(kinds)
    got = {r.doc_id: r for r in hd_language.identify(fit, names, vectors).collect()}
    assert all(got[i].lang_pred == k and 0.5 < got[i].score <= 1 for i, _, k in sample if crc(i) % 3 == 1)
    odd = hd_language.identify(docs, names, vectors).collect()
    assert len(odd) == len(rows) and all(0 <= r.score <= 1 for r in odd)
    assert {r.lang_pred for r in odd if r.doc_id in (0, 1, 2)} == {"und"}
    assert hd_language.identify(empty, names, vectors).count() == 0
    names, vectors = hd_language.prototypes(fit.where("false"), "text", "lang")
    assert {r.lang_pred for r in hd_language.identify(fit, names, vectors).collect()} == {"und"}


def test_bundle_is_the_sum_of_bound_letters():
    (block,) = blocks(pa.array(["Ab, c"]))
    vectors, n = hd_language.bundles(block, 64)
    letter = lambda c, k: np.roll(hd_language.letter_vectors(np.array([ord(c) if c else 0]), 64)[0], k)
    want = sum(letter(a, 2) * letter(b, 1) * letter(c, 0) for a, b, c in [("", "a", "b"), ("a", "b", ""), ("b", "", "c"), ("", "c", "")])
    assert n.tolist() == [4] and (vectors[0] == want).all()
