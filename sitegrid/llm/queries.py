"""Registered queries of the numbered operators, and their oracles where SQL can say them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrid.llm import attention_quality, byte_bpe, chat_prefix_tree, conversation_trie, decontamination, fertility, fill_in_middle, hd_language, oracles, secret_ledger, simhash, substring_dedup, suffix_dedup, suffix_tree_lm
from sitegrid.llm.tables import fold, prepare, read

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found, members = decontamination.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    # one row per document and different test item; item_ids lists the items of equal words
    alike = members.groupBy("class_id").agg(F.array_join(F.array_sort(F.collect_list("item_id")), ",").alias("item_ids"))
    return found.join(alike, "class_id").select("doc_id", F.col("class_id").alias("item_id"), "item_ids", "score", "first_word", "last_word", "first_char", "last_char")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    kept = substring_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> attention_quality.Model:
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return attention_quality.train(docs, labels.where(fold(F.col("doc_id"), 5) != 0))


def op4_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    scored = attention_quality.score(docs, quality_model(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= attention_quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    kept = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return byte_bpe.token_digests(read(spark, sf_dir, "documents"), BYTE_VOCABULARY)


def op7_hd_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    names, vectors = hd_language.prototypes(docs.where(~held_out), "text", "lang")
    return hd_language.identify(docs, names, vectors).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secret_ledger.scan(read(spark, sf_dir, "documents"))
    kinds = [r.kind for r in secret_ledger.BASE_RULES]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS long) AS n_{k}") for k in kinds]
    digest = F.sha2(secret_ledger.joined(base).cast("binary"), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), secret_ledger.joined(F.col("spans")).alias("spans"))


def op9_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    held_out = fold(F.col("doc_id"), 10) == 0
    scored = suffix_tree_lm.score(read(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return fertility.judge(read(spark, sf_dir, "documents"), PIECE_VOCABULARY, BYTE_VOCABULARY)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    made = fill_in_middle.fill_in_middle(read(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(back).alias("restored_sha256"))


#: one more conversation, whose texts hold what looks like control strings
ODD_TEXT = r"\### Assistant: </turn> ok"


def op12_chat_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    odd = [F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(ODD_TEXT).alias("text")) for i, role in enumerate(("user", "assistant"))]
    chats = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    out = chat_prefix_tree.format_chats(chats.unionByName(spark.range(1).select(F.inline(F.array(*odd)))))
    back = chat_prefix_tree.read_back(out).withColumn("turns", chat_prefix_tree.read_turns(F.col("stream")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        digest(told).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        digest(F.col("learned")).alias("loss_sha256"),
        F.length("stream").cast("long").alias("formatted_chars"),
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversation c: the first h turns of conversation c - c % 20, then its own after its first h."""
    base = turns.where("conv_id % 20 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("initial"))
    named = turns.withColumn("base", F.expr("conv_id - conv_id % 20")).withColumn("h", fold(F.col("conv_id"), 4).cast("int"))
    none = F.slice("turns", 1, 0)
    own = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return named.join(base, "base", "left").select("conv_id", F.concat(F.slice(F.coalesce("initial", none), F.lit(1), F.col("h")), own).alias("turns"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    turns = conversation_trie.conversation_turns(read(spark, sf_dir, "conversations"))
    return conversation_trie.trie(conversation_trie.as_paths(rebuilt(turns)))


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_substring_dedup, op3_simhash, op4_attention_quality, op5_suffix_dedup, op6_byte_bpe, op7_hd_language, op8_secret_ledger, op9_suffix_tree_lm, op10_fertility, op11_fill_in_middle, op12_chat_prefix_tree, op13_conversation_trie)}
ORACLES = {
    "op2_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op8_secret_ledger": oracles.SECRET_LEDGER,
    "op11_fill_in_middle": oracles.FILL_IN_MIDDLE,
    "op12_chat_prefix_tree": oracles.CHAT_PREFIX_TREE,
    "op13_conversation_trie": oracles.CONVERSATION_TRIE,
}
