"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantledger.llm import (
    chat, contamination, fingerprints, jaccard, mixing, pages, personal, quality, repair, repeats, search, sharding, tokens,
)
from grantledger.llm.common import WORD, table, whole_text
from grantledger.session import settle


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.regexp_count(whole_text(), F.lit(WORD))
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, size)
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken")
    )


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination.digest(contamination.find_items(docs, table(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal.find(docs, personal.train(docs))
    kinds = F.transform("base", lambda span: span["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in personal.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2("base_written", 256).alias("base_sha256"),
        F.col("all_written").alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = whole_text()
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return sharding.interleave(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard.link(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return linked.select("doc_id", "n_shingles", "component_id")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "\\### Assistant: </turn> ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], turns.schema)
    read = chat.read_back(chat.format_chats(turns.unionByName(added)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = pages.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return extracted.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = fingerprints.with_edited(docs).select(
        "__k", "__k2", "__next", "__next2", "doc_id", "copies",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(F.array(
            F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("body")),
            F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("body")),
        )).alias("version"),
    ).select("*", "version.*")
    keys = ["__k", "__k2", "__next", "__next2", "doc_id", "copies", "n_chars", "edited_sha256", "is_edited"]
    marks = settle(fingerprints.simhash(both, *keys, text="body"), "fingerprints")

    own = marks.where("not is_edited").drop("is_edited")
    edited = marks.where("is_edited").select("__k", "__k2", F.col("fingerprint").alias("changed"))
    following = own.select(
        F.col("__k").alias("__next"), F.col("__k2").alias("__next2"), F.col("fingerprint").alias("following")
    )
    asked = own.where(F.col("doc_id") % 50 == 0)
    sizes = own.groupBy("fingerprint").agg(F.sum("copies").alias("size"))
    found = fingerprints.near(asked, own).join(sizes, "fingerprint").groupBy("query").agg(
        (F.sum("size") - 1).alias("near")  # without itself
    )
    rows = own.join(edited, ["__k", "__k2"]).join(following, ["__next", "__next2"])
    rows = rows.join(found, rows["fingerprint"] == found["query"], "left")
    mark = F.col("fingerprint")
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))  # repeated rows come back repeated
    return rows.withColumn("__copy", each).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.written(mark).alias("fingerprint"),
        fingerprints.written(F.col("changed")).alias("edited_fingerprint"),
        fingerprints.likeness(mark, F.col("changed")).alias("near_edited"),
        fingerprints.likeness(mark, F.col("following")).alias("near_next"),
        F.when(F.col("doc_id") % 50 == 0, F.col("near")).alias("n_near"),
    )


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repaired = repair.Repair(repair.damaged(turns))
    found = repaired.faults().withColumnRenamed("conv_id", "__c1")
    written = repaired.digests().withColumnRenamed("conv_id", "__c2")
    every = turns.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("__c1")), "left")
    joined = joined.join(written, F.col("conv_id").eqNullSafe(F.col("__c2")), "left")
    # a conversation that lost all its rows has no fault and nothing to repair
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id",
        F.when(F.col("audit").isNull(), F.lit(0)).otherwise(F.col("gaps")).cast("long").alias("gaps"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder, manifest = tokens.write(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return tokens.read(spark, folder, manifest, docs.schema["doc_id"].dataType)


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_repeats": op2_repeats,
    "op3_decontamination": op3_decontamination,
    "op4_personal_data": op4_personal_data,
    "op5_sharding": op5_sharding,
    "op6_quality": op6_quality,
    "op7_jaccard": op7_jaccard,
    "op8_chat": op8_chat,
    "op9_main_text": op9_main_text,
    "op10_fingerprints": op10_fingerprints,
    "op11_repair": op11_repair,
    "op12_search": op12_search,
    "op13_token_ids": op13_token_ids,
}
