"""Registered queries of the operators, with the SQL they are compared with where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textmill.llm import (
    chat, decontaminate, language, orc_ids, packing, periodic, personal, quality, repeats, sharding, simhash, turns, warc,
)
from textmill.session import new_folder


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(documents(spark, folder))


def op2_personal(spark: SparkSession, folder: str) -> DataFrame:
    return personal.personal_spans(documents(spark, folder))


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, folder))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder))


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.read_back(chat.chat_format(spark.read.parquet(f"{folder}/conversations.parquet")))


def op7_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, folder)).drop("kept")


def op8_orc_ids(spark: SparkSession, folder: str) -> DataFrame:
    written = new_folder(spark, "orc-ids")
    orc_ids.write_ids(documents(spark, folder), written, tokenizer_file("word_bpe_49k.json"))
    return orc_ids.document_positions(spark, written)


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(documents(spark, folder))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder), tokenizer_file("byte_bpe_50k.json"))


def op11_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.read_back(spark.read.parquet(f"{folder}/pages.parquet"))


def op12_periodic(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.run_digests(periodic.repeated_runs(documents(spark, folder), prepare=periodic.repeat_tail))


def op13_turns(spark: SparkSession, folder: str) -> DataFrame:
    said = spark.read.parquet(f"{folder}/conversations.parquet")
    return turns.audits(said, turns.damage(said))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        op1_language, op2_personal, op3_sharding, op4_decontaminate, op5_simhash, op6_chat, op7_repeats, op8_orc_ids,
        op9_quality, op10_packing, op11_warc, op12_periodic, op13_turns,
    )
    return {f.__name__: f for f in registered}


def oracle_sql() -> dict[str, str]:
    return {"op6_chat": chat.SQL, "op11_warc": warc.SQL}
