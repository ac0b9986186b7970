"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import pytest

import corpus_pipeline
from textmill.llm import chat, decontaminate, language, orc_ids, packing, personal, quality, repeats, sharding, simhash
from textmill.llm.queries import tokenizer_file
from textmill.session import new_folder

BYTES, WORDS = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("word_bpe_49k.json")
PROSE = "The quick brown fox jumps over the lazy dog near river banks while seven wizards watch quietly from afar. "
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, key string, item string, print long"


@pytest.fixture(scope="module")
def odd(spark):
    said = [
        (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, PROSE), (5, PROSE), (None, PROSE + "x"), (None, None), (6, "é😀" * 3000),
        (7, "word " * 40_000), (8, "x" * 120_000), (9, PROSE * 30), (10, PROSE * 30),
    ]
    rows = [(i, t, "en" if t else None, None if i == 4 else "s", 0, 1, "k", "i", 7) for i, t in said]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, PROSE), (2, None), (3, "")], "item_id long, text string")


def operators(bench):
    return {
        "language": lambda d: language.identify(d, language.Settings(steps=20)),
        "personal": personal.personal_spans,
        "sharding": lambda d: sharding.shard_documents(d, groups_per_bucket=3),
        "decontaminate": lambda d: decontaminate.contamination(d, bench),
        "simhash": simhash.near_duplicates,
        "repeats": repeats.remove_repeats,
        "orc": lambda d: _orc(d),
        "quality": quality.quality_rules,
        "packing": lambda d: packing.pack(d, BYTES),
    }


def _orc(docs):
    folder = new_folder(docs.sparkSession, "orc-test")
    orc_ids.write_ids(docs, folder, WORDS, files=3)
    return orc_ids.document_positions(docs.sparkSession, folder)


@pytest.mark.parametrize("name", list(operators(None)))
def test_operator_takes_odd_rows_and_no_rows(name, odd, bench):
    run = operators(bench)[name]
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in run(odd).select("doc_id").collect())
    want = sorted((r.doc_id is None, r.doc_id or 0) for r in odd.select("doc_id").collect())
    assert (sorted(set(ids)) == sorted(set(want))) if name == "packing" else (ids == want)
    assert run(odd.limit(0)).collect() == []


def test_stages_take_odd_rows_and_no_rows(spark, odd, tmp_path):
    spark.createDataFrame([(1, PROSE)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (odd, odd.limit(0)):
        docs = rows
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            made = stage(spark, docs, str(tmp_path))
            if k < len(corpus_pipeline.STAGES) - 1:
                assert made.columns == odd.columns
            made.collect()
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, rows, str(tmp_path)).collect()


def test_chat_takes_odd_rows(spark):
    rows = [(1, 0, None, None, "x"), (1, 0, None, None, "x"), (None, None, "a\nb\\", "[\\INST]", "y"), (2, 1, "assistant", "", "z")]
    said = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.read_back(chat.chat_format(said)).collect()}
    assert set(got) == {1, None, 2, -7} and got[1].n_turns == 2 and got[2].loss_chars == 0
    assert [r.conv_id for r in chat.read_back(chat.chat_format(said.limit(0))).collect()] == [-7]
