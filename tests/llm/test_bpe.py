"""The BPE encoder on many different words, in blocks, and with a small memory of words."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from platewise.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


def vocabulary() -> str:
    with open(PATH, encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def tables():
    return bpe.Bpe(vocabulary())


def many_words(n: int, seed: int) -> list[str]:
    """Texts of made-up words, hardly any of them twice: syllables, runs of one letter, odd bytes, long pieces."""
    rng = np.random.default_rng(seed)
    parts = ["th", "he", "a", "ing", "er", "on", "q", "zz", "é", "漢", "x" * 9, "'s", "_", "12", "\n"]
    words = ["".join(rng.choice(parts, rng.integers(1, 9))) for _ in range(n)]
    words[::500] = ["".join(rng.choice(parts, 400)) for _ in words[::500]]
    return [" ".join(words[i:i + 20]) for i in range(0, n, 20)]


def ids_of(texts: list) -> list[list[int]]:
    library = Tokenizer.from_file(PATH)
    return [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_new_words_are_encoded_together(tables, monkeypatch):
    alone, one = [], bpe.Bpe.encode_word
    monkeypatch.setattr(bpe.Bpe, "encode_word", lambda self, word: alone.append(1) or one(self, word))
    texts = many_words(20_000, 5)
    assert tables.encode(pa.array(texts)).to_pylist() == ids_of(texts)
    assert len(alone) <= 2 * bpe.FEW


def test_forgotten_words_and_shared_slots(monkeypatch):
    for name, value in (("SLOTS", 64), ("POOL", 500), ("PAIRS", 32), ("BLOCK", 4_000), ("FEW", 2)):
        monkeypatch.setattr(bpe, name, value)
    texts = many_words(3_000, 6) + ["a<|endoftext|>b", None, "", "<|endoftext|><|endoftext|>"]
    small = bpe.Bpe(vocabulary())
    for _ in range(2):
        assert small.encode(pa.array(texts)).to_pylist() == ids_of(texts)


def test_a_long_batch_is_held_in_blocks(tables):
    texts = pa.array(many_words(20_000, 7) * 80)
    size, most, rows = texts.nbytes, 0, 0
    tables.encode(texts.slice(0, 1000))
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    for block in tables.round_trips(texts):
        most = max(most, pa.total_allocated_bytes() - before)
        assert block.field("text").equals(texts.slice(rows, len(block)))
        rows += len(block)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(texts) and size > 30 * bpe.BLOCK
    assert most < 16 * bpe.BLOCK and peak < 100 * bpe.BLOCK


def test_round_trip_in_spark_encodes_a_text_once(spark):
    texts = [*many_words(2_000, 8), None, "", "a<|endoftext|>b", "é 漢字 🙂"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = docs.select("doc_id", bpe.Tokenizer(spark, PATH).round_trip(F.col("text")).alias("coded")).orderBy("doc_id").collect()
    assert [r["coded"]["ids"] for r in rows] == ids_of(texts)
    assert [r["coded"]["text"] for r in rows] == [t or "" for t in texts]
    assert docs.limit(0).select(bpe.Tokenizer(spark, PATH).round_trip(F.col("text"))).count() == 0
    folder = "/root/testdata/sf0.001"
    stage = corpus_pipeline.bpe_tokens(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    for frame in (queries.QUERIES["op8_bpe"](spark, folder), stage):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        calls = [line for line in plan.split("\n") if "ArrowEvalPython" in line]
        assert len(calls) == 1 and calls[0].count("text#") == 1
