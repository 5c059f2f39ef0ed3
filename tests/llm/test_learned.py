"""Language, quality and BPE against brute force, round trips and held-out rows."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from platewise.llm import bpe, langid, quality

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, " ", "\n\n a", "it's we'll 'S 's's I'm'd''re", "  two  spaces ", "été 漢字 🙂 ½ ²", "a<|endoftext|>b<|endof", "text|>",
       "x" * 30_000, "tab\tand\x0bnul\x00", "1234 56a7   end", "!!!'s ?'t", "The theory's theirs" * 500, "\r\n\r\n  x"]


@pytest.fixture(scope="module")
def tables():
    return bpe.Bpe(open(PATH, encoding="utf-8").read())


def test_ids_equal_the_library(tables):
    rng = np.random.default_rng(3)
    parts = ["a", "ing", "the", " ", "  ", "'", "'s", "\n", "é", "漢", ".", "7", "<|endoftext|>", "zq", " "]
    texts = ODD + ["".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(2000)]
    library = Tokenizer.from_file(PATH)
    got = tables.encode(pa.array(texts)).to_pylist()
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert tables.decode(pa.array(got, pa.list_(pa.int32()))).to_pylist() == [t or "" for t in texts]


def test_decoding_cut_characters_equals_the_library(tables):
    library = Tokenizer.from_file(PATH)
    ids = library.encode("漢字🙂", add_special_tokens=False).ids
    cut = [ids[1:], ids[:-1], [], ids]
    assert tables.decode(pa.array(cut, pa.list_(pa.int32()))).to_pylist() == [
        library.decode(x, skip_special_tokens=False) for x in cut]


def test_encoding_in_spark(spark):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(ODD)], "doc_id long, text string, ids_ string")
    tokenizer = bpe.Tokenizer(spark, PATH)
    rows = docs.withColumn("ids", tokenizer.encode(F.col("text"))).withColumn("back", tokenizer.decode(F.col("ids"))).collect()
    library = Tokenizer.from_file(PATH)
    assert all(r["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids and r["back"] == (r["text"] or "") for r in rows)
    assert docs.limit(0).withColumn("ids", tokenizer.encode(F.col("text"))).count() == 0


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_language_of_held_out_rows(spark, documents):
    model = langid.train(documents.where(langid.in_training(F.col("doc_id"))))
    rows = langid.identify(documents, model).where(~langid.in_training(F.col("doc_id"))).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.95
    assert np.mean([r["accepted"] for r in rows]) >= 0.98
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "1234 !!", "x"), (4, "a", "x"), (4, "a", "x"), (5, "漢字", None)],
                                "doc_id long, text string, score string")
    got = {r["doc_id"]: r for r in langid.identify(odd, model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and not got[1]["accepted"] and got[1]["score"] == 0
    assert got[4]["lang_pred"] in model.labels and got[5]["lang_pred"] in model.labels
    assert langid.identify(odd.limit(0), model).count() == 0


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "hello", None)], "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert langid.identify(docs, model).first()["lang_pred"] == "und"


def test_whole_texts_count(spark):
    model = langid.LanguageModel(["a", "b"], np.random.default_rng(0).normal(size=(langid.BUCKETS, 2)), np.zeros(2))
    raw = np.frombuffer(b"some text " * 300_000, np.uint8)
    buckets, _ = langid.subwords(raw, np.array([0, len(raw)]))
    assert np.allclose(model.logits(raw, np.array([0, len(raw)]))[0], model.table[buckets].mean(axis=0))


def test_trees_learn_and_flat_arrays_agree():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    trees = quality.fit_trees(x, y)
    assert np.mean((trees.score(x) > 0.5) == y) > 0.97

    def walk(row):
        total = trees.base
        for at in trees.roots:
            while trees.left[at] >= 0:
                at = trees.left[at] + (row[trees.feature[at]] > trees.cut[at])
            total += trees.value[at]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.score(x[:50]), [walk(r) for r in x[:50]])
    assert np.allclose(quality.fit_trees(x[:0], y[:0]).score(x[:2]), 0.5)
    assert (quality.fit_trees(x, np.ones(3000)).score(x) > 0.9).all()


def test_statistics_by_hand():
    text = "One two TWO.\nOne two TWO.\n\nétà 12"
    row = dict(zip(quality.STATISTICS, quality.statistics(pa.array(["other", text, None]))[1]))
    size = len(text.encode())
    words = text.split()
    assert row["log_words"] == pytest.approx(np.log1p(len(words))) and row["digit"] == pytest.approx(2 / size)
    assert row["distinct_words"] == pytest.approx(len(set(words)) / len(words)) and row["newline"] == pytest.approx(3 / size)
    assert row["repeated_lines"] == pytest.approx(1 / 3) and row["first_upper"] == 1
    assert quality.statistics(pa.array([None, ""], pa.string())).shape == (2, len(quality.STATISTICS))


def test_quality_of_held_out_rows(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    stats = quality.with_statistics(documents)
    rows = quality.score(stats, quality.train(stats, labels.where(fold != 0))).join(labels.where(fold == 0), "doc_id").collect()
    assert np.mean([(r["score"] >= 0.3) == (r["quality"] == 1) for r in rows]) >= 0.95
    empty = quality.with_statistics(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"))
    assert [r["score"] for r in quality.score(empty, quality.train(empty, labels.limit(0))).collect()] == [0.5, 0.5]


def test_language_sample_reaches_the_driver_packed(spark, monkeypatch):
    """Three bytes for each distinct subword of a sampled text, not eight; counts above 255 are kept."""
    seen, fit = [], langid.fit
    monkeypatch.setattr(langid, "fit", lambda labels, sample, *rest: seen.append(sample) or fit(labels, sample, *rest))
    texts = [f"word{i} and another{i * 7} of many{i * 31}" for i in range(200)] + ["ab" * 2000]
    docs = spark.createDataFrame([(i, t, "ab"[i % 2]) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    assert langid.train(docs).labels == ["a", "b"]
    pairs = 0
    for text in texts:
        raw = np.frombuffer(text.encode(), np.uint8)
        pairs += len(set(langid.subwords(raw, np.array([0, len(raw)]))[0].tolist()))
    assert seen[0].nbytes < 4 * pairs + 40 * len(texts)
    for counts in ([], [1, 255], [1, 256, 70_000]):
        buckets = np.arange(len(counts), dtype=np.uint16) + np.uint16(langid.BUCKETS - 5)
        got = langid.unpacked(langid.packed(buckets, np.array(counts, np.int64)))
        assert got[0].tolist() == buckets.tolist() and got[1].tolist() == counts
