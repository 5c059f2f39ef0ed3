"""Sentence pieces against the sentencepiece library."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from platewise.llm import pieces
from platewise.llm.queries import op12_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "ing", "the", " ", "  ", "▁", "'s", "\n", "é", "漢", "🙂", ".", "7", "<s>", "</s>", "<0x41>", "<unk>", "zq", " " * 7, "aaa", "\x00", "ê", "ou"]
ODD = ["", None, " ", "\n\n a", "x" * 30_000, " " * 40, "▁" * 35 + "a", "ab" * 5000, "\t\r\n", "a" * 129, "word " * 20_000, "﻿bom", "ê" * 500, "漢字" * 400 + "x" * 90, "z" * 100 + "é" * 70 + "🙂" * 80, "ab" * 60]


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as file:
        return pieces.PieceModel(file.read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    return ODD + ["".join(rng.choice(PARTS, rng.integers(0, 40))) for _ in range(2000)]


def test_ids_and_texts_equal_the_library(model, library, texts):
    got = model.encode(pa.array(texts)).to_pylist()
    want = [library.encode(t or "", add_eos=True) for t in texts]
    assert got == want
    assert model.decode(pa.array(got, pa.list_(pa.int32()))).to_pylist() == [library.decode(ids) for ids in want]


def test_decoding_any_ids_equals_the_library(model, library):
    rng = np.random.default_rng(4)
    lists = [rng.integers(0, 32_000 if k % 2 else 300, rng.integers(0, 12)).tolist() for k in range(3000)]
    assert model.decode(pa.array(lists, pa.list_(pa.int32()))).to_pylist() == [library.decode(ids) for ids in lists]
    with pytest.raises(ValueError):
        model.decode(pa.array([[32_000]]))


def test_last_tokens_are_those_of_each_prefix(model):
    rng = np.random.default_rng(5)
    segments = ["▁" + "".join(rng.choice([p for p in PARTS if len(p) < 4], rng.integers(1, 8))) for _ in range(200)]
    segments.sort(key=len, reverse=True)
    table = np.full((200, len(segments[0])), -1)
    for row, text in zip(table, segments):
        row[:len(text)] = list(map(ord, text))
    for text, last in zip(segments, model.last_tokens(table).tolist()):
        assert [model.name(t) for t in last[:len(text)]] == [model.merged(text[:i])[-1] for i in range(1, len(text) + 1)]


def test_equal_hashes_of_other_segments_do_no_harm(model, library, texts, monkeypatch):
    monkeypatch.setattr(pieces, "hash_slices", lambda raw, starts, ends: (ends - starts) % 3)
    assert model.encode(pa.array(texts[:200])).to_pylist() == [library.encode(t or "", add_eos=True) for t in texts[:200]]


def test_tables_of_many_keys():
    rng = np.random.default_rng(7)
    keys = np.unique(rng.integers(0, 1 << 50, 50_000))
    table = pieces.Table(keys[:100], keys[:100] % 97)
    for part in np.array_split(keys[100:], 30):
        table.put(part, part % 97)
    assert (table.get(keys) == keys % 97).all() and (table.get(keys + (1 << 51)) == -1).all() and table.count == len(keys)


def test_pair_table_equals_the_merges(model):
    assert model.in_order
    rng = np.random.default_rng(6)
    tokens = [t for t in model.ids if model.merged(t) == [t]]
    runs = [t for t in tokens if set(t) == {"▁"}]
    pairs = [(tokens[a], tokens[b]) for a, b in rng.integers(0, len(tokens), (4000, 2))]
    words = [x for t in tokens[:1500] for i in range(1, len(t)) if model.merged(t[:i])[1:] == model.merged(t[i:])[1:] == []
             for x in [(t[:i], t[i:])] if all(y in model.ids for y in x)]
    for left, right in pairs + words + [(a, b) for a in runs for b in runs]:
        assert model._compatible(model.ids[left] << pieces.POINT | model.ids[right]) == (model.merged(left + right) == [left, right])


def test_full_tables_start_anew(model, texts, monkeypatch):
    want = model.encode(pa.array(texts[:300]))
    monkeypatch.setattr(pieces, "PAIRS", 5)
    monkeypatch.setattr(pieces, "STEPS", 5)
    assert model.encode(pa.array(texts[:300])).equals(want)


def test_models_of_other_kinds_are_refused():
    with pytest.raises(ValueError):
        pieces.PieceModel(b"")


def test_query_equals_the_library(spark, library, tmp_path):
    rows = [(i, t, "clash", 1) for i, t in enumerate(ODD)] + [(3, "again", "x", 2), (3, "again", "x", 2), (None, "no id", None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int").write.parquet(str(tmp_path / "documents.parquet"))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_eos=True)
        want.append((i, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids))))
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, op12_pieces(spark, str(tmp_path)).collect()), key=key) == sorted(want, key=key)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert empty.withColumn("ids", pieces.PieceTokenizer(spark, PATH).encode(F.col("text"))).count() == 0
