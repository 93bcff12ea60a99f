"""Word BPE against the public library, which is only used to compare with."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from caselake.llm import queries, word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def odd_texts():
    rng = random.Random(12)
    out = [
        "", " ", "end <|endoftext|> of it<|startoftext|>x", "<|ENDOFTEXT|> a<|endoftext|><|endoftext|>",
        "é café İstanbul ΣΑΣ ß ǅ é", " x y\u0085z", "don't WE'LL 12345 ٠١ ½", "-" * 5000,
        "日本語テキスト" * 40, "ab" * 3000, "a" * 4097, "́abc", "😀😀", "a\x00b\x1cc", "x" * 31 + " " + "y" * 33,
    ]
    out += ["".join(rng.choice("abcdeè 'sdl0é\t\nßŁĿ̀Ａ<|>") for _ in range(rng.randrange(200))) for _ in range(500)]
    out += ["".join(chr(rng.randrange(32, 0xD7FF)) for _ in range(rng.randrange(60))) for _ in range(500)]
    return out


def test_ids_and_decoding_are_those_of_the_library(library):
    run = word_bpe.Encoder(word_bpe._content(PATH))
    texts = odd_texts()
    for text, ids in zip(texts, run.encode(texts)):
        expected = ids_of(library, text)
        assert np.frombuffer(ids, word_bpe.ID).tolist() == expected, text[:80]
        assert run.decode(expected) == library.decode(expected, skip_special_tokens=False)


def test_a_full_store_is_emptied_and_gives_the_same_ids(library, monkeypatch):
    monkeypatch.setattr(word_bpe, "KEPT", 5)
    run = word_bpe.Encoder(word_bpe._content(PATH))
    for text in ["one two three four", "five six seven two one", "one one eight nine ten eleven"] * 2:
        assert np.frombuffer(run.encode([text])[0], word_bpe.ID).tolist() == ids_of(library, text)


def test_without_rising_ranks_one_place_is_merged_at_a_time(library):
    merges = word_bpe.Encoder(word_bpe._content(PATH)).merges
    assert merges.rising
    merges.rising = False
    for word in ["aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "thethethethethethethethethethethethethe"]:
        assert merges.one(word.encode()).tolist() == ids_of(library, word)


def test_query_over_the_whole_table(spark, library):
    found = {r["doc_id"]: r for r in queries.op12_word_bpe(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(found) == len(rows)
    for row in rows:
        ids = ids_of(library, row["text"] or "")
        got = found[row["doc_id"]]
        assert got["n_tokens"] == len(ids)
        assert got["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_nulls_repeats_clashing_names_and_an_empty_table(spark, library):
    rows = [(1, "Some words", 7), (None, None, 8), (1, "Some words", 7), (2, "", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int").withColumn("doc", F.lit("x"))
    docs = docs.withColumn("body", F.lit(1)).withColumn("decoded", F.lit(2)).withColumn("own", F.lit(3))
    coded = word_bpe.encode(docs, PATH)
    assert coded.columns == ["doc_id", "text", "doc", "body", "decoded", "own", "ids"]
    texts = word_bpe.decode(coded, PATH)
    assert sorted((r["text"] or "", r["ids"], r["decoded"]) for r in texts.collect()) == sorted(
        (t or "", ids_of(library, t or ""), library.decode(ids_of(library, t or ""))) for _, t, _ in rows)
    assert word_bpe.encode(docs.limit(0), PATH).count() == 0
    assert word_bpe.digests(docs.limit(0), PATH).count() == 0
    missing = spark.createDataFrame([(1, None), (2, [10**6, -1])], "doc_id int, ids array<int>")
    assert [r["decoded"] for r in word_bpe.decode(missing, PATH).collect()] == ["", ""]
