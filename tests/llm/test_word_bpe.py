"""Word BPE against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tripledger.llm import word_bpe
from tripledger.llm.queries import op11_word_bpe, vocabulary

PATH = vocabulary("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, ids string, row int, decoded int"


@pytest.fixture(scope="module")
def own():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return word_bpe.WordBpe(PATH)


def ids_of(codec, text):
    return np.frombuffer(codec.encode(text), np.int32).tolist()


def same(own, codec, text):
    want = own.encode(text, add_special_tokens=False).ids
    assert ids_of(codec, text) == want, text
    assert codec.decode(np.array(want, np.int32)) == own.decode(want, skip_special_tokens=False)


def test_every_character(own, codec):
    """Also those newer than Python's tables, unassigned ones and all white space."""
    for low in range(0, 0x110000, 64):
        letters = [chr(c) for c in range(low, low + 64) if not 0xD800 <= c < 0xE000]
        text = "".join(f"A{c}b {c}" for c in letters)
        if own.encode(text, add_special_tokens=False).ids != ids_of(codec, text):
            for c in letters:
                same(own, codec, f"A{c}b {c}")


def test_random_texts(own, codec):
    rng = random.Random(3)
    letters = "abcdefghiklmnoprstuvw''''stveml d  \n\t ΣσςİıÉé́ñ日本語русский12 34!?.,-<|>\x1c\x1f\x85　🙂͸"
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 50)))
        if rng.random() < 0.3:
            text += "<|endoftext|>" + text[::-1] + "<|startoftext|><|x"
        same(own, codec, text)


@pytest.mark.parametrize("letters", ["abcdefghij", "日本語русскийabc", "theofand", "!?*"])
def test_long_words_take_the_same_merges(own, codec, letters):
    rng = random.Random(7)
    for n in (word_bpe.SHORT - 1, word_bpe.SHORT, word_bpe.SHORT + 1, 700, 20_000):
        same(own, codec, "".join(rng.choice(letters) for _ in range(n)))
    ids = [rng.choice(codec.inner) for _ in range(400)]
    assert codec.merge_short(ids[:]) == codec.merge_long(ids[:])


def test_forgetting_changes_nothing(own, monkeypatch):
    monkeypatch.setattr(word_bpe, "REMEMBERED", 3)
    small = word_bpe.WordBpe(PATH)
    text = "some words, some more words: the same words again and the rest of the words"
    for _ in range(3):
        same(own, small, text)
        assert len(small.known_words) <= 3


def test_another_kind_of_file_is_an_error():
    with pytest.raises(ValueError, match="word BPE"):
        word_bpe.WordBpe(vocabulary("byte_bpe_50k.json"))


def test_rows(spark, own):
    texts = ["Hello, World", None, "", " \n", "x" * 5000, "same", "same", "a <|endoftext|> b"]
    rows = [(i if i != 3 else None, t, "s", i, 1) for i, t in enumerate(texts)]
    out = word_bpe.encode(spark.createDataFrame(rows, SCHEMA).repartition(3), PATH, decoded=True)
    got = {r["row"]["row"]: r for r in out.collect()}
    assert len(got) == len(rows)
    for i, t in enumerate(texts):
        want = own.encode(t or "", add_special_tokens=False).ids
        assert got[i]["ids"] == want and got[i]["decoded"] == own.decode(want, skip_special_tokens=False)
        assert got[i]["row"].asDict() == dict(zip(("doc_id", "text", "ids", "row", "decoded"), rows[i]))
    assert word_bpe.encode(spark.createDataFrame([], SCHEMA), PATH).count() == 0
    again = out.select("decoded", word_bpe.decoder(PATH)("ids").alias("d"))
    assert again.where("NOT (decoded <=> d)").count() == 0


def test_batches_end_between_texts(spark, own, monkeypatch):
    monkeypatch.setattr(word_bpe, "TOKENS", 5)
    rows = [(i, "one two three four" * (i % 3), "s", i, 1) for i in range(40)]
    out = word_bpe.encode(spark.createDataFrame(rows, SCHEMA), PATH, keep=["doc_id"])
    assert {r["row"]["doc_id"]: r["ids"] for r in out.collect()} == {
        r[0]: own.encode(r[1], add_special_tokens=False).ids for r in rows}


def test_query(spark, own):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op11_word_bpe(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        ids = own.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        decoded = own.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
