import os
import random

import pytest

from sparkseg.llm.tokenizer import FOLDER, VOCABULARY, Encoder, byte_letters, decode_corpus, encode_corpus, ranks, serialised, to_bytes, to_letters

pytestmark = pytest.mark.skipif(not os.path.exists(f"{FOLDER}/{VOCABULARY}"), reason="no vocabulary files")

ODD = [
    "<|endoftext|> hi", " \n \n x", "a  b   c ", "\t a　b\t　c", "a\x1cb \x1c c", "don't I'LL we've 'sx", "  \n", "\n\n\nx", "x \n", "é é ퟿ \U0001f600  ok", "a\r\n\r\nb", "\x00 a",
    "。a、b，c「d」", "₂ x²³ ١٢", "a\x85b \x85c", " lead", "x_y _z  _", "한국어 텍스트", "हिन्दी पाठ", "a" * 5000, "\n" * 999, " " * 999, "a\n b", "a \n b", "x。\ny", "🇰🇷👩‍🚀", "﻿​",
]


@pytest.fixture(scope="module")
def ours():
    return Encoder(serialised(ranks(f"{FOLDER}/{VOCABULARY}")))


@pytest.fixture(scope="module")
def theirs():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{FOLDER}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize("text", ODD)
def test_same_ids_and_round_trip(ours, theirs, text):
    ids = ours.encode(text)
    assert list(ids) == theirs.encode(text, add_special_tokens=False).ids
    assert ours.decode(ids) == text


@pytest.mark.parametrize("seed", range(5))
def test_random_texts(ours, theirs, seed):
    rng = random.Random(seed)
    alphabet = "aab'st 12\n\t  .,é한の。，！ 　_ड़ि🙂-"
    for _ in range(200):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
        assert list(ours.encode(text)) == theirs.encode(text, add_special_tokens=False).ids
        assert ours.decode(ours.encode(text)) == text


def test_tables_that_overflow_change_nothing(ours, monkeypatch):
    import sparkseg.llm.tokenizer as t

    text = " ".join(f"word{i}" for i in range(300))
    want = list(ours.encode(text))
    monkeypatch.setattr(t, "REMEMBERED", 7)
    small = Encoder(serialised(ranks(f"{FOLDER}/{VOCABULARY}")))
    assert list(small.encode(text)) == want == list(small.encode(text))


def test_letters():
    assert len(set(byte_letters())) == 256
    data = bytes(range(256))
    assert to_bytes(to_letters(data)) == data and " " not in to_letters(data)


def test_table(spark, ours):
    rows = [(1, "hello world"), (2, ""), (3, None), (None, "x"), (1, "hello world"), (2**62, "é")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, text string, ids int")
    got = encode_corpus(df)
    assert got.dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    assert sorted(((r.doc_id, r.ids) for r in got.collect()), key=repr) == sorted(((k, [int(i) for i in ours.encode(t)]) for k, t in rows), key=repr)
    assert encode_corpus(df.where("false")).count() == 0


def test_refused_files(tmp_path):
    (tmp_path / "v").write_text("YQ== 1\n")
    with pytest.raises(ValueError):
        ranks(str(tmp_path / "v"))


def test_decoding_is_the_inverse(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)] + [(100, None), (101, "")], "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in decode_corpus(encode_corpus(df)).collect()}
    assert got == {**dict(enumerate(ODD)), 100: "", 101: ""}
    odd = spark.createDataFrame([(1, [-1, 50256, 99999, None]), (2, None), (3, [156])], "doc_id bigint, ids array<int>")
    assert [r.text for r in decode_corpus(odd).orderBy("doc_id").collect()] == ["", "", "\ufffd"]
