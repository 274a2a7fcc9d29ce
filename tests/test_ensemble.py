import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkseg.operators.ensemble import aligned, rover, slots, trusted, vote_by_first, vote_by_slots

WORDS = st.lists(st.sampled_from("a b c d e".split()), max_size=12).map(" ".join)


@pytest.mark.parametrize("vote", [vote_by_slots, vote_by_first])
def test_few_transcripts(vote):
    assert vote([]) == "" and vote([None, " ", ""]) == "" and vote([None, " a b "]) == "a b"


@given(st.lists(st.sampled_from("a b c d e f g h".split()), min_size=1, max_size=8, unique=True))
@settings(max_examples=50, deadline=None)
def test_equal_transcripts_stay(words):
    text = " ".join(words)
    assert vote_by_slots([text] * 3) == text and vote_by_first([text] * 3) == text


@given(st.lists(WORDS, max_size=4))
@settings(max_examples=100, deadline=None)
def test_only_words_that_were_said(texts):
    said = {w for t in texts for w in t.split()}
    assert set(vote_by_slots(texts).split()) <= said and set(vote_by_first(texts).split()) <= said


def test_majority_beats_a_wrong_word():
    assert vote_by_slots(["we met the cat today", "we met the hat today", "we met the cat today"]) == "we met the cat today"
    assert vote_by_first(["we met the hat today", "we met the cat today", "we met the cat today"]) == "we met the cat today"


def test_repeated_word_is_cut():
    assert vote_by_slots(["no no no no no", "no no no no no"]) == "no no"


def test_trust():
    words = ["a b c d".split(), "a b c e".split(), "x y z".split()]
    assert trusted(words) == {0, 1}
    assert trusted([["a"], ["b"], ["c"]]) == {0, 1}


def test_longest_leads_and_others_fall_into_place():
    assert slots([["a", "b"], ["a", "x", "b"]]) == [["a", "a"], ["x"], ["b", "b"]]
    assert slots([["a", "b", "c"], ["q", "c"]]) == [["a", "q"], ["b", "q"], ["c", "c"]]
    assert slots([["a"]]) == [["a"]] and slots([]) == []
    assert aligned(["a", "b"], ["a", "c", "d"]) == [("a", "a"), ("b", "c"), (None, "d")]


def test_long_texts_use_the_popular_word_rule():
    rng = random.Random(1)
    text = " ".join(rng.choice(["the", "a", "w%d" % i]) for i in range(300))
    assert vote_by_first([text, text, text]) == text


def test_column(spark):
    df = spark.createDataFrame([(["a b", "a b", None],), (None,)], "h array<string>")
    assert [r[0] for r in df.select(rover(F.col("h"))).collect()] == ["a b", ""]
    assert [r[0] for r in df.select(rover(F.col("h"), by_first=True)).collect()] == ["a b", ""]
