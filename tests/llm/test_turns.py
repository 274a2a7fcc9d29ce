import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkseg.llm.rosters import assign_labels, cheapest, nicknames, settled, sound_code
from sparkseg.llm.spoken import clean, has_words, speech, with_speech
from sparkseg.llm.turns import spoken_segments, turn_parts, turn_texts, turns

T0 = datetime.datetime(2025, 1, 1)
SCHEMA = "seg_id bigint, rec_id string, start double, end double, speaker string, text string, ingested_at timestamp"
ALIAS = "rec_id string, speaker string, alias string"

SPOKEN = [
    ("[00:01:05] We went. [laughter]", "We went."),
    ("00:03:19.583 | Nous avons <breath> passé heum", "Nous avons passé heum"),
    ("00:01:02,195 --> 00:01:06,478 差不多有11分钟呃…姐姐解释了", "差不多有11分钟 姐姐解释了"),
    ("(05:39) at 9:30 in the morning (door closes)", "at 9:30 in the morning"),
    ("uh, We um... met *coughs* hmm", "We met"),
    ("ein Brief um sicher zu gehen äh", "ein Brief um sicher zu gehen"),
    ("um mapa em Lisboa hum", "um mapa em Lisboa"),
    ("the cat um sat", "the cat sat"),
    ("사람이 으음 모인 어, 자리 (웃음)", "사람이 모인 자리"),
    ("えーと、去年の秋から", "去年の秋から"),
]


@pytest.mark.parametrize(("text", "want"), SPOKEN)
def test_spoken_words(spark, text, want):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(clean(speech(F.col("text")))).first()[0] == want


@pytest.mark.parametrize("text", [None, "", " \n", "uh, um", "Hmm.", "[laughter] (00:12)", "♪ music ♪", "00:02:00.750 |", "呃…", "えっと", "음... 어.", "((inaudible)) <noise>", "[ silence ]", "um", "उम्म,", "ऊँ अम्म..."])
def test_no_words(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(has_words(F.col("text"))).first()[0] is False


@pytest.mark.parametrize("text", ["Okay.", "yes", "네 맞아요.", "9", "对啊。", "umbrella", "हाँ सही।"])
def test_words(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(has_words(F.col("text"))).first()[0] is True


@pytest.mark.parametrize(
    ("text", "number", "name", "body"),
    [("SPEAKER_05> Hi", 5, None, "Hi"), ("[s1]: Hi", 1, None, "Hi"), ("(S0) Hi", 0, None, "Hi"), ("<speaker_12> Hi", 12, None, "Hi"), ("SPK3: Hi", 3, None, "Hi"), (">> Speaker 10: Hi", 10, None, "Hi"), ("[00:01:02] Speaker 2: Hi", 2, None, "Hi"), ("Ann Lee: Hi", None, "ann lee", "Hi"), (">> Ann: Hi", None, "ann", "Hi"), ("[Ann Lee] Hi", None, "ann lee", "Hi"), ("Ann Lee – Hi", None, "ann lee", "Hi"), ("So they went", None, None, "So they went"), ("S2 went", None, None, "S2 went")],
)
def test_labels_at_the_beginning(spark, text, number, name, body):
    r = with_speech(spark.createDataFrame([(text,)], "text string")).first()
    assert (r.lead_number, r.lead_name, r.body_named) == (number, name, body)


@pytest.mark.parametrize("seed", range(10))
def test_assignment_is_cheapest(seed):
    from itertools import permutations

    rng = np.random.default_rng(seed)
    n, m = int(rng.integers(1, 5)), int(rng.integers(1, 6))
    cost = rng.random((n, m))
    got = cheapest(cost)
    total = sum(cost[i, j] for i, j in enumerate(got) if j >= 0)
    small, large = min(n, m), max(n, m)
    c = cost if n <= m else cost.T
    assert np.isclose(total, min(sum(c[i, p[i]] for i in range(small)) for p in permutations(range(large), small)))
    assert len({j for j in got if j >= 0}) == small


def test_misspelled_names_go_to_the_nearest_speaker(spark):
    alias = spark.createDataFrame([("r", "SPEAKER_01", "Katrin Belmor"), ("r", "SPEAKER_02", "Kasrin Belmor"), ("q", "SPEAKER_03", "Katrin Belmor")], ALIAS)
    labels = spark.createDataFrame([("r", "katrin belmor"), ("r", "kasrin belmr"), ("r", "someone else"), ("q", "kasrin belmor"), (None, "x"), ("r", None), ("r", "")], "rec_id string, label string")
    assert {(r.rec_id, r.label): r.who for r in assign_labels(labels, alias).collect()} == {("r", "katrin belmor"): "SPEAKER_01", ("r", "kasrin belmr"): "SPEAKER_02", ("q", "kasrin belmor"): "SPEAKER_03"}
    assert assign_labels(labels.where("false"), alias).count() == 0 and assign_labels(labels, alias.where("false")).count() == 0


def test_a_second_spelling_goes_to_the_same_speaker(spark):
    alias = spark.createDataFrame([("r", "SPEAKER_01", "Katherine"), ("r", "SPEAKER_02", "Marcus"), ("q", "SPEAKER_01", "Katrin Belmor"), ("q", "SPEAKER_02", "Kasrin Belmor")], ALIAS)
    labels = spark.createDataFrame([("r", "katharine"), ("r", "katherine"), ("r", "katherin"), ("q", "katrin belmor"), ("q", "kasrin belmor"), ("q", "kawrin belmor")], "rec_id string, label string")
    got = {(r.rec_id, r.label): r.who for r in assign_labels(labels, alias).collect()}
    assert got == {("r", "katharine"): "SPEAKER_01", ("r", "katherine"): "SPEAKER_01", ("r", "katherin"): "SPEAKER_01", ("q", "katrin belmor"): "SPEAKER_01", ("q", "kasrin belmor"): "SPEAKER_02"}


def assigned(spark, labels, alias):
    got = assign_labels(spark.createDataFrame(labels, "rec_id string, label string"), spark.createDataFrame(alias, ALIAS)).collect()
    assert len({(r.rec_id, r.label) for r in got}) == len(got)
    return {(r.rec_id, r.label): r.who for r in got}


@pytest.mark.parametrize("labels", [["john smith", "jon smith", "john smyth"], ["jon smith", "john smyth"], ["jhon smith", "john smit", "jon smyth", "johnn smith"]])
def test_no_spelling_of_a_name_is_lost(spark, labels):
    alias = [("r", "SPEAKER_01", "John Smith"), ("r", "SPEAKER_02", "Mary Jones")]
    assert assigned(spark, [("r", x) for x in labels], alias) == {("r", x): "SPEAKER_01" for x in labels}


@pytest.mark.parametrize(("name", "label"), [("Мария", "мариа"), ("Екатерина Волкова", "екатирина волкова"), ("김민준 교수님", "김민쥰 교수님"), ("さくらこばやし", "サクラこばやし"), ("محمد العربي", "محمد العربى"), ("Zoë Müller", "zoe müller"), ("Kathryn Fox", "cathryn fox"), ("अनिल कुमार", "अनील कुमार")])
def test_names_of_any_script(spark, name, label):
    other = ("r", "SPEAKER_02", "Quentin Zog")
    found = assigned(spark, [("r", label), ("r", "unlike anybody")], [("r", "SPEAKER_01", name), other])
    share = 1 - sum(a != b for a, b in zip(name.lower(), label)) / len(name)
    assert found == ({("r", label): "SPEAKER_01"} if share >= 0.8 else {})
    assert sound_code(name.lower().split()[0]) == sound_code(label.split()[0])


def test_short_forms_are_known_from_other_transcripts(spark):
    alias = [("q", "SPEAKER_00", "Katharine Belmor"), ("q", "SPEAKER_00", "Kit"), ("r", "SPEAKER_03", "Katharine Belmor"), ("r", "SPEAKER_01", "Tom Ash"), ("p", "SPEAKER_05", "Kit")]
    assert {tuple(r) for r in nicknames(spark.createDataFrame([(r, a.lower(), s) for r, s, a in alias], "rec_id string, alias_key string, alias_speaker string")).collect()} == {("katharine belmor", "kit")}
    labels = [("r", "kit"), ("r", "tom ash"), ("p", "katharine belmor"), ("o", "kit"), ("q", "kitt")]
    assert assigned(spark, labels, alias) == {("r", "kit"): "SPEAKER_03", ("r", "tom ash"): "SPEAKER_01", ("p", "katharine belmor"): "SPEAKER_05"}


def test_groups_of_spellings_are_assigned():
    pairs = [("jon smit", "john smith", "S1", 0.8), ("jon smit", "joan smith", "S2", 0.8), ("joan smit", "joan smith", "S2", 0.9), ("joan smit", "john smith", "S1", 0.7), ("joann smith", "joan smith", "S2", 0.91), ("jo smith", "john smith", "S1", 0.8), ("jo smith", "joan smith", "S2", 0.8)]
    got = dict(settled(pairs))
    assert got == {"jon smit": "S1", "joan smit": "S2", "joann smith": "S2"} or got == {"jo smith": "S1", "joan smit": "S2", "joann smith": "S2"}
    assert settled([("ab", "x", "S1", 0.9), ("ab", "y", "S2", 0.9)]) == []
    assert settled([("ab", "x", "S1", 0.9), ("ab", "y", "S2", 0.8)]) == [("ab", "S1")]
    assert settled([]) == []


def test_a_roster_of_many_names(spark):
    """Planted misspellings: each goes to its own speaker, whatever else is in the roster."""
    rng = random.Random(5)
    syllables = ["bel", "dor", "fin", "gar", "hal", "jor", "kas", "lum", "mir", "nov", "pel", "ros", "sten", "tav", "vor", "zan"]
    names = list({f"{''.join(rng.sample(syllables, 3))} {''.join(rng.sample(syllables, 3))}" for _ in range(60)})
    alias = [(f"r{k % 3}", f"SPEAKER_{k:02d}", n.title()) for k, n in enumerate(names)]
    labels, want = [], {}
    for k, n in enumerate(names):
        for _ in range(3):
            i = rng.randrange(2, len(n) - 1)
            wrong = n[:i] + rng.choice("aeiou") + n[i + rng.randrange(2) :]
            labels.append((f"r{k % 3}", wrong))
            want[f"r{k % 3}", wrong] = f"SPEAKER_{k:02d}"
    got = assigned(spark, labels + labels, alias)
    assert sum(got.get(k) == w for k, w in want.items()) >= 0.98 * len(want)


@pytest.mark.parametrize("text", ["(audience applauds loudly while the host introduces the guest)", "[a very long description of what is heard in the studio before the show]", "*" + "laughs for a long time " * 4 + "*", "（" + "拍手" * 40 + "）"])
def test_annotations_of_any_length_are_no_words(spark, text):
    df = spark.createDataFrame([(text, text + " yes")], "text string, more string")
    assert list(df.select(has_words(F.col("text")), has_words(F.col("more"))).first()) == [False, True]


def brute(rows):
    seen, out = set(), []
    for rec in sorted({r[0] for r in rows}):
        last = None
        for _, s, e, seg, who in sorted(r for r in rows if r[0] == rec):
            if seg in seen:
                continue
            seen.add(seg)
            if last and last[1] == who:
                last[2], last[3] = min(last[2], s), max(last[3], e)
            else:
                last = [rec, who, s, e]
                out.append(last)
    return sorted(map(tuple, out))


@pytest.mark.parametrize("bucket", [500, 20_000, 10**9])
def test_turns_match_a_walk_through_the_rows(spark, bucket):
    rng = random.Random(bucket)
    rows = []
    for i in range(400):
        s = rng.randrange(0, 100_000)
        rows.append((rng.choice(["a", "b"]), s, s + rng.randrange(1, 5000), i, rng.choice(["S0", "S1"])))
    rows += rows[:40]
    df = spark.createDataFrame([(seg, rec, s, e, T0, who, "x") for rec, s, e, seg, who in rows], "seg_id bigint, rec_id string, s bigint, e bigint, ingested_at timestamp, who string, speech string")
    parts = turn_parts(df, bucket).groupBy("rec_id", "turn").agg(F.first("who").alias("who"), F.min("s").alias("s"), F.max("e").alias("e"))
    assert sorted((r.rec_id, r.who, r.s, r.e) for r in parts.collect()) == brute(rows)


def test_whole_operator(spark):
    alias = spark.createDataFrame([("r", "SPEAKER_01", "Ann Lee"), ("r", "SPEAKER_01", "Ann")], ALIAS)
    rows = [
        (1, "r", 0.0, 1.0, "SPEAKER_00", "uh, Hello", T0),
        (1, "r", 0.0, 1.0, "[s0]", "uh, Hello", T0 + datetime.timedelta(days=1)),
        (2, "r", 1.0, 2.0, None, "Speaker 0: there", T0),
        (3, "r", 2.0, 3.0, "?", "Ann Lee: [laughter] uh", T0),  # a label and sounds: no words
        (4, "r", 3.0, 4.0, "?", ">> Ann: yes", T0),
        (5, "r", 4.0, 5.0, " ANN lee ", "no", T0),
        (6, "r", 5.0, 5.0, "SPEAKER_02", "no time", T0),
        (7, "r", 6.0, 7.0, "UNKNOWN", "nobody", T0),
        (8, "r", None, 7.0, "SPEAKER_02", "x", T0),
        (9, "r", 7.0, 8.0, "SPEAKER_00", None, T0),
        (10, None, 7.0, 8.0, "SPEAKER_00", "x", T0),
        (None, "r", 8.0, 9.0, "SPEAKER_01", "x", T0),
    ]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA + ", s int, label string")
    seg = spoken_segments(df, alias)
    assert sorted((r.rec_id, r.speaker, r.start_ms, r.end_ms) for r in turns(seg).collect()) == [("r", "SPEAKER_00", 0, 2000), ("r", "SPEAKER_01", 3000, 9000)]
    assert [(r.speaker, r.text, r.segments) for r in turn_texts(seg).orderBy("start_ms").collect()] == [("SPEAKER_00", "Hello there", 2), ("SPEAKER_01", "yes no x", 3)]
    assert turns(spoken_segments(df.where("false"), alias)).count() == 0
    assert turns(spoken_segments(df, alias.where("false"))).count() >= 1
