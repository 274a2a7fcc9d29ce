import datetime
import random
import warnings

import pytest

from sparkseg.llm.consensus import TRANSCRIPTS, _weighed, chance_corrected, consensus, judged, latest_votes, of_people, reliability, transcript_votes
from sparkseg.llm.queries import p5_found, p5_items

T0 = datetime.datetime(2025, 1, 1)
LABEL = "seg_id bigint, annotator_id bigint, label string, labelled_at timestamp"
TEXTS = "seg_id bigint, text string, text_whisper string, text_parakeet string, text_canary string"


def test_latest_usable_verdict(spark):
    day = lambda n: T0 + datetime.timedelta(days=n)
    rows = [(1, 1, "ok", day(0)), (1, 1, "EDIT.", day(1)), (1, 1, "?", day(2)), (1, 2, " rejected", None), (1, None, "okay", day(0)), (2, 1, None, day(0)), (2, 2, "skip", day(0)), (None, 1, "ok", day(0)), (3, 1, "ok", day(0)), (3, 1, "reject", day(0)), (3, 1, "reject", day(0))]
    got = sorted((r.seg_id, r.judge, r.label) for r in latest_votes(spark.createDataFrame(rows, LABEL)).collect())
    assert got == [(1, "1", "edit"), (1, "2", "reject"), (1, "unknown", "ok"), (3, "1", "reject")]


def test_transcripts_judge(spark):
    t = "the producer cut the story of the lighthouse before the show"
    rows = [
        (1, f"[laughter] uh, {t}", t, t.upper(), t),
        (2, t.replace("story", "map"), t, t, t),
        (3, "the producer cut the the producer cut the the producer cut", t, t, t),
        (4, t, t, None, ""),
        (5, None, t, t, t),
        (6, t, t.replace("cut", "at"), t.replace("show", "end"), t.replace("story", "map")),
        (6, t, t, t, t),
    ]
    got = {r.seg_id: r.label for r in transcript_votes(spark.createDataFrame([(*r, 1) for r in rows], TEXTS + ", own int")).collect()}
    assert got == {1: "ok", 2: "edit", 3: "reject", 5: "reject", 6: "ok"}


def simulated(n=600, seed=0):
    rng = random.Random(seed)
    skill = {1: 0.95, 2: 0.9, 3: 0.9, 4: 0.4, 5: 0.35, 6: 0.35}
    rows, truth = [], {}
    for seg in range(n):
        truth[seg] = rng.choices(["ok", "edit", "reject"], [6, 3, 1])[0]
        for who in rng.sample(sorted(skill), 4):
            rows.append((seg, who, truth[seg] if rng.random() < skill[who] else rng.choice(["ok", "edit", "reject"]), T0))
    return rows, truth, skill


def test_reliable_annotators_weigh_more_and_beat_the_majority(spark):
    rows, truth, _ = simulated()
    votes = judged(spark.createDataFrame(rows, LABEL))
    weights = reliability(votes)
    w = {int(r.judge): r.accuracy for r in weights.collect()}
    assert min(w[1], w[2], w[3]) > max(w[4], w[5], w[6])
    got = consensus(votes, weights).collect()
    assert len(got) == len(truth) and all(0 < r.agreement <= 1 and r.votes == 4 for r in got)
    right = sum(r.label == truth[r.seg_id] for r in got) / len(got)
    most = {}
    for seg, _, label, _ in rows:
        most.setdefault(seg, []).append(label)
    majority = sum(max(("edit", "ok", "reject"), key=v.count) == truth[s] for s, v in most.items()) / len(truth)
    assert right > 0.9 and right > majority


def test_transcripts_are_one_more_judge(spark):
    t = "we met the producer of the show in the morning"
    seg = spark.createDataFrame([(1, t, t, t, t), (2, t.replace("met", "saw"), t, t, t), (99, t, t, t, t)], TEXTS)
    votes = judged(spark.createDataFrame([(1, 1, "ok", T0), (2, 1, "ok", T0)], LABEL), seg)
    assert sorted((r.seg_id, r.judge, r.label) for r in votes.collect()) == [(1, "1", "ok"), (1, TRANSCRIPTS, "ok"), (2, "1", "ok"), (2, TRANSCRIPTS, "edit")]


def test_alpha(spark):
    rows = [(1, 1, "ok", T0), (1, 2, "ok", T0), (2, 1, "edit", T0), (2, 2, "edit", T0), (3, 1, "ok", T0)]
    r = chance_corrected(latest_votes(spark.createDataFrame(rows, LABEL))).first()
    assert (r.segments, r.votes, r.alpha) == (2, 4, 1.0)
    # a worked case: nominal alpha by the coincidence matrix
    rows = [(i, a, x, T0) for i, pair in enumerate([("ok", "ok"), ("ok", "edit"), ("edit", "edit"), ("reject", "edit")]) for a, x in enumerate(pair)]
    r = chance_corrected(latest_votes(spark.createDataFrame(rows, LABEL))).first()
    n, same = 8, 4
    expected = (3 * 2 + 4 * 3 + 1 * 0) / (n * (n - 1))
    assert r.alpha == pytest.approx((same / n - expected) / (1 - expected))
    assert chance_corrected(latest_votes(spark.createDataFrame([], LABEL))).first().alpha is None


def test_lonely_and_empty(spark):
    votes = judged(spark.createDataFrame([(1, 1, "reject", T0)], LABEL))
    got = consensus(votes, reliability(votes)).collect()
    assert [(r.seg_id, r.label, r.votes) for r in got] == [(1, "reject", 1)]
    votes = judged(spark.createDataFrame([], LABEL))
    assert consensus(votes, reliability(votes)).count() == 0


def test_one_segment_with_most_votes(spark):
    rows = [(7, who, "ok" if who % 3 else "edit", T0) for who in range(3000)] + [(s, s, "ok", T0) for s in range(20)]
    votes = judged(spark.createDataFrame(rows, LABEL))
    got = {r.seg_id: r.label for r in consensus(votes, reliability(votes, 2)).collect()}
    assert got[7] == "ok" and len(got) == 20


def test_items_has_every_segment(spark, tmp_path):
    t = "we met the producer of the show in the morning"
    rows = [(1, t, t, t, t), (2, t.replace("met", "saw"), t, t, t), (3, t, t, t, t), (4, t.replace("met", "saw"), t, t, t), (5, t, t, None, None), (3, t, t, t, t), (None, t, t, t, t)]
    spark.createDataFrame(rows, TEXTS).write.parquet(str(tmp_path / "seg_result.parquet"))
    spark.createDataFrame([(1, 1, "ok", T0), (2, 1, "edit", T0), (9, 1, "reject", T0)], LABEL).write.parquet(str(tmp_path / "seg_label.parquet"))
    got = {r.seg_id: (r.label, r.agreement, r.votes) for r in p5_items(spark, str(tmp_path)).collect()}
    assert got == {1: ("ok", 1.0, 2), 2: ("edit", 1.0, 2), 3: ("ok", 1.0, 1), 4: ("edit", 1.0, 1), 5: (None, None, 0), 9: ("reject", 1.0, 1)}
    assert {r.seg_id: r.label for r in p5_found(spark, str(tmp_path)).collect()} == {1: "ok", 2: "edit", 9: "reject"}


def test_transcripts_alone_label_where_nobody_judges(spark):
    t = "we met the producer of the show in the morning"
    votes = judged(spark.createDataFrame([], LABEL), spark.createDataFrame([(1, t, t, t, t)], TEXTS), every=True)
    assert [(r.seg_id, r.label, r.votes) for r in consensus(votes, reliability(of_people(votes))).collect()] == [(1, "ok", 1)]


def test_rounds_go_on_until_weights_are_stable(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(seg, who, "ok" if rng.random() < 0.5 + 0.02 * who else rng.choice(["edit", "reject"]), T0) for seg in range(150) for who in rng.sample(range(12), 3)]
    votes = judged(spark.createDataFrame(rows, LABEL))
    rounds = []
    monkeypatch.setattr("sparkseg.llm.consensus._weighed", lambda v, w, f=_weighed: (rounds.append(1), f(v, w))[1])
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        last = {r.judge: r.w for r in reliability(votes).collect()}
    assert len(rounds) > 8
    again = {r.judge: r.w for r in reliability(votes, len(rounds)).collect()}
    assert last == again
    with pytest.warns(UserWarning, match="not stable after 2 rounds"):
        reliability(votes, 2)
