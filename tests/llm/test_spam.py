import random

import numpy as np
import pytest

from sparkseg.llm.forest import Forest
from sparkseg.llm import spam as module
from sparkseg.llm.spam import FEATURES, Held, features, host_weight, seed_pages, signals, spam_pages, train, weak_labels

WORDS = "river stone window garden letter winter bridge candle market summer doctor engine forest island kitchen".split()


def prose(rng, n=8):
    return " ".join(f"The {rng.choice(WORDS)} near the {rng.choice(WORDS)} was {rng.choice(['old', 'quiet', 'empty', 'bright'])} when we {rng.choice(['came', 'left', 'met', 'slept'])} there." for _ in range(n))


def spam(rng, kind):
    key = [f"{rng.choice(['cheap', 'best', 'buy'])} {rng.choice(WORDS)}" for _ in range(3)]
    if kind == 0:
        return " ".join(rng.choice(key) for _ in range(80))
    if kind == 1:
        return "\n".join(f"* https://www.{rng.choice(WORDS)}.example/p/{rng.randrange(9999)}" for _ in range(25))
    if kind == 2:
        return " ".join(f"#{rng.choice(WORDS)}_{rng.choice(WORDS)}" for _ in range(40))
    if kind == 3:
        return ", ".join(f"{rng.choice(key)} new set {rng.randrange(999)}" for _ in range(40))
    return " ".join(f"Why {k}? Since {k} beats other {k}, {k} fans pick {k}. If you want {k}, compare {k}, then choose {k} and save on {k}." for k in [key[0]] * 5)


def corpus(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        bad = rng.random() < 0.15
        text = spam(rng, i % 5) if bad else prose(rng, rng.randrange(1, 30))
        if not bad and rng.random() < 0.3:
            text += "\n\n* https://www.one.example/1"
        rows.append((i, text, f"https://{rng.choice(['a', 'b', 'c'])}.example/{i}", "src", bad))
    return rows


def test_held_out_pages(spark):
    rows = corpus(1, 900)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, url string, source string, bad boolean")
    got = spam_pages(df, sample=300).join(df.select("doc_id", "bad"), "doc_id").collect()
    assert sum(r.spam == r.bad for r in got) / len(got) > 0.99
    assert all(0 <= r.score <= 1 and r.host in ("a.example", "b.example", "c.example") for r in got)


def test_edges(spark):
    rng = random.Random(2)
    rows = [(1, None, None, None), (2, "", None, "S"), (3, " \n", "x", None), (4, "short", "HTTP://A.example", None), (None, prose(rng), "//B.example/x", None), (6, spam(rng, 1) * 50, None, None), (6, spam(rng, 1), None, None), (7, "a" * 100_000, None, None), (8, "{}" * 5, None, None)]
    df = spark.createDataFrame([(*r, 1.0, "h") for r in rows], "doc_id bigint, text string, url string, source string, p double, host string")
    got = spam_pages(df).collect()
    assert len(got) == 9
    assert [r.spam for r in got if r.doc_id in (1, 2, 3, 4)] == [False] * 4 and [r.score for r in got if r.doc_id in (1, 2, 3)] == [0.0] * 3
    assert all(r.spam for r in got if r.doc_id == 6)
    assert {r.doc_id: r.host for r in got}[4] == "a.example" and {r.doc_id: r.host for r in got}[2] == "s" and {r.doc_id: r.host for r in got}[None] == "b.example"
    assert spam_pages(df.where("false")).count() == 0


def told(texts):
    return list(weak_labels(np.array([signals(t) for t in texts])))


@pytest.mark.parametrize("kind", range(5))
def test_features_and_signals_cover_the_whole_text(kind):
    rng = random.Random(kind)
    bad = spam(rng, kind)
    texts = [bad, prose(rng, 60), prose(rng, 60) + "\n" + bad, "", "a" * 50_000, "\ud800 x"]
    x = np.array([features(t) for t in texts])
    assert x.shape[1] == len(FEATURES) and np.isfinite(x).all() and np.isfinite([signals(t) for t in texts]).all()
    assert told(texts[:2]) == [1, 0] or kind in (1, 2) and told(texts[:2]) == [-1, 0]
    assert (x[2] != x[1]).any() and signals(texts[2]) != signals(texts[1])


def test_forest_learns_and_repeats():
    rng = np.random.default_rng(0)
    x = rng.random((600, 6))
    y = ((x[:, 1] > 0.5) ^ (x[:, 4] > 0.3)).astype(float)
    f, g = Forest(x[:400], y[:400]), Forest(x[:400], y[:400])
    p = f.predict(x[400:])
    assert ((p > 0.5) == (y[400:] > 0.5)).mean() > 0.9 and (p == g.predict(x[400:])).all()


def test_the_method_is_the_same_at_every_size_and_rate(spark):
    rng = random.Random(4)
    rows = [(i, spam(rng, i // 100 % 5) if i % 100 == 0 else prose(rng, 4), None, None) for i in range(500)]
    shape = "doc_id bigint, text string, url string, source string"
    for some in (rows, rows[:3], [r for r in rows if r[0] % 100], rows[:1]):
        df = spark.createDataFrame(some, shape)
        forest, _ = train(df)
        assert len(forest.trees) == module.TREES
        assert [r.doc_id for r in spam_pages(df).where("spam").orderBy("doc_id").collect()] == [r[0] for r in some if r[0] % 100 == 0]


def test_seed_pages_have_both_kinds_in_each_language():
    pages = seed_pages()
    assert pages == seed_pages() and len({t for t, _ in pages}) == len(pages)
    assert sum(k for _, k in pages) >= 60 and sum(1 - k for _, k in pages) >= 48


def test_short_lists_are_not_taught_as_prose():
    texts = ["#river #stone #window #garden", "https://www.river.example/p/1 https://www.stone.example/p/2", "The river near the stone was quiet.", "Okay then"]
    assert 0 not in told(texts)[:2] and 1 not in told(texts)[2:]


_MANY = ["".join(random.Random(k).choice("bdfgklmnrstv") + random.Random(k + 1000).choice("aeiou") for _ in range(1)) + "".join(random.Random(k * 7 + j).choice("bdfgklmnrstvaeiou") for j in range(5)) for k in range(500)]


def varied(rng, n):
    """Prose of ever other words."""
    return " ".join(" ".join(rng.choice(_MANY) for _ in range(rng.randrange(5, 12))).capitalize() + "." for _ in range(n))


def listed(rng, n=30):
    """Keywords with ever new words behind them: less alike than other lists."""
    few = rng.sample(WORDS, 8)
    return rng.choice([" / ", " • ", ", "]).join(f"{rng.choice(few)} {rng.choice(few)} {rng.choice(['in ', '-', ''])}{''.join(rng.choice('bdfgklmnrstv') + rng.choice('aeiou') for _ in range(3))} {rng.randrange(999)}" for _ in range(n))


def test_trees_decide_what_the_weak_labels_leave_open(spark):
    """Labels don't tell lists of little repetition, nor prose on lines that end in no mark; taken for prose, the lists would be missed."""
    rng = random.Random(6)
    make = [lambda: (listed(rng), True), lambda: (varied(rng, rng.randrange(3, 20)).rstrip("."), False), lambda: (spam(rng, rng.randrange(5)), True)]
    rows = []
    for i in range(900):
        text, bad = make[i % 20 // 2]() if i % 20 < 6 else (varied(rng, rng.randrange(2, 20)), False)
        rows.append((i, text, None, None, bad))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, url string, source string, bad boolean")
    got = {r.doc_id: r.spam for r in spam_pages(df).collect()}
    labels = told([r[1] for r in rows])
    by_label = [k == 1 for k in labels]
    unlike = [(got[r[0]] == r[4]) for r, k in zip(rows, by_label) if k != got[r[0]]]
    assert labels.count(-1) >= 40
    assert len(unlike) >= 20 and np.mean(unlike) > 0.95
    assert np.mean([got[r[0]] == r[4] for r in rows]) > 0.99 > np.mean([k == r[4] for r, k in zip(rows, by_label)])


def test_hosts_change_decisions_for_the_better(spark):
    """Doubtful pages, half prose and half list, are spam on the host that has nothing else."""
    rng = random.Random(8)
    rows = []
    for i in range(1500):
        farm = i % 3 == 0
        doubtful = i % 10 == 1
        text = varied(rng, 6) + "\n" + listed(rng, rng.randrange(6, 20)) if doubtful else spam(rng, i % 5) if farm else varied(rng, rng.randrange(2, 20))
        rows.append((i, text, f"https://{'farm' if farm else f'h{i % 7}'}.example/{i}", None, farm, doubtful))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, url string, source string, bad boolean, doubtful boolean")
    got = spam_pages(df).join(df.select("doc_id", "bad"), "doc_id").collect()
    changed = [r for r in got if (r.p >= module.SPAM) != r.spam]
    assert len(changed) >= 10 and all(r.spam == r.bad for r in changed)


def test_hosts_that_tell_nothing_have_no_weight():
    rng = np.random.default_rng(1)
    y = (rng.random(2000) < 0.1).astype(int)
    p = np.clip(y * 0.9 + 0.05 + rng.normal(0, 0.02, 2000), 0.01, 0.99)
    hosts = [f"h{k}" for k in rng.integers(0, 20, 2000)]
    rates = {h: (float(p[[x == h for x in hosts]].sum()), float(hosts.count(h))) for h in set(hosts)}
    assert host_weight(Held(p, y, hosts), rates, float(p.mean())) == 0
    farms = ["farm" if k else h for k, h in zip(y, hosts)]
    rates = {h: (float(p[[x == h for x in farms]].sum()), float(farms.count(h))) for h in set(farms)}
    assert host_weight(Held(p, y, farms), rates, float(p.mean())) > 0
    assert host_weight(Held(p[:0], y[:0], []), {}, 0.0) == 0
