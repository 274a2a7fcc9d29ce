import os
import random
from collections import defaultdict

import numpy as np
import pytest

from sparkseg.llm.packing import BUCKETS, Projection, Shelf, fill, hilbert_keys, pack, runs_of, sized
from sparkseg.llm.tokenizer import FOLDER, VOCABULARY

vocabulary = pytest.mark.skipif(not os.path.exists(f"{FOLDER}/{VOCABULARY}"), reason="no vocabulary files")


@pytest.mark.parametrize("dimensions, bits", [(2, 3), (3, 3), (4, 2)])
def test_the_curve_visits_each_cell_once_by_unit_steps(dimensions, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), -1).reshape(-1, dimensions)
    keys = hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    along = cells[np.argsort(keys)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def test_like_documents_lie_close():
    rng = np.random.default_rng(0)
    topics = rng.random((8, BUCKETS)) ** 8
    docs = np.stack([rng.poisson(40 * topics[i % 8]) for i in range(400)])
    order = np.argsort(Projection(docs[:200]).keys(docs), kind="stable") % 8
    assert (order[1:] == order[:-1]).mean() > 0.8  # an eighth by chance


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_projection_of_a_tiny_sample(n):
    docs = np.tile(np.arange(BUCKETS) % 3, (n, 1))
    keys = Projection(docs).keys(np.concatenate([docs, np.zeros((1, BUCKETS)), np.ones((1, BUCKETS))]))
    assert len(keys) == n + 2 and (keys >= 0).all() and len(set(keys[:n])) <= 1


def test_shelf_fits_best_and_closes_what_lies_behind():
    shelf = Shelf(10, 4)
    assert [shelf.put(s, i) for i, s in enumerate((6, 7, 3, 4))] == [0, 1, 1, 0]
    assert [shelf.put(s, 4 + i) for i, s in enumerate((5, 6, 7, 8))] == [2, 3, 4, 5]
    shelf.close(9)
    assert shelf.put(1, 9) == 5 and shelf.put(5, 9) == 6


def test_runs_of_cells():
    assert runs_of([]) == []
    assert runs_of([(3, 4), (1, 4), (2, 3), (7, 31), (8, 1), (9, 9)], 10) == [(1, 0, 1), (2, 0, 1), (3, 1, 1), (7, 2, 4), (8, 6, 1), (9, 6, 1)]


@vocabulary
@pytest.mark.parametrize("capacity", [1, 7, 64])
def test_every_token_lies_in_one_place(spark, capacity):
    rng = random.Random(capacity)
    words = ["alpha", "beta", "gamma", "delta", "x"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 9, 30, 200])))) for i in range(150)] + [(900, ""), (901, None), (None, "x y"), (5, "twice"), (5, "twice")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, tokens int, container int")
    sizes = defaultdict(list)
    for r in sized(df).collect():
        sizes[r.doc_id].append(r.tokens)
    boxes, pieces = defaultdict(int), defaultdict(list)
    for r in pack(df, capacity).collect():
        assert r.tokens <= capacity and r.first == r.piece * capacity
        boxes[r.container] += r.tokens
        pieces[r.doc_id].append((r.first, r.tokens))
    assert max(boxes.values()) <= capacity
    assert {k: sum(n for _, n in v) for k, v in pieces.items()} == {k: sum(v) for k, v in sizes.items()}
    for k, v in pieces.items():
        if len(sizes[k]) == 1:
            assert len(v) == max(1, -(-sizes[k][0] // capacity))  # split only where it must be
    least = -(-sum(map(sum, sizes.values())) // capacity)
    assert len([b for b in boxes.values() if b]) <= 1.15 * least + 2


@vocabulary
def test_fill_and_empty(spark):
    df = spark.createDataFrame([(i, "same text here") for i in range(50)], "doc_id bigint, text string")
    got = fill(pack(df, 9), 9).collect()
    assert sum(r["items"] for r in got) == 50 and len(got) == 17 and sum(r.unused for r in got) == 17 * 9 - 150
    assert pack(df.where("false"), 9).count() == 0
    with pytest.raises(ValueError):
        pack(df, 0)


@vocabulary
def test_containers_hold_neighbours_whatever_the_cluster(spark):
    rng = random.Random(3)
    topics = [[f"{a}{rng.choice('aeiou')}{b}" for a in "bdfglmnprst" for b in "klmnrstz"[i : i + 3]] for i in range(6)]
    rows = [(i, " ".join(rng.choice(topics[i % 6]) for _ in range(rng.choice([4, 15, 40, 90])))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    packed = pack(df.repartition(7), 256, window=32, span=90)
    got = packed.collect()
    key = lambda r: (r.container, r.doc_id, r.piece, r.first, r.tokens)
    assert sorted(map(key, got)) == sorted(map(key, pack(df.coalesce(1), 256, window=32, span=90).collect()))
    place = {r.doc_id: k for k, r in enumerate(sized(df).orderBy("curve", "doc_id", "tokens").collect())}
    boxes, shuffled = defaultdict(list), defaultdict(list)
    others = [r.doc_id for r in got]
    rng.shuffle(others)
    for r, o in zip(got, others):
        boxes[r.container].append(r.doc_id)
        shuffled[r.container].append(o)
    span = lambda ids: max(place[i] for i in ids) - min(place[i] for i in ids)
    several = [k for k, v in boxes.items() if len(v) > 1]
    assert max(span(boxes[k]) for k in several) < 90
    assert np.median([span(boxes[k]) for k in several]) < 0.15 * np.median([span(shuffled[k]) for k in several])
    different = lambda of: np.mean([len({i % 6 for i in of[k]}) / len(of[k]) for k in several])
    assert different(boxes) < 0.7 * different(shuffled)
    full = fill(packed, 256).collect()
    assert sum(r.tokens for r in full) / (256 * len(full)) > 0.93


@vocabulary
def test_many_copies_spread_over_runs(spark, monkeypatch):
    monkeypatch.setattr("sparkseg.llm.packing.runs_of", lambda counts: runs_of(counts, 20))
    df = spark.createDataFrame([(i, "the same text" if i % 3 else f"text {i} of its own {i * i}") for i in range(300)], "doc_id bigint, text string")
    got = pack(df, 64).collect()
    assert sorted(r.doc_id for r in got) == list(range(300))
    assert len({r.container >> 40 for r in got if r.doc_id % 3}) >= 10
