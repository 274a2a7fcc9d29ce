"""Speakers by their embeddings: centroids, nearest candidates, and labels linked across chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkseg.functions.vectors import cosine
from sparkseg.operators.ordered import fold_sorted

#: Embeddings of a speaker that make a centroid; least similarity of two that are linked.
FIRST, ALIKE = 3, 0.75


def centroids(df: DataFrame, key: list[str], order: list[str], vector: str = "embedding", first: int = FIRST) -> DataFrame:
    """Rows (key, centroid, used): the element-wise mean of the first vectors of each key by ``order``.

    Null vectors are passed over; a key without any has no row. ``order`` must tell rows apart.
    The first few are found within each task before the shuffle. Vectors of one key must have
    one length; positions that only some have count for those.
    """
    given = df.where(F.col(vector).isNotNull()).select(*key, *order, F.col(vector).cast("array<double>").alias("v")).withColumn("__p", F.spark_partition_id())
    near = Window.partitionBy(*key, "__p").orderBy(*order)
    few = given.withColumn("__r", F.row_number().over(near)).where(F.col("__r") <= first)
    picked = few.withColumn("__r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("__r") <= first)
    means = picked.select(*key, F.posexplode("v").alias("i", "x")).groupBy(*key, "i").agg(F.avg("x").alias("x"), F.count("*").alias("n"))
    return means.groupBy(*key).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("centroid"), F.max("n").alias("used"))


def nearest(vector: Column | str, candidates: Column | str) -> Column:
    """The label of the candidate, of an array of (label, vector), with the greatest cosine.

    Of equal ones the first; the first too if the vector is null or nothing exceeds -1. Null for no candidates.
    """
    c = F.col(candidates) if isinstance(candidates, str) else candidates
    rated = F.transform(c, lambda x, i: F.struct(cosine(vector, x["vector"]).alias("sim"), (-i).alias("place"), x["label"].alias("label")))
    return F.array_max(rated)["label"]


class Linker:
    """Global speakers of a recording: centroids with the number of links, in order of making."""

    def __init__(self, alike: float):
        self.alike = alike
        self.centroids: list[np.ndarray | None] = []
        self.links: list[int] = []

    def chunk(self, locals_: list[tuple[str, np.ndarray | None]]) -> Iterator[tuple[str, int, float | None]]:
        """The global number of each local speaker of the next chunk, and the similarity of a link.

        Speakers come in order of first appearance; each takes the most similar global speaker
        that no other of the chunk has, the oldest of equals, if it is alike enough, and moves its
        centroid; else a new one is made. One without a vector is new and never found again.
        """
        used: set[int] = set()
        for name, v in locals_:
            best, at = -1.0, -1
            if v is not None and np.linalg.norm(v) > 0:
                for k, c in enumerate(self.centroids):
                    if c is None or k in used or np.linalg.norm(c) == 0:
                        continue
                    sim = float(np.dot(v, c) / (np.linalg.norm(v) * np.linalg.norm(c)))
                    if sim > best:
                        best, at = sim, k
            if at >= 0 and best >= self.alike:
                n = self.links[at]
                self.centroids[at] = (self.centroids[at] * n + v) / (n + 1)
                self.links[at] = n + 1
            else:
                at, best = len(self.centroids), None
                self.centroids.append(v)
                self.links.append(1 if v is not None else 0)
            used.add(at)
            yield name, at, best


def link_speakers(df: DataFrame, alike: float = ALIKE) -> DataFrame:
    """Rows (rec_id, chunk, speaker, linked, similarity) of local speakers, one row each in ``df``.

    ``df`` has (rec_id, chunk, place, speaker, centroid): centroids are null where there is no
    embedding, ``place`` is the order of appearance. Linking follows the chunks of a recording one
    by one, so it streams; only the centroids of its global speakers are kept.
    """

    def fold(key: tuple, group: Iterator[tuple]) -> Iterator[tuple]:
        linker, now, waiting = Linker(alike), None, []

        def settle() -> Iterator[tuple]:
            for name, k, sim in linker.chunk(waiting):
                yield key[0], now, name, f"SPEAKER_{k:02d}", sim

        for _, chunk, _, speaker, v in group:
            if chunk != now and waiting:
                yield from settle()
                waiting = []
            now = chunk
            waiting.append((speaker, None if v is None else np.asarray(v, dtype=float)))
        yield from settle()

    rows = df.select("rec_id", F.col("chunk").cast("bigint").alias("chunk"), "place", "speaker", "centroid")
    return fold_sorted(rows, ["rec_id"], ["chunk", "place", "speaker"], fold, "rec_id string, chunk bigint, speaker string, linked string, similarity double")
