"""Consensus of several judges: iteratively reweighted voting."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from sparkseg.functions.columns import let
from sparkseg.llm.spoken import heard, with_speech
from sparkseg.session import checkpointed

LABELS = ("ok", "edit", "reject")
#: Name of the judge that compares the transcripts.
TRANSCRIPTS = "transcripts"
#: Votes of average accuracy added to each judge's own.
SMOOTHING = 10.0
#: Rounds after which weights that still move are taken as they are, with a warning.
ROUNDS = 40
#: Rounds end when no weight moves by more.
STABLE = 1e-3
#: Judges up to whose number their weights are broadcast; more are joined by shuffle.
BROADCAST_JUDGES = 100_000
#: Share of the transcripts' common word pairs that a text may miss, and share of missed and added ones together, up to which it is worth editing.
REJECT_MISSED, REJECT_APART = 0.45, 0.5
#: A text loops if it has so many times as many word pairs as distinct ones, and so many times as many as the longest transcript.
LOOP_REPEATS, LOOP_LENGTH = 1.5, 1.3


def usable_label(label: Column) -> Column:
    """ok, edit or reject; null for anything else."""
    word = F.regexp_replace(F.lower(label), r"[^\p{L}]+", "")
    return F.when(word.isin("ok", "okay"), "ok").when(word.isin("edit", "edited"), "edit").when(word.isin("reject", "rejected"), "reject")


def latest_votes(labels: DataFrame) -> DataFrame:
    """Rows (seg_id, judge, label): the latest usable verdict of each annotator on a segment.

    Of verdicts at one time the greatest label counts; one without a time is older than any.
    Repeated rows count once. A null annotator is one judge; rows with a null seg_id and
    unusable labels are left out.
    """
    return (
        labels.select("seg_id", F.coalesce(F.col("annotator_id").cast("string"), F.lit("unknown")).alias("judge"), usable_label(F.col("label")).alias("label"), "labelled_at")
        .where("seg_id IS NOT NULL AND label IS NOT NULL")
        .groupBy("seg_id", "judge")
        .agg(F.max(F.struct(F.col("labelled_at").alias("t"), "label")).alias("last"))
        .select("seg_id", "judge", "last.label")
    )


def _pairs(text: Column) -> Column:
    """Pairs of neighbouring words (characters in Chinese and Japanese) in order, ends included."""
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}'’]+", " ")
    spaced = F.regexp_replace(plain, r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}ー])", " $1 ")
    ends = F.array(F.lit("^")), F.array(F.lit("$"))
    words = F.split(F.trim(spaced), " +")
    pairs = let(words, lambda w: F.zip_with(F.concat(ends[0], w), F.concat(w, ends[1]), lambda a, b: F.concat(a, F.lit(" "), b)))
    # no words: split gives one empty one
    return let(pairs, lambda p: F.when(p[0] == "^ ", F.array(F.lit("^ $"))).otherwise(p))


def transcript_votes(segments: DataFrame, text: str = "text", others: tuple[str, ...] = ("text_whisper", "text_parakeet", "text_canary"), silent: bool = False) -> DataFrame:
    """Rows (seg_id, judge, label): what the other transcripts say of ``text``.

    Compared are pairs of neighbouring spoken words. Nothing missed of what two transcripts
    share and nothing that no transcript has: ok. More missed or added than ``REJECT_MISSED`` and
    ``REJECT_APART`` allow, words said over and over, or no words where the others have some: reject.
    Else edit. Segments where fewer than two other
    transcripts have words get no vote, or with ``silent`` a null label; redelivered rows count once.
    """
    read = with_speech(segments.select("seg_id", *[F.col(c) for c in {text, *others}]), text)
    words = lambda c: _pairs(F.coalesce(heard(F.col(c)), F.lit("")))
    for c in others:
        read = read.withColumn(f"raw_{c}", F.col(c)).withColumn(c, words(c))
    named = F.col("lead_name").isNotNull()
    # a text that is one of the transcripts has its pairs
    same = [F.when(F.col("body") == F.col(f"raw_{c}"), F.col(c)) for c in others]
    read = read.withColumn("own", F.coalesce(*same, words("body")))
    read = read.withColumn("own_named", F.when(named, words("body_named")))
    pooled = F.flatten(F.array(*[F.when(F.size(c) > 1, F.col(c)).otherwise(F.array().cast("array<string>")) for c in others]))
    common = F.concat(*[F.array_intersect(a, b) for i, a in enumerate(others) for b in others[i + 1 :]])
    given = reduce(lambda a, b: a + b, [(F.size(c) > 1).cast("int") for c in others])
    longest = F.greatest(*[F.size(c) for c in others])
    read = read.select("seg_id", "own", "own_named", given.alias("given"), F.array_distinct(pooled).alias("any"), F.array_distinct(common).alias("shared"), longest.alias("longest"))
    for own in ("own", "own_named"):
        read = read.withColumn(f"total_{own}", F.size(own)).withColumn(own, F.array_distinct(own))
        read = read.withColumn(f"extra_{own}", F.size(F.array_except(own, "any"))).withColumn(f"missed_{own}", F.size(F.array_except("shared", own)))

    def verdict(own: str) -> Column:
        extra, missed, total = F.col(f"extra_{own}"), F.col(f"missed_{own}"), F.col(f"total_{own}")
        share = missed / F.greatest(F.size("shared"), F.lit(1))
        apart = (extra + missed) / (F.size(own) + F.size("shared"))
        loops = (total >= LOOP_REPEATS * F.size(own)) & (total >= LOOP_LENGTH * F.col("longest"))
        reject = loops | (share > REJECT_MISSED) | (apart > REJECT_APART) | (F.size(own) <= 1)
        return F.when((extra == 0) & (missed == 0) & ~loops, 0).when(reject, 2).otherwise(1)

    best = F.when(F.col("own_named").isNull(), verdict("own")).otherwise(F.least(verdict("own"), verdict("own_named")))
    # tested for null: what element_at makes of a null index isn't taken for nullable
    label = F.when(F.col("best").isNotNull(), F.element_at(F.array(*[F.lit(x) for x in LABELS]), F.col("best") + 1))
    # the verdict is tested behind the aggregation: a filter before it would be run ahead of the caller's join
    votes = read.select("seg_id", F.when(F.col("given") >= 2, best).alias("best")).groupBy("seg_id").agg(F.min("best").alias("best"))
    given_votes = votes if silent else votes.where("best IS NOT NULL")
    return given_votes.select("seg_id", F.lit(TRANSCRIPTS).alias("judge"), label.alias("label"))


def _chosen(totals: dict[str, Column]) -> Column:
    """The label of the greatest total; of equal ones edit, then ok, then reject; null without votes."""
    ranked = F.array(*[F.struct(totals[x].alias("t"), F.lit(r).alias("r"), F.lit(x).alias("label")) for x, r in (("edit", 2), ("ok", 1), ("reject", 0))])
    top = F.array_max(ranked)
    return F.when(top["t"] > 1e-9, top["label"])


def _weighed(votes: DataFrame, weights: DataFrame) -> DataFrame:
    """Votes with their weight and, for each label, the total of their segment.

    A segment has at most one vote per judge, so the votes of one are bounded by the judges,
    and totals are taken where its votes lie, without a shuffle in each round. A judge without
    a weight gets 1.
    """
    few = weights.count() <= BROADCAST_JUDGES
    seg = Window.partitionBy("seg_id")
    joined = votes.join(F.broadcast(weights) if few else weights, "judge", "left").withColumn("w", F.coalesce("w", F.lit(1.0)))
    return joined.withColumns({f"t_{x}": F.sum(F.when(F.col("label") == x, F.col("w")).otherwise(0.0)).over(seg) for x in LABELS})


def reliability(votes: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Rows (judge, votes, accuracy, w) when consensus and weights agree.

    ``votes`` has one row (seg_id, judge, label) per judge and segment. Each round takes the
    weighted consensus of the other judges on every segment and counts how often a judge meets
    it, smoothed by ``SMOOTHING`` votes of the average accuracy; the weight is the log odds of
    that accuracy against guessing, 0.05 at least. A judge who is alone on all segments keeps the
    average. Weights are one row per judge; each round's are written to the shared folder,
    so the lineage doesn't grow. Rounds end when no weight moves by ``STABLE``; if one still does
    after ``rounds``, a warning says so.
    """
    weights = checkpointed(votes.groupBy("judge").agg(F.count("*").alias("votes"), F.lit(0.5).alias("accuracy"), F.lit(1.0).alias("w"), F.lit(0.0).alias("moved")))
    moved = 0.0
    for _ in range(rounds):
        weighed = _weighed(votes, weights.select("judge", "w"))
        others = _chosen({x: F.col(f"t_{x}") - F.when(F.col("label") == x, F.col("w")).otherwise(0.0) for x in LABELS})
        met = weighed.select("judge", (others == F.col("label")).cast("double").alias("met"), "w")
        counts = met.groupBy("judge").agg(F.count("*").alias("votes"), F.count("met").alias("n"), F.coalesce(F.sum("met"), F.lit(0.0)).alias("hits"), F.max("w").alias("old"))
        total = counts.agg(((F.sum("hits") + 1) / (F.sum("n") + 2)).alias("mean"))
        accuracy = F.least(F.greatest((F.col("hits") + SMOOTHING * F.col("mean")) / (F.col("n") + SMOOTHING), F.lit(0.01)), F.lit(0.99))
        odds = F.log((len(LABELS) - 1) * F.col("accuracy") / (1 - F.col("accuracy")))
        rated = counts.crossJoin(F.broadcast(total)).withColumn("accuracy", accuracy).withColumn("w", F.greatest(odds, F.lit(0.05)))
        weights = checkpointed(rated.select("judge", "votes", "accuracy", "w", F.abs(F.col("w") - F.col("old")).alias("moved")))  # one row beside each
        moved = weights.agg(F.max("moved").alias("d")).first()["d"]
        if moved is None or moved < STABLE:
            break
    else:
        warnings.warn(f"weights not stable after {rounds} rounds: the last moved one by {moved:.4f}", stacklevel=2)
    return weights.drop("moved")


def consensus(votes: DataFrame, weights: DataFrame) -> DataFrame:
    """Rows (seg_id, label, agreement, votes): the label, the share of weight behind it, the judges.

    A segment that has only null labels has no label and no agreement, and 0 votes.
    """
    totals = {x: F.col(f"t_{x}") for x in LABELS}
    per = _weighed(votes, weights.select("judge", "w")).groupBy("seg_id").agg(*[F.first(f"t_{x}").alias(f"t_{x}") for x in LABELS], F.count("label").alias("votes"))
    behind = F.try_divide(F.greatest(*totals.values()), reduce(lambda a, b: a + b, totals.values()))
    return per.select("seg_id", _chosen(totals).alias("label"), behind.alias("agreement"), "votes")


def chance_corrected(votes: DataFrame) -> DataFrame:
    """One row (segments, votes, agreement, expected, alpha): Krippendorff's alpha for nominal labels.

    Segments with one vote have nothing to compare and are left out; missing ratings need no
    filling. Without any such segment the figures are null.
    """
    counts = votes.groupBy("seg_id").agg(*[F.sum((F.col("label") == x).cast("bigint")).alias(x) for x in LABELS], F.count("*").alias("m")).where("m > 1")
    alike = reduce(lambda a, b: a + b, [F.col(x) * (F.col(x) - 1) for x in LABELS]) / (F.col("m") - 1)
    sums = counts.agg(F.count("*").alias("segments"), F.sum("m").alias("votes"), F.sum(alike).alias("same"), *[F.sum(x).alias(x) for x in LABELS])
    by_chance = reduce(lambda a, b: a + b, [F.col(x) * (F.col(x) - 1) for x in LABELS]) / (F.col("votes") * (F.col("votes") - 1))
    rated = sums.withColumn("agreement", F.col("same") / F.col("votes")).withColumn("expected", by_chance)
    return rated.select("segments", "votes", "agreement", "expected", F.when(F.col("expected") < 1, (F.col("agreement") - F.col("expected")) / (1 - F.col("expected"))).alias("alpha"))


def judged(labels: DataFrame, segments: DataFrame | None = None, every: bool = False) -> DataFrame:
    """Votes of annotators and, given the segments, of their transcripts, kept for several passes.

    Transcripts vote on the segments that people judge; with ``every`` on all, and those that
    neither judge have one row of a null label. Votes are partitioned by segment and kept in
    memory and on disk; what an executor takes with it is computed again.
    """
    people = latest_votes(labels)
    votes = people
    if segments is not None:
        wanted = people.select("seg_id").distinct()
        asked = segments.where("seg_id IS NOT NULL") if every else segments.join(wanted, "seg_id", "left_semi")
        votes = people.unionByName(transcript_votes(asked, silent=every))
    return _kept(votes.repartition("seg_id").sortWithinPartitions("seg_id"))


def of_people(votes: DataFrame) -> DataFrame:
    """The votes on segments that people judge, kept for several passes, without a shuffle."""
    judges = F.max(F.col("judge") != TRANSCRIPTS).over(Window.partitionBy("seg_id"))
    return _kept(votes.withColumn("people", judges).where("people AND label IS NOT NULL").drop("people"))


def _kept(votes: DataFrame) -> DataFrame:
    return votes.persist(StorageLevel.MEMORY_AND_DISK)
