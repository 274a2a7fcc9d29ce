"""Queries and SQL of the language-model problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkseg.llm.consensus import chance_corrected, consensus, judged, latest_votes, of_people, reliability
from sparkseg.llm.language import first_delivered, identify, mislabelled
from sparkseg.llm.packing import fill, pack
from sparkseg.llm.spam import spam_pages
from sparkseg.llm.splitting import split_segments
from sparkseg.llm.tokenizer import decode_corpus, encode_corpus
from sparkseg.llm.turns import spoken_segments, turn_texts, turns
from sparkseg.session import table

#: What both segment tables have and the problems on text need.
SEGMENT = ["seg_id", "rec_id", "`start`", "`end`", "speaker", "text", "language", "ingested_at"]


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "seg_result").select(*SEGMENT).unionByName(table(spark, folder, "res_seg").select(*SEGMENT))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """How each segment of more than 30 s can be cut, before any overlap is added."""
    pieces = split_segments(table(spark, folder, "seg_result"))
    return pieces.where("piece = 0").select("seg_id", "cut")


def p2_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of at most 30 s that overlap by half a second."""
    return split_segments(table(spark, folder, "seg_result"), overlap_ms=500)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Turns of each recording."""
    return turns(spoken_segments(_segments(spark, folder), table(spark, folder, "speaker_alias"), texts=False))


def p3_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Turns with their clean text."""
    return turn_texts(spoken_segments(_segments(spark, folder), table(spark, folder, "speaker_alias")))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Languages of segments whose label is missing or wrong, or that are mixed."""
    return mislabelled(identify(_segments(spark, folder), texts=False, keep=("ingested_at",)), "ingested_at")


def p4_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Language and confidence of each part of each segment, as first delivered."""
    return first_delivered(identify(_segments(spark, folder), keep=("ingested_at",))).drop("ingested_at")


def _votes(spark: SparkSession, folder: str, every: bool = False) -> DataFrame:
    segments = table(spark, folder, "seg_result").select("seg_id", "text", "text_whisper", "text_parakeet", "text_canary")
    return judged(table(spark, folder, "seg_label"), segments, every)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Consensus label of each segment with a usable verdict."""
    votes = _votes(spark, folder)
    return consensus(votes, reliability(votes)).select("seg_id", "label")


def p5_items(spark: SparkSession, folder: str) -> DataFrame:
    """Consensus label of each segment, how far its judges agree, and how many there are.

    Weights are those of the segments that people judge; a segment that nobody judges has no label.
    """
    votes = _votes(spark, folder, every=True)
    return consensus(votes, reliability(of_people(votes)))


def p5_annotators(spark: SparkSession, folder: str) -> DataFrame:
    """Reliability of each annotator, and of the comparison of transcripts."""
    return reliability(_votes(spark, folder)).select("judge", "votes", "accuracy", F.col("w").alias("weight"))


def p5_agreement(spark: SparkSession, folder: str) -> DataFrame:
    """Chance-corrected agreement of the annotators."""
    return chance_corrected(latest_votes(table(spark, folder, "seg_label")))


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of each document."""
    return encode_corpus(table(spark, folder, "documents"))


def p6_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's text after encoding and decoding."""
    return decode_corpus(encode_corpus(table(spark, folder, "documents")))


def p7_packed(spark: SparkSession, folder: str) -> DataFrame:
    """Which tokens of which document lie in which container of 2 048."""
    return pack(table(spark, folder, "documents"))


def p7_fill(spark: SparkSession, folder: str) -> DataFrame:
    """How full each container is."""
    return fill(p7_packed(spark, folder))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents most of whose text is repeated keywords, links or tags."""
    return spam_pages(table(spark, folder, "documents")).where("spam").select("doc_id")


def p8_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Score of each document beside the rate of its host."""
    return spam_pages(table(spark, folder, "documents"))


QUERIES = {"p2_found": p2_found, "p2_pieces": p2_pieces, "p3_found": p3_found, "p3_turns": p3_turns, "p4_found": p4_found, "p4_parts": p4_parts, "p5_found": p5_found, "p5_items": p5_items, "p5_annotators": p5_annotators, "p5_agreement": p5_agreement, "p6_ids": p6_ids, "p6_round_trip": p6_round_trip, "p7_packed": p7_packed, "p7_fill": p7_fill, "p8_found": p8_found, "p8_scores": p8_scores}

_CLOCK = r"\d{1,3}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?"
_TIME = rf"(?:[\[<(]\s*(?:{_CLOCK}|\d+\s*s)\s*[\]>)]|\d{{1,3}}:\d{{2}}:\d{{2}}[.,]\d{{1,3}}(?:\s*-->\s*\d{{1,3}}:\d{{2}}:\d{{2}}[.,]\d{{1,3}})?\s*\|?)"
_NUMBER = r"(?i)^(?:>>\s*)?[\[(<]?\s*(?:speaker|spkr|spk|s)[\s._#-]*(\d{1,6})\s*(?:[\])>]\s*:?|[:>–—|]|-\s)\s*"
_PART = r"\p{L}[\p{L}\p{M}''’.-]*"
_NAME = rf"^(?:>>\s*)?[\[<]?\s*({_PART}(?: {_PART}){{0,3}})\s*(?:[\]>]\s*:?|[:>–—：]|-\s)\s*"
_SOUND = r"\(\([^()]{0,40}\)\)|\[[^\[\]]{0,40}\]|\([^()]{0,40}\)|<[^<>]{0,40}>|\{[^{}]{0,40}\}|（[^（）]{0,40}）|【[^【】]{0,40}】|\*[^*\s][^*]{0,38}\*|♪[^♪]{0,40}♪|♪"
# hesitation sounds by how they are spelled, not by the operator's lists
_SOUNDS = "|".join([
    "u+(?:h+m*|m+)", "h+m+", "m{2,}h*m*", "mhm", "e+r+m*", "e+h+m*", "ahm", "e+u+h*", "heu+", "h[ue]m", "ahn", "hã", "[äö]h+m*", "éé", "em",
    "음+", "으음", "어", "에", "э+м*", "э-э", "м{2,}", "امم+", "آآ", "م+إ?م+م", "إم+", "उम्म", "अम्म", "हम्म", "म", "अं", "ऊँ",
    "え+ー?と", "えっと", "うーん", "あのー", "んー", "[嗯呃额唔啊]+",
])

SQL = {
    "p6_round_trip": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p3_found": f"""
WITH given AS (
  SELECT seg_id, rec_id, CAST(round("start" * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e, speaker, text, ingested_at FROM seg_result
  UNION ALL SELECT seg_id, rec_id, CAST(round("start" * 1000) AS BIGINT), CAST(round("end" * 1000) AS BIGINT), speaker, text, ingested_at FROM res_seg),
once AS (SELECT * FROM given WHERE e > s AND rec_id IS NOT NULL AND text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY seg_id ORDER BY ingested_at) = 1),
aliases AS (SELECT rec_id, trim(lower(alias)) AS k, min(speaker) AS who FROM speaker_alias GROUP BY ALL),
begun AS (SELECT *, regexp_replace(text, '^(?:\\s|{_TIME})+', '') AS at_, regexp_extract(trim(lower(speaker)), '^\\[?(?:speaker|spkr|spk|s)[ ._#-]*0*([0-9]+)\\]?$', 1) AS num, regexp_replace(trim(lower(speaker)), ' *\\([^()]*\\)$', '') AS k FROM once),
led AS (SELECT *, regexp_extract(at_, '{_NUMBER}', 1) AS lead_num, lower(regexp_extract(at_, '{_NAME}', 1)) AS lead_name FROM begun),
found AS (
  SELECT led.*, a.who AS named, b.who AS lead_named FROM led LEFT JOIN aliases a ON a.rec_id = led.rec_id AND a.k = led.k AND num = ''
  LEFT JOIN aliases b ON b.rec_id = led.rec_id AND b.k = lead_name AND lead_num = ''),
bodies AS (
  SELECT *, CASE WHEN lead_num <> '' THEN regexp_replace(at_, '{_NUMBER}', '') WHEN lead_named IS NOT NULL THEN regexp_replace(at_, '{_NAME}', '') ELSE at_ END AS body,
    CASE WHEN num <> '' THEN CAST(num AS BIGINT) WHEN named IS NOT NULL THEN CAST(named[9:] AS BIGINT) WHEN lead_num <> '' THEN CAST(lead_num AS BIGINT) ELSE CAST(lead_named[9:] AS BIGINT) END AS who FROM found),
spoken AS (
  SELECT * FROM bodies WHERE who IS NOT NULL AND len(list_filter(regexp_split_to_array(lower(regexp_replace(regexp_replace(body, '{_TIME}', ' ', 'g'), '{_SOUND}', ' ', 'g')), '[\\s.,…、，。!?？！|-]+'),
    lambda w: regexp_matches(w, '[\\p{{L}}\\p{{N}}]') AND NOT regexp_full_match(w, '{_SOUNDS}'))) > 0),
marked AS (SELECT *, CASE WHEN who = lag(who) OVER (PARTITION BY rec_id ORDER BY s, e, seg_id) THEN 0 ELSE 1 END AS fresh FROM spoken),
grouped AS (SELECT *, sum(fresh) OVER (PARTITION BY rec_id ORDER BY s, e, seg_id ROWS UNBOUNDED PRECEDING) AS g FROM marked)
SELECT rec_id, 'SPEAKER_' || CASE WHEN any_value(who) < 10 THEN '0' ELSE '' END || any_value(who) AS speaker, min(s) AS start_ms, max(e) AS end_ms FROM grouped GROUP BY rec_id, g
""",
    "p5_agreement": """
WITH usable AS (
  SELECT seg_id, annotator_id, labelled_at,
    CASE regexp_replace(lower(label), '[^a-z]', '', 'g') WHEN 'ok' THEN 'ok' WHEN 'okay' THEN 'ok' WHEN 'edit' THEN 'edit' WHEN 'edited' THEN 'edit' WHEN 'reject' THEN 'reject' WHEN 'rejected' THEN 'reject' END AS label
  FROM seg_label),
last AS (SELECT seg_id, annotator_id, arg_max(label, (labelled_at, label)) AS label FROM usable WHERE label IS NOT NULL GROUP BY ALL),
counts AS (SELECT seg_id, count(*) FILTER (label = 'ok') AS a, count(*) FILTER (label = 'edit') AS b, count(*) FILTER (label = 'reject') AS c, count(*) AS m FROM last GROUP BY seg_id HAVING m > 1),
sums AS (
  SELECT count(*) AS segments, CAST(sum(m) AS BIGINT) AS votes, sum((a * (a - 1) + b * (b - 1) + c * (c - 1)) / (m - 1)) AS same, sum(a)::DOUBLE AS a, sum(b)::DOUBLE AS b, sum(c)::DOUBLE AS c FROM counts),
rated AS (SELECT segments, votes, same / votes AS agreement, (a * (a - 1) + b * (b - 1) + c * (c - 1)) / (votes::DOUBLE * (votes - 1)) AS expected FROM sums)
SELECT segments, votes, agreement, expected, (agreement - expected) / (1 - expected) AS alpha FROM rated
""",
    "p2_found": """
WITH RECURSIVE segments AS (
  SELECT seg_id, CAST(round("start" * 1000) AS BIGINT) AS a, CAST(round("end" * 1000) AS BIGINT) AS b, any_value(words) AS words
  FROM seg_result GROUP BY ALL HAVING b - a > 30000),
long AS (
  SELECT *, CASE WHEN len(words) > 0 AND words[1]."start" * 1000 < a - 100 AND list_max(list_transform(words, lambda w: w."end")) * 1000 <= b - a + 100 THEN a ELSE 0 END AS shift
  FROM segments),
pause AS (
  SELECT seg_id, shift + CAST(round(words[i]."end" * 1000) AS BIGINT) AS p, shift + CAST(round(words[i + 1]."start" * 1000) AS BIGINT) AS q
  FROM long, unnest(range(1, len(words))) AS u(i)
  WHERE round(words[i + 1]."start" * 1000) - round(words[i]."end" * 1000) >= 300),
step AS (
  SELECT seg_id, b, a AS pos FROM long
  UNION ALL
  SELECT step.seg_id, any_value(step.b), max(least(q, pos + 30000))
  FROM step JOIN pause ON step.seg_id = pause.seg_id AND p <= pos + 30000 AND q > pos
  WHERE b - pos > 30000 GROUP BY step.seg_id, pos)
SELECT seg_id, CASE WHEN min(b - pos) <= 30000 THEN 'natural' ELSE 'forced' END AS cut FROM step GROUP BY seg_id
""",
}
