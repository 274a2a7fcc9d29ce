"""SQL of the operator queries, for an engine that reads the same tables."""

from __future__ import annotations

_SEG = """seg AS (
  SELECT * FROM (SELECT * REPLACE (CAST(round("start" * 1000) AS BIGINT) AS "start", CAST(round("end" * 1000) AS BIGINT) AS "end"), CAST(round("start" * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e FROM seg_result)
  WHERE e > s QUALIFY row_number() OVER (PARTITION BY seg_id ORDER BY ingested_at NULLS FIRST, speaker NULLS FIRST) = 1)"""
_W = "(PARTITION BY rec_id ORDER BY s, e, seg_id)"
_BEFORE = "(PARTITION BY rec_id ORDER BY s, e, seg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_DENEST = f"kept AS (SELECT * FROM (SELECT *, max(e) OVER {_BEFORE} AS reach FROM seg) WHERE e > greatest(coalesce(reach, 0), 0))"
_GAPS = f"""gaps AS (SELECT rec_id, a AS start_ms, b AS end_ms FROM (SELECT rec_id, coalesce(lag(e) OVER {_W}, 0) AS a, s AS b FROM kept) WHERE b - a >= 300)"""
_INDEX = "CASE WHEN n < 100000 THEN lpad(CAST(n AS VARCHAR), 5, '0') ELSE CAST(n AS VARCHAR) END"
_TIME = lambda ms, dot, day: f"lpad(CAST({ms} // 3600000 {day} AS VARCHAR), 2, '0') || ':' || lpad(CAST({ms} // 60000 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST({ms} // 1000 % 60 AS VARCHAR), 2, '0') || '{dot}' || lpad(CAST({ms} % 1000 AS VARCHAR), 3, '0')"
_FILES = """files AS (
  SELECT * FROM audio_file WHERE regexp_extract(lower(path), '(\\.[^./]*)$', 1) IN ('.mp3', '.wav', '.flac', '.m4a', '.aac', '.opus', '.ogg') AND NOT contains(regexp_replace(path, '^.*/', ''), '.temp')
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY modificationtime DESC NULLS LAST, length DESC NULLS LAST) = 1)"""
_CACHED = """names AS (
  SELECT path, length, CASE WHEN regexp_extract(lower(path), '(\\.[^./]*)$', 1) IN ('.opus', '.ogg') THEN
    regexp_replace(regexp_replace(regexp_replace(path, '^.*/', ''), '(.)\\.[^.]*$', '\\1'), '[^\\w\\-.]', '_', 'g') || '_' || md5(concat_ws('|', path, CAST(epoch_us(modificationtime) AS VARCHAR), CAST(length AS VARCHAR)))[:16] || '.wav' END AS cached
  FROM files)"""
_TOKENS = lambda c: f"list_filter(regexp_split_to_array(coalesce({c}, ''), '\\s+'), lambda w: w <> '')"
_JACCARD = lambda a, b: f"CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) ELSE 0 END"
_RUNS = """
WITH {given}
words AS (SELECT {key}, coalesce(trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> '', false) AS filled, list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda w: w <> '') AS w FROM {table}),
runs AS (SELECT {key}, array_to_string(w[i:i + 14], ' ') AS run FROM words, unnest(range(1, greatest(len(w) - 13, 1))) AS u(i)),
often AS (SELECT DISTINCT {key} FROM (SELECT {key}, run FROM runs GROUP BY {key}, run HAVING count(*) > 5))
SELECT {key}, filled AND {key} NOT IN (SELECT {key} FROM often) AS keep FROM words
"""
_WHITE = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_MOS = {"sig": "-0.08397278, 1.22083953, 0.0052439", "bak": "-0.13166888, 1.60915514, -0.39604546", "ovr": "-0.06766283, 1.11546468, 0.04602535"}


def _poly(kind: str) -> str:
    a, b, c = _MOS[kind].split(", ")
    return f"({a}::DOUBLE * {kind} * {kind} + {b}::DOUBLE * {kind} + ({c})::DOUBLE)"


SQL = {
    "segment_index": f"WITH {_SEG}, numbered AS (SELECT *, row_number() OVER {_W} - 1 AS n FROM seg) SELECT rec_id, seg_id, {_INDEX} AS index, s, e, speaker FROM numbered",
    "chunk_offsets": f"WITH {_SEG} SELECT rec_id, seg_id, s, e, s // 120000 AS chunk, s % 120000 AS within FROM seg",
    "pad_boundaries": f"WITH {_SEG} SELECT rec_id, seg_id, greatest(s - 250, 0) AS s, greatest(greatest(s - 250, 0), least(greatest(e + 400, 0), max(e) OVER (PARTITION BY rec_id))) AS e FROM seg",
    "split_long": f"""
WITH {_SEG}, parts AS (SELECT rec_id, seg_id, piece, s + piece * 30000 AS s, least(e, s + (piece + 1) * 30000) AS e FROM seg, unnest(range(0, CAST(greatest(ceil((e - s) / 30000.0), 1) AS BIGINT))) AS u(piece)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY rec_id ORDER BY s, e, seg_id, piece) - 1 AS n FROM parts) SELECT rec_id, seg_id, piece, {_INDEX} AS index, s, e FROM numbered""",
    "denest_running_max": f"WITH {_SEG}, {_DENEST} SELECT rec_id, seg_id, s, e FROM kept",
    "silence_gaps": f"""
WITH {_SEG}, {_DENEST}, {_GAPS} SELECT * FROM gaps
UNION ALL SELECT rec_id, max(e), max(e) + 1000 FROM seg GROUP BY rec_id""",
    "overlap_pairs": f"""
WITH {_SEG} SELECT a.rec_id, a.seg_id AS seg1, b.seg_id AS seg2, greatest(a.s, b.s) AS overlap_start, least(a.e, b.e) AS overlap_end, least(a.e, b.e) - greatest(a.s, b.s) AS overlap_ms
FROM seg a JOIN seg b ON a.rec_id = b.rec_id AND (a.s, a.e, a.seg_id) < (b.s, b.e, b.seg_id) AND b.s < a.e WHERE least(a.e, b.e) - greatest(a.s, b.s) >= 200""",
    "reference_segments": f"""
WITH {_SEG}, pairs AS (SELECT a.seg_id AS x, b.seg_id AS y FROM seg a JOIN seg b ON a.rec_id = b.rec_id AND (a.s, a.e, a.seg_id) < (b.s, b.e, b.seg_id) AND b.s < a.e WHERE least(a.e, b.e) - greatest(a.s, b.s) >= 1000)
SELECT rec_id, speaker, arg_min(seg_id, (s, e, seg_id)) AS seg_id FROM seg
WHERE e - s >= 2000 AND speaker IS NOT NULL AND rec_id IS NOT NULL AND seg_id NOT IN (SELECT x FROM pairs UNION SELECT y FROM pairs) GROUP BY rec_id, speaker""",
    "cut_by_speaker": f"""
WITH RECURSIVE {_SEG}, numbered AS (SELECT rec_id, s, e, speaker, row_number() OVER {_W} AS i FROM seg WHERE speaker IS NOT NULL),
fold AS (
  SELECT rec_id, i, speaker, CASE WHEN e - s >= 30000 THEN s + (e - s) // 30000 * 30000 ELSE s END AS cs, e AS ce, i AS g FROM numbered WHERE i = 1
  UNION ALL
  SELECT n.rec_id, n.i, n.speaker,
    CASE WHEN n.e - n.s < 3000 AND n.speaker = f.speaker AND n.s - f.ce < 2000 AND n.e - f.cs < 30000 THEN f.cs WHEN n.e - n.s >= 30000 THEN n.s + (n.e - n.s) // 30000 * 30000 ELSE n.s END,
    n.e,
    CASE WHEN n.e - n.s < 3000 AND n.speaker = f.speaker AND n.s - f.ce < 2000 AND n.e - f.cs < 30000 THEN f.g ELSE n.i END
  FROM fold f JOIN numbered n ON n.rec_id = f.rec_id AND n.i = f.i + 1),
last AS (SELECT rec_id, min(cs) AS s, arg_max(ce, i) AS e, any_value(speaker) AS speaker FROM fold GROUP BY rec_id, g),
pieces AS (SELECT rec_id, s + k * 30000 AS s, s + (k + 1) * 30000 AS e, speaker FROM numbered, unnest(range(0, (e - s) // 30000)) AS u(k) WHERE e - s >= 30000)
SELECT * FROM (SELECT * FROM last UNION ALL SELECT * FROM pieces) WHERE e - s >= 3000""",
    "chunk_ranges": f"""
WITH RECURSIVE {_SEG}, {_DENEST}, {_GAPS}, mids AS (SELECT rec_id, start_ms + end_ms AS at2 FROM gaps WHERE rec_id IS NOT NULL),
totals AS (SELECT rec_id, 2 * max(e) AS total FROM seg WHERE rec_id IS NOT NULL GROUP BY rec_id),
cut AS (
  SELECT rec_id, total, -1::BIGINT AS chunk, 0::BIGINT AS a, 0::BIGINT AS b FROM totals
  UNION ALL
  SELECT c.rec_id, any_value(c.total), c.chunk + 1, c.b,
    CASE WHEN any_value(c.total) <= 240002 THEN any_value(c.total) WHEN max(at2) FILTER (at2 <= c.b + 240000) IS NOT NULL THEN max(at2) FILTER (at2 <= c.b + 240000)
      WHEN count(at2) FILTER (at2 > c.b + 240000) > 0 OR c.rec_id NOT IN (SELECT rec_id FROM mids) THEN least(c.b + 240000, any_value(c.total)) ELSE any_value(c.total) END
  FROM cut c LEFT JOIN mids m ON m.rec_id = c.rec_id AND m.at2 > c.b + 2
  WHERE c.b < c.total - 2 GROUP BY c.rec_id, c.chunk, c.b)
SELECT rec_id, chunk, a AS start_2ms, b AS end_2ms FROM cut WHERE chunk >= 0""",
    "dedup_by_index": f"""
WITH {_SEG} SELECT rec_id, seg_id, "index" FROM seg WHERE "index" IS NULL
UNION ALL SELECT rec_id, arg_min(seg_id, (s, e, seg_id)), "index" FROM seg WHERE "index" IS NOT NULL GROUP BY rec_id, "index" """,
    "word_times": f"""
WITH {_SEG} SELECT seg_id, i - 1 AS i, words[i].word AS word, CAST(round((words[i]."start" + s / 1000) * 1000) AS BIGINT) AS start_ms, CAST(round((words[i]."end" + s / 1000) * 1000) AS BIGINT) AS end_ms
FROM seg, unnest(range(1, len(words) + 1)) AS u(i)""",
    "caption_context": f"""
WITH {_SEG}, near AS (SELECT rec_id, seg_id, row_number() OVER {_W} AS n, lag(text) OVER {_W} AS one, lag(text, 2) OVER {_W} AS two FROM seg)
SELECT rec_id, seg_id, least(n - 1, 2) AS n, CASE WHEN n >= 3 THEN coalesce(two, '') || '|' || coalesce(one, '') WHEN n = 2 THEN coalesce(one, '') ELSE '' END AS context FROM near""",
    "speaker_tags": f"""
WITH {_SEG}, firsts AS (SELECT rec_id, speaker, min((s, e, seg_id)) AS place FROM seg WHERE speaker IS NOT NULL GROUP BY ALL),
tags AS (SELECT rec_id, speaker, row_number() OVER (PARTITION BY rec_id ORDER BY place, speaker) - 1 AS tag FROM firsts)
SELECT rec_id, seg_id, s, e, '[s' || tag || ']' || coalesce(text, '') AS text FROM seg JOIN tags USING (rec_id, speaker)""",
    "tagged_text": f"""
WITH {_SEG} SELECT rec_id, s // 3600000 AS part, string_agg('[' || coalesce(speaker, 'Unknown') || ']: ' || coalesce(text, ''), chr(10) ORDER BY s, e, seg_id) AS text FROM seg GROUP BY ALL""",
    "relabel": f"""
WITH {_SEG}, names AS (SELECT rec_id, speaker, min(alias) AS label FROM speaker_alias WHERE rec_id IS NOT NULL AND speaker IS NOT NULL GROUP BY ALL)
SELECT seg.rec_id, seg_id, seg.speaker, label FROM seg LEFT JOIN names ON seg.rec_id = names.rec_id AND seg.speaker = names.speaker""",
    "char_count": "SELECT doc_id, length(translate(text, ',.!?\"''，。！？“”‘’ ', '')) AS chars FROM documents",
    "display_times": f"WITH {_SEG} SELECT seg_id, '[ ' || {_TIME('s', '.', '')} || ' --> ' || {_TIME('e', '.', '')} || ']' AS shown, {_TIME('s', ',', '% 24')} AS srt FROM seg",
    "srt_parts": f"""
WITH {_SEG}, numbered AS (SELECT *, row_number() OVER {_W} AS n FROM seg)
SELECT rec_id, s // 3600000 AS part, string_agg(n || chr(10) || {_TIME('s', ',', '% 24')} || ' --> ' || {_TIME('e', ',', '% 24')} || chr(10) || coalesce(speaker, '') || ': ' || coalesce(text, '') || chr(10) || chr(10), '' ORDER BY n) AS srt FROM numbered GROUP BY ALL""",
    "repetition_filter": _RUNS.format(given="", key="doc_id", table="documents"),
    "repetition_filter_segments": _RUNS.format(given=_SEG + ",", key="seg_id", table="seg"),
    "iqr_filter": f"""
WITH {_SEG}, rated AS (SELECT seg_id, s, e, coalesce(length(translate(text, ',.!?"''，。！？“”‘’ ', '')), 0) AS chars, (e - s) / 1000 AS d FROM seg),
rates AS (SELECT *, CASE WHEN chars > 0 THEN d / chars ELSE 0 END AS rate FROM rated),
q AS (SELECT quantile_cont(rate, 0.25) AS a, quantile_cont(rate, 0.75) AS b FROM rates WHERE chars > 0)
SELECT seg_id, chars, e - s AS ms FROM rates, q WHERE d BETWEEN 3 AND 30 AND chars >= 2 AND rate BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)""",
    "jaccard_trust": f"""
WITH {_SEG}, w AS (SELECT seg_id, {_TOKENS('text_whisper')} AS a, {_TOKENS('text_canary')} AS b, {_TOKENS('text_parakeet')} AS c FROM seg),
p AS (SELECT seg_id, {_JACCARD('a', 'b')} AS ab, {_JACCARD('a', 'c')} AS ac, {_JACCARD('b', 'c')} AS bc FROM w)
SELECT seg_id, (ab + ac) / 2 AS whisper, (ab + bc) / 2 AS canary, (ac + bc) / 2 AS parakeet FROM p""",
    "trusted_transcripts": f"""
WITH {_SEG}, w AS (SELECT seg_id, {_TOKENS('text_whisper')} AS a, {_TOKENS('text_canary')} AS b, {_TOKENS('text_parakeet')} AS c FROM seg),
p AS (SELECT seg_id, {_JACCARD('a', 'b')} AS ab, {_JACCARD('a', 'c')} AS ac, {_JACCARD('b', 'c')} AS bc FROM w),
m AS (SELECT seg_id, unnest([0, 1, 2]) AS i, unnest([(ab + ac) / 2, (ab + bc) / 2, (ac + bc) / 2]) AS mean FROM p),
r AS (SELECT *, max(mean) OVER (PARTITION BY seg_id) AS most, row_number() OVER (PARTITION BY seg_id ORDER BY mean DESC, i) AS rank FROM m)
SELECT seg_id, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS trusted FROM r WHERE CASE WHEN most >= 0.3 THEN mean >= 0.3 ELSE rank <= 2 END GROUP BY seg_id""",
    "max_gap_split": f"""
WITH RECURSIVE {_SEG}, {_DENEST},
long AS (SELECT rec_id, seg_id, list_sort(list_transform(words, lambda w: {{'s': CAST(round(w."start" * 1000) AS BIGINT), 'e': CAST(round(w."end" * 1000) AS BIGINT)}})) AS st FROM kept WHERE e - s > 20000 AND len(words) > 0),
node AS (
  SELECT rec_id, seg_id, st, CAST(1 AS BIGINT) AS a, CAST(len(st) AS BIGINT) AS b FROM long
  UNION ALL
  SELECT rec_id, seg_id, st, unnest([a, spot + 1]), unnest([spot, b]) FROM (
    SELECT rec_id, seg_id, st, a, b, a + list_position(gaps, list_max(gaps)) - 1 AS spot FROM (
      SELECT *, list_transform(range(a, b), lambda i: st[i + 1].s - st[i].e) AS gaps FROM node WHERE a < b AND st[b].e - st[a].s >= 20000))),
leaf AS (SELECT rec_id, seg_id, row_number() OVER (PARTITION BY seg_id ORDER BY a) - 1 AS part, st[a].s AS s, st[b].e AS e FROM node WHERE a = b OR st[b].e - st[a].s < 20000)
SELECT * FROM leaf UNION ALL SELECT rec_id, seg_id, 0, s, e FROM kept WHERE e - s <= 20000""",
    "result_document_rows": f"""
WITH {_SEG}, numbered AS (SELECT *, row_number() OVER {_W} - 1 AS n, max(e) OVER (PARTITION BY rec_id) AS last FROM seg)
SELECT rec_id, n // 100 AS part, n % 100 AS place, seg_id, s, e, speaker, text, round(last / 1000.0::DOUBLE, 3) AS seconds FROM numbered""",
    "link_speakers": """
WITH RECURSIVE near AS (
  SELECT vec_id // 50 AS chunk, 'speaker_' || label AS speaker, vec_id, embedding::DOUBLE[] AS v, row_number() OVER (PARTITION BY vec_id // 50, label ORDER BY vec_id) AS r FROM embeddings),
means AS (SELECT chunk, speaker, i, avg(v[i]) AS x FROM near, unnest(range(1, len(v) + 1)) AS u(i) WHERE r <= 3 GROUP BY ALL),
heard AS (
  SELECT row_number() OVER (ORDER BY chunk, place, speaker) AS t, * FROM (
    SELECT m.chunk, m.speaker, list(x ORDER BY i) AS v, any_value(f.vec_id) AS place FROM means m JOIN near f ON f.chunk = m.chunk AND f.speaker = m.speaker AND f.r = 1 GROUP BY m.chunk, m.speaker)),
walk AS (
  SELECT CAST(0 AS BIGINT) AS t, CAST(-1 AS BIGINT) AS chunk, '' AS speaker, CAST([] AS STRUCT(c DOUBLE[], n BIGINT)[]) AS known, CAST([] AS BIGINT[]) AS used, CAST(0 AS BIGINT) AS who, CAST(NULL AS DOUBLE) AS best
  UNION ALL
  SELECT t, chunk, speaker,
    CASE WHEN hit THEN list_transform(known, lambda k, i: CASE WHEN i = found THEN {'c': list_transform(list_zip(k.c, v), lambda z: (z[1] * k.n + z[2]) / (k.n + 1)), 'n': k.n + 1} ELSE k END) ELSE list_append(known, {'c': v, 'n': 1}) END,
    list_append(used, CASE WHEN hit THEN found ELSE len(known) + 1 END), CASE WHEN hit THEN found ELSE len(known) + 1 END, CASE WHEN hit THEN top END
  FROM (
    SELECT *, coalesce(top >= 0.1, false) AS hit, list_position(sims, top) AS found FROM (
      SELECT *, list_max(sims) AS top FROM (
        SELECT h.t, h.chunk, h.speaker, h.v, w.known, CASE WHEN h.chunk = w.chunk THEN w.used ELSE [] END AS used,
          list_transform(w.known, lambda k, i: CASE WHEN h.chunk = w.chunk AND list_contains(w.used, i) THEN -2 ELSE list_cosine_similarity(k.c, h.v) END) AS sims
        FROM walk w JOIN heard h ON h.t = w.t + 1))))
SELECT 'rec' AS rec_id, chunk, speaker, 'SPEAKER_' || CASE WHEN who <= 10 THEN '0' ELSE '' END || CAST(who - 1 AS VARCHAR) AS linked, round(best, 6) AS similarity FROM walk WHERE t > 0""",
    "majority_language": f"""
WITH {_SEG}, per AS (SELECT rec_id, language, count(*) AS n, min((s, e, seg_id)) AS place FROM seg WHERE language IS NOT NULL GROUP BY ALL)
SELECT rec_id, arg_min(language, (-n, place)) AS language, max(n) AS n FROM per GROUP BY rec_id""",
    "diarization_lines": f"""
WITH {_SEG}, numbered AS (SELECT *, row_number() OVER {_W} - 1 AS n FROM seg)
SELECT rec_id, seg_id, '[ ' || {_TIME('s', '.', '')} || ' --> ' || {_TIME('e', '.', '')} || ']' AS segment, chr(CAST(65 + n % 26 AS INTEGER)) AS label,
  'SPEAKER_' || lpad(CAST(CAST(regexp_extract(speaker, '([0-9]+)', 1) AS BIGINT) AS VARCHAR), 2, '0') AS speaker, s, e FROM numbered WHERE regexp_matches(speaker, '^SPEAKER_[0-9]+$')""",
    "json_arrays": "SELECT event_id, event_id % 4 = 0 AS parsed, CASE WHEN event_id % 4 = 0 THEN CAST(props->>'k' AS BIGINT) END AS k FROM events",
    "json_blocks": "SELECT event_id, CASE WHEN event_id % 4 = 3 THEN 0 ELSE 1 END::BIGINT AS n, CASE WHEN event_id % 4 < 3 THEN CAST(props->>'k' AS BIGINT) END AS k FROM events",
    "audio_listing": f"WITH {_FILES.replace('FROM audio_file WHERE', 'FROM audio_file WHERE length >= 1024 AND')} SELECT path, length FROM files",
    "audio_folders": r"SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder FROM audio_file WHERE regexp_extract(path, '(\.[^./]*)$', 1) IN ('.opus', '.ogg') AND NOT contains(regexp_extract(path, '^(.*)/[^/]*$', 1), '_opus_cache')",
    "cache_names": f"WITH {_FILES}, {_CACHED} SELECT path, cached FROM names",
    "decode_todo": f"WITH {_FILES}, {_CACHED} SELECT path, cached FROM names WHERE cached IS NOT NULL AND cached NOT IN (SELECT cached FROM names WHERE regexp_matches(path, '[02468][.][^.]*$') AND cached IS NOT NULL)",
    "decoded_paths": f"WITH {_FILES}, {_CACHED} SELECT path, CASE WHEN cached IS NULL THEN path ELSE '/cache/' || cached END AS read FROM names WHERE cached IS NULL OR regexp_matches(path, '[02468][.][^.]*$')",
    "resume_todo": "SELECT DISTINCT rec_id FROM audio_file WHERE rec_id IS NOT NULL AND rec_id NOT IN (SELECT rec_id FROM seg_result WHERE rec_id IS NOT NULL)",
    "progress_running": f"""
WITH {_FILES}, done AS (SELECT path, length, epoch_us(modificationtime) // 1000 AS ms FROM files WHERE modificationtime IS NOT NULL AND length IS NOT NULL)
SELECT path, row_number() OVER w AS files, CAST(sum(length) OVER w AS BIGINT) AS bytes, 100.0::DOUBLE * row_number() OVER w / count(*) OVER () AS percent FROM done WINDOW w AS (ORDER BY ms, path ROWS UNBOUNDED PRECEDING)""",
    "recording_metadata": f"""
WITH {_SEG} SELECT rec_id, count(*) AS total_segments, max(e) / 1000 AS audio_duration_seconds, max(e) / 1000 / 60 AS audio_duration_minutes,
  CASE WHEN max(e) > 0 THEN count(*) * 0.5::DOUBLE / (max(e) / 1000) ELSE 0 END AS rt FROM seg GROUP BY rec_id""",
    "result_document_sizes": f"""
WITH {_SEG}, numbered AS (SELECT *, row_number() OVER {_W} - 1 AS n, count(*) OVER (PARTITION BY rec_id) AS total_segments FROM seg)
SELECT rec_id, n // 1000 AS part, count(*) AS n, arg_min(seg_id, numbered.n) AS first, any_value(total_segments) AS total_segments FROM numbered GROUP BY rec_id, numbered.n // 1000""",
    "clip_names": f"WITH {_SEG}, numbered AS (SELECT *, row_number() OVER {_W} - 1 AS n FROM seg) SELECT seg_id, {_INDEX} || '_' || coalesce(speaker, 'UNKNOWN') || '.mp3' AS name FROM numbered",
    "separated_flags": f"""
WITH {_SEG} SELECT rec_id, count(*) FILTER (demucs) AS demucs, count(*) FILTER (is_separated) AS separated,
  count(*) FILTER (sepreformer AND is_separated AND trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> '') AS denoise, CAST(sum(e - s) AS BIGINT) AS ms FROM seg GROUP BY rec_id""",
    "cosine_neighbours": "SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
    "centroids": """
WITH near AS (SELECT vec_id // 50 AS chunk, 'speaker_' || label AS speaker, embedding::DOUBLE[] AS v FROM embeddings QUALIFY row_number() OVER (PARTITION BY vec_id // 50, label ORDER BY vec_id) <= 3)
SELECT chunk, speaker, i - 1 AS i, round(avg(v[i]), 6) AS x, count(*) AS used FROM near, unnest(range(1, len(v) + 1)) AS u(i) GROUP BY ALL""",
    "nearest_speaker": """
SELECT e.vec_id, CASE WHEN list_cosine_similarity(e.embedding::DOUBLE[], b.embedding::DOUBLE[]) > list_cosine_similarity(e.embedding::DOUBLE[], a.embedding::DOUBLE[]) THEN 'v1' ELSE 'v0' END AS label
FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) a, (SELECT embedding FROM embeddings WHERE vec_id = 1) b""",
    "sound_levels": "SELECT vec_id, round(sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)) / len(embedding)), 6) AS rms, round(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)), 6) AS energy, round(list_max(list_transform(embedding::DOUBLE[], lambda x: abs(x))), 6) AS peak FROM embeddings",
    "gain": "SELECT vec_id, round(least(greatest(-20 - 20 * log10(sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)) / len(embedding))), -3), 3), 6) AS db FROM embeddings",
    "mos_scores": f"""
WITH q AS (SELECT l_orderkey, l_quantity / 10 AS sig, l_quantity / 10 * 0.9::DOUBLE AS bak, l_quantity / 10 * 0.8::DOUBLE AS ovr FROM lineitem)
SELECT l_orderkey, count(*) AS num_hops, round(avg(ovr), 6) AS ovr_raw, round(avg(sig), 6) AS sig_raw, round(avg(bak), 6) AS bak_raw, round(avg({_poly('ovr')}), 6) AS ovr, round(avg({_poly('sig')}), 6) AS sig, round(avg({_poly('bak')}), 6) AS bak FROM q GROUP BY l_orderkey""",
    "hop_windows": f"""
WITH {_SEG}, long AS (SELECT seg_id, CAST((e - s) * pow(2, greatest(ceil(log2(9010.0 / (e - s))), 0)) AS BIGINT) AS l FROM seg),
counted AS (SELECT seg_id, l, CAST(trunc((l // 1000 * 1000 - 9010) / 1000) AS BIGINT) + 1 AS c FROM long),
starts AS (SELECT seg_id, list_filter(list_transform(range(0, greatest(c - 1, 0) + 1), lambda i: i * 1000), lambda x: x + 9010 <= l) AS w FROM counted)
SELECT seg_id, len(w) AS n, list_max(w) AS last FROM starts""",
    "last_lines": rf"WITH bare AS (SELECT doc_id, regexp_replace(text, '^{_WHITE}+|{_WHITE}+$', '', 'g') AS t FROM documents) SELECT doc_id, regexp_replace(regexp_extract(t, '([^\n]*)$', 1), '^{_WHITE}+|{_WHITE}+$', '', 'g') AS line FROM bare",
    "matched_level": """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), l AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x)) / len(v)) AS r FROM v),
m AS (SELECT vec_id, list_transform(v[1:32], lambda x: least(greatest(x * (0.5 / (r + 1e-10)), -1), 1)) AS w FROM l)
SELECT vec_id, len(w) AS n, round(sqrt(list_sum(list_transform(w, lambda x: x * x)) / len(w)), 5) AS rms FROM m""",
    "music_flags": "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN false ELSE value / 100 > 0.3 END AS music FROM events",
    "latin_phrases": "WITH f AS (SELECT doc_id, regexp_extract_all(text, '[A-Za-z][A-Za-z'']*(?: +[A-Za-z][A-Za-z'']*)*') AS p FROM documents WHERE lang = 'ko') SELECT doc_id, CASE WHEN p IS NOT NULL THEN len(p) END AS n, array_to_string(p, '|') AS phrases FROM f",
    "safe_names": r"SELECT DISTINCT path, regexp_replace(regexp_replace(regexp_replace(path, '^.*/', ''), '(.)\.[^.]*$', '\1'), '[^\w\-.]', '_', 'g') AS name FROM audio_file WHERE path IS NOT NULL",
    "settings_sweep": "SELECT voted, music, parted, threshold FROM (VALUES ('on'), ('off')) a(voted), (VALUES ('on'), ('off')) b(music), (VALUES ('on'), ('off')) c(parted), (VALUES ('0.5'), ('1.0'), ('1.5')) d(threshold)",
    "overlap_repair": "SELECT 'rec_' || vec_id AS rec_id, seg_id, seg_id < 3 AS separated, n FROM embeddings, (VALUES (1::BIGINT, 3200::BIGINT), (2, 2240), (3, 1920)) s(seg_id, n)",
}
