"""DuckDB SQL for each query, over the same parquet tables.

The SQL is written independently of the Spark plans: plain windows, all-pairs
joins and recursive queries in place of chunked windows, keyed joins and loops.
"""

from __future__ import annotations

from claimweave import fixed
from claimweave.operators.extract import TEMPLATE, flag_lines

ORACLES: dict[str, str] = {}
CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, needs: str, sql: str) -> None:
    CTES[name] = (needs.split(), sql)


def oracle(name: str, needs: str, sql: str) -> None:
    ORACLES[name] = compose(needs.split(), sql)


def compose(needs: list[str], sql: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return sql.strip()
    parts = []
    for n in order:
        body = CTES[n][1].strip()
        # a recursive CTE brings its own column list and clause
        parts.append(body if body.startswith(f"{n}(") else f"{n} AS (\n{body}\n)")
    sql = sql.strip()
    if sql.startswith("WITH"):
        sql = f"SELECT * FROM (\n{sql}\n)"
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + sql


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def h16(x: str) -> str:
    return f"('0x'||substr(md5({x}),1,4))::int"


def clock_problem(c: str) -> str:
    return f"""CASE WHEN NOT coalesce(regexp_matches({c}, '^\\d{{2}}:\\d{{2}}:\\d{{2}}$'), false) THEN 'Invalid timestamp format: '||{c}||'. Expected HH:MM:SS'
      WHEN substr({c},1,2)::int > 23 THEN 'Invalid hours in timestamp: '||substr({c},1,2)::int
      WHEN substr({c},4,2)::int > 59 THEN 'Invalid minutes in timestamp: '||substr({c},4,2)::int
      WHEN substr({c},7,2)::int > 59 THEN 'Invalid seconds in timestamp: '||substr({c},7,2)::int END"""


def seconds(c: str) -> str:
    return f"(substr({c},1,2)::int*3600 + substr({c},4,2)::int*60 + substr({c},7,2)::int)"


def render(c: str) -> str:
    return f"printf('%02d:%02d:%02d', ({c})//3600, (({c})%3600)//60, ({c})%60)"


# --- inputs -----------------------------------------------------------------------

cte("lines", "", f"""
SELECT 'ep_'||lpad(conv_id::varchar,6,'0') AS episode_id, conv_id AS episode_seq, turn+1 AS line_no,
  CASE k WHEN 0 THEN concat_ws(' | ', who, st, st, said) WHEN 1 THEN concat_ws(' | ', who, st, said)
    WHEN 2 THEN concat_ws(' | ', who, st, en, 'a | b '||said) WHEN 3 THEN concat_ws(' | ', '', st, en, said)
    WHEN 4 THEN concat_ws(' | ', who, '25:00:00', en, said) WHEN 5 THEN concat_ws(' | ', who, st, substr(en,2), said)
    WHEN 6 THEN concat_ws(' | ', who, st, en, '') ELSE concat_ws(' | ', who, st, en, said) END AS line
FROM (SELECT *, (conv_id*7+turn)%23 AS k, upper(role) AS who, regexp_replace(text,'\\s+',' ','g') AS said,
  {render('turn*60')} AS st, {render('turn*60+30')} AS en FROM conversations)
""")
cte("episodes", "lines", "SELECT episode_id, min(episode_seq) AS episode_seq FROM lines GROUP BY 1")
cte("parsed", "lines", f"""
SELECT *, CASE WHEN reason IS NOT NULL THEN 'Line '||line_no||': '||reason END AS error FROM (
 SELECT *, CASE WHEN n_parts <> 4 THEN 'Invalid line format. Expected 4 parts, got '||n_parts
   WHEN speaker = '' THEN 'Speaker cannot be empty'
   WHEN sp IS NOT NULL THEN sp WHEN ep IS NOT NULL THEN ep
   WHEN {seconds('ts')} >= {seconds('te')} THEN 'Start time '||ts||' must be before end time '||te
   WHEN text = '' THEN 'Utterance text cannot be empty' END AS reason
 FROM (SELECT *, {clock_problem('ts')} AS sp, {clock_problem('te')} AS ep FROM (
  SELECT episode_id, episode_seq, line_no, line, len(p) AS n_parts, trim(p[1]) AS speaker, trim(p[2]) AS ts, trim(p[3]) AS te, trim(p[4]) AS text
  FROM (SELECT *, string_split(trim(line),'|') AS p FROM lines WHERE trim(line) <> ''))))
""")
cte("utts", "parsed", f"""
SELECT md5(episode_id||'|'||line_no) AS utterance_id, episode_id, episode_seq, speaker, ts AS timestamp_start, te AS timestamp_end,
  {seconds('ts')} AS start_s, {seconds('te')} AS end_s, line_no, text FROM parsed WHERE error IS NULL
""")
cte("sents", "utts", """
SELECT CASE WHEN several THEN md5(parent_id||'|'||pos) ELSE parent_id END AS utterance_id, parent_id, episode_id, episode_seq, line_no,
  CASE WHEN several THEN pos ELSE 0 END AS sentence_no, speaker, CASE WHEN several THEN trim(piece) ELSE text END AS text
FROM (SELECT *, len(l) > 1 AS several, unnest(CASE WHEN len(l) > 1 THEN l ELSE [text] END) AS piece,
       generate_subscripts(CASE WHEN len(l) > 1 THEN l ELSE [text] END, 1) AS pos
  FROM (SELECT utterance_id AS parent_id, * EXCLUDE (utterance_id),
    list_filter(string_split_regex(regexp_replace(text,'([.!?])\\s+','\\1'||chr(1),'g'),chr(1)), lambda x: trim(x) <> '') AS l FROM utts))
""")
_FLAGS = "[" + ", ".join(quoted(f) for f in fixed.FLAGS) + "]"
cte("claims", "sents", f"""
SELECT utterance_id, o, pair, h, CASE WHEN h%13=0 THEN 'not ' ELSE '' END || pair AS said,
  printf('%.2f', CASE WHEN h%10=9 THEN 1.5::double ELSE (h%101)/100.0::double END) AS num,
  {_FLAGS}[(h%11+1)::int] AS f1, {_FLAGS}[((h//11)%11+1)::int] AS f2
FROM (SELECT utterance_id, o, array_to_string(w[2*o-1:2*o],' ') AS pair, {h16("utterance_id||'|'||o")} AS h
  FROM (SELECT utterance_id, w, unnest(range(1, (len(w)+1)//2+1)) AS o
    FROM (SELECT utterance_id, string_split(trim(regexp_replace(regexp_replace(lower(text),'[^\\p{{L}}\\p{{N}}\\s]',' ','g'),'\\s+',' ','g')),' ') AS w FROM sents)))
""")
cte("answers", "claims sents", f"""
SELECT s.utterance_id, CASE WHEN s.hh%97=0 THEN '{{not json' WHEN s.hh%10=8 THEN '{{"beliefs": []}}'
   WHEN s.hh%89=1 THEN '{{"note": "nothing found"}}' WHEN s.hh%83=2 THEN '[1]' ELSE '{{"beliefs": ['||j.items||']}}' END AS response
FROM (SELECT utterance_id, {h16('utterance_id')} AS hh FROM sents) s JOIN (
 SELECT utterance_id, string_agg(CASE WHEN h%43=17 THEN '"'||said||'"' ELSE
   '{{"belief_text": "'||said||'", "confidence": '||CASE WHEN h%17=3 THEN '"'||num||'"' ELSE num END
   ||CASE WHEN h%29=5 THEN ', "original_quote": null' WHEN h%3=0 THEN ', "original_quote": "'||said||'"' ELSE '' END
   ||CASE WHEN h%37=11 THEN '' ELSE ', "extraction_flags": {{"'||f1||'": '||CASE WHEN h%31=7 THEN '"maybe"' WHEN h%41=13 THEN '"true"' ELSE 'true' END
     ||CASE WHEN f1<>f2 THEN ', "'||f2||'": false' ELSE '' END||'}}' END||'}}' END, ', ' ORDER BY o) AS items
 FROM claims GROUP BY 1) j USING (utterance_id)
""")
cte("rooted", "answers", "SELECT utterance_id, try_cast(response AS json) AS r FROM answers")
cte("usable", "rooted", """
SELECT utterance_id, r, r IS NOT NULL AND json_type(r) = 'OBJECT' AND (json_type(r,'$.beliefs') IS NULL OR json_type(r,'$.beliefs') = 'ARRAY') AS ok FROM rooted
""")
cte("read", "usable sents", """
SELECT md5(utterance_id||'|'||ordinal) AS belief_id, utterance_id, ordinal, belief_text, confidence, original_quote, flag_keys, true_flags,
 CASE WHEN NOT is_object THEN 'element' WHEN belief_text IS NULL OR belief_text = '' THEN 'belief_text'
  WHEN confidence IS NULL OR confidence < 0 OR confidence > 1 THEN 'confidence'
  WHEN original_quote IS NULL OR original_quote = '' THEN 'original_quote'
  WHEN bad_flags > 0 OR len(true_flags) = 0 THEN 'extraction_flags' END AS problem
FROM (SELECT utterance_id, ordinal, json_type(e) = 'OBJECT' AS is_object,
  CASE WHEN json_type(e,'$.belief_text') = 'VARCHAR' THEN trim(e->>'$.belief_text') END AS belief_text,
  try_cast(e->>'$.confidence' AS double) AS confidence,
  CASE WHEN json_type(e,'$.original_quote') IS NULL THEN trim(text) WHEN json_type(e,'$.original_quote') = 'VARCHAR' THEN trim(e->>'$.original_quote') END AS original_quote,
  ks AS flag_keys,
  list_sort(list_filter(ks, lambda k: coalesce(try_cast(json_extract_string(e->'$.extraction_flags', '$.'||k) AS boolean), false))) AS true_flags,
  len(list_filter(ks, lambda k: try_cast(json_extract_string(e->'$.extraction_flags', '$.'||k) AS boolean) IS NULL)) AS bad_flags
 FROM (SELECT *, coalesce(CASE WHEN json_type(e,'$.extraction_flags') = 'OBJECT' THEN json_keys(e->'$.extraction_flags') END, []) AS ks FROM (
  SELECT utterance_id, unnest(l) AS e, generate_subscripts(l,1) AS ordinal FROM (
   SELECT utterance_id, json_extract(r,'$.beliefs[*]') AS l FROM usable WHERE ok AND json_type(r,'$.beliefs') = 'ARRAY'))
  JOIN sents USING (utterance_id)))
""")
cte("beliefs", "read", "SELECT * EXCLUDE (problem) FROM read WHERE problem IS NULL")
_WORDS = """list_transform(string_split(trim(regexp_replace(regexp_replace(regexp_replace(lower({c}),'n[''’]t\\b',' not','g'),'[^\\p{{L}}\\p{{N}}\\s]',' ','g'),'\\s+',' ','g')),' '),
  lambda w: CASE w WHEN 'une' THEN 'un' WHEN 'les' THEN 'le' ELSE w END)"""
cte("normal", "beliefs", f"""
SELECT *, md5(norm_text) AS norm_hash FROM (SELECT *, array_to_string({_WORDS.format(c='belief_text')},' ') AS norm_text FROM beliefs)
""")
cte("forms", "normal", "SELECT norm_hash, norm_text, count(*) AS mentions, min(belief_text) AS spelling FROM normal GROUP BY 1, 2")
cte("mentions", "normal sents", """
SELECT n.*, n.norm_hash AS canonical_id, s.episode_id, s.episode_seq, s.speaker, s.line_no, s.sentence_no FROM normal n JOIN sents s USING (utterance_id)
""")
cte("middle", "", "SELECT floor(max(conv_id)/2)::bigint AS m FROM conversations")
cte("old_m", "mentions middle", "SELECT mentions.* FROM mentions, middle WHERE episode_seq <= m")
cte("new_m", "mentions middle", "SELECT mentions.* FROM mentions, middle WHERE episode_seq > m")


def summary_of(src: str) -> str:
    return f"""
SELECT canonical_id, arg_min(spelling, (-n, norm_text)) AS canonical_text, arg_min(norm_text, (-n, norm_text)) AS norm_text, sum(n)::bigint AS mentions,
  min(lo_seq) AS first_seq, min(lo_ep) AS first_seen_episode, max(hi_seq) AS last_seq, max(hi_ep) AS last_seen_episode
FROM (SELECT canonical_id, norm_text, count(*) AS n, min(belief_text) AS spelling, min(episode_seq) AS lo_seq, min(episode_id) AS lo_ep,
  max(episode_seq) AS hi_seq, max(episode_id) AS hi_ep FROM {src} GROUP BY 1, 2) GROUP BY 1"""


cte("canonicals", "mentions", summary_of("mentions"))
cte("cells", "mentions", """
SELECT episode_id, canonical_id, min(episode_seq) AS episode_seq, avg(confidence) AS conviction_avg, count(*) AS frequency,
  greatest(0.0::double, 1 - 2*stddev_pop(confidence)) AS stability_score, true AS presence_flag FROM mentions GROUP BY 1, 2
""")
cte("calls", "", """
SELECT * EXCLUDE (done, pos, ends), caller||'-'||done||'-'||(pos//4) AS item_id, (pos%4+1)::int AS attempt FROM (
 SELECT *, row_number() OVER (PARTITION BY caller, done ORDER BY ts, call_id) - 1 AS pos FROM (
  SELECT event_id AS call_id, user_id AS caller, 'ep_'||lpad(user_id::varchar,6,'0') AS episode_id, ts, floor(value*10)::bigint AS tokens, value/100 AS latency,
   event_type <> 'error' AS success,
   CASE WHEN event_type = 'error' THEN ['429 rate_limit','Request timed out','HTTP 503','bad request'][(event_id%4+1)::int] END AS error,
   event_type <> 'error' OR event_id%4 = 3 AS ends,
   coalesce(sum((event_type <> 'error' OR event_id%4 = 3)::int) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS done
  FROM events))
""")
_PHASES = "[" + ", ".join(quoted(p) for p in fixed.PHASES) + "]"
cte("manifest", "", f"""
SELECT 'ep_'||lpad(conv_id::varchar,6,'0') AS episode_id, {_PHASES}[(o+1)::int] AS phase, 'run'||o AS run_id,
  epoch_ms((1704067200 + conv_id*40000 + o*(60+conv_id%7))*1000) AS ts, (turns*(o+1))::bigint AS row_count, o AS ord
FROM (SELECT conv_id, turns, unnest(range(0,4)) AS o FROM (SELECT conv_id, count(*) AS turns FROM conversations GROUP BY 1)) WHERE o < (conv_id*7)%5
""")

# --- A ----------------------------------------------------------------------------

oracle("a1_file_lines", "", """
SELECT 'doc_'||doc_id AS episode_id, n AS line_no, md5(l) AS line_md5 FROM (
 SELECT doc_id, generate_subscripts(p,1) AS n, regexp_replace(unnest(p),'^[\\s\\x{A0}\\x{2000}-\\x{200A}\\x{3000}\\x{85}]+|[\\s\\x{A0}\\x{2000}-\\x{200A}\\x{3000}\\x{85}]+$','','g') AS l
 FROM (SELECT doc_id, string_split_regex(regexp_replace(text,'(\\r\\n|\\n|\\r)$',''),'\\r\\n|\\n|\\r') AS p FROM documents WHERE length(text) > 0)) WHERE l <> ''
""")
oracle("a1_transcript_lines", "lines", "SELECT * FROM lines")
oracle("a2_episodes", "episodes", """
SELECT episode_id, episode_seq, episode_id AS title, '2024-01-01' AS date, episode_id||'.txt' AS transcript_path FROM episodes
""")
oracle("a2_numbered_episodes", "episodes", "SELECT episode_id, row_number() OVER (ORDER BY episode_id) - 1 AS episode_seq FROM episodes")
oracle("a3_a4_snapshot_round_trip", "utts", "SELECT utterance_id, episode_id, speaker, start_s, end_s, md5(text||'!') AS text_md5 FROM utts")
oracle("a5_resume_points", "manifest episodes", f"""
SELECT episode_id, {_PHASES}[n] AS last_phase, {_PHASES}[n+1] AS next_phase
FROM (SELECT e.episode_id, coalesce(max(m.ord)+1, 0)::int AS n FROM episodes e LEFT JOIN manifest m USING (episode_id) GROUP BY 1)
""")
oracle("a5_pending", "manifest episodes", """
SELECT episode_id FROM episodes WHERE episode_id NOT IN (SELECT episode_id FROM manifest WHERE phase = 'canonical_beliefs')
""")
oracle("a6_expired", "manifest", """
SELECT episode_id, phase, run_id FROM manifest WHERE episode_id IN (
 SELECT episode_id FROM manifest GROUP BY 1 HAVING max(ts) < TIMESTAMP '2024-02-20 00:00:00' - INTERVAL 30 DAY)
""")
oracle("a7_registry_round_trip", "mentions", """
SELECT 'canonical' AS part, count(DISTINCT canonical_id) AS n FROM mentions UNION ALL SELECT 'member', count(*) FROM mentions
UNION ALL SELECT 'alias', count(DISTINCT lower(belief_text)) FROM mentions
UNION ALL SELECT 'history', count(*) FROM (SELECT DISTINCT canonical_id, episode_id FROM mentions) UNION ALL SELECT 'embedding', count(DISTINCT canonical_id) FROM mentions
""")

# quality events
cte("where_", "sents", "SELECT utterance_id, episode_id, line_no FROM sents")
cte("base_events", "parsed usable read where_", """
SELECT episode_id, 'parsing_error' AS kind, line_no::bigint AS pos, error AS message FROM parsed WHERE error IS NOT NULL
UNION ALL SELECT episode_id, 'api_error', line_no, 'unusable response' FROM usable JOIN where_ USING (utterance_id) WHERE NOT ok
UNION ALL SELECT episode_id, 'malformed', 0, NULL FROM read JOIN where_ USING (utterance_id) WHERE problem IS NOT NULL
""")
cte("tried", "calls", """
SELECT *, CASE WHEN cause IN ('rate_limit','timeout','server_error') AND attempt <= 3
  THEN least(pow(2, attempt) * CASE WHEN cause = 'rate_limit' THEN 2 ELSE 1 END, 60.0) ELSE 0.0 END::double AS wait_s,
  coalesce(cause IN ('rate_limit','timeout','server_error') AND attempt > 3, false) AS exhausted,
  NOT success AND (cause = 'non_retryable' OR attempt > 3) AS given_up
FROM (SELECT *, CASE WHEN NOT success THEN CASE error WHEN '429 rate_limit' THEN 'rate_limit' WHEN 'Request timed out' THEN 'timeout'
  WHEN 'HTTP 503' THEN 'server_error' ELSE 'non_retryable' END END AS cause FROM calls)
""")
cte("call_events", "base_events tried", """
SELECT * FROM base_events UNION ALL SELECT episode_id, 'retry', 0, NULL FROM tried WHERE attempt > 1
UNION ALL SELECT episode_id, 'api_error', call_id, error FROM tried WHERE given_up
""")


def counters_of(src: str) -> str:
    return f"""
SELECT e.episode_id, count(*) FILTER (kind IN ('parsing_error','api_error')) AS errors_count, count(*) FILTER (kind = 'retry') AS retries_count,
 count(*) FILTER (kind = 'malformed') AS malformed_beliefs_count, count(*) FILTER (kind = 'mismatch') AS registry_mismatches_count
FROM episodes e LEFT JOIN {src} USING (episode_id) GROUP BY 1"""


def scored(src: str) -> str:
    return f"""
SELECT *, CASE WHEN quality_score >= 90 THEN 'A' WHEN quality_score >= 80 THEN 'B' WHEN quality_score >= 70 THEN 'C' WHEN quality_score >= 60 THEN 'D' ELSE 'F' END AS quality_grade
FROM (SELECT *, greatest(0.0::double, 100 - 2.0::double*errors_count - 0.5::double*retries_count - malformed_beliefs_count - 0.5::double*registry_mismatches_count) AS quality_score FROM {src})"""


cte("base_counts", "episodes base_events", counters_of("base_events"))
cte("call_counts", "episodes call_events", counters_of("call_events"))
cte("base_scores", "base_counts", scored("base_counts"))
cte("call_scores", "call_counts", scored("call_counts"))
cte("run_times", "manifest", """
SELECT episode_id, sum(d) AS execution_time_seconds FROM (
 SELECT episode_id, epoch(ts) - epoch(lag(ts) OVER (PARTITION BY episode_id ORDER BY ord)) AS d FROM manifest) GROUP BY 1
""")


def messages_of(src: str) -> str:
    return f"SELECT episode_id, kind, string_agg(message, ';' ORDER BY pos, message) AS messages, count(*) AS n FROM {src} WHERE message IS NOT NULL GROUP BY 1, 2"


oracle("a8_report_round_trip", "base_scores base_events", """
SELECT episode_id, 0::bigint AS page_no, errors_count, quality_score, quality_grade,
 (SELECT count(*) FROM base_events b WHERE b.episode_id = s.episode_id AND kind = 'parsing_error') AS n_parsing,
 (SELECT count(*) FROM base_events b WHERE b.episode_id = s.episode_id AND kind = 'api_error') AS n_api, 0 AS n_warnings FROM base_scores s
""")
oracle("a8_second_run", "base_counts base_events episodes middle", f"""
SELECT episode_id, 0::bigint AS page_no, errors_count, quality_score FROM ({scored("""(
 SELECT c.* REPLACE (errors_count + CASE WHEN episode_seq > m THEN 1 ELSE 0 END AS errors_count) FROM base_counts c JOIN episodes USING (episode_id), middle)""")})
""")
oracle("a3_smaller_rerun", "utts", "SELECT utterance_id, episode_id, speaker FROM utts WHERE speaker = 'USER'")
oracle("a6_purged", "utts middle", "SELECT utterance_id, episode_id FROM utts, middle WHERE episode_seq > m")
oracle("a9_matrix_csv", "episodes cells", """
SELECT e.episode_id, w.canonical_id, round(coalesce(c.conviction_avg, 0.0), 6) AS conviction_avg FROM episodes e CROSS JOIN (SELECT DISTINCT canonical_id FROM cells) w
LEFT JOIN cells c ON c.episode_id = e.episode_id AND c.canonical_id = w.canonical_id
""")
_CELL = "episode_id, canonical_id, round(conviction_avg,6) AS conviction_avg, frequency, round(stability_score,6) AS stability_score, presence_flag"
oracle("a10_matrix_json", "cells", f"SELECT {_CELL} FROM cells")
oracle("h1_weights", "cells", f"SELECT {_CELL} FROM cells")
oracle("a12_belief_preview", "beliefs sents", """
SELECT belief_id AS id, belief_text, confidence, speaker, episode_id FROM (SELECT * FROM beliefs ORDER BY belief_id LIMIT 100) JOIN sents USING (utterance_id)
""")

# --- B ----------------------------------------------------------------------------

oracle("b1_accepted", "utts", "SELECT utterance_id, episode_id, speaker, timestamp_start, timestamp_end, start_s, end_s, line_no, text FROM utts")
oracle("b2_rejected", "parsed", "SELECT episode_id, line_no, error FROM parsed WHERE error IS NOT NULL")
oracle("b3_talk_time", "utts", f"""
SELECT *, {render('talk_s')} AS talk_time FROM (
 SELECT episode_id, speaker, count(*) AS utterances, sum(end_s - start_s)::bigint AS talk_s FROM utts GROUP BY 1, 2)
""")
oracle("b3_durations", "utts", "SELECT utterance_id, episode_id, speaker, start_s, end_s, end_s - start_s AS duration_s FROM utts")
oracle("b4_repaired_starts", "parsed", f"""
SELECT episode_id, line_no, (last_s + rn - last_rn)::bigint AS start_filled_s, s IS NULL AND last_s IS NOT NULL AS repaired FROM (
 SELECT *, last_value(s IGNORE NULLS) OVER w AS last_s, last_value(CASE WHEN s IS NOT NULL THEN rn END IGNORE NULLS) OVER w AS last_rn FROM (
  SELECT episode_id, line_no, CASE WHEN error IS NULL THEN {seconds('ts')} END AS s, row_number() OVER (PARTITION BY episode_id ORDER BY line_no) AS rn FROM parsed)
 WINDOW w AS (PARTITION BY episode_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
""")
oracle("b5_reference_checks", "", f"""
WITH v AS (SELECT conv_id||'-'||turn AS id, 'ep_'||lpad(conv_id::varchar,6,'0') AS name, {h16("conv_id||'-'||turn")} AS h FROM conversations)
SELECT 'reference' AS entity, id, rule FROM (
 SELECT id, 'episode_id' AS rule FROM v WHERE h%11 IN (0,1) UNION ALL SELECT id, 'audio_uri' FROM v WHERE h%13 IN (0,1,2,3)
 UNION ALL SELECT id, 'date' FROM v WHERE h%17 IN (0,1) UNION ALL SELECT id, 'path' FROM v WHERE h%19 = 0 UNION ALL SELECT id, 'score' FROM v WHERE h%120 > 100)
""")
oracle("b6_contract_violations", "parsed read", """
SELECT 'utterance' AS entity, episode_id||'-'||line_no AS id, unnest(list_filter([
  CASE WHEN trim(coalesce(speaker,'')) = '' THEN 'speaker' END,
  CASE WHEN sp IS NOT NULL OR ts IS NULL THEN 'timestamp_start' END, CASE WHEN ep IS NOT NULL OR te IS NULL THEN 'timestamp_end' END,
  CASE WHEN trim(coalesce(text,'')) = '' THEN 'text' END], lambda x: x IS NOT NULL)) AS rule FROM parsed
UNION ALL
SELECT 'belief', belief_id, unnest(list_filter([
  CASE WHEN belief_text IS NULL OR belief_text = '' THEN 'belief_text' END, CASE WHEN original_quote IS NULL OR original_quote = '' THEN 'original_quote' END,
  CASE WHEN confidence IS NULL OR confidence < 0 OR confidence > 1 THEN 'confidence' END, CASE WHEN len(true_flags) = 0 THEN 'extraction_flags' END], lambda x: x IS NOT NULL)) FROM read
""")
oracle("b6_result_contracts", "", "SELECT 0::bigint AS violations")
oracle("b6_broken_records", "", """
WITH d AS (SELECT doc_id AS id FROM documents), broken AS (
 SELECT 'episode' AS entity, unnest([CASE WHEN id%7=1 THEN 'episode_id' END, CASE WHEN id%11=2 THEN 'date' END, CASE WHEN id%13=3 THEN 'transcript_path' END,
  CASE WHEN id%17=4 THEN 'quality_score' END, CASE WHEN id%19=6 THEN 'quality_grade' END]) AS rule FROM d
 UNION ALL SELECT 'cluster', unnest([CASE WHEN id%7=1 THEN 'ontology_level' END, CASE WHEN id%11=2 THEN 'size' END, CASE WHEN id%13=3 THEN 'members' END]) FROM d
 UNION ALL SELECT 'weight', unnest([CASE WHEN id%7 IN (1,2,3) THEN 'conviction_avg' END, CASE WHEN id%11=2 THEN 'frequency' END, CASE WHEN id%13=3 THEN 'stability_score' END]) FROM d
 UNION ALL SELECT 'drift', unnest([CASE WHEN id%7=1 THEN 'drift_type' END, CASE WHEN id%11=2 THEN 'magnitude' END, CASE WHEN id%13=3 THEN 'episode_range' END]) FROM d
 UNION ALL SELECT 'contradiction', unnest([CASE WHEN id%7=1 THEN 'opposition_score' END, CASE WHEN id%11=2 THEN 'type' END,
  CASE WHEN id%13=3 AND (id%11=2 OR id%2=1) THEN 'is_reversal' END]) FROM d
 UNION ALL SELECT 'report', unnest([CASE WHEN id%7=1 THEN 'quality_score' END, CASE WHEN id%11=2 THEN 'quality_grade' END, CASE WHEN id%13=3 THEN 'errors_count' END,
  CASE WHEN id%17=4 THEN 'retries_count' END, CASE WHEN id%19=5 THEN 'malformed_beliefs_count' END, CASE WHEN id%23=6 THEN 'registry_mismatches_count' END,
  CASE WHEN id%29=7 THEN 'execution_time_seconds' END]) FROM d)
SELECT entity, rule, count(*) AS violations FROM broken WHERE rule IS NOT NULL GROUP BY 1, 2
""")
oracle("b7_orphans", "beliefs utts calls episodes", """
SELECT 'belief-line' AS edge, belief_id AS id, utterance_id AS missing FROM beliefs WHERE utterance_id NOT IN (SELECT utterance_id FROM utts)
UNION ALL SELECT 'call-episode', call_id::varchar, episode_id FROM calls WHERE episode_id NOT IN (SELECT episode_id FROM episodes)
""")
oracle("b8_repeated_ids", "forms", "SELECT 'form' AS entity, norm_hash AS id, mentions AS times FROM forms WHERE mentions > 1")
oracle("b9_audio_links", "utts", """
SELECT utterance_id, CASE WHEN episode_seq%3 <> 0 THEN 's://audio/'||episode_id||'.mp3#t='||start_s END AS audio_snippet_uri,
 CASE WHEN episode_seq%3 <> 0 THEN episode_id||'.mp3#t='||start_s||','||end_s END AS ranged_uri FROM utts
""")

# --- C, D -------------------------------------------------------------------------

oracle("c1_sentences", "sents", "SELECT utterance_id, parent_id, episode_id, line_no, sentence_no, speaker, text FROM sents")
oracle("c2_split_counts", "sents", "SELECT episode_id, count(DISTINCT parent_id) AS utterances_in, count(*) AS atomic_out FROM sents GROUP BY 1")
_filled = TEMPLATE.replace("{flags}", flag_lines(fixed.FLAGS))
_head, _rest = _filled.split("{speaker}")
_mid, _tail = _rest.split("{text}")
oracle("d1_prompts", "sents", f"SELECT utterance_id, md5({quoted(_head)}||speaker||{quoted(_mid)}||text||{quoted(_tail)}) AS prompt_md5 FROM sents")
cte("items", "sents", "SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY line_no, sentence_no) AS item_no FROM sents")
oracle("d2_batches", "items", "SELECT utterance_id, item_no, (item_no-1)//10 AS batch_no FROM items")
oracle("d3_model_calls", "sents", """
SELECT utterance_id, CASE WHEN length(text)%50 <> 0 THEN '{"n": '||length(text)||'}' END AS response,
 CASE WHEN length(text)%50 = 0 THEN 'Request timed out' END AS error, CASE WHEN length(text)%50 = 0 THEN 0 ELSE length(text) END AS tokens FROM sents
""")
oracle("d3_short_answers", "sents", """
SELECT utterance_id, CASE WHEN error IS NULL THEN '{"n": '||n||'}' END AS response, error, CASE WHEN error IS NULL THEN n ELSE 0 END AS tokens
FROM (SELECT utterance_id, length(text) AS n, CASE WHEN length(text)%50 = 0 OR length(text)%7 = 0 AND length(text)%11 <> 1 THEN 'no answer'
  WHEN length(text)%7 <> 0 AND length(text)%11 = 1 THEN 'several answers' END AS error FROM sents)
""")
oracle("d3_resumed", "answers sents", "SELECT utterance_id, md5(response||CASE WHEN speaker = 'USER' THEN ' ' ELSE '' END) AS response_md5 FROM answers JOIN sents USING (utterance_id)")
oracle("d4_beliefs", "beliefs", """
SELECT belief_id, utterance_id, ordinal, belief_text, confidence, md5(original_quote) AS quote_md5, array_to_string(true_flags,',') AS true_flags, len(flag_keys) AS n_flags FROM beliefs
""")
oracle("d5_malformed", "read", "SELECT belief_id, utterance_id, ordinal, problem FROM read WHERE problem IS NOT NULL")
oracle("d6_failures", "usable where_", "SELECT utterance_id, 'unusable response' AS message, episode_id FROM usable JOIN where_ USING (utterance_id) WHERE NOT ok")
oracle("d7_first_items", "items", "SELECT episode_id, utterance_id, item_no FROM items WHERE item_no <= 10")
oracle("d8_call_costs", "calls", """
SELECT episode_id, count(*) AS api_calls, sum(tokens)::bigint AS api_tokens, round(sum(tokens/1000.0::double*0.045::double),6) AS api_cost_usd,
 round(avg(latency),6) AS api_latency_avg, count(*) FILTER (NOT success) AS api_errors FROM calls GROUP BY 1
""")

# --- E ----------------------------------------------------------------------------

oracle("e1_one_per_belief", "beliefs sents", """
SELECT md5('canonical|'||belief_id) AS canonical_id, belief_text AS canonical_text, belief_id, utterance_id, md5(original_quote) AS quote_md5,
 episode_id AS first_seen_episode, episode_id AS last_seen_episode FROM beliefs JOIN sents USING (utterance_id)
""")
oracle("e2_alias_lookup", "old_m new_m", """
SELECT belief_id, a.canonical_id AS alias_canonical_id FROM new_m n LEFT JOIN (
 SELECT lower(belief_text) AS t, arg_max(md5('canonical|'||belief_id), (episode_seq, md5('canonical|'||belief_id))) AS canonical_id FROM old_m GROUP BY 1) a ON lower(n.belief_text) = a.t
""")
oracle("e3_alias_upsert", "mentions", """
SELECT lower(belief_text) AS alias_text, arg_max(md5('canonical|'||belief_id), (episode_seq, md5('canonical|'||belief_id))) AS canonical_id, max(episode_seq) AS seq FROM mentions GROUP BY 1
""")
oracle("e4_canonical_upsert", "mentions", """
SELECT canonical_id, belief_text AS canonical_text, belief_id, episode_seq AS seq FROM mentions
QUALIFY row_number() OVER (PARTITION BY canonical_id ORDER BY episode_seq DESC, belief_text DESC, belief_id DESC) = 1
""")
oracle("e5_history", "mentions", "SELECT canonical_id, episode_id, min(episode_seq) AS seq FROM mentions GROUP BY 1, 2")
oracle("e5_history_lists", "mentions", """
SELECT canonical_id, (rn-1)//50 AS page_no, string_agg(episode_id, ',' ORDER BY rn) AS episode_ids FROM (
 SELECT *, row_number() OVER (PARTITION BY canonical_id ORDER BY seq, episode_id) AS rn FROM (
  SELECT canonical_id, episode_id, min(episode_seq) AS seq FROM mentions GROUP BY 1, 2)) GROUP BY 1, 2
""")
oracle("e6_embedding_cache", "old_m new_m", """
SELECT DISTINCT canonical_id, CASE WHEN canonical_id IN (SELECT canonical_id FROM old_m) THEN 'cache' ELSE 'new' END AS origin, 64 AS dims FROM new_m
""")


def text_vector(words: str) -> str:
    h = "('0x'||substr(md5(w),1,4))::int"
    return f"""list_transform(range(0,64), lambda d: list_sum(list_transform({words}, lambda w:
   CASE WHEN {h} % 64 = d THEN CASE WHEN ({h} // 64) % 2 = 0 THEN 1.0::double ELSE -1.0::double END ELSE 0.0::double END)))"""


cte("form_vectors", "forms", f"""
SELECT norm_hash AS canonical_id, list_transform(v, lambda x: CASE WHEN n > 0 THEN x/n ELSE x END) AS v FROM (
 SELECT norm_hash, v, sqrt(list_sum(list_transform(v, lambda x: x*x))) AS n FROM (
  SELECT norm_hash, {text_vector("string_split(norm_text,' ')")} AS v FROM forms))
""")
oracle("e7_text_embeddings", "form_vectors", """
SELECT canonical_id, array_to_string(list_filter(list_transform(v, lambda x, i: CASE WHEN x <> 0 THEN i-1 END), lambda i: i IS NOT NULL),',') AS places,
 round(coalesce(list_sum(v),0),6) AS total FROM form_vectors
""")
oracle("e8_nearest_canonical", "", """
WITH asked AS (SELECT 'n'||vec_id AS belief_id, list_transform(embedding, lambda x, i: x::double + CASE WHEN i = 1 THEN 0.05::double ELSE 0.0::double END) AS v FROM embeddings
 UNION ALL SELECT 'r'||vec_id, list_transform(list_reverse(embedding), lambda x: x::double) FROM embeddings),
base AS (SELECT 'c'||vec_id AS canonical_id, list_transform(embedding, lambda x: x::double) AS v FROM embeddings),
best AS (SELECT belief_id, arg_max(canonical_id, s) AS canonical_id, max(s) AS s FROM (
 SELECT belief_id, canonical_id, list_cosine_similarity(asked.v, base.v) AS s FROM asked, base) WHERE s > 0.85 GROUP BY 1)
SELECT belief_id, canonical_id, canonical_id IS NULL AS is_new, round(s,6) AS similarity FROM asked LEFT JOIN best USING (belief_id)
""")
oracle("e9_normalized", "normal", "SELECT belief_id, norm_text, norm_hash FROM normal")
oracle("e10_exact_groups", "forms", "SELECT * FROM forms")
_NEG = "len(list_filter(string_split(norm_text,' '), lambda w: w IN ('not','no','never','none','cannot'))) % 2"
# levenshtein counts bytes here, so letters of two bytes are replaced by unused capitals
cte("plain", "forms", f"""
SELECT norm_hash AS id, translate(norm_text,'ßäçèéêíñóöü','ABCDEFGHIJK') AS t, length(norm_text) AS n, {_NEG} AS parity FROM forms
""")


def pairs_at(ratio: str) -> str:
    return f"""
SELECT a.id AS a, b.id AS b, 1 - levenshtein(a.t, b.t)/greatest(a.n, b.n)::double AS ratio FROM plain a JOIN plain b
 ON a.parity = b.parity AND a.id < b.id AND abs(a.n - b.n) <= floor(greatest(a.n, b.n)*(1-{ratio}::double)+1e-9)
WHERE levenshtein(a.t, b.t) <= floor(greatest(a.n, b.n)*(1-{ratio}::double)+1e-9)"""


cte("close_forms", "plain", pairs_at("0.85"))
oracle("e11_fuzzy_pairs", "close_forms", "SELECT a, b, round(ratio,6) AS ratio FROM close_forms")


def component_ctes(name: str, pairs: str, needs: str) -> None:
    """Smallest id reachable, by a keyed recursive query."""
    cte(f"{name}_e", needs, f"SELECT a AS u, b AS v FROM {pairs} UNION SELECT b, a FROM {pairs}")
    cte(f"{name}_cc", f"{name}_e", f"""{name}_cc(id, label) USING KEY (id) AS (
 SELECT DISTINCT u, u FROM {name}_e
 UNION
 SELECT e.u, min(c.label) FROM {name}_cc c JOIN {name}_e e ON e.v = c.id JOIN recurring.{name}_cc r ON r.id = e.u
 GROUP BY e.u HAVING min(c.label) < min(r.label))""")


component_ctes("fz", "close_forms", "close_forms")
cte("form_groups", "forms fz_cc", "SELECT f.*, coalesce(c.label, f.norm_hash) AS group_id FROM forms f LEFT JOIN fz_cc c ON c.id = f.norm_hash")
oracle("e12_fuzzy_groups", "form_groups", "SELECT norm_hash, group_id FROM form_groups")
oracle("e13_canonicals", "form_groups normal sents", """
WITH rep AS (SELECT group_id, arg_min(norm_hash, (-mentions, norm_text)) AS canonical_id, arg_min(spelling, (-mentions, norm_text)) AS canonical_text FROM form_groups GROUP BY 1)
SELECT canonical_id, any_value(canonical_text) AS canonical_text, count(*) AS mentions, min(episode_id) AS first_seen_episode, max(episode_id) AS last_seen_episode
FROM normal JOIN form_groups USING (norm_hash) JOIN rep USING (group_id) JOIN sents USING (utterance_id) GROUP BY 1
""")
oracle("e13_member_lists", "mentions", """
SELECT canonical_id, (rn-1)//1000 AS page_no, string_agg(belief_id, ',' ORDER BY rn) AS belief_ids, count(*) AS n_utterances, count(*) AS n_quotes FROM (
 SELECT canonical_id, belief_id, row_number() OVER (PARTITION BY canonical_id ORDER BY belief_id) AS rn FROM mentions) GROUP BY 1, 2
""")
_MERGED = "canonical_id, mentions, first_seq, first_seen_episode, last_seq, last_seen_episode"
cte("old_c", "old_m", summary_of("old_m"))
oracle("e14_incremental_merge", "canonicals old_c new_m", f"""
SELECT coalesce(o.canonical_text, n.canonical_text) AS canonical_text, {', '.join('c.' + x.strip() for x in _MERGED.split(','))}
FROM canonicals c LEFT JOIN old_c o USING (canonical_id) LEFT JOIN ({summary_of('new_m')}) n USING (canonical_id)
""")
cte("loose_forms", "plain", pairs_at("0.8"))
oracle("e15_rephrased", "forms loose_forms", """
WITH asked AS (SELECT a AS h FROM loose_forms WHERE ratio < 0.85 UNION SELECT b FROM loose_forms WHERE ratio < 0.85)
SELECT norm_hash, CASE WHEN norm_hash IN (SELECT h FROM asked) AND length(norm_text)%10 <> 0 THEN 'that '||norm_text ELSE norm_text END AS canonical_text FROM forms
""")
oracle("e17_rebuilt_registry", "canonicals", f"SELECT {_MERGED} FROM canonicals")
oracle("e17_rebuilt_from_snapshots", "canonicals", f"SELECT {_MERGED} FROM canonicals")
# nearest embedding of each later form among the earlier ones, by distinct vector
cte("mismatch", "old_m new_m form_vectors", """
SELECT n.belief_id, n.episode_id FROM new_m n
JOIN (SELECT lower(belief_text) AS t, arg_max(canonical_id, (episode_seq, canonical_id)) AS x FROM old_m GROUP BY 1) al ON al.t = lower(n.belief_text)
JOIN form_vectors fv ON fv.canonical_id = n.canonical_id
JOIN (SELECT vq, arg_min(y, (-s, y)) AS y FROM (
  SELECT q.v AS vq, b.y, round(list_inner_product(q.v, b.v), 9) AS s
  FROM (SELECT DISTINCT v FROM form_vectors WHERE canonical_id IN (SELECT canonical_id FROM new_m)) q,
       (SELECT v, min(canonical_id) AS y FROM form_vectors WHERE canonical_id IN (SELECT canonical_id FROM old_m) GROUP BY 1) b
  WHERE list_inner_product(q.v, b.v) > 0.85) GROUP BY 1) near ON near.vq = fv.v
WHERE near.y <> al.x
""")
oracle("e16_mismatches", "mismatch", "SELECT episode_id, count(*) AS mismatches FROM mismatch GROUP BY 1")

# --- F ----------------------------------------------------------------------------


def canonical_vectors(src: str) -> str:
    def d(i: int) -> str:
        return f"('0x'||substr(canonical_id,{i},4))::int"

    return f"""
SELECT c.canonical_id, list_transform(e.embedding, lambda x, i: x::double + CASE WHEN i = c.place THEN 0.05::double ELSE 0.0::double END) AS v
FROM (SELECT canonical_id, floor((SELECT max(vec_id)+1 FROM embeddings) * ({d(1)}/65536::double) * ({d(5)}/65536::double) * ({d(9)}/65536::double))::bigint AS vec_id,
  {d(13)} % 3 AS place FROM {src}) c JOIN embeddings e USING (vec_id)"""


def cluster_ctes(p: str, src: str, needs: str, distance: str) -> None:
    """Vectors, distinct vectors, pairs, components and membership, all with a prefix."""
    if f"{p}_v" not in CTES:
        cte(f"{p}_v", needs, canonical_vectors(src))
    cte(f"{p}_d", f"{p}_v", f"""SELECT v, min(canonical_id) AS id, count(*) AS copies, any_value(list_dot_product(v, v)) > 0 AS directed
 FROM {p}_v GROUP BY v, CASE WHEN list_dot_product(v, v) = 0 THEN canonical_id END""")
    cte(f"{p}_p", f"{p}_d", f"""SELECT x.id AS a, y.id AS b, x.copies AS copies_a, y.copies AS copies_b, list_cosine_similarity(x.v, y.v) AS s
 FROM (SELECT * FROM {p}_d WHERE directed) x JOIN (SELECT * FROM {p}_d WHERE directed) y ON x.id < y.id WHERE list_cosine_similarity(x.v, y.v) > 1 - {distance}::double""")
    component_ctes(p, f"{p}_p", f"{p}_p")
    cte(f"{p}_m", f"{p}_v {p}_d {p}_cc", f"""SELECT v.canonical_id, md5(coalesce(c.label, d.id)) AS cluster_id FROM {p}_v v JOIN {p}_d d ON d.v = v.v AND (directed OR d.id = v.canonical_id) LEFT JOIN {p}_cc c ON c.id = d.id""")


def centroid_cte(name: str, membership: str, vectors: str, needs: str) -> None:
    cte(name, needs, f"""
SELECT cluster_id, list(m ORDER BY i) AS v FROM (SELECT cluster_id, i, avg(x) AS m FROM (
 SELECT cluster_id, unnest(u) AS x, generate_subscripts(u,1) AS i FROM (
  SELECT cluster_id, list_transform(v, lambda x: x / n) AS u FROM (SELECT m.cluster_id, v, sqrt(list_inner_product(v,v)) AS n FROM {membership} m JOIN {vectors} USING (canonical_id)))) GROUP BY 1, 2) GROUP BY 1""")


cluster_ctes("cl", "canonicals", "canonicals", "0.3")
centroid_cte("cl_c", "cl_m", "cl_v", "cl_m cl_v")
oracle("f1_close_pairs", "cl_p", "SELECT a, b, copies_a, copies_b, round(1 - s, 6) AS distance FROM cl_p")
oracle("f1_members", "cl_v", "SELECT min(canonical_id) OVER (PARTITION BY v) AS vector_id, canonical_id AS member_id FROM cl_v")
oracle("f1_given_vectors", "", """
WITH v AS (SELECT lpad(vec_id::varchar,8,'0') AS id, list_transform(embedding, lambda x: x::double) AS v FROM embeddings
 UNION ALL SELECT lpad((vec_id+1000000)::varchar,8,'0'), list_transform(embedding, lambda x, i: x::double + CASE WHEN i = 1 THEN 0.05::double ELSE 0.0::double END) FROM embeddings WHERE vec_id%5 = 0
 UNION ALL SELECT lpad((vec_id+2000000)::varchar,8,'0'), list_transform(embedding, lambda x, i: x::double + CASE WHEN i = 2 THEN 0.05::double ELSE 0.0::double END) FROM embeddings WHERE vec_id%10 = 0)
SELECT a.id AS a, b.id AS b, round(list_cosine_similarity(a.v, b.v), 6) AS similarity FROM v a JOIN v b ON a.id < b.id WHERE list_cosine_similarity(a.v, b.v) > 0.85
""")
oracle("f3_linked_clusters", "cl_m", "SELECT canonical_id, cluster_id FROM cl_m")
cte("cl_sized", "cl_m", "SELECT *, count(*) OVER (PARTITION BY cluster_id) AS size FROM cl_m")
oracle("f4_outliers", "cl_sized", "SELECT canonical_id, CASE WHEN size >= 3 THEN cluster_id END AS cluster_id, size < 3 AS is_outlier FROM cl_sized")
cte("fine_v", "cl_v", "SELECT * FROM cl_v")
cluster_ctes("fine", "canonicals", "canonicals", "0.0005")
cte("fine_sized", "fine_m", "SELECT *, count(*) OVER (PARTITION BY cluster_id) AS size FROM fine_m")
cte("fine_large", "fine_sized", "SELECT canonical_id, cluster_id FROM fine_sized WHERE size >= 3")
centroid_cte("fine_c", "fine_large", "fine_v", "fine_large fine_v")
oracle("f4_merged", "fine_large fine_c fine_sized fine_v", """
SELECT canonical_id, cluster_id, false AS merged, false AS is_outlier FROM fine_large
UNION ALL
SELECT s.canonical_id, n.cluster_id, n.cluster_id IS NOT NULL, n.cluster_id IS NULL FROM fine_sized s LEFT JOIN (
 SELECT canonical_id, arg_min(cluster_id, (-s, cluster_id)) AS cluster_id FROM (
  SELECT x.canonical_id, c.cluster_id, round(list_cosine_similarity(v.v, c.v), 9) AS s FROM fine_sized x JOIN fine_v v USING (canonical_id), fine_c c WHERE x.size < 3)
 WHERE s > 0.7 GROUP BY 1) n USING (canonical_id) WHERE s.size < 3
""")
oracle("f5_clusters", "cl_m canonicals", """
SELECT cluster_id, count(*) AS size, sum(mentions)::bigint AS mentions, min(first_seen_episode) AS created_episode, max(last_seen_episode) AS last_updated_episode
FROM cl_m JOIN canonicals USING (canonical_id) GROUP BY 1
""")
oracle("f5_centroids", "cl_c", "SELECT cluster_id, generate_subscripts(v,1)-1 AS place, round(unnest(v),6) AS x FROM cl_c")
oracle("f5_member_lists", "cl_m mentions", """
SELECT cluster_id, (rn-1)//1000 AS page_no, md5(string_agg(utterance_id, ',' ORDER BY rn)) AS utterances_md5, count(*) AS n_members FROM (
 SELECT cluster_id, utterance_id, row_number() OVER (PARTITION BY cluster_id ORDER BY belief_id) AS rn FROM cl_m JOIN mentions USING (canonical_id)) GROUP BY 1, 2
""")
oracle("f6_names", "cl_m cl_v cl_c canonicals", """
SELECT m.cluster_id, arg_min(canonical_text, (-round(list_cosine_similarity(v.v, c.v), 9), m.canonical_id)) AS name
FROM cl_m m JOIN cl_v v USING (canonical_id) JOIN cl_c c USING (cluster_id) JOIN canonicals USING (canonical_id) GROUP BY 1
""")
cte("early", "canonicals middle", "SELECT canonicals.* FROM canonicals, middle WHERE first_seq <= m")
cte("late", "canonicals middle", "SELECT canonicals.* FROM canonicals, middle WHERE first_seq > m")
cluster_ctes("ea", "early", "early", "0.3")
centroid_cte("ea_c", "ea_m", "ea_v", "ea_m ea_v")
cte("late_v", "late", canonical_vectors("late"))
cte("assigned", "late_v ea_c", """
SELECT canonical_id, arg_min(cluster_id, (-round(s,9), cluster_id)) AS cluster_id, max(s) AS s FROM (
 SELECT l.v, cluster_id, list_cosine_similarity(l.v, c.v) AS s FROM (SELECT DISTINCT v FROM late_v) l, ea_c c WHERE list_cosine_similarity(l.v, c.v) > 0.7)
 x JOIN late_v USING (v) GROUP BY 1
""")
oracle("f2_assigned", "assigned", "SELECT canonical_id, cluster_id, round(1 - s, 6) AS distance FROM assigned")
cte("left_v", "late_v assigned", "SELECT * FROM late_v WHERE canonical_id NOT IN (SELECT canonical_id FROM assigned)")
cluster_ctes("left", "left_v", "left_v", "0.3")
oracle("f7_incremental", "ea_m assigned left_m", """
SELECT canonical_id, cluster_id, 'kept' AS origin FROM ea_m UNION ALL SELECT canonical_id, cluster_id, 'assigned' FROM assigned UNION ALL SELECT canonical_id, cluster_id, 'formed' FROM left_m
""")
oracle("f8_facts", "cl_v", "SELECT count(*) AS members, count(DISTINCT canonical_id) AS ids, true AS few_leaves, true AS none_empty FROM cl_v")
oracle("f9_metrics", "cl_m", """
SELECT count(*) FILTER (n >= 3) AS clusters_total, round(avg(n) FILTER (n >= 3),6) AS avg_cluster_size, count(*) FILTER (n < 3) AS micro_clusters_filtered
FROM (SELECT cluster_id, count(*) AS n FROM cl_m GROUP BY 1)
""")

# --- G ----------------------------------------------------------------------------

cte("flag_counts", "cl_m mentions", "SELECT cluster_id, flag, count(*) AS n FROM (SELECT cluster_id, unnest(true_flags) AS flag FROM cl_m JOIN mentions USING (canonical_id)) GROUP BY 1, 2")
oracle("g1_flag_counts", "flag_counts", "SELECT * FROM flag_counts")


def tiers_of(rules: dict[str, list[str]], counts: str) -> str:
    order = list(rules)
    cases = " ".join(f"WHEN flag = {quoted(f)} THEN {order.index(t)}" for t, fs in rules.items() for f in fs)
    names = "[" + ", ".join(quoted(t) for t in order) + "]"
    return f"""
SELECT cluster_id, coalesce(ord, {len(order) - 1})::int AS tier_ord, {names}[(coalesce(ord, {len(order) - 1})+1)::int] AS ontology_level, coalesce(votes, 0)::bigint AS votes, votes IS NULL AS is_default
FROM (SELECT DISTINCT cluster_id FROM cl_m) LEFT JOIN (
 SELECT cluster_id, arg_min(ord, (-n, ord)) AS ord, sum(n) AS votes FROM (
  SELECT cluster_id, ord, sum(n) AS n FROM (SELECT *, CASE {cases} END AS ord FROM {counts}) WHERE ord IS NOT NULL GROUP BY 1, 2) GROUP BY 1) USING (cluster_id)"""


cte("tiers", "cl_m flag_counts", tiers_of(fixed.TIERS, "flag_counts"))
oracle("g2_tiers", "tiers", "SELECT cluster_id, ontology_level, votes, is_default FROM tiers")
cte("own_tiers", "cl_m flag_counts", tiers_of(
    {"stated": ["q23_surface_opinion", "q24_factual_claim"], "deep": ["q16_first_principles", "q18_moral_framework"]}, "flag_counts"))
cte("six_tiers", "cl_m flag_counts", tiers_of(
    {f"t{i}": list(fixed.FLAGS)[k : k + 2] for i, k in enumerate(range(0, 11, 2))}, "flag_counts"))
oracle("g2_custom_flags", "own_tiers", "SELECT cluster_id, ontology_level, votes, is_default FROM own_tiers")
oracle("g3_tier_distribution", "tiers", "SELECT ontology_level, count(*) AS clusters FROM tiers GROUP BY 1")
cte("nodes", "tiers cl_c", """
SELECT t.*, p.parent AS parent_cluster_id, p.s AS parent_similarity FROM tiers t LEFT JOIN (
 SELECT cluster_id, arg_min(parent, (-round(s,9), parent)) AS parent, max(s) AS s FROM (
  SELECT x.cluster_id, y.cluster_id AS parent, list_cosine_similarity(cx.v, cy.v) AS s
  FROM (SELECT *, (SELECT max(t2.tier_ord) FROM tiers t2 WHERE t2.tier_ord < t1.tier_ord) AS target FROM tiers t1) x
  JOIN tiers y ON y.tier_ord = x.target JOIN cl_c cx ON cx.cluster_id = x.cluster_id JOIN cl_c cy ON cy.cluster_id = y.cluster_id)
 WHERE round(s,9) >= 0.35 AND NOT isnan(s) GROUP BY 1) p USING (cluster_id)
""")
cte("six_nodes", "six_tiers cl_c", CTES["nodes"][1].replace("tiers", "six_tiers"))
cte("six_tree", "six_nodes", """six_tree(cluster_id, ontology_level, parent_cluster_id, depth, path) AS (
 SELECT cluster_id, ontology_level, parent_cluster_id, 0, cluster_id FROM six_nodes WHERE parent_cluster_id IS NULL
 UNION ALL SELECT n.cluster_id, n.ontology_level, n.parent_cluster_id, t.depth+1, t.path||'/'||n.cluster_id FROM six_nodes n JOIN six_tree t ON n.parent_cluster_id = t.cluster_id)""")
oracle("g5_custom_tree", "six_tree", """
SELECT t.cluster_id, t.ontology_level, t.parent_cluster_id, t.depth, t.path, (SELECT count(*) FROM six_tree c WHERE c.parent_cluster_id = t.cluster_id) AS children FROM six_tree t
""")
oracle("g4_parents", "nodes", "SELECT cluster_id, ontology_level, parent_cluster_id, round(parent_similarity,6) AS parent_similarity FROM nodes")
cte("tree", "nodes", """tree(cluster_id, ontology_level, parent_cluster_id, depth, path) AS (
 SELECT cluster_id, ontology_level, parent_cluster_id, 0, cluster_id FROM nodes WHERE parent_cluster_id IS NULL
 UNION ALL SELECT n.cluster_id, n.ontology_level, n.parent_cluster_id, t.depth+1, t.path||'/'||n.cluster_id FROM nodes n JOIN tree t ON n.parent_cluster_id = t.cluster_id)""")
oracle("g5_tree", "tree", """
SELECT t.cluster_id, t.ontology_level, t.parent_cluster_id, t.depth, t.path, (SELECT count(*) FROM tree c WHERE c.parent_cluster_id = t.cluster_id) AS children FROM tree t
""")
oracle("g6_trace", "cl_m mentions", "SELECT cluster_id, canonical_id, belief_id, utterance_id, episode_id, speaker FROM cl_m JOIN mentions USING (canonical_id)")
cte("sources", "tree cl_m mentions", """
SELECT DISTINCT node_id, utterance_id FROM (SELECT cluster_id, unnest(string_split(path,'/')) AS node_id FROM tree) JOIN cl_m USING (cluster_id) JOIN mentions USING (canonical_id)
""")
oracle("g6_node_sources", "sources", "SELECT node_id, count(*) AS sources, min(utterance_id) AS first_utterance FROM sources GROUP BY 1")
oracle("g7_default_tiers", "cl_m mentions", """
SELECT count(DISTINCT cluster_id) - count(DISTINCT cluster_id) FILTER (
  list_has_any(true_flags, ['q23_surface_opinion','q24_factual_claim','q16_first_principles','q18_moral_framework'])) AS default_tier_assignments
FROM cl_m JOIN mentions USING (canonical_id)
""")
oracle("a11_ontology_report", "sources tree", """
SELECT node_id, ontology_level, depth, page_no, count(*) AS sources FROM (
 SELECT node_id, (row_number() OVER (PARTITION BY node_id ORDER BY utterance_id)-1)//1000 AS page_no FROM sources) JOIN tree ON node_id = cluster_id GROUP BY 1, 2, 3, 4
""")

# --- H ----------------------------------------------------------------------------

oracle("h2_dense_matrix", "episodes cells", """
SELECT e.episode_id, count(*) AS cells, count(*) FILTER (c.frequency IS NULL) AS absent, coalesce(sum(c.frequency),0)::bigint AS mentions, round(coalesce(sum(c.conviction_avg),0),6) AS conviction
FROM episodes e CROSS JOIN (SELECT DISTINCT canonical_id FROM cells) b LEFT JOIN cells c ON c.episode_id = e.episode_id AND c.canonical_id = b.canonical_id GROUP BY 1
""")
oracle("h3_cell_lookup", "cells", """
SELECT 'ep_'||lpad((a.episode_seq+1)::varchar,6,'0') AS episode_id, a.canonical_id, round(b.conviction_avg,6) AS conviction_avg, b.frequency, round(b.stability_score,6) AS stability_score, b.presence_flag
FROM cells a LEFT JOIN cells b ON b.canonical_id = a.canonical_id AND b.episode_seq = a.episode_seq+1
""")
oracle("h4_cell_upsert", "cells", """
SELECT episode_id, canonical_id, CASE WHEN frequency = 1 THEN 0.5 ELSE round(conviction_avg,6) END AS conviction_avg, frequency, CASE WHEN frequency = 1 THEN 2 ELSE 1 END AS seq FROM cells
""")
oracle("h5_dimensions", "cells episodes", """
SELECT e AS n_episodes, b AS n_beliefs, e||'x'||b AS dimensions FROM (SELECT count(*) AS e FROM episodes), (SELECT count(DISTINCT canonical_id) AS b FROM cells)
""")

# --- J ----------------------------------------------------------------------------

cte("sets", "canonicals", f"""
SELECT canonical_id, {_NEG} AS parity, list_distinct(list_filter(string_split(norm_text,' '), lambda w: w NOT IN ('not','no','never','none','cannot') AND w <> '')) AS words FROM canonicals
""")
cte("opposed", "sets", """
SELECT least(x, y) AS a, greatest(x, y) AS b, round(i/(nx + ny - i)::double, 9) AS score FROM (
 SELECT p.canonical_id AS x, q.canonical_id AS y, p.n AS nx, q.n AS ny, count(*) AS i
 FROM (SELECT canonical_id, len(words) AS n, unnest(words) AS w FROM sets WHERE parity = 0) p JOIN (SELECT canonical_id, len(words) AS n, unnest(words) AS w FROM sets WHERE parity = 1) q ON p.w = q.w
 GROUP BY 1, 2, 3, 4) WHERE i/(nx + ny - i)::double >= 0.5
""")
oracle("j1_j2_candidates", "opposed", "SELECT a, b, round(score,6) AS score FROM opposed")
oracle("j3_certain_pairs", "opposed", "SELECT a, b, round(score,6) AS score FROM opposed WHERE score >= 0.7")
cte("found", "opposed mentions", """
SELECT md5(concat_ws('|', a, b, spk_a, spk_b)) AS contradiction_id, a AS belief_a_id, b AS belief_b_id, score AS opposition_score,
 CASE WHEN spk_a = spk_b THEN 'within_speaker' ELSE 'cross_speaker' END AS type, spk_a = spk_b AND differ AS is_reversal, spk_a AS speaker_a, spk_b AS speaker_b,
 CASE WHEN fa <> fb THEN greatest(fa, fb) ELSE greatest(la, lb) END AS later_seq
FROM (SELECT o.a, o.b, o.score, x.speaker AS spk_a, y.speaker AS spk_b, bool_or(x.episode_seq <> y.episode_seq) AS differ,
  min(x.episode_seq) AS fa, max(x.episode_seq) AS la, min(y.episode_seq) AS fb, max(y.episode_seq) AS lb
 FROM opposed o JOIN mentions x ON x.canonical_id = o.a JOIN mentions y ON y.canonical_id = o.b WHERE o.score >= 0.7 GROUP BY 1, 2, 3, 4, 5)
""")
oracle("j4_j5_contradictions", "found", "SELECT * REPLACE (round(opposition_score,6) AS opposition_score) FROM found")
oracle("j4_pair_counts", "found", """
SELECT belief_a_id, belief_b_id, round(any_value(opposition_score),6) AS opposition_score, count(DISTINCT speaker_a) AS speakers_a, count(DISTINCT speaker_b) AS speakers_b,
 count(*) FILTER (type = 'within_speaker') AS within_speaker, count(*) FILTER (type = 'cross_speaker') AS cross_speaker, count(*) FILTER (is_reversal) AS reversals
FROM found GROUP BY 1, 2
""")
cte("held", "found mentions", """
SELECT contradiction_id, episode_id FROM found JOIN mentions ON canonical_id = belief_a_id AND speaker = speaker_a
UNION SELECT contradiction_id, episode_id FROM found JOIN mentions ON canonical_id = belief_b_id AND speaker = speaker_b
""")
cte("held_pages", "held", """
SELECT contradiction_id, (rn-1)//1000 AS page_no, string_agg(episode_id, ',' ORDER BY episode_id) AS episode_ids FROM (
 SELECT *, row_number() OVER (PARTITION BY contradiction_id ORDER BY substr(md5(episode_id),1,4)||episode_id) AS rn FROM held) GROUP BY 1, 2
""")
oracle("j4_episode_lists", "held_pages", "SELECT * FROM held_pages")
oracle("a11_contradiction_report", "held_pages found", "SELECT contradiction_id, type, page_no, episode_ids FROM held_pages JOIN found USING (contradiction_id)")
oracle("a12_contradiction_preview", "found canonicals", """
SELECT contradiction_id, x.canonical_text AS belief_a, y.canonical_text AS belief_b, opposition_score, type, is_reversal
FROM (SELECT * FROM found ORDER BY contradiction_id LIMIT 50) JOIN canonicals x ON x.canonical_id = belief_a_id JOIN canonicals y ON y.canonical_id = belief_b_id
""")
oracle("j6_verified", "opposed", "SELECT a, b, round(score,6) AS score FROM opposed WHERE score >= 0.7 OR substr(a,1,1) < '8'")
oracle("j7_counts_by_type", "found", "SELECT type, count(*) AS contradictions, count(*) FILTER (is_reversal) AS reversals FROM found GROUP BY 1")
oracle("j7_counts_by_speakers", "found", """
SELECT least(speaker_a, speaker_b) AS speaker_1, greatest(speaker_a, speaker_b) AS speaker_2, count(*) AS contradictions FROM found GROUP BY 1, 2
""")
oracle("j7_counts_by_episode", "held", "SELECT episode_id, count(*) AS contradictions FROM held GROUP BY 1")
oracle("j8_speaker_comparison", "mentions", """
WITH s AS (SELECT DISTINCT speaker, canonical_id FROM mentions), n AS (SELECT DISTINCT speaker FROM s)
SELECT * FROM (
SELECT x.speaker AS speaker_1, y.speaker AS speaker_2,
 (SELECT count(*) FROM s a JOIN s b USING (canonical_id) WHERE a.speaker = x.speaker AND b.speaker = y.speaker) AS shared,
 (SELECT count(*) FROM s a WHERE a.speaker = x.speaker AND a.canonical_id NOT IN (SELECT canonical_id FROM s b WHERE b.speaker = y.speaker)) AS only_1,
 (SELECT count(*) FROM s a WHERE a.speaker = y.speaker AND a.canonical_id NOT IN (SELECT canonical_id FROM s b WHERE b.speaker = x.speaker)) AS only_2
FROM n x JOIN n y ON x.speaker < y.speaker) WHERE shared > 0
""")
oracle("j8_speaker_claims", "mentions", "SELECT speaker, count(DISTINCT canonical_id) AS claims FROM mentions GROUP BY 1")
oracle("j8_shared_and_own", "mentions", """
WITH s AS (SELECT DISTINCT speaker, canonical_id FROM mentions)
SELECT canonical_id, CASE WHEN canonical_id IN (SELECT canonical_id FROM s WHERE speaker = 'ASSISTANT') THEN 'both' ELSE 'USER' END AS held_by FROM s WHERE speaker = 'USER'
""")

# --- I ----------------------------------------------------------------------------

cte("steps", "cells", """
SELECT *, round(conviction_avg - pc, 9) AS dc, frequency - pf AS df FROM (
 SELECT *, lag(episode_id) OVER w AS pe, lag(conviction_avg) OVER w AS pc, lag(frequency) OVER w AS pf, lead(episode_seq) OVER w AS ns
 FROM cells WINDOW w AS (PARTITION BY canonical_id ORDER BY episode_seq))
""")
cte("moved", "steps", """
SELECT *, CASE WHEN pe IS NULL THEN 'new' WHEN abs(dc) >= 0.15 THEN CASE WHEN dc > 0 THEN 'strengthening' ELSE 'weakening' END
  WHEN abs(df) >= 2 THEN CASE WHEN df > 0 THEN 'strengthening' ELSE 'weakening' END END AS kind,
 least(1.0::double, CASE WHEN pe IS NULL THEN conviction_avg WHEN abs(dc) >= 0.15 THEN abs(dc) ELSE abs(df)/greatest(frequency, pf)::double END) AS size FROM steps
""")
cte("gone", "steps episodes", """
SELECT canonical_id, 'dropped' AS drift_type, least(1.0::double, conviction_avg) AS magnitude, s.episode_id AS se, e.episode_id AS ee, s.episode_seq+1 AS event_seq,
 conviction_avg AS conviction_before, NULL::double AS conviction_after, frequency AS frequency_before, NULL::bigint AS frequency_after
FROM steps s JOIN episodes e ON e.episode_seq = s.episode_seq+1 WHERE ns IS NULL OR ns <> s.episode_seq+1
""")
_MOVED = """SELECT canonical_id, {kind} AS drift_type, {size} AS magnitude, coalesce(pe, episode_id) AS se, episode_id AS ee, episode_seq AS event_seq, pc AS conviction_before,
 conviction_avg AS conviction_after, pf AS frequency_before, frequency AS frequency_after FROM {src} WHERE kind IS NOT NULL UNION ALL SELECT * FROM gone"""
cte("plain_drift", "moved gone", _MOVED.format(kind="kind", size="size", src="moved"))
cte("turned", "moved found", """
SELECT m.*, t.sc FROM moved m LEFT JOIN (SELECT id, later_seq, max(opposition_score) AS sc FROM (
 SELECT belief_a_id AS id, later_seq, opposition_score FROM found WHERE is_reversal UNION ALL SELECT belief_b_id, later_seq, opposition_score FROM found WHERE is_reversal) GROUP BY 1, 2) t
ON t.id = m.canonical_id AND t.later_seq = m.episode_seq
""")
cte("drift", "turned gone", _MOVED.format(
    kind="CASE WHEN sc IS NOT NULL AND kind <> 'new' THEN 'reversal' ELSE kind END",
    size="CASE WHEN sc IS NOT NULL AND kind <> 'new' THEN least(1.0::double, sc) ELSE size END", src="turned"))


def drift_rows(src: str, kind: str | None = None) -> str:
    where = f" WHERE drift_type = '{kind}'" if kind else ""
    return f"""SELECT md5(concat_ws('|', canonical_id, ee, drift_type)) AS drift_id, canonical_id, drift_type, round(magnitude,6) AS magnitude, se||'>'||ee AS episode_range,
 round(conviction_before,6) AS conviction_before, round(conviction_after,6) AS conviction_after, frequency_before, frequency_after FROM {src}{where}"""


oracle("i1_new", "plain_drift", drift_rows("plain_drift", "new"))
oracle("i2_dropped", "plain_drift", drift_rows("plain_drift", "dropped"))
oracle("i3_strengthening", "plain_drift", drift_rows("plain_drift", "strengthening"))
oracle("i4_weakening", "plain_drift", drift_rows("plain_drift", "weakening"))
oracle("i5_reversals", "drift", drift_rows("drift", "reversal"))
oracle("i6_all_drift", "drift", drift_rows("drift"))
oracle("i7_drift_counts", "drift", "SELECT drift_type, count(*) AS events FROM drift GROUP BY 1")
oracle("i7_timeline", "plain_drift", """
SELECT canonical_id, (rn-1)//1000 AS page_no, string_agg(event_seq||':'||drift_type, ',' ORDER BY rn) AS events FROM (
 SELECT *, row_number() OVER (PARTITION BY canonical_id ORDER BY event_seq, drift_type) AS rn FROM plain_drift) GROUP BY 1, 2
""")

oracle("a11_timeline_report", "plain_drift", """
SELECT canonical_id, (rn-1)//1000 AS page_no, string_agg(event_seq||':'||drift_type, ',' ORDER BY rn) AS events FROM (
 SELECT *, row_number() OVER (PARTITION BY canonical_id ORDER BY event_seq, drift_type) AS rn FROM plain_drift) GROUP BY 1, 2
""")
oracle("b7_broken_links", "mentions old_m opposed plain_drift sents", """
SELECT 'canonical-utterance' AS edge, belief_id AS id, utterance_id AS missing FROM mentions WHERE utterance_id NOT IN (SELECT utterance_id FROM old_m)
UNION ALL SELECT 'canonical-belief', canonical_id, belief_id FROM mentions WHERE belief_id NOT IN (SELECT belief_id FROM old_m)
UNION ALL SELECT DISTINCT 'canonical-cluster', canonical_id, substr(canonical_id, 1, 4) FROM mentions WHERE substr(canonical_id, 1, 4) NOT IN (SELECT substr(canonical_id, 1, 4) FROM old_m)
UNION ALL SELECT DISTINCT 'cluster-canonical', substr(canonical_id, 1, 4), canonical_id FROM mentions WHERE canonical_id NOT IN (SELECT canonical_id FROM old_m)
UNION ALL SELECT 'contradiction-a', a||'-'||b, a FROM opposed WHERE score >= 0.7 AND a NOT IN (SELECT canonical_id FROM old_m)
UNION ALL SELECT 'contradiction-b', a||'-'||b, b FROM opposed WHERE score >= 0.7 AND b NOT IN (SELECT canonical_id FROM old_m)
UNION ALL SELECT 'drift-canonical', md5(concat_ws('|', canonical_id, ee, drift_type)), canonical_id FROM plain_drift WHERE canonical_id NOT IN (SELECT canonical_id FROM old_m)
UNION ALL SELECT 'utterance-episode', utterance_id, episode_id FROM sents WHERE episode_id NOT IN (SELECT episode_id FROM old_m)
""")

# --- K ----------------------------------------------------------------------------

cte("all_events", "call_events mismatch", "SELECT episode_id, kind FROM call_events UNION ALL SELECT episode_id, 'mismatch' FROM mismatch")
oracle("k1_counters", "episodes all_events", counters_of("all_events"))
oracle("k1_messages", "call_events", f"SELECT episode_id, kind, 0 AS page_no, messages FROM ({messages_of('call_events')})")
cte("all_counts", "episodes all_events", counters_of("all_events"))
cte("all_scores", "all_counts", scored("all_counts"))
oracle("k2_k3_scores", "all_scores", "SELECT episode_id, quality_score, quality_grade FROM all_scores")
oracle("k4_reports", "all_scores call_events run_times", f"""
SELECT s.episode_id, quality_score, quality_grade, errors_count, retries_count, malformed_beliefs_count, registry_mismatches_count,
 coalesce(execution_time_seconds, 0.0) AS execution_time_seconds, '2024-01-01 00:00:00' AS timestamp, 0 AS page_no,
 coalesce(p.messages, '') AS parsing_errors, coalesce(a.messages, '') AS api_errors, '' AS warnings
FROM all_scores s LEFT JOIN run_times USING (episode_id)
LEFT JOIN (SELECT * FROM ({messages_of('call_events')}) WHERE kind = 'parsing_error') p ON p.episode_id = s.episode_id
LEFT JOIN (SELECT * FROM ({messages_of('call_events')}) WHERE kind = 'api_error') a ON a.episode_id = s.episode_id
""")
oracle("k5_summary", "all_scores manifest", """
SELECT count(*) AS total_episodes, round(avg(quality_score),6) AS average_score, sum(errors_count)::bigint AS total_errors, sum(retries_count)::bigint AS total_retries,
 count(*) FILTER (quality_grade = 'A') AS grade_a, count(*) FILTER (quality_grade = 'B') AS grade_b, count(*) FILTER (quality_grade = 'C') AS grade_c,
 count(*) FILTER (quality_grade = 'D') AS grade_d, count(*) FILTER (quality_grade = 'F') AS grade_f
FROM all_scores WHERE episode_id IN (SELECT episode_id FROM manifest WHERE phase = 'canonical_beliefs') HAVING count(*) > 0
""")
oracle("k6_phase_rates", "manifest", """
SELECT episode_id, phase, (ord+1)::int AS phase_ord, row_count, round(d,6) AS duration_s, round(CASE WHEN d > 0 THEN row_count*60/d END,6) AS rows_per_minute FROM (
 SELECT *, epoch(ts) - epoch(lag(ts) OVER (PARTITION BY episode_id ORDER BY ord)) AS d FROM manifest)
""")
oracle("k7_progress_rows", "mentions", """
SELECT episode_id, belief_id, event_no FROM (SELECT episode_id, belief_id, row_number() OVER (PARTITION BY episode_id ORDER BY line_no, sentence_no, ordinal) AS event_no FROM mentions) WHERE event_no%10 = 0
""")
oracle("k8_graded_episodes", "all_scores", "SELECT episode_id, episode_id AS title, quality_score, quality_grade FROM all_scores")
oracle("k9_line_counts", "lines parsed", """
SELECT episode_id, max(line_no) AS lines_read, count(*) FILTER (error IS NULL) AS lines_accepted, count(*) FILTER (error IS NOT NULL) AS lines_rejected FROM parsed GROUP BY 1
""")

# --- L, M -------------------------------------------------------------------------

oracle("l1_causes", "tried", "SELECT episode_id, cause, count(*) AS failures FROM tried WHERE cause IS NOT NULL GROUP BY 1, 2")
oracle("l1_retries", "calls", "SELECT episode_id, count(*) FILTER (attempt > 1) AS retries FROM calls GROUP BY 1")
oracle("l2_attempts", "tried", "SELECT call_id, item_id, attempt, cause, wait_s, exhausted, given_up FROM tried")
oracle("l2_waits", "tried", "SELECT episode_id, sum(wait_s) AS wait_s, count(*) FILTER (exhausted) AS items_exhausted FROM tried GROUP BY 1")


def audit(tokens: str) -> str:
    return f"""
SELECT *, prior_requests >= 2 AS over_requests, tokens > 0 AND prior_tokens + tokens > 3000 AS over_tokens FROM (
 SELECT a.call_id, a.ts, any_value(a.tok) AS tokens, count(b.call_id) AS prior_requests, coalesce(sum(b.tok),0)::bigint AS prior_tokens, min(b.ts) AS first_ts, min(b.ts) FILTER (b.tok > 0) AS first_tok
 FROM (SELECT *, {tokens} AS tok FROM calls) a LEFT JOIN (SELECT *, {tokens} AS tok FROM calls) b
  ON b.caller = a.caller AND b.ts >= a.ts - INTERVAL 6 HOUR AND (b.ts < a.ts OR (b.ts = a.ts AND b.call_id < a.call_id)) GROUP BY 1, 2)"""


cte("audited", "calls", audit("tokens"))
oracle("l3_budget_audit", "audited", """
SELECT call_id, prior_requests, prior_tokens, over_requests, over_tokens, round(greatest(
 CASE WHEN over_requests THEN 21600 - epoch(ts - first_ts) + 0.1::double ELSE 0 END,
 CASE WHEN over_tokens THEN 21600 - epoch(ts - coalesce(first_tok, ts)) + 0.1::double ELSE 0 END), 6) AS wait_s FROM audited
""")
cte("estimated", "calls", audit("ceil(latency*1000)::bigint"))
oracle("l3_estimated_tokens", "estimated", "SELECT call_id, tokens, prior_tokens, over_tokens FROM estimated")


def minutes_of(src: str, where: str = "") -> str:
    return f"""
SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS minute, count(*) AS api_calls, sum(tokens)::bigint AS api_tokens, round(avg(latency),6) AS api_latency_avg,
 count(*) FILTER (NOT success) AS api_errors, count(*) FILTER (attempt > 1) AS api_retries FROM {src} {where} GROUP BY 1"""


oracle("l4_per_minute", "calls", minutes_of("calls"))
cte("simple", "", """
SELECT event_id AS call_id, user_id AS caller, ts, floor(value*10)::bigint AS tokens, value/100 AS latency, event_type <> 'error' AS success,
 CASE WHEN event_type = 'error' THEN event_id%4+1 ELSE 1 END AS attempt FROM events
""")
oracle("m1_streamed_utterances", "utts", "SELECT episode_id, line_no, speaker, start_s, end_s, md5(text) AS text_md5 FROM utts")
oracle("m2_streamed_registry", "canonicals", f"SELECT {_MERGED} FROM canonicals")
oracle("m2_second_stream", "canonicals", f"SELECT {_MERGED} FROM canonicals")
oracle("m3_streamed_minutes", "simple", minutes_of(
    "simple", "WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM simple) - INTERVAL 2 MINUTE"))
oracle("m4_streamed_alarm", "audited", "SELECT call_id, prior_requests, prior_tokens, over_requests, over_tokens FROM audited WHERE over_requests OR over_tokens")

# the whole path on text embeddings, which compares all pairs of texts
cte("tx_v", "form_vectors", "SELECT canonical_id, v FROM form_vectors")
cluster_ctes("tx", "canonicals", "form_vectors", "0.3")
centroid_cte("tx_c", "tx_m", "tx_v", "tx_m tx_v")
cte("tx_flags", "tx_m mentions", CTES["flag_counts"][1].replace("cl_m", "tx_m"))
cte("tx_tiers", "tx_m tx_flags", tiers_of(fixed.TIERS, "tx_flags").replace("cl_m", "tx_m"))
cte("tx_nodes", "tx_tiers tx_c", CTES["nodes"][1].replace("tiers", "tx_tiers").replace("cl_c", "tx_c").replace("0.35", "0.5"))
cte("tx_tree", "tx_nodes", CTES["tree"][1].replace("tree", "tx_tree").replace("nodes", "tx_nodes"))
oracle("g5_whole_path", "tx_tree", """
SELECT t.cluster_id, t.ontology_level, t.parent_cluster_id, t.depth, t.path, (SELECT count(*) FROM tx_tree c WHERE c.parent_cluster_id = t.cluster_id) AS children FROM tx_tree t
""")
