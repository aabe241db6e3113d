"""The same results in plain SQL over the same tables."""

from __future__ import annotations

from millrace.functions.languages import LANGUAGE_NAMES
from millrace.plans.tables import LIST_SIZE
from millrace.sources.retweet_log import LOG_HEADER

ORACLE_SQL: dict[str, str] = {}

NAMES = "names(iso_code, iso_name) AS (VALUES " + ", ".join(
    f"('{code}', '{name}')" for code, name in LANGUAGE_NAMES.items()
) + ")"

# Page views ---------------------------------------------------------------

PAGEVIEWS = """views AS (
  SELECT lang || '.' || source AS project,
         CASE WHEN doc_id % 50 = 0 THEN lang ELSE 'd' || doc_id END AS title,
         n_chars AS views, doc_id AS size
  FROM documents)"""

ORACLE_SQL["scan_pagecounts"] = f"WITH {PAGEVIEWS} SELECT project, title, views, size FROM views"

ORACLE_SQL["pagecounts"] = f"""
WITH {NAMES}, {PAGEVIEWS},
kept AS (
  SELECT split_part(project, '.', 1) AS code, title, views FROM views
  WHERE split_part(project, '.', 1) <> title),
ranked AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY views DESC, title) AS rn FROM kept),
totals AS (SELECT code, CAST(sum(views) AS BIGINT) AS total_views FROM kept GROUP BY code)
SELECT coalesce(iso_name, lower(code)) AS language, code AS language_code, total_views,
       title AS top_title, views AS top_views
FROM totals JOIN ranked USING (code) LEFT JOIN names ON iso_code = lower(code)
WHERE rn = 1"""

ORACLE_SQL["pagecounts_report"] = f"""
WITH report AS ({ORACLE_SQL["pagecounts"]})
SELECT 'Language, Language-code, TotalViews, MostVisitedPage, MostVisitedPage_Views' AS value
UNION ALL
SELECT language || ', ' || language_code || ', ' || total_views || ', "' || top_title || '", ' || top_views
FROM report"""

# Posts --------------------------------------------------------------------

K = "CAST(regexp_extract(props, '[0-9]+') AS INTEGER)"

LOG = f"""log AS (
  SELECT event_id, '(' || event_id || ')' AS seconds,
         upper(event_type[1]) || event_type[2:] AS language, event_type AS language_code,
         CAST(7 AS BIGINT) AS total_lang_count, user_id AS id,
         CAST({K} + event_id % 5 AS BIGINT) AS max_count, CAST({K} AS BIGINT) AS min_count,
         CAST(event_id % 5 AS BIGINT) AS count,
         CASE WHEN event_id % 11 = 1 THEN event_type ELSE event_type || ' ' || {K} END AS text
  FROM events WHERE event_id % 11 NOT IN (0, 2))"""

ORACLE_SQL["scan_retweet_log"] = f"WITH {LOG} SELECT * EXCLUDE (event_id) FROM log"

ORACLE_SQL["retweet_log_totals"] = f"""
WITH {NAMES}, {LOG},
firsts AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY event_id) AS rn FROM log),
posts AS (
  SELECT f.id, f.language_code, f.text, g.mx - g.mn AS count
  FROM firsts f JOIN (SELECT id, max(max_count) mx, min(min_count) mn FROM log GROUP BY id) g USING (id)
  WHERE rn = 1),
totals AS (SELECT language_code, CAST(sum(count) AS BIGINT) AS total_lang_count FROM posts GROUP BY 1)
SELECT coalesce(iso_name, lower(language_code)) AS language, language_code, total_lang_count, id, count, text
FROM posts JOIN totals USING (language_code) LEFT JOIN names ON iso_code = lower(language_code)
WHERE count > 1"""

SIGHTINGS = f"""seen AS (
  SELECT ts, user_id AS id, {K} AS n, event_type AS lang FROM events WHERE event_type <> 'error')"""

WINDOWS = f"""{SIGHTINGS},
opened AS (
  SELECT date_trunc('hour', ts) - to_hours(back) AS window_start, ts, id, n, lang
  FROM seen, (SELECT unnest(range(12)) AS back)),
firsts AS (
  SELECT window_start, id, lang,
         row_number() OVER (PARTITION BY window_start, id ORDER BY ts, lang) AS rn FROM opened),
spans AS (SELECT window_start, id, max(n) AS max_count, min(n) AS min_count FROM opened GROUP BY 1, 2),
counted AS (
  SELECT window_start, window_start + INTERVAL 12 HOUR AS window_end, id, max_count, min_count,
         lang AS language_code, lang AS text,
         CASE WHEN max_count = min_count THEN 1 ELSE max_count - min_count END AS count
  FROM spans JOIN firsts USING (window_start, id) WHERE rn = 1),
totals AS (
  SELECT window_end, language_code, CAST(sum(count) AS BIGINT) AS total_lang_count FROM counted GROUP BY 1, 2),
windows AS (
  SELECT window_start, window_end, coalesce(iso_name, lower(language_code)) AS language, language_code,
         total_lang_count, id, max_count, min_count, count, text
  FROM counted JOIN totals USING (window_end, language_code) LEFT JOIN names ON iso_code = lower(language_code))"""

ORACLE_SQL["retweet_filter"] = f"WITH {SIGHTINGS} SELECT ts, id, n AS max_count, n AS min_count, lang FROM seen"
ORACLE_SQL["retweet_window"] = f"WITH {NAMES}, {WINDOWS} SELECT * FROM windows"
ORACLE_SQL["retweet_lang_totals"] = f"""
WITH {NAMES}, {WINDOWS}
SELECT window_end,
       CAST(row_number() OVER (PARTITION BY window_end ORDER BY total_lang_count DESC, language_code) - 1 AS INTEGER)
         AS rank,
       coalesce(iso_name, lower(language_code)) AS language, language_code, total_lang_count
FROM totals LEFT JOIN names ON iso_code = lower(language_code)"""
ORACLE_SQL["retweet_top"] = f"""
WITH {NAMES}, {WINDOWS}
SELECT window_end,
       row_number() OVER (PARTITION BY window_end
         ORDER BY total_lang_count DESC, max_count - min_count DESC, language_code, id) - 1 AS rank,
       language, total_lang_count, id, text, max_count, min_count, count
FROM windows"""

FIRST_END = "(SELECT date_trunc('hour', min(ts)) + INTERVAL 1 HOUR FROM seen)"
LOG_LINE = f"""'(' || date_diff('second', {FIRST_END}, window_end) || '),' || language || ',' || language_code || ','
  || total_lang_count || ',' || id || ',' || max_count || ',' || min_count || ',' || count || ',' || text AS value"""
WARM = f"window_end >= {FIRST_END} + INTERVAL 12 HOUR"

ORACLE_SQL["retweet_warmup"] = f"WITH {NAMES}, {WINDOWS} SELECT window_end, {LOG_LINE} FROM windows WHERE {WARM}"
ORACLE_SQL["retweet_log_round_trip"] = f"""
WITH {NAMES}, {WINDOWS},
logged AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY window_end) AS rn FROM windows WHERE {WARM}),
posts AS (
  SELECT id, any_value(language_code) FILTER (WHERE rn = 1) AS language_code, any_value(text) FILTER (WHERE rn = 1) AS text,
         CAST(max(max_count) - min(min_count) AS BIGINT) AS count
  FROM logged GROUP BY id),
sums AS (SELECT language_code, CAST(sum(count) AS BIGINT) AS total_lang_count FROM posts GROUP BY 1)
SELECT coalesce(iso_name, lower(language_code)) AS language, language_code, total_lang_count, id, count, text
FROM posts JOIN sums USING (language_code) LEFT JOIN names ON iso_code = lower(language_code)
WHERE count > 1"""
ORACLE_SQL["stream_source"] = f"""
SELECT ts, event_type <> 'error' AS is_retweet, user_id AS id, {K} AS retweet_count, event_type AS lang,
       event_type AS text
FROM events"""
# All events arrive in one batch, so nothing is late; windows open at the end are closed after the run.
ORACLE_SQL["retweet_stream"] = f"WITH {NAMES}, {WINDOWS} SELECT * FROM windows"
ORACLE_SQL["retweet_stream_log"] = f"""
WITH {NAMES}, {WINDOWS}
SELECT '{LOG_HEADER}' AS value
UNION ALL
SELECT {LOG_LINE} FROM windows WHERE {WARM}"""

# People and movies --------------------------------------------------------

BLOCKS = """blocks AS (
  SELECT o_orderkey, o_custkey, year(o_orderdate) + 14 AS year, o_orderstatus,
         starts_with(o_orderpriority, '1') AS series,
         'Person ' || o_custkey || '-' || o_orderkey AS actor
  FROM orders)"""

ORACLE_SQL["scan_blocks"] = f"""
WITH {BLOCKS}
SELECT actor || chr(9) || 'Order ' || o_orderkey || ' (' || year || ')  <3>' || chr(10) || repeat(chr(9), 3)
  || CASE WHEN series THEN '"Series ' || o_orderkey || '" (2012)'
          ELSE 'Second ' || o_orderkey || ' (' || year || '/I) [extra] (uncredited)' END
  || chr(10) || repeat(chr(9), 3)
  || CASE o_orderstatus WHEN 'F' THEN 'Foo (Bar) (2012)' WHEN 'O' THEN 'No bracket 2013' ELSE 'Undated (????)' END
  AS value
FROM blocks"""

ORACLE_SQL["section_extract"] = f"""
SELECT CAST(o_orderkey // {LIST_SIZE} AS BIGINT) AS list,
       3 + row_number() OVER (PARTITION BY o_orderkey // {LIST_SIZE} ORDER BY o_orderkey) AS line_no,
       'Person' || chr(9) || o_orderkey AS value
FROM orders"""

ORACLE_SQL["filmography"] = f"""
WITH {BLOCKS}
SELECT actor, 'm' AS gender,
       'Order ' || o_orderkey || ' (' || year || ')'
       || CASE WHEN series THEN '' ELSE '|Second ' || o_orderkey || ' (' || year || '/I)' END AS movies
FROM blocks WHERE year >= 2011"""

ORACLE_SQL["actors_union"] = f"""
WITH {BLOCKS}
SELECT actor, CASE WHEN o_custkey % 2 = 0 THEN 'm' ELSE 'f' END AS gender,
       CASE WHEN series THEN 1 ELSE 2 END AS movies
FROM blocks WHERE year >= 2011"""

PEOPLE = """people AS (
  SELECT c_custkey AS actor_id, c_name AS name, CASE WHEN c_nationkey % 2 = 0 THEN 'm' ELSE 'f' END AS gender
  FROM customer)"""
EDGES = """edges AS (
  SELECT DISTINCT o_custkey AS actor_id, l_partkey || '@' || strftime(l_shipdate, '%Y-%m') AS movie
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey)"""

ORACLE_SQL["actor_ids"] = f"""
WITH {PEOPLE}, numbered AS (
  SELECT name AS actor, gender, row_number() OVER (ORDER BY name, gender) - 1 AS actor_id FROM people)
SELECT actor, gender, actor_id, CASE WHEN gender = 'm' THEN actor_id ELSE -(actor_id + 1) END AS signed_id
FROM numbered"""
ORACLE_SQL["seed_lookup"] = f"""
WITH {PEOPLE} SELECT name, min(actor_id) AS actor_id FROM people WHERE name = 'Customer#000000000' GROUP BY name"""
ORACLE_SQL["coactors"] = f"""
WITH {EDGES}
SELECT movie, count(*) AS cast_size, CAST(count(*) * (count(*) - 1) AS BIGINT) AS pairs FROM edges GROUP BY movie"""
ORACLE_SQL["coactors_of_seed"] = f"""
WITH {PEOPLE}, {EDGES},
seed AS (SELECT actor_id FROM people WHERE name = 'Customer#000000000')
SELECT DISTINCT actor_id FROM edges
WHERE movie IN (SELECT movie FROM edges WHERE actor_id IN (SELECT actor_id FROM seed))
  AND actor_id NOT IN (SELECT actor_id FROM seed)"""
ORACLE_SQL["adjacency"] = f"""
WITH {EDGES}
SELECT a.actor_id, count(DISTINCT a.movie) AS movies,
       count(*) FILTER (WHERE b.actor_id <> a.actor_id) AS neighbour_entries
FROM edges a JOIN edges b USING (movie) GROUP BY a.actor_id
HAVING count(*) FILTER (WHERE b.actor_id <> a.actor_id) > 0"""

ORACLE_SQL["neighbours"] = f"""
WITH {EDGES}
SELECT a.actor_id, count(DISTINCT b.actor_id) AS neighbours, true AS exact
FROM edges a JOIN edges b USING (movie) WHERE a.actor_id <> b.actor_id GROUP BY a.actor_id"""

SEPARATION = f"""{PEOPLE}, {EDGES},
walk(actor_id, depth) AS (
  SELECT actor_id, 0 FROM people WHERE name = 'Customer#000000000'
  UNION
  SELECT b.actor_id, w.depth + 1
  FROM walk w JOIN edges a ON a.actor_id = w.actor_id JOIN edges b ON b.movie = a.movie
  WHERE w.depth < 6),
found AS (SELECT actor_id, min(depth) AS depth FROM walk GROUP BY actor_id),
connected AS (
  SELECT DISTINCT actor_id FROM edges
  WHERE movie IN (SELECT movie FROM edges GROUP BY movie HAVING count(*) > 1)),
distances AS (
  SELECT actor_id, coalesce(depth, 100) AS distance FROM connected LEFT JOIN found USING (actor_id)),
steps AS (
  SELECT d.distance,
         count(*) FILTER (WHERE gender = 'm') AS actors, count(*) FILTER (WHERE gender = 'f') AS actresses
  FROM (SELECT CAST(unnest(range(1, 7)) AS INTEGER) AS distance) d
  LEFT JOIN distances x ON x.distance = d.distance LEFT JOIN people USING (actor_id)
  GROUP BY d.distance),
names AS (
  SELECT gender, row_number() OVER (PARTITION BY gender ORDER BY name, actor_id) AS number, name
  FROM distances JOIN people USING (actor_id) WHERE distance = 6)"""

ORACLE_SQL["separation"] = f"WITH RECURSIVE {SEPARATION} SELECT actor_id, distance FROM distances"
ORACLE_SQL["separation_counts"] = f"""
WITH RECURSIVE {SEPARATION}
SELECT distance, actors, actresses, actors + actresses AS total,
       CAST(sum(actors + actresses) OVER (ORDER BY distance) AS BIGINT) AS running_total
FROM steps"""
ORACLE_SQL["separation_names"] = f"WITH RECURSIVE {SEPARATION} SELECT gender, number, name FROM names"
ORACLE_SQL["separation_report"] = f"""
WITH RECURSIVE {SEPARATION},
cast_list AS (SELECT * FROM people WHERE actor_id IN (SELECT actor_id FROM edges)),
t AS (
  SELECT count(*) FILTER (WHERE gender = 'm') AS men, count(*) FILTER (WHERE gender = 'f') AS women,
         count(*) AS people FROM cast_list),
s AS (SELECT CAST(sum(actors) AS BIGINT) AS a, CAST(sum(actresses) AS BIGINT) AS b FROM steps)
SELECT 1 AS section, CAST(1 AS BIGINT) AS line_no,
       'Total number of actors = ' || people || ', out of which ' || men || ' (' || men * 100 // people
       || '%) are males while ' || women || ' (' || women * 100 // people || '%) are females.' AS line FROM t
UNION ALL
SELECT 1, 2, 'Total number of movies = ' || (SELECT count(DISTINCT movie) FROM edges)
UNION ALL
SELECT 2, distance, 'There are ' || actors || ' (' || printf('%.1f', round(actors * 100.0::DOUBLE / men, 1)) || '%) actors and '
       || actresses || ' (' || printf('%.1f', round(actresses * 100.0::DOUBLE / women, 1)) || '%) actresses at distance '
       || distance FROM steps, t
UNION ALL
SELECT 3, 1, 'Total number of actors from distance 1 to 6 = ' || (a + b) || ', ratio = '
       || CAST(CAST(CAST(a + b AS DOUBLE) / people AS FLOAT) AS VARCHAR) FROM s, t
UNION ALL
SELECT 3, 2, 'Total number of male actors from distance 1 to 6 = ' || a || ', ratio = '
       || CAST(CAST(CAST(a AS DOUBLE) / men AS FLOAT) AS VARCHAR) FROM s, t
UNION ALL
SELECT 3, 3, 'Total number of female actors (actresses) from distance 1 to 6 = ' || b || ', ratio = '
       || CAST(CAST(CAST(b AS DOUBLE) / women AS FLOAT) AS VARCHAR) FROM s, t
UNION ALL
SELECT 4, 0, 'List of male actors at distance 6:'
UNION ALL
SELECT 5, 0, 'List of female actors (actresses) at distance 6:'
UNION ALL
SELECT CASE WHEN gender = 'm' THEN 4 ELSE 5 END, number, number || '. ' || name FROM names"""

ORACLE_SQL["separation_file"] = f"""
SELECT row_number() OVER (ORDER BY section, line_no) - 1 AS line_no, line AS value
FROM ({ORACLE_SQL["separation_report"]})"""

CAREER_PEOPLE = """people AS (
  SELECT row_number() OVER (ORDER BY c_name, gender) - 1 AS actor_id, c_name AS name, gender, c_custkey AS custkey
  FROM (SELECT c_name, c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'm' ELSE 'f' END AS gender FROM customer
        WHERE c_custkey IN (SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey)))"""
CAREER_EDGES = """edges AS (
  SELECT DISTINCT actor_id, l_partkey || '@' || strftime(l_shipdate, '%Y-%m') AS movie
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN people ON custkey = o_custkey)"""
ORACLE_SQL["separation_from_lists"] = (
    ORACLE_SQL["separation_report"].replace(PEOPLE, CAREER_PEOPLE).replace(EDGES, CAREER_EDGES)
)

# Intervals ----------------------------------------------------------------

EXTENTS = """extents AS (
  SELECT 's' || l_suppkey AS chrom,
         CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) * 40 + l_partkey % 40 + 1 AS INTEGER)
           AS lo,
         CAST(l_quantity AS INTEGER) AS len,
         CASE WHEN l_linenumber % 2 = 0 THEN 'S' ELSE 's' END || l_suppkey AS mixed
  FROM lineitem)"""


def _islands(gap: int) -> str:
    return f"""{EXTENTS},
marked AS (
  SELECT chrom, lo, lo + len - 1 AS hi, mixed,
         max(lo + len - 1) OVER (PARTITION BY chrom ORDER BY lo, lo + len, mixed
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM extents),
grouped AS (
  SELECT *, sum(CASE WHEN reach IS NULL OR lo > reach + {gap} THEN 1 ELSE 0 END)
              OVER (PARTITION BY chrom ORDER BY lo, hi, mixed ROWS UNBOUNDED PRECEDING) AS island
  FROM marked),
islands AS (
  SELECT chrom, min(lo) AS lo, max(hi) AS hi, count(*) AS members, min(mixed) FILTER (WHERE lo = first_lo) AS shown
  FROM (SELECT *, min(lo) OVER (PARTITION BY chrom, island) AS first_lo FROM grouped)
  GROUP BY chrom, island)"""


ORACLE_SQL["covered_intervals"] = f"""
WITH {_islands(5)}
SELECT chrom, lo AS start, hi AS "end", members FROM islands"""
ORACLE_SQL["padded_intervals"] = f"""
WITH {_islands(4)}
SELECT shown AS chrom, greatest(lo - 5, 1) AS start, hi AS "end" FROM islands"""
TARGETS = """targets AS (
  SELECT 's' || o_custkey // 15 AS chrom,
         CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) * 40 AS INTEGER) AS lo,
         CAST(CASE WHEN o_orderkey % 100 = 0 THEN 5000 ELSE o_orderkey % 97 + 1 END AS INTEGER) AS len,
         't' || o_orderkey AS extra
  FROM orders)"""
ORACLE_SQL["scan_bed"] = f'WITH {TARGETS} SELECT chrom, lo AS start, lo + len AS "end", extra FROM targets'
ORACLE_SQL["interval_intersect"] = f"""
WITH {TARGETS}, {_islands(5)}
SELECT t.chrom, greatest(t.lo, i.lo - 1) AS start, least(t.lo + t.len, i.hi) AS "end", t.extra
FROM targets t JOIN islands i ON i.chrom = t.chrom AND t.lo < i.hi AND i.lo - 1 < t.lo + t.len"""
ORACLE_SQL["bed_sink"] = f"""
WITH {_islands(5)}
SELECT row_number() OVER (ORDER BY chrom, lo, hi) - 1 AS line_no,
       chrom || chr(9) || (lo - 1) || chr(9) || hi AS value FROM islands"""
ORACLE_SQL["region_file"] = f"""
WITH {_islands(5)}
SELECT row_number() OVER (ORDER BY chrom, lo, hi) - 1 AS line_no, chrom || ':' || lo || '-' || hi AS value FROM islands"""
ORACLE_SQL["region_strings"] = f"WITH {_islands(5)} SELECT chrom || ':' || lo || '-' || hi AS region FROM islands"

# Reads --------------------------------------------------------------------


def _chrom(index: str, other: str) -> str:
    return (
        f"CASE WHEN {index} = 0 THEN 'chrM' WHEN {index} = 23 THEN 'chrX' WHEN {index} = 24 THEN 'chrY' "
        f"WHEN {index} BETWEEN 1 AND 22 THEN 'chr' || {index} ELSE {other} END"
    )


SEQS = f"""seqs AS (
  SELECT CAST(s_suppkey AS INTEGER) AS ref_index, {_chrom("s_suppkey", "'chrUn_' || s_suppkey")} AS name,
         CAST(CASE WHEN s_suppkey >= 25 AND s_suppkey % 10 = 5 THEN 0 ELSE 2000 + 10 * s_suppkey END AS INTEGER)
           AS length
  FROM supplier)"""

def _reads(spread: int = 1, quality: str = "n * 5") -> str:
    return f"""{SEQS}, raw AS (
  SELECT *, CAST(l_quantity AS INTEGER) AS q, l_linenumber AS n,
         CASE WHEN l_orderkey % 997 <> 3 THEN
           CAST((date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) // 8) * 8 * {spread} + 1 AS INTEGER) END AS pos,
         {_chrom("(l_suppkey % 26)", "'chrUn_25'")} AS rname
  FROM lineitem),
reads AS (
  SELECT concat_ws(':', 'r', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS qname,
         CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 4 WHEN l_returnflag = 'N' THEN 16 ELSE 0 END
           AS flag,
         rname, ref_index, pos, n * 8 AS mapq,
         CASE n WHEN 1 THEN q || 'M' WHEN 2 THEN '3S' || q || 'M' WHEN 3 THEN q || 'M2D5M'
                WHEN 4 THEN q || 'M1I4M' WHEN 5 THEN q || 'M100N5M' WHEN 6 THEN '2H' || q || 'M3S' ELSE '*' END
           AS cigar,
         '=' AS rnext, CAST(pos + l_partkey % 3 AS INTEGER) AS pnext, 0 AS tlen, '*' AS seq,
         repeat(chr(CAST({quality} + 33 AS INTEGER)), q) AS qual, CAST({quality} AS INTEGER) AS quality,
         n, q, length,
         CASE n WHEN 1 THEN q WHEN 2 THEN q WHEN 3 THEN q + 7 WHEN 4 THEN q + 4 WHEN 5 THEN q + 105
                WHEN 6 THEN q ELSE 0 END AS span
  FROM raw LEFT JOIN seqs ON name = rname),
mapped AS (SELECT * FROM reads WHERE flag <> 4 AND ref_index BETWEEN 1 AND 24)"""


READS = _reads()

READ_COLUMNS = "qname, flag, rname, ref_index, pos, mapq, cigar, rnext, pnext, tlen, seq, qual"

ORACLE_SQL["scan_input_files"] = f"""
SELECT 'list=' || o_orderkey // {LIST_SIZE} AS folder,
       count(*) + 4 * count(*) FILTER (WHERE o_orderkey % {LIST_SIZE} = 0)
                + 2 * count(*) FILTER (WHERE o_orderkey % {LIST_SIZE} = {LIST_SIZE} - 1) AS lines
FROM orders GROUP BY o_orderkey // {LIST_SIZE}"""
ORACLE_SQL["scan_reads"] = f"WITH {READS} SELECT {READ_COLUMNS} FROM reads"
ORACLE_SQL["scan_seq_dict"] = f"WITH {SEQS} SELECT ref_index, name, length FROM seqs"
ORACLE_SQL["mapped_reads"] = f"WITH {READS} SELECT {READ_COLUMNS} FROM mapped"
ORACLE_SQL["alignment_end"] = f"""
WITH {READS} SELECT qname, pos, cigar, CAST(pos + span - 1 AS INTEGER) AS "end" FROM reads"""

ORACLE_SQL["quality_encoding"] = """
WITH q AS (
  SELECT label AS region, vec_id, 'v' || vec_id AS qname,
         list_transform(embedding, lambda x: CAST(floor(abs(CAST(x AS DOUBLE)) * 100) AS INTEGER) + 35) AS quals
  FROM embeddings),
guess AS (
  SELECT region, CASE WHEN list_max(quals) <= 60 THEN 'SANGER' ELSE 'ILLUMINA' END AS encoding
  FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY vec_id, qname) AS rn FROM q) WHERE rn = 1),
fixed AS (
  SELECT q.region, qname, encoding,
         CASE encoding WHEN 'ILLUMINA' THEN list_transform(quals, lambda x: x - 31) ELSE quals END AS phred
  FROM q JOIN guess USING (region))
SELECT region, qname, encoding, list_min(phred) AS lowest, CAST(list_sum(phred) AS BIGINT) AS total,
       list_min(phred) < 0 AS rejected
FROM fixed"""

LANE = f"""{_reads(100, "CASE WHEN l_suppkey % 26 % 2 = 1 AND l_orderkey % 50 <> 7 THEN 2 * n + 59 ELSE 5 * n END")},
guess AS (
  SELECT ref_index, CASE WHEN quality <= 60 THEN 'SANGER' ELSE 'ILLUMINA' END AS encoding
  FROM (SELECT *, row_number() OVER (PARTITION BY ref_index ORDER BY pos NULLS FIRST, qname) AS rn FROM mapped)
  WHERE rn = 1),
lane AS (
  SELECT mapped.*, encoding, CASE encoding WHEN 'ILLUMINA' THEN quality - 31 ELSE quality END AS phred
  FROM mapped JOIN guess USING (ref_index))"""
ORACLE_SQL["mended_qualities"] = f"""
WITH {LANE}
SELECT ref_index AS region, qname, encoding, phred AS lowest, CAST(phred * q AS BIGINT) AS total, phred < 0 AS rejected
FROM lane"""
ORACLE_SQL["covered_targets"] = f"""
WITH {LANE},
ends AS (
  SELECT ref_index, rname, pos AS lo, pos + span - 1 AS hi,
         max(pos + span - 1) OVER (PARTITION BY ref_index ORDER BY pos, span, qname
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach, span, qname
  FROM lane WHERE phred >= 0 AND span > 0 AND pos IS NOT NULL),
stretches AS (
  SELECT rname, min(lo) AS lo, max(hi) AS hi
  FROM (SELECT *, sum(CASE WHEN reach IS NULL OR lo > reach + 51 THEN 1 ELSE 0 END)
                    OVER (PARTITION BY ref_index ORDER BY lo, span, qname ROWS UNBOUNDED PRECEDING) AS island FROM ends)
  GROUP BY ref_index, rname, island),
goals AS (
  SELECT {_chrom("(o_custkey % 26)", "'chrUn_25'")} AS chrom,
         CAST(greatest(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) * 100, 0) AS INTEGER) AS lo,
         CAST(CASE WHEN o_orderkey % 100 = 0 THEN 5000 ELSE o_orderkey % 97 + 1 END AS INTEGER) AS len,
         't' || o_orderkey AS extra
  FROM orders)
SELECT chrom, greatest(g.lo, s.lo - 1) AS start, least(g.lo + g.len, s.hi) AS "end", extra
FROM goals g JOIN stretches s ON s.rname = chrom AND g.lo < s.hi AND s.lo - 1 < g.lo + g.len"""

# Room = reference bases left on the sequence; past it bases are soft-clipped.
ORACLE_SQL["clean_reads"] = f"""
WITH {READS},
sized AS (
  SELECT *, length - pos + 1 AS room,
         coalesce(flag <> 4 AND pos + span - 1 > length AND pos <= length, FALSE) AS was_clipped FROM reads)
SELECT qname, flag, rname, pos,
  CASE WHEN NOT was_clipped THEN cigar
    WHEN n = 1 THEN room || 'M' || (q - room) || 'S'
    WHEN n = 2 THEN '3S' || room || 'M' || (q - room) || 'S'
    WHEN n = 6 THEN '2H' || room || 'M' || (q - room + 3) || 'S'
    WHEN n = 3 AND room <= q + 2 THEN least(room, q) || 'M' || (q - least(room, q) + 5) || 'S'
    WHEN n = 3 THEN q || 'M2D' || (room - q - 2) || 'M' || (q + 7 - room) || 'S'
    WHEN n = 4 AND room <= q THEN room || 'M' || (q - room + 5) || 'S'
    WHEN n = 4 THEN q || 'M1I' || (room - q) || 'M' || (q + 4 - room) || 'S'
    WHEN n = 5 AND room <= q + 100 THEN least(room, q) || 'M' || (q - least(room, q) + 5) || 'S'
    WHEN n = 5 THEN q || 'M100N' || (room - q - 100) || 'M' || (q + 105 - room) || 'S'
  END AS cigar,
  CASE WHEN flag = 4 THEN 0 ELSE mapq END AS mapq, was_clipped
FROM sized"""

MARKED = f"""{READS},
keyed AS (
  SELECT *, CASE WHEN flag = 16 THEN pos + span - 1 + CASE n WHEN 6 THEN 3 ELSE 0 END
                 ELSE pos - CASE n WHEN 2 THEN 3 WHEN 6 THEN 2 ELSE 0 END END AS five,
         CASE WHEN 5 * n >= 15 THEN q * 5 * n ELSE 0 END AS score
  FROM mapped),
marked AS (
  SELECT *, row_number() OVER (PARTITION BY ref_index, flag = 16, five, rnext, pnext
                               ORDER BY score DESC, qname, flag, rname, pos, mapq, cigar, tlen, seq, qual) > 1
              AND five IS NOT NULL AS is_duplicate
  FROM keyed)"""
ORACLE_SQL["mark_duplicates"] = f"""
WITH {MARKED}
SELECT qname, flag, rname, ref_index, pos, mapq, cigar, rnext, pnext, qual, is_duplicate FROM marked"""
ORACLE_SQL["duplicate_metrics"] = f"""
WITH {MARKED}
SELECT 'LIB1' AS library, count(*) AS reads, count(*) FILTER (WHERE is_duplicate) AS duplicates,
       round(count(*) FILTER (WHERE is_duplicate) / count(*), 6) AS duplication
FROM marked"""
ORACLE_SQL["library_metrics"] = f"""
WITH RECURSIVE {MARKED},
counted AS (
  SELECT 'LIB' || ref_index AS library, count(*) AS reads, count(*) FILTER (WHERE is_duplicate) AS duplicates,
         count(*)::DOUBLE AS n, count(*) FILTER (WHERE NOT is_duplicate)::DOUBLE AS c
  FROM marked GROUP BY ref_index),
halved(library, n, c, lo, hi, step) AS (
  SELECT library, n, c, 0.0::DOUBLE, n / c, 0 FROM counted
  UNION ALL
  SELECT library, n, c,
         CASE WHEN (1 - exp(-(lo + hi) / 2)) * n > (lo + hi) / 2 * c THEN (lo + hi) / 2 ELSE lo END,
         CASE WHEN (1 - exp(-(lo + hi) / 2)) * n > (lo + hi) / 2 * c THEN hi ELSE (lo + hi) / 2 END, step + 1
  FROM halved WHERE step < 60)
SELECT library, reads, duplicates, round(duplicates / reads, 6) AS duplication,
       CASE WHEN duplicates > 0 THEN CAST(round(h.n / ((lo + hi) / 2)) AS BIGINT) END AS estimated_size
FROM counted JOIN halved h USING (library) WHERE step = 60"""
ORACLE_SQL["read_group_tag"] = f"""
WITH {READS}
SELECT qname, flag, rname, ref_index, pos, mapq, cigar, rnext, pnext, 'GROUP1' AS rg_id, 'LIB1' AS library,
       'ILLUMINA' AS platform, 'UNIT1' AS unit, 'SAMPLE1' AS sample
FROM mapped"""
ORACLE_SQL["region_counts"] = f"WITH {READS} SELECT ref_index, count(*) AS n FROM mapped GROUP BY ref_index"
ORACLE_SQL["reads_by_region"] = f"WITH {READS} SELECT ref_index AS region, pos, qname, flag, cigar FROM mapped"
ORACLE_SQL["coordinate_sort"] = f"""
WITH {READS}
SELECT ref_index, pos, qname, flag, cigar,
       row_number() OVER (ORDER BY ref_index, pos NULLS FIRST, qname, flag, cigar) - 1 AS ordinal
FROM mapped"""
ORACLE_SQL["reads_sorted_sink"] = f"""
WITH {READS} SELECT qname, flag, rname, ref_index, pos, mapq, cigar, rnext, pnext, qual FROM mapped"""

ORACLE_SQL["reads_in_region"] = f"""
WITH {READS}
SELECT qname, flag, ref_index, pos, cigar FROM mapped
WHERE ref_index = 3 AND pos <= 900 AND greatest(pos + span - 1, pos) >= 400"""

ASSIGNMENT = """weights AS (
  SELECT c_nationkey AS key, count(*) AS n,
         row_number() OVER (ORDER BY count(*) DESC, c_nationkey DESC) AS step
  FROM customer GROUP BY c_nationkey),
fold(step, key, n, task, loads) AS (
  SELECT CAST(0 AS BIGINT), CAST(NULL AS INTEGER), CAST(NULL AS BIGINT), CAST(NULL AS INTEGER),
         list_transform(range(8), lambda x: CAST(0 AS BIGINT))
  UNION ALL
  SELECT w.step, w.key, w.n, CAST(list_position(f.loads, list_min(f.loads)) - 1 AS INTEGER),
         list_transform(f.loads, lambda load, i:
           load + CASE WHEN i = list_position(f.loads, list_min(f.loads)) THEN w.n ELSE 0 END)
  FROM fold f JOIN weights w ON w.step = f.step + 1)"""
ORACLE_SQL["region_assignment"] = f"WITH RECURSIVE {ASSIGNMENT} SELECT key, n, task FROM fold WHERE step > 0"
ORACLE_SQL["balanced_repartition"] = f"""
WITH RECURSIVE {ASSIGNMENT}
SELECT c_nationkey, c_custkey, task FROM customer JOIN fold ON key = c_nationkey"""
ORACLE_SQL["task_partitions"] = f"""
WITH RECURSIVE {ASSIGNMENT},
loads AS (SELECT task, CAST(sum(n) AS BIGINT) AS rows FROM fold WHERE step > 0 GROUP BY task)
SELECT task, rows, CAST(ceil(rows * 16 / (SELECT sum(rows) FROM loads)) AS BIGINT) AS partitions,
       CAST(1 AS BIGINT) AS tasks_met
FROM loads"""
ORACLE_SQL["grouped_region_apply"] = f"""
WITH {READS},
kept AS (SELECT ref_index, pos AS lo, pos + span AS hi FROM mapped WHERE span > 0 AND pos IS NOT NULL),
steps AS (
  SELECT ref_index, spot, sum(d) AS d
  FROM (SELECT ref_index, lo AS spot, 1 AS d FROM kept UNION ALL SELECT ref_index, hi, -1 FROM kept)
  GROUP BY ref_index, spot),
depths AS (
  SELECT ref_index, spot, sum(d) OVER (PARTITION BY ref_index ORDER BY spot) AS depth,
         lead(spot) OVER (PARTITION BY ref_index ORDER BY spot) AS upto
  FROM steps)
SELECT ref_index, CAST(sum(CASE WHEN depth > 0 THEN upto - spot ELSE 0 END) AS BIGINT) AS covered,
       CAST(max(depth) AS BIGINT) AS max_depth
FROM depths GROUP BY ref_index"""

# Variants -----------------------------------------------------------------

VARIANTS = f"""variants AS (
  SELECT CAST(l_suppkey % 25 AS INTEGER) AS chrom, CAST(l_partkey + 1 AS INTEGER) AS pos,
         l_returnflag AS ref, l_linestatus AS alt,
         concat_ws(chr(9), {_chrom("(l_suppkey % 25)", "'chrM'")}, l_partkey + 1, '.', l_returnflag, l_linestatus,
                   CAST(l_quantity AS INTEGER), 'PASS', 'OK=' || l_orderkey || ';N=' || l_linenumber) AS line
  FROM lineitem)"""
ORACLE_SQL["scan_vcf"] = f"WITH {VARIANTS} SELECT chrom, pos, ref, alt, line FROM variants"
ORACLE_SQL["variants_ordered"] = f"""
WITH {VARIANTS}
SELECT chrom, pos, line, row_number() OVER (ORDER BY chrom, pos, line) - 1 AS ordinal
FROM variants WHERE chrom BETWEEN 1 AND 24"""
ORACLE_SQL["variants_file"] = f"""
WITH {VARIANTS}
SELECT row_number() OVER (ORDER BY chrom, pos, line) - 1 AS line_no, line AS value
FROM variants WHERE chrom BETWEEN 1 AND 24"""
ORACLE_SQL["variants_by_region"] = f"""
WITH {VARIANTS} SELECT chrom AS region, line FROM variants WHERE chrom BETWEEN 1 AND 24"""
ORACLE_SQL["vcf_compare"] = """
WITH keys AS (
  SELECT DISTINCT l_orderkey % 2 AS odd, l_suppkey, l_partkey, l_returnflag, l_linestatus FROM lineitem),
matched AS (
  SELECT r.l_suppkey IS NOT NULL AS hit, 1 AS one
  FROM keys k LEFT JOIN (SELECT * FROM keys WHERE odd = 0) r
    USING (l_suppkey, l_partkey, l_returnflag, l_linestatus)
  WHERE k.odd = 1)
SELECT count(*) AS total, count(*) FILTER (WHERE hit) AS matches, count(*) FILTER (WHERE NOT hit) AS diff
FROM matched"""

# Texts and paired reads ---------------------------------------------------

CLEAN = r"""regexp_replace(regexp_replace(regexp_replace({text}, 'RT', ''), '@\p{{L}}+', '', 'g'),
         'https?://\S+\s?', '', 'g')"""
POST = "'RT @user' || lang || ': ' || text || ' https://t.co/' || doc_id || ' RT @end'"
ORACLE_SQL["clean_text"] = rf"""
SELECT doc_id, regexp_replace({CLEAN.format(text=POST)}, '[\r\n]', ' ', 'g') AS cleaned FROM documents"""
ORACLE_SQL["script_fix"] = """
WITH coded AS (
  SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'lt' ELSE lang END AS code,
         text || CASE doc_id % 4 WHEN 0 THEN ' ひら' WHEN 1 THEN ' 한글' WHEN 2 THEN ' 한ひ' ELSE '' END AS text
  FROM documents)
SELECT doc_id, code,
       CASE WHEN code = 'lt' AND regexp_matches(text, '\\p{Hiragana}') THEN 'ja'
            WHEN code = 'lt' AND regexp_matches(text, '\\p{Hangul}') THEN 'ko' ELSE code END AS fixed
FROM coded""".replace("\\\\", "\\")

GRAMS = "unnest(list_transform(range(1, length(s) - 1), lambda i: substring(s, i, 3))) AS gram"


def _framed(text: str) -> str:
    return rf"' ' || trim(regexp_replace(lower({text}), '[^\p{{L}}]+', ' ', 'g')) || ' ' AS s"


def _identified(texts: str) -> str:
    """Queries up to ``identified(doc_id, language, distance)`` of a query ``doc_id, s``."""
    return f"""samples AS (SELECT lang, {_framed(CLEAN.format(text='text'))} FROM documents),
profiles AS (
  SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, gram) AS known
  FROM (SELECT lang, {GRAMS} FROM samples) GROUP BY lang, gram QUALIFY known <= 300),
framed AS ({texts}),
ranked AS (
  SELECT doc_id, gram, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, gram) AS rank
  FROM (SELECT doc_id, {GRAMS} FROM framed) GROUP BY doc_id, gram QUALIFY rank <= 300),
langs AS (SELECT DISTINCT lang FROM profiles),
distances AS (
  SELECT r.doc_id, l.lang, sum(coalesce(abs(r.rank - p.known), 300)) AS distance
  FROM ranked r CROSS JOIN langs l LEFT JOIN profiles p ON p.lang = l.lang AND p.gram = r.gram
  GROUP BY r.doc_id, l.lang),
identified AS (
  SELECT doc_id, arg_min(lang, (distance, lang)) AS language, CAST(min(distance) AS BIGINT) AS distance
  FROM (SELECT doc_id, lang, distance FROM distances
        UNION ALL
        SELECT doc_id, (SELECT min(lang) FROM langs), 0 FROM framed WHERE length(s) < 3)
  GROUP BY doc_id)"""


ORACLE_SQL["language_id"] = f"""
WITH {_identified(f"SELECT doc_id, {_framed(CLEAN.format(text='text'))} FROM documents")}
SELECT doc_id, language, distance FROM identified"""

POSTS = rf"""post AS (
  SELECT doc_id, regexp_replace({CLEAN.format(text=POST)}, '[\r\n]', ' ', 'g') AS cleaned FROM documents)"""
ORACLE_SQL["language_detect"] = f"""
WITH {POSTS}, {_identified(f"SELECT doc_id, {_framed('cleaned')} FROM post")}
SELECT doc_id, language AS lang, length(cleaned) AS letters FROM identified JOIN post USING (doc_id)"""

TIMED = rf"""post AS (
  SELECT doc_id, regexp_replace({CLEAN.format(text='text')}, '[\r\n]', ' ', 'g') AS cleaned FROM documents)"""
ORACLE_SQL["retweet_window_detected"] = f"""
WITH {NAMES}, {TIMED}, {_identified(f"SELECT doc_id, {_framed('cleaned')} FROM post")},
seen AS (
  SELECT doc_id, doc_id * 10 AS minute, doc_id % 40 AS id, CAST(n_chars AS INTEGER) AS n, language AS lang
  FROM documents JOIN identified USING (doc_id) WHERE doc_id % 7 <> 0),
opened AS (
  SELECT begin, minute, id, n, lang
  FROM (SELECT *, unnest(range(-2, 1)) * 240 + minute // 240 * 240 AS begin FROM seen)
  WHERE begin <= minute AND minute < begin + 600),
counted AS (
  SELECT begin, id, max(n) AS max_count, min(n) AS min_count, arg_min(lang, minute) AS language_code,
         CASE WHEN max(n) = min(n) THEN 1 ELSE max(n) - min(n) END AS count
  FROM opened GROUP BY begin, id),
totals AS (SELECT begin, language_code, CAST(sum(count) AS BIGINT) AS total_lang_count FROM counted GROUP BY ALL)
SELECT CAST(TIMESTAMP '2024-01-01' + to_minutes(begin) AS VARCHAR) AS window_start,
       CAST(TIMESTAMP '2024-01-01' + to_minutes(begin + 600) AS VARCHAR) AS window_end,
       coalesce(iso_name, lower(language_code)) AS language, language_code, total_lang_count, id, max_count, min_count, count
FROM counted JOIN totals USING (begin, language_code) LEFT JOIN names ON iso_code = lower(language_code)"""

ORACLE_SQL["fastq_interleave_chunks"] = r"""
WITH turns AS (
  SELECT conv_id, turn // 2 AS p, turn % 2 AS side, turn, regexp_replace(text, '[\r\n]', ' ', 'g') AS seq,
         count(*) OVER (PARTITION BY conv_id, turn // 2) AS mates
  FROM conversations),
pairs AS (
  SELECT conv_id, p, row_number() OVER (ORDER BY conv_id, p) - 1 AS pair, count(*) OVER () AS total
  FROM (SELECT DISTINCT conv_id, p FROM turns WHERE mates = 2))
SELECT CAST(pair * 8 // total AS INTEGER) AS chunk, CAST(pair AS BIGINT) AS pair, CAST(side + 1 AS INTEGER) AS mate,
       'c' || conv_id || '/' || turn AS name, seq, 'q' || length(seq) AS qual
FROM turns JOIN pairs USING (conv_id, p)"""
ORACLE_SQL["fastq_chunk_files"] = f"""
SELECT CAST(2 * pair + mate - 1 AS BIGINT) AS record, name, seq, qual FROM ({ORACLE_SQL["fastq_interleave_chunks"]})"""
ORACLE_SQL["fastq_unpaired"] = """
SELECT count(*) AS only_first, CAST(0 AS BIGINT) AS only_second
FROM (SELECT conv_id, turn // 2 FROM conversations GROUP BY 1, 2 HAVING count(*) = 1)"""
