"""The registered queries as DuckDB SQL over the same tables, written independently of the operators."""

from __future__ import annotations

from skytally.functions.text import COMMON_WORDS

FLIGHTS = """
flights AS (
 SELECT sn.n_name AS origin, cn.n_name AS dest, p_brand AS airline_id,
  CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS arr_delayed,
  CASE WHEN l_suppkey % 13 = 0 THEN NULL WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS dep_delayed,
  CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE CAST(l_quantity AS INT) END AS arr_delay_minutes,
  CAST(l_shipdate AS DATE) AS flight_date,
  CAST(isodow(l_shipdate) AS INT) AS day_of_week,
  CAST((l_partkey % 24) * 100 + (l_orderkey % 60) AS INT) AS dep_time,
  CAST(((l_partkey + l_suppkey) % 24) * 100 + (l_orderkey % 60) AS INT) AS arr_time,
  concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS flight_id
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
 JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN customer ON o_custkey = c_custkey
 JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN part ON l_partkey = p_partkey)"""

POPULARITY = FLIGHTS + """,
popularity AS (
 SELECT airport, count(*) AS popularity
 FROM (SELECT origin AS airport FROM flights UNION ALL SELECT dest FROM flights) GROUP BY airport)"""

AIRPORTS = """
airports AS (SELECT n_name AS origin FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('AFRICA', 'ASIA'))"""

PAIRS = """
pairs AS (SELECT a.n_name AS origin, b.n_name AS dest FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey)"""

WEEKDAYS = FLIGHTS + """,
weekdays AS (
 SELECT day_of_week, round((count(*) - sum(arr_delayed)) / count(*), 9) AS perf
 FROM flights WHERE arr_delayed IS NOT NULL GROUP BY day_of_week)"""

FROM_ORIGIN = FLIGHTS + """,
rates AS (
 SELECT origin, airline_id, round((count(*) - sum(dep_delayed)) / count(*), 9) AS perf
 FROM flights WHERE dep_delayed IS NOT NULL GROUP BY origin, airline_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY origin ORDER BY perf DESC, airline_id DESC) AS rank FROM rates)"""

BETWEEN = FLIGHTS + """,
rates AS (
 SELECT origin, dest, airline_id, round((count(*) - sum(arr_delayed)) / count(*), 9) AS perf
 FROM flights WHERE arr_delayed IS NOT NULL GROUP BY origin, dest, airline_id),
ranked AS (
 SELECT *, row_number() OVER (PARTITION BY origin, dest ORDER BY perf DESC, airline_id DESC) AS rank FROM rates)"""

DELAYS = FLIGHTS + """,
delays AS (
 SELECT origin, dest, round(sum(arr_delay_minutes) / count(arr_delay_minutes), 6) AS mean_delay
 FROM flights WHERE arr_delay_minutes IS NOT NULL GROUP BY origin, dest)"""

REQUESTS = FLIGHTS + """,
requests AS (
 SELECT DISTINCT sn.n_name AS x, cn.n_name AS y, zn.n_name AS z, CAST(l_shipdate AS DATE) AS date1
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
 JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN customer ON o_custkey = c_custkey
 JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN nation zn ON l_partkey % 25 = zn.n_nationkey),
legs AS (
 SELECT x, y, z, date1, 0 AS leg, x AS origin, y AS dest, date1 AS flight_date FROM requests
 UNION ALL
 SELECT x, y, z, date1, 1, y, z, date1 + 2 FROM requests)"""

TRIPS = REQUESTS + """,
options AS (
 SELECT l.*, f.arr_time, f.flight_id,
  row_number() OVER (PARTITION BY l.x, l.y, l.z, l.date1, l.leg ORDER BY f.arr_time, f.flight_id) AS pick
 FROM legs l JOIN flights f USING (origin, dest, flight_date)
 WHERE arr_time < 9999 AND CASE WHEN leg = 0 THEN dep_time <= 1200 ELSE dep_time >= 1200 END),
best AS (SELECT * FROM options WHERE pick = 1),
found AS (
 SELECT a.flight_date AS date1, a.origin AS origin1, a.dest AS dest1, a.arr_time AS time1, a.flight_id AS flight_id1,
  b.flight_date AS date2, b.origin AS origin2, b.dest AS dest2, b.arr_time AS time2, b.flight_id AS flight_id2
 FROM best a JOIN best b USING (x, y, z, date1) WHERE a.leg = 0 AND b.leg = 1)"""

LINKS = "links AS (SELECT DISTINCT o_custkey AS src, l_suppkey AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"

INLINKS = LINKS + """,
pages_ AS (SELECT src AS id FROM links UNION SELECT dst FROM links),
inlinks AS (SELECT id, count(dst) AS inlinks FROM pages_ LEFT JOIN links ON id = dst GROUP BY id)"""

RATINGS = """
ratings AS (
 SELECT o_custkey AS user_id, l_partkey AS movie_id, 1 + CAST(l_quantity AS INT) % 5 AS rating
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 QUALIFY row_number() OVER (PARTITION BY o_custkey, l_partkey
  ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, CAST(l_quantity AS INT) % 5 DESC) = 1)"""

TITLE_WORDS = r"""
stops AS (SELECT DISTINCT unnest(string_split_regex(lower(text), '[\s.,]+')) AS word FROM benchmark),
counts AS (
 SELECT word, count(*) AS n
 FROM (SELECT unnest(string_split_regex(lower(text), '[\n\r \t,;.?!\-:@\[\](){}_*/]+')) AS word FROM documents)
 WHERE word <> '' AND word NOT IN (SELECT word FROM stops) GROUP BY word),
top AS (SELECT * FROM counts ORDER BY n DESC, word DESC LIMIT 10)"""

SENTENCE_SPLIT = r"""string_split_regex(text, '[\s~`!@#$%^&*(-)+=_:;''",.<>?/\\0-9\]\[\}\{]+')"""

SPOKEN = f"""
spoken AS (SELECT unnest({SENTENCE_SPLIT}) AS word FROM documents),
sentence_counts AS (SELECT word, count(*) AS n FROM spoken WHERE word <> '' GROUP BY word),
normal_counts AS (
 SELECT lower(word) AS word, count(*) AS n FROM spoken
 WHERE word <> '' AND lower(word) NOT IN ({", ".join(f"'{word}'" for word in COMMON_WORDS)}) GROUP BY lower(word)),
normal_top AS (SELECT * FROM normal_counts ORDER BY n DESC, word LIMIT 10)"""

CHANGES = """
log AS (
 SELECT user_id AS key, event_id AS seq, value,
  CASE event_type WHEN 'signup' THEN 'CREATE' WHEN 'error' THEN 'DELETE' WHEN 'view' THEN 'READ' ELSE 'UPDATE' END AS op
 FROM events)"""

AUDIT = CHANGES + """,
audit AS (
 SELECT key, seq, op, op = 'CREATE' OR coalesce(
  last_value(CASE WHEN op IN ('CREATE', 'DELETE') THEN op END IGNORE NULLS) OVER (
   PARTITION BY key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 'CREATE', false) AS success
 FROM log)"""

CHANGED_STATE = """deleted AS (SELECT key, max(seq) AS dq FROM log WHERE op = 'DELETE' GROUP BY key),
created AS (
 SELECT log.key, min(seq) AS cq FROM log LEFT JOIN deleted USING (key)
 WHERE op = 'CREATE' AND (dq IS NULL OR seq > dq) GROUP BY log.key)
SELECT key, seq, value FROM log JOIN created USING (key) WHERE seq = cq OR (op = 'UPDATE' AND seq > cq)
QUALIFY row_number() OVER (PARTITION BY key ORDER BY seq DESC) = 1"""

COPIES = """
copies AS (
 SELECT c_custkey AS key, CASE WHEN (c_custkey + r) % 7 = 0 THEN NULL WHEN (c_custkey + r) % 5 = 0
  THEN c_acctbal + 1 + r ELSE c_acctbal END AS value
 FROM customer, (VALUES (0), (1), (2)) AS n(r))"""

RING = """
spots AS (SELECT n_name AS node, CAST(('0x' || substr(md5(n_name), 1, 8)) AS BIGINT) % 512 AS pos FROM nation),
ring_keys AS (
 SELECT c_custkey AS key, CAST(('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8)) AS BIGINT) % 512 AS pos FROM customer),
placed AS (
 SELECT key, node, row_number() OVER (
  PARTITION BY key ORDER BY CASE WHEN s.pos >= k.pos THEN 0 ELSE 1 END, s.pos, node) - 1 AS replica
 FROM ring_keys k CROSS JOIN spots s)"""

HEARTBEATS = """
beats AS (SELECT user_id AS member, event_id AS heartbeat, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS tick FROM events),
advances AS (
 SELECT member, heartbeat, min(tick) AS tick FROM beats b
 WHERE heartbeat = (SELECT max(heartbeat) FROM beats c WHERE c.member = b.member) GROUP BY member, heartbeat),
status AS (
 SELECT *, CASE WHEN gap <= 5 THEN 'alive' WHEN gap <= 25 THEN 'suspect' ELSE 'removed' END AS status
 FROM (SELECT *, (SELECT max(tick) FROM beats) - tick AS gap FROM advances))"""

CELLS = """
cells AS (
 SELECT printf('row%05d', user_id) AS row_key, event_type AS family, 'k' AS qualifier, props::JSON->>'k' AS value,
  event_id AS seq FROM events
 UNION ALL
 SELECT printf('row%05d', user_id), event_type, 'value', CAST(CAST(floor(value) AS BIGINT) AS VARCHAR), event_id FROM events),
latest AS (
 SELECT row_key, family, qualifier, value FROM cells
 QUALIFY row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY seq DESC) = 1)"""

MEMBERSHIP = """
log AS (
 SELECT CASE WHEN event_type = 'signup' THEN user_id::VARCHAR ELSE props::JSON->>'k' END || '.0.0.0:0' AS member,
  user_id || '.0.0.0:0' AS observer,
  CASE event_type WHEN 'signup' THEN 'failed' WHEN 'error' THEN 'removed' ELSE 'joined' END AS action
 FROM events WHERE event_type <> 'view'),
nodes AS (SELECT observer AS node FROM log UNION SELECT member FROM log WHERE action = 'joined'),
dead AS (SELECT DISTINCT observer AS node FROM log WHERE action = 'failed'),
survivors AS (SELECT node FROM nodes EXCEPT SELECT node FROM dead),
per_member AS (SELECT DISTINCT member, member IN (SELECT node FROM dead) AS failed FROM log),
with_peers AS (
 SELECT *, (SELECT count(*) FROM nodes WHERE node <> member) AS others,
  (SELECT count(*) FROM survivors WHERE node <> member) AS peers,
  (SELECT count(DISTINCT l.observer) FROM log l WHERE l.member = p.member AND l.action = 'joined'
    AND l.observer <> l.member) AS joined_by,
  (SELECT count(DISTINCT l.observer) FROM log l SEMI JOIN survivors s ON l.observer = s.node
    WHERE l.member = p.member AND l.action = 'removed' AND l.observer <> l.member) AS removed_by,
  (SELECT count(*) FROM log l WHERE l.member = p.member AND l.action = 'removed' AND l.observer <> l.member) AS removals
 FROM per_member p)"""

ALARMS = """
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, event_type AS sensor, CAST(floor(value) AS INT) - 150 AS value
FROM events WHERE CAST(floor(value) AS INT) - 150 < -100 OR CAST(floor(value) AS INT) - 150 > 100"""

FULL_FLIGHT = """
SELECT origin, dest, airline_id, airline_id AS airline_code, arr_delayed, dep_delayed, arr_delay_minutes, flight_date,
 day_of_week, dep_time AS crs_dep_time, arr_time, dep_time, flight_id FROM flights"""

_FAMILY_COLUMNS = ", ".join(
    f"max(CASE WHEN family = '{family}' AND qualifier = '{name}' THEN value END) AS {family}_{name}"
    for family in ("click", "error", "purchase", "signup", "view") for name in ("k", "value"))

TOP_FROM = f"WITH {FROM_ORIGIN}, {AIRPORTS} SELECT origin, airline_id, perf, rank FROM ranked " \
           "WHERE rank <= 10 AND origin IN (SELECT origin FROM airports)"
TOP_BETWEEN = f"WITH {BETWEEN}, {PAIRS} SELECT origin, dest, airline_id, perf, rank FROM ranked " \
              "JOIN pairs USING (origin, dest) WHERE rank <= 10"
TOP_AIRPORTS = f"WITH {POPULARITY} SELECT * FROM popularity ORDER BY popularity DESC, airport DESC LIMIT 10"
RANKED_DAYS = f"WITH {WEEKDAYS} SELECT *, row_number() OVER (ORDER BY perf DESC, day_of_week DESC) - 1 AS id FROM weekdays"
SERVED_AIRPORTS = f"""WITH {POPULARITY}
 SELECT *, row_number() OVER (ORDER BY popularity DESC, airport DESC) - 1 AS id, 0 AS grp FROM popularity
 ORDER BY popularity DESC, airport DESC LIMIT 10"""
LAST_EVENTS = """SELECT user_id, event_type, event_id, value FROM events
     QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1"""
FOUND_TRIPS = f"WITH {TRIPS} SELECT * FROM found"
ONE_WORD = lambda *names: ", ".join(f"replace({name}, ' ', '_') AS {name}" for name in names)
SERVED_FROM = f"""WITH {FROM_ORIGIN}, {AIRPORTS},
 served AS (SELECT origin, airline_id AS from_airline, perf,
  row_number() OVER (ORDER BY perf DESC, origin, airline_id DESC) - 1 AS id FROM ranked WHERE rank <= 10)"""
SERVED_BETWEEN = f"""WITH {BETWEEN}, {PAIRS},
 served AS (SELECT origin, dest, airline_id AS airline, perf,
  row_number() OVER (ORDER BY perf DESC, origin, dest, airline_id DESC) - 1 AS id FROM ranked WHERE rank <= 10)"""

ORACLES: dict[str, str] = {
    "airport_popularity": f"WITH {POPULARITY} SELECT * FROM popularity",
    "top_airports": TOP_AIRPORTS,
    "rank_airports_full": f"WITH {POPULARITY} SELECT *, "
                          "row_number() OVER (ORDER BY popularity DESC, airport DESC) - 1 AS id FROM popularity",
    "ontime_by_weekday": f"WITH {WEEKDAYS} SELECT * FROM weekdays",
    "rank_weekdays": RANKED_DAYS,
    "ontime_by_origin_airline": f"WITH {FROM_ORIGIN} SELECT * FROM rates",
    "top_airlines_from_x": TOP_FROM,
    "ontime_by_pair_airline": f"WITH {BETWEEN} SELECT * FROM rates",
    "top_airlines_xy": TOP_BETWEEN,
    "mean_delay_pair": f"WITH {DELAYS} SELECT * FROM delays",
    "semi_origin_list": f"WITH {FLIGHTS}, {AIRPORTS} SELECT origin, flight_id FROM flights "
                        "WHERE origin IN (SELECT origin FROM airports)",
    "semi_pair_list": f"WITH {FLIGHTS}, {PAIRS} SELECT origin, dest, flight_id FROM flights "
                      "JOIN pairs USING (origin, dest)",
    "trip_request_legs": f"WITH {REQUESTS} SELECT * FROM legs",
    "trip_leg_candidates": f"""WITH {REQUESTS}
     SELECT leg, origin, dest, flight_date, dep_time, arr_time, flight_id
     FROM (SELECT DISTINCT leg, origin, dest, flight_date FROM legs) JOIN flights USING (origin, dest, flight_date)
     WHERE (leg = 0 AND dep_time <= 1200) OR (leg = 1 AND dep_time >= 1200)""",
    "trip_leg_best": f"WITH {TRIPS} SELECT * EXCLUDE (pick) FROM best",
    "trip_best": FOUND_TRIPS,
    "zipf_compare": f"""WITH {POPULARITY},
     ranked AS (SELECT *, row_number() OVER (ORDER BY popularity DESC, airport DESC) AS rank FROM popularity),
     zipf AS (SELECT *, max(popularity) OVER () / rank AS zipf, sum(ln(rank)) OVER (ORDER BY rank) AS lf FROM ranked)
     SELECT airport, popularity, rank, round(zipf, 9) AS zipf,
      round((popularity - min(popularity) OVER ()) / (max(popularity) OVER () - min(popularity) OVER ()), 9) AS popularity_scaled,
      round((zipf - min(zipf) OVER ()) / (max(zipf) OVER () - min(zipf) OVER ()), 9) AS zipf_scaled,
      round(0.5 * pow(0.5, rank), 9) AS geometric,
      round(exp(-0.999 + rank * ln(0.999) - lf), 9) AS poisson
     FROM zipf""",

    "src_flight_csv": f"WITH {FLIGHTS} {FULL_FLIGHT}",
    "src_manifest": f"""WITH {FLIGHTS} SELECT origin, dest, count(*) AS flights,
     CAST(sum(arr_delay_minutes) AS BIGINT) AS delay FROM flights GROUP BY origin, dest""",
    "src_flight_rejects": f"""WITH {FLIGHTS} SELECT CAST(year(flight_date) AS VARCHAR) AS year,
     CASE CAST(split_part(flight_id, '-', 1) AS BIGINT) % 10 WHEN 0 THEN 'blank' WHEN 1 THEN 'short' WHEN 2 THEN 'unreadable'
      ELSE 'good' END AS verdict, count(*) AS n FROM flights GROUP BY ALL""",
    "clean_project": f"WITH {FLIGHTS} {FULL_FLIGHT}",
    "src_double_colon": "SELECT p_partkey AS movie_id, p_name || ', again' AS title, p_type AS genres FROM part",

    "params_key_list": TOP_FROM,
    "params_pair_list": f"""WITH {DELAYS}, {PAIRS} SELECT {ONE_WORD("origin", "dest")}, mean_delay
     FROM delays JOIN pairs USING (origin, dest)""",
    "params_trip_requests": f"""WITH {TRIPS} SELECT * REPLACE ({ONE_WORD("origin1", "dest1", "origin2", "dest2")}) FROM found""",
    "src_ratings": """SELECT o_custkey AS user_id, l_partkey AS movie_id, 1 + CAST(l_quantity AS INT) % 5 AS rating
     FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     QUALIFY row_number() OVER (PARTITION BY o_custkey, l_partkey ORDER BY CAST(l_shipdate AS DATE) DESC, rating DESC) = 1""",
    "src_labeled_points": """SELECT CAST(p_size AS DOUBLE) AS x1, CAST(p_retailprice AS DOUBLE) AS x2,
     CAST(p_size > 25 AS DOUBLE) AS label FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)""",
    "src_titled_points": """SELECT p_name || ', again' AS title, CAST(p_size AS DOUBLE) AS x1,
     CAST(p_retailprice AS DOUBLE) AS x2 FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)""",

    "snk_tsv_roundtrip": f"WITH {POPULARITY} SELECT * FROM popularity",
    "serving_top_airports": SERVED_AIRPORTS,
    "serving_perf_days": f"SELECT *, 0 AS grp FROM ({RANKED_DAYS})",
    "serving_topfromx": f"""WITH {FROM_ORIGIN} SELECT origin, airline_id AS from_airline, perf,
     row_number() OVER (ORDER BY perf DESC, origin, airline_id DESC) - 1 AS id FROM ranked WHERE rank <= 10""",
    "serving_topxy": f"""WITH {BETWEEN} SELECT origin, dest, airline_id AS airline, perf,
     row_number() OVER (ORDER BY perf DESC, origin, dest, airline_id DESC) - 1 AS id FROM ranked WHERE rank <= 10""",
    "serving_mean": f"""WITH {DELAYS} SELECT *,
     row_number() OVER (ORDER BY mean_delay DESC, origin, dest) - 1 AS id FROM delays""",
    "serving_findflight": FOUND_TRIPS,
    "serving_zipf": f"""WITH {POPULARITY} SELECT *,
     row_number() OVER (ORDER BY popularity DESC, airport DESC) - 1 AS id, 0 AS grp FROM popularity""",
    "serving_select_topairports": SERVED_AIRPORTS,
    "serving_read_topfromx": f"{SERVED_FROM} SELECT * FROM served WHERE origin IN (SELECT origin FROM airports)",
    "serving_read_topxy": f"{SERVED_BETWEEN} SELECT served.* FROM served JOIN pairs USING (origin, dest)",
    "load_whitespace_table": f"""WITH {FLIGHTS} SELECT CAST(flight_date AS VARCHAR) AS date1, origin AS origin1,
     dest AS destination1, CAST(arr_time AS VARCHAR) AS arr_time1, flight_id AS flight_id1 FROM flights""",
    "load_table_last_write": """SELECT CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(event_id AS VARCHAR) AS event_id
     FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id % 2 DESC, event_id DESC) = 1""",
    "upsert_last_write": LAST_EVENTS,
    "stored_upsert": LAST_EVENTS,
    "stored_upsert_get": f"SELECT * FROM ({LAST_EVENTS}) WHERE user_id % 10 = 3",
    "stored_wide_put": f"WITH {CELLS} SELECT * FROM latest",
    "stored_scan_column": f"WITH {CELLS} SELECT row_key, value FROM latest WHERE family = 'click' AND qualifier = 'k'",
    "stored_scan_range": f"WITH {CELLS} SELECT * FROM latest WHERE row_key >= 'row00010' AND row_key < 'row00100'",
    "stored_point_get": f"WITH {CELLS} SELECT * FROM latest WHERE row_key = 'row00010'",
    "publish_lines": r"""SELECT line, count(*) AS n
     FROM (SELECT unnest(string_split_regex(text, '\r\n|\r|\n')) AS line FROM documents) WHERE line <> '' GROUP BY line""",
    "wide_put_latest": f"WITH {CELLS} SELECT row_key, {_FAMILY_COLUMNS} FROM latest GROUP BY row_key",
    "wide_scan_column": f"WITH {CELLS} SELECT row_key, value FROM latest WHERE family = 'click' AND qualifier = 'k'",
    "wide_scan_range": f"WITH {CELLS} SELECT * FROM latest WHERE row_key >= 'row00010' AND row_key < 'row00100'",

    "tokenize_delimiters": r"""SELECT doc_id, array_to_string(list_filter(
     string_split_regex(text, '[\n\r \t,;.?!\-:@\[\](){}_*/]+'), lambda w: w <> ''), ' ') AS words FROM documents""",
    "tokenize_sentence": f"""SELECT doc_id, array_to_string(list_filter({SENTENCE_SPLIT}, lambda w: w <> ''), ' ')
     AS words FROM documents""",
    "title_word_count": f"WITH {TITLE_WORDS} SELECT * FROM counts",
    "top_titles": f"WITH {TITLE_WORDS} SELECT * FROM top",
    "top_title_stats": f"""WITH {TITLE_WORDS},
     m AS (SELECT CAST(sum(n) AS BIGINT) AS s, min(n) AS lo, max(n) AS hi, count(*) AS c, CAST(sum(n) AS BIGINT) // count(*) AS mean
      FROM top),
     v AS (SELECT CAST(sum((n - mean) * (n - mean)) AS BIGINT) // max(c) AS var FROM top, m)
     SELECT 'Mean' AS name, mean AS value FROM m UNION ALL SELECT 'Sum', s FROM m UNION ALL SELECT 'Min', lo FROM m
     UNION ALL SELECT 'Max', hi FROM m UNION ALL SELECT 'Var', var FROM v""",
    "top_title_stats_exact": f"""WITH {TITLE_WORDS}
     SELECT 'Mean' AS name, round(avg(n), 6) AS value FROM top UNION ALL SELECT 'Sum', CAST(sum(n) AS DOUBLE) FROM top
     UNION ALL SELECT 'Min', CAST(min(n) AS DOUBLE) FROM top UNION ALL SELECT 'Max', CAST(max(n) AS DOUBLE) FROM top
     UNION ALL SELECT 'Var', round(var_pop(n), 6) FROM top""",
    "topn_report": f"""WITH {SPOKEN} SELECT 'top-words = [ ' ||
     string_agg('(' || word || ' , ' || n || ')', ' , ' ORDER BY n DESC, word) || ' ]' AS top_n FROM normal_top""",

    "graph_parse_adjacency": """SELECT src, dst, count(*) AS n FROM (
      SELECT l_orderkey AS src, l_partkey AS dst FROM lineitem UNION ALL SELECT l_orderkey, l_suppkey FROM lineitem)
     GROUP BY src, dst""",
    "graph_vertices": f"WITH {INLINKS} SELECT id FROM pages_",
    "inlink_count": f"WITH {INLINKS} SELECT * FROM inlinks",
    "orphan_pages": f"WITH {INLINKS} SELECT id FROM inlinks WHERE inlinks = 0",
    "top_popular_links": f"WITH {INLINKS} SELECT * FROM inlinks ORDER BY inlinks DESC, id DESC LIMIT 10",
    "rank_line_prices": """SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice,
     rank() OVER (ORDER BY l_extendedprice) - 1 AS rank FROM lineitem""",
    "popularity_league": f"""WITH {INLINKS} SELECT id, rank() OVER (ORDER BY inlinks) - 1 AS rank FROM inlinks
     WHERE id IN (SELECT c_custkey FROM customer)""",
    "graph_components": """WITH homes AS (
      SELECT CAST(r_regionkey AS BIGINT) * 5 AS id, r_regionkey AS home FROM region
      UNION SELECT CAST(n_nationkey AS BIGINT) * 5 + 1, n_regionkey FROM nation
      UNION SELECT s_suppkey * 5 + 2, n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
      UNION SELECT c_custkey * 5 + 3, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey
      UNION SELECT o_orderkey * 5 + 4, n_regionkey FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey)
     SELECT id, min(id) OVER (PARTITION BY home) AS component FROM homes""",
    "graph_sssp": """WITH RECURSIVE edges AS (SELECT p_partkey // 2 AS src, p_partkey AS dst FROM part),
     reach(id, hops) AS (
      SELECT CAST(1 AS BIGINT), 0 UNION ALL SELECT dst, hops + 1 FROM reach JOIN edges ON src = id WHERE src <> dst)
     SELECT v.id, hops FROM (SELECT src AS id FROM edges UNION SELECT dst FROM edges) v LEFT JOIN reach r ON v.id = r.id""",

    "distinct_users": "SELECT count(DISTINCT o_custkey) AS users FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "user_index": """SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_index
     FROM (SELECT DISTINCT o_custkey AS user_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "rating_movie_join": f"""WITH {RATINGS} SELECT user_id, movie_id, rating, p_name AS title, p_type AS genres
     FROM ratings JOIN part ON movie_id = p_partkey""",
    "movie_rating_vectors": f"""WITH {RATINGS},
     users AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS i FROM (SELECT DISTINCT user_id FROM ratings))
     SELECT movie_id, i // 512 AS block, string_agg(i || ':' || rating, ' ' ORDER BY i) AS user_rates,
      any_value(p_name) AS title, any_value(p_type) AS genres
     FROM ratings JOIN users USING (user_id) JOIN part ON movie_id = p_partkey GROUP BY movie_id, i // 512""",
    "movie_lookup": """SELECT p_partkey AS movie_id, p_name AS title, p_type AS genres FROM part
     WHERE contains(p_name, 'gizmo') ORDER BY p_partkey LIMIT 1""",
    "movie_similarity": f"""WITH {RATINGS},
     source AS (SELECT user_id, rating AS s FROM ratings WHERE movie_id = 1),
     dots AS (SELECT movie_id, CAST(sum(rating * coalesce(s, 0)) AS BIGINT) AS dot, CAST(sum(rating * rating) AS BIGINT) AS sq
      FROM ratings LEFT JOIN source USING (user_id) GROUP BY movie_id)
     SELECT movie_id, round(dot / (sqrt(sq) * sqrt((SELECT CAST(sum(s * s) AS BIGINT) FROM source))), 9) AS score,
      p_name AS title, p_type AS genres FROM dots JOIN part ON movie_id = p_partkey""",

    "movie_similarity_topk": f"""WITH {RATINGS},
     norms AS (SELECT movie_id, sqrt(CAST(sum(rating * rating) AS BIGINT)) AS norm FROM ratings GROUP BY movie_id),
     dots AS (SELECT a.movie_id, b.movie_id AS other_id, CAST(sum(a.rating * b.rating) AS BIGINT) AS dot
      FROM ratings a JOIN ratings b ON a.user_id = b.user_id AND a.movie_id <> b.movie_id GROUP BY a.movie_id, b.movie_id),
     scored AS (SELECT d.movie_id, other_id, round(dot / (x.norm * y.norm), 9) AS score
      FROM dots d JOIN norms x ON x.movie_id = d.movie_id JOIN norms y ON y.movie_id = other_id)
     SELECT movie_id, CAST(row_number() OVER (PARTITION BY movie_id ORDER BY score DESC, other_id) AS INT) AS rank, other_id, score
     FROM scored QUALIFY rank <= 5""",

    "sql_tokenize_sentence": f"""SELECT doc_id, array_to_string(list_filter({SENTENCE_SPLIT}, lambda w: w <> ''), ' ')
     AS words FROM documents""",
    "sql_ring_position": f"WITH {RING} SELECT key, pos FROM ring_keys",
    "sql_similarity": f"""WITH {RATINGS},
     users AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS i FROM (SELECT DISTINCT user_id FROM ratings)),
     placed AS (SELECT *, i // 512 AS block FROM ratings JOIN users USING (user_id)
      WHERE movie_id IN (SELECT p_partkey FROM part)),
     source AS (SELECT user_id, rating AS s FROM placed WHERE movie_id = 1),
     norms AS (SELECT block, sqrt(CAST(sum(rating * rating) AS BIGINT)) AS norm FROM placed WHERE movie_id = 1 GROUP BY block)
     SELECT movie_id, block, round(CAST(sum(rating * coalesce(s, 0)) AS BIGINT)
      / (sqrt(CAST(sum(rating * rating) AS BIGINT)) * any_value(norm)), 9) AS score
     FROM placed JOIN norms USING (block) LEFT JOIN source USING (user_id) GROUP BY movie_id, block""",

    "stream_top_airports": TOP_AIRPORTS,
    "stream_ontime_weekday": RANKED_DAYS,
    "stream_top_airlines_from_x": TOP_FROM,
    "stream_top_airlines_xy": TOP_BETWEEN,
    "stream_mean_delay": f"WITH {DELAYS}, {PAIRS} SELECT origin, dest, mean_delay FROM delays JOIN pairs USING (origin, dest)",
    "stream_mean_delay_batches": f"WITH {DELAYS}, {PAIRS} SELECT origin, dest, mean_delay FROM delays JOIN pairs USING (origin, dest)",
    "stream_trip_best": FOUND_TRIPS,
    "stream_sensor_alarms": ALARMS,
    "stream_word_count": f"WITH {SPOKEN} SELECT * FROM sentence_counts",
    "stream_word_count_batches": f"WITH {SPOKEN} SELECT * FROM sentence_counts",
    "stream_word_count_normalized": f"WITH {SPOKEN} SELECT * FROM normal_counts",
    "stream_top_words": f"WITH {SPOKEN} SELECT * FROM normal_top",
    "stream_heartbeat_status": f"WITH {HEARTBEATS} SELECT * FROM status",
    "stream_failure_transitions": """WITH
     beats AS (SELECT user_id AS member, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS tick, max(event_id) AS heartbeat FROM events
      GROUP BY ALL),
     steps AS (SELECT *, max(heartbeat) OVER (PARTITION BY member ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      AS before FROM beats),
     advances AS (SELECT member, tick, heartbeat, lag(tick) OVER w AS previous, lead(tick) OVER w AS following
      FROM steps WHERE before IS NULL OR heartbeat > before WINDOW w AS (PARTITION BY member ORDER BY tick)),
     transitions AS (
      SELECT member, tick, 'alive' AS status, heartbeat FROM advances WHERE previous IS NULL OR previous + 6 < tick
      UNION ALL SELECT member, tick + 6, 'suspect', heartbeat FROM advances WHERE following IS NULL OR tick + 6 < following
      UNION ALL SELECT member, tick + 26, 'removed', heartbeat FROM advances WHERE following IS NULL OR tick + 26 < following)
     SELECT * FROM transitions WHERE tick <= (SELECT max(tick) FROM beats) - 12""",
    "stream_batch_counts": "SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS records FROM events",
    "stream_changelog_audit": f"WITH {AUDIT} SELECT * FROM audit WHERE seq <= (SELECT max(seq) FROM log) - 100",
    "stream_changelog_state": f"""WITH {CHANGES.replace("FROM events", "FROM events WHERE event_id <= (SELECT max(event_id) FROM events) - 100")},
     {CHANGED_STATE}""",

    "sensor_alarms": ALARMS,
    "changelog_state": f"WITH {CHANGES}, {CHANGED_STATE}",
    "changelog_audit": f"WITH {AUDIT} SELECT * FROM audit",
    "changelog_audit_counts": f"WITH {AUDIT} SELECT op, success, count(*) AS n FROM audit GROUP BY op, success",
    "quorum_read": f"""WITH {COPIES},
     votes AS (SELECT key, value, count(*) AS n FROM copies WHERE value IS NOT NULL GROUP BY key, value)
     SELECT k.key, v.value, v.value IS NOT NULL AS success FROM (SELECT DISTINCT key FROM copies) k
     LEFT JOIN votes v ON k.key = v.key AND n >= 2""",
    "quorum_write": f"""WITH {COPIES} SELECT key, count(value) AS acks, count(value) >= 2 AS success
     FROM copies GROUP BY key""",
    "ring_placement": f"WITH {RING} SELECT key, CAST(replica AS INT) AS replica, node FROM placed WHERE replica < 3",
    "ring_balance": f"""WITH {RING} SELECT s.node, count(key) FILTER (WHERE replica = 0) AS keys, count(key) AS copies
     FROM (SELECT DISTINCT node FROM spots) s LEFT JOIN placed p ON p.node = s.node AND replica < 3 GROUP BY s.node""",
    "heartbeat_status": f"WITH {HEARTBEATS} SELECT * FROM status",
    "membership_audit": f"""WITH {MEMBERSHIP} SELECT member, joined_by, removed_by, failed, peers, joined_by >= others AS introduced,
     NOT failed OR removed_by >= peers AS complete, failed OR removals = 0 AS accurate FROM with_peers""",
}
