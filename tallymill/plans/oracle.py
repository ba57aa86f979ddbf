"""DuckDB SQL for the same results as the queries, written independently of the operators' plans."""

from __future__ import annotations

from tallymill.functions.hashing import PRIME, coefficients
from tallymill.plans import catalog, tables

# What the cleaned text keeps besides letters, spelled out because \s is narrower in RE2.
SPACE = r"\t\n\v\f\r "
CLEAN = rf"regexp_replace(lower(text), '[^a-z{SPACE}]', '', 'g')"
TOPIC_LIST = ", ".join(f"'{t}'" for t in tables.TOPICS)


def _per_measure(select: str) -> str:
    return " UNION ALL ".join(select.format(c=c) for c in catalog.MEASURES)


COLUMN_SUMMARY = _per_measure(
    "SELECT '{c}' AS \"column\", min({c}) AS min, max({c}) AS max, count({c}) AS n FROM lineitem"
)
COLUMN_MOMENTS = _per_measure(
    "SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std FROM lineitem"
)
MINMAX_NORMALIZE = "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(({c} - min({c}) OVER ()) / nullif(max({c}) OVER () - min({c}) OVER (), 0), 6) AS {c}_norm"
    for c in catalog.MEASURES
) + " FROM lineitem"

WORDS = f"""words AS (
  SELECT doc_id, lang AS topic, DATE '2015-11-01' + (doc_id % 30)::INT AS day,
         unnest(string_split({CLEAN}, ' ')) AS word
  FROM documents WHERE text IS NOT NULL)"""
WORD_COUNT_TOTAL = f"""
SELECT word, count(*) AS n FROM (SELECT unnest(string_split({CLEAN}, ' ')) AS word FROM documents) GROUP BY word"""
WORD_COUNT_BY_DAY = f"WITH {WORDS} SELECT day::DATE AS day, word, count(*) AS n FROM words GROUP BY ALL"
WORD_COUNT_BY_TOPIC = f"""
WITH {WORDS} SELECT topic, word, count(*) AS n FROM words WHERE topic IN ({TOPIC_LIST}) GROUP BY ALL"""
TOP = f"""top AS (
  SELECT topic, word, count(*) AS n, row_number() OVER (PARTITION BY topic ORDER BY count(*) DESC, word) AS rank
  FROM words WHERE topic IN ({TOPIC_LIST}) GROUP BY topic, word QUALIFY rank <= {catalog.TOP_WORDS})"""
TOP_WORDS = f"WITH {WORDS}, {TOP} SELECT topic, word, n, rank::INT AS rank FROM top"
COOCCURRENCE = f"""
WITH {WORDS}, {TOP}, kept AS (
  SELECT doc_id, topic, word, count(*) AS m FROM words SEMI JOIN top USING (topic, word) GROUP BY ALL)
SELECT a.topic, a.word AS word_a, b.word AS word_b, sum(a.m * b.m)::BIGINT AS n
FROM kept a JOIN kept b ON a.doc_id = b.doc_id AND a.topic = b.topic GROUP BY ALL"""


def _matrix() -> str:
    listed = ", ".join(f"'{w}'" for w in catalog.MATRIX_WORDS)
    cells = ", ".join(
        f"coalesce(sum(a.m * b.m) FILTER (WHERE b.word = '{w}'), 0)::BIGINT AS \"{w}\"" for w in catalog.MATRIX_WORDS
    )
    return f"""
WITH {WORDS}, kept AS (
  SELECT doc_id, word, count(*) AS m FROM words
  WHERE topic = '{catalog.MATRIX_TOPIC}' AND word IN ({listed}) GROUP BY ALL)
SELECT a.word AS word, {cells} FROM kept a JOIN kept b USING (doc_id) GROUP BY a.word"""


CASES = f"""words AS (
  SELECT doc_id, "case", topic, unnest(string_split({CLEAN}, ' ')) AS word
  FROM (SELECT doc_id, lang AS topic, 'Title' AS "case", split_part(text, chr(10), 1) AS text FROM documents
        UNION ALL SELECT doc_id, lang, 'Headline', text FROM documents)),
top AS (
  SELECT "case", topic, word, row_number() OVER (PARTITION BY "case", topic ORDER BY count(*) DESC, word) AS rank
  FROM words WHERE topic IN ({TOPIC_LIST}) AND word IS NOT NULL GROUP BY "case", topic, word QUALIFY rank <= {catalog.TOP_WORDS})"""


def _matrices() -> str:
    """Row words against column words by rank, from the plain self-join of all occurrences in a document."""
    cells = ", ".join(f"coalesce(sum(a.m * b.m) FILTER (WHERE b.rank = {r}), 0)::BIGINT AS n{r}" for r in range(1, catalog.TOP_WORDS + 1))
    return f"""
WITH {CASES}, kept AS (
  SELECT doc_id, "case", topic, word, rank, count(*) AS m FROM words JOIN top USING ("case", topic, word) GROUP BY ALL)
SELECT a."case", a.topic, a.rank::INT AS rank, a.word, {cells}
FROM kept a JOIN kept b ON a.doc_id = b.doc_id AND a."case" = b."case" AND a.topic = b.topic GROUP BY ALL"""


def _headers() -> str:
    named = ", ".join(f"max(word) FILTER (WHERE rank = {r}) AS w{r}" for r in range(1, catalog.TOP_WORDS + 1))
    return f"""WITH {CASES} SELECT "case", topic, {named} FROM top GROUP BY ALL"""


TICKS = f"""ticks AS (
  SELECT entity, block, slot, coalesce(v, 0) AS v
  FROM (SELECT DISTINCT event_type AS entity, date_diff('day', DATE '{tables.FIRST_DAY}', ts::DATE) // 2 AS block FROM events)
  CROSS JOIN (SELECT unnest(range(1, 145)) AS slot)
  LEFT JOIN (
    SELECT event_type AS entity, date_diff('day', DATE '{tables.FIRST_DAY}', ts::DATE) // 2 AS block,
           ((date_diff('day', DATE '{tables.FIRST_DAY}', ts::DATE) % 2) * 72 + hour(ts) * 3 + minute(ts) // 20) + 1 AS slot,
           sum(value) AS v
    FROM events GROUP BY ALL) USING (entity, block, slot))"""


def _hours(stride: int) -> str:
    return f"""hours AS (
  SELECT entity, block, i AS slot, sum(v) / 3 AS avg_hour
  FROM ticks JOIN (SELECT unnest(range(1, (144 - 3) // {stride} + 2)) AS i) ON slot BETWEEN 1 + (i - 1) * {stride} AND 3 + (i - 1) * {stride}
  GROUP BY ALL)"""


def _hourly(stride: int) -> str:
    return f"""WITH {TICKS}, {_hours(stride)}
SELECT entity, block::INT AS block, slot::INT AS slot, round(avg_hour, 6) AS avg_hour FROM hours"""


def _daily(hour_stride: int, stride: int) -> str:
    return f"""WITH {TICKS}, {_hours(hour_stride)}
SELECT entity, block::INT AS block, i::INT AS slot, round(sum(avg_hour) / 24, 6) AS avg_day
FROM hours JOIN (SELECT unnest(range(1, ((144 - 3) // {hour_stride} + 1 - 24) // {stride} + 2)) AS i) ON slot BETWEEN 1 + (i - 1) * {stride} AND 24 + (i - 1) * {stride}
GROUP BY ALL"""


SENTIMENT = """
SELECT lang AS topic, round(sum((quality + toxic) / 2.0), 6)::DOUBLE AS sum, round(avg((quality + toxic) / 2.0), 6) AS mean
FROM documents JOIN labels USING (doc_id) GROUP BY lang"""

SHINGLES = rf"""plain AS (
  SELECT doc_id, string_split(translate(lower(trim(regexp_replace(text, '[{SPACE}]+', ' ', 'g'), ' ')), ',.', ''), ' ') AS w
  FROM documents),
runs AS (
  SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM plain))"""


def _crc_table() -> str:
    """The byte table of CRC-32 (reflected polynomial EDB88320) from its bitwise definition."""
    entries = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 * (value & 1))
        entries.append(str(value))
    return f"[{', '.join(entries)}]::BIGINT[]"


CRC = f"""crc AS (
  SELECT doc_id, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode(run))),
      lambda i: ('0x' || substr(hex(encode(run)), 2 * i + 1, 2))::BIGINT)),
    lambda c, byte: xor(c >> 8, ({_crc_table()})[(xor(c, byte) & 255) + 1])), 4294967295::BIGINT) AS x
  FROM runs),
shingles AS (SELECT DISTINCT doc_id, x AS shingle FROM crc)"""
DOC_SHINGLES = f"WITH {SHINGLES}, {CRC} SELECT doc_id, shingle FROM shingles"
DOC_SHINGLES_MD5 = f"""
WITH {SHINGLES} SELECT DISTINCT doc_id, ('0x' || substr(md5(run), 1, 8))::BIGINT AS shingle FROM runs"""
SHINGLE_DOC_MATRIX = f"WITH {SHINGLES}, {CRC} SELECT shingle, doc_id, 1::INT AS present FROM shingles"


def _minhash(count: int) -> str:
    pairs = ", ".join(f"({i}, {a}::UBIGINT, {b}::UBIGINT)" for i, (a, b) in enumerate(coefficients(count, catalog.SEED)))
    return f"""
WITH {SHINGLES}, {CRC}, pairs(hash_idx, a, b) AS (VALUES {pairs}),
least AS (
  SELECT doc_id, hash_idx, min((a * shingle::UBIGINT + b) % {PRIME}) AS least FROM shingles CROSS JOIN pairs GROUP BY ALL)
SELECT doc_id, hash_idx::INT AS hash_idx, coalesce(least, 0)::BIGINT AS minhash
FROM documents CROSS JOIN pairs LEFT JOIN least USING (doc_id, hash_idx)"""


CORPUS = rf"""
WITH found AS (
  SELECT page_id, regexp_replace(unnest(parts[2:]), '(?is)</html\s*>.*', '') AS record,
         generate_subscripts(parts[2:], 1) - 1 AS position
  FROM (SELECT page_id, string_split_regex(html, '(?i)<html\b[^>]*>') AS parts FROM pages)),
bodies AS (
  SELECT page_id, position::INT AS position,
         replace(replace(replace(replace(replace(regexp_extract(record, '(?is)<title\b[^>]*>([^<]*)', 1),
           '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&amp;', '&') AS body
  FROM found),
plain AS (SELECT *, trim(regexp_replace(body, '[{SPACE}]+', ' ', 'g'), ' ') AS settled FROM bodies)
SELECT page_id, position, body, translate(lower(settled), ',.', '') AS words,
       CASE WHEN settled = '' THEN 0 ELSE len(string_split(settled, ' ')) END::INT AS n_words
FROM plain"""

AVERAGE_RATING = """
SELECT p_partkey, p_name, round(avg(l_quantity), 6) AS average
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL"""


def _similarity(entity: str, dimension: str) -> str:
    return f"""
WITH cells AS (
  SELECT {entity} AS e, {dimension} AS d, sum(l_quantity) AS v FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
own AS (SELECT d, v FROM cells WHERE e = {catalog.TARGET}),
norms AS (SELECT e, sqrt(sum(v * v)) AS norm FROM cells GROUP BY e),
dots AS (SELECT e, sum(cells.v * own.v) AS dot FROM cells JOIN own USING (d) GROUP BY e)
SELECT e AS {'user' if entity == 'o_custkey' else 'item'},
       round(coalesce(dot, 0) / (norm * (SELECT norm FROM norms WHERE e = {catalog.TARGET})), 9) AS similarity
FROM norms LEFT JOIN dots USING (e)"""


OUT_DEGREE = "SELECT l_partkey AS src, count(DISTINCT l_suppkey) AS degree FROM lineitem GROUP BY l_partkey"
IN_DEGREE = "SELECT l_suppkey AS dst, count(DISTINCT l_partkey) AS degree FROM lineitem GROUP BY l_suppkey"
NODE_LINKS = f"""
SELECT 'out' AS direction, l_suppkey AS neighbour FROM lineitem WHERE l_partkey = {catalog.TARGET}
UNION ALL SELECT 'in', l_partkey FROM lineitem WHERE l_suppkey = {catalog.TARGET}"""
GRAPH_NODES = "SELECT l_partkey AS node FROM lineitem UNION SELECT l_suppkey FROM lineitem"

HIRES = f"""hires AS (
  SELECT (user_id % {tables.ZONES} + 1)::INT AS zone, ts::DATE AS day, hour(ts)::INT AS hour, count(*) AS hires
  FROM events GROUP BY ALL)"""
RIDES_PER_DAY = "SELECT ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL"
DAILY_FEBRUARY = """
SELECT o_orderdate::DATE AS day, count(*) AS hires FROM orders WHERE month(o_orderdate) = 2 GROUP BY ALL"""
RIDES_PER_MONTH = """
SELECT month(o_orderdate)::INT AS month, round(count(*) / count(DISTINCT o_orderdate::DATE), 6) AS per_day
FROM orders GROUP BY ALL"""


def _profile(slot: str, name: str, zone: str = "") -> str:
    return f"""
WITH {HIRES}, sums AS (SELECT {zone} {slot} AS {name}, day, sum(hires) AS hires FROM hires GROUP BY ALL)
SELECT {zone} {name}::INT AS {name}, round(avg(hires), 6) AS mean_hires FROM sums GROUP BY ALL"""


RIDES_PER_ZONE = f"SELECT (user_id % {tables.ZONES} + 1)::INT AS zone, count(*) AS n FROM events GROUP BY ALL"
ZONE_BOUNDS = """
SELECT label AS zone, min(embedding[1]) AS "left", max(embedding[1]) AS "right", min(embedding[2]) AS bottom, max(embedding[2]) AS top
FROM embeddings GROUP BY GROUPING SETS ((label), ())"""
RIDE_TOTALS = f"""
WITH days AS (SELECT ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL),
hourly AS (SELECT hour(ts) AS hour, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL),
profile AS (SELECT hour, avg(n) AS n FROM hourly GROUP BY hour),
zones AS (SELECT user_id % {tables.ZONES} AS zone, count(*) AS n FROM events GROUP BY ALL)
SELECT (SELECT count(*) FROM events) AS total, round((SELECT avg(n) FROM days), 6) AS per_day,
       round((SELECT avg(n) FROM profile), 6) AS per_hour,
       round((SELECT avg(n) FROM zones) / (24 * (SELECT count(*) FROM days)), 6) AS per_zone_hour"""
FORECAST = f"""
WITH {HIRES}, aged AS (SELECT *, date_diff('day', DATE '{tables.FIRST_DAY}', day) AS age FROM hires),
means AS (
  SELECT zone, isodow(day) AS weekday, hour, trunc(avg(hires))::INT AS hires FROM aged WHERE age < {tables.TRAIN_DAYS} GROUP BY ALL)
SELECT ((age * 24 + aged.hour) * {tables.ZONES} + aged.zone)::BIGINT AS test_id, aged.zone, day, aged.hour, means.hires
FROM aged LEFT JOIN means ON means.zone = aged.zone AND means.hour = aged.hour AND means.weekday = isodow(day)
WHERE age >= {tables.TRAIN_DAYS}"""
DATE_SLICE = f"""
WITH {HIRES} SELECT zone, hour, trunc(avg(hires))::INT AS hires FROM hires
WHERE day = DATE '{catalog.SLICE_DAY}' AND zone = {catalog.SLICE_ZONE} AND hour <= {catalog.SLICE_HOUR} GROUP BY ALL"""
_AGED = f"{HIRES}, aged AS (SELECT *, isodow(day) AS weekday, month(day) AS month, date_diff('day', DATE '{tables.FIRST_DAY}', day) AS age FROM hires)"


def _features() -> str:
    """Places of the training values in their order, for features with at most 24 of them."""
    names = ["zone", "hour", "weekday", "month"]
    values = " UNION ".join(f"SELECT '{c}' AS f, {c}::DOUBLE AS v FROM aged WHERE age < {tables.TRAIN_DAYS}" for c in names)
    place = ", ".join(
        f"coalesce((SELECT place FROM known k WHERE k.f = '{c}' AND k.v = aged.{c}), (SELECT max(place) + 1 FROM known k WHERE k.f = '{c}'), aged.{c})::DOUBLE AS {c}_index"
        for c in names
    )
    return f"""
WITH {_AGED}, seen AS ({values}),
known AS (SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) - 1 AS place FROM seen QUALIFY count(*) OVER (PARTITION BY f) <= 24)
SELECT ((age * 24 + aged.hour) * {tables.ZONES} + aged.zone)::BIGINT AS test_id, weekday::INT AS weekday, month::INT AS month, {place}
FROM aged WHERE age >= {tables.TRAIN_DAYS}"""


PROFILE_RMSE = f"""
WITH {_AGED}, means AS (SELECT zone, weekday, hour, avg(hires) AS mean FROM aged WHERE age < {tables.TRAIN_DAYS} GROUP BY ALL)
SELECT count(*) AS n, count(mean) AS seen, round(sqrt(avg(power(mean - hires, 2))), 6) AS rmse
FROM aged LEFT JOIN means USING (zone, weekday, hour) WHERE age >= {tables.TRAIN_DAYS}"""
ZONE_POINTS = "SELECT embedding[1] AS x, embedding[2] AS y FROM embeddings WHERE label = 5"

# Results of the file queries: what the tables give after the change of format.
POWER_FILE = " UNION ALL ".join(
    f"SELECT '{m}' AS \"column\", min({c}::FLOAT)::DOUBLE AS min, max({c}::FLOAT)::DOUBLE AS max, count({c}) AS n FROM lineitem"
    for m, c in zip(["Global_active_power", "Global_reactive_power", "Voltage", "Global_intensity"], catalog.MEASURES)
) + " UNION ALL SELECT 'Sub_metering_1', NULL, NULL, 0"
LINE = f"regexp_replace(text, '[{SPACE}]+', ' ', 'g')"
NEWS_FILE = f"""
WITH cases AS (
  SELECT 'Title' AS "case", lang AS "Topic", {LINE} AS text FROM documents
  UNION ALL SELECT 'Headline', lang, 'He said: "' || {LINE} || '", twice' FROM documents),
words AS (SELECT "case", "Topic", unnest(string_split({CLEAN}, ' ')) AS word FROM cases)
SELECT "case", "Topic", word, count(*) AS n FROM words GROUP BY ALL"""
FEEDBACK_FILES = f"""WITH {TICKS}, {_hours(1)}
SELECT ['Facebook', 'GooglePlus', 'LinkedIn'][block % 3 + 1] AS platform,
       (block * 10 + list_position(['click', 'error', 'purchase', 'signup', 'view'], entity))::INT AS item,
       slot::INT AS slot, round(avg_hour, 6) AS avg_hour FROM hours"""
MOVIE_FILES = """
SELECT p_partkey::BIGINT AS "MovieID", p_name || ', The (1995): ' || p_type || '+' || p_brand AS "Title", round(avg(l_quantity), 6) AS average
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL"""
USER_FILE = """
SELECT c_custkey::BIGINT AS "UserID", c_mktsegment[1] AS "Gender", c_nationkey::INT AS "Age",
       (c_nationkey + c_custkey % 2 * 200)::INT AS "Occupation",
       (c_custkey + 10000)::INT AS zip FROM customer"""
EDGE_FILE = "SELECT l_partkey::BIGINT AS src, count(DISTINCT l_suppkey) AS degree FROM lineitem GROUP BY l_partkey"
GPS_FILE = f"""
SELECT (user_id % {tables.ZONES} + 1)::INT AS zone, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, count(ts) AS n_parsed,
       max(hour(ts))::INT AS last_hour FROM events GROUP BY ALL"""
ARTICLE_FILES = rf"""
SELECT text AS body, translate(lower(trim(regexp_replace(text, '[{SPACE}]+', ' ', 'g'), ' ')), ',.', '') AS words FROM documents"""
WORD_FILES = f"""
WITH {WORDS}, counts AS (SELECT topic, word, count(*) AS n FROM words GROUP BY ALL)
SELECT topic, regexp_replace(word, '[{SPACE}]', '~', 'g') AS word, n FROM counts"""
SIGNATURE_FILES = f"SELECT hash_idx, minhash FROM ({_minhash(16)})"

NEWS_TEXTS = """
SELECT doc_id, split_part(text, chr(10), 1) AS "Title", text AS "Headline", '' AS "Source", lang AS "Topic",
       DATE '2015-11-01' + (doc_id % 30)::INT AS day FROM documents"""
CASE_DAY_FILES = f"""
WITH cases AS (
  SELECT 'Title' AS "case", doc_id, split_part(text, chr(10), 1) AS text FROM documents
  UNION ALL SELECT 'Headline', doc_id, text FROM documents),
words AS (SELECT "case", DATE '2015-11-01' + (doc_id % 30)::INT AS day, unnest(string_split({CLEAN}, ' ')) AS word FROM cases)
SELECT "case", day::DATE AS day, word, count(*) AS n FROM words GROUP BY ALL"""
CASE_TOPIC_FILES = f"""
WITH cases AS (
  SELECT 'Title' AS "case", lang AS topic, split_part(text, chr(10), 1) AS text FROM documents
  UNION ALL SELECT 'Headline', lang, text FROM documents),
words AS (SELECT "case", topic, unnest(string_split({CLEAN}, ' ')) AS word FROM cases WHERE topic IN ({", ".join(f"'{t}'" for t in tables.TOPICS)}))
SELECT "case", topic, word, count(*) AS n FROM words GROUP BY ALL"""
ARTICLE_IDS = "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, text AS body FROM documents"
MATRIX_FILES = f"""
WITH {CASES}, kept AS (
  SELECT doc_id, "case", topic, word, count(*) AS m FROM words SEMI JOIN top USING ("case", topic, word) GROUP BY ALL)
SELECT a."case", a.topic, a.word AS word_a, b.word AS word_b, sum(a.m * b.m)::BIGINT AS n
FROM kept a JOIN kept b ON a.doc_id = b.doc_id AND a."case" = b."case" AND a.topic = b.topic GROUP BY ALL"""
SIGNATURE_MATRIX = f"""
SELECT hash_idx, row_number() OVER (PARTITION BY hash_idx ORDER BY doc_id) - 1 AS position, doc_id, minhash
FROM ({_minhash(catalog.HASHES)})"""
ARTICLE_SIGNATURES = f"""
WITH places AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents)
SELECT hash_idx, position, minhash FROM ({_minhash(catalog.HASHES)}) JOIN places USING (doc_id)"""
_PAIRS = ", ".join(f"({i}, {a}::BIGINT, {b}::BIGINT)" for i, (a, b) in enumerate(coefficients(catalog.HASHES, catalog.SEED)))
COEFFICIENTS = f"""
SELECT hash_idx, min(minhash) AS least, count(*) FILTER (WHERE minhash = 0) AS zeros, a, b
FROM ({_minhash(catalog.HASHES)}) JOIN (SELECT * FROM (VALUES {_PAIRS}) AS p(hash_idx, a, b)) USING (hash_idx) GROUP BY ALL"""
WIDE_AVERAGES = f"""
SELECT 'hour' AS kind, entity, block, slot, avg_hour AS average FROM ({_hourly(1)})
UNION ALL SELECT 'day', entity, block, slot, avg_day FROM ({_daily(1, 1)})"""
LINK_LINES = """
SELECT coalesce(string_agg(l_suppkey::VARCHAR, ',' ORDER BY l_suppkey), '') AS value FROM lineitem WHERE l_partkey = 1
UNION ALL SELECT coalesce(string_agg(l_partkey::VARCHAR, ',' ORDER BY l_partkey), '') FROM lineitem WHERE l_suppkey = 1"""


def oracle_sql() -> dict[str, str]:
    return {
        "column_summary": COLUMN_SUMMARY,
        "column_moments": COLUMN_MOMENTS,
        "minmax_normalize": MINMAX_NORMALIZE,
        "word_count_total": WORD_COUNT_TOTAL,
        "word_count_by_day": WORD_COUNT_BY_DAY,
        "word_count_by_topic": WORD_COUNT_BY_TOPIC,
        "popularity_hourly": _hourly(1),
        "popularity_hourly_disjoint": _hourly(3),
        "popularity_daily": _daily(1, 1),
        "popularity_daily_disjoint": _daily(3, 24),
        "sentiment_by_topic": SENTIMENT,
        "top_words_by_topic": TOP_WORDS,
        "cooccurrence": COOCCURRENCE,
        "cooccurrence_matrix": _matrix(),
        "cooccurrence_matrices": _matrices(),
        "cooccurrence_headers": _headers(),
        "doc_shingles": DOC_SHINGLES,
        "doc_shingles_md5": DOC_SHINGLES_MD5,
        "shingle_doc_matrix": SHINGLE_DOC_MATRIX,
        "minhash_signatures": _minhash(catalog.HASHES),
        "corpus_documents": CORPUS,
        "average_rating": AVERAGE_RATING,
        "user_similarity": _similarity("o_custkey", "l_partkey"),
        "item_similarity": _similarity("l_partkey", "o_custkey"),
        "out_degree": OUT_DEGREE,
        "in_degree": IN_DEGREE,
        "node_links": NODE_LINKS,
        "graph_nodes": GRAPH_NODES,
        "rides_per_day": RIDES_PER_DAY,
        "daily_hires_in_february": DAILY_FEBRUARY,
        "rides_per_month": RIDES_PER_MONTH,
        "weekday_profile": _profile("isodow(day)", "weekday"),
        "weekday_profile_by_zone": _profile("isodow(day)", "weekday", "zone,"),
        "hour_profile": _profile("hour", "hour"),
        "hour_profile_by_zone": _profile("hour", "hour", "zone,"),
        "rides_per_zone": RIDES_PER_ZONE,
        "zone_bounds": ZONE_BOUNDS,
        "ride_totals": RIDE_TOTALS,
        "profile_forecast": FORECAST,
        "date_slice_profile": DATE_SLICE,
        "forest_features": _features(),
        "profile_rmse": PROFILE_RMSE,
        "zone_points": ZONE_POINTS,
        "power_file_summary": POWER_FILE,
        "news_file_word_counts": NEWS_FILE,
        "feedback_files_hourly": FEEDBACK_FILES,
        "movie_files_average_rating": MOVIE_FILES,
        "user_file_ages": USER_FILE,
        "edge_file_degrees": EDGE_FILE,
        "hire_files_forecast": FORECAST,
        "gps_file_rides": GPS_FILE,
        "zone_file_bounds": ZONE_BOUNDS,
        "article_files_documents": ARTICLE_FILES,
        "word_files_by_topic": WORD_FILES,
        "top_word_file": TOP_WORDS,
        "degree_files_sorted": IN_DEGREE,
        "signature_files": SIGNATURE_FILES,
        "link_files": NODE_LINKS,
        "news_file_texts": NEWS_TEXTS,
        "word_files_by_case_and_day": CASE_DAY_FILES,
        "word_files_by_case_and_topic": CASE_TOPIC_FILES,
        "article_file_signatures": ARTICLE_SIGNATURES,
        "article_file_ids": ARTICLE_IDS,
        "matrix_files": MATRIX_FILES,
        "signature_matrix_files": SIGNATURE_MATRIX,
        "wide_average_files": WIDE_AVERAGES,
        "link_lines": LINK_LINES,
        "word_count_file": WORD_COUNT_TOTAL,
        "signature_coefficients": COEFFICIENTS,
        "edge_file_in_degrees": IN_DEGREE,
        "edge_file_links": NODE_LINKS,
        "rating_file_user_similarity": _similarity("o_custkey", "l_partkey"),
        "rating_file_item_similarity": _similarity("l_partkey", "o_custkey"),
    }
