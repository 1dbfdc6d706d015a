"""DuckDB twins of the catalogue queries (the correctness oracle).

Each query is ``WITH <needed CTEs> <select>`` over the driver's views
(``events``, ``nation``). The CTEs rebuild the feed lines with the same rules
as ``sources/adapters.py`` and parse them the way ``sources/parse.py`` does,
so both engines see identical text.
"""

from __future__ import annotations

import re

TAB = "chr(9)"

# name -> SQL body. Order matters only for readability; dependencies are
# resolved from the names each body mentions.
CTES: dict[str, str] = {}
QUERIES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


def q(name: str, body: str) -> None:
    QUERIES[name] = body.strip()


def _deps(body: str, seen: list[str], visiting: frozenset = frozenset()) -> None:
    for name in CTES:
        if name not in seen and name not in visiting and re.search(rf"\b{name}\b", body):
            _deps(CTES[name], seen, visiting | {name})
            if name not in seen:
                seen.append(name)


def render(name: str) -> str:
    body = QUERIES[name]
    need: list[str] = []
    _deps(body, need)
    if not need:
        return body
    withs = ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in need)
    return f"WITH {withs}\n{body}"


def all_sql() -> dict[str, str]:
    return {n: render(n) for n in QUERIES}


# ---- feed lines (FIXTURES.md section 3) -----------------------------------

cte("base", """
SELECT event_id AS id, user_id AS u, event_type,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS t,
       epoch_us(ts) // 1000 AS ms
FROM events
""")

cte("register_base", "SELECT * FROM base WHERE event_type = 'signup'")

cte("register_feed", f"""
SELECT id AS pos, concat_ws({TAB}, u, id % 4, t) AS value FROM register_base
UNION ALL SELECT id, concat_ws({TAB}, u, id % 4) FROM register_base WHERE id % 17 = 0
UNION ALL SELECT id, concat_ws({TAB}, u, id % 4, '') FROM register_base WHERE id % 19 = 0
UNION ALL SELECT id, concat_ws({TAB}, u, '', t) FROM register_base WHERE id % 23 = 0
""")

cte("qz_feed", f"""
SELECT id AS pos, concat_ws({TAB}, u, 501 + id % 2, 10 + k % 3, k,
       CASE WHEN event_type IN ('purchase', 'view') THEN '1' ELSE '0' END, t) AS value FROM base
UNION ALL SELECT id, concat_ws({TAB}, u, 501 + id % 2) FROM base WHERE id % 17 = 0
UNION ALL SELECT id, concat_ws({TAB}, u, '501', '10', k, '1', '') FROM base WHERE id % 19 = 0
UNION ALL SELECT id, concat_ws({TAB}, 'x', 501 + id % 2, 10 + k % 3, k, '1', t) FROM base WHERE id % 23 = 0
""")

cte("page_base", """
SELECT id AS pos, u, page, '{"uid":"' || u || '","app_id":"' || (id % 2 + 1) || '","device_id":"' || (id % 50)
       || '","ip":"10.' || (u % 256) || '.' || (id % 256) || '.1","last_page_id":"' || (page - 1)
       || '","page_id":"' || page || '","next_page_id":"' || (page + 1) || '"}' AS line
FROM (SELECT *, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 END AS page
      FROM base)
WHERE page IS NOT NULL
""")

cte("page_feed", """
SELECT pos, line AS value FROM page_base
UNION ALL SELECT pos, 'not json' FROM page_base WHERE pos % 29 = 0
UNION ALL SELECT pos, '[1]' FROM page_base WHERE pos % 31 = 0
UNION ALL SELECT pos, '' FROM page_base WHERE pos % 37 = 0
UNION ALL SELECT pos, '{"uid":"' || u || '","page_id":' || page || '}' FROM page_base WHERE pos % 41 = 0
UNION ALL SELECT pos, line || ' x' FROM page_base WHERE pos % 43 = 0
UNION ALL SELECT pos, line || '] junk' FROM page_base WHERE pos % 53 = 0
""")

cte("learn_base", """
SELECT id, ms,
  '{"uid":' || u || ',"cwareid":' || (id % 4) || ',"videoid":' || (id % 5)
    || ',"chapterid":' || (id % 10) AS head,
  ',"edutypeid":' || (id % 3 + 1) AS edu,
  ',"subjectid":' || (id % 6) || ',"sourceType":"'
    || CASE id % 3 WHEN 0 THEN 'PC' WHEN 1 THEN 'APP' ELSE 'Other' END
    || '","speed":' || (id % 2 + 1) AS mid,
  ',"ts":' || ms || ',"te":' || (ms + (id * 7919) % 90000) AS times,
  ',"ps":' || ((id * 37) % 600) || ',"pe":' || ((id * 37) % 600 + (id * 13) % 61) || '}' AS tail,
  (id * 37) % 600 AS ps, u,
  CASE id % 3 WHEN 0 THEN 'PC' WHEN 1 THEN 'APP' ELSE 'Other' END AS source
FROM base
""")

cte("learn_feed", """
SELECT id AS pos, head || edu || mid || times || tail AS value FROM learn_base
UNION ALL SELECT id, 'not json' FROM learn_base WHERE id % 29 = 0
UNION ALL SELECT id, head || edu || mid || tail FROM learn_base WHERE id % 31 = 0
UNION ALL SELECT id, head || mid || times || tail FROM learn_base WHERE id % 37 = 0
UNION ALL SELECT id, '{"uid":"' || u || '","cwareid":"' || (id % 4) || '","videoid":"' || (id % 5)
    || '","chapterid":"' || (id % 10) || '","edutypeid":"' || (id % 3 + 1) || '","subjectid":"' || (id % 6)
    || '","sourceType":"' || source || '","speed":"' || (id % 2 + 1) || '","ts":"' || ms || '","te":"'
    || (ms + (id * 7919) % 90000) || '","ps":' || ps || '.5,"pe":' || (ps + 20) || '}'
  FROM learn_base WHERE id % 41 = 0
UNION ALL SELECT id, head || edu || mid || times || tail || ' x' FROM learn_base WHERE id % 43 = 0
UNION ALL SELECT id, head || edu || mid || times || ',"ps":' || (ps + 30) || ',"pe":' || (ps + 10) || '}'
  FROM learn_base WHERE id % 47 = 0
UNION ALL SELECT id, head || edu || mid || times || tail || ']' FROM learn_base WHERE id % 53 = 0
UNION ALL SELECT id, head || edu || mid || ',"ts":-9223372036854775808,"te":9223372036854775807' || tail
  FROM learn_base WHERE id % 59 = 0
UNION ALL SELECT id, head || edu || mid || times || ',"ps":-2147483648,"pe":1e12}' FROM learn_base WHERE id % 61 = 0
""")

cte("province_range", """
SELECT n_name AS province,
       CAST(10 * 16777216 + n_nationkey * 6 * 65536 AS BIGINT) AS ip_from,
       CAST(10 * 16777216 + (n_nationkey * 6 + 5) * 65536 + 65535 AS BIGINT) AS ip_to
FROM nation
""")

cte("half", "SELECT count(*) / 2 AS half FROM events")

# ---- parsers ---------------------------------------------------------------

cte("register_rows", rf"""
SELECT TRY_CAST(string_split(value, {TAB})[1] AS INTEGER) AS uid,
       CASE string_split(value, {TAB})[2] WHEN '1' THEN 'PC' WHEN '2' THEN 'APP'
            ELSE 'Other' END AS channel,
       string_split(value, {TAB})[3] AS createtime
FROM register_feed
WHERE len(string_split(regexp_replace(value, '\t+$', ''), {TAB})) = 3
""")

# ---- registrations ---------------------------------------------------------

q("replay_register_lines", "SELECT value AS line FROM register_feed")

q("register_valid_rows", "SELECT uid, channel, createtime FROM register_rows")

q("register_channel_total",
  "SELECT channel, count(*) AS n FROM register_rows GROUP BY channel")

q("register_channel_window", """
SELECT CAST(w * 6 AS BIGINT) AS window_start, channel, CAST(sum(n) AS BIGINT) AS n
FROM (
  SELECT pane, channel, count(*) AS n
  FROM (SELECT channel,
               CAST(floor(epoch(try_strptime(createtime, '%Y-%m-%d %H:%M:%S')) / 6) AS BIGINT) AS pane
        FROM register_rows)
  WHERE pane IS NOT NULL
  GROUP BY pane, channel) p,
  LATERAL (SELECT unnest(range(p.pane - 9, p.pane + 1)) AS w) ws
GROUP BY w, channel
""")

# ---- watch time (J5) -------------------------------------------------------

def _whole_sql(field: str, kind: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST(json_extract_string(value, '$.{field}') AS DOUBLE)) AS {kind})"


LEARN_INTS = ("uid", "cwareid", "videoid", "chapterid", "edutypeid", "subjectid", "speed", "ps", "pe")
LEARN_COLS = ", ".join(
    [f"coalesce({_whole_sql(f, 'INTEGER')}, 0) AS {f}" for f in LEARN_INTS]
    + ["json_extract_string(value, '$.sourceType') AS sourcetype"]
    + [f"{_whole_sql(f, 'BIGINT')} AS {f}" for f in ("ts", "te")])
# numbers beyond their bounds: 32 bits, a thousand million seconds of video, the year 9999
LEARN_BEYOND = " OR ".join(
    f"coalesce(trunc(TRY_CAST(json_extract_string(value, '$.{f}') AS DOUBLE)) NOT BETWEEN {low} AND {high}, false)"
    for low, high, fields in ((-2147483648, 2147483647, LEARN_INTS[:-2]), (-1000000000, 1000000000, ("ps", "pe")),
                              (0, 253402300799999, ("ts", "te")))
    for f in fields)


def _json_objects(feed: str) -> str:
    """Rows whose text is a JSON object, as ``value`` (others dropped). The
    CASE keeps every JSON function off malformed text, whatever the order
    DuckDB evaluates filter and projection in."""
    return f"""
SELECT value FROM (
  SELECT CASE WHEN json_valid(value) THEN
              CASE WHEN json_type(value) = 'OBJECT' THEN value END END AS value
  FROM {feed})
WHERE value IS NOT NULL"""


def _learn_rows_sql(feed: str) -> str:
    return f"""
SELECT *, (te - ts) // 1000 AS secs FROM (
  SELECT {LEARN_COLS}
  FROM ({_json_objects(feed)})
  WHERE NOT ({LEARN_BEYOND}))
WHERE ts IS NOT NULL AND te IS NOT NULL"""


cte("learn_rows", _learn_rows_sql("learn_feed"))
cte("learn_hist_feed", "SELECT l.* FROM learn_feed l, half WHERE l.pos < half.half")
cte("learn_batch_feed", "SELECT l.* FROM learn_feed l, half WHERE l.pos >= half.half")
cte("learn_hist_rows", _learn_rows_sql("learn_hist_feed"))
cte("learn_batch_rows", _learn_rows_sql("learn_batch_feed"))

WKEY = "userid, cwareid, videoid"


def _watch_ctes(name: str, rows: str, history: str | None = None) -> None:
    """Plays second by second, an independent form: a second belongs to the
    first play over it that history does not cover."""
    cte(f"{name}_plays", f"""
SELECT row_number() OVER () AS pid, uid AS userid, cwareid, videoid, ps, pe, ts, te, secs FROM {rows}""")
    cte(f"{name}_cells", f"""
SELECT pid, {WKEY}, ps, ts, te, pe, unnest(range(ps, pe)) AS cell FROM {name}_plays WHERE pe > ps""")
    fresh = (f"ANTI JOIN (SELECT DISTINCT {WKEY}, cell FROM {history}_cells) h USING ({WKEY}, cell)"
             if history else "")
    cte(f"{name}_new", f"""
SELECT pid, count(*) AS n FROM (
  SELECT pid, row_number() OVER (PARTITION BY {WKEY}, cell ORDER BY ps, ts, te, pe, pid) AS nth
  FROM {name}_cells {fresh})
WHERE nth = 1 GROUP BY pid""")
    cte(f"{name}_cov", f"""
SELECT *, coalesce(CAST(trunc(CAST(secs AS DOUBLE) / nullif(pe - ps, 0) * new_seconds) AS BIGINT), 0)
          AS effective_seconds
FROM (SELECT p.*, CAST(coalesce(n, 0) AS BIGINT) AS new_seconds
      FROM {name}_plays p LEFT JOIN {name}_new USING (pid))""")


def _intervals_sql(cells: str) -> str:
    """Runs of covered seconds as text, per key."""
    return f"""
SELECT {WKEY}, string_agg(s || '-' || e, ',' ORDER BY s) AS play_interval FROM (
  SELECT {WKEY}, min(cell) AS s, max(cell) + 1 AS e FROM (
    SELECT *, cell - row_number() OVER (PARTITION BY {WKEY} ORDER BY cell) AS run
    FROM (SELECT DISTINCT {WKEY}, cell FROM {cells}))
  GROUP BY {WKEY}, run)
GROUP BY {WKEY}"""


_watch_ctes("w", "learn_rows")
_watch_ctes("wh", "learn_hist_rows")
_watch_ctes("wb", "learn_batch_rows", history="wh")

for _name, _dim in [("learn_by_chapter", "chapterid"), ("learn_by_cware", "cwareid"),
                    ("learn_by_edutype", "edutypeid"), ("learn_by_source", "sourcetype"),
                    ("learn_by_subject", "subjectid")]:
    q(_name, f"SELECT {_dim}, CAST(sum(secs) AS BIGINT) AS totaltime FROM learn_rows GROUP BY {_dim}")

q("learn_rows", "SELECT * FROM learn_rows")

q("learn_rollup", " UNION ALL ".join(
    f"SELECT '{d}' AS dim, CAST({d} AS VARCHAR) AS key, CAST(sum(secs) AS BIGINT) AS totaltime "
    f"FROM learn_rows GROUP BY {d}"
    for d in ("chapterid", "cwareid", "edutypeid", "sourcetype", "subjectid")))

q("play_new_coverage", f"""
SELECT {WKEY}, ps, ts, te, pe, secs, new_seconds, effective_seconds FROM w_cov""")

q("video_watch_detail", f"""
SELECT {WKEY}, CAST(sum(secs) AS BIGINT) AS totaltime,
       CAST(sum(effective_seconds) AS BIGINT) AS effecttime,
       CAST(sum(new_seconds) AS BIGINT) AS completetime
FROM w_cov GROUP BY {WKEY}""")

q("video_intervals", f"""
SELECT {WKEY}, coalesce(play_interval, '') AS play_interval
FROM (SELECT DISTINCT {WKEY} FROM w_plays) LEFT JOIN ({_intervals_sql('w_cells')}) USING ({WKEY})""")

q("video_watch_incremental", f"""
SELECT {WKEY}, t.totaltime, t.effecttime, t.completetime, coalesce(i.play_interval, '') AS play_interval
FROM (SELECT {WKEY}, CAST(sum(secs) AS BIGINT) AS totaltime,
             CAST(sum(effective_seconds) AS BIGINT) AS effecttime,
             CAST(sum(new_seconds) AS BIGINT) AS completetime
      FROM (SELECT * FROM wh_cov UNION ALL SELECT * FROM wb_cov) GROUP BY {WKEY}) t
LEFT JOIN ({_intervals_sql('(SELECT * FROM wh_cells UNION ALL SELECT * FROM wb_cells)')}) i USING ({WKEY})""")

# ---- practice (J3) ---------------------------------------------------------

QKEY = "userid, courseid, pointid"


def _qz_rows_sql(feed: str) -> str:
    return rf"""
SELECT * FROM (
  SELECT TRY_CAST(f[1] AS INTEGER) AS userid, TRY_CAST(f[2] AS INTEGER) AS courseid,
         TRY_CAST(f[3] AS INTEGER) AS pointid, f[4] AS questionid, f[5] AS istrue,
         f[6] AS createtime
  FROM (SELECT string_split(value, {TAB}) AS f FROM {feed}
        WHERE len(string_split(regexp_replace(value, '\t+$', ''), {TAB})) = 6))
WHERE userid IS NOT NULL AND courseid IS NOT NULL AND pointid IS NOT NULL"""


def _per_question_sql(src: str) -> str:
    return f"""
SELECT {QKEY}, questionid, count(*) AS n,
       CAST(sum(CASE WHEN istrue = '1' THEN 1 ELSE 0 END) AS BIGINT) AS r,
       min(createtime) AS first_time
FROM {src} GROUP BY {QKEY}, questionid"""


QORDER = "ORDER BY TRY_CAST(questionid AS BIGINT) NULLS FIRST, questionid"

cte("qz_rows", _qz_rows_sql("qz_feed"))
cte("qz_pq", _per_question_sql("qz_rows"))
cte("qz_hist_feed", "SELECT l.* FROM qz_feed l, half WHERE l.pos < half.half")
cte("qz_batch_feed", "SELECT l.* FROM qz_feed l, half WHERE l.pos >= half.half")
cte("qz_hist_rows", _qz_rows_sql("qz_hist_feed"))
cte("qz_batch_rows", _qz_rows_sql("qz_batch_feed"))
cte("qz_hist_pq", _per_question_sql("qz_hist_rows"))
cte("qz_batch_pq", _per_question_sql("qz_batch_rows"))


def _rates_sql(s: str, c: str, i: str) -> str:
    return (f"CAST({i} AS DOUBLE) / CAST(nullif({s}, 0) AS DOUBLE) AS correct_rate, "
            f"CAST(({i} * 200 + {s}) // nullif({s} * 2, 0) AS DOUBLE) / 100.0 AS correct_rate_2, "
            f"(CAST({c} AS DOUBLE) / 30.0) * (CAST({i} AS DOUBLE) / CAST(nullif({s}, 0) AS DOUBLE))"
            f" AS mastery_rate")


q("qz_valid_rows", "SELECT * FROM qz_rows")

q("qz_question_set", f"""
SELECT {QKEY}, string_agg(questionid, ',' {QORDER}) AS questionids,
       min(first_time) AS createtime
FROM qz_pq GROUP BY {QKEY}""")

q("qz_point_history", f"""
SELECT {QKEY}, string_agg(questionid, ',' {QORDER}) AS questionids, min(first_time) AS createtime,
       (SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') FROM events) AS updatetime
FROM qz_pq GROUP BY {QKEY}""")

q("qz_point_detail", f"""
SELECT {QKEY}, qz_sum, qz_count, qz_istrue, {_rates_sql('qz_sum', 'qz_count', 'qz_istrue')}
FROM (SELECT {QKEY}, CAST(sum(n) AS BIGINT) AS qz_sum, CAST(count(*) AS BIGINT) AS qz_count,
             CAST(sum(r) AS BIGINT) AS qz_istrue
      FROM qz_pq GROUP BY {QKEY})""")

q("qz_latest_attempt", f"""
SELECT {QKEY}, questionid, max(createtime) AS createtime FROM qz_rows
GROUP BY {QKEY}, questionid""")

q("qz_latest_by_answer", f"""
SELECT {QKEY}, questionid, istrue, max(createtime) AS createtime FROM qz_rows
GROUP BY {QKEY}, questionid, istrue""")

q("qz_dedup_rate", f"""
SELECT {QKEY}, done, right_n, CAST(right_n AS DOUBLE) / CAST(done AS DOUBLE) AS right_rate,
       (CAST(done AS DOUBLE) / 30.0) * (CAST(right_n AS DOUBLE) / CAST(done AS DOUBLE)) AS mastery
FROM (SELECT {QKEY}, CAST(count(*) AS BIGINT) AS done,
             CAST(sum(CASE WHEN r > 0 THEN 1 ELSE 0 END) AS BIGINT) AS right_n
      FROM qz_pq GROUP BY {QKEY})""")

q("qz_point_detail_incremental", f"""
SELECT {QKEY}, qz_sum, qz_count, qz_istrue, {_rates_sql('qz_sum', 'qz_count', 'qz_istrue')},
       createtime
FROM (
  SELECT {QKEY}, CAST(sum(n) AS BIGINT) AS qz_sum, CAST(count(DISTINCT questionid) AS BIGINT) AS qz_count,
         CAST(sum(r) AS BIGINT) AS qz_istrue,
         coalesce(min(CASE WHEN side = 0 THEN first_time END),
                  min(CASE WHEN side = 1 THEN first_time END)) AS createtime
  FROM (SELECT *, 0 AS side FROM qz_hist_pq UNION ALL SELECT *, 1 AS side FROM qz_batch_pq)
  GROUP BY {QKEY})""")

# ---- pages (J4) ------------------------------------------------------------

PAGE_FIELDS = ("uid", "app_id", "device_id", "ip", "last_page_id", "page_id", "next_page_id")


def _page_rows_sql(feed: str) -> str:
    cols = ",\n  ".join(f"coalesce(json_extract_string(value, '$.{f}'), '') AS {f}"
                        for f in PAGE_FIELDS)
    return f"SELECT\n  {cols}\nFROM ({_json_objects(feed)})"


def _view_total_sql(src: str) -> str:
    return f"""
SELECT TRY_CAST(page_id AS INTEGER) AS page_id, CAST(count(*) AS BIGINT) AS num
FROM {src} WHERE TRY_CAST(page_id AS INTEGER) IS NOT NULL GROUP BY 1"""


def _pct(a: str, b: str) -> str:
    qq = f"(({a}) * 100) // nullif({b}, 0)"
    r2 = f"((({a}) * 100 - {qq} * ({b})) * 2)"
    return (f"CASE WHEN ({b}) = 0 THEN '0%' ELSE CAST({qq} + CASE WHEN {r2} > ({b}) OR "
            f"({r2} = ({b}) AND {qq} % 2 = 1) THEN 1 ELSE 0 END AS VARCHAR) || '%' END")


IP_NUM = ("CASE WHEN len(string_split(ip, '.')) = 4 AND "
          + " AND ".join(f"TRY_CAST(string_split(ip, '.')[{i}] AS BIGINT) BETWEEN 0 AND 255"
                         for i in range(1, 5))
          + " THEN " + " + ".join(f"TRY_CAST(string_split(ip, '.')[{i}] AS BIGINT) * {m}"
                                   for i, m in zip(range(1, 5), (16777216, 65536, 256, 1)))
          + " END")

cte("page_rows", _page_rows_sql("page_feed"))
cte("page_hist_feed", "SELECT l.* FROM page_feed l, half WHERE l.pos < half.half")
cte("page_batch_feed", "SELECT l.* FROM page_feed l, half WHERE l.pos >= half.half")
cte("page_hist_rows", _page_rows_sql("page_hist_feed"))
cte("page_batch_rows", _page_rows_sql("page_batch_feed"))
cte("page_totals", _view_total_sql("page_rows"))

q("page_valid_rows", "SELECT * FROM page_rows")

q("page_jump_count", """
SELECT last_page_id, page_id, next_page_id, count(*) AS num FROM page_rows
GROUP BY last_page_id, page_id, next_page_id""")

q("page_view_total", "SELECT * FROM page_totals")

q("page_convert_rate", f"""
SELECT t.page_id, t.num,
       CASE WHEN t.page_id = 1 THEN '100%'
            WHEN t.page_id = 2 THEN {_pct('c.n2', 'c.n1')}
            WHEN t.page_id = 3 THEN {_pct('c.n3', 'c.n2')} END AS jump_rate
FROM page_totals t, (
  SELECT CAST(coalesce(sum(CASE WHEN page_id = 1 THEN num END), 0) AS BIGINT) AS n1,
         CAST(coalesce(sum(CASE WHEN page_id = 2 THEN num END), 0) AS BIGINT) AS n2,
         CAST(coalesce(sum(CASE WHEN page_id = 3 THEN num END), 0) AS BIGINT) AS n3
  FROM page_totals) c""")

q("province_clicks_top3", f"""
SELECT r.province, count(*) AS n
FROM (SELECT {IP_NUM} AS ip_num FROM page_rows) p
JOIN province_range r ON p.ip_num BETWEEN r.ip_from AND r.ip_to
GROUP BY r.province ORDER BY n DESC, r.province LIMIT 3""")

cte("nested_range", """
SELECT 'ANY' AS province, CAST(10 * 16777216 AS BIGINT) AS ip_from, CAST(10 * 16777216 + 16777215 AS BIGINT) AS ip_to
UNION ALL SELECT province, ip_from, ip_to FROM province_range
UNION ALL SELECT province || ' CITY', ip_from + 65536, ip_from + 2 * 65536 + 32767 FROM province_range
UNION ALL SELECT province || ' PARK', ip_from + 2 * 65536 + 4096, ip_from + 2 * 65536 + 20479 FROM province_range
UNION ALL SELECT province || ' EDGE', ip_from + 5 * 65536 + 32768, ip_from + 6 * 65536 + 16383 FROM province_range
""")

# of every click the smallest range around it
q("province_clicks_nested", f"""
SELECT province, count(*) AS n FROM (
  SELECT p.id, arg_min(r.province, struct_pack(size := r.ip_to - r.ip_from, f := r.ip_from, p := r.province)) AS province
  FROM (SELECT row_number() OVER () AS id, {IP_NUM} AS ip_num FROM page_rows) p
  JOIN nested_range r ON p.ip_num BETWEEN r.ip_from AND r.ip_to
  GROUP BY p.id)
GROUP BY province""")

q("page_view_incremental", f"""
SELECT page_id, CAST(sum(num) AS BIGINT) AS num FROM (
  {_view_total_sql('page_hist_rows')} UNION ALL {_view_total_sql('page_batch_rows')})
GROUP BY page_id""")

q("page_state_incremental", f"""
SELECT s.last_page_id, s.page_id, s.next_page_id, s.num,
       CASE WHEN s.page_id = 1 THEN '100%'
            WHEN s.page_id = 2 THEN {_pct('c.n2', 'c.n1')}
            WHEN s.page_id = 3 THEN {_pct('c.n3', 'c.n2')} END AS jump_rate
FROM (
  SELECT page_id, CAST(count(*) AS BIGINT) AS num,
         arg_min(last_page_id, struct_pack(s := side, a := last_page_id, b := next_page_id)) AS last_page_id,
         arg_min(next_page_id, struct_pack(s := side, a := last_page_id, b := next_page_id)) AS next_page_id
  FROM (SELECT TRY_CAST(page_id AS INTEGER) AS page_id, last_page_id, next_page_id, 0 AS side FROM page_hist_rows
        UNION ALL
        SELECT TRY_CAST(page_id AS INTEGER), last_page_id, next_page_id, 1 FROM page_batch_rows)
  WHERE page_id IS NOT NULL GROUP BY page_id) s, (
  SELECT CAST(coalesce(sum(CASE WHEN page_id = 1 THEN num END), 0) AS BIGINT) AS n1,
         CAST(coalesce(sum(CASE WHEN page_id = 2 THEN num END), 0) AS BIGINT) AS n2,
         CAST(coalesce(sum(CASE WHEN page_id = 3 THEN num END), 0) AS BIGINT) AS n3
  FROM page_totals) c""")

q("feed_reject_count", " UNION ALL ".join(
    f"SELECT '{feed}' AS feed, (SELECT count(*) FROM {kept}) AS kept, "
    f"(SELECT count(*) FROM {feed if feed != 'course_learn' else 'learn'}_feed) - (SELECT count(*) FROM {kept}) AS rejected"
    for feed, kept in (("register", "register_rows"), ("qz", "qz_rows"), ("page", "page_rows"),
                       ("course_learn", "learn_rows"))))

# ---- state merges ----------------------------------------------------------

q("merge_replace", """
SELECT user_id AS key, arg_max(event_type, event_id) AS value FROM events GROUP BY user_id""")

q("merge_accumulate", """
SELECT chapterid, CAST(sum(secs) AS BIGINT) AS totaltime FROM learn_rows GROUP BY chapterid""")

q("feed_progress", """
SELECT 'learnstream' AS grp, event_type AS topic, CAST(event_id % 3 AS INTEGER) AS partition,
       CAST(max(event_id) + 1 AS BIGINT) AS until_offset
FROM events GROUP BY event_type, event_id % 3""")
