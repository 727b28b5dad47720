"""DuckDB SQL for every registered query, over the same Parquet tables.

The eligibility queries are formulated independently of the Spark plans
(NOT EXISTS for new mappings and carry-forward, one conditional projection
for the merge rules, "hour = the offer's latest hour" for saved offers), so
they check them against a second derivation of the same rules.
"""

from __future__ import annotations

from eligo.plans import standins as S
from eligo.schemas import STAGE_COLS, STATE_COLS

_STAGE = ", ".join(STAGE_COLS)
_STAGE_NO_USES = ", ".join(c for c in STAGE_COLS if c != "uses")
_STATE_NO_BATCH = ", ".join(c for c in STATE_COLS if c != "batch_id")
_CUT = f"TIMESTAMP '{S.CUT}'"
_I = lambda cols: ", ".join(f"i.{c}" for c in cols)

_FLAT = """
flat AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) AS updated,
         CAST(k AS VARCHAR) AS offer_id,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) AS start_time,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 30 DAY AS end_time,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) AS creation_time,
         CAST(NULL AS TIMESTAMP) AS invalidation_time,
         CAST(k AS DOUBLE) AS dollars,
         CAST(CASE WHEN event_type = 'error' THEN NULL ELSE 0.5 END AS DOUBLE) AS percentage,
         CAST(CASE WHEN k % 4 = 0 THEN 0 ELSE k % 7 END AS DECIMAL(38,0)) AS quantity,
         (k % 10 = 0) AS holdout,
         'NA' AS meta,
         CAST(0 AS DECIMAL(1,1)) AS ranking,
         (event_type = 'signup') AS potentiallyeligibleinfuture,
         (user_id % 3 <> 0) AS audience,
         CAST(floor(value) AS DECIMAL(38,0)) AS uses,
         CASE WHEN k % 2 = 0 THEN 'explore' ELSE 'exploit' END AS bandit_status,
         'NULL' AS experiment_status
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
)"""


def _staged(name: str, where: str) -> str:
    return f"""
{name}_rows AS (
  SELECT *, max(updated) OVER (PARTITION BY user_id, offer_id) AS key_latest
  FROM flat WHERE {where}
),
{name} AS (
  SELECT {_STAGE_NO_USES}, MAX(uses) AS uses FROM {name}_rows WHERE updated = key_latest
  GROUP BY {_STAGE_NO_USES}
)"""


def _ctes_state(flat_cte: str = _FLAT) -> str:
    """flat -> hist (batch 1, all new mappings) and incr, then the next batch.

    Formulated independently of the Spark plan: NOT EXISTS for new mappings
    and for the carry-forward, one conditional projection for the four merge
    rules over the de-duplicated fresher pairs.
    """
    pef = "potentiallyeligibleinfuture"
    return f"""WITH {flat_cte},
{_staged("hist_staged", f"updated < {_CUT}")},
{_staged("incr", f"updated >= {_CUT}")},
hist AS (
  SELECT user_id, updated, offer_id, start_time, end_time, creation_time, invalidation_time,
         dollars, percentage, quantity, holdout, meta, ranking, {pef},
         CASE WHEN {pef} = false THEN start_time END AS start_time_first_observed,
         CAST(NULL AS TIMESTAMP) AS start_time_recently_observed, audience,
         CAST(NULL AS DOUBLE) AS percentage_recently_observed, uses,
         CAST(NULL AS DECIMAL(38,0)) AS uses_recently_observed, bandit_status, experiment_status,
         'active' AS expiry_status, CAST({S.HIST_BATCH_ID} AS BIGINT) AS batch_id
  FROM hist_staged WHERE {pef} IS NOT NULL
),
matching AS (
  SELECT DISTINCT {_I(STAGE_COLS)},
         h.start_time_first_observed AS h_first_observed,
         h.start_time_recently_observed AS h_start_recent,
         h.percentage_recently_observed AS h_pct_recent,
         h.uses_recently_observed AS h_uses_recent,
         h.start_time AS h_start, h.percentage AS h_pct, h.uses AS h_uses
  FROM incr i JOIN hist h ON (i.offer_id = h.offer_id AND i.user_id = h.user_id)
  WHERE i.updated > h.updated
),
new_upd AS (
  SELECT {_STAGE},
         CASE WHEN {pef} THEN CAST(NULL AS TIMESTAMP) ELSE start_time END AS fo,
         CAST(NULL AS TIMESTAMP) AS sr, CAST(NULL AS DOUBLE) AS pr, CAST(NULL AS DECIMAL(38,0)) AS ur
  FROM incr i
  WHERE {pef} IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM hist h WHERE h.user_id = i.user_id AND h.offer_id = i.offer_id)
),
match_upd AS (
  SELECT {_STAGE},
         CASE WHEN h_first_observed IS NULL AND NOT {pef} THEN start_time
              ELSE h_first_observed END AS fo,
         CASE WHEN h_first_observed IS NOT NULL AND NOT {pef} THEN h_start
              ELSE h_start_recent END AS sr,
         CASE WHEN h_first_observed IS NOT NULL AND NOT {pef} AND percentage IS NOT NULL THEN h_pct
              ELSE h_pct_recent END AS pr,
         CASE WHEN h_first_observed IS NOT NULL AND NOT {pef} THEN h_uses
              ELSE h_uses_recent END AS ur
  FROM matching
  WHERE {pef} IS NOT NULL AND NOT (h_first_observed IS NOT NULL AND {pef})
),
{_to_state("updates", "(SELECT * FROM match_upd UNION ALL SELECT * FROM new_upd)")},
{_to_state("new_updates", "new_upd")},
carried AS (
  SELECT {", ".join(f"h.{c}" for c in STATE_COLS if c != "batch_id")},
         CAST({S.NEXT_BATCH_ID} AS BIGINT) AS batch_id
  FROM hist h
  WHERE NOT EXISTS (SELECT 1 FROM updates u WHERE u.user_id = h.user_id AND u.offer_id = h.offer_id)
)"""


def _to_state(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT user_id, updated, offer_id, start_time, end_time, creation_time, invalidation_time,
         dollars, percentage, quantity, holdout, meta, ranking, potentiallyeligibleinfuture,
         fo AS start_time_first_observed, sr AS start_time_recently_observed, audience,
         pr AS percentage_recently_observed, uses, ur AS uses_recently_observed,
         bandit_status, experiment_status, 'active' AS expiry_status,
         CAST({S.NEXT_BATCH_ID} AS BIGINT) AS batch_id
  FROM {src} x
)"""


def _labels() -> str:
    """Labels from sets, not from one CASE: each row's known versions are split by freshness,
    then by what the previous version shows, and each set is labelled on its own."""
    hist = ", ".join(f"h.{c} AS {a}" for c, a in (
        ("start_time_first_observed", "h_first_observed"), ("start_time_recently_observed", "h_start_recent"),
        ("percentage_recently_observed", "h_pct_recent"), ("uses_recently_observed", "h_uses_recent"),
        ("start_time", "h_start"), ("percentage", "h_pct"), ("uses", "h_uses")))
    none = ", ".join(f"NULL AS {a}" for a in (
        "h_first_observed", "h_start_recent", "h_pct_recent", "h_uses_recent", "h_start", "h_pct", "h_uses"))
    eligible, later = "x.potentiallyeligibleinfuture IS FALSE", "x.potentiallyeligibleinfuture IS TRUE"
    return f""",
known AS (SELECT i.*, {hist}, h.updated AS h_updated FROM incr i JOIN hist h USING (user_id, offer_id)),
unknown AS (SELECT i.*, {none} FROM incr i
            WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.user_id = i.user_id AND h.offer_id = i.offer_id)),
fresh AS (SELECT * FROM known WHERE updated > h_updated),
old AS (SELECT * FROM known WHERE updated <= h_updated OR updated IS NULL OR h_updated IS NULL),
labelled AS (
  SELECT 'N1' AS rule, {_LABEL_COLS} FROM unknown x WHERE {eligible}
  UNION SELECT 'N2', {_LABEL_COLS} FROM unknown x WHERE {later}
  UNION SELECT 'new_pef_null', {_LABEL_COLS} FROM unknown x WHERE potentiallyeligibleinfuture IS NULL
  UNION SELECT 'stale', {_LABEL_COLS} FROM old x
  UNION SELECT 'pef_null', {_LABEL_COLS} FROM fresh x WHERE potentiallyeligibleinfuture IS NULL
  UNION SELECT 'M1', {_LABEL_COLS} FROM fresh x WHERE {eligible} AND h_first_observed IS NULL
  UNION SELECT 'M4', {_LABEL_COLS} FROM fresh x WHERE {later} AND h_first_observed IS NULL
  UNION SELECT 'M2', {_LABEL_COLS} FROM fresh x WHERE {eligible} AND h_first_observed IS NOT NULL AND percentage IS NOT NULL
  UNION SELECT 'M3', {_LABEL_COLS} FROM fresh x WHERE {eligible} AND h_first_observed IS NOT NULL AND percentage IS NULL
  UNION SELECT 'gap', {_LABEL_COLS} FROM fresh x WHERE {later} AND h_first_observed IS NOT NULL
)"""


_LABEL_COLS = ", ".join([*STAGE_COLS, "h_first_observed", "h_start_recent", "h_pct_recent", "h_uses_recent",
                         "h_start", "h_pct", "h_uses"])


def _state_select(src: str) -> str:
    return f"SELECT {', '.join(STATE_COLS)} FROM {src}"


_RAW_OFFERS = """raw AS (
  SELECT CAST(user_id * 1000 + CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR) AS id,
         epoch_us(ts) // 1000 AS start_ms,
         epoch_us(ts) // 1000 + 2592000000 AS end_ms,
         date_trunc('second', ts) AS start_utc,
         date_trunc('second', ts) + INTERVAL 30 DAY AS end_utc,
         date_trunc('second', ts) + to_days(CAST(floor(value) AS INTEGER)) AS latest_end_utc,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
         CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour
  FROM events
)"""


def _offer_stage(name: str, where: str) -> str:
    """Per offer: rows of its latest landing hour, each time column at its MAX."""
    def chi(c):
        return f"(({c} AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago')"
    hour_ts = "make_timestamp(year, month, day, hour, 0, 0)"
    return f"""{name}_rows AS (
  SELECT id AS offer_id, {chi("start_utc")} AS start_time, {chi("end_utc")} AS end_time,
         {chi("latest_end_utc")} AS latest_end_time, year, month, day, hour,
         {hour_ts} AS hour_ts,
         max({hour_ts}) OVER (PARTITION BY id) AS offer_latest_hour
  FROM raw WHERE start_ms + end_ms > 0 AND {where}
),
{name} AS (
  SELECT offer_id, MAX(start_time) AS start_time, MAX(end_time) AS end_time,
         MAX(latest_end_time) AS latest_end_time, year, month, day, MAX(hour) AS hour
  FROM {name}_rows WHERE hour_ts = offer_latest_hour
  GROUP BY offer_id, year, month, day
)"""


_PART_EXPIRY = f"""WITH dim AS (
  SELECT l_partkey AS p_partkey, max(l_shipdate) FILTER (l_returnflag <> 'R') AS latest_end_time
  FROM lineitem GROUP BY l_partkey
),
st AS (
  SELECT p.p_partkey, p.p_name, p.p_brand, p.p_type, p.p_size, p.p_retailprice,
         CASE WHEN CAST(d.latest_end_time AS DATE) + 91 < DATE '{S.EXPIRY_AS_OF}'
              THEN 'expired' ELSE 'active' END AS expiry_status
  FROM part p LEFT JOIN dim d ON (p.p_partkey = d.p_partkey)
)"""

_PARTS = ("CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, "
          "CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour")


def _flatten_oracle(legacy: bool) -> str:
    def b(expr):   # a boolean as the legacy payload carries it (text)
        return f"CASE WHEN {expr} THEN 'true' ELSE 'false' END" if legacy else f"({expr})"
    if legacy:
        status = ("CASE WHEN k % 2 = 0 THEN 'explore' ELSE 'exploit' END AS bandit_status, "
                  "event_type AS experiment_status")
        progress = """CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS progress_uses,
       CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) AS progress_dollars,
       '100' AS progress_dollars_required, '10' AS progress_max_uses,
       CASE WHEN event_type = 'error' THEN NULL ELSE '0.5' END AS progress_percentage,
       CASE WHEN k % 4 = 0 THEN NULL ELSE CAST(k % 7 AS VARCHAR) END AS progress_quantity,
       '7' AS progress_quantity_required"""
    else:
        status = "'NULL' AS bandit_status, 'NULL' AS experiment_status"
        progress = """CAST(floor(value) AS BIGINT) AS progress_uses,
       value AS progress_dollars,
       CAST(100.0 AS DOUBLE) AS progress_dollars_required, CAST(10 AS BIGINT) AS progress_max_uses,
       CAST(CASE WHEN event_type = 'error' THEN NULL ELSE 0.5 END AS DOUBLE) AS progress_percentage,
       CAST(CASE WHEN k % 4 = 0 THEN NULL ELSE k % 7 END AS BIGINT) AS progress_quantity,
       CAST(7 AS BIGINT) AS progress_quantity_required"""
    return f"""WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k0 FROM events),
o AS (SELECT *, k0 AS k FROM e UNION ALL SELECT *, (k0 + 1) % 100 AS k FROM e)
SELECT CAST(user_id AS VARCHAR) AS user_id,
       date_trunc('second', ts) AS updated_ts,
       CAST(k AS VARCHAR) AS offer_id,
       date_trunc('second', ts) - INTERVAL 1 DAY AS creation_time,
       {b("user_id % 3 <> 0")} AS audience,
       {status},
       {b("k % 10 = 0")} AS holdout,
       CAST(NULL AS TIMESTAMP) AS invalidation_time,
       date_trunc('second', ts) AS start_time,
       date_trunc('second', ts) + INTERVAL 30 DAY AS end_time,
       {b("event_type = 'signup'")} AS potentially_eligible_in_future,
       'uses' AS progress_type,
       {progress}
FROM o"""


_TYPED_FROM_FLAT = """
  SELECT user_id, updated_ts AS updated, offer_id, start_time, end_time, creation_time,
         invalidation_time,
         TRY_CAST(progress_dollars AS DOUBLE) AS dollars,
         TRY_CAST(progress_percentage AS DOUBLE) AS percentage,
         CASE WHEN progress_quantity IS NULL THEN CAST(0 AS DECIMAL(38,0))
              ELSE TRY_CAST(progress_quantity AS DECIMAL(38,0)) END AS quantity,
         TRY_CAST(holdout AS BOOLEAN) AS holdout, 'NA' AS meta, CAST(0 AS DECIMAL(1,1)) AS ranking,
         TRY_CAST(potentially_eligible_in_future AS BOOLEAN) AS potentiallyeligibleinfuture,
         TRY_CAST(audience AS BOOLEAN) AS audience,
         TRY_CAST(progress_uses AS DECIMAL(38,0)) AS uses, bandit_status, experiment_status"""


def _legacy_flat_cte() -> str:
    """The legacy stand-in, flattened and typed, as the ``flat`` CTE."""
    return f"""flat AS (
  WITH f AS ({_flatten_oracle(legacy=True)})
  {_TYPED_FROM_FLAT.strip()} FROM f
)"""


def _kafka_job_sql() -> str:
    """The state after both windows; the first window's second run carries every row into batch 3."""
    flat = f"""flat AS (
  WITH f AS (SELECT * REPLACE (progress_quantity + 0.5 AS progress_quantity)
             FROM ({_flatten_oracle(legacy=False)}) x)
  {_TYPED_FROM_FLAT.strip()} FROM f
)"""
    cols = ", ".join(c for c in STATE_COLS if c != "batch_id")
    return f"""{_ctes_state(flat)}
SELECT {cols}, CAST({S.NEXT_BATCH_ID + 1} AS BIGINT) AS batch_id
FROM (SELECT {cols} FROM updates UNION ALL SELECT {cols} FROM carried) s"""


def _init_job_sql() -> str:
    cols = ", ".join({"offer_id": "d.offer_id", "expiry_status":
                      f"CASE WHEN CAST(o.latest_end_time AS DATE) + 91 < DATE '{S.INIT_AS_OF}' "
                      "THEN 'expired' ELSE 'active' END AS expiry_status"}.get(c, f"d.{c}") for c in STATE_COLS)
    return f"""{_ctes_state()},
{_RAW_OFFERS},
{_offer_stage("st", "true")},
dumped AS (
  SELECT * REPLACE (CAST(CAST(user_id AS BIGINT) * 1000 + CAST(offer_id AS BIGINT) AS VARCHAR) AS offer_id)
  FROM hist
)
SELECT {cols} FROM dumped d
LEFT JOIN (SELECT offer_id, max(latest_end_time) AS latest_end_time FROM st GROUP BY offer_id) o USING (offer_id)"""


def _stage_from_flat(flat_sql: str) -> str:
    """Typing and latest-version selection over a flattened layout, as staged."""
    return f"""WITH f AS ({flat_sql}),
typed AS (
  SELECT user_id, updated_ts AS updated, offer_id, start_time, end_time, creation_time,
         invalidation_time,
         TRY_CAST(progress_dollars AS DOUBLE) AS dollars,
         TRY_CAST(progress_percentage AS DOUBLE) AS percentage,
         CASE WHEN progress_quantity IS NULL THEN CAST(0 AS DECIMAL(38,0))
              ELSE TRY_CAST(progress_quantity AS DECIMAL(38,0)) END AS quantity,
         TRY_CAST(holdout AS BOOLEAN) AS holdout, 'NA' AS meta, CAST(0 AS DECIMAL(1,1)) AS ranking,
         TRY_CAST(potentially_eligible_in_future AS BOOLEAN) AS potentiallyeligibleinfuture,
         TRY_CAST(audience AS BOOLEAN) AS audience,
         TRY_CAST(progress_uses AS DECIMAL(38,0)) AS uses, bandit_status, experiment_status,
         max(updated_ts) OVER (PARTITION BY user_id, offer_id) AS key_latest
  FROM f
)
SELECT {_STAGE_NO_USES}, MAX(uses) AS uses FROM typed WHERE updated = key_latest
GROUP BY {_STAGE_NO_USES}"""


def _path_sql() -> str:
    def two(x):
        return f"lpad(CAST({x}(ts) AS VARCHAR), 2, '0')"
    path = (f"concat('{S.PATH_ROOT}', 'year=', CAST(year(ts) AS VARCHAR), '/month=', {two('month')}, "
            f"'/day=', {two('day')}, CASE WHEN event_type = 'error' THEN '' "
            f"ELSE concat('/hour=', {two('hour')}) END, '/part-', CAST(event_id AS VARCHAR), '.json')")
    parts = ", ".join(
        f"TRY_CAST(NULLIF(regexp_extract(file_path, '{p}=(\\d{{{n}}})', 1), '') AS INTEGER) AS {p}"
        for p, n in (("year", 4), ("month", 2), ("day", 2), ("hour", 2)))
    return f"""WITH p AS (SELECT event_id, {path} AS file_path FROM events)
SELECT event_id, file_path, {parts} FROM p"""


_BATCH = "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT)"

_OFFER_MERGE = f"""WITH {_RAW_OFFERS},
{_offer_stage("tgt", f"make_timestamp(year, month, day, hour, 0, 0) < {_CUT}")},
{_offer_stage("src", f"make_timestamp(year, month, day, hour, 0, 0) >= {_CUT}")},
j AS (
  SELECT t.offer_id AS t_offer_id, t.start_time AS t_start_time, t.end_time AS t_end_time,
         t.latest_end_time AS t_latest_end_time, t.year AS t_year, t.month AS t_month,
         t.day AS t_day, t.hour AS t_hour, t.present AS t_present,
         s.offer_id AS s_offer_id, s.start_time AS s_start_time, s.end_time AS s_end_time,
         s.latest_end_time AS s_latest_end_time, s.year AS s_year, s.month AS s_month,
         s.day AS s_day, s.hour AS s_hour, s.present AS s_present
  FROM (SELECT *, true AS present FROM tgt) t
  FULL OUTER JOIN (SELECT *, true AS present FROM src) s ON (t.offer_id = s.offer_id)
),
d AS (
  SELECT *, (t_present IS NULL OR (s_present IS NOT NULL AND coalesce(
      s_start_time <> t_start_time OR s_end_time <> t_end_time
      OR s_latest_end_time <> t_latest_end_time, false))) AS take_source
  FROM j
)
SELECT {", ".join(f"CASE WHEN take_source THEN s_{c} ELSE t_{c} END AS {c}"
                  for c in ["offer_id", "start_time", "end_time", "latest_end_time",
                            "year", "month", "day", "hour"])}
FROM d"""


def _catalog_tables_sql() -> str:
    """Three versions of the dimension: the first window's stage, then the merge of the second, twice."""
    cols = "offer_id, start_time, end_time, latest_end_time, year, month, day, hour"
    merged = _OFFER_MERGE.replace("\nFROM d", ", t_present, s_present\nFROM d")
    head, _, body = merged.rpartition("\nSELECT ")
    return f"""{head},
merged AS (SELECT {body})
SELECT {cols}, CAST(1 AS BIGINT) AS batch_id FROM tgt
UNION ALL SELECT {cols}, CAST(v AS BIGINT) AS batch_id FROM merged, (SELECT unnest([2, 3]) AS v)"""


def _schema_drift_sql() -> str:
    """The landed lines as DuckDB writes them, opened by its own json_tree."""
    def offer(k):
        progress = (f"json_object('type', 'uses', 'uses', CAST(floor(value) AS BIGINT), 'dollars', value, 'dollars_required', 100.0, "
                    f"'max_uses', 10, 'percentage', CASE WHEN event_type <> 'error' THEN 0.5 END, "
                    f"'quantity', CASE WHEN {k} % 4 <> 0 THEN {k} % 7 + 0.5 END, 'quantity_required', 7)")
        # a merge patch drops members that are null, as the feed leaves them out
        return (f"json_merge_patch('{{}}', json_object('offer_id', CAST({k} AS VARCHAR), 'creation_timestamp_ms', ms - 86400000, "
                f"'start_timestamp_ms', ms, 'end_timestamp_ms', ms + 2592000000, 'audience', user_id % 3 <> 0, 'holdout', {k} % 10 = 0, "
                f"'potentially_eligible_in_future', event_type = 'signup', 'progress', {progress}))")
    known = ["$", "$.user_id", "$.updated_timestamp_ms", "$.offers", "$.offers[*]", *(
        f"$.offers[*].{f}" for f in ("offer_id", "creation_timestamp_ms", "invalidation_timestamp_ms", "start_timestamp_ms",
                                     "end_timestamp_ms", "audience", "holdout", "potentially_eligible_in_future", "progress")), *(
        f"$.offers[*].progress.{f}" for f in ("type", "uses", "dollars", "dollars_required", "max_uses", "percentage", "quantity",
                                              "quantity_required"))]
    return f"""WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, epoch_us(ts) // 1000 AS ms FROM events),
l AS (SELECT event_id, json_object('user_id', CAST(user_id AS VARCHAR), 'updated_timestamp_ms',
        CASE WHEN event_type = 'view' THEN to_json(CAST(ms AS VARCHAR)) ELSE to_json(ms) END,
        'offers', json_array({offer("k")}, {offer("((k + 1) % 100)")}), 'source_host', 'h1') AS line FROM e),
t AS (SELECT DISTINCT event_id, regexp_replace(fullkey, '\\[\\d+\\]', '[*]', 'g') AS path,
        CASE type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean'
                  WHEN 'NULL' THEN 'null' ELSE 'number' END AS type
      FROM l, json_tree(l.line))
SELECT path, type, count(*) AS n_lines, list_contains({known!r}, path) AS known FROM t GROUP BY path, type"""


def _audit_sql(state: str) -> str:
    keys = "(SELECT DISTINCT user_id, offer_id FROM updates)"
    return f"""{state},
u AS (SELECT * EXCLUDE (batch_id), count(*) AS copies FROM updates GROUP BY ALL)
SELECT (SELECT count(*) FROM updates) + (SELECT count(*) FROM carried) AS rows, (SELECT count(*) FROM updates) AS update_rows,
       (SELECT count(*) FROM carried) AS carried_rows, (SELECT count(*) FROM hist) AS previous_rows,
       (SELECT count(*) FROM hist JOIN {keys} USING (user_id, offer_id)) AS replaced_rows,
       (SELECT count(*) FROM (SELECT user_id, offer_id FROM updates UNION ALL SELECT user_id, offer_id FROM carried)
        JOIN {keys} USING (user_id, offer_id)) AS rows_of_updated_keys,
       (SELECT count(*) FROM (SELECT 1 FROM updates GROUP BY user_id, offer_id HAVING count(*) > 1)) AS keys_with_several_rows,
       CAST((SELECT sum(copies - 1) FROM u) AS BIGINT) AS update_copies, true AS sound"""


def oracle_sql() -> dict[str, str]:
    state = _ctes_state()
    k = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
    return {
        "q_hour_window": f"""SELECT event_id, ts, user_id, event_type, {_PARTS} FROM events
WHERE make_timestamp(year(ts), month(ts), day(ts), hour(ts), 0, 0) >= TIMESTAMP '{S.WINDOW_START}:00:00'
  AND make_timestamp(year(ts), month(ts), day(ts), hour(ts), 0, 0) < TIMESTAMP '{S.WINDOW_END}:00:00'""",
        "q_path_parts": _path_sql(),
        "q_json_field": """SELECT event_id, json_extract_string(props, '$.k') AS k_text,
       json_extract_string(props, '$.missing') AS missing_text FROM events""",
        "q_flatten_legacy": _flatten_oracle(legacy=True),
        "q_flatten_kafka": _flatten_oracle(legacy=False),
        "q_epoch_to_ts": """SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms,
       date_trunc('second', ts) AS ts_sec FROM events""",
        "q_chicago_time": """SELECT event_id,
       ((date_trunc('second', ts) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago') AS chicago_ts
FROM events""",
        "q_typed_progress": f"""WITH t AS (
  SELECT event_id,
         CASE WHEN event_type = 'error' THEN 'abc' WHEN event_type = 'view' THEN NULL
              ELSE CAST(value AS VARCHAR) END AS quantity_text,
         json_extract_string(props, '$.k') AS uses_text,
         CAST(value AS VARCHAR) AS dollars_text,
         CASE WHEN {k} % 10 = 0 THEN 'true' WHEN {k} % 10 = 1 THEN 'maybe' ELSE 'false' END AS holdout_text
  FROM events)
SELECT event_id,
       CASE WHEN quantity_text IS NULL THEN CAST(0 AS DECIMAL(38,0))
            ELSE TRY_CAST(quantity_text AS DECIMAL(38,0)) END AS quantity,
       TRY_CAST(uses_text AS DECIMAL(38,0)) AS uses,
       TRY_CAST(dollars_text AS DOUBLE) AS dollars,
       TRY_CAST(holdout_text AS BOOLEAN) AS holdout,
       TRY_CAST(TRY_CAST(quantity_text AS DECIMAL(38,0)) AS BIGINT) AS max_uses
FROM t""",
        "q_stage_legacy": _stage_from_flat(_flatten_oracle(legacy=True)),
        "q_stage_kafka": _stage_from_flat(_flatten_oracle(legacy=False)),
        "q_dedupe_rows": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
        "q_latest_per_key": f"WITH {_FLAT},\n{_staged('st', 'true')}\nSELECT {_STAGE} FROM st",
        "q_last_batch": f"SELECT max({_BATCH}) AS last_batch FROM orders",
        "q_batch_slice": f"""WITH o AS (SELECT *, {_BATCH} AS batch_id FROM orders)
SELECT * FROM o WHERE batch_id = (SELECT max(batch_id) FROM o)""",
        "q_new_mappings": f"{state}\n{_state_select('new_updates')}",
        "q_matching": f"{state}\nSELECT * FROM matching",
        "q_classify": f"{state}{_labels()}\nSELECT rule, count(*) AS n_rows FROM labelled GROUP BY rule",
        "q_state_updates": f"{state}\n{_state_select('updates')}",
        "q_carry_forward": f"{state}\n{_state_select('carried')}",
        "q_state_batch": f"{state}\n{_state_select('updates')}\nUNION ALL\n{_state_select('carried')}",
        "q_offer_stage": f"""WITH {_RAW_OFFERS},
{_offer_stage("st", "true")}
SELECT offer_id, start_time, end_time, latest_end_time, year, month, day, hour FROM st""",
        "q_carry_forward_large": f"{state}\n{_state_select('carried')}",
        "q_audit_counts": _audit_sql(state),
        "q_offer_merge": _OFFER_MERGE,
        "q_merge_bucketed": _OFFER_MERGE,
        "q_catalog_tables": _catalog_tables_sql(),
        "q_schema_drift": _schema_drift_sql(),
        "q_pruned_matches": f"{state}\nSELECT * FROM matching",
        "q_late_hours": f"""SELECT {_PARTS}, CAST(1 AS BIGINT) AS n_files, 2 * count(*) AS n_lines
FROM events WHERE event_type = 'error' GROUP BY ALL""",
        "q_compact_small": """SELECT CAST(ts AS DATE) AS day, count(*) AS n_rows, true AS fewer_files, true AS disjoint,
       true AS large_kept FROM events GROUP BY 1""",
        "q_saved_offers_job": _OFFER_MERGE,
        "q_eligibility_job": f"""{_ctes_state(_legacy_flat_cte())}
{_state_select('updates')}
UNION ALL
{_state_select('carried')}""",
        "q_kafka_job": _kafka_job_sql(),
        "q_init_job": _init_job_sql(),
        "q_landing_window": f"""SELECT {_PARTS},
       count(*) + count(*) FILTER (event_type = 'error') AS n_lines,
       count(*) FILTER (event_type = 'error') AS n_corrupt
FROM events
WHERE date_trunc('hour', ts) >= TIMESTAMP '{S.WINDOW_START}:00:00' AND ts < TIMESTAMP '{S.WINDOW_END}:00:00'
GROUP BY ALL""",
        "q_expiry_status": f"{_PART_EXPIRY}\nSELECT * FROM st",
        "q_expiry_salted": f"""{_PART_EXPIRY}
SELECT l_orderkey, l_linenumber, l_partkey AS p_partkey, coalesce(st.expiry_status, 'active') AS expiry_status
FROM lineitem LEFT JOIN st ON (l_partkey = st.p_partkey)""",
        "q_expiry_split": f"""{_PART_EXPIRY}
SELECT 'active' AS side, count(*) AS n_rows, CAST(sum(p_partkey) AS BIGINT) AS key_checksum
FROM st WHERE expiry_status <> 'expired'
UNION ALL
SELECT 'inactive' AS side, count(*) AS n_rows, CAST(sum(p_partkey) AS BIGINT) AS key_checksum
FROM st WHERE expiry_status = 'expired'""",
        "q_clustered_rows": f"SELECT event_id, user_id, {_PARTS} FROM events",
        "q_compact_check": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    }
