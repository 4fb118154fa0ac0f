"""ANSI SQL over the same tables, one statement per registered query."""

from pointstream.plans.tables import STATUS_CODES, TRIAL_RUN_DATE, TRIAL_SENTINEL

_STATUS = (
    "CASE event_type "
    + " ".join(f"WHEN '{kind}' THEN {code}" for kind, code in STATUS_CODES.items())
    + " END"
)


def _milli(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%g')"


def _second(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def _whole_second(column: str) -> str:
    return f"{_second(column)} || '.000'"


_READINGS = f"""readings AS (
  SELECT event_id, CAST(user_id AS INTEGER) AS id, value AS point_value,
         ts AS real_time, ts AS collect_time, CAST({_STATUS} AS INTEGER) AS status
  FROM events)"""

_POINTS = """points AS (
  SELECT CAST(c_custkey AS INTEGER) AS point_id, c_name AS point_name,
         c_mktsegment AS point_index_name, n_nationkey AS heat_station_code,
         n_name AS heat_station_name, n_regionkey AS area_code
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def _enriched(where: str = "TRUE", text=_milli) -> str:
    return f"""WITH {_READINGS}, {_POINTS}
SELECT d.point_id, d.point_name, f.point_value, f.status AS point_status,
       d.point_index_name, d.heat_station_code, d.heat_station_name, d.area_code,
       {text('f.collect_time')} AS collect_time, {text('f.real_time')} AS real_time
FROM readings f JOIN points d ON f.id = d.point_id
WHERE {where}"""


_NOT_SENTINEL = f"strftime(f.real_time, '%Y-%m-%d') <> '{TRIAL_SENTINEL}'"


_COUNT = """CASE event_id % 50 WHEN 10 THEN 0 WHEN 21 THEN 78 WHEN 32 THEN 79
            ELSE event_id % 4 + 1 END"""


# Records of the frames made from events: see plans/tables.py for the rule.
def _records(ts: str = "ts") -> str:
    return f"""records AS (
  SELECT event_id AS frame_id, CAST(i AS INTEGER) AS record_seq, {_COUNT} AS n,
         ts + INTERVAL 8 HOUR AS collect_time,
         CAST(CASE WHEN i % 4 = 3 THEN -user_id - 1 ELSE user_id + i END AS INTEGER) AS id,
         CAST(CASE WHEN i % 2 = 0 THEN value ELSE -value END AS FLOAT) AS v,
         CASE WHEN i % 3 = 2 THEN 0
              ELSE CAST(floor(epoch({ts})) AS BIGINT) + i * 3600 END AS seconds,
         CAST(({_STATUS} + 37 * i) % 256 AS INTEGER) AS status
  FROM events, range(79) r(i)
  WHERE i < {_COUNT})"""


# Text of a number's four bytes, lowest first, and of the bits of a single.
def _le_hex(number: str) -> str:
    text = f"printf('%08X', ({number}) & 4294967295)"
    return " || ".join(f"substr({text}, {at}, 2)" for at in (7, 5, 3, 1))


_SINGLE = "CAST(CAST(value AS FLOAT) AS DOUBLE)"
_NEAR = f"floor(log2(CASE WHEN {_SINGLE} > 0 THEN {_SINGLE} ELSE 1 END))"
_BITS = f"""bits AS (
  SELECT event_id, near + CASE WHEN single < pow(2, near) THEN -1
                               WHEN single >= pow(2, near + 1) THEN 1 ELSE 0 END AS e, single
  FROM (SELECT event_id, {_SINGLE} AS single, {_NEAR} AS near FROM events) s),
singles AS (
  SELECT event_id, CASE WHEN single = 0 THEN 0 ELSE CAST((e + 127) * 8388608
           + (single / pow(2, e) - 1) * 8388608 AS BIGINT) END AS bits
  FROM bits),
texts AS (
  SELECT frame_id, record_seq, n,
         {_le_hex('id')} || {_le_hex('CASE WHEN record_seq % 2 = 0 THEN bits ELSE bits + 2147483648 END')}
         || {_le_hex('seconds')} || printf('%02X', status) AS text
  FROM records JOIN singles ON event_id = frame_id),
bodies AS (
  SELECT frame_id, string_agg(text, '' ORDER BY record_seq) AS body FROM texts GROUP BY frame_id)"""

_HEADER = "upper(substr(md5(CAST(event_id AS VARCHAR)), 1, 20))"


_SIGNED = "CASE WHEN seconds >= 2147483648 THEN seconds - 4294967296 ELSE seconds END"


def _local(seconds: str) -> str:
    return f"(TIMESTAMP '1970-01-01 08:00:00' + to_seconds({seconds}))"


def _decoded(where: str = "TRUE") -> str:
    return f"""WITH {_records()}
SELECT frame_id, record_seq, {_second('collect_time')} AS collect_time, id,
       CAST(CAST(v AS VARCHAR) AS DOUBLE) AS point_value, CAST(v AS DOUBLE) AS point_value_bits,
       {_second(_local('seconds'))} AS real_time, status
FROM records WHERE {where}"""


_FRAMES_ENRICHED = f"""WITH {_records()}, {_POINTS}
SELECT d.point_id, d.point_name, CAST(CAST(f.v AS VARCHAR) AS DOUBLE) AS point_value,
       f.status AS point_status, d.point_index_name, d.heat_station_code,
       d.heat_station_name, d.area_code, {_whole_second('f.collect_time')} AS collect_time,
       {_whole_second(_local('f.seconds'))} AS real_time
FROM records f JOIN points d ON f.id = d.point_id
WHERE f.seconds <> 0"""

_FLOAT_VALUE = "CAST(CAST(CAST(value AS FLOAT) AS VARCHAR) AS DOUBLE)"

_TYPED = f"""CAST(user_id AS INTEGER) AS id, {_FLOAT_VALUE} AS point_value,
       CAST({_STATUS} AS INTEGER) AS status,
       {_whole_second('ts')} AS collect_time, {_whole_second('ts')} AS real_time"""

# Which messages the spoiling rule leaves, in the order the rule is applied.
_BROKEN = "(event_id % 7 = 0 OR event_id % 11 = 0 OR (event_id % 13 <> 0 AND event_id % 17 = 0))"
_BARE = "(event_id % 13 = 0)"

_MESSAGE = f"""'{{"collect_time":"' || {_second('ts')} || '","id":' || CAST(user_id AS VARCHAR)
  || ',"point_value":' || CAST(CAST(value AS FLOAT) AS VARCHAR) || ',"real_time":"'
  || {_second('ts')} || '","status":' || CAST({_STATUS} AS VARCHAR) || '}}'"""

_MESSAGE_REJECTS = f"""SELECT event_id, 'bad_message' AS reason,
  CASE WHEN event_id % 7 = 0 THEN '{{bad ' || {_MESSAGE}
       WHEN event_id % 11 = 0 THEN '{{"id":"x","status":1}}' ELSE '' END AS value
FROM events WHERE {_BROKEN}"""

_GENERATED = """generated AS (
  SELECT CAST(CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 10 + 1
              AS INTEGER) AS id
  FROM events)"""

_DATAGEN = f"""WITH {_GENERATED}
SELECT f.id, c_name AS description FROM generated f JOIN customer ON f.id = c_custkey"""

_LEDGER = """SELECT strftime(ts, '%Y-%m-%d') AS cm, event_id AS no, CAST(i AS INTEGER) AS part,
       event_type AS kind, user_id AS user
FROM events, range(2) r(i)
WHERE event_id % 5 <> 4 AND i < event_id % 3"""

# Totals before and after micro-batches of events by event_id % 3.
_CHANGES = """SELECT batch, CAST(coalesce(sum(n) OVER (
         ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before,
       CAST(sum(n) OVER (ORDER BY batch) AS BIGINT) AS after
FROM (SELECT event_id % 3 AS batch,
             count(*) FILTER (WHERE user_id % 2 = 0 AND user_id IN (
               SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey)) AS n
      FROM events GROUP BY event_id % 3) counted"""

ORACLES: dict[str, str] = {
    "lookup_enrich": _enriched(_NOT_SENTINEL),
    "lookup_enrich_unfiltered": _enriched(),
    "lookup_enrich_shuffled": _enriched(),
    "lookup_unmatched_dropped": _enriched("d.point_id % 2 = 0"),
    "lookup_multi_match": """SELECT event_id, d.point_id, d.point_index_name, value AS point_value
FROM events JOIN (
  SELECT CAST(o_custkey AS INTEGER) AS point_id, o_orderpriority AS point_index_name
  FROM orders) d ON user_id = d.point_id""",
    "sentinel_filter": f"""WITH {_READINGS}
SELECT event_id, id, point_value, status, strftime(real_time, '%Y-%m-%d') AS real_day,
       {_milli('real_time')} AS real_time, {_milli('collect_time')} AS collect_time
FROM readings f WHERE {_NOT_SENTINEL}""",
    "count_enriched": """SELECT count(*) AS total
FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey % 2 = 0""",
    "frame_hex": f"""WITH {_records()}, {_BITS}
SELECT event_id AS frame_id, {_HEADER} AS header_hex, coalesce(body, '') AS body_hex,
       TRUE AS same_bytes
FROM events LEFT JOIN bodies ON event_id = frame_id""",
    "frame_fields": f"""WITH {_records()}
SELECT frame_id, record_seq, id, CAST(v AS DOUBLE) AS point_value_bits,
       CAST(seconds AS INTEGER) AS seconds, status
FROM records""",
    "frame_decode": _decoded(),
    "captures_decode": _decoded(),
    "frame_decode_padded": f"""WITH {_records()}
SELECT event_id AS frame_id, CAST(i AS INTEGER) AS record_seq,
       {_second('ts + INTERVAL 8 HOUR')} AS collect_time, coalesce(id, 0) AS id,
       CAST(CAST(coalesce(v, CAST(0 AS FLOAT)) AS VARCHAR) AS DOUBLE) AS point_value,
       CAST(coalesce(v, CAST(0 AS FLOAT)) AS DOUBLE) AS point_value_bits,
       {_second(_local('coalesce(seconds, 0)'))} AS real_time, coalesce(status, 0) AS status
FROM events CROSS JOIN range(78) r(i)
LEFT JOIN records ON frame_id = event_id AND record_seq = i""",
    "frame_over_length": f"""WITH {_records()}, {_BITS}
SELECT frame_id, 'over_length' AS reason, text AS rest_hex FROM texts
WHERE n = 79 AND record_seq = 78""",
    "frame_decode_padded_filtered": _decoded("seconds <> 0 AND record_seq < 78"),
    "frame_decode_unsigned_time": f"""WITH {_records("(ts + INTERVAL 177 MONTH)")}
SELECT frame_id, record_seq, 'signed' AS reading,
       {_second(_local(_SIGNED))} AS real_time
FROM records
UNION ALL
SELECT frame_id, record_seq, 'unsigned' AS reading, {_second(_local('seconds'))} AS real_time
FROM records""",
    "frame_rejects": f"""WITH {_records()}, {_BITS}
SELECT event_id AS frame_id, 'short_header' AS reason,
       substr({_HEADER}, 1, CAST(2 * (event_id % 9 + 1) AS INTEGER)) AS rest_hex
FROM events WHERE event_id % 10 = 3
UNION ALL
SELECT frame_id, 'ragged_body', substr(text, 1, CAST(2 * (13 - (frame_id % 12 + 1)) AS INTEGER))
FROM texts WHERE frame_id % 10 = 7 AND record_seq = n - 1""",
    "frame_whole_records": f"""WITH {_records()}
SELECT frame_id, record_seq, id, status FROM records
WHERE frame_id % 10 <> 3 AND NOT (frame_id % 10 = 7 AND record_seq = n - 1)""",
    "non_finite_rejects": """SELECT event_id, CAST(user_id AS INTEGER) AS id,
       CASE event_id % 10 WHEN 0 THEN 'NaN' WHEN 1 THEN 'Infinity' ELSE '-Infinity' END
         AS point_value, 'non_finite' AS reason
FROM events WHERE event_id % 10 < 3""",
    "message_fields": f"""SELECT event_id, {_second('ts')} AS collect_time,
       CAST(user_id AS VARCHAR) AS id, CAST(CAST(value AS FLOAT) AS VARCHAR) AS point_value,
       {_second('ts')} AS real_time, CAST({_STATUS} AS VARCHAR) AS status
FROM events""",
    "message_roundtrip": f"SELECT event_id, {_TYPED} FROM events",
    "message_sink": f"SELECT {_TYPED} FROM events",
    "message_quarantined": f"""SELECT event_id,
       CAST(CASE WHEN {_BARE} THEN event_id ELSE user_id END AS INTEGER) AS id,
       CASE WHEN {_BARE} THEN NULL ELSE {_FLOAT_VALUE} END AS point_value,
       CAST(CASE WHEN {_BARE} THEN NULL ELSE {_STATUS} END AS INTEGER) AS status,
       CASE WHEN {_BARE} THEN NULL ELSE {_whole_second('ts')} END AS collect_time,
       CASE WHEN {_BARE} THEN NULL ELSE {_whole_second('ts')} END AS real_time
FROM events WHERE NOT {_BROKEN}""",
    "message_rejects": _MESSAGE_REJECTS,
    "frames_to_enriched": _FRAMES_ENRICHED,
    "frames_to_enriched_fused": _FRAMES_ENRICHED,
    "datagen_lookup": _DATAGEN,
    "datagen_count": f"SELECT count(*) AS total FROM ({_DATAGEN}) rows_found",
    "ledger_daily": _LEDGER,
    "ledger_rejects": "SELECT event_id, 'no_result' AS reason FROM events WHERE event_id % 5 = 4",
    "ledger_window": f"""SELECT strftime(ts, '%Y-%m-%d') AS cm, event_id,
       {_milli('ts')} AS event_time
FROM events
WHERE ts >= TIMESTAMP '{TRIAL_RUN_DATE}' - INTERVAL 1 DAY AND ts < TIMESTAMP '{TRIAL_RUN_DATE}'""",
    "ledger_replay": _LEDGER,
    "ledger_numbers": """SELECT strftime(ts, '%Y-%m-%d') AS cm,
       CAST(CAST('12345678901234567890' AS HUGEINT) + event_id AS VARCHAR) || '.'
         || lpad(CAST(event_id % 1000000000 AS VARCHAR), 9, '0') AS long,
       CAST(CAST('98765432109876543210' AS HUGEINT) + event_id AS VARCHAR) AS whole,
       CAST((event_id % 9 + 1) * 1000 AS DOUBLE) AS power, 'a"b\\cé' AS text,
       '1.10' AS deep_number, event_id AS deep_x
FROM events""",
    "ledgers_two": f"""SELECT CASE WHEN no % 2 = 0 THEN 'entrance' ELSE 'furnace' END AS ledger,
       strftime(TIMESTAMP '{TRIAL_RUN_DATE}' - INTERVAL 1 DAY, '%Y-%m-%d') AS cm,
       no, part, kind, user
FROM ({_LEDGER}) rows_found""",
    # Messages carry whole seconds.
    "stream_small_batches": _enriched(_NOT_SENTINEL, _whole_second),
    "stream_dimension_kept": _enriched(_NOT_SENTINEL, _whole_second),
    "stream_dimension_reloaded": _enriched(_NOT_SENTINEL, _whole_second).replace(
        "d.point_name,", "d.point_name || CASE f.event_id % 2 WHEN 1 THEN '#2' ELSE '' END AS point_name,"
    ),
    "dimension_read": f"""WITH {_POINTS}
SELECT point_id AS id, point_id, point_name, point_index_name, heat_station_code,
       heat_station_name, area_code
FROM points""",
    "stream_quarantine_good": f"""WITH {_POINTS}, good AS (
  SELECT CAST(user_id AS INTEGER) AS id, {_FLOAT_VALUE} AS point_value,
         CAST({_STATUS} AS INTEGER) AS status, {_whole_second('ts')} AS at
  FROM events WHERE NOT {_BROKEN} AND NOT {_BARE}
  UNION ALL SELECT CAST(event_id AS INTEGER), NULL, NULL, NULL
  FROM events WHERE NOT {_BROKEN} AND {_BARE})
SELECT d.point_id, d.point_name, f.point_value, f.status AS point_status,
       d.point_index_name, d.heat_station_code, d.heat_station_name, d.area_code,
       f.at AS collect_time, f.at AS real_time
FROM good f JOIN points d ON f.id = d.point_id""",
    "trial_two_outputs": f"""SELECT 'rows' AS output, count(*) AS total FROM ({_DATAGEN}) one
UNION ALL SELECT 'counted', count(*) FROM ({_DATAGEN}) two""",
    "sink_new_checkpoint": f"""{_enriched(_NOT_SENTINEL, _whole_second)}
UNION ALL SELECT * FROM ({_enriched(_NOT_SENTINEL, _whole_second)}) again""",
    "stream_enrich": _enriched(_NOT_SENTINEL, _whole_second),
    "stream_enrich_uncached": _enriched(_NOT_SENTINEL, _whole_second),
    "stream_frames": _FRAMES_ENRICHED,
    "stream_quarantine": _MESSAGE_REJECTS,
    "stream_count": """SELECT count(*) AS total
FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey % 2 = 0""",
    "stream_datagen": _DATAGEN,
    "sink_replay": _enriched(_NOT_SENTINEL),
    "stream_dimension_bucketed": _enriched(_NOT_SENTINEL, _whole_second),
    "stream_dimension_retried": _enriched(_NOT_SENTINEL, _whole_second),
    "sink_compacted": _enriched(_NOT_SENTINEL),
    "sink_label_log": _enriched(_NOT_SENTINEL, _whole_second),
    "stream_count_changes": _CHANGES,
    "stream_count_changelog": f"""SELECT batch, '+I' AS kind, after AS total FROM ({_CHANGES}) c WHERE batch = 0
UNION ALL SELECT batch, '-U', before FROM ({_CHANGES}) c WHERE batch > 0 AND before <> after
UNION ALL SELECT batch, '+U', after FROM ({_CHANGES}) c WHERE batch > 0 AND before <> after""",
    "stream_bounded_rows": f"SELECT *, TRUE AS within_bound FROM ({_enriched('TRUE', _whole_second)}) rows_found",
    "ledger_large": f"""SELECT cm, no, part, kind || '],"}}\\ {{' AS kind, user FROM ({_LEDGER}) rows_found""",
    "ledger_emptied_day": f"""SELECT * FROM ({_LEDGER}) rows_found
WHERE day(CAST(cm AS DATE) + INTERVAL 1 DAY) % 2 = 1""",
}
