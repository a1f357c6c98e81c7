"""The registered queries as SQL for the checking engine.

The packet line is the same text as on Spark's side. From there on lines are parsed with the
engine's own JSON functions, and everything else is plain SQL.
"""

from __future__ import annotations

from wirelake.plans.derived import COUNT_SQL, METRIC_LINES_SQL, line_sql
from wirelake.plans import settings as P

_MS = "(epoch_us(ts) // 1000)"

_V4 = r"((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _address(text: str) -> str:
    # The derived lines hold three forms of IPv6 text; each has one short form.
    return f"""CASE WHEN regexp_full_match({text}, '{_V4}') THEN {text}
      WHEN contains({text}, ':')
      THEN regexp_replace(replace(lower({text}), ':0:0::', '::'), '::0$', '::') END"""


def _integer(text: str) -> str:
    return f"CASE WHEN regexp_full_match({text}, '[+-]?[0-9]+') THEN TRY_CAST({text} AS BIGINT) END"


LINES = f"""lines AS (
  SELECT event_id, ts AS event_ts, user_id, event_type, {line_sql(_MS)} AS line FROM events)"""

_LAYERS = ("frame", "ip", "ipv6", "tcp", "udp")
_BAD_LAYER = " OR ".join(
    f"coalesce(json_type(doc, '$.layers.{name}'), 'NULL') NOT IN ('OBJECT', 'NULL')" for name in _LAYERS
)

SHAPED = f"""{LINES},
docs AS (SELECT *, CASE WHEN json_valid(line) THEN line END AS doc FROM lines),
texts AS (
  SELECT *,
    doc IS NULL OR json_type(doc) <> 'OBJECT' OR {_BAD_LAYER} AS malformed,
    coalesce(json_extract_string(doc, '$.timestamp'), '') AS t_time,
    coalesce(CASE WHEN json_type(doc, '$.layers.ip') = 'OBJECT'
      THEN json_extract_string(doc, '$.layers.ip.ip_ip_src')
      ELSE json_extract_string(doc, '$.layers.ipv6.ipv6_ipv6_src') END, '') AS t_src,
    coalesce(CASE WHEN json_type(doc, '$.layers.ip') = 'OBJECT'
      THEN json_extract_string(doc, '$.layers.ip.ip_ip_dst')
      ELSE json_extract_string(doc, '$.layers.ipv6.ipv6_ipv6_dst') END, '') AS t_dst,
    coalesce(CASE WHEN json_type(doc, '$.layers.tcp') = 'OBJECT'
      THEN json_extract_string(doc, '$.layers.tcp.tcp_tcp_srcport')
      ELSE json_extract_string(doc, '$.layers.udp.udp_udp_srcport') END, '') AS t_sport,
    coalesce(CASE WHEN json_type(doc, '$.layers.tcp') = 'OBJECT'
      THEN json_extract_string(doc, '$.layers.tcp.tcp_tcp_dstport')
      ELSE json_extract_string(doc, '$.layers.udp.udp_udp_dstport') END, '') AS t_dport,
    coalesce(json_extract_string(doc, '$.layers.frame.frame_frame_len'), '') AS t_len,
    coalesce(json_extract_string(doc, '$.layers.frame.frame_frame_protocols'), '') AS proto
  FROM docs),
numbers AS (
  SELECT *, {_integer('t_time')} AS ms, {_address('t_src')} AS src_ip, {_address('t_dst')} AS dst_ip,
    {_integer('t_sport')} AS sport, {_integer('t_dport')} AS dport,
    CASE WHEN t_len = '' THEN 0 ELSE {_integer('t_len')} END AS len
  FROM texts),
shaped AS (
  SELECT event_id, event_type, event_ts, line,
    make_timestamp_ms(ms) AS ts, src_ip, dst_ip, TRY_CAST(sport AS INTEGER) AS src_port,
    TRY_CAST(dport AS INTEGER) AS dst_port, proto, TRY_CAST(len AS INTEGER) AS length, line AS payload,
    CASE WHEN malformed THEN 'malformed_json' WHEN ms IS NULL THEN 'bad_timestamp'
      WHEN t_src = '' OR t_dst = '' THEN 'missing_ip'
      WHEN src_ip IS NULL THEN 'invalid_src_ip' WHEN dst_ip IS NULL THEN 'invalid_dst_ip'
      WHEN t_sport <> '' AND sport IS NULL THEN 'invalid_port'
      WHEN t_dport <> '' AND dport IS NULL THEN 'invalid_port'
      WHEN len IS NULL THEN 'invalid_length'
      WHEN abs(coalesce(sport, 0)) > 2147483647 OR abs(coalesce(dport, 0)) > 2147483647
        OR abs(len) > 2147483647 THEN 'out_of_range' END AS reason,
    CASE WHEN malformed THEN 'unmarshal ek' WHEN ms IS NULL THEN 'parse timestamp "' || t_time || '"'
      WHEN t_src = '' OR t_dst = '' THEN 'missing IP addresses: src=' || t_src || ', dst=' || t_dst
      WHEN src_ip IS NULL THEN 'invalid src IP "' || t_src || '"'
      WHEN dst_ip IS NULL THEN 'invalid dst IP "' || t_dst || '"'
      WHEN t_sport <> '' AND sport IS NULL THEN 'invalid port "' || t_sport || '"'
      WHEN t_dport <> '' AND dport IS NULL THEN 'invalid port "' || t_dport || '"'
      WHEN len IS NULL THEN 'invalid frame_frame_len "' || t_len || '"'
      WHEN abs(coalesce(sport, 0)) > 2147483647 OR abs(coalesce(dport, 0)) > 2147483647
        OR abs(len) > 2147483647 THEN 'value does not fit its column' END AS error
  FROM numbers)"""

_EIGHT = "ts, src_ip, dst_ip, src_port, dst_port, proto, length, payload"
_SEVEN = "ts, src_ip, dst_ip, src_port, dst_port, proto, length"

PACKETS = f"{SHAPED},\npackets AS (SELECT event_id, event_type, {_EIGHT} FROM shaped WHERE reason IS NULL)"

# The second table of the comparisons, and the packets with repeated deliveries.
OTHER = """other AS (
  SELECT event_id, ts, src_ip, dst_ip, src_port, dst_port, proto,
    CASE WHEN ends_with(proto, ':icmp') THEN length + 1 ELSE length END AS length,
    replace(payload, ',', ', ') AS payload
  FROM packets)"""
DELIVERED = f"""delivered AS (
  SELECT {_EIGHT} FROM packets UNION ALL SELECT {_EIGHT} FROM packets WHERE dst_port = 53)"""

_ROW_TEXT = """concat_ws('|', coalesce(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '~'), coalesce(src_ip, '~'),
  coalesce(dst_ip, '~'), coalesce(CAST(src_port AS VARCHAR), '~'), coalesce(CAST(dst_port AS VARCHAR), '~'),
  coalesce(proto, '~'), coalesce(CAST(length AS VARCHAR), '~'))"""


def _digest(text: str) -> str:
    return f"""coalesce(md5(CAST(CAST(sum(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)) AS HUGEINT)
      AS VARCHAR)), 'empty')"""


_ID = """sha256(concat_ws('|', CAST(epoch_us(ts) AS VARCHAR), src_ip, dst_ip,
  coalesce(CAST(src_port AS VARCHAR), '~'), coalesce(CAST(dst_port AS VARCHAR), '~'), proto))"""

METRIC_LINES = "metric_lines AS (\n  " + "\n  UNION ALL ".join(
    f"SELECT event_type AS service, ts AS scrape_ts, {sql} AS line FROM events" for sql in METRIC_LINES_SQL
) + ")"

SAMPLES = METRIC_LINES + r""",
split AS (
  SELECT service, scrape_ts, regexp_extract(trim(line), '^(.*) ([^ ]*)$', 1) AS series,
    TRY_CAST(regexp_extract(trim(line), '^(.*) ([^ ]*)$', 2) AS DOUBLE) AS value
  FROM metric_lines WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#') AND contains(trim(line), ' ')),
samples AS (
  SELECT service, scrape_ts, series, split_part(series, '{', 1) AS name,
    regexp_extract(series, '.*service="([^"]*)"', 1) AS service_label,
    nullif(regexp_extract(series, 'shard="([^"]*)"', 1), '') AS shard_label, value
  FROM split WHERE value IS NOT NULL AND NOT isinf(value))"""

_STEP, _WINDOW = P.STEP_US, P.WINDOW_US

# Every window is filled by comparing times, and the step between samples is taken anew
# inside each window.
WINDOWS = f"""{SAMPLES},
counters AS (SELECT service, series, epoch_us(scrape_ts) AS us, value FROM samples
  WHERE name = 'worker_rows_inserted_total'),
ends AS (SELECT service, series, us, value, unnest(generate_series(
    CAST(ceil(us / {_STEP}.0) AS BIGINT) * {_STEP}, (us + {_WINDOW}) // {_STEP} * {_STEP}, {_STEP})) AS at_us
  FROM counters),
stepped AS (SELECT *, lag(value) OVER (PARTITION BY service, series, at_us ORDER BY us) AS before FROM ends),
windows AS (SELECT service, series, at_us, count(*) AS n, min(us) AS first_us, max(us) AS last_us,
    arg_min(value, us) AS first_value,
    coalesce(sum(CASE WHEN before IS NULL THEN 0 WHEN value >= before THEN value - before ELSE value END), 0)
      AS increase
  FROM stepped GROUP BY service, series, at_us HAVING count(*) > 1)"""

_SPAN = "((last_us - first_us) / 1e6)"
_AVG = f"({_SPAN} / (n - 1))"
_LEAD = f"((first_us - (at_us - {_WINDOW})) / 1e6)"
_TRAIL = "((at_us - last_us) / 1e6)"
_LEAD_1 = f"(CASE WHEN {_LEAD} >= {_AVG} * 1.1 THEN {_AVG} / 2 ELSE {_LEAD} END)"
_LEAD_2 = f"""(CASE WHEN increase > 0 AND first_value >= 0
  THEN least({_LEAD_1}, {_SPAN} * (first_value / increase)) ELSE {_LEAD_1} END)"""
_TRAIL_1 = f"(CASE WHEN {_TRAIL} >= {_AVG} * 1.1 THEN {_AVG} / 2 ELSE {_TRAIL} END)"
_STRETCHED = f"(increase * (({_SPAN} + {_LEAD_2} + {_TRAIL_1}) / {_SPAN}))"



def _rates(amount: str) -> str:
    return f"""WITH {WINDOWS} SELECT service, series, make_timestamp(at_us) AS at,
      round({amount}, 6) AS increase, round({amount} / {_WINDOW / 1e6}, 6) AS rate FROM windows"""


# The series a dashboard of the pipeline reads.
_REQUIRED = (
    "VALUES ('worker_msgs_consumed_total'), ('worker_rows_inserted_total'), ('worker_batch_flush_total'), "
    "('worker_deadletter_total'), ('worker_db_errors_total'), ('worker_buffer_size'), ('process_memory_bytes')"
)

SOAK = f"""{SAMPLES},
per_scrape AS (
  SELECT service, scrape_ts, name, sum(value) AS value FROM samples GROUP BY service, scrape_ts, name),
wide AS (
  SELECT service, scrape_ts,
    coalesce(sum(value) FILTER (name = 'process_memory_bytes'), 0) AS rss,
    coalesce(sum(value) FILTER (name = 'worker_buffer_size'), 0) AS buffer,
    coalesce(sum(value) FILTER (name = 'worker_deadletter_total'), 0) AS dead,
    coalesce(sum(value) FILTER (name = 'worker_db_errors_total'), 0) AS errors,
    coalesce(sum(value) FILTER (name = 'worker_rows_inserted_total'), 0) AS inserted,
    coalesce(sum(value) FILTER (name = 'worker_msgs_consumed_total'), 0) AS consumed
  FROM per_scrape GROUP BY service, scrape_ts),
absent AS (
  SELECT f.service, string_agg(r.name, ',' ORDER BY r.name) AS missing
  FROM (SELECT service, min(scrape_ts) AS scrape_ts FROM wide GROUP BY service) f
  CROSS JOIN ({_REQUIRED}) r(name)
  WHERE NOT EXISTS (SELECT 1 FROM per_scrape p
    WHERE p.service = f.service AND p.scrape_ts = f.scrape_ts AND p.name = r.name)
  GROUP BY f.service),
runs AS (
  SELECT service, count(*) AS samples, arg_min(rss, scrape_ts) AS first_rss, max(rss) AS peak_rss,
    arg_max(rss, scrape_ts) AS final_rss, max(buffer) AS peak_buffer, arg_max(buffer, scrape_ts) AS final_buffer,
    arg_max(dead, scrape_ts) AS dead_letters, arg_max(errors, scrape_ts) AS db_errors,
    arg_max(inserted, scrape_ts) - arg_min(inserted, scrape_ts) AS rows_inserted,
    arg_max(consumed, scrape_ts) AS msgs_consumed,
    (epoch_us(max(scrape_ts)) - epoch_us(min(scrape_ts))) / 1e6 AS elapsed_s
  FROM wide GROUP BY service),
judged AS (
  SELECT r.*, coalesce(a.missing, '') AS missing, concat_ws('; ',
    CASE WHEN peak_rss > 20971520 THEN 'memory_over_limit' END,
    CASE WHEN dead_letters > 0 THEN 'dead_letters_over_limit' END,
    CASE WHEN final_buffer > 0 AND final_buffer >= peak_buffer THEN 'buffer_still_at_peak' END,
    CASE WHEN rows_inserted = 0 THEN 'no_new_rows' END,
    CASE WHEN elapsed_s < {P.SOAK_S} THEN 'run_too_short' END) AS failures
  FROM runs r LEFT JOIN absent a USING (service))"""

_POLLS = f"polls AS (SELECT event_type AS table_name, ts, CAST({COUNT_SQL} AS BIGINT) AS n FROM events)"

# Batches by count or time, followed one row after the other.
BATCHES = f"""WITH RECURSIVE rows_ AS MATERIALIZED (
  SELECT event_type AS key, event_id AS seq, epoch_us(ts) AS us,
    row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS i FROM events),
walk AS (
  SELECT key, i, us, seq, 1 AS filled, us AS flushed, CAST(0 AS BIGINT) AS batch_no,
    {P.BATCH_ROWS} <= 1 AS closes FROM rows_ WHERE i = 1
  UNION ALL
  SELECT r.key, r.i, r.us, r.seq,
    CASE WHEN w.closes THEN 1 ELSE w.filled + 1 END,
    CASE WHEN w.closes THEN w.us ELSE w.flushed END,
    CASE WHEN w.closes THEN w.batch_no + 1 ELSE w.batch_no END,
    CASE WHEN w.closes THEN 1 ELSE w.filled + 1 END >= {P.BATCH_ROWS}
      OR r.us - CASE WHEN w.closes THEN w.us ELSE w.flushed END >= {P.BATCH_US}
  FROM walk w JOIN rows_ r ON r.key = w.key AND r.i = w.i + 1)
SELECT key, batch_no, count(*) AS rows, min(seq) AS first_seq, max(seq) AS last_seq,
  bool_or(closes) AS closed
FROM walk GROUP BY key, batch_no"""


def oracle_sql() -> dict[str, str]:
    eight = f"WITH {PACKETS} SELECT {_EIGHT} FROM packets"
    clean = f"WITH {LINES} SELECT event_id, line AS value FROM lines"
    minute = "date_trunc('minute', ts)"
    retained = f"""WITH {PACKETS} SELECT {_EIGHT} FROM packets
          WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR > TIMESTAMP '{P.NOW}' - INTERVAL 1 DAY"""
    return {
        "ek_scan": clean,
        "ek_stream": clean,
        "replay_expand": f"""WITH {LINES}, numbered AS (
            SELECT event_id, line AS value, row_number() OVER (ORDER BY event_id) - 1 AS seq FROM lines)
          SELECT event_id, value, seq, pass, pass * (SELECT count(*) FROM lines) + seq AS emit_idx
          FROM numbered, (SELECT unnest(range({P.PASSES})) AS pass)""",
        "shape_packets": eight,
        "packets_scan": eight,
        "packets_append": eight,
        "talker_layout": f"WITH {PACKETS} SELECT {_EIGHT}, date_trunc('hour', ts) AS chunk FROM packets",
        "ingest_stream": eight,
        "payload_verbatim": f"WITH {PACKETS} SELECT event_id, payload, md5(payload) AS payload_md5 FROM packets",
        "layer_precedence": f"""WITH {SHAPED} SELECT event_id,
            CASE WHEN contains(src_ip, ':') THEN 6 ELSE 4 END AS ip_version,
            src_ip, dst_ip, src_port, dst_port FROM shaped WHERE reason IS NULL""",
        "ip_canonical": f"""WITH {SHAPED} SELECT event_id, src_ip, dst_ip FROM shaped
            WHERE reason IS DISTINCT FROM 'malformed_json'""",
        "quarantine": f"WITH {SHAPED} SELECT event_id, reason, error, line FROM shaped WHERE reason IS NOT NULL",
        "dead_letters": f"""WITH {SHAPED} SELECT error, line AS raw_ek_line,
            CAST(epoch(TIMESTAMP '{P.NOW}') AS BIGINT) AS ts FROM shaped WHERE reason IS NOT NULL""",
        "ingest_counters": f"""WITH {SHAPED} SELECT event_id // {P.BATCH_ROWS} AS batch,
            count(*) FILTER (reason IS NULL) AS consumed, count(*) FILTER (reason IS NULL) AS inserted,
            count(*) FILTER (reason IS NOT NULL) AS dead_letters,
            CASE WHEN count(*) FILTER (reason IS NULL) > 0 THEN 1 ELSE 0 END AS flushes
          FROM shaped GROUP BY 1""",
        "chunked_table": f"WITH {PACKETS} SELECT {_EIGHT}, date_trunc('hour', ts) AS chunk FROM packets",
        "parquet_sink": eight,
        "fan_out": f"""WITH {SHAPED}
          SELECT 'packets' AS sink, line, NULL AS error FROM shaped WHERE reason IS NULL
          UNION ALL SELECT 'dead_letters', line, error FROM shaped WHERE reason IS NOT NULL
          UNION ALL SELECT 'lines', line, NULL FROM shaped""",
        "dedup_stream": f"WITH {PACKETS} SELECT DISTINCT {_SEVEN.replace(', length', '')} FROM packets",
        "run_metrics": f"""WITH {SHAPED}
          SELECT 'ingestor_lines_read_total' AS name, CAST(count(*) AS DOUBLE) AS value, CAST(NULL AS BOOLEAN) AS fell FROM shaped
          UNION ALL SELECT 'ingestor_msgs_published_total', count(*), NULL FROM shaped
          UNION ALL SELECT 'worker_batch_flush_total', 3, NULL
          UNION ALL SELECT 'worker_db_errors_total', 0, NULL
          UNION ALL SELECT 'worker_buffer_size', 0, true
          UNION ALL SELECT 'process_memory_bytes', NULL, NULL
          UNION ALL SELECT 'worker_msgs_consumed_total', count(*) FILTER (reason IS NULL), NULL FROM shaped
          UNION ALL SELECT 'worker_rows_inserted_total', count(*) FILTER (reason IS NULL), NULL FROM shaped
          UNION ALL SELECT 'worker_deadletter_total', count(*) FILTER (reason IS NOT NULL), NULL FROM shaped""",
        # Three micro-batches; after the first of them a file waits.
        "own_soak": f"""WITH {SHAPED} SELECT 3 AS samples, CAST(count(*) FILTER (reason IS NOT NULL) AS DOUBLE) AS dead_letters,
            CAST(0 AS DOUBLE) AS db_errors, CAST(count(*) FILTER (reason IS NULL) AS DOUBLE) AS msgs_consumed,
            CAST(0 AS DOUBLE) AS final_buffer, 1 AS alerts, 1 AS episodes, '' AS missing, '' AS failures, true AS passed FROM shaped""",
        "isolated_batch": f"""WITH {SHAPED} SELECT line, CASE WHEN reason IS NOT NULL THEN 'dead letter'
            WHEN length = {P.ODD_LENGTH} AND dst_ip = '{P.ODD_ADDRESS}' THEN 'refused' ELSE 'packet' END AS kind FROM shaped""",
        "dedup_stored": f"WITH {PACKETS} SELECT DISTINCT {_SEVEN.replace(', length', '')} FROM packets",
        "compacted_packets": f"""WITH {PACKETS} SELECT {_EIGHT}, 1 AS files FROM packets
          WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR > TIMESTAMP '{P.NOW}' - INTERVAL 1 DAY""",
        "table_lifecycle": f"""WITH {PACKETS} SELECT 'created' AS step, 0 AS n UNION ALL SELECT 'emptied', 0
          UNION ALL SELECT 'filled', count(*) FROM packets""",
        "retention": retained,
        "retained_packets": retained,
        "row_count": f"WITH {PACKETS} SELECT count(*) AS n FROM packets",
        "latest_packets": f"""WITH {PACKETS} SELECT ts, src_ip, dst_ip, proto FROM packets
          ORDER BY ts DESC, src_ip, dst_ip, proto LIMIT 10""",
        "top_talkers": f"""WITH {PACKETS} SELECT src_ip, dst_ip, count(*) AS cnt FROM packets
          GROUP BY src_ip, dst_ip ORDER BY cnt DESC, src_ip, dst_ip LIMIT 10""",
        "heavy_talkers": f"""WITH {PACKETS} SELECT src_ip, dst_ip, count(*) AS cnt, true AS within FROM packets
          GROUP BY src_ip, dst_ip ORDER BY cnt DESC, src_ip, dst_ip LIMIT 10""",
        "talker_lookback": f"""WITH {PACKETS} SELECT {_EIGHT} FROM packets
          WHERE src_ip = '{P.TALKER[0]}' AND dst_ip = '{P.TALKER[1]}'
            AND ts >= TIMESTAMP '{P.LOW}' AND ts < TIMESTAMP '{P.HIGH}'""",
        "capture_filter": f"""WITH {PACKETS} SELECT {_EIGHT} FROM packets
          WHERE list_contains(string_split(proto, ':'), 'tcp') AND (src_port = 443 OR dst_port = 443)""",
        "capture_filter_not": f"""WITH {PACKETS} SELECT {_EIGHT} FROM packets
          WHERE NOT coalesce(src_port = 53 OR dst_port = 53, false)""",
        "payload_contains": f"""WITH {PACKETS} SELECT event_id, payload FROM packets
          WHERE json_contains(payload, '{{"layers": {{"udp": {{"udp_udp_dstport": "53"}}, "dns": {{"dns_dns_qry_name": "click.example"}}}}}}')""",
        "payload_index": f"""WITH {PACKETS} SELECT {_EIGHT} FROM packets
          WHERE json_contains(payload, '{{"layers": {{"udp": {{"udp_udp_dstport": "53"}}, "dns": {{"dns_dns_qry_name": "click.example"}}}}}}')""",
        "payload_variant": f"""WITH {PACKETS} SELECT event_id,
            json_extract_string(payload, '$.layers.frame.frame_frame_len') AS frame_len,
            json_extract_string(payload, '$.layers.udp.udp_udp_dstport') AS udp_port FROM packets""",
        "app_columns": f"""WITH {PACKETS} SELECT event_id, src_ip, dst_ip,
            json_extract_string(payload, '$.layers.http.http_http_host') AS http_host,
            json_extract_string(payload, '$.layers.dns.dns_dns_qry_name') AS dns_query FROM packets""",
        "proto_parts": f"""WITH {PACKETS} SELECT split_part(proto, ':', -1) AS leaf,
            CAST(CASE WHEN proto = '' THEN 0 ELSE len(string_split(proto, ':')) END AS INTEGER) AS depth,
            count(*) AS packets, CAST(sum(length) AS BIGINT) AS bytes FROM packets GROUP BY 1, 2""",
        "table_checksum": f"""WITH {PACKETS} SELECT count(*) AS rows, {_digest(_ROW_TEXT)} AS digest FROM packets""",
        "payload_checksum": f"WITH {PACKETS} SELECT {_digest('payload')} AS payloads FROM packets",
        "diff_rows": f"""WITH {PACKETS}, {OTHER}
          SELECT {_SEVEN} FROM packets EXCEPT ALL SELECT {_SEVEN} FROM other""",
        "diff_by_digest": f"""WITH {PACKETS}, {OTHER}
          SELECT {_SEVEN} FROM packets EXCEPT ALL SELECT {_SEVEN} FROM other""",
        "diff_sample": f"""WITH {PACKETS}, {OTHER}, missing AS (
            SELECT {_SEVEN} FROM packets EXCEPT ALL SELECT {_SEVEN} FROM other)
          SELECT * FROM missing ORDER BY ts, src_ip, dst_ip, src_port NULLS FIRST, dst_port NULLS FIRST,
            proto, length LIMIT 5""",
        "verify_tables": f"""WITH {PACKETS}, {OTHER},
          a AS (SELECT count(*) AS rows, {_digest(_ROW_TEXT)} AS digest, {_digest('payload')} AS payloads FROM packets),
          b AS (SELECT count(*) AS rows, {_digest(_ROW_TEXT)} AS digest, {_digest('payload')} AS payloads FROM other)
          SELECT a.rows AS rows_a, a.digest AS digest_a, a.payloads AS payloads_a,
            b.rows AS rows_b, b.digest AS digest_b, b.payloads AS payloads_b,
            concat_ws('; ', CASE WHEN a.rows = 0 OR b.rows = 0 THEN 'a side is empty' END,
              CASE WHEN a.rows <> b.rows THEN printf('rows differ: %d and %d', a.rows, b.rows) END,
              CASE WHEN a.digest <> b.digest THEN 'columns differ' END,
              CASE WHEN a.payloads <> b.payloads THEN 'payloads differ' END) AS problems,
            a.rows > 0 AND a.rows = b.rows AND a.digest = b.digest AND a.payloads = b.payloads AS passed
          FROM a, b""",
        "reconcile_counts": f"""WITH {SHAPED}, ids AS (
            SELECT reason, event_id % 20 AS slot, coalesce(src_port = 53 OR dst_port = 53, false) AS dns,
              CASE WHEN reason IS NULL THEN {_ID} ELSE line END AS id FROM shaped),
          copies AS (
            SELECT run, reason, id, 1 AS came,
              CASE WHEN reason IS NOT NULL THEN 1 WHEN run = 'holes' AND dns THEN 0 WHEN run = 'twice' AND dns THEN 2
                WHEN run = 'both' AND slot = 1 THEN 0 WHEN run = 'both' AND slot = 2 THEN 2 ELSE 1 END AS stored
            FROM ids, (VALUES ('whole'), ('holes'), ('twice'), ('both')) runs(run)),
          each_id AS (SELECT run, reason IS NULL AS packet, id, sum(came) AS came, sum(stored) AS stored FROM copies GROUP BY ALL),
          counted AS (
            SELECT run, CAST(sum(came) AS BIGINT) AS lines_in, CAST(coalesce(sum(stored) FILTER (packet), 0) AS BIGINT) AS packets,
              CAST(coalesce(sum(stored) FILTER (NOT packet), 0) AS BIGINT) AS dead_letters,
              count(*) FILTER (packet AND stored > 0) AS distinct_ids,
              CAST(sum(greatest(came - stored, 0)) AS BIGINT) AS lost, CAST(sum(greatest(stored - came, 0)) AS BIGINT) AS doubled
            FROM each_id GROUP BY run)
          SELECT *, packets - distinct_ids AS duplicates,
            CASE WHEN lines_in = 0 THEN 'empty' WHEN lost > 0 AND doubled > 0 THEN 'lost_and_doubled' WHEN lost > 0 THEN 'lost'
              WHEN doubled > 0 THEN 'doubled' ELSE 'complete' END AS status
          FROM counted""",
        "dedup_packets": f"""WITH {PACKETS}, {DELIVERED}
          SELECT {_ID} AS msg_id, {_SEVEN.replace(', length', '')}, min(length) AS length,
            arg_min(payload, (length, payload)) AS payload, count(*) AS copies
          FROM delivered GROUP BY {_SEVEN.replace(', length', '')}""",
        "pps_per_minute": f"""WITH {PACKETS} SELECT {minute} AS minute, count(*) AS packets,
            CAST(sum(length) AS BIGINT) AS bytes, round(count(*) / 60.0, 6) AS pps FROM packets GROUP BY 1""",
        "talkers_per_minute": f"""WITH {PACKETS}, pairs AS (
            SELECT {minute} AS minute, src_ip, dst_ip, count(*) AS packets FROM packets GROUP BY ALL),
          ranked AS (SELECT *, CAST(row_number() OVER (
            PARTITION BY minute ORDER BY packets DESC, src_ip, dst_ip) AS INTEGER) AS rank FROM pairs)
          SELECT minute, src_ip, dst_ip, packets, rank FROM ranked WHERE rank <= 3""",
        "pps_rollup": f"""WITH {PACKETS} SELECT {minute} AS minute, count(*) AS packets,
            CAST(sum(length) AS BIGINT) AS bytes, round(count(*) / 60.0, 6) AS pps FROM packets GROUP BY 1""",
        "talkers_rollup": f"""WITH {PACKETS}, pairs AS (
            SELECT {minute} AS minute, src_ip, dst_ip, count(*) AS packets FROM packets GROUP BY ALL),
          ranked AS (SELECT *, CAST(row_number() OVER (
            PARTITION BY minute ORDER BY packets DESC, src_ip, dst_ip) AS INTEGER) AS rank FROM pairs)
          SELECT minute, src_ip, dst_ip, packets, rank FROM ranked WHERE rank <= 3""",
        "ingest_latency": f"""WITH {PACKETS}, delays AS (
            SELECT 'event_type' AS kind, event_type AS grp, CAST((event_id * 7) % 3000 AS BIGINT) AS ms FROM packets
            UNION ALL SELECT 'leaf', split_part(proto, ':', -1), CAST(length * 7 % 3000 AS BIGINT) FROM packets)
          SELECT kind, grp, count(*) AS packets, min(ms) AS min_ms, max(ms) AS max_ms,
            quantile_disc(ms, 0.5) AS p50_ms, quantile_disc(ms, 0.95) AS p95_ms,
            count(*) FILTER (ms <= 1000) AS in_time,
            CASE WHEN kind = 'leaf' THEN true END AS p50_ok, CASE WHEN kind = 'leaf' THEN true END AS p95_ok
          FROM delays GROUP BY kind, grp""",
        "metrics_parse": f"WITH {SAMPLES} SELECT service, scrape_ts, series, name, service_label, shard_label, value FROM samples",
        "sum_across_labels": f"""WITH {SAMPLES} SELECT service, scrape_ts, name, sum(value) AS value
          FROM samples GROUP BY service, scrape_ts, name""",
        "metric_contract": f"""WITH {SAMPLES}, runs AS (SELECT DISTINCT service FROM samples)
          SELECT r.service, q.name AS missing FROM runs r CROSS JOIN ({_REQUIRED}) q(name)
          WHERE NOT EXISTS (SELECT 1 FROM samples s WHERE s.service = r.service AND s.name = q.name)""",
        "backlog_alert": f"""WITH {SAMPLES} SELECT service, scrape_ts, series, value FROM samples
          WHERE name = 'worker_buffer_size' AND value > 0.75 * 50000""",
        "backlog_episodes": f"""WITH {SAMPLES}, above AS (
            SELECT service, scrape_ts, value, lag(scrape_ts) OVER (PARTITION BY service ORDER BY scrape_ts) AS before
            FROM samples WHERE name = 'worker_buffer_size' AND value > 0.75 * 50000),
          marked AS (SELECT *, sum(CASE WHEN before IS NULL OR scrape_ts - before > INTERVAL {P.EPISODE_S} SECOND THEN 1 ELSE 0 END)
              OVER (PARTITION BY service ORDER BY scrape_ts ROWS UNBOUNDED PRECEDING) AS episode FROM above)
          SELECT service, min(scrape_ts) AS started, max(scrape_ts) AS ended, max(value) AS peak, count(*) AS samples
          FROM marked GROUP BY service, episode""",
        "memory_text": f"""WITH {SAMPLES} SELECT service, scrape_ts, printf('%.1f MiB', round_even(value / 1048576, 1)) AS size
          FROM samples WHERE name = 'process_memory_bytes'""",
        "gauge_sum": f"""WITH {SAMPLES}, latest AS (
            SELECT (epoch_us(scrape_ts) + {_STEP - 1}) // {_STEP} * {_STEP} AS us, series, arg_max(value, scrape_ts) AS value
            FROM samples WHERE name = 'process_memory_bytes' GROUP BY 1, 2)
          SELECT make_timestamp(us) AS step, sum(value) AS value FROM latest GROUP BY us""",
        "gauge_per_service": f"""WITH {SAMPLES}
          SELECT service, make_timestamp((epoch_us(scrape_ts) + {_STEP - 1}) // {_STEP} * {_STEP}) AS step,
            arg_max(value, scrape_ts) AS value
          FROM samples WHERE name = 'process_memory_bytes' GROUP BY 1, 2""",
        "counter_rate": _rates("increase"),
        "live_rates": _rates("increase"),
        "counter_rate_extrapolated": _rates(_STRETCHED),
        "counter_increase": f"""WITH {WINDOWS} SELECT make_timestamp(at_us) AS at, round(sum(increase), 6) AS increase
          FROM windows GROUP BY at_us""",
        "soak_gate": f"""WITH {SOAK} SELECT service, samples, first_rss, peak_rss, final_rss, peak_buffer, final_buffer,
            dead_letters, db_errors, rows_inserted, msgs_consumed, round(elapsed_s, 6) AS elapsed_s,
            round(rows_inserted / elapsed_s, 9) AS throughput, missing, failures,
            failures = '' AND missing = '' AS passed FROM judged""",
        "settled_at": f"""WITH {_POLLS},
          changes AS (SELECT *, coalesce(n <> lag(n) OVER w, true) AS changed FROM polls
            WINDOW w AS (PARTITION BY table_name ORDER BY ts)),
          islands AS (SELECT *, sum(CASE WHEN changed THEN 1 ELSE 0 END) OVER (
            PARTITION BY table_name ORDER BY ts ROWS UNBOUNDED PRECEDING) AS island FROM changes),
          held AS (SELECT *, ts - min(ts) OVER (PARTITION BY table_name, island) AS quiet FROM islands),
          firsts AS (SELECT table_name, min(ts) AS ts, arg_min(n, ts) AS n FROM held
            WHERE NOT changed AND epoch_us(quiet) >= {P.STABLE_US} GROUP BY table_name),
          lasts AS (SELECT table_name, arg_max(n, ts) AS n FROM polls GROUP BY table_name)
          SELECT l.table_name, CASE WHEN f.ts IS NULL THEN 'timeout' WHEN f.n > 0 THEN 'settled' ELSE 'empty' END
            AS status, f.ts AS settled_ts, coalesce(f.n, l.n) AS n
          FROM lasts l LEFT JOIN firsts f USING (table_name)""",
        "pace_schedule": f"""WITH numbered AS (
            SELECT event_type AS key, event_id AS seq, ts AS arrival,
              row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS i FROM events)
          SELECT key, seq, arrival, make_timestamp(CAST((max(epoch_us(arrival) * CAST({P.PACE_ROWS} AS HUGEINT) - i * {P.PACE_US}) OVER (
              PARTITION BY key ORDER BY i ROWS UNBOUNDED PRECEDING) + i * {P.PACE_US} + {P.PACE_ROWS - 1})
              // {P.PACE_ROWS} AS BIGINT)) AS emit_at
          FROM numbered""",
        "batch_by_count": f"""SELECT event_type AS key, event_id AS seq,
            (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // {P.BATCH_ROWS} AS batch_no
          FROM events""",
        "batch_count_or_time": BATCHES,
    }
