"""The same results as plain SQL for another engine, for comparison only.

Written from the definitions rather than from the Spark code: coordinates, ranks and draws are spelled
out row by row. A statement is put together from the named parts it needs.
"""

from __future__ import annotations

import re

FLOAT = r"\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*"
INT = r"\s*[+-]?[0-9]+\s*"

START = "l_shipdate + to_minutes((l_orderkey * 37 + l_linenumber * 101) % 1440)"
STAMP = "'%Y-%m-%d %H:%M:%S'"


def sub(coordinate: str, shift: str) -> str:
    return f"CAST(floor(({coordinate} + CAST({shift} AS DOUBLE)) / CAST(0.00025 AS DOUBLE)) AS BIGINT)"


def cell(name: str) -> str:
    return f"CAST(floor({name} / CAST(20 AS DOUBLE)) AS BIGINT)"


def moment(name: str) -> str:
    return f"try_strptime({name}, {STAMP})"


def slot(name: str) -> str:
    return f"CAST((hour({moment(name)}) * 60 + minute({moment(name)})) // 10 AS INTEGER)"


def minute(name: str) -> str:
    at = moment(name)
    return f"CAST(hour({at}) * 60 + minute({at}) + (day({at}) - 1) * 1440 AS INTEGER)"


def centre(name: str, corner: str) -> str:
    return f"CAST({corner} AS DOUBLE) + ({name} + CAST(0.5 AS DOUBLE)) * CAST(0.00025 AS DOUBLE)"


def leading(digest: str, digits: int) -> str:
    return f"CAST('0x' || substr({digest}, 1, {digits}) AS BIGINT)"


def draw(seed: str, rank: str) -> str:
    """Four words to a digest: draw 1 takes the first word of digest 0, draw 5 that of digest 1."""
    digest = f"md5(concat({seed}, ':', ({rank} - 1) // 4))"
    word = f"CAST('0x' || substr({digest}, ({rank} - 1) % 4 * 8 + 1, 8) AS BIGINT)"
    return f"(({word} + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE))"


def drawn(matched: str, seed: str, keep: str, picks: int = 3) -> str:
    """Weighted draws one by one. After each the spot drawn is taken out and the running totals are made anew."""
    left = f"SELECT *, {seed} AS seed, CAST(least(passengers, 1099511627776) AS DOUBLE) AS weight FROM {matched}"
    steps, found = [f"left_1 AS ({left})"], []
    for nth in range(1, picks + 1):
        steps.append(f"""totals_{nth} AS (
            SELECT *, sum(weight) OVER (PARTITION BY event_id ORDER BY rn) AS ends,
                   {draw('seed', str(nth))} * sum(weight) OVER (PARTITION BY event_id) AS falls FROM left_{nth})""")
        steps.append(f"drawn_{nth} AS (SELECT *, {nth} AS pick_no FROM totals_{nth} WHERE ends - weight < falls AND falls <= ends)")
        steps.append(f"left_{nth + 1} AS (SELECT * FROM left_{nth} ANTI JOIN drawn_{nth} USING (event_id, rn))")
        found.append(f"SELECT {keep}, pick_no, longitude AS spot_lon, latitude AS spot_lat FROM drawn_{nth}")
    return f"WITH {', '.join(steps)} {' UNION ALL '.join(found)}"


# One number per copy, read as digits of the sizes 500, 4, 20 and 20.
SECONDS = "(number % 500 - 250)"
EXTRA = "(number // 500 % 4 = 3)"
EAST = "(number // 2000 % 20 - 10)"
NORTH = "(number // 40000 % 20 - 10)"


def moved(coordinate: str, steps: str) -> str:
    return f"round({coordinate} + {steps} / CAST(100000 AS DOUBLE), 10)"


PARTS: dict[str, str] = {
    "trips": f"""
        SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS trip_key,
               CAST(-74.05 AS DOUBLE) + ((l_partkey * 7919 + l_suppkey * 31) % 400) / CAST(10000 AS DOUBLE) AS longitude,
               CAST(40.70 AS DOUBLE) + ((l_orderkey * 104729 + l_linenumber * 17) % 400) / CAST(10000 AS DOUBLE) AS latitude,
               strftime({START}, {STAMP}) AS datetime,
               strftime({START} + to_seconds(300 + l_linenumber * 60), {STAMP}) AS dropoff,
               CAST(trunc(l_quantity) AS INTEGER) % 7 AS passengers
        FROM lineitem""",
    "faults": """
        SELECT CAST('0x' || substr(md5(trip_key), 1, 2) AS INTEGER) AS fault, datetime, dropoff,
               CAST(passengers AS VARCHAR) AS p, CAST(longitude AS VARCHAR) AS lon, CAST(latitude AS VARCHAR) AS lat
        FROM trips""",
    "lines": """
        SELECT CASE fault
                 WHEN 0 THEN 'vendor,pickup,dropoff,passengers,distance,longitude,latitude'
                 WHEN 1 THEN concat_ws(',', 'V1', datetime)
                 WHEN 2 THEN concat_ws(',', 'V1', datetime, dropoff, p, '1.5', lon, lat, '1', 'N', '', 'x', '2.5')
                 WHEN 3 THEN concat_ws(',', 'V1', datetime, dropoff, p || '.0', '1.5', lon, lat)
                 WHEN 4 THEN concat_ws(',', 'V1', datetime, dropoff, '', '1.5', lon, lat)
                 WHEN 5 THEN concat_ws(',', 'V1', datetime, dropoff, ' ' || p || ' ', '1.5', lon, lat)
                 WHEN 6 THEN concat_ws(',', 'V1', datetime, dropoff, p, '1.5', 'nan', lat)
                 WHEN 7 THEN concat_ws(',', 'V1', datetime, dropoff, p, '1.5', 'inf', lat)
                 WHEN 8 THEN concat_ws(',', 'V1', datetime, dropoff, p, '1.5', '3d', lat)
                 WHEN 9 THEN concat_ws(',', 'V1', '2008-5-3 5:6:7', dropoff, p, '1.5', lon, lat)
                 WHEN 10 THEN concat_ws(',', 'V1', '2008-05-13 15:62:35', dropoff, p, '1.5', lon, lat)
                 WHEN 11 THEN concat_ws(',', 'V1', datetime, dropoff, 'x', '1.5', lon, lat)
                 WHEN 12 THEN concat_ws(',', 'V1', datetime, dropoff, '9223372036854775807', '1.5', lon, lat)
                 ELSE concat_ws(',', 'V1', datetime, dropoff, p, '1.5', lon, lat)
               END AS value
        FROM faults""",
    "split_lines": "SELECT value, string_split(value, ',') AS part FROM lines",
    "parsed": f"""
        SELECT part[2] AS datetime,
               CASE WHEN regexp_full_match(part[4], '{INT}') THEN TRY_CAST(trim(part[4]) AS BIGINT) END AS passengers,
               CASE WHEN regexp_full_match(part[6], '{FLOAT}') THEN TRY_CAST(trim(part[6]) AS DOUBLE) END AS longitude,
               CASE WHEN regexp_full_match(part[7], '{FLOAT}') THEN TRY_CAST(trim(part[7]) AS DOUBLE) END AS latitude
        FROM split_lines""",
    "readable": """
        SELECT * FROM parsed
        WHERE datetime IS NOT NULL AND passengers IS NOT NULL AND longitude IS NOT NULL AND latitude IS NOT NULL""",
    "cleaned_text": f"""
        SELECT passengers, {sub('longitude', '74.25')} AS sub_x, {sub('latitude', '-40.5')} AS sub_y,
               {slot('datetime')} AS time_slot
        FROM readable WHERE passengers >= 1 AND {moment('datetime')} IS NOT NULL""",
    "placed": f"""
        SELECT *, {sub('longitude', '74.25')} AS sub_x, {sub('latitude', '-40.5')} AS sub_y, {slot('datetime')} AS time_slot
        FROM trips""",
    "cleaned": "SELECT * FROM placed WHERE passengers >= 1",
    "counts": f"""
        SELECT {cell('sub_x')} AS cell_x, {cell('sub_y')} AS cell_y, time_slot, sub_x, sub_y,
               CAST(least(sum(CAST(passengers AS HUGEINT)), CAST(9223372036854775807 AS HUGEINT)) AS BIGINT) AS passengers
        FROM cleaned GROUP BY ALL""",
    "own": """
        SELECT * FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY cell_x, cell_y, time_slot
                                            ORDER BY passengers DESC, sub_x, sub_y) AS INTEGER) AS rn
          FROM counts) WHERE rn <= 10""",
    "offers": """
        SELECT cell_x + dx AS cell_x, cell_y + dy AS cell_y,
               CAST(CASE WHEN dx = 0 AND dy = 0 THEN time_slot ELSE (time_slot + 143) % 144 END AS INTEGER) AS time_slot,
               sub_x, sub_y, passengers
        FROM own, (VALUES (-1), (0), (1)) AS a(dx), (VALUES (-1), (0), (1)) AS b(dy)""",
    "spots": f"""
        SELECT cell_x AS block_latid, cell_y AS block_lonid, time_slot, rn,
               {centre('sub_x', '-74.25')} AS longitude, {centre('sub_y', '40.5')} AS latitude, passengers
        FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY cell_x, cell_y, time_slot
                                            ORDER BY passengers DESC, sub_x, sub_y) AS INTEGER) AS rn
          FROM offers) WHERE rn <= 10""",
    "positions": f"""
        SELECT CAST(user_id AS VARCHAR) AS vehicle_id,
               CAST(-74.05 AS DOUBLE) + ((user_id * 7919 + event_id * 31) % 400) / CAST(10000 AS DOUBLE) AS longitude,
               CAST(40.70 AS DOUBLE) + ((user_id * 104729 + event_id * 17) % 400) / CAST(10000 AS DOUBLE) AS latitude,
               strftime(ts, {STAMP}) AS datetime, event_id
        FROM events""",
    "cleaned_positions": f"""
        SELECT vehicle_id, longitude, latitude, datetime, event_id, {slot('datetime')} AS time_slot,
               {cell(sub('longitude', '74.25'))} AS block_latid, {cell(sub('latitude', '-40.5'))} AS block_lonid
        FROM positions""",
    "messages": """
        SELECT CAST((block_lonid * 137 + block_latid) % 77703 AS VARCHAR) AS key,
               CAST(to_json({'latitude': latitude, 'longitude': longitude, 'datetime': datetime,
                             'vehicle_id': vehicle_id}) AS VARCHAR) AS value, *
        FROM cleaned_positions""",
    "whole_messages": "SELECT * FROM messages WHERE substr(md5(value), 1, 2) <> '00'",
    "matched": """
        SELECT p.event_id, p.vehicle_id, p.datetime, p.longitude AS vehicle_lon, p.latitude AS vehicle_lat,
               s.rn, s.longitude, s.latitude, s.passengers
        FROM cleaned_positions p JOIN spots s USING (time_slot, block_latid, block_lonid)""",
    "picks": drawn("matched", "4040 + CAST(vehicle_id AS BIGINT)", "event_id, vehicle_id, datetime, vehicle_lon, vehicle_lat"),
    "copied": f"""
        SELECT t.*, copy, {leading("md5(concat_ws(':', 0, copy, trip_key))", 15)} AS number,
               {moment('datetime')} AS old_start, {moment('dropoff')} AS old_end
        FROM trips t, (VALUES (1), (2)) AS c(copy)""",
    "shifted": f"""
        SELECT *, try_strptime(concat(year(old_start) - 7 * copy, strftime(old_start, '-%m-%d %H:%M:%S')), {STAMP}) AS shifted
        FROM copied""",
    "copied_lines": f"""
        SELECT part, copy, {leading("md5(concat_ws(':', 0, copy, trim(value)))", 15)} AS number,
               {moment('part[2]')} AS old_start, {moment('part[3]')} AS old_end,
               CASE WHEN regexp_full_match(part[4], '{INT}') THEN TRY_CAST(trim(part[4]) AS BIGINT) END AS passengers,
               CASE WHEN regexp_full_match(part[6], '{FLOAT}|nan|inf') THEN TRY_CAST(trim(part[6]) AS DOUBLE) END AS longitude,
               CASE WHEN regexp_full_match(part[7], '{FLOAT}|nan|inf') THEN TRY_CAST(trim(part[7]) AS DOUBLE) END AS latitude
        FROM split_lines, (VALUES (1), (2)) AS c(copy)""",
    "shifted_lines": f"""
        SELECT *, try_strptime(concat(year(old_start) - 7 * copy, strftime(old_start, '-%m-%d %H:%M:%S')), {STAMP}) AS shifted
        FROM copied_lines""",
    "noisy_lines": f"""
        SELECT *, shifted + to_seconds({SECONDS}) AS new_start,
               CASE WHEN {EXTRA} THEN CAST(CAST(passengers AS HUGEINT) + 1 AS VARCHAR) ELSE part[4] END AS carried,
               {moved('longitude', EAST)} AS lon, {moved('latitude', NORTH)} AS lat
        FROM shifted_lines WHERE shifted IS NOT NULL AND old_end IS NOT NULL""",
    "line_copies": f"""
        SELECT array_to_string([part[1], strftime(new_start, {STAMP}), strftime(new_start + (old_end - old_start), {STAMP}),
                 carried, part[5],
                 CASE WHEN isnan(lon) THEN 'NaN' WHEN isinf(lon) THEN 'Infinity' ELSE CAST(lon AS VARCHAR) END,
                 CAST(lat AS VARCHAR)] || part[8:], ',') AS value,
               copy, CAST(year(shifted) AS INTEGER) AS period_year, CAST(month(shifted) AS INTEGER) AS period_month
        FROM noisy_lines WHERE carried IS NOT NULL AND lon IS NOT NULL AND lat IS NOT NULL""",
    "free": """
        SELECT vehicle_id AS resolved_id,
               row_number() OVER (ORDER BY md5('0:' || vehicle_id), vehicle_id) - 1 AS place, count(*) OVER () AS total
        FROM (SELECT DISTINCT vehicle_id FROM positions
              WHERE vehicle_id NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier))""",
    "requested": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS vehicle_id,
               {leading("md5('0:draw:' || CAST(c_custkey AS VARCHAR))", 15)} AS h
        FROM customer""",
    "resolved": """
        SELECT vehicle_id, vehicle_id AS resolved_id FROM requested
        WHERE vehicle_id IN (SELECT vehicle_id FROM positions)
        UNION ALL
        SELECT r.vehicle_id, f.resolved_id FROM requested r JOIN free f ON r.h % f.total = f.place
        WHERE r.vehicle_id NOT IN (SELECT vehicle_id FROM positions)""",
    "timed": f"SELECT *, {minute('datetime')} AS minute FROM positions",
    "ticks": "SELECT vehicle_id, CAST(range AS INTEGER) AS tick FROM (SELECT DISTINCT vehicle_id FROM positions), range(1180, 2641)",
    "earliest": """
        SELECT * FROM timed
        QUALIFY row_number() OVER (PARTITION BY vehicle_id, minute ORDER BY datetime, event_id) = 1""",
    "first_row": "SELECT * FROM timed QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY datetime, event_id) = 1",
    "last_row": "SELECT * FROM timed QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY datetime DESC, event_id DESC) = 1",
    "upcoming": """
        SELECT t.vehicle_id, t.tick, e.event_id
        FROM ticks t ASOF LEFT JOIN earliest e ON t.vehicle_id = e.vehicle_id AND t.tick <= e.minute * 2""",
    "shown_ids": """
        SELECT u.vehicle_id, u.tick,
               CASE WHEN u.tick = 1180 THEN f.event_id ELSE coalesce(u.event_id, l.event_id) END AS event_id
        FROM upcoming u JOIN first_row f USING (vehicle_id) JOIN last_row l USING (vehicle_id)""",
    "read_positions": """
        SELECT latitude, longitude, datetime, vehicle_id FROM positions
        WHERE substr(md5(CAST(event_id AS VARCHAR)), 1, 2) NOT IN ('00', '01', '02')""",
    "odd_positions": """
        SELECT event_id, latitude, CASE WHEN fault < 20 THEN longitude + 1 WHEN fault < 30 THEN CAST('nan' AS DOUBLE)
                      WHEN fault < 40 THEN CAST(1e12 AS DOUBLE) ELSE longitude END AS longitude,
               CASE WHEN fault BETWEEN 40 AND 59 THEN 'abc' || vehicle_id ELSE vehicle_id END AS vehicle_id,
               CASE WHEN fault BETWEEN 60 AND 79 THEN substr(datetime, 1, 14) || '62:00' ELSE datetime END AS datetime
        FROM (SELECT *, CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 2) AS INTEGER) AS fault FROM positions)""",
    "usable_odd": f"SELECT * FROM odd_positions WHERE NOT isnan(longitude) AND {moment('datetime')} IS NOT NULL",
    "cleaned_odd": f"""
        SELECT event_id, vehicle_id, {slot('datetime')} AS time_slot,
               {cell(sub('longitude', '74.25'))} AS block_latid, {cell(sub('latitude', '-40.5'))} AS block_lonid
        FROM usable_odd""",
    "odd_matched": """
        SELECT p.event_id, p.vehicle_id, s.rn, s.longitude, s.latitude, s.passengers
        FROM cleaned_odd p JOIN spots s USING (time_slot, block_latid, block_lonid)""",
    "odd_drawable": "SELECT * FROM odd_matched WHERE regexp_full_match(vehicle_id, '[0-9]+')",
    "odd_picks": drawn("odd_drawable", "4040 + CAST(vehicle_id AS BIGINT)", "event_id, vehicle_id"),
    "later_positions": f"""
        SELECT vehicle_id, longitude, latitude,
               strftime({moment('datetime')} + INTERVAL 1 MONTH - to_minutes(CAST(event_id % 50 AS BIGINT)), {STAMP}) AS datetime,
               event_id + 10000000 AS event_id
        FROM positions WHERE event_id % 2 = 0""",
    "all_positions": """
        SELECT vehicle_id, longitude, latitude, datetime, event_id FROM positions
        UNION ALL SELECT vehicle_id, longitude, latitude, datetime, event_id FROM later_positions""",
    "timed_months": f"SELECT *, {minute('datetime')} AS minute, substr(datetime, 1, 7) AS month FROM all_positions",
    "month_ticks": """
        SELECT vehicle_id, month, CAST(range AS INTEGER) AS tick
        FROM (SELECT DISTINCT vehicle_id, month FROM timed_months), range(1180, 2641)""",
    "month_earliest": """
        SELECT * FROM timed_months
        QUALIFY row_number() OVER (PARTITION BY vehicle_id, month, minute ORDER BY datetime, event_id) = 1""",
    "month_first": """
        SELECT * FROM timed_months
        QUALIFY row_number() OVER (PARTITION BY vehicle_id, month ORDER BY datetime, event_id) = 1""",
    "month_last": """
        SELECT * FROM timed_months
        QUALIFY row_number() OVER (PARTITION BY vehicle_id, month ORDER BY datetime DESC, event_id DESC) = 1""",
    "month_upcoming": """
        SELECT t.vehicle_id, t.month, t.tick, e.event_id
        FROM month_ticks t ASOF LEFT JOIN month_earliest e
          ON t.vehicle_id = e.vehicle_id AND t.month = e.month AND t.tick <= e.minute * 2""",
    "month_ids": """
        SELECT u.vehicle_id, u.month, u.tick,
               CASE WHEN u.tick = 1180 THEN f.event_id ELSE coalesce(u.event_id, l.event_id) END AS event_id
        FROM month_upcoming u JOIN month_first f USING (vehicle_id, month) JOIN month_last l USING (vehicle_id, month)""",
    "shown_months": """
        SELECT s.vehicle_id, s.month, s.tick, t.datetime, t.event_id, t.longitude, t.latitude, t.minute
        FROM month_ids s JOIN timed_months t USING (event_id)""",
    "shown": """
        SELECT s.vehicle_id, s.tick, t.datetime, s.event_id, t.longitude, t.latitude, t.minute
        FROM shown_ids s JOIN timed t USING (event_id)""",
}

CORNER_LON = "floor(longitude * CAST(200 AS DOUBLE)) / CAST(200 AS DOUBLE)"
CORNER_LAT = "floor(latitude * CAST(200 AS DOUBLE)) / CAST(200 AS DOUBLE)"
CLOCK = 42000

FINAL: dict[str, str] = {
    "parse_trips": f"""
        SELECT datetime, passengers, longitude, latitude,
               {sub('longitude', '74.25')} AS sub_x, {sub('latitude', '-40.5')} AS sub_y FROM readable""",
    "hotspots_from_text": "SELECT * FROM spots",
    "read_slots": "SELECT * FROM spots WHERE time_slot // 8 % 3 = 0",
    "parse_positions": "SELECT latitude, longitude, datetime, vehicle_id FROM read_positions",
    "replay_from_text": """
        SELECT latitude, longitude, datetime, vehicle_id,
               row_number() OVER (ORDER BY datetime, vehicle_id, longitude, latitude) - 1 AS seq FROM read_positions""",
    "message_key_value": "SELECT key, value FROM messages",
    "decode_positions": "SELECT latitude, longitude, datetime, vehicle_id FROM whole_messages",
    "replay_sequence": """
        SELECT latitude, longitude, datetime, vehicle_id,
               row_number() OVER (ORDER BY datetime, vehicle_id, longitude, latitude) - 1 AS seq FROM positions""",
    "csv_periods": "SELECT value, period_year, period_month FROM line_copies",
    "time_slot": "SELECT trip_key, time_slot FROM placed",
    "cell_ids": f"SELECT trip_key, sub_x, sub_y, {cell('sub_x')} AS cell_x, {cell('sub_y')} AS cell_y FROM placed",
    "neighbours": f"""
        SELECT cell_x, cell_y, cell_x + dx AS to_x, cell_y + dy AS to_y
        FROM (SELECT DISTINCT {cell('sub_x')} AS cell_x, {cell('sub_y')} AS cell_y FROM placed),
             (VALUES (-1), (0), (1)) AS a(dx), (VALUES (-1), (0), (1)) AS b(dy)
        WHERE dx <> 0 OR dy <> 0""",
    "sub_cell_centre": f"""
        SELECT sub_x, sub_y, {centre('sub_x', '-74.25')} AS longitude, {centre('sub_y', '40.5')} AS latitude
        FROM (SELECT DISTINCT sub_x, sub_y FROM placed)""",
    "viewport_corner": f"SELECT event_id, {CORNER_LON} AS corner_lon, {CORNER_LAT} AS corner_lat FROM positions",
    "viewport_tiles": f"""
        SELECT event_id, CAST(tile AS INTEGER) AS tile,
               {CORNER_LAT} + (tile // 3) * CAST(0.005 AS DOUBLE) AS north,
               {CORNER_LAT} + (tile // 3 - 1) * CAST(0.005 AS DOUBLE) AS south,
               {CORNER_LON} + (tile % 3) * CAST(0.005 AS DOUBLE) AS east,
               {CORNER_LON} + (tile % 3 - 1) * CAST(0.005 AS DOUBLE) AS west
        FROM positions, range(9) AS r(tile)""",
    "clock_label": f"""
        SELECT event_id, CAST(hour({moment('datetime')}) * 60 + minute({moment('datetime')}) AS INTEGER) AS minutes,
               strftime({moment('datetime')}, '%I:%M %p') AS label FROM positions""",
    "minute_of_month": "SELECT event_id, minute FROM timed",
    "slot_part": """
        SELECT event_id, time_slot, CAST(time_slot // 8 AS INTEGER) AS part, CAST(time_slot // 8 * 8 AS INTEGER) AS first_slot,
               CAST(time_slot // 8 * 8 + 7 AS INTEGER) AS last_slot FROM cleaned_positions""",
    "amplify": f"""
        SELECT trip_key, {moved('longitude', EAST)} AS longitude, {moved('latitude', NORTH)} AS latitude,
               strftime(new_start, {STAMP}) AS datetime, strftime(new_start + (old_end - old_start), {STAMP}) AS dropoff,
               CAST(passengers + CASE WHEN {EXTRA} THEN 1 ELSE 0 END AS INTEGER) AS passengers, copy,
               CAST(year(shifted) AS INTEGER) AS period_year, CAST(month(shifted) AS INTEGER) AS period_month
        FROM (SELECT *, shifted + to_seconds({SECONDS}) AS new_start
              FROM shifted WHERE shifted IS NOT NULL)""",
    "amplify_lines": "SELECT value, copy, period_year, period_month FROM line_copies",
    "valid_trips": "SELECT trip_key, passengers, sub_x, sub_y, time_slot FROM cleaned",
    "clean_positions": "SELECT * FROM cleaned_positions",
    "match_spots": "SELECT event_id, vehicle_id, datetime, rn, longitude, latitude, passengers FROM matched",
    "match_stored": "SELECT event_id, vehicle_id, datetime, rn, longitude, latitude, passengers FROM matched",
    "expand_neighbours": "SELECT * FROM offers",
    "prune_slots": "SELECT * FROM spots WHERE time_slot // 6 BETWEEN 6 AND 8 AND time_slot IN (SELECT time_slot FROM cleaned_positions)",
    "resolve_ids": "SELECT * FROM resolved",
    "fleet_at": f"""
        SELECT vehicle_id, datetime, event_id, longitude, latitude, minute FROM timed
        QUALIFY row_number() OVER (
          PARTITION BY vehicle_id
          ORDER BY minute >= {CLOCK} DESC,
                   CASE WHEN minute >= {CLOCK} THEN datetime END, CASE WHEN minute >= {CLOCK} THEN event_id END,
                   datetime DESC, event_id DESC) = 1""",
    "fleet_at_months": f"""
        SELECT vehicle_id, month, datetime, event_id, longitude, latitude, minute FROM timed_months
        QUALIFY row_number() OVER (
          PARTITION BY vehicle_id, month
          ORDER BY minute >= {CLOCK} DESC,
                   CASE WHEN minute >= {CLOCK} THEN datetime END, CASE WHEN minute >= {CLOCK} THEN event_id END,
                   datetime DESC, event_id DESC) = 1""",
    "fleet_at_clocks": """
        SELECT r.request_id, r.vehicle_id, r.month, r.clock, t.datetime, t.event_id, t.longitude, t.latitude, t.minute
        FROM (SELECT o_orderkey AS request_id, CAST(o_custkey AS VARCHAR) AS vehicle_id,
                     CASE WHEN o_orderkey % 3 = 0 THEN '2024-02' ELSE '2024-01' END AS month,
                     (o_orderkey * 7919 % 89280) / CAST(2 AS DOUBLE) AS clock
              FROM orders) r
        JOIN timed_months t ON t.vehicle_id = r.vehicle_id AND t.month = r.month
        QUALIFY row_number() OVER (
          PARTITION BY r.request_id
          ORDER BY t.minute >= r.clock DESC,
                   CASE WHEN t.minute >= r.clock THEN t.datetime END, CASE WHEN t.minute >= r.clock THEN t.event_id END,
                   t.datetime DESC, t.event_id DESC) = 1""",
    "playback": "SELECT * FROM shown",
    "track_live": "SELECT * FROM shown_months",
    "playback_ids": """
        SELECT vehicle_id, month, tick, datetime, event_id, longitude, latitude, minute
        FROM shown_months WHERE vehicle_id IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)""",
    "vehicle_history": "SELECT * FROM timed WHERE vehicle_id = '7'",
    "vehicle_histories": "SELECT * FROM timed",
    "clean_odd_positions": "SELECT event_id, vehicle_id, time_slot, block_latid, block_lonid FROM cleaned_odd",
    "suggest_odd": """
        SELECT event_id, vehicle_id, pick_no, spot_lon, spot_lat FROM odd_picks
        UNION ALL
        SELECT DISTINCT event_id, vehicle_id, 0, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
        FROM odd_matched WHERE NOT regexp_full_match(vehicle_id, '[0-9]+')""",
    "count_pickups": "SELECT * FROM counts",
    "top_spots": "SELECT * FROM own",
    "hotspots": "SELECT * FROM spots",
    "hotspots_updated": "SELECT * FROM spots",
    "known_vehicles": "SELECT DISTINCT vehicle_id FROM positions",
    "arrivals": """
        SELECT *, rank() OVER (PARTITION BY time_slot, block_latid, block_lonid ORDER BY datetime) AS arrival_no
        FROM cleaned_positions""",
    "slot_counts": """
        SELECT time_slot, count(*) AS row_count
        FROM (SELECT DISTINCT block_latid, block_lonid, time_slot FROM spots) GROUP BY time_slot""",
    "suggest": "SELECT event_id, vehicle_id, pick_no, spot_lon, spot_lat FROM picks",
    "suggestions": "SELECT * FROM picks",
    "stream_suggestions": """
        SELECT vehicle_id, datetime, vehicle_lon, vehicle_lat, pick_no, spot_lon, spot_lat FROM picks
        WHERE event_id IN (SELECT event_id FROM whole_messages)""",
    "stream_committed": """
        SELECT vehicle_id, datetime, vehicle_lon, vehicle_lat, pick_no, spot_lon, spot_lat FROM picks
        WHERE event_id IN (SELECT event_id FROM whole_messages)""",
    "track_frames": """
        SELECT vehicle_id, tick, strftime(TIMESTAMP '2014-08-01' + to_minutes(CAST(tick // 2 AS BIGINT)), '%I:%M %p') AS label,
               event_id, longitude, latitude
        FROM shown
        WHERE vehicle_id IN (SELECT resolved_id FROM resolved UNION ALL SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)""",
}

# The text job counts other trips than the typed one; the parts after that are the same.
INSTEAD = {"hotspots_from_text": {"cleaned": "SELECT * FROM cleaned_text"}}


def needed(sql: str, parts: dict[str, str]) -> list[str]:
    """Names of the parts a statement builds on, in an order in which each follows its own parts."""
    order: list[str] = []
    for name in parts:
        if re.search(rf"\b(?:FROM|JOIN) {name}\b", sql):
            order += [inner for inner in needed(parts[name], parts) if inner not in order]
            if name not in order:
                order.append(name)
    return order


def statement(name: str) -> str:
    parts = {**PARTS, **INSTEAD.get(name, {})}
    body = FINAL[name].strip()
    head = ",\n".join(f"{part} AS ({parts[part].strip()})" for part in needed(body, parts))
    return f"WITH {head}\n{body}"


ORACLES: dict[str, str] = {name: statement(name) for name in FINAL}
