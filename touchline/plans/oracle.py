"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

_EVENTS = """
ev AS (
  SELECT event_id,
         strftime(ts, '%Y-%m-%d') AS match_id,
         epoch_us(ts) / 1e6 AS "timestamp",
         CAST(user_id % 6 AS VARCHAR) AS team,
         CAST(user_id AS VARCHAR) AS player_id,
         CASE event_type WHEN 'click' THEN 'pass' WHEN 'purchase' THEN 'shot'
              WHEN 'signup' THEN 'interception' WHEN 'error' THEN 'foul'
              ELSE event_type END AS event_type,
         least(100.0, value) AS x_coord,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y_coord,
         ts AS event_time
  FROM events)
"""

_DIMS = """
teams AS (
  SELECT CAST(r_regionkey AS VARCHAR) AS team_id, r_name AS official_name FROM region),
players AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS player_id, replace(s_name, '#', ' ') AS short_name
  FROM supplier),
days AS (
  SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS match_id, day(ts) AS d FROM events),
pairs AS (
  SELECT match_id, CAST(d % 6 AS VARCHAR) AS team_a_id, CAST((d + 1) % 6 AS VARCHAR) AS team_b_id
  FROM days),
sess AS (
  SELECT match_id, team_a_id, team_b_id,
         coalesce(a.official_name, 'Team ' || team_a_id) AS team_a_name,
         coalesce(b.official_name, 'Team ' || team_b_id) AS team_b_name
  FROM pairs
  LEFT JOIN teams a ON a.team_id = team_a_id
  LEFT JOIN teams b ON b.team_id = team_b_id)
"""

_FRAME = (
    _EVENTS
    + ","
    + _DIMS
    + """,
recent AS (
  SELECT match_id, "timestamp", team, player_id, event_type, x_coord, y_coord,
         CAST(row_number() OVER (PARTITION BY match_id
                                 ORDER BY "timestamp" DESC, player_id, event_type)
              AS INTEGER) AS recency
  FROM ev),
frame AS (
  SELECT recent.*, team_a_id, team_a_name, team_b_id, team_b_name
  FROM recent JOIN sess USING (match_id)
  WHERE recency <= 1000 AND (team = team_a_id OR team = team_b_id)),
named AS (
  SELECT frame.*, coalesce(official_name, team) AS team_name,
         coalesce(short_name, frame.player_id) AS player_name,
         CAST(row_number() OVER (PARTITION BY match_id ORDER BY recency) AS INTEGER) AS position
  FROM frame
  LEFT JOIN teams ON team = team_id
  LEFT JOIN players ON frame.player_id = players.player_id)
"""
)

_ACTIONS = (
    _FRAME
    + """,
actions AS (
  SELECT match_id, position, "timestamp", team, team_name, player_name, event_type,
         x_coord, y_coord,
         CASE event_type WHEN 'shot' THEN '*' WHEN 'interception' THEN 'D'
              WHEN 'foul' THEN 'X' ELSE 'o' END AS marker,
         CASE event_type WHEN 'shot' THEN 400 ELSE 120 END AS marker_size,
         CASE team_name WHEN team_b_name THEN '#ef4444' WHEN team_a_name THEN '#3b82f6'
              ELSE 'yellow' END AS colour,
         team_name || ' ' || upper(event_type[1]) || event_type[2:] AS legend
  FROM named WHERE position <= 100)
"""
)

_RADAR = (
    _FRAME
    + """,
last_pos AS (
  SELECT * FROM frame
  QUALIFY row_number() OVER (PARTITION BY match_id, team, player_id ORDER BY recency) = 1),
squad AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY match_id, team ORDER BY recency) AS INTEGER)
              AS squad_rank
  FROM last_pos),
radar AS (
  SELECT match_id, team,
         CASE WHEN team = team_a_id THEN team_a_name ELSE team_b_name END AS team_name,
         squad_rank, squad.player_id, coalesce(short_name, squad.player_id) AS player_name,
         "timestamp", x_coord, y_coord,
         CASE WHEN team = team_b_id THEN '#ef4444' ELSE '#3b82f6' END AS colour
  FROM squad LEFT JOIN players ON squad.player_id = players.player_id
  WHERE squad_rank <= 11)
"""
)


def _sliding(width: int, slide: int) -> str:
    """Counts of every window, by copying each event into its windows."""
    copies = width // slide
    return f"""
counts AS (
  SELECT match_id, team,
         make_timestamp((epoch_us(event_time) // {slide}000000 - k) * {slide}000000)
           AS window_start,
         make_timestamp(((epoch_us(event_time) // {slide}000000 - k) * {slide} + {width})
                        * 1000000) AS window_end,
         count(*) AS total_events
  FROM ev, generate_series(0, {copies - 1}) AS g(k)
  GROUP BY ALL)
"""


_WIDE = _sliding(21600, 3600)
_WINDOW_COLUMNS = "match_id, team, window_start, window_end, total_events"

_LATEST = """
latest AS (
  SELECT * FROM counts
  QUALIFY row_number() OVER (PARTITION BY match_id, team ORDER BY window_end DESC) = 1)
"""
_FULLEST = """
latest AS (
  SELECT * FROM counts
  QUALIFY row_number() OVER (PARTITION BY match_id, team
                             ORDER BY total_events DESC, window_end DESC) = 1)
"""
_ROLLING = """
ends AS (SELECT match_id, max(event_time) AS window_end FROM ev GROUP BY 1),
latest AS (
  SELECT match_id, team, window_end - INTERVAL 6 HOURS AS window_start, window_end,
         count(*) AS total_events
  FROM ev JOIN ends USING (match_id)
  WHERE event_time > window_end - INTERVAL 6 HOURS
  GROUP BY ALL)
"""

_MIDDLE = """
middle AS (
  SELECT min("timestamp") + (max("timestamp") - min("timestamp")) / 2 AS half FROM {events})
"""
#: The match of the middle starts again there.
_RESET = (
    _MIDDLE.format(events="arrived")
    + """,
ev AS (
  SELECT arrived.* FROM arrived, middle
  WHERE "timestamp" >= half
     OR match_id <> strftime(make_timestamp(CAST(half * 1e6 AS BIGINT)), '%Y-%m-%d'))
"""
)

_CARD = """
card AS (
  SELECT match_id, team_a_id, team_b_id, a.total_events AS events_a, b.total_events AS events_b,
         CASE WHEN a.total_events + b.total_events > 0
              THEN CAST(a.total_events AS DOUBLE) / (a.total_events + b.total_events) * 100
              ELSE 50 END AS possession_a,
         CASE WHEN a.total_events + b.total_events > 0
              THEN CAST(b.total_events AS DOUBLE) / (a.total_events + b.total_events) * 100
              ELSE 50 END AS possession_b
  FROM sess
  JOIN latest a USING (match_id) JOIN latest b USING (match_id)
  WHERE a.team = team_a_id AND b.team = team_b_id)
"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_FACTS = """
fa AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS match_id, CAST(l_linenumber AS VARCHAR) AS event_id,
         l_returnflag AS event_name,
         CASE l_linestatus WHEN 'O' THEN '' ELSE l_linestatus END AS sub_event_name,
         CAST(l_partkey AS VARCHAR) AS player_id, CAST(l_suppkey AS VARCHAR) AS team_id,
         l_quantity AS event_sec,
         CAST(0 AS DOUBLE) AS x_start, CAST(0 AS DOUBLE) AS y_start,
         CAST(0 AS DOUBLE) AS x_end, CAST(0 AS DOUBLE) AS y_end
  FROM lineitem)
"""

_PLAYERS = """
  SELECT CAST(c_custkey AS VARCHAR) AS player_id, c_name AS short_name,
         c_mktsegment AS first_name,
         regexp_replace(CAST(c_acctbal AS VARCHAR), '\\.0$', '') AS last_name,
         {foot} AS foot,
         CASE c_mktsegment WHEN 'BUILDING' THEN '' ELSE '1990-01-01' END AS birth_date,
         CAST(c_nationkey AS VARCHAR) AS "currentTeamId"
  FROM customer
"""

_MATCHES = """
  SELECT CAST(o_orderkey AS VARCHAR) AS match_id, o_orderpriority || ', 1 - 0' AS label,
         strftime(o_orderdate, '%Y-%m-%d') AS dateutc,
         CAST(o_custkey AS VARCHAR) AS competition_id, o_orderstatus AS season_id,
         CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
              THEN o_orderkey ELSE 0 END AS INTEGER) AS gameweek
  FROM orders
"""

_HOURLY = """
hourly AS (
  SELECT event_id, match_id, floor("timestamp" / 3600) * 3600.0 AS "timestamp", team,
         player_id, event_type, x_coord, y_coord
  FROM ev)
"""
_UPSERTED = """
  SELECT * FROM hourly
  QUALIFY row_number() OVER (PARTITION BY match_id, "timestamp" ORDER BY event_id DESC) = 1
"""

_ROSTER = """
team_ids AS (SELECT CAST(s_suppkey AS VARCHAR) AS team_id FROM supplier),
people AS (
  SELECT CAST(c_custkey AS VARCHAR) AS player_id, c_name AS short_name,
         CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS VARCHAR) AS team_id
  FROM customer),
seen AS (
  SELECT DISTINCT CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) AS team_id,
         CAST(l_partkey AS VARCHAR) AS player_id
  FROM lineitem),
choices AS (
  SELECT team_id, player_id, short_name, 1 AS tier FROM people
  UNION ALL
  SELECT seen.team_id, seen.player_id, coalesce(short_name, ''), 2
  FROM seen LEFT JOIN people USING (player_id)
  UNION ALL
  SELECT team_ids.team_id, p.player_id, p.short_name, 3
  FROM team_ids, (SELECT * FROM people ORDER BY player_id LIMIT 11) p),
best AS (
  SELECT * FROM choices
  QUALIFY row_number() OVER (PARTITION BY team_id, player_id ORDER BY tier) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY tier, player_id) AS number
  FROM best),
squads AS (
  SELECT team_ids.team_id, CAST(n - 1 AS INTEGER) AS slot,
         coalesce(player_id, 'SYN_' || team_ids.team_id || '_' || n) AS player_id,
         coalesce(short_name, 'Player ' || n) AS player_name, coalesce(tier, 4) AS tier
  FROM team_ids CROSS JOIN generate_series(1, 11) AS s(n)
  LEFT JOIN ranked ON ranked.team_id = team_ids.team_id AND number = n)
"""

_LINEUP = """
sides AS (
  SELECT s_name AS match_id, 'A' AS side, CAST(s_suppkey AS VARCHAR) AS team_id FROM supplier
  UNION ALL
  SELECT s_name, 'B', CAST(s_nationkey AS VARCHAR) FROM supplier)
"""

_QUARANTINE = """
routes AS (
  SELECT ev.*, CASE event_type WHEN 'foul' THEN 'unreadable' WHEN 'shot' THEN 'no match_id'
              WHEN 'interception' THEN 'no timestamp' END AS reason
  FROM ev)
"""

_SPELLS = """
flagged AS (
  SELECT *, lag(team) OVER w IS DISTINCT FROM team AS starts,
         lead(team) OVER w IS DISTINCT FROM team AS ends,
         lead(event_type) OVER w AS next_type
  FROM ev WINDOW w AS (PARTITION BY match_id ORDER BY "timestamp", player_id)),
numbered AS (
  SELECT *, sum(CAST(starts AS INTEGER)) OVER (PARTITION BY match_id
            ORDER BY "timestamp", player_id ROWS UNBOUNDED PRECEDING) AS spell
  FROM flagged)
"""

ORACLE: dict[str, str] = {
    "sliding_window_counts": _with(_EVENTS, _sliding(60, 10))
    + f"SELECT {_WINDOW_COLUMNS} FROM counts",
    "sliding_window_counts_6h": _with(_EVENTS, _WIDE) + f"SELECT {_WINDOW_COLUMNS} FROM counts",
    "tumbling_window_counts": _with(_EVENTS, _sliding(3600, 3600))
    + f"SELECT {_WINDOW_COLUMNS} FROM counts",
    "latest_window_per_team": _with(_EVENTS, _WIDE, _LATEST)
    + f"SELECT {_WINDOW_COLUMNS} FROM latest",
    "latest_window_aligned": _with(_EVENTS, _WIDE, _LATEST)
    + f"""SELECT {_WINDOW_COLUMNS} FROM latest
          QUALIFY window_end = max(window_end) OVER (PARTITION BY match_id)""",
    "max_window_per_team": _with(_EVENTS, _WIDE, _FULLEST)
    + f"SELECT {_WINDOW_COLUMNS} FROM latest",
    "rolling_window_per_team": _with(_EVENTS, _ROLLING) + f"SELECT {_WINDOW_COLUMNS} FROM latest",
    "possession_latest": _with(_EVENTS, _DIMS, _WIDE, _LATEST, _CARD) + "SELECT * FROM card",
    "possession_rolling": _with(_EVENTS, _DIMS, _ROLLING, _CARD) + "SELECT * FROM card",
    "possession_max": _with(_EVENTS, _DIMS, _WIDE, _FULLEST, _CARD) + "SELECT * FROM card",
    "possession_display": _with(_EVENTS, _DIMS, _WIDE, _FULLEST, _CARD)
    + """SELECT match_id, printf('%.1f', round(possession_a, 1)) || '%' AS text_a,
                printf('%.1f', round(possession_b, 1)) || '%' AS text_b FROM card""",
    "possession_spells": _with(_EVENTS, _SPELLS)
    + """SELECT match_id, any_value(team) AS team, min("timestamp") AS start_ts,
                max("timestamp") AS end_ts, count(*) AS events,
                coalesce(any_value(next_type) FILTER (ends) = 'interception', false)
                  AS ended_by_turnover
         FROM numbered GROUP BY match_id, spell""",
    "possession_spells_stream": _with(_EVENTS, _SPELLS)
    + """SELECT match_id, any_value(team) AS team, min("timestamp") AS start_ts,
                max("timestamp") AS end_ts, count(*) AS events,
                coalesce(any_value(next_type) FILTER (ends) = 'interception', false)
                  AS ended_by_turnover
         FROM numbered GROUP BY match_id, spell""",
    "event_json_roundtrip": _with(_EVENTS)
    + """SELECT match_id, "timestamp", team, player_id, event_type, x_coord, y_coord, event_time
         FROM ev""",
    "event_json_quarantine": _with(_EVENTS, _QUARANTINE)
    + "SELECT reason, count(*) AS n FROM routes WHERE reason IS NOT NULL GROUP BY 1",
    "event_json_lenient": _with(_EVENTS, _QUARANTINE)
    + """SELECT match_id, "timestamp", CASE WHEN event_type = 'pass' THEN team END AS team,
                CASE WHEN event_type = 'pass' THEN player_id END AS player_id,
                CASE WHEN event_type = 'pass' THEN event_type END AS event_type,
                CASE WHEN event_type = 'pass' THEN x_coord END AS x_coord,
                CASE WHEN event_type = 'pass' THEN y_coord END AS y_coord
         FROM routes WHERE reason IS NULL""",
    "live_recent_topk": _with(_EVENTS)
    + """SELECT * EXCLUDE (event_time),
                CAST(row_number() OVER (PARTITION BY match_id
                  ORDER BY "timestamp" DESC, player_id, event_type) AS INTEGER) AS recency
         FROM ev QUALIFY recency <= 100""",
    "live_recent_single_match": _with(_EVENTS)
    + """SELECT * EXCLUDE (event_time, event_id) FROM ev WHERE match_id = '2024-01-02'
         ORDER BY "timestamp" DESC, player_id, event_type LIMIT 1000""",
    "live_events_named": _with(_EVENTS, _DIMS)
    + """SELECT event_id, match_id, "timestamp", team, ev.player_id, event_type, x_coord, y_coord,
                coalesce(official_name, team) AS team_name,
                coalesce(short_name, ev.player_id) AS player_name
         FROM ev LEFT JOIN teams ON team = team_id
         LEFT JOIN players ON ev.player_id = players.player_id""",
    "live_enriched": _with(_FRAME) + "SELECT * EXCLUDE (position) FROM named",
    "live_feed": _with(_FRAME)
    + """SELECT match_id, position, team_name AS "Team", player_name AS "Player",
                event_type AS "Event" FROM named WHERE position <= 6""",
    "action_map_last100": _with(_ACTIONS) + "SELECT * FROM actions",
    "action_matrix": _with(_ACTIONS)
    + """SELECT match_id, team_name, event_type, legend, count(*) AS n,
                min(position) AS newest_position, arg_min(x_coord, position) AS newest_x,
                arg_min(y_coord, position) AS newest_y
         FROM actions GROUP BY 1, 2, 3, 4""",
    "radar_last_position": _with(_RADAR) + "SELECT * FROM last_pos",
    "radar_top11": _with(_RADAR)
    + """SELECT *, regexp_extract(player_name, '(\\S+)\\s*$', 1)[1:10] AS label,
                y_coord - 3.5 AS label_y,
                CASE colour WHEN '#3b82f6' THEN '#60a5fa' ELSE '#f87171' END AS glow
         FROM radar""",
    "radar_counts": _with(_RADAR)
    + """SELECT match_id, team_name, count(*) AS players,
                team_name || ': ' || count(*) || ' players' AS badge
         FROM radar GROUP BY 1, 2""",
    "event_types": _with(_EVENTS) + "SELECT DISTINCT event_type FROM ev",
    "clamped_positions": _with(_EVENTS)
    + """SELECT event_id, greatest(0.0, least(100.0, x_coord * 2 - 20)) AS x_coord,
                greatest(0.0, least(100.0, y_coord)) AS y_coord FROM ev""",
    "event_styles": _with(_EVENTS)
    + """SELECT event_type,
                CASE event_type WHEN 'shot' THEN '*' WHEN 'interception' THEN 'D'
                     WHEN 'foul' THEN 'X' ELSE 'o' END AS marker,
                CASE event_type WHEN 'shot' THEN 400 ELSE 120 END AS marker_size,
                upper(event_type[1]) || event_type[2:] AS title,
                format('{:,}', count(*)) AS n_text
         FROM ev GROUP BY 1""",
    "event_log_upsert": _with(_EVENTS, _HOURLY) + _UPSERTED,
    "keyed_log_compaction": _with(_EVENTS, _HOURLY) + _UPSERTED,
    "session_reset": _with(_EVENTS)
    + """SELECT match_id, count(*) AS events, min("timestamp") AS first_ts FROM ev
         WHERE event_time > CAST(match_id AS TIMESTAMP) + INTERVAL 12 HOURS GROUP BY 1""",
    "archive_recent_of_match": _with(_EVENTS)
    + """SELECT * EXCLUDE (event_time, event_id) FROM ev WHERE match_id = '2024-01-02'
         ORDER BY "timestamp" DESC, player_id, event_type LIMIT 1000""",
    "archive_recent": _with(_EVENTS)
    + """SELECT * EXCLUDE (event_time, event_id),
                CAST(row_number() OVER (PARTITION BY match_id
                  ORDER BY "timestamp" DESC, player_id, event_type) AS INTEGER) AS recency
         FROM ev QUALIFY recency <= 100""",
    "archive_by_match": _with(_EVENTS)
    + """SELECT match_id, count(*) AS events, count(DISTINCT player_id) AS players,
                max("timestamp") AS last_ts
         FROM (SELECT match_id, "timestamp", max(player_id) AS player_id FROM ev GROUP BY 1, 2)
         GROUP BY 1""",
    "hist_avg_events": """
         SELECT count(*) / count(DISTINCT l_orderkey) AS average_exact,
                coalesce(CAST(trunc(count(*) / count(DISTINCT l_orderkey)) AS INTEGER), 1450)
                  AS historical_avg
         FROM lineitem""",
    "live_counts_capped": _with(_FRAME)
    + """SELECT sess.match_id, count(frame.match_id) AS live_events
         FROM sess LEFT JOIN frame USING (match_id) GROUP BY 1""",
    "live_vs_baseline": _with(_EVENTS, _DIMS)
    + """SELECT sess.match_id, count(ev.match_id) AS live_events, any_value(avg) AS historical_avg,
                any_value(avg) - count(ev.match_id) AS delta
         FROM sess CROSS JOIN (SELECT CAST(trunc(count(*) / count(DISTINCT l_orderkey)) AS INTEGER)
                               AS avg FROM lineitem)
         LEFT JOIN ev ON ev.match_id = sess.match_id AND team IN (team_a_id, team_b_id)
         GROUP BY 1""",
    "baseline_display": _with(_EVENTS, _DIMS)
    + """SELECT sess.match_id, format('{:,}', any_value(avg)) AS average_text,
                format('{:,}', count(ev.match_id)) AS live_text,
                (any_value(avg) - count(ev.match_id)) || ' to average' AS delta_text
         FROM sess CROSS JOIN (SELECT CAST(trunc(count(*) / count(DISTINCT l_orderkey)) AS INTEGER)
                               AS avg FROM lineitem)
         LEFT JOIN ev ON ev.match_id = sess.match_id AND team IN (team_a_id, team_b_id)
         GROUP BY 1""",
    "normalize_facts": _with(_FACTS) + "SELECT * FROM fa",
    "csv_fact_load": _with(_FACTS)
    + """SELECT * REPLACE (CAST(CASE event_name WHEN 'A' THEN 12.5 ELSE 0 END AS DOUBLE) AS x_start) FROM fa""",
    "warehouse_append": _with(_FACTS)
    + """SELECT event_name, sub_event_name, count(*) AS n,
                (SELECT count(*) FROM fa) AS appended
         FROM fa GROUP BY 1, 2""",
    "normalize_players": _PLAYERS.format(foot="''"),
    "csv_player_load": _PLAYERS.format(foot="'left,' || chr(10) || 'or right'"),
    "normalize_teams": """
         SELECT CAST(n_nationkey AS VARCHAR) AS team_id, n_name AS name,
                n_name || ' FC' AS official_name, 'a city, quoted' AS city, 'club' AS type
         FROM nation""",
    "normalize_matches": _MATCHES,
    "csv_match_load": _MATCHES
    + " UNION ALL SELECT * REPLACE ('' AS label, 0 AS gameweek) FROM ("
    + _MATCHES
    + ")",
    "dim_dedupe": """
         SELECT CAST(c_nationkey AS VARCHAR) AS team_id, c_name AS official_name,
                c_mktsegment AS type
         FROM customer
         QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey DESC) = 1""",
    "event_label_lookup": """
         SELECT c_custkey, c_nationkey, coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS label
         FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "tag_label_lists": """
         SELECT c_custkey, coalesce(a.n_name, CAST(c_nationkey AS VARCHAR)) || '/' ||
                coalesce(b.n_name, CAST(c_custkey % 40 AS VARCHAR)) AS labels
         FROM customer LEFT JOIN nation a ON a.n_nationkey = c_nationkey
         LEFT JOIN nation b ON b.n_nationkey = c_custkey % 40""",
    "roster_fill": _with(_ROSTER) + "SELECT * FROM squads",
    "lineup_positions": _with(_ROSTER, _LINEUP)
    + """SELECT match_id, player_id, side, team_id, slot, player_name,
                CASE WHEN slot = 0 THEN CASE side WHEN 'A' THEN 5 ELSE 95 END
                     WHEN slot <= 4 THEN CASE side WHEN 'A' THEN 25 ELSE 75 END
                     WHEN slot <= 7 THEN 50
                     ELSE CASE side WHEN 'A' THEN 75 ELSE 25 END END AS base_x,
                CASE WHEN slot = 0 THEN 50 WHEN slot <= 4 THEN slot * 20
                     WHEN slot <= 7 THEN (slot - 5) * 20 + 30
                     ELSE (slot - 8) * 20 + 30 END AS base_y
         FROM sides JOIN squads USING (team_id)
         QUALIFY row_number() OVER (PARTITION BY match_id, player_id ORDER BY side DESC) = 1""",
    "team_selector": """
         SELECT c_mktsegment AS official_name, CAST(max(c_custkey) AS VARCHAR) AS team_id
         FROM customer GROUP BY 1 ORDER BY 1""",
    "team_selector_default": """
         SELECT r_name AS official_name, CAST(max(r_regionkey) AS VARCHAR) AS team_id
         FROM region GROUP BY 1 ORDER BY 1 LIMIT 2""",
    "session_resolve": """
         SELECT CAST(o_orderkey % 25 AS VARCHAR) AS team_a_id, o_orderpriority AS team_a_name,
                CAST(o_custkey % 25 AS VARCHAR) AS team_b_id, o_orderstatus AS team_b_name,
                CASE o_orderpriority WHEN '1-URGENT' THEN 'FC26_FINAL_01'
                     ELSE CAST(o_orderkey AS VARCHAR) END AS match_id
         FROM orders""",
    "team_stats_upsert_stream": _with(_EVENTS, _WIDE, _LATEST)
    + f"SELECT {_WINDOW_COLUMNS} FROM latest",
    "checkpoint_version_stream": _with(_EVENTS, _WIDE, _LATEST)
    + f"SELECT {_WINDOW_COLUMNS} FROM latest",
    "reset_counts_stream": _with(
        _EVENTS.replace("ev AS", "arrived AS"), _RESET, _WIDE, _LATEST
    )
    + f"SELECT {_WINDOW_COLUMNS} FROM latest",
    "late_event_policy": _with(
        _EVENTS,
        """
mark AS (
  SELECT date_trunc('milliseconds', max(event_time)) - INTERVAL 10 DAYS AS watermark
  FROM ev WHERE event_type <> 'foul')
""",
        _WIDE.replace("count(*) AS total_events", "event_type = 'foul' AS late, count(*) AS n"),
    )
    + """SELECT match_id, team, window_start, window_end,
                CAST(sum(n) AS BIGINT) AS total_events
         FROM counts, mark WHERE NOT late OR window_end > watermark
         GROUP BY 1, 2, 3, 4""",
    "late_event_log": _with(
        _EVENTS,
        """
mark AS (
  SELECT date_trunc('milliseconds', max(event_time)) - INTERVAL 10 DAYS AS watermark
  FROM ev WHERE event_type <> 'foul')
""",
        _WIDE.replace("count(*) AS total_events", "event_type = 'foul' AS late, count(*) AS n"),
    )
    + """SELECT match_id, team, window_start, window_end,
                CAST(sum(n) AS BIGINT) AS late_events
         FROM counts, mark WHERE late AND window_end <= watermark
         GROUP BY 1, 2, 3, 4""",
    "raw_append_stream": _with(_EVENTS, _QUARANTINE)
    + """SELECT coalesce(reason, match_id) AS target, count(*) AS n FROM routes GROUP BY 1""",
    "enriched_stream": _with(_EVENTS, _DIMS)
    + """SELECT match_id, "timestamp", team, ev.player_id, event_type, x_coord, y_coord,
                coalesce(official_name, team) AS team_name,
                coalesce(short_name, ev.player_id) AS player_name
         FROM ev LEFT JOIN teams ON team = team_id
         LEFT JOIN players ON ev.player_id = players.player_id""",
    "dim_reload": _with(_EVENTS, _DIMS, _MIDDLE.format(events="ev"))
    + """SELECT match_id, "timestamp", team, ev.player_id, event_type, x_coord, y_coord,
                coalesce(CASE WHEN "timestamp" < half THEN '' ELSE 'New ' END || official_name,
                         team) AS team_name,
                coalesce(CASE WHEN "timestamp" < half THEN '' ELSE 'New ' END || short_name,
                         ev.player_id) AS player_name
         FROM ev CROSS JOIN middle LEFT JOIN teams ON team = team_id
         LEFT JOIN players ON ev.player_id = players.player_id""",
    "dashboard_refresh": _with(_FRAME)
    + """SELECT match_id, position, team_name AS "Team", player_name AS "Player",
                event_type AS "Event", live_events,
                (SELECT CAST(trunc(count(*) / count(DISTINCT l_orderkey)) AS INTEGER)
                 FROM lineitem) - live_events AS delta
         FROM (SELECT *, count(*) OVER (PARTITION BY match_id) AS live_events FROM named)
         WHERE position <= 6""",
    "deployed_sessions": _with(
        _EVENTS,
        """
pairs(team_a_id, team_b_id) AS (VALUES ('2', '3'), ('0', '1')),
newest AS (SELECT team, floor(max("timestamp") / 10) * 10 AS start FROM ev GROUP BY 1),
counts AS (
  SELECT team, count(*) AS n FROM ev JOIN newest USING (team) WHERE "timestamp" >= start GROUP BY 1),
recent AS (SELECT team FROM ev ORDER BY "timestamp" DESC, player_id, event_type LIMIT 1000)
""",
    )
    + """SELECT team_a_id, team_b_id, a.n AS events_a, b.n AS events_b,
                (SELECT count(*) FROM recent WHERE recent.team IN (team_a_id, team_b_id))
                  AS live_events,
                (SELECT CAST(trunc(count(*) / count(DISTINCT l_orderkey)) AS INTEGER)
                 FROM lineitem) AS historical_avg
         FROM pairs JOIN counts a ON a.team = team_a_id JOIN counts b ON b.team = team_b_id""",
}
