"""One DuckDB statement per query of the catalog."""

from __future__ import annotations

from oracles.views import season

LINES = "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS q, CAST(CASE WHEN l_linenumber <> 3 THEN l_linenumber END AS BIGINT) AS a, CAST(CASE WHEN l_linenumber <> 5 THEN l_linenumber % 2 END AS BIGINT) AS b FROM lineitem"
MILES = "2 * 3961 * ASIN(SQRT(POW(SIN(RADIANS((48.81 - la) / 2)), 2) + COS(RADIANS(la)) * COS(RADIANS(48.81)) * POW(SIN(RADIANS((2.06 - lo) / 2)), 2)))"


def leaders(stat: str, n: int, extra: str) -> str:
    return f"""SELECT season, player, {stat}, {extra}, {stat} / MAX({stat}) OVER (PARTITION BY season) AS share_of_leader
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY season ORDER BY {stat} DESC, player) AS rn FROM v_perf WHERE {stat} > 0) WHERE rn <= {n}"""


def money(text: str) -> str:
    """Amount of the fee texts of the test data."""
    return f"""CASE WHEN LOWER({text}) LIKE '%m%' THEN CAST(FLOOR(TRY_CAST(REGEXP_REPLACE(REPLACE({text}, ',', '.'), '[^0-9.]', '', 'g') AS DOUBLE) * 1000000) AS BIGINT)
        WHEN LOWER({text}) LIKE '%k%' THEN CAST(FLOOR(TRY_CAST(REGEXP_REPLACE({text}, '[^0-9.]', '', 'g') AS DOUBLE) * 1000) AS BIGINT)
        ELSE TRY_CAST(REGEXP_REPLACE({text}, '[^0-9]', '', 'g') AS BIGINT) END"""


def rounded(x: str) -> str:
    """Two digits, half up on the shortest decimal text of the double, as Spark's ROUND does."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE)"


NO_FEE = "(LOWER(fee_text) LIKE '%free%' OR LOWER(fee_text) LIKE '%loan%' OR LOWER(fee_text) LIKE '%draft%' OR fee_text LIKE '%-%')"
SPAN = "SELECT o_custkey, MIN(o_orderdate) AS a, MAX(o_orderdate) AS b FROM orders GROUP BY o_custkey"
START_YEAR = "YEAR({0}) - CASE WHEN MONTH({0}) < 8 THEN 1 ELSE 0 END"
CODE = "LPAD(CAST(y % 100 AS VARCHAR), 2, '0') || LPAD(CAST((y + 1) % 100 AS VARCHAR), 2, '0')"


def nations(alias: str, table: str, key: str) -> str:
    return f"(SELECT CASE WHEN {key} <> 3 THEN {key} END AS n, COUNT(*) AS c FROM {table} GROUP BY 1) {alias}"


NATION_COUNTS = f"{nations('a', 'customer', 'c_nationkey')} FULL JOIN {nations('b', 'supplier', 's_nationkey')} ON a.n = b.n"
SQUAD_DIFF = "(SELECT 'a_minus_b' AS which_diff, * FROM (SELECT season, player, market_value_eur FROM v_squad EXCEPT SELECT season, player, market_value_eur FROM v_squad_new) UNION ALL SELECT 'b_minus_a', * FROM (SELECT season, player, market_value_eur FROM v_squad_new EXCEPT SELECT season, player, market_value_eur FROM v_squad))"


def report(check: str, table: str, failing: str, severity: str = "error", count: str = "COUNT(*)", warn: str = "<> 0") -> str:
    bad = "fail" if severity == "error" else "warn"
    return f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", CAST(f AS BIGINT) AS failures, CASE WHEN f {warn} THEN '{bad}' ELSE 'pass' END AS status FROM (SELECT {count} AS f FROM ({failing}))"


def nulls(table: str, view: str, *cols: str) -> list[str]:
    return [report(f"not_null_{c}", table, f"SELECT 1 FROM {view} WHERE {c} IS NULL") for c in cols]


def out_of_range(table: str, view: str, col: str, top: int) -> str:
    return report(f"range_{col}", table, f"SELECT 1 FROM {view} WHERE {col} < 0 OR {col} > {top}", "warn")


def repeated(table: str, view: str, cols: str, name: str = "unique_rows") -> str:
    return report(name, table, f"SELECT 1 FROM {view} GROUP BY {cols} HAVING COUNT(*) > 1")


RUN_CHECKS = "\nUNION ALL ".join([
    *nulls("player_performance", "v_perf", "season", "player", "goals", "assists", "minutes"),
    report("known_player", "player_performance", "SELECT 1 FROM v_perf WHERE player NOT IN (SELECT player FROM v_raw_stats)", "warn"),
    out_of_range("player_performance", "v_perf", "goals", 60),
    out_of_range("player_performance", "v_perf", "assists", 40),
    out_of_range("player_performance", "v_perf", "minutes", 4000),
    repeated("player_performance", "v_perf", "season, player"),
    report("enough_players", "player_performance", "SELECT 1 FROM v_perf GROUP BY season HAVING COUNT(*) < 20", "warn"),
    *nulls("match_results", "v_results", "season", "game_id", "date"),
    repeated("match_results", "v_results", "season, date, opponent, venue_type"),
    *nulls("season_summary", "v_summary", "season", "points"),
    repeated("season_summary", "v_summary", "season", "unique_season"),
    out_of_range("season_summary", "v_summary", "points", 120),
    repeated("squad_value", "v_squad_value", "season", "unique_season"),
    repeated("transfer_balance", "v_balance", "season", "unique_season"),
    *nulls("player_values", "v_values", "season", "player"),
    repeated("player_values", "v_values", "season, player"),
    report("same_squads", "squad_values", f"SELECT which_diff FROM {SQUAD_DIFF}", "warn",
           "COUNT(*) + ABS(COUNT(*) FILTER (WHERE which_diff = 'a_minus_b') - COUNT(*) FILTER (WHERE which_diff = 'b_minus_a'))"),
    "SELECT 'columns', 'orders', CAST(5 AS BIGINT), 'fail'",
    "SELECT 'readable', 'no_such_table', CAST(NULL AS BIGINT), 'unreadable'",
])

LOADS = {
    "scan_table": "SELECT * FROM customer",
    "replace_partitions": """SELECT * FROM v_raw_matches WHERE season < '9899' AND season NOT IN (SELECT season FROM v_raw_matches WHERE season >= '9899' AND venue = 'Home')
        UNION ALL SELECT * REPLACE ('99' AS gameweek) FROM v_raw_matches WHERE season >= '9899' AND venue = 'Home'""",
    "merge_upsert": """SELECT COALESCE(t.season, s.season) AS season, COALESCE(t.player, s.player) AS player,
          CASE WHEN t.player IS NULL THEN 'new' ELSE t.position END AS position,
          CASE WHEN s.player IS NULL THEN t.market_value_eur ELSE s.market_value_eur END AS market_value_eur
        FROM (SELECT * FROM v_squad WHERE season < '9900') t FULL JOIN v_squad_new s ON t.season = s.season AND t.player = s.player""",
    "replace_by_id": """SELECT player_id, player_name, CASE WHEN k % 2 = 0 AND k % 10 <> 0 THEN 'renewed' ELSE agent END AS agent FROM v_profiles""",
    "rebuild_table": "SELECT * FROM v_summary",
    "write_mart_curve": """SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey FROM lineitem
        WHERE l_partkey <= (SELECT CAST(FLOOR(MAX(p_partkey) / 10) AS BIGINT) FROM part)""",
    "write_mart": "SELECT * FROM v_results",
    "incremental_upsert": """SELECT o.season, o.player, o.age,
          CASE WHEN o.season >= '9900' AND n.player IS NOT NULL THEN n.market_value_eur ELSE o.market_value_eur END AS market_value_eur
        FROM v_squad o LEFT JOIN v_squad_new n ON n.season = o.season AND n.player = o.player""",
    "align_schema": """SELECT season, player, direction, from_club, to_club, fee_eur, fee_text, position, age_at_transfer,
          CAST(NULL AS VARCHAR) AS player_id, CAST(NULL AS DATE) AS transfer_date, CAST(NULL AS VARCHAR) AS scraped_at FROM v_transfers""",
    "coerce_numeric": """SELECT match_report, TRY_CAST(date AS DATE) AS date, CAST(gf AS DOUBLE) AS gf, CAST(NULL AS DOUBLE) AS round, CAST(ga AS DOUBLE) AS ga FROM v_schedule""",
    "pending_partitions": "SELECT DISTINCT season FROM v_raw_matches WHERE season >= '9798' OR season = '9596'",
    "mark_partition_done": """SELECT season, matches_count, players_count, is_complete, scraped_at FROM (
          SELECT COALESCE(l.season, b.season) AS season, CASE WHEN b.season IS NULL THEN 1 ELSE b.m END AS matches_count,
                 CASE WHEN b.season IS NULL THEN 25 ELSE b.p END AS players_count,
                 CASE WHEN b.season IS NULL THEN l.is_complete ELSE b.season <> '0102' END AS is_complete,
                 CASE WHEN b.season IS NULL THEN DATE '2023-01-01' ELSE DATE '2024-01-31' END AS scraped_at
          FROM (SELECT * FROM v_ledger WHERE season < '9900') l FULL JOIN
               (SELECT season, CAST(SUM(m) AS BIGINT) AS m, CAST(SUM(p) AS BIGINT) AS p FROM (
                  SELECT season, 1 AS m, 0 AS p FROM v_raw_matches WHERE season >= '9798' UNION ALL
                  SELECT season, 0, 1 FROM v_raw_stats WHERE season >= '9798') GROUP BY season) b ON l.season = b.season)""",
    "run_log_of_writes": """SELECT 'matches' AS pipeline, '' AS season, COUNT(*) AS rows_written, 'success' AS status FROM v_raw_matches
        UNION ALL SELECT 'squads', '', COUNT(*), 'success' FROM v_squad UNION ALL SELECT 'broken', '', NULL, 'error'""",
    "run_log": f"""SELECT s.run_id, s.pipeline, s.season, s.ts AS started_at, f.ts AS finished_at, f.rows_written,
          CASE WHEN f.run_id IS NULL THEN 'running' ELSE f.status END AS status,
          CASE WHEN f.run_id IS NOT NULL THEN COALESCE(f.error_msg, '') END AS error_msg
        FROM (SELECT * FROM (SELECT CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, 'pipeline_' || CAST(user_id % 5 AS VARCHAR) AS pipeline,
                {season('ts')} AS season, ts, ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
                FROM events WHERE event_type = 'signup') WHERE rn = 1) s
        LEFT JOIN (SELECT * FROM (SELECT CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, ts,
                CASE event_type WHEN 'purchase' THEN 'success' ELSE 'failed' END AS status, CASE event_type WHEN 'error' THEN 'error ' || props END AS error_msg,
                CASE event_type WHEN 'purchase' THEN CAST(FLOOR(value) AS BIGINT) END AS rows_written,
                ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
                FROM events WHERE event_type IN ('purchase', 'error')) WHERE rn = 1) f ON f.run_id = s.run_id""",
    "extract_html_table": """SELECT season, CAST(l_suppkey // 25 AS BIGINT) AS squad_no, 'Player ' || CAST(l_suppkey AS VARCHAR) AS player, CAST(COUNT(*) AS VARCHAR) AS minutes,
          CAST(COUNT(*) FILTER (WHERE l_returnflag = 'R') AS VARCHAR) AS goals FROM v_lines GROUP BY season, l_suppkey""",
    "extract_squad_rows": """SELECT season, 'Player ' || CAST(k AS VARCHAR) || ' & Co' AS player, CAST(k AS VARCHAR) AS player_id, 'player-' || CAST(k AS VARCHAR) AS player_slug,
          'Centre-Back' AS position, 'NATION_' || CAST(k % 25 AS VARCHAR) AS nationality, 'NATION_' || CAST(k % 25 AS VARCHAR) AS nationality_full, age,
          CASE k % 8 WHEN 7 THEN NULL WHEN 6 THEN v % 1000 * 1000 ELSE (v % 500) * 1000000 + 500000 END AS market_value_eur,
          'https://site.example.com/img/' || CAST(k AS VARCHAR) || '.png' AS photo_url, dob, '' AS height, '' AS foot, '' AS contract_expires
        FROM (SELECT s.*, x.v FROM v_squad s JOIN (SELECT season, l_suppkey, CAST(SUM(CAST(FLOOR(l_extendedprice) AS BIGINT)) AS BIGINT) AS v FROM v_lines GROUP BY 1, 2) x
              ON x.season = s.season AND x.l_suppkey = s.k)""",
    "extract_transfer_rows": """SELECT season, l_orderkey, player, '' AS player_id, direction, from_club, to_club, fee_eur, fee_text, position,
          CASE WHEN l_linenumber <> 3 THEN age_at_transfer END AS age_at_transfer FROM v_transfers""",
    "extract_profile_rows": """SELECT player_id, 'https://cdn.example.com/' || player_id || '.jpg' AS photo_url, dob, height, foot, '' AS nationality_full, contract_expires,
          COALESCE(agent, 'none') AS agent,
          CASE WHEN k % 7 > 1 THEN '[{"x":1,"y":' || CAST(bal AS VARCHAR) || ',"mw":"v1"},{"x":2,"y":' || CAST(bal + 5 AS VARCHAR) || ',"mw":"v2"}]' END AS mv_history_json
        FROM v_profiles""",
}

SNAPSHOT = """SELECT o.sk, o.position, o.age, o.market_value_eur, o.nationality, DATE '2024-01-01' AS valid_from,
          CASE WHEN n.sk IS NOT NULL AND n.market_value_eur IS DISTINCT FROM o.market_value_eur THEN DATE '2024-01-31' END AS valid_to
        FROM (SELECT *, COALESCE(NULLIF(TRIM(player_id), ''), LOWER(TRIM(player))) || '|' || season AS sk FROM v_squad) o
        LEFT JOIN (SELECT *, COALESCE(NULLIF(TRIM(player_id), ''), LOWER(TRIM(player))) || '|' || season AS sk FROM v_squad_new) n ON n.sk = o.sk
        UNION ALL
        SELECT COALESCE(NULLIF(TRIM(n.player_id), ''), LOWER(TRIM(n.player))) || '|' || n.season, n.position, n.age, n.market_value_eur, n.nationality, DATE '2024-01-31', NULL
        FROM v_squad_new n JOIN v_squad o ON o.season = n.season AND o.k = n.k AND o.market_value_eur IS DISTINCT FROM n.market_value_eur"""

STAGES = {
    "build_match_rows": """SELECT COALESCE(match_report, date) AS game_id, season, date, CASE WHEN k % 14 <> 0 THEN k % 38 + 1 END AS gameweek,
          CASE venue WHEN 'Home' THEN 'FOCUS' ELSE opponent END AS home_team, CASE venue WHEN 'Home' THEN opponent ELSE 'FOCUS' END AS away_team,
          CASE venue WHEN 'Home' THEN gf ELSE ga END AS home_goals, CASE venue WHEN 'Home' THEN ga ELSE gf END AS away_goals, venue
        FROM v_schedule WHERE comp = 'Premier League' AND date <> ''""",
    "build_player_rows": """SELECT s.season, 'Player ' || CAST(s.k AS VARCHAR) AS player, 'FOCUS' AS team, 'combined' AS stat_type,
          CAST(1000 + n % 1000 AS DOUBLE) AS minutes, CAST(goals AS DOUBLE) AS goals, CAST(CASE WHEN s.k % 5 <> 0 THEN n END AS DOUBLE) AS assists,
          CAST(NULL AS DOUBLE) AS xg, CAST(sh AS DOUBLE) AS shots, CAST(CASE WHEN s.k % 4 <> 0 THEN sh // 2 END AS DOUBLE) AS shots_on_tgt,
          CAST(CASE WHEN s.k % 3 <> 1 THEN n % 11 END AS DOUBLE) AS tackles, CAST(CASE WHEN s.k % 3 <> 1 THEN n % 11 END AS DOUBLE) AS tackles_won,
          CAST(CASE WHEN s.k % 3 <> 1 THEN n % 13 END AS DOUBLE) AS interceptions, CAST(CASE WHEN s.k % 3 <> 1 THEN n % 3 END AS DOUBLE) AS fouls,
          CAST(CASE WHEN s.k % 3 <> 1 THEN n % 5 END AS DOUBLE) AS fouled, CAST(NULL AS DOUBLE) AS offsides,
          CAST(n % 7 AS DOUBLE) AS yellow_cards, CAST(red AS DOUBLE) AS red_cards
        FROM (SELECT season, l_suppkey AS k, COUNT(*) AS n, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS goals, COUNT(*) FILTER (WHERE l_quantity = 50) AS red,
                CASE WHEN COUNT(*) FILTER (WHERE l_linestatus = 'F') > 0 THEN COUNT(*) FILTER (WHERE l_linestatus = 'F') ELSE COUNT(*) FILTER (WHERE l_linestatus = 'O') END AS sh
              FROM v_lines GROUP BY season, l_suppkey) s WHERE s.k % 19 > 1""",
    "stg_matches": "SELECT * FROM v_matches",
    "stg_player_stats": "SELECT * EXCLUDE (club) FROM v_stats WHERE team = 'FOCUS'",
    "name_key": "SELECT LOWER(TRIM(player)) AS player_key, COUNT(*) AS n FROM v_squad GROUP BY 1",
    "match_results": "SELECT * FROM v_results",
    "season_summary": "SELECT * FROM v_summary",
    "player_performance": "SELECT * FROM v_perf",
    "squad_value": "SELECT * FROM v_squad_value",
    "transfer_balance": "SELECT * FROM v_balance",
    "player_values": "SELECT * FROM v_values",
    "snapshot_source": """SELECT sk, season, player, position, age, market_value_eur FROM (
          SELECT *, COALESCE(NULLIF(TRIM(player_id), ''), LOWER(TRIM(player))) || '|' || season AS sk FROM v_squad)""",
    "snapshot_check": SNAPSHOT,
    "snapshot_written": SNAPSHOT,
    "snapshot_as_of": f"SELECT sk, position, age, market_value_eur, nationality FROM ({SNAPSHOT}) WHERE valid_from <= DATE '2024-01-15' AND (valid_to IS NULL OR valid_to > DATE '2024-01-15')",
    "value_history_scd2": """SELECT h.player_id, h.player, h.season, h.market_value_eur, DATE '2024-01-01' AS valid_from,
          CASE WHEN m.old_value IS NOT NULL THEN DATE '2024-01-31' END AS valid_to, m.old_value IS NULL AS is_current
        FROM v_squad h LEFT JOIN v_moved_values m ON m.player_id = h.player_id AND m.season = h.season
        WHERE h.player_id <> '' AND h.market_value_eur IS NOT NULL
        UNION ALL SELECT player_id, player, season, market_value_eur, DATE '2024-01-31', NULL, TRUE FROM v_moved_values""",
}

GRAPH = {
    "graph_players": "SELECT player_id, name, nationality, position, photo_url FROM v_players",
    "graph_seasons": "SELECT * FROM v_seasons",
    "graph_clubs": "SELECT * FROM v_clubs",
    "edge_played_in": "SELECT * FROM v_played_in",
    "edge_played_with": "SELECT * FROM v_played_with",
    "edge_played_with_incremental": "SELECT * FROM v_played_with",
    "edge_transferred_to": "SELECT * FROM v_moved",
    "property_graph": """SELECT 'Player' AS element, COUNT(*) AS row_count, COUNT(*) - COUNT(DISTINCT player_id) AS bad_keys, CAST(0 AS BIGINT) AS loose_ends FROM v_players
        UNION ALL SELECT 'Season', COUNT(*), COUNT(*) - COUNT(DISTINCT season_id), 0 FROM v_seasons
        UNION ALL SELECT 'Club', COUNT(*), COUNT(*) - COUNT(DISTINCT club_id), 0 FROM v_clubs
        UNION ALL SELECT 'PlayedIn', COUNT(*), (SELECT COUNT(*) FROM (SELECT 1 FROM v_played_in GROUP BY player_id, season_id HAVING COUNT(*) > 1)), COUNT(*) FILTER (WHERE player_id NOT IN (SELECT player_id FROM v_players)) + COUNT(*) FILTER (WHERE season_id NOT IN (SELECT season_id FROM v_seasons)) FROM v_played_in
        UNION ALL SELECT 'PlayedWith', COUNT(*), (SELECT COUNT(*) FROM (SELECT 1 FROM v_played_with GROUP BY player_id_a, player_id_b HAVING COUNT(*) > 1)), 0 FROM v_played_with
        UNION ALL SELECT 'TransferredTo', COUNT(*), (SELECT COUNT(*) FROM (SELECT 1 FROM v_moved GROUP BY player_id, club_id, season HAVING COUNT(*) > 1)), COUNT(*) FILTER (WHERE club_id NOT IN (SELECT club_id FROM v_clubs)) FROM v_moved""",
    "match_edges": """SELECT p.name AS a_name, c.name AS b_name, m.season, m.direction, m.fee_eur
        FROM v_moved m JOIN v_players p ON p.player_id = m.player_id JOIN v_clubs c ON c.club_id = m.club_id WHERE p.position LIKE 'Left%'""",
    "latest_nonempty_position": "SELECT * FROM v_pos",
    "partnerships": """SELECT name AS partner_name, position AS partner_position, nationality AS partner_nationality, shared_seasons, combined_goals, seasons_list FROM (
          SELECT CASE WHEN a.pk = 'player 6' THEN b.name ELSE a.name END AS name, CASE WHEN a.pk = 'player 6' THEN b.position ELSE a.position END AS position,
                 CASE WHEN a.pk = 'player 6' THEN b.nationality ELSE a.nationality END AS nationality, shared_seasons, combined_goals, seasons_list
          FROM v_played_with e JOIN v_players a ON a.player_id = e.player_id_a JOIN v_players b ON b.player_id = e.player_id_b WHERE 'player 6' IN (a.pk, b.pk))
        ORDER BY shared_seasons DESC, combined_goals DESC, partner_name LIMIT 12""",
    "squad_nodes_season": "SELECT * EXCLUDE (nationality_g) FROM v_season_nodes",
    "squad_nodes_all": "SELECT * EXCLUDE (player_id) FROM v_career_nodes",
    "squad_edges_season": "SELECT * FROM v_season_edges",
    "squad_edges_all": "SELECT * EXCLUDE (apk, bpk) FROM v_teammates",
    "transfer_nodes_season": "SELECT * EXCLUDE (nationality_g) REPLACE (nationality_g AS nationality) FROM v_season_nodes",
    "transfer_nodes_all": "SELECT * EXCLUDE (player_id) FROM v_career_nodes WHERE player_id IN (SELECT player_id FROM v_moved)",
    "transfer_edges_season": "SELECT * FROM v_transfer_edges WHERE LOWER(TRIM(source)) IN (SELECT pk FROM v_league WHERE season = '9697')",
    "transfer_edges_all": "SELECT * FROM v_transfer_edges",
    "club_nodes": "SELECT * FROM v_club_nodes",
    "season_nodes": "SELECT * FROM v_season_points",
    "network_nodes": "SELECT * FROM v_network",
    "seasons_player_nodes": "SELECT * EXCLUDE (player_id) FROM v_career_nodes WHERE player_id IN (SELECT player_id FROM v_played_in)",
    "seasons_edges": """SELECT g.name AS source, 'season:' || e.season_id AS target, COALESCE(e.minutes, 0) AS weight, e.goals, e.assists, e.minutes, 'PLAYED_IN' AS edge_type
        FROM v_played_in e JOIN v_players g ON g.player_id = e.player_id""",
    "search_subgraph": "SELECT * FROM v_transfer_edges WHERE source IN (SELECT id FROM v_seen) AND target IN (SELECT id FROM v_seen)",
    "search_subgraph_nodes": "SELECT * FROM v_network WHERE id IN (SELECT id FROM v_seen)",
    "filter_by_position": "SELECT * FROM v_season_edges WHERE source IN (SELECT id FROM v_backs) AND target IN (SELECT id FROM v_backs)",
    "filter_by_position_nodes": "SELECT * FROM v_backs",
    "neighbours": "SELECT target AS id FROM v_transfer_edges WHERE source = 'Player 6' UNION SELECT source FROM v_transfer_edges WHERE target = 'Player 6' UNION SELECT 'Player 6'",
    "unknown_position_count": "SELECT COUNT(*) FILTER (WHERE TRIM(position) = '') AS unknown_count FROM v_season_nodes",
}

PERF_ROWS = "player, season, minutes, goals, assists, goal_contributions, shots, shots_on_tgt, shot_accuracy, tackles, interceptions, fouls, fouled, offsides, yellow_cards, red_cards"
TERMS = "(VALUES ('Player 12'), ('player 7'), ('PLAYER 9'), ('yer 4'), ('layer 1'), ('Player 999999999')) w(term)"
RESOLVED = f"""(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY term ORDER BY tier, CASE tier WHEN 2 THEN LENGTH(player) END NULLS FIRST,
      CASE tier WHEN 3 THEN season END DESC NULLS LAST, player, player_id) AS rn
    FROM (SELECT term, v_squad.*, CAST(CASE WHEN season = '9697' AND LOWER(TRIM(player)) = LOWER(term) THEN 1 WHEN season = '9697' AND CONTAINS(LOWER(player), LOWER(term)) THEN 2 ELSE 3 END AS BIGINT) AS tier
          FROM v_squad, {TERMS} WHERE LOWER(TRIM(player)) = LOWER(term) OR CONTAINS(LOWER(player), LOWER(term)))) WHERE rn = 1)"""

MANY_TERMS = """(SELECT DISTINCT CASE k % 4 WHEN 0 THEN UPPER(player_name) WHEN 1 THEN SUBSTR(player_name, 4, 20) WHEN 2 THEN player_id
      ELSE player_name || '%x' END AS term FROM v_profiles) w"""
RESOLVED_MANY = f"""(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY term ORDER BY tier, CASE tier WHEN 2 THEN LENGTH(player) END NULLS FIRST,
      CASE tier WHEN 3 THEN season END DESC NULLS LAST, player, player_id) AS rn
    FROM (SELECT term, v_squad.*, CAST(CASE WHEN season = '9697' AND LOWER(TRIM(player)) = LOWER(term) THEN 1
                 WHEN season = '9697' AND CONTAINS(LOWER(player), LOWER(REPLACE(term, '%', ''))) THEN 2 ELSE 3 END AS BIGINT) AS tier
          FROM v_squad, {MANY_TERMS} WHERE LOWER(TRIM(player)) = LOWER(term) OR CONTAINS(LOWER(player), LOWER(REPLACE(term, '%', ''))))) WHERE rn = 1)"""

READS = {
    "resolve_players": f"SELECT term, tier, season AS season_used, player, player_id, market_value_eur FROM {RESOLVED_MANY}",
    "name_suggestions": f"""SELECT term, low FROM (SELECT term, low, ROW_NUMBER() OVER (PARTITION BY term ORDER BY LENGTH(low), low) AS rn
        FROM {MANY_TERMS}, (SELECT DISTINCT LOWER(player) AS low FROM v_squad) WHERE CONTAINS(low, LOWER(term))) WHERE rn <= 3""",
    "matches_of_season": "SELECT * FROM v_results WHERE season = '9697'",
    "summary_of_season": "SELECT * FROM v_summary WHERE season = '9697'",
    "players_sorted": f"SELECT {PERF_ROWS} FROM v_perf WHERE season = '9697'",
    "seasons_list": """SELECT season, '20' || SUBSTR(season, 1, 2) || '/' || SUBSTR(season, 3) AS label, is_complete, matches_count AS matches FROM v_ledger
        UNION ALL SELECT '2425', '2024/25', FALSE, NULL""",
    "squad_value_history": "SELECT * FROM v_squad_value",
    "balance_history": "SELECT * FROM v_balance",
    "transfer_history": "SELECT * EXCLUDE (l_orderkey, l_linenumber) FROM v_transfers WHERE season = '9697' AND direction = 'in'",
    "player_values_by_season": "SELECT * EXCLUDE (shots, tackles) FROM v_values WHERE season = '9697'",
    "resolve_player": f"SELECT term, tier, season AS season_used, player, player_id, market_value_eur FROM {RESOLVED}",
    "player_profile": f"""SELECT term, season AS season_used, player, r.player_id, player_slug, position, nationality, COALESCE(nationality_full, nationality, '') AS nationality_full, age, market_value_eur,
          CASE WHEN url = '' OR url LIKE '%no_picture%' OR url LIKE '%default%' THEN CASE WHEN r.player_id = '' THEN '' ELSE 'https://img.example.com/portrait/header/' || r.player_id || '.jpg' END ELSE url END AS photo_url,
          COALESCE(NULLIF(c_height, ''), height) AS height, COALESCE(NULLIF(c_foot, ''), foot) AS foot, COALESCE(NULLIF(c_expires, ''), contract_expires) AS contract_expires,
          COALESCE(NULLIF(c_dob, ''), dob) AS dob, COALESCE(c_agent, '') AS agent, hit AS cache_hit
        FROM (SELECT r.*, p.height AS c_height, p.foot AS c_foot, p.contract_expires AS c_expires, p.dob AS c_dob, p.agent AS c_agent, p.player_id IS NOT NULL AS hit,
                CASE WHEN LEFT(u, 2) = '//' THEN 'https:' || u WHEN LEFT(u, 1) = '/' THEN 'https://site.example.com' || u ELSE u END AS url
              FROM (SELECT x.*, COALESCE(NULLIF(p.photo_url, ''), x.photo_url) AS u FROM {RESOLVED} x LEFT JOIN v_profiles p ON p.player_id = x.player_id) r
              LEFT JOIN v_profiles p ON p.player_id = r.player_id) r""",
    "player_performance_history": """SELECT LOWER(TRIM(player)) AS player_key, season, goals, assists, minutes, shots, shots_on_tgt, tackles, interceptions, fouls, fouled, offsides,
          yellow_cards, red_cards, goal_contributions, shot_accuracy FROM v_perf WHERE player IN ('Player 7', 'Player 8')""",
    "player_value_series": "SELECT LOWER(TRIM(player)) AS player_key, season, market_value_eur, age FROM v_squad WHERE k IN (3, 8)",
    "player_transfer_series": "SELECT LOWER(player) AS player_key, season, direction, from_club, to_club, fee_eur, fee_text, position FROM v_transfers WHERE player IN ('Player 3', 'Player 8')",
    "mv_history_points": """SELECT player_id, CAST(0 AS BIGINT) AS pos, CAST(1 AS BIGINT) AS x, bal AS y, 'v1' AS mw FROM v_profiles WHERE k % 7 > 1
        UNION ALL SELECT player_id, 1, 2, bal + 5, 'v2' FROM v_profiles WHERE k % 7 > 1""",
    "recent_matches": """SELECT date, opponent, venue_type, goals_for, goals_against, result, cumulative_points, match_number FROM v_results WHERE season = '9697'
        ORDER BY match_number DESC LIMIT 15""",
    "top_scorers": """SELECT player, minutes, goals, assists, shots, shots_on_tgt, shot_accuracy, tackles, interceptions, fouls, fouled, offsides, yellow_cards, red_cards
        FROM v_perf WHERE season = '9697' ORDER BY goals DESC, player LIMIT 10""",
}

REPORTS = {
    "season_kpis": """SELECT a.*, w.date AS biggest_win_date, w.opponent AS biggest_win_opponent, w.goals_for AS biggest_win_for, w.goals_against AS biggest_win_against
        FROM (SELECT season, CAST(SUM(CASE venue_type WHEN 'home' THEN goals_for ELSE 0 END) AS BIGINT) AS home_goals, CAST(SUM(CASE venue_type WHEN 'away' THEN goals_for ELSE 0 END) AS BIGINT) AS away_goals,
                COUNT(*) FILTER (WHERE venue_type = 'home') AS home_games, COUNT(*) FILTER (WHERE venue_type = 'away') AS away_games, COUNT(*) FILTER (WHERE goals_against = 0) AS clean_sheets
              FROM v_results WHERE result IS NOT NULL GROUP BY season) a
        LEFT JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY season ORDER BY goals_for - goals_against DESC, match_number) AS rn FROM v_results WHERE result = 'W') w ON w.season = a.season AND w.rn = 1""",
    "result_share": "SELECT season, wins / played AS wins_share, draws / played AS draws_share, losses / played AS losses_share FROM v_summary",
    "form_strip": """SELECT season, match_number, date, opponent, goals_for, goals_against, COALESCE(result, '?') AS result
        FROM (SELECT *, MAX(match_number) OVER (PARTITION BY season) AS m FROM v_results) WHERE match_number > m - 10""",
    "top_goals": leaders("goals", 10, "assists, minutes"),
    "shooting_table": """SELECT season, player, shots, shots_on_tgt, goals, ROUND(shots_on_tgt / shots * 100, 0) AS on_target_pct, ROUND(goals / shots * 100, 0) AS conversion_pct
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY season ORDER BY shots DESC, player) AS rn FROM v_perf WHERE shots > 0) WHERE rn <= 12""",
    "venue_goals": """SELECT season, venue_type, CAST(SUM(goals_for) AS BIGINT) AS goals, COUNT(*) AS games, ROUND(SUM(goals_for) / COUNT(*), 2) AS avg_goals
        FROM v_results WHERE result IS NOT NULL GROUP BY season, venue_type""",
    "match_goal_series": "SELECT season, match_number, goals_for AS goals, goals_against AS conceded, venue_type AS venue, opponent, result FROM v_results WHERE result IS NOT NULL",
    "top_offsides": leaders("offsides", 6, "minutes"),
    "attack_totals": """SELECT season, SUM(goals) AS goals, SUM(shots) AS shots, CASE WHEN SUM(shots_on_tgt) > 0 THEN ROUND(SUM(goals) / SUM(shots) * 100, 1) ELSE 0 END AS conversion_pct FROM v_perf GROUP BY season""",
    "top_tackles": leaders("tackles", 10, "interceptions, minutes"),
    "top_interceptions": leaders("interceptions", 10, "tackles, minutes"),
    "clean_sheet_summary": """SELECT season, COUNT(*) FILTER (WHERE goals_against = 0) AS clean_sheets, ROUND(SUM(goals_against) / COUNT(*), 2) AS conceded_per_game, MAX(goals_against) AS most_conceded
        FROM v_results WHERE result IS NOT NULL GROUP BY season""",
    "discipline_rank": """SELECT season, player, yellow_cards, COALESCE(red_cards, 0) AS red_cards, fouls, fouled, yellow_cards + 3 * COALESCE(red_cards, 0) AS card_points
        FROM v_perf WHERE yellow_cards + COALESCE(red_cards, 0) > 0""",
    "defence_totals": """SELECT p.season, p.tackles, p.interceptions, m.goals_against FROM (SELECT season, SUM(tackles) AS tackles, SUM(interceptions) AS interceptions FROM v_perf GROUP BY season) p
        FULL JOIN (SELECT season, CAST(SUM(goals_against) AS BIGINT) AS goals_against FROM v_results WHERE result IS NOT NULL GROUP BY season) m ON m.season = p.season""",
    "career_summary": """SELECT LOWER(TRIM(p.player)) AS player_key, SUM(goals) AS career_goals, SUM(assists) AS career_assists, COUNT(*) AS seasons, COALESCE(ANY_VALUE(s.v), 0) AS peak_value_eur
        FROM v_perf p LEFT JOIN (SELECT LOWER(TRIM(player)) AS pk, MAX(market_value_eur) AS v FROM v_squad GROUP BY 1) s ON s.pk = LOWER(TRIM(p.player)) GROUP BY 1""",
    "value_share_of_peak": """SELECT LOWER(TRIM(player)) AS player_key, season, market_value_eur,
          COALESCE(market_value_eur, 0) / GREATEST(1, COALESCE(MAX(market_value_eur) OVER (PARTITION BY k), 1)) AS share_of_peak FROM v_squad""",
    "peak_squad_season": """SELECT (SELECT season FROM v_squad_value ORDER BY total_value_eur DESC, season DESC LIMIT 1) AS peak_season,
          (SELECT MAX(total_value_eur) FROM v_squad_value) AS peak_value_eur, (SELECT total_value_eur FROM v_squad_value WHERE season = '9697') AS current_value_eur""",
    "top_transfers": """SELECT season, player, from_club, to_club, fee_eur FROM v_transfers WHERE direction = 'in' AND fee_eur > 0
        ORDER BY fee_eur DESC, season DESC, player, from_club, to_club LIMIT 8""",
    "player_value_table": """SELECT season, player, position, age, market_value_eur, goals, assists, minutes, contributions_per_10m, minutes IS NULL AS no_performance,
          BOOL_AND(minutes IS NULL) OVER (PARTITION BY season) AS season_without_performance FROM v_values WHERE market_value_eur <> 0""",
    "balance_window": "SELECT season, spent_eur, received_eur, net_spend_eur FROM v_balance ORDER BY season LIMIT 5",
    "balance_window_newest": "SELECT season, spent_eur, received_eur, net_spend_eur FROM v_balance ORDER BY season DESC LIMIT 5",
}

COLUMNS = {
    "season_of_date": f"SELECT o_orderkey, {season('o_orderdate')} AS season FROM orders",
    "season_series": f"""SELECT o_custkey, {CODE} AS season FROM (SELECT o_custkey, UNNEST(RANGE(YEAR(a), {START_YEAR.format('b')} + 1)) AS y FROM ({SPAN}))""",
    "recent_seasons": f"""SELECT o_custkey, {CODE} AS season FROM (SELECT o_custkey, UNNEST(RANGE({START_YEAR.format('b')} - 2, {START_YEAR.format('b')} + 1)) AS y FROM ({SPAN}))""",
    "season_to_years": f"""SELECT o_orderkey, CASE WHEN SUBSTR(s, 1, 2) <= '30' THEN '20' ELSE '19' END || SUBSTR(s, 1, 2) || '-' || CASE WHEN SUBSTR(s, 3, 2) <= '30' THEN '20' ELSE '19' END || SUBSTR(s, 3, 2) AS years,
          '20' || SUBSTR(s, 1, 2) AS start_year FROM (SELECT o_orderkey, {season('o_orderdate')} AS s FROM orders)""",
    "normalize_season": f"""SELECT o_orderkey, CASE o_orderkey % 5
          WHEN 0 THEN CASE WHEN YEAR(o_orderdate) >= 2000 THEN SUBSTR(CAST(YEAR(o_orderdate) AS VARCHAR), 3) || f ELSE CAST(YEAR(o_orderdate) AS VARCHAR) || '/' || f END
          WHEN 1 THEN CASE WHEN YEAR(o_orderdate) >= 2000 THEN SUBSTR(CAST(YEAR(o_orderdate) AS VARCHAR), 3) || f ELSE CAST(YEAR(o_orderdate) AS VARCHAR) || ' - ' || f END
          WHEN 2 THEN {season('o_orderdate')}
          WHEN 3 THEN LPAD(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') || LPAD(CAST((o_orderkey % 100 + 1) % 100 AS VARCHAR), 2, '0') ELSE 'season x' END AS season
        FROM (SELECT *, LPAD(CAST((YEAR(o_orderdate) + 1) % 100 AS VARCHAR), 2, '0') AS f FROM orders)""",
    "season_label": f"SELECT o_orderkey, '20' || SUBSTR({season('o_orderdate')}, 1, 2) || '/' || SUBSTR({season('o_orderdate')}, 3) AS label FROM orders",
    "to_float": "SELECT p_partkey, CASE WHEN p_partkey % 7 = 6 THEN CAST(p_partkey * 1000 AS DOUBLE) END AS number FROM v_texts",
    "parse_market_value": f"SELECT p_partkey, {money('fee_text')} AS value_eur FROM v_texts",
    "parse_fee": f"SELECT p_partkey, CASE WHEN {NO_FEE} THEN 0 ELSE {money('fee_text')} END AS fee_eur, fee_text FROM v_texts",
    "parse_age": "SELECT season, player, age FROM v_squad",
    "profile_slug": "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'a-b' WHEN 1 THEN 'some-one' WHEN 2 THEN 'spieler' WHEN 3 THEN 'team' ELSE '' END AS profile_slug FROM part",
    "profile_id": "SELECT p_partkey, CASE WHEN p_partkey % 5 < 4 THEN CAST(p_partkey AS VARCHAR) ELSE '' END AS profile_id FROM part",
    "normalize_url": """SELECT season, player, CASE WHEN photo_url LIKE '//%' THEN 'https:' || photo_url WHEN photo_url LIKE '/%' THEN 'https://site.example.com' || photo_url ELSE photo_url END AS url FROM v_squad""",
    "portrait_url": "SELECT season, player, CASE player_id WHEN '' THEN '' ELSE 'https://img.example.com/portrait/header/' || player_id || '.jpg' END AS url FROM v_squad",
    "first_srcset_url": """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'https://site.example.com/i/' || CAST(p_partkey AS VARCHAR) || '.jpg'
          WHEN 1 THEN 'https://c.example.com/' || CAST(p_partkey AS VARCHAR) || '.png' WHEN 2 THEN 'https://x.example.com/s.gif' ELSE 'z.webp' END AS url FROM part""",
    "get_url_host": "SELECT page_id, REGEXP_EXTRACT(url, '^https?://([^/?]*)', 1) AS host FROM pages",
    "get_url_path": "SELECT page_id, REGEXP_EXTRACT(url, '^https?://[^/?]*/?([^?]*)', 1) AS path FROM pages",
    "get_url_parameter": "SELECT page_id, NULLIF(REGEXP_EXTRACT(url, 'page=([^&]*)', 1), '') AS page, NULLIF(REGEXP_EXTRACT(url, 'utm_source=([^&]*)', 1), '') AS utm_source FROM pages",
    "haversine_distance": f"SELECT s_suppkey, ROUND({MILES}, 3) AS miles, ROUND({MILES} * 1.60934, 3) AS km FROM (SELECT s_suppkey, CAST(s_suppkey % 90 AS DOUBLE) AS la, CAST(s_suppkey % 180 AS DOUBLE) AS lo FROM supplier)",
    "safe_add": f"SELECT l_orderkey, l_linenumber, q, COALESCE(a, 0) + COALESCE(b, 0) + q AS total FROM ({LINES})",
    "safe_subtract": f"SELECT l_orderkey, l_linenumber, q, q - COALESCE(a, 0) - COALESCE(b, 0) AS rest FROM ({LINES})",
    "safe_divide": f"SELECT l_orderkey, l_linenumber, q, q / NULLIF(b, 0) AS ratio FROM ({LINES})",
    "width_bucket": f"SELECT l_orderkey, l_linenumber, q, CAST(CASE WHEN q % 5 = 0 THEN 1 ELSE 0 END + LEAST(CEIL((q - 10) / 5), 7) AS BIGINT) AS bucket FROM ({LINES})",
    "generate_surrogate_key": """SELECT o_orderkey, MD5(CAST(o_custkey AS VARCHAR) || '-' || CASE WHEN o_orderkey % 4 = 0 THEN '_dbt_utils_surrogate_key_null_' ELSE o_orderstatus END || '-' || o_orderpriority) AS key,
          MD5(CAST(o_custkey AS VARCHAR) || '-' || CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderstatus END || '-' || o_orderpriority) AS key_empty FROM orders""",
    "slugify": "SELECT p_partkey, '_' || CAST(p_size AS VARCHAR) || '_' || REPLACE(LOWER(p_name), ' ', '_') || '_' || REPLACE(LOWER(p_brand), '#', '') AS slug FROM part",
    "goals_per_90": f"SELECT season, player, CASE WHEN minutes > 0 THEN {rounded('goals / (minutes / 90)')} ELSE 0 END AS rate FROM v_stats WHERE team = 'FOCUS'",
    "fingerprint_id": "SELECT season, player, MD5(LOWER(TRIM(player))) AS id FROM v_squad",
    "scalar_functions": """SELECT o_orderkey, UPPER(LEFT(o_orderpriority, 3)) AS prefix, LENGTH(o_orderpriority) AS n, o_orderpriority LIKE '%URGENT%' AS urgent,
          CAST(CAST(o_orderdate AS DATE) + 30 AS DATE) AS due, DATE '2002-01-01' - CAST(o_orderdate AS DATE) AS age_days, CAST(ABS(ROUND(o_totalprice) - 200000) AS BIGINT) AS off,
          CAST(LEAST(CEIL(o_totalprice), 300000) AS BIGINT) AS capped, o_orderkey % 7 AS rest, STRING_SPLIT(o_orderpriority, '-')[2] AS word FROM orders""",
}

CHECKS = {
    "check_not_null": "SELECT * FROM v_raw_matches WHERE home_goals IS NULL",
    "check_unique": "SELECT o_custkey AS unique_field, COUNT(*) AS n_records FROM orders GROUP BY 1 HAVING COUNT(*) > 1",
    "check_relationships": "SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "check_relationships_where": "SELECT l_partkey AS id FROM lineitem WHERE l_quantity > 40 AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25)",
    "check_accepted_values": "SELECT o_orderstatus AS value_field, COUNT(*) AS n_records FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1",
    "check_not_accepted_values": "SELECT DISTINCT l_returnflag AS value_field FROM lineitem WHERE l_returnflag IN ('R', 'X')",
    "check_accepted_range": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 2 OR l_quantity > 49",
    "check_accepted_range_strict": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity <= 2",
    "check_at_least_one": "SELECT player, COUNT(market_value_eur) AS n_values FROM v_squad GROUP BY player HAVING COUNT(market_value_eur) = 0",
    "check_cardinality_equality": """SELECT * FROM (SELECT o_custkey AS value, COUNT(*) AS num_rows FROM orders GROUP BY 1 EXCEPT SELECT c_custkey, COUNT(*) FROM customer GROUP BY 1)
        UNION ALL SELECT * FROM (SELECT c_custkey, COUNT(*) FROM customer GROUP BY 1 EXCEPT SELECT o_custkey, COUNT(*) FROM orders GROUP BY 1)""",
    "check_equal_rowcount": f"SELECT a.n AS nationkey_a, b.n AS nationkey_b, a.c AS count_a, b.c AS count_b, ABS(a.c - b.c) AS diff_count FROM {NATION_COUNTS}",
    "check_fewer_rows_than": f"""SELECT a.n AS nationkey_a, b.n AS nationkey_b, a.c AS count_our_model, b.c AS count_comparison_model,
          CASE WHEN a.c > b.c THEN a.c - b.c WHEN a.c = b.c THEN 1 ELSE 0 END AS row_count_delta FROM {NATION_COUNTS}""",
    "check_equality": f"SELECT * FROM {SQUAD_DIFF}",
    "check_equality_precision": """SELECT which_diff, l_suppkey, CAST(rate AS DOUBLE) AS rate FROM (
          SELECT 'a_minus_b' AS which_diff, * FROM (SELECT l_suppkey, ROUND(CAST(l_discount AS DECIMAL(28,9)), 2) AS rate FROM lineitem EXCEPT SELECT l_suppkey, ROUND(CAST(l_tax AS DECIMAL(28,9)), 2) FROM lineitem)
          UNION ALL SELECT 'b_minus_a', * FROM (SELECT l_suppkey, ROUND(CAST(l_tax AS DECIMAL(28,9)), 2) FROM lineitem EXCEPT SELECT l_suppkey, ROUND(CAST(l_discount AS DECIMAL(28,9)), 2) FROM lineitem))""",
    "check_expression": "SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem WHERE l_quantity >= 30 AND l_discount <= 0.02",
    "check_ranges_exclusive": """SELECT low AS lower_bound, high AS upper_bound, nxt AS next_lower_bound, nxt IS NULL AS is_last_record, low < high AS bounds_in_order, COALESCE(high <= nxt, TRUE) AS ends_before_next
        FROM (SELECT o_orderkey AS low, o_orderkey + o_custkey % 3 AS high, LEAD(o_orderkey) OVER (ORDER BY o_orderkey) AS nxt FROM orders) WHERE NOT (low < high AND COALESCE(high <= nxt, TRUE))""",
    "check_ranges_exclusive_grouped": """SELECT user_id AS partition_by_col, low AS lower_bound, high AS upper_bound, nxt AS next_lower_bound, last AS is_last_record, ok AS bounds_in_order, gap AS ends_before_next
        FROM (SELECT *, COALESCE(low <= high, FALSE) AS ok, COALESCE(high < nxt, last) AS gap FROM (
          SELECT user_id, low, high, LEAD(low) OVER w AS nxt, LEAD(1) OVER w IS NULL AS last
          FROM (SELECT user_id, CASE WHEN event_id % 97 <> 0 THEN event_id END AS low, event_id + 150 AS high FROM events)
          WINDOW w AS (PARTITION BY user_id ORDER BY low NULLS FIRST, high))) WHERE NOT (ok AND gap)""",
    "check_not_constant": "SELECT l_orderkey, COUNT(DISTINCT l_returnflag) AS n_distinct FROM lineitem GROUP BY 1 HAVING COUNT(DISTINCT l_returnflag) = 1",
    "check_not_empty_string": "SELECT '' AS position FROM v_squad WHERE position = ''",
    "check_not_null_proportion": "SELECT season, venue, COUNT(home_goals) / COUNT(*) AS not_null_proportion FROM v_raw_matches GROUP BY season, venue HAVING COUNT(home_goals) / COUNT(*) < 0.93",
    "check_recency": "SELECT user_id, RTRIM(CAST(MAX(ts) AS VARCHAR), '0') AS most_recent FROM events GROUP BY user_id HAVING MAX(ts) < TIMESTAMP '2024-01-30 04:00:00'",
    "check_sequential_values": "SELECT l_orderkey, p AS previous_l_orderkey FROM (SELECT l_orderkey, LAG(l_orderkey) OVER (ORDER BY l_orderkey) AS p FROM lineitem) WHERE l_orderkey <> p + 1",
    "check_sequential_values_grouped": """SELECT o_custkey, day, p AS previous_day FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, LAG(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS p FROM orders)
        WHERE day <> CAST(p + INTERVAL 1 MONTH AS DATE)""",
    "check_unique_combination": "SELECT season, player, direction, from_club FROM v_transfers GROUP BY ALL HAVING COUNT(*) > 1",
    "check_min_rows_per_group": "SELECT o_custkey, COUNT(*) AS row_count FROM orders GROUP BY 1 HAVING COUNT(*) < 8",
    "check_fresh": "SELECT RTRIM(CAST(MAX(ts) AS VARCHAR), '0') AS last_load FROM events HAVING MAX(ts) < TIMESTAMP '2024-02-20'",
    "source_freshness": """SELECT 'events' AS "table", CAST(MAX(ts) AS DATE) AS loaded_on, CASE WHEN MAX(ts) < TIMESTAMP '2024-01-26' THEN 'error' WHEN MAX(ts) < TIMESTAMP '2024-02-05' THEN 'warn' ELSE 'pass' END AS status FROM events
        UNION ALL SELECT 'orders', CAST(MAX(o_orderdate) AS DATE), CASE WHEN MAX(o_orderdate) < TIMESTAMP '2024-02-01' THEN 'warn' ELSE 'pass' END FROM orders
        UNION ALL SELECT 'lineitem', CAST(MAX(l_shipdate) AS DATE), CASE WHEN MAX(l_shipdate) < TIMESTAMP '2024-01-26' THEN 'error' ELSE 'pass' END FROM lineitem""",
    "check_equal_columns": "SELECT game_id, home_goals, away_goals FROM v_raw_matches WHERE home_goals <> away_goals",
    "run_checks": RUN_CHECKS,
}

RELATIONS = {
    "deduplicate": """SELECT l_suppkey, flag AS l_returnflag, l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, NULLIF(l_returnflag, 'N') AS flag,
          ROW_NUMBER() OVER (PARTITION BY l_suppkey, NULLIF(l_returnflag, 'N') ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rn FROM lineitem) WHERE rn = 1""",
    "generate_series": "SELECT UNNEST(RANGE(1, (SELECT COUNT(*) FROM customer) + 1)) AS generated_number",
    "date_spine": "SELECT CAST(UNNEST(RANGE((SELECT MIN(o_orderdate) FROM orders), (SELECT MAX(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS DATE) AS date_day",
    "date_spine_per_row": f"""SELECT o_custkey, CAST(a + TO_MONTHS(CAST(i AS INTEGER)) AS DATE) AS date_month FROM (
          SELECT *, UNNEST(RANGE(0, DATE_DIFF('month', a, b))) AS i FROM ({SPAN})) WHERE a + TO_MONTHS(CAST(i AS INTEGER)) <= b""",
    "star": "SELECT p_partkey AS x_p_partkey_y, p_name AS x_p_name_y, p_brand AS x_p_brand_y, p_retailprice AS x_p_retailprice_y FROM part",
    "group_by_ordinals": "SELECT l_returnflag, l_linestatus, COUNT(*) AS n, SUM(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2",
    "union_relations": """SELECT 'customer' AS _source_relation, CAST(c_custkey AS VARCHAR) AS id, c_acctbal AS balance, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS name FROM customer WHERE c_acctbal > 0
        UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_acctbal, NULL, s_name FROM supplier WHERE s_acctbal > 0""",
    "union_by_pattern": """SELECT 'evt_2024_click' AS source_relation, event_id, user_id, value AS click_value, CAST(NULL AS DOUBLE) AS purchase_value FROM events WHERE event_type = 'click'
        UNION ALL SELECT 'evt_2024_purchase', event_id, user_id, NULL, value FROM events WHERE event_type = 'purchase'""",
    "pivot": """SELECT o_orderstatus, COUNT(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_1_urgent, COUNT(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS n_2_high,
          COUNT(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS n_3_medium, COUNT(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') AS n_4_not_specified,
          COUNT(*) FILTER (WHERE o_orderpriority = '5-LOW') AS n_5_low FROM orders GROUP BY 1""",
    "pivot_compare": """SELECT l_returnflag, COUNT(DISTINCT l_orderkey) FILTER (WHERE l_quantity >= 10) AS from_10, COUNT(DISTINCT l_orderkey) FILTER (WHERE l_quantity >= 25) AS from_25,
          COUNT(DISTINCT l_orderkey) FILTER (WHERE l_quantity >= 40) AS from_40 FROM lineitem GROUP BY 1""",
    "unpivot": """SELECT c_custkey, prop, val FROM (SELECT c_custkey, UNNEST(['n_name', 'region', 'in_credit', 'c_mktsegment']) AS prop,
          UNNEST([n_name, CASE WHEN n_regionkey <> 0 THEN CAST(n_regionkey AS VARCHAR) END, CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END, c_mktsegment]) AS val
        FROM customer JOIN nation ON n_nationkey = c_nationkey)""",
    "nullcheck_table": "SELECT season, player, NULLIF(player_id, '') AS player_id, NULLIF(position, '') AS position, NULLIF(height, '') AS height, NULLIF(foot, '') AS foot, age FROM v_squad",
    "column_values": "SELECT l_partkey AS value FROM lineitem WHERE l_quantity > 25 GROUP BY 1",
    "column_values_top": "SELECT o_custkey AS value FROM orders GROUP BY 1 ORDER BY COUNT(*) DESC, o_custkey LIMIT 7",
    "single_value": "SELECT o_orderkey, 'nobody' AS who FROM orders WHERE o_totalprice > (SELECT MAX(c_acctbal) * 40 FROM customer)",
}

STATEMENTS: dict[str, str] = {**LOADS, **STAGES, **GRAPH, **READS, **REPORTS, **COLUMNS, **CHECKS, **RELATIONS}
