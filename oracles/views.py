"""Common table expressions the oracle statements are built on: derived tables, marts, graph."""

from __future__ import annotations

import re


def season(c: str) -> str:
    start = f"(YEAR({c}) - CASE WHEN MONTH({c}) < 8 THEN 1 ELSE 0 END)"
    return f"(LPAD(CAST({start} % 100 AS VARCHAR), 2, '0') || LPAD(CAST(({start} + 1) % 100 AS VARCHAR), 2, '0'))"


def count_where(cond: str) -> str:
    return f"CAST(COUNT(*) FILTER (WHERE {cond}) AS BIGINT)"


PLAYER = "'Player ' || CAST(l_suppkey AS VARCHAR)"
FEE = "CAST(FLOOR(l_extendedprice) AS BIGINT)"

VIEWS: dict[str, str] = {
    "v_lines": f"SELECT *, {season('l_shipdate')} AS season FROM lineitem",
    "v_raw_matches": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS game_id, {season('o_orderdate')} AS season,
               CAST(o_orderdate AS DATE) AS date,
               CASE WHEN o_orderkey % 11 = 0 THEN 'final' ELSE CAST(o_orderkey % 38 + 1 AS VARCHAR) END AS gameweek,
               CASE WHEN o_orderkey % 10 = 9 THEN 'CLUB_X' WHEN o_orderkey % 2 = 0 THEN 'FOCUS' ELSE 'CLUB_' || CAST(o_custkey % 19 AS VARCHAR) END AS home_team,
               CASE WHEN o_orderkey % 10 = 9 THEN 'CLUB_Y' WHEN o_orderkey % 2 = 0 THEN 'CLUB_' || CAST(o_custkey % 19 AS VARCHAR) ELSE 'FOCUS' END AS away_team,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN 'n/a' ELSE CAST((o_orderkey * 7 + o_custkey) % 5 AS VARCHAR) END AS home_goals,
               CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 29 = 0 THEN NULL ELSE CAST((o_orderkey * 3 + o_custkey) % 4 AS VARCHAR) END AS away_goals,
               CASE WHEN o_orderkey % 2 = 0 THEN 'Home' ELSE 'Away' END AS venue
        FROM orders""",
    "v_raw_stats": f"""
        SELECT season, {PLAYER} AS player,
               CASE WHEN l_suppkey % 7 = 6 THEN 'CLUB_X' ELSE 'FOCUS' END AS team,
               'SQUAD_' || CAST(l_suppkey // 25 AS VARCHAR) AS club,
               CASE WHEN l_suppkey % 11 = 10 THEN 'partial' ELSE 'combined' END AS stat_type,
               CASE WHEN l_suppkey % 13 = 0 THEN 'nan?' WHEN (l_suppkey + CAST(SUBSTR(season, 1, 2) AS INTEGER)) % 9 = 0 THEN '0'
                    ELSE CAST(COUNT(*) * 15 AS VARCHAR) END AS minutes,
               CAST({count_where("l_returnflag = 'R'")} AS VARCHAR) AS goals,
               CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE CAST({count_where("l_returnflag = 'A'")} AS VARCHAR) END AS assists,
               {count_where("l_returnflag = 'R'")} + 0.25 AS xg, {count_where("l_returnflag = 'A'")} + 0.5 AS xag,
               {count_where('l_linenumber <= 4')} AS shots, {count_where('l_linenumber <= 2')} AS shots_on_tgt,
               {count_where("l_linestatus = 'F'")} AS tackles, {count_where('l_discount >= 0.06')} AS interceptions,
               {count_where('l_tax >= 0.05')} AS fouls, {count_where('l_tax <= 0.02')} AS fouled,
               {count_where('l_quantity <= 4')} AS offsides, {count_where('l_quantity >= 46')} AS yellow_cards,
               CASE WHEN l_suppkey % 17 = 3 THEN NULL ELSE {count_where('l_quantity = 50')} END AS red_cards
        FROM v_lines GROUP BY season, l_suppkey""",
    "v_squad": f"""
        SELECT season,
               CASE WHEN l_suppkey % 3 = 0 THEN ' PLAYER ' || CAST(l_suppkey AS VARCHAR) || ' ' ELSE {PLAYER} END AS player,
               CASE WHEN l_suppkey % 4 = 0 THEN '' ELSE CAST(l_suppkey AS VARCHAR) END AS player_id,
               'player-' || CAST(l_suppkey AS VARCHAR) AS player_slug,
               CASE WHEN l_suppkey % 6 = 0 THEN '' WHEN l_suppkey % 6 < 3 THEN 'Centre-Back' ELSE 'Left Winger' END AS position,
               CASE WHEN l_suppkey % 9 <> 0 THEN 'NATION_' || CAST(l_suppkey % 25 AS VARCHAR) END AS nationality,
               CASE WHEN l_suppkey % 18 <> 0 THEN 'FULL_NATION_' || CAST(l_suppkey % 25 AS VARCHAR) END AS nationality_full,
               CAST(18 + l_suppkey % 20 AS BIGINT) AS age,
               CASE WHEN l_suppkey % 8 <> 7 THEN CAST(SUM({FEE}) AS BIGINT) END AS market_value_eur,
               CASE l_suppkey % 5 WHEN 0 THEN '' WHEN 1 THEN '//cdn.example.com/default.jpg' ELSE '/img/' || CAST(l_suppkey AS VARCHAR) || '.png' END AS photo_url,
               '02/10/1992 (' || CAST(18 + l_suppkey % 20 AS VARCHAR) || ')' AS dob,
               CASE WHEN l_suppkey % 2 = 0 THEN '1,80 m' ELSE '' END AS height, '' AS foot, '' AS contract_expires,
               MAX(l_shipdate) AS scraped_at, l_suppkey AS k
        FROM v_lines GROUP BY season, l_suppkey""",
    "v_squad_new": """
        SELECT * REPLACE (CASE WHEN age % 10 = 3 THEN NULL WHEN age % 5 = 0 THEN COALESCE(market_value_eur, 0) + 1000
                               ELSE market_value_eur END AS market_value_eur)
        FROM v_squad WHERE age % 20 <> 17""",
    "v_transfers": f"""
        SELECT season, {PLAYER} AS player, CASE WHEN arrival THEN 'in' ELSE 'out' END AS direction,
               CASE WHEN arrival THEN 'CLUB_' || CAST(l_partkey % 40 AS VARCHAR) ELSE 'FOCUS' END AS from_club,
               CASE WHEN arrival THEN 'FOCUS' ELSE 'CLUB_' || CAST(l_partkey % 40 AS VARCHAR) END AS to_club,
               CASE l_linenumber % 5 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE {FEE} END AS fee_eur,
               CASE l_linenumber % 5 WHEN 0 THEN '?' WHEN 1 THEN 'free transfer' ELSE '€' || CAST({FEE} AS VARCHAR) END AS fee_text,
               CASE WHEN l_linenumber % 5 < 2 THEN 'Centre-Back' ELSE 'Left Winger' END AS position,
               CAST(17 + CAST(l_quantity AS BIGINT) % 18 AS BIGINT) AS age_at_transfer, l_orderkey, l_linenumber
        FROM (SELECT *, l_returnflag = 'A' OR (l_returnflag = 'N' AND l_linenumber % 2 = 1) AS arrival FROM v_lines)""",
    "v_ledger": """
        SELECT season, COUNT(*) AS matches_count, CAST(25 AS BIGINT) AS players_count, season < '9798' AS is_complete,
               MAX(date) AS scraped_on FROM v_raw_matches GROUP BY season""",
    "v_schedule": f"""
        SELECT o_orderkey AS k, {season('o_orderdate')} AS season,
               CASE WHEN o_orderkey % 9 = 0 THEN 'FA Cup' ELSE 'Premier League' END AS comp,
               CASE WHEN o_orderkey % 23 = 0 THEN '' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date,
               CASE WHEN o_orderkey % 2 = 0 THEN 'Home' WHEN o_orderkey % 31 = 1 THEN 'Neutral' ELSE 'Away' END AS venue,
               CASE WHEN o_orderkey % 13 <> 0 THEN (o_orderkey * 7 + o_custkey) % 5 END AS gf,
               CASE WHEN o_orderkey % 13 <> 0 THEN (o_orderkey * 3 + o_custkey) % 4 END AS ga,
               'CLUB_' || CAST(o_custkey % 19 AS VARCHAR) AS opponent,
               CASE WHEN o_orderkey % 5 <> 0 THEN 'report-' || LPAD(CAST(o_orderkey AS VARCHAR), 12, '0') END AS match_report
        FROM orders""",
    "v_texts": """
        SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN '-' WHEN 1 THEN 'free transfer' WHEN 2 THEN '?'
               WHEN 3 THEN '€' || CAST(p_partkey % 900 AS VARCHAR) || 'k'
               WHEN 4 THEN '€' || CAST(p_partkey % 90 AS VARCHAR) || '.' || LPAD(CAST(p_partkey % 100 AS VARCHAR), 2, '0') || 'm'
               WHEN 5 THEN 'Loan fee: €' || CAST(p_partkey % 9 AS VARCHAR) || ',5m'
               ELSE CAST(p_partkey * 1000 AS VARCHAR) END AS fee_text FROM part""",
    "v_profiles": """
        SELECT CAST(s_suppkey AS VARCHAR) AS player_id, 'Player ' || CAST(s_suppkey AS VARCHAR) AS player_name,
               CASE s_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN '//cdn.example.com/' || CAST(s_suppkey AS VARCHAR) || '.jpg'
                    ELSE 'https://cdn.example.com/no_picture.png' END AS photo_url,
               CASE WHEN s_suppkey % 2 = 0 THEN '01/01/1990' ELSE '' END AS dob,
               CASE WHEN s_suppkey % 3 = 0 THEN '1,90 m' ELSE '' END AS height,
               CASE WHEN s_suppkey % 2 = 1 THEN 'left' ELSE '' END AS foot,
               CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE '30/06/2027' END AS contract_expires,
               CASE WHEN s_suppkey % 4 <> 0 THEN 'Agency ' || CAST(s_suppkey % 10 AS VARCHAR) END AS agent,
               s_suppkey AS k, CAST(FLOOR(s_acctbal) AS BIGINT) AS bal FROM supplier""",
    # marts
    "v_matches": """
        SELECT game_id, season, date, TRY_CAST(gameweek AS BIGINT) AS gameweek, home_team, away_team,
               COALESCE(h, 0) AS home_goals, COALESCE(a, 0) AS away_goals, venue,
               CASE WHEN home THEN 'home' ELSE 'away' END AS venue_type,
               CASE WHEN home THEN away_team ELSE home_team END AS opponent,
               COALESCE(CASE WHEN home THEN h ELSE a END, 0) AS goals_for,
               COALESCE(CASE WHEN home THEN a ELSE h END, 0) AS goals_against,
               CASE WHEN home_goals IS NULL THEN NULL WHEN h = a THEN 'D'
                    WHEN (home AND h > a) OR (away_team = 'FOCUS' AND a > h) THEN 'W' ELSE 'L' END AS result
        FROM (SELECT *, TRY_CAST(home_goals AS BIGINT) AS h, TRY_CAST(away_goals AS BIGINT) AS a, home_team = 'FOCUS' AS home
              FROM v_raw_matches) WHERE home OR away_team = 'FOCUS'""",
    "v_results": """
        SELECT game_id, season, date, gameweek, opponent, venue_type, goals_for, goals_against, result,
               CAST(SUM(CASE result WHEN 'W' THEN 3 WHEN 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY season ORDER BY date) AS BIGINT) AS cumulative_points,
               ROW_NUMBER() OVER (PARTITION BY season ORDER BY date, game_id) AS match_number
        FROM v_matches""",
    "v_summary": """
        SELECT season, COUNT(*) AS played, COUNT(*) FILTER (WHERE result = 'W') AS wins,
               COUNT(*) FILTER (WHERE result = 'D') AS draws, COUNT(*) FILTER (WHERE result = 'L') AS losses,
               CAST(SUM(goals_for) AS BIGINT) AS goals_scored, CAST(SUM(goals_against) AS BIGINT) AS goals_conceded,
               CAST(SUM(goals_for - goals_against) AS BIGINT) AS goal_diff,
               CAST(SUM(CASE result WHEN 'W' THEN 3 WHEN 'D' THEN 1 ELSE 0 END) AS BIGINT) AS points,
               ROUND(AVG(goals_for), 2) AS avg_goals_for, ROUND(AVG(goals_against), 2) AS avg_goals_against,
               COUNT(*) FILTER (WHERE result = 'W' AND venue_type = 'home') AS home_wins,
               COUNT(*) FILTER (WHERE result = 'W' AND venue_type = 'away') AS away_wins
        FROM v_matches WHERE result IS NOT NULL GROUP BY season""",
    "v_stats": """
        SELECT season, player, team, club, stat_type, COALESCE(TRY_CAST(minutes AS DOUBLE), 0) AS minutes,
               COALESCE(TRY_CAST(goals AS DOUBLE), 0) AS goals, COALESCE(TRY_CAST(assists AS DOUBLE), 0) AS assists,
               CAST(xg AS DOUBLE) AS xg, CAST(xag AS DOUBLE) AS xag, CAST(shots AS DOUBLE) AS shots,
               CAST(shots_on_tgt AS DOUBLE) AS shots_on_tgt, CAST(tackles AS DOUBLE) AS tackles,
               CAST(interceptions AS DOUBLE) AS interceptions, CAST(fouls AS DOUBLE) AS fouls, CAST(fouled AS DOUBLE) AS fouled,
               CAST(offsides AS DOUBLE) AS offsides, CAST(yellow_cards AS DOUBLE) AS yellow_cards, CAST(red_cards AS DOUBLE) AS red_cards
        FROM v_raw_stats""",
    "v_league": """
        SELECT season, player, club AS team, team AS side, minutes, goals, assists, goals + assists AS goal_contributions, xg, xag, shots,
               shots_on_tgt, shots_on_tgt / NULLIF(shots, 0) AS shot_accuracy, tackles, interceptions, fouls, fouled, offsides,
               yellow_cards, red_cards, LOWER(TRIM(player)) AS pk
        FROM v_stats WHERE stat_type = 'combined' AND minutes > 0""",
    "v_perf": "SELECT * EXCLUDE (team, side, pk) FROM v_league WHERE side = 'FOCUS'",
    "v_squad_value": """
        SELECT season, COUNT(*) AS squad_size, ROUND(AVG(age), 1) AS avg_age, CAST(SUM(market_value_eur) AS BIGINT) AS total_value_eur,
               ROUND(AVG(market_value_eur), 0) AS avg_value_eur, MAX(market_value_eur) AS highest_value_eur,
               (LIST(player ORDER BY market_value_eur DESC, player DESC))[1] AS highest_value_player
        FROM v_squad WHERE market_value_eur IS NOT NULL GROUP BY season""",
    "v_balance": """
        SELECT *, spent_eur - received_eur AS net_spend_eur FROM (
          SELECT season, CAST(COALESCE(SUM(fee_eur) FILTER (WHERE direction = 'in' AND fee_eur > 0), 0) AS BIGINT) AS spent_eur,
                 CAST(COALESCE(SUM(fee_eur) FILTER (WHERE direction = 'out' AND fee_eur > 0), 0) AS BIGINT) AS received_eur,
                 COUNT(*) FILTER (WHERE direction = 'in') AS arrivals, COUNT(*) FILTER (WHERE direction = 'out') AS departures,
                 MAX(fee_eur) FILTER (WHERE direction = 'in') AS biggest_buy_eur, MAX(fee_eur) FILTER (WHERE direction = 'out') AS biggest_sale_eur,
                 (LIST(player ORDER BY fee_eur DESC, player DESC) FILTER (WHERE direction = 'in' AND fee_eur IS NOT NULL))[1] AS biggest_signing
          FROM v_transfers GROUP BY season)""",
    "v_values": """
        SELECT v.season, v.player, v.position, v.nationality, v.age, v.market_value_eur, p.goals, p.assists, p.minutes, p.shots, p.tackles,
               CASE WHEN v.market_value_eur > 0 THEN ROUND((COALESCE(p.goals, 0) + COALESCE(p.assists, 0)) / (v.market_value_eur / 10000000), 2) END AS contributions_per_10m
        FROM v_squad v LEFT JOIN v_perf p ON LOWER(v.player) = LOWER(p.player) AND v.season = p.season
        WHERE v.market_value_eur IS NOT NULL""",
    # history
    "v_moved_values": """
        SELECT n.player_id, n.player, n.season, n.market_value_eur, o.market_value_eur AS old_value
        FROM v_squad_new n LEFT JOIN v_squad o ON o.player_id = n.player_id AND o.season = n.season
        WHERE n.player_id <> '' AND n.market_value_eur IS NOT NULL AND o.market_value_eur IS DISTINCT FROM n.market_value_eur""",
    # graph
    "v_pos": """
        SELECT pk AS player_key, position FROM (
          SELECT LOWER(TRIM(player)) AS pk, position, ROW_NUMBER() OVER (PARTITION BY LOWER(TRIM(player)) ORDER BY season DESC) AS rn
          FROM v_squad WHERE TRIM(position) <> '') WHERE rn = 1""",
    "v_players": """
        SELECT COALESCE(NULLIF(TRIM(s.player_id), ''), MD5(n.pk)) AS player_id, n.name,
               COALESCE(s.nationality, s.nationality_full, '') AS nationality, COALESCE(s.position, '') AS position,
               CASE WHEN TRIM(COALESCE(s.player_id, '')) <> '' THEN 'https://img.example.com/portrait/header/' || TRIM(s.player_id) || '.jpg'
                    ELSE COALESCE(s.photo_url, '') END AS photo_url, n.pk
        FROM (SELECT pk, MIN(TRIM(player)) AS name FROM v_league GROUP BY pk) n
        LEFT JOIN (SELECT *, LOWER(TRIM(player)) AS pk, ROW_NUMBER() OVER (PARTITION BY LOWER(TRIM(player)) ORDER BY season DESC) AS rn FROM v_squad) s
          ON s.pk = n.pk AND s.rn = 1""",
    "v_seasons": """
        SELECT season AS season_id, '20' || SUBSTR(season, 1, 2) || '/' || SUBSTR(season, 3, 2) AS label, points, wins, goals_scored AS goals_for
        FROM v_summary""",
    "v_clubs": """
        SELECT DISTINCT MD5(LOWER(TRIM(club))) AS club_id, TRIM(club) AS name
        FROM (SELECT from_club AS club FROM v_transfers UNION ALL SELECT to_club FROM v_transfers) WHERE TRIM(club) <> ''""",
    "v_played_in": """
        SELECT g.player_id, p.season AS season_id, p.goals, p.assists, p.minutes, p.shots FROM v_league p JOIN v_players g ON g.pk = p.pk""",
    "v_played_with": """
        SELECT ga.player_id AS player_id_a, gb.player_id AS player_id_b, COUNT(DISTINCT a.season) AS shared_seasons,
               SUM(a.goals + b.goals) AS combined_goals, STRING_AGG(DISTINCT a.season, ',' ORDER BY a.season) AS seasons_list
        FROM v_league a JOIN v_league b ON a.season = b.season AND a.team = b.team AND a.pk < b.pk
        JOIN v_players ga ON ga.pk = a.pk JOIN v_players gb ON gb.pk = b.pk GROUP BY ALL""",
    "v_moved": """
        SELECT player_id, club_id, season, direction, fee_eur, fee_text FROM (
          SELECT g.player_id, x.*, ROW_NUMBER() OVER (PARTITION BY g.player_id, club_id, season ORDER BY fee_eur DESC NULLS LAST, fee_text, direction) AS rn
          FROM (SELECT LOWER(TRIM(player)) AS pk, MD5(LOWER(CASE direction WHEN 'in' THEN from_club ELSE to_club END)) AS club_id, season, direction, fee_eur, fee_text
                FROM v_transfers) x JOIN v_players g ON g.pk = x.pk) WHERE rn = 1""",
    "v_career": "SELECT pk, SUM(goals) AS goals, SUM(assists) AS assists, SUM(minutes) AS minutes FROM v_league GROUP BY pk",
    "v_career_nodes": """
        SELECT g.player_id, g.name AS id, g.name AS label, COALESCE(NULLIF(TRIM(g.position), ''), l.position, '') AS position, g.nationality,
               CAST(0 AS BIGINT) AS market_value, g.photo_url, c.goals, c.assists, c.minutes, 'player' AS node_type
        FROM v_players g JOIN v_career c ON c.pk = g.pk LEFT JOIN v_pos l ON l.player_key = g.pk""",
    "v_season_nodes": """
        SELECT p.player AS id, p.player AS label, COALESCE(NULLIF(TRIM(v.position), ''), NULLIF(TRIM(g.position), ''), l.position, '') AS position,
               COALESCE(v.nationality, v.nationality_full, '') AS nationality, COALESCE(v.nationality, v.nationality_full, g.nationality, '') AS nationality_g,
               COALESCE(v.market_value_eur, 0) AS market_value, COALESCE(g.photo_url, v.photo_url, '') AS photo_url,
               p.goals, p.assists, p.minutes, 'player' AS node_type
        FROM v_league p LEFT JOIN v_squad v ON LOWER(TRIM(v.player)) = p.pk AND v.season = '9697'
        LEFT JOIN v_players g ON g.pk = p.pk LEFT JOIN v_pos l ON l.player_key = p.pk WHERE p.season = '9697'""",
    "v_teammates": """
        SELECT a.name AS source, b.name AS target, e.shared_seasons AS weight, e.combined_goals, e.seasons_list, 'PLAYED_WITH' AS edge_type,
               a.pk AS apk, b.pk AS bpk
        FROM v_played_with e JOIN v_players a ON a.player_id = e.player_id_a JOIN v_players b ON b.player_id = e.player_id_b""",
    "v_season_edges": """
        SELECT source, target, weight, combined_goals, seasons_list, edge_type FROM v_teammates
        WHERE LIST_CONTAINS(STRING_SPLIT(seasons_list, ','), '9697')
          AND apk IN (SELECT pk FROM v_league WHERE season = '9697') AND bpk IN (SELECT pk FROM v_league WHERE season = '9697')""",
    "v_transfer_edges": """
        SELECT g.name AS source, 'club:' || m.club_id AS target, m.club_id, CAST(1 AS BIGINT) AS weight, m.season, m.direction, m.fee_eur, m.fee_text,
               c.name AS target_label, 'TRANSFERRED_TO' AS edge_type
        FROM v_moved m JOIN v_players g ON g.player_id = m.player_id JOIN v_clubs c ON c.club_id = m.club_id""",
    "v_club_nodes": """
        SELECT 'club:' || club_id AS id, name AS label, '' AS position, '' AS nationality, CAST(0 AS BIGINT) AS market_value, '' AS photo_url,
               CAST(NULL AS DOUBLE) AS goals, CAST(NULL AS DOUBLE) AS assists, CAST(NULL AS DOUBLE) AS minutes, 'club' AS node_type
        FROM v_clubs WHERE club_id IN (SELECT club_id FROM v_moved)""",
    "v_season_points": """
        SELECT 'season:' || season_id AS id, label, 'Pts ' || CAST(points AS VARCHAR) || ' · W ' || CAST(wins AS VARCHAR) AS position, '' AS nationality,
               CAST(0 AS BIGINT) AS market_value, '' AS photo_url, CAST(goals_for AS DOUBLE) AS goals, CAST(NULL AS DOUBLE) AS assists,
               CAST(NULL AS DOUBLE) AS minutes, 'season' AS node_type FROM v_seasons""",
    "v_network": """
        SELECT * EXCLUDE (player_id) FROM v_career_nodes WHERE player_id IN (SELECT player_id FROM v_moved)
        UNION ALL SELECT * FROM v_club_nodes UNION ALL SELECT * FROM v_season_points""",
    "v_found": """
        SELECT id FROM v_network WHERE (node_type = 'player' AND LOWER(label) LIKE '%player 7%')
           OR (node_type = 'season' AND (id LIKE '%99/00%' OR label LIKE '%99/00%'))""",
    "v_seen": """
        SELECT id FROM v_found UNION SELECT target FROM v_transfer_edges WHERE source IN (SELECT id FROM v_found)
        UNION SELECT source FROM v_transfer_edges WHERE target IN (SELECT id FROM v_found)""",
    "v_backs": """
        SELECT * EXCLUDE (nationality_g) FROM v_season_nodes
        WHERE TRIM(position) <> '' AND REGEXP_MATCHES(LOWER(position), 'back|defen[cs]e|defender|iv|cb|rb|lb|außenverteidiger|innverteidiger')""",
}


def with_views(sql: str) -> str:
    """The statement with the views it needs, in order."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name in re.findall(r"\bv_\w+", text):
            if name in VIEWS and name not in needed:
                add(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    add(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed) + "\n" + sql
