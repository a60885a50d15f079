"""DuckDB SQL for every registered query: the correctness oracle.

under test.  Team questions stack home and away rows (a match of a team with
itself once) and aggregate with ``FILTER``; names are joined to the aggregated
keys.  ``SUM`` is cast to BIGINT (DuckDB widens it to HUGEINT).
"""

from __future__ import annotations

# Default parameters of the parameterised (dashboard) queries.
TEAM = "NATION_3"
OPPONENT = "NATION_7"
SEASON = "1997-98"
MIN_MATCHES = 30
TOP = 3

# Source column → silver column, in the source's order.
SOURCE_COLUMNS = {
    "Date": "match_date", "Time": "match_time", "HomeTeam": "home_team", "AwayTeam": "away_team",
    "FTHG": "home_goals", "FTAG": "away_goals", "FTR": "result",
    "HTHG": "home_goals_ht", "HTAG": "away_goals_ht", "HTR": "result_ht",
    "HS": "home_shots", "AS": "away_shots", "HST": "home_shots_on_target", "AST": "away_shots_on_target",
    "HF": "home_fouls", "AF": "away_fouls", "HC": "home_corners", "AC": "away_corners",
    "HY": "home_yellow_cards", "AY": "away_yellow_cards", "HR": "home_red_cards", "AR": "away_red_cards",
}
# The declared data tests (table, unique, not null, accepted values).
DECLARED_TESTS = [
    ("fact_matches", ["match_id"], ["match_id", "home_goals", "result"], {"result": ["H", "A", "D"]}),
    ("dim_team", ["team_id", "team_name"], ["team_id", "team_name"], {}),
    ("dim_season", ["season_id"], ["season_id"], {}),
    ("dim_date", ["date_id"], ["date_id"], {}),
]

SILVER_CTE = """
silver AS (
  SELECT
    CAST(sy AS VARCHAR) || '-' || lpad(CAST((sy + 1) % 100 AS VARCHAR), 2, '0') AS season,
    match_date,
    lpad(CAST(l_linenumber + 12 AS VARCHAR), 2, '0') || ':00' AS match_time,
    home_team, away_team,
    hg AS home_goals, ag AS away_goals,
    CASE WHEN hg > ag THEN 'H' WHEN hg < ag THEN 'A' ELSE 'D' END AS result,
    hg // 2 AS home_goals_ht, ag // 2 AS away_goals_ht,
    CASE WHEN hg // 2 > ag // 2 THEN 'H' WHEN hg // 2 < ag // 2 THEN 'A' ELSE 'D' END AS result_ht,
    hg + l_linenumber AS home_shots, ag + l_linenumber AS away_shots,
    hg + disc AS home_shots_on_target, ag + tax AS away_shots_on_target,
    l_linenumber AS home_fouls, CAST(l_partkey % 20 AS INTEGER) AS away_fouls,
    CAST(l_suppkey % 13 AS INTEGER) AS home_corners, CAST(l_partkey % 13 AS INTEGER) AS away_corners,
    disc AS home_yellow_cards, tax AS away_yellow_cards,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS home_red_cards,
    CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS away_red_cards,
    sy
  FROM (
    SELECT l.*, CAST(o.o_orderdate AS DATE) AS match_date,
           sn.n_name AS home_team, cn.n_name AS away_team,
           CAST(round(l.l_quantity) AS INTEGER) AS hg, p.p_size AS ag,
           CAST(round(l.l_discount * 100) AS INTEGER) AS disc,
           CAST(round(l.l_tax * 100) AS INTEGER) AS tax,
           CAST(CASE WHEN month(o.o_orderdate) >= 7 THEN year(o.o_orderdate)
                     ELSE year(o.o_orderdate) - 1 END AS INTEGER) AS sy
    FROM lineitem l
    JOIN orders o    ON l.l_orderkey = o.o_orderkey
    JOIN customer c  ON o.o_custkey = c.c_custkey
    JOIN nation cn   ON c.c_nationkey = cn.n_nationkey
    JOIN supplier s  ON l.l_suppkey = s.s_suppkey
    JOIN nation sn   ON s.s_nationkey = sn.n_nationkey
    JOIN part p      ON l.l_partkey = p.p_partkey))"""

# ── star schema ──────────────────────────────────────────────────────────────
_MEASURES = [c for c in SOURCE_COLUMNS.values() if c not in ("match_date", "match_time", "home_team", "away_team")]
# matches are numbered by date and home team; a digest of all else makes the order total
_REST = ", ".join(f"coalesce({c}::VARCHAR, '~')" for c in ["season_id", "team_id_away", *_MEASURES])
_NUMBERING = ["match_date", "home_team", f"md5(concat_ws('|', {_REST}))"]


def _day_number(day: str) -> str:
    return f"(year({day}) * 10000 + month({day}) * 100 + day({day}))::INTEGER"


_STATS = {"goals": ("home_goals", "away_goals"), "sot": ("home_shots_on_target", "away_shots_on_target"),
          "corners": ("home_corners", "away_corners"), "yellows": ("home_yellow_cards", "away_yellow_cards")}


def _side(own: str, other: str, at_home: str, at_away: str) -> str:
    i = 0 if own == "home" else 1
    stats = ", ".join(f"{pair[i]} AS {name}_for, {pair[1 - i]} AS {name}_against" for name, pair in _STATS.items())
    return (f"SELECT match_id, season_id, date_id, result, team_id_{own} AS team_id, team_id_{other} AS opponent_id, "
            f"{at_home} AS at_home, {at_away} AS at_away, {stats} FROM fact_matches")


STAR_CTES = f""",
dim_season AS (
  SELECT row_number() OVER (ORDER BY season) AS season_id, season AS season_label,
         split_part(season, '-', 1)::INTEGER AS start_year, 2000 + split_part(season, '-', 2)::INTEGER AS end_year
  FROM silver GROUP BY season),
dim_team AS (
  SELECT row_number() OVER (ORDER BY team_name) AS team_id, team_name
  FROM (SELECT unnest([home_team, away_team]) AS team_name FROM silver) GROUP BY team_name),
dim_date AS (
  SELECT {_day_number('match_date')} AS date_id, match_date AS full_date, year(match_date)::INTEGER AS year,
         month(match_date)::INTEGER AS month, day(match_date)::INTEGER AS day,
         weekofyear(match_date)::INTEGER AS week_number, dayname(match_date) AS day_of_week,
         isodow(match_date) >= 6 AS is_weekend
  FROM silver GROUP BY match_date HAVING match_date IS NOT NULL),
fact_matches AS (
  SELECT row_number() OVER (ORDER BY {', '.join(_NUMBERING)}) AS match_id, season_id, team_id_home, team_id_away,
         {_day_number('match_date')} AS date_id, {', '.join(_MEASURES)}
  FROM silver
  JOIN (SELECT season_label AS season, season_id FROM dim_season) USING (season)
  JOIN (SELECT team_name AS home_team, team_id AS team_id_home FROM dim_team) USING (home_team)
  JOIN (SELECT team_name AS away_team, team_id AS team_id_away FROM dim_team) USING (away_team)),
stacked AS (
  {_side('home', 'away', 'TRUE', 'team_id_home = team_id_away')}
  UNION ALL
  {_side('away', 'home', 'FALSE', 'TRUE')} WHERE team_id_home <> team_id_away),
sides AS (
  SELECT *, coalesce((at_home AND result = 'H') OR (at_away AND result = 'A'), FALSE) AS won,
         coalesce(result = 'D', FALSE) AS drawn,
         coalesce((at_home AND result = 'A') OR (at_away AND result = 'H'), FALSE) AS lost
  FROM stacked)
"""

PREFIX = "WITH " + SILVER_CTE.strip() + STAR_CTES


def with_star(body: str) -> str:
    return PREFIX + body


Q: dict[str, str] = {}

# ── bronze / silver ──────────────────────────────────────────────────────────
# The source rendering of the silver rows and the two file generations.
_SOURCE_COLS = ", ".join(
    ["'SP1' AS \"Div\"", "strftime(match_date, '%d/%m/%Y') AS \"Date\""]
    + [f"CAST({silver} AS VARCHAR) AS \"{src}\"" for src, silver in SOURCE_COLUMNS.items()
       if src != "Date"])
_SOURCE_ORDER = ["Div"] + list(SOURCE_COLUMNS)
_OLD = ", ".join(f'"{c}"' for c in _SOURCE_ORDER if c != "Time")
_NEW = ", ".join(f'"{c}"' for c in _SOURCE_ORDER)
BRONZE_CTES = f""",
src AS (
  SELECT {_SOURCE_COLS}, season,
         'LaLiga ' || substr(season, 3, 2) || '-' || right(season, 2) || '.csv' AS _source_file, sy
  FROM silver),
bronze AS (
  SELECT {_OLD}, season, _source_file,
         CAST(CAST("HS" AS INTEGER) + CAST("AS" AS INTEGER) AS VARCHAR) AS "BbMx>2.5"
  FROM src WHERE sy < 1998 OR sy IS NULL
  UNION ALL BY NAME
  SELECT {_NEW}, season, _source_file, "HC" AS "BWH"
  FROM src WHERE sy >= 1998)
"""
BRONZE_PREFIX = "WITH " + SILVER_CTE.strip() + BRONZE_CTES

Q["bronze_union_by_name"] = BRONZE_PREFIX + "SELECT * FROM bronze"
# the season by the file naming rule: '20' before the first year, so 95-96 → 2095-96
_SEASON_RULE = r"regexp_replace(_source_file, '^LaLiga (\d\d)-(\d\d)\.csv$', '20\1-\2')"
# the same rows after a CSV round trip through files, with the season derived again
Q["bronze_csv_landing"] = BRONZE_PREFIX + f"SELECT * REPLACE ({_SEASON_RULE} AS season) FROM bronze"
# files whose later generation ends with a column without a name: it is named by its position
Q["bronze_odd_csv_landing"] = BRONZE_PREFIX + f"""
SELECT * REPLACE ({_SEASON_RULE} AS season), CASE WHEN "BWH" IS NOT NULL THEN "HomeTeam" || ' "at"' || chr(10) || "AwayTeam" END AS column{len(_SOURCE_ORDER) + 1}
FROM bronze"""
_COUNTS = [src for src, silver in SOURCE_COLUMNS.items()
           if silver.startswith(("home_", "away_")) and not silver.endswith("_team")]
_TYPED = "".join(f', "{c}"::BIGINT AS "{c}"' for c in _COUNTS) + "".join(f', "{c}"::DOUBLE AS "{c}"' for c in ("BbMx>2.5", "BWH"))
Q["bronze_typed_landing"] = BRONZE_PREFIX + f"""
SELECT * REPLACE ({_SEASON_RULE} AS season, strptime("Date", '%d/%m/%Y')::DATE AS "Date"{_TYPED}) FROM bronze"""
# what every value of a column can be read as, counting the files that have the column
_TYPE_ROWS = " UNION ALL ".join(f"""
SELECT '{c}' AS "column",
       CASE WHEN bool_and(try_cast("{c}" AS BIGINT) IS NOT NULL) FILTER ("{c}" IS NOT NULL) THEN 'bigint'
            WHEN bool_and(try_strptime("{c}", '%d/%m/%Y') IS NOT NULL) FILTER ("{c}" IS NOT NULL) THEN 'date'
            WHEN bool_and(try_cast("{c}" AS TIME) IS NOT NULL) FILTER ("{c}" IS NOT NULL) THEN 'time'
            ELSE 'text' END AS type,
       count(DISTINCT _source_file) FILTER ("{c}" IS NOT NULL) AS files, 1::BIGINT AS kinds
FROM bronze""" for c in _SOURCE_ORDER + ["BbMx>2.5", "BWH"])
Q["bronze_inferred_types"] = BRONZE_PREFIX + _TYPE_ROWS

Q["season_from_filename"] = BRONZE_PREFIX + f"""
SELECT _source_file, {_SEASON_RULE} AS season, COUNT(*) AS matches FROM bronze GROUP BY _source_file
"""

Q["bronze_projection"] = BRONZE_PREFIX + f"SELECT {_NEW}, season, _source_file FROM bronze"

_TEXT = {"Time", "HomeTeam", "AwayTeam", "FTR", "HTR"}
_SILVER_SELECT = ", ".join(
    ["season", "CAST(strptime(\"Date\", '%d/%m/%Y') AS DATE) AS match_date"]
    + [(f'"{src}" AS {silver}' if src in _TEXT else f'TRY_CAST("{src}" AS INTEGER) AS {silver}')
       for src, silver in SOURCE_COLUMNS.items() if src != "Date"])
Q["silver_matches"] = BRONZE_PREFIX + f"SELECT {_SILVER_SELECT} FROM bronze"
Q["silver_matches_cleaned"] = BRONZE_PREFIX + f"SELECT DISTINCT {_SILVER_SELECT} FROM bronze"

Q["silver_sql_view"] = Q["silver_matches"]

# near-copies: padded names and missing values; one row a match survives, the fullest
_KEY = ["season", "match_date", "match_time", "home_team", "away_team"]
_OTHER = [c for c in SOURCE_COLUMNS.values() if c not in _KEY]
_CODES = {"result": ("home_goals", "away_goals"), "result_ht": ("home_goals_ht", "away_goals_ht")}
_FILLED = "".join(f", coalesce({c}, CASE WHEN {h} > {a} THEN 'H' WHEN {h} < {a} THEN 'A' WHEN {h} = {a} THEN 'D' END) AS {c}"
                  for c, (h, a) in _CODES.items())
_FILLED += "".join(f", coalesce({c}, 0) AS {c}" for c in _OTHER if c.endswith("_cards"))
_KNOWN = " + ".join(f"({c} IS NOT NULL)::INTEGER" for c in _OTHER)
Q["silver_survivors"] = "WITH " + SILVER_CTE.strip() + f""",
loaded AS (SELECT * EXCLUDE (sy) REPLACE (CASE WHEN sy >= 1998 THEN match_time END AS match_time) FROM silver),
delivered AS (
  SELECT * REPLACE (CASE WHEN home_fouls % 5 <> 0 THEN result END AS result,
                                 CASE WHEN home_fouls % 5 <> 0 THEN home_red_cards END AS home_red_cards) FROM loaded
  UNION ALL
  SELECT * REPLACE (NULL AS result, NULL AS home_shots, NULL AS away_yellow_cards) FROM loaded WHERE home_goals % 3 = 0),
survivors AS (
  SELECT * FROM delivered
  QUALIFY row_number() OVER (PARTITION BY {', '.join(_KEY)}
                             ORDER BY {_KNOWN} DESC, {', '.join(f"{c} DESC NULLS LAST" for c in _OTHER)}) = 1)
SELECT {', '.join(c for c in ["season", *SOURCE_COLUMNS.values()] if c not in _CODES and not c.endswith('_cards'))}{_FILLED}
FROM survivors
"""

Q["load_report"] = BRONZE_PREFIX + """
SELECT season, _source_file, COUNT(*) AS matches FROM bronze
GROUP BY season, _source_file ORDER BY season, _source_file
"""

_BRONZE_DATA_COLS = _SOURCE_ORDER + ["BbMx>2.5", "BWH"]


def _nonnull_name(c: str) -> str:
    return "nonnull_" + "".join(ch if ch.isalnum() else "_" for ch in c.lower())


Q["completeness_by_season"] = BRONZE_PREFIX + "SELECT season, COUNT(*) AS total_matches, " + \
    ", ".join(f'COUNT("{c}") AS {_nonnull_name(c)}' for c in _BRONZE_DATA_COLS) + \
    " FROM bronze GROUP BY season ORDER BY season"

Q["sample_rows"] = BRONZE_PREFIX + """
SELECT season, "Date", "HomeTeam", "AwayTeam", "FTHG", "FTAG", "FTR" FROM bronze
ORDER BY season, strptime("Date", '%d/%m/%Y'), "HomeTeam", "AwayTeam", "FTHG", "FTAG", "FTR"
LIMIT 5
"""

# ── gold tables ──────────────────────────────────────────────────────────────
Q["dim_season"] = with_star("SELECT * FROM dim_season")
Q["dim_season_as_written"] = with_star("""
SELECT * REPLACE (2000 + season_label[1:2]::INTEGER AS start_year) FROM dim_season""")
Q["dim_team"] = with_star("SELECT * FROM dim_team")
Q["dim_date"] = with_star("SELECT * FROM dim_date")
Q["fact_matches"] = with_star("SELECT * FROM fact_matches")
Q["role_playing_names"] = with_star("""
SELECT home_team, away_team, home_goals, away_goals FROM fact_matches
JOIN (SELECT team_id AS team_id_home, team_name AS home_team FROM dim_team) USING (team_id_home)
JOIN (SELECT team_id AS team_id_away, team_name AS away_team FROM dim_team) USING (team_id_away)
""")

# ── analytic queries ─────────────────────────────────────────────────────────
_PER_SEASON = """,
per_season AS (
  SELECT season_id, count(*) AS n, sum(home_goals + away_goals)::BIGINT AS goals,
         count(home_goals + away_goals) AS scored, count(*) FILTER (result = 'H') AS home_wins,
         count(*) FILTER (result = 'D') AS draws, count(*) FILTER (result = 'A') AS away_wins,
         sum(home_yellow_cards + away_yellow_cards)::BIGINT AS yellow_cards,
         sum(home_red_cards + away_red_cards)::BIGINT AS red_cards
  FROM fact_matches GROUP BY season_id),
seasons AS (
  SELECT *, round(goals::DOUBLE / nullif(scored, 0), 2) AS mean_goals, round(100::DOUBLE * home_wins / n, 1) AS home_win_pct
  FROM per_season JOIN dim_season USING (season_id))
"""
Q["season_summary"] = PREFIX + _PER_SEASON + """
SELECT season_label, n AS total_matches, goals AS total_goals, mean_goals AS avg_goals_per_match,
       home_wins, draws, away_wins, home_win_pct
FROM seasons ORDER BY season_label
"""

Q["team_performance"] = with_star("""
SELECT team_name, total_matches, wins, draws, losses, goals_scored, goals_conceded,
       goals_scored - goals_conceded AS goal_difference
FROM (SELECT team_id, count(*) AS total_matches, count(*) FILTER (won) AS wins, count(*) FILTER (drawn) AS draws,
             count(*) FILTER (lost) AS losses, sum(goals_for)::BIGINT AS goals_scored,
             sum(goals_against)::BIGINT AS goals_conceded
      FROM sides GROUP BY team_id)
JOIN dim_team USING (team_id)
ORDER BY wins DESC, goal_difference DESC, team_name
""")

Q["home_away_advantage"] = with_star(f"""
SELECT team_name, home_matches, away_matches,
       round(100::DOUBLE * won_at_home / nullif(home_matches, 0), 1) AS home_win_pct,
       round(100::DOUBLE * won_away / nullif(away_matches, 0), 1) AS away_win_pct
FROM (SELECT team_id, count(*) AS played, count(*) FILTER (at_home) AS home_matches,
             count(*) FILTER (at_away) AS away_matches, count(*) FILTER (at_home AND result = 'H') AS won_at_home,
             count(*) FILTER (at_away AND result = 'A') AS won_away
      FROM sides GROUP BY team_id)
JOIN dim_team USING (team_id)
WHERE played >= {MIN_MATCHES}
ORDER BY home_win_pct DESC, team_name
""")

Q["monthly_goals"] = with_star("""
SELECT year, month, sum(n)::BIGINT AS matches_played, sum(goals)::BIGINT AS total_goals,
       round(sum(goals)::DOUBLE / nullif(sum(scored), 0), 2) AS avg_goals_per_match
FROM (SELECT date_id, count(*) AS n, sum(home_goals + away_goals) AS goals, count(home_goals + away_goals) AS scored
      FROM fact_matches GROUP BY date_id)
JOIN dim_date USING (date_id)
GROUP BY year, month ORDER BY year, month
""")

Q["top_team_seasons"] = with_star(f"""
SELECT season_label, team_name, goals_scored, matches, place AS rank_in_season
FROM (SELECT season_id, team_id, sum(goals_for)::BIGINT AS goals_scored, count(*) AS matches,
             rank() OVER (PARTITION BY season_id ORDER BY sum(goals_for) DESC NULLS LAST) AS place
      FROM sides GROUP BY season_id, team_id)
JOIN dim_season USING (season_id) JOIN dim_team USING (team_id)
WHERE place <= {TOP}
ORDER BY season_label, place, team_name
""")

# ── dashboard: league overview ───────────────────────────────────────────────
Q["league_overview"] = PREFIX + _PER_SEASON + """
SELECT season_label, n AS matches, goals AS total_goals, mean_goals AS avg_goals, home_wins, draws, away_wins,
       home_win_pct, yellow_cards, red_cards
FROM seasons ORDER BY season_label
"""
Q["latest_season_kpis"] = PREFIX + _PER_SEASON + """
SELECT season_label, goals AS total_goals, mean_goals AS avg_goals, home_win_pct, red_cards
FROM seasons ORDER BY season_label DESC NULLS FIRST LIMIT 1
"""
Q["result_distribution"] = PREFIX + _PER_SEASON + """
SELECT season_label, unnest(['Home Win', 'Draw', 'Away Win']) AS result,
       unnest([home_wins, draws, away_wins]) AS "count"
FROM seasons
"""


# ── dashboard: team deep-dive ────────────────────────────────────────────────
def _log(season: str | None) -> str:
    only = f"WHERE season_label = '{season}'" if season else ""
    return PREFIX + f""",
log AS (
  SELECT season_label AS season, full_date AS date, if(at_home, 'Home', 'Away') AS venue,
         dim_team.team_name AS opponent, goals_for AS gf, goals_against AS ga,
         CASE WHEN won THEN 'W' WHEN drawn THEN 'D' ELSE 'L' END AS result,
         sot_for AS shots_on_target, yellows_for AS yellows
  FROM sides SEMI JOIN (SELECT team_id FROM dim_team WHERE team_name = '{TEAM}') USING (team_id)
  JOIN dim_team ON dim_team.team_id = opponent_id
  JOIN dim_season USING (season_id) JOIN dim_date USING (date_id) {only})
"""


_RECORD = """count(*) AS matches, count(*) FILTER (result = 'W') AS wins, count(*) FILTER (result = 'D') AS draws,
       count(*) FILTER (result = 'L') AS losses"""

for _suffix, _season in (("", None), ("_season", SEASON)):
    Q["team_match_log" + _suffix] = _log(_season) + "SELECT * FROM log ORDER BY date"
    Q["team_kpis" + _suffix] = _log(_season) + f"""
SELECT {_RECORD}, coalesce(sum(gf), 0)::BIGINT AS gf, (coalesce(sum(gf), 0) - coalesce(sum(ga), 0))::BIGINT AS goal_diff
FROM log
"""
    Q["team_result_breakdown" + _suffix] = _log(_season) + """
SELECT label AS result, count(log.result) AS "count"
FROM (VALUES ('Win', 'W'), ('Draw', 'D'), ('Loss', 'L')) AS labels(label, code) LEFT JOIN log ON log.result = code
GROUP BY label
"""
    Q["team_goals_by_season" + _suffix] = _log(_season) + """
SELECT season, coalesce(sum(gf), 0)::BIGINT AS goals_for, coalesce(sum(ga), 0)::BIGINT AS goals_against
FROM log GROUP BY season HAVING season IS NOT NULL ORDER BY season
"""
    Q["team_venue_split" + _suffix] = _log(_season) + f"""
SELECT *, round_even(wins::DOUBLE / matches * 100 * 10, 0) / 10 AS win_pct
FROM (SELECT venue, {_RECORD}, coalesce(sum(gf), 0)::BIGINT AS goals_for, coalesce(sum(ga), 0)::BIGINT AS goals_against
      FROM log GROUP BY venue)
ORDER BY venue
"""


# ── dashboard: head to head ──────────────────────────────────────────────────
# In the form "as written" the season binds to the meetings that OPPONENT hosts only.
_FORMS = {"": "TRUE", "_season": f"season_label = '{SEASON}'", "_as_written": f"(hosted OR season_label = '{SEASON}')"}


def _avg_stat_rows() -> str:
    rows = []
    for team, side in ((TEAM, "for"), (OPPONENT, "against")):
        rows.append(f"SELECT '{team}' AS team, 'Goals/Match' AS category, "
                    f"CAST(printf('%.2f', coalesce(sum(goals_{side}), 0)::DOUBLE / nullif(count(*), 0)) AS DOUBLE) AS value FROM met")
        rows += [f"SELECT '{team}', '{label}', round_even(avg({stat}_{side}) * 100, 0) / 100 FROM met"
                 for label, stat in (("Shots on Target", "sot"), ("Corners", "corners"), ("Yellow Cards", "yellows"))]
    return "\nUNION ALL ".join(rows)


for _suffix, _kept in _FORMS.items():
    Q["head_to_head" + _suffix] = with_star(f"""
SELECT season_label AS season, full_date AS date, home_team, away_team, home_goals, away_goals, result,
       home_shots_on_target, away_shots_on_target, home_corners, away_corners, home_yellow_cards, away_yellow_cards
FROM (SELECT *, home_team = '{TEAM}' AS hosted FROM fact_matches
      JOIN (SELECT team_id AS team_id_home, team_name AS home_team FROM dim_team) USING (team_id_home)
      JOIN (SELECT team_id AS team_id_away, team_name AS away_team FROM dim_team) USING (team_id_away))
JOIN dim_season USING (season_id) JOIN dim_date USING (date_id)
WHERE list_sort([home_team, away_team]) = list_sort(['{TEAM}', '{OPPONENT}']) AND {_kept}
ORDER BY date
""")
    _met = PREFIX + f""",
met AS (
  SELECT sides.*, at_home AS hosted FROM sides
  JOIN dim_season USING (season_id) SEMI JOIN dim_date USING (date_id)
  WHERE team_id = (SELECT team_id FROM dim_team WHERE team_name = '{TEAM}')
    AND opponent_id = (SELECT team_id FROM dim_team WHERE team_name = '{OPPONENT}') AND {_kept})
"""
    # what is neither won nor drawn counts for the opponent, a missing result too
    Q["head_to_head_summary" + _suffix] = _met + """
SELECT count(*) AS meetings, count(*) FILTER (won) AS wins_a, count(*) FILTER (drawn AND NOT won) AS draws,
       count(*) FILTER (NOT won AND NOT drawn) AS wins_b, coalesce(sum(goals_for), 0)::BIGINT AS goals_a,
       coalesce(sum(goals_against), 0)::BIGINT AS goals_b
FROM met
"""
    Q["head_to_head_win_share" + _suffix] = _met + f"""
SELECT unnest(['{TEAM}', 'Draw', '{OPPONENT}']) AS team,
       unnest([count(*) FILTER (won), count(*) FILTER (drawn AND NOT won), count(*) FILTER (NOT won AND NOT drawn)]) AS "count"
FROM met
"""
    Q["head_to_head_avg_stats" + _suffix] = _met + _avg_stat_rows()

Q["pick_list_teams"] = with_star("SELECT team_name FROM dim_team ORDER BY team_name")
Q["pick_list_seasons"] = with_star("SELECT season_label FROM dim_season ORDER BY season_label")

# ── data quality ─────────────────────────────────────────────────────────────
Q["row_count_integrity"] = "WITH " + SILVER_CTE.strip() + BRONZE_CTES + STAR_CTES + """
SELECT bronze_rows, gold_rows, bronze_rows - gold_rows AS difference
FROM (SELECT (SELECT count(*) FROM bronze) AS bronze_rows, (SELECT count(*) FROM fact_matches) AS gold_rows)
"""


# the two sides' rows of a group as sorted lists: the same rows, as often
_ROW = "concat_ws('|', " + ", ".join(f"coalesce(\"{c}\", '~')" for c in SOURCE_COLUMNS) + ")"
for _name, _lost in (("", "FALSE"), ("_lossy", "TRUE")):
    Q["integrity_by_source" + _name] = BRONZE_PREFIX + f""",
kept AS (
  SELECT * FROM bronze
  WHERE NOT ({_lost} AND season = '{SEASON}' AND "HomeTeam" = '{TEAM}' AND "AwayTeam" = '{OPPONENT}')
  UNION ALL
  SELECT * FROM bronze WHERE {_lost} AND "HomeTeam" = '{OPPONENT}' AND "AwayTeam" = '{TEAM}'),
b AS (SELECT season, _source_file, count(*) AS n, list_sort(list({_ROW})) AS r FROM bronze GROUP BY ALL),
s AS (SELECT season, _source_file, count(*) AS n, list_sort(list({_ROW})) AS r FROM kept GROUP BY ALL)
SELECT season, _source_file, coalesce(b.n, 0) AS bronze_rows, coalesce(s.n, 0) AS silver_rows,
       coalesce(b.n, 0) - coalesce(s.n, 0) AS difference, coalesce(b.r = s.r, FALSE) AS same_rows
FROM b FULL JOIN s USING (season, _source_file)
"""
Q["integrity_gold"] = with_star(f""",
told AS (
  SELECT season_label AS season, full_date AS match_date, home_team, away_team, {', '.join(_MEASURES)}
  FROM fact_matches JOIN dim_season USING (season_id) LEFT JOIN dim_date USING (date_id)
  JOIN (SELECT team_id AS team_id_home, team_name AS home_team FROM dim_team) USING (team_id_home)
  JOIN (SELECT team_id AS team_id_away, team_name AS away_team FROM dim_team) USING (team_id_away)),
s AS (SELECT season, count(*) AS n, list_sort(list(concat_ws('|', match_date, home_team, away_team, {', '.join(_MEASURES)}))) AS r FROM silver GROUP BY season),
g AS (SELECT season, count(*) AS n, list_sort(list(concat_ws('|', match_date, home_team, away_team, {', '.join(_MEASURES)}))) AS r FROM told GROUP BY season)
SELECT season, coalesce(s.n, 0) AS silver_rows, coalesce(g.n, 0) AS gold_rows, coalesce(s.n, 0) - coalesce(g.n, 0) AS difference,
       coalesce(s.r = g.r, FALSE) AS same_rows
FROM s FULL JOIN g USING (season)
""")
for _name, _team, _season in (("", "TRUE", "TRUE"), ("_dirty", f"team_name <> '{TEAM}'", f"season_label <> '{SEASON}'")):
    Q["dq_relationships" + _name] = with_star(" UNION ALL ".join(f"""
SELECT 'fact_matches' AS table_name, '{fk}' AS column_name, 'relationships' AS test_name,
       count(*) FILTER ({fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {parent} WHERE {kept})) AS failures
FROM fact_matches""" for fk, parent, pk, kept in (("season_id", "dim_season", "season_id", _season), ("team_id_home", "dim_team", "team_id", _team),
                                                   ("team_id_away", "dim_team", "team_id", _team), ("date_id", "dim_date", "date_id", "TRUE"))))


def _dq_rows(kinds, fact_table: str = "fact_matches") -> str:
    rows = []
    for table, uniq, not_null, accepted in DECLARED_TESTS:
        src = fact_table if table == "fact_matches" else table
        if "unique" in kinds:
            rows += [f"SELECT '{table}' AS table_name, '{c}' AS column_name, 'unique' AS test_name, "
                     f"(SELECT COUNT(*) FROM (SELECT {c} FROM {src} WHERE {c} IS NOT NULL "
                     f"GROUP BY {c} HAVING COUNT(*) > 1)) AS failures" for c in uniq]
        if "not_null" in kinds:
            rows += [f"SELECT '{table}', '{c}', 'not_null', "
                     f"(SELECT COUNT(*) FROM {src} WHERE {c} IS NULL)" for c in not_null]
        if "accepted_values" in kinds:
            for c, values in accepted.items():
                vals = ", ".join(f"'{v}'" for v in values)
                rows.append(f"SELECT '{table}', '{c}', 'accepted_values', "
                            f"(SELECT COUNT(*) FROM (SELECT {c} AS v FROM {src} GROUP BY {c}) "
                            f"WHERE v NOT IN ({vals}))")
    # the first SELECT names the columns; the rest follow by position
    first, *rest = rows
    if not first.startswith("SELECT '") or " AS table_name" not in first:
        t, c, k, f = first.split(", ", 3)
        first = f"{t} AS table_name, {c} AS column_name, {k} AS test_name, {f} AS failures"
    return "\nUNION ALL ".join([first, *rest])


_ALL = ("unique", "not_null", "accepted_values")
Q["dq_unique"] = with_star(_dq_rows(("unique",)))
Q["dq_not_null"] = with_star(_dq_rows(("not_null",)))
Q["dq_accepted_values"] = with_star(_dq_rows(("accepted_values",)))
Q["dq_report"] = with_star(_dq_rows(_ALL))
Q["dq_report_dirty"] = PREFIX + """,
dirty_fact AS (
    SELECT * FROM fact_matches
    UNION ALL BY NAME
    SELECT * REPLACE ('X' AS result, CAST(NULL AS INTEGER) AS home_goals)
    FROM fact_matches WHERE result = 'D')
""" + _dq_rows(_ALL, "dirty_fact")
