"""DuckDB SQL for every registered query (the correctness oracle).

The CTEs below restate the test bed of ``testbed.py`` in plain SQL so the oracle
never calls the library. Doubles are rounded the same way on both sides
(``round(x * 10^d, 0) / 10^d``) and sums run over scaled integers, so results do not
depend on the order of addition.
"""

from __future__ import annotations

ENTRIES = """
entries AS (
  SELECT o_orderkey AS entry_id,
         CAST(year(o_orderdate) AS BIGINT) AS event,
         c_mktsegment AS division,
         'C' AS first_name,
         CAST(c_custkey AS VARCHAR) AS last_name,
         c_custkey AS racer_key,
         CAST(CASE WHEN c_custkey % 11 = 0 THEN NULL
                   ELSE 18 + c_custkey % 60 + year(o_orderdate) % 3 END AS INTEGER) AS age,
         CASE WHEN o_orderpriority < '4' THEN 'main' ELSE 'participation' END AS race_role,
         o_totalprice AS score
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

RESULTS = ENTRIES + """,
main_best AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event, racer_key ORDER BY score DESC, entry_id) AS rn
    FROM entries WHERE race_role = 'main') WHERE rn = 1
),
main_placed AS (
  SELECT *, row_number() OVER (PARTITION BY event, division ORDER BY score DESC, entry_id) AS division_place
  FROM main_best
),
part_one AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event, first_name, last_name ORDER BY entry_id) AS rn
    FROM entries WHERE race_role = 'participation') WHERE rn = 1
),
part_kept AS (
  SELECT p.* FROM part_one p
  WHERE NOT EXISTS (SELECT 1 FROM entries m
                    WHERE m.race_role = 'main' AND m.event = p.event
                      AND m.first_name = p.first_name AND m.last_name = p.last_name)
),
results AS (
  SELECT event, division, first_name, last_name, racer_key, age,
         CAST(division_place AS BIGINT) AS division_place, race_role, entry_id, score
  FROM main_placed
  UNION ALL
  SELECT event, division, first_name, last_name, racer_key, age,
         CAST(NULL AS BIGINT) AS division_place, race_role, entry_id, score
  FROM part_kept
)"""



def scoring_ctes(src: str, out: str, sizes: str) -> str:
    """E1-E7 over the results CTE ``src``: CTEs ``<sizes>`` and ``<out>`` (steps kept)."""
    return f""",
{sizes} AS (
  SELECT event, division, CAST(max(division_place) AS BIGINT) AS max_place
  FROM {src} WHERE race_role = 'main' GROUP BY event, division
),
{out}_steps AS (
  SELECT r.*, s.max_place,
         (1 - (r.division_place - 1) / s.max_place) * 100 AS placement
  FROM {src} r LEFT JOIN {sizes} s ON r.event = s.event AND r.division = s.division
),
{out}_steps2 AS (
  SELECT *,
         CASE WHEN placement >= 20.0 THEN placement ELSE CAST(20.0 AS DOUBLE) END AS floored,
         CASE WHEN age > 45 THEN CAST(age - 45 AS DOUBLE) * CAST(1.0 AS DOUBLE)
              ELSE CAST(0.0 AS DOUBLE) END AS bonus
  FROM {out}_steps
),
{out} AS (
  SELECT event, division, first_name, last_name, racer_key,
         CASE WHEN race_role = 'participation' THEN NULL ELSE age END AS age,
         division_place, race_role, entry_id,
         round((CASE WHEN race_role = 'participation' THEN CAST(20.0 AS DOUBLE)
                     WHEN floored + bonus > 100.0 THEN CAST(100.0 AS DOUBLE)
                     ELSE floored + bonus END) * 1e6, 0) / 1e6 AS points,
         placement, floored, bonus
  FROM {out}_steps2
)"""


# E1-E7 on ``results``: one row per result with the intermediate steps kept.
POINTS = RESULTS + scoring_ctes("results", "points", "sizes")

# Every order as one race day (no reduction), scored the same way.
DAYS = ENTRIES + """,
days_res AS (
  SELECT event, division, first_name, last_name, racer_key, age,
         CAST(row_number() OVER (PARTITION BY event, division ORDER BY score DESC, entry_id) AS BIGINT)
           AS division_place,
         race_role, entry_id, score
  FROM entries WHERE race_role = 'main'
  UNION ALL
  SELECT event, division, first_name, last_name, racer_key, age, CAST(NULL AS BIGINT), race_role, entry_id, score
  FROM entries WHERE race_role = 'participation'
)""" + scoring_ctes("days_res", "day_points", "day_sizes")


def with_ctes(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body.strip()


SQL: dict[str, str] = {}

SQL["event_points"] = with_ctes(POINTS, """
SELECT event, division, first_name, last_name, age, division_place, race_role, points
FROM points
""")

SQL["field_size"] = with_ctes(RESULTS, """
SELECT event, division, CAST(max(division_place) AS BIGINT) AS max_place
FROM results WHERE race_role = 'main' GROUP BY event, division
""")

SQL["placement_points"] = with_ctes(POINTS, """
SELECT event, division, first_name, last_name, division_place, max_place,
       round(placement * 1e4, 0) / 1e4 AS placement,
       round(floored * 1e4, 0) / 1e4 AS floored
FROM points JOIN sizes USING (event, division)
WHERE race_role = 'main'
""")

SQL["age_bonus"] = with_ctes(POINTS, """
SELECT event, division, first_name, last_name, age, round(bonus * 1e4, 0) / 1e4 AS bonus
FROM points WHERE race_role = 'main'
""")

SQL["participation_points"] = with_ctes(POINTS, """
SELECT event, division, first_name, last_name, points
FROM points WHERE race_role = 'participation'
""")

# --- season ---------------------------------------------------------------
SEASON = POINTS + """,
ranked_pts AS (
  SELECT *, row_number() OVER (PARTITION BY division, first_name, last_name ORDER BY points DESC) AS k
  FROM points
),
season0 AS (
  SELECT division, first_name, last_name,
         count(points) AS n_events,
         CAST(sum(CAST(round(points * 1e6, 0) AS BIGINT)) AS DOUBLE) / 1e6 AS all_points,
         CAST(sum(CAST(round(points * 1e6, 0) AS BIGINT)) FILTER (WHERE k <= 6) AS DOUBLE) / 1e6 AS best_points,
         max(points) FILTER (WHERE event = 1995) AS e1995_points,
         max(points) FILTER (WHERE event = 1996) AS e1996_points,
         max(points) FILTER (WHERE event = 1997) AS e1997_points,
         max(points) FILTER (WHERE event = 1998) AS e1998_points,
         max(points) FILTER (WHERE event = 1999) AS e1999_points,
         max(points) FILTER (WHERE event = 2000) AS e2000_points,
         max(points) FILTER (WHERE event = 2001) AS e2001_points
  FROM ranked_pts GROUP BY division, first_name, last_name
),
season1 AS (
  SELECT *,
         CAST(0.0 AS DOUBLE)
           + CASE WHEN n_events >= 3 THEN CAST(15.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END
           + CASE WHEN n_events >= 6 THEN CAST(20.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END
           + CASE WHEN n_events >= 9 THEN CAST(25.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS incentive
  FROM season0
),
adj AS (
  SELECT 'C' AS first_name, CAST(c_custkey AS VARCHAR) AS last_name, sum(CAST(-10.0 AS DOUBLE)) AS adjustment
  FROM customer WHERE c_acctbal < 0 GROUP BY 1, 2
),
season AS (
  SELECT s.*, coalesce(a.adjustment, CAST(0.0 AS DOUBLE)) AS adjustment,
         best_points + incentive + coalesce(a.adjustment, CAST(0.0 AS DOUBLE)) AS series_points
  FROM season1 s LEFT JOIN adj a ON s.first_name = a.first_name AND s.last_name = a.last_name
),
standings AS (
  SELECT division,
         CAST(row_number() OVER (PARTITION BY division
                                 ORDER BY series_points DESC, first_name DESC, last_name DESC) AS BIGINT) AS overall_place,
         first_name || ' ' || last_name AS name, first_name, last_name, n_events,
         round(series_points * 100, 0) / 100 AS series_points,
         coalesce(round(e1995_points * 100, 0) / 100, 0.0) AS e1995_points,
         coalesce(round(e1996_points * 100, 0) / 100, 0.0) AS e1996_points,
         coalesce(round(e1997_points * 100, 0) / 100, 0.0) AS e1997_points,
         coalesce(round(e1998_points * 100, 0) / 100, 0.0) AS e1998_points,
         coalesce(round(e1999_points * 100, 0) / 100, 0.0) AS e1999_points,
         coalesce(round(e2000_points * 100, 0) / 100, 0.0) AS e2000_points,
         coalesce(round(e2001_points * 100, 0) / 100, 0.0) AS e2001_points
  FROM season
)"""

SQL["season_points"] = with_ctes(SEASON, """
SELECT division, first_name, last_name, n_events, all_points FROM season
""")

SQL["best_six"] = with_ctes(SEASON, """
SELECT division, first_name, last_name, best_points FROM season
""")

SQL["incentives"] = with_ctes(SEASON, """
SELECT division, first_name, last_name, n_events, incentive FROM season
""")

SQL["adjustments"] = with_ctes(SEASON, """
SELECT division, first_name, last_name, adjustment, series_points FROM season
""")

SQL["standings_wide"] = with_ctes(SEASON, "SELECT * FROM standings")

# --- teams ----------------------------------------------------------------
TEAMS = SEASON + """,
reg AS (
  SELECT n_name || ' #' || CAST((rn - 1) // 10 + 1 AS VARCHAR) AS team_name,
         CAST((rn - 1) % 10 + 1 AS INTEGER) AS slot,
         'C ' || CAST(c_custkey AS VARCHAR) AS raw_name, c_mktsegment AS raw_division
  FROM (SELECT c_custkey, c_mktsegment, n_name,
               row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn
        FROM customer JOIN nation ON c_nationkey = n_nationkey)
),
membership AS (
  SELECT team_name, slot, trim(raw_division) AS division,
         split_part(trim(raw_name), ' ', 1) AS first_name,
         regexp_replace(trim(raw_name), '^[^ ]* ?', '') AS last_name
  FROM reg
),
team_rows AS (
  SELECT p.event, p.division, p.first_name, p.last_name, p.points, m.team_name
  FROM points p JOIN membership m
    ON p.division = m.division AND p.first_name = m.first_name AND p.last_name = m.last_name
  WHERE p.points IS NOT NULL
),
team_ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY team_name, event, division
                                    ORDER BY CAST(round(points * 1e6, 0) AS BIGINT) DESC,
                                             last_name, first_name) AS BIGINT) AS team_rank
  FROM team_rows
),
team_event AS (
  SELECT team_name, event,
         CAST(sum(CAST(round(points * 1e6, 0) AS BIGINT)) AS DOUBLE) / 1e6 AS team_points
  FROM team_ranked WHERE team_rank <= 3 GROUP BY team_name, event
),
team_totals AS (
  SELECT team_name,
         CAST(sum(CAST(round(team_points * 1e6, 0) AS BIGINT)) AS DOUBLE) / 1e6 AS total_points,
         coalesce(max(team_points) FILTER (WHERE event = 1995), 0.0) AS e1995_points,
         coalesce(max(team_points) FILTER (WHERE event = 1996), 0.0) AS e1996_points,
         coalesce(max(team_points) FILTER (WHERE event = 1997), 0.0) AS e1997_points,
         coalesce(max(team_points) FILTER (WHERE event = 1998), 0.0) AS e1998_points,
         coalesce(max(team_points) FILTER (WHERE event = 1999), 0.0) AS e1999_points,
         coalesce(max(team_points) FILTER (WHERE event = 2000), 0.0) AS e2000_points,
         coalesce(max(team_points) FILTER (WHERE event = 2001), 0.0) AS e2001_points
  FROM team_event GROUP BY team_name
)"""

SQL["membership_unpivot"] = with_ctes(TEAMS, """
SELECT team_name, slot, division, first_name, last_name FROM membership
""")

SQL["membership_guard"] = with_ctes(TEAMS, """
SELECT 'team' AS kind, team_name AS key, count(*) AS n_rows
FROM (SELECT DISTINCT team_name FROM reg) GROUP BY team_name HAVING count(*) > 1
UNION ALL
SELECT 'racer' AS kind, first_name || ' ' || last_name AS key, count(*) AS n_rows
FROM membership GROUP BY first_name, last_name HAVING count(*) > 1
UNION ALL
SELECT 'division' AS kind, team_name || ' / ' || first_name AS key, count(*) AS n_rows
FROM membership WHERE division IS NULL GROUP BY 2
UNION ALL
SELECT 'name' AS kind, team_name || ' / ' || first_name AS key, count(*) AS n_rows
FROM membership WHERE last_name = '' GROUP BY 2
""")

SQL["team_join"] = with_ctes(TEAMS, """
SELECT team_name, event, division, first_name, last_name, points FROM team_rows
""")

SQL["team_top3"] = with_ctes(TEAMS, """
SELECT team_name, event, division, first_name, last_name, team_rank, points
FROM team_ranked WHERE team_rank <= 3
""")

SQL["team_event_points"] = with_ctes(TEAMS, "SELECT team_name, event, team_points FROM team_event")

SQL["team_standings"] = with_ctes(TEAMS, """
SELECT CAST(row_number() OVER (ORDER BY total_points DESC, team_name) AS BIGINT) AS overall_place,
       team_name, round(total_points * 100, 0) / 100 AS total_points,
       round(e1995_points * 100, 0) / 100 AS e1995_points,
       round(e1996_points * 100, 0) / 100 AS e1996_points,
       round(e1997_points * 100, 0) / 100 AS e1997_points,
       round(e1998_points * 100, 0) / 100 AS e1998_points,
       round(e1999_points * 100, 0) / 100 AS e1999_points,
       round(e2000_points * 100, 0) / 100 AS e2000_points,
       round(e2001_points * 100, 0) / 100 AS e2001_points
FROM team_totals
""")

SQL["team_report"] = with_ctes(TEAMS, """
SELECT team_name, event, division, first_name, last_name, team_rank,
       round(points * 100, 0) / 100 AS event_points,
       CASE WHEN team_rank <= 3 THEN 'Yes' ELSE 'No' END AS is_scoring
FROM team_ranked
""")

# --- age groups -------------------------------------------------------------
AGES = TEAMS + """,
ages AS (
  SELECT division, first_name || ' ' || last_name AS name, CAST(age AS BIGINT) AS age
  FROM points WHERE age IS NOT NULL
),
modal AS (
  SELECT division, name, age FROM (
    SELECT division, name, age,
           row_number() OVER (PARTITION BY division, name ORDER BY count(*) DESC, age ASC) AS k
    FROM ages GROUP BY division, name, age) WHERE k = 1
),
bands AS (
  SELECT lower, upper, CAST(lower AS VARCHAR) || '-' || CAST(upper AS VARCHAR) AS age_group
  FROM (VALUES (0, 30), (31, 35), (36, 40), (41, 45), (46, 50),
               (51, 55), (56, 60), (61, 65), (66, 70), (71, 123)) t(lower, upper)
),
banded AS (
  SELECT s.division, s.name, s.overall_place, m.age, b.age_group
  FROM standings s JOIN modal m ON s.division = m.division AND s.name = m.name
  JOIN bands b ON m.age >= b.lower AND m.age <= b.upper
  WHERE s.overall_place > 3
)"""

SQL["age_mode"] = with_ctes(AGES, "SELECT division, name, age FROM modal")

SQL["band_join"] = with_ctes(AGES, """
SELECT m.division, m.name, m.age, b.age_group
FROM modal m JOIN bands b ON m.age >= b.lower AND m.age <= b.upper
""")

SQL["age_group_winners"] = with_ctes(AGES, """
SELECT division, age_group, name, overall_place FROM (
  SELECT *, row_number() OVER (PARTITION BY division, age_group ORDER BY overall_place, name) AS k
  FROM banded) WHERE k = 1
""")

# --- consolidation and guards ----------------------------------------------
SQL["consolidate_best"] = with_ctes(DAYS, """
SELECT event, division, first_name, last_name, race_role, division_place, age, points FROM (
  SELECT *, row_number() OVER (
           PARTITION BY event, division, first_name, last_name
           ORDER BY points DESC, CASE WHEN race_role = 'participation' THEN 1 ELSE 0 END DESC,
                    division_place ASC NULLS LAST) AS k
  FROM day_points) WHERE k = 1
""")

SQL["repeat_guard"] = with_ctes(DAYS, """
SELECT event, division, first_name, last_name, count(*) AS n_rows
FROM day_points GROUP BY event, division, first_name, last_name HAVING count(*) > 2
""")

SQL["unique_guard"] = with_ctes(DAYS, """
SELECT event, division, first_name, last_name, count(*) AS n_rows
FROM day_points GROUP BY event, division, first_name, last_name HAVING count(*) > 1
""")

SQL["dedupe_anti"] = with_ctes(RESULTS, """
SELECT event, division, first_name, last_name, entry_id FROM part_kept
""")

# --- ranking ------------------------------------------------------------------
SQL["place_ordinal"] = """
SELECT o_orderkey, o_orderstatus,
       CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS place
FROM orders
"""

SQL["place_dense"] = """
SELECT event_id, event_type, value,
       CAST(dense_rank() OVER (PARTITION BY event_type ORDER BY value) AS BIGINT) AS place
FROM events
"""

SQL["distributed_rank"] = """
SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS place
FROM orders
"""

# --- quality, lookup, relay ---------------------------------------------------
SQL["alias_report"] = with_ctes(POINTS, """
SELECT p.event, p.division, p.first_name, p.last_name, 'S' AS actual_fn, s.s_name AS actual_ln,
       p.division_place, p.age
FROM points p JOIN supplier s ON p.first_name = 'C' AND p.last_name = CAST(s.s_suppkey AS VARCHAR)
""")

SQL["lookup_join"] = """
SELECT c_custkey, r_name AS division
FROM customer LEFT JOIN (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) lk
  ON c_nationkey = lk.n_nationkey
"""

SQL["relay_stretch"] = """
WITH teams AS (
  SELECT l_orderkey, l_linenumber,
         'P' || CAST(l_partkey AS VARCHAR) || ' &' AS name_1,
         'S' || CAST(l_suppkey AS VARCHAR) AS name_2,
         CASE l_returnflag WHEN 'A' THEN 'Male' WHEN 'N' THEN 'Female' ELSE 'Mixed' END AS class,
         l_extendedprice AS time_s
  FROM lineitem
),
members AS (
  SELECT l_orderkey, l_linenumber, 1 AS member_no, trim(rtrim(trim(name_1), '&')) AS member_name, class, time_s
  FROM teams
  UNION ALL
  SELECT l_orderkey, l_linenumber, 2 AS member_no, trim(rtrim(trim(name_2), '&')) AS member_name, class, time_s
  FROM teams
),
lookup AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS name, 'female' AS division FROM part
  UNION ALL
  SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS name, 'male' AS division FROM supplier
)
SELECT m.l_orderkey, m.l_linenumber, m.member_no, m.member_name, m.class,
       CASE m.class WHEN 'Male' THEN 'male' WHEN 'Female' THEN 'female' ELSE lk.division END AS division,
       m.time_s
FROM members m LEFT JOIN lookup lk ON m.member_name = lk.name
"""

SQL["patch_rows"] = """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN '4-NOT SPECIFIED'
            ELSE o_orderpriority END AS o_orderpriority
FROM orders
"""

SQL["race_role"] = """
SELECT o_orderkey,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'main' ELSE 'participation' END
         AS race_role
FROM orders
"""

SQL["union_races"] = """
SELECT o_orderstatus AS race, o_orderkey, o_custkey,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')
"""

SQL["drop_status"] = """
SELECT o_orderkey, CAST(o_orderkey AS BIGINT) AS place FROM orders WHERE o_orderstatus <> 'P'
"""

SQL["clean_rows"] = """
SELECT event_id AS row_id,
       TRY_CAST(trim(regexp_extract(props, ':\\s*(\\d+)', 1)) AS BIGINT) AS place,
       event_type AS name
FROM events
WHERE event_type <> 'error'
  AND TRY_CAST(trim(regexp_extract(props, ':\\s*(\\d+)', 1)) AS BIGINT) IS NOT NULL
"""


# --- names ---------------------------------------------------------------------

def initcap(x: str) -> str:
    """Upper-case the first letter of each space-separated word, lower-case the rest."""
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda w: upper(w[1]) || lower(w[2:])), ' ')")


def capitalize_parts(x: str) -> str:
    padded = f"replace(replace(trim({x}), '-', ' - '), '''', ' '' ')"
    collapsed = f"trim(regexp_replace({padded}, '\\s+', ' ', 'g'))"
    return f"replace(replace({initcap(collapsed)}, ' - ', '-'), ' '' ', '''')"


PART = f"""
part_text AS (
  SELECT p_partkey, p_name, p_type, p_brand, p_size, {initcap('p_name')} AS given FROM part
)"""

SQL["name_first_rest"] = with_ctes(PART, """
SELECT p_partkey, split_part(trim(t), ' ', 1) AS first_name, regexp_replace(trim(t), '^[^ ]* ?', '') AS last_name
FROM (SELECT p_partkey, given || ' ' || upper(p_type) AS t FROM part_text)
""")

SQL["name_first_last"] = with_ctes(PART, """
SELECT p_partkey, string_split(t, ' ')[1] AS first_name, string_split(t, ' ')[-1] AS last_name
FROM (SELECT p_partkey, given || ' ' || upper(p_type) AS t FROM part_text)
""")

SQL["name_comma"] = with_ctes(PART, """
SELECT p_partkey,
       CASE WHEN s = '' THEN ''
            WHEN instr(s, ',') > 0 THEN regexp_extract(trim(regexp_replace(s, '^[^,]*,', '')), '^([^ \\t]+)', 1)
            ELSE string_split(regexp_replace(s, '[ \\t]+', ' ', 'g'), ' ')[1] END AS first_name,
       CASE WHEN s = '' THEN ''
            WHEN instr(s, ',') > 0 THEN trim(split_part(s, ',', 1))
            WHEN len(string_split(regexp_replace(s, '[ \\t]+', ' ', 'g'), ' ')) = 1 THEN ''
            ELSE array_to_string(string_split(regexp_replace(s, '[ \\t]+', ' ', 'g'), ' ')[2:], ' ') END
         AS last_name
FROM (SELECT p_partkey,
             trim(coalesce(CASE WHEN p_size > 25 THEN upper(p_type) || ', ' || given ELSE given END, '')) AS s
      FROM part_text)
""")

CAPS = r"^(([A-Z][a-z]+( |-))+)([A-Z \-']+)$".replace("'", "''")

SQL["name_caps"] = with_ctes(PART, f"""
SELECT p_partkey,
       CASE WHEN regexp_matches(t, '{CAPS}') THEN trim(regexp_extract(t, '{CAPS}', 1)) END AS first_name,
       CASE WHEN regexp_matches(t, '{CAPS}')
            THEN {capitalize_parts(f"regexp_extract(t, '{CAPS}', 4)")} END AS last_name,
       regexp_matches(t, '{CAPS}') AS matched
FROM (SELECT p_partkey,
             given || ' ' || CASE WHEN p_size > 40 THEN upper(p_brand) ELSE upper(p_type) END AS t
      FROM part_text)
""")

TITLES = "mr|mrs|ms|miss|dr|prof|rev|sir"
SUFFIXES = "jr|sr|ii|iii|iv|phd|md|esq"

SQL["name_human"] = with_ctes(PART, f"""
SELECT p_partkey, string_split(s, ' ')[1] AS first_name, string_split(s, ' ')[-1] AS last_name
FROM (
  SELECT p_partkey,
         trim(regexp_replace(regexp_replace(regexp_replace(trim(t), '\\s+', ' ', 'g'),
                                            '(?i)^(({TITLES})\\.? )+', ''),
                             '(?i)(,? ({SUFFIXES})\\.?)+$', '')) AS s
  FROM (SELECT p_partkey,
               CASE WHEN p_size > 40 THEN 'Dr. ' ELSE '' END || given
               || CASE WHEN p_size < 10 THEN ' Jr.' ELSE '' END AS t
        FROM part_text))
""")

SQL["name_capitalize"] = with_ctes(PART, f"""
SELECT p_partkey, {capitalize_parts("replace(p_name, ' ', '-') || ' o''' || lower(p_type)")} AS name
FROM part_text
""")

SQL["full_name"] = "SELECT p_partkey, p_brand || ' ' || p_type AS name FROM part"

# --- parsing -------------------------------------------------------------------

SQL["division_norm"] = """
SELECT c_custkey,
       CASE WHEN lower(trim(c_mktsegment)) LIKE 'm%' THEN 'male'
            WHEN lower(trim(c_mktsegment)) LIKE 'f%' THEN 'female'
            WHEN lower(trim(c_mktsegment)) LIKE 'n%' THEN 'nb' END AS div_prefix,
       CASE substr(c_mktsegment, 1, 1) WHEN 'M' THEN 'male' WHEN 'F' THEN 'female' END AS div_strict,
       CASE WHEN substr(c_mktsegment, 1, 1) = 'M' THEN 'male' ELSE 'female' END AS div_m_else_f,
       CASE upper(trim(lower(substr(c_mktsegment, 1, 1)))) WHEN 'M' THEN 'male' WHEN 'F' THEN 'female'
            ELSE upper(trim(lower(substr(c_mktsegment, 1, 1)))) END AS div_upper
FROM customer
"""

LABELS = """
labels AS (
  SELECT c_custkey,
         CASE c_mktsegment
           WHEN 'AUTOMOBILE' THEN l || CAST(lo AS VARCHAR) || '-' || CAST(lo + 5 AS VARCHAR)
                                  || ' (' || CAST(c_nationkey AS VARCHAR) || ')'
           WHEN 'BUILDING' THEN l || ' ' || CAST(lo AS VARCHAR) || ' to ' || CAST(lo + 4 AS VARCHAR) || ' (2)'
           WHEN 'FURNITURE' THEN CASE l WHEN 'M' THEN 'Male' ELSE 'Female' END
                                  || ' (' || CAST(c_nationkey AS VARCHAR) || ')'
           WHEN 'HOUSEHOLD' THEN CASE WHEN l = 'M' THEN l || CAST(lo AS VARCHAR) || '+'
                                      ELSE l || '  ' || CAST(lo AS VARCHAR) END
           ELSE l || CAST(lo - 6 AS VARCHAR) || '-' || CAST(lo - 4 AS VARCHAR) END AS label
  FROM (SELECT c_custkey, c_nationkey, c_mktsegment, 18 + c_custkey % 60 AS lo,
               CASE WHEN c_nationkey < 12 THEN 'M' ELSE 'F' END AS l FROM customer)
),
dash AS (
  SELECT *,
         CASE WHEN contains(label, '70+') THEN 70 WHEN contains(label, '75+') THEN 75
              WHEN contains(label, '12-') THEN 12 WHEN contains(label, '19-') THEN 19
              WHEN contains(label, '16-') THEN 16 END AS open_age,
         regexp_matches(label, '^([MF])([0-9]{1,3})-([0-9]{1,3})') AS closed,
         TRY_CAST(regexp_extract(label, '^([MF])([0-9]{1,3})-([0-9]{1,3})', 2) AS INTEGER)
           + TRY_CAST(regexp_extract(label, '^([MF])([0-9]{1,3})-([0-9]{1,3})', 3) AS INTEGER) AS s2,
         regexp_extract(label, '^([MF])([0-9]{1,3})-([0-9]{1,3})', 1) AS letter,
         regexp_matches(label, '^([MF]) ?([0-9]{1,3}) to ([0-9]{1,3}) \\(.+\\)') AS words,
         TRY_CAST(regexp_extract(label, '^([MF]) ?([0-9]{1,3}) to ([0-9]{1,3}) \\(.+\\)', 2) AS INTEGER)
           + TRY_CAST(regexp_extract(label, '^([MF]) ?([0-9]{1,3}) to ([0-9]{1,3}) \\(.+\\)', 3) AS INTEGER) AS w2,
         regexp_extract(label, '^([MF]) ?([0-9]{1,3}) to ([0-9]{1,3}) \\(.+\\)', 1) AS wletter,
         regexp_matches(label, '^(Male|Female) \\(.+\\)') AS gonly,
         regexp_extract(label, '^(Male|Female) \\(.+\\)', 1) AS gword,
         regexp_matches(label, '^([MF]) +([0-9]{2})') AS owords,
         TRY_CAST(regexp_extract(label, '^([MF]) +([0-9]{2})', 2) AS INTEGER) AS oage,
         regexp_extract(label, '^([MF]) +([0-9]{2})', 1) AS oletter
  FROM labels
),
parsed AS (
  SELECT c_custkey, label,
         CASE WHEN open_age IS NOT NULL THEN open_age
              WHEN closed THEN CASE WHEN s2 % 2 = 0 THEN s2 // 2 WHEN (s2 // 2) % 2 = 0 THEN s2 // 2
                                    ELSE s2 // 2 + 1 END END AS dash_age,
         CASE WHEN open_age IS NOT NULL THEN CASE WHEN starts_with(label, 'M') THEN 'male' ELSE 'female' END
              WHEN closed THEN CASE letter WHEN 'M' THEN 'male' WHEN 'F' THEN 'female' END END AS dash_division,
         CASE WHEN open_age IS NOT NULL THEN open_age WHEN closed THEN s2 // 2 END AS dash_age_floor,
         CASE WHEN open_age IS NOT NULL OR closed THEN 1 ELSE 0 END AS dash_ok,
         CASE WHEN words THEN CASE WHEN w2 % 2 = 0 THEN w2 // 2 WHEN (w2 // 2) % 2 = 0 THEN w2 // 2
                                   ELSE w2 // 2 + 1 END
              WHEN gonly THEN NULL
              WHEN owords THEN oage END AS words_age,
         CASE WHEN words THEN CASE wletter WHEN 'M' THEN 'male' WHEN 'F' THEN 'female' END
              WHEN gonly THEN CASE gword WHEN 'Male' THEN 'male' WHEN 'Female' THEN 'female' END
              WHEN owords THEN CASE oletter WHEN 'M' THEN 'male' WHEN 'F' THEN 'female' END END AS words_division
  FROM dash
)"""

SQL["age_class"] = with_ctes(LABELS, """
SELECT c_custkey, label, CAST(dash_age AS INTEGER) AS dash_age, dash_division,
       CAST(dash_age_floor AS INTEGER) AS dash_age_floor,
       CAST(words_age AS INTEGER) AS words_age, words_division
FROM parsed
""")

SQL["quarantine"] = with_ctes(LABELS, """
SELECT reason, count(*) AS n_rows FROM (
  SELECT CASE WHEN dash_ok = 0 THEN 'unreadable_class' WHEN dash_division IS NULL THEN 'no_division'
              ELSE 'ok' END AS reason
  FROM parsed) GROUP BY reason
""")

SQL["first_int"] = """
SELECT event_id,
       TRY_CAST(NULLIF(regexp_extract(props, '(\\d+)', 1), '') AS BIGINT) AS k,
       TRY_CAST(NULLIF(regexp_extract('Male (' || CAST(user_id AS VARCHAR) || ')', '(\\d+)', 1), '') AS BIGINT)
         AS uid
FROM events
"""

SQL["lenient_int"] = """
SELECT c_custkey, TRY_CAST(trim(regexp_extract(c_name, '#(.*)$', 1)) AS BIGINT) AS num,
       TRY_CAST(trim(c_mktsegment) AS BIGINT) AS seg_num
FROM customer
"""

SQL["clock_seconds"] = """
WITH t AS (SELECT event_id, CAST(round(value * 1000.0, 0) AS BIGINT) AS t FROM events),
c AS (
  SELECT event_id,
         CASE WHEN t // 360000 > 0
              THEN CAST(t // 360000 AS VARCHAR) || ':' || lpad(CAST((t // 6000) % 60 AS VARCHAR), 2, '0')
              ELSE CAST((t // 6000) % 60 AS VARCHAR) END
         || ':' || lpad(CAST((t // 100) % 60 AS VARCHAR), 2, '0') || '.' || lpad(CAST(t % 100 AS VARCHAR), 2, '0')
           AS clock
  FROM t
),
p AS (SELECT event_id, clock, string_split(clock, ':') AS parts FROM c)
SELECT event_id, clock,
       round((CASE len(parts)
                WHEN 3 THEN (CAST(parts[1] AS DOUBLE) * 60.0 + CAST(parts[2] AS DOUBLE)) * 60.0
                            + CAST(parts[3] AS DOUBLE)
                WHEN 2 THEN CAST(parts[1] AS DOUBLE) * 60.0 + CAST(parts[2] AS DOUBLE)
                ELSE CAST(parts[1] AS DOUBLE) END) * 1e4, 0) / 1e4 AS seconds
FROM p
"""

# --- sources -------------------------------------------------------------------

SQL["json_rows_flat"] = """
SELECT event_id // 50 AS page,
       row_number() OVER (PARTITION BY event_id // 50 ORDER BY event_id) - 1 AS row_no,
       event_id, event_type, value, user_id
FROM events
"""

SQL["json_rows_keyed"] = """
SELECT event_id // 50 AS page, event_type AS race,
       row_number() OVER (PARTITION BY event_id // 50, event_type ORDER BY event_id) - 1 AS row_no,
       event_id, value
FROM events
"""

SQL["ragged_layout"] = """
SELECT event_id, event_type,
       CASE WHEN event_type IN ('click', 'purchase') THEN value END AS value,
       user_id,
       CASE WHEN event_type = 'purchase' THEN props END AS props
FROM events WHERE event_type IN ('click', 'view', 'purchase')
"""

SQL["label_zip"] = "SELECT event_id, event_type AS kind, value AS amount, user_id AS who FROM events"

SQL["html_rows"] = """
WITH items AS (SELECT page_id, regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) AS items FROM pages),
flat AS (SELECT page_id, unnest(range(0, len(items))) AS row_no, unnest(items) AS raw FROM items)
SELECT page_id, row_no, regexp_extract(raw, 'href="([^"]*)"', 1) AS href,
       trim(regexp_extract_all(raw, '(?s)<a[^>]*>(.*?)</a>', 1)[1]) AS text
FROM flat
"""

SQL["text_rows"] = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
f AS (SELECT doc_id, unnest(range(0, len(lines))) AS line_no, unnest(lines) AS line FROM l)
SELECT doc_id, line_no, regexp_extract(line, '(?s)^([^ ]+) (.+)', 1) AS word,
       regexp_extract(line, '(?s)^([^ ]+) (.+)', 2) AS rest
FROM f WHERE line_no > 0 AND regexp_matches(line, '(?s)^([^ ]+) (.+)')
"""

SQL["stream_event_points"] = SQL["event_points"]

SQL["completeness"] = with_ctes(LABELS, """
SELECT c_mktsegment, count(*) AS n_rows,
       count(*) FILTER (WHERE dash_division = 'male') AS n_male,
       count(*) FILTER (WHERE dash_division = 'female') AS n_female,
       count(*) FILTER (WHERE dash_division = 'male') + count(*) FILTER (WHERE dash_division = 'female')
         = count(*) AS complete
FROM parsed JOIN customer USING (c_custkey) GROUP BY c_mktsegment
""")

LEGACY_POINTS = RESULTS + scoring_ctes("results", "points", "sizes").replace(
    "CASE WHEN age > 45 THEN CAST(age - 45 AS DOUBLE) * CAST(1.0 AS DOUBLE)",
    "CASE WHEN age > 40 THEN CAST(age - 40 AS DOUBLE) * CAST(0.5 AS DOUBLE)")

SQL["age_bonus_legacy"] = with_ctes(LEGACY_POINTS, """
SELECT event, division, first_name, last_name, age, round(bonus * 1e4, 0) / 1e4 AS bonus, points
FROM points WHERE race_role = 'main'
""")

SQL["place_from_overall"] = """
WITH overall AS (
  SELECT o_orderkey, o_orderpriority, o_orderstatus,
         CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT)
           AS overall_place
  FROM orders
),
checks AS (
  SELECT o_orderpriority,
         count(*) FILTER (WHERE o_orderstatus = 'F') + count(*) FILTER (WHERE o_orderstatus = 'O')
         + count(*) FILTER (WHERE o_orderstatus = 'P') = count(*) AS complete
  FROM orders GROUP BY o_orderpriority
)
SELECT o_orderkey, o_orderpriority, o_orderstatus, overall_place,
       CAST(row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY overall_place) AS BIGINT)
         AS division_place,
       complete
FROM overall JOIN checks USING (o_orderpriority)
"""

SQL["season_job_standings"] = with_ctes(SEASON, """
SELECT division, overall_place, name, n_events, series_points,
       e1995_points AS "1995_points", e1996_points AS "1996_points", e1997_points AS "1997_points",
       e1998_points AS "1998_points", e1999_points AS "1999_points", e2000_points AS "2000_points",
       e2001_points AS "2001_points"
FROM standings
""")

SQL["html_table_rows"] = """
SELECT o_custkey AS c_custkey, o_orderkey, 'Clerk & ' || CAST(o_custkey AS VARCHAR) || ' <x>' AS o_clerk,
       o_orderpriority
FROM orders
"""

SQL["html_table_grid"] = """
SELECT o_custkey AS c_custkey, CAST(0 AS BIGINT) AS table_no,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus, o_orderkey) - 1 AS row_no,
       o_orderstatus AS status, o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS whole, o_orderkey % 100 AS cents,
       o_orderpriority, 'caf\u00e9 &amp; &#233;' AS note, CAST(NULL AS BIGINT) AS n_orders
FROM orders
UNION ALL
SELECT o_custkey, 1, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) - 1,
       o_orderstatus, NULL, NULL, NULL, NULL, NULL, count(*)
FROM orders GROUP BY o_custkey, o_orderstatus
"""

DOCUMENT_LINES = """
l AS (SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
      FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents WHERE text IS NOT NULL)),
h AS (SELECT *, min(CASE WHEN regexp_matches(line, '^([^ ]+ ){9,}') THEN line_no END) OVER (PARTITION BY rid) AS hdr FROM l)
"""

SQL["text_rows_header"] = f"""
WITH {DOCUMENT_LINES}
SELECT doc_id, line_no, regexp_extract(line, '(?s)^([^ ]+) (.+)', 1) AS word,
       regexp_extract(line, '(?s)^([^ ]+) (.+)', 2) AS rest
FROM h WHERE line_no > hdr AND regexp_matches(line, '(?s)^([^ ]+) (.+)')
"""

SQL["headerless_documents"] = f"""
WITH {DOCUMENT_LINES}
SELECT DISTINCT doc_id FROM h WHERE hdr IS NULL
UNION ALL SELECT doc_id FROM documents WHERE text IS NULL
"""

SQL["label_zip_repeated"] = """
SELECT event_id, event_type AS kind, value AS amount, user_id AS who FROM events
"""

SQL["rejects"] = f"""
WITH {DOCUMENT_LINES},
found AS (
  SELECT 'text' AS reader, CASE WHEN hdr IS NULL THEN 'header not found' WHEN line_no < hdr THEN 'before header'
         WHEN line_no = hdr THEN 'header' WHEN NOT regexp_matches(line, '(?s)^([^ ]+) (.+)') THEN 'no match'
         ELSE 'kept' END AS reason FROM h
  UNION ALL
  SELECT 'layout', CASE event_type WHEN 'click' THEN 'kept' WHEN 'view' THEN 'kept' WHEN 'purchase' THEN '5 cells'
         ELSE '2 cells' END FROM events
  UNION ALL
  SELECT 'json', CASE page % 7 WHEN 1 THEN 'not json' WHEN 2 THEN 'no data' WHEN 3 THEN 'unknown shape' ELSE 'kept' END
  FROM (SELECT DISTINCT event_id // 50 AS page FROM events)
  UNION ALL
  SELECT 'csv', CASE WHEN c_custkey % 11 = 0 THEN 'bad cell in c_custkey' WHEN c_custkey % 9 = 0 THEN 'bad cell in c_acctbal'
         ELSE 'kept' END FROM customer)
SELECT reader, reason, count(*) AS n_rows, CAST(sum(count(*)) OVER (PARTITION BY reader) AS BIGINT) AS input_rows,
       true AS complete
FROM found GROUP BY reader, reason
"""

YEARS = range(1995, 2002)
AS_JOB = ", ".join(f'e{y}_points AS "{y}_points"' for y in YEARS)  # the job's event columns

SQL["season_job_teams"] = f"SELECT overall_place, team_name, total_points, {AS_JOB} FROM ({SQL['team_standings']})"
SQL["season_job_report"] = f"SELECT * REPLACE (CAST(event AS VARCHAR) AS event) FROM ({SQL['team_report']})"
SQL["season_job_age_groups"] = SQL["age_group_winners"]
SQL["season_job_aliases"] = f"SELECT * REPLACE (CAST(event AS VARCHAR) AS event) FROM ({SQL['alias_report']})"

# a racer's best row per event of many days takes the place of the one row
SEASON_OF_DAYS = DAYS + """,
points AS (SELECT event, division, first_name, last_name, max(points) AS points FROM day_points GROUP BY ALL)
""" + SEASON[len(POINTS):]

SQL["season_job_multiday"] = with_ctes(SEASON_OF_DAYS, f"""
SELECT division, overall_place, name, n_events, series_points, {AS_JOB} FROM standings
""")

FLAWED = TEAMS + """,
forms AS (
  SELECT team_name, slot, raw_name, raw_division, 1 AS copy FROM reg
  UNION ALL SELECT team_name, slot, raw_name, raw_division, 2 FROM reg WHERE team_name LIKE '%#1'
  UNION ALL SELECT team_name || ' B', slot, CASE WHEN slot = 1 THEN 'Solo' ELSE raw_name END, raw_division, 1
  FROM reg WHERE team_name LIKE '%#2'
),
flawed AS (
  SELECT team_name, slot, CASE WHEN raw_division <> 'MACHINERY' THEN raw_division END AS division,
         split_part(raw_name, ' ', 1) AS first_name, regexp_replace(raw_name, '^[^ ]* ?', '') AS last_name
  FROM forms
),
offenders AS (
  SELECT 'team' AS kind, team_name AS key, count(*) AS n_rows
  FROM (SELECT DISTINCT team_name, copy FROM forms) GROUP BY team_name HAVING count(*) > 1
  UNION ALL
  SELECT 'racer', first_name || ' ' || last_name, count(*) FROM flawed GROUP BY first_name, last_name HAVING count(*) > 1
  UNION ALL
  SELECT 'division', team_name || ' / ' || first_name, count(*) FROM flawed WHERE division IS NULL GROUP BY 2
  UNION ALL
  SELECT 'name', team_name || ' / ' || first_name, count(*) FROM flawed WHERE last_name = '' GROUP BY 2
)"""

SQL["membership_guard_offenders"] = with_ctes(FLAWED, "SELECT kind, key, n_rows FROM offenders")

SQL["season_job_violations"] = with_ctes(FLAWED, """
SELECT 'duplicate_racer' AS guard, CAST(event AS VARCHAR) || ' / ' || division || ' / ' || first_name || ' / ' || last_name AS key,
       count(*) AS n_rows
FROM entries WHERE race_role = 'main' GROUP BY event, division, first_name, last_name HAVING count(*) > 1
UNION ALL
SELECT 'unknown_division', CAST(event AS VARCHAR) || ' / ' || division, count(*)
FROM entries WHERE division NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD') GROUP BY event, division
UNION ALL
SELECT 'membership_' || kind, key, n_rows FROM offenders
""")

SQL["name_human_forms"] = """
SELECT p_partkey,
       CASE p_partkey % 8 WHEN 3 THEN '' WHEN 5 THEN 'van' WHEN 7 THEN '' ELSE a END AS first_name,
       CASE p_partkey % 8 WHEN 1 THEN 'de la ' || b WHEN 2 THEN '' WHEN 3 THEN a WHEN 6 THEN 'von ' || b WHEN 7 THEN ''
            ELSE b END AS last_name
FROM (SELECT p_partkey, upper(split_part(p_name, ' ', 1)[1]) || lower(split_part(p_name, ' ', 1)[2:]) AS a,
             upper(split_part(p_name, ' ', 2)[1]) || lower(split_part(p_name, ' ', 2)[2:]) AS b FROM part)
"""

SQL["band_join_many"] = """
SELECT l_orderkey, l_linenumber, o_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_linenumber <= o_orderkey % 10
"""

BRACKET = "'^.* ([0-9]+) to ([0-9]+) .*'"

SQL["age_bracket"] = with_ctes(LABELS, f"""
SELECT c_custkey, CAST(CASE WHEN s % 2 = 0 THEN s // 2 WHEN (s // 2) % 2 = 0 THEN s // 2 ELSE s // 2 + 1 END AS INTEGER) AS age,
       CAST(s // 2 AS INTEGER) AS age_floor
FROM (SELECT c_custkey, TRY_CAST(regexp_extract(t, {BRACKET}, 1) AS INTEGER)
                        + TRY_CAST(regexp_extract(t, {BRACKET}, 2) AS INTEGER) AS s
      FROM (SELECT c_custkey, 'Race 9 to 5 of ' || label || ' end' AS t FROM labels))
""")
