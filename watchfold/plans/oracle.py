"""DuckDB SQL for every registered query: the independent check of the Spark plans.

The fixtures are re-derived in SQL from the same tables; the facts use the
reference's operator-by-operator shape (separate aggregates joined on the
contract, UNION ALL of five program aggregates, a self-join for the month pair)
so that they do not share a plan with the Spark side.
"""

from __future__ import annotations

# The values the reference fixes are stated here once more, so that a wrong value in
# the package does not pass both sides.
PROGRAM_TYPES = ["Entertainment", "Kids", "Movies", "Sports", "TV_Channel"]
APPS = ["CHANNEL", "DSHD", "KPLUS", "KPlus", "VOD", "FIMS_RES", "BHD_RES", "VOD_RES", "FIMS", "BHD", "DANET",
        "RELAX", "CHILD", "SPORT", "XAPP"]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


LC = f"""SELECT CASE WHEN user_id % 50 = 49 THEN NULL WHEN user_id % 50 = 48 THEN ''
            WHEN user_id = 0 THEN '0' ELSE 'C' || CAST(user_id AS VARCHAR) END AS Contract,
       'M' || CAST(user_id * 4 + event_id % 4 AS VARCHAR) AS Mac,
       {_list(APPS)}[CAST(event_id % (1 + user_id % 15) AS INTEGER) + 1] AS AppName,
       CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN CAST(0 AS BIGINT)
            ELSE CAST(round(value * 100) AS BIGINT) END AS TotalDuration,
       DATE '2024-01-01' + CAST((day(ts) - 1) % (user_id % 31 + 1)
           + CASE WHEN user_id % 3 = 0 AND event_id % 2 = 1 THEN 31 ELSE 0 END AS INTEGER) AS log_date
FROM events"""

KEYWORD = """CASE WHEN p_partkey % 40 = 0 THEN ['VTV3', 'running', 'nhật ký'][CAST(p_partkey // 40 % 3 AS INTEGER) + 1]
            ELSE p_name || ' ' || ['htv7', 'CHANNEL', 'Master Key', 'Reality', 'romantic', 'Love', 'hogwarts',
                 'plain'][CAST(p_partkey % 8 AS INTEGER) + 1] || ' ' || CAST(p_partkey // 8 AS VARCHAR) END"""

LS = f"""SELECT CASE WHEN o_custkey % 101 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS user_id,
       CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE {KEYWORD} END AS keyword,
       CAST(o_orderdate AS DATE) AS log_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""

_FOUR = "['Action', 'Romance', 'Comedy', 'Horror']"
MP = f"""SELECT CASE WHEN k % 8 = 7 THEN 'unsearched ' || keyword ELSE keyword END AS most_searched,
       CASE WHEN again THEN {_FOUR}[CAST((k + 1) % 4 AS INTEGER) + 1] WHEN k % 30 = 0 THEN 'Fantasy'
            ELSE {_FOUR}[CAST(k % 4 AS INTEGER) + 1] END AS Genre
FROM (SELECT {KEYWORD} AS keyword, min(p_partkey) AS k FROM part GROUP BY 1), (VALUES (false), (true)) a(again)
WHERE NOT again OR k % 11 = 0"""

_TYPE_CASE = """CASE WHEN AppName IN ('CHANNEL', 'DSHD', 'KPLUS', 'KPlus') THEN 'TV_Channel'
     WHEN AppName IN ('VOD', 'FIMS_RES', 'BHD_RES', 'VOD_RES', 'FIMS', 'BHD', 'DANET') THEN 'Movies'
     WHEN AppName = 'RELAX' THEN 'Entertainment' WHEN AppName = 'CHILD' THEN 'Kids'
     WHEN AppName = 'SPORT' THEN 'Sports' ELSE 'Error' END"""

# interaction chain: lc -> t (month, Type) -> cat (type totals) -> parts -> fi
INTERACTION_CTES = f"""lc AS ({LC}),
t AS (SELECT *, strftime(log_date, '%Y%m') AS month_yyyymm, {_TYPE_CASE} AS Type FROM lc),
cat AS (SELECT month_yyyymm, Contract, Type, CAST(SUM(TotalDuration) AS BIGINT) AS TotalDuration
        FROM t GROUP BY month_yyyymm, Contract, Type),
st AS (SELECT month_yyyymm, Contract, {', '.join(
    f"CAST(COALESCE(SUM(TotalDuration) FILTER (WHERE Type = {_q(p)}), 0) AS BIGINT) AS {p}"
    for p in PROGRAM_TYPES)}
       FROM cat GROUP BY month_yyyymm, Contract),
dev AS (SELECT month_yyyymm, Contract, COUNT(*) AS TotalDevices FROM t GROUP BY month_yyyymm, Contract),
mw AS (SELECT month_yyyymm, Contract, Type AS Most_Watch FROM (
         SELECT *, row_number() OVER (PARTITION BY month_yyyymm, Contract
                                      ORDER BY TotalDuration DESC NULLS LAST, Type) AS rn FROM cat)
       WHERE rn = 1),
taste AS (SELECT month_yyyymm, Contract, string_agg(Type, ',' ORDER BY Type) AS customer_taste
          FROM cat WHERE TotalDuration > 0 GROUP BY month_yyyymm, Contract),
act AS (SELECT month_yyyymm, Contract,
               COUNT(DISTINCT CASE WHEN Contract IS NOT NULL THEN log_date END) AS Active_Days
        FROM t GROUP BY month_yyyymm, Contract),
fi AS (SELECT Contract, {', '.join(PROGRAM_TYPES)}, TotalDevices, Most_Watch, customer_taste,
              Active_Days, month_yyyymm
       FROM st JOIN dev USING (month_yyyymm, Contract) JOIN mw USING (month_yyyymm, Contract)
               JOIN taste USING (month_yyyymm, Contract) JOIN act USING (month_yyyymm, Contract)
       WHERE Contract NOT IN ('0', '') AND Contract IS NOT NULL)"""

_MONTH_INDEX = ("(CAST(substr(month_yyyymm, 1, 4) AS INTEGER) * 12 "
                "+ CAST(substr(month_yyyymm, 5, 2) AS INTEGER) - 1)")

# behaviour chain: ls -> kf -> ms -> gm -> tr -> fb
BEHAVIOR_CTES = f"""ls AS ({LS}),
mp AS ({MP}),
kf AS (SELECT strftime(log_date, '%Y%m') AS month_yyyymm, user_id, keyword, COUNT(*) AS frequency
       FROM ls WHERE user_id IS NOT NULL AND keyword IS NOT NULL
       GROUP BY 1, 2, 3),
ms AS (SELECT month_yyyymm, user_id, keyword AS most_searched FROM (
         SELECT *, row_number() OVER (PARTITION BY month_yyyymm, user_id
                                      ORDER BY frequency DESC, keyword) AS rn FROM kf)
       WHERE rn = 1),
gm AS (SELECT ms.month_yyyymm, ms.user_id, ms.most_searched, mp.Genre, {_MONTH_INDEX} AS mi
       FROM ms JOIN mp ON ms.most_searched = mp.most_searched),
tr AS (SELECT c.month_yyyymm, c.user_id, p.Genre AS prev_genre, c.Genre AS curr_genre,
              CASE WHEN p.Genre = c.Genre THEN 'Unchanged' ELSE 'Changed' END AS Trending_Type,
              CASE WHEN p.Genre = c.Genre THEN 'Unchanged' ELSE p.Genre END AS Previous_Genre
       FROM gm c JOIN gm p ON p.user_id = c.user_id AND p.mi = c.mi - 1),
fb AS (SELECT user_id, Previous_Genre, Trending_Type, month_yyyymm FROM tr)"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _interaction(body: str) -> str:
    return _with(INTERACTION_CTES, body)


def _behavior(body: str) -> str:
    return _with(BEHAVIOR_CTES, body)


def _both(body: str) -> str:
    return _with(INTERACTION_CTES + ",\n" + BEHAVIOR_CTES, body)


_BIN_CASE = """CASE WHEN Active_Days IS NULL THEN 'Unknown'
     WHEN Active_Days >= 0 AND Active_Days < 5 THEN '0-5' WHEN Active_Days >= 5 AND Active_Days < 10 THEN '5-10'
     WHEN Active_Days >= 10 AND Active_Days < 15 THEN '10-15' WHEN Active_Days >= 15 AND Active_Days < 20 THEN '15-20'
     WHEN Active_Days >= 20 AND Active_Days < 25 THEN '20-25' WHEN Active_Days >= 25 AND Active_Days < 30 THEN '25-30'
     ELSE '30' END"""


def _program_stats_part(p: str) -> str:
    watched = f"FILTER (WHERE {p} > 0)"
    return (f"SELECT month_yyyymm, {_q(p)} AS program_name, "
            f"CAST(SUM({p}) {watched} AS BIGINT) AS total_duration, "
            f"SUM({p}) {watched} / 3600 AS total_duration_hours, "
            f"COUNT(DISTINCT Contract) {watched} AS distinct_contract_count, "
            f"AVG(Active_Days) {watched} AS avg_active_days "
            f"FROM fi GROUP BY month_yyyymm")


def _rule_case(col: str) -> str:
    has = lambda *words: " OR ".join(f"contains(lower({col}), {_q(w)})" for w in words)
    return f"""CASE {col} WHEN 'thuyếtminh' THEN 'Other' WHEN 'bigfoot' THEN 'Horror' WHEN 'capdoi' THEN 'Romance'
     WHEN 'ARGEN' THEN 'Sports' WHEN 'nhật ký' THEN 'Drama' WHEN 'PENT' THEN 'C Drama'
     WHEN 'running' THEN 'Reality Show' WHEN 'VTV3' THEN 'TV Channel' ELSE
     CASE WHEN {has('vtv', 'htv', 'channel')} THEN 'TV Channel'
          WHEN {has('running', 'master key', 'reality')} THEN 'Reality Show'
          WHEN {has('sex', 'romantic', 'love')} THEN 'Romance'
          WHEN {has('potter', 'hogwarts')} THEN 'Drama' ELSE 'Other' END END"""


_GENRES = ["Action", "Romance", "Comedy", "Horror", "Animation", "Drama", "C Drama", "K Drama", "Sports", "Music",
           "Reality Show", "TV Channel", "News", "Other"]

# the bridge: numbered keys, running demand, slots, links, primary
_BRIDGE = """u AS (SELECT user_id, row_number() OVER (ORDER BY md5('42:' || user_id), user_id) - 1 AS pos
       FROM (SELECT DISTINCT user_id FROM fb WHERE user_id IS NOT NULL)),
n AS (SELECT COUNT(*) AS n FROM u),
c AS (SELECT contract, row_number() OVER (ORDER BY md5('43:' || contract), contract) - 1 AS pos,
             least(CAST('0x' || substr(md5('44:' || contract), 1, 8) AS BIGINT) % 5 + 1, n) AS d
      FROM (SELECT DISTINCT Contract AS contract FROM fi WHERE Contract IS NOT NULL), n),
s AS (SELECT contract, d, SUM(d) OVER (ORDER BY pos) AS slot_end FROM c),
l AS (SELECT contract AS contract_id, unnest(range(CAST(slot_end - d AS BIGINT), CAST(slot_end AS BIGINT))) AS slot FROM s),
b AS (SELECT DISTINCT user_id, contract_id FROM l, n, u WHERE slot < 5 * n AND u.pos = slot % n)"""

ORACLE_SQL: dict[str, str] = {
    "log_content": LC,
    "log_search": LS,
    "genre_mapping": MP,
    "app_category": _interaction("SELECT * FROM t"),
    "category_duration": _interaction("SELECT * FROM cat"),
    "contract_statistics": _interaction("SELECT * FROM st"),
    "total_devices": _interaction("SELECT * FROM dev"),
    "most_watch": _interaction("SELECT * FROM mw"),
    "customer_taste": _interaction("SELECT * FROM taste"),
    "daily_active": _interaction(
        "SELECT month_yyyymm, log_date, Contract, COUNT(DISTINCT Contract) AS Active "
        "FROM t GROUP BY month_yyyymm, log_date, Contract"),
    "active_days": _interaction("SELECT * FROM act"),
    "fact_interaction": _interaction("SELECT * FROM fi"),
    "fact_interaction_stepwise": _interaction("SELECT * FROM fi"),
    "fact_sink_roundtrip": _interaction("SELECT * FROM fi"),
    "keyword_frequency": _behavior("SELECT * FROM kf"),
    "most_searched": _behavior("SELECT * FROM ms"),
    "genre_mapped": _behavior("SELECT month_yyyymm, user_id, most_searched, Genre FROM gm"),
    "genre_trend": _behavior("SELECT * FROM tr"),
    "fact_behavior": _behavior("SELECT * FROM fb"),
    "distinct_programs": _behavior("SELECT DISTINCT most_searched FROM ms"),
    "active_days_distribution": _interaction(
        f"SELECT month_yyyymm, {_BIN_CASE} AS active_days_bin, "
        "COUNT(DISTINCT Contract) AS distinct_contract_count FROM fi GROUP BY 1, 2"),
    "program_duration_stats": _interaction(
        "\nUNION ALL\n".join(_program_stats_part(p) for p in PROGRAM_TYPES)),
    "taste_distribution": _interaction(
        "SELECT month_yyyymm, customer_taste, COUNT(DISTINCT Contract) AS distinct_contract_count "
        "FROM fi GROUP BY 1, 2"),
    "top10_by_program": _interaction(
        "SELECT month_yyyymm, Contract, upper(trim('tv')) AS Program, TV_Channel AS Duration FROM ("
        "SELECT *, row_number() OVER (PARTITION BY month_yyyymm "
        "ORDER BY TV_Channel DESC NULLS LAST, Contract) AS rn FROM fi) WHERE rn <= 10"),
    "avg_total_devices": _interaction(
        "SELECT month_yyyymm, AVG(TotalDevices) AS avg_total_devices FROM fi GROUP BY 1"),
    "behavior_sample": _behavior("SELECT * FROM fb ORDER BY month_yyyymm, user_id, Previous_Genre, Trending_Type LIMIT 100"),
    # round half up to two decimals in exact integer arithmetic, then to double
    "genre_change_percent": _behavior(
        "SELECT month_yyyymm, CAST((20000 * c + u) // (2 * u) AS DOUBLE) / 100 AS percent_changed FROM ("
        "SELECT month_yyyymm, COUNT(DISTINCT CASE WHEN Trending_Type <> 'Unchanged' THEN user_id END) AS c, "
        "NULLIF(COUNT(DISTINCT user_id), 0) AS u FROM fb GROUP BY 1)"),
    "changed_by_previous_genre": _behavior(
        "SELECT month_yyyymm, Previous_Genre, COUNT(DISTINCT user_id) AS changed_user_count "
        "FROM fb WHERE Trending_Type <> 'Unchanged' GROUP BY 1, 2"),
    "dim_user": _behavior("SELECT DISTINCT user_id FROM fb WHERE user_id IS NOT NULL"),
    "dim_contract": _interaction("SELECT DISTINCT Contract AS contract FROM fi WHERE Contract IS NOT NULL"),
    "check_row_counts": _both(
        "SELECT (SELECT COUNT(*) FROM fi) AS fact_interaction_rows, "
        "(SELECT COUNT(*) FROM fb) AS fact_behavior_rows"),
    # on the facts' key columns as they are (repeated keys), and on the raw logs (NULL keys)
    "check_dim_uniqueness": _both(
        "SELECT (SELECT COUNT(user_id) FROM fb) AS dim_user_rows, "
        "(SELECT COUNT(DISTINCT user_id) FROM fb) AS dim_user_distinct, "
        "(SELECT COUNT(Contract) FROM fi) AS dim_contract_rows, "
        "(SELECT COUNT(DISTINCT Contract) FROM fi) AS dim_contract_distinct"),
    "check_null_keys": _both(
        "SELECT (SELECT CAST(SUM(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM ls) "
        "AS null_user_id_rows, "
        "(SELECT CAST(SUM(CASE WHEN Contract IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM lc) "
        "AS null_contract_rows"),
    "label_genres": _behavior(
        f"SELECT most_searched, {_rule_case('most_searched')} AS Genre "
        "FROM (SELECT DISTINCT most_searched FROM ms)"),
    "parse_label_replies": _behavior(
        f"SELECT most_searched, {_rule_case('most_searched')} AS Genre "
        "FROM (SELECT DISTINCT most_searched FROM ms)"),
    "rule_genre_label": _behavior(
        f"SELECT keyword, {_rule_case('keyword')} AS Genre "
        "FROM (SELECT DISTINCT keyword FROM ls WHERE keyword IS NOT NULL)"),
    "check_genre_domain": _behavior(
        "SELECT COUNT(*) AS mapping_rows, COUNT(*) FILTER (WHERE Genre IS NULL OR Genre NOT IN ("
        + ", ".join(_q(g) for g in _GENRES) + ")) AS out_of_domain_rows FROM mp"),
    "bridge_synth": _with(INTERACTION_CTES + ",\n" + BEHAVIOR_CTES + ",\n" + _BRIDGE,
        "SELECT user_id, contract_id, DATE '2022-04-01' AS start_date, DATE '2026-12-12' AS end_date, "
        "row_number() OVER (PARTITION BY contract_id ORDER BY md5('45:' || user_id), user_id) = 1 AS is_primary FROM b"),
    # the same numbers by other ways: files written and read back, SQL text, no month
    "csv_roundtrip": MP,
    "watch_log_files": _interaction("SELECT Contract, Mac, AppName, CAST(TotalDuration AS DOUBLE) AS TotalDuration, "
                                    "log_date FROM lc"),
    "search_log_files": _behavior("SELECT user_id, keyword, strftime(log_date, '%Y%m') AS month_yyyymm FROM ls"),
    "top10_overall": _interaction(
        "SELECT Contract, 'TV' AS Program, TV_Channel AS Duration FROM fi "
        "ORDER BY TV_Channel DESC NULLS LAST, Contract, month_yyyymm LIMIT 10"),
}
_PROGRAM_COLUMNS = ", ".join(f"{p} bigint" for p in PROGRAM_TYPES)
_STORED = [("fact_monthly_customer_interaction", "fi", f"Contract string, {_PROGRAM_COLUMNS}, TotalDevices bigint, "
            "Most_Watch string, customer_taste string, Active_Days bigint, month_yyyymm string"),
           ("fact_monthly_customer_behavior", "fb",
            "user_id string, Previous_Genre string, Trending_Type string, month_yyyymm string"),
           ("dim_user", "(SELECT DISTINCT user_id FROM fb WHERE user_id IS NOT NULL)", "user_id string"),
           ("dim_contract", "(SELECT DISTINCT Contract FROM fi)", "contract string"),
           ("user_contract_details", "b",
            "user_id string, contract_id string, start_date date, end_date date, is_primary boolean")]
_BIN_PLACE = """CASE active_days_bin WHEN '0-5' THEN 1 WHEN '5-10' THEN 2 WHEN '10-15' THEN 3 WHEN '15-20' THEN 4
     WHEN '20-25' THEN 5 WHEN '25-30' THEN 6 WHEN '30' THEN 7 ELSE 8 END"""


def _in_order(name: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS place FROM ({ORACLE_SQL[name]})"


ORACLE_SQL |= {
    "fact_month_reload": _interaction("SELECT * FROM fi WHERE month_yyyymm > '202402' "
                                      "OR month_yyyymm = '202401' AND Active_Days >= 5"),
    "daily_state": _interaction(
        "SELECT log_date, Contract, " + ", ".join(
            f"CAST(SUM(TotalDuration) FILTER (WHERE Type = '{t}') AS BIGINT) AS {t}" for t in ["Error", *PROGRAM_TYPES])
        + ", COUNT(*) AS log_rows FROM t WHERE Contract NOT IN ('', '0') GROUP BY 1, 2"),
    "fact_from_daily": ORACLE_SQL["fact_interaction"],
    "fact_after_late_day": ORACLE_SQL["fact_interaction"].replace(
        f"lc AS ({LC})",
        f"lc AS (SELECT * FROM ({LC}) WHERE log_date <> DATE '2024-01-03' OR TotalDuration >= 5000)"),
    "watch_log_payloads": _interaction("""SELECT Contract, Mac, AppName, CAST(TotalDuration AS DOUBLE) AS TotalDuration, log_date,
       'history' AS index_name, CASE WHEN day(log_date) % 2 = 1 THEN Mac END AS device_id,
       CASE WHEN day(log_date) % 2 = 1 THEN dayofyear(log_date) END AS device_os,
       CASE WHEN day(log_date) % 2 = 0 THEN 'v' || day(log_date) END AS release, CAST(NULL AS VARCHAR) AS malformed
FROM lc WHERE TotalDuration IS NULL OR TotalDuration <> 0
UNION ALL SELECT NULL, NULL, NULL, NULL, log_date, NULL, NULL, NULL, NULL,
       '{{"_index":"history","_source":{' || CASE WHEN Contract IS NULL THEN '' ELSE '"Contract":"' || Contract || '",' END
       || '"Mac":"' || Mac || '","AppName":"' || AppName || '","TotalDuration":0,'
       || CASE WHEN day(log_date) % 2 = 1 THEN '"device":{"id":"' || Mac || '","os":' || dayofyear(log_date) || '}'
               ELSE '"release":"v' || day(log_date) || '"' END || '}}'
FROM lc WHERE TotalDuration = 0"""),
    "label_ledger": _behavior(
        f"SELECT most_searched, {_rule_case('most_searched')} AS Genre, 1 + length(most_searched) % 2 AS asked, "
        "length(most_searched) % 2 AS failed FROM (SELECT DISTINCT most_searched FROM ms)"),
    "publication_checks": _interaction(
        "SELECT COUNT(*) AS rows, COUNT(DISTINCT month_yyyymm) AS months, 0 AS null_keys, 0 AS placeholder_contracts, "
        "true AS published FROM fi UNION ALL SELECT COUNT(*), COUNT(DISTINCT month_yyyymm), "
        "COUNT(*) FILTER (WHERE Contract IS NULL), COUNT(*) FILTER (WHERE Contract IN ('', '0')), false FROM dev"),
    "programs_csv": ORACLE_SQL["distinct_programs"],
    "stored_model": _with(INTERACTION_CTES + ",\n" + BEHAVIOR_CTES + ",\n" + _BRIDGE, " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, (SELECT COUNT(*) FROM {rows}) AS rows, '{columns}' AS columns"
        for name, rows, columns in _STORED)),
    "bitmap_active_days": ORACLE_SQL["active_days_distribution"],
    "bitmap_taste": ORACLE_SQL["taste_distribution"],
    "bitmap_genre_change": ORACLE_SQL["genre_change_percent"],
    "bitmap_program_reach": _interaction(" UNION ALL ".join(
        f"SELECT '{p}' AS program_name, COUNT(DISTINCT Contract) AS contracts FROM fi WHERE {p} > 0 HAVING COUNT(*) > 0"
        for p in PROGRAM_TYPES)),
    "bitmap_taste_reach": _interaction(
        "SELECT customer_taste, COUNT(DISTINCT Contract) AS contracts FROM fi GROUP BY 1"),
    "bitmap_retention": _with(BEHAVIOR_CTES + f""",
k AS (SELECT DISTINCT user_id, month_yyyymm, {_MONTH_INDEX} AS mi FROM fb)""", """SELECT month_yyyymm, CAST(SUM(a * b) AS BIGINT) AS retained,
       CAST(SUM(a * (1 - b)) AS BIGINT) AS gained, CAST(SUM((1 - a) * b) AS BIGINT) AS lost
FROM (SELECT m.month_yyyymm, u.user_id,
             CAST(EXISTS (SELECT 1 FROM k WHERE k.user_id = u.user_id AND k.mi = m.mi) AS INTEGER) AS a,
             CAST(EXISTS (SELECT 1 FROM k WHERE k.user_id = u.user_id AND k.mi = m.mi - 1) AS INTEGER) AS b
      FROM (SELECT DISTINCT month_yyyymm, mi FROM k) m, (SELECT DISTINCT user_id FROM k) u
      WHERE m.mi - 1 IN (SELECT mi FROM k)) GROUP BY 1""")
,
    "active_days_in_order": _in_order("active_days_distribution", f"month_yyyymm, {_BIN_PLACE}"),
    "taste_in_order": _in_order("taste_distribution", "month_yyyymm, distinct_contract_count DESC, customer_taste"),
    "changed_in_order": _in_order("changed_by_previous_genre",
                                  "month_yyyymm, changed_user_count DESC, Previous_Genre NULLS FIRST"),
    "users_in_order": _in_order("dim_user", "user_id DESC"),
}
for _view, _same in (("sql_active_days_view", "active_days_distribution"),
                     ("sql_program_stats_view", "program_duration_stats"),
                     ("sql_taste_view", "taste_distribution")):
    ORACLE_SQL[_view] = ORACLE_SQL[_same]
ORACLE_SQL["sql_top10_function"] = ORACLE_SQL["top10_overall"]
