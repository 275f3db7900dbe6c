"""DuckDB twins of the registered queries (run by the driver's correctness gate).

Each string builds the same fixture rows as ``fixtures.py`` in SQL and applies
the operator's semantics directly, so it is an independent statement of what
the Spark plan must return. Column names and types match the Spark output.
"""

from __future__ import annotations

DAILY_LI = """daily_li AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS symbol, l_shipdate AS load_timestamp_utc,
    CAST(l_extendedprice AS DECIMAL(9,2)) AS previous_close,
    CAST(l_quantity AS DECIMAL(9,2)) AS open_price,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) || ' x ' || CAST(l_partkey AS VARCHAR) AS bid,
    CAST(CAST(l_tax AS DECIMAL(4,2)) AS VARCHAR) || 'x' || CAST(l_linenumber AS VARCHAR) AS ask,
    CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) || ' - ' || CAST(CAST(l_tax AS DECIMAL(4,2)) AS VARCHAR) AS day_range,
    CAST(l_suppkey AS VARCHAR) AS volume,
    CAST(l_partkey AS VARCHAR) AS avg_volume,
    CAST(l_linenumber AS VARCHAR) || '.' || CAST(l_suppkey AS VARCHAR)
      || CASE WHEN l_returnflag = 'A' THEN 'T' ELSE 'B' END AS intraday_market_cap,
    CAST(l_discount AS DECIMAL(5,2)) AS beta,
    CAST(l_tax AS DECIMAL(7,2)) AS pe_ratio,
    CAST(l_linenumber AS DECIMAL(7,2)) AS eps,
    CASE WHEN l_orderkey % 3 = 0 THEN strftime(l_shipdate, '%b %d, %Y')
         ELSE strftime(l_shipdate, '%b %d, %Y') || ' - ' || strftime(l_shipdate + INTERVAL 5 DAY, '%b %-d, %Y')
    END AS earnings_date,
    l_returnflag || ' (' || l_linestatus || ')' AS forward_dividend_and_yield,
    strftime(l_shipdate, '%b %-d, %Y') AS ex_dividend_date,
    CAST(l_extendedprice AS DECIMAL(9,2)) AS one_year_target_estimate
  FROM lineitem)"""

DAILY_EV = """daily_e AS (
  SELECT CAST(user_id AS VARCHAR) AS symbol, load_timestamp_utc,
    CAST(vmin AS DECIMAL(9,2)) AS previous_close, CAST(vmax AS DECIMAL(9,2)) AS open_price,
    CAST(vmin AS VARCHAR) || ' x ' || CAST(n AS VARCHAR) AS bid,
    CAST(vmax AS VARCHAR) || ' x ' || CAST(clicks AS VARCHAR) AS ask,
    CAST(vmin AS VARCHAR) || ' - ' || CAST(vmax AS VARCHAR) AS day_range,
    CAST(n AS VARCHAR) AS volume, CAST(vsum AS VARCHAR) AS avg_volume,
    CAST(n AS VARCHAR) || 'T' AS intraday_market_cap,
    CAST(NULL AS DECIMAL(5,2)) AS beta, CAST(NULL AS DECIMAL(7,2)) AS pe_ratio,
    CAST(NULL AS DECIMAL(7,2)) AS eps,
    strftime(tmin, '%b %d, %Y') || ' - ' || strftime(tmax, '%b %d, %Y') AS earnings_date,
    CAST(purchases AS VARCHAR) || ' purchases' AS forward_dividend_and_yield,
    CAST(views AS VARCHAR) || ' views' AS ex_dividend_date,
    CAST(vmax AS DECIMAL(9,2)) AS one_year_target_estimate
  FROM (SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS load_timestamp_utc,
          min(CAST(value AS DECIMAL(12,2))) AS vmin, max(CAST(value AS DECIMAL(12,2))) AS vmax,
          sum(CAST(value AS DECIMAL(12,2))) AS vsum, count(*) AS n,
          sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS clicks,
          sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS purchases,
          sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS views,
          min(ts) AS tmin, max(ts) AS tmax
        FROM events GROUP BY user_id, CAST(date_trunc('day', ts) AS TIMESTAMP)) g)"""

WEEKLY_CUST = """weekly_c AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS symbol,
    TIMESTAMP '2024-01-07 00:00:00' AS load_timestamp_utc,
    c.c_name AS company_name,
    CAST(c.c_custkey AS VARCHAR) || ' Main St, '
      || CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'New Town' ELSE 'Town' END || ' '
      || n.n_name || ' ' || lpad(CAST(c.c_custkey AS VARCHAR), 5, '0') || ' US' AS company_address,
    '+1 (' || CAST(c.c_nationkey + 100 AS VARCHAR) || ') 555-' || CAST(c.c_custkey AS VARCHAR) AS company_phone_number,
    'https://c' || CAST(c.c_custkey AS VARCHAR) || '.example.com' AS company_website,
    c.c_mktsegment AS company_sector,
    n.n_name AS company_industry,
    CAST(c.c_custkey AS VARCHAR) || ',' || lpad(CAST(c.c_nationkey AS VARCHAR), 3, '0') || ' employees' AS company_full_time_employees,
    'Description   ' || c.c_name || ' serves ' || c.c_mktsegment AS company_description,
    'Corporate Governance   ISS score ' || CAST(CAST(c.c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS company_corporate_governance_score
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

WEEKLY_ORD = """weekly_o AS (
  SELECT CAST(a.o_custkey AS VARCHAR) AS symbol, a.load_timestamp_utc, c.c_name AS company_name,
    CAST(a.o_custkey AS VARCHAR) || ' Main St, '
      || CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'New Town' ELSE 'Town' END || ' '
      || n.n_name || ' ' || lpad(CAST(a.o_custkey AS VARCHAR), 5, '0') || ' US' AS company_address,
    CAST(NULL AS VARCHAR) AS company_phone_number, CAST(NULL AS VARCHAR) AS company_website,
    a.company_sector, a.company_industry,
    CAST(NULL AS VARCHAR) AS company_full_time_employees, CAST(NULL AS VARCHAR) AS company_description,
    CAST(NULL AS VARCHAR) AS company_corporate_governance_score
  FROM (SELECT o_custkey, CAST(date_trunc('year', o_orderdate) AS TIMESTAMP) AS load_timestamp_utc,
          max(o_orderpriority) AS company_industry, max(o_orderstatus) AS company_sector
        FROM orders GROUP BY o_custkey, CAST(date_trunc('year', o_orderdate) AS TIMESTAMP)) a
  JOIN customer c ON a.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

DIMS = """companies AS (SELECT c_custkey AS company_id, CAST(c_custkey AS VARCHAR) AS company_symbol,
                     c_name AS company_name FROM customer),
industries AS (SELECT * FROM (VALUES (1, '1-URGENT'), (2, '2-HIGH'), (3, '3-MEDIUM'), (5, '5-LOW'))
               t(industry_id, industry_name)),
sectors AS (SELECT * FROM (VALUES (1, 'F'), (2, 'O')) t(sector_id, sector_name)),
states AS (SELECT n_nationkey AS state_id, 'N' || CAST(n_nationkey AS VARCHAR) AS state_symbol,
           n_name AS state_name FROM nation)"""


def stg_daily_sql(src: str) -> str:
    def part(c, d, n):
        return f"trim(split_part({c}, '{d}', {n}))"

    def dt(n):
        p = part("earnings_date", "-", n)
        return f"CASE WHEN {p} IS NOT NULL THEN CAST(try_strptime({p}, '%b %d, %Y') AS DATE) END"

    return f"""SELECT symbol, load_timestamp_utc, previous_close, open_price,
    {part('bid', 'x', 1)} AS bid_price, {part('bid', 'x', 2)} AS bid_size,
    {part('ask', 'x', 1)} AS ask_price, {part('ask', 'x', 2)} AS ask_size,
    {part('day_range', '-', 1)} AS day_range_low, {part('day_range', '-', 2)} AS day_range_high,
    volume, avg_volume,
    left(intraday_market_cap, length(intraday_market_cap) - 1) AS intraday_market_cap_trillions,
    beta, pe_ratio, eps,
    {dt(1)} AS earnings_date_min, {dt(2)} AS earnings_date_max,
    forward_dividend_and_yield, ex_dividend_date, one_year_target_estimate
  FROM {src}"""


def stg_weekly_sql(src: str) -> str:
    second = "trim(split_part(company_address, ',', 2))"
    return f"""SELECT symbol, load_timestamp_utc, company_name,
    trim(split_part(company_address, ',', 1)) AS company_street_address,
    split_part({second}, ' ', 1) AS company_city,
    split_part({second}, ' ', 2) AS company_state,
    COALESCE(split_part({second}, ' ', 3), '') AS company_zip_code,
    COALESCE(split_part({second}, ' ', 4), '') AS company_country,
    regexp_replace(company_phone_number, '[^0-9]', '', 'g') AS company_phone_number,
    company_website, company_sector, company_industry,
    regexp_replace(company_full_time_employees, '[^0-9]', '', 'g') AS company_full_time_employees,
    replace(company_description, 'Description   ', '') AS company_description,
    replace(company_corporate_governance_score, 'Corporate Governance   ', '') AS company_corporate_governance_score
  FROM {src}"""


LATEST_WEEKLY = f"""{WEEKLY_ORD},
sw AS ({stg_weekly_sql('weekly_o')}),
lw AS (SELECT * FROM sw WHERE load_timestamp_utc = (SELECT max(load_timestamp_utc) FROM sw))"""

FACT_MEASURES = """d.load_timestamp_utc, d.previous_close, d.open_price, d.bid_price, d.bid_size,
    d.ask_price, d.ask_size, d.day_range_low, d.day_range_high, d.volume, d.avg_volume,
    d.intraday_market_cap_trillions, d.beta, d.pe_ratio, d.eps, d.earnings_date_min,
    d.earnings_date_max, d.forward_dividend_and_yield, d.ex_dividend_date,
    d.one_year_target_estimate"""

STAR_FACT = f"""WITH {DAILY_EV},
sd AS ({stg_daily_sql('daily_e')}),
{LATEST_WEEKLY},
{DIMS}
SELECT c.company_id, i.industry_id, s.sector_id, st.state_id, {FACT_MEASURES}
FROM sd d
LEFT JOIN lw w ON d.symbol = w.symbol
LEFT JOIN companies c ON d.symbol = c.company_symbol
LEFT JOIN industries i ON w.company_industry = i.industry_name
LEFT JOIN sectors s ON w.company_sector = s.sector_name
LEFT JOIN states st ON w.company_state = st.state_name"""

LATEST_SNAPSHOT = f"""WITH {LATEST_WEEKLY}
SELECT symbol, load_timestamp_utc, company_industry, company_sector, company_state FROM lw"""

SURROGATE_LOOKUP = f"""WITH {LATEST_WEEKLY},
{DIMS}
SELECT w.symbol, i.industry_id, s.sector_id, st.state_id
FROM lw w
LEFT JOIN industries i ON w.company_industry = i.industry_name
LEFT JOIN sectors s ON w.company_sector = s.sector_name
LEFT JOIN states st ON w.company_state = st.state_name"""

SCD_INTERVALS = f"""WITH w AS (
  SELECT CAST(user_id AS VARCHAR) AS symbol, ts AS load_timestamp_utc,
         regexp_replace(props, '[^0-9]', '', 'g') AS company_full_time_employees
  FROM events),
{DIMS}
SELECT c.company_id, w.company_full_time_employees, w.load_timestamp_utc AS load_timestamp_utc_from,
       LEAD(w.load_timestamp_utc, 1) OVER (PARTITION BY w.symbol ORDER BY w.load_timestamp_utc)
         AS load_timestamp_utc_to
FROM w LEFT JOIN companies c ON w.symbol = c.company_symbol"""
SCD_REFRESH = (SCD_INTERVALS.replace("SELECT c.company_id", "SELECT w.symbol, c.company_id")
               + " AND c.company_id % 5 <> 0")
DIM_COMPANIES = """SELECT c_custkey AS company_id, CAST(c_custkey AS VARCHAR) AS company_symbol, c_name AS company_name
FROM customer"""
DIM_INDUSTRIES = "SELECT CAST(s_suppkey AS BIGINT) AS industry_id, s_name AS industry_name FROM supplier"
FACT_VIEW = f"SELECT * FROM ({STAR_FACT}) WHERE company_id IS NOT NULL"

DIM_MARTS = """SELECT CAST(c_custkey AS INTEGER) AS state_id, 'N' || CAST(c_nationkey AS VARCHAR) AS state_symbol,
       c_name AS state_name FROM customer"""

SEED_DIMENSION = "SELECT CAST(p_partkey AS INTEGER) AS sector_id, trim(p_name) AS sector_name FROM part"

STG_DAILY = f"WITH {DAILY_LI} {stg_daily_sql('daily_li')}"
STG_DAILY_INCREMENTAL = f"""SELECT * FROM ({STG_DAILY}) WHERE load_timestamp_utc >
  (SELECT max(l_shipdate) FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01 00:00:00')"""
STG_WEEKLY = f"WITH {WEEKLY_CUST} {stg_weekly_sql('weekly_c')}"


def _second_run(rows: str, before: str, at: str = "") -> str:
    """Rows that two runs of a model leave: the even symbols' before a time, then those past the newest."""
    early = f"load_timestamp_utc < TIMESTAMP '{before}' AND CAST(symbol AS INTEGER) % 2 = 0"
    mine = early.replace("load_timestamp_utc", f"{at}load_timestamp_utc").replace("(symbol", f"({at}symbol")
    return f"({mine}) OR {at}load_timestamp_utc > (SELECT max(load_timestamp_utc) FROM {rows} WHERE {early})"


STG_WEEKLY_INCREMENTAL = f"""WITH {WEEKLY_ORD}
SELECT * FROM ({stg_weekly_sql('weekly_o')}) WHERE {_second_run('weekly_o', '1997-01-01 00:00:00')}"""
FACT_INCREMENTAL = f"{STAR_FACT}\nWHERE {_second_run('sd', '2024-01-20 00:00:00', 'd.')}"

SPLIT_PAIR = f"""WITH {DAILY_LI}
SELECT symbol, trim(split_part(bid, 'x', 1)) AS bid_price, trim(split_part(bid, 'x', 2)) AS bid_size,
       trim(split_part(ask, 'x', 1)) AS ask_price, trim(split_part(ask, 'x', 2)) AS ask_size,
       trim(split_part(day_range, '-', 1)) AS day_range_low,
       trim(split_part(day_range, '-', 2)) AS day_range_high
FROM daily_li"""

DATE_RANGE_PARSE = f"""WITH {DAILY_LI}
SELECT symbol,
  CASE WHEN trim(split_part(earnings_date, '-', 1)) IS NOT NULL
       THEN CAST(try_strptime(trim(split_part(earnings_date, '-', 1)), '%b %d, %Y') AS DATE) END
    AS earnings_date_min,
  CASE WHEN trim(split_part(earnings_date, '-', 2)) IS NOT NULL
       THEN CAST(try_strptime(trim(split_part(earnings_date, '-', 2)), '%b %d, %Y') AS DATE) END
    AS earnings_date_max
FROM daily_li"""

DROP_SUFFIX = f"""WITH {DAILY_LI}
SELECT symbol, left(intraday_market_cap, length(intraday_market_cap) - 1) AS intraday_market_cap_trillions
FROM daily_li"""

_SECOND = "trim(split_part(company_address, ',', 2))"
ADDRESS_PARTS = f"""WITH {WEEKLY_CUST}
SELECT symbol, trim(split_part(company_address, ',', 1)) AS company_street_address,
       split_part({_SECOND}, ' ', 1) AS company_city,
       split_part({_SECOND}, ' ', 2) AS company_state,
       COALESCE(split_part({_SECOND}, ' ', 3), '') AS company_zip_code,
       COALESCE(split_part({_SECOND}, ' ', 4), '') AS company_country
FROM weekly_c"""

DIGITS_ONLY = f"""WITH {WEEKLY_CUST}
SELECT symbol, regexp_replace(company_phone_number, '[^0-9]', '', 'g') AS company_phone_number,
       regexp_replace(company_full_time_employees, '[^0-9]', '', 'g') AS company_full_time_employees
FROM weekly_c"""

STRIP_PREFIX = f"""WITH {WEEKLY_CUST}
SELECT symbol, replace(company_description, 'Description   ', '') AS company_description,
       replace(company_corporate_governance_score, 'Corporate Governance   ', '')
         AS company_corporate_governance_score
FROM weekly_c"""

LOAD_DAY = """SELECT event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS load_timestamp_utc,
       strftime(CAST(date_trunc('day', ts) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS load_day_text
FROM events"""

SCHEMA_CAST = """SELECT o_orderkey, o_custkey,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(9,2)) AS o_totalprice,
       o_orderdate, left(o_orderpriority, 4) AS o_orderpriority,
       CAST(left(o_orderpriority, 1) AS INTEGER) AS priority_rank
FROM orders"""

CSV_POSITIONAL_SCAN = """SELECT o_orderkey AS orderkey, o_custkey AS custkey, o_orderstatus AS status,
       CAST(o_totalprice AS DECIMAL(12,2)) AS totalprice, o_orderdate AS orderdate,
       o_orderpriority || ', "' || o_orderstatus || '"' AS priority_note
FROM orders"""

CSV_QUOTED_SCAN = """SELECT o_orderkey AS orderkey, o_orderpriority || chr(10) || '"' || o_orderstatus || '",' ||
       chr(10) || chr(10) || CAST(o_custkey AS VARCHAR) AS note, o_orderstatus AS status FROM orders"""
TRUNCATE_LOAD = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
FROM orders WHERE o_orderkey % 3 <> 0"""
ARCHIVE_LOAD = TRUNCATE_LOAD.replace("o_orderkey % 3 <> 0", "o_orderkey % 2 = 1")

ORDERS_TYPED = """SELECT o_orderkey, o_custkey, o_orderstatus,
       CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, o_orderdate, o_orderpriority
FROM orders"""

LOAD_APPEND = f"{ORDERS_TYPED} WHERE o_orderkey % 2 = 0 UNION ALL {ORDERS_TYPED} WHERE o_orderkey % 3 = 0"
APPEND_KEYED = ORDERS_TYPED
LOAD_REPLACE = """SELECT o_orderkey, o_custkey, o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) + 1 AS DECIMAL(12,2)) AS o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderkey % 2 = 1"""
INCREMENTAL_APPEND = f"""{ORDERS_TYPED}
WHERE (o_orderdate < TIMESTAMP '2000-01-01 00:00:00' AND o_orderkey % 2 = 0)
   OR o_orderdate > (SELECT max(o_orderdate) FROM orders
                     WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00' AND o_orderkey % 2 = 0)"""

UPSERT_MERGE = """SELECT *, CAST(CASE WHEN o_orderstatus <> 'P' THEN year(o_orderdate) END AS INTEGER) AS order_year
FROM (SELECT o_orderkey, o_custkey, o_orderstatus,
       CAST(CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_totalprice AS DECIMAL(12,2)) + 1
                 ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS DECIMAL(12,2)) AS o_totalprice,
       CAST(CASE WHEN o_orderkey % 8 = 0 THEN o_orderdate + INTERVAL 400 DAY ELSE o_orderdate END AS TIMESTAMP) AS o_orderdate,
       o_orderpriority, '{"p":"' || o_orderpriority || '"}' AS note
FROM orders)"""

REFUSALS = """SELECT t.c AS "case", t.o AS outcome, (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0) AS rows_after
FROM (VALUES ('append of stored keys', 'KeyViolation'), ('replace by doubled keys', 'KeyViolation'),
             ('upsert of doubled keys', 'KeyViolation'), ('append of null keys', 'KeyViolation'),
             ('unknown operation', 'ValueError'), ('unknown scope', 'ValueError')) t(c, o)"""

HIGH_WATER_FILTER = """SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders
                     WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00')"""

SYMBOL_LIST = "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey IN (1, 3, 5, 24)"
SYMBOL_SUBSET = """SELECT c_custkey, c_name, c_nationkey FROM customer
WHERE c_custkey IN (SELECT user_id FROM events)"""

UNIQUE_CHECK = """SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

NULLABLE_LI = """li AS (SELECT l_orderkey, l_linenumber, nullif(l_suppkey, 1) AS l_suppkey,
                   nullif(l_returnflag, 'N') AS l_returnflag, l_shipdate FROM lineitem)"""


def _nulls(table: str, cols: list[str], prefix: str = "") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{prefix}{c}' AS {'check' if prefix else 'column_name'}, "
        f"CAST(count(*) - count({c}) AS BIGINT) AS {'violations' if prefix else 'null_count'} "
        f"FROM {table}" for c in cols)


NOT_NULL_CHECK = f"""WITH {NULLABLE_LI}
{_nulls('li', ['l_orderkey', 'l_linenumber', 'l_suppkey', 'l_returnflag', 'l_shipdate'])}"""


def _dups(table: str, key: str) -> str:
    return f"""SELECT 'duplicate_keys' AS "check", CAST(count(*) AS BIGINT) AS violations
  FROM (SELECT count(*) AS n FROM {table} GROUP BY {key} HAVING count(*) > 1)
UNION ALL
SELECT 'duplicate_rows' AS "check", CAST(COALESCE(sum(n), 0) AS BIGINT) AS violations
  FROM (SELECT count(*) AS n FROM {table} GROUP BY {key} HAVING count(*) > 1)"""


KEY_VIOLATIONS = f"""WITH {NULLABLE_LI},
lv AS ({_nulls('li', ['l_orderkey', 'l_linenumber', 'l_suppkey'], 'null:')}
  UNION ALL {_dups('li', 'l_orderkey, l_linenumber')}),
ov AS ({_nulls('orders', ['o_orderkey', 'o_custkey'], 'null:')}
  UNION ALL {_dups('orders', 'o_orderkey')})
SELECT 'lineitem' AS table_name, "check", violations FROM lv
UNION ALL
SELECT 'orders' AS table_name, "check", violations FROM ov"""

FRESHNESS_CHECK = """WITH g AS (
  SELECT event_type, max(ts) AS max_loaded_at,
         CAST(floor((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts))) / 1000000) AS BIGINT)
           AS age_seconds
  FROM events GROUP BY event_type)
SELECT event_type, max_loaded_at, age_seconds,
       CASE WHEN max_loaded_at IS NULL THEN 'error'
            WHEN age_seconds > 86400 THEN 'error'
            WHEN age_seconds > 43200 THEN 'warn'
            ELSE 'pass' END AS status
FROM g"""


def _decoded(expr: str) -> str:
    # HTML decodes the legacy entities with or without their closing ';'
    return (f"trim(regexp_replace(regexp_replace({expr}, '&quot;?', '\"', 'g'), "
            f"'&amp;?', '&', 'g'))")


_AD = ("CASE WHEN regexp_matches(html, '<div class=\"ad\">[^<]*</div>') THEN "
       + _decoded("regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1)") + " END")
_TITLE = ("CASE WHEN regexp_matches(html, '<h1>[^<]*</h1>') THEN "
          + _decoded("regexp_extract(html, '<h1>([^<]*)</h1>', 1)") + " END")
_THE = r"CASE WHEN regexp_matches(html, '<a[^>]*>\s*the\s*</a>') THEN 'the' END"

HTML_ATTR_EXTRACT = f"SELECT page_id, {_AD} AS ad_text FROM pages"
HTML_LABEL_EXTRACT = f"SELECT page_id, {_THE} AS the_link FROM pages"
HTML_RECORD_EXTRACT = f"SELECT page_id, {_TITLE} AS title, {_AD} AS ad_text, {_THE} AS the_link FROM pages"

PAGE_INGEST = f"""SELECT CAST(page_id AS VARCHAR) AS symbol,
  TIMESTAMP '2024-01-07 00:00:00' AS load_timestamp_utc,
  left({_TITLE}, 65535) AS title, left({_AD}, 65535) AS ad_text, left({_THE}, 65535) AS the_link
FROM pages"""
HTML_REJECTS = "SELECT page_id, 'empty page' AS error FROM pages WHERE page_id % 7 = 0 OR page_id % 11 = 0"


def _rule_values(fields: str) -> str:
    cols = [f"'{f}-' || CAST(page_id AS VARCHAR) || '-' || CAST(length(url) AS VARCHAR) AS {f}" for f in fields.split()]
    return f"SELECT page_id, {', '.join(cols)} FROM pages"


QUOTE_RULES = _rule_values("previous_close open_price bid ask day_range volume avg_volume intraday_market_cap beta "
                           "pe_ratio eps earnings_date forward_dividend_and_yield ex_dividend_date one_year_target_estimate")
PROFILE_RULES = _rule_values("company_name company_address company_phone_number company_website company_sector "
                             "company_industry company_full_time_employees company_description "
                             "company_corporate_governance_score")

_PAYLOAD = """'{"transaction_id":"T' || CAST(event_id AS VARCHAR)
  || '","customer_id":' || CAST(CAST(user_id AS INTEGER) AS VARCHAR)
  || ',"company_id":' || CAST(CAST(floor(value) AS INTEGER) AS VARCHAR)
  || ',"volume_traded":' || CAST(CAST(CAST(value AS DECIMAL(12,2)) * 100 AS INTEGER) AS VARCHAR)
  || ',"transaction_timestamp_utc":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '"}'"""

FRAME_SPLIT = f"""SELECT event_id,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS magic,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(100000 + user_id AS BIGINT) END AS schema_id,
  CASE WHEN event_type = 'error' THEN NULL ELSE {_PAYLOAD} END AS payload,
  CASE WHEN event_type = 'error' THEN 'bad magic byte' END AS frame_error
FROM events"""

_OK = "event_type <> 'error'"
STREAM_DECODE = f"""SELECT
  CASE WHEN {_OK} THEN 'T' || CAST(event_id AS VARCHAR) END AS transaction_id,
  CASE WHEN {_OK} THEN CAST(CAST(user_id AS INTEGER) AS VARCHAR) END AS customer_id,
  CASE WHEN {_OK} THEN CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) END AS company_id,
  CASE WHEN {_OK} AND event_id % 4 <> 0
       THEN CAST(CAST(CAST(value AS DECIMAL(12,2)) * 100 AS INTEGER) AS VARCHAR) END AS volume_traded,
  CASE WHEN {_OK} THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS transaction_timestamp_utc,
  CASE WHEN {_OK} AND event_id % 4 <> 0 THEN {_PAYLOAD}
       WHEN {_OK} THEN regexp_replace({_PAYLOAD}, ',"volume_traded":-?[0-9]+', '') END AS record_json,
  CASE WHEN {_OK} THEN NULL ELSE 'unknown schema id' END AS frame_error
FROM events"""

STREAM_UPSERT = f"""SELECT 'T' || CAST(event_id AS VARCHAR) AS transaction_id,
  CAST(user_id AS INTEGER) AS customer_id, CAST(floor(value) AS INTEGER) AS company_id,
  CAST(CAST(CAST(value AS DECIMAL(12,2)) * 100 AS INTEGER)
       + CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS volume_traded,
  CAST(date_trunc('second', ts) + CASE WHEN event_id % 3 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS TIMESTAMP)
    AS transaction_timestamp_utc
FROM events WHERE {_OK}"""

ORACLE: dict[str, str] = {
    "star_fact": STAR_FACT,
    "latest_snapshot": LATEST_SNAPSHOT,
    "surrogate_lookup": SURROGATE_LOOKUP,
    "scd_intervals": SCD_INTERVALS,
    "dim_marts": DIM_MARTS,
    "seed_dimension": SEED_DIMENSION,
    "stg_daily": STG_DAILY,
    "stg_weekly": STG_WEEKLY,
    "split_pair": SPLIT_PAIR,
    "date_range_parse": DATE_RANGE_PARSE,
    "drop_suffix": DROP_SUFFIX,
    "address_parts": ADDRESS_PARTS,
    "digits_only": DIGITS_ONLY,
    "strip_prefix": STRIP_PREFIX,
    "load_day": LOAD_DAY,
    "schema_cast": SCHEMA_CAST,
    "csv_positional_scan": CSV_POSITIONAL_SCAN,
    "csv_quoted_scan": CSV_QUOTED_SCAN,
    "truncate_load": TRUNCATE_LOAD,
    "load_append": LOAD_APPEND,
    "append_keyed": APPEND_KEYED,
    "load_replace": LOAD_REPLACE,
    "upsert_merge": UPSERT_MERGE,
    "upsert_partitioned": UPSERT_MERGE,
    "incremental_append": INCREMENTAL_APPEND,
    "high_water_filter": HIGH_WATER_FILTER,
    "symbol_subset": SYMBOL_SUBSET,
    "unique_check": UNIQUE_CHECK,
    "not_null_check": NOT_NULL_CHECK,
    "key_violations": KEY_VIOLATIONS,
    "freshness_check": FRESHNESS_CHECK,
    "html_attr_extract": HTML_ATTR_EXTRACT,
    "html_label_extract": HTML_LABEL_EXTRACT,
    "html_record_extract": HTML_RECORD_EXTRACT,
    "page_ingest": PAGE_INGEST,
    "scd_refresh": SCD_REFRESH,
    "frame_split": FRAME_SPLIT,
    "stream_decode": STREAM_DECODE,
    "stream_upsert": STREAM_UPSERT,
    "html_rejects": HTML_REJECTS,
    "dim_companies": DIM_COMPANIES,
    "dim_industries": DIM_INDUSTRIES,
    "dim_employees": SCD_INTERVALS,
    "fact_view": FACT_VIEW,
    "stg_daily_incremental": STG_DAILY_INCREMENTAL,
    "stg_weekly_incremental": STG_WEEKLY_INCREMENTAL,
    "fact_incremental": FACT_INCREMENTAL,
    "symbol_list": SYMBOL_LIST,
    "archive_load": ARCHIVE_LOAD,
    "newest_snapshot": TRUNCATE_LOAD,
    "refusals": REFUSALS,
    "quote_rules": QUOTE_RULES,
    "profile_rules": PROFILE_RULES,
}
