"""DuckDB text of the fixture views (see ``vitrina.sources.fixtures``).

Each oracle query starts with the CTEs it needs; the driver tables are
pre-registered views in DuckDB.
"""

from vitrina.sources.fixtures import KPI_ROWS, PRICE_ROWS

GIVEN = "CASE WHEN length(p_name) % 7 = 0 THEN 'Анна' ELSE split_part(p_name, ' ', 1) END"
TWICE = "JOIN range(2) copies(c) ON c = 0 OR l.l_orderkey % 50 = 0"


def _values(rows, types) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if t == "VARCHAR" else f"CAST({v} AS {t})" for v, t in zip(r, types)) + ")"
                     for r in rows)


FX_POSTS = r"""
fx_posts AS (
  SELECT """ + GIVEN + r""" || ' ' || split_part(p_name, ' ', 2) AS author,
         CASE WHEN l.l_orderkey % 89 <> 0 THEN CAST(l.l_shipdate AS DATE) END AS release_date,
         CASE WHEN l.l_linenumber = 1 THEN ''
              ELSE CAST(CAST(floor(l.l_extendedprice) AS INTEGER) AS VARCHAR) END AS tiktok_reach,
         CASE WHEN l.l_linestatus = 'O' THEN 'http://v/' || CAST(l.l_orderkey AS VARCHAR)
              WHEN l.l_returnflag = 'A' THEN 'Дубай'
              ELSE '' END AS tiktok_video_link,
         CASE WHEN l.l_linenumber = 2 THEN ''
              ELSE CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) END AS youtube_reach,
         CAST(CAST(l.l_quantity * 10 AS INTEGER) AS VARCHAR) AS instagram_reach,
         '' AS likee_video_link,
         CAST(CAST(l.l_suppkey AS INTEGER) AS VARCHAR) AS likee_reach,
         'Отчет ' || l.l_returnflag AS account_name,
         strftime(l.l_shipdate, '%Y-%m') AS sheets_name
  FROM lineitem l """ + TWICE + r""" JOIN part p ON l.l_partkey = p.p_partkey
)"""

FX_ROSTER = r"""
fx_roster AS (
  SELECT DISTINCT
         split_part(p_name, ' ', 2) || ' ' || """ + GIVEN + r""" || ' X' AS blogger,
         CASE WHEN c = 1 THEN 'r2' ELSE 'r' END AS region,
         CASE WHEN c = 0 AND length(p_name) % 2 = 0 THEN 'RUB' ELSE 'BYN' END AS currency,
         CASE WHEN c = 1 OR length(p_name) % 3 = 0 THEN 'A' ELSE 'B' END AS grade,
         CASE WHEN c = 0 AND length(p_name) % 2 = 0 THEN 'TRUE' ELSE 'FALSE' END AS is_state,
         CASE WHEN c = 1 THEN 'second' ELSE 'contract' END AS contract
  FROM part JOIN range(2) copies(c) ON c = 0 OR length(p_name) % 5 = 0
)"""

FX_KPI = f"""
fx_kpi(grade, currency, start_reach, end_reach, tiktok, instagram, youtube, likee) AS (
  VALUES {_values(KPI_ROWS, ["VARCHAR"] * 2 + ["DECIMAL(12,1)"] * 2 + ["DECIMAL(10,2)"] * 4)}
)"""

FX_PRICE = f"""
fx_price(grade, currency, start_count, end_count, price) AS (
  VALUES {_values(PRICE_ROWS, ["VARCHAR"] * 2 + ["INTEGER"] * 2 + ["DECIMAL(10,2)"])}
)"""

FX_BUDGET = r"""
fx_budget AS (
  SELECT CASE WHEN user_id % 10 = 7 AND event_id % 97 <> 0 OR user_id % 10 <> 7 AND (event_id % 53 <> 0 OR event_id % 97 = 0)
              THEN event_id END AS id,
         event_type AS social_network,
         CASE WHEN event_id * 10 >= (SELECT count(*) FROM events) * 9 AND event_id % 100 = 0
              THEN 'БЮДЖЕТ ' ELSE 'link' END AS social_link,
         CASE WHEN event_id % 50 = 0 THEN 'p-' || (CASE WHEN event_id % 150 = 0 THEN 'tsh01'
                                                       WHEN event_id % 150 = 50 THEN 'lmb02'
                                                       ELSE 'zzz03' END) || '-x'
              WHEN event_id % 71 = 0 THEN NULL
              ELSE 'person ' || CAST(user_id AS VARCHAR) END AS responsible_person,
         CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || chr(160) || '000,5' AS price,
         CASE WHEN event_id % 7 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) || ' 1,25' END AS product_cost,
         '1 ' || CAST(user_id + 100 AS VARCHAR) AS actual_reach,
         CASE WHEN event_type = 'error' THEN '#DIV/0!' ELSE '3,5' END AS actual_cpm,
         CASE WHEN event_id % 97 = 0 THEN 'Итого Безнал' ELSE '1' END AS reach,
         CASE WHEN event_type IN ('click', 'purchase') THEN 'TRUE' ELSE 'FALSE' END AS is_integration,
         'r' AS region,
         'f' AS format,
         CASE WHEN user_id % 10 = 7 THEN 'Май 2025' WHEN user_id % 2 = 0 THEN 'Апрель 2025' ELSE 'Март 2025' END AS sheets_name
  FROM events
)"""

FX_PROFIT = r"""
fx_profit AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS id,
         l.l_shipdate AS date_data,
         p.p_name AS name,
         CASE WHEN p.p_size = 1 THEN '' ELSE p.p_brand END AS article,
         CAST(CASE WHEN l.l_returnflag = 'N' THEN l.l_quantity ELSE 0 END AS DECIMAL(18,3)) AS sellQuantity,
         CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(18,3)) AS sellSum,
         CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * 0.5 AS DECIMAL(18,3)) AS sellCostSum,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN l.l_quantity ELSE 0 END AS DECIMAL(18,3)) AS returnQuantity,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_extendedprice AS DECIMAL(18,2)) ELSE 0 END
              AS DECIMAL(18,3)) AS returnSum,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_extendedprice AS DECIMAL(18,2)) * 0.5 ELSE 0 END
              AS DECIMAL(18,3)) AS returnCostSum,
         CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * 0.3 AS DECIMAL(18,3)) AS profit
  FROM lineitem l """ + TWICE + r""" JOIN part p ON l.l_partkey = p.p_partkey
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)
