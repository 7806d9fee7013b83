"""SQL equivalents of the registered queries for a second engine over the same tables."""

from __future__ import annotations

from tallyloom.plans import catalog, star_schema as star

_TS = "%Y-%m-%d %H:%M:%S"
_RAW_COLUMNS = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country"


def _raw(country: str = "lower(n_name)") -> str:
    return f"""
        SELECT concat(CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END, CAST(o_orderkey AS VARCHAR)) AS InvoiceNo,
               CAST(l_partkey AS VARCHAR) AS StockCode,
               CASE WHEN p_partkey % 53 = 0 THEN NULL
                    ELSE p_name || ' ' || p_type || ' ' || p_brand END AS Description,
               CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INTEGER) AS Quantity,
               CASE WHEN o_orderkey % 97 = 0 THEN 'not-a-date'
                    ELSE strftime(o_orderdate + to_hours(CAST(6 + o_orderkey % 16 AS BIGINT)), '{_TS}')
               END AS InvoiceDate,
               CASE WHEN p_partkey % 101 = 0 THEN 0.0e0 ELSE p_retailprice END AS UnitPrice,
               CASE WHEN o_orderkey % 50 = 7 THEN NULL WHEN o_orderkey % 50 = 8 THEN '  '
                    ELSE CAST(o_custkey AS VARCHAR) || '.0' END AS CustomerID,
               concat(CASE WHEN o_orderkey % 11 = 0 THEN '  ' ELSE '' END, {country}) AS Country
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN part ON l_partkey = p_partkey"""


def _trimmed(country: str, where: str) -> str:
    return f"""
        SELECT * FROM (
            SELECT trim(InvoiceNo) AS InvoiceNo, trim(StockCode) AS StockCode,
                   trim(Description) AS Description, Quantity, trim(InvoiceDate) AS InvoiceDate, UnitPrice,
                   trim(CustomerID) AS CustomerID, {country} AS Country,
                   try_strptime(trim(InvoiceDate), '{_TS}') AS InvoiceTS
            FROM raw WHERE {where})
        WHERE InvoiceTS IS NOT NULL AND NOT starts_with(InvoiceNo, 'C') AND Quantity > 0 AND UnitPrice > 0"""


_NORMALIZED = "CAST(TRY_CAST(TRY_CAST({} AS DOUBLE) AS BIGINT) AS VARCHAR)"


def _rfm(source: str, reference: str | None = None, extra: str = "") -> str:
    reference = reference or f"(SELECT max(InvoiceTS) FROM {source})"
    return f"""
        SELECT CustomerID, max(InvoiceTS) AS LastPurchaseTS,
               CAST(count(DISTINCT InvoiceNo) AS BIGINT) AS Frequency, sum(TotalAmount) AS Monetary, {extra}
               CAST(sum(Quantity) AS BIGINT) AS Sum_Qty,
               CAST(date_diff('day', CAST(max(InvoiceTS) AS DATE), CAST({reference} AS DATE)) AS INTEGER)
                   AS Recency
        FROM {source} GROUP BY CustomerID"""


def _segments(rfm: str) -> str:
    return f"""
        SELECT CustomerID, Recency, Frequency, Monetary,
               CAST((SELECT count(DISTINCT b.c_mktsegment) FROM customer b
                     WHERE b.c_mktsegment < customer.c_mktsegment) AS INTEGER) AS Cluster,
               c_mktsegment AS Segment
        FROM {rfm} JOIN customer ON CustomerID = CAST(c_custkey AS VARCHAR) || '.0'"""


def _cohort(source: str) -> str:
    return f"""
        SELECT s.*, strftime(first_ts, '%Y-%m') AS CohortMonth,
               CAST((year(InvoiceTS) - year(first_ts)) * 12 + month(InvoiceTS) - month(first_ts) + 1 AS INTEGER)
                   AS CohortIndex
        FROM {source} s
        JOIN (SELECT CustomerID, min(InvoiceTS) AS first_ts FROM {source} GROUP BY CustomerID) f
        ON s.CustomerID = f.CustomerID"""


def _cells(source: str) -> str:
    return f"""
        SELECT CohortMonth, CohortIndex, CAST(count(DISTINCT CustomerID) AS BIGINT) AS Customers
        FROM ({_cohort(source)}) GROUP BY ALL"""


_CTES = {
    "raw": _raw(),
    "clean": _trimmed("upper(trim(Country))", "Description IS NOT NULL AND CustomerID IS NOT NULL"),
    "sales": "SELECT *, Quantity * UnitPrice AS TotalAmount FROM clean",
    "minimal": f"""
        SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID,
               upper(Country) AS Country
        FROM raw WHERE Description IS NOT NULL AND CustomerID IS NOT NULL AND Quantity > 0""",
    "dash": f"""
        SELECT {_RAW_COLUMNS}, InvoiceTS, Quantity * UnitPrice AS TotalAmount,
               strftime(InvoiceTS, '%Y-%m') AS MonthStr, dayname(InvoiceTS) AS DayOfWeek,
               CAST(hour(InvoiceTS) AS INTEGER) AS Hour
        FROM (SELECT *, try_strptime(InvoiceDate, '{_TS}') AS InvoiceTS FROM raw
              WHERE CustomerID IS NOT NULL AND Quantity > 0)""",
    "picked": f"""
        SELECT * FROM dash WHERE CAST(InvoiceTS AS DATE) BETWEEN DATE '{catalog.FILTER_START}'
        AND DATE '{catalog.FILTER_END}' AND Country IN ({", ".join(f"'{c}'" for c in catalog.FILTER_COUNTRIES)})""",
    "event_sales": """
        SELECT CAST(user_id AS VARCHAR) AS InvoiceNo, 1 AS Quantity, ts AS InvoiceTS, "value" AS TotalAmount
        FROM events""",
    "basic": f"SELECT *, Quantity * UnitPrice AS TotalAmount FROM ({_trimmed('trim(Country)', 'true')}) WHERE CustomerID <> ''",
    "basic_rfm": _rfm("basic"),
    "regions": f"""
        SELECT upper(n_name) AS Country, r_name AS Region FROM nation JOIN region ON n_regionkey = r_regionkey
        WHERE r_name <> '{star.UNMAPPED_REGION}'""",
    "rfm": _rfm("sales"),
    "segs": _segments("rfm"),
    "spend": f"""
        SELECT {_NORMALIZED.format('CustomerID')} AS CustomerID, sum(TotalAmount) AS TotalAmount,
               CAST(count(DISTINCT InvoiceNo) AS BIGINT) AS Invoices
        FROM sales GROUP BY 1 HAVING {_NORMALIZED.format('CustomerID')} IS NOT NULL""",
    "nsegs": f"SELECT * REPLACE ({_NORMALIZED.format('CustomerID')} AS CustomerID) FROM segs",
    "insight": """
        SELECT s.CustomerID, s.TotalAmount, s.Invoices, n.Recency, n.Frequency, n.Monetary, n.Cluster, n.Segment
        FROM spend s JOIN nsegs n ON s.CustomerID = n.CustomerID""",
    "old_sales": f"SELECT * FROM sales WHERE InvoiceTS < TIMESTAMP '{catalog.STORE_UNTIL}'",
    "new_sales": f"SELECT * FROM sales WHERE InvoiceTS >= TIMESTAMP '{catalog.STORE_UNTIL}'",
    "old_rfm": _rfm("old_sales"),
    "new_rfm": _rfm("new_sales"),
    "old_store": _segments("old_rfm"),
    "new_store": _segments("new_rfm"),
    "cohort": _cohort("sales"),
    "cells": _cells("sales"),
    "retention": """
        SELECT CohortMonth, CohortIndex, Customers,
               max(CASE WHEN CohortIndex = 1 THEN Customers END) OVER (PARTITION BY CohortMonth) AS CohortSize,
               round(Customers / (max(CASE WHEN CohortIndex = 1 THEN Customers END)
                     OVER (PARTITION BY CohortMonth))::DOUBLE, 6) AS Retention
        FROM cells""",
    "codes": """
        SELECT Country, CAST(row_number() OVER (ORDER BY count(*) DESC, Country) - 1 AS DOUBLE) AS Country_Encoded
        FROM sales WHERE Country IS NOT NULL GROUP BY Country""",
    "modular": f"""
        SELECT s.InvoiceNo, s.StockCode, s.Description, CAST(s.Quantity AS DOUBLE) AS Quantity, s.InvoiceDate,
               s.InvoiceTS, s.UnitPrice, s.CustomerID, s.Country, c.Country_Encoded,
               coalesce(r.Region, 'Other') AS Region, s.TotalAmount,
               round((s.Quantity - st.lo) / (st.hi - st.lo)::DOUBLE, 6) AS Quantity_Normalized,
               round((s.UnitPrice - st.mean) / st.std, 6) AS UnitPrice_Standardized
        FROM sales s JOIN codes c ON s.Country = c.Country LEFT JOIN regions r ON s.Country = r.Country,
             (SELECT min(Quantity) AS lo, max(Quantity) AS hi, avg(UnitPrice) AS mean,
                     stddev_samp(UnitPrice) AS std FROM sales) st""",
    "mapped": """
        SELECT m.*, coalesce(r.Region, 'Other') AS Region
        FROM minimal m LEFT JOIN regions r ON m.Country = r.Country""",
    "region_codes": """
        SELECT Region, CAST(row_number() OVER (ORDER BY count(*) DESC, Region) - 1 AS DOUBLE) AS Region_Encoded
        FROM mapped GROUP BY Region""",
    "monolith": """
        SELECT m.InvoiceNo, m.StockCode, m.Description, CAST(m.Quantity AS DOUBLE) AS Quantity, m.InvoiceDate,
               m.UnitPrice, m.CustomerID, m.Country, m.Region, c.Region_Encoded,
               CAST(m.Quantity * m.UnitPrice AS DOUBLE) AS TotalAmount
        FROM mapped m JOIN region_codes c ON m.Region = c.Region""",
    "scaled": """
        SELECT Cluster AS c, (Recency - mr) / sr AS x, (Frequency - mf) / sf AS y, (Monetary - mm) / sm AS z
        FROM segs, (SELECT avg(Recency) AS mr, stddev_pop(Recency) AS sr, avg(Frequency) AS mf,
                           stddev_pop(Frequency) AS sf, avg(Monetary) AS mm, stddev_pop(Monetary) AS sm FROM segs)""",
    "homes": f"""
        SELECT {_NORMALIZED.format('CustomerID')} AS CustomerID,
               arg_min(Country, row(InvoiceTS, InvoiceNo, StockCode)) AS Country FROM sales GROUP BY 1""",
    "centres": "SELECT c, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz, count(*) AS n FROM scaled GROUP BY c",
    "spreads": """
        SELECT c, cx, cy, cz, avg(sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy) + (z - cz) * (z - cz))) AS s
        FROM scaled JOIN centres USING (c) GROUP BY ALL""",
    "tags": """
        SELECT *,
               list_bool_or([coalesce(starts_with(v, ' ') OR ends_with(v, ' '), false) FOR v IN
                   [InvoiceNo, StockCode, Description, InvoiceDate, CustomerID, Country]]) AS t_trim,
               coalesce(starts_with(InvoiceNo, 'C'), false) AS t_cancel,
               length(coalesce(InvoiceDate, '')) < 19 OR NOT contains(coalesce(InvoiceDate, ''), '-')
                   OR NOT contains(coalesce(InvoiceDate, ''), ':') AS t_date,
               coalesce(Quantity, 0) <= 0 OR coalesce(UnitPrice, 0) <= 0 AS t_value,
               trim(coalesce(CustomerID, '')) = '' AS t_customer
        FROM raw""",
    "tagged": "".join(
        f"\n        {'UNION ALL ' if i else ''}SELECT '{name}' AS category, {_RAW_COLUMNS} FROM tags WHERE {flag}"
        for i, (name, flag) in enumerate(
            {
                "trim": "t_trim",
                "cancel": "t_cancel",
                "invalid_date": "t_date",
                "invalid_values": "t_value",
                "null_customer": "t_customer",
                "normal": "NOT (t_trim OR t_cancel OR t_date OR t_value OR t_customer)",
            }.items()
        )
    ),
}


def _needs(sql: str, available: list[str]) -> set[str]:
    words = set(sql.replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split())
    return {name for name in available if name in words}


def _with(body: str, raw: str = _CTES["raw"]) -> str:
    """``body`` preceded by the named frames it uses, directly or through another frame."""
    ctes = {**_CTES, "raw": raw}
    wanted, todo = set(), _needs(body, list(ctes))
    while todo:
        name = todo.pop()
        wanted.add(name)
        todo |= _needs(ctes[name], list(ctes)) - wanted
    frames = [f"{name} AS ({ctes[name]})" for name in ctes if name in wanted]
    more = body.lstrip()
    if more.startswith("WITH "):  # the body names frames of its own
        return "WITH " + ",\n".join(frames) + ",\n" + more.removeprefix("WITH ")
    return "WITH " + ",\n".join(frames) + "\n" + body if frames else body


_MONTH = "strftime(InvoiceTS, '%Y-%m')"
_REVENUE = "round(sum(TotalAmount), 2)"
_INVOICES = "CAST(count(DISTINCT InvoiceNo) AS BIGINT)"
_ITEMS = "CAST(sum(Quantity) AS BIGINT)"
_NULLS_FIRST = ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in _RAW_COLUMNS.split(","))


def _mean(column: str) -> str:
    return f"CAST(round(CAST(avg({column}) AS DECIMAL(18, 6)), 2) AS DOUBLE)"


def _share(status: str, part: str, whole: str) -> str:
    return f"SELECT '{status}' AS status, CAST({part} AS BIGINT) AS lines, round({part} * 100.0e0 / {whole}, 6) AS share_pct"


def _missing() -> str:
    rows = [
        f"""SELECT '{c}' AS column_name, CAST(count(*) FILTER ({c} IS NULL) AS BIGINT) AS missing_count,
               round(count(*) FILTER ({c} IS NULL) * 100.0e0 / count(*), 2) AS missing_pct FROM raw"""
        for c in _RAW_COLUMNS.split(", ")
    ]
    return " UNION ALL ".join(rows)


def _summary() -> str:
    rows = [
        f"""SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS "count", round(avg({c}), 2) AS mean,
               round(stddev_samp({c}), 2) AS std, round(CAST(min({c}) AS DOUBLE), 2) AS "min",
               round(CAST(quantile_cont({c}, 0.25) AS DOUBLE), 2) AS p25,
               round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 2) AS p50,
               round(CAST(quantile_cont({c}, 0.75) AS DOUBLE), 2) AS p75,
               round(CAST(max({c}) AS DOUBLE), 2) AS "max" FROM dash"""
        for c in ("Quantity", "UnitPrice", "TotalAmount")
    ]
    return " UNION ALL ".join(rows)


def _domain(source: str, defaults: list[str]) -> str:
    listed = ", ".join(f"'{d}'" for d in defaults)
    return f"""
        SELECT Country,
               CASE WHEN (SELECT bool_or(Country IN ({listed})) FROM {source}) THEN Country IN ({listed})
                    ELSE Country IN (SELECT DISTINCT Country FROM {source} ORDER BY 1 LIMIT 5) END AS is_default,
               (SELECT CAST(min(InvoiceTS) AS DATE) FROM {source}) AS min_date,
               (SELECT CAST(max(InvoiceTS) AS DATE) FROM {source}) AS max_date
        FROM (SELECT DISTINCT Country FROM {source}) AS countries"""


def _export(name: str) -> str:
    return f"""SELECT '{name}' AS export, Region, CAST(count(*) AS BIGINT) AS lines,
        CAST(count(DISTINCT InvoiceNo) AS BIGINT) AS invoices, {_ITEMS} AS quantity, {_REVENUE} AS amount
        FROM {name} GROUP BY Region"""


# The regions of the 45 mapped countries.
_REGION_PAIRS = """
    ('UNITED KINGDOM', 'Europe'), ('GERMANY', 'Europe'), ('FRANCE', 'Europe'), ('SPAIN', 'Europe'), ('PORTUGAL', 'Europe'),
    ('ITALY', 'Europe'), ('SWITZERLAND', 'Europe'), ('BELGIUM', 'Europe'), ('NETHERLANDS', 'Europe'), ('EIRE', 'Europe'),
    ('ICELAND', 'Europe'), ('CHANNEL ISLANDS', 'Europe'), ('CYPRUS', 'Europe'), ('NORWAY', 'Europe'), ('POLAND', 'Europe'),
    ('SWEDEN', 'Europe'), ('DENMARK', 'Europe'), ('AUSTRIA', 'Europe'), ('IRELAND', 'Europe'), ('ALBANIA', 'Europe'),
    ('FINLAND', 'Europe'), ('GREECE', 'Europe'), ('CZECH REPUBLIC', 'Europe'), ('MALTA', 'Europe'),
    ('LUXEMBOURG', 'Europe'), ('HUNGARY', 'Europe'), ('JAPAN', 'Asia'), ('SAUDI ARABIA', 'Asia'), ('LEBANON', 'Asia'),
    ('HONG KONG', 'Asia'), ('SINGAPORE', 'Asia'), ('BAHRAIN', 'Asia'), ('MALAYSIA', 'Asia'),
    ('UNITED ARAB EMIRATES', 'Asia'), ('ISRAEL', 'Asia'), ('KOREA, REPUBLIC OF', 'Asia'), ('USA', 'North America'),
    ('CANADA', 'North America'), ('COSTA RICA', 'North America'), ('BRAZIL', 'South America'),
    ('ARGENTINA', 'South America'), ('RSA', 'Africa'), ('KENYA', 'Africa'), ('EGYPT', 'Africa'), ('AUSTRALIA', 'Oceania')"""
_REGION_CASE = f"""
    SELECT Country, coalesce(r, 'Other') AS Region, CAST(count(*) AS BIGINT) AS lines
    FROM clean LEFT JOIN (VALUES {_REGION_PAIRS}) AS pairs(c, r) ON Country = c GROUP BY 1, 2"""

# One column for each cohort index that the tables hold.
_WIDE = """
    SELECT * FROM (PIVOT (SELECT CohortMonth, 'm' || CohortIndex AS cell, Retention FROM retention)
                   ON cell USING max(Retention) GROUP BY CohortMonth)"""


def _basket(source: str, key: str, name: str, where: str = "true") -> str:
    return f"""SELECT {key} AS {name}, {_REVENUE} AS TotalAmount, {_INVOICES} AS Invoices,
        round(sum(TotalAmount) / count(DISTINCT InvoiceNo), 6) AS AvgBasketSize
        FROM {source} WHERE {where} GROUP BY 1"""


def _hourly(source: str) -> str:
    return f"""
        SELECT lpad(CAST(hour(InvoiceTS) AS VARCHAR), 2, '0') || ':00' AS Hour, {_REVENUE} AS Total_Sales,
               {_INVOICES} AS Transactions, hour(InvoiceTS) BETWEEN 10 AND 15 AS is_peak
        FROM {source} GROUP BY hour(InvoiceTS)"""


def _moving_average(source: str) -> str:
    return f"""
        SELECT d AS Date, t AS Transactions,
               CASE WHEN count(*) OVER w = 7 THEN round(avg(t) OVER w, 6) END AS MA7
        FROM (SELECT CAST(InvoiceTS AS DATE) AS d, {_INVOICES} AS t FROM {source} GROUP BY 1)
        WINDOW w AS (ORDER BY d ROWS 6 PRECEDING)"""


def _kpi(source: str) -> str:
    return f"""
        SELECT {_REVENUE} AS revenue,
               CAST((SELECT sum(t) FROM (SELECT count(DISTINCT InvoiceNo) AS t FROM {source}
                     GROUP BY dayname(InvoiceTS))) AS BIGINT) AS weekday_transactions,
               {_INVOICES} AS transactions, {_ITEMS} AS items_sold
        FROM {source}"""


def _run_summary(rfm: str) -> str:
    return f"""SELECT CustomerID, Recency, CAST(Frequency AS INTEGER) AS Frequency,
        round(Monetary, 2) AS Monetary, true AS is_labelled FROM {rfm} WHERE trim(CustomerID) <> ''"""


_CHURN = """
    SELECT CustomerID, Recency, round(Monetary, 2) AS Monetary, round(t, 6) AS Threshold,
           CASE WHEN Recency > 90 AND Monetary > t THEN '{lapsed}'
                WHEN Recency > 90 AND Monetary <= t THEN '{ordinary}'
                WHEN Recency <= 90 AND Monetary > t THEN '{active}' ELSE '{safe}' END AS RiskStatus
    FROM insight, (SELECT quantile_cont(Monetary, 0.75) AS t FROM insight)"""

_VIP = "(SELECT Segment FROM insight GROUP BY Segment ORDER BY avg(Monetary) DESC, Segment LIMIT 1)"

_FLAT = "SELECT CustomerID, Recency, CAST(Frequency AS INTEGER) AS Frequency, round(Monetary, 2) AS Monetary, Cluster, Segment FROM segs"

_BOX = """
    SELECT Segment, round(p25, 2) AS q1, round(p50, 2) AS median, round(p75, 2) AS q3,
           round(min(Monetary) FILTER (inside), 2) AS whisker_low,
           round(max(Monetary) FILTER (inside), 2) AS whisker_high,
           CAST(count(*) FILTER (NOT inside) AS BIGINT) AS outliers
    FROM (SELECT *, Monetary BETWEEN p25 - (p75 - p25) * 1.5e0 AND p75 + (p75 - p25) * 1.5e0 AS inside
          FROM segs JOIN (SELECT Segment, quantile_cont(Monetary, 0.25) AS p25, quantile_cont(Monetary, 0.5) AS p50,
                                 quantile_cont(Monetary, 0.75) AS p75 FROM segs GROUP BY Segment) USING (Segment))
    GROUP BY Segment, p25, p50, p75"""

_DAVIES = """
    SELECT round(avg(worst), 6) AS score
    FROM (SELECT a.c, max((a.s + b.s) / sqrt((a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy)
                          + (a.cz - b.cz) * (a.cz - b.cz))) AS worst
          FROM spreads a JOIN spreads b ON a.c <> b.c GROUP BY a.c)"""
_CALINSKI = """
    SELECT round((b / (k - 1)) / (w / (total - k)), 6) AS score
    FROM (SELECT sum(n * (cx * cx + cy * cy + cz * cz)) AS b, count(*) AS k, sum(n) AS total FROM centres),
         (SELECT sum((x - cx) * (x - cx) + (y - cy) * (y - cy) + (z - cz) * (z - cz)) AS w
          FROM scaled JOIN centres USING (c))"""

_SCORE = "round(avg(CASE WHEN a IS NULL THEN 0 WHEN greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS score"
# The mean squared distance of a customer to a segment, from the segment's count, sums and sum of squares.
_SILHOUETTE = f"""
    SELECT {_SCORE}
    FROM (SELECT min(CASE WHEN s.c = p.c AND s.n > 1 THEN gap * s.n / (s.n - 1) END) AS a, min(gap) FILTER (s.c <> p.c) AS b
          FROM (SELECT *, row_number() OVER () AS r FROM scaled) p,
               (SELECT c, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(z) AS sz, sum(x * x + y * y + z * z) AS q
                FROM scaled GROUP BY c) s,
               LATERAL (SELECT p.x * p.x + p.y * p.y + p.z * p.z + (s.q - 2 * (p.x * s.sx + p.y * s.sy + p.z * s.sz)) / s.n AS gap)
          GROUP BY p.r)"""
_EUCLIDEAN = f"""
    WITH placed AS (
        SELECT CustomerID, Cluster AS c, (Recency - mr) / sr AS x, (Frequency - mf) / sf AS y, (Monetary - mm) / sm AS z
        FROM segs, (SELECT avg(Recency) AS mr, stddev_pop(Recency) AS sr, avg(Frequency) AS mf, stddev_pop(Frequency) AS sf,
                           avg(Monetary) AS mm, stddev_pop(Monetary) AS sm FROM segs))
    SELECT {_SCORE}
    FROM (SELECT CustomerID, min(CASE WHEN own AND others > 0 THEN total / others END) AS a, min(total / n) FILTER (NOT own) AS b
          FROM (SELECT p.CustomerID, p.c = m.c AS own, count(*) AS n,
                       count(*) - max(CASE WHEN p.c = m.c THEN 1 ELSE 0 END) AS others,
                       sum(sqrt((p.x - m.x) ** 2 + (p.y - m.y) ** 2 + (p.z - m.z) ** 2)) AS total
                FROM placed p CROSS JOIN placed m GROUP BY p.CustomerID, p.c, m.c)
          GROUP BY CustomerID)"""

_CLUSTERED = """SELECT CustomerID, CAST(Recency AS DOUBLE) AS Recency, CAST(Frequency AS DOUBLE) AS Frequency,
    round(Monetary, 2) AS Monetary, true AS is_nearest, true AS label_fits FROM rfm WHERE trim(CustomerID) <> ''"""
_NAMED = "(SELECT CAST(count(*) AS BIGINT) FROM rfm WHERE trim(CustomerID) <> '') AS customers"


def oracle_sql() -> dict[str, str]:
    risk = {
        "lapsed": "⚠️ MANTAN VIP (Risiko Tinggi Hilang)",
        "ordinary": "Churn Biasa",
        "active": "VIP Aktif",
        "safe": "Aman / Belanja Kecil",
    }
    n = _NORMALIZED.format("CustomerID")
    days = "('Monday', 1), ('Tuesday', 2), ('Wednesday', 3), ('Thursday', 4), ('Friday', 5), ('Sunday', 6)"
    names = ", ".join(f"'{c}'" for c in star.REAL_COUNTRIES)
    dow = f"SELECT dayname(InvoiceTS) AS Day, {_REVENUE} AS Total_Sales, {_INVOICES} AS Transactions FROM sales GROUP BY 1"
    bodies = {
        "src_csv_fixed": "SELECT * FROM raw",
        "src_csv_latin1": "SELECT * FROM raw",
        "src_csv_multiline": """
            SELECT * REPLACE (CASE WHEN CAST(StockCode AS INTEGER) % 2 = 1
                                   THEN '"' || replace(Description, ' ', chr(10)) || '",' || chr(10)
                                   ELSE Description END AS Description) FROM raw""",
        "src_csv_inferred": "SELECT * REPLACE (CAST(StockCode AS INTEGER) AS StockCode) FROM raw",
        "export_csv_modular": "SELECT * FROM modular",
        "export_csv_minimal": "SELECT * FROM monolith",
        "export_csv_roundtrip": f"{_export('modular')} UNION ALL {_export('minimal')}".replace(
            "FROM minimal", "FROM monolith"
        ),
        "segments_flatten": _FLAT,
        "segments_documents": """
            SELECT CustomerID AS _id, Recency AS rfm_recency, CAST(Frequency AS INTEGER) AS rfm_frequency,
                   round(Monetary, 2) AS rfm_monetary, Cluster AS segment_cluster_id, Segment AS segment_label
            FROM segs""",
        "rfm_kmeans": _CLUSTERED,
        "kmeans_rfm3": _CLUSTERED,
        "kmeans_metrics": f"""
            SELECT 4 AS k, {_NAMED}, true AS sse_fits, true AS silhouette_fits, true AS davies_bouldin_fits,
                   true AS calinski_harabasz_fits""",
        "cluster_centroids": "SELECT 'Segment-' || i AS Segment, true AS is_mean FROM range(4) t(i)",
        "cluster_sizes": f"SELECT CAST(4 AS BIGINT) AS segments, true AS none_empty, {_NAMED}",
        "vip_share_by_country_wide": f"""
            SELECT Country, {", ".join(f"coalesce(max(SharePct) FILTER (Segment = '{s}'), 0.0e0) AS {s}" for s in star.SEGMENTS)}
            FROM (SELECT Country, Segment, round(Customers * 100.0e0 / sum(Customers) OVER (PARTITION BY Country), 6) AS SharePct
                  FROM (SELECT Country, Segment, CAST(count(*) AS BIGINT) AS Customers
                        FROM homes JOIN insight USING (CustomerID) GROUP BY 1, 2)
                  WHERE Country IN (SELECT Country FROM homes JOIN insight USING (CustomerID)
                                    GROUP BY Country ORDER BY count(*) DESC, Country LIMIT 10))
            GROUP BY Country""",
        "segments_upsert": f"""
            {_FLAT.replace("FROM segs", "FROM new_store")} UNION ALL
            {_FLAT.replace("FROM segs", "FROM old_store")}
            WHERE CustomerID NOT IN (SELECT CustomerID FROM new_store)""",
        "clean_modular": "SELECT * FROM clean",
        "clean_basic": "SELECT * EXCLUDE (TotalAmount) FROM basic",
        "clean_basic_keep_null_customer": _trimmed("trim(Country)", "true"),
        "clean_minimal": "SELECT * FROM minimal",
        "clean_dashboard": "SELECT * FROM dash",
        "cleaning_loss_report": """
            SELECT a AS rows_before, p AS rows_after, a - p AS rows_removed,
                   round((a - p) * 100.0e0 / a, 6) AS removed_pct, c AS rows_consistent
            FROM (SELECT CAST(count(*) AS BIGINT) AS a,
                         CAST(count(*) FILTER (Description IS NOT NULL AND CustomerID IS NOT NULL) AS BIGINT) AS p
                  FROM raw), (SELECT CAST(count(*) AS BIGINT) AS c FROM minimal)""",
        "volume_comparison": """
            SELECT a AS rows_before, b AS rows_after, a - b AS rows_removed
            FROM (SELECT CAST(count(*) AS BIGINT) AS a FROM raw), (SELECT CAST(count(*) AS BIGINT) AS b FROM dash)""",
        "cancellations": "SELECT * FROM raw WHERE starts_with(InvoiceNo, 'C')",
        "filter_date_country": "SELECT * FROM picked",
        "filtered_monthly_revenue": f"SELECT {_MONTH} AS Month, {_REVENUE} AS Total_Sales FROM picked GROUP BY 1",
        "filtered_cohort_counts": _cells("picked"),
        "filter_sales_by_month": f"""
            SELECT *, {_MONTH} AS YearMonth FROM sales
            WHERE CAST(InvoiceTS AS DATE) BETWEEN DATE '{catalog.FILTER_START}' AND DATE '{catalog.FILTER_END}'
            AND Country IN ({", ".join(f"'{c}'" for c in star.DEFAULTS)})""",
        "filter_domain": _domain("sales", star.DEFAULTS),
        "filter_domain_stored": _domain("sales", star.DEFAULTS),
        "filter_domain_fallback": _domain("dash", ["United Kingdom", "Germany", "France", "EIRE", "Netherlands"]),
        "region_left_join": "SELECT * FROM mapped",
        "total_amount": "SELECT * FROM sales",
        "normalize_customer_id": f"""
            SELECT CustomerID, CAST(count(*) AS BIGINT) AS lines, {n} AS normalized_id FROM raw GROUP BY CustomerID""",
        "label_clusters": """
            SELECT c_custkey AS CustomerID, CAST(c_custkey % 7 AS INTEGER) AS cluster,
                   CASE WHEN c_custkey % 7 <= 4 THEN 'Segment-' || CAST(c_custkey % 7 AS VARCHAR)
                        ELSE 'Segment-Other' END AS segment_label,
                   'Segment-' || CAST(c_custkey % 7 AS VARCHAR) AS Segment
            FROM customer""",
        "preview_raw_clean": f"""
            SELECT * FROM (SELECT 'raw' AS frame, {_RAW_COLUMNS} FROM raw ORDER BY {_NULLS_FIRST} LIMIT 10)
            UNION ALL
            SELECT * FROM (SELECT 'clean' AS frame, {_RAW_COLUMNS} FROM dash ORDER BY {_NULLS_FIRST} LIMIT 10)""",
        "missing_values": _missing(),
        "cancel_share": f"""
            {_share("cancelled", "c", "t")} FROM (SELECT count(*) AS t, count(*) FILTER (starts_with(InvoiceNo, 'C')) AS c FROM raw)
            UNION ALL
            {_share("successful", "(t - c)", "t")} FROM (SELECT count(*) AS t, count(*) FILTER (starts_with(InvoiceNo, 'C')) AS c FROM raw)""",
        "top_returned_products": """
            SELECT Description AS Product, CAST(count(*) AS BIGINT) AS ReturnLines FROM raw
            WHERE starts_with(InvoiceNo, 'C') AND Description IS NOT NULL
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
        "cancel_trend_monthly": f"""
            SELECT strftime(ts, '%Y-%m') AS Month, {_INVOICES} AS CancelledInvoices
            FROM (SELECT InvoiceNo, try_strptime(InvoiceDate, '{_TS}') AS ts FROM raw WHERE starts_with(InvoiceNo, 'C'))
            WHERE ts IS NOT NULL GROUP BY 1""",
        "numeric_summary": _summary(),
        "quality_counts": """
            SELECT category, CAST(count(*) AS BIGINT) AS "rows" FROM tagged GROUP BY category""",
        "quality_examples": f"""
            SELECT category, "rank", {_RAW_COLUMNS}
            FROM (SELECT *, CAST(row_number() OVER (PARTITION BY category ORDER BY {_NULLS_FIRST}) AS INTEGER) AS "rank"
                  FROM tagged) WHERE "rank" <= 3""",
        "stage_counts": """
            SELECT 'raw' AS stage, CAST(count(*) AS BIGINT) AS "rows" FROM raw
            UNION ALL SELECT 'clean', count(*) FROM clean
            UNION ALL SELECT 'customers', count(DISTINCT CustomerID) FROM clean""",
        "sales_daily": f"""
            SELECT CAST(InvoiceTS AS DATE) AS SaleDate, Country, {_REVENUE} AS Revenue, {_INVOICES} AS Transactions,
                   {_ITEMS} AS ItemsSold FROM sales GROUP BY 1, 2""",
        "sales_monthly": f"""
            SELECT {_MONTH} AS YearMonth, Country, {_REVENUE} AS Revenue, {_INVOICES} AS Transactions,
                   {_ITEMS} AS ItemsSold FROM sales GROUP BY 1, 2""",
        "monthly_revenue": f"SELECT {_MONTH} AS Month, {_REVENUE} AS Total_Sales FROM sales GROUP BY 1",
        "dow_sales": dow,
        "dow_sales_ordered": f"""
            SELECT CAST(o AS INTEGER) AS DayOrdinal, d AS Day, Total_Sales, Transactions
            FROM (VALUES {days}) AS v(d, o) LEFT JOIN ({dow}) AS s ON v.d = s.Day""",
        "hourly_sales": _hourly("sales"),
        "events_hourly": _hourly("event_sales"),
        "country_revenue": f"SELECT Country, {_REVENUE} AS Total_Sales FROM sales GROUP BY Country",
        "product_sales": f"""
            SELECT Description AS Product, {_ITEMS} AS Quantity, {_REVENUE} AS Total_Sales FROM sales GROUP BY 1""",
        "top_products": f"""
            SELECT Product, CASE WHEN length(Product) > 25 THEN substr(Product, 1, 25) || '...' ELSE Product END
                   AS ShortName, q AS Quantity, Total_Sales
            FROM (SELECT Description AS Product, {_ITEMS} AS q, {_REVENUE} AS Total_Sales FROM sales GROUP BY 1)
            ORDER BY q DESC, Product LIMIT 10""",
        "home_vs_international": f"""
            SELECT market, round(amount, 2) AS Total_Sales,
                   round(amount * 100.0e0 / (SELECT sum(TotalAmount) FROM sales), 6) AS share_pct
            FROM (SELECT CASE WHEN Country = '{star.HOME}' THEN 'home' ELSE 'international' END AS market,
                         sum(TotalAmount) AS amount FROM sales GROUP BY 1)""",
        "top_international": f"""
            SELECT Country, {_REVENUE} AS Total_Sales FROM sales WHERE Country <> '{star.HOME}'
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
        "daily_transactions_ma7": _moving_average("sales"),
        "events_daily_ma7": _moving_average("event_sales"),
        "kpi_sales": _kpi("sales"),
        "events_kpi": _kpi("event_sales"),
        "dow_basket": _basket("sales", "dayname(InvoiceTS)", "DayOfWeek", "dayname(InvoiceTS) <> 'Saturday'"),
        "events_dow_basket": _basket(
            "event_sales", "dayname(InvoiceTS)", "DayOfWeek", "dayname(InvoiceTS) <> 'Saturday'"
        ),
        "hourly_basket": _basket("sales", "CAST(hour(InvoiceTS) AS INTEGER)", "Hour"),
        "price_quantity_bins": f"""
            SELECT CAST(floor(log10(UnitPrice) * 4) AS INTEGER) AS price_bin,
                   CAST(floor(log10(Quantity) * 4) AS INTEGER) AS qty_bin,
                   CAST(count(*) AS BIGINT) AS Lines, {_ITEMS} AS Quantity, {_REVENUE} AS TotalAmount
            FROM sales GROUP BY 1, 2""",
        "rfm": "SELECT * REPLACE (round(Monetary, 2) AS Monetary) FROM rfm",
        "rfm_fixed_date": f"""
            SELECT * REPLACE (round(Monetary, 2) AS Monetary) FROM ({_rfm("sales", f"DATE '{catalog.REFERENCE_DATE}'")})""",
        "rfm_encoded": f"""
            SELECT * REPLACE (round(Monetary, 2) AS Monetary)
            FROM ({_rfm("sales", extra="max((SELECT Country_Encoded FROM codes WHERE codes.Country = sales.Country)) AS Country_Encoded,")})""",
        "top_customers": f"""
            SELECT {n} AS CustomerID, {_REVENUE} AS TotalAmount FROM sales
            WHERE {n} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
        "customer_country": """
            SELECT CustomerID, arg_min(Country, row(InvoiceTS, InvoiceNo, StockCode)) AS Country
            FROM sales GROUP BY CustomerID""",
        "kpi_customers": """
            SELECT CAST(count(*) AS BIGINT) AS total_customers, CAST(count(DISTINCT Segment) AS BIGINT) AS total_segments,
                   round(avg(Monetary), 2) AS avg_monetary, round(avg(Frequency), 1) AS avg_frequency FROM segs""",
        "repeat_purchase": """
            SELECT buyer_type, CAST(c AS BIGINT) AS Customers, round(c * 100.0e0 / sum(c) OVER (), 6) AS share_pct
            FROM (SELECT 'repeat' AS buyer_type, count(*) FILTER (Frequency > 1) AS c FROM insight
                  UNION ALL SELECT 'one_time', count(*) FILTER (Frequency = 1) FROM insight)""",
        "loyalty_effect": """
            SELECT round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept,
                   round(corr(y, x), 6) AS corr, CAST(count(*) AS BIGINT) AS n
            FROM (SELECT Monetary / Frequency AS y, CAST(Frequency AS DOUBLE) AS x FROM insight)""",
        "loyalty_caps": """
            SELECT round(quantile_cont(CAST(Frequency AS DOUBLE), 0.99), 6) AS freq_p99,
                   round(quantile_cont(Monetary / Frequency, 0.99), 6) AS avg_spend_p99,
                   round(quantile_cont(Monetary, 0.98), 6) AS monetary_p98 FROM insight""",
        "cohort_assign": "SELECT * FROM cohort",
        "cohort_counts": "SELECT * FROM cells",
        "cohort_retention": "SELECT * FROM retention",
        "cohort_retention_wide": _WIDE,
        "cohort_ltv": f"""
            SELECT CohortMonth, {_mean('spend')} AS AvgLTV
            FROM (SELECT CohortMonth, CustomerID, sum(TotalAmount) AS spend FROM cohort GROUP BY 1, 2) GROUP BY 1""",
        "insight_frame": """
            SELECT * REPLACE (round(TotalAmount, 2) AS TotalAmount, round(Monetary, 2) AS Monetary) FROM insight""",
        "pareto_segments": """
            SELECT Segment, round(a, 2) AS TotalAmount,
                   round(sum(a) OVER (ORDER BY a DESC, Segment ROWS UNBOUNDED PRECEDING) / sum(a) OVER () * 100, 6)
                       AS CumulativePercentage
            FROM (SELECT Segment, sum(TotalAmount) AS a FROM insight GROUP BY Segment)""",
        "churn_risk": _CHURN.format(**risk),
        "vip_segment": f"""
            SELECT Segment, {_mean('Monetary')} AS AvgMonetary FROM insight GROUP BY Segment
            ORDER BY avg(Monetary) DESC, Segment LIMIT 1""",
        "vip_top_products": f"""
            SELECT Description, {_REVENUE} AS TotalAmount FROM sales
            WHERE {n} IN (SELECT CustomerID FROM insight WHERE Segment = {_VIP})
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
        "vip_share_by_country": f"""
            SELECT Country, Segment, Customers, round(Customers * 100.0e0 / sum(Customers) OVER (PARTITION BY Country), 6) AS SharePct
            FROM (SELECT Country, Segment, CAST(count(*) AS BIGINT) AS Customers FROM homes JOIN insight USING (CustomerID) GROUP BY 1, 2)
            WHERE Country IN (SELECT Country FROM homes JOIN insight USING (CustomerID)
                              GROUP BY Country ORDER BY count(*) DESC, Country LIMIT 10)""",
        "cancellations_by_segment": f"""
            SELECT Segment, {_INVOICES} AS CancelledInvoices
            FROM (SELECT {n} AS CustomerID, InvoiceNo FROM raw WHERE starts_with(InvoiceNo, 'C'))
            JOIN nsegs USING (CustomerID) GROUP BY Segment""",
        "segment_monetary_box": _BOX,
        "encode_country": "SELECT * FROM codes",
        "encode_region": "SELECT * FROM region_codes",
        "minmax_quantity": f"SELECT {_RAW_COLUMNS.replace('Quantity', 'CAST(Quantity AS INTEGER) AS Quantity')}, Quantity_Normalized FROM modular",
        "zscore_price": f"SELECT {_RAW_COLUMNS.replace('Quantity', 'CAST(Quantity AS INTEGER) AS Quantity')}, UnitPrice_Standardized FROM modular",
        "preprocess_modular": "SELECT * FROM modular",
        "preprocess_monolith": "SELECT * FROM monolith",
        "davies_bouldin": _DAVIES,
        "silhouette": _SILHOUETTE,
        "silhouette_euclidean": _EUCLIDEAN,
        "calinski_harabasz": _CALINSKI,
        "end_to_end_full": _run_summary("rfm"),
        "end_to_end_basic": _run_summary("basic_rfm"),
    }
    sql = {name: _with(body) for name, body in bodies.items()}
    sql["region_case"] = _with(_REGION_CASE, raw=_raw(f"list_extract([{names}], n_nationkey + 1)"))
    return sql
