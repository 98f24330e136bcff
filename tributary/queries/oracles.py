"""The results of tables.py in SQL over the same tables, for an independent check."""

from __future__ import annotations

from tributary.fixed_values import CHECK_TEXTS, DEPARTMENTS

# --- shared pieces ------------------------------------------------------------

PARTIES = """
SELECT CAST(c_custkey AS VARCHAR) AS employee_id, CAST(NULL AS VARCHAR) AS first_name,
  c_name AS last_name, CAST(NULL AS VARCHAR) AS email, c_mktsegment AS department,
  CAST(NULL AS VARCHAR) AS job_title, CAST(NULL AS VARCHAR) AS hire_date,
  CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS employment_type,
  CAST(c_nationkey AS VARCHAR) AS manager_id, 'globaltech_hris' AS source,
  'GlobalTech' AS company_origin FROM customer
UNION ALL
SELECT 'ACQ_' || s_suppkey, NULL, s_name, NULL, NULL, NULL, NULL, NULL, NULL,
  CAST(s_nationkey AS VARCHAR), 'acquiredco_hris', 'AcquiredCo' FROM supplier
"""

FORMATTED = """
SELECT 'globaltech_hris' AS source, c_name AS last_name, c_mktsegment AS department,
  printf('GT-%06d', c_custkey) AS employee_id, printf('GT-%06d', c_nationkey) AS manager_id FROM customer
UNION ALL
SELECT 'acquiredco_hris', s_name, NULL, printf('AC-%06d', s_suppkey), printf('AC-%06d', s_nationkey) FROM supplier
"""


def _checked(rows: list[str], threshold: str = "0.95") -> str:
    """Report from SELECTs of (position, check, description, failed, total, threshold)."""
    union = " UNION ALL ".join(rows)
    return f"""
    SELECT position, "check", description, CAST(total AS BIGINT) AS total,
      CAST(total - failed AS BIGINT) AS passed, CAST(failed AS BIGINT) AS failed,
      round_even(CASE WHEN total > 0 THEN 1 - failed::DOUBLE / total ELSE 1.0 END, 4) AS pass_rate,
      CASE WHEN CASE WHEN total > 0 THEN 1 - failed::DOUBLE / total ELSE 1.0 END
        >= coalesce(threshold, {threshold}) THEN 'PASS' ELSE 'FAIL' END AS status
    FROM ({union})"""


def _check(position, label, description, failed, total, table, threshold="NULL"):
    return (
        f"""SELECT {position} AS position, '{label}' AS "check", '{description}' AS description, """
        f"{failed} AS failed, {total} AS total, CAST({threshold} AS DOUBLE) AS threshold FROM {table}"
    )


PARTY_REPORT = f"WITH p AS ({FORMATTED}) " + _checked([
    _check(1, "NOT NULL: employee_id", "id", "count(*) - count(employee_id)", "count(*)", "p"),
    _check(2, "UNIQUE: employee_id", "id", "count(employee_id) - count(DISTINCT employee_id)", "count(employee_id)", "p"),
    _check(3, "REGEX: employee_id", "id",
           r"count(*) FILTER (NOT regexp_matches(employee_id, '^(GT|AC)-\d{6}$'))", "count(employee_id)", "p"),
    _check(4, "NOT NULL: department", "segment", "count(*) - count(department)", "count(*)", "p"),
]) + """
UNION ALL SELECT 5, 'MIN ROW COUNT', 'rows', count(*), CASE WHEN count(*) >= 1000 THEN count(*) ELSE 0 END,
  CASE WHEN count(*) >= 1000 THEN 0 ELSE 1000 - count(*) END,
  CASE WHEN count(*) >= 1000 THEN 1.0 ELSE round_even(count(*)::DOUBLE / 1000, 4) END,
  CASE WHEN count(*) >= 1000 THEN 'PASS' ELSE 'FAIL' END FROM p"""


def _title(text: str) -> str:
    return f"""array_to_string(list_transform(range(1, length({text}) + 1), lambda i:
      CASE WHEN i > 1 AND regexp_matches({text}[i - 1], '\\p{{L}}') THEN lower({text}[i])
      ELSE upper({text}[i]) END), '')"""


def _tidy(text: str) -> str:
    return f"""trim(regexp_replace(translate(nfc_normalize({text}), '-'',', '   '), '\\s+', ' ', 'g'))"""


CLEAN_NAMES = f"""
WITH raw AS (SELECT p_partkey, {_tidy("' 3rd  ' || replace(p_name, ' ', '-')")} AS f,
    {_tidy("'o''' || p_brand || ',e' || chr(769) || 'lan ' || p_type || ' '")} AS l FROM part),
named AS (SELECT p_partkey, {_title('f')} AS first_name, {_title('l')} AS last_name FROM raw)
SELECT *, first_name || ' ' || last_name AS employee_name FROM named"""

PAYROLL = """
SELECT CAST(c_custkey AS VARCHAR) AS raw_id, printf('GT-%06d', c_custkey) AS employee_id, c_acctbal AS amount,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN '£' ELSE '$' END || format('{:,.2f}', c_acctbal) AS base_salary,
  CASE WHEN c_nationkey < 10 THEN 'Annual' WHEN c_nationkey < 15 THEN 'Monthly'
    WHEN c_nationkey < 20 THEN 'Bi-Weekly' ELSE 'Daily' END AS pay_frequency,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'GBP' WHEN 'BUILDING' THEN 'EUR' WHEN 'AUTOMOBILE' THEN 'USD'
    WHEN 'FURNITURE' THEN 'JPY' END AS currency FROM customer"""

SALARY = """amount * CASE pay_frequency WHEN 'Annual' THEN 1.0::DOUBLE WHEN 'Monthly' THEN 12.0::DOUBLE
    WHEN 'Bi-Weekly' THEN 26.0::DOUBLE END
  * CASE currency WHEN 'USD' THEN 1.0::DOUBLE WHEN 'EUR' THEN 1.08::DOUBLE WHEN 'GBP' THEN 1.27::DOUBLE END"""

HOSTS = r"""
SELECT page_id, CASE WHEN regexp_extract(url, '^https?://[^/]+/([^/]+)', 1) <> 'es' THEN
    CASE WHEN url LIKE 'https%' THEN ' ' || upper(regexp_extract(url, '^https?://([^/]+)', 1))
      ELSE regexp_extract(url, '^https?://([^/]+)', 1) END END AS host,
  regexp_extract(url, '^https?://[^/]+/([^/]+)', 1) AS source FROM pages"""

HOST_RANKS = f"""
WITH hosts AS ({HOSTS}),
ranked AS (SELECT *, row_number() OVER best AS rn, first_value(page_id) OVER best AS keeper_id,
    first_value(source) OVER best AS keeper_source, count(*) OVER (PARTITION BY lower(trim(host))) AS n
  FROM hosts WINDOW best AS (PARTITION BY lower(trim(host)), CASE WHEN host IS NULL THEN page_id END
    ORDER BY CASE source WHEN 'en' THEN 1 WHEN 'fr' THEN 2 ELSE 99 END, page_id))"""


def _lcs(a: str, b: str) -> str:
    """Textbook table, one row per character of `a`, each row a running maximum."""
    return f"""list_reduce(
      list_concat([list_transform(range(0, length({b}) + 1), lambda z: 0::BIGINT)],
        list_transform(string_split({a}, ''), lambda c: [unicode(c)::BIGINT])),
      lambda above, ch: list_reduce(
        list_concat([[0::BIGINT]], list_transform(range(1, length({b}) + 1), lambda j:
          [CASE WHEN unicode({b}[j]) = ch[1] THEN above[j] + 1 ELSE above[j + 1] END])),
        lambda done, cell: list_append(done, greatest(done[-1], cell[1]))))[-1]"""


# CTEs that turn `linking(ord, id, source, name, last, date)` into candidates, matches, review
LINKAGE = f"""
keyed AS (SELECT *, coalesce(upper(nullif(substr(last, 1, 1), '')), '?') AS block,
    array_to_string(list_sort(list_filter(string_split_regex(name, '\\s+'), lambda w: w <> '')), ' ') AS k
  FROM linking WHERE name IS NOT NULL),
l AS (SELECT * FROM keyed WHERE source = 'acquiredco_hris' AND name <> ''),
g AS (SELECT * FROM keyed WHERE source = 'globaltech_hris'),
names AS (SELECT DISTINCT l.block, l.k AS lk, g.k AS gk FROM l JOIN g ON l.block = g.block),
measured AS (SELECT *, length(lk) + length(gk) AS total, {_lcs('lk', 'gk')} AS lcs FROM names),
scored AS (SELECT *, (1.0::DOUBLE - (total - 2 * lcs)::DOUBLE / total) * 100 AS score
  FROM measured WHERE 200 * lcs >= 75 * total),
candidates AS (SELECT l.ord AS l_ord, l.id AS l_id, l.source AS l_source, l.name AS l_name, l.date AS l_date,
    g.ord AS g_ord, g.id AS g_id, g.source AS g_source, g.name AS g_name, g.date AS g_date, score,
    abs(datediff('day', l.date, g.date)) AS days,
    row_number() OVER (PARTITION BY l.ord ORDER BY score DESC, g.ord) AS rank
  FROM l JOIN scored s ON s.block = l.block AND s.lk = l.k JOIN g ON g.block = s.block AND g.k = s.gk
  QUALIFY rank <= 5),
matches AS (SELECT * FROM candidates WHERE score >= 88 AND days <= 30
  QUALIFY row_number() OVER (PARTITION BY l_ord ORDER BY rank) = 1),
review AS (SELECT * FROM candidates WHERE rank = 1 AND l_ord NOT IN (SELECT l_ord FROM matches))"""

ROSTER = """
SELECT p_partkey AS _ord, p_brand || '/' || p_type || '/' || p_size AS employee_id,
  CASE WHEN p_brand LIKE 'Brand#1%' THEN upper(p_name || '/' || p_type || '/' || p_size)
    ELSE p_name || '/' || p_type || '/' || p_size END AS email,
  split_part(p_name, ' ', -1) AS last_name, p_name AS employee_name,
  CAST(DATE '1995-01-01' + 3 * p_size AS DATE) AS hire_date,
  CASE WHEN p_brand LIKE 'Brand#1%' THEN 'globaltech_hris'
    WHEN p_brand LIKE 'Brand#2%' THEN 'acquiredco_hris' ELSE 'other' END AS source FROM part"""


def _part_linkage(row_id: str) -> str:
    return f"""WITH linking AS (SELECT _ord AS ord, {row_id} AS id, source, employee_name AS name,
      last_name AS last, hire_date AS date FROM ({ROSTER})), {LINKAGE}"""


URL_LINKAGE = f"""WITH linking AS (SELECT page_id AS ord, page_id AS id,
    CASE WHEN url LIKE 'https%' THEN 'globaltech_hris' ELSE 'acquiredco_hris' END AS source,
    regexp_replace(url, '^https?://', '') AS name, regexp_replace(url, '^https?://', '') AS last,
    CAST(DATE '2020-01-01' + CAST(page_id AS INTEGER) AS DATE) AS date FROM pages), {LINKAGE}"""

CANDIDATE_LIST = """ SELECT g_id AS gt_employee_id, g_name AS gt_name, l_id AS ac_employee_id, l_name AS ac_name,
  CAST(rank AS INTEGER) AS rank, score AS name_score, CAST(days AS INTEGER) AS date_diff_days FROM candidates"""
MATCH_LIST = """ SELECT g_id AS keeper_id, g_source AS keeper_source, l_id AS dropped_id, l_source AS dropped_source,
  'fuzzy_name_date' AS match_method, score AS match_score FROM matches"""
REVIEW_LIST = """ SELECT g_id AS gt_employee_id, g_name AS gt_name, g_date AS gt_hire_date, l_id AS ac_employee_id,
  l_name AS ac_name, l_date AS ac_hire_date, score AS name_score, CAST(days AS INTEGER) AS date_diff_days FROM review"""
REVIEW_EXPORT = """ SELECT g_id AS record_1_id, l_id AS record_2_id, round_even(score * 10, 0) / 10 AS similarity_score,
  CAST(days AS INTEGER) AS hire_date_diff_days,
  CASE WHEN score >= 88 THEN 'VERIFY_HIRE_DATE' ELSE 'MANUAL_REVIEW' END AS recommended_action FROM review"""

THREE_PASSES = f"""
WITH roster AS ({ROSTER}),
first_ids AS (SELECT * FROM roster QUALIFY row_number() OVER (PARTITION BY employee_id ORDER BY _ord) = 1),
by_key AS (SELECT *, row_number() OVER best AS rn, first_value(employee_id) OVER best AS keeper_id,
    first_value(source) OVER best AS keeper_source,
    CASE source WHEN 'globaltech_hris' THEN 1 WHEN 'acquiredco_hris' THEN 2 ELSE 99 END AS priority
  FROM first_ids WINDOW best AS (PARTITION BY lower(trim(email)) ORDER BY
    CASE source WHEN 'globaltech_hris' THEN 1 WHEN 'acquiredco_hris' THEN 2 ELSE 99 END, _ord)),
by_email AS (SELECT * FROM by_key WHERE rn = 1),
linking AS (SELECT _ord AS ord, employee_id AS id, source, employee_name AS name, last_name AS last,
    hire_date AS date FROM by_email), {LINKAGE},
edges AS (
  SELECT keeper_id, keeper_source, employee_id AS dropped_id, source AS dropped_source,
    'exact_email' AS match_method, 100.0::DOUBLE AS match_score, 0 AS step, priority, _ord AS ord FROM by_key WHERE rn > 1
  UNION ALL
  SELECT g_id, g_source, l_id, l_source, 'fuzzy_name_date', score, 1, 0, l_ord FROM matches),
contributions AS (SELECT keeper_id, dropped_source, min((step, priority, ord)) AS first, max(step) AS last
  FROM edges GROUP BY ALL),
added AS (SELECT c.keeper_id, max(last) AS last,
    string_agg(dropped_source, ',' ORDER BY first) FILTER (dropped_source <> e.source) AS more
  FROM contributions c JOIN by_email e ON e.employee_id = c.keeper_id GROUP BY 1),
golden AS (SELECT e._ord, e.employee_id, e.source, e.source || coalesce(',' || more, '') AS source_systems,
    CASE a.last WHEN 1 THEN 'fuzzy_name_date' WHEN 0 THEN 'exact_email' ELSE 'unique' END AS dedup_method
  FROM by_email e LEFT JOIN added a ON a.keeper_id = e.employee_id
  WHERE e._ord NOT IN (SELECT l_ord FROM matches)),
unpaid AS (SELECT p_brand || '/' || p_type || '/' || (p_size + 1) AS employee_id FROM part),
ghost AS (SELECT * FROM unpaid u WHERE NOT EXISTS (SELECT 1 FROM golden g WHERE g.employee_id = u.employee_id))"""

ORDER_GHOSTS = """
SELECT o_orderkey, nullif(o_custkey, 5) AS employee_id, o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c_acctbal > 0 AND c.c_custkey = nullif(o.o_custkey, 5))"""

_ORDERS = """(SELECT printf('GT-%06d', o_orderkey) AS id, o_custkey AS customer,
  nullif(o_orderpriority, '5-LOW') AS priority, nullif(o_orderstatus, 'P') AS state,
  CAST(o_orderdate AS DATE) AS day FROM orders)"""


def _flag_rate(position, label, description, hit, limit, table):
    rate = f"(count(*) FILTER ({hit}))::DOUBLE / count(*)"
    return f"""SELECT {position}, '{label}', '{description}', count(*),
      CASE WHEN {rate} > {limit} THEN 0 ELSE count(*) - count(*) FILTER ({hit}) END,
      CASE WHEN {rate} > {limit} THEN count(*) FILTER ({hit}) ELSE 0 END,
      round_even(1 - {rate}, 4), CASE WHEN {rate} > {limit} THEN 'FAIL' ELSE 'PASS' END FROM {table}"""


def _min_rows(position, description, minimum, table):
    return f"""SELECT {position}, 'MIN ROW COUNT', '{description}', count(*),
      CASE WHEN count(*) >= {minimum} THEN count(*) ELSE 0 END,
      CASE WHEN count(*) >= {minimum} THEN 0 ELSE {minimum} - count(*) END,
      CASE WHEN count(*) >= {minimum} THEN 1.0 ELSE round_even(count(*)::DOUBLE / {minimum}, 4) END,
      CASE WHEN count(*) >= {minimum} THEN 'PASS' ELSE 'FAIL' END FROM {table}"""


def _ghost_rate(position, description, table):
    return f"""SELECT {position}, 'GHOST RATE: payroll vs HRIS', '{description}', n + g,
      CASE WHEN g::DOUBLE / (n + g) < 0.75 THEN n ELSE 0 END,
      CASE WHEN g::DOUBLE / (n + g) >= 0.75 THEN g ELSE 0 END, round_even(1 - g::DOUBLE / (n + g), 4),
      CASE WHEN g::DOUBLE / (n + g) >= 0.75 THEN 'FAIL' ELSE 'PASS' END
      FROM (SELECT (SELECT count(*) FROM {table}) AS n, (SELECT count(*) FROM ({ORDER_GHOSTS})) AS g)"""


QUALITY_REPORT = f"WITH t AS {_ORDERS} " + _checked([
    _check(1, "NOT NULL: priority", "filled", "count(*) - count(priority)", "count(*)", "t"),
    _check(2, "NOT NULL: state", "filled", "count(*) - count(state)", "count(*)", "t", "0.5"),
    _check(3, "UNIQUE: id", "one row per id", "count(id) - count(DISTINCT id)", "count(id)", "t"),
    _check(4, "UNIQUE: customer", "one order per customer", "count(customer) - count(DISTINCT customer)",
           "count(customer)", "t"),
    _check(5, "REGEX: priority", "urgent", "count(*) FILTER (NOT regexp_matches(priority, '^[12]-[A-Z]'))",
           "count(priority)", "t"),
    _check(6, "VALUES IN SET: state", "finished", "count(*) FILTER (state NOT IN ('F'))", "count(state)", "t"),
    _check(7, "DATE RANGE: day", "period",
           "count(*) FILTER (day NOT BETWEEN DATE '1996-01-01' AND DATE '2000-12-31')", "count(day)", "t"),
]) + " UNION ALL " + " UNION ALL ".join([
    _flag_rate(8, "FLAG RATE: state=F", "few finished", "state = 'F'", 0.25, "t"),
    _flag_rate(9, "FLAG RATE: priority=1-URGENT", "not mostly urgent", "priority = '1-URGENT'", 0.5, "t"),
    "SELECT 10, 'COLUMN PRESENT: day', 'has a date', 1, 1, 0, 1.0, 'PASS'",
    "SELECT 11, 'COLUMN PRESENT: salary', 'has a salary', 1, 0, 1, 0.0, 'FAIL'",
    _min_rows(12, "enough rows", 1000, "t"),
    _min_rows(13, "many rows", 1_000_000_000, "t"),
    _ghost_rate(14, "known customers", "t"),
])

_CUSTOMERS = """(SELECT printf('GT-%06d', c_custkey) AS employee_id, c_mktsegment AS first_name, c_name AS last_name,
  CASE WHEN c_acctbal > 0 THEN c_name || '@example.org' END AS email,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Engineering' WHEN 'MACHINERY' THEN 'Manufacturing'
    WHEN 'AUTOMOBILE' THEN 'Sales' WHEN 'FURNITURE' THEN 'Interior' END AS department,
  CAST(DATE '1960-01-01' + 2 * CAST(trunc(c_acctbal) AS INTEGER) AS DATE) AS hire_date FROM customer)"""


def _standard_report() -> str:
    known = ", ".join(f"'{d}'" for d in DEPARTMENTS)
    failed = {
        "REGEX: employee_id": r"NOT regexp_matches(employee_id, '^(GT|AC)-\d{6}$')",
        "REGEX: email": r"NOT regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$')",
        "DATE RANGE: hire_date": "hire_date NOT BETWEEN DATE '1970-01-01' AND DATE '2000-01-01'",
        "VALUES IN SET: department": f"department NOT IN ({known})",
    }
    plain, other = [], []
    for position, (label, description) in enumerate(CHECK_TEXTS.items(), start=1):
        kind, _, column = label.partition(": ")
        filled = f"count({column})"
        if kind == "NOT NULL":
            plain.append(_check(position, label, description, f"count(*) - {filled}", "count(*)", "t"))
        elif kind == "UNIQUE":
            plain.append(_check(position, label, description, f"{filled} - count(DISTINCT {column})", filled, "t"))
        elif label in failed:
            plain.append(_check(position, label, description, f"count(*) FILTER ({failed[label]})", filled, "t"))
        elif kind == "COLUMN PRESENT":
            other.append(f"SELECT {position}, '{label}', '{description}', 1, 1, 0, 1.0, 'PASS'")
        elif kind == "MIN ROW COUNT":
            other.append(_min_rows(position, description, 1000, "t"))
        else:
            other.append(_ghost_rate(position, description, "t"))
    return f"WITH t AS {_CUSTOMERS} {_checked(plain)} UNION ALL {' UNION ALL '.join(other)}"


STANDARD_REPORT = _standard_report()

_TENURES = """(SELECT datediff('day', CAST(o_orderdate AS DATE), DATE '2000-01-01') / 365.25::DOUBLE AS v
  FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '2000-01-01')"""

_EMPLOYMENTS = """(SELECT nullif(c_mktsegment, 'FURNITURE') AS segment,
    CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price
  FROM customer JOIN orders ON nullif(c_custkey, 3) IS NOT DISTINCT FROM nullif(o_custkey, 4))"""


def _boxes(table: str, group: str, value: str) -> str:
    return f"""
    SELECT {group}, n, least(coalesce(low, q1), q1) AS whisker_low, q1, median, q3,
      greatest(coalesce(high, q3), q3) AS whisker_high, outliers FROM (
      SELECT x.{group}, n, q[1] AS q1, q[2] AS median, q[3] AS q3,
        min({value}) FILTER ({value} BETWEEN q[1] - (q[3] - q[1]) * 1.5 AND q[3] + (q[3] - q[1]) * 1.5) AS low,
        max({value}) FILTER ({value} BETWEEN q[1] - (q[3] - q[1]) * 1.5 AND q[3] + (q[3] - q[1]) * 1.5) AS high,
        count(*) FILTER ({value} NOT BETWEEN q[1] - (q[3] - q[1]) * 1.5 AND q[3] + (q[3] - q[1]) * 1.5) AS outliers
      FROM {table} x JOIN (SELECT {group}, count(*) AS n, quantile_cont({value}, [0.25, 0.5, 0.75]) AS q
        FROM {table} WHERE {value} IS NOT NULL AND {group} IS NOT NULL GROUP BY 1) s ON s.{group} = x.{group}
      WHERE {value} IS NOT NULL GROUP BY ALL)"""


# --- one statement per query ------------------------------------------------------

ORACLES = {
    "parties": PARTIES,
    "source_counts": f"SELECT source, count(*) AS count FROM ({PARTIES}) GROUP BY 1",
    "format_ids": f"SELECT source, last_name, employee_id, manager_id FROM ({FORMATTED})",
    "other_origins": """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'GlobalTech' WHEN 'MACHINERY' THEN 'AcquiredCo'
            WHEN 'FURNITURE' THEN NULL ELSE 'ThirdCo' END AS company_origin,
        CASE c_mktsegment WHEN 'BUILDING' THEN printf('GT-%06d', c_custkey) WHEN 'MACHINERY' THEN printf('AC-%06d', c_custkey)
            ELSE c_custkey::VARCHAR END AS employee_id,
        CASE c_mktsegment WHEN 'BUILDING' THEN printf('GT-%06d', c_nationkey) WHEN 'MACHINERY' THEN printf('AC-%06d', c_nationkey)
            ELSE c_nationkey::VARCHAR END AS manager_id FROM customer""",
    "party_report": PARTY_REPORT,
    "code_map": """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' END
        AS o_orderstatus FROM orders""",
    "code_map_table": """SELECT c_custkey, n_name AS nation FROM customer
        LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey < 3""",
    "unmapped_values": """SELECT DISTINCT o_orderpriority FROM orders
        WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')""",
    "clean_names": CLEAN_NAMES,
    "parse_dates": """SELECT o_orderkey, d AS hire_date, CASE WHEN d BETWEEN DATE '1970-01-01' AND DATE '2000-01-01'
        THEN 'ok' ELSE 'out_of_range' END AS hire_date_flag
        FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS d FROM orders)""",
    "annual_amount": f"SELECT employee_id, {SALARY} AS salary_usd_annual FROM ({PAYROLL})",
    "payroll_counts": f"""SELECT count(*) FILTER (amount IS NULL) AS unparsed,
        count(*) FILTER (currency IS NULL) AS no_currency, count({SALARY}) AS computed,
        count(*) FILTER (pay_frequency = 'Daily') AS daily FROM ({PAYROLL})""",
    "benefit_ids": """SELECT o_orderkey, CASE WHEN o_custkey <> 7 THEN printf('GT-%06d', o_custkey) END
        AS employee_id FROM orders""",
    "unknown_category": """SELECT p_partkey, p_type FROM part
        WHERE p_type NOT IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO')""",
    "unknown_category_table": """SELECT c_custkey, c_nationkey FROM customer
        WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)""",
    "flatten_json": """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS props_k,
        event_type AS body_kind_type, value AS body_value FROM events""",
    "page_stats": """SELECT conv_id, CAST(turn // 3 + 1 AS INTEGER) AS page, count(*) AS records,
        min(turn) AS first_offset, max(turn) AS last_offset FROM conversations GROUP BY 1, 2""",
    "exact_dedup": """SELECT doc_id, lang, source, n_chars FROM documents
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
    "exact_dedup_null_key": """SELECT event_id, event_type, u AS user_id FROM (
        SELECT *, CASE WHEN event_type <> 'error' THEN user_id END AS u FROM events)
        QUALIFY row_number() OVER (PARTITION BY u ORDER BY event_id) = 1""",
    "priority_dedup": f"{HOST_RANKS} SELECT page_id, host, source FROM ranked WHERE rn = 1",
    "priority_edges": f"""{HOST_RANKS} SELECT keeper_id, keeper_source, page_id AS dropped_id,
        source AS dropped_source, 'exact_email' AS match_method, 100.0::DOUBLE AS match_score
        FROM ranked WHERE rn > 1""",
    "shared_hosts": f"{HOST_RANKS} SELECT page_id, host, source FROM ranked WHERE host IS NOT NULL AND n > 1",
    "order_merge": """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer, o_orderpriority FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 1
          WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 99 END, o_orderkey) = 1""",
    "drop_rows": """SELECT doc_id, lang, n_chars FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    "linkage_candidates": _part_linkage("_ord") + CANDIDATE_LIST,
    "linkage_matches": _part_linkage("_ord") + MATCH_LIST,
    "linkage_review": _part_linkage("_ord") + REVIEW_LIST,
    "review_export": _part_linkage("employee_id") + REVIEW_EXPORT,
    "review_actions": _part_linkage("employee_id") + f""" SELECT recommended_action, count(*) AS count
        FROM ({REVIEW_EXPORT}) GROUP BY 1""",
    "url_candidates": URL_LINKAGE + CANDIDATE_LIST,
    "url_matches": URL_LINKAGE + MATCH_LIST,
    "url_review": URL_LINKAGE + REVIEW_LIST,
    "golden_provenance": THREE_PASSES + " SELECT * FROM golden",
    "match_edges": THREE_PASSES + """ SELECT keeper_id, keeper_source, dropped_id, dropped_source,
        match_method, match_score FROM edges""",
    "removed_by_step": THREE_PASSES + """ SELECT 'exact_id' AS step,
        (SELECT count(*) FROM roster) - (SELECT count(*) FROM first_ids) AS removed
        UNION ALL SELECT match_method, count(*) FROM edges GROUP BY 1""",
    "stage_summary": THREE_PASSES + """ SELECT (SELECT count(*) FROM roster) AS input_records,
        (SELECT count(*) FROM golden) AS golden_records, (SELECT count(*) FROM review) AS review_candidates,
        (SELECT count(*) FROM ghost) AS ghost_records,
        (SELECT count(*) FROM ghost WHERE employee_id IN (SELECT dropped_id FROM edges)) AS merged_ghosts""",
    "ghosts": ORDER_GHOSTS,
    "ghost_rate": f"""SELECT ghosts, payroll_rows, ghosts::DOUBLE / payroll_rows AS ghost_rate FROM (
        SELECT (SELECT count(*) FROM ({ORDER_GHOSTS})) AS ghosts, (SELECT count(*) FROM orders) AS payroll_rows)""",
    "ghost_export": f"""SELECT employee_id AS payroll_employee_id, 'N/A (payroll-only record)' AS name,
        o_totalprice AS salary_usd_annual, 'No matching HRIS employee record' AS ghost_flag_reason
        FROM ({ORDER_GHOSTS})""",
    "ghost_file": f"""SELECT employee_id AS payroll_employee_id, 'N/A (payroll-only record)' AS name,
        o_totalprice AS salary_usd_annual, 'No matching HRIS employee record' AS ghost_flag_reason
        FROM ({ORDER_GHOSTS})""",
    "review_file": _part_linkage("employee_id") + REVIEW_EXPORT,
    "report_file": STANDARD_REPORT,
    "page_file": f"""SELECT count(*) AS total, count(*) FILTER (status = 'PASS') AS passed, count(*) FILTER (status = 'FAIL') AS failed,
        count(*) FILTER (status = 'PASS') AS passed_rows, count(*) FILTER (status = 'FAIL') AS failed_rows FROM ({STANDARD_REPORT})""",
    "exported_files": THREE_PASSES + """ SELECT 'golden' AS file, (SELECT count(*) FROM golden) AS rows
        UNION ALL SELECT 'ghosts', NULL
        UNION ALL SELECT 'review', (SELECT count(*) FROM review)""",
    "quality_report": QUALITY_REPORT,
    "standard_report": STANDARD_REPORT,
    "quality_gate": f"""SELECT count(*) AS checks, count(*) FILTER (status = 'FAIL') AS failed_checks,
        count(*) FILTER (status = 'FAIL') <= 2 AS gate_open FROM ({STANDARD_REPORT})""",
    "all_passed": f"SELECT bool_and(status = 'PASS') AS all_passed FROM ({STANDARD_REPORT})",
    "check_labels": f"""SELECT position, replace(regexp_replace("check", '^.*?: ', ''), 'employee_id', 'emp_id')
        AS label, passed, failed FROM ({STANDARD_REPORT})""",
    "quality_page": f"""SELECT printf('<tr style="background:%s"><td>%s</td><td><b>%s</b></td><td>%.1f%%</td>'
        || '<td>%d / %d</td><td>%s</td></tr>',
        CASE WHEN status = 'PASS' THEN '#d4edda' ELSE '#f8d7da' END, "check", status, pass_rate * 100,
        failed, total, description) AS line FROM ({STANDARD_REPORT})""",
    "value_counts": "SELECT p_type, count(*) AS count FROM part GROUP BY 1",
    "top15": """SELECT c_nationkey, count(*) AS count FROM customer GROUP BY 1
        ORDER BY count DESC, c_nationkey LIMIT 15""",
    "distinct_count": "SELECT count(DISTINCT text) AS distinct_values FROM documents",
    "distinct_labels": "SELECT DISTINCT o_orderpriority FROM orders",
    "box_stats": f"""SELECT segment, n, round(whisker_low, 4) AS whisker_low, round(q1, 4) AS q1,
        round(median, 4) AS median, round(q3, 4) AS q3, round(whisker_high, 4) AS whisker_high, outliers
        FROM ({_boxes(_EMPLOYMENTS, 'segment', 'price')})""",
    "box_outliers": f"""SELECT d.lang, CAST(n_chars AS DOUBLE) AS n_chars FROM documents d
        JOIN ({_boxes('documents', 'lang', 'n_chars')}) b ON b.lang = d.lang
        WHERE n_chars NOT BETWEEN whisker_low AND whisker_high""",
    "tenure_hist": f"""
        WITH t AS {_TENURES}, r AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 20 AS w FROM t),
        e AS (SELECT CAST(i AS INTEGER) AS bin, lo + (i - 1) * w AS bin_low,
          CASE WHEN i = 20 THEN hi ELSE lo + i * w END AS bin_high FROM range(1, 21) x(i), r)
        SELECT bin, bin_low, bin_high, count(v) AS count FROM e
        LEFT JOIN t ON v >= bin_low AND (v < bin_high OR bin = 20) GROUP BY ALL""",
    "median_tenure": f"SELECT quantile_cont(v, 0.5) AS median_years FROM {_TENURES}",
    "tenure_years": """SELECT o_orderkey, datediff('day', CAST(o_orderdate AS DATE), DATE '2000-01-01')
        / 365.25::DOUBLE AS tenure_years FROM orders""",
    "enrollment_rate": """SELECT c_mktsegment, round(avg(CASE WHEN c_custkey IN
          (SELECT o_custkey FROM orders WHERE o_totalprice > 450000) THEN 1.0::DOUBLE ELSE 0 END) * 100, 6)
        AS enrollment_rate, 80 AS target FROM customer GROUP BY 1""",
    "csv_roundtrip": """SELECT doc_id, md5(text) AS text_md5, nullif(lang, 'de') AS lang, 'documents' AS source
        FROM documents""",
    "csv_mixed_headers": """SELECT doc_id, md5(text) AS text_md5, nullif(lang, 'es') AS lang, 'documents' AS source
        FROM documents UNION ALL SELECT -1, NULL, 'lang', 'documents'""",
    "csv_dead_letters": """SELECT CASE WHEN o_orderstatus = 'P' THEN 'more fields than the header' ELSE 'kept' END
        AS outcome, count(*) AS count FROM orders GROUP BY 1 UNION ALL SELECT 'no column o_clerk', 1""",
    "json_roundtrip": """SELECT turn, CASE role WHEN 'user' THEN 'U' WHEN 'assistant' THEN 'A' END AS said_role,
        md5(text) AS text_md5, 'talk' AS source FROM conversations""",
    "xml_roundtrip": """SELECT CAST(c_custkey AS VARCHAR) AS employee_id,
        CASE WHEN c_mktsegment NOT IN ('FURNITURE', 'MACHINERY') THEN c_mktsegment END AS plan_type,
        c_name AS coverage_level, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'missing plan_type' ELSE 'benefits' END
        AS source FROM customer""",
    "xlsx_roundtrip": f"""SELECT raw_id AS employee_id, 'GlobalTech' AS company_origin, base_salary, currency,
        'payroll' AS source FROM ({PAYROLL})""",
    "golden_roundtrip": """SELECT c_custkey AS employee_id,
        CASE WHEN c_mktsegment = 'BUILDING' THEN 'AcquiredCo' ELSE 'GlobalTech' END AS company_origin,
        CAST(DATE '1990-01-01' + CAST(trunc(c_acctbal) AS INTEGER) AS TIMESTAMP) AS hire_date,
        CASE WHEN c_mktsegment = 'BUILDING' THEN 'second' ELSE 'first' END AS version FROM customer""",
}
