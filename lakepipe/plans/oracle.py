"""Oracle SQL (DuckDB dialect) for the registered queries.

Written independently of the DataFrame code: window functions, NOT IN,
FILTER clauses and string aggregation where the engine uses aggregates,
anti-joins and array functions.  Tables are the test tables registered as
views by the checker.
"""

from __future__ import annotations

# The code lists of the contract, spelled out for SQL.
LINE_CODES_SQL = "['HQLA_L1', 'HQLA_L2A', 'HQLA_L2B', 'OUT_RETAIL', 'OUT_WHOLESALE', 'OUT_OTHER', 'IN_TOTAL']"
RUN1 = "TIMESTAMP '2024-01-01 06:00:00'"
RUN2 = "TIMESTAMP '2024-02-01 06:00:00'"

CODES = """codes AS (
  SELECT * FROM (VALUES
    ('HQLA_L1', 'HQLA', CAST(1.00 AS DECIMAL(5,2))),
    ('HQLA_L2A', 'HQLA', CAST(0.85 AS DECIMAL(5,2))),
    ('HQLA_L2B', 'HQLA', CAST(0.50 AS DECIMAL(5,2))),
    ('OUT_RETAIL', 'OUTFLOW', CAST(1.00 AS DECIMAL(5,2))),
    ('OUT_WHOLESALE', 'OUTFLOW', CAST(1.00 AS DECIMAL(5,2))),
    ('OUT_OTHER', 'OUTFLOW', CAST(1.00 AS DECIMAL(5,2))),
    ('IN_TOTAL', 'INFLOW', CAST(1.00 AS DECIMAL(5,2)))) t(line_code, category, weight))"""


def inst_id(expr: str, n: int) -> str:
    return f"'FI' || lpad(CAST(({expr}) % {n} + 1 AS VARCHAR), 3, '0')"


def lines_cte(name: str, n: int, faults: bool) -> str:
    own = "l.l_orderkey // 8 % 3 = 0"
    line_code = f"({LINE_CODES_SQL})[l.l_linenumber]"
    currency = "'MYR'"
    amount = "CAST(l.l_extendedprice AS DECIMAL(20,2))"
    if faults:
        line_code = f"CASE WHEN l.l_orderkey % 71 = 0 THEN NULL WHEN l.l_orderkey % 73 = 0 THEN 'HQLA_X' ELSE {line_code} END"
        currency = ("CASE WHEN l.l_partkey % 97 = 0 THEN 'XXX' WHEN l.l_partkey % 89 = 0 THEN NULL "
                    "ELSE 'MYR' END")
        amount = (f"CASE WHEN l.l_partkey % 79 = 0 THEN NULL WHEN l.l_orderkey % 83 = 0 THEN -{amount} "
                  f"ELSE {amount} END")
    return f"""{name}_0 AS (
  SELECT {inst_id(f'CASE WHEN {own} THEN l.l_orderkey // 8 ELSE l.l_suppkey END', n)} AS institution_id,
         CASE WHEN {own} THEN CAST(l.l_orderkey // 8 // 12 % 6 + 1993 AS VARCHAR) || '-'
                || lpad(CAST(l.l_orderkey // 8 % 12 + 1 AS VARCHAR), 2, '0')
              ELSE strftime(o.o_orderdate, '%Y-%m') END AS reporting_period,
         {line_code} AS line_code,
         {currency} AS currency,
         {amount} AS amount,
         CASE WHEN {own} THEN CAST(l.l_orderkey // 8 % 1000000000 AS INTEGER) + 4
              ELSE CAST(floor(l.l_quantity) AS INTEGER) % 3 + 1 END AS submission_version,
         {own} AS own
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
{name}_1 AS (
  SELECT * EXCLUDE (own) FROM {name}_0 WHERE NOT own
  UNION ALL BY NAME
  SELECT institution_id, reporting_period, line_code, currency, CAST(sum(amount) AS DECIMAL(20,2)) AS amount, submission_version
  FROM {name}_0 WHERE own GROUP BY ALL),
{name} AS (
  SELECT *, institution_id || '-LCR-' || reporting_period || '-v' || CAST(submission_version AS VARCHAR)
            AS submission_id,
         CAST(last_day(CAST(reporting_period || '-01' AS DATE)) + (((submission_version - 1) % 3 + 1) * 5 + 5) AS TIMESTAMP)
            AS loaded_at
  FROM {name}_1)"""


def bronze_cte(name: str = "bronze", n: int = 999) -> str:
    """Pre-summed Bronze (one row per submission, line, currency)."""
    return lines_cte(f"{name}_lines", n, False) + f""",
{name} AS (
  SELECT institution_id, reporting_period, line_code, currency,
         CAST(sum(amount) AS DECIMAL(20,2)) AS amount, submission_id,
         submission_version, loaded_at
  FROM {name}_lines
  GROUP BY institution_id, reporting_period, line_code, currency, submission_id,
           submission_version, loaded_at)"""


def institutions_cte(name: str, n: int) -> str:
    return f"""{name} AS (
  SELECT {inst_id('s.s_suppkey', n)} AS institution_id,
         arg_min(s.s_name, s.s_suppkey) AS institution_name,
         (['COMMERCIAL_BANK', 'ISLAMIC_BANK', 'INVESTMENT_BANK', 'DFI'])[arg_min(s.s_nationkey, s.s_suppkey) % 4 + 1]
            AS institution_type,
         arg_min(nt.n_name, s.s_suppkey) AS peer_group,
         CASE WHEN sum(s.s_acctbal) < 0 THEN 'SMALL' WHEN sum(s.s_acctbal) < 20000 THEN 'MEDIUM'
              ELSE 'LARGE' END AS size_band,
         DATE '1995-01-01' + CAST(min(s.s_suppkey) % 80 * 45 AS INTEGER) AS active_from
  FROM supplier s LEFT JOIN nation nt ON s.s_nationkey = nt.n_nationkey
  GROUP BY 1)"""


# Bronze-stage rules of the LCR return, as SQL over one relation.
def rule_failures_cte(name: str, src: str) -> str:
    """Per sid: tested and failed counts of LCR-001..LCR-006."""
    return f"""{name}_u AS (
  SELECT submission_id, count(*) FILTER (WHERE n > 1) AS f5
  FROM (SELECT submission_id, institution_id, reporting_period, line_code, currency, count(*) AS n
        FROM {src} GROUP BY ALL) GROUP BY submission_id),
{name} AS (
  SELECT a.submission_id, a.tested, a.f1, a.f2, a.f3, a.f4, u.f5, a.f6 FROM (
    SELECT submission_id, count(*) AS tested,
      count(*) FILTER (WHERE institution_id IS NULL OR reporting_period IS NULL OR line_code IS NULL
                             OR currency IS NULL OR amount IS NULL) AS f1,
      count(*) FILTER (WHERE line_code IS NULL OR line_code NOT IN
         ('HQLA_L1', 'HQLA_L2A', 'HQLA_L2B', 'OUT_RETAIL', 'OUT_WHOLESALE', 'OUT_OTHER', 'IN_TOTAL')) AS f2,
      count(*) FILTER (WHERE currency IS NULL OR currency NOT IN ('MYR', 'USD', 'SGD', 'EUR', 'GBP', 'JPY', 'CNY')) AS f3,
      count(*) FILTER (WHERE amount < 0) AS f4,
      CASE WHEN coalesce(count(DISTINCT line_code) = 7, false) THEN 0 ELSE 1 END AS f6
    FROM {src} GROUP BY submission_id) a JOIN {name}_u u ON a.submission_id = u.submission_id)"""


def rule_results_cte(name: str, fails: str, checked_at: str) -> str:
    """Long format: one row per (sid, rule)."""
    rules = [("LCR-001", "completeness", "f1"), ("LCR-002", "validity", "f2"),
             ("LCR-003", "validity", "f3"), ("LCR-004", "validity", "f4"),
             ("LCR-005", "uniqueness", "f5"), ("LCR-006", "completeness", "f6")]
    parts = [f"""  SELECT '{rid}' AS rule_id, submission_id, 'blocking' AS severity, '{dim}' AS dimension,
         'bronze' AS stage, CAST(tested AS BIGINT) AS records_tested,
         CAST({f} AS BIGINT) AS records_failed,
         CASE WHEN {f} = 0 THEN 'PASS' ELSE 'FAIL' END AS outcome, {checked_at} AS checked_at
  FROM {fails}""" for rid, dim, f in rules]
    return f"{name} AS (\n" + "\n  UNION ALL\n".join(parts) + ")"


def quarantine_cte(name: str, results: str) -> str:
    return f"""{name} AS (
  SELECT DISTINCT submission_id FROM {results}
  WHERE stage = 'bronze' AND severity = 'blocking' AND outcome = 'FAIL')"""


def silver_cte(name: str, bronze: str, quarantined: str | None) -> str:
    where = f"WHERE submission_id NOT IN (SELECT submission_id FROM {quarantined})" if quarantined else ""
    return f"""{name} AS (
  SELECT institution_id, reporting_period, line_code, currency, CAST(amount AS DECIMAL(20,2)) AS amount,
         submission_id, submission_version, loaded_at AS bronze_loaded_at
  FROM (SELECT b.*, row_number() OVER (PARTITION BY institution_id, reporting_period, line_code, currency
                                       ORDER BY submission_version DESC, loaded_at DESC) AS rn
        FROM {bronze} b {where}) WHERE rn = 1)"""


def gold_select(silver: str, inst: str) -> str:
    return f"""agg AS (
  SELECT s.institution_id, s.reporting_period,
         sum(CASE WHEN c.category = 'HQLA' THEN s.amount * c.weight END) AS hqla_d,
         sum(CASE WHEN c.category = 'OUTFLOW' THEN s.amount END) AS out_d,
         sum(CASE WHEN c.category = 'INFLOW' THEN s.amount END) AS in_d,
         array_to_string(list_sort(list(DISTINCT s.submission_id)), ',') AS submission_ids
  FROM {silver} s JOIN codes c ON s.line_code = c.line_code
  GROUP BY 1, 2),
net AS (
  SELECT *, out_d - CASE WHEN in_d IS NULL OR out_d IS NULL THEN NULL
                         ELSE least(CAST(in_d AS DECIMAL(24,4)), CAST(0.75 * out_d AS DECIMAL(24,4))) END AS net_d
  FROM agg),
gold AS (
  SELECT a.institution_id, i.institution_name, i.institution_type, i.peer_group, a.reporting_period,
         CAST(round(a.hqla_d, 2) AS DOUBLE) AS hqla,
         CAST(round(a.out_d, 2) AS DOUBLE) AS outflows,
         CAST(round(a.in_d, 2) AS DOUBLE) AS inflows,
         CAST(round(a.net_d, 2) AS DOUBLE) AS net_outflows,
         round(CAST(a.hqla_d AS DOUBLE) / nullif(CAST(a.net_d AS DOUBLE), 0), 4) AS lcr_ratio,
         a.submission_ids
  FROM net a LEFT JOIN {inst} i ON a.institution_id = i.institution_id)"""


def chain_ctes(max_version: int | None = None, grain: str = "line") -> str:
    bronze = bronze_cte("bronze_all", 999)
    filt = f"WHERE submission_version <= {max_version}" if max_version else ""
    silver = silver_cte("silver", "eligible_bronze", "quarantined")
    if grain == "submission":
        silver = f"""silver AS (
  SELECT institution_id, reporting_period, line_code, currency, CAST(amount AS DECIMAL(20,2)) AS amount,
         submission_id, submission_version, loaded_at AS bronze_loaded_at
  FROM (SELECT b.*, rank() OVER (PARTITION BY institution_id, reporting_period
                                 ORDER BY submission_version DESC, loaded_at DESC) AS rk
        FROM eligible_bronze b WHERE submission_id NOT IN (SELECT submission_id FROM quarantined))
  WHERE rk = 1)"""
    return f"""WITH {bronze},
eligible_bronze AS (SELECT * FROM bronze_all {filt}),
{rule_failures_cte('fails', 'eligible_bronze')},
{rule_results_cte('dq', 'fails', RUN1)},
{quarantine_cte('quarantined', 'dq')},
{silver},
{institutions_cte('inst', 999)},
{CODES},
{gold_select('silver', 'inst')}"""


GOLD_COLS = ("institution_id, institution_name, institution_type, peer_group, reporting_period, "
             "hqla, outflows, inflows, net_outflows, lcr_ratio, submission_ids")

SQL: dict[str, str] = {}

SQL["lcr_gold_ratio"] = chain_ctes() + f"\nSELECT {GOLD_COLS} FROM gold"
SQL["lcr_silver_current"] = chain_ctes() + "\nSELECT * FROM silver"
SQL["lcr_silver_by_submission"] = chain_ctes(grain="submission") + "\nSELECT * FROM silver"
SQL["lcr_gold_asof"] = chain_ctes(max_version=300) + f"\nSELECT {GOLD_COLS} FROM gold"

SQL["gold_by_change"] = SQL["lcr_gold_ratio"]

# --------------------------------------------------------------- rules engine

RULES_BASE = f"""WITH {lines_cte('rin', 999, True)},
{rule_failures_cte('fails', 'rin')},
{rule_results_cte('dq', 'fails', RUN1)}"""

RESULT_COLS = "rule_id, submission_id, severity, records_tested, records_failed, outcome"

SQL["dq_not_null"] = RULES_BASE + f"\nSELECT {RESULT_COLS} FROM dq WHERE rule_id = 'LCR-001'"
SQL["dq_accepted_values"] = RULES_BASE + f"\nSELECT {RESULT_COLS} FROM dq WHERE rule_id IN ('LCR-002', 'LCR-003')"
SQL["dq_range"] = RULES_BASE + f"\nSELECT {RESULT_COLS} FROM dq WHERE rule_id = 'LCR-004'"
SQL["dq_unique"] = RULES_BASE + f"\nSELECT {RESULT_COLS} FROM dq WHERE rule_id = 'LCR-005'"
SQL["dq_aggregate_expr"] = RULES_BASE + f"\nSELECT {RESULT_COLS} FROM dq WHERE rule_id = 'LCR-006'"
SQL["dq_all_rules_by_submission"] = RULES_BASE + f"\nSELECT {RESULT_COLS} FROM dq"
SQL["dq_gate_status"] = RULES_BASE + """
SELECT submission_id,
       CASE WHEN count(*) FILTER (WHERE severity = 'blocking' AND outcome = 'FAIL') > 0
            THEN 'QUARANTINED' ELSE 'ACCEPTED' END AS status,
       count(*) FILTER (WHERE severity = 'blocking' AND outcome = 'FAIL') AS blocking_failures
FROM dq GROUP BY submission_id"""

SQL["dq_row_expr"] = chain_ctes() + """
SELECT 'LCR-101' AS rule_id, institution_id, 'warning' AS severity, count(*) AS records_tested,
       count(*) FILTER (WHERE NOT (lcr_ratio BETWEEN 0.5 AND 10)) AS records_failed,
       CASE WHEN count(*) FILTER (WHERE NOT (lcr_ratio BETWEEN 0.5 AND 10)) = 0 THEN 'PASS' ELSE 'FAIL' END
         AS outcome
FROM gold GROUP BY institution_id"""

HISTORY = f"""WITH {lines_cte('rin', 999, True)},
{lines_cte('clean', 999, False)},
{rule_failures_cte('fails1', 'rin')},
{rule_results_cte('dq1', 'fails1', RUN1)},
{rule_failures_cte('fails2', 'clean')},
{rule_results_cte('dq2', 'fails2', RUN2)},
hist AS (SELECT * FROM dq1 UNION ALL SELECT * FROM dq2)"""

SQL["dq_failures_by_rule"] = HISTORY + """
SELECT rule_id, submission_id, count(*) AS failed_runs, CAST(sum(records_failed) AS BIGINT) AS records_failed
FROM hist WHERE outcome = 'FAIL' GROUP BY rule_id, submission_id"""

BRONZE_OUT = ("institution_id, reporting_period, line_code, currency, amount, submission_id, "
              "submission_version, source_uri, source_sha256, loaded_at")
CLEAN_AUDIT = """
SELECT institution_id, reporting_period, line_code, currency, amount, submission_id, submission_version,
       'raw/' || institution_id || '/LCR/' || reporting_period || '/v' || CAST(submission_version AS VARCHAR)
         || '/' || institution_id || '_LCR_' || reporting_period || '_v' || CAST(submission_version AS VARCHAR)
         || '.csv' AS source_uri,
       sha256(submission_id) AS source_sha256, loaded_at
FROM clean"""

SQL["quarantine_antijoin"] = HISTORY + f""",
q AS (SELECT DISTINCT submission_id FROM hist
      WHERE stage = 'bronze' AND severity = 'blocking' AND outcome = 'FAIL')
SELECT * FROM ({CLEAN_AUDIT}) WHERE submission_id NOT IN (SELECT submission_id FROM q)"""

SQL["quarantine_latest_run"] = HISTORY + f""",
last_run AS (SELECT submission_id, max(checked_at) AS checked_at FROM hist GROUP BY submission_id),
q AS (SELECT DISTINCT h.submission_id FROM hist h JOIN last_run r
        ON h.submission_id = r.submission_id AND h.checked_at = r.checked_at
      WHERE h.stage = 'bronze' AND h.severity = 'blocking' AND h.outcome = 'FAIL')
SELECT * FROM ({CLEAN_AUDIT}) WHERE submission_id NOT IN (SELECT submission_id FROM q)"""

# ---------------------------------------------------------------- model tests

SQL["checks_not_null"] = chain_ctes() + """
SELECT * FROM (
  SELECT 'not_null_silver_' || c AS rule_id, 'silver' AS stage, 'error' AS severity,
         (SELECT count(*) FROM silver) AS records_tested, n AS records_failed,
         CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS outcome
  FROM (SELECT 'institution_id' AS c, count(*) FILTER (WHERE institution_id IS NULL) AS n FROM silver
        UNION ALL SELECT 'reporting_period', count(*) FILTER (WHERE reporting_period IS NULL) FROM silver
        UNION ALL SELECT 'line_code', count(*) FILTER (WHERE line_code IS NULL) FROM silver
        UNION ALL SELECT 'amount', count(*) FILTER (WHERE amount IS NULL) FROM silver)
  UNION ALL
  SELECT 'accepted_values_silver_line_code', 'silver', 'error', (SELECT count(*) FROM silver),
         count(*) FILTER (WHERE line_code IS NOT NULL AND line_code NOT IN
           ('HQLA_L1', 'HQLA_L2A', 'HQLA_L2B', 'OUT_RETAIL', 'OUT_WHOLESALE', 'OUT_OTHER', 'IN_TOTAL')),
         CASE WHEN count(*) FILTER (WHERE line_code IS NOT NULL AND line_code NOT IN
           ('HQLA_L1', 'HQLA_L2A', 'HQLA_L2B', 'OUT_RETAIL', 'OUT_WHOLESALE', 'OUT_OTHER', 'IN_TOTAL')) = 0
              THEN 'PASS' ELSE 'FAIL' END
  FROM silver
  UNION ALL
  SELECT 'assert_one_current_version', 'silver', 'error', (SELECT count(*) FROM silver), count(*),
         CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END
  FROM (SELECT institution_id, reporting_period, line_code, currency FROM silver GROUP BY ALL HAVING count(*) > 1)
  UNION ALL
  SELECT 'not_null_gold_' || c, 'gold', 'error', (SELECT count(*) FROM gold), n,
         CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END
  FROM (SELECT 'institution_id' AS c, count(*) FILTER (WHERE institution_id IS NULL) AS n FROM gold
        UNION ALL SELECT 'reporting_period', count(*) FILTER (WHERE reporting_period IS NULL) FROM gold
        UNION ALL SELECT 'lcr_ratio', count(*) FILTER (WHERE lcr_ratio IS NULL) FROM gold)
  UNION ALL
  SELECT 'LCR-101', 'gold', 'warning', count(*),
         count(*) FILTER (WHERE NOT (lcr_ratio BETWEEN 0.5 AND 10)),
         CASE WHEN count(*) FILTER (WHERE NOT (lcr_ratio BETWEEN 0.5 AND 10)) = 0 THEN 'PASS' ELSE 'FAIL' END
  FROM gold)"""

SQL["checks_one_current_version"] = f"""WITH {lines_cte('clean', 999, False)},
{silver_cte('silver', 'clean', None)},
dup AS (SELECT institution_id, reporting_period, line_code, currency, count(*) AS n
        FROM silver GROUP BY ALL HAVING count(*) > 1)
SELECT count(*) AS failing_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS failing_rows FROM dup"""

SQL["checks_ratio_plausible"] = chain_ctes() + """
SELECT institution_id, reporting_period, lcr_ratio FROM gold WHERE NOT (lcr_ratio BETWEEN 0.5 AND 10)"""

# ------------------------------------------------------ structural validation

NUM_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
CONTRACT_LIST = "['institution_id', 'reporting_period', 'line_code', 'currency', 'amount']"
HDR_REORDERED = "['reporting_period', 'institution_id', 'line_code', 'currency', 'amount']"
HDR_SHORT = "['institution_id', 'reporting_period', 'line_code', 'currency']"


def _q(s: str) -> str:
    return s.replace("'", "''")


STRUCT_BASE = f"""WITH files AS (
  SELECT o.o_orderkey,
         'FI' || lpad(CAST(o.o_custkey % 999 + 1 AS VARCHAR), 3, '0') AS inst,
         strftime(o.o_orderdate, '%Y-%m') AS period,
         CAST(o.o_orderkey + 1 AS INTEGER) AS version,
         CASE WHEN o.o_orderkey % 31 = 0 THEN 1 WHEN o.o_orderkey % 37 = 0 THEN 2 ELSE 0 END AS htype
  FROM orders o),
files2 AS (
  SELECT *, inst || '-LCR-' || period || '-v' || CAST(version AS VARCHAR) AS submission_id FROM files),
cells AS (
  SELECT f.submission_id, f.o_orderkey,
         CAST(row_number() OVER (PARTITION BY l.l_orderkey
              ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice) + 1 AS BIGINT) AS n,
         CASE WHEN l.l_partkey % 71 = 0 THEN 'X' || f.inst ELSE f.inst END AS v1,
         CASE WHEN l.l_partkey % 73 = 0 THEN replace(f.period, '-', '/') ELSE f.period END AS v2,
         ({LINE_CODES_SQL})[l.l_linenumber] AS v3,
         CASE WHEN l.l_partkey % 67 = 0 THEN '' ELSE 'MYR' END AS v4,
         CASE WHEN f.htype = 2 THEN '' WHEN l.l_partkey % 53 = 0 THEN 'x' WHEN l.l_partkey % 59 = 0 THEN ''
              WHEN l.l_partkey % 61 = 0 THEN '1_000'
              ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(20,2)) AS VARCHAR) END AS v5,
         CAST(l.l_extendedprice AS DECIMAL(20,2)) AS true_amt
  FROM files2 f JOIN lineitem l ON l.l_orderkey = f.o_orderkey),
totals AS (
  SELECT f.submission_id, f.o_orderkey, f.htype,
         count(c.n) AS record_count,
         coalesce(sum(TRY_CAST(c.v5 AS DECIMAL(38,6))) FILTER (WHERE regexp_matches(c.v5, '{NUM_RE}')),
                  CAST(0 AS DECIMAL(38,6))) AS vt,
         CASE WHEN f.o_orderkey % 53 = 0 THEN NULL
              ELSE count(c.n) + CASE WHEN f.o_orderkey % 29 = 0 THEN 1 ELSE 0 END END AS m_count,
         CASE WHEN f.o_orderkey % 53 = 0 THEN NULL
              ELSE CAST(round(coalesce(sum(c.true_amt), 0), 2) AS DOUBLE) END AS m_total
  FROM files2 f LEFT JOIN cells c ON c.o_orderkey = f.o_orderkey
  GROUP BY f.submission_id, f.o_orderkey, f.htype),
errs AS (
  SELECT submission_id, 0 AS grp, 0 AS n, 0 AS p, 0 AS k,
         'header ' || CASE htype WHEN 1 THEN '{_q(HDR_REORDERED)}' ELSE '{_q(HDR_SHORT)}' END
         || ' != contract ' || '{_q(CONTRACT_LIST)}' AS message
  FROM files2 WHERE htype > 0
  UNION ALL
  SELECT submission_id, 1, n, 1, 1, 'line ' || CAST(n AS VARCHAR) || ': institution_id is required'
  FROM cells WHERE v1 = ''
  UNION ALL
  SELECT submission_id, 1, n, 1, 3, 'line ' || CAST(n AS VARCHAR) || ': institution_id=''' || v1
         || ''' does not match ^FI[0-9]{{3}}$'
  FROM cells WHERE v1 <> '' AND NOT regexp_matches(v1, '^FI[0-9]{{3}}$')
  UNION ALL
  SELECT submission_id, 1, n, 2, 1, 'line ' || CAST(n AS VARCHAR) || ': reporting_period is required'
  FROM cells WHERE v2 = ''
  UNION ALL
  SELECT submission_id, 1, n, 2, 3, 'line ' || CAST(n AS VARCHAR) || ': reporting_period=''' || v2
         || ''' does not match ^[0-9]{{4}}-[0-9]{{2}}$'
  FROM cells WHERE v2 <> '' AND NOT regexp_matches(v2, '^[0-9]{{4}}-[0-9]{{2}}$')
  UNION ALL
  SELECT submission_id, 1, n, 3, 1, 'line ' || CAST(n AS VARCHAR) || ': line_code is required'
  FROM cells WHERE v3 = ''
  UNION ALL
  SELECT submission_id, 1, n, 4, 1, 'line ' || CAST(n AS VARCHAR) || ': currency is required'
  FROM cells WHERE v4 = ''
  UNION ALL
  SELECT submission_id, 1, n, 5, 1, 'line ' || CAST(n AS VARCHAR) || ': amount is required'
  FROM cells WHERE v5 = ''
  UNION ALL
  SELECT submission_id, 1, n, 5, 2, 'line ' || CAST(n AS VARCHAR) || ': amount=''' || v5 || ''' is not a number'
  FROM cells WHERE v5 <> '' AND NOT regexp_matches(v5, '{NUM_RE}')
  UNION ALL
  SELECT submission_id, 2, 0, 0, 0,
         CASE WHEN m_count IS NULL THEN 'manifest missing'
              ELSE 'record count ' || CAST(record_count AS VARCHAR) || ' != manifest ' || CAST(m_count AS VARCHAR) END
  FROM totals WHERE m_count IS NULL OR m_count <> record_count
  UNION ALL
  SELECT submission_id, 3, 0, 0, 0,
         'control total ' || CAST(CAST(round(vt, 2) AS DECIMAL(38,2)) AS VARCHAR) || ' != manifest '
         || CAST(CAST(m_total AS DECIMAL(38,2)) AS VARCHAR)
  FROM totals WHERE m_total IS NOT NULL AND abs(CAST(round(vt, 2) AS DOUBLE) - m_total) > 0.01),
numbered AS (
  SELECT submission_id, row_number() OVER (PARTITION BY submission_id ORDER BY grp, n, p, k) AS error_no, message
  FROM errs),
nerr AS (SELECT submission_id, count(*) AS n_errors FROM errs GROUP BY submission_id)"""

SQL["structural_errors"] = STRUCT_BASE + """
SELECT submission_id, CAST(error_no AS INTEGER) AS error_no, message FROM numbered WHERE error_no <= 200"""

SQL["structural_counts"] = STRUCT_BASE + """
SELECT t.submission_id,
       CASE WHEN coalesce(e.n_errors, 0) = 0 THEN 'VALIDATED' ELSE 'REJECTED' END AS status,
       coalesce(e.n_errors, 0) AS n_errors, t.record_count,
       CASE WHEN coalesce(e.n_errors, 0) > 0 THEN CAST(e.n_errors AS VARCHAR) || ' structural errors' END AS reason
FROM totals t LEFT JOIN nerr e ON t.submission_id = e.submission_id"""

SQL["control_total_check"] = STRUCT_BASE + """
SELECT submission_id, record_count, m_count AS manifest_record_count,
       CAST(round(vt, 2) AS DECIMAL(38,2)) AS control_total, m_total AS manifest_control_total,
       record_count = m_count AS count_ok,
       abs(CAST(round(vt, 2) AS DOUBLE) - m_total) <= 0.01 AS total_ok
FROM totals"""

# -------------------------------------------------------------------- intake

NAME_RE = r"^(FI[0-9]{3})_(LCR)_([0-9]{4}-[0-9]{2})_v([0-9]+)\.csv$"

INTAKE_BASE = f"""WITH lf AS (
  SELECT doc_id, text,
         'FI' || lpad(CAST(doc_id % 999 + 1 AS VARCHAR), 3, '0') || '_LCR_2024-'
           || lpad(CAST(doc_id % 12 + 1 AS VARCHAR), 2, '0') || '_v' || CAST(doc_id % 2 + 1 AS VARCHAR)
           || '.csv' AS good
  FROM documents),
lf2 AS (
  SELECT doc_id, text,
         CASE WHEN doc_id % 17 = 0 THEN 'FI' || CAST(doc_id AS VARCHAR) || '_LCR.csv'
              WHEN doc_id % 19 = 0 THEN lower(good) ELSE good END AS file_name,
         sha256(text) AS sha256,
         TIMESTAMP '2024-03-01 00:00:00' + to_minutes(CAST(doc_id AS BIGINT)) AS received_at,
         doc_id % 23 <> 0 AS manifest_ok,
         CASE WHEN doc_id % 23 = 0 THEN NULL WHEN doc_id % 29 = 0 THEN sha256(text || 'x')
              ELSE sha256(text) END AS manifest_sha256
  FROM lf),
files AS (
  SELECT 'landing/' || CAST(doc_id AS VARCHAR) || '/' || file_name AS path, *,
         regexp_matches(file_name, '{NAME_RE}') AS name_ok
  FROM lf2),
parsed AS (
  SELECT *,
         CASE WHEN name_ok THEN regexp_extract(file_name, '{NAME_RE}', 1) END AS institution_id,
         CASE WHEN name_ok THEN regexp_extract(file_name, '{NAME_RE}', 2) END AS return_type,
         CASE WHEN name_ok THEN regexp_extract(file_name, '{NAME_RE}', 3) END AS reporting_period,
         CASE WHEN name_ok THEN CAST(regexp_extract(file_name, '{NAME_RE}', 4) AS INTEGER) END AS version,
         manifest_ok AND coalesce(sha256 = manifest_sha256, false) AS checksum_ok
  FROM files),
keyed AS (
  SELECT *,
         institution_id || '-' || return_type || '-' || reporting_period || '-v' || CAST(version AS VARCHAR)
           AS submission_id,
         institution_id || '/' || return_type || '/' || reporting_period || '/v' || CAST(version AS VARCHAR)
           || '/' || file_name AS raw_key
  FROM parsed),
by_sha AS (
  SELECT path,
         row_number() OVER (PARTITION BY sha256 ORDER BY received_at, path, file_name) AS rn_sha,
         first_value(file_name) OVER (PARTITION BY sha256 ORDER BY received_at, path, file_name) AS first_file
  FROM keyed WHERE name_ok AND manifest_ok AND checksum_ok),
by_name AS (
  SELECT k.path,
         row_number() OVER (PARTITION BY k.institution_id, k.return_type, k.reporting_period, k.version
                            ORDER BY k.received_at, k.path, k.file_name) AS rn_name
  FROM keyed k JOIN by_sha s ON k.path = s.path WHERE s.rn_sha = 1),
verdicts AS (
  SELECT k.*, s.rn_sha, s.first_file, n.rn_name,
         CASE WHEN NOT k.name_ok OR NOT k.manifest_ok OR NOT k.checksum_ok THEN 'REJECTED'
              WHEN s.rn_sha > 1 THEN 'DUPLICATE'
              WHEN n.rn_name > 1 THEN 'VERSION_CONFLICT' ELSE 'RECEIVED' END AS verdict,
         CASE WHEN NOT k.name_ok THEN 'file name does not match the contract pattern'
              WHEN NOT k.manifest_ok THEN 'manifest missing'
              WHEN NOT k.checksum_ok THEN 'SHA-256 does not match manifest'
              WHEN s.rn_sha > 1 THEN 'identical file already received'
              WHEN n.rn_name > 1 THEN 'version already received' END AS reason
  FROM keyed k LEFT JOIN by_sha s ON k.path = s.path LEFT JOIN by_name n ON k.path = n.path)"""

SQL["intake_receipts"] = INTAKE_BASE + """
SELECT submission_id, '{"submission_id":"' || submission_id || '","status":"RECEIVED","raw_uri":"' || path
       || '","sha256":"' || sha256 || '","received_at":"' || CAST(received_at AS VARCHAR) || '"}' AS receipt
FROM verdicts WHERE verdict = 'RECEIVED'"""

SQL["intake_name_parse"] = INTAKE_BASE + """
SELECT path, file_name, name_ok, institution_id, return_type, reporting_period, version, submission_id, raw_key
FROM keyed"""

SQL["intake_checksum"] = INTAKE_BASE + """
SELECT path, sha256, manifest_ok, manifest_sha256, checksum_ok FROM keyed"""

SQL["intake_duplicate"] = INTAKE_BASE + """
SELECT path, sha256, first_file AS duplicate_of_file FROM verdicts WHERE verdict = 'DUPLICATE'"""

SQL["intake_verdict"] = INTAKE_BASE + """
SELECT path, submission_id, verdict, reason FROM verdicts"""

# -------------------------------------------------------------------- ledger

LEDGER_BASE = RULES_BASE + """,
gate AS (
  SELECT submission_id,
         CASE WHEN count(*) FILTER (WHERE severity = 'blocking' AND outcome = 'FAIL') > 0
              THEN 'QUARANTINED' ELSE 'ACCEPTED' END AS status
  FROM dq GROUP BY submission_id),
subs AS (SELECT submission_id, min(loaded_at) AS loaded_at FROM rin GROUP BY submission_id),
events AS (
  SELECT submission_id, 'RECEIVED' AS status, loaded_at - INTERVAL 1 HOUR AS created_at, 1 AS rk FROM subs
  UNION ALL
  SELECT g.submission_id, g.status, s.loaded_at + INTERVAL 1 HOUR,
         CASE WHEN g.status = 'ACCEPTED' THEN 4 ELSE 5 END
  FROM gate g JOIN subs s ON g.submission_id = s.submission_id
  UNION ALL
  SELECT g.submission_id, 'PUBLISHED', s.loaded_at + INTERVAL 2 HOUR, 6
  FROM gate g JOIN subs s ON g.submission_id = s.submission_id WHERE g.status = 'ACCEPTED')"""

SQL["ledger_current_status"] = LEDGER_BASE + """
SELECT submission_id, arg_max(status, created_at) AS status,
       CASE WHEN arg_max(status, created_at) = 'QUARANTINED' THEN 'blocking quality rule failed' END
         AS status_reason,
       min(created_at) AS received_at, max(created_at) AS updated_at, count(*) AS n_events
FROM events GROUP BY submission_id"""

SQL["ledger_time_in_status"] = LEDGER_BASE + """
SELECT submission_id, status, created_at,
       lead(created_at) OVER (PARTITION BY submission_id ORDER BY created_at, rk) AS left_at,
       date_diff('second', created_at,
                 lead(created_at) OVER (PARTITION BY submission_id ORDER BY created_at, rk)) AS seconds_in_status
FROM events"""

# --------------------------------------------------------------- Bronze replay

def audit_select(src: str) -> str:
    return f"""
SELECT institution_id, reporting_period, line_code, currency, amount, submission_id, submission_version,
       'raw/' || institution_id || '/LCR/' || reporting_period || '/v' || CAST(submission_version AS VARCHAR)
         || '/' || institution_id || '_LCR_' || reporting_period || '_v' || CAST(submission_version AS VARCHAR)
         || '.csv' AS source_uri,
       sha256(submission_id) AS source_sha256, loaded_at
FROM {src}"""


SQL["bronze_replay_replace"] = f"""WITH {lines_cte('clean', 999, False)},
{lines_cte('rin', 999, True)},
base AS ({audit_select('clean')}),
replay AS ({audit_select('rin')} WHERE submission_version = 3)
SELECT * FROM base WHERE submission_id NOT IN (SELECT submission_id FROM replay)
UNION ALL
SELECT * FROM replay"""

SQL["bronze_moved_emptied"] = f"""WITH {lines_cte('clean', 999, False)},
base AS ({audit_select('clean')})
SELECT * FROM base WHERE submission_version <> 3 AND NOT (submission_version = 2 AND institution_id LIKE '%7')
UNION ALL
SELECT * REPLACE (CAST(CAST(reporting_period[1:4] AS INTEGER) + 1 AS VARCHAR) || reporting_period[5:7] AS reporting_period)
FROM base WHERE submission_version = 3"""

SQL["bronze_asof_redelivery"] = f"""WITH {lines_cte('clean', 999, False)},
base AS ({audit_select('clean')})
SELECT reporting_period, submission_version, count(*) AS n_rows, count(DISTINCT submission_id) AS submissions,
       CAST(sum(amount) AS DECIMAL(38,2)) AS amount
FROM base WHERE submission_version = 3 OR (submission_version = 2 AND institution_id LIKE '%7') GROUP BY ALL"""

_FLOW = f"""WITH {lines_cte('flow', 999, True)},
returns AS (SELECT * FROM flow WHERE submission_version >= 4),
{rule_failures_cte('fails', 'returns')},
{CODES},
judged AS (
  SELECT r.submission_id, r.institution_id, r.reporting_period, r.submission_version,
         CASE WHEN f.f1 > 0 THEN 'REJECTED' WHEN f.f2 + f.f3 + f.f4 + f.f5 + f.f6 > 0 THEN 'QUARANTINED' ELSE 'ACCEPTED' END AS verdict
  FROM (SELECT DISTINCT submission_id, institution_id, reporting_period, submission_version FROM returns) r
  JOIN fails f ON f.submission_id = r.submission_id),
newest AS (
  SELECT * FROM judged WHERE verdict = 'ACCEPTED'
  QUALIFY row_number() OVER (PARTITION BY institution_id, reporting_period ORDER BY submission_version DESC) = 1)"""

# a structurally rejected return has two events, a quarantined or superseded one three
SQL["flow_taken_up_status"] = _FLOW + """
SELECT j.submission_id, CASE WHEN n.submission_id IS NOT NULL THEN 'PUBLISHED' ELSE j.verdict END AS status,
       CASE WHEN n.submission_id IS NOT NULL THEN 4 WHEN j.verdict = 'REJECTED' THEN 2 ELSE 3 END AS n_events
FROM judged j LEFT JOIN newest n ON n.submission_id = j.submission_id"""

SQL["flow_taken_up_gold"] = _FLOW + """,
sums AS (
  SELECT n.institution_id, n.reporting_period, n.submission_id,
         sum(r.amount * c.weight) FILTER (WHERE c.category = 'HQLA') AS h, sum(r.amount) FILTER (WHERE c.category = 'OUTFLOW') AS o,
         sum(r.amount) FILTER (WHERE c.category = 'INFLOW') AS i
  FROM newest n JOIN returns r ON r.submission_id = n.submission_id JOIN codes c ON c.line_code = r.line_code GROUP BY ALL),
net AS (SELECT *, o - least(CAST(i AS DECIMAL(24,4)), CAST(0.75 * o AS DECIMAL(24,4))) AS net FROM sums)
SELECT institution_id, reporting_period, CAST(round(h, 2) AS DOUBLE) AS hqla, CAST(round(net, 2) AS DOUBLE) AS net_outflows,
       round(CAST(h AS DOUBLE) / nullif(CAST(net AS DOUBLE), 0), 4) AS lcr_ratio, submission_id AS submission_ids
FROM net"""

SQL["dq_results_by_day"] = HISTORY + """
SELECT CAST(checked_at AS DATE) AS checked_day, rule_id, outcome, count(*) AS results FROM hist GROUP BY ALL"""

SQL["orders_evolving"] = """SELECT o_orderkey, o_orderdate,
       CASE WHEN o_orderkey % 2 <> 0 THEN o_totalprice END AS o_totalprice FROM orders"""

# ------------------------------------------------------------- payment events

EVENTS_BASE = """WITH ev AS (
  SELECT event_id AS eid, ts, user_id, event_type, value,
         CASE WHEN event_id % 170 = 0 THEN 7 WHEN event_id % 50 = 0 THEN (event_id // 50) % 4 + 1 ELSE 0 END
           AS shift
  FROM events),
typed AS (
  SELECT CAST(eid AS VARCHAR) AS event_id,
         'FI' || lpad(CAST(user_id % 999 + 1 AS VARCHAR), 3, '0') AS institution_id,
         epoch_us(ts - to_minutes(CAST(shift AS BIGINT))) // 1000 AS event_time,
         (['RTGS', 'INSTANT', 'CARD', 'CHEQUE'])[user_id % 4 + 1] AS payment_system,
         CASE WHEN eid % 140 = 7 THEN 'BOTH' WHEN eid % 2 = 0 THEN 'OUT' ELSE 'IN' END AS direction,
         value AS amount, 'MYR' AS currency,
         CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'PENDING' ELSE 'SETTLED' END AS status,
         eid % 250 = 0 AS malformed, ts AS arrival, eid
  FROM ev),
raw AS (
  SELECT * FROM typed
  UNION ALL
  SELECT * REPLACE (arrival + CASE WHEN eid % 300 = 0 THEN INTERVAL 15 MINUTE ELSE INTERVAL 30 SECOND END
                    AS arrival)
  FROM typed WHERE eid % 100 = 0),
good AS (
  SELECT *, make_timestamp(event_time * 1000) AS event_ts FROM raw WHERE NOT malformed)"""

EVENT_COLS_SQL = "event_id, institution_id, event_ts, payment_system, direction, amount, currency, status"
STATS_SQL = """
SELECT date_trunc('minute', event_ts) AS window_start,
       date_trunc('minute', event_ts) + INTERVAL 1 MINUTE AS window_end,
       institution_id, payment_system, count(*) AS event_count,
       CAST(sum(CAST(amount AS DECIMAL(38,10))) AS DOUBLE) AS total_amount,
       count(*) FILTER (WHERE status = 'FAILED') AS failed_count
FROM {src} GROUP BY ALL"""

SQL["events_dedup"] = EVENTS_BASE + f"\nSELECT DISTINCT {EVENT_COLS_SQL} FROM good"
SQL["minute_stats"] = EVENTS_BASE + STATS_SQL.format(src="good")
SQL["minute_stats_dedup"] = EVENTS_BASE + STATS_SQL.format(
    src=f"(SELECT DISTINCT {EVENT_COLS_SQL} FROM good)")
SQL["minute_stats_late"] = EVENTS_BASE + """
SELECT date_trunc('minute', event_ts) AS window_start, institution_id, payment_system,
       count(*) FILTER (WHERE (epoch_us(arrival) // 1000) - event_time <= 300000) AS event_count,
       count(*) FILTER (WHERE (epoch_us(arrival) // 1000) - event_time > 0
                          AND (epoch_us(arrival) // 1000) - event_time <= 300000) AS late_count,
       count(*) FILTER (WHERE (epoch_us(arrival) // 1000) - event_time > 300000) AS dropped_count
FROM good GROUP BY ALL"""
SQL["stream_bronze_events"] = SQL["events_dedup"]
SQL["stream_bronze_compacted"] = SQL["events_dedup"]
SQL["stream_minute_stats"] = SQL["minute_stats"]
SQL["stream_dlq"] = EVENTS_BASE + """
SELECT event_id AS source_event_id, 'malformed JSON' AS error FROM raw WHERE malformed"""

# windows refuse what ended more than 5 minutes before the largest event time of the batches before
SQL["stream_late_events"] = EVENTS_BASE + """,
ends AS (SELECT epoch_us(min(arrival)) // 1000 AS lo, epoch_us(max(arrival)) // 1000 AS hi FROM raw),
batched AS (
  SELECT g.*, least(3, CAST(floor((epoch_us(arrival) // 1000 - lo) * 4 / greatest(hi - lo, 1)) AS INTEGER))
           + CASE WHEN eid % 170 = 0 THEN 1 ELSE 0 END AS batch, event_time // 60000 * 60000 AS window_ms
  FROM good g, ends),
largest AS (SELECT batch, max(event_time) AS m FROM batched GROUP BY batch),
flagged AS (
  SELECT b.*, coalesce(window_ms + 60000 <= (SELECT max(m) FROM largest l WHERE l.batch < b.batch) - 300000, false) AS late
  FROM batched b)
SELECT make_timestamp(window_ms * 1000) AS window_start, institution_id, payment_system,
       count(*) FILTER (WHERE NOT late) AS event_count, count(*) FILTER (WHERE late) AS late_count
FROM flagged GROUP BY ALL"""

# every copy comes in its original's batch or the next one, so it is within the horizon
SQL["stream_dedup_bounded"] = SQL["events_dedup"]

# with the event that closes the stream
SQL["stream_rules"] = EVENTS_BASE + """
SELECT 'PAY-001' AS rule_id, 'blocking' AS severity, count(*) + 1 AS records_tested,
       count(*) FILTER (WHERE event_id IS NULL OR institution_id IS NULL OR event_time IS NULL OR amount IS NULL) AS records_failed FROM good
UNION ALL SELECT 'PAY-002', 'blocking', count(*) + 1, count(*) FILTER (WHERE amount < 0) FROM good
UNION ALL SELECT 'PAY-004', 'blocking', count(*) + 1,
       count(*) FILTER (WHERE status IS NULL OR status NOT IN ('SETTLED', 'PENDING', 'FAILED')) FROM good"""

# ------------------------------------------------------------------- serving

SQL["serve_ratio_by_institution"] = chain_ctes() + """
SELECT institution_id, reporting_period, lcr_ratio, lcr_ratio < 1.0 AS below_minimum FROM gold"""

SQL["serve_ratio_trend"] = chain_ctes() + """
SELECT reporting_period, peer_group,
       CAST(sum(CAST(lcr_ratio AS DECIMAL(38,4))) AS DOUBLE) / CAST(nullif(count(lcr_ratio), 0) AS DOUBLE)
         AS avg_lcr_ratio,
       count(lcr_ratio) AS n_ratios
FROM gold GROUP BY reporting_period, peer_group"""

SQL["serve_below_threshold"] = chain_ctes() + """
SELECT institution_id, institution_name, reporting_period, lcr_ratio FROM gold WHERE lcr_ratio < 1.2"""

SQL["serve_point_lookup"] = chain_ctes() + f"""
SELECT {GOLD_COLS} FROM gold WHERE institution_id = 'FI001' AND reporting_period = '1993-01'"""

SQL["policy_mask"] = chain_ctes() + """
SELECT institution_id, '***' AS institution_name, institution_type, peer_group, reporting_period,
       hqla, outflows, inflows, net_outflows, lcr_ratio, submission_ids FROM gold"""

SQL["policy_row_filter"] = chain_ctes() + f"""
SELECT {GOLD_COLS} FROM gold WHERE institution_id IN ('FI001', 'FI002')"""

SQL["lineage_trace"] = chain_ctes() + """,
files AS (
  SELECT DISTINCT submission_id,
         'raw/' || institution_id || '/LCR/' || reporting_period || '/v' || CAST(submission_version AS VARCHAR)
           || '/' || institution_id || '_LCR_' || reporting_period || '_v' || CAST(submission_version AS VARCHAR)
           || '.csv' AS source_uri,
         sha256(submission_id) AS source_sha256
  FROM bronze_all),
g AS (SELECT institution_id, reporting_period, lcr_ratio, unnest(string_split(submission_ids, ',')) AS submission_id
      FROM gold)
SELECT g.submission_id, g.institution_id, g.reporting_period, g.lcr_ratio, f.source_uri, f.source_sha256
FROM g LEFT JOIN files f ON g.submission_id = f.submission_id"""


def _mixed() -> str:
    # the chain's CTE list, then the event CTEs appended to it
    events = EVENTS_BASE[len("WITH "):]
    return chain_ctes() + ",\n" + events + """,
stats AS (
  SELECT date_trunc('minute', event_ts) AS window_start, institution_id, payment_system, count(*) AS event_count,
         CAST(sum(CAST(amount AS DECIMAL(38,10))) AS DOUBLE) AS total_amount,
         count(*) FILTER (WHERE status = 'FAILED') AS failed_count
  FROM good GROUP BY ALL),
monthly AS (
  SELECT institution_id, strftime(window_start, '%Y-%m') AS month, CAST(sum(event_count) AS BIGINT) AS event_count,
         CAST(sum(CAST(total_amount AS DECIMAL(38,10))) AS DOUBLE) AS total_amount,
         CAST(sum(failed_count) AS BIGINT) AS failed_count
  FROM stats GROUP BY ALL),
latest AS (
  SELECT institution_id, reporting_period AS latest_period, lcr_ratio AS latest_lcr_ratio
  FROM (SELECT *, row_number() OVER (PARTITION BY institution_id ORDER BY reporting_period DESC) AS rn FROM gold)
  WHERE rn = 1)
SELECT m.institution_id, m.month, m.event_count, m.total_amount, m.failed_count, l.latest_period,
       l.latest_lcr_ratio
FROM monthly m LEFT JOIN latest l ON m.institution_id = l.institution_id"""


SQL["mixed_batch_stream"] = _mixed()

# ------------------------------------------------------ contract capabilities

SQL["codelist_violations"] = f"""WITH {lines_cte('rin', 999, True)},
bad AS (
  SELECT submission_id, 'line_code' AS "column", line_code AS value FROM rin
  WHERE line_code IS NOT NULL AND line_code NOT IN
    ('HQLA_L1', 'HQLA_L2A', 'HQLA_L2B', 'OUT_RETAIL', 'OUT_WHOLESALE', 'OUT_OTHER', 'IN_TOTAL')
  UNION ALL
  SELECT submission_id, 'currency', currency FROM rin
  WHERE currency IS NOT NULL AND currency NOT IN ('MYR', 'USD', 'SGD', 'EUR', 'GBP', 'JPY', 'CNY')
  UNION ALL
  SELECT submission_id, 'amount', CAST(amount AS VARCHAR) FROM rin WHERE amount < 0)
SELECT submission_id, "column", value, count(*) AS rows FROM bad GROUP BY ALL"""

SQL["schema_row_check"] = STRUCT_BASE + f""",
typed AS (
  SELECT submission_id, CAST(n AS INTEGER) AS line_no, v1, v2, v3, v4,
         CASE WHEN regexp_matches(v5, '{NUM_RE}') THEN TRY_CAST(v5 AS DECIMAL(20,2)) END AS amount
  FROM cells),
v AS (
  SELECT submission_id, line_no, 1 AS o, 'institution_id' AS property, 'missing' AS violation FROM typed
  WHERE v1 IS NULL OR v1 = ''
  UNION ALL SELECT submission_id, line_no, 2, 'institution_id', 'does not match pattern' FROM typed
  WHERE v1 <> '' AND NOT regexp_matches(v1, '^FI[0-9]{{3}}$')
  UNION ALL SELECT submission_id, line_no, 3, 'reporting_period', 'missing' FROM typed WHERE v2 IS NULL OR v2 = ''
  UNION ALL SELECT submission_id, line_no, 4, 'reporting_period', 'does not match pattern' FROM typed
  WHERE v2 <> '' AND NOT regexp_matches(v2, '^[0-9]{{4}}-[0-9]{{2}}$')
  UNION ALL SELECT submission_id, line_no, 5, 'line_code', 'missing' FROM typed WHERE v3 IS NULL OR v3 = ''
  UNION ALL SELECT submission_id, line_no, 6, 'line_code', 'not in enum' FROM typed
  WHERE v3 <> '' AND v3 NOT IN ('HQLA_L1', 'HQLA_L2A', 'HQLA_L2B', 'OUT_RETAIL', 'OUT_WHOLESALE', 'OUT_OTHER', 'IN_TOTAL')
  UNION ALL SELECT submission_id, line_no, 7, 'currency', 'missing' FROM typed WHERE v4 IS NULL OR v4 = ''
  UNION ALL SELECT submission_id, line_no, 8, 'currency', 'not in enum' FROM typed
  WHERE v4 <> '' AND v4 NOT IN ('MYR', 'USD', 'SGD', 'EUR', 'GBP', 'JPY', 'CNY')
  UNION ALL SELECT submission_id, line_no, 9, 'amount', 'missing' FROM typed WHERE amount IS NULL
  UNION ALL SELECT submission_id, line_no, 10, 'amount', 'below minimum' FROM typed WHERE amount < 0)
SELECT submission_id, line_no, property, violation FROM v"""

SQL["deadline_timeliness"] = f"""WITH {lines_cte('rin', 999, True)},
subs AS (SELECT submission_id, reporting_period, min(loaded_at) AS received_at FROM rin GROUP BY ALL),
d AS (SELECT *, CAST(last_day(CAST(reporting_period || '-01' AS DATE)) + 15 AS DATE) AS deadline FROM subs)
SELECT submission_id, reporting_period, deadline, received_at,
       CAST(greatest(date_diff('day', deadline, CAST(received_at AS DATE)), 0) AS INTEGER) AS days_late,
       CAST(received_at AS DATE) <= deadline AS on_time
FROM d"""

SQL["freshness_p95"] = EVENTS_BASE + """
SELECT institution_id, count(*) AS n,
       CAST(quantile_cont(floor(((epoch_us(arrival) // 1000) - event_time) / 1000), 0.95) AS DOUBLE) AS p95
FROM good GROUP BY institution_id"""

SQL["retention_candidates"] = chain_ctes() + """
SELECT 'bronze' AS zone, reporting_period, count(*) AS row_count,
       CAST(last_day(CAST(reporting_period || '-01' AS DATE)) + INTERVAL 84 MONTH AS DATE) AS expires_on
FROM bronze_all GROUP BY reporting_period
HAVING CAST(last_day(CAST(reporting_period || '-01' AS DATE)) + INTERVAL 84 MONTH AS DATE) < DATE '2006-01-01'
UNION ALL
SELECT 'silver', reporting_period, count(*),
       CAST(last_day(CAST(reporting_period || '-01' AS DATE)) + INTERVAL 120 MONTH AS DATE)
FROM silver GROUP BY reporting_period
HAVING CAST(last_day(CAST(reporting_period || '-01' AS DATE)) + INTERVAL 120 MONTH AS DATE) < DATE '2006-01-01'"""

def token_sql(id_sql: str, key: bytes, version: int) -> str:
    """HMAC of an id by its definition: the key, filled up to 64 bytes, with 36 and with 5c."""
    inner, outer = (bytes(b ^ x for b in key.ljust(64, b"\0")).hex() for x in (0x36, 0x5C))
    return (f"('{version}.' || sha256(from_hex('{outer}') || from_hex(sha256(from_hex('{inner}') || encode({id_sql})))))")


TOKEN_2 = token_sql("institution_id", b"published test key 2", 2)

SQL["tokenise_ids"] = chain_ctes() + f"""
SELECT {TOKEN_2} AS institution_id, reporting_period, line_code, currency, amount,
       {TOKEN_2} || substr(submission_id, length(institution_id) + 1) AS submission_id,
       submission_version, bronze_loaded_at
FROM silver"""

SQL["token_rotation"] = chain_ctes() + f"""
SELECT {TOKEN_2} AS token, institution_id AS raw_id, count(*) AS row_count FROM silver GROUP BY institution_id"""

SQL["retention_archive"] = chain_ctes() + """
SELECT CASE WHEN CAST(last_day(CAST(reporting_period || '-01' AS DATE)) + INTERVAL 84 MONTH AS DATE) < DATE '2006-01-01'
            THEN 'archive' ELSE 'live' END AS place,
       reporting_period, count(*) AS row_count, CAST(sum(amount) AS DECIMAL(38,2)) AS amount
FROM bronze_all GROUP BY reporting_period"""

SQL["freshness_sketch"] = EVENTS_BASE + """
SELECT institution_id, count(*) AS n, true AS within_bound FROM good GROUP BY institution_id"""

SQL["expected_vs_received"] = f"""WITH {lines_cte('rin', 999, True)},
{institutions_cte('inst', 999)},
onb AS (SELECT institution_id, CAST(strftime(active_from, '%Y-%m') || '-01' AS DATE) AS first_day FROM inst),
expected AS (
  SELECT institution_id, strftime(unnest(generate_series(first_day, DATE '2001-08-01', INTERVAL 1 MONTH)), '%Y-%m')
           AS reporting_period
  FROM onb WHERE first_day <= DATE '2001-08-01'),
received AS (SELECT DISTINCT institution_id, reporting_period FROM rin)
SELECT e.institution_id, e.reporting_period FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM received r
                  WHERE r.institution_id = e.institution_id AND r.reporting_period = e.reporting_period)"""

SQL["bitemporal_reference"] = f"""WITH {bronze_cte('b', 999)},
{institutions_cte('one', 999)},
inst AS (
  SELECT institution_id, institution_name, peer_group, active_from FROM one
  UNION ALL
  SELECT institution_id, institution_name || ' II', peer_group, active_from + 1826 FROM one),
facts AS (SELECT DISTINCT institution_id, reporting_period FROM b)
SELECT f.institution_id, f.reporting_period, i.institution_name, i.peer_group, i.active_from
FROM facts f LEFT JOIN inst i
  ON f.institution_id = i.institution_id
 AND i.active_from <= last_day(CAST(f.reporting_period || '-01' AS DATE))
QUALIFY row_number() OVER (PARTITION BY f.institution_id, f.reporting_period ORDER BY i.active_from DESC) = 1"""

SQL["event_rules"] = EVENTS_BASE + """,
batches AS (SELECT *, strftime(arrival, '%Y-%m-%d') AS batch_id FROM good),
u AS (SELECT batch_id, count(*) FILTER (WHERE n > 1) AS f3
      FROM (SELECT batch_id, event_id, count(*) AS n FROM batches GROUP BY ALL) GROUP BY batch_id),
a AS (
  SELECT batch_id, count(*) AS tested,
         count(*) FILTER (WHERE event_id IS NULL OR institution_id IS NULL OR event_time IS NULL
                                OR amount IS NULL) AS f1,
         count(*) FILTER (WHERE amount < 0) AS f2,
         count(*) FILTER (WHERE status IS NULL OR status NOT IN ('SETTLED', 'PENDING', 'FAILED')) AS f4
  FROM batches GROUP BY batch_id),
w AS (SELECT a.*, u.f3 FROM a JOIN u ON a.batch_id = u.batch_id)
SELECT 'PAY-001' AS rule_id, batch_id, 'blocking' AS severity, tested AS records_tested, f1 AS records_failed,
       CASE WHEN f1 = 0 THEN 'PASS' ELSE 'FAIL' END AS outcome FROM w
UNION ALL SELECT 'PAY-002', batch_id, 'blocking', tested, f2, CASE WHEN f2 = 0 THEN 'PASS' ELSE 'FAIL' END FROM w
UNION ALL SELECT 'PAY-003', batch_id, 'warning', tested, f3, CASE WHEN f3 = 0 THEN 'PASS' ELSE 'FAIL' END FROM w
UNION ALL SELECT 'PAY-004', batch_id, 'blocking', tested, f4, CASE WHEN f4 = 0 THEN 'PASS' ELSE 'FAIL' END FROM w"""

SQL["event_enum_check"] = EVENTS_BASE + """
SELECT count(*) FILTER (WHERE payment_system IS NULL OR payment_system NOT IN ('RTGS', 'INSTANT', 'CARD', 'CHEQUE'))
         AS bad_payment_system,
       count(*) FILTER (WHERE direction IS NULL OR direction NOT IN ('OUT', 'IN')) AS bad_direction,
       count(*) FILTER (WHERE status IS NULL OR status NOT IN ('SETTLED', 'PENDING', 'FAILED')) AS bad_status,
       count(*) FILTER (WHERE payment_system IS NULL OR payment_system NOT IN ('RTGS', 'INSTANT', 'CARD', 'CHEQUE')
                          OR direction IS NULL OR direction NOT IN ('OUT', 'IN')
                          OR status IS NULL OR status NOT IN ('SETTLED', 'PENDING', 'FAILED')) AS bad_rows
FROM good"""

SQL["ledger_oldest_received"] = LEDGER_BASE + """
SELECT submission_id, created_at FROM events WHERE status = 'RECEIVED'
ORDER BY created_at, submission_id LIMIT 1"""
