"""Expected results as SQL over the given tables.

Nothing here builds a grid: the expected rows are stated straight from the source
table that the grid was made of, so an error in decoding a grid cannot cancel out.
"""

from __future__ import annotations

from sheetloom.sources.canonical import DEFAULT_NAMES, CanonicalNames

BLANK = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SENTINEL = "('null', '?', 'n/a', 'na', '--', '-', 'none')"


def _strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{BLANK}+|{BLANK}+$', '', 'g')"


# --- source rows with the address that the grid gave them ---------------------------

ORDERS = """
o AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         'orders_' || (o_orderkey // 5000) || '.xlsx' AS workbook,
         CAST((o_orderkey // 500) % 10 + 1 AS INTEGER) AS pos,
         CAST((o_orderkey // 500) % 10 + 1 AS INTEGER) || '. R-'
           || CAST(2100 + (o_orderkey // 500) % 10 + 1 AS INTEGER) AS sheet,
         CAST(13 + o_orderkey % 500 AS INTEGER) AS row
  FROM orders),
os AS (SELECT DISTINCT workbook, sheet, pos FROM o),
d AS (
  SELECT *, CASE WHEN k % 101 <> 7 AND k % 89 = 3 THEN k ELSE k + 1 END AS row_seq,
         k % 25 AS sample_r, (k + 7) % 25 AS report_r
  FROM o WHERE k % 97 <> 5),
band(even, col, label, canonical, confidence, is_min, limited, unit) AS (VALUES
  (TRUE, 12, 'Impurity-1', 'Impurity_1', 0.95::DOUBLE, FALSE, TRUE, '%/w/w'),
  (TRUE, 13, '2-chloro benzamide', 'Chloro_Benzamide_2', 0.95, FALSE, TRUE, '%/w/w'),
  (TRUE, 14, 'Impurity-1', 'Impurity_1', 0.95, FALSE, TRUE, '%/w/w'),
  (TRUE, 15, 'TFMBA', 'TFMBA', 0.95, TRUE, TRUE, '%/w/w'),
  (TRUE, 16, 'Impurity', 'Impurity_generic', 0.95, FALSE, TRUE, '%/w/w'),
  (TRUE, 17, 'col_17', 'unknown_col_17', 0.30, FALSE, FALSE, NULL),
  (TRUE, 18, '5-chloro TFMBA', 'Chloro_TFMBA_5', 0.95, FALSE, TRUE, '%/w/w'),
  (TRUE, 19, 'Peak-A', 'unknown_Peak_A', 0.30, FALSE, TRUE, '%'),
  (TRUE, 20, 'TFMBA Acid', 'TFMBA_Acid', 0.95, FALSE, TRUE, '%/w/w'),
  (FALSE, 12, 'Impurity-1', 'Impurity_1', 0.95, FALSE, TRUE, '%/w/w'),
  (FALSE, 13, 'Impurity-3', 'Impurity_generic', 0.70, FALSE, TRUE, '%/w/w'),
  (FALSE, 14, 'TFMBA', 'TFMBA', 0.95, TRUE, TRUE, '%/w/w'),
  (FALSE, 15, 'Late peak 1.7', 'unknown_Late_peak_1_7', 0.30, FALSE, TRUE, '%/w/w'),
  (FALSE, 16, 'TFMBA Acid', 'TFMBA_Acid', 0.95, FALSE, TRUE, '%'))"""

META = """
meta AS (
  SELECT workbook, sheet, pos, row, row_seq, k, o_totalprice,
    CASE WHEN k % 40 IN (3, 4, 5, 7) THEN NULL ELSE CAST(o_orderdate AS DATE) END AS sample_date,
    CASE WHEN sample_r IN (1, 2, 3, 4) THEN NULL WHEN sample_r = 5 THEN '20:05:00'
         WHEN sample_r = 6 THEN strftime(o_orderdate, '%H:%M:%S')
         ELSE lpad(CAST(k % 24 AS VARCHAR), 2, '0') || ':'
              || lpad(CAST(k * 7 % 60 AS VARCHAR), 2, '0') || ':00' END AS sample_time,
    CASE WHEN report_r IN (1, 2, 3, 4) THEN NULL WHEN report_r = 5 THEN '20:05:00'
         WHEN report_r = 6 THEN strftime(o_orderdate, '%H:%M:%S')
         ELSE lpad(CAST((k + 7) % 24 AS VARCHAR), 2, '0') || ':'
              || lpad(CAST(k * 7 % 60 AS VARCHAR), 2, '0') || ':00' END AS report_time,
    CASE WHEN pos % 2 = 1 THEN CASE WHEN k % 4 = 0 THEN 'R' || (k // 3) END
         WHEN k % 31 <> 7 THEN '#' || (k // 3) END AS batch_no,
    'HPLC-0' || (o_custkey % 5 + 1) || '/KF-12' AS instrument_id,
    o_orderpriority AS stage,
    CASE o_orderstatus WHEN 'F' THEN 'Solid' WHEN 'O' THEN 'Liquid' ELSE 'Slurry' END AS sample_form,
    CASE WHEN k % 20 IN (3, 4) THEN NULL WHEN k % 20 = 5 THEN 'Off-white McDonald Cake'
         ELSE 'White Powder' END AS appearance,
    CASE WHEN k % 23 IN (2, 3, 4, 6) THEN NULL WHEN k % 23 IN (5, 7) THEN FALSE
         ELSE TRUE END AS appearance_solution
  FROM d)"""

MEASURED = """
m0 AS (
  SELECT meta.*, band.*, (k + 11 * col) % 37 AS dirt,
         (CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) * col + k) % 1300 + 1 AS u
  FROM meta JOIN band ON even = (pos % 2 = 0)),
m1 AS (
  SELECT *, CASE WHEN is_min THEN 98.0::DOUBLE + CAST(u % 200 AS DOUBLE) / 100.0::DOUBLE
                 ELSE CAST(u AS DOUBLE) / 10000.0::DOUBLE END AS v FROM m0),
m2 AS (
  SELECT *, CAST(v AS VARCHAR) AS t,
    CASE WHEN dirt IN (2, 3, 4, 5, 6, 7, 8, 9, 11) THEN NULL WHEN dirt = 10 THEN 10.0::DOUBLE
         ELSE v END AS value,
    CASE WHEN limited AND is_min THEN 99.0::DOUBLE END AS spec_min,
    CASE WHEN limited AND NOT is_min THEN 0.1::DOUBLE END AS spec_max,
    CASE WHEN limited AND is_min THEN 99.0::DOUBLE END AS spec_internal_min,
    CASE WHEN limited AND NOT is_min THEN 0.08::DOUBLE END AS spec_internal_max
  FROM m1),
obs AS (
  SELECT workbook, sheet, row_seq, sample_date, sample_time, report_time, batch_no, instrument_id,
    stage, sample_form, appearance,
    CASE WHEN appearance_solution THEN 'OK' WHEN NOT appearance_solution THEN 'FAIL' END
      AS appearance_solution,
    label AS analyte, canonical AS analyte_canonical,
    CASE WHEN limited THEN 0.5::DOUBLE + 0.25::DOUBLE * (col - 12) END AS rt,
    CASE WHEN limited THEN (0.5::DOUBLE + 0.25::DOUBLE * (col - 12)) / 2 END AS rrt,
    value, unit, spec_min, spec_max, spec_internal_min, spec_internal_max,
    CASE WHEN value IS NULL OR NOT limited THEN NULL
         WHEN is_min THEN value >= 99.0::DOUBLE ELSE value <= 0.1::DOUBLE END AS pass,
    CASE dirt WHEN 0 THEN ' ' || t WHEN 1 THEN t || ' ' WHEN 2 THEN 'NULL' WHEN 3 THEN '?'
         WHEN 4 THEN '' WHEN 5 THEN '-' || t WHEN 6 THEN 'n.d.' WHEN 7 THEN NULL
         WHEN 8 THEN CAST(-(v + 1) AS VARCHAR) WHEN 9 THEN 'True' WHEN 10 THEN '1_0'
         WHEN 11 THEN '-' ELSE t END AS raw_value,
    confidence AS mapping_confidence, row, CAST(col AS INTEGER) AS column_index, dirt, t
  FROM m2)"""

EVENTS = """
e AS (
  SELECT event_id AS k, ts, user_id, event_type, props,
    'events_' || (event_id // 3000) || '.xlsx' AS workbook,
    CAST((event_id // 600) % 5 + 1 AS INTEGER) AS pos,
    'MISC ' || CAST((event_id // 600) % 5 + 1 AS INTEGER) AS sheet,
    CAST(4 + event_id % 600 AS INTEGER) AS row,
    event_id % 50 = 9 OR event_id % 600 = 0 AS blank
  FROM events),
es AS (
  SELECT workbook, sheet, pos, min(CASE WHEN NOT blank THEN row END) AS start_row,
         max(CASE WHEN NOT blank OR k % 100 = 9 THEN row END) AS max_row,
         count(CASE WHEN NOT blank THEN 1 END) AS n
  FROM e GROUP BY ALL),
ef AS (
  SELECT e.*, CAST(row - start_row + 1 AS BIGINT) AS row_seq,
    CAST(k + 1 AS VARCHAR) AS s_no,
    CASE k % 15 WHEN 1 THEN strftime(ts, '%d/%m/%Y') WHEN 2 THEN NULL
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS day,
    'QA-' || (1000 + user_id) AS test_id,
    CASE k % 8 WHEN 0 THEN 'Pass' WHEN 1 THEN 'Fail' WHEN 2 THEN 'Review' WHEN 3 THEN 'OK' END
      AS result,
    'user ' || (user_id % 7) AS reviewer,
    CASE WHEN k % 5 = 0 THEN 'late' END AS notes
  FROM e JOIN es USING (workbook, sheet, pos) WHERE NOT blank)"""

PARTS = """
ps AS (
  SELECT DISTINCT 'part_' || (p_partkey // 500) || '.xlsx' AS workbook,
         CAST((p_partkey // 100) % 5 + 1 AS INTEGER) AS pos FROM part),
pe AS (SELECT DISTINCT workbook FROM ps)"""

ISSUES = """
found AS (
  SELECT workbook, sheet, row_seq, 'sample_date' AS "column", 'Date of Sampling' AS label,
    CASE WHEN k % 40 IN (1, 2) THEN 'non_standard_date' WHEN k % 40 = 4 THEN 'malformed_date'
         WHEN k % 40 = 5 THEN 'null_sentinel' END AS rule,
    CASE k % 40 WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
         WHEN 2 THEN strftime(o_orderdate, '%b %d %Y') WHEN 4 THEN '31/31/2020'
         WHEN 5 THEN 'NULL' END AS raw_value,
    CASE WHEN k % 40 IN (1, 2) THEN strftime(o_orderdate, '%Y-%m-%d') END AS repaired_value
  FROM d
  UNION ALL
  SELECT workbook, sheet, row_seq, 'sample_time', 'Time of sampling',
    CASE WHEN sample_r IN (1, 2, 3) THEN 'malformed_time' END,
    CASE sample_r WHEN 1 THEN '27:00.0' WHEN 2 THEN '8.30' ELSE '??:??' END, NULL FROM d
  UNION ALL
  SELECT workbook, sheet, row_seq, 'report_time', 'Time of Reporting',
    CASE WHEN report_r IN (1, 2, 3) THEN 'malformed_time' END,
    CASE report_r WHEN 1 THEN '27:00.0' WHEN 2 THEN '8.30' ELSE '??:??' END, NULL FROM d
  UNION ALL
  SELECT workbook, sheet, row_seq, 'batch_no', 'Batch No.',
    CASE WHEN k % 31 <> 7 AND k % 37 = 2 THEN 'whitespace' END,
    ' #' || (k // 3) || ' ', '#' || (k // 3) FROM d
  UNION ALL
  SELECT workbook, sheet, row_seq, 'batch_no', 'Batch number',
    CASE WHEN pos % 2 = 1 AND k % 4 = 1 THEN 'null_sentinel' END, 'NULL', NULL FROM d
  UNION ALL
  SELECT workbook, sheet, row_seq, 'sample_form', 'Sample Characteristic',
    CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'whitespace' END, '  Slurry', 'Slurry' FROM d
  UNION ALL
  SELECT workbook, sheet, row_seq, 'appearance', 'Appearance',
    CASE WHEN k % 20 IN (0, 2, 5) THEN 'case_variant' WHEN k % 20 = 1 THEN 'whitespace'
         WHEN k % 20 = 4 THEN 'null_sentinel' END,
    CASE k % 20 WHEN 0 THEN 'white powder' WHEN 1 THEN ' White Powder ' WHEN 2 THEN 'WHITE POWDER'
         WHEN 4 THEN 'NULL' ELSE 'off-white McDonald cake' END,
    CASE WHEN k % 20 IN (0, 1, 2) THEN 'White Powder'
         WHEN k % 20 = 5 THEN 'Off-white McDonald Cake' END FROM d
  UNION ALL
  SELECT workbook, sheet, row_seq, 'appearance_solution',
    'Appearance of 30% solution in methanol (read next day)',
    CASE WHEN k % 23 = 1 THEN 'whitespace' WHEN k % 23 IN (2, 3) THEN 'null_sentinel'
         WHEN k % 23 = 6 THEN 'unrecognized_token' END,
    CASE k % 23 WHEN 1 THEN ' OK ' WHEN 2 THEN 'NULL' WHEN 3 THEN '?' ELSE 'maybe' END,
    CASE WHEN k % 23 = 1 THEN 'True' END FROM d),
dq AS (
  SELECT workbook, sheet, row_seq, "column", rule,
    CASE WHEN rule LIKE 'malformed%' THEN 'warning' ELSE 'info' END AS severity,
    raw_value, repaired_value, 'raw label was ''' || label || '''' AS note
  FROM found WHERE rule IS NOT NULL
  UNION ALL
  SELECT workbook, sheet, row_seq, analyte,
    CASE WHEN dirt IN (0, 1) THEN 'whitespace' WHEN dirt IN (2, 3, 11) THEN 'null_sentinel'
         WHEN dirt IN (5, 8) THEN 'negative_value' WHEN dirt = 6 THEN 'non_numeric'
         ELSE 'wrong_type' END,
    CASE WHEN dirt IN (5, 6, 8) THEN 'warning' ELSE 'info' END,
    raw_value, CASE WHEN dirt IN (0, 1) THEN t END, 'analyte=' || analyte_canonical
  FROM obs WHERE dirt IN (0, 1, 2, 3, 5, 6, 8, 9, 11)
  UNION ALL
  SELECT workbook, sheet, row_seq, 'Date', 'null_sentinel', 'info', 'NULL', NULL, ''
  FROM ef WHERE k % 15 = 2
  UNION ALL
  SELECT workbook, sheet, row_seq, 'What', 'whitespace', 'info',
         ' ' || event_type || ' ', event_type, ''
  FROM ef WHERE k % 9 = 4
  UNION ALL
  SELECT workbook, sheet, row_seq, 'Outcome', 'null_sentinel', 'info',
         CASE k % 8 WHEN 4 THEN 'NULL' ELSE '?' END, NULL, ''
  FROM ef WHERE k % 8 IN (4, 6))"""


def _aliases(name: str, names: dict[str, list[str]]) -> str:
    rows = ", ".join("('{}', '{}', {})".format(c.replace("'", "''"), a.replace("'", "''"), o)
                     for c, a, o in CanonicalNames.flatten(names))
    return f"{name}(canonical, alias, ord) AS (VALUES {rows})"


SYNONYMS = _aliases("synonyms", DEFAULT_NAMES.synonyms)
ANALYTES = _aliases("analytes", DEFAULT_NAMES.analytes)


def _collapsed(expr: str) -> str:
    return f"regexp_replace({expr}, '{BLANK}+', ' ', 'g')"


def _meta_match(source: str, result: str) -> str:
    """CTEs that match the labels of one CTE by joining them with the aliases."""
    return f"""
{result}_n AS (SELECT raw_label, {_collapsed("lower(" + _strip("raw_label") + ")")} AS norm
  FROM (SELECT DISTINCT raw_label FROM {source})),
{result}_c AS (
  SELECT raw_label, canonical, alias, ord, alias = norm AS exact,
    CASE WHEN alias = norm THEN 0.95::DOUBLE
         ELSE 0.4::DOUBLE + least(0.5::DOUBLE, (CAST(length(alias) AS DOUBLE)
              / greatest(length(norm), 1)) * 0.6::DOUBLE) END AS confidence,
    CAST(length(alias) AS DOUBLE) / greatest(length(norm), 1) AS coverage
  FROM {result}_n JOIN synonyms ON contains(norm, alias) OR contains(alias, norm)),
{result} AS (
  SELECT n.raw_label, canonical, coalesce(confidence, 0.0::DOUBLE) AS confidence,
    CASE WHEN canonical IS NULL THEN 'no synonym match'
         WHEN exact THEN 'exact synonym match: ''' || alias || ''''
         ELSE 'substring match against ''' || alias || ''' (coverage='
              || printf('%.2f', coverage) || ')' END AS rationale
  FROM {result}_n n LEFT JOIN (
    SELECT * FROM {result}_c
    QUALIFY row_number() OVER (PARTITION BY raw_label
                               ORDER BY exact DESC, confidence DESC, ord) = 1) b
    ON n.raw_label = b.raw_label)"""


def _analyte_match(source: str, result: str) -> str:
    def norm(expr: str) -> str:
        return _collapsed(f"translate({_collapsed('lower(' + _strip(expr) + ')')}, '-_', '  ')")

    return f"""
{result}_n AS (SELECT raw_label, {norm("raw_label")} AS norm
  FROM (SELECT DISTINCT raw_label FROM {source})),
{result}_a AS (SELECT *, {norm("alias")} AS key FROM analytes),
{result}_c AS (
  SELECT raw_label, canonical, alias, ord, key = norm AS exact,
    CASE WHEN key = norm THEN 0.95::DOUBLE WHEN length(key) >= 5 THEN 0.7::DOUBLE
         ELSE 0.55::DOUBLE END AS confidence
  FROM {result}_n JOIN {result}_a ON contains(norm, key) OR contains(key, norm)),
{result} AS (
  SELECT n.raw_label, canonical, coalesce(confidence, 0.0::DOUBLE) AS confidence,
    CASE WHEN canonical IS NULL THEN 'no analyte match'
         WHEN exact THEN 'exact analyte alias: ''' || alias || ''''
         ELSE 'substring match against analyte alias ''' || alias || '''' END AS rationale
  FROM {result}_n n LEFT JOIN (
    SELECT * FROM {result}_c
    QUALIFY row_number() OVER (PARTITION BY raw_label
                               ORDER BY exact DESC, confidence DESC, ord) = 1) b
    ON n.raw_label = b.raw_label)"""


SHEET_LABELS = """
labelled(column_index, raw_label, odd_only) AS (VALUES
  (1, 'Entry', FALSE), (2, 'Date of Sampling', FALSE), (3, 'Time of sampling', FALSE),
  (4, 'Time of Reporting', FALSE), (5, 'Batch No.', FALSE), (6, 'Instrument ID', FALSE),
  (7, 'Stage', FALSE), (8, 'Sample Characteristic', FALSE), (9, 'Batch number', TRUE),
  (10, 'Appearance', FALSE),
  (11, 'Appearance of 30% solution in methanol (read next day)', FALSE)),
flat_labelled(column_index, raw_label) AS (VALUES
  (1, 'Row'), (2, 'Date'), (3, 'What'), (4, 'Run'), (5, 'Outcome'), (6, 'Checked by'),
  (7, 'Remarks'), (8, 'Remarks')),
sheet_columns AS (
  SELECT workbook, sheet, pos, CAST(column_index AS INTEGER) AS column_index, 'meta' AS kind,
         raw_label
  FROM os JOIN labelled ON pos % 2 = 1 OR NOT odd_only
  UNION ALL
  SELECT workbook, sheet, pos, CAST(col AS INTEGER), 'analyte', label
  FROM os JOIN band ON even = (pos % 2 = 0)
  UNION ALL
  SELECT workbook, sheet, pos, CAST(column_index AS INTEGER), 'meta', raw_label
  FROM es CROSS JOIN flat_labelled)"""

MAPPINGS = f"""
{SYNONYMS}, {ANALYTES},
meta_labels AS (SELECT raw_label FROM sheet_columns WHERE kind = 'meta'),
analyte_labels AS (SELECT raw_label FROM sheet_columns WHERE kind = 'analyte'),
{_meta_match("meta_labels", "mm")},
{_analyte_match("analyte_labels", "am")},
mappings AS (
  SELECT workbook, sheet, pos, column_index, c.raw_label,
    CASE WHEN canonical IS NULL THEN 'ignored' ELSE 'meta' END AS role, canonical, confidence,
    rationale, 'mock_synonyms' AS source
  FROM sheet_columns c JOIN mm ON c.raw_label = mm.raw_label WHERE kind = 'meta'
  UNION ALL
  SELECT workbook, sheet, pos, column_index, c.raw_label, 'analyte',
    coalesce(canonical, 'unknown_' || trim(regexp_replace(c.raw_label, '[^A-Za-z0-9]+', '_', 'g'), '_')),
    CASE WHEN canonical IS NULL THEN 0.3::DOUBLE ELSE confidence END,
    CASE WHEN canonical IS NULL THEN 'no canonical analyte match — slug fallback' ELSE rationale END,
    'mock_synonyms'
  FROM sheet_columns c JOIN am ON c.raw_label = am.raw_label WHERE kind = 'analyte')"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


GRID = [ORDERS, EVENTS, PARTS]
FACTS = [ORDERS, META, MEASURED]
LOG = [ORDERS, META, MEASURED, EVENTS, ISSUES]
MAPPED = [ORDERS, EVENTS, SHEET_LABELS, MAPPINGS]

MAPPING_FIELDS = ("workbook, sheet, column_index, raw_label, role, canonical, confidence, "
                  "rationale, source")
OBSERVATION_FIELDS = (
    "workbook, sheet, row_seq, sample_date, sample_time, report_time, batch_no, instrument_id, "
    "stage, sample_form, appearance, appearance_solution, analyte, analyte_canonical, rt, rrt, "
    "value, unit, spec_min, spec_max, spec_internal_min, spec_internal_max, pass, raw_value, "
    "mapping_confidence")
FACT_FIELDS = OBSERVATION_FIELDS.replace("sample_time, report_time, ", "").replace("raw_value, ", "")

PASS_RATE = """SELECT workbook, sheet, batch_no, count(*) AS observations,
  CAST(sum(CASE WHEN pass THEN 1 ELSE 0 END) AS BIGINT) AS passing,
  CAST(sum(CASE WHEN NOT pass THEN 1 ELSE 0 END) AS BIGINT) AS failing,
  round(avg(CASE WHEN pass THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 3) AS pass_rate
  FROM obs WHERE pass IS NOT NULL GROUP BY workbook, sheet, batch_no"""


def _exact_avg(expr: str) -> str:
    """Mean by decimals; by way of text, as doubles are turned into decimals and back exactly."""
    total = f"CAST(CAST(sum(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18))) AS VARCHAR) AS DOUBLE)"
    return f"{total} / count({expr})"


TREND = f"""SELECT analyte_canonical, sample_date, count(*) AS n_observations,
  {_exact_avg("value")} AS avg_value, max(value) AS max_value, min(spec_max) AS spec_max
  FROM obs WHERE sample_date IS NOT NULL GROUP BY analyte_canonical, sample_date"""
VIOLATIONS = f"""SELECT analyte_canonical, workbook, sheet, count(*) AS violation_count,
  {_exact_avg("value")} AS avg_violating_value, {_exact_avg("(value - spec_max)")} AS avg_overshoot
  FROM obs WHERE NOT pass GROUP BY analyte_canonical, workbook, sheet"""


def _sheet_table(select_orders: str, select_flat: str, select_parts: str, select_empty: str) -> str:
    return (_with(*GRID) + f"""
  SELECT workbook, sheet, {select_orders} FROM os
  UNION ALL SELECT workbook, sheet, {select_flat} FROM es
  UNION ALL SELECT workbook, 'S' || pos, {select_parts} FROM ps
  UNION ALL SELECT workbook, 'Empty', {select_empty} FROM pe""")


ORACLE: dict[str, str] = {}

# --- coercion ---------------------------------------------------------------------------

ORACLE["coerce_str"] = f"""
WITH t AS (SELECT doc_id, CASE doc_id % 13 WHEN 0 THEN 'NULL' WHEN 1 THEN ' ' || chr(9) || text
    WHEN 2 THEN '?' WHEN 3 THEN '' WHEN 4 THEN text || chr(10) || ' ' WHEN 5 THEN ' n/a '
    WHEN 6 THEN NULL WHEN 7 THEN '   ' WHEN 8 THEN '--' ELSE text END AS raw FROM documents),
s AS (SELECT *, {_strip("raw")} AS s FROM t)
SELECT doc_id, CASE WHEN s <> '' AND lower(s) NOT IN {SENTINEL} THEN s END AS value,
  CASE WHEN raw IS NULL OR s = '' THEN NULL WHEN lower(s) IN {SENTINEL} THEN 'null_sentinel'
       WHEN s <> raw THEN 'whitespace' END AS rule FROM s"""

ORACLE["coerce_appearance"] = """
WITH t AS (
  SELECT p_partkey, p_partkey % 11 AS r, p_brand, p_type, p_name,
    array_to_string(list_transform(string_split(p_name, ' '),
      lambda w: upper(w[1]) || lower(w[2:])), ' ') AS titled,
    upper(p_type[1]) || lower(p_type[2:]) AS type_titled FROM part)
SELECT p_partkey,
  CASE WHEN r IN (3, 4) THEN NULL WHEN r = 5 THEN 'Off-white McDonald ' || type_titled
       WHEN r = 6 THEN titled || ' ' || p_brand ELSE titled END AS value,
  CASE r WHEN 1 THEN 'whitespace' WHEN 2 THEN NULL WHEN 3 THEN 'null_sentinel' WHEN 4 THEN NULL
       ELSE 'case_variant' END AS rule
FROM t"""

ORACLE["coerce_pass_fail"] = """
SELECT event_id,
  CASE WHEN event_id % 17 IN (0, 1, 2, 7, 8) THEN TRUE
       WHEN event_id % 17 IN (3, 4, 9, 11) THEN FALSE END AS value,
  CASE WHEN event_id % 17 IN (1, 9) THEN 'whitespace'
       WHEN event_id % 17 IN (5, 10) THEN 'null_sentinel'
       WHEN event_id % 17 > 11 THEN 'unrecognized_token' END AS rule
FROM events"""

ORACLE["coerce_date"] = """
WITH t AS (SELECT o_orderkey, o_orderkey % 22 AS r, CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT o_orderkey,
  CASE WHEN r < 4 OR r BETWEEN 6 AND 11 OR r = 15 THEN day WHEN r > 18 THEN make_date(year(day), month(day), 5)
       WHEN r IN (4, 5) THEN make_date(year(day), month(day), 28) END AS value,
  CASE WHEN r IN (0, 1, 13, 20, 21) THEN NULL WHEN r = 12 THEN 'null_sentinel'
       WHEN r IN (14, 16, 17, 18) THEN 'malformed_date' ELSE 'non_standard_date' END AS rule
FROM t"""

ORACLE["coerce_time"] = """
SELECT event_id,
  CASE WHEN event_id % 17 IN (0, 3) THEN strftime(ts, '%H:%M:%S')
       WHEN event_id % 17 IN (1, 2) OR event_id % 17 > 12 THEN strftime(ts, '%H:%M:00')
       WHEN event_id % 17 = 11 THEN '07:05:09' END AS value,
  CASE WHEN event_id % 17 IN (4, 5, 6, 8, 9, 10, 12) THEN 'malformed_time' END AS rule
FROM events"""

ORACLE["coerce_float"] = """
WITH t AS (SELECT *, (l_orderkey * 8 + l_linenumber) % 23 AS r FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN r IN (2, 3, 4, 5, 7, 12, 13, 14, 15, 16) THEN NULL WHEN r = 6 THEN 1000.5::DOUBLE
       WHEN r = 8 THEN 1000.0::DOUBLE WHEN r = 9 THEN 0.5::DOUBLE WHEN r = 10 THEN 5.0::DOUBLE
       ELSE l_extendedprice END AS value,
  CASE WHEN r IN (0, 1) THEN 'whitespace' WHEN r IN (2, 14) THEN 'null_sentinel'
       WHEN r = 12 AND upper(l_returnflag) IN ('?', '-') THEN 'null_sentinel'
       WHEN r IN (4, 16) THEN 'negative_value'
       WHEN r IN (5, 7, 12, 13, 15) THEN 'non_numeric' END AS rule
FROM t"""

ORACLE["evaluate_pass"] = """
WITH t AS (SELECT *, CASE WHEN l_linenumber <> 7 THEN l_quantity END AS value,
    CASE WHEN l_returnflag <> 'A' THEN l_discount * 200 END AS low,
    CASE WHEN l_linestatus = 'F' AND l_returnflag <> 'R' THEN 20.0::DOUBLE + l_tax * 200 END AS high
  FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN value IS NULL OR (low IS NULL AND high IS NULL) THEN NULL
       ELSE coalesce(value >= low, TRUE) AND coalesce(value <= high, TRUE) END AS pass
FROM t"""

ORACLE["spec_bounds"] = """
WITH t AS (SELECT p_partkey, p_partkey % 7 AS r, p_type,
    CASE WHEN p_size > 5 THEN p_retailprice END AS spec, p_retailprice / 2 AS internal FROM part),
f AS (SELECT *, r IN (0, 1, 4) OR (r = 6 AND lower(p_type) LIKE 'min%') AS is_min FROM t)
SELECT p_partkey, CASE WHEN is_min THEN spec END AS spec_min,
  CASE WHEN NOT is_min THEN spec END AS spec_max,
  CASE WHEN is_min THEN internal END AS spec_internal_min,
  CASE WHEN NOT is_min THEN internal END AS spec_internal_max FROM f"""

ORACLE["compose_unit"] = """
SELECT p_partkey, nullif(
  CASE WHEN p_partkey % 5 < 2 THEN '' ELSE p_type END
  || CASE WHEN p_partkey % 3 < 2 OR p_brand = '' THEN '' ELSE '/' || p_brand END, '') AS unit
FROM part"""

ORACLE["serialize_values"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
  CASE WHEN o_orderkey % 3 <> 1 THEN o_orderstatus ELSE '' END AS status,
  CASE WHEN o_orderkey % 3 <> 1 THEN '' WHEN o_totalprice > 100000 THEN 'true' ELSE 'false' END
    AS flag,
  strftime(o_orderdate, '%Y-%m-%d') AS day,
  CAST(o_totalprice * 1000 AS VARCHAR) AS large,
  CASE WHEN o_orderkey % 3 = 1 THEN CAST(CAST(o_orderkey AS DOUBLE) / 65536.0::DOUBLE AS VARCHAR)
       ELSE '' END AS small
FROM orders"""

# --- profiling ----------------------------------------------------------------------------

_I = "CAST(NULL AS INTEGER)"
ORACLE["detect_anchors"] = _sheet_table(
    "5 AS rt_row, 6 AS rrt_row, 7 AS unit_row, 9 AS spec_bound_row, 11 AS internal_spec_row",
    ", ".join([_I] * 5),
    "CASE WHEN pos IN (2, 5) THEN 5 END, CASE WHEN pos = 5 THEN 6 END, "
    "CASE WHEN pos = 5 THEN 7 END, CASE WHEN pos IN (2, 5) THEN 9 END, "
    "CASE WHEN pos = 5 THEN 11 END",
    ", ".join([_I] * 5))
ORACLE["detect_field_label_row"] = _sheet_table(
    "4 AS field_label_row", _I, "CASE WHEN pos = 5 THEN 4 END", _I)
ORACLE["detect_process_label_row"] = _sheet_table(
    "3 AS process_label_row", _I, "CASE WHEN pos = 5 THEN 3 END", _I)
ORACLE["detect_analyte_band"] = _sheet_table(
    "12 AS first_col, CASE WHEN pos % 2 = 0 THEN 20 ELSE 16 END AS last_col", f"{_I}, {_I}",
    "CASE WHEN pos = 2 THEN 12 END, CASE WHEN pos = 2 THEN 12 END", f"{_I}, {_I}")
ORACLE["looks_like_flat"] = _sheet_table("FALSE AS looks_flat", "TRUE", "pos = 4", "FALSE")
ORACLE["detect_data_start"] = _with(ORDERS) + """
SELECT workbook, sheet, min(row) AS data_start_row FROM d GROUP BY workbook, sheet"""
ORACLE["flat_profiles"] = _with(EVENTS) + """
SELECT workbook, sheet, 3 AS field_label_row, coalesce(start_row, max_row + 1) AS data_start_row,
  n AS n_data_rows FROM es"""
ORACLE["sheet_profiles"] = _with(*GRID) + """,
starts AS (SELECT workbook, sheet, min(row) AS first_row, count(*) AS n FROM d GROUP BY ALL)
SELECT workbook, sheet, pos AS sheet_pos, 'quality_standard' AS layout, 3 AS process_label_row,
  4 AS field_label_row, 5 AS rt_row, 6 AS rrt_row, 7 AS unit_row, 9 AS spec_bound_row,
  10 AS spec_value_row, 11 AS internal_spec_row, coalesce(first_row, 12) AS data_start_row,
  coalesce(n, 0) AS n_data_rows, '' AS notes
FROM os LEFT JOIN starts USING (workbook, sheet)
UNION ALL
SELECT workbook, sheet, pos, 'misc_flat', NULL, 3, NULL, NULL, NULL, NULL, NULL, NULL,
  coalesce(start_row, max_row + 1), n, '' FROM es
UNION ALL
SELECT workbook, 'S' || pos, pos, 'unknown', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  0, CASE pos WHEN 1 THEN 'sheet too small to profile'
              WHEN 2 THEN 'could not locate quality_standard header band'
              WHEN 3 THEN 'no anchors and no flat header detected'
              WHEN 4 THEN 'misc_flat detector tripped but header row not isolated'
              ELSE 'could not locate measured columns' END FROM ps
UNION ALL
SELECT workbook, 'Empty', 6, 'unknown', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 0,
  'sheet too small to profile' FROM pe"""
ORACLE["sheet_columns"] = _with(ORDERS, EVENTS, SHEET_LABELS) + """
SELECT workbook, sheet, column_index, kind, raw_label FROM sheet_columns"""
_ANALYTES = """
SELECT workbook, sheet, CAST(col AS INTEGER) AS column_index, label AS raw_label,
  CASE WHEN limited THEN 0.5::DOUBLE + 0.25::DOUBLE * (col - 12) END AS rt,
  CASE WHEN limited THEN (0.5::DOUBLE + 0.25::DOUBLE * (col - 12)) / 2 END AS rrt,
  CASE WHEN limited THEN '%' END AS unit, CASE WHEN unit = '%/w/w' THEN 'w/w' END AS sub_unit,
  CASE WHEN limited THEN CASE WHEN is_min THEN 'Min' ELSE 'Max' END END AS spec_bound,
  CASE WHEN limited THEN CASE WHEN is_min THEN 99.0::DOUBLE ELSE 0.1::DOUBLE END END AS spec_value,
  CASE WHEN limited THEN CASE WHEN is_min THEN 99.0::DOUBLE ELSE 0.08::DOUBLE END END
    AS internal_spec_value
FROM os JOIN band ON even = (pos % 2 = 0)"""
ORACLE["analyte_columns"] = _with(ORDERS) + _ANALYTES
ORACLE["mapping_requests"] = _with(ORDERS, EVENTS, SHEET_LABELS) + f""",
measured AS ({_ANALYTES}),
items AS (
  SELECT c.workbook, c.sheet, c.kind, c.column_index,
    CASE WHEN c.kind = 'analyte' THEN to_json({{'raw': c.raw_label, 'kind': c.kind, 'col': c.column_index,
           'rt': m.rt, 'rrt': m.rrt, 'spec_bound': m.spec_bound, 'spec': m.spec_value}})
         WHEN c.raw_label IS NULL THEN to_json({{'kind': c.kind, 'col': c.column_index}})
         ELSE to_json({{'raw': c.raw_label, 'kind': c.kind, 'col': c.column_index}}) END AS item
  FROM sheet_columns c LEFT JOIN measured m USING (workbook, sheet, column_index))
SELECT workbook, sheet, CAST(count(*) AS INTEGER) AS n_columns,
  'Assign a canonical name to every column of this laboratory sheet.' || chr(10) || 'Sheet: ' || sheet || chr(10)
  || 'Layout: ' || CASE WHEN workbook LIKE 'events%' THEN 'misc_flat' ELSE 'quality_standard' END || chr(10)
  || 'Names for columns of kind meta: {", ".join(DEFAULT_NAMES.synonyms)}' || chr(10)
  || 'Names for columns of kind analyte: {", ".join(DEFAULT_NAMES.analytes)}' || chr(10)
  || 'Use canonical null and role \'\'ignored\'\' where no name fits.' || chr(10)
  || 'Answer with a JSON list of objects {{raw, col, role, canonical, confidence, rationale}}; '
  || 'confidence lies between 0 and 1.' || chr(10) || 'Columns: ['
  || string_agg(item, ', ' ORDER BY kind = 'analyte', column_index) || ']' AS request
FROM items GROUP BY workbook, sheet"""
ORACLE["bronze_raw_workbooks"] = _with(*GRID) + """,
sheets AS (SELECT workbook, sheet, pos FROM os UNION ALL SELECT workbook, sheet, pos FROM es
  UNION ALL SELECT workbook, 'S' || pos, pos FROM ps UNION ALL SELECT workbook, 'Empty', 6 FROM pe)
SELECT workbook, CAST(count(*) AS INTEGER) AS sheet_count,
  string_agg(sheet, '|' ORDER BY pos) AS sheet_names FROM sheets GROUP BY workbook"""
ORACLE["grid_preview_top"] = _with(EVENTS) + """,
pick AS (SELECT workbook, sheet FROM es ORDER BY workbook, pos LIMIT 1),
grid AS (
  SELECT row, CASE WHEN NOT blank THEN CAST(k + 1 AS VARCHAR) END AS c1,
    CASE WHEN blank THEN CASE WHEN k % 100 = 9 THEN '' END
         WHEN k % 15 = 1 THEN strftime(ts, '%d/%m/%Y') WHEN k % 15 = 2 THEN 'NULL'
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS c2,
    CASE WHEN blank THEN NULL WHEN k % 9 = 4 THEN ' ' || event_type || ' ' ELSE event_type END AS c3,
    CASE WHEN NOT blank THEN 'QA-' || (1000 + user_id) END AS c4,
    CASE WHEN NOT blank THEN CASE k % 8 WHEN 0 THEN 'Pass' WHEN 1 THEN 'Fail' WHEN 2 THEN 'Review'
      WHEN 3 THEN 'OK' WHEN 4 THEN 'NULL' WHEN 5 THEN '' WHEN 6 THEN '?' END END AS c5,
    CASE WHEN NOT blank THEN 'user ' || (user_id % 7) END AS c6,
    CASE WHEN NOT blank THEN CASE WHEN k % 11 = 3 THEN '' ELSE props END END AS c7,
    CASE WHEN NOT blank AND k % 5 = 0 THEN 'late' END AS c8
  FROM e JOIN pick USING (workbook, sheet)
  UNION ALL SELECT 1, 'Event log', NULL, NULL, NULL, NULL, NULL, NULL, NULL
  UNION ALL SELECT 3, 'Row', 'Date', 'What', 'Run', 'Outcome', 'Checked by', 'Remarks', 'Remarks')
SELECT CAST(n AS INTEGER) AS row, c1, c2, c3, c4, c5, c6, c7, c8
FROM range(1, 19) r(n) LEFT JOIN grid ON n = row"""

# --- label mapping --------------------------------------------------------------------------

ORACLE["map_meta_labels"] = f"""
WITH {SYNONYMS},
l AS (SELECT CASE p_partkey % 9 WHEN 0 THEN 'Batch ' || p_brand WHEN 1 THEN 'Date of  Sampling'
    WHEN 2 THEN 'Stage ' || p_type || ' ' || p_name WHEN 3 THEN 'SAMPLE TIME'
    WHEN 4 THEN 'Appearance - ' || p_name WHEN 5 THEN ' Instrument' || chr(9) || 'ID '
    WHEN 6 THEN 'Form ' || p_size WHEN 7 THEN 'st' ELSE p_name END AS raw_label FROM part),
{_meta_match("l", "matched")}
SELECT raw_label, canonical, confidence, rationale FROM matched"""
ORACLE["map_analyte_labels"] = f"""
WITH {ANALYTES},
l AS (SELECT CASE p_partkey % 9 WHEN 0 THEN 'Impurity-' || p_size WHEN 1 THEN 'TFMBA ' || p_type
    WHEN 2 THEN 'imp_1' WHEN 3 THEN '5-Chloro_TFMBA' WHEN 4 THEN '2-chlorobenzamide ' || p_name
    WHEN 5 THEN p_brand WHEN 6 THEN 'im' WHEN 7 THEN 'TFMBA -  acid' ELSE p_name END AS raw_label
  FROM part),
{_analyte_match("l", "matched")}
SELECT raw_label, canonical, confidence, rationale FROM matched"""
ORACLE["map_own_aliases"] = f"""
WITH synonyms AS (
  SELECT n_name AS canonical, alias, n_nationkey * 9 + i AS ord
  FROM (SELECT n_name, n_nationkey, generate_subscripts(a, 1) - 1 AS i, unnest(a) AS alias FROM (
    SELECT *, ['plant ' || l, l || ' plant', 'site ' || l, l || ' site', 'lab ' || l, l || ' lab', l || ' works',
               l || ' unit', l] AS a FROM (SELECT *, lower(n_name) AS l FROM nation)))),
labels AS (
  SELECT DISTINCT CASE s_suppkey % 8 WHEN 0 THEN 'Plant  ' || n_name WHEN 1 THEN n_name || chr(9) || 'site'
    WHEN 2 THEN 'our ' || lower(n_name) || ' lab no. ' || s_suppkey WHEN 3 THEN substr(n_name, 1, 2)
    WHEN 4 THEN 'lant ' || substr(n_name, 1, 3) WHEN 5 THEN 'elsewhere'
    WHEN 6 THEN n_name || ' works and unit' ELSE s_name END AS raw_label
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
{_meta_match("labels", "m")}
SELECT raw_label, canonical, confidence, rationale FROM m"""
ORACLE["slug_fallback"] = """
SELECT p_partkey, 'unknown_' || trim(regexp_replace(p_name || '_' || p_brand,
  '[^A-Za-z0-9]+', '_', 'g'), '_') AS canonical FROM part"""
ORACLE["column_mapping_log"] = _with(*MAPPED) + f" SELECT {MAPPING_FIELDS} FROM mappings"
ORACLE["mapping_confidence"] = _with(*MAPPED) + """
SELECT sheet, raw_label, canonical, role, confidence, rationale, source
FROM mappings WHERE role <> 'ignored'"""
ORACLE["lowest_confidence_topk"] = _with(*MAPPED) + """
SELECT sheet, raw_label, role, canonical, confidence, rationale, source FROM mappings
ORDER BY confidence, workbook, sheet, column_index LIMIT 30"""
ORACLE["mapping_review"] = _with(*MAPPED) + """
SELECT sheet, raw_label, canonical, confidence, workbook, column_index, role
FROM mappings WHERE confidence < 0.5 AND role <> 'ignored'"""
ORACLE["mapping_review_digest"] = _with(*MAPPED) + """
SELECT sheet, raw_label, canonical, confidence, count(*) OVER () AS flagged
FROM mappings WHERE confidence < 0.5 AND role <> 'ignored'
ORDER BY workbook, sheet, column_index LIMIT 5"""
ORACLE["parse_mapping_responses"] = _with(*MAPPED) + f"""
SELECT {MAPPING_FIELDS} FROM mappings WHERE pos % 6 IN (3, 4)
UNION ALL
SELECT workbook, sheet, column_index, raw_label, role, canonical, 0.75::DOUBLE, '', 'llm'
FROM mappings WHERE pos % 6 IN (0, 1)
UNION ALL
SELECT workbook, sheet, column_index, raw_label,
  CASE WHEN column_index % 5 = 4 THEN 'ignored' ELSE role END, canonical,
  CASE WHEN column_index % 5 = 2 THEN 0.5::DOUBLE ELSE 0.75::DOUBLE END, '', 'llm'
FROM mappings WHERE pos % 6 = 5 AND column_index % 5 IN (2, 4)"""

# --- rows and facts ---------------------------------------------------------------------------

ORACLE["observations_by_replies"] = _with(*FACTS) + """
SELECT obs.workbook, obs.sheet, obs.row, column_index,
  CASE WHEN d.k % 31 <> 7 THEN '#' || (d.k // 3) END AS batch_no, CAST(NULL AS VARCHAR) AS stage, analyte,
  'M' || column_index AS analyte_canonical, value, pass, raw_value, column_index / 32.0::DOUBLE AS mapping_confidence
FROM obs JOIN d ON d.workbook = obs.workbook AND d.sheet = obs.sheet AND d.row = obs.row
WHERE column_index % 2 = 0"""
ORACLE["data_rows"] = _with(ORDERS) + " SELECT workbook, sheet, row, row_seq FROM d"
ORACLE["row_meta"] = _with(ORDERS, META) + """
SELECT workbook, sheet, row, row_seq, sample_date, sample_time, report_time, batch_no,
  instrument_id, stage, sample_form, appearance, appearance_solution FROM meta"""
ORACLE["observations_long"] = _with(*FACTS) + (
    f" SELECT {OBSERVATION_FIELDS}, row, column_index FROM obs")
ORACLE["dq_issues"] = _with(*LOG) + """
SELECT workbook, sheet, row_seq, "column", rule, severity, raw_value, repaired_value, note FROM dq"""
ORACLE["export_text"] = _with(*LOG) + """
SELECT workbook, sheet, CAST(row_seq AS VARCHAR) AS row_seq, analyte AS name, coalesce(raw_value, '') AS raw_value,
  coalesce(CAST(value AS VARCHAR), '') AS number, coalesce(CAST(pass AS VARCHAR), '') AS passed FROM obs
UNION ALL
SELECT workbook, sheet, coalesce(CAST(row_seq AS VARCHAR), ''), "column", coalesce(raw_value, ''), '', '' FROM dq"""
ORACLE["misc_rows"] = _with(EVENTS) + """
SELECT workbook, sheet, row_seq, 'Checked by=' || reviewer || '; Date=' || coalesce(day, '') || '; Outcome=' || coalesce(result, '')
  || '; Remarks=' || coalesce(notes, '') || '; Row=' || s_no || '; Run=' || test_id || '; What=' || event_type AS fields
FROM ef"""
ORACLE["misc_wide"] = _with(EVENTS) + """
SELECT workbook, sheet, row_seq, day AS "Date", event_type AS "What", notes AS "Remarks",
  result AS "Outcome", reviewer AS "Checked by", s_no AS "Row", test_id AS "Run" FROM ef"""

# --- marts and reports --------------------------------------------------------------------------

ORACLE["misc_union_fields"] = _with(EVENTS) + """
SELECT workbook, sheet, row_seq, s_no, test_id, result, CAST(NULL AS VARCHAR) AS absent, 7 AS n_labels FROM ef"""
ORACLE["misc_label_table"] = _with(EVENTS) + """
SELECT unnest(['Row', 'Date', 'What', 'Run', 'Outcome', 'Checked by', 'Remarks']) AS label,
  count(*) AS n_rows FROM ef HAVING count(*) > 0"""
ORACLE["quarantine_review"] = _with(*LOG, SHEET_LABELS, MAPPINGS) + """
SELECT 'mapping_low_confidence' AS reason, workbook, sheet, CAST(NULL AS BIGINT) AS row_seq,
  raw_label AS "column", confidence AS metric, rationale AS note
FROM mappings WHERE confidence < 0.5 AND role <> 'ignored'
UNION ALL
SELECT 'dq_warning', workbook, sheet, row_seq, "column", NULL, rule || ': ' || note
FROM dq WHERE severity = 'warning'"""
ORACLE["dim_batch"] = _with(*FACTS) + """,
firsts AS (SELECT * FROM obs WHERE batch_no IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY batch_no, workbook, sheet ORDER BY row, column_index) = 1)
SELECT batch_no, workbook, sheet, f.stage, f.instrument_id, first_seen, last_seen
FROM firsts f JOIN (
  SELECT batch_no, workbook, sheet, min(sample_date) AS first_seen, max(sample_date) AS last_seen
  FROM obs WHERE batch_no IS NOT NULL GROUP BY ALL) s USING (batch_no, workbook, sheet)"""
ORACLE["dim_analyte"] = _with(*FACTS) + f"""
SELECT analyte_canonical, array_to_string(list_sort(list(DISTINCT analyte)), '|')
    AS raw_label_variants,
  coalesce(array_to_string(list_sort(list(DISTINCT unit) FILTER (unit IS NOT NULL)), '|'), '')
    AS units_seen,
  {_exact_avg("rt")} AS avg_rt, {_exact_avg("rrt")} AS avg_rrt,
  {_exact_avg("spec_max")} AS avg_spec_max, {_exact_avg("spec_min")} AS avg_spec_min
FROM obs GROUP BY analyte_canonical"""
ORACLE["fact_observation"] = _with(*FACTS) + f" SELECT {FACT_FIELDS} FROM obs"
ORACLE["mv_batch_pass_rate"] = _with(*FACTS) + " " + PASS_RATE
ORACLE["cells_to_pass_rate"] = ORACLE["mv_batch_pass_rate"]
ORACLE["mv_impurity_trend"] = _with(*FACTS) + " " + TREND
ORACLE["mv_spec_violations"] = _with(*FACTS) + " " + VIOLATIONS
ORACLE["compliance_summary"] = _with(*FACTS) + """
SELECT count(*) AS total_obs, CAST(sum(CASE WHEN pass THEN 1 ELSE 0 END) AS BIGINT) AS passing,
  CAST(sum(CASE WHEN NOT pass THEN 1 ELSE 0 END) AS BIGINT) AS failing,
  round(avg(CASE WHEN pass THEN 100.0::DOUBLE WHEN NOT pass THEN 0.0::DOUBLE END), 2)
    AS pass_rate_pct FROM obs"""
ORACLE["compliance_three_state"] = _with(*FACTS) + """
SELECT count(*) FILTER (pass) AS pass_count,
  round(count(*) FILTER (pass) * 100.0::DOUBLE / greatest(count(*), 1), 1) AS pass_pct,
  count(*) FILTER (NOT pass) AS fail_count,
  round(count(*) FILTER (NOT pass) * 100.0::DOUBLE / greatest(count(*), 1), 1) AS fail_pct,
  count(*) FILTER (pass IS NULL) AS na_count,
  round(count(*) FILTER (pass IS NULL) * 100.0::DOUBLE / greatest(count(*), 1), 1) AS na_pct
FROM obs"""
ORACLE["dq_breakdown"] = _with(*LOG) + """
SELECT rule, severity, count(*) AS issue_count FROM dq GROUP BY rule, severity"""
ORACLE["rule_counts"] = _with(*LOG) + " SELECT rule, count(*) AS issue_count FROM dq GROUP BY rule"
ORACLE["dq_warning_sample"] = _with(*LOG) + """
SELECT sheet, row_seq, "column", rule, raw_value, repaired_value, note FROM dq
WHERE severity = 'warning'
ORDER BY workbook, sheet, row_seq, "column", rule, raw_value, note LIMIT 20"""
ORACLE["violations_topk"] = _with(*FACTS) + """
SELECT batch_no, sheet, analyte_canonical, value, spec_max, pass FROM obs WHERE NOT pass
ORDER BY workbook, sheet, batch_no NULLS FIRST, row_seq, analyte_canonical, analyte, value LIMIT 20"""
ORACLE["dashboard_pass_rate"] = _with(*FACTS) + f"""
SELECT batch_no, sheet, workbook, observations, passing, failing, pass_rate FROM ({PASS_RATE})"""
ORACLE["dashboard_trend"] = _with(*FACTS) + f"""
SELECT analyte_canonical, sample_date, avg_value, max_value, spec_max FROM ({TREND})"""
ORACLE["dashboard_violations"] = _with(*FACTS) + f"""
SELECT analyte_canonical, workbook, sheet, violation_count, avg_overshoot FROM ({VIOLATIONS})"""
ORACLE["per_workbook_summary"] = _with(*LOG, PARTS, SHEET_LABELS, MAPPINGS) + """,
books AS (SELECT DISTINCT workbook FROM os UNION SELECT DISTINCT workbook FROM es
  UNION SELECT workbook FROM pe)
SELECT workbook, coalesce(o.n, 0) AS observations, coalesce(q.n, 0) AS dq_issues,
  coalesce(m.n, 0) AS mappings
FROM books LEFT JOIN (SELECT workbook, count(*) AS n FROM obs GROUP BY ALL) o USING (workbook)
LEFT JOIN (SELECT workbook, count(*) AS n FROM dq GROUP BY ALL) q USING (workbook)
LEFT JOIN (SELECT workbook, count(*) AS n FROM mappings GROUP BY ALL) m USING (workbook)"""
ORACLE["export_manifest"] = _with(*LOG, SHEET_LABELS, MAPPINGS) + """
SELECT workbook, replace(workbook, '.xlsx', '_CLEAN.xlsx') AS export_name, o.n AS observations,
  coalesce(q.n, 0) AS dq_issues, coalesce(m.n, 0) AS mappings
FROM (SELECT workbook, count(*) AS n FROM obs GROUP BY ALL) o
LEFT JOIN (SELECT workbook, count(*) AS n FROM dq GROUP BY ALL) q USING (workbook)
LEFT JOIN (SELECT workbook, count(*) AS n FROM mappings GROUP BY ALL) m USING (workbook)"""


def _counts(**tables: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name.split('__')[0]}' AS layer, '{name.split('__')[1]}' AS name, "
                              f"(SELECT count(*) FROM ({sql})) AS n" for name, sql in tables.items())


ORACLE["medallion_tables"] = _with(*LOG, PARTS, SHEET_LABELS, MAPPINGS) + _counts(
    silver__sheet_profiles="SELECT workbook, pos FROM os UNION ALL SELECT workbook, pos FROM es "
                           "UNION ALL SELECT workbook, pos FROM ps UNION ALL SELECT workbook, 0 FROM pe",
    silver__column_mapping_log="FROM mappings", silver__unanswered_sheets="SELECT 1 WHERE FALSE",
    silver__observations_long="FROM obs", silver__dq_issues="FROM dq", silver__misc_rows="FROM ef",
    silver__quarantine_review="SELECT 1 FROM mappings WHERE confidence < 0.5 AND role <> 'ignored' "
                              "UNION ALL SELECT 1 FROM dq WHERE severity = 'warning'",
    gold__fact_observation="FROM obs",
    gold__dim_batch="SELECT DISTINCT batch_no, workbook, sheet FROM obs WHERE batch_no IS NOT NULL",
    gold__dim_analyte="SELECT DISTINCT analyte_canonical FROM obs", gold__mv_batch_pass_rate=PASS_RATE,
    gold__mv_impurity_trend=TREND, gold__mv_spec_violations=VIOLATIONS)
