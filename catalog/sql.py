"""The same results in plain SQL, written from the rules and not from the Spark code.

Every text here runs in DuckDB over views named like the parquet tables.
"""

from __future__ import annotations

M = "DECIMAL(38,2)"


def money(x: str) -> str:
    return f"CAST(CAST({x} AS {M}) AS VARCHAR)"


LEDGER = f"""
postings AS (
  SELECT l_orderkey AS k, 'J' || l_orderkey AS journal_id, 'P' || l_partkey AS account_code,
         CAST(l_linenumber AS BIGINT) AS line_no, CAST(l_shipdate AS DATE) AS posting_date,
         l_returnflag AS description, CAST(l_extendedprice AS DECIMAL(28,2)) AS debit,
         CAST(0 AS DECIMAL(28,2)) AS credit
  FROM lineitem),
per_order AS (
  SELECT k, 'J' || k AS journal_id, CAST(SUM(debit) AS DECIMAL(28,2)) AS total,
         MIN(posting_date) AS posting_date
  FROM postings GROUP BY k),
clean AS (
  SELECT * FROM postings
  UNION ALL
  SELECT k, journal_id, '4000', 1000, posting_date, 'contra', CAST(0 AS DECIMAL(28,2)), total
  FROM per_order),
lines AS (
  SELECT * FROM clean
  UNION ALL
  SELECT k, journal_id, 'P1', 1001, posting_date, 'one-sided', CAST(250 AS DECIMAL(28,2)), 0
  FROM per_order WHERE k % 997 = 0
  UNION ALL
  SELECT * FROM postings WHERE k % 499 = 1
  UNION ALL
  SELECT k, 'X' || journal_id, account_code, line_no, posting_date, description, debit, credit
  FROM postings WHERE k % 613 = 2
  UNION ALL
  SELECT k, journal_id, '9999', 1002, posting_date, 'stray', CAST(75 AS DECIMAL(28,2)),
         CAST(75 AS DECIMAL(28,2))
  FROM per_order WHERE k % 1009 = 3),
gl AS (
  SELECT 'E001' AS entity, account_code, 'Account ' || account_code AS account_name, posting_date,
         'FY' AS period, journal_id, line_no, description, debit, credit, 'AUD' AS currency,
         'LINEITEM' AS source_system,
         row_number() OVER (ORDER BY journal_id, line_no, account_code, posting_date, debit,
                                     credit, description) - 1 AS row_index
  FROM lines),
chart AS (
  SELECT DISTINCT account_code, CAST(0 AS DECIMAL(28,2)) AS opening_balance FROM clean
  UNION ALL SELECT '1500', 95000.00
  UNION ALL SELECT '3000', -95000.00),
moved AS (
  SELECT account_code, SUM(debit) AS dr, SUM(credit) AS cr FROM clean GROUP BY account_code),
clean_tb AS (
  SELECT 'E001' AS entity, account_code, 'Account ' || account_code AS account_name,
         opening_balance,
         CAST(COALESCE(dr, 0) AS DECIMAL(28,2)) AS period_debits,
         CAST(COALESCE(cr, 0) AS DECIMAL(28,2)) AS period_credits,
         CAST(opening_balance + COALESCE(dr, 0) - COALESCE(cr, 0) AS DECIMAL(28,2)) AS closing_balance
  FROM chart LEFT JOIN moved USING (account_code)),
tb AS (
  SELECT entity, account_code, account_name, opening_balance, period_debits, period_credits,
         closing_balance + CASE WHEN account_code = 'P7' THEN 1850.00 ELSE 0.00 END AS closing_balance
  FROM clean_tb),
prior AS (
  SELECT account_code, entity,
         CASE WHEN regexp_matches(account_code, '^P[0-9]*0$') THEN opening_balance + 5.00
              ELSE opening_balance END AS closing_balance
  FROM tb WHERE NOT regexp_matches(account_code, '^P[0-9]*13$')
  UNION ALL SELECT '2500', 'E001', -40.00)"""


def finding(
    control: str,
    source: str,
    value: str,
    evidence: str,
    *,
    account: str = "CAST(NULL AS VARCHAR)",
    journal: str = "CAST(NULL AS VARCHAR)",
    count: str = "1",
    unbalanced: bool = False,
    balance: bool = True,
) -> str:
    material = f"{value} > 1000.00"
    grade = (
        "'HIGH'"
        if unbalanced
        else f"CASE WHEN {material} THEN 'HIGH' ELSE '{'MEDIUM' if balance else 'LOW'}' END"
    )
    return f"""SELECT 'RUN' AS run_id, '{control}' AS control_id, {grade} AS severity,
  'E001' AS entity, {account} AS account_code, {journal} AS journal_id,
  CAST({value} AS {M}) AS value, CAST({count} AS BIGINT) AS record_count,
  {material} AS above_materiality, {evidence} AS evidence, 'OPEN' AS disposition
FROM {source}"""


C1_SOURCE = """(SELECT journal_id, SUM(debit) AS dr, SUM(credit) AS cr, COUNT(*) AS n FROM gl
  GROUP BY journal_id HAVING SUM(debit) <> SUM(credit))"""
C1 = finding(
    "C1", C1_SOURCE, "abs(dr - cr)",
    f"""'journal ' || journal_id || ' does not self-balance across ' || n || ' lines: debits '
  || {money('dr')} || ' against credits ' || {money('cr')} || ', a difference of '
  || {money('abs(dr - cr)')}""",
    journal="journal_id", count="n", unbalanced=True,
)
C2_SOURCE = """(SELECT t.*, COALESCE(dr, 0) AS dr, COALESCE(cr, 0) AS cr, COALESCE(n, 0) AS n,
  opening_balance + COALESCE(dr, 0) - COALESCE(cr, 0) AS derived
  FROM tb t LEFT JOIN (SELECT account_code, SUM(debit) AS dr, SUM(credit) AS cr, COUNT(*) AS n
    FROM gl GROUP BY account_code) g USING (account_code)) WHERE derived <> closing_balance"""
C2 = finding(
    "C2", C2_SOURCE, "abs(derived - closing_balance)",
    f"""'account ' || account_code || ': General Ledger derives ' || {money('derived')}
  || ' from opening ' || {money('opening_balance')} || ' plus debits ' || {money('dr')}
  || ' less credits ' || {money('cr')} || ' over ' || n
  || ' lines, against a Trial Balance closing balance of ' || {money('closing_balance')}
  || '; a difference of ' || {money('abs(derived - closing_balance)')}""",
    account="account_code", count="n + 1",
)
C3A = finding(
    "C3", "tb WHERE account_code NOT IN (SELECT account_code FROM gl)", "abs(closing_balance)",
    f"""'account ' || account_code || ' ' || account_name
  || ' appears in the Trial Balance with a closing balance of ' || {money('closing_balance')}
  || ' and has no General Ledger lines'""",
    account="account_code",
)
C3B = finding(
    "C3",
    """(SELECT account_code, COUNT(*) AS n, SUM(debit - credit) AS moves FROM gl
  WHERE account_code NOT IN (SELECT account_code FROM tb) GROUP BY account_code)""",
    "abs(moves)",
    f"""'account ' || account_code || ' carries ' || n || ' General Ledger lines moving '
  || {money('moves')} || ' and does not appear in the Trial Balance'""",
    account="account_code", count="n",
)
OUTSIDE = "gl WHERE posting_date NOT BETWEEN DATE '1995-02-01' AND DATE '2001-10-01'"
C4 = finding(
    "C4", OUTSIDE, "(debit + credit)",
    f"""'journal ' || journal_id || ' line ' || line_no || ', account ' || account_code
  || ', is dated ' || posting_date || ', outside 1995-02-01 to 2001-10-01: debit '
  || {money('debit')} || ' credit ' || {money('credit')}""",
    account="account_code", journal="journal_id", balance=False,
)
BOTH_YEARS = """(SELECT COALESCE(t.account_code, p.account_code) AS account_code,
  COALESCE(t.entity, p.entity) AS entity, COALESCE(t.opening_balance, 0) AS opening,
  COALESCE(p.closing_balance, 0) AS before,
  CASE WHEN t.account_code IS NULL OR p.account_code IS NULL THEN 1 ELSE 2 END AS sides
  FROM tb t FULL JOIN prior p ON t.account_code = p.account_code)"""
C5 = finding(
    "C5", BOTH_YEARS + " WHERE opening <> before", "abs(opening - before)",
    f"""'account ' || account_code || ': prior period closing ' || {money('before')}
  || ' against current period opening ' || {money('opening')} || '; a difference of '
  || {money('abs(opening - before)')}""",
    account="account_code", count="sides",
)
BROKEN = """(SELECT account_code, opening_balance, period_debits, period_credits, closing_balance,
  opening_balance + period_debits - period_credits AS derived FROM tb
  WHERE opening_balance + period_debits - period_credits <> closing_balance)"""
C6 = finding(
    "C6",
    f"""(SELECT SUM(closing_balance) AS total, COUNT(*) AS n FROM tb),
  (SELECT COUNT(*) AS broken, MAX(abs(derived - closing_balance)) AS largest FROM {BROKEN})
WHERE total <> 0 OR broken > 0""",
    "abs(total)",
    f"""'Trial Balance closing balances sum to ' || {money('total')} || ' rather than 0.00 across '
  || n || ' accounts; ' || CASE WHEN broken = 0 THEN 'every account''s opening plus movement equals its closing'
  ELSE 'rows whose closing does not follow from opening plus debits less credits: ' || broken || ', by '
  || {money('largest')} || ' at most' END""",
    count="n",
)

EXACT_DIGEST = f"""sha256(entity || chr(31) || account_code || chr(31) || posting_date || chr(31)
  || journal_id || chr(31) || line_no || chr(31) || {money('debit')} || chr(31) || {money('credit')}
  || chr(31) || description)"""
SUSPECTED_DIGEST = f"""sha256(entity || chr(31) || account_code || chr(31) || posting_date || chr(31)
  || {money('debit')} || chr(31) || {money('credit')})"""


def exact_groups(listed: bool = False) -> str:
    """Groups by the fields, then hashing: the digest is only a name of the group. ``listed``: with all its rows."""
    rows = ",\n    string_agg(CAST(row_index AS VARCHAR), ', ' ORDER BY row_index) AS rows_" if listed else ""
    return f"""
exact_g AS (
  SELECT 'EXACT' AS kind, {EXACT_DIGEST} AS digest, account_code, posting_date, journal_id, line_no,
    debit, credit, COUNT(*) AS n, 1 AS journals,
    MIN(row_index) AS first_row, MAX(row_index) AS last_row{rows}
  FROM gl GROUP BY entity, account_code, posting_date, journal_id, line_no, debit, credit, description
  HAVING COUNT(*) >= 2)"""


DUPLICATES = f"""{exact_groups()},
suspected_g AS (
  SELECT 'SUSPECTED' AS kind, {SUSPECTED_DIGEST} AS digest, account_code, posting_date,
    CAST(NULL AS VARCHAR) AS journal_id, 0 AS line_no, debit, credit, COUNT(*) AS n,
    COUNT(DISTINCT journal_id) AS journals,
    MIN(row_index) AS first_row, MAX(row_index) AS last_row
  FROM gl GROUP BY entity, account_code, posting_date, debit, credit
  HAVING COUNT(DISTINCT journal_id) >= 2)"""


def dedupe_exact(listed: bool = False) -> str:
    rows = "'; population rows ' || rows_ || " if listed else ""
    return finding(
        "DEDUPE", "exact_g", "((n - 1) * (debit + credit))",
        f"""n || ' lines identical across all eight key fields: first at population row ' || first_row
  || ', last at ' || last_row || ', journal ' || journal_id || ' line ' || line_no || ', account ' || account_code
  || ', dated ' || posting_date || ', debit ' || {money('debit')} || ' credit ' || {money('credit')}
  || {rows}'; hash ' || substr(digest, 1, 12)""",
        account="account_code", journal="journal_id", count="n",
    )


DEDUPE_EXACT = dedupe_exact()
DEDUPE_SUSPECTED = finding(
    "DEDUPE", "suspected_g", "((n - 1) * (debit + credit))",
    f"""n || ' lines share account ' || account_code || ', date ' || posting_date || ', debit '
  || {money('debit')} || ' and credit ' || {money('credit')} || ' under ' || journals
  || ' journal identifiers: first at population row ' || first_row || ', last at ' || last_row || '; hash '
  || substr(digest, 1, 12)""",
    account="account_code", count="n",
)


def placed(control: int, source: str, value: str, code: str = "''", row: str = "0", block: int = 0) -> str:
    """What orders a control's findings: its number, a block, a code and a row."""
    name = ("C1", "C2", "C3", "C4", "C5", "C6", "DEDUPE")[control]
    return f"""SELECT '{name}' AS control_id, {control} AS control_pos, {block} AS block, {code} AS sort_code,
  CAST({row} AS BIGINT) AS sort_row, CAST({value} AS {M}) AS value FROM {source}"""


PLACED = " UNION ALL ".join([
    placed(0, C1_SOURCE, "abs(dr - cr)", "journal_id"),
    placed(1, C2_SOURCE, "abs(derived - closing_balance)", "account_code"),
    placed(2, "tb WHERE account_code NOT IN (SELECT account_code FROM gl)", "abs(closing_balance)", "account_code"),
    placed(
        2, """(SELECT account_code, SUM(debit - credit) AS moves FROM gl
  WHERE account_code NOT IN (SELECT account_code FROM tb) GROUP BY account_code)""", "abs(moves)", "account_code", block=1,
    ),
    placed(3, OUTSIDE, "debit + credit", row="row_index"),
    placed(4, BOTH_YEARS + " WHERE opening <> before", "abs(opening - before)", "account_code"),
    placed(5, f"""(SELECT SUM(closing_balance) AS total FROM tb), (SELECT COUNT(*) AS broken FROM {BROKEN})
WHERE total <> 0 OR broken > 0""", "abs(total)"),
    placed(6, "exact_g", "(n - 1) * (debit + credit)", "'EXACT'", "first_row"),
    placed(6, "suspected_g", "(n - 1) * (debit + credit)", "'SUSPECTED'", "first_row", block=1),
])
WITH = f"WITH {LEDGER}"
FOUND = f"""{LEDGER}, {DUPLICATES},
found AS (
{C1} UNION ALL {C2} UNION ALL {C3A} UNION ALL {C3B} UNION ALL {C4} UNION ALL {C5} UNION ALL {C6}
UNION ALL {DEDUPE_EXACT} UNION ALL {DEDUPE_SUSPECTED})"""

WHOLE = f"""(SELECT CAST(SUM(debit) AS {M}) AS dr, CAST(SUM(credit) AS {M}) AS cr, COUNT(*) AS n,
  COUNT(DISTINCT journal_id) AS journals FROM gl)"""
C1_DETAIL = f"""'whole ledger: debits ' || {money('dr')} || ' against credits ' || {money('cr')}
  || ', debits less credits ' || {money('dr - cr')}
  || ', equal to the sum of the per-journal differences over ' || journals
  || CASE WHEN journals = 1 THEN ' journal' ELSE ' journals' END
  || '; reported, not raised, because the journals it is made of are already reported above'"""

CONTROLS = "(VALUES ('C1'), ('C2'), ('C3'), ('C4'), ('C5'), ('C6'), ('DEDUPE')) AS r(control_id)"

# ---- text ---------------------------------------------------------------------------

CLEAN_TEXT = """entity, account_code, account_name, CAST(posting_date AS VARCHAR) AS posting_date, period,
  journal_id, CAST(line_no AS VARCHAR) AS line_no, description, CAST(debit AS VARCHAR) AS debit,
  CAST(credit AS VARCHAR) AS credit, currency, source_system"""

DIRTY = f"""{LEDGER},
dirty AS MATERIALIZED (
  SELECT row_index + 1 AS row_number, journal_ AS journal_id, * EXCLUDE (journal_id, journal_, row_index)
  FROM (SELECT row_index, account_code, period, description, currency, source_system, journal_id,
    CASE WHEN row_index % 101 = 0 THEN '' WHEN row_index % 103 = 0 THEN NULL ELSE entity END AS entity,
    CASE WHEN row_index % 107 = 0 THEN NULL ELSE account_name END AS account_name,
    CASE WHEN row_index % 109 = 0 THEN '30/02/2001' WHEN row_index % 113 = 0 THEN NULL
         WHEN row_index % 3 = 0 THEN CAST(posting_date AS VARCHAR)
         WHEN row_index % 3 = 1 THEN day(posting_date) || '/' || month(posting_date) || '/' || year(posting_date)
         ELSE day(posting_date) || '-' || strftime(posting_date, '%b') || '-' || year(posting_date)
    END AS posting_date,
    CASE WHEN row_index % 127 = 0 THEN '   ' ELSE journal_id END AS journal_,
    CASE WHEN row_index % 131 = 0 THEN '1.5' WHEN row_index % 137 = 0 THEN '0'
         WHEN row_index % 139 = 0 THEN ' 7 ' ELSE CAST(line_no AS VARCHAR) END AS line_no,
    CASE WHEN row_index % 149 = 0 THEN 'abc' WHEN row_index % 151 = 0 THEN '-5.00'
         WHEN row_index % 157 = 0 THEN 'NaN' WHEN row_index % 163 = 0 THEN '1e3'
         WHEN row_index % 167 = 0 THEN '100000000000000000000000000.00'
         WHEN row_index % 173 = 0 THEN '2.345' WHEN row_index % 179 = 0 THEN '-0.004'
         ELSE CAST(debit AS VARCHAR) END AS debit,
    CASE WHEN row_index % 181 = 0 THEN NULL ELSE CAST(credit AS VARCHAR) END AS credit
  FROM gl)),
read_ AS MATERIALIZED (
  SELECT *, TRY_CAST(debit AS DECIMAL(28,2)) AS dr, TRY_CAST(credit AS DECIMAL(28,2)) AS cr,
    COALESCE(TRY_STRPTIME(posting_date, '%Y-%m-%d'), TRY_STRPTIME(posting_date, '%d/%m/%Y'),
             TRY_STRPTIME(posting_date, '%d-%b-%Y'))::DATE AS day_,
    CASE WHEN regexp_full_match(trim(line_no), '[+-]?[0-9]+') THEN TRY_CAST(trim(line_no) AS BIGINT) END AS ln
  FROM dirty),
broken AS MATERIALIZED (
  SELECT row_number, 1 AS place, 'V-TYPE' AS rule_id, 'entity' AS field, 'Input should be a valid string' AS detail
  FROM read_ WHERE entity IS NULL
  UNION ALL SELECT row_number, 1, 'V-EMPTY', 'entity', 'String should have at least 1 character'
  FROM read_ WHERE entity = ''
  UNION ALL SELECT row_number, 3, 'V-TYPE', 'account_name', 'Input should be a valid string'
  FROM read_ WHERE account_name IS NULL
  UNION ALL SELECT row_number, 4, 'V-DATE', 'posting_date',
    CASE WHEN posting_date IS NULL THEN 'a date must arrive as text; this arrived as NoneType'
    ELSE posting_date || ' matches none of the configured formats: %Y-%m-%d, %d/%m/%Y, %d-%b-%Y' END
  FROM read_ WHERE day_ IS NULL
  UNION ALL SELECT row_number, 7, 'V-INTEGER', 'line_no', '''' || line_no || ''' is not a whole number'
  FROM read_ WHERE ln IS NULL
  UNION ALL SELECT row_number, 7, 'V-INTEGER', 'line_no', 'line numbers start at 1; this row carries ' || ln
  FROM read_ WHERE ln < 1
  UNION ALL SELECT row_number, 9, 'V-DECIMAL', 'debit',
    CASE debit WHEN 'abc' THEN '''abc'' cannot be read as a monetary amount'
               WHEN 'NaN' THEN 'NaN is not a finite amount'
               ELSE debit || ' carries more digits than a monetary amount can hold' END
  FROM read_ WHERE dr IS NULL
  UNION ALL SELECT row_number, 9, 'V-SIGN', 'debit', 'Input should be greater than or equal to 0'
  FROM read_ WHERE dr < 0
  UNION ALL SELECT row_number, 10, 'V-DECIMAL', 'credit', 'None cannot be read as a monetary amount'
  FROM read_ WHERE cr IS NULL)"""

PROFILED = f"""{LEDGER},
cells AS (
  SELECT row_index, 'line_no' AS col, CAST(line_no AS VARCHAR) AS v FROM gl
  UNION ALL SELECT row_index, 'debit', CAST(debit AS VARCHAR) FROM gl
  UNION ALL SELECT row_index, 'posting_date', CAST(posting_date AS VARCHAR) FROM gl
  UNION ALL SELECT row_index, 'description', description FROM gl
  UNION ALL SELECT row_index, 'blank', '' FROM gl
  UNION ALL SELECT row_index, 'mixed', CASE WHEN row_index % 5 = 0 THEN 'x' ELSE CAST(line_no AS VARCHAR) END FROM gl)"""
KIND = r"""CASE WHEN COUNT(*) FILTER (WHERE v <> '') = 0 THEN 'empty'
  WHEN bool_and(v = '' OR regexp_full_match(v, '[+-]?[0-9]+')) THEN 'integer'
  WHEN bool_and(v = '' OR TRY_CAST(v AS DOUBLE) IS NOT NULL) THEN 'decimal'
  WHEN bool_and(v = '' OR TRY_STRPTIME(v, '%Y-%m-%d') IS NOT NULL) THEN 'date' ELSE 'text' END"""


def examples(cells: str) -> str:
    return f"""SELECT col AS "column", string_agg(v, '|' ORDER BY seen, v) AS examples FROM (
  SELECT col, v, MIN(row_index) AS seen,
    row_number() OVER (PARTITION BY col ORDER BY MIN(row_index), v) AS place
  FROM {cells} WHERE v <> '' GROUP BY col, v) WHERE place <= 3 GROUP BY col"""


# ---- mapping ------------------------------------------------------------------------

# Longest common subsequence by the textbook table, one list per row of it.
LCS = """list_last(list_reduce(
  list_prepend([0 for i in range(length(t.term) + 1)], [[ord(ch)] for ch in string_split(header_key, '')]),
  lambda above, cell: list_reduce(
    list_prepend([0], [[j] for j in range(1, length(t.term) + 1)]),
    lambda line, j: list_append(line, greatest(above[j[1] + 1], line[j[1]],
      above[j[1]] + CASE WHEN ord(substr(t.term, j[1], 1)) = cell[1] THEN 1 ELSE 0 END)))))"""

NAMES = """
part_headers AS (
  SELECT p_partkey, p_name, p_size, 'S' || (p_partkey // 40) AS provider,
    CASE WHEN p_partkey % 2 = 0 THEN 'parts' ELSE 'stock' END AS dataset,
    CASE p_partkey % 7 WHEN 0 THEN upper(p_name) WHEN 1 THEN replace(p_name, ' ', '_')
      WHEN 2 THEN replace(p_name, ' ', '-') WHEN 3 THEN substr(p_name, 2)
      WHEN 4 THEN p_name || ' no' WHEN 5 THEN p_brand || ' ' || p_type ELSE p_name END AS source_column,
    p_partkey % 40 AS position
  FROM part),
h AS (
  SELECT provider, dataset, source_column, position,
    lower(regexp_replace(source_column, '[ _-]+', '', 'g')) AS header_key FROM part_headers),
names AS (SELECT DISTINCT p_name FROM part),
terms AS (
  SELECT 'parts' AS dataset, p_name, 'f_' || replace(p_name, ' ', '_') AS field,
    lower(replace(p_name, ' ', '')) AS term FROM names
  UNION ALL
  SELECT 'stock', p_name, 'f_' || replace(p_name, ' ', '_'), lower(replace(p_name, ' ', ''))
  FROM names WHERE p_name NOT LIKE 's%'),
reg AS (
  SELECT provider, dataset, source_column, 'f_' || replace(MIN(p_name), ' ', '_') AS canonical_field,
    CASE WHEN MIN(p_partkey % 7) = 0 THEN 2 ELSE 3 END AS source_tier,
    CASE WHEN MIN(p_partkey % 7) = 0 THEN 'deterministic' ELSE 'human' END AS approved_by
  FROM part_headers WHERE (p_partkey // 40) % 3 = 0 AND p_partkey % 7 IN (0, 4)
  GROUP BY provider, dataset, source_column),
prop AS (
  SELECT dataset, header_key, 'f_' || replace(MIN(p_name), ' ', '_') AS canonical_field,
    CAST(70 + MIN(p_size) % 30 AS DOUBLE) / 100 AS confidence
  FROM (SELECT *, lower(regexp_replace(source_column, '[ _-]+', '', 'g')) AS header_key
        FROM part_headers WHERE p_partkey % 7 = 5)
  WHERE length(header_key) % 2 = 0 GROUP BY dataset, header_key)"""

NEAREST = f"""{NAMES},
keys AS (SELECT DISTINCT dataset, header_key FROM h),
scored AS (
  SELECT k.dataset, k.header_key, t.term, t.field, t.p_name,
    2.0::DOUBLE * {LCS} / (length(k.header_key) + length(t.term)) AS ratio
  FROM (SELECT dataset, header_key FROM keys) k JOIN terms t ON k.dataset = t.dataset),
nearest AS (
  SELECT dataset, header_key, ratio, term, field FROM scored WHERE ratio > 0
  QUALIFY row_number() OVER (PARTITION BY dataset, header_key ORDER BY ratio DESC, p_name) = 1)"""

TIER1_TEXT = """'registry entry for ' || provider || ' ' || dataset || ', approved by ' || approved_by
  || ' on 2026-07-28 at tier ' || source_tier || ': approved before'"""
TWO = "CAST(CAST(round_even(ratio, 2) AS DECIMAL(10,2)) AS VARCHAR)"

ROUTED = f"""{NEAREST},
known AS (SELECT DISTINCT provider, dataset FROM reg),
routed AS (
  SELECT h.provider, h.dataset, h.source_column, h.position,
    CASE WHEN r.source_column IS NOT NULL THEN r.canonical_field
         WHEN n.ratio >= 0.85 THEN n.field ELSE p.canonical_field END AS canonical_field,
    CASE WHEN r.source_column IS NOT NULL THEN 1.0::DOUBLE WHEN n.ratio >= 0.85 THEN n.ratio
         ELSE COALESCE(p.confidence, 0.0::DOUBLE) END AS confidence,
    CASE WHEN r.source_column IS NOT NULL THEN 1 WHEN n.ratio >= 0.85 THEN 2
         WHEN p.header_key IS NOT NULL THEN 3 END AS source_tier,
    CASE WHEN r.source_column IS NOT NULL THEN 'registry entry for ' || h.provider || ' ' || h.dataset
           || ', approved by ' || r.approved_by || ' on 2026-07-28 at tier ' || r.source_tier
           || ': approved before'
         WHEN n.term = h.header_key THEN 'exact synonym match'
         WHEN n.ratio >= 0.85 THEN 'fuzzy match to synonym ''' || n.term || ''' for ' || n.field
           || ' scoring ' || {TWO} || ', at or above the 0.85 gate'
         WHEN p.header_key IS NOT NULL THEN 'proposed from outside'
         WHEN n.term IS NULL THEN 'unresolved: no synonym in the dataset''s list came close; '
           || 'the model returned no proposal for this column'
         ELSE 'unresolved: nearest synonym ''' || n.term || ''' for ' || n.field || ' scored ' || {TWO}
           || ', below the 0.85 gate; the model returned no proposal for this column' END AS rationale,
    r.source_column IS NOT NULL OR COALESCE(n.ratio >= 0.85, FALSE)
      OR COALESCE(p.confidence >= 0.85 AND k.provider IS NOT NULL, FALSE) AS settles
  FROM h
  LEFT JOIN reg r ON r.provider = h.provider AND r.dataset = h.dataset AND r.source_column = h.source_column
  LEFT JOIN nearest n ON n.dataset = h.dataset AND n.header_key = h.header_key
  LEFT JOIN prop p ON p.dataset = h.dataset AND p.header_key = h.header_key
  LEFT JOIN known k ON k.provider = h.provider AND k.dataset = h.dataset)"""

RESOLVED = f"""{ROUTED},
ranked AS (
  SELECT *, first_value(source_column) OVER w AS holder, row_number() OVER w AS turn
  FROM routed WINDOW w AS (PARTITION BY provider, dataset, canonical_field, settles ORDER BY position)),
res AS (
  SELECT provider, dataset, source_column, position, canonical_field, confidence, source_tier,
    CASE WHEN settles AND turn > 1 THEN rationale || '; ''' || holder || ''' already resolves to '
      || canonical_field || ', so both need adjudication' ELSE rationale END AS rationale,
    CASE WHEN settles AND turn = 1 THEN 'resolved' ELSE 'review' END AS state, holder, turn, settles
  FROM ranked)"""
SHOWN = """provider, dataset, source_column, position, canonical_field,
  round(confidence, 6) AS confidence, CAST(source_tier AS INTEGER) AS source_tier, rationale"""

NAMED = f"""{RESOLVED},
names_given AS (SELECT DISTINCT source_column FROM res WHERE state = 'review'
  AND canonical_field IS NOT NULL AND source_column LIKE '%L'),
approving AS (SELECT * FROM res WHERE state = 'review' AND canonical_field IS NOT NULL
  AND source_column IN (SELECT source_column FROM names_given)),
entry AS (
  SELECT s.provider, s.dataset, s.source_column,
    CASE WHEN s.source_tier = 1 THEN r.canonical_field ELSE s.canonical_field END AS canonical_field,
    CASE WHEN s.source_tier = 1 THEN r.source_tier ELSE s.source_tier END AS source_tier,
    round(CASE WHEN s.source_tier = 1 THEN 1.0::DOUBLE ELSE s.confidence END, 6) AS confidence,
    CASE WHEN s.source_tier = 1 THEN r.approved_by WHEN s.source_tier = 2 THEN 'deterministic'
         WHEN s.state = 'review' THEN 'human' ELSE 'model' END AS approved_by,
    CASE WHEN s.source_tier = 1 THEN '2026-07-28' ELSE '2026-08-01' END AS approved_at,
    CASE WHEN s.source_tier = 1 THEN 'approved before' ELSE s.rationale END AS rationale,
    s.position, s.source_tier AS settled_tier
  FROM (SELECT * FROM res WHERE state = 'resolved' UNION ALL SELECT * FROM approving) s
  LEFT JOIN reg r ON r.provider = s.provider AND r.dataset = s.dataset AND r.source_column = s.source_column
  WHERE (s.provider, s.dataset) IN (SELECT (provider, dataset) FROM approving))"""
ENTRY_COLUMNS = """provider, dataset, source_column, canonical_field, CAST(source_tier AS INTEGER) AS source_tier,
  confidence, approved_by, approved_at, rationale"""
REG_COLUMNS = """provider, dataset, source_column, canonical_field, CAST(source_tier AS INTEGER) AS source_tier,
  1.0::DOUBLE AS confidence, approved_by, '2026-07-28' AS approved_at, 'approved before' AS rationale"""

# ---- one text per query -------------------------------------------------------------

MAPPED = f"""WITH {RESOLVED}
  SELECT dataset, COUNT(*) FILTER (WHERE source_tier = 1) AS tier1, COUNT(*) FILTER (WHERE source_tier = 2) AS tier2,
    COUNT(*) FILTER (WHERE source_tier = 3) AS tier3, COUNT(*) FILTER (WHERE state = 'review') AS review,
    COUNT(*) FILTER (WHERE state = 'resolved') AS mapped FROM res GROUP BY dataset"""
SPOILT_ROWS = f"WITH {DIRTY} SELECT COUNT(DISTINCT row_number) AS quarantined FROM broken"

SQL: dict[str, str] = {
    "c1_journal_balance": f"{WITH} {C1}",
    "c1_ledger_crosscheck": f"""{WITH}
SELECT dr AS total_debits, cr AS total_credits, CAST(dr - cr AS {M}) AS ledger_difference,
  CAST((SELECT SUM(d) FROM (SELECT SUM(debit) - SUM(credit) AS d FROM gl GROUP BY journal_id)) AS {M})
    AS journal_difference,
  n AS lines, journals, TRUE AS agrees, {C1_DETAIL} AS detail FROM {WHOLE}""",
    "account_totals": f"""{WITH}
SELECT account_code, CAST(SUM(debit) AS {M}) AS debits, CAST(SUM(credit) AS {M}) AS credits,
  COUNT(*) AS lines, arg_min(entity, row_index) AS entity FROM gl GROUP BY account_code""",
    "c2_detail_vs_summary": f"{WITH} {C2}",
    "c3_summary_only": f"{WITH} {C3A}",
    "c3_detail_only": f"{WITH} {C3B}",
    "c4_cutoff": f"{WITH} {C4}",
    "out_of_period_guard": f"""{WITH}
SELECT row_index, journal_id, CAST(posting_date AS VARCHAR) AS posting_date FROM {OUTSIDE}""",
    "c5_rollforward": f"{WITH} {C5}",
    "account_union": f"""{WITH}
SELECT account_code, entity, CAST(opening AS {M}) AS opening_balance, CAST(before AS {M}) AS prior_closing,
  CAST(sides AS BIGINT) AS sides FROM {BOTH_YEARS}""",
    "c6_tb_internal": f"{WITH} {C6}",
    "tb_row_arithmetic": f"""{WITH}
SELECT account_code, closing_balance, CAST(derived AS {M}) AS derived,
  CAST(abs(derived - closing_balance) AS {M}) AS difference FROM {BROKEN}""",
    "control_summary": f"""WITH {FOUND}
SELECT 'RUN' AS run_id, control_id, 'RUN' AS status,
  CAST(CASE WHEN control_id IN ('C1', 'C4', 'DEDUPE') THEN n
    WHEN control_id IN ('C2', 'C3') THEN n + (SELECT COUNT(*) FROM tb)
    WHEN control_id = 'C5' THEN (SELECT COUNT(*) FROM tb) + (SELECT COUNT(*) FROM prior)
    ELSE (SELECT COUNT(*) FROM tb) END AS BIGINT) AS rows_tested,
  (SELECT COUNT(*) FROM found f WHERE f.control_id = r.control_id) AS exceptions_raised,
  CAST(NULL AS VARCHAR) AS reason, CASE WHEN control_id = 'C1' THEN {C1_DETAIL} END AS detail
FROM {CONTROLS}, {WHOLE}""",
    "run_controls": f"WITH {FOUND} SELECT * FROM found",
    "register_order": f"""WITH {LEDGER}, {DUPLICATES}, keyed AS ({PLACED})
SELECT row_number() OVER (ORDER BY control_pos, block, sort_code, sort_row) AS place, * EXCLUDE (sort_row) FROM keyed""",
    "evidence": f"WITH {FOUND} SELECT control_id, evidence FROM found",
    "exact_key": f"{WITH} SELECT row_index, {EXACT_DIGEST} AS digest FROM gl",
    "suspected_key": f"{WITH} SELECT row_index, {SUSPECTED_DIGEST} AS digest FROM gl",
    "dedupe_exact": f"{WITH}, {exact_groups(listed=True)} {dedupe_exact(listed=True)}",
    "dedupe_suspected": f"{WITH}, {DUPLICATES} {DEDUPE_SUSPECTED}",
    "duplicate_decisions": f"""{WITH}, {DUPLICATES}
SELECT 'DUP-' || kind || '-' || substr(digest, 1, 12) AS decision_id, kind, CAST(n AS BIGINT) AS group_rows,
  CAST(journals AS BIGINT) AS journals, CAST(first_row AS BIGINT) AS first_row,
  CAST(last_row AS BIGINT) AS last_row, 'PIPELINE' AS decided_by,
  'OPEN' AS disposition, TRUE AS reversible
FROM (SELECT kind, digest, n, journals, first_row, last_row FROM exact_g
  UNION ALL SELECT kind, digest, n, journals, first_row, last_row FROM suspected_g)""",
    "duplicate_journals": f"""{WITH}, {DUPLICATES}
SELECT 'DUP-EXACT-' || substr(digest, 1, 12) AS decision_id, kind, journal_id, CAST(n AS BIGINT) AS lines FROM exact_g
UNION ALL
SELECT 'DUP-SUSPECTED-' || substr(digest, 1, 12), kind, k.journal_id, COUNT(*) FROM suspected_g
JOIN (SELECT journal_id, {SUSPECTED_DIGEST} AS digest FROM gl) k USING (digest)
GROUP BY digest, kind, k.journal_id""",
    "duplicate_members": f"""{WITH}, keyed AS (
  SELECT row_index, journal_id, {EXACT_DIGEST} AS e, {SUSPECTED_DIGEST} AS s FROM gl),
members AS (
  SELECT 'EXACT' AS kind, e AS digest, row_index, journal_id, COUNT(*) OVER (PARTITION BY e) AS n,
    2 AS journals FROM keyed
  UNION ALL
  SELECT 'SUSPECTED', s, k.row_index, k.journal_id, g.n, g.journals FROM keyed k JOIN (
    SELECT s, COUNT(*) AS n, COUNT(DISTINCT journal_id) AS journals FROM keyed GROUP BY s) g USING (s))
SELECT 'DUP-' || kind || '-' || substr(digest, 1, 12) AS decision_id, kind, row_index, journal_id,
  row_number() OVER (PARTITION BY kind, digest ORDER BY row_index) AS occurrence, CAST(n AS BIGINT) AS group_rows
FROM members WHERE n >= 2 AND journals >= 2""",
    "population_unchanged": f"""{WITH}
SELECT COUNT(*) AS "rows", CAST(0 AS BIGINT) AS lost, CAST(0 AS BIGINT) AS added FROM gl""",
    "canonical_projection": f"{WITH} SELECT row_index, {CLEAN_TEXT} FROM gl",
    "normalise_header": f"""WITH {NAMES}
SELECT provider, position, source_column,
  replace(replace(replace(lower(source_column), ' ', ''), '_', ''), '-', '') AS normalised FROM part_headers""",
    "severity": f"""{WITH}
SELECT row_index, CASE WHEN line_no = 1001 OR debit + credit > 1000.00 THEN 'HIGH'
  WHEN account_code <> '4000' THEN 'MEDIUM' ELSE 'LOW' END AS severity FROM gl""",
    "above_materiality": f"""{WITH}
SELECT account_code, closing_balance > 1000.00 OR closing_balance < -1000.00 AS above_materiality FROM tb""",
    "signed_amount": f"""{WITH}
SELECT row_index, CAST(debit + credit AS {M}) AS amount, CAST(debit - credit AS {M}) AS movement FROM gl""",
    "parse_money": f"WITH {DIRTY} SELECT row_number, debit AS text, dr AS parsed FROM read_",
    "parse_date_multi": f"""WITH {DIRTY}
SELECT row_number, posting_date AS text, CAST(day_ AS VARCHAR) AS parsed FROM read_""",
    "parse_whole_number": f"WITH {DIRTY} SELECT row_number, line_no AS text, ln AS parsed FROM read_",
    "required_text": f"""WITH {DIRTY}
SELECT row_number, rule_id, field, detail FROM broken WHERE rule_id IN ('V-EMPTY', 'V-TYPE')""",
    "movement_sign": f"""WITH {DIRTY}
SELECT row_number, rule_id, field, detail FROM broken WHERE rule_id = 'V-SIGN'""",
    "structural_rules": f"""WITH {DIRTY}
SELECT rule_id, field, COUNT(*) AS failures FROM broken GROUP BY rule_id, field
UNION ALL SELECT 'V-REQUIRED', 'currency', COUNT(*) FROM dirty
UNION ALL SELECT 'V-UNEXPECTED-FIELD', 'ccy', COUNT(*) FROM dirty""",
    "quarantine_split": f"""WITH {DIRTY}
SELECT 'ledger' AS source_file, row_number, entity, account_code, account_name,
  CAST(day_ AS VARCHAR) AS posting_date, period, journal_id, ln AS line_no, description, dr AS debit,
  cr AS credit, currency, source_system
FROM read_ ANTI JOIN (SELECT DISTINCT row_number FROM broken) AS b USING (row_number)""",
    "quarantine_detail": f"""WITH {DIRTY}
SELECT 'ledger' AS source_file, row_number, arg_min(rule_id, place) AS rule_id, arg_min(field, place) AS field,
  arg_min(detail, place) AS detail, string_agg(rule_id || ' ' || field, '; ' ORDER BY place) AS failures,
  any_value(debit) AS raw_debit, CAST(12 AS BIGINT) AS raw_fields
FROM broken JOIN dirty USING (row_number) GROUP BY row_number""",
    "control_total": f"""WITH {DIRTY}, bad AS (SELECT DISTINCT row_number FROM broken)
SELECT 'ledger' AS source_file, COUNT(*) AS rows_received, COUNT(*) - (SELECT COUNT(*) FROM bad) AS rows_accepted,
  (SELECT COUNT(*) FROM bad) AS rows_quarantined, TRUE AS holds FROM dirty""",
    "by_control": f"""WITH {FOUND}
SELECT r.control_id, COUNT(f.value) AS findings, CAST(COALESCE(SUM(f.value), 0) AS {M}) AS value,
  COUNT(*) FILTER (WHERE f.above_materiality) AS above,
  COUNT(*) FILTER (WHERE NOT f.above_materiality) AS below
FROM {CONTROLS} LEFT JOIN found f ON f.control_id = r.control_id GROUP BY r.control_id""",
    "agreement": f"""WITH {FOUND}, flagged AS (
  SELECT DISTINCT account_code FROM found WHERE control_id IN ('C2', 'C3') AND account_code IS NOT NULL)
SELECT CAST(SUM(abs(closing_balance)) AS {M}) AS in_scope,
  CAST(SUM(abs(closing_balance)) FILTER (WHERE account_code NOT IN (SELECT account_code FROM flagged)) AS {M}) AS agreed,
  CAST(SUM(abs(closing_balance)) FILTER (WHERE account_code IN (SELECT account_code FROM flagged)) AS {M}) AS not_agreed,
  COUNT(*) AS accounts, (SELECT COUNT(*) FROM flagged) AS flagged_total,
  COUNT(*) FILTER (WHERE account_code IN (SELECT account_code FROM flagged)) AS flagged_in_scope
FROM tb""",
    "counters": f"""WITH {DIRTY}, {DUPLICATES},
found AS ({C1} UNION ALL {C2} UNION ALL {C3A} UNION ALL {C3B} UNION ALL {C4} UNION ALL {C5} UNION ALL {C6}
UNION ALL {DEDUPE_EXACT} UNION ALL {DEDUPE_SUSPECTED}),
{RESOLVED}, bad AS (SELECT DISTINCT row_number FROM broken)
SELECT CAST(1 AS BIGINT) AS source_files,
  (SELECT COUNT(*) FROM res WHERE state = 'resolved') AS columns_mapped,
  (SELECT COUNT(*) FROM res WHERE state = 'review') AS columns_in_review, CAST(2 AS BIGINT) AS model_calls,
  (SELECT COUNT(*) FROM dirty) AS rows_received,
  (SELECT COUNT(*) FROM dirty) - (SELECT COUNT(*) FROM bad) AS rows_accepted,
  (SELECT COUNT(*) FROM bad) AS rows_quarantined, (SELECT COUNT(*) FROM gl) AS gl_lines,
  (SELECT COUNT(*) FROM tb) AS tb_rows, CAST(7 AS BIGINT) AS controls_registered,
  CAST(7 AS BIGINT) AS controls_run, CAST(0 AS BIGINT) AS controls_skipped,
  (SELECT COUNT(*) FROM exact_g) + (SELECT COUNT(*) FROM suspected_g) AS duplicate_decisions,
  COUNT(*) AS exceptions, COUNT(*) FILTER (WHERE above_materiality) AS exceptions_above_materiality,
  COUNT(*) FILTER (WHERE NOT above_materiality) AS exceptions_below_materiality
FROM found""",
    "register_sink": f"""WITH {FOUND}
SELECT run_id, control_id, severity, entity, COALESCE(account_code, '') AS account_code,
  COALESCE(journal_id, '') AS journal_id, CAST(value AS VARCHAR) AS value,
  CAST(record_count AS VARCHAR) AS record_count,
  CASE WHEN above_materiality THEN 'true' ELSE 'false' END AS above_materiality, evidence, disposition
FROM found""",
    "run_log_sink": f"""WITH figures AS ({MAPPED}), quarantined AS ({SPOILT_ROWS}), run AS (WITH {FOUND}
  SELECT 'RUN' AS run_id, 'LINEITEM' AS provider, (SELECT COUNT(*) FROM gl) AS rows_received,
    COUNT(*) AS exceptions, TRUE AS control_total_holds, CAST(7 AS BIGINT) AS controls,
    COUNT(DISTINCT control_id) AS controls_with_findings FROM found)
SELECT run.*, quarantined.*, figures.* FROM run, quarantined, figures""",
    "register_vs_expected": f"""{WITH}, expected AS (
  SELECT 'C1' AS control_id, journal_id, CAST(CASE WHEN k % 499 = 1 THEN total ELSE 0 END
    + CASE WHEN k % 997 = 0 THEN 250 ELSE 0 END AS {M}) AS value FROM per_order
  WHERE k % 499 = 1 OR k % 997 = 0
  UNION ALL SELECT 'C1', journal_id, 1 FROM per_order WHERE k % 613 = 2),
actual AS (SELECT 'C1' AS control_id, journal_id, CAST(abs(dr - cr) AS {M}) AS value FROM {C1_SOURCE})
SELECT *, 'unexpected' AS problem FROM (SELECT * FROM actual EXCEPT ALL SELECT * FROM expected)
UNION ALL SELECT *, 'not found' FROM (SELECT * FROM expected EXCEPT ALL SELECT * FROM actual)""",
    "column_profile": f"""WITH {PROFILED}, shown AS ({examples('cells')})
SELECT c.col AS "column", COUNT(*) AS "rows", COUNT(*) FILTER (WHERE v <> '') AS populated,
  COUNT(DISTINCT v) FILTER (WHERE v <> '') AS "distinct", {KIND} AS kind,
  COALESCE(any_value(examples), '') AS examples
FROM cells c LEFT JOIN shown s ON s."column" = c.col GROUP BY c.col""",
    "kind_inference": f'WITH {PROFILED} SELECT col AS "column", {KIND} AS kind FROM cells GROUP BY col',
    "sample_and_examples": f"WITH {PROFILED} {examples('(SELECT * FROM cells WHERE row_index < 20)')}",
    "tier1_registry": f"""WITH {NAMES}
SELECT provider, dataset, source_column, position, canonical_field, 1.0::DOUBLE AS confidence,
  CAST(1 AS INTEGER) AS source_tier, {TIER1_TEXT} AS rationale
FROM h JOIN reg USING (provider, dataset, source_column)""",
    "tier2_synonym": f"""WITH {NAMES}
SELECT provider, dataset, source_column, position, field AS canonical_field, 1.0::DOUBLE AS confidence,
  CAST(2 AS INTEGER) AS source_tier, 'exact synonym match' AS rationale
FROM h JOIN terms USING (dataset) WHERE header_key = term""",
    "tier2_fuzzy_nearest": f"""WITH {NEAREST}
SELECT provider, h.dataset, source_column, position, h.header_key, round(ratio, 6) AS ratio, term, field
FROM h LEFT JOIN nearest n ON n.dataset = h.dataset AND n.header_key = h.header_key""",
    "nearest_argmax": f"""WITH {NEAREST}
SELECT dataset, header_key, round(ratio, 6) AS ratio, term, field FROM nearest""",
    "tier3_proposals": f"""WITH {NAMES}
SELECT provider, h.dataset, source_column, position, canonical_field, round(confidence, 6) AS confidence,
  CAST(3 AS INTEGER) AS source_tier, 'proposed from outside' AS rationale
FROM h JOIN prop p ON p.dataset = h.dataset AND p.header_key = h.header_key
WHERE NOT EXISTS (SELECT 1 FROM reg r WHERE r.provider = h.provider AND r.dataset = h.dataset
    AND r.source_column = h.source_column)
  AND NOT EXISTS (SELECT 1 FROM terms t WHERE t.dataset = h.dataset AND t.term = h.header_key)""",
    "gate_routing": f"WITH {ROUTED} SELECT {SHOWN}, settles FROM routed",
    "contested_field": f"""WITH {RESOLVED}
SELECT provider, dataset, source_column, position, canonical_field, holder FROM res WHERE settles AND turn > 1""",
    "file_order_proposals": f"WITH {RESOLVED} SELECT {SHOWN}, state FROM res",
    "review_queue_sink": f"WITH {RESOLVED} SELECT {SHOWN}, state FROM res",
    "missing_fields": f"""WITH {RESOLVED}, wanted AS (
  SELECT d.provider, d.dataset, 'f_' || replace(p_name, ' ', '_') AS field, place AS field_position
  FROM (SELECT DISTINCT provider, dataset FROM res) d,
    (SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS place FROM names))
SELECT * FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM res r WHERE r.provider = w.provider
  AND r.dataset = w.dataset AND r.canonical_field = w.field AND r.state = 'resolved')""",
    "column_accounting": """SELECT COUNT(*) AS headers, COUNT(*) AS accounted, CAST(0 AS BIGINT) AS problems FROM part""",
    "mapping_figures": f"""WITH {RESOLVED}
SELECT provider, dataset, COUNT(*) FILTER (WHERE source_tier = 1) AS tier1,
  COUNT(*) FILTER (WHERE source_tier = 2) AS tier2, COUNT(*) FILTER (WHERE source_tier = 3) AS tier3,
  COUNT(*) FILTER (WHERE state = 'review') AS review, COUNT(*) FILTER (WHERE state = 'resolved') AS mapped
FROM res GROUP BY provider, dataset""",
    "reference_tables": f"WITH {NAMES} SELECT {REG_COLUMNS} FROM reg",
    "approve_all": f"""WITH {RESOLVED}
SELECT {SHOWN}, state FROM res WHERE state = 'review' AND canonical_field IS NOT NULL""",
    "approve_named": f"""WITH {NAMED}
SELECT {SHOWN}, state FROM res WHERE state = 'review'
  AND source_column IN (SELECT source_column FROM names_given)""",
    "registry_entry": f"WITH {NAMED} SELECT {ENTRY_COLUMNS}, position FROM entry",
    "registry_upsert": f"""WITH {NAMED}
SELECT {REG_COLUMNS} FROM reg WHERE (provider, dataset) NOT IN (SELECT (provider, dataset) FROM entry)
UNION ALL SELECT {ENTRY_COLUMNS} FROM entry""",
    "written_summary": f"""WITH {NAMED}
SELECT provider, dataset, COUNT(*) AS columns, COUNT(*) FILTER (WHERE settled_tier = 1) AS tier1,
  COUNT(*) FILTER (WHERE settled_tier = 2) AS tier2, COUNT(*) FILTER (WHERE settled_tier = 3) AS tier3,
  COUNT(*) FILTER (WHERE approved_by = 'deterministic') AS deterministic,
  COUNT(*) FILTER (WHERE approved_by = 'human') AS human, COUNT(*) FILTER (WHERE approved_by = 'model') AS model
FROM entry GROUP BY provider, dataset""",
    "derive_summary": f"{WITH} SELECT * FROM clean_tb",
    "expand_journals": """WITH t AS (
  SELECT 'O' || o_orderkey AS journal_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS posting_date,
    o_orderkey AS k, CAST(o_totalprice AS DECIMAL(28,2)) AS total FROM orders),
p AS (SELECT *, CAST(total * CAST(0.6 AS DECIMAL(3,1)) AS DECIMAL(28,2)) AS part FROM t)
SELECT journal_id, posting_date, CAST(1 AS BIGINT) AS line_no, '1100' AS account_code, 'sale' AS description,
  CASE WHEN k % 2 = 0 THEN total ELSE part END AS debit, CAST(0 AS DECIMAL(28,2)) AS credit FROM p
UNION ALL SELECT journal_id, posting_date, 2, '1000', 'deposit', total - part, 0 FROM p WHERE k % 2 <> 0
UNION ALL SELECT journal_id, posting_date, CASE WHEN k % 2 = 0 THEN 2 ELSE 3 END, '4100', 'revenue', 0, total FROM p""",
    "two_sided_check": f"""{WITH}
SELECT row_index, journal_id, debit, credit FROM gl
WHERE NOT ((debit > 0 AND credit = 0) OR (credit > 0 AND debit = 0))""",
    "expectation_suite": f"""{WITH}, {DUPLICATES}, measured AS (
  SELECT 'V1' AS check_id, 'every clean journal balances' AS statement, '0' AS expected, CAST((SELECT COUNT(*)
    FROM (SELECT k FROM clean GROUP BY k HAVING SUM(debit) <> SUM(credit))) AS VARCHAR) AS actual
  UNION ALL SELECT 'V2', 'the clean ledger balances', '0.00',
    (SELECT CAST(CAST(SUM(debit) - SUM(credit) AS {M}) AS VARCHAR) FROM clean)
  UNION ALL SELECT 'V3', 'summary closings sum to nil', '0.00',
    (SELECT CAST(CAST(SUM(closing_balance) AS {M}) AS VARCHAR) FROM tb)
  UNION ALL SELECT 'V4', 'every summary row follows', '0', CAST((SELECT COUNT(*) FROM {BROKEN}) AS VARCHAR)
  UNION ALL SELECT 'V5', 'two accounts are without lines', '2', CAST((SELECT COUNT(*) FROM tb
    WHERE account_code NOT IN (SELECT account_code FROM gl)) AS VARCHAR)
  UNION ALL SELECT 'V7', 'every clean posting is in the year', '0', CAST((SELECT COUNT(*) FROM clean
    WHERE posting_date NOT BETWEEN DATE '1995-02-01' AND DATE '2001-10-01') AS VARCHAR)
  UNION ALL SELECT 'V8', 'every delivered journal balances', '0',
    CAST((SELECT COUNT(*) FROM {C1_SOURCE}) AS VARCHAR)
  UNION ALL SELECT 'V9', 'no exact duplicates were delivered', '0', CAST((SELECT COUNT(*) FROM exact_g) AS VARCHAR)
  UNION ALL SELECT 'V10', 'summary closings sum to the moved amount', '1850.00',
    (SELECT CAST(CAST(SUM(closing_balance) AS {M}) AS VARCHAR) FROM tb)
  UNION ALL SELECT 'G3', 'no suspected duplicates were delivered', '0',
    CAST((SELECT COUNT(*) FROM suspected_g) AS VARCHAR)
  UNION ALL SELECT 'G10', 'every clean line has one side', '0', CAST((SELECT COUNT(*) FROM clean
    WHERE NOT ((debit > 0 AND credit = 0) OR (credit > 0 AND debit = 0))) AS VARCHAR))
SELECT check_id, statement, expected = actual AS ok, expected, actual FROM measured""",
    "all_text_scan": f"{WITH} SELECT {CLEAN_TEXT}, TRUE AS regular FROM gl",
    "row_position": f"""{WITH} SELECT COUNT(*) AS "rows", COUNT(*) AS well_numbered FROM gl""",
    "format_audit": f"""{WITH}
SELECT 'utf-8' AS encoding, ',' AS delimiter, CAST(12 AS BIGINT) AS width, COUNT(*) AS "rows" FROM gl""",
}
