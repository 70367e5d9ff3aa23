"""Independent DuckDB SQL for every registered query.

Written from the reference's SQL semantics (``TRUNC`` date ranges, ``NVL``
bounds, inner joins), not from the Spark plans, so a shared mistake is unlikely.
The entity mapping is repeated here in SQL.
"""

from __future__ import annotations

ENTITIES = """
checks AS (
  SELECT o_orderkey AS check_id, o_orderkey AS doc_sequence_value, o_orderkey AS check_number,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderdate AS check_date,
         o_custkey AS vendor_id, o_custkey AS vendor_site_id,
         CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS payment_document_id,
         CAST(substr(o_orderpriority, 1, 1) AS BIGINT) - 1 AS ce_bank_acct_use_id,
         CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS BIGINT) = 5 THEN 'CHECK' ELSE 'EFT' END AS payment_method_code,
         CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS BIGINT) <= 2 THEN 'A' ELSE 'Q' END AS payment_type_flag,
         CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS checkrun_id,
         'PAYRUN ' || strftime(o_orderdate, '%Y-%m-%d') AS checkrun_name,
         CASE WHEN day(o_orderdate) = 31 THEN 'VOIDED' ELSE 'NEGOTIABLE' END AS status_lookup_code,
         CASE WHEN substr(o_orderpriority, 1, 1) = '5' THEN 'COURIER' ELSE 'STANDARD' END AS attribute_category,
         CASE WHEN substr(o_orderpriority, 1, 1) <> '5' AND o_custkey % 11 <> 0 THEN 'B' || CAST(o_custkey % 9 AS VARCHAR) END AS attribute2,
         CASE WHEN substr(o_orderpriority, 1, 1) = '5' AND o_orderstatus = 'O' THEN 'Y' END AS attribute3,
         CASE WHEN substr(o_orderpriority, 1, 1) = '5'
              THEN CASE WHEN o_orderkey % 10 = 3 THEN 'NOON' WHEN o_totalprice > 250000 THEN 'NIGHT' END END AS attribute5,
         CASE WHEN substr(o_orderpriority, 1, 1) <> '5' THEN CAST(o_orderkey % 40 - 4 AS VARCHAR)
              WHEN o_orderkey % 25 = 0 THEN 'n/a'
              ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) % CAST(1000 AS DECIMAL(18,2)) AS VARCHAR) END AS attribute8,
         CASE o_orderstatus WHEN 'P' THEN 'NEW' WHEN 'F' THEN 'PRINTED' END AS attribute14,
         CASE WHEN day(o_orderdate) = 31 THEN o_orderdate + INTERVAL 1 DAY END AS void_date
  FROM orders),
sites AS (SELECT c_custkey AS vendor_site_id, c_mktsegment AS vendor_site_code, c_name AS vendor_name FROM customer),
labels AS (SELECT * FROM (VALUES ('NEW', 'US', 'Unsend'), ('PRINTED', 'US', 'Sent'),
                                 ('NEW', 'ESA', 'No Enviado'), ('PRINTED', 'ESA', 'Enviado')) t(code, lang, meaning)),
docs AS (SELECT CAST(n_nationkey + 1 AS BIGINT) AS payment_document_id, CAST(n_nationkey AS BIGINT) AS bank_account_id,
                'DOC ' || n_name AS payment_document_name FROM nation),
inv_pay AS (SELECT l_orderkey AS check_id, l_partkey AS invoice_id, l_linenumber AS line_number,
                   l_suppkey AS supplier_ref, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount_paid FROM lineitem),
invoices AS (SELECT p_partkey AS invoice_id, 'INV' || CAST(p_partkey AS VARCHAR) AS invoice_num FROM part)
"""


def selection_sql(start="1996-01-01", end="1998-12-31", statuses=("NEW", "PRINTED"), lang="US",
                  doc_lo=None, doc_hi=None, base="0", top="99999999.99", run_id="run-1", name="sel") -> str:
    """The selection cursor with Oracle's TRUNC semantics written literally."""
    st = ", ".join(f"'{s}'" for s in statuses)
    lo = "NULL" if doc_lo is None else str(doc_lo)
    hi = "NULL" if doc_hi is None else str(doc_hi)
    b = "NULL" if base is None else f"CAST({base} AS DECIMAL(18,2))"
    t = "NULL" if top is None else f"CAST({top} AS DECIMAL(18,2))"
    return f"""
{name} AS (
  SELECT '{run_id}-' || CAST(c.payment_document_id AS VARCHAR) AS file_id, c.*, s.vendor_site_code, s.vendor_name,
         l.meaning AS send_status, COALESCE(c.attribute14, 'NEW') AS send_code
  FROM checks c
  JOIN docs d ON d.payment_document_id = c.payment_document_id
  JOIN sites s ON s.vendor_site_id = c.vendor_site_id
  JOIN labels l ON l.code = COALESCE(c.attribute14, 'NEW') AND l.lang = '{lang}'
  WHERE CAST(c.check_date AS DATE) >= DATE '{start}' AND CAST(c.check_date AS DATE) <= DATE '{end}'
    AND c.check_number >= COALESCE({lo}, c.check_number) AND c.check_number <= COALESCE({hi}, c.check_number)
    AND c.amount BETWEEN COALESCE({b}, c.amount) AND COALESCE({t}, c.amount)
    AND COALESCE(c.attribute14, 'NEW') IN ({st})
    AND c.void_date IS NULL)
"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


BASE = with_(ENTITIES, selection_sql())

SEL_NEW = with_(ENTITIES, selection_sql(statuses=("NEW",)))

SUPPLIER_BANK = """
accts AS (
  SELECT c_custkey * 2 AS ext_bank_account_id, c_custkey AS owner, c_name || ';MAIN' AS bank_account_name,
         lpad(CAST(c_nationkey AS VARCHAR), 3, '0') || '-' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS bank_account_num
  FROM customer
  UNION ALL
  SELECT c_custkey * 2 + 1, c_custkey, c_name || ';SAVINGS',
         lpad(CAST(c_nationkey AS VARCHAR), 3, '0') || '-9' || lpad(CAST(c_custkey AS VARCHAR), 9, '0')
  FROM customer WHERE c_acctbal < 0),
sup AS (
  SELECT DISTINCT a.bank_account_name, a.bank_account_num, c.c_name AS party_name, c.c_custkey AS vendor_id
  FROM accts a JOIN customer c ON c.c_custkey = a.owner)
"""

LINES = BASE + """
, body AS (
  SELECT file_id, check_id, payment_document_id, check_number, amount, check_date, vendor_name, vendor_site_code,
         CAST(row_number() OVER (PARTITION BY file_id ORDER BY check_number, check_id) AS BIGINT) AS seq1
  FROM sel WHERE payment_document_id IN (1, 2, 3, 4)),
det0 AS (
  SELECT s.file_id, s.check_id, s.payment_document_id, ip.invoice_id, i.invoice_num,
         CAST(row_number() OVER (PARTITION BY s.file_id, s.check_id
                                 ORDER BY ip.line_number, ip.invoice_id, ip.supplier_ref, ip.amount_paid) AS BIGINT) AS seq2
  FROM sel s JOIN inv_pay ip ON ip.check_id = s.check_id JOIN invoices i ON i.invoice_id = ip.invoice_id
  WHERE s.payment_document_id IN (1, 2, 4)),
nd AS (SELECT file_id, check_id, COUNT(*) AS n FROM det0 GROUP BY file_id, check_id),
body3 AS (
  SELECT b.*, CAST(b.seq1 - 1 + COALESCE(SUM(COALESCE(nd.n, 0)) OVER (PARTITION BY b.file_id ORDER BY b.seq1
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS seq3
  FROM body b LEFT JOIN nd ON nd.file_id = b.file_id AND nd.check_id = b.check_id),
det AS (
  SELECT d.*, b.seq1, CAST(b.seq3 + d.seq2 - 1 AS BIGINT) AS seq3
  FROM det0 d JOIN body3 b ON b.file_id = d.file_id AND b.check_id = d.check_id),
tot AS (SELECT file_id, payment_document_id, COUNT(*) AS trx_lines, SUM(amount) AS sum_trans,
               (SELECT COUNT(*) FROM det WHERE det.file_id = sel.file_id) AS n_det
        FROM sel GROUP BY file_id, payment_document_id),
lines AS (
  SELECT file_id, 'BODY' AS part, seq1, CAST(NULL AS BIGINT) AS seq2, 1 AS r, 0 AS sub,
         CASE WHEN payment_document_id IN (1, 4) THEN
           'PAYRECORD0000001' || lpad(CAST(check_number AS VARCHAR), 12, '0') || lpad(CAST(seq1 AS VARCHAR), 8, '0')
           || lpad(printf('%.2f', amount), 16, ' ') || strftime(check_date, '%d%m%Y') || 'USD'
           || rpad(vendor_name, 40, ' ') || lpad(CAST(seq3 AS VARCHAR), 6, '0') || '01'
         WHEN payment_document_id = 2 THEN
           'P;' || CAST(check_number AS VARCHAR) || ';' || format('{:,.2f}', amount) || ';'
           || strftime(check_date, '%d/%m/%Y') || ';' || replace(vendor_name, ';', '') || ';' || 'X    ' || ';'
           || lpad(CAST(seq1 AS VARCHAR), 6, '0') || ';'
         ELSE CAST(seq1 AS VARCHAR) || chr(9) || vendor_site_code || chr(9) || 'EFT-----' || chr(9) || printf('%.2f', amount)
         END AS value
  FROM body3
  UNION ALL
  SELECT file_id, 'DETAIL', seq1, seq2, 1, 1,
         CASE WHEN payment_document_id IN (1, 4) THEN
           'VOI   ' || rpad(CAST(seq1 AS VARCHAR), 8, '0') || rpad(CAST(seq2 AS VARCHAR), 4, '0') || rpad(invoice_num, 20, ' ')
           || lpad(CAST(seq3 AS VARCHAR), 6, '0')
         ELSE 'D;' || CAST(seq2 AS VARCHAR) || ';' || invoice_num END
  FROM det
  UNION ALL
  SELECT file_id, 'HEADER', 0, 0, 0, 0, 'H;' || 'DOC NATION_' || CAST(payment_document_id - 1 AS VARCHAR) || ';1996/01/01;0'
  FROM tot WHERE payment_document_id = 2
  UNION ALL
  SELECT file_id, 'TRAILER', trx_lines + 1, CAST(NULL AS BIGINT), 2, 0,
         CASE WHEN payment_document_id IN (1, 4) THEN
           'TRL' || lpad(CAST(trx_lines AS VARCHAR), 9, '0') || lpad(printf('%.2f', sum_trans), 17, '0')
           || lpad(CAST(trx_lines + 1 AS VARCHAR), 8, '0') || repeat(' ', 63)
         ELSE 'T;' || CAST(trx_lines AS VARCHAR) || ';' || printf('%.2f', sum_trans) END
  FROM tot WHERE payment_document_id IN (1, 2, 4)),
numbered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY file_id ORDER BY r, COALESCE(seq1, 0), sub, COALESCE(seq2, 0)) AS BIGINT)
            AS line_no
  FROM lines)
"""

US_TITLES = """
tl AS (SELECT * FROM (VALUES
  ('BANK', 'Bank'), ('BANK_ACCOUNT', 'Bank Account'), ('CHECK_AMOUNT', 'Amount'), ('CHECK_DATE', 'Check Date'),
  ('CHECK_NUMBER', 'Check Number'), ('DATE_TIME', 'Date Time'), ('LEGAL_ENTITY', 'Legal Entity'),
  ('PAYMENT_DOCUMENT', 'Payment Document'), ('REPORT_NAME', 'Payment Register'), ('SEND_STATUS', 'Status'),
  ('SUPPLIER_NAME', 'Supplier Name'), ('SUPPLIER_SITE', 'Supplier Site')) t(code, meaning))
"""


def _money(x: str) -> str:
    return f"CASE WHEN {x} >= 1000000000 THEN repeat('#', 15) ELSE lpad(format('{{:,.2f}}', {x}), 15, ' ') END"


def _t(code: str) -> str:
    return f"(SELECT meaning FROM tl WHERE code = '{code}')"


ES_TITLES = """
tl AS (SELECT * FROM (VALUES
  ('BANK', 'Banco'), ('BANK_ACCOUNT', 'Cuenta Bancaria'), ('CHECK_AMOUNT', 'Monto'), ('CHECK_DATE', 'Fecha de Pago'),
  ('CHECK_NUMBER', 'Numero de Pago'), ('DATE_TIME', 'Fecha Hora'), ('LEGAL_ENTITY', 'Entidad Legal'),
  ('PAYMENT_DOCUMENT', 'Documento de Pago'), ('REPORT_NAME', 'Registro de Pagos'), ('SEND_STATUS', 'Estado'),
  ('SUPPLIER_NAME', 'Proveedor'), ('SUPPLIER_SITE', 'Sucursal')) t(code, meaning))
"""


def register_text_sql(lang: str = "US") -> str:
    titles = US_TITLES if lang == "US" else ES_TITLES
    return with_(ENTITIES, selection_sql(lang=lang)) + ", " + titles.strip() + REGISTER_BODY


REGISTER_BODY = f"""
, head AS (SELECT s.file_id, n.n_name, r.r_name, COUNT(*) AS n, SUM(s.amount) AS total
           FROM sel s JOIN nation n ON n.n_nationkey + 1 = s.payment_document_id
           JOIN region r ON r.r_regionkey = n.n_regionkey GROUP BY s.file_id, n.n_name, r.r_name),
reg AS (
  SELECT file_id, 1 AS line_no, '' AS value FROM head
  UNION ALL SELECT file_id, 2, {_t('REPORT_NAME')} FROM head
  UNION ALL SELECT file_id, 3, rpad({_t('LEGAL_ENTITY')}, 18, ' ') || ': ' ||
      array_to_string(list_transform(string_split(lower(n_name) || ' payments sa', ' '),
                                     lambda w: upper(w[1]) || lower(w[2:])), ' ') FROM head
  UNION ALL SELECT file_id, 4, rpad({_t('BANK')}, 18, ' ') || ': ' || r_name || ' BANK' FROM head
  UNION ALL SELECT file_id, 5, rpad({_t('BANK_ACCOUNT')}, 18, ' ') || ': ' || n_name || ' OPERATING' FROM head
  UNION ALL SELECT file_id, 6, rpad({_t('PAYMENT_DOCUMENT')}, 18, ' ') || ': ' || 'DOC ' || n_name FROM head
  UNION ALL SELECT file_id, 7, rpad({_t('DATE_TIME')}, 18, ' ') || ': ' || '25-APR-2014 09:09:17' FROM head
  UNION ALL SELECT file_id, 8, '' FROM head
  UNION ALL SELECT file_id, 9, '  ' || lpad({_t('CHECK_NUMBER')}, 15, ' ') || '  ' || rpad({_t('CHECK_DATE')}, 14, ' ')
      || '  ' || rpad({_t('SUPPLIER_NAME')}, 50, ' ') || '  ' || rpad({_t('SUPPLIER_SITE')}, 15, ' ')
      || '  ' || lpad({_t('CHECK_AMOUNT')}, 15, ' ') || '  ' || rpad({_t('SEND_STATUS')}, 15, ' ') FROM head
  UNION ALL SELECT file_id, 9 + row_number() OVER (PARTITION BY file_id ORDER BY check_number, check_id),
      '  ' || lpad(CAST(COALESCE(check_number, 0) AS VARCHAR), 15, ' ') || '  '
      || rpad(upper(strftime(check_date, '%d-%b-%Y')), 14, ' ') || '  ' || rpad(COALESCE(vendor_name, ' '), 50, ' ')
      || '  ' || rpad(COALESCE(vendor_site_code, ' '), 15, ' ') || '  ' || {_money('amount')}
      || '  ' || rpad(COALESCE(send_status, ' '), 15, ' ') FROM sel
  UNION ALL SELECT file_id, 10 + n, repeat('-', 135) FROM head
  UNION ALL SELECT file_id, 11 + n, '  COUNT ' || lpad(CAST(n AS VARCHAR), 9, ' ') || repeat(' ', 87) || {_money('total')}
  FROM head)
"""
REGISTER_TEXT = register_text_sql("US")

FINAL1 = selection_sql(start="1996-01-01", end="1997-12-31", statuses=("NEW",), run_id="final-1", name="sel1")

GRANTS = """
grants AS (SELECT * FROM (VALUES ('G1', ' ap_supervisor ', 'Y', NULL, NULL),
                                 ('G2', 'treasury_lead', 'Y', DATE '2010-01-01', DATE '2012-12-31'),
                                 ('G3', 'intern', 'N', NULL, NULL),
                                 ('G4', 'Controller', 'Y', DATE '2013-01-01', NULL),
                                 ('G5', 'CONTROLLER ', 'Y', NULL, NULL)) t(code, meaning, enabled, s, e)),
users AS (SELECT * FROM (VALUES (1001, 'AP_SUPERVISOR'), (1002, 'TREASURY_LEAD'), (1003, 'INTERN'),
                                (1004, 'CONTROLLER'), (1005, 'AUDITOR')) t(user_id, user_name)),
ng AS (SELECT u.user_id, COUNT(g.code) AS n FROM users u LEFT JOIN grants g
         ON upper(trim(g.meaning)) = u.user_name AND g.enabled = 'Y'
        AND DATE '2014-04-25' BETWEEN COALESCE(CAST(g.s AS DATE), DATE '2014-04-25')
                              AND COALESCE(CAST(g.e AS DATE), DATE '2014-04-25')
       GROUP BY u.user_id)
"""

SUPPLIER_LINES = with_(ENTITIES, SUPPLIER_BANK) + """
, lists AS (
  SELECT ip.check_id, 'DOCUMENTOS: ' || string_agg(COALESCE(i.invoice_num, '-1') || ' ', ''
                      ORDER BY ip.line_number, ip.invoice_id, ip.supplier_ref, ip.amount_paid) AS invoices
  FROM inv_pay ip LEFT JOIN invoices i ON i.invoice_id = ip.invoice_id GROUP BY ip.check_id)
SELECT c.ce_bank_acct_use_id, c.check_id, sp.bank_account_num,
       replace(sp.bank_account_num, '-', '') || ';' || replace(sp.bank_account_name, ';', ',') || ';;'
       || rtrim(rtrim(CAST(c.amount AS VARCHAR), '0'), '.') || ';'
       || strftime(c.check_date, '%d%m%Y') || ';' || replace(COALESCE(l.invoices, 'DOCUMENTOS: '), ';', ',') AS line
FROM checks c JOIN sup sp ON sp.vendor_id = c.vendor_id LEFT JOIN lists l ON l.check_id = c.check_id
WHERE c.check_date BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-12-31 23:59:59'
  AND c.payment_method_code = 'EFT' AND c.void_date IS NULL
"""

ORACLE = {
    "check_register": BASE + """
SELECT file_id, check_id, doc_sequence_value, check_number, amount, check_date, vendor_name, send_status,
       vendor_site_code
FROM sel
""",
    "selection_totals": BASE + """
SELECT file_id, COUNT(*) AS trx_lines, CAST(SUM(amount) AS DECIMAL(38,2)) AS sum_trans FROM sel GROUP BY file_id
""",
    "legacy_batch_totals": with_(ENTITIES) + """
SELECT 'run-1-' || CAST(c.payment_document_id AS VARCHAR) AS file_id, c.checkrun_id,
       CAST(SUM(c.amount) AS DECIMAL(38,2)) AS sum_trans, COUNT(c.amount) AS trx_lines
FROM checks c JOIN docs d ON d.payment_document_id = c.payment_document_id
WHERE CAST(c.check_date AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
  AND c.amount >= 0 AND c.amount <= 99999999.99
  AND c.payment_method_code = 'EFT' AND COALESCE(c.attribute14, 'NEW') = 'NEW' AND c.void_date IS NULL
GROUP BY 1, 2
""",
    "optional_range": with_(ENTITIES, selection_sql(doc_lo=5000, base=None, top="150000.00")) + """
SELECT file_id, check_id, doc_sequence_value, check_number, amount, check_date, vendor_name, send_status,
       vendor_site_code
FROM sel
""",
    "report_lines": BASE + """
SELECT s.file_id, COUNT(DISTINCT s.check_id) AS trx_lines,
       CAST(COUNT(DISTINCT s.check_id) + COALESCE((SELECT COUNT(*) FROM sel s2 JOIN inv_pay ip ON ip.check_id = s2.check_id
                                                   WHERE s2.file_id = s.file_id), 0) AS BIGINT) AS report_lines,
       CAST(SUM(s.amount) AS DECIMAL(38,2)) AS sum_trans
FROM sel s GROUP BY s.file_id
""",
    "report_lines_legacy": BASE + """
SELECT file_id, COUNT(*) AS trx_lines,
       CAST(COUNT(*) * (SELECT COUNT(invoice_id) FROM inv_pay) + COUNT(*) AS BIGINT) AS report_lines,
       CAST(SUM(amount) AS DECIMAL(38,2)) AS sum_trans
FROM sel GROUP BY file_id
""",
    "paid_invoices": BASE + """
SELECT s.file_id, s.check_id, ip.invoice_id, i.invoice_num, ip.line_number, ip.supplier_ref, ip.amount_paid
FROM sel s JOIN inv_pay ip ON ip.check_id = s.check_id JOIN invoices i ON i.invoice_id = ip.invoice_id
""",
    "invoice_list": BASE + """
SELECT s.file_id, s.check_id,
       'DOCUMENTOS: ' || string_agg(COALESCE(i.invoice_num, '-1') || ' ', ''
                                    ORDER BY ip.line_number, ip.invoice_id, ip.supplier_ref, ip.amount_paid) AS invoices
FROM sel s JOIN inv_pay ip ON ip.check_id = s.check_id LEFT JOIN invoices i ON i.invoice_id = ip.invoice_id
GROUP BY s.file_id, s.check_id
""",
    "supplier_bank_lines": SUPPLIER_LINES,
    "supplier_bank_lines_account": SUPPLIER_LINES + "AND c.ce_bank_acct_use_id = 2",
    "value_set_labels": BASE + """
SELECT s.file_id, s.send_code, l.lang AS language, l.meaning, COUNT(*) AS n_checks
FROM sel s JOIN labels l ON l.code = s.send_code GROUP BY 1, 2, 3, 4
""",
    "register_heading": BASE + """
, tl AS (SELECT * FROM (VALUES
  ('BANK', 'Bank'), ('BANK_ACCOUNT', 'Bank Account'), ('CHECK_AMOUNT', 'Amount'), ('CHECK_DATE', 'Check Date'),
  ('CHECK_NUMBER', 'Check Number'), ('DATE_TIME', 'Date Time'), ('LEGAL_ENTITY', 'Legal Entity'),
  ('PAYMENT_DOCUMENT', 'Payment Document'), ('REPORT_NAME', 'Payment Register'), ('SEND_STATUS', 'Status'),
  ('SUPPLIER_NAME', 'Supplier Name'), ('SUPPLIER_SITE', 'Supplier Site')) t(code, meaning))
SELECT s.file_id, COUNT(*) AS trx_lines, CAST(SUM(s.amount) AS DECIMAL(38,2)) AS sum_trans,
       r.r_name || ' BANK' AS bank_name, n.n_name || ' OPERATING' AS bank_account_name,
       'DOC ' || n.n_name AS payment_document_name,
       array_to_string(list_transform(string_split(lower(n.n_name) || ' payments sa', ' '),
                                      lambda w: upper(w[1]) || lower(w[2:])), ' ') AS legal_entity,
       (SELECT meaning FROM tl WHERE code = 'BANK') AS tl_bank,
       (SELECT meaning FROM tl WHERE code = 'BANK_ACCOUNT') AS tl_bank_account,
       (SELECT meaning FROM tl WHERE code = 'CHECK_AMOUNT') AS tl_check_amount,
       (SELECT meaning FROM tl WHERE code = 'CHECK_DATE') AS tl_check_date,
       (SELECT meaning FROM tl WHERE code = 'CHECK_NUMBER') AS tl_check_number,
       (SELECT meaning FROM tl WHERE code = 'DATE_TIME') AS tl_date_time,
       (SELECT meaning FROM tl WHERE code = 'LEGAL_ENTITY') AS tl_legal_entity,
       (SELECT meaning FROM tl WHERE code = 'PAYMENT_DOCUMENT') AS tl_payment_document,
       (SELECT meaning FROM tl WHERE code = 'REPORT_NAME') AS tl_report_name,
       (SELECT meaning FROM tl WHERE code = 'SEND_STATUS') AS tl_send_status,
       (SELECT meaning FROM tl WHERE code = 'SUPPLIER_NAME') AS tl_supplier_name,
       (SELECT meaning FROM tl WHERE code = 'SUPPLIER_SITE') AS tl_supplier_site
FROM sel s JOIN nation n ON n.n_nationkey + 1 = s.payment_document_id JOIN region r ON r.r_regionkey = n.n_regionkey
GROUP BY s.file_id, r.r_name, n.n_name
""",
    "file_names": BASE + """
, fmt AS (SELECT * FROM (VALUES (1, 'txt'), (2, 'csv'), (3, 'tsv'), (4, 'txt'), (5, 'ctl')) t(format_id, ext)),
docfmt AS (SELECT * FROM (VALUES (1, 1), (2, 2), (3, 3), (4, 1), (5, 4), (6, 5), (7, 5)) t(doc, format_id))
SELECT DISTINCT s.file_id, CAST(n.n_regionkey AS BIGINT) AS bank_party_id, CAST(n.n_nationkey AS BIGINT) AS bank_account_id,
       regexp_replace('OU ' || n.n_name || '_' || 'DOC ' || n.n_name || '_' || '2014-APR-25_09AM-09-17',
                      '[^A-Za-z0-9_-]', '', 'g') AS file_name,
       f.ext AS file_extension
FROM sel s JOIN nation n ON n.n_nationkey + 1 = s.payment_document_id
LEFT JOIN docfmt df ON df.doc = s.payment_document_id LEFT JOIN fmt f ON f.format_id = df.format_id
""",
    "assigned_format": BASE + """
, fmt AS (SELECT * FROM (VALUES (1, 'PAY FIXED', 'Y'), (2, 'PAY CSV', 'Y'), (3, 'PAY TAB', 'Y'), (4, 'OLD FIXED', 'N'),
                                (5, 'CONTROL ONLY', 'Y')) t(format_id, format_name, enable_flag)),
docfmt AS (SELECT * FROM (VALUES (1, 1), (2, 2), (3, 3), (4, 1), (5, 4), (6, 5), (7, 5)) t(doc, format_id))
SELECT s.file_id, s.payment_document_id, CAST(df.format_id AS BIGINT) AS format_id, f.format_name,
       COUNT(*) AS trx_lines,
       CASE WHEN df.format_id IS NULL THEN 'NO FORMAT' WHEN f.format_name IS NULL THEN 'UNKNOWN FORMAT'
            WHEN f.enable_flag <> 'Y' THEN 'DISABLED' ELSE 'OK' END AS format_status
FROM sel s LEFT JOIN docfmt df ON df.doc = s.payment_document_id LEFT JOIN fmt f ON f.format_id = df.format_id
GROUP BY 1, 2, 3, 4, 6
""",
    "format_parts": BASE + """
, docfmt AS (SELECT * FROM (VALUES (1, 1), (2, 2), (3, 3), (4, 1), (5, 4), (6, 5), (7, 5)) t(doc, format_id)),
parts AS (SELECT * FROM (VALUES (1, false, true, true, true), (2, true, true, true, true),
                                (3, false, true, false, false), (5, true, false, false, true))
          t(format_id, has_header, has_body, has_detail, has_trailer))
SELECT DISTINCT s.file_id, CAST(p.format_id AS BIGINT) AS format_id, p.has_header, p.has_body, p.has_detail,
       p.has_trailer
FROM sel s JOIN docfmt df ON df.doc = s.payment_document_id JOIN parts p ON p.format_id = df.format_id
""",
    "seq_body": LINES + "SELECT file_id, check_id, seq1, seq3 FROM body3",
    "seq_detail": LINES + "SELECT file_id, check_id, invoice_id, seq1, seq2, seq3 FROM det",
    "line_numbers": LINES + "SELECT file_id, part, seq1, seq2, line_no FROM numbered",
    "bank_file_lines": LINES + "SELECT file_id, part, line_no, value FROM numbered",
    "fixed_width_lines": LINES + """
SELECT file_id, part, line_no, value FROM numbered WHERE file_id IN ('run-1-1', 'run-1-4')""",
    "delimited_lines": LINES + """
SELECT file_id, part, line_no, value FROM numbered WHERE file_id IN ('run-1-2', 'run-1-3')""",
    "written_lines": LINES + "SELECT file_id, value || CASE WHEN file_id = 'run-1-2' THEN chr(13) ELSE '' END AS value FROM numbered",
    "bound_fields": BASE + """
, tot3 AS (SELECT file_id, COUNT(*) AS n, SUM(amount) AS total FROM sel WHERE payment_document_id = 3 GROUP BY file_id),
det3 AS (SELECT s.file_id, s.check_id, i.invoice_id, i.invoice_num, ip.line_number,
                row_number() OVER (PARTITION BY s.file_id, s.check_id ORDER BY ip.line_number, ip.invoice_id, ip.supplier_ref, ip.amount_paid) AS seq2,
                MIN(ip.line_number) OVER (PARTITION BY s.check_id, i.invoice_id) AS first_line
         FROM sel s JOIN inv_pay ip ON ip.check_id = s.check_id JOIN invoices i ON i.invoice_id = ip.invoice_id WHERE s.payment_document_id = 3),
n3 AS (SELECT check_id, COUNT(*) AS n FROM det3 GROUP BY check_id),
body3 AS (SELECT s.*, row_number() OVER w - 1 + COALESCE(SUM(COALESCE(n3.n, 0)) OVER (PARTITION BY s.file_id ORDER BY s.check_number, s.check_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seq3
          FROM sel s LEFT JOIN n3 ON n3.check_id = s.check_id WHERE s.payment_document_id = 3 WINDOW w AS (PARTITION BY s.file_id ORDER BY s.check_number, s.check_id))
SELECT s.file_id, 'BODY' AS part, '3' || chr(9) || CAST(t.n AS VARCHAR) || chr(9) || printf('%.2f', s.amount) || chr(9)
       || CAST(s.check_number AS VARCHAR) || chr(9) || 'range' || chr(9) || 'L' || CAST(CAST(s.seq3 AS BIGINT) AS VARCHAR) AS value
FROM body3 s JOIN tot3 t ON t.file_id = s.file_id
UNION ALL
SELECT d.file_id, 'DETAIL', d.invoice_num || chr(9) || CAST(CAST(d.first_line + 10 * (b.seq3 + d.seq2 - 1) AS BIGINT) AS VARCHAR)
FROM det3 d JOIN body3 b ON b.check_id = d.check_id
UNION ALL
SELECT file_id, 'TRAILER', printf('%.2f', total) FROM tot3
""",
    "layout_variants": BASE + """
, b AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY check_number, check_id) AS n FROM sel WHERE payment_document_id = 3),
firsts AS (SELECT s.check_id, first(i.invoice_num ORDER BY ip.line_number, i.invoice_num) AS num FROM sel s JOIN inv_pay ip ON ip.check_id = s.check_id
           JOIN invoices i ON i.invoice_id = ip.invoice_id GROUP BY s.check_id)
SELECT b.file_id, 'BODY' AS part, CAST(b.n AS BIGINT) AS line_no,
       COALESCE(f.num, '') || chr(9) || rpad(strftime(check_date, '%B'), 9, ' ') || ' ' || strftime(check_date, '%d, %Y') || chr(9)
       || CAST(quarter(check_date) AS VARCHAR) || '/' || strftime(check_date, '%j') || chr(9) || '+' || format('{:,.2f}', amount) || chr(9)
       || '$' || format('{:,.2f}', amount) || chr(9) || '10' || CAST(check_number AS VARCHAR) AS value
FROM b LEFT JOIN firsts f ON f.check_id = b.check_id
UNION ALL SELECT file_id, 'HEADER', CAST(1 AS BIGINT), 'H' FROM sel WHERE payment_document_id = 2 GROUP BY file_id
UNION ALL SELECT file_id, 'TRAILER', CAST(2 AS BIGINT), CAST(COUNT(*) AS VARCHAR) FROM sel WHERE payment_document_id = 2 GROUP BY file_id
""",
    "migrated_lines": BASE + """
, b AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY check_number, check_id) AS n FROM sel WHERE payment_document_id IN (1, 3))
SELECT file_id, 'BODY' AS part, CAST(n AS BIGINT) AS line_no,
       CASE WHEN payment_document_id = 1
            THEN 'P' || chr(9) || 'Q   ' || lpad(CAST(check_number AS VARCHAR), 10, '0') || lpad(CAST(n AS VARCHAR), 7, '0')
            ELSE 'R' || chr(9) || vendor_name || chr(9) || '   x' END AS value
FROM b
UNION ALL
SELECT file_id, 'TRAILER', CAST(COUNT(*) + 1 AS BIGINT), lpad(CAST(COUNT(*) AS VARCHAR), 8, '0') FROM b WHERE payment_document_id = 1 GROUP BY file_id
""",
    "dq_dynamic_values": BASE + """
SELECT 'DQ-10 dynamic value missing' AS check_name, file_id || '/' || CAST(check_id AS VARCHAR) AS key,
       'definition 921: SELECT check_id, vendor_name AS value FROM selection WHERE amount > 100000' AS detail
FROM sel WHERE payment_document_id IN (1, 4) AND amount <= 100000
UNION ALL
SELECT 'DQ-10 dynamic value missing', file_id || '/' || CAST(check_id AS VARCHAR),
       'definition 922: SELECT check_id, vendor_name AS value FROM selection'
FROM sel WHERE payment_document_id IN (1, 4)
""",
    "dq_dynamic_values_relational": BASE + """
SELECT 'DQ-10 dynamic value missing' AS check_name, file_id || '/' || CAST(check_id AS VARCHAR) AS key,
       'definition 921: SELECT check_id, vendor_name AS value FROM selection WHERE amount > 100000' AS detail
FROM sel WHERE payment_document_id IN (1, 4) AND amount <= 100000
UNION ALL
SELECT 'DQ-10 dynamic value missing', file_id || '/' || CAST(check_id AS VARCHAR),
       'definition 922: SELECT check_id, vendor_name AS value FROM selection'
FROM sel WHERE payment_document_id IN (1, 4)
""",
    "register_text": REGISTER_TEXT + "SELECT file_id, CAST(line_no AS BIGINT) AS line_no, value FROM reg",
    "register_text_es": register_text_sql("ESA") + "SELECT file_id, CAST(line_no AS BIGINT) AS line_no, value FROM reg",
    "mark_printed": with_(ENTITIES, FINAL1) + """
SELECT check_id, 'PRINTED' AS status, 'final-1' AS run_id, TIMESTAMP '2014-04-25 09:09:17' AS event_ts, 'SENT' AS attribute_category FROM sel1
""",
    "current_status": with_(ENTITIES, FINAL1) + """
SELECT c.check_id, CASE WHEN s.check_id IS NOT NULL THEN 'PRINTED' ELSE c.attribute14 END AS status_code
FROM checks c LEFT JOIN sel1 s ON s.check_id = c.check_id
""",
    "unsent_after_final": with_(ENTITIES, FINAL1, selection_sql(statuses=("NEW",), run_id="final-2")) + """
SELECT file_id, check_id, doc_sequence_value, check_number, amount, check_date, vendor_name, send_status,
       vendor_site_code
FROM sel WHERE check_id NOT IN (SELECT check_id FROM sel1)
""",
    "rows_updated_by_file": with_(ENTITIES, FINAL1) + """
SELECT k.process_type, s.file_id, CASE WHEN k.process_type = 'FINAL' THEN COUNT(*) ELSE 0 END AS rows_updated
FROM sel1 s, (VALUES ('FINAL'), ('DRAFT')) k(process_type) GROUP BY 1, 2
""",
    "status_by_metadata": with_(ENTITIES, selection_sql(statuses=("NEW", "PRINTED"))) + """
SELECT file_id, check_id, send_code FROM (
  SELECT s.file_id, s.check_id, CASE WHEN c.attribute_category = 'STANDARD' THEN COALESCE(c.attribute14, 'NEW') ELSE 'NEW' END AS send_code
  FROM sel s JOIN checks c ON c.check_id = s.check_id) t
WHERE send_code = 'NEW'
""",
    "flex_sql_default": with_(ENTITIES) + """
SELECT check_id, CASE WHEN attribute_category = 'COURIER' THEN COALESCE(attribute5, 'EARLY') END AS delivery_window FROM checks
""",
    "dq_payments": with_(ENTITIES) + """
SELECT 'DQ-02 missing parameter' AS check_name, 'run-1-' || CAST(payment_document_id AS VARCHAR) AS key, 'end_ts' AS detail FROM docs
UNION ALL SELECT 'DQ-06 amount outside domain', CAST(check_id AS VARCHAR), CAST(amount AS VARCHAR) FROM checks
          WHERE amount <= 0 OR abs(amount) >= 100000
UNION ALL SELECT 'DQ-07 required value missing', CAST(check_id AS VARCHAR), 'attribute2' FROM checks WHERE attribute2 IS NULL
UNION ALL SELECT 'DQ-07 required value missing', CAST(check_id AS VARCHAR), 'attribute14' FROM checks WHERE attribute14 IS NULL
""",
    "dq_segment_rules": with_(ENTITIES) + """
, v AS (
  SELECT check_id, 'Ledger Branch' AS segment, attribute2 AS value FROM checks WHERE attribute_category = 'STANDARD'
  UNION ALL SELECT check_id, 'Value Days', attribute8 FROM checks WHERE attribute_category = 'STANDARD'
  UNION ALL SELECT check_id, 'Send Mark', attribute14 FROM checks WHERE attribute_category = 'STANDARD'
  UNION ALL SELECT check_id, 'Waybill', attribute14 FROM checks WHERE attribute_category = 'COURIER'
  UNION ALL SELECT check_id, 'Parcel Grams', attribute8 FROM checks WHERE attribute_category = 'COURIER'
  UNION ALL SELECT check_id, 'Delivery Window', COALESCE(attribute5, 'ANYTIME') FROM checks WHERE attribute_category = 'COURIER'),
n AS (SELECT *, TRY_CAST(value AS DECIMAL(38,10)) AS x FROM v WHERE segment IN ('Value Days', 'Parcel Grams') AND value IS NOT NULL),
found AS (
  SELECT 'DQ-05 value outside value set' AS check_name, check_id, segment || '=' || value AS detail FROM v
  WHERE (segment = 'Ledger Branch' AND value NOT IN ('B0', 'B1', 'B2', 'B3', 'B4', 'B5', 'B6', 'B7'))
     OR (segment = 'Delivery Window' AND value NOT IN ('EARLY', 'LATE', 'NIGHT')) OR (segment = 'Send Mark' AND value NOT IN ('NEW', 'PRINTED'))
  UNION ALL SELECT 'DQ-06 not a number', check_id, segment || '=' || value FROM n WHERE x IS NULL
  UNION ALL SELECT 'DQ-06 below minimum', check_id, segment || '=' || value FROM n WHERE x < CASE segment WHEN 'Value Days' THEN 0 ELSE 50 END
  UNION ALL SELECT 'DQ-06 above maximum', check_id, segment || '=' || value FROM n WHERE x > CASE segment WHEN 'Value Days' THEN 30 ELSE 950.5 END
  UNION ALL SELECT 'DQ-06 too many decimals', check_id, segment || '=' || value FROM n WHERE CASE segment WHEN 'Value Days' THEN x <> round(x, 0) ELSE x <> round(x, 1) END
  UNION ALL SELECT 'DQ-06 too long', check_id, segment || '=' || value FROM v
  WHERE length(value) > CASE segment WHEN 'Ledger Branch' THEN 2 WHEN 'Value Days' THEN 2 WHEN 'Waybill' THEN 5 WHEN 'Parcel Grams' THEN 6 ELSE 999 END
  UNION ALL SELECT 'DQ-07 required value missing', check_id, segment FROM v WHERE value IS NULL AND segment IN ('Ledger Branch', 'Waybill'))
SELECT check_name, CAST(check_id AS VARCHAR) AS key, detail FROM found
""",
    "second_final_run": with_(ENTITIES, FINAL1, selection_sql(statuses=("NEW",), run_id="final-2")) + """
SELECT check_id, 'PRINTED' AS status, 'final-2' AS run_id
FROM sel WHERE payment_document_id IN (1, 2, 3, 4)
  AND check_id NOT IN (SELECT check_id FROM sel1 WHERE payment_document_id IN (1, 2, 3, 4))
""",
    "crashed_final_run": with_(ENTITIES, FINAL1, selection_sql(statuses=("NEW",), run_id="final-2")) + """
SELECT check_id, 'PRINTED' AS status, 'final-1' AS run_id FROM sel1 WHERE payment_document_id IN (1, 2, 3, 4)
UNION ALL
SELECT check_id, 'PRINTED', 'final-2' FROM sel WHERE payment_document_id IN (1, 2, 3, 4)
  AND check_id NOT IN (SELECT check_id FROM sel1 WHERE payment_document_id IN (1, 2, 3, 4))
""",
    "compacted_status": with_(ENTITIES, FINAL1, selection_sql(statuses=("NEW",), run_id="final-2")) + """
, sent AS (SELECT check_id FROM sel1 WHERE payment_document_id IN (1, 2, 3, 4)
           UNION SELECT check_id FROM sel WHERE payment_document_id IN (1, 2, 3, 4))
SELECT c.check_id, CASE WHEN s.check_id IS NOT NULL THEN 'PRINTED' ELSE c.attribute14 END AS status_code
FROM checks c LEFT JOIN sent s ON s.check_id = c.check_id
""",
    "unlock": BASE + """
SELECT check_id, 'NEW' AS status, 'unlock-1' AS run_id, TIMESTAMP '2014-04-25 09:09:17' AS event_ts FROM sel
""",
    "unlock_outcome": BASE + ", " + GRANTS.strip() + """
SELECT user_id, n AS n_grants, CASE WHEN n = 1 THEN '0' ELSE '1' END AS retcode,
       CASE WHEN n = 0 THEN 'User Does not have Access'
            WHEN n > 1 THEN 'Contac Payables Setup Administator for Help' END AS errbuf,
       CAST(CASE WHEN n = 1 THEN (SELECT COUNT(*) FROM sel) ELSE 0 END AS BIGINT) AS rows_updated
FROM ng
""",
    "flex_project": with_(ENTITIES) + """
SELECT check_id, attribute_category,
  CASE WHEN attribute_category = 'STANDARD' THEN attribute2 END AS ledger_branch,
  CASE WHEN attribute_category = 'STANDARD' THEN attribute8 END AS value_days,
  CASE WHEN attribute_category = 'STANDARD' THEN attribute14 END AS send_mark,
  CASE WHEN attribute_category = 'COURIER' THEN attribute14 END AS waybill,
  CASE WHEN attribute_category = 'COURIER' THEN attribute8 END AS parcel_grams,
  CASE WHEN attribute_category = 'COURIER' THEN attribute3 END AS doorstep,
  CASE WHEN attribute_category = 'COURIER' THEN COALESCE(attribute5, 'ANYTIME') END AS delivery_window
FROM checks
""",
    "flex_unpivot": with_(ENTITIES) + """
, u AS (
  SELECT check_id, 'STANDARD' AS context_code, 'Ledger Branch' AS segment, 'ATTRIBUTE2' AS application_column_name, attribute2 AS value,
         'BRANCHES' AS value_set_name FROM checks WHERE attribute_category = 'STANDARD'
  UNION ALL SELECT check_id, 'STANDARD', 'Value Days', 'ATTRIBUTE8', attribute8, 'DAY_COUNT' FROM checks WHERE attribute_category = 'STANDARD'
  UNION ALL SELECT check_id, 'STANDARD', 'Send Mark', 'ATTRIBUTE14', attribute14, 'XX_EFT_STATUS_CHECK' FROM checks WHERE attribute_category = 'STANDARD'
  UNION ALL SELECT check_id, 'COURIER', 'Waybill', 'ATTRIBUTE14', attribute14, 'SHORT_CODES' FROM checks WHERE attribute_category = 'COURIER'
  UNION ALL SELECT check_id, 'COURIER', 'Parcel Grams', 'ATTRIBUTE8', attribute8, 'GRAMS' FROM checks WHERE attribute_category = 'COURIER'
  UNION ALL SELECT check_id, 'COURIER', 'Doorstep', 'ATTRIBUTE3', attribute3, NULL FROM checks WHERE attribute_category = 'COURIER'
  UNION ALL SELECT check_id, 'COURIER', 'Delivery Window', 'ATTRIBUTE5', attribute5, 'WINDOWS' FROM checks WHERE attribute_category = 'COURIER')
SELECT * FROM u WHERE value IS NOT NULL
""",
    "dq_flex_domain": with_(ENTITIES) + """
SELECT 'DQ-05 value outside value set' AS check_name, CAST(check_id AS VARCHAR) AS key, 'Delivery Window=' || COALESCE(attribute5, 'ANYTIME') AS detail
FROM checks WHERE attribute_category = 'COURIER' AND COALESCE(attribute5, 'ANYTIME') NOT IN ('EARLY', 'LATE', 'NIGHT')
UNION ALL
SELECT 'DQ-05 value outside value set', CAST(check_id AS VARCHAR), 'Ledger Branch=' || attribute2
FROM checks WHERE attribute_category = 'STANDARD' AND attribute2 NOT IN ('B0', 'B1', 'B2', 'B3', 'B4', 'B5', 'B6', 'B7')
""",
    "dq_requests": BASE + """
SELECT 'DQ-01 empty selection' AS check_name, 'run-1-' || CAST(d.payment_document_id AS VARCHAR) AS key,
       'Warning : Parameters did not retrieve any data' AS detail
FROM docs d WHERE d.payment_document_id NOT IN (SELECT payment_document_id FROM sel)
UNION ALL
SELECT DISTINCT 'DQ-03 format not usable', file_id, 'format 4' FROM sel WHERE payment_document_id = 5
""",
    "ingest_rejects": """
WITH r AS (
  SELECT *, event_id // 1000 AS thousand, row_number() OVER (PARTITION BY event_type, event_id // 1000 ORDER BY event_id) AS record_no,
         CASE WHEN user_id % 40 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS u,
         CASE WHEN event_id % 50 <> 0 THEN CASE WHEN event_type = 'error' THEN 'n/a' ELSE printf('%.2f', value) END END AS v,
         event_id % 60 = 7 AS more
  FROM events),
c AS (
  SELECT *, CAST(event_id AS VARCHAR) || ',' || u || COALESCE(',' || v, '') || CASE WHEN more THEN ',more' ELSE '' END AS raw_record,
         -- a line without its value but with the other column has that one in the value's place
         CASE WHEN v IS NULL AND more THEN 'more' ELSE v END AS third, v IS NOT NULL AND more AS many, v IS NULL AND NOT more AS few
  FROM r),
bad AS (
  SELECT *, NULL AS column_name, 'too few columns' AS reason FROM c WHERE few
  UNION ALL SELECT *, NULL, 'too many columns' FROM c WHERE many
  UNION ALL SELECT *, 'value', '''' || third || ''' is not a double' FROM c WHERE third IN ('n/a', 'more')
  UNION ALL SELECT *, 'user_id', 'required value missing' FROM c WHERE u = '' AND NOT few)
SELECT event_type, CAST(thousand AS BIGINT) AS thousand, record_no, 'BAD' AS kind, column_name, reason, raw_record FROM bad
UNION ALL
SELECT event_type, CAST(thousand AS BIGINT), record_no, 'DISCARDED', NULL, 'not value >= 2', raw_record FROM c
WHERE NOT few AND NOT many AND u <> '' AND third NOT IN ('n/a', 'more') AND NOT (CAST(third AS DOUBLE) >= 2)
""",
    "landing_stream": "SELECT event_id, user_id, value FROM events WHERE event_type <> 'error'",
    "delivered_files": LINES + """
, named AS (SELECT 'run-1-' || CAST(n.n_nationkey + 1 AS VARCHAR) AS file_id,
                   regexp_replace('OU ' || n.n_name || '_' || 'DOC ' || n.n_name || '_' || '2014-APR-25_09AM-09-17', '[^A-Za-z0-9_-]', '', 'g')
                   || CASE n.n_nationkey WHEN 1 THEN '.csv' WHEN 2 THEN '.tsv' ELSE '.txt' END AS file_name FROM nation n)
SELECT f.file_name, l.line_no, l.value || CASE WHEN l.file_id = 'run-1-2' THEN chr(13) ELSE '' END AS value
FROM numbered l JOIN named f ON f.file_id = l.file_id
""",
    "main_register": REGISTER_TEXT + "SELECT file_id, value FROM reg",
    "main_outcome": BASE + """
, fmt AS (SELECT * FROM (VALUES (1, 'txt'), (2, 'csv'), (3, 'tsv'), (4, 'txt'), (5, 'ctl')) t(format_id, ext)),
docfmt AS (SELECT * FROM (VALUES (1, 1), (2, 2), (3, 3), (4, 1), (5, 4), (6, 5), (7, 5)) t(doc, format_id)),
t AS (SELECT payment_document_id, COUNT(*) AS n, SUM(amount) AS total FROM sel GROUP BY 1)
SELECT 'run-1-' || CAST(d.payment_document_id AS VARCHAR) AS file_id,
       CASE WHEN t.n IS NULL OR d.payment_document_id = 5 THEN '1' ELSE '0' END AS retcode,
       CASE WHEN t.n IS NULL THEN 'DQ-01 empty selection' WHEN d.payment_document_id = 5 THEN 'DQ-03 format not usable' END AS errbuf,
       COALESCE(t.n, 0) AS trx_lines, CAST(t.total AS DECIMAL(38,2)) AS sum_trans,
       regexp_replace('OU ' || n.n_name || '_' || 'DOC ' || n.n_name || '_' || '2014-APR-25_09AM-09-17', '[^A-Za-z0-9_-]', '', 'g') AS file_name,
       f.ext AS file_extension
FROM docs d JOIN nation n ON n.n_nationkey + 1 = d.payment_document_id LEFT JOIN t ON t.payment_document_id = d.payment_document_id
LEFT JOIN docfmt df ON df.doc = d.payment_document_id LEFT JOIN fmt f ON f.format_id = df.format_id
""",
    "ingest_file_status": """
SELECT event_type, COUNT(*) FILTER (WHERE event_type <> 'error') AS n_good,
       COUNT(*) FILTER (WHERE event_type = 'error') AS n_bad,
       CASE WHEN COUNT(*) FILTER (WHERE event_type = 'error') > 0 THEN 'BATCH ERROR' ELSE 'OK' END AS status
FROM events GROUP BY event_type
""",
    "legacy_register": with_(ENTITIES) + f"""
, g1 AS (
  SELECT 'run-1-' || CAST(c.payment_document_id AS VARCHAR) AS file_id, c.*, s.vendor_name, s.vendor_site_code,
         CASE c.status_lookup_code WHEN 'NEGOTIABLE' THEN 'Negotiable' WHEN 'VOIDED' THEN 'Voided' END AS check_status
  FROM checks c JOIN docs d ON d.payment_document_id = c.payment_document_id
  JOIN sites s ON s.vendor_site_id = c.vendor_site_id
  WHERE CAST(c.check_date AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
    AND c.amount >= 0 AND c.amount <= 99999999.99
    AND c.payment_method_code = 'EFT' AND COALESCE(c.attribute14, 'NEW') = 'NEW' AND c.void_date IS NULL),
head AS (SELECT g.file_id, n.n_name, r.r_name, COUNT(*) AS n, SUM(g.amount) AS total
         FROM g1 g JOIN nation n ON n.n_nationkey + 1 = g.payment_document_id
         JOIN region r ON r.r_regionkey = n.n_regionkey GROUP BY 1, 2, 3),
reg AS (
  SELECT file_id, 1 AS line_no, 'Registro de Pagos ' AS value FROM head
  UNION ALL SELECT file_id, 2, 'BANK              : ' || r_name || ' BANK' FROM head
  UNION ALL SELECT file_id, 3, 'BANK ACCOUNT NAME : ' || n_name || ' OPERATING' FROM head
  UNION ALL SELECT file_id, 4, 'PAYMENT DOCUMENT  : DOC ' || n_name FROM head
  UNION ALL SELECT file_id, 5, '  ' FROM head
  UNION ALL SELECT file_id, 6, '  ' || rpad('DOC SEQUENCE', 12, ' ') || '  ' || rpad('CHECK DATE', 15, ' ') || '  '
      || rpad('SUPPLIER NAME', 50, ' ') || '  ' || rpad('VENDOR SITE', 15, ' ') || '  ' || lpad('AMOUNT', 15, ' ')
      || '  ' || rpad('CHECK STATUS', 15, ' ') || '  ' || rpad('SEND STATUS', 15, ' ') FROM head
  UNION ALL SELECT file_id, 6 + row_number() OVER (PARTITION BY file_id ORDER BY doc_sequence_value, check_id),
      '  ' || lpad(CAST(COALESCE(doc_sequence_value, 0) AS VARCHAR), 12, ' ') || '  '
      || rpad(strftime(check_date, '%d/%m/%Y'), 15, ' ') || '  ' || rpad(COALESCE(vendor_name, ' '), 50, ' ')
      || '  ' || rpad(COALESCE(vendor_site_code, ' '), 15, ' ') || '  ' || {_money('amount')}
      || '  ' || rpad(COALESCE(check_status, ' '), 15, ' ') || '  ' || rpad(COALESCE(attribute14, ' '), 15, ' ')
  FROM g1
  UNION ALL SELECT file_id, 7 + n, repeat('-', 35) FROM head
  UNION ALL SELECT file_id, 8 + n, 'REPORT TOTAL     :' || {_money('total')} FROM head
  UNION ALL SELECT file_id, 9 + n, 'REPORT COUNT     :' || lpad(CAST(n AS VARCHAR), 15, ' ') FROM head)
SELECT file_id, CAST(line_no AS BIGINT) AS line_no, value FROM reg
""",
    "legacy_register_batch": with_(ENTITIES) + f"""
, batches AS (SELECT DISTINCT payment_document_id, checkrun_id FROM checks
              WHERE payment_type_flag = 'A' AND CAST(check_date AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'),
names AS (SELECT checkrun_id, arg_max(checkrun_name, check_id) AS checkrun_name FROM checks
          WHERE payment_type_flag = 'A' AND checkrun_id IS NOT NULL GROUP BY checkrun_id),
g1 AS (
  SELECT 'run-1-' || CAST(c.payment_document_id AS VARCHAR) || '-' || CAST(b.checkrun_id AS VARCHAR) AS file_id,
         b.checkrun_id AS batch, c.*, s.vendor_name, s.vendor_site_code,
         CASE c.status_lookup_code WHEN 'NEGOTIABLE' THEN 'Negotiable' WHEN 'VOIDED' THEN 'Voided' END AS check_status
  FROM batches b JOIN checks c ON c.payment_document_id = b.payment_document_id AND c.checkrun_id = b.checkrun_id
  JOIN sites s ON s.vendor_site_id = c.vendor_site_id
  WHERE CAST(c.check_date AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
    AND c.amount >= 0 AND c.amount <= 99999999.99
    AND c.payment_method_code = 'EFT' AND COALESCE(c.attribute14, 'NEW') = 'NEW' AND c.void_date IS NULL),
head AS (SELECT g.file_id, n.n_name, r.r_name, nm.checkrun_name, COUNT(*) AS n, SUM(g.amount) AS total
         FROM g1 g JOIN nation n ON n.n_nationkey + 1 = g.payment_document_id
         JOIN region r ON r.r_regionkey = n.n_regionkey LEFT JOIN names nm ON nm.checkrun_id = g.batch
         GROUP BY 1, 2, 3, 4),
reg AS (
  SELECT file_id, 1 AS line_no, 'Registro de Pagos ' AS value FROM head
  UNION ALL SELECT file_id, 2, 'BANK              : ' || r_name || ' BANK' FROM head
  UNION ALL SELECT file_id, 3, 'BANK ACCOUNT NAME : ' || n_name || ' OPERATING' FROM head
  UNION ALL SELECT file_id, 4, 'PAYMENT DOCUMENT  : DOC ' || n_name FROM head
  UNION ALL SELECT file_id, 5, 'CHECKRUN NAME     : ' || COALESCE(checkrun_name, '') FROM head
  UNION ALL SELECT file_id, 6, '  ' FROM head
  UNION ALL SELECT file_id, 7, '  ' || rpad('DOC SEQUENCE', 12, ' ') || '  ' || rpad('CHECK DATE', 15, ' ') || '  '
      || rpad('SUPPLIER NAME', 50, ' ') || '  ' || rpad('VENDOR SITE', 15, ' ') || '  ' || lpad('AMOUNT', 15, ' ')
      || '  ' || rpad('CHECK STATUS', 15, ' ') || '  ' || rpad('SEND STATUS', 15, ' ') FROM head
  UNION ALL SELECT file_id, 7 + row_number() OVER (PARTITION BY file_id ORDER BY doc_sequence_value, check_id),
      '  ' || lpad(CAST(COALESCE(doc_sequence_value, 0) AS VARCHAR), 12, ' ') || '  '
      || rpad(strftime(check_date, '%d/%m/%Y'), 15, ' ') || '  ' || rpad(COALESCE(vendor_name, ' '), 50, ' ')
      || '  ' || rpad(COALESCE(vendor_site_code, ' '), 15, ' ') || '  ' || {_money('amount')}
      || '  ' || rpad(COALESCE(check_status, ' '), 15, ' ') || '  ' || rpad(COALESCE(attribute14, ' '), 15, ' ')
  FROM g1
  UNION ALL SELECT file_id, 8 + n, repeat('-', 35) FROM head
  UNION ALL SELECT file_id, 9 + n, 'REPORT TOTAL     :' || {_money('total')} FROM head
  UNION ALL SELECT file_id, 10 + n, 'REPORT COUNT     :' || lpad(CAST(n AS VARCHAR), 15, ' ') FROM head)
SELECT file_id, CAST(line_no AS BIGINT) AS line_no, value FROM reg
""",
    "dependent_lists": with_(ENTITIES) + """
, b AS (SELECT payment_document_id, arg_max(checkrun_id, check_id) AS checkrun_id,
               arg_max(checkrun_name, check_id) AS checkrun_name
        FROM checks WHERE payment_type_flag = 'A'
          AND CAST(check_date AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
        GROUP BY payment_document_id)
SELECT CAST(n.n_nationkey AS BIGINT) AS org_id, CAST(n.n_nationkey AS BIGINT) AS bank_account_id,
       n.n_name || ' OPERATING' AS bank_account_name, lpad(CAST(n.n_nationkey AS VARCHAR), 10, '0') AS bank_account_num,
       CAST(1 AS BIGINT) AS account_pos, d.payment_document_id, d.payment_document_name, b.checkrun_id, b.checkrun_name
FROM nation n JOIN docs d ON d.bank_account_id = n.n_nationkey JOIN b ON b.payment_document_id = d.payment_document_id
""",
    "check_amount_lookup": with_(ENTITIES) + """
SELECT ip.check_id, ip.invoice_id, ip.line_number, ip.supplier_ref,
       COALESCE(c.amount, CAST(0 AS DECIMAL(18,2))) AS check_amount, COALESCE(i.invoice_num, '-1') AS invoice_num
FROM inv_pay ip LEFT JOIN checks c ON c.check_id = ip.check_id LEFT JOIN invoices i ON i.invoice_id = ip.invoice_id
""",
    "latest_batch_name": with_(ENTITIES) + """
SELECT checkrun_id, arg_max(checkrun_name, check_id) AS checkrun_name, MAX(check_id) AS latest_check_id
FROM checks WHERE checkrun_id IS NOT NULL AND payment_type_flag = 'A' GROUP BY checkrun_id
""",
}
