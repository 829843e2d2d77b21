"""DuckDB oracle SQL, one statement per registered query (same keys, same column names).

The SQL recomputes each result independently from the parquet tables: the
JSON documents' features come from the typed columns they were printed from,
not from parsing the JSON, so the Spark parse path is checked end to end.
"""

from __future__ import annotations

from .oracle_views import INVOICE_LINES, INVOICE_LINES_NULLS, INVOICE_TEXT, ITEM_ORDER, ORDER_DOCS, with_

SQL: dict[str, str] = {}

# Fixed values, written here a second time so that a wrong word or pattern in the library is seen: the keyword groups of the
# general category in rule order, and the field patterns of plain documents (D6, D7 over texts that no column holds).
GENERAL_CATEGORY_WORDS = {
    "Transport/Fahrzeuge": "auto|leasing|car|vehicle|transportation|ground transportation",
    "Immobilien/Miete": "lease|rent|real estate|base rent|store management",
    "Bau/Handwerk": "construction|contractor|site clean|building",
    "Personal/HR": "labor|contingent|human resources|employee|staffing",
    "Reisen/Bewirtung": "travel|entertainment|hotel|flight|meal",
    "Marketing/Design": "artworking|typesetting|production|packaging design|smap|prototype",
    "Events/Promotion": "event|promotion|trade show|talent|artists",
    "Sonstige Dienstleistungen": "services|corporate services",
}
INVOICE_NUMBER_PATTERNS = ["invoice\\s*(?:no|number|#)[:\\s]*(\\d+)", "invoice[:\\s]*(\\d+)", "inv\\s*(?:no|#)[:\\s]*(\\d+)"]
DATE_PATTERN = "(\\d{1,2}[/-]\\d{1,2}[/-]\\d{2,4})"
SELLER_PATTERN, CLIENT_PATTERN = "seller[:\\s]*([^\\n]+)", "client[:\\s]*([^\\n]+)"
PRICE_PATTERN, QUANTITY_PATTERN = "(\\d+[.,]\\d{2})", "(\\d+[.,]?\\d*)\\s*(?:each|pcs?|x)"
TAX_PATTERN = "(?:tax|vat)[:\\s]*\\$?\\s*(\\d+[.,]\\d{2})"
DISCOUNT_PATTERN = "discount[:\\s]*\\$?\\s*(\\d+[.,]\\d{2})"
TOTAL_PATTERN = "(?:total|gross)[:\\s]*\\$?\\s*(\\d+[.,]\\d{2})"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def parse_number_sql(x: str) -> str:
    return f"coalesce(try_cast(replace(regexp_replace({x}, '[^0-9.,\\-]', '', 'g'), ',', '.') AS DOUBLE), 0.0)"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def clean_text_sql(x: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9\\s]', ' ', 'g'), "
            f"'\\s+', ' ', 'g'))")


def first_match_sql(x: str, patterns) -> str:
    hits = ", ".join(f"nullif(regexp_extract({x}, {q('(?i)' + p)}, 1), '')" for p in patterns)
    return f"coalesce({hits}, '')"


def general_category_sql(x: str) -> str:
    whens = [f"WHEN regexp_matches(lower(coalesce({x}, '')), {q(words)}) THEN {q(cat)}" for cat, words in GENERAL_CATEGORY_WORDS.items()]
    return "CASE " + " ".join(whens) + " ELSE 'Sonstiges' END"


DATE_SHAPE_SQL = "'^(\\d{1,2}[/.\\-]\\d{1,2}[/.\\-]\\d{4}|\\d{4}-\\d{1,2}-\\d{1,2})$'"
DATE_FORMATS_SQL = "['%m/%d/%Y', '%d/%m/%Y', '%Y-%m-%d', '%m-%d-%Y', '%d.%m.%Y']"


def parse_date_sql(x: str) -> str:
    t = strip_sql(x)
    return (f"CASE WHEN regexp_matches({t}, {DATE_SHAPE_SQL}) "
            f"THEN CAST(try_strptime({t}, {DATE_FORMATS_SQL}) AS DATE) END")


# ---------------------------------------------------------------------------------------------------
# C: features of the JSON documents, from the typed order columns


def _feature_exprs(broken: bool) -> dict[str, str]:
    bad = "(o_orderkey % 23 = 0)" if broken else "FALSE"
    nodate = "(o_orderkey % 11 = 0)" if broken else "FALSE"
    no_d = f"({bad} OR {nodate})"
    return {
        "seller_name": f"CASE WHEN {bad} THEN '' ELSE coalesce(s_name, '') END",
        "client_name": f"CASE WHEN {bad} THEN '' ELSE coalesce(c_name, '') END",
        "invoice_number": f"CASE WHEN {bad} THEN '' ELSE CAST(o_orderkey AS VARCHAR) END",
        "item_descriptions": f"CASE WHEN {bad} THEN '' ELSE descs END",
        "num_items": f"CAST(CASE WHEN {bad} THEN 0 ELSE n_items END AS INTEGER)",
        "combined_text": f"CASE WHEN {bad} THEN '  ' ELSE coalesce(s_name, '') || ' ' || coalesce(c_name, '') || ' ' "
                         f"|| descs END",
        "ocr_text": "''",
        "total_quantity": f"round(CASE WHEN {bad} THEN 0.0 ELSE CAST(qty AS DOUBLE) END, 6)",
        "total_items_price": f"round(CASE WHEN {bad} THEN 0.0 ELSE CAST(price_dec AS DOUBLE) END, 6)",
        "avg_item_price": f"round(CASE WHEN {bad} OR n_items = 0 THEN 0.0 ELSE CAST(price_dec AS DOUBLE) / n_items "
                          f"END, 6)",
        "tax": "round(tax, 6)",
        "discount": "round(discount, 6)",
        "total": "round(total, 6)",
        "tax_rate": "round(CASE WHEN total > 0 THEN tax / total ELSE 0.0 END, 6)",
        "discount_rate": "round(CASE WHEN total > 0 THEN discount / total ELSE 0.0 END, 6)",
        "invoice_year": f"CAST(CASE WHEN {no_d} THEN 0 ELSE year(o_orderdate) END AS INTEGER)",
        "invoice_month": f"CAST(CASE WHEN {no_d} THEN 0 ELSE month(o_orderdate) END AS INTEGER)",
        "invoice_day": f"CAST(CASE WHEN {no_d} THEN 0 ELSE day(o_orderdate) END AS INTEGER)",
        "invoice_weekday": f"CAST(CASE WHEN {no_d} THEN 0 ELSE isodow(o_orderdate) - 1 END AS INTEGER)",
        "invoice_quarter": f"CAST(CASE WHEN {no_d} THEN 0 ELSE quarter(o_orderdate) END AS INTEGER)",
        "days_until_due": f"CAST(CASE WHEN {no_d} THEN 0 ELSE 30 END AS INTEGER)",
        "file_name": "'inv_' || CAST(o_orderkey AS VARCHAR) || '.png'",
    }


def _features_sql(broken: bool, cols=None) -> str:
    bad = "(o_orderkey % 23 = 0)" if broken else "FALSE"
    odd = "(o_orderkey % 7 = 0)" if broken else "FALSE"
    ex = _feature_exprs(broken)
    cols = cols or list(ex)
    select = ",\n  ".join(f"{ex[c]} AS {c}" for c in cols)
    return with_(ORDER_DOCS, f"""vals AS (
  SELECT *,
    CASE WHEN {bad} THEN 0.0 ELSE CAST(tax_dec AS DOUBLE) END AS tax,
    CASE WHEN {bad} THEN 0.0 ELSE CAST(discount_dec AS DOUBLE) END AS discount,
    CASE WHEN {bad} THEN 0.0 WHEN {odd} AND o_totalprice >= 1000 THEN 0.0
         ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DOUBLE) END AS total
  FROM order_docs)""") + f"SELECT\n  {select}\nFROM vals"


FEATURE_ORDER = [
    "seller_name", "client_name", "invoice_number", "item_descriptions", "num_items", "combined_text", "ocr_text",
    "total_quantity", "total_items_price", "avg_item_price", "tax", "discount", "total", "tax_rate", "discount_rate",
    "invoice_year", "invoice_month", "invoice_day", "invoice_weekday", "invoice_quarter", "days_until_due",
    "file_name",
]

SQL["c5_feature_table"] = _features_sql(True, FEATURE_ORDER)
SQL["c4_all_features"] = _features_sql(False, FEATURE_ORDER)
SQL["c1_text_features"] = _features_sql(True, ["file_name", "seller_name", "client_name", "invoice_number",
                                               "item_descriptions", "num_items", "combined_text", "ocr_text"])
SQL["c2_numeric_features"] = _features_sql(True, ["file_name", "num_items", "total_quantity", "total_items_price",
                                                  "avg_item_price", "tax", "discount", "total", "tax_rate",
                                                  "discount_rate"])
SQL["c3_date_features"] = _features_sql(True, ["file_name", "invoice_year", "invoice_month", "invoice_day",
                                               "invoice_weekday", "invoice_quarter", "days_until_due"])
SQL["b14_combined_text"] = _features_sql(True, ["file_name", "combined_text"])
SQL["b15_text_column"] = _features_sql(False, ["combined_text"])

SQL["c6_items_exploded"] = """WITH items AS (
  SELECT l.l_orderkey AS k,
         CAST(row_number() OVER (PARTITION BY l.l_orderkey ORDER BY """ + ITEM_ORDER + """) - 1
              AS INTEGER) AS item_pos,
         p.p_name AS description,
         CAST(CAST(l.l_quantity AS DECIMAL(15,2)) AS VARCHAR) AS q,
         CAST(CAST(l.l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) AS pr,
         l.l_quantity AS qv,
         CAST(CAST(l.l_extendedprice AS DECIMAL(15,2)) AS DOUBLE) AS pv
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
SELECT 'inv_' || CAST(o.o_orderkey AS VARCHAR) || '.png' AS file_name, i.item_pos, i.description,
       CASE WHEN o.o_orderkey % 7 = 0 THEN replace(i.q, '.', ',') ELSE i.q END AS quantity,
       CASE WHEN o.o_orderkey % 7 = 0 THEN '$' || i.pr ELSE i.pr END AS total_price,
       round(i.qv, 6) AS quantity_value, round(i.pv, 6) AS price_value
FROM orders o LEFT JOIN items i ON o.o_orderkey = i.k AND o.o_orderkey % 23 <> 0"""

# The 15-float vector, exploded
_VEC = ["total_quantity", "total_items_price", "avg_item_price", "num_items", "tax", "discount", "total", "tax_rate",
        "discount_rate", "invoice_year", "invoice_month", "invoice_day", "invoice_weekday", "invoice_quarter",
        "days_until_due"]


def _b12() -> str:
    ex = _feature_exprs(True)
    raw = {k: v.replace("round(", "(").replace(", 6)", ")") if k in _VEC else v for k, v in ex.items()}
    cols = ", ".join(f"CAST(CAST({raw[c]} AS DOUBLE) AS FLOAT)" for c in _VEC)
    base = _features_sql(True, ["file_name"]).rsplit("SELECT\n", 1)[0]
    return base + f"""SELECT file_name, CAST(pos AS INTEGER) AS pos, round(CAST(v AS DOUBLE), 2) AS value FROM (
  SELECT 'inv_' || CAST(o_orderkey AS VARCHAR) || '.png' AS file_name, unnest(range(15)) AS pos,
         unnest([{cols}]) AS v
  FROM vals)"""


SQL["b12_numeric_vector"] = _b12()

# ---------------------------------------------------------------------------------------------------
# B: scalar functions

SQL["b1_clean_text"] = f"SELECT doc_id, {clean_text_sql('text')} AS clean FROM documents"

SQL["b2_parse_number"] = f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s,
  round({parse_number_sql('s')}, 6) AS value
FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE l_linenumber % 7
      WHEN 0 THEN '$' || price
      WHEN 1 THEN replace(price, '.', ',')
      WHEN 2 THEN price || ' EUR'
      WHEN 3 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' Liter'
      WHEN 4 THEN price || '.' || CAST(l_linenumber AS VARCHAR)
      WHEN 5 THEN '-' || price
      ELSE '' END AS s
  FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) AS price FROM lineitem))"""

_DATE_STRINGS = """date_strings AS (
  SELECT o_orderkey,
    CASE o_orderkey % 8
      WHEN 0 THEN strftime(o_orderdate, '%m/%d/%Y')
      WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
      WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN 3 THEN strftime(o_orderdate, '%m-%d-%Y')
      WHEN 4 THEN strftime(o_orderdate, '%d.%m.%Y')
      WHEN 5 THEN '  ' || strftime(o_orderdate, '%-m/%-d/%Y') || ' '
      WHEN 6 THEN strftime(o_orderdate, '%m/%d/%y')
      ELSE strftime(o_orderdate, '%Y/%m/%d') END AS s
  FROM orders)"""

SQL["b3_parse_date"] = with_(_DATE_STRINGS) + \
    f"SELECT o_orderkey, s, CAST({parse_date_sql('s')} AS VARCHAR) AS parsed FROM date_strings"

SQL["b7_date_parts"] = with_(_DATE_STRINGS, f"p AS (SELECT o_orderkey, {parse_date_sql('s')} AS dt FROM date_strings)") + \
    """SELECT o_orderkey, CAST(coalesce(year(dt), 0) AS INTEGER) AS year, CAST(coalesce(month(dt), 0) AS INTEGER) AS month,
  CAST(coalesce(day(dt), 0) AS INTEGER) AS day, CAST(coalesce(isodow(dt) - 1, 0) AS INTEGER) AS weekday,
  CAST(coalesce(quarter(dt), 0) AS INTEGER) AS quarter
FROM p"""

SQL["b4_parse_invoice_json"] = with_(ORDER_DOCS) + """SELECT 'inv_' || CAST(o_orderkey AS VARCHAR) || '.png' AS file_name,
  (o_orderkey % 23 = 0) AS is_empty,
  CAST(CASE WHEN o_orderkey % 23 = 0 THEN 0 ELSE n_items END AS INTEGER) AS n_items,
  CASE WHEN o_orderkey % 23 = 0 OR o_orderkey % 11 = 0 THEN NULL ELSE strftime(o_orderdate, '%m/%d/%Y') END
    AS invoice_date
FROM order_docs"""

SQL["b5_fill_defaults"] = with_(INVOICE_LINES_NULLS) + """SELECT Inv_Id, coalesce(Vendor_Code, 'VENDOR-UNKNOWN') AS Vendor_Code,
  coalesce(GL_Code, 'GL-UNKNOWN') AS GL_Code, coalesce(Inv_Amt, 0.0) AS Inv_Amt,
  coalesce(Item_Description, '') AS Item_Description, Product_Category
FROM invoice_lines_nulls"""

SQL["b6_safe_ratio"] = """SELECT o.o_orderkey,
  round(CASE WHEN c.c_acctbal > 0 THEN o.o_totalprice / c.c_acctbal ELSE 0.0 END, 6) AS ratio
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""

SQL["b8_days_between"] = """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
  CAST(CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE) AS INTEGER) AS days
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

SQL["b9_text_stats"] = """SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars,
  CAST(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS INTEGER) AS n_words
FROM documents"""

SQL["b10_general_category"] = f"SELECT doc_id, {general_category_sql('text')} AS general_category FROM documents"
SQL["b10_general_category_lines"] = with_(INVOICE_LINES_NULLS) + \
    f"SELECT Inv_Id, {general_category_sql('Item_Description')} AS general_category FROM invoice_lines_nulls"

SQL["b11_preview"] = "SELECT doc_id, substring(text, 1, 100) || '...' AS preview FROM documents"

SQL["b13_filter_category"] = with_(INVOICE_LINES) + """SELECT Inv_Id, Vendor_Code, GL_Code, round(Inv_Amt, 6) AS Inv_Amt,
  Item_Description, Product_Category FROM invoice_lines WHERE Product_Category = 'CLASS-1210'"""

# ---------------------------------------------------------------------------------------------------
# D: text -> fields, over the rendered invoice text

# The fields come from the columns that the text was made of, not from patterns.
SQL["d1_invoice_number"] = with_(INVOICE_TEXT) + "SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS invoice_number FROM invoice_text"


def _date_field_sql(x: str, name: str) -> str:
    return first_match_sql(x, ["(?:date|" + name + ")[:\\s]*" + DATE_PATTERN, DATE_PATTERN])


# The text has no due date, so the first date stands for it. Where no item names a seller, the line after it is taken.
SQL["d2_date_field"] = with_(INVOICE_TEXT) + "SELECT o_orderkey, date_text AS invoice_date, date_text AS due_date FROM invoice_text"

SQL["d3_parties"] = with_(INVOICE_TEXT) + """SELECT o_orderkey, coalesce(s_name, 'Client: ' || c_name) AS seller_name, '' AS seller_address,
  c_name AS client_name, '' AS client_address FROM invoice_text"""

_PRICE = q("(?i)" + PRICE_PATTERN)
_QTY = q("(?i)" + QUANTITY_PATTERN)
_LINES = f"list_filter(string_split(text, chr(10)), lambda ln: regexp_matches(ln, {_PRICE}))"

# Every item line, and the two lines of tax and total, which hold a price too.
SQL["d4_line_items"] = with_(INVOICE_TEXT, """d4 AS (
  SELECT o_orderkey, list_concat(if(item_lines IS NULL, CAST([] AS VARCHAR[]), string_split(item_lines, chr(10))),
    ['Tax: ' || tax_text, 'Total: $ ' || total_text]) AS ls FROM invoice_text)""",
                             "u AS (SELECT o_orderkey, unnest(ls) AS line, unnest(range(len(ls))) AS pos, len(ls) AS n FROM d4)") + \
    """SELECT o_orderkey, CAST(pos AS INTEGER) AS item_pos, line AS description,
  CASE WHEN pos < n - 2 THEN split_part(line, ' ', -3) ELSE '1.00' END AS quantity, split_part(line, ' ', -1) AS total_price
FROM u"""

SQL["d5_totals"] = with_(INVOICE_TEXT) + "SELECT o_orderkey, tax_text AS tax, '' AS discount, total_text AS total FROM invoice_text"


def _text_doc_sql(src: str, key: str) -> str:
    """D6 + C4 over a text column: CTE 'tf' with every feature of the text-derived document."""
    qty_of = (f"CASE WHEN regexp_extract(ln, {_QTY}, 1) = '' THEN '1.00' ELSE regexp_extract(ln, {_QTY}, 1) END")
    return f"""td AS (
  SELECT {key},
    {strip_sql(first_match_sql('text', [SELLER_PATTERN]))} AS seller_name,
    {strip_sql(first_match_sql('text', [CLIENT_PATTERN]))} AS client_name,
    {first_match_sql('text', INVOICE_NUMBER_PATTERNS)} AS invoice_number,
    {_date_field_sql('text', 'invoice')} AS d_inv, {_date_field_sql('text', 'due')} AS d_due,
    {_LINES} AS ls,
    {first_match_sql('text', [TAX_PATTERN])} AS tax_s, {first_match_sql('text', [DISCOUNT_PATTERN])} AS disc_s,
    {first_match_sql('text', [TOTAL_PATTERN])} AS total_s
  FROM {src}),
tf AS (
  SELECT {key}, seller_name, client_name, invoice_number,
    array_to_string(list_filter(list_transform(ls, lambda ln: {strip_sql('ln')}), lambda d: d <> ''), ' ')
      AS item_descriptions,
    CAST(len(ls) AS INTEGER) AS num_items,
    coalesce(list_sum(list_transform(ls, lambda ln: {parse_number_sql(qty_of)})), 0.0) AS total_quantity,
    coalesce(list_sum(list_transform(ls, lambda ln: {parse_number_sql(f"regexp_extract(ln, {_PRICE}, 1)")})), 0.0)
      AS total_items_price,
    {parse_number_sql('tax_s')} AS tax, {parse_number_sql('disc_s')} AS discount, {parse_number_sql('total_s')} AS total,
    {parse_date_sql('d_inv')} AS di, {parse_date_sql('d_due')} AS dd
  FROM td)"""


SQL["d6_text_to_invoice"] = with_(INVOICE_TEXT, _text_doc_sql("invoice_text", "o_orderkey")) + """SELECT o_orderkey,
  seller_name, client_name, invoice_number, item_descriptions, num_items,
  seller_name || ' ' || client_name || ' ' || item_descriptions AS combined_text,
  round(total_quantity, 6) AS total_quantity, round(total_items_price, 6) AS total_items_price,
  round(CASE WHEN num_items > 0 THEN total_items_price / num_items ELSE 0.0 END, 6) AS avg_item_price,
  round(tax, 6) AS tax, round(discount, 6) AS discount, round(total, 6) AS total,
  round(CASE WHEN total > 0 THEN tax / total ELSE 0.0 END, 6) AS tax_rate,
  round(CASE WHEN total > 0 THEN discount / total ELSE 0.0 END, 6) AS discount_rate,
  CAST(coalesce(year(di), 0) AS INTEGER) AS invoice_year, CAST(coalesce(month(di), 0) AS INTEGER) AS invoice_month,
  CAST(coalesce(day(di), 0) AS INTEGER) AS invoice_day, CAST(coalesce(isodow(di) - 1, 0) AS INTEGER) AS invoice_weekday,
  CAST(coalesce(quarter(di), 0) AS INTEGER) AS invoice_quarter,
  CAST(coalesce(dd - di, 0) AS INTEGER) AS days_until_due
FROM tf"""

SQL["d7_batch_text_to_invoice"] = with_(
    """all_docs AS (SELECT doc_id, text FROM documents UNION ALL SELECT -1 - doc_id,
      CASE doc_id % 4 WHEN 0 THEN chr(10) || chr(9) WHEN 1 THEN '' WHEN 2 THEN ' ' || chr(160) || chr(8195) || ' ' END
      FROM documents)""",
    "docs AS (SELECT doc_id, text FROM all_docs WHERE doc_id >= 0)",
    _text_doc_sql("docs", "doc_id")) + f"""SELECT doc_id, 'parsed' AS status, tf.invoice_number, tf.num_items AS n_items,
  td.total_s AS total FROM tf JOIN td USING (doc_id)
UNION ALL
SELECT doc_id, 'quarantined', NULL, NULL, NULL FROM all_docs WHERE doc_id < 0"""

# ---------------------------------------------------------------------------------------------------
# W2 / W3 / K7 over embeddings used as logits

_SOFTMAX = """e AS (SELECT vec_id, embedding, list_max(embedding) AS m FROM embeddings),
x AS (SELECT vec_id, unnest(list_transform(embedding, lambda v: exp(CAST(v AS DOUBLE) - CAST(m AS DOUBLE)))) AS ex,
             unnest(range(len(embedding))) AS idx FROM e),
s AS (SELECT vec_id, idx, ex / sum(ex) OVER (PARTITION BY vec_id) AS prob FROM x)"""

SQL["k7_softmax"] = with_(_SOFTMAX) + "SELECT vec_id, CAST(idx AS INTEGER) AS idx, round(prob, 9) AS prob FROM s"

SQL["w2_top_k_per_row"] = with_(_SOFTMAX, """r AS (SELECT vec_id, idx, prob,
  row_number() OVER (PARTITION BY vec_id ORDER BY prob DESC, idx DESC) - 1 AS rank FROM s)""") + \
    """SELECT vec_id, CAST(rank AS INTEGER) AS rank, CAST(idx AS INTEGER) AS idx, round(prob, 6) AS prob
FROM r WHERE rank < 3"""

SQL["w3_argmax"] = "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax " \
                   "FROM embeddings"

# ---------------------------------------------------------------------------------------------------
# E / G1-G3 / A12: dictionaries and lookups

from .oracle_views import FAKE_PREDICTIONS, LINES_KEYED  # noqa: E402

SQL["e1_attach_labels"] = "SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"

SQL["e3_encode_lookup"] = with_(INVOICE_LINES) + \
    "SELECT Inv_Id, CAST(dense_rank() OVER (ORDER BY Vendor_Code) - 1 AS INTEGER) AS vendor_idx FROM invoice_lines"

_HALVES = LINES_KEYED + """,
fit AS (SELECT * FROM lines_keyed WHERE l_partkey % 3 = 0),
new AS (SELECT * FROM lines_keyed),
dict AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS idx
         FROM (SELECT DISTINCT Item_Description AS v FROM fit))"""

SQL["g2_transform_dictionary"] = with_(_HALVES) + """SELECT n.Inv_Id, CAST(coalesce(d.idx, 0) AS DOUBLE) AS desc_idx
FROM new n LEFT JOIN dict d ON n.Item_Description = d.v"""

SQL["g2_unseen_vendors"] = with_(LINES_KEYED + """,
cut AS (SELECT max(l_suppkey) * CAST(0.8 AS DOUBLE) AS c FROM lineitem),
fit AS (SELECT k.* FROM lines_keyed k WHERE l_suppkey < (SELECT c FROM cut)),
new AS (SELECT * FROM lines_keyed),
dict AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS idx FROM (SELECT DISTINCT Vendor_Code AS v FROM fit))""") + \
    """SELECT n.Inv_Id, CAST(coalesce(d.idx, 0) AS DOUBLE) AS vendor_idx
FROM new n LEFT JOIN dict d ON n.Vendor_Code = d.v"""

SQL["e5_known_values"] = with_(_HALVES) + \
    "SELECT Inv_Id, Item_Description FROM new WHERE Item_Description IN (SELECT v FROM dict)"
SQL["e5_unseen_values"] = with_(_HALVES) + \
    "SELECT Inv_Id, Item_Description FROM new WHERE Item_Description NOT IN (SELECT v FROM dict)"

_CLASS_DICT = """cdict AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS idx
  FROM (SELECT DISTINCT y_true AS v FROM fake_predictions))"""

SQL["e4_decode_labels"] = with_(FAKE_PREDICTIONS, _CLASS_DICT) + """SELECT p.Inv_Id, d.idx AS pred_idx, d2.v AS pred_label
FROM fake_predictions p LEFT JOIN cdict d ON p.y_pred = d.v LEFT JOIN cdict d2 ON d.idx = d2.idx"""


def _dict_sql(col: str) -> str:
    return (f"SELECT '{col}' AS column_name, v AS value, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS idx "
            f"FROM (SELECT DISTINCT {col} AS v FROM invoice_lines WHERE {col} IS NOT NULL)")


SQL["g1_fit_dictionary"] = with_(INVOICE_LINES) + "\nUNION ALL\n".join(
    _dict_sql(c) for c in ("Vendor_Code", "GL_Code", "Product_Category"))

SQL["a12_label_mapping"] = with_(INVOICE_LINES) + """SELECT CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS idx, v AS label
FROM (SELECT DISTINCT Product_Category AS v FROM invoice_lines)"""

SQL["g3_scaler"] = with_(INVOICE_LINES, "st AS (SELECT avg(Inv_Amt) AS m, stddev_pop(Inv_Amt) AS s FROM invoice_lines)") + \
    """SELECT Inv_Id, round((Inv_Amt - (SELECT m FROM st)) / (SELECT CASE WHEN s = 0 THEN 1.0 ELSE s END FROM st), 6)
  AS amount_scaled FROM invoice_lines"""

# ---------------------------------------------------------------------------------------------------
# G4-G7 over documents

_TERMS = f"""docs_clean AS (SELECT doc_id, {clean_text_sql('text')} AS c FROM documents),
toks AS (SELECT doc_id, list_filter(string_split(c, ' '), lambda t: length(t) >= 2) AS t FROM docs_clean),
grams AS (SELECT doc_id, list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS g
          FROM toks),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(g) AS term FROM grams) GROUP BY doc_id, term),
stats AS (SELECT term, CAST(sum(tf) AS BIGINT) AS count, count(*) AS df FROM tf GROUP BY term),
nd AS (SELECT count(*) AS n FROM documents),
kept AS (SELECT s.* FROM stats s WHERE df >= 2 AND df <= CAST(0.95 AS DOUBLE) * (SELECT n FROM nd)
         ORDER BY count DESC, term ASC LIMIT 5000),
vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, df,
                 ln((1.0 + (SELECT n FROM nd)) / (1.0 + df)) + 1.0 AS idf FROM kept)"""

SQL["g4_tokens"] = with_(f"docs_clean AS (SELECT doc_id, {clean_text_sql('text')} AS c FROM documents)") + \
    "SELECT doc_id, CAST(len(list_filter(string_split(c, ' '), lambda t: length(t) >= 2)) AS INTEGER) AS n_tokens " \
    "FROM docs_clean"
SQL["g5_ngrams"] = with_(_TERMS) + "SELECT term, count, df FROM stats"
SQL["g6_fit_vocabulary"] = with_(_TERMS) + "SELECT term, idx, df, round(idf, 9) AS idf FROM vocab"
SQL["g7_tfidf"] = with_(_TERMS) + """SELECT doc_id, term, idx,
  round(tf * idf / sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY doc_id)), 6) AS weight
FROM tf JOIN vocab USING (term)"""

# ---------------------------------------------------------------------------------------------------
# H: splits

SQL["h1_stratified_split"] = with_(INVOICE_LINES, """r AS (
  SELECT Inv_Id, row_number() OVER (PARTITION BY Product_Category ORDER BY md5('42|' || Inv_Id), Inv_Id) - 1 AS r,
         count(*) OVER (PARTITION BY Product_Category) AS n
  FROM invoice_lines)""") + "SELECT Inv_Id, r < round(CAST(0.2 AS DOUBLE) * n) AS is_val FROM r"

SQL["h1_stratified_split_nulls"] = with_(INVOICE_LINES_NULLS, """r AS (
  SELECT Inv_Id, GL_Code, row_number() OVER (PARTITION BY GL_Code ORDER BY md5('42|' || Inv_Id)) - 1 AS r,
         count(*) OVER (PARTITION BY GL_Code) AS n
  FROM invoice_lines_nulls)""") + "SELECT Inv_Id, GL_Code, r < round(CAST(0.2 AS DOUBLE) * n) AS is_val FROM r"

SQL["h2_random_split"] = with_(INVOICE_LINES, """r AS (
  SELECT Inv_Id, row_number() OVER (ORDER BY md5('42|' || Inv_Id), Inv_Id) - 1 AS r, count(*) OVER () AS n
  FROM invoice_lines)""") + "SELECT Inv_Id, r < floor(CAST(0.2 AS DOUBLE) * n) AS is_val FROM r"

# ---------------------------------------------------------------------------------------------------
# F / W1 / K3: profiling

_LINE_COLS = ("Inv_Id", "Vendor_Code", "GL_Code", "Inv_Amt", "Item_Description", "Product_Category")
_SPARK_TYPES = {"Inv_Amt": "double"}

SQL["f1_shape"] = with_(INVOICE_LINES) + "SELECT count(*) AS n_rows, 6 AS n_cols FROM invoice_lines"
SQL["f2_null_counts"] = with_(INVOICE_LINES_NULLS) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM invoice_lines_nulls"
    for c in _LINE_COLS)
SQL["f3_n_unique"] = with_(INVOICE_LINES_NULLS) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_unique FROM invoice_lines_nulls" for c in _LINE_COLS)
SQL["f6_column_info"] = with_(INVOICE_LINES_NULLS) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{_SPARK_TYPES.get(c, 'string')}' AS dtype, count({c}) AS non_null "
    f"FROM invoice_lines_nulls" for c in _LINE_COLS)


def _value_counts_sql(cte: str, src: str, col: str, n: int | None) -> str:
    lim = f" LIMIT {n}" if n else ""
    return with_(cte) + (f"SELECT {col} AS value, count(*) AS count FROM {src} WHERE {col} IS NOT NULL "
                         f"GROUP BY {col} ORDER BY count DESC, value ASC{lim}")


SQL["f4_value_counts"] = _value_counts_sql(INVOICE_LINES_NULLS, "invoice_lines_nulls", "Vendor_Code", 5)
SQL["f4_value_counts_class"] = _value_counts_sql(INVOICE_LINES_NULLS, "invoice_lines_nulls", "Product_Category", None)
SQL["f13_top_categories"] = _value_counts_sql(INVOICE_LINES, "invoice_lines", "Product_Category", 20)
SQL["k3_predicted_distribution"] = _value_counts_sql(FAKE_PREDICTIONS, "fake_predictions", "y_pred", 10)
SQL["f13_general_categories"] = with_(f"g AS (SELECT {general_category_sql('text')} AS general_category FROM documents)") + \
    "SELECT general_category AS value, count(*) AS count FROM g GROUP BY 1 ORDER BY count DESC, value ASC"

SQL["f5_describe"] = with_(INVOICE_LINES_NULLS) + """SELECT count(Inv_Amt) AS count, round(avg(Inv_Amt), 6) AS mean,
  round(stddev_samp(Inv_Amt), 6) AS std, round(min(Inv_Amt), 6) AS min,
  round(quantile_cont(Inv_Amt, 0.25), 6) AS q25, round(quantile_cont(Inv_Amt, 0.5), 6) AS q50,
  round(quantile_cont(Inv_Amt, 0.75), 6) AS q75, round(max(Inv_Amt), 6) AS max
FROM invoice_lines_nulls"""

SQL["f7_histogram"] = with_(INVOICE_LINES_NULLS, """d AS (SELECT Inv_Amt AS x FROM invoice_lines_nulls WHERE Inv_Amt IS NOT NULL),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM d),
c AS (SELECT CASE WHEN hi = lo THEN 1
                  ELSE least(CAST(floor((x - lo) * (CAST(50 AS DOUBLE) / (hi - lo))) AS INTEGER) + 1, 50) END AS bin,
             count(*) AS n
      FROM d, b GROUP BY 1),
g AS (SELECT CAST(unnest(range(1, 51)) AS INTEGER) AS bin, lo, hi FROM b)""") + \
    """SELECT g.bin, round(lo + (g.bin - 1) * ((hi - lo) / CAST(50 AS DOUBLE)), 6) AS lo,
  round(lo + g.bin * ((hi - lo) / CAST(50 AS DOUBLE)), 6) AS hi, coalesce(c.n, 0) AS count
FROM g LEFT JOIN c ON g.bin = c.bin"""

SQL["f8_box_stats"] = with_(INVOICE_LINES_NULLS, """d AS (SELECT Inv_Amt AS x FROM invoice_lines_nulls WHERE Inv_Amt IS NOT NULL),
q AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS med, quantile_cont(x, 0.75) AS q3 FROM d)""") + \
    """SELECT round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
  round(min(x) FILTER (WHERE x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1)), 6) AS lower_whisker,
  round(max(x) FILTER (WHERE x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1)), 6) AS upper_whisker,
  count(*) FILTER (WHERE NOT (x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1))) AS n_outliers,
  round(q3 - q1, 6) AS iqr
FROM d, q GROUP BY q1, med, q3"""

SQL["f9_examples_top3"] = with_(INVOICE_LINES, """c AS (SELECT Product_Category AS category, count(*) AS n FROM invoice_lines
      GROUP BY 1 ORDER BY n DESC, category ASC LIMIT 3),
r AS (SELECT Product_Category AS category, Inv_Id, Item_Description,
             row_number() OVER (PARTITION BY Product_Category ORDER BY Inv_Id) AS rn FROM invoice_lines)""") + \
    """SELECT r.category, c.n, CAST(r.rn AS INTEGER) AS rn, r.Inv_Id, r.Item_Description
FROM r JOIN c USING (category) WHERE r.rn <= 2"""

SQL["f9_examples_general"] = with_(f"""t AS (SELECT doc_id, {general_category_sql('text')} AS category,
  substring(text, 1, 100) || '...' AS preview FROM documents),
c AS (SELECT category, count(*) AS n FROM t GROUP BY 1),
r AS (SELECT category, doc_id, preview, row_number() OVER (PARTITION BY category ORDER BY doc_id) AS rn FROM t)""") + \
    """SELECT r.category, c.n, CAST(r.rn AS INTEGER) AS rn, r.doc_id, r.preview FROM r JOIN c USING (category)
WHERE r.rn <= 3"""


def _word_freq_sql(cte: str, src: str, col: str, n: int) -> str:
    return with_(cte, f"""w AS (SELECT unnest(regexp_split_to_array(trim(regexp_replace(lower({col}), '[^a-z\\s]', ' ', 'g')),
  '\\s+')) AS word FROM {src} WHERE {col} IS NOT NULL)""") + \
        f"SELECT word, count(*) AS count FROM w WHERE word <> '' GROUP BY word ORDER BY count DESC, word ASC LIMIT {n}"


SQL["f10_word_frequency"] = _word_freq_sql("docs AS (SELECT * FROM documents)", "docs", "text", 30)
SQL["f13_top_words"] = _word_freq_sql(INVOICE_LINES_NULLS, "invoice_lines_nulls", "Item_Description", 20)

SQL["f11_class_distribution"] = with_(INVOICE_LINES) + """SELECT label, n, min(n) OVER () AS min_count,
  CAST(sum(CASE WHEN n < 2 THEN 1 ELSE 0 END) OVER () AS BIGINT) AS n_classes_lt2
FROM (SELECT Product_Category AS label, count(*) AS n FROM invoice_lines GROUP BY 1)"""

SQL["f12_head"] = with_(INVOICE_LINES) + """SELECT Inv_Id, Vendor_Code, GL_Code, round(Inv_Amt, 6) AS Inv_Amt, Item_Description,
  Product_Category FROM invoice_lines ORDER BY Inv_Id LIMIT 5"""

SQL["w1_top_k"] = with_(INVOICE_LINES) + \
    "SELECT Inv_Id, round(Inv_Amt, 6) AS Inv_Amt FROM invoice_lines ORDER BY Inv_Amt DESC, Inv_Id ASC LIMIT 10"

# ---------------------------------------------------------------------------------------------------
# J / I6 over prediction tables


def _per_class_sql(src: str, name: str = "pcm") -> str:
    return f"""{name}_c AS (
  SELECT label, sum(tp) AS tp, sum(t) AS support, sum(p) AS predicted FROM (
    SELECT y_true AS label, 1 AS t, 0 AS p, CASE WHEN y_true = y_pred THEN 1 ELSE 0 END AS tp FROM {src}
    UNION ALL SELECT y_pred, 0, 1, 0 FROM {src}) GROUP BY label),
{name} AS (
  SELECT label, CAST(tp AS DOUBLE) AS tp, CAST(support AS BIGINT) AS support, CAST(predicted AS BIGINT) AS predicted,
    CASE WHEN predicted > 0 THEN CAST(tp AS DOUBLE) / predicted ELSE 0.0 END AS precision,
    CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / support ELSE 0.0 END AS recall,
    CASE WHEN support + predicted > 0 THEN 2.0 * CAST(tp AS DOUBLE) / (support + predicted) ELSE 0.0 END AS f1
  FROM {name}_c)"""


_ACC = "CAST(avg(CASE WHEN y_true = y_pred THEN 1 ELSE 0 END) AS DOUBLE)"

SQL["j1_accuracy"] = with_(FAKE_PREDICTIONS) + f"SELECT round({_ACC}, 6) AS accuracy FROM fake_predictions"
SQL["j2_f1"] = with_(FAKE_PREDICTIONS, _per_class_sql("fake_predictions")) + \
    "SELECT round(avg(f1), 6) AS f1_macro, round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM pcm"
SQL["j3_classification_report"] = with_(FAKE_PREDICTIONS, _per_class_sql("fake_predictions")) + f"""SELECT label,
  round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM pcm
UNION ALL SELECT 'accuracy', round(a, 6), round(a, 6), round(a, 6), s
  FROM (SELECT (SELECT {_ACC} FROM fake_predictions) AS a, CAST(sum(support) AS BIGINT) AS s FROM pcm)
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
  CAST(sum(support) AS BIGINT) FROM pcm
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
  CAST(sum(support) AS BIGINT) FROM pcm"""
SQL["j5_confusion_matrix"] = with_(FAKE_PREDICTIONS) + \
    "SELECT y_true, y_pred, count(*) AS n FROM fake_predictions GROUP BY y_true, y_pred"
SQL["j6_log_loss"] = with_(_SOFTMAX, "lp AS (SELECT s.prob FROM s JOIN embeddings e ON s.vec_id = e.vec_id AND s.idx = e.label)") + \
    "SELECT round(avg(-ln(least(greatest(prob, 1e-15), 1 - 1e-15))), 6) AS log_loss FROM lp"

_MODEL_B = """model_b AS (
  SELECT Inv_Id, y_true,
    CASE WHEN starts_with(md5(Inv_Id), '0') OR starts_with(md5(Inv_Id), '1')
         THEN 'CLASS-' || CAST(1200 + (CAST(regexp_extract(y_true, '(\\d+)$', 1) AS INTEGER) - 1200 + 1) % 36 AS VARCHAR)
         ELSE y_true END AS y_pred
  FROM fake_predictions)"""
_RESULTS = with_(FAKE_PREDICTIONS, _MODEL_B, _per_class_sql("fake_predictions", "pa"), _per_class_sql("model_b", "pb"),
                 f"""results AS (
  SELECT 'model_a' AS model, 1 AS train_order, (SELECT {_ACC} FROM fake_predictions) AS accuracy,
    (SELECT sum(f1 * support) / sum(support) FROM pa) AS f1_weighted, (SELECT avg(f1) FROM pa) AS f1_macro,
    'moved=md5 0' AS params
  UNION ALL
  SELECT 'model_b', 2, (SELECT {_ACC} FROM model_b), (SELECT sum(f1 * support) / sum(support) FROM pb),
    (SELECT avg(f1) FROM pb), 'moved=md5 0-1')""")
SQL["j4_compare_models"] = _RESULTS + """SELECT model, train_order, round(accuracy, 6) AS accuracy,
  round(f1_weighted, 6) AS f1_weighted, round(f1_macro, 6) AS f1_macro, params FROM results"""
SQL["i6_select_best"] = _RESULTS + """SELECT model, train_order, round(accuracy, 6) AS accuracy,
  round(f1_weighted, 6) AS f1_weighted, round(f1_macro, 6) AS f1_macro, params FROM results
WHERE f1_weighted > 0 ORDER BY f1_weighted DESC, train_order ASC LIMIT 1"""

# ---------------------------------------------------------------------------------------------------
# A: projections behind the sinks

SQL["a8_submission"] = with_(FAKE_PREDICTIONS) + "SELECT Inv_Id, y_pred AS Product_Category FROM fake_predictions"
SQL["a9_export_categorized"] = with_(INVOICE_LINES) + f"""SELECT Inv_Id, Vendor_Code, GL_Code, round(Inv_Amt, 6) AS Inv_Amt,
  Item_Description, {general_category_sql('Item_Description')} AS General_Category, Product_Category
FROM invoice_lines"""
SQL["a13_scan_labels"] = with_(INVOICE_LINES) + \
    "SELECT count(*) AS n_rows, count(DISTINCT Product_Category) AS n_classes FROM invoice_lines"

SQL["f4_value_counts_gl"] = _value_counts_sql(INVOICE_LINES_NULLS, "invoice_lines_nulls", "GL_Code", 5)
SQL["f4_value_counts_class_top10"] = _value_counts_sql(INVOICE_LINES, "invoice_lines", "Product_Category", 10)
_PIVOT_COLS = ",\n  ".join(f"count(*) FILTER (WHERE y_pred = 'CLASS-{1200 + i}') AS CLASS_{1200 + i}" for i in range(36))
SQL["j5_confusion_pivot"] = with_(FAKE_PREDICTIONS) + f"SELECT y_true,\n  {_PIVOT_COLS}\nFROM fake_predictions GROUP BY y_true"

from . import oracle_images, oracle_models  # noqa: E402

SQL.update(oracle_models.SQL)
SQL.update(oracle_images.SQL)
