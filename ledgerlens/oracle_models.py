"""DuckDB SQL for the model, scoring and round-trip queries (imported at the end of ``oracle``)."""

from __future__ import annotations

from . import oracle as o
from .oracle_views import INVOICE_LINES, INVOICE_LINES_NULLS, INVOICE_TEXT, LINES_KEYED, ORDER_DOCS, with_

SQL: dict[str, str] = {}

# ---------------------------------------------------------------------------------------------------
# Feature vectors, entry by entry

_VENDOR, _GL = "coalesce(Vendor_Code, 'VENDOR-UNKNOWN')", "coalesce(GL_Code, 'GL-UNKNOWN')"


def _grams(name: str, src: str) -> str:
    return f"""{name}_rows AS (SELECT row_number() OVER () AS rid, * FROM {src}),
{name}_tok AS (SELECT rid, list_filter(string_split({o.clean_text_sql('Item_Description')}, ' '), lambda t: length(t) >= 2) AS t
  FROM {name}_rows),
{name}_tf AS (SELECT rid, term, count(*) AS tf FROM (
  SELECT rid, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term
  FROM {name}_tok) GROUP BY rid, term)"""


def _dict(col: str, src: str) -> str:
    return (f"SELECT v, row_number() OVER (ORDER BY v) - 1 AS idx FROM (SELECT DISTINCT {col} AS v FROM {src})")


def _vectors(fit: str, apply: str, keep: str) -> list[str]:
    """CTEs ending in ``entries`` (rid, idx, weight): fitted on ``fit``, applied to ``apply``."""
    same = fit == apply
    a = "f" if same else "a"
    ctes = [_grams("f", fit)] + ([] if same else [_grams("a", apply)])
    ctes += [f"""stats AS (SELECT term, sum(tf) AS count, count(*) AS df FROM f_tf GROUP BY term),
nd AS (SELECT count(*) AS n, avg(coalesce(Inv_Amt, 0.0)) AS m, stddev_pop(coalesce(Inv_Amt, 0.0)) AS s FROM f_rows),
kept AS (SELECT * FROM stats WHERE df >= 2 AND df <= CAST(0.95 AS DOUBLE) * (SELECT n FROM nd)
  ORDER BY count DESC, term ASC LIMIT 5000),
vocab AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx,
  ln((1.0 + (SELECT n FROM nd)) / (1.0 + df)) + 1.0 AS idf FROM kept),
w AS (SELECT rid, idx, tf * idf / sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY rid)) AS weight
  FROM {a}_tf JOIN vocab USING (term)),
vd AS ({_dict(_VENDOR, 'f_rows')}), gd AS ({_dict(_GL, 'f_rows')}),
nv AS (SELECT count(*) AS k FROM vocab),
entries AS (
  SELECT rid, idx, weight FROM w
  UNION ALL SELECT rid, (SELECT k FROM nv), CAST(vd.idx AS DOUBLE) FROM {a}_rows r JOIN vd ON {_VENDOR} = vd.v
  UNION ALL SELECT rid, (SELECT k FROM nv) + 1, CAST(gd.idx AS DOUBLE) FROM {a}_rows r JOIN gd ON {_GL} = gd.v
  UNION ALL SELECT rid, (SELECT k FROM nv) + 2, (coalesce(Inv_Amt, 0.0) - (SELECT m FROM nd)) / (SELECT s FROM nd)
    FROM {a}_rows)"""]
    return ctes


_SPLIT = """side AS (SELECT rid, rn < round(CAST(0.2 AS DOUBLE) * n) AS is_val FROM (
  SELECT rid, row_number() OVER (PARTITION BY Product_Category ORDER BY md5('42|' || Inv_Id)) - 1 AS rn,
         count(*) OVER (PARTITION BY Product_Category) AS n FROM f_rows))"""

SQL["g9_preprocess_features"] = with_(INVOICE_LINES, *_vectors("invoice_lines", "invoice_lines", ""), _SPLIT) + """
SELECT r.Inv_Id, side.is_val, CAST(e.idx AS INTEGER) AS idx, round(e.weight, 6) AS weight
FROM entries e JOIN f_rows r USING (rid) JOIN side USING (rid) WHERE e.weight <> 0"""

SQL["g11_prepare_test"] = with_(LINES_KEYED, """cut AS (SELECT max(l_suppkey) * CAST(0.8 AS DOUBLE) AS c FROM lineitem),
fit_lines AS (SELECT * FROM lines_keyed WHERE l_suppkey < (SELECT c FROM cut))""",
                               INVOICE_LINES_NULLS.replace(LINES_KEYED + ",\n", ""),
                               *_vectors("fit_lines", "invoice_lines_nulls", "")) + """
SELECT r.Inv_Id, CAST(e.idx AS INTEGER) AS idx, round(e.weight, 6) AS weight
FROM entries e JOIN a_rows r USING (rid) WHERE e.weight <> 0"""

_VAL = """r AS (
  SELECT Inv_Id, Product_Category, row_number() OVER (PARTITION BY Product_Category ORDER BY md5('42|' || Inv_Id)) - 1 AS rn,
         count(*) OVER (PARTITION BY Product_Category) AS n FROM invoice_lines)"""

SQL["g10_prepare_train"] = with_(INVOICE_LINES, _VAL) + """SELECT Inv_Id, rn < round(CAST(0.2 AS DOUBLE) * n) AS is_val,
  CAST(dense_rank() OVER (ORDER BY Product_Category) - 1 AS DOUBLE) AS label FROM r"""

_TRAIN = """parted AS (
  SELECT *, row_number() OVER (PARTITION BY Product_Category ORDER BY md5('42|' || Inv_Id)) - 1
      < round(CAST(0.2 AS DOUBLE) * count(*) OVER (PARTITION BY Product_Category)) AS is_val FROM invoice_lines),
train_lines AS (SELECT * FROM parted WHERE NOT is_val)"""
SQL["g10_fit_on_train"] = with_(INVOICE_LINES, _TRAIN, *_vectors("train_lines", "parted", "")) + """
SELECT r.Inv_Id, r.is_val, CAST(e.idx AS INTEGER) AS idx, round(e.weight, 6) AS weight
FROM entries e JOIN a_rows r USING (rid) WHERE e.weight <> 0"""

# ---------------------------------------------------------------------------------------------------
# I, J7, K: what every fitted model must satisfy

_CLASSES = "(SELECT CAST(count(DISTINCT Product_Category) AS INTEGER) FROM invoice_lines)"
for _name in ("i1_train_logistic", "i2_train_forest"):
    SQL[_name] = with_(INVOICE_LINES, _VAL) + f"""SELECT Inv_Id, Product_Category, TRUE AS label_known,
  TRUE AS confidence_is_max, TRUE AS sums_to_one, {_CLASSES} AS n_classes, TRUE AS beats_majority
FROM r WHERE rn < round(CAST(0.2 AS DOUBLE) * n)"""

SQL["i1_recomputed"] = with_(INVOICE_LINES, _VAL) + """SELECT Inv_Id, TRUE AS same_probabilities, TRUE AS confidence_is_max
FROM r WHERE rn < round(CAST(0.2 AS DOUBLE) * n)"""

SQL["i3_top_importances"] = """SELECT CAST(i AS INTEGER) AS rank, TRUE AS name_known, TRUE AS positive, TRUE AS in_order
FROM range(1, 11) t(i)"""


def _plain_val(table: str, key: str) -> str:
    return f"""r AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || CAST({key} AS VARCHAR))) - 1 AS rn,
  count(*) OVER () AS n FROM {table})"""


SQL["i4_train_fused"] = with_(_plain_val("documents", "doc_id")) + """SELECT doc_id, lang, TRUE AS label_known,
  TRUE AS confidence_is_max, TRUE AS sums_to_one,
  (SELECT CAST(count(DISTINCT lang) AS INTEGER) FROM documents) AS n_classes
FROM r WHERE rn < floor(CAST(0.2 AS DOUBLE) * n)"""

SQL["i5_train_embedding_only"] = with_(_plain_val("embeddings", "vec_id")) + """SELECT vec_id, label, TRUE AS label_known,
  TRUE AS confidence_is_max, TRUE AS sums_to_one FROM r WHERE rn < floor(CAST(0.2 AS DOUBLE) * n)"""

SQL["j7_training_history"] = """SELECT CAST(i AS INTEGER) AS epoch, TRUE AS val_loss_positive, TRUE AS accuracy_in_range,
  TRUE AS f1_in_range, TRUE AS train_loss_falls FROM range(1, 21) t(i)"""

SQL["k1_predict_batch"] = with_(INVOICE_LINES_NULLS) + """SELECT Inv_Id, coalesce(Vendor_Code, 'VENDOR-UNKNOWN') AS Vendor_Code,
  coalesce(GL_Code, 'GL-UNKNOWN') AS GL_Code, round(coalesce(Inv_Amt, 0.0), 6) AS Inv_Amt,
  coalesce(Item_Description, '') AS Item_Description, TRUE AS label_known, TRUE AS confidence_in_range
FROM invoice_lines_nulls"""

SQL["k2_predict_top3"] = with_(INVOICE_LINES) + """SELECT Inv_Id, CAST(i AS INTEGER) AS rank, TRUE AS label_known, TRUE AS in_order,
  TRUE AS first_is_prediction FROM invoice_lines, range(1, 4) t(i)"""

SQL["k4_predict_from_json"] = with_(ORDER_DOCS) + """SELECT 'inv_' || CAST(o_orderkey AS VARCHAR) || '.png' AS file_name,
  CAST(CASE WHEN o_orderkey % 23 = 0 THEN 0 ELSE n_items END AS INTEGER) AS num_items, TRUE AS label_known,
  TRUE AS confidence_in_range FROM order_docs"""

SQL["k5_predict_from_text"] = with_(INVOICE_TEXT) + """SELECT o_orderkey,
  CAST(o_orderkey AS VARCHAR) AS invoice_number, total_text AS total, TRUE AS label_known, TRUE AS confidence_in_range
FROM invoice_text"""

SQL["i4_three_branches"] = """WITH lang AS (
  SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS idx FROM (SELECT DISTINCT lang FROM documents))
SELECT d.doc_id, d.lang, CAST(l.idx * 4 + CASE WHEN len(list_filter(regexp_split_to_array(d.text, '\\s+'), lambda w: w <> '')) > 400
    THEN 2 ELSE 0 END + CASE WHEN e.embedding[1] > 0 THEN 1 ELSE 0 END AS INTEGER) AS class,
  e.vec_id IS NULL AS no_vector, TRUE AS same_forward, TRUE AS mostly_right
FROM documents d JOIN lang l ON l.lang = d.lang LEFT JOIN embeddings e ON e.vec_id = d.doc_id"""


def _text_terms(key: str) -> str:
    """Vocabulary of all documents' texts, and each (unbroken) document's number of distinct terms in it."""
    text = "coalesce(s_name, '') || ' ' || coalesce(c_name, '') || ' ' || descs"
    return f"""txt AS (SELECT o_orderkey, n_items, o_orderkey % 23 = 0 AS lost, {o.clean_text_sql(text)} AS t FROM order_docs),
tok AS (SELECT o_orderkey, list_filter(string_split(t, ' '), lambda x: length(x) >= 2) AS t FROM txt),
tf AS (SELECT o_orderkey, term, count(*) AS tf FROM (
  SELECT o_orderkey, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM tok) GROUP BY ALL),
vocab AS (SELECT term FROM (SELECT term, sum(tf) AS n, count(*) AS df FROM tf GROUP BY term)
  WHERE df >= 2 AND df <= CAST(0.95 AS DOUBLE) * (SELECT count(*) FROM txt) ORDER BY n DESC, term LIMIT 1000),
terms AS (SELECT o_orderkey, count(*) AS n FROM tf JOIN vocab USING (term) GROUP BY o_orderkey)
SELECT {key}, CAST(CASE WHEN lost THEN 0 ELSE n_items END AS INTEGER) AS num_items,
  CAST(CASE WHEN lost THEN 0 ELSE coalesce(n, 0) END AS INTEGER) AS n_terms, TRUE AS unit_length, TRUE AS label_known,
  TRUE AS mostly_right FROM txt LEFT JOIN terms USING (o_orderkey)"""


SQL["k4_json_text_branch"] = with_(ORDER_DOCS).rstrip() + ",\n" + _text_terms(
    "'inv_' || CAST(o_orderkey AS VARCHAR) || '.png' AS file_name")
SQL["k5_text_branch"] = """SELECT o_orderkey, TRUE AS has_terms, TRUE AS unit_length, TRUE AS label_known, TRUE AS mostly_right
FROM orders"""
SQL["k4_same_forward"] = "SELECT 'inv_' || CAST(o_orderkey AS VARCHAR) || '.png' AS file_name, TRUE AS same_forward FROM orders"

SQL["k6_score_with"] = """SELECT vec_id, (SELECT max(label) + 1 FROM embeddings) AS n_scores, TRUE AS same_scores FROM embeddings"""

# ---------------------------------------------------------------------------------------------------
# A, D8, K8: round trips give back what was written

SQL["a1_scan_invoice_lines"] = with_(INVOICE_LINES_NULLS) + """SELECT Inv_Id, Vendor_Code, GL_Code, round(Inv_Amt, 6) AS Inv_Amt,
  Item_Description, Product_Category FROM invoice_lines_nulls"""

SQL["a2_scan_invoice_json_csv"] = o._features_sql(True, ["file_name", "seller_name", "client_name", "num_items",
                                                         "total_items_price", "total"])

SQL["a2_land_invoice_json_csv"] = SQL["a2_scan_invoice_json_csv"]

SQL["a3_scan_invoice_json_files"] = """WITH by_block AS (
  SELECT c_nationkey, c_custkey // 100 AS block, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS v, count(*) AS k
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT n_name AS seller_name, CAST(count(*) AS INTEGER) AS num_items, CAST(sum(k) AS DOUBLE) AS total_quantity,
  round(CAST(sum(v) AS DOUBLE), 2) AS total_items_price, round(CAST(sum(v) AS DOUBLE), 2) AS total
FROM by_block JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"""

SQL["a5_write_features"] = o._features_sql(True, ["file_name", "seller_name", "num_items", "tax", "total", "tax_rate",
                                                  "invoice_year", "days_until_due"])

SQL["a6_write_invoice_json"] = with_(ORDER_DOCS) + """SELECT 'inv_' || CAST(o_orderkey AS VARCHAR) || '.png' AS file_name,
  CAST(o_orderkey AS VARCHAR) AS invoice_number, c_name AS client_name, CAST(n_items AS INTEGER) AS n_items,
  CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS total FROM order_docs"""

SQL["a7_write_predictions"] = with_(INVOICE_LINES) + """SELECT Inv_Id, Vendor_Code, CAST(3 AS INTEGER) AS n_top,
  TRUE AS first_is_prediction, TRUE AS first_is_confidence FROM invoice_lines"""

SQL["a10_pipeline_round_trip"] = with_(INVOICE_LINES) + "SELECT Inv_Id, TRUE AS same FROM invoice_lines"
SQL["a11_model_round_trip"] = with_(INVOICE_LINES) + """SELECT Inv_Id, TRUE AS same, 'logistic_regression' AS model,
  CAST(0.5 AS DOUBLE) AS score, 1 AS n_results FROM invoice_lines"""

SQL["k8_score_stream"] = with_(INVOICE_LINES_NULLS) + """SELECT Inv_Id, coalesce(Vendor_Code, 'VENDOR-UNKNOWN') AS Vendor_Code,
  coalesce(GL_Code, 'GL-UNKNOWN') AS GL_Code, count(*) AS n_rows, TRUE AS same_as_batch
FROM invoice_lines_nulls GROUP BY ALL"""

_SKETCHED = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag"]
SQL["f3_n_unique_sketch"] = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_unique, TRUE AS within_bound FROM lineitem" for c in _SKETCHED)
SQL["f5_describe_sketch"] = "\nUNION ALL ".join(
    f"""SELECT CAST(year(l_shipdate) AS INTEGER) AS year, '{c}' AS column_name, count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 4) AS mean,
  round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
  TRUE AS q25_within_bound, TRUE AS q50_within_bound, TRUE AS q75_within_bound FROM lineitem GROUP BY year(l_shipdate)"""
    for c in _SKETCHED[:5])

SQL["k8_stream_restart"] = with_(INVOICE_LINES_NULLS) + """SELECT Inv_Id, coalesce(Vendor_Code, 'VENDOR-UNKNOWN') AS Vendor_Code,
  coalesce(GL_Code, 'GL-UNKNOWN') AS GL_Code, count(*) AS n_rows, TRUE AS same_as_batch, TRUE AS same_in_both
FROM invoice_lines_nulls GROUP BY ALL"""


def _cents(x: str) -> str:
    return f"CAST({x} // 100 AS VARCHAR) || '.' || lpad(CAST({x} % 100 AS VARCHAR), 2, '0')"


SQL["d8_template_extract"] = f"""WITH q AS (
  SELECT l_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(15,2))) * 100 AS BIGINT) AS q FROM lineitem GROUP BY 1),
x AS (SELECT o_orderkey, o_orderdate, coalesce(q.q, 0) AS q, CAST(CAST(o_totalprice AS DECIMAL(15,2)) * 100 AS BIGINT) AS g
      FROM orders LEFT JOIN q ON o_orderkey = l_orderkey)
SELECT o_orderkey, 'Tankhof Lindenau' AS seller_name,
  CAST(o_orderkey AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR) AS invoice_number,
  strftime(o_orderdate, '%d.%m.%Y') AS invoice_date,
  strftime(CAST(o_orderdate AS DATE) + 5, '%d.%m.%Y') AS due_date, 1 AS n_items,
  {_cents('q')} || ' Liter' AS quantity, {_cents('g')} AS total_price, {_cents('(g - g * 19 // 119)')} AS net,
  {_cents('(g * 19 // 119)')} AS tax, {_cents('g')} AS total,
  'DE' || lpad(CAST(o_orderkey AS VARCHAR), 20, '0') AS iban, 'Hausbank Lindenau' AS bank_name
FROM x"""
