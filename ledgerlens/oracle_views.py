"""DuckDB SQL for the derived views of ``fixtures.py``, as CTE text.

The oracle queries (``oracle.py``) prepend the CTEs they need. Both engines
build the same rows from the same parquet tables, so every value is comparable.
"""

from __future__ import annotations

LINES_KEYED = """lines_keyed AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber,
         CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_partkey AS VARCHAR) || '-' ||
           CAST(l.l_suppkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS Inv_Id,
         'VENDOR-' || CAST(l.l_suppkey AS VARCHAR) AS Vendor_Code,
         'GL-' || CAST(6100000 + p.p_size AS VARCHAR) AS GL_Code,
         l.l_extendedprice AS Inv_Amt,
         p.p_name || ' ' || p.p_type || ' ' || p.p_brand AS Item_Description,
         'CLASS-' || CAST(1200 + p.p_size % 36 AS VARCHAR) AS Product_Category
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

INVOICE_LINES = LINES_KEYED + """,
invoice_lines AS (
  SELECT Inv_Id, Vendor_Code, GL_Code, Inv_Amt, Item_Description, Product_Category FROM lines_keyed)"""

INVOICE_LINES_NULLS = LINES_KEYED + """,
invoice_lines_nulls AS (
  SELECT Inv_Id,
         CASE WHEN l_suppkey % 10 <> 0 THEN Vendor_Code END AS Vendor_Code,
         CASE WHEN l_orderkey % 19 <> 0 THEN GL_Code END AS GL_Code,
         CASE WHEN l_partkey % 17 <> 0 THEN Inv_Amt END AS Inv_Amt,
         CASE WHEN l_orderkey % 13 <> 0 THEN Item_Description END AS Item_Description,
         Product_Category
  FROM lines_keyed)"""

# Item order: the key, then description, quantity text and price text (the key alone is not unique).
ITEM_ORDER = ("l.l_linenumber, l.l_partkey, l.l_suppkey, p.p_name, "
              "CAST(CAST(l.l_quantity AS DECIMAL(15,2)) AS VARCHAR), "
              "CAST(CAST(l.l_extendedprice AS DECIMAL(15,2)) AS VARCHAR)")

ORDER_DOCS = """order_items AS (
  SELECT l.l_orderkey,
         count(*) AS n_items,
         string_agg(p.p_name, ' ' ORDER BY """ + ITEM_ORDER + """) AS descs,
         sum(l.l_quantity) AS qty,
         sum(CAST(l.l_extendedprice AS DECIMAL(15,2))) AS price_dec,
         CAST(sum(CAST(l.l_extendedprice AS DECIMAL(15,2)) * CAST(l.l_tax AS DECIMAL(15,2))) AS DECIMAL(15,2)) AS tax_dec,
         CAST(sum(CAST(l.l_extendedprice AS DECIMAL(15,2)) * CAST(l.l_discount AS DECIMAL(15,2))) AS DECIMAL(15,2))
           AS discount_dec,
         first(l.l_suppkey ORDER BY """ + ITEM_ORDER + """) AS first_suppkey
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY l.l_orderkey),
order_docs AS (
  SELECT o.o_orderkey, o.o_totalprice, o.o_orderdate, c.c_name, s.s_name,
         coalesce(oi.n_items, 0) AS n_items, coalesce(oi.descs, '') AS descs, coalesce(oi.qty, 0) AS qty,
         coalesce(oi.price_dec, 0) AS price_dec,
         coalesce(oi.tax_dec, CAST(0 AS DECIMAL(15,2))) AS tax_dec,
         coalesce(oi.discount_dec, CAST(0 AS DECIMAL(15,2))) AS discount_dec
  FROM orders o
  LEFT JOIN order_items oi ON o.o_orderkey = oi.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN supplier s ON oi.first_suppkey = s.s_suppkey)"""

# Plain-text rendering of each invoice (same lines as fixtures.invoice_text).
INVOICE_TEXT = """text_items AS (
  SELECT l.l_orderkey,
         string_agg(p.p_name || ' ' || CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) || ' pcs ' ||
                    CAST(CAST(l.l_extendedprice AS DECIMAL(15,2)) AS VARCHAR), chr(10)
                    ORDER BY """ + ITEM_ORDER + """) AS item_lines,
         CAST(sum(CAST(l.l_extendedprice AS DECIMAL(15,2)) * CAST(l.l_tax AS DECIMAL(15,2))) AS DECIMAL(15,2)) AS tax_dec,
         first(l.l_suppkey ORDER BY """ + ITEM_ORDER + """) AS first_suppkey
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY l.l_orderkey),
invoice_text AS (
  SELECT o.o_orderkey, s.s_name, c.c_name, ti.item_lines, strftime(o.o_orderdate, '%m/%d/%Y') AS date_text,
         CAST(coalesce(ti.tax_dec, CAST(0 AS DECIMAL(15,2))) AS VARCHAR) AS tax_text,
         CAST(CAST(o.o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS total_text,
         'Invoice no: ' || CAST(o.o_orderkey AS VARCHAR) || chr(10) ||
         'Date: ' || strftime(o.o_orderdate, '%m/%d/%Y') || chr(10) ||
         'Seller: ' || coalesce(s.s_name, '') || chr(10) ||
         'Client: ' || c.c_name || chr(10) ||
         CASE WHEN ti.item_lines IS NULL THEN '' ELSE ti.item_lines || chr(10) END ||
         'Tax: ' || CAST(coalesce(ti.tax_dec, CAST(0 AS DECIMAL(15,2))) AS VARCHAR) || chr(10) ||
         'Total: $ ' || CAST(CAST(o.o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS text
  FROM orders o
  LEFT JOIN text_items ti ON o.o_orderkey = ti.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN supplier s ON ti.first_suppkey = s.s_suppkey)"""

FAKE_PREDICTIONS = INVOICE_LINES + """,
fake_predictions AS (
  SELECT Inv_Id, Product_Category AS y_true,
         CASE WHEN starts_with(md5(Inv_Id), '0')
              THEN 'CLASS-' || CAST(1200 + (CAST(regexp_extract(Product_Category, '(\\d+)$', 1) AS INTEGER) - 1200 + 1) % 36
                                    AS VARCHAR)
              ELSE Product_Category END AS y_pred
  FROM invoice_lines)"""


def with_(*ctes: str) -> str:
    """Join CTE bodies into one WITH clause."""
    return "WITH " + ",\n".join(ctes) + "\n"
