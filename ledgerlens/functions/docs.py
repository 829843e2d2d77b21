"""Invoice JSON documents: parse and feature expressions.

A document is parsed once per row (``from_json`` into a declared schema) and
every feature is then a plain column expression over that struct, so a whole
feature table is one projection with no Python in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ._util import as_col
from .dates import date_parts, days_between, parse_date
from .numbers import parse_number, safe_ratio
from .text import combined_text


_JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false"}


def _raw_parse(c) -> Column:
    return F.from_json(as_col(c), schemas.INVOICE_DOC_WITH_BAD, _JSON_OPTIONS)


def _checked(parsed: Column) -> Column:
    doc = F.struct(*[parsed[f.name].alias(f.name) for f in schemas.INVOICE_DOC.fields])
    return F.when(parsed.isNotNull() & parsed["_bad"].isNull(), doc)


def parse_invoice_json(c) -> Column:
    """JSON text -> invoice struct; malformed text -> null struct (read as an empty document).

    The row is always kept. Any corrupt-record flag nulls the whole document so
    that a half-parsed record never leaks partial fields. On DataFrames prefer
    ``parse_invoice_frame``, which parses in a projection of its own.
    """
    return _checked(_raw_parse(c))


def parse_invoice_frame(df: DataFrame, json_column: str = "json_data", out: str = "_doc", keep=("file_name",)):
    """B4 on a DataFrame: ``from_json`` runs once per row in its own projection, the corrupt-record check in the next."""
    carried = [c for c in keep if c in df.columns]
    parsed = df.select(*carried, _raw_parse(json_column).alias("_parsed"))
    return parsed.select(*carried, _checked(F.col("_parsed")).alias(out))


def _items(doc) -> Column:
    return F.coalesce(as_col(doc)["items"], F.array().cast(schemas.INVOICE_DOC["items"].dataType))


def text_features(doc) -> dict[str, Column]:
    """Header names and number, joined item descriptions, item count, combined and OCR text."""
    doc = as_col(doc)
    inv = doc["invoice"]
    seller = F.coalesce(inv["seller_name"], F.lit(""))
    client = F.coalesce(inv["client_name"], F.lit(""))
    descs = F.filter(F.transform(_items(doc), lambda i: i["description"]), lambda d: d.isNotNull() & (d != ""))
    item_descriptions = F.array_join(descs, " ")
    return {
        "seller_name": seller,
        "client_name": client,
        "invoice_number": F.coalesce(inv["invoice_number"], F.lit("")),
        "item_descriptions": item_descriptions,
        "num_items": F.size(_items(doc)),
        "combined_text": combined_text(seller, client, item_descriptions),
        "ocr_text": F.coalesce(doc["_ocr_text"], F.lit("")),
    }


def numeric_features(doc) -> dict[str, Column]:
    """Item sums and mean, tax, discount, total and the two rates."""
    doc = as_col(doc)
    items = _items(doc)
    n = F.size(items)
    qty = F.aggregate(items, F.lit(0.0), lambda a, i: a + parse_number(i["quantity"]))
    price = F.aggregate(items, F.lit(0.0), lambda a, i: a + parse_number(i["total_price"]))
    sub = doc["subtotal"]
    tax = parse_number(sub["tax"])
    discount = parse_number(sub["discount"])
    total = parse_number(sub["total"])
    return {
        "total_quantity": qty,
        "total_items_price": price,
        "avg_item_price": F.when(n > 0, price / n).otherwise(F.lit(0.0)),
        "num_items": n,
        "tax": tax,
        "discount": discount,
        "total": total,
        "tax_rate": safe_ratio(tax, total),
        "discount_rate": safe_ratio(discount, total),
    }


def date_features(doc) -> dict[str, Column]:
    """Parts of the invoice date and days until due."""
    doc = as_col(doc)
    issued = parse_date(doc["invoice"]["invoice_date"])
    due = parse_date(doc["invoice"]["due_date"])
    parts = date_parts(issued)
    return {
        "invoice_year": parts["year"],
        "invoice_month": parts["month"],
        "invoice_day": parts["day"],
        "invoice_weekday": parts["weekday"],
        "invoice_quarter": parts["quarter"],
        "days_until_due": days_between(due, issued),
    }


# Column order of a feature row: text, numeric, date features (num_items once).
FEATURE_COLUMNS = (
    "seller_name", "client_name", "invoice_number", "item_descriptions", "num_items", "combined_text", "ocr_text",
    "total_quantity", "total_items_price", "avg_item_price", "tax", "discount", "total", "tax_rate", "discount_rate",
    "invoice_year", "invoice_month", "invoice_day", "invoice_weekday", "invoice_quarter", "days_until_due",
)


def all_features(doc) -> list[Column]:
    """C4: union of C1-C3 as aliased columns, in feature order."""
    cols = {**text_features(doc), **numeric_features(doc), **date_features(doc)}
    return [cols[name].alias(name) for name in FEATURE_COLUMNS]


def add_features(df: DataFrame, doc_col: str = "_doc", carried=()) -> DataFrame:
    """C4 on a DataFrame, in two projections: fields, numbers and dates first, then what is made from them.

    Every source string is parsed once; rates, parts and joined texts refer to columns.
    """
    doc = F.col(doc_col)
    t, n = text_features(doc), numeric_features(doc)
    names = [f"_f{i}" for i in range(len(carried))]  # carried columns can't clash with ours
    first = {k: t[k] for k in ("seller_name", "client_name", "invoice_number", "item_descriptions", "num_items", "ocr_text")}
    first |= {k: n[k] for k in ("total_quantity", "total_items_price", "tax", "discount", "total")}
    first["_issued"] = parse_date(doc["invoice"]["invoice_date"])
    first["_due"] = parse_date(doc["invoice"]["due_date"])
    x = df.select(*[F.col(c).alias(m) for c, m in zip(carried, names)], *[c.alias(k) for k, c in first.items()])
    parts = date_parts(F.col("_issued"))
    made = {
        "combined_text": combined_text("seller_name", "client_name", "item_descriptions"),
        "avg_item_price": F.when(F.col("num_items") > 0, F.col("total_items_price") / F.col("num_items")).otherwise(F.lit(0.0)),
        "tax_rate": safe_ratio("tax", "total"), "discount_rate": safe_ratio("discount", "total"),
        "invoice_year": parts["year"], "invoice_month": parts["month"], "invoice_day": parts["day"],
        "invoice_weekday": parts["weekday"], "invoice_quarter": parts["quarter"],
        "days_until_due": days_between("_due", "_issued"),
    }
    cols = [made.get(c, F.col(c)).alias(c) if c in made else F.col(c) for c in FEATURE_COLUMNS]
    return x.select(*cols, *[F.col(m).alias(c) for c, m in zip(carried, names)])


def feature_table(df: DataFrame, json_column: str = "json_data", keep=("file_name",)) -> DataFrame:
    """One feature row per JSON document, carrying ``keep`` columns (e.g. file_name).

    The parse runs in its own projection so ``from_json`` is evaluated once per row.
    """
    carried = [c for c in keep if c in df.columns]
    parsed = parse_invoice_frame(df, json_column, "_doc", carried)
    return add_features(parsed, "_doc", carried)


def items_exploded(df: DataFrame, doc_column: str = "_doc", keep=("file_name",)) -> DataFrame:
    """One row per item (position, text fields, parsed numbers); documents without items keep one null row."""
    carried = [c for c in keep if c in df.columns]
    exploded = df.select(*carried, F.posexplode_outer(_items(F.col(doc_column))).alias("item_pos", "_item"))
    return exploded.select(
        *carried,
        "item_pos",
        F.col("_item.description").alias("description"),
        F.col("_item.quantity").alias("quantity"),
        F.col("_item.total_price").alias("total_price"),
        F.when(F.col("_item").isNotNull(), parse_number(F.col("_item.quantity"))).alias("quantity_value"),
        F.when(F.col("_item").isNotNull(), parse_number(F.col("_item.total_price"))).alias("price_value"),
    )


def numeric_vector(df: DataFrame, names=schemas.NUMERIC_VECTOR_ORDER, out: str = "numeric_features") -> Column:
    """Fixed-order float array; null/NaN -> 0.0; a column the frame lacks -> 0.0."""
    vals = []
    for name in names:
        if name in df.columns:
            v = F.col(name).cast("double")
            vals.append(F.coalesce(F.nanvl(v, F.lit(0.0)), F.lit(0.0)).cast("float"))
        else:
            vals.append(F.lit(0.0).cast("float"))
    return F.array(*vals).alias(out)
