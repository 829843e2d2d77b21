"""Declared schemas for every table the engine reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

INVOICE_LINES = T.StructType([
    T.StructField("Inv_Id", S),
    T.StructField("Vendor_Code", S),
    T.StructField("GL_Code", S),
    T.StructField("Inv_Amt", T.DoubleType()),
    T.StructField("Item_Description", S),
    T.StructField("Product_Category", S),
])

# Unlabelled lines: the same without the class column.
INVOICE_LINES_TEST = T.StructType([f for f in INVOICE_LINES.fields if f.name != "Product_Category"])

LABELS = T.StructType([T.StructField("Inv_Id", S), T.StructField("Product_Category", S)])

INVOICE_JSON = T.StructType([T.StructField("file_name", S), T.StructField("json_data", S)])

INVOICE_HEADER = T.StructType([
    T.StructField(n, S) for n in (
        "client_name", "client_address", "seller_name", "seller_address",
        "invoice_number", "invoice_date", "due_date",
    )
])
ITEM = T.StructType([T.StructField(n, S) for n in ("description", "quantity", "total_price")])
SUBTOTAL = T.StructType([T.StructField(n, S) for n in ("tax", "discount", "total", "net")])
PAYMENT = T.StructType([
    T.StructField(n, S) for n in ("due_date", "bank_name", "account_number", "payment_method", "iban", "bic")
])

# The nested invoice document. Every leaf is a string: numbers and dates arrive as text.
INVOICE_DOC = T.StructType([
    T.StructField("invoice", INVOICE_HEADER),
    T.StructField("items", T.ArrayType(ITEM)),
    T.StructField("subtotal", SUBTOTAL),
    T.StructField("payment_instructions", PAYMENT),
    T.StructField("_ocr_text", S),
])

# from_json schema with a corrupt-record column, so malformed text is flagged, never dropped.
INVOICE_DOC_WITH_BAD = T.StructType(INVOICE_DOC.fields + [T.StructField("_bad", S)])

TEXT_FEATURES = ("seller_name", "client_name", "invoice_number", "item_descriptions", "combined_text", "ocr_text")
NUMERIC_FEATURES = (
    "total_quantity", "total_items_price", "avg_item_price", "tax", "discount", "total", "tax_rate", "discount_rate",
)
DATE_FEATURES = (
    "invoice_year", "invoice_month", "invoice_day", "invoice_weekday", "invoice_quarter", "days_until_due",
)

# Order of the 15-float numeric vector fed to models (fixed values).
NUMERIC_VECTOR_ORDER = (
    "total_quantity", "total_items_price", "avg_item_price", "num_items",
    "tax", "discount", "total", "tax_rate", "discount_rate",
    "invoice_year", "invoice_month", "invoice_day", "invoice_weekday", "invoice_quarter", "days_until_due",
)
