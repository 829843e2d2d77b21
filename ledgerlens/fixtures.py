"""Derived test views built from the driver's tables (see FIXTURES.md section 2).

Every view is a Spark plan over the parquet tables, so its size grows with the
scale factor. The DuckDB oracle builds the same views in SQL (``oracle.py``).
Numbers that end up in text are printed through DECIMAL casts, which round the
same way in both engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.fields import GERMAN_FUEL_RULES, german_party_rules
from .operators.encode import BROADCAST_BYTES
from .session import table

DEC = "decimal(15,2)"


def _money_text(c: Column) -> Column:
    """Two-decimal text of a double amount (exact for amounts in cents)."""
    return c.cast(DEC).cast("string")


def lines_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to part, with the invoice-line columns and the source keys."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    j = li.join(part, li.l_partkey == part.p_partkey)
    return j.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.concat_ws("-", *[F.col(c).cast("string") for c in
                           ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]).alias("Inv_Id"),
        F.concat(F.lit("VENDOR-"), F.col("l_suppkey").cast("string")).alias("Vendor_Code"),
        F.concat(F.lit("GL-"), (F.lit(6100000) + F.col("p_size")).cast("string")).alias("GL_Code"),
        F.col("l_extendedprice").alias("Inv_Amt"),
        F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("Item_Description"),
        F.concat(F.lit("CLASS-"), (F.lit(1200) + F.col("p_size") % 36).cast("string")).alias("Product_Category"),
    )


LINE_COLUMNS = ("Inv_Id", "Vendor_Code", "GL_Code", "Inv_Amt", "Item_Description", "Product_Category")


def invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled invoice lines: Inv_Id, Vendor_Code, GL_Code, Inv_Amt, Item_Description, Product_Category."""
    return lines_keyed(spark, sf_dir).select(*LINE_COLUMNS)


def invoice_lines_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice lines with nulls on fixed shares of rows (vendor, GL, amount, description)."""
    k = lines_keyed(spark, sf_dir)
    return k.select(
        "Inv_Id",
        F.when(F.col("l_suppkey") % 10 != 0, F.col("Vendor_Code")).alias("Vendor_Code"),
        F.when(F.col("l_orderkey") % 19 != 0, F.col("GL_Code")).alias("GL_Code"),
        F.when(F.col("l_partkey") % 17 != 0, F.col("Inv_Amt")).alias("Inv_Amt"),
        F.when(F.col("l_orderkey") % 13 != 0, F.col("Item_Description")).alias("Item_Description"),
        "Product_Category",
    )


def lines_unseen(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(fit rows, new rows): rows of suppliers above 80 % of the largest key are held out as unseen vendors."""
    k = lines_keyed(spark, sf_dir)
    cut = table(spark, sf_dir, "lineitem").agg(F.max("l_suppkey") * 0.8).scalar()
    fit = k.where(F.col("l_suppkey") < cut).select(*LINE_COLUMNS)
    new = k.where(F.col("l_suppkey") >= cut).select(*LINE_COLUMNS)
    return fit, new


def _order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: sorted item texts, first supplier, tax and discount sums (decimal, exact)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax",
        "l_discount")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = li.join(part, li.l_partkey == part.p_partkey)
    price = F.col("l_extendedprice").cast(DEC)
    item = F.struct(
        F.col("l_linenumber").alias("ln"), F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk"),
        F.col("p_name").alias("description"),
        F.col("l_quantity").cast(DEC).cast("string").alias("quantity"),
        price.cast("string").alias("total_price"),
    )
    return j.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(item)).alias("_items"),
        F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey"))["l_suppkey"].alias("first_suppkey"),
        F.sum(price * F.col("l_tax").cast(DEC)).cast(DEC).alias("tax_dec"),
        F.sum(price * F.col("l_discount").cast(DEC)).cast(DEC).alias("discount_dec"),
    )


def invoice_docs_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One typed invoice per order (orders without items keep an empty item list)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    items = _order_items(spark, sf_dir)
    size = supp.agg(F.count(F.lit(1)) * 48 + F.coalesce(F.sum(F.octet_length("s_name")), F.lit(0))).first()[0]
    supp = F.broadcast(supp) if size <= BROADCAST_BYTES else supp
    # Customers before items, suppliers broadcast: the items, most of the bytes, are shuffled by order only.
    d = (orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
         .join(items, orders.o_orderkey == items.l_orderkey, "left")
         .join(supp, F.col("first_suppkey") == supp.s_suppkey, "left"))
    return d.select(
        "o_orderkey", "o_totalprice", "c_name", "s_name",
        F.coalesce("_items", F.array()).alias("_items"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("invoice_date"),
        F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 30), "dd.MM.yyyy").alias("due_date"),
        F.coalesce(F.col("tax_dec"), F.lit(0).cast(DEC)).cast("string").alias("tax"),
        F.coalesce(F.col("discount_dec"), F.lit(0).cast(DEC)).cast("string").alias("discount"),
        _money_text(F.col("o_totalprice")).alias("total"),
    )


def _doc_json(d: DataFrame, broken: bool) -> DataFrame:
    k = F.col("o_orderkey")
    odd = (k % 7 == 0) if broken else F.lit(False)
    no_date = (k % 11 == 0) if broken else F.lit(False)
    items = F.transform("_items", lambda i: F.struct(
        i["description"].alias("description"),
        F.when(odd, F.regexp_replace(i["quantity"], r"\.", ",")).otherwise(i["quantity"]).alias("quantity"),
        F.when(odd, F.concat(F.lit("$"), i["total_price"])).otherwise(i["total_price"]).alias("total_price"),
    ))
    doc = F.struct(
        F.struct(
            F.col("c_name").alias("client_name"), F.col("s_name").alias("seller_name"),
            k.cast("string").alias("invoice_number"),
            F.when(~no_date, F.col("invoice_date")).alias("invoice_date"),
            F.col("due_date").alias("due_date"),
        ).alias("invoice"),
        items.alias("items"),
        F.struct(
            F.col("tax").alias("tax"), F.col("discount").alias("discount"),
            F.when(odd, F.format_number("o_totalprice", 2)).otherwise(F.col("total")).alias("total"),
        ).alias("subtotal"),
        F.struct(F.col("due_date").alias("due_date"), F.lit("bank transfer").alias("payment_method"))
        .alias("payment_instructions"),
    )
    named = d.select(
        k.alias("o_orderkey"),
        F.concat(F.lit("inv_"), k.cast("string"), F.lit(".png")).alias("file_name"),
        F.to_json(doc).alias("_js"),
    )
    js = F.col("_js")
    if broken:
        js = F.when(F.col("o_orderkey") % 23 == 0, F.expr("substring(_js, 1, length(_js) div 2)")).otherwise(js)
    return named.select("file_name", js.alias("json_data"), "o_orderkey")


def invoice_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_name, json_data, o_orderkey): one JSON invoice per order."""
    return _doc_json(invoice_docs_typed(spark, sf_dir), broken=False)


def invoice_docs_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """invoice_docs with truncated JSON (key % 23), '$'/comma numbers (key % 7), missing dates (key % 11)."""
    return _doc_json(invoice_docs_typed(spark, sf_dir), broken=True)


def invoice_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, text): a plain-text rendering of each invoice, one line per field and item."""
    d = invoice_docs_typed(spark, sf_dir)
    item_lines = F.transform("_items", lambda i: F.concat(
        i["description"], F.lit(" "), i["quantity"].cast("double").cast("bigint").cast("string"), F.lit(" pcs "),
        i["total_price"]))
    header = F.array(
        F.concat(F.lit("Invoice no: "), F.col("o_orderkey").cast("string")),
        F.concat(F.lit("Date: "), F.col("invoice_date")),
        F.concat(F.lit("Seller: "), F.coalesce(F.col("s_name"), F.lit(""))),
        F.concat(F.lit("Client: "), F.col("c_name")),
    )
    footer = F.array(
        F.concat(F.lit("Tax: "), F.col("tax")),
        F.concat(F.lit("Total: $ "), F.col("total")),
    )
    return d.select("o_orderkey", F.array_join(F.concat(header, item_lines, footer), "\n").alias("text"))


def fake_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(Inv_Id, y_true, y_pred): the true class, moved by one class where md5(Inv_Id) starts with '0'."""
    lines = invoice_lines(spark, sf_dir)
    num = F.regexp_extract("Product_Category", r"(\d+)$", 1).cast("int")
    moved = F.concat(F.lit("CLASS-"), (F.lit(1200) + (num - 1200 + 1) % 36).cast("string"))
    return lines.select(
        "Inv_Id", F.col("Product_Category").alias("y_true"),
        F.when(F.md5("Inv_Id").startswith("0"), moved).otherwise(F.col("Product_Category")).alias("y_pred"),
    )


def image_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings -> (vec_id, embedding, label): ten classes over 64 floats."""
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


# An invented filling station and customer for the German layout.
GERMAN_SELLER, GERMAN_CLIENT = "Tankhof Lindenau", "Jonas Beck"
GERMAN_RULES = GERMAN_FUEL_RULES + german_party_rules(
    GERMAN_SELLER, "Uferweg 7, 04177 Lindenau", GERMAN_CLIENT, "Am Anger 3, 04420 Seehausen")


def _comma(cents: Column) -> Column:
    """Cents as German text: 123456 -> '1234,56'."""
    return F.concat(F.floor(cents / 100).cast("bigint").cast("string"), F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"))


def german_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, text): every order as a German fuel-station invoice; litres are its summed quantities."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    litres = li.groupBy("l_orderkey").agg((F.sum(F.col("l_quantity").cast(DEC)) * 100).cast("bigint").alias("q"))
    x = o.join(litres, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", F.coalesce("q", F.lit(0)).alias("q"), "o_orderdate",
        (F.col("o_totalprice").cast(DEC) * 100).cast("bigint").alias("gross"))
    x = x.withColumn("vat", F.expr("gross * 19 div 119"))
    gross, vat, net = _comma(F.col("gross")), _comma(F.col("vat")), _comma(F.col("gross") - F.col("vat"))
    key, day = F.col("o_orderkey").cast("string"), F.col("o_orderdate")
    lines = [
        F.lit(GERMAN_SELLER), F.lit("Uferweg 7, 04177 Lindenau"), F.lit("Herr"), F.lit(GERMAN_CLIENT),
        F.lit("Am Anger 3, 04420 Seehausen"), F.concat(F.lit("Rechnungsdatum: "), F.date_format(day, "dd.MM.yyyy")),
        F.concat(F.lit("Rechnungsnr. : "), key, F.lit("/"), F.year(day).cast("string")),
        F.concat(_comma(F.col("q")), F.lit(" SuperE 5 19,00 % 1,699 "), gross, F.lit(" EUR")),
        F.concat(F.lit("Gesamtsumme "), gross, F.lit(" EUR")),
        F.concat(F.lit("5 A:MwSt 19 % "), net, F.lit(" EUR "), vat, F.lit(" EUR "), gross, F.lit(" EUR")),
        F.concat(F.lit("Summe "), net, F.lit(" EUR "), vat, F.lit(" EUR "), gross, F.lit(" EUR")),
        F.concat(F.lit("Konto IBAN: DE"), F.lpad(key, 20, "0"), F.lit(" BIC: LINDDE01XXX Bank: Hausbank Lindenau ")),
        F.concat(F.lit("wird am "), F.date_format(F.date_add(day.cast("date"), 5), "dd.MM.yyyy"), F.lit(" eingezogen.")),
    ]
    return x.select("o_orderkey", F.concat_ws("\n", *lines).alias("text"))


# Images: one 8 x 8 RGB picture for each embedding; some files are missing, some cut short.
IMAGE_SIDE = 8


def image_name(vec_id: Column) -> Column:
    return F.concat(F.lit("vec-"), vec_id.cast("string"), F.lit(".png"))


def image_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, file_name, height, width, data[RGB bytes], cut) of every embedding with 64 finite components.

    A component x is a level of 128 + 200 x within 0 to 255; red, green and blue of a pixel are 21 components apart.
    Ids with remainder 5 by 89 have no picture; those with remainder 3 by 97 are to be cut short.
    """
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    level = F.transform("e", lambda x: F.lpad(F.hex(
        F.least(F.lit(255), F.greatest(F.lit(0), F.floor(F.lit(128.0) + F.lit(200.0) * x).cast("int")))), 2, "0"))
    rows = rows.where((F.size("e") == 64) & finite & (F.col("vec_id") % 89 != 5)).select("vec_id", level.alias("p"))
    pixel = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda j: F.concat(
        F.get("p", j), F.get("p", (j + 21) % 64), F.get("p", (j + 42) % 64)))
    return rows.select("vec_id", image_name(F.col("vec_id")).alias("file_name"), F.lit(IMAGE_SIDE).alias("height"),
                       F.lit(IMAGE_SIDE).alias("width"), F.unhex(F.array_join(pixel, "")).alias("data"),
                       (F.col("vec_id") % 97 == 3).alias("cut"))
