"""Text -> fields: generic patterns (D1-D6) and the German template (D8) with its golden row."""

import math
import random
import re

from pyspark.sql import functions as F

from ledgerlens.fixtures import GERMAN_CLIENT, GERMAN_RULES, GERMAN_SELLER
from ledgerlens.functions import all_features, template_extract, text_to_invoice
from ledgerlens.functions.fields import GERMAN_FUEL_LAZY_TAX, PRICE_PATTERN, QUANTITY_PATTERN, line_items
from ledgerlens.functions.text import strip_ws

# An invented invoice in the German fuel-station layout.
GERMAN_TEXT = f"""{GERMAN_SELLER} - Inhaberin: Petra Vogt
Uferweg 7, 04177 Lindenau, Telefon 0341 5550147

An
Herr
{GERMAN_CLIENT}
Am Anger 3
04420 Seehausen

Rechnungsdatum: 12.03.2024
Rechnungsnr. : 58/2024
Kundennr. 7714, Kartennr. 0032

Menge Sorte Steuer Preis Betrag
52,50 SuperE 5 19,00 % 1,760 92,40 EUR
Gesamtsumme 92,40 EUR

Aufstellung
5 A:MwSt 19 % 77,65 EUR 14,75 EUR 92,40 EUR
Summe 77,65 EUR 14,75 EUR 92,40 EUR

Konto IBAN: DE02100500000054540402 BIC: LINDDE01XXX Bank: Hausbank Lindenau
Der Betrag wird am 19.03.2024 eingezogen. Vielen Dank!
"""


def german(spark, rules=GERMAN_RULES):
    df = spark.createDataFrame([(GERMAN_TEXT,)], "text string")
    d = df.select(template_extract("text", rules).alias("d"))
    return d.select("d", *all_features("d")).first()


def test_german_golden_row(spark):
    r = german(spark)
    doc = r["d"]
    assert doc["invoice"]["invoice_number"] == "58/2024"
    assert doc["invoice"]["seller_name"] == "Tankhof Lindenau"
    assert doc["invoice"]["seller_address"] == "Uferweg 7, 04177 Lindenau"
    assert doc["invoice"]["client_name"] == "Jonas Beck"
    assert doc["invoice"]["client_address"] == "Am Anger 3, 04420 Seehausen"
    assert doc["items"][0]["quantity"] == "52.50 Liter" and doc["items"][0]["total_price"] == "92.40"
    assert doc["subtotal"]["net"] == "77.65" and doc["subtotal"]["tax"] == "14.75"
    assert doc["payment_instructions"]["iban"] == "DE02100500000054540402"
    assert doc["payment_instructions"]["bic"] == "LINDDE01XXX"
    assert doc["payment_instructions"]["bank_name"] == "Hausbank Lindenau"
    assert doc["payment_instructions"]["payment_method"] == "SEPA-Lastschrift"
    assert doc["payment_instructions"]["due_date"] == "19.03.2024"
    assert (r["invoice_year"], r["invoice_month"], r["invoice_day"]) == (2024, 3, 12)
    assert r["invoice_weekday"] == 1 and r["invoice_quarter"] == 1 and r["days_until_due"] == 7
    assert r["num_items"] == 1 and r["total_quantity"] == 52.5 and r["total_items_price"] == 92.4
    assert r["total"] == 92.4 and r["discount"] == 0.0 and r["tax"] == 14.75


def test_german_lazy_tax_rule(spark):
    """The layout's own tax rule takes the net amount: tax 77.65, rate 0.8404."""
    r = german(spark, GERMAN_RULES + (GERMAN_FUEL_LAZY_TAX,))
    assert r["tax"] == 77.65 and math.isclose(round(r["tax_rate"], 4), 0.8404)


def test_generic_patterns_on_german_text(spark):
    """The generic patterns find no number or total here, and take every line with an amount as an item."""
    df = spark.createDataFrame([(GERMAN_TEXT,)], "text string")
    d = df.select(text_to_invoice(F.col("text")).alias("d")).first()["d"]
    assert d["invoice"]["invoice_number"] == "" and d["subtotal"]["total"] == ""
    assert [i["total_price"] for i in d["items"]] == ["12.03", "52,50", "92,40", "77,65", "77,65", "19.03"]


def test_generic_traits(spark):
    text = "Invoice #123\nDate of issue:\n04/13/2013\nDue date: 05/01/2013\nwidget 3,00 each 627.00\nSubtotal: 627.00"
    df = spark.createDataFrame([(text,)], "text string")
    d = df.select(text_to_invoice(F.col("text")).alias("d")).first()["d"]
    assert d["invoice"]["invoice_number"] == "123"
    assert d["invoice"]["invoice_date"] == "05/01/2013" and d["invoice"]["due_date"] == "05/01/2013"
    item = d["items"][0]
    assert item["total_price"] == "3,00" and item["quantity"] == "3,00"
    assert d["subtotal"]["total"] == "627.00"  # 'Subtotal' feeds total
    assert d["payment_instructions"]["due_date"] == "05/01/2013"


def test_each_line_pattern_runs_once(spark):
    """an amount was looked for twice in a line, a quantity twice, by patterns that took the cube of a run of digits."""
    df = spark.createDataFrame([("9" * 2000 + "\n" + "8" * 2000 + ".50 x",)], "t string")
    x = df.select(line_items("t").alias("i"))
    plan = x._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("each|pcs?|x") == plan.count("[.,]\\d{2}") == 1
    [item] = x.first()["i"]
    assert (item["quantity"], item["total_price"]) == ("8" * 2000 + ".50",) * 2
    assert "++" in PRICE_PATTERN and "++" in QUANTITY_PATTERN


def test_items_of_odd_lines_are_those_of_the_plain_patterns(spark):
    rnd = random.Random(5)
    bits = ["12", "1,5", "1.", ".", ",", "3.50", "007", "x", "X", "each", "PCS", "pc", " ", "\u2003", "\t", "\u0661\u0662", "1.2.3", "a", "#006344"]
    lines = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    want = []
    for ln in lines:
        price, qty = re.search(r"(\d+[.,]\d{2})", ln), re.search(r"(?i)(\d+[.,]?\d*)\s*(?:each|pcs?|x)", ln)
        want.append([(ln.strip(), qty.group(1) if qty else "1.00", price.group(1))] if price else [])
    got = spark.createDataFrame(list(enumerate(lines)), "i int, t string").select("i", line_items("t").alias("x")).orderBy("i").collect()
    assert [[tuple(x) for x in r["x"]] for r in got] == want and sum(map(len, want)) > 300


def test_stripped_characters_are_those_of_the_pattern(spark):
    """the pattern visited every character of a text to strip its ends."""
    df = spark.range(1, 0x3100).select(F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')").alias("c")).select(
        F.concat("c", F.lit("a"), "c", F.lit("b"), "c", "c").alias("t")).union(spark.createDataFrame([("",), (" \n",), (None,)], "t string"))
    x = df.select(strip_ws("t").alias("got"), F.regexp_replace("t", r"(?U)^\s+|\s+$", "").alias("want"))
    assert x.where("NOT got <=> want").count() == 0 and x.where("length(got) = 3").count() == 25
    assert "regexp_replace" not in df.select(strip_ws("t"))._jdf.queryExecution().optimizedPlan().toString()
