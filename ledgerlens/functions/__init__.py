"""Column functions: every one returns a Spark ``Column`` built from built-in expressions."""

from .arrays import argmax, softmax, softmax_frame, top_k_per_row
from .dates import date_parts, days_between, parse_date
from .docs import (
    FEATURE_COLUMNS, add_features, all_features, date_features, feature_table, items_exploded, numeric_features,
    numeric_vector, parse_invoice_frame, parse_invoice_json, text_features,
)
from .fields import (
    GERMAN_FUEL_LAZY_TAX, GERMAN_FUEL_RULES, FieldRule, date_field, first_match, german_party_rules, invoice_number, line_items,
    parties, template_extract, text_to_invoice, totals,
)
from .numbers import parse_number, safe_ratio
from .text import (
    GENERAL_CATEGORY_RULES, clean_text, combined_text, general_category, ngrams, preview, strip_ws, text_length, tokens,
    word_count,
)
