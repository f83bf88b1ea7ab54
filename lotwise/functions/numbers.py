"""Numbers as listing sources write them. All are column expressions; bad input gives null or the default, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .once import unless

WHOLE = r"^\s*[+-]?\d+([eE][+-]?\d+)?\s*$"
DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
#: The leftmost alternative wins, so 1234 without a dot gives 123.
GROUPED = r"(\d{1,3}(?:\.\d{3})*|\d+)"


def _double(text: Column, pattern: str) -> Column:
    return F.trim(F.regexp_extract(text, pattern, 0)).try_cast("double")


def parse_int(text: Column, default: int | None = 0) -> Column:
    """Drops every dot and comma, then truncates: '1.234,56' is 123456."""
    return F.coalesce(_double(F.regexp_replace(text, "[.,]", ""), WHOLE).try_cast("bigint"), F.lit(default).cast("bigint"))


def parse_int_variant(value: Column, default: int | None = 0) -> Column:
    """parse_int of a JSON value: texts as above, numbers truncated, true is 1."""
    kind, text = F.schema_of_variant(value), F.try_variant_get(value, "$", "string")
    number = F.when(kind == "STRING", parse_int(text, None)).when(kind == "BOOLEAN", (text == "true").cast("bigint")).when(~kind.rlike("^(OBJECT|ARRAY|VOID)"), text.try_cast("double").try_cast("bigint"))
    return F.coalesce(number, F.lit(default).cast("bigint"))


def parse_float(text: Column, default: float | None = None) -> Column:
    """A comma counts as a dot."""
    return F.coalesce(_double(F.replace(text, F.lit(","), F.lit(".")), DECIMAL), F.lit(default).cast("double"))


def to_int(text: Column) -> Column:
    """Truncated number, or null: '12.9' is 12."""
    return _double(text, DECIMAL).try_cast("bigint")


def parse_first_int(text: Column) -> Column:
    """The first number with dots between thousands."""
    return F.replace(unless(F.regexp_extract(text, GROUPED, 1), ""), F.lit("."), F.lit("")).try_cast("bigint")


def parse_int_digits(text: Column) -> Column:
    """All digits of the text as one number."""
    return unless(F.regexp_replace(text, "[^0-9]", ""), "").try_cast("bigint")


def text_to_float(text: Column) -> Column:
    """Dots between thousands, a comma before decimals."""
    return _double(F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit(".")), DECIMAL)


def text_to_int(text: Column) -> Column:
    return F.floor(text_to_float(text))


def get_numbers(text: Column) -> Column:
    """All tokens of digits, dots and commas."""
    return F.filter(F.split(F.trim(F.regexp_replace(text, "[^0-9., ]", "")), " "), lambda x: x != "")


def get_number(text: Column, index: int) -> Column:
    return F.get(get_numbers(text), F.lit(index))


def monthly_truncated(yearly: Column) -> Column:
    """A twelfth, truncated; 0 on bad input."""
    return F.coalesce((yearly.try_cast("double") / 12).try_cast("bigint"), F.lit(0).cast("bigint"))


def monthly_rounded(yearly: Column) -> Column:
    """A twelfth, halves to the even neighbour: 30 is 2, 18 is 2."""
    return F.bround(yearly.try_cast("double") / 12).try_cast("bigint")


def monthly_tax(exempt: Column, note: Column, monthly: Column, tax: Column, yearly: Column) -> Column:
    """Exempt is 0; else the monthly value, the tax field, or a twelfth of the yearly one."""
    free = F.coalesce(exempt, F.lit(False)) | F.coalesce(F.lower(note).contains("isento"), F.lit(False))
    return F.when(free, F.lit(0).cast("bigint")).when(monthly.isNotNull(), to_int(monthly)).when(tax.isNotNull(), to_int(tax)).otherwise(monthly_rounded(yearly))


def parse_price_text(text: Column) -> Column:
    """'Isento' is 0, 'não informado' null, else the digits."""
    t = F.trim(text)
    return F.when(t.rlike("(?iu)^isento$"), F.lit(0).cast("bigint")).when(t.rlike(r"(?iu)^n[aã]o\s+informado$"), F.lit(None)).otherwise(parse_int_digits(t))


def combined_fee(combined: Column, total: Column, rent: Column) -> Column:
    """The combined fee, or what the total holds beyond the rent."""
    return F.coalesce(F.nullif(combined, F.lit(0)), F.try_subtract(total, rent))
