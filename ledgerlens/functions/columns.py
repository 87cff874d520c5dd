"""Column expressions shared by the validators, metrics and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

# The characters a text strip removes, ASCII first, then the Unicode spaces.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
# A cast also takes "1d" or "2f" for numbers; the audit counts those as text.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# Texts that table readers take for a missing value.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# ISO dates with an optional time; a year has four digits.
ISO_PATTERN = r"^\d{4}-\d{1,2}(-\d{1,2}([ T]\d{1,2}(:\d{1,2}(:\d{1,2}(\.\d{1,9})?)?)?(Z|[+-]\d{2}:?\d{2})?)?)?$"
YEARS = (1678, 2261)
MISSING_STATUS = "Nan"


def given_text(column: Column) -> Column:
    """Text as read, but null where it says that the value is missing."""
    return F.when(~column.isin(*MISSING_TEXTS), column)


def strip(column: Column) -> Column:
    return F.btrim(column, F.lit(WHITESPACE))


def parse_number(df: DataFrame, name: str) -> Column:
    """The column as a double; text that is no number, NaN and infinities become null."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, NumericType):
        number = column.cast("double")
    else:
        text = strip(column.cast("string"))
        number = F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    return F.when(F.abs(number) < float("inf"), number)


def parse_timestamp(df: DataFrame, name: str, formats: Sequence[str] = ()) -> Column:
    """The column as a timestamp without zone; text in none of the formats becomes null.

    ISO text is always understood; ``formats`` adds patterns in order of preference. Years outside
    ``YEARS`` count as no date, and so do the day numbers of spreadsheets.
    """
    column = F.col(name)
    if not isinstance(df.schema[name].dataType, StringType):
        return column.cast("timestamp_ntz")
    text = strip(column)
    tries = [F.when(text.rlike(ISO_PATTERN), text.try_cast("timestamp_ntz"))]
    tries += [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    found = F.coalesce(*tries)
    return F.when(F.year(found).between(*YEARS), found)


def normalise_status(column: Column) -> Column:
    """Trimmed status, each run of letters capitalised; a missing one becomes the text 'Nan', a group of its own."""
    runs = F.regexp_extract_all(strip(column.cast("string")), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    titled = F.array_join(F.transform(runs, lambda run: F.concat(F.upper(F.left(run, F.lit(1))), F.lower(F.substring(run, F.lit(2), F.length(run))))), "")
    return F.coalesce(titled, F.lit(MISSING_STATUS))


def net_fee(fee: Column, discount_pct: Column) -> Column:
    """Monthly fee after discount."""
    return fee * (1 - F.coalesce(discount_pct, F.lit(0.0)) / 100.0)


def share(condition: Column) -> Column:
    """Aggregate: the part of the rows for which the condition holds."""
    return F.count_if(condition) / F.count(F.lit(1))


def clip(column: Column, low: float, high: float) -> Column:
    return F.when(column < low, F.lit(low)).when(column > high, F.lit(high)).otherwise(column)


def round_half_even(column: Column, digits: int = 2) -> Column:
    """Scale, round to the nearest even whole number, scale back: what array libraries do."""
    scale = float(10**digits)
    return F.rint(column * scale) / scale


def round_half_up(column: Column, digits: int) -> Column:
    """Round half away from zero by decimal digits, as a double: 0.285 becomes 0.29."""
    value = column.cast("double")
    # From 10^15 on a double has no decimals worth rounding.
    return F.when(F.abs(value) < 1e15, F.round(value.try_cast("decimal(38,9)"), digits).cast("double")).otherwise(value)


def round_money(column: Column) -> Column:
    return round_half_up(column, 2)
