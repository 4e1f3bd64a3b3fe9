"""Cleaning and initial load of raw purchase lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import digits_only, has_digit, non_blank
from tillroll.schema import (
    COUNTRY, CUSTOMER_ID, DESCRIPTION, INVOICE_DATE, INVOICE_NO, QUANTITY,
    SEGMENT, STOCK_CODE, UNIT_PRICE,
)

# The date text pattern of the raw data, and the timestamp used
# when a date cannot be parsed (1 December 2010, 08:34).
DATE_PATTERN = "M/d/yyyy H:mm"
DEFAULT_TIMESTAMP = "2010-12-01 08:34:00"
# Text used as the segment of a customer that was never segmented.
UNSEGMENTED = "null"


def _typed(raw: DataFrame) -> DataFrame:
    """Quantity to int and UnitPrice to double; malformed text gives null.

    A fractional quantity is truncated ("3.7" gives 3), as the original
    string-to-int cast did: the fraction's digits are cut off before the
    cast.  ``try_cast`` keeps ANSI mode on: "n/a" becomes null instead of
    failing the job.
    """
    whole = rf"regexp_replace({QUANTITY}, r'\.[0-9]*\z', '')"
    return raw.select(
        F.col(INVOICE_NO), F.col(STOCK_CODE), F.col(DESCRIPTION),
        F.expr(f"try_cast({whole} AS INT)").alias(QUANTITY),
        F.col(INVOICE_DATE),
        F.expr(f"try_cast({UNIT_PRICE} AS DOUBLE)").alias(UNIT_PRICE),
        F.col(CUSTOMER_ID), F.col(COUNTRY),
    )


def _clean_line() -> Column:
    """Whether a typed line is a valid purchase line."""
    return (
        non_blank(STOCK_CODE) & non_blank(INVOICE_DATE) & non_blank(CUSTOMER_ID)
        & digits_only(CUSTOMER_ID) & digits_only(INVOICE_NO)
        & (F.col(QUANTITY) > 0) & (F.col(UNIT_PRICE) > 0)
        & has_digit(STOCK_CODE)
    )


def _loadable_line() -> Column:
    """Whether the initial load accepts a typed line."""
    return non_blank(STOCK_CODE) & (F.col(UNIT_PRICE) > 0) & non_blank(CUSTOMER_ID)


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Keep valid purchase lines.

    Required: StockCode, InvoiceDate and CustomerID present and non-empty;
    CustomerID and InvoiceNo digits only (drops cancelled invoices such as
    "C536379"); Quantity and UnitPrice positive; StockCode holding a digit
    (drops service codes such as "POST").  InvoiceDate stays unparsed text.

    One projection and one filter: Catalyst fuses them into the scan's
    codegen stage and pushes the not-null parts to the source.
    """
    return _typed(raw).filter(_clean_line())


def flagged_lines(raw: DataFrame, clean_col: str = "_clean", loadable_col: str = "_loadable") -> DataFrame:
    """The typed lines that cleaning or the initial load keeps, each told by a flag, from one scan."""
    flag = lambda c: F.coalesce(c, F.lit(False))
    lines = _typed(raw).select("*", flag(_clean_line()).alias(clean_col), flag(_loadable_line()).alias(loadable_col))
    return lines.where(F.col(clean_col) | F.col(loadable_col))


def _loadable(raw: DataFrame, pattern: str, default_ts: str) -> DataFrame:
    """Rows the initial load accepts, with a parsed timestamp ``_ts``.

    The load filter is weaker than cleaning: StockCode and CustomerID
    present, UnitPrice positive.  Dates are parsed with ``pattern`` as a
    24-hour clock (the original 12-hour ``hh`` with no am/pm field lost
    afternoon times); unparsable or missing dates take ``default_ts``.
    """
    typed = _typed(raw).filter(_loadable_line())
    ts = F.coalesce(
        F.try_to_timestamp(F.col(INVOICE_DATE), F.lit(pattern)),
        F.lit(default_ts).cast("timestamp"),
    )
    return typed.withColumn("_ts", ts)


def load_products(raw: DataFrame, pattern: str = DATE_PATTERN,
                  default_ts: str = DEFAULT_TIMESTAMP) -> DataFrame:
    """Products: StockCode with its latest Description and latest UnitPrice.

    Two levels: first the latest timestamp of each distinct (StockCode, Description,
    UnitPrice), a hash aggregate over the lines with a fixed-width buffer, combined
    map-side; then ``max(struct(ts, value))`` over these few rows picks the value of the latest
    line (ties: the greatest value).  No lines are sorted, and a product
    with a huge number of lines never gathers them in one place.
    """
    rows = _loadable(raw, pattern, default_ts).groupBy(STOCK_CODE, DESCRIPTION, UNIT_PRICE).agg(F.max("_ts").alias("_ts"))
    return (rows.groupBy(STOCK_CODE)
            .agg(F.max(F.struct(F.col("_ts"), F.col(DESCRIPTION))).getField(DESCRIPTION).alias(DESCRIPTION),
                 F.max(F.struct(F.col("_ts"), F.col(UNIT_PRICE))).getField(UNIT_PRICE).alias(UNIT_PRICE)))


def load_customers(raw: DataFrame, pattern: str = DATE_PATTERN,
                   default_ts: str = DEFAULT_TIMESTAMP,
                   unsegmented: str | None = UNSEGMENTED) -> DataFrame:
    """Distinct customers of the loadable lines, each with the initial segment.

    The initial segment is the text "null" as originally written; pass
    ``unsegmented=None`` for a real NULL.
    """
    return initial_customers(_loadable(raw, pattern, default_ts), unsegmented)


def initial_customers(rows: DataFrame, unsegmented: str | None = UNSEGMENTED) -> DataFrame:
    """The distinct customers of ``rows``, each with the initial segment."""
    return rows.select(CUSTOMER_ID).distinct().withColumn(SEGMENT, F.lit(unsegmented).cast("string"))
