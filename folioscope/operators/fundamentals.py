"""Statement metrics: growth, ratios, trends and missing data with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def growth(rows: DataFrame, period: str, value: str, key: list[str] | None = None, spans: tuple = (3, 5)) -> DataFrame:
    """yoy (0.0 in the first period) and cagr over the spans, by position in time."""
    w = Window.partitionBy(*(key or [])).orderBy(period) if key else Window.orderBy(period)
    out = rows.withColumn("yoy", F.round(F.coalesce(F.try_divide(F.col(value), F.lag(value).over(w)) - 1, F.lit(0.0)), 6))
    for n in spans:
        base = F.lag(value, n).over(w)
        out = out.withColumn(f"cagr_{n}", F.round(F.when((base > 0) & (F.col(value) > 0), F.pow(F.col(value) / base, F.lit(1.0 / n)) - 1), 6))
    return out


def ratio(top: Column, bottom: Column, name: str) -> list[Column]:
    """name and name_missing: null with a reason where an input is missing or the divisor is zero."""
    reason = F.when(top.isNull() | bottom.isNull(), "missing_input").when(bottom == 0, "zero_divisor")
    return [F.round(F.when(reason.isNull(), F.try_divide(top, bottom)), 6).alias(name), reason.alias(name + "_missing")]


def long_facts(wide: DataFrame, ids: list[str], items: list[str]) -> DataFrame:
    """(ids..., item, value) of a wide statement."""
    return wide.unpivot(ids, items, "item", "value")


def drawdown(rows: DataFrame, key: str, period: str, value: str) -> DataFrame:
    """Share lost against the running maximum, and the range so far."""
    w = Window.partitionBy(key).orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("drawdown", F.round(F.col(value) / F.max(value).over(w) - 1, 6))


def identity(rows: DataFrame, left: Column, right: Column, tolerance: float) -> DataFrame:
    """difference and ok of an accounting identity."""
    return rows.withColumn("difference", F.round(left - right, 2)).withColumn("ok", F.abs(left - right) <= tolerance)


#: Statement metrics as (name, formula over item columns, source fields); interest and capex are negative in statements.
METRICS = {
    "gross_margin": ("gross_profit / net_sales", ["gross_profit", "net_sales"]),
    "operating_margin": ("operating_profit / net_sales", ["operating_profit", "net_sales"]),
    "net_margin": ("net_profit / net_sales", ["net_profit", "net_sales"]),
    "debt_to_equity": ("(short_borrowings + long_borrowings) / equity", ["short_borrowings", "long_borrowings", "equity"]),
    "interest_coverage": ("operating_profit / -interest", ["operating_profit", "interest"]),
    "current_ratio": ("current_assets / current_liabilities", ["current_assets", "current_liabilities"]),
    "free_cash_flow": ("operating_cash + capex", ["operating_cash", "capex"]),
    "cash_conversion": ("operating_cash / net_profit", ["operating_cash", "net_profit"]),
    "return_on_equity": ("net_profit / equity", ["net_profit", "equity"]),
    "payout_ratio": ("-dividends / net_profit", ["dividends", "net_profit"]),
    "net_debt_to_ebitda": ("(short_borrowings + long_borrowings - cash) / (operating_profit + depreciation)", ["short_borrowings", "long_borrowings", "cash", "operating_profit", "depreciation"]),
    "price_to_earnings": ("price / earnings_per_share", ["price", "earnings_per_share"]),
}


def metric_records(wide: DataFrame, ids: list[str], metrics: dict = METRICS) -> DataFrame:
    """(ids..., metric_name, value, formula, source_fields, missing_reason): one row per metric; items that the table
    lacks make the metric null with a reason, never an error."""
    rows = []
    for name, (formula, fields) in metrics.items():
        absent = [f for f in fields if f not in wide.columns]
        if absent:
            value, reason = F.lit(None).cast("double"), F.lit("no field " + absent[0])
        else:
            null = F.lit(None).cast("string")
            for f in fields:
                null = F.coalesce(null, F.when(F.col(f).isNull(), F.lit("null " + f)))
            value = F.expr(_safe(formula)).cast("double")
            reason = F.coalesce(null, F.when(value.isNull(), F.lit("zero divisor")))
        rows.append(F.struct(F.lit(name).alias("metric_name"), F.round(value, 6).alias("value"), F.lit(formula).alias("formula"), F.lit(",".join(fields)).alias("source_fields"), reason.alias("missing_reason")))
    return wide.select(*ids, F.explode(F.array(*rows)).alias("m")).select(*ids, "m.*")


def _safe(formula: str) -> str:
    top, slash, bottom = formula.partition(" / ")
    return f"try_divide(cast({top} as double), cast({bottom} as double))" if slash else formula


#: Units by the words that a header has for them.
UNITS = {"bn": 1e9, "billion": 1e9, "mn": 1e6, "million": 1e6, "thousand": 1e3}


def unit_normalised(value: Column, header: Column, plain_from: float = 1e7) -> list[Column]:
    """value in single units and what was done: scaled by the unit of the header, or kept where the header names one but
    the value is too large for it (statements say Bn and hold single units)."""
    low, factor = F.lower(F.coalesce(header, F.lit(""))), F.lit(1.0)
    for word, f in UNITS.items():
        factor = F.when(low.rlike(rf"\b{word}\b"), f).otherwise(factor)
    stays = (factor > 1) & (F.abs(value) >= plain_from)
    return [F.when(stays, value).otherwise(value * factor).alias("value"), F.when(stays, "kept").when(factor > 1, "scaled").otherwise("plain").alias("unit")]
