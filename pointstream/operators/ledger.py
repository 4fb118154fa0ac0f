"""Ledger responses to day rows ``(cm, content)``."""

from pyspark.sql import Column, DataFrame, functions as F

from pointstream.functions.once import once
from pointstream.functions.times import pull_day, pull_day_of

NO_RESULT = "no_result"


def _with_elements(responses: DataFrame) -> DataFrame:
    # Parsed as variants, numbers keep all their digits: decimals of up to 38, whole
    # numbers as such. Text and nesting stay; key order and the way a number is
    # written (1.10 or 1.1) may not. A text that is no JSON has no elements. A result
    # may also be the text of an array.
    parsed = responses.select("*", once(_parsed=F.expr("try_parse_json(value)")))
    elements = """coalesce(
        try_variant_get(_parsed, '$.result', 'array<variant>'),
        try_variant_get(
            try_parse_json(try_variant_get(_parsed, '$.result', 'string')), '$', 'array<variant>'))"""
    return parsed.select(*responses.columns, once(_elements=F.expr(elements)))


def load_ledger(responses: DataFrame, run_date: str | Column) -> DataFrame:
    """One row per element of each response's ``result`` array.

    ``responses`` has one response per ``value``; ``run_date`` is the day of the
    pull (ISO text) or a DATE column, and the rows get the day before as ``cm``.
    ``content`` is the element as JSON text with the same values. A ``ledger``
    column, if there is one, is kept, so that several ledgers stay apart.
    """
    day = F.lit(pull_day(run_date)) if isinstance(run_date, str) else pull_day_of(run_date)
    names = [name for name in ("ledger",) if name in responses.columns]
    return (
        _with_elements(responses)
        .withColumn("cm", day)
        .select(*names, "cm", F.explode("_elements").alias("_element"))
        .select(*names, "cm", F.to_json("_element").alias("content"))
    )


def pulled_days(responses: DataFrame, run_date: str | Column) -> DataFrame:
    """Days that responses with a ``result`` array are for, as ``cm``; also empty ones.

    A response without a result tells nothing about its day, which then stays as it is.
    """
    day = F.lit(pull_day(run_date)) if isinstance(run_date, str) else pull_day_of(run_date)
    whole = _with_elements(responses).filter(F.col("_elements").isNotNull())
    return whole.select(day.alias("cm")).distinct()


def ledger_rejects(responses: DataFrame) -> DataFrame:
    """Responses without a ``result`` array."""
    return (
        _with_elements(responses)
        .filter(F.col("_elements").isNull())
        .drop("_elements")
        .withColumn("reason", F.lit(NO_RESULT))
    )
