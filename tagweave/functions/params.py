"""Integer parsing with a default, and request limits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagweave.fixed import (
    MIN_QUERY_LENGTH,
    RECOMMEND_DEFAULT,
    RECOMMEND_MAX,
    SUGGEST_DEFAULT,
    SUGGEST_MAX,
)
from tagweave.functions.text import strip

_LONG_MIN, _LONG_MAX = -(2**63), 2**63 - 1


def _whole(value: Column) -> Column:
    """Numbers without their fraction, towards zero; null for what is no number."""
    number = value.try_cast("double")
    beyond = F.when(number < 0, F.lit(_LONG_MIN)).otherwise(F.lit(_LONG_MAX))
    finite = ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))
    towards_zero = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))
    return F.when(finite, F.coalesce(towards_zero.try_cast("bigint"), beyond))


def parse_int(value: Column, default: int) -> Column:
    """Whole number in ``value`` as bigint, ``default`` where there is none.

    Text is parsed, numbers lose their fraction, true is 1. Numbers beyond bigint saturate: every
    caller clamps or compares, so only the side matters.
    """
    kind = F.typeof(value)
    default_ = F.lit(default).cast("bigint")
    return (
        F.when(
            kind.isin("tinyint", "smallint", "int", "bigint", "boolean"),
            F.coalesce(value.try_cast("bigint"), default_),
        )
        .when(
            kind.isin("float", "double") | kind.startswith("decimal"),
            F.coalesce(_whole(value), default_),
        )
        .otherwise(_parse_text(value, default))
    )


def _parse_text(value: Column, default: int) -> Column:
    text = strip(value.cast("string"))
    digits = F.regexp_replace(text, "_", "")
    beyond = F.when(text.startswith("-"), F.lit(_LONG_MIN)).otherwise(F.lit(_LONG_MAX))
    return F.when(
        text.rlike(r"\A[+-]?[0-9]+(?:_[0-9]+)*\z"), F.coalesce(digits.try_cast("bigint"), beyond)
    ).otherwise(F.lit(default).cast("bigint"))


def parse_count(value: Column) -> Column:
    """Non-null bigint counter: 0 for null or unreadable text."""
    return parse_int(value, 0)


def clamp(value: Column, default: int, upper: int) -> Column:
    """Parse and limit to ``1..upper``."""
    return F.greatest(F.lit(1), F.least(F.lit(upper), parse_int(value, default))).cast("int")


def recommend_limit(value: Column) -> Column:
    return clamp(value, RECOMMEND_DEFAULT, RECOMMEND_MAX)


def suggest_limit(value: Column) -> Column:
    return clamp(value, SUGGEST_DEFAULT, SUGGEST_MAX)


def query_long_enough(query: Column) -> Column:
    """The length is that of the raw text, white space included."""
    return F.length(F.coalesce(query, F.lit(""))) >= MIN_QUERY_LENGTH
