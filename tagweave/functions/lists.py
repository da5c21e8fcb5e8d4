"""List columns, tag lists and feature maps, all local to one row: nothing here shuffles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagweave.fixed import (
    CONTENT_VERSION_TAGS,
    DESCRIPTOR_FEATURE_WEIGHT,
    DESCRIPTOR_PREFIX,
    MISSING_LIST,
    PRIMARY_FEATURE_WEIGHT,
    PRIMARY_PREFIX,
    SECONDARY_FEATURE_WEIGHT,
    SECONDARY_PREFIX,
    TAG_PREFIX,
)
from tagweave.functions.text import clean_tag, norm, strip

_OUTER_QUOTES = r'(?s)\A"(?:(.*)")?\z'


def no_strings() -> Column:
    return F.array().cast("array<string>")


def or_empty(values: Column) -> Column:
    return F.coalesce(values, no_strings())


def drop_empty(values: Column) -> Column:
    """Remove empty and null elements."""
    return F.filter(or_empty(values), lambda x: x != "")


def parse_list(value: Column) -> Column:
    """Comma text to array; empty items stay, one pair of outer quotes goes."""
    body = F.regexp_replace(strip(value), _OUTER_QUOTES, "$1")
    missing = value.isNull() | (value == "") | (value == MISSING_LIST)
    return F.when(missing, no_strings()).otherwise(F.transform(F.split(body, ",", -1), strip))


def tag_names(tags: Column) -> Column:
    """Cleaned names of an array of named tags, in order, duplicates kept."""
    return drop_empty(F.transform(tags, lambda t: clean_tag(t["name"])))


def match_tags(values: Column) -> Column:
    """Distinct normalized tags that count for matching."""
    tags = F.array_distinct(F.transform(or_empty(values), norm))
    return F.filter(tags, lambda t: (t != "") & ~t.isin(CONTENT_VERSION_TAGS))


def _weighted(values: Column, prefix: str, weight: float) -> Column:
    return F.transform(
        F.array_distinct(drop_empty(values)),
        lambda x: F.struct(
            F.concat(F.lit(prefix), x).alias("key"), F.lit(weight).cast("float").alias("value")
        ),
    )


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    The optimizer may copy the expression behind a column into every place that reads it, even
    inside an element-wise lambda, where it would be evaluated again for each element. A lambda
    variable cannot be replaced that way.
    """
    return F.get(F.transform(F.array(value), body), 0)


def _runs(in_order: Column) -> Column:
    """Features of a sorted tag list: prefixed tag and length of its run."""
    size = F.size(in_order)

    def first_of_run(i: Column) -> Column:
        return (i == 1) | (F.get(in_order, i - 1) != F.get(in_order, i - 2))

    def entries(starts: Column) -> Column:
        return F.transform(
            starts,
            lambda start, k: F.struct(
                F.concat(F.lit(TAG_PREFIX), F.get(in_order, start - 1)).alias("key"),
                (F.coalesce(F.get(starts, k + 1), size + 1) - start).cast("float").alias("value"),
            ),
        )

    places = F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>"))
    return let(F.filter(places, first_of_run), entries)


def feature_map(primary: Column, secondary: Column, descriptors: Column, tags: Column) -> Column:
    """Fixed weights for the three lists, occurrences for ``tags``.

    Occurrences come from run lengths of the sorted tag list, so a row costs a sort even when it
    has tens of thousands of tags, and no row leaves its partition. The four prefixes differ, so
    the keys are unique.
    """
    return F.map_from_entries(
        F.concat(
            _weighted(primary, PRIMARY_PREFIX, PRIMARY_FEATURE_WEIGHT),
            _weighted(secondary, SECONDARY_PREFIX, SECONDARY_FEATURE_WEIGHT),
            _weighted(descriptors, DESCRIPTOR_PREFIX, DESCRIPTOR_FEATURE_WEIGHT),
            let(F.sort_array(drop_empty(tags)), _runs),
        )
    )
