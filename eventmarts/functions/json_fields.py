"""Type-strict access to fields of a parsed JSON value.

A cast would turn the number 5 into the text "5" and an object into its JSON text, which
hides exactly the defects a validator is there to find.  So each field is looked at twice:
what kind of value it is, and the value itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hold(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are worked out once per row, whatever is filtered on them later.

    The optimizer moves a filter below a projection by putting the projected expressions in
    the place of their names, so a filter on the outcome of a long decision would parse the
    text again at every mention.  It does not move one below a generator; this is a generator
    that gives one row.
    """
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return rows.select("*", F.inline(F.array(made)))


def parse(text: Column | str) -> Column:
    """Parsed JSON, or null where the text is not JSON."""
    return F.try_parse_json(text)


def fields(value: Column | str, shape: str) -> Column:
    """The wanted members of a JSON object in one pass; null where there is no object.

    ``shape`` is a struct type whose leaves are ``variant``: a member that is absent comes
    back null, one that is JSON null does not.  A nested object is null if it is missing or
    something other than an object.
    """
    return F.try_variant_get(value, "$", shape)


def members(value: Column | str) -> Column:
    """All members of a JSON object as a map; null where there is no object."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def kind(value: Column | str) -> Column:
    """Kind of a value: null if it is absent, ``VOID`` for JSON null, otherwise ``STRING``,
    ``BIGINT``, ``BOOLEAN``, ``ARRAY<...>``, ``OBJECT<...>`` and so on."""
    return F.schema_of_variant(value)


def is_string(value: Column | str) -> Column:
    return F.coalesce(kind(value) == "STRING", F.lit(False))


def text(value: Column | str) -> Column:
    """The value as text.  Check its kind first, unless it is compared with a known word,
    which only a string can equal."""
    return F.try_variant_get(value, "$", "string")


def text_if_string(value: Column | str) -> Column:
    return F.when(kind(value) == "STRING", text(value))


def integer(value: Column | str) -> Column:
    """The value if it is a whole number, else null."""
    return F.when(kind(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))


def string_list(value: Column | str) -> Column:
    return F.try_variant_get(value, "$", "array<string>")


def is_string_list(value: Column | str) -> Column:
    """True for a list holding strings only; an empty list counts, a null element does not.

    A null is found by joining the list with and without a stand-in for nulls: unlike a
    lambda over the elements, this stays inside generated code.
    """
    items = string_list(value)
    no_null = F.length(F.array_join(items, "", "x")) == F.length(F.array_join(items, ""))
    return (
        F.when(kind(value) == "ARRAY<STRING>", no_null)
        .when(kind(value) == "ARRAY<VOID>", F.size(items) == 0)
        .otherwise(F.lit(False))
    )


def is_optional_string_list(value: Column | str) -> Column:
    """As above, also true where the value is absent or JSON null."""
    column = F.col(value) if isinstance(value, str) else value
    return column.isNull() | F.is_variant_null(column) | is_string_list(column)


def canonical_json(value: Column | str) -> Column:
    """Compact JSON text with sorted keys, the same for every spelling of one value."""
    return F.to_json(value)
