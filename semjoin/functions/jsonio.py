"""Open-schema JSON records as ``map<string, variant>``.

Unknown keys survive (they are carried in the map and written back out), while
the fields the operators need are read out into typed columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

JSON_OBJECT = "map<string,variant>"


def parse_json_object(col) -> Column:
    """JSON text -> map; NULL unless the text is a JSON object (arrays, scalars, junk, ``null``)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, JSON_OBJECT, {"allowSingleQuotes": "false", "mode": "PERMISSIVE"})


def truthy_text(v: Column) -> Column:
    """A variant value as text when it is *truthy* in the producer's sense, else NULL.

    Missing key, JSON null, ``""``, ``false``, ``0``, ``[]`` and ``{}`` are falsy;
    a whitespace-only string is truthy. Non-string values are rendered as text.
    """
    t = F.schema_of_variant(v)
    s = F.try_variant_get(v, "$", "string")
    num = F.try_variant_get(v, "$", "double")
    return (F.when(v.isNull() | F.is_variant_null(v), F.lit(None).cast("string"))
            .when(t == "STRING", F.nullif(s, F.lit("")))
            .when(t == "BOOLEAN", F.when(F.try_variant_get(v, "$", "boolean"), F.lit("true")))
            .when(t.startswith("ARRAY"), F.when(s != "[]", s))
            .when(t.startswith("OBJECT"), F.when(s != "{}", s))
            .when(num.isNotNull(), F.when(num != 0, s))
            .otherwise(s))


def variant_bool(v: Column) -> Column:
    """A variant flag as boolean: missing -> NULL, JSON null -> NULL, else its truth value."""
    return F.when(v.isNull() | F.is_variant_null(v), F.lit(None).cast("boolean")) \
        .otherwise(F.coalesce(F.try_variant_get(v, "$", "boolean"), truthy_text(v).isNotNull()))


def to_json_text(m: Column) -> Column:
    """Map (or struct) -> JSON text, keeping explicit nulls."""
    return F.to_json(m, {"ignoreNullFields": "false"})


def drop_keys(m: Column, keys) -> Column:
    """Remove the given keys from a map column."""
    ks = F.array(*[F.lit(k) for k in keys])
    return F.map_filter(m, lambda k, _v: ~F.array_contains(ks, k))
