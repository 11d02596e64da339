"""JSON parsing and rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_permissive(value, schema: T.StructType) -> Column:
    """Parse JSON text to a struct (P1).  Malformed text does not fail the
    job: the struct gets ``_corrupt_record`` set (cut messages) or is null
    (empty messages); :func:`is_malformed` tests both."""
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    return F.from_json(_c(value), with_corrupt,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def is_malformed(parsed) -> Column:
    p = _c(parsed)
    return p.isNull() | p.getField(CORRUPT).isNotNull()


def parse_string_map(value) -> Column:
    """JSON object text -> MAP<STRING,STRING>; numbers keep their text."""
    return F.from_json(_c(value), T.MapType(T.StringType(), T.StringType()))


def typed_from_map(m, fields) -> list[Column]:
    """Typed columns from a string map.

    A field that is missing or does not parse as its type takes the bean
    default (``None`` = stays null).  ``try_cast`` keeps ANSI mode from
    failing the job on bad values."""
    m = _c(m)
    cols = []
    for name, sql_type, default in fields:
        v = m.getItem(name)
        if sql_type != "string":
            v = v.try_cast(sql_type)
        if default is not None:
            v = F.coalesce(v, F.lit(default).cast(sql_type))
        cols.append(v.alias(name))
    return cols


def field_by_name(m, name_col) -> Column:
    """Value of a field whose name is computed per row."""
    return F.element_at(_c(m), _c(name_col))


def first_element(arr) -> Column:
    """First element of an array, null when empty."""
    return F.get(_c(arr), 0)


def row_to_json(*cols) -> Column:
    """Row -> JSON text."""
    return F.to_json(F.struct(*cols))
