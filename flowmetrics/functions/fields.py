"""Typed reads from the open field map (JSON → VARIANT), no UDFs.

Reading rules of the source's field accessor, per target type:

* string  – object with ``displayName`` → that name; otherwise the JSON text
            (a string's value, a number's digits, an object's JSON);
* int     – an integer JSON literal within INT range, else NULL;
* decimal – any JSON number, rounded to the column scale;
* timestamp – an ISO-8601 string, converted to UTC; one without an offset is UTC;
* boolean – a JSON boolean.

Where the source would throw (a string in a numeric field, …) the value is
NULL here and ``field_type_errors`` flags the record for a quarantine table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .calendar import ts_lit

NUMERIC_TYPES = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE")
INTEGER_TYPES = ("TINYINT", "SMALLINT", "INT", "BIGINT")


def path(name: str | None, sub: str | None = None) -> str:
    """Path of a field of the map; of the value itself where ``name`` is None (see ``opened``)."""
    p = "$" if name is None else f'$["{name}"]'
    return p + (f".{sub}" if sub else "")


def opened(v: Column, types: dict[str, str]) -> Column:
    """The named fields of the map as a struct, each as VARIANT or as text (``types``): the map
    is searched once for each, and what is read of a field (``name`` None) does not search it again."""
    return F.try_variant_get(v, "$", "struct<" + ", ".join(f"`{n}`: {t}" for n, t in types.items()) + ">")


def text_string(text: Column, v: Column, name: str) -> Column:
    """``as_string`` of a field opened as text: only an object, whose text begins so, is looked into."""
    return F.when(text.startswith("{"), as_string(v, name)).otherwise(text)


def text_timestamp(text: Column, v: Column, name: str) -> Column:
    """``as_timestamp`` of a field opened as text: the usual text is a string's, and it is zoned."""
    usual = text.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?Z$")
    return F.when(usual, instant(text)).when(text.isNotNull(), as_timestamp(v, name))


def _kind(v: Column, name: str | None) -> Column:
    """Type name of the field's value (``STRING``, ``BIGINT``, ``DECIMAL(3,1)``, …)."""
    return F.schema_of_variant(v if name is None else F.try_variant_get(v, path(name), "variant"))


def _is_number(kind: Column) -> Column:
    return kind.isin(*NUMERIC_TYPES) | kind.startswith("DECIMAL")


def present(v: Column, name: str | None) -> Column:
    got = v if name is None else F.try_variant_get(v, path(name), "variant")
    return got.isNotNull() & ~F.is_variant_null(got)


def as_string(v: Column, name: str) -> Column:
    return F.coalesce(F.try_variant_get(v, path(name, "displayName"), "string"),
                      F.try_variant_get(v, path(name), "string"))


def as_int(v: Column, name: str) -> Column:
    """Integer literals only: ``16.0`` or ``1e2`` do not read as INT."""
    ok = _kind(v, name).isin(*INTEGER_TYPES)
    return F.when(ok, F.try_variant_get(v, path(name), "int"))


def as_decimal(v: Column, name: str, type_: str = "decimal(10,2)") -> Column:
    return F.when(_is_number(_kind(v, name)), F.try_variant_get(v, path(name), type_))


def as_double(v: Column, name: str) -> Column:
    return F.when(_is_number(_kind(v, name)), F.try_variant_get(v, path(name), "double"))


def as_timestamp(v: Column, name: str | None) -> Column:
    return instant(with_offset(F.when(_kind(v, name) == "STRING", F.trim(F.try_variant_get(v, path(name), "string")))))


def instant(zoned: Column) -> Column:
    # parse as an instant (offsets honoured), then take its UTC wall clock from
    # the epoch microseconds: no session-zone round trip (ambiguous at DST ends)
    return F.timestamp_add("MICROSECOND", F.unix_micros(F.try_to_timestamp(zoned)), ts_lit("1970-01-01 00:00:00"))


def with_offset(text: Column) -> Column:
    """ISO text with an offset: a text that names none is UTC, in any session zone."""
    date_only = text.rlike(r"^[+-]?\d+-\d{1,2}-\d{1,2}$")
    zoned = text.rlike(r":.*([zZ]|[+-]\d{1,2}(:?\d{2}){0,2}|[A-Za-z]{2,}\S*)$")
    minutes = text.rlike(r"[T ]\d{1,2}:\d{1,2}$")
    return (F.when(date_only, F.concat(text, F.lit("T00:00:00Z"))).when(zoned, text)
            .when(minutes, F.concat(text, F.lit(":00Z"))).otherwise(F.concat(text, F.lit("Z"))))


def as_boolean(v: Column, name: str) -> Column:
    return F.when(_kind(v, name) == "BOOLEAN", F.try_variant_get(v, path(name), "boolean"))


def identity_name(v: Column, name: str) -> Column:
    return as_string(v, name)


def identity_unique(v: Column, name: str) -> Column:
    return F.coalesce(F.try_variant_get(v, path(name, "uniqueName"), "string"),
                      F.try_variant_get(v, path(name, "displayName"), "string"),
                      F.try_variant_get(v, path(name), "string"))


def type_error(v: Column, name: str, kind: str) -> Column:
    """TRUE when a value is present but its typed reader cannot read it: another type,
    a date that does not parse, a number the column cannot hold."""
    read = {"number": as_decimal, "timestamp": as_timestamp, "boolean": as_boolean}[kind]
    return present(v, name) & read(v, name).isNull()
