"""Time-series line protocol as one column expression."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from sensorloom.functions.numbers import all_of, finite

# Characters the line protocol reserves in names and tag values, and line breaks.
RESERVED = {",": "\\,", "=": "\\=", " ": "\\ ", "\n": "\\n", "\r": "\\r"}
RESERVED_IN_MEASUREMENT = {c: escape for c, escape in RESERVED.items() if c != "="}


def _escaped(text: Column, reserved: Mapping[str, str] = RESERVED) -> Column:
    for character, escape in reserved.items():
        text = F.replace(text, F.lit(character), F.lit(escape))
    return text


def can_be_tag(value: Column) -> Column:
    """Whether a tag value can be written so that it is read back the same; null for null.

    The protocol has no escape for a backslash, which would change what the next character means.
    """
    return ~F.contains(value, F.lit("\\"))


def line_protocol(
    measurement: Column, tags: Mapping[str, Column], fields: Mapping[str, Column], nanos: Column
) -> Column:
    """``measurement,tag=... field=...,field=... nanoseconds``.

    Null, NaN and infinite fields and null or empty tags are left out, as the protocol cannot carry
    them; a point without any field, or with a tag that :func:`can_be_tag` rules out, has no line (null). Float32 fields are written as the double
    they widen to.
    """
    tag_parts = [
        F.when(value != "", F.concat(_escaped(F.lit(name)), F.lit("="), _escaped(value)))
        for name, value in tags.items()
    ]
    field_parts = [
        F.concat(_escaped(F.lit(name)), F.lit("="), finite(value.cast("double")).cast("string"))
        for name, value in fields.items()
    ]
    head = F.concat_ws(",", _escaped(measurement, RESERVED_IN_MEASUREMENT), *tag_parts)
    body = F.nullif(F.concat_ws(",", *field_parts), F.lit(""))
    time = F.coalesce(F.concat(F.lit(" "), nanos.cast("string")), F.lit(""))
    carried = all_of(F.coalesce(can_be_tag(value), F.lit(True)) for value in tags.values())
    return F.when(carried, F.concat(head, F.lit(" "), body, time))
