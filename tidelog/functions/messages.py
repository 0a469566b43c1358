"""Small message helpers: JSON strings and lookups in property maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_string(value: Column | str, on_error: str = "fail") -> Column:
    """Text inside a message that is one JSON string; a number or boolean as it is written.

    NULL for a NULL message and for JSON ``null``. Anything else ends the job, or with
    ``on_error="skip"`` gives NULL. The message is parsed once.
    """
    if on_error not in ("fail", "skip"):
        raise ValueError(f"on_error is 'fail' or 'skip', not {on_error!r}")
    value = F.col(value) if isinstance(value, str) else value
    text = value.cast("string")
    bad = F.lit(None).cast("string")
    if on_error == "fail":
        why = F.concat(F.lit("Message isn't a JSON string: "), text)
        bad = F.raise_error(why).cast("string")

    def read(parsed: Column) -> Column:
        kind = F.schema_of_variant(parsed)
        return (
            F.when(kind == "STRING", F.try_variant_get(parsed, "$", "string"))
            .when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)"), F.trim(text))
            .when(text.isNull() | (kind == "VOID"), F.lit(None).cast("string"))
            .otherwise(bad)
        )

    return F.element_at(F.transform(F.array(F.try_parse_json(text)), read), 1)


def map_value(properties: Column | str, key: str) -> Column:
    """Value under ``key``; NULL for a NULL map or a missing key."""
    properties = F.col(properties) if isinstance(properties, str) else properties
    return F.try_element_at(properties, F.lit(key))
