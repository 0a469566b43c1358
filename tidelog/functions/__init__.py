"""Column expressions: everything here stays inside generated JVM code."""

from tidelog.functions.messages import json_string, map_value
from tidelog.functions.text import browser, regexp_first, similar_to, words
from tidelog.functions.times import (
    date_parts,
    epoch_millis,
    instant,
    millis_to_ntz,
    to_millis,
    wall_clock,
    window_time,
)

__all__ = [
    "browser",
    "date_parts",
    "epoch_millis",
    "instant",
    "json_string",
    "map_value",
    "millis_to_ntz",
    "regexp_first",
    "similar_to",
    "to_millis",
    "wall_clock",
    "window_time",
    "words",
]
