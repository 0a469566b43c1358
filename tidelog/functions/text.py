"""Text functions: whole-string SQL patterns, first match, word split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the browser is the text of a user agent up to its first slash.
BROWSER_PATTERN = "[^/]+"

# Characters that mean something to a Java regular expression but are plain
# text in a SIMILAR TO pattern.
_PLAIN_IN_SQL = set(".^$\\")


def similar_to_regex(pattern: str) -> str:
    """Java regex that accepts exactly the strings ``SIMILAR TO pattern`` accepts.

    ``\\z`` and not ``$`` ends it: ``$`` would also accept a trailing newline.
    """
    out, in_class = [], False
    for ch in pattern:
        if in_class:
            in_class = ch != "]"
            out.append("\\\\" if ch == "\\" else ch)
        elif ch == "[":
            in_class = True
            out.append(ch)
        elif ch == "%":
            out.append(".*")
        elif ch == "_":
            out.append(".")
        elif ch in _PLAIN_IN_SQL:
            out.append("\\" + ch)
        else:
            out.append(ch)
    if in_class:
        raise ValueError(f"unclosed character class in {pattern!r}")
    return f"^(?s:{''.join(out)})\\z"


def similar_to(col: Column | str, pattern: str) -> Column:
    """``col SIMILAR TO pattern``; NULL stays NULL, so a filter drops it."""
    return _col(col).rlike(similar_to_regex(pattern))


def regexp_first(col: Column | str, pattern: str) -> Column:
    """First match of the whole pattern, NULL when there is none."""
    return F.regexp_substr(_col(col), F.lit(pattern))


def browser(user_agent: Column | str = "user_agent") -> Column:
    return regexp_first(user_agent, BROWSER_PATTERN)


def words(line: Column | str) -> Column:
    """Split on single spaces: trailing empty words go, inner ones stay.

    An empty line is one empty word; a line of spaces only has no words.
    """
    line = _col(line)
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(F.rtrim(line) == "", F.array().cast("array<string>"))
        .otherwise(F.split(F.rtrim(line), " ", -1))
    )


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
