"""SQL expressions over a JSON value kept as a variant.

A variant remembers whether a leaf was a number, a text, a boolean, null or
absent. The canonical rules need that: the number 3.7 becomes the int 3 while
the text "3.7" is not an int and takes the default.

All functions take and give SQL text: the rules are applied to dozens of leaves,
and one text is far cheaper to hand to the planner than a tree of columns.
`value` is a variant expression and `path` a JSON path below it.
"""

from __future__ import annotations

from pyspark.sql.types import DataType

from tremorlake.functions.scalars import FIRST_EPOCH_MS, LAST_EPOCH_MS

# Texts a falsy value that is no text can show as.
FALSY_SHOWN = ("0", "0.0", "-0.0", "false", "[]", "{}")
FALSY_LIST = ", ".join(f"'{shown}'" for shown in FALSY_SHOWN)

_INT_TEXT = "^[ ]*[+-]?[0-9]+[ ]*$"
_INFINITY = "double('Infinity')"


def get(value: str, path: str, to: str) -> str:
    """The value at the path in the type; null when absent or not convertible.

    An object becomes a struct in one pass, by the same rule for each field.
    """
    return f"try_variant_get({value}, '{path}', '{to}')"


def leaf(value: str, path: str) -> str:
    """The value at the path: SQL null when absent, a variant null for JSON null."""
    return get(value, path, "variant")


def kind(value: str, path: str) -> str:
    """Type name of the value at the path, e.g. STRING; null when absent."""
    return f"schema_of_variant({leaf(value, path)})"


def safe_cast(expression: str, to: DataType, default: str) -> str:
    """The expression in the target type; the default if it is null or does not fit."""
    kind_of = to.simpleString()
    return f"coalesce(try_cast({expression} AS {kind_of}), CAST({default} AS {kind_of}))"


def _other_falsy(shown: str, value: str, path: str) -> str:
    """Zero, false or an empty container; `shown` is the value at the path as text.

    Only if that looks like a falsy value is the type at the path looked up.
    """
    return f"({shown} IN ({FALSY_LIST}) AND {kind(value, path)} <> 'STRING')"


def is_falsy(value: str, path: str) -> str:
    """Absent, null, empty text, zero, false and empty containers."""
    shown = get(value, path, "string")
    return f"(coalesce({shown} = '', true) OR {_other_falsy(shown, value, path)})"


def falsy_to_empty(shown: str, value: str, path: str) -> str:
    """The text at the path, with every falsy value turned into the empty text."""
    return f"CASE WHEN {_other_falsy(shown, value, path)} THEN '' ELSE coalesce({shown}, '') END"


def exact_epoch(ms: str, value: str, path: str) -> str:
    """Epoch milliseconds `ms` as read from the path.

    Falsy gives null; anything else that is not an integer counts as zero. An
    integer other than zero is neither, so nothing more is looked up for it.
    """
    return f"CASE WHEN {ms} <> 0 THEN {ms} WHEN NOT {is_falsy(value, path)} THEN 0L END"


def in_calendar(epoch_ms: str) -> str:
    return f"({epoch_ms} BETWEEN {FIRST_EPOCH_MS} AND {LAST_EPOCH_MS})"


def epoch_out_of_range(value: str, path: str) -> str:
    """An epoch that is an integer but no calendar time can show."""
    outside = f"NOT {in_calendar(get(value, path, 'double'))}"
    shown = get(value, path, "string")
    is_int = f"({kind(value, path)} <> 'STRING' OR {shown} RLIKE '{_INT_TEXT}')"
    return f"({outside} AND {is_int})"


def is_infinite(value: str, path: str) -> str:
    """A JSON number too large for a double, e.g. 1e400."""
    infinite = f"abs({get(value, path, 'double')}) = {_INFINITY}"
    return f"({infinite} AND {kind(value, path)} <> 'STRING')"


def any_of(checks: list[str]) -> str:
    """Whether one of the checks holds; a check that gives null does not."""
    return " OR ".join(f"coalesce({check}, false)" for check in checks)
