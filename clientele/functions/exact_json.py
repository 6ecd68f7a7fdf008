"""Numbers that keep every digit while JSON is parsed and written again.

Spark writes a parsed fraction back as a double: ``1.10`` becomes ``1.1`` and the 25th digit is lost. Here
every number with a fraction or an exponent is turned into a marked string before parsing, which the parser
copies, and back into a number afterwards. Integers are exact anyway and stay as they are.

The mark is U+0001, which JSON text can only hold as an escape. A string that starts with it gets a second
one, so nothing is taken for a marked number; only text inside a string that itself looks like JSON with
such a mark would be.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ESCAPED = r"\u0001"
#: The quote that opens a string with the mark; a quote after a backslash opens nothing.
_OPEN = r'(?<!\\)"\\u0001'
#: A marked number with its quotes, the first of two marks, or the mark a parsed value starts with.
_MARKED = r'(?<!\\)"\\u0001(-?[0-9][0-9.eE+-]*+)"|(?<=[^\\]")\\u0001(?=\\u0001)|^\x01'
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_INTEGER = r"(?:-?[1-9][0-9]*+|0)(?![0-9.eE])"
_NUMBER = r"-?[0-9]++(?:\.[0-9]++)?+(?:[eE][+-]?[0-9]++)?+"
#: What stands before the next number to mark. ``\G`` ties it to the end of the last one, so a search never
#: starts inside a string; possessive repeats keep it to one pass without recursion.
_NEXT = rf'(?s)\G([^"0-9-]*+(?:(?:{_STRING}|{_INTEGER})[^"0-9-]*+)*+)({_NUMBER})'


def mark_numbers(text: Column) -> Column:
    """JSON text whose fractions are marked strings; text that is no JSON stays no JSON."""
    doubled = F.regexp_replace(text, _OPEN, r'"\\u0001\\u0001')
    text = F.when(text.contains(_ESCAPED), doubled).otherwise(text)
    # Most texts have a point, which is found at far less cost than the pattern.
    fractions = text.contains(".") | text.rlike("[0-9][eE]|-0")
    return F.when(fractions, F.regexp_replace(text, _NEXT, r'$1"\\u0001$2"')).otherwise(text)


def unmark_json(text: Column) -> Column:
    """The JSON text that was marked, with its numbers as they were written."""
    return F.when(text.contains(_ESCAPED), F.regexp_replace(text, _MARKED, "$1")).otherwise(text)


def unmark_value(text: Column) -> Column:
    """A value parsed as text from marked JSON: a number or string, or the JSON of an object or list.

    Most values hold no mark; the pattern, which costs far more than the look for one, is left to the rest.
    """
    marked = text.contains(_ESCAPED) | text.startswith("\x01")
    return F.when(marked, F.regexp_replace(text, _MARKED, "$1")).otherwise(text)
