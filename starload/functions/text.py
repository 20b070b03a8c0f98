"""Text rules of the delimited files: empty fields, escapes, field splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a backslash followed by a letter stands for in the delimited files.
ESCAPES = {"0": "\x00", "b": "\b", "n": "\n", "r": "\r", "t": "\t", "Z": "\x1a"}

NULL_FIELD = r"\N"


def null_if_empty(text: Column) -> Column:
    """Empty text becomes null; blanks stay."""
    return F.when(text != "", text)


def read_fields(line: Column, separator: str = ",") -> Column:
    r"""Array of the values of a line; ``\N`` is null, and a separator after a backslash is data.

    Lines without a backslash, nearly all of them, take the plain split.
    """
    literal = separator if separator.isalnum() or separator in ",;" else "\\" + separator
    raw = F.regexp_extract_all(
        F.concat(F.lit(separator), line),
        F.lit(rf"(?s){literal}((?:[^\\{literal}]++|\\.?+)*+)"),
        F.lit(1),
    )
    escaped = F.transform(raw, _unescape)
    return F.when(F.contains(line, F.lit("\\")), escaped).otherwise(F.split(line, literal, -1))


def _unescape(field: Column) -> Column:
    r"""``\x`` is its meaning or plain ``x``; the whole field ``\N`` is null.

    Each pattern starts where the last match ended and steps over the other escapes whole, so a
    pair of backslashes is never read as the start of the next escape.
    """
    plain = field
    for letter, meaning in ESCAPES.items():
        plain = F.regexp_replace(plain, rf"(?s)\G((?:[^\\]++|\\[^{letter}])*+)\\{letter}", "$1" + meaning)
    plain = F.regexp_replace(plain, r"(?s)\\(.)", "$1")
    return F.when(field != NULL_FIELD, plain)
