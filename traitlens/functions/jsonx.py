"""Extraction of JSON objects embedded in free text (model replies).

Contract: every ``{...}`` substring is found left to right, non-greedy, with
``.`` matching newlines; each one is parsed as strict JSON and silently dropped
when it is not valid.  A nested object is therefore cut at its first ``}`` and
dropped, and so is an object whose string value contains ``}``.

Spark's JSON reader is made strict to match: single quotes, comments,
unquoted names, leading zeros, non-numeric numbers (NaN/Infinity), stray
backslash escapes and raw control characters all make a fragment invalid.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import TRAIT_KEYS

OBJECT_PATTERN = r"(?s)\{.*?\}"
CORRUPT_FIELD = "_corrupt"
# A \\ud800-\\udfff escape that is not part of a high-low pair.
LONE_SURROGATE = (
    r"\\u[dD][89abAB][0-9a-fA-F]{2}(?!\\u[dD][c-fC-F][0-9a-fA-F]{2})"
    r"|(?<!\\u[dD][89abAB][0-9a-fA-F]{2})\\u[dD][c-fC-F][0-9a-fA-F]{2}"
)

STRICT_JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT_FIELD,
    "allowSingleQuotes": "false",
    "allowComments": "false",
    "allowUnquotedFieldNames": "false",
    "allowNumericLeadingZeros": "false",
    "allowNonNumericNumbers": "false",
    "allowBackslashEscapingAnyCharacter": "false",
    "allowUnquotedControlChars": "false",
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def object_candidates(text) -> Column:
    """All ``{...}`` fragments of the text (array<string>); null text gives null.

    The search ends at the text's last ``}``: an unclosed ``{`` would be sought to the end of the text, once for each of them.
    Up to there every ``{`` is closed, so each character is passed once.
    """
    whole = _col(text)
    tail = F.substring_index(whole, "}", -1)
    return F.regexp_extract_all(F.substring(whole, F.lit(1), F.length(whole) - F.length(tail)), F.lit(OBJECT_PATTERN), F.lit(0))


def _ddl(keys: Sequence[str]) -> str:
    fields = [f"`{k}` string" for k in keys] + [f"`{CORRUPT_FIELD}` string"]
    return ", ".join(fields)


def _finite(obj: Column, keys: Sequence[str]) -> Column:
    """False when a number overflowed (rendered as a quoted ``"Infinity"``)."""
    out = F.lit(True)
    for k in keys:
        out = out & ~F.coalesce(obj[k].isin('"Infinity"', '"-Infinity"', '"NaN"'), F.lit(False))
    return out


def extract_json_objects(text, keys: Sequence[str] = TRAIT_KEYS) -> Column:
    """array<struct<keys...>> of the valid JSON objects in ``text``.

    Missing keys are null, extra keys are ignored, an empty object ``{}`` is a
    struct of nulls.  Non-string values are rendered as JSON (``1.50`` as ``1.5``).  Numbers beyond the double range and
    escapes of half a surrogate pair make a fragment invalid.
    """
    ddl = _ddl(keys)
    whole = F.filter(object_candidates(text), lambda frag: ~frag.rlike(LONE_SURROGATE))
    parsed = F.transform(whole, lambda frag: F.from_json(frag, ddl, STRICT_JSON_OPTIONS))
    valid = F.filter(parsed, lambda obj: obj[CORRUPT_FIELD].isNull() & _finite(obj, keys))
    return F.transform(valid, lambda obj: F.struct(*[obj[k].alias(k) for k in keys]))


def count_json_objects(text) -> Column:
    """Number of valid objects in ``text`` (int); null text gives null."""
    return F.size(extract_json_objects(text, keys=()))
