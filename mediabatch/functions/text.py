"""String expressions with the exact trimming, naming and JSON quoting rules of the data format."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Python str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# UTF-16 code units with a short JSON escape.
SHORT_ESCAPES = {
    "0022": '\\"',
    "005C": "\\\\",
    "0008": "\\b",
    "0009": "\\t",
    "000A": "\\n",
    "000C": "\\f",
    "000D": "\\r",
}


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    """Stripped text, or NULL where nothing is left."""
    s = strip(c)
    return F.when(s != "", s)


def normalized_name(c: Column) -> Column:
    return F.lower(strip(c))


def legacy_safe_name(c: Column) -> Column:
    """File-name form of a creator name, letter case kept."""
    return F.replace(F.trim(F.regexp_replace(c, r"[^\p{L}\p{N} \-_]", "")), F.lit(" "), F.lit("_"))


def safe_name(c: Column) -> Column:
    return F.lower(legacy_safe_name(c))


def _escape_unit(unit: Column) -> Column:
    out = F.when(unit == "0022", F.lit(SHORT_ESCAPES["0022"]))
    for code, text in SHORT_ESCAPES.items():
        if code != "0022":
            out = out.when(unit == code, F.lit(text))
    printable = unit.between("0020", "007E")
    return out.when(printable, F.chr(F.conv(unit, 16, 10).cast("int"))).otherwise(
        F.concat(F.lit("\\u"), F.lower(unit))
    )


def json_quote(c: Column) -> Column:
    """`c` as an ASCII-only JSON string literal.

    Printable ASCII and line breaks need a few replacements; anything else is escaped UTF-16 unit by unit.
    """
    plain = c
    for raw, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        plain = F.replace(plain, F.lit(raw), F.lit(escaped))
    units = F.regexp_extract_all(F.hex(F.encode(c, "UTF-16BE")), F.lit(".{4}"), F.lit(0))
    rare = F.array_join(F.transform(units, _escape_unit), "")
    return F.concat(F.lit('"'), F.when(c.rlike("[^ -~\n\r\t]"), rare).otherwise(plain), F.lit('"'))


def canonical_json(value) -> str:
    """JSON text of a small driver-side value, in the form that gets hashed."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"))


def csv_cell(c: Column) -> Column:
    """One CSV cell, quoted where the text needs it."""
    quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(c.rlike('[",\r\n]'), quoted).otherwise(F.coalesce(c, F.lit("")))
