"""Text helpers whose results must agree with Python's str and float rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Characters that Python's str.strip() and str.split() treat as blank (fixed values).
BLANKS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
          "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
          "\u2028\u2029\u202f\u205f\u3000")
BLANK_RUN = r"(?U)[\s\x1c-\x1f]+"

# What float() reads, apart from non-ASCII digits.
FLOAT_TEXT = (r"(?i)^[+-]?(inf|infinity|nan|"
              r"(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?)$")
INT_TEXT = r"^[+-]?\d+(_\d+)*$"


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(BLANKS))


def collapse(text: Column) -> Column:
    return F.regexp_replace(text, BLANK_RUN, " ")


def header_label(raw: Column) -> Column:
    """Label as compared during layout detection: null is empty text."""
    return F.lower(strip(F.coalesce(raw, F.lit(""))))


def mapping_label(raw: Column) -> Column:
    """Label as compared during name mapping."""
    return collapse(F.lower(strip(raw)))


def analyte_label(raw: Column) -> Column:
    return collapse(F.translate(mapping_label(raw), "-_", "  "))


def text_or_null(raw: Column) -> Column:
    return F.nullif(strip(raw), F.lit(""))


def strict_double(text: Column) -> Column:
    """Double that Python's float() would read from the text, else null."""
    s = strip(text)
    return F.when(s.rlike(FLOAT_TEXT), F.replace(s, F.lit("_"), F.lit("")).try_cast("double"))


def double_text(value: Column) -> Column:
    """Python's str(float) of a double."""
    java = value.cast("string")
    sign = F.when(java.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    mantissa = F.regexp_extract(java, r"^-?([0-9.]+)E", 1)
    exponent = F.regexp_extract(java, r"E(-?\d+)$", 1).try_cast("int")
    digits = F.regexp_replace(F.replace(mantissa, F.lit("."), F.lit("")), r"0+$", "")
    digits = F.when(digits == "", "0").otherwise(digits)
    whole = F.rpad(F.substring(digits, 1, 17), 17, "0").substr(F.lit(1), exponent + 1)
    tail = F.substr(digits, exponent + 2)
    shifted = F.concat(sign, whole, F.lit("."), F.when(tail == "", "0").otherwise(tail))
    scientific = F.concat(
        sign, digits.substr(1, 1),
        F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise(""),
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.lpad(F.abs(exponent).cast("string"), 2, "0"))
    return (
        F.when(F.isnan(value), "nan")
        .when(java == "Infinity", "inf")
        .when(java == "-Infinity", "-inf")
        .when(~java.contains("E"), java)
        .when(exponent == -4, F.concat(sign, F.lit("0.000"), digits))
        .when((exponent >= 7) & (exponent < 16), shifted)
        .otherwise(scientific)
    )


def quoted(text: Column) -> Column:
    """Python's repr() of a printable text."""
    body = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for char, escape in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(char), F.lit(escape))
    single, double = text.contains("'"), text.contains('"')
    return (
        F.when(single & ~double, F.concat(F.lit('"'), body, F.lit('"')))
        .when(single, F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'")))
        .otherwise(F.concat(F.lit("'"), body, F.lit("'")))
    )


def ratio_text(part: Column, whole: Column) -> Column:
    """'%.2f' of part/whole for positive integers, rounded as Python rounds it.

    Python rounds the binary value exactly.  Away from a tie that equals rounding
    the true ratio; at a tie the sign of (double ratio - tie) decides, and a true
    binary tie goes to the even digit.  Splitting the double in two short halves
    keeps the multiplication by 200 exact.
    """
    ratio = part.cast("double") / whole
    twice = part.cast("bigint") * 200
    is_tie = (twice % whole == 0) & ((twice / whole) % 2 == 1)
    below = F.floor(part.cast("bigint") * 100 / whole)
    nearest = F.floor((twice + whole) / (whole * 2))
    upper = ratio.cast("float").cast("double")
    excess = (upper * 200 - twice / whole) + (ratio - upper) * 200
    at_tie = (F.when(excess > 0, below + 1).when(excess < 0, below)
              .otherwise(below + below % 2))
    hundredths = F.when(is_tie, at_tie).otherwise(nearest)
    return F.concat(F.floor(hundredths / 100).cast("string"), F.lit("."),
                    F.lpad((hundredths % 100).cast("string"), 2, "0"))
