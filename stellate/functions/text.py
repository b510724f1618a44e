"""Text cleaning (SC-1..5)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters with the Unicode White_Space property. Spark's one-argument
# trim removes the ASCII space only.
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Gender code -> label, and the label of everything else.
GENDER_LABELS = {"M": "Male", "F": "Female"}
GENDER_OTHER = "Unknown"


def clean(text: Column | str) -> Column:
    """Strip all leading and trailing white space, in one linear pass per value."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def clean_upper(text: Column | str) -> Column:
    return F.upper(clean(text))


def clean_lower(text: Column | str) -> Column:
    return F.lower(clean(text))


def gender_label(code: Column | str) -> Column:
    """Label of a gender code; case is ignored, padding is not, NULL is the other label."""
    code = F.upper(F.coalesce(code, F.lit("")))
    label = F.lit(GENDER_OTHER)
    for value, name in GENDER_LABELS.items():
        label = F.when(code == value, name).otherwise(label)
    return label
