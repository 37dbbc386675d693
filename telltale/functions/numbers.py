"""Numbers that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Sign, digits and perhaps a fraction: the shapes whose whole part can be cut out.
_PLAIN = r"^\s*[+-]?\d+(\.\d*)?\s*$"


def truncated_int(text: Column) -> Column:
    """Whole part of a decimal text, cut toward zero; NULL if it is none.

    ``'190.857'`` is 190 and ``'-0.9'`` is 0; texts beyond the range of INT are
    NULL. A direct cast of such text to INT fails (or gives NULL with
    ``try_cast``), and one by way of DOUBLE rounds a long run of nines up. Plain
    texts are cut at the point; the rest (``'.5'``, ``'1e3'``) takes the slower
    way over DECIMAL(38,27), whose 11 whole digits cover every INT.
    """
    text = text.cast("string")
    return F.when(
        text.rlike(_PLAIN), F.substring_index(text, ".", 1).try_cast("int")
    ).otherwise(text.try_cast("decimal(38,27)").try_cast("int"))


def number(text: Column) -> Column:
    """DOUBLE value of a text that may carry blanks; NULL if it is no number."""
    return text.cast("string").try_cast("double")
