"""Type inference for feeds whose columns arrive as text."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

NUMERIC_RATIO = 0.90
DATE_RATIO = 0.85
LARGEST_EXACT = 2**53 - 1
#: Text that may be a date has one of these at least.
DATE_MARKS = r"[-/:T]"
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd", "MM/dd/yyyy", "yyyy-MM-dd'T'HH:mm:ss")




def _as_time(c):
    return F.coalesce(*(F.try_to_timestamp(c, F.lit(f)) for f in DATE_FORMATS))


def decide_types(df: DataFrame, numeric_ratio: float = NUMERIC_RATIO, date_ratio: float = DATE_RATIO, as_text: Collection[str] = ("cik",), keep_large: bool = False) -> dict[str, str]:
    """``double``, ``timestamp`` or ``string`` for each text column, from one aggregate over all rows.

    A column without values is text, as are those of ``as_text``.  It is numeric if enough of its values are; else a date
    if half of its values look like one and enough of them are.  Numbers come first, so 20240101 is one.  With
    ``keep_large`` a column with whole numbers beyond exact doubles stays text."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if not names:
        return {}
    asked = []
    for i, name in enumerate(names):
        c = F.trim(F.col(f"`{name}`"))
        number = c.try_cast("double")
        asked += [
            F.count(c).alias(f"n{i}"), F.count(number).alias(f"d{i}"), F.count(_as_time(c)).alias(f"t{i}"),
            F.count_if(c.rlike(DATE_MARKS)).alias(f"m{i}"), F.count_if(c.rlike(r"^[+-]?\d+$") & (F.abs(number) > LARGEST_EXACT)).alias(f"l{i}"),
        ]
    row, out = df.agg(*asked).first(), {}
    for i, name in enumerate(names):
        n, numbers, times, marked, large = (row[f"{k}{i}"] for k in "ndtml")
        if not n or name in as_text or (keep_large and large):
            out[name] = "string"
        elif numbers / n >= numeric_ratio:
            out[name] = "double"
        elif marked / n >= 0.5 and times / n >= date_ratio:
            out[name] = "timestamp"
        else:
            out[name] = "string"
    return out


def normalize_types(df: DataFrame, **options) -> DataFrame:
    """``df`` with text columns cast as :func:`decide_types` says; values that don't fit become NULL."""
    kinds = decide_types(df, **options)
    casts = {}
    for name, kind in kinds.items():
        c = F.trim(F.col(f"`{name}`"))
        if kind == "double":
            x = c.try_cast("double")
            casts[name] = F.when(~F.isnan(x), x)
        elif kind == "timestamp":
            casts[name] = _as_time(c)
    return df.withColumns(casts) if casts else df
