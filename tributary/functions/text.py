from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters that count as white space, ASCII separators included.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_RUN = f"[{WHITE_SPACE}]+"


def clean_sku(sku: Column) -> Column:
    """Trim, collapse inner white space to one blank, empty to null; case is kept."""
    one_blank = F.trim(F.regexp_replace(sku.cast("string"), SPACE_RUN, " "))
    return F.nullif(one_blank, F.lit(""))


def sku_key(sku: Column) -> Column:
    """Key under which SKUs of one channel are matched: trimmed, case folded."""
    return F.lower(F.btrim(sku, F.lit(WHITE_SPACE)))


def row_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """One row as a JSON object: nulls and NaN written as null, other than numbers as text."""
    fields = []
    for name in columns or df.columns:
        kind = df.schema[name].dataType
        value = F.col(name)
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value)
        elif not isinstance(kind, (T.StringType, T.IntegralType, T.BooleanType)):
            value = value.cast("string")
        fields.append(value.alias(name))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
