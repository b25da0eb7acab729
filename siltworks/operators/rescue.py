"""Keep values that do not fit their declared type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"
#: A record that can't be cut into the fields it should have, as it was written.
RECORD = "_record"


def fits(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """Whether a value keeps all of itself as ``target``: cast back, it is the same value.

    Text has many spellings of one value, so of text only the cast itself is asked, and that no
    time of day is cut off. NULL fits everywhere.
    """
    if source == target:
        return F.lit(True)
    cast = column.try_cast(target)
    if isinstance(source, (T.StringType, T.CharType, T.VarcharType)):
        kept = cast.isNotNull()
        if isinstance(target, T.DateType):
            moment = column.try_cast(T.TimestampNTZType())
            kept &= moment.isNull() | (moment == cast.cast(T.TimestampNTZType()))
    else:
        kept = cast.isNotNull() & cast.try_cast(source).eqNullSafe(column)
    return column.isNull() | kept


def rescue_types(df: DataFrame, schema: T.StructType, rescued: str = RESCUED) -> DataFrame:
    """Cast columns to ``schema``; a value that a cast would change goes to a JSON column by name.

    Columns of ``df`` outside the schema are rescued as well, whatever their value, so added
    source columns are never lost, and so is the text of a column ``RECORD``.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    known = [f for f in schema.fields if f.name in types]
    extra = [c for c in df.columns if c not in schema.fieldNames() and (c == RECORD or not c.startswith("_"))]
    whole = {f.name: fits(F.col(f"`{f.name}`"), types[f.name], f.dataType) for f in known}
    misfits = []
    for name, fit in whole.items():
        misfits += [F.lit(name), F.when(~fit, F.col(f"`{name}`").cast("string"))]
    for name in extra:
        misfits += [F.lit(name), F.col(f"`{name}`").cast("string")]
    kept = F.map_filter(F.create_map(*misfits), lambda _, v: v.isNotNull())
    typed = [F.when(whole[f.name], F.col(f"`{f.name}`").try_cast(f.dataType)).alias(f.name) for f in known]
    passed_on = [F.col(c) for c in df.columns if c.startswith("_") and c not in (*schema.fieldNames(), RECORD)]
    return df.select(*typed, *passed_on, F.when(F.size(kept) > 0, F.to_json(kept)).alias(rescued))
