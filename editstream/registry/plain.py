"""Results with scalar columns only, so that two engines can be compared by value."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _scalar(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    if isinstance(kind, T.DateType):
        return F.date_format(column, "yyyy-MM-dd")
    if isinstance(kind, T.ArrayType):
        return F.array_join(column, "|")
    if isinstance(kind, T.MapType):
        return F.array_join(F.map_keys(column), "|")
    if isinstance(kind, T.DecimalType):
        return column.cast("double")
    if isinstance(kind, T.IntegerType):
        return column.cast("long")
    return column


def plain(df: DataFrame) -> DataFrame:
    """Times as text, arrays and map keys joined by ``|``, struct fields as own columns."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StructType):
            columns += [
                _scalar(column[part.name], part.dataType).alias(f"{field.name}_{part.name}")
                for part in field.dataType.fields
            ]
        else:
            columns.append(_scalar(column, field.dataType).alias(field.name))
    return df.select(columns)
