"""Columns of a table by their exact names, whatever else the table holds."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


def picked(frame: DataFrame, *names: str) -> DataFrame:
    """The columns ``names`` of ``frame``, told apart from others that differ in case only.

    Other columns may have any name, also ones with dots, spaces or the name of a function. Of
    several columns with the very same name the first is taken.
    """
    place = [frame.columns.index(name) for name in names]
    return frame.toDF(*(f"c{i}" for i in range(len(frame.columns)))).select(*(f"c{i}" for i in place)).toDF(*names)


def any_names(*known: str) -> Callable:
    """For an operator on a table: columns other than ``known``, and texts among its arguments, may have any names.

    The operator sees them as x0, x1 ... by place; a result that has the table's columns, or a ``row`` of
    them, gets their names back. Of several columns with the very same name the first is meant. Where no
    column needs it, nothing changes.
    """

    def wrap(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(operator)
        def run(table: DataFrame, *args, **kwargs) -> DataFrame:
            meant = {*known, *(x for x in (*args, *kwargs.values()) if isinstance(x, str))}
            names, safe = table.columns, []
            for i, name in enumerate(names):
                safe.append(name if name in meant and name not in safe else f"x{i}")
            if all(name in meant for name in names) and safe == names:
                return operator(table, *args, **kwargs)
            out = operator(table.toDF(*safe), *args, **kwargs)
            if out.columns == safe:
                return out.toDF(*names)
            if "row" not in out.columns:
                return out
            own = dict(zip(safe, names, strict=True))
            row = StructType([StructField(own[f.name], f.dataType) for f in out.schema["row"].dataType.fields])
            return out.select(*(F.col(c).cast(row).alias(c) if c == "row" else c for c in out.columns))

        return run

    return wrap
