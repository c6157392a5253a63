"""Helpers for tables whose column names are not known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


class Table:
    """A table under positional column names, so that added columns never clash with its own."""

    def __init__(self, df: DataFrame):
        self.names = df.columns
        self.own = [f"c{i}" for i in range(len(self.names))]
        self.df = df.toDF(*self.own)

    def at(self, name: str) -> str:
        return self.own[self.names.index(name)]

    def col(self, name: str) -> Column:
        return F.col(self.at(name))

    def restore(self, df: DataFrame, *added: str) -> DataFrame:
        """The table's columns under their names and then ``added`` ones, which replace namesakes."""
        keep = [F.col(c).alias(n) for c, n in zip(self.own, self.names) if n not in added]
        return df.select(*keep, *added)


def schema_with(df: DataFrame, **added: T.DataType) -> T.StructType:
    """The schema of ``df`` with columns added or given another type, all nullable."""
    fields = [T.StructField(f.name, added.get(f.name, f.dataType)) for f in df.schema]
    return T.StructType(fields + [T.StructField(n, t) for n, t in added.items() if n not in df.columns])
