"""A1 for engines with a Python driver (DB-API 2): a partition a month.

``load_sales(spark, {"driver": "pymysql", "table": "...", "connect": '{"host": ...}'})``
reads with any such driver that the executors have. Months are read side by side, each
by its own connection; filters on months, names and numbers go to the engine, so a
filter on the month leaves the other months unread.
"""

from __future__ import annotations

import datetime
import importlib
import json
from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows that a connection is asked for at once.
ROWS = 20_000
_COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
#: Types that any engine compares as Spark does, text by bytes being up to the engine.
_ALIKE = (T.DateType, T.IntegerType, T.LongType)


class Month(InputPartition):
    def __init__(self, month: datetime.date | None) -> None:
        super().__init__(month)


class SalesReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]) -> None:
        self.schema = schema
        self.driver, self.table, self.month = options["driver"], options["table"], options.get("month", "month")
        self.arguments = json.loads(options.get("connect", "{}"))
        self.where: list[str] = []
        self.values: list = []

    def _mark(self) -> str:
        return "?" if importlib.import_module(self.driver).paramstyle == "qmark" else "%s"

    def _connect(self):
        return importlib.import_module(self.driver).connect(**self.arguments)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keeps those that the engine is given; the others are Spark's."""
        for f in filters:
            name = ".".join(f.attribute) if hasattr(f, "attribute") else ""
            kind = self.schema[name].dataType if name in self.schema.names else None
            text = isinstance(kind, T.StringType)
            if isinstance(f, (IsNull, IsNotNull)) and kind is not None:
                self.where.append(f"{name} IS {'NOT ' if isinstance(f, IsNotNull) else ''}NULL")
            elif isinstance(f, EqualNullSafe) and kind is not None and f.value is None:
                self.where.append(f"{name} IS NULL")
            elif type(f) in _COMPARED and isinstance(kind, _ALIKE) and f.value is not None:
                self.where.append(f"{name} {_COMPARED[type(f)]} {self._mark()}")
                self.values.append(_plain(f.value))
            elif isinstance(f, In) and isinstance(kind, _ALIKE) and None not in f.value:
                self.where.append(f"{name} IN ({', '.join([self._mark()] * len(f.value))})")
                self.values += map(_plain, f.value)
            else:
                if isinstance(f, EqualTo) and text and f.value is not None:
                    # an engine may hold more texts for equal than Spark does, never fewer
                    self.where.append(f"{name} = {self._mark()}")
                    self.values.append(f.value)
                yield f

    def _rows(self, what: str, more: str, values: list) -> Iterator[list[tuple]]:
        where = " AND ".join([*self.where, *([more] if more else [])])
        connection = self._connect()
        try:
            cursor = connection.cursor()
            cursor.execute(f"SELECT {what} FROM {self.table}{f' WHERE {where}' if where else ''}", [*self.values, *values])
            while rows := cursor.fetchmany(ROWS):
                yield rows
        finally:
            connection.close()

    def partitions(self) -> list[InputPartition]:
        months = [_date(r[0]) for rows in self._rows(f"DISTINCT {self.month}", "", []) for r in rows]
        return [Month(m) for m in sorted(months, key=lambda m: (m is not None, m))] or [Month(None)]

    def read(self, partition: Month) -> Iterator[pa.RecordBatch]:
        m = partition.value
        more, values = (f"{self.month} IS NULL", []) if m is None else (f"{self.month} = {self._mark()}", [_plain(m)])
        schema = to_arrow_schema(self.schema)
        for rows in self._rows(", ".join(self.schema.names), more, values):
            columns = [[_typed(v, f.dataType) for v in c] for c, f in zip(zip(*rows, strict=True), self.schema.fields, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _plain(v):
    """A date as text, which every driver takes."""
    return v.isoformat() if isinstance(v, datetime.date) else v


def _date(v) -> datetime.date | None:
    return datetime.date.fromisoformat(v[:10]) if isinstance(v, str) else v.date() if isinstance(v, datetime.datetime) else v


def _typed(v, kind: T.DataType):
    if v is None:
        return None
    if isinstance(kind, T.DateType):
        return _date(v)
    if isinstance(kind, T.DecimalType):
        return round(Decimal(str(v)), kind.scale)
    return str(v) if isinstance(kind, T.StringType) else int(v) if isinstance(kind, (T.IntegerType, T.LongType)) else v


class SalesDatabase(DataSource):
    """Options: driver, table, connect (JSON of the driver's arguments), month (the
    column that partitions)."""

    @classmethod
    def name(cls) -> str:
        return "plumbline_database"

    def schema(self) -> T.StructType:
        from .sales import SALES

        return SALES

    def reader(self, schema: T.StructType) -> SalesReader:
        return SalesReader(schema, dict(self.options))
