"""A source read in ranges of one column, several tasks at once: Parquet files, or a database with a Python driver.

The counterpart of a partitioned JDBC read for databases that have a Python driver only, and for extracts kept as
files. What a query asks of the range column decides which ranges are read at all.
"""

from __future__ import annotations

import datetime as dt
import importlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
)
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

NAME = "apportia_ranges"
BATCH = 10_000
SIGNS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", In: "in"}
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)

#: A condition: column, sign, value; the sign "null" asks for nulls.
Condition = tuple[str, str, object]


@dataclass
class Span(InputPartition):
    """The rows a task reads: all conditions of one of the lists in ``either``."""

    either: tuple[tuple[Condition, ...], ...]


def literal(text: str, kind: T.DataType):
    """A bound given as text, as a value of the range column."""
    if isinstance(kind, WHOLE):
        return int(text)
    if isinstance(kind, T.DateType):
        return dt.date.fromisoformat(text)
    at = dt.datetime.fromisoformat(text)
    if isinstance(kind, T.TimestampNTZType):
        return at.replace(tzinfo=None)
    return at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)


def cuts(low, high, n: int) -> list:
    """At most n - 1 bounds that cut low..high evenly, the ends not among them."""
    if high <= low:
        return []
    found = {low + (high - low) * i // n if not isinstance(low, dt.date) else low + (high - low) * i / n for i in range(1, n)}
    return sorted(c for c in found if low < c < high)


def narrowed(low, high, asked: list[tuple[str, object]]) -> tuple[object, object, bool, bool]:
    """(low, high, open below, open above): the declared range, cut to what the conditions leave."""
    floors = [v for sign, v in asked if sign in ("=", ">", ">=")] + [min(v) for sign, v in asked if sign == "in"]
    roofs = [v for sign, v in asked if sign in ("=", "<", "<=")] + [max(v) for sign, v in asked if sign == "in"]
    floor, roof = max(floors, default=None), min(roofs, default=None)
    return (low if floor is None else floor), (high if roof is None else roof), floor is None, roof is None


def spans(column: str, low, high, n: int, asked: list[tuple[str, object]]) -> list[Span]:
    """Ranges that together hold every row the conditions on the column leave, each row once.

    Without conditions the first range takes what is below ``low`` and nulls too, the last what is above
    ``high``. A condition moves the ends to it, and the narrower range is cut into as many parts; conditions
    that exclude each other leave no range.
    """
    low, high, below, above = narrowed(low, high, asked)
    if not below and not above and high < low:
        return []
    bounds = cuts(low, high, n)
    first = [None] if below else [low]
    parts = []
    for start, stop in zip(first + bounds, bounds + [None]):
        part = [] if start is None else [(column, ">=", start)]
        if stop is not None:
            part.append((column, "<", stop))
        elif not above:
            part.append((column, "<=", high))
        parts.append([tuple(part)])
    if not asked and parts[0][0]:
        parts[0].append(((column, "null", None),))
    return [Span(tuple(p)) for p in parts]


def marked(style: str, place: int) -> str:
    """The mark of a bound value in the statement, by the driver's paramstyle."""
    return {"qmark": "?", "format": "%s", "pyformat": "%s", "numeric": f":{place}"}[style]


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def statement(relation: str, columns: list[str], either, also, style: str = "qmark") -> tuple[str, list]:
    """SELECT of a span, values bound: ``also`` are conditions on every row."""
    values: list = []

    def bind(value) -> str:
        values.append(value)
        return marked(style, len(values))

    def term(c: Condition) -> str:
        name, sign, value = c
        if sign == "null":
            return f"{quoted(name)} IS NULL"
        if sign == "in":
            return f"{quoted(name)} IN ({', '.join(bind(v) for v in value)})"
        return f"{quoted(name)} {sign} {bind(value)}"

    ands = [term(c) for c in also]
    ors = [" AND ".join(term(c) for c in part) for part in either if part]
    if ors:
        ands.append("(" + " OR ".join(f"({o})" for o in ors) + ")")
    where = f" WHERE {' AND '.join(ands)}" if ands else ""
    return f"SELECT {', '.join(map(quoted, columns))} FROM {relation}{where}", values


def expression(either, also, schema: pa.Schema) -> ds.Expression | None:
    """The same as a condition on files, values written in the type the files have."""

    def value(name: str, v):
        kind = schema.field(name).type
        if pa.types.is_timestamp(kind) and kind.tz is None and v.tzinfo:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return pa.scalar(v).cast(kind)

    def term(c: Condition) -> ds.Expression:
        name, sign, v = c
        field = ds.field(name)
        if sign == "null":
            return field.is_null()
        if sign == "in":
            return field.isin([value(name, x) for x in v])
        v = value(name, v)
        return {"=": field == v, ">": field > v, ">=": field >= v, "<": field < v, "<=": field <= v}[sign]

    def joined(terms, with_and: bool):
        out = None
        for t in terms:
            out = t if out is None else (out & t if with_and else out | t)
        return out

    span = joined([joined([term(c) for c in part], True) for part in either if part], False)
    return joined([t for t in (*map(term, also), span) if t is not None], True)


def located(path: str) -> dict:
    if "://" not in path:
        return {"source": path}
    files, inner = fs.FileSystem.from_uri(path)
    return {"source": inner, "filesystem": files}


class RangeSource(DataSource):
    """Options: column, low, high, parts, and either path (Parquet) or driver, connect and table or query.

    driver: a module with the Python database interface, importable on the executors; connect: what its
    ``connect`` takes. Files give their own schema; a database needs ``schema(...)``.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        if "path" not in self.options:
            raise ValueError("a database source needs a schema")
        found = from_arrow_schema(ds.dataset(**located(self.options["path"]), format="parquet").schema, prefer_timestamp_ntz=True)
        return T.StructType([T.StructField(f.name, f.dataType) for f in found])  # as Spark reads files: nulls allowed

    def reader(self, schema: T.StructType) -> RangeReader:
        return RangeReader(schema, dict(self.options))


class RangeReader(DataSourceReader):
    """Reads the spans that the pushed conditions leave; Spark checks every condition again on what comes."""

    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema, self.options, self.also = schema, options, []
        self.column = options["column"]
        kind = schema[self.column].dataType
        if not isinstance(kind, (*WHOLE, *TIMES)):
            raise ValueError(f"{self.column} is {kind.simpleString()}; ranges need whole numbers, dates or times")
        self.low, self.high = literal(options["low"], kind), literal(options["high"], kind)
        self.parts = int(options.get("parts", 8))
        if self.parts < 1 or self.high < self.low:
            raise ValueError("parts must be at least 1, and low at most high")

    def condition(self, f: Filter) -> Condition | None:
        """A filter the source can apply without losing rows that Spark would keep.

        Floating numbers are left out (Spark orders NaN above all), and of text anything but equality, whose
        order depends on the database.
        """
        sign = SIGNS.get(type(f))
        if sign is None or len(f.attribute) != 1 or f.attribute[0] not in self.schema.names:
            return None
        kind = self.schema[f.attribute[0]].dataType
        values = f.value if sign == "in" else (f.value,)
        if not values or any(v is None for v in values):
            return None
        if isinstance(kind, (*WHOLE, *TIMES)) or (isinstance(kind, T.StringType) and sign in ("=", "in")):
            return f.attribute[0], sign, tuple(values) if sign == "in" else f.value
        return None

    def pushFilters(self, filters: list[Filter]):
        self.also = [c for c in map(self.condition, filters) if c]
        return filters

    def partitions(self) -> list[Span]:
        asked = [(sign, v) for name, sign, v in self.also if name == self.column]
        # a reader has at least one task; one whose range is empty stands for none
        return spans(self.column, self.low, self.high, self.parts, asked) or [Span((((self.column, "null", None),),))]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(self.schema)
        batches = self.files(partition) if "path" in self.options else self.database(partition, target)
        for b in batches:
            if b.num_rows:
                yield from pa.Table.from_batches([b]).cast(target).to_batches()

    def files(self, span: Span) -> Iterator[pa.RecordBatch]:
        data = ds.dataset(**located(self.options["path"]), format="parquet")
        yield from data.to_batches(columns=self.schema.names, filter=expression(span.either, self.also, data.schema), batch_size=BATCH)

    def database(self, span: Span, target: pa.Schema) -> Iterator[pa.RecordBatch]:
        driver = importlib.import_module(self.options["driver"])
        relation = f"({self.options['query'].rstrip(' ;')}) src" if "query" in self.options else self.options["table"]
        connection = driver.connect(self.options["connect"])
        try:
            cursor = connection.cursor()
            cursor.execute(*statement(relation, self.schema.names, span.either, self.also, driver.paramstyle))
            while rows := cursor.fetchmany(BATCH):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), target)], schema=target)
        finally:
            connection.close()


def read_ranges(spark: SparkSession, column: str, low, high, parts: int = 8, schema=None, **where: str) -> DataFrame:
    """A source read in ``parts`` ranges of a column; ``where`` are the options that name it (see RangeSource).

    Rows outside low..high and those without a value are read too, by the first and last range. Only the
    columns of ``schema`` are asked of the source, where one is given. Sets the session's switch that hands
    filters to such sources.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RangeSource)
    reader = spark.read.format(NAME).options(column=column, low=str(low), high=str(high), parts=str(parts), **where)
    return (reader.schema(schema) if schema else reader).load()
