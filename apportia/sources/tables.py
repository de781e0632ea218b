"""Scans: sections with declared columns, JDBC, catalog tables, delimited files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from apportia import schemas
from apportia.functions import dates
from apportia.schemas import Section
from apportia.session import cut_lineage

Catalog = dict[str, "str | DataFrame"]


def first_present(df: DataFrame, names) -> str | None:
    """First of the names the frame has, whatever their case."""
    have = {c.lower(): c for c in df.columns}
    return next((have[n.lower()] for n in names if n.lower() in have), None)


def pick(df: DataFrame, names: list[str]) -> DataFrame:
    """Only the wanted columns that exist."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[have[n.lower()] for n in names if n.lower() in have])


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    have = {c.lower() for c in df.columns}
    return df.withColumns({n: v for n, v in defaults.items() if n.lower() not in have})


def resolve(df: DataFrame, section: Section) -> DataFrame:
    """Canonical names and types; a missing column becomes a typed null, a bad value null."""
    cols = []
    for f in section.schema.fields:
        found = first_present(df, (f.name, *section.aliases.get(f.name, ())))
        if found is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif df.schema[found].dataType == f.dataType:
            cols.append(F.col(found).alias(f.name))
        else:
            cols.append(F.col(found).try_cast(f.dataType.simpleString()).alias(f.name))
    return df.select(*cols)


def usable(df: DataFrame, condition: str | None, optional: bool = False) -> Column | None:
    """User predicate; only where it is optional, None if it names columns this section does not have."""
    if not condition:
        return None
    try:
        df.where(condition).schema
    except AnalysisException as e:
        if optional and (e.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            return None
        raise
    return F.expr(condition)


def open_table(spark: SparkSession, catalog: Catalog, name: str, fmt: str = "parquet") -> DataFrame:
    source = catalog[name]
    if isinstance(source, DataFrame):
        return source
    return spark.read.format(fmt).load(source) if "/" in source else spark.read.table(source)


def read_table(
    spark: SparkSession, catalog: Catalog, name: str, where: Column | str | None = None,
    columns: list[str] | None = None, fmt: str = "parquet",
) -> DataFrame:
    """Windowed scan of any table: predicate first, then the columns that exist."""
    df = open_table(spark, catalog, name, fmt)
    if where is not None:
        df = df.where(where)
    return pick(df, columns) if columns else df


def read_section(
    spark: SparkSession, catalog: Catalog, name: str, window: tuple[str, str] | None = None,
    key: str | None = None, where: str | None = None, fmt: str = "parquet",
) -> DataFrame:
    """A document section under its canonical names, filtered on the stored column so that the
    window reaches the scan.

    A main section must be in the catalog and take the predicate; a section beside it that the catalog
    does not list comes back empty, and a predicate on columns it lacks leaves it whole."""
    section = schemas.SECTIONS[name]
    main = name in schemas.MAIN_SECTIONS
    if name not in catalog:
        if main:
            raise KeyError(f"section {name!r} is required")
        return spark.createDataFrame([], section.schema)
    raw = open_table(spark, catalog, name, fmt)
    if window and section.time:
        stored = first_present(raw, (section.time, *section.aliases.get(section.time, ())))
        if stored:
            tests = {
                "timestamp": lambda c: dates.between(c, *window),
                "epoch": lambda c: dates.between_epoch(c, *window),
                "mixed": lambda c: dates.between_mixed(c, *window),
            }
            raw = raw.where(tests[section.time_kind](F.col(stored)))
    if key:
        stored = first_present(raw, ("access_key", *section.aliases.get("access_key", ())))
        if stored:
            raw = raw.where(F.col(stored) == key)
    extra = usable(raw, where, optional=not main)
    if extra is not None:
        raw = raw.where(extra)
    return resolve(raw, section)


def read_reference(
    spark: SparkSession, catalog: Catalog, name: str, required: bool = False
) -> DataFrame:
    """Reference table; an optional one that is absent is empty with its declared columns."""
    schema = schemas.REFERENCES[name]
    if name in catalog:
        return resolve(open_table(spark, catalog, name), Section(schema))
    if required:
        raise KeyError(f"reference {name!r} is required")
    return spark.createDataFrame([], schema)


def read_references(spark: SparkSession, catalog: Catalog) -> dict[str, DataFrame]:
    return {n: read_reference(spark, catalog, n, n == "params") for n in schemas.REFERENCES}


def jdbc_options(
    url: str, table: str | None = None, where: str | None = None, query: str | None = None,
    partition: tuple[str, object, object, int] | None = None, fetch_size: int = 10_000, **props: str,
) -> dict[str, str]:
    """Options of a JDBC read: predicate as a subselect, key range split over tasks."""
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    opts = {"url": url, "fetchsize": str(fetch_size), **props}
    if query:
        if partition:
            opts["dbtable"] = f"({query.rstrip(' ;')}) src"
        else:
            opts["query"] = query.rstrip(" ;")
    else:
        opts["dbtable"] = f"(select * from {table} where {where}) src" if where else table
    if partition:
        column, low, high, n = partition
        opts |= {
            "partitionColumn": column, "lowerBound": str(low), "upperBound": str(high),
            "numPartitions": str(n),
        }
    return opts


def read_jdbc(spark: SparkSession, urls: list[str] | str, columns: list[str] | None = None, **how) -> DataFrame:
    """JDBC table or query; further addresses are tried when the first does not answer."""
    failure = None
    for url in [urls] if isinstance(urls, str) else urls:
        try:
            df = spark.read.format("jdbc").options(**jdbc_options(url, **how)).load()
            return pick(df, columns) if columns else df
        except Exception as e:  # the driver's connection errors have no common type
            failure = e
    raise failure


def read_delimited(
    spark: SparkSession, path: str, sep: str = "|", schema=None, encoding: str = "ISO-8859-1"
) -> DataFrame:
    """Delimited file with a header; all text unless a schema is given."""
    reader = spark.read.options(sep=sep, header=True, encoding=encoding)
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.toDF(*[c.strip() for c in df.columns])


REJECTED = "__line"


def read_checked(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = "|", encoding: str = "ISO-8859-1", store=cut_lineage,
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of delimited files with a header: lines that do not fit the schema are kept as text.

    A line is rejected if it has too few or too many fields or one that its column's type cannot hold; rejects
    have the line and its file. Each line is parsed once: ``store`` holds both, so the line of a row that was
    read is not asked for again without its columns.
    """
    full = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    reader = spark.read.options(sep=sep, header=True, encoding=encoding, mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED, enforceSchema=True)
    parsed = store(reader.schema(full).csv(path).withColumn("__file", F.col("_metadata.file_name")))
    bad = F.col(REJECTED).isNotNull()
    return parsed.where(~bad).select(*schema.names), parsed.where(bad).select(F.col(REJECTED).alias("line"), F.col("__file").alias("file"))


def tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")


def columns_of(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def sample_to_csv(df: DataFrame, path: str, rows: int = 100) -> None:
    df.limit(rows).write.mode("overwrite").option("header", True).csv(path)


def valid_references(
    ref: DataFrame, start: str, stop: str, first, last, **equal
) -> DataFrame:
    """Reference rows whose validity covers the whole window; ``equal`` adds plain conditions."""
    out = ref.where(dates.covers(start, stop, first, last))
    for name, value in equal.items():
        out = out.where(F.col(name) == value)
    return out


def days(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Calendar days of a range."""
    return spark.range(1).select(
        F.explode(
            F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("INTERVAL 1 DAY"))
        ).alias("day")
    )


def day_slices(df: DataFrame, day: str, n: int) -> DataFrame:
    """A day cut into n equal closed intervals with second precision."""
    step = 86_400 / n
    start = F.col(day).cast("timestamp")
    slices = F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda i: F.struct(
            F.timestamp_seconds(F.unix_timestamp(start) + (i * step)).alias("first"),
            F.timestamp_seconds(F.unix_timestamp(start) + ((i + 1) * step) - 1).alias("last"),
        ),
    )
    return df.select("*", F.inline(slices))
