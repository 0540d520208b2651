"""Readers for landed feeds, and the seed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import charset, clock
from ..operators.keyed import first_per_key

# The market indexes to follow.
INDEX_ROWS = [
    ("^GSPC", "S&P 500"),
    ("^DJI", "Dow Jones Industrial Average"),
    ("^IXIC", "NASDAQ"),
    ("^VIX", "CBOE Volatility Index"),
    ("^RUT", "Russell 2000"),
    ("^FTW5000", "Wilshire 5000"),
]

# Metadata key -> symbol column.
METADATA_KEYS = {
    "shortName": "short_name",
    "sector": "sector",
    "industry": "industry",
    "exchange": "exchange",
    "website": "website",
    "cik": "cik",
    "currency": "currency",
    "country": "country",
}


def read_landed(spark: SparkSession, path: str | list[str], schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Landed files with their declared schema. ``fmt`` is parquet, orc, json or csv (with header)."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.format(fmt).load(path)


def page_files(files: DataFrame) -> DataFrame:
    """Pages as landed bytes (page_id, url, body) from the binary file source, streaming or not. The page id
    is the number that a file's name begins with, else a hash of its path."""
    number = F.regexp_extract("path", r"/([0-9]{1,18})[^/]*$", 1).try_cast("long")
    return files.select(
        F.coalesce(number, F.xxhash64("path")).alias("page_id"), F.col("path").alias("url"), F.col("content").alias("body")
    )


def read_page_files(spark: SparkSession, path: str | list[str], names: str = "*") -> DataFrame:
    """One page per file below a folder; ``names`` is a pattern of file names."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", names)
    return page_files(reader.load(path))


def decode_pages(landed: DataFrame, encoding: str | None = None, *, fail_fast: bool = False) -> tuple[DataFrame, DataFrame]:
    """(pages, undecodable pages with ``violations``) from landed bytes (page_id, url, body).

    A column ``charset``, or ``encoding`` for all pages, is what the server declared; see
    ``charset.charset_of``. ``fail_fast`` raises on the first page that can't be decoded.
    """
    declared = F.col("charset") if "charset" in landed.columns else F.lit(encoding) if encoding else None
    named = landed.withColumn("_charset", charset.charset_of(F.col("body"), declared))
    read = named.withColumn("html", charset.decoded(F.col("body"), F.col("_charset")))
    why = (
        F.when(F.col("body").isNull(), F.lit("page has no bytes"))
        .when(~F.col("_charset").isin(*charset.LABELS), F.concat(F.lit("unknown charset "), "_charset"))
        .otherwise(F.concat(F.lit("bytes are not "), "_charset"))
    )
    columns = schemas.PAGES.fieldNames()
    if fail_fast:
        message = F.concat(F.lit("page "), F.col("page_id").cast("string"), F.lit(": "), why)
        read = read.withColumn("html", F.when(F.col("html").isNull(), F.raise_error(message)).otherwise(F.col("html")))
        return read.select(*columns), landed.filter(F.lit(False)).withColumn("violations", F.array(F.lit("")))
    lost = read.filter(F.col("html").isNull())
    # A filter would be moved before the decoding and decode every page once more.
    known = read.select(*[c for c in columns if c != "html"], F.explode(F.array_compact(F.array("html"))).alias("html"))
    return known.select(*columns), lost.select(*landed.columns, F.array(why).alias("violations"))


def read_prices(
    spark: SparkSession, path: str | list[str], window: tuple[str, str] | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Long OHLCV feed, cut to a half-open date window that reaches the scan."""
    feed = read_landed(spark, path, schemas.OHLCV_LONG, fmt)
    return feed if window is None else feed.filter(clock.in_window(F.col("date"), window))


def typed_rows(rows: DataFrame, schema: T.StructType, required: tuple[str, ...] = ()) -> DataFrame:
    """Landed text rows in their declared types, with ``violations``: texts that are no value of their
    type, and missing ``required`` values. No row is dropped; a broken value is NULL."""
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    said = [
        F.when(F.col(f.name).isNotNull() & typed[f.name].isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}"))
        for f in schema.fields
    ] + [F.when(F.col(c).isNull(), F.lit(f"{c} is required")) for c in required]
    return rows.select(*[typed[c].alias(c) for c in typed], F.array_compact(F.array(*said)).alias("violations"))


def read_actions(
    spark: SparkSession, path: str | list[str], schema: T.StructType, fmt: str = "csv"
) -> tuple[DataFrame, DataFrame]:
    """Landed splits or dividends (``schemas.SPLITS``, ``schemas.DIVIDENDS``): good rows, and bad rows
    with ``violations`` for ``quality.rejects``."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    texts = read_landed(spark, path, as_text if fmt in ("csv", "json") else schema, fmt)
    rows = typed_rows(texts.select(*[F.col(c).cast("string") for c in schema.names]), schema, ("ticker", "action_date"))
    return rows.filter(F.size("violations") == 0).drop("violations"), rows.filter(F.size("violations") > 0)


def index_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(INDEX_ROWS, schemas.INDEX_SEED)


def metadata_columns(metadata: DataFrame) -> DataFrame:
    """One row per symbol with the metadata keys as columns; an absent key is NULL.

    ``info`` is a map, or the JSON text of one. Of repeated symbols the first row counts, by the
    columns in their order with NULL last.
    """
    info: Column = F.col("info")
    if isinstance(metadata.schema["info"].dataType, T.StringType):
        info = F.from_json(info, T.MapType(T.StringType(), T.StringType()))
    picked = [F.try_element_at(info, F.lit(k)).alias(c) for k, c in METADATA_KEYS.items()]
    columns = list(METADATA_KEYS.values())
    return first_per_key(metadata.select("ticker", *picked), ["ticker"], *[F.col(c).asc_nulls_last() for c in columns])


def metadata_values(metadata: DataFrame) -> DataFrame:
    """The rows with ``info`` as VARIANT, whatever its shape: a map, or JSON text with values of any kind
    and depth. Text that is no JSON gives NULL."""
    info = F.col("info")
    if not isinstance(metadata.schema["info"].dataType, T.StringType):
        info = F.to_json(info)
    return metadata.withColumn("info", F.try_parse_json(info))


def metadata_paths(metadata: DataFrame, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per symbol with a column for each path: name -> (path such as ``$.address.city``, type).

    A value of another kind, or an absent path, is NULL; an object or array asked for as text is its
    JSON. Of repeated symbols the first row counts, by the columns in their order with NULL last.
    """
    values = metadata_values(metadata)
    picked = [F.try_variant_get("info", path, kind).alias(name) for name, (path, kind) in paths.items()]
    return first_per_key(values.select("ticker", *picked), ["ticker"], *[F.col(c).asc_nulls_last() for c in paths])


def unknown_keys(metadata: DataFrame, known: tuple[str, ...] = tuple(METADATA_KEYS)) -> DataFrame:
    """(key, kind, n_rows): top-level keys that no column takes, with the kind of their values (``object``,
    ``array``, ``string``, ``bigint``, ...), counted in each task first."""
    values = metadata_values(metadata).select("info").filter(F.col("info").isNotNull())
    spark = metadata.sparkSession
    pairs = values.lateralJoin(spark.tvf.variant_explode(F.col("info").outer())).filter(F.col("key").isNotNull())
    kind = F.lower(F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0))
    return pairs.filter(~F.col("key").isin(*known)).groupBy("key", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n_rows"))
