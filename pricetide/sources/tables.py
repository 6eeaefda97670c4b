"""Shop tables on disk: shards, per-store tables, the topic workbook."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from pricetide import schema as S
from pricetide.session import stage

PARTS = [
    T.StructField("store", T.StringType()),
    T.StructField("chunk", T.IntegerType()),
    T.StructField("run", T.StringType()),
]
# Order of shard rows when shards are concatenated.
SHARD_ORDER = ["_file", "_row"]
FILES = "file string, rows long, modified long, error string"


def shard_schema(store: str | None = None) -> T.StructType:
    fields = S.BRONZE.fields if store is None else [T.StructField(h, T.StringType()) for h in S.SHOPS[store].headers]
    return T.StructType([*fields, *PARTS])


def checked_shards(spark: SparkSession, root: str, store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of the whole shard files below ``root`` (``store=/chunk=/run=``), and all its files.

    Rows have their file and row number (``_file``, ``_row``). Files are ``file, rows, modified, error``: a file is whole if
    Spark's scan decoded as many rows as its footer states, else ``error`` says what was read and no row of it is taken. A
    file that holds no row cannot be told from one without a footer: it is listed as well, and gives nothing either way.

    Each file is decoded by blocks in all columns of the schema, and only counts per file are kept; the footers are counted by a
    scan without columns. If all files are whole, the rows are read from them by a scan that fails on any damage; else from a
    staged table of what was decoded. Nothing passes through the driver but the reader's own file index.
    """
    path = f"{root}/store={'*' if store is None else store}/chunk=*/run=*"
    reader = spark.read.schema(shard_schema(store)).option("basePath", root).option("pathGlobFilter", "*.parquet")
    names = spark.read.format("binaryFile").option("basePath", root).option("pathGlobFilter", "*.parquet")
    try:
        # What cannot be decoded ends its block here, and shows as rows that are missing.
        shards = reader.option("ignoreCorruptFiles", "true").parquet(path)
        listed = names.load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition()):
            raise
        extra = [T.StructField("_file", T.StringType()), T.StructField("_row", T.LongType())]
        none = spark.createDataFrame([], T.StructType([*shard_schema(store).fields, *extra]))
        return none, spark.createDataFrame([], FILES)
    found = _judged(shards, listed, shards.select(F.col(_FILE).alias("file"), _cell_bytes(shards).alias("bytes")))
    if found.where("error IS NOT NULL").isEmpty():
        rows = _placed(reader.option("ignoreCorruptFiles", "false").parquet(path))
    else:
        # The rows that are taken must be those that were counted, or a file that breaks later would be read in part.
        rows = stage(_placed(shards), "shards")
        found = _judged(shards, listed, rows.select(F.col("_file").alias("file"), F.lit(0).alias("bytes")))
    # Files that came meanwhile are not among those found: no row of them is taken.
    whole = found.where("error IS NULL").select(F.col("file").alias("_file"))
    return rows.join(whole, "_file", "left_semi").select(rows.columns), found


_FILE = "_metadata.file_path"


def _placed(shards: DataFrame) -> DataFrame:
    return shards.select("*", F.col(_FILE).alias("_file"), F.col("_metadata.row_index").alias("_row"))


def _cell_bytes(shards: DataFrame) -> Column:
    """Size of a row's cells: every cell of the files has to be decoded for it."""
    sizes = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in shards.schema.fields if f.name not in {p.name for p in PARTS}]
    return reduce(lambda x, y: x + y, sizes)


def _judged(shards: DataFrame, listed: DataFrame, read_rows: DataFrame) -> DataFrame:
    """``file, rows, modified, error`` of the listed files, from ``file, bytes`` of the rows that were decoded."""
    modified = F.unix_millis("_metadata.file_modification_time")
    stated = shards.select(F.col(_FILE).alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("stated"))
    # The sum is looked at below, or no cell would be decoded.
    counted = read_rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("bytes").cast("bigint")).alias("bytes"))
    found = listed.select(F.col(_FILE).alias("file"), modified.alias("modified")).join(stated, "file", "left").join(counted, "file", "left")
    read, footer = F.when(F.col("bytes") >= 0, F.col("rows")).otherwise(F.lit(0)), F.col("stated")
    error = F.when(footer.isNull(), "no footer with rows").when(
        read != footer, F.concat(read.cast("string"), F.lit(" of "), footer.cast("string"), F.lit(" rows decoded"))
    )
    return stage(found.select("file", read.alias("rows"), "modified", error.alias("error")), "shard-files")


def shard_files(spark: SparkSession, root: str, store: str | None = None) -> DataFrame:
    """``file, rows, modified, error`` of the shard files below ``root``."""
    return checked_shards(spark, root, store)[1]


def read_shards(spark: SparkSession, root: str, store: str | None = None) -> DataFrame:
    """Shard tables below ``root`` with their file and row number; damaged files are left out."""
    return checked_shards(spark, root, store)[0]


def read_registered(spark: SparkSession, root: str, stores: dict[str, str], schema=None) -> tuple[dict, list[str]]:
    """Tables of the registry that exist below ``root``, by store, and the stores without one."""
    found, missing = {}, []
    for store, name in stores.items():
        reader = spark.read if schema is None else spark.read.schema(schema)
        try:
            found[store] = reader.parquet(f"{root}/{name}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e.getCondition()):
                raise
            missing.append(store)
    return found, missing


def read_workbook(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All sheets of a workbook table; the sheet name is the partition column ``store``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("basePath", path).parquet(path)


def stage_input(spark: SparkSession, pending: DataFrame | None, links: DataFrame | None, discover) -> DataFrame:
    """Work list by precedence: pending rows, then a stored link list, then discovery."""
    if pending is not None and not pending.isEmpty():
        return pending
    return links if links is not None else discover()
