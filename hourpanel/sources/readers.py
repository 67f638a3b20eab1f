"""Scans: Parquet trees, snapshots, CSV calendars, JSON exports, columnar JSON."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourpanel.functions.scalars import tolerant_date
from hourpanel.functions.wallclock import local_date
from hourpanel.session import materialise
from hourpanel.sources.schemas import TYPES
from hourpanel.sources.tree import Tree


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_tree(
    spark: SparkSession, root: str, schema: T.StructType, partition: str | None = None
) -> DataFrame:
    """Scan a Parquet tree with a declared schema; a missing or empty tree gives an empty frame.

    With ``partition`` (a column that exists only in the path) directories are pruned. Without it
    path keys are ignored, so a key that also sits inside the files keeps its in-file type.
    """
    if not Tree(spark, root).has_parquet():
        return empty(spark, schema)
    if partition is None:
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(root)
    wanted = T.StructType([f for f in schema if f.name != partition])
    typed = schema[partition].dataType if partition in schema.names else T.StringType()
    return spark.read.schema(T.StructType([*wanted, T.StructField(partition, typed)])).parquet(root)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns by name, cast to the declared types, missing ones as null."""
    present = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        )
    )


def union_by_name(frames: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    """Union frames whose columns differ in presence or width under one declared schema."""
    return reduce(DataFrame.unionByName, (conform(df, schema) for df in frames))


def data_files(spark: SparkSession, root: str) -> list[str]:
    """Full paths of the Parquet files anywhere below ``root``, listed by Spark; no file is opened."""
    if not Tree(spark, root).has_parquet():
        return []
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root)
    return sorted(r.path for r in found.select("path").collect())


def footer_catalogue(spark: SparkSession, files: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """Groups of files with a schema that holds for each of them: no column has two types in a group, some may be missing in a file.

    One job reads the footers of all files in its tasks and merges them. Where two types meet it is repeated on both
    halves, so the number of jobs follows the changes of type along the sorted files, not their number. Groups that agree are joined again.
    """
    reader = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True)

    def merged(part: list[str]) -> list[tuple[T.StructType, list[str]]]:
        try:
            return [(reader.parquet(*part).schema, part)]
        except (PySparkException, Py4JJavaError) as error:
            if len(part) == 1 or "MERGE" not in str(error):
                raise
        half = len(part) // 2
        return merged(part[:half]) + merged(part[half:])

    groups: list[tuple[dict[str, T.StructField], list[str]]] = []
    for schema, part in merged(files) if files else []:
        own = {f.name: f for f in schema}
        for fields, members in groups:
            if all(fields[n].dataType == own[n].dataType for n in fields.keys() & own.keys()):
                fields |= own
                members += part
                break
        else:
            groups.append((own, list(part)))
    return [(T.StructType(list(fields.values())), members) for fields, members in groups]


def read_foreign_tree(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Scan a tree written by others, whose files drift in column set or numeric type, wherever below ``root`` they lie.

    Files are grouped by their footers, every group is one scan, and the groups are cast and united by name: the number of
    scans is the number of conflicting types, not of folders or files.
    """
    groups = footer_catalogue(spark, data_files(spark, root))
    if not groups:
        return empty(spark, schema)
    reader = spark.read.option("recursiveFileLookup", True)
    return union_by_name([reader.schema(found).parquet(*files) for found, files in groups], schema)


def read_required(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan a table that must exist and hold rows."""
    if not Tree(spark, path).has_parquet():
        raise FileNotFoundError(f"no table at {path}; run the stage that writes it first")
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    if df.isEmpty():
        raise ValueError(f"table at {path} has no rows")
    return df


def read_optional(spark: SparkSession, path: str | None) -> DataFrame | None:
    """Scan a table that may be absent."""
    if path is None or not Tree(spark, path).has_parquet():
        return None
    return spark.read.parquet(path)


def read_calendar_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line, skipping lines that start with ``#``."""
    return (
        spark.read.option("header", True).option("comment", "#").option("enforceSchema", False)
        .schema(schema).csv(path)
    )


CLOSE = "}"  # JSON objects are cut behind this sign, wherever it stands
BLOCK_BITS = 12  # running sums over pieces go through blocks of at most 2**12 neighbouring pieces
TASK_BYTES = 16 << 20  # JSON that a task sorts at once


def _order():
    return Window.partitionBy("path", "split", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before(pieces: DataFrame, value: Column, out: str, tasks: int) -> DataFrame:
    """Add ``out``, the sum of ``value`` over all earlier blocks of the same file: one number a block of a split, and then one a split, meets in a window."""
    block = pieces.groupBy(F.col("path").alias("p"), F.col("split").alias("s"), F.col("block").alias("b")).agg(F.sum(value).alias("own"))
    split = block.groupBy(F.col("p").alias("sp"), F.col("s").alias("ss")).agg(F.sum("own").alias("whole"))
    of_file = Window.partitionBy("sp").orderBy("ss").rowsBetween(Window.unboundedPreceding, -1)
    of_split = Window.partitionBy("p", "s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    split = split.select("sp", "ss", F.coalesce(F.sum("whole").over(of_file), F.lit(0)).alias("splits"))
    block = block.select("p", "s", "b", F.coalesce(F.sum("own").over(of_split), F.lit(0)).alias("blocks"))
    known = block.join(split, (F.col("p") == F.col("sp")) & (F.col("s") == F.col("ss")))
    known = known.select("p", "s", "b", (F.col("splits") + F.col("blocks")).alias(out))
    dealt = pieces.repartition(tasks, "path", "split", "block")
    return dealt.join(known, (F.col("path") == F.col("p")) & (F.col("split") == F.col("s")) & (F.col("block") == F.col("b"))).drop("p", "s", "b")


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """(path, record, text) of the outermost objects in JSON files, however large a file is.

    A file is an array of objects, or objects one after another. It is read in byte ranges by many tasks, cut behind every
    closing brace. Whether a cut is inside a string, and how deep it is, follows from what stands before it: each piece
    tells its number of quotes and of opening braces for either case, and prefix sums, within a block, over the blocks of a split and
    over the splits of a file, stitch the pieces together. Only the pieces of one object meet. An object that never closes fails the job.
    The number of partitions follows the size of the files, so what a task sorts does not grow with them: adaptive execution would
    join partitions by their compressed size, and JSON is many times larger.
    """
    lines = spark.read.option("lineSep", CLOSE).text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("piece"),
    ).withColumn("block", F.shiftright("at", BLOCK_BITS))
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-size // TASK_BYTES))
    key = ("path", "split", "block")
    bare = F.regexp_replace("piece", r"(?s)\\.", "")  # without escaped signs

    def opened(text: Column) -> Column:
        outside = F.regexp_replace(text, r'(?s)"[^"]*("|\z)', "")
        return F.length(outside) - F.length(F.replace(outside, F.lit("{"), F.lit("")))

    pieces = materialise(
        lines.select(
            *key, "at", "piece", (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))).alias("quotes"),
            opened(bare).alias("plain"), opened(F.regexp_replace(bare, r'(?s)\A[^"]*("|\z)', "")).alias("quoted"),
        ),
        "json-pieces",
    )
    placed = _before(pieces, F.col("quotes"), "earlier", tasks).withColumn("after", F.col("earlier") + F.sum("quotes").over(_order()))
    inside = (F.col("after") - F.col("quotes")) % 2 == 1
    closes = F.col("after") % 2 == 0
    placed = placed.select(*key, "at", "piece", (F.when(inside, F.col("quoted")).otherwise(F.col("plain")) - closes.cast("int")).alias("step"), closes.alias("closes"))
    placed = materialise(placed, "json-steps")
    deep = _before(placed, F.col("step"), "earlier", tasks).withColumn("depth", F.col("earlier") + F.sum("step").over(_order()))
    ends = materialise(deep.select(*key, "at", "piece", (F.col("closes") & (F.col("depth") == 0)).alias("end")), "json-ends")
    numbered = _before(ends, F.col("end").cast("int"), "earlier", tasks).withColumn(
        "record", F.col("earlier") + F.sum(F.col("end").cast("int")).over(_order()) - F.col("end").cast("int")
    )
    whole = numbered.repartition(tasks, "path", "record").groupBy("path", "record").agg(
        F.sort_array(F.collect_list(F.struct("split", "at", "piece"))).alias("parts"), F.max("end").alias("closed")
    )
    text = F.concat(F.array_join("parts.piece", CLOSE), F.lit(CLOSE))
    rest = F.regexp_replace(F.array_join("parts.piece", CLOSE), r"[\s,\[\]\x{feff}]+", "")
    checked = F.when(F.col("closed"), text).when(rest != "", F.raise_error(F.concat(F.lit("unfinished object in "), F.col("path"))))
    return whole.select("path", "record", F.regexp_replace(checked, r"\A[\s,\[\]\x{feff}]+", "").alias("text")).filter("text IS NOT NULL")


def read_json_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of JSON files that hold an array of objects; a large file is read by many tasks."""
    parsed = F.from_json("text", schema)
    return json_records(spark, path).select(parsed.alias("row")).select("row.*")


def columnar_schema(row: T.StructType) -> T.StructType:
    """Schema of a payload that holds one array per column below ``hourly``."""
    arrays = T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in row])
    return T.StructType(
        [
            T.StructField("hourly", arrays),
            T.StructField("error", T.StringType()),
            T.StructField("reason", T.StringType()),
        ]
    )


def flatten_columnar(payloads: DataFrame, row: T.StructType) -> DataFrame:
    """One row per array position. An ``error`` payload or one without ``hourly`` fails the job."""
    failed = F.col("error").isNotNull() & (F.lower("error") != "false")
    checked = (
        F.when(failed, F.raise_error(F.coalesce(F.col("reason"), F.col("error"))))
        .when(F.col("hourly").isNull(), F.raise_error(F.lit("payload has no hourly object")))
        .otherwise(F.arrays_zip(*(F.col(f"hourly.{name}") for name in row.names)))
    )
    fields = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in row)
    return payloads.select(F.inline(checked.cast(f"array<struct<{fields}>>")))


def date_window(day: Column, start: date, end: date) -> Column:
    """Inclusive window as a half-open predicate, which reaches the Parquet scan."""
    return (day >= F.lit(start)) & (day < F.date_add(F.lit(end), 1))


def max_date(df: DataFrame, column: str) -> DataFrame:
    """One row with the latest date of a column; unreadable values are ignored.

    An instant counts for the day it has on the local wall clock.
    """
    is_instant = dict(df.dtypes)[column] == "timestamp"
    day = local_date(F.col(column)) if is_instant else tolerant_date(F.col(column))
    return df.agg(F.max(day).alias("max_date"))


def existing_max_date(spark: SparkSession, root: str, column: str, dtype: str) -> date | None:
    """Latest date landed below ``root``, reading one column only."""
    schema = T.StructType([T.StructField(column, TYPES[dtype])])
    return max_date(read_tree(spark, root, schema), column).first()["max_date"]


def holidays_between(holidays: DataFrame, start: date, end: date) -> DataFrame:
    return holidays.filter(F.col("date").between(F.lit(start), F.lit(end))).orderBy("date", "name")
