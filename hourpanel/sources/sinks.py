"""Sinks: day and key replacement, snapshots, Parquet, CSV and JSON outputs."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hourpanel.functions.scalars import null_if_nan
from hourpanel.sources.tree import Tree

DAY_PARTITION = "part_day"
KEY_PARTITION = "part_key"


@dataclass(frozen=True)
class Written:
    """Rows written and the partition values that now hold them."""

    rows: int
    partitions: tuple[str, ...]


def _replace_parts(
    df: DataFrame, root: str, partition: str, in_scope: Callable[[str], bool]
) -> Written:
    """Overwrite the partitions ``df`` has rows for, then drop in-scope ones it has none for.

    The overwrite is committed before anything is dropped, so a failed job loses nothing. Dynamic
    overwrite alone would leave the partitions without new rows. A rebalance keeps a hot partition
    from becoming one task: adaptive execution splits it and merges the small ones.
    """
    tree = Tree(df.sparkSession, root)
    before = {v: tree.files(f) for v, f in tree.parts(partition).items() if in_scope(v)}
    seen = Observation()
    (
        df.hint("rebalance", F.col(partition))
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(root)
    )
    after = {v: f for v, f in tree.parts(partition).items() if in_scope(v)}
    kept = []
    for value, folder in after.items():
        if value in before and before[value] and before[value] == tree.files(folder):
            tree.drop(folder)
        else:
            kept.append(value)
    return Written(int(seen.get["rows"]), tuple(sorted(kept)))


def replace_days(
    df: DataFrame, root: str, day: Column, start: date, end: date, partition: str = DAY_PARTITION
) -> Written:
    """Replace every day in ``[start, end]``.

    Rows outside the range or without a day are not written; a day without rows ends up absent;
    days outside the range are untouched. Running it twice gives the same table.
    """
    span = {str(start + timedelta(days=n)) for n in range((end - start).days + 1)}
    scoped = df.withColumn(partition, day.try_cast("date")).filter(
        F.col(partition).between(F.lit(start), F.lit(end))
    )
    return _replace_parts(scoped, root, partition, span.__contains__)


def replace_keys(
    df: DataFrame, root: str, key: str, keys: Iterable[object], partition: str = KEY_PARTITION
) -> Written:
    """Replace the partitions of the listed keys; others are untouched.

    A numeric key matches any spelling of the number; a text key matches as text.
    """
    wanted = list(keys)
    names = {str(k) for k in wanted}
    numbers = [k for k in wanted if not isinstance(k, str)]
    text = F.col(key).cast("string")
    label = F.when(text.isin(sorted(names)), text)
    if numbers:
        number = text.try_cast("double")
        as_number = F.coalesce(*(F.when(number == F.lit(k), F.lit(str(k))) for k in numbers))
        label = F.coalesce(as_number, label)
    scoped = df.withColumn(partition, label).filter(F.col(partition).isNotNull())
    return _replace_parts(scoped, root, partition, names.__contains__)


def replace_snapshot(df: DataFrame, path: str) -> Written:
    """Overwrite a snapshot table."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return Written(int(seen.get["rows"]), ())


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_mart(df: DataFrame, name: str) -> DataFrame:
    """Materialise a mart as a catalog table."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN of every floating column becomes null, as JSON has no NaN."""
    floating = {n for n, t in df.dtypes if t in ("double", "float")}
    return df.select(
        *(null_if_nan(F.col(n)).alias(n) if n in floating else F.col(n) for n in df.columns)
    )


def write_json(df: DataFrame, path: str) -> None:
    nan_to_null(df).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_json_arrays(df: DataFrame, path: str) -> None:
    """JSON files that hold one array of objects each, one file a task."""
    records = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))

    def lines(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        sign = "["
        for batch in batches:
            found = batch.column("value").to_pylist()
            if found:
                yield pa.RecordBatch.from_pydict({"value": [f"{sign}{found[0]}", *(f",{x}" for x in found[1:])]})
                sign = ","
        yield pa.RecordBatch.from_pydict({"value": ["[]" if sign == "[" else "]"]})

    records.mapInArrow(lines, "value string").write.mode("overwrite").text(path)


def write_export(df: DataFrame, parquet_path: str, csv_path: str, single_csv: bool = False) -> None:
    """Parquet and CSV with header. One CSV file only on request, as it means one writer task."""
    df.write.mode("overwrite").parquet(parquet_path)
    written = df.sparkSession.read.schema(df.schema).parquet(parquet_path)
    if single_csv:
        written = written.coalesce(1)
    written.write.mode("overwrite").option("header", True).csv(csv_path)
