"""Scans: typed and untyped CSV, folders of CSV files, Parquet."""

from __future__ import annotations

import logging
import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallygrain.columns import submission_schema, transaction_schema

log = logging.getLogger(__name__)

CORRUPT = "_corrupt_record"
#: Files whose header line is read at the same time.
HEADER_READERS = 16


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv_typed(
    spark: SparkSession, path: str, schema: T.StructType | None = None, keep_bad_rows: bool = False
) -> DataFrame:
    """CSV with a header and a fixed schema, matched by column name; malformed rows fail, or are kept aside.

    Columns may stand in any order, which may differ between the files of a folder; further
    columns are left out, a missing one is an error. With ``keep_bad_rows`` the raw text of a
    malformed row is in ``_corrupt_record``.
    """
    schema = schema or transaction_schema()
    known = {f.name: f for f in schema.fields}
    layouts = _layouts(spark, _csv_files(spark, path))
    for header, files in layouts.items():
        missing = [n for n in known if n not in header]
        if missing:
            raise ValueError(f"{files[0]} lacks the columns {missing}")
    reader = spark.read.option("header", True).option("enforceSchema", False)
    parts = []
    for header, files in layouts.items():
        fields = [known.get(n, T.StructField(n, T.StringType())) for n in header]
        if keep_bad_rows:
            layout = reader.schema(T.StructType([*fields, T.StructField(CORRUPT, T.StringType())]))
            part = layout.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(files)
            parts.append(part.select(*known, CORRUPT))
        else:
            parts.append(reader.schema(T.StructType(fields)).option("mode", "FAILFAST").csv(files).select(*known))
    if not parts:
        wanted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]) if keep_bad_rows else schema
        return spark.createDataFrame([], wanted)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _csv_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a path: itself, or what lies in the folder and is not hidden."""
    jvm = spark.sparkContext._jvm
    files = []
    for found in _glob(spark, path):
        place = jvm.org.apache.hadoop.fs.Path(found)
        system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files += [s.getPath().toString() for s in system.listStatus(place) if s.isFile() and s.getPath().getName()[0] not in "._"]
    if not files:
        raise FileNotFoundError(path)
    return sorted(files)


def _first_line(spark: SparkSession, file: str) -> str | None:
    """The first line with text, unpacked where the file's name tells a codec; None if there is none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(file)
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        plain = stream if codec is None else codec.createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
        line = reader.readLine()
        while line is not None and not line.strip():
            line = reader.readLine()
        return line
    finally:
        stream.close()


def _layouts(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each header. Opens every file for a line; one job for each different line. Files without one are left out."""
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        lines = list(pool.map(lambda f: _first_line(spark, f), files))
    same: dict[str, list[str]] = {}
    for file, line in zip(files, lines, strict=True):
        if line is not None:
            same.setdefault(line, []).append(file)
    layouts: dict[tuple[str, ...], list[str]] = {}
    for group in same.values():
        layouts.setdefault(tuple(spark.read.option("header", True).csv(group[0]).columns), []).extend(group)
    return layouts


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both inferred types."""
    order: list[type[T.DataType]] = [T.IntegerType, T.LongType, T.DoubleType]
    if a == b:
        return a
    if type(a) in order and type(b) in order:
        return order[max(order.index(type(a)), order.index(type(b)))]()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def read_csv_untyped(spark: SparkSession, path: str) -> DataFrame:
    """CSV of unknown columns, matched by name. A header that matches the transaction table gets its
    types without the extra inference pass.

    Files of a folder may have other column orders and columns: a column that a file lacks is NULL
    in its rows, and a column's type is one that holds its values in all files.
    """
    known = {f.name: f for f in transaction_schema().fields}
    layouts = _layouts(spark, _csv_files(spark, path))
    if not layouts:
        return spark.createDataFrame([], T.StructType([]))
    names = list(dict.fromkeys(n for header in layouts for n in header))
    if all(n in known for n in names) and all(len(header) == len(names) for header in layouts):
        return read_csv_typed(spark, path, T.StructType([known[n] for n in names]))
    reader = spark.read.option("header", True)
    if len(layouts) == 1:
        return reader.option("inferSchema", True).csv(next(iter(layouts.values())))
    guessed = [reader.option("inferSchema", True).csv(files).schema for files in layouts.values()]
    types: dict[str, T.DataType] = {}
    for f in (f for schema in guessed for f in schema.fields):
        types[f.name] = _wider(types.get(f.name, f.dataType), f.dataType)
    out = None
    for schema, files in zip(guessed, layouts.values(), strict=True):
        part = spark.read.option("header", True).schema(T.StructType([T.StructField(f.name, types[f.name]) for f in schema.fields])).csv(files)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.select(*names)


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [] if found is None else sorted(s.getPath().toString() for s in found)


def path_exists(spark: SparkSession, path: str) -> bool:
    return bool(_glob(spark, path))


# The files of a raw data folder.
RAW_FILES = ["transactions.csv", "test.csv", "sample_submission.csv"]


def _raw_schema(name: str) -> T.StructType:
    if name == "sample_submission.csv":
        return submission_schema()
    return transaction_schema(with_fraud=name != "test.csv")


def read_raw_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The known files of a folder; missing ones are skipped.

    A folder with none of them is read file by file, whatever the CSVs hold.
    """
    tables: dict[str, DataFrame] = {}
    for name in RAW_FILES:
        path = os.path.join(folder, name)
        if path_exists(spark, path):
            tables[name.removesuffix(".csv")] = read_csv_typed(spark, path, _raw_schema(name))
        else:
            log.warning("not found: %s", path)
    return tables or read_csv_folder(spark, folder)


def read_csv_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every ``*.csv`` of a folder, keyed by its stem."""
    return {
        os.path.basename(p).removesuffix(".csv"): spark.read.option("header", True).option("inferSchema", True).csv(p)
        for p in _glob(spark, os.path.join(folder, "*.csv"))
    }


def first_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """The first n rows in key order."""
    return df.orderBy(key).limit(n)
