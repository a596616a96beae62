"""Readers for delimited, JSON, XML and Parquet feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.clean import normalise_column_names

POSITION = "_position"
FILE = "_file"


def text_schema(names: Sequence[str]) -> T.StructType:
    """An all-string schema; feeds are typed later, on purpose. Blanks around names are dropped."""
    return T.StructType([T.StructField(n.strip(), T.StringType()) for n in names])


def scan_delimited(spark: SparkSession, paths, *, schema, sep: str = "|", encoding: str = "UTF-8", header: bool = False,
                   quote: str = '"', escape: str = "\\", trim: bool = False, validate_header: bool = False) -> DataFrame:
    """Delimited text with a declared schema; short rows are padded with nulls.

    ``trim`` drops blanks around values. With ``validate_header`` a file whose
    header differs from the schema is an error instead of being read by position.
    """
    return spark.read.csv(paths, schema=schema, sep=sep, encoding=encoding, header=header, mode="PERMISSIVE", quote=quote, escape=escape,
                          ignoreLeadingWhiteSpace=trim, ignoreTrailingWhiteSpace=trim, enforceSchema=not validate_header)


def with_position(df: DataFrame) -> DataFrame:
    """Add the file of each row and its place in that file.

    A file may be read by several tasks. Splits start at different byte
    offsets, and row ids grow inside a split, so (offset, id) orders the file.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.struct(
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("row_id"),
        ).alias(POSITION),
    )


def split_start() -> Column:
    """Where the piece of a file begins that one task reads; ``with_position`` adds the position it is taken from."""
    return F.col(POSITION)["block_start"]


def drop_header_trailer(spark: SparkSession, paths, *, schema, sep: str = "|", header: bool = True,
                        trailer: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Drop the first and, if asked, the last physical row of each file.

    ``keep`` lists helper columns to leave in: the file path and the position.
    """
    df = scan_delimited(spark, paths, schema=schema, sep=sep, header=header)
    if not trailer and not keep:
        return df
    placed = with_position(df)
    if trailer:
        last = placed.groupBy(FILE).agg(F.max(POSITION).alias("_last"))
        placed = placed.join(last, FILE, "left").where(F.col(POSITION) != F.col("_last")).drop("_last")
    return placed.select(*df.columns, *keep)


def _stem_parts(sep: str) -> Column:
    return F.split(F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", ""), f"\\Q{sep}\\E")


def filename_columns(df: DataFrame, *, parts: Mapping[int, str], sep: str = "_") -> DataFrame:
    """Columns from the separated parts of the file name; null where the name has too few parts."""
    names = _stem_parts(sep)
    return df.select("*", *[F.get(names, F.lit(i)).alias(n) for i, n in parts.items()])


def filename_timestamp(df: DataFrame, *, date_part: int, time_part: int, name: str, sep: str = "_") -> DataFrame:
    """``yyyy-MM-dd HH:mm:ss`` text from a yyyyMMdd and an HHmmss part of the file name."""
    names = _stem_parts(sep)
    stamp = F.try_to_timestamp(F.concat(F.get(names, F.lit(date_part)), F.get(names, F.lit(time_part))),
                               F.lit("yyyyMMddHHmmss"))
    return df.select("*", F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias(name))


def _windows_1252() -> tuple[str, str]:
    """Characters in which windows-1252 differs from ISO-8859-1: as read, and as meant."""
    read, meant = "", ""
    for code in range(0x80, 0xA0):
        try:
            char = bytes([code]).decode("cp1252")
        except UnicodeDecodeError:
            continue
        read, meant = read + chr(code), meant + char
    return read, meant


def scan_csv_header_glob(spark: SparkSession, glob, *, schema=None, encoding: str = "UTF-8", sep: str = ",") -> DataFrame:
    """Header CSV over a path pattern; without a schema all columns are strings.

    Spark reads no windows-1252, so such files are read as ISO-8859-1 and the
    characters in which the two differ are replaced.
    """
    windows = encoding.lower() in ("windows-1252", "cp1252")
    df = spark.read.csv(glob, header=True, schema=schema, encoding="ISO-8859-1" if windows else encoding, sep=sep)
    if not windows:
        return df
    read, meant = _windows_1252()
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.translate(F.col(c), read, meant) for c in texts})


def scan_csv_infer(spark: SparkSession, glob, *, sep: str = "|", header: bool = True) -> DataFrame:
    """All parts of one table with inferred types (one extra pass over the data)."""
    return spark.read.csv(glob, header=header, sep=sep, inferSchema=True)


def scan_json_multiline(spark: SparkSession, paths, *, schema=None) -> DataFrame:
    """JSON documents that span lines; each file is one task, so keep files modest."""
    return spark.read.json(paths, schema=schema, multiLine=True)


def scan_by_type(spark: SparkSession, paths, *, kind: str, schema=None, options: Mapping | None = None) -> DataFrame:
    """Read a feed by the type that a recipe names: CSV, PARQUET, PARQUET_WITH_DECIMAL, JSON or XML.

    ``options`` go to the reader of that type. Column names of Parquet feeds
    are normalised; ``merge_schema`` unites the columns of all its files.
    """
    kind, options, paths = kind.upper(), dict(options or {}), [paths] if isinstance(paths, str) else list(paths)
    if kind == "CSV":
        return scan_delimited(spark, paths, schema=schema, **options)
    if kind == "PARQUET":
        df = spark.read.option("mergeSchema", str(options.get("merge_schema", False)).lower()).parquet(*paths)
        return normalise_column_names(df)
    if kind == "PARQUET_WITH_DECIMAL":
        return scan_parquet_decimal(spark, paths, **options)
    if kind == "JSON":
        return scan_json_multiline(spark, paths, schema=schema)
    if kind == "XML":
        return scan_xml_rows(spark, paths, schema=schema, **options)
    raise ValueError(f"unknown feed type {kind!r}")


def parse_json_column(df: DataFrame, col: str, *, schema, corrupt_col: str | None = None) -> DataFrame:
    """Replace a JSON string or binary column by the columns of ``schema``.

    With ``corrupt_col``, the text of a document that does not parse is kept there.
    """
    parsed_type = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    options = {"mode": "PERMISSIVE"}
    if corrupt_col:
        parsed_type = T.StructType([*parsed_type.fields, T.StructField(corrupt_col, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt_col
    parsed = F.from_json(F.col(col).cast("string"), parsed_type, options)
    others = [c for c in df.columns if c != col]
    return df.select(*others, parsed.alias("_json")).select(*others, "_json.*")


def scan_xml_rows(spark: SparkSession, paths, *, row_tag: str, schema=None, sampling_ratio: float | None = None,
                  ignore_namespace: bool = False) -> DataFrame:
    """XML elements named ``row_tag`` as rows, every leaf a string."""
    reader = spark.read.format("xml").option("rowTag", row_tag).option("inferSchema", "false")
    reader = reader.option("ignoreNamespace", str(ignore_namespace).lower())
    if sampling_ratio is not None:
        reader = reader.option("samplingRatio", sampling_ratio)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(paths)


def _existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(conf).exists(path):
            found.append(p)
    return found


def _children(spark: SparkSession, base: str) -> list[str]:
    """Files and folders directly below ``base``, without hidden ones: one listing."""
    root = spark._jvm.org.apache.hadoop.fs.Path(base)
    listed = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    return sorted(st.getPath().toString() for st in listed if st.getPath().getName()[0] not in "._")


def scan_parquet_partitions(spark: SparkSession, base: str, *, schema, days="*", hours: Sequence[int] | None = None) -> DataFrame:
    """Read the listed run folders below ``base``; absent ones are skipped.

    ``days`` is ``"*"`` or a list of yyyyMMdd. Folder names are
    yyyyMMdd000000, or yyyyMMddHH0000 for each of ``hours``. A base without run
    folders gives an empty frame; a base that does not exist is an error.
    """
    if not _existing(spark, [base]):
        raise FileNotFoundError(base)
    if days == "*":
        found = _children(spark, base)
        return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)
    stamps = [f"{d}{h:02d}0000" for d in days for h in (hours if hours is not None else [0])]
    paths = _existing(spark, [f"{base}/{s}" for s in stamps])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def scan_parquet_decimal(spark: SparkSession, paths: Sequence[str], *, decimals: Mapping[str, str]) -> DataFrame:
    """Folders whose decimals differ, read one by one and cast to one type."""
    result = None
    for p in paths:
        part = spark.read.parquet(p).withColumns({c: F.col(c).cast(t) for c, t in decimals.items()})
        result = part if result is None else result.unionByName(part, allowMissingColumns=True)
    return result


def _snapshots(spark: SparkSession, base: str, fmt: str, schema, newest: int) -> DataFrame:
    """Rows of the ``newest`` snapshots directly below ``base``, 1 for the latest.

    A snapshot is one file or one run folder with all files in it, and as old
    as its newest file. Only these files are read.
    """
    # One listing of all files, grouped by what is directly below the base.
    root = spark._jvm.org.apache.hadoop.fs.Path(base)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString().rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base).select("path", "modificationTime")
    child = F.concat(F.lit(f"{root}/"), F.substring_index(F.substring(F.col("path"), F.length(F.lit(root)) + 2, F.length("path")), "/", 1))
    found = files.groupBy(child.alias("child")).agg(F.max("modificationTime").alias("newest"))
    latest = [r["child"] for r in found.orderBy(F.desc("newest"), F.desc("child")).take(newest)]
    out = spark.createDataFrame([], schema).withColumn("snapshot", F.lit(1))
    for rank, path in enumerate(latest, 1):
        part = spark.read.format(fmt).schema(schema).option("recursiveFileLookup", "true").load(path).withColumn("snapshot", F.lit(rank))
        out = part if rank == 1 else out.unionByName(part)
    return out


def scan_latest_file(spark: SparkSession, base: str, *, fmt: str, schema) -> DataFrame:
    """Rows of the file or run folder written last."""
    return _snapshots(spark, base, fmt, schema, 1).drop("snapshot")


def scan_latest_two_files(spark: SparkSession, base: str, *, fmt: str, schema) -> DataFrame:
    """Rows of the two files or run folders written last; ``snapshot`` is 1 for the current one and 2 for the one before."""
    return _snapshots(spark, base, fmt, schema, 2)


def scan_table_pruned(spark: SparkSession, table, *, cols: Sequence[str], where: str | None = None) -> DataFrame:
    """Columns and rows of a table or Parquet path; both reach the scan."""
    df = spark.read.parquet(table) if "/" in table else spark.table(table)
    if where:
        df = df.where(where)
    return df.select(*cols)


def scan_active_files_by_watermark(files_df: DataFrame, watermark_df: DataFrame, *, stage: str) -> DataFrame:
    """Files changed since the time stored for them; a file never seen counts from 1900-01-01.

    ``files_df`` has file_name and modified_at, ``watermark_df`` has
    file_name, stage and last_processed_at.
    """
    seen = watermark_df.where(F.col("stage") == stage).groupBy("file_name").agg(
        F.max("last_processed_at").alias("last_processed_at"))
    since = F.coalesce("last_processed_at", F.lit("1900-01-01 00:00:00").cast(files_df.schema["modified_at"].dataType))
    return (files_df.join(seen, "file_name", "left").withColumn("last_processed_at", since)
            .where(F.col("modified_at") > F.col("last_processed_at")))
