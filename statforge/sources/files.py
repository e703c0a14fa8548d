"""CSV, Parquet and JSON inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statforge.functions import messages as M
from statforge.operators.cleaning import INGESTED_AT, SOURCE_FILE

_CSV = {"header": "true", "escape": '"'}


def text_schema(columns: list[str] | tuple[str, ...]) -> T.StructType:
    """All-text schema: types are decided by the cleaning rules, not by what a sample looked like."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _open_quoted_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """Files with a line that has an odd number of quotes: only in these can a field hold a line break. One name per file."""
    # Bytes, which need no look at the characters; most lines have no quote and are not copied without them.
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    odd = F.contains("value", F.lit('"')) & (quotes % 2 == 1)
    found = spark.read.text(paths).where(odd).select(F.col("_metadata.file_path").alias("path")).distinct()
    return sorted(row["path"] for row in found.collect())


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    multi_line: bool | None = None,
    infer: bool = False,
    lineage: bool = True,
) -> DataFrame:
    """CSV with a header, ``""`` as quote escape and quoted fields that may span lines.

    With ``multi_line`` a file is read by one task, without it in splits. By default (None) a parallel look at the text
    decides for every file; pass False for large tables known to have no line breaks in fields. Without
    ``schema`` every header column is text, or inferred if ``infer``. Files whose header differs are refused when read.
    ``lineage`` adds the ingest time and the file each row came from.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if schema is None and not infer:
        schema = text_schema(spark.read.options(**_CSV).csv(paths).columns)
    elif schema is None:
        schema = spark.read.options(**_CSV, inferSchema="true", multiLine="true").csv(paths).schema

    def read(whole: bool) -> DataFrame:
        reader = spark.read.options(**_CSV, enforceSchema="false", multiLine=str(whole).lower()).schema(schema)
        return reader.csv(paths).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))

    if multi_line is not None:
        rows = read(multi_line)
    else:
        # The file filter is applied to the listing, so each file is read one way only.
        whole_files = _open_quoted_files(spark, paths)
        listed = F.col("_metadata.file_path").isin(whole_files)
        rows = read(False) if not whole_files else read(False).where(~listed).unionByName(read(True).where(listed))
    if not lineage:
        return rows.drop(SOURCE_FILE)
    return rows.select(*(F.col(f"`{c}`") for c in rows.columns if c != SOURCE_FILE), F.current_timestamp().alias(INGESTED_AT), SOURCE_FILE)


def read_layer(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One table of a Parquet layer."""
    return spark.read.parquet(f"{root.rstrip('/')}/{table}")


def verify_layer(spark: SparkSession, root: str, tables: list[str] | tuple[str, ...]) -> list[dict]:
    """Row and column count of every table; a missing or unreadable one is reported, not raised.

    Counts come from the Parquet footers.
    """
    report = []
    for table in tables:
        try:
            df = read_layer(spark, root, table)
            report.append({"table": table, "status": "OK", "rows": df.count(), "columns": len(df.columns)})
        except Exception as error:  # noqa: BLE001 - any failure is a finding here
            missing = getattr(error, "getCondition", lambda: None)() == "PATH_NOT_FOUND"
            report.append({"table": table, "status": "MISSING" if missing else "UNREADABLE", "error": str(error)})
    return report


def source_inventory(spark: SparkSession, root: str, pattern: str, expected: list[str] | None = None) -> DataFrame:
    """Path, name and size of the files below ``root``; expected names without a file have no size.

    Only listings are read, never file contents.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    found = reader.load(root).select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "path",
        F.col("length").alias("bytes"),
        F.lit(True).alias("present"),
    )
    if not expected:
        return found
    names = spark.createDataFrame([(e,) for e in expected], "file_name string")
    missing = names.join(found, "file_name", "left_anti").select(
        "file_name", F.lit(None).cast("string").alias("path"), F.lit(None).cast("bigint").alias("bytes"), F.lit(False).alias("present")
    )
    return found.unionByName(missing)


def competitions_file(spark: SparkSession, path: str) -> DataFrame:
    """Flat competitions of ``{"competitions": [...]}`` files."""
    whole = spark.read.schema(M.COMPETITIONS_FILE).json(path, multiLine=True)
    return M.flatten_competition(whole.select(F.explode("competitions").alias("data")))


def standings_dir(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Flat standings of a directory of files that hold one message, or a list of messages, with the file each row came from.

    Unlike the stream, a missing stage, type or current matchday stays NULL, so does a statistic that is null in
    the file (an absent one is 0), and only a missing team id drops a row. Files are later applied in name order (see
    ``load_standings_files``).
    """
    reader = spark.read.schema(M.STANDINGS_FILE).option("multiLine", True).option("pathGlobFilter", pattern)
    whole = reader.json(path).select(
        F.struct("filters", "area", "competition", "season", M.typed_standings(F.col("standings")).alias("standings")).alias("data"),
        F.col("_metadata.file_path").alias(SOURCE_FILE),
    )
    stays_null = ("stage", "standing_type", "current_matchday", *M.STATISTIC_COLUMNS)
    return M.flatten_standings(whole, carry=(SOURCE_FILE,), keep_null=stays_null, required=("team_id",))
