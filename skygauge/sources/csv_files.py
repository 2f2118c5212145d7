"""CSV files to bronze rows: positional columns, skipped bad rows, each file once."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from skygauge.functions.times import ts_literal
from skygauge.schemas import BRONZE_COLUMNS, SOURCES, column_names

FILE_GLOBS = {s: f"*{s}*.csv" for s in SOURCES}
SOURCE_FILE = "source_file"
#: The whole line, where it has too few or too many fields; and its name among the columns that don't fit.
MALFORMED, FIELD_COUNT = "_malformed", "field_count"


def _csv_options(source: str, file_glob: str | None = None) -> dict[str, str]:
    return {"sep": ",", "header": "true", "enforceSchema": "true", "quote": '"', "escape": '"', "nullValue": "",
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED, "pathGlobFilter": file_glob or FILE_GLOBS[source],
            "recursiveFileLookup": "true",
            # A line has the wrong number of fields or not, whichever of them a query needs.
            "columnPruning": "false"}


def _text_schema(source: str) -> StructType:
    return StructType.fromDDL(", ".join(f"{c} STRING" for c in [*column_names(BRONZE_COLUMNS[source]), MALFORMED]))


def read_text(spark: SparkSession, folder: str, source: str, file_glob: str | None = None) -> DataFrame:
    """Fields of all files of a source as text, by position; the header is skipped, not matched.

    A quote within a quoted field is doubled. A line with too few or too many fields is kept whole in ``MALFORMED``.
    """
    raw = spark.read.schema(_text_schema(source)).options(**_csv_options(source, file_glob)).csv(folder)
    return raw.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def _typed(column: str, type_name: str) -> Column:
    text = F.nullif(F.col(column), F.lit(""))
    if type_name == "INT":  # numbers such as 5.0 are whole
        return F.round(text.try_cast("decimal(38,10)")).try_cast("int")
    return text.try_cast(type_name)


def _fields(source: str) -> dict[str, str]:
    return dict(part.split() for part in BRONZE_COLUMNS[source].split(", "))


def _misfit(column: str, type_name: str) -> Column:
    """True for a non-empty field that does not fit its type."""
    return F.nullif(F.col(column), F.lit("")).isNotNull() & _typed(column, type_name).isNull()


def any_misfit(source: str) -> Column:
    misfits = [_misfit(n, kind) for n, kind in _fields(source).items() if kind != "STRING"]
    return reduce(operator.or_, misfits, F.col(MALFORMED).isNotNull())


def bronze_rows(text: DataFrame, source: str, load_timestamp, null_sentinel: float | None = None) -> DataFrame:
    """Typed rows of the text rows with the right number of fields, all of which fit.

    ``null_sentinel`` (such as -999) turns that measure into NULL.
    """
    typed = {name: _typed(name, kind) for name, kind in _fields(source).items()}
    if null_sentinel is not None:
        typed.update({n: F.nullif(typed[n], F.lit(float(null_sentinel)))
                      for n, kind in _fields(source).items() if kind == "DOUBLE"})
    return text.filter(~any_misfit(source)).select(
        *[c.alias(n) for n, c in typed.items()], ts_literal(load_timestamp).alias("load_timestamp"))


def rejected_rows(text: DataFrame, source: str, load_timestamp) -> DataFrame:
    """The other text rows, as they came, with the names of the fields that do not fit, or ``FIELD_COUNT``."""
    ragged = F.col(MALFORMED).isNotNull()
    bad = [F.when(~ragged & _misfit(n, kind), F.lit(n)) for n, kind in _fields(source).items() if kind != "STRING"]
    bad.append(F.when(ragged, F.lit(FIELD_COUNT)))
    return (text.filter(any_misfit(source)).withColumn("bad_columns", F.array_compact(F.array(*bad)))
            .withColumn("load_timestamp", ts_literal(load_timestamp)))


def read_bronze(spark: SparkSession, folder: str, source: str, load_timestamp,
                null_sentinel: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(bronze rows, rejected rows) of all files of a source, read as one batch."""
    text = read_text(spark, folder, source)
    return (bronze_rows(text, source, load_timestamp, null_sentinel),
            rejected_rows(text, source, load_timestamp))


def load_new_files(spark: SparkSession, landing: str, warehouse: str, source: str, load_timestamp,
                   bytes_per_batch: str | None = None, null_sentinel: float | None = None,
                   file_glob: str | None = None) -> None:
    """Add the files not loaded before to the bronze table of a source.

    Files are matched by name (``FILE_GLOBS``) unless ``file_glob`` says otherwise. With
    ``bytes_per_batch`` (such as "500g") a large backlog is loaded in steps; a run that stops goes on
    after the last complete step.

    The file stream's checkpoint is the ledger of loaded files, by full path. Every micro-batch
    overwrites its own ``load_id`` folder, so a repeated batch leaves no double rows.
    """
    stream = spark.readStream.schema(_text_schema(source)).options(**_csv_options(source, file_glob))
    # Old files count as well: the default would pass over files a week older than the newest.
    stream = stream.option("maxFileAge", "36500d")
    if bytes_per_batch:
        stream = stream.option("maxBytesPerTrigger", bytes_per_batch)
    text = stream.csv(landing).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        counted = batch.observe(seen, F.count_if(any_misfit(source)).alias("rejected"))
        (bronze_rows(counted, source, load_timestamp, null_sentinel)
         .write.mode("overwrite").parquet(f"{bronze_path(warehouse, source)}/load_id={batch_id}"))
        if seen.get["rejected"]:  # the files are parsed again only where rows were put aside
            (rejected_rows(batch, source, load_timestamp)
             .write.mode("overwrite").parquet(f"{rejected_path(warehouse, source)}/load_id={batch_id}"))

    query = (text.writeStream.foreachBatch(write)
             .option("checkpointLocation", f"{warehouse}/_ledger/{source}")
             .trigger(availableNow=True).start())
    query.awaitTermination()


def bronze_path(warehouse: str, source: str) -> str:
    return f"{warehouse}/bronze/{source}"


def rejected_path(warehouse: str, source: str) -> str:
    return f"{warehouse}/bronze_rejected/{source}"


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """CSV files below a folder with their kind; reads no contents."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(folder).select("path", "length", F.col("modificationTime").alias("modified")))
    name = F.element_at(F.split("path", "/"), -1)
    kind = reduce(lambda label, s: label.when(F.contains(F.lower(name), F.lit(s)), F.lit(s)), SOURCES, F)
    return files.filter(name.endswith(".csv")).select("path", name.alias("file_name"), "length", "modified",
                                                      kind.alias("kind"))


def count_files(files: DataFrame) -> DataFrame:
    """File count per kind."""
    return files.groupBy("kind").agg(F.count("*").alias("files"))


def require_files(files: DataFrame) -> DataFrame:
    """The same listing, or an error if it is empty."""
    if files.isEmpty():
        raise ValueError("no CSV files to load")
    return files


def files_to_copy(source_files: DataFrame, landed_files: DataFrame) -> DataFrame:
    """Source files whose name has not landed yet."""
    return source_files.join(landed_files.select("file_name"), "file_name", "left_anti")
