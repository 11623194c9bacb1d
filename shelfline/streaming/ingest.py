"""Incremental file ingest: each file of a feed is read once and its rows are appended.

Progress is in the stream's checkpoint, so a repeated or restarted run adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from shelfline.operators.dates import read_time
from shelfline.sources.tables import COMPRESSION

CORRUPT = "_corrupt_record"
# Fields that the schema does not have, as one JSON object.
BEYOND = "_beyond"
# A file is read whatever its date. The stream's log of files it has seen keeps one line for each of them.
ANY_AGE = {"maxFileAge": "36500d"}


def bronze_stream(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType,
    provenance: bool = False,
    max_bytes: int | None = None,
) -> DataFrame:
    """New files of a feed as a stream, with the ingestion clock and, if asked, file and file time.

    A JSON record that does not fit the schema keeps its text in ``_corrupt_record``, fields that the schema
    does not have are in ``_beyond``. CSV comes as lines, see :func:`csv_records`. ``max_bytes`` bounds a micro-batch, so
    a large backlog is worked off in pieces that can be retried alone.
    """
    reader = spark.readStream.options(recursiveFileLookup="true", **ANY_AGE)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    files = reader.format("parquet").schema(schema).load(path) if fmt == "parquet" else reader.format("text").load(path)
    names = list(files.columns)
    added = [F.current_timestamp().alias("_ingestion_ts")]
    if provenance or fmt == "csv":
        added = [
            F.col("_metadata.file_path").alias("_source_file"),
            F.col("_metadata.file_modification_time").alias("_source_ts"),
            *added,
        ]
    rows = files.select(*names, *added)
    return json_records(rows, schema) if fmt == "json" else rows


def json_records(lines: DataFrame, schema: StructType) -> DataFrame:
    """The records of JSON lines (value, …): declared columns, ``_corrupt_record`` and ``_beyond``."""
    whole = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    text = F.col("value")
    record = F.from_json(text, whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    fields = F.from_json(text, "map<string,variant>")
    known = [F.lit(name) for name in schema.names]
    more = F.map_filter(fields, lambda name, _: ~name.isin(*known))
    read = lines.filter(F.trim(text) != "").withColumns({"_r": record, "_m": more})
    corrupt = F.when(F.col("_r").isNull(), text).otherwise(F.col(f"_r.{CORRUPT}"))
    return read.select(
        *[F.col("_r")[name].alias(name) for name in schema.names],
        corrupt.alias(CORRUPT),
        F.when(F.size("_m") > 0, F.to_json("_m")).alias(BEYOND),
        *[name for name in lines.columns if name != "value"],
    )


def _cells(line: Column) -> Column:
    """A header line cut at its commas, without quotes and blanks."""
    return F.transform(F.split(line, ","), lambda cell: F.regexp_replace(cell, r'^[\s"\x{FEFF}]+|[\s"]+$', ""))


def csv_records(lines: DataFrame, schema: StructType) -> DataFrame:
    """The records of CSV lines (value, _source_file, …): declared columns, ``_corrupt_record`` and ``_beyond``.

    Every file may have a header of its own: a line that names at least half of the declared columns. Its names say
    which cell belongs to which column, in whatever order; cells under other names are in ``_beyond``. A file
    without a header has the declared columns in their order. A record with too many or too few cells, or with a
    cell that cannot be read as its column's type, keeps its text in ``_corrupt_record``; a time is read in several spellings.
    Lines are read to find the headers, one row for each file, and once to cut the records. The headers are sent to the
    lines, which are not shuffled, as a file may be large; the stream's own log lists the same files.
    """
    declared = F.array(*[F.lit(name) for name in schema.names])
    rows = lines.filter(F.trim("value") != "")
    line, cells = F.col("value"), _cells(F.col("value"))
    # A name that is a cell is also in the line, so few lines need to be cut to be told from a header.
    held = reduce(Column.__add__, [line.contains(name).cast("int") for name in schema.names])
    names_half = F.size(F.array_intersect(cells, declared)) * 2 >= len(schema)
    is_header = F.when(held * 2 >= len(schema), names_half).otherwise(F.lit(False))
    longest = F.max(F.struct(F.size(cells).alias("n"), cells.alias("names"))).alias("h")
    headers = rows.filter(is_header).groupBy("_source_file").agg(longest).select("_source_file", "h.*")
    # Looked for once: a row for each file, as in the stream's log, is all that comes back.
    read = headers.collect()
    width = max([header["n"] for header in read] + [len(schema)])
    headers = lines.sparkSession.createDataFrame(read, headers.schema)
    places = F.array(*[F.array_position("names", name).cast("int") for name in schema.names])
    numbered = F.transform("names", lambda name, i: F.struct(name.alias("k"), (i + 1).alias("at")))
    # A name that stands twice counts where it stands first.
    others = F.filter(
        numbered, lambda p: (F.array_position("names", p["k"]) == p["at"]) & ~F.array_contains(declared, p["k"])
    )
    headers = headers.select("_source_file", "n", places.alias("_places"), others.alias("_others"))
    in_order = F.array(*[F.lit(i + 1) for i in range(len(schema))])
    named = rows.filter(~is_header).join(F.broadcast(headers), "_source_file", "left")
    named = named.withColumns({"n": F.coalesce("n", F.lit(len(schema))), "_places": F.coalesce("_places", in_order)})
    # Empty cells make every record as long as the longest header, so that one cut serves all files.
    padded = F.concat("value", F.repeat(F.lit(","), F.lit(width) - F.col("n")))
    cells_read = ", ".join(f"c{i} string" for i in range(width))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"'}
    cut = F.from_csv(padded, f"{cells_read}, {CORRUPT} string", options)
    read = named.withColumn("_r", cut).withColumn("_values", F.array(*[F.col(f"_r.c{i}") for i in range(width)]))
    values, unread = {}, F.col("_r").isNull() | F.col(f"_r.{CORRUPT}").isNotNull()
    for i, field in enumerate(schema.fields):
        at = F.col("_places")[i]
        cell = F.when(at > 0, F.get("_values", at - 1))
        value = f"_value{i}"
        values[value] = read_time(cell) if field.dataType == TimestampType() else cell.try_cast(field.dataType)
        if field.dataType != StringType():
            unread = unread | (cell.isNotNull() & F.col(value).isNull())
    pairs = F.transform("_others", lambda p: F.struct(p["k"].alias("k"), F.get("_values", p["at"] - 1).alias("v")))
    more = F.filter(pairs, lambda p: p["v"].isNotNull())
    beyond = F.when(F.size("_others") > 0, F.when(F.size(more) > 0, F.to_json(F.map_from_entries(more))))
    # Each value is a column first, so that it is read once and not again for the check.
    return read.withColumns(values).select(
        *[F.col(value).alias(name) for value, name in zip(values, schema.names)],
        F.when(unread, F.col("value")).alias(CORRUPT),
        beyond.alias(BEYOND),
        *[name for name in lines.columns if name != "value"],
    )


def table_stream(spark: SparkSession, path: str) -> DataFrame:
    """Rows appended to a stored table, as a stream."""
    return spark.readStream.schema(spark.read.parquet(path).schema).options(**ANY_AGE).parquet(path)


def _triggered(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def append_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet table: all that is there now, or on and on ``every`` interval."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return _triggered(writer, every).start(path)


def batch_stream(
    rows: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Hand each micro-batch to ``write``, which must give the same result when it is called again."""
    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, every).start()


def wait(queries: Iterable[StreamingQuery]) -> None:
    """Wait for triggered queries that were started together; where one fails the others are stopped."""
    queries = list(queries)
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
