"""File-stream ingest: consume each landed file once, archive it, merge every micro-batch by key.

The sink is a table on storage, partitioned by day (:mod:`starload.plans.commits`).  A micro-batch reads and writes only the days that
its rows touch, sends what validation rejects to the dead letters, and publishes both, with the names of the files that it
consumed, in one commit numbered by its epoch.  An epoch that is delivered again finds its commit and changes nothing.  The
checkpoint records which files were read; ``cleanSource=archive`` moves them away on the next trigger, and those of the last
trigger are moved when the stream has ended.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starload.functions.dates import date_id
from starload.operators.merge import dedupe_stored, merge_touched
from starload.plans.commits import COMMIT, State, commit, commits, put_partitions, read_table, state
from starload.schemas import DEAD_LETTERS, RAW_ORDER, RAW_VISIT, STG_ORDERS, STG_TRAFFIC
from starload.session import discard, materialize, scratch_path
from starload.sources.deadletters import TABLE as LETTERS
from starload.sources.deadletters import add_letters, dead_letters
from starload.sources.landing import FILES as LANDED
from starload.sources.landing import ingest_traffic, line_schema, parse_lines, split_orders, validate_orders

#: The table of a stream's root, and the column that deals its rows to days.
ROWS, DAY = "rows", "day_id"
#: The files that each epoch consumed, one partition an epoch.
FILES, EPOCH = "files", "epoch"
FILE_ROWS = T.StructType([T.StructField("source_file", T.StringType()), T.StructField(EPOCH, T.LongType())])


def stream_ingest(spark: SparkSession, path: str, schema: T.StructType, checkpoint: str, archive: str,
                  sink: Callable[[DataFrame, int], None], transform: Callable[[DataFrame], DataFrame] | None = None,
                  max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Start a stream over the JSON Lines in ``path`` (``*.json`` and ``*.json.gz`` only).  Each micro-batch holds the records parsed by ``schema``, with
    their text, their landing batch and file; it goes through ``transform`` (a DataFrame -> DataFrame function, e.g. validation and
    flattening) and then to ``sink``.  Whether there are landing batches is read from the folders at the start."""
    r = (spark.readStream.schema(line_schema(spark, path))
         .option("pathGlobFilter", LANDED)
         .option("cleanSource", "archive")
         .option("sourceArchiveDir", archive))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    read = r.text(path).withColumn("source_file", F.col("_metadata.file_path"))
    read = read if "batch" in read.columns else read.withColumn("batch", F.lit(None).cast("string"))

    def handler(batch: DataFrame, epoch: int) -> None:
        records = parse_lines(batch, schema)
        sink(records if transform is None else transform(records), epoch)

    w = read.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def load_batch(source: DataFrame, transform: Callable[[DataFrame], DataFrame | tuple[DataFrame, DataFrame]],
               sink: Callable[[DataFrame], object], rejected: Callable[[DataFrame], object] | None = None, stored: bool = False) -> object:
    """One batch from a source through a transform into a sink: what a stream does with a micro-batch, without a stream.

    ``transform`` returns the rows to load, or those and the rejected ones, which go to ``rejected``.  The transform's result is
    written once, so the source is read once however often the sink reads it, unless the source is ``stored`` already.  Returns
    what the sink returns.
    """
    made = transform(source)
    rows, bad = made if isinstance(made, tuple) else (made, None)
    if bad is not None and rejected is not None:
        rejected(bad)
    return sink(rows if stored else materialize(rows, "batch"))


def merge_epoch(spark: SparkSession, at: State, rows: DataFrame, keys: list[str], order: str, time: str) -> list:
    """Merge a micro-batch by ``keys`` (latest ``order`` wins, also against what is stored) into the days that it touches; the
    days.  ``time`` is a column of epoch seconds; ``rows`` are on storage and read more than once."""
    rows = rows.withColumn(DAY, date_id(F.timestamp_seconds(time)))
    stored = read_table(spark, at, ROWS, rows.schema)
    batch = dedupe_stored(rows, keys, order)
    # a late copy of a row that is stored in a newer form changes nothing
    newer = stored.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(order).alias("__order"))
    stale = F.lit(True)
    for k in keys:
        stale = stale & (F.col(k) == F.col(f"__{k}"))
    batch = batch.join(newer, stale & (F.col(order) < F.col("__order")), "left_anti")
    merged, days = merge_touched(stored, batch, keys, [], DAY, deduped=True)
    if days:
        put_partitions(at, ROWS, merged, DAY, days)
    return days


def stream_merge_to_table(spark: SparkSession, path: str, raw_schema: T.StructType,
                          ingest: Callable[[DataFrame], tuple[DataFrame, DataFrame]], staged: T.StructType, keys: list[str],
                          order: str, time: str, table_path: str | None = None, checkpoint: str | None = None,
                          archive: str | None = None, max_files_per_trigger: int | None = None,
                          kept: Callable[[DataFrame], DataFrame] = lambda records: records) -> DataFrame:
    """Consume landed files into a stored table of ``staged`` rows keyed by ``keys``, and return it.

    Each micro-batch is written once, as ``kept`` makes it of the records, until its epoch is committed.  It is split by ``ingest``
    into rows and dead letters; the rows are merged into the days that they touch, and both
    are committed under the number of the epoch.  What was committed is found on storage, not kept in memory, so a restarted query
    continues from there.  Checkpoint and archive default to folders next to the table, so running again over the same table
    resumes the stream; a table and its checkpoint belong together, because epochs are counted by the checkpoint.
    """
    base = (table_path or scratch_path(spark, "stream-table")).rstrip("/")
    checkpoint, archive = checkpoint or f"{base}_checkpoint", archive or f"{base}_archive"

    def sink(records: DataFrame, epoch: int) -> None:
        if epoch in commits(spark, base):
            return
        at = state(spark, base).next(epoch)
        records = materialize(kept(records), "records")
        for before in [k for k in at.paths if k[0] == FILES]:  # only the last epoch's files are still of use
            del at.paths[before]
        put_partitions(at, FILES, records.select("source_file").distinct().withColumn(EPOCH, F.lit(epoch).cast("long")), EPOCH, [epoch])
        load_batch(records, lambda r: tuple(x.select(*c) for x, c in zip(ingest(r), (staged.names, DEAD_LETTERS.names))),
                   lambda rows: merge_epoch(spark, at, rows, keys, order, time), lambda bad: add_letters(at, bad), stored=True)
        commit(spark, at)
        discard(records)

    q = stream_ingest(spark, path, raw_schema, checkpoint, archive, sink, max_files_per_trigger=max_files_per_trigger)
    q.awaitTermination()
    at = state(spark, base)
    archive_consumed(spark, at, archive)
    return read_table(spark, at, ROWS, T.StructType([*staged.fields, T.StructField(DAY, T.IntegerType())])).select(*staged.names)


def archive_consumed(spark: SparkSession, at: State, archive: str) -> int:
    """Move the files of the last epoch, which the source cleans only when another one follows, below ``archive``; how many.  Files
    keep their path there, as the source does it, and one that is gone already is left alone."""
    files = read_table(spark, at, FILES, FILE_ROWS).where(F.col(EPOCH) == at.number)
    jvm, moved = spark.sparkContext._jvm, 0
    for row in files.collect():  # the files of one trigger, which the driver lists anyway
        source = jvm.org.apache.hadoop.fs.Path(row["source_file"])
        fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(source):
            continue
        target = jvm.org.apache.hadoop.fs.Path(archive + source.toUri().getPath())
        fs.mkdirs(target.getParent())
        moved += bool(fs.rename(source, target))
    return moved


def stream_dead_letters(spark: SparkSession, table_path: str) -> DataFrame:
    """What the stream into ``table_path`` has rejected."""
    return read_table(spark, state(spark, table_path), LETTERS, DEAD_LETTERS)


def stream_epochs(spark: SparkSession, table_path: str) -> DataFrame:
    """The transaction log: for every epoch the partitions that it wrote (epoch, table, part, path)."""
    root = table_path.rstrip("/")
    log = spark.read.schema(T.StructType([*COMMIT.fields, T.StructField("c", T.LongType())])).json(f"{root}/_commits")
    return log.where(F.col("path").endswith(F.concat(F.lit("c="), F.col("c").cast("string")))).select(F.col("c").alias("epoch"), "table", "part", "path")


def _visits(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    valid, bad = ingest_traffic(records)
    return valid, dead_letters(bad, "traffic")


def _validated(records: DataFrame) -> DataFrame:
    """Orders typed and checked.  An order without lines has no key in a table of lines: it is rejected.  Only what is rejected
    keeps its text."""
    empty = F.coalesce(F.size("item_list") == 0, F.lit(False))
    v = validate_orders(records).withColumns({"reason": F.when(empty, F.lit("no line")).otherwise(F.col("reason")), "__ok": F.col("__ok") & ~empty})
    return v.withColumn("raw_record", F.when(~F.col("__ok"), F.col("raw_record")))


def _lines(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    valid, bad = split_orders(orders)
    return valid, dead_letters(bad, "orders")


def stream_ingest_to_table(spark: SparkSession, path: str, table_path: str | None = None, checkpoint: str | None = None,
                           archive: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed web sessions -> staged sessions keyed by ``session_id`` (see :func:`stream_merge_to_table`)."""
    return stream_merge_to_table(spark, path, RAW_VISIT, _visits, STG_TRAFFIC, ["session_id"], "visit_time", "visit_time",
                                 table_path, checkpoint, archive, max_files_per_trigger)


def stream_ingest_orders_to_table(spark: SparkSession, path: str, table_path: str | None = None, checkpoint: str | None = None,
                                  archive: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed nested orders -> flat staged lines keyed by ``line_item_id``.  Invalid orders go to the dead letters."""
    return stream_merge_to_table(spark, path, RAW_ORDER, _lines, STG_ORDERS, ["line_item_id"], "updated_at", "order_time",
                                 table_path, checkpoint, archive, max_files_per_trigger, kept=_validated)
