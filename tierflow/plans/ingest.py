"""Source to bronze: full or incremental load, run ledger, reconciliation."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from tierflow.functions.predicates import moment
from tierflow.operators.digest import content_digest, differing
from tierflow.schemas import INGESTION_HISTORY

log = logging.getLogger(__name__)

SUCCESS, FAILED = "SUCCESS", "FAILED"

# Columns that bronze has besides those of the source: the change time a row was read with, the load
# it came with, and where in the load's window its change time lies. The table is partitioned by the
# last two.
LOAD_COL, TICK_COL, BOUNDARY_COL = "load_id", "source_modified", "boundary"
# Values of the boundary column: NULL for rows without a change time, the time itself for rows stamped
# with the upper end of the window, which the next load reads again, and these for all other rows: of a
# window, and of a load without an upper end.
WITHIN, UNBOUNDED = "-", "any"
IDENTITY = ["source_server_name", "source_database_name", "source_schema_name", "source_table_name",
            "target_database_name", "target_schema_name", "target_table_name"]


@dataclass(frozen=True)
class IngestSpec:
    """One source table, the bronze table it feeds, and how both are reached.

    ``source`` gives the source as a DataFrame; filters on it reach the reader. The target is
    written and read in ``target_format`` with ``target_options``, at the path ``target`` if the
    format has one, partitioned by load. Subclasses may replace ``write`` and ``read_target``.

    ``intents`` is the folder in which loads are announced before they write (default: in the target's
    own folder, where readers don't look). Without it, as for a connector table by default, a load
    whose ledger row is lost is appended again.

    With ``check_contents`` a load's rows are read again after the write and compared with what the
    write observed, column by column.

    ``clock`` asks the source for its time, and ``lag`` is how long a change may be stamped before
    it can be read: a load reads up to that time less the lag. Without a clock a load reads up to
    the highest change time, which it has to look up first.
    """

    source_table: str
    target_table: str
    source: Callable[[SparkSession], DataFrame]
    target: str = ""
    source_server: str = ""
    source_database: str = ""
    source_schema: str = ""
    target_database: str = ""
    target_schema: str = ""
    modified_col: str = "lastmodifieddate"
    watermark_by: str = "source_max"
    clock: Callable[[SparkSession], datetime] | None = None
    lag: timedelta = timedelta(0)
    triggered_by: str = ""
    target_format: str = "parquet"
    target_options: dict[str, str] = field(default_factory=dict)
    intents: str = ""
    check_contents: bool = False

    @property
    def intents_path(self) -> str | None:
        return self.intents or (f"{self.target}/_intents" if self.target else None)

    def write(self, rows: DataFrame, load: str) -> None:
        """Write the rows of a load, in place of those an earlier attempt of it left.

        A connector table is appended to, unless it holds the load: its writes have to be whole.
        """
        if self.target:
            rows.write.format(self.target_format).options(**self.target_options).mode("overwrite").option(
                "partitionOverwriteMode", "static").partitionBy(BOUNDARY_COL).save(f"{self.target}/{LOAD_COL}={load}")
            return
        spark = rows.sparkSession
        rows = rows.withColumn(LOAD_COL, F.lit(load))
        if not self.intents_path or self.read_target(spark, rows.schema).where(F.col(LOAD_COL) == load).isEmpty():
            rows.write.format(self.target_format).options(**self.target_options).mode("append").save()

    def read_target(self, spark: SparkSession, schema: StructType) -> DataFrame:
        reader = spark.read.format(self.target_format).options(**self.target_options)
        # a folder without files has no schema of its own
        return reader.schema(schema).load(self.target) if self.target else reader.load()


def _of(spec: IngestSpec) -> Column:
    return (
        (F.col("source_server_name") == spec.source_server)
        & (F.col("source_database_name") == spec.source_database)
        & (F.col("source_schema_name") == spec.source_schema)
        & (F.col("source_table_name") == spec.source_table)
        & (F.col("target_database_name") == spec.target_database)
        & (F.col("target_schema_name") == spec.target_schema)
        & (F.col("target_table_name") == spec.target_table)
    )


def history_for(ledger: DataFrame, spec: IngestSpec) -> DataFrame:
    """The successful runs of this source and target."""
    return ledger.where(_of(spec) & (F.col("status") == SUCCESS))


def _watermark_col(by: str) -> Column:
    if by == "run_start":
        return F.max("run_start")
    if by == "source_max":
        return F.max("watermark")
    raise ValueError(f"watermark must be source_max or run_start, not {by!r}")


def watermark(ledger: DataFrame, spec: IngestSpec, by: str | None = None) -> DataFrame:
    """One row ``(runs, watermark)``; NULL if no run has seen a change time yet."""
    return history_for(ledger, spec).agg(
        F.count(F.lit(1)).alias("runs"), _watermark_col(by or spec.watermark_by).alias("watermark"))


def all_watermarks(ledger: DataFrame, by: str = "source_max") -> DataFrame:
    """The watermarks of all pairs of source and target, as servers, databases and schemas tell
    them apart, in one pass over the ledger."""
    return ledger.where(F.col("status") == SUCCESS).groupBy(*IDENTITY).agg(
        F.count(F.lit(1)).alias("runs"), _watermark_col(by).alias("watermark"))


def next_run_id(ledger: DataFrame) -> DataFrame:
    """One row ``run_id``: that of the latest row plus one (largest id on ties); 1 if empty."""
    latest = F.max(F.struct("created_date", "run_id"))
    return ledger.where("created_date IS NOT NULL").agg(
        (F.coalesce(latest["run_id"], F.lit(0)) + 1).cast("bigint").alias("run_id"))


def since(source: DataFrame, modified_col: str, after: datetime | str | Column | None) -> DataFrame:
    """Rows modified strictly after the watermark; all rows without one."""
    return source if after is None else source.where(F.col(modified_col) > moment(after))


def add_load_columns(rows: DataFrame, run_ts: datetime | str | Column) -> DataFrame:
    """Stamp all rows with the same load time."""
    return rows.withColumns({"insert_date": moment(run_ts), "update_date": moment(run_ts)})


def bronze_rows(source: DataFrame, modified_col: str, after: datetime | str | Column | None,
                run_ts: datetime | str | Column) -> DataFrame:
    """Rows modified after ``after`` as bronze rows: without the change time, stamped."""
    return add_load_columns(since(source, modified_col, after).drop(modified_col), run_ts)


@dataclass(frozen=True)
class Window:
    """What one load reads: change times above ``low`` up to ``high``, both fixed before the read.

    ``low`` is None before a change time was seen: everything up to ``high`` is read.
    """

    runs: int
    low: datetime | None
    high: datetime | None


def window(spark: SparkSession, ledger: DataFrame, spec: IngestSpec) -> Window:
    """The next window of a source, from its ledger and the source's clock or highest change time."""
    runs, low = watermark(ledger, spec).first()
    if spec.watermark_by == "run_start":
        return Window(runs, low, None)
    if spec.clock:
        high = spec.clock(spark) - spec.lag
    else:
        high = since(spec.source(spark), spec.modified_col, low).agg(F.max(spec.modified_col)).first()[0]
    return Window(runs, low, low if high is None or (low is not None and high < low) else high)


def boundary(tick: Column, span: Window) -> Column:
    """Where a change time lies in a window, as the folder its rows go to."""
    if span.high is None:
        return F.when(tick.isNotNull(), F.lit(UNBOUNDED))
    return F.when(tick.isNull(), F.lit(None)).when(tick == moment(span.high), _stamp(tick)).otherwise(F.lit(WITHIN))


def _stamp(tick: Column) -> Column:
    return tick.cast("timestamp_ntz").cast("string")


def fresh_rows(source: DataFrame, modified_col: str, span: Window, loaded: DataFrame | None) -> DataFrame:
    """The rows of a window that bronze does not have yet.

    Rows stamped ``low`` may have been committed after the load that read up to it, and rows
    without a change time belong to no window. Both are read by every load, and those that the
    earlier loads (``loaded``) hold are left out, copy for copy. All other rows are new. Of bronze
    only the folders of these two kinds are read.
    """
    stamp = F.col(modified_col)
    if span.low is None:
        within = stamp.isNull() if span.high is None else stamp.isNull() | (stamp <= moment(span.high))
        rows = source.where(within)
        return rows if loaded is None else _without(rows, loaded, modified_col, F.lit(True))
    newer = source.where((stamp > moment(span.low)) & (stamp <= moment(span.high)))
    seen = (F.col(modified_col) == moment(span.low)) | F.col(modified_col).isNull()
    where = F.col(BOUNDARY_COL)
    near = loaded.where(where.isNull() | (where == _stamp(moment(span.low))) | (where == UNBOUNDED))
    return newer.unionByName(_without(source.where(seen), near, modified_col, seen))


def _without(rows: DataFrame, loaded: DataFrame, modified_col: str, which: Column) -> DataFrame:
    held = loaded.select(*[F.col(TICK_COL if c == modified_col else c).alias(c) for c in rows.columns]).where(which)
    return rows.exceptAll(held)


def bronze_schema(source: StructType, modified_col: str) -> StructType:
    fields = [StructField(TICK_COL if f.name == modified_col else f.name, f.dataType) for f in source.fields]
    stamps = [StructField(name, TimestampNTZType()) for name in ("insert_date", "update_date")]
    return StructType([*fields, *stamps, StructField(LOAD_COL, StringType()), StructField(BOUNDARY_COL, StringType())])


def load_id(run_ts: datetime) -> str:
    return run_ts.strftime("%Y%m%dT%H%M%S%f")


def loaded(target: DataFrame, run_ts: datetime) -> DataFrame:
    """The rows of one load; no other partition is read."""
    return target.where(F.col(LOAD_COL) == load_id(run_ts))


def reconcile(source: DataFrame, target: DataFrame, loaded_since: datetime | str | Column,
              insert_col: str = "insert_date") -> DataFrame:
    """One row: source rows, target rows loaded since then, and whether they agree."""
    target_rows = target.where(F.col(insert_col) >= moment(loaded_since)).agg(F.count(F.lit(1)).alias("n"))
    return source.agg(F.count(F.lit(1)).alias("source_rows")).select(
        "source_rows", target_rows.scalar().alias("target_rows")
    ).withColumn("agree", F.col("source_rows") == F.col("target_rows"))


@dataclass
class RunResult:
    source_table: str
    target_table: str
    status: str
    error: str = ""
    source_rows: int | None = None
    target_rows: int | None = None
    watermark: datetime | None = None
    run_id: int | None = None


def ledger_row(spark: SparkSession, spec: IngestSpec, result: RunResult, run_start: datetime,
               run_end: datetime, created: datetime) -> DataFrame:
    values = {
        "run_id": result.run_id, "run_start": run_start, "run_end": run_end,
        "duration": (run_end - run_start).total_seconds(),
        "source_server_name": spec.source_server, "source_database_name": spec.source_database,
        "source_schema_name": spec.source_schema, "source_table_name": spec.source_table,
        "target_database_name": spec.target_database, "target_schema_name": spec.target_schema,
        "target_table_name": spec.target_table, "snowflake_flag": False,
        "triggered_by": spec.triggered_by, "status": result.status, "error": result.error,
        "source_nbr_of_records": result.source_rows, "target_nbr_of_records": result.target_rows,
        "created_date": created, "created_by": spec.triggered_by,
        "modified_date": created, "modified_by": spec.triggered_by, "watermark": result.watermark,
    }
    return spark.createDataFrame([tuple(values[f.name] for f in INGESTION_HISTORY.fields)], INGESTION_HISTORY)


# An announced load: the window it reads, its id and stamp, and the last run that had succeeded by then.
INTENT = StructType(
    [StructField(name, StringType()) for name in (LOAD_COL, *IDENTITY)]
    + [StructField("after_run", LongType())]
    + [StructField(name, TimestampNTZType()) for name in ("low", "high", "run_start")])


@dataclass(frozen=True)
class Load:
    """One load: its window, its id and stamp, and whether an earlier run has begun it."""

    span: Window
    load_id: str
    stamp: datetime
    resumed: bool = False


def begin(spark: SparkSession, ledger: DataFrame, spec: IngestSpec, run_ts: datetime) -> Load:
    """Announce the next load, or take up the one that is announced and not in the ledger.

    The announcement is written before any row of the load. If the run ends before its ledger row is
    written, the next run finds it: the load is repeated with the same window, id and stamp, and takes
    the place of whatever the first attempt has left. Which loads are done is told by the ledger
    alone: an announcement counts until a run succeeds after it.
    """
    path = spec.intents_path
    if path is None:
        return Load(window(spark, ledger, spec), load_id(run_ts), run_ts)
    spark.createDataFrame([], INTENT).write.mode("ignore").parquet(path)
    announced = spark.read.schema(INTENT).parquet(path)
    latest = F.max(F.struct("created_date", "run_id"))  # as next_run_id understands it
    last = history_for(ledger, spec).agg(F.coalesce(latest["run_id"], F.lit(0)).alias("run")).first()["run"]
    open_load = announced.where(_of(spec) & (F.col("after_run") == last)).orderBy(F.col("run_start").desc()).first()
    if open_load:
        runs = history_for(ledger, spec).count()
        return Load(Window(runs, open_load["low"], open_load["high"]), open_load[LOAD_COL], open_load["run_start"], True)
    span, name = window(spark, ledger, spec), load_id(run_ts)
    if not announced.where(F.col(LOAD_COL) == name).isEmpty():
        raise RuntimeError(f"load {name} of {spec.target_table} is announced already")
    identity = [spec.source_server, spec.source_database, spec.source_schema, spec.source_table,
                spec.target_database, spec.target_schema, spec.target_table]
    spark.createDataFrame([(name, *identity, last, span.low, span.high, run_ts)], INTENT).coalesce(1).write.mode(
        "append").parquet(path)
    return Load(span, name, run_ts)


@dataclass(frozen=True)
class Written:
    """What a load has written: the schema of bronze, its columns, and what was observed of them."""

    schema: StructType
    columns: list[str]
    seen: dict


def _load(spark: SparkSession, spec: IngestSpec, load: Load, result: RunResult) -> Written:
    """One load. Its row count and its digests are observed by the write itself."""
    span = load.span
    log.info("%s: %s load", spec.source_table, "full" if span.low is None else "incremental")
    result.watermark = span.low
    source = spec.source(spark)
    schema = bronze_schema(source.schema, spec.modified_col)
    if spec.watermark_by == "run_start":
        rows = since(source, spec.modified_col, span.low)
    else:
        # what an earlier attempt of this load has left is not loaded
        earlier = spec.read_target(spark, schema).where(F.col(LOAD_COL) != load.load_id) if span.runs else None
        rows = fresh_rows(source, spec.modified_col, span, earlier)
        result.watermark = span.high
    seen = Observation()
    stamped = add_load_columns(rows.withColumnRenamed(spec.modified_col, TICK_COL), load.stamp)
    columns = stamped.columns
    checks = content_digest(columns) if spec.check_contents else [F.count(F.lit(1)).alias("rows")]
    stamped = stamped.observe(seen, *checks, F.max(TICK_COL).alias("newest"))
    spec.write(stamped.withColumn(BOUNDARY_COL, boundary(F.col(TICK_COL), span)), load.load_id)
    result.source_rows = seen.get["rows"]
    if spec.watermark_by == "run_start" and seen.get["newest"] is not None:
        result.watermark = seen.get["newest"]
    return Written(schema, columns, seen.get)


def _check(spark: SparkSession, spec: IngestSpec, load: Load, written: Written, result: RunResult) -> None:
    """Count the load in the target, and compare its contents if asked for."""
    stored = spec.read_target(spark, written.schema).where(F.col(LOAD_COL) == load.load_id)
    if not spec.check_contents:
        result.target_rows = stored.count()
        return
    found = stored.agg(*content_digest(written.columns)).first().asDict()
    result.target_rows = found["rows"]
    wrong = differing(written.columns, written.seen, found)
    if wrong:
        result.error = f"contents differ from what was written: {', '.join(wrong)}"


def run_ingest(spark: SparkSession, specs: Sequence[IngestSpec], read_ledger: Callable[[SparkSession], DataFrame],
               append_ledger: Callable[[DataFrame], None],
               now: Callable[[], datetime] = datetime.now) -> list[RunResult]:
    """Load the tables one after the other and add a ledger row for each, failed ones included.

    A failure is recorded and the next table is loaded; nothing stops the caller's session.
    A load that was written counts as done: if only the count of the target fails, the row says
    SUCCESS, with the message and no target count. An increment without rows is a success too.
    Two loads of one table may not run at once.

    Every load is stored once: one that a run has begun and not put into the ledger is repeated first,
    with a result and a ledger row of its own, then what came since is loaded.
    """
    results = []
    for spec in specs:
        more = True
        while more:
            result, resumed = _run(spark, spec, read_ledger, append_ledger, now)
            results.append(result)
            more = resumed and result.status == SUCCESS
    return results


def _run(spark: SparkSession, spec: IngestSpec, read_ledger: Callable[[SparkSession], DataFrame],
         append_ledger: Callable[[DataFrame], None], now: Callable[[], datetime]) -> tuple[RunResult, bool]:
    run_start = now()
    result = RunResult(spec.source_table, spec.target_table, SUCCESS)
    resumed = False
    try:
        load = begin(spark, read_ledger(spark), spec, run_start)
        resumed = load.resumed
        written = _load(spark, spec, load, result)
    except Exception as failure:  # the ledger has to record any cause
        log.exception("load of %s failed", spec.source_table)
        result.status, result.error = FAILED, str(failure)
    else:
        try:
            _check(spark, spec, load, written, result)
        except Exception as failure:
            log.exception("count of %s failed", spec.target_table)
            result.error = str(failure)
    run_end = now()
    result.run_id = next_run_id(read_ledger(spark)).first()[0]
    append_ledger(ledger_row(spark, spec, result, run_start, run_end, now()))
    return result, resumed
