"""Watermark, run ids, ledger and failures."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tierflow.functions.predicates import moment
from tierflow.plans import ingest
from tierflow.plans.ingest import FAILED, SUCCESS, IngestSpec, RunResult, ledger_row, run_ingest
from tierflow.schemas import INGESTION_HISTORY, empty_table
from tierflow.sources.tables import JdbcSplit, jdbc_options, read_jdbc, read_table, stage

DAY = datetime(2024, 6, 1)


def at(hour, minute=0):
    return DAY + timedelta(hours=hour, minutes=minute)


def spec(**given):
    return IngestSpec(**{"source_table": "order_details", "target_table": "bz_orderdetails",
                         "source": None, "source_server": "s", "source_database": "d", **given})


def run(spark, run_id, start, status, table="order_details", created=None, watermark=None):
    result = RunResult(table, "bz_orderdetails", status, run_id=run_id, watermark=watermark)
    return ledger_row(spark, spec(source_table=table), result, start, start, created or start)


def union(frames):
    total = frames[0]
    for frame in frames[1:]:
        total = total.unionByName(frame)
    return total


def test_watermark(spark):
    ledger = union([run(spark, 1, at(1), SUCCESS), run(spark, 2, at(3), FAILED), run(spark, 3, at(2), SUCCESS),
                    run(spark, 4, at(5), SUCCESS, table="other")])
    assert ingest.watermark(ledger, spec(), by="run_start").first()[:] == (2, at(2))
    source = spark.createDataFrame([(1, at(2)), (2, at(2, 1))], "id int, lastmodifieddate timestamp_ntz")
    assert [r.id for r in ingest.since(source, "lastmodifieddate", at(2)).collect()] == [2]
    assert ingest.watermark(ledger, spec(source_table="none")).first()[:] == (0, None)
    assert ingest.since(source, "lastmodifieddate", None).count() == 2


def test_watermark_is_a_source_time_or_nothing(spark):
    ledger = union([run(spark, 1, at(1), SUCCESS), run(spark, 2, at(9), SUCCESS, watermark=at(4))])
    assert ingest.watermark(ledger, spec()).first()[1] == at(4)
    assert ingest.watermark(ledger, spec(), by="run_start").first()[1] == at(9)
    assert ingest.watermark(run(spark, 1, at(1), SUCCESS), spec()).first()[:] == (1, None)
    with pytest.raises(ValueError):
        ingest.watermark(ledger, spec(), by="clock")


def test_watermarks_of_equal_names_on_two_servers(spark):
    def row(server, hour):
        given = spec(source_server=server)
        result = RunResult("order_details", "bz_orderdetails", SUCCESS, run_id=1, watermark=at(hour))
        return ledger_row(spark, given, result, at(0), at(0), at(0))
    found = ingest.all_watermarks(union([row("a", 1), row("b", 9)]))
    assert sorted((r.source_server_name, r.watermark) for r in found.collect()) == [("a", at(1)), ("b", at(9))]


def test_next_run_id(spark):
    ledger = union([run(spark, 4, at(1), SUCCESS), run(spark, 9, at(0, 30), FAILED)])
    assert ingest.next_run_id(ledger).first()[0] == 5
    tied = ledger.unionByName(run(spark, 7, at(1), SUCCESS))
    assert ingest.next_run_id(tied).first()[0] == 8
    assert ingest.next_run_id(empty_table(spark, INGESTION_HISTORY)).first()[0] == 1


@pytest.fixture
def lake(spark, tmp_path):
    """A source folder, a bronze folder, and a ledger."""
    class Lake:
        ledger, bronze, source = (str(tmp_path / name) for name in ("ledger", "bronze", "source"))
        clock = at(0)

        def add(self, *data):
            spark.createDataFrame(list(data), "id int, lastmodifieddate timestamp_ntz").write.mode(
                "append").parquet(self.source)

        def now(self):
            Lake.clock += timedelta(minutes=1)
            return Lake.clock

        def run(self, *specs):
            return run_ingest(spark, specs, lambda s: s.read.parquet(self.ledger),
                              lambda row: row.write.mode("append").parquet(self.ledger), self.now)

        def spec(self, **given):
            return spec(**{"source": lambda s: s.read.parquet(self.source), "target": self.bronze, **given})

    made = Lake()
    empty_table(spark, INGESTION_HISTORY).write.parquet(made.ledger)
    return made


def test_full_then_incremental_then_empty(spark, lake):
    lake.add((1, at(1)), (2, at(2)))
    first, = lake.run(lake.spec())
    assert (first.status, first.run_id, first.source_rows, first.target_rows) == (SUCCESS, 1, 2, 2)
    assert first.watermark == at(2)
    lake.add((3, at(2)), (4, at(3)))  # row 3 is committed late, with the last stamp of the first load
    second, = lake.run(lake.spec())
    assert (second.run_id, second.source_rows, second.target_rows, second.watermark) == (2, 2, 2, at(3))
    third, = lake.run(lake.spec())
    assert (third.status, third.source_rows, third.target_rows, third.watermark) == (SUCCESS, 0, 0, at(3))
    bronze = spark.read.parquet(lake.bronze)
    assert sorted(r.id for r in bronze.collect()) == [1, 2, 3, 4]
    assert bronze.columns == ["id", "source_modified", "insert_date", "update_date", "load_id", "boundary"]
    assert bronze.select("insert_date").distinct().count() == 2
    ledger = spark.read.parquet(lake.ledger)
    assert ledger.columns == INGESTION_HISTORY.fieldNames()
    assert {r.duration for r in ledger.collect()} == {60.0}


def test_failure_is_recorded_and_the_next_table_loaded(spark, lake):
    lake.add((1, at(1)))

    def down(session):
        raise ConnectionError("source is down")

    bad, good = lake.run(lake.spec(source=down), lake.spec(source_table="second"))
    assert (bad.status, bad.error, bad.source_rows, good.status) == (FAILED, "source is down", None, SUCCESS)
    assert [r.status for r in spark.read.parquet(lake.ledger).orderBy("run_id").collect()] == [FAILED, SUCCESS]
    again, = lake.run(lake.spec())
    assert (again.status, again.source_rows) == (SUCCESS, 1)


def test_written_load_counts_as_done_if_only_the_count_fails(lake):
    lake.add((1, at(1)))

    class Uncounted(IngestSpec):
        def read_target(self, session, schema):
            raise ConnectionError("no answer")

    given = lake.spec()
    result, = lake.run(Uncounted(**{name: getattr(given, name) for name in given.__dataclass_fields__}))
    assert (result.status, result.error, result.source_rows, result.target_rows) == (SUCCESS, "no answer", 1, None)


def loaded(spark, lake):
    return sorted(r.id for r in spark.read.parquet(lake.bronze).collect())


def test_nothing_is_skipped_after_a_load_without_change_times(spark, lake):
    spark.createDataFrame([], "id int, lastmodifieddate timestamp_ntz").write.parquet(lake.source)
    first, = lake.run(lake.spec())  # starts at 00:01
    assert (first.status, first.source_rows, first.watermark) == (SUCCESS, 0, None)
    lake.add((1, datetime(2020, 1, 1)), (2, None))  # stamped long before the empty load
    lake.run(lake.spec())
    assert loaded(spark, lake) == [1, 2]


def test_rows_without_a_change_time_are_loaded_once(spark, lake):
    lake.add((1, None), (1, None))
    lake.run(lake.spec())
    lake.add((2, None), (1, None))
    for _ in range(2):
        lake.run(lake.spec())
        assert loaded(spark, lake) == [1, 1, 1, 2]
    lake.add((3, at(1)), (4, None))
    lake.run(lake.spec())
    lake.add((5, None), (6, at(1)))
    lake.run(lake.spec())
    assert loaded(spark, lake) == [1, 1, 1, 2, 3, 4, 5, 6]


def test_window_ends_at_the_sources_clock_less_a_lag(spark, lake):
    lake.add((1, at(1)), (2, at(2)), (3, at(3)))
    given = {"clock": lambda s: at(3), "lag": timedelta(minutes=30)}
    first, = lake.run(lake.spec(**given))
    assert loaded(spark, lake) == [1, 2] and first.watermark == at(2, 30)
    lake.add((4, at(2, 45)), (5, at(2, 30)))  # committed late, within the lag
    second, = lake.run(lake.spec(clock=lambda s: at(5)))
    assert loaded(spark, lake) == [1, 2, 3, 4, 5] and second.watermark == at(5)
    back, = lake.run(lake.spec(clock=lambda s: at(4)))  # a clock that goes back moves nothing
    assert (back.source_rows, back.watermark) == (0, at(5))


class LostLedger(Exception):
    pass


def run_and_lose_ledger(spark, lake, *specs):
    def lose(row):
        raise LostLedger

    with pytest.raises(LostLedger):
        run_ingest(spark, specs, lambda s: s.read.parquet(lake.ledger), lose, lake.now)


def test_a_load_whose_ledger_row_is_lost_is_stored_once(spark, lake):
    lake.add(*[(i, at(1, i)) for i in range(5)], (9, None))
    run_and_lose_ledger(spark, lake, lake.spec())
    assert loaded(spark, lake) == [0, 1, 2, 3, 4, 9]
    lake.add((5, at(2)), (6, at(1, 1)))  # the second one lies in the window that is read again
    again, after = lake.run(lake.spec())
    assert (again.status, again.source_rows, again.target_rows, again.watermark) == (SUCCESS, 7, 7, at(1, 4))
    assert (after.run_id, after.source_rows, after.watermark) == (2, 1, at(2))
    assert loaded(spark, lake) == [0, 1, 2, 3, 4, 5, 6, 9]
    first = spark.read.parquet(lake.bronze).where("id < 5")
    assert first.select("load_id", "insert_date").distinct().count() == 1
    run_and_lose_ledger(spark, lake, lake.spec())
    lake.run(lake.spec())
    assert loaded(spark, lake) == [0, 1, 2, 3, 4, 5, 6, 9]


def test_a_repeated_load_leaves_nothing_of_its_first_attempt(spark, lake):
    lake.add((1, at(1)))
    run_and_lose_ledger(spark, lake, lake.spec())
    spark.createDataFrame([(7, at(5))], "id int, lastmodifieddate timestamp_ntz").write.mode("overwrite").parquet(lake.source)
    again, after = lake.run(lake.spec())
    assert (again.source_rows, after.source_rows, loaded(spark, lake)) == (0, 1, [7])


def test_loads_of_two_sources_into_one_table_are_told_apart(spark, lake):
    lake.add((1, at(1)))
    run_and_lose_ledger(spark, lake, lake.spec())
    other, = lake.run(lake.spec(source_table="second"))
    assert (other.status, other.source_rows, loaded(spark, lake)) == (SUCCESS, 1, [1, 1])
    lake.run(lake.spec())
    assert loaded(spark, lake) == [1, 1]


def test_a_broken_write_is_repeated(spark, lake):
    lake.add((1, at(1)))

    class Broken(IngestSpec):
        def write(self, rows, load):
            super().write(rows.limit(0), load)
            raise OSError("disk is full")

    given = lake.spec()
    failed, = lake.run(Broken(**{name: getattr(given, name) for name in given.__dataclass_fields__}))
    assert (failed.status, failed.error) == (FAILED, "disk is full")
    assert [r.status for r in lake.run(lake.spec())] == [SUCCESS, SUCCESS] and loaded(spark, lake) == [1]


def test_boundary_rows_are_read_from_their_own_folders(spark, lake):
    lake.add((1, at(1)), (2, at(2)), (3, None))
    lake.run(lake.spec())
    bronze = spark.read.schema(ingest.bronze_schema(spark.read.parquet(lake.source).schema, "lastmodifieddate")).parquet(lake.bronze)
    rows = ingest.fresh_rows(spark.read.parquet(lake.source), "lastmodifieddate", ingest.Window(1, at(2), at(5)), bronze)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((isnull(boundary" in plan
    assert {r.id: r.boundary for r in bronze.collect()} == {1: "-", 2: "2024-06-01 02:00:00", 3: None}
    assert rows.count() == 0


def test_contents_are_compared_after_the_write(spark, lake):
    lake.add((1, at(1)), (2, at(1)), (2, at(1)))
    assert [r.error for r in lake.run(lake.spec(check_contents=True))] == [""]

    class Careless(IngestSpec):
        def write(self, rows, load):
            super().write(rows.withColumn("id", F.abs("id")), load)

    lake.add((-3, at(2)), (4, at(2)))
    given = lake.spec(check_contents=True)
    result, = lake.run(Careless(**{name: getattr(given, name) for name in given.__dataclass_fields__}))
    assert (result.status, result.source_rows, result.target_rows) == (SUCCESS, 2, 2)
    assert result.error == "contents differ from what was written: id, (rows)"


def test_rows_changed_while_a_split_read_runs_are_read_next_time(spark, lake):
    """The upper bound is fixed before the read, so what changes meanwhile lies above it."""
    lake.add((1, at(1)))
    reads = []

    def source(session):
        reads.append(1)
        if len(reads) == 2:  # the bound is known, the read begins
            lake.add((2, at(2)), (3, at(4)))
        return session.read.parquet(lake.source)

    lake.run(lake.spec(source=source))
    assert loaded(spark, lake) == [1]
    lake.run(lake.spec())
    assert loaded(spark, lake) == [1, 2, 3]


def test_only_one_load_is_counted(spark, lake):
    lake.add((1, at(1)))
    result, = lake.run(lake.spec())
    assert result.target_rows == 1
    plan = ingest.loaded(spark.read.parquet(lake.bronze), at(0, 1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_id" in plan


def test_run_start_watermark_reads_rows_stamped_after_the_start_again(lake):
    lake.add((1, at(1)))
    lake.run(lake.spec())  # starts at 00:01
    lake.add((2, at(0)), (3, at(8)))
    result, = lake.run(lake.spec(watermark_by="run_start"))
    assert result.source_rows == 2  # rows 1 and 3


def test_reconcile(spark):
    source = spark.range(3)
    target = source.withColumn("insert_date", moment(at(2))).unionByName(
        source.withColumn("insert_date", moment(at(1))))
    assert ingest.reconcile(source, target, at(2)).first()[:] == (3, 3, True)
    assert ingest.reconcile(source, target, at(1)).first()[:] == (3, 6, False)


def test_incremental_filter_reaches_the_scan(spark, lake):
    lake.add((1, at(1)))
    rows = ingest.bronze_rows(spark.read.parquet(lake.source), "lastmodifieddate", at(0), at(5))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(lastmodifieddate" in plan


def test_moment_keeps_the_wall_clock(spark):
    assert spark.range(1).select(moment(datetime(2024, 3, 31, 2, 30))).first()[0] == datetime(2024, 3, 31, 2, 30)


def test_jdbc_options():
    assert jdbc_options("jdbc:x", table="t") == {"url": "jdbc:x", "dbtable": "t"}
    assert jdbc_options("jdbc:x", query="SELECT 1", options={"fetchsize": 9}) == {
        "url": "jdbc:x", "query": "SELECT 1", "fetchsize": "9"}
    split = jdbc_options("jdbc:x", query="SELECT 1", split=JdbcSplit("id", 0, 100, 4))
    assert split["dbtable"] == "(SELECT 1) split_query" and "query" not in split
    assert (split["partitionColumn"], split["numPartitions"]) == ("id", "4")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x")
    with pytest.raises(ValueError):
        read_jdbc(None, "jdbc:x", query="SELECT 1", predicates=["a = 1"])


class RecordingReader:
    """Stands in for ``spark.read``; notes what a JDBC read asks for."""

    def __init__(self):
        self.read, self.asked = self, {}

    def format(self, name):
        self.asked["format"] = name
        return self

    def options(self, **given):
        self.asked.update(given)
        return self

    def load(self):
        return self.asked

    def jdbc(self, url, table, predicates, properties):
        return {"url": url, "dbtable": table, "predicates": predicates, **properties}


def test_jdbc_reader():
    options = {"user": "u", "fetchsize": 9}
    assert read_jdbc(RecordingReader(), "jdbc:x", "t", options=options) == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "t", "user": "u", "fetchsize": "9"}
    assert read_jdbc(RecordingReader(), "jdbc:x", "t", predicates=["a = 1", "a <> 1"], options=options) == {
        "url": "jdbc:x", "dbtable": "t", "predicates": ["a = 1", "a <> 1"], "user": "u", "fetchsize": "9"}
    parts = read_jdbc(RecordingReader(), "jdbc:x", "t", split=JdbcSplit("day", "2024-01-01", "2024-12-31", 12))
    assert (parts["lowerBound"], parts["upperBound"], parts["numPartitions"]) == ("2024-01-01", "2024-12-31", "12")


def test_sources(spark, tmp_path):
    path = str(tmp_path / "t")
    staged = stage(spark.range(10, numPartitions=1), path)
    assert read_table(spark, "parquet", path=path).count() == 10
    staged.createOrReplaceTempView("ten")
    assert read_table(spark, "table", path="ten").count() == 10
