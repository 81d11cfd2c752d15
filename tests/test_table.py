import os
import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from brooklet.operators import analytics
from brooklet.operators.clean import clean
from brooklet.operators.layout import compact
from brooklet.operators.quality import columns_of, table_columns
from brooklet.plans.inputs import cleaned, scratch
from brooklet.schema import TARGET, TARGET_COLUMNS, create_event_table, to_target
from brooklet.sources import (
    as_landing,
    read_events_csv,
    read_events_jdbc,
    read_events_table,
    read_stored,
    register_events,
    write_landing,
)
from brooklet.streaming import JdbcSink, TableSink

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "t")
    rows = cleaned(spark, SF)
    TableSink(path, writer="test")(rows.filter("event_type = 'view'"), 0)
    TableSink(path, writer="test")(rows, 1)
    return path


def dump(rows):
    return sorted(map(repr, rows.select(*TARGET_COLUMNS).collect()))


def test_table_holds_all_rows_once(spark, stored):
    assert dump(read_events_table(spark, stored)) == dump(to_target(cleaned(spark, SF)))


def test_a_table_can_be_replayed(spark, stored, tmp_path):
    events = read_events_table(spark, stored)
    write_landing(as_landing(events), str(tmp_path / "in"), 100)
    again = clean(read_events_csv(spark, str(tmp_path / "in")))
    def shown(rows):
        return sorted(map(repr, to_target(rows).drop("ingested_at").collect()))
    assert shown(again) == shown(events)


def test_one_file_per_quiet_day(spark, stored, tmp_path):
    for path in (stored, str(tmp_path / "packed")):
        if path != stored:
            compact(read_stored(spark, stored), path)
        folders = [file.parent for file in Path(path).rglob("*.parquet")]
        assert len(folders) == len(set(folders)) >= 30


def test_sql_over_the_table(spark, stored):
    events = read_events_table(spark, stored)
    register_events(events)
    found = spark.sql(
        "SELECT category, CAST(sum(total_amount) AS double) AS revenue FROM user_events "
        "WHERE event_type = 'purchase' GROUP BY category ORDER BY revenue DESC, category"
    )
    assert found.collect() == analytics.revenue_by_category(events).collect()


def test_typed_table_enforces_the_contract(spark):
    spark.sql("DROP TABLE IF EXISTS typed_events")
    create_event_table(spark, "typed_events")
    create_event_table(spark, "typed_events")  # an existing table is left alone
    names = [c.name for c in TARGET if not c.default]
    def insert(**change):
        row = {"event_id": "'e'", "user_id": "1", "session_id": "'s'", "event_type": "'view'",
               "product_id": "1", "product_name": "'n'", "category": "'c'", "price": "1.5",
               "total_amount": "1.5", "event_timestamp": "timestamp'2024-01-01 00:00:00'"} | change
        values = ", ".join(row[n] for n in names)
        spark.sql(f"INSERT INTO typed_events ({', '.join(names)}) VALUES ({values})")
    insert()
    row = spark.table("typed_events").first()
    assert row.quantity == 1 and row.ingested_at is not None
    for bad in ({"event_id": f"'{'x' * 37}'"}, {"category": f"'{'c' * 51}'"}, {"price": "123456789"}):
        with pytest.raises(Exception):
            insert(**bad)
    assert spark.table("typed_events").count() == 1
    columns = [(c.column_name, c.data_type) for c in table_columns(spark.table("typed_events")).collect()]
    assert columns == [(c.name, c.kind) for c in TARGET]
    insert(user_id="NULL")  # file tables take NULLs whatever is declared, hence the contract check
    assert all(c.is_nullable == "YES" for c in table_columns(spark.table("typed_events")).collect())
    named = [(c.column_name, c.data_type) for c in columns_of(spark, "typed_events").collect()]
    assert [n for n, _ in named] == TARGET_COLUMNS and dict(named)["price"] == "decimal(10,2)"


def test_compacted_copy_is_whole_and_pruned(spark, stored, tmp_path):
    packed = str(tmp_path / "packed")
    compact(read_stored(spark, stored), packed)
    events = read_events_table(spark, packed)
    assert dump(events) == dump(read_events_table(spark, stored))
    since, until = datetime(2024, 1, 10), datetime(2024, 1, 11)
    day = read_events_table(spark, packed, since, until)
    wanted = events.filter((F.col("event_timestamp") >= since) & (F.col("event_timestamp") < until))
    assert dump(day) == dump(wanted) != []
    scan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in scan
    create_event_table(spark, "packed_events", packed)
    assert spark.table("packed_events").count() == events.count()


def test_compaction_rewrites_only_days_with_new_rows(spark, tmp_path):
    table, packed = str(tmp_path / "t"), str(tmp_path / "packed")
    rows = cleaned(spark, SF)
    TableSink(table, writer="test")(rows.filter("event_timestamp < '2024-01-20'"), 0)
    compact(read_stored(spark, table), packed)
    def written():
        return {p.parent.name: p.name for p in Path(packed).rglob("*.parquet")}
    before = written()
    time.sleep(0.01)
    TableSink(table, writer="test")(rows.filter("event_timestamp >= '2024-01-19'"), 1)
    for _ in range(2):
        compact(read_stored(spark, table), packed, since_batch=1)
    after = written()
    assert {d: f for d, f in after.items() if d < "event_date=2024-01-20"} == before
    assert dump(read_events_table(spark, packed)) == dump(to_target(rows))


def test_hot_day_is_split(spark, tmp_path):
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    rows = session.range(30_000).selectExpr(
        "uuid() AS event_id", "CAST(id % 500 AS int) AS user_id", "'s' AS session_id", "'view' AS event_type",
        "1 AS product_id", "'n' AS product_name", "'c' AS category", "CAST(1 AS decimal(10,2)) AS price",
        "1 AS quantity", "CAST(1 AS decimal(10,2)) AS total_amount",
        "CASE WHEN id % 3 = 0 THEN timestamp'2024-01-01 00:00:00' "
        "ELSE timestampadd(DAY, id % 20, timestamp'2024-02-01 00:00:00') END AS event_timestamp",
        "timestamp'2024-03-01 00:00:00' AS ingested_at",
    ).withColumn("event_date", F.to_date("event_timestamp"))
    compact(rows, str(tmp_path / "packed"))
    files = list(Path(tmp_path, "packed", "event_date=2024-01-01").glob("*.parquet"))
    assert len(files) > 1
    assert read_events_table(spark, str(tmp_path / "packed")).count() == 30_000


def test_compaction_scans_only_the_days_it_rewrites(spark, stored):
    rows = read_stored(spark, stored)
    days = rows.filter("batch_id >= 1").select("event_date").distinct()
    plan = rows.join(F.broadcast(days), "event_date", "left_semi")._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()


def rows_scanned(frame):
    """Rows the file scans of an executed plan gave, by number of columns read."""
    frame.collect()
    found = {}

    def walk(node):
        name = node.nodeName()
        if name.startswith("Scan"):
            rows = node.metrics().apply("numOutputRows").value()
            found[node.output().size()] = rows
        if name == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif "QueryStage" in name:
            walk(node.plan())
        else:
            for i in range(node.children().size()):
                walk(node.children().apply(i))

    walk(frame._jdf.queryExecution().executedPlan())
    return found


def test_latest_rows_of_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = cleaned(spark, SF).persist()
    for batch, day in enumerate(("2024-01-01", "2024-01-10", "2024-01-20")):
        TableSink(path, writer="test")(rows.filter(f"event_timestamp >= '{day}' AND event_timestamp < date'{day}' + 9"), batch)
    events = read_events_table(spark, path)
    rows.unpersist()
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == "INT96"  # put back
    whole = rows_scanned(events)
    newest = rows_scanned(analytics.latest_stored(events))
    assert newest[max(newest)] < whole[max(whole)] / 10  # statistics skip the older files
    for n in (1, 5, 100, 10_000):
        assert analytics.latest_stored(events, n).collect() == analytics.latest_events(events, n).collect()
    assert analytics.latest_stored(events.filter("1 = 0")).count() == 0
    plan = analytics.latest_stored(events)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ingested_at:timestamp>" in plan


def test_newest_minutes_skip_older_days(spark, stored):
    events = read_events_table(spark, stored, with_day=True)
    for last in (1, 3, 10, 10_000):
        newest = analytics.newest_minutes(events, last)
        assert newest.collect() == analytics.events_per_minute(events, last).collect()
    whole = rows_scanned(analytics.events_per_minute(events, 3))
    newest = rows_scanned(analytics.newest_minutes(events, 3))
    assert newest[max(newest)] < whole[max(whole)] / 3


def test_running_total_by_batch(spark, stored):
    rows = read_stored(spark, stored)
    found = analytics.running_total(rows, "batch_id").orderBy("batch_id").collect()
    counts = [rows.filter(F.col("batch_id") == i).count() for i in (0, 1)]
    assert [tuple(r) for r in found] == [(0, counts[0], counts[0]), (1, counts[1], sum(counts))]


class RecordingSink(JdbcSink):
    """Keeps what would go to the database."""

    def stored(self, rows):
        return rows.sparkSession.createDataFrame([(k,) for k in self.options["have"].split()], "event_id string")

    def write(self, rows):
        self.options["sent"] = " ".join(sorted(r.event_id for r in rows.collect()))


def test_jdbc_replay_sends_only_what_is_missing(spark):
    rows = cleaned(spark, SF).limit(3)
    ids = sorted(r.event_id for r in rows.collect())
    sink = RecordingSink("jdbc:none", options={"have": ids[0]})
    sink(rows.unionByName(rows), 4)
    assert sink.options["sent"].split() == ids[1:]


def test_jdbc_options():
    sink = JdbcSink("jdbc:postgresql://db/shop", options={"user": "u"})
    assert sink.write_options() == {
        "url": "jdbc:postgresql://db/shop",
        "dbtable": "user_events",
        "ssl": "true",
        "sslmode": "require",
        "user": "u",
        "batchsize": "1000",
        "numPartitions": "2",
        "isolationLevel": "READ_COMMITTED",
    }


def test_jdbc_lookup_is_bounded_and_split(spark):
    sink = JdbcSink("jdbc:postgresql://db/shop", readers=6)
    options = sink.lookup_options(datetime(2024, 1, 1), datetime(2024, 1, 2))
    assert options["partitionColumn"] == "event_timestamp"
    assert (options["lowerBound"], options["upperBound"]) == ("2024-01-01 00:00:00", "2024-01-02 00:00:01")
    assert options["numPartitions"] == "6"


class MergingSink(JdbcSink):
    """Stages and merges in an engine inside this process."""

    def stage(self, rows, stream):
        import duckdb

        frame = rows.toPandas()  # noqa: F841  read by name
        with duckdb.connect(self.url) as database:
            database.execute(f"CREATE OR REPLACE TABLE {self.staging(stream)} AS SELECT * FROM frame")

    def execute(self, spark, statements):
        import duckdb

        with duckdb.connect(self.url) as database:
            database.execute("BEGIN")
            for text in statements:
                database.execute(text)
            if self.options.get("lost"):
                self.options.clear()
                raise RuntimeError("lost before the commit")
            database.execute("COMMIT")


def test_jdbc_merge_takes_copies_with_other_times_and_replays(spark, tmp_path):
    import duckdb

    sink = MergingSink(str(tmp_path / "db"), merge=True, writer="s'1")
    rows = cleaned(spark, SF).limit(4).persist()
    ids = sorted(r.event_id for r in rows.collect())
    with duckdb.connect(sink.url) as database:
        columns = ", ".join(c.ddl for c in TARGET).replace("`", "").replace("string", "varchar")
        database.execute(f"CREATE TABLE user_events ({columns.replace('current_timestamp()', 'now()')}, PRIMARY KEY (event_id))")

    def stored():
        with duckdb.connect(sink.url) as database:
            found = database.execute("SELECT event_id, category FROM user_events ORDER BY event_id").fetchall()
            return found, database.execute("SELECT * FROM user_events_batches ORDER BY ALL").fetchall()

    sink(rows.filter(F.col("event_id") != ids[3]).unionByName(rows.filter(F.col("event_id") == ids[0])), 0)
    first = stored()
    assert [i for i, _ in first[0]] == ids[:3] and first[1] == [("s'1", 0)]
    # A copy with another time and category does not collide, and does not win.
    later = rows.withColumns({"event_timestamp": F.col("event_timestamp") + F.expr("INTERVAL 40 DAYS"), "category": F.lit("x")})
    sink.options["lost"] = "once"
    with pytest.raises(RuntimeError):
        sink(later, 1)
    assert stored() == first
    sink(later, 1)
    found, marks = stored()
    assert found[:3] == first[0] and found[3] == (ids[3], "x") and marks == [("s'1", 0), ("s'1", 1)]
    sink(rows.withColumn("event_id", F.concat(F.lit("late "), "event_id")), 1)  # marked: merged before
    assert stored() == (found, marks)


def test_jdbc_merge_options():
    sink = JdbcSink("jdbc:postgresql://db/shop", merge=True, writer="a-b")
    options = sink.staging_options("a-b")
    assert (options["dbtable"], options["truncate"]) == ("user_events_staging_a_b", "true")
    create, insert, mark = sink.merge_statements("a-b", 7)
    assert "ON CONFLICT (event_id) DO NOTHING" in insert and "user_events_staging_a_b" in insert
    assert "('a-b', 7)" in insert and "('a-b', 7)" in mark and "PRIMARY KEY (stream, batch_id)" in create


def test_jdbc_without_a_driver_fails(spark):
    with pytest.raises(Exception, match="driver"):
        JdbcSink("jdbc:nosuchdb:x", resume=False)(cleaned(spark, SF), 0)
    with pytest.raises(Exception, match="driver"):
        JdbcSink("jdbc:nosuchdb:x").execute(spark, ["SELECT 1"])
    with pytest.raises(Exception, match="driver"):
        read_events_jdbc(spark, "jdbc:nosuchdb:x", "t", datetime(2024, 1, 1), datetime(2024, 2, 1))


def test_scratch_is_in_the_shared_folder(spark):
    assert scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch(spark, "x") != scratch(spark, "x")
    assert not os.path.exists(scratch(spark, "x"))
