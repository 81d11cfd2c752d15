import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brooklet.functions import exact_sum
from brooklet.operators import analytics, dedupe, quality
from brooklet.operators.enrich import enrich, unmatched
from brooklet.operators.quality import KPIS
from brooklet.plans.inputs import TABLES, cleaned, slim_events, table
from brooklet.schema import SOURCE_COLUMNS, TARGET

SF = "/root/testdata/sf0.001"
relaxed = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture(scope="module")
def goods(spark):
    return spark.createDataFrame(
        [(1, "Lamp", "Home", 19.99), (2, "Mat", "Sports", 24.99)],
        "product_id bigint, product_name string, category string, price double",
    )


def events(spark, rows):
    rows = [(f"e{i}", 1, "s", kind, product, units, "2024-01-01 00:00:00")
            for i, (kind, product, units) in enumerate(rows)]
    return spark.createDataFrame(
        rows, "event_id string, user_id int, session_id string, event_type string, "
        "product_id bigint, quantity int, timestamp string",
    )


def test_enrich(spark, goods):
    slim = events(spark, [("view", 1, 3), ("purchase", 1, 3), ("purchase", 2, 2), ("view", 9, 1), ("view", None, 1)])
    wide = enrich(slim, goods)
    assert wide.columns == SOURCE_COLUMNS
    found = {r.event_id: (r.product_name, r.quantity, r.total_amount) for r in wide.collect()}
    assert found == {"e0": ("Lamp", 1, 19.99), "e1": ("Lamp", 3, 59.97), "e2": ("Mat", 2, 49.98)}
    assert sorted(r.event_id for r in unmatched(slim, goods).collect()) == ["e3", "e4"]


def final_plan(frame):
    frame.write.format("noop").mode("overwrite").save()
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_small_catalogue_is_broadcast(spark):
    products = spark.read.parquet(f"{SF}/part.parquet").selectExpr(
        "p_partkey AS product_id", "p_name AS product_name", "p_type AS category", "p_retailprice AS price"
    )
    plan = final_plan(enrich(slim_events(spark, SF).withColumnRenamed("units", "quantity"), products))
    assert "BroadcastHashJoin" in plan


def test_hot_product_is_split(spark, goods):
    """Without a broadcast, a product with most of the events is read by many tasks."""
    session = spark.newSession()
    for name, value in {
        "autoBroadcastJoinThreshold": "-1",
        "adaptive.autoBroadcastJoinThreshold": "-1",
        "shuffle.partitions": "8",
        "adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "adaptive.skewJoin.skewedPartitionFactor": "2",
        "adaptive.advisoryPartitionSizeInBytes": "20KB",
    }.items():
        session.conf.set(f"spark.sql.{name}", value)
    slim = session.range(0, 40_000, 1, 8).selectExpr(
        "uuid() AS event_id", "1 AS user_id", "'s' AS session_id", "'view' AS event_type",
        "CASE WHEN id % 3 < 2 THEN 1 ELSE id % 500 END AS product_id", "1 AS quantity",
        "'2024-01-01 00:00:00' AS timestamp",
    )
    products = session.range(500).selectExpr(
        "id AS product_id", "'n' AS product_name", "'c' AS category", "1.5D AS price"
    )
    wide = enrich(slim, products)
    plan = final_plan(wide)
    assert "skew=true" in plan
    assert wide.count() == 40_000


@relaxed
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3), st.integers(0, 3)), max_size=40), st.integers(1, 4))
def test_first_per_key(spark, rows, parts):
    frame = spark.createDataFrame(rows, "k int, t int, v int").repartition(parts)
    found = sorted(tuple(r) for r in dedupe.first_per_key(frame, "k", ["t"]).collect())
    wanted = {}
    for row in sorted(rows):
        wanted.setdefault(row[0], row)
    assert found == sorted(wanted.values())


@relaxed
@given(st.lists(st.integers(0, 30)), st.lists(st.integers(0, 30)))
def test_not_stored(spark, rows, stored):
    new = spark.createDataFrame([(r,) for r in rows], "event_id int")
    old = spark.createDataFrame([(r,) for r in stored], "event_id int")
    found = sorted(r[0] for r in dedupe.not_stored(new, old).collect())
    assert found == sorted(r for r in rows if r not in set(stored))


@relaxed
@given(st.lists(st.integers(-5, 2**62).map(lambda n: f"part-{n}.csv"), min_size=1, max_size=200))
def test_running_total(spark, files):
    """Over names, as sparse as they come."""
    files = files + files[::2]
    frame = spark.createDataFrame([(f,) for f in files], "file_id string").repartition(5)
    found = [tuple(r) for r in analytics.running_total(frame).orderBy("file_id").collect()]
    total, wanted = 0, []
    for file in sorted(set(files)):
        n = files.count(file)
        total += n
        wanted.append((file, n, total))
    assert found == wanted


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr("concat('hot', id % 1) AS event_id", "id AS v")
    plan = dedupe.first_per_key(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_amounts_that_are_not_finite_show_and_do_no_harm(spark):
    rows = [("a", 1.5), ("a", float("nan")), ("b", 2.25), ("c", float("inf")), ("d", None), ("b", 0.25), ("e", 123456789.0)]
    frame = spark.createDataFrame([(*r, "purchase") for r in rows], "category string, total_amount double, event_type string")
    found = {r.category: r.revenue for r in analytics.revenue_by_category(frame).collect()}
    assert found.pop("a") != 0 and found.pop("c") != found.get("c", 0)
    assert found == {"b": 2.5, "d": None, "e": 123456789.0}
    views = frame.withColumn("event_type", F.lit("view"))
    assert analytics.revenue_by_category(views).count() == 0


def test_schema_report_shows_the_table_as_it_is(spark):
    odd = spark.createDataFrame([(1, None), (2, "x")], "price int, event_id string")
    found = [tuple(r) for r in quality.schema_report(odd).collect()]
    assert found == [(1, "price", "int", "NO", 0), (2, "event_id", "string", "NO", 1)]


def test_minutes_have_no_gap_filling(spark):
    rows = spark.sql("SELECT explode(sequence(0, 30, 3)) AS m").selectExpr(
        "timestampadd(MINUTE, m, timestamp'2024-01-01 00:00:20') AS event_timestamp"
    )
    found = analytics.events_per_minute(rows).collect()
    assert [r.event_minute.minute for r in found] == list(range(30, 0, -3))
    assert analytics.events_per_minute(rows, last=None).count() == 11


def test_ties_in_latest_events(spark):
    rows = spark.createDataFrame([(f"e{i}", i // 4) for i in range(9)], "event_id string, ingested_at int")
    rows = rows.orderBy(F.rand(random.randrange(99)))
    assert [r.event_id for r in analytics.latest_events(rows).collect()] == ["e8", "e4", "e5", "e6", "e7"]


def test_share_and_coverage(spark):
    rows = spark.createDataFrame(
        [("view", "A", 1.0)] * 3 + [("purchase", "A", 0.1)] * 3 + [("purchase", "B", 0.25)],
        "event_type string, category string, total_amount double",
    )
    share = {r.event_type: (r.n, r.pct) for r in analytics.event_type_share(rows).collect()}
    assert share == {"view": (3, 42.9), "purchase": (4, 57.1)}
    assert tuple(analytics.category_coverage(rows).first()) == (2, 0.25)
    top = analytics.category_revenue_purchases(rows).collect()
    assert [tuple(r) for r in top] == [("A", 0.3, 3), ("B", 0.25, 1)]


def test_kpis_against_their_targets(spark):
    table = ", ".join(f"CAST(NULL AS {c.kind}) AS {c.name}" for c in TARGET)
    rows = spark.sql(
        f"SELECT {table} FROM range(20)"
    ).selectExpr(
        "concat('e', (row_number() OVER (ORDER BY 1)) % 19) AS event_id", "1 AS user_id", "'s' AS session_id",
        "'view' AS event_type", "1 AS product_id", "'n' AS product_name", "'c' AS category",
        "CAST(1 AS decimal(10,2)) AS price", "1 AS quantity", "CAST(1 AS decimal(10,2)) AS total_amount",
        "timestamp'2024-01-01 00:00:00' AS event_timestamp", "timestamp'2024-01-01 00:00:02' AS ingested_at",
    )
    report = {r.kpi: (r.actual, r["pass"]) for r in quality.kpi_report(rows).collect()}
    assert report == {
        "throughput_per_s": (10.0, True),
        "avg_latency_s": (2.0, True),
        "max_latency_s": (2.0, True),
        "duplicate_pct": (5.0, False),
        "clean_pct": (100.0, True),
    }
    assert [k.name for k in KPIS] == list(report)
    assert quality.duplicate_rows(rows).first()[0] == 1


def test_reports_on_an_empty_table(spark):
    none = cleaned(spark, SF).filter("1 = 0")
    assert analytics.total_events(none).first().n == 0
    assert analytics.revenue_by_category(none).count() == 0
    assert quality.latency_stats(none).first().avg_s is None
    assert quality.kpi_report(none).count() == len(KPIS)
    assert quality.duplicate_rows(none).first()[0] == 0


@pytest.mark.parametrize("scale", ["0.001", "0.01", "0.1"])
@pytest.mark.parametrize("name", TABLES)
def test_declared_tables(spark, scale, name):
    folder = f"/root/testdata/sf{scale}"
    assert table(spark, folder, name).schema == spark.read.parquet(f"{folder}/{name}.parquet").schema


def test_stored_keys_are_scanned_not_shuffled(spark, tmp_path):
    spark.range(1000).selectExpr("id AS event_id", "id AS v").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    new = spark.range(990, 1010).selectExpr("id AS event_id")
    plan = dedupe.not_stored(new, stored)._jdf.queryExecution().executedPlan().toString()
    semi = plan[plan.index("LeftSemi") :]
    assert "BroadcastHashJoin" in plan and "ReadSchema: struct<event_id:bigint>" in plan
    assert "Exchange hashpartitioning" not in semi[: semi.index("Scan parquet")]


@relaxed
@given(st.lists(st.integers(-(2**62), 2**62), min_size=1, max_size=30))
def test_exact_sum(spark, numbers):
    rows = spark.createDataFrame([(n,) for n in numbers], "x bigint").repartition(3)
    assert int(rows.agg(exact_sum(F.col("x"))).first()[0]) == sum(numbers)
