from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from brooklet.functions import batch_boundary, cents, parse_event_time
from brooklet.operators.clean import clean, has_known_type, has_positive_money, has_required_fields
from brooklet.operators.contract import accepted, check, rejected, violations
from brooklet.schema import SOURCE_COLUMNS, SOURCE_FIELDS, TARGET_COLUMNS, to_target
from brooklet.sources import read_events_csv
from dirty import CASES, EXTRA, SHORT, dirty_lines, write_csv


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("dirty")
    return read_events_csv(spark, write_csv(folder / "dirty.csv", dirty_lines())).cache()


def key(event_id):
    return event_id or None


def test_filters_keep_what_they_should(raw):
    kept = sorted(r.event_id for r in clean(raw).collect())
    assert kept == sorted([i for i, _, keep, _ in CASES if keep] + [SHORT[0], EXTRA[0]])


def test_filter_order_does_not_matter(raw):
    one = raw.filter(has_positive_money()).filter(has_known_type()).filter(has_required_fields())
    assert sorted(r.event_id for r in one.collect()) == sorted(r.event_id for r in clean(raw).collect())


def test_columns_in_target_order(raw):
    assert clean(raw).columns == TARGET_COLUMNS
    assert raw.columns == SOURCE_COLUMNS
    assert dict(raw.dtypes) == SOURCE_FIELDS


def test_money_is_filtered_before_it_is_rounded(raw):
    prices = {r.event_id: r.price for r in clean(raw).collect()}
    assert prices["d13"] == 0.0
    assert prices["d14"] == 1.01
    assert prices["d01"] == 9.99


def test_every_reason(raw):
    found = {(r.event_id, r.reason) for r in violations(check(raw)).collect()}
    wanted = {(key(i), reason) for i, _, _, reasons in CASES for reason in reasons}
    assert found == wanted | {(SHORT[0], "event_timestamp_null")}


def test_split_is_whole(raw):
    checked = check(raw)
    good, bad = accepted(checked), rejected(checked)
    assert good.count() + bad.count() == raw.count()
    assert good.columns == [c for c in TARGET_COLUMNS]
    strictly_clean = {i for i, _, keep, reasons in CASES if keep and not reasons} | {EXTRA[0]}
    assert {r.event_id for r in good.collect()} == strictly_clean
    assert bad.filter(F.size("reasons") == 0).count() == 0


def test_accepted_rows_fit_the_table(raw):
    stored = {r.event_id: r for r in to_target(accepted(check(raw))).collect()}
    assert stored["d14"].price == Decimal("1.01")
    assert stored["d31"].total_amount == Decimal("99999999.99")
    assert all(v is not None for row in stored.values() for v in row)


def test_time_zone_is_a_parameter(spark):
    row = spark.createDataFrame([("2024-07-01 12:00:00",), ("2024-07-01 12:00",)], "t string")
    utc = [r[0] for r in row.select(parse_event_time(F.col("t"))).collect()]
    paris = [r[0] for r in row.select(parse_event_time(F.col("t"), "Europe/Paris")).collect()]
    micros = [r[0] for r in row.select(F.unix_micros(parse_event_time(F.col("t"), "Europe/Paris"))).collect()]
    assert utc[1] is None and paris[1] is None and micros[1] is None
    assert micros[0] == 1719828000 * 1_000_000  # 10:00 UTC


def test_ingest_time_is_one_constant(raw):
    assert clean(raw).select("ingested_at").distinct().count() == 1


def test_boundary(spark):
    row = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS a, timestamp'2024-01-01 00:00:01' AS b")
    whole, next_one = row.select(batch_boundary(F.col("a")), batch_boundary(F.col("b"))).first()
    assert (next_one - whole).total_seconds() == 10
    assert whole.replace(tzinfo=None) == row.first().a.replace(tzinfo=None)
    assert isinstance(whole, datetime)


def test_cents_are_exact(spark):
    amounts = [0.01, 0.07, 0.29, 1.15, 4.35, 8.2, 99999999.99, 64.1]
    rows = spark.createDataFrame([(a,) for a in amounts], "x double")
    wanted = [int(Decimal(str(a)) * 100) for a in amounts]
    assert [r[0] for r in rows.select(cents(rows, "x")).collect()] == wanted
    exact = rows.select(F.col("x").cast("decimal(10,2)").alias("x"))
    assert [r[0] for r in exact.select(cents(exact, "x")).collect()] == wanted
