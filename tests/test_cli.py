import pytest
from pyspark.sql import functions as F

from brooklet.__main__ import main
from brooklet.operators.cluster import read_clustered
from brooklet.plans.inputs import cleaned, user_events
from brooklet.sources import read_events_table, write_landing
from brooklet.streaming import TableSink
from brooklet.streaming.commits import last_committed

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("unique", ["table", "day", "state"])
def test_ingest_compact_report(spark, tmp_path, capsys, unique):
    landing, table, packed = (str(tmp_path / n) for n in ("in", "table", "packed"))
    write_landing(user_events(spark, SF), landing, 500)
    write_landing(user_events(spark, SF), landing, 500)
    options = ["--landing", landing, "--table", table, "--checkpoint", str(tmp_path / "ck"), "--discard"]
    main(["ingest", *options, "--once", "--max-files", "1", "--unique", unique], spark)
    main(["compact", "--table", table, "--out", packed], spark)
    stored = read_events_table(spark, packed)
    assert stored.count() == cleaned(spark, SF).count()
    main(["report", "--table", packed], spark)
    assert "clean_pct" in capsys.readouterr().out


def test_ingest_with_everything_cluster_and_reports_from_partials(spark, tmp_path, capsys):
    landing, table, out = (str(tmp_path / n) for n in ("in", "table", "clustered"))
    write_landing(user_events(spark, SF), landing, 500)
    folders = [f"--{name}={tmp_path / name}" for name in ("quarantine", "metrics", "commits", "archive")]
    options = ["--landing", landing, "--table", table, "--checkpoint", str(tmp_path / "ck"), *folders]
    main(["ingest", *options, "--raw", "--partials", "--once", "--stop-file", str(tmp_path / "stop")], spark)
    wanted = cleaned(spark, SF)
    main(["cluster", "--table", table, "--out", out], spark)
    assert read_clustered(spark, out).count() == wanted.count()
    main(["report", "--table", table, "--partials"], spark)
    shown = capsys.readouterr().out
    main(["report", "--table", table], spark)
    plain = capsys.readouterr().out
    for title in ("events", "by type", "revenue", "per minute"):
        part = lambda text: text.split(f"== {title}\n")[1].split("== ")[0].splitlines()  # noqa: E731, B023
        assert sorted(part(shown)) == sorted(part(plain))
    assert last_committed(spark, str(tmp_path / "commits"))


@pytest.mark.parametrize("options", [["--table", "t"], ["--discard"], []])
def test_ingest_that_would_lose_rows_is_refused(options):
    with pytest.raises(SystemExit):
        main(["ingest", "--landing", "in", "--checkpoint", "ck", *options])


def test_reports_are_printed_whole(spark, tmp_path, capsys):
    rows = cleaned(spark, SF).withColumn("category", F.concat(F.lit("category "), F.crc32("event_id") % 30))
    TableSink(str(tmp_path / "t"), writer="test")(rows, 0)
    main(["report", "--table", str(tmp_path / "t")], spark)
    out = capsys.readouterr().out
    sold = rows.filter("event_type = 'purchase'").select("category").distinct().collect()
    assert len(sold) == 30
    assert all(f"{r.category}\t" in out for r in sold)
