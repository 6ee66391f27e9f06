from clickweir.cli import main
from clickweir.plans.jobs import read_table
from clickweir.session import work_path
from clickweir.sources import clickstream_source
from conftest import SF_SMALL


def test_cli_job_cycle(spark, capsys):
    source = work_path(spark, "cli-source")
    clickstream_source(spark, SF_SMALL).write.parquet(source)
    target = work_path(spark, "cli-target")
    full = main(["full", "--source", source, "--target", target, "--set-hwm"], spark=spark)
    assert full["rows_written"] == 978
    assert main(["incremental", "--source", source, "--target", target], spark=spark)["rows_read"] == 0
    assert main(["preview", "--source", source, "--target", target], spark=spark)["first_rows"] == []
    hist = main(["history", "--target", target, "--limit", "5"], spark=spark)["items"]
    assert [h["job_type"] for h in hist] == ["incremental", "full_snapshot"]
    assert main(["status", "--target", target, "--run-id", full["run_id"]], spark=spark)["rows_written"] == 978
    out = work_path(spark, "cli-marts")
    assert main(["marts", "--target", target, "--out", out], spark=spark)["dates"] is None
    # the latest load is the full snapshot (the empty increment wrote none): all 30 dates
    assert len(main(["marts", "--target", target, "--out", out, "--last-load"], spark=spark)["dates"]) == 30
    kept = work_path(spark, "cli-marts-kept")
    assert len(main(["marts", "--target", target, "--out", kept, "--update"], spark=spark)["loads"]) == 1
    assert main(["marts", "--target", target, "--out", kept, "--update"], spark=spark)["dates"] == []
    main(["reset", "--target", target], spark=spark)
    assert main(["incremental", "--source", source, "--target", target], spark=spark)["rows_read"] == 989
    before = read_table(spark, target).count()
    assert main(["merge", "--target", target], spark=spark)["rows_written"] == before
    assert len(main(["vacuum", "--target", target], spark=spark)["deleted"]) == 2
    assert read_table(spark, target).count() == before
    assert main(["deliver", "--target", target], spark=spark) == {"delivered": []}
    assert '"rows_read": 989' in capsys.readouterr().out


def test_cli_ingest(spark, tmp_path):
    csv = tmp_path / "raw"
    csv.mkdir()
    (csv / "events.csv").write_text(
        "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
        "2019-10-01 00:00:00 UTC,view,1,2,a.b,x,1.50,3,s\n"
        "bad,view,x,2,nan,x,nan,3,s\n"
    )
    table = work_path(spark, "cli-ingest")
    assert main(["ingest", "--csv", str(csv), "--table", table], spark=spark) == {"rows_loaded": 2, "malformed_rows": 0}
    assert main(["ingest", "--csv", str(csv), "--table", table, "--append", "--limit", "1"], spark=spark)["rows_loaded"] == 1
    assert spark.read.parquet(table).count() == 3
