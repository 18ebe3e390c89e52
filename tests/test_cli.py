from contrail import cli
from contrail.plans import views as V
from contrail.session import scratch_path
from contrail.sources.feeds import land_json
from contrail.sources.sinks import latest_run, read_table, write_run

SF = "/root/testdata/sf0.001"


def test_cli_ingest_clean_indicators(spark, tmp_path, capsys):
    # ingest: landed JSON under a schema file -> bronze run
    landing, bronze = scratch_path(spark, "cli_land"), scratch_path(spark, "cli_bronze")
    ev = V.events(spark, SF)
    land_json(ev, landing)
    schema = tmp_path / "events.json"
    schema.write_text(ev.schema.json())
    assert cli.main(["ingest", "--landing", landing, "--schema", str(schema), "--bronze", bronze,
                     "--as-of", "2024-02-01 00:00:00", "--files-per-run", "2"], spark) == 0
    assert read_table(spark, bronze).count() == ev.count()
    # clean + indicators over the detail feed
    det_bronze, silver, marts = (scratch_path(spark, n) for n in ("cli_det", "cli_silver", "cli_marts"))
    write_run(V.detail_view(spark, SF).drop("extract_ts"), det_bronze, "2002-01-01 00:00:00")
    assert cli.main(["clean", "--bronze", det_bronze, "--silver", silver], spark) == 0
    assert cli.main(["indicators", "--silver", silver, "--out", marts, "--as-of", "1998-01-01 00:00:00",
                     "--dims", SF, "--names", "current_flight_by_airline,in_out_flight"], spark) == 0
    assert latest_run(read_table(spark, f"{marts}/in_out_flight")).count() > 0
    assert '"marts"' in capsys.readouterr().out
