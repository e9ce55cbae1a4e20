from __future__ import annotations

import pytest

from matchstats.__main__ import _show, main
from matchstats.functions.seasons import DEFAULT_SEASONS
from matchstats.sinks.raw_csv import write_raw


def test_steps_one_by_one_and_all_at_once(spark, raw, tmp_path, capsys):
    source = str(tmp_path / "raw")
    write_raw(raw({}, {"HomeTeam": "C"}, {"Season": "1999/00"}), source)
    common = ["--work-dir", str(tmp_path / "work"), "--seasons", "2015"]
    for layer in ("raw", "staging", "marts"):
        common += [f"--{layer}-schema", f"{layer}_cli"]
    for step in ("profile", "stage", "load", "model"):
        main([step, "--source", source, *common])
    shown = capsys.readouterr().out
    assert "rows_read=3, rows_selected=2, rows_kept=2" in shown
    assert "fct_league_table|not_null" in shown
    assert spark.table("marts_cli.fct_league_table").count() == 3
    main(["run", "--source", source, *common])
    shown = capsys.readouterr().out
    assert "Configured seasons" in shown and "required_column" in shown


def test_all_seasons_and_reading_options(spark, raw, tmp_path, capsys):
    source = tmp_path / "raw.csv"
    row = raw({"HomeTeam": "two\nlines"}, {"Season": "1999/00"}).toPandas()
    row.to_csv(source, index=False, sep=";")
    main(
        ["stage", "--source", str(source), "--work-dir", str(tmp_path / "work"), "--all-seasons",
         "--reading", "sep=;", "--reading", "multiLine=true"]
    )
    assert "rows_read=2, rows_selected=2, rows_kept=2" in capsys.readouterr().out


def test_reports_are_printed_whole(spark, capsys):
    _show("Many", spark.range(150).selectExpr("concat('row-', id) AS name"))
    assert "row-149" in capsys.readouterr().out


def test_source_is_required(capsys):
    with pytest.raises(SystemExit):
        main(["stage", "--work-dir", "anywhere"])
    assert "needs --source" in capsys.readouterr().err


def test_default_seasons():
    assert (DEFAULT_SEASONS[0], DEFAULT_SEASONS[-1], len(DEFAULT_SEASONS)) == ("2015/16", "2024/25", 10)
