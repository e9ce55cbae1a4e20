from __future__ import annotations

import csv
import uuid
from datetime import date, datetime
from pathlib import Path

import pytest
from base_match import BASE_MATCH
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from matchstats.operators.league import league_table
from matchstats.operators.matches import stg_matches
from matchstats.operators.profile import profile_blanks, profile_malformed, summarise
from matchstats.operators.staging import stage_matches
from matchstats.operators.team_stats import team_stats
from matchstats.plans.full_run import Schemas, load_matches, materialise_models, run
from matchstats.schemas import RAW_COLUMNS, STAGED_SCHEMA, WAREHOUSE_COLUMNS
from matchstats.session import scratch_dir
from matchstats.sinks.raw_csv import write_raw
from matchstats.sinks.staged import StagedCounts, stage_and_write, write_staged
from matchstats.sinks.tables import (
    create_matches_table,
    create_schema,
    loader_frame,
    reload_matches,
    save_mart,
    verify_load,
)
from matchstats.sinks.versions import current_version
from matchstats.sources.fixture import FIXTURE_SEASONS, read_fixture
from matchstats.sources.raw_csv import read_raw, read_raw_text
from matchstats.sources.staged import read_staged, require_rows

SF_DIR = "/root/testdata/sf0.001"
STAMP = datetime(2024, 5, 1, 12, 30)


def write_lines(path: Path, header: list[str], *rows: list) -> str:
    with path.open("w", newline="") as f:
        csv.writer(f).writerows([header, *rows])
    return str(path)


def values(**changes) -> list:
    return list((BASE_MATCH | changes).values())


@pytest.fixture(scope="module")
def fixture_staged(spark):
    return stage_matches(read_fixture(spark, SF_DIR), FIXTURE_SEASONS, ingested_at=STAMP)


@pytest.fixture
def schemas(spark):
    names = Schemas(*[f"{layer}_{uuid.uuid4().hex[:8]}" for layer in ("raw", "staging", "marts")])
    for schema in (names.raw, names.staging, names.marts):
        create_schema(spark, schema)
    return names


def table(frame):
    return sorted(map(str, frame.select(*sorted(frame.columns)).collect()))


# --- raw CSV ---------------------------------------------------------------------


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    header = [*reversed(RAW_COLUMNS), "Referee", ""]
    row = [*reversed(values(HomeTeam="Reordered")), "M Dean", "unnamed"]
    path = write_lines(tmp_path / "m.csv", header, row)
    row = read_raw(spark, path).first()
    assert row.asDict() == BASE_MATCH | {"HomeTeam": "Reordered"}


def test_csv_missing_columns_are_named(spark, tmp_path):
    path = write_lines(tmp_path / "m.csv", RAW_COLUMNS[2:], values()[2:])
    with pytest.raises(ValueError, match="columns Season, MatchDate"):
        read_raw(spark, path)


def test_csv_missing_file_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere.csv"):
        read_raw(spark, str(tmp_path / "nowhere.csv"))


def test_csv_files_with_different_headers_are_refused(spark, tmp_path):
    write_lines(tmp_path / "a.csv", RAW_COLUMNS, values())
    write_lines(tmp_path / "b.csv", list(reversed(RAW_COLUMNS)), list(reversed(values())))
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        read_raw(spark, str(tmp_path)).collect()


def test_csv_short_long_and_malformed_lines(spark, tmp_path):
    path = write_lines(
        tmp_path / "m.csv",
        RAW_COLUMNS,
        values(HomeTeam="short")[:6],
        [*values(HomeTeam="long"), "extra", "fields"],
        values(HomeTeam="numbers", HomeShots="2.0", AwayShots=" 5 ", HomeFouls=""),
    )
    rows = {r["HomeTeam"]: r for r in read_raw(spark, path).collect()}
    assert rows["short"]["FullTimeAwayGoals"] == 0
    assert rows["short"]["FullTimeResult"] is None
    assert rows["long"].asDict() == BASE_MATCH | {"HomeTeam": "long"}
    assert (rows["numbers"]["HomeShots"], rows["numbers"]["AwayShots"]) == (None, None)
    assert rows["numbers"]["HomeShotsOnTarget"] == 4
    blanks = {r[0]: r[1] for r in profile_blanks(summarise(read_raw_text(spark, path))).collect()}
    assert (blanks["HomeShots"], blanks["HomeFouls"], blanks["Season"]) == (1, 2, 0)
    summary = summarise(read_raw_text(spark, path))
    malformed = {r[0]: r[1] for r in profile_malformed(summary).where("malformed > 0").collect()}
    assert malformed == {"HomeShots": 1, "AwayShots": 1}


def test_csv_roundtrip_keeps_nulls_and_padding(spark, tmp_path):
    source = read_fixture(spark, SF_DIR)
    write_raw(source, str(tmp_path / "raw"))
    assert table(read_raw(spark, str(tmp_path / "raw"))) == table(source)


# --- staged Parquet --------------------------------------------------------------


def test_staged_roundtrip_one_file_per_season(spark, fixture_staged, tmp_path):
    path = tmp_path / "staged"
    write_staged(fixture_staged, str(path))
    back = read_staged(spark, str(path))
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in STAGED_SCHEMA]
    assert table(back) == table(fixture_staged)
    assert len(list(path.glob("season_start_year=*"))) == 6
    assert len(list(path.glob("season_start_year=*/*.parquet"))) == 6


def test_dominant_season_is_split_over_tasks(spark, tmp_path):
    hot = (
        spark.range(0, 60_000, 1, 8)
        .withColumns({c: F.lit(BASE_MATCH[c]) for c in RAW_COLUMNS})
        .withColumn("HomeTeam", F.sha2(F.col("id").cast("string"), 256))
    )
    staged = stage_matches(hot, "2015")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "256k")
    try:
        write_staged(staged, str(tmp_path / "hot"))
    finally:
        spark.conf.unset(key)
    assert len(list((tmp_path / "hot").glob("season_start_year=2015/*.parquet"))) > 4
    assert read_staged(spark, str(tmp_path / "hot")).count() == 60_000


def test_overwrite_drops_old_seasons_unless_told_otherwise(spark, raw, tmp_path):
    path = str(tmp_path / "staged")

    def seasons():
        return sorted({r["season"] for r in read_staged(spark, path).select("season").collect()})

    both, later = raw({}, {"Season": "2016/17"}), raw({"Season": "2016/17"})
    write_staged(stage_matches(both, "2015,2016"), path)
    write_staged(stage_matches(later, "2016"), path, replace_all=False)
    assert seasons() == ["2015/16", "2016/17"]
    write_staged(stage_matches(later, "2016"), path)
    assert seasons() == ["2016/17"]


def test_counts_are_observed_during_the_write(spark, raw, tmp_path):
    rows = raw({}, {"MatchDate": "bad"}, {"AwayTeam": None})
    rows = rows.union(raw({"Season": "1999/00"}, {"Season": None}))
    counts = stage_and_write(rows, "2015", str(tmp_path / "staged"))
    assert counts == StagedCounts(rows_read=5, rows_selected=3, rows_kept=1)
    assert counts.rows_dropped == 2
    assert read_staged(spark, str(tmp_path / "staged")).count() == 1


def test_a_partial_write_is_counted_against_its_own_seasons(spark, raw, tmp_path, monkeypatch):
    path = str(tmp_path / "staged")
    stage_and_write(raw({}, {"Season": "odd/16"}), None, path)
    monkeypatch.setattr("matchstats.sinks.staged.count_staged", None)
    counts = stage_and_write(raw({"Season": "2016/17"}), None, path, replace_all=False)
    assert counts == StagedCounts(1, 1, 1) and read_staged(spark, path).count() == 3


def test_observed_counts_are_not_trusted_against_the_files(raw, tmp_path, monkeypatch):
    """As after a lost executor, whose tasks are observed twice."""
    twice = {"rows_read": 4, "rows_selected": 4, "rows_kept": 2, "years": [2015], "yearless": 0}
    monkeypatch.setattr(Observation, "get", twice)
    counts = stage_and_write(raw({}, {"MatchDate": "bad"}), "2015", str(tmp_path / "staged"))
    assert counts == StagedCounts(rows_read=2, rows_selected=2, rows_kept=1)


def test_counts_of_no_rows(raw, tmp_path):
    """Also where the optimizer knows that nothing is left."""
    for name, seasons in (("listed", []), ("found", "1999")):
        assert stage_and_write(raw({}), seasons, str(tmp_path / name)) == StagedCounts(1, 0, 0)
    assert stage_and_write(raw({}).where("false"), None, str(tmp_path / "none")) == StagedCounts(0, 0, 0)


def test_season_scan_keeps_rows_of_odd_labels(spark, raw, tmp_path):
    path = str(tmp_path / "staged")
    write_staged(stage_matches(raw({}, {"Season": "first/16"}), ["2015", "first/16"]), path)
    assert read_staged(spark, path, ["2015/16"]).count() == 1
    assert read_staged(spark, path, "first/16,2015").count() == 2
    assert read_staged(spark, path, ["2015/16", "first/16", "x/1"]).count() == 2
    assert read_staged(spark, path, []).count() == 0


def test_each_entry_prunes_to_its_directory(spark, raw, tmp_path):
    path = str(tmp_path / "staged")
    rows = raw({}, {"Season": "2016/17"}, {"Season": "first/16"}, {"Season": "1995/96"})
    write_staged(stage_matches(rows), path)

    def opened(seasons):
        scan = read_staged(spark, path, seasons)
        assert "PartitionFilters: [" in scan._jdf.queryExecution().toString()
        return {f.rpartition("season_start_year=")[2].split("/")[0] for f in scan.inputFiles()}, scan

    folders, scan = opened(["1995/96", "x/1"])
    filters = scan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1]
    assert "1995" in filters.split("]")[0]
    assert scan.count() == 1
    assert read_staged(spark, path, ["first/16"]).count() == 1


def test_a_quoted_line_break_needs_the_reading_option(spark, tmp_path):
    path = write_lines(tmp_path / "m.csv", RAW_COLUMNS, values(HomeTeam="two\nlines"))
    assert read_raw(spark, path, multiLine=True).first()["HomeTeam"] == "two\nlines"
    assert read_raw(spark, path).count() == 2


def test_missing_or_empty_staged_data(spark, raw, tmp_path):
    with pytest.raises(FileNotFoundError, match="nothing"):
        read_staged(spark, str(tmp_path / "nothing"))
    with pytest.raises(ValueError, match="empty holds no rows"):
        require_rows(raw({}).where("false"), "empty")


# --- typed table, views, marts ---------------------------------------------------


def test_reload_is_idempotent_and_typed(spark, fixture_staged, schemas, tmp_path):
    path, name = str(tmp_path / "staged"), f"{schemas.raw}.matches"
    write_staged(fixture_staged, path)
    first = load_matches(spark, path, schemas).collect()
    before = table(spark.table(name))
    assert load_matches(spark, path, schemas).collect() == first
    assert table(spark.table(name)) == before
    assert first[0]["rows_loaded"] == fixture_staged.count()
    assert first[0]["seasons"] == 6
    declared = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE {name}").collect()}
    assert {c: declared[c] for c, _ in WAREHOUSE_COLUMNS} == {c: t.lower() for c, t in WAREHOUSE_COLUMNS}


def test_reload_replaces_seasons_and_matches_by_name(spark, raw, schemas):
    name = f"{schemas.raw}.matches"
    create_matches_table(spark, name)
    reload_matches(stage_matches(raw({}, {"Season": "2016/17"}), "2015,2016"), name)
    shuffled = stage_matches(raw({"HomeTeam": "Only"}), "2015")
    reload_matches(shuffled.select(*sorted(shuffled.columns)), name)
    (row,) = spark.table(name).collect()
    assert (row["home_team"], row["away_team"], row["season"]) == ("Only", "B", "2015/16")
    assert row["match_date"] == date(2015, 8, 8)
    assert isinstance(row["ingested_at"], str)


def test_reload_drops_seasons_no_longer_staged(spark, raw, schemas):
    name = f"{schemas.raw}.matches"
    create_matches_table(spark, name)

    def seasons():
        return sorted(r["season"] for r in spark.table(name).select("season").distinct().collect())

    reload_matches(stage_matches(raw({}, {"Season": "odd/16"}, {"Season": "2016/17"}), "2015,odd,2016"), name)
    assert seasons() == ["2015/16", "2016/17", "odd/16"]
    reload_matches(stage_matches(raw({"Season": "2016/17"}), "2016"), name)
    assert seasons() == ["2016/17"]
    version = f"{name}__{current_version(spark, name)[0]}"
    assert spark.sql(f"SHOW PARTITIONS {version}").count() == 1
    reload_matches(stage_matches(raw({}), []), name)
    assert spark.table(name).count() == 0


def test_a_fresh_catalog_finds_the_table_again(spark, raw, schemas, tmp_path):
    placed = Schemas(schemas.raw, schemas.staging, schemas.marts, str(tmp_path / "tables"))
    both = stage_matches(raw({}, {"Season": "2016/17"}, {"Season": "odd/16"}), "2015,2016,odd")
    for staged in (both, stage_matches(raw({"Season": "2016/17"}), "2016")):
        write_staged(staged, str(tmp_path / "staged"))
        load_matches(spark, str(tmp_path / "staged"), placed)
        spark.sql(f"DROP VIEW {placed.matches}")
        spark.sql(f"DROP TABLE IF EXISTS {placed.marts}.fct_match_kpi")
        for kept in spark.catalog.listTables(schemas.raw):
            spark.sql(f"DROP TABLE {schemas.raw}.{kept.name}")
        kpi = materialise_models(spark, placed)["fct_match_kpi"]
        assert kpi.agg(F.sum("total_matches")).first()[0] == staged.count()


def test_overlong_text_is_refused_and_leaves_the_table(spark, raw, schemas):
    name = f"{schemas.raw}.matches"
    create_matches_table(spark, name)
    reload_matches(stage_matches(raw({}), "2015"), name)
    before = table(spark.table(name))
    with pytest.raises(PySparkException, match="EXCEED_LIMIT_LENGTH|exceeds"):
        reload_matches(stage_matches(raw({"HomeTeam": "x" * 101}), "2015"), name)
    assert table(spark.table(name)) == before
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_loader_frame(raw):
    staged = stage_matches(raw({}), "2015", ingested_at=STAMP)
    loaded = loader_frame(staged.withColumn("match_date", F.lit(None).cast("date")))
    assert loaded.columns == [c.upper() for c in staged.columns]
    row = loaded.first()
    assert row["MATCH_DATE"] is None
    assert row["INGESTED_AT"] == "2024-05-01 12:30:00"


def test_views_and_marts_equal_the_frames(spark, fixture_staged, schemas, tmp_path):
    write_staged(fixture_staged, str(tmp_path / "staged"))
    load_matches(spark, str(tmp_path / "staged"), schemas)
    built = materialise_models(spark, schemas)
    stg = stg_matches(spark.table(f"{schemas.raw}.matches"))
    assert table(built["stg_matches"]) == table(stg)
    stats = team_stats(stg)
    assert built["int_team_stats"].dtypes == stats.dtypes
    assert table(built["int_team_stats"]) == table(stats)
    assert table(spark.table(f"{schemas.marts}.fct_league_table")) == table(league_table(stats))
    kpi = table(built["fct_match_kpi"])
    assert table(materialise_models(spark, schemas)["fct_match_kpi"]) == kpi


def test_a_failing_build_leaves_the_former_mart(spark, schemas):
    name = f"{schemas.marts}.numbers"
    frame = spark.range(5).selectExpr("id", "id * 2 AS double")
    for _ in range(3):
        save_mart(frame, name)
    assert spark.table(name).count() == 5
    failing = frame.selectExpr("id", "CASE WHEN id = 3 THEN raise_error('no') ELSE id END AS double")
    with pytest.raises(PySparkException):
        save_mart(failing, name)
    assert table(spark.table(name)) == table(frame)
    save_mart(frame.limit(2), name)
    assert spark.table(name).count() == 2
    save_mart(frame.selectExpr("id", "'text' AS double"), name)
    assert spark.table(name).dtypes == [("id", "bigint"), ("double", "string")]


def test_a_quote_in_a_folder_name(spark, raw, schemas, tmp_path):
    placed = Schemas(schemas.raw, schemas.staging, schemas.marts, str(tmp_path / "it's"))
    write_staged(stage_matches(raw({}), None), str(tmp_path / "staged"))
    load_matches(spark, str(tmp_path / "staged"), placed)
    assert materialise_models(spark, placed)["fct_match_kpi"].count() == 1


def test_a_dominant_season_is_written_by_date(spark, tmp_path):
    """Files of one season hardly overlap in their dates, and a week opens few of them."""
    hot = (
        spark.range(0, 60_000, 1, 8)
        .withColumns({c: F.lit(BASE_MATCH[c]) for c in RAW_COLUMNS})
        .withColumn("MatchDate", F.expr("cast(date_add(date'2015-08-01', cast(id % 300 as int)) as string)"))
        .withColumn("HomeTeam", F.sha2(F.col("id").cast("string"), 256))
    )
    key, parts = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions"
    former = spark.conf.get(parts)
    spark.conf.set(key, "64k")
    spark.conf.set(parts, "64")
    try:
        write_staged(stage_matches(hot), str(tmp_path / "hot"))
    finally:
        spark.conf.unset(key)
        spark.conf.set(parts, former)
    files = [
        (r["low"], r["high"])
        for r in read_staged(spark, str(tmp_path / "hot"))
        .groupBy(F.input_file_name())
        .agg(F.min("match_date").alias("low"), F.max("match_date").alias("high"))
        .collect()
    ]
    assert len(files) >= 4
    week = (date(2015, 11, 2), date(2015, 11, 8))
    assert sum(low <= week[1] and high >= week[0] for low, high in files) <= len(files) / 2


def test_models_refuse_an_empty_table(spark, schemas):
    create_matches_table(spark, f"{schemas.raw}.matches")
    with pytest.raises(ValueError, match="holds no rows"):
        materialise_models(spark, schemas)


# --- whole run -------------------------------------------------------------------


def test_full_run(spark, schemas, tmp_path):
    source = str(tmp_path / "raw")
    write_raw(read_fixture(spark, SF_DIR), source)
    with pytest.warns(UserWarning) as warned:
        report = run(spark, source, [*FIXTURE_SEASONS, "1890/91"], str(tmp_path / "work"), schemas)
    messages = [str(w.message) for w in warned]
    assert "missing seasons: ['1890/91']" in messages
    assert f"dropped {report.counts.rows_dropped} incomplete rows" in messages
    assert report.counts.rows_dropped > 0
    assert report.load.first()["rows_loaded"] == report.counts.rows_kept
    failed = report.gates.where("not passed").collect()
    assert [(r["check"], r["column"]) for r in failed] == [("season_coverage", "1890/91")]
    assert report.league_table.count() == 120
    assert report.match_kpi.count() == 6
    assert report.quality.count() == 14
    assert report.quality.where("not passed").count() == 0
    loaded = report.load.collect()
    with pytest.warns(UserWarning, match="dropped"):
        again = run(spark, source, FIXTURE_SEASONS, str(tmp_path / "work"), schemas)
    assert again.load.collect() == loaded


def test_scratch_follows_the_session_setting(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(shared) and first != second


def test_verify_load_of_no_rows(raw):
    empty = stage_matches(raw({}), [])
    assert tuple(verify_load(empty).first()) == (0, None, None, 0)
