"""The typed table's versions: one commit, carried seasons, clean-up, builds that meet."""

from __future__ import annotations

import threading
import uuid

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import matchstats.sinks.versions as versions
from matchstats.files import Files
from matchstats.operators.insights import champions, top_teams
from matchstats.operators.staging import stage_matches
from matchstats.plans.full_run import Schemas
from matchstats.sinks import tables
from matchstats.sinks.layout import Clustering
from matchstats.sinks.tables import create_schema, save_mart, verify_load
from matchstats.sinks.versions import LoadError, clean_up, current_version, exchange, open_table, read_summary, verify_version


@pytest.fixture
def name(spark):
    schema = f"raw_{uuid.uuid4().hex}"
    create_schema(spark, schema)
    open_table(spark, f"{schema}.matches")
    yield f"{schema}.matches"
    spark.sql(f"DROP SCHEMA {schema} CASCADE")


@pytest.fixture
def staged(raw):
    """Complete matches, one for each given season and team."""

    def build(*seasons, team="A", **columns):
        return stage_matches(raw(*[{"Season": s, "HomeTeam": team, **columns} for s in seasons]), None, ingested_at=None).withColumn(
            "ingested_at", F.lit("2024-05-01 12:30:00").cast("timestamp")
        )

    return build


def content(spark, name):
    return sorted((r["season"], r["home_team"]) for r in spark.table(name).select("season", "home_team").collect())


def test_readers_see_whole_contents_only(spark, staged, name):
    """A reader in a loop while two contents of three seasons take turns."""
    seasons = ("2015/16", "2016/17", "odd/16")
    contents = [staged(*seasons, team=t) for t in ("Old", "New")]
    exchange(contents[0], name)
    seen, errors, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.add(tuple(content(spark, name)))
            except Exception as error:  # noqa: BLE001 - handed to the test
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for turn in range(1, 4):
        exchange(contents[turn % 2], name)
    stop.set()
    reader.join()
    assert not errors
    assert seen <= {tuple(sorted((s, t) for s in seasons)) for t in ("Old", "New")}
    assert len(seen) == 2


@pytest.mark.parametrize("step", ["_create_version", "_write", "_carry", "_verify", "_record", "_point"])
def test_a_failure_at_any_step_keeps_the_old_content(spark, staged, name, monkeypatch, step):
    exchange(staged("2015/16", "2016/17"), name)
    before, version = content(spark, name), current_version(spark, name)

    def fail(*_):
        raise OSError(step)

    with monkeypatch.context() as patched:
        patched.setattr(versions, step, fail)
        with pytest.raises(OSError, match=step):
            exchange(staged("2015/16", "2017/18", team="Z"), name)
    assert content(spark, name) == before and current_version(spark, name) == version
    folder = version[1]
    assert len([n for n in Files(spark).ages(folder) if n.startswith("load-")]) == 1
    exchange(staged("2017/18", team="Z"), name)
    assert content(spark, name) == [("2017/18", "Z")]


def test_rows_lost_by_a_write_are_noticed(spark, staged, name, monkeypatch):
    exchange(staged("2015/16"), name)
    write = versions._write
    monkeypatch.setattr(versions, "_write", lambda rows, *rest: write(rows.where("home_team <> 'B2'"), *rest))
    with pytest.raises(LoadError, match="2016"):
        exchange(staged("2015/16").union(staged("2016/17", team="B2")).union(staged("2016/17", team="C")), name)
    assert content(spark, name) == [("2015/16", "A")]


def test_unchanged_seasons_are_carried_over(spark, staged, name):
    exchange(staged("2015/16", "2016/17", "odd/16"), name)

    def folders():
        version, folder = current_version(spark, name)
        return {r["season_start_year"]: r["folder"] for r in read_summary(spark, folder, version).collect()}

    first = folders()
    exchange(staged("2015/16", "odd/16").union(staged("2016/17", team="Z")), name)
    second = folders()
    assert second[2015] == first[2015] and second[None] == first[None] and second[2016] != first[2016]
    assert content(spark, name) == [("2015/16", "A"), ("2016/17", "Z"), ("odd/16", "A")]
    exchange(staged("2015/16"), name)
    assert folders() == {2015: first[2015]} and content(spark, name) == [("2015/16", "A")]
    # The same values in other columns are another season.
    exchange(staged("2015/16", HomeShots=None, AwayShots=10), name)
    exchange(staged("2015/16", HomeShots=10, AwayShots=None), name)
    assert spark.table(name).first()["home_shots"] == 10


def test_replaced_versions_go_after_their_time(spark, staged, name):
    exchange(staged("2015/16", "2016/17"), name)
    for team in ("B", "C", "D"):
        exchange(staged("2015/16").union(staged("2016/17", team=team)), name)
    version, folder = current_version(spark, name)
    schema = name.partition(".")[0]
    assert len(spark.catalog.listTables(schema)) == 6
    clean_up(spark, name, folder, {version}, grace=3600)
    assert len(spark.catalog.listTables(schema)) == 6
    clean_up(spark, name, folder, {version}, grace=0)
    assert len(spark.catalog.listTables(schema)) == 2
    # The first load stays, as the current version names one of its seasons.
    assert len([n for n in Files(spark).ages(folder) if n.startswith("load-")]) == 2
    assert content(spark, name) == [("2015/16", "A"), ("2016/17", "D")]


def test_a_load_is_verified_without_a_scan(spark, staged, name):
    assert tuple(verify_version(spark, name).first()) == (0, None, None, 0)
    exchange(staged("2015/16", "2016/17", "odd/16").union(staged("2015/16", MatchDate="2016-01-02")), name)
    verified = verify_version(spark, name)
    plan = verified._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "_versions" in plan and "home_team" not in plan
    assert verified.collect() == verify_load(spark.table(name)).collect()
    assert verified.dtypes == verify_load(spark.table(name)).dtypes


def test_the_session_is_left_as_it_is(spark, staged, name, monkeypatch):
    settings = {}
    write = versions._write

    def watched(*given):
        settings.update(spark.conf.getAll)
        write(*given)

    monkeypatch.setattr(versions, "_write", watched)
    before = dict(spark.conf.getAll)
    exchange(staged("2015/16"), name)
    assert settings == before == dict(spark.conf.getAll)


def test_a_plain_table_of_the_name_is_kept(spark, staged, raw, tmp_path):
    schemas = Schemas(*(f"{layer}_{uuid.uuid4().hex}" for layer in ("raw", "staging", "marts")))
    create_schema(spark, schemas.raw)
    spark.sql(f"CREATE TABLE {schemas.matches} (x INT) USING parquet")
    schemas.create(spark)
    exchange(staged("2015/16"), schemas.matches)
    assert content(spark, schemas.matches) == [("2015/16", "A")]
    for name in (schemas.raw, schemas.staging, schemas.marts):
        spark.sql(f"DROP SCHEMA {name} CASCADE")


def test_two_builders_of_one_mart(spark, name, monkeypatch):
    """One build ends, and cleans up, while the other has written half of its own."""
    mart = name.replace(".matches", ".numbers")
    frame = spark.range(5).selectExpr("id", "id * 2 AS double")
    for _ in range(2):
        save_mart(frame, mart)
    switch = tables._switch

    def interleaved(own, table, build):
        monkeypatch.setattr(tables, "_switch", switch)
        save_mart(frame.limit(3), mart)
        save_mart(frame.limit(4), mart)
        assert spark.table(mart).count() == 4
        assert spark.read.parquet(build).count() == 2
        return switch(own, table, build)

    monkeypatch.setattr(tables, "_switch", interleaved)
    save_mart(frame.limit(2), mart)
    assert spark.table(mart).count() == 2


def test_builds_and_claims_left_behind(spark, name, monkeypatch):
    mart = name.replace(".matches", ".numbers")
    save_mart(spark.range(5).toDF("id"), mart)
    files = Files(spark)
    base = versions.table_folder(spark, mart)
    spark.range(3).write.parquet(f"{base}/build-gone")
    files.create(f"{base}/_claims/build-gone")
    save_mart(spark.range(5).toDF("id"), mart)
    assert "build-gone" in files.ages(base)
    monkeypatch.setattr(tables, "CLAIM_SECONDS", 0)
    save_mart(spark.range(5).toDF("id"), mart)
    assert "build-gone" not in files.ages(base) and not files.ages(f"{base}/_claims")


def test_files_are_asked_quietly(spark, tmp_path, capfd):
    files = Files(spark)
    assert not files.exists(str(tmp_path / "nothing")) and not files.exists(str(tmp_path / "*.csv"))
    (tmp_path / "a.csv").write_text("x")
    assert files.exists(str(tmp_path / "*.csv")) and files.exists(str(tmp_path / "a.csv"))
    assert files.ages(str(tmp_path / "nothing")) == {}
    assert "Exception" not in capfd.readouterr().err


@pytest.fixture
def league(spark):
    rows = spark.range(40 * 20).selectExpr(
        "concat(1980 + id div 20, '/', lpad((81 + id div 20) % 100, 2, '0')) AS season",
        "cast(1980 + id div 20 AS int) AS season_start_year",
        "cast(1 + id % 20 AS int) AS season_rank", "concat('team ', (id * 7) % 31) AS team",
        "100 - id % 20 AS points", "id % 9 AS goal_difference", "38L AS matches_played",
        "id % 5 AS wins", "id % 7 AS goals_scored",
    )
    schema = f"marts_{uuid.uuid4().hex}"
    create_schema(spark, schema)
    yield rows, f"{schema}.league"
    spark.sql(f"DROP SCHEMA {schema} CASCADE")


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_clustered_mart_prunes_and_needs_no_exchange(spark, league):
    rows, name = league
    by_season = Clustering("season", ("season", "season_rank"))
    save_mart(rows, name, clustering=by_season)
    save_mart(rows, name, clustering=by_season)
    table = spark.table(name)
    assert sorted(table.collect()) == sorted(rows.collect())
    one = table.where("season = '1999/00' AND season_rank <= 4")
    assert "SelectedBucketsCount: 1 out of 8" in _plan(one.groupBy("season").count()) and one.count() == 4
    assert "LessThanOrEqual(season_rank,4)" in _plan(one)
    ranked = Window.partitionBy("season").orderBy("season_rank")
    for frame in (
        table.groupBy("season").agg(F.max("points")),
        table.withColumn("ahead", F.lag("points").over(ranked)),
        champions(table.sortWithinPartitions("season", "season_rank")).where("season > '1990'").groupBy("season").count(),
    ):
        assert "Exchange" not in _plan(frame)
    # Every file holds whole seasons, in order.
    held = [r.season_rank for r in table.where("season = '1985/86'").collect()]
    assert held == sorted(held) and len(held) == 20


def test_mart_by_team_answers_without_an_exchange(spark, league):
    rows, name = league
    expected = top_teams(rows).collect()
    save_mart(rows, name)
    assert "Exchange" in _plan(top_teams(spark.table(name)))
    save_mart(rows, name, clustering=Clustering("team", ("team", "season_start_year")))
    table = spark.table(name)
    assert "Exchange" not in _plan(top_teams(table)) and top_teams(table).collect() == expected


def test_clustered_mart_when_a_build_fails_or_is_empty(spark, league):
    rows, name = league
    layout = Clustering("season", ("season", "season_rank"))
    save_mart(rows, name, clustering=layout)
    failing = rows.withColumn("season_rank", F.when(F.col("points") > 0, F.raise_error(F.lit("no"))).cast("int"))
    with pytest.raises(Exception, match="no"):
        save_mart(failing, name, clustering=layout)
    assert spark.table(name).count() == rows.count()
    schema = name.split(".")[0]
    assert [t.name for t in spark.catalog.listTables(schema)] == ["league"]
    save_mart(rows.limit(0), name, clustering=layout)
    assert spark.table(name).count() == 0 and spark.table(name).dtypes == rows.dtypes
