"""The typed match table as a series of versions, exchanged by one catalog entry.

Readers know the table by the name of a view, which selects from one version: a table of
its own, whose partitions are season folders. A reload builds the next version beside the
current one and then points the view at it, a single change in the catalog; until then
readers see the old content, whole, and after it the new. Whatever fails before leaves the
old content as it was. Nothing is set on the session, so other writes may run meanwhile,
other reloads too: the last to finish is what readers see.

Each version has a summary, one row a season: its folder, rows, a checksum over all
columns, first and last date and season labels. A season whose rows and checksum are those
of the version before is carried over by its folder's name and not written again. What was
written is held against the summary by the row counts in the files' footers before readers
see it, so a load can be verified from the summary, without reading a row.

Under the table's folder lie ``load-<version>`` (written seasons) and ``_versions``: a
summary for each version, and a mark once readers have seen it. A session whose catalog
does not know the table finds the newest marked version there. Versions that are neither
the current nor the one before go when they are older than the time of grace, and with
them the folders that no remaining version names; so readers can finish, and a load that is
still being written, as its folder is young, is left alone.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..files import Files
from ..schemas import WAREHOUSE_COLUMNS
from .layout import place_by_month, sort_matches

#: Seconds that replaced versions and their folders are kept for their readers.
GRACE = 24 * 3600
FOLDER = "matchstats.folder"
SUMMARY_SCHEMA = (
    "season_start_year int, folder string, rows long, checksum decimal(38,0), "
    "first_date date, last_date date, seasons array<string>"
)
_COLUMNS = [name for name, _ in WAREHOUSE_COLUMNS]


class LoadError(RuntimeError):
    """What a load wrote is not what was staged."""


def quoted(text: str) -> str:
    """The text as a SQL literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def table_folder(spark: SparkSession, table: str, location: str | None = None) -> str:
    if location:
        return location.rstrip("/")
    schema, _, name = table.rpartition(".")
    schema = schema or spark.catalog.currentDatabase()
    return f"{spark.catalog.getDatabase(schema).locationUri.rstrip('/')}/{name}"


def current_version(spark: SparkSession, table: str) -> tuple[str, str] | tuple[None, None]:
    """The version that readers of the table see, and its folder; none for a table of another kind."""
    if not spark.catalog.tableExists(table):
        return None, None
    held = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if FOLDER not in held:
        return None, None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'View Text'").first()
    return described["data_type"].rpartition("__")[2].strip("` "), held[FOLDER]


def _new_name() -> str:
    """Versions sort by the time of their making."""
    return f"{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:8]}"


def _summary_path(folder: str, version: str) -> str:
    return f"{folder}/_versions/{version}"


def _mark(folder: str, version: str) -> str:
    return f"{folder}/_versions/{version}.seen"


def read_summary(spark: SparkSession, folder: str, version: str) -> DataFrame:
    """The seasons of a version; one that began empty has no summary written."""
    path = _summary_path(folder, version)
    if not Files(spark).exists(path):
        return spark.createDataFrame([], SUMMARY_SCHEMA)
    return spark.read.schema(SUMMARY_SCHEMA).parquet(path)


def summarise_seasons(rows: DataFrame) -> DataFrame:
    """One row a season; rows in any order have the same checksum."""
    # A hash passes over nulls, so it is told where they are.
    nulls = F.array(*[F.col(c).isNull() for c in _COLUMNS])
    checksum = F.sum(F.xxhash64(*_COLUMNS, nulls).cast("decimal(20,0)")).cast("decimal(38,0)")
    return rows.groupBy("season_start_year").agg(
        F.count("*").alias("rows"),
        checksum.alias("checksum"),
        F.min("match_date").alias("first_date"),
        F.max("match_date").alias("last_date"),
        F.array_sort(F.collect_set("season")).alias("seasons"),
    )


def _create_version(spark: SparkSession, name: str, location: str) -> None:
    columns = ", ".join(f"{column} {kind}" for column, kind in WAREHOUSE_COLUMNS)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"PARTITIONED BY (season_start_year) LOCATION {quoted(location)}"
    )


def _carry(spark: SparkSession, name: str, seasons: list[Row]) -> None:
    """Seasons that lie in other folders become partitions, in one statement."""
    if not seasons:
        return
    parts = " ".join(
        f"PARTITION (season_start_year = {'null' if s['season_start_year'] is None else s['season_start_year']}) "
        f"LOCATION {quoted(s['folder'])}"
        for s in seasons
    )
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")


def _in(years: list[int | None]) -> Column:
    year = F.col("season_start_year")
    named = year.isin([y for y in years if y is not None])
    return F.coalesce(named, F.lit(False)) | year.isNull() if None in years else named


def _write(rows: DataFrame, name: str, years: list[int | None], balanced: bool) -> None:
    """The seasons' rows; text longer than declared is refused by the insert."""
    if not years:
        return
    chosen = rows.where(_in(years))
    placed = sort_matches(chosen if balanced else place_by_month(chosen))
    rows.sparkSession.sql(f"INSERT INTO {name} BY NAME SELECT * FROM {{placed}}", placed=placed)


def _verify(spark: SparkSession, name: str, seasons: list[Row]) -> None:
    """Row counts of the files' footers against the summary, season by season."""
    counted = spark.table(name).groupBy("season_start_year").count().collect()
    held = {r["season_start_year"]: r["count"] for r in counted}
    expected = {s["season_start_year"]: s["rows"] for s in seasons}
    if held != expected:
        wrong = sorted(k for k in held.keys() | expected if held.get(k) != expected.get(k) and k is not None)
        raise LoadError(f"{name} does not hold the staged rows of seasons {wrong or [None]}")


def _record(spark: SparkSession, folder: str, version: str, seasons: list[Row]) -> None:
    frame = spark.createDataFrame([tuple(s) for s in seasons], SUMMARY_SCHEMA)
    frame.coalesce(1).write.parquet(_summary_path(folder, version))


def _point(spark: SparkSession, table: str, folder: str, version: str) -> None:
    """The one change that readers see."""
    selection = f"SELECT {', '.join(_COLUMNS)} FROM {_version_table(table, version)}"
    if spark.catalog.tableExists(table):
        # Replacing a view would drop and make it anew; this alters its entry in place.
        spark.sql(f"ALTER VIEW {table} AS {selection}")
    else:
        spark.sql(f"CREATE VIEW {table} TBLPROPERTIES ({quoted(FOLDER)} = {quoted(folder)}) AS {selection}")


def _version_table(table: str, version: str) -> str:
    return f"{table}__{version}"


def _committed(spark: SparkSession, folder: str) -> list[str]:
    names = Files(spark).ages(f"{folder}/_versions")
    return sorted(n.removesuffix(".seen") for n in names if n.endswith(".seen"))


def open_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    """The table, empty if it is new; a catalog that does not know it gets its newest version."""
    if current_version(spark, table)[0]:
        return
    folder = table_folder(spark, table, location)
    found = _committed(spark, folder)
    version = found[-1] if found else _new_name()
    name = _version_table(table, version)
    if spark.catalog.tableExists(table):
        # A plain table of this name, as other writers make it, keeps its rows under another.
        spark.sql(f"ALTER TABLE {table} RENAME TO {table}__plain_{version}")
    if not spark.catalog.tableExists(name):
        _create_version(spark, name, f"{folder}/load-{version}")
    if found:
        _carry(spark, name, read_summary(spark, folder, version).collect())
    _point(spark, table, folder, version)
    Files(spark).create(_mark(folder, version))


def _folder_of(location: str, year: int | None) -> str:
    name = "__HIVE_DEFAULT_PARTITION__" if year is None else year
    return f"{location}/season_start_year={name}"


def exchange(staged: DataFrame, table: str, balanced: bool = False, grace: float = GRACE) -> None:
    """Make the staged matches the whole content of an open table, in one step for its readers.

    Fetches one summary row a season. ``balanced`` rows are written by the tasks that read
    them; others are placed by season and month first.
    """
    spark = staged.sparkSession
    former, folder = current_version(spark, table)
    if former is None:
        raise ValueError(f"{table} has no versions")
    rows = staged.withColumn("ingested_at", F.col("ingested_at").cast("string")).select(*_COLUMNS)
    version = _new_name()
    name, location = _version_table(table, version), f"{folder}/load-{version}"
    known = {r["season_start_year"]: r for r in read_summary(spark, folder, former).collect()}

    def same(season: Row) -> bool:
        held = known.get(season["season_start_year"])
        return held is not None and (held["rows"], held["checksum"]) == (season["rows"], season["checksum"])

    found = summarise_seasons(rows).collect()
    summary = [
        Row(
            season_start_year=s["season_start_year"],
            folder=known[s["season_start_year"]]["folder"] if same(s) else _folder_of(location, s["season_start_year"]),
            rows=s["rows"], checksum=s["checksum"], first_date=s["first_date"],
            last_date=s["last_date"], seasons=s["seasons"],
        )
        for s in found
    ]
    try:
        _create_version(spark, name, location)
        _write(rows, name, [s["season_start_year"] for s in found if not same(s)], balanced)
        _carry(spark, name, [s for s in summary if not s["folder"].startswith(f"{location}/")])
        _verify(spark, name, summary)
        _record(spark, folder, version, summary)
        _point(spark, table, folder, version)
    except BaseException:
        if current_version(spark, table)[0] != version:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            Files(spark).remove(location)
            Files(spark).remove(_summary_path(folder, version))
        raise
    Files(spark).create(_mark(folder, version))
    clean_up(spark, table, folder, {version, former}, grace)


def clean_up(spark: SparkSession, table: str, folder: str, keep: set[str | None], grace: float = GRACE) -> None:
    """Removes versions past their time of grace, and load folders that no other one names."""
    files = Files(spark)
    versions: dict[str, float] = {}
    for name, age in files.ages(f"{folder}/_versions").items():
        version = name.removesuffix(".seen")
        versions[version] = min(age, versions.get(version, age))
    going = {v for v, age in versions.items() if v not in keep and age >= grace}
    loads = {n for n, age in files.ages(folder).items() if n.startswith("load-") and age >= grace}
    if not going and not loads:
        return
    named = set()
    for version in versions.keys() - going:
        places = read_summary(spark, folder, version).select("folder").collect()
        named |= {r["folder"].rpartition("/")[0].rpartition("/")[2] for r in places} | {f"load-{version}"}
    for version in going:
        spark.sql(f"DROP TABLE IF EXISTS {_version_table(table, version)}")
        files.remove(_mark(folder, version))
        files.remove(_summary_path(folder, version))
    for load in loads - named:
        files.remove(f"{folder}/{load}")


def verify_version(spark: SparkSession, table: str) -> DataFrame:
    """One row on what the table holds: rows, first and last date, distinct seasons.

    Read from the summary of the version that readers see, whose row counts were held
    against the files before; no row of the table is read.
    """
    version, folder = current_version(spark, table)
    if version is None:
        raise ValueError(f"{table} has no versions")
    summary = read_summary(spark, folder, version)
    labels = F.array_distinct(F.flatten(F.collect_list("seasons")))
    return summary.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_loaded"),
        F.min("first_date").alias("min_date"),
        F.max("last_date").alias("max_date"),
        F.size(labels).cast("long").alias("seasons"),
    )
