"""Typed match table, model views and mart tables."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import Files
from .layout import Clustering
from .versions import exchange, open_table, quoted, table_folder

#: Seconds after which a claim on a build is taken for that of a builder that is gone.
CLAIM_SECONDS = 24 * 3600


def create_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    where = f" LOCATION {quoted(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{where}")


def create_matches_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    """The typed table, if absent; text longer than declared is refused on insert.

    With a ``location`` the data stays in that folder whatever catalog the session
    has, and a catalog that does not know the table picks up its newest version there.
    """
    open_table(spark, table, location)


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def reload_matches(staged: DataFrame, table: str, balanced: bool = False) -> None:
    """Replace the whole content of the typed table with the staged matches.

    Columns are matched by name, and running it twice leaves the same table. Readers see
    the old content, whole, until one catalog entry is changed, and then the new; a reload
    that fails leaves the table as it was. Seasons that did not change are not written.

    ``balanced`` says that the rows come from files split by season, as
    ``read_staged`` gives them; they are then written by the tasks that read them,
    without a shuffle, and each file keeps the dates of the one it was read from.
    """
    exchange(staged, table, balanced)


def loader_frame(staged: DataFrame) -> DataFrame:
    """Upper-case names, date and load time as text, for a text-only external target.

    A missing value stays null.
    """
    as_text = ("match_date", "ingested_at")
    return staged.select(
        *[
            (F.col(c).cast("string") if c in as_text else F.col(c)).alias(c.upper())
            for c in staged.columns
        ]
    )


def verify_load(matches: DataFrame) -> DataFrame:
    """One row: rows, first and last date, distinct seasons."""
    return matches.agg(
        F.count("*").alias("rows_loaded"),
        F.min("match_date").alias("min_date"),
        F.max("match_date").alias("max_date"),
        F.count_distinct("season").alias("seasons"),
    )


def save_mart(
    frame: DataFrame, table: str, location: str | None = None, clustering: Clustering | None = None
) -> None:
    """Materialise a model as a table, in the order of the frame or clustered.

    Each build is written to a folder of its own, and the table is pointed at it once
    it is complete. So a failing build leaves the former rows readable, and readers of
    the former build can finish: its folder goes with the build after the next.

    Builders of one table may meet: each claims its folder before it writes, and nobody
    removes a folder under a claim that is younger than CLAIM_SECONDS. The build that ends
    last is the one that readers see.
    """
    spark = frame.sparkSession
    files = Files(spark)
    base = table_folder(spark, table, location)
    name = f"build-{uuid.uuid4().hex}"
    build, claim = f"{base}/{name}", f"{base}/_claims/{name}"
    switch = partial(_switch, clustering=clustering) if clustering else _switch
    files.create(claim)
    try:
        _write_build(frame, build, clustering, f"{table}__{name.replace('-', '_')}")
        former = switch(frame, table, build)
    except BaseException:
        files.remove(build)
        files.remove(claim)
        raise
    files.remove(claim)
    _remove_builds(spark, base, {build, former, _location(spark, table)})


def _write_build(frame: DataFrame, build: str, clustering: Clustering | None, name: str) -> None:
    """The rows as files; buckets are written through a table of a passing name."""
    if clustering is None:
        frame.write.parquet(build)
        return
    first, *rest = clustering.order
    placed = clustering.place(frame).write.bucketBy(clustering.buckets, clustering.by)
    try:
        placed.sortBy(first, *rest).saveAsTable(name, format="parquet", path=build)
    finally:
        # Its data lies at a path of ours and stays.
        frame.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def _clustering_of(spark: SparkSession, table: str) -> Clustering | None:
    told = ("Num Buckets", "Bucket Columns", "Sort Columns")
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name").isin(*told)).collect()
    found = {r["col_name"]: r["data_type"].strip("[]").replace("`", "") for r in rows}
    if not found:
        return None
    return Clustering(
        found["Bucket Columns"], tuple(found["Sort Columns"].split(", ")), int(found["Num Buckets"])
    )


def _create_mart(frame: DataFrame, table: str, build: str, clustering: Clustering | None) -> None:
    if clustering is None:
        frame.sparkSession.catalog.createTable(table, path=build, source="parquet")
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)
    frame.sparkSession.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet {clustering.clause} LOCATION {quoted(build)}"
    )


def _switch(
    frame: DataFrame, table: str, build: str, clustering: Clustering | None = None
) -> str | None:
    """Points the table at a complete build; returns the folder it had before."""
    spark = frame.sparkSession
    if not spark.catalog.tableExists(table):
        _create_mart(frame, table, build, clustering)
        return None
    former = _location(spark, table)
    if spark.table(table).dtypes == frame.dtypes and _clustering_of(spark, table) == clustering:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {quoted(build)}")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"DROP TABLE {table}")
        _create_mart(frame, table, build, clustering)
    return former


def _remove_builds(spark: SparkSession, base: str, keep: set[str | None]) -> None:
    """Removes builds that no table, reader or builder has a use for, and claims left behind."""
    files = Files(spark)
    names = {folder.rstrip("/").rpartition("/")[2] for folder in keep if folder}
    claims = files.ages(f"{base}/_claims")
    claimed = {name for name, age in claims.items() if age < CLAIM_SECONDS}
    for name in files.ages(base):
        if name.startswith("build-") and name not in names | claimed:
            files.remove(f"{base}/{name}")
    for name in claims.keys() - claimed:
        files.remove(f"{base}/_claims/{name}")
