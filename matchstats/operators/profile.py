"""Profile of raw matches: totals, frequencies, blanks, malformed values, season coverage.

``summarise`` scans the raw rows once and leaves one small row per season and
result; every report is a roll-up of that summary, so a profile costs one scan and
asks for only the measures the report uses.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.seasons import parse_seasons, season_condition, start_year_text
from ..functions.text import is_present, strip_whitespace
from ..schemas import DATE_FORMAT, RAW_COLUMNS, RAW_INT_COLUMNS

PARSED_COLUMNS = ["MatchDate", *RAW_INT_COLUMNS]
#: Bytes of a text that are compared as one decimal.
CODE_BYTES = 14


def _key(name: str) -> Column:
    """Trimmed text, empty where nothing is present, so that blanks are counted as a key."""
    return F.coalesce(strip_whitespace(F.col(name)), F.lit(""))


def _present(name: str, kind: str) -> Column:
    """Number of values holding more than whitespace."""
    col = F.col(name)
    return F.count(F.when(is_present(col), 1) if kind == "string" else col)


def _parsed(name: str, kind: str) -> Column:
    """Number of values the typed scan reads as an integer; it takes no outer whitespace."""
    col = F.col(name)
    bare = (col >= "!") & (F.substring(col, -1, 1) >= "!")
    return F.count(F.when(bare, col.try_cast("int")) if kind == "string" else col)


def summarise(raw: DataFrame) -> DataFrame:
    """Per season and result: rows, first and last date, present and parsed values by column.

    Takes the all-text scan, where blanks and bad numbers still differ, as well as
    typed rows. Keys are grouped as written (``written``) and trimmed once per group, so
    a key written in several ways has several rows here; the roll-ups add them up.

    Dates compare as text. A minimum of text would make Spark sort all rows before it
    groups them; a date or a number does not. ISO dates order alike as dates and as text, so
    readable dates are compared as dates. Of any other text the first bytes are compared, as
    a number of the same order (``low_code``, ``high_code``); ``date_range`` and ``settled``
    make whole texts of them.

    Plain counts keep the generated code in small methods, which the JVM compiles; as
    conditional counts over shared blank tests the same work ran four times longer.
    """
    kinds = dict(raw.dtypes)
    text = F.col("MatchDate").cast("string")
    odd = F.when(F.col("day").isNull(), F.col("date_text"))
    dated = _dated(raw)
    grouped = dated.groupBy(
        F.col("Season").alias("written"), F.col("FullTimeResult").alias("result")
    ).agg(
        F.count("*").alias("matches"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.min(_code(odd)).alias("low_code"),
        F.max(_code(odd)).alias("high_code"),
        F.count_if(F.instr(odd, "\0") > 0).alias("odd_zeros"),
        *[_present(c, kinds[c]).alias(f"present_{c}") for c in RAW_COLUMNS],
        # Staging reads the date as it stands, so outer whitespace makes it unreadable there.
        F.count(F.when(F.col("date_text") == text, F.col("day"))).alias("parsed_MatchDate"),
        *[_parsed(c, kinds[c]).alias(f"parsed_{c}") for c in RAW_INT_COLUMNS],
    )
    return grouped.withColumns(
        {
            "season": _key("written"),
            "result": _key("result"),
            "min_date": F.col("first_day").cast("string"),
            "max_date": F.col("last_day").cast("string"),
        }
    ).drop("first_day", "last_day")


def _dated(raw: DataFrame) -> DataFrame:
    text = F.nullif(strip_whitespace(F.col("MatchDate").cast("string")), F.lit(""))
    return raw.withColumn("date_text", text).withColumn("day", F.try_to_date("date_text", DATE_FORMAT))


def _code(text: Column) -> Column:
    """The first CODE_BYTES bytes as a number; texts order alike, as far as these bytes go."""
    half = CODE_BYTES // 2
    part = lambda at: F.conv(
        F.rpad(F.hex(F.substring(text.cast("binary"), at, half)), 2 * half, "0"), 16, 10
    ).cast("decimal(20,0)")
    return (part(1) * F.lit(1 << (8 * half)).cast("decimal(17,0)") + part(half + 1)).cast("decimal(38,0)")


def _whole_text(raw: DataFrame, code: Decimal | None, pick: Callable, zeros: bool) -> str | None:
    """The text of a winning code. Only one that may go on behind it is looked up, among the
    few rows of that code."""
    if code is None:
        return None
    first = int(code).to_bytes(CODE_BYTES, "big")
    if not first[-1] and not zeros:
        return first.rstrip(b"\0").decode()
    tied = _dated(raw).where(F.col("day").isNull() & (_code(F.col("date_text")) == F.lit(code)))
    return tied.agg(pick("date_text")).first()[0]


def _outer(texts: Iterable[str | None], pick: Callable) -> str | None:
    return pick((t for t in texts if t is not None), key=str.encode, default=None)


def date_range(summary: DataFrame, raw: DataFrame) -> tuple[str | None, str | None]:
    """Least and greatest date text of the rows that ``summary`` sums up."""
    return _totals(summary, raw)[2:]


def _totals(summary: DataFrame, raw: DataFrame) -> tuple:
    row = summary.agg(
        F.coalesce(F.sum("matches"), F.lit(0)),
        F.count_distinct("season"),
        F.min("min_date"), F.max("max_date"), F.min("low_code"), F.max("high_code"),
        F.coalesce(F.sum("odd_zeros"), F.lit(0)) > 0,
    ).first()
    matches, seasons, first, last, low, high, zeros = row
    low, high = _whole_text(raw, low, F.min, zeros), _whole_text(raw, high, F.max, zeros)
    return matches, seasons, _outer((first, low), min), _outer((last, high), max)


def settled(summary: DataFrame, raw: DataFrame, path: str) -> DataFrame:
    """The summary written to ``path`` in one scan, with whole texts in place of codes.

    They are one more row, without a season, that holds nothing else.
    """
    spark = summary.sparkSession
    codes = ("low_code", "high_code", "odd_zeros")
    summary.write.mode("overwrite").parquet(path)
    kept = spark.read.schema(summary.schema).parquet(path)
    ends = spark.createDataFrame([date_range(kept, raw)], "min_date string, max_date string")
    row = kept.drop(*codes).limit(0).unionByName(ends, allowMissingColumns=True)
    row.coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(row.schema).parquet(path)


def _groups(summary: DataFrame) -> DataFrame:
    """The summary without the row of whole date texts."""
    return summary.where(F.col("season").isNotNull())


def profile_totals(summary: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """One row: rows, distinct seasons (blank is one), first and last date or null.

    With ``raw``, the rows that were summed up, in one scan of them. Without it the summary
    must be a settled one.
    """
    schema = "total_rows long, total_seasons long, min_date string, max_date string"
    if raw is not None:
        return summary.sparkSession.createDataFrame([_totals(summary, raw)], schema)
    if "low_code" in summary.columns:
        raise ValueError("date texts are not settled; give the raw rows, or settle the summary")
    return summary.agg(
        F.coalesce(F.sum("matches"), F.lit(0)).alias("total_rows"),
        F.count_distinct("season").alias("total_seasons"),
        F.min("min_date").alias("min_date"),
        F.max("max_date").alias("max_date"),
    )


def profile_frequency(summary: DataFrame, key: str) -> DataFrame:
    """Rows per ``season`` or per ``result``."""
    return _groups(summary).groupBy(key).agg(F.sum("matches").alias("matches")).orderBy(key)


def profile_rollup(summary: DataFrame) -> DataFrame:
    """Rows of each season, of each result and of all, in one pass over the summary.

    ``report`` names the set a row belongs to, ``key`` is its season or result.
    """
    sets = _groups(summary).groupingSets(
        [[F.col("season")], [F.col("result")], []], F.col("season"), F.col("result")
    )
    rolled = sets.agg(F.sum("matches").alias("matches"), F.grouping_id().alias("_set"))
    report = F.when(F.col("_set") == 1, "season").when(F.col("_set") == 2, "result").otherwise("total")
    # Without rows there is no total to sum up.
    return rolled.where("matches IS NOT NULL").select(
        report.alias("report"), F.coalesce("season", "result").alias("key"), "matches"
    )


def _per_column(
    summary: DataFrame, whole: str, part: str, columns: list[str], name: str
) -> DataFrame:
    """(column, whole - part), both summed; ``{}`` stands for the column's name."""
    totals = _groups(summary).agg(
        *[
            F.coalesce(F.sum(F.col(whole.format(c)) - F.col(part.format(c))), F.lit(0)).alias(c)
            for c in columns
        ]
    )
    return totals.unpivot([], columns, "column", name)


def profile_blanks(summary: DataFrame) -> DataFrame:
    """Blank values per raw column."""
    return _per_column(summary, "matches", "present_{}", RAW_COLUMNS, "blanks")


def profile_malformed(summary: DataFrame) -> DataFrame:
    """Values per date or number column that are present but unreadable."""
    return _per_column(summary, "present_{}", "parsed_{}", PARSED_COLUMNS, "malformed")


def season_coverage(summary: DataFrame, seasons: str | Iterable[str]) -> DataFrame:
    """Per configured entry: is it in the data, and with how many matches.

    Entries are labels or start years and match seasons as they are written, as in the
    season filter: a season with outer whitespace is not found, since it would not be
    staged. Entries join the matching seasons as rows of zero matches, so one small
    aggregation answers for found and missing entries alike.
    """
    entries = parse_seasons(seasons)
    season = F.col("written")
    names = F.array_distinct(F.array(season, start_year_text(season)))
    counted = _groups(summary).select(F.explode(names).alias("season"), "matches").where(
        F.col("season").isin(entries)
    )
    configured = summary.sparkSession.range(0, 1, 1, 1).select(
        F.explode(F.array(*[F.lit(e) for e in entries]).cast("array<string>")).alias("season"),
        F.lit(0).cast("long").alias("matches"),
    )
    return (
        configured.unionByName(counted)
        .groupBy("season")
        .agg(F.sum("matches").alias("matches"))
        .select("season", (F.col("matches") > 0).alias("found"), "matches")
        .orderBy("season")
    )


def covered_matches(summary: DataFrame, seasons: str | Iterable[str]) -> DataFrame:
    """One row: matches of all configured seasons, each counted once.

    The same rows pass as in the season filter.
    """
    configured = season_condition(seasons, F.col("written"))
    return _groups(summary).agg(
        F.coalesce(F.sum(F.when(configured, F.col("matches"))), F.lit(0)).alias("total_matches")
    )
