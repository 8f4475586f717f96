"""Layer jobs that follow changes: what new messages touch is computed again, and nothing else is read or written.

New messages are first set down as a change set below the lake. Of silver, only dates are read that may hold an older
copy of one of its readings: a table of event times per date tells which. Dates where a reading is added or loses to
a newer copy are replaced, in silver, gold and the published copy; checks are counted again for these dates and added to
the counters of all others. The change set goes last, so a run that ends early is taken up by the next one, and every
step gives the same when it is repeated.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from .. import schemas
from ..operators import gold as G
from ..operators import quality as Q
from ..operators import silver as S
from ..operators.dedup import LATEST_FIRST
from ..session import cut
from ..sinks.files import check_apart, write_partitioned
from ..sinks.swap import Folders, recover, replace
from .jobs import MESSAGE_KEYS, LayerFailed, not_among

Date = tuple
ZONES = "year int, month int, day int, low timestamp, high timestamp, untimed bigint"
OFFSETS = "year int, month int, day int, data_source string, kafka_partition int, low bigint, high bigint"
HELPERS = ("offsets", "zones", "counters")  # small tables, some rows per date


@dataclass(frozen=True)
class Lake:
    """Where the tables of a lake are.

    ``offsets`` has the topic offsets of each bronze date, ``zones`` the event times of each silver date, ``counters`` the
    checks of each gold date, ``changes`` the change sets at work.
    """

    root: str

    def __getattr__(self, name: str) -> str:
        if name not in ("bronze", "silver", "gold", "changes", *HELPERS):
            raise AttributeError(name)
        return f"{self.root.rstrip('/')}/{'_' if name in ('changes', *HELPERS) else ''}{name}"


def on_dates(df: DataFrame, dates: Iterable[Date]) -> DataFrame:
    """Rows of some dates (year, month, day; null is a date of its own); other partitions are not read."""
    year: dict = {}
    for y, m, d in dates:
        year.setdefault(y, {}).setdefault(m, set()).add(d)

    def is_in(column: str, values: Iterable) -> Column:
        known = [v for v in values if v is not None]
        found = F.col(column).isin(known) if known else F.lit(False)
        return found | F.col(column).isNull() if None in values else found

    keep = F.lit(False)
    for y, months in sorted(year.items(), key=repr):
        for m, days in sorted(months.items(), key=repr):
            keep = keep | (is_in("year", [y]) & is_in("month", [m]) & is_in("day", sorted(days, key=repr)))
    return df.where(keep)


def dates_of(df: DataFrame) -> set[Date]:
    """The dates that occur; as many as the calendar has, at most."""
    return {tuple(r) for r in df.select(*C.DATE_PARTS).distinct().collect()}


def offset_zones(bronze: DataFrame) -> DataFrame:
    """First and last offset of each date, by source and topic partition."""
    return bronze.groupBy(*C.DATE_PARTS, "data_source", "kafka_partition").agg(F.min("kafka_offset").alias("low"), F.max("kafka_offset").alias("high"))


def unknown_messages(rows: DataFrame, lake: Lake) -> DataFrame:
    """Bronze rows of messages that the lake has not got; only dates with offsets around theirs are read."""
    spark = rows.sparkSession
    if not Folders(spark, lake.root).exists(lake.bronze):
        return rows
    span = rows.groupBy("data_source", "kafka_partition").agg(F.min("kafka_offset").alias("from"), F.max("kafka_offset").alias("to"))
    zones = spark.read.schema(OFFSETS).parquet(lake.offsets).join(span, ["data_source", "kafka_partition"])
    dates = dates_of(zones.where((F.col("low") <= F.col("to")) & (F.col("high") >= F.col("from"))))
    return not_among(rows, on_dates(spark.read.schema(schemas.BRONZE).parquet(lake.bronze), dates), MESSAGE_KEYS)


def event_zones(silver: DataFrame) -> DataFrame:
    """First and last event time of each date, and its readings without one."""
    times = [F.min("timestamp").alias("low"), F.max("timestamp").alias("high"), F.count_if(F.col("timestamp").isNull()).alias("untimed")]
    return silver.groupBy(*C.DATE_PARTS).agg(*times)


def dates_to_search(zones: DataFrame, rows: DataFrame) -> set[Date]:
    """Dates whose event times reach into a day on which one of ``rows`` was taken: no other can hold an older copy."""
    day = F.date_trunc("day", "timestamp")
    days = rows.select(day.alias("begin")).distinct()
    end = F.col("begin") + F.expr("INTERVAL 1 DAY")
    meets = (F.col("begin").isNull() & (F.col("untimed") > 0)) | ((F.col("low") < end) & (F.col("high") >= F.col("begin")))
    return dates_of(zones.join(days, meets, "left_semi"))


def contested(rows: DataFrame, old: DataFrame) -> DataFrame:
    """Copies in ``old`` of readings that new silver ``rows`` bring again: their key and date, and whether the new one is ``__newer``.

    Null keys are keys of their own, as in the dedup. Of copies that tie, the old one stays, so that rows that silver has
    already change nothing. Only keys, order and dates go through the join.
    """
    when = F.struct(*LATEST_FIRST)
    copies = _keyed(old).select("__hash", "__key", *C.DEDUP_KEYS, *C.DATE_PARTS, when.alias("__old"))
    fresh = _keyed(rows).select("__hash", "__key", when.alias("__when"))
    found = copies.join(fresh, ["__hash", "__key"])
    return found.select(*C.DEDUP_KEYS, *C.DATE_PARTS, (F.col("__when") > F.col("__old")).alias("__newer"))


def silver_changes(rows: DataFrame, old: DataFrame, keep: Callable[[DataFrame], DataFrame] = cut) -> tuple[DataFrame, set[Date]]:
    """What new silver ``rows`` change in ``old``, the part of silver that may hold copies of them.

    Gives the rows that are now the latest of their key, and the dates that change: theirs, and those of the copies that
    they replace. ``keep`` sets down the contested copies, so that ``old`` is searched once.
    """
    found = keep(contested(rows, old))
    stale = found.where("not __newer")
    added, lost = without_keys(rows, stale), without_keys(found, stale)
    return added, dates_of(added) | dates_of(lost)


def _keyed(df: DataFrame) -> DataFrame:
    """With the key of the dedup, and its hash, by which joins sort much faster than by the key."""
    return df.withColumns({"__hash": F.xxhash64(*C.DEDUP_KEYS), "__key": F.struct(*C.DEDUP_KEYS)})


def without_keys(old: DataFrame, added: DataFrame) -> DataFrame:
    return _keyed(old).join(_keyed(added).select("__hash", "__key"), ["__hash", "__key"], "left_anti").select(*old.columns)


def _kept(df: DataFrame, path: str) -> DataFrame:
    """``df`` from files, whose size and columns later plans know."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def upsert_silver(spark: SparkSession, rows: DataFrame, lake: Lake, change: str) -> set[Date]:
    """Bring silver up to date with bronze ``rows`` and give the dates that changed.

    The dates are set down in the folder of the change set before silver changes, since a repeated run no longer sees
    which copies lost.
    """
    folders, note = Folders(spark, lake.root), f"{change}/dates"
    earlier = {tuple(line.split(",")) for line in folders.read(note).split()} if folders.exists(note) else set()
    changed = {tuple(None if v == "" else int(v) for v in d) for d in earlier}
    fresh = _kept(S.silver(rows), f"{change}/fresh")
    if not folders.exists(lake.silver):
        old = spark.createDataFrame([], schemas.SILVER)
    else:
        whole = spark.read.schema(schemas.SILVER).parquet(lake.silver)
        old = on_dates(whole, dates_to_search(spark.read.schema(ZONES).parquet(lake.zones), fresh))
    added, dates = silver_changes(fresh, old, lambda found: _kept(found, f"{change}/contested"))
    changed |= dates
    folders.write(f"{note}.new", "\n".join(",".join("" if v is None else str(v) for v in d) for d in sorted(changed, key=repr)))
    folders.delete(note)
    folders.move(f"{note}.new", note)
    if dates:
        kept = without_keys(on_dates(whole, dates), added) if folders.exists(lake.silver) else old
        replace(kept.unionByName(added).select(*schemas.SILVER.names), lake.silver, partitions=True, dates=dates)
    return changed


def refresh(spark: SparkSession, parts: DataFrame, path: str, schema: T.StructType | str, dates: set[Date]) -> None:
    """Replace the rows of some dates in a small table with a few rows per date."""
    folders = Folders(spark, path)
    recover(spark, path)
    old = spark.read.schema(schema).parquet(path) if folders.exists(path) else spark.createDataFrame([], schema)
    changed = spark.createDataFrame(list(dates), "year int, month int, day int")
    same = F.lit(True)
    for c in C.DATE_PARTS:
        same = same & old[c].eqNullSafe(changed[c])
    replace(old.join(changed, same, "left_anti").unionByName(parts.select(*old.columns)), path, cols=())


def run_changes(
    spark: SparkSession,
    messages: DataFrame,
    root: str,
    published: str,
    source: str = C.WEATHER_SOURCE,
    processed_at: Column | None = None,
    gold_at: Column | None = None,
    suite: Q.Suite = Q.GOLD_SUITE,
    pass_percent: float = C.GOLD_PASS_PERCENT,
) -> DataFrame:
    """Like ``run_all``, at the cost of what changes: messages that bronze has not got yet go through all layers, and only
    the dates that they touch are read and replaced. Gives the report on the whole of gold.

    Runs over one lake must not overlap in time. A lake that ``run_all`` has made is taken over, by one pass over its
    tables; from then on all runs must go this way, since it relies on what it notes about them. A failed report stops before publication; the changes wait, and the next run publishes them if it succeeds.
    """
    lake = Lake(root)
    check_apart(root, published)
    folders = Folders(spark, root)
    for path in (lake.silver, lake.gold, *(getattr(lake, h) for h in HELPERS), published):
        recover(spark, path)
    take_over(spark, lake, suite)
    waiting = [f"{lake.changes}/{n}" for n in sorted(folders.names(lake.changes)) if folders.exists(f"{lake.changes}/{n}/rows/_SUCCESS")]
    dates: set[Date] = set()
    for change in waiting:
        dates |= _layer(spark, change, lake, gold_at, suite)
    change = f"{lake.changes}/{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    fresh = set_down(S.bronze(messages, source, processed_at=processed_at), lake, change)
    dates |= _layer(spark, change, lake, gold_at, suite, fresh)
    if not folders.exists(lake.silver):
        folders.delete(change)
        raise LayerFailed("silver: no data")
    gold = read_gold(spark, lake)
    results = Q.merged_suite(spark.read.parquet(lake.counters), suite, gold)
    report = cut(Q.summarize(results, pass_percent))
    if not report.select("success").first()[0]:
        raise LayerFailed("gold: the checks failed, nothing was published")
    if dates:
        whole = not folders.exists(published)
        rows = gold if whole else on_dates(gold, dates)
        replace(rows, published, partitions=not whole, dates=() if whole else dates, compression="snappy")
    for done in [*waiting, change]:
        folders.delete(done)
    return report


def take_over(spark: SparkSession, lake: Lake, suite: Q.Suite | None = None) -> None:
    """Note offsets, event times and checks of tables that have none yet."""
    folders = Folders(spark, lake.root)
    made = {"offsets": (lake.bronze, offset_zones), "zones": (lake.silver, event_zones), "counters": (lake.gold, lambda gold: Q.suite_counters(gold, suite))}
    for helper, (table, count) in made.items():
        path = getattr(lake, helper)
        if folders.exists(table) and not folders.exists(path) and (suite or helper != "counters"):
            replace(count(spark.read.parquet(table)), path, cols=())


def set_down(bronze: DataFrame, lake: Lake, change: str) -> bool:
    """Write the bronze rows that the lake has not got yet as a change set; one that is there whole stays as it is.

    Whether it was written now, so that none of its rows can be in the lake.
    """
    folders = Folders(bronze.sparkSession, lake.root)
    if fresh := not folders.exists(f"{change}/rows/_SUCCESS"):
        unknown_messages(bronze, lake).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{change}/rows")
    return fresh


def read_gold(spark: SparkSession, lake: Lake) -> DataFrame:
    """The gold table by its known schema: to infer it, a file of any date would be opened."""
    schema = G.weather_metrics(spark.createDataFrame([], schemas.SILVER)).schema
    return spark.read.schema(schema).parquet(lake.gold)


def change_silver(spark: SparkSession, change: str, lake: Lake, fresh: bool = False) -> set[Date]:
    """One change set through bronze, silver and the zones; the dates that changed.

    Of a set that an earlier run may have begun with, bronze takes what it has not got; of a ``fresh`` one it takes all.
    """
    rows = spark.read.schema(schemas.BRONZE).parquet(f"{change}/rows")
    if rows.isEmpty():
        return set()
    # The offsets go first: a date too many is searched, one too few would let messages in twice.
    known = spark.read.schema(OFFSETS).parquet(lake.offsets) if Folders(spark, lake.root).exists(lake.offsets) else spark.createDataFrame([], OFFSETS)
    merged = known.unionByName(offset_zones(rows)).groupBy(*C.DATE_PARTS, "data_source", "kafka_partition").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    replace(merged, lake.offsets, cols=())
    write_partitioned(rows if fresh else unknown_messages(rows, lake), lake.bronze, replace="nothing")
    dates = upsert_silver(spark, rows, lake, change)
    if dates:
        refresh(spark, event_zones(on_dates(spark.read.schema(schemas.SILVER).parquet(lake.silver), dates)), lake.zones, ZONES, dates)
    return dates


def _layer(spark: SparkSession, change: str, lake: Lake, gold_at: Column | None, suite: Q.Suite, fresh: bool = False) -> set[Date]:
    """One change set through bronze, silver, gold and the counters; the dates that changed."""
    dates = change_silver(spark, change, lake, fresh)
    if not dates:
        return dates
    silver = on_dates(spark.read.schema(schemas.SILVER).parquet(lake.silver), dates)
    replace(G.weather_metrics(silver, gold_at), lake.gold, partitions=True, dates=dates, compression="snappy")
    gold = read_gold(spark, lake)
    counted = Q.suite_counters(on_dates(gold, dates), suite)
    refresh(spark, counted, lake.counters, counted.schema, dates)
    return dates

