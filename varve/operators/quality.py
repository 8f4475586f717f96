"""Data-quality suites: all checks of a suite run in one aggregate over the data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from .. import schemas

RESULT = T.StructType(
    [
        T.StructField("suite", T.StringType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("expectation", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("detail", T.StringType()),
        T.StructField("records", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Check:
    """One expectation. ``low`` and ``high`` are inclusive; ``mostly`` is the least share of known values in range."""

    kind: str
    column: str | None = None
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    mostly: float | None = None
    null_ok: bool = True

    @property
    def name(self) -> str:
        return _NAMES[self.kind]


@dataclass(frozen=True)
class Suite:
    name: str
    checks: tuple[Check, ...]
    # Checks on columns the data lack: left out, or reported as failed.
    skip_missing: bool = False


# Public names of the expectations.
_NAMES = {
    "columns": "expect_table_columns_to_match_ordered_list",
    "rows": "expect_table_row_count_to_be_between",
    "not_null": "expect_column_values_to_not_be_null",
    "in_set": "expect_column_values_to_be_in_set",
    "between": "expect_column_values_to_be_between",
    "greater": "expect_column_values_to_be_greater_than",
}


def columns_match(names: Sequence[str]) -> Check:
    return Check("columns", values=tuple(names))


def row_count(low: int = C.LEAST_ROWS, high: int | None = None) -> Check:
    """At least ``low`` rows, and at most ``high`` where that is given."""
    return Check("rows", low=low, high=high)


def not_null(column: str) -> Check:
    return Check("not_null", column)


def in_set(column: str, values: Sequence, null_ok: bool = True) -> Check:
    return Check("in_set", column, values=tuple(values), null_ok=null_ok)


accepted_values = in_set


def between(column: str, low: float | None, high: float | None, mostly: float | None = None) -> Check:
    """Known values in a range; a bound that is None is open."""
    return Check("between", column, low=low, high=high, mostly=mostly)


def greater_than(column: str, low: float) -> Check:
    return Check("greater", column, low=low)


GOLD_SUITE = Suite(
    "gold",
    (
        row_count(),
        *[not_null(c) for c in C.DAILY_KEYS],
        in_set("data_source", C.GOLD_SOURCES, null_ok=False),
        between("year", *C.YEAR_BOUNDS),
        between("month", *C.MONTH_BOUNDS),
        between("day", *C.DAY_BOUNDS),
        between("avg_temperature", *C.AVG_TEMPERATURE_BOUNDS, mostly=C.MOSTLY),
        between("record_count", C.LEAST_RECORDS, None),
    ),
)

SILVER_SUITE = Suite(
    "silver",
    (
        columns_match(schemas.SILVER.names),
        row_count(),
        *[not_null(c) for c in schemas.SILVER.names],
        in_set("data_source", C.SILVER_SOURCES),
        between("year", *C.YEAR_BOUNDS),
        between("month", *C.MONTH_BOUNDS),
        between("day", *C.DAY_BOUNDS),
        between("quality_score", 0.0, 1.0),
        in_set("is_valid", (True, False)),
        in_set("weather_category", C.CATEGORIES),
        between("data_freshness_hours", *C.FRESHNESS_HOUR_BOUNDS),
    ),
    skip_missing=True,
)

MARKET_SUITE = Suite(
    "market",
    (
        not_null("close"),
        between("daily_return", -C.RETURN_LIMIT, C.RETURN_LIMIT),
        between("volatility", 0.0, C.VOLATILITY_LIMIT),
        greater_than("close", 0),
    ),
)

INDICATOR_SUITE = Suite(
    "indicators", (between("rsi", 0, 100), between("daily_return", -C.RETURN_LIMIT, C.RETURN_LIMIT))
)

BRONZE_SUITE = Suite(
    "bronze",
    (
        *[not_null(c) for c in ("temperature", "city", "processing_timestamp", "data_source")],
        accepted_values("data_source", C.SILVER_SOURCES),
    ),
)


def missing(df: DataFrame, column: str) -> Column:
    """True for null, and for not-a-number in a column of floating numbers."""
    c = F.col(f"`{column}`")
    return c.isNull() | F.isnan(c) if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)) else c.isNull()


def _number(df: DataFrame, column: str) -> Column:
    """The column as a number; not-a-number counts as missing."""
    c = F.col(f"`{column}`")
    number = c if isinstance(df.schema[column].dataType, T.NumericType) else c.try_cast("double")
    if isinstance(df.schema[column].dataType, (T.IntegralType, T.DecimalType)):
        return number
    return F.when(~F.isnan(number), number)


def _unknown(df: DataFrame, check: Check) -> Column:
    """True where the value is not in the check's set. Other types than text and boolean are compared as text."""
    column, values = F.col(f"`{check.column}`"), list(check.values)
    if not isinstance(df.schema[check.column].dataType, T.BooleanType):
        column, values = column.cast("string"), [str(v).lower() if isinstance(v, bool) else str(v) for v in values]
    return F.coalesce(~column.isin(values), F.lit(not check.null_ok))


def _text(values: Column, *more: Column | str) -> Column:
    return F.concat(*[v if isinstance(v, Column) else F.lit(v) for v in (values, *more)])


def _show(bound: float | None) -> str:
    if bound is None:
        return "any"
    return f"{bound:g}" if abs(bound) < 1e6 else str(int(bound))


def _measure(df: DataFrame, check: Check, i: int) -> tuple[list[Column], Column, Column]:
    """Aggregates a check needs, then its success and detail over their names."""
    bad, seen = f"bad{i}", f"seen{i}"
    count = F.col(bad).cast("string")
    if check.kind == "rows":
        rows = F.col("records")
        fits = rows >= int(check.low)
        fits = fits if check.high is None else fits & (rows <= int(check.high))
        return [], fits, _text(rows.cast("string"), " rows")
    if check.kind == "columns":
        same = list(df.columns) == list(check.values)
        return [], F.lit(same), F.lit("columns match" if same else "columns: " + ", ".join(df.columns))
    column = F.col(f"`{check.column}`")
    if check.kind == "not_null":
        return [F.count_if(missing(df, check.column)).alias(bad)], F.col(bad) == 0, _text(count, " nulls")
    if check.kind == "in_set":
        unknown = _unknown(df, check)
        return [F.count_if(unknown).alias(bad)], F.col(bad) == 0, _text(count, " unexpected")
    number = _number(df, check.column)
    if check.kind == "greater":
        return [F.count_if(number <= check.low).alias(bad)], F.col(bad) == 0, _text(count, f" not above {_show(check.low)}")
    low = F.lit(False) if check.low is None else number < check.low
    high = F.lit(False) if check.high is None else number > check.high
    outside = F.count_if(low | high).alias(bad)
    if check.mostly is None:
        return [outside], F.col(bad) == 0, _text(count, f" outside {_show(check.low)} to {_show(check.high)}")
    good_share = F.try_divide(F.col(seen) - F.col(bad), F.col(seen))
    return (
        [outside, F.count(number).alias(seen)],
        F.coalesce(good_share >= check.mostly, F.lit(False)),
        F.when(F.col(seen) == 0, F.lit("no values")).otherwise(_text(count, "/", F.col(seen).cast("string"), " outliers")),
    )


def _surely_resolves(df: DataFrame, check: Check) -> bool:
    numeric = isinstance(df.schema[check.column].dataType, T.NumericType)
    return check.kind == "not_null" or (check.kind in ("between", "greater") and numeric)


def _planned(df: DataFrame, suite: Suite) -> tuple[list[Column], list[Column]]:
    """The aggregates that a suite needs, all of them counts, and one result row per check over their names."""
    aggregates: list[Column] = [F.count(F.lit(1)).alias("records")]
    rows: list[Column] = []
    like = df.sparkSession.createDataFrame([], df.schema)
    n = 0
    for check in suite.checks:
        missing = check.column is not None and check.column not in df.columns
        if missing and suite.skip_missing:
            continue
        n += 1
        if missing:
            needed, success, detail = [], F.lit(False), F.lit(f"column {check.column} not found")
        else:
            try:
                needed, success, detail = _measure(df, check, n)
                if needed and not _surely_resolves(df, check):
                    like.agg(*needed)  # resolves types against the schema alone
            except Exception as error:  # a check that cannot be built fails alone
                needed, success, detail = [], F.lit(False), F.lit(f"error: {error}")
        aggregates += needed
        rows.append(
            F.struct(
                F.lit(suite.name).alias("suite"),
                F.lit(n).alias("n"),
                F.lit(check.name).alias("expectation"),
                F.lit(check.column).cast("string").alias("column"),
                success.alias("success"),
                detail.alias("detail"),
            )
        )
    return aggregates, rows


def _reported(measured: DataFrame, rows: list[Column]) -> DataFrame:
    if not rows:
        return measured.sparkSession.createDataFrame([], RESULT)
    return measured.select(F.explode(F.array(*rows)).alias("r"), "records").select("r.*", "records")


def run_suite(df: DataFrame, suite: Suite) -> DataFrame:
    """One row per check, from one pass over ``df``; only the columns the checks name are read."""
    aggregates, rows = _planned(df, suite)
    return _reported(df.agg(*aggregates), rows)


def suite_counters(df: DataFrame, suite: Suite, by: Sequence[str] = C.DATE_PARTS) -> DataFrame:
    """What a suite counts, per part of the data: ``by``, ``records`` and the counters of the checks.

    All of them are counts, so those of several parts add up to those of the whole (:func:`merged_suite`), and only
    parts that changed have to be counted again.
    """
    aggregates, _ = _planned(df, suite)
    return df.groupBy(*by).agg(*aggregates)


def merged_suite(counters: DataFrame, suite: Suite, like: DataFrame) -> DataFrame:
    """The results of ``run_suite`` over the whole, from the counters of its parts. ``like`` has the columns of the data;
    no row of it is read."""
    aggregates, rows = _planned(like, suite)
    names = like.limit(0).agg(*aggregates).columns
    return _reported(counters.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]), rows)


def unexpected_rows(df: DataFrame, suite: Suite, shown: int = 5) -> DataFrame:
    """The first few unexpected values of each value-set check, with the check's number in the suite.

    All checks share one scan. Values are made distinct before the shuffle and ranked per check with a pre-shuffle
    limit, so a column full of unexpected values still sends few rows.
    """
    pairs = []
    for n, check in enumerate(suite.checks, 1):
        if check.kind == "in_set" and check.column in df.columns:
            value = F.col(f"`{check.column}`").cast("string").alias("value")
            pairs.append(F.when(_unknown(df, check), F.struct(F.lit(n).alias("n"), value)))
    if not pairs:
        return df.sparkSession.createDataFrame([], "n int, value string")
    flat = df.select(F.explode(F.array_compact(F.array(*pairs))).alias("p")).select("p.*").distinct()
    w = Window.partitionBy("n").orderBy("value")
    return flat.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= shown).drop("__r")


def summarize(results: DataFrame, pass_percent: float = C.GOLD_PASS_PERCENT) -> DataFrame:
    """One row: counts, success rate, and whether it reaches ``pass_percent``. No records is a failure."""
    good = F.count_if(F.col("success"))
    total = F.count(F.lit(1))
    counted = results.agg(
        F.coalesce(F.max("records"), F.lit(0)).alias("total_records"),
        total.alias("validations_checked"),
        good.alias("successful_validations"),
        (total - good).alias("failed_validations"),
        F.coalesce(F.try_divide(good * 100.0, total), F.lit(0.0)).alias("success_rate"),
    )
    passed = (F.col("total_records") > 0) & (F.col("success_rate") >= pass_percent)
    error = F.when(F.col("total_records") == 0, F.lit("No data"))
    return counted.select(passed.alias("success"), *counted.columns, error.alias("error"))


def no_data(spark: SparkSession) -> DataFrame:
    """The failed one-row report on data that is not there."""
    columns = "success boolean, total_records bigint, validations_checked bigint, successful_validations bigint, failed_validations bigint, success_rate double, error string"
    return spark.createDataFrame([(False, 0, 0, 0, 0, 0.0, "No data")], columns)


def no_rows(failing: DataFrame, suite: str, name: str) -> DataFrame:
    """A query that should find nothing, as one result row."""
    found = failing.agg(F.count(F.lit(1)).alias("c"))
    return found.select(
        F.lit(suite).alias("suite"),
        F.lit(1).alias("n"),
        F.lit(name).alias("expectation"),
        F.lit(None).cast("string").alias("column"),
        (F.col("c") == 0).alias("success"),
        _text(F.col("c").cast("string"), " rows found").alias("detail"),
        F.col("c").alias("records"),
    )


# Profiles


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, for columns that have any; not-a-number counts as missing."""
    counted = df.agg(*[F.count_if(missing(df, c)).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("nulls")) for c in df.columns])
    return counted.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("nulls") > 0)


def _whole_text(value: Column, kind: T.DataType) -> Column:
    """Text that is equal for equal nested values only: each part has its length before it, and nulls are marked."""
    if isinstance(kind, T.ArrayType):
        parts = F.transform(value, lambda x: _whole_text(x, kind.elementType))
        text = F.concat(F.size(value).cast("string"), F.lit("["), F.array_join(parts, ""))
    elif isinstance(kind, T.StructType):
        text = F.concat(F.lit("{"), *[_whole_text(value.getField(f.name), f.dataType) for f in kind.fields])
    elif isinstance(kind, T.MapType):
        pairs = F.transform(F.map_entries(value), lambda e: F.concat(_whole_text(e["key"], kind.keyType), _whole_text(e["value"], kind.valueType)))
        text = F.concat(F.size(value).cast("string"), F.lit("<"), F.array_join(F.array_sort(pairs), ""))
    elif isinstance(kind, T.BinaryType):
        text = F.hex(value)
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        text = F.when(value == 0, F.lit("0.0")).otherwise(value.cast("string"))  # the two zeros are equal
    else:
        text = value.cast("string")
    return F.when(value.isNull(), F.lit("n")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat another row in full.

    Rows are counted by two hashes, 128 bits in all, in place of their columns: only hashes and counts are shuffled,
    and copies are counted before that.
    """
    row = [F.col(f"`{c}`") for c in df.columns]
    kinds = [f.dataType.typeName() for f in df.schema.fields]
    # Hashes pass over nulls, so which columns are null is hashed with them. Inside arrays and structs they also pass over
    # nulls and bounds, so nested columns are hashed as text that shows both; variants have no hash but as text.
    plain = [_whole_text(c, f.dataType) if k in ("array", "struct", "map") else c.cast("string") if k == "variant" else c for c, k, f in zip(row, kinds, df.schema.fields)]
    empty = [c.isNull() for c in row]
    hashes = [F.xxhash64(F.lit(seed), *plain, *empty) for seed in (1, 2)]
    copies = df.groupBy(hashes[0].alias("__a"), hashes[1].alias("__b")).agg(F.count(F.lit(1)).alias("__copies"))
    return copies.agg(F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("duplicates"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.col("count").desc(), "value")


def top_values(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    return value_counts(df, column).limit(n)


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def unexpected_values(df: DataFrame, column: str, allowed: Sequence, shown: int | None = 5) -> DataFrame:
    """Distinct known values outside ``allowed``, the first ``shown`` in order (all with ``None``)."""
    other = df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(allowed))).select(F.col(column).alias("value"))
    ordered = other.distinct().orderBy("value")
    return ordered if shown is None else ordered.limit(shown)


def records(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def profile(df: DataFrame, shown_cities: int = 5) -> DataFrame:
    """Long-form profile: ``section, item, value``: columns, size, counts of sources and alerts, years and top cities.

    Sizes, counts and range come from one aggregate; the top cities are a bounded sort of another.
    """
    text = "string"
    sections = [F.struct(F.lit("records").alias("section"), F.lit("rows").alias("item"))]
    for name in ("data_source", "weather_alert_type"):
        if name in df.columns:
            sections.append(F.struct(F.lit(name).alias("section"), F.col(name).cast(text).alias("item")))
    year = F.col("year") if "year" in df.columns else F.lit(None).cast("int")
    tagged = df.select(year.alias("year"), F.explode(F.array(*sections)).alias("s"))
    counted = (
        tagged.where(F.col("s.item").isNotNull())
        .groupBy("s.section", "s.item")
        .agg(F.count(F.lit(1)).alias("n"), F.min("year").alias("first"), F.max("year").alias("last"))
    )

    def line(section: Column, item: Column, value: Column) -> Column:
        return F.struct(section.alias("section"), item.alias("item"), value.cast(text).alias("value"))

    lines = [line(F.col("section"), F.col("item"), F.col("n"))]
    if "year" in df.columns:
        on_size = F.col("section") == "records"
        for item, value in (("min", F.col("first")), ("max", F.col("last"))):
            lines.append(F.when(on_size, line(F.lit("year"), F.lit(item), value)))
    out = counted.select(F.explode(F.array_compact(F.array(*lines))).alias("l")).select("l.*")
    shape = [("columns", "count", str(len(df.columns))), *(("column", str(i), c) for i, c in enumerate(df.columns, 1))]
    out = out.unionByName(df.sparkSession.createDataFrame(shape, "section string, item string, value string"))
    if "city" in df.columns:
        cities = top_values(df, "city", shown_cities)
        out = out.unionByName(
            cities.select(F.lit("top_city").alias("section"), F.col("value").cast(text).alias("item"), F.col("count").cast(text).alias("value"))
        )
    return out
