"""Profiling and validation jobs over Bronze, Silver and quarantine.

Each function is one (or two) distributed aggregates returning a small
DataFrame; nothing is collected to the driver. Bronze functions expect raw
column names, Silver/quarantine functions the renamed ones.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DecimalType, DoubleType, FloatType, IntegerType, LongType,
                               ShortType)

from .. import spec
from ..functions import rules
from ..functions.common import count_true

NUMERIC_TYPES = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DecimalType)
DERIVED_COLUMNS = (spec.OFFSET_COLUMN, *spec.WARNING_FLAGS, "trip_duration_min", "avg_speed_mph", "pickup_month")
RUN_STAMP_COLUMNS = (spec.INGESTED_AT_COLUMN, spec.PROCESSED_AT_COLUMN, spec.REJECTED_AT_COLUMN)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def round2(c: Column) -> Column:
    """Two-decimal rounding, half away from zero on the scaled double."""
    return F.round(c * 100.0, 0) / 100.0


def _share(count: Column, total: Column) -> Column:
    return F.when(total != 0, round2(count.cast("double") / total.cast("double") * 100.0)).otherwise(F.lit(0.0))


def _unpivot_counts(df: DataFrame, columns: list[str], count_name: str) -> DataFrame:
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return df.select("_rows", F.expr(f"stack({len(columns)}, {pairs}) AS (column, {count_name})"))


def null_summary(df: DataFrame) -> DataFrame:
    """Per column: null count and percent of rows (2 decimals). One scan."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = _unpivot_counts(agg, cols, "null_count")
    return long.select("column", F.col("null_count").cast("bigint").alias("null_count"),
                       _share(F.col("null_count"), F.col("_rows")).alias("null_percentage"))


def negative_summary(df: DataFrame) -> DataFrame:
    """Per numeric column: rows below zero and percent of rows."""
    cols = numeric_columns(df)
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[count_true(F.col(c) < 0).alias(c) for c in cols])
    long = _unpivot_counts(agg, cols, "negative_count")
    return long.select("column", F.col("negative_count").cast("bigint").alias("negative_count"),
                       _share(F.col("negative_count"), F.col("_rows")).alias("negative_percentage"))


def negative_rows(df: DataFrame) -> DataFrame:
    """Rows with at least one negative numeric value (schema-driven OR)."""
    cond = reduce(lambda a, b: a | b, [F.col(c) < 0 for c in numeric_columns(df)])
    return df.agg(count_true(cond).alias("negative_row_count"), F.count(F.lit(1)).alias("_rows")).select(
        "negative_row_count", _share(F.col("negative_row_count"), F.col("_rows")).alias("negative_percentage"))


#: Buckets of a histogram pass, and passes: a last bucket holds 1/BUCKETS^PASSES of a column's range.
BUCKETS, PASSES = 1024, 2
QUARTILES = (0.25, 0.5, 0.75)


def numeric_summary(df: DataFrame) -> DataFrame:
    """count, mean, stddev, min, exact quartiles (p25, p50, p75) and max of each numeric column, one row a column.

    Quartiles interpolate linearly between order statistics, which are found by
    selection, without sorting: one aggregate for counts and ranges, PASSES
    histograms of all columns at once, each of the buckets that hold a wanted
    rank of the one before, and a last pass over the rows of the last buckets,
    which counts their values. Missing values (NULL, NaN) do not count.
    """
    cols = numeric_columns(df)
    value = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    finite = lambda c: F.when(F.abs(value(c)) < float("inf"), value(c))
    stats = df.agg(F.array(*[F.struct(
        F.lit(c).alias("column"), F.count(value(c)).alias("count"), F.avg(value(c)).alias("mean"), F.stddev(value(c)).alias("stddev"),
        F.min(value(c)).alias("min"), F.max(value(c)).alias("max"), F.min(finite(c)).alias("low"), F.max(finite(c)).alias("high")) for c in cols]).alias("a"))
    stats = {r["column"]: r for r in stats.select(F.inline("a")).collect()}  # one row a column
    spark = df.sparkSession

    # ranks (from 0) of the order statistics that a column's quartiles lie between
    ranks = {c: sorted({f(q * (s["count"] - 1)) for q in QUARTILES for f in (math.floor, math.ceil)}) for c, s in stats.items() if s["count"]}
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), value(c).alias("x")) for i, c in enumerate(cols)])
    rows = df.select(F.explode(pairs).alias("p")).where(F.col("p.x").isNotNull()).select("p.i", "p.x")
    low = _literal([stats[c].low for c in cols])
    width = _literal([None if stats[c].low is None else (stats[c].high - stats[c].low) or 1.0 for c in cols])
    # Position within the range, from 0 to 1; infinite values lie before and behind. Each step keeps the order of the values.
    place = (F.when(F.col("x") == float("inf"), F.lit(2.0)).when(F.col("x") == float("-inf"), F.lit(-1.0))
             .otherwise((F.col("x") - F.get(low, F.col("i"))) / F.get(width, F.col("i"))))
    rows = rows.withColumn("b", F.floor(place * float(BUCKETS ** PASSES)))  # the number of its last bucket
    prefix = {(i, None): (0, list(ranks.get(c, []))) for i, c in enumerate(cols) if c in ranks}
    for step in range(PASSES):
        # prefix: (column, bucket of the pass before) -> (rows before it, ranks that lie in it)
        size = BUCKETS ** (PASSES - 1 - step)
        outer = F.floor(F.col("b") / (size * BUCKETS))
        wanted = None if step == 0 else [(i, p) for i, p in prefix]
        part = rows
        if wanted is not None:  # six buckets a column at most
            part = rows.withColumn("o", outer).join(F.broadcast(spark.createDataFrame(wanted or [], "i int, o long")), ["i", "o"], "left_semi")
        counts = part.groupBy("i", F.floor(F.col("b") / size).alias("k")).count().collect()  # BUCKETS rows a wanted bucket at most
        held: dict = {}
        for r in sorted(counts):
            held.setdefault((r.i, None if step == 0 else r.k // BUCKETS), []).append((r.k, r["count"]))
        following = {}
        for key, (before, want) in prefix.items():
            for k, n in held[key]:
                inside = [x for x in want if before <= x < before + n]
                if inside:
                    following[key[0], k] = (before, inside)
                before += n
        prefix = following
    start = spark.createDataFrame([(i, k, before, want) for (i, k), (before, want) in prefix.items()], "i int, b long, before long, want array<long>")
    values = rows.join(F.broadcast(start), ["i", "b"]).groupBy("i", "b", "before", "want", "x").count()  # a few buckets a column
    order = Window.partitionBy("i", "b").orderBy("x")
    upto = F.col("before") + F.sum("count").over(order)
    found = (values.select("i", "x", "want", upto.alias("upto"), F.col("count")).where(F.exists("want", lambda w: (w >= F.col("upto") - F.col("count")) & (w < F.col("upto"))))
             .select("i", F.col("x"), F.explode(F.filter("want", lambda w: (w >= F.col("upto") - F.col("count")) & (w < F.col("upto")))).alias("rank")))
    at = {(r.i, r["rank"]): r.x for r in found.collect()}  # six a column at most
    out = []
    for i, c in enumerate(cols):
        s, cut = stats[c], []
        for q in QUARTILES:
            if not s["count"]:
                cut.append(None)
                continue
            place = q * (s["count"] - 1)
            a, b = at[i, math.floor(place)], at[i, math.ceil(place)]
            cut.append(a if a == b else a + (b - a) * (place - math.floor(place)))
        out.append((c, s["count"], s["mean"], s["stddev"], s["min"], *cut, s["max"]))
    return spark.createDataFrame(out, "column string, count long, mean double, stddev double, min double, p25 double, p50 double, p75 double, max double")


def _literal(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])


def frequency(df: DataFrame, column: str, nulls_first: bool = True) -> DataFrame:
    """Value counts of one column, ordered by value (NULL first by default)."""
    order = F.asc_nulls_first(column) if nulls_first else F.asc_nulls_last(column)
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(order)


def column_value_counts(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """For every column: counts per value, as (column, value, count).

    One pass: each row is exploded into (column, value-as-text) pairs, so the
    per-column group-bys share one shuffle (map-side combined).
    """
    cols = [c for c in df.columns if c not in exclude]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    exploded = df.select(F.explode(pairs).alias("p"))
    return exploded.groupBy(F.col("p.column").alias("column"), F.col("p.value").alias("value")).agg(
        F.count(F.lit(1)).alias("count"))


def zero_duration_profile(bronze: DataFrame) -> DataFrame:
    """Value counts of every other column among zero-duration Bronze rows."""
    zero = bronze.filter(F.col("tpep_pickup_datetime") == F.col("tpep_dropoff_datetime"))
    return column_value_counts(zero, exclude=("tpep_pickup_datetime", "tpep_dropoff_datetime"))


def _epoch_seconds(c: Column) -> Column:
    """Whole epoch seconds of a zone-less timestamp. `unix_timestamp` reads
    TIMESTAMP_NTZ without the session zone; a cast to TIMESTAMP would apply
    it, and differences across a DST change would be off by an hour."""
    return F.unix_timestamp(c)


def timestamp_health(bronze: DataFrame, pickup: str = "tpep_pickup_datetime",
                     dropoff: str = "tpep_dropoff_datetime") -> DataFrame:
    p, d = F.col(pickup), F.col(dropoff)
    both = p.isNotNull() & d.isNotNull()
    return bronze.agg(
        count_true(p.isNull()).alias("missing_pickup"),
        count_true(d.isNull()).alias("missing_dropoff"),
        count_true(both & (d <= p)).alias("dropoff_not_after_pickup"),
        count_true(both & (_epoch_seconds(d) - _epoch_seconds(p) > 24 * 60 * 60)).alias("duration_over_24_hours"),
    )


def duration_days(bronze: DataFrame, pickup: str = "tpep_pickup_datetime",
                  dropoff: str = "tpep_dropoff_datetime") -> DataFrame:
    """Histogram of whole days between pickup and dropoff (wall clock,
    truncated toward zero, independent of the session time zone)."""
    p, d = F.col(pickup), F.col(dropoff)
    days = F.extract(F.lit("DAY"), d - p).cast("long").alias("trip_duration_days")
    return bronze.filter(p.isNotNull() & d.isNotNull()).groupBy(days).agg(F.count(F.lit(1)).alias("count"))


def misdated(bronze: DataFrame, first_day: str = "2026-01-01", end_day: str = "2026-04-01",
             min_pickup: str = spec.MIN_PICKUP, max_pickup: str = spec.MAX_PICKUP,
             pickup: str = "tpep_pickup_datetime") -> DataFrame:
    """Counts of misdated rows under the three definitions (one scan)."""
    p = F.col(pickup)
    day = F.to_date(p)
    label = F.regexp_extract(F.col(spec.SOURCE_FILE_COLUMN), spec.SOURCE_MONTH_LABEL_REGEX, 1)
    start = F.to_date(F.concat(label, F.lit("-01")), "yyyy-MM-dd")
    start = F.when(label != "", start)
    outside_global = p.isNotNull() & ((day < F.lit(first_day).cast("date")) | (day >= F.lit(end_day).cast("date")))
    outside_source = p.isNotNull() & start.isNotNull() & ((day < start) | (day >= F.add_months(start, 1)))
    outside_range = p.isNotNull() & ((p < rules.ntz(min_pickup)) | (p > rules.ntz(max_pickup)))
    return bronze.agg(
        count_true(outside_global).alias("outside_global_dates"),
        count_true(outside_source).alias("outside_source_month"),
        count_true(outside_range).alias("outside_allowed_range"),
    )


def anomaly_crosstab(bronze: DataFrame) -> DataFrame:
    # The output names.
    fare, dist, total, pax = (F.col("fare_amount"), F.col("trip_distance"), F.col("total_amount"),
                              F.col("passenger_count"))
    return bronze.agg(
        count_true(dist <= 0).alias("invalid_trip_distance"),
        count_true(fare < 0).alias("invalid_fare_amount"),
        count_true(total < 0).alias("invalid_total_amount"),
        count_true(pax <= 0).alias("invalid_passenger_count"),
        count_true(fare < 0).alias("fare_l_0"),
        count_true(fare == 0).alias("fare_eq_0"),
        count_true((fare == 0) & (dist == 0)).alias("fare_eq_0_and_distance_eq_0"),
        count_true(dist == 0).alias("distance_eq_0"),
        count_true(dist < 0).alias("distance_l_0"),
        count_true(total == 0).alias("total_eq_0"),
        count_true((total == 0) & (fare == 0)).alias("total_eq_0_and_fare_eq_0"),
        count_true(total < fare).alias("total_lt_fare"),
    )


#: A hash's place in the bitmap, by its lowest bits: a row of words (12), a word (9), a bit (6). 2^27 bits are 16 MB.
WORD_ROWS, WORDS = 4096, 512


def _marked(keyed: DataFrame, hot: DataFrame) -> DataFrame:
    """The rows whose hash `_h` has a bit that some hash of `hot` marks in a bitmap of WORD_ROWS x WORDS words."""
    h = F.col("_h")
    at, word, bit = h.bitwiseAND(WORD_ROWS - 1), F.shiftright(h, 12).bitwiseAND(WORDS - 1), F.shiftright(h, 21).bitwiseAND(63).cast("int")
    one = F.lit(1).cast("long")
    marks = hot.select(at.alias("_at"), word.alias("_word"), F.call_function("shiftleft", one, bit).alias("_bits"))
    i = F.col("id")  # every word is there, so that a word's place in its row is its number
    none = hot.sparkSession.range(WORD_ROWS * WORDS).select(
        i.bitwiseAND(WORD_ROWS - 1).alias("_at"), F.shiftright(i, 12).alias("_word"), F.lit(0).cast("long").alias("_bits"))
    words = marks.unionByName(none).groupBy("_at", "_word").agg(F.bit_or("_bits").alias("_bits"))
    bitmap = words.groupBy("_at").agg(F.transform(F.array_sort(F.collect_list(F.struct("_word", "_bits"))), lambda w: w["_bits"]).alias("_words"))
    found = keyed.withColumn("_at", at).join(F.broadcast(bitmap), "_at")
    # The hash comes out of the test of its bit: a join on it cannot be moved in front of the test.
    kept = F.when(F.call_function("getbit", F.get("_words", word.cast("int")), bit) == 1, h).alias("_h")
    return found.select(*[kept if c == "_h" else F.col(c) for c in keyed.columns]).filter("_h IS NOT NULL")


def duplicate_groups(df: DataFrame, key_columns: list[str]) -> DataFrame:
    """Exact duplicate groups over `key_columns` (NULLs equal), count > 1.

    Two phases so that the wide rows are not all shuffled: (1) count rows per
    64-bit hash of the key columns (an 8-byte shuffle key, map-side combined);
    (2) re-group exactly, on the full columns, only the rows whose hash
    occurs more than once. Hash collisions are resolved by phase 2.

    The hashes of phase 1 mark their bits in a bitmap of fixed size, which each
    task has: rows whose bit is not marked are left out before any wide row is
    shuffled. An unmarked bit is proof, a marked one is not, so the semi-join follows.

    Phase 2 groups on the key columns without the hash. Grouping on (hash,
    keys) would be satisfied by a shuffled semi-join's partitioning on the
    hash, so Spark would add no partial aggregate and AQE could not split a
    skewed join partition: one hot duplicate key would run as one task.
    Without the hash, a partial aggregate follows every join task (a hot key
    becomes one row per task) and AQE may split the skewed join side.
    """
    h = F.xxhash64(*[F.col(c) for c in key_columns]).alias("_h")
    keyed = df.select(h, *key_columns)
    hot = keyed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select("_h")
    candidates = _marked(keyed, hot).join(hot, "_h", "left_semi").drop("_h")
    return candidates.groupBy(*key_columns).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def duplicate_summary(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """One row: duplicate groups and excess (duplicate) rows."""
    keys = [c for c in df.columns if c not in exclude]
    groups = duplicate_groups(df, keys)
    return groups.agg(F.count(F.lit(1)).alias("duplicate_groups"),
                      F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def bronze_duplicates(bronze: DataFrame) -> DataFrame:
    return duplicate_summary(bronze, exclude=(spec.INGESTED_AT_COLUMN, spec.SOURCE_FILE_COLUMN))


def silver_duplicates(silver: DataFrame) -> DataFrame:
    """Duplicates by the source columns: the derived ones are functions of those (`silver_revalidation` checks that)."""
    return duplicate_summary(silver, exclude=(*RUN_STAMP_COLUMNS, *DERIVED_COLUMNS))


def silver_revalidation(silver: DataFrame, min_pickup: str = spec.MIN_PICKUP,
                        max_pickup: str = spec.MAX_PICKUP) -> DataFrame:
    """Re-check Silver's rules and derived columns; every count should be 0
    except the informational zero_duration and speed buckets."""
    p, d = F.col("pickup_datetime"), F.col("dropoff_datetime")
    dur, speed = F.col("trip_duration_min"), F.col("avg_speed_mph")
    recomputed = (_epoch_seconds(d) - _epoch_seconds(p)) / 60.0
    amount_checks = [
        count_true(F.col(c).isNull() | (F.col(c) < 0)).alias(c) for c in spec.REQUIRED_AMOUNT_COLUMNS
    ] + [count_true(F.col(c).isNotNull() & (F.col(c) < 0)).alias(c) for c in spec.OPTIONAL_AMOUNT_COLUMNS]
    return silver.agg(
        count_true(p.isNull()).alias("missing_pickup"),
        count_true(d.isNull()).alias("missing_dropoff"),
        count_true(d < p).alias("dropoff_before_pickup"),
        count_true(p < rules.ntz(min_pickup)).alias("pickup_before_window"),
        count_true(p > rules.ntz(max_pickup)).alias("pickup_after_window"),
        count_true(F.col("trip_distance").isNull() | (F.col("trip_distance") < 0)).alias("negative_or_null_distance"),
        count_true(F.col("passenger_count").isNotNull() & (F.col("passenger_count") <= 0))
        .alias("nonpositive_passenger_count"),
        *amount_checks,
        count_true(dur.isNull() | (dur < 0)).alias("negative_or_null_duration"),
        count_true(dur == 0).alias("zero_duration"),
        count_true(F.abs(dur - recomputed) > 1e-6).alias("duration_mismatch"),
        count_true(speed.isNull() != (dur == 0)).alias("speed_null_mismatch"),
        count_true(speed < 0).alias("negative_speed"),
        count_true(speed == 0).alias("zero_speed"),
        count_true(speed > 100).alias("speed_above_100_mph"),
    )


def warning_totals(silver: DataFrame) -> DataFrame:
    """Totals of the 5 warning flags and stored-vs-recomputed mismatches."""
    offset_expected = rules.source_month_offset(F.col("pickup_datetime"),
                                                rules.file_month_label(F.col(spec.SOURCE_FILE_COLUMN)))
    expected = rules.warning_columns()
    return silver.agg(
        *[count_true(F.col(f)).alias(f.removeprefix("_silver_")) for f in spec.WARNING_FLAGS],
        count_true(F.col(spec.OFFSET_COLUMN) != offset_expected).alias("source_month_offset_mismatch"),
        *[count_true(F.col(f) != expected[f]).alias(f"{f.removeprefix('_silver_')}_mismatch")
          for f in spec.WARNING_FLAGS],
    )


def month_offset_hist(silver: DataFrame) -> DataFrame:
    return silver.groupBy(F.col(spec.OFFSET_COLUMN)).agg(F.count(F.lit(1)).alias("count"))


def month_by_file(silver: DataFrame) -> DataFrame:
    return silver.groupBy(
        F.date_format("pickup_datetime", "yyyy-MM").alias("pickup_month"), F.col(spec.SOURCE_FILE_COLUMN),
    ).agg(F.count(F.lit(1)).alias("rows"), count_true(F.col(spec.OFFSET_COLUMN) != 0).alias("off_month"))


def partition_inventory(silver_table: DataFrame) -> DataFrame:
    """Per pickup-month partition: rows and data files (A17).

    Reads no column: rows come from the files' footers, the month from their
    paths. Rows are counted by file first, so each task sends a row a file.
    """
    files = silver_table.groupBy("pickup_month", F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n"))
    return files.groupBy("pickup_month").agg(F.sum("n").alias("record_count"), F.count(F.lit(1)).alias("file_count"))


def rejection_combos(quarantine: DataFrame) -> DataFrame:
    flags = list(spec.REJECTION_FLAGS)
    return quarantine.groupBy(*flags).agg(F.count(F.lit(1)).alias("count"))


def quarantine_no_reason(quarantine: DataFrame) -> DataFrame:
    none = reduce(lambda a, b: a & b, [~F.col(f) for f in spec.REJECTION_FLAGS])
    return quarantine.agg(F.count(F.lit(1)).alias("quarantined_rows"),
                          count_true(none).alias("rows_without_reason"))


def _flex_all_null() -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in spec.FLEX_FARE_FIELDS_RAW])


def flex_violations(bronze: DataFrame) -> DataFrame:
    """All-five-null rows, and rows breaking (payment_type = 0) == all-null.

    A NULL payment type makes the equivalence NULL, so such rows drop out.
    """
    all_null = _flex_all_null()
    equiv = (F.col("payment_type") == 0) == all_null
    return bronze.agg(count_true(all_null).alias("all_profile_fields_null_rows"),
                      count_true(~equiv).alias("flex_fare_violations"))


def flex_profile(bronze: DataFrame) -> DataFrame:
    """All-null rows counted by vendor, by source file and by payment type."""
    dims = F.array(
        F.struct(F.lit("VendorID").alias("d"), F.col("VendorID").cast("string").alias("v")),
        F.struct(F.lit(spec.SOURCE_FILE_COLUMN).alias("d"), F.col(spec.SOURCE_FILE_COLUMN).alias("v")),
        F.struct(F.lit("payment_type").alias("d"), F.col("payment_type").cast("string").alias("v")),
    )
    rows = bronze.filter(_flex_all_null()).select(F.explode(dims).alias("x"))
    return rows.groupBy(F.col("x.d").alias("dimension"), F.col("x.v").alias("value")).agg(
        F.count(F.lit(1)).alias("count"))


def ledger_balance(transform_log: DataFrame, silver: DataFrame, quarantine: DataFrame,
                   silver_table: str = spec.SILVER_TABLE) -> DataFrame:
    """Ledger vs tables: unbalanced success entries and total agreement."""
    log = transform_log.filter((F.col("status") == "success") & (F.col("target_table") == silver_table))
    t = log.agg(
        count_true(F.col("rows_read") != F.col("rows_written") + F.col("rows_rejected")).alias("unbalanced_entries"),
        F.coalesce(F.sum("rows_read"), F.lit(0)).cast("bigint").alias("log_rows_read"),
        F.coalesce(F.sum("rows_rejected"), F.lit(0)).cast("bigint").alias("log_rows_rejected"),
        F.coalesce(F.sum("rows_written"), F.lit(0)).cast("bigint").alias("log_rows_written"),
    )
    out = t.withColumns({
        "silver_rows": silver.agg(F.count(F.lit(1))).scalar(),
        "quarantine_rows": quarantine.agg(F.count(F.lit(1))).scalar(),
    })
    return out.withColumns({
        "log_matches_quarantine": F.col("log_rows_rejected") == F.col("quarantine_rows"),
        "log_matches_silver": F.col("log_rows_written") == F.col("silver_rows"),
    })
