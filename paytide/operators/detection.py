"""Anomaly detection over Silver: fixed rules, velocity, z-score, IQR, and scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytide.functions.rules import any_of, detection_rules
from paytide.functions.scalars import flag
from paytide.operators.lookup import attach
from paytide.sources.staging import staged

VELOCITY_WINDOW_SECONDS = 3600
VELOCITY_MIN_TXNS = 3
SLICE_SECONDS = 6 * 3600
ZSCORE_LIMIT = 3.0
IQR_FENCE = 1.5
# Buckets of a key's distinct values, and the sketch's accuracy (an error of one in so many).
BUCKETS = 32
SKETCH_ACCURACY = 2000
FAILURE_ALERT_PCT = 10.0


def rule_flags(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """One boolean per single-row rule, and `is_suspect` if any of them fires."""
    rules = {name: flag(rule) for name, rule in (rules or detection_rules()).items()}
    flags = df.withColumns(rules)
    return flags.withColumn("is_suspect", any_of([F.col(name) for name in rules]))


# --- velocity -------------------------------------------------------------------------


def velocity_counts(
    df: DataFrame,
    *,
    key: str = "sender_vpa",
    event_time: str = "txn_timestamp",
    window_seconds: int = VELOCITY_WINDOW_SECONDS,
) -> DataFrame:
    """Per key and second: rows in that second (`n`) and in the window ending with it
    (`n_window`, both ends included).

    A plain range window per key would put all rows of a busy key in one task. Here rows
    are first counted per second. Each second enters the count when it occurs and leaves it
    when it is `window_seconds` old; the count is the running sum of these changes, whose
    cost does not depend on how full the windows are. Time is cut into slices, the changes
    of each slice are added up, and a slice starts from the sum of all before it. So a task
    group holds the changes of one slice, at most two for each of its `SLICE_SECONDS`
    seconds, however many rows a key has and however long the window is.
    """
    per_second = (
        df.filter(F.col(event_time).isNotNull())
        .groupBy(key, F.unix_seconds(event_time).alias("second"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    changes = F.array(
        F.struct(F.col("second").alias("_at"), F.col("n").alias("_change")),
        F.struct(
            (F.col("second") + window_seconds + 1).alias("_at"), (-F.col("n")).alias("_change")
        ),
    )
    flow = per_second.select(F.col(key).alias("_key"), "second", "n", F.inline(changes)).withColumn(
        "_slice", F.floor(F.col("_at") / SLICE_SECONDS)
    )
    earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        flow.groupBy("_key", "_slice")
        .agg(F.sum("_change").alias("_total"))
        .withColumn("_before", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
        .select(F.col("_key").alias("_k"), F.col("_slice").alias("_s"), "_before")
    )
    so_far = (
        Window.partitionBy("_key", "_slice")
        .orderBy("_at")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        flow.withColumn("_within", F.sum("_change").over(so_far))
        .filter("_change > 0")
        .join(starts, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_slice") == F.col("_s")))
        .select(F.col("_key").alias(key), "second", "n", (F.col("_before") + F.col("_within")).alias("n_window"))
    )


def velocity_flags(
    df: DataFrame,
    *,
    key: str = "sender_vpa",
    event_time: str = "txn_timestamp",
    window_seconds: int = VELOCITY_WINDOW_SECONDS,
    min_txns: int = VELOCITY_MIN_TXNS,
    row_id: Sequence[str] = ("txn_id",),
) -> DataFrame:
    """Mark rows that are at least the `min_txns`-th of their key within the window.

    Only seconds that reach the limit are joined back, which is a small table as long as
    bursts are the exception. Adds `window_txns` (NULL below the limit) and `is_velocity`.
    """
    bursts = (
        velocity_counts(df, key=key, event_time=event_time, window_seconds=window_seconds)
        .filter(F.col("n_window") >= min_txns)
        .select(
            key,
            F.col("second").alias("_second"),
            F.col("n").alias("_n"),
            F.col("n_window").alias("window_txns"),
        )
    )
    rows = df.withColumn("_second", F.unix_seconds(event_time))
    joined = attach(rows, bursts, [key, "_second"], weight="_n", spread_by=row_id)
    return joined.drop("_second", "_n").withColumn(
        "is_velocity", F.col("window_txns").isNotNull()
    )


# --- z-score --------------------------------------------------------------------------


def group_profile(df: DataFrame, key: str = "sender_bank", value: str = "amount") -> DataFrame:
    """Row count, mean and sample deviation of `value` per key."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("profile_rows"),
        F.avg(value).alias("profile_mean"),
        F.stddev_samp(value).alias("profile_stddev"),
    )


def zscore_flags(
    df: DataFrame,
    profile: DataFrame | None = None,
    *,
    key: str = "sender_bank",
    value: str = "amount",
    limit: float = ZSCORE_LIMIT,
    row_id: Sequence[str] = ("txn_id",),
) -> DataFrame:
    """Add `z_score` within the key's distribution and `is_zscore_outlier`.

    A stored `profile` scores new rows against earlier history; by default it is taken
    from `df` itself. A key without spread has no score.
    """
    fitted = profile if profile is not None else group_profile(df, key, value)
    weight = "profile_rows" if profile is None else None  # history does not weigh these rows
    joined = attach(df, fitted, [key], weight=weight, spread_by=row_id)
    z = F.try_divide(F.col(value) - F.col("profile_mean"), F.col("profile_stddev"))
    return (
        joined.withColumn("z_score", z)
        .withColumn("is_zscore_outlier", flag(F.abs("z_score") > limit))
        .drop("profile_rows", "profile_mean", "profile_stddev")
    )


# Four decimals, so that squares of amounts fit; sums of squares have 30 digits before the point.
_SQUARED = "decimal(18,4)"


def daily_profile(
    df: DataFrame, key: str = "sender_bank", value: str = "amount", day: str = "txn_date"
) -> DataFrame:
    """`(key, day, n, value_sum, square_sum)`: what a key's profile needs of one day.

    Sums are exact (values at four decimals, below 1e14), so days can be stored once and
    merged in any order and grouping with the same digits. Values that do not fit are left
    out, like NULLs.
    """
    exact = F.col(value).try_cast(_SQUARED)
    return (
        df.filter(exact.isNotNull())
        .groupBy(key, day)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(exact).cast("decimal(38,4)").alias("value_sum"),
            F.sum((exact * exact).cast("decimal(36,8)")).cast("decimal(38,8)").alias("square_sum"),
        )
    )


def _profile_of(n: Column, value_sum: Column, square_sum: Column) -> dict[str, Column]:
    """Mean and sample deviation from exact sums; no deviation below two values."""
    total = value_sum.cast("double")
    spread = square_sum.cast("double") - total * total / n
    return {
        "profile_rows": n,
        "profile_mean": F.try_divide(total, n),
        "profile_stddev": F.sqrt(F.try_divide(F.greatest(spread, F.lit(0.0)), F.nullif(n - 1, F.lit(0)))),
    }


def merged_profile(daily: DataFrame, key: str = "sender_bank") -> DataFrame:
    """The profile of all days of a `daily_profile`, for `zscore_flags`."""
    sums = daily.groupBy(key).agg(
        *[F.sum(c).alias(c) for c in ("n", "value_sum", "square_sum")]
    )
    shown = _profile_of(F.col("n"), F.col("value_sum"), F.col("square_sum"))
    return sums.select(key, *[c.alias(name) for name, c in shown.items()])


def trailing_profile(
    daily: DataFrame, days: int, key: str = "sender_bank", day: str = "txn_date"
) -> DataFrame:
    """Per key and day the profile of the `days` days before it, from `daily_profile`.

    Days are merged, rows are not read again. A window holds a key's days only. Days without
    a row for the key have no line; a day without any earlier one has no profile.
    """
    at = F.unix_date(day)
    before = Window.partitionBy(key).orderBy(at).rangeBetween(-days, -1)
    sums = {c: F.sum(c).over(before) for c in ("n", "value_sum", "square_sum")}
    found = daily.filter(F.col(day).isNotNull()).select(key, day, *[c.alias(f"_{n}") for n, c in sums.items()])
    shown = _profile_of(F.col("_n"), F.col("_value_sum"), F.col("_square_sum"))
    return found.select(key, day, *[c.alias(name) for name, c in shown.items()])


def zscore_trailing(
    df: DataFrame,
    days: int,
    daily: DataFrame | None = None,
    *,
    key: str = "sender_bank",
    value: str = "amount",
    day: str = "txn_date",
    limit: float = ZSCORE_LIMIT,
    row_id: Sequence[str] = ("txn_id",),
) -> DataFrame:
    """Add `z_score` against the key's `days` days before the row's own, and
    `is_zscore_outlier`. A stored `daily` profile saves the pass over history; rows of a day
    without a profile, or a key without spread in it, have no score."""
    daily = daily if daily is not None else daily_profile(df, key, value, day)
    profile = trailing_profile(daily, days, key, day)
    joined = attach(df, profile, [key, day], weight=None, spread_by=row_id)
    z = F.try_divide(F.col(value) - F.col("profile_mean"), F.col("profile_stddev"))
    return (
        joined.withColumn("z_score", z)
        .withColumn("is_zscore_outlier", flag(F.abs("z_score") > limit))
        .drop("profile_rows", "profile_mean", "profile_stddev")
    )


# --- quartiles ------------------------------------------------------------------------


def group_percentiles(
    df: DataFrame,
    percentages: Mapping[str, float],
    *,
    key: str = "sender_bank",
    value: str = "amount",
    bucket_width: float | None = None,
) -> DataFrame:
    """Exact interpolated percentiles of `value` per key, plus `n`, the values counted.

    The built-in exact percentile keeps all distinct values of a group in one task's
    memory. Instead, equal values are counted before the shuffle, buckets locate the ranks
    asked for, and only the buckets holding one are ordered value by value. The buckets' edges are
    quantiles of each key's distinct values, from a sketch that is merged on the map side,
    so a bucket holds about one in `BUCKETS` of them whatever the values' range; the edges
    only balance the work and the result is exact. With `bucket_width` the edges are its
    multiples instead, which saves the sketch where the range is known.
    """
    values = (
        df.filter(F.col(value).isNotNull())
        .groupBy(F.col(key).alias("_key"), F.col(value).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    if bucket_width is None:
        # Staged: the sketch, the buckets and the ranks all start from it.
        values = staged(values)
        steps = F.array(*[F.lit(i / BUCKETS) for i in range(1, BUCKETS)])
        edges = values.groupBy("_key").agg(
            F.percentile_approx("_value", steps, SKETCH_ACCURACY).alias("_edges"),
            F.count(F.lit(1)).alias("_weight"),
        )
        values = attach(values, edges, ["_key"], weight="_weight", spread_by=["_value"])
        bucket = F.size(F.filter("_edges", lambda edge: edge <= F.col("_value"))).cast("long")
        values = values.select("_key", "_value", "_n", bucket.alias("_bucket"))
    else:
        values = values.withColumn("_bucket", F.floor(F.col("_value") / bucket_width))
    # Stated for both uses below, so that they share one scan and one shuffle.
    values = values.filter(F.col("_bucket").isNotNull())
    earlier = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    buckets = (
        values.groupBy("_key", "_bucket")
        .agg(F.sum("_n").alias("_held"))
        .withColumn("_before", F.coalesce(F.sum("_held").over(earlier), F.lit(0)))
        .withColumn("_total", F.sum("_held").over(Window.partitionBy("_key")))
    )

    def rank(p: float) -> Column:
        return (F.col("_total") - 1) * F.lit(p)

    def covers(position: Column, start: Column, end: Column) -> Column:
        return (start <= position) & (position < end)

    wanted = [edge(rank(p)) for p in percentages.values() for edge in (F.floor, F.ceil)]
    holding = buckets.filter(
        any_of([covers(w, F.col("_before"), F.col("_before") + F.col("_held")) for w in wanted])
    ).withColumnsRenamed({"_key": "_k", "_bucket": "_b"})

    running = (
        Window.partitionBy("_key", "_bucket")
        .orderBy("_value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = (
        values.join(
            holding,
            F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_bucket") == F.col("_b")),
        )
        .withColumn("_end", F.col("_before") + F.sum("_n").over(running))
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )

    def value_at(position: Column) -> Column:
        return F.max(F.when(covers(position, F.col("_start"), F.col("_end")), F.col("_value")))

    found = placed.groupBy("_key").agg(
        F.max("_total").alias("_total"),
        *[value_at(F.floor(rank(p))).alias(f"_low_{name}") for name, p in percentages.items()],
        *[value_at(F.ceil(rank(p))).alias(f"_high_{name}") for name, p in percentages.items()],
    )

    def interpolated(name: str, p: float) -> Column:
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        return low + (high - low) * (rank(p) - F.floor(rank(p)))

    return found.select(
        F.col("_key").alias(key),
        F.col("_total").alias("n"),
        *[interpolated(name, p).alias(name) for name, p in percentages.items()],
    )


def iqr_fences(
    df: DataFrame,
    *,
    key: str = "sender_bank",
    value: str = "amount",
    fence: float = IQR_FENCE,
    bucket_width: float | None = None,
) -> DataFrame:
    """Quartiles per key and the limits `fence` interquartile ranges outside them."""
    quartiles = group_percentiles(
        df, {"q1": 0.25, "q3": 0.75}, key=key, value=value, bucket_width=bucket_width
    )
    reach = (F.col("q3") - F.col("q1")) * fence
    return quartiles.withColumns(
        {"lower_fence": F.col("q1") - reach, "upper_fence": F.col("q3") + reach}
    )


def iqr_flags(
    df: DataFrame,
    fences: DataFrame | None = None,
    *,
    key: str = "sender_bank",
    value: str = "amount",
    row_id: Sequence[str] = ("txn_id",),
    **options: float,
) -> DataFrame:
    """Add `is_iqr_outlier`: the value lies outside its key's fences."""
    fitted = fences if fences is not None else iqr_fences(df, key=key, value=value, **options)
    # Private names: the caller's own columns may be called `n` or `q1`.
    private = fitted.select(
        key,
        F.col("n").alias("_iqr_n"),
        F.col("lower_fence").alias("_iqr_lower"),
        F.col("upper_fence").alias("_iqr_upper"),
    )
    weight = "_iqr_n" if fences is None else None  # history does not weigh these rows
    joined = attach(df, private, [key], weight=weight, spread_by=row_id)
    outside = (F.col(value) < F.col("_iqr_lower")) | (F.col(value) > F.col("_iqr_upper"))
    kept = [c for c in df.columns if c != "is_iqr_outlier"]
    return joined.select(*kept, flag(outside).alias("is_iqr_outlier"))


# --- scoring and alerts ---------------------------------------------------------------


def confusion(df: DataFrame, predicted: Column | str, label: str = "is_anomaly") -> DataFrame:
    """Rows per (label, predicted) pair."""
    guess = F.col(predicted) if isinstance(predicted, str) else predicted
    return df.groupBy(flag(F.col(label)).alias("label"), flag(guess).alias("predicted")).agg(
        F.count(F.lit(1)).alias("txns")
    )


def detector_score(
    df: DataFrame, detectors: Sequence[str], label: str = "is_anomaly"
) -> DataFrame:
    """Precision and recall of boolean detector columns against the label.

    All detectors are counted in one pass over one row per task.
    """
    truth = flag(F.col(label))
    outcomes: list[Column] = []
    for name in detectors:
        guess = flag(F.col(name))
        outcomes += [
            F.count_if(truth & guess).alias(f"{name}_tp"),
            F.count_if(~truth & guess).alias(f"{name}_fp"),
            F.count_if(truth & ~guess).alias(f"{name}_fn"),
            F.count_if(~truth & ~guess).alias(f"{name}_tn"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("detector"),
                *[F.col(f"{name}_{kind}").alias(kind) for kind in ("tp", "fp", "fn", "tn")],
            )
            for name in detectors
        ]
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return (
        df.agg(*outcomes)
        .select(F.inline(rows))
        .withColumns(
            {
                "precision": F.round(F.try_divide(tp, tp + fp), 4),
                "recall": F.round(F.try_divide(tp, tp + fn), 4),
            }
        )
    )


def failure_alert(
    bank_failures: DataFrame, threshold_pct: float = FAILURE_ALERT_PCT
) -> DataFrame:
    """Banks whose failure rate lies above the threshold, from `bank_failure_analysis`."""
    return bank_failures.filter(F.col("failure_rate_pct") > threshold_pct).orderBy(
        F.desc("failure_rate_pct"), "sender_bank"
    )
