"""Entity time series: moving averages, trend runs, daily metrics, correlation.

Every window here is partitioned by the entity key and ordered by date, so a
whole chain of windows costs one shuffle by the key.  A series holds one row
per entity and day (callers aggregate raw events to that grain first, which
Spark does map-side), so a window partition is bounded by the number of days
no matter how skewed the raw data is.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rawhouse.functions.labels import trend_label
from rawhouse.functions.text import pct_change


def year_range(c: Column | str, from_year: int, to_year: int) -> Column:
    """``year(c) BETWEEN from_year AND to_year`` as a half-open date range.

    Unlike ``year(c) = y`` this reaches the scan as a pushed filter and can
    prune row groups / partitions.
    """
    c = F.col(c) if isinstance(c, str) else c
    return (c >= F.lit(dt.date(from_year, 1, 1))) & (c < F.lit(dt.date(to_year + 1, 1, 1)))


def _spec(key: str | list[str], order: str):
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys).orderBy(order)


def moving_average(
    ts: DataFrame,
    key: str | list[str],
    order: str,
    value: str,
    n_preceding: int,
    out: str = "moving_average",
) -> DataFrame:
    """Trailing mean over ``n_preceding`` rows before and the current row
    (``ROWS n PRECEDING``: n + 1 rows, fewer at the start of a series)."""
    w = _spec(key, order).rowsBetween(-n_preceding, 0)
    return ts.withColumn(out, F.avg(value).over(w))


def with_trend(
    ts: DataFrame,
    key: str | list[str],
    order: str,
    value: str,
    n: int,
    price_lag: int | None = None,
) -> DataFrame:
    """Adds ``ma_short`` (n preceding), ``ma_long`` (2n preceding) and
    ``indicator`` ('up' when short > long).  With ``price_lag`` the value
    column is replaced by its value ``price_lag`` rows earlier, while both
    means still use the current values."""
    w = _spec(key, order)
    out = ts.select(
        "*",
        F.avg(value).over(w.rowsBetween(-n, 0)).alias("ma_short"),
        F.avg(value).over(w.rowsBetween(-2 * n, 0)).alias("ma_long"),
    )
    if price_lag is not None:
        out = out.withColumn(value, F.lag(value, price_lag).over(w))
    return out.withColumn("indicator", trend_label(F.col("ma_short"), F.col("ma_long")))


def trend_runs(
    ts: DataFrame,
    key: str,
    order: str,
    value: str,
    n: int,
    target_year: int,
    out_key: str | None = None,
    anchor: str = "lag",
    price_lag: int | None = None,
    warmup_years: int = 1,
    report_years: int = 3,
) -> DataFrame:
    """Up/down runs of a moving-average crossover per entity.

    Means are computed over ``[target_year - report_years - warmup_years + 1,
    target_year]`` and the series is then cut to the last ``report_years``
    years.  A run starts at a flip of the indicator and ends on the day before
    the next flip; the run before the first flip and the open run after the
    last flip are not reported.

    ``anchor='lag'`` reports ``(key, period, period_start_date,
    period_end_date, trend)``.  ``anchor='lead'`` reports the same runs
    anchored on their start and adds the start and end prices
    (``period_start_closing_price``, ``period_end_closing_price``) taken from
    ``value`` lagged by ``price_lag`` rows.

    Runs are numbered by a running count of the flips over the date order and
    rolled up by number: one shuffle by key, no join, no second scan.
    """
    first_year = target_year - report_years - warmup_years + 1
    report_from = target_year - report_years + 1
    series = ts.where(year_range(order, first_year, target_year))
    trends = with_trend(series, key, order, value, n, price_lag=price_lag).where(
        year_range(order, report_from, target_year)
    )
    return indicator_runs(trends, key, order, value, out_key=out_key, anchor=anchor)


def indicator_runs(
    trends: DataFrame,
    key: str,
    order: str,
    value: str | None = None,
    indicator: str = "indicator",
    out_key: str | None = None,
    anchor: str = "lag",
) -> DataFrame:
    """Runs of equal ``indicator`` values between two flips, per entity.

    See :func:`trend_runs` for the output; ``value`` is only needed for the
    prices of ``anchor='lead'``.
    """
    if anchor not in ("lag", "lead"):
        raise ValueError(f"anchor must be 'lag' or 'lead', not {anchor!r}")
    price = F.col(value) if value else F.lit(None).cast("double")
    days = trends.select(F.col(key), F.col(order).alias("_day"), F.col(indicator).alias("_state"), price.alias("_price"))
    by_day = _spec(key, "_day")
    turned = F.coalesce(F.col("_state") != F.lag("_state").over(by_day), F.lit(False))
    # a run's number is the number of turns so far; run 0 began before the series
    so_far = by_day.rowsBetween(Window.unboundedPreceding, 0)
    numbered = days.withColumn("_turned", turned).withColumn("_run", F.count_if("_turned").over(so_far))
    runs = numbered.groupBy(key, "_run").agg(
        F.min("_day").alias("_from"), F.max("_day").alias("_to"), F.min_by("_state", "_day").alias("_state"),
        F.min_by("_price", "_day").alias("_opened"), F.max_by("_price", "_day").alias("_closed"),
    )
    closed = runs.withColumn("_open_run", F.max("_run").over(Window.partitionBy(key))).where("_run > 0 AND _run < _open_run")
    prices = [F.col("_opened").alias("period_start_closing_price"), F.col("_closed").alias("period_end_closing_price")]
    return closed.select(
        F.col(key).alias(out_key or key),
        F.datediff("_to", "_from").alias("period"),
        F.col("_from").alias("period_start_date"),
        F.col("_to").alias("period_end_date"),
        F.col("_state").alias("trend"),
        *(prices if anchor == "lead" else []),
    )


def category_series(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    category: str,
    order: str,
    value: str,
    with_sum: bool = True,
) -> DataFrame:
    """Mean (and sum) of ``value`` per (category, day) over entities of each
    category; entities with a NULL category are left out.

    The fact side is pre-aggregated to (entity, day) before the join so the
    join and the final aggregation see one row per entity-day.
    """
    per_entity = fact.groupBy(fact_key, order).agg(
        F.sum(value).alias("_s"), F.count(value).alias("_n")
    )
    cats = dim.where(F.col(category).isNotNull()).select(
        F.col(dim_key).alias(fact_key), F.col(category)
    )
    joined = per_entity.join(cats, fact_key)
    aggs = [F.try_divide(F.sum("_s"), F.sum("_n")).alias("avg_close")]
    if with_sum:
        aggs.append(F.sum("_s").alias("sum_close"))
    return joined.groupBy(category, order).agg(*aggs)


def daily_metrics(
    bars: DataFrame,
    posts: DataFrame,
    bar_key: str = "h_code",
    bar_date: str = "h_date",
    post_key: str = "t_code",
    post_ts: str = "t_date",
    post_content: str = "t_content",
) -> DataFrame:
    """Per entity and day with posts: volume, % price change, % range and
    number of posts.  Only days that have posts are kept (inner join).

    Posts are counted per (entity, day) first; the join is then one-to-one on
    the composite key, so neither side can fan out.
    """
    daily_posts = posts.groupBy(
        F.col(post_key).alias("_pk"), F.to_date(post_ts).alias("_day")
    ).agg(F.count(post_content).alias("n_posts"))
    joined = bars.join(
        daily_posts,
        (F.col(bar_key) == F.col("_pk")) & (F.col(bar_date) == F.col("_day")),
    )
    return joined.select(
        F.col(bar_key).alias("stock"),
        F.col(bar_date).alias("trading_date"),
        F.col("h_volume").alias("volume"),
        pct_change("h_close", "h_open").alias("price_difference_percent"),
        (F.try_divide(F.col("h_high") - F.col("h_low"), F.col("h_close")) * F.lit(100.0)).alias(
            "price_fluctuation_percent"
        ),
        F.col("n_posts"),
    )


def grouped_corr(df: DataFrame, key: str, a: str, b: str, out: str | None = None) -> DataFrame:
    """Pearson correlation of ``a`` and ``b`` per ``key`` over rows where both
    are non-NULL.  A constant series or a single row gives NULL (``corr``
    would raise a division by zero under ANSI mode).

    Uses mergeable moments (``covar_pop``, ``stddev_pop``), so the group-by is
    a partial + final aggregation whatever the skew.
    """
    out = out or f"correlation_{a}_{b}"
    both = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return both.groupBy(key).agg(
        F.try_divide(
            F.covar_pop(a, b),
            F.stddev_pop(a) * F.stddev_pop(b),
        ).alias(out)
    )


def top_k_mean(
    fact: DataFrame,
    entities: DataFrame,
    categories: DataFrame,
    year: int,
    k: int = 100,
    fact_key: str = "h_code",
    fact_date: str = "h_date",
    value: str = "h_volume",
    entity_key: str = "p_code",
    entity_cat: str = "p_industry_id",
    cat_key: str = "id",
    cat_label: str = "industry",
    out: str = "avg_volume",
) -> DataFrame:
    """Top ``k`` entities by mean ``value`` in ``year`` with their category.

    The fact table is reduced to one (sum, count) row per entity before the
    joins, so the joins handle one row per entity instead of one per fact.
    Ties are broken by the entity key.
    """
    per_entity = (
        fact.where(year_range(fact_date, year, year))
        .groupBy(fact_key)
        .agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    )
    joined = per_entity.join(
        entities.select(F.col(entity_key).alias(fact_key), F.col(entity_cat).alias("_cat")), fact_key
    ).join(categories.select(F.col(cat_key).alias("_cat"), F.col(cat_label)), "_cat")
    grouped = joined.groupBy(F.col(fact_key).alias(entity_key), cat_label).agg(
        F.try_divide(F.sum("_s"), F.sum("_n")).alias(out)
    )
    return grouped.orderBy(F.col(out).desc(), F.col(entity_key)).limit(k).select(entity_key, out, cat_label)
