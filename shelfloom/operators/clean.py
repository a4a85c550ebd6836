"""Projections, filters, predicates and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfloom.functions.expr import clip, equal_width_bin, hash_uniform
from shelfloom.spec import SeriesSpec

#: Other names under which columns arrive.
ALIASES = {"dt": "hour_timestamp", "sale_amount": "sales_quantity", "PRODUCTID": "product_id", "STOREID": "store_id"}


def standardize_columns(df: DataFrame, upper: bool = False, renames: dict[str, str] | None = None) -> DataFrame:
    """Known aliases renamed, then all names in one case."""
    renames = ALIASES if renames is None else renames
    names = [renames.get(c, c) for c in df.columns]
    return df.toDF(*[n.upper() if upper else n.lower() for n in names])


def resolve_column(df: DataFrame, *candidates: str) -> str | None:
    """The first candidate that the table has, whatever its case."""
    by = {c.lower(): c for c in df.columns}
    return next((by[c.lower()] for c in candidates if c.lower() in by), None)


def select_by_keyword(df: DataFrame, keywords: list[str], keys: list[str] = ()) -> DataFrame:
    """Keys, and the numeric columns whose name holds a keyword."""
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    found = [c for c, t in df.dtypes if c not in keys and (t in numeric or t.startswith("decimal")) and any(k in c.lower() for k in keywords)]
    return df.select(*keys, *found)


def feature_list(df: DataFrame, spec: SeriesSpec) -> tuple[list[str], list[str]]:
    """(features, categorical ones) that the spec's capabilities allow and the table has."""
    wanted = [f"{spec.target}_lag_{k}" for k in spec.lags]
    wanted += [f"rolling_{s}_{n}" for n in spec.windows for s in ("mean", "std", "max", "min")]
    wanted += ["week_of_year", "month_proxy", "quarter", "week_sin", "week_cos"] if spec.unit == "week" else ["hour_of_day", "day_of_week", "is_weekend", "hour_sin", "hour_cos"]
    if spec.has_price:
        wanted += ["base_price", "total_discount", "discount_pct", "is_on_display", "is_on_mailer"]
    if spec.has_weather:
        wanted += ["temperature", "precipitation", "is_rainy", "temp_lag_24"]
    if spec.has_stockout:
        wanted += ["is_stockout", "stockout_streak", "latent_demand"]
    wanted += list(spec.categorical)
    have = set(df.columns)
    return [c for c in wanted if c in have], [c for c in spec.categorical if c in have]


def equal_width_category(df: DataFrame, column: str, names: list[str], out: str = "category") -> DataFrame:
    """P5: a numeric column cut into equal widths between its extremes."""
    ends = df.agg(F.min(column).cast("double").alias("__lo"), F.max(column).cast("double").alias("__hi"))
    bin_ = equal_width_bin(F.col(column).cast("double"), F.col("__lo"), F.col("__hi"), len(names))
    return df.crossJoin(F.broadcast(ends)).withColumn(out, F.element_at(F.array(*map(F.lit, names)), bin_ + 1)).drop("__lo", "__hi")


def tidy_metrics(df: DataFrame, id_column: str = "model", keep: str = "(?i)pinball|mae|rmse") -> DataFrame:
    """Wide metrics to rows (model, metric, value) of the error metrics."""
    values = [c for c in df.columns if c != id_column]
    return df.unpivot(id_column, values, "metric", "value").where(F.col("metric").rlike(keep))


def drop_negative(df: DataFrame, *columns: str) -> DataFrame:
    """F1."""
    for c in columns:
        df = df.where(F.col(c) >= 0)
    return df


def clip_weather(df: DataFrame) -> DataFrame:
    """physical limits, with the number of clipped values in a row."""
    t, h = F.col("temperature"), F.col("humidity")
    off = lambda c, lo, hi: F.coalesce((c < lo) | (c > hi), F.lit(False)).cast("int")
    return df.withColumns({"n_clipped": off(t, -20, 50) + off(h, 0, 100), "temperature": clip(t, -20.0, 50.0), "humidity": clip(h, 0.0, 100.0)})


def drop_zero_sales(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """only where no stockout data explain the zeros."""
    return df if spec.has_stockout else df.where(F.col(spec.target) > 0)


def drop_null_keys(df: DataFrame, *columns: str) -> DataFrame:
    """F4."""
    return df.dropna(subset=list(columns))


def limit_entities(df: DataFrame, column: str, n: int) -> DataFrame:
    """rows of the first n distinct values, in order."""
    return df.join(df.select(column).distinct().orderBy(column).limit(n), column, "left_semi")


def sample_fraction(df: DataFrame, fraction: float, keys: list[str] = (), seed: int = 42, draw: Column | None = None) -> DataFrame:
    """about that share of the rows, by a number in [0, 1) that is drawn from a hash of the keys (of all
    columns, if none are given), so the same rows in every run and under any partitioning."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be above 0 and at most 1")
    draw = draw if draw is not None else hash_uniform(*(keys or df.columns), seed=seed)
    return df if fraction == 1 else df.where(draw < fraction)


def sample_n(df: DataFrame, n: int, keys: list[str], order: Column | None = None, seed: int = 42) -> DataFrame:
    """n rows, chosen by a hash of the keys: the same rows in every run."""
    return df.orderBy(order if order is not None else F.xxhash64(*keys, F.lit(seed)), *keys).limit(n)


def stratified_sample(df: DataFrame, stratum: Column, n: int, keys: list[str], order: Column | None = None) -> DataFrame:
    """F8: at most n rows of each stratum."""
    w = Window.partitionBy(stratum).orderBy(order if order is not None else F.xxhash64(*keys), *keys)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def split_time(df: DataFrame, time: str, q: float = 0.8) -> float | None:
    """The q quantile of time, as a number (microseconds of a timestamp); None without rows."""
    times = df.groupBy(_number(df, time).alias("t")).agg(F.count("*").alias("n"))
    # Times repeat: the quantile is taken over the distinct ones and their counts.
    return times.agg(F.percentile("t", q, F.col("n"))).first()[0]


def _number(df: DataFrame, time: str) -> Column:
    return F.unix_micros(F.col(time)) if dict(df.dtypes)[time] == "timestamp" else F.col(time)


def is_newer(df: DataFrame, time: str, q: float = 0.8) -> Column:
    """Whether a row is at or after the q quantile of time."""
    cut = split_time(df, time, q)
    return F.lit(False) if cut is None else _number(df, time) >= cut


def time_split(df: DataFrame, time: str, q: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(rows before the q quantile of time, rows from it on); rows without a time are in neither."""
    cut = split_time(df, time, q)
    if cut is None:
        return df, df.limit(0)
    return df.where(_number(df, time) < cut), df.where(_number(df, time) >= cut)


def last_periods(df: DataFrame, period: str, n: int = 30) -> DataFrame:
    """rows of the last n distinct periods."""
    return df.join(df.select(period).distinct().orderBy(F.desc(period)).limit(n), period, "left_semi")


def active_recommendations(df: DataFrame, n: int = 50) -> DataFrame:
    """F11."""
    return df.where("should_apply").orderBy("product_id").limit(n)


def priority_reorders(df: DataFrame, risk: float = 0.1) -> DataFrame:
    """what must be ordered or may run out, riskiest first, by the unclipped risk where there is one."""
    c = "stockout_risk_raw" if "stockout_risk_raw" in df.columns else "stockout_risk"
    return df.where(F.col("should_reorder") | (F.col(c) > risk)).orderBy(F.desc(c), "product_id")


def null_fill(df: DataFrame, measures: list[str] = (), categories: list[str] = (), flags: list[str] = ()) -> DataFrame:
    """F13."""
    return df.fillna({**dict.fromkeys([*measures, *flags], 0), **dict.fromkeys(categories, "Unknown")})


def series_filter(df: DataFrame, keys: dict, time: str, periods: list) -> DataFrame:
    """one series at the given periods, in order."""
    for c, v in keys.items():
        df = df.where(F.col(c) == v)
    return df.where(F.col(time).isin(periods)).orderBy(time)


def topk(df: DataFrame, column: str, k: int, *ties: str) -> DataFrame:
    """T2."""
    return df.orderBy(F.desc(column), *ties).limit(k)


def head_per_series(df: DataFrame, keys: list[str], time: str, n: int = 30) -> DataFrame:
    """T3."""
    w = Window.partitionBy(*keys).orderBy(time)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def most_frequent(df: DataFrame, column: str, n: int = 3) -> DataFrame:
    """T4."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(n)


def latest(df: DataFrame, time: str, n: int = 10, *ties: str) -> DataFrame:
    """T5."""
    return df.orderBy(F.desc(time), *ties).limit(n)


def union_all(*tables: DataFrame) -> DataFrame:
    """By name; columns that a table lacks are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """U2."""
    return df.select(*keys).distinct()
