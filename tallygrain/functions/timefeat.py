"""Date and time features as plain column expressions (UTC)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
DEFAULT_CYCLIC = ("month", "day", "hour", "minute", "dayofweek", "dayofyear", "weekofyear")


def micros(ts: Column) -> Column:
    """Microseconds since the epoch, for zoned and zone-less timestamps."""
    return F.unix_micros(ts.cast("timestamp"))


def floor_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour periods between two instants, rounded down (not calendar days)."""
    return F.floor((micros(later) - micros(earlier)) / F.lit(MICROS_PER_DAY)).cast("long")


def weekday(ts: Column) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return F.coalesce(F.weekday(ts).isin(5, 6), F.lit(False)).cast("int")


def add_activity_columns(df: DataFrame, time: str) -> DataFrame:
    """Month, year, weekday and hour columns of the customer path."""
    ts = F.col(time)
    return df.withColumns(
        {
            "TransactionMonth": F.date_format(ts, "yyyy-MM"),
            "TransactionYear": F.year(ts),
            "DayOfWeek": weekday(ts),
            "HourOfDay": F.hour(ts),
        }
    )


def add_calendar_columns(df: DataFrame, time: str, prefix: str = "transaction") -> DataFrame:
    """Date, hour and calendar fields of the transaction path."""
    ts = F.col(time)
    return df.withColumns(
        {
            f"{prefix}_date": F.to_date(ts),
            f"{prefix}_hour": F.hour(ts),
            f"{prefix}_day_of_week": weekday(ts),
            f"{prefix}_day_of_month": F.dayofmonth(ts),
            f"{prefix}_month": F.month(ts),
            f"{prefix}_year": F.year(ts),
        }
    )


def add_preparation_columns(df: DataFrame, time: str) -> DataFrame:
    ts = F.col(time)
    return df.withColumns(
        {
            "TransactionHour": F.hour(ts),
            "TransactionDayOfWeek": weekday(ts),
            "TransactionDayOfMonth": F.dayofmonth(ts),
            "TransactionMonth": F.month(ts),
        }
    )


def add_time_parts(df: DataFrame, time: str, prefix: str | None = None) -> DataFrame:
    """Nine calendar fields named ``<prefix>_<field>``."""
    p = time if prefix is None else prefix
    ts = F.col(time)
    return df.withColumns(
        {
            f"{p}_year": F.year(ts),
            f"{p}_month": F.month(ts),
            f"{p}_day": F.dayofmonth(ts),
            f"{p}_hour": F.hour(ts),
            f"{p}_minute": F.minute(ts),
            f"{p}_dayofweek": weekday(ts),
            f"{p}_dayofyear": F.dayofyear(ts),
            f"{p}_weekofyear": F.weekofyear(ts),
            f"{p}_is_weekend": is_weekend(ts),
        }
    )


def add_cyclical_by_max(df: DataFrame, time: str, prefix: str | None = None) -> DataFrame:
    """Calendar fields plus sine and cosine with the observed maximum as period.

    The seven maxima come from one aggregate; a maximum of 0 gives NULL.
    """
    p = time if prefix is None else prefix
    parts = add_time_parts(df, time, p)
    names = [f"{p}_{f}" for f in DEFAULT_CYCLIC]
    peak = add_time_parts(df.select(time), time, p).agg(*[F.max(n).alias(n) for n in names]).first()
    columns = {}
    for n in names:
        period = peak[n] or None
        angle = F.lit(None).cast("double") if period is None else 2 * F.pi() * F.col(n) / F.lit(float(period))
        columns[f"{n}_sin"] = F.sin(angle)
        columns[f"{n}_cos"] = F.cos(angle)
    return parts.withColumns(columns)


# Cycle lengths and clock ranges of the transaction time features.
FIXED_PERIODS = {"hour": 24, "day_of_week": 7, "day_of_month": 30, "month": 12}
BUSINESS_HOURS = (9, 17)
NIGHT_FROM, NIGHT_TO = 22, 6
MORNING_RUSH = (7, 10)
EVENING_RUSH = (16, 19)

TIME_FEATURES = [
    *[f"{field}_{wave}" for field in FIXED_PERIODS for wave in ("sin", "cos")],
    "is_weekend",
    "is_business_hours",
    "is_night",
    "is_morning_rush",
    "is_evening_rush",
    "season",
]


def _within(hour: Column, span: tuple[int, int]) -> Column:
    return F.coalesce((hour >= span[0]) & (hour < span[1]), F.lit(False)).cast("int")


def season(ts: Column) -> Column:
    """1 winter, 2 spring, 3 summer, 4 autumn."""
    return F.floor((F.month(ts) % 12 + 3) / 3).cast("int")


def time_feature_columns(time: str) -> dict[str, Column]:
    """The 14 transaction time features."""
    ts = F.col(time)
    field = {
        "hour": F.hour(ts),
        "day_of_week": weekday(ts),
        "day_of_month": F.dayofmonth(ts),
        "month": F.month(ts),
    }
    out: dict[str, Column] = {}
    for name, period in FIXED_PERIODS.items():
        angle = 2 * F.pi() * field[name] / period
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.cos(angle)
    hour = field["hour"]
    out["is_weekend"] = is_weekend(ts)
    out["is_business_hours"] = _within(hour, BUSINESS_HOURS)
    out["is_night"] = F.coalesce((hour >= NIGHT_FROM) | (hour < NIGHT_TO), F.lit(False)).cast("int")
    out["is_morning_rush"] = _within(hour, MORNING_RUSH)
    out["is_evening_rush"] = _within(hour, EVENING_RUSH)
    out["season"] = season(ts)
    return out


def add_time_features(df: DataFrame, time: str) -> DataFrame:
    return df.withColumns(time_feature_columns(time))
