"""Column clean-up, missing values, outlier trimming and derived features."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from engage.functions import haversine_miles, is_blank
from engage.operators.ranking import ACCURACY, quantile_values

# Name parts of columns kept out of the feature table.
PRIVATE_PATTERNS = (
    "HASH",
    "ID",
    "DT",
    "DATE",
    "NAME",
    "PHONE",
    "EMAIL",
    "ADDRESS",
    "ADDR",
    "FIPS",
    "TRACTCODE",
    "CENSUS",
    "HOME",
    "MAILING",
    "ZIP",
    "LATITUDE",
    "LONGITUDE",
    "CITY",
    "PRIMARY",
    "SECONDARY",
    "PROV",
)


def column_types(df: DataFrame) -> tuple[list[str], list[str]]:
    """(numeric, text) column names; every numeric type counts, long and short included."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return numeric, text


def drop_matching(
    df: DataFrame, patterns: Sequence[str] = PRIVATE_PATTERNS, also: Sequence[str] = ()
) -> DataFrame:
    """Drop columns whose name holds one of the patterns (case-sensitive) or is listed."""
    return df.select(*[c for c in df.columns if c not in also and not any(p in c for p in patterns)])


def drop_duplicate_columns(df: DataFrame, keep: str = "first") -> DataFrame:
    """Resolve repeated column names: keep the first copy, or with ``keep='none'`` drop every copy."""
    if keep not in ("first", "none"):
        raise ValueError("keep is first or none")
    seen = Counter(df.columns)
    marks, wanted, used = [], [], set()
    for position, name in enumerate(df.columns):
        marks.append(f"_{position}")
        if seen[name] == 1 or (keep == "first" and name not in used):
            wanted.append((position, name))
        used.add(name)
    renamed = df.toDF(*marks)
    return renamed.select(*[F.col(f"_{p}").alias(n) for p, n in wanted])


def decimals_to_double(df: DataFrame) -> DataFrame:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({n: F.col(n).cast("double") for n in names}) if names else df


def fill_constant(df: DataFrame, numeric: float = -1, text: str = "missing") -> DataFrame:
    """Constant for NULL and NaN numbers, and for NULL text."""
    numbers, strings = column_types(df)
    return df.fillna(numeric, subset=numbers).fillna(text, subset=strings)


def fill_blank(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Default where a column is NULL or, for text, empty after trimming."""
    changes = {}
    for name, value in defaults.items():
        kind = df.schema[name].dataType
        empty = is_blank(name) if isinstance(kind, T.StringType) else F.col(name).isNull()
        changes[name] = F.when(empty, F.lit(value).cast(kind)).otherwise(F.col(name))
    return df.withColumns(changes)


def non_null_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Non-null, non-NaN values per column, in one pass over all columns: rows (column, n)."""
    names = list(cols) if cols is not None else column_types(df)[0]

    def present(name: str) -> Column:
        here = F.col(name).isNotNull()
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            here = here & ~F.isnan(name)
        return F.count_if(here)

    return df.agg(*[present(n).alias(n) for n in names]).unpivot([], names, "column", "n")


def drop_empty_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop the columns that hold nothing; the column list, not the data, comes to the driver."""
    empty = {r["column"] for r in non_null_columns(df, cols).where("n = 0").collect()}
    return df.select(*[c for c in df.columns if c not in empty])


def impute_median(df: DataFrame, cols: Sequence[str], accuracy: int = ACCURACY) -> DataFrame:
    """Replace NULL and NaN by the column's median element; all medians come from the same three passes."""
    medians = quantile_values(df, cols, [0.5], "disc", accuracy)
    changes = {}
    for name in cols:
        value = F.col(name)
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            value = F.nanvl(value, F.lit(None).cast("double"))
        median = F.lit(medians[name][0.5]).cast("double")
        changes[name] = F.coalesce(value, median).cast(df.schema[name].dataType)
    return df.withColumns(changes)


def quantile(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """Exact element quantiles, rows (column, prob, value)."""
    found = quantile_values(df, cols, probs, "disc", accuracy)
    rows = [(c, float(p), v) for c, per_prob in found.items() for p, v in per_prob.items() if v is not None]
    return df.sparkSession.createDataFrame(rows, "column string, prob double, value double")


def approx_quantile(df: DataFrame, cols: Sequence[str], probs: Sequence[float], error: float = 0.01) -> DataFrame:
    """Sketched quantiles in one pass, rank error at most ``error``."""
    accuracy = round(1 / error)
    sketched = df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(c) for c in cols]
    ).unpivot([], list(cols), "column", "values")
    keyed = sketched.select("column", F.arrays_zip(F.array(*[F.lit(p) for p in probs]).alias("prob"), "values"))
    return keyed.toDF("column", "z").select("column", F.inline("z").alias("prob", "value"))


def describe(df: DataFrame, cols: Sequence[str], accuracy: int = ACCURACY) -> DataFrame:
    """Per column count, mean, standard deviation, min, quartiles and max."""
    quartiles = quantile_values(df, cols, [0.25, 0.5, 0.75], "disc", accuracy)
    rows = []
    for c in cols:
        value = F.col(c).cast("double")
        facts = {
            "column": F.lit(c),
            "n": F.count(value),
            "mean": F.avg(value),
            "stddev": F.stddev_samp(value),
            "min": F.min(value),
            "p25": F.lit(quartiles[c][0.25]).cast("double"),
            "p50": F.lit(quartiles[c][0.5]).cast("double"),
            "p75": F.lit(quartiles[c][0.75]).cast("double"),
            "max": F.max(value),
        }
        rows.append(F.struct(*[f.alias(n) for n, f in facts.items()]))
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def trim_quantiles(
    df: DataFrame, col: str, low: float = 0.01, high: float = 0.95, accuracy: int = ACCURACY
) -> DataFrame:
    """Keep rows between two quantiles, ends included; NULLs drop out."""
    ends = quantile_values(df, [col], [low, high], "disc", accuracy)[col]
    return df.where(F.col(col).between(F.lit(ends[low]).cast("double"), F.lit(ends[high]).cast("double")))


def tenure(
    df: DataFrame,
    first: str = "first_elig_month_start_dt",
    last: str = "last_elig_month_end_dt",
    name: str = "tenure",
) -> DataFrame:
    """Days between two dates; text that is no date gives NULL."""

    def day(c: str) -> Column:
        return F.try_to_date(c) if isinstance(df.schema[c].dataType, T.StringType) else F.to_date(c)

    return df.withColumn(name, F.datediff(day(last), day(first)))


def distance_feature(
    df: DataFrame,
    flag: str = "provider_flag",
    coordinates: Sequence[str] = ("latitude", "longitude", "home_latitude", "home_longitude"),
    name: str = "pcp_distance",
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Miles between two places for flagged rows; the flagged rows' median for the others."""
    miles = haversine_miles(*[F.col(c) for c in coordinates])
    flagged = df.where(F.col(flag) == 1).select(miles.alias("miles"))
    median = quantile_values(flagged, ["miles"], [0.5], "disc", accuracy)["miles"][0.5]
    return df.withColumn(name, F.when(F.col(flag) == 1, miles).otherwise(F.lit(median).cast("double")))
