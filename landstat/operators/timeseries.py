"""Per-pixel series: arrays of timesteps of bands, as column expressions and as long tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAYS_A_MONTH = 30.436875
EO_TYPE = "array<array<double>>"


def parse_eo(text: Column) -> Column:
    """A nested list in text form as an array; null if it is not one."""
    return F.from_json(text, EO_TYPE)


def format_eo(eo: Column) -> Column:
    return F.to_json(eo)


def first_months(eo: Column, n: int) -> Column:
    return F.slice(eo, 1, n)


def last_months(eo: Column, n: int) -> Column:
    """The last n timesteps, or all of a shorter series."""
    return F.slice(eo, F.greatest(F.lit(1), F.size(eo) - n + 1), F.lit(n))


def scale_bands(eo: Column, add: Sequence[float], div: Sequence[float], keep: Sequence[int] | None = None) -> Column:
    """Each band plus its shift, over its divisor; then only the bands of ``keep``."""
    out = F.transform(eo, lambda t: F.transform(t, lambda v, i: (v + F.element_at(F.array(*map(F.lit, map(float, add))), i + 1)) / F.element_at(F.array(*map(F.lit, map(float, div))), i + 1)))
    return out if keep is None else select_bands(out, keep)


def select_bands(eo: Column, bands: Sequence[int]) -> Column:
    return F.transform(eo, lambda t: F.array(*[F.get(t, F.lit(b)) for b in bands]))


def with_ndvi(eo: Column, nir: int, red: int) -> Column:
    """Each timestep with (nir - red) / (nir + red) appended, 0 where the sum is 0."""
    n, r = lambda t: F.get(t, F.lit(nir)), lambda t: F.get(t, F.lit(red))
    return F.transform(eo, lambda t: F.concat(t, F.array(F.coalesce(F.try_divide(n(t) - r(t), n(t) + r(t)), F.lit(0.0)))))


def vegetation_indices(eo: Column, b2: int, b3: int, b4: int, b8: int, b11: int) -> Column:
    """NDVI, GNDVI, EVI, CVI (as b8 - (b3 - 1)) and BSI of each timestep; null where a denominator is 0."""
    g = lambda t, k: F.get(t, F.lit(k))
    d = F.try_divide
    return F.transform(
        eo,
        lambda t: F.struct(
            d(g(t, b8) - g(t, b4), g(t, b8) + g(t, b4)).alias("ndvi"),
            d(g(t, b8) - g(t, b3), g(t, b8) + g(t, b3)).alias("gndvi"),
            d(2.5 * (g(t, b8) - g(t, b4)), g(t, b8) + 6 * g(t, b4) - 7.5 * g(t, b2) + 1).alias("evi"),
            (g(t, b8) - (g(t, b3) - 1)).alias("cvi"),
            d(g(t, b11) + g(t, b4) - g(t, b8) - g(t, b2), g(t, b11) + g(t, b4) + g(t, b8) + g(t, b2)).alias("bsi"),
        ),
    )


def flatten_eo(eo: Column) -> Column:
    return F.flatten(eo)


def feature_concat(*parts: Column) -> Column:
    return F.concat(*parts)


def band_means(eo: Column) -> Column:
    """The mean of each band over the timesteps."""
    return F.transform(F.get(eo, F.lit(0)), lambda _, i: F.aggregate(eo, F.lit(0.0), lambda a, t: a + F.get(t, i)) / F.size(eo))


def band_stds(eo: Column) -> Column:
    """The population standard deviation of each band over the timesteps."""
    mean = lambda i: F.aggregate(eo, F.lit(0.0), lambda a, t: a + F.get(t, i)) / F.size(eo)
    square = lambda i: F.aggregate(eo, F.lit(0.0), lambda a, t: a + F.get(t, i) * F.get(t, i)) / F.size(eo)
    return F.transform(F.get(eo, F.lit(0)), lambda _, i: F.sqrt(F.greatest(F.lit(0.0), square(i) - mean(i) * mean(i))))


def pad_months(eo: Column, n: int, bands: int) -> Column:
    """A series with null timesteps up to ``n``."""
    missing = F.array_repeat(F.array_repeat(F.lit(None).cast("double"), bands), F.greatest(F.lit(0), F.lit(n) - F.size(eo)))
    return F.concat(eo, missing)


def month_sin_cos(month: Column) -> Column:
    """A month (0 to 11) on the unit circle."""
    a = month * (2 * math.pi / 12)
    return F.struct(F.sin(a).alias("sin"), F.cos(a).alias("cos"))


def month_seq(start: Column, n: int) -> Column:
    """``n`` month numbers from ``start``, modulo 12."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.pmod(start + i, F.lit(12)))


def num_timesteps(start: Column, end: Column, start_month: int, months: int) -> Column:
    """Timesteps of a window that opens in ``start_month`` of the start's year and is ``months`` long at most, rounded half to even."""
    opened = F.make_date(F.year(start), F.lit(start_month), F.lit(1))
    closed = F.least(end, F.add_months(opened, months))
    return F.bround(F.datediff(closed, opened) / F.lit(DAYS_A_MONTH), 0).cast("int")


def is_clear(qa: Column, cloud_bit: int = 10, cirrus_bit: int = 11) -> Column:
    """Neither the cloud nor the cirrus bit is set."""
    return qa.bitwiseAND(F.lit((1 << cloud_bit) | (1 << cirrus_bit))) == 0


def min_max(c: str, by: Sequence[str] = ()) -> Column:
    """A column between 0 and 1 in its group, nulls as the smallest; null for a group with one value."""
    w = Window.partitionBy(*by)
    low, high = F.min(c).over(w), F.max(c).over(w)
    return F.try_divide(F.coalesce(F.col(c), low) - low, high - low)


def band_stats(long: DataFrame) -> DataFrame:
    """(band, mean, std, n) over all instances and timesteps, sample deviation, one pass."""
    return long.groupBy("band").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.count("value").alias("n"))


def stats_arrays(stats: DataFrame) -> DataFrame:
    """One row: means and deviations as arrays in band order."""
    ordered = stats.agg(F.array_sort(F.collect_list(F.struct("band", "mean", "std"))).alias("s"))  # one entry a band
    return ordered.select(F.transform("s", lambda x: x["mean"]).alias("means"), F.transform("s", lambda x: x["std"]).alias("stds"))


def normalize(df: DataFrame, stats: DataFrame, eo: str = "eo") -> DataFrame:
    """Series as z-scores by band statistics; 0 for a band without spread."""
    both = df.join(F.broadcast(stats_arrays(stats)), F.lit(True))  # one row
    z = F.transform(eo, lambda t: F.transform(t, lambda v, i: F.coalesce(F.try_divide(v - F.get("means", i), F.get("stds", i)), F.lit(0.0))))
    return both.withColumn(eo, z).drop("means", "stds")


def profile(long: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean and population deviation of a value by group, timestep and band."""
    return long.groupBy(*by, "t", "band").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def sample_features(points: DataFrame, image: DataFrame, bands: Sequence[int], key: str = "id") -> DataFrame:
    """A feature column for each band; points with a missing band go."""
    wide = image.groupBy(key).pivot("band", list(bands)).agg(F.first("value"))
    named = wide.select(key, *[F.col(str(b)).alias(f"b{b}") for b in bands])
    return points.join(named, key).dropna(subset=[f"b{b}" for b in bands])


def assemble(df: DataFrame, long: DataFrame, months: int, bands: int, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """A training table from (id, is_crop, eo): timesteps, local flag, normalised and padded series, and a weight that balances classes."""
    out = normalize(df.withColumn("timesteps", F.size("eo")), band_stats(long))
    if box is not None:
        from landstat.operators.labels import with_is_local

        out = with_is_local(out, box)
    share = df.agg(F.avg("is_crop").alias("_share"))
    out = out.join(F.broadcast(share), F.lit(True))
    weight = F.when(F.col("is_crop") == 1, F.try_divide(F.lit(0.5), F.col("_share"))).otherwise(F.try_divide(F.lit(0.5), 1 - F.col("_share")))
    return out.withColumns({"weight": weight, "eo": pad_months(F.col("eo"), months, bands)}).drop("_share")
