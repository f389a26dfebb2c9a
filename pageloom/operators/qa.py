"""Quality flags of entries and observations, and what is left."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.operators.aggregates import upper_median
from pageloom.operators.graph import settled


def usable(observations: DataFrame, least: float = 0.3) -> DataFrame:
    """Observations of birds whose taxon is named, ranked or not held in doubt."""
    return observations.filter(~(_non_bird() | _doubtful(least)))


def _non_bird() -> Column:
    return F.coalesce(~F.col("is_bird"), F.lit(False))


def _doubtful(least: float) -> Column:
    return ~_non_bird() & F.col("family").isNull() & F.coalesce(F.col("confidence") < least, F.lit(False))


def qa_flags(entries: DataFrame, observations: DataFrame, tolerance: int = 2, least: float = 0.3) -> DataFrame:
    """entry_uid, reason, action, value: a row for each breach.

    entries: entry_uid, volume, entry_date, header_date, plausible, place,
    location_raw, explained (weather or travel). observations: entry_uid, taxon,
    family, is_bird, confidence, conflict. Entries without observations are told
    after the excluded observations are gone.
    """
    # both are read several times, and made once
    entries = settled(entries.select("entry_uid", "volume", "entry_date", "header_date", "plausible", "place", "location_raw", "explained"))
    observations = settled(observations.select("entry_uid", "taxon", "family", "is_bird", "confidence", "conflict"))
    dated = entries.filter("entry_date is not null").select("volume", F.substring("entry_date", 1, 4).cast("int").alias("year"))
    rows = entries.join(upper_median(dated, "volume", "year"), "volume", "left")
    left = usable(observations, least).groupBy("entry_uid").agg(F.count("*").alias("_n"))
    rows = rows.join(left, "entry_uid", "left")
    year = F.substring("entry_date", 1, 4).cast("int")
    raw = F.trim(F.coalesce("location_raw", F.lit("")))
    tests = [
        ("implausible_date", "excluded", ~F.col("plausible"), F.col("entry_date")),
        ("date_corrected", "flagged", F.coalesce(F.col("plausible"), F.lit(True)) & (F.col("header_date") != F.col("entry_date")), F.col("entry_date")),
        ("misdate", "flagged", F.abs(year - F.col("median")) > tolerance, F.col("entry_date")),
        ("nonplace", "flagged", F.col("place").isNull() & (raw != ""), raw),
        ("no_observations", "flagged", F.col("_n").isNull() & F.col("explained"), F.lit("")),
        ("empty", "flagged", F.col("_n").isNull() & ~F.col("explained"), F.lit("")),
    ]
    seen = observations.join(entries.select("entry_uid"), "entry_uid")
    doubts = [
        ("non_bird", "excluded", _non_bird(), F.col("taxon")), ("low_confidence_taxon", "excluded", _doubtful(least), F.col("taxon")),
        ("record_type_conflict", "flagged", F.col("conflict") & ~_non_bird() & ~_doubtful(least), F.col("taxon")),
    ]
    return reduce(DataFrame.union, [_explode(rows, tests), _explode(seen, doubts)])


def _explode(rows: DataFrame, tests: list) -> DataFrame:
    found = F.array(*[F.when(test, F.struct(F.lit(r).alias("reason"), F.lit(a).alias("action"), F.coalesce(v, F.lit("")).alias("value"))) for r, a, test, v in tests])
    return rows.select("entry_uid", F.explode(F.filter(found, lambda f: f.isNotNull())).alias("f")).select("entry_uid", "f.*")


def surviving(entries: DataFrame, flags: DataFrame) -> DataFrame:
    """Entries without a flag of their own that excludes them."""
    gone = flags.filter("action = 'excluded' and reason in ('implausible_date', 'misdate', 'date_out_of_span', 'duplicate_entry')").select("entry_uid").distinct()
    return entries.join(gone, "entry_uid", "left_anti")
