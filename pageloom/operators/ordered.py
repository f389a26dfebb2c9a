"""Operators on rows in order. Every one needs an order without ties; none gathers a group in one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from pageloom.functions import dates
from pageloom.operators import scan


def _before(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, -1)


def segments(rows: DataFrame, group: str, order: str, header: Column, text: str) -> DataFrame:
    """group, seq, start, n_rows, n_chars, body: one row for each stretch from a header row to the next; rows before the first header are of none."""
    marks = rows.select(group, order, header.cast("long").alias("_h"))
    places = scan.scanned(marks, group, [order], seq=scan.running_sum(F.col("_h"))).filter("seq > 0").select(F.col(group).alias("_g"), F.col(order).alias("_o"), "seq")
    numbered = rows.join(places, F.col(group).eqNullSafe(F.col("_g")) & (F.col(order) == F.col("_o"))).drop("_g", "_o")
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return numbered.groupBy(group, "seq").agg(F.min(order).alias("start"), F.count("*").alias("n_rows"), F.array_join(F.transform(parts, lambda x: x["t"]), "\n\n").alias("body")).withColumn("n_chars", F.length("body"))


def with_valid_neighbours(rows: DataFrame, value: str, group: str, order: str, n: int = 2, to: str = "neighbours") -> DataFrame:
    """Adds an array of up to n nearest non-null values before (nearest first), then after."""
    return scan.neighbours(rows, value, group, order, n).withColumn(to, F.concat("_before", "_after")).drop("_before", "_after")


def interval_of(before: Column, after: Column, start: Column, end: Column) -> Column:
    """(start, end): the values before and after, the span's edges where there are none, in order."""
    a, b = F.coalesce(before, start), F.coalesce(after, end)
    return F.struct(F.least(a, b).alias("start"), F.greatest(a, b).alias("end"))


def with_interval(rows: DataFrame, value: str, start: Column, end: Column, group: str, order: str, to: str = "interval") -> DataFrame:
    """Adds (start, end): the nearest valid values before and after a row, the span's edges where there are none."""
    found = scan.scanned(rows, group, [order], _p=scan.last_value(F.col(value), own=False), _n=scan.next_value(F.col(value)))
    return found.withColumn(to, interval_of(F.col("_p"), F.col("_n"), start, end)).drop("_p", "_n")


def repair_years(rows: DataFrame, spans: DataFrame, tolerance: int = 1, max_digits: int = 2, kinds: tuple[str, ...] = ("field-day", "correspondence", "other", "species-digest", "retrospective")) -> DataFrame:
    """Routes dated rows outside their volume's span: repaired, excluded, positional or flagged.

    rows: volume, ord, entry_date (ISO or null), kind, verbatim, historic (its own
    records point before the diaries). spans: volume, start, end (YYYY-MM). Adds
    new_date, new_end, reason (null inside). Neighbours are the rows inside, as
    they stand: a repair changes nobody's neighbours.
    """
    edges = spans.agg(F.min("start").alias("_first"), F.max("end").alias("_last"))
    edge = edges.first()  # one row
    rows = rows.join(spans, "volume", "left").withColumns({"_first": F.lit(edge["_first"]).cast("string"), "_last": F.lit(edge["_last"]).cast("string")})
    ym = F.substring("entry_date", 1, 7)
    known = F.col("start").isNotNull() & F.col("entry_date").isNotNull()
    inside = known & dates.in_span(ym, F.col("start"), F.col("end"), tolerance)
    rows = rows.withColumn("_inside", F.when(inside, F.col("entry_date")))
    rows = scan.neighbours(rows, "_inside", "volume", "ord", 2).withColumn("_near", F.concat("_before", "_after"))
    years = F.transform("_near", lambda d: F.substring(d, 1, 4))
    # the commonest year, the first seen of equals
    votes = lambda y: F.size(F.filter(years, lambda x: x == y))
    top = F.array_max(F.transform(years, votes))
    year = F.element_at(F.filter(years, lambda y: votes(y) == top), 1)
    rows = rows.withColumn("_year", F.when(F.size("_near") > 0, year)).withColumn("_votes", top)
    before = ym < F.col("_first")
    outside = before | (dates.month_index(ym) > dates.month_index(F.col("_last")) + tolerance)
    record = before & F.col("kind").isin("species-digest", "retrospective") & F.col("historic")
    token = dates.year_token(F.col("verbatim"))
    digits = F.coalesce(F.length(token) < 4, F.lit(False)) | (dates.digit_distance(F.substring("entry_date", 1, 4), F.col("_year")) <= max_digits)
    new = F.concat("_year", F.substring("entry_date", 5, 6))
    fits = F.try_to_date(new, "yyyy-MM-dd").isNotNull() & dates.in_span(F.substring(new, 1, 7), F.col("start"), F.col("end"), tolerance)
    near = F.forall("_near", lambda d: dates.months_between(new, d) <= 3)
    fixed = F.col("kind").isin(*kinds) & ~record & (F.size("_near") > 0) & (F.col("_votes") >= F.least(F.lit(2), F.size("_near"))) & digits & fits & near
    last = F.date_format(F.last_day(F.try_to_date(F.concat("end", F.lit("-01")), "yyyy-MM-dd")), "yyyy-MM-dd")
    rows = rows.withColumn("_place", interval_of(F.get("_before", F.lit(0)), F.get("_after", F.lit(0)), F.concat("start", F.lit("-01")), last))
    reason = (
        F.when(~known | inside, F.lit(None).cast("string"))
        .when(F.coalesce(fixed, F.lit(False)), "date_year_corrected")
        .when(outside & (F.col("kind") == "other"), "date_out_of_span")
        .when(outside, "date_from_position")
        .otherwise("date_out_of_coverage")
    )
    rows = rows.withColumn("reason", reason)
    moved = F.col("reason") == "date_from_position"
    return rows.select(
        "*",
        F.when(F.col("reason") == "date_year_corrected", new).when(moved, F.col("_place.start")).otherwise(F.col("entry_date")).alias("new_date"),
        F.when(moved & (F.col("_place.end") != F.col("_place.start")), F.col("_place.end")).alias("new_end"),
    ).drop("_first", "_last", "_inside", "_near", "_before", "_after", "_year", "_votes", "_place")


def travel_departures(legs: DataFrame, event: str = "event", order: str = "pos") -> DataFrame:
    """Departures filled from the arrival before, else from the entry's place; legs without both ends are dropped.

    legs: event, pos, departure, arrival, entry_place. A leg with an arrival
    survives from the event's first leg on that has both ends, stated or given
    by the place; the last surviving arrival is the next departure.
    """
    w = Window.partitionBy(event).orderBy(order)
    both = F.col("arrival").isNotNull() & (F.col("departure").isNotNull() | F.col("entry_place").isNotNull())
    alive = F.col("arrival").isNotNull() & F.max(both).over(w.rowsBetween(Window.unboundedPreceding, 0))
    legs = legs.withColumn("_alive", alive)
    last = F.last(F.when(F.col("_alive"), F.col("arrival")), ignorenulls=True).over(_before(w))
    return legs.withColumn("departure", F.coalesce("departure", last, "entry_place")).filter("_alive").drop("_alive")


def running_index(rows: DataFrame, group: list[str], order: str, to: str = "index") -> DataFrame:
    return rows.withColumn(to, F.row_number().over(Window.partitionBy(*group).orderBy(order)) - 1)


def first_wins(rows: DataFrame, group: list[str], order: str) -> DataFrame:
    return running_index(rows, group, order, "_i").filter("_i = 0").drop("_i")


def dominant(rows: DataFrame, group: str, member: str, uses: str, least: int = 5, ratio: float = 5.0) -> DataFrame:
    """Of each group the member whose uses are enough and so many times the next one's."""
    w = Window.partitionBy(group).orderBy(F.desc(uses), member)
    ranked = rows.select(group, member, uses, F.row_number().over(w).alias("_r"), F.lead(uses, 1, 0).over(w).alias("_next"))
    return ranked.filter((F.col("_r") == 1) & (F.col(uses) >= least) & (F.col(uses) >= ratio * F.greatest(F.col("_next"), F.lit(1)))).select(group, member, uses)
