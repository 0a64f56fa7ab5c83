"""Request plans as tables: even chunks, years, parameter groups, budgets, retries, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from croplake.catalog import DAILY_WEATHER_TYPES
from croplake.functions import timeops as t
from croplake.operators.ranking import numbered
from croplake.session import cut_lineage

#: fixed values: limits and sizes of requests, and which parameters go together
MAX_PARAMETERS = 10
DAILY_LIMIT = 2500
PARAMETERS = tuple(w[0] for w in DAILY_WEATHER_TYPES)
PARAMETER_SETS = (PARAMETERS[:6], PARAMETERS[6:])
CELLS_PER_UPDATE = (1000, 1000)
CELLS_PER_ADD = (100, 100)
CELLS_PER_FILL = 100
#: fixed values: what request_seconds holds for a failed request
ERROR_CODES = {"NotFound": -404, "ReadTimeout": -408, "TooManyRequests": -429,
               "InternalServerError": -500}
_RESULT_COLUMNS = ["status", "date_requested", "error", "request_seconds"]


def chunk_of(rn: Column, n: Column, max_rows: Column) -> Column:
    """0-based chunk of row ``rn`` of ``n`` when cut evenly into as few chunks as fit.

    ceil(n / max) chunks; the first n mod k chunks hold one row more than the others.
    """
    k = F.ceil(n / max_rows).cast("long")
    small = F.floor(n / k).cast("long")
    large_rows = (n % k) * (small + 1)
    i = rn - 1
    return F.when(i < large_rows, F.floor(i / (small + 1))).otherwise(
        (n % k) + F.floor((i - large_rows) / small)
    ).cast("long")


def even_chunks(rows: DataFrame, keys: list[str], max_rows: int) -> DataFrame:
    """``rows`` plus ``chunk`` per key, by cell id."""
    ranked = numbered(rows, keys, ["cell_id"], "_rn", total="_n")
    chunk = chunk_of(F.col("_rn"), F.col("_n"), F.lit(max_rows))
    return ranked.withColumn("chunk", chunk).drop("_rn", "_n")


def split_years(need: DataFrame, now, forecast_days: int = t.FORECAST_DAYS) -> DataFrame:
    """One row per cell and calendar year of its range, with the year's bounds.

    The current year ends ``forecast_days`` after today, every other one on Dec 31.
    """
    today = F.to_date(t.instant(now))
    year = F.col("year")
    first, last = F.year("date_first"), F.year("date_last")
    years = F.when(first <= last, F.sequence(first, last))
    return (
        need.withColumn("year", F.explode(years))
        .withColumn("date_first", F.make_date(year, F.lit(1), F.lit(1)))
        .withColumn(
            "date_last",
            F.when(year == F.year(today), F.date_add(today, forecast_days)).otherwise(
                F.make_date(year, F.lit(12), F.lit(31))
            ),
        )
    )


_CELL_YEAR = ["utm_zone", "utc_offset_seconds", "world_utm_id", "cell_id", "lon", "lat", "year"]


def gap_cells(gaps: DataFrame) -> DataFrame:
    """The gaps reduced, in every task before the shuffle, to one row per cell and year.

    With the cell's first and last gap date and its parameters, an enumerated domain.
    """
    return gaps.withColumn("year", F.year("date")).groupBy(*_CELL_YEAR).agg(
        F.min("date").alias("date_first"), F.max("date").alias("date_last"),
        F.collect_set("parameter").alias("parameters"),
    )


def _cells_with_bounds(cells: DataFrame) -> DataFrame:
    bounds = cells.groupBy("utm_zone", "year").agg(
        F.min("date_first").alias("date_first"), F.max("date_last").alias("date_last")
    )
    return cells.select(*_CELL_YEAR).join(bounds, ["utm_zone", "year"])


def split_years_for_fill(gaps: DataFrame) -> DataFrame:
    """Distinct cells per zone and year of the gaps, with the year's first and last gap date."""
    return _cells_with_bounds(gap_cells(gaps))


def parameter_groups(gaps: DataFrame, limit: int = MAX_PARAMETERS) -> DataFrame:
    """Parameter lists per zone: all of them, or every n-th of them where there are too many.

    Parameters are an enumerated domain, so a zone's list is short.
    """
    pairs = gaps.select("utm_zone", "parameter").distinct()
    by_zone = pairs.groupBy("utm_zone").agg(F.array_sort(F.collect_list("parameter")).alias("_p"))
    n = F.ceil(F.size("_p") / F.lit(limit)).cast("int")
    spread = by_zone.withColumn("_n", n).withColumn(
        "set_id", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
    )
    strided = F.expr("filter(_p, (p, i) -> i % _n = set_id)")
    return spread.select("utm_zone", "set_id", strided.alias("parameters"))


def _with_sets(parameter_sets, n_cells_per_set) -> Column:
    return F.explode(
        F.array(*[
            F.struct(
                F.lit(i).alias("set_id"),
                F.array(*[F.lit(p) for p in params]).alias("parameters"),
                F.lit(int(n)).alias("max_cells"),
            )
            for i, (params, n) in enumerate(zip(parameter_sets, n_cells_per_set))
        ])
    )


def _requests(chunks: DataFrame, place: list[str], restart: list[str]) -> DataFrame:
    """Request rows from cells with set_id, parameters, zone, chunk (and year).

    ``restart`` are the columns within which request numbers start over; the numbers count the
    chunks by ``place``. A chunk holds a bounded number of cells, so its points fit in one array.
    """
    group = [*restart, *place, "chunk"]
    day_span = F.datediff(F.max("date_last"), F.min("date_first")).cast("long")
    packed = chunks.groupBy(*group).agg(
        F.first("parameters").alias("parameters"),
        F.min("utc_offset_seconds").alias("utc_offset_seconds"),
        F.array_sort(F.collect_list(F.struct("cell_id", "lat", "lon"))).alias("_cells"),
        F.min("date_first").alias("date_first"),
        F.max("date_last").alias("date_last"),
        day_span.alias("_days"),
        F.count("*").alias("n_cells"),
    )
    # chunks per place: zones × years at most, a short table
    per_place = packed.groupBy(*restart, *place).agg(F.count("*").alias("_k"))
    before = W.partitionBy(*restart).orderBy(*place).rowsBetween(W.unboundedPreceding, -1)
    starts = per_place.select(
        *restart, *place, F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_first")
    )
    offset = F.col("utc_offset_seconds")
    return packed.join(starts, [*restart, *place]).select(
        "set_id",
        F.col("utm_zone").alias("zone"),
        *[c for c in place if c != "utm_zone"],
        "chunk",
        (F.col("_first") + F.col("chunk")).cast("int").alias("utm_request_id"),
        "utc_offset_seconds",
        (F.size("parameters") * F.col("_days") * F.col("n_cells")).cast("long")
        .alias("n_pts_requested"),
        F.transform("_cells", lambda c: F.struct(c["lat"].alias("lat"), c["lon"].alias("lon")))
        .alias("coordinate_list"),
        t.end_of_day_utc(F.col("date_first"), offset).alias("startdate"),
        t.end_of_day_utc(F.col("date_last"), offset).alias("enddate"),
        "parameters",
    )


def _chunked_by_set(rows: DataFrame, keys: list[str], sets: Column) -> DataFrame:
    # ranks do not depend on the set: rank once, then cut each set by its own size
    ranked = numbered(rows, keys, ["cell_id"], "_rn", total="_n")
    each = ranked.withColumn("_set", sets).select("*", "_set.*").drop("_set")
    chunk = chunk_of(F.col("_rn"), F.col("_n"), F.col("max_cells"))
    return each.withColumn("chunk", chunk).drop("_rn", "_n", "max_cells")


def update_plan(
    need: DataFrame, parameter_sets=PARAMETER_SETS, n_cells_per_set=CELLS_PER_UPDATE
) -> DataFrame:
    """Requests for an update: parameter set × zone × chunk of cells."""
    sets = _with_sets(parameter_sets, n_cells_per_set)
    return _requests(_chunked_by_set(need, ["utm_zone"], sets), ["utm_zone"], ["set_id"])


def add_plan(
    need: DataFrame, now, parameter_sets=PARAMETER_SETS, n_cells_per_set=CELLS_PER_ADD,
    forecast_days: int = t.FORECAST_DAYS,
) -> DataFrame:
    """Requests for an addition: parameter set × zone × year × chunk of cells."""
    sets = _with_sets(parameter_sets, n_cells_per_set)
    years = split_years(need, now, forecast_days)
    chunks = _chunked_by_set(years, ["utm_zone", "year"], sets)
    return _requests(chunks, ["utm_zone", "year"], ["set_id"])


def fill_plan(gaps: DataFrame, n_cells: int = CELLS_PER_FILL) -> DataFrame:
    """Requests for a fill: zone × parameter group × year × chunk of cells.

    The gaps are computed once: bounds, chunks and parameter groups all come from the written
    table of cells and years.
    """
    cells = cut_lineage(gap_cells(gaps))
    chunks = even_chunks(_cells_with_bounds(cells), ["utm_zone", "year"], n_cells)
    asked = cells.select("utm_zone", F.explode("parameters").alias("parameter"))
    # at most a handful of groups per zone, so the zone join does not fan out
    with_parameters = chunks.join(parameter_groups(asked), "utm_zone")
    return _requests(with_parameters, ["year"], ["utm_zone", "set_id"])


def request_size(need: DataFrame, keys: list[str], n_parameters: int) -> DataFrame:
    """Points a request per key would ask for."""
    days = F.datediff(F.max("date_last"), F.min("date_first"))
    return need.groupBy(*keys).agg(
        (F.lit(n_parameters) * days * F.count("*")).cast("long").alias("n_pts_requested")
    )


def requests_used_today(request_log: DataFrame, now) -> DataFrame:
    midnight = F.date_trunc("DAY", t.instant(now)).cast("timestamp_ntz")
    return request_log.filter(F.col("date_requested") > midnight).agg(
        F.count("*").alias("n_requests")
    )


def requests_remaining(
    request_log: DataFrame, now, account_remaining: int, limit: int = DAILY_LIMIT
) -> DataFrame:
    """One row: what is left of our own limit or of the account, whichever is less."""
    return requests_used_today(request_log, now).select(
        F.least(F.lit(limit) - F.col("n_requests"), F.lit(account_remaining)).cast("long")
        .alias("n_requests")
    )


def budget_cut(requests: DataFrame, budget: Column | int) -> DataFrame:
    """Whole zones within the budget: all if they fit, else the smallest zones first.

    A zone is kept while the running total stays strictly below the budget. Zones of one size go
    by number.
    """
    limit = F.lit(budget) if isinstance(budget, int) else budget
    per_zone = requests.groupBy("zone").agg(F.count("*").alias("_n"))
    # at most 61 zones, so a window without partition is fine
    running = W.orderBy("_n", "zone").rowsBetween(W.unboundedPreceding, W.currentRow)
    everything = W.orderBy("_n", "zone").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    kept = (
        per_zone.select(
            "zone", F.sum("_n").over(running).alias("_sum"), F.sum("_n").over(everything).alias("_all")
        )
        .filter((F.col("_all") <= limit) | (F.col("_sum") < limit))
        .select("zone")
    )
    return requests.join(kept, "zone", "left_semi")


# ---- failed requests ------------------------------------------------------------------------
def without_unknown_parameters(failed: DataFrame) -> DataFrame:
    """Failed requests minus the parameters their error names; gone when none is left."""
    good = F.filter("parameters", lambda p: ~F.contains(F.col("error"), p))
    return (
        failed.withColumn("parameters", good)
        .filter(F.size("parameters") > 0)
        .drop(*_RESULT_COLUMNS)
    )


def halved(failed: DataFrame) -> DataFrame:
    """Timed-out requests in two: by days, for one day by points, for one point by parameters.

    The first half takes the odd one. A range of n days breaks after floor(n / 2) more days, so
    that two days give a first half of both and an empty second one.
    """
    one_day = F.col("startdate") == F.col("enddate")
    many_points = F.size("coordinate_list") > 1

    def halves(column: str) -> tuple[Column, Column]:
        n = F.size(column)
        first = F.ceil(n / F.lit(2)).cast("int")
        return F.slice(column, F.lit(1), first), F.slice(column, first + 1, n)

    points, params = halves("coordinate_list"), halves("parameters")
    n_days = F.expr("extract(DAY FROM (enddate - startdate))") + 1
    split = F.floor(n_days / F.lit(2)).cast("int")
    middle = F.col("startdate") + F.make_dt_interval(split)

    def part(i: int) -> Column:
        start = F.col("startdate") if i == 0 else middle + F.expr("interval 1 day")
        end = middle if i == 0 else F.col("enddate")
        return F.struct(
            F.lit(i).alias("half"),
            F.when(one_day, F.col("startdate")).otherwise(start).alias("startdate"),
            F.when(one_day, F.col("enddate")).otherwise(end).alias("enddate"),
            F.when(one_day & many_points, points[i]).otherwise(F.col("coordinate_list"))
            .alias("coordinate_list"),
            F.when(one_day & ~many_points, params[i]).otherwise(F.col("parameters"))
            .alias("parameters"),
        )

    changed = ["startdate", "enddate", "coordinate_list", "parameters"]
    rest = [c for c in failed.columns if c not in changed + _RESULT_COLUMNS]
    parts = failed.withColumn("_part", F.explode(F.array(part(0), part(1))))
    return parts.select(*rest, "_part.half", *[f"_part.{c}" for c in changed])


def retry_requests(requests: DataFrame) -> DataFrame:
    """Requests to send again: unknown parameters dropped, time-outs halved, others given up."""
    failed = requests.filter("status = 'FAIL'")
    code = F.col("request_seconds")
    fewer = without_unknown_parameters(failed.filter(code == ERROR_CODES["NotFound"]))
    smaller = halved(failed.filter(code == ERROR_CODES["ReadTimeout"]))
    return fewer.withColumn("half", F.lit(0)).unionByName(smaller)


def request_report(requests: DataFrame) -> DataFrame:
    """One row: attempted, succeeded, failed, shares in percent, and failures per error."""
    failed = F.col("status") == "FAIL"
    n, n_failed = F.count("*"), F.count_if(failed)
    share = lambda part: F.bround(F.lit(100.0) * part / F.nullif(n, F.lit(0))).cast("long")
    return requests.agg(
        n.alias("n_attempted"),
        (n - n_failed).alias("n_success"),
        n_failed.alias("n_failed"),
        share(n - n_failed).alias("percent_success"),
        share(n_failed).alias("percent_failed"),
        *[
            F.count_if(failed & (F.col("request_seconds") == code)).alias(f"n_{name}")
            for name, code in ERROR_CODES.items()
        ],
    )


def unhandled_failures(requests: DataFrame) -> DataFrame:
    """Failed requests a person must look at."""
    codes = [float(ERROR_CODES[e]) for e in ("NotFound", "InternalServerError")]
    return requests.filter(
        (F.col("status") == "FAIL") & F.col("request_seconds").isin(*codes)
    ).select("error", "zone", "startdate", "enddate", "coordinate_list", "parameters")
