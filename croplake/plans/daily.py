"""The daily job over stored tables: update, add, fill, each with retries, then a report."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from croplake.operators import weather as w
from croplake.plans import ingest as g
from croplake.plans import requests as r
from croplake.session import cut_lineage

#: fixed value: rounds in which failed requests of a step are sent again
RETRIES = 3

#: gives for (step, plan) the landed (wide response rows, requests with their results)
Responses = Callable[[str, DataFrame], tuple[DataFrame, DataFrame]]


@dataclass
class StepResult:
    """What one step needs, asks for, got back in all its rounds, and adds to the daily table."""

    need: DataFrame
    plan: DataFrame
    requests: DataFrame
    new_rows: DataFrame


def update_need(daily, world_utm, cell_centroid, now) -> DataFrame:
    return w.update_inventory(daily, world_utm, cell_centroid, now)


def add_need(need_fields, daily) -> DataFrame:
    return w.add_inventory(need_fields, daily)


def fill_need(need_fields, daily, world_utm, cell_centroid, weather_type, now) -> DataFrame:
    need = w.merged_need(need_fields, w.need_of_populated(daily, world_utm, cell_centroid, now))
    return w.fill_inventory(need, daily, weather_type, now)


def check_names(weather_type: DataFrame, names: Iterable[str]) -> None:
    """Raise if a parameter that is about to be asked for has no stored weather type."""
    wanted = weather_type.sparkSession.createDataFrame([(n,) for n in names], "weather_type string")
    unknown = sorted(x[0] for x in w.weather_type_ids(weather_type, wanted)[1].collect())  # as many as names at most
    if unknown:
        raise ValueError(f"no weather type is stored for {', '.join(unknown)}")


def _step(
    name: str, need: DataFrame, make_plan: Callable[[DataFrame], DataFrame], budget: Column,
    responses: Responses, weather_type: DataFrame,
) -> StepResult:
    # need, plan and answers are written before they are used, as requests are sent in between
    need = cut_lineage(need)
    plan = pending = cut_lineage(r.budget_cut(make_plan(need), budget))
    cells = need.select("world_utm_id", "cell_id", "utc_offset_seconds", "lat", "lon").distinct()
    sent, rows = None, None
    for _ in range(1 + RETRIES):
        wide, requests = responses(name, pending)
        requests = cut_lineage(requests)
        got = g.daily_rows_of(g.filter_response(g.clean_response(wide, cells), need), weather_type)
        got = cut_lineage(got)
        sent = requests if sent is None else sent.unionByName(requests)
        rows = got if rows is None else rows.unionByName(got)
        budget = budget - requests.agg(F.count("*")).scalar()
        # the frontier: what failed in this round, in a form that may succeed
        pending = cut_lineage(r.budget_cut(r.retry_requests(requests).drop("half"), budget))
        if pending.isEmpty():
            break
    return StepResult(need, plan, sent, rows)


def run_daily(
    daily: DataFrame, need_fields: DataFrame, world_utm: DataFrame, cell_centroid: DataFrame,
    weather_type: DataFrame, responses: Responses, now, budget: int, fill: bool = False,
    parameter_sets=r.PARAMETER_SETS,
) -> tuple[dict[str, StepResult], DataFrame]:
    """Steps by name, and the report over all their requests.

    Names of parameters are checked first. Each step sees the daily table with the rows of the steps
    before it, and what they left of the budget; its failed requests are sent again in up to
    ``RETRIES`` rounds within that budget: without the parameters that are unknown, or in halves.
    Sending requests is not done here: ``responses`` reads what has landed. What to store afterwards:
    :func:`rows_to_append`, :func:`requests_to_log`.
    """
    check_names(weather_type, [p for group in parameter_sets for p in group])
    steps: dict[str, StepResult] = {}
    rows = daily.select(*g.DAILY_COLUMNS)
    left: Column = F.lit(budget)

    def run(name: str, need: DataFrame, make_plan: Callable[[DataFrame], DataFrame]) -> None:
        nonlocal rows, left
        step = steps[name] = _step(name, need, make_plan, left, responses, weather_type)
        rows = rows.unionByName(step.new_rows)
        left = left - step.requests.agg(F.count("*")).scalar()

    run(
        "update", update_need(rows, world_utm, cell_centroid, now),
        lambda need: r.update_plan(need, parameter_sets),
    )
    run("add", add_need(need_fields, rows), lambda need: r.add_plan(need, now, parameter_sets))
    if fill:
        gaps = fill_need(need_fields, rows, world_utm, cell_centroid, weather_type, now)
        run("fill", gaps, r.fill_plan)
    return steps, r.request_report(_all(s.requests.select("status", "request_seconds") for s in steps.values()))


def _all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def rows_to_append(steps: dict[str, StepResult]) -> DataFrame:
    """New daily rows of all steps, for :func:`croplake.plans.ingest.append_daily`."""
    return _all(s.new_rows for s in steps.values())


def requests_to_log(steps: dict[str, StepResult]) -> DataFrame:
    """Every request of every round, for :func:`croplake.plans.ingest.append_request_log`."""
    return _all(s.requests.select(*g.LOG_COLUMNS) for s in steps.values())
