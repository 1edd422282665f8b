"""The daily run: land, apply, build, check, publish, keep house."""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import Rule, broken_counts
from ..sources.groups import TABLES, Table
from ..sources.landing import Run, land
from ..sources.storage import Storage
from . import gold, silver  # noqa: F401  they register the models
from .bronze import Bronze, Outcome
from .maintenance import housekeeping_due, maintain
from .models import MODELS, Build, Context, select
from .publish import DAILY, FULL, Published, publish, readable, run_mode, write_report
from .rules import RULES

#: Models that several others read; a run that publishes keeps them.
SHARED = ("stg_orders", "stg_order_product", "int_order_value_rollup", "int_orders_latest_status", "fact_orders")


class ChecksFailed(ValueError):
    """Rows break data-quality rules."""


@dataclass
class Report:
    landed: dict[str, int] = field(default_factory=dict)
    bronze: Outcome = field(default_factory=Outcome)
    published: list[Published] = field(default_factory=list)
    broken: dict[str, int] = field(default_factory=dict)
    unreadable: list[str] = field(default_factory=list)
    seconds: dict[str, float] = field(default_factory=dict)
    mode: str = DAILY


def land_all(spark: SparkSession, sources: Mapping[str, DataFrame], run: Run, tables: Mapping[str, Table] = TABLES) -> dict[str, int]:
    """Rows landed of each table that has a source."""
    return {n: sum(b["row_count"] for b in land(spark, sources[n], run, t)) for n, t in tables.items() if n in sources}


def broken_rules(build: Build, rules: Iterable[Rule] = RULES) -> dict[str, int]:
    """How many rows break each rule that any row breaks."""
    return {f"{r.kind}:{r.model}.{r.column}": n for r, n in broken_counts([*rules], build).items() if n}


def refresh(spark: SparkSession, build: Build, root: str, wanted: str = DAILY, tags: Iterable[str] = (), check: bool = True, strict: bool = True, report: Report | None = None) -> Report:
    """Build models, check them, and publish dimensions, facts and marts."""
    report = report or Report()
    names = [n for n in select(tags) if MODELS[n].layer in ("dimension", "fact", "gold") and _available(build, n)]
    report.mode = run_mode(spark, root, wanted, names)
    if report.mode == FULL and build.ctx.logical_date is not None:
        build = Build(build.source, replace(build.ctx, logical_date=None), {k: v for k, v in build.found.items() if k.startswith("b_")})
    kept = [build(n).persist() for n in SHARED]
    try:
        if check:
            report.broken = broken_rules(build)
            if report.broken and strict:
                raise ChecksFailed(str(report.broken))
        for n in names:
            began = time.time()
            report.published.append(publish(spark, build, n, root, report.mode))
            report.seconds[n] = round(time.time() - began, 2)
    finally:
        for df in kept:
            df.unpersist()
    write_report(spark, root, build.ctx.run_id, report.published)
    report.unreadable = readable(spark, report.published)
    return report


def _available(build: Build, name: str) -> bool:
    try:
        build(name)
    except KeyError:
        return False
    return True


def run_daily(spark: SparkSession, sources: Mapping[str, DataFrame], run: Run, root: str, ctx: Context, wanted: str = DAILY, extra: Mapping[str, DataFrame] | None = None, strict: bool = True, housekeeping: bool = False) -> Report:
    """One day, from source tables to marts; extra: inputs that are not landed, such as budgets."""
    report, bronze = Report(), Bronze(spark, root)
    report.landed = land_all(spark, sources, run)
    report.bronze = bronze.apply_all(run, [TABLES[n] for n in sources if n in TABLES])
    tables = {n: bronze.table(n) for n in TABLES if Storage(spark).exists(bronze.path(n))} | dict(extra or {})
    report = refresh(spark, Build(tables, ctx), root, wanted, strict=strict, report=report)
    if housekeeping_due(run.run_date, housekeeping):
        for t in TABLES.values():
            if t.group != "snapshots" and Storage(spark).exists(bronze.path(t.name)):
                maintain(spark, bronze.path(t.name), "event_date" if t.partition_key == "event_date" else None)
    Storage(spark).write_json(f"{root}/_runs/{run.run_id}.json", {"landed": report.landed, "bronze": report.bronze.statuses, "errors": report.bronze.errors, "mode": report.mode, "broken": report.broken, "seconds": report.seconds})
    return report
