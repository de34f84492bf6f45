"""Ordered runs: ingestion and models go on after a failure, loads stop at the first one."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession

from tradewind.plans import cleaning, models
from tradewind.plans.dashboards import delivered
from tradewind.plans.warehouse import DIMENSIONS, FACTS, Warehouse
from tradewind.sources.writers import ingest, replace_table, write_back


@dataclass(frozen=True)
class Outcome:
    job: str
    ok: bool
    seconds: float
    rows: int | None = None
    error: str | None = None


class LoadError(RuntimeError):
    """A load failed; the loads after it did not run."""

    def __init__(self, done: list[Outcome]):
        super().__init__("; ".join(f"{o.job}: {o.error}" for o in done if not o.ok))
        self.done = done


def run_jobs(
    jobs: Mapping[str, Callable[[], object]], stop_on_failure: bool, at_once: int = 1
) -> list[Outcome]:
    """Run jobs in order, up to `at_once` of them side by side.

    With `stop_on_failure` no job is started after a failed one, and the
    failure is raised with the outcomes so far.
    """
    failed = threading.Event()

    def run(item: tuple[str, Callable[[], object]]) -> Outcome | None:
        name, job = item
        if stop_on_failure and failed.is_set():
            return None
        started = time.monotonic()
        try:
            report = job()
        except Exception as e:  # noqa: BLE001 - every failure is reported, none hidden
            failed.set()
            return Outcome(name, False, time.monotonic() - started, error=f"{type(e).__name__}: {e}")
        return Outcome(name, True, time.monotonic() - started, getattr(report, "rows", None))

    if at_once == 1:
        results = [run(item) for item in jobs.items()]
    else:
        with ThreadPool(at_once) as pool:
            results = pool.map(run, jobs.items(), chunksize=1)
    done = [o for o in results if o is not None]
    if stop_on_failure and failed.is_set():
        raise LoadError(done)
    return done


def ingest_all(spark: SparkSession, sources: Mapping[str, Callable[[], DataFrame]], root: str) -> list[Outcome]:
    """Copy all raw sources."""
    jobs = {n: (lambda n=n, read=read: ingest(spark, read(), f"{root}/{n}")) for n, read in sources.items()}
    return run_jobs(jobs, stop_on_failure=False)


# independent loads share the cluster; the small ones fill the tail of the large ones
LOADS_AT_ONCE = 4


def _load(warehouse: Warehouse, names: Sequence[str], at_once: int) -> list[Outcome]:
    def load(name: str):
        warehouse[name]
        return warehouse.reports.get(name)

    return run_jobs({n: (lambda n=n: load(n)) for n in names}, stop_on_failure=True, at_once=at_once)


def clean_all(warehouse: Warehouse, at_once: int = LOADS_AT_ONCE) -> list[Outcome]:
    """The nine cleaning loads; none reads another's result."""
    return _load(warehouse, list(cleaning.JOBS), at_once)


def load_star(warehouse: Warehouse, at_once: int = LOADS_AT_ONCE) -> list[Outcome]:
    """All dimensions, then all facts."""
    return _load(warehouse, DIMENSIONS, at_once) + _load(warehouse, FACTS, at_once)


def run_models(
    orders: DataFrame, target: str | None = None, options: Mapping[str, dict] | None = None
) -> tuple[DataFrame, list[Outcome]]:
    """Fit and score all models, put their columns on the order table.

    Without a target nothing is written (dry run).
    """
    done = delivered(orders)
    fitted: dict[str, models.Fitted] = {}

    def fit(name: str):
        job, _ = models.JOBS[name]
        fitted[name] = job(done, **(options or {}).get(name, {}))

    outcomes = run_jobs({n: (lambda n=n: fit(n)) for n in models.JOBS}, stop_on_failure=False)
    scored = orders
    for name, result in fitted.items():
        scored = write_back(scored, result.scores, models.JOBS[name][1])
    if target is not None:
        replace_table(scored, target)
        for result in fitted.values():
            result.release()
    return scored, outcomes
