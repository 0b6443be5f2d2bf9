"""Run independent Spark jobs at the same time."""

from __future__ import annotations

import contextvars
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def run_together(
    spark: SparkSession, jobs: Mapping[str, Callable[[], Any]], parallelism: int
) -> tuple[dict[str, Any], dict[str, Exception]]:
    """Call every job, a few at a time; return results and failures by name.

    Each job gets a scheduler pool of its own, so that under ``spark.scheduler.mode=FAIR`` a
    large one does not hold up the small ones. A failure leaves the other jobs running.
    """

    def call(name: str, job: Callable[[], Any]) -> Any:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return job()

    def target() -> Callable:  # every thread with a copy of its own of the local properties
        return inheritable_thread_target(spark)(call)

    results, failures = {}, {}
    with ThreadPoolExecutor(max(1, min(parallelism, len(jobs)))) as pool:
        running = {
            name: pool.submit(contextvars.copy_context().run, target(), name, job)
            for name, job in jobs.items()
        }
        for name, future in running.items():
            try:
                results[name] = future.result()
            except Exception as err:  # reported under the job's own name
                failures[name] = err
    return results, failures


def run_all(spark: SparkSession, jobs: Mapping[str, Callable[[], Any]], parallelism: int) -> dict:
    """As :func:`run_together`, but fail after the last job if any of them failed."""
    results, failures = run_together(spark, jobs, parallelism)
    if failures:
        raise RuntimeError("failed: " + ", ".join(failures)) from next(iter(failures.values()))
    return results
