"""Run independent table jobs of one layer as concurrent Spark jobs.

Tables of a layer do not depend on each other; submitting their writes from a
few driver threads lets Spark's scheduler interleave their stages, so small
tables no longer leave most executors idle while they run one after another.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

DEFAULT_WORKERS = 4


def run_all(jobs: dict[str, Callable[[], object]], workers: int = DEFAULT_WORKERS) -> dict[str, object]:
    """Run each job (a no-argument callable) and return its result by name; the
    first failure is raised after all jobs have finished."""
    if workers <= 1 or len(jobs) <= 1:
        return {name: job() for name, job in jobs.items()}
    with ThreadPoolExecutor(max_workers=workers, thread_name_prefix="letramento-job") as pool:
        futures = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: f.result() for name, f in futures.items()}
