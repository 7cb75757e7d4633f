"""Independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from typing import TypeVar

R = TypeVar("R")


def together(jobs: Mapping[str, Callable[[], R]]) -> dict[str, R]:
    """Results of ``jobs`` by name; each starts its Spark jobs from a thread of its own.

    Small tables are done while a large one still runs, instead of after it. The first error is
    raised when all jobs have ended.
    """
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        running = {name: pool.submit(copy_context().run, job) for name, job in jobs.items()}
    return {name: future.result() for name, future in running.items()}
