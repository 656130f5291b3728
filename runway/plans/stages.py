"""Concurrent stages: independent parts of a run submit their Spark jobs from separate threads."""

from __future__ import annotations

import contextvars
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor


def in_parallel(tasks: dict[str, Callable[[], object]], workers: int = 5) -> dict[str, object]:
    """Run independent stages concurrently; each submits its own Spark jobs from its own thread.

    The scheduler interleaves their tasks, so small stages of one source fill
    the cores (or executors) another leaves idle.
    """
    if len(tasks) <= 1 or workers <= 1:
        return {k: fn() for k, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(workers, len(tasks))) as pool:
        # Each thread runs in a copy of the caller's context (its scratch folder, see ``sinks.scratch``).
        futures = {k: pool.submit(contextvars.copy_context().run, fn) for k, fn in tasks.items()}
        return {k: f.result() for k, f in futures.items()}
