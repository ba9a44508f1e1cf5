"""Periodic progress of batch jobs: what Spark's status tracker says about the running stages."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import SparkSession


def running_stages(spark: SparkSession) -> list[dict]:
    """``stage, tasks, done, running`` of every stage that runs now."""
    tracker, out = spark.sparkContext.statusTracker(), []
    for number in sorted(tracker.getActiveStageIds()):
        info = tracker.getStageInfo(number)
        if info is not None:
            out.append({"stage": number, "tasks": info.numTasks, "done": info.numCompletedTasks, "running": info.numActiveTasks})
    return out


@contextmanager
def reported(spark: SparkSession, seconds: float, on_report: Callable[[dict], None]):
    """While the block runs, a report every ``seconds`` (0: none): seconds so far and the running stages."""
    if seconds <= 0:
        yield
        return
    over, began = threading.Event(), time.time()

    def watch() -> None:
        while not over.wait(seconds):
            on_report({"elapsed_s": round(time.time() - began, 1), "stages": running_stages(spark)})

    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    try:
        yield
    finally:
        over.set()
        watcher.join()
