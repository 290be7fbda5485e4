"""Deadlines and cancelling of batch jobs, by Spark job tags.

Every Spark job that a batch job starts carries its tag, also those of its
broadcast and subquery threads. When the time is over, or the run is stopped,
a watcher cancels the jobs with that tag, and goes on doing so until the batch
job has given up, as it may be between two Spark jobs just then. ``check`` is
called once more before an output is published, so that a job that is over its
time leaves the previous version alone.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import SparkSession

AGAIN_S = 0.3  # between two attempts to cancel


class JobTimeout(TimeoutError):
    """A batch job was over its time."""


class JobStopped(RuntimeError):
    """The run of a batch job was stopped."""


class Deadline:
    """``with Deadline(spark, tag, seconds, stop):`` runs its body under the
    tag. No ``seconds``: no limit. ``stop`` is an event that another thread may
    set."""

    def __init__(self, spark: SparkSession, tag: str, seconds: float | None = None, stop: threading.Event | None = None):
        self.context, self.tag, self.seconds = spark.sparkContext, tag, seconds
        self.stop = stop or threading.Event()
        self.done = threading.Event()
        self.ends = None

    def __enter__(self) -> Deadline:
        self.ends = None if self.seconds is None else time.monotonic() + self.seconds
        self.context.addJobTag(self.tag)
        self.context.setInterruptOnCancel(True)
        self.watcher = threading.Thread(target=self._watch, daemon=True)
        self.watcher.start()
        return self

    def __exit__(self, *exc) -> None:
        self.done.set()
        self.watcher.join()
        self.context.removeJobTag(self.tag)
        self.context.setInterruptOnCancel(False)

    @property
    def over(self) -> bool:
        return self.ends is not None and time.monotonic() >= self.ends

    def check(self) -> None:
        """Raise if the job must not go on."""
        if self.stop.is_set():
            raise JobStopped("the run was stopped")
        if self.over:
            raise JobTimeout(f"not done after {self.seconds:g} seconds")

    def _watch(self) -> None:
        while not self.done.wait(AGAIN_S):
            if self.over or self.stop.is_set():
                self.context.cancelJobsWithTag(self.tag)
