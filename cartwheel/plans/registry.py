"""Register jobs by name and call them, getting a one-row status frame.

This re-aims stored-procedure registration and ``CALL name()``: a job is
any ``f(spark) -> str``; the data work inside it runs on the cluster, the
registry itself is a dictionary on the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession], str]


class JobRegistry:
    def __init__(self) -> None:
        self._jobs: dict[str, Job] = {}

    def register(self, name: str, job: Job, replace: bool = False) -> Job:
        key = name.lower()
        if key in self._jobs and not replace:
            raise ValueError(f"job {name!r} is already registered (pass replace=True)")
        self._jobs[key] = job
        return job

    def names(self) -> list[str]:
        return sorted(self._jobs)

    def call(self, spark: SparkSession, name: str) -> DataFrame:
        """Run the job and return its status as a one-row ``status`` frame."""
        try:
            job = self._jobs[name.lower()]
        except KeyError:
            raise KeyError(f"no job named {name!r}; registered: {self.names()}") from None
        return spark.createDataFrame([(job(spark),)], "status string")
