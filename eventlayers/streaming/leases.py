"""Leases: one active run of a job, and numbers that fence off one that was taken over.

A lease is a file `<folder>/<number>` that exists once: it is created and never overwritten by another. Its content
says until when it holds; `<number>.released` ends it before. Whoever wants the job creates the next number, which
only one can, and only where the newest is released or has run out. Whoever is not the newest any more must not commit.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from eventlayers.sources import files

# Fixed value: a run is given up after so many seconds without a sign of life.
SECONDS = 1800


class LeaseHeld(RuntimeError):
    """Another run is at work."""


class LeaseLost(RuntimeError):
    """A later run has taken over; what this one has not committed is void."""


def newest(spark: SparkSession, folder: str) -> int:
    """The last number given out; 0 before the first."""
    return max((int(n) for n in files.names(spark, folder) if n.isdecimal()), default=0)


@dataclass(frozen=True)
class Lease:
    spark: SparkSession
    folder: str
    number: int
    owner: str
    seconds: float

    def _path(self, mark: str = "") -> str:
        return f"{self.folder}/{self.number}{mark}"

    def check(self) -> None:
        """Raises unless this is the newest lease."""
        last = newest(self.spark, self.folder)
        if last != self.number:
            raise LeaseLost(f"lease {self.number} of {self.owner} was followed by {last}")

    def renew(self) -> None:
        """A sign of life; only the holder writes this file after its creation."""
        self.check()
        files.write_text(self.spark, self._path(), f"{time.time() + self.seconds} {self.owner}")

    def release(self) -> None:
        if newest(self.spark, self.folder) == self.number:
            files.write_text(self.spark, self._path(".released"), self.owner)


def acquire(spark: SparkSession, folder: str, owner: str, seconds: float = SECONDS) -> Lease:
    """The next lease of a folder; raises `LeaseHeld` while the newest one holds, or if another was quicker."""
    folder = folder.rstrip("/")
    last = newest(spark, folder)
    if last and f"{last}.released" not in files.names(spark, folder):
        # A holder that died between creation and content has held nothing.
        until = (files.read_text(spark, f"{folder}/{last}").split(" ", 1)[0] or "0")
        if float(until) > time.time():
            raise LeaseHeld(f"{folder} is leased as {last}")
    lease = Lease(spark, folder, last + 1, owner, seconds)
    try:
        files.write_text(spark, lease._path(), f"{time.time() + seconds} {owner}", overwrite=False)
    except Py4JJavaError as error:
        raise LeaseHeld(f"{folder}: {last + 1} was taken by another") from error
    return lease
