"""Run folders: the outputs of a job become visible together, when all of them are written.

A job writes below a hidden folder of its output folder. If it ends well, each output is moved into place (an
older one of the same name goes), then ``_manifest/<job>.json`` lists them with their files and bytes. If it
fails, the hidden folder goes and what was there before stays as it was. Scratch tables made during the job are deleted
either way.
"""

from __future__ import annotations

import contextlib
import datetime
import json
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

from .scratch import cleaned, hadoop


class Run:
    """Output paths of one job."""

    def __init__(self, spark: SparkSession, out: str, job: str) -> None:
        self.spark, self.out, self.job = spark, out.rstrip("/"), job
        # Spark's readers leave out names that begin with a dot
        self.hidden = f"{self.out}/.run-{uuid.uuid4().hex}"
        self.names: list[str] = []

    def path(self, name: str) -> str:
        """Where to write the output ``name``, until it is published."""
        if name not in self.names:
            self.names.append(name)
        return f"{self.hidden}/{name}"

    def publish(self) -> dict:
        outputs = []
        for name in self.names:
            fs, made = hadoop(self.spark, f"{self.hidden}/{name}")
            if not fs.exists(made):
                raise FileNotFoundError(f"{self.job} has not written {name}")
            size = fs.getContentSummary(made)
            outputs.append({"name": name, "files": size.getFileCount(), "bytes": size.getLength()})
        for name in self.names:
            fs, made = hadoop(self.spark, f"{self.hidden}/{name}")
            _, place = hadoop(self.spark, f"{self.out}/{name}")
            fs.mkdirs(place.getParent())
            fs.delete(place, True)
            if not fs.rename(made, place):
                raise OSError(f"{name} can't be moved into {self.out}")
        manifest = {"job": self.job, "finished": datetime.datetime.now(datetime.timezone.utc).isoformat(), "outputs": outputs}
        fs, place = hadoop(self.spark, f"{self.out}/_manifest/{self.job}.json")
        stream = fs.create(place, True)
        stream.write(bytearray(json.dumps(manifest, indent=1).encode()))
        stream.close()
        return manifest

    def discard(self) -> None:
        fs, p = hadoop(self.spark, self.hidden)
        fs.delete(p, True)


@contextlib.contextmanager
def run_folder(spark: SparkSession, out: str, job: str) -> Iterator[Run]:
    run = Run(spark, out, job)
    try:
        with cleaned(spark):
            yield run
        run.publish()
    finally:
        run.discard()
