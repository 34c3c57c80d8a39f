"""Numbered manifests of a folder: what a table kept in files consists of.

A manifest is a small JSON file ``manifests/<number>.json``, written as a draft
and moved into place whole; the newest one is in force.  A number is published
once: a second writer of the same number fails.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Versions:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def fs(self):
        return self.path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        fs, folder = self.fs(), self.path("manifests")
        names = [st.getPath().getName() for st in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def load(self, number: int) -> dict:
        return json.loads(self.spark.read.text(f"{self.root}/manifests/{number:012d}.json", wholetext=True).first()[0])

    def newest(self) -> tuple[int, dict] | None:
        numbers = self.numbers()
        return (numbers[-1], self.load(numbers[-1])) if numbers else None

    def publish(self, number: int, manifest: dict) -> None:
        fs = self.fs()
        fs.mkdirs(self.path("manifests"))
        draft = self.path("manifests", f"_{number:012d}.draft")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest), "utf-8"))
        out.close()
        if not fs.rename(draft, self.path("manifests", f"{number:012d}.json")):
            raise RuntimeError(f"version {number} of {self.root} was published by someone else")
