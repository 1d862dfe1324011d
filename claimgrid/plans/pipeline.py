"""The build: stages in order, each a function that writes its tables; a manifest tells which are done, and on what inputs."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from claimgrid.sources.readers import parquet_if_there


@dataclass
class Checkpoints:
    """Completed stages in a small JSON file, replaced as a whole."""

    path: str
    done: list[dict] = field(default_factory=list)

    @staticmethod
    def load(path: str) -> Checkpoints:
        if not os.path.exists(path):
            return Checkpoints(path)
        with open(path) as f:
            return Checkpoints(path, json.load(f)["stages"])

    def has(self, stage: str, inputs: str | None = None) -> bool:
        """Is the stage done, on these inputs if they are given?"""
        return any(x["stage"] == stage and inputs in (None, x.get("inputs")) for x in self.done)

    def add(self, stage: str, inputs: str | None = None) -> None:
        self.done = [x for x in self.done if x["stage"] != stage] + [{"stage": stage, "at": datetime.now(UTC).isoformat(timespec="seconds"), "inputs": inputs}]
        self._save()

    def drop(self, stage: str) -> None:
        if self.has(stage):
            self.done = [x for x in self.done if x["stage"] != stage]
            self._save()

    def restore(self, done: list[dict]) -> None:
        """The state that another folder's ``done`` told."""
        self.done = list(done)
        self._save()

    def _save(self) -> None:
        with open(self.path + ".new", "w") as f:
            json.dump({"stages": self.done}, f, indent=2)
        os.replace(self.path + ".new", self.path)

    def clear(self) -> None:
        self.done = []
        if os.path.exists(self.path):
            os.remove(self.path)


class StageTable:
    """Completed stages as one-row tables under a folder, in any store that Spark writes to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _write(self, stage: str, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, "stage string, at string, inputs string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/name={stage}")

    def _read(self, path: str) -> list[dict]:
        found = parquet_if_there(self.spark, path)
        return [] if found is None else [{"stage": r["stage"], "at": r["at"], "inputs": r.asDict().get("inputs")} for r in found.orderBy("at").collect()]  # a row for each stage

    @property
    def done(self) -> list[dict]:
        return self._read(self.path)

    def has(self, stage: str, inputs: str | None = None) -> bool:
        """Is the stage done, on these inputs if they are given?"""
        return any(inputs in (None, x["inputs"]) for x in self._read(f"{self.path}/name={stage}"))

    def add(self, stage: str, inputs: str | None = None) -> None:
        self._write(stage, [(stage, datetime.now(UTC).isoformat(timespec="microseconds"), inputs)])

    def drop(self, stage: str) -> None:
        if self.has(stage):
            self._write(stage, [])

    def clear(self) -> None:
        for x in self.done:
            self._write(x["stage"], [])

    def restore(self, done: list[dict]) -> None:
        """The state that another folder's ``done`` told."""
        self.clear()
        for x in done:
            self._write(x["stage"], [(x["stage"], x["at"], x.get("inputs"))])


def fingerprint(spark: SparkSession, paths: list[str], parameters: dict | None = None) -> str:
    """A digest of parameters and of the names, sizes and times of all files under some paths, in any store; their content
    isn't read. A path without files counts as such."""
    parts = [json.dumps(parameters or {}, sort_keys=True)]
    for path in paths:
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            one = files.agg(F.count("*"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            one = (0, None)
        parts.append(f"{path} {one[0]} {one[1]}")
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


@dataclass
class Pipeline:
    """Named stages; run() goes from start to end, without those skipped or already done.

    inputs: a stage's fingerprint, with which it counts as done. after: the stages whose tables a stage reads; when one runs,
    all that follow it are no longer done.
    """

    stages: list[tuple[str, Callable[[], object]]]
    checkpoints: Checkpoints | StageTable | None = None
    inputs: dict[str, Callable[[], str]] = field(default_factory=dict)
    after: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def names(self) -> list[str]:
        return [n for n, _ in self.stages]

    def selected(self, start: str | None = None, end: str | None = None, skip: tuple[str, ...] = ()) -> list[str]:
        names = self.names()
        for n in filter(None, (start, end, *skip)):
            if n not in names:
                raise ValueError(f"no stage {n!r}; there are {', '.join(names)}")
        first, last = names.index(start) if start else 0, names.index(end) if end else len(names) - 1
        if first > last:
            raise ValueError(f"{start!r} comes after {end!r}")
        return [n for n in names[first : last + 1] if n not in skip]

    def followers(self, stage: str) -> list[str]:
        """The stages that read what a stage writes, directly or not."""
        found = {stage}
        for n in self.names():  # a stage comes after those that it reads
            if found & set(self.after.get(n, ())):
                found.add(n)
        return [n for n in self.names() if n in found - {stage}]

    def clear(self, stage: str) -> list[str]:
        """Lets a stage and all that follow it run again; their names."""
        again = [*self.selected(stage, stage), *self.followers(stage)]
        for n in again if self.checkpoints else ():
            self.checkpoints.drop(n)
        return again

    def run(self, start: str | None = None, end: str | None = None, skip: tuple[str, ...] = (), resume: bool = True) -> list[str]:
        wanted, ran, by_name = self.selected(start, end, skip), [], dict(self.stages)
        for n in wanted:
            inputs = self.inputs[n]() if n in self.inputs and self.checkpoints else None
            if resume and self.checkpoints and self.checkpoints.has(n, inputs):
                continue
            self.clear(n)
            by_name[n]()
            ran.append(n)
            if self.checkpoints:
                self.checkpoints.add(n, inputs)
        return ran


def merged_config(*configs: dict) -> dict:
    """Later values replace earlier ones, dictionaries key by key."""
    out: dict = {}
    for c in configs:
        for k, v in c.items():
            out[k] = merged_config(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def read_config(path: str) -> dict:
    """A JSON file, or a YAML file where the yaml package is installed."""
    with open(path) as f:
        if not path.endswith((".yaml", ".yml")):
            return json.load(f)
        import yaml

        return yaml.safe_load(f) or {}


def environment(prefix: str, environ: dict[str, str] | None = None) -> dict:
    """PREFIX_A__B=x as {"a": {"b": "x"}}."""
    out: dict = {}
    for name, value in (os.environ if environ is None else environ).items():
        if name.startswith(prefix + "_"):
            at, *rest = name[len(prefix) + 1 :].lower().split("__")
            node, keys = out, [at, *rest]
            for k in keys[:-1]:
                node = node.setdefault(k, {})
            node[keys[-1]] = value
    return out


def next_folder(path: str) -> str:
    """path, or path_1, path_2 ... if it is taken."""
    out, i = path, 0
    while os.path.exists(out):
        i += 1
        out = f"{path}_{i}"
    return out
