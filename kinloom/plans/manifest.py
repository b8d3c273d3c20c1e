"""What a run has finished, so that the next one goes on from there and refuses what has changed since.

The manifest holds the run's signature (settings, inputs by path, size and time, the package's code) and, for each finished
stage, what it left. A stage counts once its entry is written, after its outputs; what an unfinished one left at its own
places is deleted before it runs again."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

import kinloom
from kinloom.session import staged
from kinloom.sources import files


def code_digest() -> str:
    """Of all modules of the package but those of the optional part."""
    home = Path(kinloom.__file__).parent
    digest = hashlib.sha256()
    for module in sorted(p for p in home.rglob("*.py") if p.relative_to(home).parts[0] in ("functions", "operators", "plans", "sources") or p.parent == home):
        digest.update(f"{module.relative_to(home)}\n".encode() + module.read_bytes())
    return digest.hexdigest()


class Manifest:
    """The manifest of one output folder."""

    def __init__(self, spark: SparkSession, folder: str, signature: dict) -> None:
        self.spark, self.path = spark, f"{folder}/manifest.json"
        signature = json.loads(json.dumps(signature))
        if files.exists(spark, self.path):
            self.held = json.loads(files.read_text(spark, self.path))
            old = self.held["signature"]
            if changed := sorted(k for k in {*old, *signature} if old.get(k) != signature.get(k)):
                raise ValueError(f"changed since the run in {folder} began: {', '.join(changed)}; use another folder")
        else:
            self.held = {"signature": signature, "completed": {}}
            self._write()

    def _write(self) -> None:
        files.write_text(self.spark, self.path, json.dumps(self.held, sort_keys=True))

    def done(self, stage: str) -> bool:
        """Whether a stage is finished; one whose outputs are gone is an error."""
        entry = self.held["completed"].get(stage)
        for path in entry["outputs"] if entry else ():
            if not files.exists(self.spark, path):
                raise ValueError(f"{path}, which stage {stage} left, is missing; use another folder")
        return entry is not None

    def _finish(self, stage: str, began: float, outputs: list[str], schemas: list | None = None) -> None:
        self.held["completed"][stage] = {"outputs": outputs, "schemas": schemas, "seconds": round(time.time() - began, 3)}
        self._write()

    def run(self, stage: str, outputs: list[str], work: Callable[[], object]) -> None:
        """Do the work that leaves `outputs`, unless it is done."""
        if self.done(stage):
            return
        for path in outputs:
            files.delete(self.spark, path)
        began = time.time()
        work()
        self._finish(stage, began, outputs)

    def frames(self, stage: str, build: Callable[[], list[DataFrame]]) -> list[DataFrame]:
        """The frames that `build` gives, as written; of a finished stage, as read from where it wrote them."""
        if self.done(stage):
            entry = self.held["completed"][stage]
            return [self.spark.read.schema(T.StructType.fromJson(s)).parquet(p) for p, s in zip(entry["outputs"], entry["schemas"], strict=True)]
        began = time.time()
        made = [df if "_kinloom_staged" in df.__dict__ else staged(df, stage) for df in build()]
        self._finish(stage, began, [df._kinloom_staged for df in made], [df.schema.jsonValue() for df in made])
        return made
