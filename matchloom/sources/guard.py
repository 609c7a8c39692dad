"""Guarded reads: verified files, and labels that only their rightful callers see."""

import hashlib
import inspect
import json
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.operators.profile import content_hash


class IntegrityError(RuntimeError):
    """Data isn't what the manifest says."""


class LockboxError(PermissionError):
    """Labels of a split were asked for by someone who may not see them, or for a second time."""


def file_sha256(path: str) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def manifest(tables: dict[str, tuple[DataFrame, list[str]]], gates_passed: bool) -> dict:
    """Content hashes of tables, for a JSON file next to them."""
    out = {"gates_passed": gates_passed, "written": time.strftime("%Y-%m-%dT%H:%M:%S"), "tables": {}}
    for name, (df, cols) in tables.items():
        n, digest = content_hash(df, cols).first()
        out["tables"][name] = {"columns": cols, "rows": n, "content_hash": digest}
    return out


class Store:
    """Tables under one folder with their manifest.

    ``callers``: the modules that may read the labels of VALIDATION and of LOCKBOX. LOCKBOX labels can be
    read once; the log remembers it.
    """

    def __init__(self, spark: SparkSession, folder: str, callers: dict[str, str] | None = None):
        self.spark, self.folder = spark, Path(folder)
        self.callers = callers or {"VALIDATION": "matchloom.operators.metric", "LOCKBOX": "matchloom.plans.lockbox"}
        self.log = self.folder / "access.log"
        self.verified: set[str] = set()
        self.manifest = json.loads((self.folder / "manifest.json").read_text())
        if not self.manifest.get("gates_passed"):
            raise IntegrityError("the manifest's gates didn't pass")

    def table(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(str(self.folder / name))
        if name not in self.verified:
            said = self.manifest["tables"][name]
            n, digest = content_hash(df, said["columns"]).first()
            if (n, digest) != (said["rows"], said["content_hash"]):
                raise IntegrityError(f"{name} isn't the table that the manifest describes")
            self.verified.add(name)
        return df

    def labels(self, split: str, caller: str | None = None) -> DataFrame:
        """Links of the rows of ``split``."""
        caller = caller or inspect.stack()[1].frame.f_globals.get("__name__", "")
        self._allow(split, caller)
        return self.table("links").join(self.table("split").filter(F.col("split") == split).select("s1_gid"), "s1_gid", "left_semi")

    def _allow(self, split: str, caller: str) -> None:
        if split == "FIT":
            return
        if caller != self.callers.get(split):
            raise LockboxError(f"{caller} may not read the labels of {split}")
        if split == "LOCKBOX":
            if self.log.exists() and any("LOCKBOX" in x for x in self.log.read_text().splitlines()):
                raise LockboxError("the lockbox has been opened before")
            with self.log.open("a") as f:
                f.write(f"{time.time():.0f} LOCKBOX {caller}\n")
