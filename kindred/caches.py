"""Stage caches: tables written under a key of all that they depend on, read instead of being made again.

A key is the hash of a stage's name, its parameters, the code it runs and its
parent's key, so a change anywhere ahead changes it.  A table counts only when
its success mark is there; a write that was cut short is made again.
"""

import hashlib
import inspect
import json
import os
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession

VERSION = 1
_TRUE = ("1", "true", "yes", "on")


def enabled(value: str | None) -> bool:
    """Whether a setting turns caches on; they are on where it is unset."""
    return value is None or value.strip().lower() in _TRUE


def stable_key(payload: dict) -> str:
    return hashlib.sha256(json.dumps(payload, sort_keys=True, ensure_ascii=False, default=str).encode()).hexdigest()


def code_hash(*modules: ModuleType) -> str:
    """The hash of modules' sources."""
    return stable_key({m.__name__: inspect.getsource(m) for m in modules})


def input_signature(spark: SparkSession, path: str) -> dict:
    """Size and time of a file or folder, by the file system that Spark reads it with."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    summary = fs.getContentSummary(p)
    return {"path": str(fs.makeQualified(p)), "bytes": summary.getLength(), "files": summary.getFileCount(), "time": fs.getFileStatus(p).getModificationTime()}


class StageCache:
    """Tables under root/stage/key; `used` tells for each stage whether its table was there."""

    def __init__(self, spark: SparkSession, root: str, on: bool = True):
        self.spark, self.root, self.on, self.used = spark, root.rstrip("/"), on, {}

    def path(self, stage: str, key: str) -> str:
        return f"{self.root}/{stage}/{key}"

    def has(self, stage: str, key: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path(stage, key)}/_SUCCESS")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def table(self, stage: str, make: Callable[[], DataFrame], parent: str = "", code: str = "", **params) -> tuple[DataFrame, str]:
        """(the stage's table, its key): read if it is there, else made, written and read back."""
        key = stable_key({"version": VERSION, "stage": stage, "parent": parent, "code": code, "params": params})
        if not self.on:
            return make(), key
        self.used[stage] = self.has(stage, key)
        if not self.used[stage]:
            make().write.mode("overwrite").parquet(self.path(stage, key))
        return self.spark.read.parquet(self.path(stage, key)), key

    def status(self) -> dict[str, dict]:
        return {stage: {"enabled": int(self.on), "used": int(used)} for stage, used in self.used.items()}


def default_root() -> str:
    return os.path.join(".cache", "kindred")
