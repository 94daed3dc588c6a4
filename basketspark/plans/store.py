"""Fitted artefacts and tables kept under a digest of what they were made from.

A store is a folder on shared storage. ``<store>/<digest>/`` holds everything made from one ledger content with one set
of parameters by one version of the code. Each artefact is written to a folder of its own and then entered in the
register of its digest, so what is entered is complete, a job that fails leaves nothing that is read, and of two
sessions that make the same artefact the first entry counts for both.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from pathlib import Path
from typing import Any, NamedTuple

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketspark.operators import boosting, segment, value
from basketspark.session import scratch_dir, shuffles_released
from basketspark.sources.ledger import read_if_present

REGISTER = "name string, kind string, path string, entered timestamp"


class Kind(NamedTuple):
    """How a fitted object is written to a folder and read back."""

    save: Callable[[SparkSession, Any, str], None]
    load: Callable[[SparkSession, str], Any]


def _save_json(spark: SparkSession, x: Any, path: str) -> None:
    spark.createDataFrame([(json.dumps(x),)], "body string").write.parquet(path)


def _load_json(spark: SparkSession, path: str) -> Any:
    return json.loads(spark.read.parquet(path).first()["body"])


def _load_scaler(spark: SparkSession, path: str) -> segment.Scaler:
    return segment.Scaler(*(tuple(x) for x in _load_json(spark, path)))


KINDS = {
    "json": Kind(_save_json, _load_json),
    "ensemble": Kind(lambda spark, m, path: m.save(spark, path), boosting.Ensemble.load),
    "kmeans": Kind(lambda spark, m, path: m.write().save(path), lambda spark, path: KMeansModel.load(path)),
    "value": Kind(lambda spark, p, path: value.params_table(spark, *p).write.parquet(path), lambda spark, path: value.load_params(spark.read.parquet(path))),
    "scaler": Kind(lambda spark, s, path: _save_json(spark, [s.mean, s.scale], path), _load_scaler),
}


def code_digest() -> str:
    """Digest of the library's own modules, so that a changed operator never reads what an older one made."""
    home, seen = Path(__file__).resolve().parents[1], hashlib.md5()
    for folder in ("functions", "operators", "plans", "sources"):
        for file in sorted((home / folder).glob("*.py")):
            seen.update(file.name.encode() + file.read_bytes())
    return seen.hexdigest()


def content_digest(df: DataFrame) -> str:
    """Digest of a table's columns and rows, whatever their order: count, sum and exclusive or of row hashes, in one pass.

    Rows are hashed twice, so that a row and its copies do not cancel each other.
    """
    columns = [F.to_json(F.struct(c)) if t.startswith("map") else F.col(c) for c, t in df.dtypes]
    row = F.xxhash64(*columns)
    r = df.select(row.alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("total"), F.bit_xor("h").alias("either"),
        F.sum(F.xxhash64(F.col("h"), F.lit("again")).cast("decimal(38,0)")).alias("second")).first()
    return hashlib.md5(json.dumps([df.dtypes, [str(x) for x in r]]).encode()).hexdigest()


def artefact_digest(parameters: dict, *tables: DataFrame) -> str:
    """The key of everything made from these tables with these parameters."""
    parts = [json.dumps(parameters, sort_keys=True, default=str), code_digest(), *map(content_digest, tables)]
    return hashlib.md5("\n".join(parts).encode()).hexdigest()


def default_store(spark: SparkSession) -> str:
    """``spark.basketspark.store`` if the session has it, else a folder beside the checkpoints."""
    return spark.conf.get("spark.basketspark.store", None) or f"{scratch_dir(spark)}/basketspark/store"


class ArtefactStore:
    """The artefacts of one digest."""

    def __init__(self, spark: SparkSession, store: str, digest: str):
        self.spark, self.root = spark, f"{store.rstrip('/')}/{digest}"
        self.register = f"{self.root}/register"
        self.entries = self._read()

    def _read(self) -> dict[str, str]:
        """Path of each artefact: the first entered, should there be several."""
        found = read_if_present(self.spark, self.register)
        if found is None:
            return {}
        return {r["name"]: r["path"] for r in found.groupBy("name").agg(F.min_by("path", F.struct("entered", "path")).alias("path")).collect()}

    def _enter(self, name: str, kind: str, path: str) -> str:
        row = self.spark.createDataFrame([(name, kind, path)], "name string, kind string, path string")
        row.select("*", F.current_timestamp().alias("entered")).coalesce(1).write.mode("append").parquet(self.register)
        self.entries = self._read()
        return self.entries[name]

    def path_of(self, name: str, write: Callable[[str], None], kind: str = "table") -> str:
        """The folder of an artefact, made by ``write`` into a new folder where there is none yet."""
        if name not in self.entries:
            path = f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"
            write(path)
            return self._enter(name, kind, path)
        return self.entries[name]

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        def write(path: str) -> None:
            built = build()
            with shuffles_released(self.spark):
                built.write.parquet(path)

        return self.spark.read.parquet(self.path_of(name, write))

    def model(self, name: str, fit: Callable[[], Any], kind: str) -> Any:
        """The stored object, fitted and written where there is none yet."""
        held: list[Any] = []

        def write(path: str) -> None:
            held.append(fit())
            KINDS[kind].save(self.spark, held[0], path)

        path = self.path_of(f"model-{name}", write, kind)
        return held[0] if held else KINDS[kind].load(self.spark, path)


def metrics_history(spark: SparkSession, store: str, digests: list[str]) -> DataFrame | None:
    """The stored metric rows of these digests, each with its digest and when it was entered; None where there are none."""
    out = None
    for digest in digests:
        kept = ArtefactStore(spark, store, digest)
        if "metrics" in kept.entries:
            entered = spark.read.parquet(kept.register).filter("name = 'metrics'").agg(F.min("entered")).first()[0]
            rows = spark.read.parquet(kept.entries["metrics"]).select(F.lit(digest).alias("digest"), F.lit(entered).alias("entered"), "*")
            out = rows if out is None else out.unionByName(rows)
    return out
