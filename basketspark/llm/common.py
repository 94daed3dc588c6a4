"""Shared helpers: input tables, written intermediate tables, shared files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketspark.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A given table, reduced to the named columns."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name in the shared scratch folder."""
    return f"{scratch_dir(spark)}/llm/{purpose}-{uuid.uuid4().hex}"


class Written:
    """Tables written to the shared folder, so that each is computed once and survives lost executors.

    ``keep`` writes a table and reads it back; ``drop`` deletes those that no later step reads.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.root, self.paths = spark, new_folder(spark, purpose), {}

    def path(self, name: str) -> str:
        """A folder for a table of this name."""
        path = f"{self.root}/{name}-{len(self.paths)}"
        self.paths[path] = name
        return path

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for path in [p for p, n in self.paths.items() if n in names]:
            delete_folder(self.spark, path)
            self.paths[path] = ""


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this library through the cluster's file system."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


@contextmanager
def output_file(uri: str) -> Iterator:
    """A file in the shared folder opened for writing from a task; parents are created."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(_absolute(uri))
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        yield out


@contextmanager
def input_file(uri: str) -> Iterator:
    """A file in the shared folder opened for random reads from a task."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(_absolute(uri))
    with system.open_input_file(path) as source:
        yield source


def written_numbers(uri: str, folder: str, column: str) -> np.ndarray:
    """From a task: a column of whole numbers from the Parquet files in a folder of a finished table; empty if it has no such folder."""
    from pyarrow import fs, parquet

    system, path = fs.FileSystem.from_uri(_absolute(uri))
    if system.get_file_info(f"{path}/_SUCCESS").type != fs.FileType.File:
        raise FileNotFoundError(f"{uri} is not a finished table")
    files = system.get_file_info(fs.FileSelector(f"{path}/{folder}", allow_not_found=True))
    found = []
    for f in files:
        if f.path.endswith(".parquet"):
            with system.open_input_file(f.path) as source:
                found.append(parquet.read_table(source, columns=[column])[column].to_numpy())
    return np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)


def _absolute(uri: str) -> str:
    return uri if "://" in uri else "file://" + uri.removeprefix("file:")


def map_frames(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInPandas`` with exact 64-bit integers: a whole-number column that holds nulls arrives as ``Int64``, not as doubles."""
    import pyarrow as pa

    plain = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [field.rsplit(" ", 1) for field in schema.split(", ")]
    kind = {t: pa.list_(pa.field("element", plain[t[6:-1]])) if t.startswith("array<") else plain[t] for _, t in fields}
    out = pa.schema([(name.strip("`"), kind[t]) for name, t in fields])

    def frame(batch: pa.RecordBatch) -> pd.DataFrame:
        exact = {pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype()}
        return pd.DataFrame({name: c.to_pandas(types_mapper=exact.get if c.null_count else None) for name, c in zip(batch.schema.names, batch.columns)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for result in fn(map(frame, batches)):
            yield from pa.Table.from_pandas(result, out, preserve_index=False).combine_chunks().to_batches()

    return df.mapInArrow(run, schema)


def text_crc32(text: Column) -> Column:
    """Unsigned crc32 of the UTF-8 bytes; null counts as empty."""
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).cast("bigint")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the identifier as text, modulo; a null identifier counts as empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")), F.lit(modulus))


def words(text: str | None) -> list[bytes]:
    """Runs of anything but space, tab, line feed, vertical tab, form feed and return, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


MIX = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHasher:
    """64-bit hashes of words and of shingles of words, with a bounded memory of words already hashed."""

    def __init__(self, limit: int = 400_000):
        self.limit, self.known = limit, {}

    def hashes(self, tokens: list[bytes]) -> np.ndarray:
        import xxhash

        known = self.known
        if len(known) > self.limit:
            known.clear()
        for w in set(tokens).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))

    def shingles(self, text: str | None, n: int) -> np.ndarray:
        """Sorted distinct n-word shingles; with fewer words, the whole sequence as one; none without words."""
        h = self.hashes(words(text))
        return np.unique(combine(h, min(n, len(h)))) if len(h) else h


def combine(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n consecutive word hashes; n is part of the hash."""
    m = len(h) - n + 1
    out = np.full(m, n, np.uint64)
    for k in range(n):
        out = mix64(out * MIX + h[k : k + m])
    return out
