"""Vector bin packing of documents into shards: bytes, tokens and rows balanced together."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketspark.llm.common import Written, text_crc32

MEASURES = ["size", "tokens", "rows"]
WEIGHTS = np.array([8.0, 1.0, 1.0])  # of the measures in the dot product: bytes come first where not all can be even
SALTS = 4096


def measured(docs: DataFrame, overhead: int = 16) -> DataFrame:
    """doc_id, group (digest of the text), size (UTF-8 bytes plus ``overhead``), tokens (words), rows, text_crc32.

    Null texts have no bytes and no words, and form one group of their own.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.unhex(F.md5("text")), F.lit(b"null")).alias("group"),
        (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.lit(1).cast("long").alias("rows"),
        text_crc32(F.col("text")).alias("text_crc32"),
    )


def place(weights: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Shard of every group, largest first: where the weighted dot product of weights and residual room is highest.

    ``weights`` is groups x measures and ``room`` shards x measures, both as shares of one shard's capacity;
    ``room`` is reduced in place. Ties go to the smaller shard.
    """
    out = np.empty(len(weights), np.int64)
    for k in np.lexsort((np.arange(len(weights)), -(weights @ WEIGHTS))):
        out[k] = best = int(np.argmax(room @ (WEIGHTS * weights[k])))
        room[best] -= weights[k]
    return out


def shard(items: DataFrame, shards: int, split_share: float = 0.125, large_share: float = 1 / 64, groups_per_task: int = 4096) -> DataFrame:
    """``items`` (doc_id, group, size, tokens, rows, ...) with ``shard``.

    Equal groups go to one shard, except those over ``split_share`` of a shard by any measure: they are cut by
    doc_id into as many pieces as that takes, since no shard could hold them and stay even. Pieces and groups
    over ``large_share`` of a shard (at most shards / large_share a measure, so a bounded number) are placed
    first, together. All others are dealt to tasks of about ``groups_per_task`` groups, and each task places its
    own against its part of the room that is left. Rows equal in group and doc_id stay together.
    """
    written = Written(items.sparkSession, "sharding")
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    items = written.keep(items.withColumn("salt", salt.cast("int")), "items")
    by_salt = items.groupBy("group", "salt").agg(*[F.sum(m).alias(m) for m in MEASURES])
    groups = written.keep(by_salt.groupBy("group").agg(*[F.sum(m).alias(m) for m in MEASURES]), "groups")
    total = groups.agg(F.count("*").alias("n"), *[F.sum(m).alias(m) for m in MEASURES]).first()
    if not total["n"]:
        return items.drop("salt").withColumn("shard", F.lit(None).cast("int"))
    capacity = np.array([max(total[m], 1) / shards for m in MEASURES])
    share = F.greatest(*[F.col(m) / float(c) for m, c in zip(MEASURES, capacity)])
    groups = groups.withColumn("share", share)
    pieces = groups.filter(F.col("share") > large_share).select(
        "group", F.when(F.col("share") > split_share, F.ceil(F.col("share") / split_share)).otherwise(1).cast("int").alias("pieces")
    )
    piece = F.floor(F.col("salt") * F.col("pieces") / SALTS).cast("int").alias("piece")
    parts = by_salt.join(F.broadcast(pieces), "group").groupBy("group", piece).agg(*[F.sum(m).alias(m) for m in MEASURES])
    large = parts.select("group", "piece", *[(F.col(m) / float(c)).alias(m) for m, c in zip(MEASURES, capacity)]).orderBy("group", "piece").toPandas()
    room = np.ones((shards, len(MEASURES)))
    large["shard"] = place(large[MEASURES].to_numpy(float), room)
    room = np.maximum(room, 0)
    room /= np.maximum(room.sum(axis=0), 1e-12)

    def place_part(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("group", ignore_index=True)
        sums = part[MEASURES].sum().to_numpy(float)
        own = part[MEASURES].to_numpy(float) / np.maximum(sums / shards, 1e-12)
        turn = np.random.default_rng(key[0]).permutation(shards)  # else what tasks leave uneven would add up
        return pd.DataFrame({"group": part["group"], "shard": turn[place(own, (room * shards)[turn])].astype("int32")})

    tasks = max(1, -(-total["n"] // groups_per_task))
    small = (
        groups.filter(F.col("share") <= large_share)
        .withColumn("task", F.pmod(F.xxhash64("group"), F.lit(tasks)))
        .groupBy("task").applyInPandas(place_part, "group binary, shard int")
    )
    where = items.sparkSession.createDataFrame(
        [(bytes(g), int(p), int(s)) for g, p, s in zip(large["group"], large["piece"], large["shard"])], "group binary, piece int, shard int"
    )
    head = items.join(F.broadcast(pieces), "group", "left")
    head = written.keep(head.withColumn("piece", F.coalesce(F.floor(F.col("salt") * F.col("pieces") / SALTS).cast("int"), F.lit(-1))).drop("pieces", "salt"), "cut")
    placed = head.filter("piece >= 0").join(F.broadcast(where), ["group", "piece"]).unionByName(head.filter("piece < 0").join(small, "group"))
    return placed.drop("piece")


def with_slots(placed: DataFrame, shard_column: str = "shard") -> DataFrame:
    """``slot``: a gapless number from 0 within each shard.

    Rows are numbered where they lie, in each task and shard, and the tasks' counts give the offsets; no shard is
    ever collected or sorted as a whole. The rows are written first, so their order is fixed.
    """
    written = Written(placed.sparkSession, "slots")

    def number(batches):
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            order = batch.groupby(shard_column, sort=False).cumcount()
            batch["place"] = order + batch[shard_column].map(lambda s: seen.get(s, 0)).astype("int64") if len(batch) else order
            batch["task"] = task
            for s, n in batch[shard_column].value_counts().items():
                seen[s] = seen.get(s, 0) + int(n)
            yield batch

    schema = ", ".join(f"`{n}` {t}" for n, t in placed.dtypes) + ", place long, task int"
    rows = written.keep(placed.mapInPandas(number, schema), "numbered")
    before = Window.partitionBy(shard_column).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(shard_column, "task").agg(F.count("*").alias("n")).withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    slot = (F.col("first") + F.col("place")).alias("slot")
    return rows.join(offsets.select(shard_column, "task", "first"), [shard_column, "task"]).select(*placed.columns, slot)


def sharded_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Every document with shard and slot; see :func:`measured` and :func:`shard`."""
    return with_slots(shard(measured(docs), shards).select("doc_id", "size", "tokens", "text_crc32", "shard"))
