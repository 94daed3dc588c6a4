"""Best-two-fit packing of tokenised documents into sequences of bounded length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketspark.llm.common import Written, map_frames
from basketspark.llm.tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Token ids of every whole document plus an end id, cut into pieces of at most ``length``.

    Only longer documents are cut: all pieces are full but the first, which may be shorter. A null or empty text
    is the end id alone; null and repeated doc_ids are kept, one set of pieces a row. ``docs`` needs doc_id and
    text, other columns are ignored. ``with_ids`` adds the ids themselves as little-endian 32-bit values.
    """
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.doc_id, encode.ids(list(batch.text))):
                ids += end
                n, at, piece = len(ids) // 4, 0, 0
                while at < n:
                    to = at + ((n - at - 1) % length + 1 if piece == 0 else length)
                    part = ids[4 * at : 4 * to]
                    rows.append((doc_id, piece, at, to - at, zlib.crc32(part), part)[: 6 if with_ids else 5])
                    at, piece = to, piece + 1
            yield frame(rows, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if with_ids else 5])

    return map_frames(docs.select(F.col("doc_id").cast("long"), "text"), cut, PIECES + (", ids binary" if with_ids else ""))


def frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, dtype=object, columns=columns)
    return out.astype({c: "Int64" if c == "doc_id" else "int64" for c in columns if c != "ids"})


class Stock:
    """How many unpacked pieces there are of each length, and the largest available length up to any bound."""

    def __init__(self, lengths: np.ndarray, room: int):
        self.count = np.bincount(lengths, minlength=room + 1)
        self.down = np.maximum.accumulate(np.where(self.count > 0, np.arange(room + 1), 0))

    def largest(self, bound: int) -> int:
        return int(self.down[bound]) if bound > 0 else 0

    def take(self, size: int) -> None:
        self.count[size] -= 1
        if not self.count[size]:  # longer bounds that led here now lead to the next smaller length
            end = size + int(np.argmax(self.down[size:] != size)) if self.down[-1] != size else len(self.down)
            self.down[size:end] = self.down[size - 1]

    def give(self, size: int) -> None:
        self.count[size] += 1
        if self.count[size] == 1:
            above = self.down[size:]
            above[above < size] = size

    def best_two(self, room: int) -> tuple[int, int]:
        """Two available lengths with the largest sum within ``room``; (0, 0) if there are none."""
        first = np.flatnonzero(self.count[: room + 1])
        if not len(first):
            return 0, 0
        second = self.down[room - first]
        alone = (second == first) & (self.count[first] < 2)  # the same piece can't be taken twice
        second = np.where(alone, self.down[np.maximum(first - 1, 0)], second)
        total = np.where(second > 0, first + second, 0)
        best = int(np.argmax(total))
        return (int(first[best]), int(second[best])) if total[best] else (0, 0)


def best_two_fit(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place of every piece.

    Each bin is filled greedily, largest first. If a gap is left, its smallest piece gives way to the two
    unpacked pieces that fill gap plus smallest most tightly, when they are larger together than it was.
    Equal lengths are told apart by position: earlier pieces go into earlier bins.
    """
    stock, bins = Stock(lengths, room), []
    left = len(lengths)
    while left:
        content, gap = [], room
        while size := stock.largest(gap):
            stock.take(size)
            content.append(size)
            gap -= size
        if gap and len(content) > 1:
            smallest = content[-1]
            a, b = stock.best_two(gap + smallest)
            if a + b > smallest:
                stock.take(a)
                stock.take(b)
                stock.give(smallest)
                content[-1:] = [a, b]
        left -= len(content)
        bins.append(content)
    waiting = np.argsort(lengths, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(lengths, minlength=room + 1))])
    used = np.zeros(room + 2, np.int64)
    which, place = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for k, content in enumerate(bins):
        at = 0
        for size in content:
            row = waiting[first[size] + used[size]]
            used[size] += 1
            which[row], place[row] = k, at
            at += size
    return which, place


def pack(pieces: DataFrame, length: int = 2048, pieces_per_task: int = 20_000) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; every sequence has at most ``length`` tokens.

    Pieces are dealt at random to tasks of about ``pieces_per_task``, and each task packs its own. More data
    means more tasks; a task leaves at most a few badly filled sequences, a share that does not grow. Pieces of
    full length fill a sequence each. Repeated rows are packed one by one; an empty table gives an empty result.
    """
    written = Written(pieces.sparkSession, "packing")
    number = "piece number"
    while number in pieces.columns:
        number += "_"
    pieces = written.keep(pieces.withColumn(number, F.monotonically_increasing_id()), "pieces")
    tasks = max(1, -(-pieces.count() // pieces_per_task))
    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes)

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        rows = [b for b in batches if len(b)]
        if rows:
            own = pd.concat(rows, ignore_index=True)
            which, own["offset"] = best_two_fit(own["length"].to_numpy(), length)
            own["sequence_id"] = which + (TaskContext.get().partitionId() << 32)
            yield own

    # Dealt by a number of their own: rows that are alike in all columns go to different tasks.
    return map_frames(pieces.repartition(tasks, F.xxhash64(number)), packed, f"{schema}, offset long, sequence_id long").drop(number)


def packed_documents(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, offset and sequence_id of every piece of every document."""
    return pack(token_pieces(docs, tokenizer, length, end_id), length)
