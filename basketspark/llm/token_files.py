"""Token-id files: a concatenated id array with Elias-Fano coded document borders.

A file holds, in this order: the ids, the coded borders, the coded doc_ids, and a trailer of little-endian signed
64-bit values (documents, ids, null doc_ids, smallest doc_id, for both coded sequences their low bits and numbers
of words, bytes of an id, magic). A coded sequence of n values below u is a low part (l bits a value), a high part
(for each value a 1-bit at position (value >> l) + index) and for every 256th value the position of its 1-bit.
The borders are 0 and the ends of the documents in order. A border is read by jumping to its sample and counting
1-bits from there: about 2 + log2(u / n) bits a document instead of 64. Ascending doc_ids are coded alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketspark.llm.common import Written, input_file, map_frames, output_file
from basketspark.llm.tokens import encoder

MAGIC = 0x31_46_45_54  # fixed value
SAMPLE = 256


class EliasFano:
    """A non-decreasing sequence of integers in near-minimal space, with ``select`` by index."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        values, n = values.astype(np.uint64), len(values)
        bits = max(0, int(universe // max(n, 1)).bit_length() - 1)
        low = pack_bits(values & np.uint64((1 << bits) - 1), bits)
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros(-(-(int(ones[-1]) + 1 if n else 1) // 64) * 64, np.uint8)
        flags[ones] = 1
        return cls(n, bits, low, np.packbits(flags, bitorder="little").view("<u8"), ones[::SAMPLE].astype("<u8"))

    def select(self, index: int) -> int:
        """The value with this index."""
        at = int(self.samples[index // SAMPLE])
        left, word = index % SAMPLE, at // 64
        bits = int(self.high[word]) >> (at % 64) << (at % 64)  # from the sample's own 1-bit on
        while (here := bits.bit_count()) <= left:
            left, word = left - here, word + 1
            bits = int(self.high[word])
        for _ in range(left):
            bits &= bits - 1
        one = word * 64 + (bits & -bits).bit_length() - 1
        return (one - index) << self.low_bits | self.low_value(index)

    def low_value(self, index: int) -> int:
        if not self.low_bits:
            return 0
        word, shift = divmod(index * self.low_bits, 64)
        value = int(self.low[word]) >> shift
        if shift + self.low_bits > 64:
            value |= int(self.low[word + 1]) << (64 - shift)
        return value & ((1 << self.low_bits) - 1)

    def all(self) -> np.ndarray:
        """Every value, decoded together."""
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))[: self.n]
        low = unpack_bits(self.low, self.low_bits, self.n)
        return ((ones - np.arange(self.n)) << self.low_bits) | low

    @property
    def bits_used(self) -> int:
        return 64 * (len(self.low) + len(self.high) + len(self.samples))

    @property
    def layout(self) -> list[int]:
        return [self.low_bits, len(self.low), len(self.high), len(self.samples)]

    @classmethod
    def stored(cls, n: int, layout: list[int], words: np.ndarray) -> EliasFano:
        bits, low, high, samples = layout
        return cls(n, bits, words[:low], words[low : low + high], words[low + high : low + high + samples])


def pack_bits(values: np.ndarray, bits: int) -> np.ndarray:
    if not bits or not len(values):
        return np.zeros(0, "<u8")
    flags = ((values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
    return np.packbits(np.pad(flags, (0, -len(flags) % 64)), bitorder="little").view("<u8")


def unpack_bits(packed: np.ndarray, bits: int, n: int) -> np.ndarray:
    if not bits:
        return np.zeros(n, np.int64)
    flags = np.unpackbits(packed.view(np.uint8), bitorder="little")[: n * bits].reshape(n, bits)
    return flags.astype(np.int64) @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, documents_per_file: int = 10_000) -> DataFrame:
    """Encode whole texts and write id files in ascending doc_id order; returns one row a file.

    Columns: file, n_docs, n_ids, part. Null texts are empty and hold the end id alone; null doc_ids
    come first; rows with equal doc_id are ordered by text. Ids take two bytes where the vocabulary allows it.
    Each attempt of a task writes a file of its own, and only files named in the result count, so a lost
    executor leaves at most a file that nobody reads. Documents stream through a task; only their lengths are kept.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    files = max(1, -(-docs.count() // documents_per_file))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        narrow = encode.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16
        kind, end = ("<u2" if narrow else "<u4"), np.array([end_id], "<u4").tobytes()
        lengths, doc_ids, nulls = [], [], 0
        name = f"{folder}/{part:05d}-{uuid.uuid4().hex}.ids"
        with output_file(name) as out:
            for batch in batches:
                for doc_id, whole in zip(batch.doc_id, encode.ids(list(batch.text))):
                    ids = np.frombuffer(whole + end, "<u4")
                    lengths.append(len(ids))
                    if pd.isna(doc_id):
                        nulls += 1
                    else:
                        doc_ids.append(int(doc_id))
                    out.write(ids.astype(kind).tobytes())
            total, least = sum(lengths), min(doc_ids, default=0)
            borders = EliasFano.encode(np.concatenate([[0], np.cumsum(lengths)]), total)
            own = EliasFano.encode(np.array([i - least for i in doc_ids], np.uint64), max(doc_ids, default=0) - least)
            for block in (borders.low, borders.high, borders.samples, own.low, own.high, own.samples):
                out.write(block.tobytes())
            trailer = [len(lengths), total, nulls, least, *borders.layout, *own.layout, int(kind[-1]), MAGIC]
            out.write(np.array(trailer, "<i8").tobytes())
        if lengths:
            yield pd.DataFrame([(name, len(lengths), total, part)], columns=["file", "n_docs", "n_ids", "part"])

    ordered = rows.repartitionByRange(files, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return Written(spark, "token-files").keep(map_frames(ordered, write, "file string, n_docs long, n_ids long, part int"), "files")


class TokenFile:
    """Reads one id file: borders by select, ids by range."""

    def __init__(self, source):
        size, trailer = source.size(), 8 * 14
        fields = np.frombuffer(source.read_at(trailer, size - trailer), "<i8").tolist()
        self.n_docs, self.n_ids, self.nulls, self.least = fields[:4]
        own, ids, (self.width, magic) = fields[4:8], fields[8:12], fields[12:]
        if magic != MAGIC:
            raise ValueError("not a token-id file, or not finished")
        n_words = sum(own[1:]) + sum(ids[1:])
        words = np.frombuffer(source.read_at(8 * n_words, size - trailer - 8 * n_words), "<u8")
        self.borders = EliasFano.stored(self.n_docs + 1, own, words)
        self.doc_ids = EliasFano.stored(self.n_docs - self.nulls, ids, words[sum(own[1:]) :])
        self.source = source

    def ids(self, start: int, end: int) -> np.ndarray:
        return np.frombuffer(self.source.read_at((end - start) * self.width, start * self.width), f"<u{self.width}").astype("<u4")

    def document(self, index: int) -> np.ndarray:
        """Ids of one document, found through two selects."""
        return self.ids(self.borders.select(index), self.borders.select(index + 1))


def with_starts(files: DataFrame) -> DataFrame:
    """Files with ``first``: the ids in all files before. One row a file, so the window is small."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(files: DataFrame, ids_per_read: int = 1_000_000) -> DataFrame:
    """One row a document, in file order: doc_id, part, index, start (ids before it in all files), ids (binary, 32 bit).

    A file is read in runs of documents of about ``ids_per_read`` ids.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, part, first in zip(batch.file, batch.part, batch["first"]):
                with input_file(file) as source:
                    stored = TokenFile(source)
                    borders = stored.borders.all()
                    doc_ids = pd.array([pd.NA] * stored.nulls + (stored.doc_ids.all() + stored.least).tolist(), "Int64")
                    lo = 0
                    while lo < stored.n_docs:
                        hi = max(lo + 1, int(np.searchsorted(borders, borders[lo] + ids_per_read, "right")) - 1)
                        own = borders[lo : hi + 1]
                        ids = stored.ids(int(own[0]), int(own[-1]))
                        cut = [ids[a:b].tobytes() for a, b in zip(own[:-1] - own[0], own[1:] - own[0])]
                        yield pd.DataFrame({"doc_id": doc_ids[lo:hi], "part": part, "index": np.arange(lo, hi), "start": first + own[:-1], "ids": cut})
                        lo = hi

    n = max(1, files.count())
    return with_starts(files).repartition(n, "part").mapInPandas(read, "doc_id long, part int, index long, start long, ids binary")
