"""Deleted interpolation: bigram, unigram and uniform estimates mixed by the frequency of the context.

The corpus is cut into blocks of whole documents. A block's words are stored as numbers in a file of the shared
folder; its distinct words and word pairs, as sorted 64-bit hashes with their counts in training documents, are
dealt to shards by hash range. A shard adds up the counts of all blocks and answers every block with the totals of
its own keys. So a key crosses the network once a block and not once an occurrence, no table of counts is ever sent
whole, and every count covers all training text.

Mixture weights are learned by expectation-maximisation on held-out counts: each training document in turn is
deleted from the counts, and its tokens are then predicted from the rest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketspark.llm.common import MIX, WordHasher, Written, input_file, map_frames, mix64, new_folder, output_file, words

END, START = np.uint64(0x5C0D2E_0000_0001), np.uint64(0x5C0D2E_0000_0002)
STEPS = 4  # cells an octave of the statistics for the weights
IMPOSSIBLE = 255  # cell of probability 0


def planes(a: np.ndarray) -> bytes:
    """Values as byte planes, which compress well when sorted or small."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


class Block:
    """Whole documents as word numbers: vocab (ascending hashes), index (word number of every token), lengths, learn, doc_id."""

    def __init__(self, vocab, index, lengths, learn, doc_id, known_id):
        self.vocab, self.index, self.lengths, self.learn, self.doc_id, self.known_id = vocab, index, lengths, learn, doc_id, known_id
        self.doc = np.repeat(np.arange(len(lengths)), lengths)
        first = np.zeros(len(index), bool)
        first[np.cumsum(lengths) - lengths] = True
        self.first = first
        before = np.r_[START, vocab[index[:-1]]] if len(index) else vocab
        before[first] = START
        self.pairs, self.pair = np.unique(mix64(before * MIX + vocab[index]), return_inverse=True)

    @classmethod
    def build(cls, rows: list[tuple], hashes: list[np.ndarray]) -> Block:
        vocab, index = np.unique(np.concatenate(hashes), return_inverse=True)
        ids = [r[0] for r in rows]
        return cls(vocab, index.astype(np.uint32), np.array([len(h) for h in hashes]), np.array([r[1] for r in rows], bool),
                   np.array([0 if pd.isna(i) else int(i) for i in ids], np.int64), np.array([not pd.isna(i) for i in ids], bool))

    def write(self, name: str) -> None:
        import zstandard

        with output_file(name) as out:
            for part, kind in ((self.vocab, "<u8"), (self.index, "<u4"), (self.lengths, "<i8"), (self.learn, "u1"), (self.doc_id, "<i8"), (self.known_id, "u1")):
                data = zstandard.ZstdCompressor(level=3).compress(planes(part.astype(kind)))
                out.write(np.array([len(data)], "<i8").tobytes() + data)

    @classmethod
    def read(cls, name: str) -> Block:
        import zstandard

        parts = []
        with input_file(name) as source:
            for kind in ("<u8", "<u4", "<i8", "u1", "<i8", "u1"):
                n = int(np.frombuffer(source.read(8), "<i8")[0])
                parts.append(from_planes(zstandard.ZstdDecompressor().decompress(source.read(n)), kind))
        return cls(parts[0], parts[1], parts[2], parts[3].astype(bool), parts[4], parts[5].astype(bool))

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of every word and pair in training documents."""
        learn = self.learn[self.doc]
        return tuple(np.bincount(x[learn], minlength=n).astype("<u4") for x, n in ((self.index, len(self.vocab)), (self.pair, len(self.pairs))))


def write_blocks(docs: DataFrame, learn: Column, folder: str, tokens_per_block: int) -> DataFrame:
    """file, tokens, train_tokens and train_docs of every block."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, rows, hashes, size = WordHasher(), [], [], 0

        def close() -> pd.DataFrame:
            name = f"{folder}/{uuid.uuid4().hex}.block"
            block = Block.build(rows, hashes)
            block.write(name)
            own = int(block.lengths[block.learn].sum())
            return pd.DataFrame([(name, int(block.lengths.sum()), own, int(block.learn.sum()))], columns=["file", "tokens", "train_tokens", "train_docs"])

        for batch in batches:
            for doc_id, text, own in zip(batch.doc_id, batch.text, batch.learn):
                rows.append((doc_id, bool(own)))
                hashes.append(np.r_[hasher.hashes(words(text)), END])
                size += len(hashes[-1])
                if size >= tokens_per_block:
                    yield close()
                    rows, hashes, size = [], [], 0
        if rows:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long"), "text", learn.alias("learn"))
    return map_frames(rows, build, "file string, tokens long, train_tokens long, train_docs long")


def asked(files: DataFrame, shards: int) -> DataFrame:
    """Every block's keys and training counts, one row a shard and kind (words or pairs)."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        borders = np.array([(k << 64) // shards for k in range(1, shards)], np.uint64)
        for batch in batches:
            for file in batch.file:
                block = Block.read(file)
                for kind, keys, counts in zip(("word", "pair"), (block.vocab, block.pairs), block.counts()):
                    cuts = [0, *np.searchsorted(keys, borders).tolist(), len(keys)]
                    rows = [(file, kind, s, planes(keys[a:b]), planes(counts[a:b])) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
                    yield pd.DataFrame(rows, columns=["file", "kind", "shard", "keys", "counts"])

    return files.select("file").mapInPandas(ask, "file string, kind string, shard int, keys binary, counts binary")


def answered(questions: DataFrame) -> DataFrame:
    """For every question the totals of its keys over all blocks, and once a shard the number of keys seen in training."""

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        keys = [from_planes(k, "<u8") for k in group["keys"]]
        counts = np.concatenate([from_planes(c, "<u4") for c in group["counts"]])
        all_keys, where = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(where, weights=counts, minlength=len(all_keys)).astype("<u8")
        ends = np.cumsum([len(k) for k in keys])
        own = [planes(totals[where[e - len(k) : e]]) for e, k in zip(ends, keys)]
        seen = np.zeros(len(group), np.int64)
        seen[0] = int((totals > 0).sum())
        return pd.DataFrame({"file": group["file"], "kind": group["kind"], "shard": group["shard"], "totals": own, "seen": seen})

    return questions.groupBy("kind", "shard").applyInPandas(answer, "file string, kind string, shard int, totals binary, seen long")


def totals_of(group: pd.DataFrame, kind: str) -> np.ndarray:
    own = group[group.kind == kind].sort_values("shard")
    return np.concatenate([from_planes(t, "<u8") for t in own.totals]).astype(np.int64)


def in_document(block: Block, index: np.ndarray, width: int) -> np.ndarray:
    """For every token how often its document has the same key."""
    _, where, n = np.unique(block.doc.astype(np.int64) * width + index, return_inverse=True, return_counts=True)
    return n[where]


def context(block: Block, per_word: np.ndarray, at_start: np.ndarray | int) -> np.ndarray:
    """The context's value for every token: that of the word before it, or ``at_start``."""
    out = np.r_[0, per_word[:-1]]
    out[block.first] = at_start
    return out


def cell(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.minimum(np.round(-STEPS * np.log2(np.maximum(p, 1e-300))), IMPOSSIBLE - 1), IMPOSSIBLE).astype(np.int64)


def bucket(count: np.ndarray) -> np.ndarray:
    """Context frequency by powers of two; 0 for a context that was never seen."""
    return np.where(count > 0, np.floor(np.log2(np.maximum(count, 1))).astype(np.int64) + 1, 0)


def ratio(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    return np.where(np.asarray(b) > 0, a / np.maximum(b, 1), 0.0)


def held_out_statistics(answers: DataFrame, tokens: int, documents: int) -> DataFrame:
    """bucket, pair_cell, word_cell, n: how often deleted documents meet which estimates. Cells are a fixed grid."""

    def collect(group: pd.DataFrame) -> pd.DataFrame:
        block = Block.read(group.file.iloc[0])
        word, pair = totals_of(group, "word")[block.index], totals_of(group, "pair")[block.pair]
        own_word, own_pair = in_document(block, block.index, len(block.vocab)), in_document(block, block.pair, len(block.pairs))
        before = context(block, word, documents) - context(block, own_word, 1)
        learn = block.learn[block.doc]
        rest = tokens - block.lengths[block.doc]
        keys = bucket(before) << 16 | cell(ratio(pair - own_pair, before)) << 8 | cell(ratio(word - own_word, rest))
        found, n = np.unique(keys[learn], return_counts=True)
        return pd.DataFrame({"bucket": found >> 16, "pair_cell": found >> 8 & 255, "word_cell": found & 255, "n": n})

    cells = answers.groupBy("file").applyInPandas(collect, "bucket long, pair_cell long, word_cell long, n long")
    return cells.groupBy("bucket", "pair_cell", "word_cell").agg(F.sum("n").alias("n"))


def mixture_weights(cells: pd.DataFrame, vocabulary: int, rounds: int = 60) -> np.ndarray:
    """Weights of pair, word and uniform estimate for each bucket, by expectation-maximisation from equal weights."""
    out = np.tile([0.0, 0.5, 0.5], (66, 1))
    out[1:] = [0.4, 0.4, 0.2]
    value = lambda c: np.where(c == IMPOSSIBLE, 0.0, 2.0 ** (-c.astype(float) / STEPS))
    p = np.stack([value(cells.pair_cell.to_numpy()), value(cells.word_cell.to_numpy()), np.full(len(cells), 1 / (vocabulary + 1))], axis=1)
    b, n = cells.bucket.to_numpy(), cells.n.to_numpy(float)
    p[b == 0, 0] = 0
    for _ in range(rounds):
        share = out[b] * p
        share *= (n / np.maximum(share.sum(axis=1), 1e-300))[:, None]
        sums = np.stack([np.bincount(b, share[:, k], minlength=66) for k in range(3)], axis=1)
        seen = sums.sum(axis=1) > 0
        out[seen] = sums[seen] / sums[seen].sum(axis=1, keepdims=True)
    smallest = np.array([0.0, 0.0, 1e-6])  # an unseen word keeps some probability everywhere
    return (out + smallest) / (1 + 1e-6)


SCORES = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scored(answers: DataFrame, weights: np.ndarray, tokens: int, documents: int, vocabulary: int) -> DataFrame:
    def score(group: pd.DataFrame) -> pd.DataFrame:
        block = Block.read(group.file.iloc[0])
        word, pair = totals_of(group, "word")[block.index], totals_of(group, "pair")[block.pair]
        before = context(block, word, documents)
        own = weights[bucket(before)]
        p = own[:, 0] * ratio(pair, before) + own[:, 1] * ratio(word, tokens) + own[:, 2] / (vocabulary + 1)
        base = np.log10((word + 1) / (tokens + vocabulary + 1))
        total = lambda x: np.bincount(block.doc, x, minlength=len(block.lengths))
        ids = pd.array(block.doc_id, "Int64")
        ids[~block.known_id] = pd.NA
        return pd.DataFrame({"doc_id": ids, "n_tokens": block.lengths, "n_known": total(word > 0).astype(np.int64), "train_tokens": tokens,
                             "base_score": total(base), "score": total(np.log10(p))})

    return answers.groupBy("file").applyInPandas(score, SCORES)


def score_documents(docs: DataFrame, learn: Column, tokens_per_block: int = 1_500_000, tokens_per_shard: int = 1_000_000) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs`` (doc_id, text).

    Tokens are words between white space, A-Z lower-cased, and one end token a document; null texts are empty. Rows
    where ``learn`` is true are the training text. base_score adds one to every word's count and one word to the
    vocabulary; score is the mixture's log10 probability of the whole text. Null and repeated doc_ids keep a row
    each. Without training text every estimate but the uniform one is 0. Extra columns are ignored.
    """
    spark = docs.sparkSession
    written = Written(spark, "language-model")
    files = written.keep(write_blocks(docs, learn, new_folder(spark, "blocks"), tokens_per_block), "files")
    total = files.agg(F.sum("tokens"), F.sum("train_tokens"), F.sum("train_docs"), F.count("*")).first()
    if not total[3]:
        return spark.createDataFrame([], SCORES)
    shards = max(1, -(-total[0] // tokens_per_shard))
    answers = written.keep(answered(asked(files.repartition(total[3], "file"), shards)), "answers")
    vocabulary = answers.filter("kind = 'word'").agg(F.sum("seen")).first()[0]
    cells = held_out_statistics(answers, total[1], total[2]).toPandas()
    return scored(answers, mixture_weights(cells, vocabulary), total[1], total[2], vocabulary)
