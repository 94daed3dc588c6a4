"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Documents are partitioned by the size of their shingle set (powers of two). A document of a partition with upper
size u has a one-permutation MinHash signature of 4u bins, a bin's entry being its smallest hash; items get a
signature for every partition. A long document thus has a longer signature, and a short item inside it is found as
surely as in a short one: a shared shingle meets its match unless a smaller hash of the document lies in its bin,
which has a probability under 0.12. The number of permutations makes the chance that all of an item's shared
shingles miss less than 1e-9. Candidates are then verified on the real shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketspark.llm.common import MIX, WordHasher, Written, combine, map_frames, mix64, words

BINS_PER_SHINGLE = 4
MISS = 0.12
LEAST_CHANCE = 1e-9

FOUND = "doc_id long, item_id long, item_shingles long, shared_shingles long, containment double"


def lowered(text: str | None) -> list[bytes]:
    return words(text.lower()) if text else []


def real_shingles(tokens: list[bytes], n: int) -> set[tuple]:
    """Distinct runs of n words; with fewer words the whole sequence; none without words."""
    n = min(n, len(tokens))
    return {tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1)} if n else set()


def signature(h: np.ndarray, bins: int, permutation: int) -> np.ndarray:
    """The smallest hash of every occupied bin, ascending; a hash's leading bits are its bin. ``bins``: a power of two."""
    x = np.sort(mix64(h ^ mix64(np.array([permutation + 1], np.uint64) * MIX)))
    which = x >> np.uint64(64 - bins.bit_length() + 1)
    return x[np.flatnonzero(np.diff(which, prepend=which[:1] ^ np.uint64(1)))] if len(x) else x


class ItemIndex:
    """Signatures of a bounded block of items for each size partition, built when a document of that size comes."""

    def __init__(self, items: list[tuple[int, str]], n: int, threshold: float):
        hasher = WordHasher()
        self.n, self.threshold = n, threshold
        self.items = [(i, real_shingles(lowered(t), n)) for i, t in items]
        self.items = [(i, s) for i, s in self.items if s]
        self.hashes = [np.unique(combine(hasher.hashes(lowered(t)), min(n, len(lowered(t))))) for _, t in items if lowered(t)]
        least = min((math.ceil(threshold * len(s)) for _, s in self.items), default=1)
        self.permutations = math.ceil(math.log(LEAST_CHANCE) / math.log(MISS) / max(least, 1))
        self.by_size: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.hasher = hasher

    def partition(self, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
        bins = BINS_PER_SHINGLE << (size - 1).bit_length()
        if bins not in self.by_size:
            own = []
            for p in range(self.permutations):
                parts = [signature(h, bins, p) for h in self.hashes]
                values = np.concatenate(parts)
                owners = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
                order = np.argsort(values, kind="stable")
                own.append((values[order], owners[order]))
            self.by_size[bins] = own
        return self.by_size[bins]

    def search(self, text: str | None) -> list[tuple[int, int, int]]:
        """item_id, its shingles and how many of them the text holds, for items contained to the threshold."""
        tokens = lowered(text)
        if not tokens or not self.items:
            return []
        h = np.unique(combine(self.hasher.hashes(tokens), min(self.n, len(tokens))))
        bins = BINS_PER_SHINGLE << (len(h) - 1).bit_length()
        candidates: set[int] = set()
        for p, (values, owners) in enumerate(self.partition(len(h))):
            own = signature(h, bins, p)
            lo, hi = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
            for k in np.flatnonzero(hi > lo):
                candidates.update(owners[lo[k] : hi[k]].tolist())
        if not candidates:
            return []
        real = real_shingles(tokens, self.n)
        found = ((self.items[c][0], len(self.items[c][1]), len(self.items[c][1] & real)) for c in sorted(candidates))
        return [(i, size, shared) for i, size, shared in found if shared >= self.threshold * size]


def sent_blocks(items: DataFrame, words_per_block: int) -> Iterator[Broadcast]:
    """The items with a text as (item_id, text), broadcast in blocks of about ``words_per_block`` words; one at least."""
    items = items.select(F.col("item_id").cast("long"), "text").filter("text IS NOT NULL")
    total = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    blocks = max(1, -(-total // words_per_block))
    for k in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield items.sparkSession.sparkContext.broadcast([(r.item_id, r.text) for r in block.collect()])


def contained_items(docs: DataFrame, items: DataFrame, n: int = 5, threshold: float = 0.8, words_per_block: int = 2_000_000) -> DataFrame:
    """doc_id, item_id, item_shingles, shared_shingles, containment for every item that a document contains.

    Containment: the share of an item's distinct n-word shingles (lower case, words between white space) that the
    whole text of the document has. A text of fewer words is one shingle of all its words. Null or wordless items
    and documents match nothing; repeated rows of documents or items give a row each. ``docs``: doc_id, text;
    ``items``: item_id, text. Items go to the tasks in blocks of about ``words_per_block`` words, each read against
    all documents, so neither side is shuffled and what is sent at once does not grow.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    found = []
    for sent in sent_blocks(items, words_per_block):

        def search(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            index = ItemIndex(sent.value, n, threshold)
            for batch in batches:
                rows = [(d, i, size, shared, shared / size) for d, t in zip(batch.doc_id, batch.text) for i, size, shared in index.search(t)]
                out = pd.DataFrame(rows, columns=["doc_id", "item_id", "item_shingles", "shared_shingles", "containment"])
                yield out.astype({"doc_id": "Int64", "item_id": "Int64"})

        found.append(map_frames(docs, search, FOUND))
    return reduce(DataFrame.unionByName, found)


def holds_none(sent: Broadcast, n: int, threshold: float):
    """A column function: whether a text contains no item of a block."""

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = ItemIndex(sent.value, n, threshold)
        for batch in batches:
            yield pd.Series([not index.search(t) for t in batch], dtype=bool)

    return clean


def without_contaminated(docs: DataFrame, items: DataFrame, n: int = 5, threshold: float = 0.8, words_per_block: int = 2_000_000) -> DataFrame:
    """``docs`` without the rows whose text contains an item; every row is judged by its own text, whatever its doc_id.

    What one block of items leaves is written before the next, so a task holds one block.
    """
    written, last = Written(docs.sparkSession, "uncontaminated"), None
    for k, sent in enumerate(sent_blocks(items, words_per_block)):
        if last is not None:
            docs = written.keep(last, f"left{k}")
            written.drop(f"left{k - 1}")
        last = docs.filter(holds_none(sent, n, threshold)("text"))
    return last


def contained_sql(n: int = 5, threshold: float = 0.8) -> str:
    """The exact result in DuckDB SQL over ``documents`` and ``benchmark``."""

    def shingles(name: str, key: str) -> str:
        return f"""{name} AS (
  SELECT DISTINCT row_id, {key}, unnest(list_transform(range(1, greatest(len(w) - {n} + 1, 1) + 1), lambda i: array_to_string(list_slice(w, i, i + {n} - 1), ' '))) AS s
  FROM (SELECT row_number() OVER () AS row_id, {key}, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS w FROM {'documents' if key == 'doc_id' else 'benchmark'}) WHERE len(w) > 0)"""

    return f"""
WITH {shingles('d', 'doc_id')}, {shingles('b', 'item_id')},
sizes AS (SELECT row_id, count(*) AS n FROM b GROUP BY 1),
shared AS (SELECT d.row_id AS dr, b.row_id AS br, d.doc_id, b.item_id, count(*) AS k FROM b JOIN d USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n AS item_shingles, k AS shared_shingles, k::DOUBLE / n AS containment
FROM shared JOIN sizes ON br = sizes.row_id WHERE k >= {threshold} * n"""
