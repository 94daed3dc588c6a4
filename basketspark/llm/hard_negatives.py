"""Hard negatives by an inverted multi-index with certified windows.

Vectors are cut in two halves; each half has a codebook, fitted on a bounded sample, and a vector lies in the cell of
its two codewords. All vectors are indexed: a cell is stored in the shared folder as blocks of bounded size, each with
the largest distance of its halves from the two codewords.

An anchor's score with a vector is at most the sum of its two half-scores with the codewords plus, for each half, its
norm times the radius. Anchors visit cells by a heap over pairs of codewords (multi-sequence order), the largest summed
bound first, and read a block only if its own bound may still matter. Two walks are made: the first ends when the
positives found cannot be bettered, the second when every window is certified, that is when no unread cell can hold
a better negative for it. So the result is exact. An anchor keeps its positives and a few rows for each window, and a
task holds a bounded group of anchors and one block at a time.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketspark.llm.common import Written, input_file, map_frames, new_folder, output_file

SAMPLE = 20_000  # rows on which the codebooks are fitted
CELL = 256  # rows a cell should have; there are at most MOST_CODES codewords a half
MOST_CODES = 256
BLOCK = 2048  # rows of a stored block
GROUP = 256  # anchors that walk together
STEP = 16  # cells that an anchor visits between two looks at its bounds
BLOCKS = "code1 int, code2 int, radius1 double, radius2 double, rows int, width int, file string, start long"


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label, v (whole components floor(scale * x)) of the rows that take part, equal rows once."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>").alias("x"))
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND size(x) > 0")
    rows = rows.filter(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    most = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.filter(F.size("x") == (most["n"] if most else 0))
    return rows.select("vec_id", "label", F.transform("x", lambda c: F.floor(c * scale)).alias("v")).distinct()


def codebook(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """``k`` centres at most by Lloyd's rounds from distinct rows."""
    rng = np.random.default_rng(seed)
    own = np.unique(x, axis=0)
    centres = own[rng.choice(len(own), min(k, len(own)), replace=False)]
    for _ in range(rounds):
        near = nearest_code(x, centres)
        n = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest_code(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(axis=1) - 2 * (x @ centres.T), axis=1)


class Index:
    """The stored cells: codebooks and, read from the shared folder, the list of blocks by cell."""

    def __init__(self, books: tuple[np.ndarray, np.ndarray], blocks: pd.DataFrame, half: int, width: int, exact: bool):
        self.books, self.half, self.width, self.exact = books, half, width, exact
        blocks = blocks.sort_values(["code1", "code2", "file", "start"], ignore_index=True)
        self.blocks = list(zip(blocks.radius1, blocks.radius2, blocks.rows, blocks.width, blocks.file, blocks.start))
        cell = blocks.code1.to_numpy() * len(books[1]) + blocks.code2.to_numpy()
        self.cells = np.searchsorted(cell, np.arange(len(books[0]) * len(books[1]) + 1))
        self.radius = [np.array([0.0] * len(b)) for b in books]
        for radius, code, own in zip(self.radius, (blocks.code1, blocks.code2), (blocks.radius1, blocks.radius2)):
            np.maximum.at(radius, code.to_numpy(), own.to_numpy())

    def read(self, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """vec_ids, labels and vectors of a block."""
        _, _, n, width, file, start = self.blocks[block]
        with input_file(file) as source:
            data = source.read_at(n * (16 + width * self.width), start)
        v = np.frombuffer(data, f"<i{width}", n * self.width, 16 * n).reshape(n, -1)
        return np.frombuffer(data, "<i8", n), np.frombuffer(data, "<i8", n, 8 * n), v.astype(np.float64 if self.exact else np.int64)


class Walk:
    """One anchor's way through the cells, by falling bound of their scores."""

    def __init__(self, index: Index, q: np.ndarray):
        halves = q[: index.half], q[index.half :]
        self.at_code = [book @ h for book, h in zip(index.books, halves)]
        self.norm = [float(np.linalg.norm(h)) for h in halves]
        slack = 1e-9 * sum(n * (np.abs(b).max(initial=0) * len(h) + r.max(initial=0)) for n, b, h, r in zip(self.norm, index.books, halves, index.radius)) + 1e-6
        bounds = [a + n * r for a, n, r in zip(self.at_code, self.norm, index.radius)]
        self.order = [np.argsort(-b, kind="stable") for b in bounds]
        self.bounds, self.slack, self.n2 = [b[o].tolist() for b, o in zip(bounds, self.order)], slack, len(index.books[1])
        self.heap = [(-(self.bounds[0][0] + self.bounds[1][0]), 0, 0)]

    def bound(self) -> float:
        """No cell from here on holds a higher score."""
        return -self.heap[0][0] + self.slack if self.heap else -np.inf

    def cells(self, least: float) -> Iterator[int]:
        """The next cells, as long as they may hold a score of ``least``."""
        for _ in range(STEP):
            if not self.heap or self.bound() < least:
                return
            _, i, j = heapq.heappop(self.heap)
            if j + 1 < len(self.bounds[1]):
                heapq.heappush(self.heap, (-(self.bounds[0][i] + self.bounds[1][j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(self.bounds[0]):
                heapq.heappush(self.heap, (-(self.bounds[0][i + 1] + self.bounds[1][0]), i + 1, 0))
            yield int(self.order[0][i]) * self.n2 + int(self.order[1][j])

    def span(self, index: Index, cell: int, block: int) -> tuple[float, float]:
        """Least and greatest score that a block may hold."""
        c1, c2 = divmod(cell, self.n2)
        mid = self.at_code[0][c1] + self.at_code[1][c2]
        r1, r2 = index.blocks[block][:2]
        reach = self.norm[0] * r1 + self.norm[1] * r2 + self.slack
        return mid - reach, mid + reach


class Best:
    """The first ``k`` of the rows shown, by score falling, then id."""

    def __init__(self, k: int):
        self.k, self.score, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> float:
        return float(self.score[-1]) if len(self.score) == self.k else -np.inf

    def show(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.r_[self.score, score], np.r_[self.ids, ids]
        if len(score) > 4 * self.k:
            keep = score >= np.partition(score, -self.k)[-self.k]
            score, ids = score[keep], ids[keep]
        order = np.lexsort((ids, -score))[: self.k]
        self.score, self.ids = score[order], ids[order]


def visit(index: Index, q: np.ndarray, walks: list[Walk], least, wanted, show) -> None:
    """Walk all anchors until ``least(a)``, the score below which anchor ``a`` needs nothing, exceeds what is left.

    ``wanted(a, low, high)``: whether a block with scores in this range matters. ``show(a, score, ids, labels)`` takes
    the scores of a block. A block is read once for all anchors that want it in a round.
    """
    active = list(range(len(walks)))
    while active:
        asked: dict[int, list[int]] = {}
        for a in active:
            for cell in walks[a].cells(least(a)):
                for block in range(index.cells[cell], index.cells[cell + 1]):
                    if wanted(a, *walks[a].span(index, cell, block)):
                        asked.setdefault(block, []).append(a)
        for block in sorted(asked):
            ids, labels, v = index.read(block)
            scores = v @ q[asked[block]].T
            for a, score in zip(asked[block], scores.T.astype(np.int64)):
                show(a, score, ids, labels)
        active = [a for a in active if walks[a].heap and walks[a].bound() >= least(a)]


def mine(index: Index, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, positives: int, negatives: int, low: int, high: int) -> pd.DataFrame:
    """The rows of ``hard_negatives`` for a group of anchors."""
    q = v.astype(np.float64 if index.exact else np.int64)
    floats = v.astype(np.float64)
    near = [Best(positives) for _ in ids]

    def show_positive(a: int, score: np.ndarray, other: np.ndarray, label: np.ndarray) -> None:
        ok = (label == labels[a]) & (other != ids[a]) & (score >= near[a].least())
        if ok.any():
            near[a].show(score[ok], other[ok])

    visit(index, q, [Walk(index, f) for f in floats], lambda a: near[a].least(), lambda a, lo, hi: hi >= near[a].least(), show_positive)

    # A window asks for different-label rows with low * p <= 100 * score <= high * p, so ceil and floor in whole numbers.
    windows = [{int(p): (-(-low * int(p) // 100), high * int(p) // 100, Best(negatives)) for p in near[a].score if p >= 0} for a in range(len(ids))]

    def needed(a: int) -> float:
        return min((max(lo, best.least()) for lo, hi, best in windows[a].values()), default=np.inf)

    def wanted(a: int, least: float, most: float) -> bool:
        return any(most >= max(lo, best.least()) and least <= hi for lo, hi, best in windows[a].values())

    def show_negative(a: int, score: np.ndarray, other: np.ndarray, label: np.ndarray) -> None:
        different = (label != labels[a]) & (other != ids[a])
        for lo, hi, best in windows[a].values():
            ok = different & (score >= max(lo, best.least())) & (score <= hi)
            if ok.any():
                best.show(score[ok], other[ok])

    visit(index, q, [Walk(index, f) for f in floats], needed, wanted, show_negative)
    rows = []
    for a, own in enumerate(ids):
        for p, positive in zip(near[a].score, near[a].ids):
            if int(p) in windows[a]:
                best = windows[a][int(p)][2]
                rows += [(own, positive, k + 1, n, p, s) for k, (n, s) in enumerate(zip(best.ids, best.score))]
    return pd.DataFrame(rows, columns=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]).astype("int64")


def build_index(rows: DataFrame, written: Written) -> tuple[tuple[np.ndarray, np.ndarray], DataFrame, int, int, bool]:
    """Codebooks, the list of stored blocks, places of the first half, all places, and whether doubles hold all scores exactly."""
    spark = rows.sparkSession
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("norm")).first()
    n, d, norm = facts["n"], facts["d"] or 0, facts["norm"] or 0.0
    if norm >= 2.0**62:
        raise ValueError("scores do not fit 64 bits")
    k, half = min(MOST_CODES, max(1, round((n / CELL) ** 0.5))), (d + 1) // 2
    sample = rows.orderBy(F.xxhash64("vec_id", "label", "v")).limit(SAMPLE).select("v").collect()
    x = np.array([r["v"] for r in sample], float).reshape(len(sample), d)
    books = (codebook(x[:, :half], k, 1), codebook(x[:, half:], k, 2)) if len(x) else (np.zeros((0, half)), np.zeros((0, d - half)))
    sent, folder = spark.sparkContext.broadcast(books), new_folder(spark, "multi-index")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.stack(batch.v.to_numpy()).astype(float) if len(batch) else np.zeros((0, d))
            yield batch.assign(code1=nearest_code(x[:, :half], sent.value[0]), code2=nearest_code(x[:, half:], sent.value[1]) if half < d else 0)

    def store(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file, start, found, rest = f"{folder}/{uuid.uuid4().hex}.cells", 0, [], None
        with output_file(file) as out:

            def write(part: pd.DataFrame) -> None:
                nonlocal start
                x = np.stack(part.v.to_numpy())
                c1, c2 = int(part.code1.iloc[0]), int(part.code2.iloc[0])
                most = np.abs(x).max()
                width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
                far = [float(np.linalg.norm(h - c, axis=1).max(initial=0)) for h, c in ((x[:, :half], sent.value[0][c1]), (x[:, half:], sent.value[1][c2]))]
                data = part.vec_id.to_numpy("<i8").tobytes() + part.label.to_numpy("<i8").tobytes() + x.astype(f"<i{width}").tobytes()
                out.write(data)
                found.append((c1, c2, *far, len(part), width, file, start))
                start += len(data)

            for batch in batches:
                batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
                cell = batch.code1.to_numpy() * MOST_CODES + batch.code2.to_numpy()
                ends = np.flatnonzero(np.r_[cell[1:] != cell[:-1], False]) + 1
                cuts = [0, *ends.tolist()]
                for lo, hi in zip(cuts, [*cuts[1:], len(batch)]):
                    whole = hi < len(batch)  # the last cell may go on in the next batch
                    while hi - lo >= BLOCK or whole and hi > lo:
                        write(batch.iloc[lo : min(hi, lo + BLOCK)])
                        lo = min(hi, lo + BLOCK)
                rest = batch.iloc[lo:]
            if rest is not None and len(rest):
                write(rest)
        yield pd.DataFrame(found, columns=[c.split()[0] for c in BLOCKS.split(", ")])

    placed = written.keep(rows.mapInPandas(place, "vec_id long, label long, v array<long>, code1 int, code2 int"), "placed")
    sizes = placed.groupBy("code1", "code2").agg(F.count("*").alias("size"))
    share = F.pmod(F.xxhash64("vec_id", "v"), F.ceil(F.col("size") / (8 * BLOCK)))  # a large cell is written by several tasks
    parts = placed.join(F.broadcast(sizes), ["code1", "code2"]).withColumn("share", share)
    tasks = parts.repartition("code1", "code2", "share").sortWithinPartitions("code1", "code2", "share")
    blocks = written.keep(tasks.select("code1", "code2", "vec_id", "label", "v").mapInPandas(store, BLOCKS), "blocks")
    return books, blocks, half, d, norm < 2.0**53


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """Hard negatives of every anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors``: vec_id, label, embedding; ``anchors``: which rows are anchors. Scores are inner products of whole
    components floor(scale * x); higher come first, ties by smaller vec_id. Positives are an anchor's first rows of the
    same label, negatives for each the first of another label with low * positive <= 100 * score <= high * positive
    (none for a negative positive score). Rows without vec_id, label or vector, with null or non-finite components, or
    of another length than most take no part; rows alike in all three columns are one; other rows of an anchor's own
    vec_id are neither its positives nor its negatives. Raises if scores do not fit 64 bits.
    """
    spark, written = vectors.sparkSession, Written(vectors.sparkSession, "hard-negatives")
    rows = written.keep(usable(vectors, scale), "rows")
    books, blocks, half, d, exact = build_index(rows, written)
    listed = new_folder(spark, "multi-index") + "/blocks"

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pickle

        whole = pd.concat(list(batches) or [pd.DataFrame(columns=["code1"])])
        name = f"{listed}-{uuid.uuid4().hex}"
        with output_file(name) as out:
            out.write(pickle.dumps(whole))
        yield pd.DataFrame({"file": [name], "n": [len(whole)]})

    # The list has a row for every few hundred vectors; tasks read it from files, one for each of its partitions.
    names = [r["file"] for r in blocks.mapInPandas(save, "file string, n long").collect() if r["n"]]
    sent = spark.sparkContext.broadcast(books)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pickle

        index = None
        for batch in batches:
            for lo in range(0, len(batch), GROUP):
                if index is None:
                    parts = []
                    for name in names:
                        with input_file(name) as source:
                            parts.append(pickle.loads(source.read()))
                    index = Index(sent.value, pd.concat(parts, ignore_index=True), half, d, exact)
                part = batch.iloc[lo : lo + GROUP]
                yield mine(index, part.vec_id.to_numpy(), part.label.to_numpy(), np.stack(part.v.to_numpy()), positives, negatives, low, high)

    asked = rows.filter(anchors)
    tasks = max(spark.sparkContext.defaultParallelism, -(-asked.count() // GROUP))
    out = "anchor_id long, positive_id long, rank long, negative_id long, positive_score long, negative_score long"
    found = written.keep(map_frames(asked.repartition(tasks, "vec_id"), run, out), "found")
    return found.withColumn("rank", F.col("rank").cast("int"))


def hard_negatives_sql() -> str:
    """The query's rows as DuckDB SQL over ``embeddings``."""
    return """
    WITH taken AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
                   FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0),
    finite AS (SELECT vec_id, label, list_transform(embedding, lambda x : floor(256 * x::DOUBLE)::BIGINT) AS v FROM taken
               WHERE list_bool_and(list_transform(embedding, lambda x : x IS NOT NULL AND isfinite(x)))),
    most AS (SELECT len(v) AS n FROM finite GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
    rows_ AS (SELECT DISTINCT vec_id, label, v FROM finite, most WHERE len(v) = n),
    scores AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                      list_sum(list_transform(list_zip(a.v, b.v), lambda z : z[1] * z[2]))::BIGINT AS score
               FROM rows_ a JOIN rows_ b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    positives AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
                  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
           other_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scores USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 10
    """
