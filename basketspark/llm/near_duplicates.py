"""Near-duplicate documents by an LSH forest, confirmed on full shingle sets.

Every distinct shingle set has 128 MinHash values. Twenty trees each order the sets by their own sequence of
values; sets that share the first four are in one region of a tree. Candidates are, first, neighbours in sorted
order, whose common prefix is the longest: in a dense region that is a deep level of the tree, in a sparse one a
shallow level. Confirmed links join sets into classes. Then every region that still holds several classes is
compared as a whole, class against class: once along the pairs that would join all its classes, and at last every
pair that may be similar is judged where it lies. So large groups send about a link a member, and no link between
classes is given up to save work.

A pair of similarity 0.8 is in no common region of any tree with a probability under 3e-5, and is taken for less
similar by its 128 values with one under 1e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketspark.llm.common import MIX, WordHasher, Written, map_frames, mix64, written_numbers
from basketspark.llm.components import components

VALUES, TREES, DEPTH = 128, 20, 4
CHUNK, BLOCK = 2048, 512  # rows of a chunk; rows compared at once
LITTLE = 16
SET_BYTES = 6
PAIRS = "a long, b long, block long"
NUMBER_BITS = 33  # monotonically_increasing_id: the task above these bits, its rows below

_rng = np.random.default_rng(20_240_601)
FACTORS = (_rng.integers(0, 2**32, VALUES, dtype=np.uint64) | 1).astype(np.uint32)[:, None]
SHIFTS = _rng.integers(0, 2**32, VALUES, dtype=np.uint64).astype(np.uint32)[:, None]


def minhash(h: np.ndarray, block: int = 4096) -> np.ndarray:
    """128 MinHash values of a set of 64-bit hashes."""
    x, out = (h >> np.uint64(32)).astype(np.uint32), np.full(VALUES, 2**32 - 1, np.uint32)
    for lo in range(0, len(x), block):
        np.minimum(out, (x[None, lo : lo + block] * FACTORS + SHIFTS).min(axis=1), out=out)
    return out


def regions(values: np.ndarray) -> np.ndarray:
    """For each tree a hash of its number and its first values."""
    own = values[: TREES * DEPTH].reshape(TREES, DEPTH).astype(np.uint64)
    out = np.arange(1, TREES + 1, dtype=np.uint64)
    for k in range(DEPTH):
        out = mix64(out * MIX + own[:, k])
    return out.view(np.int64)


def described(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n (size of the shingle set), set_id (hash of the set), signature (a byte a value), trees (the region in every tree, as bytes)."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        hasher = WordHasher()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.doc_id, batch.text):
                h = hasher.shingles(text, words)
                if len(h):
                    v = minhash(h)
                    short = ((v * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8)
                    rows.append((doc_id, len(h), xxhash.xxh3_64_intdigest(h.tobytes()) - 2**63, short.tobytes(), regions(v).tobytes()))
                else:
                    rows.append((doc_id, 0, None, None, None))
            out = pd.DataFrame(rows, dtype=object, columns=["doc_id", "n", "set_id", "signature", "trees"])  # no doubles beside nulls
            yield out.astype({"doc_id": "Int64", "n": "int64", "set_id": "Int64"})

    return map_frames(docs.select(F.col("doc_id").cast("long"), "text"), describe, "doc_id long, n long, set_id long, signature binary, trees binary")


def places_of(sets: DataFrame) -> DataFrame:
    """set_id, tree, region: a row for every tree of a set."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.frombuffer(b"".join(batch.trees), np.int64)
            yield pd.DataFrame({"set_id": np.repeat(batch.set_id.to_numpy(np.int64), TREES), "tree": np.tile(np.arange(TREES, dtype=np.int32), len(batch)), "region": found})

    return sets.select("set_id", "trees").mapInPandas(unpack, "set_id long, tree int, region long")


def order_of(tree: Column) -> Column:
    """The signature in the order of a tree: its own values first, then the others."""
    return F.expr(f"concat(substring(signature, tree * {DEPTH} + 1), substring(signature, 1, tree * {DEPTH}))")


def agreeing(percent: int) -> int:
    """The least number of agreeing signature bytes that a pair of this similarity has but for five standard errors."""
    s = percent / 100
    return int(VALUES * s - 5 * np.sqrt(VALUES * s * (1 - s)))


def neighbours(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b that follow each other in the sorted order of a region and may be similar; block: a stretch of that order."""
    least = agreeing(percent)

    def adjacent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        last, at, task = None, 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            if last is not None:
                batch = pd.concat([last, batch], ignore_index=True)
            if len(batch) > 1:
                sig = np.frombuffer(b"".join(batch.signature), np.uint8).reshape(-1, VALUES)
                region, n, sid = batch.region.to_numpy(), batch.n.to_numpy(), batch.set_id.to_numpy()
                near = (region[1:] == region[:-1]) & ((sig[1:] == sig[:-1]).sum(axis=1) >= least)
                near &= 100 * np.minimum(n[1:], n[:-1]) >= percent * np.maximum(n[1:], n[:-1])
                block = task + (at + np.arange(len(near))) // CHUNK
                yield pd.DataFrame({"a": np.minimum(sid[1:], sid[:-1])[near], "b": np.maximum(sid[1:], sid[:-1])[near], "block": block[near]})
                at += len(near)
            last = batch.tail(1)

    sorted_rows = rows.repartition("region").withColumn("order", order_of(F.col("tree"))).sortWithinPartitions("region", "order", "set_id")
    pairs = sorted_rows.select("region", "set_id", "n", "signature").mapInPandas(adjacent, PAIRS)
    return pairs.groupBy("a", "b").agg(F.min("block").alias("block"))


def class_tasks(rows: DataFrame) -> DataFrame:
    """The regions that hold several classes, dealt to comparison tasks region, i, j, with a row's own chunk.

    ``rows``: region, set_id, label. Regions over CHUNK rows are cut into chunks of about that
    size: a large class into chunks of its own, small ones together. Every two chunks are a task, but for those that
    hold one and the same class, so a large class meets the few rows beside it and not itself.
    """
    mixed = rows.groupBy("region").agg(F.count("*").alias("size"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
    rows = rows.join(mixed.select("region", "size"), "region")
    columns = ["set_id", "label"]
    small = rows.filter(f"size <= {CHUNK}").select("region", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("chunk"), *columns)
    large = rows.filter(f"size > {CHUNK}")
    by_label = large.groupBy("region", "label").agg(F.count("*").alias("own"))
    large = large.join(by_label, ["region", "label"])
    few = F.pmod(F.xxhash64("label"), F.ceil(F.col("size") / CHUNK)).cast("int")
    many = F.pmod(F.xxhash64("set_id"), F.ceil(F.col("own") / CHUNK)).cast("int")
    chunk = F.when(F.col("own") <= CHUNK // 4, few).otherwise(F.pmod(F.xxhash64("label", many), F.lit(2**30)).cast("int") + (2**30 - 1))
    large = large.withColumn("chunk", chunk)
    chunks = large.groupBy("region", "chunk").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    other = chunks.select("region", F.col("chunk").alias("other"), F.col("lo").alias("other_lo"), F.col("hi").alias("other_hi"))
    pairs = chunks.join(other, "region").filter("NOT (lo = hi AND other_lo = other_hi AND lo = other_lo)").select("region", "chunk", "other")
    dealt = large.join(pairs, ["region", "chunk"]).select("region", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", *columns)
    return small.unionByName(dealt)


def in_tasks(tasks: DataFrame, run, schema: str) -> DataFrame:
    """``run`` on runs of complete tasks."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in whole_groups(batches, ["region", "i", "j"]):
            yield from run(part.reset_index(drop=True))

    return tasks.repartition("region", "i", "j").sortWithinPartitions("region", "i", "j").mapInPandas(each, schema)


def spanning_pairs(tasks: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b of different classes that may be similar: the most similar ones that would join all classes of a task; block: the task."""
    least = agreeing(percent)

    def run(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
        x, y, group = similar_pairs(part, percent, least)
        label, sid = part.label.to_numpy(), part.set_id.to_numpy()
        keep = spanning(group, label[x], label[y])
        block = (part.region + part.i * 1_000_003 + part.j).to_numpy()[x]
        yield pd.DataFrame({"a": np.minimum(sid[x], sid[y])[keep], "b": np.maximum(sid[x], sid[y])[keep], "block": block[keep]})

    return in_tasks(tasks, run, PAIRS).groupBy("a", "b").agg(F.min("block").alias("block"))


def undecided(tasks: DataFrame, percent: int) -> DataFrame:
    """The rows of ``tasks`` that may be similar to one of another class there."""
    least = agreeing(percent)

    def run(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
        x, y, _ = similar_pairs(part, percent, least)
        yield part.iloc[np.unique(np.r_[x, y])]

    return in_tasks(tasks, run, tasks_schema(tasks))


def tasks_schema(tasks: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in tasks.dtypes)


def links_across(tasks: DataFrame, percent: int) -> DataFrame:
    """Links a, b between the labels of different classes, confirmed on the full sets in column ``members``.

    Every pair of different classes that may be similar is judged in the first tree that has both in one region,
    except where links found before in the same task have joined their classes; so only links leave a task, and fewer
    than it has classes.
    """
    least = agreeing(percent)

    def run(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
        x, y, group = similar_pairs(part, percent, least)
        label, sets = part.label.to_numpy(), part.members.to_numpy()
        known: dict[int, np.ndarray] = {}

        def full(k: int) -> np.ndarray:
            if k not in known:
                if len(known) > CHUNK:
                    known.clear()
                known[k] = unpacked(sets[k])
            return known[k]

        keep = spanning(group, label[x], label[y], lambda k: similar(full(x[k]), full(y[k]), percent))
        yield stars(label[x][keep], label[y][keep])

    return in_tasks(tasks, run, "a long, b long").distinct()


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Runs of complete groups of rows with equal keys from sorted batches."""
    rest = None
    for batch in batches:
        batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if not len(batch):
            continue
        values = batch[keys].to_numpy()
        change = np.flatnonzero((values[1:] != values[:-1]).any(axis=1))
        last = int(change[-1]) + 1 if len(change) else 0
        if last:
            yield batch.iloc[:last]
        rest = batch.iloc[last:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest


def similar_pairs(part: pd.DataFrame, percent: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers x and y and task number of all pairs of different classes in a task that may be similar, most similar first.

    Pairs that an earlier tree has in one region are left to that region.
    """
    region, i, j, chunk, label, n = (part[c].to_numpy() for c in ("region", "i", "j", "chunk", "label", "n"))
    sig = np.frombuffer(b"".join(part.signature), np.uint8).reshape(-1, VALUES)
    trees = np.frombuffer(b"".join(part.trees), np.int64).reshape(-1, TREES)
    new = np.r_[True, (region[1:] != region[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]
    group, starts = np.cumsum(new) - 1, np.flatnonzero(new)
    sizes = np.diff(np.r_[starts, len(part)])
    found = []

    def keep(x: np.ndarray, y: np.ndarray, same: np.ndarray | None = None) -> None:
        ok = (label[x] != label[y]) & ((i[x] == j[x]) | (chunk[x] != chunk[y])) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
        x, y = x[ok], y[ok]
        same = (sig[x] == sig[y]).sum(axis=1) if same is None else same[ok]
        ok = same >= least
        x, y, same = x[ok], y[ok], same[ok].astype(np.int64)
        ok = trees[x, np.argmax(trees[x] == trees[y], axis=1)] == region[x]
        found.append((x[ok], y[ok], same[ok]))

    little = (sizes <= LITTLE)[group]
    for d in range(1, LITTLE):  # row k against row k + d, for all little groups together
        x = np.flatnonzero(little[:-d] & (group[d:] == group[:-d])) if len(part) > d else np.zeros(0, np.int64)
        if not len(x):
            break
        keep(x, x + d)
    for g in np.flatnonzero(sizes > LITTLE):
        rows = np.arange(starts[g], starts[g] + sizes[g])
        if label[rows].min() == label[rows].max():
            continue
        left, right = rows[chunk[rows] == i[rows[0]]], rows[chunk[rows] == j[rows[0]]]
        for lo in range(0, len(left), BLOCK):
            for ro in range(0, len(right), BLOCK):
                own, other = left[lo : lo + BLOCK], right[ro : ro + BLOCK]
                same = np.zeros((len(own), len(other)), np.uint8)
                for k in range(VALUES):
                    same += sig[own, k][:, None] == sig[other, k][None]
                x, y = np.nonzero(same >= least)
                once = (own[x] < other[y]) | (i[rows[0]] != j[rows[0]])
                keep(own[x[once]], other[y[once]], same[x[once], y[once]])
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    x, y, same = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((y, x, -same, group[x]))
    return x[order], y[order], group[x[order]]


def spanning(group: np.ndarray, la: np.ndarray, lb: np.ndarray, linked=None) -> np.ndarray:
    """Which pairs, in the given order, join classes of their group that earlier pairs have not joined yet.

    With ``linked``, only pairs for whose number it is true join classes.
    """
    keep, parent, now = np.zeros(len(group), bool), {}, None

    def top(c: int) -> int:
        while (up := parent.get(c, c)) != c:
            parent[c] = c = parent.get(up, up)
        return c

    for k, (g, a, b) in enumerate(zip(group.tolist(), la.tolist(), lb.tolist())):
        if g != now:
            parent, now = {}, g
        if (a := top(a)) != (b := top(b)) and (linked is None or linked(k)):
            parent[a] = b
            keep[k] = True
    return keep


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b, block with 100 * intersection >= percent * union on the full sets."""

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            linked = [similar(unpacked(x), unpacked(y), percent) for x, y in zip(batch.set_a, batch.set_b)]
            yield batch[["a", "b", "block"]][np.array(linked, bool)]

    first = pairs.join(sets.select(F.col("set_id").alias("b"), F.col("members").alias("set_b")), "b")
    return first.join(sets.select(F.col("set_id").alias("a"), F.col("members").alias("set_a")), "a").mapInPandas(judge, PAIRS)


def stars(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """Links a, b that connect the same nodes as the given ones, each node with the smallest it reaches here."""
    parent: dict[int, int] = {}

    def top(c: int) -> int:
        while (up := parent.get(c, c)) != c:
            parent[c] = c = parent.get(up, up)
        return c

    for u, v in zip(a.tolist(), b.tolist()):
        if (u := top(u)) != (v := top(v)):
            parent[max(u, v)] = min(u, v)
    nodes = np.array(list(parent), np.int64)
    return pd.DataFrame({"a": np.array([top(c) for c in nodes.tolist()], np.int64), "b": nodes})


def shortened(links: DataFrame) -> DataFrame:
    """``links`` (a, b, block) with the paths inside a block replaced by stars, so that components take few passes.

    Links of a block lie together; each batch is replaced by itself, so a block of any size takes bounded memory.
    """

    def replace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield stars(batch.a.to_numpy(), batch.b.to_numpy())

    return links.repartition("block").sortWithinPartitions("block", "a", "b").mapInPandas(replace, "a long, b long")


def similar(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether two ascending arrays without repeats share enough: 100 * intersection >= percent * union."""
    if len(p) > len(q):
        p, q = q, p
    at = np.searchsorted(q, p)
    shared = int((q[np.minimum(at, len(q) - 1)] == p).sum())
    return 100 * shared >= percent * (len(p) + len(q) - shared)


def packed(h: np.ndarray) -> bytes:
    """The upper 48 bits of every hash: two sets of 20,000 shingles differ in them by a false match once in a million pairs."""
    return np.ascontiguousarray(h.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :SET_BYTES]).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // SET_BYTES, 8), np.uint8)
    out[:, :SET_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, SET_BYTES)
    return out.view(">u8").ravel().astype(np.uint64)


def full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """set_id, members of the wanted sets, from the text of the document that stands for each (``wanted``: set_id, doc_id)."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        hasher = WordHasher()
        for batch in batches:
            found = [hasher.shingles(t, words) for t in batch.text]
            ids = [xxhash.xxh3_64_intdigest(h.tobytes()) - 2**63 for h in found]
            keep = [k for k, (i, w) in enumerate(zip(ids, batch.set_id)) if i == w]
            yield pd.DataFrame({"set_id": pd.array([ids[k] for k in keep], "int64"), "members": [packed(found[k]) for k in keep]})

    rows = docs.select(F.col("doc_id").cast("long"), "text").join(wanted, "doc_id")
    return rows.select("set_id", "text").mapInPandas(build, "set_id long, members binary").dropDuplicates(["set_id"])


def set_classes(docs: DataFrame, words: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Every row's doc_id, n and set_id, and for every linked set its class: set_id, label."""
    written = Written(docs.sparkSession, "near-duplicates")
    rows = written.keep(described(docs, words), "described")
    sets = rows.filter("n > 0 AND doc_id IS NOT NULL")
    sets = sets.groupBy("set_id").agg(F.min("doc_id").alias("doc_id"), F.min_by(F.struct("n", "signature", "trees"), "doc_id").alias("s"))
    sets = written.keep(sets.select("set_id", "doc_id", "s.*"), "sets")
    rows = written.keep(rows.select("doc_id", "n", "set_id"), "rows")
    written.drop("described")

    places = places_of(sets)
    shared = places.groupBy("region").agg(F.count("*").alias("k")).filter("k > 1").select("region")
    members = written.keep(places.join(shared, "region").select("region", "tree", "set_id"), "members")
    described_sets = sets.select("set_id", "n", "signature", "trees")
    wanted = members.select("set_id").distinct().join(sets.select("set_id", "doc_id"), "set_id")
    full = written.keep(full_sets(docs, wanted, words), "full")

    def joined(labels: DataFrame | None, links: DataFrame) -> DataFrame:
        """Classes after further links: node, root."""
        links = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if labels is not None:
            links = links.unionByName(labels.select(F.col("node").alias("u"), F.col("root").alias("v")))
        return written.keep(components(links), "labels")

    def tasks(labels: DataFrame) -> DataFrame:
        now = members.join(labels.select(F.col("node").alias("set_id"), "root"), "set_id", "left")
        return class_tasks(now.select("region", "set_id", F.coalesce("root", "set_id").alias("label"))).join(described_sets, "set_id")

    first = members.filter("tree < 2").join(described_sets.drop("trees"), "set_id")
    labels = joined(None, shortened(confirmed(neighbours(first, percent), full, percent)))
    labels = joined(labels, shortened(confirmed(spanning_pairs(tasks(labels), percent), full, percent)))
    rest = written.keep(undecided(tasks(labels), percent), "rest")
    labels = joined(labels, links_across(rest.join(full, "set_id"), percent))
    written.drop("members", "full", "rest", "sets")
    return rows, labels.select(F.col("node").alias("set_id"), F.col("root").alias("label"))


def near_duplicate_classes(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text).

    Shingles: distinct runs of ``words`` words, A-Z lower-cased, words between white space; with fewer words the
    whole sequence; null, empty and wordless texts have none and are linked with nothing. Two documents are linked
    if 100 * intersection >= percent * union; component_id is the smallest doc_id reachable over links. A null
    doc_id is in no component and kept. Rows that repeat a doc_id each have the component of their own text.
    """
    rows, labels = set_classes(docs, words, percent)
    least = rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    least = least.join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    roots = least.groupBy("label").agg(F.min("least").alias("component_id"))
    by_set = least.join(roots, "label").select("set_id", "component_id")
    out = rows.join(by_set, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each class: one of the smallest doc_id there, even if that repeats.

    Rows are judged one by one under a number of their own, so rows that share a doc_id but not a class do not touch
    each other. Rows of null doc_id are in no class; of those with equal texts one stays, also if a row with a doc_id
    has that text. Rows without words all stay.
    """
    written = Written(docs.sparkSession, "kept")
    number = "row number"
    while number in docs.columns:
        number += "_"
    numbered = written.keep(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    ids = numbered.select(F.col(number).alias("row"), F.col("doc_id").cast("long").alias("own_id"), "text")
    rows, labels = set_classes(ids.filter("own_id IS NOT NULL").select(F.col("row").alias("doc_id"), "text"), words, percent)
    rows = rows.withColumnRenamed("doc_id", "row")
    first = F.min(F.struct("own_id", "row")).alias("first")
    of_set = rows.filter("n > 0").join(ids.select("row", "own_id"), "row").groupBy("set_id").agg(F.min("own_id").alias("own_id"), F.min_by("row", F.struct("own_id", "row")).alias("row"))
    of_class = of_set.join(labels, "set_id", "left").groupBy(F.coalesce("label", "set_id").alias("label")).agg(first).select("first.row")
    nulls = ids.filter("own_id IS NULL").select("row", "text")
    worded = F.coalesce(F.col("text").rlike(r"[^ \t\n\x0B\f\r]"), F.lit(False))
    of_text = nulls.filter(worded).groupBy(F.sha2("text", 256).alias("digest")).agg(F.min("row").alias("row")).select("row")
    kept = of_class.unionByName(rows.filter("n = 0").select("row")).unionByName(of_text).unionByName(nulls.filter(~worded).select("row"))
    removed = ids.select("row").join(kept, "row", "left_anti")
    return without_rows(numbered, number, removed, written.path("removed")).drop(number)


def without_rows(numbered: DataFrame, number: str, removed: DataFrame, path: str) -> DataFrame:
    """``numbered`` without the rows whose ``number`` is in ``removed`` (row), filtered where they lie.

    The numbers are those of ``monotonically_increasing_id`` in a written table. The removed ones are written below
    ``path``, a folder for each task that numbered rows, and a task reads the folders of the numbers it meets: at most
    as many numbers as one task wrote rows. So only numbers are shuffled, never texts.
    """
    parts = removed.select("row", F.shiftright("row", NUMBER_BITS).alias("part"))
    parts.repartition("part").sortWithinPartitions("part", "row").write.partitionBy("part").parquet(path)

    @F.pandas_udf("boolean")
    def stays(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        part, gone = None, np.zeros(0, np.int64)
        for batch in batches:
            rows = batch.to_numpy(np.int64)
            out = np.ones(len(rows), bool)
            for now in np.unique(rows >> NUMBER_BITS):
                if now != part:
                    part, gone = now, written_numbers(path, f"part={now}", "row")
                own = (rows >> NUMBER_BITS) == now
                out[own] = ~np.isin(rows[own], gone)
            yield pd.Series(out)

    return numbered.filter(stays(F.col(number)))
