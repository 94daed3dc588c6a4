"""Two-stage recommendation: item space, retrieval, candidates, their features, baselines, lists."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketspark.functions.hashing import hash_bucket
from basketspark.functions.joins import lookup_join, salted_join
from basketspark.functions.ranks import global_row_number
from basketspark.functions.vectors import SIM_DECIMALS, dot, owned_vector_sums, top_n_by_similarity, unit
from basketspark.operators.features import days_before
from basketspark.session import cut_lineage, scratch_dir

N_CANDIDATES = 200
N_POPULAR = 50
TOP_K = 12
HALF_LIFE_DAYS = 90.0
VECTOR_BROADCAST_ROWS = 50_000
PAIR_BROADCAST_ROWS = 2_000_000
OWNED_ROWS_PER_TASK = 20_000

# Candidate feature order (position-significant).
CANDIDATE_FEATURES = [
    "emb_similarity",
    "emb_rank",
    "log_units",
    "log_buyers",
    "price",
    "bought_before",
    "times_bought_before",
    "weight_before",
    "copurchase",
    "copurchase_rank",
    "price_vs_customer_avg",
    "cust_frequency",
    "cust_recency",
]


# --- baskets and items ------------------------------------------------------------------------

def baskets(observation: DataFrame, part_size: int = 1000) -> DataFrame:
    """Product list per invoice, repeats kept, sorted.

    An invoice with more than ``part_size`` lines comes out in several parts
    (hash of the whole line), so no list outgrows one row. ``n_parts`` is 1 for
    every ordinary invoice.
    """
    lines = observation.groupBy("invoice").agg(F.count(F.lit(1)).alias("n_lines"))
    large = lines.filter(F.col("n_lines") > part_size).select("invoice", F.ceil(F.col("n_lines") / part_size).cast("int").alias("n_parts"))
    rows = salted_join(observation, large, "invoice", "left", unique=True) if large.limit(1).count() else observation.withColumn("n_parts", F.lit(1))
    n_parts = F.coalesce(F.col("n_parts"), F.lit(1))
    return (
        rows.select("invoice", "stock_code", n_parts.alias("n_parts"),
                    F.pmod(F.xxhash64(*[F.col(c) for c in observation.columns]), n_parts).cast("int").alias("part"))
        .groupBy("invoice", "part", "n_parts").agg(F.array_sort(F.collect_list("stock_code")).alias("items"))
    )


def item_index(observation: DataFrame, min_count: int = 5) -> DataFrame:
    """Items with at least ``min_count`` lines, numbered by (lines desc, code)."""
    counts = observation.groupBy("stock_code").agg(F.count(F.lit(1)).alias("n_lines")).filter(F.col("n_lines") >= min_count)
    return global_row_number(counts, [F.desc("n_lines"), F.asc("stock_code")]).select(
        (F.col("rn") - 1).cast("int").alias("item_idx"), "stock_code", "n_lines"
    )


def corpus_stats(observation: DataFrame, items: DataFrame, top: int = 100) -> DataFrame:
    """Baskets, products, vector coverage, basket sizes and demand concentration as one row."""
    sizes = observation.groupBy("invoice").agg(F.count(F.lit(1)).alias("n"))
    demand = observation.groupBy("stock_code").agg(F.sum(F.col("quantity").cast("bigint")).alias("units"))
    head = demand.orderBy(F.desc("units"), F.asc("stock_code")).limit(top)
    return sizes.agg(
        F.count(F.lit(1)).alias("n_baskets"), F.avg("n").alias("mean_size"), F.max("n").alias("max_size"),
        F.avg((F.col("n") >= 2).cast("double")).alias("share_two_plus"),
    ).select(
        "n_baskets", demand.agg(F.count(F.lit(1))).scalar().alias("n_products"), items.agg(F.count(F.lit(1))).scalar().alias("n_with_vector"),
        "mean_size", "max_size", "share_two_plus",
        (head.agg(F.sum("units")).scalar() / demand.agg(F.sum("units")).scalar()).alias("top_100_unit_share"),
    ).withColumn("coverage_pct", 100 * F.col("n_with_vector") / F.col("n_products"))


def item2vec(basket_rows: DataFrame, items: DataFrame, dim: int = 64, min_count: int = 5, epochs: int = 10, seed: int = 42,
             num_partitions: int = 1, longest_basket: int = 1000) -> DataFrame:
    """Skip-gram vectors over baskets: (item_idx, stock_code, vector), unit length.

    The window spans ``longest_basket`` products: those further apart in a
    basket (or in different parts of one, see :func:`baskets`) are no training
    pair. With one training partition (the default, at every size) runs repeat
    exactly; on a large ledger ask for more, which train in parallel and are
    averaged per epoch.
    """
    fixed = cut_lineage(basket_rows.select("invoice", "part", "items").repartitionByRange("invoice", "part").sortWithinPartitions("invoice", "part"))
    model = Word2Vec(
        inputCol="items", outputCol="v", vectorSize=dim, windowSize=longest_basket, minCount=min_count, maxIter=epochs,
        numPartitions=num_partitions, maxSentenceLength=longest_basket, seed=seed,
    ).fit(fixed)
    vectors = model.getVectors().select(F.col("word").alias("stock_code"), vector_to_array("vector").alias("raw"))
    return items.join(vectors, "stock_code").select("item_idx", "stock_code", unit(F.col("raw")).alias("vector"))


def normalised_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    return rows.select(key, unit(F.col(vector)).alias("vector"))


def with_item_index(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Rows whose product has an index, with ``item_idx``; a popular product is salted if it is heavy."""
    return lookup_join(rows, items.select("stock_code", "item_idx"), "stock_code")


# --- customers in the item space --------------------------------------------------------------

def purchase_weights(observation: DataFrame, items: DataFrame, cutoff: datetime, half_life: float = HALF_LIFE_DAYS) -> DataFrame:
    """Sum of 0.5^(days/half_life) and the line count per (customer, item)."""
    age = days_before(cutoff, "invoice_date").cast("double") / F.lit(half_life)
    return with_item_index(observation.select("customer_id", "stock_code", "invoice_date"), items).groupBy("customer_id", "item_idx").agg(
        F.sum(F.pow(F.lit(0.5), age)).alias("weight"), F.count(F.lit(1)).alias("lines_bought")
    )


def customer_vectors(weights: DataFrame, vectors: DataFrame) -> DataFrame:
    """Weighted sum of owned item vectors, unit length: (customer_id, vector)."""
    return normalised_vectors(owned_vector_sums(weights, vectors, "customer_id", "item_idx", "weight", "raw"), "customer_id", "raw")


def retrieve_top_n(customers: DataFrame, vectors: DataFrame, n: int = N_CANDIDATES) -> DataFrame:
    """Stage one: the ``n`` items closest to each customer, exactly."""
    return top_n_by_similarity(customers, vectors, "customer_id", "item_idx", n)


def similar_items(vectors: DataFrame, k: int = 8, key: str = "item_idx") -> DataFrame:
    """The ``k`` (1..50) nearest other items of every item, cosine rounded to 4 places."""
    k = max(1, min(k, 50))
    best = top_n_by_similarity(vectors, vectors, key, key, k, exclude_self=True)
    return best.select(key, F.col("_other").alias(f"similar_{key}"), F.round("similarity", 4).alias("similarity"), "rank")


# --- item facts -------------------------------------------------------------------------------

def item_stats(observation: DataFrame, items: DataFrame) -> DataFrame:
    """Units, buyers, baskets, median price and log1p forms per indexed item; zero when unseen.

    Distinct buyers and baskets are counted after pre-aggregating to (item,
    customer) and (item, invoice); the median reads (price, count) pairs, so a
    bestseller costs one entry per price point, not per line.
    """
    rows = with_item_index(observation.select("stock_code", "customer_id", "invoice", "quantity", "price"), items)
    by_customer = rows.groupBy("item_idx", "customer_id").agg(F.sum(F.col("quantity").cast("bigint")).alias("units"))
    buyers = by_customer.groupBy("item_idx").agg(F.sum("units").alias("units"), F.count(F.lit(1)).alias("buyers"))
    in_baskets = rows.select("item_idx", "invoice").distinct().groupBy("item_idx").agg(F.count(F.lit(1)).alias("baskets"))
    prices = rows.groupBy("item_idx", "price").agg(F.count(F.lit(1)).alias("c")).groupBy("item_idx").agg(
        F.expr("percentile(CAST(price AS DOUBLE), 0.5D, c)").alias("price")
    )
    joined = items.select("item_idx", "stock_code").join(buyers, "item_idx", "left").join(in_baskets, "item_idx", "left").join(prices, "item_idx", "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("units", "buyers", "baskets")}
    return joined.withColumns({**zero, "price": F.coalesce("price", F.lit(0.0))}).withColumns({
        "log_units": F.log1p(F.greatest(F.col("units"), F.lit(0)).cast("double")), "log_buyers": F.log1p(F.col("buyers").cast("double")),
    })


def popularity_order(stats: DataFrame) -> DataFrame:
    """(item_idx, rank) by units sold, best first."""
    return global_row_number(stats.select("item_idx", "units"), [F.desc("units"), F.asc("item_idx")], "rank").select("item_idx", "rank")


def item_description(observation: DataFrame) -> DataFrame:
    """Most frequent description per product, the smallest on ties."""
    counts = observation.filter(F.col("description").isNotNull()).groupBy("stock_code", "description").agg(F.count(F.lit(1)).alias("c"))
    best = counts.groupBy("stock_code").agg(F.min_by("description", F.struct(-F.col("c"), F.col("description"))).alias("description"))
    return best


def copurchase(observation: DataFrame, items: DataFrame, cell: int = 512) -> DataFrame:
    """Distinct-basket co-occurrence counts, stored once per pair (item_i < item_j).

    Items inside a basket are hashed into ``ceil(n / cell)`` groups and only
    pairs of groups are joined, so a huge basket becomes many bounded joins on
    different tasks while an ordinary basket (one group) is a plain self-join.
    Counts combine on the map side before the shuffle on the pair.
    """
    # Read three times below (sizes and both join sides), so written once.
    pairs = cut_lineage(with_item_index(observation.select("invoice", "stock_code"), items).select("invoice", "item_idx").distinct())
    sizes = pairs.groupBy("invoice").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.filter(F.col("n") > cell).select("invoice", F.ceil(F.col("n") / cell).cast("int").alias("groups"))
    if large.limit(1).count() == 0:
        left = pairs.withColumnRenamed("item_idx", "item_i")
        right = pairs.withColumnRenamed("item_idx", "item_j")
        joined = left.join(right, "invoice").filter(F.col("item_i") < F.col("item_j"))
    else:
        tagged = salted_join(pairs, large, "invoice", "left", unique=True).withColumn("groups", F.coalesce("groups", F.lit(1))).withColumn(
            "own", F.pmod(F.xxhash64("item_idx"), F.col("groups")).cast("int")
        )
        spread = F.explode(F.sequence(F.lit(0), F.col("groups") - 1))
        left = tagged.select("invoice", F.col("item_idx").alias("item_i"), F.col("own").alias("a"), spread.alias("b"))
        right = tagged.select("invoice", F.col("item_idx").alias("item_j"), F.col("own").alias("b"), spread.alias("a"))
        joined = left.join(right, ["invoice", "a", "b"]).filter(F.col("item_i") < F.col("item_j"))
    return joined.groupBy("item_i", "item_j").agg(F.count(F.lit(1)).alias("n_baskets"))


def mirrored(pairs: DataFrame) -> DataFrame:
    """Both directions of the stored pairs, without a second scan."""
    both = F.array(
        F.struct(F.col("item_i").alias("item_i"), F.col("item_j").alias("item_j")),
        F.struct(F.col("item_j").alias("item_i"), F.col("item_i").alias("item_j")),
    )
    return pairs.select(F.explode(both).alias("d"), "n_baskets").select("d.item_i", "d.item_j", "n_baskets")


# --- candidates -------------------------------------------------------------------------------

def top_items(popular: DataFrame, n: int) -> list[int]:
    """Ids of the best ``n`` items (n rows on the driver, used as a literal list)."""
    return [r["item_idx"] for r in popular.filter(F.col("rank") <= n).orderBy("rank").collect()]


def build_candidates(weights: DataFrame, retrieved: DataFrame, popular: DataFrame, n_popular: int = N_POPULAR) -> DataFrame:
    """Retrieved, owned and popular items per customer, once each, with source flags and owned weight."""
    none, no = F.lit(None).cast("double"), F.lit(0)
    owned = weights.select("customer_id", "item_idx", no.alias("r"), F.lit(1).alias("o"), no.alias("t"), "weight", "lines_bought", none.alias("similarity"))
    found = retrieved.select("customer_id", "item_idx", F.lit(1).alias("r"), no.alias("o"), no.alias("t"), none.alias("weight"),
                             F.lit(None).cast("bigint").alias("lines_bought"), "similarity")
    best = F.array(*[F.lit(i) for i in top_items(popular, n_popular)])
    everyone = weights.select("customer_id").distinct().select(
        "customer_id", F.explode(best).alias("item_idx"), no.alias("r"), no.alias("o"), F.lit(1).alias("t"), none.alias("weight"),
        F.lit(None).cast("bigint").alias("lines_bought"), none.alias("similarity"),
    )
    return owned.unionByName(found).unionByName(everyone).groupBy("customer_id", "item_idx").agg(
        F.max("r").alias("from_retrieval"), F.max("o").alias("from_history"), F.max("t").alias("from_popular"),
        F.coalesce(F.max("weight"), F.lit(0.0)).alias("weight_before"), F.coalesce(F.max("lines_bought"), F.lit(0)).alias("lines_bought_before"),
        F.max("similarity").alias("retrieval_similarity"),
    )


def candidate_similarity(candidates: DataFrame, customers: DataFrame, vectors: DataFrame) -> DataFrame:
    """Adds emb_similarity and emb_rank (ties by item).

    Retrieved candidates bring their similarity along; only the rest carry two
    vectors through a join.
    """
    known = candidates.filter(F.col("retrieval_similarity").isNotNull()).withColumn("emb_similarity", F.col("retrieval_similarity"))
    rest = candidates.filter(F.col("retrieval_similarity").isNull())
    rest = lookup_join(rest, vectors.select("item_idx", F.col("vector").alias("_iv")), "item_idx", max_broadcast_rows=VECTOR_BROADCAST_ROWS)
    rest = rest.join(customers.select("customer_id", F.col("vector").alias("_cv")), "customer_id").withColumn(
        "emb_similarity", F.round(dot(F.col("_cv"), F.col("_iv")), SIM_DECIMALS)).drop("_cv", "_iv")
    order = Window.partitionBy("customer_id").orderBy(F.desc("emb_similarity"), F.asc("item_idx"))
    return known.unionByName(rest).drop("retrieval_similarity").withColumn("emb_rank", F.row_number().over(order))


def owned_copurchase(weights: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per (customer, item): co-occurrence with everything the customer owns, summed.

    The product is the largest intermediate here. While the pair table is
    small (counted) it is broadcast to rows already hashed by customer, and
    the sums need no shuffle at all. Beyond that it is a join on the owned
    item, split over salts where an item is owned by many customers, with sums
    combined before the shuffle.
    """
    owned = weights.select("customer_id", F.col("item_idx").alias("item_i"))
    if pairs.count() <= PAIR_BROADCAST_ROWS:
        # An explicit count: the rows are few before the join and many after it,
        # so adaptive coalescing on the input size would leave too few tasks.
        tasks = max(weights.sparkSession.sparkContext.defaultParallelism, -(-weights.count() // OWNED_ROWS_PER_TASK))
        joined = owned.repartition(tasks, "customer_id").join(F.broadcast(mirrored(pairs)), "item_i")
    else:
        joined = salted_join(owned, mirrored(pairs), "item_i")
    return joined.groupBy("customer_id", F.col("item_j").alias("item_idx")).agg(F.sum("n_baskets").alias("co_score"))


TILE_CELLS = 1 << 22  # customers x items summed in one dense tile
TILE_PRODUCTS = 1 << 22  # products added to a tile at a time


def tile_sums(customer: np.ndarray, item: np.ndarray, start: np.ndarray, column: np.ndarray, n: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Sparse product as one dense tile, laid out flat: for every owned (customer, item) the item's row of the pair table added to the customer's.

    The pair table's rows lie behind each other: those of item ``i`` from ``start[i]`` to ``start[i + 1]``.
    """
    out = np.zeros(shape[0] * shape[1])
    length = start[item + 1] - start[item]
    customer, item, length = customer[length > 0], item[length > 0], length[length > 0]
    ends = np.cumsum(length)
    lo = 0
    while lo < len(item):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + TILE_PRODUCTS, "right")))
        own = length[lo:hi]
        at = np.arange(own.sum()) + np.repeat(start[item[lo:hi]] - (ends[lo:hi] - own - before), own)
        out += np.bincount(np.repeat(customer[lo:hi], own) * shape[1] + column[at], n[at], len(out))
        lo = hi
    return out


def best_places(row: np.ndarray, place: np.ndarray, score: np.ndarray, owned: np.ndarray, width: int, k: int) -> np.ndarray:
    """Which entries are among the best ``k`` of their row, of all or of those not owned; ties by place."""
    if not len(row):
        return np.zeros(0, np.int64)
    most = int(score.max()) + 1
    if (int(row.max()) + 1) * most * width < 1 << 62:
        order = np.argsort((row * most + (most - 1 - score)) * width + place)
    else:
        order = np.lexsort((place, -score, row))
    row, fresh = row[order], ~owned[order]
    begin = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    lengths = np.diff(np.r_[begin, len(row)])
    before = np.cumsum(fresh) - fresh  # entries not owned that come earlier
    rank, fresh_rank = np.arange(len(row)) - np.repeat(begin, lengths), before - np.repeat(before[begin], lengths)
    return order[(rank < k) | (fresh & (fresh_rank < k))]


def wanted_copurchase(weights: DataFrame, pairs: DataFrame, candidates: DataFrame | None = None, k: int = TOP_K,
                      customers_per_chunk: int = 4096, pairs_per_chunk: int = 2_000_000) -> DataFrame:
    """The rows of :func:`owned_copurchase` that ranking reads, without the rest: (customer_id, item_idx, co_score).

    Kept are the scores of ``candidates`` and, per customer, the best ``k`` items of each item chunk, of all and of
    those not owned (ties by item), so the best ``k`` overall are among them. The product is taken in tiles: customers
    are hashed into chunks, scored items too. A cell of both gets its customers' owned items and, of the pair table,
    only the rows of items that one of these customers owns, and adds them up tile by tile. Nothing of the size
    customers x items is stored or shuffled, and no pair goes to a chunk of customers who do not own its item.
    """
    n_customers, n_pairs = weights.select("customer_id").distinct().count(), 2 * pairs.count()
    p = max(1, -(-n_customers // customers_per_chunk))
    # A pair is sent to p cells whatever q is: more chunks of items than needed give every core several cells.
    q = max(1, -(-n_pairs // pairs_per_chunk), min(3 * weights.sparkSession.sparkContext.defaultParallelism // p, n_pairs // 10_000))
    item_chunk = F.pmod(F.xxhash64(F.col("item_idx").cast("int")), F.lit(q)).cast("int")
    customer_chunk = F.pmod(F.xxhash64("customer_id"), F.lit(p)).cast("int").alias("_p")
    owned = weights.select("customer_id", F.col("item_idx").cast("int"), customer_chunk)
    asks = owned.select("*", F.explode(F.sequence(F.lit(0), F.lit(q - 1))).alias("_q"), F.lit(False).alias("wanted"))
    if candidates is not None:
        asks = asks.unionByName(candidates.select("customer_id", F.col("item_idx").cast("int"), customer_chunk, item_chunk.alias("_q"), F.lit(True).alias("wanted")))
    owners = owned.select(F.col("_p").alias("_rp"), F.col("item_idx").alias("item_i")).distinct()
    columns = salted_join(mirrored(pairs).withColumnRenamed("item_j", "item_idx").select("item_i", "item_idx", "n_baskets", item_chunk.alias("_rq")), owners, "item_i")
    id_type = dict(weights.dtypes)["customer_id"]

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"customer_id": [], "item_idx": [], "co_score": []})
        if not len(left) or not len(right):
            return empty
        customers, who = np.unique(left["customer_id"].to_numpy(), return_inverse=True)
        what, asked = left["item_idx"].to_numpy(), left["wanted"].to_numpy()
        items, column = np.unique(right["item_idx"].to_numpy(), return_inverse=True)
        sources, source = np.unique(right["item_i"].to_numpy(), return_inverse=True)
        width = min(len(items), max(1, TILE_CELLS // len(customers)))
        order = np.lexsort((source, column // width))
        column, source, n = column[order], source[order], right["n_baskets"].to_numpy(float)[order]
        at = np.minimum(np.searchsorted(sources, what), len(sources) - 1)
        has = ~asked & (sources[at] == what)
        place = np.minimum(np.searchsorted(items, what), len(items) - 1)
        scored = items[place] == what
        found = []
        for tile in range(-(-len(items) // width)):
            lo, hi = np.searchsorted(column // width, [tile, tile + 1])
            first, shape = tile * width, (len(customers), min(width, len(items) - tile * width))
            start = np.searchsorted(source[lo:hi], np.arange(len(sources) + 1))
            scores = tile_sums(who[has], at[has], start, column[lo:hi] - first, n[lo:hi], shape)
            here = scored & (place >= first) & (place < first + shape[1])
            cells = who[here] * shape[1] + place[here] - first
            owned_here, wanted_here = np.zeros(len(scores), bool), np.zeros(len(scores), bool)
            owned_here[cells[~asked[here]]], wanted_here[cells[asked[here]]] = True, True
            own = np.flatnonzero(scores)
            x, y = np.divmod(own, shape[1])
            s = scores[own].astype(np.int64)
            keep = wanted_here[own]
            keep[best_places(x, y, s, owned_here[own], shape[1], k)] = True
            found.append((x[keep], y[keep] + first, s[keep], owned_here[own][keep], wanted_here[own][keep]))
        x, y, s, mine, asked_for = (np.concatenate(c) for c in zip(*found))
        asked_for[best_places(x, y, s, mine, len(items), k)] = True  # now the best of all tiles
        return pd.DataFrame({"customer_id": customers[x], "item_idx": items[y], "co_score": s})[asked_for]

    return asks.groupBy("_p", "_q").cogroup(columns.groupBy("_rp", "_rq")).applyInPandas(cell, f"customer_id {id_type}, item_idx int, co_score long")


def candidate_copurchase(candidates: DataFrame, scores: DataFrame) -> DataFrame:
    """Adds copurchase = log1p(score) and its rank within the customer. ``scores``: wanted_copurchase of the candidates."""
    order = Window.partitionBy("customer_id").orderBy(F.desc("_co"), F.asc("item_idx"))
    return (
        candidates.join(scores, ["customer_id", "item_idx"], "left")
        .withColumn("_co", F.coalesce("co_score", F.lit(0)))
        .withColumn("copurchase", F.log1p(F.col("_co").cast("double")))
        .withColumn("copurchase_rank", F.row_number().over(order)).drop("_co", "co_score")
    )


def customer_average_price(weights: DataFrame, stats: DataFrame) -> DataFrame:
    """Weighted average price of a customer's items, floors at 1e-9."""
    rows = lookup_join(weights, stats.select("item_idx", "price"), "item_idx")
    total = F.sum(F.col("weight") * F.col("price")) / F.greatest(F.sum("weight"), F.lit(1e-9))
    return rows.groupBy("customer_id").agg(F.greatest(total, F.lit(1e-9)).alias("avg_price"))


def candidate_item_facts(candidates: DataFrame, stats: DataFrame) -> DataFrame:
    return lookup_join(candidates, stats.select("item_idx", "log_units", "log_buyers", "price"), "item_idx")


def candidate_history(candidates: DataFrame) -> DataFrame:
    """Ownership signals. ``times_bought_before`` repeats the 0/1 flag; the line count is its own column."""
    bought = (F.col("lines_bought_before") > 0).cast("int")
    return candidates.withColumns({"bought_before": bought, "times_bought_before": bought})


def candidate_price_fit(candidates: DataFrame, weights: DataFrame, stats: DataFrame) -> DataFrame:
    return candidates.join(customer_average_price(weights, stats), "customer_id").withColumn(
        "price_vs_customer_avg", F.col("price") / F.col("avg_price")
    ).drop("avg_price")


def candidate_context(candidates: DataFrame, features: DataFrame) -> DataFrame:
    return candidates.join(
        features.select("customer_id", F.col("frequency").alias("cust_frequency"), F.col("recency").alias("cust_recency")), "customer_id", "left"
    )


def candidate_features(candidates: DataFrame, customers: DataFrame, vectors: DataFrame, weights: DataFrame, stats: DataFrame,
                       scores: DataFrame, features: DataFrame) -> DataFrame:
    """All thirteen ranking signals per (customer, item), in fixed order."""
    rows = candidate_item_facts(candidate_history(candidates), stats)
    rows = candidate_similarity(rows, customers, vectors)
    rows = candidate_copurchase(rows, scores)
    rows = candidate_context(candidate_price_fit(rows, weights, stats), features)
    return rows.select("customer_id", "item_idx", *CANDIDATE_FEATURES)


def truth_pairs(future: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct (customer, item) bought in the label window, indexed items only."""
    return with_item_index(future.select("customer_id", "stock_code"), items).select("customer_id", "item_idx").distinct()


def label_candidates(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    return candidates.join(truth.withColumn("label", F.lit(1)), ["customer_id", "item_idx"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def candidate_balance(labelled: DataFrame, name: str) -> DataFrame:
    per = labelled.groupBy("customer_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("label").alias("pos"))
    return per.agg(F.sum("rows").alias("n_rows"), F.count(F.lit(1)).alias("n_customers"), F.sum("pos").alias("positives")).select(
        F.lit(name).alias("snapshot"), "n_rows", "n_customers", "positives", (100 * F.col("positives") / F.col("n_rows")).alias("positive_pct")
    )


def group_split(rows: DataFrame, share: int = 20, seed: int = 42) -> DataFrame:
    """Held-out flag by customer, never by row."""
    return rows.withColumn("is_val", hash_bucket("customer_id", 100, seed) < share)


def group_sizes(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_candidates"))


# --- lists ------------------------------------------------------------------------------------

def top_k(scored: DataFrame, k: int = TOP_K, score: str = "score") -> DataFrame:
    """Best ``k`` items per customer; the row limit is pushed below the shuffle."""
    order = Window.partitionBy("customer_id").orderBy(F.desc(score), F.asc("item_idx"))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("customer_id", "item_idx", "rank")


def owned_pairs(weights: DataFrame) -> DataFrame:
    return weights.select("customer_id", "item_idx")


def baseline_popular(customers: DataFrame, popular: DataFrame, k: int = TOP_K) -> DataFrame:
    """The same bestsellers for everyone: a k-item literal exploded per customer."""
    best = F.array(*[F.lit(i) for i in top_items(popular, k)])
    return customers.select("customer_id", F.posexplode(best).alias("pos", "item_idx")).select("customer_id", "item_idx", (F.col("pos") + 1).alias("rank"))


def baseline_repeat(weights: DataFrame, k: int = TOP_K) -> DataFrame:
    """Most bought, recent first; weights equal to ten significant digits are ties, broken by item."""
    return top_k(weights.withColumn("_digits", F.round(F.log10("weight"), 10)), k, "_digits")


def baseline_copurchase(weights: DataFrame, scores: DataFrame, n_items: int, k: int = TOP_K, exclude_own: bool = False) -> DataFrame:
    """Items most often bought together with what the customer owns. ``scores``: wanted_copurchase (or all of owned_copurchase).

    Short lists are filled with the lowest-numbered items that have no score
    (and are not owned, when own items are excluded).
    """
    owned = owned_pairs(weights)
    if exclude_own:
        scores = scores.join(owned, ["customer_id", "item_idx"], "left_anti")
    listed = cut_lineage(top_k(scores, k, "co_score"))  # k rows per customer, read three times below
    per = owned.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_owned"))
    short = per.join(listed.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_listed")), "customer_id", "left").withColumn(
        "n_listed", F.coalesce("n_listed", F.lit(0))
    ).filter(F.col("n_listed") < k)
    # Among the first k + listed (+ owned) item numbers at least k are free.
    reach = F.lit(k) + F.col("n_listed") + (F.col("n_owned") if exclude_own else F.lit(0))
    last = (F.least(F.lit(n_items), reach) - 1).cast("int")
    filler = short.select("customer_id", "n_listed", F.explode(F.sequence(F.lit(0), last)).alias("item_idx")).join(
        listed.select("customer_id", "item_idx"), ["customer_id", "item_idx"], "left_anti"
    )
    if exclude_own:
        filler = filler.join(owned, ["customer_id", "item_idx"], "left_anti")
    nth = F.row_number().over(Window.partitionBy("customer_id").orderBy("item_idx"))
    padded = filler.withColumn("rank", (nth + F.col("n_listed")).cast("int")).filter(F.col("rank") <= k).select("customer_id", "item_idx", "rank")
    return listed.unionByName(padded)


def baseline_stage1(retrieved: DataFrame, k: int = TOP_K) -> DataFrame:
    return retrieved.filter(F.col("rank") <= k).select("customer_id", "item_idx", "rank")


def truth_new(truth: DataFrame, owned: DataFrame) -> DataFrame:
    """Truth without already owned items; customers left empty drop out by construction."""
    return truth.join(owned, ["customer_id", "item_idx"], "left_anti")


def recs_new_only(recommended: DataFrame, owned: DataFrame, k: int = TOP_K) -> DataFrame:
    """Owned items stripped, order kept, cut to k again."""
    fresh = recommended.join(owned, ["customer_id", "item_idx"], "left_anti")
    again = Window.partitionBy("customer_id").orderBy("rank")
    return fresh.withColumn("rank", F.row_number().over(again)).filter(F.col("rank") <= k).select("customer_id", "item_idx", "rank")


def candidates_fresh(featured: DataFrame) -> DataFrame:
    return featured.filter(F.col("bought_before") == 0)


def covered_share(found: DataFrame, truth: DataFrame, known_only: bool, known: DataFrame | None = None) -> DataFrame:
    """Mean share of truth inside ``found``.

    ``known_only`` scores customers in ``known``; otherwise customers never
    seen before count as zero.
    """
    base = truth.join(known, "customer_id", "left_semi") if known_only else truth
    hits = base.join(found.select("customer_id", "item_idx").withColumn("hit", F.lit(1)), ["customer_id", "item_idx"], "left")
    per = hits.groupBy("customer_id").agg(F.avg(F.coalesce("hit", F.lit(0)).cast("double")).alias("share"))
    return per.agg(F.avg("share").alias("recall"), F.count(F.lit(1)).alias("customers_scored"))


def retrieval_recall(retrieved: DataFrame, truth: DataFrame, customers: DataFrame) -> DataFrame:
    return covered_share(retrieved, truth, True, customers.select("customer_id").distinct())


def candidate_ceiling(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    return covered_share(candidates, truth, False)


def repeat_share(observation: DataFrame, future: DataFrame) -> DataFrame:
    """Share of future (customer, product) pairs already bought; share of future products never seen before."""
    keys = ["customer_id", "stock_code"]
    past = observation.select(*keys).distinct().withColumn("seen", F.lit(1))
    ahead = future.select(*keys).distinct().join(past, keys, "left")
    known = observation.select("stock_code").distinct().withColumn("known", F.lit(1))
    products = future.select("stock_code").distinct().join(known, "stock_code", "left")
    unseen = products.agg(F.avg(F.col("known").isNull().cast("double"))).scalar()
    return ahead.agg(F.count(F.lit(1)).alias("future_pairs"), F.avg(F.coalesce("seen", F.lit(0)).cast("double")).alias("repeat_share")).withColumn(
        "unseen_product_share", unseen
    )


def recommendation_lists(listed: DataFrame, weights: DataFrame, items: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Ranked list with code, description, bought_before and how many are new to the customer."""
    owned = owned_pairs(weights).withColumn("bought_before", F.lit(True))
    named = items.select("item_idx", "stock_code").join(descriptions, "stock_code", "left")
    rows = lookup_join(listed, named, "item_idx").join(owned, ["customer_id", "item_idx"], "left").withColumn(
        "bought_before", F.coalesce("bought_before", F.lit(False))
    )
    whole = Window.partitionBy("customer_id")  # at most k rows
    return rows.select(
        "customer_id", "rank", "stock_code", F.coalesce("description", F.lit("")).alias("description"), "bought_before",
        F.count_if(~F.col("bought_before")).over(whole).alias("n_new_to_customer"),
    )


def fit_pointwise(labelled: DataFrame, trees: int = 500, depth: int = 6):
    from basketspark.operators import boosting

    return boosting.fit_gbt_classifier(labelled, CANDIDATE_FEATURES, F.col("label"), trees, depth, patience=30)


def fit_listwise(labelled: DataFrame, trees: int = 500, depth: int = 6):
    from basketspark.operators import boosting

    return boosting.fit_listwise(labelled, CANDIDATE_FEATURES, trees, depth)
