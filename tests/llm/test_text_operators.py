"""Sharding, decontamination, packing, quality, licences, archives and id files against brute force."""

import base64
import hashlib
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketspark.llm import common, decontaminate, licences, packing, quality, queries, sharding, token_files, tokens, warc

SMALL = "/root/testdata/sf0.001"
ODD = [None, "", "a", "A a\tb  c\n", "x " * 30_000, "same text", "same text", "<|endoftext|> it's　é\x85 Σ", " \n lead", "trail \n"]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd texts with null, repeated and negative ids, and extra columns that clash with the operators' own names."""
    ids = [None, 5, -3, 7, 8, 9, 9, None, 1, 2]
    rows = [(i, t, "s", k, k) for k, (i, t) in enumerate(zip(ids, ODD))]
    return spark.createDataFrame(rows, "doc_id long, text string, shard string, size int, `group` int").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")


def given(name, *columns):
    return duckdb.sql(f"SELECT {', '.join(columns)} FROM '{SMALL}/{name}.parquet'").fetchall()


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_whole_text_encoding(file):
    plain = Tokenizer.from_file(public_tokenizers.path(file))
    texts = [*ODD, *[t for (t,) in given("documents", "text")]]
    rng = np.random.default_rng(4)
    pool = ["a", "B", "'s", "don't", " ", "  ", "\n", "\n\n", "\t", "\u00a0", "\u2003", "\u0301", "\x1c", "\x85", "漢字", "3.5", "!", "</s>", "x\n", "\r\n", "İ"]
    texts = [*texts, *("".join(rng.choice(pool) + " " * int(rng.integers(0, 2)) for _ in range(rng.integers(1, 30))) for _ in range(1500))]
    for text, ids in zip(texts, tokens.Encoder(public_tokenizers.path(file), limit=50).ids(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text or "", add_special_tokens=False).ids


def test_sharding_contract(spark):
    rows = queries.op1_sharding(spark, SMALL).collect()
    texts = dict(given("documents", "doc_id", "text"))
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(40))


def test_sharding_is_even_and_keeps_groups(spark):
    rows = [(i, i % 3000 if i % 3 else 0, 100 + i * 7919 % 900, 10 + i * 104729 % 90, 1) for i in range(9000)]
    items = spark.createDataFrame(rows, "doc_id long, g long, size long, tokens long, rows long").withColumn("group", F.col("g").cast("string").cast("binary"))
    out = sharding.shard(items, 8, groups_per_task=500).groupBy("shard").agg(*[F.sum(m).alias(m) for m in sharding.MEASURES]).toPandas()
    assert len(out) == 8 and all((out[m].max() - out[m].min()) / out[m].mean() < 0.03 for m in sharding.MEASURES)
    spread = sharding.shard(items, 8).groupBy("g").agg(F.countDistinct("shard").alias("n")).filter("g <> 0 AND n > 1")
    assert spread.count() == 0


def test_sharding_odd_rows(docs, empty):
    out = sharding.sharded_documents(docs, 4).collect()
    assert len(out) == len(ODD) and {r.size for r in out if r.doc_id == 5} == {16}
    assert sharding.sharded_documents(empty, 4).count() == 0


def test_place_takes_highest_dot_product():
    room = np.array([[1.0, 0.2, 0.5], [0.5, 1.0, 0.5]])
    assert sharding.place(np.array([[0.5, 0.0, 0.1], [0.0, 0.3, 0.1]]), room).tolist() == [0, 1]
    assert np.allclose(room, [[0.5, 0.2, 0.4], [0.5, 0.7, 0.4]])


def brute_containment(docs, items, n=5, t=0.8):
    out = []
    for d, text in docs:
        own = decontaminate.real_shingles(decontaminate.lowered(text), n)
        for i, item in items:
            need = decontaminate.real_shingles(decontaminate.lowered(item), n)
            if need and len(need & own) >= t * len(need):
                out.append((d, i, len(need), len(need & own)))
    return sorted(out, key=str)


def found_rows(df):
    return sorted([(r.doc_id, r.item_id, r.item_shingles, r.shared_shingles) for r in df.collect()], key=str)


def test_containment_equals_brute_force(spark):
    assert found_rows(queries.op2_decontamination(spark, SMALL)) == brute_containment(given("documents", "doc_id", "text"), given("benchmark", "item_id", "text"))


def test_containment_odd_rows_and_blocks(spark, docs, empty):
    items = [(1, "x x x x x x"), (1, "x x x x x x"), (2, None), (3, ""), (4, "A"), (None, "same TEXT"), (6, "never seen at all in any of these")]
    table = spark.createDataFrame([(*r, "doc") for r in items], "item_id long, text string, doc_id string")
    want = brute_containment([(r.doc_id, r.text) for r in docs.collect()], items)
    assert found_rows(decontaminate.contained_items(docs, table)) == want and len(want) == 5
    assert found_rows(decontaminate.contained_items(docs, table, words_per_block=4)) == want
    assert decontaminate.contained_items(empty, table).count() == 0 and decontaminate.contained_items(docs, table.limit(0)).count() == 0
    assert decontaminate.without_contaminated(docs, table).count() == len(ODD) - 4


def test_decontamination_judges_rows(spark):
    rows = [(None, "one two three four five six"), (None, "clean text"), (None, None), (4, "seven eight nine ten eleven"), (4, "other clean text"), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    items = spark.createDataFrame([(1, "one two three four five six"), (2, "seven eight nine ten eleven")], "item_id long, text string")
    want = sorted([rows[1], rows[2], rows[4], rows[5]], key=str)
    for block in (2_000_000, 4):
        out = decontaminate.without_contaminated(docs, items, words_per_block=block)
        assert out.schema == docs.schema and sorted(map(tuple, out.collect()), key=str) == want


def test_short_item_in_very_long_document(spark):
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in rng.integers(0, 5_000, 60_000)]
    item = [f"q{k}" for k in range(15)]
    words[30_000:30_000] = item[:14] + ["other"]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item)), (2, "q1 q2 q9 q4 q5 q6")], "item_id long, text string")
    assert found_rows(decontaminate.contained_items(docs, items)) == [(1, 1, 11, 10)]


def test_packing_contract(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    texts = dict(given("documents", "doc_id", "text"))
    rows = queries.op5_packing(spark, SMALL).collect()
    bins = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    for doc_id, own in pieces.items():
        ids = [*plain.encode(texts[doc_id], add_special_tokens=False).ids, 0]
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids)
        assert all(r.length == 2048 for r in own[1:])
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    assert set(pieces) == set(texts)
    assert len(bins) <= 1.03 * sum(r.length for r in rows) / 2048 + 1


def brute_best_two(lengths, room):
    left, bins = sorted(lengths, reverse=True), []
    while left:
        content = []
        for size in list(left):
            if size <= room - sum(content):
                content.append(size)
                left.remove(size)
        gap = room - sum(content)
        if gap and len(content) > 1:
            smallest = content[-1]
            pairs = [(a, b) for i, a in enumerate(left) for b in left[i + 1 :] if smallest < a + b <= gap + smallest]
            if pairs:
                a, b = max(pairs, key=sum)
                content[-1:] = [a, b]
                left.remove(a)
                left.remove(b)
                left = sorted([*left, smallest], reverse=True)
        bins.append(sorted(content))
    return bins


def test_best_two_fit_equals_plain_version():
    rng = np.random.default_rng(3)
    for room, n in [(30, 60), (100, 80), (100, 1), (50, 0)]:
        lengths = rng.integers(1, room + 1, n)
        which, place = packing.best_two_fit(lengths, room)
        bins = [sorted(lengths[which == k].tolist()) for k in range(which.max() + 1 if n else 0)]
        assert [sum(b) for b in bins] == [sum(b) for b in brute_best_two(lengths.tolist(), room)]
        assert all(sum(b) <= room for b in bins)


def test_packing_odd_rows(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    out = packing.packed_documents(docs, path).toPandas()
    assert (out[out.doc_id == 5].length == 1).all() and len(out[out.piece == 0]) == len(ODD)
    assert packing.packed_documents(empty, path).count() == 0
    ids = packing.token_pieces(docs, path, with_ids=True).filter("doc_id = -3").first().ids
    assert np.frombuffer(ids, "<u4")[-1] == 0


def test_quality_held_out(spark):
    labels = dict(duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall())
    rows = queries.op6_quality(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    own = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in own) / len(own) > 0.95
    assert sum(a for a, b in own if not b) <= 0.2 * sum(not b for a, b in own)


def test_prior_and_odd_rows(spark, docs, empty):
    rng = np.random.default_rng(5)
    good, bad = rng.normal(0, 1, (3000, 4)), rng.normal(3, 1, (600, 4))
    model = quality.fit_pu(good[:1500], np.vstack([good[1500:], bad]))
    assert abs(model.prior - 1500 / 2100) < 0.08
    assert (model.scores(good) >= 0.5).mean() > 0.95 and (model.scores(bad) < 0.5).mean() > 0.9
    labels = spark.createDataFrame([(5, 1), (None, 1), (7, None), (7, 0)], "doc_id long, quality int")
    assert quality.scored_documents(docs, labels).count() == len(ODD)
    assert {r.score for r in quality.scored_documents(docs, labels.limit(0)).collect()} == {1.0}
    assert quality.scored_documents(empty, labels).count() == 0
    assert quality.score(docs, model=None).columns == [*docs.columns, "quality_score"]


def test_licences(spark, empty):
    mit = licences.KNOWN[3][1]
    spelled = mit.replace("sublicense", "Sub-License").replace("year holder", "2020 Someone Else").upper().replace("\n\n", "\n")
    texts = [mit, spelled, "Intro.\n\nlicensed under the APACHE licence, version 2.0!", "(c) 2020 A\nReleased under the MIT License", "under the MIT License.", None, ""]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, licence string")
    got = {(r.doc_id, r.licence, r.unit) for r in licences.scan(docs, licences.known_texts(spark)).collect()}
    assert {(0, "MIT", "text"), (1, "MIT", "text"), (2, "Apache-2.0", "line"), (2, "Apache-2.0", "paragraph"), (3, "MIT", "text"), (3, "MIT", "line")} <= got
    assert not {r for r in got if r[0] > 3}
    assert licences.scan(empty, licences.known_texts(spark)).count() == 0


def test_archives_contract(spark):
    pages = dict(given("pages", "page_id", "html"))
    rows = queries.op8_warc(spark, SMALL).collect()
    first = {}
    for k in sorted(pages):
        first.setdefault(pages[k] or "", k)
    assert len(rows) == len(pages)
    for r in rows:
        raw = (pages[r.page_id] or "").encode()
        origin = first[pages[r.page_id] or ""]
        want = ("response", None) if origin == r.page_id else ("revisit", origin)
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert (r.record_type, r.refers_to) == want


def test_archives_odd_rows(spark):
    html = [None, "", "", "long é" * 9000, "long é" * 9000, "a\r\n\r\nb", "a\r\n\r\nb", "a\r\n\r\nb"]
    ids = [3, 2, None, 5, 4, None, 6, 6]
    pages = spark.createDataFrame([(i, f"http://e/{k}\r\nX: y {k}", h, "z") for k, (i, h) in enumerate(zip(ids, html))], "page_id long, url string, html string, digest string")
    out = warc.archive_round_trip(pages, common.new_folder(spark, "test"), segment_bytes=1000).toPandas()
    assert len(out) == 8
    assert sorted(len(p) for p in out.payload if p is not None) == [0, 6, len(("long é" * 9000).encode())]
    got = {(None if np.isnan(r.page_id) else int(r.page_id), r.record_type, None if np.isnan(r.refers_to) else int(r.refers_to)) for r in out.astype({"page_id": float, "refers_to": float}).itertuples()}
    assert got == {(2, "response", None), (3, "revisit", 2), (None, "revisit", 2), (4, "response", None), (5, "revisit", 4), (6, "response", None), (6, "revisit", 6), (None, "revisit", 6)}
    assert warc.archive_round_trip(pages.limit(0), common.new_folder(spark, "test")).count() == 0
    large = warc.archive_round_trip(pages, common.new_folder(spark, "test"), least_revisit=100)
    assert large.filter("record_type = 'revisit'").count() == 1


def test_missing_segment_is_noticed(spark):
    rows = [("response", "<a>", None, 1, None, 1, b"ab"), ("continuation", "<b>", "<a>", 3, 6, None, b"ef"), ("response", "<c>", None, 1, None, 2, b"ab"), ("continuation", "<d>", "<c>", 2, 4, None, b"cd")]
    records = spark.createDataFrame(rows, "kind string, record_id string, origin string, segment long, total_length long, page_id long, block binary")
    records = records.withColumns({"refers_to": F.lit(None).cast("long"), "url": F.lit("u"), "digest": F.lit("d"), "payload_length": F.lit(None).cast("long")})
    assert {(r.page_id, bytes(r.block), r.complete) for r in warc.reassembled(records).collect()} == {(1, b"abef", False), (2, b"abcd", True)}
    assert warc.unchunked(warc.chunked(b"abc" * 9000)) == b"abc" * 9000
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nab\r\n")


def test_token_files_contract(spark):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = {r.doc_id: r for r in queries.op10_token_files(spark, SMALL).collect()}
    at = 0
    for doc_id, text in sorted(given("documents", "doc_id", "text")):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        r = rows[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_token_files_odd_rows_and_select(spark, docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    files = token_files.write_token_files(docs, path, common.new_folder(spark, "test"), documents_per_file=4)
    out = token_files.read_token_files(files, ids_per_read=7).orderBy("start").collect()
    assert [r.doc_id for r in out] == [None, None, -3, 1, 2, 5, 7, 8, 9, 9] and len(files.collect()) > 1
    row = next(r for r in files.collect() if r.n_docs > 1)
    with common.input_file(row.file) as source:
        stored = token_files.TokenFile(source)
        own = [r for r in out if r.part == row.part]
        assert [stored.document(k).tobytes() for k in range(stored.n_docs)] == [bytes(r.ids) for r in own]
    none = token_files.write_token_files(empty, path, common.new_folder(spark, "test"))
    assert none.count() == 0 and token_files.read_token_files(none).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(2)
    for values, universe in [([], 0), ([0], 0), ([5] * 700, 5), (np.sort(rng.integers(0, 10**9, 3000)), 10**9), (np.sort(rng.integers(0, 2**62, 50)), 2**62)]:
        values = np.array(values, np.int64)
        coded = token_files.EliasFano.encode(values, universe)
        assert coded.all().tolist() == values.tolist() == [coded.select(k) for k in range(len(values))]
    dense = token_files.EliasFano.encode(np.arange(0, 10**6, 500), 10**6)
    assert dense.bits_used < 2000 * 13
