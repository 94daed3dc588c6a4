"""64-bit identifiers stay exact beside null ones, in one batch, in every operator."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from basketspark.llm import decontaminate, language_id, language_model, near_duplicates, packing, quality, token_files, tokens, warc
from basketspark.llm.common import new_folder

IDS = [None, 2**53 + 1, 2**53 + 3]
TEXT = "the quick brown fox jumps over the lazy dog near the old river bank today"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"{TEXT} {k}", "en", i) for k, i in enumerate(IDS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, more long").coalesce(1)


def ids_of(df, column="doc_id"):
    return sorted((r[0] for r in df.select(column).collect()), key=lambda i: -1 if i is None else i)


def test_text_operators_keep_ids(spark, docs):
    items = spark.createDataFrame([(2**53 + 1, TEXT)], "item_id long, text string")
    hits = decontaminate.contained_items(docs, items)
    assert ids_of(hits) == IDS and ids_of(hits, "item_id") == [2**53 + 1] * 3
    assert ids_of(language_model.score_documents(docs, F.lit(True))) == IDS
    assert ids_of(packing.packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))) == IDS
    files = token_files.write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), new_folder(spark, "ids"))
    assert ids_of(token_files.read_token_files(files)) == IDS
    assert ids_of(language_id.identified(docs, F.lit(True))) == IDS
    rows = near_duplicates.near_duplicate_classes(docs, words=2).collect()
    assert {(r.doc_id, r.component_id) for r in rows} == {(None, None), (IDS[1], IDS[1]), (IDS[2], IDS[1])}


def test_scores_keep_ids_and_other_columns(docs):
    out = quality.score(docs, None)
    assert ids_of(out) == IDS and ids_of(out, "more") == IDS


def test_archives_keep_ids(spark):
    pages = spark.createDataFrame([(i, "u", h) for i, h in zip([*IDS, 2**53 + 5], ["a", "a", "b", "b"])], "page_id long, url string, html string").coalesce(1)
    out = warc.archive_round_trip(pages, new_folder(spark, "warc"))
    got = {(r.page_id, r.record_type, r.refers_to) for r in out.collect()}
    assert got == {(None, "revisit", IDS[1]), (IDS[1], "response", None), (IDS[2], "response", None), (2**53 + 5, "revisit", IDS[2])}


def test_rows_alike_are_dealt_to_several_tasks(spark):
    pieces = spark.createDataFrame([(None, 0, 0, 700, 5)] * 300, packing.PIECES)
    out = packing.pack(pieces, pieces_per_task=50).collect()
    assert len(out) == 300 and len({r.sequence_id >> 32 for r in out}) > 2
    assert max(sum(r.length for r in out if r.sequence_id == s) for s in {r.sequence_id for r in out}) <= 2048


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_special_strings_are_those_of_the_plain_call(file):
    from tokenizers import Tokenizer

    plain, own = Tokenizer.from_file(public_tokenizers.path(file)), tokens.Encoder(public_tokenizers.path(file))
    marks = [t.content for t in plain.get_added_tokens_decoder().values()]
    texts = [f"a {m} b" for m in marks] + [f"x{m}y\n{m}" for m in marks] + [f"one  {m.upper()} {m.lower()}  two" for m in marks] + ["plain text"]
    for text, raw in zip(texts, own.ids(texts)):
        assert list(memoryview(raw).cast("I")) == plain.encode(text, add_special_tokens=False).ids
