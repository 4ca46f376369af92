"""Line dedup, the Bloom filter pair and benchmark decontamination."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rateflow.llm import bloom, decontaminate, line_dedup
from tests.llm import brute

ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"), (2, "Short, item!"), (3, None),
    (4, ""), (None, "nameless item of some words"), (1, "another text of the first item"), (5, "??? --")]
TEXTS = [
    (1, "x y One two, three four five six seven eight nine ten eleven twelve thirteen fourteen! z"), (2, "a short ITEM b short item"),
    (3, None), (4, ""), (5, "nameless item of some words, and " + "more words " * 60), (6, "two three four five six seven eight nine ten eleven twelve thirteen"),
    (7, "short"), (None, "short item"), (8, "short\x00item"), (8, "short\x00item"), (9, "short é item"),
    (10, "another text of the first item" + " filler" * 114), (11, "another text of the first item" + " filler" * 115)]


@pytest.mark.parametrize("bits", [1 << 16, 64])
def test_line_dedup_equals_brute_force(spark, bits, monkeypatch):
    monkeypatch.setattr(line_dedup.bloom, "size_for", lambda *a: bits)  # 64 bits: every key is suspected
    rows = brute.odd_rows()
    kept = line_dedup.dedup_lines(brute.frame(spark, rows))
    got = kept.select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert brute.same(got, brute.kept_lines([r[:2] for r in rows]))
    docs = line_dedup.replaced(kept)
    assert docs.columns == brute.frame(spark, rows).columns
    assert docs.where(F.col("n_chars") != F.length("text")).isEmpty()


def test_line_dedup_of_nothing(spark):
    assert line_dedup.dedup_lines(brute.frame(spark, [])).count() == 0


def test_twice_filter_misses_no_repeat(spark):
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 1 << 63, 4000)
    rows = spark.createDataFrame([(int(k),) for k in keys] + [(int(k),) for k in keys[:500]], "k bigint").repartition(6)

    def fill(batches):
        pair = bloom.Pair(1 << 16)
        for batch in batches:
            pair.add(batch.column(0).to_numpy().view(np.uint64))
        yield from pair.batches()

    partial = rows.mapInArrow(fill, bloom.PARTIAL)
    twice = bloom.twice_filter(partial, 1 << 16)
    found = bloom.contains(twice, keys.astype(np.uint64))
    assert found[:500].all() and found[500:].mean() < 0.1
    assert bloom.contains(bloom.once_filter(partial, 1 << 16), keys.astype(np.uint64)).all()


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 300])
def test_contamination_equals_brute_force(spark, block_bytes):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    rows = TEXTS + [r[:2] for r in brute.odd_rows()]
    docs = brute.frame(spark, [(*r, "en") for r in rows])
    found = decontaminate.find_hits(docs, items, block_bytes=block_bytes)
    got = found.select("row.doc_id", "n_words", decontaminate.n_hit(), "items").collect()
    assert brute.same(got, brute.contamination(rows, ITEMS))


def test_contaminated_documents_and_spans_go(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = brute.frame(spark, [(*r, "en") for r in TEXTS])
    left = decontaminate.without_documents(docs, items)
    assert left.columns == docs.columns
    # six of 120 words are exactly a twentieth, six of 121 are less
    assert {r[0] for r in left.select("doc_id").collect()} == {3, 4, 5, 6, 7, 9, 11}
    cut = {r[0]: r[1] for r in decontaminate.without_spans(docs, items).select("doc_id", "text").collect()}
    assert cut[1] == "x y ! z" and cut[2] == "a  b " and cut[3] is None and cut[6] == TEXTS[5][1]


def test_contamination_of_and_by_nothing(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.find_hits(brute.frame(spark, []), none).count() == 0
    docs = brute.frame(spark, brute.odd_rows())
    assert decontaminate.find_hits(docs, none).where("size(hits) > 0 OR size(items) > 0").isEmpty()
