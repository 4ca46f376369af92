"""Every registered query of the subpackage on the smallest tables, and the pipeline against brute force."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from rateflow.llm import language, oracles, queries
from suite import check
from tests.llm import brute

COLUMNS = {
    "op1": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op2": {"doc_id": "bigint", "component_id": "bigint", "n_links": "bigint"},
    "op3": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op5": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string",
            "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op6": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op7": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint",
            "base_sha256": "string", "spans": "string"},
    "op8": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string",
            "contaminated": "boolean"},
    "op9": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op10": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op11": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op12": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    "op13": {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"},
}


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r[0]: r[1] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def _rows(spark, sf_dir, name):
    return {r.doc_id: r for r in queries.ALL[name](spark, sf_dir).collect()}


@pytest.mark.parametrize("name", list(queries.ALL))
def test_columns_and_rows(spark, sf_dir, texts, name):
    df = contract.queries()[name](spark, sf_dir)
    wanted = COLUMNS[name.split("_")[0]]
    assert {k: v for k, v in df.dtypes if k in wanted} == wanted
    if name.startswith(("op11", "op12", "op13")):  # these rank; their rows are compared with SQL
        return
    ids = [r[0] for r in df.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and (set(ids) == set(texts) or name.startswith("op2") and set(ids) < set(texts))


@pytest.mark.parametrize("name", list(oracles.ALL))
def test_query_equals_its_sql(spark, sf_dir, name):
    cursor = check.connect(sf_dir).execute(oracles.ALL[name])
    order = [c[0] for c in cursor.description]
    assert brute.same(queries.ALL[name](spark, sf_dir).select(*order).collect(), cursor.fetchall())


def test_encoded_and_counted_queries(spark, sf_dir, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for i, r in _rows(spark, sf_dir, "op6_sentencepiece").items():
        ids = library.encode(texts[i], add_bos=True, add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), brute.sha(library.decode(ids)))


def test_simhash_query(spark, sf_dir, texts):
    got = _rows(spark, sf_dir, "op10_simhash_near_dedup").values()
    assert brute.same(got, brute.simhash_groups(sorted(texts.items())))


def test_personal_data_query(spark, sf_dir, texts):
    for i, r in _rows(spark, sf_dir, "op7_personal_data").items():
        base = brute.personal(texts[i])
        assert r.base_sha256 == brute.sha(",".join(base)) and r.spans.startswith(",".join(base))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in base) for k, _ in brute.PII]


def test_passage_query(spark, sf_dir, texts):
    """Every document with 50 words of another is found, in one class with it."""
    places = {}
    for i, t in texts.items():
        words = brute.words_of(t)
        for at in range(len(words) - 49):
            places.setdefault(tuple(words[at:at + 50]), set()).add(i)
    shared = [sorted(s) for s in places.values() if len(s) > 1]
    got = _rows(spark, sf_dir, "op2_substring_dedup")
    assert {i for s in shared for i in s} <= set(got)
    assert all(len({got[i].component_id for i in s}) == 1 for s in shared)


def _brute_pipeline(docs, items):
    """The stages in plain Python over rows (doc_id, text, lang); the language model runs outside Spark."""
    model = language.Model(sorted({(t, g) for i, t, g in docs if None not in (i, t, g)}))
    names, score = language.Labeller(model).label([t or "" for _, t, _ in docs])
    docs = [d for d, n, s in zip(docs, names, score, strict=True) if n != "und" and s >= corpus_pipeline.LEAST_SHARE]
    docs = [(i, t) for i, _, _, t in brute.kept_lines([d[:2] for d in docs])]
    docs = [d for d, g in zip(docs, brute.simhash_groups(docs), strict=True) if d[0] == g[2]]
    hits = brute.contamination(docs, items)
    docs = [d for d, (_, n, h, _) in zip(docs, hits, strict=True) if not (h and 20 * h >= n)]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    coded = [library.encode(t, add_bos=True, add_eos=True) for _, t in docs]
    return [(i, library.decode(ids), ids) for (i, _), ids in zip(docs, coded, strict=True)]


def test_pipeline_equals_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    out = contract.queries()["pipeline"](spark, sf_dir)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "token_ids", "n_tokens"]
    assert brute.same(out.select("doc_id", "text", "token_ids").collect(), _brute_pipeline(docs, items))
    assert out.where(F.size("token_ids") != F.col("n_tokens")).isEmpty()


def test_stages_keep_the_columns_and_stand_odd_rows(spark, sf_dir):
    for rows in (brute.odd_rows(), []):
        docs = brute.frame(spark, rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, sf_dir)
            assert after.columns == docs.columns and after.count() <= docs.count(), name
            docs = corpus_pipeline.stored(after, name)
        assert corpus_pipeline.encode(spark, docs, sf_dir).count() == docs.count()
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
