"""Top-k search by inner product, ranked lexical search and the source divergence audit."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rateflow.llm import divergence, lexical, maxscore, terms
from tests.llm import brute

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- words ---------------------------------------------------------------

def test_runs_equal_patterns():
    import pyarrow as pa
    texts = ["", "Ab1 c", "x", " ", "É日本 語-A\x00b\x7fc", "", "end ", "next"] + [r[1] or "" for r in brute.odd_rows()]
    array = pa.array([t.encode() for t in ["skipped", *texts]], pa.binary())[1:]
    for table, pattern in ((terms.LETTERS_DIGITS, WORD), (terms.LETTERS, LETTERS)):
        words, counts = terms.runs(array, table)
        wanted = [pattern.findall(_lower(t)) for t in texts]
        assert [w.decode() for w in words.to_pylist()] == [w for ws in wanted for w in ws]
        assert list(counts) == list(map(len, wanted))
    chunks, _ = terms.runs(array, terms.CHUNKS, lower=False)
    assert [c.decode() for c in chunks.to_pylist()] == [c for t in texts for c in re.findall(r"[^\x20\x09-\x0D]+", t)]
    assert len(terms.runs(pa.array([], pa.binary()), terms.CHUNKS)[0]) == 0


# --- top-k ---------------------------------------------------------------

def _vectors(spark, rows):
    extra = [(i, v, "x", 1, 2.0, "y") for i, v in rows]
    kinds = "vec_id bigint, embedding array<double>, query string, v int, theta double, score string"
    return spark.createDataFrame(extra, kinds).repartition(5)


def _nearest(rows, asked, k):
    """(query_id, rank, vec_id, score) of distinct asked vectors, in Python's integers."""
    def whole(v):
        taken = v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)
        return tuple(math.floor(1024 * x) for x in v) if taken else None

    rows = [(i, whole(v)) for i, v in rows if i is not None and whole(v) is not None]
    out = []
    for i, q in sorted(set(r for r in rows if asked(r[0]))):
        scored = [(min(max(sum(a * b for a, b in zip(q, v)), -2**63), 2**63 - 1), j) for j, v in rows if j != i]
        best = sorted(scored, key=lambda s: (-s[0], s[1]))[:k]
        out += [(i, n + 1, j, s) for n, (s, j) in enumerate(best)]
    return out


@pytest.mark.parametrize("block_bytes, shard", [(maxscore.BLOCK_BYTES, maxscore.SHARD_ROWS), (600, 7)])
def test_top_k_equals_brute_force(spark, monkeypatch, block_bytes, shard):
    monkeypatch.setattr(maxscore, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(maxscore, "SHARD_ROWS", shard)
    monkeypatch.setattr(maxscore, "SEED_ROWS", 20)
    rng = np.random.default_rng(3)
    near = rng.normal(size=(6, 12))
    rows = [(int(i), (near[i % 6] + 0.3 * rng.normal(size=12)).tolist()) for i in range(220)]
    rows += [(300 + i, rows[4][1]) for i in range(25)] + [rows[10], rows[10]]  # ties and repeated rows
    rows += [(10, rows[11][1])]  # an id with another vector
    rows += [(None, rows[0][1]), (401, None), (402, []), (403, [1.0, None]), (404, [float("nan")] * 12), (410, [float("inf")] * 12),
             (405, [0.0] * 12), (406, rows[3][1][:5]), (420, rows[3][1] * 2), (407, [-x for x in rows[0][1]])]
    df = _vectors(spark, rows)
    got = maxscore.top_k(df, df.where("vec_id % 10 = 0")).collect()
    wanted = _nearest(rows, lambda i: i % 10 == 0, 10)
    assert brute.same(got, wanted)


def test_top_k_of_large_components(spark):
    rows = [(i, [float(10 ** (i % 9)), -3.5 * i, 1e15 * (i % 2)]) for i in range(40)] + [(50, [1e300, 1.0, 1.0]), (51, [-1e300, 2.0, 0.0])]
    df = _vectors(spark, rows)
    assert brute.same(maxscore.top_k(df, df.where("vec_id % 10 = 0"), k=3).collect(), _nearest(rows, lambda i: i % 10 == 0, 3))


def test_top_k_of_few_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    df = _vectors(spark, rows)
    assert brute.same(maxscore.top_k(df, df).collect(), _nearest(rows, lambda i: True, 10))
    assert maxscore.top_k(df, df.limit(0)).count() == 0
    assert maxscore.top_k(df.limit(0), df.limit(0)).count() == 0


def test_non_essential_terms_are_probed_only_while_competitive():
    rng = np.random.default_rng(1)
    rows = np.floor(40 * rng.normal(size=(500, 30)))
    packed = [r.astype("<f8").tobytes() for r in rows]
    best = maxscore.Best(range(1000, 1003), packed[:3], None, 5)
    best.add(np.arange(500), packed)
    theta = best.theta.copy()
    q, r, score = best._maxscore(np.arange(3), rows)
    wanted = rows[:3] @ rows.T
    assert (score == wanted[q, r]).all() and len(q) < 60
    assert {*zip(q, r)} == {*zip(*np.nonzero(wanted >= theta[:, None]))}


# --- lexical -------------------------------------------------------------

def _ranked(docs, items, k):
    docs = [(i, Counter(WORD.findall(_lower(t)))) for i, t in docs]
    n_docs, n_words = sum(bool(c) for _, c in docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    held = {}
    for i, t in items:
        held.setdefault(i, set()).update(WORD.findall(_lower(t)))
    out = []
    for item, asked in held.items():
        scored = []
        for i, c in docs:
            m = 50 + 50 * sum(c.values()) * n_docs // n_words if c else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in asked if t in c)
            if s > 0 and i is not None:
                scored.append((-s, i))
        out += [(item, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return out


@pytest.mark.parametrize("block_bytes, bucket, sample", [(lexical.BLOCK_BYTES, lexical.BUCKET_ROWS, 4096), (400, 8, 16)])
def test_ranking_equals_brute_force(spark, monkeypatch, block_bytes, bucket, sample):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(lexical, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(lexical, "SAMPLE_ROWS", sample)
    rng = random.Random(2)
    rows = [r[:2] for r in brute.odd_rows()]
    known = sorted({w for _, t in rows for w in WORD.findall(_lower(t))})
    rows += [(100 + i, " ".join(rng.choices(known, k=rng.randint(1, 80)))) for i in range(120)]
    rows += [(300 + i, rows[60][1]) for i in range(40)]  # copies: ties in the ranking
    items = [(i, " ".join(rng.choices(known, k=rng.randint(1, 12))) + " Unseen") for i in range(12)]
    items += [(3, "word of the third item"), (20, None), (21, ""), (22, "unheard-of"), (None, "word"), (23, rows[60][1].upper())]
    asked = spark.createDataFrame([(*r, "x") for r in items], "item_id bigint, text string, term string")
    got = lexical.rank_documents(brute.frame(spark, [(*r, "en") for r in rows]), asked, k=15)
    assert brute.same(got.collect(), _ranked(rows, items, 15))


def test_ranking_of_and_by_nothing(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert lexical.rank_documents(brute.frame(spark, brute.odd_rows()), none).count() == 0
    one = spark.createDataFrame([(1, "word")], "item_id bigint, text string")
    assert lexical.rank_documents(brute.frame(spark, []), one).count() == 0
    assert lexical.rank_documents(brute.frame(spark, [(1, None, "en"), (2, "--", "en")]), one).count() == 0


def test_buckets_and_rows_out_of_reach_are_skipped(monkeypatch):
    """Long vectors first: what Cauchy-Schwarz or coordinate bounds exclude is never scored exactly."""
    import pyarrow as pa
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        held = np.sort(rng.choice(50, 8, False)).astype("<i4")
        value = (rng.integers(1, 100, 8) * (50 if i < 20 else 1)).astype("<i8")
        rows.append((i, float(np.sqrt((value.astype(float)**2).sum())), held, value))
    rows.sort(key=lambda r: -r[1])
    batch = pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[2].tobytes() for r in rows], pa.binary()),
        pa.array([r[3].tobytes() for r in rows], pa.binary())], names=["doc_id", "length", "terms", "impacts"])
    items = [np.array([1, 5, 9, 30]), np.array([2, 44])]
    seen = []
    original = lexical._Bucket.scores
    monkeypatch.setattr(lexical._Bucket, "scores", lambda self, rows, item: seen.extend(rows) or original(self, rows, item))
    out, = lexical._search(items, [1, 1], 50, 2, 20, [batch])
    wanted = []
    for n, item in enumerate(items):
        scored = sorted((-int(r[3][np.isin(r[2], item)].sum()), r[0]) for r in rows)[:2]
        wanted += [(n, i, -s) for s, i in scored]
    assert brute.same(zip(*(c.to_pylist() for c in out.columns)), wanted)
    assert len(seen) < 60


# --- divergence ----------------------------------------------------------

def _audited(rows, least):
    """(lang, source, part, item, value, rank) in plain Python."""
    docs = [(g or "", s or "", Counter(LETTERS.findall(_lower(t)))) for t, g, s in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in d[2])
        kept = [t for t, n in df.items() if n >= least]
        sources = sorted({d[1] for d in mine})

        def shares(ds):
            count = Counter()
            for d in ds:
                count.update(d[2])
            n = sum(count[t] for t in kept)
            return count, {t: 1 + 10**9 * (count[t] + 5) // (n + 5 * len(kept)) for t in kept}

        whole = shares(mine)[1]
        by = {s: shares([d for d in mine if d[1] == s]) for s in sources}
        for s in sources:
            count, p = by[s]
            pairs = [(-sum(abs(p[t] - by[o][1][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            more = [(whole[t] - p[t], t.encode(), t) for t in kept if count[t] and p[t] > whole[t]]
            out += [(lang, s, "pair", o, -v, n + 1) for n, (v, _, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", t, -v, n + 1) for n, (v, _, t) in enumerate(sorted(more)[:50])]
    return out


def _corpus():
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdeé語", k=rng.randint(1, 3))) for _ in range(60)]
    rows = []
    for i in range(500):
        text = " ".join(rng.choice([w, w.upper(), f"{w},", f"({w}", f"{w}-{w}", f"{w}1{rng.choice(words)}"]) for w in
                        rng.choices(words[i % 5:], k=rng.randint(1, 12)))
        rows.append((text, rng.choice(["en", "en", "de", None]), f"s{min(i % 23, rng.randint(0, 22))}" if i % 9 else None))
    rows += [(rows[0][0], "en", "copies")] * 200
    rows += [("one two", "xx", "a"), ("three", "xx", "b"), (None, "xx", "c"), ("", "yy", "only"), (None, None, None), ("12 34", "en", "digits")]
    return rows + [(r[1], r[2], "odd") for r in brute.odd_rows()]


def _frame(spark, rows):
    kinds = "text string, lang string, source string, term string, piece string, n string, p int"
    return spark.createDataFrame([(*r, "x", "y", "z", 1) for r in rows], kinds).repartition(4)


@pytest.mark.parametrize("sources, piece", [(divergence.SOURCES, divergence.PIECE_BYTES), (4, 300)])
def test_audit_equals_brute_force(spark, monkeypatch, sources, piece):
    monkeypatch.setattr(divergence, "SOURCES", sources)
    monkeypatch.setattr(divergence, "PIECE_BYTES", piece)
    monkeypatch.setattr(divergence, "STEP_BYTES", min(piece, divergence.STEP_BYTES))
    rows = _corpus()
    got = divergence.audit(_frame(spark, rows), min_docs=10)
    assert brute.same(got.collect(), _audited(rows, 10))


def test_term_counts_are_of_distinct_documents(spark):
    rows = [("Word, word; word-word x", "en", "a"), ("(word", "en", "a"), ("word", "en", "b"), ("word", "en", "b")]
    got = divergence.term_counts(_frame(spark, rows)).collect()
    assert brute.same(got, [("en", "a", "word", 2, 5), ("en", "a", "x", 1, 1), ("en", "b", "word", 2, 2)])


def test_audit_of_nothing(spark):
    assert divergence.audit(_frame(spark, [])).count() == 0
    got = divergence.audit(_frame(spark, [("few words", "en", "a"), (None, "en", "b")])).collect()
    assert brute.same(got, [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)])


def test_shares_stay_exact_beyond_64_bits(spark):
    row = spark.range(1).select(divergence._share(F.lit(10**13), F.lit(10**15 + 1), F.lit(7))).first()
    assert row[0] == 1 + 10**9 * (10**13 + 5) // (10**15 + 1 + 35)
