"""SimHash, MinHash, compact windows and components, each against brute force."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rateflow.llm import components, fingerprints, simhash, substrings
from tests.llm import brute


def _near_copies(n=60):
    """Texts of which groups differ in few words."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    out = []
    for i in range(n):
        base = random.Random(i // 6).choices(words, k=150)
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            base[rng.randrange(150)] = rng.choice(words)
        out.append((100 + i, " ".join(base)))
    return out


def test_golay_keys_tolerate_one_error():
    golay = simhash.Golay()
    words = np.random.default_rng(1).integers(0, 1 << 23, 3000)
    own = set(zip(*map(np.ndarray.tolist, golay.keys(words)), strict=True))
    for bit in range(23):
        other = set(zip(*map(np.ndarray.tolist, golay.keys(words ^ (1 << bit))), strict=True))
        assert {i for i, _ in own & other} == set(range(3000))
    assert golay.count.max() == 6 and golay.count.min() == 1


def test_bucket_keys_tolerate_three_errors():
    golay, rng = simhash.Golay(), np.random.default_rng(2)
    values = rng.integers(0, 1 << 64, 2000, np.uint64)
    near = values.copy()
    for i in range(2000):
        for bit in rng.choice(64, 3, replace=False):
            near[i] ^= np.uint64(1) << np.uint64(bit)
    a, b = (set(zip(*map(np.ndarray.tolist, simhash.bucket_keys(v, golay)), strict=True)) for v in (values, near))
    assert {i for i, _ in a & b} == set(range(2000))


def test_simhash_equals_brute_force(spark):
    rows = [r[:2] for r in brute.odd_rows()] + _near_copies()
    docs = brute.frame(spark, [(*r, "en") for r in rows])
    wanted = brute.simhash_groups(rows)
    assert brute.same(simhash.near_duplicates(docs).collect(), wanted)
    # a limit under the size of the buckets: chunks are searched in pairs
    assert brute.same(simhash.near_duplicates(docs, limit=2).collect(), wanted)
    left = simhash.one_of_each(docs)
    assert left.columns == docs.columns
    kept = [r[0] for r in left.select("doc_id").collect()]
    assert sorted(i for i in kept if i is not None) == sorted({c for _, _, c in wanted if c is not None})


def test_near_duplicates_of_nothing(spark):
    empty = brute.frame(spark, [])
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0
    assert fingerprints.fingerprint_edits(empty).count() == 0 and fingerprints.near_duplicates(empty).count() == 0
    assert substrings.near_duplicate_passages(empty).count() == 0


def test_components_equal_brute_force(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(500, 600)] + [(7, 7)]
    groups = brute.Groups({x for link in links for x in link})
    for x, y in links:
        groups.join(x, y)
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert got == {x: groups.find(x) for x, y in links + [(y, x) for x, y in links] if any(x in k and k[0] != k[1] for k in links)}


def _shingles(text):
    words = brute.words_of(text)
    return {tuple(words[max(0, i - 4):i + 1]) for i in range(len(words))}


def test_fingerprints_of_edited_texts(spark):
    rows = [r[:2] for r in brute.odd_rows()]
    got = fingerprints.fingerprint_edits(brute.frame(spark, [(*r, "en") for r in rows])).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    wanted = []
    for (i, text), (_, then) in zip(order, order[1:] + order[:1], strict=True):
        text, half = text or "", len(text or "") // 2
        wanted.append((i, len(text), brute.sha(text[:len(text) - half] + (then or "")[:half])))
    assert brute.same([r[:3] for r in got], wanted)
    prints = {}
    for r in got:
        prints.setdefault(r.fingerprint, set()).add((r.doc_id, r.n_chars))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert {(2, 0), (1, 0), (None, 0)} <= next(v for v in prints.values() if (2, 0) in v)
    estimates = []
    for (_, text), (_, then) in zip(order, order[1:] + order[:1], strict=True):
        a, b = _shingles(text), _shingles(then)
        if len(a | b) > 40:
            estimates.append(len(a & b) / len(a | b))
    assert len(estimates) > 5


def test_fingerprint_likeness_follows_jaccard(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(500)], k=300)) for _ in range(20)]
    edits = [" ".join(t.split()[:200]) + " " + u for t, u in zip(texts, reversed(texts), strict=True)]
    a, b = (fingerprints.minhashes([t.encode() for t in x]) for x in (texts, edits))
    true = [len(_shingles(x) & _shingles(y)) / len(_shingles(x) | _shingles(y)) for x, y in zip(texts, edits, strict=True)]
    assert np.abs(fingerprints.likeness(a, b) - true).mean() < 0.05
    assert (fingerprints.likeness(a, a) == 1).all()


def test_banded_joins_equal_brute_force(spark, monkeypatch):
    rows = [r[:2] for r in brute.odd_rows() if r[1]] + _near_copies(40)
    rows = [r for r in rows if r[0] is not None and len(r[1]) < 5000]
    sets = [_shingles(t) for _, t in rows]
    groups = brute.Groups(range(len(rows)))
    for x in range(len(rows)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if rows[x][1] == rows[y][1] or both and both >= 0.8 * len(sets[x] | sets[y]):
                groups.join(x, y)
    least = {}
    for x, (i, _) in enumerate(rows):
        least[groups.find(x)] = min(i, least.get(groups.find(x), i))
    wanted = [(i, least[groups.find(x)]) for x, (i, _) in enumerate(rows)]
    docs = brute.frame(spark, [(*r, "en") for r in rows])
    assert brute.same(fingerprints.near_duplicates(docs).collect(), wanted)
    monkeypatch.setattr(fingerprints, "BUCKET", 2)
    assert brute.same(fingerprints.near_duplicates(docs).collect(), wanted)


def test_compact_windows_hold_each_sequence_once():
    rng = np.random.default_rng(0)
    sizes = np.array([30, 3, 0, 12, 50, 11])
    values = rng.integers(0, 1 << 63, sizes.sum(), np.uint64)
    values[5:10] = values[15:20]
    text, function, _, left, centre, right = substrings.compact_windows(values, sizes, 12)
    ends = np.cumsum(sizes)
    for f in range(substrings.FUNCTIONS):
        hashed = values * substrings._factors()[f] >> np.uint64(24)
        for t, (end, size) in enumerate(zip(ends, sizes, strict=True)):
            own = [w for w in zip(text, function, left, centre, right, strict=True) if w[0] == t and w[1] == f]
            for i in range(size):
                for j in range(i + 11, size):
                    least = i + int(hashed[end - size + i:end - size + j + 1].argmin())
                    assert [c for _, _, a, c, b in own if a <= i <= c <= j <= b] == [least]


def test_passages_are_found_and_clean_texts_left_alone(spark):
    rng = random.Random(4)
    word = lambda n: [f"v{rng.randrange(5000)}" for _ in range(n)]
    passage, common = word(55), word(8)
    edited = passage.copy()
    edited[20] = "other"
    rows = [(i, " ".join(word(40) + passage + word(40))) for i in range(1, 6)]
    rows += [(i, " ".join(word(60) + edited + word(9))) for i in (6, 7)]
    # a short common line is no passage, however many texts have it; nor are 40 equal words
    rows += [(i, " ".join(word(50) + common + word(50))) for i in range(10, 60)]
    half = word(40)
    rows += [(i, " ".join(word(30) + half + word(30))) for i in (70, 71)]
    whole = " ".join(word(80))
    rows += [(80, whole), (81, whole), (82, "short copy"), (83, "short copy"), (84, None), (85, "")]
    got = {r.doc_id: r for r in substrings.near_duplicate_passages(brute.frame(spark, [(*r, "en") for r in rows])).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, 7, 80, 81}
    assert {got[i].component_id for i in range(1, 6)} == {1} and got[80].component_id == got[81].component_id == 80
    assert got[6].component_id == got[7].component_id
    assert all(got[i].spans == "40:95" for i in range(1, 6)) and got[80].spans == "0:80" and got[80].n_copies == 2


def test_passages_with_frequent_keys(spark, monkeypatch):
    """Keys of a large share of texts are paired by broadcast; the result is the same."""
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join([f"q{rng.randrange(9999)}" for _ in range(20)] + passage)) for i in range(40)]
    docs = brute.frame(spark, [(*r, "en") for r in rows])
    got = substrings.near_duplicate_passages(docs).collect()
    assert {r.doc_id for r in got} == set(range(40)) and {r.component_id for r in got} == {0}
    assert {r.spans for r in got} == {"20:80"}
    monkeypatch.setattr(substrings, "HOT_SHARE", 0)
    assert brute.same(substrings.near_duplicate_passages(docs).drop("n_links").collect(), [
        (r.doc_id, r.component_id, r.n_copies, r.spans, r.n_span_words) for r in got])


def test_passages_behind_the_first_text_of_a_key(spark, monkeypatch):
    """A passage of lines that many other texts hold singly: the first text of every key has one line only."""
    rng = random.Random(11)
    word = lambda n: [f"u{rng.randrange(100_000)}" for _ in range(n)]
    lines = [word(11) for _ in range(5)]
    passage = sum(lines, [])
    edited = passage.copy()
    edited[54] = "other"
    rows = [(i, " ".join(word(40) + p + word(40))) for i, p in ((1, passage), (2, passage), (3, edited), (4, passage))]
    rows += [(100 + 60 * k + i, " ".join(word(60) + line + word(60))) for k, line in enumerate(lines) for i in range(60)]
    docs = brute.frame(spark, [(*r, "en") for r in rows])
    for share in (substrings.HOT_SHARE, 0):
        monkeypatch.setattr(substrings, "HOT_SHARE", share)
        got = {r.doc_id: r for r in substrings.near_duplicate_passages(docs).collect()}
        assert set(got) == {1, 2, 3, 4} and {r.component_id for r in got.values()} == {1}
        assert got[1].spans == got[2].spans == got[4].spans == "40:95" and got[3].spans == "40:94"
    # fewer leaders at once give the same
    monkeypatch.setattr(substrings, "MORE_LEADERS", 2)
    again = {r.doc_id: r for r in substrings.near_duplicate_passages(docs).collect()}
    assert {i: (r.component_id, r.spans) for i, r in again.items()} == {i: (r.component_id, r.spans) for i, r in got.items()}


def test_texts_like_a_linked_text_but_not_like_the_first(spark, monkeypatch):
    """Versions of a passage, each near the one before: all that share a passage are in one component, over any of them."""
    rng = random.Random(3)
    rows = []
    for family in range(40):
        version = [f"w{family}x{rng.randrange(9999)}" for _ in range(75)]
        for n in range(4):
            rows.append((10 * family + n, " ".join([f"t{rng.randrange(10**6)}" for _ in range(30)] + version)))
            version = version.copy()
            for at in rng.sample(range(75), 2):
                version[at] = f"e{rng.randrange(10**6)}"
    groups = brute.Groups([i for i, _ in rows])
    for family in range(40):
        own = rows[4 * family:4 * family + 4]
        parts = [(substrings.tokens([t.encode()])[0] >> np.uint64(32)).astype(np.int64) for _, t in own]
        for x in range(4):
            for y in range(x):
                if substrings.passages(parts[x], parts[y], 46):
                    groups.join(own[x][0], own[y][0])
    linked = [i for i, _ in rows if sum(groups.find(i) == groups.find(j) for j, _ in rows) > 1]
    docs = brute.frame(spark, [(*r, "en") for r in rows])
    wanted = {i: groups.find(i) for i in linked}
    assert {r.doc_id: r.component_id for r in substrings.near_duplicate_passages(docs).collect()} == wanted
    monkeypatch.setattr(substrings, "MORE_LEADERS", 2)
    assert {r.doc_id: r.component_id for r in substrings.near_duplicate_passages(docs).collect()} == wanted


def test_repeated_and_scattered_passages_are_verified():
    rng = np.random.default_rng(12)
    token = lambda n: rng.integers(0, 1 << 30, n).astype(np.int32)
    p, q = token(60), token(50)
    doubled = np.concatenate([token(20), p, token(30), p, token(10)])
    b = np.concatenate([token(5), p, token(9)])
    assert {x[:2] for x in substrings.passages(doubled, b, 46)} == {(20, 80), (110, 170)}
    # a passage whose chain runs on through scattered common tokens keeps its own part
    edited = p.copy()
    edited[30] = 1
    left, right = token(300), token(300)
    right[::12] = left[::12]
    found = substrings.passages(np.concatenate([p, left, q]), np.concatenate([edited, right, q]), 46)
    assert any(i0 == 0 and i1 >= 60 for i0, i1, _, _ in found) and any(i0 <= 360 and i1 == 410 for i0, i1, _, _ in found)
    assert substrings.passages(np.zeros(3000, np.int32), np.zeros(2500, np.int32), 46)


def test_texts_with_a_line_in_common_are_told_apart_before_runs(monkeypatch):
    """Tokens of a stretch that are too few for any passage end the comparison; repeats count as often as they must."""
    rng = np.random.default_rng(14)
    token = lambda n: rng.integers(0, 1 << 30, n).astype(np.int32)
    line, edited = token(36), token(60)
    a, b = np.concatenate([token(90), line, token(80), edited]), np.concatenate([token(70), line, token(90), edited])
    b[-20] = 1
    assert len(substrings.passages(a, b, 46)) == 1
    for values in (edited, np.tile(line[:7], 12), rng.integers(0, 30, 200).astype(np.int32)):
        least = min(len(set(values[x:x + 46].tolist())) for x in range(len(values) - 45))
        assert substrings._least_distinct(values, 46) == least
    monkeypatch.setattr(substrings, "_runs", lambda *args: 1 / 0)
    assert substrings.passages(a[:206], b[:196], 46) == []


def test_many_runs_are_chained_as_few():
    rng = np.random.default_rng(15)
    for length in (40, 400):
        runs = np.unique(rng.integers(0, length, (2, 300)), axis=1)[:, :200]
        runs = runs[:, np.lexsort(runs)]
        runs = np.stack([runs[1], runs[0], np.ones(runs.shape[1], np.int64)])
        assert substrings._followed(runs, few=1000) == substrings._followed(runs, few=0) == substrings._followed(runs, few=0, limit=50)
    found = {(int(x), int(x + n), int(y), int(y + n)) for x, y, n in rng.integers(0, 60, (300, 3))}
    assert substrings._outermost(found, few=1000) == substrings._outermost(found, few=0, rows=16)


def test_windows_meet_beyond_many_repeats():
    """A text with a passage many times gives many pairs of one function at one place of the other text."""
    window = lambda f, c: int(substrings._packed(f, c - 40, c, c + 40))
    rows = [(1, 2, window(0, 100), window(0, 100 + 200 * i)) for i in range(40)] + [(1, 2, window(1, 101), window(1, 101 + 200 * 20))]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["a", "b", "a_window", "b_window"])
    got = [r for out in substrings._interval_join(46)([batch]) for r in out.to_pylist()]
    assert got == [{"a": 1, "b": 2, "start": 4060, "stop": 4141}]


def test_odd_rows_have_their_passages(spark):
    got = {r.doc_id: r for r in substrings.near_duplicate_passages(brute.frame(spark, brute.odd_rows())).collect()}
    assert {9, 10, 12} <= set(got) and not {1, 2, 3, 4, 5, 6, 7, 13, 16} & set(got)
    assert got[9].component_id == got[12].component_id == 9


def test_lookup_splits_hot_keys(spark):
    from rateflow.llm.common import lookup
    big = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(3000)], "k bigint, v bigint")
    small = big.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("m")).where("k % 2 = 0")
    got = lookup(big, small, "k", "n").collect()
    most = {r.k: r.m for r in small.collect()}
    assert brute.same(got, [(0 if i % 3 else i, i, most.get(0 if i % 3 else i)) for i in range(3000)])


def _noisy(rng, tokens, share):
    """The tokens with some others in their place."""
    out = tokens.copy()
    some = rng.random(len(out)) < share
    out[some] = rng.integers(1 << 20, 1 << 28, some.sum())
    return out


def test_no_pair_with_a_passage_is_left_out_by_shared_tokens():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 20, 300).astype(np.int32)
    line = np.concatenate([base[:40], np.repeat(base[40:41], 90), np.tile(base[60:75], 6)])
    texts = [_noisy(rng, x, share) for x in (base, line) for share in (0, 0.005, 0.01, 0.02, 0.04, 0.1, 0.3)]
    texts += [np.concatenate([_noisy(rng, x[:k], 0.01), rng.integers(0, 1 << 28, 90).astype(np.int32)])
              for x in (base, line) for k in (10, 36, 45, 46, 60, 140)]
    key = substrings._Key(texts, 46)
    linked = 0
    for n, text in enumerate(texts):
        partners = set(key.partners(n, np.arange(len(texts))).tolist())
        with_passage = {m for m, other in enumerate(texts) if m != n and substrings.passages(other, text, 46)}
        assert with_passage <= partners
        linked += len(with_passage)
    assert linked > 100 and sum(len(key.partners(n, np.arange(len(texts)))) for n in range(len(texts))) < len(texts) ** 2 * 0.7


def test_kept_passages_hold_all_words():
    rng = np.random.default_rng(4)
    words = lambda found, side: {w for p in found for w in range(p[side], p[side + 1])}
    for n in (1, 2, 3, 8, 60):
        for _ in range(40):
            i, j = rng.integers(0, 200, n), rng.integers(0, 200, n)
            found = list(zip(i.tolist(), (i + rng.integers(1, 60, n)).tolist(), j.tolist(), (j + rng.integers(1, 60, n)).tolist(), strict=True))
            kept = substrings._covering(found)
            assert set(kept) <= set(found) and all(words(kept, side) == words(found, side) for side in (0, 2))
    same = np.zeros(120, np.int32)
    assert len(substrings.passages(same, same[:100], 46)) > 20
    assert len(substrings._covering(substrings.passages(same, same[:100], 46))) <= 4


def test_texts_with_only_a_line_in_common_are_not_compared(spark, monkeypatch):
    rng = np.random.default_rng(5)
    word = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 1 << 30, n))
    line, passage = word(30), word(60)
    texts = [f"{word(40)} {line} {word(80)}" for _ in range(60)] + [f"{word(20)} {line} {passage} {word(30)}" for _ in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wanted = {tuple(r) for r in substrings.near_duplicate_passages(docs).collect()}
    assert {r[0] for r in wanted} == set(range(60, 66)) and len({r[1] for r in wanted}) == 1
    monkeypatch.setattr(substrings, "MORE_LEADERS", 10)
    rows, narrowed = [], substrings._narrowed

    def counted(members, lists, shortest):
        left = narrowed(members, lists, shortest)
        rows.append((members.select("text").distinct().count(), left.select("text").distinct().count()))
        return left

    monkeypatch.setattr(substrings, "_narrowed", counted)
    got = {tuple(r) for r in substrings.near_duplicate_passages(docs).collect()}
    assert {r[:2] + r[3:] for r in got} == {r[:2] + r[3:] for r in wanted}
    before, after = rows[0]
    assert before > 50 and after < 20  # groups of few texts are not looked at
