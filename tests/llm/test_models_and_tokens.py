"""Language, toxicity, personal data, encoding and token counts."""

import itertools
import math
import random
import re
import time
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import regex
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rateflow.llm import language, pieces, pii, token_counts, toxicity
from rateflow.llm.common import first_of_labels
from tests.llm import brute

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = [" ", "  ", "▁", "a", "B", "the", "'s", "don't", "1", "½", "é", "́", "日本", "𝒳", "\n", "\x1c", "\x85", "\xa0", "ΑΣ", "İ",
            "ﬁ", "!?", "\x00", "aaaa", "abab", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "<0x41>", "�"]


def _random_texts(n):
    rng = random.Random(8)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, 30))) for _ in range(n)] + [
        "".join(rng.choices("etaoinshr", k=2000)), "a" * 999, "ab" * 500, "▁" * 50]


def test_chain_probabilities_equal_enumeration():
    rng = np.random.default_rng(0)
    sizes = np.array([3, 1, 4])
    emission, transition, start = rng.normal(size=(8, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    marginal, moves, starts = language.forward_backward(emission, transition, start, sizes)
    at, wanted, all_moves, all_starts = 0, np.zeros((8, 3)), np.zeros((3, 3)), np.zeros(3)
    for n in sizes:
        weights = {y: np.exp(start[y[0]] + sum(emission[at + i, y[i]] for i in range(n)) + sum(
            transition[y[i], y[i + 1]] for i in range(n - 1))) for y in itertools.product(range(3), repeat=int(n))}
        for y, w in weights.items():
            p = w / sum(weights.values())
            for i in range(n):
                wanted[at + i, y[i]] += p
            for i in range(n - 1):
                all_moves[y[i], y[i + 1]] += p
            all_starts[y[0]] += p
        at += n
    assert np.allclose(marginal, wanted) and np.allclose(moves, all_moves) and np.allclose(starts, all_starts)


def test_languages_share_the_learned_words(monkeypatch):
    """A language of short texts keeps its words beside one of long texts."""
    seen = {}
    shared = language.Model._shared
    monkeypatch.setattr(language.Model, "_shared", lambda self, *a: seen.setdefault("pieces", shared(self, *a)))
    rows = [(" ".join(f"lang{i % 97}" for i in range(20_000)), "aa")] + [("ein kurzer text", "bb") for _ in range(300)]
    language.Model(rows, max_words=2000)
    words = [sum(len(p) for i, p in seen["pieces"] if i == n) for n in (0, 1)]
    assert words[1] >= 900 and 1000 <= words[0] <= 1300


def test_pipeline_keeps_texts_when_no_language_is_known(spark):
    docs = brute.frame(spark, [(1, "some words", None), (2, "12 34", None), (3, None, None)])
    assert [r.doc_id for r in corpus_pipeline.identify_language(spark, docs, "").collect()] == [1]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def language_model(documents):
    return language.train(documents, F.crc32(F.col("doc_id").cast("string")) % 3 != 1, max_rows=60)


def test_held_out_languages(documents, language_model):
    found = language.label_documents(documents, language_model).where(F.crc32(F.col("row.doc_id").cast("string")) % 3 == 1)
    right = found.agg(F.avg((F.col("row.lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right[0] > 0.99 and 0 <= right[1] <= right[2] <= 1


def test_words_of_mixed_texts(spark, documents, language_model):
    """Texts put together from two languages: most words get the language of their own part."""
    texts = {r[1]: r[0].split()[:40] for r in documents.where("lang IN ('en', 'de') AND n_chars > 900").orderBy(F.desc("doc_id"))
             .limit(60).select("text", "lang").collect()}
    mixed = spark.createDataFrame([(1, " ".join(texts["en"] + texts["de"]))], "doc_id bigint, text string")
    words = language.label_words(mixed, language_model).first().words
    wanted = ["en"] * sum(map(language._has_letter, texts["en"])) + ["de"] * sum(map(language._has_letter, texts["de"]))
    assert len(words) == len(wanted)
    assert np.mean([w.lang == g for w, g in zip(words, wanted, strict=True)]) > 0.9


def test_language_of_odd_rows(spark, language_model):
    docs = brute.frame(spark, brute.odd_rows())
    got = language.label_documents(docs, language_model)
    assert got.count() == docs.count()
    unknown = {r[0] for r in got.where("lang_pred = 'und'").select("row.doc_id").collect()}
    assert unknown == {None, 1, 2, 3, 4, 15} and got.where("lang_pred = 'und' AND score <> 0").isEmpty()
    assert language.label_words(docs, language_model).where("row.doc_id = 3 AND size(words) > 0").isEmpty()
    empty = brute.frame(spark, [])
    assert language.label_documents(empty, language_model).count() == 0
    nothing = language.train(empty, F.lit(True))
    assert {r[0] for r in language.label_documents(docs, nothing).select("lang_pred").collect()} == {"und"}
    alone = language.train(docs.where("lang = 'fr'"), F.lit(True))
    assert {r[0] for r in language.label_documents(docs, alone).select("lang_pred").collect()} == {"und", "fr"}


def test_held_out_toxicity(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    learn = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    model = toxicity.train(docs, labels, learn)
    held = docs.join(labels.where(~learn), "doc_id")
    rows = toxicity.score(held, model).select("score", "row.toxic").collect()
    score, toxic = np.array([r[0] for r in rows]), np.array([r[1] for r in rows]) == 1
    assert (score[toxic] >= 0.5).mean() > 0.85 and (score[~toxic] >= 0.5).mean() < 0.05
    known, misspelt, plain = model.word_scores(["idiot", "idiott", "the"])
    assert known > misspelt > 0.3 > plain


def test_the_first_ids_of_frequent_and_rare_labels(spark):
    rows = spark.range(40_000).select("id", F.when(F.col("id") % 3 > 0, "often").when(F.col("id") % 1000 == 0, "rare").otherwise("some").alias("label"))
    got = first_of_labels(rows, "label", 50).groupBy("label").agg(F.sort_array(F.collect_list("id")).alias("ids")).collect()
    hashed = {}
    for r in rows.select("label", F.xxhash64("id").alias("h"), "id").collect():
        hashed.setdefault(r.label, []).append((r.h, r.id))
    assert {r.label: r.ids for r in got} == {k: sorted(i for _, i in sorted(v)[:50]) for k, v in hashed.items()}


def test_a_repeated_id_brings_one_text_to_the_driver(spark):
    """2,000 rows of one id and language, and of one id and label."""
    rows = [(1, f"der hund und die katze {i}", "de") for i in range(2000)] + [(2, "the dog and the cat", "en")]
    docs = brute.frame(spark, rows)
    model = language.train(docs, F.lit(True))
    assert model.languages == ["de", "en"]
    labels = spark.createDataFrame([(1, 0, 0), (2, 0, 1)], "doc_id bigint, quality int, toxic int")
    assert toxicity.score(docs, toxicity.train(docs, labels, F.lit(True))).count() == len(rows)


def test_toxicity_of_odd_rows(spark):
    docs = brute.frame(spark, brute.odd_rows())
    labels = spark.createDataFrame([(5, 1, 0), (16, 1, 1), (1, 0, 1), (None, 0, 1), (9, 0, None), (99, 0, 1), (7, 0, 2), (5, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    for learned in (labels, labels.where("toxic = 1"), labels.where("false")):
        got = toxicity.score(docs, toxicity.train(docs, learned, F.lit(True)))
        assert got.count() == docs.count() and got.where("NOT score BETWEEN 0 AND 1").isEmpty()
    assert toxicity.score(brute.frame(spark, []), toxicity.Model([], [])).count() == 0


def test_personal_data_equals_brute_force(spark):
    rng = random.Random(2)
    parts = ["a", "b@", "@", ".", "c.d", "-", "1", "12", "4111 1111 1111 1111", "4111111111111111", "255.1.2.3", "256.1.1.1",
             "1.2.3.4.5.6.7.8", "+1 (555) 555-1234", " ", "  ", "é", "𝒳", "+", "(", ")", "a@b.c", "%", "00", "5500 0000 0000 0004",
             "\n", "0255.0.0.1"]
    rows = [(1000 + i, "".join(rng.choices(parts, k=rng.randint(0, 14))), "en") for i in range(4000)] + brute.odd_rows()
    found = pii.find_personal_data(brute.frame(spark, rows))
    got = found.select("row.doc_id", pii._joined(F.col("base"))).collect()
    assert brute.same(got, [(i, ",".join(brute.personal(t))) for i, t, _ in rows])
    assert pii.digest(pii.find_personal_data(brute.frame(spark, []))).count() == 0


def test_terms_that_reveal_an_entity_go(spark):
    """A name that comes with one address only reveals it; words found everywhere do not."""
    rng = random.Random(3)
    filler = [f"common{i}" for i in range(30)]
    some = lambda n: " ".join(rng.choices(filler, k=n))
    rows = [(i, f"{some(9)} Zaphod wrote from z.b@galaxy.example.com {some(9)}", "en") for i in range(6)]
    rows += [(10 + i, f"{some(40)} wrote {some(20)}", "en") for i in range(300)]
    rows += [(400, rows[0][1], "en"), (401, f"{some(5)} Arthur once wrote from a.d@earth.example.com", "en")]
    found = pii.find_personal_data(brute.frame(spark, rows))
    terms = {r[0]: [rows[[x[0] for x in rows].index(r[0])][1][s.start:s.stop] for s in r[1]]
             for r in found.select("row.doc_id", "terms").collect() if r[1]}
    assert set(terms) == {*range(6), 400} and {t for ts in terms.values() for t in ts} == {"Zaphod", "from"}
    clean = {r[0]: r[1] for r in pii.sanitised(found).select("row.doc_id", "clean_text").collect()}
    assert "[EMAIL]" in clean[0] and "Zaphod" not in clean[0] and "Arthur once" in clean[401] and clean[10] == rows[6][1]


def _revealed(rows):
    """(doc_id, start, stop, replacement) of all term spans, by the definition in plain Python."""
    word = regex.compile(r"[\p{L}\p{N}]{2,}")
    distinct = {t or "" for _, t, _ in rows}
    spans = {t: [(s.split(":")[0], *map(int, s.split(":")[1:])) for s in brute.personal(t)] for t in distinct}
    contexts, pairs, n_term = {}, {}, Counter(w for t in distinct for w in word.findall(t.lower()))
    for t in distinct:
        for kind, a, b in spans[t]:
            entity, shown = f"{kind}:{t[a:b]}", (t[max(0, a - 120):a], t[b:b + 120])
            contexts.setdefault(entity, []).append((t, shown))
            for w in {w.lower() for side in shown for w in word.findall(side)}:
                pairs.setdefault((entity, w), []).append((t, shown))
    seen = lambda found: min(len({t for t, _ in found}), len({s for _, s in found}))
    n_chars, revealed = sum(map(len, distinct)), {}
    for (entity, w), found in pairs.items():
        n_both, n_entity = seen(found), seen(contexts[entity])
        total = max(n_chars / 240, n_entity + 1)
        share = math.log2(total * n_both / (n_entity * n_term[w])) / math.log2(total / n_entity) if n_term[w] else 0
        if n_both >= 3 and share >= 0.6:
            revealed.setdefault(entity, {})[w] = "" if share >= 0.8 else "[NUMBER]" if regex.fullmatch(r"\p{N}+", w) else "[TERM]"
    out = []
    for i, t, _ in rows:
        values = {}
        for kind, a, b in spans[t or ""]:
            for w, v in revealed.get(f"{kind}:{t[a:b]}", {}).items():
                values[w] = min(v, values.get(w, v))
        for m in word.finditer(t or ""):
            apart = not any(a < m.end() and m.start() < b for _, a, b in spans[t])
            if m[0].lower() in values and apart:
                out.append((i, m.start(), m.end(), values[m[0].lower()]))
    return out


def test_term_spans_equal_brute_force(spark):
    """Names of several strengths around entities, in copies, repeats within a text, nulls and texts without entities."""
    rng = random.Random(11)
    filler = [f"common{i}" for i in range(40)] + ["Team", "2024", "wrote"]
    some = lambda n: " ".join(rng.choices(filler, k=n))
    rows = []
    for k in range(12):
        names, entity = [f"Name{k}", f"Plan{k % 3}", f"77{k % 4}"], [f"user{k}@mail.example.com", f"10.0.0.{k}"][k % 2]
        for _ in range(3 + k % 4):
            rows.append(f"{rng.choice(names)} {some(rng.randint(0, 30))} {names[0]} {entity} {some(6)} {names[1]}, {names[2]} {some(rng.randint(0, 40))} {names[0].upper()}")
    rows += [f"{some(30)} {rng.choice(['Name3', 'Plan1', '772'])} {some(10)}" for _ in range(60)] + [rows[0]] * 50 + [rows[4] + " " + rows[4]]
    rows = [(i, t, "en") for i, t in enumerate(rows)] + [(900, None, "en"), (901, "", "en")]
    found = pii.find_personal_data(brute.frame(spark, rows)).select("row.doc_id", F.explode("terms").alias("t"))
    wanted = _revealed(rows)
    assert brute.same(found.select("doc_id", "t.start", "t.stop", "t.value").collect(), wanted)
    assert {v for *_, v in wanted} == {"", "[TERM]", "[NUMBER]"}


def test_copies_hide_no_revealing_term(spark):
    """Exact copies of a text count once, in the term's frequency and in the corpus too."""
    rng = random.Random(5)
    some = lambda n: " ".join(rng.choices([f"common{i}" for i in range(30)], k=n))
    rows = [(i, f"{some(9)} Zaphod wrote from z.b@galaxy.example.com {some(9)}", "en") for i in range(4)]
    rows += [(10 + i, f"{some(40)} wrote from {some(20)}", "en") for i in range(60)]
    plain = pii.find_personal_data(brute.frame(spark, rows)).select("row.doc_id", "terms").where("doc_id < 10").collect()
    copied = pii.find_personal_data(brute.frame(spark, rows + [(1000 + i, rows[0][1], "en") for i in range(3000)]))
    assert all(r.terms for r in plain)
    assert brute.same(copied.select("row.doc_id", "terms").where("doc_id < 10").collect(), plain)


def test_revealing_terms_go_in_the_whole_text(spark):
    """Far from the entity too, and short names; entities themselves hold no term."""
    rng = random.Random(7)
    some = lambda n: " ".join(rng.choices([f"common{i}" for i in range(30)], k=n))
    rows = [(i, f"KIM {some(90)} Kim, 李明 wrote to kim@galaxy.example.com {some(9)} 𝒳 {some(90)} kim", "en") for i in range(5)]
    rows += [(10 + i, f"{some(40)} wrote to {some(20)}", "en") for i in range(300)]
    found = pii.find_personal_data(brute.frame(spark, rows)).select("row.doc_id", "terms").where("doc_id < 5").collect()
    for i, terms in found:
        text = rows[i][1]
        shown = [text[s.start:s.stop] for s in terms]
        assert [w for w in shown if w.lower() == "kim"] == ["KIM", "Kim", "kim"] and "李明" in shown
        assert not any(text.index("kim@") <= s.start < text.index(".com") for s in terms)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.mark.parametrize("part, size", [("th", 500_000), ("ing", 500_000), ("aab", 500_000), ("é", 200_000), ("thein", 60_000)])
def test_a_very_long_word_is_encoded_in_time(library, part, size):
    """Repeats, and with the last part random letters: time grows with the length, not its square."""
    rng = random.Random(1)
    word = "".join(rng.choices("abcdefghinorst", k=size)) if part == "thein" else part * (size // len(part))
    with open(PIECES, "rb") as file:
        encoder = pieces.Encoder(pieces.Model(file.read()))
    started = time.process_time()
    ids, _ = encoder.encode([word])
    assert time.process_time() - started < 20
    assert ids.tolist() == library.encode(word)


def test_texts_of_few_letters_equal_the_library(library):
    """Overlaps, repeats and pairs whose merge makes a better pair, thousands of short texts in one batch and alone."""
    rng = random.Random(4)
    letters = ["thein", "aab", "theringo ", "aeiou lnst", "▁a b", "éèa ", "0123 .", "_-= "]
    texts = ["".join(rng.choices(rng.choice(letters), k=rng.randint(1, 60))) for _ in range(4000)]
    with open(PIECES, "rb") as file:
        model = pieces.Model(file.read())
    ids, sizes = pieces.Encoder(model).encode(texts)
    wanted = [library.encode(t) for t in texts]
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == wanted
    assert all(pieces.Encoder(model).encode([t])[0].tolist() == w for t, w in zip(texts[:300], wanted))


def test_encoding_equals_the_library(library):
    with open(PIECES, "rb") as file:
        table = pieces.Model(file.read())
    texts = _random_texts(3000)
    encoder = pieces.Encoder(table, cached_words=500)
    for at in range(0, len(texts), 400):
        some = texts[at:at + 400]
        ids, sizes = encoder.encode(some)
        got = np.split(ids, np.cumsum(sizes)[:-1])
        assert [g.tolist() for g in got] == library.encode(some)
    rng = random.Random(1)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(1, 32000)]) for _ in range(rng.randint(0, 10))]
        assert table.decode(np.array(ids, np.uint32)) == library.decode(ids), ids


def test_encoding_of_odd_rows(spark, library):
    rows = brute.odd_rows()
    coded = pieces.encode_and_decode(brute.frame(spark, rows), PIECES)
    wanted = [library.encode(t or "", add_bos=True, add_eos=True) for _, t, _ in rows]
    assert brute.same(coded.select("row.doc_id", "ids", "decoded").collect(),
                      [(i, ids, library.decode(ids)) for (i, _, _), ids in zip(rows, wanted, strict=True)])
    assert pieces.encode_and_decode(brute.frame(spark, []), PIECES).count() == 0


def test_token_counts_equal_the_library(spark, monkeypatch):
    tokenizer = Tokenizer.from_file(WORDS)
    rows = brute.odd_rows() + [(500 + i, t, "en") for i, t in enumerate(_random_texts(1500))]
    wanted = [(i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows]
    docs = brute.frame(spark, rows)
    for frequent in (token_counts.FREQUENT, 10, 0):
        counted = token_counts.count_tokens(docs, WORDS, frequent=frequent)
        assert brute.same(counted.select("row.doc_id", "n_bytes", "n_tokens").collect(), wanted)
    assert token_counts.count_tokens(brute.frame(spark, []), WORDS).count() == 0


def test_frequent_pre_tokens_with_a_small_store(spark):
    docs = spark.createDataFrame([("often " * 50 + " ".join(f"r{i}x{j}" for j in range(40)),) for i in range(20)], "text string")
    texts = docs.select(F.col("text").cast("binary").alias("text"))
    assert token_counts.frequent_words(texts, frequent=3, sent=5, counted=30)[0] == "often"


def test_tokenizers_that_keep_white_space_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file, pytest.raises(ValueError):
        token_counts.checked(file.read())


def test_white_space_classes_agree():
    every = "".join(map(chr, [*range(0x3100), 0xFEFF]))
    cut = {c for c in every if not token_counts.pre_tokens(c)}
    tokenizer = Tokenizer.from_file(WORDS)
    assert cut == {c for c in every if re.match(r"\s", c) and not tokenizer.encode(c, add_special_tokens=False).ids}
