"""Language identification of words in code-switched text by a linear-chain conditional random field.

A chain is a line, its items are the words (cut at white space) that hold a letter. Features of a word are its hashed
character n-grams, framed by begin and end marks so that those at its ends are its affixes, and its entry in a lexicon of
the words found in at least `LEXICON_ROWS` learned texts. Feature weights, transition and start weights are learned
together by the gradient of the chain's log-likelihood (forward-backward, Adagrad). As labelled texts have one language
each, training chains are put together from pieces of several texts, so that switches are learned too.

Learning takes at most `max_rows` labelled rows of each language with at most `max_chars` characters, and at most
`max_words` words of all of these, shared equally by the languages. Every other text is labelled whole: forward-backward gives each word a probability of
each language; a text's language is the one with the largest sum, its score that sum's share.

Workers compute the feature sums of new words in batches, keep a bounded number of them, and run all lines of a batch
side by side, one position at a time.

Nulls and odd rows: a null text, and a text without a letter, is `und` with score 0, as is every text if nothing was
learned. Rows with a null id, text or language are not learned from. Of equal sums the first language in order counts.
Extra columns are carried in a struct.
"""

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rateflow.llm.common import by_piece, column, first_of_labels, row_and_text, worker_store
from rateflow.llm.ngrams import hashed

MAX_ROWS = 300
MAX_CHARS = 50_000
MAX_WORDS = 120_000
LEXICON_ROWS = 3
BUCKETS = 1 << 16
SIZES = (1, 2, 3, 4)
EPOCHS = 3
RATE = 0.2
#: Mean number of words between switches in a training chain, words of a training chain, chains of a training batch.
RUN, CHAIN, BATCH = 12, 40, 64
CACHED_WORDS = 200_000
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_STRIP = "".join(map(chr, range(0x21, 0x41))) + "[\\]^_`{|}~"


def words_of(line):
    return [w for w in line.lower().split() if _has_letter(w)]


def _has_letter(word):
    return word.isalpha() or any(map(str.isalpha, word))


def forward_backward(emission, transition, start, sizes):
    """Probability of each label for each item of chains that lie one after the other; all weights are logarithms.

    Chains must not be empty. Also gives the expected number of transitions, and of starts, over all chains.
    """
    n_labels = emission.shape[1]
    order = np.argsort(-sizes, kind="stable")
    first = (np.cumsum(sizes) - sizes)[order]
    active = np.searchsorted(-sizes[order], -np.arange(sizes.max()), "left")  # chains longer than t
    step = np.exp(transition)
    local = np.exp(emission - emission.max(1, keepdims=True))
    forward, scale = np.empty_like(local), np.empty(len(local), local.dtype)
    now = local[first] * np.exp(start - start.max())
    for t, k in enumerate(active.tolist()):
        at = first[:k] + t
        if t:
            now = (now[:k] @ step) * local[at]
        total = now.sum(1)
        now = now / total[:, None]
        forward[at], scale[at] = now, total
    backward = np.ones_like(local)
    for t in range(len(active) - 2, -1, -1):
        at = first[:active[t + 1]] + t
        backward[at] = ((backward[at + 1] * local[at + 1] / scale[at + 1, None]) @ step.T)
    marginal = forward * backward
    marginal /= marginal.sum(1, keepdims=True)
    inner = np.ones(len(local), bool)
    inner[first] = False
    to = np.flatnonzero(inner)
    moves = np.einsum("ni,nj->ij", forward[to - 1], local[to] * backward[to] / scale[to, None]) * step
    return marginal, moves, marginal[first].sum(0).reshape(n_labels)


class Model:
    """Weights of features, transitions and starts for the languages found in the learned rows."""

    def __init__(self, rows, seed=7, max_words=MAX_WORDS):
        rows = [(text, lang) for text, lang in rows if _LETTER.search(text)]
        self.languages = sorted({lang for _, lang in rows})
        n = len(self.languages)
        self.weights = np.zeros((BUCKETS + 1, n), np.float32)
        self.transition = np.zeros((n, n), np.float32)
        self.start = np.zeros(n, np.float32)
        self.lexicon = np.zeros(0, np.uint64)
        if n > 1:
            self._fit(rows, np.random.default_rng(seed), max_words)

    def _fit(self, rows, rng, max_words):
        pieces, seen = [], {}
        for text, lang in rows:
            words = [w for line in text.split("\n") for w in words_of(line)]
            for w in set(words):
                seen[w] = seen.get(w, 0) + 1
            at = 0
            while at < len(words):
                size = 1 + int(rng.geometric(1 / RUN))
                pieces.append((self.languages.index(lang), words[at:at + size]))
                at += size
        pieces = [pieces[i] for i in rng.permutation(len(pieces))]
        pieces = self._shared(pieces, max_words)
        vocabulary = {w: i for i, w in enumerate(sorted({w for _, p in pieces for w in p}))}
        common = [w for w in vocabulary if seen[w] >= LEXICON_ROWS]
        self.lexicon = np.unique(hashed(common, (1,), BUCKETS)[2])
        self.weights = np.zeros((BUCKETS + 1 + len(self.lexicon), len(self.languages)), np.float32)
        word, feature, value = self._features(list(vocabulary))
        first = np.searchsorted(word, np.arange(len(vocabulary) + 1))
        number = np.array([vocabulary[w] for _, p in pieces for w in p])
        label = np.array([i for i, p in pieces for _ in p])
        state = [np.full_like(p, 1e-3) for p in (self.weights, self.transition, self.start)]
        chains = [slice(a, a + CHAIN) for a in range(0, len(number), CHAIN)]
        for _ in range(EPOCHS):
            mixed = rng.permutation(len(chains))
            for at in range(0, len(mixed), BATCH):
                part = [chains[i] for i in mixed[at:at + BATCH]]
                own = np.concatenate([number[c] for c in part])
                target = np.eye(len(self.languages), dtype=np.float32)[np.concatenate([label[c] for c in part])]
                sizes = np.array([len(number[c]) for c in part])
                used, inverse = np.unique(own, return_inverse=True)
                size = first[used + 1] - first[used]
                take = np.repeat(first[used] - np.cumsum(size) + size, size) + np.arange(size.sum())
                rows_of = np.repeat(np.arange(len(used)), size)
                begin = np.cumsum(size) - size
                sums = np.add.reduceat(self.weights[feature[take]] * value[take, None], begin)
                marginal, moves, starts = forward_backward(sums[inverse], self.transition, self.start, sizes)
                gap = target - marginal
                by_word = np.stack([np.bincount(inverse, gap[:, i], len(used)) for i in range(gap.shape[1])], 1)
                of_feature, inv = np.unique(feature[take], return_inverse=True)
                pull = by_word[rows_of] * value[take, None]
                slope = np.stack([np.bincount(inv, pull[:, i], len(of_feature)) for i in range(gap.shape[1])], 1)
                heads = np.cumsum(sizes) - sizes
                tails = np.setdiff1d(np.arange(len(own)), heads)
                self._step(state[0], self.weights, slope.astype(np.float32), of_feature)
                self._step(state[1], self.transition, (target[tails - 1].T @ target[tails] - moves) / 10)
                self._step(state[2], self.start, (target[heads].sum(0) - starts) / 10)

    def _shared(self, pieces, max_words):
        """The first pieces of each language up to an equal share of max_words; what a language leaves goes to the others."""
        label = np.array([i for i, _ in pieces])
        size = np.array([len(p) for _, p in pieces])
        totals = np.bincount(label, size, len(self.languages)).astype(np.int64)
        kept, left = np.zeros(len(pieces), bool), max_words
        for n, i in enumerate(np.argsort(totals, kind="stable").tolist()):
            share = left // (len(totals) - n)
            own = np.flatnonzero(label == i)
            own = own[:np.searchsorted(np.cumsum(size[own]), share) + 1]
            kept[own] = True
            left = max(left - int(size[own].sum()), 0)
        return [pieces[i] for i in np.flatnonzero(kept)]

    @staticmethod
    def _step(state, weights, slope, rows=slice(None)):
        state[rows] += slope * slope
        weights[rows] += RATE * slope / np.sqrt(state[rows])

    def _features(self, words):
        """(number of the word, feature, value), sorted by word; the n-grams of a word have the mean as their value."""
        bare = [w.strip(_STRIP) or w for w in words]
        word, bucket, whole = hashed(bare, SIZES, BUCKETS)
        value = (3 / np.sqrt(np.bincount(word, minlength=len(words))))[word]
        place = np.searchsorted(self.lexicon, whole)
        place = np.where(np.append(self.lexicon, 0)[place] == whole, place + 1, 0) if len(self.lexicon) else place * 0
        word = np.concatenate([word, np.arange(len(words))])
        feature = np.concatenate([bucket, BUCKETS + place])
        value = np.concatenate([value, np.full(len(words), 1.0)]).astype(np.float32)
        order = np.argsort(word, kind="stable")
        return word[order], feature[order], value[order]

    def emissions(self, words):
        """Sum of the feature weights of each word."""
        out = np.zeros((len(words), len(self.languages)), np.float32)
        for at in range(0, len(words), 10_000):
            some = words[at:at + 10_000]
            word, feature, value = self._features(some)
            begin = np.searchsorted(word, np.arange(len(some)))
            out[at:at + len(some)] = np.add.reduceat(self.weights[feature] * value[:, None], begin)
        return out


class Labeller:
    """Labels the words of texts, with a bounded store of word emissions."""

    def __init__(self, model):
        self.model = model
        self._clear()

    def _clear(self):
        self.number, self.table = {}, np.zeros((0, len(self.model.languages)), np.float32)

    def words(self, texts):
        """For each text the number of its words; for all words in turn the probability of each language."""
        lines = [[ws for line in t.split("\n") if (ws := line.lower().split())] for t in texts]
        every = set().union(*(ws for ls in lines for ws in ls))
        new = every.difference(self.number)
        if len(self.number) + len(new) > CACHED_WORDS:
            self._clear()
            new = every
        real = [w for w in new if _has_letter(w)]
        if new:
            self.table = np.concatenate([self.table, self.model.emissions(real)])
            self.number.update(dict.fromkeys(new, -1))
            self.number.update(zip(real, range(len(self.table) - len(real), len(self.table)), strict=True))
        get = self.number.__getitem__
        flat = [list(map(get, ws)) for ls in lines for ws in ls]
        numbers = np.array([i for f in flat for i in f], np.int64)
        sizes = np.array([len(f) for f in flat], np.int64)
        line = np.repeat(np.arange(len(flat)), sizes)
        text = np.repeat(np.repeat(np.arange(len(texts)), [len(ls) for ls in lines]), sizes)
        kept = numbers >= 0
        numbers, line, text = numbers[kept], line[kept], text[kept]
        count = np.bincount(text, minlength=len(texts))
        if not len(numbers):
            return count, np.zeros((0, len(self.model.languages)), np.float32)
        sizes = np.bincount(line)
        return count, forward_backward(self.table[numbers], self.model.transition, self.model.start, sizes[sizes > 0])[0]

    def label(self, texts):
        """Language and score of each text."""
        if not self.model.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        count, chance = self.words(texts)
        sums = np.zeros((len(texts), len(self.model.languages)))
        if len(chance):
            begin = (np.cumsum(count) - count)[count > 0]
            sums[count > 0] = np.add.reduceat(chance.astype(np.float64), begin)
        best = sums.argmax(1)
        score = sums[np.arange(len(texts)), best] / np.maximum(count, 1)
        return [self.model.languages[b] if n else UNKNOWN for b, n in zip(best, count, strict=True)], np.clip(score, 0, 1)


def train(docs, learn, id_col="doc_id", text_col="text", lang_col="lang", max_rows=MAX_ROWS, max_chars=MAX_CHARS,
          max_words=MAX_WORDS):
    """A model from labelled rows. `learn` is a condition on the columns of docs.

    Of each language the max_rows ids of the smallest hash are taken, of a repeated id the smallest text.
    """
    rows = docs.where(learn).select(column(id_col).alias("id"), column(lang_col).alias("lang"), column(text_col).alias("text"))
    rows = rows.where(F.expr("id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL") & (F.length("text") <= max_chars))
    ids = first_of_labels(rows.select("id", "lang").distinct(), "lang", max_rows)
    # One text an id, so that a repeated id does not bring more rows to the driver than there are ids.
    learned = rows.join(F.broadcast(ids), ["id", "lang"]).groupBy("id", "lang").agg(F.min("text").alias("text")).select("lang", "text").collect()
    return Model(sorted({(r[1], r[0]) for r in learned}), max_words=max_words)


def label_documents(docs, model, text_col="text"):
    """row (all columns of docs), lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    def run(piece):
        names, score = worker_store(key, lambda: Labeller(shared.value)).label(piece.column("text").cast(pa.string()).to_pylist())
        return {"row": piece.column("row"), "lang_pred": pa.array(names, pa.string()), "score": pa.array(score, pa.float64())}

    rows = row_and_text(docs, text_col)
    schema = rows.select("row", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return rows.mapInArrow(by_piece(run, key=key), schema)


def label_words(docs, model, text_col="text"):
    """row, words: for each word that holds a letter its lower-cased form, language and probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    def run(piece):
        own = worker_store(key, lambda: Labeller(shared.value))
        texts = piece.column("text").cast(pa.string()).to_pylist()
        count, chance = own.words(texts) if own.model.languages else (np.zeros(len(texts), int), np.zeros((0, 1)))
        ends = np.cumsum(count).tolist()
        out = []
        for t, end, n in zip(texts, ends, count.tolist(), strict=True):
            words = [w for line in t.split("\n") for w in words_of(line)] if n else []
            best = chance[end - n:end].argmax(1) if n else []
            out.append([{"word": w, "lang": own.model.languages[b], "p": float(chance[end - n + i, b])}
                        for i, (w, b) in enumerate(zip(words, best, strict=True))])
        kind = pa.list_(pa.struct([("word", pa.string()), ("lang", pa.string()), ("p", pa.float64())]))
        return {"row": piece.column("row"), "words": pa.array(out, kind)}

    rows = row_and_text(docs, text_col)
    schema = rows.select("row", F.array().cast("array<struct<word:string,lang:string,p:double>>").alias("words")).schema
    return rows.mapInArrow(by_piece(run, key=key), schema)
