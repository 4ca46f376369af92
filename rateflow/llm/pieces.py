"""SentencePiece BPE encoding and decoding, as rounds of merges over flat numpy arrays of symbols.

The model file gives pieces and scores; the library reads it, but does not encode. A text gets a leading space, spaces
become U+2581, and its characters are symbols. Merges never cross from another character to U+2581, as no piece holds that
sequence (checked when a model is loaded), so a text is cut there into words. Equal words have equal ids: a batch encodes
its new words together, and a worker keeps a bounded number of encoded words.

In a round every word finds its best pair, by the score of the joined piece (a segmented minimum of ranks), and merges
it. Merging is what the library's queue does: best score first, leftmost first. All leftmost non-overlapping places of the
best pair are merged at once, up to the first where the new piece and its neighbour join to a piece of as good a score, which
the queue would take next. Words without a pair leave the arrays, and the arrays are compacted after every round.

A character without a piece is encoded as the bytes of its UTF-8 form. Decoding joins the pieces, turns U+2581 into
spaces, drops the leading space, and reads byte pieces as UTF-8 with U+FFFD for each invalid byte.

Nulls and odd rows: a null text is an empty one, and has only the begin and end ids. Repeated rows are rows of their own.
Extra columns are carried in a struct.
"""

import uuid

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F

from rateflow.llm.common import by_piece, row_and_text, worker_store

SPACE = "▁"
#: Words that a worker keeps encoded; beyond that it starts anew.
CACHED_WORDS = 200_000
#: Words that are merged together; more would need more memory, not less time.
MERGED_WORDS = 10_000
_NONE = np.iinfo(np.int64).max


class Model:
    """Tables of a SentencePiece BPE model with byte fallback and without a normalisation of its own."""

    def __init__(self, proto):
        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = sp.vocab_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or sp.is_unused(i))]
        if any(SPACE in pieces[i].lstrip(SPACE) for i in plain):
            raise ValueError("a piece holds a space after another character")
        if sp.encode("  aÅ\t ", out_type=str)[0][:1] != SPACE or sp.decode(sp.encode("  ａ ")) != "  ａ ":
            raise ValueError("the model normalises its input")
        self.begin, self.end, self.size = sp.bos_id(), sp.eos_id(), n
        self.byte_ids = np.zeros(256, np.uint32)
        text = [b""] * n
        for i in range(n):
            if sp.is_byte(i):
                value = int(pieces[i][3:-1], 16)
                self.byte_ids[value], text[i] = i, bytes([value])
            elif not sp.is_control(i):
                text[i] = pieces[i].replace(SPACE, " ").encode()
        self.is_byte = np.array([sp.is_byte(i) for i in range(n)])
        self.bytes_of = text
        by_text = {pieces[i]: i for i in plain}
        self.single = {p: i for p, i in by_text.items() if len(p) == 1}
        order = sorted(plain, key=lambda i: -sp.get_score(i))
        rank = np.full(n, _NONE >> 20, np.int64)
        last, place = None, -1
        for i in order:
            place += sp.get_score(i) != last
            last = sp.get_score(i)
            rank[i] = place
        keys, merged = [], []
        inner = np.full(n, _NONE, np.int64)
        for i in plain:
            p = pieces[i]
            for cut in range(1, len(p)):
                left, right = by_text.get(p[:cut]), by_text.get(p[cut:])
                for part in (left, right):
                    if part is not None:
                        inner[part] = min(inner[part], rank[i])
                if left is not None and right is not None:
                    keys.append(left * n + right)
                    merged.append(i)
        self.safe = inner > rank
        self.rank = rank
        self._hash(np.array(keys, np.int64), np.array(merged, np.int64))

    def _hash(self, keys, merged):
        """Open addressing: each pair is at its slot or at one of the next `self.reach`."""
        bits = int(np.ceil(np.log2(len(keys) * 4)))
        self.shift = np.uint64(64 - bits)
        self.slot_key = np.full((1 << bits) + 64, -1, np.int64)
        self.slot_value = np.zeros(len(self.slot_key), np.int64)
        self.reach = 1
        for key, value, slot in zip(keys.tolist(), merged.tolist(), self._slot(keys).tolist(), strict=True):
            step = 0
            while self.slot_key[slot + step] >= 0:
                step += 1
            self.slot_key[slot + step], self.slot_value[slot + step] = key, value
            self.reach = max(self.reach, step + 1)

    def _slot(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pairs(self, left, right):
        """The piece that each pair of symbols joins to, or -1. Symbols beyond the vocabulary join to nothing."""
        keys = np.where((left < self.size) & (right < self.size), left * self.size + right, -2)
        slot = self._slot(keys)
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for step in range(self.reach):
            have = self.slot_key[slot[open_] + step]
            same = have == keys[open_]
            out[open_[same]] = self.slot_value[slot[open_[same]] + step]
            open_ = open_[~same & (have >= 0)]
            if not len(open_):
                break
        return out

    def symbols(self, words):
        """Flat symbols of all words: piece ids of characters, or size + code point where there is none."""
        text = "".join(words)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        known, inverse = np.unique(points, return_inverse=True)
        table = np.array([self.single.get(chr(c), self.size + c) for c in known.tolist()], np.int64)
        return table[inverse] if len(points) else points

    def merge(self, words):
        """Ids of each word, as one flat array and the number of ids of each word."""
        n_words = len(words)
        symbol = self.symbols(words)
        word = np.repeat(np.arange(n_words), np.fromiter(map(len, words), np.int64, n_words))
        done_word, done_symbol = [], []
        joined = self._joined(symbol, word)
        while len(symbol):
            rank = np.where(joined >= 0, self.rank[joined], _NONE)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(word)))
            over = best == _NONE
            if over.any():
                gone = np.repeat(over, sizes)
                done_word.append(word[gone])
                done_symbol.append(symbol[gone])
                symbol, word, joined, rank = symbol[~gone], word[~gone], joined[~gone], rank[~gone]
                if not len(symbol):
                    break
                best, sizes = best[~over], sizes[~over]
            at = np.flatnonzero(rank == np.repeat(best, sizes))
            at = self._chosen(at, symbol, word, joined)
            symbol[at] = joined[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            place = at - np.arange(len(at))  # once the second symbols are gone
            symbol, word, joined = symbol[keep], word[keep], joined[keep]
            again = np.union1d(place, place[place > 0] - 1)
            joined[again] = self._joined_at(symbol, word, again)
        if not done_word:
            return np.zeros(0, np.uint32), np.zeros(n_words, np.int64)
        word, symbol = np.concatenate(done_word), np.concatenate(done_symbol)
        order = np.argsort(word, kind="stable")
        return self._with_bytes(word[order], symbol[order], n_words)

    def _joined_at(self, symbol, word, at):
        right = np.minimum(at + 1, len(symbol) - 1)
        out = self.pairs(symbol[at], symbol[right])
        out[(word[at] != word[right]) | (right == at)] = -1
        return out

    def _joined(self, symbol, word):
        return self._joined_at(symbol, word, np.arange(len(symbol)))

    def _chosen(self, at, symbol, word, joined):
        """Of the places of the best pairs: in each word those up to the first whose merge gives a pair that is as good."""
        start = (np.diff(word[at], prepend=-1) != 0) | (np.diff(at, prepend=-2) != 1)
        # an overlap is a row of neighbouring places, of which every second is merged, from the left
        nth = np.arange(len(at)) - np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))
        at = at[nth % 2 == 0]
        piece, owner = joined[at], word[at]
        check = np.flatnonzero(~self.safe[piece])
        if len(check):
            p, own, new = at[check], owner[check], piece[check]
            # the places before are merged already, those behind are not
            last = np.maximum(check - 1, 0)
            left, right = np.maximum(p - 1, 0), np.minimum(p + 2, len(symbol) - 1)
            before = np.where((check > 0) & (at[last] == p - 2), piece[last], symbol[left])
            risky = np.zeros(len(at), np.int64)
            for a, b, beside in ((before, new, (p > 0) & (word[left] == own)), (new, symbol[right], (right == p + 2) & (word[right] == own))):
                made = self.pairs(a, b)
                risky[check] |= beside & (made >= 0) & (self.rank[made] <= self.rank[new])
            seen = np.cumsum(risky) - risky
            first = np.flatnonzero(np.diff(owner, prepend=-1) != 0)
            at = at[seen == np.repeat(seen[first], np.diff(np.append(first, len(at))))]
        return at

    def _with_bytes(self, word, symbol, n_words):
        odd = np.flatnonzero(symbol >= self.size)
        if len(odd):
            raw = [chr(c).encode("utf-8", "surrogatepass") for c in (symbol[odd] - self.size).tolist()]
            times = np.ones(len(symbol), np.int64)
            times[odd] = [len(r) for r in raw]
            symbol, word = np.repeat(symbol, times), np.repeat(word, times)
            symbol[symbol >= self.size] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return symbol.astype(np.uint32), np.bincount(word, minlength=n_words)

    def decode(self, ids):
        """Text of an array of ids."""
        if not len(ids):
            return ""
        data = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        shown = ids[(ids != self.begin) & (ids != self.end)]
        if len(shown) and not self.is_byte[shown[0]] and data[:1] == b" ":
            data = data[1:]
        if not self.is_byte[ids].any():
            return data.decode()
        return _decoded(data)


def _decoded(data):
    """UTF-8 with one U+FFFD for each invalid byte."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(data):
            for size in (1, 2, 3, 4):
                try:
                    out.append(data[at:at + size].decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


class Encoder:
    """Encodes texts with a bounded store of encoded words: numbers of words, and their ids in one flat array."""

    def __init__(self, table, cached_words=CACHED_WORDS):
        self.model, self.limit = table, cached_words
        self._clear()

    def _clear(self):
        self.number, self.flat, self.start, self.count = {}, np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, words):
        for at in range(0, len(words), MERGED_WORDS):
            self._add(words[at:at + MERGED_WORDS])

    def _add(self, words):
        ids, count = self.model.merge(words)
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words)), strict=True))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.flat = np.concatenate([self.flat, ids])

    def encode(self, texts):
        """Flat ids of all texts without begin and end, and the number of each text's ids."""
        split = [_words(t) for t in texts]
        new = set().union(*split).difference(self.number) if split else set()
        if new:
            if len(self.number) + len(new) > self.limit:
                self._clear()
                new = set().union(*split)
            self._learn(sorted(new))
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        get = self.number.__getitem__
        numbers = np.fromiter((n for words in split for n in map(get, words)), np.int64, int(sizes.sum()))
        count = self.count[numbers]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.start[numbers] - ends + count, count) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
        return ids, np.diff(bounds)


def _words(text):
    """Words of a text: each begins with the spaces before it. A leading space is added to a text that is not empty."""
    if not text:
        return []
    parts = text.replace(SPACE, " ").split(" ")
    if "" not in parts:
        return [SPACE + p for p in parts]
    out, spaces = [], 0
    for p in parts:
        spaces += 1
        if p:
            out.append(SPACE * spaces + p)
            spaces = 0
    if spaces:
        out.append(SPACE * spaces)
    return out


def encode_and_decode(docs, model_path, text_col="text"):
    """row (all columns of docs), ids (with begin and end), decoded. The model file is read on the driver and broadcast."""
    with open(model_path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    key = uuid.uuid4().hex

    def run(piece):
        own = worker_store(key, lambda: Encoder(Model(shared.value)))
        table = own.model
        ids, sizes = own.encode(piece.column("text").cast(pa.string()).to_pylist())
        framed = [
            np.concatenate([[table.begin], x, [table.end]]).astype(np.uint32) for x in np.split(ids, np.cumsum(sizes)[:-1])]
        offsets = np.concatenate([[0], np.cumsum(sizes + 2)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(framed).astype(np.int32)))
        return {"row": piece.column("row"), "ids": lists, "decoded": pa.array(map(table.decode, framed), pa.string())}

    rows = row_and_text(docs, text_col)
    schema = rows.select("row", F.array().cast("array<int>").alias("ids"), F.lit("").alias("decoded")).schema
    return rows.mapInArrow(by_piece(run, key=key), schema)
