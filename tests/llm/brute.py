"""Plain versions of the operators for small inputs, and the odd rows that every operator must stand."""

import hashlib
import random
import re

import xxhash

#: Names that the operators use inside; a table that has them as columns must not disturb anything.
CLASHING = ["row", "key", "n", "words", "hits", "items", "kept_text", "suspects", "lost", "fingerprint", "component", "place",
            "score", "lang_pred", "ids", "decoded", "base", "terms", "digest", "route", "a", "b", "start", "token_ids"]


def odd_rows():
    """(doc_id, text, lang): nulls in each column, empty and very long texts, ties, repeated rows, odd characters."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnoprstuvé", k=rng.randint(2, 9))) for _ in range(400)]
    long = " ".join(rng.choices(words, k=30_000)) + " " + "x" * 20_000
    passage = " ".join(rng.choices(words, k=70))
    shared = "A line that several documents share, word for word"
    edited = passage.split()
    edited[35] = "changed"
    rows = [
        (1, None, "en"), (2, "", "en"), (3, "   \t ", None), (4, "\n\n", "de"), (5, "word", "en"), (6, long, "en"),
        (7, f"{shared}\nshort\nalone in this one document", "en"), (8, f"  {shared.upper()} \nshort\n{shared}", "de"),
        (8, f"  {shared.upper()} \nshort\n{shared}", "de"), (None, f"{shared}\nmore\r", None), (None, None, None),
        (9, f"{passage} tail one", "fr"), (10, f"head two {passage}", "fr"), (11, "head " + " ".join(edited) + " end", "es"),
        (12, f"{passage} tail one", "fr"), (13, "日本語 текст 𝒳 ½ \x1c a\x00b <|endoftext|> ▁▁ <s>", "en"),
        (14, "mail a.b%c@x-y.example.com or 10.0.0.255, 256.1.1.1; 4111 1111 1111 1111 +1 (555) 555-0100", None),
        (15, "12345 67890", "en"), (16, "word", "en"), (17, f"{shared}", "en")]
    return rows + [(20 + i, " ".join(rng.choices(words, k=rng.randint(1, 60))), "en" if i % 2 else "de") for i in range(30)]


def frame(spark, rows, clashing=True):
    """documents of rows, with columns whose names clash with those inside the operators."""
    extra = CLASHING if clashing else []
    data = [(i, t, g, "src", len(t) if t is not None else None, *["x"] * len(extra)) for i, t, g in rows]
    kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return spark.createDataFrame(data, ", ".join([kinds, *[f"`{c}` string" for c in extra]])).repartition(4)


def words_of(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def same(rows, wanted):
    """Equal as bags."""
    return sorted(map(repr, map(tuple, rows))) == sorted(map(repr, map(tuple, wanted)))


class Groups:
    """Disjoint sets; the name of one is its smallest member."""

    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)


def line_key(line):
    key = re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    return key if len(key) >= 10 else None


def kept_lines(rows):
    """(doc_id, n_lines, n_dropped, kept text) of rows (doc_id, text); a null id is one document after all others."""
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if line_key(line) is not None:
                holders.setdefault(line_key(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        left = []
        for line in lines:
            ids = holders.get(line_key(line), {i})
            if len(ids) < 2 or i == min(x for x in ids if x is not None):
                left.append(line)
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def simhash(text, width=3):
    words = words_of(text)
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def simhash_groups(rows):
    """(doc_id, fingerprint, component_id) of rows (doc_id, text)."""
    marks = [simhash(t) for _, t in rows]
    groups = Groups(range(len(rows)))
    for x in range(len(rows)):
        for y in range(x):
            if (marks[x] ^ marks[y]).bit_count() <= 3:
                groups.join(x, y)
    least = {}
    for x, (i, _) in enumerate(rows):
        g = groups.find(x)
        least[g] = min((j for j in (i, least.get(g)) if j is not None), default=None)
    return [(i, f"{marks[x]:016x}", least[groups.find(x)]) for x, (i, _) in enumerate(rows)]


BENCHMARK_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def contamination(rows, items, width=13):
    """(doc_id, n_words, n_hit, item names) of rows (doc_id, text) against items (item_id, text)."""
    low = lambda t: BENCHMARK_WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for item, text in items:
        words = low(text)
        k = min(width, len(words))
        for i in range(len(words) - k + 1 if words else 0):
            windows.setdefault(tuple(words[i:i + k]), set()).add("" if item is None else str(item))
    out = []
    for i, text in rows:
        words, hit, found = low(text), set(), set()
        for k in {len(w) for w in windows}:
            for at in range(len(words) - k + 1):
                names = windows.get(tuple(words[at:at + k]))
                if names:
                    hit.update(range(at, at + k))
                    found |= names
        out.append((i, len(words), len(hit), sorted(found)))
    return out


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def personal(text):
    """Valid matches as kind:start:end, in order."""
    out = []
    for kind, pattern in PII:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))) % 10
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn == 0):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out
