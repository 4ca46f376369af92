"""Near-duplicate passages by compact windows: Cartesian trees over min-hashes, interval joins, verified Jaccard.

A text's words are cut at ASCII white space, A-Z lower-cased; its tokens are the hashes of `WIDTH` = 5 consecutive words. For
a hash function, all token sequences of at least some length with the same smallest token form a compact window (l, c, r):
the smallest is at c, a sequence starts from l to c and ends from c to r. These are the upper nodes of the Cartesian tree
over the hashed tokens: the smallest places of all shortest sequences, and for each the next smaller ones on both sides.

Two texts are linked if they share a passage: a chain of common runs of at least MIN_WORDS words in both texts with a
Jaccard similarity of tokens of 0.8 or more. A place where the texts differ costs 2 x WIDTH - 1 tokens, so among the runs of
such a chain one has at least `least_run` = 21 tokens. Both texts have the same compact windows of such sequences, by
every function, so no pair is left to chance:

1. In each text the windows of `KEY_FUNCTIONS` functions are joined as intervals: two that hold a sequence of `least_run`
   tokens in common make a key of the tokens from one smallest place to the other. Linked texts share a key.
2. Two Bloom filters over all keys tell which a second document has too; only those go on.
3. The texts of a key are paired with the first one. Pairs are verified token by token around their keys: runs of common
   tokens, at all places where they occur, are chained along both texts; of chains that are not similar enough the longest
   parts count that are, and all runs of MIN_WORDS words count.
4. A key is done if its texts are of one component and a passage covers it in each. In the keys that are left, two texts
   are compared around the key if they are of two components, or no passage covers the key yet in one of them. Texts of
   large groups that have too few tokens there in common with all others go first, then pairs with too few. The
   comparisons run by blocks of texts; their number grows with the square of a group that has passages but none that
   covers the key, and memory does not.

So two texts that share a passage are in one component. The links and the edges of passages are those of the texts that
were compared, not of all pairs of a component; of the passages of two texts so many are kept that all their words are. The bound of `least_run` takes the tokens that two texts do not share
for distinct; a passage of lines that repeat within it but for a word (below 25 words a line, in another order in the other
text) can have shorter runs only and be missed.

The texts so linked are joined to components. Texts are told apart by a 64-bit hash; equal texts are one text, and are
linked as such if they have MIN_WORDS words.

Nulls and odd rows: a null or short text has no passage. Rows that repeat an id are reported once each; repeated rows
count as copies. A null id is not chosen as a component's name. Extra columns are not read.
"""

import math
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from rateflow.llm import bloom
from rateflow.llm.common import HOT_SHARE, id_and_text, lookup, pieces, row_and_text, stored
from rateflow.llm.components import components
from rateflow.llm.wordhash import mixed, spoken, window_hashes
from rateflow.session import pieces_for

WIDTH = 5
MIN_WORDS = 50
FUNCTIONS = 5
#: Words of the tokens that make keys, and functions whose windows are joined to a key; more make keys longer and more frequent.
KEY_WIDTH = 10
KEY_FUNCTIONS = 2
SIMILARITY = 0.8
BITS_PER_KEY = 8
MAX_BITS = 1 << 28
SEED = 23
#: Common tokens further apart than this are not of one passage; edits within a passage are closer.
GAP = 16
#: Texts of a group that one task compares with as many others.
MORE_LEADERS = 200
#: Texts that are verified against one text by the same task.
PARTNERS = 1000
#: Pairs of texts of a key that are compared without a look at the tokens that its texts share.
FEW_PAIRS = 32
#: Tokens on both sides of the keys of two texts that are verified with them, at least.
MARGIN = 150
#: Candidates, or rows of blocks, for one task.
CANDIDATES, BLOCK_ROWS = 2000, 1000
_REACH = (1 << 17) - 1


def _factors():
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 64, FUNCTIONS, np.uint64) | np.uint64(1)


def least_run(width, shortest, similarity=SIMILARITY):
    """Tokens of the longest common run of a passage, at least, if the passage's tokens are distinct.

    With g places of difference, which cost 2 x width - 1 tokens each, it has g + 1 runs.
    """
    two_runs = similarity / (1 + similarity) * 2 * shortest
    return min(shortest, *(
        math.ceil(round(max(two_runs, similarity / (1 - similarity) * (2 * width - 1) * g) / (g + 1), 9)) for g in range(1, 9)))


def tokens(texts, width=WIDTH):
    """Flat tokens of all texts, and the number of each text's tokens."""
    words, sizes = spoken(texts)
    rolled = mixed(window_hashes(words, width))
    count = np.maximum(sizes - width + 1, 0)
    starts = np.cumsum(sizes) - sizes
    return rolled[np.repeat(starts - np.cumsum(count) + count, count) + np.arange(count.sum())], count


def _tree(values):
    """For each value the place of the nearest smaller one on its left and right. The first and last are the smallest."""
    left, right = [0] * len(values), [0] * len(values)
    stack = []
    for i, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            right[stack.pop()] = i
        left[i] = stack[-1] if stack else 0
        stack.append(i)
    return np.array(left), np.array(right)


def compact_windows(values, sizes, shortest, functions=FUNCTIONS):
    """(text, function, key, l, c, r) of all compact windows; places count from the start of the text."""
    ends = np.cumsum(sizes)
    long = np.flatnonzero(sizes >= shortest)
    if not len(long):
        return tuple(np.zeros(0, np.int64) for _ in range(2)) + (np.zeros(0, np.uint64),) + tuple(
            np.zeros(0, np.int64) for _ in range(3))
    places = sizes[long] - shortest + 1
    first = np.repeat(ends[long] - sizes[long] - np.cumsum(places) + places, places) + np.arange(places.sum())
    owner = np.repeat(long, places)
    bits = np.uint64(max(24, len(values).bit_length()))
    number = np.arange(len(values), dtype=np.uint64)
    out = []
    for f, factor in enumerate(_factors()[:functions]):
        hashed = values * factor
        ranked = (hashed >> bits << bits) | number
        span, least = 1, ranked
        while span * 2 <= shortest:
            least, span = np.minimum(least[:-span], least[span:]), span * 2
        best = np.minimum(least[first], least[first + shortest - span])
        new = np.flatnonzero(np.diff(best, prepend=best[0] + np.uint64(1)) != 0)
        text, value = owner[new], best[new]
        c = (value & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        # a smallest value before each text keeps the trees of texts apart
        edge = np.flatnonzero(np.diff(text, prepend=-1))
        nodes = np.append(np.insert(value, edge, 0), np.uint64(0))
        at = np.arange(len(text)) + 1 + np.searchsorted(edge, np.arange(len(text)), "right") - 1
        where = np.full(len(nodes), -1)
        where[at] = c
        left, right = (where[x[at]] for x in _tree(nodes.tolist()))
        begin = ends[text] - sizes[text]
        out.append((text, np.full(len(text), f), mixed(hashed[c] + np.uint64(f + 1)), np.where(left < 0, 0, left + 1 - begin),
                    c - begin, np.where(right < 0, sizes[text], right - begin) - 1))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _packed(function, left, centre, right):
    """A window in one number; how far it reaches to each side is cut at 131,071 words, far beyond MIN_WORDS."""
    return (centre << 37) | (np.minimum(centre - left, _REACH) << 20) | (np.minimum(right - centre, _REACH) << 3) | function


def _unpacked(window):
    centre = window >> 37
    return window & 7, centre - (window >> 20 & _REACH), centre, centre + (window >> 3 & _REACH)


def _names(texts):
    return np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64).view(np.int64)


def _piece_keys(texts, width, run):
    """(text, key, start, stop) of all keys: places are words from the first smallest token to the end of the last."""
    values, sizes = tokens(texts, width)
    text, function, _, left, centre, right = compact_windows(values, sizes, run, KEY_FUNCTIONS)
    order = np.lexsort((centre, text))
    text, function, left, centre, right = (x[order] for x in (text, function, left, centre, right))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(values))])
    before = np.cumsum(sizes) - sizes
    stop = np.searchsorted((text << 36) + centre, (text << 36) + centre + run, "left")
    x, d, out = np.arange(len(text)), 1, [(np.zeros(0, np.int64),) * 4]
    while len(x := x[x + d < stop[x]]):
        y = x + d
        low, high = np.maximum(left[x], left[y]), np.minimum(right[x], right[y])
        both = (function[x] != function[y]) & (low <= centre[x]) & (high >= centre[y]) & (high - low + 1 >= run)
        u, v = x[both], y[both]
        at = before[text[u]]
        inner = sums[at + centre[v] + 1] - sums[at + centre[u]]
        key = mixed(mixed(inner) + (centre[v] - centre[u] << 3 | function[u]).astype(np.uint64))
        out.append((text[u], key.view(np.int64), centre[u], centre[v] + width))
        d += 1
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _fill(bits, width, run):
    """Filter segments of this task's keys."""
    def filled(batches):
        filters = bloom.Pair(bits)
        for piece in pieces(batches):
            text, key, _, _ = _piece_keys(piece.column("text").to_pylist(), width, run)
            order = np.lexsort((text, key))
            text, key = text[order], key[order]
            new = np.append(True, (key[1:] != key[:-1]) | (text[1:] != text[:-1]))[:len(key)]
            filters.add(key[new].view(np.uint64))
        yield from filters.batches()
    return filled


def _deal(shared, width, run):
    """Keys that may be in two texts, with their place."""
    def dealt(batches):
        seen = set()
        for piece in pieces(batches):
            texts = piece.column("text").to_pylist()
            names = _names(texts)
            new = [i for i, n in enumerate(names.tolist()) if n not in seen and not seen.add(n)]
            if not new:
                continue
            text, key, start, stop = _piece_keys([texts[i] for i in new], width, run)
            some = bloom.contains(shared.value, key.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[some]) for c in (key, names[new][text], start, stop)], names=["key", "text", "start", "stop"])
    return dealt


def _interval_join(shortest):
    """Rows come sorted by a and b: surroundings of windows that agree with one of another function."""
    def found(rows):
        rows = rows[:, np.lexsort((_unpacked(rows[3])[2], rows[1], rows[0]))]
        a, b, wa, wb = rows
        fa, la, ca, ra = _unpacked(wa)
        _, lb, cb, rb = _unpacked(wb)
        good = np.zeros(len(a), bool)
        # each window meets all whose centre in b lies between its own centre and its end
        group = np.cumsum((np.diff(a, prepend=a[:1]) != 0) | (np.diff(b, prepend=b[:1]) != 0)) << 36
        stop = np.searchsorted(group + cb, group + rb, "right")
        x, d = np.arange(len(a)), 1
        while len(x := x[x + d < stop[x]]):
            y = x + d
            both = fa[x] != fa[y]
            for left, centre, right in ((la, ca, ra), (lb, cb, rb)):
                low, high = np.maximum(left[x], left[y]), np.minimum(right[x], right[y])
                both &= (low <= np.minimum(centre[x], centre[y])) & (high >= np.maximum(centre[x], centre[y]))
                both &= high - low + 1 >= shortest
            good[x] |= both
            good[y] |= both
            d += 1
        a, b, lb, rb = a[good], b[good], lb[good], rb[good]
        if not len(a):
            return np.zeros((0, 4), np.int64)
        order = np.lexsort((lb, b, a))
        a, b, lb, rb = a[order], b[order], lb[order], rb[order]
        new = np.flatnonzero((np.diff(a, prepend=a[0] - 1) != 0) | (np.diff(b, prepend=b[0] - 1) != 0))
        return np.stack([a[new], b[new], lb[new], np.maximum.reduceat(rb, new)], 1)

    def run(batches):
        held = None
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy() for c in ("a", "b", "a_window", "b_window")])
            rows = rows if held is None else np.concatenate([held, rows], 1)
            if not rows.shape[1]:
                continue
            same = (rows[0] == rows[0, -1]) & (rows[1] == rows[1, -1])
            cut = rows.shape[1] - int(same[::-1].argmin()) if not same.all() else 0
            held = rows[:, cut:]
            yield _columns(found(rows[:, :cut]))
        if held is not None:
            yield _columns(found(held))
    return run


def _columns(rows):
    return pa.RecordBatch.from_arrays([pa.array(rows[:, i]) for i in range(4)], names=["a", "b", "start", "stop"])


def _tokens_of(asked, width):
    """Whole texts as 32-bit tokens, of those whose name the filter holds."""
    def run(batches):
        seen = set()
        for piece in pieces(batches):
            texts = piece.column("text").to_pylist()
            names = _names(texts)
            keep = np.flatnonzero(bloom.contains(asked.value, names.view(np.uint64)))
            keep = [i for i in keep.tolist() if names[i] not in seen and not seen.add(names[i])]
            if keep:
                values, sizes = tokens([texts[i] for i in keep], width)
                values = (values >> np.uint64(32)).astype(np.uint32).view(np.int32)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[keep]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["text", "tokens"])
    return run


def _lists(batch, name):
    """The arrays of a list column."""
    lists = batch.column(name)
    flat, offsets = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    offsets = (offsets - offsets[0]).tolist()
    return [flat[x:y] for x, y in zip(offsets, offsets[1:], strict=False)]


def _least_distinct(values, size):
    """The least number of distinct tokens among `size` in a row."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    same = np.flatnonzero(ranked[1:] == ranked[:-1])
    if not len(same):
        return size
    # the last place of each token counts in all windows that hold it and not the next one
    place, starts = np.arange(len(values)), len(values) - size + 1
    after = np.full(len(values), 2 * len(values))
    after[order[same]] = order[same + 1]
    first, last = np.maximum(place - size + 1, 0), np.minimum(np.minimum(place, after - size), starts - 1)
    held = first <= last
    return int(np.cumsum(np.bincount(first[held], minlength=starts + 1) - np.bincount(last[held] + 1, minlength=starts + 1))[:starts].min())


def _dense(common, a, b, shortest, similarity):
    """The common places of b in stretches that can hold a passage.

    A passage of distinct tokens is common at `similarity` of its places, so some `shortest` places in a row have at least
    2 x similarity - 1 of theirs; repeated tokens are allowed for. And a stretch has all distinct tokens that a passage
    shares, which has on both sides those of some `shortest` places. Chains do not leave a stretch.
    """
    out = np.zeros(len(b), bool)
    places = np.flatnonzero(common)
    if not len(places):
        return out
    own = None
    cuts = np.flatnonzero(places[1:] - places[:-1] > GAP)
    for low, high in zip([int(places[0]), *places[cuts + 1].tolist()], [*places[cuts].tolist(), int(places[-1])], strict=True):
        high += 1
        if high - low >= shortest:
            sums = np.zeros(high - low + 1, np.int64)
            np.cumsum(common[low:high], out=sums[1:])
            least = (2 * similarity - 1) * shortest - 1 - int((sums[shortest:] - sums[:-shortest]).max())
            part = b[low:high]
            if least > 0 and high - low - len(np.unique(part)) < least:
                continue
            if own is None:
                own = _least_distinct(a, shortest)
            shared = len(set(part[common[low:high]].tolist()))
            if shared * (1 + similarity) >= similarity * (own + _least_distinct(part, shortest)) - 1e-9:
                out[low:high] = common[low:high]
    return out


def _runs(order, ranked, b, low, wanted, limit=1 << 21):
    """(start in a, start in b, length) of the maximal runs of equal tokens on a diagonal, for all places of a token in a.

    `ranked` is a in order, `low` has the first place there for each token of b. Only the places of b that `wanted` marks
    are looked at. Runs come by their start in b, then in a.
    """
    j = np.flatnonzero(wanted)
    first = low[j]
    if (ranked[1:] != ranked[:-1]).all():  # one place in a for each of b
        i = order[first]
        new = np.flatnonzero(np.append(True, (j[1:] - j[:-1] != 1) | (i[1:] - i[:-1] != 1)))
        return i[new], j[new], np.diff(new, append=len(j))
    size = np.searchsorted(ranked, b[j], "right") - first
    ends = np.cumsum(size)
    at, out = 0, []
    while at < len(j):  # so many places of b at once that their pairs of places fit into memory
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        some = size[at:stop]
        i = order[np.arange(some.sum()) + np.repeat(first[at:stop] - np.cumsum(some) + some, some)]
        both = np.repeat(j[at:stop], some)
        key = np.sort((i - both + len(low) << 32) + both)  # by diagonal: the next place of a run is the next number
        new = np.flatnonzero(np.append(True, key[1:] - key[:-1] != 1))
        key, length = key[new], np.diff(new, append=len(key))
        out.append(np.stack([(key >> 32) + (key & 0xFFFFFFFF) - len(low), key & 0xFFFFFFFF, length]))
        at = stop
    i, j, length = _joined(*np.concatenate(out, 1)) if len(out) > 1 else out[0]
    by_place = np.argsort((j << 32) + i)
    return i[by_place], j[by_place], length[by_place]


def _joined(i, j, length):
    order = np.lexsort((j, i - j))
    i, j, length = i[order], j[order], length[order]
    new = np.flatnonzero(np.append(True, (np.diff(i - j) != 0) | (np.diff(j) != length[:-1]))) if len(i) else np.zeros(0, np.int64)
    return np.stack([i[new], j[new], np.add.reduceat(length, new) if len(new) else length])


def _followed(runs, few=24, limit=1 << 20):
    """For each run the one that it follows in a chain, or -1: steps are below GAP along both texts and shift least."""
    i, j, length = runs
    if len(i) <= few:
        before, ends = [-1] * len(i), list(zip((i + length).tolist(), (j + length).tolist(), strict=True))
        for n, (x, y) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
            least = GAP
            for m in range(n):
                p, q = x - ends[m][0], y - ends[m][1]
                if 0 <= p < GAP and 0 <= q < GAP and abs(p - q) <= least:
                    least, before[n] = abs(p - q), m
        return before
    before = np.full(len(i), -1)
    by_end = np.argsort(j + length, kind="stable")
    end_i, end_j = (i + length)[by_end], (j + length)[by_end]
    low, high = np.searchsorted(end_j, j - GAP, "right"), np.searchsorted(end_j, j, "right")
    ends = np.cumsum(high - low)
    at = 0
    while at < len(i):  # so many runs at once that those that end near them along b fit into memory
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        size = (high - low)[at:stop]
        n = np.repeat(np.arange(at, stop), size)
        m = np.arange(size.sum()) + np.repeat(low[at:stop] - np.cumsum(size) + size, size)
        p = i[n] - end_i[m]
        near = np.flatnonzero((p >= 0) & (p < GAP))
        n, m, p = n[near], m[near], p[near]
        if len(n):
            rank = (np.abs(p - j[n] + end_j[m]) << 32) - by_end[m]
            new = np.flatnonzero(np.append(True, n[1:] != n[:-1]))
            best = np.minimum.reduceat(rank, new)
            before[n[new]] = -best & 0xFFFFFFFF
        at = stop
    return before.tolist()


def _longest(gain):
    """(first, last) of the longest stretch whose sum is not negative."""
    total, lows, at, best, found = 0.0, [0.0], [0], 0, None
    for end, value in enumerate(gain, 1):
        total += value
        # the first start whose sum is no larger; the lowest sums so far, negative, rise
        if -total > lows[-1]:
            lows.append(-total)
            at.append(end)
        place = bisect_left(lows, -total - 1e-9)
        if place < len(at) and end - at[place] > best:
            best, found = end - at[place], (at[place], end - 1)
    return found


def _outermost(found, few=16, rows=512):
    """Without what lies within another passage on both sides."""
    ranked = sorted(found, key=lambda p: (p[0] - p[1], p))
    if len(ranked) <= few:
        outer = [p for n, p in enumerate(ranked) if not any(
            q[0] <= p[0] and p[1] <= q[1] and q[2] <= p[2] and p[3] <= q[3] for q in ranked[:n])]
        return sorted(outer, key=lambda p: p[2])
    ranked = np.array(ranked, np.int64)
    outer = np.ones(len(ranked), bool)
    for at in range(0, len(ranked), rows):
        own = ranked[at:at + rows, None]
        q = ranked[:at + rows]
        within = (q[:, 0] <= own[..., 0]) & (own[..., 1] <= q[:, 1]) & (q[:, 2] <= own[..., 2]) & (own[..., 3] <= q[:, 3])
        outer[at:at + rows] = ~np.tril(within, at - 1).any(1)
    return sorted(map(tuple, ranked[outer].tolist()), key=lambda p: p[2])


def passages(a, b, shortest, similarity=SIMILARITY):
    """(start in a, end in a, start in b, end in b) in tokens, ends exclusive, of the passages common to two texts.

    A chain counts whole if its tokens are similar enough, else by its longest parts that are; so do all equal stretches.
    """
    if min(len(a), len(b)) < shortest:
        return []
    order = np.argsort(a, kind="stable")
    ranked = a[order]
    low = np.searchsorted(ranked, b)
    common = ranked[np.minimum(low, len(a) - 1)] == b
    wanted = _dense(common, a, b, shortest, similarity)
    if not wanted.any():
        return []
    runs = np.stack(_runs(order, ranked, b, low, wanted))
    i, j, length = runs.tolist()
    found = {(x, x + n, y, y + n) for x, y, n in zip(i, j, length, strict=True) if n >= shortest}
    if len(i) == 1:
        return sorted(found)
    before = _followed(runs)
    root = list(range(len(i)))
    for n, m in enumerate(before):
        if m >= 0:
            root[n] = root[m]

    def place_of(x, y):
        """From the start of run x to the end of run y, if that is long enough."""
        place = i[x], i[y] + length[y], j[x], j[y] + length[y]
        return place if min(place[1] - place[0], place[3] - place[2]) >= shortest else None

    def drop(counts, tokens):
        for x in tokens:
            if counts[x] == 1:
                del counts[x]
            else:
                counts[x] -= 1

    def gain(part):
        """By places: of a stretch of items (run, way to the next, run, ...) the sum tells if it is similar enough."""
        items, last = [], None
        for n in part:
            if last is not None:
                items.append(-similarity * (i[n] - i[last] + j[n] - j[last] - 2 * length[last]))
            items.append(length[n] * (1 - similarity))
            last = n
        return items

    own, other = a.tolist(), b.tolist()
    done = set()
    for n in set(range(len(i))).difference(before):
        if before[n] < 0 or not place_of(root[n], n):  # a run by itself, or a short chain
            continue
        path = []
        while n >= 0:
            path.append(n)
            n = before[n]
        open_parts = [(path[::-1], None)]
        while open_parts:
            part, counts = open_parts.pop()
            first, last = part[0], part[-1]
            place = place_of(first, last)
            if place is None or first == last or (first, last) in done:  # chains that part later have the same beginning
                continue
            done.add((first, last))
            s, t = counts or (set(own[place[0]:place[1]]), set(other[place[2]:place[3]]))
            shared = len(s.keys() & t.keys()) if counts else len(s & t)
            if shared >= similarity * (len(s) + len(t) - shared):
                found.add(place)
                continue
            size = sum(length[n] for n in part)
            if size * (1 - similarity) - similarity * (place[1] - place[0] + place[3] - place[2] - 2 * size) < -1e-9:
                x, y = _longest(gain(part))
                x, y = (x + 1) // 2, y // 2 + 1
                open_parts += [(p, None) for p in (part[:x], part[x:y], part[y:]) if p]
                continue
            # repeats within the part: without its weaker end
            s, t = counts or (Counter(own[place[0]:place[1]]), Counter(other[place[2]:place[3]]))
            if length[first] <= length[last]:
                part = part[1:]
                drop(s, own[place[0]:i[part[0]]])
                drop(t, other[place[2]:j[part[0]]])
            else:
                part = part[:-1]
                drop(s, own[i[part[-1]] + length[part[-1]]:place[1]])
                drop(t, other[j[part[-1]] + length[part[-1]]:place[3]])
            open_parts.append((part, (s, t)))
    return _outermost(found)


def _most(common, new, shortest, similarity=SIMILARITY, sides=2):
    """For each row, the most that a stretch of tokens gains by those in common less what it loses by the others.

    Of two texts with S distinct tokens in common and U others on both sides, a passage has S * (1 - similarity) >= U *
    similarity. With both sides in view each counts half of S. A token that repeats in a row counts once, where `new` says so.
    """
    rows, size = common.shape
    if size < shortest:
        return np.full(rows, -np.inf, np.float32)
    gain = common * np.float32(similarity + (1 - similarity) / sides)
    gain -= np.float32(similarity)
    gain *= new
    sums = np.zeros((rows, size + 1), np.float32)
    np.cumsum(gain, 1, out=sums[:, 1:])
    return (sums[:, shortest:] - np.minimum.accumulate(sums[:, :size + 1 - shortest], 1)).max(1)


def _slack(again, similarity=SIMILARITY, sides=2):
    """What _most may lack: a stretch can begin within a repeated token, and `again` tokens may have come before in it."""
    return similarity * again + (1 - similarity) / sides + 0.01


def _changes(tokens):
    """Where a token differs from the one before it, and how many such places hold a token that came earlier."""
    new = np.append(True, tokens[1:] != tokens[:-1])[:len(tokens)]
    return new, int(new.sum()) - len(np.unique(tokens))


def _in_group(group, tokens):
    """The tokens of a group's text as keys that other groups do not have."""
    return mixed((tokens.astype(np.int64) << 20).view(np.uint64) ^ mixed(np.array([group]).view(np.uint64)))


def _fill_groups(bits, rows=500):
    """Filter segments of the tokens of this task's texts; a text comes once a group."""
    def filled(batches):
        filters = bloom.Pair(bits)
        for batch in batches:
            keys = [_in_group(a, np.unique(x)) for a, x in zip(batch.column("a").to_pylist(), _lists(batch, "tokens"), strict=True)]
            for at in range(0, len(keys), rows):
                filters.add(np.concatenate(keys[at:at + rows]))
        yield from filters.batches()
    return filled


def _likely(shared, shortest):
    """The places around which a second text of the group may have a passage's tokens, one row each."""
    def run(batches):
        for batch in batches:
            places = list(zip(*(_lists(batch, f"place_{c}") for c in _PLACE), strict=True))
            out = [np.zeros((0, len(_PLACE) + 2), np.int64)]
            names = zip(*(batch.column(c).to_pylist() for c in ("a", "text", "start")), strict=True)
            for (a, text, at), part, place in zip(names, _lists(batch, "tokens"), places, strict=True):
                common = bloom.contains(shared.value, _in_group(a, part))
                keep = []
                for low, high in zip(place[1].tolist(), place[2].tolist(), strict=True):
                    x, y = max(low - at - MARGIN, 0), high - at + MARGIN
                    new, again = _changes(part[x:y])
                    keep.append(_most(common[None, x:y], new, shortest, sides=1)[0] >= -_slack(again, sides=1))
                columns = np.stack(place, 1)[keep]
                out.append(np.concatenate([np.full((len(columns), 2), (a, text)), columns], 1))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(out).T], names=["a", "text", *_PLACE])
    return run


class _Key:
    """What the texts of a key have in common around it, which tells most pairs without a passage."""

    def __init__(self, windows, shortest, similarity=SIMILARITY):
        self.shortest, self.similarity = shortest, similarity
        sizes = np.array([len(w) for w in windows])
        owner = np.repeat(np.arange(len(windows)), sizes)
        _, number = np.unique(np.concatenate(windows), return_inverse=True)
        held = np.unique(number * len(windows) + owner)
        twice = np.flatnonzero(np.bincount(held // len(windows)) > 1)
        rank = np.full(int(number.max(initial=0)) + 1, len(twice))  # tokens that one text alone has are none that others have
        rank[twice] = np.arange(len(twice))
        self.has = np.zeros((len(windows), len(twice) + 1), np.bool_)
        self.has[owner, rank[number]] = True
        self.has[:, -1] = False
        self.numbers = np.full((len(windows), int(sizes.max())), len(twice))
        self.new = np.ones(self.numbers.shape, np.bool_)
        at = np.arange(len(number)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.numbers[owner, at] = rank[number]
        edge = np.append(True, (number[1:] != number[:-1]) | (owner[1:] != owner[:-1]))[:len(number)]
        self.new[owner, at] = edge
        again = np.bincount(owner[edge], minlength=len(windows)) - np.bincount(held % len(windows), minlength=len(windows))
        self.slack = _slack(again, similarity)
        least = np.array([_least_distinct(w, shortest) if len(w) >= shortest else np.inf for w in windows])
        shares = self.has.astype(np.float32)
        self.many = shares @ shares.T >= similarity / (1 + similarity) * (least[:, None] + least) - 0.01

    def partners(self, n, others):
        """Those of the members `others` with which n can share a passage."""
        others = others[self.many[n, others]]
        if not len(others):
            return others
        needed = -self.slack[n] - self.slack[others]
        needed -= _most(self.has[others][:, self.numbers[n]], self.new[n], self.shortest, self.similarity)
        near = needed <= self.new[others].sum(1) * (1 - self.similarity) / 2
        others, needed = others[near], needed[near]
        return others[_most(self.has[n][self.numbers[others]], self.new[others], self.shortest, self.similarity) >= needed]


def _covering(found):
    """Of the passages of two texts so many that they hold the same words on both sides; where words repeat there are many more."""
    if len(found) < 3:
        return found
    out = set()
    for first in (0, 2):
        ranked = sorted(found, key=lambda p: (p[first], -p[first + 1]))
        reach, at = -1, 0
        while at < len(ranked):
            best = None
            while at < len(ranked) and ranked[at][first] <= reach:
                if ranked[at][first + 1] > reach and (best is None or ranked[at][first + 1] > best[first + 1]):
                    best = ranked[at]
                at += 1
            if best is None:
                if at == len(ranked):
                    break
                best = ranked[at]
            out.add(best)
            reach = best[first + 1]
    return sorted(out, key=lambda p: p[2])


def _verify(width, shortest):
    """Rows come sorted by a, salt and b, the text a itself (null b) first; a row names the part of a that it is compared with."""
    def run(batches):
        at, own, first = None, None, 0
        for batch in batches:
            out = []
            names = zip(*(batch.column(c).to_pylist() for c in ("a", "salt", "b", "start", "a_from", "a_to")), strict=True)
            for (a, salt, b, start, a_from, a_to), part in zip(names, _lists(batch, "tokens"), strict=True):
                if b is None:
                    at, own, first = (a, salt), part.copy(), start
                elif at == (a, salt):
                    low = max(a_from - first, 0)
                    found = _placed(own[low:max(a_to - first, 0)], part, first + low, start, width, shortest)
                    out += [(a, b, *x) for x in _covering(found)]
            if out:
                yield _passages(out)
    return run


def _placed(a, b, a_at, b_at, width, shortest):
    """The passages of parts of two texts, in words of the whole texts."""
    return [(a_at + i0, a_at + i1 + width - 1, b_at + j0, b_at + j1 + width - 1) for i0, i1, j0, j1 in passages(a, b, shortest)]


_FOUND = "a bigint, b bigint, a_start bigint, a_stop bigint, b_start bigint, b_stop bigint"


def _passages(rows):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["a", "b", "a_start", "a_stop", "b_start", "b_stop"])


def _compare(block, width, shortest, run):
    """Passages between the texts of one block of a group: (side, text, start, tokens, places of keys).

    Two texts of a key are compared if they are of two components, or a passage covers the key not yet in one of them; those
    of one side are left to another block if there are two. They are compared around the key: a chain that is similar enough
    has a part that is, holds a key of its own and is shorter than MARGIN, so a passage shows at one of the keys.
    """
    parts, keys, known, spans, up, out = {}, {}, {}, {}, {}, set()
    sides = {x[0] for x in block}
    for side, text, start, part, places in block:
        parts[text] = side, start, part
        for key, *place in places:
            keys.setdefault(key, []).append((text, *place))

    def find(x):
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    def covered(member):
        text, low, high, _, done, _, size = member
        own = spans.get(text, ())
        return done or any(x <= low and low + size <= y for x, y in own) and any(x <= high - size and high <= y for x, y in own)

    def may_hold(x, y):
        """False if the common run at the key, which is at one place in both texts, is too short for a passage's longest."""
        if x[2] - x[1] != x[6] or y[2] - y[1] != y[6]:
            return True
        _, x_at, a = parts[x[0]]
        _, y_at, b = parts[y[0]]
        i, j = x[1] - x_at, y[1] - y_at
        back, size = min(i, j, run), x[2] - x[1] - width + 1
        left = a[i - back:i] == b[j - back:j]
        ahead = min(len(a) - i, len(b) - j, size + run)
        right = a[i:i + ahead] == b[j:j + ahead]
        return _leading(left[::-1]) + _leading(right) >= run

    def compare(x, y):
        x, y = (x, y) if x[0] < y[0] else (y, x)
        seen = known.setdefault((x[0], y[0]), [])
        if any(i <= x[1] and x[2] <= j and k <= y[1] and y[2] <= m for i, j, k, m in seen) or not may_hold(x, y):
            return
        (_, x_at, a), (_, y_at, b) = parts[x[0]], parts[y[0]]
        i, k = max(x[1] - x_at - MARGIN, 0), max(y[1] - y_at - MARGIN, 0)
        a, b = a[i:x[2] - x_at + MARGIN], b[k:y[2] - y_at + MARGIN]
        # keys so close to this one have nearly the same surroundings
        near = MARGIN - 2 * shortest - GAP
        seen.append((x[1] - near, x[2] + near, y[1] - near, y[2] + near))
        found = _placed(a, b, x_at + i, y_at + k, width, shortest)
        if found:
            up[find(x[5])] = find(y[5])
            spans.setdefault(x[0], set()).update(p[:2] for p in found)
            spans.setdefault(y[0], set()).update(p[2:] for p in found)
            out.update((x[0], y[0], *p) for p in _covering(found))

    def window(member):
        """The part of a member's text that is compared."""
        text, low, high, *_ = member
        _, at, part = parts[text]
        return part[max(low - at - MARGIN, 0):high - at + MARGIN]

    for members in keys.values():
        members = sorted(members, key=lambda m: -m[3])
        first = sum(m[3] for m in members)
        side = np.array([parts[m[0]][0] for m in members])
        key = _Key([*map(window, members)], shortest) if (len(members) - first) * len(members) > FEW_PAIRS else None
        for n in range(first, len(members)):
            y = members[n]
            others = np.flatnonzero(side[:n] != side[n]) if len(sides) > 1 else np.arange(n)
            for m in (key.partners(n, others) if key else others).tolist():
                x = members[m]
                if not (find(x[5]) == find(y[5]) and covered(x) and covered(y)):
                    compare(x, y)
    return list(out)


def _leading(equal):
    """How many of the first values are true."""
    return len(equal) if equal.all() else int(equal.argmin())


#: What a block knows of a text's place of a key.
_PLACE = ["key", "start", "stop", "linked", "covered", "component", "size"]


def _blocks(width, shortest, run):
    """Rows come sorted by a, kind, i, j: those of one block are compared together."""
    def compared(batches):
        at, block = None, []
        for batch in batches:
            out = []
            names = zip(*(batch.column(c).to_pylist() for c in ("a", "kind", "i", "j", "side", "text", "start")), strict=True)
            places = zip(*(_lists(batch, f"place_{c}") for c in _PLACE), strict=True)
            for (*task, side, text, start), part, place in zip(names, _lists(batch, "tokens"), places, strict=True):
                if task != at:
                    out += _compare(block, width, shortest, run)
                    at, block = task, []
                block.append((side, text, start, part.copy(), list(zip(*(c.tolist() for c in place), strict=True))))
            if out:
                yield _passages(out)
        if out := _compare(block, width, shortest, run):
            yield _passages(out)
    return compared


def _cut(batches):
    """Tokens from `start` to `stop` of the whole lists."""
    for batch in batches:
        start, stop = (batch.column(c).to_numpy() for c in ("start", "stop"))
        lists = [x[i:j] for x, i, j in zip(_lists(batch, "tokens"), start, stop, strict=True)]
        offsets = np.cumsum([0, *map(len, lists)]).astype(np.int32)
        cut = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int32), pa.int32()))
        columns = [cut if c == "tokens" else batch.column(c) for c in batch.schema.names]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def _merge_spans(batches):
    """Rows come sorted by text and start: overlapping and touching spans become one."""
    held = None
    for batch in batches:
        out = []
        for text, start, stop in zip(*(batch.column(c).to_pylist() for c in ("text", "start", "stop")), strict=True):
            if held is not None and held[0] == text and start <= held[2]:
                held = (text, held[1], max(held[2], stop))
            else:
                if held is not None:
                    out.append(held)
                held = (text, start, stop)
        if out:
            yield _spans(out)
    if held is not None:
        yield _spans([held])


def _spans(rows):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["text", "start", "stop"])


def passage_pairs(docs, text_col="text", width=WIDTH, min_words=MIN_WORDS):
    """A stored table (a, b, a_start, a_stop, b_start, b_stop) of passages that two texts share, in words, ends exclusive.

    a and b name texts by their hash. All texts with a passage are linked, over other texts or directly.
    """
    spark = docs.sparkSession
    shortest = min_words - width + 1
    run = least_run(width, shortest)
    key_width = min(KEY_WIDTH, run + width - 1)
    key_run = run + width - key_width
    texts = row_and_text(docs, text_col).select("text")
    n_bytes = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = bloom.size_for(n_bytes // 6 * 2 * KEY_FUNCTIONS // key_run, BITS_PER_KEY, MAX_BITS)
    filled = stored(texts.mapInArrow(_fill(bits, key_width, key_run), bloom.PARTIAL), "passage-filters")
    shared = spark.sparkContext.broadcast(bloom.twice_filter(filled, bits))
    dealt = texts.mapInArrow(_deal(shared, key_width, key_run), "key bigint, text bigint, start bigint, stop bigint")
    members = stored(dealt.groupBy("key", "text").agg(F.min("start").alias("start"), F.max("stop").alias("stop"),
                                                   (F.min("stop") - F.min("start")).alias("size")), "passage-keys")
    first = members.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("text", "start", "stop")).alias("a"))
    first = stored(first.where("n > 1").select(
        "key", "n", F.col("a.text").alias("a"), F.col("a.start").alias("a_start"), F.col("a.stop").alias("a_stop")), "passage-first")
    members = stored(lookup(members, first, "key", "n", HOT_SHARE).where("a IS NOT NULL"), "passage-members")
    names = members.select("text").distinct()
    asked = spark.sparkContext.broadcast(_name_filter(names))
    lists = stored(texts.mapInArrow(_tokens_of(asked, width), "text bigint, tokens array<int>").dropDuplicates(["text"]), "passage-tokens")
    near = stored(members.where("a <> text").groupBy("a", F.col("text").alias("b")).agg(
        *(f(c).alias(n) for f, c, n in ((F.min, "a_start", "a_from"), (F.max, "a_stop", "a_to"),
                                        (F.min, "start", "start"), (F.max, "stop", "stop")))), "passage-pairs")
    found = _verified(lists, near, width, shortest)
    left = _narrowed(_left_over(members, found), lists, shortest)
    return found if left.isEmpty() else found.unionByName(_compared(lists, left, width, shortest, run))


def _widened(start, stop):
    """The tokens around keys that a passage with them can reach: beyond its last long run similarity falls faster than it rose."""
    reach = MARGIN + 3 * (F.col(stop) - F.col(start))
    return F.greatest(F.col(start) - reach, F.lit(0)).alias(start), (F.col(stop) + reach).alias(stop)


def _left_over(members, found):
    """Members of the keys whose texts are not yet of one component, or hold the key where no passage is found.

    A member is linked if it is of the component of the key's first text and a passage covers the key, at its
    first and last place.
    """
    named = components(found.select("a", "b")).withColumnRenamed("node", "text")
    spans = _merged(_sides(found)).groupBy("text").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    texts = stored(spans.join(named, "text"), "passage-linked")
    first = texts.select(F.col("text").alias("a"), F.col("component").alias("a_component"))
    first_stop, last_start = F.col("m.start") + F.col("size"), F.col("m.stop") - F.col("size")
    covered = F.exists("spans", lambda p: (p["start"] <= F.col("m.start")) & (first_stop <= p["stop"]))
    covered &= F.exists("spans", lambda p: (p["start"] <= last_start) & (F.col("m.stop") <= p["stop"]))
    marked = members.alias("m").join(texts, "text", "left").join(first, "a", "left").select(
        "key", "a", "text", F.col("m.start").alias("start"), F.col("m.stop").alias("stop"), "size",
        F.coalesce(covered, F.lit(False)).cast("bigint").alias("covered"), F.coalesce("component", "text").alias("component"),
        F.coalesce("a_component", "a").alias("a_component"))
    marked = stored(marked.withColumn("linked", F.when(F.col("component") == F.col("a_component"), F.col("covered")).otherwise(0)
                                      .cast("bigint")).drop("a_component"), "passage-marked")
    done = stored(marked.groupBy("key").agg(F.count("*").alias("n"), F.min("linked").alias("done")), "passage-done")
    return stored(lookup(marked, done, "key", "n", HOT_SHARE).where("done = 0").select(*marked.columns), "passage-open")


def _narrowed(members, lists, shortest):
    """Members without those of large groups that have too few tokens around their key in common with all others of the group.

    The tokens of each group go into a pair of filters, so this is one pass over texts, not over pairs; a filter that is
    full keeps more members and loses none.
    """
    spark = members.sparkSession
    sizes = members.groupBy("a").agg(F.count_distinct("text").alias("n"))
    large = stored(sizes.where(F.col("n") > MORE_LEADERS).select("a"), "passage-large")
    if large.isEmpty():
        return members
    rows = members.join(large, "a", "left_semi").groupBy("a", "text").agg(
        F.greatest(F.min("start") - MARGIN, F.lit(0)).alias("start"), (F.max("stop") + MARGIN).alias("stop"),
        *(F.collect_list(c).alias(f"place_{c}") for c in _PLACE))
    ready = rows.join(lists, "text")
    windows = stored(ready.mapInArrow(_cut, ready.schema), "passage-windows")
    bits = bloom.size_for(windows.agg(F.sum(F.size("tokens"))).first()[0] or 0, 2 * BITS_PER_KEY, MAX_BITS)
    filled = stored(windows.select("a", "tokens").mapInArrow(_fill_groups(bits), bloom.PARTIAL), "passage-common")
    shared = spark.sparkContext.broadcast(bloom.twice_filter(filled, bits))
    kept = windows.mapInArrow(_likely(shared, shortest), ", ".join(f"{c} bigint" for c in ("a", "text", *_PLACE)))
    others = members.join(large, "a", "left_anti")
    return stored(others.unionByName(kept.select(*others.columns)), "passage-likely")


def _sides(found):
    """(text, other, start, stop): each passage from both sides."""
    sides = found.select(F.col("a").alias("text"), F.col("b").alias("other"), F.col("a_start").alias("start"), F.col("a_stop").alias("stop"))
    return sides.unionByName(found.select(
        F.col("b").alias("text"), F.col("a").alias("other"), F.col("b_start").alias("start"), F.col("b_stop").alias("stop")))


def _merged(sides):
    merged = sides.select("text", "start", "stop").distinct().repartition("text").sortWithinPartitions("text", "start")
    return merged.mapInArrow(_merge_spans, "text bigint, start bigint, stop bigint")


def _compared(lists, members, width, shortest, run):
    """A stored table of the passages between the members that are not linked to a key's first text and all others.

    The keys of one first text go together. Its texts are dealt to chunks, and every chunk of texts that are not linked
    somewhere meets every chunk; two chunks of linked texts do not.
    """
    rows = stored(members.groupBy("a", "text").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("linked").alias("whole"),
        F.sort_array(F.collect_list(F.struct(*_PLACE))).alias("places")), "passage-places")
    chunks = rows.groupBy("a").agg(*(F.ceil(F.sum(n) / MORE_LEADERS).cast("int").alias(c) for n, c in (
        (1 - F.col("whole"), "open_chunks"), (F.col("whole"), "linked_chunks"))))
    upto = lambda c: F.when(F.col(c) > 0, F.sequence(F.lit(0), F.col(c) - 1)).otherwise(F.array().cast("array<int>"))
    own = F.pmod(F.xxhash64("text"), F.when(F.col("whole") == 1, F.col("linked_chunks")).otherwise(F.col("open_chunks"))).cast("int")
    task = lambda kind, i, j, side: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"))
    among = F.transform(upto("open_chunks"), lambda c: task(
        0, F.least(c, F.col("own")), F.greatest(c, F.col("own")), F.col("own") > c))
    outward = F.transform(upto("linked_chunks"), lambda c: task(1, F.col("own"), c, F.lit(0)))
    inward = F.transform(upto("open_chunks"), lambda c: task(1, c, F.col("own"), F.lit(1)))
    tasks = F.when(F.col("whole") == 1, inward).otherwise(F.concat(among, outward))
    dealt = rows.join(chunks, "a").withColumn("own", own).select("a", "text", "start", "stop", "places", F.explode(tasks).alias("task"))
    dealt = stored(dealt.select("a", "task.*", "text", *_widened("start", "stop"), *(
        F.col(f"places.{c}").alias(f"place_{c}") for c in _PLACE)), "passage-blocks")
    ready = dealt.join(lists, "text")
    ready = ready.mapInArrow(_cut, ready.schema).repartition(
        pieces_for(dealt, _tasks(lists), BLOCK_ROWS), "a", "kind", "i", "j").sortWithinPartitions("a", "kind", "i", "j", "side", "text")
    return stored(ready.mapInArrow(_blocks(width, shortest, run), _FOUND).distinct(), "passages")


def _tasks(df):
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _verified(lists, near, width, shortest):
    """A stored table of the passages of candidates (a, b, a_from, a_to, start, stop), given by the places of their keys."""
    near = near.select("a", "b", *_widened("a_from", "a_to"), *_widened("start", "stop"))
    salts = near.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("salts"),
                                  F.min("a_from").alias("least"), F.max("a_to").alias("most"))
    none = F.lit(None).cast("bigint")
    parts = near.join(salts, "a").select(
        "a", F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt"), "b", F.col("b").alias("text"), "start", "stop", "a_from", "a_to")
    wholes = salts.select(
        "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), none.alias("b"), F.col("a").alias("text"),
        F.col("least").alias("start"), F.col("most").alias("stop"), none.alias("a_from"), none.alias("a_to"))
    wanted = stored(parts.unionByName(wholes), "passage-parts")
    ready = wanted.join(lists, "text")
    ready = ready.mapInArrow(_cut, ready.schema).repartition(
        pieces_for(wanted, _tasks(lists), CANDIDATES), "a", "salt").sortWithinPartitions("a", "salt", F.asc_nulls_first("b"))
    return stored(ready.mapInArrow(_verify(width, shortest), _FOUND).distinct(), "passages")


def _name_filter(names):
    """A filter of bounded size that holds all names."""
    bits = bloom.size_for(names.count(), 16, MAX_BITS)

    def fill(batches):
        filters = bloom.Pair(bits)
        for batch in batches:
            filters.add(batch.column(0).to_numpy().view(np.uint64))
        yield from filters.batches()

    return bloom.once_filter(names.mapInArrow(fill, bloom.PARTIAL), bits)


def near_duplicate_passages(docs, id_col="doc_id", text_col="text", width=WIDTH, min_words=MIN_WORDS):
    """One row for each document that shares a passage with another.

    doc_id, component_id (smallest doc_id linked by passages, itself included), n_links (texts linked with this one),
    n_copies (rows with the same text, itself included), spans (start:end in words, comma-joined), n_span_words.
    """
    def named(batches):
        for piece in pieces(batches):
            texts = piece.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(_names(texts)), pa.array([len(t.split()) for t in texts], pa.int64())],
                names=["doc_id", "text", "n_words"])

    rows = id_and_text(docs, id_col, text_col)
    ids = stored(rows.mapInArrow(named, rows.select(
        "doc_id", F.lit(0).cast("bigint").alias("text"), F.lit(0).cast("bigint").alias("n_words")).schema), "text-names")
    found = passage_pairs(docs, text_col, width, min_words)
    sides = _sides(found)
    merged = _merged(sides)
    linked = sides.groupBy("text").agg(F.count_distinct("other").alias("n_links"))
    spans = merged.groupBy("text").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    named_components = components(found.select("a", "b")).withColumnRenamed("node", "text")
    counted = ids.groupBy("text").agg(
        F.count("*").alias("n_copies"), F.max("n_words").alias("n_words"), F.min("doc_id").alias("least"))
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_words").alias("stop")))
    texts = counted.join(named_components, "text", "left").join(linked, "text", "left").join(spans, "text", "left")
    is_copy = (F.col("n_copies") > 1) & (F.col("n_words") >= min_words)
    texts = stored(texts.where(is_copy | F.col("component").isNotNull()).select(
        "text", "n_copies", "least", F.coalesce("component", "text").alias("component"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), F.when(is_copy, whole).otherwise(F.col("spans")).alias("spans")),
        "passage-texts")
    least = texts.groupBy("component").agg(F.min("least").alias("component_id"))
    answers = stored(texts.join(least, "component").select(
        "text", "component_id", "n_links", F.col("n_copies").alias("copies"), "spans", F.col("n_copies").alias("n")), "passage-answers")
    shown = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["stop"])))
    return lookup(ids.select("doc_id", "text"), answers, "text", "n").where("spans IS NOT NULL").select(
        "doc_id", "component_id", "n_links", F.col("copies").alias("n_copies"), shown.alias("spans"),
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"]).alias("n_span_words"))
