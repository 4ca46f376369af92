"""Source divergence audit by chunk factorization: term counts of every source, and how far they lie apart.

Counting. Texts are cut at ASCII white space into chunks, which no term crosses. A task gathers documents into pieces of
`PIECE_BYTES`; a piece numbers its distinct chunks and keeps, for each document, the numbers and counts of its chunks.
The chunks are dealt by their hash into slices, a compressed list for each piece and slice, and shuffled by slice. There
each globally distinct chunk is tokenized once, and its terms go back, under its numbers, to the pieces that hold it.
They are joined with the documents' counts: a term is in a document once, however many of its chunks hold it, so distinct
documents are exact, and they add up over pieces, which share no document. What leaves a piece is the documents and
occurrences of each (lang, source, term), again in slices, by term, where they are summed. A chunk is shuffled once a
piece, not once a document, so a chunk, source or language that holds most rows stays small; a task holds one piece, or
the distinct chunks or terms of one slice.

Comparing. A language keeps the terms of at least `MIN_DOCS` of its documents. Shares p are whole numbers, made with
decimals where 64 bits could overflow. For pairs of sources, sources of a language are numbered and cut into blocks of `SOURCES`;
a term's row for a pair of blocks holds the shares of the sources that have it, and tasks add up |p - q| against the
share at count 0 of all others. What neither source of a pair has adds the same to each term, so it is a product.

A null text, lang or source is ''. Every row is a document, repeated rows too. Every (lang, source) that occurs is compared, without
terms as well: its shares are those of count 0, and all values are 0 where a language keeps no term. A very long text is a
piece by itself. Equal values are ranked by the bytes of their item. Without documents there are no rows.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rateflow.llm.common import bound_batches, column, pieces, stored
from rateflow.llm.terms import CHUNKS, LETTERS, runs
from rateflow.llm.wordhash import LOWER

PIECE_BYTES = 32 << 20
STEP_BYTES = 4 << 20
MIN_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
SMOOTH = 5
#: Sources of a block, and parts that a block's row of shares at count 0 is repeated for.
SOURCES, SALTS = 256, 64
#: Slices at least and at most; between them, four for each shuffle partition.
SLICES = 64, 8192
_GROUP = pa.struct([("lang", pa.string()), ("source", pa.string())])
_GROUPS = "groups array<struct<lang:string,source:string>>"
_COUNTS = "lang string, source string, term binary, n_docs bigint, n_occurrences bigint"
#: Lower-case letters for letters, the line feed for itself and spaces for all other bytes.
_TO_TERMS = bytes(b if b == 10 else int(LOWER[b]) if LETTERS[b] else 32 for b in range(256))


def _labelled(docs, text_col, lang_col, source_col):
    bound_batches(docs.sparkSession)
    lang, source = (F.coalesce(column(c).cast("string"), F.lit("")) for c in (lang_col, source_col))
    return docs.select(lang.alias("lang"), source.alias("source"), F.coalesce(column(text_col), F.lit("")).cast("binary").alias("text"))


def _squeeze(data):
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unsqueeze(data):
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _pack(*arrays):
    """Some arrays of 32-bit integers of one length, ascending ones best as differences."""
    return _squeeze(b"".join(np.asarray(a).astype("<i4").tobytes() for a in arrays))


def _unpack(data, n):
    return np.frombuffer(_unsqueeze(data), "<i4").astype(np.int64).reshape(n, -1)


def _slice_of(texts, slices):
    return np.fromiter((zlib.crc32(t) % slices for t in texts), np.int64, len(texts))


def _rows(names, kinds, rows):
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)


_FACTORED = f"piece bigint, slice int, numbers binary, body binary, {_GROUPS}"
_FACTORED_ROW = (["piece", "slice", "numbers", "body", "groups"],
                 [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(_GROUP)])


class _Piece:
    """The chunks of some documents, numbered as they come."""

    def __init__(self, name):
        self.name, self.numbers, self.size = name, {}, 0

    def add(self, batch):
        """The row of a batch's documents: their groups, and for each the numbers and counts of its chunks."""
        chunks, sizes = runs(batch.column("text"), CHUNKS, lower=False)
        found = chunks.dictionary_encode()
        numbers = self.numbers
        known = np.fromiter((numbers.setdefault(c, len(numbers)) for c in found.dictionary.to_pylist()), np.int64, len(found.dictionary))
        owner, width = np.repeat(np.arange(len(sizes)), sizes), max(1, len(numbers))
        both, counts = np.unique(owner * width + known[found.indices.to_numpy(zero_copy_only=False)], return_counts=True)
        owner, number = np.divmod(both, width)
        names, group = {}, np.zeros(len(sizes), np.int64)
        for i, name in enumerate(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())):
            group[i] = names.setdefault(name, len(names))
        self.size += batch.nbytes
        groups = [{"lang": a, "source": b} for a, b in names]
        per_doc = _pack(group, np.bincount(owner, minlength=len(sizes)))
        return _rows(*_FACTORED_ROW, [(self.name, None, per_doc, _pack(np.diff(number, prepend=0), counts), groups)])

    def chunks(self, slices):
        """Rows of all chunks, by slice."""
        texts = list(self.numbers)
        slice_of = _slice_of(texts, slices)
        order = np.argsort(slice_of, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(slice_of[order])) + 1) if texts else []:
            body = _squeeze(b"\n".join([texts[i] for i in part]))
            yield _rows(*_FACTORED_ROW, [(self.name, int(slice_of[part[0]]), _pack(np.diff(part, prepend=0)), body, None)])


def _factored(slices, piece_bytes, step_bytes):
    def run(batches):
        first = TaskContext.get().partitionId() << 32
        piece, n = _Piece(first), 0
        for batch in pieces(batches, limit=step_bytes):
            yield piece.add(batch)
            if piece.size >= piece_bytes:
                yield from piece.chunks(slices)
                n += 1
                piece = _Piece(first + n)
        yield from piece.chunks(slices)
    return run


def _tokenized(batches):
    """For every piece the terms of its chunks in a slice; rows come by slice, and each chunk of a slice is tokenized once."""
    now, known = None, {}
    for batch in batches:
        for r in batch.to_pylist():
            if r["slice"] != now:
                now, known = r["slice"], {}
            chunks = _unsqueeze(r["body"]).split(b"\n")
            fresh = [c for c in chunks if c not in known]
            if fresh:
                lines = b"\n".join(fresh).translate(_TO_TERMS).split(b"\n")
                known.update(zip(fresh, [b" ".join(line.split()) for line in lines]))
            terms = [known[c] for c in chunks]
            held = [i for i, t in enumerate(terms) if t]
            if held:
                numbers = np.cumsum(_unpack(r["numbers"], 1)[0])[held]
                body = _squeeze(b"\n".join([terms[i] for i in held]))
                yield _rows(["piece", "numbers", "body"], [pa.int64(), pa.binary(), pa.binary()],
                            [(r["piece"], _pack(np.diff(numbers, prepend=0)), body)])


class _Terms:
    """Terms of numbered chunks."""

    def __init__(self, table):
        number, count, self.names, word = [], [], {}, []
        for packed, body in zip(table.column("numbers").to_pylist(), table.column("body").to_pylist()):
            number.append(np.cumsum(_unpack(packed, 1)[0]))
            text = _unsqueeze(body)
            count.append(np.fromiter((line.count(b" ") + 1 for line in text.split(b"\n")), np.int64, len(number[-1])))
            names = self.names
            word.append(np.fromiter((names.setdefault(t, len(names)) for t in text.split()), np.int64, count[-1].sum()))
        number, count, self.word = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (number, count, word))
        self.count, self.first = (np.zeros(int(number.max(initial=-1)) + 2, np.int64) for _ in range(2))
        self.count[number], self.first[number] = count, np.cumsum(count) - count

    def of(self, chunk):
        """Numbers of the terms of each chunk, one chunk after the other, and how many each has."""
        chunk = np.minimum(chunk, len(self.count) - 1)  # the last has none
        n = self.count[chunk]
        return self.word[np.repeat(self.first[chunk] - (np.cumsum(n) - n), n) + np.arange(n.sum())], n


def _add_up(keys, *values):
    """Distinct keys and the sums of their values."""
    keys, inverse = np.unique(keys, return_inverse=True)
    return keys, *(np.bincount(inverse, v, len(keys)).astype(np.int64) for v in values)


_COUNTED = f"slice int, {_GROUPS}, numbers binary, body binary"
_COUNTED_ROW = ["slice", "groups", "numbers", "body"], [pa.int32(), pa.list_(_GROUP), pa.binary(), pa.binary()]


def _joined(slices):
    """Distinct documents and occurrences of each (group, term) of a piece, by slice of terms."""
    def run(term_rows, documents):
        terms, names, parts = _Terms(term_rows), {}, []
        width = max(1, len(terms.names))
        for r in documents.to_pylist():
            group, n_chunks = _unpack(r["numbers"], 2)
            steps, counts = _unpack(r["body"], 2)
            group = np.array([names.setdefault((g["lang"], g["source"]), len(names)) for g in r["groups"]], np.int64)[group]
            term, n = terms.of(np.cumsum(steps))
            doc = np.repeat(np.repeat(np.arange(len(n_chunks)), n_chunks), n)
            both, held = _add_up(doc * width + term, np.repeat(counts, n))
            doc, term = np.divmod(both, width)
            parts.append(_add_up(group[doc] * width + term, np.ones(len(doc)), held))
        parts = parts or [(np.zeros(0, np.int64),) * 3]
        both, n_docs, held = _add_up(*(np.concatenate(x) for x in zip(*parts)))
        group, term = np.divmod(both, width)
        texts = list(terms.names)
        slice_of = _slice_of(texts, slices)[term] if texts else term
        order = np.lexsort((term, slice_of))
        rows, names = [], list(names)
        for part in np.split(order, np.flatnonzero(np.diff(slice_of[order])) + 1) if len(order) else []:
            used, of_group = np.unique(group[part], return_inverse=True)
            words, of_word = np.unique(term[part], return_inverse=True)
            groups = [{"lang": names[i][0], "source": names[i][1]} for i in used]
            body = _squeeze(b"\n".join([texts[i] for i in words]))
            rows.append((int(slice_of[part[0]]), groups, _pack(of_group, np.diff(of_word, prepend=0), n_docs[part], held[part]), body))
        if not rows:
            return pa.table({n: pa.array([], k) for n, k in zip(*_COUNTED_ROW)})
        return pa.Table.from_batches([_rows(*_COUNTED_ROW, rows)])
    return run


class _Sums:
    """Counts of (group, term) of one slice of terms, added up."""

    def __init__(self, least):
        self.least, self.groups, self.terms, self.parts, self.held = least, {}, {}, [], 0

    def add(self, r):
        groups, terms = self.groups, self.terms
        group = np.array([groups.setdefault((g["lang"], g["source"]), len(groups)) for g in r["groups"]], np.int64)
        words = _unsqueeze(r["body"]).split(b"\n")
        word = np.fromiter((terms.setdefault(w, len(terms)) for w in words), np.int64, len(words))
        of_group, steps, n_docs, held = _unpack(r["numbers"], 4)
        self.parts.append((group[of_group] << 32 | word[np.cumsum(steps)], n_docs, held))
        self.held += len(held)
        if self.held > 1 << 20:
            self.parts = [_add_up(*(np.concatenate(x) for x in zip(*self.parts)))]
            self.held = -2 * len(self.parts[0][0])  # the next time, when as much again has come, and more

    def rows(self):
        """The counts of terms in at least so many documents of their language."""
        if not self.parts:
            return
        both, n_docs, held = _add_up(*(np.concatenate(x) for x in zip(*self.parts)))
        group, term = both >> 32, both & 0xFFFFFFFF
        langs = {}
        lang = np.array([langs.setdefault(g[0], len(langs)) for g in self.groups], np.int64)[group]
        keys, inverse = np.unique(lang << 32 | term, return_inverse=True)
        keep = np.flatnonzero(np.bincount(inverse, n_docs, len(keys))[inverse] >= self.least)
        groups, terms = list(self.groups), pa.array(list(self.terms), pa.binary())
        lang, source = (pa.array([g[i] for g in groups], pa.string()).take(pa.array(group[keep])) for i in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [lang, source, terms.take(pa.array(term[keep])), pa.array(n_docs[keep]), pa.array(held[keep])],
            names=["lang", "source", "term", "n_docs", "n_occurrences"])


def _summed(least):
    def run(batches):
        now, sums = None, _Sums(least)
        for batch in batches:
            for r in batch.to_pylist():
                if r["slice"] != now:
                    yield from sums.rows()
                    now, sums = r["slice"], _Sums(least)
                sums.add(r)
        yield from sums.rows()
    return run


def _by_slice(df):
    return df.repartition("slice").sortWithinPartitions("slice")


def term_counts(docs, text_col="text", lang_col="lang", source_col="source", min_docs=1):
    """lang, source, term, n_docs (distinct documents), n_occurrences, of terms in at least min_docs documents of the lang."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = min(max(SLICES[0], 4 * partitions), SLICES[1])
    factored = stored(_labelled(docs, text_col, lang_col, source_col).mapInArrow(_factored(slices, PIECE_BYTES, STEP_BYTES), _FACTORED), "chunk-counts")
    terms = _by_slice(factored.where("slice IS NOT NULL").select("piece", "slice", "numbers", "body")).mapInArrow(
        _tokenized, "piece bigint, numbers binary, body binary")
    documents = factored.where("slice IS NULL").select("piece", "numbers", "body", "groups")
    counted = terms.groupBy("piece").cogroup(documents.groupBy("piece")).applyInArrow(_joined(slices), _COUNTED)
    return _by_slice(counted).mapInArrow(_summed(min_docs), _COUNTS).withColumn("term", F.col("term").cast("string"))


def kept_terms(counts):
    """lang, term, count: all occurrences of the counted terms in a language."""
    return counts.groupBy("lang", "term").agg(F.sum("n_occurrences").alias("count"))


def _share(count, n, v):
    """1 + floor(SCALE * (count + SMOOTH) / (n + SMOOTH * v)) in decimals."""
    wide = lambda c: c.cast("decimal(20,0)")
    top = F.lit(SCALE).cast("decimal(10,0)") * (wide(count) + F.lit(SMOOTH).cast("decimal(1,0)"))
    return F.call_function("div", top, wide(n) + F.lit(SMOOTH).cast("decimal(1,0)") * wide(v)) + 1


def _add_tiles(width, batches):
    """Sums over terms of |p - q| less that at count 0, for the pairs of sources of two blocks of `width`."""
    sums = {}
    for batch in batches:
        tiles = {}
        for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in ("lang", "i", "j")))):
            tiles.setdefault(key, []).append(i)
        for key, rows in tiles.items():
            part = batch.take(pa.array(rows))
            base = [np.array(part.column(c)[0].as_py(), np.int64) for c in ("base_i", "base_j")]
            entries = part.column("entries")
            sizes = np.diff(np.asarray(entries.offsets))
            side, at, p = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in entries.flatten().flatten())
            row = np.repeat(np.arange(len(rows)), sizes)
            dense = []
            for k, block in ((0, key[1]), (1, key[2])):
                shares = np.repeat(base[k][None, :], len(rows), 0)
                mine = side == block
                shares[row[mine], at[mine]] = p[mine]
                dense.append(shares)
            apart = np.abs(base[0][:, None] - base[1][None, :])
            total = sums.setdefault(key, np.zeros(apart.shape, np.int64))
            step = max(1, (1 << 21) // apart.size)
            for start in range(0, len(rows), step):
                a, b = (x[start:start + step] for x in dense)
                total += np.abs(a[:, :, None] - b[:, None, :]).sum(0) - len(a) * apart
        if len(sums) > 64:
            yield from _tile_rows(sums, width)
            sums = {}
    yield from _tile_rows(sums, width)


def _tile_rows(sums, width):
    for (lang, i, j), total in sums.items():
        a, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * len(a), pa.string()), pa.array(a + i * width, pa.int64()), pa.array(b + j * width, pa.int64()),
            pa.array(total[a, b])], names=["lang", "a", "b", "part"])


def _pairs(held, groups):
    """lang, source, item, value for every two sources of a language."""
    width = SOURCES
    no = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    numbered = stored(groups.select(
        "lang", "source", "v", no.cast("bigint").alias("no"), _share(F.lit(0), F.col("n"), F.col("v")).alias("none")), "numbered-sources")
    block = F.expr(f"no div {width}")
    blocks = numbered.groupBy("lang", block.alias("i")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("no", "none"))), lambda s: s["none"]).alias("base_i"))
    last = F.max("i").over(Window.partitionBy("lang"))
    blocks = blocks.withColumn("last", last)
    other = blocks.select("lang", F.col("i").alias("j"), F.col("base_i").alias("base_j"))
    salt = F.sequence(F.lit(0), F.lit(SALTS - 1))
    tiles = blocks.join(other, "lang").where("i <= j").select("lang", "i", "j", "base_i", "base_j", F.explode(salt).alias("salt"))
    rows = held.join(numbered.select("lang", "source", "no"), ["lang", "source"]).join(
        blocks.groupBy("lang").agg(F.max("last").alias("last")), "lang")
    rows = rows.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), "last")))
    entry = F.struct(F.col("own").alias("side"), F.pmod("no", F.lit(width)).alias("at"), F.col("p").alias("p"))
    rows = rows.groupBy("lang", "term", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).agg(
        F.collect_list(entry).alias("entries"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int")).join(tiles, ["lang", "i", "j", "salt"])
    parts = rows.select("lang", "i", "j", "entries", "base_i", "base_j").mapInArrow(
        lambda batches: _add_tiles(width, batches), "lang string, a bigint, b bigint, part bigint").groupBy("lang", "a", "b").agg(F.sum("part").alias("part"))
    both = parts.unionByName(parts.where(F.expr(f"a div {width} < b div {width}")).select(
        "lang", F.col("b").alias("a"), F.col("a").alias("b"), "part"))
    mine = numbered.select("lang", "source", "v", F.col("no").alias("a"), F.col("none").alias("none_a"))
    others = numbered.select("lang", F.col("source").alias("item"), F.col("no").alias("b"), F.col("none").alias("none_b"))
    value = F.coalesce(F.col("v") * F.abs(F.col("none_a") - F.col("none_b")), F.lit(0)) + F.coalesce("part", F.lit(0))
    return mine.join(others, "lang").where("a <> b").join(both, ["lang", "a", "b"], "left").select(
        "lang", "source", "item", value.cast("bigint").alias("value"))


def audit(docs, min_docs=MIN_DOCS, top=TOP_TERMS, text_col="text", lang_col="lang", source_col="source"):
    """lang, source, part, item, value, rank: sources by their distance, and the terms that a source has more of."""
    counts = stored(term_counts(docs, text_col, lang_col, source_col, min_docs), "term-counts")
    kept = stored(kept_terms(counts), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("count").alias("n_lang"))
    held = counts.select("lang", "source", "term", F.col("n_occurrences").alias("count"))
    sums = held.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = _labelled(docs, text_col, lang_col, source_col).select("lang", "source").distinct()
    groups = groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.nullif(F.col("v"), F.lit(0)).alias("v"), "n_lang")
    groups = stored(groups, "groups")
    held = stored(held.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n_lang", "v", _share(F.col("count"), F.col("n"), F.col("v")).alias("p")), "term-shares")
    pairs = _pairs(held, groups)
    more = held.join(kept, ["lang", "term"]).select(
        "lang", "source", F.col("term").alias("item"), (F.col("p") - _share(F.col("count"), F.col("n_lang"), F.col("v"))).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = pairs.withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(order))
    more = more.where("value > 0").withColumn("part", F.lit("term")).withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= top)
    return pairs.select(*columns).unionByName(more.select(*columns))
