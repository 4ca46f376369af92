"""Personal data: patterns find protected entities, corpus co-occurrence finds the terms that would reveal them.

All of it is DataFrame expressions. E-mail addresses, IP addresses, card numbers and phone numbers are the entities; they
are found by the contract's patterns, leftmost and without overlap per kind. (Where the pattern starts with a run of one
class, the expression here starts a match only where such a run does, or where the last match ended. That finds the same
matches in linear time. The one for cards asks for the maximal run of 16 to 19 digits at once, for the same reason.)

Information-theoretic sanitisation: the context of an entity is the text up to `REACH` characters on both sides. A term is
a word of at least `MIN_TERM` letters or digits. Over the whole corpus, with windows of a context's length as the unit,
p(t) comes from all occurrences of the term in distinct texts, whose lengths make the corpus, p(e) from the distinct contexts of the entity and p(e, t) from those that
hold the term; copies of a context count once, and so do the contexts within one text. A term reveals the share PMI(e, t) / IC(e) of the entity's information IC(e) = -log2 p(e),
where PMI(e, t) = log2(p(e, t) / (p(e) p(t))). Pairs with at least `MIN_SUPPORT` distinct contexts count. A term that
reveals `GENERALISE` or more is replaced by its class wherever it stands in a text that holds the entity, one that reveals
`REMOVE` or more is cut. In writing without spaces a run of letters is one term; a name inside a longer run is none.
Entities themselves are always replaced by their kind. A context holds a bounded number of terms, so pairs grow with the
number of entities. Terms are counted over distinct texts, which are shuffled once; a task sends one sum for each term.

Nulls and odd rows: a null text is an empty one and has no spans. Repeated texts have equal spans. Extra columns are
carried in a struct.
"""

from functools import partial

from pyspark.sql import functions as F

from rateflow.llm.common import column, lookup, stored, whole_row

#: The kinds in order and their patterns.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_NEEDED = {"email": "@", "ip": ".", "phone": "+"}
_PART = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})?"
REACH = 120
MIN_TERM = 2
MIN_SUPPORT = 3
GENERALISE, REMOVE = 0.6, 0.8
_TERM = rf"[\p{{L}}\p{{N}}]{{{MIN_TERM},}}"
_SPANS = "array<struct<kind:string,start:int,stop:int,value:string>>"


def _is_card(value):
    digits = F.split(F.reverse(F.regexp_replace(value, "[^0-9]", "")), "")
    digits = F.transform(F.filter(digits, lambda c: c != ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(digits, F.lit(0), lambda s, x: s + x) % 10 == 0


def _is_valid(kind, span):
    value = span["value"]
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return _is_card(value)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(8, 15)
    return F.lit(True)


def _located(values, gaps, kind):
    """Spans in code points, from the matches and the lengths of what lies before, between and after them."""
    def step(state, m):
        start = state["at"] + m["gap"]
        stop = start + F.length(m["value"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), stop.alias("stop"), m["value"].alias("value"))
        return F.when(m["value"].isNull(), state).otherwise(
            F.struct(stop.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans")))

    none = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))
    pairs = F.arrays_zip(values.alias("value"), gaps.alias("gap"))
    return F.aggregate(pairs, none, step, lambda s: s["spans"])


def base_spans(df, text="text", into="base"):
    """df with the valid matches of all kinds in `into`, by kind and start; `text` is a column that is never null."""
    empty = F.array().cast("array<string>")
    found = {}
    for kind in KINDS:
        matches = F.regexp_extract_all(F.col(text), F.lit(PATTERNS[kind]), F.lit(0))
        found[kind] = F.when(F.contains(F.col(text), F.lit(_NEEDED[kind])), matches).otherwise(empty) if kind in _NEEDED else matches
    df = df.withColumn("_found", F.struct(*[c.alias(k) for k, c in found.items()]))
    parts = []
    for kind in KINDS:
        values = F.col(f"_found.{kind}")
        gaps = F.transform(F.split(F.col(text), PATTERNS[kind], -1), F.length)
        spans = F.filter(_located(values, gaps, kind), partial(_is_valid, kind))
        parts.append(F.when(F.size(values) > 0, spans).otherwise(F.array().cast(_SPANS)))
    return df.withColumn(into, F.concat(*parts)).drop("_found")


def contexts(marked):
    """(digest, entity, start, stop, begin, before, after): the distinct surroundings of all entities of marked(text, base).

    start and stop are the entity's place, before and after the texts on both sides, begin is where before starts.
    """
    rows = marked.where(F.size("base") > 0).select(
        F.sha2("text", 256).alias("digest"), "text", F.explode("base").alias("span"))
    begin = F.greatest(F.col("span.start") - REACH, F.lit(0))
    return rows.select(
        "digest", F.concat_ws(":", "span.kind", "span.value").alias("entity"), F.col("span.start").alias("start"),
        F.col("span.stop").alias("stop"), begin.alias("begin"),
        F.substring(F.col("text"), begin + 1, F.col("span.start") - begin).alias("before"),
        F.substring(F.col("text"), F.col("span.stop") + 1, F.lit(REACH)).alias("after")).distinct()


def _terms(text, begin):
    """Terms of a short text with their places, which count from `begin`."""
    values = F.regexp_extract_all(text, F.lit(_TERM), F.lit(0))
    gaps = F.transform(F.split(text, _TERM, -1), F.length)
    return F.transform(_located(values, gaps, "term"), lambda s: F.struct(
        F.lower(s["value"]).alias("term"), (begin + s["start"]).alias("start"), (begin + s["stop"]).alias("stop")))


def term_places(found):
    """(digest, entity, shown, term, start, stop): each term around each entity; `shown` names the context."""
    shown = F.xxhash64("before", "after")
    both = F.concat(_terms(F.col("before"), F.col("begin")), _terms(F.col("after"), F.col("stop")))
    return found.select("digest", "entity", shown.alias("shown"), F.explode(both).alias("t")).select(
        "digest", "entity", "shown", "t.*")


def _seen(shown):
    """Distinct contexts, but no more than distinct texts: neither copies nor repeats within a text add to it."""
    return F.least(F.count_distinct(shown), F.count_distinct("digest"))


def revealing_terms(docs, places, found, text_col="text", min_support=MIN_SUPPORT, at_least=GENERALISE):
    """(entity, term, share) for all terms that reveal a share of at least `at_least` of an entity."""
    text = F.coalesce(column(text_col), F.lit(""))
    pairs = stored(
        places.groupBy("entity", "term").agg(_seen(F.col("shown")).alias("n_both"))
        .where(F.col("n_both") >= min_support), "revealing-pairs")
    known = found.groupBy("entity").agg(_seen(F.xxhash64("before", "after")).alias("n_entity"))
    sizes = docs.groupBy(F.sha2(text, 256).alias("digest")).agg(F.max(F.length(text)).alias("n_chars"))
    n_chars = sizes.agg(F.sum("n_chars")).first()[0] or 0
    # Distinct texts, copies of a task going first; then a task sends one row for each of its terms.
    texts = docs.select(text.alias("text")).distinct()
    words = texts.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(_TERM), F.lit(0))).alias("term"))
    n_term = words.groupBy("term").agg(F.count("*").alias("n_term"))
    rated = pairs.join(known, "entity").join(n_term, "term")
    total = F.greatest(F.lit(n_chars / (2 * REACH)), F.col("n_entity") + F.lit(1.0))
    rated = rated.withColumn("share", F.log2(total * F.col("n_both") / (F.col("n_entity") * F.col("n_term"))) / F.log2(
        total / F.col("n_entity")))
    return rated.where(F.col("share") >= at_least).select("entity", "term", "share")


def _joined(spans):
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])))


def find_personal_data(docs, text_col="text", min_support=MIN_SUPPORT, generalise=GENERALISE, remove=REMOVE):
    """row (all columns of docs), base, terms: spans (kind, start, stop, value) in code points, end exclusive.

    The value of a term span is what replaces it: a class, or nothing.
    """
    rows = docs.select(whole_row(docs), F.coalesce(column(text_col), F.lit("")).alias("text"))
    marked = base_spans(rows)
    found = stored(contexts(marked), "entity-contexts")
    places = stored(term_places(found), "entity-terms")
    bad = stored(revealing_terms(docs, places, found, text_col, min_support, generalise), "revealing-terms")
    number = F.col("term").rlike(r"^\p{N}+$")
    shown = F.when(F.col("share") >= remove, "").when(number, "[NUMBER]").otherwise("[TERM]")
    holders = stored(found.select("digest", "entity").distinct(), "entity-texts")
    by_entity = bad.groupBy("entity").agg(F.collect_list(F.struct("term", shown.alias("value"))).alias("revealed"))
    by_entity = stored(by_entity.join(holders.groupBy("entity").agg(F.count("*").alias("n")), "entity"), "revealing-entities")
    held = lookup(holders, by_entity, "entity", "n").where("revealed IS NOT NULL")
    held = held.select("digest", F.explode("revealed").alias("t")).groupBy("digest", "t.term").agg(F.min("t.value").alias("value"))
    held = stored(held.groupBy("digest").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "value"))).alias("revealed")), "revealing-spans")
    # A text without entities meets nothing in `held`; its short hash only spreads such rows, should the join be a shuffle.
    marked = marked.withColumn("digest", F.when(F.size("base") > 0, F.sha2("text", 256)).otherwise(F.xxhash64("text").cast("string")))
    out = marked.join(held, "digest", "left")
    return out.select("row", "text", "base", F.when(F.col("revealed").isNull(), F.array().cast(_SPANS)).otherwise(
        _revealed_spans()).alias("terms"))


def _revealed_spans():
    """All places in `text` of the terms that `revealed` maps to their replacements, outside the entities in `base`."""
    each = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(F.map_keys("revealed"), "|"), F.lit(r")(?![\p{L}\p{N}])"))
    values = F.regexp_extract_all(F.col("text"), each, F.lit(0))
    gaps = F.transform(F.split(F.col("text"), each, -1), F.length)
    spans = F.transform(_located(values, gaps, "term"), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"),
        F.col("revealed")[F.lower(s["value"])].alias("value")))
    apart = lambda s: ~F.exists("base", lambda e: (e["start"] < s["stop"]) & (s["start"] < e["stop"]))
    return F.filter(spans, lambda s: s["value"].isNotNull() & apart(s))


def sanitised(found):
    """row and clean_text: entities replaced by their kind, revealing terms by their class or nothing."""
    kinds = F.transform("base", lambda s: F.struct(
        s["start"].alias("start"), s["stop"].alias("stop"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("value")))
    terms = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("value")))
    none = F.struct(F.lit(0).alias("at"), F.lit("").alias("kept"))

    def step(state, s):
        kept = F.concat(state["kept"], F.substring(F.col("text"), state["at"] + 1, s["start"] - state["at"]), s["value"])
        return F.when(s["start"] < state["at"], F.struct(F.greatest(state["at"], s["stop"]).alias("at"), state["kept"].alias("kept"))
                      ).otherwise(F.struct(s["stop"].alias("at"), kept.alias("kept")))

    clean = F.aggregate(F.array_sort(F.concat(kinds, terms)), none, step, lambda s: F.concat(
        s["kept"], F.substring(F.col("text"), s["at"] + 1, F.lit(2**31 - 1))))
    return found.select("row", F.when(F.size("base") + F.size("terms") == 0, F.col("text")).otherwise(clean).alias("clean_text"))


def digest(found, id_col="doc_id"):
    """doc_id, the number of spans of each kind, base_sha256, spans."""
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return found.select(
        column("row").getField(id_col).alias(id_col), *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "terms")).alias("spans"))
