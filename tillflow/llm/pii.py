"""Personal data by patterns, and terms that give it away, with DataFrame functions only.

Patterns find the protected entities (e-mail and network addresses, card and phone
numbers). A term discloses an entity as far as knowing the term tells which entity it
is: the pointwise mutual information of both, counted by documents over the corpus, against
the information of the entity itself. Terms that come near the entity's full information
are generalised or removed in documents that hold the entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.llm.words import text_or_empty
from tillflow.session import stored

#: Fixed patterns of the kinds, in order. Each starts where a run of its first characters
#: starts, or where the match before ended, and gives nothing back: the same matches as
#: without, but no second look at long runs.
START = r"(?:\G|(?<![{0}]))"
PATTERNS = {
    "email": START.format("A-Za-z0-9._%+-") + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": START.format("0-9") + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)
#: A character that every match of the kind holds, to pass over most texts at once.
HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
TERM_KIND = "term"
PART = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"  # a number up to 255
BLOCK = 32  # matches whose starts are added up at once; appending copies half a block for each


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Does the sum of the digits, every second from the right doubled, end in 0?"""
    size = F.length(digits)
    values = F.transform(
        F.sequence(F.lit(1), size),
        lambda k: F.when(
            (size - k) % 2 == 1,
            F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                         F.substr(digits, k, F.lit(1)).cast("int") + 1),
        ).otherwise(F.substr(digits, k, F.lit(1)).cast("int")),
    )
    return F.aggregate(values, F.lit(0), lambda s, v: s + v) % 10 == 0


def passes(kind: str, match: Column) -> Column:
    """Is a match of the pattern one of the kind?"""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.rlike(match, F.lit(rf"^{PART}(\.{PART}){{3}}$"))
    digits = _digits(match)
    size = F.length(digits)
    if kind == "card":
        return F.when(size.between(12, 19), _luhn(digits)).otherwise(False)
    return size.between(9, 15)


def located(rows: DataFrame, text: str, pattern: str, name: str, hint: str = "") -> DataFrame:
    """Adds the matches of a pattern as ``name``: array of (start, end, value), code points, end
    exclusive. What lies between two matches gives where the next begins.

    Starts are added up in blocks of matches, so that a text of many takes time in proportion.
    Lambdas refer to finished columns only, each used twice, which the optimizer leaves apart:
    folded into a lambda, the text would be cut anew for every match.
    """
    hinted = F.contains(F.col(text), F.lit(hint)) if hint else F.lit(True)
    matches = F.regexp_extract_all(F.col(text), F.lit(pattern), 0)
    gaps = F.transform(F.split(F.col(text), pattern, -1), F.length)
    pairs = F.when(hinted, F.zip_with(gaps, matches, lambda gap, value: F.struct(
        gap.alias("gap"), value.alias("value"))))
    found = F.filter("__pairs", lambda p: p["value"].isNotNull())
    count = F.floor((F.size("__found") - 1) / BLOCK).cast("int")
    blocks = F.when(F.size("__found") > 0, F.transform(
        F.sequence(F.lit(0), count), lambda b: F.slice("__found", b * BLOCK + 1, BLOCK)))

    def length(pair: Column) -> Column:
        return pair["gap"] + F.length(pair["value"])
    none = F.array().cast("array<int>")
    starts = F.aggregate(
        "__blocks", F.struct(F.lit(0).alias("at"), none.alias("starts")),
        lambda s, block: F.struct(
            F.aggregate(block, s["at"], lambda at, p: at + length(p)).alias("at"),
            F.concat(s["starts"], F.array(s["at"])).alias("starts")))["starts"]
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def spans(block: Column, at: Column) -> Column:
        return F.aggregate(
            block, F.struct(at.alias("at"), empty.alias("spans")),
            lambda s, p: F.struct(
                (s["at"] + length(p)).alias("at"),
                F.concat(s["spans"], F.array(F.struct(
                    (s["at"] + p["gap"]).alias("start"), (s["at"] + length(p)).alias("end"),
                    p["value"].alias("value")))).alias("spans")))["spans"]
    return (
        rows.withColumn("__pairs", pairs).withColumn("__found", found).withColumn("__blocks", blocks)
        .withColumn("__starts", starts)
        .withColumn(name, F.coalesce(F.flatten(F.zip_with("__blocks", "__starts", spans)), empty))
        .drop("__pairs", "__found", "__blocks", "__starts")
    )


def found(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, base: the spans of all kinds by start, then by kind as listed."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    for kind in KINDS:
        rows = located(rows, "text", PATTERNS[kind], kind, HINTS[kind])
    def spans_of(rank: int, kind: str) -> Column:
        return F.transform(
            F.filter(kind, lambda s: passes(kind, s["value"])),
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"),
                F.lit(kind).alias("kind"), s["value"].alias("value")))
    passing = [spans_of(rank, kind) for rank, kind in enumerate(KINDS)]
    return rows.withColumn("base", F.sort_array(F.concat(*passing))).drop(*KINDS)


# --- terms that disclose an entity ------------------------------------------------

TOKEN = r"[\p{L}\p{N}]+"
#: Documents in which a term is taken to have been seen besides, at the entity's rate over the
#: corpus: what few documents show counts the more, the rarer the entity is by itself.
PRIOR = 1.5


def tokens(text: Column) -> Column:
    """The distinct runs of letters and digits of a text, as they are written."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(TOKEN), 0))


def lowered(tokens: Column) -> Column:
    return F.array_distinct(F.transform(tokens, F.lower))


def each(rows: DataFrame, items: Column, name: str, *others: str) -> DataFrame:
    """A row for each item of a list, beside ``others``. From a plain explode the optimizer infers a
    filter on the list's size and moves it below, which makes the list a second time and folds what
    it is made of into lambdas; the outer one has no such filter."""
    return rows.select(*others, F.explode_outer(items).alias(name)).where(F.col(name).isNotNull())


def most_documents(n: Column, documents: int, prior: float, least: float) -> Column:
    """The number of documents up to which a term can disclose an entity of ``n`` documents: if it
    stood with the entity wherever the entity stands, its share would just reach ``least``."""
    rate = n / float(documents)
    return F.when(rate < 1, (n + prior * rate) / F.pow(rate, F.lit(1 - least)) - prior).otherwise(-1.0)


def share_of(both: Column, entity_n: Column, term_n: Column, documents: int, prior: float) -> Column:
    """PMI(entity, term) / information of the entity, near 1 if the term stands nowhere but with the
    entity. The entity's probability given the term is smoothed by ``prior`` documents at its rate
    over the corpus, so pairs of few documents count for less."""
    rate = entity_n / float(documents)
    given = (both + prior * rate) / (term_n + prior)
    return F.when(rate < 1, F.log(given / rate) / -F.log(rate)).otherwise(0.0)


def distinct_documents(rows: DataFrame) -> DataFrame:
    """key and text of ``rows`` (key, text), each key once. Only keys that repeat are shuffled with
    their texts."""
    repeated = stored(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "pii-repeated")
    once = rows.join(repeated, "key", "left_anti")
    return once.unionByName(rows.join(repeated, "key", "left_semi").dropDuplicates(["key"]))


def entity_classes(entities: DataFrame, documents: int, prior: float, least: float) -> DataFrame:
    """(key, cls, n, most) from (key, entity): entities that stand in the very same documents tell
    the same about every term and are one class, so that a long list of addresses is a few.
    A class is named by the number and two sums of hashes over its documents."""
    def summed(seed: int) -> Column:
        return F.sum(F.xxhash64("key", F.lit(seed)).cast("decimal(20,0)")).cast("string")
    known = entities.groupBy("entity").agg(
        F.count("*").alias("n"), F.concat_ws(":", F.count("*").cast("string"), summed(1), summed(2)).alias("cls"))
    return entities.join(known, "entity").select(
        "key", "cls", "n", most_documents(F.col("n"), documents, prior, least).alias("most")).distinct()


def placed_terms(held: DataFrame, marks: DataFrame) -> DataFrame:
    """(key, terms: start, end, term, action) from held texts (key, text, base) and marks (key, term,
    action): every place of a marked term, unless it overlaps a base span there."""
    texts = held.join(marks.select("key").distinct(), "key", "left_semi")
    words = each(located(texts.select("key", "text"), "text", TOKEN, "words"), F.col("words"), "w", "key").select(
        "key", F.col("w.start").alias("start"), F.col("w.end").alias("end"), F.lower("w.value").alias("term"))
    hits = words.join(marks, ["key", "term"])
    base = texts.select("key", F.explode("base").alias("s")).select(
        "key", F.col("s.start").alias("start"), F.col("s.end").alias("end"),
        F.lit(None).cast("string").alias("term"), F.lit(None).cast("string").alias("action"))
    # Base spans sort before words that start with them. Both windows grow row by row: one that
    # shrinks would be added up anew for every row.
    grown = W.unboundedPreceding, W.currentRow
    upward = W.partitionBy("key").orderBy("start", F.asc_nulls_first("term")).rowsBetween(*grown)
    downward = W.partitionBy("key").orderBy(F.desc("start"), "term").rowsBetween(*grown)
    of_base = F.col("term").isNull()
    reach = F.max(F.when(of_base, F.col("end"))).over(upward)
    next_base = F.min(F.when(of_base, F.col("start"))).over(downward)
    free = hits.select(*base.columns).unionByName(base).withColumns({"reach": reach, "next_base": next_base}).where(
        "term is not null and coalesce(reach, 0) <= start and coalesce(next_base, end) >= end")
    return free.groupBy("key").agg(F.sort_array(F.collect_list(
        F.struct("start", "end", "term", "action"))).alias("terms"))


def sanitise(docs: DataFrame, prior: float = PRIOR, generalise_at: float = 0.7, remove_at: float = 0.9,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, base (spans of personal data), terms (spans of disclosing
    terms: start, end, term, action), both in code points, end exclusive.

    A term is looked for wherever it stands in a document that holds the entity. Documents
    without personal data have no spans. A null or empty text has none either.
    Rows that repeat a doc_id and a text get the same answer each and count once in all
    statistics; other columns are ignored; an empty table gives an empty one. Ties of spans
    are ordered by kind and end.

    Pairs of an entity and a term are made only where the term is rare enough to reach the
    least share at best, which `most_documents` gives exactly: none that counts is left out.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    key = F.sha2(F.encode(F.concat_ws(":", name, "text"), "utf-8"), 256)
    marked = stored(found(docs, doc_id, text).select(
        "doc_id", key.alias("key"), "base", F.when(F.size("base") > 0, F.col("text")).alias("text")), "pii")
    whole = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text")).select(
        key.alias("key"), "text")
    documents = marked.select("key").distinct().count()
    held = stored(marked.where(F.size("base") > 0).select("key", "base", "text").dropDuplicates(["key"]), "pii-held")
    entity = F.transform("base", lambda s: F.concat_ws(":", s["kind"], F.lower(s["value"])))
    entities = held.select("key", F.explode(F.array_distinct(entity)).alias("entity"))
    classes = stored(entity_classes(entities, max(documents, 1), prior, generalise_at), "pii-classes")
    most = classes.agg(F.max("most")).first()[0]
    words = lowered(tokens(F.col("text")))
    terms = each(distinct_documents(whole), words, "term").groupBy("term").agg(
        F.count("*").alias("term_n")).where(F.col("term_n") <= F.lit(-1.0 if most is None else most))
    rare = each(held, words, "term", "key").join(terms, "term")
    of_key = classes.groupBy("key").agg(F.collect_list(F.struct("cls", "n", "most")).alias("classes"))
    met = stored(rare.join(of_key, "key").select("key", "term", "term_n", F.explode(F.filter(
        "classes", lambda c: c["most"] >= F.col("term_n"))).alias("c")).select(
        "key", "term", "term_n", "c.cls", "c.n"), "pii-met")
    share = share_of(F.col("both"), F.col("n"), F.col("term_n"), max(documents, 1), prior)
    pairs = met.groupBy("cls", "term", "n", "term_n").agg(F.count("*").alias("both")).withColumn(
        "share", share).where(F.col("share") >= generalise_at).select(
        "cls", "term", F.when(F.col("share") >= remove_at, "remove").otherwise("generalise").alias("action"))
    marks = stored(met.select("key", "cls", "term").join(pairs, ["cls", "term"]).groupBy("key", "term").agg(
        F.max("action").alias("action")), "pii-marks")
    placed = placed_terms(held, marks).withColumnRenamed("key", "of_key")
    none = F.array().cast("array<struct<start:int,end:int,term:string,action:string>>")
    bare = marked.where(F.size("base") == 0).select("doc_id", "base", none.alias("terms"))
    answered = marked.where(F.size("base") > 0).join(placed, F.col("key") == F.col("of_key"), "left").select(
        "doc_id", "base", F.coalesce("terms", none).alias("terms"))
    return answered.unionByName(bare)


def redacted(text: Column, spans: Column) -> Column:
    """A text with its spans (start, end, mark), sorted and apart, each replaced by its mark."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))
    state = F.aggregate(spans, begin, lambda s, p: F.struct(
        p["end"].alias("at"),
        F.concat(s["done"], F.substr(text, s["at"] + 1, p["start"] - s["at"]), p["mark"]).alias("done")))
    return F.concat(state["done"], F.substr(text, state["at"] + 1, F.length(text)))


def all_spans(base: Column, terms: Column) -> Column:
    """kind:start:end of base spans and terms, by start, then in the order of kinds."""
    ranked = F.concat(
        F.transform(base, lambda s: F.struct(
            s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))),
        F.transform(terms, lambda s: F.struct(
            s["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), s["end"].alias("end"),
            F.lit(TERM_KIND).alias("kind"))))
    return spelled(F.sort_array(ranked))


def spelled(spans: Column) -> Column:
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
