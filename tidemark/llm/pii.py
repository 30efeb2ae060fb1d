"""Personal data: patterns find it, and corpus co-occurrence finds the terms that reveal it.

The base kinds (email, ip, card, phone) are found by patterns and checks.  What they find are the
protected entities.  A term that stands near an entity says how much about it?  With p(e) the share of
all word places that lie near e, and p(e|t) the share of t's places in the corpus that do, the pointwise
mutual information log2 p(e|t) / p(e), taken as a part of the entity's information -log2 p(e), is the
disclosure: 1 when t occurs nowhere else.  Terms above the threshold, whose places near the entity are
no chance, are marked in the documents that hold the entity, and generalised or, where they reveal it
almost surely, removed.  All of it is DataFrame functions.

Chance: if t's places fell anywhere, that a share p(e|t) or more of n of them lies near e has a
probability of at most exp(-n D), D the divergence of p(e|t) from p(e) (Chernoff's bound of the binomial
tail; p(e) itself for one place near e of one).  Copies of a context are no further evidence, so n counts
t's places as if each different context were one.  In a large corpus one context is enough.

The patterns are written so that Java's matcher needs no recursion and no second pass over a run of
characters: a loop over one character class, entered at the start of a run only.  They match what the
plain ones in ``KINDS`` match.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import stored

#: In the order of the spans of one start.
KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9-][A-Za-z0-9.-]*?"
          r"(?![A-Za-z0-9-]|\.[A-Za-z0-9-])")
_IP = r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
#: Digits and separators; cut at doubled separators, its parts are the matches of the card's pattern.
_DIGITS = r"[0-9][0-9\x20-]{10,}[0-9]"
_TERM = r"[\p{L}\p{N}]+"

#: Characters around an entity whose whole words are its context, and terms of fewer characters pass.
REACH, SHORTEST = 60, 3
#: Part of the entity's information that a term may disclose, the part of its places near the entity
#: from which it is removed, and the probability below which these are no chance.
DISCLOSED, CERTAIN, CHANCE = 0.8, 0.9, 0.001

_SPAN = "array<struct<start: int, kind: int, end: int>>"


def _places(text: Column, pattern: Column) -> Column:
    """(start, end, found) of every match of ``pattern``, from what is matched and what lies between."""
    found, between = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, pattern, -1)
    none = F.array().cast("array<struct<start: int, end: int, found: string>>")

    def add(so_far, x):
        start = so_far["at"] + F.length(x["gap"])
        end = start + F.length(x["found"])
        one = F.struct(start.alias("start"), end.alias("end"), x["found"].alias("found"))
        return F.struct(end.alias("at"), F.concat(so_far["all"], F.array(one)).alias("all"))

    # the last gap has no match after it
    each = F.arrays_zip(F.slice(between, 1, F.greatest(F.size(between) - 1, F.lit(0))).alias("gap"), found.alias("found"))
    named = F.transform(each, lambda x: F.struct(x["gap"].alias("gap"), x["found"].alias("found")))
    return F.aggregate(named, F.struct(F.lit(0).alias("at"), none.alias("all")), add, lambda s: s["all"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a text of digits passes: every second digit from the right doubled, the sum ends in 0."""
    n = F.length(digits)

    def add(total, k):
        digit = F.substring(digits, n - k, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(k % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _found(text: Column) -> list[Column]:
    """Arrays of (start, end, found) of each of KINDS."""
    none = F.array().cast("array<struct<start: int, end: int, found: string>>")

    def where_it_may(guard: Column, places: Column) -> Column:
        return F.when(guard, places).otherwise(none)

    email = where_it_may(F.contains(text, F.lit("@")), _places(text, F.lit(_EMAIL)))
    ip = where_it_may(text.rlike(r"[0-9]\.[0-9]"), _places(text, F.lit(_IP)))
    ip = F.filter(ip, lambda x: F.forall(F.split(x["found"], r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False))))
    runs = where_it_may(text.rlike(_DIGITS), _places(text, F.lit(_DIGITS)))
    parts = F.flatten(F.transform(runs, lambda r: F.transform(
        # within a run, what lies between doubled separators
        _places(r["found"], F.lit(r"(?:\G|(?<=[\x20-]{2}))[0-9](?:[0-9]|[\x20-](?=[0-9])){10,40}+(?![0-9]|[\x20-][0-9])")),
        lambda p: F.struct((r["start"] + p["start"]).alias("start"), (r["start"] + p["end"]).alias("end"), p["found"].alias("found")),
    )))
    card = F.filter(parts, lambda x: F.length(_digits(x["found"])).between(12, 19) & _luhn(_digits(x["found"])))
    phone = where_it_may(F.contains(text, F.lit("+")), _places(text, F.lit(KINDS["phone"])))
    phone = F.filter(phone, lambda x: F.length(_digits(x["found"])).between(9, 15))
    return [email, ip, card, phone]


def _listed(spans: str, names: list[str]) -> Column:
    """``kind:start:end`` of spans in order, comma-joined."""
    kinds = F.array(*(F.lit(n) for n in names))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"])), ",")


def _numbered(places: str, kind: int) -> Column:
    return F.transform(places, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row, email, ip, card, phone, base): what the patterns find; null texts read as empty.

    ``row`` holds the row's other columns, whatever their names, and whether there is a text.
    """
    rest = [F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate(docs.columns) if c != "text"]
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.struct(*rest, F.col("text").isNull().alias("missing")).alias("row"),
    )
    found = docs.select("doc_id", "text", "row", *(c.alias(k) for c, k in zip(_found(F.col("text")), KINDS)))
    each = [_numbered(k, n) for n, k in enumerate(KINDS)]
    return found.withColumn("base", F.array_sort(F.concat(*each)).cast(_SPAN))


def _named(kind: str) -> Column:
    """Finds of a kind as (entity, start, end); numbers are known by their digits."""

    def name(found):
        same = _digits(found) if kind in ("card", "phone") else F.lower(found)
        return F.concat_ws(":", F.lit(kind), same)

    return F.transform(kind, lambda s: F.struct(name(s["found"]).alias("entity"), s["start"].alias("start"), s["end"].alias("end")))


def _entities(found: DataFrame) -> DataFrame:
    """(doc_id, entity, left, right): every find as a protected entity, with the text around it."""
    each = [_named(k) for k in KINDS]
    rows = found.where(F.size("base") > 0).select("doc_id", "text", F.explode(F.concat(*each)).alias("e"))
    start = F.greatest(F.col("e.start") - REACH, F.lit(0))
    rows = rows.select(
        "doc_id", "e.entity",
        F.substring("text", start + 1, F.col("e.start") - start).alias("left"),
        F.substring("text", F.col("e.end") + 1, F.lit(REACH)).alias("right"),
    )
    # a word at the end of a full window may have been cut
    whole = lambda side, at: F.when(F.length(side) == REACH, F.regexp_replace(side, at, "")).otherwise(F.col(side))
    return rows.select("doc_id", "entity", whole("left", r"^[\p{L}\p{N}]+").alias("left"), whole("right", r"[\p{L}\p{N}]+$").alias("right"))


def _near(entities: DataFrame) -> DataFrame:
    """(entity, context, term): the terms around every find."""
    context = F.lower(F.concat_ws(" ", "left", "right"))
    rows = entities.select("entity", F.xxhash64(context).alias("context"), F.explode(F.regexp_extract_all(context, F.lit(_TERM), F.lit(0))).alias("term"))
    return rows.where(F.length("term") >= SHORTEST)


def disclosing(docs: DataFrame, entities: DataFrame) -> DataFrame:
    """(entity, term, certain): terms of the whole corpus that reveal an entity beyond the threshold."""
    near = _near(entities)
    once = near.groupBy("entity", "term", "context").agg(F.count(F.lit(1)).alias("n"))
    pairs = once.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("contexts"), F.sum("n").alias("together"))
    pairs = stored(pairs, "pairs")
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col("text").cast("string")), F.lit(_TERM), F.lit(0))).alias("term"))
    counts = stored(words.where(F.length("term") >= SHORTEST).groupBy("term").agg(F.count(F.lit(1)).alias("all")), "terms")
    total = counts.agg(F.sum("all")).first()[0] or 0
    places = near.groupBy("entity").agg(F.count(F.lit(1)).alias("places"))
    judged = pairs.join(places, "entity").join(counts, "term")
    share = F.least(F.col("together") / F.greatest("all", "together"), F.lit(1.0))
    judged = judged.withColumn("share", share).withColumn("p", F.col("places") / F.greatest(F.lit(total), F.col("places") + 1))
    rest = F.when(F.col("share") < 1, (1 - F.col("share")) * F.log((1 - F.col("share")) / (1 - F.col("p")))).otherwise(0.0)
    divergence = F.col("share") * F.log(F.col("share") / F.col("p")) + rest
    evidence = F.greatest("all", "together") * F.col("contexts") / F.col("together")
    judged = judged.withColumn("disclosed", 1 - F.log2("share") / F.log2("p"))
    judged = judged.where((F.col("disclosed") >= DISCLOSED) & (evidence * divergence >= -math.log(CHANCE)))
    return judged.select("entity", "term", (F.col("share") >= CERTAIN).alias("certain"))


def marked(docs: DataFrame) -> DataFrame:
    """``base_spans`` of every row with ``certain`` (terms to remove) and ``spans``, which adds those of terms."""
    found = base_spans(docs)
    entities = stored(_entities(found), "entities")
    terms = stored(disclosing(docs, entities), "disclosing")
    # the words of the documents that hold an entity meet its terms: an entity of many documents has many terms
    holders = entities.where("doc_id is not null").select("doc_id", "entity").distinct()
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col("text")), F.lit(_TERM), F.lit(0)))
    held = found.where("size(base) > 0 and doc_id is not null").select("doc_id", F.explode(words).alias("term")).distinct()
    held = held.join(terms.select("term").distinct(), "term", "left_semi")
    known = held.join(holders, "doc_id").join(terms, ["entity", "term"])
    terms = known.groupBy("doc_id").agg(
        F.array_sort(F.collect_set("term")).alias("terms"),
        F.collect_set(F.when(F.col("certain"), F.col("term"))).alias("certain"),
    )
    rows = found.join(stored(terms, "marks"), "doc_id", "left")
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join("terms", "|"), F.lit(r")(?![\p{L}\p{N}])"))
    own = F.when(F.col("terms").isNotNull(), _places(F.col("text"), pattern))
    rows = rows.withColumn("own", own)
    rows = rows.withColumn("own", _numbered("own", len(KINDS)))
    apart = F.filter("own", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return rows.withColumn("spans", F.when(F.col("own").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", apart)).cast(_SPAN)))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of ``docs`` (doc_id, text, ...).

    Spans are in code points, ends exclusive.  Null or empty text has none.  A null doc_id gets base
    spans only; rows that repeat a doc_id share its disclosing terms.  Overlapping kinds are all listed.
    Other columns are ignored; an empty table gives no rows.
    """
    names = [*KINDS, "term"]
    return marked(docs.select("doc_id", "text")).select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_listed("base", names), 256).alias("base_sha256"), _listed("spans", names).alias("spans"),
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...), all columns, with every span of the text replaced.

    What the patterns find becomes its kind in brackets, a disclosing term ``[TERM]``, or nothing where
    it reveals the entity almost surely.  Of overlapping spans the first is replaced, and the rest of
    the others goes with it.  Texts without spans, null ones too, stay as they are.
    """
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in [*KINDS, "term"]))

    def add(so_far, s):
        here = F.substring("text", s["start"] + 1, s["end"] - s["start"])
        removed = (s["kind"] == len(KINDS)) & F.coalesce(F.array_contains("certain", F.lower(here)), F.lit(False))
        new = F.concat(
            so_far["out"], F.substring("text", so_far["at"] + 1, s["start"] - so_far["at"]),
            F.when(removed, F.lit("")).otherwise(names[s["kind"]]),
        )
        fresh = s["start"] >= so_far["at"]
        return F.struct(F.greatest(so_far["at"], s["end"]).alias("at"), F.when(fresh, new).otherwise(so_far["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda s: F.concat(s["out"], F.substring("text", s["at"] + 1, F.length("text")))
    clean = F.when(F.size("spans") == 0, F.col("text")).otherwise(F.aggregate("spans", start, add, rest))
    clean = F.when(F.col("row.missing"), F.lit(None)).otherwise(clean)
    return marked(docs).select(*(
        clean.alias(c) if c == "text" else F.col(f"row.c{n}").alias(c) for n, c in enumerate(docs.columns)
    ))
