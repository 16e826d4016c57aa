"""Personal data: fixed patterns, and contextual extraction bootstrapped from what they find.

The fixed patterns find mail addresses, IP addresses, card numbers and phone numbers. Their values are the
seeds. Candidates come in the families of the seeds, whatever their length: address-like tokens and handles,
also with a spelled "at"; dotted or colon-joined number groups; and numbers with blanks, signs and brackets or
tokens with four digits in a row. No fixed span touches them. Every occurrence has lexical patterns: the word
before it, the word behind it (of each the nearest CONTEXT characters), both together, and its form (digits
and letters by class, with the outcome of the card check); an empty context is no pattern. Occurrences make a
graph of patterns and instances within each family, which is scored in thousandths by rounds of grouped sums
until nothing changes: a pattern is as good as the share of its distinct instances that are believed in, an
instance as its best pattern. Scores only grow and are whole numbers, so the rounds end. An unseen identifier is
reported, with the kind of its seeds, where the belief reaches BELIEF through a pattern of at least SUPPORT
distinct seeds, or where its value is a seed elsewhere. Everything is built from SQL functions; only
occurrences travel, texts do not.

Nulls: a null text is empty and has no spans; null ids stay. Rows of the same id and text are one document
and are treated alike. No rows give no rows; other columns pass through `redact`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.llm.shared import fresh, staged, whole_text
from pulsemill.llm.spans import SPAN, count_of, find_spans, listed, masked, no_spans, overlaps
from pulsemill.plans.once import with_columns_once
from pulsemill.plans.skew import skew_join

# The patterns of the base spans, each beginning where a run of its characters begins.
KINDS = ["email", "ip", "card", "phone"]
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Found spans are named after the kind of their seeds.
NAMES = KINDS + [f"found_{kind}" for kind in KINDS]
LABELS = [f"<{kind.upper()}>" for kind in KINDS] * 2
# Candidates by family: addresses, dotted numbers, other numbers.
FAMILIES = [0, 1, 2, 2]
ADDRESS = (
    r"(?<![A-Za-z0-9._%+@-])(?:[A-Za-z0-9._%+-]*+@[A-Za-z0-9_]++(?:[.-][A-Za-z0-9_]++)*+"
    r"|[A-Za-z0-9._%+-]++(?:\x20?(?:\[at\]|\(at\))\x20?|\x20at\x20)[A-Za-z0-9-]++"
    r"(?:(?:\.|\x20?(?:\[dot\]|\(dot\))\x20?|\x20dot\x20)[A-Za-z0-9-]++)++)"
)
DOTTED = (
    r"(?<![A-Za-z0-9._:-])(?:[0-9]++(?:\.[0-9]++){2,}+|[0-9A-Fa-f]{1,4}(?:::?[0-9A-Fa-f]{1,4}){2,}+)(?![A-Za-z0-9_])"
)
NUMBER = (
    r"(?<![A-Za-z0-9._+-])(?:\+?\(?[0-9]++(?:[)./-]{0,2}+(?:\x20(?=\(?[0-9]{2}))?+\(?[0-9]++)*+(?![A-Za-z0-9_+])"
    r"|(?=[A-Za-z0-9._+-]*[0-9]{4})[A-Za-z0-9+][A-Za-z0-9._+-]*+)"
)
CONTEXT = 48
WHOLE = 1000
BELIEF = 800
SUPPORT = 5


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether 16 to 19 digits pass the card check."""
    digits = F.reverse(_digits(value))
    each = F.transform(F.split(digits, ""), lambda d: d.cast("int"))
    doubled = F.transform(each, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2))
    total = F.aggregate(doubled, F.lit(0), lambda t, d: t + d)
    return F.length(digits).between(16, 19) & (total % 10 == 0)


def _is_ip(value: Column) -> Column:
    def small(part: Column) -> Column:
        trimmed = F.regexp_replace(part, "^0+", "")
        return (F.length(trimmed) <= 3) & (F.coalesce(trimmed.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(value, r"\."), small)


def with_base_spans(docs: DataFrame, text: str) -> DataFrame:
    """Add `_text` and `_base`, the spans of the fixed patterns in order of kind and start."""
    read = with_columns_once(docs, {"_text": whole_text(text)})
    found = with_columns_once(
        read,
        {
            "_email": find_spans("_text", EMAIL, 0, lambda v: F.lit(True)),
            "_ip": find_spans("_text", IP, 1, _is_ip),
            "_card": find_spans("_text", CARD, 2, luhn),
            "_phone": find_spans("_text", PHONE, 3, lambda v: F.length(_digits(v)).between(8, 15)),
        },
    )
    return with_columns_once(found, {"_base": F.concat("_email", "_ip", "_card", "_phone")}).drop(
        "_email", "_ip", "_card", "_phone"
    )


def _occurrence(span: Column, seed: int) -> Column:
    """Where an identifier stands, its value without signs, and its lexical patterns."""
    text, start, end = F.col("_text"), span["start"], span["end"]
    before = F.substring(text, F.greatest(start - CONTEXT, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT)))
    behind = F.substring(text, end + 1, F.lit(CONTEXT))
    left = F.lower(F.regexp_extract(before, r"([^\s\"'(<\[:=]+)[\s\"'(<\[:=]*$", 1))
    right = F.lower(F.regexp_extract(behind, r"^[\s\"')>\].,;]*([^\s\"')>\].,;]+)", 1))
    form = F.regexp_replace(F.regexp_replace(span["value"], "[0-9]", "9"), "[A-Za-z]+", "a")
    checked = F.when(luhn(span["value"]), "+").otherwise("-")
    value = F.lower(F.regexp_replace(span["value"], r"[^A-Za-z0-9@.]", ""))
    patterns = F.array_compact(
        F.array(
            F.when(left != "", F.concat(F.lit("before "), left)),
            F.when(right != "", F.concat(F.lit("behind "), right)),
            F.when((left != "") & (right != ""), F.concat(F.lit("around "), left, F.lit(" "), right)),
            F.concat(F.lit("form "), form, checked),
        )
    )
    kind = span["kind"] if seed else F.lit(None).cast("int")
    family = F.element_at(F.array(*map(F.lit, FAMILIES)), span["kind"] + 1) if seed else span["kind"]
    return F.struct(
        start.alias("start"),
        end.alias("end"),
        kind.alias("kind"),
        family.alias("family"),
        value.alias("value"),
        patterns.alias("patterns"),
    )


def occurrences(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, k1, k2, base spans, occurrences of seeds and candidates) of every document."""
    based = with_base_spans(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("_read")), "_read")
    based = with_columns_once(
        based,
        {
            "_addresses": find_spans("_text", ADDRESS, 0, lambda v: F.lit(True)),
            "_dotted": find_spans("_text", DOTTED, 1, lambda v: F.lit(True)),
            "_numbers": find_spans(
                "_text", NUMBER, 2, lambda v: F.rlike(v, F.lit("[0-9]{4}")) | (F.length(_digits(v)) > 6)
            ),
        },
    )
    based = with_columns_once(based, {"_tokens": F.concat("_addresses", "_dotted", "_numbers")})
    free = F.filter("_tokens", lambda s: ~overlaps(s, F.col("_base")))
    seen = F.concat(F.transform("_base", lambda s: _occurrence(s, 1)), F.transform(free, lambda s: _occurrence(s, 0)))
    busy = (F.size("_base") > 0) | (F.size("_tokens") > 0)
    empty = F.array().cast(
        "array<struct<start:int,end:int,kind:int,family:int,value:string,patterns:array<string>>>"
    )
    return based.select(
        "id",
        F.xxhash64("_text").alias("k1"),
        F.xxhash64(F.lit(1), "_text").alias("k2"),
        F.col("_base").alias("base"),
        F.when(busy, seen).otherwise(empty).alias("seen"),
    )


def discover(found: DataFrame, belief: int = BELIEF, support: int = SUPPORT) -> DataFrame:
    """(k1, k2, start, end, kind): candidates that the pattern-instance graph believes in.

    `found` has the columns of `occurrences`. Equal texts count once, so copies are no evidence.
    """
    rows = found.filter(F.size("seen") > 0).dropDuplicates(["k1", "k2"])
    rows = rows.select("k1", "k2", F.inline("seen"))
    instance, pattern = ["family", "value"], ["family", "pattern"]
    # What an instance is: the kind of its seeds, or null.
    edges = staged(
        rows.select(*instance, "kind", F.explode("patterns").alias("pattern"))
        .groupBy(*pattern, "value")
        .agg(F.max("kind").alias("kind")),
        "pii-edges",
    )
    known = edges.filter(F.col("kind").isNotNull()).groupBy(*instance).agg(F.max("kind").alias("kind"))
    # A score per instance and kind; seeds are certain.
    certain = staged(known.withColumn("score", F.lit(WHOLE).cast("long")), "pii-seeds")
    degree = edges.groupBy(*pattern).agg(F.count(F.lit(1)).alias("degree"))
    degree = staged(degree, "pii-degrees")
    pairs = edges.select(*pattern, "value")
    scores, reached_before = certain, None
    while True:
        believed = pairs.join(scores, instance).groupBy(*pattern, "kind").agg(
            F.sum("score").alias("sum"), F.count(F.when(F.col("score") == WHOLE, 1)).alias("seeds")
        )
        confidence = F.floor(F.col("sum") / (F.col("degree") + 1))
        good = (
            believed.filter(F.col("seeds") >= support)
            .join(degree, pattern)
            .select(*pattern, "kind", confidence.alias("score"))
            .filter(F.col("score") >= belief // 2)
        )
        reached = pairs.join(good, pattern).groupBy(*instance, "kind").agg(F.max("score").alias("score"))
        new = reached.join(certain.select(*instance), instance, "left_anti")
        scores = staged(new.unionByName(certain, allowMissingColumns=False), "pii-scores")
        # Scores never fall, so equal sums are equal scores.
        total = scores.agg(F.sum("score")).first()[0]
        if total == reached_before:
            break
        reached_before = total
    best = scores.groupBy(*instance).agg(F.max(F.struct("score", "kind")).alias("best"))
    best = best.filter(F.col("best.score") >= belief).select(*instance, F.col("best.kind").alias("found"))
    unseen = rows.filter(F.col("kind").isNull()).select("k1", "k2", "start", "end", *instance)
    unseen = staged(unseen, "pii-unseen")
    return skew_join(unseen, best, instance).select("k1", "k2", "start", "end", F.col("found").alias("kind"))


def _added(found: DataFrame) -> DataFrame:
    """(k1, k2, added): discovered spans of each text, named after their seeds' kinds."""
    span = F.struct("start", "end", (F.col("kind") + len(KINDS)).alias("kind"), F.lit("").alias("value"))
    added = discover(found).groupBy("k1", "k2").agg(F.collect_set(span).alias("added"))
    return staged(added, "pii-added")


def _all_spans() -> Column:
    added = F.coalesce(F.col("added"), no_spans())

    def order(a: Column, b: Column) -> Column:
        by_kind = F.when(a["kind"] < b["kind"], -1).when(a["kind"] > b["kind"], 1)
        return by_kind.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0)

    return F.concat("base", F.array_sort(added.cast(SPAN), order))


def personal_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and digests of the spans of every document."""
    found = staged(occurrences(docs, doc_id, text), "pii-found")
    every = skew_join(found.drop("seen"), _added(found), ["k1", "k2"], "left").withColumn("every", _all_spans())
    return every.select(
        F.col("id").alias("doc_id"),
        *[count_of("base", i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.sha2(listed(F.col("base"), NAMES), 256).alias("base_sha256"),
        listed(F.col("every"), NAMES).alias("spans"),
    )


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", replaced: str = "n_replaced") -> DataFrame:
    """The documents with every span replaced by the label of its kind, and how many there were."""
    found = staged(occurrences(docs, doc_id, text), "pii-found")
    k1, k2, spans = fresh("k1", "k2", "spans")
    every = found.select("k1", "k2", "base").dropDuplicates(["k1", "k2"])
    every = every.join(_added(found), ["k1", "k2"], "left").withColumn("every", _all_spans())
    every = every.filter(F.size("every") > 0).select(
        F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("every").alias(spans)
    )
    own = whole_text(text)
    keyed = docs.select("*", F.xxhash64(own).alias(k1), F.xxhash64(F.lit(1), own).alias(k2))
    joined = skew_join(keyed, every, [k1, k2], "left")
    new = F.when(F.col(spans).isNotNull(), masked(F.col(text), F.col(spans), LABELS)).otherwise(F.col(text))
    columns = [new.alias(c) if c == text else F.col(c) for c in docs.columns if c != replaced]
    return joined.select(*columns, F.coalesce(F.size(spans), F.lit(0)).cast("long").alias(replaced))
