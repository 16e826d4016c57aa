"""Secret scan: fixed patterns, and character Markov models of random strings and of ordinary identifiers.

The fixed patterns find assignments, access keys and long hexadecimal strings. Two first-order models
over ASCII characters are trained by grouped counts over a bounded sample of about TRAIN_DOCS documents:
labelled as random are the values the fixed patterns found and the encoded digest of each sampled text,
labelled as ordinary are the words of these texts outside of matches. A token of at least LEAST characters
with a letter and a digit that no fixed span touches is reported (kind `markov`) when the log likelihood
ratio of its transitions is at least ODDS. Everything is built from SQL functions.

Nulls: a null text is empty and has no spans; null ids stay. Repeated rows are treated alike, no rows give
no rows, other columns pass through `scan_secrets`; one of the name of the result is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.llm.spans import count_of, find_spans, listed, no_spans, overlaps
from pulsemill.plans.once import with_columns_once

# The patterns of the base spans.
KINDS = ["assign", "access", "hex", "markov"]
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"

TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}"
LEAST = 16
TRAIN_DOCS = 4000
# A random string is expected once in a million tokens.
ODDS = math.log(1e6)
CODES = 128


def with_base_spans(docs: DataFrame, text: str) -> DataFrame:
    """(_row, _text, _base): all columns, the text, and the spans of the fixed patterns in order of start
    and kind."""
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"))
    read = with_columns_once(packed, {"_text": F.coalesce(F.col(f"_row.{text}"), F.lit(""))})
    found = with_columns_once(
        read,
        {
            "_assign": find_spans("_text", ASSIGN, 0, lambda v: F.length(v) >= 6, group=2),
            "_access": find_spans("_text", ACCESS, 1, lambda v: F.length(v) >= 20),
            "_hex": find_spans("_text", HEX, 2, lambda v: F.length(v) >= 24),
        },
    )
    base = F.array_sort(F.concat("_assign", "_access", "_hex"), _by_start)
    return with_columns_once(found, {"_base": base}).drop("_assign", "_access", "_hex")


def _by_start(a: Column, b: Column) -> Column:
    first = F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
    return first.when(a["kind"] < b["kind"], -1).when(a["kind"] > b["kind"], 1).otherwise(0)


def transitions(token: Column) -> Column:
    """Codes of the neighbouring characters of an ASCII token."""
    chars = F.transform(F.split(token, ""), lambda c: F.ascii(c))
    return F.transform(
        F.slice(chars, F.lit(1), F.greatest(F.length(token) - 1, F.lit(0))), lambda c, i: c * CODES + F.get(chars, i + 1)
    )


def fit_markov(docs: DataFrame, text: str = "text", key: str = "doc_id", most: int = TRAIN_DOCS) -> list[float]:
    """The log likelihood ratio of every transition, random against ordinary."""
    written = docs.filter(F.length(text) > 0)
    total = max(1, written.count())
    sample = written.filter(F.pmod(F.xxhash64(key, text), F.lit(total)) < most).select(F.col(text).alias("text"))
    found = with_base_spans(sample, "text")
    digest = F.base64(F.unhex(F.sha2("_text", 256)))
    random = F.concat(F.transform("_base", lambda s: s["value"]), F.array(digest))
    cut = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col("_text"), ASSIGN, " "), ACCESS, " "), HEX, " ")
    words = F.regexp_extract_all(cut, F.lit(r"[A-Za-z_][A-Za-z0-9_]+"), F.lit(0))
    labelled = found.select(F.lit(True).alias("random"), F.explode(random).alias("token")).unionByName(
        found.select(F.lit(False).alias("random"), F.explode(words).alias("token"))
    )
    steps = labelled.groupBy("random", "token").agg(F.count(F.lit(1)).alias("n")).select(
        "random", "n", F.explode(transitions(F.col("token"))).alias("code")
    )
    # At most two rows for each pair of ASCII characters.
    rows = steps.groupBy("random", "code").agg(F.sum("n").alias("n")).filter(F.col("code") < CODES * CODES).collect()
    counts = {(r["random"], r["code"]): r["n"] for r in rows}
    used = 65  # Letters, digits and the signs of encoded strings.
    out = [0.0] * (CODES * CODES)
    for label, sign in ((True, 1.0), (False, -1.0)):
        for before in range(CODES):
            line = [counts.get((label, before * CODES + c), 0) for c in range(CODES)]
            whole = sum(line) + used
            for c, n in enumerate(line):
                out[before * CODES + c] += sign * math.log((n + 1) / whole)
    return out


def scan_secrets(docs: DataFrame, text: str = "text", key: str = "doc_id", ratios: list[float] | None = None, out: str = "spans") -> DataFrame:
    """The documents with an array of spans (start, end, kind, value), ordered by start and kind."""
    if ratios is None:
        ratios = fit_markov(docs, text, key)
    # Folded into one literal array by the optimizer.
    table = F.split(F.lit(",".join(f"{r:.6f}" for r in ratios)), ",").cast("array<double>")
    based = with_base_spans(docs, text)
    mixed = lambda v: F.rlike(v, F.lit("[0-9]")) & F.rlike(v, F.lit("[A-Za-z]"))
    tokens = with_columns_once(based, {"_tokens": find_spans("_text", TOKEN, 3, mixed)})

    def score(span: Column) -> Column:
        return F.aggregate(transitions(span["value"]), F.lit(0.0), lambda t, code: t + F.element_at(table, code + 1))

    added = F.when(
        F.size("_tokens") > 0,
        F.filter("_tokens", lambda s: ~overlaps(s, F.col("_base")) & (score(s) >= ODDS)),
    ).otherwise(no_spans())
    every = F.array_sort(F.concat("_base", added), _by_start)
    spans = with_columns_once(tokens, {"_spans": every})
    return spans.select(*[F.col(f"_row.{c}") for c in docs.columns if c != out], F.col("_spans").alias(out))


def secret_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and digests of the spans of every document."""
    spans = scan_secrets(docs.select(F.col(doc_id), F.col(text)), text, doc_id, out="_spans")
    base = F.filter("_spans", lambda s: s["kind"] < 3)
    return spans.select(
        F.col(doc_id).alias("doc_id"),
        count_of("_spans", 0).alias("n_assign"),
        count_of("_spans", 1).alias("n_access"),
        count_of("_spans", 2).alias("n_hex"),
        F.sha2(listed(base, KINDS), 256).alias("base_sha256"),
        listed(F.col("_spans"), KINDS).alias("spans"),
    )
