"""Personal data: base spans against a plain scan, and planted identifiers that only context gives away."""

import hashlib
import random
import re

from pulsemill.llm.personal import KINDS, personal_report, redact
from pulsemill.llm.shared import ready

# The stated patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    def digits(value):
        return [int(c) for c in value if c.isdigit()]

    def luhn(value):
        back = digits(value)[::-1]
        total = sum(back[0::2]) + sum(sum(divmod(2 * d, 10)) for d in back[1::2])
        return 16 <= len(back) <= 19 and total % 10 == 0

    rules = [
        (EMAIL, lambda v: True),
        (IP, lambda v: all(int(p) <= 255 for p in v.split("."))),
        (CARD, luhn),
        (PHONE, lambda v: 8 <= len(digits(v)) <= 15),
    ]
    found = [[f"{k}:{m.start()}:{m.end()}" for m in p.finditer(text) if keep(m[0])] for k, (p, keep) in zip(KINDS, rules)]
    return [len(f) for f in found], hashlib.sha256(",".join(sum(found, [])).encode()).hexdigest()


def test_base_spans_equal_a_plain_scan(spark):
    ready(spark)
    spell = random.Random(11)
    bits = ["jo.x@ex.org", "a@b", "@", ".", "1.2.3.4", "256.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111", "+1 (017) 555-7713",
            "+", " ", " ", "\n", "é", "😀", "x", "7", "00000001.2.3.4", "- ", "user%a@x-y.co.uk"]
    texts = ["".join(spell.choices(bits, k=spell.randint(0, 14))) for _ in range(600)]
    texts += [None, "", "+1 (017) 555-7713 " * 400, "12 " * 20_000]
    rows = [(i, t, "k", [1]) for i, t in enumerate(texts)] + [(0, texts[0], "k", [1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k1 string, seen array<int>").repartition(4)
    got = personal_report(docs).collect()
    assert len(got) == len(rows)
    for row in got:
        counts, digest = plain(texts[row.doc_id] or "")
        assert ([row.n_email, row.n_ip, row.n_card, row.n_phone], row.base_sha256) == (counts, digest), texts[row.doc_id]


def test_identifiers_beyond_the_patterns(spark):
    """Handles, spelled addresses, dotted groups and numbers without a plus, in the contexts of seeds."""
    ready(spark)
    rows = [f"please call +1 (168) 555-50{i} today" for i in range(10, 50)]
    rows += [f"write mailto u{i}@ex{i}.org soon" for i in range(40)]
    rows += [f"server peer 10.0.{i}.7 answered" for i in range(40)]
    long = "9" * 90
    planted = [
        ("please call (168) 555-7000 today", "please call <PHONE> today"),
        (f"please call {long} today", "please call <PHONE> today"),
        ("write mailto @jo_x soon", "write mailto <EMAIL> soon"),
        ("write mailto jo.x at ex.org soon", "write mailto <EMAIL> soon"),
        ("write mailto jo.x [at] ex [dot] org soon", "write mailto <EMAIL> soon"),
        ("server peer 10.0.3 answered", "server peer <IP> answered"),
        ("server peer fe80::1:2:ab answered", "server peer <IP> answered"),
    ]
    clean = ["in 2024 we sold 350 pieces at 12:30:45", "we met at example.org in 1999", "please call me today", "write mailto nobody soon"]
    texts = rows + [t for t, _ in planted] + clean
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.text for r in redact(docs).collect()}
    for i, (_, want) in enumerate(planted):
        assert got[len(rows) + i] == want
    assert [got[len(rows) + len(planted) + i] for i in range(len(clean))] == clean


def test_without_rows(spark):
    ready(spark)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert personal_report(none).count() == 0 and redact(none).count() == 0
