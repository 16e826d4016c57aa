"""Operators on small tables with nulls, empty and repeated rows, ties and clashing columns."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from pulsemill.llm.codec import encode_documents
from pulsemill.llm.graph import components
from pulsemill.llm.languages import UNKNOWN, fit_trigrams, identify
from pulsemill.llm.neardup import drop_near_duplicates, near_duplicates
from pulsemill.llm.packing import pack, token_pieces
from pulsemill.llm.personal import LABELS, personal_report, redact
from pulsemill.llm.secret_scan import scan_secrets, secret_report
from pulsemill.llm.shared import ready
from pulsemill.llm.sketch import fingerprint_report
from pulsemill.llm.topk import exact_top_k
from pulsemill.llm.windows import drop_repeated_lines

public_tokenizers = pytest.importorskip("public_tokenizers")

LONG = " ".join(f"word{i} thing{i % 7}" for i in range(400))
ROWS = [
    (1, "a\nb\nc\nd"), (2, "x\na\nb\nc"), (3, None), (4, ""), (5, "short"), (6, "short"), (6, "short"),
    (None, "a\nb\nc"), (7, LONG), (8, LONG + " end"), (9, LONG), (10, "mail me: jo.x@ex.org or +1 (017) 555-7713 \n 1.2.3.4"),
    (11, "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" card 4111 1111 1111 1111"),
]


@pytest.fixture
def docs(spark):
    ready(spark)
    rows = [(i, t, "en", "src", "n", "k", "s", 1) for i, t in ROWS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, node string, k1 string, spans string, n_chars long"
    )


def test_windows(docs):
    rows = {(r.doc_id, r.text) for r in drop_repeated_lines(docs).collect()}
    # The null id comes first, so its window is the one that stays.
    assert {(None, "a\nb\nc"), (1, "d"), (2, "x"), (3, None), (4, ""), (5, "short"), (6, ""), (9, "")} <= rows
    assert drop_repeated_lines(docs.limit(0)).count() == 0


def test_sketches(docs):
    rows = fingerprint_report(docs).collect()
    assert len(rows) == len(ROWS)
    by_text = {}
    texts = dict(ROWS)
    for r in rows:
        by_text.setdefault(texts.get(r.doc_id) or "", set()).add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(prints) == 1 for prints in by_text.values())
    edited = {r.doc_id: r.edited_sha256 for r in rows}
    assert edited[5] == hashlib.sha256(b"shor" + b"s").hexdigest()
    assert edited[7] == hashlib.sha256((LONG[: -(len(LONG) // 4)] + (LONG + " end")[: len(LONG) // 4]).encode()).hexdigest()
    assert fingerprint_report(docs.limit(0)).count() == 0


def test_packs(docs):
    out = pack(token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=256), 256).collect()
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256
    assert sum(r.piece == 0 for r in out) == len(ROWS)
    empty = token_pieces(docs.limit(0), public_tokenizers.path("word_bpe_49k.json"))
    assert pack(empty).count() == 0


def test_codec(docs):
    rows = encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True).collect()
    assert len(rows) == len(ROWS)
    assert {r.decoded for r in rows} == {t or "" for _, t in ROWS}


def test_near_duplicates(docs):
    rows = near_duplicates(docs).collect()
    classes = {r.id: r.class_id for r in rows}
    assert classes[7] == classes[8] == classes[9] == 7 and classes[5] == classes[6] == 5
    assert classes[3] == classes[4] == 3 and classes[10] == 10
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id)
    assert ids == [1, 2, 3, 5, 7, 10, 11]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_chain(spark):
    links = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    links = links.unionByName(spark.createDataFrame([(100, 102), (102, 101), (7, 7)], "a long, b long"))
    roots = {r.node: r.root for r in components(links).collect()}
    assert set(roots) == {*range(61), 100, 101, 102}
    assert {roots[n] for n in range(61)} == {0} and {roots[n] for n in (100, 101, 102)} == {100}


def test_secrets(docs):
    rows = {r.doc_id: r for r in secret_report(docs).collect()}
    text = dict(ROWS)[11]
    start = text.index("token")
    hexa = re.search("[0-9a-f]{24,}", text)
    wanted = f"assign:{start}:{hexa.end()},hex:{hexa.start()}:{hexa.end()}"
    assert rows[11].spans == wanted and rows[11].base_sha256 == hashlib.sha256(wanted.encode()).hexdigest()
    assert rows[3].spans == "" and rows[3].n_hex == 0
    # The result replaces the column of its name.
    assert sorted(scan_secrets(docs, ratios=[0.0] * 128 * 128).columns) == sorted(docs.columns)


def test_personal_data(docs):
    rows = {r.doc_id: r for r in personal_report(docs).collect()}
    assert (rows[10].n_email, rows[10].n_phone, rows[10].n_ip, rows[11].n_card) == (1, 1, 1, 1)
    clean = {r.doc_id: r.text for r in redact(docs).collect()}
    assert clean[10] == f"mail me: {LABELS[0]} or {LABELS[3]} \n {LABELS[1]}"
    assert clean[3] is None and clean[7] == LONG


def test_languages(spark):
    ready(spark)
    words = {"en": "the of and that with this house", "de": "der und nicht ein das wohnung ist", "fr": "le la de et une maison est"}
    rows = [(n * 3 + k, " ".join((text.split() * 5)[n % 5 :]), lang) for k, (lang, text) in enumerate(words.items()) for n in range(30)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_trigrams(labelled)
    odd = [(900, "und nicht ein", None), (901, "12 34 !!", "en"), (902, None, "de"), (903, "", None), (904, "ЖЩЫ ЪЭЮ ФХЦ ЧШЩ ЁЙЦУ " * 20, None)]
    found = identify(spark.createDataFrame(odd, "doc_id long, text string, language string"), model, declared=F.col("language"))
    got = {r.doc_id: (r.language, r.accepted) for r in found.collect()}
    assert got[900] == ("de", True)
    assert all(got[i] == (UNKNOWN, False) for i in (901, 902, 903, 904))


def test_top_k(spark):
    ready(spark)
    vectors = [(i, [float(i % 5) - 2, (i * 7 % 11) / 4 - 1, 0.5]) for i in range(120)]
    vectors += [(200, None), (201, [1.0, None, 2.0]), (202, [float("nan")] * 3), (203, [float("inf")] * 3), (None, [1.0, 1.0, 1.0])]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in exact_top_k(table, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect()]
    ints = {i: [int((256 * x) // 1) for x in v] for i, v in vectors[:120]}
    wanted = []
    for q in (0, 50, 100):
        best = sorted((-sum(a * b for a, b in zip(ints[q], ints[i])), i) for i in ints if i != q)[:5]
        wanted += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert got == wanted
    assert exact_top_k(table.limit(0), F.col("id") % 50 == 0).count() == 0
