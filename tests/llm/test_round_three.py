"""Token alignment, filter cascade and runs of words against plain versions of the same definitions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsemill.llm import cascade as cascades
from pulsemill.llm.alignment import align, chunks
from pulsemill.llm.cascade import address, build_cascade, filter_addresses, judged, keys_of_blocked_hosts, rule_of
from pulsemill.llm.catalog import BYTE_FILE, PIECE_FILE, QUERIES, RULES, tokenizer_path
from pulsemill.llm.periodic import find_runs, made_periodic, run_report, runs_of, runs_of_texts
from pulsemill.llm.shared import ready


@pytest.fixture(scope="module")
def llm(spark):
    return ready(spark)


TEXTS = [
    None, "", " ", "  ", "\n", "The token's 1234 words -- don't stop.", "The token's 1234 words -- don't stop.",
    "<|endoftext|> <s> is plain text", "tab\there  two   blanks \n\n line", "été à Zürich, naïve Ωμέγα 東京 😀😀",
    "a mark ▁ in the text", "nul \x00 and \x1c and \x85 and \xa0 blank\u3000wide", " leading", "trailing ", "x" * 5000,
    "word " * 3000, "é" * 300 + " é", "1 2 3 4 5 6 7 8 9 10 11 12",
]


def plain_alignment(texts):
    """Groups and links of every text, token by token."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(tokenizer_path(BYTE_FILE))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_FILE))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    letters |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}

    def placed(tokens):
        at, out = 0, []
        for number, data in tokens:
            out.append((at, at + len(data), number))
            at += len(data)
        return out

    found, counts = [], Counter()
    for text in texts:
        own = (" " + (text or "")).encode()
        coded = a_model.encode(own.decode(), add_special_tokens=False)
        a = [(i, bytes(letters[c] for c in t)) for i, t in zip(coded.ids, coded.tokens)]
        b = []
        for i in b_model.encode(text or ""):
            piece = b_model.id_to_piece(i)
            b.append((i, bytes([int(piece[1:-1], 16)]) if b_model.is_byte(i) else piece.replace("▁", " ").encode()))
        if not text or b"".join(t for _, t in a) != own or b"".join(t for _, t in b) != own:
            found.append(None)
            continue
        a, b = placed(a), placed(b)
        stops = sorted({end for _, end, _ in a} & {end for _, end, _ in b})
        groups, begin = [], 0
        for stop in stops:
            groups.append(tuple([i for s, _, i in side if begin <= s < stop] for side in (a, b)) if len(own) < 2000 else None)
            begin = stop
        links = [(i, j) for s, e, i in a for t, f, j in b if s < f and t < e] if len(own) < 2000 else None
        found.append((a, b, groups, links))
        counts.update(set(links or ()))
    return found, counts


def test_alignment_equals_token_by_token(llm):
    texts = [t for t in TEXTS if t is None or len(t) < 1000]
    docs = llm.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, block string, n_a int")
    got = {r["doc_id"]: r for r in align(docs, tokenizer_path(BYTE_FILE), tokenizer_path(PIECE_FILE)).collect()}
    found, counts = plain_alignment(texts)
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(n, most.get(a, 0))
    assert len(got) == len(texts)
    for i, known in enumerate(found):
        want = (i, 0, 0, 0, 0, 0, 0, "")
        if known:
            a, b, groups, links = known
            written = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
            want = (
                i, len(a), len(b), len(groups), len(links), sum(counts[x] == most[x[0]] for x in links),
                sum(counts[x] for x in links), hashlib.sha256(written.encode()).hexdigest(),
            )
        assert tuple(got[i]) == want, texts[i]


def test_alignment_of_long_repeated_and_no_texts(llm):
    schema = "doc_id long, text string"
    files = tokenizer_path(BYTE_FILE), tokenizer_path(PIECE_FILE)
    docs = llm.createDataFrame([(None, TEXTS[15]), (1, TEXTS[15]), (1, TEXTS[15]), (2, TEXTS[14])], schema)
    rows = align(docs, *files).collect()
    assert len(rows) == 4 and len({r["groups_sha256"] for r in rows}) == 2
    same = [r for r in rows if r["doc_id"] != 2]
    assert {r["n_a"] for r in same} == {3001} and len({r["count_sum"] for r in same}) == 1
    assert align(llm.createDataFrame([], schema), *files).count() == 0


def test_chunks_are_read_one_by_one():
    import pyarrow as pa
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer_path(BYTE_FILE))
    for text in filter(None, TEXTS):
        parts, _ = chunks(pa.array([text]))
        whole = model.encode(text, add_special_tokens=False).ids if "<|" not in text else None
        ids = [i for part in parts.to_pylist() for i in model.encode(part, add_special_tokens=False).ids]
        assert "".join(parts.to_pylist()) == text and whole in (None, ids)


@pytest.mark.parametrize("flat", [cascades.FLAT_BYTES, 0])
def test_cascade_is_exact(llm, monkeypatch, flat):
    universe = llm.range(60_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    listed = universe.filter(F.crc32("key") % 7 == 0)
    # Few hashes let many wrong keys through, so that several levels are needed.
    monkeypatch.setattr(cascades, "MOST_HASHES", 2)
    made = build_cascade(listed.unionByName(listed), universe)
    monkeypatch.setattr(cascades, "FLAT_BYTES", flat)
    assert made.levels > 2 and made.shards > 1
    hot = universe.unionByName(llm.range(30_000).select(F.lit("k0").alias("key"))).withColumn("shard", F.lit("own"))
    found = judged(hot, made, F.col("key"), "hit")
    wrong = found.filter(F.col("hit") != (F.crc32("key") % 7 == 0))
    assert found.count() == 90_000 and wrong.count() == 0 and found.columns == ["key", "shard", "hit"]


def test_cascade_without_list_or_universe(llm):
    none = llm.createDataFrame([], "key string")
    some = llm.createDataFrame([("a",), ("b",), (None,)], "key string")
    for listed, universe, want in ((none, none, set()), (none, some, set()), (some, none, {"a", "b"}), (some, some, {"a", "b"})):
        found = judged(some, build_cascade(listed, universe), F.col("key"), "hit").collect()
        assert {r["key"] for r in found if r["hit"]} == want and all(r["hit"] is not None for r in found)


URLS = [
    None, "", "no scheme/here", "http://", "HTTP://WWW.Example.ORG", "http://example.org/es/x", "http://example.org/en/12",
    "http://a.example.org/en/1?q=://x", "http://badexample.org/es/", "http://x.com/de/1", "http://x.com/de/1", "http://x.com/fr/1",
    "http://x.com/de/2#top", "http://x.com/en/1", "http://x.com/en/1?again", "http://y.com/en/1", "http://y.com/fr/1", "ftp://com/de/",
    "x://one://two/", "http://h\nost/a\nb", "http://É.com/de/", "http://x.com:80/de/1", "http://" + "long" * 5000 + "/p",
]


def test_addresses_and_rules(llm):
    pages = llm.createDataFrame([(i, u, "mine", "mine") for i, u in enumerate(URLS)], "page_id long, url string, rule string, key string")
    got = {r["page_id"]: r for r in filter_addresses(pages, RULES, build_cascade(*keys_of_blocked_hosts(pages, RULES))).collect()}
    split, keys = {}, {}
    for i, url in enumerate(URLS):
        host = path = ""
        if url and "://" in url:
            host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [r for r in RULES if ("." + host).endswith("." + r[1]) and path.startswith(r[2])]
        split[i] = host, path, max(fits, key=lambda r: len(r[1] + r[2])) if fits else None
        keys[host, path] = split[i][2]
    balance = Counter()
    for (host, _), rule in keys.items():
        balance[host] += 0 if rule is None else 1 if rule[0] == "block" else -1
    for i, (host, path, rule) in split.items():
        verdict = rule[0] if rule else "block" if balance[host] > 0 else "allow"
        want = host, path, rule and rule[1] + rule[2], verdict
        assert tuple(got[i][c] for c in ("host", "path", "rule", "verdict")) == want and got[i]["key"] == "mine", URLS[i]
    assert {v["verdict"] for v in got.values()} == {"allow", "block"}
    empty = pages.limit(0)
    assert filter_addresses(empty, RULES, build_cascade(*keys_of_blocked_hosts(empty, RULES))).count() == 0


def plain_runs(x, least=12):
    n, found = len(x), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted((i, length, q) for (i, length), q in found.items())


def random_words(rng):
    n, k = rng.randint(0, 70), rng.choice([1, 2, 3, 20])
    x = [rng.randint(1, k) for _ in range(n)]
    if n > 4 and rng.random() < 0.5:
        a, p = rng.randrange(n), rng.randint(1, 9)
        for i in range(a + p, n):
            x[i] = x[i - p]
    return x


def test_runs_equal_all_periods():
    rng = random.Random(5)
    for _ in range(600):
        x = random_words(rng)
        for least in (2, 12):
            assert [tuple(map(int, r)) for r in runs_of(np.array(x, np.int64), least)] == plain_runs(x, least)
    for _ in range(60):
        texts = [random_words(rng) for _ in range(rng.randint(0, 12))]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        got = runs_of_texts(np.array([w for t in texts for w in t], np.int64), offsets)
        assert sorted(tuple(map(int, r)) for r in got) == sorted((i, *r) for i, t in enumerate(texts) for r in plain_runs(t))


def test_run_report(llm):
    rng = random.Random(6)
    texts = [None, "", " \n ", "a " * 11, "a " * 12, "a\x0bb\x0cc " * 4, "a b\x85c\xa0d " * 3, "one two three " * 20000]
    texts += [" ".join(f"w{w}" for w in random_words(rng)) for _ in range(60)]
    docs = llm.createDataFrame([(i, t, [1]) for i, t in enumerate(texts + texts[-3:])], "doc_id long, text string, runs array<int>")
    edited = docs.withColumn("text", made_periodic(F.col("text"), F.col("doc_id")))
    got = {r["doc_id"]: tuple(r) for r in run_report(find_runs(edited)).collect()}
    assert len(got) == len(texts) + 3
    for i, text in enumerate(texts + texts[-3:]):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
        runs = plain_runs(words) if n < 1000 else [(0, 60000, 3)]
        dropped = {w for s, length, q in runs for w in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        lines = "".join("%d,%d,%d\n" % r for r in sorted(runs, key=lambda r: (r[0], r[2])))
        kept = " ".join(w for j, w in enumerate(words) if j not in dropped)
        want = (i, len(runs), *best, runs and 1000 * best[1] // best[2] or None)
        assert got[i] == want + tuple(hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept)), text
    none = llm.createDataFrame([], "doc_id long, text string")
    assert run_report(find_runs(none)).count() == 0
    assert run_report(find_runs(llm.createDataFrame([(None, "a " * 12)], "doc_id long, text string"))).first()["n_runs"] == 1


def test_queries_cover_their_tables(llm):
    folder = "/root/testdata/sf0.001"
    for name, table in (("op11_token_overlaps", "documents"), ("op12_filter_cascade", "pages"), ("op13_periodic_runs", "documents")):
        assert QUERIES[name](llm, folder).count() == llm.read.parquet(f"{folder}/{table}.parquet").count()


def test_rule_and_address_columns(llm):
    row = llm.range(1).select(F.lit("http://A.example.org/en/1/x?y").alias("u"))
    host, path = address(F.col("u"))
    rule, says = rule_of(host, path, RULES)
    assert tuple(row.select(host, path, rule, says).first()) == ("a.example.org", "/en/1/x", "example.org/en/1", "block")
