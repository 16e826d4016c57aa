"""Operators do the whole job where an earlier form did less: compared with brute force on planted rows."""

import random

import numpy as np
import pyarrow as pa

from corpus_pipeline import language_id
from pulsemill.llm.languages import fit_trigrams, identify
from pulsemill.llm.neardup import fit_idf, near_duplicates, shingles
from pulsemill.llm.shared import ready


def test_near_pairs_inside_a_template_group(spark):
    """One template, texts that are not alike as wholes, and pairs of them that are just alike enough."""
    ready(spark)
    spell = random.Random(5)
    template = [f"same{i}" for i in range(260)]
    texts = []
    for i in range(1500):
        own = [f"own{i}x{k}" for k in range(44)]
        texts.append(template + own)
        if i % 10 == 0:
            copy = list(own)
            for at in spell.sample(range(44), 4):
                copy[at] = f"new{i}x{at}"
            texts.append(template + copy)
    spell.shuffle(texts)
    texts = [" ".join(t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)

    value, tf, offsets = shingles(pa.array(texts))
    weight = tf * fit_idf(docs).of(value)
    names, place = np.unique(value, return_inverse=True)
    rows = np.repeat(np.arange(len(texts)), np.diff(offsets))
    often = np.bincount(place, weights=np.ones(len(place)))[place] > 1
    columns, place = np.unique(place[often], return_inverse=True)
    held = np.zeros((len(texts), len(columns)), np.float32)
    held[rows[often], place] = np.sqrt(weight[often])
    shared = held @ held.T
    total = np.add.reduceat(weight, offsets[:-1])
    alike = shared >= 0.8 * (total[:, None] + total[None, :] - shared)
    a, b = np.nonzero(np.triu(alike, 1))
    assert 50 < len(a) < 400

    classes = {r.id: r.class_id for r in near_duplicates(docs).collect()}
    assert all(classes[x] == classes[y] for x, y in zip(a.tolist(), b.tolist()))
    assert len(set(classes.values())) == len(texts) - len(a)


def test_rare_languages_stay(spark):
    """A language of far less than 1 % of the table, in a script of its own."""
    ready(spark)
    words = {"en": "the of and that with this house", "de": "der und nicht ein das wohnung ist", "ru": "дом который город вечером они"}
    sizes = {"en": 1500, "de": 1500, "ru": 8}
    rows = [
        (len(text) * 10_000 + n, " ".join((text.split() * 5)[n % 5 :]), lang, "src", 9)
        for lang, text in words.items() for n in range(sizes[lang])
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(4)
    found = identify(docs, fit_trigrams(docs), declared=docs.lang, host=docs.source).collect()
    assert all(r.language == r.lang and r.accepted for r in found)
    kept = language_id(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in rows)


def test_group_of_near_copies_in_proportion(spark, monkeypatch):
    """Copies of one text with one or two words of their own: classes as by brute force, and a number of
    compared pairs that grows about as the group does."""
    import pulsemill.llm.neardup as neardup

    ready(spark)
    compared = []

    class Counted(neardup._Links):
        def verify(self, pairs):
            before = self.verified
            found = super().verify(pairs)
            compared[-1] += self.verified - before
            return found

    monkeypatch.setattr(neardup, "_Links", Counted)
    spell = random.Random(5)
    for size in (1600, 3200):
        texts = []
        for i in range(size):
            words = [f"w{k}" for k in range(80)]
            for at in spell.sample(range(80), 1 + i % 2):
                words[at] = f"own{i}x{at}"
            texts.append(" ".join(words))
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
        value, tf, offsets = shingles(pa.array(texts))
        weight = tf * fit_idf(docs).of(value)
        rows = np.repeat(np.arange(size), np.diff(offsets))
        columns, place = np.unique(value, return_inverse=True)
        often = np.bincount(place)[place] > 1
        columns, place = np.unique(place[often], return_inverse=True)
        held = np.zeros((size, len(columns)), np.float32)
        held[rows[often], place] = np.sqrt(weight[often])
        shared = held @ held.T
        total = np.add.reduceat(weight, offsets[:-1])
        alike = shared >= 0.8 * (total[:, None] + total[None, :] - shared)
        first = np.full(size, -1)
        for i in range(size):
            todo = [i] if first[i] < 0 else []
            first[todo] = i
            while todo:
                new = np.flatnonzero(alike[todo.pop()] & (first < 0))
                first[new] = i
                todo += new.tolist()
        compared.append(0)
        classes = {r.id: r.class_id for r in near_duplicates(docs).collect()}
        assert [classes[i] for i in range(size)] == first.tolist()
    assert compared[1] < 2.5 * compared[0]


def test_many_languages(spark):
    """120 languages, one of them with two rows only, within a time that grows with their number."""
    import string
    import time

    ready(spark)
    spell = random.Random(4)
    rows = []
    for number in range(120):
        words = ["".join(spell.choices(string.ascii_lowercase, k=spell.randint(3, 7))) for _ in range(30)]
        label = string.ascii_lowercase[number % 26] + string.ascii_lowercase[number // 26]
        for _ in range(2 if number == 77 else 10):
            rows.append((len(rows), " ".join(spell.choices(words, k=60)), label, f"host{number % 7}.example.com", 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(4)
    begun = time.monotonic()
    found = identify(docs, fit_trigrams(docs), declared=docs.lang, host=docs.source).collect()
    assert len(found) == len(rows) and all(r.language == r.lang and r.accepted for r in found)
    assert time.monotonic() - begun < 60
