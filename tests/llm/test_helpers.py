"""The parts that run inside tasks, against libraries and brute force."""

import html
import itertools

import numpy as np
import pyarrow as pa
import pytest

from pulsemill.llm.codec import PieceCodec
from pulsemill.llm.neardup import Idf, ROWS, SLOTS, band_hashes, samples, shingles
from pulsemill.llm.packing import WordTokenizer, evolve
from pulsemill.llm.pages import Weights, best_run, main_text
from pulsemill.llm.topk import Pack, search

public_tokenizers = pytest.importorskip("public_tokenizers")

TEXTS = [
    "", " ", "a", "  a  b ", "\n\n a\n", "don't stop'll we'RE", "<|endoftext|> hi<|startoftext|>x",
    "Ünïcödé ΣΑΣ İstanbul ſ K", "日本語テキスト😀 é​\t\x00x", "x" * 300 + "é" * 90,
    "12,345.67!!? ...'s's", "a▁b ▁ ▁▁c", "\xa0nb sp", "½ µ ª º ² ×÷ ß ŉ ǆ", "a\r\nb", "Thhaen Thhaen, thhaen.",
]


def test_words_like_the_library():
    coder = WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    ids, offsets = coder.encode(pa.array(TEXTS))
    for i, text in enumerate(TEXTS):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == coder.library.encode(text, add_special_tokens=False).ids


def test_pieces_like_the_library():
    codec = PieceCodec(public_tokenizers.path("piece_bpe_32k.model"))
    ids, offsets = codec.encode(pa.array(TEXTS))
    for i, text in enumerate(TEXTS):
        mine, theirs = ids[offsets[i] : offsets[i + 1]], codec.library.encode(text)
        assert mine.tolist() == theirs
        assert codec.decode(mine).decode() == codec.library.decode(theirs)


def test_packings_are_whole_and_near_the_bound():
    rng = np.random.default_rng(3)
    sizes = np.minimum(2047, rng.lognormal(6.5, 0.8, 2000).astype(int) + 1).tolist()
    for seed in (0, 1):
        packing = evolve(sizes, 2048, seed, [])
        assert sorted(itertools.chain(*packing)) == list(range(2000))
        assert all(sum(sizes[i] for i in members) <= 2048 for members in packing)
        assert len(packing) <= -(-sum(sizes) // 2048) * 1.01 + 1
    assert evolve([], 2048, 0, []) == []


def test_best_run_against_every_run():
    rng = np.random.default_rng(5)
    for _ in range(200):
        scores = rng.integers(-4, 5, rng.integers(0, 9)).tolist()
        sums = [sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)]
        a, b = best_run(scores)
        assert sum(scores[a:b]) == max([0, *sums])


def test_main_text_of_odd_pages():
    weights = Weights({}, {}, 1.0, -0.05)
    page = (
        "<html><head><title>T</title><script>var t='<p>no</p>';</script></head><body><nav><a href=x>Menu</a></nav>"
        "<div class='ad box'>Buy</div><article><h1>A &amp; B</h1><p>one<br>two  <b>three<p>four &lt;5"
        "<div class=comments><p>I agree</div></article><footer>&copy; x</footer>"
    )
    assert main_text(page, weights) == "A & B\none two three\nfour <5"
    assert main_text(None, weights) == main_text("", weights) == main_text("<p></p>", weights) == ""
    assert main_text("just words", weights) == "just words"
    assert main_text("<p>" + html.escape("a<b") + "</p>" * 3, weights) == "a<b"


def test_samples_agree_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(1)
    agree, m, k = [], 600, 480
    weight = rng.uniform(0.75, 1, m).astype(np.float32)
    for _ in range(40):
        a = rng.integers(0, 2**63, m).astype(np.uint64)
        b = np.concatenate([a[:k], rng.integers(0, 2**63, m - k).astype(np.uint64)])
        drawn = samples(np.concatenate([a, b]), np.concatenate([weight, weight]), np.array([0, m, 2 * m]))
        agree.append((drawn[0] == drawn[1]).mean())
    wanted = weight[:k].sum() / (2 * weight.sum() - weight[:k].sum())
    assert abs(np.mean(agree) - wanted) < 0.04


def test_shingles_of_short_and_empty_texts():
    value, count, offsets = shingles(pa.array(["", "a b", "a b", "a b c d e f", "x x x x x x x"], pa.large_string()))
    assert np.diff(offsets).tolist() == [0, 1, 1, 2, 1]
    assert value[offsets[1]] == value[offsets[2]] and count[offsets[4]] == 3
    idf = Idf(np.zeros(ROWS * SLOTS), 0)
    bands = band_hashes(samples(value, count * idf.of(value), offsets))
    assert (bands[1] == bands[2]).all()


def test_search_prunes_nothing_that_counts():
    rng = np.random.default_rng(2)

    def pack(ids, rows):
        order = np.argsort(-(rows.astype(float) ** 2).sum(1), kind="stable")
        ids, rows = np.asarray(ids)[order], rows[order]
        from types import SimpleNamespace

        row = SimpleNamespace(
            ids=ids.astype(np.int64).tobytes(), hashes=ids.astype(np.int64).tobytes(),
            ints=rows.astype(np.int64).tobytes(), wide=True, size=len(ids),
        )
        return Pack(row, np.linalg.qr(rng.normal(size=(8, 8)))[0])

    rows = rng.integers(-9, 10, (300, 8))
    rows[50:150] = rows[50]
    state = rng.bit_generator.state
    chunk = pack(range(300), rows)
    rng.bit_generator.state = state
    asked = pack([0, 50, 299], rows[[0, 50, 299]])
    q, c, s = search(asked, chunk, np.full(3, -np.inf), 5)
    for i, name in enumerate(asked.ids):
        scores = sorted((-int(rows[name] @ rows[j]), j) for j in range(300) if j != name)[:5]
        assert [(-int(x), int(chunk.ids[j])) for x, j in zip(s[q == i], c[q == i])] == scores
