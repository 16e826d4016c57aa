"""SentencePiece encoding and decoding for vocabularies of the merge type.

The model file gives pieces and scores. A pair of neighbours may merge if their concatenation is a piece;
the best score merges first, leftmost on ties (`merges`). No piece holds a word mark behind another
letter, and letters outside the vocabulary merge with nothing, so a text falls apart exactly before each
run of blanks and around each line feed; both facts are read from the model, and a model without them is
refused. Distinct parts are encoded once per slice of text. Letters that are no piece become byte pieces.
In every Arrow batch some whole texts are also encoded and decoded by the sentencepiece library, and a
difference ends the job.

Nulls: a null text is empty and has no ids; a null id stays. Repeated rows are encoded each for itself,
no rows give no rows, other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.llm.merges import PairTable, merge_words
from pulsemill.llm.ragged import as_bytes, distinct, from_bytes, gather, text_slices

MARK = "▁"
# One text in so many of each batch is compared with the library.
CHECK_EVERY = 64


class PieceCodec:
    """Encodes and decodes as the model file says."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        pieces = {model.id_to_piece(i): i for i in range(size) if i not in special and not model.is_unused(i)}
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        if any(MARK in p.lstrip(MARK) for p in pieces) or "\n" in "".join(pieces) or model.unk_id() in self.bytes:
            raise ValueError("the model's pieces cross word marks or line feeds, or it lacks byte pieces")
        if "".join(model.encode(" a  b ", out_type=str)) != f"{MARK * 2}a{MARK * 2}b{MARK}":
            raise ValueError("the model changes blanks")
        # Letters that are no piece of their own can still be part of pieces.
        letters = sorted(set("".join(pieces)) - set(pieces))
        self.own = dict(pieces) | {c: size + n for n, c in enumerate(letters)}
        self.outside = size
        score = {p: model.get_score(i) for p, i in pieces.items()}
        order = {s: n for n, s in enumerate(sorted(set(score.values()), reverse=True))}
        left, right, rank, merged = [], [], [], []
        for piece, number in pieces.items():
            for cut in range(1, len(piece)):
                a, b = self.own.get(piece[:cut]), self.own.get(piece[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(order[score[piece]])
                    merged.append(number)
        self.table = PairTable(left, right, rank, merged)
        # Every letter as a symbol: its piece, or a number behind all pieces that merges with nothing.
        self.letter = np.arange(0x110000, dtype=np.int32) + (size + len(letters))
        single = {c: i for c, i in self.own.items() if len(c) == 1}
        self.letter[[ord(c) for c in single]] = list(single.values())
        self.letter_base = size + len(letters)
        self.outside_letters = letters
        self.surface = np.array(
            [b"" if i in special else model.id_to_piece(i).replace(MARK, " ").encode() for i in range(size)], object
        )
        self.surface[self.bytes] = [bytes([b]) for b in range(256)]
        self.decimal = np.array([str(i) for i in range(size)], object)

    def _letter_bytes(self, symbol: int) -> bytes:
        if symbol >= self.letter_base:
            return chr(symbol - self.letter_base).encode()
        return self.outside_letters[symbol - self.outside].encode()

    def parts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The independent parts of every text, each with its leading blanks, and each text's offset."""
        blanked = pc.replace_substring(texts.cast(pa.large_string()), MARK, " ")
        space, none = (pa.scalar(c, pa.large_string()) for c in (" ", ""))
        led = pc.if_else(pc.equal(pc.binary_length(blanked), 0), none, pc.binary_join_element_wise(space, blanked, none))
        flat, offsets = as_bytes(led)
        blank, feed = flat == 32, flat == 10
        cut = np.zeros(len(flat) + 1, bool)
        cut[:-1] |= feed
        cut[1:] |= feed
        cut[1:-1] |= blank[1:] & ~blank[:-1]
        cut[offsets] = True
        if len(flat):
            cut[0] = True
        starts = np.flatnonzero(cut[:-1])
        ends = np.append(starts, len(flat))
        counted = np.concatenate([[0], np.cumsum(cut[:-1])])
        return from_bytes(flat, ends), counted[offsets]

    def encode_parts(self, known: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each distinct part."""
        text = "".join(known.to_pylist())
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        lengths = pc.utf8_length(known).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        symbols = self.letter[np.where(points == 32, ord(MARK), points)]
        ids, offsets = merge_words(symbols, ends, self.table)
        foreign = np.flatnonzero(ids >= self.outside)
        if len(foreign):
            symbol, kind = np.unique(ids[foreign], return_inverse=True)
            spelled = [self.bytes[np.frombuffer(self._letter_bytes(int(s)), np.uint8)] for s in symbol]
            widths = np.array([len(s) for s in spelled])
            width = np.ones(len(ids), np.int64)
            width[foreign] = widths[kind]
            place = np.concatenate([[0], np.cumsum(width)])
            out = np.repeat(ids, width)
            for number, letters in enumerate(spelled):
                out[place[foreign[kind == number]][:, None] + np.arange(len(letters))] = letters
            ids, offsets = out, place[offsets]
        return ids, offsets

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and each text's offset into them."""
        parts, text_offsets = self.parts(texts)
        index, known = distinct(parts)
        ids, offsets = gather(*self.encode_parts(known), index)
        return ids, offsets[text_offsets]

    def write(self, ids: np.ndarray) -> str:
        """Decimal ids joined by commas."""
        return ",".join(self.decimal[ids].tolist())

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids; the mark that leads every text is no part of it."""
        return b"".join(self.surface[ids].tolist())[1:]


@cache
def _codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def encode_documents(
    docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) of every document, in one pass
    without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in batches:
            for first, texts in text_slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), *described(codec, texts, first)], names=names
                )

    def described(codec: PieceCodec, texts: pa.Array, first: int) -> list[pa.Array]:
        ids, offsets = codec.encode(texts)
        bounds = offsets.tolist()
        rows = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
        written = [codec.write(row) for row in rows]
        decoded = [codec.decode(row) for row in rows]
        for row in range(-first % CHECK_EVERY, len(texts), CHECK_EVERY):
            theirs = codec.library.encode(texts[row].as_py())
            if rows[row].tolist() != theirs or decoded[row].decode() != codec.library.decode(theirs):
                raise ValueError("encoding differs from the sentencepiece library")
        out = [
            pa.array(offsets[1:] - offsets[:-1], pa.int64()),
            pa.array([hashlib.sha256(w.encode()).hexdigest() for w in written], pa.string()),
            pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
        ]
        if with_ids:
            out += [pa.array(rows, pa.list_(pa.int32())), pa.array([d.decode() for d in decoded], pa.string())]
        return out

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * with_ids
    key_type = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {key_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(run, schema + ", ids array<int>, decoded string" * with_ids)


def decode_documents(docs: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of an array of ids; a null array stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in batches:
            texts = [
                None if row is None else codec.decode(np.array(row, np.int64)).decode("utf-8", "replace")
                for row in batch.column(batch.schema.get_field_index(ids)).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, `{out}` string")
