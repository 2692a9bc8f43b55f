"""SentencePiece encoding and decoding that keeps the place of every piece in the text.

The model's compiled character map normalises by longest prefix and notes which byte of
the text each normalised character comes from. As no piece of the model goes on after a
word with a space symbol, the normalised text falls into spaces-and-word segments that
merge independently; merges run over all new segments of a block at once. Pieces
are projected back to byte spans of the original text.

Defined results: null and empty texts have no pieces; characters outside the vocabulary
become byte pieces, one per byte; the space put before the text spans no byte; texts of
any length are encoded whole, a block of texts at a time.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from plaudit.llm.bpe import Merges
from plaudit.llm.common import per_text

SPACE = "▁"
MEMO_ENTRIES = 250_000
#: Characters of texts whose pieces and spans are handed on together; they take many times the texts' room.
SPAN_BLOCK_CHARS = 1 << 18
NORMAL, CONTROL, USER, UNUSED, BYTE = 1, 3, 4, 5, 6  # piece types of the model format (fixed values)


def compiled_rules(blob: bytes) -> dict[str, str]:
    """Prefix -> replacement, read from a compiled character map (a double array and its texts)."""
    if not blob:
        return {}
    size = struct.unpack("<I", blob[:4])[0]
    units = np.frombuffer(blob, "<u4", size // 4, 4)
    texts = blob[4 + size :]
    labels = np.arange(1, 256, dtype=np.uint32)

    def below(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    rules, open_nodes = {}, [(below(int(units[0])), b"")]
    while open_nodes:
        base, prefix = open_nodes.pop()
        children = base ^ labels
        inside = children < len(units)
        for label in labels[inside][(units[children[inside]] & 0x800000FF) == labels[inside]].tolist():
            at, key = base ^ label, prefix + bytes([label])
            unit = int(units[at])
            down = at ^ below(unit)
            if unit & 0x100:
                start = int(units[down]) & 0x7FFFFFFF
                rules[key.decode("utf-8", "replace")] = texts[start : texts.index(b"\0", start)].decode()
            open_nodes.append((down, key))
    return rules


class CharMap:
    """Longest-prefix replacement with the source of every character it writes."""

    def __init__(self, rules: dict[str, str]):
        self.rules = {**rules, " ": rules.get(" ", " ").replace(" ", SPACE)}
        self.rules = {key: value.replace(" ", SPACE) for key, value in self.rules.items()}
        self.only_spaces = self.rules == {" ": SPACE}
        self.prefix = re.compile("|".join(map(re.escape, sorted(self.rules, key=len, reverse=True))))

    def text(self, text: str) -> str:
        if self.only_spaces:
            return text.replace(" ", SPACE)
        return self.prefix.sub(lambda match: self.rules[match[0]], text)

    def sources(self, text: str) -> np.ndarray:
        """First byte in ``text`` of each normalised character, and the end of the text."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        width = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        place = np.append(0, np.cumsum(width))
        if self.only_spaces:
            return place
        parts, done = [], 0
        for match in self.prefix.finditer(text):
            parts += [place[done : match.start()], np.full(len(self.rules[match[0]]), place[match.start()])]
            done = match.end()
        return np.concatenate([*parts, place[done:]])


class Encoder:
    """A byte-pair SentencePiece model with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        if spec.remove_extra_whitespaces or not model.trainer_spec.byte_fallback or model.trainer_spec.model_type != 2:
            raise ValueError("the encoder is for byte-pair models with byte fallback that keep white space")
        self.dummy = SPACE if spec.add_dummy_prefix else ""
        self.map = CharMap(compiled_rules(spec.precompiled_charsmap))
        ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (NORMAL, USER, UNUSED)}
        if any(a != SPACE and b == SPACE for piece in ids for a, b in zip(piece, piece[1:])):
            raise ValueError("pieces that go on after a word with a space are not handled")
        self.size = len(model.pieces)
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.surface = [
            bytes([int(p.piece[3:5], 16)]) if p.type == BYTE
            else b"" if p.type == CONTROL else p.piece.replace(SPACE, " ").encode()
            for p in model.pieces
        ]
        # Characters of each piece, and the byte of each byte piece (-1 for others).
        self.byte = np.full(self.size, -1, np.int64)
        for value, i in self.bytes.items():
            self.byte[i] = value
        self.chars = np.array([
            int(b & 0xC0 != 0x80) if b >= 0 else len(surface.decode()) for b, surface in zip(self.byte.tolist(), self.surface)
        ])
        # A character without a piece is the symbol size + its code point: no pair holds it.
        self.symbol = np.arange(0x110000, dtype=np.int32) + self.size
        for piece, i in ids.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        name = lambda part: int(self.symbol[ord(part)]) if len(part) == 1 else ids.get(part, -1)
        scores = np.array([model.pieces[i].score for i in ids.values()], np.float32)
        ranks = np.unique(-scores, return_inverse=True)[1]
        pairs = [
            (name(piece[:cut]), name(piece[cut:]), rank, i)
            for (piece, i), rank in zip(ids.items(), ranks.tolist())
            for cut in range(1, len(piece))
        ]
        self.merges = Merges(*zip(*[p for p in pairs if p[0] >= 0 and p[1] >= 0]))
        self.segments = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        self.digits = [str(i) for i in range(self.size)]
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, int] = {}  # segment -> its place among the next two
        self.first, self.count = np.empty(0, np.int64), np.empty(0, np.int64)
        self.pieces = np.empty(0, np.int32)

    def learn(self, new: list[str]) -> None:
        """Put the pieces of new segments into the memo."""
        codes = np.frombuffer("".join(new).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        symbols, counts = self.merges.merge(self.symbol[codes], sizes)
        unknown = np.flatnonzero(symbols >= self.size)
        if len(unknown):
            parts = [[self.bytes[b] for b in chr(s - self.size).encode()] for s in symbols[unknown].tolist()]
            width = np.ones(len(symbols), np.int64)
            width[unknown] = list(map(len, parts))
            fallback = np.zeros(len(symbols), bool)
            fallback[unknown] = True
            counts = np.bincount(np.repeat(np.arange(len(counts)), counts), width, len(counts)).astype(np.int64)
            symbols = np.repeat(symbols, width)
            symbols[np.repeat(fallback, width)] = [i for part in parts for i in part]
        self.memo.update(zip(new, range(len(self.memo), len(self.memo) + len(new))))
        self.first = np.append(self.first, len(self.pieces) + np.cumsum(counts) - counts)
        self.count = np.append(self.count, counts)
        self.pieces = np.append(self.pieces, symbols)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text."""
        if len(self.memo) > MEMO_ENTRIES:
            self.forget()
        cut = [self.segments(self.dummy + self.map.text(text)) if text else [] for text in texts]
        flat = [segment for one in cut for segment in one]
        new = list(set(flat).difference(self.memo))
        if new:
            self.learn(new)
        at = np.fromiter(map(self.memo.__getitem__, flat), np.int64, len(flat))
        count = self.count[at]
        ends = np.cumsum(count)
        ids = self.pieces[np.repeat(self.first[at] - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)]
        last = np.append(0, ends)[np.cumsum([len(one) for one in cut])] if cut else np.empty(0, np.int64)
        ids = ids.tolist()
        return [ids[a:b] for a, b in zip([0, *last.tolist()], last.tolist())]

    def spans(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """First and last byte (exclusive) in ``text`` of each piece of its encoding."""
        pieces = np.array(ids, np.int64)
        if not len(pieces):
            return pieces, pieces
        sources = np.append(np.zeros(len(self.dummy), np.int64), self.map.sources(text))
        chars = self.chars[pieces]  # the first byte of a character counts as it, further ones as none
        upto = np.cumsum(chars)
        begins, ends = sources[upto - chars], sources[upto]
        byte = self.byte[pieces]
        if (byte >= 0).any():
            further = (byte & 0xC0) == 0x80
            further[byte < 0] = False
            place = np.arange(len(pieces))
            nth = place - np.maximum.accumulate(np.where(further, 0, place))
            last = np.append(~further[1:], True)
            of_char = np.where(further, sources[upto - 1], begins)
            until = np.where(further, sources[np.minimum(upto, len(sources) - 1)], ends)
            begins = np.where(byte >= 0, np.minimum(of_char + nth, until), begins)
            ends = np.where(byte >= 0, np.where(last, until, np.minimum(of_char + nth + 1, until)), ends)
        return begins, ends

    def decode(self, ids: list[int]) -> str:
        data = b"".join(map(self.surface.__getitem__, ids))
        return data[1 if self.dummy and data.startswith(b" ") else 0 :].decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def located(model: Encoder, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """The ids of each text with the first and last byte (exclusive) of every piece."""
    for text, ids in zip(texts, model.encode(texts)):
        yield ids, *model.spans(text, ids)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, begins, ends): the pieces of each text and their byte spans in it."""
    kind = dict(docs.dtypes)[doc_id]

    def prepare():
        def work(ids, texts):
            out = {doc_id: ids, "ids": [], "begins": [], "ends": []}
            for pieces, begins, ends in located(encoder(path), texts):
                out["ids"].append(np.array(pieces, np.int32))
                out["begins"].append(begins)
                out["ends"].append(ends)
            return out

        return work

    schema = f"`{doc_id}` {kind}, ids array<int>, begins array<bigint>, ends array<bigint>"
    return per_text(docs, schema, prepare, doc_id, text, SPAN_BLOCK_CHARS)


def digest(docs: DataFrame, path: str) -> DataFrame:
    """Number of pieces and digests of the ids, of the text decoded from them, and of the pieces' byte spans.

    ``spans_sha256`` is of the begins and ends in turn, as 64-bit little-endian numbers.
    """

    def prepare():
        def work(ids, texts):
            out = {"doc_id": ids, "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "spans_sha256": []}
            model = encoder(path)
            for pieces, begins, ends in located(model, texts):
                out["n_tokens"].append(len(pieces))
                joined = ",".join(map(model.digits.__getitem__, pieces))
                out["ids_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(model.decode(pieces).encode()).hexdigest())
                places = np.column_stack([begins, ends]).astype("<i8")
                out["spans_sha256"].append(hashlib.sha256(places.tobytes()).hexdigest())
            return out

        return work

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_sha256 string"
    return per_text(docs, schema, prepare)
