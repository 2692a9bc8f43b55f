"""Token counts of a byte-level BPE vocabulary by compiled finite-state transducers.

Two transducers are composed. The splitter is a deterministic transducer over character
classes whose transitions say where a pre-token starts; it is compiled from the rules of the
split pattern. Texts are cut into chunks of equal length; for each chunk the map from any
state before it to the state after it is computed, all chunks in step, the maps are composed by
a parallel prefix scan, and with its true first state each chunk then emits its starts. The
merger is acyclic: an arc per distinct pre-token of the block, annotated with the number of
tokens that byte pair merges emit for it. A text's count is the sum over its arcs.

Strings of special tokens count as one token and end the pre-token before them, as the
library does by default.

Defined results: null and empty texts count 0; texts of any length are counted whole, a block of texts at a
time; repeated rows give repeated results.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from tokenizers.pre_tokenizers import ByteLevel

from plaudit.llm.bpe import Merges
from plaudit.llm.common import per_text

CHUNK = 128
#: Pre-tokens of up to so many bytes are told apart as machine words, longer ones as strings.
WORDS = 4

# Character classes. LETTER to LETTER_E are letters; BREAK stands between texts.
LETTER, LETTER_STMD, LETTER_R, LETTER_V, LETTER_L, LETTER_E, DIGIT, OTHER, QUOTE, BLANK, WHITE, BREAK = range(12)
# States. The last three have read a quote that starts a pre-token and a letter that may complete 're, 've, 'll.
START, IN_LETTERS, IN_DIGITS, IN_OTHER, AFTER_BLANK, AFTER_WHITE, AFTER_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(10)
HERE, BEFORE = 1, 2  # a pre-token starts at this character; at the one before it


def transition(state: int, kind: int) -> tuple[int, int]:
    """The next state and what is emitted, by the rules of the split pattern.

    's 't 're 've 'm 'll 'd | blank? letters | blank? digits | blank? others | white space not
    before a visible character | white space
    """
    letter = kind <= LETTER_E
    run = IN_LETTERS if letter else {
        DIGIT: IN_DIGITS, OTHER: IN_OTHER, QUOTE: AFTER_QUOTE, BLANK: AFTER_BLANK, WHITE: AFTER_WHITE, BREAK: START
    }[kind]
    white = kind in (BLANK, WHITE)
    if state in (QUOTE_R, QUOTE_V, QUOTE_L):
        if kind == (LETTER_L if state == QUOTE_L else LETTER_E):
            return START, 0
        after, emitted = transition(IN_LETTERS, kind)  # the quote stood alone, letters began after it
        return after, emitted | BEFORE
    if kind == BREAK:
        return START, 0
    if state == AFTER_QUOTE:
        if kind == LETTER_STMD:
            return START, 0
        if kind in (LETTER_R, LETTER_V, LETTER_L):
            return {LETTER_R: QUOTE_R, LETTER_V: QUOTE_V, LETTER_L: QUOTE_L}[kind], 0
        if kind in (OTHER, QUOTE):
            return IN_OTHER, 0
    if state in (AFTER_BLANK, AFTER_WHITE) and white:
        return run, 0
    if state == AFTER_BLANK:  # the last blank goes with what follows; a quote after it is no contraction
        return (IN_OTHER if kind == QUOTE else run), BEFORE
    if state == AFTER_WHITE:
        return run, BEFORE | HERE
    if (state == IN_LETTERS and letter) or (state == IN_DIGITS and kind == DIGIT):
        return state, 0
    if state == IN_OTHER and kind in (OTHER, QUOTE):
        return state, 0
    return run, HERE


@lru_cache(maxsize=1)
def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next states (as row offsets) and emissions, by state * 12 + class."""
    steps = [transition(state, kind) for state in range(10) for kind in range(12)]
    return np.array([s * 12 for s, _ in steps], np.uint8), np.array([e for _, e in steps], np.uint8)


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point, by its general category.

    Characters on which Python's tables and newer ones disagree are put to the library's
    own splitter, so that classes are those of its version of Unicode.
    """
    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    kinds = np.full(0x110001, OTHER, np.uint8)
    codes = [code for code in range(0x110000) if not 0xD800 <= code < 0xE000]
    text = "".join(map(chr, codes))
    for kind, known, newer, before in ((LETTER, "L", r"\p{L}", "a"), (DIGIT, "N", r"\p{N}", "1")):
        here = {code for code in codes if unicodedata.category(chr(code))[0] == known}
        there = set(map(ord, regex.findall(newer, text)))
        asked = {code for code in here ^ there if len(split(before + chr(code))) == 1}
        kinds[list((here & there) | asked)] = kind
    for code in [*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]:
        kinds[code] = WHITE
    for letters, kind in (("stmd", LETTER_STMD), ("r", LETTER_R), ("v", LETTER_V), ("l", LETTER_L), ("e", LETTER_E)):
        for letter in letters:
            kinds[ord(letter)] = kind
    kinds[ord("'")], kinds[ord(" ")], kinds[0x110000] = QUOTE, BLANK, BREAK
    return kinds


def starts(kinds: np.ndarray) -> np.ndarray:
    """Where pre-tokens start, in a string of classes that begins in state START."""
    after, emits = splitter()
    n = len(kinds)
    rows = -(-n // CHUNK) if n else 0
    padded = np.full(rows * CHUNK, BREAK, np.uint8)
    padded[:n] = kinds
    columns = np.ascontiguousarray(padded.reshape(rows, CHUNK).T)
    # The map of every chunk: the state after it (a row offset) for each state before it.
    maps = np.repeat(np.arange(10, dtype=np.uint8)[:, None] * 12, rows, axis=1)
    for column in columns:
        maps = after[maps + column]
    states = maps // 12
    step = 1
    while step < rows:  # prefix scan: chunk i takes in the map of chunks up to i - step
        states[:, step:] = np.take_along_axis(states[:, step:], states[:, :-step], axis=0)
        step *= 2
    state = np.append(np.zeros(1, np.uint8), states[START, :-1] * 12)[:rows]
    emitted = np.empty((CHUNK, rows), np.uint8)
    for i, column in enumerate(columns):
        at = state + column
        emitted[i] = emits[at]
        state = after[at]
    emitted = emitted.T.reshape(-1)[:n]
    out = (emitted & HERE).astype(bool)
    out[:-1] |= (emitted[1:] & BEFORE).astype(bool)
    return np.flatnonzero(out)


class Counter:
    """Counts tokens of texts with a byte-level BPE vocabulary in the tokenizers' JSON format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split, model = spec["pre_tokenizer"], spec["model"]
        plain = spec["normalizer"] is None and split["type"] == "ByteLevel" and split["use_regex"]
        if not plain or split["add_prefix_space"] or model["type"] != "BPE" or model.get("ignore_merges"):
            raise ValueError("the counter is for byte-level BPE without normaliser or prefix space")
        added = [t["content"] for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take in their surroundings are not handled")
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        # Bytes are written as characters: printable ones as they are, the others from 256 on.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        hidden = [b for b in range(256) if b not in shown]
        names = {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}
        vocab = model["vocab"]
        self.byte_id = np.array([vocab[names[b]] for b in range(256)], np.int32)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = Merges(
            [vocab[a] for a, _ in merges], [vocab[b] for _, b in merges], range(len(merges)),
            [vocab[a + b] for a, b in merges],
        )

    def arcs(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Tokens of every pre-token ``data[begin : begin + size]``; each distinct one is merged once."""
        counts = np.zeros(len(begin), np.int64)
        padded = np.append(data, np.zeros(8 * WORDS, np.uint8))
        words = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(padded) - 7,), (1,))
        short = np.flatnonzero(size <= 8 * WORDS)
        long = np.flatnonzero(size > 8 * WORDS)
        parts = np.zeros((WORDS, len(short)), np.uint64)
        for k in range(WORDS):
            left = size[short] - 8 * k
            has = np.flatnonzero(left > 0)
            mask = np.uint64(2**64 - 1) >> (np.uint64(8) * (8 - np.minimum(left[has], 8)).astype(np.uint64))
            parts[k, has] = words[begin[short[has]] + 8 * k] & mask
        hashed = size[short].astype(np.uint64)
        for part, odd in zip(parts, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)):
            hashed = (hashed ^ part) * np.uint64(odd)
            hashed ^= hashed >> np.uint64(29)
        _, first, of = np.unique(hashed, return_index=True, return_inverse=True)
        alike = size[short] == size[short[first]][of]
        for part in parts:
            alike &= part == part[first][of]
        odd_ones = np.flatnonzero(~alike)  # hashes that collide: told apart as strings
        strings: dict[bytes, list[int]] = {}
        for i in np.concatenate([long, short[odd_ones]]).tolist():
            strings.setdefault(data[begin[i] : begin[i] + size[i]].tobytes(), []).append(i)
        chosen = np.concatenate([short[first], np.array([places[0] for places in strings.values()], np.int64)])
        sizes = size[chosen].astype(np.int64)
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(begin[chosen] - ends + sizes, sizes) + np.arange(total)
        _, tokens = self.merges.merge(self.byte_id[data[at]], sizes)
        counts[short] = tokens[: len(first)][of]
        for places, count in zip(strings.values(), tokens[len(first) :]):
            counts[places] = count
        return counts

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        special = np.zeros(len(texts), np.int64)
        parts: list[list[str]] = []
        for i, text in enumerate(texts):
            pieces = self.special.split(text) if self.special else [text]
            special[i] = len(pieces) - 1
            parts.append(pieces)
        flat = [piece for pieces in parts for piece in pieces]
        lengths = np.fromiter(map(len, flat), np.int64, len(flat))
        joined = "".join(flat)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        # A BREAK after every part.
        place = np.arange(len(codes)) + np.repeat(np.arange(len(flat)), lengths)
        kinds = np.full(len(codes) + len(flat), BREAK, np.uint8)
        kinds[place] = classes()[codes]
        width = np.zeros(len(kinds), np.int64)
        width[place] = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000).astype(np.int64)
        to_byte = np.append(0, np.cumsum(width))
        begins = starts(kinds)
        ends = np.cumsum(lengths) + np.arange(len(flat))  # places of the breaks
        if len(begins):
            until = np.minimum(np.append(begins[1:], len(kinds)), ends[np.searchsorted(ends, begins)])
            data = np.frombuffer(joined.encode(), np.uint8)
            tokens = self.arcs(data, to_byte[begins], to_byte[until] - to_byte[begins])
            text_of = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
            owner = text_of[np.searchsorted(ends, begins)]
            special += np.bincount(owner, tokens, len(texts)).astype(np.int64)
        return special.tolist()


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(
    docs: DataFrame, path: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every document."""
    kind = dict(docs.dtypes)[doc_id]

    def prepare():
        def work(ids, texts):
            tokens = counter(path).count(texts)
            return {
                doc_id: ids, "n_bytes": [len(t.encode()) for t in texts], "n_tokens": tokens,
                "over_limit": [n > limit for n in tokens],
            }

        return work

    schema = f"`{doc_id}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return per_text(docs, schema, prepare, doc_id, text)
