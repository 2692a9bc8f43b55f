"""Secret scans: an Aho-Corasick pass over keywords, anchored patterns only at its hits, checksums last.

Keywords are searched in the text with A-Z lowered. At each hit the pattern of its kind is
matched from the keyword's first character. Long runs of hexadecimal digits have no keyword:
every 32nd character is looked at, as a run of 32 must hold one of them, and the run
round a hit is measured. Tokens with an embedded checksum (the last six of 36 characters are the
CRC-32 of the others in base 62) count only if it is right.

Defined results: null and empty texts have no spans; spans are in code points, end exclusive;
whole texts of any length are scanned; repeated rows give repeated results.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from plaudit.llm.common import per_text, sha256

#: Kinds in the order of reports; those after "hex" are added by checksum (fixed values).
KINDS = ("assign", "access", "hex", "github", "npm")
BASE_KINDS = KINDS[:3]
#: Words that start a match, and the kind that each starts (fixed values).
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign",
    "api_key": "assign", "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github",
    "ghs_": "github", "ghr_": "github", "npm_": "npm",
}
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
CHECKED = re.compile(r"(?:gh[opusr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
HEX_RUN = 32
HEX_DIGIT = re.compile("[0-9a-f]")
HEX_REST = re.compile("[0-9a-f]*")


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    words = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        words.add_word(word, (kind, len(word)))
    words.make_automaton()
    return words


def checksum(body: str) -> str:
    """CRC-32 of the token's body in base 62, six characters."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, place = divmod(value, 62)
        digits = BASE62[place] + digits
    return digits


def hex_runs(text: str) -> list[tuple[int, int]]:
    """Runs of at least 32 lower-case hexadecimal digits."""
    found, done = [], 0
    for hit in HEX_DIGIT.finditer(text[HEX_RUN - 1 :: HEX_RUN]):
        at = hit.start() * HEX_RUN + HEX_RUN - 1
        if at < done:
            continue
        start = at
        while start > done and text[start - 1] in "0123456789abcdef":
            start -= 1
        done = HEX_REST.match(text, at).end()
        if done - start >= HEX_RUN:
            found.append((start, done))
    return found


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then in the order of kinds."""
    lowered = text.encode().lower().decode()  # A-Z only, so that places stay
    hits = sorted((end - size + 1, kind) for end, (kind, size) in automaton().iter(lowered))
    done = {"assign": 0, "access": 0}
    found = [("hex", *run) for run in hex_runs(text)]
    for start, kind in hits:
        if start < done.get(kind, 0):
            continue
        if kind == "assign":
            match = ASSIGN.match(lowered, start)
            good = match and len(match[1]) >= 8
        elif kind == "access":
            match = ACCESS.match(text, start)
            good = match and match.end() - start >= 16
        else:
            match = CHECKED.match(text, start)
            good = match and checksum(match[1]) == match[2]
        if match and kind in done:
            done[kind] = match.end()
        if good:
            found.append((kind, start, match.end()))
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0])))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans: array of (kind, start, end)) for every document."""
    kind = dict(docs.dtypes)[doc_id]

    def prepare():
        return lambda ids, texts: {
            doc_id: ids, "spans": [[dict(zip(("kind", "start", "end"), s)) for s in find_secrets(t)] for t in texts]
        }

    return per_text(
        docs, f"`{doc_id}` {kind}, spans array<struct<kind string, start bigint, end bigint>>", prepare, doc_id, text
    )


def span_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


@F.pandas_udf(StringType())
def redacted(texts):
    """The text with every secret replaced by its kind in brackets; overlapping spans become one."""

    def clean(text):
        if not isinstance(text, str):
            return None
        parts, done = [], 0
        for kind, start, end in find_secrets(text):
            if start >= done:
                parts += [text[done:start], f"[{kind}]"]
            done = max(done, end)
        return "".join([*parts, text[done:]]) if parts else text

    return texts.map(clean)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with their secrets replaced; all rows and columns stay."""
    return docs.withColumn(text, redacted(F.col(text)))


def digest(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans of each document."""

    def prepare():
        def work(ids, texts):
            spans = [find_secrets(t) for t in texts]
            base = [[s for s in one if s[0] in BASE_KINDS] for one in spans]
            counts = {f"n_{k}": [sum(s[0] == k for s in one) for one in base] for k in BASE_KINDS}
            return {
                "doc_id": ids, **counts, "base_sha256": [sha256(span_text(one)) for one in base],
                "spans": [span_text(one) for one in spans],
            }

        return work

    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return per_text(docs, schema, prepare)
