"""Contexts beyond the previous match, and chains of patterns of any length."""

import random
import re

from plaudit.llm import pii

TEXT = "member ids 123456a 234567b,345678c and " + "x" * 90 + " 10.0.0.1 10.0.0.2 " + "9 12-34567 " * 60


def plain_pattern(text, start):
    found = re.search(r"(\S+\s+\S+)\s*$", text[max(0, start - pii.CONTEXT_CHARS) : start])
    return re.sub("[0-9]", "0", found.group(1).lower()) if found else ""


def test_contexts_come_from_the_whole_text(spark):
    row = pii.found_in(spark.createDataFrame([(1, TEXT)], "doc_id bigint, text string")).first()
    assert "ids 000000a" in [c.pattern for c in row.candidates]
    for span in [*row.base, *row.candidates]:
        assert TEXT[span.start : span.end] == span.value and span.pattern == plain_pattern(TEXT, span.start)


def test_chains_of_patterns_are_followed_to_their_end(spark, monkeypatch):
    monkeypatch.setattr(pii, "CONFIDENT", 0.01)  # each step halves the confidence
    base = [(0, f"0-{i}", "p0") for i in range(3)]
    candidates = [(f"{k + d}-{i}", f"p{k}") for k in range(5) for d in (0, 1) for i in range(3) if k + d]
    spans = spark.createDataFrame(
        [(base, candidates)],
        "base array<struct<kind int, value string, pattern string>>, candidates array<struct<value string, pattern string>>",
    )
    assert {r.value for r in pii.bootstrapped(spans).collect()} == {f"{k}-{i}" for k in range(1, 6) for i in range(3)}


def planted(rng):
    """Texts with seeds and, for a third of all values, forms that no base pattern knows; and the spans of those."""
    words = ["the", "of", "and", "river", "stone", "light", "paper", "green", "winter", "garden"]

    def luhn(digits):
        total = sum(int(d) if k % 2 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits)))
        return digits + str(-total % 10)

    def digits(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    contexts = {
        "phone": ["call me at {} today", "my phone: {} (office)", "please ring {} or write"],
        "card": ["the card number {} expires", "paid with visa {} online", "please charge {} or write"],
    }
    seed = {"phone": lambda: f"+49 171 {digits(7)}", "card": lambda: luhn("4" + digits(14))}
    hidden = {"phone": lambda: f"0171-{digits(7)}", "card": lambda: f"4{digits(3)}-{digits(4)}-X{digits(4)}"}
    decoys = [
        ("order number {} shipped", lambda: digits(9)), ("the {} of", lambda: digits(3)), ("at {} today", lambda: digits(2) + ":30"),
        ("part {} online", lambda: f"A{digits(6)}"), ("the {} of", lambda: digits(8)), ("the number {} of", lambda: luhn(digits(15))[:15] + "x"),
    ]
    rows, truth = [], set()
    for i in range(600):
        filler = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 9))) for _ in range(2)]
        template, value = rng.choice(decoys)
        value, kind = value(), None
        if i % 3:
            kind = rng.choice(["phone", "card"])
            template = rng.choice(contexts[kind])
            value = (hidden if i % 9 in (1, 4) else seed)[kind]()
        before = f"{filler[0]} {template[: template.index('{')]}"
        if kind and i % 9 in (1, 4):
            truth.add((i, f"{kind}:{len(before)}:{len(before) + len(value)}"))
        rows.append((i, f"{before}{value}{template[template.index('}') + 1 :]} {filler[1]}"))
    return rows, truth


def test_hidden_identifiers_are_found_and_other_numbers_left(spark):
    rows, truth = planted(random.Random(8))
    texts = dict(rows)
    found = set()
    for r in pii.digest(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        for span in filter(None, r.spans.split(",")):
            kind, start, end = span.split(":")
            if not re.fullmatch(pii.PATTERNS[kind].replace(r"(?:\G|(?<![0-9]))", ""), texts[r.doc_id][int(start) : int(end)]):
                found.add((r.doc_id, span))
    recall, precision = len(found & truth) / len(truth), len(found & truth) / max(len(found), 1)
    print(f"hidden {len(truth)}, found {len(found)}, recall {recall:.3f}, precision {precision:.3f}")
    assert len(truth) > 100 and recall >= 0.9 and precision >= 0.95


def test_unseen_values_do_not_speak_against_a_pattern_and_added_spans_do_not_touch(spark):
    rows = [(i, f"write to a{i}@b.org soon or dial +1 555 {1000000 + i} now") for i in range(12)]
    rows += [(100 + i, f"or dial {i:04d}-5551 now") for i in range(500)]
    rows += [(900, "or dial +1 555 7654321-99 now"), (901, "or dial 1234-5551 now, or dial 8765-4321-12@b.org now"), (None, "or dial 77-5551 now")]
    spans = {r.doc_id: r.spans for r in pii.digest(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(spans[100 + i] == "phone:8:17" for i in range(500))
    assert spans[900] == "phone:8:25" and spans[901] == "email:31:49,phone:8:17" and spans[None] == "phone:8:15"
