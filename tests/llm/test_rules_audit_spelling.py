"""Quality rules, filter audit and spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

import edge_tables
from plaudit.llm import audit, rules, spelling
from plaudit.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def edge(spark, tmp_path_factory):
    return edge_tables.write(spark, str(tmp_path_factory.mktemp("edge")))


def rows_of(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet").collect()


def counted(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text, one window after the other."""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    covered = {i + k for i, window in enumerate(windows) if times[window] > 1 for k in range(8)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered)


@pytest.mark.parametrize("tables", ["edge", "given"])
def test_base_rules_are_those_of_brute_force(spark, request, tables):
    folder = request.getfixturevalue("edge") if tables == "edge" else SF
    docs = rows_of(spark, folder, "documents")
    expected = Counter()
    for row in docs:
        n = counted(row.text or "")
        expected[(row.doc_id, *n, n[0] < 20 or 100 * n[4] > 30 * n[0])] += 1
    found = QUERIES["op11_quality_rules"](spark, folder).collect()
    assert Counter(tuple(row)[:7] for row in found) == expected
    assert not any(row.kept for row in found if row.base_failed)


def test_repeated_words_of_made_texts():
    rng = random.Random(3)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(300)] + ["a " * 50, "\x1c".join("abcdefghi") * 2]
    words = rules.Words(texts)
    assert words.repeated().tolist() == [counted(t)[4] for t in texts]
    assert words.counts.tolist() == [counted(t)[0] for t in texts]


def distance(p, q):
    """Jensen-Shannon distance of two histograms by its definition, less the part of chance."""
    n, bins = sum(p), sum(a + b > 0 for a, b in zip(p, q))
    p, q = [a / sum(p) for a in p], [b / sum(q) for b in q]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    half = [sum(a * np.log2(a / c) for a, c in zip(x, m) if a) for x in (p, q)]
    return np.sqrt(max(sum(half) / 2 - (bins - 1) / (8 * n * np.log(2)), 0))


def test_distances_and_references_are_those_of_brute_force(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").repartition(3)
    rows = docs.collect()
    good = [r for r in rows if (n := counted(r.text))[0] >= 20 and 100 * n[4] <= 30 * n[0]]
    expected = {}
    for lang in {r.lang for r in rows}:
        words = Counter(rules.bare(w.encode()) for r in good if r.lang == lang for w in WORD.findall(r.text))
        chars = Counter(int(rules.class_table()[ord(c)]) for r in good if r.lang == lang for c in r.text)
        total = words.total()
        words.pop("", None)
        if total >= rules.LEAST_WORDS:
            common = sorted(words.items(), key=lambda item: (-item[1], item[0].encode()))[: rules.COMMON]
            expected[lang] = (total, [w for w, _ in common], [n for _, n in common], [chars[k] for k in range(len(rules.CLASSES))])
    refs = rules.references(docs)
    found = {r.lang: (r.n_words, r.words, r.word_counts, r.classes) for r in refs.collect()}
    assert found == expected and len(found) >= 1
    judged = {r.doc_id: r for r in rules.judged(docs, refs).collect()}
    checked = 0
    for row in rows:
        got = judged[row.doc_id]
        if row.lang not in expected or got.n_words < rules.LEAST_TEXT_WORDS:
            continue
        total, words, counts, classes = expected[row.lang]
        own = Counter(rules.bare(w.encode()) for w in WORD.findall(row.text))
        bins = [own[w] for w in words]
        by_word = distance([*bins, got.n_words - sum(bins)], [*counts, total - sum(counts)])
        chars = Counter(int(rules.class_table()[ord(c)]) for c in row.text)
        by_class = distance([chars[k] for k in range(len(classes))], classes) if len(row.text) >= rules.LEAST_CHARS else 0.0
        if by_class <= rules.CLASS_BOUND and by_word <= rules.WORD_BOUND:
            assert (got.class_distance, got.word_distance) == pytest.approx((by_class, by_word), abs=1e-9)
            assert got.kept != got.base_failed
            checked += 1
    assert checked > 50


def test_what_is_no_language_fails_and_clean_texts_stay(spark):
    rng = random.Random(5)
    common = "the of and to in is that for was on with as be by this are it from".split()
    rare = ["".join(rng.choice("abcdefghilmnoprstuv") for _ in range(rng.randint(3, 9))) for _ in range(3000)]

    def prose(n):
        return " ".join(rng.choice(common) if rng.random() < 0.45 else rng.choice(rare) for _ in range(n)).capitalize() + "."

    def noise(n):
        return " ".join("".join(rng.choice("#$%0123456789{}[]=;") for _ in range(7)) for _ in range(n))

    rows = [(i, prose(rng.randint(60, 300)), ("en", None, "xx")[i % 3] if i % 5 == 0 else "en") for i in range(300)]
    rows += [(1000 + i, noise(100), "en" if i % 2 else None) for i in range(10)]
    rows += [(2000 + i, " ".join(rng.choice(rare) for _ in range(200)), "en") for i in range(10)]  # no common word
    rows += [(3000, noise(30)[:190], "en")]  # too short to be judged
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = {r.doc_id: r.kept for r in rules.judged(docs, rules.references(docs)).collect()}
    assert all(kept[i] for i in range(300)) and kept[3000]
    assert not any(kept[i] for i in kept if 1000 <= i < 3000)


def audit_by_hand(docs, labels):
    good = {r.doc_id for r in labels if r.quality == 1 and r.doc_id is not None}
    toxic = {r.doc_id for r in labels if r.toxic == 1 and r.doc_id is not None}
    rows, first = [], {}
    for r in docs:
        if r.doc_id is not None:
            text = r.text or ""
            first[text] = min(first.get(text, r.doc_id), r.doc_id)
    for r in docs:
        text = r.text or ""
        words = WORD.findall(text)
        failed = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), "D": bool(set(text) & set("#$%&*|")),
            "E": r.doc_id is not None and first[text] < r.doc_id,
        }
        rows.append((r.lang or "", {name for name in failed if failed[name]}, r.doc_id in good, r.doc_id in toxic))
    result, shapley = {}, Counter()
    for part in {row[0] for row in rows}:
        mine = [row for row in rows if row[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, name in enumerate(order, 1):
                out = [row for row in left if name in row[1]]
                redundant = sum(name in row[1] for row in mine) - len(out)
                left = [row for row in left if name not in row[1]]
                shapley[part, name] += len(out)
                result[part, order, step] = (
                    len(left), len(out), redundant, sum(row[1] == {name} for row in mine), sum(row[2] for row in out), sum(row[3] for row in out)
                )
    return {key: (*value, shapley[key[0], key[1][key[2] - 1]]) for key, value in result.items()}


@pytest.mark.parametrize("tables", ["edge", "given"])
def test_audit_is_that_of_applying_every_order(spark, request, tables):
    folder = request.getfixturevalue("edge") if tables == "edge" else SF
    expected = audit_by_hand(rows_of(spark, folder, "documents"), rows_of(spark, folder, "labels"))
    found = QUERIES["op12_filter_audit"](spark, folder).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found} == expected
    assert len(found) == len(expected)


def test_paths_through_the_lattice():
    lattice = audit.Lattice("ABCDE")
    assert lattice.forward[31] == lattice.backward[0] == 120 and lattice.backward[31] == lattice.forward[0] == 1
    through = Counter()
    for _, _, state, f in lattice.step_rows():
        through[state, f] += 1
    assert all(lattice.orders_through(*edge) == through[edge] for edge in lattice.edges) and len(lattice.edges) == 80
    with pytest.raises(ValueError):
        audit.Lattice("ABCDEFG")


def test_audit_of_chosen_orders_without_copies(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "A b", "x"), (3, "AA", None)], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    counts = audit.failure_counts(docs, labels, lambda t: {"capital": t.rlike("[A-Z]"), "b": F.contains(t, F.lit("b"))}, copies=False)
    lattice = audit.Lattice(["capital", "b"])
    assert {(r.part, r.mask): (r.n, r.good) for r in counts.collect()} == {("x", 2): (1, 1), ("x", 3): (1, 0), ("", 1): (1, 0)}
    found = {(r.part, r.step): (r.kept, r.removed, r.shapley) for r in audit.steps(spark, counts, lattice, [("b", "capital")]).collect()}
    assert found == {("x", 1): (0, 2, 3), ("x", 2): (0, 0, 1), ("", 1): (1, 0, 0), ("", 2): (0, 1, 2)}


def variants_by_hand(docs):
    counts = Counter()
    for r in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = near_by_hand(words)
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None

    def root(w):
        return w if forms[w] is None else root(forms[w])

    return {w: (forms[w], root(w), n, len(near[w]), words.get(forms[w])) for w, n in words.items()}


def near_by_hand(words):
    """By the words that are left when a letter goes: at the same place of words as long, or in the shorter word."""
    gaps, near = {}, {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            gaps.setdefault((i, w[:i] + w[i + 1 :]), set()).add(w)
    for (_, rest), those in gaps.items():
        for w in those:
            near[w] |= those - {w}
            if rest in near:
                near[w].add(rest)
                near[rest].add(w)
    return near


def found_variants(spark, docs):
    return {r.word: tuple(r)[1:] for r in spelling.variants(docs).collect()}


@pytest.mark.parametrize("subtrie", [20, spelling.SUBTRIE])
def test_variants_are_those_of_brute_force(spark, monkeypatch, subtrie):
    monkeypatch.setattr(spelling, "SUBTRIE", subtrie)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = found_variants(spark, docs)
    assert found == variants_by_hand(docs.collect())
    assert sum(v[3] for v in found.values()) > 1000 and any(v[0] not in (None, v[1]) for v in found.values())


def test_variants_on_edges(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    assert found_variants(spark, docs) == variants_by_hand(docs.collect())


def test_crowded_leaves_long_words_and_chains(spark, monkeypatch):
    """Words of two letters share their leaves, far more than a subtrie's; some words are very long; forms of forms."""
    monkeypatch.setattr(spelling, "SUBTRIE", 16)
    monkeypatch.setattr(spelling, "SEARCHES", 64)
    rng = random.Random(9)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 8))) for _ in range(700)]
    words += ["z" * 40_000, "z" * 40_001, "z" * 39_999 + "y", "chained", "chaine", "chain", "chainz"]
    times = [rng.randint(3, 9) for _ in words[:-4]] + [4, 8, 16, 16]
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(zip(words, times))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = found_variants(spark, docs)
    assert found == variants_by_hand(docs.collect())
    assert found["z" * 40_001][3] >= 1 and found["chained"][1] == "chain"
