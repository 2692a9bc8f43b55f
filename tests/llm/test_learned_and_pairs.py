"""Classifiers by held-out accuracy; near copies, neighbours and mixing against brute force."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from compare import differences, oracle_connection  # noqa: E402
from plaudit.llm import forest, itq, minhash, mixing, toxicity  # noqa: E402
from plaudit.llm.components import components  # noqa: E402
from plaudit.llm.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.01"


def held_out_scores(spark, name, label):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in QUERIES[name](spark, SF).collect() if r.held_out and r.doc_id in labels]
    y, score = np.array([labels[r.doc_id] for r in rows]), np.array([r.score for r in rows])
    better = score[y == 1][:, None] - score[y == 0][None, :]
    return (better > 0).mean() + (better == 0).mean() / 2, score


@pytest.mark.parametrize("name, label, least", [("op1_toxicity", "toxic", 0.55), ("op10_quality", "quality", 0.8)])
def test_held_out_documents(spark, name, label, least):
    """About 40 toxic documents teach little; the README has the figures of larger tables."""
    area, score = held_out_scores(spark, name, label)
    assert area > least and score.min() >= 0 and score.max() <= 1


@pytest.mark.parametrize("marked", [["blockhead", "dimwitted", "pigfaced"], ["oaf", "yob", "wimp"], ["utter dolt", "go rot"]])
def test_toxic_dictionary_learns_marked_words(marked):
    """Long words, short ones, and phrases."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("aeioutnsr") for _ in range(rng.randint(2, 9)))
    plain = lambda n: [word() for _ in range(n)]

    def text(toxic):
        words = plain(rng.randint(50, 300))
        for _ in range(len(words) // 30 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(marked)
        return " ".join(words)

    y = np.array([i % 4 == 0 for i in range(1600)], int)
    texts = [text(k) for k in y]
    model = toxicity.Model(texts[:1200], y[:1200], np.ones(1200), np.arange(1200) % 3 == 0)
    assert ((model.scores(texts[1200:]) >= 0.5) == y[1200:]).mean() > 0.9


def test_passages_are_runs_of_marked_words():
    found = toxicity.passages(["An Oaf, you dolt oaf! sits", "oaf", "", "none here"], {b"oaf", b"dolt"})
    assert found == [b" oaf,", b" dolt oaf!", b"oaf"]


def test_without_both_classes_the_score_is_constant():
    model = toxicity.Model(["a b c"], np.array([1]), np.ones(1), np.array([False]))
    assert model.scores(["x", ""]).tolist() == [1.0, 1.0]


def plain_groups(texts):
    sets = {i: minhash.shingle_set(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if minhash.similar(sets[a], sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_texts():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    texts, n = {}, 0
    for group in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 60, 300]))]
        for _ in range(rng.choice([1, 3, 25])):
            copy = list(base)
            for _ in range(int(len(copy) * rng.choice([0, 0.01, 0.03, 0.05]))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts[n] = " ".join(copy).replace(" ", "\n", 1).upper() if n % 5 == 0 else " ".join(copy)
            n += 1
    return {**texts, 900: "", 901: " \n", 902: "one two", 903: "ONE  two", 904: "one two three"}


@pytest.mark.parametrize("block", [7, minhash.BUCKET_BLOCK])
def test_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BUCKET_BLOCK", block)
    texts = near_texts()
    rows = minhash.groups(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == plain_groups(texts)


def row_groups(rows):
    """The smallest id that each row with words reaches, through links of texts and through ids, by brute force."""
    sets = [minhash.shingle_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and (rows[i][0] == rows[j][0] or minhash.similar(sets[i], sets[j])):
                root[find(i)] = find(j)
    return sorted(
        (d, len(sets[i]), min(rows[j][0] for j in range(len(rows)) if sets[j] and find(j) == find(i)) if sets[i] else d)
        for i, (d, _) in enumerate(rows)
    )


def test_ids_that_repeat_with_other_texts_lose_no_link(spark):
    a, b = (" ".join(f"{k}{i}" for i in range(60)) for k in "ab")
    rows = [(1, a), (5, b), (5, a + " z"), (9, b + " z")]
    rng = random.Random(4)
    texts = list(near_texts().values())
    rows += [(rng.randrange(20, 140), rng.choice(texts)) for _ in range(120)] + [(5, ""), (30, None), (200, a + " y"), (200, a + " y")]
    plain = [(d, t or "") for d, t in rows]
    found = minhash.groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(map(tuple, found)) == row_groups(plain)


def test_a_hot_bucket_is_dealt_over_many_tasks(spark):
    from plaudit.llm.units import with_totals

    rows = spark.range(3000).selectExpr("id AS row", "if(id % 3 = 0, 0, id) AS bucket")
    got = with_totals(
        rows, "bucket", "row", [F.min("row").alias("least"), F.count(F.lit(1)).alias("size")],
        [F.min("least").alias("least"), F.sum("size").alias("size")], "size > 1",
    )
    assert {tuple(r) for r in got.collect()} == {(0, i, 0, 1000) for i in range(0, 3000, 3)}
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(32))).groupBy("bucket", "salt").count()
    assert salted.agg(F.max("count")).first()[0] < 100


def test_text_keys_are_those_of_sql(spark):
    texts = ["", "a", "héllo 🎉", "x" * 1000]
    keys = spark.createDataFrame([(t,) for t in texts], "text string").select(F.xxhash64("text")).collect()
    assert [k[0] for k in keys] == list(map(minhash.text_key, texts))


def test_sketches_estimate_the_similarity():
    rng = np.random.default_rng(6)
    for size in (1, 4, 40, 4000):
        a = rng.integers(0, 2**63, size, dtype=np.uint64)
        b = np.concatenate([a[: -(-size * 3 // 4)], rng.integers(0, 2**63, size - -(-size * 3 // 4), dtype=np.uint64)])
        bins = minhash.sketches(np.concatenate([a, b, a]), np.array([size, size, size]))
        assert (bins != minhash.EMPTY).all() and (bins[0] == bins[2]).all()
        common = len(set(a.tolist()) & set(b.tolist()))
        assert abs((bins[0] == bins[1]).mean() - common / (2 * size - common)) < 0.2


def test_long_chains_are_one_component(spark):
    links = spark.range(200).selectExpr("id a", "id + 1 b").union(spark.createDataFrame([(500, 501), (7, 7)], "a bigint, b bigint"))
    found = {r.id: r.component for r in components(links, "chain").collect()}
    assert set(found[i] for i in range(201)) == {0} and found[501] == 500


def vectors_with_copies(n=600, size=32):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(n, size)).astype(np.float32)
    for i in range(0, 200):  # near copies in chains and stars, around the limit
        x[i] = x[i // 10 * 10] + rng.normal(size=size) * rng.choice([0.0, 0.1, 0.3, 0.4]) * (i % 10 > 0)
    return x


@pytest.mark.parametrize("block", [5, itq.BUCKET_BLOCK])
def test_near_embeddings(spark, monkeypatch, block):
    monkeypatch.setattr(itq, "BUCKET_BLOCK", block)
    x = vectors_with_copies()
    label = np.arange(len(x)) // 300
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label))]
    got = {r.vec_id: r for r in itq.near_embeddings(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (u @ u.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    wanted = near.sum(axis=1)
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= wanted).all() and found.sum() >= 0.97 * wanted.sum() > 0
    root = list(range(len(x)))
    for i, j in sorted(zip(*np.nonzero(near))):
        low, high = sorted((root[i], root[j]))
        root = [low if r == high else r for r in root]
    # Links that are found join no vectors that hang not together, and all but a few hang together as they do.
    assert all(root[got[i].component_id] == root[i] and got[i].component_id <= i for i in range(len(x)))
    assert np.mean([got[i].component_id == root[i] for i in range(len(x))]) >= 0.99
    assert len(set(root)) < len(x) - 50


@pytest.mark.parametrize("blocks", [(8, 3), (forest.ROWS_BLOCK, forest.QUERIES_BLOCK)])
def test_nearest(spark, monkeypatch, blocks):
    monkeypatch.setattr(forest, "ROWS_BLOCK", blocks[0])
    monkeypatch.setattr(forest, "QUERIES_BLOCK", blocks[1])
    x = vectors_with_copies()
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = forest.nearest(df, lambda v: v % 50 == 0).collect()
    u = x.astype(float)
    hits = total = 0
    for q in range(0, len(x), 50):
        score = (u * u[q]).sum(axis=1) / np.sqrt((u * u).sum(axis=1)) / np.sqrt((u[q] ** 2).sum())
        score[q] = -9
        best = np.lexsort((np.arange(len(x)), -score))[:5].tolist()
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5] and all(abs(r.score - score[r.vec_id]) < 1e-12 for r in mine)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        hits, total = hits + len(set(best) & {r.vec_id for r in mine}), total + 5
    assert hits / total >= 0.9


def test_targets_fill_up_to_their_limits(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 100), (None, 50), ("z", 0)], "source string, source_size bigint")
    rows = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    size, weight = {"a": 10, "b": 1000, "c": 100, "z": 0, None: 50}, dict(zip(["a", "b", "c", "z", None], [5, 2, 1, 5, 2]))
    target, left = {}, dict(weight)
    total = sum(size.values())
    while True:  # share what is left among the sources below their limit, until none is above
        level = (total - sum(target.values())) / sum(left.values())
        above = [s for s in left if level * left[s] > 3 * size[s]]
        if not above:
            break
        for s in above:
            target[s] = 3.0 * size[s]
            del left[s]
    target.update({s: level * w for s, w in left.items()})
    assert rows == pytest.approx(target)


def test_mix_equals_its_sql(spark):
    assert differences(QUERIES["op2_mix_sources"](spark, SF), oracle_connection(SF), ORACLE["op2_mix_sources"]) == []


def test_mix_emits_what_it_counts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    taken = {r.doc_id: r._mix.copies for r in mixing.mixed(docs).collect()}
    emitted = {r.doc_id: r["count"] for r in mixing.mix(docs).groupBy("doc_id").count().collect()}
    assert emitted == {i: n for i, n in taken.items() if n} and max(taken.values()) <= 3
    by_source = QUERIES["op2_mix_sources"](spark, SF).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target")
    )
    assert by_source.filter("abs(taken - target) > 0.5 * target").count() == 0
    plan = mixing.mixed(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def pairs_at_the_limit(n, mean, size=64):
    """Unit vectors around a common direction, and one of cosine 0.935 for each."""
    rng = np.random.default_rng(12)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    x = unit(mean / np.sqrt(size) + np.sqrt((1 - mean**2) / size) * rng.normal(size=(n, size)))
    away = rng.normal(size=x.shape)
    away = unit(away - (away * x).sum(axis=1, keepdims=True) * x)
    return x, 0.935 * x + np.sqrt(1 - 0.935**2) * away


@pytest.mark.parametrize("mean, total", [(0.0, 10_000), (0.0, 10**8), (0.5, 10**6), (0.8, 10_000), (0.9, 10_000), (0.99, 10_000)])
def test_tables_keep_links_around_a_common_direction(mean, total):
    x, y = pairs_at_the_limit(2000, mean)
    quantiser = itq.Quantiser(x, total)
    a, b = quantiser.signs(x), quantiser.signs(y)
    meet = (quantiser.keys(a) == quantiser.keys(b)).any(axis=1)
    meet &= (a != b)[:, : quantiser.code_bits].sum(axis=1) <= quantiser.radius
    assert meet.mean() >= 0.99


def test_near_embeddings_around_a_common_direction(spark):
    x = np.concatenate(pairs_at_the_limit(400, 0.8))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    found = {r.vec_id: r.n_links for r in itq.near_embeddings(df).collect()}
    near = (x @ x.T >= 0.93).sum(axis=1) - 1
    assert sum(found.values()) >= 0.99 * near.sum() and all(found[i] <= n for i, n in enumerate(near))


def brute_visits(x, share_of):
    """Recall and compared rows of searches by ``share_of`` the rows, over all trees."""
    fitted, share = forest.cheapest(x, forest.TREES, 6, 5)
    leaves = fitted.leaves(x)
    sizes = dict(zip(*np.unique(leaves, return_counts=True)))
    queries = np.arange(3, len(x), 37)
    hits = compared = 0
    for q, taken in zip(queries, fitted.visits(x[queries], sizes, share_of(share) * len(x))):
        met = np.isin(leaves, taken)
        score = x @ x[q]
        score[q] = -9
        hits += met.any(axis=1)[np.argsort(-score)[:5]].sum()
        compared += met.sum()
    return hits / 5 / len(queries), compared / len(queries) / len(x), share


@pytest.mark.parametrize("kind, most", [("clusters", 0.2), ("few dimensions", 0.2), ("none", 1.0)])
def test_searches_compare_what_the_vectors_need(kind, most):
    rng = np.random.default_rng(8)
    x = {
        "clusters": lambda: rng.normal(size=(80, 32))[rng.integers(0, 80, 8000)] + 0.3 * rng.normal(size=(8000, 32)),
        "few dimensions": lambda: rng.normal(size=(8000, 4)) @ rng.normal(size=(4, 32)),
        "none": lambda: rng.normal(size=(8000, 32)),
    }[kind]()
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    recall, compared, share = brute_visits(x, lambda share: share)
    assert recall >= 0.92 and share <= most and compared <= share + 0.05


@pytest.mark.parametrize("held", [1, 40, 10_000])
def test_neighbours_of_many_units_are_combined(monkeypatch, held):
    monkeypatch.setattr(forest, "HELD_ROWS", held)
    import pandas as pd

    rng = np.random.default_rng(3)
    rows = [(int(q), int(v), -float(v * 7 % 31)) for q, v in zip(rng.integers(0, 9, 600), rng.integers(0, 60, 600))]
    frames = [pd.DataFrame(rows[i : i + 7], columns=["query_id", "vec_id", "score"]) for i in range(0, 600, 7)]
    kept = {tuple(r) for f in forest.best_of(iter(frames), 5) for r in f.itertuples(index=False)}
    for q in range(9):
        best = sorted({r for r in rows if r[0] == q}, key=lambda r: (-r[2], r[1]))[:5]
        assert set(best) <= kept and (held < 100 or best == sorted((r for r in kept if r[0] == q), key=lambda r: (-r[2], r[1])))


def test_bounds_are_the_order_of_the_queue():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 8))
    trees = forest.Forest(x, 4, 4)
    sizes = dict(zip(*np.unique(trees.leaves(x), return_counts=True)))
    for bound, taken in zip(trees.bounds(x), trees.visits(x, sizes, 250)):
        flat = bound.reshape(-1)
        assert (np.diff(flat[taken]) >= 0).all() and (np.delete(flat, taken)[[i in sizes for i in np.delete(np.arange(64), taken)]] >= flat[taken[-1]]).all()


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6, 7, 10, 12, 20, 30])
def test_nearest_in_small_tables(spark, n):
    x = np.random.default_rng(n).normal(size=(n, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = forest.nearest(df, lambda v: v >= 0).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(n):
        score = u @ u[q]
        score[q] = -9
        best = np.lexsort((np.arange(n), -score))[: min(5, n - 1)].tolist()
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r.vec_id for r in mine] == best and all(abs(r.score - score[r.vec_id]) < 1e-14 for r in mine)


def test_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(4)
    x = [rng.normal(size=8 if i % 3 else 16) for i in range(90)]
    for i in range(30, 60, 3):
        x[i] = x[i + 30] * 2  # a link among those of length 16
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>, label int")
    links = {r.vec_id: (r.n_links, r.component_id) for r in itq.near_embeddings(df).collect()}
    got = forest.nearest(df, lambda v: v % 10 == 0).collect()
    for q, v in enumerate(x):
        score = {i: w @ v / np.sqrt(w @ w) / np.sqrt(v @ v) for i, w in enumerate(x) if len(w) == len(v) and i != q}
        near = [i for i in score if score[i] >= 0.93]
        assert links[q] == (len(near), min([q, *near]))
        if q % 10 == 0:
            best = sorted(score, key=lambda i: (-score[i], i))[:5]
            assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == best
