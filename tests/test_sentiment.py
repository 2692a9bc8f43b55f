import random
import re

import pytest
from pyspark.sql import functions as F

from plaudit.functions.sentiment import Lexicon, category, with_sentiment
from plaudit.operators import scoring

LEXICON = Lexicon(
    {"good": 0.7, "bad": -0.7, "great": 0.8, "edge": 0.05, "under": -0.05, "fine": 0.4},
    {"very": 1.3, "slightly": 0.5},
    ("not", "never", "don't"),
)

GOLDEN = [
    ("good", 0.7, "positive"),
    ("a good thing", 0.7, "positive"),
    ("not good", -0.35, "negative"),
    ("not very good", -0.455, "negative"),
    ("not a good", -0.35, "negative"),
    ("not the good", 0.7, "positive"),
    ("very great", 1.0, "positive"),
    ("not very great", -0.5, "negative"),
    ("not bad", 0.35, "positive"),
    ("slightly bad", -0.35, "negative"),
    ("don't good", -0.35, "negative"),
    ("Good, BAD!", 0.0, "neutral"),
    ("edge", 0.05, "neutral"),
    ("under", -0.05, "neutral"),
    ("nothing known", 0.0, "neutral"),
    ("", 0.0, "neutral"),
    ("\t\n", 0.0, "neutral"),
    (None, 0.0, "neutral"),
]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def results(df):
    return [(r.polarity, r.category) for r in df.orderBy("id").collect()]


def forms(spark, df, lexicon):
    table = scoring.lexicon_frame(spark, lexicon)
    yield with_sentiment(df, "text", lexicon, form="native")
    yield with_sentiment(df, "text", lexicon, form="arrow")
    yield scoring.score_by_join(df, "id", "text", table)
    yield scoring.score_by_join(df, "id", "text", table, max_broadcast_rows=1)


def brute_force(text, lexicon):
    words = re.findall(r"[a-zé]+(?:'[a-zé]+)*", (text or "").lower())
    units = []
    for i, word in enumerate(words):
        if word in lexicon.polarity:
            p1 = words[i - 1] if i else ""
            p2 = words[i - 2] if i > 1 else ""
            value = max(-1.0, min(1.0, lexicon.polarity[word] * lexicon.intensity.get(p1, 1.0)))
            if p1 in lexicon.negations or (p2 in lexicon.negations and (p1 in lexicon.intensity or len(p1) == 1)):
                value *= -0.5
            value *= 1e6
            units.append(int(abs(value) + 0.5) * (1 if value >= 0 else -1))
    return sum(units) / (len(units) * 1e6) if units else 0.0


def test_golden_rows_in_every_form(spark, no_auto_broadcast):
    df = frame(spark, [text for text, _, _ in GOLDEN])
    for scored in forms(spark, df, LEXICON):
        assert results(scored) == [(p, c) for _, p, c in GOLDEN]


def test_random_texts_in_every_form(spark, no_auto_broadcast):
    rng = random.Random(5)
    vocabulary = [*LEXICON.polarity, *LEXICON.intensity, *LEXICON.negations, "a", "x", "the", "café", "don't"]
    seps = [" ", "  ", ", ", "\n", "! ", " 7 ", "² "]
    texts = ["".join(rng.choice(vocabulary) + rng.choice(seps) for _ in range(rng.randrange(40))) for _ in range(300)]
    expected = [brute_force(text, LEXICON) for text in texts]
    df = frame(spark, texts)
    for scored in forms(spark, df, LEXICON):
        assert [p for p, _ in results(scored)] == expected


@pytest.mark.parametrize("size", [1, 300, 10_000])
def test_the_size_of_the_lexicon_changes_nothing(spark, no_auto_broadcast, size):
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz"
    more = {"w" + "".join(rng.choices(letters, k=6)): rng.randrange(-100, 101) / 100 for _ in range(size - 1)}
    lexicon = Lexicon({"good": 0.7, **more}, LEXICON.intensity, LEXICON.negations)
    words = [*list(lexicon.polarity)[:200], "very", "not", "other"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(60))) for _ in range(60)]
    df = frame(spark, texts)
    expected = [brute_force(text, lexicon) for text in texts]
    for scored in forms(spark, df, lexicon):
        assert [p for p, _ in results(scored)] == expected
    # A letter that is newer than the tables of the JVM or of Python is the same to all forms.
    newer = frame(spark, ["good\U0001E030 thing", "good\u1C89 not good"])
    first, *others = ([p for p, _ in results(scored)] for scored in forms(spark, newer, lexicon))
    assert all(other == first for other in others)


def test_short_lexicon_stays_in_the_jvm(spark):
    scored = with_sentiment(frame(spark, ["good"]), "text", LEXICON)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_hot_word_in_the_salted_join(spark, no_auto_broadcast):
    df = spark.range(2000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "good " * 50).otherwise("bad fine").alias("text"))
    table = scoring.lexicon_frame(spark, LEXICON)
    scored = scoring.score_by_join(df, "id", "text", table, max_broadcast_rows=1)
    counts = {r.category: r["count"] for r in scored.groupBy("category").count().collect()}
    assert counts == {"positive": 667, "negative": 1333}


def test_category_bounds(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.0500001,), (-0.0500001,), (0.0,)], "p double")
    assert [r[0] for r in df.select(category(F.col("p"))).collect()] == [
        "neutral", "neutral", "positive", "negative", "neutral",
    ]


def test_plugin_scorer(spark):
    def scorer(text):
        if "boom" in text:
            raise ValueError(text)
        return len(text) / 10

    df = frame(spark, ["abc", "boom", "  ", None])
    scored = with_sentiment(df, "text", scorer=scorer)
    assert results(scored.drop("scorer_failed")) == [
        (0.3, "positive"), (0.0, "neutral"), (0.0, "neutral"), (0.0, "neutral"),
    ]
    assert scored.filter("scorer_failed").count() == 1


def test_lexicon_tables(spark):
    table = scoring.lexicon_table(
        spark.createDataFrame([("Good", 0.6), ("good", 0.8), ("bad", -0.7)], "word string, polarity double"),
        spark.createDataFrame([("very", 1.3)], "word string, intensity double"),
        spark.createDataFrame([("not",)], "word string"),
    )
    lexicon = Lexicon.from_table(table)
    assert lexicon.polarity == {"good": pytest.approx(0.7), "bad": -0.7}
    assert lexicon.intensity == {"very": 1.3} and lexicon.negations == ("not",)
    with pytest.raises(ValueError):
        Lexicon.from_table(table, max_rows=2)


def test_starter_lexicon(spark):
    df = frame(spark, ["this is a great product", "it isn't good", "terrible quality"])
    assert [c for _, c in results(with_sentiment(df, "text"))] == ["positive", "negative", "negative"]


def test_counts_share_and_mean(spark):
    scored = with_sentiment(frame(spark, ["good", "good", "bad", ""]), "text", LEXICON)
    assert {r.category: r["count"] for r in scoring.category_counts(scored).collect()} == {
        "positive": 2, "negative": 1, "neutral": 1,
    }
    assert scoring.mean_sentiment(scored).first()[0] == pytest.approx(0.175)
    share = {r.category: (r.share, r.label) for r in scoring.category_share(scored).collect()}
    assert share["positive"] == (0.5, "positive (2)")


def test_empty_input(spark):
    scored = with_sentiment(frame(spark, []), "text", LEXICON)
    assert [r["count"] for r in scoring.category_counts(scored).collect()] == [0, 0, 0]
    assert scoring.mean_sentiment(scored).first()[0] == 0.0
    assert [r.share for r in scoring.category_share(scored).collect()] == [0.0, 0.0, 0.0]


def test_repeated_ids_are_scored_by_row(spark):
    from plaudit.operators.scoring import lexicon_table
    from plaudit.plans.analysis import scored_by

    words = spark.createDataFrame([("good", 0.7), ("bad", -0.7)], "word string, polarity double")
    texts = [("1", "good"), ("1", "bad"), ("1", "bad"), ("2", "good"), (None, "bad")]
    rows = spark.createDataFrame(texts, "review_id string, text string")
    scored = scored_by(rows, "text", lexicon_table(words))
    found = sorted((r.review_id or "", r.text, r.polarity) for r in scored.collect())
    assert found == sorted((i or "", t, 0.7 if t == "good" else -0.7) for i, t in texts)
