"""Small tables with everything that may go wrong, and empty ones."""

from pyspark.sql import functions as F

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def sentence(seed, n):
    return " ".join(WORDS[(seed * 7 + i * (seed % 5 + 1) + i * i) % 10] + str((seed + i) % 17) for i in range(n))


def rows():
    texts = [(i, sentence(i, 40 + i), ("en", None, "de")[i % 3], ("a", "b", None, "ü")[i % 4], 1) for i in range(60)]
    texts += [
        (100, None, "en", "a", None), (101, "", "en", "b", 0), (102, " \t\n", None, None, 3),
        (103, sentence(3, 60_000), "en", "a", 9), (104, "one two", "en", "c", 7), (105, "one  TWO", "en", "c", 8),
        (106, sentence(1, 41), "en", "a", 1), (107, "x" * 50_000, "en", "a", 1), (None, "no id at all", "en", "a", 1),
        (108, "mail a.b@c.de or 10.0.0.1 token = abcdefgh1234", "en", "z", 1),
    ]
    return texts + texts[5:8] + [texts[60]]  # repeated rows


def write(spark, folder, empty=False):
    docs = spark.createDataFrame(rows(), "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, kind in (("score", "double"), ("size", "string"), ("target", "int"), ("spans", "string"),
                       ("component_id", "string"), ("ids", "int"), ("weight", "int"), ("label", "string"),
                       ("part", "int"), ("step", "string"), ("kept", "int"), ("word", "int"), ("n", "string"), ("unit", "int")):
        docs = docs.withColumn(name, F.lit(None).cast(kind))
    labels = spark.createDataFrame(
        [(i, (1, 0, None)[i % 3], (0, 0, 1, None)[i % 4]) for i in range(60)] + [(None, 1, 1), (3, 1, 0), (999, 0, 1)],
        "doc_id bigint, quality int, toxic int",
    )
    nan, inf = float("nan"), float("inf")
    vectors = [(i, [float((i * 7 + k * 3) % 11 - 5) for k in range(8)], i % 3) for i in range(120)]
    vectors += [(200, vectors[5][1], 2), (201, vectors[5][1], None), (202, None, 1), (203, [0.0] * 8, 1), (204, [nan] + [1.0] * 7, 1),
                (205, [inf] + [1.0] * 7, 1), (206, [None] + [1.0] * 7, 1), (207, [1.0] * 3, 1), (None, [1.0] * 8, 1), (250, [2.0] * 8, 1)]
    vectors += vectors[10:13]
    embeddings = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, label int").withColumns(
        {"rank": F.lit("x"), "score": F.lit(1), "n_links": F.lit(0)}
    )
    for name, df in (("documents", docs), ("labels", labels), ("embeddings", embeddings)):
        (df.limit(0) if empty else df.repartition(3)).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return folder
