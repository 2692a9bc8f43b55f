"""Personal data by patterns and by bootstrapped contexts, with DataFrame functions only.

Base spans are e-mail and IP addresses, card and phone numbers by pattern and check. They are the
seeds. The context of a seed gives lexical patterns of several grains: the two words before it, the word
before with the word after, and the word before with the shape of the value. One word alone says too little: order
numbers would follow card numbers.
Candidates are other tokens of 6 to 64 characters with digits. Plain numbers, times and dates, and what
looks like a card number but fails its check, are known to be no identifiers and speak against the patterns that they occur in. Patterns and instances (values) form a graph of (pattern, instance)
edges, counted once per corpus. In each round a pattern's confidence in a kind is the sum of its instances' scores for
that kind over the number of its known instances (of any kind, numbers too) and a half more, so that few instances
prove less than many; an instance's score is the best confidence of its patterns, seeds score 1, and instances of
which nothing is known count neither for nor against. Candidates found by confident patterns with enough different
known instances become spans of that kind and support further patterns in the next round, until
a round accepts no value that was not accepted before. As every step loses some confidence, chains end
before they drift.

Matches are cut out with split, and their places are running sums of lengths, taken by doubling
steps, so that a text with many matches needs n log n steps. Patterns are possessive and
start at the first character of a run or at the end of the previous match, which finds the same matches
as the plain forms in time linear in the text. Whether an added span touches a base span is told by an equi-join on
cells of the text.

Defined results: null and empty texts have no spans; places are in code points, end exclusive; rows
that repeat an id and a text have the same spans; candidates that touch a base span are not added; contexts are words of
the 80 characters before and after a value, so a longer word counts by its nearest 80 characters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from plaudit.llm.common import written
from plaudit.sizing import is_small

#: Kinds in the order of reports, with their patterns (fixed values, made possessive).
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What may be an identifier: letters and digits, perhaps joined by dashes, a digit among them, of LEAST to MOST characters.
CANDIDATE = r"(?<![A-Za-z0-9-])(?=[A-Za-z-]*+[0-9])[A-Za-z0-9]++(?:-[A-Za-z0-9]++)*+(?![A-Za-z0-9-])"
LEAST, MOST = 6, 64
#: What is no identifier: short numbers, decimals, times and dates that stand alone and not in a row of numbers.
NUMBER = (
    r"(?<!\S)(?<![0-9]\s)(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,5}(?:[:.,][0-9]{1,3})?)%?(?=[.,;:!?)]?(?:\s|$))(?!\s[0-9])"
)
OTHER = len(KINDS)
CONTEXT_CHARS = 80
#: So many matches, of two characters at least, and the gaps after them are no shorter than a context.
CONTEXT_MATCHES = CONTEXT_CHARS // 2
CONFIDENT = 0.8
#: Different known instances that a pattern needs.
SUPPORT = 3
#: Instances of no kind that every pattern is taken to have.
DOUBT = 0.5
#: Characters of a text that are looked at together when spans are compared.
CELL = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_sums(numbers: Column) -> Column:
    """Sums of the first 1, 2, ... numbers of an array, by doubling steps."""
    steps = F.sequence(F.lit(0), F.greatest(F.ceil(F.log2(F.greatest(F.size(numbers), F.lit(1)))).cast("int"), F.lit(0)))

    def double(sums: Column, step: Column) -> Column:
        reach = F.call_function("shiftleft", F.lit(1), step)
        return F.transform(
            sums, lambda x, i: x + F.when(i >= reach, F.get(sums, i - reach)).otherwise(F.lit(0))
        )

    return F.aggregate(steps, numbers, double)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the check digit of a string of digits is right."""

    def weight(i: Column) -> Column:
        digit = F.substring(number, F.length(number) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, digit).when(digit < 5, digit * 2).otherwise(digit * 2 - 9)

    places = F.sequence(F.lit(0), F.length(number) - 1)
    return F.aggregate(F.transform(places, weight), F.lit(0), lambda total, x: total + x) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    """The check that a match of the kind must pass."""
    if kind == "ip":
        small = lambda part: let(
            F.regexp_replace(part, "^0+", ""),
            lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= F.lit("255"))),
        )
        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        return let(digits(value), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


def matches(text: Column, pattern: str, check: Callable[[Column], Column]) -> Column:
    """Array of (start, end, value, before, after) of the matches that pass the check, with the text on both sides."""

    def last(value: Column) -> Column:
        return F.substring(value, F.lit(-CONTEXT_CHARS), F.lit(CONTEXT_CHARS))

    def first(value: Column) -> Column:
        return F.substring(value, F.lit(1), F.lit(CONTEXT_CHARS))

    def before(gaps: Column, values: Column, i: Column) -> Column:
        """The end of the text before match i: its gap and, if that is short, earlier matches with their gaps."""
        gap = last(F.get(gaps, i))
        earlier = F.transform(
            F.sequence(F.greatest(i - CONTEXT_MATCHES, F.lit(0)), i - 1),
            lambda j: F.concat(last(F.get(gaps, j)), last(F.get(values, j))),
        )
        return F.when((i == 0) | (F.length(gap) >= CONTEXT_CHARS), gap).otherwise(
            last(F.concat(F.array_join(earlier, ""), gap))
        )

    def after(gaps: Column, values: Column, i: Column) -> Column:
        """The start of the text after match i: the next gap and, if that is short, later matches with their gaps."""
        gap, most = first(F.get(gaps, i + 1)), F.size(values) - 1
        later = F.transform(
            F.sequence(i + 1, F.least(i + CONTEXT_MATCHES, most)),
            lambda j: F.concat(first(F.get(values, j)), first(F.get(gaps, j + 1))),
        )
        return F.when((i == most) | (F.length(gap) >= CONTEXT_CHARS), gap).otherwise(
            first(F.concat(gap, F.array_join(later, "")))
        )

    def located(gaps: Column, values: Column) -> Column:
        sizes = F.transform(
            gaps, lambda gap, i: F.length(gap) + F.when(i > 0, F.length(F.get(values, i - 1))).otherwise(F.lit(0))
        )
        return let(
            running_sums(sizes),
            lambda starts: F.filter(
                F.transform(
                    values,
                    lambda value, i: F.struct(
                        F.get(starts, i).cast("bigint").alias("start"),
                        (F.get(starts, i) + F.length(value)).cast("bigint").alias("end"),
                        value.alias("value"),
                        before(gaps, values, i).alias("before"),
                        after(gaps, values, i).alias("after"),
                    ),
                ),
                lambda found: check(found["value"]),
            ),
        )

    cut = let(
        F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values")),
        lambda parts: located(parts["gaps"], parts["values"]),
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string,before:string,after:string>>")
    return F.when(text.rlike(pattern), cut).otherwise(none)


def plain(words: Column) -> Column:
    return F.regexp_replace(F.lower(words), "[0-9]", "0")


def lexical(before: Column) -> Column:
    """The last two words before a place, lowered, digits alike; empty if there are none."""
    return plain(F.regexp_extract(before, r"(\S+\s+\S+)\s*$", 1))


def shape(value: Column) -> Column:
    """Letters alike and digits alike."""
    return F.substring(F.regexp_replace(F.regexp_replace(value, "[A-Za-z]", "a"), "[0-9]", "0"), 1, MOST)


def grains(match: Column) -> Column:
    """The lexical patterns of a match, from narrow to wide; those that lack a word are left out."""

    def of(word: Column, following: Column) -> Column:
        wide = F.array(
            F.when(following != "", F.concat_ws("\x01", F.lit("between"), word, following)),
            F.concat_ws("\x01", F.lit("shape"), word, shape(match["value"])),
        )
        two = lexical(match["before"])
        return F.when(word != "", F.array_compact(F.concat(F.array(F.when(two != "", two)), wide))).otherwise(
            F.array().cast("array<string>")
        )

    return let(
        plain(F.regexp_extract(match["before"], r"(\S+)\s*$", 1)),
        lambda word: let(plain(F.regexp_extract(match["after"], r"^(\S*\s+\S+)", 1)), lambda following: of(word, following)),
    )


def found_in(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, base, candidates, numbers): spans of each document, without its text."""
    body = F.coalesce(F.col(text), F.lit(""))

    def placed(m: Column, *more: Column) -> Column:
        return F.struct(
            *more, m["start"], m["end"], m["value"], lexical(m["before"]).alias("pattern"), grains(m).alias("patterns")
        )

    def of_kind(k: int, kind: str) -> Column:
        found = matches(F.col("_text"), PATTERNS[kind], lambda value: passes(kind, value))
        return F.transform(found, lambda m: placed(m, F.lit(k).alias("kind")))

    base = F.concat(*[of_kind(k, kind) for k, kind in enumerate(KINDS)])
    others = F.transform(matches(F.col("_text"), CANDIDATE, lambda value: F.length(value).between(LEAST, MOST)), lambda m: placed(m))
    numbers = F.transform(
        matches(F.col("_text"), NUMBER, lambda value: F.lit(True)),
        lambda m: F.struct(F.lit(OTHER).alias("kind"), m["value"], grains(m).alias("patterns")),
    )
    # Every pattern needs a digit or an at sign; a text without them is not searched further.
    searched = F.when(body.rlike("[0-9@]"), body).otherwise(F.lit(""))
    found = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("text_key"), searched.alias("_text")).select(
        "doc_id", "text_key", base.alias("base"), others.alias("candidates"), numbers.alias("numbers")
    )
    tested = F.filter("candidates", lambda c: c["value"].rlike("^[0-9]{13,19}$") & ~luhn(c["value"]))
    failing = F.transform(tested, lambda c: F.struct(F.lit(OTHER).alias("kind"), c["value"], c["patterns"]))
    return found.withColumn("numbers", F.concat("numbers", failing))


def by_grain(rows: DataFrame) -> DataFrame:
    """(base, candidates): one entry for each pattern of a match; numbers are base entries of a kind of their own."""

    def each(spans: str, *more: str) -> Column:
        return F.flatten(F.transform(spans, lambda s: F.transform(
            s["patterns"], lambda p: F.struct(*[s[name] for name in more], s["value"], p.alias("pattern"))
        )))

    return rows.select(
        F.concat(each("base", "kind"), each("numbers", "kind")).alias("base"), each("candidates").alias("candidates")
    )


def small_first(rows: DataFrame) -> DataFrame:
    """``rows``, sent to the other side of a join if their size, which is checked, allows."""
    return F.broadcast(rows) if is_small(rows) else rows


def bootstrapped(spans: DataFrame) -> DataFrame:
    """(pattern, value, kind): candidates accepted as personal data, under the patterns that found them."""
    seeds = spans.select(F.explode("base").alias("s")).select("s.pattern", "s.value", "s.kind")
    others = spans.select(F.explode("candidates").alias("s")).select("s.pattern", "s.value")
    known = written(seeds.groupBy("value").agg(F.min("kind").alias("kind")), "pii-known")
    edges = written(
        seeds.select("pattern", "value").unionByName(others).filter("pattern <> ''").distinct(), "pii-edges"
    )
    unknown = written(edges.join(known.select("value"), "value", "left_anti"), "pii-unknown")
    started = known.select("value", "kind", F.lit(1.0).alias("score"))
    scores, seen = started, known.select("value").limit(0)
    while True:
        kinds = (
            edges.join(scores, "value").groupBy("pattern", "kind")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("score"))
        )
        # A pattern has at most one row per kind, so these windows are small.
        total = F.sum("n").over(Window.partitionBy("pattern"))
        confident = written(
            kinds.withColumn("confidence", F.col("score") / (total + F.lit(DOUBT)))
            .filter((F.col("confidence") >= CONFIDENT) & (F.col("n") >= SUPPORT) & (F.col("kind") < OTHER)),
            "pii-patterns",
        )
        best = F.max_by("kind", F.struct("confidence", -F.col("kind")))
        reached = written(
            unknown.join(small_first(confident.select("pattern", "kind", "confidence")), "pattern"), "pii-reached"
        )
        accepted = written(
            reached.groupBy("value").agg(best.alias("kind"), F.max("confidence").alias("score")), "pii-accepted"
        )
        if accepted.join(seen, "value", "left_anti").isEmpty():
            break
        seen = written(seen.union(accepted.select("value")).distinct(), "pii-seen")
        scores = started.unionByName(accepted)
    return reached.select("pattern", "value").join(accepted.select("value", "kind"), "value").distinct()


def cells(start: str, end: str) -> Column:
    """The cells of the text that a span lies in."""
    return F.explode(F.sequence(F.floor(F.col(start) / CELL), F.floor((F.col(end) - 1) / CELL))).alias("cell")


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, spans): arrays of (kind, start, end) in the order of kinds, then places."""
    rows = written(found_in(docs, doc_id, text), "pii-spans")
    accepted = bootstrapped(by_grain(rows))
    mentions = rows.select("doc_id", "text_key", F.explode("candidates").alias("c")).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "c.value", "c.start", "c.end",
        F.explode("c.patterns").alias("pattern"),
    )
    # Rows that repeat an id and a text have one set of added spans.
    added = written(
        mentions.join(small_first(accepted), ["pattern", "value"]).select("_id", "_key", "kind", "start", "end").distinct(),
        "pii-added",
    )
    held = rows.select("doc_id", "text_key", F.explode("base").alias("b")).select(
        "doc_id", "text_key", F.col("b.start").alias("from"), F.col("b.end").alias("to")
    ).join(
        small_first(added.select("_id", "_key").distinct()),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left_semi",
    )
    base_cells = held.select("doc_id", "text_key", "from", "to", cells("from", "to")).distinct()
    touching = added.select("*", cells("start", "end").alias("_cell")).join(
        base_cells,
        F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("text_key")) & (F.col("_cell") == F.col("cell"))
        & (F.col("start") < F.col("to")) & (F.col("from") < F.col("end")), "left_semi",
    ).select(F.col("_id").alias("t_id"), F.col("_key").alias("t_key"), F.col("start").alias("t_start")).distinct()
    fresh = added.join(
        touching,
        F.col("_id").eqNullSafe(F.col("t_id")) & (F.col("_key") == F.col("t_key")) & (F.col("start") == F.col("t_start")),
        "left_anti",
    ).groupBy("_id", "_key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))  # of one text
    joined = rows.select("doc_id", "text_key", "base").join(
        F.broadcast(fresh) if is_small(added) else fresh,
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left"
    )
    base = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    more = F.coalesce("added", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>"))
    return joined.select("doc_id", base.alias("base"), F.array_sort(F.concat(base, more)).alias("spans"))


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def digest(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans of each document."""
    spans = personal_data(docs)

    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")

    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return spans.select(
        "doc_id", *counts, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans")
    )
