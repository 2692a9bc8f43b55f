"""Token counts, pieces, secrets and personal data against the libraries and brute force."""

import hashlib
import random
import re
import struct

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from plaudit.llm import pieces, pii, secrets, tokens
from plaudit.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
BPE, PIECES = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(1)
    parts = "ab c  d\n\t.,!!é漢🎉''''0123 streavlmd ▁\0"
    special = [
        "", " ", "  a  b ", "\n\n x", "'s't're've'm'll'd'x'r'v'l ", "a" * 3000, "ab " * 100, " " * 50, "\0\0a\0",
        "<|endoftext|> a <|endoftext|><|endoftext|>x \n<|endoftext|>", "<s> </s> <unk>", "▁a ▁", "don't 'round 'l'",
        "".join(rng.choice("abcdefghi") for _ in range(5000)),
    ]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    return special + made + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.mark.parametrize("chunk", [5, tokens.CHUNK])
def test_token_counts_are_the_library_s(texts, monkeypatch, chunk):
    monkeypatch.setattr(tokens, "CHUNK", chunk)
    library = tokenizers.Tokenizer.from_file(BPE)
    assert tokens.counter(BPE).count(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_character_classes_are_the_library_s():
    split = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
    kinds = tokens.classes()
    for code in [*range(0x3000), *range(0xA700, 0xAC00), *range(0x10000, 0x11000), 0x1E5F8, 0x1C89, 0x88F]:
        char, kind = chr(code), kinds[code]
        for before, same in (("a", kind <= tokens.LETTER_E), ("1", kind == tokens.DIGIT), ("!", kind in (tokens.OTHER, tokens.QUOTE))):
            assert (len(split(before + char)) == 1) == same, hex(code)


def test_hash_collisions_do_not_matter(texts, monkeypatch):
    expected = tokens.counter(BPE).count(texts[:200])
    real = np.unique
    monkeypatch.setattr(
        tokens.np, "unique", lambda x, **k: real(x % 16 if k.get("return_inverse") else x, **k)
    )
    assert tokens.counter(BPE).count(texts[:200]) == expected


def test_pieces_are_the_library_s(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model = pieces.encoder(PIECES)
    ids = model.encode(texts)
    assert ids == library.encode(texts)
    assert [model.decode(one) for one in ids] == library.decode(ids)


def test_pieces_lie_end_to_end_in_the_text(texts):
    model = pieces.encoder(PIECES)
    for text, ids in zip(texts, model.encode(texts)):
        begins, ends = model.spans(text, ids)
        if ids:
            assert begins[0] == 0 and ends[-1] == len(text.encode()) and list(begins[1:]) == list(ends[:-1])
            if "▁" not in text:
                data = text.encode()
                cut = [data[a:b] for a, b in zip(begins, ends)]
                assert cut[1:] == [model.surface[i] for i in ids[1:]] and b" " + cut[0] == model.surface[ids[0]]


def test_compiled_character_maps_are_read():
    library = sentencepiece.SentencePieceNormalizer(rule_name="nfkc")
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(library.serialized_model_proto())
    table = pieces.CharMap(pieces.compiled_rules(spec.normalizer_spec.precompiled_charsmap))
    for text in ("ﬁ①Ａ㌔é", "éx", "ｶﾞ", "plain"):
        assert table.text(text) == library.normalize(text).replace(" ", pieces.SPACE).removeprefix(pieces.SPACE)
        assert len(table.sources(text)) == len(table.text(text)) + 1


SECRET_FORMS = (
    ("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
     r"""[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
)


def plain_secrets(text):
    found = [
        (m.start(), k, kind, m.end())
        for k, (kind, form, good) in enumerate(SECRET_FORMS) for m in re.finditer(form, text) if good(m)
    ]
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found))


def test_base_secrets_are_those_of_plain_patterns(texts):
    rng = random.Random(3)
    parts = ["token", "SeCret", "api_key", "apikey", "password", "=", ":", " ", "'", '"', "abcdef12", "AKIA", "ABCDEF1234567890",
             "0123456789abcdef" * 2, "ſecret", "Kapi", "İ", "g", "_", "deadbeef", "x"]
    for text in texts + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(2000)]:
        base = [s for s in secrets.find_secrets(text) if s[0] in secrets.BASE_KINDS]
        assert secrets.span_text(base) == plain_secrets(text)


def test_checksums_decide():
    body = "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"
    good = f"ghp_{body}{secrets.checksum(body)}"
    assert secrets.find_secrets(f"x {good} y") == [("github", 2, 42)]
    assert secrets.find_secrets(f"x ghp_{body}000000 y") == []
    assert secrets.find_secrets(f"x {good}Z") == []


def test_secrets_are_redacted(spark):
    df = spark.createDataFrame([(1, 'a token = "abcdefgh12" b'), (2, None), (3, "clean")], "id int, text string")
    assert [r.text for r in secrets.redact(df).orderBy("id").collect()] == ["a [assign]\" b", None, "clean"]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def digits(value):
    return re.sub("[^0-9]", "", value)


PERSONAL_FORMS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 13 <= len(digits(v)) <= 19 and luhn(digits(v))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(digits(v)) <= 15),
)


def plain_personal(text):
    return [
        f"{kind}:{m.start()}:{m.end()}" for kind, form, good in PERSONAL_FORMS for m in re.finditer(form, text) if good(m[0])
    ]


def test_base_personal_data_is_that_of_plain_patterns(spark):
    rng = random.Random(5)
    parts = ["a", "b.c", "@", "x-y", ".com", ".", "1", "12", "255", "256", "001", "+", "+1 ", "(", "555-", " ", "-", "4111111111111111",
             "4111 1111 1111 1111", "é", "🎉", "1.2.3.4", "_", "%", "\n", "a@b.co", "37828224631000 5"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    texts += ["", "1" * 2000, "a" * 2000 + "@", "a@" + "b." * 1500 + "c " + "1.2.3.4 " * 400]
    rows = pii.digest(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_personal(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), texts[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b.startswith(k) for b in base) for k in pii.KINDS]


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    seeds = [(i, f"so please call me at +1 555 {1000000 + i} now") for i in range(12)]
    more = [(100, "so please call me at 7712345-9 now"), (101, "the order number 7712346-9 now"), (102, "call me at noon")]
    rows = {r.doc_id: r for r in pii.digest(spark.createDataFrame(seeds + more, "doc_id bigint, text string")).collect()}
    assert rows[100].spans == "phone:21:30" and rows[100].n_phone == 0
    assert rows[101].spans == "" and rows[102].spans == "" and rows[0].n_phone == 1


def test_personal_data_takes_no_python(spark):
    plan = pii.found_in(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_queries_carry_the_digests(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    places = {r.doc_id: r for r in pieces.encode(spark.read.parquet(f"{SF}/documents.parquet"), PIECES).collect()}
    for r in QUERIES["op7_sentencepiece"](spark, SF).collect():
        spans = [place for pair in zip(places[r.doc_id].begins, places[r.doc_id].ends) for place in pair]
        assert r.spans_sha256 == hashlib.sha256(struct.pack(f"<{len(spans)}q", *spans)).hexdigest()
        ids = library.encode(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    for r in QUERIES["op8_secrets"](spark, SF).collect():
        assert r.base_sha256 == hashlib.sha256(plain_secrets(docs[r.doc_id]).encode()).hexdigest()
    assert QUERIES["op3_token_counts"](spark, SF).filter(F.col("over_limit") != (F.col("n_tokens") > 512)).count() == 0
