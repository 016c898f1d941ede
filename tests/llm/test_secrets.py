"""Random strings of several alphabets among ordinary text, and very long tokens."""

import random
import string
import time

import pytest
from pyspark.sql import functions as F

from roadpulse.llm.secrets import SecretModel, find_secrets, labelled_tokens, train_secret_model

BASE62 = string.ascii_letters + string.digits
KINDS = {
    "base62 of 24": ("", BASE62, 24),
    "base62 of 32": ("", BASE62, 32),
    "base62 of 40": ("", BASE62, 40),
    "ghp_ and 36": ("ghp_", BASE62, 36),
    "base64 of 40": ("", BASE62 + "+/", 40),
    "base32 of 32": ("", string.ascii_uppercase + "234567", 32),
    "upper-case hex of 40": ("", "0123456789ABCDEF", 40),
}
ORDINARY = [
    "internationalization_of_messages", "INTERNATIONALIZATION", "getElementsByTagNameAndClass",
    "https-redirect-configuration", "src/main/java/com/example/service", "MAX_CONNECTIONS_PER_SERVER_INSTANCE",
    "000000000000000000000000", "----------------------------------------",
    "AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA", "==============================",
    "counterrevolutionaries", "2024-01-01-2024-12-31-2025", "UncharacteristicallyLongIdentifier",
]


@pytest.fixture(scope="module")
def model(spark) -> SecretModel:
    return train_secret_model(labelled_tokens(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))


def test_random_strings_of_every_alphabet_are_found(spark, model):
    draw = random.Random(3)
    rows = [
        (kind, f"the key {prefix}{''.join(draw.choices(letters, k=n))} is used")
        for kind, (prefix, letters, n) in KINDS.items() for _ in range(200)
    ]
    found = {
        r.doc_id: r.n
        for r in find_secrets(spark.createDataFrame(rows, "doc_id string, text string"), model)
        .groupBy("doc_id").agg(F.sum(F.size("spans")).alias("n")).collect()
    }
    assert {kind: found[kind] for kind in KINDS if found[kind] < 180} == {}


def test_ordinary_tokens_are_left_alone(spark, model):
    docs = spark.createDataFrame([(w, f"a {w} b") for w in ORDINARY], "doc_id string, text string")
    assert [r.doc_id for r in find_secrets(docs, model).collect() if r.spans] == []


def test_few_spans_in_ordinary_documents(spark, model):
    """Tokens of 20 characters or more outside the base patterns; at most one in a hundred is taken."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    added = F.size(F.filter("spans", lambda s: s["kind"] == 3))
    long_tokens = F.size(F.regexp_extract_all("text", F.lit("[A-Za-z0-9+/_=-]{20,}"), F.lit(0)))
    n_added = find_secrets(docs, model).agg(F.sum(added)).first()[0]
    assert n_added <= max(5, docs.agg(F.sum(long_tokens)).first()[0] // 100)


def test_a_token_of_a_million_characters(spark, model):
    draw = random.Random(4)
    blob = "".join(draw.choices(BASE62 + "+/", k=1_000_000))
    docs = spark.createDataFrame([(1, f"data {blob} end"), (2, "x" * 1_000_000)], "doc_id bigint, text string")
    started = time.perf_counter()
    spans = {r.doc_id: r.spans for r in find_secrets(docs, model).collect()}
    assert time.perf_counter() - started < 60
    assert [(s.start, s.stop) for s in spans[1]] == [(5, 1_000_005)]
    assert spans[2] == []


def test_training_on_a_long_token(spark):
    docs = spark.createDataFrame([(1, "data " + "aB3" * 30_000)], "doc_id bigint, text string")
    assert train_secret_model(labelled_tokens(docs)).ratios.shape[0] == 7
