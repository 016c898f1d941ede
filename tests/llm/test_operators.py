"""Text operators against brute force, and on nulls, empty and repeated rows and empty tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from compare import connect, differences
from pyspark.sql import functions as F

import corpus_pipeline
from roadpulse.llm import queries
from roadpulse.llm.components import connected_components
from roadpulse.llm.decontaminate import find_contamination, keep_clean
from roadpulse.llm.exact import exact_groups
from roadpulse.llm.language import identify, least_score, train_language_model
from roadpulse.llm.lm import lm_scores
from roadpulse.llm.mixing import mix_sources, repeat_mixed
from roadpulse.llm.quality import score_quality, train_quality_model
from roadpulse.llm.repeats import repeated_passages
from roadpulse.llm.secrets import find_secrets, labelled_tokens, train_secret_model
from roadpulse.llm.sharding import shard_documents
from roadpulse.llm.simhash import keep_first_of_groups, near_groups

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, block string"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(4000))
ODD = [
    (1, None, "en", "a", 0, 0.5, "x"),
    (2, "", "en", "a", 0, 0.5, None),
    (3, "  \n ", None, None, 0, None, None),
    (4, LONG, "en", "b", 0, 0.5, "x"),
    (5, LONG.upper(), "de", "b", 0, 0.5, "x"),
    (5, LONG, None, "b", 0, 0.5, "x"),
    (6, "one two", "en", "b", 0, 0.5, "x"),
    (6, "one two", "en", "b", 0, 0.5, "x"),
    (None, "ünïcode tëxt ok", "fr", None, 0, 0.5, "x"),
    (None, None, None, None, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "One TWO"), (None, "x"), (2, None), (3, "")], "item_id bigint, text string")


def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.collect()}


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def all_operators(docs, benchmark):
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    yield identify(docs, train_language_model(docs))
    yield score_quality(docs, train_quality_model(docs, labels))
    yield find_secrets(docs, train_secret_model(labelled_tokens(docs)))
    yield near_groups(docs)
    yield shard_documents(docs, 7)
    yield lm_scores(docs, F.col("doc_id") % 2 == 0)[0]
    yield exact_groups(docs)
    yield find_contamination(docs, benchmark)
    yield repeated_passages(docs)
    yield mix_sources(docs)


def test_odd_rows_give_one_row_each(odd, benchmark):
    for result in all_operators(odd, benchmark):
        assert Counter(r.doc_id for r in result.collect()) == Counter(r[0] for r in ODD), result.columns


def test_empty_tables(empty, benchmark):
    for result in all_operators(empty, benchmark):
        assert result.collect() == []


def test_filters_keep_columns(odd, benchmark, empty):
    for kept in (keep_clean(odd, benchmark), keep_first_of_groups(odd), repeat_mixed(odd)):
        assert kept.columns == odd.columns
        kept.collect()
    assert keep_clean(odd, empty.select(F.lit(1).alias("item_id"), "text")).count() == len(ODD)
    # One row of: no words (4 rows), the long text in any case (3), the short one (2), the last.
    assert keep_first_of_groups(odd).count() == 4


@pytest.mark.parametrize("name", [n for n, sql in queries.ORACLES.items() if sql])
def test_query_matches_sql(spark, sf_dir, name):
    assert differences(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) == []


def test_language_of_held_out_documents(spark, sf_dir, documents):
    rows = queries.QUERIES["op1_language"](spark, sf_dir).join(documents, "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.9 * len(rows)
    assert sum(r.rejected for r in rows) <= 0.02 * len(rows)


@pytest.mark.parametrize("share", [0.005, 0.015, 0.02, 0.03, 0.2, 1.0])
def test_wrong_labels_do_not_reject_good_documents(share):
    for seed in range(20):
        rng = np.random.default_rng(seed)
        score, right = rng.uniform(0.3, 1, 1600), rng.random(1600) >= share
        assert (score < least_score(score, right, 0.25))[right].sum() <= 0.021 * right.sum()


def test_language_with_shuffled_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang is not null")
    langs = sorted(r.lang for r in docs.select("lang").distinct().collect())
    following = F.create_map(*[F.lit(x) for pair in zip(langs, langs[1:] + langs[:1]) for x in pair])
    wrong = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 100 < 3
    noisy = docs.withColumn("lang", F.when(wrong, F.try_element_at(following, F.col("lang"))).otherwise(F.col("lang")))
    found = identify(docs, train_language_model(noisy), ["lang"]).collect()
    assert sum(r.rejected for r in found) <= 0.05 * len(found)
    assert sum(r.lang == r.lang_pred for r in found) >= 0.9 * len(found)


def test_quality_separates_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = queries.QUERIES["op2_quality"](spark, sf_dir).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.85 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_base_secrets(spark, sf_dir, documents):
    assign = re.compile(
        r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
    )
    found = {r.doc_id: r for r in queries.QUERIES["op3_secrets"](spark, sf_dir).collect()}
    for doc_id, text in texts(documents).items():
        spans = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[1]) >= 8]
        for rank, kind, pattern, least in ((1, "access", "AKIA[A-Z0-9]+", 16), (2, "hex", "[0-9a-f]+", 32)):
            spans += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text) if len(m[0]) >= least]
        joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))
        assert hashlib.sha256(joined.encode()).hexdigest() == found[doc_id].base_sha256


def random_strings(seed, n):
    """Base62 strings of 32 characters in a text each, which no base pattern finds."""
    rng = np.random.default_rng(seed)
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"))
    return [f"the value {''.join(rng.choice(letters, 32))} of it" for _ in range(n)]


def test_unlabelled_secrets_in_the_training_text_do_not_hide_others(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    fresh = spark.createDataFrame(list(enumerate(random_strings(2, 200))), "doc_id bigint, text string")

    def caught(training):
        model = train_secret_model(labelled_tokens(training))
        return sum(len(r.spans) for r in find_secrets(fresh, model).collect())

    planted = spark.createDataFrame(list(enumerate(random_strings(1, 50), 10**6)), docs.schema)
    assert caught(docs.union(planted)) >= 0.9 * caught(docs) > 90


def test_simhash_components(spark, sf_dir, documents):
    prints = {}
    for doc_id, text in texts(documents).items():
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
        shingles = [words[i : i + 4] for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
        prints[doc_id] = sum(
            1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
        )
    parent = {d: d for d in prints}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    for r in queries.QUERIES["op4_simhash"](spark, sf_dir).collect():
        assert (int(r.fingerprint, 16), r.component_id) == (prints[r.doc_id], root(r.doc_id))


def jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def test_jump_hash(spark, sf_dir, documents):
    keys = dict(documents.select("doc_id", F.xxhash64("doc_id")).collect())
    rows = queries.QUERIES["op5_sharding"](spark, sf_dir).collect()
    assert len(rows) == len(keys)
    for r in rows:
        assert r.shard == jump(keys[r.doc_id] % 2**64, 40)
        assert r.grown_shard == jump(keys[r.doc_id] % 2**64, 41)
    for shard, n in Counter(r.shard for r in rows).items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))


def test_base_scores(spark, sf_dir, documents):
    import math

    tokens = {d: re.findall(r"[^\x20\x09-\x0D]+", lowered(t)) + [None] for d, t in texts(documents).items()}
    counts = Counter(w for d, ws in tokens.items() if zlib.crc32(str(d).encode()) % 10 for w in ws)
    total, types = sum(counts.values()), len(counts)
    rows = queries.QUERIES["op6_lm"](spark, sf_dir).collect()
    for r in rows:
        words = tokens[r.doc_id]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in words)
        assert (r.n_tokens, r.n_known) == (len(words), sum(counts[w] > 0 for w in words))
        assert r.base_score == pytest.approx(base)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_repeated_passages(spark, sf_dir, documents):
    found = {r.doc_id: r for r in queries.QUERIES["op9_repeats"](spark, sf_dir).collect()}
    seen = set()
    for doc_id, text in sorted(texts(documents).items()):
        raw = text.encode()
        covered = bytearray(len(raw))
        for at in range(len(raw) - 99):
            window = raw[at : at + 100]
            if window in seen:
                covered[at : at + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(b for b, c in zip(raw, covered) if not c)
        r = found[doc_id]
        assert (r.n_removed, r.kept_sha256) == (len(raw) - len(kept), hashlib.sha256(kept).hexdigest())


def without_passages(rows):
    seen, out = set(), []
    for raw in rows:
        covered = bytearray(len(raw))
        for at in range(len(raw) - 99):
            window = raw[at : at + 100]
            if window in seen:
                covered[at : at + 100] = b"\1" * 100
            seen.add(window)
        out.append(bytes(b for b, c in zip(raw, covered) if not c))
    return out


def test_repeated_row_keeps_a_passage_it_shares(spark):
    rng = np.random.default_rng(3)

    def words(n):
        return " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(n))

    shared = [words(60) for _ in range(5)]
    first = words(50).join(shared)
    rows = [(1, first), (1, first), (2, words(50).join(shared)), (3, words(40) + shared[2] + words(9))]
    kept = without_passages([t.encode() for _, t in rows])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = Counter((r.doc_id, r.kept_sha256) for r in repeated_passages(docs).collect())
    assert found == Counter((i, hashlib.sha256(k).hexdigest()) for (i, _), k in zip(rows, kept))


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(10, 40)] + [(100, i) for i in range(101, 150)] + [(7, 7)]
    roots = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {roots[i] for i in range(10, 41)} == {10} and {roots[i] for i in range(100, 150)} == {100}


def test_pipeline_stages(spark, sf_dir, documents):
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == documents.columns
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
