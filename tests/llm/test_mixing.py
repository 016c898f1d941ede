"""Pareto order sampling with unequal odds, against the order and the shares worked out by hand."""

import hashlib
from collections import defaultdict

from compare import connect, differences

from roadpulse.llm.mixing import mix_sources
from roadpulse.llm.queries import ORACLES, QUERIES

WEIGHTS = (5, 2, 1)


def brute_force(rows, tastes):
    """Copies of each row: rows are (id, source, text) with no source above three times its size."""
    sizes = {i: len((text or "").split()) for i, _, text in rows}
    sources = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s))
    total = {s: sum(sizes[i] for i, mine, _ in rows if mine == s) for s in sources}
    weight = {s: WEIGHTS[n % 3] for n, s in enumerate(sources)}
    copies = {}
    for s in sources:
        target = weight[s] * sum(total.values()) / sum(weight.values())
        assert target < 3 * total[s]
        whole = int(target // total[s])
        left = target - whole * total[s]
        mine = [(i, text) for i, source, text in rows if source == s]
        low, high = 0.0, 1.0
        for _ in range(52):
            q = (low + high) / 2
            short = sum(sizes[i] * (1 - (1 - q) ** tastes[i]) for i, _ in mine) < left
            low, high = (q, high) if short else (low, q)

        def rank(entry):
            i, text = entry
            inner = hashlib.md5((text or "").encode()).hexdigest()
            u = (int(hashlib.md5(f"{i}:{inner}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            chance = 1 - (1 - high) ** tastes[i]
            return (u / (1 - u)) / (chance / (1 - chance)), i

        taken = 0
        for i, _ in sorted(mine, key=rank):
            taken += sizes[i]
            copies[i] = whole + (2 * taken - sizes[i] <= 2 * left)
    return copies


def documents(spark, n=600):
    rows = [(i, ("a", "b", None)[i % 3], " ".join(["w"] * (i * 37 % 90)) or None) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)


def test_size_steps_equal_brute_force(spark):
    rows, docs = documents(spark)
    sizes = {i: len((text or "").split()) for i, _, text in rows}
    want = brute_force(rows, {i: 4.0 if n >= 60 else 2.0 if n >= 20 else 1.0 for i, n in sizes.items()})
    got = mix_sources(docs, size_steps=((20, 2.0), (60, 4.0))).collect()
    assert {r.doc_id: r.copies for r in got if r.size} == {i: c for i, c in want.items() if sizes[i]}


def test_preference_column_equals_brute_force_and_its_shares(spark):
    rows, docs = documents(spark, 3000)
    preferred = docs.selectExpr("*", "if(doc_id % 5 = 0, 8.0, if(doc_id % 5 = 1, null, 0.5)) AS liking")
    tastes = {i: 8.0 if i % 5 == 0 else 1.0 if i % 5 == 1 else 0.5 for i, _, _ in rows}
    got = mix_sources(preferred, preference="liking").collect()
    want = brute_force(rows, tastes)
    assert {r.doc_id: r.copies for r in got if r.size} == {r.doc_id: want[r.doc_id] for r in got if r.size}
    # More of what is preferred more, and every source near its target.
    extra, size, taken = defaultdict(list), {}, defaultdict(int)
    for r in got:
        if r.source == "b":
            extra[tastes[r.doc_id]].append(r.copies)
        size[r.source], taken[r.source] = r.target, taken[r.source] + r.taken
    share = {t: sum(c) / len(c) for t, c in extra.items()}
    assert share[8.0] > share[1.0] + 0.1 > share[0.5] + 0.15
    assert all(abs(taken[s] - size[s]) <= 45 for s in size)


def test_preferences_of_any_value_have_a_result(spark):
    values = "array(-1.0, 0.0, 1e9, double('nan'), null)"
    docs = spark.range(50).selectExpr(
        "id AS doc_id", "'s' AS source", "repeat('w ', cast(id % 7 AS int)) AS text", f"{values}[id % 5] AS liking"
    )
    got = mix_sources(docs, preference="liking").collect()
    assert len(got) == 50 and sum(r.taken for r in got) == sum(r.size for r in got)
    assert mix_sources(docs.limit(0), preference="liking").collect() == []


def test_query_equals_sql(spark, sf_dir):
    assert differences(QUERIES["op10_mixing"](spark, sf_dir), connect(sf_dir), ORACLES["op10_mixing"]) == []
