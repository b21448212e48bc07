"""Exact dedup and mixing against plain versions, and their edge cases."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from riskframe.llm import exact_dedup, mixing

CLASHING = "doc_id long, text string, digest string, salt int, content string, row string, id int"


def plain_decisions(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[text or ""].append(key)
    out = Counter()
    for key, text in rows:
        own = groups[text or ""]
        keep = max((k for k in own if k is not None), default=None)
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        out[key, keep, len(own), digest] += 1
    return out


def test_decisions_match_the_plain_version(spark, docs):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(50)]), rng.choice(["a", "b", "", None, "long " * 5000])) for _ in range(300)]
    frame = docs([(k, t, "en", "s", 1) for k, t in rows]).repartition(7)
    found = exact_dedup.decisions(frame, salts=4).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == plain_decisions(rows)
    kept = Counter(r.text_sha256 for r in found if r.kept)
    assert set(kept.values()) == {1} and len(kept) == 4


def test_survivors_are_the_kept_rows(spark, docs):
    rows = [(3, "x", "d1", 1, "c", "r", 9), (7, "x", None, 2, "c", "r", 9), (7, "x", "z", 5, "c", "r", 9)]
    rows += [(None, "x", "n", 1, "c", "r", 9), (1, None, "q", 1, "c", "r", 9), (0, "", "q", 1, "c", "r", 9)]
    frame = docs(rows, CLASHING)
    found = exact_dedup.survivors(frame, salts=2).collect()
    assert frame.columns == exact_dedup.survivors(frame).columns
    by_text = {r.text: r for r in found}
    assert len(found) == 2 and by_text["x"].doc_id == 7
    assert [r.doc_id for r in found if not r.text] == [1] and None in by_text
    decided = exact_dedup.decisions(frame, salts=2).where("kept").collect()
    assert sorted(r.doc_id for r in decided) == [1, 7]


def test_empty_tables(spark, docs):
    empty = docs([])
    assert exact_dedup.decisions(empty).count() == 0
    assert exact_dedup.survivors(empty).count() == 0
    assert mixing.mixing_plan(empty).count() == 0
    assert mixing.mix(empty).count() == 0


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = {}, sum(sizes.values()), set(names)
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_match_repeated_sharing(spark, seed):
    rng = random.Random(seed)
    names = [None, "é", "z", "Z", "a", "10", "9"][: rng.randint(1, 7)]
    sizes = {n: rng.choice([0, 1, 7, 100, 5000]) for n in names}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    want = plain_targets(sizes)
    assert found == {n: pytest.approx(want.get(n, 0.0)) for n in names}


def test_mix_comes_near_targets_and_reruns_agree(spark, docs):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        source = "hot" if i % 3 == 0 else rng.choice(["b", "c", None, "ü"])
        rows.append((i, "w " * rng.choice([0, 1, 5, 40]) + "$$$ " * rng.choice([0, 3]), "en", source, 0))
    frame = docs(rows).repartition(5)
    one, many = (
        mixing.mixing_plan(f, rows_per_range=n).select("doc_id", "source", "size", "source_size", "target", "taken")
        for f, n in ((frame, 100), (frame.coalesce(1), 10**6))
    )
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, many.collect()), key=str)
    taken = one.groupBy("source").agg(
        F.sum("taken").alias("t"), F.max("target").alias("want"), F.max("size").alias("most"),
        F.max(F.col("taken") - 3 * F.col("size")).alias("over"), F.sum("size").alias("size"), F.max("source_size").alias("ss"),
    )
    for r in taken.collect():
        assert abs(r.t - r.want) <= r.most and r.over <= 0 and r.size == r.ss
    mixed = mixing.mix(frame)
    assert mixed.columns == frame.columns
    words = mixed.select(F.sum(mixing.word_count(F.coalesce("text", F.lit("")))).alias("n")).first().n
    assert words == one.agg(F.sum("taken")).first()[0]


def test_noisy_documents_are_drawn_later(spark, docs):
    rows = [(i, "word " * 10 if i % 2 else "word$$$ " * 10, "en", "abc"[i % 3], 0) for i in range(1200)]
    plan = mixing.mixing_plan(docs(rows)).where("picked AND source = 'c'").collect()
    clean = sum(r.doc_id % 2 for r in plan)
    assert len(plan) == 150 and clean > 2 * (len(plan) - clean)


def test_repeated_and_null_rows_mix(spark, docs):
    rows = [(None, None, None, None, None), (1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5)]
    plan = mixing.mixing_plan(docs(rows)).collect()
    assert len(plan) == 3 and sum(r.taken for r in plan) == 6
    assert mixing.mix(docs(rows)).where("doc_id = 1").count() == 2
