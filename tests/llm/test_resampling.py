"""Importance resampling against counting text by text."""

import random

import pytest

from ledgerline.llm import resampling


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    words = ["alpha", "Beta", "GAMMA", "naïve", "Ñandú", "x1", "日本", "don't", "a_b", "c-d"] + [f"w{i}" for i in range(200)]
    often = "the line that many documents hold, word for word"
    out = [(i, "\n".join([" ".join(rng.choices(words[:rng.choice((10, 60, 200))], k=rng.randint(0, 25))) for _ in range(rng.randint(1, 6))] + [often] * (i % 4)))
           for i in range(120)]
    return out + [(300, None), (301, ""), (302, "\n\n \n"), (303, "one\ntwo\nthree"), (304, "beta " * 5_000), (305, "...")] + [out[7], out[7]]


TARGET = ["alpha beta gamma w1 w2", "Beta naïve\nw3", None, "", "w1"]


def frames(spark, rows, target):
    docs = spark.createDataFrame([(i, t, 1, "x", "q", 2) for i, t in rows], "doc_id long, text string, score int, `less` string, `a.b` string, place int").repartition(3)
    return docs, spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")


def sort(rows):
    return sorted(map(repr, map(tuple, rows)))


@pytest.mark.parametrize("n, buckets, percent", [(1, 10_000, 10), (3, 500, 35), (2, 1, 100)])
def test_resample_equals_brute_force(spark, rows, n, buckets, percent):
    got = resampling.resample(spark, *frames(spark, rows, TARGET), n=n, buckets=buckets, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sort(got.collect()) == sort(resampling.brute_force(rows, TARGET, n, buckets, percent=percent))


def test_lines_and_their_ends_make_all_features(spark, rows):
    docs, _ = frames(spark, rows, TARGET)
    got = {r.bucket: r.n for r in resampling.bucket_counts(spark, docs, n=3, buckets=97).collect()}
    want: dict = {}
    for _, t in rows:
        for f in resampling.line_features(resampling.words((t or "").replace("\n", " ")), 3):
            b = resampling.Buckets(97)[f]
            want[b] = want.get(b, 0) + 1
    assert got == want


def test_empty_tables_and_null_ids(spark, rows):
    docs, target = frames(spark, rows, TARGET)
    assert resampling.resample(spark, docs.limit(0), target).count() == 0
    alone = resampling.resample(spark, docs, target.limit(0))
    assert sort(alone.collect()) == sort(resampling.brute_force(rows, []))
    none = spark.createDataFrame([(None, "word " * 30), (1, "word " * 30)], "doc_id long, text string")
    got = {r.doc_id: r for r in resampling.resample(spark, none, target, percent=100).collect()}
    assert got[None].score == got[None].weight + resampling.noise("") and {r.rank for r in got.values()} == {1, 2}
    with pytest.raises(ValueError):
        resampling.resample(spark, docs, target, percent=101)
