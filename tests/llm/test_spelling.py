"""Spelling variants: the composition against comparing all words with all."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import spelling


def made(seed=3, n=400):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdelmnosté", k=rng.randint(7, 11))) for _ in range(40)]
    base += ["balloonist", "ballooonist", "aaaaaaaa", "aaaaaaaaa", "aaaaaaab", "prefixaa" + "z" * 30, "prefixab" + "z" * 30, "z" * 300]
    out = []
    for i in range(n):
        words = []
        for _ in range(30):
            w = rng.choice(base[:8] * 6 + base)
            for _ in range(rng.choice((0,) * 12 + (1, 1, 2))):
                k = rng.randrange(len(w))
                w = rng.choice((w[:k] + w[k + 1:], w[:k] + rng.choice("abez") + w[k:], w[:k] + rng.choice("abez") + w[k + 1:]))
            words.append(rng.choice((w, w, w.upper(), w.title())))
        out.append((i, "12 ".join(words[:10]) + "\n" + " ".join(words[10:])))
    out += [(5, out[5][1]), (None, "balloonist ballooonist"), (7, None), (8, ""), (9, "... 77"), (10, "ÀÉÎÕÜßÿ ÀÉÎÕÜßÿ Àéîõüßÿ×÷")]
    return out


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "q") for i, t in rows], "doc_id long, text string, word string, n int, `a.b` string").repartition(3)


def sort(rows):
    return sorted(map(repr, map(tuple, rows)))


@pytest.mark.parametrize("most", [spelling.MOST_CHARS, 60])
def test_variants_equal_brute_force(spark, most):
    rows = made()
    got = spelling.variants(spark, docs_of(spark, rows), ratio=3, most=most)
    want = spelling.brute_force(rows, ratio=3)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sort(got.collect()) == sort(want)
    assert any(r[1] and r[2] != r[1] for r in want)  # a chain of two forms at least


def test_partitions_are_bounded(spark):
    words = spark.createDataFrame([(f"constan{c}{d}", 2) for c in "abcdefghij" for d in "abcdefghij"], "word string, n long")
    sizes = spelling.partitions(spark, words, most=40).groupBy(*spelling._KEY).agg({"middle": "count"}).collect()
    assert max(r[-1] for r in sizes if r.b - r.a > 1) <= 40 and max(r[-1] for r in sizes) <= 11


def test_empty_and_one_word(spark):
    assert spelling.variants(spark, docs_of(spark, []).limit(0)).count() == 0
    one = spelling.variants(spark, docs_of(spark, [(None, "balloonist balloonist")]), delete_every=0).collect()
    assert [tuple(r) for r in one] == [("balloonist", None, "balloonist", 2, 0, None)]
    with pytest.raises(ValueError):
        spelling.variants(spark, docs_of(spark, []), ratio=1)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abc", min_size=4, max_size=4), max_size=30), st.sets(st.text("abc", min_size=3, max_size=3), max_size=12),
       st.sampled_from(["", "a", "cab"]))
def test_composition_finds_each_pair_once(longer, shorter, tail):
    got = list(spelling.near_in_partition(sorted(longer) + sorted(shorter), 4, tail))
    want = [(x, y) for x in longer for y in longer if x < y and sum(c != d for c, d in zip(x, y)) == 1]
    for x in longer:
        for y in shorter:
            spots = [i for i in range(4) if x[:i] + x[i + 1:] == y]
            if spots and not (x[spots[-1]:] == x[spots[-1]] and tail[:1] == x[-1]):
                want.append((x, y))
    assert sorted(got) == sorted(want)


def test_minimal_acceptor_shares_states():
    a = spelling.Acceptor()
    a.root(sorted(x + y for x in "abcd" for y in ("ing", "ung")))
    assert len(a.arcs) == 5  # the end, g, n, i or u, the root
