"""Token files: the library's ids, exact round trips, random access."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import token_file

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = ["the", "naïve", "12½", "don't", "日本語", "x" * 40, "​", "\x1c", "\x85", "🙂🙂", "é́", "ß", "<|endoftext|>", "<|x|>", "\U0001e900"]
    line = "this line stands in very many documents, word for word"
    out = [(i, rng.choice((" ", "  ", "\n", "\t ")).join(rng.choices(words, k=rng.randint(1, 60))) + "\n" + line) for i in range(80)]
    out += [(i, line * 40) for i in range(80, 110)] + [(200, None), (201, ""), (202, " \n\n  "), (None, "no id"), (203, "a b c " * 30_000), (204, "z" * 50_000)]
    return out + [(5, out[5][1])]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "q", 0) for i, t in rows], "doc_id long, text string, start long, `range` string, `a.b` string, number int").repartition(3)


@pytest.mark.parametrize("most", [token_file.SHARD_IDS, 500])
def test_written_and_read_back(spark, rows, most):
    folder = token_file.write_tokens(spark, docs_of(spark, rows), BYTE_BPE, most=most)
    got = sorted(((r.doc_id, r.start, np.frombuffer(r.ids, dtype="<u4").tolist()) for r in token_file.read_tokens(spark, folder).collect()), key=lambda r: r[1])
    want = token_file.brute_force([(-1 if i is None else i, t) for i, t in rows], BYTE_BPE)
    assert [(-1 if d is None else d, s, i) for d, s, i in got] == want
    shards = token_file.open_tokens(spark, folder).collect()
    assert all(r.n_ids == sum(r.lengths) for r in shards) and all(r.n_ids <= most or len(r.doc_ids) == 1 for r in shards)


def test_wanted_documents(spark, rows):
    folder = token_file.write_tokens(spark, docs_of(spark, rows), BYTE_BPE, most=3_000)
    wanted = spark.createDataFrame([(5,), (85,), (200,), (203,), (999,), (85,)], "doc_id long")
    got = sorted((r.doc_id, r.n_tokens, np.frombuffer(r.ids, dtype="<u4").tolist()) for r in token_file.find_tokens(spark, folder, wanted).collect())
    assert got == sorted((d, len(i), i) for d, _, i in token_file.brute_force([r for r in rows if r[0] in (5, 85, 200, 203)], BYTE_BPE))


def test_empty_table(spark, rows):
    folder = token_file.write_tokens(spark, docs_of(spark, rows).limit(0), BYTE_BPE)
    assert token_file.read_tokens(spark, folder).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=200), st.integers(1, 12), st.data())
def test_grammar_round_trip(ids, times, data):
    ids = np.array(ids * times, dtype=np.int64)
    g = token_file.Grammar(token_file.pack(ids, 7, least=2))
    assert (g.all() == ids).all()
    assert (g.rules < 7 + np.arange(len(g.rules))[:, None]).all()  # a rule is made of what comes before it
    lo = data.draw(st.integers(0, len(ids)))
    hi = data.draw(st.integers(lo, len(ids)))
    assert (g.between(lo, hi) == ids[lo:hi]).all()
    with pytest.raises(IndexError):
        g.between(0, len(ids) + 1)


def test_grammar_is_smaller_than_ids():
    rng = random.Random(1)
    passages = [[rng.randrange(50_000) for _ in range(60)] for _ in range(50)]
    ids = np.array([i for _ in range(400) for i in rng.choice(passages)])
    g = token_file.Grammar(token_file.pack(ids, 50_257))
    assert (g.all() == ids).all() and len(g.seq) + 2 * len(g.rules) < len(ids) / 3
    with pytest.raises(ValueError):
        token_file.Grammar(b"none")


def test_later_rounds_count_only_pairs_that_may_be_frequent(monkeypatch):
    """A pair that was counted and is rare is not counted again; what is left has no frequent pair."""
    rng = random.Random(5)
    passages = [[rng.randrange(50_000) for _ in range(40)] for _ in range(30)]
    ids = np.array([i for _ in range(300) for i in [*rng.choice(passages), *(rng.randrange(50_000) for _ in range(300))]])
    counted, bincount = [], np.bincount
    monkeypatch.setattr(token_file.np, "bincount", lambda x, **more: counted.append(len(x)) or bincount(x, **more))
    monkeypatch.setattr(token_file, "LAST_GAIN", 0)
    seq, rules, rounds = token_file.repair(ids, 50_257)
    monkeypatch.undo()
    assert len(rounds) > 4 and sum(counted) < 2 * len(ids)
    pairs, n = np.unique((seq[:-1] << 32) | seq[1:], return_counts=True)
    overlaps = (pairs >> 32) == (pairs & 0xFFFFFFFF)
    assert n[~overlaps].max() < 2 * token_file.LEAST
    assert (token_file.Grammar(token_file.pack(ids, 50_257)).all() == ids).all()


def test_splits_every_character_as_the_library_does():
    bpe = token_file.ByteBpe(BYTE_BPE)
    chars = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}1{c}{c} {c}!{c} " for c in chars[i:i + 64]) for i in range(0, len(chars), 64)]
    for text, e in zip(texts, bpe.tok.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(bpe.ids(text), dtype=bpe.type).tolist() == e.ids
        for c in text[1:]:
            assert (c in bpe.same) != (c in bpe.other) or c.isascii()


def test_checksum_of_ids(spark, rows):
    folder = token_file.write_tokens(spark, docs_of(spark, rows[:9]), BYTE_BPE)
    from pyspark.sql import functions as F
    got = {r.doc_id: r.c for r in token_file.read_tokens(spark, folder).select("doc_id", F.crc32("ids").alias("c")).collect()}
    for d, _, ids in token_file.brute_force(rows[:9], BYTE_BPE):
        assert got[d] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
