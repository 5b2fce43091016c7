"""Target-distribution importance resampling with segment deduplication.

A document's weight says how much more probable its word n-grams are in a
target corpus than in the documents, both seen through hashed buckets of
n-grams; a seeded Gumbel noise turns the highest scores into a draw without
replacement.

Separator newlines cut texts into lines. Each distinct line of the corpus is
counted once: its n-grams per bucket, times its occurrences. N-grams that
reach over a separator belong to no line; they are counted from the documents
and added.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import bounded_batches, column, staged
from ledgerline.llm.sharding import row_numbers

#: Longest n-grams, buckets, seed of the noise, words that a document needs, and documents drawn out of a hundred.
N, BUCKETS, SEED, MIN_WORDS, PERCENT = 1, 10_000, "2024", 20, 10
#: Words whose bucket a Python worker remembers.
KNOWN_WORDS = 400_000

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str) -> list[str]:
    return WORD.findall(text.encode().lower().decode())  # bytes.lower: A-Z only


class Buckets(dict):
    """Features with their buckets, as far as they were seen; ``of`` maps a bucket to what is asked for."""

    def __init__(self, buckets: int, of=None):
        super().__init__()
        self.buckets, self.of = buckets, of

    def __missing__(self, feature: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        b = zlib.crc32(feature.encode()) % self.buckets
        self[feature] = out = b if self.of is None else self.of[b]
        return out


def line_features(ws: list[str], n: int) -> list[str]:
    """All runs of 1 to ``n`` consecutive words, joined by one space."""
    return ws if n == 1 else [" ".join(ws[i:i + k]) for k in range(1, n + 1) for i in range(len(ws) - k + 1)]


def cross_features(lines: list[list[str]], n: int) -> list[str]:
    """The runs of 2 to ``n`` words of a text that reach over a line's end."""
    if n == 1:
        return []
    ws = [w for line in lines for w in line]
    at = [i for i, line in enumerate(lines) for _ in line]
    return [" ".join(ws[i:i + k]) for k in range(2, n + 1) for i in range(len(ws) - k + 1) if at[i] != at[i + k - 1]]


def bucket_counts(spark: SparkSession, df: DataFrame, text_col: str = "text", n: int = N, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: how many features of all whole texts fall in each bucket that has one.

    Null and empty texts have no features.
    """
    bounded_batches(spark)
    text = column(df, text_col)

    def rows(counts: np.ndarray) -> pd.DataFrame:
        at = np.flatnonzero(counts)
        return pd.DataFrame({"bucket": at, "n": counts[at]})

    def of_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, counts = Buckets(buckets), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for line, times in zip(batch["line"], batch["times"].tolist()):
                found = [known[f] for f in line_features(words(line), n)]
                np.add.at(counts, found, times)
        yield rows(counts)

    def of_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, counts = Buckets(buckets), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for t in batch["text"]:
                np.add.at(counts, [known[f] for f in cross_features([words(x) for x in t.split("\n")], n)], 1)
        yield rows(counts)

    # a line that a third of the rows hold is folded to a row per map task
    lines = df.select(F.explode(F.split(text, "\n")).alias("line")).where("line != ''").groupBy("line").agg(F.count(F.lit(1)).alias("times"))
    out = lines.mapInPandas(of_lines, "bucket int, n long")
    if n > 1:
        out = out.unionByName(df.select(text.alias("text")).where(F.instr("text", "\n") > 0).mapInPandas(of_ends, "bucket int, n long"))
    return out.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """floor(1000 ln of the smoothed ratio of the target's and the documents' share) per bucket."""
    s_all, t_all = float(sum(documents.values()) + buckets), float(sum(target.values()) + buckets)
    return [math.floor(1000 * math.log(float(target.get(b, 0) + 1) * s_all / (float(documents.get(b, 0) + 1) * t_all))) for b in range(buckets)]


def noise(doc: str, seed: str = SEED) -> int:
    """Gumbel noise in thousandths, by the seed and the document's id."""
    h = int(hashlib.sha256(f"{seed}:{doc}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scorer(gain: list[int], n: int, seed: str):
    @F.pandas_udf("struct<n_words: long, n_features: long, weight: long, score: long>")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        known = Buckets(len(gain), gain)
        for ids, texts in batches:
            out, of_line = [], {}  # a line that comes again in the batch is looked up
            for doc, text in zip(ids, texts):
                lines = (text or "").split("\n")
                n_words = n_features = total = 0
                for line in lines:
                    if line not in of_line:
                        ws = words(line)
                        found = line_features(ws, n)
                        of_line[line] = len(ws), len(found), sum([known[f] for f in found])
                    a, b, c = of_line[line]
                    n_words, n_features, total = n_words + a, n_features + b, total + c
                if n > 1 and len(lines) > 1:
                    found = cross_features([words(x) for x in lines], n)
                    n_features, total = n_features + len(found), total + sum([known[f] for f in found])
                weight = total // n_features if n_features else 0
                out.append((n_words, n_features, weight, weight + noise(doc, seed)))
            yield pd.DataFrame(out, columns=["n_words", "n_features", "weight", "score"])

    return score


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, n: int = N, buckets: int = BUCKETS, seed: str = SEED,
             min_words: int = MIN_WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank: every document; ``rank`` is 1, 2, 3... for those drawn, else null.

    Of the documents with ``min_words`` words, floor(percent * count / 100) of
    the highest scores are drawn, ties to the smaller id (null first). The
    weight is the floored mean of the gains of a document's features, 0
    without any (null or empty text). The noise hashes the id as text, a null
    one as an empty text. Equal rows share a score and take neighbouring
    ranks. Empty tables of documents or targets are allowed; other columns are
    ignored. What passes through the driver are two counts per bucket.
    """
    if n < 1 or buckets < 1 or not 0 <= percent <= 100:
        raise ValueError("n and buckets must be positive, percent between 0 and 100")
    own = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    counted = [{r.bucket: r.n for r in bucket_counts(spark, df, c, n, buckets).collect()}  # bounded: a row per bucket
               for df, c in ((own, "text"), (target, target_text))]
    score = _scorer(gains(*counted, buckets), n, seed)
    scored = own.select("doc_id", score(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text")).alias("s")).select("doc_id", "s.*")
    scored = staged(spark, scored, "resample-scores")
    able = F.col("n_words") >= min_words
    ranked, count = row_numbers(spark, scored.where(able).withColumn("less", -F.col("score")), ["less", "doc_id"], "place")
    drawn = count * percent // 100
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    return (ranked.select("doc_id", "n_features", "weight", "score", rank.cast("long").alias("rank"))
            .unionByName(scored.where(~able).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))))


def brute_force(rows: list[tuple], target: list, n: int = N, buckets: int = BUCKETS, seed: str = SEED, min_words: int = MIN_WORDS,
                percent: int = PERCENT) -> list[tuple]:
    """The rows of ``resample`` text by text, for tests. Ids must not be null."""
    def features(text):
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        return len(ws), [zlib.crc32(" ".join(ws[i:i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(ws) - k + 1)]

    def tally(texts):
        out: dict[int, int] = {}
        for t in texts:
            for b in features(t)[1]:
                out[b] = out.get(b, 0) + 1
        return out

    s, t = tally([x for _, x in rows]), tally(target)
    gain = {b: math.floor(1000 * math.log((t.get(b, 0) + 1.0) * (sum(s.values()) + buckets) / ((s.get(b, 0) + 1.0) * (sum(t.values()) + buckets))))
            for b in range(buckets)}
    scored = []
    for doc, text in rows:
        n_words, found = features(text)
        weight = math.floor(sum(gain[b] for b in found) / len(found)) if found else 0
        h = int(hashlib.sha256(f"{seed}:{doc}".encode()).hexdigest()[:8], 16)
        scored.append((doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), n_words >= min_words))
    order = sorted((r for r in scored if r[4]), key=lambda r: (-r[3], r[0]))
    out = [(*r[:4], i + 1 if i < percent * len(order) // 100 else None) for i, r in enumerate(order)]
    return out + [(*r[:4], None) for r in scored if not r[4]]
