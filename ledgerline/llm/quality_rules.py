"""Quality rules: tokeniser fertility under a public vocabulary.

For each text: characters per token, the share of byte-fallback tokens, and
the entropy of its tokens. Texts of a language have these within narrow
bands; a text far outside them is no running text of the language. Bands
come from the quartiles of all rows of the language (or script, where no
language is named) that are alike in length, as entropy and noise depend on
it; they are found in one aggregate over the measured table.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import bounded_batches, column, staged

#: Base rules: least words, and the most percent of words in repeated three-word windows.
MIN_WORDS, MAX_REPEAT = 50, 50
#: A band reaches so many quartile distances beyond the quartiles. Rows of a language whose token counts lie
#: between the same powers of two share a band; with fewer rows than this they take their language's, and a
#: language with fewer the band of all.
REACH, MIN_ROWS = 3.0, 30
#: Least distance to the quartiles, so that a very even language does not reject its own, and what is added
#: for short texts where a band spans all lengths, over the square root of their tokens.
LEAST = {"chars_per_token": 0.05, "byte_share": 0.02, "entropy": 0.02}
WIDE = {"chars_per_token": 0.12, "byte_share": 0.03, "entropy": 0.12}
NOISE = {"chars_per_token": 4.0, "byte_share": 0.5, "entropy": 1.0}
SYMBOLS = "#*$%&|<>"
METRICS = ("chars_per_token", "byte_share", "entropy")
SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, chars_per_token double, byte_share double, entropy double, script string"


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more, the first one included."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), dtype=np.int64, count=n)
    k = len(ids)
    pair = w[:-1] * k + w[1:]
    _, pair = np.unique(pair, return_inverse=True)  # numbers below n again, so the next product fits
    _, window, counts = np.unique(pair[:-1] * k + w[2:], return_inverse=True, return_counts=True)
    often = counts[window] > 1
    hit = np.zeros(n, dtype=bool)
    for i in range(3):
        hit[i:n - 2 + i] |= often
    return int(hit.sum())


def dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    seen, n = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            n += line in seen
            seen.add(line)
    return n


def script_of(text: str) -> str:
    """The script of most letters among the distinct ones; '' without letters."""
    names = Counter(unicodedata.name(c, "?").split(" ")[0] for c in set(text) if c.isalpha())
    return min(names, key=lambda s: (-names[s], s)) if names else ""


class Fertility:
    """Measures texts with one sentencepiece vocabulary."""

    def __init__(self, path: str):
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.sp.vocab_size()
        self.is_byte = np.array([self.sp.is_byte(i) for i in range(self.size)])

    def of(self, text: str) -> tuple[int, float | None, float | None, float | None]:
        """(tokens, characters per token, byte share, entropy as a share of the most that so many tokens can have)."""
        counts = np.bincount(np.asarray(self.sp.encode(text, num_threads=1), dtype=np.int64), minlength=1)
        n = int(counts.sum())
        if not n:
            return 0, None, None, None
        at = np.flatnonzero(counts)
        p = counts[at] / n
        most = np.log2(min(n, self.size)) if n > 1 else 1.0
        return n, len(text) / n, float(counts[at][self.is_byte[at]].sum() / n), float(max(0.0, -(p * np.log2(p)).sum()) / most)


def measure(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, band_group and the measures of every row; a null text has no words and no tokens."""

    @F.pandas_udf(SCHEMA)
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fertility = Fertility(path)
        for batch in batches:
            rows = []
            for text in batch:
                text = text or ""
                raw = text.encode("utf-8", "replace")
                words = raw.split()  # white space [\x20\x09-\x0D], as bytes have it
                space = sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
                rows.append((len(words), len(text) - space, sum(raw.count(c.encode()) for c in SYMBOLS), dup_lines(text), repeat_words(words),
                             *fertility.of(text), script_of(text)))
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in SCHEMA.split(", ")])

    lang = column(docs, lang_col) if lang_col in docs.columns else F.lit(None).cast("string")
    m = docs.select(column(docs, id_col).alias("doc_id"), lang.alias("lang"), look(column(docs, text_col)).alias("m"))
    return m.select("doc_id", F.coalesce(F.concat(F.lit("lang:"), "lang"), F.concat(F.lit("script:"), "m.script")).alias("band_group"), "m.*").drop("script")


def octave():
    """Between which powers of two the token count lies; null without tokens."""
    return F.when(F.col("n_tokens") > 0, F.floor(F.log2(F.col("n_tokens"))).cast("int"))


def bands(measured: DataFrame) -> DataFrame:
    """(level, band_group, octave, n_rows) with the bounds lo_x and hi_x of each measure.

    Level 0: a language at one length; 1: a language; 3: all together. The
    quartiles are over all rows that pass the base rules; rows equal in all
    measures, as copies are, count once.
    """
    good = measured.where("n_tokens > 0").where(~base_failed()).select("band_group", octave().alias("octave"), "n_tokens", *METRICS).distinct()
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.percentile_approx(m, [0.25, 0.75], 1000).alias(f"q_{m}") for m in METRICS]
    q = good.rollup("band_group", "octave").agg(F.grouping_id().alias("level"), *aggs)  # quartile sketches of bounded size per group
    out = ["level", "band_group", "octave", "n_rows"]
    for m in METRICS:
        lo, hi = F.col(f"q_{m}")[0], F.col(f"q_{m}")[1]
        least = F.when(F.col("level") == 0, LEAST[m]).otherwise(WIDE[m])
        reach = F.greatest(F.lit(REACH) * (hi - lo), least)
        out += [(lo - reach).alias(f"lo_{m}"), (hi + reach).alias(f"hi_{m}")]
    return q.select(*out)


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def judge(spark: SparkSession, docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The measures of every row with base_failed, the reasons against it, and kept.

    ``reasons``: the measures outside their band. A text without tokens fails
    the base rules. Fewer than MIN_ROWS good rows of a language at one length
    are judged by the bands of the language, and a language with fewer by
    those of all rows; with no good row at all nothing but the base rules
    counts. Repeated rows get equal results, and count once in the quartiles.
    Other columns of ``docs`` are ignored.
    """
    bounded_batches(spark)
    measured = staged(spark, measure(docs, path, id_col, text_col, lang_col), "quality")
    b = staged(spark, bands(measured), "quality-bands")  # a row per language and length
    whole = b.where("level = 3").head()
    bounds = [f"{side}_{m}" for m in METRICS for side in ("lo", "hi")]

    def level(n: int, on: list[str]) -> DataFrame:
        rows = b.where((F.col("level") == n) & (F.col("n_rows") >= MIN_ROWS))
        return rows.select(*on, F.lit(True).alias(f"has_{n}"), *[F.col(c).alias(f"{c}_{n}") for c in bounds])

    rows = (measured.withColumn("octave", octave()).join(level(0, ["band_group", "octave"]), ["band_group", "octave"], "left")
            .join(level(1, ["band_group"]), "band_group", "left"))

    def bound(name: str, sign: int):
        m = name[3:]
        noise = F.lit(sign * NOISE[m]) / F.sqrt(F.greatest("n_tokens", F.lit(1)))
        wide = F.coalesce(F.col(f"{name}_1"), F.lit(None if whole is None else whole[name]).cast("double")) + noise
        return F.when(F.col("has_0"), F.col(f"{name}_0")).otherwise(wide)

    outside = [F.when((F.col(m) < bound(f"lo_{m}", -1)) | (F.col(m) > bound(f"hi_{m}", 1)), F.lit(m)) for m in METRICS]
    failed = base_failed()
    judged = (rows.withColumn("base_failed", failed).withColumn("reasons", F.array_compact(F.array(*outside)))
              .withColumn("kept", ~F.col("base_failed") & (F.size("reasons") == 0)))
    return judged.select(*measured.columns, "base_failed", "reasons", "kept")
