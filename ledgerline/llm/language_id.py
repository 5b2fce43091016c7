"""Language ID by error-correcting output codes.

Each language has a codeword; for each bit a binary n-gram classifier tells
the languages with 1 from those with 0. A text's bits are decoded to the
codeword with the least weighted loss, and a close second flags it. A text
is ``unlike`` its language where its n-grams fit that language's counts no
better than another language's would: the bound lies half-way between what the
language's own n-grams score and what those of the next language do.

Training counts every hashed byte n-gram of every training row (no sample):
``FEATURES`` counts per language, summed in Spark. What reaches the driver is
the model: languages x FEATURES numbers, however large the table is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import bounded_batches, column

#: Hashed n-gram slots; a language model is this many numbers.
FEATURES = 1 << 14
#: Up to this many languages all two-way splits are bits; beyond, random ones are.
EXHAUSTIVE = 6
#: A score below this, or a lead over the second below it, is ambiguous.
MIN_SCORE, MIN_LEAD = 0.5, 0.2
#: A short text may stray from its language's mean by chance: standard errors of the mean that are let pass.
STRAY = 6
#: What is no word of a language: words with a digit in them, runs of marks.
NO_WORD = re.compile(r"(?<!\S)[^\s\d]*+\d\S*+|[^\w\s]+")
#: Long texts are added up in pieces of so many n-grams.
PIECE = 1 << 16
UNDETERMINED = "und"


def ngram_slots(text: str) -> np.ndarray:
    """The slot of each byte trigram of the lower-cased text, a space at both ends."""
    b = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), dtype=np.uint8).astype(np.uint32)
    h = b[:-2] * np.uint32(65_599 * 65_599 & 0xFFFFFFFF) + b[1:-1] * np.uint32(65_599) + b[2:]
    return (h ^ (h >> np.uint32(15))) & np.uint32(FEATURES - 1)


def codewords(k: int) -> np.ndarray:
    """k rows of bits. Few languages: every split of them (distance 2^(k-2)); many: the best of seeded random codes."""
    if k < 2:
        return np.zeros((k, 0), dtype=np.int8)
    if k <= EXHAUSTIVE:  # the first language is always 1, so no split comes twice
        return np.array([[1] * (2 ** (k - 1) - 1)] + [[(c >> j) & 1 for c in range(2 ** (k - 1) - 1)]
                                                       for j in range(k - 1)], dtype=np.int8)
    rng, width, best, apart = np.random.default_rng(7), int(np.ceil(10 * np.log2(k))), None, -1
    for _ in range(200):
        code = rng.integers(0, 2, (k, width), dtype=np.int8)
        code = code[:, (code.sum(0) > 0) & (code.sum(0) < k)]
        d = (code[:, None, :] != code[None, :, :]).sum(2) + np.eye(k, dtype=int) * width
        if d.min() > apart:
            best, apart = code, d.min()
    return best


@dataclass
class Model:
    """Languages, their codewords (+1/-1), slot weights per bit, and the weight of each bit's loss.

    Per language: ``logs``, the log-probability of each slot; ``bound``, the
    mean of it below which a long text is unlike the language; ``spread``, its
    standard deviation over the language's n-grams.
    """

    langs: list[str]
    code: np.ndarray
    weights: np.ndarray
    trust: np.ndarray
    logs: np.ndarray
    bound: np.ndarray
    spread: np.ndarray


def fit(rows: list[tuple[str, int, int]]) -> Model:
    """The model from (language, slot, count) sums; each language weighs the same in a bit."""
    langs = sorted({r[0] for r in rows})
    counts = np.zeros((len(langs), FEATURES))
    at = {lang: i for i, lang in enumerate(langs)}
    for lang, slot, n in rows:
        counts[at[lang], slot] += n
    p = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True)
    bits = codewords(len(langs))
    weights, trust = np.zeros((FEATURES, bits.shape[1]), dtype=np.float32), np.ones(bits.shape[1])
    for j in range(bits.shape[1]):
        one, zero = p[bits[:, j] == 1].mean(0), p[bits[:, j] == 0].mean(0)
        weights[:, j] = np.log(one / zero)
        trust[j] = ((one - zero) * np.log(one / zero)).sum()  # how far apart the bit's two sides are
    logs = np.log(p)
    fits = np.vstack([p, np.full((1, FEATURES), 1 / FEATURES)]) @ logs.T  # [k, l]: n-grams of k under l; the last k has all alike
    own = np.diag(fits).copy()
    np.fill_diagonal(fits, -np.inf)
    spread = np.sqrt(np.maximum(0, (p * (logs - own[:, None]) ** 2).sum(1)))
    return Model(langs, bits.astype(float) * 2 - 1, weights, trust / trust.mean() if trust.size else trust,
                 logs.astype(np.float32), (own + fits.max(0, initial=-np.inf)) / 2, spread)


def strays(model: Model, language: int, slots: np.ndarray) -> bool:
    """Whether the mean log-probability of n-grams is below the language's bound."""
    mean = sum(model.logs[language].take(slots[i:i + PIECE]).sum(dtype=np.float64) for i in range(0, len(slots), PIECE)) / len(slots)
    return bool(mean < model.bound[language] - STRAY * model.spread[language] / np.sqrt(len(slots)))


def unlike(model: Model, language: int, text: str, slots: np.ndarray) -> bool:
    """Whether neither a text nor its words alone are of the language, nor of another one; words with a digit, and marks, tell no language."""
    if not strays(model, language, slots):
        return False
    own = " ".join(NO_WORD.sub(" ", text).split())
    words = ngram_slots(own) if own else slots[:0]
    return bool(own) and all(strays(model, k, slots) and strays(model, k, words) for k in range(len(model.langs)))


def decode(model: Model, text: str | None) -> tuple[str, float, float, bool]:
    """(language, score, lead over the second, unlike). Score: softmax of the negative weighted losses."""
    if not text or not any(map(str.isalpha, text)) or not model.langs:
        return UNDETERMINED, 0.0, 0.0, True
    slots = ngram_slots(text)
    if len(model.langs) == 1:
        return model.langs[0], 1.0, 1.0, unlike(model, 0, text, slots)
    z = np.zeros(model.weights.shape[1])
    for i in range(0, len(slots), PIECE):
        z += model.weights.take(slots[i:i + PIECE], axis=0).sum(0, dtype=np.float64)
    z /= np.sqrt(len(slots))  # neighbouring n-grams are not independent evidence
    loss = (np.logaddexp(0, -model.code * z) * model.trust).sum(1)
    e = np.exp(loss.min() - loss)
    e /= e.sum()
    order = np.argsort(-e, kind="stable")
    return model.langs[order[0]], float(e[order[0]]), float(e[order[0]] - e[order[1]]), unlike(model, order[0], text, slots)


def train(spark: SparkSession, rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on all rows that have a text and a language."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                if lang not in sums:
                    sums[lang] = np.zeros(FEATURES, dtype=np.int64)
                sums[lang] += np.bincount(ngram_slots(text), minlength=FEATURES)
        for lang, c in sums.items():
            at = np.flatnonzero(c)
            yield pd.DataFrame({"lang": lang, "slot": at.astype("int32"), "n": c[at]})

    bounded_batches(spark)
    known = rows.select(column(rows, text_col).alias("text"), column(rows, lang_col).alias("lang")).dropna()
    sums = known.mapInPandas(count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    return fit([tuple(r) for r in sums.collect()])  # bounded: languages x FEATURES


def predictor(spark: SparkSession, model: Model):
    """A column function text -> struct(lang_pred, score, ambiguous, unlike)."""
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # FEATURES x bits numbers

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean, unlike boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        found = [decode(shared.value, t) for t in texts]
        return pd.DataFrame({"lang_pred": [f[0] for f in found], "score": [f[1] for f in found],
                             "ambiguous": [f[0] == UNDETERMINED or f[1] < MIN_SCORE or f[2] < MIN_LEAD for f in found],
                             "unlike": [f[3] for f in found]})

    return predict


def held_out(doc_id) -> object:
    """Every third document by the checksum of its id is kept from training (null id: not held out)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def train_split(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang") -> Model:
    """The model of all rows that are not held out; rows without id, text or language teach nothing."""
    ids = column(docs, id_col)
    return train(spark, docs.where(ids.isNotNull() & ~held_out(ids)), text_col, lang_col)


def identify(spark: SparkSession, docs: DataFrame, model: Model | None = None, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous, unlike for every row.

    A null text, or one without a letter, is ``und`` with score 0, ambiguous
    and unlike; so is everything when no row teaches a language. Repeated rows
    get equal answers. Other columns of ``docs`` are ignored.
    """
    model = model or train_split(spark, docs, id_col, text_col, lang_col)
    out = predictor(spark, model)(column(docs, text_col))
    return (docs.select(column(docs, id_col).alias("doc_id"), held_out(column(docs, id_col)).alias("held_out"),
                        out.alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score", "p.ambiguous", "p.unlike"))
