"""Spelling variant grouping by finite-state composition.

The vocabulary is an acceptor A; T is the transducer that copies a word but
for one inserted, deleted or replaced code point. The pairs that A o T o A
accepts are the pairs of near words.

Composed whole, A would have to lie in one place. It is cut by where T leaves
its initial state. A pair is looked for in the class L, the length of its
longer word; a window [a, b) of edit positions then fixes what lies before a
and after b: the two words share it. So all words of a class with the same
head and tail are one partition of the composition, entered in the state that
the head leads to. Each partition builds the minimal acceptor of the words'
middles, composes it with T and itself, and enumerates the accepted pairs.
Windows begin as the two halves of a class; a partition with more than
MOST_CHARS of middles is cut into the two halves of its window, and so on to
one position, where it holds at most one word per code point of the alphabet
and one without. No partition is dropped or capped.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import bounded_batches, column, staged

#: Shortest word, fewest occurrences of a word, and how much more frequent its form must be.
MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
#: One in so many runs loses a code point before it is counted.
DELETE_EVERY = 31
#: Code points of middles in a partition before its window is halved; bounds a partition's automaton.
MOST_CHARS = 200_000
#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 200_000


# ---------------------------------------------------------------- vocabulary

def vocabulary(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, delete_every: int = DELETE_EVERY) -> DataFrame:
    """word, n: the words of all whole texts.

    A word is a maximal run of A-Z, a-z, U+00C0-U+00FF, A-Z lower-cased; of
    every run whose crc32 of ``<doc_id>:<run>`` is divisible by
    ``delete_every`` (0: none), the code point at crc32 mod length is left out.
    Null texts have no words; a null id counts as an empty one.
    """
    run = re.compile(rf"[a-zÀ-ÿ]{{{min_length},}}")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch["id"], batch["text"]):
                start = zlib.crc32(f"{doc}:".encode())
                for w, n in Counter(run.findall(text.encode().lower().decode())).items():  # bytes.lower: A-Z only
                    h = zlib.crc32(w.encode(), start)
                    if delete_every and h % delete_every == 0:
                        k = h % len(w)
                        w = w[:k] + w[k + 1:]
                        if len(w) < min_length:
                            continue
                    held[w] += n
                if len(held) > HELD_WORDS:
                    yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                    held = Counter()
        if held:
            yield pd.DataFrame({"word": list(held), "n": list(held.values())})

    own = docs.select(F.coalesce(column(docs, id_col).cast("string"), F.lit("")).alias("id"), column(docs, text_col).alias("text"))
    bounded_batches(spark)
    counted = own.where(F.col("text").isNotNull()).mapInPandas(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---------------------------------------------------------------- acceptor and composition

class Acceptor:
    """Minimal acyclic acceptor of several word lists, with one root each; states with the same right language are one."""

    def __init__(self):
        self.arcs: list[dict[str, int]] = [{}]  # state 0: the end of a word
        self.known: dict[tuple, int] = {(): 0}

    def root(self, words: list[str]) -> int:
        """The state that accepts ``words``: sorted, distinct, all of one length."""
        open_: list[dict[str, int]] = [{}]  # states on the path of the last word, not yet shared
        last = ""
        for w in words:
            same = 0
            while same < len(last) and w[same] == last[same]:
                same += 1
            self._close(open_, last, same)
            open_ += [{} for _ in range(len(w) - same)]
            last = w
        self._close(open_, last, 0)
        return self._state(open_[0]) if last else 0

    def _close(self, open_: list, last: str, depth: int) -> None:
        for at in range(len(last) - 1, depth - 1, -1):
            state = self._state(open_.pop())
            open_[at][last[at]] = state

    def _state(self, arcs: dict[str, int]) -> int:
        key = tuple(arcs.items())  # words come in order, so arcs do
        if key not in self.known:
            self.known[key] = len(self.arcs)
            self.arcs.append(arcs)
        return self.known[key]


class Composition:
    """Acceptor o one-edit transducer o acceptor, from given states on."""

    def __init__(self, acceptor: Acceptor):
        self.arcs = acceptor.arcs
        self.common_: dict[tuple[int, int], list[str]] = {(0, 0): [""]}

    def common(self, p: int, q: int) -> list[str]:
        """The words that both states accept: what T copies after its edit."""
        todo = [(p, q)]
        while todo:
            p_, q_ = todo[-1]
            if (p_, q_) in self.common_:
                todo.pop()
                continue
            left, right = self.arcs[p_], self.arcs[q_]
            steps = [(c, (s, right[c])) for c, s in left.items() if c in right]
            new = [k for _, k in steps if k not in self.common_]
            if new:
                todo += new
            else:
                self.common_[p_, q_] = [c + r for c, k in steps for r in self.common_[k]]
                todo.pop()
        return self.common_[p, q]

    def replaced(self, root: int) -> Iterator[tuple[str, str]]:
        """Pairs of accepted words that differ in one code point, the smaller one first."""
        todo = [(root, "")]
        while todo:
            p, head = todo.pop()
            arcs = list(self.arcs[p].items())
            for i, (c, s) in enumerate(arcs):
                todo.append((s, head + c))
                for d, t in arcs[:i]:
                    for rest in self.common(s, t):
                        yield head + d + rest, head + c + rest

    def deleted(self, root: int, shorter: int, tail: str) -> Iterator[tuple[str, str]]:
        """Pairs of a word from ``root`` and one from ``shorter`` that lacks one of its code points.

        In a row of equal code points the last one counts as deleted, also if the row goes on in ``tail``.
        """
        todo = [(root, shorter, "")]
        while todo:
            p, q, head = todo.pop()
            right = self.arcs[q]
            for c, s in self.arcs[p].items():
                if c in right:
                    todo.append((s, right[c], head + c))
                for rest in self.common(s, q):
                    if (rest or tail)[:1] != c:
                        yield head + c + rest, head + rest


def near_in_partition(middles: list[str], longest: int, tail: str) -> Iterator[tuple[str, str]]:
    """Near pairs among middles of length ``longest`` and ``longest`` - 1, but for pairs of two shorter ones."""
    acceptor = Acceptor()
    longer, shorter = ([m for m in middles if len(m) == n] for n in (longest, longest - 1))
    if not longer:
        return
    root = acceptor.root(longer)
    root_shorter = acceptor.root(shorter) if shorter else None
    both = Composition(acceptor)
    yield from both.replaced(root)
    if root_shorter is not None:
        yield from both.deleted(root, root_shorter, tail)


# ---------------------------------------------------------------- partitions

_KEY = ["L", "a", "b", "head", "tail"]


def _cut(words: DataFrame, windows) -> DataFrame:
    """A row per word and window: the key of its partition, and the middle. ``windows``: array of structs L, a, b."""
    x = words.select("word", "n", F.explode(windows).alias("w")).select("word", "n", "w.*")
    size = F.char_length("word")
    end = F.col("b") - (F.col("L") - size)  # the shorter word's middle is one shorter
    return x.select("L", "a", "b", F.expr("substring(word, 1, a)").alias("head"),
                    F.substring("word", end + 1, size).alias("tail"),
                    F.substring("word", F.col("a") + 1, end - F.col("a")).alias("middle"), "n")


def _halves(a, b, cls):
    mid = F.floor((a + b) / 2).cast("int")
    return [F.struct(cls.alias("L"), x.cast("int").alias("a"), y.cast("int").alias("b")) for x, y in ((a, mid), (mid, b))]


def partitions(spark: SparkSession, words: DataFrame, most: int = MOST_CHARS) -> DataFrame:
    """L, a, b, head, tail, middle, n: a row per word and partition of the composition that it takes part in."""
    size = F.char_length("word")
    first = F.array(*_halves(F.lit(0), size, size), *_halves(F.lit(0), size + 1, size + 1))
    rows, done = _cut(words, first), []
    while True:
        total = F.sum(F.char_length("middle"))
        heavy = staged(spark, rows.groupBy(*_KEY).agg(total.alias("__chars")).where((F.col("__chars") > most) & (F.col("b") - F.col("a") > 1))
                       .select(*_KEY), "spelling-heavy")
        if heavy.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(heavy, _KEY, "left_anti"))
        large = rows.join(heavy, _KEY, "left_semi")
        again = large.select(F.concat("head", "middle", "tail").alias("word"), "n", F.array(*_halves(F.col("a"), F.col("b"), F.col("L"))).alias("__w"))
        rows = staged(spark, _cut(again, F.col("__w")), "spelling-rows")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def near_words(spark: SparkSession, words: DataFrame, most: int = MOST_CHARS) -> DataFrame:
    """word, n_near, best (struct of the negated count and the word of its most frequent near word): a row per word
    and partition in which it has near words; each pair is counted in one partition."""
    n_tasks = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = partitions(spark, words, most).repartition(n_tasks, *_KEY).sortWithinPartitions(*_KEY, "middle")

    def enumerate_(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []

        def close(key, count: dict[str, int]) -> None:
            _, a, b, head, tail = key
            if len(count) < 2:
                return
            tally, best = Counter(), {}
            for pair in near_in_partition(list(count), b - a, tail):
                for x, y in (pair, pair[::-1]):
                    tally[x] += 1
                    found = (-count[y], y)
                    if x not in best or found < best[x]:
                        best[x] = found
            out.extend((head + x + tail, k, best[x][0], head + best[x][1] + tail) for x, k in tally.items())

        at, count = None, {}
        for batch in batches:
            for *key, middle, n in zip(*[batch[c].tolist() for c in (*_KEY, "middle", "n")]):
                if key != at:
                    if at is not None:
                        close(at, count)
                    at, count = key, {}
                count[middle] = n
            if out:
                yield pd.DataFrame(out, columns=["word", "n_near", "less", "form"])
                out.clear()
        if at is not None:
            close(at, count)
        if out:
            yield pd.DataFrame(out, columns=["word", "n_near", "less", "form"])

    return dealt.mapInPandas(enumerate_, "word string, n_near long, less long, form string")


# ---------------------------------------------------------------- forms and roots

def variants(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
             min_count: int = MIN_COUNT, ratio: int = RATIO, delete_every: int = DELETE_EVERY, most: int = MOST_CHARS) -> DataFrame:
    """word, form, root, n, n_near, form_n: a row per distinct word of the documents.

    ``form`` is the near word of largest count (ties: the smallest in code-point
    order) if it has ``ratio`` times the word's count, else null; ``root`` is
    reached by following forms, the word itself without one. Counts grow by
    ``ratio`` along forms, so they never run in a circle, and a chain has as
    many steps as the largest count allows: the pointer doubling below needs
    the logarithm of that many rounds. Null and empty texts have no words, an
    empty table gives no rows; repeated rows count again; other columns of
    ``docs`` are ignored.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word")
    words = staged(spark, vocabulary(spark, docs, id_col, text_col, min_length, min_count, delete_every), "spelling-words")
    near = near_words(spark, words, most)
    none = F.lit(None)
    # n and the near words of a word meet in one aggregate
    both = (words.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.cast("long").alias("less"), none.cast("string").alias("form"))
            .unionByName(near.withColumn("n", none.cast("long"))))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct("less", "form")))
    found = both.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    taken = -F.col("best.less") >= ratio * F.col("n")
    found = staged(spark, found.select("word", "n", "n_near", F.when(taken, F.col("best.form")).alias("form"),
                                       F.when(taken, -F.col("best.less")).alias("form_n")), "spelling-forms")
    most_seen = found.agg(F.max("n")).head()[0] or 1
    steps = 0
    while min_count * ratio ** (steps + 1) <= most_seen:
        steps += 1
    links = found.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        on = links.select(F.col("word").alias("__at"), F.col("root").alias("__next"))
        links = staged(spark, links.join(on, F.col("root") == F.col("__at"), "left")
                       .select("word", F.coalesce("__next", "root").alias("root")), "spelling-roots")
    roots = links.select(F.col("word").alias("__word"), F.col("root").alias("__root"))
    return found.join(roots, F.col("word") == F.col("__word"), "left").select(
        "word", "form", F.coalesce("__root", "word").alias("root"), "n", "n_near", "form_n")


def brute_force(rows: list[tuple], min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
                delete_every: int = DELETE_EVERY) -> list[tuple]:
    """The rows of ``variants`` by comparing all words with all, for tests."""
    seen: Counter = Counter()
    for doc, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for w in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if delete_every and h % delete_every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            seen[w] += 1
    words = {w: n for w, n in seen.items() if len(w) >= min_length and n >= min_count}

    def near(x: str, y: str) -> bool:
        if len(x) < len(y):
            x, y = y, x
        if len(x) == len(y):
            return sum(c != d for c, d in zip(x, y)) == 1
        return len(x) == len(y) + 1 and any(x[:i] + x[i + 1:] == y for i in range(len(x)))

    of = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(of[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= ratio * n:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(of[w]), words[form[w]] if w in form else None))
    return out
