"""Benchmark decontamination with one Aho-Corasick automaton.

Items and texts are normalised alike (A-Z lowered, everything that is no word
becomes one space). The windows of all items form one automaton; each text
runs through it once, and hits are mapped back to words and to character
offsets of the original text.

An automaton takes some 36 times the bytes of its windows. A benchmark whose
windows exceed AUTOMATON_BYTES is dealt by window hash into parts, and a scan
of the texts against a bitmap of the window hashes tells which parts a text can
hold a window of. Texts and windows of a part meet in tasks that build the
part's automaton once; texts without a candidate go no further.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import bounded_batches, column, free_name, staged

#: Words in a window.
WINDOW = 10
#: Most bytes of windows in one automaton; a larger benchmark is dealt into parts.
AUTOMATON_BYTES = 4 << 20
#: Bits per window of the bitmap that screens texts, and its most 64-bit words (16 MB); a full one costs time only.
BITMAP_BITS, BITMAP_WORDS = 16, 1 << 21
#: Word characters: digits, letters and everything beyond ASCII. In UTF-8 that holds byte by byte.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    """The normalised words, as UTF-8."""
    return (text or "").encode("utf-8", "replace").translate(NORMAL).split()


def windows(item: list[bytes], size: int = WINDOW) -> list[bytes]:
    """Each ``size`` consecutive words; a shorter item is one window."""
    return [b" ".join(item[i:i + size]) for i in range(max(1, len(item) - size + 1))] if item else []


def window_table(spark: SparkSession, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 size: int = WINDOW) -> DataFrame:
    """(window, item_id, code): the distinct windows of each item with their hash. Rows without id or without words are left out."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(w.decode("utf-8"), str(i), int(hashes(w.split(b" "), w.count(b" ") + 1)[0].view(np.int64)))
                    for i, t in zip(batch["item_id"], batch["text"]) for w in windows(words(t), size)]
            yield pd.DataFrame(rows, columns=["window", "item_id", "code"])

    items = benchmark.select(column(benchmark, id_col).cast("string").alias("item_id"),
                             column(benchmark, text_col).alias("text")).dropna()
    return staged(spark, items.mapInPandas(cut, "window string, item_id string, code long").distinct(), "windows")


def part_count(table: DataFrame, most: int = AUTOMATON_BYTES) -> int:
    """As many parts as keep the windows of one at about ``most`` bytes."""
    total = table.agg(F.sum(F.octet_length("window") + F.octet_length("item_id") + 16)).head()[0] or 0
    return 1 if total <= most else -(-total * 5 // (4 * most))


def hashes(text: list[bytes], n: int) -> np.ndarray:
    """A 64-bit hash of each ``n`` consecutive words."""
    w = np.fromiter(map(zlib.crc32, text), dtype=np.uint64, count=len(text))
    out = np.full(max(0, len(w) - n + 1), n, dtype=np.uint64)
    for j in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + w[j:j + len(out)]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


def build(found: dict[str, list[str]]):
    """An automaton over ' w1 .. wn ', one character per UTF-8 byte; its values are (words, items)."""
    tree = ahocorasick.Automaton()
    for w, items in found.items():
        tree.add_word(f" {w.encode().decode('latin-1')} ", (w.count(" ") + 1, items))
    if found:
        tree.make_automaton()
    return tree


def matches(tree, text: str) -> list[tuple[int, int, list[str]]]:
    """(first word, words, items) of every window that occurs in a normalised text ' w1 .. wn '."""
    raw = [(end, v) for end, v in tree.iter(text)] if len(tree) else []
    if not raw:
        return []
    spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), dtype=np.uint8) == 32)
    last = np.searchsorted(spaces, [end for end, _ in raw])  # the k-th space ends word k - 1
    return [(int(k) - n, n, items) for k, (_, (n, items)) in zip(last, raw)]


def covered(found: list[tuple[int, int]], n_words: int) -> np.ndarray:
    """Which words lie in a window."""
    steps = np.zeros(n_words + 1, dtype=np.int64)
    for first, n in found:
        steps[first] += 1
        steps[first + n] -= 1
    return np.cumsum(steps[:-1]) > 0


def spans(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs of hit words as (start, end) character offsets of the original text."""
    at = [m.span() for m in WORD.finditer(text)]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return [(at[i][0], at[j - 1][1]) for i, j in zip(edges[::2], edges[1::2])]


#: What a text's hits are told as.
FIELDS = ["n_words", "n_hit", "items", "starts", "ends"]
FOUND = "n_words long, n_hit long, items array<string>, starts array<long>, ends array<long>"


def told(text: str | None, w: list[bytes], got: list[tuple[int, int]], items: list[str]) -> tuple:
    """A row of FOUND from (first word, words) of the windows in a text, and the items they belong to."""
    if not got:
        return len(w), 0, [], [], []
    hit = covered(got, len(w))
    runs = spans(text, hit)
    return len(w), int(hit.sum()), items, [a for a, _ in runs], [b for _, b in runs]


def run_through(tree, w: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
    """(first word, words) of every window in a text's words, and the sorted items."""
    got = matches(tree, (b" " + b" ".join(w) + b" ").decode("latin-1"))
    return [(first, n) for first, n, _ in got], sorted({i for _, _, items in got for i in items})


def finder(spark: SparkSession, table: DataFrame):
    """A column function text -> struct FOUND over the windows of ``table``, which fit one automaton."""
    found: dict[str, list[str]] = defaultdict(list)
    for w, i in table.select("window", "item_id").toLocalIterator():
        found[w].append(i)
    shared = spark.sparkContext.broadcast(dict(found))

    @F.pandas_udf(FOUND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tree = build(shared.value)
        for batch in batches:
            texts = [words(t) for t in batch]
            yield pd.DataFrame([told(t, w, *run_through(tree, w)) for t, w in zip(batch, texts)], columns=FIELDS)

    return find


def bitmap(table: DataFrame) -> np.ndarray:
    """The bits of the windows' hashes, as at most BITMAP_WORDS 64-bit words; Spark folds the bits of a word."""
    size = 1 << 10
    while size < BITMAP_WORDS and size * 64 < BITMAP_BITS * table.count():
        size *= 2
    at = F.shiftrightunsigned("code", 6).bitwiseAND(F.lit(size - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("code").bitwiseAND(F.lit(63)).cast("int"))
    out = np.zeros(size, dtype=np.int64)
    for r in table.groupBy(at.alias("at")).agg(F.bit_or(bit).alias("bits")).toLocalIterator():
        out[r["at"]] = r["bits"]
    return out.view(np.uint64)


def part_of(code, parts: int):
    """A window's part, from the upper bits of its hash."""
    return F.pmod(F.shiftrightunsigned(code, 40), F.lit(parts)).cast("int")


def found_in_parts(spark: SparkSession, docs: DataFrame, text_col: str, name: str, table: DataFrame, parts: int) -> DataFrame:
    """``docs`` with the struct FOUND as ``name``, over windows that are dealt into ``parts`` automata.

    Equal texts are looked through once. A part's texts are spread over pieces
    by their hash; each piece gets the part's windows first, so that its task
    holds one automaton at a time and streams the texts.
    """
    lengths = sorted(r["n"] for r in table.select((F.length("window") - F.length(F.replace("window", F.lit(" "))) + 1).alias("n"))
                     .distinct().collect())  # WINDOW at most
    shared = spark.sparkContext.broadcast(bitmap(table))

    @F.pandas_udf("array<int>")
    def candidates(texts: pd.Series) -> pd.Series:
        bits, out = shared.value, []
        for t in texts:
            w, own = words(t), set()
            for n in lengths:
                code = hashes(w, n)
                held = (bits[((code >> np.uint64(6)) & np.uint64(len(bits) - 1)).astype(np.int64)] >> (code & np.uint64(63))) & np.uint64(1)
                own.update(((code[held == 1] >> np.uint64(40)) % np.uint64(parts)).tolist())
            out.append(sorted(own))
        return pd.Series(out)

    text = column(docs, text_col)
    some = docs.select(F.sha2(text, 256).alias("key"), text.alias("text")).dropna().withColumn("parts", candidates("text"))
    some = staged(spark, some.where(F.size("parts") > 0).dropDuplicates(["key"]), "window-texts")
    pieces = max(8, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // parts))
    leads = table.select(part_of(F.col("code"), parts).alias("part"), F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("piece"),
                         F.lit(0).alias("kind"), F.col("item_id").alias("key"), F.col("window").alias("text"))
    probes = some.select(F.explode("parts").alias("part"), F.pmod(F.xxhash64("key"), F.lit(pieces)).cast("int").alias("piece"),
                         F.lit(1).alias("kind"), "key", "text")

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, tree, found = None, None, defaultdict(list)
        for batch in batches:
            out = []
            for part, piece, kind, key, text in zip(*(batch[c] for c in ("part", "piece", "kind", "key", "text"))):
                if at != (part, piece):
                    at, tree, found = (part, piece), None, defaultdict(list)
                if kind == 0:
                    found[text].append(key)
                    continue
                if tree is None:
                    tree, found = build(found), defaultdict(list)
                got, items = run_through(tree, words(text))
                if got:
                    out.append((key, [first for first, _ in got], [n for _, n in got], items))
            yield pd.DataFrame(out, columns=["key", "first", "n", "items"])

    both = leads.unionByName(probes).repartition(parts * pieces, "part", "piece").sortWithinPartitions("part", "piece", "kind")
    hits = both.mapInPandas(look, "key string, first array<long>, n array<long>, items array<string>").groupBy("key").agg(
        F.flatten(F.collect_list("first")).alias("first"), F.flatten(F.collect_list("n")).alias("n"),  # a row per part of a text
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    @F.pandas_udf(FOUND)
    def tell(texts: pd.Series, first: pd.Series, n: pd.Series, items: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([told(t, words(t), [] if a is None else list(zip(a.tolist(), b.tolist())), [] if i is None else list(i))
                             for t, a, b, i in zip(texts, first, n, items)], columns=FIELDS)

    own = {c: free_name(docs, f"__hit_{c}") for c in ("key", "first", "n", "items")}
    hits = staged(spark, hits, "window-hits").toDF(*own.values())
    both = docs.join(hits, F.sha2(text, 256) == hits[own["key"]], "left")
    return both.withColumn(name, tell(text, own["first"], own["n"], own["items"])).drop(*own.values())


def with_hits(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, name: str, text_col: str = "text", id_col: str = "item_id",
              item_col: str = "text", size: int = WINDOW, most: int = AUTOMATON_BYTES) -> DataFrame:
    """``docs`` with a column ``name``: struct(n_words, n_hit, items, starts, ends).

    A null or empty text has no words. ``items`` are the ids of the items of
    which a window occurs, sorted as strings; starts and ends are offsets in
    the original text. Up to ``most`` bytes of windows make one automaton in
    each task; beyond, texts with a candidate meet the automata of its parts.
    """
    bounded_batches(spark)
    table = window_table(spark, benchmark, id_col, item_col, size)
    parts = part_count(table, most)
    if parts > 1:
        return found_in_parts(spark, docs, text_col, name, table, parts)
    return docs.withColumn(name, finder(spark, table)(column(docs, text_col)))


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", size: int = WINDOW, most: int = AUTOMATON_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, items, starts, ends per row of ``docs``, other columns ignored.

    An empty benchmark hits nothing; repeated rows each get their own result;
    repeated item ids count as one item with the windows of all its rows.
    """
    own = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    return with_hits(spark, own, benchmark, "f", size=size, most=most).select("doc_id", "f.*")


def items_digest(items) -> object:
    """SHA-256 of the comma-joined ids."""
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)


def brute_force(texts: list[tuple], items: list[tuple], size: int = WINDOW) -> list[tuple]:
    """The same rows without an automaton, for tests: (doc_id, n_words, n_hit, items_sha256)."""
    cut = [(str(i), words(t)) for i, t in items if i is not None]
    out = []
    for doc, text in texts:
        w, hit, got = words(text), set(), set()
        for i, item in cut:
            n = min(size, len(item))
            wins = {tuple(item[k:k + n]) for k in range(max(0, len(item) - n + 1))} if item else set()
            for k in range(len(w) - n + 1) if wins else ():
                if tuple(w[k:k + n]) in wins:
                    hit.update(range(k, k + n))
                    got.add(i)
        out.append((doc, len(w), len(hit), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest()))
    return out
