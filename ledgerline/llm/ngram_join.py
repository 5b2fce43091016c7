"""N-gram Jaccard join as a blocked sparse matrix product, and its groups.

The incidence matrix has a row per distinct n-gram set and a column per
n-gram. Two sets with Jaccard similarity t or more share an n-gram among the
first ``n - ceil(t n) + 1`` of each, in any order common to all. So the
product runs over that part of the matrix only, with rare n-grams first:
columns are the blocks and entries of a column pair up. At the first column
that a pair has in common its overlap is at most 1 plus the shorter rest of
the two rows; a pair whose bound cannot reach what its sizes ask is
discarded, the others get their overlap counted over the whole rows.

Within a column every row first meets one leader; once rows are known to be
linked, only pairs of different groups are made. So a group of m near copies
costs m pairs where they are linked through leaders, not m^2, and no link
between two groups is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import bounded_batches, column, free_name, staged

#: Words in an n-gram, and the least similarity of a link, as a fraction of whole numbers.
N, SIMILARITY = 4, Fraction(85, 100)
#: Counters of the frequency sketch (fixed size, all n-grams of all rows), and counters in one block of it.
SKETCH, BLOCK = 1 << 24, 1 << 18
#: Bits of the filters for n-grams and sets that are needed again (fixed size; a fuller filter lets more through).
FILTER = 1 << 26

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_P, _PINV = 0x100000001B3, pow(0x100000001B3, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Grams:
    """The hashed n-gram set of a text: 64 bits an n-gram, sorted, each once."""

    def __init__(self, n: int = N):
        self.n = n
        self.odd = [_U(int.from_bytes(hashlib.sha256(f"place {i}".encode()).digest()[:8], "big") | 1) for i in range(n)]
        self._grow(1 << 16)

    def _grow(self, size: int) -> None:
        self.up, self.down = (np.empty(size, dtype=_U) for _ in range(2))
        for a, base in ((self.up, _P), (self.down, _PINV)):
            a[0], have = 1, 1
            while have < size:  # powers by doubling
                step = min(have, size - have)
                a[have:have + step] = a[:step] * _U(pow(base, have, 1 << 64))
                have += step

    def of(self, text: str | None) -> np.ndarray:
        """A-Z lowered, words between white space [\\x20\\x09-\\x0D]; fewer than n words are one n-gram, none none."""
        words = (text or "").encode("utf-8", "replace").lower().split()
        if not words:
            return np.empty(0, dtype=_U)
        raw = b" ".join(words)
        b = np.frombuffer(raw, dtype=np.uint8).astype(_U)
        if len(b) >= len(self.up):
            self._grow(2 * len(b))
        total = np.concatenate((np.zeros(1, dtype=_U), np.cumsum((b + _U(1)) * self.up[:len(b)])))
        spaces = np.flatnonzero(b == 32)
        start, end = np.concatenate(([0], spaces + 1)), np.concatenate((spaces, [len(b)]))
        word = _mix((total[end] - total[start]) * self.down[start])
        k = min(self.n, len(words))
        out = word[:len(words) - k + 1] * self.odd[0]
        for i in range(1, k):
            out += word[i:len(words) - k + 1 + i] * self.odd[i]
        out = _mix(out + _U(k))
        out.sort()
        return out[np.concatenate(([True], out[1:] != out[:-1]))]


def node_of(grams: np.ndarray) -> int:
    """64 bits of the whole set: equal sets are one row of the matrix."""
    if not len(grams):
        return 0
    return int(np.add.reduce(_mix(grams * _ODD) ^ _U(len(grams))).astype(np.int64))


def prefix_length(n: int, t: Fraction) -> int:
    return n - -(-n * t.numerator // t.denominator) + 1


def _classes(spark: SparkSession, texts: DataFrame, n: int) -> tuple[DataFrame, bytes]:
    """(doc_id, node, size) of every row, and the sketch: a byte per counter, its count's binary logarithm.

    Each task adds its n-grams to its own counters and writes them packed;
    counters of a block are added up by the task that gets the block. The
    sketch only orders n-grams, so counts that share a counter cost time, never results.
    """
    id_type = texts.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, counters, seen = Grams(n), np.zeros(SKETCH, dtype=np.uint16), 0
        for batch in batches:
            nodes, sizes = [], []
            for text in batch["text"]:
                g = grams.of(text)
                nodes.append(node_of(g))
                sizes.append(len(g))
                counters[(g & _U(SKETCH - 1)).astype(np.int64)] += 1  # a text adds 1 to a counter at most
                seen += 1
                if seen % 5_000 == 0:
                    np.minimum(counters, 60_000, out=counters)  # far beyond other counts of one task
            yield pd.DataFrame({"doc_id": batch["doc_id"], "node": pd.Series(nodes, dtype="int64"), "size": pd.Series(sizes, dtype="int64"),
                                "block": -1, "data": None})
        for k in range(SKETCH // BLOCK):
            part = counters[k * BLOCK:(k + 1) * BLOCK]
            if part.any():
                planes = np.ascontiguousarray(part.view(np.uint8).reshape(-1, 2).T).tobytes()
                yield pd.DataFrame({"doc_id": [None], "node": [0], "size": [0], "block": [k], "data": [zstandard.compress(planes, 1)]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch["block"], batch["data"]):
                planes = np.frombuffer(zstandard.decompress(bytes(data)), dtype=np.uint8).reshape(2, -1)
                part = np.ascontiguousarray(planes.T).view(np.uint16).ravel()
                sums[k] = sums.get(k, np.zeros(BLOCK, dtype=np.int64)) + part
        for k, v in sums.items():
            yield pd.DataFrame({"block": [k], "data": [np.ceil(np.log2(v + 1.0)).astype(np.uint8).tobytes()]})

    both = staged(spark, texts.mapInPandas(scan, f"doc_id {id_type}, node long, size long, block int, data binary"), "gram-sets")
    blocks = both.where("block >= 0").select("block", "data")
    sketch = bytearray(SKETCH)
    for r in blocks.repartition(SKETCH // BLOCK, "block").mapInPandas(add, "block int, data binary").toLocalIterator():
        sketch[r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = bytes(r["data"])  # SKETCH bytes in all
    return both.where("block < 0").select("doc_id", "node", "size"), bytes(sketch)


def _entries(spark: SparkSession, texts: DataFrame, shared, n: int, t: Fraction, only=None) -> DataFrame:
    """The matrix part that can decide: (gram, node, size, place), rare n-grams first in each row.

    ``only``: a bit filter of the n-grams that are wanted.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, rank = Grams(n), np.frombuffer(shared.value, dtype=np.uint8)
        bits = None if only is None else np.frombuffer(only.value, dtype=np.uint8)
        for batch in batches:
            rows, held = [], 0
            for text in batch["text"]:
                g = grams.of(text)
                if len(g):
                    k = prefix_length(len(g), t)
                    first = g[np.lexsort((g, rank[(g & _U(SKETCH - 1)).astype(np.int64)]))[:k]]
                    place = np.arange(1, k + 1, dtype=np.int32)
                    if bits is not None:
                        keep = _may_hold(bits, first)
                        first, place = first[keep], place[keep]
                    if len(first):
                        rows.append((first, place, node_of(g), len(g)))
                        held += len(first)
                if held > 200_000:
                    yield frame(rows)
                    rows, held = [], 0
            if rows:
                yield frame(rows)

    def frame(rows: list) -> pd.DataFrame:
        lengths = [len(r[0]) for r in rows]
        return pd.DataFrame({"gram": np.concatenate([r[0] for r in rows]).view(np.int64), "place": np.concatenate([r[1] for r in rows]),
                             "node": np.repeat(np.array([r[2] for r in rows], dtype=np.int64), lengths),
                             "size": np.repeat(np.array([r[3] for r in rows], dtype=np.int32), lengths)})

    return texts.select("text").mapInPandas(scan, "gram long, place int, node long, size int")


def _can_reach(t: Fraction, a: str = "", b: str = "o_"):
    """Whether a pair can reach the similarity if this column is the first that it has in common.

    Then nothing before their places is common, and at most the shorter rest
    after them. At a pair's first common column this is a true bound, sizes
    included: overlap * (p + q) >= p * (size + o_size) is J >= p / q.
    """
    reach = 1 + F.least(F.col(f"{a}size") - F.col(f"{a}place"), F.col(f"{b}size") - F.col(f"{b}place"))
    return reach * (t.numerator + t.denominator) >= (F.col(f"{a}size") + F.col(f"{b}size")) * t.numerator


def _bits(spark: SparkSession, keys: DataFrame, name: str):
    """A broadcast bit filter of FILTER bits over a long column, made by Spark's bitmap aggregate."""
    bit = F.pmod(name, F.lit(FILTER)) + 1
    maps = (keys.groupBy(F.bitmap_bucket_number(bit).alias("b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).toLocalIterator())
    bits = np.zeros(FILTER // 8, dtype=np.uint8)
    for r in maps:  # FILTER bits in all
        part = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
        bits[(r["b"] - 1) * 4096:(r["b"] - 1) * 4096 + len(part)] = part
    return spark.sparkContext.broadcast(bits.tobytes())


def _may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = (keys & _U(FILTER - 1)).astype(np.int64)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & np.uint8(1) == 1


def _sets(texts: DataFrame, needed: DataFrame, n: int, shared) -> DataFrame:
    """(node, grams) of the sets that ``needed`` names, computed from the texts again.

    ``shared``, a bit filter of them, keeps the other sets from leaving
    Python; the join then takes out what slipped through.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, bits = Grams(n), np.frombuffer(shared.value, dtype=np.uint8)
        seen: set[int] = set()  # a task sends a set of its own rows once
        for batch in batches:
            nodes, sets, held = [], [], 0
            for text in batch["text"]:
                g = grams.of(text)
                node = node_of(g)
                if len(g) and node not in seen and _may_hold(bits, np.array([node]).astype(_U))[0]:
                    seen.add(node)
                    nodes.append(node)
                    sets.append(g.view(np.int64))
                    held += len(g)
                if held > 500_000:
                    yield pd.DataFrame({"node": nodes, "grams": sets})
                    nodes, sets, held = [], [], 0
            if nodes:
                yield pd.DataFrame({"node": nodes, "grams": sets})

    found = texts.select("text").mapInPandas(scan, "node long, grams array<long>")
    return found.join(needed, "node", "left_semi").dropDuplicates(["node"])


def _verified(spark: SparkSession, texts: DataFrame, pairs: DataFrame, n: int, t: Fraction) -> DataFrame:
    """The pairs (node, o_node) whose whole sets reach the similarity."""
    first, second = pairs.select("node").distinct(), pairs.select("o_node").distinct().toDF("node")
    filters = [_bits(spark, x, "node") for x in (first, second)]
    one, other = (_sets(texts, x, n, f) for x, f in zip((first, second), filters))
    both = pairs.join(one, "node").join(other.toDF("o_node", "o_grams"), "o_node")
    overlap = F.size(F.array_intersect("grams", "o_grams"))
    similar = overlap * (t.numerator + t.denominator) >= (F.size("grams") + F.size("o_grams")) * t.numerator
    links = staged(spark, both.where(similar).select("node", "o_node"), "gram-links")
    for f in filters:
        f.unpersist()
    return links


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (node, o_node): the smallest node it is connected with.

    Each round every node takes the smallest root among itself, its
    neighbours and its root's root; paths shorten by more than half a round.
    """
    both = staged(spark, links.union(links.select("o_node", "node")).toDF("node", "other").distinct(), "links")
    roots = staged(spark, both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")), "roots")
    while True:
        near = both.join(roots.toDF("other", "root"), "other").select("node", "root")
        least = near.union(roots).groupBy("node").agg(F.min("root").alias("root"))
        hop = roots.toDF("root", "up")
        nxt = staged(spark, least.join(hop, "root", "left").select("node", F.least("root", F.coalesce("up", "root")).alias("root")), "roots")
        moved = nxt.join(roots.toDF("node", "before"), "node").where("root <> before").limit(1).count()
        roots = nxt
        if not moved:
            return roots


def grouped(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N,
            t: Fraction = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id for every row.

    ``n_shingles``: size of the row's n-gram set. ``component_id``: the
    smallest doc_id reachable by links of similarity ``t`` or more, itself
    included. A text without words, or null, has the empty set and is linked with nothing.
    Rows with equal sets are linked; a row without doc_id takes part, and its
    component_id is the smallest id of the others in its group, null if there is
    none. Rows that share a doc_id and differ in text are separate. Other columns are ignored.
    """
    known = groups(spark, docs, id_col, text_col, n, t)
    least = known.where("size > 0").groupBy("group").agg(F.min("doc_id").alias("least"))
    least = staged(spark, least, "gram-least")  # a table on both sides lets Spark split the rows of a large group
    return known.join(least, "group", "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def first_of_groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N,
                    t: Fraction = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest doc_id (rows without id come last).

    Rows with an empty set are copies of nothing and stay.
    """
    name, one, other = (free_name(docs, x) for x in ("__node", "__lead_id", "__lead_node"))

    @F.pandas_udf("long")
    def node(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grams = Grams(n)
        for batch in batches:
            yield pd.Series([node_of(grams.of(x)) for x in batch], dtype="int64")

    known = groups(spark, docs, id_col, text_col, n, t).where("size > 0")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "node")
    lead = known.groupBy("group").agg(F.min(order).alias("first")).select(F.col("first.doc_id").alias(one), F.col("first.node").alias(other))
    lead = staged(spark, lead, "gram-leads")
    marked = docs.withColumn(name, node(column(docs, text_col)))
    kept = marked.join(lead, marked[name].eqNullSafe(lead[other]) & column(marked, id_col).eqNullSafe(lead[one]), "left_semi")
    first = kept.dropDuplicates([name])  # of equal rows, one
    return first.unionByName(marked.where(F.col(name) == 0)).drop(name)


def groups(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, n: int, t: Fraction) -> DataFrame:
    """(doc_id, node, size, group) of every row; the group is a node's, null for the empty set."""
    texts = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    bounded_batches(spark)
    rows, sketch = _classes(spark, texts, n)
    rank = spark.sparkContext.broadcast(sketch)
    held = _entries(spark, texts, rank, n, t).groupBy("gram").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    columns = staged(spark, held.where("a < b").select("gram"), "gram-columns")
    wanted = _bits(spark, columns, "gram")
    entries = _entries(spark, texts, rank, n, t, wanted).join(columns, "gram")
    # rows of equal texts are one row of the matrix
    entries = staged(spark, entries.dropDuplicates(["gram", "node"]), "gram-entries")
    rank.unpersist()
    wanted.unpersist()
    pairs = staged(spark, _leader_pairs(entries, t), "gram-pairs")
    links = _verified(spark, texts, pairs, n, t)
    roots = components(spark, links)
    tested = pairs.select(F.least("node", "o_node").alias("node"), F.greatest("node", "o_node").alias("o_node"))
    cross = staged(spark, _cross_pairs(entries, roots, t).join(tested, ["node", "o_node"], "left_anti"), "gram-pairs")
    more = _verified(spark, texts, cross, n, t)
    roots = components(spark, links.union(more))
    known = rows.join(roots, "node", "left")
    return known.select("doc_id", "node", "size", F.when(F.col("size") > 0, F.coalesce("root", "node")).alias("group"))


def _leader_pairs(entries: DataFrame, t: Fraction) -> DataFrame:
    """(node, o_node): every entry against the leader of its column, the row that has it earliest.

    Such a row has the fewest n-grams of its own, so it is near the middle of a group of near copies.
    """
    leads = entries.groupBy("gram").agg(F.min(F.struct(F.col("place").alias("o_place"), F.col("node").alias("o_node"), F.col("size").alias("o_size"))).alias("l"))
    pairs = entries.join(leads, "gram").select("node", "size", "place", "l.*").where((F.col("node") != F.col("o_node")) & _can_reach(t))
    return pairs.select("node", "o_node").distinct()


def _cross_pairs(entries: DataFrame, roots: DataFrame, t: Fraction) -> DataFrame:
    """(node, o_node): the pairs of two groups that share a column and can reach the similarity at their first one."""
    known = entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = known.groupBy("gram").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("gram")
    left = staged(spark=entries.sparkSession, df=known.join(open_, "gram", "left_semi"), name="gram-open")
    other = left.select("gram", *[F.col(c).alias(f"o_{c}") for c in ("node", "size", "place", "root")])
    pairs = left.join(other, "gram").where((F.col("node") < F.col("o_node")) & (F.col("root") != F.col("o_root")) & _can_reach(t))
    return pairs.select("node", "o_node").distinct()


def brute_force(rows: list[tuple], n: int = N, t: Fraction = SIMILARITY) -> list[tuple]:
    """(doc_id, n_shingles, component_id) over all pairs, for tests."""
    sets = []
    for _, text in rows:
        w = (text or "").encode("utf-8").lower().split()
        k = min(n, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) * t.denominator >= len(sets[i] | sets[j]) * t.numerator:
                root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None and sets[i]:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(s), least.get(find(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))]
