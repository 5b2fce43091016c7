"""Line dedup that can be undone: exact reference counts behind sharded cuckoo filters.

``LineIndex`` holds two tables. ``refs`` has one row per (line key, document)
with the number of such lines: the exact state. ``filters`` has one cuckoo
filter per shard of the key space with the fingerprints of the keys that
enough documents hold; fingerprints can be taken out again, so inserting and
deleting documents keeps both in step. A line whose key misses its filter is
not repeated, and never reaches the exact join.

An index that is to be changed is stored with a folder per shard
(``stored_by_shard``). Inserting or deleting documents then reads and writes
the shards of their lines alone.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import bounded_batches, column, free_name, shared_folder, staged

#: A key counts from so many code points on, and is repeated from so many documents on.
MIN_CHARS, MIN_DOCS = 20, 3
#: White space that is stripped from a line to make its key.
STRIP = " \t\n\x0b\x0c\r"
#: Cuckoo filter: slots in a bucket, kicks before it counts as full, load it is sized for, keys per shard.
SLOTS, KICKS, LOAD, SHARD_KEYS = 4, 500, 0.8, 1 << 15
#: Filters are broadcast up to so many bytes in all; larger ones meet the rows of their own shard.
FILTER_BYTES = 32 << 20
#: Rows of ``refs`` in a shard that is stored by itself, and the pieces that a shard's rows are spread over when filters meet them.
SHARD_REFS, PIECES = 1 << 22, 8
#: So many changes make an index of as many tables; it is then stored anew as one.
MOST_TABLES = 16


def line_key(line: str) -> bytes | None:
    """128 bits of the stripped, A-Z-lowered line; None if it is too short to count."""
    line = line.strip(STRIP)
    if len(line) < MIN_CHARS:
        return None
    return hashlib.blake2b(line.encode("utf-8", "replace").lower(), digest_size=16).digest()


class CuckooFilter:
    """16-bit fingerprints in buckets of four; each has two possible buckets, so it can be found and removed."""

    def __init__(self, table: np.ndarray):
        self.table = table  # buckets x SLOTS, 0 is empty

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(1, int(np.ceil(np.log2(max(1, keys) / LOAD / SLOTS))) if keys else 1)
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16))

    @classmethod
    def read(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, dtype=np.uint16).reshape(-1, SLOTS).copy())

    def write(self) -> bytes:
        return self.table.tobytes()

    def _print(self, key: bytes) -> tuple[int, int]:
        return int.from_bytes(key[8:10], "little") or 1, int.from_bytes(key[10:16], "little") & (len(self.table) - 1)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & (len(self.table) - 1)

    def _put(self, bucket: int, mark: int) -> bool:
        free = np.flatnonzero(self.table[bucket] == 0)
        if len(free):
            self.table[bucket, free[0]] = mark
        return len(free) > 0

    def insert(self, key: bytes) -> bool:
        """False if the filter is full; it is then unchanged."""
        mark, bucket = self._print(key)
        if self._put(bucket, mark) or self._put(self._other(bucket, mark), mark):
            return True
        undo = []
        for kick in range(KICKS):
            slot = (kick * 7 + mark) % SLOTS
            undo.append((bucket, slot, int(self.table[bucket, slot])))
            mark, self.table[bucket, slot] = int(self.table[bucket, slot]), mark
            bucket = self._other(bucket, mark)
            if self._put(bucket, mark):
                return True
        for b, s, old in reversed(undo):
            self.table[b, s] = old
        return False

    def delete(self, key: bytes) -> bool:
        """Takes one copy of the key's fingerprint out; only keys that were inserted may be deleted."""
        mark, bucket = self._print(key)
        for b in (bucket, self._other(bucket, mark)):
            at = np.flatnonzero(self.table[b] == mark)
            if len(at):
                self.table[b, at[0]] = 0
                return True
        return False

    def has(self, keys: list[bytes]) -> np.ndarray:
        """Which keys may be in; a key that was inserted is never denied."""
        raw = np.frombuffer(b"".join(keys), dtype=np.uint8).reshape(-1, 16)
        mark = raw[:, 8].astype(np.uint64) | (raw[:, 9].astype(np.uint64) << np.uint64(8))
        mark = np.maximum(mark, 1)
        low = np.zeros(len(raw), dtype=np.uint64)
        for i in range(6):
            low |= raw[:, 10 + i].astype(np.uint64) << np.uint64(8 * i)
        mask = np.uint64(len(self.table) - 1)
        one = low & mask
        two = (one ^ (mark * np.uint64(0x5BD1E995))) & mask
        m = mark.astype(np.uint16)[:, None]
        return ((self.table[one] == m) | (self.table[two] == m)).any(1)


def shard_of(key, shards: int):
    """A key's shard, from its first bytes."""
    return F.pmod(F.conv(F.hex(F.substring(key, 1, 6)), 16, 10).cast("long"), F.lit(shards)).cast("int")


def line_refs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, doc_id, n): how often each document holds each key. Rows without id hold none."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, ids, counts = [], [], []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                own: dict[bytes, int] = {}
                for line in text.split("\n"):
                    if (k := line_key(line)) is not None:
                        own[k] = own.get(k, 0) + 1
                keys += own
                counts += own.values()
                ids += [doc] * len(own)
            yield pd.DataFrame({"key": keys, "doc_id": pd.Series(ids, dtype=batch["doc_id"].dtype), "n": pd.Series(counts, dtype="int64")})

    own = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text")).dropna()
    schema = T.StructType([T.StructField("key", T.BinaryType()), own.schema["doc_id"], T.StructField("n", T.LongType())])
    return own.mapInPandas(cut, schema).groupBy("key", "doc_id").agg(F.sum("n").alias("n"))


def repeated_keys(refs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(key, n_docs, last_doc) of the keys that at least ``min_docs`` documents hold."""
    held = refs.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))
    return held.where(F.col("n_docs") >= min_docs)


@dataclass
class LineIndex:
    """The state. ``refs``: key, doc_id, n. ``repeated``: key, n_docs, last_doc. ``filters``: shard, data, full.

    ``tables`` counts the stored tables that each of them is a union of; 0: not stored by shard.
    """

    refs: DataFrame
    repeated: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int
    tables: int = 0

    @classmethod
    def build(cls, spark: SparkSession, refs: DataFrame, min_docs: int = MIN_DOCS) -> LineIndex:
        """The index of a reference table, filters from scratch."""
        refs = staged(spark, refs, "line-refs")
        repeated = staged(spark, repeated_keys(refs, min_docs), "line-keys")
        shards = max(8, -(-repeated.count() // SHARD_KEYS))
        return cls(refs, repeated, staged(spark, new_filters(spark, repeated, shards), "line-filters"), shards, min_docs)

    def stored_by_shard(self, spark: SparkSession, shard_refs: int = SHARD_REFS) -> LineIndex:
        """The same index, each shard in a folder of its own; as many shards as keep one at about ``shard_refs`` rows."""
        refs, repeated = self.refs.select("key", "doc_id", "n"), self.repeated.select("key", "n_docs", "last_doc")
        shards = max(8, -(-repeated.count() // SHARD_KEYS), -(-refs.count() // shard_refs))
        return LineIndex(_by_shard(spark, refs, shards, "line-refs"), _by_shard(spark, repeated, shards, "line-keys"),
                         _stored(spark, new_filters(spark, repeated, shards), "line-filters"), shards, self.min_docs, 1)

    def _after(self, spark: SparkSession, touched: list[int], refs: DataFrame) -> LineIndex:
        """The index with other rows in the ``touched`` shards; the other shards stay unread."""
        if not touched:
            return self
        inside = F.col("shard").isin(touched)
        refs = _by_shard(spark, refs, self.shards, "line-refs")
        repeated = _by_shard(spark, repeated_keys(refs, self.min_docs), self.shards, "line-keys")
        was, now = self.repeated.where(inside).select("key"), repeated.select("key")
        changes = now.join(was, "key", "left_anti").select("key", F.lit(1).alias("change")).unionByName(
            was.join(now, "key", "left_anti").select("key", F.lit(-1).alias("change")))
        filters = staged(spark, changed_filters(self.filters.where(inside), changes, self.shards), "line-filters")
        full = [r["shard"] for r in filters.where("full").select("shard").collect()]  # shard numbers
        if full:  # these outgrew their filters: size them anew from their keys
            grown = new_filters(spark, repeated.where(F.col("shard").isin(full)), self.shards)
            filters = filters.where(~F.col("shard").isin(full)).unionByName(grown)
        filters = _stored(spark, filters, "line-filters")
        after = LineIndex(*[old.where(~inside).unionByName(new) for old, new in
                            ((self.refs, refs), (self.repeated, repeated), (self.filters, filters))],
                          self.shards, self.min_docs, self.tables + 1)
        return after if after.tables < MOST_TABLES else after.stored_by_shard(spark)

    def _touched(self, rows: DataFrame) -> list[int]:
        """The numbers of the shards that hold the keys of ``rows``."""
        return sorted(r["shard"] for r in rows.select(shard_of(F.col("key"), self.shards).alias("shard")).distinct().collect())

    def insert(self, spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """Adds documents; one that is there already has its counts added to. Reads and writes the shards of their keys."""
        if not self.tables:
            return self.stored_by_shard(spark).insert(spark, docs, id_col, text_col)
        new = staged(spark, line_refs(docs, id_col, text_col), "line-change")
        touched = self._touched(new)
        both = self.refs.where(F.col("shard").isin(touched)).select("key", "doc_id", "n").unionByName(new)
        return self._after(spark, touched, both.groupBy("key", "doc_id").agg(F.sum("n").alias("n")))

    def delete(self, spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """Takes out all lines of the documents in ``docs``; unknown ids change nothing.

        With a column ``text_col``, which must hold the texts that were
        inserted, only the shards of their keys are read. Without it, ids
        alone tell the shards, which takes a pass over all of ``refs``.
        """
        if not self.tables:
            return self.stored_by_shard(spark).delete(spark, docs, id_col, text_col)
        gone = staged(spark, docs.select(column(docs, id_col).alias("doc_id")).dropna().distinct(), "line-gone")
        if text_col in docs.columns:
            touched = self._touched(line_refs(docs, id_col, text_col))
        else:
            touched = sorted(r["shard"] for r in self.refs.select("doc_id", "shard").join(gone, "doc_id", "left_semi")
                             .select("shard").distinct().collect())
        left = self.refs.where(F.col("shard").isin(touched)).join(gone, "doc_id", "left_anti").select("key", "doc_id", "n")
        return self._after(spark, touched, left)

    def screened(self, spark: SparkSession, most: int = FILTER_BYTES) -> DataFrame:
        """The (key, doc_id) rows of ``refs`` whose key passes its shard's filter: all repeated ones and few others."""
        size = self.filters.agg(F.sum(F.length("data"))).head()[0] or 0
        shards, rows = self.shards, self.refs.select("key", "doc_id")
        if size > most:
            return met_by_shard(rows, self.filters, shards)
        filters = spark.sparkContext.broadcast({r["shard"]: bytes(r["data"]) for r in self.filters.collect()})

        def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ready = {s: CuckooFilter.read(d) for s, d in filters.value.items()}
            for batch in batches:
                keys = [bytes(k) for k in batch["key"]]
                shard = np.array([int.from_bytes(k[:6], "big") % shards for k in keys], dtype=np.int64)
                keep = np.zeros(len(keys), dtype=bool)
                for s in np.unique(shard):
                    if s in ready:
                        at = np.flatnonzero(shard == s)
                        keep[at] = ready[s].has([keys[i] for i in at])
                yield batch[keep]

        return rows.mapInPandas(probe, rows.schema)

    def dropped(self, spark: SparkSession) -> DataFrame:
        """(doc_id, keys): the keys that a document loses, because a larger doc_id keeps them."""
        lost = (self.screened(spark).join(self.repeated.select("key", "last_doc"), "key")
                .where(F.col("doc_id") < F.col("last_doc")))
        # at most one key per line of the document
        return staged(spark, lost.groupBy("doc_id").agg(F.collect_set("key").alias("keys")), "line-drops")


def met_by_shard(rows: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """The (key, doc_id) rows that pass their shard's filter; a task holds one filter at a time and streams its rows.

    A shard's rows are spread over PIECES pieces by document, each led by a
    copy of the filter, as one line may be in a third of all documents.
    """
    none = F.lit(None).cast(rows.schema["doc_id"].dataType)
    leads = filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))).alias("piece"), F.lit(0).alias("kind"),
                           F.col("data").alias("key"), none.alias("doc_id"))
    probes = rows.select(shard_of(F.col("key"), shards).alias("shard"), F.pmod(F.xxhash64("doc_id"), F.lit(PIECES)).cast("int").alias("piece"),
                         F.lit(1).alias("kind"), "key", "doc_id")

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, ready = None, None
        for batch in batches:
            keep = np.zeros(len(batch), dtype=bool)
            place, kind = batch[["shard", "piece"]].to_numpy(), batch["kind"].to_numpy()
            keys = batch["key"].tolist()
            starts = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]).any(1) | (kind[1:] != kind[:-1]))))
            for a, b in zip(starts, [*starts[1:], len(batch)]):
                if kind[a] == 0:
                    at, ready = tuple(place[a]), CuckooFilter.read(bytes(keys[a]))
                elif at == tuple(place[a]):  # a shard without a filter has no repeated key
                    keep[a:b] = ready.has([bytes(k) for k in keys[a:b]])
            yield batch.loc[keep, ["key", "doc_id"]]

    both = leads.unionByName(probes).repartition("shard", "piece").sortWithinPartitions("shard", "piece", "kind")
    return both.mapInPandas(probe, rows.schema)


def _by_shard(spark: SparkSession, df: DataFrame, shards: int, name: str) -> DataFrame:
    """``df`` stored with a folder for each shard of its keys, and read again with the column ``shard``; large shards take several tasks."""
    return _stored(spark, df.withColumn("shard", shard_of(F.col("key"), shards)).hint("rebalance", F.col("shard")), name)


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """As ``staged``, with a folder for each shard."""
    path = f"{shared_folder(spark)}/ledgerline-llm/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy("shard").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_filters(spark: SparkSession, keys: DataFrame, shards: int) -> DataFrame:
    """Filters of the keys, sized for them."""
    empty = spark.createDataFrame([], "shard int, data binary, full boolean")
    return changed_filters(empty, keys.select("key", F.lit(1).alias("change")), shards)


def changed_filters(filters: DataFrame, changes: DataFrame, shards: int) -> DataFrame:
    """The filters with keys put in (change 1) or taken out (-1), each shard by itself; a shard holds a bounded share."""

    def apply(key: tuple, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        put, take = ([bytes(k) for k in new["key"][new["change"] == c]] for c in (1, -1))
        f = CuckooFilter.read(bytes(old["data"].iloc[0])) if len(old) else CuckooFilter.sized(len(put))
        for k in take:
            f.delete(k)
        if not len(old):
            while not all(f.insert(k) for k in put):  # a new filter can grow freely
                f = CuckooFilter(np.zeros((2 * len(f.table), SLOTS), dtype=np.uint16))
            full = False
        else:
            full = not all(f.insert(k) for k in put)
        return pd.DataFrame({"shard": [key[0]], "data": [f.write()], "full": [full]})

    dealt = changes.withColumn("shard", shard_of(F.col("key"), shards))
    return filters.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInPandas(apply, "shard int, data binary, full boolean")


def without_lines(texts: pd.Series, keys: pd.Series) -> pd.DataFrame:
    """Texts without the lines of the given keys, the number of lines, and of those dropped."""
    rows = []
    for text, lose in zip(texts, keys):
        lines = (text or "").split("\n")
        if lose is None or not len(lose):
            rows.append((text or "", len(lines), 0))
            continue
        lose = {bytes(k) for k in lose}
        kept = [x for x in lines if line_key(x) not in lose]
        rows.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return pd.DataFrame(rows, columns=["kept", "n_lines", "n_dropped"])


def dedup_lines(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                index: LineIndex | None = None, min_docs: int = MIN_DOCS, name: str = "lines") -> DataFrame:
    """``docs`` with a column ``name``: struct(kept, n_lines, n_dropped).

    A key (line stripped of white space, A-Z lowered, MIN_CHARS code points or
    more) that ``min_docs`` documents hold loses its lines in all but the
    largest doc_id. A null or empty text is one empty line, kept as ''. Rows
    without doc_id neither count nor lose lines; rows that share a doc_id are
    one document, and each loses the line. All columns of ``docs`` stay.
    """
    bounded_batches(spark)
    index = index or LineIndex.build(spark, line_refs(docs, id_col, text_col), min_docs)
    key, keys = free_name(docs, "__drop_id"), free_name(docs, "__drop_keys")
    drops = index.dropped(spark).toDF(key, keys)
    drop_lines = F.pandas_udf(without_lines, "kept string, n_lines long, n_dropped long")
    both = docs.join(drops, column(docs, id_col) == drops[key], "left")
    return both.withColumn(name, drop_lines(column(docs, text_col), F.col(keys))).drop(key, keys)


def brute_force(rows: list[tuple], min_docs: int = MIN_DOCS) -> list[tuple]:
    """(doc_id, n_lines, n_dropped, kept text) with plain dictionaries, for tests."""
    held: dict[bytes, set] = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and line_key(line) is not None:
                held.setdefault(line_key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(held.get(line_key(x), ())) < min_docs or max(held[line_key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out
