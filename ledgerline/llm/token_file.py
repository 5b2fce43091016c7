"""Token ids in binary shards, compressed by Re-Pair grammars.

Documents go in the order of their ids into shards of about SHARD_IDS token
ids. In each shard, frequent pairs of neighbouring ids are replaced by
nonterminals, round by round, until no pair is frequent; what is stored is
the remaining sequence, the rules, and how many ids each rule expands to. By
those lengths a reader finds any range of ids without expanding what lies
before it.

A token file is a Parquet folder with a row per shard. ``range`` and
``number`` order the shards, ``before`` counts the ids of the range's earlier
shards, ``doc_ids`` and ``lengths`` list its documents and their ids (the end
id included), and ``grammar`` holds the ids (see ``pack``).
"""

from __future__ import annotations

import codecs
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from ledgerline.llm.common import bounded_batches, column, give_back, shared_folder

#: Ids of a shard; a longer document makes a shard of its own.
SHARD_IDS = 1 << 18
#: Uses that a pair needs to become a rule.
LEAST = 4
#: A round that replaces fewer pairs than this part of the sequence is the last one.
LAST_GAIN = 1 / 200
#: zstandard level of the planes of a grammar.
LEVEL = 3
#: Words whose ids a Python worker remembers (a dict of under 2^20 * 2 / 3 has half the table of a larger one).
KNOWN_WORDS = 600_000


# ---------------------------------------------------------------- ids of a text

#: White space as Unicode has it (White_Space).
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The vocabulary's own pattern (fixed value), and the same for ASCII texts
SPLIT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: (letters and digits first: no other part begins as they do).
ASCII_SPLIT = re.compile(r" ?[A-Za-z]+| ?[0-9]+|'(?:[stmd]|re|ve|ll)| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
#: The same for texts within Latin-1.
LATIN_SPLIT = re.compile(r" ?[A-Za-zªµºÀ-ÖØ-öø-ÿ]+| ?[0-9²³¹¼½¾]+|'(?:[stmd]|re|ve|ll)| ?[^\t-\r \x85\xa0A-Za-zªµºÀ-ÖØ-öø-ÿ0-9²³¹¼½¾]+"
                         r"|[\t-\r \x85\xa0]+(?![^\t-\r \x85\xa0])|[\t-\r \x85\xa0]+")
_KINDS = [regex.compile(r"\p{L}"), regex.compile(r"\p{N}"), regex.compile(rf"[^{SPACE}\p{{L}}\p{{N}}]")]


def _is_latin(text: str) -> bool:
    """Whether all characters are within Latin-1."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class ByteBpe(dict):
    """A byte-level BPE vocabulary file; as a dict, each word with its ids as bytes.

    Texts are split by the vocabulary's pattern. Where the library's tables
    give a character of the text another kind than ours, and where a special
    token is spelled out, the library encodes the whole text.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.size = self.tok.get_vocab_size()
        self.type = np.dtype("H" if self.size <= 1 << 16 else "I")
        added = self.tok.get_added_tokens_decoder().values()
        self.special = re.compile("|".join(re.escape(t.content) for t in added)) if added else None
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        self.letters = "".join([chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)])
        self.tokenize = self.tok.model.tokenize
        self.bytes_of = [np.array([i], dtype=self.type).tobytes() for i in range(self.size)]
        self.same, self.other = set(map(chr, range(128))), set()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        written = codecs.charmap_decode(word.encode(), "strict", self.letters)[0]
        self[word] = out = b"".join([self.bytes_of[t.id] for t in self.tokenize(written)])
        return out

    def _kinds_agree(self, text: str) -> bool:
        seen = set(text)
        for c in seen - self.same - self.other:
            ours = next((i for i, k in enumerate(_KINDS) if k.match(c)), 3)
            pieces = self.tok.pre_tokenizer.pre_tokenize_str
            theirs = next((i for i, first in enumerate("a1!") if len(pieces(first + c)) == 1), 3)
            (self.same if ours == theirs else self.other).add(c)
        return seen.isdisjoint(self.other)

    def ids(self, text: str | None) -> bytes:
        """The ids of a whole text, ``type`` wide."""
        if not text:
            return b""
        if self.special and self.special.search(text):
            words = None
        elif text.isascii():
            words = ASCII_SPLIT.findall(text)
        elif not self._kinds_agree(text):
            words = None
        else:
            words = (LATIN_SPLIT if _is_latin(text) else SPLIT).findall(text)
        if words is None:
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype=self.type).tobytes()
        return b"".join(map(self.__getitem__, words))


_LOADED: dict[str, ByteBpe] = {}


def vocabulary(path: str) -> ByteBpe:
    """The vocabulary file, kept with the words it knows for a Python worker's next tasks."""
    if path not in _LOADED:
        _LOADED.clear()
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


# ---------------------------------------------------------------- grammar

def repair(ids: np.ndarray, base: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(sequence, rules, rules per round): ids below ``base`` as a grammar.

    Symbol ``base`` + k stands for the two symbols of ``rules[k]``, which come
    before it. The first round counts all pairs; a later one those that are
    not known to be rare: pairs with a symbol of the round before, frequent
    ones and ones not counted yet. A pair that was counted and is rare stays
    so, as no new one of its two symbols comes up. Where frequent pairs
    overlap, the more frequent one is replaced.
    """
    seq, rules, rounds, done = ids.astype(np.int64), [], [], base
    multiplier = 0x9E3779B97F4A7C15
    live = np.arange(len(seq) - 1)  # where the pairs to count stand
    while len(live):
        bits = max(8, len(live).bit_length())
        pair = (seq[live] << 32) | seq[live + 1]
        slot = ((pair.view(np.uint64) * np.uint64(multiplier)) >> np.uint64(64 - bits)).view(np.int64)
        held = np.empty(1 << bits, dtype=np.int64)
        held[slot] = pair  # pairs that share a slot wait for a round with another multiplier
        own = held[slot] == pair
        again = np.zeros(len(seq), dtype=bool)
        again[live] = ~own
        own = np.flatnonzero(own)
        at, slot = live[own], slot[own]
        count = np.bincount(slot, minlength=1 << bits)[slot]
        often = np.flatnonzero(count >= least)
        at, slot, count = at[often], slot[often], count[often]  # where a frequent pair stands
        again[at] = True
        rank = (count << bits) | slot
        apart = at[1:] > at[:-1] + 1
        first = np.ones(len(at), dtype=bool)
        first[1:] = apart | (rank[1:] > rank[:-1])
        first[:-1] &= apart | (rank[:-1] >= rank[1:])
        first = np.flatnonzero(first)
        at, slot = at[first], slot[first]
        uses = np.bincount(slot, minlength=1 << bits)
        enough = np.flatnonzero(uses[slot] >= least)
        at, slot = at[enough], slot[enough]
        if not len(at):
            break
        chosen = np.flatnonzero(uses >= least)
        symbol = np.empty(1 << bits, dtype=np.int64)
        symbol[chosen] = done + np.arange(len(chosen))
        rules.append(np.stack([held[chosen] >> 32, held[chosen] & 0xFFFFFFFF], axis=1))
        rounds.append(len(chosen))
        done += len(chosen)
        gain = len(at) / len(seq)
        seq[at] = symbol[slot]
        again[at] = again[at - 1] = True  # the last place, to which -1 leads, begins no pair
        left = np.ones(len(seq), dtype=bool)
        left[at + 1] = False
        left = np.flatnonzero(left)
        seq, live = seq[left], np.flatnonzero(again[left][:-1])
        if gain < LAST_GAIN:
            break
        multiplier = (multiplier * 0x5851F42D4C957F2D + 2) % (1 << 64) | 1
    return seq, np.concatenate(rules) if rules else np.zeros((0, 2), dtype=np.int64), rounds


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The pieces of ``flat`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]


def _plane(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 as a compressed plane of their low 16 bits and one of the rest."""
    x = numbers.astype("<u4")
    low, high = (x & 0xFFFF).astype("<u2").tobytes(), (x >> 16).astype("<u2")
    high = high.astype("u1").tobytes() if not len(x) or high.max() < 256 else high.tobytes()
    parts = [zstandard.compress(p, LEVEL) for p in (low, high)]
    return struct.pack("<III", len(x), *map(len, parts)) + b"".join(parts)


def _from_plane(data: bytes, at: int) -> tuple[np.ndarray, int]:
    n, a, b = struct.unpack_from("<III", data, at)
    at += 12
    low = np.frombuffer(zstandard.decompress(data[at:at + a]), dtype="<u2")
    high = zstandard.decompress(data[at + a:at + a + b])
    high = np.frombuffer(high, dtype="u1" if len(high) == n else "<u2")
    return low.astype(np.int64) | (high.astype(np.int64) << 16), at + a + b


#: First bytes of a grammar.
MAGIC = b"LRP1"


def pack(ids: np.ndarray, base: int, least: int = LEAST) -> bytes:
    """Ids as a grammar in bytes.

    MAGIC, then as little-endian u32: ``base`` (ids below it stand for
    themselves), the number of rounds and the rules of each; then four planes:
    first and second symbol of each rule, its expansion length, the sequence.
    """
    seq, rules, rounds = repair(ids, base, least)
    size = np.ones(base + len(rules), dtype=np.int64)
    done = base
    for n in rounds:
        size[done:done + n] = size[rules[done - base:done - base + n]].sum(axis=1)
        done += n
    head = struct.pack(f"<II{len(rounds)}I", base, len(rounds), *rounds)
    return MAGIC + head + b"".join(map(_plane, (rules[:, 0], rules[:, 1], size[base:], seq)))


class Grammar:
    """A packed shard."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a grammar")
        self.base, n = struct.unpack_from("<II", data, 4)
        self.rounds = struct.unpack_from(f"<{n}I", data, 12)
        first, at = _from_plane(data, 12 + 4 * n)
        second, at = _from_plane(data, at)
        size, at = _from_plane(data, at)
        self.rules = np.stack([first, second], axis=1)
        self.size = np.concatenate([np.ones(self.base, dtype=np.int64), size])  # ids that a symbol expands to
        self.seq, _ = _from_plane(data, at)

    def all(self) -> np.ndarray:
        """All ids: the rules are expanded once, round by round, then put together."""
        start = np.concatenate([np.arange(self.base), self.base + np.cumsum(self.size[self.base:]) - self.size[self.base:]])
        flat = np.empty(self.base + int(self.size[self.base:].sum()), dtype=np.int64)
        flat[:self.base] = np.arange(self.base)
        done, at = 0, self.base
        for n in self.rounds:
            parts = self.rules[done:done + n].ravel()
            out = _gather(flat, start[parts], self.size[parts])
            flat[at:at + len(out)] = out
            done, at = done + n, at + len(out)
        return _gather(flat, start[self.seq], self.size[self.seq])

    def between(self, lo: int, hi: int) -> np.ndarray:
        """The ids from ``lo`` to before ``hi``: only the symbols that cover them are expanded."""
        ends = np.cumsum(self.size[self.seq])
        if not 0 <= lo <= hi <= (ends[-1] if len(ends) else 0):
            raise IndexError(f"no ids {lo} to {hi}")
        a, b = np.searchsorted(ends, lo, "right"), np.searchsorted(ends, hi, "left") + 1
        part, skip = self.seq[a:b], lo - (ends[a - 1] if a else 0)
        while (rule := part >= self.base).any():
            out = np.repeat(part, rule + 1)
            at = np.cumsum(rule + 1)[rule] - 2
            out[at], out[at + 1] = self.rules[part[rule] - self.base].T
            part = out
        return part[skip:skip + hi - lo]


# ---------------------------------------------------------------- files

def _file_schema(id_type: T.DataType) -> T.StructType:
    kinds = {"range": T.IntegerType(), "number": T.LongType(), "before": T.LongType(), "n_ids": T.LongType(),
             "doc_ids": T.ArrayType(id_type), "lengths": T.ArrayType(T.LongType()), "grammar": T.BinaryType()}
    return T.StructType([T.StructField(k, t) for k, t in kinds.items()])


def write_tokens(spark: SparkSession, docs: DataFrame, path: str, folder: str | None = None, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text", most: int = SHARD_IDS) -> str:
    """Encode all whole texts, append ``end_id`` to each, and write a token file; its folder.

    The documents are sorted by id (nulls first; by the text's checksum where
    an id repeats; equal rows are interchangeable). Null and empty texts have
    the end id only. An empty table gives a file without shards; other columns
    of ``docs`` are ignored. ``path``: the vocabulary file, found at the same
    place on every executor. ``folder``: a new one in the shared folder unless
    given.
    """
    folder = folder or f"{shared_folder(spark)}/ledgerline-llm/tokens-{uuid.uuid4().hex}"
    own = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    schema = _file_schema(own.schema["doc_id"].dataType)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        end = np.array([end_id], dtype=bpe.type).tobytes()
        ids, lengths, parts, held, number, before, range_ = [], [], [], 0, 0, 0, None

        def row() -> pa.RecordBatch:
            grammar = pack(np.frombuffer(b"".join(parts), dtype=bpe.type), bpe.size)
            return pa.RecordBatch.from_arrays(
                [pa.array([range_], pa.int32()), pa.array([number], pa.int64()), pa.array([before], pa.int64()), pa.array([held], pa.int64()),
                 pa.array([ids], pa.list_(id_kind)), pa.array([lengths], pa.list_(pa.int64())), pa.array([grammar], pa.binary())],
                names=schema.names)

        for batch in batches:
            id_kind = batch.schema.field("doc_id").type
            for doc, text, range_ in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "range"))):
                found = bpe.ids(text) + end
                n = len(found) // bpe.type.itemsize
                if held and held + n > most:
                    yield row()
                    number, before = number + 1, before + held
                    ids, lengths, parts, held = [], [], [], 0
                ids.append(doc)
                lengths.append(n)
                parts.append(found)
                held += n
        if held:
            yield row()
        give_back()

    bounded_batches(spark)
    order = ["doc_id", "__crc", "__tie"]
    dealt = (own.withColumn("__crc", F.crc32("text")).withColumn("__tie", F.xxhash64(F.monotonically_increasing_id()))
             .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
             .select("doc_id", "text", F.spark_partition_id().alias("range")))
    dealt.mapInArrow(shards, schema).write.parquet(folder)
    return folder


def open_tokens(spark: SparkSession, folder: str, id_type: T.DataType = T.LongType()) -> DataFrame:
    """The shards of a token file, with ``start``: all ids before the shard."""
    shards = spark.read.schema(_file_schema(id_type)).parquet(folder)
    totals = shards.groupBy("range").agg(F.sum("n_ids").alias("__n"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per written range
    starts = totals.select("range", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    return shards.join(F.broadcast(starts), "range").withColumn("start", F.col("__start") + F.col("before")).drop("__start")


def read_tokens(spark: SparkSession, folder: str, id_type: T.DataType = T.LongType()) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian u32): every document of a token file."""
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.BinaryType())])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                start, docs, lengths, data = (batch.column(c)[i] for c in ("start", "doc_ids", "lengths", "grammar"))
                raw = Grammar(data.as_py()).all().astype("<u4").tobytes()
                n = lengths.values.to_numpy()
                ends = np.cumsum(n)
                cuts = pa.array(np.concatenate([[0], 4 * ends]), pa.int32()).buffers()[1]
                yield pa.RecordBatch.from_arrays(
                    [docs.values, pa.array(start.as_py() + ends - n), pa.array(n),
                     pa.Array.from_buffers(pa.binary(), len(n), [None, cuts, pa.py_buffer(raw)])], names=schema.names)

    bounded_batches(spark)
    return open_tokens(spark, folder, id_type).select("start", "doc_ids", "lengths", "grammar").mapInArrow(documents, schema)


def find_tokens(spark: SparkSession, folder: str, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids of the wanted documents only: their shards are found by the documents' list,
    and of each shard only the symbols that cover them are expanded. A document written twice comes twice."""
    id_type = wanted.schema[id_col].dataType
    shards = spark.read.schema(_file_schema(id_type)).parquet(folder)
    listed = shards.select("range", "number", F.posexplode("doc_ids").alias("k", "doc_id"), "lengths").select(
        "range", "number", "doc_id", F.element_at("lengths", F.col("k") + 1).alias("n"),
        F.aggregate(F.slice("lengths", 1, F.col("k")), F.lit(0).cast("long"), lambda a, x: a + x).alias("lo"))
    spans = (listed.join(wanted.select(column(wanted, id_col).alias("doc_id")).distinct(), "doc_id")
             .groupBy("range", "number").agg(F.collect_list(F.struct("doc_id", "lo", "n")).alias("spans")))  # at most a shard's documents
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                grammar, spans = Grammar(batch.column("grammar")[i].as_py()), batch.column("spans")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s["doc_id"] for s in spans], batch.schema.field("spans").type.value_type.field("doc_id").type),
                     pa.array([s["n"] for s in spans], pa.int64()),
                     pa.array([grammar.between(s["lo"], s["lo"] + s["n"]).astype("<u4").tobytes() for s in spans], pa.binary())], names=schema.names)

    bounded_batches(spark)
    return shards.select("range", "number", "grammar").join(spans, ["range", "number"]).select("grammar", "spans").mapInArrow(documents, schema)


def brute_force(rows: list[tuple], path: str, end_id: int = 0) -> list[tuple]:
    """(doc_id, start, ids) by the library itself, in ascending order of ids, for tests."""
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    out, at = [], 0
    for doc, text in sorted(rows):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((doc, at, ids))
        at += len(ids)
    return out
