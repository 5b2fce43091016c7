"""BPE encoding and decoding through a table of distinct words.

Texts are cut into runs (chunks) of about CHUNK_WORDS words. Each chunk
writes its distinct words, dealt by word into buckets, and its texts as
positions in that word list. Each bucket then encodes every distinct word of
the corpus that falls to it once, whatever number of chunks has it, and turns
ids back into pieces through the vocabulary's id-to-piece table. A join by
chunk puts ids and pieces back in the place of the words.

Positions and word lists travel packed: a row per chunk and bucket, not a row
per word. Buckets grow with the text as its vocabulary does, and the join has
as many partitions as there are chunks, so that a task's share stays bounded.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from ledgerline.llm.common import bounded_batches, column, give_back, staged

#: Words in a chunk; bounds what one task holds at a time. A longer text makes a longer chunk of its own.
CHUNK_WORDS = 2_400_000
#: zstandard level of what is stored and shuffled: texts as positions, word lists, their ids.
LEVEL = 9
#: White space as the vocabulary's patterns have it (Unicode White_Space).
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The vocabulary's own pattern (fixed value), and the same for lower-case text within Latin-1.
SPLIT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+")
LATIN_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")

_KINDS = [regex.compile(r"\p{L}"), regex.compile(r"\p{N}"), regex.compile(rf"[^{SPACE}\p{{L}}\p{{N}}]")]
#: Text of one bucket at least, and the power of the text by which distinct words grow (Heaps' law; taken high).
BUCKET_BYTES, GROWTH = 4 << 20, 0.7
#: The planner's size of a frame that it knows nothing of.
UNKNOWN = 1 << 60


def byte_letters() -> list[str]:
    """The printable letter of each byte: printable Latin-1 stands for itself, the rest is numbered from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)]


class WordBpe:
    """The vocabulary file: splits texts as the tokenizer does, and encodes one word.

    Texts are split by the vocabulary's pattern; where the library's Unicode
    tables give a character of the text another kind than ours, by the
    vocabulary's own pre-tokenizer.
    """

    def __init__(self, path: str):
        self.tok = Tokenizer.from_file(path)
        added = self.tok.get_added_tokens_decoder()
        self.added = {t.content: i for i, t in added.items()}
        self.cut = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if added else None
        self.letters = byte_letters()
        self.pieces = [self.tok.id_to_token(i) for i in range(self.tok.get_vocab_size())]  # the id-to-piece table
        self.same, self.other = set(map(chr, range(128))), set()

    def _pre_tokens(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]

    def _kinds_agree(self, text: str) -> bool:
        seen = set(text)
        for c in seen - self.same - self.other:
            ours = next((i for i, k in enumerate(_KINDS) if k.match(c)), 3)
            letter, number, mark = (self._pre_tokens(first + c) == [first + c] for first in ("a", "", "!"))
            theirs = 0 if letter else 2 if mark else 1 if number else 3
            (self.same if ours == theirs else self.other).add(c)
        return seen.isdisjoint(self.other)

    def _plain(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            text = self.tok.normalizer.normalize_str(text)
            return SPLIT.findall(text) if self._kinds_agree(text) else self._pre_tokens(text)
        return LATIN_SPLIT.findall(text.lower())  # Latin-1 is in normal form C, and lower() stays within it

    def words(self, text: str | None) -> list[str]:
        """The words of a text, added tokens as words of their own."""
        if not text:
            return []
        if not self.cut or "<|" not in text and not self.cut.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += self._plain(text[at:m.start()]) + [m[0]]
            at = m.end()
        return out + self._plain(text[at:])

    def encode(self, word: str) -> list[int]:
        if word in self.added:
            return [self.added[word]]
        return [t.id for t in self.tok.model.tokenize("".join([self.letters[b] for b in word.encode("utf-8")]))]


#: First bytes below ONE are numbers themselves, those below TWO begin two bytes, those below FIVE three, and FIVE five.
ONE, TWO, FIVE = 192, 240, 255


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed; small ones take one byte. All first bytes stand together, then the second ones and so on."""
    x = numbers.astype(np.int64)
    y = x - ONE
    z = y - ((TWO - ONE) << 8)
    two, three, five = (y >= 0) & (z < 0), (z >= 0) & (z < (FIVE - TWO) << 16), z >= (FIVE - TWO) << 16
    heads = np.select([two, three, five], [ONE + (y >> 8), TWO + (z >> 16), FIVE], x)
    parts = [heads, y[two] & 255, (z[three] >> 8) & 255, z[three] & 255]
    raw = np.array([len(x)], dtype="<u8").tobytes() + b"".join([p.astype(np.uint8).tobytes() for p in parts]) + x[five].astype("<u4").tobytes()
    return zstandard.compress(raw, LEVEL)


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), dtype=np.uint8)
    n = int(raw[:8].view("<u8")[0])
    heads = raw[8:8 + n]
    two, three, five = (np.flatnonzero(k) for k in ((heads >= ONE) & (heads < TWO), (heads >= TWO) & (heads < FIVE), heads == FIVE))
    second, high, low, whole = np.split(raw[8 + n:], np.cumsum([len(two), len(three), len(three)]))
    out = heads.astype(np.uint32)
    out[two] = ((out[two] - ONE) << 8) + second + ONE
    out[three] = ((out[three] - TWO) << 16) + (high.astype(np.uint32) << 8) + low + ONE + ((TWO - ONE) << 8)
    out[five] = np.frombuffer(whole.tobytes(), dtype="<u4")
    return out


def bucket_count(spark: SparkSession, docs: DataFrame) -> int:
    """As many buckets as shuffle partitions, more if the planner's size of ``docs`` says that its distinct words need them."""
    least = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(least, math.ceil((size / BUCKET_BYTES) ** GROWTH)) if size < UNKNOWN else least


def bucket_of(word: str, buckets: int) -> int:
    return zlib.crc32(word.encode("utf-8")) % buckets


def chunked(spark: SparkSession, docs: DataFrame, path: str, buckets: int, most: int = CHUNK_WORDS) -> DataFrame:
    """One row per chunk with its texts (bucket -1), and one per chunk and bucket with its distinct words."""
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("chunk", T.StringType()), T.StructField("bucket", T.IntegerType()),
                           T.StructField("ids", T.ArrayType(id_type)), T.StructField("data", T.BinaryType()),
                           T.StructField("ranks", T.BinaryType())])

    def rows(ids: list, lengths: list[int], places: array, seen: dict[str, int]) -> pd.DataFrame:
        chunk, listed = uuid.uuid4().hex, list(seen)
        places = np.frombuffer(places, dtype=np.uint32)
        counts = np.bincount(places, minlength=len(listed))
        rank = np.empty(len(listed), dtype=np.uint32)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(listed))  # frequent words get small numbers
        out = [(chunk, -1, ids, pack(np.concatenate([np.array([len(listed)], np.uint32), rank[places]])), pack(np.array(lengths)))]
        own: dict[int, list[int]] = {}
        for i, w in enumerate(listed):
            own.setdefault(bucket_of(w, buckets), []).append(i)
        for b, at in own.items():
            at.sort(key=rank.__getitem__)  # growing numbers: their steps are small
            out.append((chunk, b, [], zstandard.compress("\n".join([listed[i] for i in at]).encode("utf-8"), LEVEL), pack(np.diff(rank[at], prepend=np.uint32(0)))))
        return pd.DataFrame(out, columns=["chunk", "bucket", "ids", "data", "ranks"])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = WordBpe(path)
        ids, lengths, places, seen = [], [], array("I"), {}
        for batch in batches:
            for doc, text in zip(batch["doc_id"].tolist(), batch["text"]):
                words = bpe.words(text)
                places.extend([seen.setdefault(w, len(seen)) for w in words])
                ids.append(None if pd.isna(doc) else doc)
                lengths.append(len(words))
                if len(places) >= most or len(ids) >= most:
                    yield rows(ids, lengths, places, seen)
                    ids, lengths, places, seen = [], [], array("I"), {}
                    give_back()
        if ids:
            yield rows(ids, lengths, places, seen)

    return docs.select("doc_id", "text").mapInPandas(cut, schema)


def encoded(words: DataFrame, path: str, buckets: int) -> DataFrame:
    """The word rows with ids and pieces in place of the words; a bucket's distinct words are encoded once."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe, known, at = WordBpe(path), {}, None
        for batch in batches:
            out = []
            for chunk, bucket, data in zip(batch["chunk"], batch["bucket"], batch["data"]):
                if bucket != at:
                    known, at = {}, bucket
                listed = zstandard.decompress(bytes(data)).decode("utf-8").split("\n")
                for w in listed:
                    if w not in known:
                        known[w] = " ".join(map(str, bpe.encode(w)))
                out.append(zstandard.compress("\n".join([known[w] for w in listed]).encode(), LEVEL))
            yield batch.assign(data=out)
        known.clear()
        give_back()

    rows = words.select("chunk", "bucket", "data", "ranks")
    return rows.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInPandas(encode, rows.schema)


def encode_texts(spark: SparkSession, docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 most: int = CHUNK_WORDS) -> DataFrame:
    """doc_id, n_tokens, ids_text (decimal ids joined by one space), decoded (the pieces joined by one space).

    Equal to the tokenizers library without special tokens, truncation and
    padding, and its decode with special tokens kept. A null or empty text
    has no tokens and decodes to ''. Repeated rows each get their row; other
    columns of ``docs`` are ignored. ``path``: the vocabulary file, found at
    the same place on every executor.
    """
    own = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    id_field = own.schema["doc_id"]
    bounded_batches(spark)
    buckets = bucket_count(spark, own)
    chunks = staged(spark, chunked(spark, own, path, buckets, most), "bpe-chunks")
    words = encoded(chunks.where("bucket >= 0"), path, buckets)
    texts = chunks.where("bucket < 0")
    tasks = max(buckets, texts.count())  # a chunk or so in a task, however many there are
    schema = T.StructType([id_field, T.StructField("n_tokens", T.LongType()), T.StructField("ids_text", T.StringType()),
                           T.StructField("decoded", T.StringType())])

    def put_back(texts: pa.Table, lists: pa.Table) -> pa.Table:
        pieces = [x.encode("utf-8") for x in WordBpe(path).pieces]
        done = []
        for row in texts.to_pylist():  # one
            places, sizes = unpack(row["data"]), unpack(row["ranks"])
            n, places = int(places[0]), places[1:]
            as_ids, as_pieces, count = [b""] * n, [b""] * n, np.zeros(n, dtype=np.int64)
            for data, ranks in zip(lists["data"], lists["ranks"]):
                for r, w in zip(np.cumsum(unpack(ranks.as_py())).tolist(), zstandard.decompress(data.as_py()).split(b"\n")):
                    got = w.split(b" ")
                    as_ids[r], as_pieces[r], count[r] = w, b" ".join([pieces[int(i)] for i in got]), len(got)
            if not count.all():
                raise ValueError("a chunk's word list is incomplete")
            ends = np.cumsum(sizes.astype(np.int64))
            spans = list(zip((ends - sizes).tolist(), ends.tolist()))
            tokens = np.concatenate(([0], np.cumsum(count[places])))
            done.append(pa.table([pa.array(row["ids"], type=texts.schema.field("ids").type.value_type),
                                  pa.array(tokens[ends] - tokens[ends - sizes], type=pa.int64()),
                                  _joined(as_ids, places, spans), _joined(as_pieces, places, spans)], names=schema.names))
            del as_ids, as_pieces, places, spans
            give_back()
        return pa.concat_tables(done)

    return (texts.select("chunk", "ids", "data", "ranks").repartition(tasks, "chunk").groupBy("chunk")
            .cogroup(words.repartition(tasks, "chunk").groupBy("chunk")).applyInArrow(lambda t, w: put_back(t, w), schema))


def _joined(entries: list[bytes], places: np.ndarray, spans: list[tuple[int, int]]) -> pa.Array:
    """A text per span: its entries, one space between them. The characters lie in one buffer."""
    buffer, at = bytearray(), np.zeros(len(spans) + 1, dtype=np.int64)
    for k, (a, b) in enumerate(spans):
        buffer += b" ".join([entries[i] for i in places[a:b].tolist()])
        at[k + 1] = len(buffer)
    if len(buffer) < 2**31:
        return pa.StringArray.from_buffers(len(spans), pa.py_buffer(at.astype(np.int32)), pa.py_buffer(buffer))
    return pa.LargeStringArray.from_buffers(len(spans), pa.py_buffer(at), pa.py_buffer(buffer)).cast(pa.string())


def brute_force(texts: list, path: str) -> list[tuple[int, str, str]]:
    """(n_tokens, ids_text, decoded) by the library itself, for tests."""
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    out = []
    for t in texts:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        out.append((len(ids), " ".join(map(str, ids)), tok.decode(ids, skip_special_tokens=False)))
    return out
