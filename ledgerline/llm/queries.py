"""One query per operator of this subpackage: production parameters, whole tables, full results.

``ORACLE`` has DuckDB SQL where SQL can express the result; the other queries
are tested against brute-force versions in tests/llm.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (bpe, decontamination, html_text, language_id, license_scan, line_dedup, ngram_join, pseudonyms,
                            quality_rules, resampling, sharding, spelling, token_file)
from ledgerline.llm.common import table
from ledgerline.llm.feistel import round_keys

#: Vocabulary files; found at the same place on every machine.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
SHARDS = 8


def _sha(text):
    return F.sha2(text.cast("binary"), 256)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside windows of benchmark items."""
    found = decontamination.decontaminate(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        decontamination.items_digest(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that a later document keeps."""
    done = line_dedup.dedup_lines(spark, table(spark, sf_dir, "documents"))
    return done.select("doc_id", "lines.n_lines", "lines.n_dropped", _sha(F.col("lines.kept")).alias("kept_sha256"))


def op3_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and fertility bands of every document."""
    judged = quality_rules.judge(spark, table(spark, sf_dir, "documents"), PIECE_BPE)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                         "band_group", "chars_per_token", "byte_share", "entropy", "reasons")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and their decoding, as digests."""
    done = bpe.encode_texts(spark, table(spark, sf_dir, "documents"), WORD_BPE)
    return done.select("doc_id", "n_tokens", _sha(F.col("ids_text")).alias("ids_sha256"), _sha(F.col("decoded")).alias("decoded_sha256"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that are similar in word 4-grams."""
    return ngram_join.grouped(spark, table(spark, sf_dir, "documents"))


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with personal values replaced by pseudonyms of their format."""
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; every third one by checksum is held out of training."""
    return language_id.identify(spark, table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that each document names or quotes."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document in a reproducible shuffle."""
    return sharding.shard_rows(spark, table(spark, sf_dir, "documents"), SHARDS).drop("place")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its near words' count, its form and the root of its forms."""
    return spelling.variants(spark, table(spark, sf_dir, "documents"))


def op12_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's token ids, as read back from a Re-Pair token file."""
    folder = token_file.write_tokens(spark, table(spark, sf_dir, "documents"), BYTE_BPE)
    return token_file.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and score of every document towards the benchmark, and the rank of those drawn."""
    return resampling.resample(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontaminate, op2_line_dedup, op3_fertility, op4_bpe, op5_html_text, op6_ngram_join, op7_pseudonyms,
                            op8_language_id, op9_license_scan, op10_shards, op11_spelling, op12_token_file,
                            op13_resample)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _decontaminate_sql(docs: str = "documents") -> str:
    words = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER.format("coalesce(text, '')"))
    return f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {words} AS w FROM benchmark WHERE item_id IS NOT NULL),
place AS (SELECT item_id, w, least({decontamination.WINDOW}, len(w)) AS n,
                 unnest(range(1, len(w) - least({decontamination.WINDOW}, len(w)) + 2)) AS i FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS s FROM place),
doc AS (SELECT doc_id, {words} AS w FROM {docs}),
spot AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
hit AS (SELECT spot.doc_id, win.item_id, spot.n, spot.i FROM
        (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s FROM spot) spot JOIN win ON spot.n = win.n AND spot.s = win.s),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""


def _line_dedup_sql(docs: str = "documents") -> str:
    key = _LOWER.format(f"trim(line, {_BLANK})")
    return f"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM {docs}),
line AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM cut),
keyed AS (SELECT doc_id, line, i, CASE WHEN length({key}) >= {line_dedup.MIN_CHARS} THEN {key} END AS k FROM line),
often AS (SELECT k, max(doc_id) AS last FROM keyed WHERE k IS NOT NULL GROUP BY k HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS}),
marked AS (SELECT keyed.doc_id, line, i, coalesce(keyed.doc_id < last, false) AS gone FROM keyed LEFT JOIN often ON keyed.k = often.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


def _ngram_sql(docs: str = "documents") -> str:
    p, q, n = ngram_join.SIMILARITY.numerator, ngram_join.SIMILARITY.denominator, ngram_join.N
    words = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')".format(_LOWER.format("coalesce(text, '')"))
    return f"""
WITH RECURSIVE doc AS (SELECT doc_id, {words} AS w FROM {docs}),
place AS (SELECT doc_id, w, least({n}, len(w)) AS n, unnest(range(1, len(w) - least({n}, len(w)) + 2)) AS i FROM doc WHERE len(w) > 0),
gram AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + n - 1], ' ') AS g FROM place),
size AS (SELECT doc_id, count(*) AS c FROM gram GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM both_ JOIN size s ON x = s.doc_id JOIN size t ON y = t.doc_id WHERE o * ({p} + {q}) >= (s.c + t.c) * {p}),
reach AS (SELECT x, y FROM link UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x)
SELECT doc_id, coalesce(c, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN (SELECT x, min(y) AS m FROM reach GROUP BY x) r ON doc_id = r.x"""


def _shards_sql() -> str:
    """The same Feistel network in integer SQL; CRC-32 by its rule, a byte at a time."""
    p = 2_147_483_647
    crc_step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    rounds = [("l", "r", "a") if i % 2 == 0 else ("r", "l", "b") for i in range(len(round_keys(sharding.KEY)))]
    steps = []
    for name, source in (("first", "start"), ("again", "walk")):
        at = f"SELECT id, y // b AS l, y % b AS r, n, a, b FROM {source} {{}}"
        for (half, other, side), (m, c) in zip(rounds, round_keys(sharding.KEY)):
            f = f"((({other} * {other}) % {p} * {m} + {other} + {c}) % {p})"
            moved = f"({half} + {f} * {f} % {p}) % {side}"
            at = f"SELECT id, {moved if half == 'l' else 'l'} AS l, {moved if half == 'r' else 'r'} AS r, n, a, b FROM ({at})"
        steps.append(f"SELECT id, l * b + r AS y, n, a, b FROM ({at})")
    return f"""
WITH RECURSIVE crc_table AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, {_nested(crc_step, 8)} AS c FROM (SELECT i, i AS c FROM range(256) r(i)))),
hexed AS (SELECT doc_id, hex(encode(text)) AS h, text FROM documents),
bytes AS (SELECT doc_id, text, [CAST(instr('0123456789ABCDEF', h[2 * i - 1]) * 16 + instr('0123456789ABCDEF', h[2 * i]) - 17 AS BIGINT)
                                for i in range(1, length(h) // 2 + 1)] AS bs FROM hexed),
summed AS (SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) + 1 AS BIGINT) AS size, CASE WHEN text IS NOT NULL THEN
             xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bs), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) END AS text_crc32
           FROM bytes, crc_table),
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32 NULLS FIRST, size) - 1 AS id FROM summed),
sides AS (SELECT n, a, CAST(ceil(n / a) AS BIGINT) AS b FROM (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a FROM documents)),
start AS (SELECT id, id AS y, n, a, b FROM numbered, sides),
walk AS ({steps[0].format("")} UNION ALL {steps[1].format("WHERE y >= n")})
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law, CAST(y % {SHARDS} AS INTEGER) AS shard, y // {SHARDS} AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM numbered JOIN walk USING (id) WHERE y < n"""


def _nested(step: str, times: int) -> str:
    """``step`` of c, applied so many times."""
    return f"list_reduce(list_prepend(i, range({times})), lambda c, _: {step})"


#: One row with the CRC-32 table t by its rule.
_CRC_TABLE = f"""SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, {_nested("CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END", 8)} AS c FROM (SELECT i, i AS c FROM range(256) r(i)))"""


def _crc(text: str) -> str:
    """Unsigned CRC-32 of a short text's UTF-8, with the table's column t in scope."""
    h = f"hex(encode({text}))"
    byte = f"CAST(instr('0123456789ABCDEF', {h}[2 * i - 1]) * 16 + instr('0123456789ABCDEF', {h}[2 * i]) - 17 AS BIGINT)"
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [{byte} for i in range(1, length({h}) // 2 + 1)]), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")


def _spelling_sql() -> str:
    runs = r"regexp_extract_all({}, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')".format(_LOWER.format("coalesce(text, '')"))
    return f"""
WITH RECURSIVE crc_table AS ({_CRC_TABLE}),
said AS (SELECT doc_id, w, count(*) AS k FROM (SELECT doc_id, unnest({runs}) AS w FROM documents) GROUP BY ALL HAVING length(w) >= {spelling.MIN_LENGTH}),
hashed AS (SELECT w, k, CAST({_crc("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w")} AS BIGINT) AS h FROM said, crc_table),
cut AS (SELECT CASE WHEN h % {spelling.DELETE_EVERY} = 0 THEN left(w, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS w, k FROM hashed),
word AS (SELECT w, CAST(sum(k) AS BIGINT) AS n FROM cut WHERE length(w) >= {spelling.MIN_LENGTH} GROUP BY w HAVING sum(k) >= {spelling.MIN_COUNT}),
spot AS (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM word),
gap AS (SELECT w, n, i, left(w, i - 1) AS a, substr(w, i + 1) AS b FROM spot),
pair AS (SELECT x.w AS x, y.w AS y, y.n AS n FROM gap x JOIN gap y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.w <> y.w
         UNION SELECT g.w, o.w, o.n FROM gap g JOIN word o ON o.w = g.a || g.b
         UNION SELECT o.w, g.w, g.n FROM gap g JOIN word o ON o.w = g.a || g.b),
best AS (SELECT x, count(*) AS n_near, max(n) AS most FROM pair GROUP BY x),
named AS (SELECT x, min(y) AS form, any_value(n) AS form_n, any_value(n_near) AS n_near FROM pair JOIN best USING (x) WHERE n = most GROUP BY x),
formed AS (SELECT w, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= {spelling.RATIO} * n THEN form END AS form,
                  CASE WHEN form_n >= {spelling.RATIO} * n THEN form_n END AS form_n FROM word LEFT JOIN named ON w = x),
follow AS (SELECT w, w AS at FROM formed UNION ALL SELECT follow.w, formed.form FROM follow JOIN formed ON formed.w = follow.at WHERE formed.form IS NOT NULL),
ends AS (SELECT follow.w, follow.at AS root FROM follow JOIN formed ON formed.w = follow.at WHERE formed.form IS NULL)
SELECT w AS word, form, root, n, n_near, form_n FROM formed JOIN ends USING (w)"""


def _resample_sql() -> str:
    b, p = resampling.BUCKETS, resampling.PERCENT
    ws = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER.format("coalesce(text, '')"))
    digest = f"sha256('{resampling.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), ''))"
    h = " * 16 + ".join(["(" * 7 + f"CAST(instr('0123456789abcdef', {digest}[1]) - 1 AS BIGINT)"] +
                        [f"(instr('0123456789abcdef', {digest}[{i}]) - 1))" for i in range(2, 9)])
    gain = f"floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(s_all + {b} AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(t_all + {b} AS DOUBLE))))"
    return f"""
WITH crc_table AS ({_CRC_TABLE}),
doc AS (SELECT row_number() OVER () AS r, doc_id, {ws} AS ws FROM documents),
said AS (SELECT r, w, count(*) AS k FROM (SELECT r, unnest(ws) AS w FROM doc) GROUP BY r, w),
aim AS (SELECT w, count(*) AS k FROM (SELECT unnest({ws}) AS w FROM benchmark) GROUP BY w),
hashed AS (SELECT w, {_crc("w")} % {b} AS b FROM (SELECT w FROM said UNION SELECT w FROM aim), crc_table),
s AS (SELECT b, sum(k) AS s FROM said JOIN hashed USING (w) GROUP BY b), t AS (SELECT b, sum(k) AS t FROM aim JOIN hashed USING (w) GROUP BY b),
totals AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS s_all, (SELECT coalesce(sum(t), 0) FROM t) AS t_all),
gain AS (SELECT b, CAST({gain} AS BIGINT) AS g FROM (SELECT b, coalesce(s, 0) AS s, coalesce(t, 0) AS t FROM s FULL JOIN t USING (b)), totals),
weighed AS (SELECT r, sum(k * g) AS total FROM said JOIN hashed USING (w) JOIN gain USING (b) GROUP BY r),
scored AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, CAST(CASE WHEN len(ws) = 0 THEN 0 ELSE (total - ((total % len(ws)) + len(ws)) % len(ws)) // len(ws) END AS BIGINT) AS weight,
           CAST(floor(-1000 * ln(-ln((({h}) + 0.5) / 4294967296))) AS BIGINT) AS noise FROM doc LEFT JOIN weighed USING (r)),
placed AS (SELECT doc_id, n_features, weight, weight + noise AS score, n_features >= {resampling.MIN_WORDS} AS able,
           row_number() OVER (PARTITION BY n_features >= {resampling.MIN_WORDS} ORDER BY weight + noise DESC, doc_id NULLS FIRST) AS place,
           count(*) OVER (PARTITION BY n_features >= {resampling.MIN_WORDS}) AS all_ FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= {p} * all_ // 100 THEN place END AS rank FROM placed"""


ORACLE: dict[str, str] = {"op1_decontaminate": _decontaminate_sql(), "op2_line_dedup": _line_dedup_sql(), "op6_ngram_join": _ngram_sql(),
                          "op10_shards": _shards_sql(), "op11_spelling": _spelling_sql(), "op13_resample": _resample_sql()}
