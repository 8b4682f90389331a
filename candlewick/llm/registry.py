"""Queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import (
    alignment,
    decontamination,
    html_extraction,
    importance,
    jaccard_join,
    language_id,
    line_dedup,
    packing,
    pii,
    quality,
    token_counts,
    token_files,
    toxicity,
)
from candlewick.llm.common import table, tokenizer_path


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 2048 ids, each document ended by id 1."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents, judged under the base and the current policy."""
    rows = quality.ledger(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       quality.fails(quality.BASE).alias("base_failed"),
                       (~quality.fails(quality.CURRENT)).alias("kept"), "n_lines", "n_capitals", "fail_bits")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files in doc_id order, then read back."""
    folder, manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), tokenizer_path())
    docs = token_files.read_token_files(spark, folder, manifest)
    return docs.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents by profiles learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    profiles = language_id.learn(docs.where(~language_id.held_out()))
    return (language_id.identify(docs, profiles)
            .select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that an earlier document holds."""
    rows = line_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents by a model fitted on labelled documents that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = toxicity.fold("doc_id", 3) == 1
    model = toxicity.fit(docs, labels.where(~held_out))
    return (toxicity.toxicity(docs, model)
            .select("doc_id", held_out.alias("held_out"), "score",
                    F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"), "spans"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents linked by 5-word shingles at 0.8."""
    return jaccard_join.linked(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents through a new digest cache."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages, with weights from pages whose document is known."""
    pages = table(spark, sf_dir, "pages")
    return html_extraction.extract(pages, html_extraction.learn(pages, table(spark, sf_dir, "documents")))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of all documents of 20 words or more, drawn towards the benchmark's word features."""
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents under two tokenizers, aligned and linked."""
    rows = alignment.align(table(spark, sf_dir, "documents"), tokenizer_path(),
                           tokenizer_path("piece_bpe_32k.model"), digest=True)
    return rows.withColumnRenamed("groups", "groups_sha256")


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: the certain spans and those the classifier adds."""
    rows = pii.spans(table(spark, sf_dir, "documents"))
    sure = F.filter("spans", lambda s: s["certain"])
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.size(F.expr(f"filter(spans, s -> s.certain and s.kind = '{k}')")).cast("long").alias(f"n_{k}")
              for k in pii.KINDS]
    return rows.select("doc_id", *counts, F.sha2(listed(sure), 256).alias("base_sha256"),
                       listed(F.col("spans")).alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_quality": op2_quality,
    "op3_token_files": op3_token_files,
    "op4_language_id": op4_language_id,
    "op5_decontamination": op5_decontamination,
    "op6_line_dedup": op6_line_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_token_counts": op9_token_counts,
    "op10_html_extraction": op10_html_extraction,
    "op11_importance": op11_importance,
    "op12_alignment": op12_alignment,
    "op13_pii": op13_pii,
}

ORACLES: dict[str, str] = {
    "op2_quality": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text,
        list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, unnest(range(1, len(ws) - 1)) AS i, ws FROM w),
t AS (SELECT r, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM g),
m AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM t),
p AS (SELECT r, count(DISTINCT i + k) AS n FROM m, (VALUES (0), (1), (2)) v(k) WHERE m.n > 1 GROUP BY r),
f AS (SELECT w.doc_id, len(ws) AS n_words,
        CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        coalesce(p.n, 0) AS n_repeat_words,
        CAST(length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals
      FROM w LEFT JOIN p USING (r)),
b AS (SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
        + 4 * (100 * n_symbols > 10 * n_words)::INT + 8 * (100 * n_dup_lines > 50 * n_lines)::INT
        + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 14 * n_words)::INT
        + 64 * (100 * n_capitals > 30 * word_chars)::INT AS BIGINT) AS fail_bits FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals,
       (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM b""",
    "op5_decontamination": r"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
       FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
       FROM benchmark),
iwin AS (SELECT item_id, least(len(ws), 13) AS l, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS i, ws
         FROM iw WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, l, array_to_string(ws[i:i + l - 1], ' ') AS g FROM iwin),
dpos AS (SELECT r, l, unnest(range(1, len(ws) - l + 2)) AS i, ws FROM dw, (SELECT DISTINCT l FROM win)
         WHERE len(ws) >= l),
hit AS (SELECT r, i, l, item_id FROM (SELECT r, l, i, array_to_string(ws[i:i + l - 1], ' ') AS g FROM dpos)
        JOIN win USING (l, g)),
cover AS (SELECT r, unnest(range(i, i + l)) AS p FROM (SELECT DISTINCT r, i, l FROM hit)),
pos AS (SELECT r, count(DISTINCT p) AS n FROM cover GROUP BY r),
its AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(pos.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
       sha256(coalesce(its.s, '')) AS items_sha256,
       coalesce(pos.n, 0) > 0 AND 20 * coalesce(pos.n, 0) >= len(ws) AS contaminated
FROM dw LEFT JOIN pos USING (r) LEFT JOIN its USING (r)""",
    "op6_line_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls,
        (doc_id IS NULL, coalesce(doc_id, CAST('0x' || substr(sha256(coalesce(text, '')), 1, 15) AS BIGINT))) AS place
      FROM documents),
l AS (SELECT r, doc_id, place, unnest(range(1, len(ls) + 1)) AS i, ls FROM d),
k AS (SELECT r, doc_id, place, i, ls[i] AS line, translate(regexp_replace(ls[i],
        '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(place) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT place) > 1),
m AS (SELECT k.*, f.first IS NOT NULL AND f.first <> place AS gone FROM k LEFT JOIN f USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r""",
    # the CRC goes bit by bit, the lowest bit of each byte first
    "op11_importance": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
       FROM documents),
i AS (SELECT regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
       FROM benchmark),
df AS (SELECT r, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda k: ws[k] || ' ' || ws[k + 1]))) AS f
       FROM d),
tf AS (SELECT unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda k: ws[k] || ' ' || ws[k + 1]))) AS f
       FROM i),
dn AS (SELECT r, f, count(*) AS n FROM df GROUP BY ALL),
tn AS (SELECT f, count(*) AS n FROM tf GROUP BY ALL),
bits AS (SELECT f, CAST(CAST(encode(f) AS BIT) AS VARCHAR) AS b FROM (SELECT f FROM dn UNION SELECT f FROM tn)),
crc AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT,
          list_transform(range(0, length(b)), lambda k: CAST(b[k - k % 8 + 8 - k % 8] AS BIGINT))),
          lambda c, x: xor(c >> 1, 3988292384 * xor(c & 1, x))), 4294967295) % 10000 AS b FROM bits),
s AS (SELECT b, sum(n) AS n FROM dn JOIN crc USING (f) GROUP BY b),
t AS (SELECT b, sum(n) AS n FROM tn JOIN crc USING (f) GROUP BY b),
g AS (SELECT v.b, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE
          * (SELECT coalesce(sum(n), 0) + 10000 FROM s)::DOUBLE
          / ((coalesce(s.n, 0) + 1)::DOUBLE * (SELECT coalesce(sum(n), 0) + 10000 FROM t)::DOUBLE))) AS BIGINT) AS gain
      FROM (SELECT unnest(range(10000)) AS b) v LEFT JOIN s USING (b) LEFT JOIN t USING (b)),
w AS (SELECT r, sum(n) AS n, sum(n * gain) AS total FROM dn JOIN crc USING (f) JOIN g USING (b) GROUP BY r),
x AS (SELECT r, doc_id, len(ws) >= 20 AS eligible, CAST(coalesce(n, 0) AS BIGINT) AS n_features,
        CAST(coalesce((total - ((total % n) + n) % n) // n, 0) AS BIGINT) AS weight,
        CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
      FROM d LEFT JOIN w USING (r)),
y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM x),
z AS (SELECT *, row_number() OVER (ORDER BY eligible DESC, score DESC, doc_id NULLS LAST, weight, n_features) AS place,
        count(*) FILTER (eligible) OVER () * 25 // 100 AS drawn FROM y)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM z""",
}
