"""Queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_tree,
    conversation_repair,
    html_extraction,
    line_dedup,
    nearest,
    ngram_join,
    packing,
    quality_classifier,
    quality_rules,
    sentencepiece_viterbi,
    sharding,
    substring_dedup,
    vector_codes,
)
from .common import kept, table

Builder = Callable[[SparkSession, str], DataFrame]


def op1_differenced_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, differenced against the nearest URL of its host."""
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op2_near_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier line repeats up to one word edit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = line_dedup.dedup(docs)
    text = F.coalesce("text", F.lit(""))
    return left.select(
        "doc_id", "n_removed", F.length(text).cast("long").alias("n_chars"), F.sha2(F.encode(text, "UTF-8"), 256).alias("kept_sha256")
    )


def op3_shingle_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 5-word shingles overlap by 75 percent or more."""
    return ngram_join.similar(table(spark, sf_dir, "documents"))


def op4_streaming_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by streaming Viterbi, and whether decoding gives the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    read = sentencepiece_viterbi.decode(sentencepiece_viterbi.encode(docs), text="decoded")
    return read.select(
        "doc_id",
        F.coalesce(F.octet_length("ids") / 4, F.lit(0)).cast("long").alias("n_ids"),
        F.crc32(F.coalesce("ids", F.lit(b""))).alias("ids_crc32"),
        F.sha2(F.encode(F.coalesce("decoded", F.lit("")), "UTF-8"), 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )


def op5_shuffled_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15 by two-pass shuffle; law `rows`."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    return sharding.shard(docs).select(
        "doc_id", "size", crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_vantage_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest rows of every embedding whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors.where(F.col("vec_id") % 100 == 0), vectors)


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the windows of 50 words that a smaller doc_id has."""
    left = substring_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_words", "UTF-8"), 256).alias("kept_sha256"))


def op8_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document and its verdict under the host-level rules."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    measured = kept(quality_rules.measure(docs).drop("text"), "op8")
    return quality_rules.with_verdicts(measured).select("doc_id", *quality_rules.MEASURES, "base_failed", "kept")


def op9_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by attention over its passages."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality_classifier.score(docs, model)
    return scored.select("doc_id", quality_classifier.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_ordered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens, cut by dynamic programming."""
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op11_run_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after planted damage: its faults, cheapest repair and what the repair leaves."""
    conversations = table(spark, sf_dir, "conversations")
    told, _ = conversation_repair.repair(conversation_repair.damaged(conversations), present=conversations)
    return told


def op12_bounded_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of every embedding by integer k-means under adaptive bounds."""
    coded, found = vector_codes.encode(table(spark, sf_dir, "embeddings"))
    coded = kept(coded, "op12")
    per_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(per_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(found.sha256()).alias("codebooks_sha256")
    )


def op13_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as prefix trees of tokens, and what is read back from these."""
    conversations = chat_tree.sample_conversation(table(spark, sf_dir, "conversations"))
    return chat_tree.read_back(chat_tree.format_tree(conversations))


_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP8_SQL = rf"""
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
grams AS (
  SELECT rid, unnest(range(1, len(w) - 1)) AS p, w FROM split WHERE len(w) >= 3),
windows AS (SELECT rid, p, count(*) OVER (PARTITION BY rid, w[p], w[p + 1], w[p + 2]) AS c FROM grams),
covered AS (
  SELECT rid, count(DISTINCT p + k) AS n FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE c >= 2 GROUP BY rid),
base AS (
  SELECT rid, doc_id, source, len(w) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN covered USING (rid)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 20 * word_chars
           OR 100 * n_dup_lines > 30 * n_lines AS rule_failed
  FROM base),
hosts AS (
  SELECT source AS h, count(*) AS n, sum(rule_failed::INT) AS f FROM judged WHERE source IS NOT NULL GROUP BY source),
total AS (SELECT count(*) AS hosts, sum(n) AS n, sum(f) AS f, sum(f * f / n::DOUBLE) AS ff FROM hosts),
moments AS (
  SELECT f / n::DOUBLE AS mean, (f / n::DOUBLE) * (1 - f / n::DOUBLE) AS noise,
         (ff - n * (f / n::DOUBLE) * (f / n::DOUBLE) - (hosts - 1) * (f / n::DOUBLE) * (1 - f / n::DOUBLE))
           / greatest(n - 1, 1) AS spread
  FROM total),
prior AS (
  SELECT mean, CASE WHEN spread <= 0 OR noise = 0 THEN 1e6
                    ELSE least(greatest(noise / spread - 1, 1.0), 1e6) END AS strength FROM moments),
rejected AS (SELECT h FROM hosts, prior WHERE (f + mean * strength) / (n + strength) >= 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(source IN (SELECT h FROM rejected), false) AS kept
FROM judged"""


#: Word sequences of lines, equal ones reduced to their first place. One edit (lines of 4 to 20 words): by leaving
#: out one word of each and comparing what is left. Two edits (both lines of 20 words or more): lines that
#: share a third are compared; without their common start and end, an edit stands at either end of what is left.
OP2_SQL = r"""
WITH raw AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
lines AS (
  SELECT doc_id, line, w, len(w) AS n FROM (
    SELECT doc_id, i - 1 AS line, list_filter(regexp_split_to_array(ls[i], '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM raw WHERE text IS NOT NULL AND doc_id IS NOT NULL))
  WHERE len(w) >= 1),
firsts AS (SELECT w, n, min(struct_pack(d := doc_id, l := line)) AS pos FROM lines GROUP BY w, n),
parts AS (
  SELECT pos, gone, list_concat(w[1:gone - 1], w[gone + 1:]) AS k
  FROM (SELECT pos, w, unnest(range(1, n + 1)) AS gone FROM firsts WHERE n BETWEEN 4 AND 20)
  UNION ALL SELECT pos, -1 AS gone, w AS k FROM firsts WHERE n BETWEEN 4 AND 20),
same AS (SELECT k, gone, min(pos) AS same FROM parts WHERE gone > 0 GROUP BY k, gone),
other AS (
  SELECT k, min(pos) FILTER (WHERE gone < 0) AS whole, min(pos) FILTER (WHERE gone > 0) AS part FROM parts GROUP BY k),
one AS (
  SELECT DISTINCT p.pos FROM parts p LEFT JOIN same s ON s.k = p.k AND s.gone = p.gone JOIN other o ON o.k = p.k
  WHERE CASE WHEN p.gone < 0 THEN coalesce(o.part < p.pos, false)
             ELSE coalesce(s.same < p.pos, false) OR coalesce(o.whole < p.pos, false) END),
far AS (SELECT pos, w, n FROM firsts WHERE n >= 20),
shorter AS (
  SELECT pos, n AS m, 'first' AS kind, md5(array_to_string(w[1:n // 3], ' ')) AS key FROM far
  UNION ALL SELECT pos, n, 'last', md5(array_to_string(w[n - n // 3 + 1:], ' ')) FROM far
  UNION ALL SELECT pos, n, 'middle', md5(array_to_string(w[n // 3 + 1:n - n // 3], ' ')) FROM far),
sizes AS (SELECT * FROM (SELECT pos, w, n, unnest([n, n - 1, n - 2]) AS m FROM far) WHERE m >= 20),
longer AS (
  SELECT pos, m, 'first' AS kind, md5(array_to_string(w[1:m // 3], ' ')) AS key FROM sizes
  UNION ALL SELECT pos, m, 'last', md5(array_to_string(w[n - m // 3 + 1:], ' ')) FROM sizes
  UNION ALL SELECT pos, m, 'middle', md5(array_to_string(w[m // 3 + s + 1:m - m // 3 + s], ' '))
  FROM (SELECT *, unnest(CASE n - m WHEN 0 THEN [-1, 0, 1] WHEN 1 THEN [0, 1] ELSE [0, 1, 2] END) AS s FROM sizes)),
pairs AS (SELECT DISTINCT a.pos AS p, b.pos AS q FROM shorter a JOIN longer b USING (m, kind, key) WHERE a.pos <> b.pos),
matched AS (SELECT p, q, x.w AS x, y.w AS y FROM pairs JOIN far x ON x.pos = p JOIN far y ON y.pos = q),
heads AS (
  SELECT *, coalesce(nullif(list_position(list_transform(range(1, len(x) + 1), lambda i: x[i] <> y[i]), true), 0) - 1, len(x)) AS head FROM matched),
tails AS (
  SELECT *, coalesce(nullif(list_position(list_transform(range(0, len(x) - head), lambda i: x[len(x) - i] <> y[len(y) - i]), true), 0) - 1, len(x) - head) AS tail
  FROM heads),
inner_ AS (SELECT p, q, x[head + 1:len(x) - tail] AS x, y[head + 1:len(y) - tail] AS y FROM tails),
two AS (
  SELECT DISTINCT greatest(p, q) AS pos FROM (SELECT *, len(x) AS k FROM inner_)
  WHERE CASE len(y) - k
    WHEN 0 THEN k <= 2 OR x[2:k - 1] = y[2:k - 1] OR x[2:] = y[1:k - 1] OR x[1:k - 1] = y[2:]
    WHEN 1 THEN k <= 1 OR x[2:] = y[2:k] OR x[1:k - 1] = y[2:k]
    WHEN 2 THEN k = 0 OR x = y[2:k + 1] END),
near AS (SELECT pos FROM one UNION SELECT pos FROM two),
gone AS (
  SELECT o.doc_id, list(o.line) AS ls FROM lines o JOIN firsts f ON f.w = o.w
  WHERE f.pos <> struct_pack(d := o.doc_id, l := o.line) OR f.pos IN (SELECT pos FROM near) GROUP BY o.doc_id),
done AS (
  SELECT r.doc_id, coalesce(len(g.ls), 0) AS n_removed,
         CASE WHEN g.ls IS NULL THEN coalesce(r.text, '')
              ELSE array_to_string(list_filter(r.ls, lambda x, i: NOT list_contains(g.ls, i - 1)), chr(10)) END AS t
  FROM raw r LEFT JOIN gone g ON g.doc_id = r.doc_id)
SELECT doc_id, CAST(n_removed AS BIGINT) AS n_removed, CAST(length(t) AS BIGINT) AS n_chars, sha256(t) AS kept_sha256 FROM done"""

#: crc32 bit by bit: each character is added, then shifted out in eight steps.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(k, ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""

#: Cheapest edits row by row: for each place of the allowed order the least (cost, edits), with what is left so far.
OP11_SQL = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
coded AS (SELECT * EXCLUDE k, {_CRC} % 20 AS code FROM keyed),
hurt AS (
  SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE code WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM coded WHERE code <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(strlen(role) || ':' || role || text)) AS i
  FROM hurt),
judged AS (
  SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS dup,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
counts AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND dup) AS duplicate,
         count(*) FILTER (NOT blank AND NOT dup AND cut) AS truncated,
         count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations),
inserts(p, q, e, c, o) AS (VALUES
  (0, 0, '', 0, ''), (1, 1, '', 0, ''), (2, 2, '', 0, ''), (3, 3, '', 0, ''),
  (0, 2, 'I', 2, chr(10) || 'user:'), (1, 2, 'I', 2, chr(10) || 'user:'), (3, 2, 'I', 2, chr(10) || 'user:'),
  (2, 3, 'I', 2, chr(10) || 'assistant:'), (0, 3, 'II', 4, chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, 3, 'II', 4, chr(10) || 'user:' || chr(10) || 'assistant:')),
edits(p, initial, q, e, c) AS (VALUES
  (0, 's', 1, 'K', 0), (0, 'u', 2, 'K', 0), (1, 'u', 2, 'K', 0), (2, 'a', 3, 'K', 0), (3, 'u', 2, 'K', 0),
  (0, '', 2, 'R', 2), (1, '', 2, 'R', 2), (2, '', 3, 'R', 2), (3, '', 2, 'R', 2),
  (0, '', 0, 'D', 3), (1, '', 1, 'D', 3), (2, '', 2, 'D', 3), (3, '', 3, 'D', 3)),
dp AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS p, struct_pack(c := 0::BIGINT, a := '', o := '') AS best FROM ids
  UNION ALL
  SELECT d.conv_id, d.i + 1, e.q, min(struct_pack(
           c := d.best.c + s.c + e.c + CASE WHEN e.e <> 'D' AND r.cut THEN 1 ELSE 0 END, a := d.best.a || s.e || e.e,
           o := d.best.o || s.o || CASE e.e WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || r.role || ':' || r.text
                                            ELSE chr(10) || CASE e.q WHEN 2 THEN 'user:' ELSE 'assistant:' END || r.text END))
  FROM dp d JOIN judged r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.i = d.i + 1
       JOIN inserts s ON s.p = d.p JOIN edits e ON e.p = s.q
  WHERE e.e = 'D' OR NOT (r.blank OR r.dup) AND (e.e = 'R' OR e.initial = r.initial)
  GROUP BY d.conv_id, d.i + 1, e.q),
done AS (
  SELECT d.conv_id, min(struct_pack(c := d.best.c + s.c, a := d.best.a || s.e, o := d.best.o || s.o)) AS best
  FROM dp d LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM d.conv_id JOIN inserts s ON s.p = d.p
  WHERE d.i = coalesce(n.n, 0) AND s.q IN (0, 3) GROUP BY d.conv_id)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit,
       sha256(substr(best.o, 2)) AS repaired_sha256
FROM done d LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM d.conv_id"""

_ROUNDS = "".join(
    f"""
took{r} AS (
  SELECT rid, p, min(struct_pack(d := list_sum(list_transform(list_zip(v, w), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := e)) AS t
  FROM parts JOIN book{r} USING (p) GROUP BY rid, p),
means{r} AS (
  SELECT p, t.e AS e, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS m
  FROM (SELECT rid, p, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM parts) JOIN took{r} USING (rid, p) GROUP BY p, t.e, i),
book{r + 1} AS (
  SELECT p, e, coalesce(n, w) AS w FROM book{r} LEFT JOIN (SELECT p, e, list(m ORDER BY i) AS n FROM means{r} GROUP BY p, e) USING (p, e)),"""
    for r in range(6)
)
OP12_SQL = f"""
WITH whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * x::DOUBLE) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: coalesce(NOT isfinite(x), true))) = 0),
numbered AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, q) AS rid FROM whole),
parts AS (
  SELECT rid, p, q[p * len(q) // 8 + 1:(p + 1) * len(q) // 8] AS v FROM (SELECT rid, q, unnest(range(8)) AS p FROM numbered)),
book0 AS (SELECT p, rid - 1 AS e, v AS w FROM parts WHERE rid <= 16),{_ROUNDS}
final AS (
  SELECT rid, p, min(struct_pack(d := list_sum(list_transform(list_zip(v, w), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := e)) AS t
  FROM parts JOIN book6 USING (p) GROUP BY rid, p),
coded AS (
  SELECT rid, string_agg(printf('%02x', t.e), '' ORDER BY p) AS code, CAST(sum(t.d) AS BIGINT) AS error FROM final GROUP BY rid),
books AS (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book6)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM numbered JOIN coded USING (rid), books"""

OP13_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r)),
turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(strlen(role) || ':' || role || text)) AS i,
         regexp_extract_all(role || chr(10) || text, '[\[<]\\*(/?INST\]|/?s>|\|endoftext\|>)') AS controls
  FROM said)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + length(text) + len(controls) + length('[INST][/INST]</s>')) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""


def builders() -> dict[str, Builder]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracles() -> dict[str, str]:
    return {
        "op2_near_line_dedup": OP2_SQL,
        "op8_host_quality": OP8_SQL,
        "op11_run_repair": OP11_SQL,
        "op12_bounded_codes": OP12_SQL,
        "op13_prefix_tree": OP13_SQL,
    }
