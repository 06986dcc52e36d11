"""The queries of the numbered operators, and their SQL where DuckDB can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patentlake.llm import bpe, decontaminate, html_wrapper, media, minhash, phrases, pii, quality, quality_rules, records, suffix_dedup, tokens, trie
from patentlake.sources.shared import size_of


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: bytes of a table for each core below which its rows are dealt anew
SPLIT_BYTES = 4 << 20


def _spread(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table; where it has fewer bytes than a small split for each core, and so perhaps one split, its rows are dealt to all cores."""
    rows, cores = _table(spark, sf_dir, name).select(*columns), spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if size_of(spark, f"{sf_dir}/{name}.parquet") < cores * SPLIT_BYTES else rows


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(_spread(spark, sf_dir, "documents", "doc_id", "text"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.written_digests(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.classify(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op5_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract_pages(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"), percent=85, side=10).drop("text")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents").select("lang", "text"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_token_counts, op2_decontamination, op3_token_records, op4_quality, op5_html_wrapper, op6_minhash, op7_byte_bpe, op8_pii, op9_suffix_dedup, op10_media, op11_phrases, op12_prefix_trie, op13_quality_rules)}

#: distinct windows of items meet every run of as many document words
OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS win
       FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, dw.n, item FROM dw JOIN bw USING (n, win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

#: every phrase counted by itself, every cut looked up
OP11_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
sizes AS (SELECT unnest([1, 2, 3, 4]) AS size),
f AS (SELECT lang, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase, count(*) AS f
      FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM pieces, sizes WHERE len(w) >= size) GROUP BY ALL),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 30),
cuts AS (SELECT lang, phrase, a, size, k, array_to_string(list_slice(w, 1, k), ' ') AS head, array_to_string(list_slice(w, k + 1, size), ' ') AS tail
         FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
scored AS (SELECT cuts.lang, cuts.phrase, size, a, h.f AS l, t.f AS r, CAST(2000000 * CAST(a AS HUGEINT) // (h.f + t.f) AS BIGINT) AS score, k
           FROM cuts JOIN (SELECT lang, phrase AS head, f FROM f) h ON h.lang = cuts.lang AND h.head = cuts.head
           JOIN (SELECT lang, phrase AS tail, f FROM f) t ON t.lang = cuts.lang AND t.tail = cuts.tail),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, size AS longer_size, a AS longer, array_to_string(list_slice(w, i, i + n - 1), ' ') AS phrase
           FROM (SELECT *, unnest(range(1, size - n + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS n FROM c))),
most AS (SELECT lang, phrase, max(longer) AS longer FROM inside GROUP BY lang, phrase),
ranked AS (SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
           FROM worst w LEFT JOIN most m ON m.lang = w.lang AND m.phrase = w.phrase WHERE longer IS NULL OR 100 * longer < 80 * a),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

#: digests of turns strung together are the keys of prefixes; the checksum of an id is computed bit by bit
OP12_SQL = r"""
WITH turns AS (SELECT CAST(conv_id AS BIGINT) AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
ordered AS (SELECT c, role, text, md5(concat(length(role), ':', role, text)) AS t, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, md5(concat(length(role), ':', role, text))) AS p FROM turns),
convs AS (SELECT c, CAST(c AS VARCHAR) AS s FROM (SELECT DISTINCT c FROM turns)),
bytes AS (SELECT c, flatten(list_transform(range(1, length(s) + 1), lambda i: [ascii(s[i]), -1, -1, -1, -1, -1, -1, -1, -1])) AS steps FROM convs),
heads AS (SELECT c, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], steps),
                       lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, CAST(3988292384 AS BIGINT) * (a & 1)) END), CAST(4294967295 AS BIGINT)) % 4 AS h FROM bytes),
paths AS (SELECT c, h, p, t, text FROM heads JOIN ordered USING (c) WHERE p > h
          UNION ALL SELECT heads.c, h, p, t, text FROM heads JOIN ordered o ON o.c = heads.c - heads.c % 20 WHERE p <= h),
turned AS (SELECT c, t, text, row_number() OVER (PARTITION BY c ORDER BY p) AS d FROM paths),
prefixes AS (SELECT c, 0 AS d, '' AS k, '' AS text FROM convs
             UNION ALL SELECT c, d, string_agg(t, '') OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS k, text FROM turned),
ended AS (SELECT c, max(d) AS d FROM prefixes GROUP BY c),
nodes AS (SELECT k, max(p.d) AS depth, min(p.c) AS conv_id, count(*) AS n, max(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))) AS words,
                 coalesce(string_agg(CASE WHEN ended.d = p.d THEN CAST(p.c AS VARCHAR) END, ',' ORDER BY p.c), '') AS ends
          FROM prefixes p JOIN ended ON p.c = ended.c GROUP BY k),
kids AS (SELECT substr(k, 1, length(k) - 32) AS k, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (k)),
sums AS (SELECT k, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n - 1) * words) AS saved
         FROM (SELECT substr(k, 1, 32 * a) AS k, n, words, n_children FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM full_nodes)) GROUP BY k)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, f.n AS n_convs, f.n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_nodes f JOIN sums USING (k) LEFT JOIN nodes up ON f.depth > 0 AND up.k = substr(f.k, 1, length(f.k) - 32)
"""

#: sketches, quartiles and fences as the operator has them
OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) AS n_lines
          FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
windows AS (SELECT r, i, concat(w[i], ' ', w[i + 1], ' ', w[i + 2]) AS win FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
twice AS (SELECT r, win FROM windows GROUP BY r, win HAVING count(*) > 1),
repeats AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 3)) AS p FROM windows JOIN twice USING (r, win)) GROUP BY r),
c AS (SELECT r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
      FROM d LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)),
rates AS (SELECT r, lang, source, unnest(['symbols', 'repeats', 'lines', 'length']) AS signal,
                 unnest([n_symbols * 1000000 // n_words, n_repeat_words * 1000000 // n_words, n_dup_lines * 1000000 // n_lines, word_chars * 1000000 // n_words]) AS rate
          FROM c WHERE n_words > 0),
sketch AS (SELECT lang, source, signal, (rate >> b) << b AS bucket, count(*) AS n FROM (SELECT *, greatest(length(bin(rate)) - 6, 0) AS b FROM rates) GROUP BY ALL),
levels AS (SELECT 0 AS k, lang, source, signal, bucket, n FROM sketch
           UNION ALL SELECT 1, lang, NULL, signal, bucket, sum(n) FROM sketch GROUP BY lang, signal, bucket
           UNION ALL SELECT 2, NULL, NULL, signal, bucket, sum(n) FROM sketch GROUP BY signal, bucket),
upto AS (SELECT *, sum(n) OVER (PARTITION BY k, lang, source, signal ORDER BY bucket) AS u, sum(n) OVER (PARTITION BY k, lang, source, signal) AS total FROM levels),
q AS (SELECT k, lang, source, signal, max(total) AS total, min(CASE WHEN u * 4 >= total THEN bucket END) AS q1, min(CASE WHEN u * 2 >= total THEN bucket END) AS q2,
             min(CASE WHEN u * 4 >= total * 3 THEN bucket END) AS q3 FROM upto GROUP BY k, lang, source, signal),
chosen AS (SELECT o.lang, o.source, o.signal, q.q1, q.q2, q.q3 FROM q o
           JOIN q ON q.signal = o.signal AND (q.k = 2 OR (q.k = 1 AND q.lang IS NOT DISTINCT FROM o.lang AND q.total >= 200)
                     OR (q.k = 0 AND q.lang IS NOT DISTINCT FROM o.lang AND q.source IS NOT DISTINCT FROM o.source AND q.total >= 200))
           WHERE o.k = 0 QUALIFY row_number() OVER (PARTITION BY o.lang, o.source, o.signal ORDER BY q.k) = 1),
fences AS (SELECT lang, source, signal, q2 + 4 * (q3 - q2) + CASE signal WHEN 'symbols' THEN 100000 WHEN 'length' THEN 1000000 ELSE 350000 END AS most,
                  CASE WHEN signal = 'length' THEN q2 - 4 * (q2 - q1) - 1000000 ELSE -1 END AS least FROM chosen),
outside AS (SELECT r, count(*) AS n FROM rates JOIN fences f ON f.signal = rates.signal AND f.lang IS NOT DISTINCT FROM rates.lang AND f.source IS NOT DISTINCT FROM rates.source
            WHERE rate > most OR rate < least GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n IS NULL AS kept
FROM c LEFT JOIN outside USING (r)
"""

SQL: dict[str, str] = {"op2_decontamination": OP2_SQL, "op11_phrases": OP11_SQL, "op12_prefix_trie": OP12_SQL, "op13_quality_rules": OP13_SQL}
