"""Registered queries of the training-data operators and their DuckDB SQL.

Each ``opN_`` query applies its operator, with production parameters, to its whole table and
derives the contract's columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, decontaminate, fingerprint, lexical, line_dedup, near_dup, packing, pii, quality, secret_scan, spans, suffix_dedup, warc,
               whitening)

SQL: dict[str, str] = {}


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_suffix_array_dedup(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", "text")
    done = suffix_dedup.remove_repeats(docs, keep=["doc_id"])
    return done.select(F.col("c0").alias("doc_id"), "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


SQL["op1_suffix_array_dedup"] = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
p AS (SELECT doc_id, g AS start, md5(substring(h, 2 * g + 1, 200)) AS s FROM b, unnest(generate_series(0, n - 100)) u(g) WHERE n >= 100),
r AS (SELECT doc_id, start FROM (SELECT doc_id, start, row_number() OVER (PARTITION BY s ORDER BY doc_id, start) AS k FROM p) WHERE k > 1),
i AS (SELECT doc_id, start, sum(CASE WHEN start <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY start) AS run
      FROM (SELECT doc_id, start, lag(start) OVER (PARTITION BY doc_id ORDER BY start) AS before FROM r)),
g AS (SELECT doc_id, min(start) AS a, max(start) + 100 AS z FROM i GROUP BY doc_id, run),
l AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS prev FROM g),
k AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last,
        string_agg(substring(h, 2 * prev + 1, 2 * (a - prev)), '' ORDER BY a) AS head FROM l JOIN b USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || substring(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM b LEFT JOIN k USING (doc_id)"""


CHAT_PROBE = "\\### Assistant: </turn> ok"


def op2_chat_formatting(spark, d):
    rows = _table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", CHAT_PROBE), (-7, 1, "assistant", CHAT_PROBE)], rows.schema)
    records = rows.unionByName(probe).select("conv_id", "turn", F.to_json(F.struct(F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text")).alias("payload"))
    turns = chat.canonical_turns(records, "conv_id", "turn", "payload")
    return chat.read_back(chat.format_turns(turns)).withColumnRenamed("key", "conv_id")


SQL["op2_chat_formatting"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '#', '\#'), '</turn>', '\</turn>') AS esc,
    replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</turn>', '\</turn>'), ':', '\:') AS esc_role FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + length(esc_role) + 2 + length(esc) + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


def op3_best_fit_packing(spark, d):
    return packing.pack_documents(_table(spark, d, "documents"), tokenizer_path())


def op4_decontamination(spark, d):
    return decontaminate.contaminated(_table(spark, d, "documents").select("doc_id", "text"), _table(spark, d, "benchmark"))


SQL["op4_decontamination"] = r"""
WITH w AS (
  SELECT 0 AS kind, item_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM benchmark
  UNION ALL
  SELECT 1, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM documents),
i AS (SELECT DISTINCT id, least(5, len(words)) AS n, array_to_string(words[g : g + least(5, len(words)) - 1], ' ') AS s
      FROM w, unnest(generate_series(1, greatest(len(words) - 4, 1))) u(g) WHERE kind = 0 AND len(words) > 0),
d AS (SELECT DISTINCT id, n, array_to_string(words[g : g + n - 1], ' ') AS s
      FROM w, (SELECT DISTINCT n FROM i) x, unnest(generate_series(1, len(words) - n + 1)) u(g) WHERE kind = 1 AND len(words) >= n),
z AS (SELECT id, count(*) AS n_shingles FROM i GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, any_value(n_shingles) AS n_shingles, count(*) AS n_found
FROM i JOIN d ON i.n = d.n AND i.s = d.s JOIN z ON z.id = i.id
GROUP BY d.id, i.id HAVING count(*) >= ceil(0.8 * any_value(n_shingles) - 1e-9)"""


def op5_line_dedup(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", "text")
    done = line_dedup.dedup_lines(docs)
    return done.select(F.col("c0").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL["op5_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, g AS pos, parts[g] AS line FROM (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) t, unnest(generate_series(1, len(parts))) u(g)),
k AS (
  SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
j AS (SELECT k.*, o.owner IS NOT NULL AND o.owner <> k.doc_id AS gone FROM k LEFT JOIN o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id"""


def op6_secret_scans(spark, d):
    docs = secret_scan.scan_secrets(_table(spark, d, "documents").select("doc_id", "text"))
    s = F.col("secret_spans")
    base = F.concat(s["assign"], s["access"], s["hex"])
    return docs.select("doc_id", *[F.size(s[k]).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
                       F.sha2(spans.joined(base), 256).alias("base_sha256"), spans.joined(F.concat(base, s["entropy"])).alias("spans"))


def op7_warc(spark, d):
    folder = warc.archive_folder(spark)
    warc.write_archives(_table(spark, d, "pages"), folder)
    # revisits get their length and digest through the capture index
    return warc.read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: a demonstration key; a production run passes its own secret
PII_KEY = "pseudonym key of the registered query"


def op8_pii_pseudonyms(spark, d):
    docs = pii.pseudonymise(_table(spark, d, "documents").select("doc_id", "text"), PII_KEY)
    n = lambda k: F.size(F.filter("pii_spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    found = F.array_join(F.transform("pii_spans", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return docs.select("doc_id", F.col("pseudonymised").alias("text"), *[n(k) for k in pii.KINDS], found.alias("spans"))


def op9_quality_rules(spark, d):
    rows = quality.quality_verdicts(_table(spark, d, "documents").select("doc_id", "lang", "text"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("log_perplexity", 4).alias("log_perplexity"))


def op10_ngram_jaccard_join(spark, d):
    return near_dup.near_duplicates(_table(spark, d, "documents").select("doc_id", "text"))


def op11_document_fingerprints(spark, d):
    return fingerprint.fingerprint_edits(_table(spark, d, "documents").select("doc_id", "text"))


SQL["op11_document_fingerprints"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
o AS (SELECT *, lead(t) OVER (ORDER BY doc_id DESC) AS after, first_value(t) OVER (ORDER BY doc_id DESC) AS top FROM d),
x AS (SELECT doc_id, t, length(t) AS n_chars, coalesce(after, top) AS next FROM o),
e AS (SELECT *, substring(t, 1, n_chars - n_chars // 3) || substring(next, 1, n_chars // 3) AS edited FROM x),
v AS (SELECT doc_id, 1 AS kind, t AS s FROM e UNION ALL SELECT doc_id, 2, edited FROM e UNION ALL SELECT doc_id, 3, next FROM e),
w AS (SELECT doc_id, kind, regexp_extract_all(s, '[^\x20\x09-\x0D]+') AS w FROM v),
h AS (SELECT doc_id, kind, list_sort(list_distinct(list_filter(list_transform(generate_series(1, CASE WHEN len(w) = 0 THEN 0 ELSE greatest(len(w) - 4, 1) END),
        lambda i: substring(md5(array_to_string(w[i : i + 4], ' ')), 1, 12)), lambda z: z < '40000000'))) AS k FROM w),
p AS (SELECT doc_id, any_value(k) FILTER (WHERE kind = 1) AS a, any_value(k) FILTER (WHERE kind = 2) AS b, any_value(k) FILTER (WHERE kind = 3) AS c FROM h GROUP BY doc_id)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, coalesce(array_to_string(a, ''), '') AS fingerprint, coalesce(array_to_string(b, ''), '') AS edited_fingerprint,
  CASE WHEN len(a) = 0 THEN CASE WHEN len(b) = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END ELSE len(list_intersect(a, b))::DOUBLE / len(a) END AS near_edited,
  CASE WHEN len(a) = 0 THEN CASE WHEN len(c) = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END ELSE len(list_intersect(a, c))::DOUBLE / len(a) END AS near_next
FROM e JOIN p USING (doc_id)"""


def op12_ranked_lexical_search(spark, d):
    return lexical.rank_documents(_table(spark, d, "documents").select("doc_id", "text"), _table(spark, d, "benchmark"))


SQL["op12_ranked_lexical_search"] = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)),
l AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM l),
f AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM f GROUP BY term), s),
i AS (SELECT f.doc_id, f.term, w.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))) AS impact FROM f JOIN l USING (doc_id) JOIN w USING (term), s),
r AS (SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM q JOIN i USING (term) GROUP BY item_id, doc_id HAVING sum(impact) > 0),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM r)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50"""


def op13_embedding_whitening(spark, d):
    done = whitening.whiten(_table(spark, d, "embeddings"))
    return done.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


SQL["op7_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT payload_digest, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN m USING (payload_digest)"""


QUERIES = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_chat_formatting": op2_chat_formatting,
    "op6_secret_scans": op6_secret_scans,
    "op7_warc": op7_warc,
    "op8_pii_pseudonyms": op8_pii_pseudonyms,
    "op9_quality_rules": op9_quality_rules,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_decontamination": op4_decontamination,
    "op5_line_dedup": op5_line_dedup,
    "op11_document_fingerprints": op11_document_fingerprints,
    "op12_ranked_lexical_search": op12_ranked_lexical_search,
    "op13_embedding_whitening": op13_embedding_whitening,
}
