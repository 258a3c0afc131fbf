"""One named query per operator, over whole tables with production parameters, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    classlm, decontaminate, fim, language, neardup, packing, quality, repair, ring, rules, simhash, text as T, urlfilter, warc,
)
from .frames import table, written

URL_RULES = (
    urlfilter.site_rule("org/", "allow"),
    urlfilter.site_rule("example.org/es/", "block"),
    urlfilter.site_rule("example.org/en/1", "block"),
    urlfilter.site_rule("com/fr/", "allow"),
    urlfilter.site_rule("com/de/", "block"),
    # Globs for URLs that no site rule covers.
    urlfilter.glob_rule("ads.*", "*", "block"),
    urlfilter.glob_rule("*", "*/login*", "block"),
    urlfilter.glob_rule("*", "*/wp-admin/*", "block"),
    urlfilter.glob_rule("*", "*.??g", "block"),
    urlfilter.glob_rule("m.*", "/es/*", "block"),
)
SHARDS = 24


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.fit(docs.where(T.fold("doc_id", 5) != 0))
    return language.identify(docs, model).select(
        "doc_id", (T.fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "accepted"
    )


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    book = rules.ledger(table(spark, folder, "documents"))
    failed = rules.base_failed()
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & rules.passes(rules.POLICIES["v1"])).alias("kept"), "fail_bits",
    )


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urlfilter.judge(table(spark, folder, "pages"), URL_RULES)


def op4_consistent_ring(spark: SparkSession, folder: str) -> DataFrame:
    data = F.coalesce(T.utf8("text"), F.lit(b""))
    sized = table(spark, folder, "documents").select(
        "doc_id", (F.length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32")
    )
    return ring.assign(sized, "doc_id", "text_crc32", SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_bin_completion(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_path())


def op6_bbit_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op7_class_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = classlm.fit(docs.where(T.fold("doc_id", 10) != 0))
    return classlm.score(docs, model).select(
        "doc_id", (T.fold("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


def op8_quality_score(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = quality.train_and_score(docs, labels, T.fold("doc_id", 4) != 2)
    return scored.select(
        "doc_id", (T.fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", decontaminate.items_digest().alias("items_sha256"), "contaminated"
    )


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc.write_archives(table(spark, folder, "pages"), warc.archive_folder(spark))
    number = lambda c: F.when(F.col(c) != "", F.col(c)).cast("long")
    return warc.read_archives(archives, with_payload=False).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    talks = table(spark, folder, "conversations")
    return repair.report(talks, repair.damage(talks)).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


def op12_multi_index_hashing(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    stored = written(fim.store(table(spark, folder, "documents")), "frames")
    return fim.transform(stored).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_quality_rules": op2_quality_rules,
    "op3_url_filter": op3_url_filter,
    "op4_consistent_ring": op4_consistent_ring,
    "op5_bin_completion": op5_bin_completion,
    "op6_bbit_minhash": op6_bbit_minhash,
    "op7_class_ngrams": op7_class_ngrams,
    "op8_quality_score": op8_quality_score,
    "op9_decontaminate": op9_decontaminate,
    "op10_warc": op10_warc,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_multi_index_hashing": op12_multi_index_hashing,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_WORD = r"'[^\x20\x09-\x0D]+'"

SQL: dict[str, str] = {}

SQL["op2_quality_rules"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, {_WORD}) AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), tri AS (
  SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS t
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, t) AS n FROM tri) WHERE n > 1
), cover AS (
  SELECT rid, count(DISTINCT i + k) AS n_repeat_words
  FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid
), m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines,
         length(text) - length(replace(text, '!', '')) AS n_bangs,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
         length(text) - length(regexp_replace(text, '[a-z]', '', 'g')) AS n_lower
  FROM w LEFT JOIN cover USING (rid)
), b AS (
  SELECT *,
    (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
     + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
     + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
     + CASE WHEN 100 * n_dup_lines > 60 * n_lines THEN 8 ELSE 0 END
     + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
     + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END
     + CASE WHEN n_upper > n_lower AND 2 * n_bangs > n_words THEN 64 ELSE 0 END
     + CASE WHEN n_words > 100000 THEN 128 ELSE 0 END)::BIGINT AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & 3) <> 0 AS base_failed, (fail_bits & 127) = 0 AS kept, fail_bits
FROM b
"""

SQL["op3_url_filter"] = r"""
WITH p AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p
), r AS (
  SELECT *,
    CASE WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM h
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
       WHEN rule IS NOT NULL THEN 'block'
       WHEN host LIKE 'ads.%' OR path LIKE '%/login%' OR path LIKE '%/wp-admin/%' OR path LIKE '%.__g'
            OR (host LIKE 'm.%' AND path LIKE '/es/%') OR host = '' THEN 'block'
       ELSE 'allow' END AS verdict
FROM r
"""

SQL["op10_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, encode(html) AS data, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS least FROM p),
bits AS (
  SELECT page_id, data, least, string_agg(lpad(bin(('0x' || substr(hex, 2 * i - 1, 2))::INT), 8, '0'), '' ORDER BY i) AS b
  FROM (SELECT *, unnest(range(1, 21)) AS i FROM h) GROUP BY ALL
)
SELECT page_id, octet_length(data)::BIGINT AS payload_bytes,
  (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
     1 + list_reduce([ascii(c) - 48 FOR c IN string_split(substr(b, 5 * k - 4, 5), '')], lambda x, y: 2 * x + y), 1), '' ORDER BY k)
   FROM (SELECT unnest(range(1, 33)) AS k)) AS payload_digest,
  CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> least THEN least END AS refers_to
FROM bits
"""

# Equal sets are one node. A link at 85 per cent needs most shingles in common, so of two sets that are ordered by
# one rule, the rarest first, one of the first n - ceil(0.85 n) + 1 is shared.
SQL["op6_bbit_minhash"] = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORD}) AS w
  FROM documents
), s AS (
  SELECT DISTINCT rid, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), sets AS (
  SELECT rid, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS h FROM s GROUP BY rid
), node AS (
  SELECT h, any_value(n) AS n, min(rid) AS rid, min(doc_id) AS least FROM sets JOIN d USING (rid) GROUP BY h
), rare AS (
  SELECT h, n, g, row_number() OVER (PARTITION BY h ORDER BY f, g) AS place
  FROM node JOIN s USING (rid) JOIN (SELECT g, count(*) AS f FROM s GROUP BY g) USING (g)
), pair AS (
  SELECT DISTINCT a.h AS a, b.h AS b
  FROM rare a JOIN rare b ON a.g = b.g AND a.h < b.h AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  WHERE 100 * a.place <= 15 * a.n + 100 AND 100 * b.place <= 15 * b.n + 100
), link AS (
  SELECT a, b FROM pair JOIN rare x ON x.h = a JOIN rare y ON y.h = b AND y.g = x.g
  GROUP BY a, b HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))
), edge AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), walk AS (
  SELECT h AS a, h AS b FROM node WHERE h IN (SELECT a FROM edge)
  UNION SELECT walk.a, edge.b FROM walk JOIN edge ON edge.a = walk.b
), part AS (
  SELECT walk.a AS h, min(least) AS component FROM walk JOIN node ON node.h = walk.b GROUP BY walk.a
)
SELECT doc_id, coalesce(sets.n, 0)::BIGINT AS n_shingles, coalesce(component, least, doc_id) AS component_id,
       coalesce(component, least, doc_id) = doc_id AS kept
FROM d LEFT JOIN sets USING (rid) LEFT JOIN node USING (h) LEFT JOIN part USING (h)
"""

SQL["op9_decontaminate"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 12], ' ') AS k, least(len(w), 13) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), hits AS (
  SELECT DISTINCT dw.rid, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n
), spots AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM hits)) GROUP BY rid
), items AS (
  SELECT rid, count(DISTINCT item_id) AS n_items,
         string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT rid, item_id, item_id::VARCHAR AS item FROM hits) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN spots USING (rid) LEFT JOIN items USING (rid)
"""

SQL["op13_fill_in_middle"] = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents
), u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS w,
         ('0x' || substr(x, 1, 8))::BIGINT AS h1, ('0x' || substr(x, 9, 8))::BIGINT AS h2,
         ('0x' || substr(x, 17, 8))::BIGINT AS h3, ('0x' || substr(x, 25, 8))::BIGINT AS h4
  FROM h
), f AS (
  SELECT doc_id, text, w, len(w)::BIGINT AS n,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
         least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b
  FROM u
), c AS (
  SELECT doc_id, text, n, form, array_to_string(w[1:a], '') AS p, array_to_string(w[a + 1:b], '') AS m, array_to_string(w[b + 1:n], '') AS s
  FROM f
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
"""

# CRC-32 bit by bit: a character's code enters, then eight shifts with the reversed polynomial.
SQL["op11_conversation_repair"] = r"""
WITH RECURSIVE base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations
), picked AS (
  SELECT *, xor(list_reduce(flatten(list_transform(string_split(k, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
      lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1)), 4294967295::BIGINT), 4294967295) % 20 AS pick
  FROM base
), damaged AS (
  SELECT conv_id, turn, CASE WHEN pick = 4 THEN 'user' ELSE role END AS role,
         CASE pick WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN pick = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM picked WHERE pick <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS said
  FROM damaged
), faults AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN said > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
  FROM placed
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
), step(p, q, r) AS (VALUES (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (2, 3, 'a'), (3, 2, 'u')),
closure(p, q, a) AS (
  VALUES (0, 0, ''), (1, 1, ''), (2, 2, ''), (3, 3, ''), (0, 2, 'I'), (0, 3, 'II'), (1, 2, 'I'), (1, 3, 'II'), (2, 3, 'I'), (3, 2, 'I')
), edit AS (
  SELECT p, q, r, kind, cost FROM step, (VALUES ('K', 0), ('R', 2)) AS k(kind, cost) WHERE kind = 'K' OR r <> 's'
  UNION ALL SELECT p, p, NULL, 'D', 3 FROM (VALUES (0), (1), (2), (3)) AS s(p)
), best AS (
  SELECT conv_id, 0::BIGINT AS i, q AS state, lpad((2 * len(a))::VARCHAR, 9, '0') || a AS plan FROM counts, closure WHERE p = 0
  UNION ALL
  SELECT b.conv_id, f.i, c.q AS state,
         min(lpad((left(b.plan, 9)::BIGINT + e.cost + 2 * len(c.a) + CASE WHEN f.fault = 'truncated' AND kind <> 'D' THEN 1 ELSE 0 END)::VARCHAR, 9, '0')
             || substr(b.plan, 10) || kind || c.a) AS plan
  FROM best b JOIN faults f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i + 1
       JOIN edit e ON e.p = b.state AND (kind <> 'K' OR e.r = f.initial) AND (kind = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
       JOIN closure c ON c.p = e.q
  GROUP BY b.conv_id, f.i, c.q
), chosen AS (
  SELECT b.conv_id, left(min(plan), 9)::BIGINT AS cost, substr(min(plan), 10) AS audit
  FROM best b JOIN counts n ON n.conv_id IS NOT DISTINCT FROM b.conv_id AND b.i = n.n WHERE state IN (0, 3) GROUP BY b.conv_id
), letters AS (
  SELECT conv_id, j, e, count(*) FILTER (e <> 'I') OVER w AS i, count(*) FILTER (e <> 'D') OVER w AS o
  FROM (SELECT conv_id, j, substr(audit, j, 1) AS e FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS j FROM chosen))
  WINDOW w AS (PARTITION BY conv_id ORDER BY j)
), made AS (
  SELECT l.conv_id, j, e, o, f.role, CASE WHEN e = 'I' THEN '' ELSE f.text END AS text,
         max(CASE WHEN o = 1 AND e = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS lead
  FROM letters l LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i AND e <> 'I' WHERE e <> 'D'
), texts AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (o - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j) AS whole
  FROM made GROUP BY conv_id
)
SELECT t.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) t
     LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM t.conv_id
     LEFT JOIN chosen h ON h.conv_id IS NOT DISTINCT FROM t.conv_id
     LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM t.conv_id
"""
