"""The registered query of each operator and, where SQL can express it, its DuckDB form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_repair, exact_dedup, jaccard_join, language_id, lattice_dedup, merkle, mixing, packing, personal_data, secret_scan, suffix_dedup, token_files, toxicity
from .common import ascii_lower, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return out.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode_and_read(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = mixing.mix_to_targets(docs)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.digests(secret_scan.scan(docs, secret_scan.learn_formats(docs)))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digests(personal_data.detect(table(spark, sf_dir, "documents").select("doc_id", "text")))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults: by a hash of id and turn rows are dropped, emptied, cut at their sentences' ends, repeated or given to the user."""
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")}).withColumn("__fault", F.crc32(named.cast("binary")) % 20).where("__fault <> 0")
    text = F.when(F.col("__fault") == 1, "").when(F.col("__fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("__fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    role = F.when(F.col("__fault") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("__time")).drop("__time")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.repair(damaged(rows), rows)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    altered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    seen = merkle.leaf([altered if c == "text" else F.col(c) for c in merkle.COLUMNS])
    out = merkle.manifest(docs, {"seen": seen})
    out = out.withColumn("folded_root", merkle.folded(F.col("seen"), F.col("places"), F.col("others"))).withColumn("proof_sha256", merkle.proof_digest(F.col("others")))
    out = out.withColumns({c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "root")}).withColumn("verified", F.col("folded_root") == F.col("root"))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_language_id": op4_language_id,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_token_files": op6_token_files,
    "op7_mixing": op7_mixing,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_secret_scan": op10_secret_scan,
    "op11_personal_data": op11_personal_data,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_merkle_manifest": op13_merkle_manifest,
}

#: The table of CRC-32 as one list; crcs.c[1] is that of byte 0.
_CRC = "bytes AS (SELECT i, i AS c0 FROM range(256) r(i)),\n" + "".join(
    f"b{k + 1} AS (SELECT i, CASE WHEN c{k} % 2 = 1 THEN xor(c{k} >> 1, 3988292384::BIGINT) ELSE c{k} >> 1 END AS c{k + 1} FROM {f'b{k}' if k else 'bytes'}),\n" for k in range(8)
) + "crcs AS (SELECT list(c8 ORDER BY i) AS c FROM b8)"


def _crc(text: str) -> str:
    """SQL for the CRC-32 of an ASCII text, beside a table crcs."""
    step = "lambda s, x: xor(s >> 8, c[(xor(s, x) & 255) + 1])"
    return f"xor(list_reduce(list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT), {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


def _insert(own: str, to: str) -> str:
    """SQL for the better of a state's rest and that of another one behind an inserted row."""
    return f"least({own}, {{'n': {to}.n + 2, 'a': 'I' || {to}.a}})"


def _row(system: str, own: str, after_s: str, keeps: str, after: str, other: str) -> str:
    """SQL for the best that a row makes of a state: deleted, kept as s or as its next role, or given that role."""
    kept = f"CASE WHEN fault IN (1, 2) THEN NULL WHEN {system} THEN {{'n': {after_s}.n + (fault = 3)::INT, 'a': 'K' || {after_s}.a}} WHEN {keeps} THEN {{'n': {after}.n + (fault = 3)::INT, 'a': 'K' || {after}.a}} END"
    named = f"CASE WHEN fault NOT IN (1, 2) THEN {{'n': {other}.n + 2 + (fault = 3)::INT, 'a': 'R' || {other}.a}} END"
    return f"least({{'n': {own}.n + 3, 'a': 'D' || {own}.a}}, {kept}, {named})"


ORACLE_SQL = {
    "op2_exact_dedup": """
WITH h AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM h WINDOW g AS (PARTITION BY text_sha256)""",
    "op8_embedding_near_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings),
good AS (
  SELECT * FROM v WHERE label IS NOT NULL AND x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
  AND len(list_filter(x, lambda c: c <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.a = v.vec_id) AS n_links, min(r.b) AS component_id, v.vec_id = min(r.b) AS kept
FROM v JOIN reach r ON r.a = v.vec_id GROUP BY v.vec_id""",
    "op9_jaccard_join": """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, min(r.b) AS component_id FROM sets JOIN reach r ON r.a = sets.doc_id GROUP BY sets.doc_id, s""",
    "op7_mixing": """
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest, row_number() OVER (PARTITION BY doc_id, source, text) AS number, coalesce(length(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s),
w AS (SELECT *, (rank - 1) % 3 + 1 AS w, source_size * 3.0::DOUBLE / ((rank - 1) % 3 + 1) AS full_at FROM r),
l AS (
  SELECT *, ((sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER b, 0))::DOUBLE
             / (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::DOUBLE) AS level
  FROM w WINDOW b AS (ORDER BY full_at, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, least(w * (SELECT level FROM l WHERE level <= full_at ORDER BY full_at, rank LIMIT 1), source_size * 3.0::DOUBLE) AS target
  FROM l),
j AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
         ('0x' || substr(md5('mix-17:' || coalesce(doc_id::VARCHAR, '') || ':' || digest || ':' || number), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM j""",
    "op12_conversation_repair": f"""
WITH RECURSIVE {_CRC},
hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS f FROM conversations, crcs),
rows AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hashed, range(2) r(t) WHERE f <> 0 AND (t = 0 OR f = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
         count(*) OVER (PARTITION BY conv_id) AS n FROM rows),
marked AS (
  SELECT *, left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS b,
         CASE WHEN body = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
  FROM placed),
-- from the last row to the first: of each state (before anything, after s, u, a) the cheapest rest, with the least letters
ends AS (SELECT DISTINCT conv_id, n FROM marked),
walk AS (
  SELECT conv_id, n + 1 AS i, {{'n': 0, 'a': ''}} AS s0, {{'n': 4, 'a': 'II'}} AS s1, {{'n': 2, 'a': 'I'}} AS s2, {{'n': 0, 'a': ''}} AS s3 FROM ends
  UNION ALL
  SELECT conv_id, i, {_insert('t0', 't2')} AS s0, {_insert('t1', 't2')} AS s1, t2 AS s2, {_insert('t3', 't2')} AS s3 FROM (
    SELECT conv_id, i, r0 AS t0, r1 AS t1, {_insert('r2', 'q3')} AS t2, q3 AS t3 FROM (
      SELECT *, {_insert('r3', 'r2')} AS q3 FROM (
        SELECT m.conv_id, m.i, {_row("c = 's'", 's0', 's1', "c = 'u'", 's2', 's2')} AS r0, {_row("false", 's1', 's1', "c = 'u'", 's2', 's2')} AS r1,
               {_row("false", 's2', 's2', "c = 'a'", 's3', 's3')} AS r2, {_row("false", 's3', 's3', "c = 'u'", 's2', 's2')} AS r3
        FROM walk w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i - 1)))),
best AS (SELECT conv_id, s0.n::BIGINT AS cost, s0.a AS audit FROM walk WHERE i = 1),
letters AS (SELECT conv_id, unnest(string_split(audit, '')) AS e, unnest(range(length(audit))) AS k FROM best WHERE audit <> ''),
counted AS (
  SELECT *, count(*) FILTER (e <> 'I') OVER o AS i, count(*) FILTER (e <> 'D') OVER o AS p FROM letters WINDOW o AS (PARTITION BY conv_id ORDER BY k)),
joined AS (
  SELECT l.*, m.role, m.text, bool_or(l.p = 1 AND l.e = 'K' AND m.c = 's') OVER (PARTITION BY l.conv_id) AS has_s
  FROM counted l LEFT JOIN marked m ON l.e <> 'I' AND m.conv_id IS NOT DISTINCT FROM l.conv_id AND m.i = l.i WHERE l.e <> 'D'),
fixed AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (p - has_s::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS body
  FROM joined GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (b IS NOT NULL AND b || c NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN fixed f ON f.conv_id IS NOT DISTINCT FROM o.conv_id""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE {_CRC},
marked AS (
  SELECT d.*, {_crc('doc_id::VARCHAR')} % 3 = 0 AS altered
  FROM documents d, crcs),
fields AS (
  SELECT doc_id, lang, altered,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
         || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS body,
         coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS altered_body FROM marked),
digests AS (
  SELECT doc_id, lang, sha256(head || body) AS leaf, CASE WHEN altered THEN sha256(head || altered_body) ELSE sha256(head || body) END AS seen FROM fields),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM digests),
tree AS (
  SELECT lang, 0 AS level, i, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM leaves
  UNION ALL
  SELECT lang, level, i, h, count(*) OVER (PARTITION BY lang) AS n FROM (
    SELECT lang, level + 1 AS level, i // 8 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM tree WHERE n > 1 GROUP BY lang, level, i // 8)),
subroots AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS j FROM tree WHERE n = 1),
upper_tree AS (
  SELECT 0 AS level, j AS i, subroot AS h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level, i, h, count(*) OVER () AS n FROM (
    SELECT level + 1 AS level, i // 8 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM upper_tree WHERE n > 1 GROUP BY level, i // 8)),
nodes AS (
  SELECT lang, false AS above, level, i, h FROM tree WHERE n > 1
  UNION ALL SELECT NULL, true, level, i, h FROM upper_tree WHERE n > 1),
runs AS (
  SELECT lang, above, level, i // 8 AS run, list(h ORDER BY i) AS hs FROM nodes GROUP BY lang, above, level, i // 8),
heights AS (SELECT lang, above, max(level) + 1 AS height FROM runs GROUP BY lang, above),
steps AS (
  SELECT l.lang, l.i, s.j, r.above, r.level, r.hs, (CASE WHEN r.above THEN s.j ELSE l.i END >> (3 * r.level)) % 8 AS place,
         r.level + CASE WHEN r.above THEN coalesce(t.height, 0) ELSE 0 END AS step
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang LEFT JOIN heights t ON NOT t.above AND t.lang IS NOT DISTINCT FROM l.lang
  JOIN runs r ON (r.above AND r.run = s.j >> (3 * (r.level + 1))) OR (NOT r.above AND r.lang IS NOT DISTINCT FROM l.lang AND r.run = l.i >> (3 * (r.level + 1)))),
proofs AS (
  SELECT lang, i, string_agg(array_to_string(hs[:place] || hs[place + 2:], ''), '' ORDER BY step) AS proof,
         list({{'before': array_to_string(hs[:place], ''), 'after': array_to_string(hs[place + 2:], '')}} ORDER BY step) AS steps FROM steps GROUP BY lang, i),
fold AS (
  SELECT l.lang, l.i, 0 AS step, l.seen AS h, p.steps FROM leaves l LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM l.lang AND p.i = l.i
  UNION ALL
  SELECT lang, i, step + 1, sha256(steps[step + 1].before || h || steps[step + 1].after), steps FROM fold WHERE step < coalesce(len(steps), 0))
SELECT l.doc_id, l.leaf, s.subroot, u.h AS root, sha256(coalesce(p.proof, '')) AS proof_sha256, f.h AS folded_root, f.h = u.h AS verified
FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang CROSS JOIN (SELECT h FROM upper_tree WHERE n = 1) u
LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM l.lang AND p.i = l.i
JOIN fold f ON f.lang IS NOT DISTINCT FROM l.lang AND f.i = l.i AND f.step = coalesce(len(p.steps), 0)""",
}
