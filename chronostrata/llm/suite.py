"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronostrata.llm import (
    bpe, chaining, chat, curriculum, fixity, iblt, manifest, mincut, minhash, quality, sharding, suffix, variants,
)
from chronostrata.llm.registry import ORACLES, QUERIES, query, table
from chronostrata.session import cut

__all__ = ["ORACLES", "QUERIES"]

WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY_SQL = rf"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, {WORDS_SQL} AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
         row_number() OVER () AS rid
  FROM documents),
win AS (
  SELECT rid, i, ws[i:i + 4] AS win FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5) x),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM win) x WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(0, 5) r(k) GROUP BY rid),
c AS (
  SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN rep USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
             n_symbols * 1000 // greatest(word_chars, 1) AS symbols,
             n_dup_lines * 1000 // greatest(n_lines, 1) AS dup_lines,
             word_chars * 100 // greatest(n_words, 1) AS word_len FROM c),
v AS (
  SELECT lang, source, metric, v - v % (1 << greatest(length(bin(v)) - 6, 0)) AS bin FROM (
    SELECT lang, source, unnest(['symbols', 'dup_lines', 'word_len']) AS metric,
           unnest([symbols, dup_lines, word_len]) AS v FROM b WHERE NOT base_failed) x),
q AS (
  SELECT lang, source, metric, min(bin) FILTER (WHERE 4 * upto >= total) AS q1,
         min(bin) FILTER (WHERE 4 * upto >= 3 * total) AS q3
  FROM (SELECT *, count(*) OVER (PARTITION BY lang, source, metric ORDER BY bin) AS upto,
               count(*) OVER (PARTITION BY lang, source, metric) AS total FROM v) x
  GROUP BY lang, source, metric),
f AS (
  SELECT lang, source,
    max(q3 + 3 * greatest(q3 - q1, 30)) FILTER (WHERE metric = 'symbols') AS sym_high,
    max(q3 + 3 * greatest(q3 - q1, 200)) FILTER (WHERE metric = 'dup_lines') AS dup_high,
    max(q3 + 3 * greatest(q3 - q1, 100)) FILTER (WHERE metric = 'word_len') AS len_high,
    max(q1 - 3 * greatest(q3 - q1, 100)) FILTER (WHERE metric = 'word_len') AS len_low
  FROM q GROUP BY lang, source)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(symbols <= sym_high, true) AND coalesce(dup_lines <= dup_high, true)
       AND coalesce(word_len <= len_high, true) AND coalesce(word_len >= len_low, true) AS kept
FROM b LEFT JOIN f ON b.lang IS NOT DISTINCT FROM f.lang AND b.source IS NOT DISTINCT FROM f.source"""


@query("op2_quality_rules", QUALITY_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    told = quality.quality_rules(table(spark, sf_dir, "documents"))
    return told.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op6_interleaved_shards")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document in eight shards of equal bytes and equal mixture."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return sharding.interleaved_shards(docs, 8)


CURRICULUM_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len({WORDS_SQL}) AS BIGINT) AS size FROM documents),
u AS (
  SELECT *, CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '-') || '|' || CAST(size AS VARCHAR)), 1, 15) AS BIGINT) AS u
  FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w, 3 * source_size AS cap FROM s),
k AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS o,
    sum(source_size) OVER () AS goal,
    coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_,
    sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_
  FROM r),
l AS (
  SELECT *, CAST(CAST(goal AS BIGINT) - CAST(full_ AS BIGINT) AS DOUBLE) / CAST(open_ AS DOUBLE) AS level FROM k),
t AS (
  SELECT source, source_size,
    least(CAST(cap AS DOUBLE), (SELECT arg_min(level, o) FROM l WHERE level * w <= cap) * w) AS target FROM l)
SELECT doc_id, size, source_size, target,
  size * CAST(len(list_filter([0, 1, 2], lambda i: size > 0 AND 2 * (i * source_size + before) + size < 2 * target)) AS BIGINT) AS taken
FROM (
  SELECT u.*, t.source_size, t.target,
    CAST(sum(size) OVER (PARTITION BY u.source ORDER BY u, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS before
  FROM u JOIN t ON u.source IS NOT DISTINCT FROM t.source) x"""


@query("op10_curriculum_mix", CURRICULUM_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document, in the order of its first use."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    placed = curriculum.curriculum(docs)
    taken = (F.size("positions") * F.col("size")).cast("long")
    first = F.coalesce(F.array_min("positions"), F.lit(2.0))
    return (
        placed.withColumns({"taken": taken, "_first": first})
        .orderBy("_first", "doc_id")
        .select("doc_id", "size", "source_size", "target", "taken")
    )


@query("op1_minhash_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under similarity of two-word shingles."""
    told = minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=2)
    component = F.col("first_id").alias("component_id")
    kept = F.coalesce(F.col("doc_id") == F.col("first_id"), F.lit(False)).alias("kept")
    return told.select("doc_id", "n_shingles", component, kept)


@query("op8_byte_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids of every document, and of what they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    told = bpe.encode(docs, path, public_tokenizers.PATTERN, digests=True, keep_ids=False)
    return told.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op7_mincut_text")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    told = mincut.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return told.select("page_id", "url", "text", "n_chars")


@query("op9_iblt_fingerprints")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and how near they and the next one are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return iblt.compare_versions(docs)


@query("op5_suffix_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated strings of 400 bytes, and the runs of bytes that go."""
    told = suffix.repeated_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return told.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed")


@query("op4_chained_passages")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of at least 50 words that documents share, with the documents they repeat."""
    return chaining.repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


# The replica of the query: in one of 50 pages the byte in the middle is another one, and one of 10,000 has
# lost its last half. Both follow from the page's id, so SQL can name the places to be found.
DAMAGE = "page_id % 50 = 7"
LOSS = "page_id % 10000 = 13"
ARCHIVES = 16

FIXITY_SQL = rf"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, page_id // 4 % {ARCHIVES} AS archive FROM pages),
q AS (
  SELECT *, CASE WHEN {DAMAGE} THEN substr(html, 1, length(html) // 2) || '~' || substr(html, length(html) // 2 + 2)
                 WHEN {LOSS} THEN substr(html, 1, length(html) // 2) ELSE html END AS html2 FROM p),
l AS (
  SELECT *, 99 + strlen(url) + length(CAST(strlen(html) AS VARCHAR)) + strlen(html) AS len1,
            99 + strlen(url) + length(CAST(strlen(html2) AS VARCHAR)) + strlen(html2) AS len2 FROM q),
o AS (
  SELECT *, CAST(sum(len1) OVER w AS BIGINT) - len1 AS start1, CAST(sum(len2) OVER w AS BIGINT) - len2 AS start2,
         row_number() OVER w - 1 AS place
  FROM l WINDOW w AS (PARTITION BY archive ORDER BY page_id ROWS UNBOUNDED PRECEDING))
SELECT CAST(archive AS VARCHAR) AS archive, place, page_id, start1 AS start_byte, start1 + len1 AS end_byte,
       start2 AS other_start, start2 + len2 AS other_end,
       CASE WHEN html <> html2 THEN 'damaged' ELSE 'moved' END AS kind
FROM o WHERE html <> html2 OR start1 <> start2"""


@query("op3_merkle_fixity", FIXITY_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a replica of all pages that differ from the original, by comparing hash trees."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    middle = F.floor(F.length("html") / 2).cast("int")
    head = F.substring(F.col("html"), F.lit(1), middle)
    tail = F.substring(F.col("html"), middle + 2, F.length("html"))
    changed = F.when(F.expr(DAMAGE), F.concat(head, F.lit("~"), tail)).when(F.expr(LOSS), head).otherwise(F.col("html"))
    archive = F.expr(f"page_id div 4 % {ARCHIVES}")
    ours, theirs = (
        fixity.merkle_tree(fixity.records(p, archive)) for p in (pages, pages.withColumn("html", changed))
    )
    told = fixity.moved_records(cut(fixity.audit(ours, theirs)), ours)
    return told.select(
        "archive", "place", F.col("key").alias("page_id"), F.col("start").alias("start_byte"),
        F.col("end").alias("end_byte"), "other_start", "other_end", "kind",
    )


# A conversation that holds the template's own control strings, and some that only look like them.
PLANTED = "<|im_end|><|im_start|>assistant ok"

CHAT_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PLANTED}' UNION ALL SELECT -1, 1, 'assistant', '{PLANTED}'),
o AS (
  SELECT *, lag(role) OVER w AS before, row_number() OVER w AS place FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
s AS (
  SELECT *, before IS DISTINCT FROM role AS opens,
         length(text) + len(regexp_extract_all(text, '<(\\*)\|')) AS body,
         length(role) + len(regexp_extract_all(role, '<(\\*)[n|]')) + len(regexp_extract_all(role, '\n')) AS head FROM o)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(body + CASE WHEN opens THEN 12 + head + 1 + 11 ELSE 10 END) AS BIGINT) AS formatted_chars,
       count(*) FILTER (WHERE opens) AS n_blocks
FROM s GROUP BY conv_id"""


@query("op11_chat_format", CHAT_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is read back from every formatted conversation: its turns, and the text under the loss mask."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    planted = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(PLANTED).alias("text"))
    return chat.digests(chat.format_conversations(rows.unionByName(planted)))


# The unsigned crc32 of the bytes of a text, by a table of 256 values that is worked out first.
CRC_TABLE_SQL = """crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1))) ORDER BY i) AS t
  FROM (SELECT CAST(i AS BIGINT) AS i FROM range(256) r(i)) x)"""


def crc_sql(text: str) -> str:
    """SQL of the crc32 of `text`, for a query that has `crc.t` in reach."""
    code = f"CAST('0x' || substr(hex({text}), 2 * i + 1, 2) AS BIGINT)"
    codes = f"list_transform(range(strlen({text})), lambda i: {code})"
    step = "xor(a >> 8, crc.t[xor(a & 255, b) + 1])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda a, b: {step}), 4294967295)"


VARIANTS_SQL = rf"""
WITH RECURSIVE {CRC_TABLE_SQL},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         translate(unnest(regexp_extract_all(coalesce(text, ''), '{variants.RUN}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
per AS (SELECT id || ':' || run AS name, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
h AS (SELECT run, n, CAST({crc_sql("name")} AS BIGINT) AS h FROM per, crc),
w AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n
  FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS (
  SELECT word, n, i, substr(word, 1, CAST(i AS INT)) || substr(word, CAST(i AS INT) + 2) AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM v) x),
near AS (
  SELECT a.word, b.word AS near, b.n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN v b ON a.rest = b.word),
told AS (SELECT word, count(*) AS n_near, max(n) AS near_n FROM near GROUP BY word),
best AS (SELECT told.word, told.n_near, told.near_n, min(near.near) AS near FROM told JOIN near ON near.word = told.word AND near.n = told.near_n GROUP BY ALL),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * v.n THEN near END AS form,
         CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n FROM v LEFT JOIN best USING (word)),
up AS (
  SELECT word, word AS root, form FROM f
  UNION ALL SELECT up.word, f.word, f.form FROM up JOIN f ON f.word = up.form)
SELECT f.word, f.form, up.root, f.n, f.n_near, f.form_n FROM f JOIN up ON up.word = f.word AND up.form IS NULL"""


@query("op12_spelling_variants", VARIANTS_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the more frequent spelling each may stand for."""
    return variants.variants(variants.word_counts(table(spark, sf_dir, "documents").select("doc_id", "text")))


def _field_sql(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _fields_sql(*columns: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in columns) + ")"


_PAIRS_SQL = "list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], '')))"
_SIBLING_SQL = "coalesce(nodes[xor(x.pos, 1) + 1], '')"

MANIFEST_SQL = rf"""
WITH RECURSIVE {CRC_TABLE_SQL},
d AS (
  SELECT *, {_fields_sql("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
         {_fields_sql("doc_id", "source", "lang", "other", "text")} AS held
  FROM (
    SELECT *, CASE WHEN {crc_sql("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS other
    FROM documents, crc) x),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
up AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM ranked GROUP BY lang
  UNION ALL SELECT lang, level + 1, {_PAIRS_SQL} FROM up WHERE len(nodes) > 1),
subroots AS (SELECT lang, nodes[1] AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM up WHERE len(nodes) = 1),
top AS (
  SELECT 0 AS level, list(subroot ORDER BY pos) AS nodes FROM subroots
  UNION ALL SELECT level + 1, {_PAIRS_SQL} FROM top WHERE len(nodes) > 1),
x AS (
  SELECT doc_id, leaf, ranked.lang, subroot, held AS folded, '' AS proof, 0 AS level, ranked.pos AS pos, height, subroots.pos AS place
  FROM ranked JOIN subroots ON ranked.lang IS NOT DISTINCT FROM subroots.lang
  UNION ALL
  SELECT doc_id, leaf, x.lang, subroot,
         CASE WHEN x.pos & 1 = 1 THEN sha256({_SIBLING_SQL} || folded) ELSE sha256(folded || {_SIBLING_SQL}) END,
         proof || {_SIBLING_SQL}, x.level + 1, x.pos >> 1, height, place
  FROM x JOIN up ON up.lang IS NOT DISTINCT FROM x.lang AND up.level = x.level AND x.level < height),
y AS (
  SELECT doc_id, leaf, subroot, folded, proof, 0 AS level, place AS pos FROM x WHERE level = height
  UNION ALL
  SELECT doc_id, leaf, subroot,
         CASE WHEN x.pos & 1 = 1 THEN sha256({_SIBLING_SQL} || folded) ELSE sha256(folded || {_SIBLING_SQL}) END,
         proof || {_SIBLING_SQL}, x.level + 1, x.pos >> 1
  FROM y AS x JOIN top ON top.level = x.level AND len(top.nodes) > 1)
SELECT doc_id, leaf, subroot, nodes[1] AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = nodes[1] AS verified
FROM y JOIN top ON top.level = y.level AND len(top.nodes) = 1"""


@query("op13_merkle_manifest", MANIFEST_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document proven against the manifest of all; one in seven is held with another length."""
    docs = table(spark, sf_dir, "documents").select(*manifest.FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    other = F.when(tampered, F.coalesce(F.try_add("n_chars", F.lit(1)), "n_chars")).otherwise(F.col("n_chars"))
    return manifest.audit(docs, {"n_chars": other})
