"""The registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from vigil.llm import (arc_convert, byte_convnet, compression_bands, curriculum, jaccard_join,
                       packing, prefix_forest, secret_scan, slot_table,
                       suffix_automaton, term_pipeline, toivonen, turn_tree)
from vigil.llm.store import keep, shared_folder
from vigil.sources.tables import table


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 4096 tokens; CRC-32 of each piece's ids."""
    import public_tokenizers
    return packing.piece_digests(packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of the compression bands for every document."""
    docs = table(spark, sf_dir, "documents")
    judged = compression_bands.judge(compression_bands.measure(docs, ["doc_id"]))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "repetitive", "incompressible",
                         "ratio", "chunks", "low_chunks", "high_chunks")


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under Jaccard links of 5-word shingles."""
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = byte_convnet.fit(docs)
    return (byte_convnet.predict(docs, model, columns=["doc_id"])
            .select("doc_id", byte_convnet.held_out(F.col("doc_id")).alias("held_out"),
                    "lang_pred", "score"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document: counts and digest of the base kinds, all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = secret_scan.scan(docs).select("doc_id", "spans")
    of = lambda k: F.size(F.filter("spans", lambda s: s["ord"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["ord"] < len(secret_scan.BASE))
    return spans.select(
        "doc_id", *[of(k).alias(f"n_{r.kind}") for k, r in enumerate(secret_scan.BASE)],
        F.sha2(secret_scan.as_text(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.as_text(F.col("spans")).alias("spans"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    return prefix_forest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


SHARD_NAMES = [f"shard-{k:02d}" for k in range(slot_table.SHARDS)]


def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slot and shard of every document by its id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return slot_table.place(docs, ["doc_id"], SHARD_NAMES)


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one with control strings, formatted, written and read back."""
    import public_tokenizers
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tree = keep(turn_tree.format_conversations(rows.unionByName(probe), ranks), "turns")
    return turn_tree.read_back(tree, ranks)


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document; sources weigh 3, 1, 2 in turn."""
    docs = table(spark, sf_dir, "documents")
    sizes = keep(docs.select("doc_id", "source", curriculum.word_count(F.col("text")).alias("n")),
                 "sizes")
    plan = curriculum.curriculum(sizes, size=F.col("n"))
    return plan.select("doc_id", "size", "source_size", "target", "taken",
                       F.floor(F.col("position") * 1e6).alias("position_ppm"))


def op10_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as ARC, converted to WARC, and read back."""
    arc, warc = shared_folder(spark, "arc"), shared_folder(spark, "warc")
    arc_convert.write_arc(table(spark, sf_dir, "pages"), arc)
    arc_convert.convert(spark, arc, warc)
    back = keep(arc_convert.read_warc(spark, warc), "warc-index")
    return arc_convert.refers_to_page(back).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of each language in all documents."""
    mined = toivonen.mine(table(spark, sf_dir, "documents"))
    return toivonen.ranked(mined).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item, and the items hit."""
    found = suffix_automaton.decontaminate(table(spark, sf_dir, "documents"),
                                           table(spark, sf_dir, "benchmark"), columns=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        suffix_automaton.item_digest(F.col("item_ids")).alias("items_sha256"),
                        "contaminated")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 documents that match each benchmark item best."""
    return term_pipeline.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


LLM_QUERIES = {q.__name__: q for q in (
    op1_pack, op2_quality, op3_jaccard, op4_language, op5_secrets, op6_nearest, op7_shard,
    op8_chat, op9_mix, op10_archive, op11_phrases,
    op12_decontaminate, op13_search)}
LLM_QUERIES["pipeline"] = corpus_pipeline.run


def _slots_sql() -> str:
    return ",".join(map(str, slot_table.fill_table(SHARD_NAMES)))


def _secrets_sql() -> str:
    """Every rule on every text; spans from split and match lengths."""
    parts = []
    for k, r in enumerate(secret_scan.RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(f"""SELECT rid, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
  's': list_sum(list_transform(p[:i], lambda x: length(x))) +
       coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0),
  'l': length(m[i]), 'ok': length(g[i]) >= {r.least}}})) AS x, {k} AS ord, '{r.kind}' AS kind
FROM (SELECT rid, regexp_extract_all(t, '{pattern}', 0) AS m,
  regexp_extract_all(t, '{pattern}', {r.group}) AS g,
  string_split_regex(t, '{pattern}') AS p FROM d) WHERE len(m) > 0""")
    return """WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t
  FROM documents),
x AS (""" + " UNION ALL ".join(parts) + """),
s AS (SELECT rid, ord, kind, CAST(x.s AS BIGINT) AS a, CAST(x.s + x.l AS BIGINT) AS b FROM x
  WHERE x.ok),
a AS (SELECT rid, CAST(count(*) FILTER (ord = 0) AS BIGINT) AS n_assign,
  CAST(count(*) FILTER (ord = 1) AS BIGINT) AS n_access,
  CAST(count(*) FILTER (ord = 2) AS BIGINT) AS n_hex,
  string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, ord) FILTER (ord < 3) AS base,
  string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, ord) AS spans
  FROM s GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (rid)"""


def _control_sql() -> str:
    """A regex for control strings, also such as are escaped already."""
    return "|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in turn_tree.CONTROL)


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LLM_ORACLES = {
    "op13_search": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({LOWER},
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT DISTINCT item_id, text FROM benchmark),
q AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all({LOWER},
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i),
g AS (SELECT count(*) FILTER (len(ws) > 0) AS docs, sum(len(ws)) AS words FROM d),
t AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(ws) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM f, g WHERE term IN (SELECT term FROM q)),
s AS (SELECT q.item_id, q.text, t.rid, CAST(sum(w * ((1000000000 * tf) //
    (1000 * tf + 8 * (10 + CAST((90 * len(d.ws) * g.docs) // g.words AS BIGINT))))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN t USING (term) JOIN d USING (rid), g GROUP BY ALL),
r AS (SELECT s.item_id, row_number() OVER (PARTITION BY s.item_id, s.text
    ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
  FROM s JOIN d USING (rid) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= {term_pipeline.TOP}""",
    "op12_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all({LOWER},
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
i AS (SELECT DISTINCT item_id, regexp_extract_all({LOWER},
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
l AS (SELECT item_id, ws, least(len(ws), {suffix_automaton.WINDOW}) AS m FROM i WHERE len(ws) > 0),
w AS (SELECT DISTINCT item_id, m, array_to_string(ws[p:p + m - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(ws) - m + 2)) AS p FROM l)),
x AS (SELECT rid, m, p, array_to_string(ws[p:p + m - 1], ' ') AS s
  FROM (SELECT rid, ws, m, unnest(range(1, len(ws) - m + 2)) AS p
    FROM d, (SELECT DISTINCT m FROM w))),
h AS (SELECT DISTINCT rid, item_id, p, x.m FROM x JOIN w ON x.s = w.s AND x.m = w.m),
c AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + m)) AS q FROM h)
  GROUP BY rid),
n AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN n USING (rid)""",
    "op11_phrases": f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex({LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
n AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, ws, unnest(range(1, len(ws) - k + 2)) AS i
  FROM w, (SELECT unnest(range(1, {toivonen.MOST_WORDS + 1})) AS k)),
f AS (SELECT lang, CAST(k AS INTEGER) AS k, array_to_string(ws[i:i + k - 1], ' ') AS phrase,
    count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= {toivonen.LEAST}),
c AS (SELECT lang, phrase, a, ws, unnest(range(1, len(ws))) AS j
  FROM (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k > 1) x
  WHERE NOT EXISTS (SELECT 1 FROM f AS o WHERE o.lang = x.lang AND o.k > x.k
    AND 100 * o.a >= 100 * x.a AND contains(' ' || o.phrase || ' ', ' ' || x.phrase || ' '))),
s AS (SELECT c.lang, c.phrase, c.a, c.j, l.a AS l, r.a AS r, n.n,
    (1000 * CAST(c.a AS HUGEINT) * CAST(n.n AS HUGEINT)) // (CAST(l.a AS HUGEINT) * CAST(r.a AS HUGEINT))
      AS score
  FROM c JOIN f AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:j], ' ')
  JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[j + 1:], ' ')
  JOIN n ON n.lang = c.lang),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS cut FROM s),
x AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM b WHERE cut = 1)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
  CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM x WHERE rank <= {toivonen.TOP}""",
    "op5_secrets": _secrets_sql(),
    "op7_shard": f"""
WITH t AS (SELECT string_split('{_slots_sql()}', ',') AS slots),
d AS (SELECT doc_id, source,
        CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT)
          % {slot_table.TABLE_SIZE} AS slot FROM documents)
SELECT doc_id, source, CAST(slot AS INTEGER) AS slot,
  'shard-' || lpad(slots[slot + 1], 2, '0') AS shard FROM d, t""",
    "op8_chat": f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT *, length(role) + length(text) + {len(turn_tree.TURN + turn_tree.TEXT + turn_tree.END)}
    + len(regexp_extract_all(role || chr(10) || text, '{_control_sql()}')) AS chars FROM c)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
    AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""",
    "op10_archive": f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, coalesce(html, '') AS h FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN n >= {arc_convert.MIN_REVISIT_BYTES} AND page_id < top THEN 'revisit'
    ELSE 'response' END AS record_type,
  CASE WHEN n >= {arc_convert.MIN_REVISIT_BYTES} AND page_id < top THEN top END AS refers_to,
  TRUE AS intact FROM w""",
    "op9_mix": f"""
WITH d AS (SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
    md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS o FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) AS turn,
    2 * source_size AS cap FROM s),
x AS (SELECT *, CASE turn WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS wt,
    CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS total FROM w),
y AS (SELECT *, cap * sum(wt) OVER (ORDER BY cap / wt, source NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
      <= (total - coalesce(sum(cap) OVER (ORDER BY cap / wt, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * wt AS capped FROM x),
z AS (SELECT source, source_size, turn, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE
      (total - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0)) * wt
      / sum(CASE WHEN NOT capped THEN wt END) OVER () END AS target FROM y),
r AS (SELECT d.doc_id, d.size, z.source_size, z.target, z.turn,
    CAST(round(z.target) AS BIGINT) AS goal,
    CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS at_word
  FROM d JOIN z ON d.source IS NOT DISTINCT FROM z.source),
p AS (SELECT *, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS passes FROM r),
q AS (SELECT *, least(greatest(goal - passes * source_size - at_word, 0), size) AS more FROM p),
u AS (SELECT *, passes * size + more AS taken,
    CASE WHEN passes > 0 THEN size ELSE more END AS words FROM q),
v AS (SELECT *, CASE WHEN words > 0 THEN (at_word + words / 2.0::DOUBLE) / goal END AS share FROM u)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
  CASE WHEN words > 0 THEN CAST(floor({
      __import__('re').sub(r'(\d)D', r'\1::DOUBLE',
                           curriculum.demand_time('share', 'turn', curriculum.SCHEDULES))
  } * 1e6::DOUBLE) AS BIGINT) END AS position_ppm FROM v""",
}
