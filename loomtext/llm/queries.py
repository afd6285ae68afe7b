"""The queries of this subpackage, with the parameters they have in production, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, audit, decontam, langid, lines, mixing, negatives, pii, quality, shards, simhash, tokens, toxicity
from .common import durable, new_folder, remove_folder, table

SHARDS = 24


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "n_words", "similarity")


#: Every item-sized window of every document that shares a shingle with the item, by exact similarity and without fingerprints.
OP1_SQL = """
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS w FROM documents
), i AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS w FROM benchmark
), k AS (SELECT item_id, w, len(w) AS n_words, least(5, len(w)) AS k, len(w) - least(5, len(w)) + 1 AS m FROM i WHERE len(w) > 0
), g AS (
  SELECT item_id, k, m, n_words, array_to_string(w[p : p + k - 1], ' ') AS gram, count(*) AS c FROM (SELECT *, unnest(range(1, m + 1)) AS p FROM k) GROUP BY ALL
), s AS (
  SELECT doc_id, k, p - 1 AS p, n, array_to_string(w[p : p + k - 1], ' ') AS gram
  FROM (SELECT doc_id, w, x.k, len(w) - x.k + 1 AS n, unnest(range(1, len(w) - x.k + 2)) AS p FROM d CROSS JOIN (SELECT DISTINCT k FROM k) x WHERE len(w) >= x.k)
), pairs AS (SELECT DISTINCT s.doc_id, s.n, g.item_id, g.k, g.m, g.n_words FROM s JOIN g USING (k, gram)
), win AS (SELECT *, unnest(range(0, greatest(1, n - m + 1))) AS start FROM pairs
), "both" AS (
  SELECT win.doc_id, win.item_id, win.n_words, win.start, win.m, least(win.m, win.n) AS a, s.gram, count(*) AS c
  FROM win JOIN s ON s.doc_id = win.doc_id AND s.k = win.k AND s.p >= win.start AND s.p < win.start + win.m GROUP BY ALL
), sim AS (
  SELECT b.doc_id, b.item_id, b.n_words, b.start, sum(least(b.c, g.c)) / (any_value(b.a) + any_value(b.m) - sum(least(b.c, g.c))) AS similarity
  FROM "both" b JOIN g ON g.item_id = b.item_id AND g.gram = b.gram GROUP BY ALL
), best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) AS r FROM sim WHERE similarity >= 0.8)
SELECT doc_id, item_id, CAST(start AS INT) AS start, CAST(n_words AS INT) AS n_words, CAST(similarity AS DOUBLE) AS similarity FROM best WHERE r = 1
"""


def op2_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    tokens.write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer_path(), end_id=1)
    out = durable(tokens.read_token_files(spark, folder))
    remove_folder(spark, folder)
    return out


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(table(spark, sf_dir, "documents"))


OP3_SQL = """
WITH l AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), each AS (
  SELECT doc_id, i, lines[i] AS line, trim(lines[i], ' ' || chr(9) || chr(13)) AS t FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM l)
), f AS (
  SELECT doc_id, i, t, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM each WHERE t <> ''
), w AS (
  SELECT a.doc_id, a.k, a.t AS x, b.t AS y, c.t AS z, a.i AS lo, c.i AS hi
  FROM f a JOIN f b ON a.doc_id = b.doc_id AND b.k = a.k + 1 JOIN f c ON a.doc_id = c.doc_id AND c.k = a.k + 2
), r AS (
  SELECT *, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, k) AS nth FROM w
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(lo, hi + 1)) AS i FROM r WHERE nth > 1
), b AS (
  SELECT each.doc_id, each.i, each.line, gone.i IS NULL AS stays FROM each LEFT JOIN gone ON gone.doc_id = each.doc_id AND gone.i = each.i
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '') AS text,
       CAST(count(*) AS INT) AS n_lines, CAST(count(*) FILTER (NOT stays) AS INT) AS n_removed
FROM b GROUP BY doc_id
"""


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)


def _crc32_sql(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8 bytes: a byte's change of the register is the sum of its eight bits' changes."""
    step = "a >> 8"
    for k in range(8):
        change = 1 << k
        for _ in range(8):
            change = (change >> 1) ^ (0xEDB88320 if change & 1 else 0)
        step = f"xor({step}, ((xor(a, b) >> {k}) & 1) * {change})"
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), lambda a, b: {step}), 4294967295)"


#: Running bytes in id order; each boundary is the row edge nearest to its share, the lower of two.
OP4_SQL = f"""
WITH d AS (
  SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) + 8 AS BIGINT) AS size, CAST({_crc32_sql("coalesce(text, '')")} AS BIGINT) AS text_crc32 FROM documents
), r AS (SELECT *, CAST(sum(size) OVER (ORDER BY doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS before FROM d
), e AS (SELECT before AS edge FROM r UNION ALL SELECT CAST(sum(size) AS BIGINT) FROM d
), g AS (SELECT j, ((SELECT sum(size) FROM d) * j + {SHARDS} - 1) // {SHARDS} AS goal FROM (SELECT unnest(range(1, {SHARDS})) AS j)
), b AS (SELECT arg_min(edge, abs(edge - goal) * 2 + CASE WHEN edge > goal THEN 1 ELSE 0 END) AS bound FROM g, e GROUP BY j
), s AS (SELECT r.*, CAST((SELECT count(*) FROM b WHERE b.bound <= r.before) AS INT) AS shard FROM r)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST) - 1 AS slot, CAST(NULL AS INT) AS grown_shard FROM s
"""


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


#: The production mix: four domains by the number in the source's name, weighted 4 to 1; English before the other languages.
MIX_SEED, MIX_EPOCHS = 20, 2


def mix_levels() -> list[mixing.Level]:
    number = F.expr("cast(coalesce(nullif(regexp_extract(source, '([0-9]+)$', 1), ''), '0') as bigint) % 4")
    return [
        mixing.Level("domain", F.concat(F.lit("domain"), number), F.expr("case domain when 'domain0' then 4 when 'domain1' then 3 when 'domain2' then 2 else 1 end")),
        mixing.Level("lang", F.col("lang"), F.expr("case lang when 'en' then 3 else 1 end")),
        mixing.Level("source", F.col("source"), F.lit(1)),
    ]


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = mixing.mix(docs, mix_levels(), F.col("total"), seed=MIX_SEED, max_epochs=MIX_EPOCHS)
    return out.select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")


OP6_SQL = """
WITH d AS (
  SELECT doc_id, 'domain' || (CAST(coalesce(nullif(regexp_extract(source, '([0-9]+)$', 1), ''), '0') AS BIGINT) % 4) AS domain,
         lang, source, len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')) AS n_tokens FROM documents
), leaf AS (
  SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) * 2 AS BIGINT) AS cap FROM d GROUP BY ALL
), n1 AS (
  SELECT domain, CAST(sum(cap) AS BIGINT) AS cap, CASE domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END AS w,
         least((SELECT sum(tokens) FROM leaf), sum(sum(cap)) OVER ()) AS amount FROM leaf GROUP BY domain
), s1 AS (
  SELECT *, sum(cap) OVER (ORDER BY cap / w, cap, domain ROWS UNBOUNDED PRECEDING) - cap AS before,
         sum(w) OVER (ORDER BY cap / w, cap, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM n1
), f1 AS (SELECT *, cap * rest <= (amount - before) * w AS full_ FROM s1
), a1 AS (
  SELECT domain, CASE WHEN full_ THEN cap ELSE ((amount - sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER ()) * w) // sum(CASE WHEN full_ THEN 0 ELSE w END) OVER () END AS alloc FROM f1
), n2 AS (
  SELECT l.domain, l.lang, CAST(sum(l.cap) AS BIGINT) AS cap, CASE l.lang WHEN 'en' THEN 3 ELSE 1 END AS w, least(any_value(a1.alloc), sum(sum(l.cap)) OVER (PARTITION BY l.domain)) AS amount
  FROM leaf l JOIN a1 USING (domain) GROUP BY l.domain, l.lang
), s2 AS (
  SELECT *, sum(cap) OVER (PARTITION BY domain ORDER BY cap / w, cap, lang ROWS UNBOUNDED PRECEDING) - cap AS before,
         sum(w) OVER (PARTITION BY domain ORDER BY cap / w, cap, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM n2
), f2 AS (SELECT *, cap * rest <= (amount - before) * w AS full_ FROM s2
), a2 AS (
  SELECT domain, lang, CASE WHEN full_ THEN cap ELSE ((amount - sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER (PARTITION BY domain)) * w) // sum(CASE WHEN full_ THEN 0 ELSE w END) OVER (PARTITION BY domain) END AS alloc FROM f2
), n3 AS (
  SELECT l.*, least(a2.alloc, sum(l.cap) OVER (PARTITION BY l.domain, l.lang)) AS amount FROM leaf l JOIN a2 USING (domain, lang)
), s3 AS (
  SELECT *, sum(cap) OVER (PARTITION BY domain, lang ORDER BY cap, source ROWS UNBOUNDED PRECEDING) - cap AS before,
         count(*) OVER (PARTITION BY domain, lang ORDER BY cap, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM n3
), f3 AS (SELECT *, cap * rest <= (amount - before) AS full_ FROM s3
), a3 AS (
  SELECT domain, lang, source, tokens, CAST(CASE WHEN full_ THEN cap ELSE (amount - sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER (PARTITION BY domain, lang)) // sum(CASE WHEN full_ THEN 0 ELSE 1 END) OVER (PARTITION BY domain, lang) END AS BIGINT) AS alloc FROM f3
), p AS (
  SELECT d.*, CASE WHEN tokens > 0 THEN alloc // tokens ELSE 0 END AS epochs, alloc - CASE WHEN tokens > 0 THEN alloc // tokens ELSE 0 END * tokens AS left_ FROM d JOIN a3 USING (domain, lang, source)
), c AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('20:' || epochs || ':' || doc_id)) AS cum FROM p
), t AS (SELECT *, epochs + CASE WHEN left_ > 0 AND cum <= left_ THEN 1 ELSE 0 END AS times FROM c)
SELECT doc_id, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(unnest(range(0, times)) AS INT) AS epoch FROM t WHERE times > 0
"""


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, radius=3)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END")  # every seventh id's label is moved on by one
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), label=label, anchors=F.col("id") % 100 == 0)


OP11_SQL = """
WITH e AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.id AS anchor_id, a.label AS anchor_label, b.id, b.label, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.v, b.v)]) AS BIGINT) AS score
  FROM e a JOIN e b ON a.id % 100 = 0 AND b.id <> a.id
), p AS (
  SELECT anchor_id, anchor_label, id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), n AS (
  SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INT) AS rank, id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label AND 80 * positive_score <= 100 * score AND score <= positive_score
)
SELECT * FROM n WHERE rank <= 5
"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Every order replayed over the documents' failures: the first failing filter of the order removes a document.
OP12_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+') AS w FROM documents
), m AS (SELECT text, min(doc_id) AS least_id FROM d GROUP BY text
), l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS q, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS t FROM labels GROUP BY doc_id
), f AS (
  SELECT d.part, coalesce(l.q, 0) AS q, coalesce(l.t, 0) AS t,
    (CASE WHEN len(w) < 50 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 5 * length(d.text) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(d.text, '[#$%&*|]') THEN 'D' ELSE '' END) || (CASE WHEN d.doc_id > m.least_id THEN 'E' ELSE '' END) AS fails
  FROM d JOIN m USING (text) LEFT JOIN l USING (doc_id)
), g AS (SELECT part, fails, count(*) AS n, sum(q) AS q, sum(t) AS t FROM f GROUP BY ALL
), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a JOIN x b ON b.x <> a.x JOIN x c ON c.x NOT IN (a.x, b.x) JOIN x d ON d.x NOT IN (a.x, b.x, c.x)
  JOIN x e ON e.x NOT IN (a.x, b.x, c.x, d.x)
), s AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o
), r AS (
  SELECT g.part, s.filter_order, s.step, g.n, g.q, g.t, g.fails, filter_order[step] AS own, contains(g.fails, filter_order[step]) AS failing,
    length(translate(filter_order[1 : step - 1], fails, '')) < step - 1 AS gone
  FROM g CROSS JOIN s
), c AS (
  SELECT part, filter_order, step, any_value(own) AS own, sum(CASE WHEN gone OR failing THEN 0 ELSE n END) AS kept, sum(CASE WHEN failing AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN failing AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN failing AND NOT gone THEN q ELSE 0 END) AS good_lost, sum(CASE WHEN failing AND NOT gone THEN t ELSE 0 END) AS toxic_lost
  FROM r GROUP BY part, filter_order, step
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM c
"""


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_token_binary": op2_token_binary,
    "op3_line_dedup": op3_line_dedup,
    "op4_shards": op4_shards,
    "op5_neighbours": op5_neighbours,
    "op6_mixing": op6_mixing,
    "op7_language": op7_language,
    "op8_toxicity": op8_toxicity,
    "op9_quality": op9_quality,
    "op10_simhash": op10_simhash,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_filter_audit": op12_filter_audit,
    "op13_personal_data": op13_personal_data,
}

ORACLE_SQL: dict[str, str] = {"op1_decontamination": OP1_SQL, "op3_line_dedup": OP3_SQL, "op4_shards": OP4_SQL, "op6_mixing": OP6_SQL, "op11_hard_negatives": OP11_SQL, "op12_filter_audit": OP12_SQL}
