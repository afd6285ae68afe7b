"""SQL (DuckDB) that gives the rows of the registered queries. Written apart from the DataFrame plans; only fixed values are shared."""

from __future__ import annotations

from ..functions import fixed


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def has(col: str, pattern: str, flags: str = "") -> str:
    return f"regexp_matches({col}, {q(pattern)}, {q(flags or 'c')})"


def n_of(col: str, pattern: str, flags: str = "") -> str:
    return f"len(regexp_extract_all({col}, {q(pattern)}, 0, {q(flags or 'c')}))"


def words(col: str) -> str:
    return f"list_filter(regexp_split_to_array({col}, '\\s+'), lambda w: w <> '')"


def case(rules: list[tuple[str, str]], other: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in rules) + f" ELSE {other} END"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def normal(x: str) -> str:
    x = f"regexp_replace({x}, '[\\x00-\\x08\\x0b-\\x1f\\x7f-\\x{{9f}}\\p{{Cf}}]', '', 'g')"
    return strip(f"regexp_replace(regexp_replace({x}, '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')")


def tags(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"


LETTERS, DIGITS = r"\p{L}", r"\p{Nd}"


def clamp(x: str, a: float, b: float) -> str:
    return f"greatest({a}::DOUBLE, least({b}::DOUBLE, {x}))"


def hits(col: str, patterns: list[tuple[str, bool]]) -> str:
    return "(" + " + ".join(f"CAST({has(col, p, 'i' if i else '')} AS INT)" for p, i in patterns) + ")"


def quality(t: str) -> str:
    b = fixed.QUALITY_BOUNDS
    n, c = f"greatest(len({words(t)}), 1)", f"greatest(length({t}), 1)"
    s = (
        f"0.5::DOUBLE - CASE WHEN {n} > {b['words'][1]} THEN 0.1::DOUBLE ELSE 0 END - CASE WHEN length(array_to_string({words(t)}, '')) / {n} BETWEEN {b['word_length'][0]} AND {b['word_length'][1]} THEN 0 ELSE 0.15::DOUBLE END"
        f" - CASE WHEN len(list_distinct({words(f'lower({t})')})) / {n} < {b['unique']} THEN 0.2::DOUBLE ELSE 0 END - CASE WHEN {n_of(t, DIGITS)} / {c} > {b['digits']} THEN 0.1::DOUBLE ELSE 0 END"
        f" - CASE WHEN {n_of(t, LETTERS)} / {c} < {b['letters']} THEN 0.15::DOUBLE ELSE 0 END"
        f" + 0.05::DOUBLE * {hits(t, [(p, True) for p in fixed.QUALITY_REWARDS])} - 0.08::DOUBLE * {hits(t, [(p, True) for p in fixed.QUALITY_PENALTIES])}"
    )
    return f"CASE WHEN {n} < {b['words'][0]} THEN 0.1::DOUBLE ELSE {clamp(s, 0.05, 1.0)} END"


def url_type(u: str) -> str:
    return case([(has(u, p), q(t)) for p, t in fixed.URL_TYPES], "'unknown'")


def text_type(t: str) -> str:
    n = f"greatest(len({words(t)}), 1)"
    return case([(f"{n_of(t, p, 'i' if i else '')} / {n} >= {least}", q(k)) for p, i, k, least in fixed.TEXT_TYPES], "'unknown'")


def type_weight(k: str) -> str:
    return case([(f"{k} = {q(t)}", f"{w}::DOUBLE") for t, w in fixed.TYPE_WEIGHTS.items()], f"{fixed.TYPE_WEIGHTS['unknown']}::DOUBLE")


def reclass(t: str) -> str:
    low = f"lower({t})"
    return case([("(" + " + ".join(f"CAST(contains({low}, {q(k)}) AS INT)" for k in keys) + ") >= 2", q(kind)) for keys, kind in fixed.TYPE_KEYWORDS], "'unknown'")


def excluded(t: str) -> str:
    parts = [f"CASE WHEN {' OR '.join(has(t, p, 'is') for p in ps)} THEN {q(tag)} END" for tag, ps in sorted(fixed.EXCLUSIONS.items())]
    return f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL)"


URL_PATH = r"regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
CODE = case([(f"ends_with(lower({URL_PATH}), {q(e)})", q(n)) for e, n in fixed.CODE_LANGUAGES.items()], "''")
BUCKET = "(CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) % 1000000)"
PART = f"CASE WHEN {BUCKET} < 50000 THEN 'val' ELSE 'train' END"
CLEANED = normal(tags("text"))
REFUSAL = f"(({n_of('t', r'\ball rights reserved\b', 'i')} + {n_of('t', r'\bwith the\b', 'i')}) * 1.0::DOUBLE / greatest(len({words('t')}), 1))"
CLEAN_CTE = f"""
WITH a AS (SELECT doc_id AS seq, CAST(doc_id AS VARCHAR) AS doc_id, source, lang, text AS raw, {CLEANED} AS t FROM documents),
g AS (SELECT *, CASE WHEN length(t) < 200 THEN 'too_short' WHEN length(t) > 200000 THEN 'too_long' END AS gate FROM a),
r AS (SELECT *, gate IS NULL AND row_number() OVER (PARTITION BY t, gate IS NULL ORDER BY seq) > 1 AS again FROM g),
s AS (SELECT *, CASE WHEN gate IS NOT NULL OR again THEN 0.0::DOUBLE ELSE {REFUSAL} END AS score FROM r),
c AS (SELECT *, CASE WHEN gate IS NOT NULL THEN gate WHEN again THEN 'duplicate' WHEN score >= 0.004 THEN 'dropped' ELSE 'kept' END AS action FROM s)
"""
VISITS = "WITH v AS (SELECT user_id AS domain, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq, event_id, CAST(floor(value * 100) AS BIGINT) % 100 / 100.0::DOUBLE AS score FROM events)"
GATE = VISITS + """,
m AS (SELECT *, avg(score) OVER (PARTITION BY domain ORDER BY seq ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS signal FROM v),
x AS (SELECT *, min(CASE WHEN seq >= 10 AND signal < 0.45 THEN seq END) OVER (PARTITION BY domain) AS stop FROM m),
kept AS (SELECT * FROM x WHERE stop IS NULL OR seq <= stop)
"""
TRIGRAMS = r"""
WITH t AS (SELECT doc_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{Nd}_]+') AS w FROM documents),
s AS (SELECT id, list_sort(list_distinct(CASE WHEN len(w) < 3 THEN w ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS g FROM t),
one AS (SELECT min(id) AS id, g FROM s WHERE len(g) > 0 GROUP BY g),
e AS (SELECT id, len(g) AS n, unnest(g) AS gram FROM one),
i AS (SELECT a.id AS a, b.id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS k FROM e a JOIN e b ON a.gram = b.gram AND a.id < b.id GROUP BY a.id, b.id)
"""
UNIT = "WITH u AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), n AS (SELECT vec_id, list_transform(v, lambda x: x / greatest(sqrt(list_dot_product(v, v)), 1e-10)) AS v FROM u)"
WEIGHTED = f"WITH d AS (SELECT doc_id, text, {quality('text')} AS quality, {text_type('text')} AS kind FROM documents), w AS (SELECT doc_id, {type_weight('kind')} * quality AS final_weight FROM d)"
SOURCE_FACTS = """WITH f AS (SELECT o_custkey % 97 AS k, sum(CAST(o_orderstatus = 'F' AS INT)) AS documents, sum(CAST(o_orderstatus = 'O' AND o_totalprice > 200000 AS INT)) AS errors,
sum(CAST(o_orderstatus = 'P' AS INT)) AS limited, sum(CAST(o_orderstatus = 'O' AS INT)) AS skipped FROM orders GROUP BY 1),
g AS (SELECT k, CASE WHEN k % 4 = 1 THEN 0 ELSE documents END AS documents, CASE WHEN k % 3 = 0 THEN errors ELSE 0 END AS errors, skipped, CASE WHEN k % 5 = 2 THEN limited ELSE 0 END AS limited FROM f)"""
RUNS = "SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS experiment_id, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS started_at FROM orders"
METRICS = "SELECT event_id AS id, event_type AS metric_name, CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_id // 3 END AS step, round(value, 6) AS metric_value FROM events"
TITLE = strip("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")
SOURCES = """WITH d AS (SELECT doc_id, 'web' AS kind, source AS identifier, 'r1' AS revision, lang AS license, sha256(text) AS h, CASE WHEN doc_id % 9 = 0 THEN 'other' ELSE 'text' END AS dataset_group FROM documents),
m AS (SELECT kind, identifier, arg_min(revision, doc_id) AS revision, arg_min(license, doc_id) AS license, arg_min(h, doc_id) AS raw_source_sha256, dataset_group FROM d GROUP BY kind, identifier, dataset_group) """
SIGNAL_BASE = case([(f"u = {q(t)}", f"{s}::DOUBLE") for t, s in fixed.SIGNAL_BASE.items()], "0.4::DOUBLE")

DRAW = "(CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)"
DOMAIN = lambda what: case([("true" if p == "*" else f"contains(d, {q(p)})" + (f" OR ends_with(d, {q(p[1:])})" if p.startswith("*") else ""), what(w, c)) for p, w, c in fixed.DOMAIN_WEIGHTS], "NULL")
DECIDED = f"""
WITH d AS (SELECT doc_id AS seq, text, CASE WHEN doc_id % 19 = 0 THEN 'again' ELSE CAST(doc_id AS VARCHAR) END AS id, {excluded('text')} AS tags, {quality('text')} AS quality FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS n FROM d),
x AS (SELECT seq, CASE WHEN n > 1 THEN 'duplicate_document_id' WHEN seq % 17 = 0 THEN 'dataset_group_mismatch' WHEN seq % 13 = 0 THEN 'unsupported_source' WHEN len(tags) > 0 THEN array_to_string(tags, ',')
  WHEN NOT (len({words('text')}) >= 30 AND quality >= 0.35) THEN 'quality_gate' WHEN CASE WHEN seq % 5 = 0 THEN seq % 11 = 0 ELSE seq % 7 = 0 END THEN 'missing_source_identity' ELSE 'accepted' END AS reason FROM r)
"""
RESOLVE = """
, d AS (SELECT *, row_number() OVER (ORDER BY id) AS r FROM nb),
st AS (
  SELECT CAST(0 AS BIGINT) AS r, CAST([] AS STRUCT(rep BIGINT, founder BIGINT, w DOUBLE)[]) AS slots
  UNION ALL
  SELECT r, CASE WHEN k IS NULL OR k = 0 THEN list_append(slots, {{'rep': id, 'founder': id, 'w': w}})
    WHEN w > slots[k].w THEN list_concat(list_concat(slots[1 : k - 1], [{{'rep': id, 'founder': slots[k].founder, 'w': w}}]), slots[k + 1 :]) ELSE slots END
  FROM (SELECT d.r, d.id, d.w, st.slots, {place} AS k FROM st JOIN d ON d.r = st.r + 1)
), fin AS (SELECT unnest(slots) AS s FROM st WHERE r = (SELECT max(r) FROM st))
"""
CRAWL_HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1))"


def crawl(depth: int, cap: int) -> str:
    """Depth by depth: links of what was fetched, unseen, on a page that is there, up to a cap for each host."""
    out = [
        f"WITH p AS (SELECT page_id, url FROM pages), k AS (SELECT a.url AS src, regexp_replace(b.url, '#.*$', '') AS url FROM p a JOIN p b ON b.page_id IN (a.page_id * 2 + 1, a.page_id * 3) WHERE regexp_matches(b.url, '^https?://')),"
        f" s0 AS (SELECT url, 0 AS crawl_depth FROM (SELECT url, row_number() OVER (PARTITION BY {CRAWL_HOST} ORDER BY url) AS n FROM (SELECT DISTINCT url FROM p WHERE regexp_matches(url, '^http://[^?#]*$'))) WHERE n <= {cap})"
    ]
    for d in range(1, depth + 1):
        out.append(
            f"c{d} AS (SELECT DISTINCT k.url FROM k JOIN s{d - 1} l ON l.url = k.src AND l.crawl_depth = {d - 1} WHERE k.url IN (SELECT url FROM p) AND k.url NOT IN (SELECT url FROM s{d - 1})),"
            f" n{d} AS (SELECT url, {CRAWL_HOST} AS h, row_number() OVER (PARTITION BY {CRAWL_HOST} ORDER BY url) AS n FROM c{d}),"
            f" s{d} AS (SELECT * FROM s{d - 1} UNION ALL SELECT n.url, {d} FROM n{d} n WHERE n.n + (SELECT count(*) FROM (SELECT {CRAWL_HOST} AS h FROM s{d - 1}) o WHERE o.h = n.h) <= {cap})"
        )
    return ", ".join(out) + f" SELECT url, CAST(crawl_depth AS INT) AS crawl_depth FROM s{depth}"


SQL: dict[str, str] = {
    "corpus_summary": f"""
WITH a AS (SELECT doc_id AS seq, source, lang, {CLEANED} AS t FROM documents), g AS (SELECT * FROM a WHERE length(t) BETWEEN 200 AND 200000),
r AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY seq) AS n FROM g), s AS (SELECT source, lang, len({words('t')}) AS words, {quality('t')} AS quality FROM r WHERE n = 1)
SELECT source, lang, count(*) AS docs, CAST(sum(words) AS BIGINT) AS words, sum(CAST(round(quality * 100) AS BIGINT)) / count(*) / 100 AS mean_quality, sum(CAST(round(quality * 100) AS BIGINT)) * 80 / 10000 AS total_weight FROM s GROUP BY source, lang""",
    "text_metrics": f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(len({words('text')}) AS INT) AS words, CAST(length(text) AS INT) AS chars, CAST(len(list_distinct({words('lower(text)')})) AS INT) AS unique_words, CAST({n_of('text', LETTERS)} AS INT) AS letters, CAST({n_of('text', DIGITS)} AS INT) AS digits FROM documents",
    "clean_kept": CLEAN_CTE + "SELECT doc_id, action AS clean_action, round(score, 6) AS clean_score, action = 'kept' AS kept, md5(t) AS text_md5 FROM c",
    "clean_outcomes": CLEAN_CTE + "SELECT action AS clean_action, count(*) AS n FROM c GROUP BY action",
    "redact": CLEAN_CTE + r"SELECT doc_id, md5(regexp_replace(t, '\ball rights reserved\b|\bwith the\b', '[REMOVED]', 'gi')) AS text_md5 FROM c WHERE action = 'dropped'",
    "exact_dedup_clean": CLEAN_CTE + "SELECT doc_id FROM r WHERE gate IS NULL AND NOT again",
    "exact_dedup_normalized": f"SELECT CAST(min(doc_id) AS VARCHAR) AS doc_id FROM documents GROUP BY array_to_string({words('lower(text)')}, ' ')",
    "html_strip_pages": f"SELECT page_id, md5({normal(tags('html'))}) AS text_md5 FROM pages",
    "page_documents": f"""
WITH p AS (SELECT sha256(url) AS doc_id, url, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS domain, {TITLE} AS title, {url_type('url')} AS u, md5({normal(tags('html'))}) AS text_md5 FROM pages)
SELECT doc_id, url, domain, title, CASE WHEN u <> 'unknown' THEN u ELSE 'html' END AS content_type, text_md5 FROM p""",
    "near_dup_pairs": TRIGRAMS + "SELECT a, b, round(k / (n + m - k), 6) AS similarity FROM i WHERE k >= 0.8 * (n + m - k) UNION ALL SELECT one.id, s.id, 1.0 FROM s JOIN one ON one.g = s.g WHERE s.id <> one.id",
    "near_dup_resolve": TRIGRAMS.replace("WITH t AS", "WITH RECURSIVE t AS", 1) + """, c AS (SELECT s.id, one.id AS head, len(s.g) AS n FROM s JOIN one ON one.g = s.g),
near AS (SELECT a AS x, b AS y FROM i WHERE k >= 0.92 * (n + m - k) UNION ALL SELECT b, a FROM i WHERE k >= 0.92 * (n + m - k) UNION ALL SELECT id, id FROM one),
nb AS (SELECT c.id, (c.id % 7) / 7.0::DOUBLE AS w, list(o.id) AS nb FROM c JOIN near ON near.x = c.head JOIN c o ON o.head = near.y WHERE o.id <> c.id GROUP BY c.id)
""" + RESOLVE.format(place="list_position(list_transform(st.slots, lambda x: list_contains(d.nb, x.rep)), true)") + "SELECT s.rep AS seq, s.founder AS slot FROM fin UNION ALL SELECT doc_id, doc_id FROM documents WHERE doc_id NOT IN (SELECT id FROM nb)",
    "embedding_dedup_resolve": UNIT.replace("WITH u AS", "WITH RECURSIVE u AS", 1) + """, near AS (SELECT a.vec_id AS x, b.vec_id AS y, list_dot_product(a.v, b.v) AS s FROM n a JOIN n b ON a.vec_id <> b.vec_id WHERE list_dot_product(a.v, b.v) >= 0.4 - 1e-6),
nb AS (SELECT x AS id, (x % 5) / 5.0::DOUBLE AS w, list(y) AS ys, list(s) AS ss FROM near GROUP BY x)
""" + RESOLVE.format(place="CASE WHEN len(st.slots) > 0 AND list_max(list_transform(st.slots, lambda x: coalesce(d.ss[list_position(d.ys, x.rep)], -1.0))) > 0 THEN list_position(list_transform(st.slots, lambda x: coalesce(d.ss[list_position(d.ys, x.rep)], -1.0)), list_max(list_transform(st.slots, lambda x: coalesce(d.ss[list_position(d.ys, x.rep)], -1.0)))) END") + "SELECT s.rep AS seq FROM fin UNION ALL SELECT vec_id FROM embeddings WHERE vec_id NOT IN (SELECT id FROM nb)",
    "crawl_replay": crawl(2, 3),
    "weight_resample": WEIGHTED + f""", k AS (SELECT doc_id, round(final_weight * 4, 6) AS w, {DRAW} AS u FROM w),
c AS (SELECT doc_id, CASE WHEN w < 1 THEN CAST(u < w AS INT) ELSE greatest(CAST(floor(w) AS INT), 1) + CAST(w > floor(w) AND u < w - floor(w) AS INT) END AS n FROM k)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(unnest(range(0, n)) AS INT) AS copy FROM c WHERE n > 0""",
    "weighter_totals": WEIGHTED + f", k AS (SELECT round(final_weight * 4, 6) AS w, {DRAW} AS u FROM w) SELECT count(*) AS docs_in, count(*) FILTER (w >= 1 OR u < w) AS docs_out, round(sum(w), 4) AS total_weight, round(sum(w) / count(*), 6) AS avg_weight, round(count(*) FILTER (w >= 1 OR u < w) / count(*), 6) AS expansion FROM k",
    "final_weight_pages": f"""
WITH p AS (SELECT sha256(url) AS doc_id, CAST('0x' || substr(sha256(url), 1, 4) AS INT) AS n FROM pages),
k AS (SELECT doc_id, ['github.com', 'x.github.com', 'export.arxiv.org', 'huggingface.co', 'a.org'][n % 5 + 1] AS d, ['source_code', 'research_paper', 'blog_post'][n % 3 + 1] AS t, ['python', 'java', 'cobol', ''][n % 4 + 1] AS l FROM p)
SELECT doc_id, round({DOMAIN(lambda w, c: f"{w}::DOUBLE")} * {type_weight('t')} * CASE WHEN t = 'source_code' AND l <> '' THEN {case([(f"l = {q(k)}", f"{w}::DOUBLE") for k, w in fixed.CODE_WEIGHTS.items()], f"{fixed.CODE_WEIGHTS['unknown']}::DOUBLE")} ELSE 1 END * 0.5, 8) AS final_weight, {DOMAIN(lambda w, c: q(c))} AS category FROM k""",
    "contract_report": DECIDED + "SELECT (SELECT count(*) FROM x) AS rows, (SELECT count(*) FROM x WHERE reason = 'accepted') AS accepted, (SELECT count(*) FROM x WHERE reason <> 'accepted') AS rejected, (SELECT count(*) FROM x WHERE reason = 'accepted' AND seq % 3 <> 0) AS rights_unknown, reason, count(*) AS n FROM x WHERE reason <> 'accepted' GROUP BY reason",
    "profile_groups": "SELECT n_nationkey AS dataset_id, n_name AS profile, r_name AS group_name FROM nation JOIN region ON r_regionkey = n_regionkey",
    "record_hash": "SELECT doc_id, sha256('{\"doc_id\":' || doc_id || ',\"lang\":' || CAST(to_json(lang) AS VARCHAR) || ',\"license\":null,\"n_chars\":' || n_chars || ',\"source\":' || CAST(to_json(source) AS VARCHAR) || ',\"text\":' || CAST(to_json(text) AS VARCHAR) || '}') AS record_sha256 FROM documents",
    "source_hash": "SELECT source, count(*) AS records, sha256(string_agg('{\"doc_id\":' || doc_id || ',\"lang\":' || CAST(to_json(lang) AS VARCHAR) || ',\"license\":null,\"n_chars\":' || n_chars || ',\"source\":' || CAST(to_json(source) AS VARCHAR) || ',\"text\":' || CAST(to_json(text) AS VARCHAR) || '}' || chr(10), '' ORDER BY doc_id)) AS source_sha256 FROM documents GROUP BY source",
    "content_fold": "WITH h AS (SELECT source, doc_id // 4096 AS part, sha256(string_agg(sha256(text), '' ORDER BY doc_id)) AS h FROM documents GROUP BY 1, 2) SELECT source, sha256(string_agg(h, '' ORDER BY part)) AS content_sha256 FROM h GROUP BY source",
    "stage_throughput": "SELECT p_partkey, CASE WHEN p_retailprice - 1000 > 0 THEN round(p_size * 1000 / (p_retailprice - 1000), 3) END AS per_second FROM part",
    "dedup_totals": f"WITH k AS (SELECT count(*) AS n, count(DISTINCT array_to_string({words('lower(text)')}, ' ')) AS d FROM documents) SELECT n AS documents_in, d AS kept, n - d AS removed, round((n - d) / greatest(n, 1), 6) AS removed_share FROM k",
    "parse_files": """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'a.json' AS url, '{"doc_id":' || doc_id || ',"lang":"' || lang || '"}' || chr(10) || '{"n":' || n_chars || '}' AS text, 'structured_data' AS content_type, CAST(NULL AS VARCHAR) AS error FROM documents
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'b.csv', 'record 2' || chr(10) || 'doc_id: ' || doc_id || chr(10) || 'lang: ' || lang || chr(10) || 'column_3: a, b' || chr(10) || 'note: ' || chr(10) || chr(10) || 'record 5' || chr(10) || 'doc_id: last' || chr(10) || 'lang: x' || chr(10) || 'y' || chr(10) || 'column_3: ' || chr(10) || 'note: ', 'tabular_data', NULL FROM documents""",
    "run_manifest_metrics": "SELECT CAST(l_orderkey AS VARCHAR) AS run_id, 'line' || l_linenumber || '.quantity' AS metric_name, max(l_quantity) AS metric_value FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey, l_linenumber UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'line' || l_linenumber || '.price', max(l_extendedprice) FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey, l_linenumber",
    "run_validate": """
WITH r AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey = 1), n AS (SELECT count(*) AS runs, count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM customer)) AS lone, (SELECT count(*) FROM supplier) AS sources FROM r)
SELECT unnest(['run exists', 'experiment exists', 'dataset recorded', 'dataset manifest hashed', 'sources recorded', 'configurations recorded', 'artefacts hashed', 'artefact parents recorded', 'stages ended', 'no errors', 'checkpoints have artefacts', 'source statistics attached']) AS name,
  unnest([CASE WHEN runs = 1 THEN 'PASS' ELSE 'FAIL' END, CASE WHEN lone = 0 THEN 'PASS' ELSE 'FAIL' END, 'PASS', 'WARN', CASE WHEN sources > 0 THEN 'PASS' ELSE 'WARN' END, 'WARN', 'PASS', 'PASS', 'PASS', 'PASS', 'PASS', 'PASS']) AS status,
  unnest(['rows: ' || runs, 'runs without experiment: ' || lone, 'data sets: 1', 'without hash: 1', 'sources: ' || sources, 'configurations: 0', 'without hash: 0', 'without parent: 0', 'not ended: 0', 'errors: 0', 'without artefact: 0', 'without source: 0']) AS detail FROM n""",
    "embedding_dup_pairs": UNIT + " SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id < b.vec_id WHERE list_dot_product(a.v, b.v) >= 0.4 - 1e-6",
    "embedding_topk": UNIT + ", p AS (SELECT a.vec_id AS id, b.vec_id AS neighbour, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_dot_product(a.v, b.v) DESC, b.vec_id) AS rank FROM n a JOIN n b ON a.vec_id <> b.vec_id) SELECT id, neighbour, CAST(rank AS INT) AS rank FROM p WHERE rank <= 5",
    "classify_url": f"SELECT page_id, {url_type('url')} AS content_type FROM pages",
    "classify_text": f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, {text_type('text')} AS content_type FROM documents",
    "code_language": f"SELECT page_id, {CODE} AS code_language FROM pages",
    "reclassify": f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, {reclass('text')} AS content_type FROM documents",
    "quality_score": f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, round({quality('text')}, 6) AS quality FROM documents",
    "document_score": f"""
WITH p AS (SELECT sha256(url) AS doc_id, {url_type('url')} AS u, {normal(tags('html'))} AS t FROM pages), w AS (SELECT *, len({words('t')}) AS n, greatest(length(t), 1) AS c, {words('lower(t)')} AS l FROM p)
SELECT doc_id, round(CASE WHEN n < 30 THEN 0.1::DOUBLE ELSE {clamp(
    f"{SIGNAL_BASE} + {hits('t', fixed.SIGNAL_REWARDS)} * 0.03::DOUBLE - ({hits('t', fixed.SIGNAL_PENALTIES[:-1])} + CAST(len(list_filter(range(1, len(l) - 3), lambda i: regexp_matches(l[i], '[0-9A-Za-z_]$') AND regexp_extract(l[i], '[0-9A-Za-z_]+$') = l[i + 1] AND l[i + 1] = l[i + 2] AND l[i + 2] = l[i + 3] AND starts_with(l[i + 4], l[i + 1]))) > 0 AS INT)) * 0.08::DOUBLE"
    " + CASE WHEN n > 500 THEN 0.05::DOUBLE ELSE 0 END + CASE WHEN n > 2000 THEN 0.05::DOUBLE ELSE 0 END"
    f" - CASE WHEN {n_of('t', LETTERS)} / c < 0.5 THEN 0.1::DOUBLE ELSE 0 END - CASE WHEN len(list_distinct(l)) / n < 0.2 THEN 0.15::DOUBLE ELSE 0 END - CASE WHEN {n_of('t', DIGITS)} / c > 0.3 THEN 0.1::DOUBLE ELSE 0 END", 0.0, 1.0)} END, 6) AS score FROM w""",
    "final_weight": WEIGHTED + " SELECT CAST(doc_id AS VARCHAR) AS doc_id, round(final_weight, 6) AS final_weight FROM w",
    "signal_gate_runs": GATE + "SELECT event_id, CAST(seq AS INT) AS page_no FROM kept",
    "signal_gate": GATE + "SELECT event_id, CAST(seq AS INT) AS page_no FROM kept",
    "domain_page_cap": VISITS + " SELECT event_id, CAST(seq AS INT) AS page_no FROM v WHERE seq <= 12",
    "domain_snapshot": GATE + ", l AS (SELECT domain, arg_max(signal, seq) AS s, count(*) AS n FROM kept GROUP BY domain) SELECT domain, round(s, 6) AS avg_score, n AS count, n >= 10 AND s < 0.45 AS abandoned FROM l",
    "weight_expand_whole": WEIGHTED + ", k AS (SELECT doc_id, floor(final_weight * 4) AS n FROM w) SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(unnest(range(0, CAST(n AS BIGINT))) AS INT) AS copy FROM k WHERE n >= 1",
    "split_assignment": f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, {BUCKET} AS bucket, {PART} AS part FROM documents",
    "shard_offsets": f"""
WITH d AS (SELECT doc_id, {PART} AS part, len({words('text')}) + 1 AS n FROM documents), s AS (SELECT *, CAST(sum(n) OVER (PARTITION BY part ORDER BY doc_id) - n AS BIGINT) AS start FROM d)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, part, start, start // 50000 AS shard FROM s""",
    "shard_pieces": f"""
WITH d AS (SELECT doc_id, {PART} AS part, len({words('text')}) AS w FROM documents), e AS (SELECT doc_id, part, w + 1 AS n FROM d WHERE w > 0),
s AS (SELECT *, CAST(sum(n) OVER (PARTITION BY part ORDER BY doc_id) - n AS BIGINT) AS a FROM e), x AS (SELECT part, a, a + n AS b, unnest(range(a // 50000, (a + n - 1) // 50000 + 1)) AS shard FROM s)
SELECT part, shard, count(*) AS pieces, CAST(sum(least(b, (shard + 1) * 50000) - greatest(a, shard * 50000)) AS BIGINT) AS tokens FROM x GROUP BY part, shard""",
    "shard_windows": f"""
WITH d AS (SELECT doc_id, {PART} AS part, {words('text')} AS w FROM documents),
k AS (SELECT doc_id, part, list_concat(list_transform(w, lambda x: least(length(x), 65535)), [2]) AS k FROM d WHERE len(w) > 0),
t AS (SELECT part, doc_id, generate_subscripts(k, 1) AS i, unnest(k) AS v FROM k),
p AS (SELECT part, v, row_number() OVER (PARTITION BY part ORDER BY doc_id, i) - 1 AS pos FROM t),
s AS (SELECT part, pos // 50000 AS shard, pos % 50000 AS p, v, count(*) OVER (PARTITION BY part, pos // 50000) AS n, lead(v) OVER (PARTITION BY part, pos // 50000 ORDER BY pos) AS y FROM p)
SELECT part || '_' || lpad(CAST(shard AS VARCHAR), 5, '0') || '.bin' AS name, CAST(p // 128 * 128 AS BIGINT) AS "at", CAST(sum(v) AS INT) AS x_sum, CAST(sum(y) AS INT) AS y_sum
FROM s WHERE p // 128 * 128 + 128 < n GROUP BY part, shard, p // 128""",
    "batch_windows": f"""
WITH d AS (SELECT doc_id, {words('text')} AS w FROM documents), t AS (SELECT doc_id, list_concat(list_transform(w, lambda x: length(x)), [2]) AS k FROM d WHERE len(w) > 0),
x AS (SELECT doc_id, k, unnest(range(0, len(k) - 128, 128)) AS pos FROM t WHERE len(k) > 128)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(pos AS INT) AS "at", CAST(list_sum(k[pos + 1 : pos + 128]) AS INT) AS x_sum, CAST(list_sum(k[pos + 2 : pos + 129]) AS INT) AS y_sum FROM x""",
    "exclusion_tags": f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(array_to_string({excluded('text')}, ','), '') AS tags FROM documents",
    "exclusion_rules": f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(array_to_string({excluded('text')}, ','), '') AS tags FROM documents",
    "contract_gate": f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, len({words('text')}) >= 30 AND {quality('text')} >= 0.35 AND len({excluded('text')}) = 0 AS keep FROM documents",
    "acceptance_report": DECIDED + "SELECT reason, count(*) AS n, CAST(count(*) FILTER (seq % 3 <> 0) AS BIGINT) AS rights_unknown FROM x GROUP BY reason",
    "source_status": SOURCE_FACTS + " SELECT k, CASE WHEN k % 10 = 0 THEN 'DISABLED' WHEN limited > 0 THEN 'RATE_LIMITED' WHEN documents > 0 AND errors > 0 THEN 'PARTIAL' WHEN documents > 0 THEN 'SUCCESS' WHEN errors > 0 THEN 'FAILED' WHEN skipped > 0 THEN 'SKIPPED' ELSE 'EMPTY' END AS status FROM g",
    "http_buckets": "WITH s AS (SELECT event_id % 5 * 100 + 101 + event_id % 7 AS s FROM events) SELECT count(*) FILTER (s BETWEEN 200 AND 299) AS http_2xx, count(*) FILTER (s BETWEEN 400 AND 499) AS http_4xx, count(*) FILTER (s BETWEEN 500 AND 599) AS http_5xx FROM s",
    "stage_counts": CLEAN_CTE + f"""
SELECT (SELECT count(*) FROM documents) AS input_document_count, CAST((SELECT sum(len({words('text')})) FROM documents) AS BIGINT) AS input_word_count, count(*) AS document_count,
CAST(sum(len({words('t')})) AS BIGINT) AS word_count, (SELECT count(*) FROM documents) - count(*) AS removed_count FROM c WHERE action = 'kept'""",
    "source_licences": "SELECT source, coalesce(string_agg(DISTINCT lang, ',' ORDER BY lang), 'unknown') AS langs FROM documents GROUP BY source",
    "latest_metric": f"WITH m AS ({METRICS}), r AS (SELECT *, row_number() OVER (PARTITION BY metric_name ORDER BY step DESC NULLS LAST, id DESC) AS n FROM m) SELECT id, metric_name, step, metric_value FROM r WHERE n = 1",
    "metric_unpivot": "SELECT event_id, 'value' AS metric_name, round(value, 6) AS metric_value FROM events WHERE value IS NOT NULL UNION ALL SELECT event_id, 'user', CAST(user_id AS DOUBLE) FROM events WHERE user_id IS NOT NULL UNION ALL SELECT event_id, 'even', CAST(event_id % 2 = 0 AS INT)::DOUBLE FROM events",
    "run_search": f"WITH r AS ({RUNS}) SELECT r.id, c_name AS experiment_name, status, started_at FROM r JOIN customer ON CAST(c_custkey AS VARCHAR) = experiment_id WHERE status = 'F' ORDER BY started_at DESC, r.id LIMIT 50",
    "run_lineage_sources": "SELECT s_suppkey AS id, s_name AS identifier, CASE WHEN s_suppkey % 2 = 0 THEN CAST(floor(s_acctbal) AS BIGINT) ELSE -1 END AS fetched FROM supplier",
    "run_upsert": f"WITH r AS ({RUNS}), k AS (SELECT *, CAST(id AS BIGINT) AS n FROM r) SELECT id, CASE WHEN n % 5 = 0 AND n % 10 <> 0 THEN 'DONE' ELSE status END AS status, started_at FROM k UNION ALL SELECT 'new-' || id, 'DONE', 'later' FROM k WHERE n % 10 = 0",
    "dataset_pages": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, source FROM documents ORDER BY documents.doc_id LIMIT 30 OFFSET 20",
    "event_tail": "SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 25",
    "generation_metrics": f"""
WITH w AS (SELECT conv_id, turn, {words('text')} AS w FROM conversations),
m AS (SELECT conv_id, turn, len(w) AS n, CASE WHEN len(w) > 0 THEN len(list_distinct(w)) / len(w) ELSE 0.0::DOUBLE END AS d1,
  CASE WHEN len(w) > 1 THEN len(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || chr(1) || w[i + 1]))) / (len(w) - 1) ELSE 0.0::DOUBLE END AS d2 FROM w)
SELECT conv_id, turn, CAST(n AS INT) AS tokens, round(CASE WHEN n > 0 THEN 1 - d1 ELSE 1.0::DOUBLE END, 6) AS repetition_rate, round(d1, 6) AS distinct_1, round(d2, 6) AS distinct_2 FROM m""",
    "loss_summary": "SELECT round(avg(l_discount * 10), 6) AS loss, round(exp(least(avg(l_discount * 10), 20)), 6) AS perplexity FROM lineitem",
    "cosine_lr": "SELECT s AS step, round(CASE WHEN s < 100 THEN 0.0003::DOUBLE * s / 100 WHEN s >= 1000 THEN 0.00003::DOUBLE ELSE 0.00003::DOUBLE + 0.5 * (0.0003::DOUBLE - 0.00003::DOUBLE) * (1 + cos(pi() * (s - 100) / 900.0)) END, 12) AS lr FROM (SELECT unnest(range(0, 1001)) AS s)",
    "duration_estimate": "SELECT p_partkey, CAST(p_size * 100 // 250 + 1 AS BIGINT) AS eval_count, CAST(p_size * 100 // 500 + p_size * 100 // 250 + 1 AS BIGINT) AS checkpoint_count, round(p_size * 100 * 8 * 4 * 512 / p_retailprice + (p_size * 100 // 250 + 1) * 1.5, 3) AS duration_seconds FROM part",
    "union_sources": """
WITH u AS (SELECT 0 AS group_idx, 0 AS kind_idx, page_id AS local_seq, url AS name FROM pages UNION ALL SELECT 0, 3, doc_id, source FROM documents UNION ALL SELECT 1, 0, item_id, 'benchmark' FROM benchmark)
SELECT *, group_idx * 4503599627370496 + kind_idx * 281474976710656 + local_seq AS seq FROM u""",
    "field_text": f"SELECT conv_id, turn, md5(array_to_string(list_filter([CASE WHEN {strip('role')} <> '' THEN 'role: ' || {strip('role')} END, CASE WHEN {strip('text')} <> '' THEN 'text: ' || {strip('text')} END], lambda x: x IS NOT NULL), chr(10) || chr(10))) AS text_md5 FROM conversations",
    "source_manifest": SOURCES + "SELECT * FROM m",
    "manifest_faults": SOURCES + "SELECT kind, identifier, 'wrong group' AS fault FROM m WHERE dataset_group <> 'text' UNION ALL SELECT kind, identifier, 'missing license' FROM m WHERE coalesce(license, '') = ''",
    "run_progress": """
WITH o AS (SELECT o_orderkey, o_orderkey % 1000 AS s, o_custkey % 900 AS n, floor(o_totalprice) AS e FROM orders)
SELECT o_orderkey, CASE WHEN n > 0 THEN round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, s / n)) * 100, 2) END AS percent, CASE WHEN s > 0 THEN round(e * greatest(n - s, 0) / s, 3) END AS eta_seconds FROM o""",
    "log_redaction": "SELECT conv_id, turn, md5(replace(replace(text, 'then', '[REDACTED]'), 'the', '[REDACTED]')) AS text_md5 FROM conversations",
    "token_totals": "SELECT CASE WHEN p_partkey % 3 = 0 THEN 'val' ELSE 'train' END AS part, CAST(sum(p_size * 8 // CASE WHEN p_partkey % 2 = 0 THEN 2 ELSE 4 END) AS BIGINT) AS tokens FROM part GROUP BY 1",
}
