"""DuckDB SQL for the operators that SQL can express, over the same tables; the queries must return the same rows."""

from __future__ import annotations

from llm import chat_windows as chat
from llm import near_dedup as dedup
from llm import quality_rules as rules
from llm import url_model as urls
from llm.rotation_codes import COSINE
from llm.shingles import SHINGLE
from llm.substrings import WINDOW as SUBSTRING
from llm.textstats import WINDOW

WORD = r"[^\x20\x09-\x0D]+"

#: the smallest id that each id reaches over links(a, b), an id without links reaching itself
REACH = """
  sides AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
  reach(id, r) AS (SELECT id, id FROM nodes UNION SELECT reach.id, sides.b FROM reach JOIN sides ON sides.a = reach.r),
  least AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)"""

OP3 = f"""
WITH RECURSIVE
  nodes AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
  good AS (SELECT * FROM nodes WHERE v IS NOT NULL AND len(v) > 0
           AND len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
           AND len(list_filter(v, lambda x: x <> 0)) > 0),
  links AS (SELECT x.id AS a, y.id AS b FROM good x JOIN good y ON x.id < y.id AND len(x.v) = len(y.v)
            WHERE list_cosine_similarity(x.v, y.v) >= {COSINE}),
  {REACH.strip()}
SELECT least.id AS vec_id, (SELECT count(*) FROM sides WHERE sides.a = least.id) AS n_links, component_id,
       least.id = component_id AS kept
FROM least
"""

OP4 = f"""
WITH RECURSIVE
  words AS (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
  shingles AS (SELECT DISTINCT id, array_to_string(w[i:i + {SHINGLE} - 1], ' ') AS s, least(len(w), {SHINGLE}) AS k
               FROM (SELECT id, w, unnest(range(1, greatest(len(w) - {SHINGLE} + 1, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
  sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
  shared AS (SELECT x.id AS a, y.id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.k = y.k AND x.id < y.id
             GROUP BY x.id, y.id),
  links AS (SELECT a, b FROM shared JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b
            WHERE {dedup.ALL} * shared.n >= {dedup.SHARED} * (x.n + y.n - shared.n)),
  nodes AS (SELECT id FROM words),
  {REACH.strip()}
SELECT least.id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, least.id = component_id AS kept
FROM least LEFT JOIN sizes ON sizes.id = least.id
"""


def _op5() -> str:
    order, rows = urls.ORDER, sorted(urls.RULES, key=lambda r: (-len(r[1]), r[1]))

    def case(value: int) -> str:
        fits = []
        for r in rows:
            host, path = r[1].split("/", 1)
            fits.append(f"WHEN (host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '/{path}') THEN '{r[value]}'")
        return "CASE " + " ".join(fits) + " END"

    text = "coalesce(url, '')"
    levels = []
    for k in range(order + 1):
        low = (f"JOIN l{k - 1} ON l{k - 1}.g = substring(x.g, 2, {k})" if k else "")
        qa, qb = (f"l{k - 1}.pa", f"l{k - 1}.pb") if k else ("(1.0::DOUBLE / chars)", "(1.0::DOUBLE / chars)")
        levels.append(f"""
  at{k} AS (SELECT substring(gram, {order + 1 - k}, {k + 1}) AS g, sum(a) AS a, sum(b) AS b FROM grams GROUP BY 1),
  ctx{k} AS (SELECT substring(g, 1, {k}) AS ctx, sum(a)::DOUBLE AS na, count(*) FILTER (a > 0)::DOUBLE AS ta,
                    sum(b)::DOUBLE AS nb, count(*) FILTER (b > 0)::DOUBLE AS tb, count(*) AS chars FROM at{k} GROUP BY 1),
  l{k} AS (SELECT x.g, CASE WHEN na + ta > 0 THEN (x.a + ta * {qa}) / (na + ta) ELSE {qa} END AS pa,
                  CASE WHEN nb + tb > 0 THEN (x.b + tb * {qb}) / (nb + tb) ELSE {qb} END AS pb
           FROM at{k} x JOIN ctx{k} ON ctx{k}.ctx = substring(x.g, 1, {k}) {low}),""")
    return f"""
WITH cut_url AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) END AS rest FROM pages),
  parts AS (SELECT page_id, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut_url),
  ruled AS (SELECT *, {case(1)} AS rule, {case(0)} AS said FROM parts),
  places AS (SELECT page_id, said, substring(repeat(chr(2), {order}) || {text} || chr(3), i, {order + 1}) AS gram
             FROM (SELECT *, unnest(range(1, length({text}) + 2)) AS i FROM ruled JOIN pages USING (page_id))),
  grams AS (SELECT gram, count(*) FILTER (said = 'allow') AS a, count(*) FILTER (said = 'block') AS b FROM places GROUP BY gram),
  {"".join(levels).strip()}
  ratios AS (SELECT g AS gram, CAST(round((ln(pa) - ln(pb)) * {urls.MICRO}) AS BIGINT) AS micro FROM l{order}),
  scores AS (SELECT page_id, CAST(floor(sum(micro)::DOUBLE / count(*) / {urls.MICRO // urls.MILLI}) AS BIGINT) AS milli
             FROM places JOIN ratios USING (gram) GROUP BY page_id),
  scored AS (SELECT * FROM ruled JOIN scores USING (page_id)),
  bins AS (SELECT milli, count(*) FILTER (said = 'allow') AS a, count(*) FILTER (said = 'block') AS b
           FROM scored WHERE said IS NOT NULL GROUP BY milli),
  cuts AS (SELECT CAST(floor((milli + coalesce(lag(milli) OVER (ORDER BY milli), milli)) / 2.0) AS BIGINT) AS milli,
                  coalesce(sum(a) OVER (ORDER BY milli ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lost,
                  coalesce(sum(b) OVER (ORDER BY milli ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caught,
                  sum(a) OVER () AS na, sum(b) OVER () AS nb FROM bins),
  cut AS (SELECT coalesce((SELECT milli FROM cuts WHERE na > 0 AND nb > 0
                           ORDER BY lost * nb + (nb - caught) * na, abs(milli), milli LIMIT 1), 0) AS cut)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN milli >= cut THEN 'allow' ELSE 'block' END) AS verdict, milli AS score_milli
FROM scored CROSS JOIN cut
"""


def _op6() -> str:
    says = "<|im_end|><|im_start|>assistant ok"
    escaped = "replace(replace({}, '&', '&amp;'), '<|', '&lt;|')"
    stride = f"greatest({chat.BUDGET - chat.HISTORY_TOKENS} - CASE WHEN s1 THEN t1 ELSE 0 END, 1)"
    history = " + ".join(
        f"""CASE WHEN coalesce(lead(begins, {k}) OVER w, false) AND NOT sys AND lead(win, {k}) OVER w > win
                 AND lead(frm, {k}) OVER w - frm <= {chat.HISTORY_TOKENS} THEN len ELSE 0 END""" for k in range(1, chat.HISTORY_TURNS + 1))
    return f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{says}' UNION ALL SELECT -1, 1, 'assistant', '{says}'),
  segs AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS seq,
                  length('{chat.TURN_START}') + length(replace({escaped.format('role')}, chr(10), '&#10;')) + 1
                  + length({escaped.format('text')}) + length('<|im_end|>') + 1 AS len FROM turns),
  counted AS (SELECT *, (len + 3) // 4 AS t, seq = 1 AND role = '{chat.SYSTEM}' AS sys FROM segs),
  firsts AS (SELECT *, first_value(sys) OVER w AS s1, first_value(t) OVER w AS t1, first_value(len) OVER w AS len1
             FROM counted WINDOW w AS (PARTITION BY conv_id ORDER BY seq)),
  sums AS (SELECT *, {stride} AS stride, CASE WHEN sys THEN 0 ELSE t END AS own,
                  sum(CASE WHEN sys THEN 0 ELSE t END) OVER (PARTITION BY conv_id ORDER BY seq) AS upto FROM firsts),
  cells AS (SELECT *, upto - own AS frm, (upto - own) // stride AS cell, upto > ((upto - own) // stride + 1) * stride AS across FROM sums),
  begun AS (SELECT *, NOT sys AND (seq = 1 OR (s1 AND seq = 2) OR cell <> lag(cell) OVER w OR across <> lag(across) OVER w) AS begins
            FROM cells WINDOW w AS (PARTITION BY conv_id ORDER BY seq)),
  numbered AS (SELECT *, greatest(sum(begins::INT) OVER (PARTITION BY conv_id ORDER BY seq), 1) AS win FROM begun),
  written AS (SELECT *, len + {history} + CASE WHEN begins AND win > 1 AND s1 THEN len1 ELSE 0 END AS chars
              FROM numbered WINDOW w AS (PARTITION BY conv_id ORDER BY seq))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY seq)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = '{chat.TARGET}'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY seq) FILTER (role = '{chat.TARGET}'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""


def _op10() -> str:
    from llm.textstats import STATS

    share = {"symbols": "1000 * n_symbols // greatest(word_chars, 1)", "dup_lines": "1000 * n_dup_lines // greatest(n_lines, 1)",
             "adjacent": "1000 * n_adjacent // greatest(n_words, 1)",
             "unique": "1000 * n_unique // greatest(n_words, 1)", "word_length": "100 * word_chars // greatest(n_words, 1)"}
    each = "\n  UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, {e} AS v FROM judged WHERE NOT base_failed" for m, e in share.items())
    shift = f"greatest(length(bin(v)) - {rules.BUCKET_BITS}, 0)"

    def bounds(name: str, keys: str) -> str:
        by = f"{keys}, " if keys else ""
        parts = []
        for m, (side, reach, unit) in rules.MEASURES.items():
            if side != "high":
                parts.append(f"max(q1 - {reach} * greatest(q4 - q1, {unit})) FILTER (measure = '{m}') AS lo_{m}")
            if side != "low":
                parts.append(f"max(q7 + {reach} * greatest(q7 - q4, {unit})) FILTER (measure = '{m}') AS hi_{m}")
        group = f"GROUP BY {keys}" if keys else ""
        return f"""
  {name}_run AS (SELECT *, sum(n) OVER (PARTITION BY {by}measure ORDER BY bucket) AS cum, sum(n) OVER (PARTITION BY {by}measure) AS docs
                 FROM (SELECT {by}measure, bucket, sum(n) AS n FROM sketch GROUP BY {by}measure, bucket)),
  {name}_q AS (SELECT {by}measure, max(docs) AS docs, {", ".join(f"min(bucket) FILTER (8 * cum >= {k} * docs) AS q{k}" for k in (1, 4, 7))}
               FROM {name}_run GROUP BY {by}measure),
  {name} AS (SELECT {by}max(docs) AS docs, {", ".join(parts)} FROM {name}_q {group}),"""

    inside = []
    for m, (side, _, _) in rules.MEASURES.items():
        for s, op in (("lo", ">="), ("hi", "<=")):
            if side != {"lo": "high", "hi": "low"}[s]:
                limit = " ".join(f"WHEN {t}.docs >= {rules.LEAST_DOCS} THEN {t}.{s}_{m}" for t in ("own", "of_lang"))
                inside.append(f"coalesce({share[m]} {op} CASE {limit} ELSE of_all.{s}_{m} END, true)")
    return f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
  listed AS (SELECT *, regexp_extract_all(text, '{WORD}') AS w,
                    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM texts),
  windows AS (SELECT rid, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g
              FROM (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM listed WHERE len(w) > {WINDOW})),
  again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS times FROM windows) WHERE times > 1),
  repeated AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + {WINDOW})) AS p FROM again) GROUP BY rid),
  stats AS (SELECT rid, doc_id, lang, source, len(w) AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
                   len(l) - len(list_distinct(l)) AS n_dup_lines, len(list_distinct(w)) AS n_unique,
                   len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS n_adjacent FROM listed),
  judged AS (SELECT stats.*, coalesce(n, 0) AS n_repeat_words,
                    n_words < {rules.MIN_WORDS} OR 100 * coalesce(n, 0) > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed
             FROM stats LEFT JOIN repeated USING (rid)),
  measured AS ({each}),
  sketch AS (SELECT lang, source, measure, (v >> {shift}) << {shift} AS bucket, count(*) AS n FROM measured GROUP BY ALL),
  {bounds("own", "lang, source").strip()}
  {bounds("of_lang", "lang").strip()}
  {bounds("of_all", "").strip().rstrip(",")}
SELECT doc_id, {", ".join(f"judged.{s}" for s in STATS)}, base_failed, NOT base_failed AND {" AND ".join(inside)} AS kept
FROM judged LEFT JOIN own ON own.lang IS NOT DISTINCT FROM judged.lang AND own.source IS NOT DISTINCT FROM judged.source
  LEFT JOIN of_lang ON of_lang.lang IS NOT DISTINCT FROM judged.lang CROSS JOIN of_all
"""


OP8 = f"""
WITH live AS (SELECT * FROM documents WHERE doc_id % 7 <> 0),
  counts AS (
    SELECT source, lang, 'words' AS version,
           CASE WHEN doc_id % 10 = 3 THEN len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]{{2,}}'))
                ELSE len(regexp_extract_all(coalesce(text, ''), '{WORD}')) END AS tokens FROM live
    UNION ALL
    SELECT CASE WHEN lang = 'de' THEN 'moved-' || source ELSE source END, lang, 'quarters', (length(coalesce(text, '')) + 3) // 4 FROM live)
SELECT source, lang, version, count(*) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens FROM counts GROUP BY source, lang, version
"""

OP11 = f"""
WITH cut AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
  words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM cut),
  windows AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + {SUBSTRING - 1}), ' ') AS s
              FROM (SELECT doc_id, w, unnest(range(1, len(w) - {SUBSTRING - 2})) AS i FROM cut WHERE len(w) >= {SUBSTRING})),
  firsts AS (SELECT s, min(doc_id) AS f FROM windows GROUP BY s),
  gone AS (SELECT DISTINCT doc_id, i + k AS i FROM windows JOIN firsts USING (s), (SELECT unnest(range({SUBSTRING})) AS k) WHERE f < doc_id),
  kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT cut.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM cut LEFT JOIN kept USING (doc_id)
"""


def _op13() -> str:
    def field(column: str) -> str:
        return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"

    def leaf(count: str) -> str:
        return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", count, "text"))) + ")"

    def levels(name: str, nodes: str) -> str:
        return f"""{name}(tree, level, place, digest, size) AS ({nodes}
    UNION ALL SELECT tree, level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (size + 1) // 2
    FROM {name} WHERE size > 1 GROUP BY tree, level, place // 2, size)"""

    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: ord(d)::BIGINT)), lambda c, b: {bits}), 4294967295)"
    return f"""
WITH RECURSIVE
  leaves AS (SELECT doc_id, coalesce('.' || lang, '') AS tree, {leaf('n_chars')} AS leaf,
                    CASE WHEN {crc} % 7 = 0 THEN {leaf('(n_chars + 1)')} ELSE {leaf('n_chars')} END AS seen FROM documents),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY tree) AS size
             FROM leaves),
  {levels("low", "SELECT tree, 0, rank, leaf, size FROM ranked")},
  subroots AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS rank, count(*) OVER () AS size FROM low WHERE size = 1),
  {levels("high", "SELECT '', 0, rank, subroot, size FROM subroots")},
  heights AS (SELECT tree, max(level) AS height FROM low GROUP BY tree),
  steps AS (
    SELECT r.tree, r.rank, n.level AS step, (r.rank >> n.level) & 1 AS side, n.digest
    FROM ranked r LEFT JOIN low n ON n.tree = r.tree AND n.size > 1 AND n.place = xor(r.rank >> n.level, 1) WHERE n.level IS NOT NULL
    UNION ALL
    SELECT r.tree, r.rank, height + n.level, (s.rank >> n.level) & 1, n.digest
    FROM ranked r JOIN subroots s ON s.tree = r.tree JOIN heights h ON h.tree = r.tree
    JOIN high n ON n.size > 1 AND n.place = xor(s.rank >> n.level, 1)),
  tall AS (SELECT h.tree, height, height + (SELECT max(level) FROM high) AS whole FROM heights h),
  fold(tree, rank, step, node) AS (
    SELECT tree, rank, 0, seen FROM ranked
    UNION ALL
    SELECT f.tree, f.rank, f.step + 1,
           sha256(CASE WHEN s.digest IS NULL THEN node WHEN s.side = 0 THEN node || s.digest ELSE s.digest || node END)
    FROM fold f JOIN tall t ON t.tree = f.tree AND f.step < t.whole LEFT JOIN steps s ON s.tree = f.tree AND s.rank = f.rank AND s.step = f.step),
  proofs AS (SELECT tree, rank, string_agg(digest, '' ORDER BY step) AS proof FROM steps GROUP BY tree, rank)
SELECT r.doc_id, r.leaf, s.subroot, root.digest AS root, sha256(coalesce(proof, '')) AS proof_sha256, f.node AS folded_root, f.node = root.digest AS verified
FROM ranked r JOIN subroots s ON s.tree = r.tree JOIN tall t ON t.tree = r.tree JOIN fold f ON f.tree = r.tree AND f.rank = r.rank AND f.step = t.whole
LEFT JOIN proofs p ON p.tree = r.tree AND p.rank = r.rank CROSS JOIN (SELECT digest FROM high WHERE size = 1) root
"""


ORACLE = {
    "op3_rotation_codes": OP3,
    "op4_minhash_bayes": OP4,
    "op5_url_model": _op5(),
    "op6_chat_windows": _op6(),
    "op8_token_rollups": OP8,
    "op10_adaptive_rules": _op10(),
    "op11_suffix_automata": OP11,
    "op13_merkle_descent": _op13(),
}
MORE = {"op5_whole_url": ORACLE["op5_url_model"]}
