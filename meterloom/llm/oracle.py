"""DuckDB SQL of the queries that SQL can express."""

from meterloom.llm.license_scan import COVERED, DRIFT, TEMPLATES
from meterloom.llm.line_dedup import WORDS
from meterloom.llm.url_filter import FOLDS, ORDER, RULES, SMOOTH, STEP

_WORDS = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {}

ORACLE["op1_exact_topk_search"] = """
WITH used AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, o.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * o.v[i])) AS BIGINT) AS score
  FROM used q JOIN used o ON o.vec_id <> q.vec_id
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

ORACLE["op2_ngram_jaccard_join"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORDS}') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS gram
  FROM w
), n AS (
  SELECT doc_id, count(gram) AS n FROM w LEFT JOIN g USING (doc_id) GROUP BY doc_id
), o AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, l.b FROM reach r JOIN l ON l.a = r.other
), classes AS (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY n, CASE WHEN n = 0 THEN doc_id END, grams) AS class_id
  FROM (SELECT n.doc_id, n, list(gram ORDER BY gram) AS grams FROM n LEFT JOIN g USING (doc_id) GROUP BY 1, 2)
)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(other) AS component_id, any_value(class_id) AS class_id
FROM n JOIN reach USING (doc_id) JOIN classes ON classes.doc_id = n.doc_id GROUP BY 1, 2
"""

ORACLE["op4_source_mixing"] = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0) AS BIGINT) AS size,
         md5('mix-1/' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source COLLATE C NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM d GROUP BY source
), f AS (
  SELECT *, 3 * source_size AS most, sum(source_size) OVER () AS words,
         coalesce(sum(3 * source_size) OVER o, 0) AS given_before, sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS weight_left
  FROM s WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (
  SELECT *, most * weight_left <= weight * (words - given_before) AS stopped FROM f
), t AS (
  SELECT source, source_size, CASE WHEN stopped THEN CAST(most AS DOUBLE)
    ELSE CAST(CAST(weight * (words - sum(CASE WHEN stopped THEN most ELSE 0 END) OVER ()) AS BIGINT) AS DOUBLE)
         / CAST(sum(CASE WHEN stopped THEN 0 ELSE weight END) OVER () AS BIGINT) END AS target
  FROM c
), p AS (
  SELECT d.*, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS whole,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, CAST(greatest(0, least(size, whole - place)) + greatest(0, least(size, whole - place - source_size))
       + greatest(0, least(size, whole - place - 2 * source_size)) AS BIGINT) AS taken
FROM p
"""

#: The contract's phrases, then the method's own notices.
_TEMPLATES = """(0, 'base', 'mit', ['under', 'the', 'mit', 'license']), (1, 'base', 'apache-2', ['apache', 'license', 'version', '2']),
  (2, 'base', 'cc-by-nc', ['cc', 'by', 'nc'])""" + "".join(
    f", ({n}, '{kind}', '{label}', string_split('{text}', ' '))" for n, (kind, label, text) in enumerate(TEMPLATES) if kind == "notice")
ORACLE["op3_license_scan"] = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), g AS (
  SELECT doc_id, i - 1 AS pos, array_to_string(w[i:i + 2], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)
), t AS (
  SELECT n, kind, label, len(w) AS length, i - 1 AS place, array_to_string(w[i:i + 2], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM (VALUES {_TEMPLATES}) v(n, kind, label, w))
), h AS (
  SELECT DISTINCT doc_id, n, kind, label, length, pos - place AS diagonal, place FROM g JOIN t USING (gram)
), d AS (
  SELECT doc_id, n, kind, label, length, diagonal, count(*) AS votes FROM h GROUP BY ALL
), s AS (
  SELECT *, sum(fresh) OVER (PARTITION BY doc_id, n ORDER BY diagonal) AS span
  FROM (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, n ORDER BY diagonal) <= {DRIFT} THEN 0 ELSE 1 END AS fresh FROM d)
), c AS (
  SELECT doc_id, kind, label, count(DISTINCT word) / length::DOUBLE AS share
  FROM (SELECT s.*, unnest([place, place + 1, place + 2]) AS word FROM s JOIN h USING (doc_id, n, kind, label, length, diagonal))
  GROUP BY doc_id, n, kind, label, length, span
), b AS (
  SELECT doc_id, label, diagonal FROM d WHERE kind = 'base' AND votes = length - 2
), l AS (
  SELECT doc_id, label FROM b UNION SELECT doc_id, label FROM c WHERE kind = 'notice' AND share >= {COVERED}
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, (SELECT count(*) FROM b WHERE b.doc_id = w.doc_id) AS n_base,
       (SELECT min(diagonal) FROM b WHERE b.doc_id = w.doc_id) AS first_word, (SELECT max(diagonal) FROM b WHERE b.doc_id = w.doc_id) AS last_word,
       coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM b WHERE b.doc_id = w.doc_id), '') AS base_labels,
       coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM l WHERE l.doc_id = w.doc_id), '') AS labels,
       greatest(coalesce((SELECT max(1.0::DOUBLE) FROM b WHERE b.doc_id = w.doc_id), 0),
                coalesce((SELECT max(share) FROM c WHERE kind = 'notice' AND c.doc_id = w.doc_id), 0)) AS score
FROM w
"""

ORACLE["op9_line_dedup"] = rf"""
WITH a AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
), n AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM (SELECT doc_id, i, len(found) AS n_words, array_to_string(found, ' ') AS w
        FROM (SELECT *, regexp_extract_all({_LOWER.format("line")}, '{_WORDS}') AS found FROM a)) WHERE n_words > 0
), d AS (
  SELECT doc_id, list(w ORDER BY k) AS ws, count(*) AS n_lines, sum(n_words) AS total FROM n GROUP BY doc_id
), s AS (
  SELECT *, sum(n_words) OVER (PARTITION BY doc_id ORDER BY k) AS upto FROM n
), r AS (
  SELECT a.doc_id, a.k AS lo, min(b.k) AS hi FROM s a JOIN s b ON a.doc_id = b.doc_id AND b.k >= a.k AND b.upto - a.upto + a.n_words >= {WORDS}
  GROUP BY a.doc_id, a.k
  UNION SELECT b.doc_id, max(a.k), b.k FROM s a JOIN s b ON a.doc_id = b.doc_id AND b.k >= a.k AND b.upto - a.upto + a.n_words >= {WORDS}
  GROUP BY b.doc_id, b.k
  UNION SELECT doc_id, 1, n_lines FROM d WHERE total < {WORDS}
), p AS (
  SELECT doc_id, lo, hi, row_number() OVER (PARTITION BY array_to_string(list_slice(ws, lo, hi), chr(10)) ORDER BY doc_id, lo) AS place
  FROM r JOIN d USING (doc_id)
), gone AS (
  SELECT DISTINCT n.doc_id, i FROM n JOIN p ON n.doc_id = p.doc_id AND k BETWEEN lo AND hi WHERE place > 1
), kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text FROM a ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
), sums AS (
  SELECT doc_id, coalesce(d.n_lines, 0) AS n_lines, (SELECT count(*) FROM gone g WHERE g.doc_id = documents.doc_id) AS n_removed,
         CASE WHEN documents.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
  FROM documents LEFT JOIN kept USING (doc_id) LEFT JOIN d USING (doc_id)
)
SELECT doc_id, CAST(n_lines AS INTEGER) AS n_lines, CAST(n_removed AS INTEGER) AS n_removed, length(text) AS n_chars, md5(text) AS text_md5 FROM sums
"""


def _rules(take: int) -> str:
    """CASE of the longest rule that fits; take: which of its parts is the value, or its text."""
    cases = [f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND path LIKE '{p}%' THEN '{(v, h, p, h + p)[take]}'" for v, h, p in
             sorted(RULES, key=lambda r: -len(r[1] + r[2]))]
    return f"CASE {' '.join(cases)} END"


def _shares(side: str) -> str:
    share = "1.0::DOUBLE / symbols"
    for order in range(ORDER + 1):
        own, context = (f"substr(gram, {ORDER + 1 - order}, {n})" for n in (order + 1, order))
        seen = f"sum({side}) OVER (PARTITION BY {context})" if order else f"sum({side}) OVER ()"
        share = f"((sum({side}) OVER (PARTITION BY {own})) + {SMOOTH}::DOUBLE * ({share})) / ({seen} + {SMOOTH}::DOUBLE)"
    return share


ORACLE["op5_url_filter"] = f"""
WITH p AS (
  SELECT page_id, {_LOWER.format("regexp_extract(after, '^[^/?#]*')")} AS host, regexp_extract(after, '^[^/?#]*([^?#]*)', 1) AS path,
         substr(after, length(regexp_extract(after, '^[^/?#]*')) + 1) AS tail
  FROM (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS after FROM pages)
), r AS (
  SELECT *, host || tail AS rest, {_rules(3)} AS rule, {_rules(0)} AS ruled, ('0x' || substr(md5(host || tail), 1, 8))::UBIGINT % {FOLDS} = 0 AS held FROM p
), u AS (
  SELECT rest, count(*) FILTER (ruled = 'allow' AND NOT held) AS a, count(*) FILTER (ruled = 'block' AND NOT held) AS b,
         count(*) FILTER (ruled = 'allow' AND held) AS held_a, count(*) FILTER (ruled = 'block' AND held) AS held_b
  FROM r GROUP BY rest
), g AS (
  SELECT *, substr(repeat(chr(2), {ORDER}) || rest || chr(3), i, {ORDER + 1}) AS gram FROM (SELECT *, unnest(range(1, length(rest) + 2)) AS i FROM u)
), c AS (
  SELECT gram, CAST(sum(a) AS DOUBLE) AS a, CAST(sum(b) AS DOUBLE) AS b, (SELECT count(DISTINCT substr(gram, {ORDER + 1}, 1)) FROM g) AS symbols FROM g GROUP BY gram
), m AS (
  SELECT gram, ln({_shares("a")}) - ln({_shares("b")}) AS s FROM c
), scored AS (
  SELECT rest, any_value(held_a) AS held_a, any_value(held_b) AS held_b, sum(s) / count(*) AS s FROM g JOIN m USING (gram) GROUP BY rest
), bins AS (
  SELECT CAST(floor(s / {STEP}) AS BIGINT) AS bin, CAST(sum(held_a) AS DOUBLE) AS a, CAST(sum(held_b) AS DOUBLE) AS b
  FROM scored WHERE held_a + held_b > 0 GROUP BY 1
), gains AS (
  SELECT bin, lag(bin) OVER (ORDER BY bin) AS lower_bin, (sum(a) OVER () - coalesce(sum(a) OVER o, 0)) / sum(a) OVER () + coalesce(sum(b) OVER o, 0) / sum(b) OVER () AS gain
  FROM bins WINDOW o AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), least_score AS (
  SELECT (bin + coalesce(lower_bin + 1, bin)) / 2::DOUBLE * {STEP} AS t FROM gains WHERE isfinite(gain) ORDER BY gain DESC, abs(bin), bin DESC LIMIT 1
)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN s >= coalesce((SELECT t FROM least_score), 0) THEN 'allow' ELSE 'block' END) AS verdict
FROM r JOIN scored USING (rest)
"""


def _merkle(width: int = 16, levels: int = 8) -> str:
    """Levels one by one; a tree of one node stays as it is, so `levels` only has to be enough. `path` has every leaf
    with its node and both roots-to-be; siblings are added up level by level."""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), field(text)]) + ")"
    crc = ("xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: "
           "[CAST(ascii(ch) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))), lambda c, b: xor(xor(c, b) // 2, 3988292384 * (xor(c, b) % 2))), 4294967295)")
    parts = [f"""leaves AS (
  SELECT row_number() OVER () AS id, doc_id, source, {leaf("text")} AS leaf,
         CASE WHEN {crc} % 5 = 0 THEN {leaf(_LOWER.format("text"))} ELSE {leaf("text")} END AS read FROM documents
), l0 AS (
  SELECT id, doc_id, source, leaf, read, leaf AS digest, read AS folded, '' AS proof,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, id) - 1 AS pos FROM leaves
)"""]

    def climb(name: str, before: str, key: str) -> list[str]:
        """`nodes` are the tree's own; `before` are the leaves, each with the node it stands under."""
        return [f"""{name}n AS (
  SELECT DISTINCT {key}, pos, digest FROM {before}
), {name}g AS (
  SELECT {key}, pos // {width} AS up, string_agg(digest, '' ORDER BY pos) AS joined, list(digest ORDER BY pos) AS run,
         (SELECT count(*) FROM {name}n o WHERE o.{key} IS NOT DISTINCT FROM {name}n.{key}) AS size
  FROM {name}n GROUP BY {key}, pos // {width}
), {name} AS (
  SELECT b.* REPLACE (CASE WHEN g.size > 1 THEN sha256(g.joined) ELSE b.digest END AS digest,
    CASE WHEN g.size > 1 THEN sha256(array_to_string(g.run[1:b.pos % {width}], '') || b.folded || array_to_string(g.run[b.pos % {width} + 2:], ''))
         ELSE b.folded END AS folded,
    CASE WHEN g.size > 1 THEN b.proof || array_to_string(g.run[1:b.pos % {width}], '') || array_to_string(g.run[b.pos % {width} + 2:], '')
         ELSE b.proof END AS proof,
    b.pos // {width} AS pos)
  FROM {before} b JOIN {name}g g ON g.{key} IS NOT DISTINCT FROM b.{key} AND g.up = b.pos // {width}
)"""]

    for i in range(1, levels + 1):
        parts += climb(f"l{i}", f"l{i - 1}", "source")
    parts.append(f"""trees AS (
  SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM (SELECT DISTINCT source FROM l{levels})
), r0 AS (
  SELECT b.* REPLACE (t.place AS pos), b.digest AS subroot, 0 AS one FROM l{levels} b JOIN trees t ON t.source IS NOT DISTINCT FROM b.source
)""")
    for i in range(1, levels + 1):
        parts += climb(f"r{i}", f"r{i - 1}", "one")
    return "WITH " + ", ".join(parts) + f"""
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified FROM r{levels}
"""


ORACLE["op11_merkle_manifest"] = _merkle()

ORACLE["op12_embedding_near_dedup"] = """
WITH RECURSIVE used AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm
  FROM (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
  WHERE len(e) > 0 AND label IS NOT NULL
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM used a JOIN used b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a) USING (vec_id)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
"""
