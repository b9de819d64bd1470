"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations


def _digest(n_chars: str) -> str:
    fields = ["cast(doc_id AS VARCHAR)", "source", "lang", n_chars, "text"]
    return "sha256(" + " || ".join(f"coalesce(cast(strlen({f}) AS VARCHAR) || ':' || {f}, '-')" for f in fields) + ")"


#: Trees as lists: a level is the list of the digests of all pairs of the level below. The CRC-32 runs over the bits of the id's text.
MERKLE_SQL = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, {_digest("cast(n_chars AS VARCHAR)")} AS leaf, {_digest("cast(n_chars + 1 AS VARCHAR)")} AS more,
        xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(range(coalesce(length(cast(doc_id AS VARCHAR)), 0)), lambda i: list_transform(range(8), lambda b:
            ((ascii(cast(doc_id AS VARCHAR)[i + 1]) >> b) & 1)::UBIGINT)))),
            lambda c, bit: CASE WHEN xor(c & 1, bit) = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END), 4294967295::UBIGINT) AS crc
    FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
lang_levels AS (
    SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY lang
    UNION ALL
    SELECT lang, level + 1, list_transform(range((len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
    FROM lang_levels WHERE len(nodes) > 1),
lang_trees AS (
    SELECT lang, list(nodes ORDER BY level) AS tree FROM lang_levels GROUP BY lang),
subroots AS (
    SELECT lang, tree[len(tree)][1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS lang_pos FROM lang_trees),
top_levels AS (
    SELECT 0 AS level, list(subroot ORDER BY lang_pos) AS nodes FROM subroots
    UNION ALL
    SELECT level + 1, list_transform(range((len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
    FROM top_levels WHERE len(nodes) > 1),
top_tree AS (SELECT list(nodes ORDER BY level) AS top FROM top_levels),
steps AS (
    SELECT doc_id, leaf, subroot, top[len(top)][1] AS root, CASE WHEN doc_id IS NOT NULL AND crc % 7 = 0 AND more IS NOT NULL THEN more ELSE leaf END AS start,
        list_concat(
            list_transform(range(len(tree) - 1), lambda k: {{'left': (pos >> k) % 2 = 1, 'other': coalesce(tree[k + 1][xor(pos >> k, 1) + 1], '')}}),
            list_transform(range(len(top) - 1), lambda k: {{'left': (lang_pos >> k) % 2 = 1, 'other': coalesce(top[k + 1][xor(lang_pos >> k, 1) + 1], '')}})) AS path
    FROM placed JOIN lang_trees ON placed.lang IS NOT DISTINCT FROM lang_trees.lang JOIN subroots ON placed.lang IS NOT DISTINCT FROM subroots.lang CROSS JOIN top_tree),
folded AS (
    SELECT *, list_reduce(list_prepend({{'left': false, 'other': start}}, path),
        lambda node, step: {{'left': false, 'other': CASE WHEN step.left THEN sha256(step.other || node.other) ELSE sha256(node.other || step.other) END}}).other AS folded_root
    FROM steps)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s.other), '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM folded
"""

#: Every window of 50 words as text, and the smallest document that holds it.
REPEATS_SQL = """
WITH words AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
windows AS (
    SELECT rid, doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h
    FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM words WHERE len(w) >= 50)),
least AS (SELECT h, min(doc_id) AS low FROM windows GROUP BY h),
gone AS (SELECT DISTINCT rid, unnest(range(p, p + 50)) AS i FROM windows JOIN least USING (h) WHERE doc_id > low OR (doc_id IS NULL AND low IS NOT NULL)),
counted AS (SELECT rid, list(i) AS places FROM gone GROUP BY rid),
marked AS (SELECT rid, doc_id, len(w) AS n_words, w, coalesce(places, []) AS places FROM words LEFT JOIN counted USING (rid)),
single AS (SELECT rid, string_agg(word, ' ' ORDER BY i) AS kept FROM (
    SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words) ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, n_words, len(places) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM marked LEFT JOIN single USING (rid)
"""

#: All phrases of 1 to 5 words of all pieces, counted as text; 128-bit whole numbers for the score.
COLLOCATIONS_SQL = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w
    FROM documents),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
counted AS (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS n
    FROM (SELECT lang, w, i, unnest(range(1, 6)) AS m FROM starts) WHERE i + m - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
frequent AS (SELECT * FROM counted WHERE n >= 100),
cuts AS (
    SELECT lang, phrase, n AS a, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM frequent WHERE m > 1),
scored AS (
    SELECT c.lang, c.phrase, c.a, k, h.n AS l, t.n AS r, totals.n AS n,
        (1000::HUGEINT * c.a * totals.n // (h.n::HUGEINT * t.n))::BIGINT AS score
    FROM cuts c JOIN totals USING (lang)
    JOIN frequent h ON h.lang = c.lang AND h.phrase = array_to_string(w[:k], ' ')
    JOIN frequent t ON t.lang = c.lang AND t.phrase = array_to_string(w[k + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
    SELECT lang, a AS held, array_to_string(w[i:i + m - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM (
        SELECT *, unnest(range(2, len(w))) AS m FROM (SELECT lang, n AS a, string_split(phrase, ' ') AS w FROM frequent WHERE m > 2)))),
covered AS (SELECT lang, phrase, max(held) AS held FROM inner_phrases GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best LEFT JOIN covered USING (lang, phrase) WHERE coalesce(100 * held >= 100 * a, false) = false
QUALIFY rank <= 2000
"""

#: All pairs of equal label by cosine in double precision, and what links reach.
EMBEDDINGS_SQL = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))) AS norm FROM embeddings),
usable AS (
    SELECT * FROM vectors WHERE label IS NOT NULL AND norm > 0 AND isfinite(norm) AND len(list_filter(e, lambda x: x IS NULL)) = 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reached AS (SELECT a, b FROM links UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
least_reached AS (SELECT a, min(b) AS low FROM reached GROUP BY a),
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM embeddings LEFT JOIN degrees ON degrees.a = vec_id LEFT JOIN least_reached ON least_reached.a = vec_id
"""
