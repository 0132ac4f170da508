"""Expected results as plain SQL for DuckDB, where SQL can express them over whole tables."""

from __future__ import annotations

WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"


def _windows(n: int) -> str:
    """The n words that start at a row, joined by blanks."""
    return "concat_ws(' ', word, " + ", ".join(f"lead(word, {k}) OVER places" for k in range(1, n)) + ")"


def _words(text: str) -> str:
    return f"""
        texts AS (SELECT doc_id, {WORDS.format(text=text)} AS w FROM documents),
        words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM texts)"""


# A text with fewer than five words is one shingle, as the missing words are left out.
OP6 = f"""
    WITH RECURSIVE {_words("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")},
        starts AS (
            SELECT doc_id, i, {_windows(5)} AS shingle, lead(word, 4) OVER places IS NOT NULL AS whole
            FROM words WINDOW places AS (PARTITION BY doc_id ORDER BY i)),
        shingles AS (
            SELECT DISTINCT starts.doc_id, shingle FROM starts JOIN texts USING (doc_id)
            WHERE whole OR (i = 1 AND len(w) < 5)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
        reached AS (
            SELECT doc_id, doc_id AS least FROM documents
            UNION SELECT b, least FROM reached JOIN links ON a = doc_id WHERE least < b)
    SELECT r.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(least) AS component_id
    FROM reached r LEFT JOIN sizes USING (doc_id) GROUP BY r.doc_id"""

OP8 = f"""
    WITH {_words("coalesce(text, '')")},
        starts AS (
            SELECT doc_id, i, word, CASE WHEN lead(word, 12) OVER places IS NOT NULL THEN {_windows(13)} END AS sequence
            FROM words WINDOW places AS (PARTITION BY doc_id ORDER BY i)),
        firsts AS (SELECT sequence, min(doc_id) AS first FROM starts WHERE sequence IS NOT NULL GROUP BY sequence),
        marked AS (SELECT doc_id, i, word, coalesce(first < doc_id, false) AS again FROM starts LEFT JOIN firsts USING (sequence)),
        judged AS (
            SELECT doc_id, i, word,
                   bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone
            FROM marked),
        left_over AS (
            SELECT doc_id, count_if(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
            FROM judged GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM texts LEFT JOIN left_over USING (doc_id)"""

OP10 = """
    WITH payloads AS (
        SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
               min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
        FROM pages)
    SELECT page_id, payload_bytes, sha256(payload) AS payload_digest,
           CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
    FROM payloads"""


# The checksum goes bit by bit; a tree level by level, for each language and then over their roots.
OP11 = """
    WITH RECURSIVE
        digits AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS t FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
        bits AS (
            SELECT doc_id, t, 0 AS k, CAST(4294967295 AS BIGINT) AS c FROM digits
            UNION ALL
            SELECT doc_id, t, k + 1, CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END
            FROM (SELECT doc_id, t, k, CASE WHEN k % 8 = 0 THEN xor(c, CAST(ascii(substr(t, k // 8 + 1, 1)) AS BIGINT)) ELSE c END AS x FROM bits WHERE k < 8 * length(t))),
        chosen AS (SELECT doc_id FROM bits WHERE k = 8 * length(t) AND xor(c, 4294967295) % 7 = 0),
        parts AS (
            SELECT d.*, CASE WHEN c.doc_id IS NULL THEN n_chars ELSE n_chars + 1 END AS claimed
            FROM documents d LEFT JOIN chosen c ON c.doc_id = d.doc_id),
        fields AS (
            SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '+' || lang END AS grp,
                   coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
                       || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
                   coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS told,
                   coalesce(octet_length(encode(CAST(claimed AS VARCHAR))) || ':' || claimed, '-') AS claim,
                   coalesce(octet_length(encode(text)) || ':' || text, '-') AS body
            FROM parts),
        hashed AS (SELECT doc_id, grp, sha256(head || told || body) AS leaf, sha256(head || claim || body) AS shown FROM fields),
        leaves AS (
            SELECT *, row_number() OVER (ORDER BY doc_id NULLS LAST, leaf) AS r, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS LAST, leaf) - 1 AS place,
                   count(*) OVER (PARTITION BY grp) AS n
            FROM hashed),
        tree AS (
            SELECT grp, 0 AS lvl, place, n, leaf AS node FROM leaves
            UNION ALL
            SELECT grp, lvl + 1, place // 2, (n + 1) // 2, sha256(node || coalesce(next, ''))
            FROM (SELECT *, lead(node) OVER (PARTITION BY grp ORDER BY place) AS next FROM tree WHERE n > 1) WHERE place % 2 = 0),
        subroots AS (
            SELECT grp, node AS subroot, row_number() OVER (ORDER BY encode(grp)) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1),
        top AS (
            SELECT 0 AS lvl, place, n, subroot AS node FROM subroots
            UNION ALL
            SELECT lvl + 1, place // 2, (n + 1) // 2, sha256(node || coalesce(next, ''))
            FROM (SELECT *, lead(node) OVER (ORDER BY place) AS next FROM top WHERE n > 1) WHERE place % 2 = 0),
        segments AS (
            SELECT l.r, t.lvl AS k, t.place % 2 = 1 AS first, coalesce(s.node, '') AS node
            FROM leaves l JOIN tree t ON t.grp = l.grp AND t.n > 1 AND t.place = l.place >> t.lvl
            LEFT JOIN tree s ON s.grp = t.grp AND s.lvl = t.lvl AND s.place = xor(t.place, 1)
            UNION ALL
            SELECT l.r, 1000 + t.lvl, t.place % 2 = 1, coalesce(s.node, '')
            FROM leaves l JOIN subroots g ON g.grp = l.grp JOIN top t ON t.n > 1 AND t.place = g.place >> t.lvl
            LEFT JOIN top s ON s.lvl = t.lvl AND s.place = xor(t.place, 1)),
        path AS (SELECT r, row_number() OVER (PARTITION BY r ORDER BY k) AS k, first, node FROM segments),
        proofs AS (SELECT r, sha256(string_agg(node, '' ORDER BY k)) AS proof, max(k) AS steps FROM path GROUP BY r),
        folds AS (
            SELECT r, CAST(0 AS BIGINT) AS k, shown AS node FROM leaves
            UNION ALL
            SELECT f.r, p.k, sha256(CASE WHEN p.first THEN p.node || f.node ELSE f.node || p.node END)
            FROM folds f JOIN path p ON p.r = f.r AND p.k = f.k + 1)
    SELECT doc_id, leaf, subroot, t.node AS root, coalesce(proof, sha256('')) AS proof_sha256, f.node AS folded_root, f.node = t.node AS verified
    FROM leaves l JOIN subroots USING (grp) JOIN top t ON t.n = 1 LEFT JOIN proofs USING (r)
    JOIN folds f ON f.r = l.r AND f.k = coalesce(steps, 0)"""

OP12 = r"""
    WITH
        item_words AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, array_to_string(w[i:least(i + 9, len(w))], ' ') AS sequence, least(len(w), 10) AS size
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT size FROM windows),
        doc_words AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        starts AS (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc_words, sizes WHERE len(w) >= size),
        met AS (
            SELECT r, i, s.size, item_id FROM (SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS sequence FROM starts) s
            JOIN windows v ON v.sequence = s.sequence AND v.size = s.size),
        hits AS (SELECT r, count(DISTINCT i) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS i FROM (SELECT DISTINCT r, i, size FROM met)) GROUP BY r),
        found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY encode(item)) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM doc_words LEFT JOIN hits USING (r) LEFT JOIN found USING (r)"""

OP13 = """
    WITH
        parts AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding, row_number() OVER () AS r
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
        numbers AS (SELECT r, vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(len(embedding))) AS d FROM parts),
        bad AS (SELECT DISTINCT r FROM numbers WHERE x IS NULL OR NOT isfinite(x)),
        good AS (SELECT r, vec_id, label, d, CAST(floor(256 * x) AS BIGINT) AS x FROM numbers WHERE r NOT IN (SELECT r FROM bad)),
        scores AS (
            SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(sum(a.x * b.x) AS BIGINT) AS score
            FROM good a JOIN good b ON a.d = b.d AND a.r <> b.r WHERE a.vec_id % 100 = 0 GROUP BY a.r, a.vec_id, b.r, b.vec_id, a.label = b.label),
        positives AS (
            SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS nth
            FROM scores WHERE same QUALIFY nth <= 5),
        negatives AS (
            SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor, nth ORDER BY s.score DESC, s.vec_id) AS rank
            FROM positives p JOIN scores s ON s.anchor = p.anchor AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10"""


def oracle_sql() -> dict[str, str]:
    return {"op6_jaccard_join": OP6, "op8_substring_dedup": OP8, "op10_warc_conversion": OP10, "op11_merkle_manifest": OP11, "op12_decontamination": OP12, "op13_hard_negatives": OP13}
