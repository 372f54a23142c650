"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

# The rules of hosts and paths are written out; words of the method by plain search.
URLS = r"""
WITH parts AS (
    SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), sites AS (
    SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM parts
), split AS (
    SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
    FROM sites
), rules(verdict, rule, of_host, of_path) AS (VALUES
    ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
    ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'),
    ('block', 'net/fr/', 'net', '/fr/')
), best AS (
    SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
    FROM (SELECT DISTINCT host, path FROM split), rules
    WHERE (host = of_host OR ends_with(host, '.' || of_host)) AND starts_with(path, of_path)
    GROUP BY host, path
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN regexp_matches(lower(host || path),
           '(^|[^a-z0-9])(cheap-pills|online-casino|casino|free-money|payday-loans|replica-watches|porn|xxx|sex-cams|crack-keygen|warez)($|[^a-z0-9])')
           THEN 'block' ELSE 'allow' END) AS verdict
FROM split LEFT JOIN best USING (host, path)
"""

PASSAGES = r"""
WITH cut AS (
    SELECT 'd' AS kind, doc_id AS id, text FROM documents
    UNION ALL SELECT 'b', item_id, text FROM benchmark
), listed AS (
    SELECT kind, id, list_filter(string_split(regexp_replace(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda w: w <> '') AS words
    FROM cut
), windows AS (
    SELECT DISTINCT id AS item_id, least(len(words), 10) AS n,
           array_to_string(words[s : s + least(len(words), 10) - 1], ' ') AS gram
    FROM (SELECT id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS s
          FROM listed WHERE kind = 'b' AND len(words) > 0)
), runs AS (
    SELECT id AS doc_id, n, s, array_to_string(words[s : s + n - 1], ' ') AS gram
    FROM (SELECT id, words, n, unnest(range(1, len(words) - n + 2)) AS s
          FROM listed, (SELECT DISTINCT n FROM windows) WHERE kind = 'd' AND len(words) >= n)
), found AS (
    SELECT doc_id, item_id, runs.n, s FROM runs JOIN windows ON runs.gram = windows.gram AND runs.n = windows.n
), hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT id AS doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM listed LEFT JOIN hit ON listed.id = hit.doc_id LEFT JOIN items ON listed.id = items.doc_id
WHERE kind = 'd'
"""

# The schedules are (4, 3, 2), (1, 1) and (1, 3) at equal steps of time; areas are 3, 1 and 2.
MIX = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5(coalesce(doc_id::VARCHAR, '')) AS key
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INTEGER AS kind
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, CASE kind WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0 ELSE 2.0 END AS weight FROM sources
), filled AS (
    SELECT *, 2 * source_size / weight AS fill, sum(source_size) OVER ()::DOUBLE * 1.5 AS words FROM weighed
), levels AS (
    SELECT *, (words - coalesce(sum(2 * source_size) OVER (ORDER BY fill, source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
              / sum(weight) OVER (ORDER BY fill, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM filled
), targets AS (
    SELECT source, source_size, kind,
           least(2.0 * source_size, coalesce(max(CASE WHEN level <= fill THEN level END) OVER () * weight, 2.0 * source_size))::DOUBLE AS target
    FROM levels
), placed AS (
    SELECT sized.*, source_size, kind, target, floor(target)::BIGINT AS whole,
           coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY key, doc_id, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), cut AS (
    SELECT *, least(size, greatest(0, whole - start)) AS first, least(size, greatest(0, whole - source_size - start)) AS second,
           start / target AS share FROM placed
), timed AS (
    SELECT *, CASE kind
        WHEN 0 THEN CASE WHEN share * 3.0 < 1.75 THEN 2 * (share * 3.0) / (4.0 + sqrt(greatest(0.0, 16.0 - 4.0 * (share * 3.0))))
                         ELSE 0.5 + 2 * (share * 3.0 - 1.75) / (3.0 + sqrt(greatest(0.0, 9.0 - 4.0 * (share * 3.0 - 1.75)))) END
        WHEN 1 THEN 2 * share / (1.0 + sqrt(1.0))
        ELSE 2 * (share * 2.0) / (1.0 + sqrt(1.0 + 4.0 * (share * 2.0))) END AS moment
    FROM cut
)
SELECT doc_id, size, source_size, target, (first + second)::BIGINT AS taken,
       CASE WHEN size > 0 THEN (2 * first >= size)::INTEGER + (2 * second >= size)::INTEGER ELSE 0 END AS copies,
       CASE WHEN size > 0 AND 2 * first >= size THEN least(1.0, moment) END::DOUBLE AS position
FROM timed
"""

VECTORS = r"""
WITH RECURSIVE able AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.98
), reach(a, b) AS (
    SELECT vec_id, vec_id FROM able UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), roots AS (SELECT a, min(b) AS root FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(root, vec_id)::BIGINT AS component_id,
       coalesce(vec_id = coalesce(root, vec_id), false) AS kept
FROM embeddings LEFT JOIN counts ON vec_id = counts.a LEFT JOIN roots ON vec_id = roots.a
"""


def clusters(rounds: int = 5, centroids: int = 40) -> str:
    """Rounds written out one after the other; the component of a vector is a row."""

    def assigned(number: int) -> str:
        return f"""
a{number} AS MATERIALIZED (
    SELECT row, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
    FROM (SELECT x.row, c.cluster, sum((x.v - c.v) * (x.v - c.v))::BIGINT AS distance
          FROM parts x JOIN c{number} c USING (i) GROUP BY x.row, c.cluster)
    GROUP BY row
)"""

    def moved(number: int) -> str:
        return f"""
c{number + 1} AS MATERIALIZED (
    SELECT c.cluster, c.i, coalesce((s - ((s % n) + n) % n) // n, c.v)::BIGINT AS v
    FROM c{number} c LEFT JOIN (
        SELECT cluster, i, sum(v)::BIGINT AS s, count(*) AS n FROM parts JOIN a{number} USING (row) GROUP BY cluster, i
    ) m ON c.cluster = m.cluster AND c.i = m.i
)"""

    steps = ",".join(assigned(n) + "," + moved(n) for n in range(rounds))
    return f"""
WITH able AS (
    SELECT row_number() OVER () AS row, vec_id,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT row, unnest(v) AS v, generate_subscripts(v, 1) AS i FROM able
), firsts AS (
    SELECT row, (row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), v) - 1)::INTEGER AS cluster
    FROM able QUALIFY cluster < {centroids}
),
c0 AS MATERIALIZED (SELECT cluster, i, v FROM parts JOIN firsts USING (row)),{steps},{assigned(rounds)},
hashes AS (SELECT cluster, sha256(string_agg(v::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM able JOIN a{rounds} USING (row) JOIN hashes USING (cluster)
"""


# The rebuilt text is cut out of the output by the lengths of its parts.
MIDDLES = r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), numbers AS (
    SELECT *, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3,
           ('0x' || h[25:32])::BIGINT AS h4, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units
    FROM drawn
), formed AS (
    SELECT *, len(units) AS n,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
                THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers
), cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high FROM formed
), parts AS (
    SELECT *, coalesce(array_to_string(units[1:low], ''), '') AS p, coalesce(array_to_string(units[low + 1:high], ''), '') AS m,
           coalesce(array_to_string(units[high + 1:], ''), '') AS s
    FROM cut
), built AS (
    SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output,
           length(p)::BIGINT AS lp, length(m)::BIGINT AS lm, length(s)::BIGINT AS ls
    FROM parts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lp END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN lm END AS middle_chars, sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN output
           WHEN 'psm' THEN substring(output, 4, lp) || substring(output, 10 + lp + ls, lm) || substring(output, 7 + lp, ls)
           ELSE substring(output, 7 + ls, lp) || substring(output, 10 + ls + lp, lm) || substring(output, 4, ls) END) AS restored_sha256
FROM built
"""

ORACLES: dict[str, str] = {
    "op5_url_verdicts": URLS,
    "op7_decontamination": PASSAGES,
    "op8_mix": MIX,
    "op10_embedding_dedup": VECTORS,
    "op11_centroid_clusters": clusters(),
    "op12_fill_in_middle": MIDDLES,
}
