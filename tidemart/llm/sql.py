"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

#: words of the similarity join, distinct shingles, links, and reachability by ids
JACCARD = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM {docs}
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [words]
        ELSE list_transform(range(1, len(words) - 3), lambda i: words[i:i + 4]) END) AS shingle
    FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
    SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
    WHERE 100 * c >= 75 * (nx.n + ny.n - c)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM w
    UNION SELECT reach.a, link.y FROM reach JOIN link ON reach.b = link.x
), component AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
"""

#: windows of the items, the document windows that equal one, and the words they cover
DECONTAMINATION = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM {docs}
), b AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), p AS (
    SELECT DISTINCT item_id, least(len(words), 13) AS n,
        unnest(list_transform(range(1, len(words) - least(len(words), 13) + 2),
            lambda i: array_to_string(words[i:i + least(len(words), 13) - 1], ' '))) AS window_text
    FROM b WHERE len(words) > 0
), lengths AS (SELECT DISTINCT n FROM p),
placed AS (
    SELECT doc_id, n, words, unnest(range(1, len(words) - n + 2)) AS i FROM d, lengths WHERE len(words) >= n
), found AS (
    SELECT doc_id, i, placed.n, item_id FROM placed JOIN p ON placed.n = p.n AND array_to_string(words[i:i + placed.n - 1], ' ') = window_text
), hit AS (
    SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: bytes of every prefix of up to 40 bits; a document's shard is its shortest prefix that fits
SHARDING = """
WITH d AS (
    SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
        ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15))::BIGINT AS h
    FROM {docs}
), p AS (SELECT *, unnest(range(0, 41)) AS depth FROM d),
b AS (
    SELECT depth, h >> (60 - depth) AS prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows
    FROM p GROUP BY ALL HAVING sum(n_bytes) <= {limit} OR count(*) = 1
), s AS (
    SELECT p.doc_id, p.n_bytes, p.h, min(p.depth) AS depth
    FROM p JOIN b ON b.depth = p.depth AND b.prefix = p.h >> (60 - p.depth) GROUP BY ALL
)
SELECT doc_id, n_bytes, 'b' || CASE WHEN s.depth = 0 THEN '' ELSE lpad(bin(h >> (60 - s.depth)), s.depth::INTEGER, '0') END AS shard,
    shard_bytes, shard_rows, shard_bytes > {limit} AS oversized
FROM s JOIN b ON b.depth = s.depth AND b.prefix = h >> (60 - s.depth)
"""

#: parts of URLs, rules, canonical and refresh edges, reachability, and the decision of each group
URLS = r"""
WITH RECURSIVE rules(rule_host, rule_path, allow) AS (
    VALUES ('net', '/', false), ('example.net', '/en/', true), ('example.com', '/de/', false), ('org', '/fr/', true)
), tags AS (
    SELECT url,
        regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>') AS link,
        regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>') AS meta
    FROM {pages} WHERE contains(url, '://')
), targets AS (
    SELECT url, regexp_extract(link, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS t FROM tags
    UNION ALL SELECT url, regexp_extract(meta, '(?is)\burl\s*=\s*["'']?([^"''>]*)', 1) FROM tags
), absolute AS (
    SELECT url, CASE WHEN contains(t, '://') THEN t
        WHEN starts_with(t, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || t
        WHEN starts_with(t, '/') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*') || t
        WHEN starts_with(t, '#') THEN url
        ELSE regexp_extract(url, '(?s)^.*?://[^/?#]*') || coalesce(nullif(regexp_replace(
            regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '[^/]*$', ''), ''), '/') || t END AS t
    FROM (SELECT url, replace(trim(t), '&amp;', '&') AS t FROM targets) WHERE t <> ''
), urls AS (
    SELECT url AS u FROM {pages} UNION SELECT t FROM absolute
), parts AS (
    SELECT u, translate(coalesce(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM urls
), judged AS (
    SELECT u, host, path, CASE WHEN contains(u, '://') THEN lower(regexp_extract(u, '(?s)^(.*?)://', 1)) || '://' || host
            || coalesce(nullif(path, ''), '/') || regexp_extract(u, '(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)?', 1) END AS node,
        max(CASE WHEN host = rule_host OR ends_with(host, '.' || rule_host) THEN
            CASE WHEN starts_with(path, rule_path) THEN {{'n': length(rule_host || rule_path), 'allow': allow, 'rule': rule_host || rule_path}} END END) AS best
    FROM parts, rules GROUP BY u, host, path
), edge AS (
    SELECT DISTINCT a.node AS x, b.node AS y FROM absolute JOIN judged a ON a.u = url JOIN judged b ON b.u = t WHERE a.node <> b.node
), either_way AS (SELECT x, y FROM edge UNION SELECT y, x FROM edge),
reach AS (SELECT x AS a, x AS b FROM either_way UNION SELECT reach.a, either_way.y FROM reach JOIN either_way ON reach.b = either_way.x),
grouped AS (
    SELECT a AS node, min(b) AS alias_of, max(best.allow) AS group_allow FROM reach LEFT JOIN judged ON judged.node = b GROUP BY a
)
SELECT page_id, host, path, best.rule AS rule,
    CASE WHEN coalesce(best.allow, group_allow, true) THEN 'allow' ELSE 'block' END AS verdict, alias_of
FROM {pages} LEFT JOIN judged ON url IS NOT DISTINCT FROM u LEFT JOIN grouped USING (node)
"""

#: terms, their weights, and each item's 50 documents of the highest scores
SEARCH = r"""
WITH d AS (
    SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM {docs}
), sizes AS (
    SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d
), lengths AS (
    SELECT row_id, doc_id, 100 - 50 + ((50 * len(terms) * n_docs) // n_terms) AS m FROM d, sizes WHERE len(terms) > 0
), postings AS (
    SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(terms) AS term FROM d) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM postings, sizes GROUP BY term, n_docs
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM {items}
), scored AS (
    SELECT item_id, row_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (row_id)
    GROUP BY item_id, row_id, doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 50
"""

#: phrases of one to three words of each piece, cuts, and the candidates that no longer one holds
PHRASES = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM {docs}
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
p AS (
    SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase
    FROM w, (VALUES (1), (2), (3)) sizes(k) WHERE len(words) >= k
), f AS (SELECT lang, k, phrase, count(*) AS f FROM p GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k >= 2 AND f >= {least}),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
scored AS (
    SELECT cuts.lang, cuts.phrase, a, cut, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(words[1:cut], ' ')
    JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(words[cut + 1:], ' ')
), best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
    SELECT lang, phrase, max(a) AS a
    FROM (SELECT lang, a, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS phrase FROM c WHERE k = 3)
    GROUP BY ALL
), kept AS (
    SELECT best.*, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, best.a DESC, best.phrase) AS rank
    FROM best LEFT JOIN longer USING (lang, phrase) WHERE longer.a IS NULL OR 100 * longer.a < 50 * best.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM kept JOIN n USING (lang) WHERE rank <= {top}
"""

SQL = {
    "op1_extendible_sharding": SHARDING.format(docs="documents", limit=16 << 20),
    "op3_url_filters": URLS.format(pages="pages"),
    "op7_ngram_jaccard_join": JACCARD.format(docs="documents") + """
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id
FROM w LEFT JOIN n USING (doc_id) JOIN component ON component.a = w.doc_id
""",
    "op9_benchmark_decontamination": DECONTAMINATION.format(docs="documents"),
    "op11_phrase_collocations": PHRASES.format(docs="documents", least=10, top=2000),
    "op12_lexical_search": SEARCH.format(docs="documents", items="benchmark"),
}
