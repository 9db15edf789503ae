"""DuckDB oracles of the text queries that SQL can express."""

# Each template as a pattern over words between blanks: optional wording as (...)?,
# replaceable regions as counted words.
_TEMPLATE_SQL = {
    "mit-notice": "(under the( terms of the)? mit license) ",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of"
                "( [^ ]+){1,12} to deal in the software without restriction including without limitation "
                "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software ",
    "apache-2.0-notice": "licensed under the apache license version 2 0 ",
    "gpl-3.0-notice": "licensed under the( terms of the)? gnu( lesser)? general public license"
                      "( as published by the free software foundation either)? version 3 ",
    "gpl-text": "is free software you can redistribute it and or modify it under the terms of the gnu( lesser)? "
                "general public license as published by the free software foundation ",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted "
                "provided that the following conditions are met ",
    "isc-text": "permission to use copy modify and or distribute this software for any purpose with or without fee "
                "is hereby granted provided that( [^ ]+){1,16} appear in all copies ",
    "cc-by-notice": "licensed under a creative commons attribution( [^ ]+){3,7} license ",
}

_OWN = ", ".join(f"CASE WHEN regexp_matches(line, ' {p}') THEN '{k}' END" for k, p in _TEMPLATE_SQL.items())

LICENSE_SCAN = f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
p AS (
  SELECT doc_id, words, ' ' || array_to_string(words, ' ') || ' ' AS line,
    list_filter(range(1, len(words) + 1), lambda i: words[i] = 'mit' AND words[i + 1] = 'license') AS m,
    list_filter(range(1, len(words) + 1), lambda i: words[i] = 'apache' AND words[i + 1] = 'license') AS a,
    list_filter(range(1, len(words) + 1), lambda i: words[i] = 'general' AND words[i + 1] = 'public'
                AND words[i + 2] = 'license') AS g
  FROM w),
q AS (
  SELECT doc_id, words, list_concat(list_concat(m, a), g) AS pl,
    list_filter([CASE WHEN len(a) > 0 THEN 'apache' END, CASE WHEN len(g) > 0 THEN 'gpl' END,
                 CASE WHEN len(m) > 0 THEN 'mit' END], lambda x: x IS NOT NULL) AS base,
    list_filter([{_OWN}], lambda x: x IS NOT NULL) AS own
  FROM p)
SELECT doc_id, len(words)::BIGINT AS n_words, len(pl)::BIGINT AS n_base,
  (list_min(pl) - 1)::BIGINT AS first_word, (list_max(pl) - 1)::BIGINT AS last_word,
  array_to_string(base, ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, own))), ',') AS labels,
  CASE WHEN len(own) > 0 THEN 1.0 WHEN len(base) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM q
"""

LINE_RULES = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM d WHERE len(words) >= 8)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY doc_id),
ln AS (
  SELECT doc_id, host, lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')) AS l
  FROM (SELECT doc_id, host, unnest(lines) AS l FROM d)),
lw AS (SELECT doc_id, host, l, len(string_split(l, ' ')) AS w FROM ln),
hosts AS (SELECT host, count(*) AS docs FROM d GROUP BY host),
freq AS (SELECT host, l FROM lw JOIN hosts USING (host) GROUP BY host, l, docs
  HAVING count(DISTINCT doc_id) > 4 AND count(DISTINCT doc_id) > 0.1 * docs),
lost AS (SELECT doc_id, sum(w) AS lost FROM lw JOIN freq USING (host, l) GROUP BY doc_id),
f AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.lost, 0)::BIGINT AS n_line_words_removed
  FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_line_words_removed <= 0.5 * n_words AS kept
FROM f
"""

# Word sets compared pair by pair through shared shingles; components by reachability.
NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END)) AS h FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s AS a JOIN s AS b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS d, b AS x FROM e UNION SELECT r.d, e.b FROM r JOIN e ON r.x = e.a),
m AS (SELECT d, min(x) AS x FROM r GROUP BY d)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(m.x, doc_id)) AS component_id,
  doc_id = least(doc_id, coalesce(m.x, doc_id)) AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.d = doc_id
"""

# Every 400-byte window of the texts' bytes (two hex digits each), counted by its digest;
# covered bytes as islands; what is left put together from the parts between them.
SUBSTRING_DEDUP = """
WITH d AS (SELECT doc_id, hex(coalesce(text, '')) AS h, len(hex(coalesce(text, ''))) // 2 AS n FROM documents),
w AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS m
  FROM (SELECT doc_id, h, unnest(range(0, n - 399)) AS i FROM d WHERE n >= 400)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY m) AS c FROM w) WHERE c > 1),
isle AS (
  SELECT doc_id, i, sum(CASE WHEN i > before + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM dup)),
span AS (SELECT doc_id, k, min(i) AS lo, max(i) + 400 AS hi FROM isle GROUP BY doc_id, k),
part AS (SELECT *, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS from_ FROM span),
cut AS (
  SELECT doc_id, sum(hi - lo) AS removed, count(*) AS spans, max(hi) AS last_,
    string_agg(substr(h, 2 * from_ + 1, 2 * (lo - from_)), '' ORDER BY lo) AS kept
  FROM part JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept || substr(h, 2 * last_ + 1), h))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

# Every document scored for every item, in 64-bit integers.
RANKED_SEARCH = r"""
WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM lowered),
size AS (SELECT r, doc_id, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0),
corpus AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM size),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
w AS (
  SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, corpus GROUP BY term, nn),
item AS (
  SELECT item_id, q, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
  FROM (SELECT *, row_number() OVER () AS q FROM benchmark)),
scored AS (
  SELECT item_id, q, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))))::BIGINT AS score
  FROM item JOIN w USING (term) JOIN tf USING (term) JOIN size USING (r), corpus GROUP BY item_id, q, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

_RHO = "1 / least(greatest(coalesce(sum((good - n * p) ** 2 - n * p * (1 - p)) / nullif(sum(n * (n - 1) * p * (1 - p)), 0), 0.05), 0.001), 0.5) - 1"

# The same levels, top-down: each group's share of good pages shrunk to the one around it.
HOST_REPUTATION = rf"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
l AS (SELECT doc_id, max(coalesce(quality, 1) <> 1 OR coalesce(toxic, 0) <> 0) AS bad FROM labels
  WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
h AS (
  SELECT host, count(bad) AS n, count(*) FILTER (WHERE NOT bad) AS good
  FROM (SELECT host, try_cast(regexp_extract(path, '/([0-9]{{1,18}})(?:[.][a-z]+)?/?$', 1) AS BIGINT) AS k FROM u) AS k
  LEFT JOIN l ON l.doc_id = k.k GROUP BY host),
o AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), '(:[0-9]*)?[.]*$', '') AS bare FROM h),
hosts AS (
  SELECT host, n, good, array_to_string(string_split(bare, '.')[-2:], '.') AS domain, string_split(bare, '.')[-1] AS suffix FROM o),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(good) AS good, (sum(sum(good)) OVER () + 1) / (sum(sum(n)) OVER () + 1) AS p
  FROM domains GROUP BY suffix),
s1 AS (SELECT {_RHO} AS s FROM suffixes),
m1 AS (SELECT suffix, (good + p * s) / (n + s) AS p FROM suffixes, s1),
d2 AS (SELECT d.*, p FROM domains AS d JOIN m1 USING (suffix)),
s2 AS (SELECT {_RHO} AS s FROM d2),
m2 AS (SELECT domain, (good + p * s) / (n + s) AS p FROM d2, s2),
h3 AS (SELECT x.*, p FROM hosts AS x JOIN m2 USING (domain)),
s3 AS (SELECT {_RHO} AS s FROM h3),
m3 AS (SELECT host, n, (good + p * s) / (n + s) AS m, n + s AS w FROM h3, s3),
b AS (SELECT host, n, round(least(m + 1.645 * sqrt(m * (1 - m) / (w + 1)), 1), 6) AS bound FROM m3),
r AS (
  SELECT u.*, n, bound, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
  FROM u JOIN b USING (host))
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN bound < 0.6 THEN 'block' ELSE 'allow' END AS verdict, n::BIGINT AS n_labelled, bound::DOUBLE AS good_bound
FROM r
"""
