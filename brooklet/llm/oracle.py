"""The results of some operators as SQL text, for checking in another engine."""

from __future__ import annotations

import string

WHITE = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase

LINE_DEDUP = f"""WITH lines AS (
    SELECT doc_id, pos, lines[pos] AS line,
      translate(trim(lines[pos], {WHITE}), '{UPPER}', '{LOWER}') AS key
    FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos
      FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
  holders AS (SELECT key, min(doc_id) AS first, max(doc_id) AS last FROM lines
    WHERE length(key) >= 10 GROUP BY key),
  marked AS (SELECT lines.*, coalesce(first < last AND doc_id > first, false) AS dropped
    FROM lines LEFT JOIN holders USING (key))
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
  FROM marked GROUP BY doc_id"""

SHINGLES = f"""words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
      '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
  grams AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS gram
    FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM words WHERE len(w) > 0))"""

NGRAM_JOIN = f"""WITH RECURSIVE {SHINGLES},
  sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
  shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a
    JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
  links AS (SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
    WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)),
  reached AS (SELECT DISTINCT a AS doc_id, a AS other FROM links
    UNION SELECT doc_id, b FROM reached JOIN links ON other = a)
  SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(least(component, doc_id), doc_id) AS component_id
  FROM documents LEFT JOIN sizes USING (doc_id)
  LEFT JOIN (SELECT doc_id, min(other) AS component FROM reached GROUP BY doc_id) USING (doc_id)"""


def _sets(table: str, key: str, short: bool = False) -> str:
    """Five-word shingles, or of fewer words the whole sequence; ``short``: besides, all shorter sequences."""
    words = "list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
    lengths = "unnest(range(1, least(5, len(w)) + 1))" if short else "least(5, len(w))"
    return f"""(SELECT DISTINCT {key}, array_to_string(w[i : i + k - 1], ' ') AS gram
    FROM (SELECT {key}, w, k, unnest(range(1, len(w) - k + 2)) AS i
      FROM (SELECT {key}, w, {lengths} AS k FROM (SELECT {key}, {words} AS w FROM {table}) WHERE len(w) > 0)))"""


DECONTAMINATION = f"""WITH items AS {_sets("benchmark", "item_id")}, docs AS {_sets("documents", "doc_id", True)},
  sizes AS (SELECT item_id, count(*) AS n_grams FROM items GROUP BY item_id),
  shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM docs JOIN items USING (gram) GROUP BY 1, 2)
  SELECT doc_id, item_id, n_grams, n_shared, n_shared / n_grams AS containment
  FROM shared JOIN sizes USING (item_id) WHERE 100 * n_shared >= 75 * n_grams"""

COLLOCATIONS = f"""WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
      unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
  words AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
  totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
  grams AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS g
    FROM (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i
      FROM (SELECT lang, w, unnest(range(1, 5)) AS k FROM words))),
  f AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
  spans AS (SELECT lang, f, k, i, m, string_split(g, ' ') AS w
    FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(1, k)) AS m FROM f))),
  parts AS (SELECT lang, f, k, i, m, array_to_string(w, ' ') AS g, array_to_string(w[i : i + m - 1], ' ') AS part,
      array_to_string(w[m + 1 :], ' ') AS rest FROM spans),
  cuts AS (SELECT p.lang, p.g AS phrase, p.m AS cut, p.f AS a, x.f AS l, y.f AS r,
      CAST((CAST(p.f AS HUGEINT) * 2000000) // (x.f + y.f) AS BIGINT) AS score
    FROM parts p JOIN f x ON x.lang = p.lang AND x.g = p.part JOIN f y ON y.lang = p.lang AND y.g = p.rest
    WHERE p.i = 1),
  lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
  covers AS (SELECT lang, part AS phrase, max(f) AS f FROM parts WHERE m > 1 GROUP BY ALL),
  kept AS (SELECT lowest.* FROM lowest LEFT JOIN covers USING (lang, phrase)
    WHERE NOT coalesce(CAST(covers.f AS HUGEINT) * 100 >= CAST(a AS HUGEINT) * 80, false)),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
  SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""
