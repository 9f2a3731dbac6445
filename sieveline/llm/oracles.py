"""The same in SQL, for the operators that SQL can express over whole tables."""

from __future__ import annotations

from .leakage import MIN_WORDS
from .repetition import GRAM
from .similarity import SHINGLE
from .spans import WINDOW

_LIVE = "text IS NOT NULL AND regexp_replace(text, '[\\s\\x{1c}-\\x{1f}\\x{85}\\p{Z}]+', '', 'g') <> ''"
#: Words are runs of letters and digits; the four letters i are one.
_WORDS = "regexp_extract_all(lower(translate(text, 'Iıİ', 'iii')), '[\\p{L}\\p{N}]+')"


def _grams(table: str, key: str, n: int) -> str:
    """Each run of n words of a text, with its place."""
    return (
        f"SELECT {key}, i, array_to_string(w[i:(i + {n - 1})], ' ') AS gram FROM "
        f"(SELECT {key}, w, unnest(generate_series(1, len(w) - {n - 1})) AS i FROM (SELECT {key}, {_WORDS} AS w FROM {table} WHERE text IS NOT NULL))"
    )


def _near_duplicates() -> str:
    """Exact prefix filter: two sets at the threshold share one of each set's rarest elements, a fifth of them and one."""
    strip = "regexp_replace(text, '^[\\s\\x{1c}-\\x{1f}\\x{85}\\p{Z}]+|[\\s\\x{1c}-\\x{1f}\\x{85}\\p{Z}]+$', '', 'g')"
    return (
        f"WITH d AS (SELECT doc_id, lower(replace({strip}, 'İ', 'i' || chr(775))) AS k FROM documents WHERE {_LIVE}), "
        "u AS (SELECT k, min(doc_id) AS id FROM d GROUP BY k), "
        f"e AS (SELECT id, unnest(CASE WHEN length(k) < {SHINGLE} THEN [k] ELSE list_distinct(list_transform(generate_series(1, length(k) - {SHINGLE - 1}), lambda i: substr(k, i, {SHINGLE}))) END) AS x FROM u), "
        "f AS (SELECT x, count(*) AS df FROM e GROUP BY x), n AS (SELECT id, count(*) AS n FROM e GROUP BY id), "
        "r AS (SELECT e.id, e.x, n.n, row_number() OVER (PARTITION BY e.id ORDER BY f.df, e.x) AS place FROM e JOIN f USING (x) JOIN n ON n.id = e.id), "
        "p AS (SELECT id, x, n FROM r WHERE place <= n - ceil(0.8 * n) + 1), "
        "c AS (SELECT DISTINCT a.id AS a, b.id AS b FROM p a JOIN p b ON a.x = b.x AND a.id < b.id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)), "
        "s AS (SELECT a, b, count(*) AS n_both FROM c JOIN e x ON x.id = c.a JOIN e y ON y.id = c.b AND y.x = x.x GROUP BY a, b), "
        "l AS (SELECT s.a, s.b FROM s JOIN n x ON x.id = s.a JOIN n y ON y.id = s.b WHERE 5 * n_both >= 4 * (x.n + y.n - n_both)), "
        "m AS (SELECT doc_id, id FROM d JOIN u USING (k)), "
        "q AS (SELECT x.doc_id AS x, y.doc_id AS y FROM m x JOIN m y ON x.id = y.id AND x.doc_id < y.doc_id UNION ALL SELECT x.doc_id, y.doc_id FROM l JOIN m x ON x.id = l.a JOIN m y ON y.id = l.b) "
        "SELECT least(x, y) AS doc_a, greatest(x, y) AS doc_b FROM q"
    )


def _shared() -> str:
    """Islands of the characters that lie in a window which stands in two documents."""
    return (
        f"WITH w AS (SELECT doc_id, i, md5(substr(text, i, {WINDOW})) AS h FROM (SELECT doc_id, text, unnest(generate_series(1, length(text) - {WINDOW - 1})) AS i FROM documents WHERE text IS NOT NULL)), "
        "t AS (SELECT h FROM w GROUP BY h HAVING min(doc_id) <> max(doc_id)), "
        "s AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM w WHERE h IN (SELECT h FROM t)), "
        f"g AS (SELECT doc_id, i, count(*) FILTER (WHERE before IS NULL OR i - before > {WINDOW}) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM s), "
        f"spans AS (SELECT doc_id, (min(i) - 1)::bigint AS span_start, (max(i) - 1 + {WINDOW})::bigint AS span_end FROM g GROUP BY doc_id, island)"
    )


def oracle_sql() -> dict[str, str]:
    leaks = f"WITH d AS ({_grams('documents', 'doc_id', MIN_WORDS)}), b AS ({_grams('benchmark', 'item_id', MIN_WORDS)}), found AS (SELECT DISTINCT d.doc_id, b.item_id FROM d JOIN b USING (gram))"
    repeated = (
        f"WITH g AS ({_grams('documents', 'doc_id', GRAM)}), a AS (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id, gram ORDER BY i) > 1 AS again FROM g), "
        f"c AS (SELECT doc_id, count(DISTINCT p) AS hit FROM (SELECT doc_id, unnest(generate_series(i, i + {GRAM - 1})) AS p FROM a WHERE again) GROUP BY doc_id), "
        f"n AS (SELECT doc_id, len({_WORDS}) AS n FROM documents WHERE text IS NOT NULL)"
    )
    return {
        "p1_found": _near_duplicates(),
        "p4_found": f"{repeated} SELECT doc_id FROM c JOIN n USING (doc_id) WHERE hit >= 0.3 * n",
        "p8_found": f"{leaks} SELECT doc_id, item_id FROM found",
        "p8_items": f"{leaks}, m AS (SELECT d.doc_id, b.item_id, d.i, d.i - b.i AS shift FROM d JOIN b USING (gram)), r AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, item_id, shift ORDER BY i) AS run FROM m), "
        f"l AS (SELECT doc_id, item_id, max(n) AS n FROM (SELECT doc_id, item_id, count(*) + {MIN_WORDS - 1} AS n FROM r GROUP BY doc_id, item_id, shift, run) GROUP BY doc_id, item_id), c AS (SELECT item_id, count(*) AS n_docs, max(n) AS longest_words FROM l GROUP BY item_id) "
        "SELECT i.item_id, coalesce(n_docs, 0)::bigint AS n_docs, coalesce(longest_words, 0)::int AS longest_words FROM (SELECT DISTINCT item_id FROM benchmark WHERE item_id IS NOT NULL) i LEFT JOIN c USING (item_id)",
        "p10_found": f"{_shared()} SELECT doc_id, span_start, span_end FROM spans",
        "p10_shares": f"{_shared()}, x AS (SELECT doc_id, sum(span_end - span_start)::bigint AS n FROM spans GROUP BY doc_id) "
        f"SELECT doc_id, length(text) AS n_chars, coalesce(n, 0)::bigint AS shared_chars, coalesce(n, 0) / length(text) AS shared_share FROM documents LEFT JOIN x USING (doc_id) WHERE {_LIVE}",
    }
