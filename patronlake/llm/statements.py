"""SQL for those queries of this package that SQL can express, over the same tables."""

from __future__ import annotations

from patronlake.llm import collocations, licenses, quality_rules
from patronlake.llm.anchors import SPAN
from patronlake.llm.queries import MIX

_BLANK_FREE = r"[^\x20\x09-\x0D]+"


def _ratio_sql(name: str) -> str:
    parts = {
        "n_words": "n_words", "repeat_ratio": "n_repeat_words / nullif(n_words, 0)",
        "word_length": "word_chars / nullif(n_words, 0)", "symbol_ratio": "n_symbols / nullif(n_words, 0)",
        "shout_ratio": "n_shouts / nullif(n_words, 0)", "dup_line_ratio": "n_dup_lines / nullif(n_lines, 0)",
        "stop_ratio": "n_stops / nullif(n_words, 0)",
    }
    return f"coalesce({parts[name]}, 0)"


def _rules_sql() -> str:
    conditions = []
    for rule in quality_rules.RULES:
        value = _ratio_sql(rule.name)
        bounds = [f"{value} >= {rule.least}"] if rule.least is not None else []
        bounds += [f"{value} <= {rule.most}"] if rule.most is not None else []
        fine = " AND ".join(bounds)
        conditions.append(f"({fine} OR n_words < {rule.words})" if rule.words else f"({fine})")
    return " AND ".join(conditions)


def _quality() -> str:
    stops = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)
    return rf"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '{_BLANK_FREE}') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_BLANK_FREE}')) AS lines
  FROM t
), windows AS (
  SELECT r, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5
), keyed AS (
  SELECT r, i, array_to_string(words[i:i + 4], ' ') AS k FROM windows
), repeated AS (
  SELECT r, i, i - lag(i, 1, -10) OVER (PARTITION BY r ORDER BY i) AS gap
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM keyed) WHERE c > 1
), covered AS (
  SELECT r, sum(least(5, gap)) AS n FROM repeated GROUP BY r
), counted AS (
  SELECT w.doc_id, len(words) AS n_words,
         length(array_to_string(words, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(text) - length(replace(text, '!', '')) AS n_shouts,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         len(list_filter(words, lambda x: lower(x) IN ({stops}))) AS n_stops,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered USING (r)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_rules_sql()} AS kept
FROM judged"""


def _warc() -> str:
    return """
WITH t AS (
  SELECT row_number() OVER (ORDER BY page_id, url) AS r, page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT *, sha1(payload) AS h FROM t
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST, r) AS k,
         max(page_id) OVER (PARTITION BY h) AS response
  FROM d
)
SELECT page_id, octet_length(payload) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
         (('0x' || substr(h || '0', (5 * k) // 4 + 1, 2))::INTEGER >> (3 - (5 * k) % 4)) & 31)::INTEGER, 1)), '')
         AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k > 1 THEN response END AS refers_to
FROM ranked"""


def _topk() -> str:
    return """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.w, c.w)::BIGINT AS score
  FROM v AS q JOIN v AS c ON q.r <> c.r WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 5"""


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _licenses() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    places, labels = [], []
    for phrase, label in licenses.PHRASES.items():
        words = phrase.split()
        same = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(words, 1))
        places.append(f"list_filter(range(0, len(w)), lambda i: {same})")
        labels.append((label, len(places) - 1))
    base = ", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{label}' END" for label, i in labels)
    extra = ", ".join(
        f"CASE WHEN regexp_matches(t, '{licenses.template_pattern(template)}') THEN '{label}' END"
        for label, template in licenses.TEMPLATES.items()
    )
    found = ", ".join(f"{p} AS p{i}" for i, p in enumerate(places))
    every = "list_concat(" * (len(places) - 1) + "p0" + "".join(f", p{i})" for i in range(1, len(places)))
    clean = "lambda x: x IS NOT NULL"
    return rf"""
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents
), s AS (
  SELECT *, regexp_extract_all(t, '{word}') AS w FROM d
), p AS (
  SELECT *, {found} FROM s
), l AS (
  SELECT *, {every} AS places, list_filter([{base}], {clean}) AS base, list_filter([{extra}], {clean}) AS extra FROM p
)
SELECT doc_id, len(w) AS n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
       array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(base, extra))), ',') AS labels,
       CASE WHEN len(extra) > 0 THEN 1.0::DOUBLE WHEN len(base) > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM l"""


def _case(column: str, given: dict, default: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in given.items())
    return f"CASE {column} {cases} ELSE {default} END" if given else default


def _dealt(level: str, by: list[str], parent: str, weight: str) -> str:
    """Budgets of one level of the tree from its parent's; the same rule as whole-number SQL."""
    keys = ", ".join(by)
    part = f"PARTITION BY {keys}" if by else ""
    join = " AND ".join(f"c.{k} IS NOT DISTINCT FROM b.{k}" for k in by) or "true"
    columns = "".join(f"c.{k}, " for k in by)
    order = f"ORDER BY CASE WHEN w > 0 THEN capacity::DOUBLE / w END NULLS LAST, {level} NULLS FIRST"
    return f"""
{level}_c AS (
  SELECT {keys + ", " if by else ""}{level}, sum(capacity)::HUGEINT AS capacity, ({weight})::HUGEINT AS w
  FROM supply GROUP BY {keys + ", " if by else ""}{level}
), {level}_o AS (
  SELECT {columns}c.{level}, c.capacity, c.w, b.budget FROM {level}_c AS c JOIN {parent} AS b ON {join}
), {level}_f AS (
  SELECT *, coalesce(sum(capacity) OVER ({part} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(w) OVER ({part} {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM {level}_o
), {level}_g AS (
  SELECT *, w > 0 AND capacity * open_weight <= (budget - before) * w AS is_full FROM {level}_f
), {level}_b AS (
  SELECT {keys + ", " if by else ""}{level}, CASE WHEN is_full THEN capacity ELSE coalesce(
    (budget - coalesce(sum(capacity) FILTER (is_full) OVER ({part}), 0)) * w
      // nullif(sum(w) FILTER (NOT is_full) OVER ({part}), 0), 0) END::HUGEINT AS budget
  FROM {level}_g
)"""


def _mixing() -> str:
    mix = MIX
    domain = _case("source", dict(mix.domains), f"'{mix.others}'")
    place = (
        f"('0x' || substr(md5(concat_ws(':', '{mix.seed}', (whole + 1)::VARCHAR, coalesce(doc_id::VARCHAR, 'null'))), 1, 15))"
        "::BIGINT"
    )
    lowest = "(-9223372036854775808)::BIGINT"
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {domain} AS domain, lang, source,
         len(regexp_extract_all(coalesce(text, ''), '{_BLANK_FREE}')) AS n_tokens
  FROM documents
), supply AS (
  SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * {mix.epochs} AS capacity
  FROM docs GROUP BY domain, lang, source
), total AS (
  SELECT coalesce(sum(tokens), 0)::HUGEINT * {mix.share} // 100 AS budget FROM supply
), {_dealt("domain", [], "total", _case("domain", dict(mix.domain_weights), "1"))},
{_dealt("lang", ["domain"], "domain_b", _case("lang", dict(mix.lang_weights), "1"))},
{_dealt("source", ["domain", "lang"], "lang_b", _case("source", dict(mix.source_weights), "1"))}, leaf AS (
  SELECT s.domain, s.lang, s.source, (b.budget // greatest(s.tokens, 1))::BIGINT AS whole,
         (b.budget % greatest(s.tokens, 1))::BIGINT AS rest
  FROM supply AS s JOIN source_b AS b ON s.domain IS NOT DISTINCT FROM b.domain
    AND s.lang IS NOT DISTINCT FROM b.lang AND s.source IS NOT DISTINCT FROM b.source
), placed AS (
  SELECT d.*, whole, rest, {place} AS place
  FROM docs AS d JOIN leaf AS l ON d.domain IS NOT DISTINCT FROM l.domain
    AND d.lang IS NOT DISTINCT FROM l.lang AND d.source IS NOT DISTINCT FROM l.source
), running AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, coalesce(doc_id, {lowest})
                                RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM placed
), used AS (
  SELECT *, whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS uses FROM running
)
SELECT doc_id, domain, lang, source, n_tokens, unnest(range(1, uses + 1)) AS epoch FROM used WHERE uses > 0"""


def _suffix_dedup() -> str:
    return f"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS o,
         hex(encode(coalesce(text, ''))) AS h
  FROM documents
), windows AS (
  SELECT r, o, i, substr(h, 2 * i + 1, {2 * SPAN}) AS s
  FROM (SELECT r, o, h, unnest(range(0, (length(h) // 2) - {SPAN - 1})) AS i FROM t WHERE length(h) >= {2 * SPAN})
), lost AS (
  SELECT r, i FROM (SELECT r, i, o, min(o) OVER (PARTITION BY s) AS least FROM windows) WHERE o > least
), islands AS (
  SELECT r, i, sum(CASE WHEN i > reach OR reach IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS island
  FROM (SELECT r, i, lag(i + {SPAN}) OVER (PARTITION BY r ORDER BY i) AS reach FROM lost)
), spans AS (
  SELECT r, island, min(i) AS a, max(i) + {SPAN} AS b FROM islands GROUP BY r, island
), edges AS (
  SELECT r, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans
  FROM spans GROUP BY r
), kept AS (
  SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
         CASE WHEN a IS NULL THEN h ELSE array_to_string(list_transform(range(1, len(a) + 2), lambda k:
           substr(h, 2 * coalesce(b[k - 1], 0) + 1,
                  2 * (coalesce(a[k], length(h) // 2) - coalesce(b[k - 1], 0)))), '') END AS rest
  FROM t LEFT JOIN edges USING (r)
)
SELECT doc_id, n_bytes, n_removed, n_spans, sha256(unhex(rest)) AS kept_sha256 FROM kept"""


def _vector_join() -> str:
    return """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_transform(range(1, len(q.w) + 1), lambda i: q.w[i] * c.w[i]) AS p
  FROM v AS q JOIN v AS c ON q.r <> c.r WHERE q.vec_id % 20 = 0
), scored AS (
  SELECT r, query_id, vec_id, list_reduce(p, lambda a, b: a + b) AS score FROM pairs
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 20"""


def _collocations() -> str:
    least, longest, first = collocations.LEAST, collocations.LONGEST, collocations.FIRST
    return rf"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents
), p AS (
  SELECT lang, unnest(regexp_extract_all(t, '[^.,;:!?
-]+')) AS piece FROM d
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM p
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w
), grams AS (
  SELECT lang, w[i:i + k - 1] AS g FROM (SELECT *, unnest(range(1, least({longest}, len(w) - i + 1) + 1)) AS k FROM starts)
), f AS (
  SELECT lang, g, count(*) AS f FROM grams GROUP BY lang, g HAVING count(*) >= {least}
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang
), cuts AS (
  SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1
), scored AS (
  SELECT c.lang, c.g, c.a, x.f AS l, y.f AS r, n, k, (1000 * c.a::HUGEINT * n // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts AS c JOIN f AS x ON x.lang = c.lang AND x.g = c.g[1:k]
  JOIN f AS y ON y.lang = c.lang AND y.g = c.g[k + 1:len(c.g)] JOIN totals AS t ON t.lang = c.lang
), lowest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS nth FROM scored) WHERE nth = 1
), inner_starts AS (
  SELECT lang, g, f, unnest(range(1, len(g))) AS i FROM f WHERE len(g) > 2
), inside AS (
  SELECT lang, g[i:j] AS g, max(f) AS longer FROM (
    SELECT lang, g, f, i, unnest(range(i + 1, len(g) + 1)) AS j FROM inner_starts
  ) WHERE j - i + 1 < len(g) GROUP BY lang, g[i:j]
), kept AS (
  SELECT s.lang, array_to_string(s.g, ' ') AS phrase, a, l, r, n, score
  FROM lowest AS s LEFT JOIN inside AS i ON i.lang = s.lang AND i.g = s.g
  WHERE longer IS NULL OR 100 * longer < 100 * a
)
SELECT * FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM kept
) WHERE rank <= {first}"""


def llm_statements() -> dict[str, str]:
    return {
        "op1_warc_archives": _warc(),
        "op3_exact_topk": _topk(),
        "op4_license_scan": _licenses(),
        "op7_quality_rules": _quality(),
        "op9_source_mix": _mixing(),
        "op10_suffix_dedup": _suffix_dedup(),
        "op11_vector_join": _vector_join(),
        "op13_collocations": _collocations(),
    }
