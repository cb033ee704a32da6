"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from . import contamination, mixing

_LINES = """
WITH base AS (
  SELECT doc_id, coalesce('h' || source, 'null') AS host, text, string_split(text, chr(10)) AS ls FROM documents
), pages AS (SELECT host, count(*) AS pages FROM base GROUP BY host),
lines AS (
  SELECT host, unnest(list_distinct(list_transform(ls, lambda x: trim(x, ' ' || chr(9) || chr(13))))) AS line FROM base
), boiler AS (
  SELECT host, list(line) AS bad FROM (
    SELECT host, line, count(*) AS c FROM lines WHERE line <> '' GROUP BY host, line
  ) JOIN pages USING (host) WHERE c >= 3 AND c > 0.1::DOUBLE * pages GROUP BY host
), kept AS (
  SELECT doc_id, ls, list_filter(ls, lambda x: bad IS NULL OR NOT list_contains(bad, trim(x, ' ' || chr(9) || chr(13)))) AS k
  FROM base LEFT JOIN boiler USING (host)
)
SELECT doc_id, array_to_string(k, chr(10)) AS text, coalesce(len(ls), 0)::BIGINT AS n_lines,
  coalesce(len(ls) - len(k), 0)::BIGINT AS n_dropped FROM kept
"""

_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
_SHINGLES = "list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))"

_LEAKS = f"""
WITH d AS (SELECT doc_id, unnest(s) AS s FROM (SELECT doc_id, {_SHINGLES} AS s FROM (SELECT doc_id, {_WORDS} AS w FROM documents))),
i AS (SELECT item_id, s, len(s) AS n FROM (SELECT item_id, {_SHINGLES} AS s FROM (SELECT item_id, {_WORDS} AS w FROM benchmark))),
x AS (SELECT item_id, n, unnest(s) AS s FROM i)
SELECT doc_id, item_id, n::BIGINT AS n_item_shingles, count(*)::BIGINT AS n_shared, count(*) / n::DOUBLE AS containment
FROM d JOIN x USING (s) GROUP BY doc_id, item_id, n HAVING count(*) / n::DOUBLE >= {contamination.THRESHOLD}
"""


#: Sweeps that the SQL spells out; the tables it is run on need fewer.
SQL_SWEEPS = 40


def _reachable(x: str) -> list[str]:
    """A marginal's targets as far as values can supply them: those cut are the first by supply over share."""
    per = (
        f"v_{x} AS (SELECT {x}, t, pow(t, {mixing.ALPHA[x]}) AS share, t / {mixing.KEEP}::DOUBLE AS cap, t / {mixing.KEEP}::DOUBLE / pow(t, {mixing.ALPHA[x]}) AS ratio, "
        f"sum(t) OVER () AS total FROM (SELECT {x}, sum(tokens)::DOUBLE AS t FROM s0 GROUP BY {x}))"
    )
    # with the values below a ratio cut, the others share what is left at this level; the first ratio whose level cuts no more holds
    level = (
        f"l_{x} AS (SELECT level FROM (SELECT (any_value(a.total) - coalesce(sum(b.cap) FILTER (WHERE b.ratio < a.ratio), 0)) "
        f"/ sum(b.share) FILTER (WHERE b.ratio >= a.ratio) AS level, a.ratio FROM v_{x} a, v_{x} b GROUP BY a.ratio) WHERE level <= ratio ORDER BY ratio LIMIT 1)"
    )
    return [per, level, f"m_{x} AS MATERIALIZED (SELECT {x}, least((SELECT level FROM l_{x}) * share, cap) AS target, (SELECT level FROM l_{x}) * share >= cap AS cut FROM v_{x})"]


def _mix_sql() -> str:
    dims = mixing.DIMS
    d = ", ".join(dims)
    ctes = [
        r"""tok AS MATERIALIZED (SELECT doc_id, text, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
  len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\r]+')) AS n, length(text) - length(replace(text, '|', '')) AS bars FROM documents)""",
        """base AS MATERIALIZED (SELECT doc_id, text, source, lang, CASE WHEN n = 0 THEN 'empty' WHEN bars * 4 >= n THEN 'tabular'
  WHEN n < 100 THEN 'note' WHEN n < 1000 THEN 'article' ELSE 'long' END AS topic, greatest(n, 1)::BIGINT AS tokens FROM tok)""",
        f"s0 AS MATERIALIZED (SELECT {d}, sum(tokens)::BIGINT AS tokens, sum(tokens)::DOUBLE AS weight FROM base GROUP BY {d})",
    ]
    for x in dims:
        ctes += _reachable(x)
    cells = ", ".join(f"p.{x}" for x in dims)
    joins = lambda t: " ".join(f"JOIN {t}_{x} USING ({x})" for x in dims)
    ctes.append(f"g AS MATERIALIZED (SELECT {cells}, p.tokens, {' OR '.join(f'm_{x}.cut' for x in dims)} AS given FROM s0 p {joins('m')})")
    for x in dims:  # cells of a cut value give all, unless they alone would pass another target
        ctes.append(
            f"f_{x} AS (SELECT {x}, coalesce(sum(tokens / {mixing.KEEP}::DOUBLE) FILTER (WHERE given), 0) <= any_value(m_{x}.target) * (1 + 1e-9) AS fits FROM g JOIN m_{x} USING ({x}) GROUP BY {x})"
        )
    held = " AND ".join(["p.given", *(f"f_{x}.fits" for x in dims)])
    ctes.append(f"h AS MATERIALIZED (SELECT {cells}, p.tokens, {held} AS held FROM g p {joins('f')})")
    ctes.append(f"start AS MATERIALIZED (SELECT *, CASE WHEN held THEN tokens / {mixing.KEEP}::DOUBLE ELSE tokens::DOUBLE END AS weight FROM h)")
    prev, done = "start", "FALSE"
    for k in range(SQL_SWEEPS):  # a sweep after the last one that is needed changes nothing
        start = prev
        for x in dims:
            name = f"s{k}_{x}"
            ctes.append(
                f"{name} AS MATERIALIZED (SELECT {cells}, p.tokens, p.held, CASE WHEN p.held THEN p.weight ELSE "
                f"p.weight * CASE WHEN h.free > 0 THEN greatest(m.target - h.fixed, 0) / h.free ELSE 0 END END AS weight FROM {prev} p "
                f"JOIN (SELECT {x}, coalesce(sum(weight) FILTER (WHERE held), 0) AS fixed, coalesce(sum(weight) FILTER (WHERE NOT held), 0) AS free "
                f"FROM {prev} GROUP BY {x}) h ON h.{x} = p.{x} JOIN m_{x} m ON m.{x} = p.{x})"
            )
            prev = name
        keys = " AND ".join(f"p.{y} = q.{y}" for y in dims)
        ctes.append(
            f"s{k}_end AS MATERIALIZED (SELECT {cells}, p.tokens, p.held, CASE WHEN {done} THEN q.weight "
            f"ELSE least(p.weight, p.tokens / {mixing.KEEP}::DOUBLE) END AS weight FROM {prev} p JOIN {start} q ON {keys})"
        )
        prev = f"s{k}_end"
        off = " UNION ALL ".join(
            f"SELECT abs(h.have - m.target) AS off FROM (SELECT {x}, sum(weight) AS have FROM {prev} GROUP BY {x}) h JOIN m_{x} m ON m.{x} = h.{x}" for x in dims
        )
        before = f"(SELECT off FROM d{k - 1})" if k else "'inf'::DOUBLE"
        least = f"{mixing.TOLERANCE}::DOUBLE * (SELECT sum(tokens) FROM s0)"
        ctes.append(
            f"d{k} AS MATERIALIZED (SELECT off, off <= {least} OR abs({before} - off) <= {mixing.STALL}::DOUBLE * {least} AS done FROM (SELECT max(off) AS off FROM ({off}) o) x)"
        )
        done = f"(SELECT done FROM d{k})"
    ctes.append(f"probs AS (SELECT {d}, least(1.0::DOUBLE, {mixing.KEEP}::DOUBLE * weight / tokens) AS prob FROM {prev})")
    return "WITH " + ",\n".join(ctes) + (
        f"\nSELECT doc_id, {d}, tokens, round(prob, 6) AS prob, "
        "('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, md5(text), '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE < prob AS sampled "
        f"FROM base JOIN probs USING ({d})"
    )


_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to FROM m
"""


_MIDDLE = """
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), x AS (
  SELECT doc_id, t, w, len(w)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM u
), c AS (
  SELECT doc_id, t, w, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM x
), p AS (
  SELECT *, array_to_string(list_slice(w, 1, a), '') AS pre, array_to_string(list_slice(w, a + 1, b), '') AS mid,
    array_to_string(list_slice(w, b + 1, n), '') AS suf FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": _LINES, "op4_warc": _WARC, "op6_mixing": _mix_sql(), "op10_decontamination": _LEAKS, "op13_fill_in_middle": _MIDDLE}
