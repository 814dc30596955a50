"""DuckDB SQL of the queries that SQL can express, built from the operators' own parameters."""

from __future__ import annotations

from knotwork.llm import codes, rules


def op11_rules() -> str:
    """Counts by unnested words, binomial tails by sums over every number of failures."""
    shares = {"symbols": "n_symbols * 1000 // greatest(n_words, 1)", "lines": "n_dup_lines * 1000 // greatest(n_lines, 1)", "repeats": "n_repeat_words * 1000 // greatest(n_words, 1)", "capitals": "n_capitals * 1000 // greatest(word_chars, 1)"}
    level = ", ".join(f"len(list_filter({rules.cutoffs(k)}, lambda c: c >= {x}))" for k, x in shares.items())
    classes = "".join(f"WHEN n_words >= {n} THEN '{n}' " for n in sorted(rules.LENGTHS, reverse=True))
    return rf"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
s AS (
    SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
t AS (
    SELECT rid, i, w, lead(w) OVER o AS w1, lead(w, 2) OVER o AS w2
    FROM (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM s) WINDOW o AS (PARTITION BY rid ORDER BY i)),
r AS (
    SELECT rid, count(DISTINCT i + k) AS n
    FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w, w1, w2) AS c FROM t WHERE w2 IS NOT NULL) CROSS JOIN (VALUES (0), (1), (2)) x(k)
    WHERE c > 1 GROUP BY rid),
f AS (
    SELECT d.rid, doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
        coalesce(r.n, 0) AS n_repeat_words, len(ls) AS n_lines, len(regexp_extract_all(text, '\p{{Lu}}')) AS n_capitals
    FROM d JOIN s USING (rid) LEFT JOIN r USING (rid)),
g AS (
    SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.REPEATED} * n_words AS base_failed,
        CASE {classes}ELSE '0' END AS stratum, least({level}) AS level
    FROM f),
y AS (
    SELECT doc_id, avg(quality) >= 0.5 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
m AS (
    SELECT stratum, x.k, count(*) FILTER (good) AS n_good, count(*) FILTER (NOT good) AS n_bad,
        count(*) FILTER (good AND level <= x.k) AS fp, count(*) FILTER (NOT good AND level <= x.k) AS tp
    FROM g JOIN y USING (doc_id) CROSS JOIN range({rules.LEVELS}) x(k) WHERE NOT base_failed GROUP BY stratum, x.k),
p AS (
    SELECT stratum, j, exp(n_good * ln(1 - {rules.RISK}::DOUBLE) + j * ln({rules.RISK}::DOUBLE / (1 - {rules.RISK}::DOUBLE))
        + sum(CASE WHEN j > 0 THEN ln((n_good - j + 1)::DOUBLE / j) ELSE 0 END) OVER (PARTITION BY stratum ORDER BY j)) AS p
    FROM (SELECT stratum, n_good, unnest(range(n_good + 1)) AS j FROM (SELECT DISTINCT stratum, n_good FROM m))),
q AS (
    SELECT m.*, fp >= n_good * {rules.RISK}::DOUBLE OR
        (SELECT sum(p) FROM p WHERE p.stratum = m.stratum AND j <= m.fp) > {rules.CONFIDENCE}::DOUBLE / (SELECT count(DISTINCT stratum) FROM m) AS fails
    FROM m),
h AS (
    SELECT *, bool_or(fails) OVER (PARTITION BY stratum ORDER BY k) AS ended FROM q),
b AS (
    SELECT stratum, arg_max(k, (tp * n_good - {rules.HARM} * fp * n_bad) * {rules.LEVELS} - k) AS picked FROM h WHERE NOT ended GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND level > coalesce(picked, -1) AS kept, stratum, CAST(level AS INTEGER) AS level
FROM g LEFT JOIN b USING (stratum)"""


def op13_codes() -> str:
    """Every distance in integers: rows by component, joined with every entry of a part."""
    step = """
d{k} AS (SELECT rid, part, e, sum((x - c) * (x - c)) AS d FROM p JOIN b{k} USING (part, i) GROUP BY rid, part, e),
a{k} AS (SELECT rid, part, min(d * 65536 + e) % 65536 AS e, min(d) AS d FROM d{k} GROUP BY rid, part),"""
    move = """
b{n} AS (
    SELECT part, e, i, coalesce(CAST(floor(s / n) AS BIGINT), c) AS c
    FROM b{k} LEFT JOIN (SELECT part, e, i, sum(x)::DOUBLE AS s, count(*) AS n FROM a{k} JOIN p USING (rid, part) GROUP BY part, e, i) USING (part, e, i)),"""
    rounds = "".join(step.format(k=k) + (move.format(k=k, n=k + 1) if k < codes.ROUNDS else "") for k in range(codes.ROUNDS + 1))
    last = codes.ROUNDS
    return f"""
WITH v AS (
    SELECT row_number() OVER () AS rid, vec_id, label, embedding AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (
    SELECT rid, vec_id, len(v) // {codes.PARTS} AS width, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS i FROM v),
p AS (
    SELECT rid, vec_id, i // width AS part, i % width AS i, CAST(floor({codes.SCALE}::DOUBLE * x) AS BIGINT) AS x FROM u),
b0 AS (
    SELECT part, row_number() OVER (PARTITION BY part, i ORDER BY vec_id) - 1 AS e, i, x AS c FROM p QUALIFY e < {codes.ENTRIES}),{rounds}
r AS (
    SELECT rid, string_agg(format('{{:02x}}', CAST(e AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{last} GROUP BY rid)
SELECT vec_id, label, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, e, i)) FROM b{last}) AS codebooks_sha256
FROM v JOIN r USING (rid)"""
