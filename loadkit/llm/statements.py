"""DuckDB SQL of the longer queries, built from parts."""

from __future__ import annotations

from loadkit.llm import ledger, merkle, resample
from loadkit.llm.common import LOWER, UPPER

# Enough for a million leaves in a tree.
_LEVELS = 5
_LOWERED = f"translate(text, '{UPPER}', '{LOWER}')"
# Step tables of CRC-32, reflected polynomial 0xEDB88320.
_CRC_TABLE = "SELECT list(list_reduce(range(8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS steps FROM range(256) r(i)"


def _crc32(bytes_: str) -> str:
    return f"xor(list_reduce({bytes_}, lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


def secrets() -> str:
    """Spans from the texts between matches: their lengths add up to the positions."""
    parts = []
    for no, rule in enumerate(ledger.RULES):
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        parts.append(f"SELECT r, {no} AS no, '{rule.kind}' AS kind, unnest(string_split_regex(t, {pattern})) AS gap, unnest(regexp_extract_all(t, {pattern})) AS hit, "
                     f"unnest(regexp_extract_all(t, {pattern}, {rule.group})) AS part, {rule.least} AS least, generate_subscripts(string_split_regex(t, {pattern}), 1) AS nth FROM texts WHERE regexp_matches(t, {pattern})")
    shown = "kind || ':' || start || ':' || \"end\""
    counts = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in ledger.BASE)
    sums = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in ledger.BASE)
    return f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
parts AS ({" UNION ALL ".join(parts)}),
placed AS (SELECT *, CAST(sum(length(gap) + coalesce(length(hit), 0)) OVER (PARTITION BY r, no ORDER BY nth) AS BIGINT) AS "end" FROM parts),
spans AS (SELECT r, no, kind, "end" - length(hit) AS start, "end" FROM placed WHERE hit IS NOT NULL AND length(part) >= least),
found AS (SELECT r, {sums}, string_agg({shown}, ',' ORDER BY start, no) FILTER (no < {len(ledger.BASE)}) AS base, string_agg({shown}, ',' ORDER BY start, no) AS spans FROM spans GROUP BY r)
SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM texts LEFT JOIN found USING (r)"""


def resampled() -> str:
    words = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format("coalesce(" + _LOWERED + ", '')")
    pairs = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    each = "list_transform(range(0, strlen(f)), lambda i: CAST('0x' || substr(hex(encode(f)), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))"
    k = resample.BUCKETS
    return f"""
WITH crc AS ({_CRC_TABLE}),
docs AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
goal AS (SELECT {words} AS w FROM benchmark),
a AS (SELECT r, f, count(*) AS n FROM (SELECT r, unnest({pairs}) AS f FROM docs) GROUP BY ALL),
b AS (SELECT f, count(*) AS n FROM (SELECT unnest({pairs}) AS f FROM goal) GROUP BY ALL),
names AS (SELECT f, {_crc32(each)} % {k} AS bucket FROM (SELECT f FROM a UNION SELECT f FROM b), crc),
sa AS (SELECT bucket, sum(n) AS s FROM a JOIN names USING (f) GROUP BY bucket),
sb AS (SELECT bucket, sum(n) AS t FROM b JOIN names USING (f) GROUP BY bucket),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT sum(s) FROM sa) + {k}.0::DOUBLE)
        / ((s + 1.0::DOUBLE) * (coalesce((SELECT sum(t) FROM sb), 0) + {k}.0::DOUBLE)))) AS BIGINT) AS gain
    FROM sa LEFT JOIN sb USING (bucket)
), means AS (
    SELECT r, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS mean FROM a JOIN names USING (f) JOIN gains USING (bucket) GROUP BY r
), scored AS (
    SELECT doc_id, CAST(greatest(2 * len(w) - 1, 0) AS BIGINT) AS n_features, coalesce(mean, 0) AS weight, len(w) >= {resample.LEAST_WORDS} AS eligible,
        coalesce(mean, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{resample.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM docs LEFT JOIN means USING (r)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id NULLS FIRST, weight, n_features) AS place, count(*) FILTER (eligible) OVER () AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN eligible AND place <= {resample.SHARE} * n // 100 THEN place END AS rank FROM placed"""


def _levels(name: str, by: str) -> str:
    """CTEs of a tree over `{{name}}0` (by, p, h, n): the nodes of each level, and what stands left and right of each."""
    out = []
    for k in range(_LEVELS):
        run = f"OVER (PARTITION BY {by}, p // {merkle.FAN} ORDER BY p ROWS BETWEEN"
        out.append(f"""{name}s{k} AS (SELECT *, coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lefts, coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rights FROM {name}{k}),
{name}{k + 1} AS (SELECT {by}, p // {merkle.FAN} AS p, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY p)) ELSE any_value(h) END AS h, (n + {merkle.FAN - 1}) // {merkle.FAN} AS n FROM {name}{k} GROUP BY {by}, p // {merkle.FAN}, n)""")
    return ",\n".join(out)


def _climb(name: str, source: str, by: str, place: str) -> str:
    """CTEs that carry `folded` and `proof` of each row of `source` up one tree."""
    out = []
    for k in range(_LEVELS):
        before = source if k == 0 else f"{name}c{k - 1}"
        out.append(f"""{name}c{k} AS (SELECT x.* REPLACE (CASE WHEN s.n > 1 THEN sha256(s.lefts || x.folded || s.rights) ELSE x.folded END AS folded, x.proof || s.lefts || s.rights AS proof)
    FROM {before} x JOIN {name}s{k} s ON {by} AND s.p = x.{place} // {merkle.FAN**k})""")
    return ",\n".join(out)


def manifest() -> str:
    def digest(text: str) -> str:
        values = ["doc_id", "source", "lang", "n_chars", text]
        return "sha256(" + " || ".join(f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR) END" for v in values) + ")"

    digits = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(unicode(c) AS BIGINT))"
    return f"""
WITH crc AS ({_CRC_TABLE}),
hashed AS (SELECT doc_id, source, {digest('text')} AS leaf, CASE WHEN {_crc32(digits)} % 5 = 0 THEN {digest(_LOWERED)} ELSE {digest('text')} END AS folded FROM documents, crc),
leaves AS (SELECT *, '' AS proof, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS n FROM hashed),
a0 AS (SELECT source, place AS p, leaf AS h, n FROM leaves),
{_levels("a", "source")},
roots AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS seat FROM a{_LEVELS}),
b0 AS (SELECT 0 AS one, seat AS p, subroot AS h, count(*) OVER () AS n FROM roots),
{_levels("b", "one")},
{_climb("a", "leaves", "s.source IS NOT DISTINCT FROM x.source", "place")},
joined AS (SELECT x.*, r.subroot, r.seat FROM ac{_LEVELS - 1} x JOIN roots r ON r.source IS NOT DISTINCT FROM x.source),
{_climb("b", "joined", "s.one = 0", "seat")}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified FROM bc{_LEVELS - 1}, b{_LEVELS}"""
