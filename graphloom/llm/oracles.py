"""DuckDB SQL that computes what some of the queries return, written independently of them."""

from .mixing import OP9_SQL  # noqa: F401

OP2_SQL = """
WITH RECURSIVE x AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda t: t IS NULL OR NOT isfinite(t))) = 0 AND len(list_filter(embedding, lambda t: t <> 0)) > 0),
link AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM x a JOIN x b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach(id, to_id) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.id, link.b FROM reach JOIN link ON link.a = reach.to_id),
low AS (SELECT id, min(to_id) AS component_id FROM reach GROUP BY id),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, low.component_id, e.vec_id = low.component_id AS kept
FROM embeddings e JOIN low ON low.id = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""

OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS hex FROM p),
b AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, (5 * i + 1)::INT, 5))::BIGINT >> s) & 31) + 1)::INT, 1)), '')), '') AS payload_digest FROM h),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM b)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM f
"""

OP5_SQL = r"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, p, sha256(array_to_string(w[p:p + 12], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS p FROM d)),
f AS MATERIALIZED (SELECT h, min(doc_id) AS low FROM s GROUP BY h),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p FROM s JOIN f USING (h) WHERE low < doc_id),
kept AS (
  SELECT t.doc_id, string_agg(t.x, ' ' ORDER BY t.p) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) t LEFT JOIN gone g ON g.doc_id = t.doc_id AND g.p = t.p
  WHERE g.p IS NULL GROUP BY t.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP8_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM benchmark WHERE text IS NOT NULL),
i AS MATERIALIZED (SELECT q, item_id, w, least(5, len(w)) AS k, len(w) - least(5, len(w)) + 1 AS m FROM t WHERE len(w) > 0),
item_shingle AS MATERIALIZED (
  SELECT q, k, g, count(*) AS c FROM (SELECT q, k, array_to_string(w[p:p + k - 1], ' ') AS g FROM (SELECT q, k, w, unnest(range(1, m + 1)) AS p FROM i)) GROUP BY ALL),
shingle AS MATERIALIZED (
  SELECT r, k, p, array_to_string(w[p:p + k - 1], ' ') AS g FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM i))),
met AS MATERIALIZED (  -- item shingles in texts, and how many shingles a window and the text have
  SELECT s.r, x.q, s.p, s.g, x.c, i.m, least(i.m, len(d.w) - i.k + 1) AS size, len(d.w) - i.k + 1 AS n
  FROM shingle s JOIN item_shingle x ON x.k = s.k AND x.g = s.g JOIN i ON i.q = x.q JOIN d ON d.r = s.r),
seen AS (SELECT r, q, g, c, m, size, unnest(range(greatest(p - size + 1, 1), least(p, n - size + 1) + 1)) AS f FROM met),
counted AS (SELECT r, q, f, m, size, sum(least(times, c)) AS both_have FROM (SELECT r, q, f, g, c, m, size, count(*) AS times FROM seen GROUP BY ALL) GROUP BY ALL),
alike AS (SELECT r, q, f, both_have::DOUBLE / (size + m - both_have)::DOUBLE AS similarity FROM counted)
SELECT d.doc_id, i.item_id, (f - 1)::BIGINT AS first_word, similarity
FROM alike JOIN d USING (r) JOIN i USING (q) WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY r, q ORDER BY similarity DESC, f) = 1
"""


def _hits(name: str, pattern: str) -> str:
    """(r, x, start, stop) of a pattern's matches, in code points: what stands before a match is its piece of the split text."""
    return f"""{name} AS MATERIALIZED (
  SELECT r, x, stop - length(x) AS start, stop FROM (
    SELECT r, x, sum(length(piece) + length(x)) OVER (PARTITION BY r ORDER BY i) AS stop FROM (
      SELECT r, unnest(xs) AS x, unnest(pieces[1:len(xs)]) AS piece, unnest(range(len(xs))) AS i
      FROM (SELECT r, regexp_extract_all(text, '{pattern}') AS xs, string_split_regex(text, '{pattern}') AS pieces FROM d))))"""


_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _normal(z: str) -> str:
    """P(|Z| >= |z|), Abramowitz and Stegun 7.1.26."""
    x = f"(abs({z}) / sqrt(2.0::DOUBLE))"
    t = f"(1 / (1 + 0.3275911::DOUBLE * {x}))"
    powers = " + ".join(f"{a}::DOUBLE * pow({t}, {i})" for i, a in enumerate(("0.254829592", "(-0.284496736)", "1.421413741", "(-1.453152027)", "1.061405429"), 1))
    return f"greatest(({powers}) * exp(-{x} * {x}), 1e-12::DOUBLE)"


def _chi_squared(z: str) -> str:
    return f"CASE WHEN {z} > 0 THEN {_normal(z)} / 2 ELSE 1 - {_normal(z)} / 2 END"


def _wilson(chi: str, df: str) -> str:
    return f"(pow({chi} / {df}, 1.0::DOUBLE / 3) - (1 - 2 / (9.0::DOUBLE * {df}))) / sqrt(2 / (9.0::DOUBLE * {df}))"


OP7_SQL = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
{_hits("assign", _ASSIGN)},
{_hits("access", "AKIA[A-Z0-9]+")},
{_hits("hex", "[0-9a-f]+")},
{_hits("run", "[A-Za-z0-9+/_-]{20,}={0,2}")},
base AS MATERIALIZED (
  SELECT r, 0 AS kind, start, stop FROM assign WHERE length(regexp_extract(x, '{_ASSIGN}', 2)) >= 6
  UNION ALL SELECT r, 1, start, stop FROM access WHERE length(x) >= 20
  UNION ALL SELECT r, 2, start, stop FROM hex WHERE length(x) >= 24),
bare AS (
  SELECT row_number() OVER () AS q, r, start, stop,
    CASE WHEN regexp_full_match(x, '[0-9A-Fa-f]{{8}}(-[0-9A-Fa-f]{{4}}){{3}}-[0-9A-Fa-f]{{12}}') THEN replace(x, '-', '') ELSE replace(translate(x, '-_', '+/'), '=', '') END AS t FROM run),
guessed AS MATERIALIZED (
  SELECT *, CASE
    WHEN NOT regexp_matches(t, '[A-Za-z0-9]') THEN ''
    WHEN regexp_full_match(t, '[0-9]+') THEN '0123456789'
    WHEN regexp_full_match(t, '[a-z]+') THEN 'abcdefghijklmnopqrstuvwxyz'
    WHEN regexp_full_match(t, '[A-Z]+') THEN 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'
    WHEN regexp_full_match(t, '[A-Za-z]+') THEN 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz'
    WHEN regexp_full_match(t, '[0-9a-f]+') THEN '0123456789abcdef'
    WHEN regexp_full_match(t, '[0-9A-F]+') THEN '0123456789ABCDEF'
    WHEN regexp_full_match(t, '[A-Z2-7]+') THEN 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'
    WHEN regexp_full_match(t, '[A-Z0-9]+') THEN '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ'
    WHEN regexp_full_match(t, '[a-z0-9]+') THEN '0123456789abcdefghijklmnopqrstuvwxyz'
    WHEN regexp_full_match(t, '[a-z0-9+/]+') AND regexp_matches(t, '[0-9]') THEN 'abcdefghijklmnopqrstuvwxyz0123456789+/'
    WHEN regexp_full_match(t, '[A-Z0-9+/]+') AND regexp_matches(t, '[0-9]') THEN 'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/'
    ELSE 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/' END AS e FROM bare),
tested AS MATERIALIZED (SELECT *, length(t)::DOUBLE AS n, length(e)::DOUBLE AS k FROM guessed WHERE e <> '' AND length(t) * ln(length(e)) / ln(2) >= 80 - 1e-9),
letter AS MATERIALIZED (
  SELECT q, i, ch, v, k, lag(v) OVER (PARTITION BY q ORDER BY i) AS was, avg(v) OVER (PARTITION BY q) AS m
  FROM (SELECT q, i, ch, (instr(e, ch) - 1)::DOUBLE AS v, k FROM (SELECT q, e, k, substr(t, i::INT, 1) AS ch, i FROM (SELECT q, e, k, t, unnest(range(1, length(t) + 1)) AS i FROM tested)))),
sums AS (
  SELECT q, count(*) FILTER (WHERE v >= k / 2)::DOUBLE AS h, 1 + count(*) FILTER (WHERE was IS NOT NULL AND (v >= k / 2) <> (was >= k / 2)) AS runs,
    sum((v - m) * (v - m)) AS spread, coalesce(sum((v - m) * (was - m)), 0) AS lagged FROM letter GROUP BY q),
squares AS (SELECT q, sum(c * c)::DOUBLE AS s2 FROM (SELECT q, ch, count(*) AS c FROM letter GROUP BY q, ch) GROUP BY q),
class(name, set) AS (VALUES ('vowel', 'aeiou'), ('consonant', 'bcdfghjklmnpqrstvwxyz'), ('VOWEL', 'AEIOU'), ('CONSONANT', 'BCDFGHJKLMNPQRSTVWXYZ'), ('digit', '0123456789'), ('sign', '+/')),
share AS (SELECT q, n * (length(e) - length(translate(e, set, ''))) / k AS want, length(t) - length(translate(t, set, '')) AS have FROM tested, class),
kinds AS (SELECT q, count(*) AS c, sum((have - want) * (have - want) / want) AS chi FROM share WHERE want > 0 GROUP BY q),
z AS (
  SELECT x.q, x.r, x.start, x.stop, kinds.c, {_wilson('(k / n * s2 - n)', '(k - 1)')} AS by_letter, CASE WHEN kinds.c > 1 THEN {_wilson('chi', '(kinds.c - 1)')} END AS by_kind,
    CASE WHEN h * (n - h) * (2 * h * (n - h) - n) > 0 THEN (runs - (1 + 2 * h * (n - h) / n)) / sqrt(2 * h * (n - h) * (2 * h * (n - h) - n) / (n * n * (n - 1))) END AS by_runs,
    CASE WHEN spread > 0 THEN lagged / spread * sqrt(n) END AS by_lag
  FROM tested x JOIN sums USING (q) JOIN squares USING (q) JOIN kinds USING (q)),
three AS (
  SELECT q, r, start, stop, least(1, 2 * least({_chi_squared('by_letter')}, CASE WHEN c > 1 THEN {_chi_squared('by_kind')} ELSE 1 END)) AS p1,
    CASE WHEN by_runs IS NULL THEN 1e-12 ELSE {_normal('by_runs')} END AS p2, CASE WHEN by_lag IS NULL THEN 1e-12 ELSE {_normal('by_lag')} END AS p3 FROM z),
fisher AS MATERIALIZED (
  SELECT r, start, stop, least(63, floor(4 * ln(stop - start) / ln(2) + 1e-9)) AS cls, exp(-x) * (1 + x + x * x / 2) AS p FROM (SELECT *, -(ln(p1) + ln(p2) + ln(p3)) AS x FROM three)),
step AS (SELECT cls, s, sum(c) OVER (PARTITION BY cls ORDER BY s DESC) AS rank, sum(c) OVER (PARTITION BY cls) AS total
  FROM (SELECT cls, s, count(*) AS c FROM (SELECT cls, least(floor(-log10(greatest(p, 1e-300)) * 20), 480) AS s FROM fisher) GROUP BY cls, s)),
cut AS (SELECT cls, pow(10.0::DOUBLE, -min(s) / 20) AS p FROM step WHERE pow(10.0::DOUBLE, -s / 20) <= 0.05 * rank / total GROUP BY cls),
random AS (
  SELECT f.r, 3 AS kind, f.start, f.stop FROM fisher f LEFT JOIN cut USING (cls)
  WHERE f.p > coalesce(cut.p, 0) AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = f.r AND b.start < f.stop AND f.start < b.stop)),
written AS (SELECT r, kind, start, ['assign', 'access', 'hex', 'random'][kind + 1] || ':' || start::BIGINT || ':' || stop::BIGINT AS span FROM (SELECT * FROM base UNION ALL SELECT * FROM random)),
listed AS (
  SELECT r, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
    string_agg(span, ',' ORDER BY start, kind) FILTER (WHERE kind < 3) AS base, string_agg(span, ',' ORDER BY start, kind) AS spans FROM written GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (r)
"""


def _xxh64(table: str) -> str:
    """Steps (name AS (SELECT ...)) that take the table's (g, b: bytes in hex, n: their number) to (g, h), XXH64 with seed 42.

    Products and shifts of 64-bit numbers are taken in 128 bits and cut.
    """
    # fixed values of the hash: its five primes
    p1, p2, p3, p4, p5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
    mod = 1 << 64
    seed = 42

    def cut(x: str) -> str:
        return f"(({x}) % {mod}::UHUGEINT)"

    def times(x: str, p: int) -> str:
        return cut(f"({x})::UHUGEINT * {p}::UHUGEINT")

    def rotated(x: str, by: int) -> str:
        return cut(f"{x} * {1 << by}::UHUGEINT + {x} // {1 << (64 - by)}::UHUGEINT")

    def plus(x: str, y: str) -> str:
        return cut(f"({x}) + ({y})")

    def number(o: str, size: int) -> str:
        """Little-endian number of `size` bytes from byte `o`."""
        digits = " || ".join(f"substr(b, (2 * ({o} + {i}) + 1)::INT, 2)" for i in reversed(range(size)))
        return f"('0x' || {digits})::UBIGINT::UHUGEINT"

    steps = []
    # stripes of 32 bytes: four lanes
    start = [(seed + p1 + p2) % mod, (seed + p2) % mod, seed, (seed - p1) % mod]
    lanes = ", ".join(f"{v}::UHUGEINT AS v{i}" for i, v in enumerate(start))
    more = []
    for i in range(4):
        x = plus(f"v{i}", times(number(f"o + {8 * i}", 8), p2))
        more.append((x, i))
    turned = ", ".join(f"{times('x.r' + str(i), p1)}" for i in range(4))
    sums = ", ".join(f"r{i} := {x}" for x, i in more)
    steps.append(
        f"stripes AS (SELECT g, b, n, 0 AS o, {lanes} FROM {table} WHERE n >= 32 UNION ALL"
        f" SELECT g, b, n, o, {turned} FROM (SELECT g, b, n, o + 32 AS o, struct_pack({', '.join(f'r{i} := ' + rotated(f's.r{i}', 31) for i in range(4))}) AS x"
        f" FROM (SELECT g, b, n, o, struct_pack({sums}) AS s FROM stripes WHERE o + 32 <= n)))"
    )
    joined = plus(plus(rotated("v0", 1), rotated("v1", 7)), plus(rotated("v2", 12), rotated("v3", 18)))
    steps.append(f"m0 AS (SELECT g, b, n, o, v0, v1, v2, v3, {joined} AS h FROM stripes WHERE o + 32 > n)")
    for i in range(4):
        steps.append(f"r{i} AS (SELECT *, {times(f'v{i}', p2)} AS y FROM m{i})")
        steps.append(f"s{i} AS (SELECT * EXCLUDE (y), {times(rotated('y', 31), p1)} AS y FROM r{i})")
        steps.append(f"m{i + 1} AS (SELECT * EXCLUDE (y, h), {plus(times('xor(h, y)', p1), str(p4) + '::UHUGEINT')} AS h FROM s{i})")
    steps.append(
        f"l0 AS MATERIALIZED (SELECT g, b, n, o, {plus('h', 'n::UHUGEINT')} AS h FROM m4 UNION ALL"
        f" SELECT g, b, n, 0, {plus(f'{(seed + p5) % mod}::UHUGEINT', 'n::UHUGEINT')} FROM {table} WHERE n < 32)"
    )
    # what is left: up to three numbers of 8 bytes, one of 4, three bytes
    for i in range(3):
        steps.append(f"a{i} AS (SELECT *, CASE WHEN o + 8 <= n THEN {times(number('o', 8), p2)} END AS y FROM l{i})")
        steps.append(f"b{i} AS (SELECT * EXCLUDE (y), xor(h, {times(rotated('y', 31), p1)}) AS y FROM a{i})")
        steps.append(f"l{i + 1} AS MATERIALIZED (SELECT g, b, n, o + CASE WHEN y IS NULL THEN 0 ELSE 8 END AS o, coalesce({plus(times(rotated('y', 27), p1), str(p4) + '::UHUGEINT')}, h) AS h FROM b{i})")
    steps.append(f"f0 AS (SELECT *, CASE WHEN o + 4 <= n THEN xor(h, {times(number('o', 4), p1)}) END AS y FROM l3)")
    steps.append(f"e0 AS MATERIALIZED (SELECT g, b, n, o + CASE WHEN y IS NULL THEN 0 ELSE 4 END AS o, coalesce({plus(times(rotated('y', 23), p2), str(p3) + '::UHUGEINT')}, h) AS h FROM f0)")
    for i in range(3):
        steps.append(f"c{i} AS (SELECT *, CASE WHEN o < n THEN xor(h, {times(number('o', 1), p5)}) END AS y FROM e{i})")
        steps.append(f"e{i + 1} AS MATERIALIZED (SELECT g, b, n, o + CASE WHEN y IS NULL THEN 0 ELSE 1 END AS o, coalesce({times(rotated('y', 11), p1)}, h) AS h FROM c{i})")
    # avalanche
    steps.append(f"z0 AS (SELECT g, {times(f'xor(h, h // {1 << 33}::UHUGEINT)', p2)} AS h FROM e3)")
    steps.append(f"z1 AS (SELECT g, {times(f'xor(h, h // {1 << 29}::UHUGEINT)', p3)} AS h FROM z0)")
    steps.append(f"hashed AS MATERIALIZED (SELECT g, xor(h, h // {1 << 32}::UHUGEINT)::UBIGINT AS h FROM z1)")
    return ",\n".join(steps)


_LOWERED = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
_BIT = "CASE WHEN 2 * count(*) FILTER (WHERE h & {0}::UBIGINT <> 0) > count(*) THEN {0}::UBIGINT ELSE 0::UBIGINT END"

OP10_SQL = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, {_LOWERED} AS w FROM documents),
shingle AS MATERIALIZED (
  SELECT doc_id, array_to_string(w[p:p + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS p FROM d WHERE len(w) > 0)),
word_run AS MATERIALIZED (SELECT g, hex(encode(g)) AS b, octet_length(encode(g)) AS n FROM (SELECT DISTINCT g FROM shingle)),
{_xxh64("word_run")},
bits AS MATERIALIZED (SELECT doc_id, {" + ".join(_BIT.format(1 << i) for i in range(64))} AS fp FROM shingle JOIN hashed USING (g) GROUP BY doc_id),
print AS MATERIALIZED (SELECT doc_id, coalesce(fp, 0::UBIGINT) AS fp FROM d LEFT JOIN bits USING (doc_id)),
rep AS MATERIALIZED (SELECT fp, min(doc_id) AS low FROM print GROUP BY fp),
link AS MATERIALIZED (SELECT a.fp AS a, b.fp AS b FROM rep a JOIN rep b ON a.fp <> b.fp AND bit_count(xor(a.fp, b.fp)) <= 4),
reach(fp, to_fp) AS (SELECT fp, fp FROM rep UNION SELECT reach.fp, link.b FROM reach JOIN link ON link.a = reach.to_fp),
part AS (SELECT reach.fp, min(rep.low) AS component_id FROM reach JOIN rep ON rep.fp = reach.to_fp GROUP BY reach.fp)
SELECT doc_id, lpad(lower(to_hex(fp)), 16, '0') AS fingerprint, component_id FROM print JOIN part USING (fp)
"""
