"""DuckDB SQL that computes what the graph queries return, written independently of them."""

from __future__ import annotations

from .fixtures import ctes

UNREACHED = 9223372036854775807


def bfs(g: str, most: int = 40) -> str:
    return f"""WITH RECURSIVE {ctes(g)},
w(id, lvl) AS (SELECT min(src), 0 FROM e UNION SELECT e.dst, w.lvl + 1 FROM w JOIN e ON e.src = w.id WHERE w.lvl < {most})
SELECT v.id, coalesce(min(w.lvl), {UNREACHED})::BIGINT AS level FROM v LEFT JOIN w ON v.id = w.id GROUP BY v.id"""


def pr(g: str, damping: float = 0.85, iterations: int = 10, digits: int = 10) -> str:
    steps = [
        f"k AS MATERIALIZED (SELECT v.id, count(e.src) AS deg FROM v LEFT JOIN e ON e.src = v.id GROUP BY v.id)",
        "r0 AS MATERIALIZED (SELECT id, deg, 1.0::DOUBLE / (SELECT count(*) FROM v) AS rank FROM k)",
    ]
    for i in range(max(1, iterations)):
        steps += [
            f"s{i} AS MATERIALIZED (SELECT e.dst AS id, sum(r.rank / r.deg) AS s FROM e JOIN r{i} r ON e.src = r.id GROUP BY e.dst)",
            f"r{i + 1} AS MATERIALIZED (SELECT r.id, r.deg, (1 - {damping}::DOUBLE) / (SELECT count(*) FROM v) + {damping}::DOUBLE * (coalesce(s.s, 0)"
            f" + (SELECT coalesce(sum(rank), 0) FROM r{i} WHERE deg = 0) / (SELECT count(*) FROM v)) AS rank FROM r{i} r LEFT JOIN s{i} s ON r.id = s.id)",
        ]
    return f"WITH {ctes(g)}, {', '.join(steps)} SELECT id, round(rank, {digits}) AS rank FROM r{max(1, iterations)}"


def _wcc(g: str, rounds: int = 24) -> str:
    steps = ["b AS MATERIALIZED (SELECT src, dst FROM e UNION SELECT dst, src FROM e)", "c0 AS MATERIALIZED (SELECT id, id AS c FROM v)"]
    for i in range(rounds):
        steps.append(f"c{i + 1} AS MATERIALIZED (SELECT x.id, least(x.c, coalesce(min(y.c), x.c)) AS c FROM c{i} x LEFT JOIN b ON b.src = x.id LEFT JOIN c{i} y ON y.id = b.dst GROUP BY x.id, x.c)")
    return f"WITH {ctes(g)}, {', '.join(steps)}, result AS (SELECT id, c::BIGINT AS component FROM c{rounds})"


def wcc(g: str) -> str:
    return _wcc(g) + " SELECT * FROM result"


def wcc_sizes(g: str) -> str:
    return _wcc(g) + " SELECT component, count(*) AS size FROM result GROUP BY component"


def _cdlp(g: str, iterations: int = 10, isolated: str = "x.id") -> str:
    steps = ["b AS MATERIALIZED (SELECT src, dst FROM e UNION ALL SELECT dst, src FROM e)", "l0 AS MATERIALIZED (SELECT id, id AS l FROM v)"]
    for i in range(max(1, iterations)):
        steps.append(
            f"l{i + 1} AS MATERIALIZED (SELECT x.id, coalesce(t.l, {isolated}) AS l FROM v x LEFT JOIN (SELECT id, l FROM (SELECT b.src AS id, y.l, row_number() OVER (PARTITION BY b.src ORDER BY count(*) DESC, y.l) AS rn"
            f" FROM b JOIN l{i} y ON b.dst = y.id GROUP BY b.src, y.l) WHERE rn = 1) t ON t.id = x.id)"
        )
    return f"WITH {ctes(g)}, {', '.join(steps)}, result AS (SELECT id, l::BIGINT AS label FROM l{max(1, iterations)})"


def cdlp(g: str, **kw) -> str:
    return _cdlp(g, **kw) + " SELECT * FROM result"


def cdlp_sizes(g: str) -> str:
    return _cdlp(g) + " SELECT label, count(*) AS size FROM result GROUP BY label"


def lcc(g: str, digits: int = 10) -> str:
    return f"""WITH {ctes(g)},
o AS MATERIALIZED (SELECT DISTINCT src, dst FROM e), n AS MATERIALIZED (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
d AS (SELECT src AS id, count(*) AS d FROM n GROUP BY src),
t AS (SELECT a.src AS id, count(*) AS t FROM n a JOIN o ON o.src = a.dst JOIN n c ON c.src = a.src AND c.dst = o.dst GROUP BY a.src)
SELECT v.id, round(CASE WHEN coalesce(d, 0) >= 2 THEN coalesce(t, 0)::DOUBLE / (d * (d - 1)) ELSE 0.0 END, {digits}) AS lcc
FROM v LEFT JOIN d ON d.id = v.id LEFT JOIN t ON t.id = v.id"""


def sssp(g: str, rounds: int = 44, digits: int = 4) -> str:
    steps = ["d0 AS MATERIALIZED (SELECT min(src) AS id, 0.0::DOUBLE AS d FROM e)"]
    for i in range(rounds):
        steps.append(f"d{i + 1} AS MATERIALIZED (SELECT id, min(d) AS d FROM (SELECT id, d FROM d{i} UNION ALL SELECT e.dst, x.d + e.weight FROM d{i} x JOIN e ON e.src = x.id) GROUP BY id)")
    return f"WITH {ctes(g)}, {', '.join(steps)} SELECT v.id, round(x.d, {digits}) AS distance FROM v LEFT JOIN d{rounds} x ON x.id = v.id"


def over(g: str, select: str, more: str = "") -> str:
    """A one-line oracle over v and e."""
    return f"WITH {ctes(g)}{', ' + more if more else ''} {select}"


# Logs that queries render from the events table: one run per user, its marks out of event times.
LOG_TIMES = "SELECT user_id AS run, min(epoch_us(ts) // 1000) AS t0, max(epoch_us(ts) // 1000) AS t3, count(*) AS n FROM events GROUP BY user_id"
