"""Secret scan with a randomness test battery (operator 7, DataFrame functions only)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the whole run counts, so a run of 20 or more is the same as a run that is kept
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = ("assign", "access", "hex", "random")
FALSE_DISCOVERY = 0.05
LEAST_BITS = 80
CLASSES, STEPS, DEPTH = 64, 20, 24  # length classes; p-values in steps of 10^(-1/20) down to 10^-24

BLOCK = 128  # matches of a text that are put together at a time: appending to one array for each would cost their square

_EMPTY = "cast(array() as array<struct<start:int,kind:int,end:int>>)"
_TOKENS = "cast(array() as array<struct<start:int,end:int,token:string>>)"


def _bound(value: Column, body) -> Column:
    """body of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _blocks(items: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")), lambda k: F.slice(items, k * BLOCK + 1, F.lit(BLOCK)))


def _matches(text: str, pattern: str, empty: str, found) -> Column:
    """found(start, match, end) of each match, an array of rows that stay: starts and ends in code points.

    Lengths of what lies between matches and of these are summed up in blocks.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.arrays_zip(F.transform(F.split(text, pattern, -1), F.length).alias("gap"), hits.alias("hit"))

    def step(acc, x):
        start = acc["pos"] + x["gap"]
        end = start + F.length(x["hit"])
        return F.when(x["hit"].isNull(), acc).otherwise(F.struct(end.alias("pos"), F.concat(acc["out"], found(start, x["hit"], end)).alias("out")))

    def of_block(block: Column, at: Column) -> Column:
        return F.aggregate(block, F.struct(at.alias("pos"), F.expr(empty).alias("out")), step, lambda acc: acc["out"])

    def all_of(blocks: Column) -> Column:
        total = lambda b: F.aggregate(b, F.lit(0), lambda n, x: n + x["gap"] + F.coalesce(F.length(x["hit"]), F.lit(0)))
        starts = F.aggregate(blocks, F.array(F.lit(0)), lambda acc, b: F.concat(acc, F.array(F.element_at(acc, -1) + total(b))))
        return _bound(starts, lambda at: F.flatten(F.transform(blocks, lambda b, k: of_block(b, F.get(at, k)))))

    return _bound(pieces, lambda z: _bound(_blocks(z), all_of))


def _spans(text: str, pattern: str, kind: int, group: int, least: int) -> Column:
    def found(start, hit, end):
        one = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        return F.when(F.length(F.regexp_extract(hit, pattern, group)) >= least, one).otherwise(F.expr(_EMPTY))

    return _matches(text, pattern, _EMPTY, found)


def _some(text: str, quick: str, spans: Column, empty: str = _EMPTY) -> Column:
    return F.when(F.col(text).rlike(quick), spans).otherwise(F.expr(empty))


def base_spans(text: str) -> Column:
    """The base patterns' spans: start and end in code points, kind by its place in KINDS."""
    found = F.concat(
        _some(text, r"(?i)passw(?:or)?d|secret|token|api_?key", _spans(text, ASSIGN, 0, 2, 6)),
        F.when(F.col(text).contains("AKIA"), _spans(text, ACCESS, 1, 0, 20)).otherwise(F.expr(_EMPTY)),
        _some(text, "[0-9a-f]{24}", _spans(text, HEX, 2, 0, 24)),
    )
    return F.array_sort(found)


def _tokens(text: str) -> Column:
    """Spans and texts of long runs of letters, digits and base64 signs."""
    found = _matches(text, TOKEN, _TOKENS, lambda start, hit, end: F.array(F.struct(start.alias("start"), end.alias("end"), hit.alias("token"))))
    return _some(text, TOKEN[: TOKEN.index("=")].replace("{20,}", "{20}"), found, _TOKENS)


def _tail(z: str) -> str:
    """P(|Z| >= |z|) of a normal variable, by a rational approximation (Abramowitz and Stegun 7.1.26)."""
    x = f"(abs({z}) / sqrt(2D))"
    t = f"(1D / (1D + 0.3275911D * {x}))"
    poly = f"({t} * (0.254829592D + {t} * (-0.284496736D + {t} * (1.421413741D + {t} * (-1.453152027D + {t} * 1.061405429D)))))"
    return f"greatest({poly} * exp(-{x} * {x}), 1e-12D)"


def _let(name: str, value: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _chi_tail(chi: str, df: str) -> str:
    """P of a chi-squared value at least as large, by the Wilson-Hilferty approximation."""
    return _let("z", f"((pow({chi} / {df}, 1D / 3) - (1 - 2 / (9D * {df}))) / sqrt(2 / (9D * {df})))", f"if(z > 0, {_tail('z')} / 2, 1 - {_tail('z')} / 2)")


_KINDS_OF_LETTERS = "array('aeiou', 'bcdfghjklmnpqrstvwxyz', 'AEIOU', 'BCDFGHJKLMNPQRSTVWXYZ', '0123456789', '+/')"


def _battery(s: str, alphabet: str) -> str:
    """p-value, under uniform letters of the alphabet, of chi-squared, runs and lag-1 correlation together (Fisher).

    Chi-squared is taken over letters and, as short tokens leave few of each, over kinds of letters too; the
    lesser p-value counts, doubled.
    """
    chi = f"(k / n * aggregate(array_distinct(v), 0D, (a, x) -> a + pow(length({s}) - length(replace({s}, substr({alphabet}, x + 1, 1), '')), 2)) - n)"
    chi_p = _chi_tail(chi, "(k - 1)")
    seen = f"transform({_KINDS_OF_LETTERS}, c -> struct(length({s}) - length(translate({s}, c, '')) as o, n * (length({alphabet}) - length(translate({alphabet}, c, ''))) / k as e))"
    kinds_p = _let("w", f"filter({seen}, x -> x.e > 0)", f"if(size(w) > 1, {_chi_tail('aggregate(w, 0D, (a, x) -> a + pow(x.o - x.e, 2) / x.e)', '(size(w) - 1)')}, 1D)")
    chi_p = f"least(1D, 2 * least({chi_p}, {kinds_p}))"
    runs = "(1 + size(filter(sequence(1, cast(n as int) - 1), i -> (v[i] >= k / 2) <> (v[i - 1] >= k / 2))))"
    mean, var = "(1 + 2D * h * (n - h) / n)", "(2D * h * (n - h) * (2D * h * (n - h) - n) / (n * n * (n - 1)))"
    runs_p = _let("h", "cast(size(filter(v, x -> x >= k / 2)) as double)", f"if({var} > 0, {_let('z', f'(({runs} - {mean}) / sqrt({var}))', _tail('z'))}, 1e-12D)")
    lag = "aggregate(sequence(1, cast(n as int) - 1), 0D, (a, i) -> a + (v[i] - m) * (v[i - 1] - m))"
    spread = "aggregate(v, 0D, (a, x) -> a + (x - m) * (x - m))"
    corr_p = _let("m", "(aggregate(v, 0D, (a, x) -> a + x) / n)", _let("d", spread, f"if(d > 0, {_let('z', f'({lag} / d * sqrt(n))', _tail('z'))}, 1e-12D)"))
    fisher = _let("x", f"-(ln({chi_p}) + ln({runs_p}) + ln({corr_p}))", "exp(-x) * (1 + x + x * x / 2)")
    values = f"transform(filter(split({s}, ''), c -> c <> ''), c -> instr({alphabet}, c) - 1)"
    return _let("v", values, _let("n", "cast(size(v) as double)", _let("k", f"cast(length({alphabet}) as double)", fisher)))


_DIGITS, _UPPER, _LOW = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Of signs and letters of one case alone, without digits, no encoding is known but base64: such tokens are held against its whole alphabet.
_INFER = f"""case
  when not t rlike '[A-Za-z0-9]' then ''
  when t rlike '^[0-9]+$' then '{_DIGITS}'
  when t rlike '^[a-z]+$' then '{_LOW}'
  when t rlike '^[A-Z]+$' then '{_UPPER}'
  when t rlike '^[A-Za-z]+$' then '{_UPPER}{_LOW}'
  when t rlike '^[0-9a-f]+$' then '{_DIGITS}abcdef'
  when t rlike '^[0-9A-F]+$' then '{_DIGITS}ABCDEF'
  when t rlike '^[A-Z2-7]+$' then '{_UPPER}234567'
  when t rlike '^[A-Z0-9]+$' then '{_DIGITS}{_UPPER}'
  when t rlike '^[a-z0-9]+$' then '{_DIGITS}{_LOW}'
  when t rlike '^[a-z0-9+/]+$' and t rlike '[0-9]' then '{_LOW}{_DIGITS}+/'
  when t rlike '^[A-Z0-9+/]+$' and t rlike '[0-9]' then '{_UPPER}{_DIGITS}+/'
  else '{_UPPER}{_LOW}{_DIGITS}+/' end"""
_UUID = "^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"


def random_tests(text: str, tokens: str = "_tokens") -> Column:
    """Tested ones of a text's tokens, which stand in a column of their own: start, end, length class and p-value; tokens of signs alone and those with too few bits aren't tested."""
    test = _let("t", f"if(c.token rlike '{_UUID}', replace(c.token, '-', ''), translate(translate(c.token, '-_', '+/'), '=', ''))", _let("e", _INFER, f"if(e = '' or length(t) * log2(length(e)) < {LEAST_BITS}, null, {_battery('t', 'e')})"))
    cls = f"least({CLASSES - 1}, cast(floor(4 * log2(c.end - c.start)) as int))"
    return F.expr(f"filter(transform({tokens}, c -> struct(c.start as start, c.end as end, {cls} as cls, {test} as p)), x -> x.p is not null)")


def thresholds(docs: DataFrame) -> dict[int, float]:
    """Per length class, the p-value up to which tokens are found not to be random, at the false-discovery rate.

    Benjamini-Hochberg on p-values rounded up to a fixed grid; CLASSES x STEPS x DEPTH
    counts at most reach the driver, whatever the input.
    """
    tests = docs.select(_tokens("text").alias("_tokens")).where(F.size("_tokens") > 0).select(F.explode(random_tests("text")).alias("x"))
    step = F.least(F.floor(-F.log10(F.greatest("x.p", F.lit(1e-300))) * STEPS), F.lit(STEPS * DEPTH)).cast("int")
    rows = tests.groupBy(F.col("x.cls").alias("cls"), step.alias("step")).agg(F.count("*").alias("n")).collect()
    out = {}
    for cls in sorted({r.cls for r in rows}):
        own = sorted(((r.step, r.n) for r in rows if r.cls == cls), reverse=True)
        total, rank, cut = sum(n for _, n in own), 0, 0.0
        for s, n in own:
            rank += n
            p = 10 ** (-s / STEPS)
            if p <= FALSE_DISCOVERY * rank / total:
                cut = p
        out[int(cls)] = cut
    return out


def with_spans(docs: DataFrame) -> DataFrame:
    """docs with columns base and spans: arrays of (start, kind, end), code points, end exclusive, kind by its place in KINDS.

    base holds the fixed patterns' spans.  spans adds random tokens: runs of 20 or more
    letters, digits and base64 signs (in the least alphabet that holds them, UUIDs without dashes), that hold
    LEAST_BITS bits, that don't overlap a base span, and for which the tests of chi-squared
    uniformity, runs and serial correlation don't reject randomness, with false-discovery
    control over all tokens of about the same length.

    That control bounds the share of random tokens among those found not to be random: secrets that are missed.
    Of the other error, words and paths that pass for random, it bounds nothing; README has measured figures.

    Null and empty texts have no spans, texts of any length are scanned whole in about linear time; rows, repeated or not, and other columns are kept
    (a column named base or spans is replaced); an empty table gives no rows.
    """
    cuts = thresholds(docs)
    cut = F.create_map(*[F.lit(x) for kv in sorted(cuts.items()) for x in kv]) if cuts else F.expr("map(-1, 0D)")
    tokens, tests, limits = (_free(docs, k) for k in ("_tokens", "_tests", "_cut"))
    out = docs.withColumn("base", F.coalesce(base_spans("text"), F.expr(_EMPTY))).withColumn(tokens, F.coalesce(_tokens("text"), F.expr(_TOKENS)))
    out = out.withColumn(tests, F.when(F.size(tokens) > 0, random_tests("text", tokens))).withColumn(limits, cut)
    extra = F.expr(
        f"transform(filter({tests}, x -> x.p > coalesce(element_at({limits}, x.cls), 0D) and not exists(base, b -> b.start < x.end and x.start < b.end)),"
        f" x -> struct(x.start as start, {KINDS.index('random')} as kind, x.end as end))"
    )
    return out.withColumn("spans", F.array_sort(F.concat("base", F.coalesce(extra, F.expr(_EMPTY))))).drop(tokens, tests, limits)


def _free(docs: DataFrame, name: str) -> str:
    """The name, with as many _ as make it one that no column has."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with each span of the text, overlapping ones as one, replaced by the mark; all rows and columns stay."""
    names = docs.columns
    # spans in blocks: each block's part of the text is cut out once, and its spans from that
    inner = f"""aggregate(b, struct(a.pos as pos, cast(array() as array<string>) as out),
      (x, s) -> struct(greatest(x.pos, s.end) as pos,
                       if(s.start >= x.pos, concat(x.out, array(substr(part, x.pos - a.pos + 1, s.start - x.pos), '{mark}')), x.out) as out),
      x -> struct(x.pos as pos, concat(a.out, array(array_join(x.out, ''))) as out))"""
    part = _let("part", "substr(text, a.pos + 1, greatest(array_max(transform(b, s -> s.end)) - a.pos, 0))", inner)
    blocks = f"transform(sequence(0, cast(floor((size(spans) - 1) / {BLOCK}) as int)), k -> slice(spans, k * {BLOCK} + 1, {BLOCK}))"
    fold = f"""aggregate({blocks}, struct(0 as pos, cast(array() as array<string>) as out), (a, b) -> {part},
      a -> array_join(concat(a.out, array(substr(text, a.pos + 1))), ''))"""
    found = with_spans(docs.select(F.struct(*names).alias("_row"), F.col("text")))
    text = F.when(F.size("spans") > 0, F.expr(fold)).otherwise(F.col("text"))
    return found.select(*[text.alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in names])


def _written(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def op7_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return with_spans(docs).select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(_written("base"), 256).alias("base_sha256"), _written("spans").alias("spans"))
