"""Secret scans: known forms, and tokens that a battery of randomness tests finds random.

Known forms are regular expressions. Further candidates are long tokens; the alphabet of
each tells its encoding. Chi-squared uniformity of that alphabet, the number of runs above
and below its middle, and the serial correlation of neighbours give p-values for a random
token, put together by Fisher's method. How unlikely the token's evenness would be for
ordinary text of that length gives another p-value; these go through a false-discovery
control of their own in each band of encoding and length, over all texts.

Everything is built-in column expressions: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlemill.llm.common import saved

ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGNED = 8
# Runs of each alphabet, and their pieces between separators.
TOKENS = tuple(rf"[{symbols}]{{20,}}={{0,2}}" for symbols in ("A-Za-z0-9+/", "A-Za-z0-9_-", "A-Za-z0-9"))
# A token that a test battery gives less than this is not random.
LEAST_RANDOM = 0.001
# False discoveries that a band may hold, as a share of its findings.
FALSE_SHARE = 0.05
# Bins of -ln p in which a band's tokens are counted.
BINS_PER_UNIT = 4
MOST_BINS = 400
_CHUNK = 256

# Encodings from the narrowest on: pattern, alphabet, and how often two symbols of ordinary
# text in it are the same.
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = {
    "hex": (r"^(?=.*[0-9])[0-9a-f]+$", _DIGITS + "abcdef", 0.1),
    "upper_hex": (r"^(?=.*[0-9])[0-9A-F]+$", _DIGITS + "ABCDEF", 0.1),
    "base32": (r"^[A-Z2-7]+$", _UPPER + "234567", 0.065),
    "letters": (r"^[a-z]+$", _LOWER, 0.065),
    "base36": (r"^[a-z0-9]+$", _LOWER + _DIGITS, 0.06),
    "base62": (r"^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGITS, 0.055),
    "base64": (r"^[A-Za-z0-9+/]+$", _UPPER + _LOWER + _DIGITS + "+/", 0.055),
    "url64": (r"^[A-Za-z0-9_-]+$", _UPPER + _LOWER + _DIGITS + "-_", 0.055),
}


def _running(steps: str) -> str:
    """SQL of the running sums of an array column, in chunks so that the work stays linear."""
    zero = "cast(0 AS bigint)"
    return f"""
    CASE WHEN size({steps}) = 0 THEN cast(array() AS array<bigint>) ELSE flatten(zip_with(
      transform(sequence(0, (size({steps}) - 1) div {_CHUNK}), k ->
        slice({steps}, cast(k * {_CHUNK} + 1 AS int), {_CHUNK})),
      aggregate(
        transform(sequence(0, (size({steps}) - 1) div {_CHUNK}), k ->
          aggregate(slice({steps}, cast(k * {_CHUNK} + 1 AS int), {_CHUNK}), {zero}, (a, x) -> a + x)),
        array({zero}), (a, x) -> concat(a, array(element_at(a, -1) + x)),
        a -> slice(a, 1, size(a) - 1)),
      (part, before) -> aggregate(part,
        named_struct('at', before, 'all', cast(array() AS array<bigint>)),
        (s, x) -> named_struct('at', s.at + x, 'all', concat(s.all, array(s.at + x))),
        s -> s.all))) END"""


def _with_places(df: DataFrame, name: str, pattern: str, group: int = 0) -> DataFrame:
    """Adds ``name``: (start, stop, t) of all matches, leftmost and not overlapping.

    Places are in code points, ``t`` is the text of a group. Matches and what lies between
    them have lengths that add up to the places.
    """
    found, gaps, steps, ends, t = (f"_{name}_{c}" for c in ("found", "gaps", "steps", "ends", "t"))
    df = df.withColumn(found, F.regexp_extract_all("text", F.lit(pattern), 0))
    held = F.regexp_extract_all("text", F.lit(pattern), group) if group else F.col(found)
    df = df.withColumn(t, F.when(F.size(found) > 0, held).otherwise(F.col(found)))
    between = F.when(F.size(found) > 0, F.split("text", pattern, -1)).otherwise(F.col(found))
    df = df.withColumn(gaps, between).withColumn(
        steps,
        F.expr(
            f"zip_with(slice({gaps}, 1, size({found})), {found},"
            " (g, m) -> cast(length(g) + length(m) AS bigint))"
        ),
    )
    df = df.withColumn(ends, F.expr(_running(steps)))
    places = f"""
        zip_with(zip_with({ends}, {found}, (e, m) -> named_struct('start', e - length(m), 'stop', e)), {t},
          (p, t) -> named_struct('start', p.start, 'stop', p.stop, 't', t))"""
    return df.withColumn(name, F.expr(places)).drop(found, gaps, steps, ends, t)


def _tail(z: str) -> str:
    """SQL of P(Z > z) of a standard normal, by the logistic approximation (fixed values)."""
    z = f"greatest(-8D, least(8D, {z}))"
    return f"(1 / (1 + exp(1.5976D * {z} + 0.07056D * pow({z}, 3))))"


def _with_tests(df: DataFrame, tokens: str) -> DataFrame:
    """Replaces ``tokens`` (start, stop, t) by (start, stop, encoding, n, random, plain).

    ``random`` is small for a token that is not random; ``plain`` is small for one that is
    more even than ordinary text of its length would be. Tokens of digits only, and of no
    encoding, go.
    """
    def pick(value) -> str:
        cases = " ".join(f"WHEN b RLIKE '{p}' THEN {value(k)}" for k, (p, _, _) in ENCODINGS.items())
        return f"CASE WHEN b RLIKE '^[0-9]+$' THEN NULL {cases} END"

    steps = [
        # The token without its padding.
        "transform({c}, m -> named_struct('start', m.start, 'stop', m.stop, 'b', rtrim('=', m.t)))",
        "transform({c}, m -> named_struct('m', m, 'e', transform(array(m.b), b -> "
        + pick(lambda k: f"'{k}'")
        + ")[0]))",
        "transform(filter({c}, x -> x.e IS NOT NULL), x -> named_struct('m', x.m, 'e', x.e,"
        f" 'a', element_at({_map(1)}, x.e), 'alike', element_at({_map(2)}, x.e)))",
        # Of each symbol its place in the alphabet, from the middle.
        "transform({c}, x -> named_struct('x', x, 'n', cast(length(x.m.b) AS double),"
        " 's', cast(length(x.a) AS double), 'o', transform(filter(split(x.m.b, ''), c -> c <> ''),"
        " c -> instr(x.a, c) - (length(x.a) + 1) / 2D)))",
        "transform({c}, y -> named_struct('y', y,"
        " 'chi', y.s / y.n * aggregate(transform(split(y.x.a, ''), c ->"
        " pow(y.n - length(replace(y.x.m.b, c, '')), 2)), 0D, (a, v) -> a + v) - y.n,"
        " 'high', cast(size(filter(y.o, v -> v > 0)) AS double),"
        " 'runs', 1D + aggregate(zip_with(slice(y.o, 2, size(y.o)), slice(y.o, 1, size(y.o) - 1),"
        " (v, w) -> if((v > 0) <> (w > 0), 1D, 0D)), 0D, (a, v) -> a + v),"
        " 'mean', aggregate(y.o, 0D, (a, v) -> a + v) / y.n))",
        "transform({c}, z -> named_struct('z', z, 'free', z.y.s - 1,"
        " 'pairs', 2 * z.high * (z.y.n - z.high),"
        " 'own', aggregate(z.y.o, 0D, (a, v) -> a + pow(v - z.mean, 2)),"
        " 'next', aggregate(zip_with(slice(z.y.o, 2, size(z.y.o)), slice(z.y.o, 1, size(z.y.o) - 1),"
        " (v, w) -> (v - z.mean) * (w - z.mean)), 0D, (a, v) -> a + v)))",
        "transform({c}, t -> named_struct('t', t, 'p', array("
        + _tail("(pow(greatest(t.z.chi, 0D) / t.free, 1 / 3D) - 1 + 2 / (9 * t.free)) / sqrt(2 / (9 * t.free))")
        + ", 2 * "
        + _tail(
            "abs(t.z.runs - t.pairs / t.z.y.n - 1) / sqrt(greatest(1e-9D, t.pairs * (t.pairs - t.z.y.n)"
            " / (t.z.y.n * t.z.y.n * (t.z.y.n - 1))))"
        )
        + ", 2 * "
        + _tail("abs(t.next / greatest(t.own, 1e-9D)) * sqrt(t.z.y.n)")
        + "), 'shift', t.z.y.n * (t.z.y.s * t.z.y.x.alike - 1)))",
        # Fisher: -2 times the sum of three logarithms has six degrees of freedom.
        "transform({c}, u -> named_struct('u', u, 'f', -aggregate(u.p, 0D, (a, p) -> a + ln(greatest(p, 1e-12D)))))",
        "transform({c}, v -> named_struct('start', v.u.t.z.y.x.m.start, 'stop', v.u.t.z.y.x.m.stop,"
        " 'encoding', v.u.t.z.y.x.e, 'n', cast(v.u.t.z.y.n AS int),"
        " 'random', exp(-v.f) * (1 + v.f + v.f * v.f / 2),"
        " 'plain', "
        + _tail(
            "(v.u.t.free + v.u.shift - v.u.t.z.chi) / sqrt(2 * (v.u.t.free + 2 * v.u.shift))"
        )
        + "))",
    ]
    for step in steps:
        df = df.withColumn(tokens, F.expr(step.replace("{c}", tokens)))
    return df


def _merged(spans: str) -> str:
    """SQL of random spans (start, kind, stop) where those that overlap are one."""
    last = "element_at(a, -1)"
    return (
        f"aggregate(array_sort({spans}), cast(array() AS array<struct<start: bigint, kind: int, stop: bigint>>),"
        f" (a, c) -> CASE WHEN size(a) = 0 THEN array(c) WHEN {last}.stop <= c.start THEN concat(a, array(c))"
        f" ELSE concat(slice(a, 1, size(a) - 1), array(named_struct('start', {last}.start, 'kind', 3,"
        f" 'stop', greatest({last}.stop, c.stop)))) END)"
    )


def _map(part: int) -> str:
    entries = ", ".join(
        f"'{k}', " + (f"'{v[part]}'" if part == 1 else f"{v[part]}D") for k, v in ENCODINGS.items()
    )
    return f"map({entries})"


def _band() -> Column:
    """A token's encoding and the power of two that its length has reached."""
    return F.concat_ws(":", "c.encoding", F.floor(F.log2(F.col("c.n"))).cast("string"))


def thresholds(scanned: DataFrame, false_share: float = FALSE_SHARE) -> dict[str, float]:
    """For each band the largest p-value that is a finding (Benjamini and Hochberg).

    p-values are counted in bins of their logarithm; a bin counts with its largest value,
    so no more is found than with exact ranks. One number a band comes to the driver: there
    are as many as encodings times powers of two of a length.
    """
    tokens = scanned.select(F.explode("tokens").alias("c"))
    depth = F.least(F.lit(MOST_BINS), F.floor(-F.log(F.greatest("c.plain", F.lit(1e-44))) * BINS_PER_UNIT))
    bins = tokens.groupBy(_band().alias("band"), depth.alias("bin")).count()
    deep = Window.partitionBy("band").orderBy(F.desc("bin"))
    bins = bins.withColumn("rank", F.sum("count").over(deep))
    bins = bins.withColumn("all", F.sum("count").over(Window.partitionBy("band")))
    p = F.exp(-F.col("bin") / BINS_PER_UNIT)
    held = bins.where(p <= F.col("rank") / F.col("all") * false_share)
    return {r.band: r.p for r in held.groupBy("band").agg(F.max(p).alias("p")).collect()}


def secrets(docs: DataFrame, false_share: float = FALSE_SHARE, least_random: float = LEAST_RANDOM) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) for every row.

    Spans are kind:start:end in code points, end exclusive, by start and then by kind,
    joined by commas: ``assign`` is a key word with a value of LEAST_ASSIGNED characters or
    more, ``access`` an access key, ``hex`` 32 hexadecimal digits or more, and ``random`` a
    token found by the tests that overlaps none of these; tokens are runs of the base64 and of
    the url64 alphabet and their pieces between separators, and findings that overlap are one. ``base_sha256`` is the hash of
    the spans without the random ones. A null or empty text has none of them. Every row
    comes back, as often as it came. Further columns are not looked at.
    """
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    df = _with_places(df, "assign", ASSIGN, 2)
    df = _with_places(df, "access", ACCESS)
    df = _with_places(df, "hex", HEX)
    for i, pattern in enumerate(TOKENS):
        df = _with_places(df, f"tokens{i}", pattern)
    df = df.withColumn("tokens", F.array_distinct(F.concat(*[f"tokens{i}" for i in range(len(TOKENS))])))
    df = df.withColumn("assign", F.filter("assign", lambda m: F.length(m["t"]) >= LEAST_ASSIGNED))
    kinds = ", ".join(
        f"transform({k}, m -> named_struct('start', m.start, 'kind', {i}, 'stop', m.stop))"
        for i, k in enumerate(KINDS[:-1])
    )
    df = df.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:-1]],
        F.expr(f"array_sort(concat({kinds}))").alias("base"),
        "tokens",
    )
    df = df.withColumn(
        "tokens",
        F.expr("filter(tokens, m -> NOT exists(base, b -> b.start < m.stop AND m.start < b.stop))"),
    )
    scanned = saved(_with_tests(df, "tokens"), "scanned")
    limits = thresholds(scanned, false_share)
    if limits:
        cases = " ".join(
            f"WHEN c.encoding = '{e}' AND floor(log2(c.n)) = {b} THEN {p!r}D"
            for band, p in sorted(limits.items())
            for e, b in [band.split(":")]
        )
        found = f"filter(tokens, c -> c.random >= {least_random}D AND c.plain <= coalesce(CASE {cases} END, -1D))"
    else:
        found = "filter(tokens, c -> false)"
    random = _merged(f"transform({found}, c -> named_struct('start', c.start, 'kind', 3, 'stop', c.stop))")
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"

    def joined(spans: str) -> Column:
        return F.expr(
            f"array_join(transform({spans}, s -> concat({names}[s.kind], ':', s.start, ':', s.stop)), ',')"
        )

    out = scanned.withColumn("found", F.expr(random))
    out = out.withColumn("all", F.expr("array_sort(concat(base, found))"))
    return out.select(
        "doc_id",
        *[f"n_{k}" for k in KINDS[:-1]],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("all").alias("spans"),
        F.size("found").cast("long").alias("n_random"),
    )
