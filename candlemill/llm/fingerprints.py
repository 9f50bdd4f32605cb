"""Document fingerprints by Order MinHash.

A text is a sequence of k-mers of words; equal ones are numbered by occurrence, so repeats
count. Each component of the fingerprint picks the two of all k-mers that are minimal under a
hash of its own, keeps their order in the text, and hashes that pair. Edits change few k-mers and
moved passages change the order, so likeness follows edit distance, not only overlap.

Everything is built-in column expressions: no Python runs on the executors.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Words in a k-mer; a stretch without white space counts as words of so many characters.
KMER = 2
WORD_CHARS = 12
COMPONENTS = 32
SEED = 9
_WORD = rf"[^\x20\x09-\x0D]{{1,{WORD_CHARS}}}"
# Rows that lie between two cuts of the ids, and cuts at most: beyond, stretches get longer.
STRETCH_ROWS = 1000
MOST_CUTS = 1024
_PLACE_BITS = 30
_HASH_BITS = 64 - _PLACE_BITS


def _seeds(count: int) -> list[int]:
    rng = random.Random(SEED)
    return [rng.getrandbits(62) for _ in range(count)]


def with_kmers(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``{name}_kmers``: hashes of k-mer and occurrence in the order of the text.

    The work grows with n log n of a text's words. Columns are cut into steps so that each
    array is made once. Texts with the same beginning have the same k-mers there.
    """
    c = {k: f"_{name}_{k}" for k in ("words", "packed", "runs", "marked", "kmers")}
    low, place = -(1 << _PLACE_BITS), (1 << _PLACE_BITS) - 1
    df = df.withColumn(c["words"], F.regexp_extract_all(text, F.lit(_WORD), 0))
    # The first k-mers take in the edge of the text, so every word ends one.
    hashed, h = "{w}", "xxhash64(h)"
    for j in range(1, KMER):
        earlier = f"concat(array_repeat('', least({j}, size({{w}}))), slice({{w}}, 1, greatest(0, size({{w}}) - {j})))"
        hashed, h = f"zip_with({hashed}, {earlier}, (h, w) -> xxhash64({h}, w))", "h"
    # Hash above, place in the text below: sorted, equal k-mers lie side by side in order.
    packed = f"sort_array(transform({hashed}, (h, i) -> ({h} & {low}L) | i))"
    df = df.withColumn(c["packed"], F.expr(packed.replace("{w}", c["words"])))
    p = c["packed"]
    starts = (
        f"filter(transform(zip_with({p}, concat(array(cast(null AS bigint)), slice({p}, 1, greatest(0, size({p}) - 1))),"
        f" (x, y) -> y IS NULL OR (x & {low}L) <> (y & {low}L)), (new, i) -> if(new, i, null)), i -> i IS NOT NULL)"
    )
    df = df.withColumn(c["runs"], F.expr(f"CASE WHEN size({p}) = 0 THEN array() ELSE {starts} END"))
    r = c["runs"]
    occurrence = (
        f"flatten(zip_with({r}, concat(slice({r}, 2, size({r})), array(size({p}))),"
        " (a, b) -> if(b - a = 1, array(0), sequence(0, b - a - 1))))"
    )
    # Place above, hash of k-mer and occurrence below: sorted, they are in the order of the text.
    marked = (
        f"CASE WHEN size({p}) = 0 THEN cast(array() AS array<bigint>) ELSE"
        f" sort_array(zip_with({p}, {occurrence}, (x, o) -> shiftleft(x & {place}L, {_HASH_BITS})"
        f" | shiftrightunsigned(xxhash64(x & {low}L, o), {_PLACE_BITS}))) END"
    )
    df = df.withColumn(c["marked"], F.expr(marked))
    df = df.withColumn(c["kmers"], F.expr(f"transform({c['marked']}, x -> x & {(1 << _HASH_BITS) - 1}L)"))
    return df.withColumnRenamed(c["kmers"], f"{name}_kmers").drop(*(v for k, v in c.items() if k != "kmers"))


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``name``: COMPONENTS hashes of the text column, none for a text without words.

    Each row by itself, in interpreted lambdas. ``with_prints`` is the form for large tables.
    """
    df = with_kmers(df, text, name)
    s = f"{name}_kmers"
    found = ", ".join(
        f"transform(array(transform({s}, k -> xxhash64(k, {seed}L))), a ->"
        f" transform(filter(transform(array(array_min(a)), m -> array(m, array_min(array_remove(a, m))))[0],"
        f" h -> h IS NOT NULL), h -> shiftleft(array_position(a, h), {_HASH_BITS})"
        f" | element_at({s}, int(array_position(a, h)))))[0]"
        for seed in _seeds(COMPONENTS)
    )
    empty = "cast(array() AS array<array<bigint>>)"
    df = df.withColumn(f"{name}_minima", F.expr(f"CASE WHEN size({s}) = 0 THEN {empty} ELSE array({found}) END"))
    joined = (
        f"transform({name}_minima, m -> aggregate(sort_array(m),"
        f" 0L, (h, p) -> xxhash64(h, p & {(1 << _HASH_BITS) - 1}L)))"
    )
    return df.withColumn(name, F.expr(joined)).drop(s, f"{name}_minima")


def with_least(df: DataFrame, keys: list[str], kmers: str, name: str, above: str | None = None) -> DataFrame:
    """Adds ``{name}_0`` and so on: the smallest hash of each component, with its k-mer's place.

    ``keys`` are never null and differ from row to row. Where rows are dealt by some of them,
    nothing is shuffled. The low bits of a hash, as many as the k-mers' number has, give way
    to the place, counted from 1. With ``above`` only what is larger than the columns of that
    name counts. The k-mers become rows, so that hashes and minima run compiled; the row
    itself passes the aggregation as a group of its own and stands beside its minima in the
    window.
    """
    seeds = list(enumerate(_seeds(COMPONENTS)))
    bounds = [f"{above}_{c}" for c, _ in seeds] if above else []
    row = F.struct(*[c for c in df.columns if c not in keys])
    rows = F.posexplode(F.expr(f"concat(array(cast(null AS bigint)), {kmers})")).alias("_at", "_k")
    high = F.expr(f"shiftleft(-1L, length(bin(size({kmers}))))")
    df = df.select(*keys, *bounds, row.alias("_row"), high.alias("_high"), rows)
    df = df.withColumn("_row", F.expr("CASE WHEN _at = 0 THEN _row END"))
    df = df.withColumn("_at", F.expr("CASE WHEN _at > 0 THEN cast(_at AS bigint) END"))
    found = []
    for c, seed in seeds:
        h = f"(xxhash64(_k, {seed}L) & _high | _at)"
        found.append(F.expr(f"min(if({h} > {above}_{c}, {h}, null))" if above else f"min({h})").alias(f"{name}_{c}"))
    df = df.groupBy(*keys, "_row").agg(*found)
    both = Window.partitionBy(*keys)
    df = df.select(*keys, "_row", *[F.min(f"{name}_{c}").over(both).alias(f"{name}_{c}") for c, _ in seeds])
    return df.where("_row IS NOT NULL").select(*keys, "_row.*", *[f"{name}_{c}" for c, _ in seeds])


def with_prints(df: DataFrame, keys: list[str], kmers: str, name: str) -> DataFrame:
    """``df`` with ``name``, the fingerprints of ``with_fingerprint``, in place of its k-mers.

    ``keys`` as in ``with_least``. K-mers of one hash count once. The pair of a component
    differs only where the second and third hash agree in all bits but the last few, as many
    as the number of k-mers has: with 1,000 k-mers once in some 10^13.
    """
    rest = [c for c in df.columns if c not in (*keys, kmers)]
    df = df.withColumn(kmers, F.array_distinct(kmers))
    df = with_least(df, keys, kmers, "_first")
    df = with_least(df, keys, kmers, "_second", above="_first")
    low = f"~shiftleft(-1L, length(bin(size({kmers}))))"
    pairs = ", ".join(f"array(_first_{c} & {low}, _second_{c} & {low})" for c in range(COMPONENTS))
    # In the order of the text; the second place is null where there is one k-mer.
    pair = (
        f"transform(array({pairs}), m -> aggregate(sort_array(filter(m, p -> p IS NOT NULL)),"
        f" 0L, (h, p) -> xxhash64(h, element_at({kmers}, int(p)))))"
    )
    pair = F.expr(f"CASE WHEN size({kmers}) = 0 THEN cast(array() AS array<bigint>) ELSE {pair} END")
    return df.select(*keys, *rest, pair.alias(name))


def likeness(a: str, b: str) -> Column:
    """The share of components that two fingerprints have in common; 1 if both have none."""
    return F.expr(
        f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL"
        f" WHEN size({a}) = 0 OR size({b}) = 0 THEN if(size({a}) = size({b}), 1D, 0D)"
        f" ELSE aggregate(zip_with({a}, {b}, (x, y) -> if(x = y, 1D, 0D)), 0D, (s, v) -> s + v) / size({a}) END"
    )


def in_hex(fingerprint: str) -> Column:
    return F.expr(f"array_join(transform({fingerprint}, h -> lpad(lower(hex(h)), 16, '0')), '')")


def in_stretches(docs: DataFrame) -> DataFrame:
    """Adds ``stretch``, ``place`` in it by ascending doc_id, ``follows`` and ``next_text``.

    After the last row comes the first. Ids are cut into stretches at some of their own
    values, by approximate quantiles, and each stretch is ordered by itself. The row at a
    cut also goes to the end of the stretch before it, marked by ``follows``, as the one
    that follows its last row: one shuffle of the rows, no task with all of them. Null ids
    come first; rows of one id follow each other by their text.
    """
    rows = docs.select("doc_id").agg(F.count("*").alias("n"), F.min("doc_id").alias("low")).first()
    cuts = max(1, min(MOST_CUTS, rows.n // STRETCH_ROWS))
    if rows.low is None or cuts == 1:
        bounds = [] if rows.low is None else [rows.low]
    else:
        share = [i / cuts for i in range(1, cuts)]
        found = docs.agg(F.percentile_approx("doc_id", share, 100 * cuts).alias("q")).first().q
        bounds = sorted({rows.low, *found})
    # A stretch begins with its bound. Few coarse steps, then fine ones, find it.
    step = max(1, round(len(bounds) ** 0.5))
    coarse = F.array(*[F.lit(b) for b in bounds[::step]]).cast("array<bigint>")
    fine = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    fine = F.array(*[F.array(*[F.lit(b) for b in f]).cast("array<bigint>") for f in fine])
    df = docs.withColumn("_coarse", F.size(F.filter(coarse, lambda b: b <= F.col("doc_id"))))
    inside = F.size(F.filter(F.element_at(fine, F.col("_coarse")), lambda b: b <= F.col("doc_id")))
    stretch = (F.col("_coarse") - 1) * step + inside - 1 if bounds else F.lit(0)
    df = df.withColumn("_stretch", F.when(F.col("doc_id").isNull(), 0).otherwise(stretch))
    last = max(0, len(bounds) - 1)
    first_of_all = F.col("doc_id").isNull() | (F.col("doc_id") == (rows.low if bounds else 0))
    at_cut = F.array_contains(F.element_at(fine, F.col("_coarse")), F.col("doc_id")) if bounds else F.lit(False)
    before = F.when(first_of_all, last).when(at_cut, F.col("_stretch") - 1)
    places = F.array(
        F.struct(F.col("_stretch").cast("int").alias("s"), F.lit(0).alias("follows")),
        F.struct(before.cast("int").alias("s"), F.lit(1).alias("follows")),
    )
    df = df.withColumn("_at", F.explode(F.filter(places, lambda p: p["s"].isNotNull())))
    df = df.withColumn("stretch", F.col("_at.s")).withColumn("_follows", F.col("_at.follows"))
    order = Window.partitionBy("stretch").orderBy("_follows", F.col("doc_id").asc_nulls_first(), "text")
    df = df.select(
        *docs.columns,
        "stretch",
        F.row_number().over(order).alias("place"),
        F.col("_follows").alias("follows"),
        F.lead("text", 1, "").over(order).alias("next_text"),
        F.lag("_follows", 1, 0).over(order).alias("_before"),
    )
    # Of the rows that follow a stretch the first is enough.
    return df.where("_before = 0").drop("_before")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has the last floor(n_chars / 4) code points replaced by the first as
    many (or all) of the next document, by ascending doc_id; after the last comes the first.
    Fingerprints are hexadecimal, 16 digits a component; equal texts have equal ones, and a
    text without words has the empty one, like null. near_edited and near_next are the
    likeness to the edited text's and to the next document's fingerprint, 0 to 1. A single
    row is its own next. Every row comes back; repeated rows follow one another.
    """
    df = in_stretches(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    head = F.substring(F.col("text"), F.lit(1), n - quarter)
    df = df.withColumn("edited", F.concat(head, F.substring(F.col("next_text"), F.lit(1), quarter)))
    df = df.withColumn("n_chars", n.cast("long")).withColumn("edited_sha256", F.sha2(F.col("edited"), 256))
    df = with_kmers(with_kmers(df, "text", "text"), "edited", "edited")
    # A row for each of the two texts; of a row that only follows its own text is asked.
    carried = ["doc_id", "n_chars", "edited_sha256"]
    text = F.struct(F.lit(0).alias("form"), *carried, F.col("text_kmers").alias("kmers"))
    none = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in carried]
    edited = F.struct(F.lit(1).alias("form"), *none, F.col("edited_kmers").alias("kmers"))
    forms = F.when(F.col("follows") == 0, F.array(text, edited)).otherwise(F.array(text))
    df = df.select("stretch", "place", "follows", F.inline(forms))
    df = with_prints(df, ["stretch", "place", "form"], "kmers", "print")
    order = Window.partitionBy("stretch").orderBy("place", "form")
    df = df.withColumn("edited_print", F.lead("print", 1).over(order))
    df = df.withColumn("next_print", F.lead("print", 2).over(order)).where("form = 0 AND follows = 0")
    return df.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        in_hex("print").alias("fingerprint"),
        in_hex("edited_print").alias("edited_fingerprint"),
        likeness("print", "edited_print").alias("near_edited"),
        likeness("print", "next_print").alias("near_next"),
    )
