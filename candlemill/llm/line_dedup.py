"""Line dedup by a tree of log templates.

Lines are parsed to a fixed depth: by their number of tokens, then by their leading tokens,
where a token with a digit stands for any value. Within such a leaf a token that enough
documents have at the same position belongs to the template, and any other is a variable
field. Lines whose template recurs across documents are dropped, in every document; only
near copies, found by a Jaccard join, count as one document and may keep their text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import BROADCAST_IDS, saved, semi_join, work_tables
from candlemill.llm.jaccard_join import jaccard_rows
from candlemill.llm.words import U64, mix, some_hashes, utf8_runs, word_starts

# Leading tokens that a leaf is chosen by.
DEPTH = 3
# Different documents that a template must occur in to be dropped.
MIN_DOCS = 5
# Lines of more words than LONG_WORDS are passages: they recur from LONG_DOCS documents on.
LONG_WORDS = 50
LONG_DOCS = 2
# Part of a line's tokens that must be constant or hold a digit, by hundredths.
MIN_CONSTANT = 70
# Part of a line's tokens that must be constant alone, by hundredths: rows of numbers that
# share a word or two are no template.
MIN_HELD = 25
# A near copy of which more than this part of the words (by hundredths) would go keeps its lines.
MOST_DROPPED = 50
# Tokens in all lines of a leaf up to which one task counts it, and of leaves counted at once.
LEAF_TOKENS = 1 << 20
TASK_TOKENS = 1 << 19
# Bits, a power of two from 32,768 on, that tell tasks which leaves recur: 512 KB.
LEAF_BITS = 1 << 22

_NEWLINE = 0x0A
_FIELD = U64(0xF1E1D)
_KEY = "text_key struct<t1: long, t2: long>"
_LEAF = ["text_key", "leaf", "words"]
_LINE = [*_LEAF, "line", "text_words", "tokens"]
_FOUND = [*_LEAF, "line", "text_words"]
_SOURCED = [*_FOUND, "source", "tokens"]
_FOUND_SCHEMA = f"{_KEY}, leaf long, words int, line int, text_words int"
_LEAF_SCHEMA = f"{_KEY}, leaf long, words int"
_LINE_SCHEMA = f"{_LEAF_SCHEMA}, line int, text_words int, tokens array<long>"


def _tokens_of(data: np.ndarray, starts: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Hashes of these words, and of any with a digit the same one."""
    hashes, digits = some_hashes(data, starts, some)
    return np.where(digits, _FIELD, hashes)


def _leaves_of(data: np.ndarray, starts: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """The leaf of each line, whose first words are at ``cut`` in ``starts``."""
    count = np.diff(cut, append=len(starts))
    place = np.arange(depth)
    there = place < count[:, None]
    parts = np.zeros(there.shape, U64)
    parts[there] = mix(_tokens_of(data, starts, (cut[:, None] + place)[there]))
    parts *= U64(3) + U64(2) * place.astype(U64)
    return mix(count.astype(U64) + parts.sum(axis=1, dtype=U64))


def _parse(depth: int, among: np.ndarray | None = None):
    """A mapInArrow function from (text_key, text) to the leaves of each text.

    With ``among``, bits of leaves (see ``_leaf_bits``), it gives whole lines instead, those
    of its leaves: only their words are hashed beyond the leading ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, _, data, offsets in utf8_runs(batch.column(1)):
                starts = word_starts(data, offsets)
                if not len(starts):
                    continue
                # A line with a token begins at a text's or a line's first word.
                newlines = np.flatnonzero(data == _NEWLINE)
                edges = np.searchsorted(starts, np.concatenate([offsets[:-1], newlines]))
                cut = np.unique(edges[edges < len(starts)])
                leaf = _leaves_of(data, starts, cut, depth)
                words = np.diff(cut, append=len(starts))
                text = np.searchsorted(offsets, starts[cut], "right") - 1
                kept = np.arange(len(cut))
                if among is not None:
                    place = (leaf & U64(LEAF_BITS - 1)).astype(np.int64)
                    kept = np.flatnonzero(among[place >> 3] >> (place & 7) & 1)
                key = batch.column(0).take(pa.array(text[kept] + at))
                columns = [key, pa.array(leaf[kept].view(np.int64)), pa.array(words[kept].astype(np.int32))]
                if among is None:
                    yield pa.RecordBatch.from_arrays(columns, names=_LEAF)
                    continue
                in_text = np.diff(np.searchsorted(starts, offsets)).astype(np.int32)
                line = np.searchsorted(newlines, starts[cut[kept]])
                line -= np.searchsorted(newlines, offsets[text[kept]])
                cuts = np.concatenate([[0], np.cumsum(words[kept])])
                some = np.repeat(cut[kept] - cuts[:-1], words[kept]) + np.arange(cuts[-1])
                tokens = _tokens_of(data, starts, some)
                lists = pa.ListArray.from_arrays(
                    pa.array(cuts.astype(np.int32)), pa.array(tokens.view(np.int64))
                )
                columns += [pa.array(line.astype(np.int32)), pa.array(in_text[text[kept]]), lists]
                yield pa.RecordBatch.from_arrays(columns, names=_LINE)

    return run


def _leaf_bits(leaves: DataFrame) -> np.ndarray:
    """LEAF_BITS bits, set at the low ones of each of these leaves.

    Other leaves may share a bit, so lines found by it are joined with the leaves themselves.
    """
    place = F.col("leaf").bitwiseAND(LEAF_BITS - 1) + 1
    parts = leaves.groupBy(F.bitmap_bucket_number(place).alias("part"))
    parts = parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    out = np.zeros(LEAF_BITS // 8, np.uint8)
    for part, bits in parts:
        out[(part - 1) * len(bits) : part * len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def _text_key(docs: DataFrame):
    """Two hashes of the text: with one, some texts of a very large table would be confused."""
    return F.struct(
        F.xxhash64(docs["text"]).alias("t1"), F.xxhash64(F.lit(1), docs["text"]).alias("t2")
    ).alias("text_key")


def near_copies(docs: DataFrame) -> DataFrame:
    """(text_key, source) of each text of ``docs`` (text, ...) that has near copies there.

    ``source`` is the same for all texts of a group. Near copies are linked by sets of
    five-word shingles with a similarity of 0.8 or more. Null texts and texts without words
    are in no group; equal texts alone are no group, since they have one key.
    """
    texts = docs.where("text IS NOT NULL").select(F.xxhash64("text").alias("doc_id"), "text")
    # The tables of the join are gone before the templates are made.
    with work_tables(docs.sparkSession):
        rows = jaccard_rows(texts, width=5, num=80, den=100)[1].where("n_shingles > 0")
        groups = rows.select(
            F.struct("row.t1", "row.t2").alias("text_key"),
            F.struct(F.col("component.d1").alias("t1"), F.col("component.d2").alias("t2")).alias("source"),
        )
        groups = saved(groups.distinct(), "groups")
        several = groups.groupBy("source").count().where("count > 1").select("source")
        named = groups.join(several, "source", "left_semi").select("text_key", "source")
        return saved(named, "copies", outlives=True)


def recurring_leaves(
    docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, long_docs: int = LONG_DOCS
) -> DataFrame:
    """The lines of different texts in leaves that enough texts have.

    (text_key, leaf, words, line, text_words, tokens): words of the line and of its text.
    """
    texts = docs.where("text IS NOT NULL").select(_text_key(docs), "text")
    # Only leaves, and later only lines of recurring leaves, go through a shuffle.
    leaves = texts.mapInArrow(_parse(depth), _LEAF_SCHEMA).distinct()
    leaves = leaves.groupBy("leaf", "words").count()
    leaves = leaves.where(F.col("count") >= _needed(min_docs, long_docs)).select("leaf")
    leaves = saved(leaves.distinct(), "leaves")
    parsed = texts.mapInArrow(_parse(depth, _leaf_bits(leaves)), _LINE_SCHEMA)
    lines = semi_join(parsed, leaves, "leaf").dropDuplicates(["text_key", "line"])
    return saved(lines.select(*_LINE), "lines")


def _needed(min_docs: int, long_docs: int):
    """Documents that a line of so many words must occur in."""
    return F.when(F.col("words") > LONG_WORDS, long_docs).otherwise(min_docs)


def template_lines(
    lines: DataFrame,
    min_docs: int = MIN_DOCS,
    long_docs: int = LONG_DOCS,
    min_constant: int = MIN_CONSTANT,
    min_held: int = MIN_HELD,
    copies: DataFrame | None = None,
) -> DataFrame:
    """(text_key, leaf, words, line, text_words) of those ``lines`` whose template recurs.

    ``lines`` come from ``recurring_leaves``. Texts that ``copies`` (see ``near_copies``)
    gives the same source count as one document. A template is a leaf with the constant
    tokens: those without a digit that enough documents have at their position, which is
    ``long_docs`` for a line of more than LONG_WORDS words and ``min_docs`` for others. It
    recurs if as many documents have it, and at least ``min_constant`` hundredths of the
    line's tokens are constant or, with a digit, general, and ``min_held`` hundredths, one at
    least, are constant. Lines are shuffled by leaf and counted there; in a leaf of very many
    tokens they are counted by joins, of rows made distinct first, so that no task has all
    of a line in very many documents.
    """
    if copies is None:
        lines = lines.withColumn("source", F.col("text_key"))
    else:
        known = F.broadcast(copies) if copies.count() <= BROADCAST_IDS else copies
        lines = lines.join(known, "text_key", "left")
        lines = lines.withColumn("source", F.coalesce("source", "text_key"))
    # A leaf within the bound is counted by one task; the tokens of a larger one are spread.
    of_leaf = lines.groupBy("leaf").agg(F.sum("words").alias("tokens"))
    large = saved(of_leaf.where(F.col("tokens") > LEAF_TOKENS).select("leaf"), "large")
    within = lines.join(large, "leaf", "left_anti").select(*_SOURCED)
    within = within.repartition("leaf").sortWithinPartitions("leaf", "words")
    within = within.mapInArrow(_within_leaves(min_docs, long_docs, min_constant, min_held), _FOUND_SCHEMA)
    if large.isEmpty():
        return within
    spread = _spread_leaves(semi_join(lines, large, "leaf"), min_docs, long_docs, min_constant, min_held)
    return within.unionByName(spread)


def _spread_leaves(
    lines: DataFrame, min_docs: int, long_docs: int, min_constant: int, min_held: int
) -> DataFrame:
    """``template_lines`` by joins over single tokens: for leaves of any size."""
    needed = _needed(min_docs, long_docs)
    field = F.lit(int(_FIELD))
    kept = ["text_key", "source", "leaf", "words", "line", "text_words"]
    plain = F.size(F.filter("tokens", lambda t: t != field)).alias("plain")
    tokens = lines.select(*kept, plain, F.posexplode("tokens").alias("position", "token"))
    tokens = tokens.where(F.col("token") != field)
    place = ["leaf", "position", "token"]
    constant = tokens.select("source", "words", *place).distinct().groupBy("words", *place).count()
    constant = constant.where(F.col("count") >= needed).select(*place)
    templates = (
        tokens.join(constant, place, "left_semi")
        .groupBy(*kept, "plain")
        .agg(F.count("*").alias("held"), F.bit_xor(F.xxhash64("position", "token")).alias("code"))
        .where((F.col("held") + F.col("words") - F.col("plain")) * 100 >= F.col("words") * min_constant)
        .where(F.col("held") * 100 >= F.col("words") * min_held)
    )
    template = ["leaf", "held", "code"]
    templates = saved(templates, "templates")
    often = templates.select("source", "words", *template).distinct().groupBy("words", *template).count()
    often = saved(often.where(F.col("count") >= needed).select(*template), "often")
    return semi_join(templates, often, template).select(*_FOUND)


def _within_leaves(min_docs: int, long_docs: int, min_constant: int, min_held: int):
    """A mapInArrow function over lines sorted by leaf: ``template_lines`` of whole leaves."""

    def found(lines: pa.Table) -> Iterator[pa.RecordBatch]:
        kept = _recurring(lines, min_docs, long_docs, min_constant, min_held)
        yield from lines.select(_FOUND).take(pa.array(kept)).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            # Up to the beginning of the batch's last leaf everything is there.
            leaf = batch.column(_SOURCED.index("leaf")).to_numpy()
            last = held[-1].column(_SOURCED.index("leaf"))[-1].as_py() if held else leaf[0]
            cut = int(np.flatnonzero(leaf != leaf[-1])[-1] + 1) if leaf[0] != leaf[-1] else 0
            tokens = int(batch.column(_SOURCED.index("words")).to_numpy().sum(dtype=np.int64))
            if size + tokens > TASK_TOKENS and held and (cut or last != leaf[-1]):
                yield from found(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held, size, batch = [], 0, batch.slice(cut)
                tokens = int(batch.column(_SOURCED.index("words")).to_numpy().sum(dtype=np.int64))
            held.append(batch)
            size += tokens
        if held:
            yield from found(pa.Table.from_batches(held))

    return run


def _recurring(
    lines: pa.Table, min_docs: int, long_docs: int, min_constant: int, min_held: int
) -> np.ndarray:
    """Places of those of some leaves' lines whose template recurs."""
    lines = lines.combine_chunks()
    leaf, words = (lines.column(c).to_numpy() for c in ("leaf", "words"))
    source = lines.column("source").combine_chunks()
    t1, t2 = (np.asarray(source.field(c)).view(U64) for c in ("t1", "t2"))
    source = mix(t1 + mix(t2))
    tokens = lines.column("tokens").combine_chunks().flatten().to_numpy().view(U64)
    needed = np.where(words > LONG_WORDS, long_docs, min_docs)
    cuts = np.cumsum(words, dtype=np.int64) - words
    line = np.repeat(np.arange(len(words)), words)
    position = np.arange(len(tokens)) - cuts[line]
    place = mix(leaf.view(U64) + words.astype(U64))[line] + position.astype(U64) * U64(3)
    key = mix(tokens + mix(place))
    plain = np.flatnonzero(tokens != _FIELD)
    constant = np.zeros(len(tokens), bool)
    constant[plain] = _sources(key[plain], source[line[plain]]) >= needed[line[plain]]
    held = np.add.reduceat(constant.astype(np.int64), cuts)
    code = np.add.reduceat(np.where(constant, key, U64(0)), cuts)
    fields = words - np.bincount(line[plain], minlength=len(words))
    kept = (held + fields) * 100 >= words.astype(np.int64) * min_constant
    kept = np.flatnonzero(kept & (held * 100 >= words.astype(np.int64) * min_held) & (held > 0))
    template = mix(code[kept] + mix(leaf[kept].view(U64) + held[kept].astype(U64)))
    return kept[_sources(template, source[kept]) >= needed[kept]]


def _sources(key: np.ndarray, source: np.ndarray) -> np.ndarray:
    """For each place the number of different sources that its key has in all."""
    order = np.lexsort((source, key))
    key, source = key[order], source[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    number = np.cumsum(fresh) - 1
    fresh[1:] |= source[1:] != source[:-1]
    out = np.empty(len(key), np.int64)
    out[order] = np.bincount(number, fresh)[number] if len(key) else 0
    return out


def drop_templates(
    docs: DataFrame,
    depth: int = DEPTH,
    min_docs: int = MIN_DOCS,
    long_docs: int = LONG_DOCS,
    min_constant: int = MIN_CONSTANT,
    min_held: int = MIN_HELD,
    most_dropped: int = MOST_DROPPED,
) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``n_lines``, ``n_dropped`` and the text that is left.

    Lines are cut at line feeds; lines without tokens are left alone. Null and empty texts
    stay as they are, with 0 lines of which 0 are dropped. Lines whose template recurs (see
    ``template_lines``) go from every text, equal texts counting as one document.

    So that copies do not wipe each other out, the texts that would lose a line of more than
    LONG_WORDS words, or more than ``most_dropped`` hundredths of their words, are joined
    among each other by ``near_copies``. A group of near copies counts as one document in a
    second count, and a text in a group keeps all its lines if it would still lose more than
    ``most_dropped`` hundredths of its words. Every row comes back, as often as it came, and
    further columns of any name but ``n_lines`` and ``n_dropped`` are handed on.
    """
    lines = recurring_leaves(docs, depth, min_docs, long_docs)
    found = saved(template_lines(lines, min_docs, long_docs, min_constant, min_held), "found")
    heavy = F.sum("words") * 100 > F.first("text_words") * most_dropped
    losing = found.groupBy("text_key").agg(((F.max("words") > LONG_WORDS) | heavy).alias("much"))
    losing = saved(losing.where("much").select("text_key"), "losing")
    texts = docs.where("text IS NOT NULL").select(_text_key(docs), "text")
    copies = near_copies(semi_join(texts, losing, "text_key"))
    # Another count is due only in leaves with a line of a near copy.
    touched = lines.join(copies, "text_key", "left_semi").select("leaf").distinct()
    touched = saved(touched, "touched")
    again = semi_join(lines, touched, "leaf")
    again = template_lines(again, min_docs, long_docs, min_constant, min_held, copies)
    found = found.join(touched, "leaf", "left_anti").unionByName(again)
    # The lines of one text at most.
    gone = found.groupBy("text_key").agg(F.collect_set("line").alias("gone"), heavy.alias("heavy"))
    gone = gone.join(copies.withColumn("copied", F.lit(True)), "text_key", "left")
    gone = gone.where("NOT (heavy AND copied IS NOT NULL)").select("text_key", "gone")
    # Texts are shuffled once, whatever the size of the other side: how many lines go grows
    # with the documents, so there is no bound for a broadcast.
    gone = saved(gone, "gone").hint("merge")
    out = docs.select(F.struct(*docs.columns).alias("given"), _text_key(docs))
    out = out.join(gone, "text_key", "left").withColumn("split", F.split("given.text", "\n", -1))
    left = F.expr("array_join(filter(split, (x, i) -> NOT array_contains(gone, i)), '\\n')")
    n_lines = F.when(F.coalesce(F.length("given.text"), F.lit(0)) == 0, 0).otherwise(F.size("split"))
    others = [F.col(f"given.`{c}`") for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    return out.select(
        *others,
        F.when(F.col("gone").isNull(), F.col("given.text")).otherwise(left).alias("text"),
        n_lines.alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).alias("n_dropped"),
    )
