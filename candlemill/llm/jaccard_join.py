"""N-gram Jaccard join: documents linked by the overlap of their shingle sets, exactly.

Sizes are cut into bands so that two sets that can link lie in the same band or in
neighbouring ones. Each band is a tile: sets are compared within it and with those of the
next. Inside a tile the hash range is cut into more parts than two linked sets can differ
by in that tile, so linked sets have at least one part that holds the same shingles in both.
All parts with the same smallest set make one block; a set is sent once to each of its
blocks, whatever the number of parts behind them. In a block, bitmaps of hashed shingles
bound the overlap of two sets from above; what is left is decided there by intersecting the
sorted hash arrays. A block gives back the number of links of each set and a spanning forest
of them, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import saved, semi_join
from candlemill.llm.components import connected_components
from candlemill.llm.words import U64, mix, shingle_sets

# Sets of a block, and shingles of them, that are compared with as many others at once.
CHUNK = 2048
CHUNK_SHINGLES = 1 << 20
_NODE = "struct<doc_id: long, d1: long, d2: long>"
_TILE = ["block", "i", "j", "chunk", "node", "n", "rows", "blocks", "shingles"]
_OUT_ROWS = 500


class Tiles:
    """Size bands for a threshold of num / den, and the number of parts in each tile."""

    def __init__(self, num: int, den: int):
        if not 0 < num <= den:
            raise ValueError("the threshold must be above 0 and at most 1")
        # At a threshold of 1 only equal sets link: one band, one part.
        largest = [1 if num < den else 1 << 31]
        while largest[-1] < 1 << 31:
            largest.append(max(largest[-1] * den // num, largest[-1] + 1))
        self.largest = np.array(largest)
        # Linked sets: |A ^ B| <= |A| (den - num) / num, A the smaller one, in this band.
        self.differ = self.largest * (den - num) // num
        # An eighth more than needed, so that nearly all sets fill more parts than may differ.
        self.parts = self.differ + 2 + self.differ // 8

    def of(self, size: int) -> list[int]:
        """Tiles in which a set of this size is compared.

        In a tile where none may differ only equal sets link; those are one set already.
        """
        band = int(np.searchsorted(self.largest, size))
        return [t for t in (band - 1, band) if t >= 0 and self.differ[t] > 0]


def part_keys(shingles: np.ndarray, tiles: Tiles) -> np.ndarray:
    """One key for each tile and part: the tile, the part and the shingles in it.

    48 bits are kept: keys that meet by chance only add candidates. A set that fills more
    parts than linked sets may differ by shares one of those with each set it links with, so
    it leaves its empty parts out, which very many sets have in common; of two sets that fill
    fewer, both keep them.
    """
    if not len(shingles):
        return np.zeros(0, np.int64)
    running = np.concatenate([np.zeros(1, U64), np.cumsum(mix(shingles + U64(77)), dtype=U64)])
    high = shingles >> U64(32)
    keys = []
    for tile in tiles.of(len(shingles)):
        parts = int(tiles.parts[tile])
        part = (high * U64(parts)) >> U64(32)
        edge = np.searchsorted(part, np.arange(parts + 1, dtype=U64))
        held = running[edge[1:]] - running[edge[:-1]]
        where = (np.arange(parts, dtype=U64) << U64(16)) + U64(tile)
        key = mix(held + mix(where + U64(5))) >> U64(16)
        filled = np.diff(edge) > 0
        keys.append(key[filled] if filled.sum() > tiles.differ[tile] else key)
    return np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)


def bitmap_of(shingles: np.ndarray) -> np.ndarray:
    """Bits at the shingles' hashes; a power of two, at least four times as many as shingles."""
    bits = 64
    while bits < 4 * len(shingles):
        bits *= 2
    at = mix(shingles) & U64(bits - 1)
    out = np.zeros(bits, bool)
    out[at.astype(np.int64)] = True
    return np.packbits(out, bitorder="little").view(U64)


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """A bitmap of fewer words: what it would have been with fewer bits."""
    while len(bits) > width:
        bits = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
    return bits


def overlap_bound(a: np.ndarray, n_a: int, b: np.ndarray, n_b: int) -> int:
    """No two sets with these bitmaps and sizes share more shingles than this."""
    width = min(len(a), len(b))
    a, b = folded(a, width), folded(b, width)
    only_a = int(np.bitwise_count(a & ~b).sum())
    only_b = int(np.bitwise_count(b & ~a).sum())
    return min(n_a - only_a, n_b - only_b)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Shingles in both of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def _per_text(make, schema: pa.Schema, width: int):
    """A mapInArrow function: ``make`` turns a shingle set into a row's values after doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at, rows = batch.column(0), 0, []
            for i, shingles in enumerate(shingle_sets(batch.column(1), width)):
                rows.append(make(shingles))
                if len(rows) == _OUT_ROWS or i == len(ids) - 1:
                    columns = [ids.slice(at, len(rows))]
                    columns += [pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[1:])]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)
                    at, rows = i + 1, []

    return run


def _digest(s: np.ndarray) -> tuple[int, int]:
    return (
        int(mix(s + U64(1)).sum(dtype=U64).view(np.int64)),
        int(mix(s * U64(3) + U64(2)).sum(dtype=U64).view(np.int64)),
    )


def shingle_counts(docs: DataFrame, width: int) -> DataFrame:
    """(row, n_shingles, d1, d2): the size and a 128-bit digest of every set.

    ``row`` is (doc_id, t1, t2): the id and two hashes of the text.
    """
    row = pa.struct([("doc_id", pa.int64()), ("t1", pa.int64()), ("t2", pa.int64())])
    longs = [(c, pa.int64()) for c in ("n_shingles", "d1", "d2")]
    run = _per_text(lambda s: (len(s), *_digest(s)), pa.schema([("row", row), *longs]), width)
    return docs.select(text_row(docs).alias("row"), "text").mapInArrow(
        run, "row struct<doc_id: long, t1: long, t2: long>, n_shingles long, d1 long, d2 long"
    )


def text_row(docs: DataFrame):
    """What tells rows apart: the id and two hashes of the text. Only equal rows agree in it."""
    return F.struct(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.xxhash64(docs["text"]).alias("t1"),
        F.xxhash64(F.lit(1), docs["text"]).alias("t2"),
    )


def _nodes(counts: DataFrame) -> DataFrame:
    """(node, n, rows): one row for each distinct set, with the rows that have it.

    A node is the smallest id and the digest, so an id that comes with several texts has as
    many nodes, and the smallest node of a component holds its smallest id.
    """
    named = counts.where("n_shingles > 0 AND row.doc_id IS NOT NULL")
    sets = named.groupBy("n_shingles", "d1", "d2").agg(
        F.min("row.doc_id").alias("doc_id"), F.count("*").alias("rows")
    )
    return sets.select(
        F.struct("doc_id", "d1", "d2").alias("node"), F.col("n_shingles").alias("n"), "rows"
    )


def _blocks(docs: DataFrame, nodes: DataFrame, width: int, tiles: Tiles) -> DataFrame:
    """(block, key): the sets to compare with each other, a set by the first half of its digest.

    A block is named by the smallest key of a part. Two different sets of one such key would
    be missed only if they linked through nothing but parts of their own.
    """
    first = saved(nodes.select("node.doc_id").distinct(), "first")
    texts = semi_join(docs.select("doc_id", "text"), first, "doc_id")
    digest = _per_text(lambda s: (_digest(s)[0], part_keys(s, tiles)), _KEYED, width)
    parts = texts.mapInArrow(digest, "doc_id long, key long, parts array<long>")
    parts = saved(parts.select("key", F.explode("parts").alias("part")), "parts")
    # Two integers a row, reduced in each task first, so a part that very many sets have is cheap.
    ends = parts.groupBy("part").agg(F.min("key").alias("block"), F.max("key").alias("high"))
    shared = ends.where("block < high").select("part", "block")
    return parts.join(shared, "part").select("block", "key").distinct()


def _sets(docs: DataFrame, nodes: DataFrame, blocks: DataFrame, width: int) -> DataFrame:
    """(node, key, n, rows, shingles) of the sets that lie in a block, each once."""
    wanted = blocks.select(F.col("key").alias("d1")).distinct()
    nodes = nodes.select("node.*", "rows").join(wanted, "d1", "left_semi")
    nodes = saved(nodes, "candidates")
    ids = saved(nodes.select("doc_id").distinct(), "candidate-ids")
    run = _per_text(lambda s: (*_digest(s), len(s), s.tobytes()), _SETS, width)
    texts = semi_join(docs.select("doc_id", "text"), ids, "doc_id")
    sets = texts.mapInArrow(run, "doc_id long, d1 long, d2 long, n long, shingles binary")
    node = ["doc_id", "d1", "d2"]
    sets = sets.dropDuplicates(node).join(nodes, node)
    return sets.select(F.struct(*node).alias("node"), F.col("d1").alias("key"), "n", "rows", "shingles")


_KEYED = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("parts", pa.list_(pa.int64()))])
_SETS = pa.schema([(c, pa.int64()) for c in ("doc_id", "d1", "d2", "n")] + [("shingles", pa.binary())])


def _tiled(blocks: DataFrame, sets: DataFrame) -> DataFrame:
    """Sets dealt into tiles: pairs of chunks of a block, bounded in sets and in shingles.

    Each set carries the names of all its blocks, at most as many as it has parts.
    """
    sizes = blocks.join(sets.select("key", "n"), "key").groupBy("block")
    sizes = sizes.agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    sizes = sizes.select(
        "block",
        F.ceil(F.greatest(F.col("sets") / CHUNK, F.col("shingles") / CHUNK_SHINGLES))
        .cast("int")
        .alias("chunks"),
    )
    of_key = blocks.groupBy("key").agg(F.sort_array(F.collect_set("block")).alias("blocks"))
    held = blocks.join(sizes, "block").join(sets.join(of_key, "key"), "key")
    chunk = F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int")
    held = held.withColumn("chunk", chunk).withColumn(
        "tile",
        F.explode(
            F.expr(
                "transform(sequence(0, chunks - 1),"
                " c -> struct(least(c, chunk) AS i, greatest(c, chunk) AS j))"
            )
        ),
    )
    held = held.withColumn("i", F.col("tile.i")).withColumn("j", F.col("tile.j"))
    return held.select(*_TILE).repartition("block", "i", "j").sortWithinPartitions("block", "i", "j")


class _Lists:
    """Lists of numbers one after the other, numbered anew, and how many of them two share."""

    def __init__(self, values: np.ndarray, owner: np.ndarray, lists: int):
        known, number, held = np.unique(values, return_inverse=True, return_counts=True)
        # What one list alone holds is shared with no other.
        several = held[number] > 1
        self.number = number[several]
        self.edge = np.searchsorted(owner[several], np.arange(lists + 1))
        self.mark = np.zeros(len(known), bool)

    def shared(self, x: int, others: np.ndarray) -> np.ndarray:
        """For each of ``others`` the numbers that it has in common with list ``x``."""
        own = self.number[self.edge[x] : self.edge[x + 1]]
        if not len(own):
            return np.zeros(len(others), np.int64)
        length = self.edge[others + 1] - self.edge[others]
        end = np.cumsum(length)
        at = np.repeat(self.edge[others] - end + length, length) + np.arange(length.sum())
        self.mark[own] = True
        running = np.concatenate([[0], np.cumsum(self.mark[self.number[at]])])
        self.mark[own] = False
        return running[end] - running[end - length]


def _decided(tile: pa.Table, num: int, den: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """For the sets of a tile the rows each links with, and links that span its components.

    Every pair of the tile's two chunks is decided, but for those that meet in a block of a
    smaller name as well: a pair counts in the first block that both its sets are in.
    """
    i, j, block = (tile.column(c)[0].as_py() for c in ("i", "j", "block"))
    chunk, n, rows = (tile.column(c).to_numpy() for c in ("chunk", "n", "rows"))
    size = len(n)
    shingles = tile.column("shingles").combine_chunks()
    sets = [np.frombuffer(b.as_buffer(), U64) for b in shingles]
    bitmaps = [bitmap_of(s) for s in sets]
    width = min(len(b) for b in bitmaps)
    bits = np.array([folded(b, width) for b in bitmaps])
    exact = _Lists(np.concatenate(sets), np.repeat(np.arange(size), n), size)
    blocks = tile.column("blocks").to_pylist()
    earlier = [[b for b in held if b < block] for held in blocks]
    owner = np.repeat(np.arange(size), [len(e) for e in earlier])
    elsewhere = _Lists(np.array([b for e in earlier for b in e], np.int64), owner, size)

    links, forest, group = np.zeros(size, np.int64), [], np.arange(size)
    right = np.flatnonzero(chunk == j)
    for x in np.flatnonzero(chunk == i):
        y = right[right > x] if i == j else right
        y = y[np.minimum(n[y], n[x]) * den >= np.maximum(n[y], n[x]) * num]
        bound = np.minimum(
            n[x] - np.bitwise_count(bits[x] & ~bits[y]).sum(axis=1, dtype=np.int64),
            n[y] - np.bitwise_count(bits[y] & ~bits[x]).sum(axis=1, dtype=np.int64),
        )
        y = y[bound * (den + num) >= num * (n[x] + n[y])]
        y = y[elsewhere.shared(x, y) == 0]
        y = y[exact.shared(x, y) * (den + num) >= num * (n[x] + n[y])]
        if not len(y):
            continue
        links[x] += rows[y].sum()
        links[y] += rows[x]
        groups, at = np.unique(group[y], return_index=True)
        new = groups != group[x]
        if new.any():
            forest += [(x, v) for v in y[at[new]]]
            group[np.isin(group, groups[new])] = group[x]
    return links, forest


def _within_tiles(num: int, den: int):
    """A mapInArrow function over sets sorted by tile: (u, v, links).

    A row without ``v`` gives the rows that ``u`` links with in the tile, a row with it a link.
    """

    def found(tile: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(tile)
        links, forest = _decided(table, num, den)
        node = table.column("node").combine_chunks()
        some = np.flatnonzero(links)
        u = np.concatenate([some, [a for a, _ in forest]]).astype(np.int64)
        v = pa.array([None] * len(some) + [int(b) for _, b in forest], pa.int64())
        count = pa.array([*links[some].tolist(), *[None] * len(forest)], pa.int64())
        yield pa.RecordBatch.from_arrays([node.take(pa.array(u)), node.take(v), count], ["u", "v", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            place = np.stack([batch.column(c).to_numpy() for c in _TILE[:3]])
            cut = np.flatnonzero((np.diff(place) != 0).any(axis=0)) + 1
            for a, b in zip([0, *cut], [*cut, batch.num_rows]):
                key = tuple(place[:, a])
                if tile and key != last:
                    yield from found(tile)
                    tile = []
                last = key
                tile.append(batch.slice(a, b - a))
        if tile:
            yield from found(tile)

    return run


def jaccard_rows(
    docs: DataFrame, width: int = 5, num: int = 80, den: int = 100
) -> tuple[DataFrame, DataFrame]:
    """(u, v) and (row, n_shingles, component, n_links): ``jaccard_join`` by nodes and rows.

    ``row`` is ``text_row``; ``component`` is the smallest node that links lead to, null for
    rows without an id and for texts without words.
    """
    tiles = Tiles(num, den)
    counts = saved(shingle_counts(docs, width), "counts")
    nodes = saved(_nodes(counts), "nodes")
    blocks = saved(_blocks(docs, nodes, width, tiles), "blocks")
    sets = saved(_sets(docs, nodes, blocks, width), "sets")
    found = _tiled(blocks, sets).mapInArrow(
        _within_tiles(num, den), f"u {_NODE}, v {_NODE}, links long"
    )
    found = saved(found, "found")
    forest = found.where("v IS NOT NULL").select("u", "v")
    labels = connected_components(forest)
    reached = found.where("v IS NULL").groupBy(F.col("u").alias("node"))
    reached = reached.agg(F.sum("links").alias("others"))
    nodes = nodes.join(labels, "node", "left").join(reached, "node", "left").select(
        F.col("n").alias("n_shingles"),
        "node.d1",
        "node.d2",
        F.coalesce("component", "node").alias("component"),
        (F.col("rows") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
    )
    out = counts.join(nodes, ["n_shingles", "d1", "d2"], "left")
    has_id = F.col("row.doc_id").isNotNull()
    return forest, out.select(
        "row",
        "n_shingles",
        F.when(has_id, F.col("component")).alias("component"),
        F.when(has_id, F.coalesce("n_links", F.lit(0))).alias("n_links"),
    )


def jaccard_join(
    docs: DataFrame, width: int = 5, num: int = 80, den: int = 100
) -> tuple[DataFrame, DataFrame]:
    """Links of ``docs`` (doc_id, text, ...) that span its components, and a row for each row.

    Two documents link when the Jaccard similarity of their sets of ``width``-word shingles
    is at least num / den. Words are stretches without 0x20 and 0x09-0x0D, with A-Z read as
    a-z. A text of fewer words has its whole sequence as its one shingle. Null and empty
    texts, and texts without words, have no shingles and link with nothing.

    The first result is (u, v): links between different sets, each set by a struct of its
    smallest id and its digest. They join all sets that links join, and are fewer than the
    sets of each block; other links are decided and counted, not given. The second is
    (doc_id, n_shingles, component_id, n_links): component_id is the smallest doc_id that
    links lead to, the document's own included, and n_links counts the other rows with an id
    that the row links with, of an equal set or of another one. Repeated rows come back as
    often as they came, and an id that comes with several texts has each of them joined on
    its own; a row without an id has no component and no count, and is counted nowhere. An
    empty table gives no rows. Further columns are not looked at.
    """
    links, rows = jaccard_rows(docs, width, num, den)
    return links, rows.select(
        "row.doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("row.doc_id"))
        .otherwise(F.col("component.doc_id"))
        .alias("component_id"),
        "n_links",
    )


def jaccard_components(
    docs: DataFrame, width: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row; see ``jaccard_join``."""
    return jaccard_join(docs, width, num, den)[1].drop("n_links")
