"""Near duplicates: a Jaccard self-join of word shingle sets in size-banded tiles.

Sets of equal hashes form a class, and classes, not documents, are joined.

Bands and tiles.  Band edges grow by 1/threshold, so two sets that can link lie
in one band or in neighbouring ones, and a set enters the tiles of its band and
of the next.  In band T linked sets differ in at most ``k`` shingles.  The hash
space is cut into ``m > k`` ranges, so at least ``m - k`` ranges hold the same
shingles in both sets: a tile is (band, range, content of the range), and linked
sets meet in at least one.  Ranges without shingles make no tile.  A set that
leaves ``m - k`` ranges or more empty also enters the tiles of another order of the
hash space, and so on until fewer are empty: in the first order in which
either of two linked sets has fewer, they share a range that is not empty.  No
candidate is lost, no tile is capped, and a passage that many documents share
gives few tiles, since its shingles are scattered over ranges with those of the
rest of each document.

Groups.  The smallest class of a tile is its pivot, and a group is a pivot with all
classes of its tiles, each once however many tiles they share: two classes
that meet in a tile are in the group of the tile's pivot.

Bounds.  Each class has a parity bitmap (the xor of its shingles' bits) of two
to four bits a shingle.  The bits in which two bitmaps differ bound the
difference of the sets from below, hence their overlap from above; a wider bitmap is
folded to the width of the narrower one.  Pairs under the bound are dropped
before the sorted arrays are intersected exactly.

Components.  A class is first compared with the pivot it shares most tiles with.
Groups that still hold several components are compared, in blocks, pairs of one component
left out: first each class with its most similar partner in the group by the bitmaps,
then, in groups still not connected, all pairs that pass the bound.  The pairs of a
group of near copies are thus not listed.  Exact comparison brings a class and its
partners together, the class's array once for up to ``PARTNERS`` of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsight.llm.bitmap import bitmap, in_bitmap
from jobsight.llm.packed import emitted, rows_of
from jobsight.llm.store import discard, written
from jobsight.llm.words import BY_SPACE, U, grams, hash_words, mix

#: Words of a shingle and percent of similarity of the registered query.
SHINGLE, PERCENT = 4, 85
#: The pipeline's near-duplicate stage.
STAGE_SHINGLE, STAGE_PERCENT = 5, 80
#: Rows, and bytes of bitmaps, of a block of a group; larger groups are compared block by block.
BLOCK_ROWS, BLOCK_BYTES = 4096, 32 << 20
#: Partners that meet one copy of a class's array.
PARTNERS = 1024
#: Partners of a class by which groups are compared, round by round; at last all.
ROUNDS = (1, None)
#: Orders of the hash space that a set may need; each is enough for most sets.
MOST_TURNS = 256
#: Classes a task remembers, to hash each once; then it begins to forget.
REMEMBERED = 1 << 18


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer words make one shingle, none an empty set."""
    if not len(words):
        return np.empty(0, U)
    return np.unique(grams(words, min(size, len(words))))


def class_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def parity_bitmap(shingles: np.ndarray) -> bytes:
    """Parities of the shingles per bit; twice as many bits as shingles or more, a power of two."""
    bits = max(64, 1 << (2 * len(shingles) - 1).bit_length()) if len(shingles) else 64
    odd = np.bincount((shingles & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(bitmap_words: np.ndarray, words: int) -> np.ndarray:
    """A bitmap (or rows of them) with so many words: of a wider one, the xor of its halves."""
    while bitmap_words.shape[-1] > words:
        half = bitmap_words.shape[-1] // 2
        bitmap_words = bitmap_words[..., :half] ^ bitmap_words[..., half:]
    return bitmap_words


def parts(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def signatures(size: int):
    """id, text key -> also the set's size, class and bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            sets = [shingle_set(w, size) for w in hash_words(part.column(2).to_pylist(), BY_SPACE)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([class_key(s) for s in sets], pa.binary()), pa.array([parity_bitmap(s) for s in sets], pa.binary())],
                names=["doc_id", "tkey", "n", "cls", "bits"])
    return run


@lru_cache(maxsize=None)
def band_edges(percent: int) -> tuple[int, ...]:
    """Smallest set size of each band, up to sets of 2**40 shingles."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(100 * out[-1] // percent + 1)
    return tuple(out)


@lru_cache(maxsize=64)
def band_plan(band: int, percent: int) -> tuple[int, int, np.ndarray | None]:
    """Largest difference k of linked sets in a band's tiles, number of ranges m, inner range edges."""
    largest = band_edges(percent)[band + 1] - 1
    k = (100 - percent) * 2 * largest // (100 + percent)
    if not k:
        return 0, 0, None  # only equal sets link, and those are one class
    smallest = band_edges(percent)[max(0, band - 1)]
    m = k + 1 + max(2, k // 32)
    # so many ranges that the band's smallest sets leave fewer than m - k of them empty, as a rule
    while m < 2 * smallest and m * (1 - math.exp(-smallest / m)) < 1.03 * (k + 1):
        m += max(1, k // 32)
    return k, m, np.array([(i << 64) // m for i in range(1, m)], U)


def tile_keys(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of the tiles that a set enters."""
    own = int(np.searchsorted(band_edges(percent), len(shingles), side="right")) - 1
    out = []
    for band in (own, own + 1):
        k, m, cuts = band_plan(band, percent)
        turn, empty, order = 0, m, shingles
        while m and empty >= m - k:
            if turn == MOST_TURNS:
                raise ValueError(f"a set of {len(shingles)} shingles leaves too many ranges empty in every order")
            if turn:
                order = np.sort(mix(shingles + U(turn)))
            sums = np.zeros(len(order) + 1, U)
            np.cumsum(mix(order), out=sums[1:])
            at = np.concatenate([[0], np.searchsorted(order, cuts), [len(order)]])
            full = at[1:] > at[:-1]
            content = sums[at[1:]] - sums[at[:-1]]
            out.append(mix(content + mix(np.arange(m, dtype=U) + U((band << 40) + (turn << 32))))[full])
            empty = m - int(full.sum())
            turn += 1
    return np.concatenate(out) if out else np.empty(0, U)


def tiles(size: int, percent: int):
    """(key, class) rows; a class enters once for the copies a task reads, unless it has met very many classes since."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for part in parts(batches, 256):
            keys, classes = [], []
            for words in hash_words(part.column(0).to_pylist(), BY_SPACE):
                s = shingle_set(words, size)
                name = class_key(s)
                if len(s) and name not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(name)
                    found = tile_keys(s, percent)
                    keys.append(found)
                    classes.append(np.full(len(found), np.frombuffer(name[:8], np.int64)[0]))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(classes))], names=["key", "c"])
    return run


def shared_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (key, class): those of tiles with two classes or more, with the tile's first class.

    Streams: of the tile at hand only its first class is kept in mind.
    """
    key = first = last = None  # of the tile that the previous batch ended in
    alone = False  # its first row has not been given out
    for batch in batches:
        if not batch.num_rows:
            continue
        k, c = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
        new[0] = key is None or k[0] != key or c[0] != last
        begins = np.ones(len(k), bool)
        begins[1:] = k[1:] != k[:-1]
        begins[0] = key is None or k[0] != key
        last_seen = c[-1]
        k, c, begins = k[new], c[new], begins[new]
        if len(k):
            start = np.maximum.accumulate(np.where(begins, np.arange(len(k)), -1))
            pivot = np.where(start >= 0, c[start], first if first is not None else 0)
            goes_on = np.zeros(len(k), bool)  # a tile's first row whose tile has a second one here
            goes_on[:-1] = begins[:-1] & ~begins[1:]
            out = ~begins | goes_on
            rows = [k[out], c[out], pivot[out]]
            if alone and not begins[0]:
                rows = [np.concatenate([[a], b]) for a, b in zip((key, first, first), rows)]
            alone = bool(begins[-1])
            if len(rows[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in rows], names=["key", "c", "pivot"])
            key, first = int(k[-1]), int(pivot[-1])
        last = int(last_seen)


def set_arrays(size: int, bits):
    """The shingle sets of documents whose text key is in the bitmap, repeated rows once, mostly."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for part in parts(batches, 256):
            keys = part.column(1).to_numpy()
            part = part.filter(pa.array(in_bitmap(bits.value, keys.view(U))))
            ids, keys, names, arrays = [], [], [], []
            for i, k, words in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                   hash_words(part.column(2).to_pylist(), BY_SPACE)):
                s = shingle_set(words, size)
                if (i, k) not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add((i, k))
                    ids.append(i)
                    keys.append(k)
                    names.append(class_key(s))
                    arrays.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, part.column(0).type), pa.array(keys, pa.int64()), pa.array(names, pa.binary()),
                                              pa.array(arrays, pa.binary())], names=["doc_id", "tkey", "cls", "shingles"])
    return run


LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def exact_links(percent: int):
    """Rows sorted by (hub, blk, kind), a hub's array (kind 0) before its partners': pairs whose sorted arrays overlap enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            at = a = None
            for hub, blk, kind, node, shingles in rows_of(batches):
                if not kind:
                    at, a = (hub, blk), np.frombuffer(shingles, U)
                elif at == (hub, blk):
                    b = np.frombuffer(shingles, U)
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    if 100 * both >= percent * (len(a) + len(b) - both):
                        yield hub, node
        yield from emitted(rows(), LINKS)
    return run


def may_link(n: np.ndarray, m: int, differ: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of sizes n and m can be similar enough if at least ``differ`` shingles are in one of them only."""
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & ((100 + percent) * ((n + m - differ) // 2) >= percent * (n + m))


def bounded(percent: int):
    """Pairs u, v with sizes and bitmaps -> those that can be similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for u, v, n, m, x, y in rows_of(batches):
                x, y = np.frombuffer(x, U), np.frombuffer(y, U)
                words = min(len(x), len(y))
                if may_link(np.int64(n), m, np.bitwise_count(folded(x, words) ^ folded(y, words)).sum(dtype=np.int64), percent):
                    yield u, v
        yield from emitted(rows(), LINKS)
    return run


def group_pairs(node: np.ndarray, comp: np.ndarray, n: np.ndarray, side: np.ndarray, bits: np.ndarray,
                percent: int, most: int | None) -> Iterator[tuple[int, int]]:
    """Pairs of different components that pass the bound; of each row the ``most`` most similar ones after it, or all."""
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    two = len(right) > 0
    for i in left:
        j = right if two else np.arange(i + 1, len(node))
        j = j[(comp[j] != comp[i]) & (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i]))]
        if len(j):
            differ = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
            passed = np.flatnonzero(may_link(n[j], n[i], differ, percent))
            if most and len(passed) > most:
                passed = passed[np.argsort(differ[passed] / (n[j[passed]] + n[i]), kind="stable")[:most]]
            for p in j[passed]:
                yield min(int(node[i]), int(node[p])), max(int(node[i]), int(node[p]))


def compare_groups(percent: int, most: int | None):
    """Rows sorted by (pivot, i, j): pairs of different components that pass the bound.

    A group holds the rows of two blocks, about 2 * BLOCK_ROWS, or of one (i = j).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for _, members in groupby(rows_of(batches), itemgetter(0, 1, 2)):
                side, node, comp, n, bits = zip(*(m[3:] for m in members))
                if len(node) > 1 and min(comp) != max(comp):
                    words = min(b.size for b in bits) // 8
                    matrix = np.stack([folded(np.frombuffer(b, U), words) for b in bits])
                    yield from group_pairs(np.array(node), np.array(comp), np.array(n), np.array(side), matrix, percent, most)
        yield from emitted(rows(), LINKS)
    return run


def components(nodes: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``node, comp`` for every node; ``links`` has ``u, v``.  comp is the smallest node of the component.

    Each round hooks every component to the smallest it touches, follows the
    hooks to their ends by doubling, and renames the links.
    """
    label = written(nodes.select("node", F.col("node").alias("comp")), f"{name}-labels")
    edges = written(links.filter("u <> v").select("u", "v").distinct(), f"{name}-edges")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hook = written(both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p"), F.lit(True).alias("moved")), f"{name}-hooks")
        while not hook.filter("moved").isEmpty():
            to = hook.select(F.col("u").alias("w"), F.col("p").alias("q"))
            jumped = written(hook.join(to, hook["p"] == to["w"]).select("u", F.col("q").alias("p"), (F.col("p") != F.col("q")).alias("moved")), f"{name}-jumps")
            discard(hook)
            hook = jumped
        moved = written(label.join(hook.drop("moved"), label["comp"] == hook["u"], "left")
                        .select("node", F.coalesce("p", "comp").alias("comp")), f"{name}-labels")
        a, b = hook.select("u", F.col("p").alias("a")), hook.select(F.col("u").alias("v"), F.col("p").alias("b"))
        rest = written(edges.join(a, "u").join(b, "v").filter("a <> b")
                       .select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), f"{name}-edges")
        discard(label, edges, hook)
        label, edges = moved, rest
    discard(edges)
    return label


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document row: ``doc_id, tkey, n_shingles, component_id, first``.

    ``component_id`` is the smallest non-null id reachable by links, the own id
    for documents without shingles.  ``first`` marks the rows of the text that
    stands for its component (``tkey`` is the text's hash).  Null and empty
    texts link with nothing; repeated rows share their class.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tkey"),
                         F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    sig = written(source.mapInArrow(signatures(shingle), f"doc_id {kind}, tkey long, n long, cls binary, bits binary"), "sets")
    # tiles name a class by its first eight bytes; two classes with one such name only add candidates
    classes = written(
        sig.filter("n > 0").groupBy("cls")
        .agg(F.first("n").alias("n"), F.first("bits").alias("bits"), F.min("doc_id").alias("first_id"),
             F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tkey")).alias("rep"))
        .select(F.monotonically_increasing_id().alias("node"), first_word(F.col("cls")).alias("name"), "cls", "n", "bits",
                "first_id", "rep.doc_id", "rep.tkey"), "classes")

    keyed = source.select("text").mapInArrow(tiles(shingle, percent), "key long, c long")
    meets = written(keyed.repartition("key").sortWithinPartitions("key", "c")
                    .mapInArrow(shared_tiles, "key long, c long, pivot long").filter("c <> pivot")
                    .groupBy("c", "pivot").agg(F.count("*").alias("together")), "meets")

    def exact(pairs: DataFrame, name: str) -> DataFrame:
        """Of candidate pairs (u with its partners v) those whose sets are similar enough."""
        pairs = written(pairs.distinct(), f"{name}-pairs")
        if pairs.isEmpty():
            return pairs
        most = pairs.groupBy("u").agg(F.ceil(F.count("*") / PARTNERS).alias("blocks"))
        dealt = pairs.join(most, "u").select("u", "v", F.pmod(F.xxhash64("v"), F.col("blocks")).alias("blk"))
        roles = (dealt.select(F.col("u").alias("hub"), "blk", F.lit(0).alias("kind"), F.col("u").alias("node")).distinct()
                 .unionByName(dealt.select(F.col("u").alias("hub"), "blk", F.lit(1).alias("kind"), F.col("v").alias("node"))))
        reps = written(roles.join(classes.select("node", F.col("cls").alias("name"), F.col("doc_id").alias("d"), F.col("tkey").alias("t")), "node"),
                       f"{name}-reps")
        # a bitmap of fixed size spares most other texts; the join decides
        bits = docs.sparkSession.sparkContext.broadcast(bitmap(reps.select("t"), "t"))
        arrays = source.mapInArrow(set_arrays(shingle, bits), f"doc_id {kind}, tkey long, cls binary, shingles binary")
        met = (arrays.join(reps, (F.col("tkey") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("cls") == F.col("name")))
               .select("hub", "blk", "kind", "node", "shingles"))
        links = written(met.repartition("hub", "blk").sortWithinPartitions("hub", "blk", "kind")
                        .mapInArrow(exact_links(percent), "u long, v long").distinct(), f"{name}-links")
        discard(pairs, reps)
        return links

    partner = meets.groupBy("c").agg(F.max_by("pivot", F.struct("together", "pivot")).alias("pivot"))
    side = lambda p, c: classes.select(F.col("name").alias(c), F.col("node").alias(f"{p}node"), F.col("n").alias(f"{p}n"), F.col("bits").alias(f"{p}bits"))
    stars = (partner.join(side("x_", "c"), "c").join(side("y_", "pivot"), "pivot")
             .select(F.col("y_node").alias("u"), F.col("x_node").alias("v"), F.col("y_n"), F.col("x_n"), F.col("y_bits"), F.col("x_bits"))
             .mapInArrow(bounded(percent), "u long, v long"))
    links = exact(stars, "stars")
    label = components(classes, links, "stars")

    node_of = classes.select(F.col("name").alias("c"), "node")
    in_group = written(meets.select("c", "pivot").unionByName(meets.select(F.col("pivot").alias("c"), "pivot").distinct())
                       .join(node_of, "c").select("pivot", "node").distinct(), "groups")
    discard(meets)
    for at, most in enumerate(ROUNDS):
        rows = written(in_group.select("pivot", "node").join(label, "node").join(classes.select("node", "n"), "node"), f"members{at}")
        open_groups = written(rows.groupBy("pivot").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("size"), F.sum("n").alias("n"))
                              .filter("low <> high")
                              .select("pivot", F.greatest(F.ceil(F.col("size") / BLOCK_ROWS), F.ceil(F.col("n") / (2 * BLOCK_BYTES))).cast("int").alias("blocks")),
                              f"open{at}")
        still = written(rows.join(open_groups, "pivot").select("pivot", "node", "comp", "blocks"), f"still{at}")
        block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        dealt = (still.select("pivot", "node", "comp", "blocks", block.alias("own"))
                 .join(classes.select("node", "n", "bits"), "node")
                 .select("pivot", "node", "comp", "n", "bits", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
                 .select("pivot", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                         F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "node", "comp", "n", "bits"))
        more = exact(dealt.repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j")
                     .mapInArrow(compare_groups(percent, most), "u long, v long"), f"round{at}")
        discard(in_group, rows, open_groups, label)
        in_group = still
        every = written(links.unionByName(more), f"links{at}")
        discard(links, more)
        links = every
        label = components(classes, links, f"round{at}")

    whole = label.join(classes.select("node", "cls", "first_id", "doc_id", "tkey"), "node")
    stands = written(whole.groupBy("comp").agg(
        F.min("first_id").alias("component_id"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tkey")).alias("rep")), "components")
    placed = written(whole.select("comp", "cls").join(stands, "comp")
                     .select("cls", "component_id", F.col("rep.doc_id").alias("rep_id"), F.col("rep.tkey").alias("rep_key")), "placed")
    discard(in_group, label, links, stands, classes)
    return sig.join(placed, "cls", "left").select(
        "doc_id", "tkey", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        ((F.col("n") == 0) | (F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("tkey") == F.col("rep_key")))).alias("first"))


def first_word(cls: Column) -> Column:
    """The first eight bytes of a binary as the long that numpy reads there."""
    swapped = F.concat(*(F.substring(cls, i, 1) for i in range(8, 0, -1)))
    return F.conv(F.hex(swapped), 16, -10).cast("long")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = STAGE_SHINGLE, percent: int = STAGE_PERCENT) -> DataFrame:
    """``docs`` with one text of each component (the one with the smallest id), all columns as they came.

    Documents without shingles stay; of rows that repeat id and text one stays.
    """
    kept = near_duplicates(docs, id_col, text_col, shingle, percent).filter("first").select(
        F.col("doc_id").alias("__d"), F.col("tkey").alias("__t")).distinct()
    marked = docs.withColumn("__k", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    joined = marked.join(kept, (marked["__k"] == kept["__t"]) & marked[id_col].eqNullSafe(kept["__d"]))
    return joined.dropDuplicates(["__t", "__d"]).select(*[joined[c] for c in docs.columns])
