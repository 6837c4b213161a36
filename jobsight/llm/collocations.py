"""Phrase collocations by direct-address tiling.

Words are ranked by frequency within their language, so a word's id is its rank,
and a pair of ids is a cell of a square that is cut into tiles of 256 x 256.
Word frequencies fall with the rank: tiles near the corner, those with
(row + 1) * (column + 1) up to 64, are dense and counted by ``bincount`` into
an array of all their cells; pairs of all other tiles are sparse and counted as
sorted coordinates.  Pairs that are frequent enough are ranked in their turn, and
(rank of a phrase, id of the next word) is again a cell of a square: the same
step counts longer phrases until the longest are reached.  A phrase can only be
frequent if both phrases of one word less in it are.

Texts are read in blocks of about half a million words of one language.  A block's
distinct words, and its distinct pairs, cross a shuffle once per block, so the
most common word weighs no more than any other.  Dense tiles are summed in two
steps (groups of blocks, then all), so no task reads a tile's cells from every block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsight.llm.bitmap import bitmap, in_bitmap
from jobsight.llm.packed import answered, emitted, gathered, groups, next_block, pack, rows_of, unpack
from jobsight.llm.store import discard, written
from jobsight.llm.words import U, mix

#: Of the registered query: words of a phrase, its least frequency, percent of a longer phrase that swallows it, rows a language.
MAX_WORDS, LEAST, SWALLOW, TOP = 3, 10, 50, 2000
BREAKS = b".,;:!?\n\x0b\x0c\r"
_TO_MARKS = bytes.maketrans(BREAKS + b"\t", b"\n" * len(BREAKS) + b" ")
_EDGE = re.compile(rb"[\t\n\x0b\x0c\r .,;:!?]")
#: A text is cut at a blank or break after this many bytes, to bound the word objects at hand.
PIECE = 1 << 20
#: A block ends with the document that brings it to this many words.
BLOCK_WORDS = 1 << 19
TILE, DENSE_TILES = 256, 64
#: Pairs of words that a bundle of sparse tiles is meant to see.
BUNDLE = 1 << 19
#: New entries of a bundle that are held before they are summed.
HELD = 1 << 19
LOW = U((1 << 32) - 1)
#: Exact, in decimals of 38 digits.
SCORE = ("(1000000 * cast(a as decimal(16,0)) * cast(a as decimal(15,0))) div "
         "(cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")

WORD_BLOCKS = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.string())),
                         ("held", pa.list_(pa.int64())), ("payload", pa.binary())])
CODED = "block long, lang string, payload binary"
CODED_SCHEMA = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("payload", pa.binary())])
KEYED = pa.schema([("key", pa.string()), ("payload", pa.binary())])


class Numbers(dict):
    """Words numbered as they come; breaks are -1, nothing is -2."""

    def __init__(self):
        super().__init__({b"\n": -1, b"": -2})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) - 2
        return n


def pieces(data: bytes) -> Iterator[bytes]:
    at = 0
    while len(data) - at > PIECE:
        cut = _EDGE.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        yield data[at:end]
        at = end
    yield data[at:]


def numbered(text: str | None, numbers: Numbers) -> list[np.ndarray]:
    """The words of a text as numbers, in order, with -1 at breaks and at both ends."""
    out = [np.array([-1], np.int32)]
    for piece in pieces((text or "").encode()):
        marks = piece.lower().translate(_TO_MARKS).replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(numbers.__getitem__, marks), np.int32, len(marks))
        out.append(ids[ids != -2])
    return out


def narrow(ids: np.ndarray) -> np.ndarray:
    """Numbers from -1 on in the narrowest signed type that holds them."""
    most = int(ids.max(initial=0))
    return ids.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)


def unbroken(*rows: np.ndarray) -> list[np.ndarray]:
    """Of runs of -1 in the first row only one place stays."""
    first = rows[0]
    keep = np.ones(len(first), bool)
    keep[1:] = (first[1:] >= 0) | (first[:-1] >= 0)
    return [r[keep] for r in rows]


def word_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, text -> blocks: distinct words, their counts, and the words as numbers."""
    number = next_block()

    def block(lang: str, numbers: Numbers, parts: list[np.ndarray]) -> tuple:
        ids, = unbroken(np.concatenate(parts))
        n = len(numbers) - 2
        held = np.bincount(ids[ids >= 0], minlength=n)
        words = [w.decode() for w in list(numbers)[2:]]
        return next(number), lang, words, held, pack(narrow(ids))

    def rows() -> Iterator[tuple]:
        open_blocks: dict[str, tuple[Numbers, list[np.ndarray]]] = {}
        sizes: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                numbers, parts = open_blocks.setdefault(lang, (Numbers(), []))
                found = numbered(text, numbers)
                parts += found
                sizes[lang] = sizes.get(lang, 0) + sum(map(len, found))
                full = list(open_blocks) if sum(sizes.values()) >= 2 * BLOCK_WORDS else [lang] if sizes[lang] >= BLOCK_WORDS else []
                for name in full:
                    yield block(name, *open_blocks.pop(name))
                    sizes.pop(name)
        for name, (numbers, parts) in open_blocks.items():
            yield block(name, numbers, parts)
    for row in rows():
        yield from emitted(iter([row]), WORD_BLOCKS)


def coded_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (block, kind): places and ids of a block's frequent words (kind 0), then the block.

    Gives blocks as ids, -1 for breaks and other words; blocks without a frequent word vanish.
    """
    def rows() -> Iterator[tuple]:
        at, known = None, []
        for batch in batches:
            block, kind, place, rank = (batch.column(k).to_numpy() for k in range(4))
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
            for part in np.split(np.arange(len(block)), cuts):
                if not len(part):
                    continue
                i = int(part[0])
                if block[i] != at:
                    at, known = int(block[i]), []
                if not kind[i]:
                    known.append((place[part], rank[part]))
                elif known:
                    ids, = unpack(batch.column(5)[i].as_buffer())
                    places, ranks = (np.concatenate(x) for x in zip(*known))
                    to = np.full(int(ids.max(initial=0)) + 2, -1, np.int64)
                    to[places] = ranks
                    to[-1] = -1  # what a break, numbered -1, becomes
                    ids = narrow(unbroken(to[ids])[0])
                    yield at, batch.column(4)[i].as_py(), pack(ids, ids)
    yield from emitted(rows(), CODED_SCHEMA, 4 << 20)


def cells(ids: np.ndarray, current: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a phrase of ``words`` words may be frequent, and its cell: rank of all but its last word, id of that word.

    ``current`` has at each place the rank of the phrase of ``words - 1`` words that begins there, or -1.
    """
    n = len(ids) - words + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, U)
    at = np.flatnonzero((current[:n] >= 0) & (current[1:n + 1] >= 0) & (ids[words - 1:] >= 0))
    return at, current[at].astype(U) << U(32) | ids[at + words - 1].astype(U)


def split_by(key: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(key, kind="stable")
    return [p for p in np.split(order, np.flatnonzero(np.diff(key[order])) + 1) if len(p)]


def bundle_of(codes: np.ndarray, bits: int) -> np.ndarray:
    return (mix(codes) >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(codes), np.int64)


def tiled(words: int, salts: int, bits: int):
    """Blocks -> counted cells per dense tile (of a group of blocks) and per bundle of sparse cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for block, lang, payload in rows_of(batches):
                _, codes = cells(*unpack(payload), words)
                codes, counts = np.unique(codes, return_counts=True)
                i, j = (codes >> U(32)) // U(TILE), (codes & LOW) // U(TILE)
                dense = (i + U(1)) * (j + U(1)) <= U(DENSE_TILES)
                salt = int(mix(np.array([block], np.int64).view(U))[0] % U(salts))
                some = np.flatnonzero(dense)
                for p in split_by(i[some] << U(32) | j[some]):
                    p = some[p]
                    cell = (codes[p] >> U(32)) % U(TILE) * U(TILE) + (codes[p] & LOW) % U(TILE)
                    yield f"{salt}\t{i[p[0]]}\t{j[p[0]]}\t{lang}", pack(cell.astype(np.uint16), counts[p].astype(np.min_scalar_type(counts[p].max())))
                some = np.flatnonzero(~dense)
                for p in split_by(bundle_of(codes[some], bits)):
                    p = some[p]
                    yield f"#\t{bundle_of(codes[p[:1]], bits)[0]}\t{lang}", pack(codes[p], counts[p].astype(np.min_scalar_type(counts[p].max())))
        yield from emitted(rows(), KEYED)
    return run


def tile_sums(parts: Iterator[tuple]) -> np.ndarray:
    total = np.zeros(TILE * TILE, np.int64)
    for *_, payload in parts:
        cell, counts = unpack(payload)
        total += np.bincount(cell, counts, TILE * TILE).astype(np.int64)  # counts of one block or group, exact as doubles
    return total


def group_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Dense tiles of a group of blocks, summed; the group's number leaves the key."""
    def rows() -> Iterator[tuple]:
        for key, parts in groups(batches):
            total = tile_sums(parts)
            cell = np.flatnonzero(total)
            yield key.split("\t", 1)[1], pack(cell.astype(np.uint16), total[cell])
    yield from emitted(rows(), KEYED)


def frequent_cells(least: int):
    """Tiles and bundles -> lang, left, right, a of the cells counted ``least`` times or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, parts in groups(batches):
            row, column, lang = key.split("\t", 2)
            if row != "#":
                total = tile_sums(parts)
                cell = np.flatnonzero(total >= least)
                left, right, a = int(row) * TILE + cell // TILE, int(column) * TILE + cell % TILE, total[cell]
            else:
                held, size = [], 0
                for *_, payload in parts:
                    held.append(unpack(payload))
                    size += len(held[-1][0])
                    if size > HELD + 2 * len(held[0][0]):
                        held = [summed(held)]
                        size = len(held[0][0])
                codes, a = summed(held)
                codes, a = codes[a >= least], a[a >= least]
                left, right = (codes >> U(32)).astype(np.int64), (codes & LOW).astype(np.int64)
            for at in range(0, len(a), 1 << 16):
                cut = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(a[cut]), pa.string()), pa.array(left[cut]), pa.array(right[cut]), pa.array(a[cut])],
                                                 names=["lang", "left", "right", "a"])
    return run


def summed(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Sorted coordinates and their sums."""
    codes, place = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
    total = np.zeros(len(codes), np.int64)
    np.add.at(total, place, np.concatenate([n.astype(np.int64) for _, n in held]))
    return [codes, total]


def ranked(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """``df``, written, with ``id``: its place, from 0, within its language by ``order``.

    Rows are range-partitioned and numbered inside their partitions; the rows
    of the partitions before (one number a partition) and of the languages before
    make up the rest.  No language is sorted by one task.
    """
    placed = written(df.repartitionByRange("lang", *order).sortWithinPartitions("lang", *order)
                     .withColumn("__m", F.monotonically_increasing_id()), f"{name}-placed")
    part = F.shiftright("__m", 33)
    sizes = placed.groupBy(part.alias("__p"), "lang").agg(F.count("*").alias("n"))
    runs = sizes.groupBy("__p").agg(F.sum("n").alias("n"))
    before = runs.select("__p", (F.sum("n").over(Window.orderBy("__p")) - F.col("n")).alias("__before"))
    at = F.col("__before") + F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))
    numbers = written(placed.join(before, part == F.col("__p")).withColumn("__at", at).drop("__m", "__p", "__before"), f"{name}-at")
    first = numbers.groupBy("lang").agg(F.min("__at").alias("__first"))
    out = written(numbers.join(first, "lang").withColumn("id", F.col("__at") - F.col("__first")).drop("__at", "__first"), name)
    discard(placed, numbers)
    return out


def packed_phrases(bits: int):
    """lang, left, right, id of phrases -> per bundle their cells and ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                left, right, ids = (batch.column(k).to_numpy() for k in (1, 2, 3))
                codes = left.astype(U) << U(32) | right.astype(U)
                names = batch.column(0).dictionary_encode()
                lang = names.indices.to_numpy().astype(np.int64)
                bundle = bundle_of(codes, bits)
                for p in split_by(lang << 40 | bundle):
                    yield f"{bundle[p[0]]}\t{names.dictionary[int(lang[p[0]])].as_py()}", pack(codes[p], ids[p])
        yield from emitted(rows(), KEYED)
    return run


def asking(words: int, bits: int, thin):
    """Blocks -> their distinct cells, those that pass the bitmap, per bundle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for block, lang, payload in rows_of(batches):
                codes = np.unique(cells(*unpack(payload), words)[1])
                codes = codes[in_bitmap(thin.value, mix(codes))]
                for p in split_by(bundle_of(codes, bits)):
                    yield f"{bundle_of(codes[p[:1]], bits)[0]}\t{lang}", block, pack(codes[p])
        yield from emitted(rows(), pa.schema([("key", pa.string()), ("block", pa.int64()), ("payload", pa.binary())]))
    return run


def open_phrases(parts: list) -> tuple[np.ndarray, np.ndarray]:
    codes, ids = (np.concatenate(x) for x in zip(*map(unpack, parts)))
    order = np.argsort(codes)
    return codes[order], ids[order]


def find(table: tuple[np.ndarray, np.ndarray], codes: np.ndarray) -> np.ndarray:
    """Ids of codes in a sorted table, -1 for those it lacks."""
    known, ids = table
    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    return np.where(known[at] == codes, ids[at], -1)


def ask_phrases(table: tuple, payload) -> bytes | None:
    codes, = unpack(payload)
    ids = find(table, codes)
    return pack(codes[ids >= 0], ids[ids >= 0]) if (ids >= 0).any() else None


def advanced(words: int):
    """Answers, then the block: the block with the ranks of its frequent phrases of ``words`` words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for block, members in groups(batches):
                answers = []
                for _, kind, lang, payload in members:
                    if not kind:
                        answers.append(payload)
                    elif answers:
                        ids, current = unpack(payload)
                        at, codes = cells(ids, current, words)
                        ranks = np.full(len(ids), -1, np.int64)
                        ranks[at] = find(open_phrases(answers), codes)
                        # a place matters if a frequent phrase begins there or reaches it
                        near = ranks >= 0
                        for k in range(1, words):
                            near[k:] |= ranks[:-k] >= 0
                        ids, ranks = unbroken(np.where(near, ids, -1), ranks)
                        yield block, lang, pack(narrow(ids), narrow(ranks))
        yield from emitted(rows(), CODED_SCHEMA)
    return run


def count_phrases(blocks: DataFrame, words: int, least: int, salts: int, bits: int) -> DataFrame:
    """``lang, left, right, a``: frequent phrases of ``words`` words as cells."""
    rows = written(blocks.mapInArrow(tiled(words, salts, bits), "key string, payload binary"), f"tiles{words}")
    sparse = F.col("key").startswith("#\t")
    dense = gathered(rows.filter(~sparse), group_tiles, "key string, payload binary")
    found = written(gathered(dense.unionByName(rows.filter(sparse)), frequent_cells(least), "lang string, left long, right long, a long"),
                    f"cells{words}")
    discard(rows)
    return found


def phrase_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
                  max_words: int = MAX_WORDS, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to ``max_words`` words found ``least`` times or more (``lang, phrase, words, f``), and words a language (``lang, n``).

    A-Z are lower-cased, texts are cut at ``.,;:!?`` and line breaks, and words are
    runs of anything but space and tab; a phrase does not cross a cut.  Null texts
    are empty, a null language is ``und``; rows are texts of their own.
    """
    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    blocks = written(source.mapInArrow(word_blocks, "block long, lang string, words array<string>, held array<long>, payload binary"), "word-blocks")
    words = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "held")).alias("place", "x")).select(
        "block", "lang", "place", F.col("x.words").alias("phrase"), F.col("x.held").alias("held"))
    totals = written(words.groupBy("lang").agg(F.sum("held").alias("n")), "word-totals")
    counts = words.groupBy("lang", "phrase").agg(F.sum("held").alias("f")).filter(F.col("f") >= least)
    vocabulary = ranked(counts, "vocabulary", F.desc("f"), F.col("phrase"))
    known = words.join(vocabulary, ["lang", "phrase"]).select(
        F.col("block").alias("key"), F.lit(0).alias("kind"), F.col("place").cast("long").alias("place"), F.col("id").alias("rank"),
        F.lit("").alias("lang"), F.lit(b"").alias("payload"))
    whole = blocks.select(F.col("block").alias("key"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("place"), F.lit(0).cast("long").alias("rank"),
                          "lang", "payload")
    coded = written(gathered(known.unionByName(whole), coded_blocks, CODED, "kind"), "coded1")
    n_blocks, n_words = coded.count(), totals.agg(F.sum("n")).first()[0] or 0
    discard(blocks)
    salts = max(1, round(n_blocks ** 0.5))
    bits = (max(1, n_words // BUNDLE) - 1).bit_length()

    phrases = vocabulary.select("lang", "phrase", F.lit(1).alias("words"), "f")
    level = vocabulary.select("lang", "phrase", "id")
    for m in range(2, max_words + 1):
        found = count_phrases(coded, m, least, salts, bits)
        here = ranked(found, f"phrases{m}", F.desc("a"), F.col("left"), F.col("right"))
        discard(found)
        left = level.select("lang", F.col("phrase").alias("head"), F.col("id").alias("left"))
        right = vocabulary.select("lang", F.col("phrase").alias("tail"), F.col("id").alias("right"))
        named = written(here.join(left, ["lang", "left"]).join(right, ["lang", "right"])
                        .select("lang", F.concat_ws(" ", "head", "tail").alias("phrase"), F.lit(m).alias("words"), F.col("a").alias("f"), "id"), f"named{m}")
        phrases = phrases.unionByName(named.drop("id"))
        level = named.select("lang", "phrase", "id")
        if m < max_words:
            table = here.select("lang", "left", "right", "id").mapInArrow(packed_phrases(bits), "key string, payload binary")
            thin = docs.sparkSession.sparkContext.broadcast(bitmap(here.mapInArrow(cell_hashes, "h long"), "h"))
            answers = answered(table, coded.mapInArrow(asking(m, bits, thin), "key string, block long, payload binary"), open_phrases, ask_phrases)
            both = (answers.select(F.col("block").alias("key"), F.lit(0).alias("kind"), F.lit("").alias("lang"), "payload")
                    .unionByName(coded.select(F.col("block").alias("key"), F.lit(1).alias("kind"), "lang", "payload")))
            further = written(gathered(both, advanced(m), CODED, "kind"), f"coded{m}")
            discard(coded)
            coded = further
    return phrases, totals


def cell_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("left", "right"))
        yield pa.RecordBatch.from_arrays([pa.array(mix(left.astype(U) << U(32) | right.astype(U)).view(np.int64))], names=["h"])


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_words: int = MAX_WORDS,
                 least: int = LEAST, swallow: int = SWALLOW, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of 2 to ``max_words`` words of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` is the phrase's frequency, at least ``least``.  Cut after its first k
    words, its parts have frequencies ``l`` and ``r``, and the cut's score is
    floor(10**6 * a * a / (l * r)); the cut with the lowest score counts, of equal ones
    that with the smallest k.  A phrase inside a longer one (of any rank)
    that is at least ``swallow`` percent as frequent is dropped.  Ranks follow score and
    ``a`` (both falling), then the phrase's bytes.  ``n`` counts the words of the language.
    See ``phrase_counts`` for nulls; repeated rows count as often as they come, other columns
    are ignored, empty tables and texts give no rows.
    """
    phrases, totals = phrase_counts(docs, lang_col, text_col, max_words, least)
    candidates = phrases.filter("words > 1")
    parts = F.split("phrase", " ", -1)
    cuts = (candidates.select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", F.concat_ws(" ", F.slice(parts, F.lit(1), F.col("k"))).alias("head"),
                    F.concat_ws(" ", F.slice(parts, F.col("k") + 1, F.col("words") - F.col("k"))).alias("tail")))
    of = lambda part, name: phrases.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
    best = (cuts.join(of("head", "l"), ["lang", "head"]).join(of("tail", "r"), ["lang", "tail"])
            .withColumn("score", F.expr(SCORE))
            .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    inner = (candidates.filter("words > 2").select("lang", "phrase", "words", "f", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("m"))
             .select("lang", "phrase", "f", "m", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1)).alias("i"))
             .select("lang", F.concat_ws(" ", F.slice(parts, F.col("i"), F.col("m"))).alias("phrase"), "f")
             .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = (best.join(inner, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (100 * F.col("longer") < swallow * F.col("a")))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
