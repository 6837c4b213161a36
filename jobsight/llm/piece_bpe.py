"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is prefixed with one space, its spaces become the vocabulary's space
symbol, and it is cut in front of every run of spaces: no piece of a merge-type
vocabulary continues over a word's end (checked when the model is loaded), so
the segments merge independently.  In each segment an agenda, ordered by score
and then from the left, holds the adjacent symbol pairs that form a piece; the
best pair merges and its new neighbours enter, until the agenda is empty.
Symbols outside the vocabulary become byte pieces.

Segments of one length are merged together: the agenda is a matrix with one row for
each segment and one column for each pair, and every step merges the best pair of every row.

Segments repeat, so each worker keeps a bounded memo of them.  Every segment that
the agenda encodes is compared with the sentencepiece library in its Arrow
batch; a difference raises.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
SEGMENT = re.compile(f"{SPACE}([^{SPACE}]+|{SPACE}*[^{SPACE}]*)")
#: Segments of a memo's younger half (about 100 MB); when it is full it becomes the older half.
MEMO_SEGMENTS = 300_000
#: Longer segments are encoded each time.
MEMO_CHARS = 64
#: Up to this length segments are merged together, beyond it one by one with a heap.
FLAT_CHARS = 48
#: Cells of an agenda matrix, at most (or one row).
AGENDA_CELLS = 1 << 20
#: Rank of a pair that forms no piece.
NONE = np.int32((1 << 31) - 1)


class MergeCodec:
    """Encoder and decoder over a sentencepiece model file of the BPE type."""

    def __init__(self, model_file: str, check: bool = True):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        sp = self.library
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        self.texts: list[bytes] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.texts.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.texts.append(b"")
            else:
                self.scores[piece], self.ids[piece] = sp.get_score(i), i
                self.texts.append(piece.replace(SPACE, " ").encode())
                if re.search(f"[^{SPACE}]{SPACE}", piece):
                    raise ValueError(f"piece {piece!r} goes on over a word's end")
        if len(self.bytes) != 256:
            raise ValueError("the vocabulary has no byte pieces")
        self.check = check
        self.lead = len(sp.encode("a"))
        # tuples of numbers and strings: the garbage collector leaves them alone
        self.memo = Memo()
        self.decimals = [str(i) for i in range(sp.get_piece_size())]
        self._pairs()

    def _pairs(self) -> None:
        """The pairs of symbols that form a piece, with the piece and the rank of its score (equal scores share one).

        Symbols are the pieces, the characters in them and ASCII, numbered from 1; 0 is any other character.
        """
        names = list(self.scores)
        number = {n: i for i, n in enumerate(dict.fromkeys([*names, *sorted(set("".join(names))), *map(chr, range(128))]), 1)}
        rank = {score: i for i, score in enumerate(sorted(set(self.scores.values()), reverse=True))}
        self.base = len(number) + 1
        found = [(number[n[:k]] * self.base + number[n[k:]], rank[self.scores[n]], number[n])
                 for n in names for k in range(1, len(n)) if n[:k] in number and n[k:] in number]
        self._table(found)
        self.id_of_symbol = np.array([-1] + [self.ids.get(n, self.bytes[ord(n)] if n.isascii() and len(n) == 1 else -1) for n in number], np.int64)
        self.symbol_of_char = np.zeros(0x110000, np.int32)
        for n, i in number.items():
            if len(n) == 1:
                self.symbol_of_char[ord(n)] = i

    def _table(self, found: list[tuple[int, int, int]]) -> None:
        """An open-addressed table of pairs, at most a quarter full; a pair lies within ``reach`` places of its own."""
        bits = max(4, (4 * len(found)).bit_length())
        self.shift = np.uint64(64 - bits)
        keys = np.array([k for k, _, _ in found], np.int64)
        home = self._home(keys).tolist()
        self.reach, places, taken = 1, [], set()
        for at in home:
            step = 0
            while at + step in taken:
                step += 1
            taken.add(at + step)
            places.append(at + step)
            self.reach = max(self.reach, step + 1)
        size = (1 << bits) + self.reach + 1
        self.pair_keys = np.full(size, -1, np.int64)
        self.pair_ranks = np.full(size, NONE, np.int32)
        self.pair_symbols = np.zeros(size, np.int64)
        self.pair_keys[places] = keys
        self.pair_ranks[places] = [r for _, r, _ in found]
        self.pair_symbols[places] = [n for _, _, n in found]

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of pairs in the table; of a pair it lacks, an empty place."""
        key = left * self.base + right
        at = self._home(key.ravel()).reshape(key.shape)
        have = self.pair_keys[at]
        open_ = np.flatnonzero((have != key) & (have >= 0))
        if len(open_):
            flat_at, flat_key = at.ravel(), key.ravel()
            for _ in range(self.reach):
                flat_at[open_] += 1
                have = self.pair_keys[flat_at[open_]]
                open_ = open_[(have != flat_key[open_]) & (have >= 0)]
                if not len(open_):
                    break
            flat_at[open_] = len(self.pair_keys) - 1  # beyond all places, and empty
            at = flat_at.reshape(key.shape)
        return at

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.pair_ranks[self.find_pairs(left, right)]

    def merge_many(self, segments: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of many segments, those of one length together."""
        found: dict[str, tuple[int, ...]] = {}
        by_length: dict[int, list[str]] = {}
        for s in segments:
            by_length.setdefault(len(s), []).append(s)
        for n in [n for n in by_length if not 0 < n <= FLAT_CHARS]:
            found.update((s, self.merge(SPACE + s)) for s in by_length.pop(n))
        for n, names in by_length.items():
            step = max(1, AGENDA_CELLS // (n + 1))
            for at in range(0, len(names), step):
                self._merge_rows(names[at:at + step], n, found)
        return found

    def _merge_rows(self, names: list[str], n: int, found: dict[str, tuple[int, ...]]) -> None:
        chars = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n)
        symbols = np.empty((len(names), n + 1), np.int64)
        symbols[:, 0] = self.symbol_of_char[ord(SPACE)]
        symbols[:, 1:] = self.symbol_of_char[chars]
        agenda = self.ranks(symbols[:, :-1], symbols[:, 1:])
        rows = np.arange(len(names))
        while len(rows):
            at = agenda.argmin(axis=1) if agenda.shape[1] else np.zeros(len(rows), np.int64)
            best = agenda[np.arange(len(rows)), at] if agenda.shape[1] else np.full(len(rows), NONE)
            done = best == NONE
            if done.any():
                for r, ids in zip(rows[done].tolist(), self.id_of_symbol[symbols[done]].tolist()):
                    found[names[r]] = tuple(ids) if -1 not in ids else self.merge(SPACE + names[r])  # a character without a piece becomes bytes
                rows, at, symbols, agenda = (x[~done] for x in (rows, at, symbols, agenda))
                if not len(rows):
                    break
            here, width = np.arange(len(rows)), symbols.shape[1]
            columns = np.arange(width - 1)
            merged = self.pair_symbols[self.find_pairs(symbols[here, at], symbols[here, at + 1])]
            symbols = np.take_along_axis(symbols, columns + (columns > at[:, None]), axis=1)
            symbols[here, at] = merged
            columns = columns[:-1]
            agenda = np.take_along_axis(agenda, columns + (columns >= at[:, None]), axis=1)
            k = np.flatnonzero(at > 0)
            agenda[k, at[k] - 1] = self.ranks(symbols[k, at[k] - 1], symbols[k, at[k]])
            k = np.flatnonzero(at < width - 2)
            agenda[k, at[k]] = self.ranks(symbols[k, at[k]], symbols[k, at[k] + 1])

    def merge(self, segment: str) -> tuple[int, ...]:
        """Ids of one segment by a heap: the best score first, of equals the leftmost."""
        symbols = self.merge_heap(segment)
        ids = self.ids
        found: list[int] = []
        for s in symbols:
            i = ids.get(s)
            if i is not None:
                found.append(i)
            else:
                found.extend(self.bytes[b] for b in s.encode())
        return tuple(found)

    def merge_heap(self, segment: str) -> list[str]:
        """The agenda as a heap; entries whose symbols have merged meanwhile are skipped."""
        symbols: list[str | None] = list(segment)
        size, scores = len(symbols), self.scores
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        agenda: list[tuple[float, int, int, str]] = []

        def propose(left: int, right: int) -> None:
            if left >= 0 and right < size:
                piece = symbols[left] + symbols[right]
                if piece in scores:
                    heapq.heappush(agenda, (-scores[piece], left, right, piece))

        for i in range(size - 1):
            propose(i, i + 1)
        while agenda:
            _, left, right, piece = heapq.heappop(agenda)
            if symbols[left] is None or symbols[right] is None or after[left] != right \
                    or symbols[left] + symbols[right] != piece:
                continue  # one of the two has merged meanwhile
            symbols[left], symbols[right] = piece, None
            after[left] = after[right]
            if after[left] < size:
                before[after[left]] = left
            propose(before[left], left)
            propose(left, after[left])
        return [s for s in symbols if s is not None]

    def learn(self, segments: set[str]) -> dict[str, tuple[tuple[int, ...], str]]:
        """Ids, and ids as comma-joined decimals, of segments (named without their first space symbol).

        All are compared with the library's ids in one call.
        """
        names = list(segments)
        merged = self.merge_many(names)
        decimal = self.decimals.__getitem__
        found = {s: (i, ",".join(map(decimal, i))) for s, i in merged.items()}
        if self.check:
            # a word stands in front, since the library adds a space before a text but not before none
            plain = self.library.encode([f"a {s.replace(SPACE, ' ')}" for s in names])
            for s, other in zip(names, plain):
                if merged[s] != tuple(other[self.lead:]):
                    raise ValueError(f"the library encodes {s[:80]!r} differently")
        self.memo.remember(found)
        return found

    def segments(self, texts: list[str | None]) -> Iterator[list[tuple[tuple[int, ...], str]]]:
        """The segments of each text, as ids and as decimals; none for null and empty texts."""
        cut = [split(t) if t else [] for t in texts]
        got = [list(map(self.memo.young.get, words)) for words in cut]
        rest = self.memo.known({s for words, have in zip(cut, got) if None in have for s, v in zip(words, have) if v is None})
        new = {s for s, v in rest.items() if v is None}
        if new:
            rest.update(self.learn(new))
        for words, have in zip(cut, got):
            yield [v or rest[s] for s, v in zip(words, have)] if None in have else have

    def encode(self, text: str) -> list[int]:
        return flat(next(self.segments([text])))

    def decode(self, ids: list[int]) -> str:
        """Pieces joined, the space symbol as a space, without the first space."""
        raw = b"".join(map(self.texts.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode(errors="replace")


class Memo:
    """A bounded memo in two halves: what is asked for again moves from the older to the younger one."""

    def __init__(self):
        self.young: dict = {}
        self.old: dict = {}

    def known(self, names: set[str]) -> dict:
        """What is known of the names, else None."""
        out = {n: self.young.get(n) for n in names}
        again = {n: self.old[n] for n, v in out.items() if v is None and n in self.old}
        self.remember(again)
        out.update(again)
        return out

    def remember(self, found: dict) -> None:
        short = {n: v for n, v in found.items() if len(n) <= MEMO_CHARS}
        if len(self.young) + len(short) > MEMO_SEGMENTS:
            self.young, self.old = {}, self.young
        if len(short) <= MEMO_SEGMENTS:
            self.young.update(short)


def flat(found: list[tuple[tuple[int, ...], str]]) -> list[int]:
    return list(chain.from_iterable(map(itemgetter(0), found)))


def split(text: str) -> list[str]:
    """The segments of a text, each without its first space symbol."""
    if SPACE in text or "  " in text or text[0] == " " or text[-1] == " ":
        return SEGMENT.findall(SPACE + text.replace(" ", SPACE))
    return text.split(" ")


_codecs: dict[tuple[str, bool], MergeCodec] = {}


def codec_of(model_file: str, check: bool = True) -> MergeCodec:
    """One codec per worker process, so that its memo outlives a task."""
    if (model_file, check) not in _codecs:
        _codecs[model_file, check] = MergeCodec(model_file, check)
    return _codecs[model_file, check]


def encoder(model_file: str, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model_file, check)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [flat(found) for found in codec.segments(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])
    return run


def encode_documents(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
                     check: bool = True) -> DataFrame:
    """``id, ids`` (array of int) for every row; null and empty texts have no ids.

    Null ids, repeated rows and other columns are of no concern: rows are
    independent, and only the two named columns are read.  ``model_file`` must
    be readable on every executor.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(encoder(model_file, check), f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, model_file: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """``id, text`` for rows of ids; null ids give the empty text."""
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model_file)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [codec.decode(x or []) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, text string")


def encode_digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row.

    The ids are the agenda's; the decoded text is the library's ``decode(ids)``.
    One pass per document, so that the ids of a long text never leave its task.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model_file)
        gc.disable()  # no cycles arise here, and the memos would be searched for some again and again
        try:
            yield from digests(codec, batches)
        finally:
            gc.enable()

    def digests(codec: MergeCodec, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = hashlib.sha256
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = list(codec.segments(part.column(1).to_pylist()))
                ids = list(map(flat, found))
                n_tokens = list(map(len, ids))
                of_ids = [sha(",".join([s for _, s in x]).encode()).hexdigest() for x in found]
                of_text = [sha(codec.library.decode(x).encode()).hexdigest() for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_tokens, pa.int64()), pa.array(of_ids, pa.string()),
                     pa.array(of_text, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
