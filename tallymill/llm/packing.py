"""Packing tokenised documents into sequences, online with a bounded number of open windows.

A task reads its documents in order and keeps a few open windows. A piece goes to the open
window that it fills best. When it fits none, it is cut to top up the fullest window, which is
emitted full, and the rest goes on. What the tasks have left open is merged afterwards.
"""

from __future__ import annotations

import re
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tallymill.session import written_table

#: Open windows per task, and tasks whose leftovers are merged together.
OPEN = 16
MERGED_TASKS = 64
#: Pieces and words whose ids a task holds, each of so many characters at most; some 70 MB each when full.
CACHED = 300_000
CACHED_LENGTH = 64
#: Bytes of text whose words are looked up at once; a longer text goes alone.
TOGETHER = 2 << 20

_PIECE = "id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


# The split pattern of the tokenizer for the printable characters of Latin-1 in lower case.
_LETTERS, _NUMBERS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
_PIECE_OF_WORD = f"('s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}]+)"
_LATIN = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA1, 0x100))]
_NOT_LATIN = "[^!-~¡-ÿ]"


class _Held(dict):
    """Ids, as little-endian 32-bit integers, of texts that ``encode`` has turned into ids; forgets all when full."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, text: str) -> bytes:
        found = self.encode(text)
        ids = struct.pack(f"<{len(found)}I", *found)
        if len(text) <= CACHED_LENGTH:
            if len(self) >= CACHED:
                self.clear()
            self[text] = ids
        return ids

    def all(self, texts: pa.Array) -> pa.Array:
        return pa.array(list(map(self.__getitem__, texts.to_numpy(zero_copy_only=False))), pa.large_binary())


def _joined(parts: pa.Array, ends: np.ndarray) -> pa.Array:
    """Binary values, those up to each of ``ends`` made one."""
    places = np.r_[0, np.cumsum(pc.binary_length(parts).to_numpy(zero_copy_only=False))]
    offsets = places[np.r_[0, ends]].astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), parts.buffers()[2]])


def _ends(lists: pa.Array) -> np.ndarray:
    return np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))


def _cut(words: pa.Array) -> pa.Array:
    """Pieces of words of Latin-1 characters."""
    return pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(words), _PIECE_OF_WORD, r"\1 "))


class _Words:
    """Ids of words, which are the parts of a text between ASCII white space.

    No id of the tokenizer spans white space, so the ids of a text are those of its words. Words
    of Latin-1 characters are put in lower case and cut into pieces by Arrow, and the tokenizer's
    model turns a piece into ids; all others, and those with a special string, go through the whole
    tokenizer. So does everything if the tokenizer cuts a sample of these characters otherwise.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = _Held(lambda word: self.tokenizer.encode(word, add_special_tokens=False).ids)
        assert self.words["a b"] == self.words["a"] + self.words["b"], "the tokenizer must drop white space"
        bytes_of = {ord(c): "".join(self._pieces(c.lower())) for c in _LATIN if not c.isascii()}
        tokenize = self.tokenizer.model.tokenize
        self.pieces = _Held(lambda piece: [t.id for t in tokenize(piece if piece.isascii() else piece.translate(bytes_of))])
        special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([_NOT_LATIN, *map(re.escape, special)])
        sample = [f"a{c}{c}'LL1{c}'" for c in _LATIN]
        cut = [[piece.translate(bytes_of) for piece in pieces if piece] for pieces in _cut(pa.array(sample)).to_pylist()]
        if cut != [self._pieces(word) for word in sample]:
            self.odd = ""

    def forget(self) -> None:
        """Frees the ids held: Spark keeps a Python worker for later stages, with all its memory."""
        self.words.clear()
        self.pieces.clear()
        pa.default_memory_pool().release_unused()

    def _pieces(self, word: str) -> list[str]:
        normalizer, cutter = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        word = normalizer.normalize_str(word) if normalizer else word
        return [piece for piece, _ in cutter.pre_tokenize_str(word)] if cutter else [word]

    def ids(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words, as little-endian 32-bit integers."""
        odd = pc.match_substring_regex(words, self.odd)
        cut = _cut(words.filter(pc.invert(odd)))
        pieces = cut.flatten().dictionary_encode()
        plain = _joined(self.pieces.all(pieces.dictionary).take(pieces.indices), _ends(cut))
        both = pa.concat_arrays([plain, self.words.all(words.filter(odd))])
        odd = odd.to_numpy(zero_copy_only=False)
        return both.take(pa.array(np.where(odd, len(plain) + np.cumsum(odd) - 1, np.cumsum(~odd) - 1)))


@lru_cache(maxsize=2)
def _words(path: str) -> _Words:
    return _Words(path)


def token_ids(texts: pa.Array, path: str, end_id: int):
    """Ids of each text (null: empty), then ``end_id``, as little-endian 32-bit integers.

    The distinct words of ``TOGETHER`` bytes of text are looked up once; Arrow puts their ids in the order of the words.
    """
    end = struct.pack("<I", end_id)
    sums = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(sums, TOGETHER + (sums[at - 1] if at else 0), "right")))
        split = pc.ascii_split_whitespace(pc.fill_null(texts[at:upto].cast(pa.large_string()), ""))
        words = split.flatten().dictionary_encode()
        ids = _joined(_words(path).ids(words.dictionary).take(words.indices), _ends(split))
        yield from (text.as_py() + end for text in ids)
        at = upto


class Packer:
    """Bounded-space best fit. ``take`` returns the windows that it filled; ``rest`` those left open.

    A window is a list of pieces (document, start, ids); documents are opaque.
    """

    def __init__(self, length: int, open_windows: int = OPEN):
        self.length, self.most = length, open_windows
        self.windows: list[list] = []
        self.free: list[int] = []

    def _put(self, at: int, piece) -> list:
        self.windows[at].append(piece)
        self.free[at] -= len(piece[2]) // 4
        if self.free[at]:
            return []
        self.free.pop(at)
        return [self.windows.pop(at)]

    def take(self, document, start: int, ids: bytes) -> list:
        full = []
        while len(ids) // 4 >= self.length:
            full.append([(document, start, ids[: 4 * self.length])])
            start, ids = start + self.length, ids[4 * self.length :]
        while ids:
            n = len(ids) // 4
            fitting = [(room, i) for i, room in enumerate(self.free) if room >= n]
            if fitting:
                return full + self._put(min(fitting)[1], (document, start, ids))
            if len(self.windows) < self.most:
                self.windows.append([(document, start, ids)])
                self.free.append(self.length - n)
                return full
            room, at = min((room, i) for i, room in enumerate(self.free))
            full += self._put(at, (document, start, ids[: 4 * room]))
            start, ids = start + room, ids[4 * room :]
        return full

    def rest(self) -> list:
        return self.windows


def _powers(n: int) -> list[int]:
    return [1 << b for b in reversed(range(n.bit_length())) if n >> b & 1]


def _last(windows: list, length: int) -> list:
    """Open windows as sequences without padding: filled up from one another, the last cut at powers of two."""
    packer = Packer(length, 1)
    done = [w for window in windows for piece in window for w in packer.take(*piece)]
    pieces = [piece for window in packer.rest() for piece in window]
    for size in _powers(sum(len(p[2]) // 4 for p in pieces)):
        part = Packer(size, 1)
        while pieces:
            document, start, ids = pieces.pop(0)
            room = part.free[0] if part.free else size
            filled = part.take(document, start, ids[: 4 * room])
            if len(ids) // 4 > room:
                pieces.insert(0, (document, start + room, ids[4 * room :]))
            if filled:
                done += filled
                break
    return done


def _rows(windows, first: int, kind: pa.DataType, keep_ids: bool, leftover: bool = False) -> pa.RecordBatch:
    rows = [(n + first, o, p) for n, window in enumerate(windows) for p, o in zip(window, np.cumsum([0, *(len(p[2]) // 4 for p in window)]))]
    return pa.record_batch(
        {
            "id": pa.array([p[0][0] for _, _, p in rows], kind),
            "start": pa.array([p[1] for _, _, p in rows], pa.int64()),
            "length": pa.array([len(p[2]) // 4 for _, _, p in rows], pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(p[2]) for _, _, p in rows], pa.int64()),
            "doc_tokens": pa.array([p[0][1] for _, _, p in rows], pa.int64()),
            "sequence_id": pa.array([n for n, _, _ in rows], pa.int64()),
            "offset": pa.array([None if leftover else int(o) for _, o, _ in rows], pa.int64()),
            "ids": pa.array([p[2] if keep_ids else None for _, _, p in rows], pa.binary()),
        }
    )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    length: int = 2048,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """One row per piece of a document: where it starts in the document's ids and where it lies.

    Every id of every row of ``docs`` (a null or empty text has ``end_id`` alone) lies in one
    piece; the pieces of a ``sequence_id`` fill it from offset 0 without a gap. Sequences hold
    ``length`` ids, or a power of two less than that, so none needs padding. ``keep_ids`` adds
    the ids of a piece (little-endian 32-bit); without it ``ids`` is null. Long documents are
    cut, repeated rows are packed each, an empty table gives no rows, and other columns of
    ``docs`` are not looked at. ``length`` must be a power of two.

    Memory per task is the open windows; leftovers of ``MERGED_TASKS`` tasks meet in one group
    of at most that many times ``OPEN`` windows.
    """
    id_kind = docs.schema[id_column].dataType.simpleString()

    def cut(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        packer, number = Packer(length), task << 32
        for batch in batches:
            kind, full = batch.schema.field(0).type, []
            for doc_id, ids in zip(batch.column(0).to_pylist(), token_ids(batch.column(1), tokenizer_path, end_id)):
                full += packer.take((doc_id, len(ids) // 4), 0, ids)
                if len(full) >= 256:
                    yield _rows(full, number, kind, keep_ids)
                    number, full = number + len(full), []
            yield _rows(full, number, kind, keep_ids)
            number += len(full)
        _words(tokenizer_path).forget()
        if packer.rest():
            yield _rows(packer.rest(), number, kind, True, leftover=True)

    def merge(table: pa.Table) -> pa.Table:
        kind, table = table.schema.field("id").type, table.sort_by([(c, "ascending") for c in ("sequence_id", "start", "ids_crc32")])
        rows = zip(*(table[c].to_pylist() for c in ("id", "doc_tokens", "start", "ids")))
        windows = _last([[((i, n), start, ids)] for i, n, start, ids in rows], length)
        first = (1 << 62) + (table["merged"][0].as_py() << 32)
        return pa.Table.from_batches([_rows(windows, first, kind, keep_ids)])

    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    shape = _PIECE.format(kind=id_kind)
    pieces = written_table(chosen.mapInArrow(cut, shape), "pieces")
    left = pieces.where("offset is null").withColumn("merged", F.shiftright(F.shiftright("sequence_id", 32), MERGED_TASKS.bit_length() - 1))
    merged = left.groupBy("merged").applyInArrow(merge, shape)
    return pieces.where("offset is not null").unionByName(merged).withColumnRenamed("id", id_column)
