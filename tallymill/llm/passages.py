"""Removing every word that a window of words covers which also starts elsewhere in the corpus.

Recompression (``recompression.py``) gives each window an anchor: a high symbol inside it, the
same one at the same place for equal windows. Windows that follow each other with one anchor, and
hold the same words around it, their core, form a part. Windows can only be equal in parts with
equal cores. Spark rounds then look for names that the corpus holds twice: first those of parts, which
settles all windows of the long repeats, then those of single windows, for cores whose parts differ.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tallymill.llm.recompression import Spans, anchors, mixed
from tallymill.llm.tables import bucketed_table
from tallymill.session import written_table

WINDOW = 35
ROUNDS = 3
#: Windows with an anchor fall into classes of this many distances from its place.
CLASS = 18
#: Bytes of text in a block, whose equal names are sent once, and bytes parsed at once.
BLOCK = 4 << 20
CHUNK = 1 << 20
_ROW = 36  # bits of a word's place in its text, below the text's number in the block
_LONG = pa.int64()
_LONGS = pa.list_(_LONG)


def _block_rows(most: int):
    """(block, row, id, n_words, data) of every text."""

    def run(batches):
        block, row, size = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            blocks, rows, n_words = [], [], []
            for text in batch.column("data"):
                data = text.as_py()
                blocks.append(block)
                rows.append(row)
                n_words.append(len(data.split()))
                row, size = row + 1, size + len(data)
                if size >= most:
                    block, row, size = block + 1, 0, 0
            arrays = [pa.array(blocks, _LONG), pa.array(rows, _LONG), batch.column("id"), pa.array(n_words, _LONG), batch.column("data")]
            yield pa.RecordBatch.from_arrays(arrays, ["block", "row", "id", "n_words", "data"])

    return run


def _pieces(table: pa.Table, window: int, most: int):
    """(bytes, offset) per text or piece of a long one, its words joined by single blanks; the offset names its first word in the block.

    A piece ends ``window - 1`` words after the start of the next one, so each window lies in one piece.
    """
    for row, n_words, text in zip(table["row"].to_pylist(), table["n_words"].to_pylist(), table["data"]):
        if n_words < window:
            continue
        data = b" ".join(text.as_py().split())
        if len(data) <= most:
            yield data, row << _ROW
            continue
        starts = np.append(0, np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1)
        first = 0
        while first + window <= n_words:
            after = max(first + 1, int(np.searchsorted(starts, starts[first] + most)))
            last = min(after + window - 1, n_words)
            yield data[starts[first] : starts[last] - 1 if last < n_words else None], (row << _ROW) + first
            first = after


def _names(data: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128-bit names of spans of bytes, as rows of two numbers."""
    found = b"".join(blake2b(data[a:b], digest_size=16).digest() for a, b in zip(begin.tolist(), end.tolist()))
    return np.frombuffer(found, "<i8").reshape(-1, 2)


def _parts(table: pa.Table, window: int, most: int):
    """The parts of a block's texts, chunk by chunk: (bytes, word bounds, first words, windows, offsets, cores, names).

    Places are counted in the chunk; an offset leads from there to the block. Cores are hashes.
    """

    def parse(pieces):
        data = b" \n ".join(p for p, _ in pieces)
        view = np.frombuffer(data, np.uint8)
        spans = Spans(view)
        bounds = np.concatenate([[0], np.flatnonzero(view == 32) + 1, [len(data) + 1]])
        bars = view[bounds[:-1]] == 10
        begins = np.append(0, np.flatnonzero(bars) + 1)
        sizes = np.append(begins[1:] - 1, len(bars)) - begins - window + 1
        first = np.repeat(begins - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        offsets = np.repeat(np.array([o for _, o in pieces]) - begins, sizes)
        name, place = anchors(spans(bounds[:-1], bounds[1:] - 1), bars, first, window, ROUNDS)
        kind = (place - first) // CLASS
        new = np.ones(len(first), bool)
        new[1:] = (place[1:] != place[:-1]) | (name[1:] != name[:-1]) | (kind[1:] != kind[:-1]) | (first[1:] != first[:-1] + 1)
        heads = np.flatnonzero(new)
        n = np.diff(heads, append=len(first))
        first, place, kind = first[heads], place[heads], kind[heads]
        low, high = place - CLASS * kind, place - np.minimum(CLASS * kind + CLASS - 1, window - 1) + window
        cores = mixed(spans(bounds[low], bounds[high] - 1), 50) + kind.astype(np.uint64)
        names = _names(data, bounds[first], bounds[first + n - 1 + window] - 1)
        return data, bounds, first, n, offsets[heads], cores.view(np.int64), names

    held, size = [], 0
    for piece in _pieces(table, window, most):
        held.append(piece)
        size += len(piece[0])
        if size >= most:
            yield parse(held)
            held, size = [], 0
    if held:
        yield parse(held)


def _first_names(window: int, most: int):
    """Names of a block's parts, each once: (key, a, b, block, many, common).

    The key is the core's hash, so that parts with equal cores meet. A core that several parts
    of this block share already is known to be common: it sends one row without a name for other blocks,
    and its parts have keys of their own, so that no key has more than a few rows a block.
    """

    def run(table: pa.Table) -> pa.Table:
        found = [(cores, names) for *_, cores, names in _parts(table, window, most)]
        core = np.concatenate([c for c, _ in found] or [np.empty(0, np.int64)])
        a, b = np.concatenate([x for _, x in found] or [np.empty((0, 2), np.int64)]).T
        order = np.lexsort((b, a, core))
        core, a, b = core[order], a[order], b[order]
        part, head = np.ones(len(core), bool), np.ones(len(core), bool)
        head[1:] = core[1:] != core[:-1]
        part[1:] = head[1:] | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        heads = np.flatnonzero(part)
        many = np.diff(heads, append=len(core)) > 1
        core, a, b, head = core[heads], a[heads], b[heads], head[heads]
        firsts = np.flatnonzero(head)
        several = np.diff(firsts, append=len(core)) > 1
        common = np.repeat(several, np.diff(firsts, append=len(core)))
        shared = core[firsts[several]]
        rest = np.arange(len(core) + len(shared)) < len(core)
        names = {
            "key": pa.array(np.append(np.where(common, core ^ a, core), shared)),
            "a": pa.array(np.append(a, shared), mask=~rest),
            "b": pa.array(np.append(b, shared), mask=~rest),
            "block": pa.repeat(table["block"][0], len(rest)),
            "many": pa.array(np.append(many, np.zeros(len(shared), bool))),
            "common": pa.array(np.append(common, np.ones(len(shared), bool))),
        }
        return pa.table(names)

    return run


def _second_names(window: int, most: int):
    """(block, ats, ns, a, b) from a block and what was found of its parts.

    Settled parts are one row without a name, with all their first windows and numbers of windows. Each
    window whose core has different parts is a row with its name and all its places in the block.
    """

    def run(key, table: pa.Table, found: pa.Table) -> pa.Table:
        told, other, settled, differ = (found[c].to_numpy() for c in ("a", "b", "settled", "differ"))
        order = np.lexsort((other, told))
        told, other, settled, differ = told[order], other[order], settled[order], differ[order]
        ats, ns, places, names = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty((0, 2), np.int64)]
        for data, bounds, first, n, offset, _, name in _parts(table, window, most) if len(told) else ():
            at = np.minimum(np.searchsorted(told, name[:, 0]), len(told) - 1)
            for step in range(int(np.unique(told, return_counts=True)[1].max())):  # of names with equal first halves
                there = np.minimum(at + step, len(told) - 1)
                known = (told[there] == name[:, 0]) & (other[there] == name[:, 1])
                whole = known & settled[there]
                ats.append((first + offset)[whole])
                ns.append(n[whole])
                single = known & differ[there]
                k = n[single]
                windows = np.repeat(first[single] - np.cumsum(k) + k, k) + np.arange(k.sum())
                places.append(windows + np.repeat(offset[single], k))
                names.append(_names(data, bounds[windows], bounds[windows + window] - 1))
        ats, ns, places = np.concatenate(ats), np.concatenate(ns), np.concatenate(places)
        a, b = np.concatenate(names).T
        order = np.lexsort((places, b, a))
        places, a, b = places[order], a[order], b[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        heads = np.flatnonzero(new)
        one = int(len(ats) > 0)
        columns = {
            "block": pa.repeat(key[0], len(heads) + one),
            "ats": pa.ListArray.from_arrays(np.concatenate([[0] * one, heads + len(ats), [len(ats) + len(a)]]).astype(np.int32), np.append(ats, places)),
            "ns": pa.array([ns] * one + [None] * len(heads), _LONGS),
            "a": pa.array(np.append([0] * one, a[heads]).astype(np.int64), mask=np.arange(len(heads) + one) < one),
            "b": pa.array(np.append([0] * one, b[heads]).astype(np.int64), mask=np.arange(len(heads) + one) < one),
        }
        return pa.table(columns)

    return run


def _cut(window: int):
    """(id, n_words, n_removed, kept, text) of a block's texts, given the windows that repeat (ats, ns)."""

    def run(key, table: pa.Table, found: pa.Table) -> pa.Table:
        ats = found["ats"].combine_chunks()
        at = np.asarray(ats.flatten(), np.int64)
        n = np.ones(len(at), np.int64)
        several = np.asarray(found["ns"].is_valid(), bool)
        counts = np.asarray(ats.value_lengths(), np.int64)
        n[np.repeat(several, counts)] = np.asarray(found["ns"].combine_chunks().flatten(), np.int64)
        order = np.argsort(at, kind="stable")
        at, end = at[order], (at + n - 1 + window)[order]
        text = at >> _ROW
        cuts = np.searchsorted(text, np.arange(int(text[-1]) + 2)) if len(at) else np.zeros(1, int)
        removed, kept, texts = [], [], []
        for row, original in zip(table["row"].to_pylist(), table["data"]):
            lo, hi = (int(cuts[row]), int(cuts[row + 1])) if row + 1 < len(cuts) else (0, 0)
            original = original.as_py()
            data = b" ".join(original.split())
            if lo == hi:
                removed.append(0)
                kept.append(data)
                texts.append(original)
                continue
            bounds = np.concatenate([[0], np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1, [len(data) + 1]])
            base = row << _ROW
            begins, ends = at[lo:hi] - base, np.maximum.accumulate(end[lo:hi] - base)
            new = np.append(True, begins[1:] > ends[:-1])
            begins, ends = begins[new], ends[np.append(new[1:], True)]
            removed.append(int((ends - begins).sum()))
            stays = zip(np.append(0, ends), np.append(begins, len(bounds) - 1))
            kept.append(b" ".join(data[bounds[a] : bounds[b] - 1] for a, b in stays if a < b))
            texts.append(kept[-1])
        arrays = [table["id"], table["n_words"], pa.array(removed, _LONG), pa.array(kept, pa.binary()), pa.array(texts, pa.binary())]
        return pa.table(arrays, ["id", "n_words", "n_removed", "kept", "text"])

    return run


def remove_passages(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, block: int = BLOCK, chunk: int = CHUNK
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words``, ``n_removed``, the words ``kept``, joined by blanks, and ``text``.

    ``text`` is the text as it was where no word goes, and ``kept`` elsewhere; both are UTF-8 bytes.

    Words are runs of other characters than ASCII white space. A word goes if a window of ``window``
    words covers it whose words also start anywhere else, in the same text or another, judged on the
    input. A null text has no words; a text with fewer words than a window loses none. Repeated rows
    are copies of each other, whatever their ids, and ids may be null. An empty table gives no
    rows; other columns of ``docs`` are not looked at.

    A text is read once, into blocks that stay where they are: only names move, each at most once a
    block, so that no passage, however frequent, gives a task more than a few rows a block. Names of
    parts and windows are 128-bit digests of their words.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    data = F.coalesce(F.col(text_column).cast("binary"), F.lit(b"")).alias("data")
    rows = docs.select(F.col(id_column).alias("id"), data)
    blocks = rows.mapInArrow(_block_rows(block), f"block long, row long, id {kind}, n_words long, data binary")
    blocks = bucketed_table(blocks, "block", "passage_blocks")

    names = blocks.groupBy("block").applyInArrow(_first_names(window, chunk), "key long, a long, b long, block long, many boolean, common boolean")
    core, part = Window.partitionBy("key"), Window.partitionBy("key", "a", "b")
    again = (F.count("*").over(part) > 1) | F.col("many")
    differ = F.max("common").over(core) | (F.min("a").over(core) < F.max("a").over(core))
    found = names.withColumns({"settled": again, "differ": differ}).where("a is not null and (settled or differ)")
    found = found.select("block", "a", "b", "settled", "differ")
    second = blocks.groupBy("block").cogroup(found.groupBy("block"))
    second = second.applyInArrow(_second_names(window, chunk), "block long, ats array<long>, ns array<long>, a long, b long")
    second = written_table(second, "passage-windows")

    places = F.sum(F.size("ats")).over(Window.partitionBy("a", "b"))
    single = second.where("a is not null").withColumn("places", places).where("places > 1").select("block", "ats", "ns")
    runs = second.where("a is null").select("block", "ats", "ns").unionByName(single)
    cut = blocks.groupBy("block").cogroup(runs.groupBy("block"))
    cut = cut.applyInArrow(_cut(window), f"id {kind}, n_words long, n_removed long, kept binary, text binary")
    return cut.withColumnRenamed("id", id_column)
