"""Removing every byte that a long string covers which also starts elsewhere in the corpus.

Each string of ``LENGTH`` bytes has an anchor: the place of the smallest hash of its runs of
``GRAM`` bytes. Equal strings have equal anchors at equal places, so only strings with the same
anchor hash need to meet. The strings of an anchor lie in one segment of the text. Equal
segments are counted by 128-bit digests of their bytes. Different segments of an anchor hash meet in blocks of bounded
size, where a Burrows-Wheeler transform tells which of their strings repeat.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallymill.llm.bwt import repeated_starts
from tallymill.session import written_table

LENGTH = 400
GRAM = 32
#: Bytes of text searched for anchors at once, and bytes of segments in a block.
CHUNK = 1 << 20
BLOCK = 1 << 20
#: Segments of an anchor hash that meet in one block; more are cut finer, FINE strings to a part.
HOT = 1024
FINE = 16

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_PLACE = 28  # bits of a place in a chunk, below the leading bits of a hash


class _Anchors:
    """Anchors of texts; holds the powers that the rolling hash needs."""

    def __init__(self):
        n = CHUNK + LENGTH
        base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
        self.power = np.cumprod(np.full(n, base))
        self.inverse = np.cumprod(np.full(n, inverse))
        self.values = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)

    def _chunk(self, data: np.ndarray):
        n = len(data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * self.power[:n], out=sums[1:])
        grams = (sums[GRAM:] - sums[:-GRAM]) * self.inverse[: n - GRAM + 1]
        grams ^= grams >> np.uint64(31)
        grams *= np.uint64(0xBF58476D1CE4E5B9)
        grams ^= grams >> np.uint64(29)
        wide = LENGTH - GRAM + 1
        low = np.uint64((1 << _PLACE) - 1)
        m = len(grams)
        keys = np.full(-(-m // wide) * wide, _MASK, np.uint64)
        keys[:m] = (grams & ~low) | np.arange(m, dtype=np.uint64)
        rows = keys.reshape(-1, wide)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = m - wide + 1
        anchor = (np.minimum(behind[:windows], ahead[wide - 1 : wide - 1 + windows]) & low).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        return first, np.diff(first, append=windows), anchor[first], grams[anchor[first]].view(np.int64)

    def of(self, data: bytes):
        """(start, number of strings, anchor place, anchor hash) of each segment."""
        view, found = np.frombuffer(data, np.uint8), []
        for at in range(0, len(data) - LENGTH + 1, CHUNK):
            first, n, place, h = self._chunk(view[at : at + CHUNK + LENGTH - 1])
            found.append((first + at, n, place + at, h))
        return [np.concatenate(x) for x in zip(*found)] if found else [np.empty(0, np.int64)] * 4


_held: list[_Anchors] = []


def _anchors() -> _Anchors:
    if not _held:
        _held.append(_Anchors())
    return _held[0]


def _digest(data) -> int:
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little", signed=True)


def _segments(batches):
    """(id, t, at, n, h, seg) of every segment of every text."""
    for batch in batches:
        index, parts, segs = [], [], []
        for row, text in enumerate(batch.column("data")):
            data = text.as_buffer()
            if data is None or data.size < LENGTH:
                continue
            view = memoryview(data)
            at, n, _, h = _anchors().of(view)
            index.append(np.full(len(at), row))
            parts.append((at, n, h))
            segs += [blake2b(view[a : a + k + LENGTH - 1], digest_size=16).digest() for a, k in zip(at.tolist(), n.tolist())]
        if parts:
            rows = pa.array(np.concatenate(index))
            at, n, h = (np.concatenate(x) for x in zip(*parts))
            columns = {c: batch.column(c).take(rows) for c in ("id", "t")}
            yield pa.record_batch(columns | {"at": at, "n": n.astype(np.int32), "h": h, "seg": pa.array(segs, pa.binary())})


def _bytes_of(batches):
    """(key, h, seg, from, data) of the wanted segments, those of hot anchors in finer parts.

    A part takes the strings whose distance from the anchor falls in the same ``FINE`` values;
    its key is a hash of the bytes that all of them hold.
    """
    for batch in batches:
        out = {c: [] for c in ("key", "h", "seg", "from", "data")}

        def put(*row):
            for column, value in zip(out.values(), row):
                column.append(value)

        for text, wanted in zip(batch.column("data"), batch.column("wanted").to_pylist()):
            view = memoryview(text.as_buffer())
            for w in wanted:
                at, n, h, seg = w["at"], w["n"], w["h"], w["seg"]
                if not w["hot"]:
                    put(h, h, seg, 0, bytes(view[at : at + n + LENGTH - 1]))
                    continue
                place = at + int(_anchors().of(view[at : at + n + LENGTH - 1])[2][0])
                start = at
                while start < at + n:
                    part = (place - start) // FINE
                    last = min(at + n - 1, place - part * FINE)
                    core = view[place - part * FINE : place - part * FINE - FINE + 1 + LENGTH]
                    put(_digest(b"%d,%d," % (h, part) + bytes(core)), h, seg, start - at, bytes(view[start : last + LENGTH]))
                    start = last + 1
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary())
        yield pa.record_batch({c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds)})


def _block(rows: dict) -> pa.RecordBatch:
    """(h, seg, at, n): runs of repeated strings in the segments of one block."""
    h, seg, at, n = [], [], [], []
    texts = list(rows.values())
    for (row_h, row_seg, begin), starts in zip(rows, repeated_starts(texts, LENGTH) if texts else []):
        if len(starts):
            first = np.flatnonzero(np.r_[True, np.diff(starts) > 1])
            for a, k in zip(starts[first].tolist(), np.diff(first, append=len(starts)).tolist()):
                h.append(row_h)
                seg.append(row_seg)
                at.append(begin + a)
                n.append(k)
    kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32())
    return pa.record_batch({c: pa.array(v, k) for c, v, k in zip(("h", "seg", "at", "n"), (h, seg, at, n), kinds)})


def _blocks(batches):
    """Packs the segments, sorted by key, into blocks that hold whole keys, and searches these."""
    block, size, key, group = {}, 0, None, {}
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("key", "h", "seg", "from", "data"))
        for row_key, h, seg, begin, data in zip(*columns):
            if row_key != key:
                if len(group) > 1:
                    block |= group
                    size += sum(map(len, group.values()))
                if size >= BLOCK:
                    yield _block(block)
                    block, size = {}, 0
                key, group = row_key, {}
            group[h, seg, begin] = data
    if len(group) > 1:
        block |= group
    if block:
        yield _block(block)


def _strings(batches):
    """(w, v, h, seg, at): 128-bit hash of every string of a part."""
    for batch in batches:
        rows = []
        for h, seg, begin, data in zip(*(batch.column(c).to_pylist() for c in ("h", "seg", "from", "data"))):
            for k in range(len(data) - LENGTH + 1):
                d = blake2b(data[k : k + LENGTH], digest_size=16).digest()
                rows.append((int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True), h, seg, begin + k))
        w, v, h, seg, at = zip(*rows) if rows else [()] * 5
        yield pa.record_batch({"w": pa.array(w, pa.int64()), "v": pa.array(v, pa.int64()), "h": pa.array(h, pa.int64()), "seg": pa.array(seg, pa.binary()), "at": pa.array(at, pa.int32())})


def repeated_runs(rows: DataFrame, hot: int = HOT) -> DataFrame:
    """(id, t, at, n): runs of strings that also start elsewhere, of ``rows`` (id, t, data).

    (id, t) names a row; rows with the same name have the same data.
    """
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(_segments, f"id {kind}, t long, at long, n int, h long, seg binary")
    segments = written_table(found, "segments")
    # Equal segments are one row before anchors are joined, so a hot anchor brings its different segments only.
    distinct = segments.groupBy("h", "seg").agg(F.count("*").alias("c"), F.min(F.struct("id", "t", "at", "n")).alias("first"))
    distinct = written_table(distinct, "distinct-segments")
    equal = distinct.where("c > 1").select("h", "seg", F.lit(0).alias("from"), F.col("first.n").alias("k"))
    several = distinct.groupBy("h").agg(F.count("*").alias("d")).where("d > 1")
    mixed = distinct.join(several, "h").select("first.*", "h", "seg", (F.col("d") > hot).alias("hot"))
    wanted = mixed.groupBy("id", "t").agg(F.collect_list(F.struct("at", "n", "h", "seg", "hot")).alias("wanted"))
    named = F.expr("r.id <=> w.id and r.t = w.t")
    texts = rows.alias("r").join(wanted.alias("w"), named).select("data", "wanted")
    parts = texts.mapInArrow(_bytes_of, "key long, h long, seg binary, `from` int, data binary")
    parts = written_table(parts, "segment-bytes")
    sizes = parts.groupBy("key").agg(F.count("*").alias("parts")).where(F.col("parts") > hot)
    sizes = written_table(sizes.select("key"), "hot-keys")
    together = parts.join(sizes, "key", "left_anti").repartition("key").sortWithinPartitions("key")
    repeated = together.mapInArrow(_blocks, "h long, seg binary, at int, n int").select("h", "seg", F.col("at").alias("from"), F.col("n").alias("k"))
    strings = parts.join(sizes, "key", "left_semi").mapInArrow(_strings, "w long, v long, h long, seg binary, at int")
    again = strings.groupBy("w", "v").agg(F.count_distinct("h", "seg").alias("c")).where("c > 1").select("w", "v")
    single = strings.join(again, ["w", "v"]).select("h", "seg", F.col("at").alias("from"), F.lit(1).alias("k"))
    runs = equal.unionByName(repeated).unionByName(single)
    return segments.join(runs, ["h", "seg"]).select("id", "t", (F.col("at") + F.col("from")).alias("at"), F.col("k").alias("n"))


def covered(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal spans (begin, end) of bytes that the strings of the runs (at, n) cover."""
    spans: list[tuple[int, int]] = []
    for at, n in sorted(runs):
        end = at + n - 1 + LENGTH
        if spans and at <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((at, end))
    return spans


def _cut(data: pa.Array, runs: pa.Array) -> pa.Array:
    kept, spans = [], []
    for text, found in zip(data, runs.to_pylist()):
        text, cut = text.as_py(), covered([(r["at"], r["n"]) for r in found or ()])
        ends = [0, *(end for _, end in cut)]
        begins = [*(begin for begin, _ in cut), len(text)]
        kept.append(b"".join(text[a:b] for a, b in zip(ends, begins)) if cut else text)
        spans.append([{"begin": a, "end": b} for a, b in cut])
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    return pa.StructArray.from_arrays([pa.array(kept, pa.binary()), pa.array(spans, kind)], ["kept", "spans"])


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_bytes``, the ``spans`` removed and the bytes ``kept``.

    A byte goes if a string of ``LENGTH`` bytes covers it that also starts anywhere else, in the
    same text or another, judged on the input. A null text counts as empty; shorter texts have
    nothing to remove. Repeated rows are copies of each other and go if long enough. Cuts may
    split characters, so what is kept is bytes. An empty table gives no rows; other columns of
    ``docs`` are not looked at.

    Work per task is bounded: texts are searched in chunks; a block holds at most ``BLOCK`` bytes
    and one key more, a key at most ``hot`` segments. An anchor with more segments is cut into
    parts by the bytes around it, and parts that are still that many are counted string by string.
    """
    data = F.coalesce(F.col(text_column).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(id_column).alias("id"), data.alias("data"))
    rows = rows.select("id", F.xxhash64("data").alias("t"), "data")
    runs = repeated_runs(rows, hot).groupBy("id", "t").agg(F.collect_set(F.struct("at", "n")).alias("runs"))
    both = rows.alias("r").join(runs.alias("s"), F.expr("r.id <=> s.id and r.t = s.t"), "left")
    cutter = F.arrow_udf(_cut, "kept binary, spans array<struct<begin: bigint, end: bigint>>")
    cut = both.select("r.id", "data", cutter("data", "runs").alias("cut"))
    return cut.select(F.col("id").alias(id_column), F.octet_length("data").cast("long").alias("n_bytes"), "cut.spans", "cut.kept")
