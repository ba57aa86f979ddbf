"""Token counts: pieces are counted once per distinct pre-token and joined to frequencies.

Documents are cut into pre-tokens in blocks of bounded size. A block keeps the frequencies of
its documents over its own list of distinct pre-tokens. The lists of all blocks meet by hash
bucket, where every distinct pre-token is encoded once; the piece counts go back to the blocks
that hold it and are multiplied with the frequencies. Token ids are never kept.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, functions as F

from tallymill.session import written_table

#: Bytes of text in a block; one longer document is a block of its own.
BLOCK_BYTES = 24 << 20
#: Distinct pre-tokens that a bucket receives from all blocks, on average.
BUCKET_TOKENS = 250_000
#: Blocks whose equal pre-tokens meet.
TOGETHER = 4096

#: Characters on whose classes the pattern and the tokenizer are known to agree (tests compare all of them).
_AGREED = regex.compile("[^\0-\u036f]")

# Fixed value: the split pattern of byte-level pre-tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """The tokenizer, and a function from a text to its pre-tokens and special strings."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
    by_pattern = regex.compile(PATTERN).findall

    def words(text: str) -> list[str]:
        if _AGREED.search(text):
            return [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return by_pattern(text)

    def pieces(text: str) -> list[str]:
        if cut is None or not any(s in text for s in special):
            return words(text)
        parts = cut.split(text)
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else words(part))]

    return tokenizer, pieces


def _hashes(tokens: list[str]) -> np.ndarray:
    return np.fromiter((zlib.crc32(t.encode()) for t in tokens), np.int64, len(tokens))


def _packed(tokens: list[str]) -> bytes:
    lengths = np.fromiter(map(len, tokens), "<i4", len(tokens))
    return zstandard.compress(np.int32(len(tokens)).tobytes() + lengths.tobytes() + "".join(tokens).encode(), 3)


def _unpacked(data: bytes) -> list[str]:
    data = zstandard.decompress(data)
    n = int(np.frombuffer(data, "<i4", 1)[0])
    ends = np.cumsum(np.frombuffer(data, "<i4", n, 4)).tolist()
    text = data[4 + 4 * n :].decode()
    return [text[a:b] for a, b in zip([0, *ends], ends)]


class _Block:
    """Frequencies of some documents over a common list of pre-tokens."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.ids, self.sizes, self.lengths = [], [], []
        self.tokens, self.times = [], []
        self.bytes = 0

    def add(self, doc_id, text: str, pieces) -> None:
        place = self.place
        found = Counter(pieces(text))
        self.tokens.append(np.fromiter((place.setdefault(w, len(place)) for w in found), np.int32, len(found)))
        self.times.append(np.fromiter(found.values(), np.int32, len(found)))
        size = len(text.encode())
        self.ids.append(doc_id)
        self.sizes.append(size)
        self.lengths.append(len(found))
        self.bytes += size

    def batch(self, number: int, id_type: pa.DataType) -> pa.RecordBatch:
        """The block as a row. Tokens are in the order of their hash, so any buckets are runs of them."""
        tokens = list(self.place)
        order = np.argsort(_hashes(tokens), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        steps, times = [np.empty(0, np.int32)], [np.empty(0, np.int32)]
        for ids, count in zip(self.tokens, self.times):
            ids = rank[ids]
            by_id = np.argsort(ids)
            steps.append(np.diff(ids[by_id], prepend=np.int32(0)))
            times.append(count[by_id])
        counts = np.concatenate(steps + times).astype("<i4")
        return pa.record_batch(
            {
                "block": pa.array([number], pa.int64()),
                "ids": pa.array([self.ids], pa.list_(id_type)),
                "sizes": pa.array([self.sizes], pa.list_(pa.int64())),
                "lengths": pa.array([self.lengths], pa.list_(pa.int32())),
                "counts": pa.array([zstandard.compress(counts.view(np.uint8).reshape(-1, 4).T.tobytes(), 3)], pa.binary()),
                "n": pa.array([len(tokens)], pa.int32()),
                "tokens": pa.array([_packed([tokens[i] for i in order])], pa.binary()),
            }
        )


def _counts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Steps between the sorted tokens of each document, and the tokens' frequencies."""
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    both = np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel()
    return both[: len(both) // 2], both[len(both) // 2 :]


def token_counts(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", together: int = TOGETHER, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_bytes`` (UTF-8) and ``n_tokens``.

    The counts are those of the byte-level BPE tokenizer in ``tokenizer_path`` on the whole
    text, without added special tokens; special strings inside a text are one token each. A
    null text counts as empty (0, 0). Repeated rows are counted each, an empty table gives no
    rows, and other columns of ``docs`` are not looked at.

    A pre-token is encoded once for all blocks, or once for every ``together`` blocks where there are more: the
    lists of a bucket come from so many blocks at most, however frequent its pre-tokens are.
    """
    id_kind = docs.schema[id_column].dataType.simpleString()

    def cut(batches):
        from pyspark import TaskContext

        _, pieces = _tokenizer(tokenizer_path)
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(doc_id, text.as_py() or "", pieces)
                if block.bytes >= block_bytes:
                    yield block.batch(number, id_type)
                    number, block = number + 1, _Block()
        if block.ids:
            yield block.batch(number, id_type)

    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    shape = f"block long, ids array<{id_kind}>, sizes array<bigint>, lengths array<int>, counts binary, n int, tokens binary"
    blocks = written_table(chosen.mapInArrow(cut, shape), "token-blocks")
    total, number_of_blocks = blocks.agg(F.sum("n"), F.count("*")).first()
    parts = max(1, -(-number_of_blocks // together))
    buckets = max(1, -(-(total or 0) // (BUCKET_TOKENS * parts)))

    def send(batches):
        for batch in batches:
            for number, packed in zip(batch.column("block").to_pylist(), batch.column("tokens")):
                tokens = _unpacked(packed.as_py())
                bucket = _hashes(tokens) * buckets >> 32
                starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.empty(0, int)
                runs = [_packed(tokens[a:b]) for a, b in zip(starts, [*starts[1:], len(tokens)])]
                yield pa.record_batch({"bucket": bucket[starts], "block": np.full(len(starts), number), "tokens": pa.array(runs, pa.binary())})

    def encode(table: pa.Table) -> pa.Table:
        tokenizer, _ = _tokenizer(tokenizer_path)
        lists = [_unpacked(x.as_py()) for x in table["tokens"]]
        tokens = pa.array([t for part in lists for t in part], pa.string()).dictionary_encode()
        distinct = tokens.dictionary.to_pylist()
        pieces = np.zeros(len(distinct), np.int32)
        for at in range(0, len(distinct), 10_000):
            found = tokenizer.encode_batch_fast(distinct[at : at + 10_000], add_special_tokens=False)
            pieces[at : at + len(found)] = [len(x.ids) for x in found]
        counts = pa.array(pieces[tokens.indices.to_numpy()])
        offsets = np.r_[0, np.cumsum([len(part) for part in lists])].astype(np.int32)
        return pa.table({"bucket": table["bucket"], "block": table["block"], "pieces": pa.ListArray.from_arrays(offsets, counts)})

    def total_up(block: pa.Table, pieces: pa.Table) -> pa.Table:
        ids, sizes, lengths = (block[c].combine_chunks().flatten() for c in ("ids", "sizes", "lengths"))
        steps, times = _counts(block["counts"][0].as_py())
        of_token = pieces.sort_by("bucket")["pieces"].combine_chunks().flatten().to_numpy().astype(np.int64)
        documents = np.repeat(np.arange(len(lengths)), lengths.to_numpy())
        run = np.cumsum(steps.astype(np.int64))
        first = np.r_[0, np.cumsum(lengths.to_numpy().astype(np.int64))[:-1]]
        before = np.r_[0, run][first]
        sums = np.r_[0, np.cumsum(of_token[run - before[documents]] * times)]
        ends = np.cumsum(lengths.to_numpy().astype(np.int64))
        n_tokens = sums[ends] - sums[ends - lengths.to_numpy()]
        return pa.table({"id": ids, "n_bytes": sizes, "n_tokens": pa.array(n_tokens, pa.int64())})

    sent = blocks.select("block", "tokens").mapInArrow(send, "bucket long, block long, tokens binary")
    part = F.pmod(F.xxhash64("block"), F.lit(parts))
    pieces = sent.withColumn("part", part).groupBy("bucket", "part").applyInArrow(encode, "bucket long, block long, pieces array<int>")
    result = blocks.drop("tokens", "n").groupBy("block").cogroup(pieces.groupBy("block")).applyInArrow(total_up, f"id {id_kind}, n_bytes long, n_tokens long")
    return result.withColumnRenamed("id", id_column)
