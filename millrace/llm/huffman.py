"""Token files: ids in canonical, length-limited Huffman code.

A folder holds three Parquet tables:

* ``codebook``: ``id, bits``. Codes are canonical: sorted by length and id, each
  is the one before plus one, so lengths are all that is stored.
* ``blocks``: whole documents in ascending id, in blocks of about ``BLOCK_TOKENS``
  tokens. A block is decoded on its own: ``payload`` is its bit stream,
  ``checkpoints`` the bit offset of every ``LANE``-th token.
* ``parts``: tokens of each writing task, in order.

Counts are global: every id of every document is counted before the first is coded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_columns, stored, texts_of
from .tokenizing import encoder

MAX_BITS = 16
BLOCK_TOKENS = 1 << 20
LANE = 256


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (0: never occurs), by package-merge."""
    lengths = np.zeros(len(counts), np.uint8)
    there = np.flatnonzero(counts)
    if len(there) < 2:
        lengths[there] = 1
        return lengths
    if len(there) > 1 << limit:
        raise ValueError(f"{len(there)} ids need more than {limit} bits")
    order = there[np.argsort(counts[there], kind="stable")]
    coins = counts[order].astype(np.int64)
    levels, merged = [], coins
    for _ in range(limit):
        sources = np.concatenate([coins, merged]) if levels else coins
        is_coin = np.arange(len(sources)) < len(coins)
        by_weight = np.argsort(sources, kind="stable")
        levels.append(is_coin[by_weight])
        sources = sources[by_weight]
        merged = sources[: len(sources) // 2 * 2].reshape(-1, 2).sum(1)
    take = 2 * len(coins) - 2
    for level in reversed(levels):
        n = int(level[:take].sum())
        lengths[order[:n]] += 1
        take = 2 * (take - n)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    codes = np.zeros(len(lengths), np.uint32)
    code = last = 0
    for symbol in np.lexsort((np.arange(len(lengths)), lengths)):
        if bits := int(lengths[symbol]):
            code <<= bits - last
            codes[symbol], last = code, bits
            code += 1
    return codes


def pack_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit stream, first bit highest, and the bit offset of every ``LANE``-th id."""
    if not len(ids):
        return b"", np.zeros(0, np.int64)
    bits = lengths[ids].astype(np.int64)
    ends = np.cumsum(bits)
    starts = ends - bits
    word = starts >> 5
    shifted = codes[ids].astype(np.uint64) << (64 - bits - (starts & 31)).astype(np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    out = np.zeros(int(ends[-1] + 31 >> 5) + 2, np.uint64)
    at = word[first]
    out[at] += np.add.reduceat(shifted >> np.uint64(32), first)
    out[at + 1] += np.add.reduceat(shifted & np.uint64(0xFFFFFFFF), first)
    return out.astype(">u4").tobytes()[: int(ends[-1] + 7 >> 3)], starts[::LANE]


class Decoder:
    """Tables of 2**MAX_BITS entries: the next bits give the id and the length of its code."""

    def __init__(self, lengths: np.ndarray):
        self.ids = np.zeros(1 << MAX_BITS, np.uint32)
        self.bits = np.ones(1 << MAX_BITS, np.int64)
        codes = canonical_codes(lengths)
        for symbol in np.flatnonzero(lengths):
            rest = MAX_BITS - int(lengths[symbol])
            at = int(codes[symbol]) << rest
            self.ids[at : at + (1 << rest)] = symbol
            self.bits[at : at + (1 << rest)] = lengths[symbol]

    def unpack(self, payload: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """All lanes of a block side by side, a token of each at a time."""
        stream = np.frombuffer(payload + bytes(4 + MAX_BITS * LANE // 8), np.uint8).astype(np.uint32)
        window = (stream[:-2] << 16) | (stream[1:-1] << 8) | stream[2:]
        position = np.array(checkpoints, np.int64)
        out = np.empty((LANE, len(position)), np.uint32)
        for step in range(LANE):
            # The last lane may be short: what it decodes past its end is cut off.
            np.minimum(position, len(payload) * 8 + MAX_BITS * (LANE - 1), out=position)
            code = (window[position >> 3] >> (8 - (position & 7)).astype(np.uint32)) & 0xFFFF
            out[step] = self.ids[code]
            position += self.bits[code]
        return out.T.reshape(-1)[:n]


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Tokenizes all texts and writes them to ``folder`` in ascending id.

    A null or empty text is the end id alone. Null ids come first; rows of
    the same id lie side by side, in the order of their ids' checksums. An empty
    table gives an empty folder of tables. Only the two named columns are read.
    """
    spark = docs.sparkSession
    end = np.array([end_id], "<u2").tobytes()

    def tokenize(batches: Iterator[dict]) -> Iterator[dict]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            yield {"doc_id": batch["doc_id"], "ids": [encode(t) + end for t in batch["text"]]}

    tokens = stored(map_columns(texts_of(docs, id_col, text_col), tokenize, "doc_id long, ids binary"), "ids")

    def count(batches: Iterator[dict]) -> Iterator[dict]:
        counts = np.zeros(1 << 16, np.int64)
        for batch in batches:
            counts += np.bincount(np.frombuffer(b"".join(batch["ids"]), "<u2"), minlength=1 << 16)
        there = np.flatnonzero(counts)
        yield {"id": there, "n": counts[there]}

    counted = map_columns(tokens.select("ids"), count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(1 << 16, np.int64)
    for row in counted.collect():  # at most one row for each id of the vocabulary
        counts[row["id"]] = row["n"]
    lengths = code_lengths(counts)
    book = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(book, "id int, bits int").coalesce(1).write.parquet(f"{folder}/codebook")
    shared = spark.sparkContext.broadcast((canonical_codes(lengths), lengths))

    def encode_blocks(batches: Iterator[dict]) -> Iterator[dict]:
        codes, bits = shared.value
        part, block, first = TaskContext.get().partitionId(), 0, 0
        ids: list[bytes] = []
        doc_ids: list[int] = []
        size = 0

        def flush() -> dict:
            nonlocal block, first, ids, doc_ids, size
            payload, checkpoints = pack_bits(np.frombuffer(b"".join(ids), "<u2"), codes, bits)
            out = {"part": [part], "block": [block], "first": [first], "n_tokens": [size], "doc_ids": [doc_ids]}
            out |= {"lengths": [[len(i) // 2 for i in ids]], "checkpoints": [checkpoints], "payload": [payload]}
            block, first, ids, doc_ids, size = block + 1, first + size, [], [], 0
            return out

        for batch in batches:
            for doc_id, own in zip(batch["doc_id"], batch["ids"]):
                ids.append(own)
                doc_ids.append(doc_id)
                size += len(own) // 2
                if size >= BLOCK_TOKENS:
                    yield flush()
        if ids:
            yield flush()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "tie"]
    ordered = tokens.withColumn("tie", F.crc32("ids")).repartitionByRange(n, *order).sortWithinPartitions(*order)
    kind = (
        "part int, block int, first long, n_tokens long, doc_ids array<long>, lengths array<int>, "
        "checkpoints array<long>, payload binary"
    )
    blocks = map_columns(ordered.select("doc_id", "ids"), encode_blocks, kind)
    blocks.write.option("compression", "none").parquet(f"{folder}/blocks")
    written = spark.read.parquet(f"{folder}/blocks")
    sums = written.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each writing task
    sums.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(f"{folder}/parts")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document: ids as little-endian unsigned 32-bit numbers."""
    book = spark.read.parquet(f"{folder}/codebook").collect()  # at most one row for each id of the vocabulary
    lengths = np.zeros(1 << 16, np.uint8)
    for row in book:
        lengths[row["id"]] = row["bits"]
    shared = spark.sparkContext.broadcast(lengths)
    parts = spark.read.parquet(f"{folder}/parts").select("part", "start")
    blocks = spark.read.parquet(f"{folder}/blocks").join(parts, "part")
    blocks = blocks.withColumn("first", F.col("first") + F.col("start")).drop("part", "block", "start")

    def decode(batches: Iterator[dict]) -> Iterator[dict]:
        decoder = Decoder(shared.value)
        for batch in batches:
            for first, n, doc_ids, sizes, checkpoints, payload in zip(
                *(batch[c] for c in ("first", "n_tokens", "doc_ids", "lengths", "checkpoints", "payload"))
            ):
                data = decoder.unpack(payload, checkpoints, n).astype("<u4").tobytes()
                ends = np.cumsum(sizes)
                starts = ends - sizes
                yield {
                    "doc_id": doc_ids, "start": starts + first, "n_tokens": sizes,
                    "ids": [data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())],
                }

    return map_columns(blocks, decode, "doc_id long, start long, n_tokens long, ids binary")
