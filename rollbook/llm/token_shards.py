"""Training-order materialisation: sequences of token ids in fixed-stride binary shards, in the order of a keyed permutation.

Documents follow one another in the order of the scan, each closed by an end id, and are cut into sequences of ``length`` ids; the last is
padded. A Feistel network over the next power of four, walked along its cycle until it falls under the number of sequences, gives every
sequence its global slot: a bijection that needs no sort, no shuffle buffer and no table. Range partitions of shards then put the pieces together
and write shard ``k`` with slots ``k * per_shard`` and on: byte ``(slot - first) * stride`` of its file is where a sequence starts, so reading is
sequential and can resume at any slot.

The scan is read twice (sizes of its partitions, then pieces), so it must be a plan that gives the same partitions again, such as a file
scan (ids of a tokenizer are stored first); each partition's size is checked the second time. Pieces are compressed before they are shuffled. A shard is written under a name of its attempt and then renamed: a lost executor's shard is
written again, with the same bytes.

Cases: null or empty ids give a sequence of the end id alone; null document ids do not matter, as ids are not read; repeated rows are
repeated; a very long document spans sequences; an empty table gives no shards; only the ids column is read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import ensure_checkpoint_dir
from .common import mix64, small_batches

ROUNDS = 6
#: Ids of a sequence, sequences of a shard, bytes of an id.
LENGTH, PER_SHARD, WIDTH = 2048, 4096, 1
#: Byte-level ids: the bytes of UTF-8 text, in which these two never occur.
END, PAD = 255, 254
CODEC = "zstd"
#: Of zstd, for stored ids and for pieces.
LEVEL, PIECE_LEVEL = 6, 3


def closing_ids(vocabulary: int) -> tuple[int, int, int]:
    """Width, end and pad for the ids 0 to ``vocabulary`` - 1: end and pad are the next two ids, a width of 2 or 4 bytes holds all of them."""
    if vocabulary + 2 > 2**32:
        raise ValueError("ids wider than 4 bytes")
    return (2 if vocabulary + 2 <= 2**16 else 4), vocabulary, vocabulary + 1


def packed(encoded: DataFrame, width: int, ids: str = "ids") -> DataFrame:
    """``ids``: the integer arrays of the column as binary, ``width`` bytes an id (little-endian); null stays null."""
    kind = np.dtype(f"<u{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(0)
            values = x.values.to_numpy(zero_copy_only=False)
            if len(values) and not 0 <= values.min() <= values.max() < 256**width:
                raise ValueError(f"ids do not fit {width} bytes")
            values, at = values.astype(kind), x.offsets.to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array([values[s:e].tobytes() if there else None for s, e, there in zip(at[:-1], at[1:], x.is_valid().to_pylist(), strict=True)], pa.binary())], ["ids"])

    return encoded.select(F.col(ids).cast("array<bigint>").alias("ids")).mapInArrow(run, "ids binary")


def _rounds(x: np.ndarray, half: int, keys: np.ndarray) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for k in keys:
        left, right = right, left ^ (mix64(right + k) & mask)
    return (left << np.uint64(half)) | right


def _keys(key: int) -> np.ndarray:
    return mix64(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(key % 2**64))


def permute(x: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """The slot of each of the numbers 0 to n - 1 (or, inverted, the number in each slot)."""
    half = max(1, -(-max(1, (n - 1).bit_length()) // 2))
    keys = _keys(key)
    swap = lambda v: (v >> np.uint64(half)) | ((v & np.uint64((1 << half) - 1)) << np.uint64(half))
    step = (lambda v: swap(_rounds(swap(v), half, keys[::-1]))) if inverse else (lambda v: _rounds(v, half, keys))
    out = step(np.asarray(x, dtype=np.uint64))
    while len(over := np.flatnonzero(out >= n)):
        out[over] = step(out[over])
    return out.astype(np.int64)


def _filesystem(uri: str):
    import pyarrow.fs as fs
    return fs.FileSystem.from_uri("file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def write_shards(docs: DataFrame, ids: Column, folder: str, key: int = 0, length: int = LENGTH, per_shard: int = PER_SHARD, width: int = WIDTH, end: int = END, pad: int = PAD) -> tuple[DataFrame, int]:
    """Write the shards; gives the manifest ``shard, path, first_slot, sequences, sha256`` and the number of sequences.

    ``ids``: the ids of a document as binary, ``width`` bytes each (little-endian)."""
    small_batches(docs)
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(ids, F.lit(b"")).alias("ids"))
    sizes = {r["p"]: r["n"] for r in rows.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.length("ids") + width).alias("n")).collect()}  # a row for each partition
    first, at = {}, 0
    for p in sorted(sizes):
        first[p], at = at, at + sizes[p]
    total, stride = -(-at // (length * width)), length * width
    closing, padding = int(end).to_bytes(width, "little"), int(pad).to_bytes(width, "little")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, place, codec = None, 0, pa.Codec(CODEC, compression_level=PIECE_LEVEL)
        for b in batches:
            if not len(b):
                continue
            here = b.column("p")[0].as_py()
            place = place or first[here]
            data = closing.join([x.as_py() for x in b.column("ids")]) + closing
            stop = place + len(data)
            number = np.arange(place // stride, -(-stop // stride))
            lo, hi = np.maximum(number * stride, place), np.minimum((number + 1) * stride, stop)
            slot = permute(number, total, key)
            yield pa.RecordBatch.from_arrays([pa.array(slot // per_shard), pa.array(slot), pa.array(lo - number * stride), pa.array(hi - lo),
                                              pa.array([codec.compress(data[s:e], asbytes=True) for s, e in zip((lo - place).tolist(), (hi - place).tolist(), strict=True)], pa.binary())], ["shard", "slot", "at", "size", "data"])
            place = stop
        if here is not None and place != first[here] + sizes[here]:
            raise RuntimeError("the scan did not give the same partitions twice")

    cut = rows.select(F.spark_partition_id().alias("p"), "ids").mapInArrow(pieces, "shard long, slot long, at long, size long, data binary")
    shards = -(-total // per_shard)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        now, buffer = None, None

        def close():
            path, attempt = f"{root}/shard-{now:08d}.bin", f"{root}/_writing-{uuid.uuid4().hex}"
            with fs.open_output_stream(attempt) as f:
                f.write(bytes(buffer))
            fs.move(attempt, path)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([f"{folder}/shard-{now:08d}.bin"]), pa.array([now * per_shard], pa.int64()), pa.array([len(buffer) // stride], pa.int64()),
                                               pa.array([hashlib.sha256(buffer).hexdigest()])], ["shard", "path", "first_slot", "sequences", "sha256"])

        for b in batches:
            for shard, slot, at_, size, data in zip(*[b.column(c).to_pylist() for c in ("shard", "slot", "at", "size", "data")], strict=True):
                if shard != now:
                    if now is not None:
                        yield close()
                    now = shard
                    buffer = bytearray(padding * (min(per_shard, total - shard * per_shard) * length))
                place = (slot - shard * per_shard) * stride + at_
                buffer[place: place + size] = pa.decompress(data, size, CODEC, asbytes=True)
        if now is not None:
            yield close()

    fs, root = _filesystem(folder)
    fs.create_dir(root, recursive=True)
    dealt = cut.repartitionByRange(max(1, min(shards, 10_000)), "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(write, "shard long, path string, first_slot long, sequences long, sha256 string"), total


def read_shards(spark: SparkSession, paths: list[str] | str, length: int = LENGTH, per_shard: int = PER_SHARD, width: int = WIDTH, from_slot: int = 0) -> DataFrame:
    """``slot, ids``: the sequences of the shards from ``from_slot`` on."""
    stride = length * width

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, content in zip(b.column("shard").to_pylist(), b.column("content"), strict=True):
                content = content.as_py()
                skip = max(0, from_slot - shard * per_shard)
                n = len(content) // stride
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(skip, n) + shard * per_shard), pa.array([content[i * stride: (i + 1) * stride] for i in range(skip, n)], pa.binary())], ["slot", "ids"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.bin").load(paths)
    shard = F.regexp_extract("path", r"shard-(\d+)\.bin$", 1).cast("long")
    return files.select(shard.alias("shard"), "content").filter(F.col("shard") >= from_slot // per_shard).mapInArrow(cut, "slot long, ids binary")


def new_folder(spark: SparkSession) -> str:
    """A new folder for shards in the shared folder of the session."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/shards-{uuid.uuid4().hex}"


def describe(sequences: DataFrame, total: int, key: int, width: int = WIDTH, end: int = END, pad: int = PAD) -> DataFrame:
    """``slot, sequence, n_ids, n_ends, ids_sha256`` of sequences read from shards: the number that the slot stands for, its ids without padding, how many documents end in it."""
    kind = np.dtype(f"<u{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slot = b.column("slot").to_numpy()
            ids = [np.frombuffer(x.as_py(), dtype=kind) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([b.column("slot"), pa.array(permute(slot, total, key, inverse=True)), pa.array([int((x != pad).sum()) for x in ids], pa.int64()),
                                              pa.array([int((x == end).sum()) for x in ids], pa.int64()), pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids])],
                                             ["slot", "sequence", "n_ids", "n_ends", "ids_sha256"])

    return sequences.mapInArrow(run, "slot long, sequence long, n_ids long, n_ends long, ids_sha256 string")
