"""Token files: one wavelet matrix per shard, written and read back through Spark.

A shard file holds a run of whole documents in id order.  Its tokens, mapped to
the shard's own alphabet, are stored as bit planes from the highest bit down,
each stably partitioned by the bits above; ranks per 512 bits make access,
counting and occurrence lookup possible on the file as it is.

Layout, little-endian: magic ``WMX1``, u32 tokens n, documents d, symbols s;
u32[s] alphabet, u64[d + 1] document starts; then per plane u32 zeros,
u32[blocks + 1] ranks, u8[ceil(n / 8)] bits.  The whole is zstd-compressed by the
Parquet container, whose rows are the shard files: any store Spark writes to
can hold them.

Cases: a null or empty text is a document of the end id only; equal ids keep
text order and each copy has its own place; an empty table gives no files and
an empty result; a document of any length is kept in one shard; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsfold.llm.frames import shared_folder
from opsfold.llm.hashing import slices
from opsfold.llm.tokens import default_tokenizer, encoder

MAGIC = b"WMX1"
END_ID = 2
SHARD_TOKENS = 1 << 20
BLOCK = 512
MAX_BROADCAST_FILES = 500_000


def build_shard(docs: list[bytes]) -> bytes:
    """The file of a run of documents, each given as its ids' 32-bit bytes."""
    ids = np.frombuffer(b"".join(docs), dtype="<u4")
    starts = np.zeros(len(docs) + 1, dtype="<u8")
    np.cumsum([len(d) // 4 for d in docs], out=starts[1:])
    seen = np.zeros(int(ids.max()) + 1 if len(ids) else 1, dtype=bool)
    seen[ids] = True
    alphabet = np.flatnonzero(seen).astype("<u4")
    code = np.zeros(len(seen), dtype=np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
    code[alphabet] = np.arange(len(alphabet))
    values = code[ids]
    out = [struct.pack("<4sIII", MAGIC, len(ids), len(docs), len(alphabet)),
           alphabet.tobytes(), starts.tobytes()]
    for shift in reversed(range(_planes(len(alphabet)))):
        bits = (values & code.dtype.type(1 << shift)).astype(bool)
        packed = np.packbits(bits, bitorder="little")
        ones = np.bitwise_count(np.pad(packed, (0, -len(packed) % (BLOCK // 8))))
        ranks = np.zeros(len(ones) * 8 // BLOCK + 1, dtype="<u4")
        np.cumsum(ones.reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint32), out=ranks[1:])
        zeros = np.compress(~bits, values)
        out += [struct.pack("<I", len(zeros)), ranks.tobytes(), packed.tobytes()]
        values = np.concatenate([zeros, np.compress(bits, values)])
    return b"".join(out)


def _planes(symbols: int) -> int:
    return max(1, (symbols - 1).bit_length())


class WaveletShard:
    """Read access to one shard file."""

    def __init__(self, data: bytes):
        magic, self.n, self.n_docs, symbols = struct.unpack_from("<4sIII", data)
        if magic != MAGIC:
            raise ValueError("no token shard")
        at = 16
        self.alphabet = np.frombuffer(data, "<u4", symbols, at)
        at += 4 * symbols
        self.starts = np.frombuffer(data, "<u8", self.n_docs + 1, at).astype(np.int64)
        at += 8 * (self.n_docs + 1)
        size = -(-self.n // 8)
        blocks = -(-size // (BLOCK // 8))
        self.planes = []
        for _ in range(_planes(symbols)):
            (zeros,) = struct.unpack_from("<I", data, at)
            ranks = np.frombuffer(data, "<u4", blocks + 1, at + 4)
            bits = np.frombuffer(data, np.uint8, size, at + 8 + 4 * blocks)
            self.planes.append((zeros, ranks, bits))
            at += 8 + 4 * blocks + size

    def _bit(self, plane: int, i: int) -> int:
        return int(self.planes[plane][2][i >> 3]) >> (i & 7) & 1

    def _ones(self, plane: int, i: int) -> int:
        """Ones among the first ``i`` bits."""
        _, ranks, bits = self.planes[plane]
        block = i // BLOCK
        a, b = block * (BLOCK // 8), i >> 3
        count = int(ranks[block]) + int(np.bitwise_count(bits[a:b]).sum())
        return count + (int(bits[b]) & ((1 << (i & 7)) - 1)).bit_count() if i & 7 else count

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Place of the ``k``-th (from 0) bit of this value."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            ones = self._ones(plane, mid + 1)
            if (ones if bit else mid + 1 - ones) <= k:
                low = mid + 1
            else:
                high = mid
        return low

    def access(self, i: int) -> int:
        """The token at place ``i``."""
        value = 0
        for p, (zeros, _, _) in enumerate(self.planes):
            bit, ones = self._bit(p, i), self._ones(p, i)
            value = value << 1 | bit
            i = zeros + ones if bit else i - ones
        return int(self.alphabet[value])

    def _code(self, token: int) -> int | None:
        at = int(np.searchsorted(self.alphabet, token))
        return at if at < len(self.alphabet) and self.alphabet[at] == token else None

    def _range(self, code: int, i: int) -> tuple[int, int]:
        """Where the tokens of this code among the first ``i`` end up, after all planes."""
        a, b, top = 0, i, len(self.planes) - 1
        for p, (zeros, _, _) in enumerate(self.planes):
            x, y = self._ones(p, a), self._ones(p, b)
            a, b = (zeros + x, zeros + y) if code >> (top - p) & 1 else (a - x, b - y)
        return a, b

    def rank(self, token: int, i: int | None = None) -> int:
        """Occurrences of ``token`` among the first ``i`` tokens (all by default)."""
        code = self._code(token)
        if code is None:
            return 0
        a, b = self._range(code, self.n if i is None else i)
        return b - a

    def select(self, token: int, k: int) -> int:
        """Place of the ``k``-th occurrence (from 0) of ``token``."""
        if not 0 <= k < self.rank(token):
            raise IndexError(k)
        code = self._code(token)
        i = self._range(code, self.n)[0] + k
        for p in reversed(range(len(self.planes))):
            bit = code >> (len(self.planes) - 1 - p) & 1
            i = self._select(p, bit, i - self.planes[p][0] if bit else i)
        return i

    def tokens(self) -> np.ndarray:
        """All tokens, by undoing the planes from the last to the first."""
        kind = np.uint16 if len(self.alphabet) <= 1 << 16 else np.uint32
        values = np.zeros(self.n, dtype=kind)
        for shift, (zeros, _, bits) in enumerate(reversed(self.planes)):
            ones = np.unpackbits(bits, count=self.n, bitorder="little").view(bool)
            above = np.empty_like(values)
            above[np.flatnonzero(~ones)] = values[:zeros]
            above[np.flatnonzero(ones)] = values[zeros:] | kind(1 << shift)
            values = above
        return self.alphabet[values]


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, end_id: int = END_ID,
                 shard_tokens: int = SHARD_TOKENS) -> str:
    """Encode ``docs`` in id order and write the shard files to ``path``.

    One range shuffle brings the texts into order; a task writes the files of
    its range one after the other and holds one of them at a time.
    """
    file = tokenizer or default_tokenizer()
    end = int(end_id).to_bytes(4, "little")
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tie = F.xxhash64("text")
    ordered = source.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie)
    kind = source.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("part", T.LongType()), T.StructField("shard", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("doc_ids", T.ArrayType(kind)),
        T.StructField("file", T.BinaryType())])

    def run(batches):
        part, shard, ids, data, size = TaskContext.get().partitionId(), 0, [], [], 0
        kinds = None

        def flush():
            row = [[part], [shard], [size // 4], [ids], [build_shard(data)]]
            return pa.RecordBatch.from_arrays(
                [pa.array(r, t) for r, t in zip(row, [pa.int64(), pa.int64(), pa.int64(),
                                                      pa.list_(kinds), pa.binary()])],
                names=schema.names)

        for batch in batches:
            kinds = batch.column(0).type
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            doc_ids = batch.column(0).to_pylist()
            for a, b in slices([len(t) for t in texts], 8_000_000):
                for doc_id, tokens in zip(doc_ids[a:b], encoder(file).encode(texts[a:b])):
                    ids.append(doc_id)
                    data.append(tokens + end)
                    size += len(tokens) + 4
                    if size >= 4 * shard_tokens:
                        yield flush()
                        shard, ids, data, size = shard + 1, [], [], 0
        if ids:
            yield flush()

    (ordered.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path))
    return path


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Shard files with ``first_token``: the number of tokens in all files before."""
    files = spark.read.parquet(path)
    sizes = files.select("part", "shard", "n_tokens")
    # Sums per part first: the one task that adds parts up reads a row for each.
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    all_before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(all_before), F.lit(0)).alias("base"))
    before = (Window.partitionBy("part").orderBy("shard")
              .rowsBetween(Window.unboundedPreceding, -1))
    first = sizes.select("part", "shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("skip"))
    starts = first.join(parts, "part").select("part", "shard",
                                              (F.col("skip") + F.col("base")).alias("first_token"))
    # One small row per file: the files need not move to it, up to a checked number.
    few = starts.count() <= MAX_BROADCAST_FILES
    return files.join(F.broadcast(starts) if few else starts, ["part", "shard"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    files = read_shards(spark, path).select("first_token", "doc_ids", "file")
    kind = files.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField("doc_id", kind),
                           *(T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32"))])

    def run(batches):
        for batch in batches:
            for first, ids, data in zip(batch.column(0).to_pylist(), batch.column(1),
                                        batch.column(2)):
                shard = WaveletShard(data.as_py())
                tokens = shard.tokens().astype("<u4")
                ends = shard.starts
                crc = [zlib.crc32(tokens[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(ends[:-1] + first), pa.array(np.diff(ends)),
                     pa.array(crc, pa.int64())], names=schema.names)

    return files.mapInArrow(run, schema)


def write_and_read(docs: DataFrame, **options) -> DataFrame:
    """Write ``docs`` to the shared folder as shard files and read the documents back."""
    spark = docs.sparkSession
    return read_documents(spark, write_shards(docs, shared_folder(spark, "tokens"), **options))
