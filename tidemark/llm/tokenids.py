"""Token ids of documents in a compact binary format, by frequency rank.

Ids are replaced by their rank among all ids of the corpus, the most frequent first, so
most fit one byte.  Ranks are written in a byte-aligned variable-length code: two
control bits per value say how many bytes it has, the control bytes of a block stand
apart from its data bytes, and so a block is decoded by table lookup and gathers in
numpy, without a loop over values.

A file begins with its rank table and goes on with blocks of documents in ascending
doc_id order; each block says where it begins in the whole corpus.  Spark's text writer
commits the files (rows are blocks, one line feed behind each), `binaryFile` reads them.

The texts are encoded once.  Where the tokenizer drops blanks, a text's ids are those of
its words, one after the other; equal words of a slice of texts are then encoded once,
found by their hashes in numpy.  The ids go through one exchange to the shards, ranges of
doc_id; counting ids, placing the shards and writing all read that exchange.

Defined results: a null text is an empty one and has the end id alone.  A null doc_id
comes first.  Rows that repeat a doc_id all stay, ordered by their ids' checksum and
number.  An empty table gives no files and no rows.
"""

from __future__ import annotations

import json
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import words as W

END_ID = 1
#: Text of a shard, which is a file, and ids of a block.
SHARD_BYTES = 32 << 20
BLOCK_IDS = 1 << 20
#: Words, and pieces of words, whose ids a task remembers.
REMEMBERED, PIECES = 600_000, 200_000
#: What special tokens begin with; they stand for themselves in this case only.
SPECIAL = b"<|"
#: ASCII marks that end a word; the apostrophe is left out, for the tokenizer looks behind it.
TAIL = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
FILE_MAGIC, BLOCK_MAGIC = b"TMR1", b"TMB1"
FILE_HEAD, BLOCK_HEAD = "<4sI", "<4sQQQQ"


# --- the code ---------------------------------------------------------------


def control_lengths() -> np.ndarray:
    """Bytes of each of the four values that a control byte stands for."""
    return ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = values.astype("<u4")
    code = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = code
    control = padded.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4)[None] <= code[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode_values(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    lengths = control_lengths()[control].reshape(-1)[:n].astype(np.int64)
    start = np.cumsum(lengths) - lengths
    if n and start[-1] + lengths[-1] != len(data):
        raise ValueError("data bytes differ from what the control bytes say")
    data = np.concatenate([data, np.zeros(3, np.uint8)])
    out = np.zeros(n, np.uint32)
    for k in range(4):
        out |= np.where(lengths > k, data[start + k], 0).astype(np.uint32) << np.uint32(8 * k)
    return out


# --- encoding texts ---------------------------------------------------------


def byte_letters() -> dict[int, str]:
    """Byte-level tokenizers' letter for each byte: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _may_be_special(words: W.Words) -> np.ndarray:
    """Words that hold the first bytes of a special token."""
    out = np.zeros(len(words.start), bool)
    data = words.data
    at = np.flatnonzero((data[:-1] == SPECIAL[0]) & (data[1:] == SPECIAL[1]))
    if len(at) and len(out):
        word = np.searchsorted(words.start, at, "right") - 1
        out[word[(word >= 0) & (at + 1 < words.end[word])]] = True
    return out


class Encoder:
    """Ids of whole texts, as one array with the end of each text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.hasher = W.Hasher()
        self._forget()
        self.model = self.tokenizer.model
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.tails: dict[bytes, tuple[int, ...]] = {}
        self.letters = str.maketrans(byte_letters())
        with open(path, encoding="utf-8") as file:
            made = json.load(file)

        def kinds(part, inner):
            return [x["type"] for x in (part or {}).get(inner, [])]

        split = (made.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        self.by_word = (
            kinds(made.get("normalizer"), "normalizers") == ["NFC", "Replace", "Lowercase"]
            and kinds(made.get("pre_tokenizer"), "pretokenizers") == ["Split", "ByteLevel"]
            and split.get("invert") is True
            and split.get("behavior") == "Removed"
            and all(t["content"].startswith(SPECIAL.decode()) for t in made.get("added_tokens", []))
        )

    def _word(self, word: bytes) -> tuple[int, ...]:
        """Ids of a lower-cased word; letters and marks behind them are split as the tokenizer does."""
        stem = word.rstrip(TAIL)
        if stem.isalpha():  # bytes, so ASCII letters
            ids = self._piece(stem.decode())
        else:
            text = stem.decode("utf-8", "replace")
            lower = text.lower()
            # Letters only, in normal form: normalising and splitting leave them whole.
            if not (text.isalpha() and lower.isalpha() and "Σ" not in text and unicodedata.is_normalized("NFC", text)):
                return self._whole(word)
            ids = self._piece(lower.encode().decode("latin-1").translate(self.letters))
        tail = word[len(stem) :]
        if tail:
            marks = self.tails.get(tail)
            if marks is None:
                marks = tuple(self.tokenizer.encode(tail.decode(), add_special_tokens=False).ids)
                if len(self.tails) < PIECES:
                    self.tails[tail] = marks
            ids += marks
        return ids

    def _whole(self, word: bytes) -> tuple[int, ...]:
        return tuple(self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids)

    def _piece(self, piece: str) -> tuple[int, ...]:
        ids = self.pieces.get(piece)
        if ids is None:
            if len(self.pieces) >= PIECES:
                self.pieces.clear()
            ids = self.pieces[piece] = tuple([t.id for t in self.model.tokenize(piece)])
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_word:
            found = self.tokenizer.encode_batch(
                [t or "" for t in texts.to_pylist()], add_special_tokens=False
            )
            sizes = [len(x.ids) for x in found]
            return np.array([i for x in found for i in x.ids], np.uint32), np.cumsum([0, *sizes])
        words = W.split(texts)
        hashes, special = self.hasher.words(words, lower=True), _may_be_special(words)
        if special.any():
            cased = self.hasher.words(words, lower=False)[special]
            hashes[special] = W.mix(cased + np.uint64(1))
        kinds, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) + len(kinds) > REMEMBERED:
            self._forget()
        new = ~np.isin(kinds, self.hashes, assume_unique=True)
        data = words.data.tobytes()
        lower, asked = data.lower(), first[new]
        begins, ends = words.start[asked].tolist(), words.end[asked].tolist()
        ids = [
            self._whole(data[a:b]) if as_given else self._word(lower[a:b])
            for a, b, as_given in zip(begins, ends, special[asked].tolist(), strict=True)
        ]
        self._remember(kinds[new], ids)
        at = np.searchsorted(self.hashes, kinds)
        begin, size = self.begin[at][kind], self.size[at][kind]
        ends = np.concatenate(([0], np.cumsum(size)))
        return self.flat[np.arange(ends[-1]) + np.repeat(begin - ends[:-1], size)], ends[words.first]

    def _forget(self) -> None:
        """The ids of words by hash: sorted hashes, and the place of each word's ids."""
        self.hashes = np.zeros(0, np.uint64)
        self.begin = self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _remember(self, hashes: np.ndarray, ids: list[tuple[int, ...]]) -> None:
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        begin = len(self.flat) + np.cumsum(size) - size
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))
        self.flat = np.concatenate([self.flat, flat])
        hashes = np.concatenate([self.hashes, hashes])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.begin = np.concatenate([self.begin, begin])[order]
        self.size = np.concatenate([self.size, size])[order]


def _shards(path: str, bounds: list[int], end_id: int, wide: str):
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents of a slice that belong to one shard, as one row."""
        encoder, edges = Encoder(path), np.array(bounds, np.int64)
        packer = zstandard.ZstdCompressor(1)
        for batch in batches:
            for part in W.slices(batch):
                ids, ends = encoder.encode(part.column("text"))
                ids = np.insert(ids, ends[1:], end_id).astype(wide)
                ends = ends + np.arange(len(ends))
                docs = part.column("doc_id")
                void = docs.is_null().to_numpy(zero_copy_only=False)
                doc = docs.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                shard = np.where(void, 0, np.searchsorted(edges, doc, "right"))
                rows: dict[str, list] = {k: [] for k in ("shard", "n", "docs", "void", "sizes", "ids")}
                for s in np.unique(shard):
                    mine = np.flatnonzero(shard == s)
                    own = [ids[ends[i] : ends[i + 1]] for i in mine]
                    rows["shard"].append(int(s))
                    rows["n"].append(sum(map(len, own)))
                    rows["docs"].append(doc[mine].tobytes())
                    rows["void"].append(void[mine].tobytes())
                    rows["sizes"].append(np.array([len(x) for x in own], np.int64).tobytes())
                    rows["ids"].append(packer.compress(np.concatenate(own).tobytes()))
                yield pa.record_batch(rows, schema=SHARD_SCHEMA)

    return shards


SHARD_SCHEMA = pa.schema(
    {
        "shard": pa.int32(),
        "n": pa.int64(),
        "docs": pa.binary(),
        "void": pa.binary(),
        "sizes": pa.binary(),
        "ids": pa.binary(),
    }
)


def _counts(wide: str):
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How often each id occurs in the partition; one row per id of the vocabulary."""
        total = np.zeros(0, np.int64)
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for ids in batch.column("ids"):
                seen = np.bincount(np.frombuffer(unpacker.decompress(ids.as_py()), wide))
                if len(seen) > len(total):
                    seen[: len(total)] += total
                    total = seen
                else:
                    total[: len(seen)] += seen
        used = np.flatnonzero(total)
        yield pa.record_batch({"id": pa.array(used, pa.int32()), "n": pa.array(total[used], pa.int64())})

    return counts


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.select(["shard", "n"])


def _blocks(wide: str):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of a shard, ordered by document and cut into blocks.

        A shard is a bounded part of the corpus, so its ids fit in memory.
        """
        unpacker = zstandard.ZstdDecompressor()

        def cut(shard: int, rows: list[dict]) -> Iterator[pa.RecordBatch]:
            doc = np.concatenate([np.frombuffer(r["docs"], np.int64) for r in rows])
            void = np.concatenate([np.frombuffer(r["void"], bool) for r in rows])
            sizes = np.concatenate([np.frombuffer(r["sizes"], np.int64) for r in rows])
            ids = np.concatenate([np.frombuffer(unpacker.decompress(r["ids"]), wide) for r in rows])
            ends = np.cumsum(sizes)
            check = np.array([zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends, sizes, strict=True)])
            order = np.lexsort((sizes, check, doc, ~void))
            before = np.cumsum(sizes[order]) - sizes[order]
            block = before // BLOCK_IDS
            for seq in np.unique(block):
                mine = order[block == seq]
                yield pa.record_batch(
                    {
                        "shard": pa.array([shard], pa.int32()),
                        "seq": pa.array([int(seq)], pa.int32()),
                        "inside": pa.array([int(before[block == seq][0])], pa.int64()),
                        "docs": pa.array([doc[mine].tobytes()], pa.binary()),
                        "void": pa.array([void[mine].tobytes()], pa.binary()),
                        "sizes": pa.array([sizes[mine].tobytes()], pa.binary()),
                        "ids": pa.array(
                            [np.concatenate([ids[ends[i] - sizes[i] : ends[i]] for i in mine]).tobytes()], pa.binary()
                        ),
                    }
                )

        shard, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and row["shard"] != shard:
                    yield from cut(shard, rows)
                    rows = []
                shard = row["shard"]
                rows.append(row)
        if rows:
            yield from cut(shard, rows)

    return blocks


def _coded(wide: str):
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of a file: its rank table, then its blocks."""
        rank = None
        for batch in batches:
            for row in batch.to_pylist():
                if rank is None:
                    ids = np.array(row["ranked"], "<u4")
                    rank = np.zeros(int(ids.max()) + 1, np.uint32)
                    rank[ids] = np.arange(len(ids))
                    head = struct.pack(FILE_HEAD, FILE_MAGIC, len(ids)) + ids.tobytes()
                    yield pa.record_batch({"block": pa.array([head], pa.binary())})
                control, data = encode_values(rank[np.frombuffer(row["ids"], wide)])
                sizes = np.frombuffer(row["sizes"], np.int64)
                size_control, size_data = encode_values(sizes)
                head = struct.pack(
                    BLOCK_HEAD, BLOCK_MAGIC, row["start"] + row["inside"], len(sizes), int(sizes.sum()), len(data)
                )
                body = struct.pack("<Q", len(size_data)) + size_control + size_data
                body += row["docs"] + row["void"] + control + data
                yield pa.record_batch({"block": pa.array([head + body], pa.binary())})

    return coded


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Files of the ids of `docs` (doc_id, text) below `path`."""
    from tokenizers import Tokenizer

    vocabulary = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1)
    wide = "<u2" if vocabulary <= 1 << 16 else "<u4"
    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    total = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    ranges = given.select("doc_id").repartitionByRange(shards, "doc_id")
    lows = ranges.groupBy(F.spark_partition_id()).agg(F.min("doc_id").alias("low"))
    # One number per shard reaches the driver.
    bounds = sorted(r["low"] for r in lows.collect() if r["low"] is not None)[1:]
    columns = "shard int, n bigint, docs binary, void binary, sizes binary, ids binary"
    coded = given.mapInArrow(_shards(tokenizer, bounds, end_id, wide), columns)
    dealt = coded.repartition(len(bounds) + 1, "shard")
    # One row per shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # Through a map of all columns: a projection would reach below the exchange, which
    # could then not be read again for the counts and the blocks.
    starts = dealt.mapInArrow(_totals, "shard int, n bigint").groupBy("shard").agg(F.sum("n").alias("n"))
    starts = starts.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    # One row, no longer than the vocabulary.
    counts = dealt.mapInArrow(_counts(wide), "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    by_rank = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("order"), "id")))
    ranks = counts.agg(F.transform(by_rank, lambda x: x["id"]).alias("ranked"))
    columns = "shard int, seq int, inside bigint, docs binary, void binary, sizes binary, ids binary"
    blocks = dealt.sortWithinPartitions("shard").mapInArrow(_blocks(wide), columns)
    blocks = blocks.join(starts, "shard").crossJoin(F.broadcast(ranks))
    rows = blocks.sortWithinPartitions("shard", "seq").mapInArrow(_coded(wide), "block binary")
    rows.select(F.col("block").cast("string")).write.option("lineSep", "\n").text(path)


def decode_file(content: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Start, doc_ids, which of them are null, sizes and ids of each block of a file."""
    magic, n = struct.unpack_from(FILE_HEAD, content)
    if magic != FILE_MAGIC:
        raise ValueError("not a file of token ids")
    at = struct.calcsize(FILE_HEAD)
    ids_of = np.frombuffer(content, "<u4", n, at)
    at += 4 * n + 1

    def take(count: int, kind: str = "u1") -> np.ndarray:
        nonlocal at
        out = np.frombuffer(content, kind, count, at)
        at += out.nbytes
        return out

    while at < len(content):
        magic, start, docs, ids, data = struct.unpack_from(BLOCK_HEAD, content, at)
        if magic != BLOCK_MAGIC:
            raise ValueError(f"no block begins at {at}")
        at += struct.calcsize(BLOCK_HEAD)
        size_data = int(take(1, "<u8")[0])
        sizes = decode_values(take(-(-docs // 4)), take(size_data), docs).astype(np.int64)
        doc, void = take(docs, "<i8"), take(docs).astype(bool)
        values = decode_values(take(-(-ids // 4)), take(data), ids)
        if sizes.sum() != ids or bytes(content[at : at + 1]) != b"\n":
            raise ValueError(f"block that ends at {at} is damaged")
        at += 1
        yield start, doc, void, sizes, ids_of[values]


def _read(with_ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                if content.as_buffer().size == 0:
                    continue
                for start, doc, void, sizes, ids in decode_file(content.as_buffer()):
                    ends = np.cumsum(sizes)
                    ids = ids.astype("<u4")
                    crc = [zlib.crc32(ids[e - n : e]) for e, n in zip(ends, sizes, strict=True)]
                    out = {
                        "doc_id": pa.array(doc, pa.int64(), mask=void),
                        "start": pa.array(start + ends - sizes, pa.int64()),
                        "n_tokens": pa.array(sizes, pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    }
                    if with_ids:
                        edges = pa.array(np.concatenate(([0], ends)), pa.int32())
                        out["ids"] = pa.ListArray.from_arrays(edges, pa.array(ids.astype(np.int32)))
                    yield pa.record_batch(out)

    return read


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) from the files below `path`."""
    files = spark.read.format("binaryFile").load(path).select("content")
    columns = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return files.mapInArrow(_read(with_ids), columns + ", ids array<int>" * with_ids)
