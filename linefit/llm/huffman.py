"""Token ids in canonical, length-limited Huffman files.

Code lengths come from the counts of all ids (package-merge, at most ``MAX_BITS``). A file
holds whole documents in ascending order:

    magic | header length (u4) | header (JSON) | code lengths (zlib) |
    documents: key, number of ids (i8 each) | bit offset of each block (u8) | bits (u8 words)

Blocks of ``BLOCK`` ids start at a recorded bit, so they decode independently; a table indexed
by the next ``MAX_BITS`` bits gives an id and the length of its code. Files are written by
tasks to the shared folder; a table of their paths counts as the archive, so files of failed
attempts are never read.

Null text counts as empty (its end id alone). Rows with a null or repeated key are kept; nulls
come first, repeated keys in the order of their texts.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linefit.llm.common import discard, pieces_of, small_batches, staged
from linefit.llm.files import open_store
from linefit.llm.tokens import DEFAULT, word_encoder
from linefit.sources.staging import new_path, remove_at_exit

END_ID, MAX_BITS, BLOCK = 1, 18, 256
#: Ids whose bits are placed together.
STRETCH = 1 << 16
#: A file is closed once it holds so many ids; a longer document has a file of its own.
FILE_IDS = 2 << 20
MAGIC = b"IDHUFF01"
#: Words whose ids a worker keeps while it encodes (about 100 MB).
KEPT = 800_000
#: Stands for a null key in a file.
NULL_KEY = -(1 << 63)


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Bits of each symbol's code, 0 for those that never occur (package-merge)."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << most:
        raise ValueError(f"{len(used)} symbols have no codes of at most {most} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    level, is_leaf = leaves, [np.ones(len(leaves), bool)]
    for _ in range(most - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([leaves, pairs])
        sort = np.argsort(merged, kind="stable")
        level = merged[sort]
        is_leaf.append(sort < len(leaves))
    take = 2 * (len(leaves) - 1)
    bits = np.zeros(len(leaves), np.int64)
    for flags in reversed(is_leaf):
        own = int(flags[:take].sum())
        bits[:own] += 1
        take = 2 * (take - own)
    lengths[order] = bits
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then symbol."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    sizes = lengths[order].astype(np.int64)
    if len(order):
        most = int(sizes.max())
        room = np.cumsum(1 << (most - sizes)) - (1 << (most - sizes))  # at full width
        codes[order] = (room >> (most - sizes)).astype(np.uint64)
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbol and code length for each pattern of the next bits, and their number."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    sizes = lengths[order].astype(np.int64)
    most = int(sizes.max()) if len(order) else 1
    spans = 1 << (most - sizes)
    symbols, bits = np.zeros(1 << most, np.uint32), np.ones(1 << most, np.uint8)
    filled = int(spans.sum())
    symbols[:filled] = np.repeat(order, spans)
    bits[:filled] = np.repeat(sizes, spans)
    return symbols, bits, most


def pack_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, block: int = BLOCK):
    """The bits as big-endian words, with a word to spare, and the bit at which blocks start.

    A stretch of ids is placed at a time, so that its arrays stay in the processor's cache.
    """
    both = codes << np.uint64(8) | lengths  # one look-up gives code and length
    total = int(sum(lengths[ids[i : i + STRETCH]].sum(dtype=np.int64) for i in range(0, len(ids), STRETCH)))
    words, offsets, base = np.zeros(total // 64 + 2, np.uint64), [], 0
    for start in range(0, len(ids), STRETCH):
        found = both[ids[start : start + STRETCH]]
        sizes, code = (found & np.uint64(255)).astype(np.int64), found >> np.uint64(8)
        ends = base + np.cumsum(sizes)
        at = ends - sizes
        base = int(ends[-1])
        offsets.append(at[-start % block :: block])
        word, over = at >> 6, (at & 63) + sizes - 64
        split = np.flatnonzero(over > 0)
        high = code << np.maximum(-over, 0).astype(np.uint64)
        high[split] >>= over[split].astype(np.uint64)
        firsts = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[firsts]] += np.add.reduceat(high, firsts)  # bits never overlap
        words[word[split] + 1] += code[split] << (64 - over[split]).astype(np.uint64)
    return words.astype(">u8"), np.concatenate([np.empty(0, "<u8"), *offsets]).astype("<u8")


def unpack_bits(words, offsets, n: int, table, block: int = BLOCK) -> np.ndarray:
    """``n`` ids; all blocks advance together, one id at a time."""
    symbols, bits, most = table
    words = words.astype(np.uint64)
    at = offsets.astype(np.int64)
    out = np.zeros((len(at), block), np.uint32)
    shift = np.uint64(64 - most)
    for i in range(min(block, n)):
        if i == n - (len(at) - 1) * block:
            at = at[:-1]  # the last block ends here
            if not len(at):
                break
        word, off = at >> 6, (at & 63).astype(np.uint64)
        # two shifts, as a shift by 64 is not defined
        seen = (words[word] << off) | ((words[word + 1] >> (np.uint64(63) - off)) >> np.uint64(1))
        index = (seen >> shift).astype(np.int64)
        out[: len(at), i] = symbols[index]
        at = at + bits[index]
    return out.ravel()[:n]


def to_bytes(keys, sizes, ids, lengths, codes, start: int, block: int = BLOCK) -> bytes:
    words, offsets = pack_bits(ids, codes, lengths, block)
    table = zlib.compress(lengths.tobytes(), 1)
    header = json.dumps({
        "documents": len(keys), "ids": len(ids), "start": start, "block": block,
        "symbols": len(lengths), "table": len(table), "blocks": len(offsets),
    }).encode()
    return b"".join([
        MAGIC, struct.pack("<I", len(header)), header, table,
        np.asarray(keys, "<i8").tobytes(), np.asarray(sizes, "<i8").tobytes(),
        offsets.tobytes(), words.tobytes(),
    ])


def from_bytes(data: bytes):
    """Keys, sizes, ids and the header of a file."""
    if data[:8] != MAGIC:
        raise ValueError("not a file of this format")
    (size,) = struct.unpack_from("<I", data, 8)
    header = json.loads(data[12 : 12 + size])
    at = 12 + size
    lengths = np.frombuffer(zlib.decompress(data[at : at + header["table"]]), np.uint8)
    at += header["table"]
    n = header["documents"]
    keys = np.frombuffer(data, "<i8", n, at)
    sizes = np.frombuffer(data, "<i8", n, at + 8 * n)
    at += 16 * n
    offsets = np.frombuffer(data, "<u8", header["blocks"], at)
    words = np.frombuffer(data, ">u8", -1, at + 8 * header["blocks"])
    ids = unpack_bits(words, offsets, header["ids"], decode_table(lengths), header["block"])
    return keys, sizes, ids, header


def ordered_ids(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = DEFAULT,
    end_id: int = END_ID,
) -> tuple[DataFrame, str]:
    """Staged (part, key, local, n, ids): parts ascend by key, and rows ascend within a part.

    ``local`` counts the ids before a document within its part. It is negative in one more row
    per part, whose ``ids`` are how often each id occurs in the part.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(text, F.lit("")).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = word_encoder(tokenizer, KEPT)
        end = np.array([end_id], encoder.dtype).tobytes()
        part, local = TaskContext.get().partitionId(), 0
        counts = np.zeros(max(encoder.library.get_vocab_size(), end_id + 1), "<i8")
        for batch in pieces_of(batches, "text"):
            ids = [x + end for x in encoder.encode(batch.column("text").to_pylist())]
            sizes = np.array([len(x) // encoder.dtype.itemsize for x in ids], np.int64)
            before = local + np.cumsum(sizes) - sizes
            local += int(sizes.sum())
            for start in range(0, len(ids), 64):
                some = np.frombuffer(b"".join(ids[start : start + 64]), encoder.dtype)
                counts += np.bincount(some, minlength=len(counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(ids), pa.int32()), batch.column("key"),
                 pa.array(before), pa.array(sizes), pa.array(ids, pa.binary())],
                ["part", "key", "local", "n", "ids"],
            )
        if local:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.nulls(1, pa.int64()), pa.array([-1]),
                 pa.array([local]), pa.array([counts.tobytes()], pa.binary())],
                ["part", "key", "local", "n", "ids"],
            )

    ordered = rows.repartitionByRange("key").sortWithinPartitions("key", "text")
    return staged(
        ordered.mapInArrow(encode, "part int, key long, local long, n long, ids binary"), "ids"
    )


def id_counts(ids: DataFrame, symbols: int) -> np.ndarray:
    """How often each id occurs, from the parts' own counts."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(symbols, np.int64)
        for batch in batches:
            for data in batch.column("ids").to_pylist():
                total += np.frombuffer(data, "<i8")
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(total[used])], ["id", "n"]
        )

    parts = ids.where("local < 0").select("ids")
    rows = parts.mapInArrow(unfold, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(symbols, np.int64)
    for r in rows.collect():  # no more rows than the vocabulary has ids
        counts[r["id"]] = r["n"]
    return counts


def write(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = DEFAULT,
    end_id: int = END_ID, max_bits: int = MAX_BITS,
) -> DataFrame:
    """Encode ``docs`` into files; returns the archive: path, part, n (ids) of each file."""
    spark = docs.sparkSession
    small_batches(spark)
    encoder = word_encoder(tokenizer)
    symbols, width = max(encoder.library.get_vocab_size(), end_id + 1), encoder.dtype.itemsize
    ids, path = ordered_ids(docs, key, text, tokenizer, end_id)
    lengths = code_lengths(id_counts(ids, symbols), max_bits)
    codes = canonical_codes(lengths)
    folder = new_path(spark, "huffman")
    remove_at_exit(spark, folder)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)

        def close(part, keys, sizes, data, first) -> pa.RecordBatch:
            name = f"{part:06d}-{first:015d}-{uuid.uuid4().hex}"
            found = np.frombuffer(b"".join(data), f"<u{width}")
            with store.open_output_stream(f"{root}/{name}") as f:
                f.write(to_bytes(keys, sizes, found, lengths, codes, first))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([first]), pa.array([len(found)]),
                 pa.array([f"{folder}/{name}"])],
                ["part", "first", "n", "path"],
            )

        part, keys, sizes, data, first, held = None, [], [], [], 0, 0
        for batch in pieces_of(batches, "ids"):
            for p, k, local, n, x in zip(*(
                batch.column(c).to_pylist() for c in ("part", "key", "local", "n", "ids")
            )):
                if keys and (p != part or local != first + held or held + n > FILE_IDS):
                    yield close(part, keys, sizes, data, first)
                    keys, sizes, data = [], [], []
                if not keys:
                    part, first, held = p, local, 0
                keys.append(NULL_KEY if k is None else k)
                sizes.append(n)
                data.append(x)
                held += n
        if keys:
            yield close(part, keys, sizes, data, first)

    archive, _ = staged(
        ids.where("local >= 0").mapInArrow(encode, "part int, first long, n long, path string"), "huffman-files"
    )
    discard(spark, path)
    return archive


def read(spark: SparkSession, archive: DataFrame, with_ids: bool = True) -> DataFrame:
    """Documents of the files: key, start, n_tokens, ids_crc32 (and ids, unsigned 32-bit)."""
    parts = {r["part"]: r["n"] for r in archive.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    bases, total = {}, 0  # one number for each partition that wrote files
    for part in sorted(parts):
        bases[part] = total
        total += parts[part]
    files = archive.count()
    spread = archive.select("part", "first", "path").repartition(max(1, files), "path")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, name in zip(*(
                batch.column(c).to_pylist() for c in ("part", "first", "path")
            )):
                store, place = open_store(name)
                with store.open_input_stream(place) as f:
                    keys, sizes, ids, _ = from_bytes(f.read())
                ids = ids.astype("<u4")
                ends = np.cumsum(sizes)
                begins = ends - sizes
                parts_of = [ids[a:b].tobytes() for a, b in zip(begins, ends)]
                columns = [
                    pa.array(keys, mask=keys == NULL_KEY),
                    pa.array(bases[part] + first + begins), pa.array(sizes),
                    pa.array([zlib.crc32(x) for x in parts_of], pa.int64()),
                ]
                names = ["key", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(parts_of, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "key long, start long, n_tokens long, ids_crc32 long"
    return spread.mapInArrow(decode, schema + (", ids binary" if with_ids else ""))
