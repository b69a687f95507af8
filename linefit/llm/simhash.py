"""Near-duplicates by SimHash, found through deletion-variant signatures.

A 64-bit fingerprint is cut into two halves. Two fingerprints that differ in at most three
bits agree in one half up to one bit, so they share that half with the bit that differs struck
out: a half is indexed under its 32 variants with one wildcard each, and equal keys are
compared. Documents with the same fingerprint are one class before anything is compared.

A key's fingerprints are compared at once only if they are few. A larger group goes to the
next round under longer keys: its members already agree in the bits of the key, and of the
remaining ones, cut in four, one part must be equal. Fingerprints are distinct, so groups are
bounded once few bits are free; no pair is lost and no group is ever compared pair by pair at
full size. Within a group the links are reduced to stars, which keeps components whole.

Null or empty text has fingerprint zero, linked like any other. Repeated rows are copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefit.llm.common import discard, pieces_of, salted_lookup, staged
from linefit.llm.components import components

SHINGLE, DISTANCE, SEED = 3, 3, 42
#: Fingerprints compared at once under one key.
GROUP = 512


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles, repeats included."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII only, both
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for start in range(0, n, 100_000):
        stop = min(n, start + 100_000)
        parts = [words[start + k : stop + k] for k in range(shingle)] if len(words) >= shingle else [words]
        joined = map(b" ".join, zip(*parts)) if len(words) >= shingle else [b" ".join(words)]
        hashes = np.fromiter((digest(x, SEED) for x in joined), "<u8", stop - start)
        total += _bit_counts(hashes)
    return int(np.packbits((2 * total > n).astype(np.uint8), bitorder="little").view("<u8")[0])


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    # sums of 255 rows fit a byte
    full = len(bits) // 255 * 255
    head = np.add.reduce(bits[:full].reshape(-1, 255, 64), axis=1, dtype=np.uint8) if full else bits[:0]
    return head.sum(axis=0, dtype=np.int64) + bits[full:].sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``key`` and ``fp``, the fingerprint as a signed long, one row per row."""
    kind = docs.schema[key].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            found = np.array(
                [fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64
            )
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found.view(np.int64))], ["key", "fp"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(make, f"key {kind}, fp long").withColumnRenamed("key", key)


def variants(fps: DataFrame) -> DataFrame:
    """(key, free, fp): 64 keys of each fingerprint. ``free`` has the bits that the key leaves.

    The key is a hash of the half, the wildcard and the other bits of the half.
    """
    half = F.explode(F.array(F.lit(0), F.lit(32))).alias("half")
    bit = F.explode(F.sequence(F.lit(0), F.lit(31))).alias("bit")
    # ``half`` and ``bit`` say which bits belong to the key
    kept = F.expr("shiftleft(4294967295L & ~shiftleft(1L, bit), half)")
    return (
        fps.select("fp", half).select("fp", "half", bit).withColumn("kept", kept)
        .select(F.xxhash64("kept", F.col("fp").bitwiseAND(F.col("kept"))).alias("key"),
                F.bitwise_not("kept").alias("free"), "fp")
    )


def _compare(distance: int, most: int):
    """Function over batches sorted by (key, fp): links, and members of groups too large.

    Output rows: (a, b, null, null) for a link, (null, fp, key, free) for a row of the next
    round.
    """

    def links(fps: np.ndarray) -> np.ndarray:
        """Each member with the smallest member of its part of the group, where they differ."""
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance
        label = np.arange(len(fps))
        while True:
            least = np.where(near, label[None, :], len(fps)).min(axis=1)
            least = least[least]
            if (least == label).all():
                return least
            label = least

    def finer(fps: np.ndarray, key: int, free: int) -> Iterator[pa.RecordBatch]:
        bits = [b for b in range(64) if free >> b & 1]
        for part in range(4):
            own = bits[part::4]
            mask = np.uint64(sum(1 << b for b in own))
            keys = _mix(fps & mask, (key * 4 + part + 1) & 0xFFFFFFFFFFFFFFFF)
            left = np.uint64(free & ~int(mask))
            yield _rows(None, fps, keys, np.full(len(fps), left))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, free, held, large = None, 0, [], False

        def settle() -> Iterator[pa.RecordBatch]:
            fps = np.unique(np.concatenate(held)) if held else np.empty(0, np.uint64)
            if large or len(fps) > most:
                yield from finer(fps, key, free)
            elif len(fps) > 1:
                least = links(fps)
                own = np.flatnonzero(least != np.arange(len(fps)))
                if len(own):
                    yield _rows(fps[least[own]], fps[own], None, None)

        for batch in batches:
            keys, frees, fps = (
                batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                for c in ("key", "free", "fp")
            )
            if not len(keys):
                continue
            edges = np.flatnonzero(np.diff(keys, prepend=keys[0] ^ np.uint64(1)))
            stops = np.append(edges[1:], len(keys))
            alone = (stops - edges == 1)
            alone[[0, -1]] = False  # may go on in the batch before or after
            for a, b in zip(edges[~alone].tolist(), stops[~alone].tolist()):
                if key is None or int(keys[a]) != key:
                    yield from settle()
                    key, free, held, large = int(keys[a]), int(frees[a]), [], False
                held.append(fps[a:b])
                if sum(map(len, held)) > most:
                    rows = np.unique(np.concatenate(held))
                    held = [rows]
                    if large or len(rows) > most:
                        large = True
                        yield from finer(rows, key, free)
                        held = []
        yield from settle()

    return run


def _mix(values: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of each value and the salt."""
    x = values ^ np.uint64(salt)
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _rows(a, b, key, free) -> pa.RecordBatch:
    def column(values):
        return pa.nulls(len(b), pa.int64()) if values is None else pa.array(values.view(np.int64))

    return pa.RecordBatch.from_arrays([column(x) for x in (a, b, key, free)], ["a", "fp", "key", "free"])


def linked_fingerprints(fps: DataFrame, distance: int = DISTANCE, most: int = GROUP) -> tuple[DataFrame, list[str]]:
    """Staged edges (a, b) between distinct fingerprints (column ``fp``) that link, as stars.

    Also the paths of the staged tables. ``distance`` may be at most 3, for which the keys are
    made: more differing bits could leave two in either half.
    """
    if distance > 3:
        raise ValueError("two halves with one wildcard find at most three differing bits")
    if most < 16:
        raise ValueError("a group of 16 must be allowed, so that longer keys always split more")
    rows, found, paths = variants(fps), None, []
    while True:
        dealt = rows.repartition("key").sortWithinPartitions("key", "fp")
        out, path = staged(
            dealt.mapInArrow(_compare(distance, most), "a long, fp long, key long, free long"),
            "links",
        )
        paths.append(path)
        links = out.where("a is not null").select("a", F.col("fp").alias("b"))
        found = links if found is None else found.unionByName(links)
        rows = out.where("key is not null").select("key", "free", "fp")
        if rows.isEmpty():
            return found, paths


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """``key``, ``fp`` (16 hex digits) and ``component_id`` of every row.

    ``component_id`` is the smallest key among the documents that links reach. Rows with a null
    key take part; a component of such rows alone has a null id.
    """
    spark = docs.sparkSession
    marked, _ = staged(fingerprints(docs, key, text, shingle), "fingerprints")
    classes, classes_path = staged(marked.groupBy("fp").agg(F.min(key).alias("least")), "classes")
    edges, paths = linked_fingerprints(classes.select("fp"), distance)
    groups, groups_path = components(edges)
    # components are named by fingerprints so far; the name in demand is the smallest key
    member = groups.select(F.col("node").alias("fp"), F.col("component").alias("root"))
    rooted = classes.join(member, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted, rooted_path = staged(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    linked = salted_lookup(
        rooted.select("fp", "root"), "root", named.where("n > 1").select("root", "component_id"),
        F.col("fp"),
    ).where("component_id is not null").select("fp", "component_id")
    alone = rooted.join(linked.select("fp"), "fp", "left_anti").select("fp", F.col("least").alias("component_id"))
    mapping, _ = staged(linked.unionByName(alone), "members")
    discard(spark, *paths, groups_path, rooted_path, classes_path)
    return salted_lookup(marked, "fp", mapping, F.col(key)).select(
        F.col(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
