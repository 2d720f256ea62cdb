"""SimHash near-duplicates with pigeonring candidate filtering.

A fingerprint of 64 bits is cut into 8 segments on a ring. Two fingerprints with
at most 3 differing bits have, by the pigeonring principle, a segment from which every
chain of ``l`` consecutive segments differs in at most ``floor(3 l / 8)``
bits: the first two segments agree, the next three differ in one bit at most, and so on.
The index therefore keys each fingerprint, for each of the 8 starts, by the two
exact segments and by either half of the next three (one half agrees, since they
hold at most one differing bit): 16 keys of 28 bits. Pairs that share a key
pass the rest of the chain and then the full Hamming check.

Rows with equal fingerprints are one node. Buckets of many distinct fingerprints are
cut into blocks, each pair of blocks a task's unit of its own; a unit emits the links of a
spanning forest, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunked, packed, stage_table, text_batches, unpack
from .components import components
from .pairs import near_rows, pair_units, whole_units

SHINGLE = 3
MAX_BITS = 3
SEGMENTS, SEGMENT_BITS = 8, 8
#: Distinct fingerprints of a bucket that are compared as one unit.
BLOCK = 2048
#: Units up to this size are compared pair by pair, larger ones node by node.
SMALL = 16
SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text, repeats included; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(flat, SEED)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:len(words) - shingle + 1].tolist()
    h = np.array([digest(flat[i:j], SEED) for i, j in zip(starts, ends[shingle - 1:].tolist(), strict=True)], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 65_536):
        ones += np.unpackbits(h[at:at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id_col, fingerprint long`` (the bits of the unsigned value) for every row; 0 for null and wordless texts."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunked(batches, 1):
            fp = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], [id_col, "fingerprint"])

    return text_batches(docs).select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, fingerprint long")


def _keys(f: str):
    """The 16 index keys of a fingerprint: start, half and 28 bits packed in one integer."""
    keys = []
    for start in range(SEGMENTS):
        turn = start * SEGMENT_BITS
        ring = F.col(f) if not turn else F.shiftleft(F.col(f), turn).bitwiseOR(F.shiftrightunsigned(F.col(f), 64 - turn))
        exact = F.shiftrightunsigned(ring, 48)
        for half in (0, 1):
            part = F.shiftrightunsigned(ring, 36 - 12 * half).bitwiseAND(F.lit(0xFFF))
            keys.append(F.shiftleft(exact, 12).bitwiseOR(part).bitwiseOR(F.lit((2 * start + half) << 28)))
    return F.array(*keys)


_CHAIN = [(((1 << l * SEGMENT_BITS) - 1) << (64 - l * SEGMENT_BITS), MAX_BITS * l // SEGMENTS) for l in range(3, SEGMENTS)]


def _close(x: np.ndarray, start: np.ndarray | int) -> np.ndarray:
    """Which differences ``x`` (XOR of a pair) pass the chain from ``start`` and the full check."""
    turn = np.asarray(start, dtype=np.uint64) * np.uint64(SEGMENT_BITS)
    ring = x << turn | x >> (np.uint64(64) - turn) % np.uint64(64) if np.ndim(turn) else (
        x if not int(turn) else x << turn | x >> np.uint64(64 - int(turn)))
    ok = np.ones(len(x), dtype=bool)
    for mask, budget in _CHAIN:
        ok &= np.bitwise_count(ring & np.uint64(mask)) <= budget
    ok[ok] = np.bitwise_count(x[ok]) <= MAX_BITS
    return ok


def _forest(fp: np.ndarray, node: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of one unit: each node met is compared with those not yet met."""
    links, left = [], np.arange(len(fp))
    while len(left):
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            i = front.pop()
            near = _close(fp[left] ^ fp[i], start)
            if near.any():
                met = left[near]
                links += [(int(node[i]), int(node[j])) for j in met]
                front += met.tolist()
                left = left[~near]
    return links


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, low, high, mine, fingerprint, node) sorted by unit -> links."""
    for t, first, size in whole_units(batches):
        start = t.column(0).to_numpy() >> 29
        fp, node = t.column(4).to_numpy().view(np.uint64), t.column(5).to_numpy()
        found = []
        for i, j in near_rows(first, size, SMALL):
            ok = _close(fp[i] ^ fp[j], start[i])
            found.append(np.stack([node[i[ok]], node[j[ok]]], axis=1))
        for s, n in zip(first[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
            found.append(np.array(_forest(fp[s:s + n], node[s:s + n], int(start[s])), dtype=np.int64).reshape(-1, 2))
        if found:
            links = np.concatenate(found)
            yield pa.RecordBatch.from_arrays([pa.array(links[:, 0].copy()), pa.array(links[:, 1].copy())], ["a", "b"])


def fingerprint_links(nodes: DataFrame) -> DataFrame:
    """``a, b``: links that connect all nodes at most ``MAX_BITS`` bits apart as the full set of links would.

    ``nodes`` has one row per distinct fingerprint: ``node long, fingerprint long``.
    """
    keyed = stage_table(nodes.select(F.explode(_keys("fingerprint")).alias("key"), "fingerprint", "node"), "simhash-keys")
    return pair_units(keyed, "fingerprint", BLOCK, "simhash").mapInArrow(_units, "a long, b long")


def classes(prints: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``fingerprint, component_id``: the smallest id reachable over links, for each distinct fingerprint.

    ``prints`` has ``id_col`` and ``fingerprint``. Rows whose id is null take part in links; their class has a null
    ``component_id`` only where it holds no other id.
    """
    nodes = stage_table(prints.groupBy("fingerprint").agg(F.min(id_col).alias("least")), "simhash-nodes")
    # the fingerprint is the node; a class's smallest id is taken afterwards
    found = components(fingerprint_links(nodes.select("fingerprint", F.col("fingerprint").alias("node"))))
    of = stage_table(nodes.join(found, nodes.fingerprint == found.node, "left")
                     .select("fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")), "simhash-classes")
    least = stage_table(of.groupBy("component").agg(F.min("least").alias("component_id")), "simhash-least")
    return stage_table(of.join(least, "component").select("fingerprint", "component_id"), "simhash-map")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id_col, fingerprint, component_id`` for every row.

    Null, empty and wordless texts have fingerprint 0 and are linked like any other. Repeated
    rows are returned repeatedly; other columns are ignored.
    """
    prints = stage_table(fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    return prints.join(classes(prints, id_col), "fingerprint").select(id_col, "fingerprint", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns: the smallest id, then the smallest hash of its text.

    A row is known by 64-bit hashes of its id and its text, so rows that repeat both count as one.
    """
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    ident = F.struct(F.col(id_col).alias("id"), text_hash.alias("text_hash"))

    def id_hash(c: str):
        return F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit("")), F.col(c).isNull())

    prints = stage_table(fingerprints(docs.select(ident.alias("ident"), F.col(text_col).alias("text")), "ident", "text", shingle), "simhash-prints")
    kept = stage_table(classes(prints, "ident").select("component_id.id", "component_id.text_hash")
                       .select(id_hash("id").alias("id_hash"), "text_hash").distinct(), "simhash-kept")
    # plain hash keys without nulls: the join's shuffle serves the removal of repeated rows as well
    rows = docs.select(packed(docs).alias("row"), id_hash(id_col).alias("id_hash"), text_hash.alias("text_hash"))
    keys = ["id_hash", "text_hash"]
    return unpack(rows.join(kept, keys, "left_semi").dropDuplicates(keys), docs.schema)
