"""Phrase collocations, counted in HAT-tries.

Words are 64-bit ids, hashed from language and word; a dictionary table proves that no two words share an
id (else the next seed is taken), so counts are exact. Each task counts its n-grams in a HAT-trie: hash
containers of at most ``BURST`` keys under a shallow trie of word ids. A full container bursts into one container for
each next byte of the ids. When a trie holds ``MOST_ENTRIES`` n-grams, its largest subtrees leave it as sorted
runs until half is free. Runs are dealt out by their first two words and merged per prefix.

Lengths are counted one after the other. An n-gram that reaches ``min_count`` has only parts that reach it too, so
an occurrence is skipped where a bitmap of fixed size (``FILTER_BITS``) shows that its first or last n-1 words don't.
The bitmap never misses a frequent part; other n-grams that pass are counted like all and dropped by their exact count.
When the corpus outgrows the bitmap it lets more through; results stay the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunked, stage_table

#: Keys of a container before it bursts, and n-grams of a task's trie before subtrees are spilled.
BURST, MOST_ENTRIES = 8192, 250_000
FILTER_BITS = 26
#: Words that are counted at once, and longest word (in bytes) that is hashed with the rest of its batch.
SLICE, LONG_WORD = 1 << 19, 64
#: Parts of a language that are ranked on their own before the language is.
RANK_PARTS = 64
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, dtype=np.uint8)  # 0 word, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
_VALUE = np.where(_KIND == 0, np.arange(1, 257), 0).astype(np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """r^0 .. r^n and r^0 .. r^-n modulo 2^64, for an odd r from the seed."""
    if seed not in _POWERS or len(_POWERS[seed][0]) <= n:
        r = xxhash.xxh64_intdigest(b"phrase", seed) | 5
        found = []
        for x in (r, pow(r, -1, 1 << 64)):
            x = np.full(max(n + 1, 1 << 20), x, dtype=np.uint64)
            x[0] = 1
            found.append(np.cumprod(x))
        _POWERS[seed] = tuple(found)
    return _POWERS[seed]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def tokens(texts: pa.Array, langs: pa.Array, seed: int = 0):
    """(ids, pieces, bytes, starts, ends, rows): every word's id, the number of its piece, its place and its row.

    The texts are taken as one buffer; A-Z becomes lower case.
    """
    texts, langs = texts.fill_null(""), langs.fill_null(UNKNOWN)
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    b = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    offsets -= offsets[0]
    if not len(b):
        return np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 5
    b = _LOWER[b]
    kind = _KIND[b]
    word = kind == 0
    edge = np.zeros(len(b) + 1, dtype=bool)
    edge[offsets] = True
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1] | edge[1:-1]
    ends[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    pieces = np.searchsorted(np.flatnonzero(kind == 2), starts) + rows
    power, inverse = _powers(seed, len(b))
    h = np.add.reduceat(_VALUE[b] * power[:len(b)], starts) * inverse[starts] if len(starts) else np.empty(0, np.uint64)
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        h[i] = xxhash.xxh64_intdigest(b[starts[i]:ends[i]].tobytes(), seed)
    names = langs.dictionary_encode()
    of_lang = np.array([xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"), seed) for x in names.dictionary.to_pylist()], dtype=np.uint64)
    return _mixed(h * _MIX ^ of_lang[names.indices.to_numpy(zero_copy_only=False)][rows]), pieces, b, starts, ends, rows


def gram_keys(ids: np.ndarray, length: int) -> np.ndarray:
    """One 64-bit key for each run of ``length`` neighbouring ids, for the bitmap only."""
    n = max(0, len(ids) - length + 1)
    key = ids[:n]
    for j in range(1, length):
        key = _mixed(key * _MIX + ids[j:j + n])
    return key


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys >> np.uint64(64 - bits)


class Trie:
    """Counts of n-grams (``width`` ids of 8 bytes) in hash containers under a trie over the ids' bytes.

    A container holds whole n-grams; what bursts is its range, into one container for each next byte.
    """

    class Part:
        __slots__ = ("children", "counts")

        def __init__(self):
            self.children, self.counts = None, {}

    def __init__(self, width: int, burst: int = BURST):
        self.width, self.burst, self.root, self.size = 8 * width, burst, Trie.Part(), 0

    def add(self, grams: list[bytes], counts: list[int]) -> None:
        burst, size = self.burst, self.size
        for gram, n in zip(grams, counts, strict=True):
            part, at = self.root, 0
            while part.children is not None:
                part = part.children[gram[at]]
                at += 1
            held = part.counts
            if gram in held:
                held[gram] += n
            else:
                held[gram] = n
                size += 1
                if len(held) > burst and at < self.width:
                    part.children, part.counts = [Trie.Part() for _ in range(256)], {}
                    for key, k in held.items():
                        part.children[key[at]].counts[key] = k
        self.size = size

    def _parts(self, part: Part) -> Iterator[Part]:
        """The containers of a subtree in order."""
        if part.children is None:
            yield part
        else:
            for child in part.children:
                yield from self._parts(child)

    def _run(self, parts: list[Part]) -> tuple[list[bytes], list[int]]:
        grams, counts = [], []
        for part in parts:
            for leaf in self._parts(part):
                keys = sorted(leaf.counts)
                grams += keys
                counts += map(leaf.counts.__getitem__, keys)
        return grams, counts

    def spill(self, leave: int = 0) -> tuple[list[bytes], list[int]]:
        """The largest subtrees, taken out until ``leave`` n-grams at most are left, as one sorted run."""
        if self.root.children is None or not leave:
            run, self.root, self.size = self._run([self.root]), Trie.Part(), 0
            return run
        children = self.root.children
        sizes = sorted(((sum(len(x.counts) for x in self._parts(p)), i) for i, p in enumerate(children)), reverse=True)
        gone = []
        for n, i in sizes:
            if self.size <= leave:
                break
            gone.append(i)
            self.size -= n
        run = self._run([children[i] for i in sorted(gone)])
        for i in gone:
            children[i] = Trie.Part()
        return run


def _columns(grams: list[bytes], counts: list[int], width: int) -> list[pa.Array]:
    ids = np.frombuffer(b"".join(grams), dtype=">u8").reshape(-1, width)
    return [*[pa.array(ids[:, j].astype(np.uint64).view(np.int64)) for j in range(width)], pa.array(counts, pa.int64())]


def _distinct(sel: np.ndarray, ids: np.ndarray, width: int) -> tuple[list[bytes], np.ndarray, list[int]]:
    """N-grams that start at the places ``sel``: (their ids as bytes, a place of each, counts).

    Sorted by a hash; neighbours count as one if all their ids agree, so should two n-grams share a hash, one may come twice.
    """
    at = sel[np.argsort(gram_keys(ids, width)[sel])]
    rows = np.stack([ids[at + j] for j in range(width)], axis=1)
    first = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1))) if len(at) else at
    grams = rows[first].astype(">u8").tobytes()
    step = 8 * width
    return [grams[i:i + step] for i in range(0, len(grams), step)], at[first], np.diff(np.append(first, len(at))).tolist()


def count_words(docs: DataFrame, seed: int) -> DataFrame:
    """``w1, lang, word, n``: runs of word counts of the columns ``text, lang``, one or more rows a word."""
    most, step = MOST_ENTRIES, SLICE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, names = Trie(1), {}

        def out():
            grams, counts = trie.spill()
            named = [names[g] for g in grams]
            names.clear()
            ids, n = _columns(grams, counts, 1)
            yield pa.RecordBatch.from_arrays([ids, pa.array([x for x, _ in named], pa.string()),
                                              pa.array([w.decode("utf-8", "surrogatepass") for _, w in named], pa.string()), n],
                                             ["w1", "lang", "word", "n"])

        for batch in chunked(batches, 0):
            langs = [UNKNOWN if x is None else x for x in batch.column(1).to_pylist()]
            ids, _, b, starts, ends, rows = tokens(batch.column(0), batch.column(1), seed)
            for at in range(0, len(ids), step):
                part = ids[at:at + step]
                grams, first, n = _distinct(np.arange(len(part)), part, 1)
                trie.add(grams, n)
                first += at
                for gram, row, i, j in zip(grams, rows[first].tolist(), starts[first].tolist(), ends[first].tolist(), strict=True):
                    if gram not in names:
                        names[gram] = langs[row], b[i:j].tobytes()
                if trie.size >= most:
                    yield from out()
        if trie.size:
            yield from out()

    return docs.mapInArrow(run, "w1 long, lang string, word string, n long")


def count_grams(docs: DataFrame, length: int, seed: int, bitmap) -> DataFrame:
    """``w1 .. w<length>, n``: runs of n-gram counts; ``bitmap`` (a broadcast) knows the frequent n-grams of one word less."""
    names = [f"w{j + 1}" for j in range(length)]
    burst, most, step, filter_bits = BURST, MOST_ENTRIES, SLICE, FILTER_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, bits = Trie(length, burst), np.frombuffer(bitmap.value, dtype=np.uint8)

        def fine(keys):
            slot = _slot(keys, filter_bits)
            return (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

        for batch in chunked(batches, 0):
            ids, pieces, *_ = tokens(batch.column(0), batch.column(1), seed)
            for at in range(0, len(ids), step):
                part, piece = ids[at:at + step + length - 1], pieces[at:at + step + length - 1]
                if len(part) < length:
                    continue
                parts = fine(gram_keys(part, length - 1))
                ok = (piece[:len(part) - length + 1] == piece[length - 1:]) & parts[:-1] & parts[1:]
                grams, _, n = _distinct(np.flatnonzero(ok), part, length)
                trie.add(grams, n)
                if trie.size >= most:
                    yield pa.RecordBatch.from_arrays(_columns(*trie.spill(most // 2), length), [*names, "n"])
        if trie.size:
            yield pa.RecordBatch.from_arrays(_columns(*trie.spill(), length), [*names, "n"])

    return docs.mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "n"]))


def _bitmap(frequent: DataFrame, length: int):
    """Broadcast bitmap of 2^FILTER_BITS bits of the n-grams in ``frequent``; its parts are or-ed in Spark."""
    filter_bits = FILTER_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(1 << filter_bits - 6, dtype=np.uint64)
        for b in batches:
            key = b.column(0).to_numpy().view(np.uint64)
            for j in range(1, length):
                key = _mixed(key * _MIX + b.column(j).to_numpy().view(np.uint64))
            slot = _slot(key, filter_bits)
            np.bitwise_or.at(words, (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63)))
        used = np.flatnonzero(words)
        for at in range(0, len(used), 100_000):
            some = used[at:at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(words[some].view(np.int64))], ["slot", "bits"])

    found = frequent.select(*[f"w{j + 1}" for j in range(length)]).mapInArrow(run, "slot long, bits long") \
        .groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()  # 2^(FILTER_BITS - 6) rows at most
    words = np.zeros(1 << filter_bits - 6, dtype="<u8")
    words[found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return frequent.sparkSession.sparkContext.broadcast(words.tobytes())


def word_table(docs: DataFrame) -> tuple[DataFrame, int]:
    """(``w1, lang, word, n``: every word once with its exact count, the seed of the ids)."""
    for seed in count():
        words = count_words(docs, seed).groupBy("w1").agg(
            F.sum("n").alias("n"), F.min(F.struct("lang", "word")).alias("name"), F.max(F.struct("lang", "word")).alias("other"))
        words = stage_table(words.select("w1", "name.lang", "name.word", "n", (F.col("name") != F.col("other")).alias("clash")), "phrase-words")
        if words.where("clash").isEmpty():
            return words.drop("clash"), seed


def frequent_grams(docs: DataFrame, words: DataFrame, seed: int, longest: int, min_count: int) -> dict[int, DataFrame]:
    """Stored tables ``w1 .. wk, n`` of all n-grams of 1 to ``longest`` words that occur ``min_count`` times or more."""
    found = {1: words.where(F.col("n") >= min_count).select("w1", "n")}
    for k in range(2, longest + 1):
        names = [f"w{j + 1}" for j in range(k)]
        runs = count_grams(docs, k, seed, _bitmap(found[k - 1], k - 1)).repartition("w1", "w2")
        merged = runs.groupBy(*names).agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
        found[k] = stage_table(merged, f"phrase-{k}")
    return found


def _parts(found: dict[int, DataFrame], k: int, after: int, cand: DataFrame) -> DataFrame:
    """``cand`` with ``l`` and ``r``, the counts of the parts of its k words cut after ``after``."""
    for name, first, size in (("l", 1, after), ("r", after + 1, k - after)):
        part = found[size].select(*[F.col(f"w{j + 1}").alias(f"w{first + j}") for j in range(size)], F.col("n").alias(f"{name}{after}"))
        cand = cand.join(part, [f"w{first + j}" for j in range(size)])
    return cand


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 3, min_count: int = 10,
                 contained_percent: int = 50, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of every language (null: ``und``).

    A phrase of 2 to ``longest`` words within a piece of text counts from ``min_count`` occurrences on. Its score is
    ``floor(10^6 a^2 / (l r))`` of its weakest cut; a phrase contained in a longer one with ``contained_percent`` of its count or
    more goes. Ties rank by ``a``, then by the phrase's bytes; ``top`` is the length of the report. Arithmetic is in
    integers of 38 digits, enough up to ``a`` of 10^16.

    A null or empty text has no words; repeated rows count repeatedly; other columns are ignored; an empty table, or one without
    frequent phrases, gives an empty result. A text of any length is counted in slices.
    """
    docs = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    words, seed = word_table(docs)
    found = frequent_grams(docs, words, seed, longest, min_count)
    names = words.where(F.col("n") >= min_count).select("w1", "lang", "word")
    scored = []
    for k in range(2, longest + 1):
        ids = [f"w{j + 1}" for j in range(k)]
        cand = found[k].withColumnRenamed("n", "a")
        for size in range(k + 1, longest + 1):  # longer phrases that contain this one
            longer = reduce(DataFrame.unionByName, [
                found[size].select(*[F.col(f"w{s + j + 1}").alias(ids[j]) for j in range(k)], "n") for s in range(size - k + 1)])
            longer = longer.groupBy(*ids).agg(F.max("n").alias("longer"))
            cand = cand.join(longer, ids, "left").where(
                F.coalesce(F.lit(100) * F.col("longer") < F.lit(contained_percent) * F.col("a"), F.lit(True))).drop("longer")
        for after in range(1, k):
            cand = _parts(found, k, after, cand)
        cuts = [F.struct(F.expr(f"(cast(1000000 as decimal(7,0)) * cast(a as decimal(16,0)) * cast(a as decimal(16,0))) div "
                                f"(cast(l{after} as decimal(19,0)) * cast(r{after} as decimal(19,0)))").alias("score"),
                         F.lit(after).alias("after"), F.col(f"l{after}").alias("l"), F.col(f"r{after}").alias("r")) for after in range(1, k)]
        scored.append((k, ids, cand.select(*ids, "a", (F.least(*cuts) if k > 2 else cuts[0]).alias("cut"))))
    phrases = []
    for k, ids, cand in scored:
        for c in ids:
            cand = cand.join(names.select(F.col("w1").alias(c), F.col("word").alias(f"{c}_word"), *([F.col("lang")] if c == "w1" else [])), c)
        phrases.append(cand.select("lang", F.concat_ws(" ", *[f"{c}_word" for c in ids]).alias("phrase"), "a", "cut.l", "cut.r", "cut.score"))
    every = reduce(DataFrame.unionByName, phrases)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    # a language's candidates are first cut to the best of each part, so that one task ranks RANK_PARTS * top rows at most
    first = every.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    best = first.where(F.col("place") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))) \
        .where(F.col("rank") <= top)
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
