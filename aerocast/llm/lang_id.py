"""Language id with language-bitmask n-gram filters.

One bit-sliced Bloom filter answers for all languages at once: slot ``s`` holds
a bitmask with bit ``l`` set when some n-gram of language ``l`` hashes to
``s``. The AND of an n-gram's slots is the set of languages that contain it. Per
document the set bits are counted per language, corrected for the filter's
false positives, and the largest corrected count decides.

Fitting reads a bounded sample (``max_fit_docs`` documents of each language in
expectation, picked by a hash of the id); prediction reads every whole text.
The filter has a fixed number of slots, so what is sent to the driver and the
executors does not grow with the corpus.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunked, text_batches

UNDETERMINED = "und"
SLOT_BITS = 19
HASHES = 2
NGRAMS = (2, 3, 4)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FOLD: list[np.ndarray] = []


def _fold_table() -> np.ndarray:
    """Code point -> lower-cased letter, 0 for all that is not a letter; built once per worker."""
    if not _FOLD:
        t = np.zeros(0x110000, dtype=np.uint32)
        for cp in range(0x110000):
            ch = chr(cp)
            if ch.isalpha():
                low = ch.lower()
                t[cp] = ord(low) if len(low) == 1 else cp
        _FOLD.append(t)
    return _FOLD[0]


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts in one array, other runs as a single 0, with the text each belongs to."""
    joined = "".join(f"\n{t}\n" for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + 2 for t in texts])
    low = _fold_table()[points]
    keep = np.ones(len(low), dtype=bool)
    keep[1:] = (low[1:] != 0) | (low[:-1] != 0) | (owner[1:] != owner[:-1])
    return low[keep], owner[keep]


def _grams(low: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams inside a word (its borders included) and the text of each."""
    size = len(low) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int32)
    ok = owner[:size] == owner[n - 1:n - 1 + size]
    for i in range(1, n - 1):
        ok &= low[i:i + size] != 0
    if n == 2:
        ok &= (low[:size] != 0) & (low[1:1 + size] != 0)
    at = np.flatnonzero(ok)
    h = np.full(len(at), n, dtype=np.uint64)
    for i in range(n):
        h = h * np.uint64(0x100000001B3) + low[at + i]
    h ^= h >> np.uint64(29)
    h *= _MIX
    h ^= h >> np.uint64(32)
    return h, owner[at]


def _slots(h: np.ndarray) -> list[np.ndarray]:
    mask = np.uint64((1 << SLOT_BITS) - 1)
    return [((h >> np.uint64(i * 22)) & mask).astype(np.int64) for i in range(HASHES)]


@dataclass
class LanguageFilter:
    """Languages by name, the slot masks (one row of words per 64 languages) and the fallback language."""

    languages: list[str]
    fallback: str = UNDETERMINED
    masks: np.ndarray = field(default_factory=lambda: np.zeros((1, 1 << SLOT_BITS), np.uint64))

    def false_positives(self) -> np.ndarray:
        """Chance that an n-gram no language holds shows bit ``l``."""
        fill = [np.count_nonzero(self.masks[i // 64] >> np.uint64(i % 64) & np.uint64(1)) / self.masks.shape[1]
                for i in range(len(self.languages))]
        return np.array(fill) ** HASHES

    def predict(self, texts: list[str | None], fp: np.ndarray) -> tuple[list[str], list[float]]:
        known = [t or "" for t in texts]
        low, owner = _letters(known)
        letters = np.bincount(owner[low != 0], minlength=len(known))
        total = np.zeros(len(known))
        hits = np.zeros((len(self.languages), len(known)))
        for n in NGRAMS:
            h, doc = _grams(low, owner, n)
            total += np.bincount(doc, minlength=len(known))
            slots = _slots(h)
            for w in range(self.masks.shape[0]):
                seen = self.masks[w][slots[0]]
                for s in slots[1:]:
                    seen &= self.masks[w][s]
                for i in range(64 * w, min(64 * w + 64, len(self.languages))):
                    hits[i] += np.bincount(doc, weights=(seen >> np.uint64(i % 64)) & np.uint64(1), minlength=len(known))
        langs, scores = [], []
        true = np.maximum(0.0, (hits - total * fp[:, None]) / np.maximum(1e-9, 1 - fp[:, None])) if self.languages else hits
        for d in range(len(known)):
            if not letters[d] or not self.languages:
                langs.append(UNDETERMINED)
                scores.append(0.0)
                continue
            c = true[:, d]
            best, all_ = int(np.argmax(c)), float(c.sum())
            langs.append(self.languages[best] if all_ > 0 else self.fallback)
            scores.append(min(1.0, float(c[best]) / all_) if all_ > 0 else 0.0)
        return langs, scores


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_fit_docs: int = 3000, min_count: int = 3, keep_ratio: float = 0.5,
        min_share: float = 0.001) -> LanguageFilter:
    """Learn the filter from rows with text and language.

    An n-gram belongs to every language in which its rate is at least
    ``keep_ratio`` of its highest rate. Rows with a null text or language are
    not used; repeated rows count as often as they occur; an empty table gives
    a filter without languages, which answers ``und``. A label of fewer than ``min_share`` of the labelled rows
    is no language of its own (damaged labels): its rows teach nothing, and predictions never name it. That bounds the filter
    at ``1 / min_share`` languages, 64 kB each, whatever the label column holds.
    """
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"),
                           F.col(lang_col).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    every = sizes.agg(F.sum("n").alias("every"))
    sizes = sizes.join(F.broadcast(every)).where(F.col("n") >= F.lit(min_share) * F.col("every")).orderBy("lang").collect()  # 1 / min_share rows at most
    if not sizes:
        return LanguageFilter([])
    langs = [r["lang"] for r in sizes]
    bucket = F.pmod(F.xxhash64(F.coalesce("id", F.lit("")), F.lit("language sample")), F.lit(1 << 30))
    picked = rows.sparkSession.createDataFrame(
        [(r["lang"], i, int(min(1.0, max_fit_docs / r["n"]) * (1 << 30))) for i, r in enumerate(sizes)], "lang string, number int, share long")
    sample = rows.join(F.broadcast(picked), "lang").where(bucket < F.col("share")).select(F.col("number").alias("lang"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunked(batches, 1):
            of = b.column(0).to_numpy()
            low, owner = _letters(b.column(1).to_pylist())
            for n in NGRAMS:
                h, doc = _grams(low, owner, n)
                lang = of[doc]
                for i in np.unique(lang):
                    g, c = np.unique(h[lang == i], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(g), i, np.int32)), pa.array(np.full(len(g), n, np.int32)),
                         pa.array(g.view(np.int64)), pa.array(c.astype(np.int64))], ["lang", "n", "gram", "c"])

    counts = (text_batches(sample).mapInArrow(count, "lang int, n int, gram long, c long")
              .groupBy("lang", "n", "gram").agg(F.sum("c").alias("c")))
    totals = counts.groupBy("lang", "n").agg(F.sum("c").alias("total"))
    rate = F.col("c") / F.col("total")
    # at most one entry a language in each list
    per_gram = (counts.join(totals, ["lang", "n"]).where(F.col("c") >= min_count)
                .groupBy("gram").agg(F.collect_list(F.struct("lang", rate.alias("rate"))).alias("in"),
                                     F.max(rate).alias("top")))
    members = per_gram.select("gram", F.explode("in").alias("m"), "top") \
        .where(F.col("m.rate") >= keep_ratio * F.col("top")).select("gram", F.col("m.lang").alias("lang"))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column(0).to_numpy().view(np.uint64)
            lang = b.column(1).to_numpy()
            bits = (np.uint64(1) << (lang % 64).astype(np.uint64)).view(np.int64)
            for s in _slots(h):
                yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(lang // 64), pa.array(bits)],
                                                 ["slot", "word", "mask"])

    # at most 2^SLOT_BITS rows for every 64 languages, whatever the corpus
    filled = (members.mapInArrow(slots, "slot long, word int, mask long")
              .groupBy("slot", "word").agg(F.expr("bit_or(mask)").alias("mask")).toArrow())
    masks = np.zeros(((len(langs) + 63) // 64, 1 << SLOT_BITS), np.uint64)
    masks[filled["word"].to_numpy(), filled["slot"].to_numpy()] = filled["mask"].to_numpy().view(np.uint64)
    return LanguageFilter(langs, max(sizes, key=lambda r: (r["n"], r["lang"]))["lang"], masks)


def predict(docs: DataFrame, model: LanguageFilter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score`` for every row.

    ``lang_pred`` is ``und`` with score 0 for a null or empty text, a text
    without a letter, or a model without languages; a text none of whose n-grams
    is known gets the language with most training rows and score 0. Ties go to the
    first language by name. Repeated rows give repeated results; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        fp = m.false_positives()
        for b in chunked(batches, 1):
            langs, scores = m.predict(b.column(1).to_pylist(), fp)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             [id_col, "lang_pred", "score"])

    return text_batches(docs).select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type.simpleString()}, lang_pred string, score double")
