"""Token ids in length-delimited binary records, with an offset index.

A record file is a plain sequence of frames::

    u32 length of payload | u32 masked CRC of those 4 bytes
    payload               | u32 masked CRC of the payload | 0x0A

    payload = u8 flags (1: document id is null) | i64 document id | u8 bytes an id (2 or 4) | ids

all little-endian. The CRC is CRC-32, rotated right by 15 bits plus a constant, so that
a checksum stored inside checksummed data doesn't weaken it. Files hold
ascending document ids, and ascend from file to file. Spark's committer writes
them, so a lost executor leaves no partial file behind.

The index has a row for each record (file, byte offset, length, document id,
number of ids and of all ids before): a shuffled read takes index rows in any order
and fetches just their bytes.
"""

from __future__ import annotations

import re
import string
import struct
import zlib
from array import array
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import LATER, byte_letters
from .common import BoundedCache, chunked, stage_table

END_ID = 2
#: A file is read back as one value, so it stays far below the 2 GB of one even where most texts are very long.
RECORDS_PER_FILE = 8_192
CACHE_MAX = 600_000
#: Pieces that do not end in a letter: punctuation, numbers and white space.
MARKS_MAX = 20_000
#: One or more of these after letters are a piece of their own. Without the apostrophe, which can begin one with letters.
_MARKS = "".join(c for c in string.punctuation if c != "'")
_ID = attrgetter("id")
_MASK_DELTA = 0xA282EAD8
_HEAD = struct.Struct("<II")
_PAYLOAD = struct.Struct("<BqB")
_CRC = struct.Struct("<I")
END_MARK = b"\n"


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + _MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    """One record: lengths, checksums and the document's ids at ``width`` bytes each."""
    payload = _PAYLOAD.pack(doc_id is None, doc_id or 0, width) + ids.astype(f"<u{width}").tobytes()
    head = _CRC.pack(len(payload))
    return b"".join([head, _CRC.pack(masked_crc(head)), payload, _CRC.pack(masked_crc(payload)), END_MARK])


def records(data: bytes, start: int = 0) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """(offset, length, document id, ids) of each frame in ``data``; damage raises ``ValueError``."""
    at = start
    while at < len(data):
        size, crc = _HEAD.unpack_from(data, at)
        if masked_crc(data[at:at + 4]) != crc:
            raise ValueError(f"damaged length at byte {at}")
        payload = data[at + 8:at + 8 + size]
        end = at + 8 + size + 5
        if len(payload) != size or data[end - 1:end] != END_MARK or _CRC.unpack_from(data, end - 5)[0] != masked_crc(payload):
            raise ValueError(f"damaged record at byte {at}")
        null, doc_id, width = _PAYLOAD.unpack_from(payload)
        yield at, end - at, None if null else doc_id, np.frombuffer(payload, dtype=f"<u{width}", offset=_PAYLOAD.size)
        at = end


def _odd_line(text: str) -> bool:
    """Whether a line feed stands first, last or beside white space."""
    if "\n" in text:
        first, *rest = text.split("\n")
        if not first or first[-1].isspace() or not rest[-1] or rest[-1][0].isspace():
            return True
        for line in rest[:-1]:
            if not line or line[0].isspace() or line[-1].isspace():
                return True
    return False


class PieceEncoder:
    """The tokenizers library's ids of whole texts, with a bounded cache of pieces.

    A text is cut before each space that a non-space follows. The file's
    split pattern never crosses such a place, so the ids of the parts are those of
    the text. A text holding one of the special tokens goes to the library whole.
    """

    _CUT, _ODD = re.compile(r" (?=\S)"), re.compile(r" (?:\s|\Z)")
    # Fixed value: the split pattern of byte-level BPE files.
    _SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = str.maketrans(dict(enumerate(byte_letters())))
        self.space = byte_letters()[0x20]
        self.marks = BoundedCache(self._word, MARKS_MAX)
        self.rest = BoundedCache(self._spaced, CACHE_MAX)

    def _ids(self, shown: str) -> bytes:
        return array("I", map(_ID, self.tokenize(shown))).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of one piece of the split pattern."""
        return self._ids(word.replace(" ", self.space) if word.isascii() and word.isprintable() else
                         word.encode().decode("latin-1").translate(self.letters))

    def _spaced(self, part: str) -> bytes:
        """Ids of a part and the space before it; of a key that begins with a line feed, those of the line feed and
        the part. Letters, and letters with marks after them, need no search of the pattern.

        The pattern takes a line feed between two non-spaces as a piece of its own.
        """
        if part.isalpha():
            return self._ids(self.space + part) if part.isascii() else self._word(" " + part)
        if part[0] == "\n":
            return self.marks["\n"] + self._first(part[1:])
        letters = part.rstrip(_MARKS)
        if letters.isalpha():
            return self.rest[letters] + self.marks[part[len(letters):]]
        return self._part(" " + part)

    def _first(self, part: str) -> bytes:
        """Ids of a part without a space before it."""
        letters = part.rstrip(_MARKS)
        if not letters.isalpha():
            return self._part(part)
        return self._word(letters) + (self.marks[part[len(letters):]] if len(letters) < len(part) else b"")

    def _part(self, part: str) -> bytes:
        if part and max(part) >= LATER:
            return array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()
        return b"".join([self._word(w) if w[-1].isalpha() else self.marks[w] for w in self._SPLIT.findall(part)])

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        if any(s in text for s in self.specials):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        if self._ODD.search(text):
            first, *rest = self._CUT.split(text)
        else:  # where every line feed lies between two non-spaces, parts are cut before it as well
            first, *rest = (text if _odd_line(text) else text.replace("\n", " \n")).split(" ")
        return np.frombuffer(self._part(first) + b"".join(map(self.rest.__getitem__, rest)), dtype=np.uint32)


_LOADED: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    if path not in _LOADED:
        _LOADED[path] = PieceEncoder(path)
    return _LOADED[path]


def write_token_files(docs: DataFrame, out: str, tokenizer_path: str, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int = END_ID) -> str:
    """Encode every row, append ``end_id`` and write record files to the new folder ``out``.

    Documents go in ascending order of ``id_col``, null ids first, repeated ids by a
    hash of the text. A null or empty text is a record with the end id alone. An empty table
    writes no record. Other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(tokenizer_path)
        for b in chunked(batches, 1, 1 << 20):
            end = np.array([end_id], dtype=np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array([
                frame(d, np.concatenate([enc.encode(t), end]), enc.width)[:-1]  # the writer adds the end mark
                for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)], pa.binary())], ["frame"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    (rows.orderBy("id", F.xxhash64("text")).mapInArrow(run, "frame binary")
     .select(F.col("frame").cast("string").alias("frame"))
     .write.option("lineSep", END_MARK.decode()).option("maxRecordsPerFile", RECORDS_PER_FILE).text(out))
    return out


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, part, chunk, offset, length, doc_id, ids`` of every record, checksums verified."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, part, chunk, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                rows = []
                for r in records(data):
                    rows.append(r)
                    if len(rows) == 512:
                        yield _rows(name, part, chunk, rows)
                        rows = []
                if rows:
                    yield _rows(name, part, chunk, rows)

    return _files(spark, path).mapInArrow(
        run, "file string, part int, chunk int, offset long, length long, doc_id long, ids array<long>")


def read_records(rows: DataFrame, path: str) -> DataFrame:
    """``file, offset, doc_id, ids`` of the records that ``rows`` of the index name, in the order of ``rows`` within partitions.

    A shuffled or partial read: each task opens the files its rows name and fetches just the bytes of its records, whose
    checksums are verified. ``path`` is a folder that pyarrow can open on every executor (a shared mount, hdfs, s3, gs).
    A repeated row is read again; a row without a file, offset or length, or that is not where a record lies, raises ``ValueError``.
    No rows give an empty result. Other columns are ignored.
    """
    uri = path if "://" in path or not path.startswith("file:") else "file://" + path.removeprefix("file:")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        system, folder = fs.FileSystem.from_uri(uri)
        name, source = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                found = []
                for file, offset, length in zip(*(c.to_pylist() for c in batch.slice(at, 512).columns), strict=True):
                    if file is None or offset is None or length is None:
                        raise ValueError("an index row without file, offset or length")
                    if file != name:
                        name, source = file, system.open_input_file(f"{folder}/{file}")
                    found += [(file, offset, doc_id, ids) for _, _, doc_id, ids in _only(source.read_at(length, offset), file, offset)]
                ends = np.cumsum([0, *(len(r[3]) for r in found)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in found]), pa.array([r[1] for r in found], pa.int64()), pa.array([r[2] for r in found], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([r[3] for r in found]).astype(np.int64)))],
                    ["file", "offset", "doc_id", "ids"])

    return rows.select("file", "offset", "length").mapInArrow(run, "file string, offset long, doc_id long, ids array<long>")


def _only(data: bytes, file: str, offset: int) -> list:
    try:
        got = list(records(data))
    except (ValueError, struct.error) as e:
        raise ValueError(f"{file}: no record at byte {offset}") from e
    if len(got) != 1:
        raise ValueError(f"{file}: {len(got)} records at byte {offset}, not one")
    return got


def _rows(name, part, chunk, rows) -> pa.RecordBatch:
    n = len(rows)
    flat = np.concatenate([r[3] for r in rows]).astype(np.int64)
    ends = np.cumsum([0, *(len(r[3]) for r in rows)]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array([name] * n), pa.array([part] * n, pa.int32()), pa.array([chunk] * n, pa.int32()),
         pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
        ["file", "part", "chunk", "offset", "length", "doc_id", "ids"])


def _files(spark: SparkSession, path: str) -> DataFrame:
    name = F.element_at(F.split("path", "/"), -1)
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
            .select(name.alias("file"), F.regexp_extract(name, r"^part-(\d+)", 1).cast("int").alias("part"),
                    F.regexp_extract(name, r"-c(\d+)", 1).cast("int").alias("chunk"), "content"))


def build_index(spark: SparkSession, path: str) -> DataFrame:
    """The offset index of the record files in ``path``, written as a table and returned.

    Columns: file, offset, length, doc_id, n_ids, ids_before (all ids of earlier
    documents), ids_crc32 (of the ids as little-endian 32-bit integers). Every checksum is verified.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, part, chunk, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                rows, before = [], 0
                for offset, length, doc_id, ids in records(data):
                    rows.append((name, part, chunk, offset, length, doc_id, len(ids), before, zlib.crc32(ids.astype("<u4").tobytes())))
                    before += len(ids)
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(cols, [pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 6], strict=True)],
                        ["file", "part", "chunk", "offset", "length", "doc_id", "n_ids", "in_file", "ids_crc32"])

    raw = stage_table(_files(spark, path).mapInArrow(
        run, "file string, part int, chunk int, offset long, length long, doc_id long, n_ids long, in_file long, ids_crc32 long"),
        "token-index")
    # one row a file: the running total over files is small whatever the corpus
    files = raw.groupBy("file", "part", "chunk").agg(F.sum("n_ids").alias("total"))
    before = F.sum("total").over(Window.orderBy("part", "chunk").rowsBetween(Window.unboundedPreceding, -1))
    starts = files.select("file", F.coalesce(before, F.lit(0)).alias("file_start"))
    return raw.join(starts, "file").select(
        "file", "offset", "length", "doc_id", "n_ids", (F.col("file_start") + F.col("in_file")).alias("ids_before"), "ids_crc32")
