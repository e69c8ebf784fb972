"""Token ids as binary files of directly addressable codes.

An id is split into chunks of ``CHUNK_BITS`` bits, least first.  Level k holds
the k-th chunks of all ids that have one, in order, and a bitmap that says
whether an id goes on in level k + 1.  The place of an id in the next level is
the number of set bits before it, which a rank directory (a count per
``RANK_BITS`` bits) gives with one look-up and a popcount of at most
``RANK_BITS`` bits.  So any token is read with a few bytes per level, wherever
it is: no block is decoded for it.

A file (``TokenFile``; all numbers little-endian):

    magic, range, part, documents, tokens, levels, ids in each of 4 levels   80 bytes
    document ids                                       8 bytes each
    which documents have an id                         1 bit each
    first token of every document, and the end         8 bytes each
    for each level: chunks                             1 byte each
        and but for the last: bitmap, rank directory   1 bit each; 4 bytes each
    crc32 of all this, a line feed                     5 bytes

* Encoding.  A task encodes the distinct units of a block of texts (words and
  pieces of words that the vocabulary's splitter never joins, see
  ``unit_spans``) with the ``tokenizers`` library, keeps the results, and puts
  the texts together from them: the ids of the whole texts, as the tests
  compare.  Strings of special tokens are ordinary text.  The cuts fit
  vocabularies like the query's; ``whole_texts=True`` encodes texts as they are.
* Order.  Rows are range-sorted by document id (equal ids by the hash of their
  texts, equal rows by the input partition, so that copies spread); a task
  closes a file at ``FILE_TOKENS`` tokens, so memory is bounded.
* Writing and reading go through Spark's file sinks and sources: a lost task's
  files are not committed, and any file system works that Spark reaches.  The
  sink ends a file with the line feed that the format asks for.
* Where a document starts among all tokens: its place in its file plus the
  tokens of the files before, a sum over one row per file.

Cases: null and empty texts have the end token alone; rows without an id come
first; equal ids stand next to each other, every row for itself; an empty
table gives no files that hold anything and an empty result; other columns are
not looked at; ids up to 2^32 - 1 fit.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sortproof._pickling import ship_by_value
from sortproof.llm.utf8 import blocks, flat
from sortproof.session import scratch_path, write_and_read

MAGIC = b"DACTOK01"
CHUNK_BITS = 8
RANK_BITS = 512
#: Tokens of a file, about: a task holds so many at once.
FILE_TOKENS = 1 << 23
#: The end token that the query's documents get.
END_ID = 2
#: Words and ids that a task keeps encoded.
KEPT_WORDS, KEPT_IDS = 1_000_000, 8_000_000

_HEADER = "<8s9Q"
_HEADER_BYTES = struct.calcsize(_HEADER)
_LEVELS = 32 // CHUNK_BITS
# Blank and line feed, which part units here (all white space parts tokens); the end mark of a word's last token.
_APART = np.zeros(256, bool)
_APART[[0x20, 0x0A]] = True
_WORD_END = "</w>"
#: Plain words encoded in one call.
_AT_ONCE = 128
# Kinds of bytes, and between which of them a unit ends.
_OTHER, _LETTER, _DIGIT, _APOSTROPHE, _BEYOND = range(5)
_KIND = np.zeros(256, np.uint8)
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x27] = _APOSTROPHE
_KIND[0x80:] = _BEYOND
_CUT = np.zeros((5, 5), bool)
_CUT[_DIGIT, :4] = _CUT[:4, _DIGIT] = True
_CUT[_LETTER, [_OTHER, _APOSTROPHE]] = True
_CUT[_OTHER, _LETTER] = True


# -- codes ---------------------------------------------------------------------

Level = tuple[np.ndarray, np.ndarray | None, np.ndarray | None]


def split_levels(ids: np.ndarray) -> list[Level]:
    """(chunks, bitmap, rank directory) of each level; the last has chunks only."""
    rest, out = ids.astype(np.uint32), []
    while True:
        chunks = (rest & np.uint32((1 << CHUNK_BITS) - 1)).astype(np.uint8)
        rest = rest >> np.uint32(CHUNK_BITS)
        more = rest > 0
        if not more.any():
            return [*out, (chunks, None, None)]
        bitmap = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-len(more) // RANK_BITS) * RANK_BITS, np.uint32)
        padded[: len(more)] = more
        per = padded.reshape(-1, RANK_BITS).sum(1, dtype=np.uint64)
        out.append((chunks, bitmap, np.append(0, np.cumsum(per)).astype("<u4")))
        rest = rest[more]


class TokenFile:
    """Random access to a file's tokens and documents; ``fetch(offset, size)`` gives bytes of it."""

    def __init__(self, fetch: Callable[[int, int], bytes]) -> None:
        self._fetch = fetch
        magic, self.range, self.part, self.documents, self.tokens, self.levels, *self.sizes = struct.unpack(
            _HEADER, fetch(0, _HEADER_BYTES)
        )
        if magic != MAGIC:
            raise ValueError("not a file of token codes")
        at = _HEADER_BYTES
        self._ids, self._has = at, at + 8 * self.documents
        self._starts = self._has + -(-self.documents // 8)
        at = self._starts + 8 * (self.documents + 1)
        self._at = []
        for k in range(self.levels):
            n = self.sizes[k]
            bitmap = at + n
            ranks = bitmap + -(-n // 8)
            self._at.append((at, bitmap, ranks))
            at = bitmap if k + 1 == self.levels else ranks + 4 * (-(-n // RANK_BITS) + 1)
        self.end = at

    @classmethod
    def of(cls, content: bytes) -> TokenFile:
        """From a whole file in memory, its checksum tested."""
        own = cls(lambda at, size: content[at : at + size])
        if len(content) != own.end + 5 or zlib.crc32(content[: own.end]) != struct.unpack("<I", content[own.end : own.end + 4])[0]:
            raise ValueError("a file of token codes is damaged")
        return own

    @classmethod
    def open(cls, path: str) -> TokenFile:
        """From a path, of which only the bytes asked for are read."""
        file = open(path, "rb")  # noqa: SIM115 - as long as the object lives

        def fetch(at: int, size: int) -> bytes:
            file.seek(at)
            return file.read(size)

        return cls(fetch)

    def _array(self, at: int, kind: str, n: int) -> np.ndarray:
        return np.frombuffer(self._fetch(at, np.dtype(kind).itemsize * n), kind)

    def _rank(self, level: int, i: int) -> int:
        """Ids before the i-th of a level that go on in the next."""
        _, bitmap, ranks = self._at[level]
        block = i // RANK_BITS
        bits = self._fetch(bitmap + block * RANK_BITS // 8, -(-i // 8) - block * RANK_BITS // 8)
        whole = int.from_bytes(bits, "little") & ((1 << (i - block * RANK_BITS)) - 1)
        return int(self._array(ranks + 4 * block, "<u4", 1)[0]) + whole.bit_count()

    def token(self, i: int) -> int:
        """The i-th token of the file."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        value = 0
        for level in range(self.levels):
            chunks, bitmap, _ = self._at[level]
            value |= self._fetch(chunks + i, 1)[0] << (CHUNK_BITS * level)
            if level + 1 == self.levels or not self._fetch(bitmap + i // 8, 1)[0] >> (i % 8) & 1:
                break
            i = self._rank(level, i)
        return value

    def read(self, begin: int, end: int) -> np.ndarray:
        """Tokens ``begin`` to ``end`` as uint32; one rank per level, then in order."""
        if not 0 <= begin <= end <= self.tokens:
            raise IndexError((begin, end))
        out, where = np.zeros(end - begin, np.uint32), None
        for level in range(self.levels):
            chunks, bitmap, _ = self._at[level]
            part = self._array(chunks + begin, "u1", end - begin).astype(np.uint32) << np.uint32(CHUNK_BITS * level)
            if where is None:
                out |= part
            else:
                out[where] |= part
            if level + 1 == self.levels or begin == end:
                break
            low = begin // 8
            bits = np.unpackbits(self._array(bitmap + low, "u1", -(-end // 8) - low), bitorder="little")
            goes = np.flatnonzero(bits[begin - 8 * low : end - 8 * low])
            where = goes if where is None else where[goes]
            begin = self._rank(level, begin)
            end = begin + len(goes)
        return out

    def starts(self) -> np.ndarray:
        """First token of every document, and the number of tokens."""
        return self._array(self._starts, "<u8", self.documents + 1).astype(np.int64)

    def document(self, i: int) -> np.ndarray:
        """Tokens of the i-th document."""
        begin, end = self._array(self._starts + 8 * i, "<u8", 2).tolist()
        return self.read(begin, end)

    def document_ids(self) -> pa.Array:
        has = np.unpackbits(self._array(self._has, "u1", -(-self.documents // 8)), bitorder="little")[: self.documents]
        return pa.array(self._array(self._ids, "<i8", self.documents), mask=has == 0)


def file_bytes(range_: int, part: int, doc_ids: pa.Array, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """A whole file but for the line feed at its end."""
    levels = split_levels(ids)
    sizes = [len(c) for c, _, _ in levels] + [0] * (_LEVELS - len(levels))
    out = [
        struct.pack(_HEADER, MAGIC, range_, part, len(doc_ids), len(ids), len(levels), *sizes),
        np.asarray(doc_ids.fill_null(0), "<i8").tobytes(), np.packbits(np.asarray(doc_ids.is_valid()), bitorder="little").tobytes(),
        np.append(0, np.cumsum(counts)).astype("<u8").tobytes(),
    ]
    for chunks, bitmap, ranks in levels:
        out += [chunks.tobytes()] + ([] if bitmap is None else [bitmap.tobytes(), ranks.tobytes()])
    body = b"".join(out)
    return body + struct.pack("<I", zlib.crc32(body))


# -- encoding ------------------------------------------------------------------

def unit_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all units, where each begins in them, index of each text's first unit).

    A unit is a piece of text whose ids don't depend on what stands next to it
    under a vocabulary that lower-cases, takes runs of letters, single digits,
    runs of other characters, and ``'s 't 're 've 'm 'll 'd``.  Texts are cut
    at blanks and line feeds, around ASCII digits, after ASCII letters before
    any other ASCII character, and before ASCII letters after any but an
    apostrophe; never next to a character beyond ASCII, which may be a letter,
    a digit, a mark or none.  A-Z is lower-cased unless such a character follows.
    """
    n = len(data)
    inside = ~_APART[data]
    kind = _KIND[data]
    begin = inside.copy()
    if n:
        low, high = kind[:-1], kind[1:]
        joined = inside[:-1] & ~_CUT[low, high]
        joined[offsets[(offsets > 0) & (offsets < n)] - 1] = False
        begin[1:] &= ~joined
    follows = np.append(data[1:], 0)
    upper = (data >= 0x41) & (data <= 0x5A) & (follows < 0x80)
    letters = np.where(upper, data | 0x20, data)[inside]
    starts = np.flatnonzero(begin)
    at = np.append(np.cumsum(inside)[starts] - 1, len(letters)).astype(np.int64)
    return letters, at, np.searchsorted(starts, offsets)


class WordEncoder:
    """Ids of whole texts by the ``tokenizers`` library, through their distinct units."""

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        tokens = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(tokens.values()) + 1, bool)
        self.closes[[i for t, i in tokens.items() if t.endswith(_WORD_END)]] = True
        self._forget()

    @classmethod
    def shared(cls, vocabulary: str) -> WordEncoder:
        """The worker process's own: the tasks that it runs one after the other share what is encoded."""
        import tokenizers

        kept = vars(tokenizers).setdefault("_kept_word_encoders", {})
        if vocabulary not in kept:
            kept[vocabulary] = cls(vocabulary)
        return kept[vocabulary]

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.begin, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, words: list[bytes]) -> None:
        """Encode new units; plain words many at a time, as each is one run of letters with one closing token."""
        plain = [w for w in words if w.isalpha()]
        odd = [w for w in words if not w.isalpha()]
        ids, sizes = [], []
        for i in range(0, len(plain), _AT_ONCE):
            some = plain[i : i + _AT_ONCE]
            (own,) = self._encoded([b" ".join(some).decode()])
            ends = np.flatnonzero(self.closes[own]) + 1
            if len(ends) != len(some):  # not such a vocabulary
                parts = self._encoded([w.decode() for w in some])
                own, ends = np.concatenate(parts), np.cumsum([len(x) for x in parts])
            ids.append(own)
            sizes.append(np.diff(ends, prepend=0))
        for i in range(0, len(odd), 1024):
            parts = self._encoded([w.decode() for w in odd[i : i + 1024]])
            ids += parts
            sizes.append(np.array([len(x) for x in parts]))
        at = len(self.known)
        self.known.update(zip([*plain, *odd], range(at, at + len(words)), strict=True))
        self.begin = np.append(self.begin, self.begin[-1] + np.cumsum(np.concatenate(sizes)))
        self.ids = np.concatenate([self.ids, *ids])

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        """Number of each unit among those kept; new ones are encoded."""
        if len(self.known) > KEPT_WORDS or len(self.ids) > KEPT_IDS:
            self._forget()
        new = [w for w in words if w not in self.known]
        if new:
            self._add(new)
        return np.array(list(map(self.known.__getitem__, words)), np.int64)

    def whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same by encoding every text as it is, for any vocabulary."""
        parts = self._encoded([t or "" for t in texts.to_pylist()])
        return np.concatenate([np.zeros(0, np.uint32), *parts]), np.array([len(x) for x in parts], np.int64)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, how many each has)."""
        letters, at, first = unit_spans(*flat(texts))
        column = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(letters)])
        coded = column.dictionary_encode()
        number = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        begin, size = self.begin[number], np.diff(self.begin)[number]
        upto = np.append(0, np.cumsum(size))
        where = np.arange(upto[-1]) + np.repeat(begin - upto[:-1], size)
        return self.ids[where], np.diff(upto[first])


def _with_ends(ids: np.ndarray, counts: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    if end_id is None:
        return ids, counts
    out = np.empty(len(ids) + len(counts), np.uint32)
    last = np.cumsum(counts + 1) - 1
    rest = np.ones(len(out), bool)
    rest[last] = False
    out[last], out[rest] = end_id, ids
    return out, counts + 1


def _files(rows: DataFrame, vocabulary: str, end_id: int | None, file_tokens: int, whole_texts: bool) -> DataFrame:
    """``file``: the files of each range of ``_id, _text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        names, counts, ids, held, part = [], [], [], 0, 0
        range_ = TaskContext.get().partitionId()

        def file() -> pa.RecordBatch:
            whole = file_bytes(range_, part, pa.concat_arrays(names), np.concatenate(counts), np.concatenate(ids))
            return pa.RecordBatch.from_arrays([pa.array([whole], pa.binary())], ["file"])

        for batch in batches:
            for block in blocks(batch, "_text"):
                encoder = encoder or WordEncoder.shared(vocabulary)
                encode = encoder.whole if whole_texts else encoder
                own, n = _with_ends(*encode(block.column("_text")), end_id)
                names.append(block.column("_id"))
                counts.append(n)
                ids.append(own)
                held += len(own)
                if held >= file_tokens:
                    yield file()
                    names, counts, ids, held, part = [], [], [], 0, part + 1
        if names:
            yield file()

    return rows.select("_id", "_text").mapInArrow(run, "file binary")


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, end_id: int | None = END_ID, file_tokens: int = FILE_TOKENS,
    whole_texts: bool = False,
) -> None:
    """Encode all texts and write them as files under ``path``, in ascending order of ``doc_id``."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.col("text"), F.lit("")).alias("_text"),
        F.xxhash64("text").alias("_t"), F.spark_partition_id().alias("_copy"),
    )
    keys = ["_id", "_t", "_copy"]
    files = _files(rows.repartitionByRange(*keys).sortWithinPartitions(*keys), vocabulary, end_id, file_tokens, whole_texts)
    # a file per row: the sink writes the bytes as they are, then a line feed
    writer = files.select(F.col("file").cast("string")).write.mode("overwrite")
    writer.option("maxRecordsPerFile", 1).option("compression", "none").option("lineSep", "\n").text(path)


# -- reading -------------------------------------------------------------------

def file_documents(spark: SparkSession, path: str) -> DataFrame:
    """``range, part, place, doc_id, first, ids`` of every document; ids as little-endian uint32, ``first`` in its file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                whole = content.as_py()
                if not whole:  # the sink's file for a table without rows
                    continue
                file = TokenFile.of(whole)
                starts, doc_ids = file.starts(), file.document_ids()
                at = 0
                while at < file.documents:  # about a million tokens a batch
                    to = max(at + 1, int(np.searchsorted(starts, starts[at] + (1 << 20), "right")) - 1)
                    n = to - at
                    raw = file.read(int(starts[at]), int(starts[to])).astype("<u4").tobytes()
                    bounds = (4 * (starts[at : to + 1] - starts[at])).astype(np.int32)
                    ids = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(bounds), pa.py_buffer(raw)])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, file.range)), pa.array(np.full(n, file.part)), pa.array(np.arange(at, to)),
                            doc_ids[at:to], pa.array(starts[at:to]), ids,
                        ],
                        ["range", "part", "place", "doc_id", "first", "ids"],
                    )
                    at = to

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "range long, part long, place long, doc_id long, first long, ids binary")


def with_starts(documents: DataFrame) -> DataFrame:
    """``start``, the tokens of all documents before, for rows with ``range, part, first, n_tokens``."""
    sizes = documents.groupBy("range", "part").agg(F.sum("n_tokens").alias("n"))
    before = Window.unboundedPreceding, -1
    inside = F.sum("n").over(Window.partitionBy("range").orderBy("part").rowsBetween(*before))
    ranges = sizes.groupBy("range").agg(F.sum("n").alias("n"))  # a row per range
    base = ranges.select("range", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(*before)), F.lit(0)).alias("base"))
    files = sizes.withColumn("inside", F.coalesce(inside, F.lit(0))).join(base, "range")
    starts = files.select("range", "part", (F.col("inside") + F.col("base")).alias("base"))
    return documents.join(starts, ["range", "part"]).withColumn("start", F.col("base") + F.col("first")).drop("base")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files under ``path``."""
    found = file_documents(spark, path).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))
    return with_starts(found).select("doc_id", "start", "n_tokens", "ids")


def token_files_digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write all documents, read the files back: where each document starts, its tokens and their checksum."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write_token_files(docs, path, vocabulary)
    found = file_documents(spark, path).select(
        "range", "part", "first", "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
    found = write_and_read(found, scratch_path(spark, "token-documents"))  # the files are read once
    return with_starts(found).select("doc_id", "start", "n_tokens", "ids_crc32")


ship_by_value(__name__)
