"""Token ids as Parquet list columns, in document order, for selective reads.

Rows are ranged and sorted by document before they are encoded, so each file holds a run of
documents and, next to the ids, each row's place in its file. Ids are dictionary-encoded; small
row groups and pages with column indexes let a reader skip to a document or read the metadata
columns alone.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from wirelake.llm import blocks, common
from wirelake.session import run_folder

END_ID = 1
#: Parquet settings of the token files: row groups, rows between page starts, encodings.
LAYOUT = {
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(1 << 18),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.writer.version": "PARQUET_2_0",  # columns without a dictionary are delta-encoded
    "compression": "zstd",
}
#: Words whose ids a worker remembers before it starts anew; longer ones are not kept.
REMEMBERED, REMEMBERED_BYTES = 1_000_000, 64
_PLAIN = re.compile("[!-~\xa1-\u024f]*").fullmatch


class Remembered(dict):
    """Ids that are worked out when first asked for, and forgotten all at once when they are too many."""

    def __init__(self, learn: Callable, most: int):
        super().__init__()
        self.learn, self.most = learn, most

    def __missing__(self, key):
        ids = self.learn(key)
        if len(key) <= REMEMBERED_BYTES:
            if len(self) >= self.most:
                self.clear()
            self[key] = ids
        return ids


class Words:
    """Encodes texts with a library's model, each word (by white space) and each piece of it once.

    The tokenizer has to drop white space and treat what it separates independently. For ``encode``
    strings of added tokens are ordinary text; ``encode_added`` gives their ids, as the library does
    unless it is told to encode special tokens.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        self.normal, self.pieces, self.model = own.normalizer, own.pre_tokenizer, own.model
        added = own.get_added_tokens_decoder()
        self.added = {t.content.encode(): np.array([i], "<i4").tobytes() for i, t in added.items() if t.content}
        longest = sorted(self.added, key=len, reverse=True)
        self.split = re.compile(b"(" + b"|".join(map(re.escape, longest)) + b")").split
        # tokens that match otherwise than as they are written are left to the library
        odd = any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in added.values())
        self.library = own if odd else None
        self.cut, self.shown = self._plain_steps(path)
        self.known_pieces = Remembered(self._piece, REMEMBERED // 2)
        self.known = Remembered(self._word, REMEMBERED)

    @staticmethod
    def _plain_steps(path: str):
        """How to cut plain words without the library's steps, and how the model writes their letters.

        Plain are letters and signs below U+0250, which compose to themselves and are classed alike
        by all engines; the pattern is the file's own. Nothing if the file's steps are others.
        """
        with open(path, encoding="utf-8") as file:
            steps = json.load(file)
        normal, cut = steps["normalizer"] or {}, steps["pre_tokenizer"] or {}
        kinds = [n.get("type") for n in normal.get("normalizers", [])], [c.get("type") for c in cut.get("pretokenizers", [])]
        if kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]):
            return None, None
        split, level = cut["pretokenizers"]
        if (split.get("behavior"), split.get("invert")) != ("Removed", True) or level.get("use_regex") or level.get("add_prefix_space"):
            return None, None
        from tokenizers import pre_tokenizers

        bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        shown = {c: "".join(p for p, _ in bytes_of(chr(c))) for c in range(0xA1, 0x250)}
        pattern = split["pattern"]["Regex"]
        for kind in "LN":  # the classes of plain characters, for an engine that has no classes by category
            of_kind = "".join(map(chr, filter(lambda c: unicodedata.category(chr(c))[0] == kind, range(0x250))))
            pattern = pattern.replace(f"\\p{{{kind}}}", of_kind)
        return re.compile(pattern).findall, shown

    def _ids(self, piece: str) -> bytes:
        found = [t.id for t in self.model.tokenize(piece)]
        return struct.pack(f"<{len(found)}i", *found)

    def _piece(self, piece: str) -> bytes:
        """The ids of a plain piece."""
        return self._ids(piece if piece.isascii() else piece.translate(self.shown))

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        small = text.lower()
        if self.cut and _PLAIN(small):
            return b"".join(map(self.known_pieces.__getitem__, self.cut(small)))
        return b"".join(self._ids(piece) for piece, _ in self.pieces.pre_tokenize_str(self.normal.normalize_str(text)))

    def encode(self, text: bytes) -> bytes:
        """The ids of a text as little-endian 32-bit numbers."""
        # combining marks may join a capital otherwise than its small letter
        words = (text if b"\xcc" in text or b"\xcd" in text else text.lower()).split()
        return b"".join(map(self.known.__getitem__, words))

    def encode_added(self, text: bytes) -> bytes:
        """As encode(), but the strings of the file's added tokens become their ids."""
        if self.library:
            return np.array(self.library.encode(text.decode(), add_special_tokens=False).ids, "<i4").tobytes()
        if not any(t in text for t in self.added):
            return self.encode(text)
        return b"".join(self.added[t] if i % 2 else self.encode(t) for i, t in enumerate(self.split(text)))


_WORDS: dict[str, Words] = {}


def words(path: str) -> Words:
    """One encoder per worker process and file."""
    if path not in _WORDS:
        _WORDS[path] = Words(path)
    return _WORDS[path]


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, added: bool = False) -> None:
    """Encode each text, append ``end_id``, and write the ids in ascending order of doc_id.

    The files hold doc_id, part and first (the file's range and the row's place in its ids),
    n_tokens and ids. Null and empty texts have the end id alone; rows without a doc_id come
    first; rows that repeat one follow each other by their text. Other columns are ignored. Strings of
    the tokenizer's added tokens become their ids with ``added``, else they are ordinary text.
    """
    end = np.array([end_id], "<i4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, first = words(tokenizer), TaskContext.get().partitionId(), 0
        encode = own.encode_added if added else own.encode
        for batch in batches:
            values = blocks.texts(batch.column(1))
            for a, b in blocks.steps(values):
                ids = [encode(v) + end for v in values[a:b]]
                at = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype=np.int64)
                flat = pa.Array.from_buffers(pa.int32(), int(at[-1]), [None, pa.py_buffer(b"".join(ids))])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a), pa.array(np.full(b - a, part), pa.int32()), pa.array(first + at[:-1]),
                        pa.array(np.diff(at)), pa.ListArray.from_arrays(pa.array(at, pa.int32()), flat),
                    ],
                    ["doc_id", "part", "first", "n_tokens", "ids"],
                )
                first += int(at[-1])

    keyed = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    keyed = keyed.withColumn("_tie", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie", "text")
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, part int, first bigint, n_tokens bigint, ids array<int>"
    ordered.select("doc_id", "text").mapInArrow(run, schema).write.options(**LAYOUT).parquet(path)


def read_tokens(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """The files' rows with ``start``, the number of ids of all documents before each.

    ``low`` and ``high`` (both inside) select documents; files, row groups and pages outside are
    skipped, and a query of the metadata columns does not read ids.
    """
    rows = spark.read.parquet(path)
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()  # a row per file
    starts, total = [], 0
    for r in sizes:
        starts.append((r["part"], total))
        total += r["n"]
    before = spark.createDataFrame(starts, "part int, _before bigint")
    if low is not None:
        rows = rows.filter(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.filter(F.col("doc_id") <= high)
    return rows.join(F.broadcast(before), "part").select(
        "doc_id", (F.col("_before") + F.col("first")).alias("start"), "n_tokens", "ids"
    )


def with_checksums(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, over the ids as little-endian 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            at, flat = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(at).astype(np.int64)), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, start bigint, n_tokens bigint, ids_crc32 bigint"
    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, schema)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = run_folder(spark, "tokens")
    write_tokens(common.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path, added=True)
    return with_checksums(read_tokens(spark, path))
