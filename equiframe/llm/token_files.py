"""Token-ID output: flat files of unsigned integers with 64-bit document
offsets, memory-mapped when read.

Documents are range-partitioned by id; each task encodes its range and writes
``<part>.bin`` (ids as little-endian unsigned integers, 16 bits wide if the
vocabulary fits, else 32) and ``<part>.idx`` (n + 1 offsets in ids, 64-bit,
then n document ids).  Offsets in a part start at 0; the part's base, the
prefix sum of the parts before it, makes them global.  File names are unique
to the task attempt and the manifest, written by Spark's committer, lists the
files of the attempts that counted: what a lost executor left is never read.

Words are encoded once: the tokenizers' normalizer and pre-tokenizer never
look across white space, so a text's ids are its words' ids in a row, and a
bounded cache keeps words already encoded.  Words made only of ASCII and
Latin-1 letters, where lower-casing and composition are plain, are split here
and given to the library's BPE model directly; all others go through the
library's whole pipeline.

Defined cases: NULL text is empty and holds the end id alone; documents with
NULL id come last, equal ids by text hash; an empty table writes no file and
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from equiframe.llm.shared import map_file, not_last, or_last, shared_path, write_file

_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
# Fixed value: the pre-tokenizer's pattern, written for the characters of _PLAIN after lower-casing.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
CACHED = 250_000        # words of a cache generation; two are kept


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level BPE:
    printable Latin-1 stands for itself, the others for U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


class _Cache(dict):
    """Words to ids; a missing word is taken from the older generation or
    encoded."""

    def __init__(self, make, old: dict):
        super().__init__()
        self.make, self.old = make, old

    def __missing__(self, word: bytes) -> bytes:
        ids = self[word] = self.old.get(word) or self.make(word)
        return ids


class Encoder:
    """Word-cached encoding with a tokenizer file of the tokenizers library."""

    def __init__(self, path: str, plain_words: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.letters, self.words, self.pieces = _byte_letters(), _Cache(self._word, {}), {}
        self.plain = plain_words

    def _word(self, raw: bytes) -> bytes:
        if self.plain and raw.isalpha():  # ASCII letters: one piece
            return self._piece(raw.lower().decode())
        word = raw.decode()
        if not self.plain or not _PLAIN.fullmatch(word) or "<|" in word:
            return array(self.width, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        return b"".join([self._piece(p) for p in _PIECES.findall(word.lower())])

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            shown = piece.encode().decode("latin-1").translate(self.letters)
            ids = self.pieces[piece] = array(self.width, [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()
        return ids

    def encode(self, raw: bytes) -> bytes:
        """The ids of a UTF-8 text, little-endian, ``width`` wide."""
        if len(self.words) > CACHED:  # frequent words come back from the older generation
            self.words.old = {}
            self.words, self.pieces = _Cache(self._word, self.words), {}
        known = self.words
        return b"".join([known[w] for w in raw.split()])


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, plain_words: bool = True) -> Encoder:
    """One encoder, with its cache, per worker process."""
    key = (path, plain_words)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, plain_words)
    return _ENCODERS[key]


MANIFEST = "part int, bin string, idx string, width int, n_docs long, n_ids long"


def write(docs: DataFrame, tokenizer: str, end_id: int, text: str = "text", doc_id: str = "doc_id",
          path: str | None = None, plain_words: bool = True) -> str:
    """Encode and write all documents; returns the folder, which holds the
    files and the manifest.  ``tokenizer`` is a file that every executor can
    open; ``plain_words`` says that it lower-cases and splits by the pattern
    of ``_PIECES`` (else every word goes through the library's pipeline)."""
    spark = docs.sparkSession
    path = path or shared_path(spark, "token-files")

    def run(batches):
        from pyspark import TaskContext

        part, enc = TaskContext.get().partitionId(), encoder(tokenizer, plain_words)
        end = array(enc.width, [end_id]).tobytes()
        size = len(end)
        name = f"{path}/files/{part:06d}-{uuid.uuid4().hex}"
        offsets, ids, out = array("Q", [0]), array("q"), None
        for b in batches:
            for did, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if out is None:
                    out = _stream(name + ".bin")
                data = enc.encode(raw or b"")
                out.write(data)
                out.write(end)
                offsets.append(offsets[-1] + len(data) // size + 1)
                ids.append(did)
        if out is not None:
            out.close()
            write_file(name + ".idx", offsets.tobytes() + ids.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([name + ".bin"]), pa.array([name + ".idx"]),
                 pa.array([size], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([offsets[-1]], pa.int64())],
                names=["part", "bin", "idx", "width", "n_docs", "n_ids"])

    rows = docs.select(or_last(F.col(doc_id)).alias("did"), F.col(text).cast("binary").alias("raw"))
    tie = F.xxhash64("raw")
    (rows.repartitionByRange("did", tie).sortWithinPartitions("did", tie)
         .mapInArrow(run, MANIFEST).write.parquet(f"{path}/manifest"))
    return path


def _stream(uri: str):
    from equiframe.llm.shared import filesystem

    fs, p = filesystem(uri)
    fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(p, buffer_size=1 << 20)


def parts(spark: SparkSession, path: str) -> DataFrame:
    """The manifest with each part's base.  One row per file, so the running
    sum's single task holds as many rows as there were write tasks."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
                 .withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))))


def documents(part: dict):
    """(doc_id, global start, ids) of each document of one manifest row; ids
    are views of the mapped file."""
    n = part["n_docs"]
    offsets = map_file(part["idx"], "<u8", n + 1)
    names = map_file(part["idx"], "<i8", n, 8 * (n + 1))
    ids = map_file(part["bin"], f"<u{part['width']}")
    for i in range(n):
        a, b = int(offsets[i]), int(offsets[i + 1])
        yield int(names[i]), part["base"] + a, ids[a:b]


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: global start, length, and crc32 of
    its ids as little-endian unsigned 32-bit integers."""
    def run(batches):
        for b in batches:
            for part in b.to_pylist():
                rows = [(d, s, len(x), zlib.crc32(x.astype("<u4").tobytes())) for d, s, x in documents(part)]
                for i in range(0, len(rows), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i:i + 100_000])],
                                                     names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = parts(spark, path)
    n = max(1, spark.sparkContext.defaultParallelism * 4)
    return files.repartition(n, "part").mapInArrow(run, READ).withColumn("doc_id", not_last(F.col("doc_id")))
