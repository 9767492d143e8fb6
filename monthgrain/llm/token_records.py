"""Token-ID output: length-delimited binary records with masked checksums and an offset index.

A file is a run of frames; a frame is

    u64 length | u32 masked crc32(length) | payload | u32 masked crc32(payload) | 0x0A

all little-endian. The payload is one document: i64 id, u8 (1: the id is null), u8 bytes per token
(2 where the vocabulary allows, else 4), then the token ids. Spark's text writer puts the frames
down, with its own commit protocol, so that failed or repeated tasks leave no half files, and any
file system that Spark writes is good; the final 0x0A is its record end. Masking (rotate by 15,
add a constant) keeps a checksum from being that of data which holds checksums.

The index has a row per record: file number, file, byte offset and length of the frame, id, tokens
and their checksum. It serves reads in any order: seek to offset, read length bytes, `parse_frame`.

Defined cases: null text is the empty text, which gives the end id alone; ids ascend, nulls first;
repeated ids are ordered by a hash of the text, then the text; repeated rows are each written; very long
texts are one record; an empty table gives an empty folder and an empty index; other columns of the
input are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, n_tasks, scratch_path

#: The published masking constant of framed records.
MASK_DELTA = 0xA282EAD8
#: Text in characters that one file should hold at most.
FILE_CHARS = 24_000_000
#: Words that one generation of a worker's cache may hold.
CACHE_ENTRIES = 120_000
INDEX_SCHEMA = "file_no long, file string, offset long, length long, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def masked(crc: int) -> int:
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """Without the final 0x0A, which the writer adds."""
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(zlib.crc32(size))), payload, struct.pack("<I", masked(zlib.crc32(payload)))))


def parse_frame(data: bytes, at: int = 0) -> tuple[int | None, np.ndarray, int]:
    """The id, the token ids and the end of the frame at an offset. Raises ValueError if it is damaged."""
    size = data[at : at + 8]
    if len(size) < 8 or data[at + 8 : at + 12] != struct.pack("<I", masked(zlib.crc32(size))):
        raise ValueError(f"damaged length at byte {at}")
    (n,) = struct.unpack("<Q", size)
    payload, end = data[at + 12 : at + 12 + n], at + 12 + n
    if len(payload) < n or data[end : end + 5] != struct.pack("<I", masked(zlib.crc32(payload))) + b"\n":
        raise ValueError(f"damaged record at byte {at}")
    doc_id, is_null, width = struct.unpack("<qBB", payload[:10])
    return None if is_null else doc_id, np.frombuffer(payload, "<u2" if width == 2 else "<u4", offset=10), end + 5


#: Fixed value: the pre-token pattern of word_bpe tokenizers.
WORD_BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def splits_at_space(path: str) -> bool:
    """Whether a tokenizer file is of the kind whose words can be encoded one by one."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    parts = lambda key, inner: [] if not spec.get(key) else spec[key].get(inner, [spec[key]])
    normalizers, first = [n["type"] for n in parts("normalizer", "normalizers")], next(iter(parts("pre_tokenizer", "pretokenizers")), {})
    splits = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and first.get("pattern", {}).get("Regex") == WORD_BPE_PATTERN
    return bool(splits) and "Lowercase" in normalizers and set(normalizers) <= {"NFC", "Replace", "Lowercase"} and spec["model"].get("end_of_word_suffix") == "</w>"


class WordEncoder:
    """A library tokenizer that encodes each distinct word once, where that gives the same ids.

    It does for tokenizers that lower-case, drop white space and split at it, with word-end marks (as
    word_bpe does; `splits_at_space` reads that from the file): there the ids of a text are those of its
    pieces between white space, one after the other, and a piece may also be cut where letters meet other
    signs. A piece of plain letters is one pre-token, whose ids end with a word-end token, so new ones are
    encoded by the library in one joined text that is split at those ends. Any other piece is encoded by
    itself, and so are whole texts with all other tokenizers.

    Words met lately are kept in two generations of CACHE_ENTRIES at most.
    """

    LETTERS = b"a-z\xdf-\xf6\xf8-\xff"
    PLAIN = re.compile(b"[" + LETTERS + b"]+")
    RUNS = re.compile(b"[" + LETTERS + rb"]+|[!#-&(-/:-@\[-`{-~]+")  # letters; ASCII signs but the apostrophe
    #: Characters that Python's split takes for white space and the library may not.
    SEPARATORS = re.compile("[\x1c-\x1f]")
    #: Lower case and one kind of white space for texts in Latin-1, of one byte a character.
    LOWER = bytes(ord(chr(i).lower()) for i in range(256)).translate(bytes.maketrans(b"\t\n\r\x0b\x0c\x85\xa0", b"       "))
    #: Their kinds: s a stop or comma, + any other sign, x what Python may split at and the library not.
    KINDS = bytes(ord("s") if chr(i) in ".," else ord("x") if 0x1C <= i < 0x20 else ord(" ") if chr(i).isspace() else ord("a") if chr(i).isalnum() else ord("+") for i in range(256))

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.by_words = splits_at_space(path)
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.width = 2 if size <= 1 << 16 else 4
        self.dtype = "<u2" if self.width == 2 else "<u4"
        self.ends = np.zeros(size, bool)
        self.ends[[i for w, i in self.library.get_vocab().items() if w.endswith("</w>")]] = True
        self.special = {t.content[:2] for t in self.library.get_added_tokens_decoder().values()}
        self.pieces: dict[bytes | str, bytes] = {}  # by piece: bytes of Latin-1, else str
        self.older: dict[bytes | str, bytes] = {}

    def _encode_alone(self, pieces: list[bytes | str]) -> None:
        for at in range(0, len(pieces), 4096):
            some = pieces[at : at + 4096]
            texts = [p if isinstance(p, str) else p.decode("latin-1") for p in some]
            for piece, got in zip(some, self.library.encode_batch(texts, add_special_tokens=False), strict=True):
                self.pieces[piece] = np.array(got.ids, self.dtype).tobytes()

    def _encode_plain(self, words: list[bytes]) -> None:
        w = self.width
        for at in range(0, len(words), 256):
            some = words[at : at + 256]
            ids = np.array(self.library.encode(b" ".join(some).decode("latin-1"), add_special_tokens=False).ids, self.dtype)
            ends = (np.flatnonzero(self.ends[ids]) + 1) * w
            if len(ends) != len(some):  # a word isn't one pre-token after all
                self._encode_alone(some)
                continue
            raw, last = ids.tobytes(), 0
            for word, end in zip(some, ends.tolist(), strict=True):
                self.pieces[word] = raw[last:end]
                last = end

    def _learn(self, missing: set[bytes | str]) -> None:
        older, pieces = self.older, self.pieces
        if older:
            for piece in missing.intersection(older):
                pieces[piece] = older[piece]
            missing = missing.difference(older)
        plain, mixed, alone = set(), {}, set()
        for piece in missing:
            if isinstance(piece, str):
                alone.add(piece)
            elif self.PLAIN.fullmatch(piece):
                plain.add(piece)
            elif len(runs := self.RUNS.findall(piece)) > 1 and sum(map(len, runs)) == len(piece):
                mixed[piece] = runs
                for r in runs:
                    if r not in pieces:
                        (plain if self.PLAIN.match(r) else alone).add(r)
            else:
                alone.add(piece)
        self._encode_plain(list(plain))
        self._encode_alone(list(alone))
        for piece, runs in mixed.items():
            pieces[piece] = b"".join([pieces[r] for r in runs])

    def _split(self, text: str | None) -> list[bytes] | list[str] | None:
        """The pieces of a text; None if it must be encoded as a whole."""
        if not text:
            return []
        if not self.by_words or any(s in text for s in self.special):
            return None
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return None if self.SEPARATORS.search(text) else text.split()
        kinds = raw.translate(self.KINDS)
        if b"x" in kinds:
            return None
        raw = raw.translate(self.LOWER)
        if b"+s" not in kinds and b"ss" not in kinds:  # each stop and comma is a run of signs by itself
            raw = raw.replace(b". ", b" . ").replace(b", ", b" , ")
        return raw.split()

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text as packed bytes."""
        for at in range(0, len(texts), 512):
            split = [self._split(t) for t in texts[at : at + 512]]
            if len(self.pieces) > CACHE_ENTRIES:
                self.older, self.pieces = self.pieces, {}
            missing = set().union(*(words for words in split if words)).difference(self.pieces)
            if missing:
                self._learn(missing)
            get = self.pieces.__getitem__
            for words, text in zip(split, texts[at : at + 512], strict=True):
                yield np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes() if words is None else b"".join(map(get, words))


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Writes doc_id and text of docs as framed records under path, ascending doc_id from file to file."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chars = rows.agg(F.sum(F.length("text"))).first()[0]
    ordered = rows.repartitionByRange(n_tasks(rows, chars, FILE_CHARS), F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text").asc_nulls_first())

    def make():
        encoder = _encoder(tokenizer)
        end, head = np.array([end_id], encoder.dtype).tobytes(), struct.Struct("<qBB")

        def step(ids: pa.Array, texts: pa.Array):
            encoded = encoder.encode(texts.to_pylist())
            return [[frame(head.pack(i or 0, i is None, encoder.width) + got + end) for i, got in zip(ids.to_pylist(), encoded, strict=True)]]

        return step

    frames = arrow_map(ordered, make, "frame binary", ["doc_id", "text"])
    frames.select(F.col("frame").cast("string").alias("value")).write.option("maxRecordsPerFile", 0).text(path)  # one file a task: its number tells its place


def index_records(spark: SparkSession, path: str) -> DataFrame:
    """Reads all files of write_records, checks each frame, and gives the index row of each record."""
    files = spark.read.schema("path string, modificationTime timestamp, length long, content binary").format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    numbered = files.select(F.regexp_extract("path", r"part-(\d+)-", 1).cast("long").alias("file_no"), F.col("path").alias("file"), "content")

    def make():
        def step(numbers: pa.Array, names: pa.Array, contents: pa.Array):
            out: list[list] = [[] for _ in range(8)]
            for number, name, content in zip(numbers.to_pylist(), names.to_pylist(), contents, strict=True):
                data, at, start = content.as_py(), 0, 0
                while at < len(data):
                    doc_id, ids, end = parse_frame(data, at)
                    row = (number, name, at, end - at, doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                    at, start = end, start + len(ids)
            return out

        return step

    return arrow_map(numbered, make, INDEX_SCHEMA, ["file_no", "file", "content"])


def with_starts(index: DataFrame) -> DataFrame:
    """Adds start: the ids of all records before this one, over all files in order.

    The running sum goes over one row a file; the record's place in its own file comes from the index."""
    totals = index.groupBy("file_no").agg(F.sum("n_tokens").alias("file_tokens"))
    before = totals.select("file_no", F.coalesce(F.sum("file_tokens").over(Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return index.join(before, "file_no").withColumn("start", F.col("base") + F.col("local_start")).drop("base", "local_start")


def token_records(docs: DataFrame, tokenizer: str, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Writes docs as records and their index under path (in the shared folder if None), and returns
    the index as read back, with starts. path gets the subfolders `records` and `index`."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-records")
    write_records(docs, f"{path}/records", tokenizer, end_id)
    index_records(spark, f"{path}/records").write.parquet(f"{path}/index")
    return with_starts(spark.read.parquet(f"{path}/index"))
