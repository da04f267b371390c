"""Token ids in fixed-width binary files.

Every id takes the least number of bits that holds the vocabulary. A file is, in little-endian order,

| part | type | content |
|---|---|---|
| magic | 8 bytes | ``GWBITS01`` |
| header | 2 x uint32, 3 x uint64 | width in bits, ids per block, documents, ids, blocks |
| block offsets | uint64 x (blocks + 1) | where each block starts within the payload; the last one is its length |
| document ends | uint64 x documents | ids up to and with each document |
| document ids | int64 x documents | 0 where null |
| validity | uint8 x documents | 0 for a null id |
| payload | blocks | ids of a block, in groups of 32 that fill ``width`` 32-bit words; the last group is padded with 0 |

A group of 32 ids of any width ends at a word, so a whole block is packed and unpacked by 32 shifts over arrays. The offsets
give random access: ``read_ids`` fetches the tables and the blocks a document touches, nothing else.

``write_files`` sorts the texts by id with a range shuffle, encodes them where they arrive and writes one file after the
other as ids fill up; a task holds the ids of one open file (``FILE_IDS``) whatever the input. File names follow the partition,
so they sort like the ids, and a task that runs again writes the same files anew: each is written under a name of its own and
moved in place. ``read_documents`` reads folders of such files with Spark's ``binaryFile`` source.

Defined cases: a null text is an empty one, which has only the end id; null ids come first and stay null; rows that share
an id are all kept, in the order of a hash of their texts; an empty table makes no file, and reads back as no row.
"""

from __future__ import annotations

import functools
import gc
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeworks.llm.text import slices
from gaugeworks.session import cut, scratch_path

MAGIC, _HEADER = b"GWBITS01", struct.Struct("<IIQQQ")
GROUP, BLOCK_IDS, FILE_IDS = 32, 4096, 1 << 23
END_ID = 0
#: Known pieces of text a worker keeps, and their greatest length; longer ones are encoded each time.
CACHE_PIECES, CACHE_CHARS = 400_000, 64
FOLDER_FILES = 1000
_ENCODE_ROWS = 512
_FIRST = "\x00"
_MANIFEST = "file string, n_docs long, n_ids long"
_READ = "file string, place long, doc_id long, local long, n_tokens long, ids_crc32 long"
# A blank before a character that is no white space begins a new piece in byte-level vocabularies.
_PIECES = re.compile(r" (?=\S)")
# Letters, runs of ASCII signs (no apostrophe, and no "<", which may begin a special token) and line feeds, each a token of its own.
_LETTERS, _SIGNS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", r"!-&(-/:;=-@\[-`{-~"
_PLAIN = re.compile(rf"[{_LETTERS}]+(?:(?:[{_SIGNS}]+\n?|\n)[{_LETTERS}]+)*[{_SIGNS}]*")
_PARTS = re.compile(rf"[{_LETTERS}]+|[{_SIGNS}]+|\n")
# The printable characters that stand for the 256 bytes in byte-level vocabularies: those that print stand for themselves.
_PRINT = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_OTHERS = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in _PRINT)}
_BYTES, _BLANK = _OTHERS, chr(_OTHERS[0x20])


def bit_width(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids in groups of 32, each in ``width`` 32-bit words, low bits first."""
    groups = -(-len(ids) // GROUP)
    table = np.zeros((groups, GROUP), np.uint32)
    table.reshape(-1)[:len(ids)] = ids
    out = np.zeros((groups, width), np.uint32)
    for k in range(GROUP):
        word, shift = divmod(k * width, 32)
        out[:, word] |= table[:, k] << np.uint32(shift)
        if shift + width > 32:
            out[:, word + 1] |= table[:, k] >> np.uint32(32 - shift)
    return out.astype("<u4").tobytes()


def unpack(raw: bytes | memoryview, width: int, n: int) -> np.ndarray:
    """The first ``n`` ids of packed groups."""
    words = np.frombuffer(raw, "<u4").reshape(-1, width)
    out = np.empty((len(words), GROUP), np.uint32)
    mask = np.uint32(0xFFFFFFFF >> (32 - width))
    for k in range(GROUP):
        word, shift = divmod(k * width, 32)
        ids = words[:, word] >> np.uint32(shift)
        if shift + width > 32:
            ids = ids | (words[:, word + 1] << np.uint32(32 - shift))
        out[:, k] = ids & mask
    return out.reshape(-1)[:n]


def file_bytes(doc_ids: list[int | None], parts: list[np.ndarray], width: int, block_ids: int = BLOCK_IDS) -> bytes:
    """One file with the ids of its documents in order."""
    if block_ids % GROUP:
        raise ValueError(f"a block holds a multiple of {GROUP} ids")
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"id {int(ids.max())} does not fit into {width} bits")
    full = block_ids * width // 8
    payload = pack(ids, width)
    blocks = -(-len(ids) // block_ids)
    offsets = np.minimum(np.arange(blocks + 1, dtype=np.uint64) * np.uint64(full), np.uint64(len(payload)))
    ends = np.cumsum([len(p) for p in parts], dtype=np.uint64)
    return b"".join([MAGIC, _HEADER.pack(width, block_ids, len(parts), len(ids), blocks),
                     offsets.astype("<u8").tobytes(), ends.astype("<u8").tobytes(),
                     np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
                     bytes(d is not None for d in doc_ids), payload])


class BitFile:
    """A file behind ``fetch(offset, length)``: header and tables are read at once, blocks when they are asked for."""

    def __init__(self, fetch: Callable[[int, int], bytes | memoryview]):
        at = len(MAGIC) + _HEADER.size
        head = bytes(fetch(0, at))
        if head[:len(MAGIC)] != MAGIC:
            raise ValueError("not a file of packed ids")
        self.width, self.block_ids, self.n_docs, self.n_ids, self.n_blocks = _HEADER.unpack(head[len(MAGIC):])
        table = memoryview(fetch(at, 8 * (self.n_blocks + 1) + 17 * self.n_docs))
        cuts = np.cumsum([0, 8 * (self.n_blocks + 1), 8 * self.n_docs, 8 * self.n_docs, self.n_docs])
        offsets, ends, ids, valid = (table[a:b] for a, b in zip(cuts, cuts[1:]))
        self.offsets = np.frombuffer(offsets, "<u8").astype(np.int64)
        self.ends = np.frombuffer(ends, "<u8").astype(np.int64)
        self.doc_ids, self.valid = np.frombuffer(ids, "<i8"), np.frombuffer(valid, np.uint8).astype(bool)
        self._fetch, self._payload = fetch, at + int(cuts[-1])

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the file, from the blocks that hold them."""
        if start >= end:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, -(-end // self.block_ids)
        a, b = int(self.offsets[first]), int(self.offsets[last])
        held = min(last * self.block_ids, self.n_ids) - first * self.block_ids
        got = unpack(self._fetch(self._payload + a, b - a), self.width, held)
        return got[start - first * self.block_ids:end - first * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder, as tasks reach it."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri)) if ":/" in uri else (pafs.LocalFileSystem(), uri)


def read_ids(uri: str, k: int) -> np.ndarray:
    """The ids of document ``k`` of one file, by random access."""
    fs, path = store(uri)
    with fs.open_input_file(path) as src:
        return BitFile(lambda at, n: src.read_at(n, at)).document(k)


class PieceEncoder:
    """Ids of texts through the ``tokenizers`` library, which sees each frequent piece of text once.

    Byte-level vocabularies never join what stands before a blank with what follows it, so a text is cut there, and pieces met
    before take their ids from a table of two generations: when the young one is full it becomes the old one, and what is
    met again moves back, so frequent pieces stay. New pieces of letters, signs and line feeds go to the model of the vocabulary word by
    word; all others, and all where the vocabulary is found to cut in another way, go through the whole pipeline of the library.
    ``whole=True`` encodes texts as they are, for vocabularies of another kind.
    """

    def __init__(self, file: str, special_as_text: bool = False, whole: bool = False):
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(file)
        self._tok.encode_special_tokens = special_as_text
        self.vocabulary = self._tok.get_vocab_size(with_added_tokens=True)
        self._whole, self._model = whole, self._tok.model
        self._signs: dict[str, bytes] = {}
        self._known, self._by_word = _Known(self._piece, {}), True
        probe = " ab.\nCd,ef gh\u00e9 xyzzyq"
        self._by_word = not whole and np.array_equal(self._encode([probe])[0], self([probe])[0])
        self._known = _Known(self._piece, {})

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self._tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: str, blank: str = "") -> bytes:
        """Ids of a run of letters, by the byte alphabet of the model."""
        mapped = blank + word if word.isascii() and word != "\n" else blank + word.encode().decode("latin-1").translate(_BYTES)
        return array("I", [t.id for t in self._model.tokenize(mapped)]).tobytes()

    def _part(self, part: str) -> bytes:
        """Ids of what follows the first word of a piece; those of short signs are kept."""
        ids = self._word(part)
        if len(part) <= 2 and not part.isalpha():
            self._signs[part] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece, which has lost the blank it was cut at; the first one of a text begins with a mark instead."""
        if self._by_word:
            if piece.isalpha():
                return self._word(piece, _BLANK)
            if _PLAIN.fullmatch(piece):
                first, *others = _PARTS.findall(piece)
                return self._known[first] + b"".join(self._signs.get(p) or self._part(p) for p in others)
        return self._encode([piece[1:] if piece[:1] == _FIRST else " " + piece])[0].tobytes()

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if self._whole:
            return self._encode(texts)
        # Nothing here makes cycles, and the collector would walk the table of pieces again and again.
        collects, out = gc.isenabled(), []
        gc.disable()
        try:
            for text in texts:
                if len(self._known) > CACHE_PIECES:
                    self._known = _Known(self._piece, dict(self._known))
                out.append(np.frombuffer(b"".join(map(self._known.__getitem__, _PIECES.split(_FIRST + text))), np.uint32))
        finally:
            if collects:
                gc.enable()
        return out


class _Known(dict):
    """Ids of pieces met before; others come from the generation before this one, or are worked out."""

    def __init__(self, make: Callable[[str], bytes], old: dict[str, bytes]):
        super().__init__()
        self._make, self._old = make, old

    def __missing__(self, piece: str) -> bytes:
        ids = self._old.get(piece)
        if ids is None:
            ids = self._make(piece)
        if len(piece) <= CACHE_CHARS and piece[:1] != _FIRST:
            self[piece] = ids
        return ids


@functools.lru_cache(maxsize=2)
def _encoder(file: str, special_as_text: bool, whole: bool) -> PieceEncoder:
    """One encoder a worker process, so that tasks share what it has learnt."""
    return PieceEncoder(file, special_as_text, whole)


def write_files(docs: DataFrame, folder: str, tokenizer: str, text: str = "text", doc_id: str = "doc_id", end_id: int = END_ID,
                special_as_text: bool = False, whole: bool = False, file_ids: int = FILE_IDS, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encode all texts, each followed by ``end_id``, and write them in ascending order of their ids below ``folder``, which
    all executors must reach. ``file, n_docs, n_ids`` per file. ``tokenizer`` is the path of a file of the
    ``tokenizers`` library on every worker."""
    body, key = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.col(f"`{doc_id}`").cast("long")
    rows = docs.select(key.alias("id"), F.xxhash64(body).alias("tie"), F.monotonically_increasing_id().alias("row"), body.alias("body"))
    order = ["id", "tie", "row"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, (fs, root) = _encoder(tokenizer, special_as_text, whole), store(folder)
        width, task, end = bit_width(encode.vocabulary), TaskContext.get(), np.array([end_id], np.uint32)
        ids, parts, held, made = [], [], 0, []

        def close() -> None:
            nonlocal held
            name = f"part-{task.partitionId():06d}-{len(made):06d}.bits"
            own = f"{root}/_writing-{uuid.uuid4().hex}"
            with fs.open_output_stream(own) as out:
                out.write(file_bytes(ids, parts, width, block_ids))
            fs.move(own, f"{root}/{name}")
            made.append((name, len(parts), held))
            ids.clear()
            parts.clear()
            held = 0

        for batch in (part for b in batches for part in slices(b, _ENCODE_ROWS)):
            got = encode(batch.column(1).to_pylist())
            for key, doc in zip(batch.column(0).to_pylist(), got):
                if parts and held + len(doc) + 1 > file_ids:
                    close()
                ids.append(key)
                parts.append(np.concatenate([doc, end]))
                held += len(doc) + 1
        if parts:
            close()
        cols = list(zip(*made)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())],
                                         ["file", "n_docs", "n_ids"])

    fs, root = store(folder)
    fs.create_dir(root, recursive=True)
    return cut(placed.mapInArrow(run, _MANIFEST))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document of the files below ``folder``, in the order of files and places:
    ``start`` counts the ids of all documents before it, ``ids_crc32`` is over its ids as little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in slices(b, 1)):
            name = batch.column(0)[0].as_py().rsplit("/", 1)[-1]
            raw = memoryview(batch.column(1)[0].as_buffer())
            src = BitFile(lambda at, n: raw[at:at + n])
            starts = np.concatenate([[0], src.ends[:-1]]).astype(np.int64)[:src.n_docs]
            ids = src.ids(0, src.n_ids).astype("<u4", copy=False).view(np.uint8).data
            crcs = [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(starts, src.ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * src.n_docs, pa.string()), pa.array(np.arange(src.n_docs)), pa.array(src.doc_ids, mask=~src.valid),
                 pa.array(starts), pa.array(src.ends - starts), pa.array(crcs, pa.int64())],
                ["file", "place", "doc_id", "local", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bits").load(folder).select("path", "content")
    docs = cut(files.mapInArrow(run, _READ))
    # Ids before each file: sums of files within folders of about a thousand neighbours, then sums of folders.
    sums = docs.groupBy("file").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("k"))
    part = sums.withColumn("fold", F.floor(F.substring("file", 6, 6).cast("long") / FOLDER_FILES))
    folds = part.groupBy("fold").agg(F.sum("n").alias("all")).withColumn(
        "earlier", F.sum("all").over(Window.orderBy("fold")) - F.col("all")).select(F.col("fold").alias("of"), "earlier")
    within = F.sum("n").over(Window.partitionBy("fold").orderBy("file")) - F.col("n")
    before = (part.withColumn("within", within).join(folds, F.col("fold") == F.col("of"))
              .select(F.col("file").alias("in_file"), (F.col("within") + F.col("earlier")).alias("before")))
    return (docs.join(before, F.col("file") == F.col("in_file"))
            .select("doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"))


def fresh_folder(spark: SparkSession) -> str:
    """A new folder for files below the shared one."""
    return scratch_path(spark, "ids")
