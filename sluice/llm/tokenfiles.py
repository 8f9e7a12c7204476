"""Token-id files: independent zstandard frames, a trailing seek table, and a checksum for each frame.

A file is a frame a document (its ids as little-endian unsigned 32-bit integers), then a skippable frame with the documents'
ids, then the seek table of the zstandard seekable format: compressed size, size and low 32 bits of the XXH64 of each frame.
A reader fetches the two tables and then only the frames of the documents it wants. Any zstandard decoder reads the frames.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import Chunks, chunks, unspaced
from .common import held, parts_for, scratch, shared_dir, slices

#: Fixed values of the seekable format: magic numbers, and the flag for checksums.
_SKIP_TABLE, _SKIP_IDS, _SEEKABLE, _CHECKSUMS = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1, 0x80
END_ID = 2
#: Pieces in each of two generations whose ids are remembered.
MAX_PIECES = 700_000
#: Pieces whose ids are put in place at once.
AT_ONCE = 400_000
#: Bytes of text that a file is meant to hold: the number of files grows with the table.
FILE_BYTES = 64 << 20


class Writer:
    """Appends documents to an open binary file, frame by frame."""

    def __init__(self, out, level: int = 3):
        self.out, self.packer = out, zstandard.ZstdCompressor(level=level)
        self.table, self.ids = bytearray(), bytearray()
        self.frames = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.packer.compress(ids)
        self.out.write(frame)
        self.table += struct.pack("<III", len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF)
        self.ids += struct.pack("<?q", doc_id is not None, doc_id or 0)
        self.frames += 1

    def finish(self) -> None:
        self.out.write(struct.pack("<II", _SKIP_IDS, len(self.ids)) + self.ids)
        self.table += struct.pack("<III", 8 + len(self.ids), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)
        self.out.write(struct.pack("<II", _SKIP_TABLE, len(self.table) + 9) + self.table + struct.pack("<IBI", self.frames + 1, _CHECKSUMS, _SEEKABLE))


class Reader:
    """Reads single documents of an open, seekable binary file; raises ValueError where bytes don't fit their checksum."""

    def __init__(self, source):
        self.source, self.unpacker = source, zstandard.ZstdDecompressor()
        size = source.seek(0, os.SEEK_END)
        source.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != _SEEKABLE or flags != _CHECKSUMS:
            raise ValueError("no seek table with checksums")
        source.seek(size - 9 - 12 * n)
        self.entries = list(struct.iter_unpack("<III", source.read(12 * n)))
        self.starts = [0]
        for packed, _, _ in self.entries:
            self.starts.append(self.starts[-1] + packed)
        source.seek(self.starts[n - 1])
        magic, length = struct.unpack("<II", source.read(8))
        if magic != _SKIP_IDS:
            raise ValueError("no table of documents")
        self.ids = [i if there else None for there, i in struct.iter_unpack("<?q", source.read(length))]

    def __len__(self) -> int:
        return len(self.ids)

    def tokens(self, k: int) -> int:
        return self.entries[k][1] // 4

    def document(self, k: int) -> bytes:
        """Ids of the k-th document; only its frame is read and decompressed."""
        packed, size, check = self.entries[k]
        self.source.seek(self.starts[k])
        ids = self.unpacker.decompress(self.source.read(packed), max_output_size=size) if size else b""
        if len(ids) != size or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} is damaged")
        return ids


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI (file, hdfs, s3, gs) or of a plain path."""
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)


class Library:
    """Whole texts encoded by the tokenizers library; pieces between spaces that come again are handed to it once.

    The vocabulary's own splitting never lets a match lie across those cuts, so that ids are those of the whole text. Texts
    that hold the string of an added token go to the library whole, as it cuts them there first.
    """

    def __init__(self, path: str, room: int = MAX_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.room = Tokenizer.from_file(path), room
        vocabulary = self.tokenizer.get_vocab()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([unspaced(), *map(re.escape, self.added)])
        space = self.tokenizer.pre_tokenizer.pre_tokenize_str(" a")[0][0][0]
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for t, i in vocabulary.items() if t.startswith(space)]] = True
        self.first = Chunks(self._ids, room)
        # ids of pieces with a space in front, in two generations
        self.after: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode_batch(self, texts: pa.Array) -> list[bytes]:
        """Packed ids of each text. Those that spaces alone can cut are cut, and their distinct pieces looked up, all at once."""
        out = [b""] * len(texts)
        odd = pc.fill_null(pc.match_substring_regex(texts, self.odd), False).to_numpy(zero_copy_only=False)
        for k in np.flatnonzero(odd).tolist():
            text = texts[k].as_py()
            out[k] = self._ids(text) if any(t in text for t in self.added) else b"".join(map(self.first.__getitem__, chunks(text)))
        there = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False) > 0
        plain = np.flatnonzero(there & ~odd)
        if not len(plain):
            return out
        parts = pc.split_pattern(texts.take(pa.array(plain)).cast(pa.large_string()), " ")
        cuts = parts.offsets.to_numpy()
        coded = parts.values.dictionary_encode()
        codes, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        # the first piece of a text has no space in front
        heads = [distinct[c] for c in codes[cuts[:-1]].tolist()]
        codes[cuts[:-1]] = len(distinct) + np.arange(len(heads))
        found = self._look_up(distinct) + [self.first[x] for x in heads]
        pool = np.frombuffer(b"".join(found), "<u4")
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(lengths) - lengths
        at = 0
        while at < len(plain):  # texts of some hundred thousand pieces at once, so that what is gathered stays small
            to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + AT_ONCE, "right")) - 1)
            some = codes[cuts[at] : cuts[to]]
            sizes = lengths[some]
            ends = np.cumsum(sizes)
            places = np.repeat(starts[some] - (ends - sizes), sizes)
            places += np.arange(len(places))
            ids = pool[places].tobytes()
            borders = [0, *(4 * ends[cuts[at + 1 : to + 1] - cuts[at] - 1]).tolist()]
            for k, a, b in zip(plain[at:to].tolist(), borders, borders[1:]):
                out[k] = ids[a:b]
            at = to
        return out

    def _look_up(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces, each with a space in front."""
        found = list(map(self.after.get, pieces))
        gaps = [k for k, ids in enumerate(found) if ids is None]
        unknown = []
        for k in gaps:
            found[k] = self.old.get(pieces[k])
            if found[k] is None:
                unknown.append(k)
        unknown.sort(key=pieces.__getitem__)  # neighbours that begin alike are encoded faster
        for k, ids in zip(unknown, self._pieces([pieces[k] for k in unknown])):
            found[k] = ids
        self.after.update((pieces[k], found[k]) for k in gaps if len(pieces[k]) < 64)
        if len(self.after) >= self.room:
            self.old, self.after = self.after, {}
        return found

    def _pieces(self, new: list[str]) -> list[bytes]:
        """Ids of each piece with a space in front. Many go to the library as one text; tokens that begin with the space part them."""
        out: list[bytes] = []
        for at in range(0, len(new), 256):
            group = new[at : at + 256]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join([" " + p for p in group])], add_special_tokens=False)[0].ids, dtype="<u4")
            starts = np.flatnonzero(self.spaced[ids])
            if len(starts) == len(group) and starts[0] == 0:
                packed, cuts = ids.tobytes(), (4 * np.append(starts, len(ids))).tolist()
                out += [packed[a:b] for a, b in zip(cuts, cuts[1:])]
            else:
                out += [self._ids(" " + p) for p in group]
        return out


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Writes docs (doc_id, text) in ascending doc_id (nulls first, then by hash of the text) to files under folder; returns their list.

    One row a file: part (files ascend), path, n_docs, n_tokens. A task writes one file under a name of its own, so that tasks
    that run twice leave an unlisted file at most. Null and empty texts have just the end id.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = held(("token files", tokenizer_path), lambda: Library(tokenizer_path))
        part, end = TaskContext.get().partitionId(), struct.pack("<I", end_id)
        writer, n = None, 0
        fs, place = open_fs(folder)
        path = f"part-{part:06d}-{uuid.uuid4().hex}.tok.zst"
        out = None
        for batch in batches:
            for piece in slices(batch, 1, 16_384, 16 << 20):
                for i, ids in zip(piece.column(0).to_pylist(), lib.encode_batch(piece.column(1))):
                    if writer is None:
                        fs.create_dir(place, recursive=True)
                        out = fs.open_output_stream(f"{place}/{path}", compression=None)
                        writer = Writer(out)
                    writer.add(i, ids + end)
                    n += len(ids) // 4 + 1
        if writer is not None:
            writer.finish()
            out.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "path": f"{folder}/{path}", "n_docs": writer.frames, "n_tokens": n}])

    # the bounds of ranges are found from a sample of narrow keys, not of texts
    keyed = docs.select("doc_id", "text").withColumn("h", F.xxhash64("text"))
    ordered = keyed.repartitionByRange(parts_for(docs, FILE_BYTES), "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    return scratch(ordered.mapInArrow(run, "part long, path string, n_docs long, n_tokens long"), "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the listed files."""
    # a row a file: running sums over them are one small task
    starts = files.withColumn("start", F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, place = open_fs(path)
                with fs.open_input_file(place) as source:
                    reader = Reader(source)
                    rows: dict[str, list] = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
                    for k, doc_id in enumerate(reader.ids):
                        ids = reader.document(k)
                        for name, value in zip(rows, (doc_id, start, len(ids) // 4, zlib.crc32(ids))):
                            rows[name].append(value)
                        start += len(ids) // 4
                    yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([(name, pa.int64()) for name in rows]))

    # each file is some task's own: the number is the files', so that it isn't coalesced
    dealt = starts.select("path", "start").repartition(max(1, files.count()), "path")
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes docs as token files and reads every document back from them; see write_token_files and read_token_files."""
    folder = folder or f"{shared_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    return read_token_files(write_token_files(docs, tokenizer_path, folder, end_id))
