"""Token ids in files of fixed-width packed integers.

A file holds the ids of a run of documents in ascending doc_id order. Each id takes the fewest bits that the
vocabulary needs. Ids are packed in blocks of `BLOCK_IDS` (a multiple of 8, so every block starts on a byte), and a
footer has each block's byte offset, and each document's doc_id and first id:

    blocks | block offsets u64[n + 1] | doc_id i64[docs] | doc_id is null u8[docs] | first id u64[docs + 1]
           | bits u32, ids per block u32, docs u64, ids u64 | magic 8 bytes

So `Reader.ids(a, b)` seeks to the blocks it needs and unpacks them with numpy. Writing streams: a task holds one
slice of texts and the footer of its file. A file gets its final name by a move when it is whole, and files of a
lost or repeated task are written again with the same name and content.

Results: a null text is encoded like an empty one; with the end id every document has one id at least. Documents
of equal doc_id stand in the order of their texts; null doc_ids come first. An empty table gives no files.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.arrow import slices, worker_state
from terrane.llm.pieces import Lexicon
from terrane.llm.storage import new_path, open_store, saved

MAGIC = b"TIDPACK1"
_TAIL = struct.Struct("<IIQQ8s")
BLOCK_IDS = 1 << 16
#: Entries of a worker's lexicon; beyond them it starts anew (speed only, never the result).
LEXICON_ENTRIES = 1_300_000
#: Chunks that the library encodes at a time.
JOINT = 200
READ_BLOCKS = 16
#: Characters of a text that take part in the bounds of ranges (speed only: within a range whole texts are ordered).
RANGE_CHARS = 32


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id below `vocabulary`."""
    return max(1, (max(1, vocabulary) - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Each id in `bits` bits, lowest bit first; zero bits fill the last byte."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    wide = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(wide, axis=1, bitorder="little")[:, :bits], bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=count).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, dtype=np.uint8), bitorder="little", count=count * bits).reshape(-1, bits)
    wide = np.zeros((count, 32), dtype=np.uint8)
    wide[:, :bits] = flat
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


class Writer:
    def __init__(self, out, bits: int):
        self.out, self.bits, self.at = out, bits, 0
        self.offsets, self.rest, self.held = [0], [], 0
        self.doc_ids: list[int | None] = []
        self.first = [0]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.first.append(self.first[-1] + len(ids))
        self.rest.append(ids)
        self.held += len(ids)
        if self.held >= 4 * BLOCK_IDS:
            self._flush(False)

    def _flush(self, end: bool) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.zeros(0, dtype="<u4")
        whole = len(ids) if end else len(ids) // BLOCK_IDS * BLOCK_IDS
        for i in range(0, whole, BLOCK_IDS):
            data = pack(ids[i : min(whole, i + BLOCK_IDS)], self.bits)
            self.out.write(data)
            self.at += len(data)
            self.offsets.append(self.at)
        self.rest, self.held = [ids[whole:].copy()], len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        out, n = self.out, len(self.doc_ids)
        out.write(np.array(self.offsets, dtype="<u8").tobytes())
        out.write(np.array([d or 0 for d in self.doc_ids], dtype="<i8").tobytes())
        out.write(np.array([d is None for d in self.doc_ids], dtype=np.uint8).tobytes())
        out.write(np.array(self.first, dtype="<u8").tobytes())
        out.write(_TAIL.pack(self.bits, BLOCK_IDS, n, self.first[-1], MAGIC))


class Reader:
    """Random access to one file, over an open pyarrow input file."""

    def __init__(self, source):
        self.source = source
        end = source.size() - _TAIL.size
        self.bits, self.block, docs, self.n_ids, magic = _TAIL.unpack(source.read_at(_TAIL.size, end))
        if magic != MAGIC:
            raise ValueError("not a packed id file")
        sizes = [8 * (-(-self.n_ids // self.block) + 1), 8 * docs, docs, 8 * (docs + 1)]
        parts, at = [], end - sum(sizes)
        for n in sizes:
            parts.append(source.read_at(n, at))
            at += n
        self.offsets = np.frombuffer(parts[0], dtype="<u8").astype(np.int64)
        self.doc_ids = [None if null else d for d, null in zip(np.frombuffer(parts[1], dtype="<i8").tolist(), parts[2])]
        self.first = np.frombuffer(parts[3], dtype="<u8").astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids `start` to `stop` of the file; only the blocks that hold them are read."""
        if stop <= start:
            return np.zeros(0, dtype=np.uint32)
        a, b = start // self.block, -(-stop // self.block)
        data = self.source.read_at(int(self.offsets[b] - self.offsets[a]), int(self.offsets[a]))
        held = min(b * self.block, self.n_ids) - a * self.block
        return unpack(data, self.bits, held)[start - a * self.block : stop - a * self.block]

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """doc_id, first id, number of ids and CRC-32 of the ids, read from start to end in bounded pieces."""
        lo, held = 0, np.zeros(0, dtype=np.uint32)
        for doc_id, a, b in zip(self.doc_ids, self.first[:-1].tolist(), self.first[1:].tolist()):
            crc, at = 0, a
            while at < b:
                if at >= lo + len(held):
                    lo, held = at, self.ids(at, min(self.n_ids, (at // self.block + READ_BLOCKS) * self.block))
                part = held[at - lo : b - lo]
                crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                at += len(part)
            yield doc_id, a, b - a, crc


def lexicon(path: str) -> Lexicon:
    """The library's ids, by its defaults but for `add_special_tokens=False`: the text of an added token is that token.

    Only for byte-level files whose added tokens stand by themselves; others raise ValueError, as texts must not be cut there.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        described = json.load(f)
    cutter, added = described.get("pre_tokenizer") or {}, tokenizer.get_added_tokens_decoder()
    if described.get("normalizer") or cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space") or not cutter.get("use_regex", True):
        raise ValueError(f"{path}: only plain byte-level tokenizers")
    if any(t.lstrip or t.rstrip or t.single_word or any(map(str.isspace, t.content)) for t in added.values()):
        raise ValueError(f"{path}: an added token depends on what stands around it")
    # Bytes of each id's token: byte-level vocabularies write one character for each byte, added tokens are as they are.
    width = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), dtype=np.int64)
    for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
        width[i] = len(added[i].content.encode()) if i in added else len(token)

    def ids_of(texts: list[str]) -> list[bytes]:
        """The library encodes many chunks as one text, and their bytes tell which ids are whose. Chunks that could
        share white space with the next are encoded alone."""
        out: dict[str, bytes] = {}
        joint = [t for t in texts if t[:1] == " " and not t[-1].isspace()]
        alone = [t for t in texts if t[:1] != " " or t[-1].isspace()]
        for i in range(0, len(alone), JOINT):
            for t, e in zip(alone[i : i + JOINT], tokenizer.encode_batch_fast(alone[i : i + JOINT], add_special_tokens=False)):
                out[t] = np.array(e.ids, dtype="<u4").tobytes()
        for i in range(0, len(joint), JOINT):
            part = joint[i : i + JOINT]
            ids = np.array(tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.cumsum(np.fromiter((len(t.encode()) for t in part), dtype=np.int64, count=len(part)))
            cuts = np.searchsorted(np.cumsum(width[ids]), ends, side="left") + 1
            raw, cuts = ids.tobytes(), [0, *(cuts * 4).tolist()]
            out.update(zip(part, (raw[a:b] for a, b in zip(cuts, cuts[1:]))))
        return [out[t] for t in texts]

    return Lexicon(ids_of, LEXICON_ENTRIES)


def vocabulary_of(path: str) -> int:
    """One more than the largest id of a tokenizers file."""
    with open(path, encoding="utf-8") as f:
        described = json.load(f)
    return 1 + max([*described["model"]["vocab"].values(), *(t["id"] for t in described.get("added_tokens") or [])])


def write_files(df: DataFrame, path: str, vocabulary: int | None = None, folder: str | None = None, end_id: int | None = 0, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Encode the whole texts by the tokenizers file `path` and write them as packed id files in `folder`.

    Gives the manifest, one row a file in doc_id order: file, part, n_docs, n_tokens. `folder` has to be shared by
    all executors; by default it is a new one in the shared folder. `vocabulary` (by default the file's own) sets the bits.
    Documents are dealt by ranges of doc_id, whose bounds Spark samples, so no key order passes through one task; those of
    one doc_id, or of none, are dealt by how their texts begin.
    """
    folder = folder or new_path(df.sparkSession, "tokens")
    bits = bits_for(vocabulary_of(path) if vocabulary is None else vocabulary)
    end = np.array([] if end_id is None else [end_id], dtype="<u4")

    def run(batches):
        known, store, writer = worker_state(f"tokenizer {path}", lambda: lexicon(path)), None, None
        part = TaskContext.get().partitionId()
        fs, root = open_store(folder)
        name, passing = f"{root}/part-{part:06d}.ids", f"{root}/.{part:06d}-{uuid.uuid4().hex}"
        for batch in batches:
            for piece in slices(batch, text):
                if writer is None:
                    fs.create_dir(root, recursive=True)
                    store = fs.open_output_stream(passing)
                    writer = Writer(store, bits)
                ids, cuts = known.encode(piece.column(text))
                for d, a, b in zip(piece.column(doc_id).to_pylist(), cuts.tolist(), cuts[1:].tolist()):
                    writer.add(d, np.concatenate((ids[a:b], end)))
        if writer is not None:
            writer.close()
            store.close()
            fs.move(passing, name)
            yield pa.RecordBatch.from_pydict({"file": [f"part-{part:06d}.ids"], "part": pa.array([part], pa.int32()), "n_docs": [len(writer.doc_ids)], "n_tokens": [writer.first[-1]]})

    ranged = df.select(doc_id, text).repartitionByRange(F.col(doc_id), F.left(F.col(text), F.lit(RANGE_CHARS))).sortWithinPartitions(doc_id, text)
    manifest = saved(ranged.mapInArrow(run, "file string, part int, n_docs long, n_tokens long"), "manifest")
    return manifest.withColumn("folder", F.lit(folder))


def read_files(manifest: DataFrame) -> DataFrame:
    """Read the files of a manifest back, each by one task: doc_id, start (over all files), n_tokens, ids_crc32."""
    # One row a file: the files before it are summed over a table as small as the list of files.
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                fs, root = open_store(row["folder"])
                with fs.open_input_file(f"{root}/{row['file']}") as source:
                    held = []
                    for d, a, n, crc in Reader(source).documents():
                        held.append((d, row["base"] + a, n, crc))
                        if len(held) == 10_000:
                            yield _rows(held)
                            held = []
                    yield _rows(held)

    files = max(1, manifest.count())
    return based.select("folder", "file", "base").repartition(files, "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(held: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*held)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"])
