"""Token ids in bit-packed shard files.

A shard holds the ids of a run of documents in ascending doc_id order, every id in the minimum number
of bits of the vocabulary. Layout, all little-endian::

    magic "SGLTOK01" | width u8, 7 zero bytes | blocks | index | footer
    block   : BLOCK ids (the last one fewer), packed at ``width`` bits, padded to whole 8 bytes
    index   : doc_id i64[n_docs] | null flags u8[n_docs] | first id u64[n_docs + 1] | block offset u64[n_blocks + 1]
    footer  : n_docs u64 | n_ids u64 | n_blocks u64 | index offset u64 | magic

A block unpacks in numpy without a loop over ids; block offsets and first ids give random access to
any document without reading others. A task writes a file under a name of its own and renames it, so
a task that runs again after a lost executor replaces the file with the same bytes.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, in_arrow, share_code, stored, text_of, work_folder

MAGIC = b"SGLTOK01"
BLOCK = 1 << 16
HEADER = 16
FOOTER = 40
END_ID = 1
#: Words whose ids a worker remembers; beyond that it forgets them all and starts anew.
MEMORY = 400_000
#: Bytes of text of a shard, in expectation, and of the texts encoded at once.
SHARD_BYTES = 64 << 20
CHUNK = 1 << 20
#: Words that the library gets as one text.
JOINED = 256
#: Marks that never join a letter or digit before them, so the ids of a word and its trailing marks add up.
_MARKS = ".,!?;:%*$&#"


def bits_for(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids, each in ``width`` bits, lowest bit first; padded to whole 8 bytes."""
    ids = np.ascontiguousarray(ids, "<u4")
    if width in (8, 16, 32):
        raw = ids.astype(f"<u{width // 8}").tobytes()
    else:
        raw = np.packbits(np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little"), bitorder="little").tobytes()
    return raw + bytes(-len(raw) % 8)


def unpack(raw: bytes, n: int, width: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(raw, f"<u{width // 8}", n).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * width, bitorder="little").reshape(n, width)
    full = np.zeros((n, 32), np.uint8)
    full[:, :width] = bits
    return np.packbits(full, axis=1, bitorder="little").view("<u4").ravel()


def filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of the shared folder as an executor's Python reaches it: a mounted folder, HDFS
    (through libhdfs) or an object store (``s3a`` is Spark's name for ``s3``)."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", folder))


class ShardWriter:
    """Writes one shard to a binary stream, block by block."""

    def __init__(self, stream, width: int):
        self.stream, self.width, self.held, self.n_held = stream, width, [], 0
        self.ids, self.nulls, self.first, self.blocks = [], [], [0], [HEADER]
        stream.write(MAGIC + bytes([width]) + bytes(7))

    def add(self, doc_id: int | None, tokens: np.ndarray) -> None:
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.first.append(self.first[-1] + len(tokens))
        self.held.append(tokens)
        self.n_held += len(tokens)
        if self.n_held >= BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        line = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        whole = len(line) if last else len(line) // BLOCK * BLOCK
        for at in range(0, whole, BLOCK):
            raw = pack(line[at : min(at + BLOCK, whole)], self.width)
            self.stream.write(raw)
            self.blocks.append(self.blocks[-1] + len(raw))
        self.held = [line[whole:]]
        self.n_held = len(line) - whole

    def close(self) -> tuple[int, int]:
        self._flush(True)
        at = self.blocks[-1]
        self.stream.write(np.array(self.ids, "<i8").tobytes() + np.array(self.nulls, np.uint8).tobytes() + np.array(self.first, "<u8").tobytes() + np.array(self.blocks, "<u8").tobytes())
        n = len(self.ids), self.first[-1], len(self.blocks) - 1, at
        self.stream.write(np.array(n, "<u8").tobytes() + MAGIC)
        return n[0], n[1]


class Shard:
    """A shard opened for reading: ``tokens(a, b)`` reads only the blocks that hold ids a to b."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        foot = self._at(size - FOOTER, FOOTER)
        if foot[-8:] != MAGIC or self._at(0, 8) != MAGIC:
            raise ValueError("not a token shard")
        self.n_docs, self.n_ids, self.n_blocks, at = (int(x) for x in np.frombuffer(foot, "<u8", 4))
        self.width = self._at(8, 1)[0]
        raw = self._at(at, size - FOOTER - at)
        cut = np.cumsum([0, 8 * self.n_docs, self.n_docs, 8 * (self.n_docs + 1), 8 * (self.n_blocks + 1)])
        part = [raw[a:b] for a, b in zip(cut, cut[1:], strict=False)]
        self.doc_ids, self.nulls = np.frombuffer(part[0], "<i8"), np.frombuffer(part[1], np.uint8).astype(bool)
        self.first, self.blocks = np.frombuffer(part[2], "<u8").astype(np.int64), np.frombuffer(part[3], "<u8").astype(np.int64)

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(int(offset))
        return self.file.read(int(size))

    def tokens(self, a: int, b: int) -> np.ndarray:
        if b <= a:
            return np.zeros(0, np.uint32)
        x, y = a // BLOCK, (b - 1) // BLOCK + 1
        raw = self._at(self.blocks[x], self.blocks[y] - self.blocks[x])
        out = []
        for k in range(x, y):
            n = min(BLOCK, self.n_ids - k * BLOCK)
            out.append(unpack(raw[self.blocks[k] - self.blocks[x] : self.blocks[k + 1] - self.blocks[x]], n, self.width))
        return np.concatenate(out)[a - x * BLOCK : b - x * BLOCK]

    def document(self, k: int) -> np.ndarray:
        return self.tokens(int(self.first[k]), int(self.first[k + 1]))


#: Fixed value: a pre-tokenizer's pattern under which a text's ids are those of its words, as it matches
#: neither white space nor a mark together with the letter or digit before.
_BY_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def separable(tok) -> bool:
    """Whether ids of words add up to those of texts: the pattern above, what it leaves being dropped, behind
    normalizers that look at single characters, or at white space alone."""
    own = json.loads(tok.to_str())
    if own.get("truncation") or own.get("padding") or own.get("post_processor"):
        return False
    parts = lambda x, name: [] if x is None else x[name] if x["type"] == "Sequence" else [x]
    first = (parts(own["pre_tokenizer"], "pretokenizers") or [{}])[0]
    kept = first.get("type") == "Split" and first["pattern"] == {"Regex": _BY_WORDS} and (first["behavior"], first["invert"]) == ("Removed", True)
    space = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    return kept and all(x in ({"type": "NFC"}, {"type": "Lowercase"}, space) for x in parts(own["normalizer"], "normalizers"))


def separator(tok) -> tuple[str, int] | None:
    """A special token and its id that stands between words without changing theirs: it is found in the text as
    it stands, takes no white space with it, and starts with ``<|``, so plain words hold no part of it."""
    for x in json.loads(tok.to_str())["added_tokens"]:
        if x["special"] and x["content"].startswith("<|") and not (x["normalized"] or x["single_word"] or x["lstrip"] or x["rstrip"]):
            return x["content"], x["id"]
    return None


class Encoder:
    """Ids of texts by the tokenizers library. If ids of words add up, each word is encoded once and
    remembered; otherwise whole texts are encoded."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has its own core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.by_words = separable(self.tok)
        self.between = separator(self.tok)
        self.memory: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_joining(self, words: list[str]) -> list[bytes]:
        """Ids of words, many to a text with a special token between: one call of the library a text."""
        if self.between is None:
            return self._library(words)
        mark, own = self.between
        groups, out = [words[k : k + JOINED] for k in range(0, len(words), JOINED)], []
        for group, x in zip(groups, self.tok.encode_batch_fast([mark.join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(x.ids, "<u4")
            at = (4 * np.flatnonzero(ids == own)).tolist()
            if len(at) != len(group) - 1:
                out += self._library(group)
                continue
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *(k + 4 for k in at)], [*at, len(raw)], strict=True)]
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_words:
            return [np.frombuffer(x, "<u4") for x in self._library(texts)]
        memory = self.memory
        if len(memory) > MEMORY:
            memory.clear()
        cut = [_words(t) for t in texts]
        new = set().union(*cut).difference(memory)
        # a word with marks behind it is two words here; special tokens stay whole
        core = {w: c for w in new if "<|" not in w and (c := w.rstrip(_MARKS)) != w and c[-1:].isalnum()}
        parts = (new - core.keys()).union(core.values(), (w[len(c) :] for w, c in core.items())).difference(memory)
        odd = [w for w in parts if "<|" in w]
        plain = list(parts.difference(odd))
        memory.update(zip(odd, self._library(odd), strict=True))
        memory.update(zip(plain, self._by_joining(plain), strict=True))
        memory.update((w, memory[c] + memory[w[len(c) :]]) for w, c in core.items())
        return [np.frombuffer(b"".join(map(memory.__getitem__, words)), "<u4") for words in cut]


#: White space beside that of ``WORD`` that ``str.split`` would cut at.
_OTHER = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_WORD = re.compile(WORD)


def _words(text: str) -> list[str]:
    """Words between spaces and ``\\t`` to ``\\r``; other white space is left to the library."""
    return _WORD.findall(text) if _OTHER.search(text) else text.split()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str]]]:
    """Ids and texts of parts of the batches of about ``CHUNK`` characters."""
    for b in batches:
        ids, texts, size = [], [], 0
        for i, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            ids.append(i)
            texts.append(x.as_py())
            size += len(texts[-1])
            if size >= CHUNK:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


def _writer(folder: str, path: str, width: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        shard = TaskContext.get().partitionId()
        final, own = f"{base}/shard-{shard:06d}.tok", f"{base}/_{shard:06d}-{uuid.uuid4().hex}"
        enc, end = encoder(path), np.array([end_id], "<u4")
        with fs.open_output_stream(own) as stream:
            out = ShardWriter(stream, width)
            for ids, texts in _chunks(batches):
                for i, tokens in zip(ids, enc.encode(texts), strict=True):
                    out.add(i, np.concatenate([tokens, end]))
            n_docs, n_ids = out.close()
        if fs.get_file_info(final).type == pafs.FileType.File:  # of an attempt before: the same bytes
            fs.delete_file(own)
        else:
            fs.move(own, final)
        yield pa.RecordBatch.from_pydict({"shard": [shard], "n_docs": [n_docs], "n_ids": [n_ids]})

    return run


def write_shards(docs: DataFrame, folder: str, path: str, vocabulary: int, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode ``docs(doc_id, text, ...)`` and write shards below ``folder``; returns the manifest
    ``(shard, n_docs, n_ids)``, in which shards of lower number hold lower doc_ids. Their number follows
    from the bytes of all texts; nulls and other cases are those of ``pack_documents``."""
    spark = docs.sparkSession
    share_code(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of())
    n = -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 1) // shard_bytes)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return stored(in_arrow(rows, _writer(folder, path, bits_for(vocabulary), end_id), "shard long, n_docs long, n_ids long"))


def _reader(folder: str):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        for b in batches:
            for shard, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with fs.open_input_file(f"{base}/shard-{shard:06d}.tok") as file:
                    s = Shard(file)
                    for a in range(0, s.n_docs, 1024):
                        z = min(a + 1024, s.n_docs)
                        line, off = s.tokens(int(s.first[a]), int(s.first[z])).astype("<u4"), int(s.first[a])
                        crc = [zlib.crc32(line[int(s.first[k]) - off : int(s.first[k + 1]) - off]) for k in range(a, z)]
                        ids = pa.array(s.doc_ids[a:z], mask=s.nulls[a:z])
                        yield pa.RecordBatch.from_arrays([ids, pa.array(s.first[a:z] + before), pa.array(np.diff(s.first[a : z + 1])), pa.array(crc, pa.int64())], schema=schema)

    return run


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files."""
    share_code(manifest.sparkSession)
    along = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.where("n_docs > 0").select("shard", F.coalesce(F.sum("n_ids").over(along), F.lit(0)).cast("long").alias("before"))
    return in_arrow(placed.repartition(max(manifest.count(), 1), "shard"), _reader(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def default_vocabulary() -> tuple[str, int]:
    """Path and size of the tokenizer that the queries use."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path).get_vocab_size()


def pack_documents(docs: DataFrame, path: str | None = None, vocabulary: int | None = None) -> DataFrame:
    """Encode, write and read back: a row ``(doc_id, start, n_tokens, ids_crc32)`` for each input row.

    Nulls: a null text is the empty one, which is the end id alone; null doc_ids come first. Very long
    texts are encoded whole. Ties: rows of one doc_id stand in the order of their text's hash, and those
    of one text as well are the same in the files. Repeated rows are documents of their own. An empty
    table gives no rows. Extra columns of any name are left out. The files lie in the shared folder."""
    if path is None or vocabulary is None:
        path, vocabulary = default_vocabulary()
    folder = work_folder(docs.sparkSession)
    return read_shards(write_shards(docs, folder, path, vocabulary), folder)
