"""Token ids in binary shards, with a minimal perfect hash index over document keys.

`write` encodes every text and puts the ids, in ascending order of doc_id, into shard files in the folder it is given:

    header   8 longs: MAGIC, documents, distinct keys, ids, bits of the index, levels, bytes per id, 0
    levels   the bits of each level of the index, as longs
    index    the bit sets of all levels, one after the other, and the keys before each 64-bit word
    slots    for each key: a 32-bit fingerprint, the number of its first document and how many documents share it
    places   for each document: its key, whether the key is null, and its first id (one more entry closes the last)
    payload  the raw ids

Key lookup takes constant time: levels are tried in turn, at most LEVELS of them; a set bit's rank is the slot; the
fingerprint tells keys that are not there. Keys left over after the last level would be hashed again with the next seed.

A shard is written under a name of its attempt and then renamed, so a task that runs again leaves one whole file. Folders
can be on any store that Arrow's file systems reach. Files are read back by Spark.

A null text is empty: it holds the end id alone. A null doc_id sorts first and is a key of its own. Rows that share a
doc_id are one key with several documents, in order of a hash of their texts. An empty table writes no shard. Extra
columns are ignored."""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from meterloom.llm import textkit

MAGIC = 0x31565444494B4F54
END = 2
#: Ids of a shard at most, unless one document has more.
SHARD_IDS = 1 << 21
LEVELS = 48
#: Words whose ids a task keeps.
KEPT = 500_000
#: Words that are encoded as one text.
JOINED = 1_000
DIGESTS = "shard int, part int, doc_id long, at long, n_tokens long, ids_crc32 long"


_encoders: dict[tuple[str, str], "Encoder"] = {}
_RUN = re.compile(r" (?:\s|\Z)")
#: How byte-level tokens spell a space.
_SPACE = "\u0120"


class Encoder:
    """Ids as bytes, by the tokenizers library. Byte-level pieces begin before each single space that a word follows, and
    before a comma or full stop that ends a word's letters. So a text's ids are those of its words, each with the space
    before it, and a word the task met before isn't encoded again. New words are encoded as one text, whose ids are cut
    where a token begins with a space. Other tokenizers get whole texts."""

    def __init__(self, path: str, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.dtype, self.known, self.older = Tokenizer.from_file(path), dtype, {}, {}
        self.splits = '"ByteLevel"' in self.tokenizer.to_str() and self.tokenizer.normalizer is None
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.end = np.array([END], dtype).tobytes()
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for token, i in vocabulary.items() if token.startswith(_SPACE)]] = True

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _spaced(self, words: list[str]) -> list[bytes]:
        """The ids of each word with the space before it, for words without a space of their own."""
        out, width = [], np.dtype(self.dtype).itemsize
        for i in range(0, len(words), JOINED):
            part = words[i:i + JOINED]
            ids = self._ids([" " + " ".join(part)])[0]
            cuts = [*(np.flatnonzero(self.begins[np.frombuffer(ids, self.dtype)]) * width).tolist(), len(ids)]
            out += [ids[a:b] for a, b in zip(cuts, cuts[1:])] if len(cuts) == len(part) + 1 else self._ids([" " + w for w in part])
        return out

    @classmethod
    def of_process(cls, path: str, dtype: str) -> "Encoder":
        """One encoder for all tasks of a Python worker, so that its words stay known."""
        if (path, dtype) not in _encoders:
            _encoders[path, dtype] = cls(path, dtype)
        return _encoders[path, dtype]

    @staticmethod
    def _words(text: str) -> list[str]:
        """The words after each space; one that is empty or begins with white space stays with the word before it."""
        words = text.split(" ")
        if not _RUN.search(text):
            return words
        out = words[:1]
        for w in words[1:]:
            if w and not w[0].isspace():
                out.append(w)
            else:
                out[-1] += " " + w
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.splits or any(s in text for s in self.special for text in texts):
            return [ids + self.end for ids in self._ids(texts)]
        split = [self._words(text) for text in texts]
        heads = self._ids([words.pop(0) for words in split])
        self._learn(set().union(*split))
        return [b"".join([head, *map(self.known.__getitem__, words), self.end]) for head, words in zip(heads, split)]

    def _learn(self, words: set[str]) -> None:
        """Makes all words known. What was not met for KEPT words is forgotten."""
        if len(self.known) > KEPT:
            self.known, self.older = {}, self.known
        missing = words.difference(self.known)
        old = missing & self.older.keys()
        self.known.update((w, self.older[w]) for w in old)
        missing -= old
        ending = {w for w in missing if w[-1] in ",." and w[-2:-1].isalpha()}
        bare = ((missing - ending) | {w[:-1] for w in ending}).difference(self.known)
        odd, plain = [w for w in bare if " " in w], [w for w in bare if " " not in w]
        self.known.update(zip(odd, self._ids([" " + w for w in odd])))
        self.known.update(zip(plain, self._spaced(plain)))
        if ending:
            marks = dict(zip(",.", self._ids([",", "."])))
            self.known.update((w, self.known[w[:-1]] + marks[w[-1]]) for w in ending)


def _keys(ids: np.ndarray, null: np.ndarray) -> np.ndarray:
    return textkit.mix(textkit.mix(ids.view(np.uint64)) ^ np.where(null, np.uint64(0xA5A5A5A5A5A5A5A5), np.uint64(0)))


def _place(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    return (textkit.mix(keys + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))) % np.uint64(bits)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """The minimal perfect hash of distinct keys: bits of each level, and all bits. A level keeps the keys that have a
    place of their own in it; the others go to the next."""
    sizes, sets = [], []
    while len(keys) and len(sizes) < LEVELS:
        bits = -(-max(64, 2 * len(keys)) // 64) * 64
        at = _place(keys, len(sizes), bits)
        alone = np.bincount(at, minlength=bits) == 1
        sizes.append(bits)
        sets.append(alone)
        keys = keys[~alone[at]]
    if len(keys):
        raise ValueError("keys that agree in 64 bits of their hash")
    return sizes, np.concatenate(sets) if sets else np.zeros(0, bool)


def ranks(keys: np.ndarray, sizes: list[int], bits: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The slot of each key by the index, -1 where no level has its bit."""
    out, left, start = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    running = np.concatenate([[0], np.cumsum(bits)])
    for level, size in enumerate(sizes):
        at = start + _place(keys[left], level, size)
        hit = bits[at]
        word = at[hit] // 64
        out[left[hit]] = before[word] + running[at[hit]] - running[word * 64]
        left, start = left[~hit], start + size
    return out


_SLOT = [("print", "<u4"), ("first", "<u4"), ("n", "<u4")]


@dataclass
class Shard:
    """A shard as it was read."""
    sizes: np.ndarray
    bits: np.ndarray
    before: np.ndarray
    slots: np.ndarray
    ids: np.ndarray
    null: np.ndarray
    places: np.ndarray
    payload: np.ndarray

    @classmethod
    def read(cls, content: bytes) -> "Shard":
        magic, docs, keys, n_ids, bits, levels, width, _ = np.frombuffer(content, "<i8", 8).tolist()
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        at = 64

        def take(dtype, n):
            nonlocal at
            got = np.frombuffer(content, dtype, n, at)
            at += got.nbytes
            return got

        sizes, packed, before = take("<i8", levels), take("u1", bits // 8), take("<i8", bits // 64)
        slots, ids, null, places = take(_SLOT, keys), take("<i8", docs), take("u1", docs), take("<i8", docs + 1)
        return cls(sizes, np.unpackbits(packed, bitorder="little").astype(bool), before, slots, ids, null.astype(bool), places,
                   take(f"<u{width}", n_ids))

    def slot(self, ids: np.ndarray, null: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that are not there."""
        keys = _keys(ids, null)
        out = ranks(keys, self.sizes.tolist(), self.bits, self.before)
        found = np.flatnonzero(out >= 0)
        out[found[self.slots["print"][out[found]] != (keys[found] >> np.uint64(32)).astype(np.uint32)]] = -1
        return out

    def documents(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of all documents of a key."""
        slot = self.slot(np.array([doc_id or 0], np.int64), np.array([doc_id is None]))[0]
        if slot < 0:
            return []
        _, first, n = self.slots[slot].tolist()
        return [self.payload[self.places[d]:self.places[d + 1]] for d in range(first, first + n)]


def packed(ids: np.ndarray, null: np.ndarray, encoded: list[bytes], dtype: str) -> bytes:
    """A shard file of documents in order."""
    lengths = np.array([len(e) // np.dtype(dtype).itemsize for e in encoded], np.int64)
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])
    first = np.flatnonzero(new)
    keys = _keys(ids[first], null[first])
    sizes, bits = build(keys)
    before = np.concatenate([[0], np.cumsum(bits.reshape(-1, 64).sum(1))])[:-1].astype("<i8")
    slots, order = np.zeros(len(keys), _SLOT), ranks(keys, sizes, bits, before)
    slots["print"][order], slots["first"][order] = (keys >> np.uint64(32)).astype(np.uint32), first
    slots["n"][order] = np.diff(np.concatenate([first, [len(ids)]]))
    header = np.array([MAGIC, len(ids), len(keys), lengths.sum(), len(bits), len(sizes), np.dtype(dtype).itemsize, 0], "<i8")
    return b"".join([header.tobytes(), np.array(sizes, "<i8").tobytes(), np.packbits(bits, bitorder="little").tobytes(), before.tobytes(),
                     slots.tobytes(), ids.astype("<i8").tobytes(), null.astype("u1").tobytes(),
                     np.concatenate([[0], np.cumsum(lengths)]).astype("<i8").tobytes(), *encoded])


def _put(folder: str, name: str, content: bytes) -> None:
    store, path = fs.FileSystem.from_uri(folder)
    own = f"{path}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(content)
    store.move(own, f"{path}/{name}")


def write(documents: DataFrame, folder: str, tokenizer: str, dtype: str = "<u2", shard_ids: int = SHARD_IDS) -> DataFrame:
    """Writes the shards and returns (shard, part, documents, ids), a row per file, after it is written. `tokenizer`: the
    path of a tokenizers file; `dtype`: the width of an id in the payload, enough for its vocabulary."""
    spark = documents.sparkSession
    uri = folder if "://" in folder else folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") else f"file://{folder}"
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path, recursive=True)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    dealt = texts.repartitionByRange(*order[:2]).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = Encoder.of_process(tokenizer, dtype), TaskContext.get().partitionId()
        docs, encoded, held, part = [], [], 0, 0

        def flush():
            ids = np.array([d or 0 for d in docs], np.int64)
            _put(uri, f"{shard:08d}-{part:06d}.ids", packed(ids, np.array([d is None for d in docs]), encoded, dtype))
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([part], pa.int32()), pa.array([len(docs)], pa.int64()),
                                               pa.array([held], pa.int64())], ["shard", "part", "documents", "ids"])

        for batch in textkit.cuts(batches, limit=1 << 20):
            for doc, own in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text").to_pylist())):
                n = len(own) // np.dtype(dtype).itemsize
                if docs and held + n > shard_ids:
                    yield flush()
                    docs, encoded, held, part = [], [], 0, part + 1
                docs.append(doc)
                encoded.append(own)
                held += n
        if docs:
            yield flush()

    return dealt.mapInArrow(run, "shard int, part int, documents long, ids long")


def digests(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per document, read back from the files through the index: doc_id, start, n_tokens, ids_crc32."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                shard, part = map(int, path.rsplit("/", 1)[1].removesuffix(".ids").split("-"))
                got = Shard.read(content.as_buffer())
                slot = got.slot(got.ids, got.null)
                first = got.slots["first"][slot].astype(np.int64)
                doc = first + np.arange(len(first)) - np.searchsorted(first, first)  # the key's documents, in turn
                starts, ends = got.places[doc], got.places[doc + 1]
                crc = [zlib.crc32(got.payload[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(doc), shard, np.int32)), pa.array(np.full(len(doc), part, np.int32)),
                    pa.array(got.ids[doc], mask=got.null[doc]), pa.array(starts), pa.array(ends - starts), pa.array(crc, pa.int64())],
                    ["shard", "part", "doc_id", "at", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder).select("path", "content")
    earlier = W.orderBy("shard", "part").rowsBetween(W.unboundedPreceding, -1)
    bases = manifest.select("shard", "part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base"))
    return files.mapInArrow(run, DIGESTS).join(bases, ["shard", "part"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
