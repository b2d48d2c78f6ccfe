"""Token ids of documents in binary shards, with a minimal perfect hash index over the document keys.

Documents are range-partitioned and sorted by key (rows of one doc_id by a hash of their texts, then by their place, so
that no id has to fit one task); each task encodes its range and writes three files under random names: the raw ids
(little-endian, 16 bits wide if the vocabulary allows, else 32; the first eight bytes of the file hold the width), the
index, and the list of keys.  What the tasks return, one row per shard, is staged and so names the files that count: those
of lost or repeated tasks are never read.

Index of a shard: levels of bit arrays.  A key whose bit on a level no other key wants stays there, the others go to
the next level; a key's rank among all set bits is its slot.  Slots hold a 32-bit fingerprint of the key, the offset
and the length of its ids.  A lookup takes one probe per level, and keys that are not there fail by fingerprint.

Defined cases: null or empty text: the end id alone; null doc_id: before all others; rows of one doc_id: told apart
by their number in their shard; empty table: no rows; other columns are not read.
"""

from __future__ import annotations

import io
import os
import re
import string
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlake.session import scratch_path

from .common import staged
from .files import file_system, make_folder, read_bytes, write_bytes
from .text import mix

END = 2
#: Bits per key on a level.
GAMMA = 2
#: Characters encoded in one call of the tokenizer.
CHARS = 200_000


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def key_words(ids: np.ndarray, null: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """One 64-bit word per (doc_id or null, number among rows of that id)."""
    x = mix(ids.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    x = np.where(null, np.uint64(0x6A09E667F3BCC909), x)
    return mix(x + mix(nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


class PerfectIndex:
    """A minimal perfect hash over distinct 64-bit keys, with fingerprint, offset and length per key."""

    def __init__(self, levels: list[np.ndarray], values: np.ndarray):
        self.levels, self.values = levels, values
        self.ranks, total = [], 0
        for bits in levels:
            self.ranks.append(total + np.concatenate([[0], np.cumsum(bits)]))
            total += int(bits.sum())

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        return (mix(keys + salt) % np.uint64(size)).astype(np.int64)

    @staticmethod
    def _print(keys: np.ndarray) -> np.ndarray:
        return mix(keys ^ np.uint64(0xA54FF53A5F1D36F1)) >> np.uint64(32)

    @classmethod
    def build(cls, keys: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> PerfectIndex:
        levels, left = [], keys
        while len(left):
            if len(levels) > 64:
                raise ValueError("keys are not distinct")
            size = GAMMA * len(left)
            at = cls._place(left, len(levels), size)
            bits = np.bincount(at, minlength=size) == 1
            levels.append(bits)
            left = left[~bits[at]]
        index = cls(levels, np.zeros((len(keys), 3), np.uint64))
        index.values[index.slots(keys)] = np.stack([cls._print(keys), offsets.astype(np.uint64), lengths.astype(np.uint64)], 1)
        return index

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of every key; -1 if no level has it."""
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = self._place(keys[open_], level, len(bits))
            hit = bits[at]
            out[open_[hit]] = rank[at[hit]]
            open_ = open_[~hit]
        return out

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each key is there, and offset and length of its ids."""
        slot = self.slots(keys)
        if not len(self.values):
            return np.zeros(len(keys), bool), slot * 0, slot * 0
        v = self.values[np.maximum(slot, 0)]
        return (slot >= 0) & (v[:, 0] == self._print(keys)), v[:, 1].astype(np.int64), v[:, 2].astype(np.int64)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, values=self.values, sizes=np.array([len(b) for b in self.levels], np.int64),
                 bits=np.packbits(np.concatenate([*self.levels, np.zeros(0, bool)])))
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> PerfectIndex:
        z = np.load(io.BytesIO(data))
        cuts = np.concatenate([[0], np.cumsum(z["sizes"])]).astype(np.int64)
        bits = np.unpackbits(z["bits"])[:cuts[-1]].astype(bool)
        return cls([bits[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], z["values"])


#: ASCII white space: the tokenizer drops it and joins nothing across it, so what lies between has ids of its own.
BLANKS = "\t\n\v\f\r"
#: Characters of the strings a worker remembers the ids of at most, and the number of strings of one generation.
KNOWN_CHARS, KNOWN = 64, 300_000
#: Characters looked at one by one: Latin, Greek, Cyrillic, Armenian.
LETTERS = "".join(map(chr, range(0x30, 0x590)))
#: Bytes before the ids in a file of ids.
HEADER = 8


class Pieces:
    """What may be taken apart before encoding without a change of ids, found out from the tokenizer itself."""

    def __init__(self, tokenizer):
        def ids(text: str) -> list[int]:
            return tokenizer.encode(text, add_special_tokens=False).ids

        self.tokenizer = tokenizer
        self.marks = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        #: Upper case gives the ids of lower case.
        self.no_case = all(ids(w) == ids(w.lower()) for w in ("A", "The", "QXZ", "MiXeD"))
        #: A run of these at the end of a word is a piece of its own; none of them is part of a mark.  ``solid`` are the
        #: characters that they may follow: normalization turns some others into ones that join a run.
        self.ends = self._ends(ids)
        self.solid = frozenset(c for c in LETTERS if self.ends and c.isalnum() and ids(c + self.ends[0]) == ids(c) + ids(self.ends[0]))
        #: A bar between blanks is one id, which text without a bar never has; it separates strings encoded in one call.
        bar = ids("|")
        alone = len(bar) == 1 and "|" in (tokenizer.id_to_token(bar[0]) or "") and ids("a | b") == ids("a") + bar + ids("b")
        self.bar = bar[0] if alone else None
        #: Letters that normalization leaves alone and that stay together in one piece, and what the model reads for them.
        self.letters = self._letters(ids)
        self.is_word = re.compile(f"[{''.join(map(chr, self.letters))}]+").fullmatch if self.letters else lambda _: None

    def _ends(self, ids) -> str:
        before, in_marks = self.tokenizer.pre_tokenizer, set("".join(self.marks))
        if before is None:
            return ""

        def apart(run: str) -> bool:
            return all([p for p, _ in before.pre_tokenize_str(w + run)][:1] == [p for p, _ in before.pre_tokenize_str(w)]
                       and ids(w + run) == ids(w) + ids(run) for w in ("word", "e"))

        ends = [c for c in string.punctuation if c not in in_marks and apart(c)]
        return "".join(ends) if all(apart(a + b) for a in ends for b in ends) else ""

    def _letters(self, ids) -> dict[int, str]:
        normal, before = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if before is None or any(m.strip().isalpha() for m in self.marks):
            return {}
        out = {}
        for c in LETTERS:
            if c.isalpha() and c.islower() and (normal is None or normal.normalize_str(f"a{c}a") == f"a{c}a"):
                found = [p for p, _ in before.pre_tokenize_str(f"a{c}a")]
                if len(found) == 1 and found[0][:1] == found[0][-1:] == "a":
                    out[ord(c)] = found[0][1:-1]
        every = "".join(map(chr, out))
        together = normal is None or normal.normalize_str(every) == every
        together = together and [p for p, _ in before.pre_tokenize_str(every)] == [every.translate(out)]
        samples = [*every, *(a + b for a in every[:2] for b in every), every, every[::-1], "the", "word", "internationally", "a" * 300]
        together = together and all([t.id for t in self.tokenizer.model.tokenize(w.translate(out))] == ids(w) for w in samples)
        return out if together else {}

    def lowered(self, text: str) -> str:
        return text.lower() if self.no_case and text.isascii() and not any(m[:2] in text for m in self.marks) else text

    def encode(self, strings: list[str], dtype: str) -> Iterator[tuple[str, bytes]]:
        """(string, its ids), for blank-free strings."""
        tokenize, letters, code, others = self.tokenizer.model.tokenize, self.letters, {"<u2": "H", "<u4": "I"}[dtype], []
        for w in strings:
            if self.is_word(w):  # one piece as it stands: only the model is left to do
                found = [t.id for t in tokenize(w.translate(letters))]
                yield w, struct.pack(f"<{len(found)}{code}", *found)
            else:
                others.append(w)
        together = [w for w in others if w and "|" not in w] if self.bar is not None else []
        if together:
            flat = np.array(self.tokenizer.encode_batch_fast([" | ".join([*together, ""])], add_special_tokens=False)[0].ids, dtype)
            cuts = (np.flatnonzero(flat == self.bar) * flat.itemsize).tolist()
            if len(cuts) != len(together):
                raise ValueError("a separator is missing among the ids")
            raw = flat.tobytes()
            yield from zip(together, (raw[a:b] for a, b in zip([0, *(c + flat.itemsize for c in cuts)], cuts)), strict=True)
        apart = others if self.bar is None else [w for w in others if not w or "|" in w]
        for w, e in zip(apart, self.tokenizer.encode_batch_fast(apart, add_special_tokens=False), strict=True):
            yield w, np.array(e.ids, dtype).tobytes()


def _learn(missing: set[str], pieces: Pieces, known: dict[str, bytes], old: dict[str, bytes], dtype: str) -> list[str]:
    """Brings all of ``missing`` into ``known``; returns those too long to stay there."""
    new, ended, heads, runs = set(), [], [], []
    for w in missing:
        if w in old:
            known[w] = old[w]
            continue
        head = w.rstrip(pieces.ends)
        if len(head) == len(w) or head[-1:] not in pieces.solid:
            new.add(w)
            continue
        run = w[len(head):]
        ended.append(w)
        heads.append(head)
        runs.append(run)
        for part in (head, run):
            if part in old:
                known[part] = old[part]
            elif part not in known:
                new.add(part)
    known.update(pieces.encode(list(new), dtype))
    for w, head, run in zip(ended, heads, runs, strict=True):
        known[w] = known[head] + known[run]
    return [w for w in chain(new, ended) if len(w) > KNOWN_CHARS]


def _encoded(texts: list[str | None], tokenizer, known: dict[str, bytes], old: dict[str, bytes] | None = None,
             dtype: str = "<u4", pieces: Pieces | None = None) -> Iterator[np.ndarray]:
    """Ids of each whole text and the end id.  ``known`` and ``old`` hold ids of blank-separated strings met before, so
    that each is encoded once: a string used again moves to ``known``; when that is full it becomes ``old``, which is
    forgotten."""
    old, pieces = {} if old is None else old, pieces or Pieces(tokenizer)
    end = np.array([END], dtype).tobytes()
    at = 0
    while at < len(texts):
        parts, size = [], 0
        while at < len(texts) and size < CHARS:
            text = pieces.lowered(texts[at] or "")
            for blank in BLANKS:
                text = text.replace(blank, " ")
            parts.append(text.split(" "))
            size, at = size + len(text), at + 1
        long = _learn(set().union(*parts).difference(known), pieces, known, old, dtype)
        for p in parts:
            yield np.frombuffer(b"".join([*map(known.__getitem__, p), end]), dtype)
        for w in long:
            del known[w]
        if len(known) > KNOWN:
            old.clear()
            old.update(known)
            known.clear()


class Encoder:
    """A tokenizer, the width of its ids and the strings it met."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = Pieces(self.tokenizer)
        self.dtype = "<u2" if max(self.tokenizer.get_vocab_size(), END + 1) <= 1 << 16 else "<u4"
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        return _encoded(texts, self.tokenizer, self.known, self.old, self.dtype, self.pieces)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker, which Spark uses for many tasks: later tasks find the strings of earlier ones."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _numbers(ids: pa.Array, last: tuple) -> tuple[np.ndarray, tuple]:
    """The number of each row among the rows of its id; rows come sorted, ``last`` is the (id, number) before."""
    out = np.zeros(len(ids), np.int64)
    for i, x in enumerate(ids.to_pylist()):
        last = (x, last[1] + 1 if last[0] == x and last[1] >= 0 else 0)
        out[i] = last[1]
    return out, last


def _write(batches: Iterator[pa.RecordBatch], folder: str, path: str) -> Iterator[pa.RecordBatch]:
    made, name, part = encoder(path), uuid.uuid4().hex, TaskContext.get().partitionId()
    width = np.dtype(made.dtype).itemsize
    listed, lengths, last = [], [], (None, -1)
    system, at = file_system(f"{folder}/{name}.ids")
    with system.open_output_stream(at, compression=None) as out:
        out.write(np.array([width], "<u8").tobytes())
        for batch in batches:
            ids = batch.column("doc_id")
            nth, last = _numbers(ids, last)
            listed.append((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), nth))
            for tokens in made.encode(batch.column("text").to_pylist()):
                out.write(tokens.tobytes())
                lengths.append(len(tokens))
    if not lengths:
        return
    n = np.array(lengths, np.int64)
    ids, null, nth = (np.concatenate(c) for c in zip(*listed, strict=True))
    write_bytes(f"{folder}/{name}.mph", PerfectIndex.build(key_words(ids, null, nth), np.cumsum(n) - n, n).dump())
    out = io.BytesIO()
    np.savez(out, ids=ids, null=null, nth=nth)
    write_bytes(f"{folder}/{name}.keys", out.getvalue())
    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([part], pa.int32()), pa.array([int(n.sum())]), pa.array([len(n)])],
                                     names=["name", "part", "n_ids", "n_docs"])


def write_shards(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the shards; returns one row per shard: folder, name, part (shards in key order), number of ids and
    documents, and the number of ids before it."""
    spark, path = docs.sparkSession, path or vocabulary()
    folder = scratch_path(spark, "ids")
    make_folder(folder)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark"),
                        F.monotonically_increasing_id().alias("place"))
    key = ["doc_id", "mark", "place"]
    ranges = keyed.repartitionByRange(*key).sortWithinPartitions(*key).select("doc_id", "text")
    made = staged(ranges.mapInArrow(lambda it: _write(it, folder, path), "name string, part int, n_ids long, n_docs long"), "shards")
    # One row per file: an ordered sum over files, not documents.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return made.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).withColumn("folder", F.lit(folder))


class IdFile:
    """Reads ids of a shard by offset, as little-endian unsigned 32-bit integers."""

    def __init__(self, base: str):
        system, at = file_system(f"{base}.ids")
        self.file = system.open_input_file(at)
        self.width = int(np.frombuffer(self.file.read_at(HEADER, 0), "<u8")[0])

    def __enter__(self) -> IdFile:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def read(self, offset: int, length: int) -> np.ndarray:
        raw = self.file.read_at(length * self.width, HEADER + offset * self.width)
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each shard, each found by its key through the index."""
    for batch in batches:
        for row in batch.to_pylist():
            base = f"{row['folder']}/{row['name']}"
            index, listed = PerfectIndex.load(read_bytes(f"{base}.mph")), np.load(io.BytesIO(read_bytes(f"{base}.keys")))
            with IdFile(base) as f:
                for lo in range(0, row["n_docs"], 4096):
                    ids, null, nth = (listed[c][lo:lo + 4096] for c in ("ids", "null", "nth"))
                    found, offset, length = index.find(key_words(ids, null, nth))
                    if not found.all():
                        raise ValueError(f"keys missing from {base}")
                    crc = [zlib.crc32(f.read(int(o), int(n)).tobytes()) for o, n in zip(offset, length, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64(), mask=null), pa.array(offset + row["start"]), pa.array(length),
                         pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_shards(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in ``shards`` (from ``write_shards``)."""
    return (shards.select("folder", "name", "start", "n_docs").repartition("name")
            .mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def lookup(row: dict, doc_id: int | None, nth: int = 0) -> np.ndarray | None:
    """The ids of one document of the shard ``row`` (folder, name), or None if it is not there."""
    base = f"{row['folder']}/{row['name']}"
    key = key_words(np.array([doc_id or 0], np.int64), np.array([doc_id is None]), np.array([nth], np.int64))
    found, offset, length = PerfectIndex.load(read_bytes(f"{base}.mph")).find(key)
    if not found[0]:
        return None
    with IdFile(base) as f:
        return f.read(int(offset[0]), int(length[0]))
