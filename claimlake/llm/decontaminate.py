"""Benchmark decontamination: BM25 with block-max WAND pruning, then overlap on five-word shingles.

Every training text is cut into overlapping passages, and every passage queries an inverted index of the test items.
An item is retrieved if its BM25 score reaches the item's own threshold: the least score that a passage can have that
holds ``per_cent`` of the item's shingles (they cover at least that many words plus four; the cheapest of its words are
assumed).  So retrieval loses no item that verification would accept.

Pruning (block-max WAND): items are cut into blocks of ``ITEMS``.  A term's list in a block carries its largest
impact.  Terms of a block whose largest impacts together stay below half its threshold are skipped at first; a
(passage, block) is opened only if the bounds of the others can still reach the threshold, and only opened blocks are
scored in full.

Verification: question (all of an item but its last sentence) and answer (its last sentence) in the words of the
passage: ``per_cent`` of the whole item's distinct shingles, and for each part that has shingles of its own at least
half of them, must occur in the passage.

Index size: items are searched in slices of about half of ``SLICE_BYTES`` of text, one after the other over numbered rows,
and each slice's matches are staged: a task, and the driver, hold the index of one slice.  All are searched.  Defined cases: null or empty text: clean; items without words: never matched; items shorter
than five words: their whole sequence is one shingle; null doc_id: kept with its own matches; null item_id: never
named, still a match; repeated rows: each by itself; empty tables: no rows, or no matches; other columns pass through,
but for those named n_items, item_ids, found_n and found_items.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed, staged
from .text import LOWER, Texts, mix, shingles, span_hashes, text_blocks, words

K1, B = 1.2, 0.75
ITEMS = 8
SLICE_BYTES = 4 << 20
#: Words of a passage at least; consecutive passages share half.
PASSAGE = 512
#: Punctuation is no part of a word.
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def _plain(t: Texts) -> Texts:
    data = LOWER[t.data]
    data[_PUNCTUATION[data]] = 0x20
    return Texts(data, t.offsets, t.first_row)


def _words(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    start, end, doc = words(t)
    return span_hashes(t.data, start, end), doc


def _last_sentence(text: str) -> int:
    """Where the last sentence of ``text`` begins (0 if it is the only one)."""
    body = text.rstrip(" .!?\n\t\r")
    return max(body.rfind(mark) + len(mark) for mark in (". ", "! ", "? ", "\n", ".\n")) if any(
        mark in body for mark in (". ", "! ", "? ", "\n")) else 0


class ItemIndex:
    """Inverted index of some test items, in blocks."""

    def __init__(self, ids: list, texts: list[str], width: int, per_cent: int):
        self.width, self.per_cent = width, per_cent
        order = sorted(range(len(texts)), key=lambda i: (len(texts[i]), i))
        self.ids = [ids[i] for i in order]
        t = _plain(next(text_blocks(pa.array([texts[i] for i in order], pa.string()), 1 << 62)))
        w, doc = _words(t)
        n = len(t)
        self.length = length = np.bincount(doc, minlength=n)
        self.longest = int(length.max(initial=0))
        self.terms, term = np.unique(w, return_inverse=True)
        pair, tf = np.unique(doc * len(self.terms) + term, return_counts=True)
        item, term = pair // max(len(self.terms), 1), pair % max(len(self.terms), 1)
        df = np.bincount(term, minlength=len(self.terms))
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[item] / max(length.mean(), 1e-9)))
        sh, offsets = shingles(w, doc, n, width)
        self.sets = [np.unique(sh[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        self.parts = self._parts([texts[i] for i in order])
        self.need = np.full(n, np.inf)
        for i in range(n):
            mine = np.sort(impact[item == i])
            if len(mine):
                # Distinct shingles found cover at least this many positions; each repeat of a word covers no new term.
                held = -(-per_cent * len(self.sets[i]) // 100)
                spare = length[i] - min(length[i], held + min(width, length[i]) - 1)
                self.need[i] = mine[:max(1, len(mine) - spare)].sum() * (1 - 1e-9)
        # Postings by (term, block) and by (term, item).
        block = item // ITEMS
        self.n_blocks = -(-n // ITEMS)
        order = np.lexsort((item, term))
        self.item, self.impact = item[order], impact[order]
        self.term_at = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
        key, inverse = np.unique(block * len(self.terms) + term, return_inverse=True)
        top = np.zeros(len(key))
        np.maximum.at(top, inverse, impact)
        b_block, b_term = key // max(len(self.terms), 1), key % max(len(self.terms), 1)
        self.block_need = np.array([self.need[b * ITEMS:(b + 1) * ITEMS].min() for b in range(self.n_blocks)])
        order = np.lexsort((top, b_block))
        running = np.zeros(len(top))
        for b in range(self.n_blocks):
            mine = order[b_block[order] == b]
            running[mine] = np.cumsum(top[mine])
        kept = running > 0.5 * self.block_need[b_block]
        skipped = np.bincount(b_block[~kept], top[~kept], minlength=self.n_blocks)
        self.open_at = self.block_need - skipped - 1e-9
        order = np.flatnonzero(kept)[np.argsort(b_term[kept], kind="stable")]
        self.b_block, self.b_top = b_block[order], top[order]
        self.b_at = np.searchsorted(b_term[order], np.arange(len(self.terms) + 1))

    def _parts(self, texts: list[str]) -> list[list[np.ndarray]]:
        out = []
        for text in texts:
            cut = _last_sentence(text)
            found = []
            for part in (text[:cut], text[cut:]):
                t = _plain(next(text_blocks(pa.array([part], pa.string()))))
                w, doc = _words(t)
                if len(w) >= self.width:
                    found.append(np.unique(shingles(w, doc, 1, self.width)[0]))
            out.append(found)
        return out

    def retrieve(self, passage: np.ndarray, term: np.ndarray) -> np.ndarray:
        """(passage, item) at or above the items' thresholds, from distinct (passage, term) pairs."""
        n_items = len(self.ids)
        p, at = _expand(self.b_at, passage, term)
        cell, bound = _sums(p * self.n_blocks + self.b_block[at], self.b_top[at])
        cell = cell[bound >= self.open_at[cell % self.n_blocks]]
        if not len(cell):
            return np.zeros((0, 2), np.int64)
        some = np.isin(passage, np.unique(cell // self.n_blocks))
        p, at = _expand(self.term_at, passage[some], term[some])
        inside = np.isin(p * self.n_blocks + self.item[at] // ITEMS, cell)
        p, at = p[inside], at[inside]
        cell, score = _sums(p * n_items + self.item[at], self.impact[at])
        cell = cell[score >= self.need[cell % n_items]]
        return np.stack([cell // n_items, cell % n_items], 1)

    def verified(self, item: int, found: np.ndarray) -> bool:
        """``found``: the sorted distinct shingles of a passage."""
        s = self.sets[item]
        return (len(s) > 0 and 100 * _common(s, found) >= self.per_cent * len(s)
                and all(2 * _common(x, found) >= len(x) for x in self.parts[item]))


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if not len(b):
        return 0
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def _expand(at: np.ndarray, passage: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The passage and the place of every posting of every (passage, term)."""
    lo, n = at[term], at[term + 1] - at[term]
    total = int(n.sum())
    place = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    return np.repeat(passage, n), place


def _sums(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cells, inverse = np.unique(key, return_inverse=True)
    return cells, np.bincount(inverse, value, minlength=len(cells))


def _search(batches: Iterator[pa.RecordBatch], index: ItemIndex) -> Iterator[pa.RecordBatch]:
    step = max(PASSAGE // 2, index.longest)
    for batch in batches:
        found: list[list[int]] = [[] for _ in range(len(batch))]
        for block in text_blocks(batch.column("text"), 1 << 20):
            t = _plain(block)
            w, doc = _words(t)
            first = np.searchsorted(doc, np.arange(len(t) + 1))
            # Passage j of a text: words [j * step, (j + 2) * step) of it.
            half = (np.arange(len(w)) - first[doc]) // step
            slot = np.minimum(np.searchsorted(index.terms, w), len(index.terms) - 1)
            known = index.terms[slot] == w
            halves = half[known]
            base = doc[known] * (1 << 32)
            cell = np.concatenate([base + halves, (base + halves - 1)[halves > 0]])
            term = np.concatenate([slot[known], slot[known][halves > 0]])
            cells, passage = np.unique(cell, return_inverse=True)
            pair = np.unique(passage * np.int64(len(index.terms)) + term)
            ready: dict[tuple[int, int], np.ndarray] = {}
            for p, item in index.retrieve(pair // len(index.terms), pair % len(index.terms)).tolist():
                d, j = int(cells[p]) >> 32, int(cells[p]) & 0xFFFFFFFF
                if item in found[block.first_row + d]:
                    continue
                size = min(index.width, int(index.length[item]))
                if (p, size) not in ready:
                    part = w[first[d] + j * step:min(first[d + 1], first[d] + (j + 2) * step)]
                    ready[p, size] = _windows(part, index.width, size)
                if index.verified(item, ready[p, size]):
                    found[block.first_row + d].append(item)
        items = [sorted(index.ids[i] for i in f if index.ids[i] is not None) for f in found]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([len(f) for f in found], pa.int64()),
                                          pa.array(items, pa.list_(pa.int64()))], names=[*batch.schema.names, "found_n", "found_items"])


def _windows(part: np.ndarray, width: int, size: int) -> np.ndarray:
    """Distinct shingles of ``size`` words, hashed as ``shingles`` hashes an item's."""
    if len(part) < size:
        return np.zeros(0, np.uint64)
    h = np.full(len(part) - size + 1, size, np.uint64)
    for j in range(width):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + (part[j:j + len(h)] if j < size else np.uint64(0)))
    return np.unique(h)


def _index(items: DataFrame, slices: int, i: int, width: int, per_cent: int) -> ItemIndex | None:
    rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == i).orderBy("item_id", "text").collect()
    index = ItemIndex([r.item_id for r in rows], [r.text for r in rows], width, per_cent) if rows else None
    return index if index and len(index.terms) else None


def _found(texts: DataFrame, index: ItemIndex) -> DataFrame:
    schema = T.StructType([*texts.schema, T.StructField("found_n", T.LongType()),
                           T.StructField("found_items", T.ArrayType(T.LongType()))])
    return texts.mapInArrow(lambda it: _search(it, index), schema)


def _matches(texts: DataFrame, items: DataFrame, slices: int, i: int, width: int, per_cent: int) -> DataFrame | None:
    """The rows of ``texts`` with matches in slice ``i``, staged: nothing holds the slice's index afterwards."""
    index = _index(items, slices, i, width, per_cent)
    return index and staged(_found(texts, index).filter("found_n > 0").select("row", "found_n", "found_items"), "matches")


def contaminated(docs: DataFrame, items: DataFrame, width: int = 5, per_cent: int = 80) -> DataFrame:
    """``docs`` with ``n_items`` (test items that a passage of the row holds) and ``item_ids`` (sorted)."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-total // (SLICE_BYTES // 2)))
    docs = docs.drop("n_items", "item_ids", "found_n", "found_items")
    none = docs.select("*", F.lit(0).cast("long").alias("n_items"), F.array().cast("array<bigint>").alias("item_ids"))
    if slices == 1:
        index = _index(items, 1, 0, width, per_cent)
        return none if index is None else _found(docs, index).withColumnsRenamed({"found_n": "n_items", "found_items": "item_ids"})
    rows = staged(docs.select(F.monotonically_increasing_id().alias("row"), packed(docs)), "numbered")
    texts = rows.select("row", "given.text")
    found = [m for i in range(slices) if (m := _matches(texts, items, slices, i, width, per_cent)) is not None]
    if not found:
        return none
    found = reduce(DataFrame.unionByName, found).groupBy("row").agg(
        F.sum("found_n").alias("found_n"), F.sort_array(F.flatten(F.collect_list("found_items"))).alias("found_items"))
    return rows.join(found, "row", "left").select(
        "given.*", F.coalesce("found_n", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("found_items", F.array().cast("array<bigint>")).alias("item_ids"))
