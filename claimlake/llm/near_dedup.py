"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard verification, components.

Two permutations make a whole signature.  The first (a 64-bit bijection cut to 32 bits) scatters a shingle
over the universe; the second, circularly shifted by k, gives coordinate k.  Every band of ``ROWS`` coordinates
is a bucket key; the number of bands follows from the threshold, so that a pair at the threshold shares no
bucket with probability ``MISS`` at most.

No bucket is expanded into all its pairs, and no bucket is gathered:

1. Documents with equal shingle sets form one class, its smallest id stands for it.
2. In every bucket each class is compared with one hub (the class with most copies); links are confirmed on
   the full shingle sets and joined to components.
3. Only buckets whose classes still lie in several components go on.  There, u(x), the number of x's shingles
   that no other remaining class has, bounds the similarity:
   J(x, y) <= min(c_x, c_y) / (max(c_x, c_y) + u_x + u_y) with c = size - u.
   The class with the smallest u is a second hub: of many edited copies, the text they were made from.
4. The remaining classes that then still lie in different components are paired by their rarest shingles (prefix and
   position filter): two sets at the threshold share a shingle among the rarest of both, with enough others after it.
   These pairs are confirmed on full sets.  Pairs inside one component are never needed: links only matter
   through components.

Defined cases: null or empty text: no shingles, linked with nothing; fewer words than ``width``: the whole sequence
is the one shingle; null id: linked with nothing, component null, kept; rows of one id are one node; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, staged
from .text import LOWER, mix, shingles, span_hashes, text_blocks, words

ROWS = 4
#: Probability, at most, that a pair at the threshold shares no bucket.
MISS = 1e-9
#: Shingles per numpy pass, so that a pass stays in the processor's cache.
PASS = 1 << 15


def band_count(threshold: float) -> int:
    return max(1, math.ceil(math.log(MISS) / math.log1p(-threshold ** ROWS)))


def _second_permutation(x: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit words, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signatures(hashes: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """One row of ``size`` coordinates per document; a document without shingles has the largest values."""
    n = len(offsets) - 1
    out = np.full((n, size), 0xFFFFFFFF, np.uint32)
    spread = (mix(hashes) >> np.uint64(32)).astype(np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    at = 0
    while at < len(full):
        end = max(at + 1, int(np.searchsorted(offsets[full + 1], offsets[full[at]] + PASS, "right")))
        part, lo = full[at:end], offsets[full[at]]
        x = spread[lo:offsets[part[-1] + 1]]
        cuts = offsets[part] - lo
        for k in range(size):
            out[part, k] = np.minimum.reduceat(_second_permutation(x + np.uint32(k)), cuts)
        at = end
    return out


def document_shingles(texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    data = LOWER[texts.data]
    start, end, doc = words(texts)
    return shingles(span_hashes(data, start, end), doc, len(texts), width)


def _distinct(hashes: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    return [np.unique(hashes[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _sketch(batches: Iterator[pa.RecordBatch], width: int, bands: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for t in text_blocks(batch.column("text")):
            hashes, offsets = document_shingles(t, width)
            sets = _distinct(hashes, offsets)
            place = [np.arange(1, len(s) + 1, dtype=np.uint64) for s in sets]
            sig = signatures(hashes, offsets, bands * ROWS).reshape(len(t), bands, ROWS).astype(np.uint64)
            key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(t), bands))
            for r in range(ROWS):
                key = mix(key * np.uint64(0xD6E8FEB86659FD93) + sig[:, :, r])
            key = key.view(np.int64)
            n = np.array([len(s) for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(t.first_row, len(t)), pa.array(n),
                pa.array([int(mix(s).sum().view(np.int64)) for s in sets], pa.int64()),
                pa.array([int((mix(s ^ np.uint64(0x5BF03635)) * p).sum().view(np.int64))
                          for s, p in zip(sets, place, strict=True)], pa.int64()),
                pa.ListArray.from_arrays(np.arange(0, len(t) * bands + 1, bands, dtype=np.int32),
                                         pa.array(key.reshape(-1))),
            ], names=["doc_id", "n_shingles", "set_a", "set_b", "bands"])


def _confirm(batches: Iterator[pa.RecordBatch], width: int, per_cent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a_ids, b_ids = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        linked = np.zeros(len(batch), bool)
        at = 0
        blocks = text_blocks(pa.concat_arrays([batch.column("a_text"), batch.column("b_text")]))
        sets: list[np.ndarray] = []
        for t in blocks:
            sets += _distinct(*document_shingles(t, width))
        for at in range(len(batch)):
            x, y = sets[at], sets[at + len(batch)]
            both = np.concatenate([x, y])
            both.sort()
            inter = int((both[1:] == both[:-1]).sum())
            linked[at] = 100 * inter >= per_cent * (len(both) - inter) and inter > 0
        yield pa.RecordBatch.from_arrays([pa.array(a_ids[linked]), pa.array(b_ids[linked])], names=["a", "b"])


def _each_shingle(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        for t in text_blocks(batch.column("text"), 1 << 20):
            sets = _distinct(*document_shingles(t, width))
            sizes = np.array([len(s) for s in sets], np.int64)
            own = np.repeat(ids[t.first_row:t.first_row + len(t)], sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own), pa.array(np.repeat(sizes, sizes)),
                 pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64))],
                names=["doc_id", "n", "shingle"])


def near_duplicates(docs: DataFrame, width: int = 5, per_cent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text): documents whose sets of
    ``width``-word shingles have a Jaccard similarity of ``per_cent`` or more are linked."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bands = band_count(per_cent / 100)
    sketch = staged(docs.mapInArrow(lambda it: _sketch(it, width, bands),
                                    "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"), "sketch")
    key = ["n_shingles", "set_a", "set_b"]
    linkable = sketch.filter("n_shingles > 0 and doc_id is not null")
    classes = linkable.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"),
                                         F.first("bands").alias("bands"))
    rows = classes.select("rep", "copies", "n_shingles", F.explode("bands").alias("bucket"))
    hubs = (rows.groupBy("bucket").agg(F.max_by("rep", F.struct("copies", -F.col("rep"))).alias("hub"),
                                       F.count("*").alias("n")).filter("n > 1").drop("n"))
    shared = staged(rows.join(hubs, "bucket").select("bucket", "rep", "hub", "n_shingles"), "buckets")
    members = shared.select(F.col("rep").alias("doc_id")).distinct()
    texts = staged(docs.join(members, "doc_id", "left_semi"), "members")

    near = _size_bound("n_shingles", "hub_size", per_cent)
    hub_sizes = shared.filter("rep = hub").groupBy(F.col("hub").alias("hub_id")).agg(F.max("n_shingles").alias("hub_size"))
    pairs = (shared.filter("rep <> hub").select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"),
                                                "hub", "n_shingles").distinct()
             .join(hub_sizes, F.col("hub") == F.col("hub_id")).filter(near).select("a", "b").distinct())
    links = staged(_verify(pairs, texts, width, per_cent), "links")
    label = connected_components(links)

    # Buckets whose classes lie in more than one component.
    labelled = shared.join(label, shared.rep == label.node, "left").select(
        "bucket", "rep", "n_shingles", F.coalesce("component", "rep").alias("component"))
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    left = staged(labelled.join(mixed.select("bucket"), "bucket"), "mixed")
    rest = left.select(F.col("rep").alias("doc_id")).distinct()
    prefix = staged(_prefixes(texts.join(rest, "doc_id", "left_semi"), width, per_cent), "prefixes")
    # The class with fewest shingles of its own is most like the others: it is the second hub of its bucket.
    left = staged(left.join(prefix.filter("place = 1").select(F.col("doc_id").alias("rep"), "n", "c"), "rep"), "open")
    central = left.groupBy("bucket").agg(F.min(F.struct(F.col("n") - F.col("c"), "rep", "component", "n", "c")).alias("y"))
    again = staged(left.alias("x").join(central, "bucket").filter(_may_link(per_cent)).select(
        F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"))
        .distinct().join(pairs, ["a", "b"], "left_anti"), "again")
    links = links.unionByName(staged(_verify(again, texts, width, per_cent), "links"))
    label = connected_components(links)

    # A prefix shingle matters where it meets another component, at a place that leaves enough shingles behind it.
    open_ = staged(prefix.join(label, prefix.doc_id == label.node, "left").select(
        "shingle", "doc_id", "n", "after", F.coalesce("component", "doc_id").alias("component")), "open")
    worth = (open_.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                          F.min("n").alias("least_n"), F.max("after").alias("most_after"))
             .filter("lo < hi").drop("lo", "hi"))
    open_ = open_.join(worth, "shingle").filter(_enough("after", "most_after", "n", "least_n", per_cent))
    more = (open_.alias("x").join(open_.alias("y"), (F.col("x.shingle") == F.col("y.shingle"))
                                  & (F.col("x.doc_id") < F.col("y.doc_id"))
                                  & (F.col("x.component") != F.col("y.component"))
                                  & _enough("x.after", "y.after", "x.n", "y.n", per_cent))
            .select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct()
            .join(pairs.unionByName(again), ["a", "b"], "left_anti"))
    late = staged(_verify(more, texts, width, per_cent), "links")
    label = connected_components(links.unionByName(late))

    found = (classes.select(*key, "rep").join(label, F.col("rep") == F.col("node"), "left")
             .select(*key, F.coalesce("component", "rep").alias("component_id")))
    plain = sketch.filter("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    linked = linkable.join(found, key).select("doc_id", "n_shingles", "component_id")
    return linked.unionByName(plain).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _prefixes(texts: DataFrame, width: int, per_cent: int) -> DataFrame:
    """(doc_id, n, c, shingle, place, after): of the n distinct shingles of each text, in order of the number of texts that
    hold them, those early enough that a similar text must share one; c: those that some other text holds; after:
    how many follow.  Shingles that no other text has come first in that order and are left out."""
    rows = staged(texts.mapInArrow(lambda it: _each_shingle(it, width), "doc_id long, n long, shingle long"), "shingles")
    held = rows.groupBy("shingle").agg(F.count("*").alias("texts")).filter("texts > 1")
    own = Window.partitionBy("doc_id")
    return (rows.join(held, "shingle")
            .withColumn("c", F.count("*").over(own))
            .withColumn("place", F.row_number().over(own.orderBy("texts", "shingle")))
            .withColumn("after", F.col("c") - F.col("place"))
            .filter(100 * (F.col("after") + 1) >= per_cent * F.col("n"))
            .select("doc_id", "n", "c", "shingle", "place", "after"))


def _enough(after_x: str, after_y: str, n_x: str, n_y: str, per_cent: int) -> F.Column:
    """If a shingle is the first that x and y share, they can still reach the threshold."""
    return (100 + per_cent) * (1 + F.least(after_x, after_y)) >= per_cent * (F.col(n_x) + F.col(n_y))


def _may_link(per_cent: int) -> F.Column:
    """Classes x and y of different components that may reach the threshold, with c of their n shingles in other texts."""
    alone = F.col("x.n") - F.col("x.c") + F.col("y.n") - F.col("y.c")
    return ((F.col("x.component") != F.col("y.component"))
            & (100 * F.least("x.c", "y.c") >= per_cent * (F.greatest("x.c", "y.c") + alone)))


def _size_bound(a: str, b: str, per_cent: int) -> F.Column:
    return 100 * F.least(a, b) >= per_cent * F.greatest(a, b)


def _verify(pairs: DataFrame, texts: DataFrame, width: int, per_cent: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold on their full shingle sets."""
    a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text"))
    b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text"))
    return (pairs.join(a, "a").join(b, "b").select("a", "b", "a_text", "b_text")
            .mapInArrow(lambda it: _confirm(it, width, per_cent), "a long, b long"))
