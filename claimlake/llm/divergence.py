"""How far the sources of a language differ in their words, from one-hot products of count levels.

A language's kept terms and its sources form a matrix of counts.  Its indicator columns, one for every (source, count
level), times their own transpose give for all pairs of sources at once how many terms lie at each pair of levels:
the joint tables, which are then priced cell by cell.  The product is blocked.  Terms are dealt into blocks of about
``TERMS``, sources into tiles of ``TILE``; each (tile, tile, block) is one group, whose terms are cut, in order of their
counts, into runs with at most ``COLUMNS`` indicator columns, so that frequent terms with a level of their own stay cheap.
Products of 0/1 columns are exact in single precision (sums below 2**24); prices are integers.  Groups send one sum per
pair of sources.  Terms without any occurrence in both tiles are priced in one go.

p of a count c in a group with N occurrences of V kept terms: 1 + (SCALE * (c + 2)) div (N + 2 V).
f(p, q): ((p - q) * (p - q)) div (p + q).

Words are cut and counted per task (A-Z as a-z, long texts in pieces) before anything is shuffled.

Defined cases: null lang or source: the empty string; null or empty text, text without terms: its group exists, without
occurrences; a language without kept terms: pairs with value 0, no terms; one source in a language: no pairs; ties: the
item that is smaller in UTF-8 first; repeated rows: each counts; empty table: no rows; other columns, doc_id among them,
are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

SCALE = 1_000_000_000
#: Kept terms of a block (on average), sources of a tile, indicator columns of one product.
TERMS, TILE, COLUMNS = 4096, 64, 512
#: Bytes of a text cut at a time, and entries a task counts before it passes them on.
PIECE, ENTRIES = 1 << 20, 200_000
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def text_terms(text: bytes) -> Counter:
    """The terms of one UTF-8 text with their numbers; pieces end between terms."""
    found, at = Counter(), 0
    flat = text.translate(_TERM_BYTES)
    while at < len(flat):
        end = flat.find(b" ", at + PIECE) if at + PIECE < len(flat) else -1
        end = len(flat) if end < 0 else end
        found.update(flat[at:end].split())
        at = end
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def passed_on() -> pa.RecordBatch:
        rows = [(*group, term.decode(), n, docs[term]) for group, (total, docs) in held.items() for term, n in total.items()]
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [[]] * 5,
                                            [pa.string()] * 3 + [pa.int64()] * 2, strict=True)],
            names=["lang", "source", "term", "n", "docs"])

    entries = 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("lang", "source")]
        for lang, source, text in zip(*columns, batch.column("text").cast(pa.large_binary()), strict=True):
            total, docs = held.setdefault((lang, source), (Counter(), Counter()))
            found, before = text_terms(text.as_py()), len(total)
            total.update(found)
            docs.update(found.keys())
            entries += len(total) - before
            if entries > ENTRIES:
                yield passed_on()
                entries = 0
    yield passed_on()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n occurrences, docs that hold it)."""
    return (docs.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(count: Column, total: Column, terms: Column) -> Column:
    """p, exact for counts of any size; null without kept terms."""
    up = F.lit(SCALE).cast("decimal(10,0)") * (count.cast("decimal(20,0)") + F.lit(2))
    down = (total + 2 * terms).cast("decimal(20,0)")
    return F.when(terms > 0, F.call_function("div", up, down) + 1)


def price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    return np.array([1 + SCALE * (c + 2) // (total + 2 * terms) for c in counts.tolist()], np.int64)


def _level_columns(counts: np.ndarray, totals: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indicator matrix of the (source, level) columns of ``counts`` (terms x sources), each column's source and p."""
    n, sources = counts.shape
    hot, of, p = [], [], []
    for g in range(sources):
        levels, at = np.unique(counts[:, g], return_inverse=True)
        hot.append(at + sum(map(len, p)))
        of.append(np.full(len(levels), g))
        p.append(_shares(levels, int(totals[g]), terms))
    z = np.zeros((n, sum(map(len, p))), np.float32)
    z[np.arange(n)[:, None], np.stack(hot, 1)] = 1
    return z, np.concatenate(of), np.concatenate(p)


def _runs(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of terms with at most COLUMNS indicator columns on either side (or of one term)."""
    columns = max(sum(len(np.unique(m[:, g])) for g in range(m.shape[1])) for m in (left, right))
    if columns <= COLUMNS or len(left) == 1:
        yield left, right
        return
    half = len(left) // 2
    yield from _runs(left[:half], right[:half])
    yield from _runs(left[half:], right[half:])


def priced_pairs(left: np.ndarray, right: np.ndarray, left_totals: np.ndarray, right_totals: np.ndarray,
                 terms: int) -> np.ndarray:
    """Sum over the terms (rows) of f(p of a left source, p of a right source), for every pair."""
    out = np.zeros((left.shape[1], right.shape[1]), np.int64)
    order = np.argsort(left.sum(1) + right.sum(1), kind="stable")
    for a, b in _runs(left[order], right[order]):
        z, of_a, p = _level_columns(a, left_totals, terms)
        y, of_b, q = (z, of_a, p) if b is a else _level_columns(b, right_totals, terms)
        joint = z.T @ y  # how many terms lie at each pair of levels, for all pairs of sources
        i, j = np.nonzero(joint)
        d = p[i] - q[j]
        np.add.at(out, (of_a[i], of_b[j]), joint[i, j].astype(np.int64) * (d * d // (p[i] + q[j])))
    return out


def _price_block(rows: pa.Table, width: int) -> pa.Table:
    """One group: counts of terms, and the totals of all sources of both tiles (rows without a term)."""
    groups, block = rows.filter(rows.column("term").is_null()), rows.filter(rows.column("term").is_valid())
    lang, low, high = (groups.column(c)[0].as_py() for c in ("lang", "low", "high"))
    terms = groups.column("terms")[0].as_py()
    size = {t: [] for t in (low, high)}
    for t, i, total in zip(*(groups.column(c).to_pylist() for c in ("tile", "i", "n")), strict=True):
        size[t].append((i, total))
    names = block.column("term").combine_chunks().dictionary_encode() if block.num_rows else None
    n, kept = len(names.dictionary) if names else 0, {}
    tile, i, count = (block.column(c).to_numpy() for c in ("tile", "i", "n"))
    for t in size:
        size[t].sort()
        kept[t] = np.zeros((n, width), np.int64)
        if n:
            mine = tile == t
            kept[t][names.indices.to_numpy()[mine], i[mine] % width] = count[mine]
        kept[t] = kept[t][:, :len(size[t])]
    totals = {t: np.array([x for _, x in size[t]], np.int64) for t in size}
    left, right = kept[low], kept[low] if low == high else kept[high]
    value = priced_pairs(left, right, totals[low], totals[high], terms)
    g, h = np.meshgrid([x for x, _ in size[low]], [x for x, _ in size[high]], indexing="ij")
    up = g < h
    out = [pa.array([lang] * int(up.sum()), pa.string()), pa.array(g[up], pa.int32()), pa.array(h[up], pa.int32()), pa.array(value[up]),
           pa.array(np.full(int(up.sum()), n))]
    return pa.Table.from_arrays(out, names=["lang", "g", "h", "value", "n"])


class Audit:
    """Counts of kept terms per (lang, source), staged; ``terms`` and ``pairs`` price them."""

    def __init__(self, docs: DataFrame, least_docs: int = 10, tile: int = TILE, block: int = TERMS):
        self.tile, self.block = tile, block
        filled = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
        counts = staged(term_counts(filled), "terms")
        kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least_docs)
        self.counts = staged(counts.select("lang", "source", "term", "n").join(kept.select("lang", "term", "all_n"), ["lang", "term"]), "kept")
        # One row per language: its kept terms and their occurrences.
        sizes = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all_n").alias("all_total"))
        total = self.counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = filled.select("lang", "source").groupBy("lang", "source").agg(F.count("*").alias("rows"))
        number = Window.partitionBy("lang").orderBy("source")  # sources of a language, one row each
        self.groups = staged(
            groups.join(total, ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0, ["total", "terms", "all_total"])
            .select("lang", "source", "total", "terms", "all_total", (F.row_number().over(number) - 1).alias("i"))
            .withColumn("tile", F.floor(F.col("i") / tile).cast("int")), "groups")

    def terms(self, most: int = 10) -> DataFrame:
        """(lang, source, item, value, rank): per group its ``most`` terms of most value above the language's share."""
        g = self.groups.select("lang", "source", "total", "terms", "all_total")
        p, q = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("all_n"), F.col("all_total"), F.col("terms"))
        found = (self.counts.join(g, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
                 .filter("p > q").select("lang", "source", "item", price(F.col("p"), F.col("q")).alias("value")))
        return found.withColumn("rank", F.row_number().over(_best())).filter(F.col("rank") <= most)

    def _sums(self) -> DataFrame:
        """(lang, g, h, value, n): per pair of sources the value over the n terms that occur in one of their tiles."""
        tiles = self.groups.groupBy("lang").agg(F.max("tile").alias("last"), F.max("terms").alias("terms"))
        blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") / self.block))
        # A tile meets every tile of its language once: (low, high) with low <= high.
        meets = F.explode(F.transform(F.sequence(F.lit(0), F.col("last")), lambda t: F.struct(
            F.least(t, "tile").alias("low"), F.greatest(t, "tile").alias("high"))))
        key = ["lang", "low", "high", "block"]
        rows = staged(
            self.counts.join(self.groups.select("lang", "source", "i", "tile"), ["lang", "source"]).join(tiles, "lang")
            .select("lang", F.pmod(F.xxhash64("term"), blocks).cast("int").alias("block"), "term", "i", "n", "tile", meets.alias("m"))
            .select("lang", "m.low", "m.high", "block", "term", "tile", "i", "n", F.lit(None).cast("long").alias("terms")), "blocks")
        used = rows.select(*key).distinct()
        totals = (self.groups.join(tiles.select("lang", "last"), "lang").select("lang", "i", "tile", "total", "terms", meets.alias("m"))
                  .select("lang", "m.low", "m.high", "tile", "i", F.col("total").alias("n"), "terms")
                  .join(used, ["lang", "low", "high"]).withColumn("term", F.lit(None).cast("string")))
        width = self.tile
        cells = (rows.unionByName(totals).groupBy(*key)
                 .applyInArrow(lambda t: _price_block(t, width), "lang string, g int, h int, value long, n long"))
        return cells.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"), F.sum("n").alias("n"))

    def pairs(self) -> DataFrame:
        """(lang, source, item, value, rank): per group every other source of its language, by divergence."""
        a, b = self.groups.alias("a"), self.groups.alias("b")
        both = (a.join(b, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.i") != F.col("b.i")))
                .select("a.lang", "a.source", F.col("b.source").alias("item"), "a.terms", F.least("a.i", "b.i").alias("g"),
                        F.greatest("a.i", "b.i").alias("h"),
                        price(share(F.lit(0), F.col("a.total"), F.col("a.terms")),
                              share(F.lit(0), F.col("b.total"), F.col("b.terms"))).alias("none")))
        value = F.coalesce("value", F.lit(0)) + F.coalesce((F.col("terms") - F.coalesce("n", F.lit(0))) * F.col("none"), F.lit(0))
        found = both.join(self._sums(), ["lang", "g", "h"], "left").select("lang", "source", "item", value.alias("value"))
        return found.withColumn("rank", F.row_number().over(_best()))


def _best() -> Window:
    return Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")


def source_audit(docs: DataFrame, least_docs: int = 10, most: int = 10, **blocks: int) -> DataFrame:
    """(lang, source, part, item, value, rank): parts ``pair`` (all other sources) and ``term`` (the first ``most``)."""
    audit = Audit(docs, least_docs, **blocks)
    parts = [df.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), "rank")
             for part, df in (("pair", audit.pairs()), ("term", audit.terms(most)))]
    return parts[0].unionByName(parts[1])
