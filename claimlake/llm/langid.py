"""Language identification with hyperdimensional profiles.

Every letter has a random +1/-1 vector.  An n-gram's vector is the product (binding) of its letters' vectors, each
permuted (rotated) by its place; a text's vector is the sum (bundle) of its n-grams' vectors; a language's prototype
the sum of its training texts' vectors, each scaled to one length and to integers, so that the order of summation
does not matter.  A text gets the language of the closest prototype by cosine.  Training vectors are summed per task
and per language, so that only (language, dimension) sums are shuffled.

Defined cases: null text, or text without letters: ``und``, score 0; nothing to learn from: ``und``; null doc_id: a
null remainder, so never held out; ties of cosine: the smaller language; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed

DIMENSIONS = 1024
GRAM = 3
SCALE = 1000
#: Rows of the letter table; code points share rows by remainder.
LETTERS = 4096
#: Texts bundled together, and letters at most in a block of n-grams.
TEXTS, BLOCK = 32, 1 << 20
_NOT_LETTERS = regex.compile(r"\P{L}+")


def _letter_tables() -> list[np.ndarray]:
    base = np.where(np.random.default_rng(20).random((LETTERS, DIMENSIONS)) < 0.5, -1, 1).astype(np.int8)
    return [np.roll(base, GRAM - 1 - i, axis=1) for i in range(GRAM)]


def bundles(texts: list[str | None], tables: list[np.ndarray]) -> np.ndarray:
    """One vector per text; zeros if it has no letters."""
    out = np.zeros((len(texts), DIMENSIONS), np.float64)
    for i, text in enumerate(texts):
        clean = _NOT_LETTERS.sub(" ", text or "").strip().lower()
        if not clean:
            continue
        cp = np.frombuffer(f" {clean} ".encode("utf-32-le"), np.uint32) % LETTERS
        for at in range(0, len(cp) - GRAM + 1, BLOCK):
            c = cp[at:at + BLOCK + GRAM - 1].astype(np.int64)
            n = len(c) - GRAM + 1
            code = np.zeros(n, np.int64)
            for j in range(GRAM):
                code = code * LETTERS + c[j:j + n]
            grams, count = np.unique(code, return_counts=True)
            for lo in range(0, len(grams), 4096):
                g, v = grams[lo:lo + 4096], None
                for j in range(GRAM):
                    part = tables[j][(g // LETTERS ** (GRAM - 1 - j)) % LETTERS]
                    v = part if v is None else v * part
                out[i] += count[lo:lo + 4096].astype(np.float32) @ v.astype(np.float32)
    return out


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-9)


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables, sums = _letter_tables(), {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for at in range(0, len(batch), TEXTS):
            v = np.rint(SCALE * _unit(bundles(batch.column("text").slice(at, TEXTS).to_pylist(), tables))).astype(np.int64)
            for lang, x in zip(langs[at:at + TEXTS], v, strict=True):
                sums[lang] = sums.get(lang, 0) + x
    for lang, x in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * DIMENSIONS), pa.array(range(DIMENSIONS), pa.int32()),
                                          pa.array(x)], names=["lang", "i", "value"])


def _score(batches: Iterator[pa.RecordBatch], langs: list[str], prototypes: np.ndarray) -> Iterator[pa.RecordBatch]:
    tables = _letter_tables()
    for batch in batches:
        pred, score = [], []
        for at in range(0, len(batch), TEXTS):
            v = bundles(batch.column("text").slice(at, TEXTS).to_pylist(), tables)
            known = v.any(axis=1) & bool(langs)
            if not langs:
                pred += ["und"] * len(v)
                score += [0.0] * len(v)
                continue
            cos = _unit(v) @ prototypes.T
            best = cos.argmax(axis=1)
            pred += [langs[b] if k else "und" for b, k in zip(best, known, strict=True)]
            score += np.where(known, np.clip(cos[np.arange(len(v)), best], 0, 1), 0.0).round(9).tolist()
        more = [c for c in batch.schema.names if c == "given"]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()),
                                          pa.array(score, pa.float64()), *[batch.column(c) for c in more]],
                                         names=["doc_id", "held_out", "lang_pred", "score", *more])


def prototypes(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and unit prototypes learned from (text, lang); one vector per language reaches the driver."""
    rows = (labelled.select("text", "lang").filter("lang is not null and text is not null")
            .mapInArrow(_learn, "lang string, i int, value long").groupBy("lang", "i").agg(F.sum("value").alias("value"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "value"))).alias("v"))
            .select("lang", F.transform("v", lambda x: x["value"]).alias("v")).orderBy("lang").collect())
    return [r.lang for r in rows], _unit(np.array([r.v for r in rows], np.float64).reshape(len(rows), DIMENSIONS))


def identify(docs: DataFrame, given: bool = False) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs`` (doc_id, text, lang); ``given``: and the row itself, as a
    struct of that name."""
    more = [packed(docs)] if given else []
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang",
                       F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False)).alias("held_out"),
                       *more)
    langs, vectors = prototypes(docs.filter("not held_out"))
    docs = docs.drop("lang")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           *[f for f in docs.schema if f.name == "given"]])
    return docs.mapInArrow(lambda it: _score(it, langs, vectors), schema)
