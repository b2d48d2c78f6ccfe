"""Token counts per section of a document, from whole-document encodings.

A document is encoded once, whole, with offsets; every token is then given to a section by an interval join of its
character span with the sections' spans.  Rule for tokens that cross a boundary: a token belongs to the section that
holds its first character, so the counts of a document's sections add up to its tokens.

Byte-level vocabularies cut a text before every white space that follows something else, and nothing on one side of such
a cut changes the tokens of the other.  So a text is taken as the strings between these cuts, and the first characters
of a string's tokens are remembered for its next occurrence; a tokenizer for which this does not hold (it is tried when
the vocabulary is loaded), and a text with white space beyond blank, tab and line ends, is encoded in one call.  Long
texts are worked through in parts of ``CHARS`` characters that end at a cut.

Sections are lines (with their line feed).  Defined cases: null or empty text: one empty section, 0 tokens; null
doc_id, repeated rows: each row by itself; empty table: no rows; other columns are not read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a text worked through at a time, and of the texts of one group of output rows.
CHARS = 200_000
#: Characters of a remembered string at most, and strings of one generation.
KNOWN_CHARS, KNOWN = 64, 500_000

_STRING = re.compile(r"\s*\S+|\s+")
_CUT = re.compile(r"(?<=\S)(?=\s)")
#: White space that Python and tokenizers may see differently, or that joins a run of blanks from its left.
_OTHER_SPACE = re.compile(r"[^\S \t\n\r]")
_PROBES = ("don't we'll  go,\n\n now.  \n a\tb 12 3x ,, end. \n", " é über\r\n naïve<|endoftext|> x", "a  b   c\n   d \n")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def line_sections(text: str) -> np.ndarray:
    """First characters of the sections of ``text``, and its length."""
    cuts, at = [0], text.find("\n")
    while 0 <= at < len(text) - 1:
        cuts.append(at + 1)
        at = text.find("\n", at + 1)
    return np.array([*cuts, len(text)], np.int64)


def join_spans(starts: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Tokens per section: a token that starts at ``starts`` lies in the section whose cuts hold it."""
    at = np.clip(starts, 0, max(int(cuts[-1]) - 1, 0))
    return np.bincount(np.searchsorted(cuts[:-1], at, "right") - 1, minlength=len(cuts) - 1)


class Starts:
    """First characters of the tokens of whole texts, with a memory of strings in two generations: a string used again
    moves to the younger; when that is full it becomes the older, which is forgotten."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        #: A comma or full stop at the end of a string is one token by itself.
        self.ends = [end for end in ",." if all(self._whole(w + end).tolist() == [*self._whole(w).tolist(), len(w)]
                                                for w in (" word", "x", " 12", "é"))]
        self.cuts = all(np.array_equal(self._joined(t), self._whole(t)) for t in _PROBES)

    def _whole(self, text: str) -> np.ndarray:
        return np.array([s for s, _ in self.tokenizer.encode(text, add_special_tokens=False).offsets], np.int64)

    def _learn(self, missing: set[str]) -> list[str]:
        """Brings all of ``missing`` into the younger generation; returns those too long to stay there."""
        ended = []
        for w in [*missing]:
            if w in self.old:
                self.known[w] = self.old[w]
                missing.discard(w)
            elif w[-1] in self.ends and w[-2:-1].isalnum():
                ended.append(w)
                missing.discard(w)
                if w[:-1] not in self.known:
                    missing.add(w[:-1])
        new = list(missing)
        for w, e in zip(new, self.tokenizer.encode_batch(new, add_special_tokens=False), strict=True):
            self.known[w] = np.array([s for s, _ in e.offsets], "<u4").tobytes()
        for w in ended:
            self.known[w] = self.known[w[:-1]] + np.array([len(w) - 1], "<u4").tobytes()
        return [w for w in (*new, *ended) if len(w) > KNOWN_CHARS]

    def _joined(self, text: str) -> np.ndarray:
        strings = _STRING.findall(text)
        found = [*map(self.known.get, strings)]
        if None in found:
            long = self._learn({w for w, x in zip(strings, found, strict=True) if x is None})
            found = [self.known[w] if x is None else x for w, x in zip(strings, found, strict=True)]
            for w in long:
                del self.known[w]
            if len(self.known) > KNOWN:
                self.old, self.known = self.known, {}
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        tokens = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        return np.frombuffer(b"".join(found), "<u4").astype(np.int64) + np.repeat(np.cumsum(lengths) - lengths, tokens)

    def of(self, text: str) -> Iterator[np.ndarray]:
        """The first characters of all tokens of ``text``, part after part."""
        if not self.cuts or _OTHER_SPACE.search(text):
            yield self._whole(text)
            return
        at = 0
        while at < len(text):
            cut = _CUT.search(text, at + CHARS) if at + CHARS < len(text) else None
            end = cut.start() if cut else len(text)
            yield self._joined(text[at:end]) + at
            at = end


_STARTS: dict[str, Starts] = {}


def starts(path: str) -> Starts:
    """One per Python worker, which Spark uses for many tasks: later tasks find the strings of earlier ones."""
    if path not in _STARTS:
        _STARTS[path] = Starts(path)
    return _STARTS[path]


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    made, names = starts(path), ["doc_id", "section", "start_char", "end_char", "n_tokens"]
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
        first, size, found = 0, 0, []
        for at, text in enumerate(texts):
            text = text or ""
            cuts = line_sections(text)
            found.append((cuts, sum((join_spans(s, cuts) for s in made.of(text)), np.zeros(len(cuts) - 1, np.int64))))
            size += len(text)
            if size < CHARS and at < len(texts) - 1:
                continue
            rows = [len(n) for _, n in found]
            of = pa.array(np.repeat(np.arange(first, at + 1), rows))
            yield pa.RecordBatch.from_arrays(
                [ids.take(of), pa.array(np.concatenate([np.arange(r) for r in rows]), pa.int32()),
                 *[pa.array(np.concatenate(c)) for c in ([c[:-1] for c, _ in found], [c[1:] for c, _ in found], [n for _, n in found])]],
                names=names)
            first, size, found = at + 1, 0, []


def section_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, section, start_char, end_char, n_tokens) for every section of every row of ``docs``."""
    path = path or vocabulary()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda it: _count(it, path), "doc_id long, section int, start_char long, end_char long, n_tokens long")
