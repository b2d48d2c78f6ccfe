"""Byte strings of ``width`` or more that repeat anywhere in a collection, by suffix arrays.

One suffix array of everything is not possible on a cluster, so the strings are dealt out by content.  A window (string
of ``width`` bytes) is owned by the smallest hash among its ``ANCHOR``-byte substrings; equal windows have equal owners
wherever they stand.  Consecutive windows of one owner form a run (cut after ``SPAN`` windows); a run's context is all
bytes of its windows.

1. Runs, as (owner, hash of the context), are dealt out once, by owner: equal contexts repeat as a whole.  Owners with a
   single context that does not repeat within itself are done.
2. The other owners' distinct contexts (one occurrence of each) are shuffled by owner.  Equal windows hold their owner's
   anchor at the same place, so a task sorts, over a block of whole owners, only the suffixes that begin with the anchor
   and, read backwards, the prefixes that end before it (two sparse suffix arrays).  Their longest common prefixes give
   how far any two contexts agree on either side of the anchor, and ``width`` bytes in all are a repeat.
   An owner with more than ``ANCHORS`` places of its anchor (text of a short period) gets an enhanced suffix array of
   all bytes instead (suffix ranks by doubling, longest common prefixes, left neighbours), whose common-prefix intervals
   of ``width`` or more with different left bytes are the maximal repeats.
3. An owner with more than ``HOT`` distinct contexts (a passage that very many documents share) would not fit one task:
   its windows are counted by 128-bit hash instead, an aggregation with partial sums, and all are judged the same way.

Defined cases: null or empty text: empty; null doc_id, repeated rows: each row by itself, so equal texts of ``width`` or
more are removed from all of them; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged
from .text import mix, span_hashes, text_blocks

#: Bytes of an anchor (long enough that texts seldom share one by chance), windows per run at most, contexts per owner in
#: one task at most.
ANCHOR, SPAN, HOT = 32, 168, 2048
#: Places of an owner's anchor in its contexts that are compared in pairs at most.
ANCHORS = 2048
#: Bytes of one suffix array, unless a single owner has more; symbols of the first rank.
BLOCK, HEAD = 1 << 20, 7


def _sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values."""
    n = len(h)
    if n < w:
        return h[:0]
    padded = np.concatenate([h, np.full(-n % w, np.uint64(0xFFFFFFFFFFFFFFFF))]).reshape(-1, w)
    ahead = np.minimum.accumulate(padded, 1).reshape(-1)
    back = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def runs(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, owner, context hash, repeats itself?) of every run; starts are within the text."""
    n, w = len(data), width - ANCHOR + 1
    none = np.zeros(0, np.int64)
    if n < width:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool)
    at = np.arange(n - ANCHOR + 1)
    h = span_hashes(data, at, at + ANCHOR)
    owner = _sliding_min(h, w)
    start = np.arange(len(owner))
    text = np.searchsorted(offsets, start, "right") - 1
    inside = start + width <= offsets[text + 1]
    start, text, owner = start[inside], text[inside], owner[inside]
    if not len(start):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool)
    new = np.ones(len(start), bool)
    new[1:] = (text[1:] != text[:-1]) | (owner[1:] != owner[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(start)), 0))
    new |= (np.arange(len(start)) - first) % SPAN == 0
    cut = np.flatnonzero(new)
    count = np.diff(np.append(cut, len(start)))
    begin, end = start[cut], start[cut] + count - 1 + width
    # A window that stands twice in a context holds its owner at two places at least.
    values = np.unique(owner[cut])
    where = np.flatnonzero(values[np.minimum(np.searchsorted(values, h), len(values) - 1)] == h)
    order = np.lexsort((where, h[where]))
    key, place = h[where][order], where[order]
    twice = _count_between(key, place, owner[cut], begin, end - ANCHOR) > 1
    return text[cut], begin - offsets[text[cut]], count, owner[cut], span_hashes(data, begin, end), twice


def _count_between(key, place, want, low, high) -> np.ndarray:
    """How many (key, place), sorted, have key ``want`` and low <= place <= high."""
    keys, first = np.unique(key, return_index=True)
    bounds = np.append(first, len(key))
    at = np.searchsorted(keys, want)
    rank = place + (np.repeat(np.arange(len(keys)), np.diff(bounds)).astype(np.int64) << 40)
    base = at.astype(np.int64) << 40
    return np.searchsorted(rank, base + high, "right") - np.searchsorted(rank, base + low, "left")


def _runs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column("row").to_numpy()
        for t in text_blocks(batch.column("text"), 2 << 20):
            text, start, count, owner, context, twice = runs(t.data, t.offsets, width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner.view(np.int64)), pa.array(context.view(np.int64)), pa.array(rows[text + t.first_row]),
                 pa.array(start), pa.array(count), pa.array(twice.astype(np.int32))],
                names=["owner", "context", "row", "start", "n", "twice"])


def suffix_array(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order of their first ``depth`` or more symbols (below 512), and their ranks by the first 7, 14, 28 ...
    symbols."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(HEAD, symbols.dtype)]).astype(np.uint64)
    head = np.zeros(n, np.uint64)
    for j in range(HEAD):
        head = (head << np.uint64(9)) | padded[j:j + n]
    levels, size = [np.unique(head, return_inverse=True)[1].astype(np.int32)], HEAD
    while size < depth:
        r = levels[-1].astype(np.int64)
        second = np.zeros(n, np.int64)
        if size < n:
            second[:-size] = r[size:] + 1
        levels.append(np.unique(r * np.int64(n + 2) + second, return_inverse=True)[1].astype(np.int32))
        size *= 2
    return np.argsort(levels[-1], kind="stable"), levels


def common_prefixes(symbols: np.ndarray, levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and at b, ``most`` at most."""
    length = np.zeros(len(a), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        size, r = HEAD << level, levels[level]
        fits = np.flatnonzero(length + size <= most)
        same = r[(a + length)[fits]] == r[(b + length)[fits]]
        length[fits[same]] += size
    for _ in range(HEAD - 1):
        on = np.flatnonzero(length < most)
        same = symbols[(a + length)[on]] == symbols[(b + length)[on]]
        length[on[same]] += 1
    return length


def maximal_intervals(lcp: list[int], left: list[int], width: int) -> Iterator[tuple[int, int, int]]:
    """(length, lo, hi) of the common-prefix intervals [lo, hi) of at least ``width`` whose suffixes have different left
    bytes (a byte of -1 differs from all), by a stack scan.  lcp[i] belongs to suffixes i - 1 and i."""
    def merge(x, y):
        return x if x == y and x != -1 else None

    stack: list[list] = []  # length, first suffix, the left byte they all have (None: several)
    for i in range(1, len(lcp) + 1):
        now = lcp[i] if i < len(lcp) else 0
        lo, byte = i - 1, (left[i - 1] if left[i - 1] != -1 else None)
        while stack and stack[-1][0] > now:
            length, lo, own = stack.pop()
            byte = merge(own, byte)
            if byte is None:
                yield length, lo, i
            # The interval's suffixes belong to the one below as well.
        if stack and stack[-1][0] == now:
            stack[-1][2] = merge(stack[-1][2], byte)
        elif now >= width:
            stack.append([now, lo, byte])


def block_repeats(contexts: list[bytes], counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """Maximal repeats among contexts whose first ``counts`` windows are to be judged.  Returns, for suffixes that lie in
    one, context number, start and length of the longest, and the groups (length, [(context, start)])."""
    size = np.array([len(c) for c in contexts], np.int64)
    # A symbol of its own ends every context, so that suffixes sort as the strings they are.
    symbols = np.frombuffer(b"".join(contexts), np.uint8).astype(np.uint16) + 1
    first = np.cumsum(size + 1) - size - 1
    symbols = np.insert(symbols, np.cumsum(size), 0)
    which = np.repeat(np.arange(len(contexts)), counts)
    valid = np.zeros(len(symbols), bool)
    valid[first[which] + np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)] = True
    of = np.repeat(np.arange(len(contexts)), size + 1)
    order, levels = suffix_array(symbols, int(size.max(initial=0)))
    order = order[valid[order]]
    room = (first + size)[of[order]] - order
    lcp = np.zeros(len(order), np.int64)
    lcp[1:] = common_prefixes(symbols, levels, order[:-1], order[1:], np.minimum(room[:-1], room[1:]))
    # The symbol before a suffix; one that begins its context differs from all.
    left = np.where(order == first[of[order]], -1, symbols[np.maximum(order - 1, 0)].astype(np.int64))
    # Intervals of ``width``: longest stretches of neighbours with that much in common.  One with a single left byte has
    # no left-diverse interval inside, so only the others are scanned.
    edge = np.flatnonzero(np.diff(np.concatenate([[False], lcp >= width, [False]]).astype(np.int8)))
    reach, groups = np.zeros(len(order), np.int64), []
    for lo, hi in zip((edge[::2] - 1).tolist(), edge[1::2].tolist(), strict=True):
        before = left[lo:hi]
        if before[0] != -1 and (before == before[0]).all():
            continue
        for length, a, b in maximal_intervals([0, *lcp[lo + 1:hi].tolist()], before.tolist(), width):
            np.maximum(reach[lo + a:lo + b], length, out=reach[lo + a:lo + b])
            groups.append((length, order[lo + a:lo + b]))
    hit = np.flatnonzero(reach)
    place = order[hit]
    return (of[place], place - first[of[place]], reach[hit],
            [(length, [(int(of[p]), int(p - first[of[p]])) for p in g]) for length, g in groups])


def _neighbours(group: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of fixed-width byte strings within their groups, and the bytes that each has in common with the one before
    (0 for the first of a group)."""
    keys = np.concatenate([group.astype(">u4")[:, None].view(np.uint8), strings], 1)
    order = np.argsort(keys.view(f"S{keys.shape[1]}").ravel(), kind="stable")
    keys = keys[order]
    differs = keys[1:] != keys[:-1]
    lcp = np.zeros(len(keys), np.int64)
    lcp[1:] = np.maximum(np.where(differs.any(1), differs.argmax(1), keys.shape[1]) - 4, 0)
    return order, lcp


def anchored_repeats(data: np.ndarray, low: np.ndarray, high: np.ndarray, at: np.ndarray, group: np.ndarray,
                     width: int) -> tuple[np.ndarray, np.ndarray]:
    """How many bytes before and from each anchor (at ``at``, in a context [low, high)) lie in strings of ``width`` or more
    that another anchor of its group has around it as well; 0 and 0 for none.

    Suffixes from the anchors and reversed prefixes before them are sorted within groups.  What two anchors have in common
    is the least common prefix of neighbours between them, kept as a running minimum over the suffixes' order and
    looked up by doubled stretches in the prefixes' order."""
    reach = width - ANCHOR
    after, before = np.minimum(high - at, width), np.minimum(at - low, reach)
    padded = np.concatenate([np.zeros(reach, np.uint8), data, np.zeros(width, np.uint8)])
    views = np.lib.stride_tricks.sliding_window_view
    right = np.where(np.arange(width) < after[:, None], views(padded, width)[at + reach], np.uint8(0))
    left = np.where(np.arange(reach) < before[:, None], views(padded, reach)[at][:, ::-1], np.uint8(0))
    order, common = _neighbours(group, right)
    by_left, least = _neighbours(group, left)
    rank = np.empty(len(at), np.int64)
    rank[by_left] = np.arange(len(at))
    rank, after, before = rank[order], after[order], before[order]
    table = [least]
    while len(at) >> len(table):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    far_before, far_after = np.zeros((2, len(at)), np.int64)
    i, same, gap = np.arange(len(at)), np.full(len(at), width), 0
    while len(i):
        gap += 1
        i, same = i[:np.searchsorted(i, len(at) - gap)], same[:np.searchsorted(i, len(at) - gap)]
        same = np.minimum(same, common[i + gap])
        on = same + before[i] >= width
        i, same = i[on], same[on]
        j = i + gap
        a, b = np.minimum(rank[i], rank[j]) + 1, np.maximum(rank[i], rank[j]) + 1
        level = np.log2(np.maximum(b - a, 1)).astype(np.int64)
        span = np.zeros(len(i), np.int64)
        for k in np.unique(level).tolist():
            of = np.flatnonzero(level == k)
            span[of] = np.minimum(table[k][a[of]], table[k][b[of] - (1 << k)])
        span = np.minimum(np.minimum(span, before[i]), before[j])
        ahead = np.minimum(np.minimum(same, after[i]), after[j])
        found = np.flatnonzero(span + ahead >= width)
        for x in (i[found], j[found]):
            far_before[x], far_after[x] = np.maximum(far_before[x], span[found]), np.maximum(far_after[x], ahead[found])
    out = np.zeros((2, len(at)), np.int64)
    out[:, order] = far_before, far_after
    return out[0], out[1]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by owner, in blocks of whole owners."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("bytes").nbytes
        if size < BLOCK:
            continue
        block = pa.concat_batches(held)
        owner = block.column("owner").to_numpy()
        cut = int(np.searchsorted(owner, owner[-1]))
        if cut:
            yield block.slice(0, cut)
        held = [block.slice(cut)]
        size = held[0].column("bytes").nbytes
    if held:
        yield pa.concat_batches(held)


def _judge(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches):
        owner, row, start, n = (block.column(c).to_numpy() for c in ("owner", "row", "start", "n"))
        t = next(text_blocks(block.column("bytes"), 1 << 62))
        group = np.cumsum(np.append(0, owner[1:] != owner[:-1]))
        at = np.arange(len(t.data) - ANCHOR + 1)
        at = np.flatnonzero(span_hashes(t.data, at, at + ANCHOR) == np.repeat(owner.view(np.uint64), t.sizes)[:len(at)])
        of = np.searchsorted(t.offsets, at, "right") - 1
        inside = at + ANCHOR <= t.offsets[of + 1]
        at, of = at[inside], of[inside]
        many = np.bincount(group[of], minlength=group[-1] + 1) > ANCHORS
        few = ~many[group[of]]
        at, of = at[few], of[few]
        low, high = t.offsets[of], t.offsets[of + 1]
        before, after = anchored_repeats(t.data, low, high, at, group[of], width)
        hit = np.flatnonzero(after)
        yield _spans(row[of[hit]], (start[of] + at - low - before)[hit], (before + after)[hit])
        for g in np.flatnonzero(many):
            own = np.flatnonzero(group == g)
            context, begin, length, _ = block_repeats([t.data[t.offsets[i]:t.offsets[i + 1]].tobytes() for i in own], n[own], width)
            yield _spans(row[own][context], start[own][context] + begin, length)


def _spans(row: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(row), pa.array(start), pa.array(start + length)], names=["row", "start", "end"])


def _lefts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every asked run with the byte before it (-1: the text begins there)."""
    for batch in batches:
        for row, text, asked in zip(*[batch.column(c) for c in ("row", "text", "asked")], strict=True):
            text = text.as_buffer()
            owner, context, start, n = (np.asarray(asked.values.field(c)) for c in ("owner", "context", "start", "n"))
            before = np.frombuffer(text, np.uint8)[np.maximum(start - 1, 0)].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner), pa.array(context), pa.array(np.full(len(start), row.as_py())), pa.array(start), pa.array(n),
                 pa.array(np.where(start > 0, before, -1).astype(np.int32))],
                names=["owner", "context", "row", "start", "n", "left"])


def _first_windows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The windows of the asked contexts, by hash, with the least and largest byte before them in all copies."""
    for batch in batches:
        for text, asked in zip(batch.column("text"), batch.column("asked"), strict=True):
            data = np.frombuffer(text.as_buffer(), np.uint8)
            fields = [np.asarray(asked.values.field(c)) for c in ("owner", "context", "start", "n", "copies", "lo", "hi")]
            for i in range(0, len(fields[0]), 2048):
                owner, context, start, n, copies, lo, hi = (f[i:i + 2048] for f in fields)
                offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                at = np.repeat(start, n) + offset
                before = data[np.maximum(at - 1, 0)].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(span_hashes(data, at, at + width).view(np.int64)), pa.array(np.repeat(owner, n)),
                     pa.array(np.repeat(context, n)), pa.array(offset), pa.array(np.repeat(copies, n)),
                     pa.array(np.where(offset > 0, before, np.repeat(lo, n)).astype(np.int32)),
                     pa.array(np.where(offset > 0, before, np.repeat(hi, n)).astype(np.int32))],
                    names=["window", "owner", "context", "offset", "copies", "lo", "hi"])


def _tails(batches: Iterator[pa.RecordBatch], skip: int, size: int) -> Iterator[pa.RecordBatch]:
    """``size`` bytes of every asked suffix after its first ``skip``, fewer where the text ends."""
    names = ["key", "row", "start", "left", "tail"]
    for batch in batches:
        for row, text, asked in zip(*[batch.column(c) for c in ("row", "text", "asked")], strict=True):
            text, row, out, held = text.as_py(), row.as_py(), [], 0
            for a in asked.as_py():
                out.append((a["key"], row, a["start"], a["left"], text[a["start"] + skip:a["start"] + skip + size]))
                held += len(out[-1][4])
                if held > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=names)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=names)


def _same(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax())


def _branch(batches: Iterator[pa.RecordBatch], skip: int, size: int, width: int) -> Iterator[pa.RecordBatch]:
    """Of suffixes sorted by key and tail, those of one key equal in their first ``skip`` bytes: the maximal repeats that
    end within the tails (``on`` false), and the groups that are equal to the end of full tails (``on`` true)."""
    def groups():
        group: list[tuple] = []
        for batch in batches:
            for r in zip(*[batch.column(c).to_pylist() for c in ("key", "row", "start", "left", "tail")], strict=True):
                if group and r[0] != group[0][0]:
                    yield group
                    group = []
                group.append(r)
        if group:
            yield group

    for group in groups():
        lcp = [0, *(skip + _same(x[4], y[4]) for x, y in zip(group, group[1:]))]
        for length, lo, hi in maximal_intervals(lcp, [r[3] for r in group], max(skip, width)):
            on = length == skip + size
            # Equal keys and equal tails: equal strings so far.
            key = hashlib.blake2b(group[lo][0] + group[lo][4], digest_size=16).digest() if on else b""
            yield pa.RecordBatch.from_arrays(
                [pa.array([on]), pa.array([key]), pa.array([length]),
                 pa.array([[{"row": r[1], "start": r[2], "left": r[3]} for r in group[lo:hi]]],
                          pa.list_(pa.struct([("row", pa.int64()), ("start", pa.int64()), ("left", pa.int32())])))],
                names=["on", "key", "length", "places"])


def _contexts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, text, asked in zip(batch.column("row").to_pylist(), batch.column("text"), batch.column("asked"), strict=True):
            data = np.frombuffer(text.as_buffer(), np.uint8)
            fields = [np.asarray(asked.values.field(c)) for c in ("owner", "start", "n")] + [asked.values.field("hot").to_numpy(False)]
            for i in range(0, len(fields[0]), 2048):
                owner, start, n, hot = (f[i:i + 2048] for f in fields)
                offsets = np.append(0, np.cumsum(n - 1 + width))
                at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], np.diff(offsets))
                pieces = pa.BinaryArray.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[at])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner), pa.array(np.full(len(n), row)), pa.array(start), pa.array(n), pieces, pa.array(hot)],
                    names=["owner", "row", "start", "n", "bytes", "hot"])


def _windows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Every window of the contexts by 128 bits of hash."""
    for batch in batches:
        for i in range(0, len(batch), 2048):
            part = batch.slice(i, 2048)
            t = next(text_blocks(part.column("bytes"), 1 << 62))
            n = part.column("n").to_numpy()
            at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            begin = np.repeat(t.offsets[:-1], n) + at
            half = begin + width // 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(span_hashes(t.data, begin, begin + width).view(np.int64)),
                 pa.array(mix(span_hashes(t.data, begin, half) ^ mix(span_hashes(t.data, half, begin + width) + np.uint64(1)))
                          .view(np.int64)),
                 pa.array(np.repeat(part.column("row").to_numpy(), n)), pa.array(np.repeat(part.column("start").to_numpy(), n) + at)],
                names=["h1", "h2", "row", "start"])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
            text, kept, at, removed, n = text.as_py(), hashlib.sha256(), 0, 0, 0
            for start, end in merged(spans):
                kept.update(text[at:start])
                at, removed, n = end, removed + end - start, n + 1
            kept.update(text[at:])
            out.append((len(text), removed, n, kept.hexdigest()))
        yield pa.RecordBatch.from_arrays([batch.column("row"), *[pa.array(c) for c in zip(*out, strict=True)]],
                                         names=["row", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def merged(spans: pa.Scalar) -> list[tuple[int, int]]:
    """Maximal runs of the union of the spans; spans that touch are one run."""
    if not spans.is_valid or not len(spans.values):
        return []
    start, end = (np.asarray(spans.values.field(i)) for i in (0, 1))
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    cut = np.flatnonzero(start[1:] > end[:-1])
    return list(zip(start[np.append(0, cut + 1)].tolist(), end[np.append(cut, len(end) - 1)].tolist(), strict=True))


def _staged(df: DataFrame, name: str) -> DataFrame:
    """:func:`staged`, after which the shuffle files of ``df`` are deleted: only the staged rows are read again."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return staged(df, name)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


class Repeats:
    """The repeats of at least ``width`` bytes of ``docs`` (doc_id, text)."""

    def __init__(self, docs: DataFrame, width: int = 200):
        self.width = width
        self.parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
        self.base = staged(docs.select(F.monotonically_increasing_id().alias("row"),
                                       F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")), "texts")
        runs_ = self.base.select("row", "text").filter(F.octet_length("text") >= width).mapInArrow(
            lambda it: _runs(it, width), "owner long, context long, row long, start long, n long, twice int")
        # One exchange and one sort serve all that is asked of an owner's runs: a run beside one of its context stands whole
        # elsewhere, and the first of each context stands for it.
        own = Window.partitionBy("owner")
        near = own.orderBy("context", "row", "start")
        marked = runs_.repartition(self.parts, "owner").withColumns({
            "first": ~F.lag("context").over(near).eqNullSafe(F.col("context")),
            "last": ~F.lead("context").over(near).eqNullSafe(F.col("context"))}).withColumns({
                "contexts": F.sum(F.col("first").cast("long")).over(own), "most": F.max("twice").over(own)})
        # Owners of one run that does not repeat within itself are done.
        self.open = _staged(marked.filter("not (first and last) or contexts > 1 or most > 0").select(
            "owner", "context", "row", "start", "n", "twice", F.expr("not (first and last)").alias("whole"),
            F.expr("first and (contexts > 1 or most > 0)").alias("look"), (F.col("contexts") > HOT).alias("hot")), "shared")

    @cached_property
    def classes(self) -> DataFrame:
        """(owner, context, copies, twice, one): the distinct contexts and one occurrence of each."""
        return staged(self.open.groupBy("owner", "context").agg(
            F.count("*").alias("copies"), F.max("twice").alias("twice"), F.min(F.struct("row", "start", "n")).alias("one")), "classes")

    @cached_property
    def contexts(self) -> DataFrame:
        """(owner, row, start, n, bytes, hot): one occurrence of every context of the owners that need looking into."""
        width = self.width
        asked = self.open.filter("look").groupBy("row").agg(F.collect_list(F.struct("owner", "start", "n", "hot")).alias("asked"))
        return _staged(self.base.select("row", "text").join(asked, "row").select("row", "text", "asked").mapInArrow(
            lambda it: _contexts(it, width), "owner long, row long, start long, n long, bytes binary, hot boolean"), "contexts")

    def by_owner(self) -> DataFrame:
        return self.contexts.filter("not hot").drop("hot").repartition(self.parts, "owner").sortWithinPartitions("owner")

    def spans(self) -> DataFrame:
        """(row, start, end): spans that together cover every byte of a repeated string, and no other."""
        width, schema = self.width, "row long, start long, end long"
        whole = self.open.filter("whole").select("row", "start", (F.col("start") + F.col("n") - 1 + width).alias("end"))
        some = self.by_owner().mapInArrow(lambda it: _judge(it, width), schema)
        windows = self.contexts.filter("hot").mapInArrow(lambda it: _windows(it, width), "h1 long, h2 long, row long, start long")
        often = windows.groupBy("h1", "h2").agg(F.count("*").alias("m")).filter("m > 1").drop("m")
        many = windows.join(often, ["h1", "h2"]).select("row", "start", (F.col("start") + width).alias("end"))
        return whole.unionByName(some).unionByName(many)

    def _begins(self) -> DataFrame:
        """(key, row, start, left): all occurrences of the windows with which a maximal repeat can begin, which are those that
        repeat after different bytes (the begin of a text differs from all).  Inside equal contexts the byte before
        is the same, so one context of each class is looked into, and only its first window if the owner has no other."""
        width, texts = self.width, self.base.select("row", "text")
        asked = self.open.groupBy("row").agg(F.collect_list(F.struct("owner", "context", "start", "n")).alias("asked"))
        runs_ = staged(texts.join(asked, "row").select("row", "text", "asked").mapInArrow(
            _lefts, "owner long, context long, row long, start long, n long, left int"), "lefts")
        before = runs_.groupBy("owner", "context").agg(F.min("left").alias("lo"), F.max("left").alias("hi"))
        alone = self.classes.groupBy("owner").agg((F.count("*") + F.max("twice") == 1).alias("alone"))
        asked = (self.classes.join(before, ["owner", "context"]).join(alone, "owner")
                 .select("one.row", F.struct("owner", "context", "one.start", F.expr("if(alone, 1L, one.n)").alias("n"),
                                             "copies", "lo", "hi").alias("a"))
                 .groupBy("row").agg(F.collect_list("a").alias("asked")))
        windows = texts.join(asked, "row").select("text", "asked").mapInArrow(
            lambda it: _first_windows(it, width),
            "window long, owner long, context long, offset long, copies long, lo int, hi int")
        begin = (windows.groupBy("window").agg(F.sum("copies").alias("m"), F.min("lo").alias("least"), F.max("hi").alias("most"))
                 .filter("m > 1 and (least = -1 or least < most)").select("window"))
        return (windows.join(begin, "window").select("window", "owner", "context", "offset", "lo")
                .join(runs_, ["owner", "context"])
                .select(F.col("window").cast("string").cast("binary").alias("key"), "row", (F.col("start") + F.col("offset")).alias("start"),
                        F.expr("if(offset = 0, left, lo)").alias("left")))

    def maximal(self) -> DataFrame:
        """(string, length, places): all strings of ``width`` bytes or more that stand at several places (row, start), with
        different bytes before them and different bytes after them (where a text begins or ends differs from all),
        and all of their places.

        The suffixes that can begin one are sorted within their first 2 ``width`` bytes, those that are equal in all of
        these within as many bytes again, and so on: each round doubles the length, until no two are equal."""
        width, texts = self.width, self.base.select("row", "text")
        open_, found, skip, size = staged(self._begins(), "begins"), [], 0, 2 * width
        while not open_.isEmpty():
            asked = open_.groupBy("row").agg(F.collect_list(F.struct("key", "start", "left")).alias("asked"))
            tails = texts.join(asked, "row").select("row", "text", "asked").mapInArrow(
                lambda it, skip=skip, size=size: _tails(it, skip, size),
                "key binary, row long, start long, left long, tail binary")
            done = staged(tails.repartition(self.parts, "key").sortWithinPartitions("key", "tail").mapInArrow(
                lambda it, skip=skip, size=size: _branch(it, skip, size, width),
                "on boolean, key binary, length long, places array<struct<row: long, start: long, left: int>>"), "branches")
            found.append(done.filter("not on").select("length", "places"))
            open_ = done.filter("on").select("key", F.explode("places").alias("p")).select("key", "p.*")
            skip, size = skip + size, skip + size
        if not found:
            found = [self.base.sparkSession.createDataFrame([], "length long, places array<struct<row: long, start: long, left: int>>")]
        groups = reduce(DataFrame.unionByName, found).select(
            "length", F.expr("transform(places, p -> struct(p.row, p.start))").alias("places"))
        return (groups.join(texts, F.col("places")[0]["row"] == F.col("row")).select(
            F.expr("substring(text, cast(places[0].start + 1 as int), cast(length as int))").alias("string"), "length", "places"))

    def removed(self) -> DataFrame:
        """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
        found = _staged(self.spans(), "spans").groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
        done = (self.base.select("row", "text").join(found, "row", "left").select("row", "text", "spans")
                .mapInArrow(_remove, "row long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
        return self.base.select("row", "doc_id").join(done, "row").drop("row")
