"""op2: contexts compared around their anchors, periodic texts, one exchange of the runs."""

import hashlib
import random
import time

import numpy as np
import pyarrow as pa

from claimlake.llm import repeats


def _contexts(rng, width):
    """Near copies of a few texts, cut to contexts as their runs ask."""
    texts = []
    for _ in range(6):
        text = bytearray(rng.choices(b"abcdefgh ", k=900))
        for _ in range(4):
            copy = bytearray(text)
            for _ in range(rng.randint(1, 8)):
                copy[rng.randrange(len(copy))] = 33
            texts.append(bytes(copy))
    texts += [b"ab" * 300, b"abc" * 200 + b"x" + b"abc" * 100]
    rows = {}
    for text in texts:
        data = np.frombuffer(text, np.uint8)
        for _, s, n, owner, context, _ in zip(*repeats.runs(data, np.array([0, len(data)]), width)):
            rows.setdefault((int(owner.view(np.int64)), int(context)), (text[s:s + n - 1 + width], int(n)))
    return sorted((o, c, *v) for (o, c), v in rows.items())


def _covered(batches):
    return {(r, i) for b in batches for r, s, e in zip(*[b.column(c).to_pylist() for c in ("row", "start", "end")]) for i in range(s, e)}


def test_anchored_repeats_are_those_of_the_suffix_array(monkeypatch):
    rows = _contexts(random.Random(3), 100)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows]), pa.array(range(len(rows))), pa.array([0] * len(rows)), pa.array([r[3] for r in rows]),
         pa.array([r[2] for r in rows], pa.binary())], names=["owner", "row", "start", "n", "bytes"])
    context, start, length, _ = repeats.block_repeats([r[2] for r in rows], np.array([r[3] for r in rows]), 100)
    want = {(c, i) for c, s, n in zip(context.tolist(), start.tolist(), length.tolist()) for i in range(s, s + n)}
    assert len({c for c, _ in want}) > 20
    monkeypatch.setattr(repeats, "BLOCK", 4000)
    parts = [batch.slice(i, 7) for i in range(0, len(rows), 7)]
    assert _covered(repeats._judge(iter(parts), 100)) == want
    monkeypatch.setattr(repeats, "ANCHORS", 0)   # every owner by the whole suffix array
    assert _covered(repeats._judge(iter(parts), 100)) == want


def test_removed_of_near_copies_and_periods(spark):
    rng = random.Random(9)
    base = "".join(rng.choices("abcdefghij ", k=2500))
    texts = [base, base, base[:700] + "#" + base[700:], base[:900] + base[1500:], "", None, "z" * 450, "xy" * 260, base[:199], base[:200],
             "".join(rng.choices("klmnop", k=300)) + base[1000:1260]]
    got = {r.doc_id: r for r in repeats.Repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).removed().collect()}
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for i, t in enumerate(raw):
        for p in range(len(t) - 199):
            seen.setdefault(t[p:p + 200], []).append((i, p))
    hit = [bytearray(len(t)) for t in raw]
    for places in seen.values():
        for i, p in places if len(places) > 1 else ():
            hit[i][p:p + 200] = b"\1" * 200
    for i, t in enumerate(raw):
        kept = bytes(b for b, h in zip(t, hit[i]) if not h)
        spans = sum(1 for p in range(len(t)) if hit[i][p] and not (p and hit[i][p - 1]))
        assert tuple(got[i]) == (i, len(t), sum(hit[i]), spans, hashlib.sha256(kept).hexdigest())


def test_shuffle_files_of_a_step_are_deleted(spark):
    """What a step dealt out is deleted with it, and its setting is left as it was."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    docs = spark.createDataFrame([(i, f"{i % 3} " * 200) for i in range(20)], "doc_id long, text string")
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    left = lambda: sum(disk.getAllFiles().apply(i).getName().startswith("shuffle_") for i in range(disk.getAllFiles().size()))
    files = left()
    assert repeats.Repeats(docs).contexts.schema.names[0] == "owner"
    until = time.time() + 30
    while left() > files and time.time() < until:   # executors delete them in their own time
        time.sleep(0.2)
    assert left() <= files
    assert spark.conf.get(key, None) == before
