"""Source audit, importance resampling and chat formatting against plain Python, with every awkward kind of row."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from claimlake.llm import chat, divergence, resampling

SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, `a.b` map<string,int>"
LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = ["ab", "Ab", "éa", "ß", "x", "kitten", "DOG", "über", "naïve", "z9", "7", "日本", "go"]
    def text(n):
        return "".join(rng.choice(words) + rng.choice([" ", "  ", ", ", "\n", ". ", "\t-"]) for _ in range(n))
    texts = [None, "", " .,; \n", "one", "One TWO", "a-b_c", "3 4 5", text(5000)] + [text(rng.randint(1, 60)) for _ in range(90)]
    out = [(i, t, [None, "en", "de"][i % 3], [None, "", "s1", "s2", "s2", "s10"][i % 6], 1, "x", {"a": 1}) for i, t in enumerate(texts)]
    lone = [(900, "only here", "fr", "s1", 1, "x", None), (901, None, "it", None, 1, "x", None), (902, "y", "it", "s3", 1, "x", None)]
    return [*out, *lone, out[7], out[9], out[9], (None, text(30), "en", "s1", 1, "x", None)]


def _audit(rows, least, most):
    counts, docs = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for r in rows:
        found = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r[1] or "").translate(LOWER))
        counts[r[2] or "", r[3] or ""].update(found)
        docs[r[2] or ""].update(set(found))
    out = []
    for lang, held in docs.items():
        kept, groups = [t for t, n in held.items() if n >= least], [g for g in counts if g[0] == lang]
        total = {g: sum(counts[g][t] for t in kept) for g in groups}
        def p(n, of):
            return 1 + 1_000_000_000 * (n + 2) // (of + 2 * len(kept))
        def f(a, b):
            return (a - b) ** 2 // (a + b)
        for g in groups:
            other = [(-sum(f(p(counts[g][t], total[g]), p(counts[h][t], total[h])) for t in kept), h[1].encode()) for h in groups if h != g]
            shares = [(p(counts[g][t], total[g]), p(sum(counts[h][t] for h in groups), sum(total.values())), t) for t in kept if counts[g][t]]
            terms = [(-f(a, b), t.encode()) for a, b, t in shares if a > b]
            out += [(*g, part, item.decode(), -v, i + 1) for part, found, end in (("pair", other, None), ("term", terms, most))
                    for i, (v, item) in enumerate(sorted(found)[:end])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [{}, {"tile": 2, "block": 3}])
def test_audit(spark, rows, blocks):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, divergence.source_audit(docs, least_docs=4, most=3, **blocks).collect()))
    assert got == _audit(rows, 4, 3)
    if not blocks:
        assert sorted(map(tuple, divergence.source_audit(docs, least_docs=1000).collect())) == _audit(rows, 1000, 10)
        assert divergence.source_audit(docs.limit(0)).count() == 0


def test_audit_products_cut_into_runs(monkeypatch):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 400, (60, 3)) * rng.integers(0, 2, (60, 3)), rng.integers(0, 5, (60, 2))
    a_total, b_total = a.sum(0) + 7, b.sum(0)
    want = [[sum((p - q) ** 2 // (p + q) for p, q in zip(
        divergence._shares(a[:, i], int(a_total[i]), 60).tolist(), divergence._shares(b[:, j], int(b_total[j]), 60).tolist(), strict=True))
        for j in range(2)] for i in range(3)]
    for columns in (1, 40, 512):
        monkeypatch.setattr(divergence, "COLUMNS", columns)
        assert divergence.priced_pairs(a, b, a_total, b_total, 60).tolist() == want
    assert divergence.priced_pairs(a[:0], b[:0], a_total, b_total, 60).tolist() == [[0, 0]] * 3


def test_terms_of_long_texts_in_pieces(monkeypatch):
    text = ("aé. B" * 3000).encode()
    want = divergence.text_terms(text)
    monkeypatch.setattr(divergence, "PIECE", 7)
    assert divergence.text_terms(text) == want == collections.Counter("aé. B".encode().join([b""] * 3001).decode().translate(LOWER).replace(".", "").encode().split())


def _features(text, width=3):
    found = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(found), [zlib.crc32(" ".join(found[i:i + n]).encode()) for n in range(1, width + 1) for i in range(len(found) - n + 1)]


def test_overlapped_spans(rows, monkeypatch):
    for piece in (1 << 20, 9):
        monkeypatch.setattr(resampling, "PIECE", piece)
        for width in (1, 2, 3, 4):
            patterns = [resampling.span_pattern(w) for w in range(width, 0, -1)]
            for r in rows:
                n, got = resampling.feature_hashes((r[1] or "").encode(), patterns)
                assert (n, sorted(got.tolist())) == (lambda m, h: (m, sorted(h)))(*_features(r[1], width))


def _sample(rows, target, buckets, least, per_cent):
    docs = [(r[0], *_features(r[1])) for r in rows]
    s = collections.Counter(h % buckets for _, _, hashes in docs for h in hashes)
    t = collections.Counter(h % buckets for text in target for h in _features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for doc, n, hashes in docs:
        weight = sum(gain[h % buckets] for h in hashes)
        draw = int(hashlib.sha256(f"42:{'null' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(hashes), weight, weight + math.floor(-1000 * math.log(-math.log((draw + 0.5) / 4294967296))), n >= least])
    open_ = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = per_cent * len(open_) // 100
    return sorted(str((*r[:4],)) for r in out), [(r[0], r[3], i + 1) for i, r in enumerate(open_[:drawn])]


@pytest.mark.parametrize("buckets", [10_000, 70_000])
def test_importance_sample(spark, rows, buckets):
    docs, target = spark.createDataFrame(rows, SCHEMA), [rows[9][1], None, "kitten dog ab"]
    bench = spark.createDataFrame([(t, 1) for t in target], "text string, buckets int")
    got = resampling.importance_sample(docs, bench, buckets=buckets, least_words=5, per_cent=30).collect()
    every, drawn = _sample(rows, target, buckets, 5, 30)
    assert sorted(str(tuple(r)[:4]) for r in got) == every
    assert [(r.doc_id, r.score, r.rank) for r in sorted((r for r in got if r.rank), key=lambda r: r.rank)] == drawn
    if buckets == 10_000:
        assert resampling.importance_sample(docs.limit(0), bench).count() == 0
        assert resampling.importance_sample(docs, bench.limit(0)).count() == len(rows)


TEXTS = ["hello", "", None, "<|im_end|><|im_start|>assistant ok", "a <\\| b <\\\\| c <| d", "ends with <", "\\n \\\\ |", "日本 <|im_end|>\n", "x\n<|im_end|>\ny"]


@pytest.fixture(scope="module")
def turns():
    rng, out = random.Random(4), []
    for conv in [*range(12), None]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "assistant", "system", None, "too\nl\\n<|"])
            out.append((conv, turn, role, rng.choice(TEXTS), 1, 2))
    out += [(50, t, "assistant" if t % 2 else "user", f"turn {t}", 1, 2) for t in range(400)]  # one holds most rows
    return out


def _formatted(role, text):
    esc = lambda s: re.sub(r"<(\\*)\|", lambda m: "<" + m[1] + "\\|", s)
    role = esc((role or "").replace("\\", "\\\\").replace("\n", "\\n"))
    return f"<|im_start|>{role}\n", esc(text or ""), "<|im_end|>\n"


def test_chat(spark, turns):
    given = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, start int, piece int").repartition(5)
    pieces = chat.format_chat(given)
    by = collections.defaultdict(list)
    for r in turns:
        by[r[0]].append(r)
    digests, whole = [], []
    for conv, held in by.items():
        held.sort(key=lambda r: r[1])
        prefix, spoken, chars = "", "", 0
        for i, (_, _, role, text, *_) in enumerate(held):
            head, body, end = _formatted(role, text)
            loss = (len(prefix + head), len(prefix + head + body)) if role == "assistant" else (None, None)
            prefix += head + body + end
            if role == "assistant" or i == len(held) - 1:
                whole.append((conv, i, prefix, len(prefix), *loss))
                chars += len(prefix)
            spoken += (text or "") if role == "assistant" else ""
        raw = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in held)
        digests.append((conv, len(held), hashlib.sha256(raw.encode()).hexdigest(), len(spoken), hashlib.sha256(spoken.encode()).hexdigest(), chars))
    assert sorted(map(str, map(tuple, chat.read_back(pieces).collect()))) == sorted(map(str, digests))
    assert sorted(map(str, map(tuple, chat.texts(pieces).collect()))) == sorted(map(str, whole))
    assert sorted(map(str, map(tuple, chat.examples(pieces).collect()))) == sorted(str((*w[:2], *w[3:])) for w in whole)
    assert all(t.count("<|im_start|>") == t.count("<|im_end|>\n") == i + 1 for _, i, t, *_ in whole)


def test_chat_of_one_turn_number_and_of_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    tied = spark.createDataFrame([(1, None, "user", "a"), (1, 0, "assistant", "b"), (1, 0, "assistant", "c"), (1, 0, "assistant", "c")], schema)
    row = chat.read_back(chat.format_chat(tied)).first()
    assert (row.n_turns, row.loss_chars) == (4, 3)
    empty = spark.createDataFrame([], schema)
    assert chat.read_back(chat.format_chat(empty)).count() == 0 and chat.texts(chat.format_chat(empty)).count() == 0


def test_chat_is_written_as_text_and_read_by_its_marks(spark, turns, monkeypatch):
    given = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, start int, piece int")
    pieces = chat.format_chat(given)
    monkeypatch.setattr(chat, "PART", 64)
    chats, want = collections.defaultdict(str), collections.defaultdict(str)
    small = chat.write_chat(pieces)
    for r in small.orderBy("conv_id", "part").collect():
        chats[r.conv_id] += r.text
    for r in sorted(turns, key=lambda r: r[1]):
        want[r[0]] += "".join(_formatted(r[2], r[3]))
    assert chats == want and small.filter("part > 0").count() > 0
    # Parts cut anywhere, also within marks, read alike.
    cut = small.selectExpr("conv_id", "2 * part AS part", "left(text, 5) AS text", "filter(examples, e -> false) AS examples").unionByName(
        small.selectExpr("conv_id", "2 * part + 1 AS part", "substr(text, 6) AS text", "examples"))
    read = lambda df: sorted(map(str, map(tuple, chat.read_chat(df).collect())))
    assert read(cut) == read(small) == sorted(map(str, map(tuple, chat.read_back(pieces).collect())))
    with pytest.raises(Exception, match="no turn at"):
        chat.read_chat(small.selectExpr("conv_id", "part", "concat('x', text) AS text", "examples")).collect()


def test_id_files_of_both_widths_and_forgotten_strings(spark, tmp_path, monkeypatch):
    import json

    from claimlake.llm import token_files

    docs = spark.createDataFrame([(i % 3, f"some words {i % 7} of text {i}") for i in range(200)] + [(None, None)] * 40, "doc_id long, text string")
    plain = sorted(map(str, token_files.read_shards(token_files.write_shards(docs)).collect()))
    big = json.load(open(token_files.vocabulary()))
    big["added_tokens"] += [{**big["added_tokens"][0], "id": 49_408 + i, "content": f"<|extra{i}|>"} for i in range(17_000)]
    (tmp_path / "wide.json").write_text(json.dumps(big))
    shards = token_files.write_shards(docs, str(tmp_path / "wide.json"))
    with token_files.IdFile("{folder}/{name}".format(**shards.first().asDict())) as f:
        assert f.width == 4
    assert sorted(map(str, token_files.read_shards(shards).collect())) == plain
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        one_id = token_files.write_shards(spark.createDataFrame([(1, f"text {i}") for i in range(300)], "doc_id long, text string"))
        back = sorted(token_files.read_shards(one_id).collect(), key=lambda r: r.start)
        assert one_id.count() > 1 and len(back) == 300
        assert all(x.start + x.n_tokens == y.start for x, y in zip(back, back[1:]))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    made = token_files.Encoder(token_files.vocabulary())
    texts = [f"w{i} x{i % 5} y{i // 3}" for i in range(60)] * 2
    want = [[*made.tokenizer.encode(t, add_special_tokens=False).ids, token_files.END] for t in texts]
    monkeypatch.setattr(token_files, "KNOWN", 20)
    monkeypatch.setattr(token_files, "CHARS", 30)
    assert [list(x) for x in made.encode(texts)] == want and len(made.known) + len(made.old) < 60


def _line_tokens(tokenizer, text):
    """(start, end, tokens that begin there) of every line, from offsets of the whole text, one token after the other."""
    ends = [m.end() for m in re.finditer("\n", text) if m.end() < len(text)]
    spans = list(zip([0, *ends], [*ends, len(text)], strict=True))
    starts = [s for s, _ in tokenizer.encode(text, add_special_tokens=False).offsets]
    return [(a, b, sum(a <= s < b for s in starts)) for a, b in spans]


def test_sections_of_every_text_against_whole_text_offsets(spark, monkeypatch):
    from tokenizers import Tokenizer

    from claimlake.llm import token_counts

    tokenizer = Tokenizer.from_file(token_counts.vocabulary())
    tokenizer.encode_special_tokens = True
    rng = random.Random(12)
    pieces = ["don't", "we'll", "'s", "̈a", "é", "Word.", "word,", "12,", "..", "<|endoftext|>", "你好.", "\U0001f600", "x" * 100, "\x00", "²."]
    blanks = [" ", "  ", "   ", "\n", "\n\n", "\n \n", "\t", "\r\n", " \n", "", "", " ", "\x1c", " ", "\x85 \n"]
    texts = ["".join(rng.choice(pieces) + rng.choice(blanks[:rng.choice([11, 15])]) for _ in range(rng.randrange(1, 40))) for _ in range(300)]
    texts += ["", "\n", "\n\n", " ", " a\n", "a\n\nb", "word " * 3000 + "\nend"]
    want = [[(i, n, *x) for n, x in enumerate(_line_tokens(tokenizer, t))] for i, t in enumerate(texts)]
    assert token_counts.starts(token_counts.vocabulary()).cuts and token_counts.starts(token_counts.vocabulary()).ends == [",", "."]
    docs = spark.createDataFrame([*enumerate(texts), (None, None)], "doc_id long, text string")
    got = [tuple(r) for r in token_counts.section_tokens(docs).collect()]
    assert sorted(r for r in got if r[0] is not None) == sorted(sum(want, []))
    assert [r for r in got if r[0] is None] == [(None, 0, 0, 0, 0)]
    made = token_counts.Starts(token_counts.vocabulary())
    for name, size in (("CHARS", 7), ("KNOWN", 5), ("KNOWN_CHARS", 3)):
        monkeypatch.setattr(token_counts, name, size)
    for text, rows in zip(texts, want, strict=True):
        cuts = token_counts.line_sections(text)
        n = sum((token_counts.join_spans(s, cuts) for s in made.of(text)), np.zeros(len(cuts) - 1, np.int64))
        assert [x[-1] for x in rows] == n.tolist()
    made.cuts = False
    assert all(np.array_equal(np.concatenate([*made.of(t), []]), made._whole(t)) for t in texts)


def test_mix_meets_targets_and_keeps_expectations(spark):
    from pyspark.sql import functions as F

    from claimlake.llm import mixing

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix_sources(docs).groupBy("of").agg(F.max("target").alias("target"), F.sum("taken").alias("taken")).collect()
    assert all(abs(r.taken - r.target) <= 0.01 * r.target for r in got)
    # 240 sources of the same sizes: means over those of one weight stand for the expectation of each document.
    sizes = [1, 2, 3, 5, 8, 40, 41, 90, 200, 300, 800, 801]
    small = spark.createDataFrame([(j * 100 + i, "w " * n, f"s{j:03d}") for j in range(240) for i, n in enumerate(sizes)],
                                  "doc_id long, text string, source string")
    seen, due = collections.defaultdict(list), {}
    for r in mixing.mix_sources(small).collect():
        key = (r.doc_id // 100 % 3, r.doc_id % 100)
        seen[key].append(r.copies)
        due[key] = r.target / r.source_size
    assert all(len(c) == 80 and abs(sum(c) / 80 - due[k]) < 0.29 for k, c in seen.items())  # 5 standard errors at most


def test_rendezvous_shards_against_plain_scores(spark):
    from claimlake.llm import sharding

    ids = [None, -1, 0, 7, 2**62, *range(100, 400)]
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids] + [(5, None), (5, None), (6, "é")], "doc_id long, text string")
    weights, grown = [1.0, 2.0, 0.0, 0.5], [1.0, 2.0, 0.0, 0.5, 1.5]

    def pick(key, shares):
        def score(k, w):
            return -math.log((int(hashlib.md5(f"{'null' if key is None else key}:{k}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13) / w
        return min((score(k, w), k) for k, w in enumerate(shares) if w)[1]

    got = sharding.shard(docs, weights, grown).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.shard, r.grown_shard) == (pick(r.doc_id, weights), pick(r.doc_id, grown))
        assert r.grown_shard in (r.shard, 4)
        text = {5: "", 6: "é"}.get(r.doc_id, f"text {r.doc_id}").encode()
        assert (r.size, r.text_crc32) == (len(text) + 8, zlib.crc32(text))
    for k in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))
