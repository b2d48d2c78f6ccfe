"""Training-data operators against brute force, on small tables with every awkward kind of row."""

from __future__ import annotations

import collections
import hashlib
import io
import random
import re
import zlib

import numpy as np
import pytest

from claimlake.llm import decontaminate, langid, mixing, near_dedup, repeats, sharding, token_counts, token_files, topk, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, mark double, n long, spans string"


def _words(rng, n):
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    long = _words(rng, 4000)
    passage = _words(rng, 70)
    texts = [None, "", " \n\t", "12 34 !", "one", "two words", long, long, passage, passage, f"x {passage} y", "ab " * 300,
             long[:900] + " changed " + long[900:], "<|endoftext|> " + _words(rng, 30)]
    texts += [_words(rng, rng.randint(1, 200)) for _ in range(30)]
    texts += [_words(rng, 40) + " " + passage + " " + _words(rng, 40) for _ in range(10)]
    out = [(i, t, ["en", "de", None][i % 3], [None, "s1", "s2", "s2"][i % 4], None, 1, 1.0, 1, "x") for i, t in enumerate(texts)]
    return [*out, out[6], out[8], (None, passage, "en", None, None, 1, 1.0, 1, "x")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _bytes(rows):
    return [(r[0], (r[1] or "").encode()) for r in rows]


def test_repeats(docs, rows, empty):
    count = collections.Counter(b[i:i + 200] for _, b in _bytes(rows) for i in range(len(b) - 199))
    want = []
    for doc, b in _bytes(rows):
        mark = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if count[b[i:i + 200]] > 1:
                mark[i:i + 200] = True
        runs = int((np.diff(np.concatenate([[0], mark.astype(int)])) == 1).sum())
        kept = hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~mark])).hexdigest()
        want.append((str(doc), len(b), int(mark.sum()), runs, kept))
    got = [(str(r.doc_id), *r[1:]) for r in repeats.Repeats(docs).removed().collect()]
    assert sorted(got) == sorted(want)
    assert repeats.Repeats(empty).removed().count() == 0


def test_repeats_of_hot_owners(docs, rows, monkeypatch):
    plain = sorted(map(str, repeats.Repeats(docs).removed().collect()))
    monkeypatch.setattr(repeats, "HOT", 1)
    assert sorted(map(str, repeats.Repeats(docs).removed().collect())) == plain


def test_maximal_repeats_with_all_places():
    rng = random.Random(5)
    shared = bytes(rng.choices(b"abc", k=40))
    contexts = [b"x" + shared + b"y", b"z" + shared + b"w", b"q" + shared[:30] + b"r"]
    *_, groups = repeats.block_repeats(contexts, np.array([len(c) - 19 for c in contexts]), 20)
    found = {(length, tuple(sorted(places))) for length, places in groups}
    assert (40, ((0, 1), (1, 1))) in found and (30, ((0, 1), (1, 1), (2, 1))) in found


def _maximal(texts, width):
    """By growing every repeated string by one byte at a time."""
    now = collections.defaultdict(list)
    for i, t in enumerate(texts):
        for p in range(len(t) - width + 1):
            now[t[p:p + width]].append((i, p))
    out, length = set(), width
    while now:
        longer = collections.defaultdict(list)
        for s, places in now.items():
            if len(places) < 2:
                continue
            left = {texts[i][p - 1] if p else (i, p) for i, p in places}
            right = {texts[i][p + length] if p + length < len(texts[i]) else (i, p) for i, p in places}
            if len(left) > 1 and len(right) > 1:
                out.add((s, tuple(sorted(places))))
            for i, p in places:
                if p + length < len(texts[i]):
                    longer[texts[i][p:p + length + 1]].append((i, p))
        now, length = longer, length + 1
    return out


def _found(spark, texts, width):
    frame = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id long, text string")
    r = repeats.Repeats(frame, width)
    number = {x.row: x.doc_id for x in r.base.select("row", "doc_id").collect()}
    got = [(bytes(x.string), x.length, tuple(sorted((number[p.row], p.start) for p in x.places))) for x in r.maximal().collect()]
    assert all(len(s) == length for s, length, _ in got) and len(set(got)) == len(got)
    return {(s, places) for s, _, places in got}


def test_maximal_against_brute_force(spark, monkeypatch):
    rng = random.Random(17)
    make = lambda n: _words(rng, n).encode()
    whole, passage, line = make(150), make(25), make(14)
    assert _found(spark, [whole, whole], 40) == {(whole, ((0, 0), (1, 0)))}
    texts = [b"", b"x", whole, whole, whole[:300] + b"!" + whole[300:], make(9) + whole, b"ab " * 60, b"ab " * 40 + b"c", passage,
             passage + passage, line[:40], line[:41], b"z" * 90]
    texts += [make(rng.randint(0, 12)) + b" " + passage + b" " + make(rng.randint(0, 12)) for _ in range(12)]
    texts += [make(3) + line + make(3) + line + make(3) for _ in range(3)]
    texts = [t.decode(errors="ignore").encode() for t in texts]
    want = _maximal(texts, 40)
    assert max(len(s) for s, _ in want) > 600 and max(len(p) for _, p in want) > 12
    assert _found(spark, texts, 40) == want
    monkeypatch.setattr(repeats, "HOT", 1)
    assert _found(spark, texts, 40) == want
    assert _found(spark, [b"", make(60)], 40) == set()


def test_near_duplicates(docs, rows, empty):
    sets = collections.OrderedDict()
    for doc, b in _bytes(rows):
        w = [x for x in re.split(rb"[\x20\x09-\x0D]+", b.lower()) if x]
        sets[doc] = {tuple(w[i:i + 3]) for i in range(max(len(w) - 2, 1))} if w else set()
    ids = [d for d in sets if d is not None]
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = near_dedup.near_duplicates(docs, 3, 85).collect()
    assert len(got) == len(rows)
    assert all(r.component_id == find(r.doc_id) and r.n_shingles == len(sets[r.doc_id]) for r in got if r.doc_id is not None)
    assert near_dedup.near_duplicates(empty).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6).astype("f4")]) for i in range(700)]
    rows += [(700 + i, rows[5][1]) for i in range(40)]
    clean = list(rows)
    rows += [(900, None), (901, [1.0, None]), (902, [float("nan")] * 6), (903, [float("inf")] * 6)]
    v = {i: np.floor(1024.0 * np.array(x)).astype(int) for i, x in clean}
    want = []
    for q in range(0, 740, 100):
        best = sorted((-int(v[q] @ x), i) for i, x in v.items() if i != q)[:10]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS block", "2 AS pivot")
    assert sorted(map(tuple, topk.exact_top_k(frame).collect())) == want
    assert topk.exact_top_k(frame.limit(0)).count() == 0


def test_section_tokens(docs, rows, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_counts.vocabulary())
    t.encode_special_tokens = True
    got = collections.defaultdict(int)
    for r in token_counts.section_tokens(docs).collect():
        got[r.doc_id] += r.n_tokens
    want = collections.defaultdict(int)
    for r in rows:
        want[r[0]] += len(t.encode(r[1] or "", add_special_tokens=False).ids)
    assert got == want and token_counts.section_tokens(empty).count() == 0
    assert token_counts.join_spans(np.array([0, 2, 3, 9]), np.array([0, 3, 6])).tolist() == [2, 2]


def test_sharding(docs, rows, empty):
    got = sharding.shard(docs, [1.0] * 24, [1.0] * 25).collect()
    assert len(got) == len(rows)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted((str(d), len(b) + 8, zlib.crc32(b)) for d, b in _bytes(rows))
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == want
    assert sharding.shard(empty, [1.0] * 24).count() == 0
    assert {r.shard for r in sharding.shard(docs, [1.0, 0.0, 3.0]).collect()} == {0, 2}


def test_mixing(docs, rows, empty):
    got = mixing.mix_sources(docs).collect()
    size = collections.Counter()
    largest = collections.Counter()
    for r in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
        size[r[3]] += n
        largest[r[3]] = max(largest[r[3]], n)
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: [3, 1, 2][i % 3] for i, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(size.values()), {}, set(size)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * size[s]}
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 2 * size[s]
            left -= target[s]
        open_ -= full
    taken = collections.Counter()
    sources = dict(zip([str(r[0]) for r in rows], [r[3] for r in rows], strict=True))
    for r in got:
        s = sources[str(r.doc_id)]
        taken[s] += r.taken
        assert r.source_size == size[s] and r.target == pytest.approx(target[s]) and r.taken <= 2 * r["size"]
    assert len(got) == len(rows) and all(abs(taken[s] - target[s]) <= largest[s] for s in size)
    again = mixing.mix_sources(docs.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix_sources(empty).count() == 0
    mixed = mixing.take_mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in got)


def test_token_files(docs, rows, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_files.vocabulary())
    shards = token_files.write_shards(docs)
    want, start = [], 0
    for doc, text in sorted(((r[0], r[1] or "") for r in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 2], "<u4")
        want.append((str(doc), start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [(str(r.doc_id), *r[1:]) for r in token_files.read_shards(shards).collect()]
    assert sorted(got) == sorted(want)
    files = [r.asDict() for r in shards.collect()]
    found = [x for x in (token_files.lookup(f, 11) for f in files) if x is not None]
    assert len(found) == 1 and found[0][-1] == 2
    assert all(token_files.lookup(f, 987654) is None for f in files)
    assert token_files.read_shards(token_files.write_shards(empty)).count() == 0


def test_decontamination(spark, docs, rows, empty):
    passage = rows[8][1]
    items = spark.createDataFrame([(1, passage), (2, None), (3, ""), (4, "wholly other words stand here and there today")],
                                  "item_id long, text string")
    got = decontaminate.contaminated(docs, items).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_items > 0) == (passage in (r.text or "")), r.doc_id
        assert r.item_ids == ([1] if r.n_items else [])
    assert decontaminate.contaminated(empty, items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).filter("n_items > 0").count() == 0


def test_decontamination_keeps_no_cut_item(spark):
    """Every item of which four fifths of the shingles stand in a text is found, whatever else is there."""
    rng = random.Random(9)
    items = [_words(rng, rng.randint(12, 60)) for _ in range(40)]
    texts = []
    for i, item in enumerate(items):
        w = item.split()
        keep = w[:max(5 + int(0.9 * (len(w) - 4)), 5)]
        texts.append((i, _words(rng, 700) + " " + " ".join(keep) + " " + _words(rng, 300)))
    found = decontaminate.contaminated(spark.createDataFrame(texts, "doc_id long, text string"),
                                       spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    assert all(r.item_ids == [r.doc_id] for r in found)


def test_decontamination_holds_one_slice_at_a_time(spark, docs, rows, monkeypatch):
    rng = random.Random(21)
    items = [(i, rows[8][1] if i in (3, 30) else _words(rng, 40)) for i in range(40)] + [(None, rows[8][1])]
    items = spark.createDataFrame(items, "item_id long, text string")
    whole = decontaminate.contaminated(docs, items)
    want = sorted(map(str, whole.collect()))
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 3000)
    got = decontaminate.contaminated(docs, items)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") <= 1
    assert got.columns == whole.columns and sorted(map(str, got.collect())) == want
    assert {(r.n_items, tuple(r.item_ids)) for r in got.collect()} == {(0, ()), (3, (3, 30))}


def test_language_id(spark, docs, rows, empty):
    got = langid.identify(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(x[1] for x in rows if x[0] == r.doc_id)
        assert (r.lang_pred == "und") == (not re.search(r"[^\W\d_]", text or ""))
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    assert langid.identify(empty).count() == 0


def test_language_id_held_out(spark):
    frame = langid.identify(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang")
    held = frame.filter("held_out").join(docs, "doc_id").filter("lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)


def test_warc(spark):
    big = "é" * 600
    rows = [(1, "u", big, 1), (5, "u\r\nX: y", big, 1), (3, None, big, 1), (4, "v", "small", 1), (6, "v", "small", 1),
            (7, "w", None, 1), (8, "w", "", 1), (None, "w", big, 1), (9, "z", "q" * 300_000 + "\r\n\r\nWARC/1.1\r\n", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload int")
    path = warc.archive(pages)
    got = {r.page_id: r for r in warc.read_archive(spark, path).collect()}
    assert len(got) == len(rows)
    for page, _, html, _ in rows:
        data = (html or "").encode()
        assert (got[page].payload_bytes, got[page].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert got[page].refers_to == (5 if page in (1, 3) else None)
        assert got[page].record_type == ("revisit" if page in (1, 3) else "response")
    assert warc.read_archive(spark, warc.archive(pages.limit(0))).count() == 0


def test_warc_headers_of_any_length(spark):
    rng = random.Random(13)
    html = "<p>" + "r\r\n\r\n" * 400
    drawn = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789%&=", k=200_000))
    urls = {1: "http://a/?" + "q" * 200_000, 2: "data:" + drawn, 3: "http://b/?" + "q" * 200_000, 4: "data:x" + drawn, 5: "u"}
    pages = spark.createDataFrame([(i, u, html if i > 2 else f"{i}") for i, u in urls.items()], "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.read_archive(spark, warc.archive(pages)).collect()}
    assert {i: r.target_uri for i, r in got.items()} == urls
    assert [got[i].record_type for i in range(1, 6)] == ["response", "response", "revisit", "revisit", "response"]
    assert all(got[i].refers_to == 5 and got[i].payload_bytes == len(html) for i in (3, 4))


def test_warc_headers_that_end_near_a_chunk():
    for fill in ("q", "".join(random.Random(1).choices("abcdefghijklmnop", k=140_000))):
        for size in [*range(65_536 - 160, 65_536 + 8), *range(131_072 - 160, 131_072 + 8)]:
            url = (fill * size)[:size] if len(fill) == 1 else fill[:size]
            row = {"record_id": "a", "record_type": "response", "target_uri": url, "payload_bytes": 9, "payload": b"x\r\n\r\nyz\r\n"}
            stream = io.BytesIO(warc.pack_record(row) * 2)
            for payload in (True, False):
                record, there = warc._record(stream, lambda values: True, payload)
                assert there and record[2] == url and record[-1] == (row["payload"] if payload else None)
            assert warc._record(stream, lambda values: True, True) == (None, False)


def test_ids_of_blank_separated_strings_are_those_of_the_whole_text():
    """Against whole-text encoding: marks after blanks, other white space, final sigma, special strings, very long strings."""
    from tokenizers import Tokenizer

    from claimlake.llm import token_files

    tokenizer = Tokenizer.from_file(token_files.vocabulary())
    rng = random.Random(11)
    pieces = ["don't", "we'll", "'s", "\u0308a", "e\u0301", "\u00c5", "\u03a3\u0391\u03a3", "\u0130", "<|endoftext|>", "a<|endoftext|>b",
              "12,3", "\u4f60\u597d", "\u1100\u1161", "\u11a8", "\U0001f600\u200d", "x" * 300, "\x1c", "\x85", "\ufb01", "\u00b4", "\x00"]
    blanks = [" ", "  ", "\n", "\t", "\r\n", "\v", "\f", "\u00a0", "\u2028", "\x1c", ""]
    texts = [None, "", " ", *("".join(rng.choice(pieces) + rng.choice(blanks) for _ in range(rng.randrange(1, 30))) for _ in range(400))]
    known: dict = {}
    got = [list(x) for x in token_files._encoded(texts, tokenizer, known)]
    assert got == [[*tokenizer.encode(t or "", add_special_tokens=False).ids, token_files.END] for t in texts]
    assert all(len(w) <= token_files.KNOWN_CHARS for w in known)


def test_words_are_encoded_once_whatever_marks_end_them(monkeypatch):
    """A word with a run of marks behind it needs no encoding of its own; a word of letters goes to the model alone."""
    from claimlake.llm import token_files

    made = token_files.Encoder(token_files.vocabulary())
    asked: list = []
    encode = made.pieces.encode
    monkeypatch.setattr(made.pieces, "encode", lambda strings, dtype: encode(asked.extend(strings) or strings, dtype))
    texts = ["wordling wordling, wordling.*** élève élève,", "wordling.*** wordling?! '9x9?! <|endoftext|>. a|b a||", "don't. don'. x's' ². ,. |. İ. слово слово, \u0958."]
    got = [x.tolist() for x in made.encode(texts)]
    assert got == [[*made.tokenizer.encode(t, add_special_tokens=False).ids, token_files.END] for t in texts]
    assert sum("wordling" in w for w in asked) == 1 and sum("élève" in w for w in asked) == 1
    assert made.pieces.is_word("élève") and not made.pieces.is_word("x's") and not made.pieces.is_word("")
