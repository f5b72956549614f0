"""Each operator against a plain version on small rows, with nulls, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

import gzip
import itertools
import random
import textwrap
import time
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakestrata.llm import chat, decontaminate, graph, licenses, minhash, packing, store, tokens, topk, toxicity, urls, warc, words
from lakestrata.runtime import scratch_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, score double, `id` string, row string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def docs_of(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, 0.5, "x", "y") for i, t in zip(ids, texts, strict=True)], DOCS)


TEXTS = [
    None, "", "   \n\t", "Hello world!", "It's 3 o'clock, don't   they'll\u00a0say", "caf\u00e9 \u00c4\u00d6\u00dc stra\u00dfe", "cafe\u0301 \u0130stanbul",
    "\u4f60\u597d \u03a3\u03b1\u03c2 \u0417\u0434\u0440\u0430\u0432\u0441\u0442\u0432\u0443\u0439", "a<|endoftext|>b <|startoftext|>", "x\x1cy\x1fz \x85 tab", "<| not special |>", "!!'s ''t ...",
    "word " * 9000, "Hello world!", "\u00b2\u00bd9 7th", "\U0001f600 ok",
]


def test_token_counts_are_the_librarys(spark, library):
    rng = random.Random(3)
    odd = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(1, 0x2FF), 32])) for _ in range(60)) for _ in range(150)]
    texts = TEXTS + odd
    got = {r.doc_id: r for r in tokens.count_tokens(docs_of(spark, texts), VOCABULARY, limit=5).collect()}
    for i, text in enumerate(texts):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((text or "").encode()), n > 5), text


def test_small_token_tables_give_the_same_counts(library):
    words_ = [f"w{i} word{i % 7}." for i in range(200)]
    counts = tokens.Counts(VOCABULARY, 10, tokens.whole_tokens(VOCABULARY))
    for start in range(0, 200, 20):
        part = words_[start : start + 20]
        assert [int(c.sum()) for c in counts.of(part)] == [len(library.encode(t, add_special_tokens=False).ids) for t in part]


def test_ids_of_new_words_take_little_memory(library):
    letters = random.Random(5)
    texts = [" ".join("".join(letters.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(400)) for _ in range(1200)]
    table = tokens.Ids(VOCABULARY, 600_000)
    tracemalloc.start()
    try:
        found = [own[:20].copy() for own in table.of(texts)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 130e6
    for text, own in zip(texts[::100], found[::100], strict=True):
        assert library.encode(text, add_special_tokens=False).ids[:20] == own.tolist()


def test_store_finds_what_was_put_in_any_order():
    entries, held = random.Random(3).sample(range(10**6), 900), tokens._Store()
    for part in (entries[:1], entries[1:500], entries[500:]):
        words = [f"w{e}" for e in part]
        held.put(tokens._Keys.of(pa.array(words)), np.array(part, np.uint32), np.ones(len(part), np.int64))
    assert (np.diff(held.hashes.astype(object)) >= 0).all()
    at = held.find(tokens._Keys.of(pa.array([f"w{e}" for e in entries] + ["w"])))
    assert at[-1] == -1 and held.values[held.where[at[:-1], 2]].tolist() == entries


def test_packing_covers_every_id_once(spark, library):
    rng = random.Random(5)
    texts = TEXTS + [" ".join(rng.choices(["alpha", "beta", "x1"], k=rng.randrange(1, 400))) for _ in range(120)]
    rows = packing.pack(docs_of(spark, texts).repartition(3), VOCABULARY, capacity=256).collect()
    places = {}
    for doc, own in itertools.groupby(sorted(rows, key=lambda r: (r.doc_id, r.start)), lambda r: r.doc_id):
        ids = np.array([*library.encode(texts[doc] or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in own:
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
            places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert at == len(ids)
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r.length for r in rows)
    assert {r.doc_id for r in rows} == set(range(len(texts))) and len(places) * 256 < total * 1.05


def test_best_fit_takes_the_tightest_window():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 64, 500)
    window, offset = packing.best_fit(lengths, 64)
    left, plain = [], np.zeros(len(lengths), int)
    for i in np.argsort(-lengths, kind="stable"):
        fits = [room for room in left if room >= lengths[i]]
        plain[i] = min(fits, default=64)
        if fits:
            left.remove(min(fits))
        left.append(plain[i] - lengths[i])
    assert (64 - offset == plain).all()
    assert np.bincount(window, lengths).max() <= 64


def plain_components(texts, ids, size, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    name = {i: i for i in ids}
    again = True
    while again:
        again = False
        for a, b in itertools.combinations(range(len(ids)), 2):
            same = len(sets[a] & sets[b])
            linked = sets[a] and sets[b] and 100 * same >= percent * len(sets[a] | sets[b])
            if (linked or ids[a] == ids[b]) and name[ids[a]] != name[ids[b]]:
                name[ids[a]] = name[ids[b]] = min(name[ids[a]], name[ids[b]])
                again = True
    return [len(s) for s in sets], [name[i] for i in ids]


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_all_pairs(spark, size):
    rng = random.Random(size)
    vocabulary = [f"W{i}" for i in range(300)]
    texts = [None, "", " \t", "one", "ONE", "one two", "one two", "\u00c4 two", "\u00e4 two"]
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.choice([8, 40, 120]))
        for edits in (0, 0, 1, 2, 3, 5, 8, 8, 8):
            own = list(base)
            for _ in range(edits):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    texts += [texts[20], "z " * 30_000 + texts[30]]
    ids = list(range(100, 100 + len(texts)))
    ids[-2] = ids[20]
    counts, names = plain_components(texts, ids, size, 80)
    got = minhash.near_duplicates(docs_of(spark, texts, ids), size=size).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == sorted(
        (i, n, c, i == c) for i, n, c in zip(ids, counts, names, strict=True)
    )


def test_near_duplicates_without_ids_or_rows(spark):
    got = minhash.near_duplicates(docs_of(spark, ["a b c", "a b c", "a b c"], [None, 7, 9])).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=str) == [(7, 7, True), (9, 7, False), (None, None, True)]
    assert minhash.near_duplicates(docs_of(spark, [])).collect() == []


def test_groups_compared_in_blocks_find_every_link():
    rng = np.random.default_rng(2)
    one = [np.unique(rng.integers(0, 200, 40).astype(np.uint64)) for _ in range(9)]
    two = [np.unique(rng.integers(0, 200, 60).astype(np.uint64)) for _ in range(7)]
    assert minhash._common(one, two).tolist() == [[len(np.intersect1d(a, b)) for b in two] for a in one]


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (139, 100)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}


def test_id_filter_keeps_every_row(spark):
    docs = docs_of(spark, ["t"] * 60, [*range(58), None, 3])
    ids = spark.createDataFrame([(i,) for i in range(0, 58, 3)], "any long")
    assert sorted(r.doc_id for r in store.rows_with(docs, "doc_id", ids).collect()) == sorted([*range(0, 58, 3), 3])
    rest = [r.doc_id for r in store.rows_without(docs, "doc_id", ids).collect()]
    assert rest.count(None) == 1 and sorted(x for x in rest if x is not None) == [i for i in range(58) if i % 3]
    assert store.rows_without(docs, "doc_id", ids.limit(0)).count() == 60


PASSAGE = " ".join(f"quiz{i}" for i in range(40))


def test_contaminated_documents(spark):
    filler = " ".join(f"fill{i}" for i in range(60))
    changed = PASSAGE.split()
    for i in (3, 11, 20, 29, 37):
        changed[i] = "other"
    texts = [
        None, "", filler, f"{filler} {PASSAGE}. {filler}", f"{filler} {' '.join(changed)}", PASSAGE.upper().replace(" ", ", "),
        " ".join(PASSAGE.split()[:12]) + " " + filler, "A short item!", "a short other", f"{PASSAGE} {PASSAGE}",
    ]
    items = spark.createDataFrame([(1, PASSAGE, 0), (2, None, 0), (3, "", 0), (4, "a short item", 0)], "item_id long, text string, doc_id int")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs_of(spark, texts), items).collect()}
    assert set(got) == {(3, 1), (4, 1), (5, 1), (7, 4), (9, 1)}
    assert (got[3, 1].doc_start, got[3, 1].item_start, got[3, 1].n_same, got[3, 1].coverage) == (60, 0, 40, 1.0)
    # the last substitution would cost more than the two tokens after it give
    assert got[4, 1].n_same == 33 and got[9, 1].doc_start == 0
    assert decontaminate.contaminated(docs_of(spark, []), items).count() == 0
    assert decontaminate.contaminated(docs_of(spark, texts), items.limit(0)).count() == 0


def plain_overlaps(texts, items, min_match=13, penalty=3):
    """The most equal tokens of each pair, by all diagonals."""
    found = {}
    for (d, text), (i, item) in itertools.product(enumerate(texts), items):
        own, test = np.array(decontaminate.tokens(text)), np.array(decontaminate.tokens(item))
        for shift in range(1 - len(test), len(own)):
            low, high = max(0, -shift), min(len(test), len(own) - shift)
            same = decontaminate.best_segment(test[low:high] == own[low + shift : high + shift], penalty)[2]
            if same >= min(min_match, len(test)):
                found[d, i] = max(same, found.get((d, i), 0))
    return found


@pytest.mark.parametrize("length", [13, 14, 60, 200])
def test_contaminated_equals_all_diagonals(spark, length):
    rng = random.Random(length)
    item = [f"quiz{i}" for i in range(length)]
    texts = []
    for period in range(4, 16):
        for first in {0, period // 2, period - 1}:
            texts.append([f"x{i}" if i % period == first else w for i, w in enumerate(item)])
    texts += [item[i : i + 13] for i in range(0, length - 12, 5)] + [item[:12], item[-13:]]
    # dense and uneven substitutions, two in a row as well
    for share in (0.1, 0.15, 0.2, 0.22):
        texts += [[w if rng.random() > share else f"x{i}" for i, w in enumerate(item)] for _ in range(8)]
    texts = [" ".join(["a", *t, "b", "c"]) for t in texts]
    items = [(1, " ".join(item)), (2, "seven words are looked for as one"), (3, "x y")]
    texts += ["here seven words are looked for as one item", "seven words are looked for as", "x, Y"]
    plain = plain_overlaps(texts, items)
    assert length < 60 or (1, 1) not in plain and (3, 1) in plain
    got = decontaminate.contaminated(docs_of(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): r.n_same for r in got} == plain


@pytest.mark.parametrize(("penalty", "min_match"), [(1, 2), (1, 6), (2, 5), (3, 13), (3, 4)])
def test_covering_masks_fit_every_accepted_stretch(penalty, min_match):
    masks = decontaminate.covering(penalty, min_match)
    for bits in range(1 << 16):
        line = f"{bits:016b}"
        if decontaminate.best_segment(np.array([c == "1" for c in line]), penalty)[2] >= min_match:
            assert any(bits >> i & int(m, 2) == int(m, 2) for m in masks for i in range(17 - len(m)))


def test_tokens_of_other_scripts():
    assert decontaminate.tokens("this\u00a0is \u201cA\u201d test\u2014x\u2026y_z \u2018q\u2019") == [w.encode() for w in "this is a test x y z q".split()]
    assert decontaminate.tokens("Stra\u00dfe \u00c9t\u00e9, 7\u00d78 cafe\u0301\u3002\ud55c\uad6d\uc5b4") == [w.encode() for w in ("stra\u00dfe", "\u00e9t\u00e9", "7", "8", "cafe\u0301", "\ud55c\uad6d\uc5b4")]
    assert decontaminate.tokens("\u4f60\u597d\uff0cabc\u4e16\u754c\u3002\u30ab\u3099") == [w.encode() for w in ("\u4f60", "\u597d", "abc", "\u4e16", "\u754c", "\u30ab\u3099")]
    assert decontaminate.tokens("\u0939\u093f\u0928\u094d\u0926\u0940 \u0e01\u0e33") == ["\u0939\u093f\u0928\u094d\u0926\u0940".encode(), "\u0e01".encode(), "\u0e33".encode()]
    rng = random.Random(8)
    for _ in range(300):
        text = "".join(rng.choices("aB9_ .\u00e9\u0130\u0141\u00d8\u010d\n-", k=40))
        assert decontaminate.tokens(text) == [t.encode() for t in decontaminate._TOKEN.findall(text.lower())]


def test_contaminated_by_typographic_and_cjk_passages(spark):
    words = PASSAGE.split()
    han = "".join(chr(0x4E00 + 37 * i) for i in range(30))
    around = "".join(chr(0x5E00 + 41 * i) for i in range(60))
    texts = [
        f"intro\u2014{'\u00a0'.join(words)}\u2026", " ".join(f"\u201c{w}\u201d" for w in words), "\u2014".join(words),
        f"{around}\u3002{han[:15]}\u3001{han[15:]}\u300d{around}", around,
    ]
    items = spark.createDataFrame([(1, PASSAGE), (2, han)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_same for r in decontaminate.contaminated(docs_of(spark, texts), items).collect()}
    assert got == {(0, 1): 40, (1, 1): 40, (2, 1): 40, (3, 2): 30}


def test_chats_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "a\\b <|im_end|>\n", "<|im_start|>user\nx<|im_end|>\n", "<|im_sep|>", "\\", "<\\|", "[\\INST]", "<s", "", None, "\n\n", "\u00e4\U0001f600"]
    rng = random.Random(4)
    rows = []
    for conv in range(30):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn if rng.random() > 0.1 else None, rng.choice(["user", "assistant", "system", None, "<|im_end|>", "two\nlines<\\n>\\\n"]), rng.choice(nasty)))
    rows += [(50, 1, "assistant", "b"), (50, 1, "assistant", "a"), (50, 1, "assistant", "a"), (None, 0, "user", "no id")]
    table = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    done = chat.format_chats(table).select("*", chat.parsed(F.col("formatted")).alias("back"), chat.trained_text(F.col("segments")).alias("loss"))
    for r in done.collect():
        own = sorted(((t if t is not None else -1, role or "", text or "") for c, t, role, text in rows if c == r.conv_id))
        assert [(b.role, b.text) for b in r.back] == [(role, text) for _, role, text in own]
        assert r.loss == "".join(text for _, role, text in own if role == "assistant")
        assert r.formatted == "".join(s.text for s in r.segments)
        changes = sum(1 for i, o in enumerate(own) if not i or own[i - 1][1] != o[1])
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == changes
        assert not any(m in s.text for s in r.segments[1::3] for m in ("</s>", "[INST]", "[/INST]", "<|"))
    assert chat.format_chats(table.limit(0)).count() == 0


def test_url_rules(spark):
    rules = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net", "allow"), ("a.net/x", "block")]
    cases = {
        None: ("", "", None, "deny"), "": ("", "", None, "deny"), "example.com/en/": ("", "", None, "deny"),
        "http://Example.COM/en/x?y#z": ("example.com", "/en/x", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://wwwexample.com/en/": ("wwwexample.com", "/en/", "com/", "allow"), "http://com": ("com", "", None, "deny"),
        "http://b.a.net/xy": ("b.a.net", "/xy", "a.net/x", "block"), "http://b.net/es/1": ("b.net", "/es/1", "net/es/", "block"),
        "http://net#/es/": ("net", "", "net", "allow"), "x://" + "q." * 20_000 + "com/" + "p" * 50_000: ("q." * 20_000 + "com", "/" + "p" * 50_000, "com/", "allow"),
        "a\nb://\u00c4.com/\n?": ("\u00c4.com", "/\n", "com/", "allow"),
    }
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(cases)] + [(0, None, "r")], "page_id long, url string, rule string")
    got = urls.judge_urls(pages, rules, otherwise="deny").collect()
    assert len(got) == len(cases) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == list(cases.values())[r.page_id]
    assert urls.judge_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in urls.judge_urls(pages, []).collect()} == {"allow"}


def test_equal_digests_are_told_apart_by_their_strings(tmp_path):
    entries = {f"key{i}".encode(): i for i in range(50)}
    path = tmp_path / "index"
    path.write_bytes(urls.DigestArray.packed(entries, digest=lambda k: len(k)))
    found = urls.DigestArray(str(path)).find([*entries, b"keyXX", b"none"], digest=lambda k: len(k))
    assert found.tolist() == [*range(50), -1, -1]


def test_word_hashes_are_those_of_spark(spark):
    ours = [int(np.uint64(x).view(np.int64)) for x in words.WordHashes().of([b"a", "\u00e4\u00f6".encode()])]
    assert len(set(ours)) == 2 and words.ascii_words("A\x0bb\x1cC \u00c4") == [b"a", b"b\x1cc", "\u00c4".encode()]


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, kind string")


def test_warc_round_trip_and_salvage(spark, tmp_path):
    rows = [(5, "http://a/\r\nx: y", "same"), (2, "http://b/", "same"), (9, None, "same"), (3, "u", None), (4, "u", ""), (1, "u", "WARC/1.1\r\n\r\n" * 3),
            (None, "u", "alone"), (7, "u", "\u00e4" * 200_000), (2, "http://b/", "same")]
    folder = warc.write_warc(pages_of(spark, rows).coalesce(1), scratch_path(spark, "warc"))
    got = warc.read_warc(spark, folder).collect()
    assert {r.kind for r in got} == {"record"}
    first = {"same": 2, "": 3}
    expected = []
    for page, _, html in rows:
        data = (html or "").encode()
        of = first.get(html or "")
        revisit = of is not None and of != page
        expected.append((page, len(data), warc.digest(data), "revisit" if revisit else "response", of if revisit else None))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == sorted(expected, key=str)
    assert all(bytes(r.payload) == (dict((p, h) for p, _, h in rows)[r.page_id] or "").encode() for r in got if r.record_type == "response")
    kept = warc.write_warc(pages_of(spark, rows), scratch_path(spark, "warc"), least=1)
    assert sorted(r.page_id for r in warc.read_warc(spark, kept).where("payload_bytes = 0 AND record_type = 'response'").collect()) == [3, 4]
    assert warc.read_warc(spark, warc.write_warc(pages_of(spark, rows).limit(0), scratch_path(spark, "warc"))).count() == 0


def test_salvage_gives_every_byte_a_place():
    parts = [warc._record(i, f"http://h/{i}", f"payload {i} ".encode() * (i + 1), None) for i in range(12)]
    rng = random.Random(9)
    for packed in (True, False):
        whole = b"".join(gzip.compress(p, mtime=0) if packed else p for p in parts)
        clean = list(warc.salvage(whole))
        assert [k for k, *_ in clean] == ["record"] * 12 and clean[0][1] == 0 and clean[-1][2] == len(whole)
        for _ in range(60):
            data = bytearray(whole)
            at = rng.randrange(len(data))
            kind = rng.randrange(3)
            if kind == 0:
                data[at] ^= 0xFF
            elif kind == 1:
                del data[at : at + rng.randrange(1, 300)]
            else:
                data[at:at] = bytes(rng.randrange(256) for _ in range(50))
            found = list(warc.salvage(bytes(data)))
            spans = sorted({(s, e) for _, s, e, *_ in found})
            assert spans[0][0] == 0 and spans[-1][1] == len(data) and all(a[1] == b[0] for a, b in itertools.pairwise(spans))
            good = [f for f in found if f[0] != "gap"]
            # a changed byte in a plain record's header can go unseen; in a member nothing can
            whole_blocks = [p.partition(b"\r\n\r\n")[2][:-4] for p in parts]
            assert len(good) >= 9 and sum(f[5] in whole_blocks for f in good) >= len(good) - (not packed)
    assert list(warc.salvage(b"")) == [] and [f[0] for f in warc.salvage(b"noise")] == ["gap"]


@pytest.mark.parametrize("level", [0, 6])
def test_a_damaged_member_gives_what_it_holds(level):
    rng = random.Random(5)
    blocks = [bytes(rng.randrange(97, 123) for _ in range(9000)) for _ in range(12)]
    plain = b"".join(warc._record(i, None, b, None) for i, b in enumerate(blocks))
    one = gzip.compress(plain, level, mtime=0)
    after = gzip.compress(warc._record(12, None, b"after", None), mtime=0)

    def pages(data):
        found = list(warc.salvage(data))
        spans = sorted({f[1:3] for f in found})
        assert spans[0][0] == 0 and spans[-1][1] == len(data) and all(a[1] == b[0] for a, b in itertools.pairwise(spans))
        inner = [f[3] for f in found if f[3] and f[1] == 0]
        assert all(a[1] == b[0] for a, b in itertools.pairwise(inner)) and (not inner or inner[0][0] == 0)
        return [warc._page(f[4], "warc-record-id") for f in found if f[0] != "gap"], [f for f in found if f[0] == "gap"]

    cut, gaps = pages(one[: len(one) * 95 // 100])
    assert cut == list(range(11)) and gaps and gaps[-1][3][1] > gaps[-1][3][0]
    wrong = bytearray(one)
    wrong[-6] ^= 1
    assert pages(bytes(wrong))[0] == list(range(12))
    got, gaps = pages(bytes(wrong) + after)
    assert got == list(range(13)) and len(gaps) == 1 and gaps[0][3] is None and 0 < gaps[0][2] - gaps[0][1] <= 8
    if level:
        middle = bytearray(one)
        middle[len(one) // 2 : len(one) // 2 + 40] = bytes(40)
        got, gaps = pages(bytes(middle) + after)
        assert got[:5] == list(range(5)) and got[-1] == 12 and gaps
    # damage inside a whole member: its own bytes are the gap
    inside = plain.replace(blocks[4][100:200], b"?" * 100)
    got, gaps = pages(gzip.compress(inside, mtime=0))
    assert got == [i for i in range(12) if i != 4] and [(k, i) for k, _, _, i, _, _ in gaps] == [("gap", (inside.find(b"WARC/1.", inside.find(b"page:3>")), inside.find(b"WARC/1.", inside.find(b"page:4>"))))]


def test_archives_roll_and_damaged_copies_lose_only_what_is_damaged(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").repartition(3)
    pages = pages.unionByName(spark.range(2000).select((F.col("id") + 10_000_000).alias("page_id"), F.lit("http://x/").alias("url"), F.lit("one body of many").alias("html")))
    folder = warc.write_warc(pages, scratch_path(spark, "warc"), piece_bytes=20_000)
    whole = warc.read_warc(spark, folder).collect()
    files = sorted({r.file for r in whole})
    assert len(whole) == pages.count() and {r.kind for r in whole} == {"record"} and len(files) > 6
    assert max(Counter(r.file for r in whole if r.page_id >= 10_000_000).values()) < 1000
    (tmp_path / "copy").mkdir()
    lost, rng = set(), random.Random(1)
    for n, file in enumerate(files):
        data = bytearray(Path(file.removeprefix("file:")).read_bytes())
        victim = rng.choice([r for r in whole if r.file == file])
        at = (victim.start + victim.end) // 2
        data[at] ^= 0x55
        lost.add(victim.page_id)
        (tmp_path / "copy" / f"{n}.warc.gz").write_bytes(data)
    got = warc.read_warc(spark, str(tmp_path / "copy")).collect()
    back = {(r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in got if r.kind == "record"}
    assert all(warc.digest(bytes(r.payload)) == r.payload_digest for r in got if r.kind == "salvaged" and r.record_type == "response")
    expected = {(r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in whole}
    assert back <= expected and {e[0] for e in expected - back} <= lost
    assert {r.file for r in got if r.kind == "gap"} == {r.file for r in got}


def test_exact_top_k(spark):
    rng = np.random.default_rng(6)
    vectors = [(i, [float(x) for x in rng.normal(0, 0.2, 16).astype(np.float32)]) for i in range(400)]
    vectors += [(401, vectors[7][1]), (402, vectors[7][1]), (7, vectors[7][1]), (403, None), (404, [None] * 16), (405, [float("nan")] * 16),
                (406, [float("inf")] + [0.0] * 15), (407, []), (None, vectors[3][1]), (450, vectors[50][1])]
    table = spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id long, embedding array<float>, score int").repartition(3)
    used = {i: np.floor(256 * np.array(v, float)).astype(int) for i, v in vectors if i is not None and v is not None and i < 403 or i in (407, 450)}
    full = {i: np.pad(v, (0, 16 - len(v))) for i, v in used.items()}
    for limit in (16 << 20, 200):
        got = topk.top_k(table, F.col("vec_id") % 50 == 0, block=8, wave_bytes=limit).collect()
        for q in (i for i in full if i % 50 == 0):
            best = sorted((-int(full[q] @ full[c]), c) for c in full if c != q)[:5]
            assert [(r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == [(n + 1, c, -s) for n, (s, c) in enumerate(best)]
    assert topk.top_k(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_blocks_are_pruned():
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 300, (8, 24))
    matrix = np.floor(np.repeat(centres, 100, 0) + rng.normal(0, 10, (800, 24)))
    best = topk.Best(np.array([-1, -2]), 5)
    queries = matrix[[0, 700]]
    scored = topk.search_blocks(best, queries, np.arange(800), matrix, 25)
    assert scored < 2 * 32 / 2
    for row, q in enumerate(queries):
        assert best.ids[row].tolist() == sorted(range(800), key=lambda i: (-(q @ matrix[i]), i))[:5]


INSULTS = ["fool", "dolt", "knave", "lout"]


def toxic_rows(n, seed):
    rng = random.Random(seed)
    plain = [f"word{i}" for i in range(400)]
    out = []
    for i in range(n):
        text, label = rng.choices(plain, k=rng.randrange(20, 80)), i % 5 == 2
        if label:
            for _ in range(rng.randrange(1, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(["you ", ""]) + rng.choice(INSULTS))
        out.append((i * 7, " ".join(text), int(label)))
    return out


def test_toxicity_learns_from_rows_not_held_out(spark):
    rows = toxic_rows(900, 1)
    docs = docs_of(spark, [t for _, t, _ in rows] + [None, "", "fool " * 20_000, rows[0][1]], [i for i, _, _ in rows] + [-1, -2, -3, rows[0][0]])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (0, None), (-9, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows) + 4
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    truth = {i: y for i, _, y in rows}
    wrong = [r for r in got if r.held_out and r.doc_id >= 0 and r.predicted != truth[r.doc_id]]
    assert len(wrong) <= 2
    assert {r.doc_id: r.predicted for r in got if r.doc_id < 0} == {-1: 0, -2: 0, -3: 1}
    used = toxicity.training_rows(docs, labels).collect()
    assert all(zlib.crc32(str(r.id).encode()) % 5 for r in used)


def test_toxicity_without_labels_is_constant(spark):
    docs, labels = docs_of(spark, ["a", None]), spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.toxicity(docs, labels).collect()] == [0.0, 0.0]
    assert toxicity.without_toxic(docs, toxicity.train(toxicity.training_rows(docs, labels))).count() == 2
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_obfuscated_and_near_hits():
    features = toxicity.Features({"w:fool": 5.0, "s:dolt": 3.0})
    at = dict(zip(toxicity.FEATURES, features.of("You f00l and f.o.o.l, FOOL!!! doltish foool"), strict=True))
    assert at["word_hits"] > 0 and at["stem_hits"] > 0 and at["hidden_hits"] == pytest.approx(np.log1p(2), rel=0.5) and at["near_second_person"] >= 2


def test_license_scan(spark):
    rng = random.Random(2)
    filler = [" ".join(rng.choices([f"tok{i}" for i in range(200)], k=30)) for _ in range(300)]
    texts = [f"{filler[0]}\n# {n}\n{filler[1]}" for _, n in licenses.NOTICES]
    others = ["He lost his driving licence in a public house.", "Permission was not granted, all rights are reserved", None, "", "licensed " * 3000, *filler]
    got = licenses.scan_licenses(docs_of(spark, texts + others)).where("confirmed").collect()
    assert {(r.doc_id, r.family) for r in got if r.paragraph_no == 1} == {(i, f) for i, (f, _) in enumerate(licenses.NOTICES)}
    assert len(got) == len(texts)
    assert licenses.scan_licenses(docs_of(spark, [])).count() == 0


def test_wrapped_licenses(spark):
    rng = random.Random(3)
    texts, expected = [], set()
    for family, notice in licenses.NOTICES:
        for width, mark in ((60, ""), (72, "// "), (80, " * "), (66, "# "), (40, "-- "), (20, "")):
            before, after = ([f"{mark}{' '.join(rng.choices([f'tok{i}' for i in range(200)], k=9))}" for _ in range(4)] for _ in range(2))
            own = textwrap.wrap(notice, width, initial_indent=mark, subsequent_indent=mark, break_on_hyphens=False, break_long_words=False)
            expected.add((len(texts), 4, family))
            texts.append("\n".join([*before, *own, *after]))
    filler = [" ".join(rng.choices([f"tok{i}" for i in range(200)], k=30)) for _ in range(300)]
    got = licenses.scan_licenses(docs_of(spark, texts + filler)).where("confirmed").collect()
    assert {(r.doc_id, r.paragraph_no, r.family) for r in got} == expected and len(got) == len(expected)


def test_notices_in_long_lines(spark):
    rng = random.Random(6)
    filler = lambda n: " ".join(rng.choices([f"tok{i}" for i in range(200)], k=n))
    texts, expected = [], []
    for around in (15, 100, 1000):
        for family, notice in licenses.NOTICES:
            expected.append((len(texts), family))
            texts.append(f"{filler(around)} {notice} {filler(around)}")
    for (one, first), (two, second) in zip(licenses.NOTICES, licenses.NOTICES[::-1], strict=True):
        expected += [(len(texts), one), (len(texts), two)]
        texts.append(f"{filler(40)} {first} {filler(30)} {second} {filler(40)}")
    texts += [f"{filler(400)} he was licensed to practise {filler(300)} the public domain of the town {filler(50)}", *[filler(30) for _ in range(200)]]
    got = licenses.scan_licenses(docs_of(spark, texts)).where("confirmed").collect()
    assert Counter((r.doc_id, r.family) for r in got) == Counter(expected)


def test_a_sample_of_very_many_rows_is_never_empty_by_rounding(spark):
    hashes = spark.range(4000).select(F.xxhash64("id").alias("h"))
    assert hashes.where(store.sampled(F.col("h"), 10, 10)).count() == hashes.where(store.sampled(F.col("h"), 10, 0)).count() == 4000
    assert 300 < hashes.where(store.sampled(F.col("h"), 100, 1000)).count() < 500
    tiny = spark.sql("SELECT explode(array(0L, 1L, 1000000L, -9223372036854775808L)) AS h")
    assert tiny.where(store.sampled(F.col("h"), 30_000, 10**12)).count() == 4


def test_grams(spark):
    row = spark.range(1).select(licenses.grams(F.lit("The MIT License")).alias("g"), licenses.grams(F.lit("")).alias("e"), licenses.grams(F.lit("one")).alias("o")).first()
    assert (row.g, row.e, row.o) == (["the", "mit", "license", "the mit", "mit license"], [], ["one"])


@pytest.mark.parametrize("doc", [None, 5])
def test_rows_without_an_id_or_with_one_id_are_compared_one_by_one(spark, doc):
    item = " ".join(f"item{i}" for i in range(30))
    passage = " ".join(f"item{i}" for i in range(5, 25))
    texts = [item, "short", passage, "before " * 50 + passage + " after" * 9, "", None, "item1 item2"]
    docs = docs_of(spark, texts + ["other words"] * 3, [doc] * 10)
    bench = spark.createDataFrame([(1, item), (1, "an item of the same id"), (None, passage), (None, "yes")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.doc_start, r.item_start, r.n_same, r.coverage) for r in decontaminate.contaminated(docs, bench).collect()}
    # best of all rows of the id: the whole item, and the item without an id wherever it begins first
    assert got == {(doc, 1): (0, 0, 30, 1.0), (doc, None): (0, 0, 20, 1.0)}


def test_very_many_rows_of_one_id_make_no_pairs_of_rows(spark):
    passage = " ".join(f"item{i}" for i in range(40))
    docs = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.concat_ws(" ", F.lit(passage), F.col("id")).alias("text"))
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    start = time.monotonic()
    got = decontaminate.contaminated(docs, bench).collect()
    assert [(r.doc_id, r.item_id, r.n_same) for r in got] == [(None, 1, 40)]
    assert time.monotonic() - start < 60


def test_table_of_seeds_grows_with_the_benchmark():
    assert [decontaminate._filter_bits(n).bit_length() - 1 for n in (0, 1, 1 << 21, (1 << 21) + 1, 7_000_000, 1 << 40)] == [24, 24, 24, 25, 26, 29]
