"""Repeated words, bytes and near duplicates against plain brute force."""

import hashlib
import random
import re
import string
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import components, filters, jaccard, substrings, suffixes
from millrace.llm import textops as tx
from tests.conftest import rows
from tests.llm.conftest import by_id

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def repeated_texts(seed, n):
    """Texts over few words, with shared passages, copies and near copies."""
    draw = random.Random(seed)
    vocabulary = ["alpha", "Beta", "gamma", "dél", "eps", "zeta", "日本", "theta,"]
    passages = [" ".join(draw.choices(vocabulary, k=draw.randint(10, 40))) for _ in range(4)]
    out = []
    for _ in range(n):
        kind = draw.random()
        if out and kind < 0.15:
            out.append(draw.choice(out))
        elif out and kind < 0.5:
            words = draw.choice(out).split(" ")
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
            out.append(" ".join(words))
        else:
            parts = [" ".join(draw.choices(vocabulary, k=draw.randint(0, 30))), draw.choice(passages), " ".join(draw.choices(vocabulary, k=draw.randint(1, 30)))]
            out.append(draw.choice([" ", "\n", "  "]).join(parts))
    return out


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def brute_words(texts, window=13):
    first, out = {}, {}
    for doc, text in texts.items():
        words = WORD.findall(text or "")
        for i in range(len(words) - window + 1):
            first.setdefault(tuple(words[i : i + window]), doc)
    for doc, text in texts.items():
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < doc:
                gone[i : i + window] = [True] * window
        left = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[doc] = (len(words), sum(gone), hashlib.sha256(left.encode()).hexdigest())
    return out


def brute_bytes(texts, length=100):
    seen, out = set(), {}
    for doc, text in sorted(texts.items()):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            if s in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(s)
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[doc] = (len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(left).hexdigest())
    return out


def brute_components(texts, size=3, percent=90):
    sets = {}
    for doc, text in texts.items():
        words = WORD.findall((text or "").translate(LOWER))
        short = [tuple(words)] if words else []
        sets[doc] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or set(short)
    root = {doc: doc for doc in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(texts), 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {doc: (len(sets[doc]), find(doc)) for doc in texts}


@pytest.fixture(scope="module")
def planted():
    return dict(enumerate(repeated_texts(1, 120)))


def test_word_windows_of_planted_repeats(spark, planted):
    got = by_id(substrings.remove_repeats(table(spark, planted.values()), with_text=True), "n_words", "n_removed", "kept_sha256", "kept")
    assert {d: x[:3] for d, x in got.items()} == brute_words(planted)
    assert all(hashlib.sha256(x[3].encode()).hexdigest() == x[2] for x in got.values())
    assert sum(x[1] for x in got.values()) > 0


def test_word_windows_of_documents(documents, texts):
    assert by_id(substrings.remove_repeats(documents), "n_words", "n_removed", "kept_sha256") == brute_words(texts)


def test_bytes_of_planted_repeats(spark, planted):
    got = by_id(suffixes.remove_repeats(table(spark, planted.values())), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute_bytes(planted)


def test_bytes_of_documents(documents, texts):
    assert by_id(suffixes.remove_repeats(documents), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(texts)


def test_periodic_text(spark):
    texts = {0: "a" * 1000, 1: "ab" * 300, 2: "x" + "ab" * 200 + "y", 3: "a" * 99, 4: "a" * 100}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert by_id(suffixes.remove_repeats(df), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(texts)


def test_hot_anchors_are_split(monkeypatch):
    texts = repeated_texts(9, 80)
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.append(0, np.cumsum([len(t.encode()) for t in texts]))
    want = np.concatenate([np.zeros(0, bool), *[_gone(texts[: i + 1]) for i in range(len(texts))]])
    for most in (1 << 19, 3000, 300):
        monkeypatch.setattr(suffixes, "MOST_TEXT", most)
        anchor, doc, start, end = suffixes.segments(raw, offsets, 100)
        found = suffixes.Segments(raw, start, end - start, doc, np.zeros(len(doc), np.int64), start - offsets[doc], anchor)
        got = np.zeros(len(raw), bool)
        for d, _, a, b in found.repeats(100, 32):
            for x, y, z in zip(d, a, b, strict=True):
                got[offsets[x] + y : offsets[x] + z] = True
        assert np.array_equal(got, want)


def _gone(texts):
    """What the last text loses."""
    seen = {t.encode()[i : i + 100] for t in texts[:-1] for i in range(len(t.encode()) - 99)}
    raw = texts[-1].encode()
    gone = np.zeros(len(raw), bool)
    for i in range(len(raw) - 99):
        if raw[i : i + 100] in seen:
            gone[i : i + 100] = True
        seen.add(raw[i : i + 100])
    return gone


def test_equal_prefixes_against_sorting():
    draw = np.random.default_rng(4)
    for _ in range(20):
        text = np.append(draw.integers(1, 4, 400), 0).astype(np.uint16)
        order, boundary = suffixes.equal_prefixes(text, 9)
        key = [tuple(text[i : i + 9]) if 0 not in text[i : i + 9] else (i, "end") for i in order.tolist()]
        assert [True, *(a != b for a, b in zip(key, key[1:], strict=False))] == boundary.tolist()
        whole = [k for k in key if "end" not in k]
        assert len(set(whole)) == sum(boundary[i] for i, k in enumerate(key) if "end" not in k)


def test_stripped_texts_keep_their_columns(spark):
    long = "é " + " ".join(f"word{i} of {i * i}" for i in range(30))
    df = spark.createDataFrame([(1, long, "a"), (2, "new " + long, "b"), (2, "new " + long, "b"), (3, None, "c"), (None, long, "d")], "doc_id long, text string, tag string")
    out = suffixes.strip_repeats(df)
    assert out.columns == df.columns and out.count() == 5
    got = {(r.doc_id, r.tag): r.text for r in out.collect()}
    assert got[1, "a"] == long and got[None, "d"] == long and got[3, "c"] is None
    assert got[2, "b"].startswith("new ") and len(got[2, "b"]) < 10


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_components_of_planted_copies(spark, planted, size, percent):
    got = by_id(jaccard.near_duplicates(table(spark, planted.values()), size=size, percent=percent), "n_shingles", "component_id")
    assert got == brute_components(planted, size, percent)


def test_components_of_documents(documents, texts):
    assert by_id(jaccard.near_duplicates(documents, size=3, percent=90), "n_shingles", "component_id") == brute_components(texts)


def test_large_groups_meet_in_blocks(spark, monkeypatch, planted):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    got = by_id(jaccard.near_duplicates(table(spark, planted.values()), size=3, percent=90), "n_shingles", "component_id")
    assert got == brute_components(planted)


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_divide_skip_finds_every_link(percent):
    draw = np.random.default_rng(percent)
    base = np.unique(draw.integers(0, 2**62, 60).astype(np.uint64))
    sets = []
    for _ in range(60):
        keep = base[draw.random(len(base)) < draw.choice([0.5, 0.9, 0.97])]
        sets.append(np.unique(np.append(keep, draw.integers(0, 2**62, draw.integers(0, 6)).astype(np.uint64))))
    x, y = jaccard.search(sets, None, percent)
    a, b = components.forest(x, y)
    root = dict(zip(a.tolist(), b.tolist(), strict=True))
    want = {i: i for i in range(60)}
    for i, j in combinations(range(60), 2):
        both = len(np.intersect1d(sets[i], sets[j]))
        if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            p, q = want[i], want[j]
            want = {k: min(p, q) if v in (p, q) else v for k, v in want.items()}
    assert {i: root.get(i, i) for i in range(60)} == want


def test_components_of_links(spark):
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (200, 150), (7, 7)] + [(500, 500 + k) for k in range(1, 60)]
    draw.shuffle(edges)
    df = spark.createDataFrame([draw.choice([(a, b), (b, a)]) for a, b in edges], "a long, b long").repartition(4)
    got = {r.node: r.component for r in components.components(df).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 150, 200), 100), **dict.fromkeys(range(500, 560), 500)}
    assert components.components(df.limit(0)).count() == 0


def test_filters_never_miss(spark):
    values = list(range(3000)) + list(range(0, 3000, 3))
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(4)
    hashes = lambda b: tx.mix(b.column("v").to_numpy().view(np.uint64))
    once, twice = filters.build(df, hashes, 3000.0)
    all_, third = (tx.mix(np.arange(*r, dtype=np.uint64)) for r in ((0, 3000), (0, 3000, 3)))
    assert once.has(all_).all() and twice.has(third).all()
    others = tx.mix(np.arange(10_000, 30_000, dtype=np.uint64))
    assert once.has(others).mean() < 0.1 and twice.has(others).mean() < 0.05


def test_words_and_spans_are_hashed_alike_wherever_they_lie():
    import pyarrow as pa

    texts = ["the cat sat", None, "", "sat the", " cat\tthe\n"]
    w = tx.words_of(pa.array(texts, pa.string()))
    words = [x for t in texts for x in WORD.findall(t or "")]
    assert np.diff(w.first).tolist() == [3, 0, 0, 2, 2]
    groups = {}
    for word, h in zip(words, w.hash.tolist(), strict=True):
        groups.setdefault(word, set()).add(h)
    assert all(len(x) == 1 for x in groups.values()) and len(set.union(*groups.values())) == 3


def test_repeats_of_odd_rows(odd, none):
    n = odd.count()
    words = substrings.remove_repeats(odd)
    assert words.count() == n and words.filter("doc_id IS NULL AND n_removed > 0").count() == 0
    assert {r.n_words for r in words.filter("doc_id = 5").collect()} == {2, 7}
    found = suffixes.remove_repeats(odd)
    assert found.count() == n
    assert [(r.n_removed, r.n_spans) for r in found.filter("doc_id = 7").collect()] == [(4999, 1)]
    groups = jaccard.near_duplicates(odd)
    assert groups.count() == n
    assert rows(groups.filter("doc_id IN (1, 2, 3)").select("doc_id", "n_shingles", "component_id")) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
    for op in (substrings.remove_repeats, suffixes.remove_repeats, suffixes.strip_repeats, jaccard.near_duplicates):
        assert op(none).count() == 0


def test_copies_send_their_prefix_once(spark):
    """A third of the rows and more are one text; a task deals it once and its links stay."""
    base = [f"w{i}" for i in range(60)]
    near = [*base[:59], "other"]
    texts = {i: " ".join(base) for i in range(400)} | {400 + i: " ".join([*near, f"z{i % 3}"]) for i in range(60)} | {900 + i: f"alone {i} of all the rest" for i in range(9)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(2)
    assert by_id(jaccard.near_duplicates(docs, size=3, percent=90), "n_shingles", "component_id") == brute_components(texts)
    described = jaccard._describe(docs, 3, 90, 10**6)
    assert described.filter("prefix IS NOT NULL").count() >= 460
    links = jaccard._candidates(described, 90, 4)
    assert links.select("a").union(links.select("b")).distinct().count() == 4


def test_parities_never_show_more_than_differs():
    draw = np.random.default_rng(5)
    words = [[f"w{i}" for i in draw.integers(0, 400, n)] for n in (3, 40, 60, 300, 340, 700, 2000)]
    words += [w[:-2] + ["x", "y"] for w in words] + [w + w[: len(w) // 3] for w in words]
    s = jaccard.Sets(pa.array([" ".join(w) for w in words]), 3)
    sets = [set(s.hash[a:b].tolist()) for a, b in zip(s.first[:-1], s.first[1:], strict=True)]
    bits = s.parities(np.ones(len(words), bool))
    assert [8 * len(b) for b in bits] == jaccard.bits_for(s.count).tolist() and s.parities(np.zeros(len(words), bool)) == [None] * len(words)
    apart, everyone = jaccard.differing(bits), np.arange(len(words))
    for i, own in enumerate(sets):
        found = apart(i, everyone)
        assert all(n <= len(own ^ other) for n, other in zip(found.tolist(), sets, strict=True)) and found[i] == 0
        alike = [j for j in range(len(words)) if j != i and len(bits[j]) == len(bits[i]) and len(sets[j] ^ own) < len(own) // 8]
        assert all(found[j] > 0 for j in alike)


def test_long_texts_that_share_passages_do_not_meet_whole(spark, monkeypatch):
    """Chance alone fills 64 cells of long texts alike, so all of them were one group whose whole sets met pair by pair."""
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    monkeypatch.setattr(jaccard, "BITS_BLOCK", 5)
    draw = random.Random(11)
    word = lambda: "".join(draw.choices(string.ascii_lowercase, k=4))
    passages = [" ".join(word() for _ in range(50)) for _ in range(120)]
    long = [" ".join(draw.sample(passages, 60)) for _ in range(24)]
    texts = dict(enumerate([*long, long[3] + " one more", long[5] + " and more", long[5]]))
    docs = table(spark, texts.values())
    described = jaccard._describe(docs, 3, 80, 10**6)
    groups = components.components(jaccard._candidates(described, 80, 4))
    assert groups.groupBy("component").count().agg({"count": "max"}).first()[0] > 20
    assert groups.join(jaccard._narrowed(described, groups, 80, 4), "node", "right").groupBy("node").count().count() == 4
    assert by_id(jaccard.near_duplicates(docs, size=3, percent=80), "n_shingles", "component_id") == brute_components(texts, 3, 80)


def test_copies_go_where_they_are(spark, monkeypatch):
    """Texts that only go are not shuffled: the join with the marks sees those that may stay."""
    texts = [f"text {i} " + " ".join(f"{i}x{j}" for j in range(30)) for i in range(40)]
    rows_ = [(i + 100 * copy, t) for copy in range(5) for i, t in enumerate(texts)] + [(3, texts[3]), (3, "another text of this id"), (None, texts[4])]
    docs = spark.createDataFrame(rows_, "doc_id long, text string")
    asked = []
    build = filters.build
    monkeypatch.setattr(filters, "build", lambda ids, *a, **k: asked.append({r[0] for r in ids.collect()} if "_id" in ids.columns else None) or build(ids, *a, **k))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in jaccard.keep_first(docs).collect())
    assert got == sorted([(False, i, t) for i, t in enumerate(texts)] + [(False, 3, "another text of this id"), (True, 0, texts[4])])
    goes, stay = (ids for ids in asked if ids is not None)
    assert stay == set(range(40)) and goes == {i + 100 * copy for copy in range(1, 5) for i in range(40)} | {3}
