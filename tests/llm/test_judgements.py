"""Quality, language and personal data: counts against plain Python, learning against planted rules."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import language, personal, quality
from tests.conftest import rows
from tests.llm.conftest import by_id

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_stats(text):
    words = WORD.findall(text or "")
    repeated, places = [False] * len(words), {}
    for i in range(len(words) - 7):
        window = tuple(words[i : i + 8])
        if window in places:
            for j in (places[window], i):
                repeated[j : j + 8] = [True] * 8
        else:
            places[window] = i
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n = sum(repeated)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), n, len(words) < 20 or 100 * n > 30 * len(words))


def test_statistics_of_whole_documents(documents, texts):
    got = by_id(quality.judge(documents, []), *quality.STATS, "base_failed", "kept")
    assert got == {doc: (*(s := brute_stats(text)), not s[-1]) for doc, text in texts.items()}


def test_statistics_of_odd_rows(odd, none):
    got = quality.judge(odd, [])
    want = sorted((r.doc_id is None, r.doc_id or 0, *brute_stats(r.text)) for r in odd.collect())
    assert sorted((r.doc_id is None, r.doc_id or 0, *(r[c] for c in quality.STATS), r.base_failed) for r in got.collect()) == want
    assert quality.judge(none, []).count() == 0 and quality.keep_good(none, []).count() == 0
    kept = quality.keep_good(odd.withColumn("text", F.lit(" ".join(f"w{i}" for i in range(30)))), [])
    assert kept.columns == odd.columns and kept.count() == odd.count()


def planted_quality(spark):
    """Bad texts hold symbols, or say few different words; good ones neither."""
    rows_ = []
    for i in range(600):
        words = [f"w{(i * 7 + j * j) % 97}x{j}" for j in range(40)]
        if i % 5 == 0:
            words = [f"{w}###" for w in words]
        elif i % 5 == 1:
            words = [f"w{j % 7}q{i}" + "abcdefg"[(j // 7 + j) % 5] for j in range(40)]
        rows_.append((i, " ".join(words), int(i % 5 > 1)))
    return spark.createDataFrame(rows_, "doc_id long, text string, quality int")


def test_rules_find_what_makes_texts_bad(spark):
    df = planted_quality(spark)
    rules = quality.fit(df.select("doc_id", "text"), df.select("doc_id", "quality"))
    assert rules and all(str(c).split()[0] in quality.FEATURES for r in rules for c in r)
    judged = quality.judge(df, rules).join(df.select("doc_id", "quality"), "doc_id").filter("NOT base_failed")
    assert judged.filter("quality = 1 AND NOT kept").count() == 0
    assert judged.filter("quality = 0 AND kept").count() < 0.05 * judged.filter("quality = 0").count() + 1
    good = quality.keep_good(df, rules)
    assert good.columns == df.columns
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in quality.judge(df, rules).filter("kept").collect()}


def test_rules_need_labels_of_both_kinds(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fit(documents, labels) == []
    alone = documents.select("doc_id", F.lit(1).alias("quality"))
    assert quality.fit(documents, alone) == []
    odd = labels.union(spark.createDataFrame([(None, 0), (10**12, 0), (1, None)], labels.schema))
    assert quality.fit(documents, odd) == []


def test_rules_reject_bad_documents_and_keep_good_ones(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.judge(docs, quality.fit(docs, labels)).join(labels, "doc_id").filter("NOT base_failed")
    assert judged.filter("quality = 1 AND kept").count() >= 0.98 * judged.filter("quality = 1").count()
    assert judged.filter("quality = 0 AND NOT kept").count() >= 0.9 * judged.filter("quality = 0").count()


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out")
    assert held.filter("lang = lang_pred").count() >= 0.98 * held.count() > 300
    assert got.filter("score < 0 OR score > 1").count() == 0
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.collect())


def test_languages_of_odd_rows(spark, odd, none, documents):
    model = language.fit(documents)
    got = language.predict(odd, model)
    assert got.count() == odd.count()
    for r in got.collect():
        if r.doc_id in (1, 2, 3):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in model.languages and 0 <= r.score <= 1
    letterless = spark.createDataFrame([(1, "123 ²³ !? ٣"), (2, "x")], "doc_id long, text string")
    assert [r.lang_pred == "und" for r in language.predict(letterless, model).orderBy("doc_id").collect()] == [True, False]
    assert language.predict(none, model).count() == 0
    empty = language.fit(none)
    assert {r.lang_pred for r in language.predict(odd, empty).collect()} == {"und"}
    assert language.identify(none).count() == 0


def test_no_language_is_lost_and_copies_count_once(spark):
    rows = [(f"{'abcdefghij'[i % 10]}{'klmnop'[i // 10]} word{'qrstuv'[i // 10]}", f"l{i:02d}") for i in range(60)]
    rows += [("one copied text", "l00")] * 3000 + [(f"text number {'xy' * i}", "l01") for i in range(40)] + [("12 34", "l99"), (None, "l98")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    drawn = language._sampled(docs, "text", "lang", 25, 7)
    sizes = {r["lang"]: r["n"] for r in drawn.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert sizes == {f"l{i:02d}": 1 for i in range(2, 60)} | {"l00": 2, "l01": 25}
    assert drawn.filter("held").groupBy("lang").count().collect() == [("l01", 5)]
    assert language.fit(docs, per_language=25).languages == [f"l{i:02d}" for i in range(60)]


def test_predictions_equal_plain_kneser_ney(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.fit(docs, per_language=20)
    scorer = language.Scorer(model.models, model.order)
    got = {r.doc_id: r.lang_pred for r in language.predict(docs, model).collect()}
    for r in docs.filter("doc_id % 5 = 0").collect():
        sums = scorer.words((r.text or "").split()).sum(0)
        near = sums[:-1] - sums[:-1].min() < 1e-3 * max(sums[-1], 1)
        assert got[r.doc_id] == "und" if not sums[-1] else got[r.doc_id] in [m for m, x in zip(model.languages, near, strict=True) if x]


def test_kneser_ney_sums_to_one():
    import math

    words = ["banana", "band", "ban", "nab", "a"]
    counts = {}
    for w in (language.EDGE + w + language.EDGE for w in words):
        for i in range(1, len(w)):
            g = w[max(0, i + 1 - 3) : i + 1]
            counts[g] = counts.get(g, 0) + 1
    scorer = language.Scorer({"x": language.train(counts, 3)}, 3)
    symbols = sorted({c for w in words for c in w} | {language.EDGE})
    text = language.np.frombuffer("".join(language.EDGE + "ba" + s for s in symbols).encode("utf-32-le"), language.np.uint32).astype(language.U64)
    at = language.np.arange(len(symbols)) * 4 + 3
    chance = language.np.exp(-scorer._costs(text, at, language.np.full(len(symbols), 3)))[:, 0]
    # All seen symbols; the rest belongs to symbols never seen.
    assert 0.9 < chance.sum() <= 1 + 1e-9 and chance[symbols.index("n")] == max(chance)
    assert math.isfinite(scorer.words(["zzz"])[0, 0])


def brute_spans(text):
    def digits(x):
        return re.sub("[^0-9]", "", x)

    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits(m[0]))))
        if 16 <= len(digits(m[0])) <= 19 and total % 10 == 0:
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15]


def test_base_spans_equal_the_patterns():
    import random

    draw = random.Random(2)
    for _ in range(20_000):
        text = "".join(draw.choice("ab.@-_+ 0123456789()é\n@.") for _ in range(draw.randint(0, 60)))
        assert personal.base_spans(text) == brute_spans(text)
    for text in ("1" * 50_000, "a" * 50_000 + "@", "1." * 20_000, "+1" + " " * 50_000, "@" * 20_000):
        assert personal.base_spans(text) == brute_spans(text) if len(text) < 100 else personal.base_spans(text) is not None


def test_personal_data_of_whole_documents(documents, texts):
    got = by_id(personal.find(documents), "base")
    assert {d: personal._triples(x[0]) for d, x in got.items()} == {d: brute_spans(t or "") for d, t in texts.items()}


@pytest.fixture(scope="module")
def contexts(spark):
    told = [(i, f"Some words. Mobile phone: +1 555 01{i:02d} 22{i:02d} and more of the words", "x") for i in range(8)]
    told += [
        (100, "Please note the mobile phone: 0171-555-7788 thanks", "x"),
        (101, "phone: none given", "x"),
        (102, None, "x"),
        (103, "", "x"),
        (104, "the year 20240101 was fine", "x"),
        (None, "mail a@b.co now", "x"),
        (105, "a@b.co", "x"),
        (105, "a@b.co", "x"),
    ]
    return spark.createDataFrame(told, "doc_id long, text string, base string")


def test_contexts_discover_identifiers(contexts):
    got = [(r.doc_id, r.spans) for r in personal.digest(contexts).collect()]
    assert (100, "phone:30:43") in got and (101, "") in got and (104, "") in got and (102, "") in got and (103, "") in got
    assert got.count((105, "email:0:6")) == 2 and (None, "email:5:11") in got


def test_context_words_of_any_length():
    for n in (1, 390, 399, 400, 401, 450, 5000):
        long, gap = "w" * n, " " * n
        for text, want in ((f"a {long} x@y.z", ["a", long]), (f"{long} of x@y.z", [long, "of"]), (f"{long}{gap}{long}\t{gap}x@y.z", [long, long]), (f"{gap}{long} x@y.z", [long])):
            assert personal._before(text, text.index("x@y.z")) == want
    assert personal._before("ax@y.z", 1) is None and personal._before("x@y.z", 0) is None


def test_copies_are_no_evidence(spark):
    same = [(i, "Call the office line: +1 555 0100 2200 today") for i in range(9)] + [(20, "the office line: 0171-555-7788")]
    df = spark.createDataFrame(same, "doc_id long, text string")
    assert personal.digest(df).filter("doc_id = 20").first().spans == ""


def test_patterns_are_judged_on_the_whole_graph(spark):
    """Few seeds and more ordinary words, but a hundred identifiers that are seeds elsewhere, in other files."""
    here = [(i, f"hotline +1 555 0100 77{i}") for i in range(3)] + [(10 + i, "our hotline is busy") for i in range(10)]
    away = [(100 + i, f"hotline 15550200{i:03d}") for i in range(100)] + [(300 + i, f"reach +1 555 0200 {i:03d}") for i in range(100)]
    last = [(500, "hotline 99887766")]
    schema = "doc_id long, text string"
    apart = spark.createDataFrame(here, schema).coalesce(1).unionByName(spark.createDataFrame(away + last, schema).coalesce(1))
    for df in (apart, apart.coalesce(1), apart.repartition(7)):
        assert personal.digest(df).filter("doc_id = 500").first().spans == "phone:8:16"


SPACED = {
    "0171 555 7788": "0171 555 7788",
    "0171 555 7788, 300 of them": "0171 555 7788",
    "0171 555 7788. 20 people": "0171 555 7788",
    "(020) 7946 0958": "(020) 7946 0958",
    "555 0100 2200": "555 0100 2200",
    "(0171 555 7788) 20 people": "0171 555 7788",
    "0171 (555) 7788 today": "0171 (555) 7788",
    "555 0100 2200 (300 people)": "555 0100 2200",
    "0171 555 7788 x20": "0171 555 7788",
    "0171 555 7788 2024-05-06": "0171 555 7788",
    "( 020 ) 7946 0958": "( 020 ) 7946 0958",
    "0171 555\n7788": "0171 555",
    "0171 - 555 - 7788 - 3pm": "0171 - 555 - 7788",
    "tel:0171 555 7788": "tel:0171 555 7788",
    "12 people": None,
}


def test_identifiers_with_blanks_are_found_whole(spark):
    seeds = [(i, f"é the desk line: +1 555 01{i:02d} 22{i:02d} ok") for i in range(60)]
    cards = [(100 + i, f"the visa card: {c} ok") for i, c in enumerate(("4111 1111 1111 1111", "5500 0000 0000 0004", "4012 8888 8888 1881", "6011 0000 0000 0004"))]
    cards += [(104 + i, "the visa card: 4111 1111 1111 1111 ok") for i in range(20)]
    told = [(200 + i, f"é the desk line: {v}") for i, v in enumerate(SPACED)] + [(300, "the visa card: 3782 822463 10005 is bad")]
    df = spark.createDataFrame(seeds + cards + told, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in personal.digest(df).collect()}
    for i, (text, want) in enumerate(SPACED.items()):
        at = 17 + text.index(want) if want else 0
        assert got[200 + i] == (f"phone:{at}:{at + len(want)}" if want else ""), text
    assert got[300] == "card:15:32"
    masked = {r.doc_id: r.text for r in personal.mask(df).collect()}
    assert masked[200] == "é the desk line: <PHONE>" and masked[300] == "the visa card: <CARD> is bad"


def test_masking_replaces_spans_and_keeps_the_rest(contexts, none):
    out = personal.mask(contexts)
    assert out.columns == contexts.columns and out.count() == contexts.count()
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert (100, "Please note the mobile phone: <PHONE> thanks") in got and (102, None) in got and (None, "mail <EMAIL> now") in got
    assert personal.mask(none).count() == 0 and personal.digest(none).count() == 0


def test_personal_data_of_odd_rows(odd):
    assert personal.mask(odd).columns == odd.columns
    assert rows(personal.mask(odd).select("doc_id", "text")) == rows(odd.select("doc_id", "text"))
