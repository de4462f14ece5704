"""Every stage against brute force on what the stage before it kept, and the registered queries."""

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from millrace.llm import personal, quality
from millrace.session import stage_table
from tests.llm.test_judgements import brute_spans, brute_stats
from tests.llm.test_repeats import brute_bytes, brute_components
from tests.llm.test_tokens import check_places, want_pieces


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_do_what_they_say(spark, sf, documents):
    (_, good), (_, apart), (_, once), (_, masked), (_, pack) = pipeline.STAGES
    columns = documents.columns
    first = stage_table(good(spark, documents, sf), "first")
    rules = quality.fit(documents, spark.read.parquet(f"{sf}/labels.parquet"))
    marked = {r.doc_id for r in quality.judge(documents, rules).filter("rule IS NOT NULL").collect()}
    want = {d: t for d, t in texts_of(documents).items() if not brute_stats(t)[-1] and d not in marked}
    assert first.columns == columns and texts_of(first) == want

    second = stage_table(apart(spark, first, sf), "second")
    groups = brute_components(want, 5, 80)
    want = {d: t for d, t in want.items() if groups[d][1] == d}
    assert second.columns == columns and second.count() == len(want) and texts_of(second) == want

    third = stage_table(once(spark, second, sf), "third")
    removed = {d: x[1] for d, x in brute_bytes(want).items()}
    got = texts_of(third)
    assert third.columns == columns and got.keys() == want.keys()
    for d, text in want.items():
        # A cut may fall inside a character, whose other bytes keep it.
        assert 0 <= removed[d] - (len(text.encode()) - len(got[d].encode())) <= 6 * (removed[d] > 0) * (1 + removed[d] // 100)
    assert third.filter(F.col("n_chars") != F.length("text")).count() == 0

    fourth = stage_table(masked(spark, third, sf), "fourth")
    assert fourth.columns == columns
    assert texts_of(fourth) == {d: personal.masked(t, brute_spans(t)) for d, t in got.items()}

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    last = pack(spark, fourth, sf).collect()
    check_places(last)
    want_rows = sorted((d, *x) for d, t in texts_of(fourth).items() for x in want_pieces(t, library))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in last) == want_rows


def test_stages_take_odd_rows(spark, sf, odd, none):
    for name, stage in pipeline.STAGES:
        for docs in (odd, none):
            out = stage(spark, docs, sf)
            n = out.count()
            assert (n == 0) == (docs is none) or name == "quality rules", name
            assert out.columns == docs.columns or name == "best-fit packing", name


def test_queries_are_registered(spark, sf):
    names = entry.queries()
    numbers = sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit())
    assert numbers == list(range(1, 14)) and "pipeline" in names
    assert [n for n, _ in pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "suffix-array dedup", "personal data", "best-fit packing"]
    rows = names["pipeline"](spark, sf).collect()
    check_places(rows)
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows) > 100
