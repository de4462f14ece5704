"""Text expressions: markup removal, tokens, keywords and lexicon sentiment.

Everything works inside the row with array functions, so a document is never
split over shuffles and no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TAG = r"<[^>]+>"

# White space as understood by Unicode text splitting.
SPACES = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Common English stop words, followed by words frequent in news.
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself "
    "yourselves he him his himself she she's her hers herself it it's its itself they them their "
    "theirs themselves what which who whom this that that'll these those am is are was were be "
    "been being have has had having do does did doing a an the and but if or because as until "
    "while of at by for with about against between into through during before after above below "
    "to from up down in out on off over under again further then once here there when where why "
    "how all any both each few more most other some such no nor not only own same so than too "
    "very s t can will just don don't should should've now d ll m o re ve y ain aren aren't "
    "couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma "
    "mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren "
    "weren't won won't wouldn wouldn't "
    "said say says also would could one two"
).split()


def strip_markup(text: Column) -> Column:
    """Remove tags, then collapse runs of white space to one space."""
    return F.regexp_replace(F.regexp_replace(text, TAG, ""), r"\s+", " ")


def title_case(text: Column) -> Column:
    """Trimmed, first letter of each word upper, the rest lower."""
    return F.initcap(F.trim(text))


def source_label(source: Column) -> Column:
    """Display names of the collected sources."""
    named = F.replace(source, F.lit("newsapi_headlines"), F.lit("NewsAPI Headlines"))
    named = F.replace(named, F.lit("newsapi_everything"), F.lit("NewsAPI Everything"))
    return F.replace(named, F.lit("hackernews"), F.lit("Hacker News"))


def joined_text(*columns: str) -> Column:
    """Columns joined by a space; nulls count as empty."""
    return F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns])


def keyword_tokens(text: Column, longer_than: int = 3, stop_words=tuple(STOP_WORDS)) -> Column:
    """Lower-case words of letters a-z, longer than a length and not stop words, in order."""
    # White space becomes plain spaces first, which keeps the pattern short and fast.
    spaced = F.translate(F.lower(text), SPACES, " " * len(SPACES))
    parts = F.split(F.regexp_replace(spaced, "[^a-z ]+", ""), " ")
    return F.filter(parts, lambda w: (F.length(w) > longer_than) & ~w.isin(list(stop_words)))


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row.

    A value named as a column can be written back into its users by the
    optimizer; inside another array function it would then be computed per
    element. A lambda variable cannot.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def top_keywords(text: Column, top_n: int = 10) -> Column:
    """The most frequent tokens of a text, ties by first appearance.

    Tokens are sorted with their position; the starts of equal runs then give
    each word's count and first position. Linear after the sort, however long
    the text.
    """

    def run_starts(ordered: Column) -> Column:
        places = F.when(F.size(ordered) > 0, F.sequence(F.lit(1), F.size(ordered))).otherwise(
            F.array().cast("array<int>")
        )
        return F.filter(
            places,
            lambda p: (p == 1) | (F.element_at(ordered, p)["w"] != F.get(ordered, p - 2)["w"]),
        )

    def ranked(ordered: Column, starts: Column) -> Column:
        counted = F.transform(
            starts,
            lambda p, k: F.struct(
                (p - F.coalesce(F.get(starts, k + 1), F.size(ordered) + 1)).alias("minus_count"),
                F.element_at(ordered, p)["i"].alias("first"),
                F.element_at(ordered, p)["w"].alias("word"),
            ),
        )
        return F.transform(F.slice(F.sort_array(counted), 1, top_n), lambda e: e["word"])

    marked = F.transform(keyword_tokens(text), lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    return bind(
        F.sort_array(marked),
        lambda ordered: bind(run_starts(ordered), lambda starts: ranked(ordered, starts)),
    )
