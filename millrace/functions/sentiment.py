"""Lexicon sentiment as column expressions.

Scores follow the published rules for lexicon sentiment of short texts: word
valences, intensifiers and negations up to three words before, capitals,
"but" and closing punctuation, normalised to -1..1. Words without a valence
never leave the row; only the hits are scored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import bind

# The built-in word valences (-4..4), for use without a lexicon table.
LEXICON = {
    "good": 1.9, "great": 3.1, "excellent": 2.7, "amazing": 2.8, "wonderful": 2.7, "best": 3.2,
    "better": 1.9, "love": 3.2, "loved": 2.9, "like": 1.5, "happy": 2.7, "joy": 2.8, "glad": 2.0,
    "win": 2.8, "wins": 2.7, "won": 2.7, "winner": 2.8, "success": 2.7, "successful": 2.8,
    "gain": 2.4, "gains": 1.4, "growth": 1.6, "improve": 1.9, "improved": 2.1, "strong": 2.3,
    "safe": 1.9, "secure": 1.4, "support": 1.7, "help": 1.7, "hope": 1.9, "positive": 2.6,
    "perfect": 2.7, "beautiful": 2.9, "brilliant": 2.8, "fantastic": 2.6, "awesome": 3.1,
    "celebrate": 2.7, "fun": 2.3, "nice": 1.8, "thanks": 1.9, "trust": 2.3, "peace": 2.5,
    "free": 2.3, "innovative": 1.9, "breakthrough": 2.0, "outstanding": 3.0, "superb": 3.1,
    "bad": -2.5, "worse": -2.1, "worst": -3.1, "terrible": -2.1, "horrible": -2.5, "awful": -2.0,
    "hate": -2.7, "hated": -3.2, "sad": -2.1, "angry": -2.3, "fear": -2.2, "afraid": -1.5,
    "fail": -2.5, "failed": -2.3, "failure": -2.3, "fails": -1.8, "crash": -1.7, "crisis": -3.1,
    "loss": -1.3, "losses": -1.7, "lose": -1.7, "lost": -1.3, "loser": -2.4, "attack": -2.1,
    "attacks": -1.9, "war": -2.9, "death": -2.9, "dead": -3.3, "kill": -3.7, "killed": -3.5,
    "murder": -3.7, "crime": -2.5, "fraud": -2.8, "scam": -2.7, "corrupt": -3.0, "disaster": -3.1,
    "danger": -2.4, "dangerous": -2.1, "threat": -2.4, "problem": -1.7, "problems": -1.7,
    "wrong": -2.1, "poor": -2.1, "weak": -1.9, "ugly": -2.3, "pain": -2.3, "sick": -2.3,
    "angst": -1.2, "disgusting": -2.4, "stupid": -2.4, "idiot": -2.3, "moron": -2.2,
    "pathetic": -2.7, "worthless": -1.9, "trash": -1.6, "scum": -2.6, "clown": -0.9, "useless": -1.8,
    "damage": -2.2, "damages": -1.9, "victim": -1.1, "violence": -3.1, "toxic": -2.3,
}

# Intensifying (+) and dampening (-) words.
BOOST = 0.293
BOOSTERS = {
    "absolutely": BOOST, "amazingly": BOOST, "completely": BOOST, "considerably": BOOST,
    "deeply": BOOST, "enormously": BOOST, "entirely": BOOST, "especially": BOOST,
    "exceptionally": BOOST, "extremely": BOOST, "greatly": BOOST, "highly": BOOST, "hugely": BOOST,
    "incredibly": BOOST, "intensely": BOOST, "more": BOOST, "most": BOOST, "particularly": BOOST,
    "quite": BOOST, "really": BOOST, "remarkably": BOOST, "so": BOOST, "substantially": BOOST,
    "thoroughly": BOOST, "totally": BOOST, "tremendously": BOOST, "unusually": BOOST,
    "utterly": BOOST, "very": BOOST,
    "almost": -BOOST, "barely": -BOOST, "hardly": -BOOST, "less": -BOOST, "little": -BOOST,
    "marginally": -BOOST, "occasionally": -BOOST, "partly": -BOOST, "scarcely": -BOOST,
    "slightly": -BOOST, "somewhat": -BOOST,
}

# Negating words.
NEGATIONS = (
    "not never no none nobody nothing neither nor nowhere without cannot can't cant don't dont "
    "doesn't doesnt didn't didnt isn't isnt aren't arent wasn't wasnt weren't werent won't wont "
    "wouldn't wouldnt shouldn't shouldnt couldn't couldnt hasn't hasnt haven't havent hadn't hadnt "
    "ain't aint rarely seldom despite"
).split()

# Published scoring constants.
CAPITALS = 0.733
NEGATE = -0.74
DISTANCE_WEIGHT = (1.0, 0.95, 0.9)
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
PER_EXCLAMATION, MAX_EXCLAMATIONS = 0.292, 4
PER_QUESTION, MANY_QUESTIONS = 0.18, 0.96
NORMALISER = 15.0
POSITIVE, NEGATIVE = 0.05, -0.05


def _literal_map(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def _is_upper(word: Column) -> Column:
    return (word == F.upper(word)) & (word != F.lower(word))


def _word_arrays(body: Column) -> Column:
    """Words of a text without surrounding punctuation, unless little would be left."""

    def stripped(word: Column) -> Column:
        bare = F.regexp_replace(word, r"^\p{Punct}+|\p{Punct}+$", "")
        return F.when(F.length(bare) <= 2, word).otherwise(bare)

    return F.transform(F.filter(F.split(body, r"\s+"), lambda w: w != ""), stripped)


def _count_of(body: Column, mark: str) -> Column:
    return F.length(body) - F.length(F.replace(body, F.lit(mark), F.lit("")))


def _emphasis(body: Column) -> Column:
    """What exclamation and question marks add to the total."""
    questions = _count_of(body, "?")
    return F.least(_count_of(body, "!"), F.lit(MAX_EXCLAMATIONS)) * PER_EXCLAMATION + F.when(
        questions > 3, MANY_QUESTIONS
    ).when(questions > 1, questions * PER_QUESTION).otherwise(0.0)


@dataclass(frozen=True)
class Valences:
    """A lexicon inside an expression: which words it holds, and the valence of one it holds."""

    holds: Callable[[Column], Column]
    value: Callable[[Column], Column]


def literal_valences(words: dict[str, float]) -> Valences:
    """A lexicon of a size that fits into the plan. Words are found by hash: one set for all, and one for each valence."""
    groups: dict[float, list[str]] = {}
    for word, valence in words.items():
        groups.setdefault(float(valence), []).append(word)

    def value(word: Column) -> Column:
        out = F.lit(None).cast("double")
        for valence, members in groups.items():
            out = F.when(word.isin(members), F.lit(valence)).otherwise(out)
        return out

    return Valences(lambda word: word.isin(list(words)), value)


def looked_up_valences(words: Column) -> Valences:
    """The valences of one text's own words, as a map."""
    return Valences(lambda word: F.map_contains_key(words, word), lambda word: F.element_at(words, word))


def _after_context(
    own: Column, loud: Column, mixed: Column, but: Column, place: Column, back: Callable[[Column], tuple[Column, Column, Column]]
) -> Column:
    """A word's score after capitals, the three words before it and "but".

    ``back(d)`` gives the word ``d`` before, whether it is in capitals, and whether
    the lexicon holds it.
    """
    boosters = _literal_map(BOOSTERS)

    def one_back(score: Column, distance: Column) -> Column:
        before, shouted, held = back(distance)
        boost = F.coalesce(F.try_element_at(boosters, before), F.lit(0.0)) * F.when(score < 0, -1.0).otherwise(1.0)
        extra = F.when(mixed & shouted & (boost != 0), F.when(score > 0, CAPITALS).otherwise(-CAPITALS)).otherwise(0.0)
        weight = F.element_at(F.array(*[F.lit(w) for w in DISTANCE_WEIGHT]), distance)
        moved = score + (boost + extra) * weight
        negated = F.when(before.isin(NEGATIONS), moved * NEGATE).otherwise(moved)
        return F.when(before.isNull() | held, score).otherwise(negated)

    shout = F.when(own > 0, CAPITALS).otherwise(-CAPITALS)
    start = own + F.when(mixed & loud, shout).otherwise(0.0)
    moved = F.aggregate(F.array(F.lit(1), F.lit(2), F.lit(3)), start, one_back)
    return moved * F.when((but >= 0) & (place < but), BEFORE_BUT).when((but >= 0) & (place > but), AFTER_BUT).otherwise(1.0)


def _is_mixed(raw: Column) -> Column:
    """Some words, but not all, are in capitals."""
    return bind(F.size(F.filter(raw, _is_upper)), lambda n: (n > 0) & (n < F.size(raw)))


def _hit_scores(raw: Column, words: Column, valences: Valences) -> Column:
    """Scores of the words with a valence, in place."""

    def scores(mixed: Column, but: Column) -> Column:
        def score_of(hit: Column) -> Column:
            def back(distance: Column) -> tuple[Column, Column, Column]:
                before = F.get(words, hit["i"] - distance)
                return before, _is_upper(F.get(raw, hit["i"] - distance)), valences.holds(before)

            return _after_context(valences.value(hit["w"]), _is_upper(F.get(raw, hit["i"])), mixed, but, hit["i"], back)

        hits = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda h: valences.holds(h["w"]))
        return F.transform(hits, score_of)

    but = F.array_position(words, "but") - 1
    return bind(F.struct(_is_mixed(raw).alias("m"), but.alias("b")), lambda c: scores(c["m"], c["b"]))


BEFORE = "array<struct<w: string, loud: boolean>>"


def contexts(text: Column) -> Column:
    """What scoring needs of a text without the text: n, emph, mixed, but, and each word with its place, capitals and the three before it."""

    def of(body: Column, raw: Column, words: Column) -> Column:
        def word(w: Column, i: Column) -> Column:
            before = F.transform(
                F.array(F.lit(1), F.lit(2), F.lit(3)), lambda d: F.struct(F.get(words, i - d).alias("w"), _is_upper(F.get(raw, i - d)).alias("loud"))
            )
            return F.struct(w.alias("w"), i.alias("i"), _is_upper(F.get(raw, i)).alias("loud"), before.alias("before"))

        return F.struct(
            F.size(words).alias("n"),
            _emphasis(body).alias("emph"),
            _is_mixed(raw).alias("mixed"),
            (F.array_position(words, "but") - 1).alias("but"),
            F.transform(words, word).alias("words"),
        )

    return bind(
        F.coalesce(text, F.lit("")),
        lambda b: bind(_word_arrays(b), lambda raw: bind(F.transform(raw, lambda w: F.lower(w)), lambda words: of(b, raw, words))),
    )


def scored_hits(hits: Column, mixed: Column, but: Column) -> Column:
    """Scores of a text's hits: structs of a word of ``contexts`` and its valence."""

    def score_of(hit: Column) -> Column:
        def back(distance: Column) -> tuple[Column, Column, Column]:
            before = F.element_at(hit["before"], distance)
            return before["w"], before["loud"], F.exists(hits, lambda other: other["i"] == hit["i"] - distance)

        return _after_context(hit["valence"], hit["loud"], mixed, but, hit["i"], back)

    return F.transform(hits, score_of)


def verdict(n_words: Column, emphasis: Column, scores: Column) -> Column:
    """A struct of label, compound, positive, negative and neutral shares from a text's scores."""

    def sums(scores: Column) -> Column:
        def total_of(term) -> Column:
            return F.aggregate(scores, F.lit(0.0), lambda a, v: a + term(v))

        return F.struct(
            n_words.alias("n"),
            total_of(lambda v: v).alias("sum"),
            total_of(lambda v: F.when(v > 0, v + 1).otherwise(0.0)).alias("pos"),
            total_of(lambda v: F.when(v < 0, 1 - v).otherwise(0.0)).alias("neg"),
            (n_words - F.size(F.filter(scores, lambda v: v != 0))).alias("neu"),
            emphasis.alias("emph"),
        )

    def with_emphasis(s: Column) -> Column:
        return F.struct(
            s["n"].alias("n"),
            F.when(s["sum"] > 0, s["sum"] + s["emph"])
            .when(s["sum"] < 0, s["sum"] - s["emph"])
            .otherwise(0.0)
            .alias("sum"),
            (s["pos"] + F.when(s["pos"] > s["neg"], s["emph"]).otherwise(0.0)).alias("pos"),
            (s["neg"] + F.when(s["pos"] < s["neg"], s["emph"]).otherwise(0.0)).alias("neg"),
            s["neu"].alias("neu"),
        )

    def result(s: Column) -> Column:
        compound = F.round(s["sum"] / F.sqrt(s["sum"] * s["sum"] + NORMALISER), 4)
        weight = s["pos"] + s["neg"] + s["neu"]

        def share(part: str, when_empty: float) -> Column:
            return F.when(s["n"] == 0, F.lit(when_empty)).otherwise(F.round(s[part] / weight, 4))

        return F.struct(
            F.when(compound >= POSITIVE, "positive")
            .when(compound <= NEGATIVE, "negative")
            .otherwise("neutral")
            .alias("label"),
            compound.alias("compound"),
            share("pos", 0.0).alias("positive"),
            share("neg", 0.0).alias("negative"),
            share("neu", 1.0).alias("neutral"),
        )

    return bind(bind(bind(scores, sums), with_emphasis), result)


def sentiment(text: Column, valences: Valences | Column | None = None) -> Column:
    """A struct of label, compound, positive, negative and neutral shares of a text.

    ``valences`` is a lexicon, or a map of the text's own words to their valence.
    The built-in words are the default.
    """
    if valences is None:
        valences = literal_valences(LEXICON)
    elif not isinstance(valences, Valences):
        valences = looked_up_valences(valences)

    def of_words(body: Column, raw: Column, words: Column) -> Column:
        return verdict(F.size(words), _emphasis(body), _hit_scores(raw, words, valences))

    body = F.coalesce(text, F.lit(""))
    return bind(
        body,
        lambda b: bind(
            _word_arrays(b),
            lambda raw: bind(F.transform(raw, lambda w: F.lower(w)), lambda words: of_words(b, raw, words)),
        ),
    )
