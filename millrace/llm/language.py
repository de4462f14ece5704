"""Language identification by interpolated Kneser-Ney models of the characters of words.

Each language gets one model of orders 1 to ORDER, learnt from a bounded sample of
different labelled texts. A word is its letters, lower-cased, between two edge symbols.
The grams of each order are sorted 64-bit hashes beside their interpolated
probabilities; contexts are sorted hashes beside the weight they leave to the next
order. A text gets the language of the lowest cross-entropy per symbol. Part of
the sample is kept back to calibrate the score, which is a probability, and the
cross-entropy above which a prediction counts as rejected.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import textops as tx
from millrace.session import stage_table

ORDER = 4
EDGE = "\x02"
MOST_WORDS = 600_000  # words a worker remembers
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
U64 = np.uint64


def letter_runs(word: str) -> list[str]:
    """Maximal runs of letters, lower-cased; letters are what str.isalpha says."""
    runs = _LETTERS.findall(word.lower())
    return [r for run in runs for r in ([run] if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split())]


@dataclass
class Order:
    """Grams of one order: hash and probability, and contexts: hash and weight left to the order below."""

    gram: np.ndarray
    chance: np.ndarray
    context: np.ndarray
    left: np.ndarray


def _hash_grams(text: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Hash of ``length`` code points from each start."""
    h = np.full(len(start), length, U64)
    for i in range(length):
        h = (h ^ text[start + i]) * U64(0x9E3779B97F4A7C15)
        h ^= h >> U64(29)
    return tx.mix(h)


def _hash_strings(grams: list[str]) -> np.ndarray:
    flat = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).astype(U64)
    n = np.fromiter(map(len, grams), np.int64, len(grams))
    start = np.cumsum(n) - n
    out = np.zeros(len(grams), U64)
    for k in np.unique(n):
        out[n == k] = _hash_grams(flat, start[n == k], int(k))
    return out


def train(counts: dict[str, int], order: int = ORDER) -> list[Order]:
    """Kneser-Ney from counts of the longest grams (shorter ones begin at a word's edge)."""
    tables: list[dict[str, int]] = [{} for _ in range(order + 1)]
    for gram, n in counts.items():
        tables[len(gram)][gram] = n
    # Below the top, a gram counts the different symbols before it; at the edge nothing stands before.
    for k in range(order, 1, -1):
        for gram in tables[k]:
            if k - 1 == 1 or gram[1:][0] != EDGE:
                tables[k - 1][gram[1:]] = tables[k - 1].get(gram[1:], 0) + 1
    symbols = len(tables[1]) + 1
    chance: dict[str, float] = {"": 1 / symbols}
    out = []
    for k in range(1, order + 1):
        table = tables[k]
        ones, twos = (sum(1 for n in table.values() if n == x) for x in (1, 2))
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        total, kinds = defaultdict(int), defaultdict(int)
        for gram, n in table.items():
            total[gram[:-1]] += n
            kinds[gram[:-1]] += 1
        left = {c: discount * kinds[c] / total[c] for c in total}
        below, chance = chance, {}
        floor = below.get("", 0.0)
        for gram, n in table.items():
            c = gram[:-1]
            lower = _lower(gram[1:], below, floor) if k > 1 else floor
            chance[gram] = max(n - discount, 0) / total[c] + left[c] * lower
        grams, contexts = list(chance), list(left)
        g, c = _hash_strings(grams), _hash_strings(contexts)
        a, b = np.argsort(g), np.argsort(c)
        out.append(Order(g[a], np.array(list(chance.values()))[a], c[b], np.array([left[x] for x in contexts])[b]))
    return out


def _lower(gram: str, below: dict[str, float], floor: float) -> float:
    return below[gram] if gram in below else floor


class Scorer:
    """Cross-entropy sums of words under every language."""

    def __init__(self, models: dict[str, list[Order]], order: int) -> None:
        self.models, self.order = models, order

    def words(self, words: list[str]) -> np.ndarray:
        """Per word: minus log probability under each language, then its number of symbols."""
        runs, owner = [], []
        for i, w in enumerate(words):
            for run in letter_runs(w):
                runs.append(EDGE + run + EDGE)
                owner.append(i)
        out = np.zeros((len(words), len(self.models) + 1))
        if not runs:
            return out
        text = np.frombuffer("".join(runs).encode("utf-32-le"), np.uint32).astype(U64)
        n = np.fromiter(map(len, runs), np.int64, len(runs))
        first = np.cumsum(n) - n
        at = tx.gather(first + 1, n - 1)  # every symbol but the first edge is predicted
        size = np.minimum(at - np.repeat(first, n - 1) + 1, self.order)
        top = np.zeros(len(at), U64)
        for k in range(2, self.order + 1):
            top[size == k] = _hash_grams(text, at[size == k] - k + 1, k)
        _, one, back = np.unique(top, return_index=True, return_inverse=True)
        costs = self._costs(text, at[one], size[one])
        word = np.repeat(np.array(owner), n - 1)
        for j in range(costs.shape[1]):
            out[:, j] = np.bincount(word, costs[back, j], len(words))
        out[:, -1] = np.bincount(word, minlength=len(words))
        return out

    def _costs(self, text: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        hashes = {}
        for k in range(1, self.order + 1):
            here = np.flatnonzero(size >= k)
            hashes[k] = here, _hash_grams(text, at[here] - k + 1, k), _hash_grams(text, at[here] - k + 1, k - 1)
        out = np.empty((len(at), len(self.models)))
        for j, model in enumerate(self.models.values()):
            p = np.full(len(at), 1 / (len(model[0].gram) + 1))
            for k, table in enumerate(model, 1):
                here, gram, context = hashes[k]
                hit, where = _find(table.gram, gram)
                seen, place = _find(table.context, context)
                p[here] = np.where(hit, table.chance[where], np.where(seen, table.left[place], 1.0) * p[here])
            out[:, j] = -np.log(np.maximum(p, 1e-12))
        return out


def _find(have: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(have, asked), len(have) - 1)
    return have[place] == asked, place


@dataclass
class Model:
    """All languages, and what was calibrated."""

    languages: list[str]
    models: dict[str, list[Order]]
    order: int
    sharpness: float = 1.0
    limit: dict[str, float] | None = None


class _Cache:
    """Scores of words by hash."""

    def __init__(self, model: Model) -> None:
        self.scorer, self.width = Scorer(model.models, model.order), len(model.languages) + 1
        self.clear()

    def clear(self) -> None:
        self.hash, self.slot = np.zeros(0, U64), np.zeros(0, np.int64)
        self.table = np.zeros((0, self.width), np.float32)

    def documents(self, text: pa.Array) -> np.ndarray:
        """Per document: the sums of its words' scores."""
        if len(self.hash) > MOST_WORDS:
            self.clear()
        words = tx.words_of(text, cut_marks=True)
        found, at, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hash, found)
        known = np.zeros(len(found), bool)
        inside = place < len(self.hash)
        known[inside] = self.hash[place[inside]] == found[inside]
        new = np.flatnonzero(~known)
        if len(new):
            raw = words.raw.tobytes()
            spans = zip(words.start[at[new]].tolist(), words.end[at[new]].tolist(), strict=True)
            scores = self.scorer.words([raw[a:b].decode() for a, b in spans])
            self.slot = np.insert(self.slot, place[new], len(self.table) + np.arange(len(new)))
            self.hash = np.insert(self.hash, place[new], found[new])
            self.table = np.concatenate([self.table, scores.astype(np.float32)])
        slot = self.slot[np.searchsorted(self.hash, found)][inverse]
        n = len(words.first) - 1
        doc = words.doc
        return np.stack([np.bincount(doc, self.table[slot, j], n) for j in range(self.width)], axis=1)


def _sampled(docs: DataFrame, text: str, lang: str, per_language: int, seed: int) -> DataFrame:
    """text, lang, held: the texts with the ``per_language`` smallest hashes of each language, each once."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = tx.small_batches(rows).withColumn("draw", F.xxhash64("text", F.lit(seed)))
    # Copies are one text before they are ranked; each task sends the window only its first few of a language.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    drawn = rows.select("lang", "draw").distinct().withColumn("place", rank).filter(F.col("place") <= per_language)
    # The smallest is always learnt from, so no language is lost to calibration.
    drawn = drawn.select("lang", "draw", (F.col("place") % 5 == 0).alias("held"))
    found = rows.join(F.broadcast(drawn), ["lang", "draw"])  # per_language short rows for each language
    return found.groupBy("lang", "draw", "held").agg(F.first("text").alias("text")).select("text", "lang", "held")


def _count(sample: DataFrame, order: int) -> DataFrame:
    """lang, gram, n of the longest grams of all words of the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, "text"):
            words: dict[str, Counter] = defaultdict(Counter)
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                words[lang].update(letter_runs(text))
            for lang, seen in words.items():
                grams: Counter = Counter()
                for word, n in seen.items():
                    w = EDGE + word + EDGE
                    for i in range(1, len(w)):
                        grams[w[max(0, i + 1 - order) : i + 1]] += n
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(list(grams)), pa.array(list(grams.values()), pa.int64())], ["lang", "gram", "n"])

    return sample.mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = 1000, order: int = ORDER, seed: int = 7) -> Model:
    """Learn from at most ``per_language`` different texts of each language, every fifth kept for calibration.

    Texts are drawn by the smallest hashes, copies once, so the sample, the model and what
    the driver gathers are bounded by ``per_language`` and the number of languages. A
    language with at least one text that holds a letter is always learnt.
    """
    sample = stage_table(_sampled(docs, text, lang, per_language, seed), "languages")
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    for row in _count(tx.small_batches(sample.filter("NOT held")), order).toLocalIterator():
        counts[row["lang"]][row["gram"]] = row["n"]
    languages = sorted(counts)
    model = Model(languages, {name: train(counts[name], order) for name in languages}, order)
    return _calibrate(model, tx.small_batches(sample.filter("held"))) if languages else model


def _calibrate(model: Model, held: DataFrame) -> Model:
    shared = held.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Cache(shared.value)
        for batch in tx.slices(batches, "text"):
            sums = cache.documents(tx.as_large(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(list(sums), pa.list_(pa.float64()))], ["lang", "sums"])

    rows = [r for r in held.mapInArrow(run, "lang string, sums array<double>").collect() if r["lang"] in model.languages and r["sums"][-1] > 0]
    model.limit = dict.fromkeys(model.languages, float("inf"))
    if rows:
        sums = np.array([r["sums"] for r in rows])
        truth = np.array([model.languages.index(r["lang"]) for r in rows])
        cost = sums[:, :-1] / sums[:, -1:]
        best = None
        for sharpness in np.geomspace(0.05, 50, 40):
            p = _chances(cost, sums[:, -1], sharpness)
            loss = -np.log(np.maximum(p[np.arange(len(p)), truth], 1e-9)).mean()
            if best is None or loss < best:
                best, model.sharpness = loss, float(sharpness)
        for j, name in enumerate(model.languages):
            if (truth == j).any():
                model.limit[name] = float(np.quantile(cost[truth == j, j], 0.995))
    return model


def _chances(cost: np.ndarray, n: np.ndarray, sharpness: float) -> np.ndarray:
    z = -sharpness * np.sqrt(np.maximum(n, 1))[:, None] * (cost - cost.min(1, keepdims=True))
    e = np.exp(z)
    return e / e.sum(1, keepdims=True)


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, the columns of ``keep``, lang_pred, score, cross_entropy and rejected.

    The whole text counts. Null texts, texts without a letter, and all texts under
    a model without languages are ``und`` with score 0 and are rejected; ties go
    to the language first in the alphabet. Rows are judged one by one.
    """
    keep = keep or {}
    source = tx.small_batches(docs).select(F.col(doc_id), *(c.alias(n) for n, c in keep.items()), F.col(text).alias("_text"))
    kept = [doc_id, *keep]
    schema = source.select(*kept).schema.add("lang_pred", "string").add("score", "double").add("cross_entropy", "double").add("rejected", "boolean")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        cache = _Cache(m)
        for batch in tx.slices(batches, "_text"):
            n = batch.num_rows
            if m.languages:
                sums = cache.documents(tx.as_large(batch.column("_text")))
                some = sums[:, -1] > 0
                cost = sums[:, :-1] / np.maximum(sums[:, -1:], 1)
                chance = _chances(cost, sums[:, -1], m.sharpness)
                best = cost.argmin(1)
                name = [m.languages[i] if ok else UNKNOWN for i, ok in zip(best.tolist(), some.tolist(), strict=True)]
                score = np.where(some, chance.max(1), 0.0)
                low = cost.min(1)
                limit = np.array([m.limit[x] for x in m.languages])
                rejected = ~some | (low > limit[best])
            else:
                name, score, low, rejected = [UNKNOWN] * n, np.zeros(n), np.zeros(n), np.ones(n, bool)
            columns = [*(batch.column(c) for c in kept), pa.array(name), pa.array(score), pa.array(low), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return source.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """The documents that nothing is learnt from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out and predict all."""
    model = fit(docs.filter(~F.coalesce(held_out(), F.lit(False))))
    return predict(docs, model, keep={"held_out": F.coalesce(held_out(), F.lit(False))})
