"""SentencePiece encoding and decoding by vectorised merge rounds.

A text is one leading word mark, then its characters with spaces as marks. No
piece holds a mark after another character, so merges never leave a word (marks
and what follows them up to the next mark). Each distinct word of a batch is
merged once: all words are flat symbol arrays, every round finds each word's
best-scored pair, merges all its occurrences from the left at once, and compacts
the arrays, until no pair is left.

Merging all occurrences at once equals merging one at a time unless a merge
makes a pair that scores better than the one just merged, or different pairs
share a score. Words where a round's best pair scores better than the round
before, and words with pairs of equal score, are merged again one pair a round.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import textops as tx

MARK = "▁"
MOST_WORDS = 400_000  # words a worker remembers between slices; then it starts afresh
_NONE = np.iinfo(np.int64).max
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Pieces:
    """Tables of a SentencePiece BPE model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        text = [model.id_to_piece(i) for i in range(n)]
        byte = np.array([model.is_byte(i) for i in range(n)])
        plain = np.array([not (byte[i] or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)])
        self.of_byte = np.full(256, model.unk_id(), np.int64)
        for i in np.flatnonzero(byte):
            self.of_byte[int(text[i][1:-1], 16)] = i
        self.by_text = {text[i]: int(i) for i in np.flatnonzero(plain)}
        scores = np.array([model.get_score(i) for i in range(n)])
        _, self.rank = np.unique(-scores, return_inverse=True)  # equal scores, equal rank
        self.tied = np.bincount(self.rank)[self.rank] > 1
        # Pairs that merge: all ways to cut a piece in two pieces or single characters.
        self.symbols = dict(self.by_text)  # text -> symbol; characters without a piece follow the pieces
        left, right, made = [], [], []
        for piece, i in self.by_text.items():
            for cut in range(1, len(piece)):
                a, b = self._part(piece[:cut]), self._part(piece[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), made.append(i)
        key = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        order = np.argsort(key)
        self.pair, self.made = key[order], np.array(made, np.int64)[order]
        # Decoded bytes of each id: a mark is a space, controls are nothing.
        out = [bytes([int(text[i][1:-1], 16)]) if byte[i] else text[i].replace(MARK, " ").encode() if plain[i] else b"" for i in range(n)]
        out[model.unk_id()] = " ⁇ ".encode()
        self.out_start = np.cumsum([0, *map(len, out)])
        self.out_raw = np.frombuffer(b"".join(out), np.uint8)
        self.starts_mark = np.array([t.startswith(MARK) and bool(p) for t, p in zip(text, plain, strict=True)])
        self.unknown = model.unk_id()

    def _part(self, text: str) -> int | None:
        if text in self.symbols:
            return self.symbols[text]
        if len(text) == 1:
            self.symbols[text] = len(self.rank) + len(self.symbols)
            return self.symbols[text]
        return None

    def _lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece each pair merges to, or -1."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.made[at], -1)

    def _pairs(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        after = np.minimum(at + 1, len(symbols) - 1)
        made = self._lookup(symbols[at], symbols[after])
        made[(word[at] != word[after]) | (after == at)] = -1
        return made

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Merge flat symbol arrays (``word``: ascending word number of each symbol)."""
        done, again = [], []
        n = int(word[-1]) + 1 if len(word) else 0
        for one_by_one in (False, True):
            before = np.full(n, -1, np.int64)
            start_symbols, start_word = symbols, word
            made = self._pairs(symbols, word, np.arange(len(symbols)))  # what each symbol and the next merge to
            while len(symbols):
                rank = np.where(made >= 0, self.rank[made], _NONE)
                heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                best = np.minimum.reduceat(rank, heads)
                length = np.diff(np.append(heads, len(word)))
                best_here = np.repeat(best, length)
                idle = best_here == _NONE
                if not one_by_one:
                    hit = rank == best_here
                    hit &= ~idle
                    odd = best < before[word[heads]]
                    at = np.flatnonzero(hit)
                    odd |= np.isin(word[heads], word[at[self.tied[made[at]]]])
                    if odd.any():  # leave these words to the second turn
                        away = np.repeat(odd, length)
                        again.append(word[heads[odd]])
                        keep = ~away
                        symbols, word, made = symbols[keep], word[keep], made[keep]
                        continue
                    before[word[heads]] = np.where(best == _NONE, before[word[heads]], best)
                    hit = np.flatnonzero(hit)
                    # Of overlapping occurrences (aaa), every other one from the left.
                    run = np.cumsum(np.append(True, np.diff(hit) > 1)) - 1
                    first = hit[np.flatnonzero(np.append(True, np.diff(hit) > 1))] if len(hit) else hit
                    hit = hit[(hit - first[run]) % 2 == 0] if len(hit) else hit
                else:
                    hit = np.flatnonzero((rank == best_here) & ~idle)
                    hit = hit[np.append(True, word[hit][1:] != word[hit][:-1])] if len(hit) else hit
                if idle.any():
                    done.append((symbols[idle], word[idle]))
                symbols = symbols.copy()
                symbols[hit] = made[hit]
                keep = ~idle
                keep[hit + 1] = False
                place = np.cumsum(keep) - 1
                symbols, word, made = symbols[keep], word[keep], made[keep]
                hit = place[hit]
                near = np.append(hit, hit[hit > 0] - 1)  # only pairs beside a merge change
                made[near] = self._pairs(symbols, word, near)
            if one_by_one or not again:
                break
            chosen = np.isin(start_word, np.concatenate(again))
            symbols, word = start_symbols[chosen], start_word[chosen]
        return done

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, number of ids of each)."""
        text = "".join(words)
        get, base = self.symbols.get, len(self.rank) + len(self.symbols)
        table = {c: get(c, base + ord(c)) for c in set(text)}
        symbols = np.fromiter((table[c] for c in text), np.int64, len(text))
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        char_of = {s: c for c, s in table.items()}
        parts = self.merge(symbols, word)
        if not parts:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        symbols, word = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(word, kind="stable")
        symbols, word = symbols[order], word[order]
        # Characters without a piece become the ids of their bytes.
        bare = np.flatnonzero(symbols >= len(self.rank))
        if len(bare):
            raw = [char_of[int(s)].encode() for s in symbols[bare]]
            counts = np.ones(len(symbols), np.int64)
            counts[bare] = list(map(len, raw))
            place = (np.cumsum(counts) - counts)[bare]
            symbols, word = np.repeat(symbols, counts), np.repeat(word, counts)
            symbols[tx.gather(place, counts[bare])] = self.of_byte[np.frombuffer(b"".join(raw), np.uint8)]
        return symbols, np.bincount(word, minlength=len(words))

    def encode(self, texts: list[str], known: dict[str, int], store: WordStore) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text)."""
        per_text = [_WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = list(set(chain.from_iterable(per_text)).difference(known))
        if new:
            store.add(*self.encode_words(new))
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
        n = sum(map(len, per_text))
        index = np.fromiter(map(known.__getitem__, chain.from_iterable(per_text)), np.int64, n)
        ids, lengths = store.take(index)
        ends = np.append(0, np.cumsum(lengths))
        last = np.cumsum([len(w) for w in per_text])
        return ids, np.diff(np.append(0, ends[last]))

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """Texts of lists of ids, given one after the other."""
        first = np.cumsum(counts) - counts
        skip = np.zeros(len(ids), np.int64)
        some = first[counts > 0]
        # The library drops the space that a leading mark stands for.
        skip[some] = self.starts_mark[ids[some]]
        start = self.out_start[ids] + skip
        length = self.out_start[ids + 1] - start
        raw = self.out_raw[tx.gather(start, length)]
        at = np.append(0, np.cumsum(length))[np.append(first, len(ids))]
        out = tx.string_array(raw, at)
        try:
            out.validate(full=True)
        except pa.ArrowInvalid:
            out = pa.array([_repair(raw[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)], pa.large_string())
        return out


def _repair(raw: bytes) -> str:
    """Decode; each byte that belongs to no character becomes U+FFFD."""
    return "".join("\ufffd" if "\udc80" <= c <= "\udcff" else c for c in raw.decode("utf-8", "surrogateescape"))


class WordStore:
    """Ids of remembered words in one growing array."""

    def __init__(self) -> None:
        self.ids, self.start = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        self.ids = np.concatenate([self.ids, ids])
        self.start = np.append(self.start, self.start[-1] + np.cumsum(counts))

    def take(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.start[index + 1] - self.start[index]
        return self.ids[tx.gather(self.start[index], lengths)], lengths


@lru_cache(1)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``, the SentencePiece ids of each whole text (null: empty list).

    ``model`` is the path of a BPE model file on every machine. Rows are handled
    one by one, so repeated rows, ties and an empty table need no rule; other
    columns pass through and may have any name but ``ids``.
    """
    schema = T.StructType([f for f in docs.schema if f.name != ids] + [T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known, store = pieces(model), {}, WordStore()
        for batch in tx.slices(batches, text):
            if len(known) > MOST_WORDS:
                known, store = {}, WordStore()
            texts = tx.as_large(batch.column(text)).to_pylist()
            found, counts = table.encode(texts, known, store)
            column = tx.list_array(found.astype(np.int32), counts, pa.int32())
            kept = [batch.column(f.name) for f in schema[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, column], schema.names)

    return tx.small_batches(docs).select(*schema.names[:-1]).mapInArrow(run, schema)


def decode(rows: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``text``, what each list of ids decodes to (null: empty)."""
    schema = T.StructType([f for f in rows.schema if f.name != text] + [T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(model)
        for batch in batches:
            for part in _by_ids(batch, ids):
                column = part.column(ids)
                counts = np.nan_to_num(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)).astype(np.int64)
                values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                kept = [part.column(f.name) for f in schema[:-1]]
                yield pa.RecordBatch.from_arrays([*kept, table.decode(values, counts).cast(pa.string())], schema.names)

    return rows.select(*schema.names[:-1]).mapInArrow(run, schema)


def _by_ids(batch: pa.RecordBatch, ids: str, most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    counts = np.nan_to_num(pa.compute.list_value_length(batch.column(ids)).to_numpy(zero_copy_only=False)).astype(np.int64)
    group = (np.cumsum(counts) - counts) // most
    cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else []
    for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def digest(docs: DataFrame, model: str) -> DataFrame:
    """Per document: number of ids, and SHA-256 of its ids and of its decoded text."""
    both = decode(encode(docs.select("doc_id", "text"), model).select("doc_id", "ids"), model)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
