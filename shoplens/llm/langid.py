"""Language identification by segmentation-marginalised unigram models.

A fixed public vocabulary of pieces is given.  Each language has a probability
per piece.  A word's probability under a language is the sum over all of its
segmentations into pieces, computed with the forward algorithm; a text's is the
product over its words, so no single best segmentation is chosen anywhere.
The language with the largest probability wins and the score is its posterior
under equal priors.

Piece probabilities are fitted by expectation maximisation: per iteration one
Spark job sums the expected piece counts (forward and backward) of the distinct
training words of each language.  The training documents are a bounded sample:
about ``max_train`` documents of each language, chosen by a hash of text and
language, from those that the caller allows.  Every document is then scored.

Words are maximal runs of letters (Unicode category L), lower-cased; of a run
longer than ``MAX_WORD`` letters, as unspaced scripts have, each ``MAX_WORD``
letters are a word.  Training and scoring read the same words, and the whole
text.  Letters that the vocabulary lacks share one more piece, so a language that
is mostly written in them is learned as well.  Probabilities are kept as logarithms or scaled, so that no word is too
long or too strange for them.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
equal scores go to the language that sorts first; repeated rows are scored
each; without any training text every document with a letter is ``und`` with
score 0; null ids count as the empty text in the choice of training documents;
texts of any length are read whole; an empty table gives no rows; further columns
are kept, but columns named ``lang_pred`` or ``score`` are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import crc32_of, small_batches, stored

UNKNOWN = "und"
#: Bound on the sampled training documents of each language.
MAX_TRAIN = 800
ITERATIONS = 2
#: Least posterior of a text that a filter keeps.
MIN_SCORE = 0.5
#: Pseudo-count of every piece, and the probability of a letter outside the vocabulary where none is learned.
SMOOTHING, UNSEEN = 0.05, 1e-9
#: The part of a single letter in the piece that the letters outside the vocabulary share.
UNSEEN_LETTER = 1e-4

#: Letters of a run that make a word at the most.
MAX_WORD = 64

_LETTERS = re.compile(r"[^\W\d_]+")
_START = "▁"
_M = np.uint64(0x9E3779B97F4A7C15)
_CACHE_WORDS = 300_000


def default_vocabulary() -> list[str]:
    """The pieces of the public 32k vocabulary, without control and byte pieces."""
    import public_tokenizers as public
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    ids = range(model.get_piece_size())
    return [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]


def words_of(text: str) -> list[str]:
    """The words of a text."""
    out = []
    for run in _LETTERS.findall(text.lower()):
        if run.isalpha():
            parts = [run]
        else:  # numbers and number-like signs among the letters
            parts = "".join(c if c.isalpha() else " " for c in run).split()
        for part in parts:
            out += [part] if len(part) <= MAX_WORD else [part[i : i + MAX_WORD] for i in range(0, len(part), MAX_WORD)]
    return out


def _codes(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), length).astype(np.uint64)


class PieceTable:
    """Piece numbers of all substrings of many words at once, by rolling hashes in two hash tables."""

    def __init__(self, pieces: list[str]) -> None:
        self.size = len(pieces)
        self.longest = max(map(len, pieces), default=1)
        hashes = np.zeros(self.size, np.uint64)
        for length in {len(p) for p in pieces}:
            ids = [i for i, p in enumerate(pieces) if len(p) == length]
            h = np.zeros(len(ids), np.uint64)
            codes = _codes([pieces[i] for i in ids], length)
            for k in range(length):
                h = h * _M + codes[:, k]
            hashes[ids] = h
        self.tables = []
        todo = np.arange(self.size)
        bits = max(8, int(self.size).bit_length() + 5)
        while len(todo):
            slots = self._slot(hashes[todo], len(self.tables), bits)
            keys, ids = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
            keys[slots], ids[slots] = hashes[todo], todo  # of pieces that share a slot, the last stays
            self.tables.append((keys, ids, bits))
            todo = todo[ids[slots] != todo]
            bits = max(8, bits - 4)

    @staticmethod
    def _slot(h: np.ndarray, k: int, bits: int) -> np.ndarray:
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * k)
        return (h >> np.uint64(64 - bits)).astype(np.int64)

    def ids(self, codes: np.ndarray) -> list[np.ndarray]:
        """For each length from 1 the piece number, or -1, at each start: arrays of (words, starts)."""
        out, h = [], np.zeros(codes.shape, np.uint64)
        for length in range(1, min(self.longest, codes.shape[1]) + 1):
            n = codes.shape[1] - length + 1
            h = h[:, :n] * _M + codes[:, length - 1 :]
            found = np.full(h.shape, -1, np.int32)
            for k, (keys, ids, bits) in enumerate(self.tables):
                slot = self._slot(h, k, bits)
                np.copyto(found, ids[slot], where=keys[slot] == h)
            out.append(found)
        return out


def _steps(ids: list[np.ndarray], probs: np.ndarray, unseen: float | np.ndarray) -> list[list[tuple[int, np.ndarray]]]:
    """For each end position the (start, probability) pairs of the pieces ending there; ``probs`` has a last row of zeros."""
    length = ids[0].shape[1]
    steps: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(length + 1)]
    for k, found in enumerate(ids):
        for start in range(found.shape[1]):
            column = found[:, start]
            if k == 0:
                p = probs[column]
                p[column < 0] = unseen
            elif (column >= 0).any():
                p = probs[column]
            else:
                continue
            steps[start + k + 1].append((start, p))
    return steps


def word_logs(words: list[str], table: PieceTable, probs: np.ndarray, unseen: float | np.ndarray = UNSEEN) -> np.ndarray:
    """log of the summed probability of all segmentations: (words, languages).  ``unseen`` is that of a letter outside the vocabulary."""
    out = np.empty((len(words), probs.shape[1]))
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w) + 1, []).append(i)
    for length, rows in by_length.items():
        for at in range(0, len(rows), max(1, 200_000 // length)):
            some = rows[at : at + max(1, 200_000 // length)]
            out[some] = _forward([_START + words[i] for i in some], length, table, probs, unseen)
    return out


def _forward(words: list[str], length: int, table: PieceTable, probs: np.ndarray, unseen: float | np.ndarray) -> np.ndarray:
    steps = _steps(table.ids(_codes(words, length)), probs, unseen)
    shape = (len(words), probs.shape[1])
    alpha, scale = {0: np.ones(shape)}, np.zeros(shape)
    for end in range(1, length + 1):
        total = np.zeros(shape)
        for start, p in steps[end]:
            total += alpha[start] * p
        alpha[end] = total
        alpha.pop(end - table.longest, None)
        if end % 16 == 0:  # long words: keep the numbers in range
            top = np.maximum.reduce(list(alpha.values()))
            scale += np.log(top)
            alpha = {k: a / top for k, a in alpha.items()}
    return np.log(alpha[length]) + scale


def expected_counts(words: list[str], weights: np.ndarray, table: PieceTable, probs: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of the weighted words; ``probs`` is one language's."""
    return expected_uses(words, weights, table, probs)[:-1]


def expected_uses(words: list[str], weights: np.ndarray, table: PieceTable, probs: np.ndarray, unseen: float = UNSEEN) -> np.ndarray:
    """``expected_counts``, followed by the uses of letters outside the vocabulary."""
    out = np.zeros(table.size + 1)
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w) + 1, []).append(i)
    for length, all_rows in by_length.items():
        for at in range(0, len(all_rows), max(1, 200_000 // length)):
            rows = all_rows[at : at + max(1, 200_000 // length)]
            _add_counts(out, [_START + words[i] for i in rows], weights[rows], table, probs, unseen)
    return out


def _add_counts(out: np.ndarray, words: list[str], weights: np.ndarray, table: PieceTable, probs: np.ndarray, unseen: float) -> None:
    """Forward and backward sums as logarithms: the share of a piece's use is a difference of them, and finite."""
    n, length = len(words), len(words[0])
    ids = table.ids(_codes(words, length))
    with np.errstate(divide="ignore"):
        steps = [[(start, np.log(p[:, 0])) for start, p in step] for step in _steps(ids, probs[:, None], unseen)]
    alpha, beta = np.full((length + 1, n), -np.inf), np.full((length + 1, n), -np.inf)
    alpha[0] = beta[length] = 0
    for end in range(1, length + 1):
        for start, p in steps[end]:
            np.logaddexp(alpha[end], alpha[start] + p, out=alpha[end])
    for end in range(length, 0, -1):
        for start, p in steps[end]:
            np.logaddexp(beta[start], beta[end] + p, out=beta[start])
    for end in range(1, length + 1):
        for start, p in steps[end]:
            column = ids[end - start - 1][:, start]
            if start == end - 1:
                column = np.where(column < 0, table.size, column)
            known = column >= 0
            use = np.exp(alpha[start] + p + beta[end] - alpha[length]) * weights
            out += np.bincount(column[known], use[known], table.size + 1)


def training_words(docs: DataFrame, allowed: Column, text_col: str = "text", lang_col: str = "lang", max_train: int = MAX_TRAIN) -> DataFrame:
    """(lang, word, n): distinct words of about ``max_train`` allowed documents of each language."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), allowed.alias("ok"))
    rows = rows.filter(F.col("ok") & F.col("lang").isNotNull() & F.col("text").isNotNull()).drop("ok")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    unit = 1 << 30
    limits = [F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(unit, unit * max_train // n))]
    if limits:
        limit = F.element_at(F.create_map(*limits), F.col("lang"))
        rows = rows.filter(F.pmod(F.xxhash64("text", "lang"), F.lit(unit)) < limit)
    words = rows.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(rf"\p{{L}}{{1,{MAX_WORD}}}"), F.lit(0))).alias("word"))
    return words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


class Model:
    """Languages, pieces and probabilities: (pieces + 1, languages), the last row zeros; and of a letter outside the vocabulary, per language."""

    def __init__(self, langs: list[str], pieces: list[str], probs: np.ndarray, unseen: float | np.ndarray = UNSEEN) -> None:
        self.langs, self.pieces, self.probs, self.unseen = langs, pieces, probs, unseen


def fit(words: DataFrame, pieces: list[str] | None = None, iterations: int = ITERATIONS) -> Model:
    """Expectation maximisation over ``training_words``; the driver keeps one number per piece and language."""
    pieces = default_vocabulary() if pieces is None else pieces
    words = stored(words, "lang-words")
    langs = sorted(r.lang for r in words.select("lang").distinct().collect())
    size = len(pieces)
    probs, unseen = np.zeros((size + 1, len(langs))), np.full(len(langs), UNSEEN)
    probs[:size] = 1 / max(1, size)
    spark = words.sparkSession
    small_batches(spark)
    for _ in range(iterations if langs else 0):
        now = spark.sparkContext.broadcast((langs, pieces, probs, unseen))

        def expect(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            langs, pieces, probs, unseen = now.value
            table, sums = PieceTable(pieces), np.zeros((len(langs), len(pieces) + 1))
            for batch in batches:
                lang, word, n = (c.to_pylist() for c in batch.columns)
                for k, name in enumerate(langs):
                    rows = [i for i, x in enumerate(lang) if x == name]
                    if rows:
                        sums[k] += expected_uses([word[i] for i in rows], np.array([n[i] for i in rows], float), table, probs[:, k], unseen[k])
            k, piece = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(piece, pa.int32()), pa.array(sums[k, piece])], ["k", "piece", "uses"])

        sums = np.zeros((size + 1, len(langs)))
        found = words.mapInArrow(expect, "k int, piece int, uses double").groupBy("k", "piece").agg(F.sum("uses").alias("uses"))
        for r in found.toLocalIterator():
            sums[r.piece, r.k] = r.uses
        probs = np.zeros_like(probs)
        shares = (sums + SMOOTHING) / (sums + SMOOTHING).sum(axis=0)
        probs[:size], unseen = shares[:size], shares[size] * UNSEEN_LETTER
        if not np.isfinite(shares).all():
            raise ArithmeticError("piece probabilities are not finite")
        now.unpersist()
    return Model(langs, pieces, probs, unseen)


class _Scorer:
    """Predicts texts; remembers the log probabilities of words it has met."""

    def __init__(self, model: Model) -> None:
        self.langs, self.probs, self.unseen, self.table = model.langs, model.probs, model.unseen, PieceTable(model.pieces)
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.logs = np.empty((0, len(self.langs)))

    def learn(self, new: set[str]) -> None:
        start, words = len(self.rows), list(new)
        self.logs = np.concatenate([self.logs, word_logs(words, self.table, self.probs, self.unseen)])
        self.rows.update(zip(words, range(start, start + len(words))))

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [], []
        found = [words_of(t) if t else [] for t in texts]
        if len(self.rows) > _CACHE_WORDS:
            self.clear()
        if self.langs:
            self.learn(set().union(*found) - self.rows.keys())
        for words in found:
            if not words or not self.langs:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            total = self.logs[np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))].sum(axis=0)
            best = int(total.argmax())
            langs.append(self.langs[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return langs, scores


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` appended (in place of columns of these names); only the text is read for them."""
    spark = docs.sparkSession
    docs = docs.select(*[c for c in docs.columns if c == text_col or c not in ("lang_pred", "score")])
    small_batches(spark)
    shared = spark.sparkContext.broadcast((model.langs, model.pieces, model.probs, model.unseen))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(Model(*shared.value))
        for batch in batches:
            langs, scores = scorer(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names, "lang_pred", "score"])

    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return docs.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose text has a language, with a posterior of at least ``min_score``, as they are."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast((model.langs, model.pieces, model.probs, model.unseen))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(Model(*shared.value))
        for batch in batches:
            langs, scores = scorer(batch.column(at).to_pylist())
            yield batch.filter(pa.array([g != UNKNOWN and s >= min_score for g, s in zip(langs, scores)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(id_col: Column) -> Column:
    """Documents kept out of training: CRC-32 of the id's text leaves 2 modulo 4."""
    return F.pmod(crc32_of(id_col), F.lit(4)) == 2


def identify(docs: DataFrame, pieces: list[str] | None = None, max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    model = fit(training_words(docs, ~held_out(F.col("doc_id")), max_train=max_train), pieces)
    rows = predict(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), model)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
