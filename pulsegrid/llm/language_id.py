"""Language identification by segmentation-marginalised unigrams over a fixed public vocabulary."""

from __future__ import annotations

import base64
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import few_rows, materialize, maybe_broadcast, release, slices

#: The model is fitted on about so many documents at most, chosen by a hash of their ids; every language has its share.
MAX_TRAIN_DOCS = 20_000
#: A run of letters longer than this is read as several words, cut between characters.
MAX_WORD = 96
#: Sums over words of up to so many bytes stay within the range of numbers; those of longer ones are logarithms.
SHORT = 30
EM_ROUNDS = 2
#: Words that a task remembers: two generations of so many at most.
CACHE_ENTRIES = 60_000
#: Digits and ASCII punctuation carry no language.
_WORDS = bytes(c if c >= 128 or 65 <= c <= 90 or 97 <= c <= 122 else 32 for c in range(256))
#: So do general, ideographic and full-width punctuation and spaces.
_BREAKS = re.compile("[\u2000-\u206f\u3000-\u303f\uff01-\uff20\uff3b-\uff40\uff5b-\uff65]+")
_LETTER = re.compile("[A-Za-z]")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(_LETTER.search(text)) or any(map(str.isalpha, text)))


def parts(word: bytes) -> list[bytes]:
    """A word in parts of MAX_WORD bytes at most, each of whole characters."""
    out, begin = [], 0
    while len(word) - begin > MAX_WORD:
        end = begin + MAX_WORD
        while end > begin + 1 and word[end] & 0xC0 == 0x80:
            end -= 1
        out.append(word[begin:end])
        begin = end
    return [*out, word[begin:]]


def letters(text: str) -> list[bytes]:
    """The lower-cased words of a text, each with a space before it as the vocabulary has them."""
    if not text.isascii():
        text = _BREAKS.sub(" ", text)
    out = []
    for w in text.lower().encode("utf-8", "surrogatepass").translate(_WORDS).split():
        w = b" " + w
        out += [w] if len(w) <= MAX_WORD else parts(w)
    return out


class Vocabulary:
    """Byte pieces of a public rank file, found by hash; every single byte is a piece, so every word has a segmentation."""

    #: Up to so many bytes every piece is tried; beyond, only where some longer piece begins with them.
    STEM = 12

    def __init__(self, path: str):
        with open(path, "rb") as f:
            pieces = {base64.b64decode(line.split()[0]) for line in f}
        # Pieces with other bytes than words have can't occur.
        inside = lambda p: not p[p[:1] == b" " :].translate(None, bytes(c for c in range(256) if _WORDS[c] != 32))
        pieces = sorted({p for p in pieces if inside(p)} | {bytes([i]) for i in range(256)})
        self.pieces = pieces
        self.size = len(pieces)
        self.longest = max(map(len, pieces))
        self.stems = np.unique(np.array([self.hash(p[: self.STEM]) for p in pieces if len(p) > self.STEM], np.uint64))
        hashes = np.array([self.hash(p) for p in pieces], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order.astype(np.int32)
        # One slot per value of the top 20 bits points at the first hash there; a few steps find the right one.
        self.first = np.searchsorted(self.hashes, np.arange(1 << 20, dtype=np.uint64) << np.uint64(44)).astype(np.int32)
        top = (self.hashes >> np.uint64(44)).astype(np.int64)
        self.steps = int(np.bincount(top).max())
        self.hashes = np.append(self.hashes, np.zeros(self.steps, np.uint64))
        self.ids = np.append(self.ids, np.full(self.steps, -1, np.int32))

    @staticmethod
    def hash(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = ((h ^ (b + 1)) * int(_BASE)) & (2**64 - 1)
            h ^= h >> 29
        return h

    def extend(self, h: np.ndarray, column: np.ndarray) -> np.ndarray:
        h = (h ^ (column.astype(np.uint64) + np.uint64(1))) * _BASE
        return h ^ (h >> np.uint64(29))

    def find(self, h: np.ndarray) -> np.ndarray:
        at = self.first[(h >> np.uint64(44)).astype(np.int64)]
        out = np.full(len(h), -1, np.int32)
        for step in range(self.steps):
            hit = self.hashes[at + step] == h
            out[hit] = self.ids[at[hit] + step]
        return out

    def lattice(self, words: np.ndarray):
        """For words of one length (rows of bytes): (begin, end, rows, pieces) of every piece in them, by end."""
        n, length = words.shape
        edges = [[] for _ in range(length + 1)]
        for begin in range(length):
            h, own = np.zeros(n, np.uint64), None
            for end in range(begin + 1, min(length, begin + self.longest) + 1):
                h = self.extend(h, words[:, end - 1] if own is None else words[own, end - 1])
                piece = self.find(h)
                rows = np.flatnonzero(piece >= 0)
                if len(rows):
                    edges[end].append((begin, rows if own is None else own[rows], piece[rows]))
                if end - begin == self.STEM:
                    own = np.flatnonzero(np.isin(h, self.stems))
                    h = h[own]
                    if not len(own):
                        break
        return edges


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def by_length(words: list[bytes], most: int = 20_000):
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for length, at in groups.items():
        step = max(1, most * 8 // length)
        for k in range(0, len(at), step):
            part = at[k : k + step]
            yield part, np.frombuffer(b"".join(words[i] for i in part), np.uint8).reshape(len(part), length)


def _ahead(edges, n: int, length: int, prob: np.ndarray) -> tuple[np.ndarray, bool]:
    """Summed probability of all segmentations up to each byte, and whether the sums (of long words) are logarithms."""
    if length <= SHORT:
        alpha = np.zeros((length + 1, n, prob.shape[1]))
        alpha[0] = 1
        for end in range(1, length + 1):
            for begin, rows, piece in edges[end]:
                alpha[end, rows] += alpha[begin, rows] * prob[piece]
        return alpha, False
    low = np.log(np.maximum(prob, 1e-300))
    alpha = np.full((length + 1, n, prob.shape[1]), -np.inf)
    alpha[0] = 0
    for end in range(1, length + 1):
        for begin, rows, piece in edges[end]:
            alpha[end, rows] = np.logaddexp(alpha[end, rows], alpha[begin, rows] + low[piece])
    return alpha, True


def forward(vocab: Vocabulary, words: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """log of the summed probability of all segmentations, per word and language; prob: pieces by languages."""
    n, length = words.shape
    alpha, logs = _ahead(vocab.lattice(words), n, length, prob)
    return alpha[length] if logs else np.log(np.maximum(alpha[length], 1e-300))


def expected(vocab: Vocabulary, words: np.ndarray, weight: np.ndarray, prob: np.ndarray, out: np.ndarray) -> None:
    """Adds the expected count of every piece, over all segmentations, for words weighted by language."""
    n, length = words.shape
    edges = vocab.lattice(words)
    alpha, logs = _ahead(edges, n, length, prob)
    low = np.log(np.maximum(prob, 1e-300)) if logs else prob
    beta = np.full_like(alpha, -np.inf if logs else 0)
    beta[length] = 0 if logs else 1
    for end in range(length, 0, -1):
        for begin, rows, piece in edges[end]:
            if logs:
                beta[begin, rows] = np.logaddexp(beta[begin, rows], low[piece] + beta[end, rows])
            else:
                beta[begin, rows] += low[piece] * beta[end, rows]
    share = None if logs else weight / np.maximum(alpha[length], 1e-300)
    for end in range(1, length + 1):
        for begin, rows, piece in edges[end]:
            if logs:
                got = np.exp(alpha[begin, rows] + low[piece] + beta[end, rows] - alpha[length, rows]) * weight[rows]
            else:
                got = alpha[begin, rows] * low[piece] * beta[end, rows] * share[rows]
            for k in range(prob.shape[1]):
                out[:, k] += np.bincount(piece, got[:, k], len(out))


class Model:
    """Per-language piece probabilities; scores words by the forward algorithm and remembers them."""

    def __init__(self, languages: list[str], prior: list[float], prob: np.ndarray, path: str):
        self.languages, self.prior, self.prob, self.path = languages, prior, prob, path
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def forget(self) -> None:
        self.young, self.old = {}, {}

    def __getstate__(self):
        return {**self.__dict__, "young": {}, "old": {}}

    def of_words(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Scores of words as bytes; those of the last words are remembered."""
        if len(self.young) > CACHE_ENTRIES:
            self.young, self.old = {}, self.young
        known, new, young, old = {}, [], self.young, self.old
        for w in words:
            s = young.get(w)
            if s is None:
                s = old.get(w)
                if s is None:
                    new.append(w)
                    continue
                young[w] = s
            known[w] = s
        vocab = vocabulary(self.path)
        for at, rows in by_length(new):
            for i, s in zip(at, forward(vocab, rows, self.prob).astype(np.float32), strict=True):
                known[new[i]] = young[new[i]] = s.tobytes()
        return known

    def score(self, texts: list[str]) -> np.ndarray:
        """Log-probability of each text's words in each language."""
        if not self.languages:
            return np.zeros((len(texts), 0))
        split = [letters(t) for t in texts]
        known = self.of_words(set().union(*split) if split else set())
        k = len(self.languages)
        out = np.zeros((len(texts), k))
        for i, words in enumerate(split):
            if words:
                rows = np.frombuffer(b"".join(map(known.__getitem__, words)), np.float32).reshape(-1, k)
                out[i] = rows.sum(axis=0, dtype=np.float64)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        lang, score = [], []
        scores = self.score([t or "" for t in texts]) + np.log(self.prior)
        for text, row in zip(texts, scores, strict=True):
            if not self.languages or not has_letter(text):
                lang.append("und")
                score.append(0.0)
                continue
            e = np.exp(row - row.max())
            lang.append(self.languages[int(row.argmax())])
            score.append(float(e.max() / e.sum()))
        return lang, score


def fit(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = MAX_TRAIN_DOCS
) -> Model:
    """Fits piece probabilities by expectation-maximisation over all segmentations, on at most about ``max_docs`` rows.

    Each language gives as many rows as the others, or all it has. Rows with null text or language don't count. A table
    without any gives a model that answers ``und``. Repeated rows count as often as they stand there.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where("text is not null and lang is not null")
    # One row per language, as many as the model has columns.
    total = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not total:
        return Model([], [], np.zeros((1, 0)), path)
    if sum(total.values()) > max_docs:
        left, share = max_docs, {}
        for i, x in enumerate(sorted(total, key=total.get)):
            share[x] = min(total[x], max(1, left // (len(total) - i)))
            left -= share[x]
        shares = few_rows(docs.sparkSession, lang=list(share), share=[int(share[x] / total[x] * (1 << 30)) for x in share])
        rows = rows.join(maybe_broadcast(shares, len(share), 64), "lang")
        rows = rows.where(F.pmod(F.xxhash64("doc_id", "text", F.lit("train")), F.lit(1 << 30)) < F.col("share"))

    def count(batches):
        for batch in batches:
            for part in slices(batch, 0):
                seen: dict[str, Counter] = {}
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    seen.setdefault(lang, Counter()).update(letters(text))
                flat = [(lang, w, n) for lang, c in seen.items() for w, n in c.items()]
                lang, word, n = zip(*flat, strict=True) if flat else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(word, pa.binary()), pa.array(n, pa.int64())], ["lang", "word", "n"])
        release()

    counts = rows.select("text", "lang").mapInArrow(count, "lang string, word binary, n long")
    counts = materialize(counts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    languages = sorted(total)
    prior = [total[x] / sum(total.values()) for x in languages]
    size, k = vocabulary(path).size, len(languages)
    index = {x: i for i, x in enumerate(languages)}
    prob = np.full((size, k), 1 / size)
    words = counts
    for _ in range(EM_ROUNDS):

        def step(batches, prob=prob):
            total, vocab = np.zeros((size, k)), vocabulary(path)
            for batch in batches:
                lang, word, n = (c.to_pylist() for c in batch.columns)
                table: dict[bytes, np.ndarray] = {}
                for x, w, c in zip(lang, word, n, strict=True):
                    table.setdefault(w, np.zeros(k))[index[x]] += c
                flat = list(table)
                for at, rows in by_length(flat, 4_000):
                    expected(vocab, rows, np.array([table[flat[i]] for i in at]), prob, total)
            piece, at = np.nonzero(total > 1e-9)
            release()
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(total[piece, at])], ["piece", "at", "n"]
            )

        # Rows of the model, bounded by vocabulary and languages.
        got = words.mapInArrow(step, "piece int, at int, n double").groupBy("piece", "at").agg(F.sum("n").alias("n")).toPandas()
        prob = np.full((size, k), 0.05)
        prob[got.piece.to_numpy(), got["at"].to_numpy()] += got.n.to_numpy()
        prob /= prob.sum(axis=0)
    return Model(languages, prior, prob, path)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (posterior probability of lang_pred) for every row, whole texts.

    A null text and one without a letter are ``und`` with score 0. Ids may be null or repeated: every row has its answer,
    the same for the same text. Of languages with equal scores the first by name is the answer. An empty table gives no
    rows. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by vocabulary and languages

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in slices(batch, 1, 1 << 20):
                lang, score = model.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang), pa.array(score)], ["doc_id", "lang_pred", "score"])
        model.forget()
        release()

    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(id_col: str = "doc_id", folds: int = 5, fold: int = 0):
    """Whether a document's fold, by crc32 of its id as text, is the one kept out of training; a null id is."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % folds == fold, F.lit(True))
