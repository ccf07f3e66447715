"""Scores of abusive, hateful or sexually explicit language.

Dense features of a text (lexicon densities, proximity of hits to a second
person, capitals, punctuation and obfuscation rates, of the text and of its
most suspicious sentence) go through gradient-boosted trees with isotonic
calibration on out-of-fold scores. Beside the general lists of ``lexicon``
there is a learned lexicon: the log-odds of the words of labelled texts. A
labelled text's own features are made from the words of the other folds.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import release, stage
from . import lexicon
from .boosting import Trees, calibrated, isotonic

#: At most so many labelled documents train the model (the smallest by hash),
#: and at most so many of their words, the most frequent, have log-odds.
TRAIN_ROWS, VOCABULARY = 20_000, 50_000
#: A word needs so many labelled texts; texts are dealt to so many folds.
LEAST, FOLDS = 3, 4
GROUPS = ("insult", "profane", "demean", "threat", "sexual", "second", "person")
_BAD = 0b11111
_SECOND, _PERSON = 1 << 5, 1 << 6
#: Fixed value: characters used in place of letters.
_LEET = str.maketrans({"@": "a", "4": "a", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t", "+": "t"})
_TOKEN = re.compile(r"[\wऀ-ॣ०-ॿ@$*!#+-]*[\wऀ-ॣ०-ॿ*#$@]|[\w]", re.U)
_SENTENCE = re.compile(r"(?<=[.!?।])\s+|\n+")
_SPACED = re.compile(r"(?<!\w)(?:\w[ .\-_*]){2,}\w(?!\w)")
_REPEAT = re.compile(r"(.)\1{2,}")
_GROUPS_OF = [[g for g in range(len(GROUPS)) if b >> g & 1] for b in range(1 << len(GROUPS))]
_LISTS = (lexicon.INSULT, lexicon.PROFANE, lexicon.DEMEAN, lexicon.THREAT, lexicon.SEXUAL, lexicon.SECOND, lexicon.PERSON)
_LEXICON = {w: sum(1 << g for g, words in enumerate(_LISTS) if w in words) for w in {w for words in _LISTS for w in words}}


def sentences_of(text: str) -> tuple[list[str], list[list[str]]]:
    """Sentences and their tokens."""
    text = unicodedata.normalize("NFC", text.replace("﻿", " "))
    parts = [s for s in _SENTENCE.split(text) if s]
    return parts, [_TOKEN.findall(s) for s in parts]


class Words:
    """What is known of a token: (lexicon groups as bits, 1 if it had to be
    undone first, learned log-odds). Spellings are looked up once."""

    def __init__(self, learned: dict[str, float] | None = None, groups: dict[str, int] | None = None):
        self.learned, self.groups = learned or {}, _LEXICON if groups is None else groups
        self.known: dict[str, tuple[int, int, float] | None] = {}
        self.shapes: dict[tuple[int, str], list[str]] = {}
        for w, bits in self.groups.items():
            if bits & _BAD and len(w) > 2:
                self.shapes.setdefault((len(w), w[0]), []).append(w)

    def __getstate__(self) -> tuple:
        return self.learned, self.groups

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def _one(self, low: str) -> tuple[int, float] | None:
        bits, w = self.groups.get(low), self.learned.get(low)
        return None if bits is None and w is None else (bits or 0, w or 0.0)

    def _look(self, token: str) -> tuple[int, int, float]:
        low = token.lower()
        hit = self._one(low)
        if hit:
            return hit[0], 0, hit[1]
        tries = []
        if low.isalpha():
            if _REPEAT.search(low):
                tries = [_REPEAT.sub(r"\1", low), _REPEAT.sub(r"\1\1", low)]
        elif "*" in low or "#" in low:
            shape = re.compile("".join("." if c in "*#" else re.escape(c) for c in low) + "$")
            tries = [w for w in self.shapes.get((len(low), low[0]), ()) if shape.match(w)][:1]
        elif not (low[0].isdigit() and low[-1].isdigit()):
            undone = _REPEAT.sub(r"\1", low.translate(_LEET))
            tries = [undone, re.sub(r"[^\w]", "", undone)]
        for t in tries:
            hit = self._one(t)
            if hit and (hit[0] & _BAD or hit[1] > 1):
                return hit[0], 1, hit[1]
        if "-" in low:
            found = [h for h in map(self._one, low.split("-")) if h]
            if found:
                bits = 0
                for b, _ in found:
                    bits |= b
                return bits, 0, max((w for _, w in found), key=abs)
        return 0, 0, 0.0

    def look(self, token: str) -> tuple[int, int, float] | None:
        """What is known of a token; None where nothing is."""
        hit = self._look(token)
        return hit if hit[0] or hit[2] else None

    def of(self, tokens: list[str]) -> list[tuple[int, tuple[int, int, float]]]:
        """(place, what is known) of the tokens of which something is known."""
        known = self.known
        for t in tokens:
            if t not in known:
                if len(known) >= 1 << 17:
                    known.clear()
                    return self.of(tokens) if len(tokens) < 1 << 16 else [(i, h) for i, h in enumerate(map(self.look, tokens)) if h]
                known[t] = self.look(t)
        return [(i, h) for i, h in enumerate(map(known.__getitem__, tokens)) if h]

    def join_spaced(self, text: str) -> tuple[str, int]:
        """Words written letter by letter, joined where the list has them."""
        n = 0

        def undo(m: re.Match) -> str:
            nonlocal n
            word = re.sub(r"[ .\-_*]", "", m.group())
            # A word of one letter may stand before or after.
            for lo, hi in ((0, 0), (1, 0), (0, 1), (1, 1)):
                own = word[lo : len(word) - hi]
                if self.groups.get(own.lower(), 0) & _BAD:
                    n += 1
                    return f"{word[:lo]} {own} {word[len(word) - hi :]}".strip()
            return m.group()

        return _SPACED.sub(undo, text), n


N_FEATURES = 40


def nearest(left: list[int], right: list[int]) -> int:
    """Least distance above 0 of two sorted lists of places; 99 for none."""
    if not left or not right:
        return 99
    a, b = np.array(left), np.array([-99, *right, left[-1] + 99])
    at = np.searchsorted(b, a)
    after = b[np.minimum(at + (b[at] == a), len(b) - 1)] - a
    return int(min(99, after.min(), (a - b[at - 1]).min()))


def features(text: str | None, words: Words) -> np.ndarray:
    """The dense features of one text; all 0 for null and blank texts."""
    out = np.zeros(N_FEATURES)
    if not text or not text.strip():
        return out
    text, undone = words.join_spaced(text)
    parts, tokenised = sentences_of(text)
    total, count, weight_sum = [0] * len(GROUPS), 0, 0.0
    best, tops = None, []
    for sentence, tokens in zip(parts, tokenised):
        count += len(tokens)
        found = words.of(tokens)
        if not found:
            continue
        weights = sorted(h[2] for _, h in found if h[2])
        whole = sum(weights)
        weight_sum += whole
        top = sum(weights[-3:])
        tops.append(top)
        n = [0] * len(GROUPS)
        odd = 0
        for _, (b, o, _) in found:
            if b:
                for g in _GROUPS_OF[b]:
                    n[g] += 1
                if o and b & _BAD:
                    odd += 1
        for g, k in enumerate(n):
            total[g] += k
        undone += odd
        suspicion = top + 1.5 * sum(n[:5]) + odd
        if best is None or suspicion > best[0]:
            best = (suspicion, sentence, tokens, found, n, odd, weights, whole)
    count = max(count, 1)
    out[:7] = np.array(total) / count * 100
    out[7] = undone
    out[8] = sum(map(str.isupper, text)) / max(1, sum(map(str.isalpha, text)))
    out[9] = sum(map(text.count, "!?*#")) / len(text) * 100
    out[10] = np.log1p(count)
    out[11:16] = np.minimum(total[:5], 5)
    tops.sort()
    out[16] = weight_sum / count
    out[17:19] = [tops[-1] if tops else 0.0, tops[-2] if len(tops) > 1 else 0.0]
    out[19] = np.median(tops) if tops else 0.0
    if best is not None:
        suspicion, sentence, tokens, found, n, odd, weights, whole = best
        hits = [i for i, (b, _, w) in found if b & _BAD or w > 1.5]
        second = [i for i, (b, _, _) in found if b & _SECOND]
        person = [i for i, (b, _, _) in found if b & _PERSON]
        near, to_person = nearest(hits, second), nearest(hits, person)
        upper = sum(map(str.isupper, sentence)) / max(1, sum(map(str.isalpha, sentence)))
        marks = sum(map(sentence.count, "!?*#"))
        out[20] = suspicion
        out[21:40] = [*n, near, to_person, len(tokens), upper, marks, odd, len(hits) / max(1, len(tokens)), weights and sum(weights[-3:]) or 0.0, sum(weights[:3]), whole / len(tokens), weights[-1] if weights else 0.0, len(found)]
    else:
        out[28] = out[29] = 99
    return out


class Model:
    """Words, trees and calibration."""

    def __init__(self, words: Words, trees: Trees, steps: tuple[np.ndarray, np.ndarray]):
        self.words, self.trees, self.steps = words, trees, steps

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = np.stack([features(t, self.words) for t in texts]) if texts else np.zeros((0, N_FEATURES))
        return calibrated(self.trees.margin(x), self.steps)


def log_odds(counts: dict[str, np.ndarray], size: np.ndarray, without: int | None = None) -> dict[str, float]:
    """Learned words: counts[word] and size are (folds, 2) numbers of texts
    with label 0 and 1; one fold may be left out."""
    keep = [f for f in range(len(size)) if f != without]
    n0, n1 = size[keep].sum(axis=0)
    if n0 < 1 or n1 < 1:
        return {}
    out = {}
    for w, c in counts.items():
        c0, c1 = c[keep].sum(axis=0)
        if c0 + c1 >= LEAST:
            # Shrunk towards 0: one text more on each side in the whole's proportion.
            k = 2.0
            p1, p0 = (c1 + k * n1 / (n0 + n1)) / n1, (c0 + k * n0 / (n0 + n1)) / n0
            v = float(np.clip(np.log(p1 / p0), -4, 4))
            if abs(v) > 0.4:
                out[w] = v
    return out


def learned_words(chosen: DataFrame) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """(counts, size) for ``log_odds`` from labelled texts (text, y, fold):
    counted on the executors; at most VOCABULARY words come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(w, y, f) for text, y, f in zip(*[c.to_pylist() for c in b.columns]) for w in {t.lower() for tokens in sentences_of(text)[1] for t in tokens} if len(w) <= 32]
            cols = list(zip(*rows)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int32(), pa.int32()))], names=["w", "y", "f"])

    cells = [F.count_if((F.col("f") == f) & (F.col("y") == y)).alias(f"c{f}{y}") for f in range(FOLDS) for y in (0, 1)]
    words = chosen.select("text", "y", "fold").mapInArrow(run, "w string, y int, f int").groupBy("w").agg(F.count("*").alias("n"), *cells)
    got = words.filter(F.col("n") >= LEAST).orderBy(F.desc("n"), "w").limit(VOCABULARY).collect()
    counts = {r[0]: np.array(r[2:], float).reshape(FOLDS, 2) for r in got}
    size = np.zeros((FOLDS, 2))
    for f, y, n in chosen.groupBy("fold", "y").count().collect():
        size[f, y] = n
    return counts, size


def train(x: np.ndarray, labels: np.ndarray, fold: np.ndarray, words: Words) -> Model:
    """Fits trees on the features of labelled texts (made from the words of
    other folds) and of the written examples; calibrates on the out-of-fold
    margins. ``words`` are those of the scores."""
    own = [v for _, v in lexicon.EXAMPLES]
    x = np.concatenate([x.reshape(-1, N_FEATURES), np.stack([features(t, Words(None, words.groups)) for t, _ in lexicon.EXAMPLES])])
    y = np.concatenate([labels, own]).astype(float)
    fold = np.concatenate([fold, np.arange(len(own)) % FOLDS])
    margin = np.zeros(len(y))
    for k in range(FOLDS):
        margin[fold == k] = Trees().fit(x[fold != k], y[fold != k]).margin(x[fold == k])
    return Model(words, Trees().fit(x, y), isotonic(margin, y))


def labelled(documents: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, text, y, fold) of labelled texts: a document's label is the
    mean of its labels that aren't null, without ties; at most ``limit``
    documents by hash."""
    each = labels.filter(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.avg("toxic").alias("m")).filter("m <> 0.5")
    chosen = each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = documents.select("text", "doc_id").filter("text IS NOT NULL").join(chosen, "doc_id")
    return rows.select("doc_id", "text", (F.col("m") > 0.5).cast("int").alias("y"), F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(FOLDS)).cast("int").alias("fold"))


def labelled_features(chosen: DataFrame, by_fold: list[Words]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, labels, folds), in order of doc_id; the features are made on
    the executors, and only they come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t, by_fold[f]).tolist() for t, f in zip(b.column(0).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "y", "fold", "x"])

    got = sorted(tuple(r) for r in chosen.select("text", "doc_id", "y", "fold").mapInArrow(run, "doc_id bigint, y int, fold int, x array<double>").collect())
    return np.array([r[3] for r in got]).reshape(-1, N_FEATURES), np.array([r[1] for r in got], float), np.array([r[2] for r in got], int)


def fit(documents: DataFrame, labels: DataFrame, groups: dict[str, int] | None = None, limit: int = TRAIN_ROWS) -> Model:
    """The model of a corpus and its labels; ``groups`` replaces the lists."""
    chosen = stage(labelled(documents, labels, limit), "abuse")
    counts, size = learned_words(chosen)
    x, y, fold = labelled_features(chosen, [Words(log_odds(counts, size, f), groups) for f in range(FOLDS)])
    release(chosen)
    return train(x, y, fold, Words(log_odds(counts, size), groups))


def score_documents(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, kept columns, score): null and blank texts score 0. Narrow."""
    cols = [key, *keep]
    schema = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in cols) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                batch = whole.slice(lo, 500)
                texts = batch.column(0).to_pylist()
                blank = np.array([not t or not t.strip() for t in texts], bool)
                score = np.where(blank, 0.0, model.score(texts))
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(score)], names=[*cols, "score"])

    return documents.select(F.col(text).alias("_text"), *cols).mapInArrow(run, schema)
