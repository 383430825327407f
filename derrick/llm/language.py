"""Language identification of words and documents by a linear-chain CRF.

Words are runs of letters; a chain is a line's words, cut every ``CHAIN`` words.
A word's features are its beginnings and endings (1 to 3 letters), its character
2- and 3-grams with the word's edges, the lower-cased word itself, and for every
language whether the word is in that language's lexicon (its most frequent
training words). Hashed feature weights give a score per language, a learned
matrix scores transitions, and forward-backward gives every word's posterior, so a
text may switch languages. A document's posterior is the mean over its words.

Trained by likelihood (Adagrad on chains) from ``TRAIN`` labelled documents of
smallest hash, evenly over the languages, ``TRAIN_WORDS`` words of each.

Defined results: ``und`` with score 0 where the text is null or has no letter, or
nothing was learned; a null id is not held out and never trained on; ties go to
the first language in order; rows that repeat an id stay rows; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from derrick.llm import common

TRAIN = 2_000
TRAIN_WORDS = 120
LEXICON = 400
CHAIN = 128
DIM = 1 << 16
EPOCHS = 6
CACHE = 200_000

_WORD = re.compile(r"[^\W\d_]+")


def chains(text: str, limit: int | None = None) -> list[list[str]]:
    out, n = [], 0
    for line in text.lower().split("\n"):
        w = _WORD.findall(line)
        for a in range(0, len(w), CHAIN):
            out.append(w[a:a + CHAIN])
        n += len(w)
        if limit and n >= limit:
            break
    return out


class Crf:
    """Feature weights (DIM + one lexicon row per language, languages) and transition scores."""

    def __init__(self, langs: list[str], lexicon: dict[str, list[int]]):
        self.langs, self.lexicon = langs, lexicon
        n = len(langs)
        self.w = np.zeros((DIM + n, n), np.float32)
        self.a = np.zeros((n, n), np.float32)
        self.cache: dict[str, int] = {}
        self.scores = np.zeros((1024, n), np.float32)

    def features(self, word: str) -> list[int]:
        w = f"<{word[:40]}>"
        parts = [w, *("^" + word[:k] for k in (1, 2, 3)), *("$" + word[-k:] for k in (1, 2, 3))]
        parts += [w[i:i + 2] for i in range(len(w) - 1)] + [w[i:i + 3] for i in range(len(w) - 2)]
        return [zlib.crc32(p.encode()) % DIM for p in parts] + [DIM + k for k in self.lexicon.get(word, ())]

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores of words, through a cache that stops growing at CACHE entries."""
        new = list({w for w in words if w not in self.cache})
        extra: dict[str, int] = {}
        if new:
            f = [self.features(w) for w in new]
            size = np.array([len(x) for x in f])
            flat = self.w[np.concatenate([np.array(x) for x in f])]
            e = np.add.reduceat(flat, np.cumsum(size) - size, axis=0)
            room = max(0, CACHE - len(self.cache))
            base = len(self.cache)
            need = base + len(new)
            if need > len(self.scores):
                self.scores = np.concatenate([self.scores, np.zeros((max(need, len(self.scores)), len(self.langs)),
                                                                    np.float32)])
            self.scores[base:need] = e
            for i, w in enumerate(new):
                (self.cache if i < room else extra)[w] = base + i
        if extra:
            return self.scores[[self.cache[w] if w in self.cache else extra[w] for w in words]]
        return self.scores[[self.cache[w] for w in words]]

    def posteriors(self, e: np.ndarray, length: np.ndarray, pairs: bool = False):
        """Forward-backward over chains of like length; e is (chains, steps,
        languages). Returns posteriors, and with ``pairs`` the summed posteriors of
        neighbouring labels."""
        b, t, n = e.shape
        e = np.exp(e - e.max(axis=2, keepdims=True))
        a = np.exp(self.a - self.a.max())
        f = np.empty_like(e)
        f[:, 0] = e[:, 0]
        f[:, 0] /= f[:, 0].sum(axis=1, keepdims=True)
        for i in range(1, t):
            x = (f[:, i - 1] @ a) * e[:, i]
            f[:, i] = x / x.sum(axis=1, keepdims=True)
        back = np.ones((b, n), e.dtype)
        post = np.empty_like(e)
        both = np.zeros((n, n))
        for i in range(t - 1, -1, -1):
            p = f[:, i] * back
            post[:, i] = p / p.sum(axis=1, keepdims=True)
            if i:
                eb = e[:, i] * back
                if pairs:
                    live = length > i
                    x = f[live, i - 1][:, :, None] * a[None] * eb[live][:, None, :]
                    both += (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                y = eb @ a.T
                back = np.where((length > i)[:, None], y / y.sum(axis=1, keepdims=True), 1.0).astype(e.dtype)
        return (post, both) if pairs else post


def train(rows: list[tuple[str, str]]) -> Crf | None:
    """CRF from (language, text) pairs."""
    langs = sorted({lang for lang, _ in rows})
    if not langs:
        return None
    place = {x: i for i, x in enumerate(langs)}
    data, count = [], [dict() for _ in langs]
    for lang, text in rows:
        left = TRAIN_WORDS
        for c in chains(text, TRAIN_WORDS):
            c = c[:left]
            left -= len(c)
            if c:
                data.append((place[lang], c))
                for w in c:
                    count[place[lang]][w] = count[place[lang]].get(w, 0) + 1
    lexicon: dict[str, list[int]] = {}
    for k, seen in enumerate(count):
        for w in sorted(seen, key=lambda x: (-seen[x], x))[:LEXICON]:
            lexicon.setdefault(w, []).append(k)
    m = Crf(langs, lexicon)
    n = len(langs)
    if n == 1 or not data:
        return m
    gw, ga = np.full(m.w.shape, 1e-6, np.float32), np.full((n, n), 1e-6, np.float32)
    made: dict[str, list[int]] = {}
    order = np.random.default_rng(5)
    data.sort(key=lambda d: len(d[1]))
    blocks = [data[i:i + 64] for i in range(0, len(data), 64)]
    for _ in range(EPOCHS):
        for k in order.permutation(len(blocks)):
            part = blocks[k]
            length = np.array([len(c) for _, c in part])
            t = int(length.max())
            for _, c in part:
                for w in c:
                    if w not in made:
                        made[w] = m.features(w)
            feats = [made[w] for _, c in part for w in c]
            size = np.array([len(x) for x in feats])
            flat = np.concatenate([np.array(x) for x in feats])
            step = np.arange(t)[None] < length[:, None]
            e = np.zeros((len(part), t, n), np.float32)
            e[step] = np.add.reduceat(m.w[flat], np.cumsum(size) - size, axis=0)
            post, both = m.posteriors(e, length, True)
            y = np.array([d[0] for d in part])
            g = post
            g[np.arange(len(part)), :, y] -= 1
            g = np.repeat(g[step], size, axis=0) / len(part)
            gradient = np.stack([np.bincount(flat, g[:, j], len(m.w)) for j in range(n)], axis=1)
            gw += gradient ** 2
            m.w -= (0.2 * gradient / np.sqrt(gw)).astype(np.float32)
            truth = np.zeros((n, n))
            np.add.at(truth, (y, y), np.maximum(length - 1, 0))
            d = (both - truth) / len(part) + 0.001 * m.a
            ga += d ** 2
            m.a -= (0.1 * d / np.sqrt(ga)).astype(np.float32)
    return m


def predict(texts: list[str | None], m: Crf | None) -> list[tuple[str, float, int, int]]:
    """(language, score, words, words of other languages) per text."""
    out: list[tuple[str, float, int, int]] = [("und", 0.0, 0, 0)] * len(texts)
    if m is None:
        return out
    owner, parts = [], []
    for i, t in enumerate(texts):
        for c in chains(t) if t else ():
            owner.append(i)
            parts.append(c)
    if not parts:
        return out
    n = len(m.langs)
    size = np.array([len(c) for c in parts])
    e = m.emissions([w for c in parts for w in c])
    at = np.cumsum(size) - size
    mass, votes = np.zeros((len(texts), n)), np.zeros((len(texts), n), np.int64)
    own = np.array(owner)
    order = np.argsort(size, kind="stable")
    a = 0
    while a < len(order):
        z = a
        # like lengths together, at most 20,000 words of padding-free work
        while z < len(order) and z - a < 2048 and size[order[z]] <= 1.25 * size[order[a]] + 2:
            z += 1
        rows = order[a:z]
        t = int(size[rows].max())
        live = np.arange(t)[None] < size[rows][:, None]
        x = np.zeros((len(rows), t, n), np.float32)
        x[live] = e[(at[rows][:, None] + np.arange(t)[None])[live]]
        p = m.posteriors(x, size[rows])[live]
        who = np.repeat(own[rows], size[rows])
        best = p.argmax(axis=1)
        for k in range(n):
            mass[:, k] += np.bincount(who, p[:, k], len(texts))
            votes[:, k] += np.bincount(who[best == k], minlength=len(texts))
        a = z
    total = votes.sum(axis=1)
    for i in np.flatnonzero(total):
        k = int(mass[i].argmax())
        out[i] = (m.langs[k], float(min(1.0, max(0.0, mass[i, k] / total[i]))), int(total[i]),
                  int(total[i] - votes[i, k]))
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, sample: int = TRAIN) -> Crf | None:
    """Train on a bounded sample of labelled documents that are not held out."""
    d = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
                   & ~held_out(F.col("doc_id")))
    n = d.select("lang").distinct().count()
    w = Window.partitionBy("lang").orderBy("o", "doc_id")
    rows = (d.select("doc_id", "lang", F.substring("text", 1, 40 * TRAIN_WORDS).alias("t"),
                     F.xxhash64("doc_id").alias("o"))
            .withColumn("k", F.row_number().over(w)).where(F.col("k") <= math.ceil(sample / max(n, 1)))
            .orderBy("lang", "k").collect())
    return train([(r["lang"], r["t"]) for r in rows])


def identify(docs: DataFrame, sample: int = TRAIN) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, n_words, n_other (words
    labelled with another language)."""
    d = common.documents(docs)
    model = docs.sparkSession.sparkContext.broadcast(
        fit(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text"), sample))

    def run(batches):
        m = model.value
        for b in batches:
            got, texts = [], b.column("text").to_pylist()
            for a in range(0, len(texts), 500):
                got += predict(texts[a:a + 500], m)
            cols = list(zip(*got)) if got else [()] * 4
            types = [pa.string(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id")] + [pa.array(c, t) for c, t in zip(cols, types)],
                names=["doc_id", "lang_pred", "score", "n_words", "n_other"])
    out = d.select("doc_id", "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, n_words long, n_other long")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
                      "n_words", "n_other")
