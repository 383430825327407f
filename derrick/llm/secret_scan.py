"""Secret scan: fixed patterns plus character Markov models.

Base spans are leftmost non-overlapping matches per kind (assign, access, hex).
The method adds ``model`` spans: tokens of ``MODEL_CHARS`` or more key characters
that no base span touches, whose likelihood under a character Markov model of
random strings exceeds that under a model of ordinary identifiers by
``THRESHOLD`` (natural log) per character.

Both models are order-1 over the key characters with add-one smoothing, trained
from labelled samples: values and runs of base matches are random strings, other
tokens of ``LEAST_CHARS`` characters are ordinary identifiers, taken from a
bounded sample of documents (``SAMPLE`` of smallest hash among those with a
pattern's hint, ``SAMPLE`` of smallest hash of all). Without one class there is
no model and no model span.

Defined results: null text is an empty document without spans; rows that repeat
an id stay rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.llm import common

KINDS = ["assign", "access", "hex", "model"]
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS, MODEL_CHARS, LEAST_CHARS = 6, 20, 24, 20, 6
SAMPLE = 2_000
THRESHOLD = 0.5

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                     r"""([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_HINT = re.compile(r"(?:passw(?:or)?d|secret|token|api_?key)[\"' :=]", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_CHARS)
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MODEL_CHARS)
_ORDINARY = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_CHARS)
_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_PLACE = np.zeros(128, np.int64)
_PLACE[[ord(c) for c in _CHARS]] = np.arange(len(_CHARS))


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) by start, then kind as listed."""
    out = []
    if _HINT.search(text):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text)
                if len(m.group(2)) >= ASSIGN_CHARS]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)
                if m.end() - m.start() >= ACCESS_CHARS]
    # a run of the least length lies over one of every HEX_CHARS-th characters
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return [(a, KINDS[k], e) for a, k, e in sorted(out)]


def codes(token: str) -> np.ndarray:
    return _PLACE[np.frombuffer(token.encode("ascii"), np.uint8)]


def train(tokens: list[str]) -> np.ndarray:
    """Log transition matrix; row n holds the first character."""
    n = len(_CHARS)
    count = np.ones((n + 1, n))
    for t in tokens:
        c = codes(t)
        if len(c):
            np.add.at(count, (np.concatenate([[n], c[:-1]]), c), 1)
    return np.log(count / count.sum(axis=1, keepdims=True))


def ratio(token: str, random: np.ndarray, ordinary: np.ndarray) -> float:
    """Log-likelihood ratio per character."""
    c = codes(token)
    before = np.concatenate([[len(_CHARS)], c[:-1]])
    return float((random[before, c] - ordinary[before, c]).mean())


def labelled(texts: list[str]) -> tuple[list[str], list[str]]:
    """Random strings and ordinary identifiers of the sample."""
    yes, no = [], []
    for t in texts:
        spans = base_spans(t)
        for a, kind, e in spans:
            value = _ASSIGN.match(t, a).group(2) if kind == "assign" else t[a:e]
            value = value.replace(".", "")
            if len(value) >= MODEL_CHARS:
                yes.append(value)
        for m in _ORDINARY.finditer(t):
            if not any(a < m.end() and m.start() < e for a, _, e in spans):
                no.append(m.group())
    return yes, no


def fit(docs: DataFrame, sample: int = SAMPLE):
    """The two models, or None."""
    d = docs.where("text is not null").select("text", F.xxhash64("doc_id", "text").alias("o"))
    hint = d.where(r"text rlike '(?i)(passw(or)?d|secret|token|api_?key)[\"\' :=]' or text rlike '[0-9a-f]{24}'")
    texts = []
    for part in (hint, d):
        texts += [r[0] for r in common.smallest(part, "o", sample).select(
            F.substring("text", 1, 20_000)).collect()]
    yes, no = labelled(texts)
    return (train(yes), train(no)) if yes and no else None


def scan(docs: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans (text),
    n_model."""
    d = common.documents(docs).select("doc_id", "text")
    models = fit(d, sample)

    def run(batches):
        for b in batches:
            out = []
            for t in b.column("text").to_pylist():
                base = base_spans(t) if t else []
                more = []
                if models and t:
                    for m in _TOKEN.finditer(t):
                        a, e = m.span()
                        if not any(x < e and a < y for x, _, y in base) \
                                and ratio(m.group(), *models) > threshold:
                            more.append((a, "model", e))
                kinds = [k for _, k, _ in base]
                line = ",".join(f"{k}:{a}:{e}" for a, k, e in base)
                every = sorted(base + more, key=lambda s: (s[0], KINDS.index(s[1])))
                out.append((kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
                            hashlib.sha256(line.encode()).hexdigest(),
                            ",".join(f"{k}:{a}:{e}" for a, k, e in every), len(more)))
            cols = list(zip(*out)) if out else [()] * 6
            types = [pa.int64()] * 3 + [pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id")] + [pa.array(c, t) for c, t in zip(cols, types)],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_model"])
    return d.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
                        "spans string, n_model long")
