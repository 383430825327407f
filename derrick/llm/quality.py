"""Quality classifier: hierarchical empirical Bayes.

Document evidence: two logistic models (low quality, toxic) over the distinct
lower-cased words of the whole text, their beginnings, and the text's shape (shares
of capitals, symbols, digits, repeated words and word length, in steps). They are
trained on a bounded sample of labelled documents (``TRAIN`` of smallest hash)
with the features found in at least ``LEAST_DOCS`` of them whose frequency in a
class is off by ``LEAST_Z`` standard deviations (at most ``FEATURES``, largest first). A document's evidence is the probability that it
is bad in either way.

Site evidence: grouped aggregates over all documents give every host and every
path below it the sum of its documents' probabilities. The global mean is the
prior of a host, shrunk by k_host pseudo-documents, and the host's posterior is
the prior of a path, shrunk by k_path; both k come from the spread between sites
(method of moments). Sparse sites stay near the global prior. A document's
posterior log-odds are its own log-odds plus those of its path less the global
ones; it is rejected above ``REJECT``.

Defined results: null text has no evidence of its own, only the prior; a null
host or path is a site of its own; labels without a document, null labels and
repeated labels are harmless; without labelled documents of both classes the
evidence is the even 0.5 and nothing is rejected; rows that repeat an id stay
rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derrick.llm import common

TRAIN = 8_000
FEATURES = 4_000
LEAST_DOCS = 5
LEAST_Z = 6.0
BEGINNINGS = (4, 5)
STEPS = 400
REJECT = 0.5
#: largest table of site posteriors that is sent to all executors
BROADCAST_BYTES = 8 << 20

_UPPER = bytes(range(65, 91))
_LETTER = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_DIGIT = bytes(range(48, 58))
_SPACE = b" \t\n\r\x0b\x0c"


def features(text: str | None) -> list[str]:
    """Distinct words and shape steps of a text."""
    if not text:
        return []
    raw = text.encode()
    w = text.lower().split()
    n = max(1, len(raw))

    def share(chars: bytes) -> float:
        return (n - len(raw.translate(None, chars))) / n
    out = {x.strip(".,;:!?\"'()") for x in w}
    symbols = 1 - share(_LETTER) - share(_DIGIT) - share(_SPACE)
    shape = {"upper": share(_UPPER), "digit": share(_DIGIT), "symbol": symbols,
             "repeat": 1 - len(out) / max(1, len(w)), "bar": w.count("|") / max(1, len(w))}
    out.discard("")
    starts = {"\1" + x[:k] for k in BEGINNINGS for x in out if len(x) > k}
    return [*out, *starts, *(f"\0{k}{min(20, int(20 * x))}" for k, x in shape.items()),
            f"\0length{min(20, len(raw) // max(1, len(w)))}"]


def logistic(rows: list[np.ndarray], y: np.ndarray, size: int, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias over sparse binary rows (full-batch Adagrad, L2)."""
    col = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    rate = y.mean()
    w = np.zeros(size)
    gw, gb = np.full(size, 1e-8), 1e-8
    # both classes weigh alike, so the bias is set back to the base rate at the end
    weight = np.where(y == 1, 0.5 / rate, 0.5 / (1 - rate))
    b = 0.0
    for _ in range(steps):
        z = np.bincount(row, w[col], len(rows)) + b
        e = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        g = np.bincount(col, e[row], size) + 0.2 * w
        gw += g * g
        w -= 0.3 * g / np.sqrt(gw)
        gb += e.sum() ** 2
        b -= 0.3 * e.sum() / math.sqrt(gb)
    return w, b + math.log(rate / (1 - rate))


def fit(docs: DataFrame, labels: DataFrame, sample: int = TRAIN) -> dict:
    """{feature: (low-quality weight, toxic weight)} and the biases under ''."""
    lab = (labels.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"),
                                                     F.col("quality").cast("int").alias("quality"),
                                                     F.col("toxic").cast("int").alias("toxic"))
           .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
           .where("quality is not null and toxic is not null")
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # at most `sample` rows of 16 bytes are broadcast; one row per id, as copies weigh nothing extra
    rows = common.shared_table(common.documents(docs).where("text is not null").join(F.broadcast(lab), "doc_id")
                               .select("text", "quality", "toxic").dropDuplicates(["text"]))
    n, low, toxic = rows.agg(F.count(F.lit(1)), F.count_if(F.expr("quality = 0")), F.count_if(F.expr("toxic = 1"))).first()
    heads = [h for h, k in (("low", low), ("tox", toxic)) if 0 < k < n]
    if not heads:
        return {}

    def counts(batches):
        seen: dict[str, list[int]] = {}
        for b in batches:
            for t, q, x in zip(*(b.column(c).to_pylist() for c in ("text", "quality", "toxic"))):
                for f in features(t):
                    k = seen.setdefault(f, [0, 0, 0])
                    k[0] += 1
                    k[1] += q == 0
                    k[2] += x == 1
        cols = list(zip(*seen.values())) if seen else [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())]
                                         + [pa.array(c, pa.int64()) for c in cols], names=["f", "n", "low", "tox"])
    total = {"low": low, "tox": toxic}
    tells = None
    share = F.col("n") / n
    for h in heads:
        gap = F.abs(F.col(h) - total[h] * share) / F.sqrt(total[h] * share * (1 - share) + 1e-9)
        tells = gap if tells is None else F.greatest(tells, gap)
    telling = (rows.mapInArrow(counts, "f string, n long, low long, tox long").groupBy("f")
               .agg(*[F.sum(c).alias(c) for c in ("n", "low", "tox")])
               .where((F.col("n") >= LEAST_DOCS) & (tells >= LEAST_Z)).select("f", tells.alias("gap"))
               .orderBy(F.desc("gap"), "f").limit(FEATURES))
    place = {r["f"]: i for i, r in enumerate(telling.collect())}

    def numbers(batches):
        for b in batches:
            found = [sorted(place[x] for x in features(t) if x in place) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("quality"), b.column("toxic"),
                                              pa.array(found, pa.list_(pa.int32()))],
                                             names=["quality", "toxic", "f"])
    got = rows.mapInArrow(numbers, "quality int, toxic int, f array<int>").collect()
    cols = [np.array(r["f"], np.int64) for r in got]
    truth = {"low": np.array([r["quality"] == 0 for r in got], float),
             "tox": np.array([r["toxic"] == 1 for r in got], float)}
    fitted = [logistic(cols, truth[h], len(place)) for h in heads]
    model = {x: tuple(float(h[0][i]) for h in fitted) for x, i in place.items()}
    model[""] = tuple(float(h[1]) for h in fitted)
    return model


def evidence(text: str | None, model: dict) -> float | None:
    """Probability that the text is bad; None without text or model."""
    if not text or not model:
        return None
    z = list(model[""])
    for x in features(text):
        w = model.get(x)
        if w is not None:
            for k, v in enumerate(w):
                z[k] += v
    good = 1.0
    for v in z:
        good *= 1 - 1 / (1 + math.exp(-max(-30.0, min(30.0, v))))
    return min(max(1 - good, 1e-6), 1 - 1e-6)


def with_evidence(docs: DataFrame, model: dict, name: str) -> DataFrame:
    """All columns of ``docs`` plus the evidence as column ``name``."""
    spark = docs.sparkSession
    common.ship_package(spark)
    held = spark.sparkContext.broadcast(model)
    where = docs.columns.index("text")

    def run(batches):
        for b in batches:
            p = [evidence(t, held.value) for t in b.column(where).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p, pa.float64())],
                                             names=[*b.schema.names, name])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def _spread(sites: DataFrame, total: str, prior: Column | float, n: str = "n") -> float:
    """Pseudo-documents k from the spread of site means around their prior."""
    r = sites.where(F.col(n) > 1).agg(
        F.sum(F.col(n) * F.pow(F.col(total) / F.col(n) - prior, F.lit(2.0))).alias("v"),
        F.sum(n).alias("n"), F.count(F.lit(1)).alias("s"),
        F.sum(F.col("v")).alias("within")).first()
    if not r["s"] or not r["n"]:
        return 1000.0
    within = max(r["within"] / r["n"], 1e-9)
    between = (r["v"] - r["s"] * within) / r["n"]
    return float(min(max(within / between, 1.0), 1e6)) if between > 0 else 1e6


def judge(docs: DataFrame, labels: DataFrame, host: Column, path: Column, name: str = "_quality",
          reject: float = REJECT) -> DataFrame:
    """``docs`` with a struct column ``name``: evidence, posterior (probability of a
    bad document) and rejected; ``host`` and ``path`` are columns of ``docs``."""
    model = fit(docs, labels)
    h, p, e, s = (common.free_name(docs, c) for c in ("_host", "_path", "_evidence", "_site"))
    sums = with_evidence(docs.select("text", host.alias("_host"), path.alias("_path")), model, "_evidence")
    sums = common.shared_table(
        sums.where("_evidence is not null").groupBy("_host", "_path")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_evidence").alias("p"),
             (F.sum(F.pow("_evidence", F.lit(2.0))) - F.pow(F.sum("_evidence"), F.lit(2.0)) / F.count(F.lit(1)))
             .alias("v")))
    whole = sums.agg(F.sum("p").alias("p"), F.sum("n").alias("n"), F.sum(
        32 + F.coalesce(F.octet_length(F.concat_ws("", "_host", "_path")), F.lit(0))).alias("bytes")).first()
    mean = min(max(whole["p"] / whole["n"], 1e-6), 1 - 1e-6) if whole["n"] else 0.5
    hosts = sums.groupBy("_host").agg(F.sum("p").alias("hp"), F.sum("n").alias("n"), F.sum("v").alias("v"))
    k_host = _spread(hosts, "hp", F.lit(mean))
    hosts = hosts.select("_host", ((F.col("hp") + k_host * mean) / (F.col("n") + k_host)).alias("host_mean"))
    paths = common.null_safe(sums, hosts, ["_host"], "inner")
    k_path = _spread(paths, "p", F.col("host_mean"))
    paths = paths.select(F.col("_host").alias(h), F.col("_path").alias(p),
                         ((F.col("p") + k_path * F.col("host_mean")) / (F.col("n") + k_path)).alias(s))
    if (whole["bytes"] or 0) <= BROADCAST_BYTES:      # beyond that the join shuffles
        paths = F.broadcast(paths)
    judged = with_evidence(docs.withColumn(h, host).withColumn(p, path), model, e)
    out = common.null_safe(judged, paths, [h, p], "left")
    prior = F.coalesce(F.least(F.greatest(F.col(s), F.lit(1e-6)), F.lit(1 - 1e-6)), F.lit(mean))
    own = F.coalesce(F.col(e), F.lit(mean))

    def odds(c):
        return F.log(c / (1 - c))
    posterior = 1 / (1 + F.exp(-(odds(own) + odds(prior) - odds(F.lit(mean)))))
    return out.withColumn(name, F.struct(
        F.col(e).alias("evidence"), posterior.alias("posterior"),
        ((posterior > reject) & F.lit(bool(model))).alias("rejected"))).drop(h, p, e, s)


def site(docs: DataFrame) -> tuple[Column, Column]:
    """Host and path columns of ``documents``: its source, and the language below it."""
    return docs["source"].cast("string"), F.concat_ws("/", docs["source"], F.coalesce(docs["lang"], F.lit("")))
