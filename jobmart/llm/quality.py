"""Quality and toxicity of whole texts: hashed n-gram logistic regression with calibrated odds.

Features are the presence of hashed word unigrams and bigrams (A-Z in lower case) and of
character n-grams inside words with their borders (case kept). Two models, for low quality and for
toxicity, are fitted on a bounded sample of labelled rows and calibrated (a logistic curve over the
score) by scores of rows held out. Scoring is a sum of weights per text in Arrow batches
against fixed thresholds.

The sample: the ``sample`` labelled rows with the smallest hash of their id, from each of the three
classes good, low and toxic a third at most, so a rare class is well represented. A row counts
in the fit with the weight of its class. Features are counted by class and chosen in Spark, by shards of
their hashes; only chosen ones and which rows have them come to the driver. Every sampled row is
scored once by a model that hasn't seen it, features included, and those scores calibrate.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from jobmart.llm.common import add_columns, pieces, stored

BITS = 30
CHARS = 5
#: Labelled rows in the fit at most.
SAMPLE = 4_500
#: Parts of the sample of which each is held out once, and shards of the features.
FOLDS, SHARDS = 3, 16
#: Features of a trait: those in at least LEAST rows of the fit with at least this chi-square, so many at most.
LEAST, CHI_SQUARE, FEATURES = 5, 25.0, 4_000
#: A text is rejected if its calibrated probability of low quality, or of toxicity, reaches these.
THRESHOLDS = (0.8, 0.25)
_SYMBOLS = "#*$%&|<>"
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in _SPACES]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mix(h: np.ndarray) -> np.ndarray:
    h = h * _M1
    return h ^ (h >> np.uint64(29))


def features(data: bytes) -> np.ndarray:
    """The hashed features of a text, one per occurrence.

    The bytes are walked as arrays: a word's hash is a difference of running sums of mixed
    (byte, place in word) pairs, a character n-gram's a polynomial over its bytes.
    """
    raw = np.frombuffer(b" " + data + b" ", np.uint8)
    space = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint32)
    lengths = ends - starts
    inside = ~space
    place = np.arange(len(raw)) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(raw)]])))
    mixed = _mix((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * _M2 + place.astype(np.uint64) * _M3)
    mixed[~inside] = 0
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed)])
    words = _mix(sums[ends] - sums[starts] + lengths.astype(np.uint64))
    pairs = _mix(words[:-1] * _M2 + words[1:] + np.uint64(7))
    marked = np.where(space, np.uint8(32), raw).astype(np.uint64)
    gram = np.zeros(len(raw) - CHARS + 1 if len(raw) >= CHARS else 0, np.uint64)
    crossing = np.zeros(len(gram), np.int8)
    for i in range(CHARS):
        gram = gram * _M3 + marked[i:i + len(gram)] + np.uint64(1)
        if 0 < i < CHARS - 1:
            crossing += space[i:i + len(gram)]
    gram = _mix(gram[crossing == 0] + np.uint64(11))
    return (np.concatenate([words, pairs, gram]) >> np.uint64(64 - BITS)).astype(np.uint32)


@dataclass
class Model:
    """Selected features, their weights for two traits, biases, and calibration slopes and offsets."""

    ids: np.ndarray  # ascending
    weights: np.ndarray  # traits x ids
    bias: np.ndarray
    slope: np.ndarray
    offset: np.ndarray

    def __post_init__(self):
        self.near = np.zeros(1 << 20, bool)  # most features of a text end here
        self.near[self.ids & 0xFFFFF] = True

    def score(self, data: bytes) -> np.ndarray:
        """The calibrated log-odds of each trait."""
        f = features(data)
        f = np.unique(f[self.near[f & 0xFFFFF]])
        at = np.searchsorted(self.ids, f)
        at = at[self.ids[np.minimum(at, len(self.ids) - 1)] == f] if len(self.ids) else at[:0]
        return self.slope * (self.bias + self.weights[:, at].sum(axis=1)) + self.offset


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows; labels: doc_id, quality (1 good), toxic (1 toxic).

    Null labels count as good and not toxic, a null text as empty, repeated labels once; of texts with the same
    id that with the least hash counts. Without labelled rows, or without a class, the model gives that
    trait no probability.
    """
    kind = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(kind).alias("kind"))
    chosen = None
    for k in range(3):
        part = marks.where(F.col("kind") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 3)
        chosen = part if chosen is None else chosen.unionByName(part)
    # An inner join against at most `sample` ids, which bound what is broadcast.
    rows = docs.select("doc_id", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    one = F.min_by("text", F.struct(F.xxhash64("text"), "text"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    rows = stored(rows.groupBy("doc_id", "kind").agg(one.alias("text")).withColumn("fold", fold), "quality-sample")
    totals = np.zeros((FOLDS, 3), np.int64)
    for r in rows.groupBy("fold", "kind").count().collect():
        totals[r.fold, r.kind] = r["count"]
    names = _choose(rows, totals)
    every = np.unique(np.concatenate([np.zeros(0, np.uint32), *names.values()]))
    shared = rows.sparkSession.sparkContext.broadcast(every)

    def held(batches):
        every = shared.value
        for b in pieces(batches, 64):
            hits = [np.flatnonzero(np.isin(every, features(x.encode("utf-8", "surrogatepass")))).astype(np.int32).tobytes() for x in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(hits, pa.binary())], ["doc_id", "kind", "fold", "hits"])

    got = rows.select("doc_id", "kind", "fold", "text").mapInArrow(held, "doc_id long, kind int, fold int, hits binary").toPandas().sort_values("doc_id")
    hits = [np.frombuffer(x, np.int32) for x in got["hits"]]
    return train(every, hits, got["kind"].to_numpy(np.int64), got["fold"].to_numpy(np.int64), names)


def _choose(rows: DataFrame, totals: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
    """(fold, trait) -> the features of the rows outside that fold (-1: of all rows) that tell a trait best."""

    def split(batches):
        for b in pieces(batches, 64):
            for kind, fold, x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ids = np.unique(features(x.encode("utf-8", "surrogatepass")))
                edges = np.searchsorted(ids, np.arange(SHARDS + 1, dtype=np.uint64) << np.uint64(BITS - SHARDS.bit_length() + 1))
                out = [(k, fold, kind, ids[i:j].tobytes()) for k, (i, j) in enumerate(zip(edges, edges[1:], strict=False)) if i < j]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.binary()), strict=True)],
                                                     ["shard", "fold", "kind", "ids"])

    def chosen(held):
        ids = [np.frombuffer(x["ids"], np.uint32) for x in held]
        names, at = np.unique(np.concatenate(ids), return_inverse=True)
        group = np.repeat([x["fold"] * 3 + x["kind"] for x in held], [len(i) for i in ids])
        counts = np.bincount(at * FOLDS * 3 + group, minlength=len(names) * FOLDS * 3).reshape(-1, FOLDS, 3)
        del at, group
        for fold in range(-1, FOLDS):
            mine = [f for f in range(FOLDS) if f != fold]
            n_kind, total_kind = counts[:, mine].sum(1), totals[mine].sum(0)
            for trait in (0, 1):
                kinds = [0, 1] if trait == 0 else [0, 1, 2]  # toxic rows say nothing about quality
                n, n1 = n_kind[:, kinds].sum(1), n_kind[:, trait + 1]
                total, ones = total_kind[kinds].sum(), total_kind[trait + 1]
                if not 0 < ones < total:
                    continue
                expected = n * ones / total
                with np.errstate(divide="ignore", invalid="ignore"):
                    chi = (n1 - expected) ** 2 / (expected * (1 - ones / total) * (1 - n / (total + 1)))
                best = np.flatnonzero((chi >= CHI_SQUARE) & (n >= LEAST))
                best = best[np.argsort(-chi[best], kind="stable")[:FEATURES]]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best), fold), pa.int32()), pa.array(np.full(len(best), trait), pa.int32()),
                                                  pa.array(names[best].astype(np.int64)), pa.array(chi[best])], ["fold", "trait", "feature", "chi"])

    def count(batches):
        now, held = None, []
        for b in pieces(batches):
            for x in b.to_pylist():
                if held and x["shard"] != now:
                    yield from chosen(held)
                    held = []
                now = x["shard"]
                held.append(x)
        if held:
            yield from chosen(held)

    sent = rows.select("kind", "fold", "text").mapInArrow(split, "shard int, fold int, kind int, ids binary")
    counted = sent.repartition(SHARDS, "shard").sortWithinPartitions("shard").mapInArrow(count, "fold int, trait int, feature long, chi double")
    best = Window.partitionBy("fold", "trait").orderBy(F.desc("chi"), "feature")
    got = counted.withColumn("place", F.row_number().over(best)).where(F.col("place") <= FEATURES).select("fold", "trait", "feature").toPandas()
    return {key: np.sort(part["feature"].to_numpy(np.uint32)) for key, part in got.groupby(["fold", "trait"])}


def train(every: np.ndarray, hits: list[np.ndarray], kind: np.ndarray, fold: np.ndarray, names: dict[tuple[int, int], np.ndarray]) -> Model:
    """``hits``: of each row the places in ``every`` of its features. One model of all rows for each trait, and one
    without each fold, whose scores of that fold calibrate it."""
    model = Model(every, np.zeros((2, len(every))), np.full(2, -9.0), np.ones(2), np.zeros(2))
    row = np.repeat(np.arange(len(kind)), [len(x) for x in hits])
    cols = np.concatenate([np.zeros(0, np.int32), *hits])
    for trait in (0, 1):
        y = (kind == trait + 1).astype(np.float64)
        used = kind != 2 if trait == 0 else np.ones(len(kind), bool)
        if not 0 < y[used].sum() < used.sum():
            continue
        apart = np.full(len(kind), np.nan)
        for k in range(-1, FOLDS):
            part = used & (fold != k)
            if k >= 0 and not 0 < y[part].sum() < part.sum():
                continue
            place = np.full(len(every), -1)
            own = np.searchsorted(every, names.get((k, trait), every[:0]))
            place[own] = np.arange(len(own))
            mine = place[cols] >= 0
            z, w, b = _weights(place[cols[mine]], row[mine], len(own), y, part)
            if k < 0:
                model.weights[trait, own], model.bias[trait] = w, b
            else:
                apart[fold == k] = z[fold == k]
        scored = used & ~np.isnan(apart)
        model.slope[trait], model.offset[trait] = _calibrate(apart[scored], y[scored])
    return model


def _weights(cols: np.ndarray, row: np.ndarray, n: int, y: np.ndarray, part: np.ndarray, rounds: int = 400) -> tuple[np.ndarray, np.ndarray, float]:
    """Scores of all rows, weights and bias of a fit on the rows in ``part``, by adaptive full-batch steps."""
    learn = part[row]
    c, r = cols[learn], row[learn]
    balance = np.where(y > 0, 0.5 / y[part].mean(), 0.5 / (1 - y[part].mean())) * part / part.sum()
    w, b, gw, gb = np.zeros(n), 0.0, np.full(n, 1e-8), 1e-8
    for _ in range(rounds):
        z = np.bincount(r, w[c], len(y)) + b
        rest = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * balance
        g = np.bincount(c, rest[r], n) + 1e-5 * w
        gw += g * g
        gb += rest.sum() ** 2
        w -= 0.1 * g / np.sqrt(gw)
        b -= 0.1 * rest.sum() / np.sqrt(gb)
    return np.bincount(row, w[cols], len(y)) + b, w, b


def _calibrate(z: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[float, float]:
    """A logistic curve over the score with smoothed targets.

    Newton steps, each halved until the loss falls; a ridge holds the slope near 1, so that scores which tell
    the classes apart completely have a finite curve too. The slope is not below 0.05.
    """
    if not 0 < y.sum() < len(y):
        return 1.0, 0.0
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    x = np.stack([z, np.ones_like(z)], 1)
    hold = np.array([ridge, 1e-6]) * len(y)
    start = np.array([1.0, 0.0])

    def loss(p):
        s = x @ p
        return (np.logaddexp(0, s) - target * s).sum() + (hold * (p - start) ** 2).sum() / 2

    p = start
    now = loss(p)
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(x @ p, -500, 500)))
        gradient = x.T @ (q - target) + hold * (p - start)
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + np.diag(hold + 1e-9), gradient)
        size = 1.0
        while size > 1e-9 and (new := loss(p - size * step)) > now:
            size /= 2
        if size <= 1e-9 or now - new < 1e-10 * (1 + abs(now)):
            break
        p, now = p - size * step, new
    return float(max(p[0], 0.05)), float(p[1])


def measures(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a whole text."""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    repeated = 0
    if len(words) > 3:
        ids: dict[bytes, int] = {}
        at = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
        n = len(ids)
        if n < 2_000_000:
            grams = (at[:-2] * n + at[1:-1]) * n + at[2:]
        else:  # three ids don't fit into 63 bits
            grams = np.unique(at[:-2] * n + at[1:-1], return_inverse=True)[1] * n + at[2:]
        order = np.argsort(grams, kind="stable")
        same = grams[order][1:] == grams[order][:-1]
        twice = np.zeros(len(grams), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = np.zeros(len(words), bool)
        for i in range(3):
            covered[i:len(grams) + i] |= twice
        repeated = int(covered.sum())
    return (len(words), len(text) - sum(map(text.count, _SPACES)), sum(map(text.count, _SYMBOLS)),
            len(lines) - len(set(lines)), repeated)


FIELDS = (T.StructType().add("n_words", "long").add("word_chars", "long").add("n_symbols", "long").add("n_dup_lines", "long")
          .add("n_repeat_words", "long").add("base_failed", "boolean").add("low_quality", "double").add("toxic", "double")
          .add("kept", "boolean"))


def judge(docs: DataFrame, model: Model, text: str = "text", thresholds: tuple[float, float] = THRESHOLDS) -> DataFrame:
    """Append the measures, base_failed, the two probabilities and kept; a null text has no words.

    base_failed: fewer than 50 words, or more than half of them in repeated three-word windows. A
    text is kept if that is false and both probabilities are below their thresholds.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def run(texts: pa.Array) -> list[pa.Array]:
            rows, odds = [], []
            for x in texts.to_pylist():
                rows.append(measures(x or ""))
                odds.append(model.score((x or "").encode("utf-8", "surrogatepass")))
            m = np.array(rows, np.int64).reshape(-1, 5)
            p = 1 / (1 + np.exp(-np.clip(np.array(odds).reshape(-1, 2), -50, 50)))
            failed = (m[:, 0] < 50) | (100 * m[:, 4] > 50 * m[:, 0])
            kept = ~failed & (p < np.array(thresholds)).all(axis=1)
            return [*(pa.array(m[:, i]) for i in range(5)), pa.array(failed), pa.array(p[:, 0]), pa.array(p[:, 1]), pa.array(kept)]
        return run

    return add_columns(docs, text, FIELDS, make)
