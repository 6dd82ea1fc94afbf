"""Toxicity: significant toxic passages by maximum-scoring segments of token log-odds.

Method. Features of a word are its text and its first 5 and 4 bytes. The log-odds of a feature
between toxic and other texts (a text counts once) has an informative Dirichlet prior (its share in both together, and
for a word the odds of its prefix), so rare words stay near their prefix and unknown ones near
zero; features with a z-score of at least MIN_Z are kept, at most MAX_FEATURES. A token's score is
its log-odds less DRIFT, so that a text's expected score is negative. One linear pass (Ruzzo and
Tompa) finds all maximal scoring segments. The scores of segments of clean texts follow an extreme-value law: lambda solves
E[exp(lambda s)] = 1 over clean tokens and K fits their maxima. A segment is significant if its
expected number of chance finds K n exp(-lambda S) is at most MAX_CHANCE. The normalised scores of
a text's significant segments, summed, and the best of them give its probability through a
logistic fitted on a fold that the log-odds have not seen.

Learning takes at most about MAX_LABELS labelled texts, drawn by a hash of the id, so what is
broadcast and gathered is bounded. Only text is scored.

Edge cases: null and empty texts have no segment and the score of a text without one; without
labelled rows of both kinds every score is 0; conflicting labels of a document count as toxic;
repeated rows give repeated results.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import Words, batch_of, code_points, mix, span_hashes, text_chunks

PREFIXES = (5, 4)
MAX_LABELS = 200_000
MAX_FEATURES = 200_000
MIN_Z = 3.0
#: Words that the prior of a feature counts as, shared out by the feature's frequency and as a floor.
PRIOR_WORDS, PRIOR_FLOOR = 500.0, 1.0
DRIFT = 0.5
MAX_CHANCE = 0.05
#: One labelled text in so many calibrates instead of counting.
CALIBRATING = 4

COUNTS = pa.schema([("kind", pa.int8()), ("feature", pa.int64()), ("prefix", pa.int64()), ("toxic", pa.int64()), ("clean", pa.int64())])
SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("chance", pa.float64())])


def features(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature (word, then prefixes): (words that have it, its hash)."""
    out = [(np.arange(len(words.starts)), words.hashes)]
    for n in PREFIXES:
        own = np.flatnonzero(words.ends - words.starts > n)
        out.append((own, span_hashes(words.sums, words.starts[own], words.starts[own] + n) ^ np.uint64(n)))
    return out


def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's features in toxic and other texts, summed chunk by chunk."""
    held: dict[int, list] = {}
    size = 0

    def flush(k: int) -> pa.RecordBatch:
        f, p, t, c = (np.concatenate(x) for x in zip(*held.pop(k)))
        keys, at, inverse = np.unique(f, return_index=True, return_inverse=True)
        add = lambda x: np.bincount(inverse, weights=x, minlength=len(keys)).astype(np.int64)
        return batch_of(COUNTS, kind=np.full(len(keys), k), feature=keys.view(np.int64), prefix=p[at].view(np.int64), toxic=add(t), clean=add(c))

    for batch in batches:
        for part in text_chunks(batch):
            words = Words(part.column(0))
            label = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)[words.text_of]
            found = features(words)
            parent = np.zeros(len(words.starts), np.uint64)
            for own, h in reversed(found[1:]):  # the longest prefix last
                parent[own] = h
            for k, (own, h) in enumerate(found):
                with np.errstate(over="ignore"):  # a text counts once, however often it repeats a word
                    pairs = mix(h ^ (words.text_of[own].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
                once = np.unique(pairs, return_index=True)[1]
                own, h = own[once], h[once]
                keys, at, inverse = np.unique(h, return_index=True, return_inverse=True)
                toxic = np.bincount(inverse, weights=label[own], minlength=len(keys)).astype(np.int64)
                every = np.bincount(inverse, minlength=len(keys))
                held.setdefault(k, []).append((keys, parent[own][at] if k == 0 else np.zeros(len(keys), np.uint64), toxic, every - toxic))
                size += len(keys)
        if size > 2_000_000:
            size = 0
            for k in list(held):
                yield flush(k)
    for k in list(held):
        yield flush(k)


@dataclass
class Model:
    keys: np.ndarray  # sorted hashes of the kept features, of all kinds
    odds: np.ndarray
    drift: float = DRIFT
    lam: float = 1.0
    k: float = 1.0
    weights: tuple[float, float, float] = (0.0, 0.0, -50.0)  # of the summed and best normalised score, and none

    def token_scores(self, words: Words) -> np.ndarray:
        out = np.full(len(words.starts), -self.drift)
        if len(self.keys):
            for own, h in reversed(features(words)):  # the word itself last: it says most
                at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                known = self.keys[at] == h
                out[own[known]] = self.odds[at[known]] - self.drift
        hit = np.flatnonzero(out > 0)
        if len(hit):  # the k-th time that a text has a word, it says a k-th as much
            order = np.lexsort((hit, words.hashes[hit], words.text_of[hit]))
            new = np.ones(len(hit), bool)
            new[1:] = np.diff(words.text_of[hit][order]) != 0
            new[1:] |= words.hashes[hit][order][1:] != words.hashes[hit][order][:-1]
            begin = np.flatnonzero(new)
            times = np.arange(len(hit)) - np.repeat(begin, np.diff(np.append(begin, len(hit)))) + 1
            out[hit[order]] = (out[hit[order]] + self.drift) / times - self.drift
        return out

    def normalised(self, score: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.lam * score - np.log(self.k * np.maximum(n, 1))

    def probability(self, total: np.ndarray, best: np.ndarray) -> np.ndarray:
        z = self.weights[0] * np.log1p(total) + self.weights[1] * best + self.weights[2]
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence, in linear time."""
    out: list[list] = []  # start, end, sum before it, sum at its end, link to an earlier candidate
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        own = [i, i + 1, before, total, -1]
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= own[2]:  # the last candidate that begins lower
                j = out[j][4]
            if j < 0 or out[j][3] >= own[3]:
                own[4] = j
                out.append(own)
                break
            own = [out[j][0], own[1], out[j][2], own[3], -1]
            del out[j:]
    return [(a, b, end - start) for a, b, start, end, _ in out]


def text_segments(scores: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, float]]:
    """(text, start, end, score) of the maximal segments of each text with a positive score.

    Words between two positive ones only matter by their sum, so runs of them are one step.
    """
    out = []
    positive = np.flatnonzero(scores > 0)
    text = np.searchsorted(first, positive, side="right") - 1
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    cuts = np.flatnonzero(np.diff(text)) + 1
    for own, t in zip(np.split(positive, cuts), text[np.concatenate(([0], cuts))] if len(text) else []):
        gaps = sums[own[1:]] - sums[own[:-1] + 1]
        steps = np.zeros(2 * len(own) - 1)
        steps[::2], steps[1::2] = scores[own], gaps
        out += [(int(t), int(own[a // 2]), int(own[(b - 1) // 2]) + 1, s) for a, b, s in maximal_segments(steps.tolist())]
    return out


def evidence(words: Words, model: Model) -> tuple[np.ndarray, np.ndarray, list]:
    """Of each text: summed and best normalised score of significant segments; the segments."""
    n = len(words.counts)
    total, best, spans = np.zeros(n), np.zeros(n), []
    for t, a, b, s in text_segments(model.token_scores(words), words.first):
        z = float(model.normalised(np.float64(s), words.counts[t]))
        if z >= -np.log(MAX_CHANCE):
            total[t] += z
            best[t] = max(best[t], z)
            spans.append((t, a, b, s, float(np.exp(-z))))
    return total, best, spans


CALIBRATION = pa.schema([("toxic", pa.int8()), ("n", pa.int64()), ("top", pa.float64())])
VALUES = pa.schema([("toxic", pa.int8()), ("total", pa.float64()), ("best", pa.float64())])


def labelled_texts(docs: DataFrame, labels: DataFrame, max_labels: int, id_column: str, text_column: str, label_column: str) -> DataFrame:
    """text and toxic (0 or 1) of the labelled documents, from at most about max_labels labels."""
    rows = labels.where(F.col(id_column).isNotNull() & F.col(label_column).isNotNull())
    rows = rows.groupBy(F.col(id_column).alias("label_id")).agg(F.max(label_column).cast("int").alias("toxic"))
    n = rows.count()
    if n > max_labels:
        rows = rows.where(F.pmod(F.xxhash64("label_id", F.lit("label draw")), F.lit(1_000_000)) < int(1_000_000 * max_labels / n))
    # bounded by max_labels, about 16 bytes a row
    texts = docs.select(F.col(id_column).alias("label_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return texts.join(F.broadcast(rows), "label_id").select("text", "toxic", F.pmod(F.xxhash64("label_id", F.lit("fold")), F.lit(CALIBRATING)).alias("fold"))


def fit_log_odds(rows: DataFrame, max_features: int = MAX_FEATURES, min_z: float = MIN_Z) -> Model:
    counts = rows.mapInArrow(count_features, "kind byte, feature long, prefix long, toxic long, clean long")
    counts = counts.groupBy("kind", "feature").agg(F.max("prefix").alias("prefix"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # a feature never seen in a toxic text can only lower a score, which the drift does already
    chosen = counts.where("toxic >= 2").toArrow()
    totals = counts.where("kind = 0").agg(F.sum("toxic"), F.sum("clean")).first()
    if not totals[0] or not totals[1]:
        return Model(np.zeros(0, np.uint64), np.zeros(0))
    n1, n0 = map(float, totals)
    kind, key, prefix, y1, y0 = (chosen.column(c).to_numpy() for c in ("kind", "feature", "prefix", "toxic", "clean"))
    share = (y1 + y0) / (n1 + n0)
    a1, a0 = (PRIOR_WORDS * share + PRIOR_FLOOR) * n1 / (n1 + n0), (PRIOR_WORDS * share + PRIOR_FLOOR) * n0 / (n1 + n0)
    odds = np.log((y1 + a1) / (n1 + PRIOR_WORDS - y1 - a1)) - np.log((y0 + a0) / (n0 + PRIOR_WORDS - y0 - a0))
    z = odds / np.sqrt(1 / (y1 + a1) + 1 / (y0 + a0))
    # a word whose prefix is known starts from the prefix's odds
    order = np.argsort(key)
    at = order[np.minimum(np.searchsorted(key[order], prefix), len(order) - 1)] if len(order) else order
    under = (kind == 0) & (prefix != 0) & (key[at] == prefix) & (z[at] >= min_z)
    weight = (y1 + y0) / (y1 + y0 + 5.0)
    odds = np.where(under, weight * odds + (1 - weight) * odds[at], odds)
    keep = np.flatnonzero(np.abs(z) >= min_z)
    keep = keep[np.argsort(-np.abs(z[keep]), kind="stable")[:max_features]]
    keys = key[keep].view(np.uint64)
    order = np.argsort(keys)
    return Model(keys[order], odds[keep][order])


def solve_lambda(values: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of E[exp(lambda s)] = 1; 1 (natural log-odds) if no score is positive."""
    if not (values > 0).any():
        return 1.0
    p, lo, hi = counts / counts.sum(), 0.0, 1.0
    f = lambda x: float((p * np.exp(np.minimum(x * values, 700))).sum()) - 1
    while f(hi) < 0 and hi < 64:
        lo, hi = hi, 2 * hi
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return min(max(hi, 0.05), 5.0)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Newton's method for a few columns; the ridge keeps separable data finite."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.clip(np.linalg.solve(h, x.T @ (y - p) - ridge * w), -5, 5)
    return w


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> Model:
    """Model of the labelled documents among docs."""
    rows = labelled_texts(docs, labels, max_labels, id_column, text_column, label_column)
    model = fit_log_odds(rows.where("fold > 0").select("text", "toxic"))
    if not len(model.keys):
        return model
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(model)

    def tops(batches):
        """Each calibrating text's label, words and best segment; and the histogram of clean token scores."""
        for batch in batches:
            for part in text_chunks(batch):
                words, m = Words(part.column(0)), shared.value
                scores, toxic = m.token_scores(words), part.column(1).to_numpy(zero_copy_only=False)
                top = np.zeros(len(words.counts))
                for t, _, _, s in text_segments(scores, words.first):
                    top[t] = max(top[t], s)
                yield batch_of(CALIBRATION, toxic=toxic, n=words.counts, top=top)
                clean = np.round(scores[toxic[words.text_of] == 0], 1)
                values, n = np.unique(clean, return_counts=True)
                yield batch_of(CALIBRATION, toxic=np.full(len(values), -1), n=n, top=values)

    held = rows.where("fold = 0").select("text", "toxic")
    got = held.mapInArrow(tops, "toxic byte, n long, top double").groupBy("toxic", "n", "top").agg(F.count("*").alias("rows")).toArrow()
    toxic, n, top, times = (got.column(c).to_numpy() for c in ("toxic", "n", "top", "rows"))
    tokens = toxic == -1
    model.lam = solve_lambda(top[tokens], (n * times)[tokens]) if tokens.any() else 1.0
    # maximum likelihood of K: the expected number of chance finds at the maxima of clean texts is one each
    clean = (toxic == 0) & (n > 0)
    if clean.any():
        model.k = float(times[clean].sum() / max((times[clean] * n[clean] * np.exp(-model.lam * top[clean])).sum(), 1e-9))
    shared = context.broadcast(model)

    def values(batches):
        for batch in batches:
            for part in text_chunks(batch):
                total, best, _ = evidence(Words(part.column(0)), shared.value)
                yield batch_of(VALUES, toxic=part.column(1), total=np.round(total, 2), best=np.round(best, 2))

    got = held.mapInArrow(values, "toxic byte, total double, best double").groupBy("toxic", "total", "best").agg(F.count("*").alias("rows")).toArrow()
    y, total, best, times = (got.column(c).to_numpy() for c in ("toxic", "total", "best", "rows"))
    times = times.astype(int)
    if len(set(y.tolist())) == 2:
        x = np.column_stack((np.log1p(total), best))
        model.weights = tuple(fit_logistic(np.repeat(x, times, axis=0), np.repeat(y, times)))
    return model


RESULT = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("n_words", pa.int64()), ("passages", pa.list_(SPAN))])


def score_documents(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row per document: probability of being toxic and its significant passages, in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in text_chunks(batch):
                words = Words(part.column(1))
                total, best, spans = evidence(words, shared.value)
                passages = [[] for _ in total]
                points = code_points(words.data) if spans else None
                for t, a, b, s, chance in spans:
                    zero = points[words.offsets[t]]
                    passages[t].append({"start": int(points[words.starts[a]] - zero), "end": int(points[words.ends[b - 1]] - zero), "score": s, "chance": chance})
                yield batch_of(RESULT, doc_id=part.column(0), score=shared.value.probability(total, best), n_words=words.counts, passages=passages)

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(run, "doc_id long, score double, n_words long, passages array<struct<start:int,end:int,score:double,chance:double>>")
