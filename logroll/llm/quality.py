"""Quality by co-training two classifiers.

View 1 reads the text (shares of character classes and of their trigrams, repetition, word
shape), view 2 the page's metadata (language, source, length).  Both are logistic regressions.
In each round a view labels the unlabelled documents it is surest of for the *other* view: those
above a threshold that holds for the whole corpus, the stricter of the one at which its labels were
at least ``SURE`` precise on held-out labelled rows and the one that the surest ``SHARE`` of the
unlabelled documents of that class pass (all of them times the class's held-out share), and never one
that the calibrated teacher itself holds for less than ``SURE``.  Each view is calibrated on held-out rows (Platt), and all documents are
scored by the sum of the calibrated log-odds over the prior.

Only the labelled rows are bounded: at most ``LABELLED`` of them, by hash of doc_id, are on the
driver.  The unlabelled documents take part in full: their features are written once (sparse, half
precision), and every round reads them for a histogram of scores and for the sums of gradient and
Hessian, added up per partition and then per piece.  A document's pseudo-label is a function of its
features and of the models so far, so no label table is kept and a lost task is simply run again.
Pseudo-labels weigh at most as much as the labelled rows in total, at any size of the corpus.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from logroll.llm.common import freeze, release, table

LABELLED, ROUNDS, SURE, SHARE, STEPS = 4_000, 4, 0.95, 1 / 8, 2
REJECT_BELOW = 0.5
#: Bins of the score histograms (log-odds from -EDGE to EDGE) and pieces that long sums are cut into.
EDGE, BINS, PIECES = 32.0, 1_280, 16
#: Lengths a Newton step is tried at, and rows that are worked on at once.
TRIES, ROWS = np.array([1, 1 / 2, 1 / 4, 1 / 8, 1 / 16, 1 / 64, 0]), 512

# Character classes of bytes: lower, upper, digit, blank, line end, stop or comma, other punctuation, beyond ASCII.
_CLASSES = 8
_CLASS = np.full(256, 7, np.uint8)
_CLASS[:128] = 6
_CLASS[ord("a"):ord("z") + 1] = 0
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[[9, 11, 12, 32]] = 3
_CLASS[[10, 13]] = 4
_CLASS[[ord("."), ord(",")]] = 5
TEXT_WIDTH, META_WIDTH = _CLASSES + _CLASSES**3 + 6, 16 + 64 + 16


def text_features(text: str | None) -> np.ndarray:
    """Content view of one whole text."""
    out = np.zeros(TEXT_WIDTH)
    raw = (text or "").encode()
    if not raw:
        return out
    c = _CLASS[np.frombuffer(raw, np.uint8)]
    out[:_CLASSES] = np.bincount(c, minlength=_CLASSES) / len(c)
    if len(c) > 2:
        tri = (c[:-2].astype(np.int32) * _CLASSES + c[1:-1]) * _CLASSES + c[2:]
        out[_CLASSES:_CLASSES + _CLASSES**3] = np.sqrt(np.bincount(tri, minlength=_CLASSES**3) / len(tri))
    words = raw.split()
    if words:
        n = len(words)
        same = sum(a == b for a, b in zip(words, words[1:]))
        out[-6:] = (len(set(words)) / n, same / n, min(len(raw) / n, 40.0) / 10, np.log1p(n) / 10,
                    raw.count(b"\n") / n, sum(len(w) == 1 for w in words) / n)
    return out


def meta_features(lang, source, n_chars) -> np.ndarray:
    """Metadata view: hashed language and source, length on a logarithmic scale."""
    out = np.zeros(META_WIDTH)
    out[xxhash.xxh32_intdigest(str(lang)) % 16] = 1
    out[16 + xxhash.xxh32_intdigest(str(source)) % 64] = 1
    out[80 + min(15, int(np.log2(1 + max(0, int(n_chars or 0)))))] = 1
    return out


class View:
    """Logistic regression on standardised features, then Platt scaling on held-out rows."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, ridge: float = 3.0):
        self.mean, self.scale = mean, scale
        self.w, self.a, self.b = np.zeros(len(mean) + 1), 1.0, 0.0
        self.penalty = np.full(len(mean) + 1, ridge)
        self.penalty[-1] = 1e-6

    def sums(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Rows, gradient and Hessian of the rows given, in one vector."""
        z = np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))])
        p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
        half = (z * np.sqrt(p * (1 - p) + 1e-6)[:, None]).astype(np.float32)
        return np.concatenate([[len(x)], z.T @ (p - y), (half.T @ half).astype(float).ravel()])

    def losses(self, x: np.ndarray, y: np.ndarray, move: np.ndarray) -> np.ndarray:
        """Summed loss of the rows given, for every length of a step along ``move``."""
        odds = ((x - self.mean) / self.scale) @ (self.w[:-1] - TRIES[:, None] * move[:-1]).T + (self.w[-1] - TRIES * move[-1])
        return np.logaddexp(0, np.where(y[:, None] > 0, -odds, odds)).sum(0)

    def move(self, told: np.ndarray, taught: np.ndarray) -> tuple:
        """Newton direction from the sums over labelled and pseudo-labelled rows, and the latters' weight."""
        weight = min(1.0, told[0] / taught[0]) if taught[0] else 0.0
        total, n = told + taught * weight, len(self.w)
        return np.linalg.solve(total[1 + n:].reshape(n, n) + np.diag(self.penalty), total[1:1 + n] + self.penalty * self.w), weight

    def step(self, move: np.ndarray, losses: np.ndarray) -> float:
        """Goes the length with the least penalised loss, never uphill; the greatest change."""
        at = self.w - TRIES[:, None] * move
        best = at[np.argmin(losses + (self.penalty * at * at).sum(1) / 2)]
        change, self.w = float(np.abs(best - self.w).max()), best
        return change

    def copy(self) -> "View":
        other = View(self.mean, self.scale)
        other.w, other.a, other.b = self.w, self.a, self.b
        return other

    def raw(self, x):
        return ((x - self.mean) / self.scale) @ self.w[:-1] + self.w[-1]

    def calibrate(self, x, y):
        """Two-parameter fit on held-out rows; a view that tells nothing shrinks to the prior."""
        r = np.clip(self.raw(x), -30, 30)
        z, sign = np.stack([r, np.ones(len(r))], 1), np.where(y > 0, 1, -1)
        prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        at = np.array([0.5, prior])
        loss = lambda w: np.logaddexp(0, -sign * (z @ w)).sum() + 1e-2 / 2 * w[0] ** 2
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ at, -30, 30)))
            g = z.T @ (p - y) + np.array([1e-2 * at[0], 0.0])
            h = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag([1e-2, 1e-9])
            tries = [at - t * np.linalg.solve(h, g) for t in TRIES]
            best = min(tries, key=loss)
            done, at = np.abs(best - at).max() < 1e-8, best
            if done:
                break
        self.a, self.b = (float(at[0]), float(at[1])) if at[0] > 0 else (0.0, prior)

    def logit(self, x):
        return self.a * np.clip(self.raw(x), -30, 30) + self.b


class CoTrained:
    """The two calibrated views and the prior; ``score`` gives the probability of good quality."""

    def __init__(self, views, prior):
        self.views, self.prior = views, prior

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        if self.views is None:
            return np.full(len(text), 1.0)
        total = self.prior + sum(v.logit(x) - self.prior for v, x in zip(self.views, (text, meta)))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def pseudo_labels(x: tuple, rules: list) -> list:
    """Labels (1, 0 or -1) that each view has been taught for rows ``x``, by the rounds so far."""
    labels = [np.full(len(v), -1) for v in x]
    for teachers, cuts in rules:
        for i, teacher in enumerate(teachers):
            odds = teacher.logit(x[i])
            for label, sign in ((0, -1), (1, 1)):
                if cuts[i][label] is not None:
                    labels[1 - i][(labels[1 - i] < 0) & (sign * odds >= cuts[i][label])] = label
    return labels


def _moments(x: tuple) -> np.ndarray:
    return np.concatenate([[len(x[0])], *[part for v in x for part in (v.sum(0), (v * v).sum(0))]])


def _odds_bins(x: tuple, views: list, rules: list) -> np.ndarray:
    """Histograms of both views' log-odds over the rows that the other view has no label for yet."""
    labels = pseudo_labels(x, rules)
    bins = [((np.clip(v.logit(x[i]), -EDGE, EDGE - 1e-6) + EDGE) * (BINS / (2 * EDGE))).astype(int) for i, v in enumerate(views)]
    return np.concatenate([np.bincount(b[labels[1 - i] < 0], minlength=BINS) for i, b in enumerate(bins)]).astype(float)


def _taught_sums(x: tuple, views: list, rules: list) -> np.ndarray:
    labels = pseudo_labels(x, rules)
    return np.concatenate([v.sums(x[i][labels[i] >= 0], labels[i][labels[i] >= 0]) for i, v in enumerate(views)])


def _taught_losses(x: tuple, views: list, rules: list, moves: list) -> np.ndarray:
    labels = pseudo_labels(x, rules)
    return np.concatenate([v.losses(x[i][labels[i] >= 0], labels[i][labels[i] >= 0], moves[i]) for i, v in enumerate(views)])


def _cuts(held_odds: np.ndarray, held_y: np.ndarray, bins: np.ndarray, wanted: float) -> list:
    """Per label the least certainty at which a view may teach, None where it may not; ``wanted`` rows of both."""
    cuts = []
    for label, sign in ((0, -1), (1, 1)):
        order = np.argsort(-sign * held_odds, kind="stable")
        right = np.cumsum(held_y[order] == label) / np.arange(1, len(order) + 1)
        enough = np.flatnonzero(right >= SURE)
        enough = enough[enough >= 19]                           # precision of fewer rows says little
        if not len(enough):
            cuts.append(None)
            continue
        upward = np.cumsum(bins[::-1] if sign > 0 else bins)    # rows from the surest bin on
        last = min(int(np.searchsorted(upward, wanted * (held_y == label).mean())), BINS - 1)
        cuts.append(max(np.log(SURE / (1 - SURE)), sign * held_odds[order[enough.max()]], EDGE - (last + 1) * (2 * EDGE / BINS)))
    return cuts


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, held: np.ndarray, over=None) -> CoTrained:
    """``y``: 1, 0, or -1 for unlabelled rows; ``held``: labelled rows kept for calibration.

    ``over(work)`` adds up ``work((text, meta))`` over the unlabelled rows (None without any); by
    default those among the rows given.
    """
    known, fit = y >= 0, (y >= 0) & ~held
    if len(set(y[fit])) < 2 or len(set(y[held & known])) < 2:
        return CoTrained(None, 0.0)
    x = (text, meta)
    if over is None:
        rest = tuple(v[~known] for v in x)
        over = lambda work: work(rest) if len(rest[0]) else None
    seen = over(_moments)
    moments = _moments(tuple(v[fit] for v in x)) + (0 if seen is None else seen)
    n, at, views = moments[0], 1, []
    for v in x:
        mean, square = moments[at:at + v.shape[1]] / n, moments[at + v.shape[1]:at + 2 * v.shape[1]] / n
        at += 2 * v.shape[1]
        views.append(View(mean, np.sqrt(np.maximum(square - mean * mean, 0.0)) + 1e-3))
    sizes, rules = [1 + len(v.w) + len(v.w) ** 2 for v in views], []

    def improve(taught: bool) -> float:
        """One step of both views; its pseudo-labelled rows are read once for the direction and once for the length."""
        none = np.zeros(sum(sizes))
        sums = np.split(over(lambda part: _taught_sums(part, views, rules)) if taught else none, [sizes[0]])
        moves, weights = zip(*[v.move(v.sums(x[i][fit], y[fit]), sums[i]) for i, v in enumerate(views)])
        lost = np.split(over(lambda part: _taught_losses(part, views, rules, moves)) if taught else none[:2 * len(TRIES)], 2)
        return max([v.step(moves[i], v.losses(x[i][fit], y[fit], moves[i]) + weights[i] * lost[i]) for i, v in enumerate(views)])

    def calibrate():
        for i, v in enumerate(views):
            v.calibrate(x[i][held], y[held].astype(float))

    for _ in range(12):
        if improve(False) < 1e-6:
            break
    calibrate()
    for _ in range(ROUNDS if seen is not None else 0):
        bins = over(lambda part: _odds_bins(part, views, rules)).reshape(2, BINS)
        rules.append(([v.copy() for v in views],
                      [_cuts(v.logit(x[i][held]), y[held], bins[i], SHARE * seen[0]) for i, v in enumerate(views)]))
        for _ in range(STEPS):
            improve(True)
        calibrate()
    good = y[held].mean()
    return CoTrained(views, float(np.log((good + 1e-6) / (1 - good + 1e-6))))


def _feature_rows(batches):
    """doc_id and the nonzero features: positions (two bytes each) and values (half precision)."""
    for batch in batches:
        ids, texts, langs, sources, sizes = (batch.column(i).to_pylist() for i in range(5))
        at, values = [], []
        for t, la, s, n in zip(texts, langs, sources, sizes):
            x = np.concatenate([text_features(t), meta_features(la, s, n)])
            at.append(np.flatnonzero(x).astype("<u2"))
            values.append(x[at[-1]].astype("<f2").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([v.tobytes() for v in at], pa.binary()),
                                          pa.array(values, pa.binary())], ["doc_id", "at", "val"])


def _dense(at: list, values: list) -> tuple:
    """Both views' features of rows written by ``_feature_rows``."""
    x = np.zeros((len(at), TEXT_WIDTH + META_WIDTH))
    rows = np.repeat(np.arange(len(at)), [len(v) // 2 for v in at])
    x[rows, np.frombuffer(b"".join(at), "<u2")] = np.frombuffer(b"".join(values), "<f2")
    return x[:, :TEXT_WIDTH], x[:, TEXT_WIDTH:]


def _summed(rows: DataFrame, work) -> np.ndarray | None:
    """``work`` of all rows' features, added up: per partition, then per piece of the vector, so
    that neither the driver nor a task meets more than one vector whatever the partitions."""
    shape = "piece int, sums binary"

    def out(sums: dict):
        return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                           pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["piece", "sums"])

    def part(batches):
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                value = work(_dense(rows.column(0).to_pylist(), rows.column(1).to_pylist()))
                total = value if total is None else total + value
        if total is not None:
            yield out(dict(enumerate(np.array_split(total, PIECES))))
        release()

    def add(batches):
        sums = {}
        for batch in batches:
            for piece, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                value = np.frombuffer(raw)
                sums[piece] = sums[piece] + value if piece in sums else value
        if sums:
            yield out(sums)

    got = rows.select("at", "val").mapInArrow(part, shape).repartition(PIECES, "piece").mapInArrow(add, shape).collect()
    return np.concatenate([np.frombuffer(r["sums"]) for r in sorted(got, key=lambda r: r["piece"])]) if got else None


def _inputs(docs: DataFrame) -> list:
    """The columns both views read; metadata that the table lacks is null."""
    have = set(docs.columns)
    return [F.col("text").cast("string").alias("text"),
            *[(F.col(c) if c in have else F.lit(None)).cast("string").alias(c) for c in ("lang", "source")],
            F.coalesce(F.col("n_chars") if "n_chars" in have else F.length("text"), F.lit(0)).cast("long").alias("n_chars")]


def fit(docs: DataFrame, labels: DataFrame) -> CoTrained:
    """Co-trained model from at most ``LABELLED`` labelled and all unlabelled rows of ``docs``."""
    told = (labels.select(F.col("doc_id").cast("long").alias("__id"), F.col("quality").cast("int").alias("label"))
            .where("__id is not null and label in (0, 1)").groupBy("__id").agg(F.max("label").alias("label")))
    features = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_inputs(docs))
                .mapInArrow(_feature_rows, "doc_id long, at binary, val binary"))
    rows = freeze(features.join(told, F.col("doc_id") == F.col("__id"), "left").select("doc_id", "label", "at", "val"),
                  "quality-features")
    known = rows.where("label is not null")
    ids = known.select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id").limit(LABELLED)
    sample = (known.join(F.broadcast(ids), "doc_id", "left_semi")                  # at most LABELLED ids
              .groupBy("doc_id").agg(F.max("label").alias("label"), F.min(F.struct("at", "val")).alias("x")).collect())
    if not sample:
        return CoTrained(None, 0.0)
    sample.sort(key=lambda r: r["doc_id"])
    text, meta = _dense([bytes(r["x"]["at"]) for r in sample], [bytes(r["x"]["val"]) for r in sample])
    y = np.array([r["label"] for r in sample])
    held = np.array([xxhash.xxh32_intdigest(str(r["doc_id"])) % 4 == 0 for r in sample])
    unlabelled = rows.where("label is null")
    return co_train(text, meta, y, held, lambda work: _summed(unlabelled, work))


def with_scores(docs: DataFrame, model: CoTrained, column: str = "quality_score") -> DataFrame:
    """``docs`` with the probability of good quality; every row is scored on its whole text."""
    def some(rows):
        return model.score(np.stack([text_features(r[0]) for r in rows]), np.stack([meta_features(*r[1:]) for r in rows]))

    def score(parts):
        for part in parts:
            rows = list(zip(*part))
            yield pd.Series(np.concatenate([np.zeros(0), *[some(rows[at:at + ROWS]) for at in range(0, len(rows), ROWS)]]))

    from pyspark.sql.pandas.functions import PandasUDFType, pandas_udf
    udf = pandas_udf(score, T.DoubleType(), PandasUDFType.SCALAR_ITER)
    return docs.withColumn(column, udf(*_inputs(docs)))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, quality_score, accepted: one row per row of ``docs``.

    Null and empty texts score by their metadata and empty features; null metadata is a value of
    its own; repeated rows score alike; labels for unknown documents are ignored, the greater of
    two labels of one document counts.  Without labels of both classes nothing is rejected.
    """
    scored = with_scores(docs, fit(docs, labels))
    return scored.select(F.col("doc_id").cast("long").alias("doc_id"), "quality_score",
                         (F.col("quality_score") >= REJECT_BELOW).alias("accepted"))


def accepted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of ``docs`` the classifier does not reject, in the columns of ``docs``."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    return with_scores(docs, model, "__score").where(F.col("__score") >= REJECT_BELOW).select(*docs.columns)
