"""Quality by co-training: two views of a document teach each other.

The content view sees which words stand in a text and how they repeat; the metadata view sees
language, source, length and the make-up of its lines and characters.  Both start from the same
labelled rows.  In every round each marks the unlabelled rows that it is surest about, and these
become training rows of the other.  Each view is then calibrated on rows that neither was
trained on, the two calibrated views are combined, and every document is scored.

Only labelled rows are sampled: ``labelled_rows`` is a bound, and the keys with the smallest hash
are taken.  They lie on the driver; the vocabulary comes from them.  All other rows are the pool:
their features are written once, and every pass reads them where they lie.  A round needs one pass
that counts how sure each teacher is of how many rows, which gives the cuts, and a few that add up
losses and gradients.  Pseudo-labels are not stored: they follow from the models and cuts of the
rounds before.  Scoring reads every document once.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.shared import ascii_lower, materialize, table, words
from riskframe.sources.scratch import discard, recorded

PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
EDGE = "".join(map(chr, PUNCTUATION))
RARE = 64  # columns that the values without a column of their own share, by hash

VIEWS = ("content", "metadata")
TEACHES = (("content", "metadata"), ("metadata", "content"))


# ---- features --------------------------------------------------------------------------


@dataclass
class Views:
    """What the features of the two views are: word -> column, and the known values."""

    vocabulary: dict[str, int]
    langs: dict[str, int]
    sources: dict[str, int]

    def columns(self) -> tuple[int, int]:
        """Number of 0/1 columns of either view."""
        return len(self.vocabulary), len(self.langs) + len(self.sources) + 2 * (1 + RARE)

    def content(self, text: str) -> tuple[list[float], list[int]]:
        """Shares of repetition, and the columns of the vocabulary's words in the text."""
        found = text.translate(_LOWER_STR).split()
        n = len(found)
        distinct = set(found)
        pairs = len(set(zip(found, found[1:])))
        again = sum(map(str.__eq__, found, found[1:]))
        lines = text.split("\n")
        bare = {w.strip(EDGE) for w in distinct}
        dense = [
            len(distinct) / max(1, n),
            pairs / max(1, n - 1),
            again / max(1, n - 1),
            len(set(lines)) / len(lines),
            sum(map(len, found)) / max(1, n) / 10,
            len(bare) / max(1, len(distinct)),
        ]
        return dense, sorted(i for i in map(self.vocabulary.get, bare) if i is not None)

    def metadata(self, text: str, lang: str | None, source: str | None) -> tuple[list[float], list[int]]:
        """Length and make-up of lines and characters, and the columns of language and source."""
        raw = text.encode()
        n = max(1, len(raw))
        counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        lines = raw.count(b"\n") + 1
        blanks = counts[[9, 10, 13, 32]].sum()
        marks = counts[list(PUNCTUATION)]
        dense = [
            np.log1p(len(raw)) / 10,
            np.log1p(lines) / 5,
            np.log1p(len(raw) / lines) / 5,
            counts[65:91].sum() / n,
            counts[97:123].sum() / n,
            counts[48:58].sum() / n,
            counts[128:].sum() / n,
            blanks / n,
            marks.sum() / n,
            marks.max() / n,
            counts[ord("|")] / n,
            float(len(raw) == 0),
        ]
        return dense, [value_column(lang, self.langs), len(self.langs) + 1 + RARE + value_column(source, self.sources)]


def value_column(value: str | None, known: dict[str, int]) -> int:
    """0 for null, 1 and so on for the known values, a shared column by hash for any other."""
    if value is None:
        return 0
    return known[value] if value in known else len(known) + 1 + zlib.crc32(value.encode()) % RARE


_LOWER_STR = {c: c + 32 for c in range(65, 91)}


def design(rows: list[tuple[list[float], list[int]]], columns: int) -> np.ndarray:
    """Dense shares first, then one 0/1 column per word or value."""
    dense = np.array([d for d, _ in rows], np.float32).reshape(len(rows), -1)
    out = np.zeros((len(rows), dense.shape[1] + columns), np.float32)
    out[:, : dense.shape[1]] = dense
    at = np.repeat(np.arange(len(rows)), [len(i) for _, i in rows])
    out[at, dense.shape[1] + np.array([i for _, own in rows for i in own], int)] = 1
    return out


@dataclass
class Part:
    """Rows of one view as they come from the table of features."""

    dense: np.ndarray
    own: np.ndarray  # 0/1 columns, of one row after the other
    at: np.ndarray  # the row that each of them belongs to

    @classmethod
    def of(cls, batch: pa.RecordBatch, view: str) -> Part:
        dense, own = batch.column(f"{view[0]}_dense"), batch.column(f"{view[0]}_own")
        sizes = np.diff(own.offsets.to_numpy())
        flat = dense.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        return cls(flat.astype(float), own.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(batch.num_rows), sizes))

    def raw(self, head: np.ndarray, weights: np.ndarray) -> np.ndarray:
        k = head.shape[1]
        return head @ weights[:k] + np.bincount(self.at, weights[k:][self.own], len(head))

    def gradient(self, head: np.ndarray, rest: np.ndarray, columns: int) -> np.ndarray:
        return np.concatenate([rest @ head, np.bincount(self.own, rest[self.at], columns)])


# ---- models ----------------------------------------------------------------------------


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Line:
    """A logistic model: standardised dense features and their squares, then 0/1 columns."""

    dense: int
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def head(self, dense: np.ndarray) -> np.ndarray:
        z = np.clip((dense - self.mean) / self.scale, -8, 8)
        return np.concatenate([np.ones((len(z), 1), z.dtype), z, z * z / 4], axis=1)

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.head(x[:, : self.dense]), x[:, self.dense :]], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (self.inputs(x) @ self.weights.astype(np.float32)).astype(np.float64)

    def logit(self, x: np.ndarray) -> np.ndarray:
        """Calibrated log-odds."""
        return self.slope * self.raw(x) + self.offset


def fitted(x: np.ndarray, y: np.ndarray, weight: np.ndarray, dense: int, start: np.ndarray | None = None, penalty: float = 0.5) -> Line:
    """Penalised logistic regression by Newton steps, each solved by conjugate gradients (so no
    p x p matrix) and halved while it does not lower the loss."""
    line = Line(dense, x[:, :dense].mean(0), x[:, :dense].std(0) + 1e-6, np.zeros(1))
    z = line.inputs(x)
    ridge = np.full(z.shape[1], penalty)
    ridge[0] = 1e-3

    def loss(w: np.ndarray, m: np.ndarray) -> float:
        return float((weight * (np.logaddexp(0, m) - y * m)).sum() + 0.5 * (ridge * w * w).sum())

    w = np.zeros(z.shape[1]) if start is None else start.copy()
    m = (z @ w.astype(np.float32)).astype(np.float64)
    at = loss(w, m)
    for _ in range(15):
        p = logistic(m)
        gradient = (weight * (y - p)).astype(np.float32) @ z - ridge * w
        curve = weight * p * (1 - p) + 1e-6
        step, r = np.zeros_like(w), gradient.copy()
        d, rr = r.copy(), r @ r
        first = rr
        for _ in range(40):
            if rr <= 1e-4 * first or rr < 1e-12:
                break
            hd = (curve * (z @ d.astype(np.float32))).astype(np.float32) @ z + ridge * d
            a = rr / (d @ hd)
            step += a * d
            r -= a * hd
            rr, before = r @ r, rr
            d = r + rr / before * d
        along, size = (z @ step.astype(np.float32)).astype(np.float64), 1.0
        while loss(w + size * step, m + size * along) > at and size > 1e-3:
            size /= 2
        w, m = w + size * step, m + size * along
        gain, at = at - loss(w, m), loss(w, m)
        if gain < 1e-4 * max(1.0, at):
            break
    line.weights = w
    return line


def combined(scores: np.ndarray, y: np.ndarray, penalty: float = 0.1) -> np.ndarray:
    """Offset and weights that turn one or more scores into log-odds: a logistic fit with
    smoothed targets and halved steps where a full one overshoots."""
    x = np.concatenate([np.ones((len(y), 1)), np.clip(scores, -30, 30)], axis=1)
    up, down = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    prior = np.r_[0.0, np.full(scores.shape[1], 1 / scores.shape[1])]
    ridge = np.r_[1e-3, np.full(scores.shape[1], penalty)]

    def loss(w: np.ndarray) -> float:
        m = x @ w
        return float((np.logaddexp(0, m) - target * m).sum() + 0.5 * (ridge * (w - prior) ** 2).sum())

    w = prior.copy()
    for _ in range(50):
        p = logistic(x @ w)
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(ridge), x.T @ (target - p) - ridge * (w - prior))
        size, at = 1.0, loss(w)
        while size > 1e-6 and loss(w + size * step) > at:
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return w


@dataclass
class CoTrained:
    """Both views, how they combine, and where to cut."""

    views: Views
    content: Line
    metadata: Line
    mix: np.ndarray  # offset, weight of the content view, weight of the metadata view
    cut: float
    rounds: list[tuple[int, int]]  # pseudo-labels given to (content, metadata) in each round
    past: list[Round]  # what decided them

    def score(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        a, b = (np.clip(x, -30, 30) for x in (self.content.logit(content), self.metadata.logit(metadata)))
        return self.mix[0] + self.mix[1] * a + self.mix[2] * b


# ---- what the pool is told -------------------------------------------------------------

BINS = 512  # bins of log-odds that a teacher's certainty is counted in
MOST = 30.0


@dataclass
class Round:
    """The models a round began with, and the bin from which on each learner is told a class."""

    lines: dict[str, Line]
    sure: float
    cuts: dict[tuple[str, int], int]


def certainty(line: Line, part: Part, sure: float) -> tuple[np.ndarray, np.ndarray]:
    """Class that a teacher leans to, and the bin of its certainty; below 0: less than ``sure``."""
    logit = line.slope * part.raw(line.head(part.dense), line.weights) + line.offset
    least = np.log(sure / (1 - sure))
    place = np.floor((np.minimum(np.abs(logit), MOST) - least) / (MOST - least) * BINS).astype(int)
    return (logit > 0).astype(int), np.minimum(place, BINS - 1)


def told(parts: dict[str, Part], past: list[Round]) -> dict[str, np.ndarray]:
    """Pseudo-label of every row for either learner after these rounds; -1 where it has none."""
    n = len(parts["content"].dense)
    out = {v: np.full(n, -1) for v in VIEWS}
    for r in past:
        for teacher, learner in TEACHES:
            y, place = certainty(r.lines[teacher], parts[teacher], r.sure)
            cut = np.where(y == 1, r.cuts[learner, 1], r.cuts[learner, 0])
            new = (out[learner] < 0) & (place >= 0) & (place >= cut)
            out[learner][new] = y[new]
    return out


def sure_rows(parts: dict[str, Part], past: list[Round], lines: dict[str, Line], sure: float) -> dict[str, np.ndarray]:
    """How many rows that a learner was not told about fall into each bin, by learner and class."""
    before, out = told(parts, past), {"rows": np.array([len(parts["content"].dense)], float)}
    for teacher, learner in TEACHES:
        y, place = certainty(lines[teacher], parts[teacher], sure)
        for c in (0, 1):
            out[f"{learner}:{c}"] = np.bincount(place[(before[learner] < 0) & (y == c) & (place >= 0)], minlength=BINS).astype(float)
    return out


def losses(parts: dict[str, Part], past: list[Round], asked: dict[str, tuple[Line, np.ndarray]], steps: tuple[float, ...]) -> dict[str, np.ndarray]:
    """Loss and gradient of the rows each learner was told about, at every size of its step."""
    labels, out = told(parts, past), {}
    for view, (line, step) in asked.items():
        part, y = parts[view], labels[view]
        head, weight = line.head(part.dense), (y >= 0).astype(float)
        base, along = part.raw(head, line.weights), part.raw(head, step)
        columns = len(line.weights) - head.shape[1]
        for i, size in enumerate(steps):
            m = base + size * along
            loss = (weight * (np.logaddexp(0, m) - y * m)).sum()
            out[f"{view}:{i}"] = np.r_[loss, part.gradient(head, weight * (logistic(m) - y), columns)]
    return out


Kernel = Callable[[dict[str, Part]], dict[str, np.ndarray]]


def over(pool: DataFrame, kernel: Kernel) -> dict[str, np.ndarray]:
    """Sums of ``kernel`` over the table of features: each task adds up its batches, and a shuffle
    by name and position the tasks, so only model-sized totals reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[str, np.ndarray] = {}
        for whole in batches:
            for batch in (whole.slice(i, 4096) for i in range(0, whole.num_rows, 4096)):
                for name, values in kernel({v: Part.of(batch, v) for v in VIEWS}).items():
                    acc[name] = acc[name] + values if name in acc else values
        for name, values in acc.items():
            yield pa.record_batch([pa.array([name] * len(values)), pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["name", "pos", "value"])

    parts = pool.mapInArrow(run, "name string, pos int, value double")
    sums = parts.groupBy("name", "pos").agg(F.sum("value").alias("value")).toArrow().sort_by("pos")
    names, values = np.array(sums.column("name").to_pylist()), sums.column("value").to_numpy()
    return {str(name): values[names == name] for name in np.unique(names)}


class Learner:
    """One view's fit: labelled rows at hand, sums over the pool asked for.

    Quasi-Newton steps: the curvature starts as that of the labelled rows and is mended by the
    gradients seen.  Every pass tries several sizes of a step, so each either lowers the loss or
    ends the fit."""

    def __init__(self, line: Line, x: np.ndarray, y: np.ndarray, penalty: float = 0.5):
        self.line, self.z, self.y = line, line.inputs(x).astype(float), y
        self.ridge = np.full(self.z.shape[1], penalty)
        self.ridge[0] = 1e-3
        self.weight = 0.0  # of one row of the pool

    def at(self, weights: np.ndarray, pooled: np.ndarray) -> tuple[float, np.ndarray]:
        m = self.z @ weights
        loss = (np.logaddexp(0, m) - self.y * m).sum() + 0.5 * (self.ridge * weights**2).sum()
        gradient = (logistic(m) - self.y) @ self.z + self.ridge * weights
        return loss + self.weight * pooled[0], gradient + self.weight * pooled[1:]

    def begin(self, weight: float, pooled: np.ndarray) -> None:
        self.weight, self.pairs, self.done = weight, [], False
        self.loss, self.gradient = self.at(self.line.weights, pooled)
        p = logistic(self.z @ self.line.weights)
        curve = (self.z.T * (1.5 * (p * (1 - p) + 1e-3))) @ self.z
        self.inverse = np.linalg.inv(curve + np.diag(self.ridge))

    def step(self) -> np.ndarray:
        q, back = self.gradient.copy(), []
        for s, g in reversed(self.pairs):
            a = (s @ q) / (s @ g)
            back.append(a)
            q -= a * g
        q = self.inverse @ q
        for (s, g), a in zip(self.pairs, reversed(back)):
            q += (a - (g @ q) / (s @ g)) * s
        return -q

    def move(self, step: np.ndarray, steps: tuple[float, ...], pooled: list[np.ndarray]) -> None:
        tried = [(*self.at(self.line.weights + size * step, part), size) for size, part in zip(steps, pooled)]
        loss, gradient, size = min(tried, key=lambda t: t[0])
        self.done = not loss < self.loss - 1e-4 * max(1.0, abs(self.loss))
        if loss < self.loss:
            if (gradient - self.gradient) @ step > 0:
                self.pairs.append((size * step, gradient - self.gradient))
            self.line = replace(self.line, weights=self.line.weights + size * step)
            self.loss, self.gradient = loss, gradient


STEPS = (2.0, 1.0, 0.5, 0.125, 0.02)


def taught(learners: dict[str, Learner], pool: DataFrame, past: list[Round], weight: dict[str, float], passes: int) -> dict[str, Line]:
    """Both views fitted to their labelled rows and to what they were told."""
    asked = {v: (x.line, np.zeros_like(x.line.weights)) for v, x in learners.items()}
    start = over(pool, lambda parts: losses(parts, past, asked, (0.0,)))
    for v, x in learners.items():
        x.begin(weight[v], start[f"{v}:0"])
    for _ in range(passes):
        asked = {v: (x.line, x.step()) for v, x in learners.items() if not x.done}
        if not asked:
            break
        sums = over(pool, lambda parts, asked=asked: losses(parts, past, asked, STEPS))
        for v, (_, step) in asked.items():
            learners[v].move(step, STEPS, [sums[f"{v}:{i}"] for i in range(len(STEPS))])
    return {v: x.line for v, x in learners.items()}


def cut_at(counts: np.ndarray, most: float) -> tuple[int, int]:
    """Lowest bin that is told, and the rows told: bins from the surest down, whole, until there
    are ``most`` rows."""
    taken, cut = 0, BINS
    while cut > 0 and taken < most:
        cut -= 1
        taken += int(counts[cut])
    return cut, taken


def co_train(
    views: Views,
    content: np.ndarray,
    metadata: np.ndarray,
    label: np.ndarray,
    pool: DataFrame,
    rounds: int = 4,
    share: float = 0.1,
    sure: float = 0.97,
    spared: float = 0.01,
    passes: int = 5,
) -> CoTrained:
    """Fit on labelled rows, label 1 (keep) or 0 (reject), in a fixed order, and on the pool.

    Every third labelled row is kept back for calibration.  In a round each view offers, of the
    rows that the other was not told about, the surest, per class about ``share`` of the pool (whole
    bins of certainty, so that ties are told alike) and only with a probability of ``sure`` or more.
    They weigh half a labelled row and stay; all together they weigh at most half of the labelled
    rows, whatever the size of the pool.  The cut rejects at most ``spared`` of the good rows kept
    back, and nothing above even odds.
    """
    columns = dict(zip(VIEWS, views.columns()))
    x = {"content": content, "metadata": metadata}
    held = np.arange(0, len(label), 3)
    train = np.setdiff1d(np.arange(len(label)), held)

    def calibrated(view: str, line: Line) -> Line:
        offset, slope = combined(line.raw(x[view][held])[:, None], label[held])
        return replace(line, offset=offset, slope=slope)

    lines = {v: fitted(x[v][train], label[train], np.ones(len(train)), x[v].shape[1] - columns[v]) for v in VIEWS}
    learners = {v: Learner(lines[v], x[v][train], label[train]) for v in VIEWS}
    lines = {v: calibrated(v, line) for v, line in lines.items()}
    past: list[Round] = []
    counts, total = [], dict.fromkeys(VIEWS, 0)
    for _ in range(rounds):
        found = over(pool, lambda parts, lines=lines: sure_rows(parts, past, lines, sure))
        if not found:
            break  # nothing in the pool
        cuts, given = {}, dict.fromkeys(VIEWS, 0)
        for learner in VIEWS:
            for y in (0, 1):
                cuts[learner, y], n = cut_at(found[f"{learner}:{y}"], share * found["rows"][0])
                given[learner] += n
            total[learner] += given[learner]
        counts.append((given["content"], given["metadata"]))
        if not sum(counts[-1]):
            break
        past.append(Round(lines, sure, cuts))
        weight = {v: 0.5 * min(1.0, len(train) / max(1, total[v])) for v in VIEWS}
        lines = {v: calibrated(v, line) for v, line in taught(learners, pool, past, weight, passes).items()}
    a, b = (lines[v].logit(x[v][held]) for v in VIEWS)
    out = CoTrained(views, lines["content"], lines["metadata"], combined(np.stack([a, b], 1), label[held]), 0.0, counts, past)
    good = np.sort(out.score(content[held], metadata[held])[label[held] == 1])
    if len(good):
        out.cut = float(min(0.0, good[int(spared * len(good))]))
    return out


# ---- on tables -------------------------------------------------------------------------


def _features(rows: DataFrame, views: Views, carried: list[str]) -> DataFrame:
    """The features of both views: dense shares and column lists."""
    types = dict(rows.dtypes)
    schema = ", ".join([f"{k} {types[k]}" for k in carried] + ["c_dense array<float>, m_dense array<float>, c_own array<int>, m_own array<int>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                texts, langs, sources = (batch.column(c).to_pylist() for c in ("text", "lang", "source"))
                c = [views.content(t) for t in texts]
                m = [views.metadata(*r) for r in zip(texts, langs, sources)]
                yield pa.record_batch(
                    [
                        *(batch.column(k) for k in carried),
                        *(pa.array([[float(v) for v in r[0]] for r in part], pa.list_(pa.float32())) for part in (c, m)),
                        *(pa.array([r[1] for r in part], pa.list_(pa.int32())) for part in (c, m)),
                    ],
                    [*carried, "c_dense", "m_dense", "c_own", "m_own"],
                )

    return rows.mapInArrow(run, schema)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    labelled_rows: int = 8_000,
    vocabulary_size: int = 600,
    own_values: int = 256,
) -> CoTrained | None:
    """Fit on the labelled documents (label 1: keep) and on all the others.

    ``docs``: key, text, lang, source; ``labels``: key, label.  A key with contradicting labels
    counts as 0; null labels and keys are dropped.  At most ``labelled_rows`` keys are taken as labelled,
    each with one row (of rows with one key that with the smallest hash of its values); documents
    of any other key, or of none, are the pool.  None when a class has fewer than 10 rows.
    ``own_values``: languages and sources with a column of their own, by frequency in the
    labelled rows; the others are dealt to ``RARE`` columns by hash.
    """
    spread = F.xxhash64(F.col(key), F.lit("quality"))
    marked = labels.where(F.col("label").isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.min("label").cast("int").alias("label"))
    rows = docs.select(
        F.col(key).alias("key"), F.coalesce("text", F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source")
    )
    with recorded() as paths:
        try:
            return _fit(rows, marked.orderBy(spread, key).limit(labelled_rows).withColumnRenamed(key, "key"), vocabulary_size, own_values)
        finally:
            discard(docs.sparkSession, paths)  # the model is all that is left of them


def _fit(rows: DataFrame, chosen: DataFrame, vocabulary_size: int, own_values: int) -> CoTrained | None:
    chosen = F.broadcast(materialize(chosen, "quality-labels"))  # at most labelled_rows
    place = F.xxhash64("text", "lang", "source")
    having = materialize(rows.join(chosen, "key").withColumn("place", place), "quality-having")
    first = having.groupBy("key").agg(F.min("place").alias("place"))  # one row a chosen key
    sample = materialize(having.join(F.broadcast(first), ["key", "place"]).dropDuplicates(["key"]), "quality-sample")

    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if min(sizes.get(0, 0), sizes.get(1, 0)) < 10:
        return None
    bare = F.array_distinct(F.transform(words(ascii_lower(F.col("text"))), lambda w: F.btrim(w, F.lit(EDGE))))
    seen = sample.select("label", F.explode(bare).alias("word")).where("word <> ''")
    counts = seen.groupBy("word").agg(F.sum(F.col("label")).alias("up"), F.sum(1 - F.col("label")).alias("down"))
    # words by the chi-square of their presence
    n1, n0, up, down = float(sizes[1]), float(sizes[0]), F.col("up"), F.col("down")
    gap = up * (n0 - down) - down * (n1 - up)
    square = gap * gap / ((up + down) * (n1 + n0 - up - down) + 0.5)
    best = counts.where("up + down >= 5").orderBy(F.desc(square), "word").limit(vocabulary_size)
    vocabulary = {r["word"]: i for i, r in enumerate(best.select("word").collect())}
    values = {}
    for column in ("lang", "source"):
        top = sample.where(F.col(column).isNotNull()).groupBy(column).count().orderBy(F.desc("count"), column).limit(own_values).collect()
        values[column] = {r[column]: i + 1 for i, r in enumerate(top)}
    views = Views(vocabulary, values["lang"], values["source"])
    found = _features(sample, views, ["key", "label"]).orderBy(F.xxhash64("key", F.lit("order")), "key").collect()
    content, metadata = (design([(r[f"{v}_dense"], r[f"{v}_own"]) for r in found], n) for v, n in zip("cm", views.columns()))
    pool = materialize(_features(rows.join(chosen, "key", "left_anti"), views, []), "quality-pool")
    return co_train(views, content, metadata, np.array([r["label"] for r in found]), pool)


def score_quality(docs: DataFrame, model: CoTrained | None, prefix: str = "") -> DataFrame:
    """Adds content, metadata and score (probabilities) and kept to every document, with
    ``prefix`` before these names; columns that had them are replaced.

    Null and empty texts, languages and sources have features like any other.  Without a model
    (too few labels) the probabilities are null and every document is kept.  Repeated rows stay.
    """
    new = [prefix + c for c in ("content", "metadata", "score", "kept")]
    docs = docs.drop(*new)
    if model is None:
        return docs.select("*", *[F.lit(None).cast("double").alias(c) for c in new[:3]], F.lit(True).alias(new[3]))
    views = model.views
    sizes = views.columns()
    model = replace(model, past=[])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                texts, langs, sources = (batch.column(c).to_pylist() for c in ("text", "lang", "source"))
                texts = [t or "" for t in texts]
                c = design([views.content(t) for t in texts], sizes[0])
                m = design([views.metadata(*r) for r in zip(texts, langs, sources)], sizes[1])
                score = model.score(c, m)
                yield pa.record_batch(
                    [
                        *batch.columns,
                        pa.array(logistic(model.content.logit(c))),
                        pa.array(logistic(model.metadata.logit(m))),
                        pa.array(logistic(score)),
                        pa.array(score >= model.cut),
                    ],
                    [*batch.schema.names, *new],
                )

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    added = ", ".join(f"`{c}` {t}" for c, t in zip(new, ("double", "double", "double", "boolean")))
    return docs.mapInArrow(run, f"{schema}, {added}")


def quality_labels(labels: DataFrame) -> DataFrame:
    """A document is good when its quality is 1 and it is not marked toxic."""
    good = F.when(F.col("quality").isNotNull(), ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int"))
    return labels.select("doc_id", good.alias("label"))


def op6(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents") if docs is None else docs
    model = fit_quality(docs, quality_labels(table(spark, sf_dir, "labels")))
    scored = score_quality(docs.select("doc_id", "text", "lang", "source"), model)
    return scored.select("doc_id", "content", "metadata", "score", "kept")


QUERIES = {"op6_quality": (op6, None)}
