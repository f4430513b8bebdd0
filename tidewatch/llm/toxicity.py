"""Operator 3: toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

Kernel: the gap-weighted subsequence kernel of length 3 (every common subsequence of three
characters counts, discounted by DECAY for each character it spans, at most SPAN of them), so
that gaps, inserted characters and unseen endings cost some similarity but not all of it; it is
normalised. Texts are compared unit by unit (a word, or letters set apart by spaces, run
together); a sentence counts as its most suspicious unit, and a document as its most suspicious
sentence.

Training (on a bounded sample of labelled rows): the units of a labelled document carry its
label. Positive examples are all units that toxic documents have more often than chance explains
(Fisher's exact test, one-sided, at a false discovery rate), weighted by their documents and by how sure the test is; those
that clean documents have too are negative examples as well. Landmarks are taken from those
units and from clean ones; k(x, Z) K^(-1/2) are the
features of a linear SVM (squared hinge, Newton's method), refitted once with the clean units
that come out worst. Platt scaling of the documents' margins makes scores.

Scoring: the SVM's sum over landmarks, sum_l a_l k(x, z_l), is one vector over subsequences, so
a unit's margin takes one look-up for each subsequence, whatever the number of landmarks.
"""

from __future__ import annotations

import math
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.arrow import batch_of, kept, sliced
from tidewatch.session import cut_lineage

#: Labelled rows that training takes at most, of either label.
TOXIC_ROWS, CLEAN_ROWS = 1500, 3000
#: Landmarks at most, clean units to train with, and clean units added for the second fit.
LANDMARKS, CLEAN_UNITS, HARD_UNITS = 192, 6000, 2000
DECAY, SPAN, WINDOW = 0.7, 8, 24
#: Expected share of chance finds among the units that tell of toxicity.
FALSE_SHARE = 0.25
#: Margins below this are all the same: clean.
FLOOR = -1.0
CACHE_ENTRIES = 400_000
TEXT_BYTES = 1 << 20
CLASSES = 64
#: Characters that stand in for letters.
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
SPACED = re.compile(r"(?<!\S)\S(?:\s\S){2,}(?!\S)")


def units_of(text: str) -> set[str]:
    """The distinct units of a text."""
    text = text.lower()
    units = set(text.split())
    units.update("".join(run.split()) for run in SPACED.findall(text))
    return units


def _classes() -> np.ndarray:
    """A class from 1 to 63 for each letter, 0 for what only fills gaps."""
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x80, 0x3000):
        if chr(c).isalpha():
            table[c] = 27 + c % (CLASSES - 27)
    table[0x3000:0xE000] = 27 + np.arange(0x3000, 0xE000) % (CLASSES - 27)
    for k in range(26):
        table[ord("a") + k] = 1 + k
    for c, letter in STAND_INS.items():
        table[ord(c)] = table[ord(letter)]
    return table


CLASS_OF = _classes()
#: Distances from the first to the second and from the second to the third character.
STEPS = [(a, b) for a in range(1, SPAN - 1) for b in range(1, SPAN - a)]


def windows(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of classes, WINDOW wide at most, and the unit of each row; long units give several."""
    lengths = np.fromiter(map(len, units), np.int64, len(units))
    codes = CLASS_OF[np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)]
    ends = np.cumsum(lengths)
    n = np.maximum(1, -(-(lengths - WINDOW) // (WINDOW // 2)) + 1)
    unit = np.repeat(np.arange(len(units)), n)
    k = np.arange(len(unit)) - np.repeat(np.cumsum(n) - n, n)
    start = (ends - lengths)[unit] + k * (WINDOW // 2)
    width = int(min(WINDOW, lengths.max(initial=0)))
    at = start[:, None] + np.arange(width)
    inside = at < ends[unit][:, None]
    return np.where(inside, codes[np.minimum(at, max(len(codes) - 1, 0))] if len(codes) else 0, 0), unit


def subsequences(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the subsequences of each row (0 where there is none), and their weights."""
    c = rows.astype(np.int32)
    numbers, weights = [], []
    for a, b in STEPS:
        n = c.shape[1] - a - b
        if n <= 0:
            continue
        x, y, z = c[:, :n], c[:, a:a + n], c[:, a + b:]
        numbers.append(np.where((x > 0) & (y > 0) & (z > 0), (x * CLASSES + y) * CLASSES + z, 0))
        weights.append(np.full(n, DECAY ** (a + b + 1)))
    if not numbers:
        return np.zeros((len(c), 1), np.int32), np.zeros(1)
    return np.concatenate(numbers, axis=1), np.concatenate(weights)


def norms(numbers: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The square roots of k(x, x): weights of equal subsequences add up first."""
    order = np.argsort(numbers, axis=1, kind="stable")
    sorted_, w = np.take_along_axis(numbers, order, 1), weights[order]
    w = np.where(sorted_ > 0, w, 0)
    new = np.ones(sorted_.shape, bool)
    new[:, 1:] = sorted_[:, 1:] != sorted_[:, :-1]
    new[:, 0] = True
    sums = np.add.reduceat(w.ravel(), np.flatnonzero(new.ravel()))
    row = np.flatnonzero(new.ravel()) // numbers.shape[1]
    return np.sqrt(np.bincount(row, sums**2, len(numbers)))


def features(units: list[str]) -> np.ndarray:
    """Explicit normalised features of a few units, as rows over all subsequences seen in them."""
    rows, unit = windows(units)
    keep = np.concatenate([[True], unit[1:] != unit[:-1]]) if len(unit) else np.zeros(0, bool)
    numbers, weights = subsequences(rows[keep])
    return numbers, weights / np.maximum(norms(numbers, weights), 1e-9)[:, None] * (numbers > 0)


def gram(left, right) -> np.ndarray:
    """k(x, z) of all x and z, by a table of one z at a time."""
    (numbers, weights), (others, other_weights) = left, right
    out = np.empty((len(numbers), len(others)))
    for j in range(len(others)):
        table = np.bincount(others[j], other_weights[j], CLASSES**3)
        out[:, j] = (table[numbers] * weights).sum(axis=1)
    return out


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM in the primal; ``y`` is -1 or 1."""
    z = np.column_stack([x, np.ones(len(x))])
    penalty = np.diag([ridge] * x.shape[1] + [1e-9])
    w = np.zeros(z.shape[1])
    active = np.ones(len(z), bool)
    for _ in range(50):
        a, c = z[active], weight[active][:, None]
        w = np.linalg.solve(a.T @ (a * c) + penalty, (a * c).T @ y[active])
        now = y * (z @ w) < 1
        if (now == active).all():
            break
        active = now
    return w[:-1], float(w[-1])


def fit_platt(margin: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve over margins, with Platt's smoothed targets."""
    pos, neg = toxic.sum(), (1 - toxic).sum()
    target = np.where(toxic == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    z, w = np.column_stack([margin, np.ones(len(margin))]), np.array([4.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - target) + 1e-3 * w
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), gradient)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


class Model:
    """Weights over subsequences, the SVM's offset, and the curve that makes scores."""

    def __init__(self, table: np.ndarray, offset: float, slope: float = 1.0, shift: float = 0.0):
        self.table, self.offset, self.slope, self.shift = table.astype(np.float32), offset, slope, shift

    def margins(self, units: list[str]) -> np.ndarray:
        """The SVM's margin of each unit, no lower than FLOOR."""
        out = np.full(len(units), FLOOR)
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        for low, high in ((2, 8), (8, 12), (12, 1 << 60)):
            some = np.flatnonzero((lengths > low) & (lengths <= high))
            for at in range(0, len(some), 4096):
                part = some[at:at + 4096]
                rows, unit = windows([units[k] for k in part])
                numbers, weights = subsequences(rows)
                total = (self.table[numbers] * weights).sum(axis=1)
                # k(x, x) is no smaller than this, so a margin is no larger than this makes it
                least = np.sqrt(((numbers > 0) * weights**2).sum(axis=1))
                close = np.flatnonzero((total > 0) & (total / np.maximum(least, 1e-9) + self.offset > FLOOR))
                if len(close):
                    exact = total[close] / norms(numbers[close], weights) + self.offset
                    np.maximum.at(out, part[unit[close]], exact)
        return out

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def disguised(unit: str) -> list[str]:
    """A unit set apart by dots, and with a character put in."""
    return [".".join(unit), unit[:len(unit) // 2] + "x" + unit[len(unit) // 2:]] if len(unit) > 4 else []


def telling(pairs: dict[tuple[int, int], int], toxic: int, clean: int) -> dict[tuple[int, int], float]:
    """Which units toxic documents have more often than chance explains, as (documents of theirs,
    clean documents) out of ``pairs``, which counts the units of each; with the logarithm of the
    chance, as a share of the best one's.

    Fisher's exact test, one-sided. The finds that chance makes up to a level are the sum, over
    all units, of the largest tail probability up to it which a unit in as many documents can
    have, so that units too rare to be found don't count. The level is the last at which they
    are FALSE_SHARE of all finds, or where there is none, the one with the smallest share.
    """
    log = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, toxic + clean + 1)))])
    tails = {}
    for n in {p + c for p, c in pairs}:
        k = np.arange(max(0, n - clean), min(n, toxic) + 1)
        mass = np.exp(log[toxic] - log[k] - log[toxic - k] + log[clean] - log[n - k] - log[clean - n + k]
                      - log[toxic + clean] + log[n] + log[toxic + clean - n])
        tails[n] = dict(zip(k.tolist(), np.cumsum(mass[::-1])[::-1].tolist()))
    # equal probabilities reached by different sums must sort as one
    level = {(p, c): round(math.log(max(tails[p + c][p], 1e-300)), 9) for p, c in pairs if p}
    if not level:
        return {}
    steps = np.array(sorted(set(level.values())))
    found, chance = np.zeros(len(steps)), np.zeros(len(steps))
    units_in = {}
    for (p, c), m in pairs.items():
        units_in[p + c] = units_in.get(p + c, 0) + m
        if p:
            found[np.searchsorted(steps, level[p, c]):] += m
    for n, m in units_in.items():
        tail = np.sort([round(math.log(max(x, 1e-300)), 9) for x in tails[n].values()])
        at = np.searchsorted(tail, steps, "right")
        chance += np.where(at > 0, np.exp(tail[np.maximum(at - 1, 0)]), 0) * m
    share = chance / found
    good = np.flatnonzero(share <= FALSE_SHARE)
    last = steps[good[-1] if len(good) else int(share.argmin())]
    return {k: x / min(steps[0], -1e-9) for k, x in level.items() if x <= last}


def fit_units(toxic: list[str], clean: list[str], weight: np.ndarray, both: dict[str, int] | None = None) -> Model:
    """The SVM over units; ``weight``: how many documents each toxic unit stands for. Disguised
    forms of the toxic units, at a tenth of the weight, are learnt along. ``both``: toxic units
    of clean documents, and how many; they count against the unit by the same measure."""
    both = both or {}
    forms = [(d, w / 10) for u, w in zip(toxic, weight) for d in disguised(u)]
    toxic = [*toxic, *(d for d, _ in forms)]
    weight = np.concatenate([weight, [w for _, w in forms]])
    order = np.argsort(-weight, kind="stable")[:LANDMARKS * 3 // 4]
    landmarks = [toxic[k] for k in order] + clean[:LANDMARKS - len(order)]
    units = [*toxic, *clean, *both]
    z = features(landmarks)
    values, vectors = np.linalg.eigh(gram(z, z))
    good = values > 1e-6 * values.max(initial=0)
    root = vectors[:, good] / np.sqrt(values[good])
    y = np.concatenate([np.ones(len(toxic)), -np.ones(len(clean) + len(both))])
    c = np.concatenate([np.log1p(weight), np.ones(len(clean)), np.log1p(np.array(list(both.values()), float))])
    told = np.concatenate([np.ones(len(toxic), bool), np.zeros(len(clean), bool), np.ones(len(both), bool)])
    c[told] *= max(1.0, len(clean) / max(c[y > 0].sum(), 1e-9) / 4)
    x = np.concatenate([gram(features(units[k:k + 4096]), z) for k in range(0, len(units), 4096)])
    w, offset = fit_svm(x @ root, y, c / c.sum() * 100)
    alpha = root @ w
    table = np.bincount(z[0].ravel(), (z[1] * alpha[:, None]).ravel(), CLASSES**3)
    table[0] = 0
    return Model(table, offset)


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc (a number), toxic and text of at most TOXIC_ROWS and CLEAN_ROWS documents."""
    per_doc = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
               .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = (per_doc.filter("toxic = 1").orderBy(*order).limit(TOXIC_ROWS)
              .unionAll(per_doc.filter("toxic = 0").orderBy(*order).limit(CLEAN_ROWS)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most TOXIC_ROWS + CLEAN_ROWS rows of two numbers
    return texts.join(F.broadcast(chosen), "doc_id").select(F.xxhash64("text").alias("doc"), "toxic", "text")


def train(docs: DataFrame, labels: DataFrame) -> Model | float:
    """Fit on labelled documents; the caller leaves held-out ones out of ``labels``.

    Copies of a text count once. A float stands for a model where only one label is there (its
    value), or none (0.0): every score is that.
    """
    schema = pa.schema([("doc", pa.int64()), ("toxic", pa.int32()), ("unit", pa.string())])

    def split(batches):
        for batch in sliced(batches, "text", TEXT_BYTES):
            for doc, toxic, text in zip(*(c.to_pylist() for c in batch.columns)):
                units = [u for u in units_of(text) if len(u) > 2]
                yield batch_of(schema, [doc] * len(units), [toxic] * len(units), units)

    units = cut_lineage(_sample(docs, labels).mapInArrow(split, "doc long, toxic int, unit string")
                        .groupBy("doc", "unit").agg(F.max("toxic").alias("toxic")), "toxic-units")
    totals = {r[0]: r[1] for r in units.groupBy("toxic").agg(F.countDistinct("doc")).collect()}
    if len(totals) < 2:
        return float(next(iter(totals), 0))
    counts = cut_lineage(units.groupBy("unit").agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg")),
                         "toxic-counts")
    pairs = {(r["pos"], r["neg"]): r["count"] for r in counts.groupBy("pos", "neg").count().collect()}
    chosen = telling(pairs, totals[1], totals[0])
    if not chosen:
        return 0.0                                     # no toxic document has a unit
    # a few kinds of counts; the units are among those of TOXIC_ROWS documents
    kinds = docs.sparkSession.createDataFrame(sorted(chosen), "pos long, neg long")
    told = {r["unit"]: r for r in counts.join(F.broadcast(kinds), ["pos", "neg"]).collect()}
    clean = counts.filter("neg > 0")
    half = CLEAN_UNITS // 2
    negatives = [r[0] for r in clean.orderBy(F.desc("neg"), "unit").limit(half).collect()]
    negatives += [r[0] for r in clean.orderBy(F.xxhash64("unit"), "unit").limit(half).collect()]
    positives = sorted(told)
    negatives = [u for u in dict.fromkeys(negatives) if u not in told]
    heavy = np.array([told[u]["pos"] * chosen[told[u]["pos"], told[u]["neg"]] for u in positives])
    both = {u: told[u]["neg"] for u in positives if told[u]["neg"]}
    model = fit_units(positives, negatives, heavy, both)

    def margins_of(batches, model=model):
        out = pa.schema([("unit", pa.string()), ("margin", pa.float64())])
        for batch in batches:
            yield batch_of(out, batch.column(0), model.margins(batch.column(0).to_pylist()))

    worst = clean.select("unit").mapInArrow(margins_of, "unit string, margin double").orderBy(F.desc("margin"), "unit")
    hard = [r[0] for r in worst.limit(HARD_UNITS).collect()]
    known = set(negatives)
    negatives += [u for u in dict.fromkeys(hard) if u not in told and u not in known]
    model = fit_units(positives, negatives, heavy, both)
    margins = (counts.select("unit").mapInArrow(lambda b: margins_of(b, model), "unit string, margin double"))
    per_doc = units.join(margins, "unit").groupBy("doc").agg(F.max("toxic"), F.max("margin")).collect()
    toxic, margin = (np.array([r[k] for r in per_doc], float) for k in (1, 2))
    model.slope, model.shift = fit_platt(margin, toxic)
    return model


def toxicity(docs: DataFrame, model: Model | float, keep: bool = False,
             names: tuple[str, str] = ("score", "margin")) -> DataFrame:
    """Score every whole text: doc_id, score (0 to 1) and margin, one row for each row.

    ``docs``: doc_id and text; nothing else enters the score. Null and empty texts, and texts
    without a unit of three letters, have the lowest margin. Repeated rows get equal scores; an
    empty table gives no rows. With ``keep``, the columns of ``docs`` come first instead of
    doc_id alone; the two results, called ``names``, replace columns of those names.
    """
    if keep:
        rows = docs.drop(*names)
    else:
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    k = [c.lower() for c in rows.columns].index("text")
    out = rows.columns if keep else ["doc_id"]
    if isinstance(model, float):
        return rows.select(*out, F.lit(model).alias(names[0]), F.lit(FLOOR).alias(names[1]))
    fields = [*rows.schema, *(T.StructField(name, T.DoubleType()) for name in names)]
    shared = docs.sparkSession.sparkContext.broadcast(model)      # CLASSES**3 numbers
    token = uuid.uuid4().hex

    def score(batches):
        model = shared.value
        known = kept(("margins", token), dict)
        for batch in batches:
            texts = batch.column(k)
            batch = pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "whole text"])
            for part in sliced([batch], "whole text", TEXT_BYTES):
                split = [units_of(t) for t in part.column(part.num_columns - 1).to_pylist()]
                new = list(set().union(*split).difference(known))
                if len(known) + len(new) > CACHE_ENTRIES:
                    known.clear()
                    new = list(set().union(*split))
                known.update(zip(new, model.margins(new).tolist()))
                get = known.__getitem__
                margin = np.array([max(map(get, units), default=FLOOR) for units in split], float)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(model.score(margin)), pa.array(margin)],
                    names=[*part.schema.names[:-1], *names])

    return rows.mapInArrow(score, T.StructType(fields)).select(*out, *names)
