"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM.

The kernel compares two units (a word, or single letters that were spread out)
by their common subsequences of three letters, each weighted by LAMBDA to the
power of its span; gaps lower the weight but do not lose the match, so inserted
letters and gaps keep a unit near its plain form. Units of two letters have
subsequences of two, and are near each other only. Since the decision function
is linear in the kernel values against the landmarks, it folds into one weight
for each letter triple, and a unit is scored by summing over its own triples:
exactly the kernel machine, without a loop over landmarks.

The training rows are the labelled texts, as in a multiple-instance machine: of
a toxic text, the units above zero under the machine so far are toxic, or else
its highest one, and every unit of a text without the label is not toxic. What
a text speaks through are its witnesses: those units, and the highest one of a
text without the label. Each round reads all units of all labelled texts, takes the new
witnesses of both labels into the working set and trains again, until no
witness is new or ROUNDS is reached. The first machine starts from units that
are frequent in one label; they only begin the working set. A unit's weight on
the toxic side is the number of toxic texts it speaks for, less one, beyond EXCESS
times what chance gives it (its share of the texts without the label), scaled so
that both labels weigh alike: words that are merely frequent weigh nothing,
and words that are a little telling get values between the two sides.

A document's score is a logistic function of its highest unit, of how many
distinct units reach each of CUTS, and of how many it has: one insult decides,
and so do several words that each tell a little.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import in_parts, share_of, stage, table

LAMBDA = 0.6
#: Numbers of letters; the last RARE of them are shared by letters that are rare in training or unseen.
LETTERS, RARE = 128, 32
#: The most labelled documents that are learned from, the first by hash.
LABELLED_ROWS = 20_000
#: Units that begin the working set, by label; the rounds add the rest that matters.
POSITIVE_START, NEGATIVE_START = 1_500, 4_000
LANDMARKS, ROUNDS = 256, 4
#: Documents that count as seen without the label, for each unit.
PRIOR = 3.0
EXCESS = 2.0
#: Toxic texts beyond chance that a unit must be in to begin the working set, and to weigh on the toxic side later.
MARGIN, LATER = 2.0, 1.0
#: Values of units that a text's distinct tokens are counted above.
CUTS = np.array([-0.75, -0.5, -0.25, 0.0, 0.25, 0.5, 0.75, 1.0])
THRESHOLD = 0.7
LONGEST, PIECE, STEP = 16, 12, 4
KNOWN_TOKENS = 200_000
#: Rows of the working set that are trained on at a time.
BLOCK = 4096
_PART = re.compile(r"[^\W\d_]+")


def units_of(token: str) -> list[str]:
    """Units of a lower-cased token: its letters, joined over inserted signs, in pieces if long."""
    parts = _PART.findall(token)
    if len(parts) > 1:
        joined = "".join(parts)
        parts = [p for p in parts if len(p) > 1]
        parts.append(joined)
    out = []
    for p in parts:
        if len(p) <= LONGEST:
            out.append(p)
        else:
            out += [p[i : i + PIECE] for i in range(0, len(p) - PIECE + STEP, STEP)]
    return [u for u in out if len(u) > 1]


def tokens_of(text: str) -> list[str]:
    """Lower-cased tokens, and runs of three or more single letters as one more token each."""
    tokens = text.lower().split()
    short = [i for i, t in enumerate(tokens) if len(t) < 3]
    if len(short) > 2:
        run: list[str] = []
        last = -2
        for i in short:
            letters = "".join(_PART.findall(tokens[i]))
            if i != last + 1 or len(letters) > 1:
                if len(run) > 2:
                    tokens.append("".join(run))
                run = []
            if len(letters) == 1:
                run.append(letters)
            last = i
        if len(run) > 2:
            tokens.append("".join(run))
    return tokens


def _shared_letters() -> np.ndarray:
    """Numbers of code points that have none of their own."""
    return (LETTERS - RARE + np.arange(0x110000) % RARE).astype(np.uint8)


def alphabet(units: Iterable[str] = ()) -> np.ndarray:
    """Numbers of all code points: one each from 1 for a-z and then for the letters most frequent in ``units``, shared ones for the rest."""
    seen = Counter("".join(units))
    own = [chr(c) for c in range(97, 123)]
    own += [c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0])) if not "a" <= c <= "z"][: LETTERS - RARE - 1 - len(own)]
    table_ = _shared_letters()
    table_[[ord(c) for c in own]] = np.arange(1, len(own) + 1)
    return table_


PLAIN = alphabet()


def _codes(units: list[str], n: int, letters: np.ndarray) -> np.ndarray:
    return letters[np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)].reshape(len(units), n).astype(np.int64)


_triples: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}


def _places(n: int):
    """All i < j < k below n and their weights."""
    if n not in _triples:
        i, j, k = (x.astype(np.int64) for x in np.array([(a, b, c) for a in range(n) for b in range(a + 1, n) for c in range(b + 1, n)]).T)
        _triples[n] = i, j, k, LAMBDA ** (k - i + 1.0)
    return _triples[n]


def _self_kernel(codes: np.ndarray) -> np.ndarray:
    """The kernel of each row with itself, by the usual recursion over prefixes."""
    n = codes.shape[1]
    same = (codes[:, :, None] == codes[:, None, :]) * LAMBDA**2
    decay = np.where(np.arange(n) >= np.arange(n)[:, None], LAMBDA ** np.maximum(0, np.arange(n) - np.arange(n)[:, None]), 0.0)
    before = np.ones_like(same)
    for _ in range(min(n, 3) - 1):
        full = decay.T @ (same * before) @ decay
        before = np.zeros_like(full)
        before[:, 1:, 1:] = full[:, :-1, :-1]
    return (same * before).sum(axis=(1, 2))


def _by_length(units: list[str], letters: np.ndarray, rows: int = 20_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in ``units``, codes) for units of one length, some thousand at a time."""
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        step = max(1, rows * 8 // int(n))
        for b in range(0, len(at), step):
            yield at[b : b + step], _codes([units[i] for i in at[b : b + step]], int(n), letters)


def _features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Triple numbers and weights of each row; weights make the row's kernel with itself 1. A pair stands as a triple that ends in 0."""
    if codes.shape[1] == 2:
        return (codes[:, :1] * LETTERS + codes[:, 1:]) * LETTERS, np.ones((len(codes), 1))
    i, j, k, w = _places(codes.shape[1])
    number = (codes[:, i] * LETTERS + codes[:, j]) * LETTERS + codes[:, k]
    return number, w / np.sqrt(_self_kernel(codes))[:, None]


@dataclass
class Machine:
    weights: np.ndarray  # by triple
    bias: float
    letters: np.ndarray
    calibration: np.ndarray = None

    def __getstate__(self) -> tuple:
        """Only weights and letters that differ from the rest: what travels is kept on every disk, once a job."""
        held, own = np.flatnonzero(self.weights), np.flatnonzero(self.letters != _shared_letters())
        return held.astype(np.int32), self.weights[held], self.bias, own.astype(np.int32), self.letters[own], self.calibration

    def __setstate__(self, state: tuple) -> None:
        held, weights, self.bias, own, letters, self.calibration = state
        self.weights, self.letters = np.zeros(LETTERS**3), _shared_letters()
        self.weights[held], self.letters[own] = weights, letters

    def decide(self, units: list[str]) -> np.ndarray:
        out = np.empty(len(units))
        for at, codes in _by_length(units, self.letters):
            number, weight = _features(codes)
            out[at] = (self.weights[number] * weight).sum(axis=1) + self.bias
        return out


def kernel(a: list[str], b: list[str], letters: np.ndarray = PLAIN) -> np.ndarray:
    """Normalised kernel values of all of ``a`` against ``b``; units have 2 letters or more."""
    seen: dict[int, int] = {}
    parts = []
    for at, codes in _by_length(b, letters):
        number, weight = _features(codes)
        for row, num, w in zip(at, number, weight, strict=True):
            parts.append((row, [seen.setdefault(x, len(seen)) for x in num.tolist()], w))
    against = np.zeros((len(seen) + 1, len(b)))
    for row, at, w in parts:
        np.add.at(against[:, row], at, w)
    place = np.full(LETTERS**3, len(seen))
    place[list(seen)] = list(seen.values())
    out = np.empty((len(a), len(b)))
    for at, codes in _by_length(a, letters, 200):
        number, weight = _features(codes)
        out[at] = np.einsum("rt,rtm->rm", weight, against[place[number]])
    return out


def _variants(unit: str) -> list[str]:
    """The unit with a letter put in at two places and with a letter doubled."""
    n = len(unit)
    pick = sum(map(ord, unit))
    first, second = 1 + pick % (n - 1), 1 + (pick // 7) % (n - 1)
    return [unit[:first] + "xqzj"[pick % 4] + unit[first:], unit[:second] + unit[second - 1] + unit[second:]]


def train(units: list[str], toxic: np.ndarray, clean: np.ndarray, letters: np.ndarray = PLAIN, ridge: float = 1.0, steps: int = 30) -> Machine:
    """A squared-hinge SVM over Nyström features; ``toxic`` and ``clean`` weigh each unit's two labels."""
    order = np.argsort(-(toxic - clean), kind="stable")
    positive = [int(i) for i in order if toxic[i] > clean[i]]
    marks = [units[i] for i in positive[: LANDMARKS * 3 // 4]]
    marks += [units[int(i)] for i in np.argsort(-clean, kind="stable")][: LANDMARKS - len(marks)]
    marks = list(dict.fromkeys(marks))
    rows, up, down = list(units), list(toxic), list(clean)
    for i in positive:
        for v in _variants(units[i]):
            rows.append(v)
            up.append(toxic[i] / 4)
            down.append(0.0)
    values, vectors = np.linalg.eigh(kernel(marks, marks, letters))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    # weights grow with the square root, so frequent words do not drown the rest
    sides = [(y, np.sqrt(np.asarray(c, float))) for y, c in ((1.0, up), (-1.0, down))]
    blocks = [(slice(i, i + BLOCK), (kernel(rows[i : i + BLOCK], marks, letters) @ root).astype(np.float32)) for i in range(0, len(rows), BLOCK)]
    w = np.zeros(root.shape[1] + 1)
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        left, right = np.diag(penalty), np.zeros(len(w))
        for at, features in blocks:
            z = np.hstack([features, np.ones((len(features), 1), np.float32)]).astype(float)
            reached = z @ w
            for y, c in sides:
                active = (y * reached < 1) & (c[at] > 0)
                za = z[active] * c[at][active, None]
                left, right = left + za.T @ z[active], right + y * za.sum(axis=0)
        new = np.linalg.solve(left, right)
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    beta = root @ w[:-1]
    weights = np.zeros(LETTERS**3)
    for at, codes in _by_length(marks, letters):
        number, weight = _features(codes)
        np.add.at(weights, number, weight * beta[at][:, None])
    return Machine(weights, float(w[-1]), letters)


class _Reader:
    """Document features under a machine; values of tokens are kept while they are few."""

    def __init__(self, machine: Machine):
        self.machine, self.known = machine, {}

    def witnesses(self, listed: list[list[str]], toxic: list[int]) -> list[list[str]]:
        """Of each text's units the highest, of equal ones the first listed, and of a toxic text all above zero."""
        missing = list({u for units in listed for u in units if u not in self.known})
        if len(self.known) + len(missing) > KNOWN_TOKENS and self.known:
            self.known = {}
            missing = list({u for units in listed for u in units})
        if missing:
            self.known.update(zip(missing, self.machine.decide(missing).tolist(), strict=True))
        value = self.known.__getitem__
        return [[u for u in units if bad and value(u) > 0] or ([max(units, key=value)] if units else []) for units, bad in zip(listed, toxic, strict=True)]

    def features(self, texts: list[str | None]) -> np.ndarray:
        listed = [tokens_of(t) if t else [] for t in texts]
        missing = {w for t in listed for w in t if w not in self.known}
        if len(self.known) + len(missing) > KNOWN_TOKENS and self.known:
            self.known = {}
            missing = {w for t in listed for w in t}
        names, parts = list(missing), []
        for k, w in enumerate(names):
            parts += [(k, u) for u in units_of(w)]
        best = np.full(len(names), -2.0)
        if parts:
            np.maximum.at(best, [k for k, _ in parts], self.machine.decide([u for _, u in parts]))
        self.known.update(zip(names, best.tolist(), strict=True))
        out = np.zeros((len(texts), N_FEATURES))
        for i, t in enumerate(listed):
            times = Counter(t)
            f = np.fromiter(map(self.known.__getitem__, times), np.float64, len(times)) if t else np.full(1, -2.0)
            n = np.fromiter(times.values(), np.int64, len(times)) if t else np.ones(1, np.int64)
            above, reach = int(n[f > 0].sum()), len(f) - np.searchsorted(np.sort(f), CUTS, "right")
            out[i, :3] = max(-2.0, min(2.0, f.max())), np.log1p(above), above / n.sum()
            out[i, 3:] = [*np.log1p(reach), np.log1p(len(f)), *(reach[[1, 3, 5]] / len(f))]
        return out


#: The highest unit, two of all tokens above zero, the counts of distinct ones, their number, three shares.
N_FEATURES = 3 + len(CUTS) + 4


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        new = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        if np.abs(new - w).max() < 1e-8:
            break
        w = new
    return w


def labelled(labels: DataFrame, holdout: bool = True, most: int = LABELLED_ROWS) -> DataFrame:
    """(doc_id, toxic) of at most ``most`` labelled documents, toxic if any of its labels is."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    if holdout:
        rows = rows.where(share_of(F.col("doc_id"), 3) != 1)
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def _trained(working: dict[str, tuple[float, float]], toxic: int, clean: int, letters: np.ndarray) -> Machine:
    """``working`` has the texts of both labels that a unit speaks for; ``toxic`` and ``clean`` are all texts of each."""
    names = sorted(working)
    up, down = np.array([working[u] for u in names], float).T
    return train(names, np.maximum(0.0, up - LATER - EXCESS * down * toxic / clean) * clean / toxic, down + PRIOR, letters)


def _witnesses(held: DataFrame, machine: Machine) -> DataFrame:
    """(unit, toxic): the witnesses of the texts of ``held`` (units, toxic), with the number of toxic texts each speaks for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(machine)
        for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            toxic = batch.column(1).to_pylist()
            pairs = [(u, t) for units, t in zip(reader.witnesses(batch.column(0).to_pylist(), toxic), toxic, strict=True) for u in units]
            yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in pairs], pa.string()), pa.array([t for _, t in pairs], pa.int64())], ["unit", "toxic"])

    return held.mapInArrow(run, "unit string, toxic long").groupBy("unit").agg(F.sum("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, holdout: bool = True) -> Machine | None:
    """The machine learned from the labelled documents; None without both classes.

    What reaches the driver are the distinct witnesses and some features of
    the LABELLED_ROWS texts at most. Rows that share a labelled id are each
    learned from; a text is read whole, however long.
    """
    sample = stage(labelled(labels, holdout), "labelled")
    rows = stage(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", F.col("toxic").cast("int").alias("toxic")), "sample")

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, 0):
            units = [sorted({u for t in set(tokens_of(x or "")) for u in units_of(t)}) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(units, pa.list_(pa.string())), batch.column(1)], ["units", "toxic"])

    held = stage(rows.select("text", (F.col("toxic") > 0).cast("long").alias("toxic")).mapInArrow(part, "units array<string>, toxic long"), "units")
    counts = held.select(F.explode("units").alias("unit"), "toxic").groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
    counts = stage(counts, "counts")
    n_toxic, n_clean = (int(x or 0) for x in held.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first())
    if not n_toxic or not n_clean:
        return None
    up = (F.col("toxic") - MARGIN - F.col("clean") * F.lit(EXCESS * n_toxic / n_clean)) * F.lit(n_clean / n_toxic)
    begin = [
        counts.where(up > F.col("clean") + PRIOR).orderBy(F.desc(up - F.col("clean")), "unit").limit(POSITIVE_START),
        counts.where(F.col("clean") > 0).orderBy(F.desc("clean"), "unit").limit(NEGATIVE_START // 2),
        counts.where(F.col("clean") > 0).orderBy(F.xxhash64("unit"), "unit").limit(NEGATIVE_START // 2),
    ]
    working = {r["unit"]: (r["toxic"], r["clean"]) for p in begin for r in p.collect()}
    if not any(t for t, _ in working.values()):
        return None
    letters = alphabet(working)
    machine = _trained(working, n_toxic, n_clean, letters)
    for _ in range(ROUNDS):
        # a unit of one toxic text and no other tells nothing
        seen = _witnesses(held, machine).join(counts.select("unit", "clean"), "unit").where(F.col("clean") + F.col("toxic") > LATER).collect()
        fresh = any(r["unit"] not in working for r in seen)
        # a toxic text speaks through its present witnesses alone
        working = {u: (0, down) for u, (_, down) in working.items()}
        working.update({r["unit"]: (r["toxic"], r["clean"]) for r in seen})
        if not any(t for t, _ in working.values()):
            break
        machine = _trained(working, n_toxic, n_clean, letters)
        if not fresh:
            break

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(machine)
        for batch in in_parts(batches, 0):
            f = reader.features(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(f[:, k]) for k in range(N_FEATURES))], ["toxic", *names])

    names = [f"f{k}" for k in range(N_FEATURES)]
    seen = rows.select("text", "toxic").mapInArrow(read, "toxic int, " + ", ".join(f"{n} double" for n in names)).toPandas()
    machine.calibration = _logistic(seen[names].to_numpy(), (seen.toxic > 0).to_numpy(float))
    return machine


def score(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """``docs`` with x_score, 0 to 1.

    Only ``text`` enters the score: null and empty texts count as texts
    without units, repeated rows score alike, and a text is read whole,
    however long. Without a machine the score is
    0. Other columns pass through; a column x_score is replaced.
    """
    own = [c for c in docs.columns if c != "x_score"]
    if machine is None:
        return docs.select(*own).withColumn("x_score", F.lit(0.0))
    kinds = dict(docs.dtypes)
    at = own.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(machine)
        for batch in in_parts(batches, at):
            f = reader.features(batch.column(at).to_pylist())
            z = np.hstack([f, np.ones((len(f), 1))]) @ machine.calibration
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], [*own, "x_score"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in own) + ", x_score double"
    return docs.select(*own).mapInArrow(run, schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (share_of(F.col("doc_id"), 3) == 1).alias("held_out"), F.col("x_score").alias("score"), (F.col("x_score") >= THRESHOLD).cast("int").alias("predicted"))
