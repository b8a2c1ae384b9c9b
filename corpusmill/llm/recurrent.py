"""A gated recurrent language model that scores whole documents.

Tokens are lower-cased words and one end per document. The most frequent
tokens have embeddings (given as their inputs to the three gates) and sit in
classes of like frequency; the output is P(class | state) * P(token | class,
state), trained by backpropagation through windows of ``WINDOW`` steps with the
state carried from window to window. All other tokens share one class, inside
which a token has its smoothed share of the training counts, so every token of
the corpus counts, and unknown ones have a probability too.

Counts and backpropagation take every token of every training document. A
document is learned from in one of several rounds, whose number grows with the
logarithm of the tokens. In a round each partition of the staged documents is
a trainer over its own rows, so texts are not exchanged, and the weights are
averaged by a tree of grouped means.

The input is read once: documents are staged with the number of their block,
beside the words of each block. For scoring, documents meet the counts of
their own block's words only, so neither the vocabulary nor a document set is
held as a whole anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import in_parts, share_of, stage, table

END = b"\n"
SMOOTHING = 0.1
HEAD, CLASS, HIDDEN = 4096, 64, 16
#: Bytes of text that make a block, and blocks of a scoring task.
BLOCK_BYTES, TASK_BLOCKS = 16 << 20, 4
WINDOW, SEQUENCES = 32, 512
#: Steps that a stream is good for at least, by fewer sequences side by side.
LEAST_STEPS = 100
#: Rounds for a corpus of ROUND_TOKENS, and one more for each four times that.
ROUNDS, ROUND_TOKENS = 3, 50_000_000
#: Tokens that a trainer holds at a time.
CHUNK_TOKENS = 4_000_000
RATE = 0.015
SCORED_AT_ONCE, SCORED_WINDOW = 1024, 32
#: Steps whose outputs are computed together, at least.
SCORED_ROWS = 32_768
#: Rows of the output layer at a time.
OUTPUT_ROWS = 2048
#: Runs of equal tokens of up to so many rows are summed side by side.
SHORT_RUN = 16
FANOUT = 32
LOG10 = float(np.log(10.0))


def tokens_of(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z only) and the end."""
    out = text.encode().lower().split() if text else []
    out.append(END)
    return out


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts end to end, as ``tokens_of`` gives them but without ends, and how many each text has."""
    bare = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    parts = pc.ascii_split_whitespace(bare)
    sizes, blank = pc.list_value_length(parts).to_numpy().astype(np.int64), pc.equal(pc.binary_length(bare), 0)
    words = parts.flatten()
    # a blank text is split into one empty word
    if pc.any(blank).as_py():
        sizes[blank.to_numpy(zero_copy_only=False)] = 0
        words = words.filter(pc.greater(pc.binary_length(words), 0))
    return words.cast(pa.binary()), sizes


def places_of(texts: pa.Array, known: pa.Array, other: int | None = None, start: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The places in ``known`` of all tokens of texts end to end, and how many each text has.

    ``other`` stands for tokens that are not known; without it they are an
    error. With ``start`` each text has that place before its tokens.
    """
    words, sizes = words_of(texts)
    found = [pc.index_in(w, value_set=known) for w in (words, pa.array([END], pa.binary()))]
    if other is not None:
        found = [pc.fill_null(x, other) for x in found]
    elif any(x.null_count for x in found):
        raise KeyError("a token that is not among the known words")
    (places, end), ends = (x.to_numpy() for x in found), np.cumsum(sizes)
    if start is None:
        return np.insert(places, ends, end[0]), sizes + 1
    bounds = np.column_stack([ends - sizes, ends]).reshape(-1)
    return np.insert(places, bounds, np.tile(np.array([start, end[0]], places.dtype), len(sizes))), sizes + 2


class Shape:
    """Sizes of a model and the places of its parts in one flat vector."""

    def __init__(self, head: int):
        self.head, self.classes = head, -(-head // CLASS)
        h = HIDDEN
        parts = {"e": (head + 2, 3 * h), "u": (h, 3 * h), "wc": (h, self.classes + 1), "bc": (self.classes + 1,), "wo": (self.classes * CLASS, h), "bo": (self.classes * CLASS,)}
        self.parts, self.size = {}, 0
        for name, dims in parts.items():
            n = int(np.prod(dims))
            self.parts[name] = (slice(self.size, self.size + n), dims)
            self.size += n

    def view(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        return {k: flat[s].reshape(d) for k, (s, d) in self.parts.items()}

    def start(self, counts: np.ndarray, tail: float) -> np.ndarray:
        """Weights before training: the outputs' biases give the unigram model."""
        rng = np.random.default_rng(11)
        flat = (rng.standard_normal(self.size) * 0.1).astype(np.float32)
        p = self.view(flat)
        full = np.full(self.classes * CLASS, 1e-9)
        full[: self.head] = counts
        p["wo"][:] *= 0.3
        p["wc"][:] *= 0.3
        by_class = np.append(full.reshape(self.classes, CLASS).sum(axis=1), max(tail, 0.1))
        p["bc"][:] = np.log(by_class / by_class.sum())
        # places beyond the vocabulary keep a probability of next to nothing
        p["bo"][:] = np.maximum(-30.0, np.log(full / np.repeat(by_class[:-1], CLASS)))
        return flat


def _gates(p: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs and weights of update, reset and candidate, each in a piece and scaled so that exp() takes their sums: -x of a logistic function, -2x of tanh."""
    n = HIDDEN
    scale = np.array([-1, -1, -2], p["u"].dtype)[:, None, None]
    e, u = (np.multiply(p[k].reshape(-1, 3, n).transpose(1, 0, 2), scale, order="C") for k in "eu")
    return e, u[:2], u[2]


def _forward(p: dict, ids: np.ndarray, h: np.ndarray, keep: bool, gates: tuple | None = None):
    """States after each step of ids (steps, sequences); with ``keep`` also what backpropagation needs: states before the steps, gates and reset states.

    ``gates`` are those of ``_gates``, for weights that stay the same from call to call.
    """
    e, u, uc = gates or _gates(p)
    (steps, width), kind = ids.shape, e.dtype
    # take() and whole pieces: plain indexing of rows, and slices of rows in each step, take several times as long
    x = np.empty((3, steps, width, HIDDEN), kind)
    for k in range(3):
        np.take(e[k], ids, axis=0, out=x[k], mode="clip")
    states = np.empty((steps + 1, width, HIDDEN), kind)
    states[0] = h
    reset = np.empty((steps if keep else 1, width, HIDDEN), kind)
    pushed = np.empty((2, width, HIDDEN), kind)
    # a gate whose exp() is infinite is 0
    with np.errstate(over="ignore"):
        for t in range(steps):
            h, zr, new, rh = states[t], x[:2, t], x[2, t], reset[t if keep else 0]
            zr += np.matmul(h, u, out=pushed)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            np.multiply(zr[1], h, out=rh)
            new += np.matmul(rh, uc, out=pushed[0])
            np.exp(new, out=new)
            new += 1
            np.divide(2, new, out=new)
            new -= 1
            after = states[t + 1]
            np.subtract(new, h, out=after)
            after *= zr[0]
            after += h
    return states[1:], states[-1].copy(), (states[:-1], x, reset) if keep else None


def _by_class(states: np.ndarray, targets: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows in the order of their targets' classes: the order, the first row of each class, classes, and states with a one behind them, which takes the outputs' biases."""
    cls = (np.minimum(targets, shape.head) // CLASS).astype(_id_type(shape.classes))
    cls[targets >= shape.head] = shape.classes
    order = np.argsort(cls, kind="stable")
    first = np.cumsum(np.bincount(cls, minlength=shape.classes + 1))
    rows = np.ones((len(order), HIDDEN + 1), states.dtype)
    rows[:, :HIDDEN] = states.take(order, axis=0)
    return order, np.append(0, first[:-1]), cls.take(order), rows


def _outputs(p: dict) -> tuple[np.ndarray, np.ndarray, bool]:
    """Weights of classes and of tokens, each with its biases, and whether a logit can be absurd: states lie in -1 to 1."""
    wc, wo = np.vstack([p["wc"], p["bc"]]), np.column_stack([p["wo"], p["bo"]])
    highest = max((np.abs(p["wc"]).sum(axis=0) + p["bc"]).max(), (np.abs(p["wo"]).sum(axis=1) + p["bo"]).max())
    return wc, wo, bool(highest > 60.0)


def _weights(rows: np.ndarray, w: np.ndarray, absurd: bool, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """exp of the logits, their sums, log of each row's share at its place, and where the places are in the flat logits."""
    out = rows @ w
    if absurd:
        np.minimum(out, 60.0, out=out)
    at = np.arange(0, out.size, out.shape[1]) + places
    own = out.take(at)
    np.exp(out, out=out)
    total = out @ np.ones(out.shape[1], out.dtype)
    return out, total, own - np.log(total), at


def _slices(first: int, end: int):
    """A range in slices of OUTPUT_ROWS, whose logits stay in a core's cache."""
    return [slice(a, min(a + OUTPUT_ROWS, end)) for a in range(first, end, OUTPUT_ROWS)]


def _log_probabilities(p: dict, shape: Shape, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log of P(class) * P(token | class); for tail tokens of P(class) alone."""
    order, cuts, cls, rows = _by_class(states, targets, shape)
    wc, wo, absurd = _outputs(p)
    goal, found = targets[order], np.empty(len(order), states.dtype)
    for at in _slices(0, len(order)):
        found[at] = _weights(rows[at], wc, absurd, cls[at])[2]
    for c in range(shape.classes):
        own = wo[c * CLASS : (c + 1) * CLASS].T
        for at in _slices(cuts[c], cuts[c + 1]):
            found[at] += _weights(rows[at], own, absurd, goal[at] - c * CLASS)[2]
    out = np.empty_like(found)
    out[order] = found
    return out


def _gradients(p: dict, shape: Shape, g: dict, ids: np.ndarray, targets: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Adds the gradient of the mean loss of one window to ``g``; the state after it and the loss."""
    n = HIDDEN
    states, last, (before, gates, reset) = _forward(p, ids, h, keep=True)
    flat, goal = states.reshape(-1, n), targets.reshape(-1)
    scale = flat.dtype.type(1.0 / len(goal))
    order, cuts, cls, rows = _by_class(flat, goal, shape)
    wc, wo, absurd = _outputs(p)
    goal, sorted_down, loss, gwc = goal[order], np.empty((len(order), n), flat.dtype), 0.0, np.zeros_like(wc)

    def push(at: slice, w: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient of the logits of a slice but for a factor of each row, and these factors; adds its loss."""
        nonlocal loss
        prob, total, logs, own = _weights(rows[at], w, absurd, places)
        loss -= float(logs.sum())
        prob.reshape(-1)[own] -= total
        return prob, (scale / total)[:, None]

    back = np.ascontiguousarray(p["wc"].T)
    for at in _slices(0, len(order)):
        prob, factor = push(at, wc, cls[at])
        gwc += (prob.T @ (rows[at] * factor)).T
        np.multiply(prob @ back, factor, out=sorted_down[at])
    g["wc"] += gwc[:n]
    g["bc"] += gwc[n]
    for c in range(shape.classes):
        own = slice(c * CLASS, (c + 1) * CLASS)
        for at in _slices(cuts[c], cuts[c + 1]):
            q, factor = push(at, wo[own].T, goal[at] - c * CLASS)
            moved = q.T @ (rows[at] * factor)
            g["wo"][own] += moved[:, :n]
            g["bo"][own] += moved[:, n]
            sorted_down[at] += (q @ p["wo"][own]) * factor
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    down = sorted_down.take(back, axis=0).reshape(states.shape)
    dx = np.empty_like(gates)
    dh, drh, dgates = np.zeros_like(h), np.empty(h.shape, dx.dtype), np.empty((2, *h.shape), dx.dtype)
    ut = np.ascontiguousarray(p["u"].reshape(n, 3, n).transpose(1, 2, 0))
    for t in range(len(ids) - 1, -1, -1):
        (z, r, new), (dz, dr, dnew) = gates[:, t], dx[:, t]
        dh += down[t]
        old = 1 - z
        np.multiply(new, new, out=dnew)
        np.subtract(1, dnew, out=dnew)
        dnew *= z
        dnew *= dh
        np.matmul(dnew, ut[2], out=drh)
        np.subtract(new, before[t], out=dz)
        dz *= z
        dz *= old
        dz *= dh
        np.subtract(1, r, out=dr)
        dr *= reset[t]
        dr *= drh
        dh *= old
        drh *= r
        dh += drh
        np.matmul(dx[:2, t], ut[:2], out=dgates)
        dh += dgates[0]
        dh += dgates[1]
    steps = dx.reshape(3, -1, n)
    for k, source in enumerate((before, before, reset)):
        g["u"][:, k * n : (k + 1) * n] += source.reshape(-1, n).T @ steps[k]
    # rows of the embeddings that the window touches, each with its summed gradient
    flat_ids = ids.reshape(-1).astype(_id_type(shape.head))
    order = np.argsort(flat_ids, kind="stable")
    sorted_ids = flat_ids.take(order)
    starts = np.append(0, np.flatnonzero(sorted_ids[1:] != sorted_ids[:-1]) + 1)
    g["touched"] = sorted_ids[starts].astype(np.int64)
    g["rows"] = _sums(steps.take(order, axis=1), starts).transpose(1, 0, 2).reshape(-1, 3 * n)
    return last, loss * float(scale)


def _sums(rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of runs of rows (parts, rows, width) that begin at ``starts``: short runs side by side, a row of each at a time, long ones one by one."""
    sizes = np.diff(np.append(starts, rows.shape[1]))
    by_size = np.argsort(-sizes, kind="stable")
    sizes, first = sizes[by_size], starts[by_size]
    long = int((sizes > SHORT_RUN).sum())
    found = np.empty((rows.shape[0], len(starts), rows.shape[2]), rows.dtype)
    found[:, long:] = rows.take(first[long:], axis=1)
    for k in range(1, int(sizes[long]) if long < len(sizes) else 0):
        live = int((sizes > k).sum())
        found[:, long:live] += rows.take(first[long:live] + k, axis=1)
    ones = np.ones(int(sizes[0]), rows.dtype)
    for i in range(long):
        found[:, i] = ones[: sizes[i]] @ rows[:, first[i] : first[i] + sizes[i]]
    out = np.empty_like(found)
    out[:, by_size] = found
    return out


class Trainer:
    """Adam over truncated backpropagation, its moments kept from stream to stream; embeddings move where they are touched."""

    def __init__(self, flat: np.ndarray, shape: Shape, rate: float):
        self.flat, self.shape, self.rate, self.step = flat.copy(), shape, rate, 0
        self.m, self.v = np.zeros_like(flat), np.zeros_like(flat)
        self.grad = np.zeros_like(flat)
        self.dense = slice(shape.parts["e"][0].stop, shape.size)

    def learn(self, stream: np.ndarray) -> None:
        """One pass over a stream of ids, cut into lines side by side."""
        width = max(1, min(SEQUENCES, len(stream) // (LEAST_STEPS * WINDOW)))
        length = len(stream) // width
        if length < 2:
            return
        lines = stream[: width * length].reshape(width, length).T.astype(np.int64)
        p, g = self.shape.view(self.flat), self.shape.view(self.grad)
        em, ev = self.shape.view(self.m)["e"], self.shape.view(self.v)["e"]
        h = np.zeros((width, HIDDEN), np.float32)
        steps = max(1, -(-(length - 1) // WINDOW))
        for k, at in enumerate(range(0, length - 1, WINDOW)):
            goal = lines[at + 1 : at + 1 + WINDOW]
            self.step += 1
            self.grad[self.dense] = 0
            h, _ = _gradients(p, self.shape, g, lines[at : at + len(goal)], goal, h)
            dense, rows, touched = self.grad[self.dense], g["rows"], g["touched"]
            norm = float(np.sqrt(dense @ dense + (rows * rows).sum()))
            if norm > 1.0:
                dense *= 1.0 / norm
                rows *= 1.0 / norm
            now = np.float32(self.rate * (1 - 0.7 * k / steps) / (1 - 0.9**self.step))
            fix = np.float32(1 / np.sqrt(1 - 0.99**self.step))
            m, v = self.m[self.dense], self.v[self.dense]
            m += np.float32(0.1) * (dense - m)
            v += np.float32(0.01) * (dense * dense - v)
            self.flat[self.dense] -= now * m / (np.sqrt(v) * fix + np.float32(1e-6))
            rm = em[touched] * np.float32(0.9) + np.float32(0.1) * rows
            rv = ev[touched] * np.float32(0.99) + np.float32(0.01) * rows * rows
            em[touched], ev[touched] = rm, rv
            p["e"][touched] -= now * rm / (np.sqrt(rv) * fix + np.float32(1e-6))


def _staged(docs: DataFrame) -> DataFrame:
    """One table of both kinds of rows, from one read: documents (block, doc_id, text, learn) and words (block, word, n).

    A word's n is how often its block's training documents hold it.
    """
    kinds = dict(docs.dtypes)
    names = ["block", "doc_id", "text", "learn", "word", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, size = TaskContext.get().partitionId() << 24, 0
        #: Words of documents that are not learned from, and of those that are.
        held: tuple[list, list] = ([], [])

        def words(kind: pa.DataType) -> pa.RecordBatch:
            counted = pc.value_counts(pa.chunked_array(held[1], pa.binary()))
            own, n = counted.field(0), counted.field(1)
            rest = pc.unique(pa.chunked_array(held[0], pa.binary()))
            rest = rest.filter(pc.invert(pc.is_in(rest, value_set=own)))
            listed, n = pa.concat_arrays([own, rest]), pa.concat_arrays([n, pa.array(np.zeros(len(rest), np.int64))])
            k = len(listed)
            return pa.RecordBatch.from_arrays([pa.array(np.full(k, block)), pa.nulls(k, kind), pa.nulls(k, pa.string()), pa.nulls(k, pa.bool_()), listed, n], names)

        kind = None
        for batch in in_parts(batches, 1):
            kind, n, texts = batch.column(0).type, batch.num_rows, batch.column(1).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), batch.column(0), texts, batch.column(2), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())], names)
            for learn in (False, True):
                part = texts.filter(pc.equal(batch.column(2), learn))
                held[learn].extend((words_of(part)[0], pa.array([END] * len(part), pa.binary())))
            size += pc.sum(pc.utf8_length(texts)).as_py() or 0
            if size >= BLOCK_BYTES:
                yield words(kind)
                for x in held:
                    x.clear()
                block, size = block + 1, 0
        if kind is not None:
            yield words(kind)

    return stage(docs.select("doc_id", "text", "learn").mapInArrow(run, f"block long, doc_id {kinds['doc_id']}, text string, learn boolean, word binary, n long"), "staged", compression="zstd")


def _id_type(head: int) -> type:
    """Places of the head, of other tokens (``head``) and of the start (``head + 1``) fit into it."""
    return np.uint16 if head + 2 <= 1 << 16 else np.int32


def _averaged(parts: DataFrame, trainers: int) -> np.ndarray:
    """The mean of all weight vectors, by grouped means of FANOUT at a time."""
    # staged, all trainers run side by side; toLocalIterator alone would run one after another
    level = stage(parts, "weights")
    while trainers > FANOUT:
        trainers = -(-trainers // FANOUT)

        def mean(group: pa.Table) -> pa.Table:
            total, n = None, 0
            for raw, k in zip(group.column("weights"), group.column("n").to_pylist(), strict=True):
                x = np.frombuffer(raw.as_buffer(), np.float32) * np.float32(k)
                total, n = x if total is None else total + x, n + k
            return pa.table({"trainer": [group.column("trainer")[0].as_py()], "n": [n], "weights": pa.array([(total / np.float32(n)).tobytes()], pa.binary())})

        level = level.withColumn("trainer", F.pmod("trainer", F.lit(trainers))).groupBy("trainer").applyInArrow(mean, "trainer long, n long, weights binary")
    total, n = None, 0
    for r in level.toLocalIterator():
        x = np.frombuffer(bytes(r["weights"]), np.float32).astype(np.float64) * r["n"]
        total, n = x if total is None else total + x, n + r["n"]
    return None if total is None else (total / n).astype(np.float32)


class Model:
    def __init__(self, head: list[bytes], counts: np.ndarray, total: int, distinct: int):
        self.place, self.words = {w: i for i, w in enumerate(head)}, pa.array(head, pa.binary())
        self.head, self.total, self.distinct = len(head), total, distinct
        self.shape = Shape(len(head))
        self.tail = total - int(counts.sum())
        self.tail_distinct = distinct - len(head)
        self.flat = self.shape.start(counts + SMOOTHING, self.tail + SMOOTHING)

    def scores(self, docs: list[np.ndarray]) -> np.ndarray:
        """Natural-log probability of each sequence of head ids (``head`` for other tokens), states carried to its end."""
        p, out = self.shape.view(self.flat), np.zeros(len(docs))
        gates, held = _gates(p), []

        def put() -> None:
            """Adds the logarithms of all steps held."""
            of, states, goals = (np.concatenate(x) for x in zip(*held))
            out[:] += np.bincount(of, _log_probabilities(p, self.shape, states, goals), len(out))
            held.clear()

        sizes = np.array([len(d) for d in docs])
        order, rows = np.argsort(-sizes, kind="stable"), 0
        for b in range(0, len(order), SCORED_AT_ONCE):
            own = order[b : b + SCORED_AT_ONCE]
            long = sizes[own]
            # all sequences in a line, each behind a start
            line = np.concatenate([x for k in own for x in ([self.head + 1], docs[k])]).astype(np.int32)
            first = np.cumsum(long + 1) - long - 1
            h = np.zeros((len(own), HIDDEN), np.float32)
            for start in range(0, int(long[0]), SCORED_WINDOW):
                live = int((long > start).sum())
                step = np.arange(start, min(start + SCORED_WINDOW, int(long[0])))
                place = first[:live, None] + step
                real = (step < long[:live, None]).T
                given = np.where(real.T, line[np.minimum(place, len(line) - 1)], self.head)
                goal = line[np.minimum(place + 1, len(line) - 1)].T
                states, h, _ = _forward(p, np.ascontiguousarray(given.T), h[:live], keep=False, gates=gates)
                at = np.flatnonzero(real)
                held.append((own[at % live], states.reshape(-1, HIDDEN).take(at, axis=0), goal.take(at)))
                rows += len(at)
                # few sequences are long, and a window of few rows takes hardly less time than one of many
                if rows >= SCORED_ROWS:
                    put()
                    rows = 0
        if held:
            put()
        return out


def fit(texts: DataFrame, counts: DataFrame, head: int = HEAD) -> Model | None:
    """A model of the rows of (text, learn) marked ``learn``, with the counts of their words; None if they hold no token."""
    sums = counts.agg(F.sum("n"), F.count(F.when(F.col("n") > 0, 1))).first()
    if not sums[0]:
        return None
    top = counts.where("n > 0").orderBy(F.desc("n"), "word").limit(head).collect()
    model = Model([bytes(r["word"]) for r in top], np.array([r["n"] for r in top], np.float64), int(sums[0]), int(sums[1]))
    rounds = ROUNDS + max(0, int(np.log2(max(1.0, model.total / ROUND_TOKENS)))) // 2
    own = texts.where("learn").select("text")
    trainers, shape, head = max(1, own.rdd.getNumPartitions()), model.shape, model.words
    for k in range(rounds):
        flat, rate = model.flat, RATE * (1 - 0.8 * k / rounds)

        def learn(batches: Iterator[pa.RecordBatch], flat=flat, rate=rate) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            trainer, whole, held, n = Trainer(flat, shape, rate), 0, [], 0
            for batch in in_parts(batches, 0):
                ids, _ = places_of(batch.column(0), head, shape.head, shape.head + 1)
                held.append(ids.astype(_id_type(shape.head)))
                n += len(ids)
                if n >= CHUNK_TOKENS:
                    trainer.learn(np.concatenate(held))
                    whole, held, n = whole + n, [], 0
            if held:
                trainer.learn(np.concatenate(held))
            if whole + n:
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([whole + n], pa.int64()), pa.array([trainer.flat.tobytes()], pa.binary())], ["trainer", "n", "weights"])

        # copies of one text fall into one round
        part = own.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == k)
        new = _averaged(part.mapInArrow(learn, "trainer long, n long, weights binary"), trainers)
        model.flat = model.flat if new is None else new
    return model


def _known(staged: DataFrame) -> DataFrame:
    """The words of ``_staged``'s blocks with ``n`` summed over all blocks; ``first`` marks one row of each word.

    Sums and rows come from one exchange by word: a word has a row for each block at most.
    """
    each = Window.partitionBy("word")
    rows = staged.where("word is not null").select("block", "word", F.sum("n").over(each).alias("n"), (F.col("block") == F.min("block").over(each)).alias("first"))
    return stage(rows, "known", compression="zstd")


def score_staged(staged: DataFrame, counts: DataFrame, model: Model | None) -> DataFrame:
    """The scores of all documents of ``_staged`` under a model; without one both are those of the smoothed base."""
    return _scored(staged, staged.where("word is not null").select("block", "word").join(counts, "word").select("block", "word", "n"), model)


def _scored(staged: DataFrame, words: DataFrame, model: Model | None) -> DataFrame:
    """``score_staged`` for (block, word, n) of all words of each block."""
    total, distinct = (model.total, model.distinct) if model else (0, 0)
    kind = dict(staged.dtypes)["doc_id"]

    def score(texts: pa.Table, known: pa.Table) -> pa.Table:
        words, n = (known.column(c).combine_chunks() for c in ("word", "n"))
        n = n.to_numpy().astype(np.float64)
        # with the base's smoothing, in natural logs; a word without a row here cannot occur
        base = np.log((n + SMOOTHING) / (total + SMOOTHING * (distinct + 1)))
        # equal texts of a block have one score
        own = pc.dictionary_encode(pc.fill_null(texts.column("text").combine_chunks(), ""))
        rows = own.indices.to_numpy()
        places, sizes = places_of(own.dictionary, words)
        ids = np.split(places, np.cumsum(sizes)[:-1])
        lines = np.array([base[d].sum() for d in ids])
        logs = lines
        if model:
            head = pc.fill_null(pc.index_in(words, value_set=model.words), model.head).to_numpy()
            inner = np.log((n + SMOOTHING) / (model.tail + SMOOTHING * (model.tail_distinct + 1)))
            inner[head < model.head] = 0.0
            logs = model.scores([head[d] for d in ids]) + np.array([inner[d].sum() for d in ids])
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "n_tokens": pa.array(sizes[rows]),
                "n_known": pa.array(np.array([int((n[d] > 0).sum()) for d in ids], np.int64)[rows]),
                "train_tokens": pa.array(np.full(len(rows), total)),
                "base_score": pa.array(lines[rows] / LOG10),
                "score": pa.array(logs[rows] / LOG10),
            }
        )

    blocks = staged.where("word is not null").agg(F.countDistinct("block")).first()[0]
    tasks = max(int(staged.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-blocks // TASK_BLOCKS))
    own = words.repartition(tasks, "block")
    texts = staged.where("word is null").select(F.col("block").alias("of"), "doc_id", "text").repartition(tasks, "of")
    schema = f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.groupBy("of").cogroup(own.groupBy("block")).applyInArrow(score, schema)


def score_documents(docs: DataFrame, holdout: int = 10) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of each row of (doc_id, text).

    Learns from rows whose crc32(doc_id) modulo ``holdout`` is not 0; a null
    doc_id counts as empty text there. A null or empty text has one token, its
    end. Repeated rows are counted and scored one by one. If there is nothing
    to learn from, both scores are those of the smoothed base. An empty table
    gives an empty table. Other columns of ``docs`` are not read.
    """
    marked = docs.select("doc_id", "text").withColumn("learn", share_of(F.col("doc_id"), holdout) != 0)
    staged = _staged(marked)
    known = _known(staged)
    model = fit(staged.where("word is null").select("text", "learn"), known.where("first").select("word", "n"))
    return _scored(staged, known.select("block", "word", "n"), model)


def op2_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_documents(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", (share_of(F.col("doc_id"), 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
