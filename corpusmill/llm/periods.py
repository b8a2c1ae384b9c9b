"""Periodic runs of words by partition refinement.

Positions of a text are kept in classes of equal factors. The classes of
length 1 are the words; those of length l + 1 come from those of length l by
splitting each class by the classes of its members' successors. Only the
smaller children of a split have to be looked at in the next step (all but one
largest), so a text of n words takes O(n log n) moves. Where two neighbours of
a class of length l stand l words apart a square begins, and squares that
begin one after the other are one run. Neighbours cannot stand closer together
and yet be missed: a factor that is itself a power has its next occurrence
nearer than its length, so each run is found at its smallest period only.

The first ``SHALLOW`` lengths, where almost every position still moves, are
refined for all texts of a slice at once with sorts; positions alone in their
class drop out there. What is left, texts that repeat long factors, goes on
text by text with linked classes and the smaller-half rule.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import in_parts, table

#: A run has at least this many words, and twice its period.
LEAST_WORDS = 12
#: Lengths that are refined for many texts at once.
SHALLOW = 8
#: Bytes of text that are refined at a time; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

ADDED = ("r_words", "r_runs", "r_collapsed")
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def plain_words(key, text: bytes) -> list[bytes]:
    """The words between space and U+0009 to U+000D; the key is not looked at."""
    return text.split()


def _streaks(at: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs whose squares begin at the ascending places ``at``."""
    cuts = np.flatnonzero(np.diff(at) != 1) + 1
    first = at[np.concatenate([[0], cuts])]
    last = at[np.concatenate([cuts, [len(at)]]) - 1]
    return first, last - first + 2 * period


def _deeper(level: int, places: list[int], classes: list[int], hits: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """Runs with a period above ``level`` of one text.

    ``places`` and ``classes`` are the positions that share their factor of
    length ``level`` with others, ascending, and their class numbers from 0.
    ``hits`` are (successor's child, position) for those whose successor lies
    in a smaller child of the last split, ascending by position.
    """
    room = places[-1] + 2
    of, after, ahead = [-1] * (room + 1), [-1] * room, [-1] * room
    n_classes = max(classes) + 1
    size, head, tail = [0] * n_classes, [-1] * n_classes, [-1] * n_classes
    #: gap to the next of the class -> positions that had it; gaps only grow, so an entry is valid if the gap is still there
    gaps: dict[int, list[int]] = defaultdict(list)
    for i, c in zip(places, classes):
        of[i] = c
        size[c] += 1
        t = tail[c]
        if t < 0:
            head[c] = i
        else:
            after[t], ahead[i] = i, t
            if i - t > level:
                gaps[i - t].append(t)
        tail[c] = i
    queue: dict[int, list[int]] = defaultdict(list)
    for child, i in hits:
        queue[child].append(i + 1)
    todo, found = list(queue.values()), []
    while todo:
        level += 1
        split: dict[int, list[int]] = {}
        for members in todo:
            new: dict[int, int] = {}
            for j in members:
                i = j - 1
                c = of[i]
                # alone already, or never shared; of[-1] is the spare place at the end
                if c < 0 or (size[c] == 1 and c not in split):
                    continue
                d = new.get(c)
                if d is None:
                    d = new[c] = len(size)
                    size.append(0)
                    head.append(-1)
                    tail.append(-1)
                    split.setdefault(c, []).append(d)
                p, q = ahead[i], after[i]
                if q >= 0:
                    ahead[q] = p
                if p < 0:
                    head[c] = q
                else:
                    after[p] = q
                    if q >= 0 and q - p >= level:
                        gaps[q - p].append(p)
                t = tail[d]
                if t < 0:
                    head[d] = i
                else:
                    after[t] = i
                    if i - t >= level:
                        gaps[i - t].append(t)
                ahead[i], after[i] = t, -1
                tail[d] = i
                of[i] = d
                size[c] -= 1
                size[d] += 1
        todo = []
        for c, children in split.items():
            if size[c]:
                children.append(c)
            largest = max(children, key=size.__getitem__)
            for child in children:
                if child != largest:
                    members, i = [], head[child]
                    while i >= 0:
                        members.append(i)
                        i = after[i]
                    todo.append(members)
        squares = gaps.pop(level, None)
        if squares:
            at = sorted({i for i in squares if after[i] - i == level})
            if at:
                starts, lengths = _streaks(np.array(at), level)
                found += [(s, n, level) for s, n in zip(starts.tolist(), lengths.tolist()) if n >= least]
    return found


def runs_of(texts: list[list[bytes]], least: int = LEAST_WORDS) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, by start and then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    n = int(sizes.sum())
    if not n:
        return out
    codes = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
    text_of = np.repeat(np.arange(len(texts)), sizes)
    # one empty place behind each text, which no factor crosses
    first = np.cumsum(sizes + 1) - sizes - 1
    places = np.arange(n) + text_of
    key = text_of * len(codes.dictionary) + codes.indices.to_numpy(zero_copy_only=False)
    room = n + len(texts) + 1
    shared = np.full(room, -1, np.int64)
    for level in range(1, SHALLOW + 1):
        order = np.argsort(key, kind="stable")
        places, key = places[order], key[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        counts = np.diff(np.append(starts, len(key)))
        child = np.repeat(np.arange(len(starts)), counts)
        near = np.flatnonzero((child[1:] == child[:-1]) & (places[1:] - places[:-1] == level))
        if len(near):
            begins, lengths = _streaks(np.sort(places[near]), level)
            held = lengths >= least
            for s, m in zip(begins[held].tolist(), lengths[held].tolist()):
                t = int(np.searchsorted(first, s, "right")) - 1
                out[t].append((s - int(first[t]), m, level))
        # the smaller children of each parent, and those alone, split others in the next step
        parents = shared[places[starts]]
        by = np.lexsort((counts, parents))
        last_of_parent = np.append(parents[by][1:] != parents[by][:-1], True)
        small = np.ones(len(starts), bool)
        small[by[last_of_parent]] = False
        small[counts == 1] = True
        children = np.full(room, -1, np.int64)
        children[places] = child
        many = counts[child] > 1
        shared = np.full(room, -1, np.int64)
        shared[places[many]] = child[many]
        places = np.flatnonzero(shared >= 0)
        if not len(places):
            break
        if level < SHALLOW:
            places = places[shared[places + 1] >= 0]
            key = shared[places] * (len(starts) + 1) + shared[places + 1]
            if not len(places):
                break
    else:
        successor = children[places + 1]
        hit = (successor < 0) | small[successor]
        # a successor that was not shared one length before has no number; it is alone
        successor = np.where(successor < 0, len(small) + places, successor)
        owner = np.searchsorted(first, places, "right") - 1
        edges = np.flatnonzero(np.diff(owner)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(places)]):
            t = int(owner[a])
            own = places[a:b] - first[t]
            numbers = np.unique(shared[places[a:b]], return_inverse=True)[1]
            marked = hit[a:b]
            hits = list(zip(successor[a:b][marked].tolist(), own[marked].tolist()))
            out[t] += _deeper(SHALLOW, own.tolist(), numbers.tolist(), hits, least)
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    start, length, period = np.array(runs).T
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return [w for w, dropped in zip(words, (np.cumsum(change)[:-1] > 0).tolist()) if not dropped]


def find_runs(docs: DataFrame, least: int = LEAST_WORDS, words_of: Callable[[object, bytes], list[bytes]] = plain_words, key: str = "doc_id") -> DataFrame:
    """The columns of ``docs`` but text, and r_words, r_runs and r_collapsed.

    r_runs holds (start, length, period) of every run by start and period:
    stretches of at least ``least`` words and two periods that no neighbour
    extends, at their smallest period. r_collapsed is the text without what
    any run repeats after its first period, joined by single spaces.
    ``words_of`` makes the words of a row from its key and its text in UTF-8.
    A null text counts as empty: no words, no runs, an empty string. Rows are
    worked on one by one, so null keys and repeated rows do no harm; a text is
    taken whole, however long; an empty table gives an empty table. Columns
    that bear one of the three names are replaced.
    """
    taken = {"text", *ADDED}
    own = [c for c in docs.columns if c.lower() not in taken]
    if key not in docs.columns:
        raise ValueError(f"no column {key}")
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in own) + ", r_words long, r_runs array<struct<start:long,length:long,period:long>>, r_collapsed string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, len(own), SLICE_BYTES):
            keys = batch.column(own.index(key)).to_pylist()
            words = [words_of(k, (t or "").encode()) for k, t in zip(keys, batch.column(len(own)).to_pylist())]
            found = runs_of(words, least)
            cuts = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
            structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(_RUN))
            kept = pa.array([b" ".join(collapse(w, r)) for w, r in zip(words, found)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([len(w) for w in words], pa.int64()), pa.ListArray.from_arrays(cuts, structs), kept], [*own, *ADDED])

    return docs.select(*own, "text").mapInArrow(run, schema)


def planted_words(key, text: bytes) -> list[bytes]:
    """The words of a text, of which one text in ten repeats a stretch to its end.

    With h the crc32 of the key as decimal text (null: empty) and g = h div
    10, a text with h mod 10 = 0 and n words repeats, from word a = g mod n
    on, the 1 + (n - a) div (3 + g mod 8) words that begin there.
    """
    words = text.split()
    h = zlib.crc32(b"" if key is None else str(key).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_runs(docs, words_of=planted_words)
    best = F.array_min(F.transform("r_runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform("r_runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("doc_id", F.size("r_runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("r_collapsed", 256).alias("collapsed_sha256"))
    length, period = -F.col("best.n"), F.col("best.p")
    return rows.select(
        "doc_id", "n_runs", F.col("best.s").alias("start"), length.alias("length"), period.alias("period"),
        F.expr("(-1000 * best.n) div best.p").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
