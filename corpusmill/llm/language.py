"""Language identification by mixture inference.

A language's model is a smoothed multinomial over hashed character n-grams
(orders 1 to 3, with word boundaries), counted over all training documents. A
document is a mixture: each word is drawn from one language, languages have
proportions, and expectation-maximisation estimates them. Languages join the
document's set one by one while the log-likelihood gains more than a penalty
for the added parameter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import in_parts, share_of, table

BINS = 1 << 14
SMOOTHING = 0.5
#: Log-likelihood that a further language must gain for each log of the number of words.
PENALTY = 6.0
STEPS = 12
#: Words kept in a task's table of word likelihoods before it is emptied.
KNOWN_WORDS = 200_000
_TEXT = re.compile(r"[^\W\d_]+")


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all n-grams of the words one after the other, and where each word's begin."""
    codes = np.frombuffer(("\n" + "\n".join(words) + "\n").encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    # at each place: the character, the pair and the triple that begin there
    a, b = codes, np.append(codes[1:], np.uint64(10))
    c = np.append(codes[2:], np.array([10, 10], np.uint64))
    m1, m2, m3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    one = a * m1
    two = one ^ ((b + np.uint64(1)) * m2)
    three = two ^ ((c + np.uint64(1)) * m3)
    shift = np.uint64(64 - BINS.bit_length() + 1)
    # every word owns its leading boundary and its letters, not the one after it
    out = np.empty((len(codes) - 1, 3), np.int64)
    for k, h in enumerate((one, two, three)):
        out[:, k] = ((h * m3) >> shift)[:-1]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return out, starts


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case; signs of numbers that the pattern takes for letters cut them."""
    out = _TEXT.findall(text.lower())
    if all(map(str.isalpha, out)):
        return out
    return [w for run in out for w in "".join([c if c.isalpha() else " " for c in run]).split()]


def fit(docs: DataFrame, holdout: int = 5) -> tuple[list[str], np.ndarray]:
    """Languages in order and log probabilities (language x bin).

    Learns from rows with a language and a text whose crc32(doc_id) modulo
    ``holdout`` is not 0 (all such rows if 0). What comes to the driver is a
    count for each bin and distinct ``lang``, however many documents there
    are; so ``lang`` must be a column of labels, some thousand at most.
    """
    chosen = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if holdout:
        chosen = chosen.where(share_of(F.col("doc_id"), holdout) != 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        totals: dict[str, np.ndarray] = {}

        def flush():
            for lang, words in found.items():
                if words:
                    grams, starts = _grams(list(words))
                    weight = np.repeat(np.fromiter(words.values(), np.float64, len(words)), np.diff(np.append(starts, len(grams))))
                    sums = totals.setdefault(lang, np.zeros(BINS))
                    for k in range(3):
                        sums += np.bincount(grams[:, k], weight, BINS)
                    words.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, found.values())) > KNOWN_WORDS:
                flush()
        flush()
        for lang, sums in totals.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(sums[at].astype(np.int64))], ["lang", "bin", "n"])

    counted = chosen.select("lang", "text").mapInArrow(count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counted.lang.unique())
    counts = np.full((len(langs), BINS), SMOOTHING)
    for k, lang in enumerate(langs):
        own = counted[counted.lang == lang]
        counts[k, own.bin.to_numpy()] += own.n.to_numpy()
    return langs, np.log(counts / counts.sum(axis=1, keepdims=True)) if langs else counts


def proportions(likelihood: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """EM over words x languages log-likelihoods: proportions and the log-likelihood of the words."""
    top = likelihood.max(axis=1, keepdims=True)
    weight = np.exp(likelihood - top)
    share = np.full(likelihood.shape[1], 1.0 / likelihood.shape[1])
    for _ in range(steps):
        part = weight * share
        part /= part.sum(axis=1, keepdims=True)
        new = part.mean(axis=0)
        if np.abs(new - share).max() < 1e-4:
            share = new
            break
        share = new
    return share, float(np.log(weight @ share).sum() + top.sum())


def languages_of(likelihood: np.ndarray, penalty: float = PENALTY) -> tuple[list[int], np.ndarray]:
    """The languages chosen for a document and their proportions."""
    sums = likelihood.sum(axis=0)
    chosen, share, best = [int(sums.argmax())], np.ones(1), float(sums.max())
    price = penalty * (1.0 + np.log(len(likelihood)))
    if likelihood.max(axis=1).sum() - best <= price:  # no mixture can gain more than its words' best languages
        return chosen, share
    full, _ = proportions(likelihood)
    for k in map(int, np.argsort(-full, kind="stable")):
        if k in chosen:
            continue
        new, value = proportions(likelihood[:, [*chosen, k]])
        if value - best <= price:
            break
        chosen, share, best = [*chosen, k], new, value
    return chosen, share


#: What ``identify`` adds.
ADDED = ("l_lang", "l_score", "l_langs", "l_shares")


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], penalty: float = PENALTY) -> DataFrame:
    """``docs`` with l_lang, l_score, l_langs and l_shares.

    ``und`` with score 0 and empty lists if the text is null or has no letter,
    or if nothing was learned; letters are the characters of Unicode category
    L, so numeric signs such as a raised two are none. l_score is the share of
    the words that the first language makes up: a text of one language scores
    1, whatever the evidence, so it is no probability. Ties go to the language
    that sorts first. Repeated rows are scored alike; a text of any length is
    read whole. Other columns pass through unless they bear one of those names.
    """
    langs, table_ = model
    table_t = np.ascontiguousarray(table_.T)
    new = list(ADDED)
    own = [c for c in docs.columns if c not in new]
    kinds = dict(docs.dtypes)
    at = own.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[str, int] = {}
        values = np.zeros((0, len(langs)))
        for batch in in_parts(batches, at):
            texts = [words_of(t) if t else [] for t in batch.column(at).to_pylist()]
            missing = list({w for t in texts for w in t if w not in place})
            if len(place) + len(missing) > KNOWN_WORDS and place:
                place, values = {}, values[:0]
                missing = list({w for t in texts for w in t})
            if missing and langs:
                grams, starts = _grams(missing)
                each = table_t[grams[:, 0]] + table_t[grams[:, 1]] + table_t[grams[:, 2]]
                place.update(zip(missing, range(len(place), len(place) + len(missing)), strict=True))
                values = np.concatenate([values, np.add.reduceat(each, starts, axis=0)])
            out = ([], [], [], [])
            for t in texts:
                if not t or not langs:
                    row = ("und", 0.0, [], [])
                else:
                    chosen, share = languages_of(values[np.fromiter(map(place.__getitem__, t), np.int64, len(t))], penalty)
                    order = sorted(range(len(chosen)), key=lambda i: (-share[i], chosen[i]))
                    row = (langs[chosen[order[0]]], float(min(1.0, share[order[0]])), [langs[chosen[i]] for i in order], [float(share[i]) for i in order])
                for o, v in zip(out, row, strict=True):
                    o.append(v)
            arrays = [pa.array(out[0], pa.string()), pa.array(out[1], pa.float64()), pa.array(out[2], pa.list_(pa.string())), pa.array(out[3], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*own, *new])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in own) + ", l_lang string, l_score double, l_langs array<string>, l_shares array<double>"
    return docs.select(*own).mapInArrow(run, schema)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", (share_of(F.col("doc_id"), 5) == 0).alias("held_out"), F.col("l_lang").alias("lang_pred"), F.col("l_score").alias("score"), F.col("l_langs").alias("langs"), F.col("l_shares").alias("shares"))
