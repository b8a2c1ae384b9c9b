"""Quality rules: simple counts, then a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed into buckets. Over all documents the bucket
counts give the raw-corpus multinomial, over trusted documents (labelled
quality 1) the target multinomial. A document's score is the mean over its
n-grams of log(target / raw); documents under a fixed quantile of the scores
of trusted documents that the target was not made of are dropped. Everything is DataFrame code: the ratios
travel as one constant array of ``BUCKETS`` doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import SPACE_CHARS, stage, table, words
from corpusmill.schema import free

BUCKETS = 10_000
#: Added to each bucket's count.
SMOOTHING = 1.0
#: Part of the trusted documents that may fall below the threshold.
TRUSTED_LOSS = 0.005
WINDOW = 5
SYMBOLS = "#*$%&|<>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: a lambda would compute an outer expression for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hashes(word: Column) -> Column:
    return F.transform(word, lambda w: F.xxhash64(w))


def _buckets(hashes: Column, buckets: int) -> Column:
    """Bucket numbers from 1 of all words and all pairs of neighbours."""
    single = F.transform(hashes, lambda h: (F.pmod(h, F.lit(buckets)) + 1).cast("int"))
    # a pair's bucket mixes both hashes; the last word has no pair
    pair = F.transform(
        F.slice(hashes, 1, F.greatest(F.size(hashes) - 1, F.lit(0))),
        lambda h, i: (F.pmod(F.xxhash64(h, F.get(hashes, i + 1)), F.lit(buckets)) + 1).cast("int"),
    )
    return F.concat(single, pair)


def repeated_words(hashes: Column) -> Column:
    """Words in windows of five words that the text holds twice or more.

    Most texts repeat no window, which the distinct count shows. For the others
    the (hash, place) pairs are sorted, those equal to a neighbour kept, and
    each kept place covers the words up to the next kept place, five at most.
    """
    windows = F.transform(
        F.slice(hashes, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0))),
        lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WINDOW)]),
    )

    def covered(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(p: Column) -> Column:
            twice = F.filter(p, lambda x, k: (x["h"] == F.get(p, k - 1)["h"]) | (x["h"] == F.get(p, k + 1)["h"]))
            # get() of -1 or of the size is null: no neighbour there
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        def length(at: Column) -> Column:
            steps = F.transform(at, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - i, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        return _let(_let(pairs, places), length)

    return _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(w)))


def _removed(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def base_counts(text: Column) -> dict[str, Column]:
    """word_chars, n_symbols and n_dup_lines of a text that is not null."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(SPACE_CHARS)) != "")
    return {
        "word_chars": _removed(text, SPACE_CHARS).cast("long"),
        "n_symbols": (F.length(text) - _removed(text, SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }


def trusted_ids(labels: DataFrame) -> DataFrame:
    """All ids labelled quality 1."""
    return labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def in_fit(labels: DataFrame) -> Column:
    """Whether a doc_id falls in the half whose trusted documents make the target; the other half gives the threshold.

    It is known without a join, so only texts of the first half travel.
    """
    return F.pmod(F.xxhash64(F.lit("half"), F.col("doc_id").cast(labels.schema["doc_id"].dataType)), F.lit(2)) == 0


def exact_quantile(scores: DataFrame, column: str, share: float, error: float = 1e-4) -> float | None:
    """The quantile as ``percentile`` gives it, from counts and the few values between a lower bound and the place; null without values."""
    values = scores.where(F.col(column).isNotNull()).select(column)
    n = values.count()
    if not n:
        return None
    at = share * (n - 1)
    first = int(at)
    low = values.approxQuantile(column, [max(0.0, share - 2 * error)], error)[0]
    below = values.where(F.col(column) < low).count()
    if below > first:
        low, below = float("-inf"), 0
    near = [r[0] for r in values.where(F.col(column) >= low).orderBy(column).limit(first - below + 2).collect()][first - below :]
    return near[0] if at == first else near[0] * (first + 1 - at) + near[1] * (at - first)


def fit_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, asked: Column | None = None) -> list[float]:
    """log(target / raw) of each bucket; zeros if nothing is trusted.

    Where ``asked`` is given, trusted rows for which it is false do not count
    as such; their texts are counted where they lie, without an exchange.
    """
    asked = F.lit(True) if asked is None else asked
    # one plan at every size, so that what is exchanged grows with the input
    marked = docs.where(asked).join(trusted.withColumn("q_trusted", F.lit(1)).hint("merge"), "doc_id", "left")
    marked = marked.unionByName(docs.where(~asked).withColumn("q_trusted", F.lit(None).cast("int")))
    grams = marked.select(F.explode(_let(_hashes(words(F.col("text"))), lambda h: _buckets(h, buckets))).alias("b"), "q_trusted")
    rows = grams.groupBy("b").agg(F.count(F.lit(1)).alias("raw"), F.count("q_trusted").alias("good")).collect()
    raw, good = [SMOOTHING] * buckets, [SMOOTHING] * buckets
    for r in rows:
        raw[r["b"] - 1] += r["raw"]
        good[r["b"] - 1] += r["good"]
    if sum(good) == SMOOTHING * buckets:
        return [0.0] * buckets
    from math import log

    n_raw, n_good = sum(raw), sum(good)
    return [log(g / n_good) - log(r / n_raw) for g, r in zip(good, raw, strict=True)]


def ratio_score(hashes: Column, ratios: list[float]) -> Column:
    """Mean log ratio over the n-grams; null without words."""
    table_ = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    total = F.aggregate(_buckets(hashes, len(ratios)), F.lit(0.0), lambda a, b: a + F.element_at(table_, b))
    return F.when(F.size(hashes) > 0, total / (2 * F.size(hashes) - 1))


def score_quality(docs: DataFrame, labels: DataFrame, trusted_loss: float = TRUSTED_LOSS, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with the base counts, llr, threshold, base_failed and kept.

    ``docs`` needs doc_id and text. A null or blank text has no words, so it
    fails the base rule. Without trusted documents the ratio is 0 everywhere
    and keeps what the base rules keep. Rows are scored one by one, repeated
    or not, and texts are read whole, however long; all other columns pass
    through, replaced if they bear a name of the result. The threshold is the exact
    ``trusted_loss`` quantile of the scores of the trusted rows kept out of the fit.
    """
    trusted = stage(trusted_ids(labels), "trusted")
    keyed = docs.select("doc_id", "text")
    fitted = in_fit(labels)
    ratios = fit_ratios(keyed, trusted, buckets, fitted)
    # scored before the join: a score takes less room than its text
    scores = keyed.where(~fitted).select("doc_id", _let(_hashes(words(F.col("text"))), lambda h: F.when(F.size(h) >= 10, ratio_score(h, ratios))).alias("s"))
    cut = exact_quantile(stage(scores.join(trusted, "doc_id", "left_semi"), "scores"), "s", trusted_loss)
    cut = float("-inf") if cut is None else cut
    text = F.coalesce(F.col("text"), F.lit(""))

    def of_words(h: Column) -> Column:
        return F.struct(F.size(h).cast("long").alias("n_words"), repeated_words(h).alias("n_repeat_words"), ratio_score(h, ratios).alias("llr"))

    held = free(docs.columns, "q_of_words")
    own = docs.withColumn(held, _let(_hashes(words(F.col("text"))), of_words)).withColumns(base_counts(text))
    scored = own.withColumns({c: F.col(f"{held}.{c}") for c in ("n_words", "n_repeat_words", "llr")}).withColumn("threshold", F.lit(cut))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(F.col("llr") >= F.lit(cut), F.lit(False))).drop(held)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr", "threshold"
    )
