"""Token counts by a digest cache.

A cache is a folder of Parquet files with the digest of a content and its
token count, one subfolder for each version of a tokenizer (its file, its
library and the library's version, as a digest). Counting joins the digests
of the texts to it, encodes one text of each digest that is not there, and
appends what it found. Texts cross the network only where they are missing,
and then once for each task that holds them.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import held_by_process, in_parts, scratch_dir, small_batches, stage, table
from corpusmill.schema import free

#: Up to so many missing digests (32 bytes each, so 2 MB) are sent to all tasks; more are joined by a shuffle.
SENT_DIGESTS = 1 << 16
#: Bytes of text that are encoded at a time.
SLICE_BYTES = 1 << 20
#: Counts of stretches of text that a task keeps, twice over (those in use outlast the others), and the longest stretch kept.
KNOWN_STRETCHES, KNOWN_LENGTH = 75_000, 64
#: The session's setting that names a lasting cache.
CACHE_SETTING = "spark.corpusmill.token.cache"

ADDED = ("n_bytes", "n_tokens")


def installed(name: str) -> str:
    """Where an installed public tokenizer's file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Two blanks in a row, and a place before a single space or on both sides of a single line break, other signs on both sides.
_BLANKS = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?=[ ]\S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")


def stretches_of(text: str) -> list[str]:
    """The text cut where the byte-level pattern cuts it in any case.

    The pattern takes one space to the word behind it, and a line break alone
    if no other blank is beside it; words hold no blanks. Python's blanks are
    more than the pattern's, so a place is cut only if both agree. In a text
    without two blanks in a row every space and line break is such a place.
    """
    if "\0" in text or _BLANKS.search(text):
        return _CUT.split(text)
    return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")


class Tokenizer:
    """A tokenizers (.json) or sentencepiece (.model) file: counts, the content that decides them, and the version."""

    def __init__(self, path: str):
        # before the library starts its threads: a task has one core
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path, self.is_json = path, path.endswith(".json")
        if self.is_json:
            import tokenizers as library

            with open(path, encoding="utf-8") as f:
                self.declared = json.load(f)
            self.own = library.Tokenizer.from_file(path)
            self.own.no_truncation()
            self.own.no_padding()
        elif path.endswith(".model"):
            import sentencepiece as library

            self.own = library.SentencePieceProcessor(model_file=path)
        else:
            raise ValueError(f"neither a .json nor a .model file: {path}")
        self.library = f"{library.__name__} {library.__version__}"
        self.known: dict[str, int] = {}
        self.before: dict[str, int] = {}

    @property
    def folds(self) -> bool:
        """Whether different texts can have one content."""
        return self.is_json and self.declared.get("normalizer") is not None

    def version(self) -> str:
        digest = hashlib.sha256(self.library.encode() + b"\0")
        with open(self.path, "rb") as f:
            while piece := f.read(1 << 20):
                digest.update(piece)
        return digest.hexdigest()

    def content(self, text: str) -> bytes:
        """Equal for texts that the tokenizer cannot tell apart.

        The tokenizer's own normaliser makes it. Added tokens are looked for
        before it runs, so a text that holds one is its own content.
        """
        if self.folds and not any(t["content"] in text for t in self.declared.get("added_tokens", [])):
            return b"n" + self.own.normalizer.normalize_str(text).encode()
        return b"t" + text.encode()

    @property
    def cuts_at_spaces(self) -> bool:
        """Whether no token crosses the place before a single space, and that around a single line break, between other signs.

        So it is where the byte-level pattern cuts the text and nothing else
        looks at it before.
        """
        return self.is_json and not self.folds and self.declared.get("pre_tokenizer") == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}

    def _whole(self, texts: list[str]) -> list[int]:
        if self.is_json:
            return [len(e) for e in self.own.encode_batch_fast(texts, add_special_tokens=False)]
        return [len(ids) for ids in self.own.encode(texts, num_threads=1)]

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text, without begin, end or added special tokens."""
        if not self.cuts_at_spaces:
            return self._whole(texts)
        added = [t["content"] for t in self.declared.get("added_tokens", [])]
        out, later = [], []
        for k, text in enumerate(texts):
            if any(a in text for a in added):
                out.append(0)
                later.append(k)
            else:
                out.append(self._by_stretches(text))
        for k, n in zip(later, self._whole([texts[k] for k in later])):
            out[k] = n
        return out

    def _by_stretches(self, text: str) -> int:
        stretches = stretches_of(text)
        if len(self.known) > KNOWN_STRETCHES:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        fresh, long = [], {}
        for s in set(stretches):
            if s not in known:
                if s in before:
                    known[s] = before[s]
                else:
                    fresh.append(s)
        for s, n in zip(fresh, self._whole(fresh)):
            (known if len(s) <= KNOWN_LENGTH else long)[s] = n
        if long:
            return sum([known[s] if s in known else long[s] for s in stretches])
        return sum(map(known.__getitem__, stretches))


def _tokenizer(path: str) -> Tokenizer:
    return held_by_process(f"tokenizer {path}", lambda: Tokenizer(path))


def _folded(path: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _tokenizer(path)
        for batch in in_parts(batches, -1, SLICE_BYTES):
            digests = [hashlib.sha256(own.content(t or "")).digest() for t in batch.column(-1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())], [*batch.schema.names, name])

    return run


def with_digest(docs: DataFrame, path: str, name: str = "t_digest") -> DataFrame:
    """``docs`` with the digest of the content of ``text``; null counts as empty text."""
    if not _tokenizer(path).folds:
        return docs.withColumn(name, F.unhex(F.sha2(F.concat(F.lit("t"), F.coalesce("text", F.lit(""))), 256)))
    own = [c for c in docs.columns if c != "text"]
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*own, "text"]) + f", `{name}` binary"
    return docs.select(*own, "text").mapInArrow(_folded(path, name), schema)


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and compressed text of the first row of each digest; a task holds the digests it has met."""
    met: set[bytes] = set()
    for batch in in_parts(batches, 1, SLICE_BYTES):
        keep = []
        for k, digest in enumerate(batch.column(0).to_pylist()):
            if digest not in met:
                met.add(digest)
                keep.append(k)
        if keep:
            rows = batch.take(pa.array(keep, pa.int64()))
            packed = [zlib.compress(t.encode(), 1) for t in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(packed, pa.binary())], ["t_digest", "t_packed"])


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _tokenizer(path)
        met: set[bytes] = set()
        for batch in in_parts(batches, 1, SLICE_BYTES // 4):
            found = {d: p for d, p in zip(*(c.to_pylist() for c in batch.columns)) if d not in met}
            met.update(found)
            counts = own.counts([zlib.decompress(p).decode() for p in found.values()])
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(counts, pa.int64())], ["t_digest", "n_tokens"])

    return run


def _folder(spark: SparkSession, path: str) -> str:
    """``path``, made if it is not there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place)
    return path


def cached_counts(spark: SparkSession, cache: str, path: str) -> DataFrame:
    """(t_digest, n_tokens) of what the cache holds for this version of the tokenizer, once each.

    Runs that miss the same content at the same time append it twice.
    """
    folder = _folder(spark, f"{cache.rstrip('/')}/version={_tokenizer(path).version()}")
    return spark.read.schema("t_digest binary, n_tokens long").parquet(folder).groupBy("t_digest").agg(F.max("n_tokens").alias("n_tokens"))


def _missing_texts(texts: DataFrame, missing: DataFrame, n_missing: int) -> DataFrame:
    """The texts of missing digests, packed, one of each task that holds it, dealt by digest; nothing is sorted."""
    kind = "t_digest binary, t_packed binary"
    if n_missing <= SENT_DIGESTS:
        return texts.join(F.broadcast(missing), "t_digest", "left_semi").mapInArrow(_once, kind).repartition("t_digest")
    return texts.mapInArrow(_once, kind).join(missing.hint("shuffle_hash"), "t_digest", "left_semi")


def count_tokens(docs: DataFrame, path: str, cache: str) -> DataFrame:
    """The columns of ``docs`` but text, with n_bytes (UTF-8) and n_tokens.

    ``path`` is the tokenizer's file on the driver and the executors, ``cache``
    a folder that all of them share. What the cache lacks is encoded once and
    appended; equal contents, within one table or between runs, are encoded
    only once. A null text counts as empty: no bytes, no tokens. Null keys and
    repeated rows do no harm: all rows of a digest get its count. A text is
    encoded whole, however long. An empty table gives an empty table. Columns
    named n_bytes or n_tokens are replaced, any other name may occur.
    """
    spark = docs.sparkSession
    own = [c for c in docs.columns if c.lower() not in ("text", *ADDED)]
    digest = free(own, "t_digest")
    sized = with_digest(docs.select(*own, "text"), path, digest).withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    keys = stage(sized.drop("text"), "keys")
    wanted = stage(keys.select(F.col(digest).alias("t_digest")).distinct(), "wanted")
    missing = stage(wanted.join(cached_counts(spark, cache, path), "t_digest", "left_anti"), "missing")
    n_missing = missing.count()
    if n_missing:
        texts = with_digest(docs.select("text"), path).select("t_digest", F.coalesce("text", F.lit("")).alias("t_text"))
        found = _missing_texts(texts, missing, n_missing).mapInArrow(_encoded(path), "t_digest binary, n_tokens long")
        with small_batches(spark):
            found.write.mode("append").parquet(_folder(spark, f"{cache.rstrip('/')}/version={_tokenizer(path).version()}"))
    # staged, so that nothing but the join stands behind the exchange of the rows and a digest of many rows can be split
    counts = stage(cached_counts(spark, cache, path).join(wanted, "t_digest", "left_semi").withColumnRenamed("t_digest", digest), "counts")
    return keys.join(counts, digest, "left").select(*own, *ADDED)


def over(limit: int) -> Column:
    return F.col("n_tokens") > F.lit(limit)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts with the 50k byte-level tokenizer; the cache is the one that the session names, or else a new one in the shared folder."""
    cache = spark.conf.get(CACHE_SETTING, None) or scratch_dir(spark) + "/token-cache"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, installed("byte_bpe_50k.json"), cache).select("doc_id", "n_bytes", "n_tokens", over(512).alias("over_limit"))
