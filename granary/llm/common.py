"""Shared plumbing of the training-data operators: work folders, column clashes, subword encoding."""

from __future__ import annotations

import atexit
import contextlib
import functools
import os
import sys
import tempfile
import unicodedata
import uuid
from array import array
from collections.abc import Iterator
from itertools import chain, filterfalse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ship import ship

#: Rows with whole texts that an operator works on at a time, and bytes after which Spark closes a batch.
ARROW_ROWS, ARROW_BYTES = 512, 4 << 20
VOCABULARY = "word_bpe_49k.json"


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    Only where ``spark.checkpoint.dir`` is unset, and all runs in one process (a test), a temporary folder takes its place.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = f"file://{os.path.join(tempfile.gettempdir(), 'granary-work')}"
    mine = f"{top.rstrip('/')}/granary-{spark.sparkContext.applicationId}"
    _forget_at_exit(spark, mine)
    return f"{mine}/{name}-{uuid.uuid4().hex}"


@functools.cache
def _folders() -> set[str]:
    return set()


def _forget_at_exit(spark: SparkSession, folder: str) -> None:
    """Delete an application's work folder when its driver ends, if Spark still runs then."""
    if folder in _folders():
        return
    _folders().add(folder)

    def forget() -> None:
        context = spark.sparkContext
        with contextlib.suppress(Exception):  # the Java side may have ended first
            if context._jsc is not None and not context._jsc.sc().isStopped():
                path = context._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)

    atexit.register(forget)


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends there and lost executors recompute nothing before it."""
    spark = df.sparkSession
    folder = work_folder(spark, name)
    df.write.options(compression="zstd", **options).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def bounded(spark: SparkSession) -> None:
    """Ship the package, and bound Arrow batches by bytes: plans are lazy, so all operators set the one bound, and never raise what is set."""
    ship(spark)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = int(spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch())
    if not 0 < held <= ARROW_BYTES:
        spark.conf.set(name, str(ARROW_BYTES))


def slices(batches: Iterator[pa.RecordBatch], rows: int = ARROW_ROWS) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, which bounds what is made of one at a time."""
    for batch in batches:
        for i in range(0, len(batch), rows):
            yield batch.slice(i, rows)


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns that an operator reads, a null text as the empty one; columns of any other name don't matter."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds(dict):
    """Ids of a stretch without blanks, by the tokenizers library; stretches met before come from memory.

    The vocabulary's pre-tokenizer always cuts at white space, so a text's ids are those of its blank-separated stretches in
    turn.  It also cuts between letters and marks (an apostrophe can belong to letters, and an angle bracket to a special
    token, so stretches with them are left whole), and lower-cases character by character.  A word of Latin letters
    needs no normalizer but that and goes to the library's model at once; whatever else goes through all of its
    steps. The memory is bounded: of two generations the older goes when the younger is full.
    """

    LIMIT = 500_000
    LONG = 64
    MARKS = ".,;:!?$%&*#()-|\""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        super().__init__()
        self.tokenizer, self.older = Tokenizer.from_file(path), {}
        self.model = self.tokenizer.model
        pieces = ByteLevel(add_prefix_space=False, use_regex=False)
        #: what the byte-level step makes of each Latin letter
        self.bytes = {ord(c): pieces.pre_tokenize_str(c)[0][0] for c in map(chr, range(0x80, 0x250)) if c.isalpha()}

    def _word(self, word: str) -> bytes | None:
        """Ids of a word of Latin letters; None if it isn't one."""
        if not word.isalpha():
            return None
        if not word.isascii():
            if max(word) > "\u024f" or "\u0130" in word or not unicodedata.is_normalized("NFC", word):
                return None
            word = word.lower()
            if (ids := self.get(word)) is not None:
                return ids
            found = self.model.tokenize(word.translate(self.bytes))
        else:
            word = word.lower()
            if (ids := self.get(word)) is not None:
                return ids
            found = self.model.tokenize(word)
        ids = self[word] = array("H", [t.id for t in found]).tobytes()
        return ids

    def _learn(self, words: set[str]) -> None:
        older, marks, rest = self.older, self.MARKS, []
        for word in words:
            ids = older.get(word)
            if ids is None:
                ids = self._word(word)
                if ids is None:
                    stem = word.rstrip(marks)
                    tail = self.get(word[len(stem) :]) if stem and stem is not word else None
                    ids = None if tail is None else self._word(stem)
                    if ids is None:
                        rest.append(word)
                        continue
                    ids += tail
            self[word] = ids
        for word, found in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self[word] = array("H", found.ids).tobytes()
            # the marks at its end serve other words from now on
            tail = word[len(word.rstrip(marks)) :]
            if tail and tail not in self and len(tail) <= self.LONG:
                self[tail] = array("H", self.tokenizer.encode(tail, add_special_tokens=False).ids).tobytes()

    def of(self, texts: list[str]) -> list[bytes]:
        """The texts' ids, two little-endian bytes each."""
        if len(self) > self.LIMIT:
            self.older = dict(self)
            self.clear()
        split = [t.replace("\n", " ").split(" ") for t in texts]
        new = set(filterfalse(self.__contains__, chain.from_iterable(split)))
        self._learn(new)
        out = [b"".join(map(self.__getitem__, words)) for words in split]
        for word in new:
            if len(word) > self.LONG:
                for part in (word, word.lower(), word.rstrip(self.MARKS).lower()):
                    self.pop(part, None)
        return out


@functools.cache
def word_ids(path: str) -> WordIds:
    """One for each Python worker.  Ids must fit in two bytes."""
    words = WordIds(path)
    if words.tokenizer.get_vocab_size() > 1 << 16 or sys.byteorder != "little":
        raise ValueError("ids are kept as 16 bits, little end first")
    return words


def small_side(df: DataFrame, limit: int = 500_000) -> DataFrame:
    """Mark df for broadcast if a count shows at most ``limit`` (narrow) rows; else leave the join to Spark."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
