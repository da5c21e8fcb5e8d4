"""Token counts kept as delta-maintained rollups.

A change is a signed row: an insert counts +1, a delete -1, and a revision is the old row with -1
and the new one with +1. Batches of changes are summed by source, language and tokenizer version
and written as additive deltas; totals are sums of deltas, whatever the order of the batches.
"""

from __future__ import annotations

import base64
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm.common import map_rows

# The pattern that splits a text before the merges of a byte-level vocabulary (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Counts of pieces that a task remembers; the memory is emptied when it is full.
MEMO = 1 << 18
GROUP = ["source", "lang", "tokenizer"]


def word_counter() -> Callable[[str | None], int]:
    return lambda text: len((text or "").split())


def bpe_counter(rank_file: str) -> Callable[[], Callable[[str | None], int]]:
    """Counter of byte-level BPE tokens; ``rank_file`` has a base64 token and its rank per line.

    Merges never cross the pieces of the splitting pattern, so a text has as many tokens as its
    pieces together, and pieces repeat.
    """

    def start():
        import regex
        import tiktoken

        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        coder = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        pieces, known = regex.compile(SPLIT).findall, {}

        def count(text: str | None) -> int:
            total = 0
            for piece in pieces(text or ""):
                n = known.get(piece)
                if n is None:
                    if len(known) >= MEMO:
                        known.clear()
                    n = known[piece] = len(coder.encode_ordinary(piece))
                total += n
            return total

        return count

    return start


def token_counts(
    docs: DataFrame,
    tokenizers: dict[str, Callable[[], Callable[[str | None], int]]],
    keep: list[str],
    text: str = "text",
) -> DataFrame:
    """The columns ``keep`` of each row, and ``n_tokens``: an array of (tokenizer, n).

    Null texts have no tokens. Counting happens where the row is; texts are not shuffled.
    """

    def start():
        counters = [(name, made()) for name, made in tokenizers.items()]
        return lambda value: ([{"tokenizer": k, "n": count(value)} for k, count in counters],)

    return map_rows(docs, keep, [text], "n_tokens array<struct<tokenizer:string,n:bigint>>", start)


class Rollup:
    """Totals by source, language and tokenizer version in a folder all executors can reach.

    Every batch has an id and a folder of its own. The folder counts once Spark has finished
    writing it; a batch that was cut off is written again from the start, and one that is
    committed is not applied a second time. Rows of a batch are summed before they are shuffled,
    so a group with a third of all changes costs each task one row.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _exists(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(place)

    def batches(self) -> list[str]:
        """Ids of the committed batches, in order."""
        jvm = self.spark.sparkContext._jvm
        top = jvm.org.apache.hadoop.fs.Path(self.folder)
        files = top.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if not files.exists(top):
            return []
        names = [status.getPath().getName() for status in files.listStatus(top)]
        names = [n.removeprefix("batch-") for n in names if n.startswith("batch-")]
        return sorted(n for n in names if self._exists(f"{self._path(n)}/_SUCCESS"))

    def _path(self, batch_id: str) -> str:
        return f"{self.folder}/batch-{batch_id}"

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply ``changes`` (source, lang, tokenizer, sign, n_tokens) once; False if they were.

        Null sources and languages are groups of their own; rows with a null sign or count change
        nothing but what they can: a null count is 0 tokens, a null sign no change.
        """
        if self._exists(f"{self._path(batch_id)}/_SUCCESS"):
            return False
        sign = F.coalesce(F.col("sign").cast("bigint"), F.lit(0))
        deltas = changes.groupBy(*GROUP).agg(
            F.sum(sign).alias("n_docs"),
            F.sum(sign * F.coalesce(F.col("n_tokens"), F.lit(0))).alias("n_tokens"),
        )
        deltas.write.mode("overwrite").parquet(self._path(batch_id))
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) of all groups that hold documents."""
        paths = [self._path(b) for b in self.batches()]
        if not paths:
            return self.spark.createDataFrame(
                [], "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"
            )
        sums = self.spark.read.parquet(*paths).groupBy(*GROUP)
        return sums.agg(
            F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
        ).filter((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))


def signed(counts: DataFrame, sign: int, tokenizers: Column | None = None) -> DataFrame:
    """Changes from rows with (source, lang, n_tokens array)."""
    rows = counts.select("source", "lang", F.explode("n_tokens").alias("x")).select(
        "source",
        "lang",
        F.col("x.tokenizer").alias("tokenizer"),
        F.lit(sign).alias("sign"),
        F.col("x.n").alias("n_tokens"),
    )
    return rows if tokenizers is None else rows.filter(tokenizers)
