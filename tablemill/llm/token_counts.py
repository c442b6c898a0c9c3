"""Token counts from an exact length histogram.

Texts are encoded once, in place; what leaves the executors is the number of documents of each
encoded length.  Suffix sums over that histogram answer totals, quantiles and truncated totals for
every context limit at once.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablemill.llm import textbuf
from tablemill.llm.scratch import ship, shipped, short_batches, store

#: Lengths are summed in blocks of this many, then over the blocks, so that no task sums all of them.
BLOCK = 128


def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("from-file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _counter(name: str, pattern: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(shipped(name), pattern)
        for batch in batches:
            for run in textbuf.runs(batch, "text"):
                texts = pc.fill_null(run.column(1), "").to_pylist()
                ids = [len(x) for x in encoding.encode_ordinary_batch(texts, num_threads=1)]
                yield pa.RecordBatch.from_arrays([run.column(0), pa.array(ids, pa.int64())], ["id", "n_tokens"])

    return count


def token_lengths(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens of each row; null and empty texts have 0.  ``vocabulary`` (ranks of a byte-level
    BPE) is a file of the driver's, which is sent to the executors.  Rows that repeat an id, or have
    none, count one by one.  Other columns are ignored."""
    short_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_counter(ship(docs.sparkSession, vocabulary), pattern), f"id {kind}, n_tokens long").withColumnRenamed("id", id_col)


def length_histogram(lengths: DataFrame) -> DataFrame:
    """n_tokens, documents: counted in every task before the shuffle."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("documents"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """One row per length L that occurs: documents and tokens of that length, documents and tokens
    of at least that length, and truncated_tokens, the total if every text is cut to L tokens."""
    tokens = F.col("n_tokens") * F.col("documents")
    rows = histogram.withColumn("tokens", tokens).withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    blocks = rows.groupBy("block").agg(F.sum("documents").alias("block_documents"), F.sum("tokens").alias("block_tokens"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(after), F.lit(0))
    blocks = blocks.select("block", before("block_documents").alias("later_documents"), before("block_tokens").alias("later_tokens"), F.sum("block_tokens").over(Window.partitionBy()).alias("all_tokens"))
    within = Window.partitionBy("block").orderBy(F.desc("n_tokens"))
    at_least = lambda c: F.sum(c).over(within) + F.col(f"later_{c}")
    out = rows.join(blocks, "block").select("n_tokens", "documents", "tokens", at_least("documents").alias("documents_at_least"), at_least("tokens").alias("tokens_at_least"), "all_tokens")
    cut = F.col("all_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("documents_at_least")
    return out.withColumn("truncated_tokens", cut).drop("all_tokens")


def truncated_total(sums: DataFrame, limits: list[int]) -> DataFrame:
    """context_limit, tokens: the total if every text is cut to the limit.  Exact between the lengths
    that occur: what is at least the next length gives ``limit`` each, the rest keeps its tokens."""
    asked = sums.sparkSession.createDataFrame([(x,) for x in limits], "context_limit long")
    rows = F.broadcast(asked).crossJoin(sums)
    over = F.col("n_tokens") > F.col("context_limit")
    kept = F.coalesce(F.sum(F.when(~over, F.col("tokens"))), F.lit(0)) + F.coalesce(F.sum(F.when(over, F.col("documents"))), F.lit(0)) * F.col("context_limit")
    return rows.groupBy("context_limit").agg(kept.alias("tokens"))


def length_quantile(sums: DataFrame, share: float) -> DataFrame:
    """n_tokens: the smallest length that at least ``share`` of the documents do not exceed."""
    total = sums.agg(F.sum("documents").alias("total"))
    up_to = F.col("total") - F.col("documents_at_least") + F.col("documents")
    return sums.join(F.broadcast(total)).filter(up_to >= F.ceil(F.col("total") * share)).agg(F.min("n_tokens").alias("n_tokens"))


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    lengths = token_lengths(spark.read.parquet(f"{sf_dir}/documents.parquet"), *default_vocabulary())
    # Stored, because the sums read it twice and the texts should be encoded once.
    return suffix_sums(store(length_histogram(lengths), "lengths"))
