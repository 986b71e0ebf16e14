"""Token counts by way of a cache of digests.

A text's count depends on its normalised content and on the tokenizer alone, so counts are
kept under the digests of both. Only distinct contents that the cache lacks are encoded, and
their counts are appended to it.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable, Iterator
from importlib.metadata import version

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvina.llm.common import checkpoint_dir, cut, give_back

#: Missing digests, of 32 bytes each, that may be broadcast to pick their texts; more meet in a join.
BROADCAST_DIGESTS = 1_000_000
#: Texts and bytes that are encoded at once.
SLICE_TEXTS, SLICE_BYTES = 512, 4 << 20
CACHE = "digest binary, n_tokens long, version string"


def null_is_empty(text: Column) -> Column:
    """The content of a text as far as every tokenizer counts it: null is empty, nothing else changes."""
    return F.coalesce(text, F.lit(""))


def tokenizer_version(path: str, library: str) -> str:
    """Digest of a tokenizer's file, its library and that library's version."""
    with open(path, "rb") as f:
        return hashlib.sha256(f"{library} {version(library)} ".encode() + f.read()).hexdigest()


def _library(path: str) -> str:
    kinds = {".json": "tokenizers", ".model": "sentencepiece"}
    kind = os.path.splitext(path)[1]
    if kind not in kinds:
        raise ValueError(f"no library for tokenizer files named *{kind}")
    return kinds[kind]


def _counter(model: bytes, library: str) -> Callable[[list[str]], list[int]]:
    """Counts whole texts as the library gives them: no begin, end or added special tokens, no truncation, no padding."""
    if library == "sentencepiece":
        from sentencepiece import SentencePieceProcessor

        processor = SentencePieceProcessor(model_proto=model)
        return lambda texts: [len(ids) for ids in processor.encode(texts, num_threads=1, add_bos=False, add_eos=False)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(model.decode())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _encoding(model: bytes, library: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in batches:
            count = count or _counter(model, library)
            at, n = 0, []
            ends = pc.cumulative_sum(pc.binary_length(batch.column(1)).cast(pa.int64())).to_pylist()
            while at < batch.num_rows:
                stop, most = at + 1, (ends[at - 1] if at else 0) + SLICE_BYTES
                while stop < batch.num_rows and stop - at < SLICE_TEXTS and ends[stop] <= most:
                    stop += 1
                n += count(batch.column(1).slice(at, stop - at).to_pylist())
                at = stop
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["digest", "n_tokens"])
        give_back()

    return run


def cached(spark: SparkSession, cache: str, of: str) -> DataFrame:
    """(digest, n_tokens) that a cache holds for a tokenizer's version; an absent cache is empty. Counts that two runs appended both are one row."""
    try:
        rows = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], CACHE)
    return rows.where(F.col("version") == of).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, cache: str, *, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] = null_is_empty) -> DataFrame:
    """One row per row of ``docs``: its id, n_bytes of UTF-8 and n_tokens; counts that the cache lacks are appended to it.

    ``cache`` is a Parquet folder that executors share, parted by tokenizer version; ``tokenizer`` a file on the driver,
    whose bytes (below a few MB) travel with the tasks. ``normalise`` may only fold what the tokenizer counts alike. Null
    texts are empty and have no tokens unless the tokenizer gives some; null and repeated ids stay; no rows give none.
    An append that fails leaves the cache as it was, and the next run encodes anew.
    """
    spark, library = docs.sparkSession, _library(tokenizer)
    of = tokenizer_version(tokenizer, library)
    with open(tokenizer, "rb") as f:
        encoding = _encoding(f.read(), library)
    digest = F.unhex(F.sha2(normalise(F.col(text_col)), 256))
    rows = cut(docs.select(F.col(id_col).alias("id"), digest.alias("digest"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes")))
    misses = cut(rows.select("digest").distinct().join(cached(spark, cache, of), "digest", "left_anti"))
    if n := misses.count():
        texts = docs.select(digest.alias("digest"), normalise(F.col(text_col)).alias("text"))
        if n <= BROADCAST_DIGESTS:
            texts = texts.join(F.broadcast(misses), "digest", "left_semi")
        # Copies are combined before the shuffle, however many a text has.
        texts = texts.groupBy("digest").agg(F.first("text").alias("text"))
        if n > BROADCAST_DIGESTS:
            texts = texts.join(misses, "digest", "left_semi")
        counts = texts.select("digest", "text").mapInArrow(encoding, "digest binary, n_tokens long")
        counts.withColumn("version", F.lit(of)).write.mode("append").partitionBy("version").parquet(cache)
    return rows.join(cached(spark, cache, of), "digest").select(F.col("id").alias(id_col), "n_bytes", "n_tokens")


def piece_bpe() -> str:
    """The file of the public vocabulary of 32,000 pieces."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op13_token_counts(spark: SparkSession, sf_dir: str, cache: str | None = None, limit: int = 4096) -> DataFrame:
    """Per document: bytes, tokens, and whether it has more than ``limit``; without ``cache`` a new one in the shared folder, so every run encodes each distinct text."""
    cache = cache or f"{checkpoint_dir(spark)}/token-counts-{uuid.uuid4().hex}"
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), cache, tokenizer=piece_bpe()).withColumn("over_limit", F.col("n_tokens") > limit)


QUERIES = {"op13_token_counts": op13_token_counts}
ORACLES: dict[str, str] = {}
