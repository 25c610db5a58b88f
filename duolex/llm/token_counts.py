"""Token totals that are kept by deltas: signed batches, committed once each, summed on reading."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from duolex.llm.tokens import encoder, tokenizer_path

KEYS = ["source", "lang", "tokenizer"]
MEASURES = ["documents", "tokens"]
DELTAS = T.StructType(
    [T.StructField(k, T.StringType()) for k in KEYS] + [T.StructField(m, T.LongType()) for m in MEASURES])


def _count_tokens(path: str, n_keys: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encode = encoder(path).encode
        for batch in batches:
            counts = [len(ids) // 4 for ids in encode(batch.column(n_keys))]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:n_keys] + [pa.array(counts, pa.int64())], batch.schema.names[:n_keys] + ["tokens"])

    return run


def count_tokens(df: DataFrame, keep: list[str], text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """The columns `keep` and `tokens`, the token ids of the whole text; a null text has none."""
    kept = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("text"))
    kinds = T.StructType([*kept.schema.fields[:-1], T.StructField("tokens", T.LongType())])
    counted = kept.mapInArrow(_count_tokens(tokenizer or tokenizer_path(), len(keep)), kinds)
    return counted.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "tokens")


def inserts(rows: DataFrame) -> DataFrame:
    """Signed deltas of new documents: KEYS and `tokens` of each."""
    return rows.select(*KEYS, F.lit(1).alias("documents"), "tokens")


def deletes(rows: DataFrame) -> DataFrame:
    """Signed deltas of documents that go: KEYS and `tokens` as they were counted."""
    return rows.select(*KEYS, F.lit(-1).alias("documents"), (-F.col("tokens")).alias("tokens"))


def revisions(rows: DataFrame) -> DataFrame:
    """Signed deltas of counts that change from `old_tokens` to `tokens`; the documents stay."""
    return rows.select(*KEYS, F.lit(0).alias("documents"), (F.col("tokens") - F.col("old_tokens")).alias("tokens"))


class Rollup:
    """Totals by source, language and tokenizer version in a folder of the shared store.

    Each batch is one folder of its sums, named after its id, that appears by a single rename: a batch is
    there as a whole or not at all. A batch that is there already is left as it is, so a job that was
    stopped can be run again from the start. Totals are the sums over all batches and do not depend on
    their order; null keys are keys like others. An empty batch commits and changes nothing.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._store = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def committed(self, batch: str) -> bool:
        return self._store.exists(self._path(f"{self.folder}/batches/{batch}"))

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Adds the batch; False, with nothing done, if its id is there.

        Deltas are summed in each task before they move, so a source that holds most rows costs one row per task.
        """
        if not batch or "/" in batch or batch.startswith((".", "_")):
            raise ValueError(f"no batch id: {batch!r}")
        if self.committed(batch):
            return False
        sums = deltas.groupBy(*KEYS).agg(*[F.sum(m).cast("bigint").alias(m) for m in MEASURES])
        draft = f"{self.folder}/_drafts/{batch}-{uuid.uuid4().hex}"
        sums.select(*[f.name for f in DELTAS.fields]).write.parquet(draft)
        self._store.mkdirs(self._path(f"{self.folder}/batches"))
        if self.committed(batch):
            return False
        return self._store.rename(self._path(draft), self._path(f"{self.folder}/batches/{batch}"))

    def totals(self) -> DataFrame:
        """KEYS, documents, tokens over all committed batches; groups whose documents are all gone are left out."""
        if not self._store.exists(self._path(f"{self.folder}/batches")):
            return self.spark.createDataFrame([], DELTAS)
        sums = self.spark.read.schema(DELTAS).parquet(f"{self.folder}/batches/*")
        return sums.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES]).filter("documents <> 0 or tokens <> 0")
