"""Token counts as delta-maintained rollups.

A batch is a set of signed changes: +1 inserts a document's count, -1 deletes it, and a revision is both. Each batch is
reduced to additive deltas by source, language and tokenizer version and written to a folder of its own; a small file,
put in place last, names batch and folder and makes it count. A batch that is committed stays as it is, so replays after
a lost driver change no total, and one that never committed is not read. Compaction sums committed batches up.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm.common import n_words, text_key
from riskframe.llm.tokens import default_tokenizer, encoder, slices
from riskframe.sources import files

KEYS = ["source", "lang", "tokenizer_version"]
_COMMIT = "batch string, attempt string"
_DELTAS = "source string, lang string, tokenizer_version string, documents long, tokens long"


def count_tokens(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """(doc_id, key1, key2, source, lang, words, tokens) of whole texts, the keys naming the text; null and empty texts count 0."""
    path = tokenizer_path or default_tokenizer()
    schema = "doc_id long, key1 long, key2 long, source string, lang string, words long, tokens long"
    plain = docs.select(
        "doc_id", *text_key(F.col("text")), "source", "lang", n_words(F.col("text")).alias("words"), "text"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                counts = encoder(path).encode(rows.column("text"))[1].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(i) for i in range(6)), pa.array(counts)], names=[f.split()[0] for f in schema.split(", ")]
                )

    return plain.mapInArrow(count, schema)


class TokenRollup:
    """Totals kept at ``path``: ``commit`` signed changes under a batch id, read ``totals``, ``compact`` now and then."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _commits(self) -> DataFrame:
        """(batch, attempt) of the batches that count by themselves."""
        path = f"{self.path}/commits"
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], _COMMIT)
        return self.spark.read.schema(_COMMIT).json(path)

    def _base(self) -> str | None:
        """The newest compacted table: totals of the batches that it lists."""
        names = [n for n in files.names(self.spark, f"{self.path}/bases") if n.endswith(".json")]
        return f"{self.path}/bases/{names[-1].removesuffix('.json')}" if names else None

    def _covered(self) -> DataFrame:
        base = self._base()
        return self.spark.read.schema("batch string").parquet(f"{base}/batches") if base else self.spark.createDataFrame([], "batch string")

    def committed(self, batch_id: str) -> bool:
        named = self._commits().select("batch").unionByName(self._covered())
        return bool(named.filter(F.col("batch") == batch_id).limit(1).count())

    def commit(self, batch_id: str, changes: DataFrame) -> None:
        """``changes`` has source, lang, tokenizer_version (nulls are values like any other), tokens and sign.

        Null tokens count 0 and a null sign changes nothing; an empty batch is one without deltas. The reduction combines on the
        map side, so a source with a third of all rows sends one row per task. A batch id that is committed stays as it
        is: committing it again reads and writes nothing.
        """
        if self.committed(batch_id):
            return
        attempt = uuid.uuid4().hex
        deltas = changes.groupBy(*KEYS).agg(
            F.coalesce(F.sum("sign"), F.lit(0)).cast("long").alias("documents"),
            F.coalesce(F.sum(F.col("sign") * F.coalesce("tokens", F.lit(0))), F.lit(0)).cast("long").alias("tokens"),
        )
        deltas.write.parquet(f"{self.path}/deltas/attempt={attempt}")
        # Of two drivers with the same batch only one puts its commit; the other's deltas are named by nobody.
        name = hashlib.sha256(batch_id.encode()).hexdigest()
        files.put_once(self.spark, f"{self.path}/commits/{name}.json", json.dumps({"batch": batch_id, "attempt": attempt}))

    def _summed(self) -> DataFrame:
        commits, base = self._commits().join(self._covered(), "batch", "left_anti"), self._base()
        parts = self.spark.createDataFrame([], _DELTAS)
        if files.exists(self.spark, f"{self.path}/deltas"):
            deltas = self.spark.read.schema(_DELTAS + ", attempt string").parquet(f"{self.path}/deltas")
            parts = deltas.join(commits, "attempt", "left_semi").drop("attempt")
        if base:
            parts = parts.unionByName(self.spark.read.schema(_DELTAS).parquet(f"{base}/totals"))
        return parts.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer_version, documents, tokens) over committed batches; groups that fell to 0 go.

        Without any committed batch there is no group.
        """
        return self._summed().filter((F.col("documents") != 0) | (F.col("tokens") != 0))

    def compact(self) -> None:
        """Put the totals of all committed batches into one table and drop their own files.

        One process compacts at a time; commits may go on. The table lists its batches, and counts from the moment its name is
        put in place. Files of batches that only the table before it listed are dropped now.
        """
        before = self._covered()
        covered = self._commits().select("batch").unionByName(before).distinct()
        number = len([n for n in files.names(self.spark, f"{self.path}/bases") if n.endswith(".json")])
        base = f"{self.path}/bases/{number:08d}"
        # The batches first: one that commits in between is then neither listed nor summed.
        covered.write.mode("overwrite").parquet(f"{base}/batches")
        listed = self.spark.read.schema("batch string").parquet(f"{base}/batches")
        fresh = self._commits().join(listed, "batch", "left_semi").join(before, "batch", "left_anti")
        parts = self.spark.createDataFrame([], _DELTAS)
        if files.exists(self.spark, f"{self.path}/deltas"):
            deltas = self.spark.read.schema(_DELTAS + ", attempt string").parquet(f"{self.path}/deltas")
            parts = deltas.join(fresh, "attempt", "left_semi").drop("attempt")
        if self._base():
            parts = parts.unionByName(self.spark.read.schema(_DELTAS).parquet(f"{self._base()}/totals"))
        summed = parts.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        summed.coalesce(1).write.mode("overwrite").parquet(f"{base}/totals")
        old = self._commits().join(before, "batch", "left_semi").collect()  # as many as were committed between two compactions
        files.put_once(self.spark, f"{base}.json", "{}")
        for r in old:
            files.delete(self.spark, f"{self.path}/deltas/attempt={r['attempt']}")
            files.delete(self.spark, f"{self.path}/commits/{hashlib.sha256(r['batch'].encode()).hexdigest()}.json")


def changes_of(counted: DataFrame, sign: int, version: str) -> DataFrame:
    """Signed changes of counted documents, one per document and counter (words, and the tokenizer ``version``)."""
    counters = F.explode(
        F.array(
            F.struct(F.lit("words").alias("tokenizer_version"), F.col("words").alias("n")),
            F.struct(F.lit(version).alias("tokenizer_version"), F.col("tokens").alias("n")),
        )
    )
    return counted.select("source", "lang", counters.alias("c")).select(
        "source", "lang", "c.tokenizer_version", F.col("c.n").alias("tokens"), F.lit(sign).alias("sign")
    )
