"""The batch chain over arriving files: only what is new is cleaned, labelled and scored."""

from __future__ import annotations

import re

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.classify import score_texts
from ..operators.lexicon import preprocess
from ..operators.quality import malformed, without_malformed
from ..session import staged
from ..sources.complaints import read_checked_complaints
from ..sources.stages import StageCatalog, read_parquet, write_parquet
from ..streaming.ingest import file_stream
from .jobs import label_rows, read_if_there

FILES = "path string, modificationTime timestamp, length bigint, content binary"
COMMIT = "files array<string>, n_malformed bigint, n_texts bigint"
STAGES = ("malformed", "preprocessed", "labeled", "scored")
SPECIAL = re.compile(r"([\\\[\]{}*?,])")  # in the patterns that readers take as paths


def new_files(spark: SparkSession, folder: str, pattern: str | None = None, max_files: int | None = None):
    """``path`` of the files that arrive in a folder; their content is not read here."""
    return file_stream(spark, folder, FILES, "binaryFile", pattern, max_files).select("path")


class ArrivingChain:
    """Preprocess, label and score the files of each arrival by saved models.

    Every batch has a partition of its own in each table below ``path``, and one commit
    record written last: the tables show committed batches only, so what a killed batch left
    is not seen, and is replaced when the batch is tried again. A batch that is committed is
    left as it is. ``path`` belongs to ``checkpoint``; a batch whose files are not those of
    its commit record is an error. The files of a batch, listed on the driver as by any
    reader, are limited by ``max_files`` of :func:`new_files`.
    """

    def __init__(
        self,
        lexicon: DataFrame,
        catalog: StageCatalog,
        classifier: PipelineModel,
        path: str,
        checkpoint: str,
        model: str = "lda",
        multi_line: bool = False,
    ):
        self.lexicon, self.catalog, self.classifier = lexicon, catalog, classifier
        self.path, self.checkpoint = path, checkpoint
        self.model, self.multi_line = model, multi_line

    def _of(self, name: str, batch_id: int) -> str:
        return f"{self.path}/{name}/batch={batch_id}"

    def _stage(self, rows: DataFrame, name: str, batch_id: int) -> DataFrame:
        path = self._of(name, batch_id)
        write_parquet(rows, path)
        return read_parquet(rows.sparkSession, path, rows.schema)

    def advance(self, arrived: DataFrame, batch_id: int) -> None:
        """All steps for the files of one batch."""
        spark = arrived.sparkSession
        files = sorted(r.path for r in arrived.distinct().collect())
        record = read_if_there(spark, self._of("commits", batch_id), COMMIT)
        done = record.collect() if record is not None else []
        if done:
            if done[0].files != files:
                raise ValueError(f"batch {batch_id} was committed with other files")
            return
        paths = [SPECIAL.sub(r"\\\1", f) for f in files]
        checked = staged(read_checked_complaints(spark, paths, self.multi_line), "arrived")
        bad = self._stage(malformed(checked), "malformed", batch_id)
        rows = preprocess(without_malformed(checked), self.lexicon)
        rows = self._stage(rows, "preprocessed", batch_id)
        labeled = self._stage(label_rows(rows, self.catalog, self.model), "labeled", batch_id)
        self._stage(score_texts(self.classifier, labeled, "id", "topic"), "scored", batch_id)
        write_parquet(
            spark.createDataFrame([(files, bad.count(), rows.count())], COMMIT).coalesce(1),
            self._of("commits", batch_id),
        )

    def run(self, arrived: DataFrame) -> None:
        """Take what has arrived (:func:`new_files`), and stop."""
        query = (
            arrived.writeStream.foreachBatch(self.advance)
            .option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def commits(self, spark: SparkSession) -> DataFrame:
        """``files, n_malformed, n_texts, batch`` of the committed batches."""
        return read_parquet(spark, f"{self.path}/commits", f"{COMMIT}, batch bigint")

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """One of ``STAGES`` with its ``batch``, of the committed batches."""
        if name not in STAGES:
            raise ValueError(f"name is one of {STAGES}")
        rows = read_parquet(spark, f"{self.path}/{name}").withColumn("batch", F.col("batch").cast("bigint"))
        return rows.join(self.commits(spark).select("batch"), "batch", "left_semi").select(*rows.columns)
