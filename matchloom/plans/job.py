"""The end-to-end job: raw rows and known links in, model, threshold, links and reports out.

Every stage is a Parquet table under one folder, written whole by Spark's commit protocol; a stage whose
table is complete is read and not computed again, so a run that was stopped goes on where it was. Beside
each table stands a key of what it was made from: the content of the input rows, the stages before it and the
parameters. A run with other inputs under the same folder stops instead of reading their tables.
"""

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.operators import blocking, decide, features, keys, labels, metric, model, records
from matchloom.operators.profile import content_hash

INPUTS = features.RETRIEVAL + features.NAME + features.ADDRESS + features.CONTEXT + features.NUMBERS


class StaleStageError(RuntimeError):
    """A stage's table was made from other inputs or parameters."""


class Job:
    """Stages under ``folder`` (a path that all executors share)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.keys: dict[str, str] = {}

    def key(self, *made_from: object) -> str:
        """A digest of tables (their columns and rows in any order), earlier keys and parameters."""
        parts = [[sorted(x.columns), list(content_hash(x, sorted(x.columns)).first())] if isinstance(x, DataFrame) else x for x in made_from]
        return hashlib.sha256(json.dumps(parts, default=str).encode()).hexdigest()

    def _hold(self, name: str, key: str) -> None:
        self.keys[name] = key
        self.spark.createDataFrame([(key,)], "key string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/{name}_key")

    def _held(self, name: str) -> str:
        return self.spark.read.text(f"{self.folder}/{name}_key").first()[0]

    def done(self, name: str) -> bool:
        jvm, path = self.spark._jvm, f"{self.folder}/{name}/_SUCCESS"
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def stage(self, name: str, build, *made_from: object) -> DataFrame:
        key = self.key(name, *made_from)
        if not self.done(name):
            self._hold(name, key)
            build().write.mode("overwrite").option("compression", "zstd").parquet(f"{self.folder}/{name}")
        elif (held := self._held(name)) != key:
            raise StaleStageError(f"{self.folder}/{name} was made from other inputs ({held[:12]}, now {key[:12]}); remove it or choose another folder")
        self.keys[name] = key
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def records(self, name: str, raw: DataFrame, dictionary: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        """Cleaned rows and comparison records of raw rows (gid, src, country, business_name, business_address)."""
        silver = self.stage(f"{name}_silver", lambda: records.silver(raw, dictionary), raw, dictionary)
        return silver, self.stage(f"{name}_records", lambda: records.records(silver), self.keys[f"{name}_silver"])

    def candidates(self, name: str, silver: DataFrame, recs: DataFrame, s1: DataFrame) -> DataFrame:
        """All candidate lists of the first-side rows in ``s1`` (s1_gid) against the whole second side."""
        def build() -> DataFrame:
            mine = lambda d: d.filter("src = 1").join(s1.select(F.col("s1_gid").alias("gid")), "gid", "left_semi")
            pool = lambda d: d.filter("src <> 1")
            first = blocking.first_list(mine(silver), pool(silver))
            v3 = blocking.ranked_list(mine(recs), pool(recs), keys.NAME_KINDS, blocking.BEST_V3, "v3")
            return blocking.union_lists(first, v3, blocking.ranked_list(mine(recs), pool(recs), keys.ADDRESS_KINDS, blocking.BEST_VA, "va"))

        return self.stage(f"{name}_candidates", build, self.keys[f"{name}_records"], s1)

    def features(self, name: str, pairs: DataFrame, recs: DataFrame) -> DataFrame:
        def build() -> DataFrame:
            r1, r23 = recs.filter("src = 1"), recs.filter("src <> 1")
            numbers = features.number_features(pairs.select("s1_gid", "s23_gid"), r1, r23)
            return features.record_features(pairs, r1, r23).join(numbers, ["s1_gid", "s23_gid"])

        return self.stage(f"{name}_features", build, self.keys[f"{name}_candidates"])

    def train(self, raw: DataFrame, truth: DataFrame, rounds: int = 100, depth: int = 5) -> dict:
        """Splits first-side rows, trains on FIT, picks the threshold on half of VALIDATION and reports on the other half.

        ``truth``: s1_gid, s23_gid.
        """
        silver, recs = self.records("train", raw)
        s1 = raw.filter("src = 1").select("gid", F.concat(F.lit("S1-"), F.col("gid").cast("string")).alias("entity_id"), "country")
        linked = truth.join(raw.select(F.col("gid").alias("s23_gid"), F.col("src").alias("s23_src")), "s23_gid")
        split = self.stage("split", lambda: labels.split(labels.match_counts(linked, s1)), raw, truth)
        pairs = self.candidates("train", silver, recs, split.filter("split <> 'LOCKBOX'"))
        rows = self.features("train", pairs, recs)
        fit = model.labelled(rows.join(split.filter("split = 'FIT'").select("s1_gid"), "s1_gid", "left_semi"), truth)
        fitted = model.train(model.subsample(fit), INPUTS, rounds=rounds, depth=depth)
        fitted.write().overwrite().save(f"{self.folder}/model")
        self._hold("model", self.key(self.keys["train_features"], truth, rounds, depth))
        halves = labels.halves(split.filter("split = 'VALIDATION'"), 20_000).select("s1_gid", "country", "bucket", "half")
        scored = self.stage("validation_scored", lambda: model.predict(fitted, rows.join(halves.select("s1_gid"), "s1_gid", "left_semi")).select("s1_gid", "s23_gid", "prob"), self.keys["model"])
        side = lambda h: halves.filter(F.col("half") == h).drop("half")
        of = lambda d, h: d.join(side(h).select("s1_gid"), "s1_gid", "left_semi")
        threshold = decide.best_threshold(decide.threshold_curve(of(scored, "A"), of(truth, "A"), side("A"))).first()["threshold"]
        links = decide.at_threshold(of(scored, "B"), threshold)
        report = [r.asDict() for r in decide.score_links(links, of(truth, "B"), side("B")).collect()]  # a row for each country and bucket
        ceiling = metric.macro(metric.ceiling(of(pairs, "B"), of(truth, "B"), side("B"))).first()["f05"]
        out = {"threshold": threshold, "report": report, "ceiling": ceiling, "importance": model.importance(fitted)}
        self.spark.createDataFrame([(json.dumps(out),)], "report string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/report")
        return out

    def links(self, raw: DataFrame, threshold: float) -> DataFrame:
        """Links of new raw rows by the trained model."""
        from pyspark.ml import PipelineModel

        silver, recs = self.records("test", raw)
        pairs = self.candidates("test", silver, recs, raw.filter("src = 1").select(F.col("gid").alias("s1_gid")))
        rows = self.features("test", pairs, recs)
        fitted = PipelineModel.load(f"{self.folder}/model")
        scored = self.stage("test_scored", lambda: model.predict(fitted, rows).select("s1_gid", "s23_gid", "prob"), self.keys["test_features"], self._held("model"))
        return decide.at_threshold(scored, threshold)
