"""Links from the ground truth, their integrity, stratified splits and the stress set."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED, FIT, VALIDATION = 20260925, 0.7, 0.2
STRATUM_TOLERANCE = 0.1


def parsed(truth: DataFrame) -> DataFrame:
    """(s1_id, ids): the comma lists of the ground truth; an empty text is no id."""
    ids = F.when(F.col("matched_entity_ids") == "", F.array().cast("array<string>")).otherwise(F.split("matched_entity_ids", ","))
    return truth.select(F.col("source1_entity_id").alias("s1_id"), ids.alias("ids"))


def links(truth: DataFrame, s1: DataFrame, s23: DataFrame) -> DataFrame:
    """(s1_gid, s1_id, s23_gid, s23_id, s23_src). ``s1``: entity_id, gid, country; ``s23`` also src."""
    pairs = parsed(truth).select("s1_id", F.explode("ids").alias("s23_id")).filter("s23_id <> ''")
    out = pairs.join(s1.select(F.col("entity_id").alias("s1_id"), F.col("gid").alias("s1_gid")), "s1_id", "left")
    out = out.join(s23.select(F.col("entity_id").alias("s23_id"), F.col("gid").alias("s23_gid"), F.col("src").alias("s23_src")), "s23_id", "left")
    return out.select("s1_gid", "s1_id", "s23_gid", "s23_id", "s23_src")


def match_counts(found: DataFrame, s1: DataFrame) -> DataFrame:
    """(s1_gid, s1_id, country, n_s2, n_s3, n_total, is_singleton, bucket) of every row of ``s1``."""
    counts = found.groupBy("s1_gid").agg(F.count_if(F.col("s23_src") == 2).alias("n_s2"), F.count_if(F.col("s23_src") == 3).alias("n_s3"), F.count("*").alias("n_total"))
    out = s1.select(F.col("gid").alias("s1_gid"), F.col("entity_id").alias("s1_id"), "country").join(counts, "s1_gid", "left").fillna(0, ["n_s2", "n_s3", "n_total"])
    return out.withColumns({"is_singleton": F.col("n_total") == 0, "bucket": bucket(F.col("n_total"))})


def bucket(n: Column) -> Column:
    return F.when(n == 0, "0").when(n <= 2, "1-2").when(n <= 4, "3-4").otherwise("5+")


def integrity(truth: DataFrame, s1: DataFrame, s23: DataFrame) -> DataFrame:
    """(check, violations): what a valid ground truth has none of."""
    ids, known = parsed(truth), s1.select(F.col("entity_id").alias("s1_id"), F.col("country").alias("c1"))
    pairs = ids.select("s1_id", F.explode("ids").alias("s23_id")).filter("s23_id <> ''")
    joined = pairs.join(s23.select(F.col("entity_id").alias("s23_id"), F.col("country").alias("c2"), F.lit(1).alias("there")), "s23_id", "left").join(known, "s1_id", "left")
    one = lambda df, name: df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")
    found = [
        one(known.join(ids, "s1_id", "left_anti"), "first_side_without_row"),
        one(ids.join(known, "s1_id", "left_anti"), "row_without_first_side"),
        one(ids.groupBy("s1_id").count().filter("count > 1"), "first_side_repeated"),
        one(ids.filter(F.size("ids") != F.size(F.array_distinct("ids"))), "id_repeated_in_list"),
        one(ids.filter(F.array_contains("ids", "")), "empty_id_in_list"),
        one(joined.filter("there is null"), "unknown_second_side"),
        one(pairs.groupBy("s23_id").agg(F.countDistinct("s1_id").alias("n")).filter("n > 1"), "second_side_linked_twice"),
        one(joined.filter("c1 <> c2"), "countries_differ"),
    ]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def hash_key(salt: str, entity_id: Column) -> Column:
    """SHA-256 of seed|salt|id."""
    return F.sha2(F.concat_ws("|", F.lit(str(SEED)), F.lit(salt), entity_id), 256)


def split(counts: DataFrame) -> DataFrame:
    """``counts`` with split: of each (country, bucket) by hash, the first 70 % FIT, the next 20 % VALIDATION, the rest LOCKBOX.

    Ranks need the order within a stratum, of which there are four for each country; the sort spills.
    """
    w = Window.partitionBy("country", "bucket")
    d = counts.withColumns({"_r": F.row_number().over(w.orderBy(hash_key("split", F.col("s1_id")))), "_n": F.count("*").over(w)})
    fit, val = F.floor(F.col("_n") * FIT), F.floor(F.col("_n") * VALIDATION)
    return d.withColumn("split", F.when(F.col("_r") <= fit, "FIT").when(F.col("_r") <= fit + val, "VALIDATION").otherwise("LOCKBOX")).drop("_r", "_n")


def split_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """(s1_id, split_a, split_b) of rows that differ or are on one side only."""
    j = a.select("s1_id", F.col("split").alias("split_a")).join(b.select("s1_id", F.col("split").alias("split_b")), "s1_id", "full_outer")
    return j.filter(~F.col("split_a").eqNullSafe(F.col("split_b")))


def stress_targets(train: DataFrame, test: DataFrame) -> DataFrame:
    """(country, n_s1, ratio_train, ratio_test, n_hide): first-side rows to hide so that both pools are as crowded.

    ``train`` and ``test``: rows with country and src. Countries missing from either side have no target.
    """
    def sizes(d: DataFrame, name: str) -> DataFrame:
        one = F.col("src") == 1
        return d.groupBy("country").agg(F.count_if(one).alias(f"n_{name}"), F.count_if(~one).alias(f"pool_{name}")).filter(F.col(f"n_{name}") > 0)

    j = sizes(train, "train").join(sizes(test, "test").filter("pool_test > 0"), "country")
    j = j.withColumns({"ratio_train": F.col("pool_train") / F.col("n_train"), "ratio_test": F.col("pool_test") / F.col("n_test")})
    hide = F.greatest(F.lit(0.0), 1 - F.col("ratio_train") / F.col("ratio_test"))
    return j.select("country", F.col("n_train").alias("n_s1"), "ratio_train", "ratio_test", F.bround(hide * F.col("n_train"), 0).cast("long").alias("n_hide"))


def stress(assigned: DataFrame, targets: DataFrame) -> DataFrame:
    """``assigned`` with stress_hidden: the FIT rows of lowest stress hash, as many as the country's target."""
    d = assigned.join(F.broadcast(targets.select("country", "n_hide")), "country", "left")  # a row for each country
    w = Window.partitionBy("country", "split").orderBy(hash_key("stress", F.col("s1_id")))
    hidden = (F.col("split") == "FIT") & (F.row_number().over(w) <= F.coalesce("n_hide", F.lit(0)))
    return d.withColumn("stress_hidden", hidden).drop("n_hide")


def strata(assigned: DataFrame) -> DataFrame:
    """(country, bucket, split, n, share, off_by): how far each stratum is from 70/20/10, in percentage points."""
    w = Window.partitionBy("country", "bucket")
    g = assigned.groupBy("country", "bucket", "split").agg(F.count("*").alias("n"))
    g = g.withColumn("share", 100.0 * F.col("n") / F.sum("n").over(w))
    want = F.when(F.col("split") == "FIT", 70.0).when(F.col("split") == "VALIDATION", 20.0).otherwise(10.0)
    return g.withColumn("off_by", F.abs(F.col("share") - want))


def sample(rows: DataFrame, n: int, by: str = "country", id_col: str = "s1_gid", seed: int = SEED) -> DataFrame:
    """``n`` rows of each group, those of lowest hash: the same rows on every run."""
    w = Window.partitionBy(by).orderBy(F.xxhash64(id_col, F.lit(seed)), id_col)
    return rows.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def halves(rows: DataFrame, n: int, by: str = "country", id_col: str = "s1_gid") -> DataFrame:
    """A sample with half A or B."""
    w = Window.partitionBy(by).orderBy(F.xxhash64(id_col, F.lit(SEED + 1)), id_col)
    return sample(rows, n, by, id_col).withColumn("half", F.when(F.row_number().over(w) % 2 == 1, "A").otherwise("B"))
