"""Record-linkage tables made from the driver's documents, in Spark and in SQL.

A document is a row: its id the gid, its language the country, every third id on the first side. The
first five words are the name, the next twelve the address in three parts. Two rows with equal texts are
a true link. House number and zip follow from lengths, so that copies agree on them.
"""

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.functions.durable import durable
from matchloom.operators.records import shares, skeleton

WORD = r"([^ \t\n\r\f\x0B]+)"
TOKEN = r"([^ .,;:!?|%$#*&()]+)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gid, src, country, business_name, business_address, text_key (digest of the whole text)."""
    space = r"[ \t\n\r\f\x0B]+"
    d = table(spark, sf_dir, "documents").withColumn("t", F.filter(F.slice(F.split(F.regexp_replace("text", "^" + space, ""), space, 18), 1, 17), lambda w: w != ""))  # words beyond the record stay unsplit
    part = lambda a: F.array_join(F.slice("t", a, 4), " ")
    address = F.array_join(F.filter(F.array(part(6), part(10), part(14)), lambda p: p != ""), ", ")
    src = F.when(F.col("doc_id") % 3 == 0, 1).otherwise(2 + F.col("doc_id") % 2).cast("int")
    return d.select(F.col("doc_id").alias("gid"), src.alias("src"), F.col("lang").alias("country"), F.array_join(F.slice("t", 1, 5), " ").alias("business_name"), address.alias("business_address"), F.sha2("text", 256).alias("text_key"))


_staged: dict[tuple[str, str], DataFrame] = {}


def fresh() -> None:
    """Forget the staged tables: every query stages its own."""
    _staged.clear()


def _once(build):
    """Written to the checkpoint folder the first time a query asks, as a pipeline stages its tables; later uses read the files."""

    @wraps(build)
    def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (build.__name__, sf_dir)
        if key not in _staged:
            _staged[key] = durable(build(spark, sf_dir))
        return _staged[key]

    return staged


@_once
def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as after cleaning: name_tokens, addr_components, addr_house_number, addr_zip, name_legal_form."""
    r = raw(spark, sf_dir)
    tokens = F.regexp_extract_all(F.lower("business_name"), F.lit(TOKEN))
    comps = F.when(F.col("business_address") == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(F.lower("business_address"), ", "), lambda p: F.array_join(F.regexp_extract_all(p, F.lit(TOKEN)), " ")))
    size = F.length("business_address")
    return r.select(
        "gid", "src", "country", "text_key", "business_name", "business_address",
        F.when(F.size(tokens) > 0, tokens).otherwise(F.array(F.lit(""))).alias("name_tokens"),
        comps.alias("addr_components"),
        (size % 37).cast("string").alias("addr_house_number"),
        (10000 + F.length("business_name") + size).cast("string").alias("addr_zip"),
        F.when(size % 4 == 0, "ltd").when(size % 4 == 1, "llc").otherwise("").alias("name_legal_form"),
    )


@_once
def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comparison records of the cleaned rows, with the region from the name's length."""
    c = cleaned(spark, sf_dir)
    size = F.length("business_name")
    t = F.col("name_tokens")
    out = c.select(
        "gid", "src", "country", F.lit("all").alias("dataset"), F.array_join(t, " ").alias("core"), F.array_join(t, "").alias("ns"),
        F.array_join(F.transform(t, lambda x: F.substring(x, 1, 1)), "").alias("ini"), F.get(t, F.lit(0)).alias("first"), F.get(t, F.size(t) - 1).alias("last"),
        F.size(t).alias("ntok"), F.col("name_legal_form").alias("legal"), F.lit(False).alias("indic"), F.array_join("addr_components", " ").alias("addr"),
        F.coalesce(F.get("addr_components", F.lit(0)), F.lit("")).alias("street"), F.coalesce(F.get("addr_components", F.size("addr_components") - 1), F.lit("")).alias("lastc"),
        F.when(size % 4 == 0, "").otherwise(F.concat(F.lit("r"), (size % 4).cast("string"))).alias("region"), F.col("addr_house_number").alias("hn"),
        F.array_join(F.array_sort(F.split("addr_house_number", "")), "").alias("hn_digits"), F.col("addr_zip").alias("zip"),
    )
    return shares(out.withColumn("skel", skeleton(F.col("ns"))))


def first_side(df: DataFrame) -> DataFrame:
    return df.filter("src = 1")


def second_side(df: DataFrame) -> DataFrame:
    return df.filter("src <> 1")


@_once
def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1_gid, s23_gid) of equal texts; a row of the second side belongs to the lowest first-side row."""
    r = raw(spark, sf_dir).select("gid", "src", "country", "text_key")
    low = first_side(r).groupBy("text_key", "country").agg(F.min("gid").alias("s1_gid"))
    return second_side(r).join(low, ["text_key", "country"]).select("s1_gid", F.col("gid").alias("s23_gid"))


_SKELETON = "replace(replace(replace(replace(replace(replace(ns, 'rn', 'm'), 'vv', 'w'), 'ph', 'f'), '0', 'o'), '1', 'l'), '5', 's')"
_TOKEN_SQL, _WORD_SQL = TOKEN[1:-1], WORD[1:-1]

#: Common table expressions of the same tables; queries append their own.
SQL = rf"""
WITH tk AS (SELECT doc_id, lang, text, regexp_extract_all(text, '{_WORD_SQL}') AS t FROM documents),
raw AS (
  SELECT doc_id AS gid, CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 2 + doc_id % 2 END AS src, lang AS country, array_to_string(t[1:5], ' ') AS business_name,
         array_to_string(list_filter([array_to_string(t[6:9], ' '), array_to_string(t[10:13], ' '), array_to_string(t[14:17], ' ')], lambda p: p <> ''), ', ') AS business_address, text
  FROM tk),
cleaned AS (
  SELECT gid, src, country, text, business_name, business_address,
         CASE WHEN len(regexp_extract_all(lower(business_name), '{_TOKEN_SQL}')) > 0 THEN regexp_extract_all(lower(business_name), '{_TOKEN_SQL}') ELSE [''] END AS name_tokens,
         CASE WHEN business_address = '' THEN [] ELSE list_transform(string_split(lower(business_address), ', '), lambda p: array_to_string(regexp_extract_all(p, '{_TOKEN_SQL}'), ' ')) END AS addr_components,
         (length(business_address) % 37)::VARCHAR AS addr_house_number, (10000 + length(business_name) + length(business_address))::VARCHAR AS addr_zip,
         CASE length(business_address) % 4 WHEN 0 THEN 'ltd' WHEN 1 THEN 'llc' ELSE '' END AS name_legal_form
  FROM raw),
rec0 AS (
  SELECT gid, src, country, array_to_string(name_tokens, ' ') AS core, array_to_string(name_tokens, '') AS ns, array_to_string(list_transform(name_tokens, lambda x: substr(x, 1, 1)), '') AS ini,
         name_tokens[1] AS first, name_tokens[-1] AS last, len(name_tokens) AS ntok, name_legal_form AS legal, array_to_string(addr_components, ' ') AS addr,
         coalesce(addr_components[1], '') AS street, coalesce(addr_components[-1], '') AS lastc,
         CASE WHEN length(business_name) % 4 = 0 THEN '' ELSE 'r' || (length(business_name) % 4) END AS region,
         addr_house_number AS hn, array_to_string(list_sort(string_split(addr_house_number, '')), '') AS hn_digits, addr_zip AS zip
  FROM cleaned),
bones AS (
  SELECT *, substr({_SKELETON}, 1, 1) || regexp_replace(substr({_SKELETON}, 2), '[aeiouy]', '', 'g') AS bone FROM rec0),
rec AS (
  SELECT * EXCLUDE (bone), array_to_string(list_filter(string_split(bone, ''), lambda c, i: c <> substr(bone, i::INT - 1, 1) OR i = 1 OR NOT regexp_matches(c, '[a-z0-9]')), '') AS skel,
         (count(*) FILTER (src = 1) OVER (PARTITION BY country, core))::DOUBLE / nullif(count(*) FILTER (src = 1) OVER (PARTITION BY country), 0) AS s1_share,
         (count(*) FILTER (src <> 1) OVER (PARTITION BY country, core))::DOUBLE / nullif(count(*) FILTER (src <> 1) OVER (PARTITION BY country), 0) AS s23_share
  FROM bones),
truth AS (
  SELECT l.s1_gid, r.gid AS s23_gid FROM raw r JOIN (SELECT text, country, min(gid) AS s1_gid FROM raw WHERE src = 1 GROUP BY ALL) l ON l.text = r.text AND l.country = r.country WHERE r.src <> 1)"""
