"""Document frequencies, profiles, integrity of ids, content hashes and gates."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.functions.expr import is_in, strip


def token_frequency(df: DataFrame, name: str = "name_clean", addr: str = "addr_clean", by: str = "country") -> DataFrame:
    """(by, token, df, idf): rows of a group that have the token; idf = ln((n+1)/(df+1)) + 1."""
    tokens = lambda c: F.filter(F.split(c, " "), lambda x: x != "")
    n = df.groupBy(by).agg(F.count("*").alias("n"))
    t = df.select(by, F.explode(F.array_distinct(F.concat(tokens(name), tokens(addr)))).alias("token")).groupBy(by, "token").agg(F.count("*").alias("df"))
    return t.join(F.broadcast(n), by).select(by, "token", "df", (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1).alias("idf"))  # n: a row for each group


def merged_frequency(parts: list[DataFrame], sizes: list[DataFrame], by: str = "country") -> DataFrame:
    """The same from partial counts (by, token, df) and (by, n) of several tables."""
    def union(frames: list[DataFrame]) -> DataFrame:
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    n = union(sizes).groupBy(by).agg(F.sum("n").alias("n"))
    t = union(parts).groupBy(by, "token").agg(F.sum("df").alias("df"))
    return t.join(F.broadcast(n), by).select(by, "token", "df", (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def profile(df: DataFrame, col: str, by: str = "country") -> DataFrame:
    """Per group: rows, percentages of empty, null-like, accented, capital, non-ASCII and double-spaced texts, length quantiles."""
    c = F.col(col)
    pct = lambda cond: F.round(100.0 * F.avg(F.coalesce(cond, F.lit(False)).cast("int")), 6)
    has_null = F.exists(F.split(c, ","), lambda p: is_in(F.lower(strip(p)), ["null", "<null>", "none", "n/a", "na"]))
    return df.groupBy(by).agg(
        F.count("*").alias("n"),
        pct(c == "").alias("pct_empty"),
        pct(has_null).alias("pct_null_part"),
        pct(c.rlike("[À-ɏ]")).alias("pct_accent"),
        pct(c.rlike("[ऀ-ॿ]")).alias("pct_devanagari"),
        pct((c != "") & (c == F.upper(c)) & (c != F.lower(c))).alias("pct_upper"),
        pct((c != "") & (c == F.lower(c)) & (c != F.upper(c))).alias("pct_lower"),
        pct(c.contains("  ")).alias("pct_double_space"),
        pct(c.rlike(r"[^\x00-\x7F]")).alias("pct_non_ascii"),
        F.expr(f"percentile_disc(0.5) within group (order by length({col}))").alias("p50_length"),
        F.expr(f"percentile_disc(0.99) within group (order by length({col}))").alias("p99_length"),
    )


def id_integrity(rows: DataFrame) -> DataFrame:
    """(dataset, src, n, repeated_ids, malformed_ids, empty_country) of raw rows (dataset, src, entity_id, country)."""
    per_id = rows.groupBy("dataset", "src", "entity_id").agg(F.count("*").alias("c"), F.count_if(F.coalesce("country", F.lit("")) == "").alias("e"))
    bad = ~F.col("entity_id").rlike(r"^S\d+-\d+$") | (F.substring_index(F.substring("entity_id", 2, 100), "-", 1) != F.col("src").cast("string"))
    return per_id.groupBy("dataset", "src").agg(F.sum("c").alias("n"), F.sum(F.col("c") - 1).alias("repeated_ids"), F.sum(F.when(bad, F.col("c")).otherwise(0)).alias("malformed_ids"), F.sum("e").alias("empty_country"))


def shared_ids(a: DataFrame, b: DataFrame, col: str = "entity_id") -> DataFrame:
    """Ids that both tables have."""
    return a.select(col).intersect(b.select(col))


def content_hash(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row (n, content_hash) that depends on the rows but not on their order or partitioning.

    The sum of 64-bit row hashes as a decimal: one partial aggregation, no sort, no collected list. A null counts where it stands.
    """
    marked = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]  # the hash function itself skips nulls
    return df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64(*marked).cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)")).cast("string").alias("content_hash"))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Equal as multisets of rows."""
    return not a.exceptAll(b).limit(1).count() and not b.exceptAll(a).limit(1).count()


@dataclass
class Gate:
    name: str
    passed: bool
    measured: object
    expected: object = None


class Gates:
    """Named checks; publishing needs all of them."""

    def __init__(self):
        self.found: list[Gate] = []

    def add(self, name: str, passed: bool, measured: object, expected: object = None) -> None:
        self.found.append(Gate(name, bool(passed), measured, expected))

    def require(self) -> None:
        if bad := [g for g in self.found if not g.passed]:
            raise AssertionError("; ".join(f"{g.name}: {g.measured} (expected {g.expected})" for g in bad))


def characters(df: DataFrame, col: str, by: str = "country") -> DataFrame:
    """(by, kind, n): characters that cleaning treats specially, counted."""
    one = lambda pattern: F.sum(F.regexp_count(F.col(col), F.lit(pattern)))
    kinds = {"control": r"[\x00-\x08\x0E-\x1F\x7F]", "c1_control": r"[\x80-\x9F]", "format": r"\p{Cf}", "latin_accented": "[À-ɏ]", "other_digit": r"(?U)(?![0-9])\d", "indic": "[ऀ-ൿ]"}
    g = df.groupBy(by).agg(*(one(p).alias(k) for k, p in kinds.items()))
    return g.unpivot([by], list(kinds), "kind", "n")
