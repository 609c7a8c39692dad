"""Features of candidate pairs. Windows run over the complete candidate list of a row of the first side."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.functions.expr import first, jaccard
from matchloom.functions.ship import ship
from matchloom.functions.similarity import scores
from matchloom.operators.keys import address_words, full

RECORD_FIELDS = ["core", "ns", "ini", "first", "last", "ntok", "skel", "legal", "indic", "addr", "street", "region", "lastc", "hn", "hn_digits", "zip", "s1_share", "s23_share"]
RETRIEVAL = ["v1_score", "v1_rank", "v3_score", "v3_rank", "va_score", "va_rank"]
NAME = [
    "n_ratio", "n_partial", "n_tsort", "n_tset", "n_jw_ns", "n_jw_skel", "n_acr", "n_ini_prefix", "n_ini_eq", "n_contain", "n_first_eq", "n_last_eq",
    "n_len_ratio", "ntok_1", "ntok_2", "legal_eq", "legal_conflict", "indic_2", "s1_share_1", "s23_share_1", "s1_share_2",
]
ADDRESS = [
    "a_tset", "a_tsort", "a_street_tset", "reg_eq", "reg_conflict", "reg_missing", "reg_jw", "hn_eq", "hn_conflict", "hn_missing", "hn_dig_eq",
    "zip_eq", "zip_conflict", "zip_missing", "zip_p3", "zip_lev1", "a_len_1", "a_len_2",
]
CONTEXT = ["ctx_n_rank", "ctx_n_gap", "ctx_a_rank", "ctx_a_gap", "ctx_c_rank", "ctx_c_gap", "ctx_n_hi", "ctx_n_cand"]
NUMBERS = ["x_a_tset_nod", "x_a_ratio_nod", "x_num_tset", "x_num_lev", "x_num_jacc", "x_num_extra2", "x_num_miss2", "x_hn_absdiff"]
PSEUDO = ["pseudo_lm", "pseudo_oov", "pseudo_rare", "pseudo_score"]
MODEL_INPUTS = RETRIEVAL + NAME + ADDRESS + CONTEXT + NUMBERS + PSEUDO
CONFIDENT = 0.5


def _num(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")


def sides(pairs: DataFrame, s1: DataFrame, s23: DataFrame, columns: list[str]) -> DataFrame:
    """``pairs`` with ``columns`` of both rows, as name_1 and name_2."""
    a = s1.select(F.col("gid").alias("s1_gid"), *(F.col(c).alias(f"{c}_1") for c in columns))
    b = s23.select(F.col("gid").alias("s23_gid"), *(F.col(c).alias(f"{c}_2") for c in columns))
    return pairs.join(a, "s1_gid", "left").join(b, "s23_gid", "left")


def simple_features(pairs: DataFrame, s1: DataFrame, s23: DataFrame) -> DataFrame:
    """Set and equality features of cleaned rows. Two empty names share the token "" and so have a name Jaccard of 1."""
    d = sides(pairs, s1, s23, ["name_tokens", "addr_components", "addr_house_number", "addr_zip", "name_legal_form"])
    d = d.withColumns({f"_address_{i}": address_words(F.coalesce(F.col(f"addr_components_{i}"), F.array().cast("array<string>"))) for i in (1, 2)})
    both = lambda c: (F.col(f"{c}_1") != "") & (F.col(f"{c}_2") != "")
    same = lambda c: _num(both(c) & (F.col(f"{c}_1") == F.col(f"{c}_2")))
    d = d.withColumns(
        {
            "name_jaccard": jaccard(F.col("name_tokens_1"), F.col("name_tokens_2")),
            "name_overlap_n": F.size(F.array_intersect("name_tokens_1", "name_tokens_2")),
            "addr_token_jaccard": jaccard(F.col("_address_1"), F.col("_address_2")),
            "house_number_match": same("addr_house_number"),
            "zip_match": same("addr_zip"),
            "legal_form_match": same("name_legal_form"),
            "legal_form_both_present": _num(both("name_legal_form")),
        }
    )
    return d.select(*pairs.columns, "name_jaccard", "name_overlap_n", "addr_token_jaccard", "house_number_match", "zip_match", "legal_form_match", "legal_form_both_present")


def context(df: DataFrame, value: Column, prefix: str) -> DataFrame:
    """``df`` with the rank (ties share the lower) and the gap to the best of ``value`` within each s1_gid."""
    w = Window.partitionBy("s1_gid")
    df = df.withColumn("_v", value)
    return df.withColumns({f"{prefix}_rank": F.rank().over(w.orderBy(F.desc("_v"))), f"{prefix}_gap": F.max("_v").over(w) - F.col("_v")}).drop("_v")


def full_context(df: DataFrame) -> DataFrame:
    """All eight context features of n_tset and a_tset."""
    w = Window.partitionBy("s1_gid")
    df = df.withColumns({"ctx_n_hi": F.count_if(F.col("n_tset") >= 95).over(w), "ctx_n_cand": F.count("*").over(w)})
    for value, prefix in ((F.col("n_tset"), "ctx_n"), (F.col("a_tset"), "ctx_a"), (F.col("n_tset") + F.col("a_tset"), "ctx_c")):
        df = context(df, value, prefix)
    return df


def address_missing() -> Column:
    return (F.col("a_len_1") == 0) | (F.col("a_len_2") == 0)


def combined_without_address() -> Column:
    """Name similarity counts twice where an address is missing."""
    return F.col("n_tset") + F.when(address_missing(), F.col("n_tset")).otherwise(F.col("a_tset"))


def flags(d: DataFrame) -> DataFrame:
    """Equality, conflict and missing flags of records side by side (name_1, name_2); strings are never null."""
    c = F.col
    both = lambda x: (c(f"{x}_1") != "") & (c(f"{x}_2") != "")
    eq = lambda x: _num(both(x) & (c(f"{x}_1") == c(f"{x}_2")))
    conflict = lambda x: _num(both(x) & (c(f"{x}_1") != c(f"{x}_2")))
    missing = lambda x: _num(~both(x))
    many = lambda i: c(f"ntok_{i}") >= 2
    l1, l2 = F.length("ns_1"), F.length("ns_2")
    return d.withColumns(
        {
            "n_acr": _num(((c("ini_1") == c("ns_2")) & many(1)) | ((c("ini_2") == c("ns_1")) & many(2))),
            "n_ini_prefix": _num((many(1) & c("ns_2").startswith(c("ini_1"))) | (many(2) & c("ns_1").startswith(c("ini_2")))),
            "n_ini_eq": _num((c("ini_1") == c("ini_2")) & many(1)),
            "n_contain": _num((l1 >= 4) & (l2 >= 4) & (c("ns_2").contains(c("ns_1")) | c("ns_1").contains(c("ns_2")))),
            "n_first_eq": eq("first"), "n_last_eq": eq("last"),
            "n_len_ratio": F.least(l1, l2) / F.greatest(l1, l2, F.lit(1)),
            "legal_eq": eq("legal"), "legal_conflict": conflict("legal"), "indic_2": _num(c("indic_2")),
            "reg_eq": eq("region"), "reg_conflict": conflict("region"), "reg_missing": missing("region"),
            "hn_eq": eq("hn"), "hn_conflict": conflict("hn"), "hn_missing": missing("hn"), "hn_dig_eq": eq("hn_digits"),
            "zip_eq": eq("zip"), "zip_conflict": conflict("zip"), "zip_missing": missing("zip"),
            "zip_p3": _num(both("zip") & (F.substring("zip_1", 1, 3) == F.substring("zip_2", 1, 3))),
            "zip_lev1": _num(both("zip") & (F.levenshtein("zip_1", "zip_2") <= 1)),
            "a_len_1": F.length("addr_1"), "a_len_2": F.length("addr_2"),
        }
    )


def record_features(pairs: DataFrame, r1: DataFrame, r23: DataFrame) -> DataFrame:
    """``pairs`` with the name, address and context features of records."""
    ship(pairs.sparkSession)
    d = sides(pairs, r1, r23, RECORD_FIELDS)
    text = [f"{c}_{i}" for c in RECORD_FIELDS if c not in ("ntok", "indic", "s1_share", "s23_share") for i in (1, 2)]
    d = d.fillna("", text).fillna(0, ["ntok_1", "ntok_2"]).fillna(0.0, ["s1_share_1", "s23_share_1", "s1_share_2"]).fillna(False, ["indic_2"])
    c = F.col
    kernels = [
        ("n_ratio", "ratio", "core"), ("n_partial", "partial", "core"), ("n_tsort", "token_sort", "core"), ("n_tset", "token_set", "core"),
        ("n_jw_ns", "jaro_winkler", "ns"), ("n_jw_skel", "jaro_winkler", "skel"), ("a_tset", "token_set", "addr"), ("a_tsort", "token_sort", "addr"),
        ("a_street_tset", "token_set", "street"), ("reg_jw", "jaro_winkler", "lastc"),
    ]
    d = d.withColumn("_k", scores([(name, kernel, c(f"{f}_1"), c(f"{f}_2")) for name, kernel, f in kernels]))
    d = flags(d.select("*", "_k.*").drop("_k"))
    return full_context(d.select(*pairs.columns, *(f for f in NAME + ADDRESS)))


def _without_numbers(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"(?U)\b\w*\d\w*\b", " "), r"(?U)\s+", " "))


def _numbers(c: Column) -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit(r"(?U)(\d+)")), lambda x: F.coalesce(F.nullif(F.ltrim(x, F.lit("0")), F.lit("")), F.lit("0")))


def number_sets(pairs: DataFrame, r1: DataFrame, r23: DataFrame) -> DataFrame:
    """``pairs`` with what the numbers of both addresses share; all built-in."""
    d = sides(pairs, r1, r23, ["addr"]).fillna("", ["addr_1", "addr_2"])
    d = d.withColumns({"m1": _numbers(F.col("addr_1")), "m2": _numbers(F.col("addr_2"))})
    union = F.size(F.array_union("m1", "m2"))
    head = lambda m: F.substring(first(F.col(m)), 1, 7).try_cast("long")
    return d.withColumns(
        {
            "x_num_lev": F.least(F.levenshtein(F.array_join("m1", ""), F.array_join("m2", "")), F.lit(9)).cast("double"),
            "x_num_jacc": F.when(union == 0, -1.0).otherwise(F.size(F.array_intersect("m1", "m2")) / F.greatest(union, F.lit(1))),
            "x_num_extra2": F.size(F.array_except("m2", "m1")).cast("double"),
            "x_num_miss2": F.size(F.array_except("m1", "m2")).cast("double"),
            "x_hn_absdiff": F.coalesce(F.when(F.abs(head("m1") - head("m2")) > 1000, 1000).otherwise(F.abs(head("m1") - head("m2"))), F.lit(-1)).cast("double"),
        }
    )


def number_features(pairs: DataFrame, r1: DataFrame, r23: DataFrame) -> DataFrame:
    """``pairs`` with all eight features of addresses without numbers, and of numbers alone."""
    ship(pairs.sparkSession)
    d = number_sets(pairs, r1, r23)
    a, b = (_without_numbers(F.col(f"addr_{i}")) for i in (1, 2))
    n1, n2 = F.array_join("m1", " "), F.array_join("m2", " ")
    d = d.withColumn("_k", scores([("x_a_tset_nod", "token_set", a, b), ("x_a_ratio_nod", "ratio", a, b), ("x_num_tset", "token_set", n1, n2)]))
    return d.select(*pairs.columns, "_k.*", *NUMBERS[3:])


def with_pseudo(df: DataFrame, pseudo: DataFrame | None) -> DataFrame:
    """Pseudo-word scores of the second side from a given table (gid, ...); 0 where it has none."""
    if pseudo is None:
        return df.withColumns({c: F.lit(0.0) for c in PSEUDO})
    return df.join(pseudo.select(F.col("gid").alias("s23_gid"), *PSEUDO), "s23_gid", "left").fillna(0.0, PSEUDO)


def group_context(df: DataFrame) -> DataFrame:
    """How a candidate of the first list compares with the others of its s1_gid."""
    g = Window.partitionBy("s1_gid")
    c = F.col
    dense = lambda x: F.dense_rank().over(g.orderBy(F.desc(x)))
    return df.withColumns(
        {
            "n_cand_s1": F.count("*").over(g),
            "score_rel_max": F.try_divide(c("blocking_score"), F.max("blocking_score").over(g)),
            "score_gap_top": F.max("blocking_score").over(g) - c("blocking_score"),
            "name_jac_rank": dense("name_jaccard"),
            "name_jac_rel_max": F.coalesce(F.try_divide(c("name_jaccard"), F.max("name_jaccard").over(g)), F.lit(0.0)),
            "n_exact_name_s1": F.count_if(c("name_jaccard") == 1.0).over(g),
            "addr_jac_rank": dense("addr_token_jaccard"),
            "n_s1_sharing_s23": F.count("*").over(Window.partitionBy("s23_gid")),
        }
    )


def rivals(df: DataFrame, prob: str = "p1") -> DataFrame:
    """``df`` with p1_rank, p1_max_other and p1_n_conf_other: the other candidates' first-pass probabilities."""
    g = Window.partitionBy("s1_gid")
    order = g.orderBy(F.desc(prob), "s23_gid")
    best = F.max(prob).over(g)
    df = df.withColumn("p1_rank", F.row_number().over(order))
    second = F.coalesce(F.max(F.when(F.col("p1_rank") == 2, F.col(prob))).over(g), F.lit(0.0))
    sure = F.col(prob) >= CONFIDENT
    return df.withColumns({"p1_max_other": F.when(F.col(prob) >= best, second).otherwise(best), "p1_n_conf_other": F.count_if(sure).over(g) - sure.cast("int")})


def siblings(df: DataFrame, r23: DataFrame, prob: str = "p1") -> DataFrame:
    """``df`` with sib_name_max, sib_addr_max, sib_both_max: best similarity to another confident candidate of the s1_gid; -1 without one."""
    ship(df.sparkSession)
    sure = df.filter(F.col(prob) >= CONFIDENT).select("s1_gid", F.col("s23_gid").alias("sib"))
    p = df.select("s1_gid", "s23_gid").join(sure, "s1_gid").filter(F.col("s23_gid") != F.col("sib"))
    of = lambda i, n: r23.select(F.col("gid").alias(i), F.col("core").alias(f"c{n}"), F.col("addr").alias(f"a{n}"))
    p = p.join(of("s23_gid", 1), "s23_gid", "left").join(of("sib", 2), "sib", "left").fillna("", ["c1", "a1", "c2", "a2"])
    p = p.withColumn("k", scores([("n", "token_set", F.col("c1"), F.col("c2")), ("a", "token_set", F.col("a1"), F.col("a2"))]))
    best = p.groupBy("s1_gid", "s23_gid").agg(F.max("k.n").alias("sib_name_max"), F.max("k.a").alias("sib_addr_max"), F.max((F.col("k.n") + F.col("k.a")) / 2).alias("sib_both_max"))
    return df.join(best, ["s1_gid", "s23_gid"], "left").fillna(-1.0, ["sib_name_max", "sib_addr_max", "sib_both_max"])


def soundex_code(c: Column) -> Column:
    """American Soundex of the letters of c; empty without letters."""
    letters = F.regexp_replace(F.lower(c), "[^a-z]", "")
    return F.when(letters == "", "").otherwise(F.soundex(letters))


def soundex_features(df: DataFrame, a: str = "core_1", b: str = "core_2") -> DataFrame:
    """``df`` with snd_eq (whole names sound alike) and snd_jacc (share of words that do)."""
    whole = lambda x: soundex_code(F.replace(F.col(x), F.lit(" "), F.lit("")))
    codes = lambda x: F.array_distinct(F.transform(full(F.split(x, " ")), soundex_code))
    df = df.withColumns({"_w1": whole(a), "_w2": whole(b), "_s1": codes(a), "_s2": codes(b)})
    return df.withColumns({"snd_eq": _num((F.col("_w1") != "") & (F.col("_w1") == F.col("_w2"))), "snd_jacc": jaccard(F.col("_s1"), F.col("_s2"))}).drop("_w1", "_w2", "_s1", "_s2")
