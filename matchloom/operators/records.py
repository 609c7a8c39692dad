"""Cleaning of raw rows ("silver") and comparison records."""

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.functions import addresses, names, script, text
from matchloom.functions.expr import INDIC, first, is_in, last, mapped
from matchloom.functions.ship import ship
from matchloom.functions.tables import LEGAL_CANON, LEGAL_WORDS, STATES, STOP_WORDS, STREET_SHORT, STREET_SHORT_BY_COUNTRY, TITLES, WEB_LEAD, WEB_MARK, WEB_TAIL

NATIVE_SUPPORT, NATIVE_SHARE = 20, 0.9


def silver(raw: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Cleaned rows of ``raw`` (gid, country, business_name, business_address, ...): text, scripts, names, addresses.

    Every row stays. An empty name has the single token "". Native words are translated by
    ``dictionary`` before names are cleaned, so that translated legal words are recognised.
    """
    ship(raw.sparkSession)
    df = text.clean_addresses(raw.withColumn("name", text.clean(F.col("business_name"))))
    df = df.withColumn("name_script_flags", script.scripts(F.col("name")))
    if dictionary is not None:
        df = script.apply_dictionary(df, dictionary)
    else:
        df = df.withColumns({"name_translit": F.col("name"), "name_indic_untranslated": F.col("name").rlike(f"[{script.BLOCKS}]"), "name_token_variants": F.lit(None).cast("string")})
    df = addresses.with_clean_addresses(names.with_clean_names(df, "name_translit"))
    return df.drop("name", "name_translit").withColumn("name_tokens", F.split("name_clean", " "))


def skeleton(ns: Column) -> Column:
    """Name without spaces, reduced to what survives reading and typing errors."""
    pairs = (("rn", "m"), ("vv", "w"), ("ph", "f"), ("0", "o"), ("1", "l"), ("5", "s"))
    s = reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, ns)
    s = F.concat(F.substring(s, 1, 1), F.regexp_replace(F.substring(s, 2, 1_000_000), "[aeiouy]", ""))
    return F.regexp_replace(s, r"([a-z0-9])\1+", "$1")


def bare_name(s: Column) -> Column:
    """Space-joined name tokens without web words, spelled-out legal tails ("s a s" becomes "sas"), titles.

    Every step is anchored text replacement, so the name is read once a step and no step refers to the
    step before it twice. Words of a web tail that aren't marks of a web name by themselves only go while
    a web word still leads.
    """
    either = "|".join
    s = F.regexp_replace(s, f"^(?:(?:{either(WEB_LEAD)})(?: |$)){{1,2}}", "")
    s = F.regexp_replace(s, f"^((?:{either(WEB_LEAD)})(?: .*?)?)(?: (?:{either(WEB_TAIL)})){{1,3}}$|(?: (?:{either(WEB_MARK)})){{1,3}}$", "$1")
    for k in (4, 3, 2):
        for word in sorted(w for w in LEGAL_WORDS if len(w) == k):
            s = F.regexp_replace(s, f"(?<=[^ ] ){' '.join(word)}$", word)
    s = F.regexp_replace(s, "^m s (?=[^ ])", "")
    return F.regexp_replace(s, f"^(?:(?:{either(TITLES)}) ){{1,2}}", "")


def name_fields(df: DataFrame) -> DataFrame:
    """``df`` (name_tokens, name_legal_form, ...) with indic, legal, core, ns, ini, first, last, ntok, skel."""
    t, c = F.col("_t"), F.col("_c")
    joined = F.array_join("name_tokens", " ")
    ascii_only = ~joined.rlike(r"[^\x00-\x7F]")
    roman = F.when(ascii_only, F.col("name_tokens")).otherwise(F.pandas_udf(_romanised_tokens, "array<string>")(F.when(~ascii_only, F.col("name_tokens"))))
    df = df.withColumns({"_roman": roman, "indic": joined.rlike(INDIC)})
    tokens = F.filter(F.transform("_roman", lambda x: F.replace(x, F.lit(" "), F.lit(""))), lambda x: x != "")
    df = df.withColumn("_t", F.filter(F.split(bare_name(F.array_join(tokens, " ")), " "), lambda x: x != ""))
    legal = F.concat(F.split(F.coalesce("name_legal_form", F.lit("")), " "), F.filter(t, lambda x: is_in(x, LEGAL_WORDS)))
    legal = F.array_join(F.array_sort(F.array_distinct(F.filter(F.transform(legal, lambda x: mapped(x, LEGAL_CANON)), lambda x: x != ""))), " ")
    df = df.withColumns({"legal": legal, "_core": F.filter(t, lambda x: ~is_in(x, LEGAL_WORDS + STOP_WORDS))})
    df = df.withColumn("_c", F.when(F.size("_core") > 0, F.col("_core")).otherwise(t))
    df = df.withColumns(
        {
            "core": F.array_join(c, " "),
            "ns": F.array_join(c, ""),
            "ini": F.array_join(F.transform(c, lambda x: F.substring(x, 1, 1)), ""),
            "first": F.coalesce(first(c), F.lit("")),
            "last": F.coalesce(last(c), F.lit("")),
            "ntok": F.size(c),
        }
    )
    return df.withColumn("skel", skeleton(F.col("ns"))).drop("_t", "_c", "_core", "_roman")


def _romanised_tokens(s: pd.Series) -> pd.Series:
    return pd.Series([None if a is None else [x if x.isascii() else script.romanised(x) for x in a] for a in s], dtype=object)


def state_table(spark) -> DataFrame:
    """(country, comp_ascii, code): states by name and by code."""
    rows = sorted({(c, k, code) for c, table in STATES.items() for name, code in table.items() for k in (name, code)})
    seen = {}
    for c, k, code in rows:  # a key that is both a name and another state's code keeps the name's code
        seen[c, k] = STATES[c].get(k, code)
    return spark.createDataFrame([(c, k, code) for (c, k), code in seen.items()], "country string, comp_ascii string, code string")


def address_components(df: DataFrame) -> DataFrame:
    """(gid, country, pos, comp, comp_ascii, code): one row for each component that has a letter or digit."""
    c = df.select("gid", "country", F.posexplode("addr_components").alias("pos", "raw"))
    c = c.select("gid", "country", "pos", F.trim(F.regexp_replace(F.lower("raw"), r"[^\p{L}\p{M}\p{N}]+", " ")).alias("comp")).filter("comp <> ''")
    c = c.withColumn("comp_ascii", script.romanise(F.col("comp")))
    return c.join(F.broadcast(state_table(df.sparkSession)), ["country", "comp_ascii"], "left")  # a fixed table of about 200 rows


def learn_native_states(s1_comps: DataFrame, s23_comps: DataFrame, links: DataFrame) -> DataFrame:
    """(country, comp, native_code, n, tot): native-script components that stand for a state, from linked pairs."""
    code = s1_comps.filter("code is not null").groupBy(F.col("gid").alias("s1_gid")).agg(F.min_by("code", "pos").alias("native_code"))
    native = s23_comps.filter(F.col("comp").rlike(INDIC)).select(F.col("gid").alias("s23_gid"), "country", "comp")
    counts = links.select("s1_gid", "s23_gid").join(code, "s1_gid").join(native, "s23_gid").groupBy("country", "comp", "native_code").agg(F.count("*").alias("n"))
    of = Window.partitionBy("country", "comp")
    best = counts.withColumns({"tot": F.sum("n").over(of), "r": F.row_number().over(of.orderBy(F.desc("n"), "native_code"))})
    return best.filter((F.col("r") == 1) & (F.col("n") >= NATIVE_SUPPORT) & (F.col("n") / F.col("tot") >= NATIVE_SHARE)).drop("r")


def address_fields(df: DataFrame, comps: DataFrame, native: DataFrame | None = None) -> DataFrame:
    """(gid, hn, zip, hn_digits, addr, street, region, lastc) of every row of ``df``.

    The first component that names a state gives the region and leaves the address; the last component
    counts with it.
    """
    if native is not None:
        comps = comps.join(native.select("country", "comp", "native_code"), ["country", "comp"], "left").withColumn("code", F.coalesce("code", "native_code")).drop("native_code")
    def shortened(table: dict[str, str]) -> Column:
        return F.transform(F.split("comp_ascii", " "), lambda x: mapped(x, table))

    canon = shortened(STREET_SHORT)
    for country, table in STREET_SHORT_BY_COUNTRY.items():
        canon = F.when(F.col("country") == country, shortened(STREET_SHORT | table)).otherwise(canon)
    rows = F.sort_array(F.collect_list(F.struct("pos", "canon", "comp_ascii", "code")))
    per = comps.withColumn("canon", F.array_join(canon, " ")).groupBy("gid").agg(rows.alias("r"))  # one address each
    coded = F.get(F.filter("r", lambda x: x["code"].isNotNull()), F.lit(0))
    per = per.withColumn("state", coded)
    rest = F.filter("r", lambda x: F.col("state").isNull() | (x["pos"] != F.col("state")["pos"]))
    per = per.select("gid", F.array_join(F.transform(rest, lambda x: x["canon"]), " ").alias("addr"), F.get(rest, F.lit(0))["canon"].alias("street"), F.col("state")["code"].alias("region"), last(F.col("r"))["comp_ascii"].alias("lastc"))
    hn = F.ltrim(F.regexp_replace(F.lower(F.coalesce("addr_house_number", F.lit(""))), "[^0-9a-z]", ""), F.lit("0"))
    digits = F.array_join(F.array_sort(F.regexp_extract_all("hn", F.lit(r"(\d)"))), "")
    base = df.select("gid", hn.alias("hn"), F.coalesce("addr_zip", F.lit("")).alias("zip")).withColumn("hn_digits", digits)
    return base.join(per, "gid", "left").fillna("", ["addr", "street", "region", "lastc"])


def shares(records: DataFrame) -> DataFrame:
    """``records`` (dataset, country, src, core, ...) with s1_share and s23_share: how common the core is in each pool of its country."""
    one = F.col("src") == 1
    by_core = records.groupBy("dataset", "country", "core").agg(F.count_if(one).alias("_same1"), F.count_if(~one).alias("_same23"))
    pools = by_core.groupBy("dataset", "country").agg(F.sum("_same1").alias("_pool1"), F.sum("_same23").alias("_pool23"))
    out = records.join(by_core, ["dataset", "country", "core"], "left").join(pools, ["dataset", "country"], "left")
    share = lambda n, total: F.coalesce(F.try_divide(F.col(n).cast("double"), F.col(total)), F.lit(0.0))
    return out.withColumns({"s1_share": share("_same1", "_pool1"), "s23_share": share("_same23", "_pool23")}).drop("_same1", "_same23", "_pool1", "_pool23")


def records(silver_rows: DataFrame, native: DataFrame | None = None) -> DataFrame:
    """Comparison records of cleaned rows: name fields, address fields and shares."""
    ship(silver_rows.sparkSession)
    if "dataset" not in silver_rows.columns:
        silver_rows = silver_rows.withColumn("dataset", F.lit(""))
    named = name_fields(silver_rows.select("gid", "dataset", "src", "country", "name_tokens", "name_legal_form")).drop("name_tokens", "name_legal_form")
    return shares(named.join(address_fields(silver_rows, address_components(silver_rows), native), "gid"))
