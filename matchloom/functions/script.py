"""Scripts of name tokens, the learned token dictionary, and romanisation."""

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.functions.expr import by_country, words
from matchloom.functions.tables import LATIN_CLASS, LEGAL_FORMS, SCRIPT_BLOCKS

MIN_SUPPORT, MIN_SHARE = 5, 0.1
BLOCKS = "".join(rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for _, lo, hi in SCRIPT_BLOCKS)


def token_script(t: Column) -> Column:
    """Script of the first letter: latin, one of the Indic blocks, or other."""
    letter = F.regexp_extract(t, r"(\p{L})", 1)
    out = F.when(letter.rlike(f"[{LATIN_CLASS}]"), "latin")
    for name, lo, hi in SCRIPT_BLOCKS:
        out = out.when(letter.rlike(rf"[\x{{{lo:X}}}-\x{{{hi:X}}}]"), name)
    return out.otherwise("other")


def scripts(name: Column) -> Column:
    """One script for each word."""
    return F.transform(words(name), token_script)


def all_indic(t: Column) -> Column:
    """At least one letter, and all letters in Indic blocks."""
    return t.rlike(r"\p{L}") & ~t.rlike(rf"[\p{{L}}&&[^{BLOCKS}]]")


def learn_dictionary(pairs: DataFrame) -> DataFrame:
    """(country, indic_token, latin array, is_legal_form, total_support) from linked names.

    ``pairs``: s1_gid, s1_name, s23_name, country. Names with equal numbers of words are aligned by
    place; a (native, Latin) word pair counts once for each S1. Pairs of at least MIN_SUPPORT stay; a
    native word whose Latin words are all legal forms of its country takes the canonical form of the most
    frequent one; else words with at least MIN_SHARE of the support stay, the most frequent first.
    """
    p = pairs.select("country", "s1_gid", words(F.col("s1_name")).alias("a"), words(F.col("s23_name")).alias("b")).filter(F.size("a") == F.size("b"))
    aligned = p.select("country", "s1_gid", F.explode(F.arrays_zip(F.col("b").alias("i"), F.col("a").alias("l"))).alias("z")).select("country", "s1_gid", "z.i", "z.l")
    counted = aligned.filter(all_indic(F.col("i")) & ~F.col("l").rlike(rf"[{BLOCKS}]")).groupBy("country", "i", "l").agg(F.countDistinct("s1_gid").alias("n")).filter(F.col("n") >= MIN_SUPPORT)
    of = Window.partitionBy("country", "i")
    shared = counted.withColumns({"total": F.sum("n").over(of), "legal": by_country(LEGAL_FORMS, F.col("country"), F.col("l"))})
    shared = shared.withColumn("all_legal", F.min(F.col("legal").isNotNull()).over(of))
    grouped = shared.groupBy("country", "i").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "l", "n", "legal"))).alias("found"),
        F.first("all_legal").alias("is_legal_form"),
        F.first("total").alias("total_support"),
    )
    common = F.filter("found", lambda x: x["n"] >= MIN_SHARE * F.col("total_support"))
    latin = F.when(F.col("is_legal_form"), F.array(F.get("found", F.lit(0))["legal"])).otherwise(F.transform(common, lambda x: x["l"]))
    return grouped.select("country", F.col("i").alias("indic_token"), latin.alias("latin"), "is_legal_form", F.col("total_support").cast("int").alias("total_support"))


def apply_dictionary(df: DataFrame, dictionary: DataFrame, name: str = "name", limit: int = 200_000) -> DataFrame:
    """``df`` with name_translit, name_indic_untranslated and name_token_variants (JSON of words with several forms, else null).

    The dictionary is joined to the distinct native words of all names, so neither side is collected;
    names without a native word skip the join.
    """
    native = df.filter(F.col(name).rlike(f"[{BLOCKS}]")).select("country", name).distinct()
    tokens = native.select("country", name, F.posexplode(words(F.col(name))).alias("pos", "t"))
    found = tokens.join(dictionary.select("country", F.col("indic_token").alias("t"), "latin"), ["country", "t"], "left")
    found = found.withColumn("v", F.coalesce(F.get("latin", F.lit(0)), F.col("t")))
    per = found.groupBy("country", name).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]), " ").alias("name_translit"),
        F.max(F.col("latin").isNull() & all_indic(F.col("t"))).alias("name_indic_untranslated"),
        F.sort_array(F.collect_list(F.when(F.size("latin") > 1, F.struct("pos", "t", "latin")))).alias("several"),
    )
    quoted = lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    json = F.concat(F.lit("["), F.array_join(F.transform("several", lambda s: F.concat(F.lit("["), quoted(s["t"]), F.lit(", ["), F.array_join(F.transform(s["latin"], quoted), ", "), F.lit("]]"))), ", "), F.lit("]"))
    per = per.select("country", name, "name_translit", "name_indic_untranslated", F.when(F.size("several") > 0, json).alias("name_token_variants"))
    out = df.join(per, ["country", name], "left")
    return out.withColumns({"name_translit": F.coalesce("name_translit", name), "name_indic_untranslated": F.coalesce("name_indic_untranslated", F.lit(False))})


def coverage(df: DataFrame, dictionary: DataFrame, name: str = "name") -> DataFrame:
    """(country, n_tokens, n_covered, share) of native words that the dictionary translates."""
    t = df.select("country", F.explode(words(F.col(name))).alias("t")).filter(all_indic(F.col("t"))).groupBy("country", "t").count()
    j = t.join(dictionary.select("country", F.col("indic_token").alias("t"), F.lit(1).alias("has")), ["country", "t"], "left")
    s = j.groupBy("country").agg(F.sum("count").alias("n_tokens"), F.sum(F.col("count") * F.coalesce("has", F.lit(0))).alias("n_covered"))
    return s.withColumn("share", F.try_divide(F.col("n_covered").cast("double"), F.col("n_tokens")))


#: Latin letters by place in an Indic block (the blocks share one layout), from place 0x05 on.
INDEPENDENT = "a aa i ii u uu r l e e e ai o o o au".split()
CONSONANTS = "k kh g gh n c ch j jh n t th d dh n t th d dh n n p ph b bh m y r r l l l v s s s h".split()
VOWEL_SIGNS = "aa i ii u uu r r e e e ai o o o au".split()


def _indic_letters() -> dict[int, str]:
    out = {}
    for _, lo, _ in SCRIPT_BLOCKS:
        out |= {lo + 0x05 + i: v for i, v in enumerate(INDEPENDENT)}
        out |= {lo + 0x15 + i: v for i, v in enumerate(CONSONANTS)}
        out |= {lo + 0x3E + i: v for i, v in enumerate(VOWEL_SIGNS)}
        out |= {lo + 0x66 + i: str(i) for i in range(10)}
        out |= {lo + 0x01: "n", lo + 0x02: "n", lo + 0x03: "h", lo + 0x4D: ""}
    return out


LETTERS = _indic_letters()
OTHER_LETTERS = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "þ": "th", "ł": "l", "ı": "i", "ħ": "h"}


def romanised(s: str) -> str:
    """Lower-case a-z, 0-9 and single spaces for any string; letters of unknown scripts are left out."""
    out = []
    for c in unicodedata.normalize("NFD", s.lower()):
        out.append(c if c.isascii() else LETTERS[ord(c)] if ord(c) in LETTERS else OTHER_LETTERS.get(c, "" if unicodedata.category(c)[0] in "ML" else " "))
    return " ".join(re.sub(r"[^a-z0-9]+", " ", "".join(out)).split())


def _romanise(s: pd.Series) -> pd.Series:
    known = {x: romanised(x) for x in s.dropna().unique()}
    return pd.Series([known.get(x) for x in s], dtype=object)


def romanise(c: Column) -> Column:
    """Romanised where not ASCII; only those strings leave the JVM."""
    other = c.rlike(r"[^\x00-\x7F]")
    return F.when(other, F.pandas_udf(_romanise, "string")(F.when(other, c))).otherwise(c)
