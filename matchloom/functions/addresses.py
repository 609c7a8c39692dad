"""Address components, house numbers and zip-like tokens, on cleaned addresses. All built-in functions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.expr import by_country, collapse, first, strip, words
from matchloom.functions.tables import HOUSE_WORDS, STREET_WORDS

HOUSE_WORD = r"(?iU)\b(?:" + "|".join(w.replace(".", r"\.") for w in HOUSE_WORDS if w != "#") + r")\b"


def components(addr: Column) -> Column:
    """Stripped stretches between commas; none for an empty address."""
    return F.when(addr == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(addr, ","), strip))


def street_words(component: Column, country: Column) -> Column:
    """Street words of a known country in full; other countries' components stay as they are."""
    known = country.isin(list(STREET_WORDS))
    out = F.transform(words(component), lambda t: F.coalesce(by_country(STREET_WORDS, country, F.rtrim(t, F.lit("."))), t))
    return F.when(known, F.array_join(out, " ")).otherwise(component)


def zip_token(comps: Column) -> Column:
    """First word of five or six digits."""
    tokens = F.flatten(F.transform(comps, lambda c: words(F.replace(c, F.lit(","), F.lit(" ")))))
    return F.coalesce(first(F.filter(tokens, lambda t: t.rlike(r"(?U)^\d{5,6}\z"))), F.lit(""))


def with_clean_addresses(df: DataFrame, addr: str = "addr_clean", country: str = "country") -> DataFrame:
    """``df`` with addr_components, addr_house_number, addr_house_number_raw and addr_zip of the column ``addr``."""
    df = df.withColumn("addr_components", F.transform(components(F.col(addr)), lambda c: street_words(c, F.col(country))))
    bare = F.transform("addr_components", lambda c: collapse(F.regexp_replace(F.regexp_replace(c, "#", " "), HOUSE_WORD, " ")))
    numbers = F.filter(F.transform(bare, lambda c: F.regexp_extract(c, r"(?U)^(\d[\d/\-]*)\b", 1)), lambda n: n != "")
    df = df.withColumns({"addr_house_number_raw": F.coalesce(first(numbers), F.lit("")), "addr_zip": zip_token(F.col("addr_components"))})
    raw = F.col("addr_house_number_raw")
    return df.withColumn("addr_house_number", F.when(raw == "", "").otherwise(F.coalesce(F.nullif(F.ltrim(raw, F.lit("0")), F.lit("")), F.lit("0"))))
