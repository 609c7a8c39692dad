"""Name cleaning, on cleaned text: legal forms apart, honorifics, ids and punctuation gone.

An unknown country keeps every word. All built-in functions: legal words of a country are a literal map, and the
removal that the definition repeats until nothing changes needs two rounds at most, as removing all legal
words can only uncover a leading honorific or article.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.expr import collapse, words
from matchloom.functions.tables import HONORIFICS, ID_TAG, INITIALS, LEGAL_FORMS, LEGAL_PHRASES, LONG_NUMBER, SHORTENED

LEADING = r"(?iU)^(?:(?:" + "|".join(HONORIFICS) + r")\b\.?\s*|the\b\s*)+"


#: (pattern, replacement), in the order in which they apply. Combining marks are no punctuation and stay.
REWRITES = [
    *((rf"(?iU)\b{r'\.?'.join(x)}\.?(?![a-z])", x) for x in INITIALS),
    *((rf"(?iU)\b{x}\.(?![a-z])", x) for x in SHORTENED),
    (ID_TAG, " "),
    (LONG_NUMBER, " "),
    (r"[\p{P}\p{S}]", " "),
]


def strip_leading(c: Column) -> Column:
    """Without honorifics and articles at the start."""
    return F.regexp_replace(c, LEADING, "")


def with_clean_names(df: DataFrame, raw: str, country: str = "country") -> DataFrame:
    """``df`` with name_clean and name_legal_form of the column ``raw``.

    Intermediate results are columns of their own, so that none is computed for each of its uses.
    """
    tidy = reduce(lambda c, rule: F.regexp_replace(c, *rule), REWRITES, F.col(raw))
    df = df.withColumn("_tokens", words(strip_leading(collapse(tidy))))
    df = df.withColumn("_text", F.concat(F.lit(" "), F.array_join("_tokens", " "), F.lit(" ")))
    rest, phrase = F.col("_text"), F.lit(None).cast("string")
    for name, (phrases, _) in LEGAL_PHRASES.items():  # also pairs that the removal of a pair makes
        gone = F.col("_text")
        for _ in range(3):
            for p in phrases:
                gone = F.regexp_replace(gone, f" {p}(?= )", "")
        rest = F.when(F.col(country) == name, gone).otherwise(rest)
    df = df.withColumn("_rest", rest)
    for name, (_, canon) in LEGAL_PHRASES.items():
        phrase = F.when((F.col(country) == name) & (F.col("_rest") != F.col("_text")), canon).otherwise(phrase)
    here = F.create_map(*(x for c, t in LEGAL_FORMS.items() for x in (F.lit(c), F.create_map(*(F.lit(v) for kv in t.items() for v in kv)))))
    legal_words = F.transform(F.filter(F.split("_rest", " "), lambda t: t != ""), lambda t: F.struct(t.alias("t"), F.try_element_at(F.col("_legal"), t).alias("legal")))
    df = df.withColumns({"_phrase": phrase, "_legal": F.coalesce(F.try_element_at(here, F.col(country)), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))})
    df = df.withColumn("_words", legal_words)
    forms = F.concat(F.array("_phrase"), F.transform("_words", lambda w: w["legal"]))
    left = F.array_join(F.transform(F.filter("_words", lambda w: w["legal"].isNull()), lambda w: w["t"]), " ")
    df = df.withColumns({"name_legal_form": F.array_join(F.array_distinct(F.filter(forms, lambda f: f.isNotNull())), " "), "name_clean": F.array_join(words(strip_leading(left)), " ")})
    return df.drop("_tokens", "_text", "_rest", "_phrase", "_legal", "_words")
