"""Blocking keys: one array of (kind, key) for each row, so all kinds cost one pass and no self-join."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.expr import is_in, pairs, products
from matchloom.functions.tables import DOMAIN_TAIL, GENERIC_ADDRESS, WEB_LEAD

MOST_PAIR_TOKENS, LEAST_NOSPACE, STRIP_ROUNDS = 8, 6, 3
MOST_NAME, MOST_ADDRESS, MOST_ADDRESS_PAIRS, LEAST_TOKEN = 5, 10, 8, 3
#: Rows of the second side that a key may have, by kind.
CAPS = {"tok": 5000, "pair": 5000, "nospace": 5000, "house": 5000, "zip": 5000, "na": 1000, "rns": 5000, "rsk": 5000, "aa": 200, "cns": 50}
NAME_KINDS, ADDRESS_KINDS = ("na", "rns", "rsk"), ("aa", "cns")
FIRST_NAME_KINDS, FIRST_ADDRESS_KINDS = ("tok",), ("house", "zip")


def full(a: Column) -> Column:
    return F.filter(a, lambda x: x != "")


def address_words(comps: Column) -> Column:
    """Words of all components."""
    return full(F.flatten(F.transform(comps, lambda c: F.split(c, " "))))


def nospace(tokens: Column) -> Column:
    """Name without web words (up to three on either side, a last word stays) and spaces; empty below six characters."""
    lead, tail = "|".join(WEB_LEAD), "|".join(DOMAIN_TAIL)
    s = F.regexp_replace(F.array_join(full(tokens), " "), f"^(?:(?:{lead})(?: |$)){{1,{STRIP_ROUNDS}}}", "")
    s = F.replace(F.regexp_replace(s, f"(?: (?:{tail})){{1,{STRIP_ROUNDS}}}$", ""), F.lit(" "), F.lit(""))
    return F.when(F.length(s) >= LEAST_NOSPACE, s).otherwise(F.lit(""))


def house_street(house: Column, address: Column) -> Column:
    """The house number with every other word of the address; repeated words stay repeated."""
    tokens = F.filter(address, lambda x: x != house)
    return F.when(F.coalesce(house, F.lit("")) != "", F.transform(tokens, lambda x: F.concat_ws("|", house, x))).otherwise(F.array().cast("array<string>"))


def _one(c: Column, cond: Column) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), F.array(c)).otherwise(F.array().cast("array<string>"))


def _generic(a: Column, extra: Column | None = None) -> Column:
    return F.array_distinct(F.filter(F.split(a, " "), lambda x: ((F.length(x) >= LEAST_TOKEN) | (x.rlike(r"^\d{2,}$") if extra is not None else F.lit(False))) & ~is_in(x, GENERIC_ADDRESS)))


def _words(kinds: tuple[str, ...]) -> dict[str, Column]:
    """Word lists that keys of several elements are made of; columns of their own, so that each is computed once a row."""
    c, out = F.col, {}
    if {"tok", "pair"} & set(kinds):
        out["_tokens"] = F.array_distinct(full(c("name_tokens")))
    if "house" in kinds:
        out["_address"] = address_words(c("addr_components"))
    if "na" in kinds:
        out["_name"] = F.slice(F.array_distinct(F.filter(F.split("core", " "), lambda x: F.length(x) >= LEAST_TOKEN)), 1, MOST_NAME)
        out["_words"] = F.slice(_generic(c("addr")), 1, MOST_ADDRESS)
    if "aa" in kinds:
        out["_numbered"] = F.slice(_generic(c("addr"), F.lit(True)), 1, MOST_ADDRESS_PAIRS)
    return out


def _values(kind: str) -> Column:
    """Keys of one kind as an array of strings, from the columns of cleaned rows or of records and from ``_words``."""
    c = F.col
    if kind == "tok":
        return c("_tokens")
    if kind == "pair":
        return pairs(F.slice("_tokens", 1, MOST_PAIR_TOKENS))
    if kind == "nospace":
        return full(F.array(nospace(c("name_tokens"))))
    if kind == "house":
        return house_street(c("addr_house_number"), c("_address"))
    if kind == "zip":
        return _one(c("addr_zip"), c("addr_zip") != "")
    if kind == "na":
        return products(c("_name"), c("_words"))
    if kind in ("rns", "rsk"):
        name, least = ("ns", 4) if kind == "rns" else ("skel", 3)
        return _one(F.concat_ws("|", "region", name), (c("region") != "") & (F.length(name) >= least))
    if kind == "aa":
        return pairs(c("_numbered"))
    if kind == "cns":
        return _one(c("ns"), F.length("ns") >= 4)
    raise ValueError(f"unknown kind of key: {kind}")


def keys(df: DataFrame, kinds: tuple[str, ...], id_col: str = "gid", hashed: bool = True, distinct: bool = True) -> DataFrame:
    """(id, country, kind, key) of the wanted kinds, each once for a row.

    ``hashed`` keys are 64-bit hashes of kind and key. Keys of a row are told apart before rows are
    exploded, so no shuffle is needed. ``distinct=False`` keeps the repeats of house keys.
    """

    def tagged(kind: str) -> Column:
        values = _values(kind)
        return F.transform(F.array_distinct(values) if distinct else values, lambda x: F.struct(F.lit(kind).alias("kind"), (F.xxhash64(F.concat(F.lit(kind + ":"), x)) if hashed else x).alias("key")))

    all_keys = reduce(lambda a, b: F.concat(a, b), map(tagged, kinds))
    return df.withColumns(_words(kinds)).select(id_col, "country", F.explode(all_keys).alias("k")).select(id_col, "country", "k.kind", "k.key")
