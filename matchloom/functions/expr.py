"""Small column expressions that the operators share. All run inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

INDIC = "[ऀ-ൿ]"


def strip(c: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """Runs of Unicode white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def words(c: Column) -> Column:
    """Parts between white space; none of them empty."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda x: x != "")


def strings(values: list[str]) -> Column:
    return F.array(*(F.lit(v) for v in values))


def is_in(x: Column, values: list[str]) -> Column:
    """Membership of an array element in a literal list (null stays null)."""
    return F.array_contains(strings(values), x)


def first(a: Column) -> Column:
    """First element, null if there is none."""
    return F.get(a, F.lit(0))


def last(a: Column) -> Column:
    return F.get(a, F.size(a) - 1)


def drop_first(a: Column, n: int = 1) -> Column:
    return F.slice(a, n + 1, F.greatest(F.size(a) - n, F.lit(0)))


def drop_last(a: Column, n: int = 1) -> Column:
    return F.slice(a, 1, F.greatest(F.size(a) - n, F.lit(0)))


def mapped(x: Column, table: dict[str, str]) -> Column:
    """The table's value for x, else x."""
    m = F.create_map(*(F.lit(v) for kv in table.items() for v in kv))
    return F.coalesce(F.try_element_at(m, x), x)


def by_country(table: dict[str, dict[str, str]], country: Column, x: Column) -> Column:
    """The value for (country, x) in a table of tables, null if there is none."""
    flat = {f"{c}\u0001{k}": v for c, t in table.items() for k, v in t.items()}
    m = F.create_map(*(F.lit(v) for kv in flat.items() for v in kv))
    return F.try_element_at(m, F.concat(country, F.lit("\u0001"), x))


def pairs(a: Column) -> Column:
    """The text x|y for every two elements at different places, the smaller first."""
    n = F.size(a)
    rows = F.transform(F.when(n >= 2, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>")), lambda i: F.transform(F.slice(a, i + 2, n - i - 1), lambda b: F.concat_ws("|", F.least(F.get(a, i), b), F.greatest(F.get(a, i), b))))
    return F.flatten(rows)


def products(a: Column, b: Column) -> Column:
    """The text x|y for every x of a and y of b."""
    return F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.concat_ws("|", x, y))))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct elements; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def trigrams(c: Column, pad: int) -> Column:
    """Distinct runs of three characters of c between ``pad`` spaces; none if that is shorter than three."""
    s = F.concat(F.lit(" " * pad), c, F.lit(" " * pad))
    at = F.when(F.length(s) >= 3, F.sequence(F.lit(1), F.length(s) - 2)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda i: F.substr(s, i, F.lit(3))))
