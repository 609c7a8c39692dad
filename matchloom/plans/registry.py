"""The queries of the record-linkage operators over the fixture tables, and their SQL."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.functions import addresses, names, script, text
from matchloom.functions.durable import stored
from matchloom.functions.expr import jaccard, trigrams
from matchloom.functions.ship import ship
from matchloom.functions.similarity import scores
from matchloom.operators import analysis, blocking, decide, features, keys, labels, metric, model, profile, ranked
from matchloom.operators import records as recs
from matchloom.plans import fixture as fx
from matchloom.sources import tsv

QUERIES: dict = {}
SQL: dict[str, str] = {}
FLAGSHIP = "macro_f05"
K_NAME, K_ADDRESS, K_FIRST, K_V3, K_VA, THRESHOLD, CAP = blocking.BEST_NAME, blocking.BEST_ADDRESS, blocking.BEST_FIRST, blocking.BEST_V3, blocking.BEST_VA, 0.5, 5000


def query(sql: str | None = None):
    """Registers a query and its SQL; whole numbers come out as longs."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            fx.fresh()
            df = f(spark, sf_dir)
            return df.select(*(F.col(c).cast("long").alias(c) if kind in ("int", "smallint", "tinyint") else F.col(c) for c, kind in df.dtypes))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def with_fixture(final: str, *ctes: str) -> str:
    return ",\n".join([fx.SQL, *ctes]) + "\n" + final


# ---------------------------------------------------------------- cleaning

#: Cleaning as SQL: exact for texts of Latin letters whose accents decompose, as those of the tables are.
_CLEAN = "regexp_replace(trim(regexp_replace(replace(replace(replace(strip_accents(lower(regexp_replace({0}, '[\\x00-\\x1F\\x7F]', ' ', 'g'))), 'ß', 'ss'), 'œ', 'oe'), 'æ', 'ae'), ' +', ' ', 'g')), ' +,', ',', 'g')"


@query(f"""SELECT doc_id, {_CLEAN.format("text")} AS cleaned FROM documents""")
def clean_unicode(spark, sf_dir):
    """Text cleaning of all texts, Arrow function and all."""
    ship(spark)
    return fx.table(spark, sf_dir, "documents").select("doc_id", text.clean(F.col("text")).alias("cleaned"))


@query(
    with_fixture(
        """SELECT gid, CASE WHEN len(kept) = 0 THEN '' ELSE array_to_string(list_filter(cl, lambda p: p <> ''), ', ') END AS addr_clean,
        len(kept) = 0 OR len(list_filter(cl, lambda p: p <> '')) = 0 AS addr_missing, len(parts) - len(kept) AS addr_null_parts_removed,
        CASE WHEN len(kept) = 0 THEN 0 ELSE len(cl) - len(list_filter(cl, lambda p: p <> '')) END AS addr_parts_emptied FROM m3""",
        """m1 AS (SELECT gid, list_transform(string_split(business_address || CASE gid % 4 WHEN 0 THEN ', NULL' WHEN 1 THEN ', n/a ,, x' WHEN 2 THEN ', ' || chr(26) ELSE '' END, ','), lambda p: trim(p)) AS parts FROM raw),
m2 AS (SELECT *, list_filter(parts, lambda p: p <> '' AND lower(p) NOT IN ('null', '<null>', 'none', 'n/a', 'na')) AS kept FROM m1),
m3 AS (SELECT *, list_transform(string_split("""
        + _CLEAN.format("array_to_string(kept, ', ')")
        + """, ','), lambda p: trim(p)) AS cl FROM m2)""",
    )
)
def missing_parts(spark, sf_dir):
    """Addresses with missing and emptied parts."""
    ship(spark)
    g = F.col("gid") % 4
    extra = F.when(g == 0, ", NULL").when(g == 1, ", n/a ,, x").when(g == 2, ", \x1a").otherwise("")
    r = fx.raw(spark, sf_dir).select("gid", F.concat("business_address", extra).alias("business_address"))
    return text.clean_addresses(r).drop("business_address")


_SUFFIXES = [" Inc.", " L.L.C.", " pvt ltd", " private limited", " SARL"]
_LEGAL_CASES = {("US", 0): ("", "inc"), ("US", 1): ("", "llc"), ("US", 2): (" pvt", "ltd"), ("US", 3): (" private limited", ""), ("US", 4): (" sarl", ""),
                ("India", 0): (" inc", ""), ("India", 1): (" llc", ""), ("India", 2): ("", "pvt ltd"), ("India", 3): ("", "pvt ltd"), ("India", 4): (" sarl", ""),
                ("France", 0): (" inc", ""), ("France", 1): (" llc", ""), ("France", 2): (" pvt ltd", ""), ("France", 3): (" private limited", ""), ("France", 4): ("", "sarl")}
_COUNTRIES = ["US", "India", "France"]


@query(
    "SELECT p_partkey, lower(regexp_replace(p_name, '[^A-Za-z0-9 ]', ' ', 'g')) || v.name AS name_clean, v.legal AS name_legal_form FROM part JOIN (VALUES "
    + ", ".join(f"({_COUNTRIES.index(c)}, {k}, '{n}', '{form}')" for (c, k), (n, form) in _LEGAL_CASES.items())
    + ") v(c, k, name, legal) ON v.c = p_partkey % 3 AND v.k = p_partkey % 5"
)
def legal_form_extract(spark, sf_dir):
    """Legal forms of part names with suffixes, by country."""
    key = F.col("p_partkey")
    pick = lambda values, n: reduce(lambda a, i: F.when(key % n == i, values[i]).otherwise(a), range(n), F.lit(""))
    d = fx.table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("The Dr. "), F.lower("p_name"), pick(_SUFFIXES, 5)).alias("raw"), pick(_COUNTRIES, 3).alias("country"))
    return names.with_clean_names(d.withColumn("raw", F.lower("raw")), "raw").select("p_partkey", "name_clean", "name_legal_form")


_ADDRESS_SQL = """a AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'India' ELSE 'France' END AS country,
  ['suite x', '#00' || c_custkey || ' main st.', 'h.no 0' || (c_custkey % 89) || '-2/1', (10000 + c_custkey % 89999) || ' end rd'] AS comps FROM customer),
b AS (SELECT *, list_transform(comps, lambda c: array_to_string(list_transform(string_split(c, ' '), lambda t: CASE
  WHEN country = 'US' AND rtrim(t, '.') = 'st' THEN 'street' WHEN country = 'US' AND t = 'rd' THEN 'road' WHEN country = 'India' AND t = 'rd' THEN 'road'
  WHEN country = 'France' AND rtrim(t, '.') = 'st' THEN 'saint' ELSE t END), ' ')) AS canon FROM a)"""


@query(f"WITH {_ADDRESS_SQL} SELECT c_custkey, array_to_string(canon, '; ') AS components, ltrim('00' || c_custkey, '0') AS addr_house_number, '00' || c_custkey AS addr_house_number_raw, coalesce(list_filter(string_split(array_to_string(canon, ' '), ' '), lambda t: regexp_full_match(t, '[0-9]{{5,6}}'))[1], '') AS addr_zip FROM b WHERE c_custkey > 0")
def address_fields(spark, sf_dir):
    """House numbers, zip-like words and street words."""
    k = F.col("c_custkey")
    country = F.when(k % 3 == 0, "US").when(k % 3 == 1, "India").otherwise("France")
    s = lambda c: c.cast("string")
    comps = F.concat_ws(", ", F.lit("suite x"), F.concat(F.lit("#00"), s(k), F.lit(" main st.")), F.concat(F.lit("h.no 0"), s(k % 89), F.lit("-2/1")), F.concat(s(10000 + k % 89999), F.lit(" end rd")))
    d = fx.table(spark, sf_dir, "customer").filter("c_custkey > 0").select("c_custkey", comps.alias("addr_clean"), country.alias("country"))
    return addresses.with_clean_addresses(d).select("c_custkey", F.array_join("addr_components", "; ").alias("components"), "addr_house_number", "addr_house_number_raw", "addr_zip")


@query()
def silver(spark, sf_dir):
    """All cleaning steps on raw rows."""
    out = recs.silver(fx.raw(spark, sf_dir))
    return out.select("gid", "country", "name_clean", "name_legal_form", "addr_clean", "addr_missing", F.size("addr_components").alias("n_components"), "addr_house_number", "addr_zip")


@query()
def comparison_records(spark, sf_dir):
    """Records of cleaned rows."""
    return recs.records(recs.silver(fx.raw(spark, sf_dir)))


@query()
def token_dictionary(spark, sf_dir):
    """Dictionary learned from linked names, with Latin letters shifted into an Indic block on one side."""
    d = fx.raw(spark, sf_dir).select("gid", F.lit("India").alias("country"), F.regexp_replace(F.lower("business_name"), "[^a-z ]", "").alias("s1_name"))
    shifted = F.translate("s1_name", "abcdefghijklmnopqrstuvwxyz", "".join(chr(0x0915 + i) for i in range(26)))
    return script.learn_dictionary(d.select(F.col("gid").alias("s1_gid"), "country", "s1_name", shifted.alias("s23_name"))).withColumn("latin", F.array_join("latin", ","))


_IDF = with_fixture(
    "SELECT t.country, token, df, round(ln((n + 1) / (df + 1)) + 1, 6) AS idf FROM t JOIN (SELECT country, count(*) n FROM cleaned GROUP BY 1) c USING (country)",
    "t AS (SELECT country, token, count(*) AS df FROM (SELECT country, unnest(list_distinct(list_filter(string_split(array_to_string(name_tokens, ' ') || ' ' || array_to_string(addr_components, ' '), ' '), lambda x: x <> ''))) AS token FROM cleaned) GROUP BY ALL)",
)


@query(_IDF)
def token_df_idf(spark, sf_dir):
    """Document frequency of name and address words by country."""
    c = fx.cleaned(spark, sf_dir).select("country", F.array_join("name_tokens", " ").alias("name_clean"), F.array_join("addr_components", " ").alias("addr_clean"))
    return profile.token_frequency(c).withColumn("idf", F.round("idf", 6))


# ---------------------------------------------------------------- keys

_DISTINCT = lambda a: f"list_filter({a}, lambda x, i: x <> '' AND list_position({a}, x) = i)"  # noqa: E731  in order
_PAIRS = lambda a, most: f"list_distinct(flatten(list_transform({a}[1:{most}], lambda x, i: list_transform({a}[i+1:{most}], lambda y: least(x, y) || '|' || greatest(x, y)))))"
_GENERIC = "(" + ", ".join(f"'{w}'" for w in keys.GENERIC_ADDRESS) + ")"
_ADDR_WORDS = "list_filter(string_split(array_to_string(addr_components, ' '), ' '), lambda x: x <> '')"
_PREP = f"""k0 AS (SELECT *, {_DISTINCT("name_tokens")} AS dt, {_ADDR_WORDS} AS aw,
    list_filter(list_filter(name_tokens, lambda x: x <> ''), lambda x: true) AS full_t FROM cleaned),
r0 AS (SELECT *, string_split(core, ' ') AS cw, string_split(addr, ' ') AS adw FROM rec),
r1 AS (SELECT *, list_filter(cw, lambda x, i: length(x) >= 3 AND list_position(cw, x) = i)[1:5] AS nt,
    list_filter(adw, lambda x, i: length(x) >= 3 AND x NOT IN {_GENERIC} AND list_position(adw, x) = i)[1:10] AS ad,
    list_filter(adw, lambda x, i: (length(x) >= 3 OR regexp_full_match(x, '[0-9]{{2,}}')) AND x NOT IN {_GENERIC} AND list_position(adw, x) = i)[1:8] AS at2 FROM r0)"""
_KEY_SQL = {
    "tok": ("k0", "dt"),
    "pair": ("k0", _PAIRS("dt[1:8]", 8)),
    "house": ("k0", "list_distinct(list_transform(list_filter(aw, lambda x: x <> addr_house_number), lambda x: addr_house_number || '|' || x))"),
    "zip": ("k0", "[addr_zip]"),
    "na": ("r1", "flatten(list_transform(nt, lambda x: list_transform(ad, lambda y: x || '|' || y)))"),
    "rns": ("r1", "CASE WHEN region <> '' AND length(ns) >= 4 THEN [region || '|' || ns] ELSE [] END"),
    "rsk": ("r1", "CASE WHEN region <> '' AND length(skel) >= 3 THEN [region || '|' || skel] ELSE [] END"),
    "aa": ("r1", _PAIRS("at2", 8)),
    "cns": ("r1", "CASE WHEN length(ns) >= 4 THEN [ns] ELSE [] END"),
}


def _key_cte(kind: str) -> str:
    source, expr = _KEY_SQL[kind]
    return f"SELECT gid, src, country, '{kind}' AS kind, unnest({expr}) AS key FROM {source}"


def _register_keys(kind: str) -> None:
    @query(with_fixture("SELECT gid, country, kind, key FROM k", _PREP, f"k AS ({_key_cte(kind)})"))
    def run(spark, sf_dir):
        rows = (fx.cleaned if _KEY_SQL[kind][0] == "k0" else fx.records)(spark, sf_dir)
        return keys.keys(rows, (kind,), hashed=False)

    QUERIES[f"keys_{kind}"] = QUERIES.pop("run")
    SQL[f"keys_{kind}"] = SQL.pop("run")


for _kind in _KEY_SQL:
    _register_keys(_kind)



@query(
    with_fixture(
        "SELECT gid, country, 'nospace' AS kind, s AS key FROM (SELECT gid, country, replace(regexp_replace(lead, '(.)( (com|in|net|org|co|biz|info)){1,3}$', '\\1'), ' ', '') AS s FROM n) WHERE length(s) >= 6",
        _PREP,
        "n AS (SELECT gid, country, regexp_replace(array_to_string(full_t, ' '), '^((www|http|https)( |$)){1,3}', '') AS lead FROM k0)",
    )
)
def keys_nospace(spark, sf_dir):
    """Names without spaces and web words."""
    return keys.keys(fx.cleaned(spark, sf_dir), ("nospace",), hashed=False)


_RARE = f"""ky AS ({" UNION ALL ".join(_key_cte(k) for k in ("tok", "house", "zip"))}),
kr AS ({" UNION ALL ".join(_key_cte(k) for k in ("na", "rns", "rsk", "aa", "cns"))}),
caps(kind, cap) AS (VALUES {", ".join(f"('{k}', {v})" for k, v in keys.CAPS.items())}),
pool AS (SELECT country, count(*) AS n FROM cleaned WHERE src <> 1 GROUP BY 1),
rare AS (SELECT country, kind, key, df, ln((n + 1) / (df + 1)) + 1 AS idf FROM (SELECT country, kind, key, count(*) AS df FROM (SELECT * FROM ky UNION ALL SELECT * FROM kr) WHERE src <> 1 GROUP BY ALL) JOIN caps USING (kind) JOIN pool USING (country) WHERE df <= cap),
sc AS (SELECT kind, a.gid AS s1_gid, b.gid AS s23_gid, idf FROM (SELECT * FROM ky UNION ALL SELECT * FROM kr) a JOIN rare USING (country, kind, key) JOIN (SELECT * FROM ky UNION ALL SELECT * FROM kr) b USING (country, kind, key) WHERE a.src = 1 AND b.src <> 1)"""


def _scored_cte(name: str, kinds: tuple[str, ...], k: int) -> str:
    listed = ", ".join(f"'{x}'" for x in kinds)
    return f"{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1_gid ORDER BY score DESC, s23_gid) AS rank FROM (SELECT s1_gid, s23_gid, round(sum(idf), 6) AS score FROM sc WHERE kind IN ({listed}) GROUP BY ALL)) WHERE rank <= {k})"


_LISTS = ",\n".join(
    [
        _PREP, _RARE, _scored_cte("by_name", ("tok",), K_NAME), _scored_cte("by_addr", ("house", "zip"), K_ADDRESS),
        "first0 AS (SELECT s1_gid, s23_gid, coalesce(n.score, 0) AS name_score, coalesce(a.score, 0) AS addr_score, round(coalesce(n.score, 0) + coalesce(a.score, 0), 6) AS blocking_score FROM by_name n FULL JOIN by_addr a USING (s1_gid, s23_gid))",
        "first1 AS (SELECT *, row_number() OVER (PARTITION BY s1_gid ORDER BY blocking_score DESC, s23_gid) AS blocking_rank FROM first0)",
        _scored_cte("v3", keys.NAME_KINDS, K_V3), _scored_cte("va", keys.ADDRESS_KINDS, K_VA),
        f"""united AS (SELECT s1_gid, s23_gid, coalesce(f.blocking_score, 0) AS v1_score, coalesce(f.blocking_rank, 999) AS v1_rank, coalesce(v3.score, 0) AS v3_score, coalesce(v3.rank, 999) AS v3_rank, coalesce(va.score, 0) AS va_score, coalesce(va.rank, 999) AS va_rank
  FROM (SELECT * FROM first1 WHERE blocking_rank <= {K_FIRST}) f FULL JOIN v3 USING (s1_gid, s23_gid) FULL JOIN va USING (s1_gid, s23_gid))""",
    ]
)


def _both(spark, sf_dir, rows=fx.cleaned) -> tuple[DataFrame, DataFrame]:
    r = rows(spark, sf_dir)
    return fx.first_side(r), fx.second_side(r)


def _pool_keys(spark, sf_dir, kinds=("tok", "house", "zip"), rows=fx.cleaned) -> tuple[DataFrame, DataFrame, DataFrame]:
    a, b = _both(spark, sf_dir, rows)
    kb = keys.keys(b, kinds, hashed=False)
    return keys.keys(a, kinds, hashed=False).withColumnRenamed("gid", "s1_gid"), kb.withColumnRenamed("gid", "s23_gid"), blocking.rare_keys(kb, blocking.pool_sizes(b))


@query(with_fixture("SELECT country, kind, key, df, round(idf, 6) AS idf FROM rare WHERE kind IN ('tok', 'house', 'zip')", _PREP, _RARE))
def rare_key_index(spark, sf_dir):
    """Rare keys and their IDF."""
    return _pool_keys(spark, sf_dir)[2].withColumn("idf", F.round("idf", 6))


@query(with_fixture("SELECT country, kind, count(*) AS n_pairs FROM (SELECT a.country, a.kind FROM ky a JOIN rare USING (country, kind, key) JOIN ky b USING (country, kind, key) WHERE a.src = 1 AND b.src <> 1) GROUP BY ALL", _PREP, _RARE))
def pair_estimate(spark, sf_dir):
    """Rows that the pair join would make."""
    return blocking.estimate_pairs(*_pool_keys(spark, sf_dir))


def _first(spark, sf_dir) -> DataFrame:
    return blocking.first_list(*_both(spark, sf_dir), K_NAME, K_ADDRESS)


def _united(spark, sf_dir) -> DataFrame:
    return ranked.united(_both(spark, sf_dir), _both(spark, sf_dir, fx.records), K_NAME, K_ADDRESS, K_FIRST, K_V3, K_VA)


def _stored_union(spark, sf_dir) -> DataFrame:
    """The united lists as a table, so that the shuffle files of the lists go before those of the features come."""
    return stored(_united(spark, sf_dir)).df


@query(with_fixture("SELECT s1_gid, s23_gid, name_score::DOUBLE AS name_score, addr_score::DOUBLE AS addr_score, blocking_score::DOUBLE AS blocking_score, blocking_rank FROM first1", _LISTS))
def candidates_topk(spark, sf_dir):
    """The first ranked list."""
    return _first(spark, sf_dir)


@query(with_fixture("SELECT s1_gid, s23_gid, v1_score::DOUBLE AS v1_score, v1_rank, v3_score::DOUBLE AS v3_score, v3_rank, va_score::DOUBLE AS va_score, va_rank FROM united", _LISTS))
def candidates_union(spark, sf_dir):
    """All three lists joined, with sentinels."""
    return _united(spark, sf_dir)


@query(
    with_fixture(
        "SELECT s1_gid, s23_gid, round(sum(idf), 6) AS score FROM (SELECT a.gid AS s1_gid, b.gid AS s23_gid, idf FROM f a JOIN fr USING (country, key) JOIN f b USING (country, key) WHERE a.src = 1 AND b.src <> 1) GROUP BY ALL",
        _PREP,
        f"""f AS (SELECT gid, src, country, unnest(dt) AS key FROM k0 UNION ALL SELECT gid, src, country, unnest(list_transform(list_filter(aw, lambda x: x <> addr_house_number), lambda x: addr_house_number || '|' || x)) FROM k0 UNION ALL SELECT gid, src, country, addr_zip FROM k0),
pool AS (SELECT country, count(*) AS n FROM cleaned WHERE src <> 1 GROUP BY 1),
fr AS (SELECT country, key, ln((n + 1) / (df + 1)) + 1 AS idf FROM (SELECT country, key, count(DISTINCT gid) AS df FROM f WHERE src <> 1 GROUP BY ALL) JOIN pool USING (country) WHERE df <= {CAP})""",
    )
)
def unweighted_candidates(spark, sf_dir):
    """The earliest scoring: no kinds, repeats count."""
    a, b = _both(spark, sf_dir)
    a, b = (d.withColumn("name_tokens", F.array_distinct("name_tokens")) for d in (a, b))
    return blocking.unweighted_list(a, b, CAP)


# ---------------------------------------------------------------- evaluation of candidates

_TRUE = "(SELECT count(*) FROM truth)"


@query(with_fixture(f"SELECT k, count(*) AS n_candidates, count(t.s1_gid) AS n_hit, count(t.s1_gid) / nullif({_TRUE}, 0) AS recall FROM first1 f JOIN (VALUES (1), (5), (10), (20)) g(k) ON blocking_rank <= k LEFT JOIN truth t USING (s1_gid, s23_gid) GROUP BY k", _LISTS))
def recall_at_k(spark, sf_dir):
    """Recall of the first list at several lengths."""
    return blocking.recall_curve(_first(spark, sf_dir), fx.truth(spark, sf_dir), "blocking_rank", [1, 5, 10, 20])


_F05 = "CASE WHEN n_true = 0 AND n_pred = 0 THEN 1.0::DOUBLE WHEN tp = 0 THEN 0.0::DOUBLE ELSE 1.25 * (tp / n_pred) * (tp / n_true) / (0.25 * (tp / n_pred) + tp / n_true) END"


def _per_row_cte(predicted: str) -> str:
    return f"""marked AS (SELECT s1_gid, p.s23_gid AS pg, t.s23_gid AS tg FROM (SELECT s1_gid, s23_gid FROM {predicted}) p FULL JOIN truth t USING (s1_gid, s23_gid)),
marked2 AS (SELECT s1_gid, count(pg) AS n_pred, count(tg) AS n_true, count(*) FILTER (pg IS NOT NULL AND tg IS NOT NULL) AS tp FROM marked GROUP BY 1),
scored_rows AS (SELECT *, {_F05} AS f05 FROM (SELECT r.gid AS s1_gid, r.country, coalesce(n_pred, 0) AS n_pred, coalesce(n_true, 0) AS n_true, coalesce(tp, 0) AS tp FROM raw r LEFT JOIN marked2 m ON m.s1_gid = r.gid WHERE src = 1))"""


@query(with_fixture("SELECT round(avg(f05), 9) AS f05, count(*) AS n FROM scored_rows", _LISTS, "oc AS (SELECT DISTINCT s1_gid, s23_gid FROM truth JOIN united USING (s1_gid, s23_gid))", _per_row_cte("oc")))
def oracle_ceiling(spark, sf_dir):
    """The best score that the candidates allow.

    A row's lists depend on its own keys and the second side alone, and only true links are looked up in them, so lists are made for
    the rows that have a true link. All rows are scored.
    """
    rows, truth = fx.first_side(fx.raw(spark, sf_dir)).select(F.col("gid").alias("s1_gid")), fx.truth(spark, sf_dir)
    linked = truth.select(F.col("s1_gid").alias("gid")).distinct()
    sides = ((a.join(linked, "gid", "left_semi"), b) for a, b in (_both(spark, sf_dir), _both(spark, sf_dir, fx.records)))
    found = ranked.united(*sides, K_NAME, K_ADDRESS, K_FIRST, K_V3, K_VA)
    return metric.macro(metric.ceiling(found, truth, rows)).withColumn("f05", F.round("f05", 9))


@query(
    with_fixture(
        """SELECT CASE WHEN f.s1_gid IS NOT NULL THEN 'hit' WHEN s.rare = 1 THEN 'ranked_out' WHEN s.rare = 0 THEN 'cap_dropped' ELSE 'no_key' END AS class, count(*) AS n_links
FROM truth t LEFT JOIN first1 f USING (s1_gid, s23_gid) LEFT JOIN shared s USING (s1_gid, s23_gid) GROUP BY ALL""",
        _LISTS,
        "shared AS (SELECT t.s1_gid, t.s23_gid, max(CASE WHEN r.key IS NOT NULL THEN 1 ELSE 0 END) AS rare FROM truth t JOIN ky a ON a.gid = t.s1_gid JOIN ky b ON b.gid = t.s23_gid AND b.country = a.country AND b.kind = a.kind AND b.key = a.key LEFT JOIN rare r ON r.country = a.country AND r.kind = a.kind AND r.key = a.key GROUP BY ALL)",
    )
)
def miss_classes(spark, sf_dir):
    """Why true links are not among the candidates."""
    a, b = _both(spark, sf_dir)
    return blocking.miss_classes(a, b, _first(spark, sf_dir), fx.truth(spark, sf_dir))


_TRIGRAM = lambda e, pad: f"list_distinct(list_transform(range(1, length({e}) + {2 * pad} - 1), lambda i: substr('{' ' * pad}' || {e} || '{' ' * pad}', i, 3)))"


@query(
    with_fixture(
        "SELECT s1_gid, s23_gid, round(len(list_intersect(x, y)) / nullif(len(list_distinct(list_concat(x, y))), 0), 6) AS sim FROM p",
        _LISTS,
        f"p AS (SELECT f.s1_gid, f.s23_gid, {_TRIGRAM('a.core', 1)} AS x, {_TRIGRAM('b.core', 1)} AS y FROM first1 f JOIN rec a ON a.gid = f.s1_gid JOIN rec b ON b.gid = f.s23_gid)",
    )
)
def trigram_jaccard(spark, sf_dir):
    """Trigram similarity of candidate names."""
    a, b = _both(spark, sf_dir, fx.records)
    d = features.sides(_first(spark, sf_dir).select("s1_gid", "s23_gid"), a, b, ["core"])
    d = d.withColumns({"x": trigrams(F.col("core_1"), 1), "y": trigrams(F.col("core_2"), 1)})
    return d.select("s1_gid", "s23_gid", F.round(jaccard(F.col("x"), F.col("y")), 6).alias("sim"))


# ---------------------------------------------------------------- features

_JACC = lambda x, y: f"CASE WHEN len(list_distinct(list_concat({x}, {y}))) = 0 THEN 0::DOUBLE ELSE len(list_intersect({x}, {y})) / len(list_distinct(list_concat({x}, {y}))) END"
_W = lambda a: f"list_filter(string_split(array_to_string({a}.addr_components, ' '), ' '), lambda x: x <> '')"
_SAME = lambda c: f"(a.{c} <> '' AND a.{c} = b.{c})::INT::BIGINT"
_SIMPLE = f"""simple AS (SELECT f.*, {_JACC("a.name_tokens", "b.name_tokens")} AS name_jaccard, len(list_intersect(a.name_tokens, b.name_tokens)) AS name_overlap_n, {_JACC(_W("a"), _W("b"))} AS addr_token_jaccard,
  {_SAME("addr_house_number")} AS house_number_match, {_SAME("addr_zip")} AS zip_match, {_SAME("name_legal_form")} AS legal_form_match, (a.name_legal_form <> '' AND b.name_legal_form <> '')::INT::BIGINT AS legal_form_both_present
  FROM (SELECT s1_gid, s23_gid, blocking_score, blocking_rank FROM first1 WHERE blocking_rank <= {K_FIRST}) f JOIN cleaned a ON a.gid = f.s1_gid JOIN cleaned b ON b.gid = f.s23_gid),
prob AS (SELECT *, round((name_jaccard + addr_token_jaccard) / 2, 6) AS prob FROM simple)"""


def _simple(spark, sf_dir) -> DataFrame:
    pairs = _first(spark, sf_dir).filter(F.col("blocking_rank") <= K_FIRST).select("s1_gid", "s23_gid", "blocking_score", "blocking_rank")
    return features.simple_features(pairs, *_both(spark, sf_dir))


def _prob(spark, sf_dir) -> DataFrame:
    """Candidates with a stand-in probability."""
    return _simple(spark, sf_dir).withColumn("prob", F.round((F.col("name_jaccard") + F.col("addr_token_jaccard")) / 2, 6))


@query(with_fixture("SELECT s1_gid, s23_gid, round(name_jaccard, 6) AS name_jaccard, name_overlap_n, round(addr_token_jaccard, 6) AS addr_token_jaccard, house_number_match, zip_match, legal_form_match, legal_form_both_present FROM simple", _LISTS, _SIMPLE))
def pair_jaccard(spark, sf_dir):
    """Set and equality features of the first list."""
    return _simple(spark, sf_dir).drop("blocking_score", "blocking_rank").withColumns({c: F.round(c, 6) for c in ("name_jaccard", "addr_token_jaccard")})


_FLAG = lambda e: f"({e})::INT::BIGINT"
_EQ = lambda c: _FLAG(f"a.{c} <> '' AND b.{c} <> '' AND a.{c} = b.{c}")
_CON = lambda c: _FLAG(f"a.{c} <> '' AND b.{c} <> '' AND a.{c} <> b.{c}")
_MIS = lambda c: _FLAG(f"a.{c} = '' OR b.{c} = ''")
_PAIR_FROM = "FROM (SELECT s1_gid, s23_gid FROM united) f JOIN rec a ON a.gid = f.s1_gid JOIN rec b ON b.gid = f.s23_gid"
_FLAG_COLUMNS = [
    "n_acr", "n_ini_prefix", "n_ini_eq", "n_contain", "n_first_eq", "n_last_eq", "n_len_ratio", "legal_eq", "legal_conflict", "reg_eq", "reg_conflict", "reg_missing",
    "hn_eq", "hn_conflict", "hn_missing", "hn_dig_eq", "zip_eq", "zip_conflict", "zip_missing", "zip_p3", "zip_lev1", "a_len_1", "a_len_2",
]


@query(
    with_fixture(
        f"""SELECT s1_gid, s23_gid, {_FLAG("(a.ini = b.ns AND a.ntok >= 2) OR (b.ini = a.ns AND b.ntok >= 2)")} AS n_acr, {_FLAG("(a.ntok >= 2 AND starts_with(b.ns, a.ini)) OR (b.ntok >= 2 AND starts_with(a.ns, b.ini))")} AS n_ini_prefix,
{_FLAG("a.ini = b.ini AND a.ntok >= 2")} AS n_ini_eq, {_FLAG("length(a.ns) >= 4 AND length(b.ns) >= 4 AND (contains(a.ns, b.ns) OR contains(b.ns, a.ns))")} AS n_contain, {_EQ("first")} AS n_first_eq, {_EQ("last")} AS n_last_eq,
round(least(length(a.ns), length(b.ns)) / greatest(length(a.ns), length(b.ns), 1), 6) AS n_len_ratio, {_EQ("legal")} AS legal_eq, {_CON("legal")} AS legal_conflict,
{_EQ("region")} AS reg_eq, {_CON("region")} AS reg_conflict, {_MIS("region")} AS reg_missing, {_EQ("hn")} AS hn_eq, {_CON("hn")} AS hn_conflict, {_MIS("hn")} AS hn_missing, {_EQ("hn_digits")} AS hn_dig_eq,
{_EQ("zip")} AS zip_eq, {_CON("zip")} AS zip_conflict, {_MIS("zip")} AS zip_missing, {_FLAG("a.zip <> '' AND b.zip <> '' AND substr(a.zip, 1, 3) = substr(b.zip, 1, 3)")} AS zip_p3, {_FLAG("a.zip <> '' AND b.zip <> '' AND levenshtein(a.zip, b.zip) <= 1")} AS zip_lev1,
length(a.addr) AS a_len_1, length(b.addr) AS a_len_2 {_PAIR_FROM}""",
        _LISTS,
    )
)
def pair_flags(spark, sf_dir):
    """Equality, conflict and missing flags of all candidates."""
    pairs = _stored_union(spark, sf_dir).select("s1_gid", "s23_gid")
    d = features.flags(features.sides(pairs, *_both(spark, sf_dir, fx.records), features.RECORD_FIELDS))
    return d.select("s1_gid", "s23_gid", *_FLAG_COLUMNS).withColumn("n_len_ratio", F.round("n_len_ratio", 6))


_NUMS = lambda e: f"list_transform(regexp_extract_all({e}, '[0-9]+'), lambda x: CASE WHEN ltrim(x, '0') = '' THEN '0' ELSE ltrim(x, '0') END)"


@query(
    with_fixture(
        """SELECT s1_gid, s23_gid, least(levenshtein(array_to_string(m1, ''), array_to_string(m2, '')), 9)::DOUBLE AS x_num_lev, CASE WHEN len(list_distinct(list_concat(m1, m2))) = 0 THEN -1::DOUBLE ELSE round(len(list_intersect(m1, m2)) / len(list_distinct(list_concat(m1, m2))), 6) END AS x_num_jacc,
len(list_distinct(list_filter(m2, lambda x: NOT list_contains(m1, x))))::DOUBLE AS x_num_extra2, len(list_distinct(list_filter(m1, lambda x: NOT list_contains(m2, x))))::DOUBLE AS x_num_miss2,
CASE WHEN len(m1) = 0 OR len(m2) = 0 THEN -1::DOUBLE ELSE least(abs(substr(m1[1], 1, 7)::BIGINT - substr(m2[1], 1, 7)::BIGINT), 1000)::DOUBLE END AS x_hn_absdiff FROM p""",
        _LISTS,
        f"p AS (SELECT s1_gid, s23_gid, {_NUMS('a.hn || chr(32) || a.zip || chr(32) || a.addr')} AS m1, {_NUMS('b.hn || chr(32) || b.zip || chr(32) || b.addr')} AS m2 {_PAIR_FROM})",
    )
)
def number_noise_sets(spark, sf_dir):
    """What the numbers of both addresses share."""
    pairs = _stored_union(spark, sf_dir).select("s1_gid", "s23_gid")
    a, b = (d.withColumn("addr", F.concat_ws(" ", "hn", "zip", "addr")) for d in _both(spark, sf_dir, fx.records))
    return features.number_sets(pairs, a, b).select("s1_gid", "s23_gid", *features.NUMBERS[3:]).withColumn("x_num_jacc", F.round("x_num_jacc", 6))


@query()
def edit_distances(spark, sf_dir):
    """Levenshtein and Jaro-Winkler of names without spaces, in code points (DuckDB measures bytes, so without SQL)."""
    ship(spark)
    d = features.sides(_stored_union(spark, sf_dir).select("s1_gid", "s23_gid"), *_both(spark, sf_dir, fx.records), ["ns"])
    d = d.withColumn("k", scores([("jw", "jaro_winkler", F.col("ns_1"), F.col("ns_2"))]))
    return d.select("s1_gid", "s23_gid", F.levenshtein("ns_1", "ns_2").alias("lev"), F.round("k.jw", 6).alias("jw"))


@query()
def record_features(spark, sf_dir):
    """All name, address and context features of all candidates."""
    return features.record_features(_stored_union(spark, sf_dir), *_both(spark, sf_dir, fx.records))


@query()
def number_features(spark, sf_dir):
    """All number-noise features of all candidates."""
    return features.number_features(_stored_union(spark, sf_dir).select("s1_gid", "s23_gid"), *_both(spark, sf_dir, fx.records))


@query()
def sound_features(spark, sf_dir):
    """Soundex features of all candidates."""
    d = features.sides(_stored_union(spark, sf_dir).select("s1_gid", "s23_gid"), *_both(spark, sf_dir, fx.records), ["core"])
    return features.soundex_features(d)


def _contexted(spark, sf_dir) -> DataFrame:
    d = _simple(spark, sf_dir)
    return d.withColumns({"n_tset": F.round(100 * F.col("name_jaccard"), 6), "a_tset": F.round(100 * F.col("addr_token_jaccard"), 6)})


_CTX = "x AS (SELECT s1_gid, s23_gid, round(100 * name_jaccard, 6) AS n, round(100 * addr_token_jaccard, 6) AS a FROM simple)"
_CTX_PART = lambda e, p: f"rank() OVER (PARTITION BY s1_gid ORDER BY {e} DESC) AS {p}_rank, round(max({e}) OVER (PARTITION BY s1_gid) - ({e}), 6) AS {p}_gap"


@query(with_fixture(f"SELECT s1_gid, s23_gid, {_CTX_PART('n', 'ctx_n')}, {_CTX_PART('a', 'ctx_a')}, {_CTX_PART('n + a', 'ctx_c')}, count(*) FILTER (n >= 95) OVER (PARTITION BY s1_gid) AS ctx_n_hi, count(*) OVER (PARTITION BY s1_gid) AS ctx_n_cand FROM x", _LISTS, _SIMPLE, _CTX))
def ctx_windows(spark, sf_dir):
    """Ranks and gaps within a row's candidates."""
    d = features.full_context(_contexted(spark, sf_dir)).select("s1_gid", "s23_gid", *features.CONTEXT)
    return d.withColumns({c: F.round(c, 6) for c in features.CONTEXT if c.endswith("_gap")})


@query(
    with_fixture(
        """SELECT s1_gid, s23_gid, count(*) OVER g AS n_cand_s1, round(blocking_score / max(blocking_score) OVER g, 6) AS score_rel_max, round(max(blocking_score) OVER g - blocking_score, 6) AS score_gap_top,
dense_rank() OVER (PARTITION BY s1_gid ORDER BY name_jaccard DESC) AS name_jac_rank, round(coalesce(name_jaccard / nullif(max(name_jaccard) OVER g, 0), 0), 6) AS name_jac_rel_max, count(*) FILTER (name_jaccard = 1) OVER g AS n_exact_name_s1,
dense_rank() OVER (PARTITION BY s1_gid ORDER BY addr_token_jaccard DESC) AS addr_jac_rank, count(*) OVER (PARTITION BY s23_gid) AS n_s1_sharing_s23 FROM simple WINDOW g AS (PARTITION BY s1_gid)""",
        _LISTS,
        _SIMPLE,
    )
)
def group_context(spark, sf_dir):
    """Context features of the first model."""
    d = features.group_context(_simple(spark, sf_dir))
    cols = ["n_cand_s1", "score_rel_max", "score_gap_top", "name_jac_rank", "name_jac_rel_max", "n_exact_name_s1", "addr_jac_rank", "n_s1_sharing_s23"]
    return d.select("s1_gid", "s23_gid", *cols).withColumns({c: F.round(c, 6) for c in ("score_rel_max", "score_gap_top", "name_jac_rel_max")})


@query(
    with_fixture(
        """SELECT s1_gid, s23_gid, p1_rank, CASE WHEN prob >= best THEN coalesce(second, 0) ELSE best END AS p1_max_other, n_conf - (prob >= 0.5)::INT AS p1_n_conf_other FROM (
SELECT *, max(CASE WHEN p1_rank = 2 THEN prob END) OVER (PARTITION BY s1_gid) AS second FROM (SELECT s1_gid, s23_gid, prob, row_number() OVER (PARTITION BY s1_gid ORDER BY prob DESC, s23_gid) AS p1_rank, max(prob) OVER (PARTITION BY s1_gid) AS best, count(*) FILTER (prob >= 0.5) OVER (PARTITION BY s1_gid) AS n_conf FROM prob))""",
        _LISTS,
        _SIMPLE,
    )
)
def pass2_windows(spark, sf_dir):
    """What the other candidates' probabilities say."""
    return features.rivals(_prob(spark, sf_dir), "prob").select("s1_gid", "s23_gid", "p1_rank", "p1_max_other", "p1_n_conf_other")


@query()
def pass2_siblings(spark, sf_dir):
    """Similarity to other confident candidates."""
    d = features.siblings(_prob(spark, sf_dir), fx.second_side(fx.records(spark, sf_dir)), "prob")
    return d.select("s1_gid", "s23_gid", "sib_name_max", "sib_addr_max", "sib_both_max")


# ---------------------------------------------------------------- labels and splits


def _counts(spark, sf_dir) -> DataFrame:
    r = fx.raw(spark, sf_dir)
    found = fx.truth(spark, sf_dir).join(r.select(F.col("gid").alias("s23_gid"), F.col("src").alias("s23_src")), "s23_gid")
    return labels.match_counts(found, fx.first_side(r).withColumn("entity_id", F.concat(F.lit("S1-"), F.col("gid").cast("string"))))


_COUNTS = """mc AS (SELECT r.gid AS s1_gid, 'S1-' || r.gid AS s1_id, r.country, count(*) FILTER (s.src = 2) AS n_s2, count(*) FILTER (s.src = 3) AS n_s3, count(s.gid) AS n_total FROM raw r LEFT JOIN truth t ON t.s1_gid = r.gid LEFT JOIN raw s ON s.gid = t.s23_gid WHERE r.src = 1 GROUP BY ALL),
mb AS (SELECT *, n_total = 0 AS is_singleton, CASE WHEN n_total = 0 THEN '0' WHEN n_total <= 2 THEN '1-2' WHEN n_total <= 4 THEN '3-4' ELSE '5+' END AS bucket FROM mc),
sp AS (SELECT *, CASE WHEN r <= floor(n * 0.7::DOUBLE) THEN 'FIT' WHEN r <= floor(n * 0.7::DOUBLE) + floor(n * 0.2::DOUBLE) THEN 'VALIDATION' ELSE 'LOCKBOX' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY country, bucket ORDER BY sha256('20260925|split|' || s1_id)) AS r, count(*) OVER (PARTITION BY country, bucket) AS n FROM mb))"""


@query(with_fixture("SELECT * FROM mb", _COUNTS))
def match_counts(spark, sf_dir):
    """Links of every first-side row."""
    return _counts(spark, sf_dir)


@query(with_fixture("SELECT s1_gid, s1_id, country, bucket, split FROM sp", _COUNTS))
def split_assign(spark, sf_dir):
    """Stratified split by hash."""
    return labels.split(_counts(spark, sf_dir)).select("s1_gid", "s1_id", "country", "bucket", "split")


_TARGETS = """sizes AS (SELECT country, count(*) FILTER (src = 1) AS n1, count(*) FILTER (src <> 1) AS p1, count(*) FILTER (src = 1 AND gid % 2 = 0) AS n2, count(*) FILTER (src <> 1) AS p2 FROM raw GROUP BY 1),
tg AS (SELECT country, round_even(greatest(0, 1 - (p1 / n1) / (p2 / n2)) * n1, 0)::BIGINT AS n_hide FROM sizes WHERE n1 > 0 AND n2 > 0 AND p2 > 0)"""


@query(with_fixture("SELECT s1_gid, split, split = 'FIT' AND row_number() OVER (PARTITION BY country, split ORDER BY sha256('20260925|stress|' || s1_id)) <= coalesce(n_hide, 0) AS stress_hidden FROM sp LEFT JOIN tg USING (country)", _COUNTS, _TARGETS))
def stress_hide(spark, sf_dir):
    """FIT rows hidden so that the pool is as crowded as that of a table with half the first side."""
    r = fx.raw(spark, sf_dir)
    targets = labels.stress_targets(r, r.filter("src <> 1 or gid % 2 = 0"))
    return labels.stress(labels.split(_counts(spark, sf_dir)), targets).select("s1_gid", "split", "stress_hidden")


@query(with_fixture("SELECT country, bucket, split, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (PARTITION BY country, bucket), 6) AS share FROM sp GROUP BY country, bucket, split", _COUNTS))
def strata_check(spark, sf_dir):
    """Shares of the splits in every stratum."""
    return labels.strata(labels.split(_counts(spark, sf_dir))).drop("off_by").withColumn("share", F.round("share", 6))


@query(
    """WITH ids AS (SELECT c_custkey, CASE WHEN n = 0 THEN [] ELSE l END AS ids FROM (SELECT c_custkey, count(o_orderkey) AS n, list(o_orderkey) AS l FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderkey % 4 <> 0 WHERE c_custkey % 5 <> 0 GROUP BY 1))
SELECT 'first_side_without_row' AS "check", (SELECT count(*) FROM customer WHERE c_custkey % 5 = 0) AS violations UNION ALL SELECT 'row_without_first_side', 0 UNION ALL SELECT 'first_side_repeated', 0 UNION ALL SELECT 'id_repeated_in_list', 0
UNION ALL SELECT 'empty_id_in_list', 0 UNION ALL SELECT 'unknown_second_side', (SELECT count(*) FROM orders WHERE o_orderkey % 4 <> 0 AND o_custkey % 5 <> 0 AND o_orderkey % 3 = 0 AND o_custkey IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'second_side_linked_twice', 0 UNION ALL SELECT 'countries_differ', (SELECT count(*) FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey % 4 <> 0 AND o_custkey % 5 <> 0 AND o_orderkey % 3 <> 0 AND o_orderkey % 7 <> c_nationkey % 7)"""
)
def label_integrity(spark, sf_dir):
    """Checks of a ground truth made of customers and their orders, with faults put in."""
    c = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("entity_id"), F.col("c_custkey").alias("gid"), (F.col("c_nationkey") % 7).cast("string").alias("country"))
    o = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lists = o.filter("o_orderkey % 4 <> 0").groupBy("o_custkey").agg(F.array_join(F.collect_list(F.col("o_orderkey").cast("string")), ",").alias("matched_entity_ids"))
    truth = c.filter("gid % 5 <> 0").join(lists, F.col("gid") == F.col("o_custkey"), "left").select(F.col("entity_id").alias("source1_entity_id"), F.coalesce("matched_entity_ids", F.lit("")).alias("matched_entity_ids"))
    second = o.filter("o_orderkey % 3 <> 0").select(F.col("o_orderkey").cast("string").alias("entity_id"), F.col("o_orderkey").alias("gid"), F.lit(2).alias("src"), (F.col("o_orderkey") % 7).cast("string").alias("country"))
    return labels.integrity(truth, c, second)


@query("SELECT 'all' AS dataset, 1 AS src, count(*) AS n, count(*) - count(DISTINCT c_custkey % 1000) AS repeated_ids, count(*) FILTER (c_custkey % 10 = 0) AS malformed_ids, count(*) FILTER (c_nationkey = 0) AS empty_country FROM (SELECT c_custkey, c_nationkey FROM customer) c HAVING count(*) > 0")
def id_integrity(spark, sf_dir):
    """Repeated and malformed ids, empty countries."""
    k = F.col("c_custkey")
    entity = F.concat(F.when(k % 10 == 0, "S2-").otherwise("S1-"), (k % 1000).cast("string"))
    c = fx.table(spark, sf_dir, "customer").select(F.lit("all").alias("dataset"), F.lit(1).alias("src"), entity.alias("entity_id"), F.when(F.col("c_nationkey") == 0, "").otherwise("x").alias("country"))
    return profile.id_integrity(c)


_PCT = lambda cond: f"round(100.0 * avg(CASE WHEN {cond} THEN 1 ELSE 0 END), 6)"


@query(
    f"""SELECT lang AS country, count(*) AS n, {_PCT("text = ''")} AS pct_empty, {_PCT("len(list_filter(string_split(text, ','), lambda p: lower(trim(p, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' ')) IN ('null', '<null>', 'none', 'n/a', 'na'))) > 0")} AS pct_null_part,
{_PCT("regexp_matches(text, '[À-ɏ]')")} AS pct_accent, {_PCT("regexp_matches(text, '[ऀ-ॿ]')")} AS pct_devanagari, {_PCT("text <> '' AND text = upper(text) AND text <> lower(text)")} AS pct_upper, {_PCT("text <> '' AND text = lower(text) AND text <> upper(text)")} AS pct_lower,
{_PCT("contains(text, '  ')")} AS pct_double_space, {_PCT("NOT regexp_full_match(text, '[\\x00-\\x7F]*')")} AS pct_non_ascii, quantile_disc(length(text), 0.5) AS p50_length, quantile_disc(length(text), 0.99) AS p99_length FROM documents GROUP BY 1"""
)
def profile_by_lang(spark, sf_dir):
    """Profile of texts by language."""
    return profile.profile(fx.table(spark, sf_dir, "documents").withColumnRenamed("lang", "country"), "text")


_KINDS = {"control": r"[\x00-\x08\x0E-\x1F\x7F]", "c1_control": r"[\x{80}-\x{9F}]", "format": r"\p{Cf}", "latin_accented": "[À-ɏ]", "indic": "[ऀ-ൿ]", "digit": r"\p{Nd}", "ascii_digit": "[0-9]"}
_COUNTED = ", ".join(f"coalesce(sum(len(regexp_extract_all(text, '{p}'))), 0)::BIGINT AS {k}" for k, p in _KINDS.items())


@query(f"SELECT country, kind, n FROM (SELECT * EXCLUDE (digit, ascii_digit), digit - ascii_digit AS other_digit FROM (SELECT lang AS country, {_COUNTED} FROM documents GROUP BY 1)) UNPIVOT (n FOR kind IN (control, c1_control, format, latin_accented, indic, other_digit))")
def character_census(spark, sf_dir):
    """Characters that cleaning treats specially."""
    return profile.characters(fx.table(spark, sf_dir, "documents").withColumnRenamed("lang", "country"), "text")


@query()
def table_hash(spark, sf_dir):
    """Order-free content hash of the documents."""
    return profile.content_hash(fx.table(spark, sf_dir, "documents"), ["doc_id", "text", "lang", "source"])


# ---------------------------------------------------------------- decisions

_DECIDED = f"linked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s23_gid ORDER BY prob DESC, s1_gid) AS rr FROM prob WHERE prob >= {THRESHOLD}) WHERE rr = 1)"


@query(with_fixture("SELECT s1_gid, s23_gid, prob FROM linked", _LISTS, _SIMPLE, _DECIDED))
def one_s1_per_s23(spark, sf_dir):
    """Links above the threshold, one for each second-side row."""
    return decide.at_threshold(_prob(spark, sf_dir), THRESHOLD).select("s1_gid", "s23_gid", "prob")


def _rows(spark, sf_dir) -> DataFrame:
    return fx.first_side(fx.raw(spark, sf_dir)).select(F.col("gid").alias("s1_gid"), "country")


@query(with_fixture("SELECT round(avg(f05), 9) AS f05, count(*) AS n FROM scored_rows", _LISTS, _SIMPLE, _DECIDED, _per_row_cte("linked")))
def macro_f05(spark, sf_dir):
    """Flagship: keys, candidates, features, decision and macro F0.5 in one plan."""
    links = decide.at_threshold(_prob(spark, sf_dir), THRESHOLD)
    return metric.macro(metric.per_row(links, fx.truth(spark, sf_dir), _rows(spark, sf_dir))).withColumn("f05", F.round("f05", 9))


@query(
    with_fixture(
        "SELECT CASE WHEN grouping(country) = 0 THEN 'country' WHEN grouping(bucket) = 0 THEN 'bucket' ELSE 'all' END AS level, coalesce(country, bucket, '') AS value, round(avg(f05), 9) AS f05, count(*) AS n, round(avg((n_pred = 0)::INT), 9) AS empty_share, round(sum(tp) / nullif(sum(n_pred), 0), 9) AS pair_precision, round(sum(tp) / nullif(sum(n_true), 0), 9) AS pair_recall FROM (SELECT *, CASE WHEN n_true = 0 THEN '0' WHEN n_true <= 2 THEN '1-2' WHEN n_true <= 4 THEN '3-4' ELSE '5+' END AS bucket FROM scored_rows) GROUP BY GROUPING SETS ((), (country), (bucket))",
        _LISTS,
        _SIMPLE,
        _DECIDED,
        _per_row_cte("linked"),
    )
)
def f05_by_group(spark, sf_dir):
    """Report overall, by country and by number of links."""
    links = decide.at_threshold(_prob(spark, sf_dir), THRESHOLD)
    rows = metric.per_row(links, fx.truth(spark, sf_dir), _rows(spark, sf_dir))
    out = metric.report(rows.withColumn("bucket", labels.bucket(F.col("n_true"))))
    return out.withColumns({c: F.round(c, 9) for c in ("f05", "empty_share", "pair_precision", "pair_recall")})


@query(
    with_fixture(
        f"""SELECT threshold, round((SELECT avg(CASE WHEN x.n_true = 0 AND x.n_pred = 0 THEN 1.0::DOUBLE WHEN x.tp = 0 THEN 0.0::DOUBLE ELSE 1.25 * (x.tp / x.n_pred) * (x.tp / x.n_true) / (0.25 * (x.tp / x.n_pred) + x.tp / x.n_true) END) FROM per x WHERE x.threshold = g.threshold), 9) AS f05,
(SELECT sum(n_pred) FROM per x WHERE x.threshold = g.threshold)::BIGINT AS n_pred, (SELECT sum(tp) FROM per x WHERE x.threshold = g.threshold)::BIGINT AS tp FROM grid g""",
        _LISTS,
        _SIMPLE,
        "grid AS (SELECT round(0.1 * i, 2)::DOUBLE AS threshold FROM range(1, 10) r(i))",
        "kept AS (SELECT * FROM (SELECT p.*, t.s1_gid IS NOT NULL AS hit, row_number() OVER (PARTITION BY p.s23_gid ORDER BY prob DESC, p.s1_gid) AS rr FROM prob p LEFT JOIN truth t ON t.s1_gid = p.s1_gid AND t.s23_gid = p.s23_gid) WHERE rr = 1)",
        "per AS (SELECT threshold, r.gid, count(k.s23_gid) AS n_pred, count(*) FILTER (k.hit) AS tp, any_value(coalesce(tt.n, 0)) AS n_true FROM grid CROSS JOIN raw r LEFT JOIN kept k ON k.s1_gid = r.gid AND k.prob >= threshold LEFT JOIN (SELECT s1_gid, count(*) AS n FROM truth GROUP BY 1) tt ON tt.s1_gid = r.gid WHERE r.src = 1 GROUP BY ALL)",
    )
)
def threshold_curve(spark, sf_dir):
    """Score at every threshold from one pass."""
    out = decide.threshold_curve(_prob(spark, sf_dir), fx.truth(spark, sf_dir), _rows(spark, sf_dir), [round(0.1 * i, 2) for i in range(1, 10)])
    return out.withColumn("f05", F.round("f05", 9))


@query(
    with_fixture(
        "SELECT s1_gid, s23_gid, prob FROM (SELECT *, max(struct_pack(f := f, k := k)) OVER (PARTITION BY s1_gid) AS best FROM b2) WHERE best.f > none AND k <= best.k",
        _LISTS,
        _SIMPLE,
        "b1 AS (SELECT s1_gid, s23_gid, prob, row_number() OVER o AS k, sum(prob) OVER (o ROWS UNBOUNDED PRECEDING) AS tp, sum(prob) OVER (PARTITION BY s1_gid) + 0.1 AS s, exp(sum(ln(greatest(1 - prob, 1e-9))) OVER (PARTITION BY s1_gid)) AS none FROM prob WINDOW o AS (PARTITION BY s1_gid ORDER BY prob DESC, s23_gid))",
        "b2 AS (SELECT *, CASE WHEN prob >= 0.1 THEN round(1.25 * tp / (0.25 * s + k), 9) ELSE -1 END AS f FROM b1)",
    )
)
def bestset(spark, sf_dir):
    """Links that maximise the expected score."""
    return decide.expected_best_set(_prob(spark, sf_dir), 0.1, 0.1).select("s1_gid", "s23_gid", "prob")


_TL = {"en": 0.3, "fr": 0.35}


@query(
    with_fixture(
        "SELECT s1_gid, s23_gid, prob FROM (SELECT *, row_number() OVER (PARTITION BY s23_gid ORDER BY prob DESC, s1_gid) AS rr FROM d WHERE prob >= 0.5 OR (r = 1 AND prob >= low)) WHERE rr = 1",
        _LISTS,
        _SIMPLE,
        "d AS (SELECT p.*, row_number() OVER (PARTITION BY s1_gid ORDER BY prob DESC, s23_gid) AS r, CASE country WHEN 'en' THEN 0.3 WHEN 'fr' THEN 0.35 ELSE 0.4 END AS low FROM prob p JOIN raw ON gid = s1_gid)",
    )
)
def rescue_by_country(spark, sf_dir):
    """Lower bars for each row's best candidate, by country."""
    d = _prob(spark, sf_dir).join(_rows(spark, sf_dir), "s1_gid")
    return decide.with_rescue(d, {}, _TL, 0.5, 0.4).select("s1_gid", "s23_gid", "prob")


_OUT = """subm AS (SELECT 'S1-' || r.gid AS source1_entity_id, coalesce(m.ids, '') AS matched_entity_ids FROM raw r LEFT JOIN (SELECT s1_gid, array_to_string(list_sort(list('S' || src || '-' || gid)), ',') AS ids FROM linked JOIN raw ON gid = s23_gid GROUP BY 1) m ON m.s1_gid = r.gid WHERE r.src = 1)"""


def _submission(spark, sf_dir, links: DataFrame, column: str = "matched_entity_ids") -> DataFrame:
    r = fx.raw(spark, sf_dir).select("gid", "src", F.concat(F.lit("S"), F.col("src").cast("string"), F.lit("-"), F.col("gid").cast("string")).alias("entity_id"))
    return tsv.link_rows(links, fx.first_side(r), fx.second_side(r), fx.first_side(r), column)


@query(with_fixture("SELECT * FROM subm", _LISTS, _SIMPLE, _DECIDED, _OUT))
def submission_rows(spark, sf_dir):
    """The output table: every first-side row with its sorted ids."""
    return _submission(spark, sf_dir, decide.at_threshold(_prob(spark, sf_dir), THRESHOLD))


@query(
    "SELECT * FROM (VALUES ('matches_repeated_first_side', 0), ('matches_missing_first_side', 0), ('matches_unknown_first_side', 0), ('matches_self_match', 0), ('matches_wrong_prefix', 0), ('matches_repeated_id', 0), ('candidates_repeated_first_side', 0), ('candidates_missing_first_side', 0), ('candidates_unknown_first_side', 0), ('candidates_self_match', 0), ('candidates_wrong_prefix', 0), ('candidates_repeated_id', 0), ('match_not_among_candidates', 0), ('second_side_linked_twice', 0)) v(\"check\", violations)"
)
def submission_checks(spark, sf_dir):
    """Checks of both output tables, which must find nothing."""
    prob = _prob(spark, sf_dir)
    every = fx.first_side(fx.raw(spark, sf_dir)).select(F.concat(F.lit("S1-"), F.col("gid").cast("string")).alias("entity_id"))
    return tsv.check_output(_submission(spark, sf_dir, decide.at_threshold(prob, THRESHOLD)), _submission(spark, sf_dir, prob, "candidate_entity_ids"), every)


_BUCKET = "('0x' || substr(sha256(s1_gid || '|' || s23_gid), 1, 8))::BIGINT % 1000"


@query(with_fixture(f"SELECT s1_gid, s23_gid, label, CASE WHEN hard THEN 1.0::DOUBLE ELSE 5.0::DOUBLE END AS weight FROM h WHERE hard OR {_BUCKET} < 200", _LISTS, _SIMPLE, "h AS (SELECT p.s1_gid, p.s23_gid, (t.s1_gid IS NOT NULL)::INT AS label, t.s1_gid IS NOT NULL OR 100 * name_jaccard >= 70 AS hard FROM prob p LEFT JOIN truth t ON t.s1_gid = p.s1_gid AND t.s23_gid = p.s23_gid)"))
def subsample_weights(spark, sf_dir):
    """Training rows: all hard ones, a weighted fifth of the easy ones."""
    d = model.labelled(_prob(spark, sf_dir), fx.truth(spark, sf_dir)).withColumn("n_tset", 100 * F.col("name_jaccard"))
    return model.subsample(d).select("s1_gid", "s23_gid", "label", "weight")


@query()
def gbt_score(spark, sf_dir):
    """Boosted trees trained on sub-sampled pairs, scoring all pairs."""
    inputs = ["blocking_score", "blocking_rank", "name_jaccard", "name_overlap_n", "addr_token_jaccard", "house_number_match", "zip_match", "legal_form_match", "legal_form_both_present"]
    pairs = ranked.first_cut(*_both(spark, sf_dir), K_NAME, K_ADDRESS, K_FIRST)
    d = stored(model.labelled(features.simple_features(pairs, *_both(spark, sf_dir)), fx.truth(spark, sf_dir))).df  # read by every step of the training
    fitted = model.train(model.subsample(d), inputs)
    return model.predict(fitted, d).select("s1_gid", "s23_gid", F.round("prob", 6).alias("prob"))


# ---------------------------------------------------------------- analysis


@query(
    with_fixture(
        """SELECT CASE WHEN t.s1_gid IS NULL THEN 'false_link' WHEN l.s1_gid IS NOT NULL THEN 'found' WHEN p.s1_gid IS NOT NULL THEN 'lost_by_model' ELSE 'lost_in_blocking' END AS class, count(*) AS n
FROM truth t FULL JOIN linked l ON l.s1_gid = t.s1_gid AND l.s23_gid = t.s23_gid LEFT JOIN prob p ON p.s1_gid = coalesce(t.s1_gid, l.s1_gid) AND p.s23_gid = coalesce(t.s23_gid, l.s23_gid) GROUP BY 1""",
        _LISTS,
        _SIMPLE,
        _DECIDED,
    )
)
def loss_split(spark, sf_dir):
    """Where true links are lost."""
    prob = _prob(spark, sf_dir)
    return analysis.loss_split(decide.at_threshold(prob, THRESHOLD), prob, fx.truth(spark, sf_dir))


@query(with_fixture("SELECT least(floor(prob * 10), 9)::BIGINT AS bin, count(*) AS n, count(t.s1_gid) AS n_true FROM prob p LEFT JOIN truth t ON t.s1_gid = p.s1_gid AND t.s23_gid = p.s23_gid GROUP BY 1", _LISTS, _SIMPLE))
def score_histogram(spark, sf_dir):
    """Candidates by score."""
    return analysis.histogram(_prob(spark, sf_dir), fx.truth(spark, sf_dir))


@query(
    with_fixture(
        f"SELECT k, round(avg({_F05}), 9) AS f05 FROM per GROUP BY k",
        _LISTS,
        _SIMPLE,
        "ks AS (SELECT unnest([1, 3, 10]) AS k)",
        f"kept AS (SELECT * FROM (SELECT k, p.s1_gid, p.s23_gid, row_number() OVER (PARTITION BY k, p.s23_gid ORDER BY prob DESC, p.s1_gid) AS rr FROM prob p JOIN ks ON blocking_rank <= k WHERE prob >= {THRESHOLD}) WHERE rr = 1)",
        "per AS (SELECT ks.k, r.gid, count(x.s23_gid) AS n_pred, count(t.s23_gid) AS tp, any_value(coalesce(tt.n, 0)) AS n_true FROM ks CROSS JOIN raw r LEFT JOIN kept x ON x.k = ks.k AND x.s1_gid = r.gid LEFT JOIN truth t ON t.s1_gid = x.s1_gid AND t.s23_gid = x.s23_gid LEFT JOIN (SELECT s1_gid, count(*) AS n FROM truth GROUP BY 1) tt ON tt.s1_gid = r.gid WHERE r.src = 1 GROUP BY ALL)",
    )
)
def length_sweep(spark, sf_dir):
    """Score by length of the candidate lists."""
    out = analysis.length_sweep(_prob(spark, sf_dir), fx.truth(spark, sf_dir), _rows(spark, sf_dir), THRESHOLD, [1, 3, 10], "blocking_rank")
    return out.withColumn("f05", F.round("f05", 9))


@query(with_fixture("SELECT country, count(*) FILTER (z <> '') AS n_zip, count(*) FILTER (z <> '' AND ltrim(z, '0') = ltrim(addr_house_number, '0')) AS n_same, round(count(*) FILTER (z <> '' AND ltrim(z, '0') = ltrim(addr_house_number, '0')) / nullif(count(*) FILTER (z <> ''), 0), 6) AS share FROM (SELECT *, CASE WHEN gid % 3 = 0 THEN '' WHEN gid % 3 = 1 THEN '0' || addr_house_number ELSE addr_zip END AS z FROM cleaned) GROUP BY 1"))
def zip_collisions(spark, sf_dir):
    """Zip-like tokens that repeat the house number."""
    c = fx.cleaned(spark, sf_dir)
    z = F.when(F.col("gid") % 3 == 0, "").when(F.col("gid") % 3 == 1, F.concat(F.lit("0"), "addr_house_number")).otherwise(F.col("addr_zip"))
    return analysis.zip_collisions(c.withColumn("addr_zip", z)).withColumn("share", F.round("share", 6))


@query(with_fixture("SELECT category, count(*) AS n_links FROM (SELECT CASE WHEN len(list_intersect(list_filter(a.name_tokens, lambda x: x <> ''), list_filter(b.name_tokens, lambda x: x <> ''))) > 0 THEN 'shares_name_token' ELSE 'other' END AS category FROM truth t JOIN cleaned a ON a.gid = t.s1_gid JOIN cleaned b ON b.gid = t.s23_gid WHERE NOT EXISTS (SELECT 1 FROM first1 f WHERE f.s1_gid = t.s1_gid AND f.s23_gid = t.s23_gid AND f.blocking_rank <= 1)) GROUP BY 1", _LISTS))
def missed_similarity(spark, sf_dir):
    """What missed links still share, for lists of one."""
    short = _first(spark, sf_dir).filter("blocking_rank <= 1")
    out = blocking.missed_similarity(fx.truth(spark, sf_dir), short, *_both(spark, sf_dir))
    return out.groupBy(F.when(F.col("category") == "shares_name_token", F.col("category")).otherwise("other").alias("category")).agg(F.sum("n_links").alias("n_links"))
