"""Normalisation of entity rows: names, addresses, countries. One projection after another, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def normalise_names(df: DataFrame, col: str = "business_name", folded: Column | None = None, extended: bool = False) -> DataFrame:
    """df with name_raw, name_clean, name_canonical, name_tokens, name_sorted, name_suffix (null if none), name_url.

    folded replaces the Latin folding, e.g. by functions.fuzzy.fold_any. extended also takes off a leading "the" and what
    follows "dba", "aka" or "fka", and a top-level domain glued to a long single word.
    """
    df = df.withColumn("name_raw", T.strip(F.col(col)))
    df = df.withColumn("_fold", T.fold(F.col("name_raw")) if folded is None else folded)
    df = df.withColumn("name_url", F.col("_fold").rlike(T.URL_START) | F.col("_fold").rlike(T.URL_END))
    opened = F.regexp_replace(F.regexp_replace(F.regexp_replace("_fold", T.URL_START, " "), T.URL_END, " "), r"[./_-]", " ")
    df = df.withColumn("_fold", F.regexp_replace(F.when(F.col("name_url"), opened).otherwise(F.col("_fold")), T.PHONE, " "))
    df = df.withColumn("_clean", T.squeeze(F.col("_fold")))
    if extended:
        core = F.regexp_replace(F.regexp_replace("_clean", r"^the\s+", ""), r"\s+(?:d b a|dba|a k a|aka|f k a|fka)\s.*$", "")
        core = F.when(~core.contains(" ") & (F.length(core) >= 8), F.regexp_replace(core, r"^(.{4,}?)(?:com|org|net|gov|edu)$", "$1")).otherwise(core)
        df = df.withColumn("_clean", F.when(core == "", F.col("_clean")).otherwise(core))
    df = df.withColumn("_bare", F.trim(F.regexp_replace("_clean", T.HONORIFIC, "")))
    df = df.withColumn("name_clean", F.when(F.col("_bare") != "", F.col("_bare")).otherwise(F.col("_clean")))
    df = df.withColumn("_legal", T.longest(F.regexp_extract_all("name_clean", F.lit(T.LEGAL_PATTERN), F.lit(1))))
    df = df.withColumn("_root", F.trim(F.regexp_replace(F.regexp_replace("name_clean", T.LEGAL_PATTERN, " "), r"\s+", " ")))
    df = df.withColumn("name_canonical", F.when(F.col("_root") != "", F.col("_root")).otherwise(F.col("name_clean")))
    df = df.withColumn("name_suffix", F.when(F.col("_legal") != "", F.element_at(T.lookup(T.LEGAL_FORMS), F.col("_legal"))))
    df = df.withColumn("name_tokens", T.tokens(F.col("name_canonical")))
    return df.withColumn("name_sorted", F.array_sort(F.array_distinct("name_tokens"))).drop("_fold", "_clean", "_bare", "_legal", "_root")


def normalise_addresses(df: DataFrame, col: str = "business_address", folded: Column | None = None) -> DataFrame:
    """df with addr_raw, addr_clean, addr_canonical, addr_tokens, addr_sorted, addr_numbers (sorted as strings), addr_postal, addr_empty."""
    df = df.withColumn("addr_raw", T.strip(F.col(col)))
    df = df.withColumn("addr_empty", (F.col("addr_raw") == "") | F.lower("addr_raw").isin(T.FIELD_MISSING))
    df = df.withColumn("_fold", F.when(F.col("addr_empty"), F.lit("")).otherwise(T.fold(F.col("addr_raw")) if folded is None else folded))
    df = df.withColumn("addr_postal", F.nullif(F.regexp_extract("_fold", T.POSTAL, 1), F.lit("")))
    spaced = F.regexp_replace("_fold", r"[^a-z0-9\s]", " ")
    df = df.withColumn("addr_clean", F.trim(F.regexp_replace(F.regexp_replace(spaced, T.ORDINAL, "$1"), r"\s+", " ")))
    words = T.lookup(T.ADDRESS_WORDS)
    df = df.withColumn("_words", F.transform(T.tokens(F.col("addr_clean")), lambda t: F.coalesce(F.element_at(words, t), t)))
    df = df.withColumn("addr_canonical", F.array_join("_words", " "))
    is_number = lambda t: t.rlike("^[0-9]{1,6}$")
    df = df.withColumn("addr_tokens", F.transform("_words", lambda t: F.when(is_number(t), T.unzero(t)).otherwise(t)))
    df = df.withColumn("addr_sorted", F.array_sort(F.array_distinct("addr_tokens")))
    return df.withColumn("addr_numbers", F.filter("addr_sorted", lambda t: is_number(t))).drop("_fold", "_words")


def normalise_countries(df: DataFrame, col: str = "country", aliases: dict[str, str] | None = None, seen: list[str] | None = None, folded: Column | None = None) -> DataFrame:
    """df with country_canonical, country_missing, country_seen (whether training data had it)."""
    df = df.withColumn("_raw", T.strip(F.col(col)))
    df = df.withColumn("country_missing", (F.col("_raw") == "") | F.lower("_raw").isin(T.FIELD_MISSING))
    df = df.withColumn("_clean", T.squeeze(T.fold(F.col("_raw")) if folded is None else folded))
    names = T.lookup(T.COUNTRIES | (aliases or {}))
    df = df.withColumn("country_canonical", F.when(F.col("country_missing"), F.lit("")).otherwise(F.coalesce(F.element_at(names, F.col("_clean")), F.upper("_clean"))))
    return df.withColumn("country_seen", F.col("country_canonical").isin(T.SEEN_COUNTRIES if seen is None else seen)).drop("_raw", "_clean")


def normalise(df: DataFrame) -> DataFrame:
    return normalise_countries(normalise_addresses(normalise_names(df)))


def _case(table: dict[str, str], c: str) -> str:
    return "map {" + ", ".join(f"'{k}': '{v}'" for k, v in table.items()) + f"}}[{c}]"


def _trim_space(c: str) -> str:
    return f"regexp_replace({c}, '^[\\s\\x{{85}}\\x{{A0}}\\p{{Z}}]+|[\\s\\x{{85}}\\x{{A0}}\\p{{Z}}]+$', '', 'g')"


def _squeeze_sql(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace({c}, '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'), ' ')"


def _tokens_sql(c: str) -> str:
    return f"CASE WHEN {c} = '' THEN [] ELSE string_split({c}, ' ') END"


#: The same steps in SQL, from the table ent to the table norm.
NORM_SQL = f"""
nn0 AS (SELECT *, lower(strip_accents({_trim_space('business_name')})) AS f, {_trim_space('business_name')} AS name_raw, {_trim_space('business_address')} AS addr_raw, {_trim_space('country')} AS country_raw FROM ent),
nn1 AS (SELECT *, regexp_matches(f, '{T.URL_START}') OR regexp_matches(f, '{T.URL_END}') AS name_url,
  addr_raw = '' OR lower(addr_raw) IN ({", ".join(f"'{x}'" for x in T.FIELD_MISSING)}) AS addr_empty,
  country_raw = '' OR lower(country_raw) IN ({", ".join(f"'{x}'" for x in T.FIELD_MISSING)}) AS country_missing FROM nn0),
nn2 AS (SELECT * EXCLUDE (f), regexp_replace(CASE WHEN name_url THEN regexp_replace(regexp_replace(regexp_replace(f, '{T.URL_START}', ' ', 'g'), '{T.URL_END}', ' ', 'g'), '[./_-]', ' ', 'g') ELSE f END, '{T.PHONE}', ' ', 'g') AS f,
  CASE WHEN addr_empty THEN '' ELSE lower(strip_accents(addr_raw)) END AS af, {_squeeze_sql("lower(strip_accents(country_raw))")} AS cf FROM nn1),
nn3 AS (SELECT *, {_squeeze_sql('f')} AS c0, nullif(regexp_extract(af, '{T.POSTAL}', 1), '') AS addr_postal,
  trim(regexp_replace(regexp_replace(regexp_replace(af, '[^a-z0-9\\s]', ' ', 'g'), '{T.ORDINAL}', '\\1', 'g'), '\\s+', ' ', 'g'), ' ') AS addr_clean,
  CASE WHEN country_missing THEN '' ELSE coalesce({_case(T.COUNTRIES, 'cf')}, upper(cf)) END AS country_canonical FROM nn2),
nn4 AS (SELECT *, coalesce(nullif(trim(regexp_replace(c0, '{T.HONORIFIC}', ''), ' '), ''), c0) AS name_clean,
  list_transform({_tokens_sql('addr_clean')}, lambda t: coalesce({_case(T.ADDRESS_WORDS, 't')}, t)) AS aw FROM nn3),
nn5 AS (SELECT *, list_reduce(list_prepend('', regexp_extract_all(name_clean, '{T.LEGAL_PATTERN}', 1)), lambda a, x: CASE WHEN length(x) > length(a) THEN x ELSE a END) AS legal,
  trim(regexp_replace(regexp_replace(name_clean, '{T.LEGAL_PATTERN}', ' ', 'g'), '\\s+', ' ', 'g'), ' ') AS root, array_to_string(aw, ' ') AS addr_canonical,
  list_transform(aw, lambda t: CASE WHEN regexp_full_match(t, '[0-9]{{1,6}}') THEN coalesce(nullif(ltrim(t, '0'), ''), '0') ELSE t END) AS addr_tokens FROM nn4),
nn6 AS (SELECT *, coalesce(nullif(root, ''), name_clean) AS name_canonical, CASE WHEN legal <> '' THEN {_case(T.LEGAL_FORMS, 'legal')} END AS name_suffix,
  list_sort(list_distinct(addr_tokens)) AS addr_sorted FROM nn5),
norm AS (SELECT *, {_tokens_sql('name_canonical')} AS name_tokens, list_sort(list_distinct({_tokens_sql('name_canonical')})) AS name_sorted,
  list_filter(addr_sorted, lambda t: regexp_full_match(t, '[0-9]{{1,6}}')) AS addr_numbers, country_canonical IN ('US', 'INDIA') AS country_seen FROM nn6)"""
