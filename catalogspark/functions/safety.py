"""Policies on public text, keys and addresses, as flag columns (our own rule sets; all are parameters)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogspark.functions.canon import as_col
from catalogspark.functions.text import bind
from catalogspark.scale import explode_rows

#: Patterns without look-around, so that any SQL engine can state the same rule.
CONTACT_PATTERNS: dict[str, str] = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "messenger": r"(?i)(?:signal|skype|telegram|viber|wechat|whatsapp|qq|line id)\s*(?:[:：@]|is|id)\s*[:：@]?\s*[a-z0-9+][\w.+-]{3,}",
    "handle_label": r"(?i)(?:call|cell|contact|fax|mobile|phone|tel|text)(?: us| me| no\.?| number)?\s*[:：]\s*[+(\w]",
}
#: Numeric patterns, waived for identifiers that may be long numbers.
NUMERIC_PATTERNS: dict[str, str] = {
    "phone": r"(?:^|[^0-9])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?:[^0-9]|$)",
    "long_number": r"\d{10,}",
}
#: Kinds of personal data by the words that name them in keys (general privacy categories; callers pass their own).
PERSONAL_KEY_WORDS: dict[str, tuple[str, ...]] = {
    "identity": ("birth", "passport", "first_?name", "last_?name", "surname", "user_?id", "user_?name"),
    "contact": ("e_?mail", "fax", "phone", "postal", "street"),
    "money": ("account_?number", "card_?number", "iban", "tax_?id"),
    "access": ("password", "secret", "session", "token"),
}
FORBIDDEN_KEY = "(?i)" + "|".join(w for words in PERSONAL_KEY_WORDS.values() for w in words)

UNSAFE_TEXT: dict[str, str] = {
    "control": r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]",
    "markup": r"<[/!?A-Za-z][^>]*>",
    "address": r"(?i)(?:https?://|www\.|(?:^|[^A-Za-z0-9@._-])[a-z0-9](?:[a-z0-9-]*[a-z0-9])?\.(?:com|net|org|info|shop|cn|ru|de|io)(?:[^A-Za-z0-9._-]|$))",
    "boilerplate": r"(?i)(?:all rights reserved|copyright|licensed under|terms of use|licen[cs]e)",
}


#: A cheap condition without which the pattern cannot match; tested first.
NEEDS: dict[str, str] = {"email": "@", "handle_label": "[:：]", "phone": r"\d[ .-]\d{4}"}


def contact_flags(value: Column | str, opaque_identifier: bool = False) -> dict[str, Column]:
    """One boolean per contact pattern; numeric ones are left out for opaque identifiers."""
    col = as_col(value)
    rules = dict(CONTACT_PATTERNS) if opaque_identifier else {**CONTACT_PATTERNS, **NUMERIC_PATTERNS}
    return {n: (col.rlike(NEEDS[n]) & col.rlike(p)) if n in NEEDS else col.rlike(p) for n, p in rules.items()}


def has_contact(value: Column | str, opaque_identifier: bool = False) -> Column:
    """True when any contact pattern occurs."""
    found = F.lit(False)
    for flag in contact_flags(value, opaque_identifier).values():
        found = found | flag
    return found


def unsafe_text_flags(value: Column | str, max_length: int | None = None) -> dict[str, Column]:
    """One boolean per reason a description is not taken over; length is one only where the caller sets a limit."""
    col = as_col(value)
    flags = {name: col.rlike(pattern) for name, pattern in UNSAFE_TEXT.items()}
    if max_length is not None:
        flags["too_long"] = F.length(col) > max_length
    return flags


def safe_text(value: Column | str) -> Column:
    """The text, of any length, or NULL when any unsafe-text rule applies."""
    bad = F.lit(False)
    for flag in unsafe_text_flags(value).values():
        bad = bad | flag
    return F.when(~bad & (F.trim(as_col(value)) != ""), F.trim(as_col(value)))


def forbidden_fields(schema: T.StructType, pattern: str = FORBIDDEN_KEY, prefix: str = "") -> list[str]:
    """Paths of schema fields whose name is sensitive (keys live in the schema, not in the rows)."""
    import re

    found: list[str] = []
    for field in schema.fields:
        path = f"{prefix}{field.name}"
        if re.search(pattern, field.name):
            found.append(path)
        kind = field.dataType
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if isinstance(kind, T.StructType):
            found += forbidden_fields(kind, pattern, f"{path}.")
    return found


def forbidden_map_keys(df: DataFrame, key: str, payload: str, pattern: str = FORBIDDEN_KEY) -> DataFrame:
    """Sensitive keys inside an open map column, one row per (row key, map key)."""
    return explode_rows(df, [key], F.map_keys(payload), "name").where(F.col("name").rlike(pattern))


def url_parts(value: Column | str) -> Column:
    """``struct(protocol, host, path, query, ref, userinfo, authority, size)``; NULL parts for an address that does not parse."""
    col = as_col(value)
    part = lambda p: F.try_parse_url(col, F.lit(p)).alias(p.lower())
    return F.struct(*[part(p) for p in ("PROTOCOL", "HOST", "PATH", "QUERY", "REF", "USERINFO", "AUTHORITY")], F.length(col).alias("size"))


def url_policy(
    value: Column | str, hosts: Sequence[str] = (), suffixes: Sequence[str] = (), prefix: str = "/",
    query_rules: Mapping[str, str] | None = None, max_length: int = 2048,
) -> Column:
    """First broken rule of an address policy, or NULL: https, allowed host, path, query keys, nothing else.

    A host is allowed by exact name or by suffix. Every query key must be known, occur once, and match
    its value pattern.
    """
    rules = query_rules or {}

    def judge(u: Column) -> Column:
        host = F.lower(u["host"])
        allowed = host.isin(*hosts) if hosts else F.lit(False)
        for suffix in suffixes:
            allowed = allowed | (host == suffix) | host.endswith("." + suffix)
        pairs = F.split(F.coalesce(u["query"], F.lit("")), "&")
        names = F.transform(pairs, lambda p: F.substring_index(p, "=", 1))
        has_query = F.coalesce(u["query"], F.lit("")) != ""
        return (
            F.when(u["host"].isNull(), "invalid")
            .when(u["size"] > max_length, "too-long")
            .when(u["protocol"] != "https", "not-https")
            .when(u["userinfo"].isNotNull() | (u["authority"] != u["host"]), "credentials-or-port")
            .when(u["ref"].isNotNull(), "fragment")
            .when(~allowed, "host")
            .when(~F.coalesce(u["path"], F.lit("")).startswith(prefix), "path")
            .when(has_query & F.exists(pairs, lambda p: ~_pair_known(p, rules)), "query-key")
            .when(has_query & (F.size(F.array_distinct(names)) < F.size(names)), "query-repeat")
        )

    return bind(url_parts(value), judge)


def _pair_known(pair: Column, rules: Mapping[str, str]) -> Column:
    name, value = F.substring_index(pair, "=", 1), F.regexp_replace(pair, "^[^=]*=?", "")
    ok = F.lit(False)
    for key, pattern in rules.items():
        ok = ok | ((name == key) & value.rlike(pattern))
    return ok
