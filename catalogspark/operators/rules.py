"""Rule books over text: multi-label matching, gates, contrast, evidence, longest match, value mapping.

A rule book is a fixed list in the program (or a table proven small and read into one), so rules become
column expressions: one scan of the texts, no join, no pairs of texts and rules are ever materialised.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.functions.canon import as_col
from catalogspark.functions.text import bind, word
from catalogspark.scale import literal_table


@dataclass(frozen=True)
class Rule:
    """``code`` applies when any pattern matches or any word occurs, and the gate rule (if any) applies too.

    ``words`` are single ASCII words (anything else is refused). The words of a text are split once for all rules, so
    that a book of any length costs one pass over the text; everything else is a pattern.
    """

    code: str
    patterns: tuple[str, ...] = ()
    requires: str | None = None
    words: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        odd = [w for w in self.words if not re.fullmatch("[A-Za-z0-9_]+", w)]
        if odd:
            raise ValueError(f"rule {self.code}: not single ASCII words: {odd}")


def rules_from_table(df: DataFrame, max_rules: int) -> list[Rule]:
    """A rule table ``(rule_order, code, pattern, requires)`` as a rule book of at most ``max_rules`` rows.

    The caller states how many rules its program can hold; a larger table is an error, never cut.
    """
    rows = df.orderBy("rule_order").limit(max_rules + 1).collect()
    if len(rows) > max_rules:
        raise ValueError(f"more than {max_rules} rules")
    book: dict[str, list] = {}
    for r in rows:
        book.setdefault(r.code, [r.requires, []])[1].append(r.pattern)
    return [Rule(code, tuple(p), requires) for code, (requires, p) in book.items()]


def book_words(text: Column, book: Sequence[Rule]) -> Column:
    """The different words of the book that occur in a text: few, however long the text; case kept."""
    words = sorted({w for rule in book for w in rule.words})
    if not words:
        return F.array().cast("array<string>")
    return F.array_intersect(F.split(text, "[^A-Za-z0-9_]+"), F.array(*[F.lit(w) for w in words]))


def _hit(text: Column, words: Column, rule: Rule) -> Column:
    hit = F.arrays_overlap(words, F.array(*[F.lit(w) for w in rule.words])) if rule.words else F.lit(False)
    return hit | text.rlike("|".join(f"(?:{p})" for p in rule.patterns)) if rule.patterns else hit


def labels(text: Column | str, book: Sequence[Rule]) -> Column:
    """Array of the codes that apply, in rule order, each once. Every rule is evaluated once per text."""
    at = {rule.code: i for i, rule in enumerate(book)}
    text = as_col(text)

    def applied(hits: Column) -> Column:
        gate = lambda r: hits[at[r.code]] & hits[at[r.requires]] if r.requires else hits[at[r.code]]
        return F.array_distinct(F.array_compact(F.array(*[F.when(gate(r), r.code) for r in book])))

    return bind(book_words(text, book), lambda w: bind(F.array(*[_hit(text, w, r) for r in book]), applied))


def strip_contrast(text: Column | str, phrases: Sequence[str]) -> Column:
    """Text before the first contrast phrase, so that what a thing is *not* does not label it."""
    return F.trim(F.get(F.split(as_col(text), word("|".join(phrases)), 2), F.lit(0)))


def first_sentence(text: Column | str) -> Column:
    """Text up to the first sentence end that is followed by white space."""
    return F.get(F.split(as_col(text), r"(?<=[.!?])\s+", 2), F.lit(0))


def explicit_or_mention(text: Column | str, names: Sequence[str], marker: str) -> Column:
    """``struct(value, evidence, ambiguous)``: exactly one "name marker" wins, else exactly one bare name."""
    def judge(head: Column) -> Column:
        strong = F.array_compact(F.array(*[F.when(head.rlike(word(rf"{n}\s+{marker}")), n) for n in names]))
        weak = F.array_compact(F.array(*[F.when(head.rlike(word(n)), n) for n in names]))
        return bind(F.struct(strong.alias("strong"), weak.alias("weak")), _evidence)

    return bind(first_sentence(text), judge)


def _evidence(found: Column) -> Column:
    strong, weak = found["strong"], found["weak"]
    pool = F.when(F.size(strong) > 0, strong).otherwise(weak)
    return F.struct(
        F.when(F.size(pool) == 1, F.get(pool, F.lit(0))).alias("value"),
        F.when(F.size(strong) > 0, "explicit").when(F.size(weak) > 0, "mention").alias("evidence"),
        F.when(F.size(pool) > 1, F.array_join(pool, ",")).alias("ambiguous"),
    )


def structured_first(structured: Column, inferred: Column) -> Column:
    """A given value beats an inferred one; blank counts as not given."""
    return F.coalesce(F.when(F.trim(structured) != "", F.trim(structured)), inferred)


def cross_facets(left: Column, right: Column, pairs: Mapping[tuple[str, str], Sequence[str]]) -> Column:
    """Codes that follow from two facets together."""
    parts = [F.when((left == a) & (right == b), F.array(*[F.lit(c) for c in codes])) for (a, b), codes in pairs.items()]
    return F.flatten(F.array_compact(F.array(*parts)))


def map_values(df: DataFrame, key: str, value: str, mapping: Mapping[str, str], parent: str | None = None) -> DataFrame:
    """Fixed value→code mapping. Unmapped values warn, and fall to the parent code if one is given."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    code = F.element_at(F.create_map(*pairs), F.col(value))
    given = F.col(value).isNotNull() & (F.col(value) != "")
    return df.where(given).select(
        key,
        F.coalesce(code, F.lit(parent)).alias("code"),
        F.when(code.isNull(), F.concat(F.lit("no mapping for "), F.col(value))).alias("warning"),
    )


def observed_nodes(declared: Sequence[tuple[str, str, str | None]], observed: DataFrame, value: str) -> DataFrame:
    """Declared taxonomy nodes ``(value, code, parent)`` that occur in the data, in declared order."""
    nodes = literal_table(
        observed.sparkSession, ["declared_order", "value", "code", "parent"],
        [(i + 1, v, c, p or "") for i, (v, c, p) in enumerate(declared)],
    )
    seen = observed.groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("uses"))
    return F.broadcast(nodes).join(seen, "value", "inner").select("declared_order", "code", "parent", "uses")


def longest_match(path: Column | str, rules: Sequence[tuple[str, bool]]) -> Column:
    """Allow / deny by the longest matching pattern; allow wins ties; no match is deny.

    ``*`` matches anything, a final ``$`` anchors. Rules are tried from the longest, so the first hit decides.
    """
    ranked = sorted(rules, key=lambda r: (-len(r[0].rstrip("$").replace("*", "")), not r[1]))
    verdict = None
    for pattern, allow in ranked:
        body, end = (pattern[:-1], "$") if pattern.endswith("$") else (pattern, "")
        regex = "^" + ".*".join(_quote(p) for p in body.split("*")) + end
        hit = as_col(path).rlike(regex)
        verdict = F.when(hit, F.lit(allow)) if verdict is None else verdict.when(hit, F.lit(allow))
    return verdict.otherwise(F.lit(False)) if verdict is not None else F.lit(False)


def rules_for_agent(groups: Sequence[tuple[Sequence[str], Sequence[tuple[str, bool]]]], agent: str) -> list[tuple[str, bool]]:
    """Rules of the most specific agent groups (longest prefix of the agent name), else of ``*``."""
    name = agent.lower()
    best = max((len(a) for agents, _ in groups for a in agents if a != "*" and name.startswith(a)), default=0)
    picked = [r for agents, rules in groups for r in rules
              if any((len(a) == best and name.startswith(a)) if best else a == "*" for a in agents)]
    return picked


def _quote(text: str) -> str:
    return "".join("\\" + c if c in r"\^$.*+?()[]{}|" else c for c in text)


def unique_definition(definitions: DataFrame, label: str, wanted: str) -> DataFrame:
    """Discovery by label: 0 hits → absent, 1 → use its code, more → ambiguous. One row."""
    hits = definitions.where(F.lower(F.trim(F.col(label))) == wanted.lower())
    return hits.agg(F.count(F.lit(1)).alias("hits"), F.min("code").alias("first_code")).select(
        "hits",
        F.when(F.col("hits") == 0, "absent").when(F.col("hits") == 1, "use").otherwise("ambiguous").alias("verdict"),
        F.when(F.col("hits") == 1, F.col("first_code")).alias("code"),
    )


def prefix_managed(attribute: Column | str, group: Column | str, prefix: str) -> Column:
    """Rows we own: attribute with our prefix, or group with our group prefix."""
    a, g = F.upper(F.trim(as_col(attribute))), F.upper(F.trim(as_col(group)))
    return F.coalesce(a.startswith(prefix), F.lit(False)) | F.coalesce(g.startswith(prefix + "GROUP-"), F.lit(False))


def junk_code(code: Column | str, prefixes: Sequence[str], exact: Sequence[str], patterns: Sequence[str]) -> Column:
    """Left-over codes: by prefix, exact value or pattern."""
    col = F.trim(as_col(code))
    hit = col.isin(*exact) if exact else F.lit(False)
    for p in prefixes:
        hit = hit | col.startswith(p)
    for p in patterns:
        hit = hit | col.rlike(p)
    return hit


def unique_lookup(df: DataFrame, keys: Sequence[str], dictionary: DataFrame, code: str) -> DataFrame:
    """Dictionary value only when exactly one entry matches; else NULL with a warning.

    The dictionary is reduced to one row per key before the join, so rows are never multiplied.
    """
    single = dictionary.groupBy(*keys).agg(F.count(F.lit(1)).alias("_hits"), F.min(code).alias("_code"))
    return df.join(single, list(keys), "left").select(
        *df.columns,
        F.when(F.col("_hits") == 1, F.col("_code")).alias(code),
        F.when(F.col("_hits").isNull(), "not-found").when(F.col("_hits") > 1, "ambiguous").alias("warning"),
    )
