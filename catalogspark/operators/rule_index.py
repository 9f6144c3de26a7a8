"""Rule books that are tables: phrases found through their rarest word, address rules through prefixes and word parts.

No rule is part of an expression, so a book may have any number of rows and is never brought to the driver. Both
operators turn "every text against every rule" into equi-joins that propose few pairs, and test those pairs exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.functions.canon import as_col
from catalogspark.scale import explode_rows, pinned, with_scalars

#: Everything in ASCII that is no letter and no digit separates words; case is folded in ASCII only.
SEPARATORS = r"[\x00-/:-@\[-`{-\x7F]+"
#: Characters of the word part by which an address rule with wildcards is looked up.
GRAM = 4


def plain_words(text: Column | str) -> Column:
    """The words of a text, lower-cased, with one blank before, between and after them; one blank if there are none."""
    text = F.coalesce(as_col(text), F.lit(""))
    # of ASCII alone, lower is the same and needs no look-up per character
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(low, SEPARATORS, " ")), F.lit(" "))


def _words(plain: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.trim(plain), " "), lambda w: w != ""))


def phrase_labels(texts: DataFrame, key: str, text: str, rules: DataFrame, code: str = "code", phrase: str = "phrase", requires: str | None = None) -> DataFrame:
    """``key, code`` for every text that holds a phrase of the rule as whole words in a row, each pair once.

    Rules are rows; a code may have several phrases, and a rule may require that another code applies to the text (that
    code's own requirement is not asked). A rule is indexed under the word that the fewest texts hold; a rule with a word
    that no text holds is out at once. Only texts with a candidate of several words are read a second time.
    """
    gate = F.col(requires) if requires else F.lit(None)
    book = rules.select(F.col(code).alias("_code"), F.trim(plain_words(phrase)).alias("_phrase"), gate.cast("string").alias("_needs")).where("_phrase <> ''").distinct()
    spelled = explode_rows(book, ["_code", "_phrase", "_needs"], _words(F.col("_phrase")), "_word")
    held = explode_rows(texts, [F.col(key).alias("_key")], _words(plain_words(text)), "_word")
    held = pinned(held.join(spelled.select("_word").distinct(), "_word", "left_semi"))  # used twice; words of the book only
    texts_with = held.groupBy("_word").agg(F.count(F.lit(1)).alias("_n"))
    ranked = spelled.join(texts_with, "_word", "left").groupBy("_code", "_phrase", "_needs").agg(
        F.min(F.struct("_n", "_word")).alias("_rare"), F.bool_or(F.col("_n").isNull()).alias("_lost"))
    index = ranked.where(~F.col("_lost")).select(F.col("_rare._word").alias("_word"), "_code", "_phrase", "_needs")
    proposed = held.join(index, "_word").select("_key", "_code", "_phrase", "_needs")
    several = F.col("_phrase").contains(" ")
    read = texts.select(F.col(key).alias("_key"), plain_words(text).alias("_plain"))
    tested = proposed.where(several).join(read, "_key").where(F.col("_plain").contains(F.concat(F.lit(" "), F.col("_phrase"), F.lit(" "))))
    hits = tested.select("_key", "_code", "_needs").unionByName(proposed.where(~several).select("_key", "_code", "_needs"))
    if requires:
        given = hits.select(F.col("_key").alias("_k"), F.col("_code").cast("string").alias("_c")).distinct()
        met = hits.where("_needs is not null").join(given, (F.col("_key") == F.col("_k")) & (F.col("_needs") == F.col("_c")), "left_semi")
        hits = hits.where("_needs is null").unionByName(met)
    return hits.select(F.col("_key").alias(key), F.col("_code").alias(code)).distinct()


def _quoted(literal: Column) -> Column:
    return F.regexp_replace(literal, r"([\\^$.|?+()\[\]{}])", r"\\$1")


def _parts_of(text: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - (n - 1))), lambda i: F.substr(text, i, F.lit(n)))


def longest_rule(paths: DataFrame, path: str, rules: DataFrame, pattern: str = "pattern", allow: str = "allow") -> DataFrame:
    """All columns of ``paths`` with ``allowed`` and ``matched`` (length of the deciding pattern, NULL without one).

    The pattern with the most literal characters decides, allow wins ties, no match is deny. ``*`` stands for anything, a
    final ``$`` for the end. A path is exploded into its prefixes (only lengths that occur among the rules) and, for rules
    whose longest literal is not at the front, into its parts of up to ``GRAM`` characters; each meets the rules in one
    equi-join, wildcards are then tested by the rule's own expression. Rules without any literal are one total.
    """
    body = F.regexp_replace(F.col(pattern), r"\$$", "")
    book = rules.where(F.col(pattern).isNotNull()).select(
        body.alias("_body"), F.col(pattern).endswith("$").alias("_end"), F.col(allow).cast("boolean").alias("_allow"), F.split(body, r"\*").alias("_parts"))
    literal = F.reduce("_parts", F.lit(""), lambda best, p: F.when(F.length(p) > F.length(best), p).otherwise(best))  # the first of the longest
    book = book.select("*", F.length(F.replace("_body", F.lit("*"), F.lit(""))).alias("_len"), (F.size("_parts") > 1).alias("_wild"), literal.alias("_lit"))
    regex = F.concat(F.lit("(?s)^"), F.array_join(F.transform("_parts", _quoted), ".*"), F.when(F.col("_end"), "$").otherwise(""))
    book = book.select("*", (F.col("_wild") | F.col("_end")).alias("_test"), regex.alias("_regex"), (F.get("_parts", F.lit(0)) == F.col("_lit")).alias("_front"))
    book = book.groupBy("_lit", "_front", "_len", "_test", F.when(F.col("_test"), F.col("_regex")).alias("_regex")).agg(F.bool_or("_allow").alias("_allow"))
    none = book.where("_len = 0 and not (_test and _regex = '(?s)^$')").agg(F.bool_or("_allow").alias("_any"))
    some = book.where("_len > 0")
    gram = F.substring("_lit", 1, GRAM)
    keyed = some.select("*", F.when(F.col("_front"), F.col("_lit")).otherwise(gram).alias("_key"))
    sizes = [(r["_front"], r["n"]) for r in keyed.select("_front", F.length("_key").alias("n")).distinct().collect()]  # at most the longest pattern and GRAM
    p = F.col("_path")
    fronts = [F.when(F.length(p) >= n, F.substring(p, 1, n)) for front, n in sorted(sizes) if front]
    seen = paths.select(F.col(path).alias("_path")).where("_path is not null").distinct()
    keys = F.array_compact(F.array(*fronts)) if fronts else F.array().cast("array<string>")
    asked = explode_rows(seen, ["_path", F.lit(True).alias("_front")], keys, "_key")
    grams = [n for front, n in sorted(sizes) if not front]
    if grams:
        parts = F.flatten(F.array(*[_parts_of(p, n) for n in grams]))
        asked = asked.unionByName(explode_rows(seen, ["_path", F.lit(False).alias("_front")], F.array_distinct(parts), "_key"))
    met = asked.join(keyed, ["_front", "_key"]).where(~F.col("_test") | F.expr("_path rlike _regex"))
    best = met.groupBy("_path").agg(F.max(F.struct("_len", "_allow")).alias("_best"))
    out = with_scalars(paths.join(best, F.col(path) == F.col("_path"), "left"), none)
    matched = F.coalesce(F.col("_best._len"), F.when(F.col("_any").isNotNull() & F.col(path).isNotNull(), 0))
    allowed = F.coalesce(F.col("_best._allow"), F.when(F.col(path).isNotNull(), F.col("_any")), F.lit(False))
    return out.select(*[paths[c] for c in paths.columns], allowed.alias("allowed"), matched.cast("int").alias("matched"))
