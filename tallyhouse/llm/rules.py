"""Quality rules as a ledger of bits: every rule is evaluated once, policies are masks over the stored bits.

`ledger` gives each document its measurements and one integer whose bit k says that rule k fails. A policy is a version with the
rules it applies, so a new version, or one rule less, needs no second look at the texts: `apply_policy` is one bitwise AND, and
`ablations` counts, from the number of documents per pattern of bits, what each rule removes alone and on top of the others.
Everything is DataFrame functions, row by row without an exchange but for the counts, which are added up before they are
exchanged (at most one row per pattern and task).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.native import let, words_of


class Rule(NamedTuple):
    name: str
    fails: Column


def rules() -> list[Rule]:
    """The rules in the order of their bits; a rule keeps its place for ever, new ones come last."""
    words, chars = F.col("n_words"), F.col("word_chars")
    return [
        Rule("few_words", words < 50),
        Rule("repeated_words", 100 * F.col("n_repeat_words") > 50 * words),
        Rule("many_symbols", 100 * F.col("n_symbols") > 40 * words),
        Rule("repeated_lines", 100 * F.col("n_dup_lines") > 50 * F.col("n_lines")),
        Rule("shouting", 100 * F.col("n_capitals") > 40 * chars),
        Rule("long_words", chars > 40 * words),
        Rule("short_words", chars < 2 * words),
        Rule("repeated_sequences", 100 * F.col("n_repeat_words") > 20 * words),
    ]


# Versions of the policy: the rules each applies. Version 1 is the base; the last rule above is measured but not yet applied.
POLICIES = {
    1: ("few_words", "repeated_words"),
    2: ("few_words", "repeated_words", "many_symbols", "repeated_lines", "shouting", "long_words", "short_words"),
}
CURRENT = 2


def mask_of(names: tuple[str, ...]) -> int:
    known = [r.name for r in rules()]
    return sum(1 << known.index(n) for n in names)


def _repeat_words(words: Column, n: Column) -> Column:
    """Words inside a window of 3 words that the text has twice or more.

    Windows are hashed; hash and place share one 64-bit integer, whose sort brings equal hashes together. Only windows whose
    hash repeats are then compared as text, so that the count is exact and long texts cost n log n.
    """

    def repeats(sorted_keys: Column, same) -> Column:
        return F.filter(sorted_keys, lambda x, i: F.coalesce(same(x, F.get(sorted_keys, i + 1)), F.lit(False)) | F.coalesce(same(x, F.get(sorted_keys, i - 1)), F.lit(False)))

    def count(low: Column) -> Column:
        high = F.bitwise_not(low)
        keys = F.transform(F.slice(words, F.lit(1), n - 2), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(high).bitwiseOR(i.cast("long")))
        hashed = let(F.sort_array(keys), lambda s: repeats(s, lambda a, b: a.bitwiseAND(high) == b.bitwiseAND(high)))
        texts = F.transform(
            F.transform(hashed, lambda x: x.bitwiseAND(low).cast("int")),
            lambda p: F.struct(F.concat_ws(" ", F.get(words, p), F.get(words, p + 1), F.get(words, p + 2)).alias("t"), p.alias("p")),
        )
        exact = let(F.sort_array(texts), lambda s: repeats(s, lambda a, b: a["t"] == b["t"]))
        places = F.sort_array(F.transform(exact, lambda x: x["p"]))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        return F.aggregate(places, start, lambda s, p: F.struct((s["n"] + 3 - F.greatest(s["end"] - p, F.lit(0))).alias("n"), (p + 3).alias("end")), lambda s: s["n"])

    # as many low bits as the places need
    return F.when(n < 4, F.lit(0).cast("long")).otherwise(let(F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(n))) - 1, count))


def _measured(words: Column, text: Column) -> Column:
    n = F.when(F.get(words, F.lit(0)) == "", 0).otherwise(F.size(words))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    return let(
        n,
        lambda n: F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            _repeat_words(words, n).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.length(text) - F.length(F.regexp_replace(text, r"[A-Z]+", ""))).cast("long").alias("n_capitals"),
        ),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, measurements, and `failed`, an integer whose bit k says that rule k fails.

    Words are what stands between ASCII white space; a null text is empty: no words, all counts 0, and only rules that hold
    for nothing fail. Rows with the same id are measured each for itself. Columns but doc_id and text are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    measured = docs.select(F.col("doc_id"), let(text, lambda t: let(words_of(t), lambda w: _measured(w, t))).alias("m")).select("doc_id", "m.*")
    bits = None
    for k, rule in enumerate(rules()):
        bit = F.when(rule.fails, F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long"))
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return measured.withColumn("failed", bits)


def apply_policy(ledger: DataFrame, version: int = CURRENT) -> DataFrame:
    """Adds `kept`: none of the policy's rules fails."""
    return ledger.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask_of(POLICIES[version]))) == 0)


def ablations(ledger: DataFrame, version: int = CURRENT) -> DataFrame:
    """For each rule of a policy: documents it fails, those that only it removes, and those kept without it.

    Documents are counted per pattern of bits first; the rest is arithmetic on at most 2^rules rows.
    """
    mask = mask_of(POLICIES[version])
    patterns = ledger.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    known = [r.name for r in rules()]
    each = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << known.index(n)).cast("long").alias("bit")) for n in POLICIES[version]])
    rows = patterns.select("bits", "n", F.inline(each))
    bit = F.col("bit")
    return rows.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(bit) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == bit, F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(bit)) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
    )
