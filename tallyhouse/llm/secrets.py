"""Secrets in texts, with weak candidates reported only where complementary parts of a credential stand near each other.

Three kinds of secret are reported wherever they stand: assignments to a telling name, access identifiers and long
hexadecimal strings. Weak parts say little alone: a long mixed token may be a key, a user or client name may be the identifier
that belongs to it, a URL the endpoint. A weak token is reported when an identifier or endpoint starts within `SCOPE` characters
of it, a weak identifier when a secret or weak token does, an endpoint when both an identifier and a secret do.

Everything is DataFrame functions. Places are found in each row by splitting the text at its matches; only documents with weak
parts go on to the interval join. It is an equi-join on document and bin of `SCOPE` characters, the part's own and its two
neighbours, against one row per bin with the first and last start of each role. Nearest neighbours are all the test needs, so
a bin with many parts costs no pairs.

No pattern is tried again at each place of one run of letters, and places are added up in chunks, so that long texts and texts
with many matches take time about in proportion.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.native import let
from tallyhouse.session import cut_lineage

SCOPE = 400
CHUNK = 256  # matches whose places are added up one after another; chunks are then moved as a whole

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


class Kind(NamedTuple):
    name: str
    pattern: str
    group: int  # group whose length counts, 0 for the whole match
    least: int  # characters that group has at least
    guard: str  # a match contains this; cheaper to look for
    role: str  # identifier, secret or endpoint
    weak: bool
    has: tuple[str, ...] = ()  # the match also has these
    tail: bool = False  # the span is the group, with which the match ends


KINDS = (
    Kind("assign", ASSIGN, 2, 8, r"(?i:passw|secret|token|api_?key)", "secret", False),
    Kind("access", r"AKIA[A-Z0-9]{12,}", 0, 16, "AKIA", "identifier", False),
    Kind("hex", r"[0-9a-f]{32,}", 0, 32, r"[0-9a-f]{32}", "secret", False),
    Kind("weak_token", r"[A-Za-z0-9+/_-]{24,}={0,2}", 0, 24, r"[A-Za-z0-9+/_-]{24}", "secret", True, ("[0-9]", "[A-Z]", "[a-z]")),
    Kind("weak_user", r"(?i:user(?:name|_id)?|login|client_?id|account(?:_?id)?|access_?key_?id)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9@._-]+)", 1, 3, r"(?i:user(?:name|_id)?|login|client_?id|account(?:_?id)?|key_?id)[\"']?\x20*[:=]", "identifier", True),
    # a scheme starts at the first letter of a run of its characters, so other places of the run need no look
    Kind("weak_endpoint", r"(?<![a-z0-9+])[0-9+]*+([a-z][a-z0-9+]*+://[^\x00-\x20\"'<>]+)", 1, 8, "://", "endpoint", True, tail=True),
)
BASE = tuple(k.name for k in KINDS if not k.weak)


def _spans(text: Column, kind: Kind, order: int) -> Column:
    """(start, kind's place in the list, end) of the matches that are long enough, in code points, end exclusive.

    Matches are found first and dropped after, so one that is too short still takes its characters.
    """
    empty = F.expr("cast(array() as array<struct<start: int, kind: int, end: int>>)")
    pattern = F.lit(kind.pattern)
    counted = F.regexp_extract_all(text, pattern, F.lit(kind.group))
    # a gap before each match, and one after the last
    rows = F.arrays_zip(
        F.split(text, kind.pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"), counted.alias("part"),
    )

    def step(s: Column, r: Column) -> Column:
        begin = s["at"] + F.length(r["gap"])
        end = begin + F.coalesce(F.length(r["match"]), F.lit(0))
        first = end - F.length(r["part"]) if kind.tail else begin
        span = F.struct(first.alias("start"), F.lit(order).alias("kind"), end.alias("end"))
        good = F.coalesce(F.length(r["part"]), F.lit(0)) >= kind.least
        for pattern in kind.has:
            good = good & r["match"].rlike(pattern)
        found = F.when(good, F.concat(s["found"], F.array(span))).otherwise(s["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    def chunks(r: Column) -> Column:
        """Spans of each chunk, counted from where it begins, and its length."""
        begin = F.struct(F.lit(0).alias("at"), empty.alias("found"))
        return F.transform(F.sequence(F.lit(1), F.size(r), F.lit(CHUNK)), lambda i: F.aggregate(F.slice(r, i, F.lit(CHUNK)), begin, step))

    def moved(c: Column) -> Column:
        begins = F.aggregate(c, F.array(F.lit(0)), lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x["at"])))

        def move(x: Column, at: Column) -> Column:
            return F.transform(x["found"], lambda f: F.struct((f["start"] + at).alias("start"), f["kind"].alias("kind"), (f["end"] + at).alias("end")))

        return let(begins, lambda at: F.flatten(F.transform(c, lambda x, i: move(x, F.get(at, i)))))

    return F.when(text.rlike(kind.guard), let(rows, lambda r: let(chunks(r), moved))).otherwise(empty)


def find_parts(docs: DataFrame) -> DataFrame:
    """doc_id, a key of the row's content, base spans and weak spans."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = [(i, k) for i, k in enumerate(KINDS)]
    found = docs.select(
        F.col("doc_id"),
        F.xxhash64("doc_id", text).alias("key_high"),
        F.hash("doc_id", text).alias("key_low"),
        let(text, lambda t: F.struct(
            F.array_sort(F.concat(*[_spans(t, k, i) for i, k in own if not k.weak])).alias("base"),
            F.array_sort(F.concat(*[_spans(t, k, i) for i, k in own if k.weak])).alias("weak"),
        )).alias("s"),
    )
    return found.select("doc_id", "key_high", "key_low", "s.base", "s.weak")


def link(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak spans that are reported: key_high, key_low and `linked`, one row per document with any.

    Those that overlap a base span are no parts: one that starts before the end of an earlier base span, or ends after the start
    of a later one. Both are running extremes over a document's spans in order.
    """
    key = ["key_high", "key_low"]
    role = {r: [i for i, k in enumerate(KINDS) if k.role == r] for r in ("identifier", "secret", "endpoint")}
    is_base = F.col("kind") < len(BASE)
    order = Window.partitionBy(*key)
    before = order.orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = order.orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    apart = F.coalesce(F.col("reach") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("next") >= F.col("end"), F.lit(True))
    each = (
        parts.filter(F.size("weak") > 0)
        .dropDuplicates(key)  # equal rows have equal parts
        .select(*key, F.inline(F.concat("base", "weak")))
        .withColumn("reach", F.max(F.when(is_base, F.col("end"))).over(before))
        .withColumn("next", F.min(F.when(is_base, F.col("start"))).over(after))
        .filter(is_base | apart)
        .select(*key, "start", "kind", "end", F.floor(F.col("start") / scope).cast("int").alias("bin"))
    )
    ends = []
    for name, kinds in role.items():
        at = F.when(F.col("kind").isin(kinds), F.col("start"))
        ends += [F.min(at).alias(f"first_{name}"), F.max(at).alias(f"last_{name}")]
    bins = each.groupBy(*key, "bin").agg(*ends)
    weak = [i for i, k in enumerate(KINDS) if k.weak]
    seen = each.filter(F.col("kind").isin(weak)).withColumn("side", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).withColumn("bin", F.col("bin") + F.col("side"))

    def near(name: str) -> Column:
        # in the own bin any part is near; the nearest of the bin before is its last, of the bin after its first
        return (
            F.when(F.col("side") == 0, F.col(f"first_{name}").isNotNull())
            .when(F.col("side") < 0, F.col("start") - F.col(f"last_{name}") <= scope)
            .otherwise(F.col(f"first_{name}") - F.col("start") <= scope)
        )

    joined = seen.join(bins, [*key, "bin"]).groupBy(*key, "start", "kind", "end").agg(*[F.max(F.coalesce(near(n), F.lit(False))).alias(n) for n in role])
    kept = F.lit(False)
    for i, k in enumerate(KINDS):
        if k.weak:
            others = {"secret": F.col("identifier") | F.col("endpoint"), "identifier": F.col("secret"), "endpoint": F.col("identifier") & F.col("secret")}
            kept = kept | ((F.col("kind") == i) & others[k.role])
    return joined.filter(kept).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("linked"))


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, `base` and `spans` as arrays of (start, kind, end), spans being base and linked ones in order.

    A null text is empty and has no secrets; a match that ends at the end of the text counts like any other; ties in start are
    ordered by kind. Equal rows get equal results each. Columns but doc_id and text are not read.
    """
    parts = cut_lineage(find_parts(docs), "secret-parts")  # else the texts are searched twice
    return parts.join(link(parts, scope), ["key_high", "key_low"], "left").select(
        "doc_id", "base", F.array_sort(F.concat("base", F.coalesce("linked", F.slice("base", 1, 0)))).alias("spans")
    )


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(i).alias(f"n_{n}") for i, n in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
