"""Secrets in texts, found and linked with DataFrame functions only.

Strong candidates speak for themselves: assignments to secret names, access identifiers, long hexadecimal runs. Weak
ones are common in clean text: named identifiers, endpoints, bare high-entropy words, short assigned values. They
are reported only where the parts of a credential come together: an interval join of identifiers, secrets and
endpoints within a scope.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .arrow import unused

IDENTIFIER, SECRET, ENDPOINT = "identifier", "secret", "endpoint"


@dataclass(frozen=True)
class Kind:
    """A pattern whose matches, leftmost and not overlapping, are spans if they are long enough."""

    name: str
    pattern: str
    part: str
    weak: bool
    least: int = 0
    most: int = 1 << 30
    group: int = 0  # whose length counts


_ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
#: In the order in which spans of the same start are listed. A run is found whole, so the least length of the
#: access and hex kinds can be part of their patterns.
KINDS = [
    Kind("assign", _ASSIGN, SECRET, False, least=12, group=2),
    Kind("access", r"AKIA[A-Z0-9]{14,}", IDENTIFIER, False),
    Kind("hex", r"[0-9a-f]{16,}", SECRET, False),
    Kind("endpoint", r"""https?://[A-Za-z0-9][A-Za-z0-9.-]*(?::[0-9]{1,5})?(?:/[^\s"'<>]*)?""", ENDPOINT, True),
    Kind("identifier", r"""(?i:access_?key_?id|access_?key|client_?id|account_?id|user_?name|user|login)["']?\x20*"""
                       r"""[:=]\x20*["']?[A-Za-z0-9@._+-]{3,}""", IDENTIFIER, True),
    Kind("short_assign", _ASSIGN, SECRET, True, least=6, most=11, group=2),
    Kind("bare_secret", r"(?<![A-Za-z0-9+/_=-])(?=[A-Z0-9+/_-]*+[a-z])(?=[a-z0-9+/_-]*+[A-Z])"
                        r"(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{20,}={0,2}", SECRET, True),
]
STRONG = [k for k in KINDS if not k.weak]
#: Hexadecimal runs of ordinary numbers are spans, but no part of a credential.
HEX_PART = 32
#: A scope is a paragraph; parts belong together if they start within so many characters.
REACH = 300
PARAGRAPH_END = r"\n[\x20\t\r]*\n"
MASK = "[SECRET]"
_SPANS = "array<struct<start:int,stop:int,place:int>>"
_BLOCK = 512


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used and inside whatever function."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _positions(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (start, stop, n) of all matches, in code points; n is the length of the group.

    What lies between the matches is what splitting leaves, so positions are running sums of lengths. They are
    summed in blocks, which keeps the copying of growing arrays small in texts with very many matches.
    """
    def steps(s, x):
        start = s["at"] + x["gap"]
        return F.struct((start + x["size"]).alias("at"), F.concat(s["out"], F.array(F.struct(
            start.alias("start"), (start + x["size"]).alias("stop"), x["n"].alias("n")))).alias("out"))

    def blocks(s, block):
        none = F.array().cast("array<struct<start:int,stop:int,n:int>>")
        return _bound(F.aggregate(block, F.struct(s["at"].alias("at"), none.alias("out")), steps), lambda inner: F.struct(
            inner["at"].alias("at"), F.concat(s["out"], F.array(inner["out"])).alias("out")))

    def summed(matches):
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / _BLOCK).cast("int")),
                          lambda b: F.slice(matches, b * _BLOCK + 1, F.lit(_BLOCK)))
        none = F.array().cast("array<array<struct<start:int,stop:int,n:int>>>")
        return F.flatten(F.aggregate(cut, F.struct(F.lit(0).alias("at"), none.alias("out")), blocks, lambda s: s["out"]))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.zip_with(F.split(text, pattern, -1), found, lambda b, f: F.struct(
        F.length(b).alias("gap"), F.length(f).alias("size")))
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    matches = F.zip_with(gaps, counted, lambda s, g: F.struct(s["gap"], s["size"], F.length(g).alias("n")))
    none = F.array().cast("array<struct<start:int,stop:int,n:int>>")
    # the last piece has no match after it
    return F.when(text.rlike(pattern), _bound(F.filter(matches, lambda m: m["size"].isNotNull()), summed)).otherwise(none)


def spans_of(text: Column, kind: Kind) -> Column:
    """Array of (start, stop, place of the kind in ``KINDS``) of a kind's matches in a text that is not null."""
    valid = F.filter(_positions(text, kind.pattern, kind.group), lambda s: s["n"].between(kind.least, kind.most))
    return F.transform(valid, lambda s: F.struct(
        s["start"].alias("start"), s["stop"].alias("stop"), F.lit(KINDS.index(kind)).alias("place")))


def _is_part(span: Column, part: str, weak: bool | None = None) -> Column:
    places = [i for i, k in enumerate(KINDS) if k.part == part and weak in (None, k.weak)]
    long_enough = (span["place"] != KINDS.index(KINDS[2])) | (span["stop"] - span["start"] >= HEX_PART)
    return span["place"].isin(places) & long_enough


def link(df: DataFrame, text: str = "text", reach: int = REACH) -> DataFrame:
    """``text_key`` (SHA-256) and ``linked``, the weak spans to report, of texts that have any.

    Parts of a text are joined by interval within their paragraph: a weak identifier counts if a secret starts
    within ``reach`` of it, a weak secret if an identifier does, an endpoint if both do. The work is done once per
    different text and only for texts that can have a pair; a window frame over the starts is the join, so no pairs
    are made.
    """
    said = df.select(F.coalesce(F.col(text), F.lit("")).alias("t"))
    weak = [k for k in KINDS if k.weak]
    any_weak = F.lit(False)
    for kind in weak:
        any_weak = any_weak | F.col("t").rlike(kind.pattern)
    parts = said.where(any_weak).select(
        F.sha2("t", 256).alias("text_key"), F.concat(*(spans_of(F.col("t"), k) for k in KINDS)).alias("parts"),
        F.transform(_positions(F.col("t"), PARAGRAPH_END), lambda s: F.struct(
            s["start"].alias("start"), s["stop"].alias("stop"), F.lit(-1).alias("place"))).alias("ends"))
    paired = F.exists("parts", lambda s: _is_part(s, IDENTIFIER)) & F.exists("parts", lambda s: _is_part(s, SECRET))
    rows = parts.where(paired).dropDuplicates(["text_key"]).select(
        "text_key", F.explode(F.concat("parts", "ends")).alias("part")).select("text_key", "part.*")
    in_text = Window.partitionBy("text_key").orderBy("start", "place")
    scoped = rows.withColumn("scope", F.sum(F.when(F.col("place") == -1, 1).otherwise(0)).over(
        in_text.rowsBetween(Window.unboundedPreceding, 0))).where("place >= 0")
    near = Window.partitionBy("text_key", "scope").orderBy("start").rangeBetween(-reach, reach)
    span = {n: F.col(n) for n in ("start", "stop", "place")}
    joined = scoped.withColumns({
        "by_identifier": F.max(_is_part(span, IDENTIFIER)).over(near), "by_secret": F.max(_is_part(span, SECRET)).over(near)})
    reported = (_is_part(span, IDENTIFIER, True) & F.col("by_secret")) \
        | (_is_part(span, SECRET, True) & F.col("by_identifier")) \
        | (_is_part(span, ENDPOINT) & F.col("by_identifier") & F.col("by_secret"))
    return joined.where(reported).groupBy("text_key").agg(
        F.collect_list(F.struct("start", "stop", "place")).alias("linked"))


def scan(df: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``df`` with the column ``spans`` (replaced if there is one): array of (start, stop, kind), in code points, stop
    exclusive, by start, then kind as listed in ``KINDS``.

    Null and empty texts have no spans. Spans of different kinds may overlap. Rows that repeat a text all get its
    spans; an empty table stays empty. The linked spans are written to the shared folder first, so that their size
    decides how they are joined; a text that many rows share is split by adaptive execution.
    """
    own_key, own_base, other_key, other = (unused(df.columns, n) for n in ("text_key", "base", "linked_key", "linked"))
    linked = stored(link(df, text), "linked").toDF(other_key, other)
    plain = F.coalesce(F.col(text), F.lit(""))
    based = df.withColumns({own_key: F.sha2(plain, 256), own_base: F.concat(*(spans_of(plain, k) for k in STRONG))})
    names = F.array(*(F.lit(k.name) for k in KINDS))
    every = F.array_sort(F.concat(own_base, F.coalesce(other, F.array().cast(_SPANS))), lambda a, b: F.when(
        (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["place"] < b["place"])), -1).when(
        (a["start"] == b["start"]) & (a["place"] == b["place"]), 0).otherwise(1))
    named = F.transform(every, lambda s: F.struct(
        s["start"], s["stop"], F.element_at(names, s["place"] + 1).alias("kind")))
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() != spans.lower()]
    return based.join(linked, F.col(own_key) == F.col(other_key), "left").select(*kept, named.alias(spans))


def redact(df: DataFrame, text: str = "text", spans: str = "spans", mask: str = MASK) -> DataFrame:
    """``df`` with every run of spans in ``text`` replaced by ``mask``; texts without spans stay as they are."""
    keep = F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<a:int,b:int>>").alias("out")),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["stop"]).alias("at"),
            F.when(x["start"] >= s["at"], F.concat(s["out"], F.array(F.struct(s["at"].alias("a"), x["start"].alias("b")))))
            .otherwise(s["out"]).alias("out")),
        lambda s: F.concat(s["out"], F.array(F.struct(s["at"].alias("a"), F.length(text).alias("b")))))
    clean = F.array_join(F.transform(keep, lambda k: F.substring(F.col(text), k["a"] + 1, k["b"] - k["a"])), mask)
    return df.withColumn(text, F.when(F.size(spans) > 0, clean).otherwise(F.col(text)))


def listed(spans: Column, kinds: list[str] | None = None) -> Column:
    """Spans as text: kind:start:stop, comma-joined."""
    chosen = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
