"""Secret scans with multipart credential linking. DataFrame functions only.

Strong parts (assigned secrets, access keys, long hex) are reported wherever
they stand. Weak parts (account names, random-looking words, endpoint
addresses) say little alone: an interval join within a scope reports an account
name or an endpoint only beside a secret, and a random word only beside an
identifier; an endpoint needs both. The scope of a part is its section, the
text between two blank lines, and REACH code points to either side where the
section ends sooner. Weak parts that overlap a strong one are dropped.

The joins are sweeps: the parts and the breaks between sections are sorted
once, and running maxima from either side tell each part how far the nearest
complement and the nearest break lie. No part is compared with every other, so
work grows with the matches (but for the sort), not with their square.

Spans are [start, end) in code points of the whole text, whatever its length;
they come from the pieces between matches, whose lengths add up to the
places. No pattern matches across a line's end.

Edge cases: a null text is empty; no match gives an empty list of spans; an
empty table gives no rows; repeated rows are scanned alike; equal starts are
ordered by kind as listed; columns of the input pass through, and internal
names begin with two underscores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "account", "random", "endpoint")
REACH = 200
#: Values of a running fold that are added up at once.
BLOCK = 64
#: Code points of the pieces that a text to be redacted is cut into.
PIECE = 1024
MARK = "[REDACTED]"

# --- fixed values: the base patterns of the contract ---
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
# --- end of fixed values ---
ACCOUNT = r"""(?i:account|client_?id|access_?key_?id|user(?:name)?|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}"""
RANDOM = r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])[A-Za-z0-9+/]{20,}"
ENDPOINT = r"(?i:https?|ssh|ftp|jdbc|postgres|mysql|mongodb|redis|amqp)[a-z+:]*://[^\x20\x09-\x0D\"'<>]+"

BREAK = r"\n[\x20\x09\x0B-\x0D]*(?=\n)"

_SPAN = "struct<start:int,kind:int,end:int>"
_NONE = "array<%s>" % _SPAN


def _none() -> Column:
    return F.array().cast(_NONE)


def _let(value: Column, body) -> Column:
    """`body` of the value, which is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, fold, of: str) -> Column:
    """For each value (of type `of`) the fold of all up to it. `fold` is
    associative and takes a null on its left. Blocks of BLOCK values are folded
    one by one, then their totals: the square of the length counts only by
    1 / BLOCK^2."""
    state = "struct<at:%s,out:array<%s>>" % (of, of)
    zero = F.struct(F.lit(None).cast(of).alias("at"), F.array().cast("array<%s>" % of).alias("out")).cast(state)

    def step(acc, v):
        return _let(fold(acc["at"], v), lambda at: F.struct(at.alias("at"), F.concat(acc["out"], F.array(at)).alias("out")).cast(state))

    def prefixes(part):
        return F.aggregate(part, zero, step, lambda acc: acc["out"])

    def joined(blocks):
        totals = prefixes(F.transform(blocks, lambda b: F.element_at(b, -1)))
        return _let(totals, lambda t: F.flatten(F.transform(blocks, lambda b, i: F.when(i == 0, b).otherwise(
            _let(F.get(t, i - 1), lambda before: F.transform(b, lambda v: fold(before, v)))))))

    cut = lambda v: F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")),
                                lambda b: prefixes(F.slice(v, b * BLOCK + 1, F.lit(BLOCK))))
    return _let(values, lambda v: F.when(F.size(v) > 0, _let(cut(v), joined)).otherwise(F.array().cast("array<%s>" % of)))


def matches(text: Column, pattern: str, kind: int, maybe: Column, keep=None) -> Column:
    """Spans of a pattern's leftmost non-overlapping matches. `maybe` is a
    cheap condition that every text with a match meets; `keep` (of the lengths
    of the match and of its value, group 2) drops failing matches."""
    whole = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    value = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(2)), F.length) if "([A-Z" in pattern else F.array().cast("array<int>")
    gaps = F.transform(F.split(text, pattern, -1), F.length)

    def spans(m):
        size = F.arrays_zip(m["0"], F.slice(m["1"], 1, F.size(m["0"])), m["2"]).cast("array<struct<`0`:int,`1`:int,`2`:int>>")
        ends = running(F.transform(size, lambda z: z["0"] + z["1"]), lambda a, b: F.coalesce(a, F.lit(0)) + b, "int")
        all_of = F.arrays_zip(size, ends).cast("array<struct<z:struct<`0`:int,`1`:int,`2`:int>,e:int>>")
        if keep is not None:
            all_of = F.filter(all_of, lambda x: keep(x["z"]["0"], x["z"]["2"]))
        return F.transform(all_of, lambda x: F.struct(
            (x["e"] - x["z"]["0"]).alias("start"), F.lit(kind).alias("kind"), x["e"].alias("end"))).cast(_NONE)

    found = _let(F.struct(whole.alias("0"), gaps.alias("1"), value.alias("2")), spans)
    return F.when(maybe, found).otherwise(_none())


_AROUND = "struct<a:int,b:int,s:int>"


def _sweep(parts: Column, a, b, keep) -> Column:
    """The parts that `keep` (of a part, what is before it and what after)
    holds for. Before: the largest end of a part of kinds `a` (`b`) and the
    start of the last break up to it; after: the least start of them, the end
    of the next break."""
    kinds = lambda p, some, at: F.when(p["kind"].isin([KINDS.index(k) for k in some]), at)
    brk = lambda p, at: F.when(p["kind"] == len(KINDS), at)

    def facts(p, sign, near, far):
        return F.struct(kinds(p, a, sign * p[near]).alias("a"), kinds(p, b, sign * p[near]).alias("b"), brk(p, sign * p[far]).alias("s")).cast(_AROUND)

    most = lambda x, y: F.struct(*[F.greatest(x[f], y[f]).alias(f) for f in "abs"]).cast(_AROUND)

    def swept(v):
        before = running(F.transform(v, lambda p: facts(p, F.lit(1), "end", "start")), most, _AROUND)
        after = F.reverse(running(F.reverse(F.transform(v, lambda p: facts(p, F.lit(-1), "start", "end"))), most, _AROUND))
        three = F.arrays_zip(v, before, after).cast("array<struct<p:%s,l:%s,r:%s>>" % (_SPAN, _AROUND, _AROUND))
        return F.transform(F.filter(three, lambda x: F.coalesce(keep(x["p"], x["l"], x["r"]), F.lit(False))), lambda x: x["p"])

    return F.when(F.size(parts) > 0, _let(F.array_sort(parts), swept)).otherwise(_none())


def _apart(parts: Column, strong) -> Column:
    """Sorted parts: those of the kinds `strong`, and others that overlap none of them."""
    def keep(p, left, right):
        hit = (left["a"] > p["start"]) | (-right["a"] < p["end"])
        return p["kind"].isin([KINDS.index(k) for k in strong]) | ~F.coalesce(hit, F.lit(False))
    return _sweep(parts, strong, (), keep)


def _linked(parts: Column, reach: int) -> Column:
    """The weak parts with their complement in scope, of sorted parts and breaks."""
    def keep(p, left, right):
        low = F.least(F.coalesce(left["s"], F.lit(-1)), p["start"] - reach)
        high = F.greatest(F.coalesce(-right["s"], F.lit((1 << 31) - 1)), p["end"] + reach)
        beside = lambda f: F.coalesce(left[f] > low, F.lit(False)) | F.coalesce(-right[f] < high, F.lit(False))
        needs = lambda k: p["kind"] == KINDS.index(k)
        return (needs("account") & beside("a")) | (needs("random") & beside("b")) | (needs("endpoint") & beside("a") & beside("b"))
    return _sweep(parts, ("assign", "hex", "random"), ("access", "account"), keep)


def scanned(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """The input's columns and __base, __spans: sorted arrays of (start, kind
    as its place in KINDS, end)."""
    text = F.col("__text")
    at = KINDS.index
    assigned = (F.contains(text, F.lit(":")) | F.contains(text, F.lit("=")))
    out = docs.withColumn("__text", F.coalesce(F.col("text").cast("string"), F.lit(""))).withColumns({
        "__assign": matches(text, ASSIGN, at("assign"), assigned & text.rlike(ASSIGN), lambda w, v: v >= 8),
        "__access": matches(text, ACCESS, at("access"), F.contains(text, F.lit("AKIA")), lambda w, v: w >= 16),
        "__hex": matches(text, HEX, at("hex"), text.rlike("[0-9a-f]{32}"), lambda w, v: w >= 32),
        "__account": matches(text, ACCOUNT, at("account"), assigned & text.rlike(ACCOUNT)),
        "__endpoint": matches(text, ENDPOINT, at("endpoint"), F.contains(text, F.lit("://"))),
    }).withColumn("__base", F.concat("__assign", "__access", "__hex"))
    weak = F.size("__account") + F.size("__endpoint") > 0
    out = out.withColumn("__parts", F.when(weak, _apart(F.concat("__base", "__account", "__endpoint"), KINDS[:3])).otherwise(F.col("__base")))
    # A random word counts only beside an identifier: others are not sought.
    some = F.exists("__parts", lambda p: p["kind"].isin(at("access"), at("account")))
    out = out.withColumn("__random", matches(text, RANDOM, at("random"), some))
    out = out.withColumn("__parts", F.when(F.size("__random") > 0, _apart(F.concat("__parts", "__random"), KINDS[:4] + KINDS[5:]))
                         .otherwise(F.col("__parts")))
    weak = F.exists("__parts", lambda p: p["kind"] >= 3) & (F.size("__parts") > 1)
    out = out.withColumn("__breaks", matches(text, BREAK, len(KINDS), weak))
    out = out.withColumn("__weak", F.when(weak, _linked(F.concat("__parts", "__breaks"), reach)).otherwise(_none()))
    out = out.withColumn("__spans", F.array_sort(F.concat("__base", "__weak"))).withColumn("__base", F.array_sort("__base"))
    return out.select(*docs.columns, "__base", "__spans")


def render(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, overlapping ones together, as one mark. The
    text is cut into pieces of PIECE code points once, so that a span costs its
    own length and not its place in the text."""
    def parts(ends):
        apart = F.filter(F.transform(spans, lambda s, i: F.struct(F.coalesce(F.get(ends, i - 1), F.lit(0)).alias("lo"), s["start"].alias("hi"))),
                         lambda p: p["lo"] <= p["hi"])
        rest = F.array(F.struct(F.element_at(ends, -1).alias("lo"), F.length(text).alias("hi")))
        return F.concat(apart, rest).cast("array<struct<lo:int,hi:int>>")

    def cut(p, pieces):
        first, last = F.floor(p["lo"] / PIECE).cast("int"), F.floor((p["hi"] - 1) / PIECE).cast("int")
        inside = F.when(p["lo"] < p["hi"], F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

        def piece(k):
            lo, hi = F.greatest(p["lo"] - k * PIECE, F.lit(0)), F.least(p["hi"] - k * PIECE, F.lit(PIECE))
            return F.substring(F.get(pieces, k), lo + 1, hi - lo)
        return F.array_join(F.transform(inside, piece), "")

    pieces = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % PIECE), F.lit(0))
    ends = running(F.transform(spans, lambda s: s["end"]), F.greatest, "int")
    kept = _let(pieces, lambda c: _let(ends, lambda e: F.transform(parts(e), lambda p: cut(p, c))))
    return F.when(F.size(spans) > 0, F.array_join(kept, MARK)).otherwise(text)


def op9_secrets(spark, sf_dir: str) -> DataFrame:
    """Every document's secret spans."""
    from barkeep.llm.common import table
    found = scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = lambda k: F.size(F.filter("__base", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias("n_" + k)
    return found.select("doc_id", n("assign"), n("access"), n("hex"),
                        F.sha2(render(F.col("__base")), 256).alias("base_sha256"), render(F.col("__spans")).alias("spans"))
