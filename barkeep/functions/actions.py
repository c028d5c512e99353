"""Corporate-action scalar functions (Y6, Y8, Y10, Y12): classify a subject
line into (kind, factor) and parse feed dates. Built-in expressions only,
so they stay inside whole-stage codegen; ANSI-safe: a malformed number
yields a NULL factor, never an error.

Cost notes: `try_cast` / `try_to_date` are cheap when they succeed but
throw and catch internally when they fail, so every attempt is guarded by
a shape test (a regex on the text) and only runs where it can succeed;
`classify_columns` stages the regex matches as columns so each pattern is
evaluated once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: patterns and formats that define the classification ---
# Bonus "a:b" (a free for every b held); face-value split "from Rs A .. to
# Rs B" where either currency may read Rs, R, Re (with or without a dot);
# dividend anywhere in the line. Feed dates come in these three formats,
# first that parses wins.
BONUS_RE = r"(?is)bonus.*?(\d+)\s*:\s*(\d+)"
SPLIT_RE = r"(?is)from\s+rs?e?\.?\s*([\d.]+).*?to\s+rs?e?\.?\s*([\d.]+)"
DIVIDEND_RE = r"(?i)dividend"
SPLIT_WORDS = ("split", "sub-division")
DATE_FORMATS = (
    ("d-MMM-yyyy", r"^\d{1,2}-[A-Za-z]{3}-\d{4}$"),
    ("yyyy-M-d", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    ("d-M-yyyy", r"^\d{1,2}-\d{1,2}-\d{4}$"),
)
# --- end of fixed values ---

_NUMBER = r"^\d+(\.\d*)?$|^\.\d+$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def first_present(*cols) -> Column:
    """The first value that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols])


def parse_feed_date(raw) -> Column:
    """A feed date in any of the three formats, else NULL. Month names
    are accepted in any letter case."""
    s = F.initcap(F.trim(_c(raw)))
    return F.coalesce(*[F.when(s.rlike(shape), F.try_to_date(s, fmt))
                        for fmt, shape in DATE_FORMATS])


def to_number(text) -> Column:
    """Digits with at most one decimal point -> double; anything else NULL
    (without paying for a failed cast)."""
    t = _c(text)
    return F.when(t.rlike(_NUMBER), t.try_cast("double"))


def _split_words(low: Column) -> Column:
    t = None
    for w in SPLIT_WORDS:
        t = low.contains(w) if t is None else (t | low.contains(w))
    return t


def _kind_factor(s, bonus, split, split_m, div, a, b, old, new):
    null = F.lit(None).cast("double")
    kind = (F.when(s == "", "unknown")
             .when(bonus, "bonus")
             .when(split, "split")
             .when(div, "dividend")
             .otherwise("other"))
    factor = (F.when(s == "", null)
               .when(bonus, F.when((a > 0) & (b > 0), F.round(b / (a + b), 8)))
               .when(split, F.when(split_m & (old > 0) & (new > 0) & (new < old),
                                   F.round(new / old, 8)))
               .otherwise(null))
    return kind, factor


def classify(subject) -> Column:
    """struct(kind, factor) for one subject line.

    Order of tests: blank -> unknown; bonus a:b -> b/(a+b) when both are
    positive; split / sub-division -> new/old face value when
    0 < new < old; dividend; other. The factor is NULL whenever the
    wording does not give one with confidence. (One expression; for a
    whole table `classify_columns` evaluates each pattern once per row.)
    """
    s = F.trim(F.coalesce(_c(subject), F.lit("")))
    kind, factor = _kind_factor(
        s, s.rlike(BONUS_RE), _split_words(F.lower(s)), s.rlike(SPLIT_RE), s.rlike(DIVIDEND_RE),
        to_number(F.regexp_extract(s, BONUS_RE, 1)), to_number(F.regexp_extract(s, BONUS_RE, 2)),
        to_number(F.regexp_extract(s, SPLIT_RE, 1)), to_number(F.regexp_extract(s, SPLIT_RE, 2)))
    return F.struct(kind.alias("kind"), factor.alias("factor"))


def classify_columns(df: DataFrame, subject: str = "subject") -> DataFrame:
    """Append `kind` and `factor` for `subject`: each regex evaluated once
    per row, the extracting ones only where their pattern matched."""
    s = df.withColumn("_s", F.trim(F.coalesce(F.col(subject), F.lit(""))))
    s = s.withColumn("_bm", F.col("_s").rlike(BONUS_RE))
    s = s.withColumn("_sw", ~F.col("_bm") & _split_words(F.lower("_s")))
    s = s.withColumn("_sm", F.col("_sw") & F.col("_s").rlike(SPLIT_RE))
    s = s.withColumn("_dm", ~F.col("_bm") & ~F.col("_sw") & F.col("_s").rlike(DIVIDEND_RE))
    s = s.withColumn("_g1", F.when(F.col("_bm"), F.regexp_extract("_s", BONUS_RE, 1))
                             .when(F.col("_sm"), F.regexp_extract("_s", SPLIT_RE, 1)))
    s = s.withColumn("_g2", F.when(F.col("_bm"), F.regexp_extract("_s", BONUS_RE, 2))
                             .when(F.col("_sm"), F.regexp_extract("_s", SPLIT_RE, 2)))
    s = s.withColumn("_n1", to_number("_g1")).withColumn("_n2", to_number("_g2"))
    n1, n2 = F.col("_n1"), F.col("_n2")
    kind, factor = _kind_factor(F.col("_s"), F.col("_bm"), F.col("_sw"), F.col("_sm"),
                                F.col("_dm"), n1, n2, n1, n2)
    out = s.withColumn("kind", kind).withColumn("factor", factor) \
           .drop("_s", "_bm", "_sw", "_sm", "_dm", "_g1", "_g2", "_n1", "_n2")
    # One row in, one row out through a generator: a later predicate on
    # kind / factor stays above it instead of being pushed down and
    # re-inlined into every staged regex column (which repeats the regex
    # work and can overflow generated code).
    return out.select(F.inline(F.array(F.struct(*out.columns))))
