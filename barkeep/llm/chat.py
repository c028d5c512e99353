"""Chat formatting with typed content parts. DataFrame functions only.

A turn's content is an ordered array of parts (type, text, ref, units). A
visitor goes over the parts: a text part gives its escaped text; an image,
audio or document part gives one placeholder, and its reference and the
tokens it expands to are recorded in order. Turns are marked by control
strings; a backslash after the first character keeps every control string
(ours and the common ones of other templates) that occurs inside a text from
being one, and backslashes are doubled, so that reading back is exact.

    <|turn|>role<|says|>body<|end|>

The loss mask is a list of [start, end) code-point spans over the bodies of
the trained role.

Edge cases: null text, role or parts are empty; rows of a conversation are
ordered by turn (null first), then role and what they say, so repeated rows
stay and reruns agree; a null conv_id is a conversation of its own; a part of an
unknown type, or a null one, gives nothing; an empty table gives an empty
result; further columns are ignored. A conversation is one row of the result,
so one conversation must fit a row (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
#: Placeholder and tokens per unit (image patch, second of audio, page).
MEDIA = {"image": ("<|image|>", 1), "audio": ("<|audio|>", 25), "document": ("<|document|>", 512)}
PART = "struct<type:string,text:string,ref:string,units:bigint>"

#: Where a control string begins: `<|`, <s>, </s>, <<SYS>>, <</SYS>>, [INST], [/INST].
_BEGINS = r"(<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"\\", r"\\\\"), _BEGINS, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_parts(text: Column) -> Column:
    """A turn's content that is one text."""
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("units")))


def body(parts: Column) -> Column:
    """The visitor's flat text."""
    def visit(p):
        out = F.when(p["type"] == "text", escape(p["text"]))
        for kind, (mark, _) in MEDIA.items():
            out = out.when(p["type"] == kind, F.lit(mark))
        return out.otherwise(F.lit(""))
    return F.array_join(F.transform(F.coalesce(parts, F.array().cast("array<%s>" % PART)), visit), "")


def attachments(parts: Column) -> Column:
    """References of the placeholders in order: (type, ref, tokens)."""
    def tokens(p):
        out = F.lit(0).cast("long")
        for kind, (_, each) in MEDIA.items():
            out = F.when(p["type"] == kind, F.coalesce(p["units"], F.lit(1)) * each).otherwise(out)
        return out
    media = F.filter(F.coalesce(parts, F.array().cast("array<%s>" % PART)), lambda p: F.coalesce(p["type"].isin(*MEDIA), F.lit(False)))
    return F.transform(media, lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), tokens(p).alias("tokens")))


def formatted(rows: DataFrame, trained: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_spans, attachments, expanded_tokens from rows
    of (conv_id, turn, role, parts)."""
    turns = rows.select(
        "conv_id", F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                            body(F.col("parts")).alias("body"), attachments(F.col("parts")).alias("media")).alias("t"))
    one = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # Rows of one turn and role go by what they say, not by how it is escaped.
    said = F.sort_array(F.transform("turns", lambda t: F.struct(
        t["turn"].alias("turn"), t["role"].alias("role"), unescape(t["body"]).alias("said"), t["body"].alias("body"), t["media"].alias("media"))))
    said = F.transform(said, lambda t: F.struct(t["turn"].alias("turn"), t["role"].alias("role"), t["body"].alias("body"), t["media"].alias("media")))
    keys = F.transform("turns", lambda t: F.struct(t["turn"], t["role"]))
    one = one.withColumn("turns", F.when(F.size(F.array_distinct(keys)) < F.size(keys), said).otherwise(F.col("turns")))
    # The whole text up to each body's start follows from running lengths.
    lead = lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(SAYS))
    kind = "struct<at:int,spans:array<struct<start:int,end:int>>>"

    def span(acc, t):
        start = acc["at"] + F.length(lead(t))
        end = start + F.length(t["body"])
        own = F.when(t["role"] == trained, F.array(F.struct(start.alias("start"), end.alias("end")))).otherwise(
            F.array().cast("array<struct<start:int,end:int>>"))
        return F.struct((end + len(END)).alias("at"), F.concat(acc["spans"], own).alias("spans")).cast(kind)

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")).cast(kind)
    media = F.flatten(F.transform("turns", lambda t: t["media"]))
    return one.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: F.concat(lead(t), t["body"], F.lit(END))), "").alias("formatted"),
        F.aggregate("turns", zero, span, lambda acc: acc["spans"]).alias("loss_spans"),
        media.alias("attachments"),
        F.aggregate(media, F.lit(0).cast("long"), lambda n, m: n + m["tokens"]).alias("expanded_tokens"))


def _bodies(text: Column) -> Column:
    """(role, body) of each turn of a formatted conversation, both escaped."""
    each = F.filter(F.split(text, r"<\|turn\|>", -1), lambda t, i: i > 0)
    return F.transform(each, lambda t: F.struct(
        F.substring_index(t, SAYS, 1).alias("role"),
        F.substring_index(F.substring_index(t, SAYS, -1), END, 1).alias("body")))


def read_turns(text: Column) -> Column:
    """(role, text) of each turn, read back from a formatted conversation."""
    return F.transform(_bodies(text), lambda t: F.struct(unescape(t["role"]).alias("role"), unescape(t["body"]).alias("text")))


def read_parts(text: Column, media: Column) -> Column:
    """(role, parts) of each turn, read back: parts are (type, text, ref,
    tokens). A placeholder is told from a text that says the same before
    anything is unescaped, as escaped texts hold no `<|`; the n-th placeholder
    of the conversation takes the n-th of its attachments. Text parts that
    follow each other come back as one, empty ones not at all."""
    mark = "<\\|(?:%s)\\|>" % "|".join(MEDIA)
    kind = "struct<type:string,text:string,ref:string,tokens:bigint>"
    pieces = F.transform(_bodies(text), lambda t: F.struct(
        unescape(t["role"]).alias("role"),
        F.regexp_extract_all(t["body"], F.lit("(?s)(%s|(?:(?!<\\|).)+)" % mark), F.lit(1)).alias("pieces")))
    is_mark = lambda p: p.rlike("^%s$" % mark)
    before = F.transform(pieces, lambda t, i: F.aggregate(
        F.slice(pieces, F.lit(1), i), F.lit(0), lambda n, u: n + F.size(F.filter(u["pieces"], is_mark))))

    def part(t, i):
        def one(p, k):
            at = F.get(before, i) + F.size(F.filter(F.slice(t["pieces"], F.lit(1), k), is_mark))
            a = F.get(media, at)
            return F.when(is_mark(p), F.struct(a["type"].alias("type"), F.lit(None).cast("string").alias("text"), a["ref"].alias("ref"),
                                               a["tokens"].alias("tokens"))).otherwise(
                F.struct(F.lit("text").alias("type"), unescape(p).alias("text"), F.lit(None).cast("string").alias("ref"),
                         F.lit(None).cast("long").alias("tokens"))).cast(kind)
        return F.struct(t["role"].alias("role"), F.transform(t["pieces"], one).alias("parts"))

    return F.transform(pieces, part)


def masked_text(text: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(text, s["start"] + 1, s["end"] - s["start"]))), "")


def op3_chat(spark, sf_dir: str) -> DataFrame:
    """All conversations and the one of control strings, read back."""
    from barkeep.llm.common import table
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    out = formatted(own.unionByName(extra).select("conv_id", "turn", "role", text_parts(F.col("text")).alias("parts")))
    back = out.select("conv_id", "formatted", "expanded_tokens", read_turns(F.col("formatted")).alias("turns"),
                      masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def _sql_escape(text: str) -> str:
    out = "replace(%s, '\\', '\\\\')" % text
    for c in ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"):
        out = "replace(%s, '%s', '%s')" % (out, c, c[0] + "\\" + c[1:])
    return out


OP3_SQL = """
WITH rows_in AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(%s) + length(%s) + 23)::BIGINT AS formatted_chars
FROM rows_in GROUP BY conv_id
""" % (_sql_escape("role"), _sql_escape("text"))
