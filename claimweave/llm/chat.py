r"""Chat formatting by relational expressions: collected turn structs, array aggregation, concatenation.

A conversation becomes one string of blocks, a block being a run of adjacent
turns of one role: ``### Role: first text<|turn|>second text</turn>`` and a line
end.  Control strings inside texts and roles are escaped: a backslash becomes
``\b``, ``### `` ``\h``, ``<|turn|>`` ``\s``, ``</turn>`` ``\t`` and, in roles, ``: ``
``\c``.  After that no text holds a control string, and none of them can arise
across a seam, as none begins with its own end; so cutting at control strings and
undoing the codes (``\b`` last) gives every turn back.

The loss mask is a list of (start, length) spans, in code points, over the
assistant texts, without the marks between merged turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions.settle import settled

# control string -> code; the backslash is escaped first and restored last
CODES = [("\\", "\\b"), ("### ", "\\h"), ("<|turn|>", "\\s"), ("</turn>", "\\t")]
OPEN, COLON, NEXT, CLOSE = "### ", ": ", "<|turn|>", "</turn>\n"
KNOWN = {"assistant": "Assistant", "user": "User", "system": "System", "tool": "Tool"}
SPAN = "array<struct<start:bigint,length:bigint>>"


def escape(c: Column) -> Column:
    for plain, code in CODES:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for plain, code in reversed(CODES):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def label(role: Column) -> Column:
    """Shown name of a role; roles that are not known are shown in quotes, so that both can be told apart."""
    other = F.concat(F.lit('"'), F.replace(escape(role), F.lit(": "), F.lit("\\c")), F.lit('"'))
    for name, shown in KNOWN.items():
        other = F.when(role == name, F.lit(shown)).otherwise(other)
    return other


def role_of(shown: Column) -> Column:
    inner = F.replace(shown.substr(F.lit(2), F.length(shown) - 2), F.lit("\\c"), F.lit(": "))
    other = unescape(inner)
    for name, known in KNOWN.items():
        other = F.when(shown == known, F.lit(name)).otherwise(other)
    return other


def _opens(turns: Column) -> Column:
    """Places, from 1, of turns whose role is not that of the turn before."""
    role = lambda i: F.element_at(turns, i)["role"]
    return F.filter(F.sequence(F.lit(1), F.size(turns)), lambda i: (i == 1) | (role(F.greatest(i - 1, F.lit(1))) != role(i)))


def _blocks(turns: Column, opens: Column) -> Column:
    """Adjacent turns of one role as (role, texts): slices between the places where the role changes."""
    n = F.size(turns)
    ends = F.concat(F.slice(opens, F.lit(2), n), F.array(n + 1))

    def block(start: Column, end: Column) -> Column:
        return F.struct(F.element_at(turns, start)["role"].alias("role"), F.transform(F.slice(turns, start, end - start), lambda t: t["text"]).alias("texts"))

    return F.zip_with(opens, ends, block)


def _texts(blocks: Column) -> Column:
    """Of each text: (length of what stands before it, its own, of what follows, whether it is masked)."""

    def sizes(b: Column) -> Column:
        head = len(OPEN) + len(COLON) + F.char_length(label(b["role"]))

        def one(t: Column, k: Column) -> Column:
            before = F.when(k == 0, head).otherwise(0).cast("bigint")
            after = F.when(k == F.size(b["texts"]) - 1, len(CLOSE)).otherwise(len(NEXT)).cast("bigint")
            return F.struct(before.alias("before"), F.char_length(t).cast("bigint").alias("n"), after.alias("after"), (b["role"] == "assistant").alias("masked"))

        return F.transform(b["texts"], one)

    return F.flatten(F.transform(blocks, sizes))


STRETCH = 64  # lengths are summed by stretches first, so that no place is found by summing all before it


def _sum(some: Column) -> Column:
    return F.aggregate(some, F.lit(0).cast("bigint"), lambda a, x: a + x)


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) from (conv_id, turn, role, text); other columns are not read.

    Turns are taken in the order of (turn, role, text), NULL first; repeated rows are
    turns of their own.  NULL text and NULL role count as empty.  A NULL conv_id is a
    conversation like any other.  No rows: no rows.  A conversation is one row, so
    all its turns meet in one task; the work there grows with its turns.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    collected = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("_turns"))
    escaped = F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), escape(t["text"]).alias("text")))
    # what a step reads more than once is settled before it
    steps = settled(collected.select("conv_id", escaped.alias("_turns")), {"_opens": _opens(F.col("_turns"))})
    steps = settled(steps.select("conv_id", _blocks(F.col("_turns"), F.col("_opens")).alias("_b")), {"_blocks": F.col("_b")}).drop("_b")
    steps = settled(steps, {"_texts": _texts(F.col("_blocks"))})
    steps = settled(steps, {"_sizes": F.transform("_texts", lambda t: t["before"] + t["n"] + t["after"])})
    stretches = F.sequence(F.lit(0), F.floor((F.size("_sizes") - 1) / STRETCH).cast("int"))
    steps = settled(steps, {"_sums": F.transform(stretches, lambda k: _sum(F.slice("_sizes", k * STRETCH + 1, F.lit(STRETCH))))})
    steps = settled(steps, {"_before": F.transform("_sums", lambda _, k: _sum(F.slice("_sums", F.lit(1), k)))})

    def span(t: Column, k: Column) -> Column:
        stretch = F.floor(k / STRETCH).cast("int")
        start = F.element_at("_before", stretch + 1) + _sum(F.slice("_sizes", stretch * STRETCH + 1, k % STRETCH)) + t["before"]
        return F.when(t["masked"], F.struct(start.alias("start"), t["n"].alias("length")))

    strings = F.transform(
        "_blocks", lambda b: F.concat(F.lit(OPEN), label(b["role"]), F.lit(COLON), F.array_join(b["texts"], NEXT), F.lit(CLOSE))
    )
    spans = F.filter(F.transform("_texts", span), lambda s: s.isNotNull()).cast(SPAN)
    return steps.select("conv_id", F.array_join(strings, "").alias("formatted"), spans.alias("loss_spans"))


def read_chats(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation, read from the string alone."""
    blocks = F.filter(F.split(formatted, CLOSE), lambda b: b != "")

    def turns(b: Column) -> Column:
        shown = F.substring_index(b.substr(F.lit(len(OPEN) + 1), F.char_length(b)), COLON, 1)
        body = b.substr(F.char_length(shown) + len(OPEN) + len(COLON) + 1, F.char_length(b))
        return F.transform(F.split(body, r"<\|turn\|>"), lambda t: F.struct(role_of(shown).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


PIECE = 4096  # code points that are passed over at most to reach a place


def under_mask(chats: DataFrame) -> DataFrame:
    """``chats`` (with formatted and loss_spans) and _loss, all text under the mask; the string is cut first, as places are counted in code points."""
    many = F.floor(F.char_length("formatted") / PIECE).cast("int")
    cut = F.transform(F.sequence(F.lit(0), many), lambda k: F.col("formatted").substr(k * PIECE + 1, F.lit(PIECE)))
    pieces = settled(chats, {"_pieces": cut})

    def text(span: Column) -> Column:
        first, last = (F.floor(at / PIECE).cast("int") for at in (span["start"], span["start"] + span["length"]))
        own = F.array_join(F.slice("_pieces", first + 1, last - first + 1), "")
        return unescape(own.substr((span["start"] % PIECE + 1).cast("int"), span["length"].cast("int")))

    return pieces.withColumn("_loss", F.array_join(F.transform("loss_spans", text), "")).drop("_pieces")


def chat_digests(turns: DataFrame) -> DataFrame:
    """What can be read back from the formatted conversations."""
    lines = F.transform("_read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    chats = settled(format_chats(turns).withColumnRenamed("formatted", "_f").withColumnRenamed("loss_spans", "_s"), {"formatted": F.col("_f"), "loss_spans": F.col("_s")})
    read = under_mask(chats.drop("_f", "_s")).select("conv_id", "formatted", read_chats(F.col("formatted")).alias("_read"), "_loss")
    return read.select(
        "conv_id",
        F.size("_read").cast("long").alias("n_turns"),
        F.sha2(F.encode(F.array_join(lines, ""), "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("_loss", "UTF-8"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def with_probe(conversations: DataFrame) -> DataFrame:
    """The given turns and conversation -7, whose two texts hold control strings."""
    said = F.lit("\\### Assistant: </turn> ok")
    probe = conversations.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


# the same read off the table: what must come back, and the length by the template's rules
DIGEST_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
n AS (SELECT *, row_number() OVER w AS rn, lag(role) OVER w IS DISTINCT FROM role AS opens,
             replace(replace(replace(replace(text, '\', '\b'), '### ', '\h'), '<|turn|>', '\s'), '</turn>', '\t') AS kept
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY rn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(kept) + CASE WHEN opens THEN 14 + length(role) + CASE WHEN role IN ('assistant', 'user', 'system', 'tool') THEN 0 ELSE 2 END ELSE 8 END)::BIGINT AS formatted_chars
FROM n GROUP BY conv_id
"""
