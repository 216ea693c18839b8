"""Chat formatting with Spark expressions only: sort collected turn structs, merge neighbours of one role, concatenate.

Template. Neighbouring turns of one role form a block; its texts are joined by ``<<TURN>>``:

    system      <<SYS>>text<</SYS>>
    user        <s>[INST] text [/INST]
    assistant   ' ' text ' </s>'
    other role  <<ROLE>>role<</ROLE>>text<</TURN>>

Inside texts and role names a backslash is doubled and the first character of every control string becomes ``\\l``
(for ``<``) or ``\\b`` (for ``[``), so that no control string is left in a text and the escape can be undone. The loss
mask is a list of spans (code points, end exclusive) over the formatted string: one span for each assistant text.

Edge cases: a null text or role counts as empty; rows with one turn number are ordered by role and text, null turns
first; rows with a null conv_id form one conversation; an empty table gives an empty result. A conversation is one
output row and must fit into one. Other columns are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's control strings.
SYS, END_SYS = "<<SYS>>", "<</SYS>>"
ROLE, END_ROLE, END_TURN = "<<ROLE>>", "<</ROLE>>", "<</TURN>>"
INST, END_INST = "<s>[INST] ", " [/INST]"
SAY, END_SAY = " ", " </s>"
BREAK = "<<TURN>>"

_ANGLE = r"<(?=/?s>|<?/?(?:SYS|ROLE|TURN)>>)"
_SQUARE = r"\[(?=/?INST\])"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(F.regexp_replace(doubled, _ANGLE, r"\\l"), _SQUARE, r"\\b")


def unescape(text: Column) -> Column:
    """Undo ``escape``: between doubled backslashes every single one starts an escape."""
    plain = lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("["))
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def _opener(role: Column) -> Column:
    return (F.when(role == "system", SYS).when(role == "user", INST).when(role == "assistant", SAY)
            .otherwise(F.concat(F.lit(ROLE), escape(role), F.lit(END_ROLE))))


def _closer(role: Column) -> Column:
    return F.when(role == "system", END_SYS).when(role == "user", END_INST).when(role == "assistant", END_SAY).otherwise(END_TURN)


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans array<struct<start,end>> for rows of conv_id, turn, role, text."""
    empty = F.lit("")
    turns = (rows.select("conv_id", F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")).alias("t"))
             .groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns")))
    kind = "array<struct<role:string,texts:array<string>>>"

    def merge(blocks: Column, turn: Column) -> Column:
        last = F.try_element_at(blocks, F.lit(-1))
        text = escape(turn["text"])
        longer = F.concat(F.slice(blocks, F.lit(1), F.size(blocks) - 1), F.array(F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(text)).alias("texts"))))
        return F.when(last["role"] == turn["role"], longer).otherwise(
            F.concat(blocks, F.array(F.struct(turn["role"].alias("role"), F.array(text).alias("texts"))))).cast(kind)

    blocks = turns.select("conv_id", F.aggregate("turns", F.array().cast(kind), merge).alias("blocks"))
    # One piece for each stretch of the output, told whether it lies under the loss mask.
    piece = lambda s, loss: F.struct(s.alias("s"), loss.alias("loss"))

    def pieces(block: Column) -> Column:
        role, no = block["role"], F.lit(False)
        body = F.transform(block["texts"], lambda x, i: F.array(
            piece(F.when(i == 0, _opener(role)).otherwise(BREAK), no), piece(x, role == "assistant")))
        return F.concat(F.flatten(body), F.array(piece(_closer(role), no)))

    laid = blocks.select("conv_id", F.flatten(F.transform("blocks", pieces)).alias("pieces"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def advance(acc: Column, p: Column) -> Column:
        end = acc["at"] + F.length(p["s"])
        span = F.array(F.struct(acc["at"].alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(p["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return laid.select(
        "conv_id", F.array_join(F.transform("pieces", lambda p: p["s"]), "").alias("formatted"),
        F.aggregate("pieces", start, advance)["spans"].alias("loss_spans"))


_BLOCK = r"(?s)<<SYS>>.*?<</SYS>>|<<ROLE>>.*?<</TURN>>|<s>\[INST\] .*? \[/INST\]| .*? </s>"


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns array<struct<role,text>>, loss_texts array<string>, formatted_chars, from ``formatted`` and ``loss_spans`` alone."""

    def turns(block: Column) -> Column:
        other = block.startswith(ROLE)
        role = (F.when(block.startswith(SYS), "system").when(other, unescape(F.regexp_extract(block, r"(?s)^<<ROLE>>(.*?)<</ROLE>>", 1)))
                .when(block.startswith(INST), "user").otherwise("assistant"))
        body = F.regexp_replace(F.regexp_replace(block, r"(?s)^(?:<<SYS>>|<<ROLE>>.*?<</ROLE>>|<s>\[INST\] | )", ""),
                                r"(?:<</SYS>>|<</TURN>>| \[/INST\]| </s>)$", "")
        return F.transform(F.split(body, BREAK, -1), lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    blocks = formatted.select("conv_id", "formatted", "loss_spans", F.regexp_extract_all("formatted", F.lit(_BLOCK), 0).alias("blocks"))
    return blocks.select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"), F.flatten(F.transform("blocks", turns)).alias("turns"),
        F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))).alias("loss_texts"))
