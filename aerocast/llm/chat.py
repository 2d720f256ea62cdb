"""Chat formatting with a grammar round trip, with DataFrame operations only.

Template (control strings ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``, ``[ROLE]``, ``[/ROLE]``)::

    user        <s>[INST] text [/INST]</s>
    assistant   <s>text</s>
    other       <s>[ROLE] role [/ROLE] text</s>

A turn is rendered as it is and parsed again; if the parser does not give back the very role and text,
or meets a control string inside them, the content is escaped and the round trip repeated. An
escape puts a backslash after the first character of a control string (one more where there are some
already), and the parser takes one away, so it is reversible for any text. No control string
holds another's first character past its own, so turns that survive alone survive in a row; the whole
conversation is parsed again nevertheless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ANGLE, _SQUARE = r"(/?s>)", r"(/?(?:INST|ROLE)\])"
_CONTROL = r"</?s>|\[/?(?:INST|ROLE)\]"
_USER_OPEN, _USER_CLOSE, _ROLE_OPEN, _ROLE_CLOSE = "[INST] ", " [/INST]", "[ROLE] ", " [/ROLE] "


def escape(text: Column) -> Column:
    out = F.regexp_replace(text, r"<(\\*)" + _ANGLE, r"<\\$1$2")
    return F.regexp_replace(out, r"\[(\\*)" + _SQUARE, r"[\\$1$2")


def unescape(text: Column) -> Column:
    out = F.regexp_replace(text, r"<\\(\\*)" + _ANGLE, r"<$1$2")
    return F.regexp_replace(out, r"\[\\(\\*)" + _SQUARE, r"[$1$2")


def _opening(role: Column, shown: Column) -> Column:
    return F.when(role == "user", F.lit("<s>" + _USER_OPEN)).when(role == "assistant", F.lit("<s>")) \
        .otherwise(F.concat(F.lit("<s>" + _ROLE_OPEN), shown, F.lit(_ROLE_CLOSE)))


def _closing(role: Column) -> Column:
    return F.when(role == "user", F.lit(_USER_CLOSE + "</s>")).otherwise(F.lit("</s>"))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted string; a turn that breaks the grammar has null fields."""
    pieces = F.split(formatted, "</s>", -1)
    turns = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(4), F.length(piece))
        is_user = body.startswith(_USER_OPEN) & body.endswith(_USER_CLOSE) & (F.length(body) >= len(_USER_OPEN + _USER_CLOSE))
        end = F.instr(body, _ROLE_CLOSE)
        is_other = body.startswith(_ROLE_OPEN) & (end > 0)
        role = F.when(is_user, F.lit("user")).when(is_other, F.substring(body, F.lit(len(_ROLE_OPEN) + 1), end - len(_ROLE_OPEN) - 1)) \
            .otherwise(F.lit("assistant"))
        text = F.when(is_user, F.substring(body, F.lit(len(_USER_OPEN) + 1), F.length(body) - len(_USER_OPEN + _USER_CLOSE))) \
            .when(is_other, F.substring(body, end + len(_ROLE_CLOSE), F.length(body))).otherwise(body)
        fine = piece.startswith("<s>") & ~F.rlike(role, F.lit(_CONTROL)) & ~F.rlike(text, F.lit(_CONTROL))
        return F.struct(F.when(fine, unescape(role)).alias("role"), F.when(fine, unescape(text)).alias("text"))

    return F.transform(turns, turn)


def render_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """``conv, turn, role, text, opening, content, closing``: each turn rendered so that the parser gives it back."""
    t = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    raw = t.withColumn("back", parse(F.concat(_opening(F.col("role"), F.col("role")), F.col("text"), _closing(F.col("role")))))
    same = (F.size("back") == 1) & F.coalesce(F.get("back", F.lit(0)) == F.struct("role", "text"), F.lit(False))
    shown = raw.withColumn("escaped", ~same)
    return shown.select("conv", "turn", "role", "text", "escaped",
                        _opening(F.col("role"), F.when(F.col("escaped"), escape(F.col("role"))).otherwise(F.col("role"))).alias("opening"),
                        F.when(F.col("escaped"), escape(F.col("text"))).otherwise(F.col("text")).alias("content"),
                        _closing(F.col("role")).alias("closing"))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """``conv, formatted, loss_spans, identical``: one row per conversation.

    ``loss_spans`` holds (start, end) in code points of each assistant text in ``formatted``; ``identical`` says
    that the parser gave back the source's turns (it always does; the tests hold that). Turns go by ``turn``, null
    first, then role and text, so repeated rows are repeated turns. A null role or text is empty, a null
    conversation id is one conversation, an empty table has none; other columns are ignored.

    A conversation is one value of the result, so its turns meet in one row by nature.
    """
    pieces = render_turns(turns, conv_col, turn_col, role_col, text_col)
    length = F.length("opening") + F.length("content") + F.length("closing")
    order = Window.partitionBy("conv").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("start", F.coalesce(F.sum(length).over(order), F.lit(0)).cast("long"))
    content = F.col("start") + F.length("opening")
    one = placed.select("conv", F.struct(
        "start", F.concat("opening", "content", "closing").alias("piece"), F.struct("role", "text").alias("turn"),
        F.struct(content.cast("long").alias("start"), (content + F.length("content")).cast("long").alias("end")).alias("span")).alias("t"))
    whole = one.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    out = whole.select("conv", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
                       F.transform(F.filter("turns", lambda t: t["turn"]["role"] == "assistant"), lambda t: t["span"]).alias("loss_spans"),
                       F.transform("turns", lambda t: t["turn"]).alias("source"))
    return out.select("conv", "formatted", "loss_spans", (parse(F.col("formatted")) == F.col("source")).alias("identical"))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(
        formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
