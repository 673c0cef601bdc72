r"""Chat formatting with a grammar round trip.

Rendered text follows the grammar

    chat := turn*
    turn := "### " role ": " text "</turn>" "\n"

in which neither role nor text holds ``###`` or ``</turn>`` and a role holds
no ``: ``.  The parser is fixed: it splits at ``</turn>\n``, takes the role up
to the first ``: ``, and undoes the escapes ``\h`` (``###``), ``\c``
(``</turn>``), ``\s`` (``: ``, in roles) and ``\\`` in what remains.  It gives
no turns at all for text outside the grammar.

Formatting starts with the plain turn, parses it, and compares what it gets
with the source.  Content that does not come back is escaped one step further:

0. as it is;
1. control strings escaped;
2. backslashes escaped as well, which always comes back, since every escape
   then begins with a backslash of its own and no control string is left.

All expressions are built-in functions; the only shuffle brings the turns of a
conversation together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, COLON, CLOSE, END = "###", ": ", "</turn>", "\n"
LOSS_ROLE = "assistant"
LEVELS = 3


def _escape(text: Column, level: int, role: bool = False) -> Column:
    if level == 0:
        return text
    if level == 2:
        text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit(OPEN), F.lit("\\h"))
    text = F.replace(text, F.lit(CLOSE), F.lit("\\c"))
    return F.replace(text, F.lit(COLON), F.lit("\\s")) if role else text


def _unescape(text: Column) -> Column:
    r"""Undo escapes; splitting at ``\\`` first, from the left, leaves in each
    piece only escapes that begin with its own backslash."""
    def one(piece: Column) -> Column:
        piece = F.replace(piece, F.lit("\\h"), F.lit(OPEN))
        piece = F.replace(piece, F.lit("\\c"), F.lit(CLOSE))
        return F.replace(piece, F.lit("\\s"), F.lit(COLON))
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), one), "\\")


def render_turn(role: Column, text: Column, level: int) -> Column:
    return F.concat(F.lit(OPEN + " "), _escape(role, level, role=True), F.lit(COLON),
                    _escape(text, level), F.lit(CLOSE + END))


def parse(chat: Column) -> Column:
    """The turns of a rendered chat as an array of structs ``role``, ``text``;
    null if the chat is outside the grammar."""
    pieces = F.split(chat, CLOSE + END, -1)
    turns = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def one(piece: Column) -> Column:
        body = F.substring(piece, len(OPEN) + 2, 2147483647)
        return F.struct(_unescape(F.substring_index(body, COLON, 1)).alias("role"),
                        _unescape(body.substr(F.position(F.lit(COLON), body) + 2, F.length(body))).alias("text"))

    def fits(piece: Column) -> Column:
        body = F.substring(piece, len(OPEN) + 2, 2147483647)
        return (piece.startswith(OPEN + " ") & body.contains(COLON)
                & ~body.contains(OPEN) & ~piece.contains(CLOSE))

    good = (F.element_at(pieces, -1) == "") & F.forall(turns, fits)
    return F.when(good, F.transform(turns, one))


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``chat`` (rendered), ``turns``
    (read back from ``chat``), ``n_escaped`` (turns that needed escapes).

    ``turns`` needs ``conv_id``, ``turn``, ``role``, ``text``; other columns
    are not read.  A null text or role is empty.  Rows are in the order of
    ``turn``, nulls first, ties by role and then text; repeated rows are
    repeated turns.  A null ``conv_id`` is a conversation of its own.  An
    empty table gives an empty result.  A conversation is one row of the
    result, so its own size, and nothing else, bounds what one task holds;
    turns are rendered and tested before the shuffle.
    """
    own = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                       F.coalesce("text", F.lit("")).alias("text"))
    role, text = F.col("role"), F.col("text")
    source = F.array(F.struct(role.alias("role"), text.alias("text")))
    level = F.lit(LEVELS - 1)
    for k in reversed(range(LEVELS - 1)):  # the lowest that comes back
        level = F.when(F.coalesce(parse(render_turn(role, text, k)) == source, F.lit(False)), k).otherwise(level)
    own = own.withColumn("level", level)
    shown = F.when(F.col("level") == 0, render_turn(role, text, 0)) \
        .when(F.col("level") == 1, render_turn(role, text, 1)).otherwise(render_turn(role, text, 2))
    own = own.withColumn("shown", shown)
    chats = own.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "shown"))).alias("source"),
        F.sum((F.col("level") > 0).cast("long")).alias("n_escaped"))
    chats = chats.withColumn("chat", F.array_join(F.col("source.shown"), ""))
    chats = chats.withColumn("turns", parse(F.col("chat")))
    same = F.coalesce(F.transform("turns", lambda x: F.struct(x["role"], x["text"])) ==
                      F.transform("source", lambda x: F.struct(x["role"], x["text"])), F.lit(False))
    return chats.select("conv_id", "chat",
                        F.when(same, F.col("turns")).otherwise(
                            F.raise_error(F.lit("the rendered chat does not parse back"))).alias("turns"),
                        "n_escaped")


def digest(chats: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """Digest columns of formatted chats, all taken from the turns read back."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == loss_role), lambda t: t["text"]), "")
    return chats.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length(masked).cast("long").alias("loss_chars"), F.sha2(masked, 256).alias("loss_sha256"),
        F.length("chat").cast("long").alias("formatted_chars"))
