"""Chat transcripts rebuilt from event logs and rendered for training, with DataFrame functions only.

An event log has a row per event: conversation, sequence number, turn, kind, role, text.

* ``message``     sets the text of a turn (a whole turn at once);
* ``delta``       adds to the text of a turn (streamed output);
* ``edit``        replaces the text of a turn;
* ``regenerate``  clears a turn, and with it all events of later turns that came before it; deltas that follow build the turn anew.

``fold_events`` gives the final messages, ``render`` one formatted text per conversation with the spans that carry loss, and ``read_back``
parses the formatted text again.

Cases: null texts and roles are empty; null sequence numbers come first, equal ones are taken in the order of kind, then role, then text; repeated rows
are events of their own (a repeated message sets the same text twice; a repeated turn in a plain table is one turn more, see
``events_of_messages``); a null conversation id is a conversation; a null turn comes first; unknown kinds are ignored; an empty log gives
no conversations. A conversation becomes one text, so its messages meet in one row; events of a message are folded before that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import running_sums

KINDS = {"message": 0, "edit": 1, "regenerate": 2, "delta": 3}
OPEN, CLOSE = "<turn>### ", "</turn>\n"
#: Control characters of the template and what stands for them inside texts; the escape character itself comes first.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
#: In roles the colon ends the role, so it is escaped too.
ROLE_ESCAPES = ESCAPES + ((":", "\\c"),)


def escape(text: Column, pairs=ESCAPES) -> Column:
    for plain, coded in pairs:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column, pairs=ESCAPES) -> Column:
    """Undo ``escape``: the escape character is restored last, so no code is read twice."""
    for plain, coded in reversed(pairs):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def events_of_messages(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The log of a plain table of messages: one ``message`` event a row. Rows that share conversation and turn become turns of their own, in the order of role and text."""
    one = Window.partitionBy("conv", "_at").orderBy("role", "text")
    return (messages.select(F.col(conv).alias("conv"), F.col(turn).alias("_at"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
            .withColumn("turn", F.struct("_at", F.row_number().over(one).alias("copy")))
            .select("conv", F.col("_at").cast("bigint").alias("seq"), "turn", F.lit("message").alias("kind"), "role", "text"))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages ``conv, turn, role, text`` of a log ``conv, seq, turn, kind, role, text``.

    First the events of each turn meet in order; then a running maximum over earlier turns gives the last regeneration that voids older
    events; then the surviving events are folded: the last one that sets the text, and all deltas after it."""
    kind = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    e = events.select("conv", "turn", F.struct(F.coalesce("seq", F.lit(-(2 ** 62))).alias("seq"), kind[F.col("kind")].alias("kind"), F.coalesce("role", F.lit("")).alias("role"),
                                               F.coalesce("text", F.lit("")).alias("text")).alias("e")).filter(F.col("e.kind").isNotNull())
    turns = e.groupBy("conv", "turn").agg(F.sort_array(F.collect_list("e")).alias("es"), F.max(F.when(F.col("e.kind") == 2, F.col("e.seq"))).alias("_again"))
    before = Window.partitionBy("conv").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("_void", F.max("_again").over(before)).withColumn("es", F.filter("es", lambda x: F.col("_void").isNull() | (x["seq"] > F.col("_void"))))
    sets = F.array_max(F.transform("es", lambda x, i: F.when(x["kind"] < 3, i)))
    after = F.slice("es", F.coalesce(sets + 1, F.lit(1)), F.greatest(F.size("es"), F.lit(1)))
    text = F.array_join(F.transform(after, lambda x: F.when(x["kind"] == 2, F.lit("")).otherwise(x["text"])), "")
    role = F.array_max(F.transform("es", lambda x, i: F.when(x["role"] != "", F.struct(i.alias("i"), x["role"].alias("role")))))["role"]
    return turns.filter(F.size("es") > 0).select("conv", "turn", F.coalesce(role, F.lit("")).alias("role"), text.alias("text"))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv, formatted, turns``. ``turns`` has, per turn, where it starts, where its text starts and ends, and whether that text carries loss."""
    role, body = escape(F.col("role"), ROLE_ESCAPES), escape(F.col("text"))
    one = messages.select("conv", F.struct("turn", (F.col("role") == loss_role).alias("loss"), F.concat(F.lit(OPEN), role, F.lit(": ")).alias("head"), body.alias("body")).alias("t"))
    all_ = one.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    all_ = all_.select("conv", "ts", running_sums(F.transform("ts", lambda t: F.length(t["head"]) + F.length(t["body"]) + len(CLOSE))).alias("_at"))
    return all_.select("conv", F.array_join(F.transform("ts", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "").alias("formatted"),
                       F.zip_with("ts", "_at", lambda t, s: F.struct(s.alias("start"), (s + F.length(t["head"])).alias("text_start"),
                                                                     (s + F.length(t["head"]) + F.length(t["body"])).alias("text_end"), t["loss"].alias("loss"))).alias("turns"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse the formatted texts: adds ``messages`` (role and text of each turn) and ``loss_text`` (what the loss spans cover, unescaped, in order)."""
    parts = F.split("formatted", CLOSE)
    parts = F.slice(parts, 1, F.size(parts) - 1)
    message = lambda p: F.struct(unescape(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), ": ", 1), ROLE_ESCAPES).alias("role"),
                                 unescape(F.substr(p, F.length(F.substring_index(p, ": ", 1)) + 3)).alias("text"))
    lossy = F.zip_with("_parts", "turns", lambda p, t: F.when(t["loss"], unescape(F.substr(p, (t["text_start"] - t["start"] + 1).cast("int"), (t["text_end"] - t["text_start"]).cast("int")))).otherwise(""))
    return formatted.withColumn("_parts", parts).withColumn("messages", F.transform("_parts", message)).withColumn("loss_text", F.array_join(lossy, "")).drop("_parts")
