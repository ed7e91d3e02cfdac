"""Chat formatting in budgeted windows (operator 5), in DataFrame functions only.

Running sums of turn tokens choose spans of whole turns: a window takes turns
as long as they fit its budget.  It begins with the conversation's system turn,
repeats a limited history, and goes on with the turns that are new in it, all
within one budget.  The loss mask covers the texts of new assistant turns; what
a window repeats is masked.

A turn is ``<s>role`` line end ``text</s>`` line end.  Within roles and texts
a backslash is doubled and each ``<`` and ``[`` is followed by one, so no
control string of this or of common other templates remains in them; a line
end in a role is ``[n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens of a window, of the history that it repeats, and of a turn's marks.
BUDGET, HISTORY, MARKS = 1024, 256, 4
#: What counts as a token: a word of ASCII letters and digits, or another
#: character that isn't white space.
TOKEN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_\x09-\x0D\x20]"


def escaped(text: Column) -> Column:
    for a, b in (("\\", "\\\\"), ("<", "<\\"), ("[", "[\\")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def unescaped(text: Column) -> Column:
    for a, b in (("[\\", "["), ("<\\", "<"), ("\\\\", "\\")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def _opening(turn: DataFrame) -> DataFrame:
    """conv_id, pos, opens: the turns that begin windows.

    ``used`` is what the open window holds: what it repeats, and its new turns.
    A conversation's numbers are folded in one row, of a few bytes a turn.
    """
    def step(s: Column, x: Column) -> Column:
        more = s["used"] + x["tokens"]
        same = F.struct(s["starts"].alias("starts"), more.alias("used"))
        opened = F.struct(F.concat(s["starts"], F.array(x["pos"])).alias("starts"), (x["base"] + x["tokens"]).alias("used"))
        return F.when(more <= BUDGET, same).otherwise(opened)

    none = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(BUDGET + 1).cast("long").alias("used"))
    sizes = F.struct("pos", F.col("tokens").cast("long").alias("tokens"), F.col("base").cast("long").alias("base"))
    folded = turn.groupBy("conv_id").agg(F.sort_array(F.collect_list(sizes)).alias("x")).select("conv_id", F.aggregate("x", none, step)["starts"].alias("starts"))
    return folded.select("conv_id", F.explode("starts").alias("pos"), F.lit(True).alias("opens"))


def windows(turns: DataFrame) -> DataFrame:
    """conv_id, window, formatted, n_repeated, loss_spans, n_tokens.

    ``n_repeated`` turns at the front of a window stand in an earlier one, too.
    ``loss_spans`` are (start, end) code points of ``formatted``.  Turns are
    ordered by turn, then role and text; null texts and roles are empty, null
    conversations are one.  History gives way first where the budget is short,
    then the repeated system turn where it can't stand beside the first new
    one.  Only a turn that alone exceeds the budget makes a window beyond it, as
    turns are not cut; it stands alone there.  Other columns are ignored.
    """
    plain = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    body = escaped(F.col("text"))
    head_line = F.concat(F.lit("<s>"), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("[n")), F.lit("\n"))
    turn = plain.select(
        "conv_id", "turn", "role", "text", F.concat(head_line, body, F.lit("</s>\n")).alias("seg"), F.char_length(head_line).alias("skip"),
        F.char_length(body).alias("body_len"), (F.regexp_count("text", F.lit(TOKEN)) + MARKS).alias("tokens"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turn = turn.withColumn("pos", F.row_number().over(order)).withColumn("is_head", (F.col("pos") == 1) & (F.col("role") == "system"))
    turn = turn.withColumn("head", F.first(F.when(F.col("is_head"), F.struct("seg", "tokens"))).over(order))
    turn = turn.withColumn("chars", F.coalesce(F.sum(F.char_length("seg")).over(before), F.lit(0)))
    past = lambda k: F.when(~F.lag("is_head", k).over(order), F.lag(F.struct("seg", "tokens"), k).over(order))
    turn = turn.withColumn("last", past(1)).withColumn("last_2", past(2))
    # What a window that begins here repeats.
    base, history = F.lit(0), F.lit(0)
    for name in ("head", "last", "last_2"):
        size = F.col(f"{name}.tokens")
        fits = base + size + F.col("tokens") <= BUDGET
        if name != "head":
            fits &= history + size <= HISTORY
        use = (F.col("pos") > 1) & F.coalesce(fits, F.lit(False))
        if name == "last_2":
            use &= F.col("use_last")
        turn = turn.withColumn(f"use_{name}", use)
        taken = F.when(F.col(f"use_{name}"), size).otherwise(0)
        base, history = base + taken, history + (0 if name == "head" else taken)
    turn = turn.withColumn("base", base)
    # A mark before each turn that opens a window; counted, they number it.
    marked = turn.withColumn("opens", F.lit(False)).unionByName(_opening(turn.select("conv_id", "pos", "tokens", "base")), allowMissingColumns=True)
    by_place = Window.partitionBy("conv_id").orderBy("pos", F.col("opens").desc())
    turn = marked.withColumn("window", F.sum(F.col("opens").cast("long")).over(by_place) - 1).where("NOT opens")
    names = ("head", "last_2", "last")
    one = turn.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct("pos", "seg", "chars", "skip", "body_len", "role"))).alias("new"),
        F.sum("tokens").alias("tokens"), F.min_by(F.struct("base", *names, *(f"use_{n}" for n in names)), "pos").alias("at"),
    )
    repeated = F.concat(*(F.when(F.col(f"at.use_{n}"), F.col(f"at.{n}.seg")).otherwise("") for n in names))
    one = one.withColumn("repeated", repeated).withColumn("n_repeated", sum((F.col(f"at.use_{n}").cast("int") for n in names), F.lit(0)))
    one = one.withColumn("shift", F.char_length("repeated") - F.col("new")[0]["chars"])
    spans = F.transform(
        F.filter("new", lambda t: t["role"] == "assistant"),
        lambda t: F.struct((t["chars"] + t["skip"] + F.col("shift")).alias("start"), (t["chars"] + t["skip"] + t["body_len"] + F.col("shift")).alias("end")),
    )
    return one.select(
        "conv_id", "window", F.concat("repeated", F.array_join(F.transform("new", lambda t: t["seg"]), "")).alias("formatted"),
        "n_repeated", spans.alias("loss_spans"), (F.col("tokens") + F.col("at.base")).alias("n_tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and masked texts of each window: conv_id, window, turns, targets.

    ``turns`` are those new in the window: array<struct<role, text>>.
    """
    segments = F.split("formatted", "</s>\n")
    fresh = F.slice(segments, F.col("n_repeated") + 1, F.greatest(F.size(segments) - 1 - F.col("n_repeated"), F.lit(0)))

    def parsed(segment: Column) -> Column:
        line = F.instr(segment, F.lit("\n"))
        role = F.replace(F.substr(segment, F.lit(4), line - 4), F.lit("[n"), F.lit("\n"))
        return F.struct(unescaped(role).alias("role"), unescaped(F.substr(segment, line + 1)).alias("text"))

    target = lambda s: unescaped(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    return formatted.select("conv_id", "window", F.transform(fresh, parsed).alias("turns"), F.transform("loss_spans", target).alias("targets"), F.char_length("formatted").alias("n_chars"))


def digests(formatted: DataFrame) -> DataFrame:
    """One row for each conversation, from what its windows say."""
    one = read_back(formatted).select(
        "conv_id", "window", "n_chars", F.size("turns").alias("n"), F.array_join("targets", "").alias("loss"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
    )
    whole = one.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("n_chars").alias("formatted_chars"), F.sort_array(F.collect_list(F.struct("window", "said", "loss"))).alias("w"))
    joined = lambda name: F.array_join(F.transform("w", lambda w: w[name]), "")
    return whole.withColumn("said", joined("said")).withColumn("loss", joined("loss")).select(
        "conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )
