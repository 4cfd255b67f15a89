"""Quotation linking: nested quotes are parsed, joined to the messages they come from, and taken out of the chat.

A line's quote level is the number of ``>`` at its beginning.  Runs of lines of one level are passages; passages and
their lines are normalised (letters and digits, lower-cased, single spaces) and hashed.  What messages write
themselves is hashed likewise, by line, paragraph and whole; the earliest author of a hash in the conversation
is its original.  A message answers the message that most characters of its first-level quotes come from.  Depths
and the order of replies come from pointer doubling over numbers (list ranking of each thread's Euler tour), so a
message is a constant number of rows however long its thread is.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm.common import running_start, stored, table
from medallion.llm.registry import query

_MARK = r"^((?:[ \t]*>)+)[ \t]?"
# Fixed pattern: the line in which mail programs name whom they quote.
_WROTE = r"(?i)^\s*(on\b.{0,200}\bwrote|am\b.{0,200}\bschrieb.{0,80}|le\b.{0,200}\ba écrit|el\b.{0,200}\bescribió)\s*:\s*$"


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def messages(chat: DataFrame) -> DataFrame:
    """``msg, conv_id, turn, role, text, tie``: rows of ``chat`` with ids, repeats too; a null text is empty.

    Rows of one turn are told apart by ``tie``, a hash of role and text, so that no order depends on ids.
    """
    rows = chat.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    tie = F.xxhash64(F.coalesce("role", F.lit("")), "text")
    return stored(rows.withColumns({"tie": tie, "msg": F.monotonically_increasing_id()}))


def parsed_lines(found: DataFrame) -> DataFrame:
    """``msg, at, level, line, run``: every line without its marks; runs of one level, cut at blank lines, share ``run``.

    A line that only says who wrote what follows, right before a quote, is level -1.
    """
    rows = found.select("msg", F.posexplode(F.split("text", r"\r?\n")).alias("at", "raw"))
    marks = F.regexp_extract("raw", _MARK, 1)
    rows = rows.withColumn("level", F.length(F.regexp_replace(marks, "[^>]", ""))).withColumn("line", F.regexp_replace("raw", _MARK, ""))
    order = Window.partitionBy("msg").orderBy("at")  # the lines of one message
    named = (F.col("level") == 0) & (F.lead("level", 1, 0).over(order) > 0) & F.col("line").rlike(_WROTE)
    rows = rows.withColumn("level", F.when(named, -1).otherwise(F.col("level")))
    blank = F.trim("line") == ""
    new = (F.lag("level").over(order) != F.col("level")) | blank | F.lag(blank).over(order)
    return rows.withColumn("run", F.sum(F.when(new, 1).otherwise(0)).over(order)).select("msg", "at", "level", "line", "run")


def _units(rows: DataFrame) -> DataFrame:
    """``msg, level, hash, chars`` of every line and run with a letter or digit; once each."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), " ")
    runs = rows.groupBy("msg", "level", "run").agg(text.alias("line")).select("msg", "level", _normal(F.col("line")).alias("unit"))
    lines = rows.select("msg", "level", _normal(F.col("line")).alias("unit"))
    return (runs.union(lines).where("unit != ''").distinct()
            .select("msg", "level", F.xxhash64("unit", F.length("unit")).alias("hash"), F.length("unit").alias("chars")))


def link(found: DataFrame, rows: DataFrame) -> DataFrame:
    """``msg, level, hash, chars, origin``: quoted passages and lines, with the message of the same conversation that
    wrote them first, if that is an earlier turn."""
    heads = found.select("msg", "conv_id", "turn", "tie")
    units = _units(rows.where("level >= 0"))
    wholes = found.select("msg", F.lit(0).alias("level"), _normal(F.col("text")).alias("unit")).where("unit != ''")
    wholes = wholes.select("msg", "level", F.xxhash64("unit", F.length("unit")).alias("hash"), F.length("unit").alias("chars"))
    quoted = stored(units.where("level > 0").join(heads.drop("tie"), "msg"))
    # only hashes that someone quotes; a common line is one row for each conversation, however often it stands there
    written = units.where("level = 0").union(wholes).join(quoted.select("hash").distinct(), "hash", "left_semi").join(heads, "msg")
    # who wrote it without a turn cannot be said to have been earlier
    first = written.where("turn is not null").groupBy("conv_id", "hash").agg(F.min(F.struct("turn", "tie", "msg")).alias("first"))
    first = first.select(F.col("conv_id").alias("c"), F.col("hash").alias("h"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("hash") == F.col("h")) & (F.col("first.turn") < F.col("turn"))
    return quoted.join(first, same, "left").select("msg", "level", "hash", "chars", F.col("first").alias("origin"))


def parents(links: DataFrame) -> DataFrame:
    """``msg, parent``: where most characters of the outermost quotes come from; the latest message of equals."""
    weight = links.where("origin is not null and level = 1").groupBy("msg", "origin").agg(F.sum("chars").alias("chars"))
    return weight.groupBy("msg").agg(F.max(F.struct("chars", "origin"))["origin"]["msg"].alias("parent"))


def roots(replies: DataFrame) -> DataFrame:
    """``msg, root, depth`` of every reply.  Each round doubles the stretch to the ancestor that a row points to."""
    state = stored(replies.select("msg", F.col("parent").alias("root"), F.lit(1).alias("depth"), F.lit(True).alias("open")))
    while state.where("open").limit(1).count():
        above = state.select(F.col("msg").alias("m"), F.col("root").alias("r"), F.col("depth").alias("d"))
        state = stored(state.join(above, F.col("root") == F.col("m"), "left").select(
            "msg", F.coalesce("r", "root").alias("root"), (F.col("depth") + F.coalesce("d", F.lit(0))).alias("depth"), F.col("d").isNotNull().alias("open")))
    return state.drop("open")


def tour(found: DataFrame, replies: DataFrame) -> DataFrame:
    """``msg, back``: how many messages of its thread stand at or behind a message, for threads that have replies.

    A thread's tour enters a message (node ``2 * msg``), tours its answers in order of turn, and leaves it
    (``2 * msg + 1``).  Pointer doubling sums up the entries from each node to the end: two rows a message, and rounds
    as the logarithm of the longest thread.
    """
    kids = replies.join(found.select("msg", "turn", "tie"), "msg")
    kids = stored(running_start(kids, ["parent", "turn", "tie", "msg"], F.lit(1), "at"))
    after = kids.select((F.col("at") - 1).alias("at"), F.col("msg").alias("next"), F.col("parent").alias("of"))
    beside = kids.join(after, "at", "left").select("msg", "parent", F.when(F.col("of") == F.col("parent"), F.col("next")).alias("sibling"))
    first = kids.groupBy("parent").agg(F.min_by("msg", "at").alias("kid"))
    all_in = replies.select("msg").union(replies.select("parent")).distinct()
    enter = all_in.join(first, F.col("msg") == F.col("parent"), "left").select(
        (2 * F.col("msg")).alias("node"), F.coalesce(2 * F.col("kid"), 2 * F.col("msg") + 1).alias("to"), F.lit(1).cast("long").alias("back"))
    leave = all_in.join(beside, "msg", "left").select(
        2 * F.col("msg") + 1, F.coalesce(2 * F.col("sibling"), 2 * F.col("parent") + 1), F.lit(0).cast("long"))
    state = stored(enter.union(leave))
    while state.where("to is not null").limit(1).count():
        ahead = state.select(F.col("node").alias("n"), F.col("to").alias("further"), F.col("back").alias("more"))
        # ends of lists are kept out of the join, in which they would meet in one task
        going = state.where("to is not null").join(ahead, F.col("to") == F.col("n")).select("node", F.col("further").alias("to"), (F.col("back") + F.col("more")).alias("back"))
        state = stored(going.union(state.where("to is null").select("node", "to", "back")))
    return state.where("node % 2 = 0").select((F.col("node") / 2).cast("long").alias("msg"), "back")


def threads(found: DataFrame, replies: DataFrame) -> DataFrame:
    """``msg, depth, begin, back``: how deep a message stands, its thread's first message (turn, tie, id), and its place
    in the thread, counted from the end."""
    heads = found.select("msg", F.struct("turn", "tie", "msg").alias("head"))
    placed = roots(replies).join(heads.select(F.col("msg").alias("root"), F.col("head").alias("begin")), "root").select("msg", "depth", "begin")
    return (heads.join(placed, "msg", "left").join(tour(found, replies), "msg", "left")
            .select("msg", F.coalesce("depth", F.lit(0)).alias("depth"), F.coalesce("begin", "head").alias("begin"), F.coalesce("back", F.lit(1)).alias("back")))


def conversations(chat: DataFrame) -> DataFrame:
    """One row for each message: ``conv_id, position, turn, role, depth, parent_turn, n_quotes, n_linked, body, chat``.

    ``position`` orders a conversation so that every message stands behind the one it answers and before later
    threads; messages without a linked quote begin threads, in order of turn, as do answers to one message.  ``body`` is the text without quotes
    and the lines that name their authors; ``chat`` is the body under its role.  Null turns come first, and are
    no originals; rows that are repeated stay messages of their own, and the turn, then a hash of role and text decides
    between equals.  Null conversations are one of their own; quotes of later turns, or of none in the conversation,
    stay unlinked.
    """
    found = messages(chat)
    # a message without a mark has no quotes; its lines need no parsing
    rows = parsed_lines(found.where(F.col("text").rlike(r"(?m)" + _MARK)))
    rows = stored(rows)
    plain = found.where(~F.col("text").rlike(r"(?m)" + _MARK))
    quoting = found.join(rows.select("msg").distinct(), "msg", "left_semi").select(F.col("conv_id").alias("c")).distinct()
    lines = rows.union(parsed_lines(plain.join(quoting, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")))
    links = stored(link(found, lines))
    replies = stored(parents(links))
    paths = threads(found, replies)

    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n")
    bodies = rows.where("level = 0").groupBy("msg").agg(text.alias("left_over"))
    quotes = rows.where("level > 0").groupBy("msg").agg(F.count_distinct("run").alias("n_quotes"))
    linked = links.where("origin is not null").groupBy("msg").agg(F.count("*").alias("n_linked"))
    above = found.select(F.col("msg").alias("parent"), F.col("turn").alias("parent_turn"))
    full = (found.join(paths, "msg").join(bodies, "msg", "left").join(quotes, "msg", "left").join(linked, "msg", "left")
            .join(replies.join(above, "parent"), "msg", "left"))
    body = F.when(F.col("n_quotes").isNull(), F.col("text")).otherwise(F.trim(F.coalesce("left_over", F.lit(""))))
    full = stored(full.select("conv_id", "turn", "role", "depth", "begin", "back", "parent_turn", F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
                              F.coalesce("n_linked", F.lit(0)).alias("n_linked"), body.alias("body"), "msg"))
    ranked = running_start(full.select("msg", "conv_id", "begin", "back"), ["conv_id", "begin", F.desc("back")], F.lit(1), "rank").select("msg", "conv_id", "rank")
    ranked = stored(ranked)
    starts = ranked.groupBy(F.col("conv_id").alias("c")).agg(F.min("rank").alias("start"))
    places = ranked.join(starts, F.col("conv_id").eqNullSafe(F.col("c"))).select("msg", (F.col("rank") - F.col("start")).alias("position"))
    return full.join(places, "msg").select(
        "conv_id", "position", "turn", "role", "depth", "parent_turn", "n_quotes", "n_linked", "body",
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), "body").alias("chat"))


@query()
def op2_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations(table(spark, sf_dir, "conversations"))
