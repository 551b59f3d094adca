"""Conversations in reply order by the quotations in their messages.

A line that starts with one or more ``>`` is quoted, its level the number of them; consecutive lines
of a level are a passage.  Passages are normalised (lower case, white space made one blank,
trimmed) and hashed, and so are the lines and the whole of what messages say themselves.
A passage's original is the earliest message with that hash: in the same conversation before
the quoting turn, else in any other conversation.  Originals are one row a hash before they are joined,
so a line that thousands of messages share adds no row.

A message replies to the original of its first passage of the lowest level that has one, else to the
turn before it, else it starts a thread.  Threads and depths are found by pointer jumping over these
links.  All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlift.llm.tables import written

_QUOTE = r"^(?:[ \t]*>)+"
_KEY = ["conv_id", "turn"]


def normalised(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def own_text(text: Column) -> Column:
    """What a message says itself: its lines that are not quoted, trimmed at both ends."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: ~x.rlike(_QUOTE))
    return F.regexp_replace(F.array_join(lines, "\n"), r"^\s+|\s+$", "")


def passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, place, level, hashes) of every quoted passage; the first hash is of the whole passage, the others of its lines."""
    quoting = messages.where(F.col("text").rlike("(?m)" + _QUOTE)).select(*_KEY, "text").distinct().withColumn("message", F.xxhash64("text"))
    lines = quoting.select(*_KEY, "message", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    quote = F.regexp_extract("line", _QUOTE, 0)
    lines = lines.select(*_KEY, "message", "place", F.regexp_count(quote, F.lit(">")).alias("level"), normalised(F.expr("substr(line, length(regexp_extract(line, '^(?:[ \\\\t]*>)+', 0)) + 1)")).alias("line"))
    order = Window.partitionBy(*_KEY, "message").orderBy("place")  # the lines of one message
    lines = lines.withColumn("starts", (F.col("level") != F.coalesce(F.lag("level").over(order), F.lit(-1))).cast("int"))
    lines = lines.withColumn("passage", F.sum("starts").over(order)).where("level > 0 AND line <> ''")
    whole = lines.groupBy(*_KEY, "message", "passage", "level").agg(F.min("place").alias("place"), F.array_sort(F.collect_list(F.struct("place", "line"))).alias("lines"))
    said = F.array_join(F.transform("lines", lambda x: x["line"]), " ")
    return whole.select(*_KEY, "place", "level", F.concat(F.array(F.xxhash64(said)), F.transform("lines", lambda x: F.xxhash64(x["line"]))).alias("hashes"))


def linked(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, place, level, from_conv, from_turn) of the passages of ``messages`` that have an original."""
    found = passages(messages).select(*_KEY, "place", "level", F.posexplode("hashes").alias("rank", "hash"))
    own = messages.select(*_KEY, "own").where("own <> ''")
    said = own.select(*_KEY, F.explode(F.concat(F.array(F.regexp_replace("own", "\n", " ")), F.split("own", "\n"))).alias("line"))
    said = said.select(*_KEY, F.xxhash64(normalised(F.col("line"))).alias("hash")).join(found.select("hash").distinct(), "hash", "left_semi")
    here = said.groupBy("conv_id", "hash").agg(F.min("turn").alias("here"))
    anywhere = here.groupBy("hash").agg(F.min(F.struct("conv_id", F.col("here").alias("turn"))).alias("first"))
    # the earliest of the conversations besides the first one's, for quotes in that conversation itself
    others = here.join(anywhere, "hash").where(F.col("conv_id") != F.col("first.conv_id")).groupBy("hash").agg(F.min(F.struct("conv_id", F.col("here").alias("turn"))).alias("next"))
    joined = found.join(here, ["conv_id", "hash"], "left").join(anywhere, "hash", "left").join(others, "hash", "left")
    source = F.when(F.col("here") < F.col("turn"), F.struct(F.col("conv_id"), F.col("here").alias("turn"))).when(F.col("first.conv_id") != F.col("conv_id"), F.col("first")).otherwise(F.col("next"))
    joined = joined.withColumn("source", source).where("source IS NOT NULL")
    best = joined.groupBy(*_KEY, "place", "level").agg(F.min(F.struct("rank", "source")).alias("best"))
    return best.select(*_KEY, "place", "level", F.col("best.source.conv_id").alias("from_conv"), F.col("best.source.turn").alias("from_turn"))


def threads(links: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(conv_id, turn, thread_conv, thread_turn, depth) from one row a message with to_conv and to_turn, null at a start; and the smallest message (conv_id, turn) of every cycle.

    The latter is None where there is no cycle; where there is one, the former lacks what leads to it.

    Every round doubles how far each message sees, so there are as many as the logarithm of the
    longest chain; a round is one join on a unique key and a written table.  A round that ends no
    message leaves only those that lead to cycles; once they see as far as there are of them, what
    they see is all of the cycles' messages, and the smallest that those met on their way is their cycle's.
    """
    state = written(
        links.select(*_KEY, F.coalesce("to_conv", "conv_id").alias("at_conv"), F.when(F.col("to_conv").isNull(), F.col("turn")).otherwise(F.col("to_turn")).alias("at_turn"), F.col("to_conv").isNotNull().cast("long").alias("depth"), F.col("to_conv").isNull().alias("done"), F.struct(*_KEY).alias("least")),
        "quotes-state",
    )
    last, seen, cycles = None, 1, None
    while True:
        open_rows = state.where("NOT done")
        left = open_rows.count()
        if not left:
            break
        if left == last and seen >= left:
            met = open_rows.select(F.col("at_conv").alias("conv_id"), F.col("at_turn").alias("turn")).distinct()
            cycles = open_rows.join(met, _KEY, "left_semi").select("least.*").distinct()
            break
        last, seen = left, 2 * seen
        ahead = state.select(F.col("conv_id").alias("at_conv"), F.col("turn").alias("at_turn"), F.col("at_conv").alias("c"), F.col("at_turn").alias("t"), F.col("depth").alias("d"), F.col("done").alias("z"), F.col("least").alias("l"))
        moved = open_rows.join(ahead, ["at_conv", "at_turn"]).select(*_KEY, F.col("c").alias("at_conv"), F.col("t").alias("at_turn"), (F.col("depth") + F.col("d")).alias("depth"), F.col("z").alias("done"), F.least("least", "l").alias("least"))
        state = written(state.where("done").unionByName(moved), "quotes-state")
    return state.where("done").select(*_KEY, F.col("at_conv").alias("thread_conv"), F.col("at_turn").alias("thread_turn"), "depth"), cycles


def turn_before(keys: DataFrame) -> DataFrame:
    """(conv_id, turn, turn_before): the largest smaller turn of each turn's conversation, null for its first.

    Turns may have gaps.  A window looks back within a segment of 1,024 turn numbers, and one row a segment is
    scanned for the turn before it, so a very long conversation is no single task.
    """
    parts = keys.withColumn("segment", F.shiftright("turn", 10))
    ends = parts.groupBy("conv_id", "segment").agg(F.max("turn").alias("last"))
    carried = ends.select("conv_id", "segment", F.lag("last").over(Window.partitionBy("conv_id").orderBy("segment")).alias("carried"))
    inner = F.lag("turn").over(Window.partitionBy("conv_id", "segment").orderBy("turn"))
    found = parts.withColumn("inner", inner).join(carried, ["conv_id", "segment"])
    return found.select(*_KEY, F.coalesce("inner", "carried").alias("turn_before"))


def reply_ordered(conversations: DataFrame) -> DataFrame:
    """One row a message of ``conversations`` (conv_id, turn, role, text; others are ignored).

    Columns: conv_id, turn, role, text without quotes, n_quotes (passages), n_linked (of them with an
    original), reply_conv and reply_turn (null at the start of a thread), thread_conv,
    thread_turn and depth.  In order of (thread_conv, thread_turn, depth, conv_id, turn) every
    message comes after the one it replies to.  Rows that share conv_id and turn are one place in
    the order and stay separate rows; a row without either of the two replies to nothing and
    starts a thread of its own.  A null text is empty.  A quote cannot lead forward in its
    conversation, but to any other one; where links form a cycle, its smallest message replies to nothing and starts the thread.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("own", own_text(F.col("text")))
    placed = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    found = written(linked(placed), "quotes-links")
    quoted = passages(placed).groupBy(*_KEY).agg(F.count("*").alias("n_quotes"))
    chosen = found.groupBy(*_KEY).agg(F.count("*").alias("n_linked"), F.min(F.struct("level", "place", "from_conv", "from_turn")).alias("first"))
    keys = placed.select(*_KEY).distinct()
    links = keys.join(chosen, _KEY, "left").join(quoted, _KEY, "left").join(turn_before(keys), _KEY, "left")
    links = links.select(
        *_KEY,
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        F.coalesce("first.from_conv", F.when(F.col("turn_before").isNotNull(), F.col("conv_id"))).alias("to_conv"),
        F.coalesce("first.from_turn", "turn_before").alias("to_turn"),
    )
    links = written(links, "quotes-replies")
    found, cycles = threads(links)
    if cycles is not None:
        cut = links.join(cycles.withColumn("cut", F.lit(True)), _KEY, "left")
        links = written(cut.withColumns({c: F.when(F.col("cut").isNull(), F.col(c)) for c in ("to_conv", "to_turn")}).drop("cut"), "quotes-replies")
        found, _ = threads(links)
    order = links.join(found, _KEY).withColumnsRenamed({"to_conv": "reply_conv", "to_turn": "reply_turn"})
    out = rows.join(order, _KEY, "left")
    return out.select(
        *_KEY, "role", F.col("own").alias("text"),
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        "reply_conv", "reply_turn",
        F.coalesce("thread_conv", "conv_id").alias("thread_conv"), F.coalesce("thread_turn", "turn").alias("thread_turn"), F.coalesce("depth", F.lit(0)).alias("depth"),
    )
