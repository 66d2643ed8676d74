"""Quotation linking: quoted passages are joined to the messages they come from; DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quakespark.llm.common import row_key
from quakespark.operators.order import number_rows
from quakespark.session import checkpointed

#: Quote marks at the start of a line; each ">" is a level.
_MARKS = r"^((?:[ \t]*>)+)"
#: The same anywhere in a text; only a line feed ends a line.
_ANY_MARKS = "(?md)" + _MARKS
#: A line that announces a quote, dropped when a quoted line follows.
_ATTRIBUTION = r"(?i)^[ \t]*(?:on|am|le|el)\b.*\b(?:wrote|schrieb|écrit|a écrit|escribió)\b.*:[ \t\r]*$"
#: What stands between paragraphs.
_BLANK = r"\n[ \t\r]*\n"
#: Characters of a passage that can be linked; shorter ones occur by chance.
LEAST = 8
_MESSAGE = ("conv_id", "turn", "key")


def level_of(line: Column | str) -> Column:
    """Nested quote level of a line; 0 is the author's own."""
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), "[^>]", ""))


def normalised(text: Column) -> Column:
    """Lower-case letters, white space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"[\s ]+", " "))


def _body(line: Column | str) -> Column:
    return F.regexp_replace(line, _MARKS, "")


def without_quotes(text: str) -> Column:
    """The text without quoted lines and the lines that announce them, blank lines at its ends removed."""
    def own(lines: Column) -> Column:
        def keep(line: Column, i: Column) -> Column:
            after = F.coalesce(F.get(lines, i + 1), F.lit(""))
            return ~line.rlike(_MARKS) & ~(line.rlike(_ATTRIBUTION) & after.rlike(_MARKS))

        return F.array_join(F.filter(lines, keep), "\n")

    # the outer lambda binds the split text once
    kept = F.transform(F.array(F.split(F.coalesce(text, F.lit("")), "\n")), own)[0]
    return F.when(F.coalesce(F.col(text), F.lit("")).rlike(_ANY_MARKS), F.regexp_replace(kept, r"^\s+|\s+$", "")).otherwise(F.coalesce(text, F.lit("")))


def _usable(passage: Column | str) -> Column:
    return F.length(passage) >= LEAST


def quoted_passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, key, level, passage, size): passages that a message quotes.

    A passage is a run of quoted lines of one level; runs of several lines also give each paragraph, that is the lines
    between blank quoted ones, and each line, as people cut what they quote. A message counts once, however often its
    row repeats.
    """
    placed = messages.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    quoting = placed.filter(F.coalesce("text", F.lit("")).rlike(_ANY_MARKS)).select(*_MESSAGE, "text").dropDuplicates(["key"])
    lines = quoting.select(*_MESSAGE, F.posexplode(F.split("text", "\n")).alias("at", "line")).withColumn("level", level_of("line"))
    quoted = lines.filter(F.col("level") > 0).withColumn("body", _body("line"))
    # consecutive places of one level keep their distance to their rank; at most one message's lines in a group
    rank = F.row_number().over(W.partitionBy("key", "level").orderBy("at"))
    runs = quoted.withColumn("run", F.col("at") - rank).groupBy(*_MESSAGE, "level", "run").agg(
        F.array_sort(F.collect_list(F.struct("at", "body"))).alias("lines")
    )
    bodies = F.transform("lines", lambda x: x["body"])
    # the outer lambda binds the joined lines once
    parts = lambda run: F.concat(F.array(run), F.split(run, _BLANK), F.split(run, "\n"))
    passages = F.array_distinct(F.transform(F.array(F.array_join(bodies, "\n")), parts)[0])
    out = runs.select(*_MESSAGE, "level", F.explode(passages).alias("passage")).withColumn("passage", normalised(F.col("passage")))
    out = out.filter(_usable("passage")).withColumn("size", F.length("passage"))
    return out.withColumn("passage", F.xxhash64("passage", "size")).distinct()


def _own_passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, key, passage): what a message says itself, as a whole, by paragraphs and by lines."""
    own = without_quotes("text")
    parts = F.array_distinct(F.concat(F.array(own), F.split(own, _BLANK), F.split(own, "\n")))
    out = messages.select(*_MESSAGE, F.explode(parts).alias("passage")).withColumn("passage", normalised(F.col("passage")))
    return out.filter(_usable("passage")).withColumn("passage", F.xxhash64("passage", F.length("passage")))


def links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, key, level, of_conv, of_turn, of_key, size): quoted messages and how much of each is quoted.

    A passage comes from the earliest earlier message of the conversation that says it, or else from the first message
    of all (by conv_id and turn) that does and stands before the quoting one. Sayings are reduced to these before the
    join, so a passage that everybody quotes or says gives one row for each time it is quoted.
    """
    quoted = checkpointed(quoted_passages(messages))
    asked = quoted.select("passage").distinct()
    said = _own_passages(messages).join(asked, "passage", "left_semi")
    said = said.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    first = F.min(F.struct("turn", "key"))
    here = checkpointed(said.groupBy("passage", "conv_id").agg(first.alias("m")))
    anywhere = here.groupBy("passage").agg(F.min(F.struct("conv_id", "m.turn", "m.key")).alias("far"))
    near = here.select("passage", "conv_id", F.struct("conv_id", "m.turn", "m.key").alias("near"))
    me = F.struct("conv_id", "turn")
    before = lambda c: F.when(F.struct(f"{c}.conv_id", f"{c}.turn") < me, F.col(c))
    found = quoted.join(near, ["passage", "conv_id"], "left").join(anywhere, "passage", "left")
    found = found.withColumn("of", F.coalesce(before("near"), before("far"))).filter(F.col("of").isNotNull())
    return found.groupBy(*_MESSAGE, "level", "of").agg(F.sum("size").alias("size")).select(
        *_MESSAGE, "level", F.col("of.conv_id").alias("of_conv"), F.col("of.turn").alias("of_turn"), F.col("of.key").alias("of_key"), "size"
    )


def _parents(found: DataFrame) -> DataFrame:
    """(key, of_conv, of_turn, of_key): the message answered: of the lowest level linked, the one quoted most, then the latest."""
    best = F.max(F.struct(-F.col("level"), "size", "of_conv", "of_turn", "of_key"))
    return found.groupBy("key").agg(best.alias("b")).select("key", "b.of_conv", "b.of_turn", "b.of_key")


def _roots(parents: DataFrame) -> DataFrame:
    """(key, root_conv, root_turn, depth): the start of each chain of answers, in rounds that double the steps taken."""
    state = checkpointed(parents.select("key", "of_key", F.col("of_conv").alias("root_conv"), F.col("of_turn").alias("root_turn"), F.lit(1).alias("depth")))
    while True:
        up = state.select(F.col("key").alias("of_key"), F.struct("of_key", "root_conv", "root_turn", "depth").alias("up"))
        step = state.join(up, "of_key", "left")
        if step.filter(F.col("up").isNotNull()).isEmpty():
            return state.select("key", "root_conv", "root_turn", "depth")
        state = checkpointed(step.select(
            "key", F.coalesce("up.of_key", "of_key").alias("of_key"),
            F.when(F.col("up").isNull(), F.col("root_conv")).otherwise(F.col("up.root_conv")).alias("root_conv"),
            F.when(F.col("up").isNull(), F.col("root_turn")).otherwise(F.col("up.root_turn")).alias("root_turn"),
            (F.col("depth") + F.coalesce("up.depth", F.lit(0))).alias("depth"),
        ))


def conversations(messages: DataFrame) -> DataFrame:
    """Every row of ``messages`` (conv_id, turn, role, text) without its quotes, placed in the thread it answers in.

    (conv_id, turn, role, text, n_quoted, max_level, n_links, reply_conv, reply_turn, thread_conv, depth, position):
    ``text`` is what the author wrote; ``reply_*`` is the message answered, null without a link; ``thread_conv`` the
    conversation where the chain of answers starts, its own without a link; ``position`` counts from 0 within the
    thread, by conv_id, turn and row hash, which puts every answer after what it answers. Null texts count as empty;
    messages without conv_id or turn quote nothing and are not quoted; rows that repeat are one message, so they share
    a position.
    """
    given = messages.select("conv_id", "turn", "role", "text", row_key("conv_id", "turn", "role", "text").alias("key"))
    found = checkpointed(links(given))
    parents = checkpointed(_parents(found))
    linked = _roots(parents).join(parents, "key").join(found.groupBy("key").agg(F.count(F.lit(1)).alias("n_links")), "key")
    # places are found without texts
    rows = given.select(*_MESSAGE).distinct().join(linked, "key", "left").select(
        *_MESSAGE, F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.col("of_conv").alias("reply_conv"), F.col("of_turn").alias("reply_turn"),
        F.coalesce("root_conv", "conv_id").alias("thread_conv"), F.coalesce("depth", F.lit(0)).alias("depth"),
    )
    levels = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), level_of)
    plain = given.withColumn("levels", levels).select(
        *_MESSAGE, "role", without_quotes("text").alias("text"),
        F.size(F.filter("levels", lambda x: x > 0)).cast("bigint").alias("n_quoted"), F.array_max("levels").alias("max_level"),
    )
    return plain.join(_placed(rows).drop("conv_id", "turn"), "key").drop("key")


def _placed(rows: DataFrame) -> DataFrame:
    """Positions within threads: rows are ranged and counted side by side, so no thread is sorted in one task."""
    order = [F.col(c).asc_nulls_first() for c in ("thread_conv", "conv_id", "turn", "key")]
    numbered = checkpointed(number_rows(rows, order, "_at"))
    starts = numbered.groupBy("thread_conv").agg(F.min("_at").alias("_start")).withColumnRenamed("thread_conv", "_thread")
    placed = numbered.join(starts, F.col("thread_conv").eqNullSafe(F.col("_thread")))
    return placed.withColumn("position", F.col("_at") - F.col("_start")).drop("_at", "_start", "_thread")
