"""Chat formatting with quotation linking; Spark columns only.

A line's quote level is its number of leading `>`. Neighbouring lines of one level above 0 are a quoted
passage; a message's lines of level 0 are its own. Passages are normalised (lower case, white space runs as
one space, trimmed) and hashed. A message can be quoted by its whole own text, by its paragraphs,
by lines, or by any run of its lines without the blank ones: runs of the lengths that the conversation's passages and their
paragraphs have. A passage links as a whole, or else by one of its paragraphs, or else by one of its lines, the longest that an
earlier message has, and to the latest message that has it; the message then answers the latest message that it
links to, or else the one before it. Linking is a running maximum over (conversation, hash), so a frequent
passage in a long conversation makes no pairs.

Reply order: a conversation is a tree, in which a message's children are those that answer it. place is a message's
number in the walk that goes from a message to the next one, if that answers it, and then to the later ones that do, by
turn; depth is its distance from the first message. Messages that each answer the one before form a run; runs are
the nodes of a smaller tree, whose walk (in at each run, out of it again) is a list that is ranked by doubling: each round
joins every step with the one as far ahead as it has come, so rounds are the logarithm of a conversation's number of runs.
A conversation without quotes is one run and takes no round. Windows over a conversation go in ranges of turns: each range of
SPAN turns by itself, then one row for each range.

Rows: one for each input row, in reply order (conv_id, place, turn). A null or empty text has an empty message; rows
with a null conversation or turn are kept, link to nothing and have no place. Rows that share conversation and turn count as
one place in the conversation. `conversations` gives the assembled texts, in parts of a bounded number of messages, so
that no row holds a conversation of any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmill.llm.common import as_text, column, written

#: Turns of a range, within which a window sorts; messages of a part of an assembled conversation.
SPAN, PART = 4096, 200

_PREFIX = r"^[ \t]*(?:>[ \t]?)+"


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _lines(text: Column) -> Column:
    """Lines with their quote level."""

    def one(line: Column) -> Column:
        prefix = F.regexp_extract(line, _PREFIX, 0)
        return F.struct(F.char_length(F.regexp_replace(prefix, "[^>]", "")).alias("level"), F.substring(line, F.char_length(prefix) + 1, F.char_length(line)).alias("body"))

    return F.transform(F.split(text, "\n"), one)


def _passages(lines: Column) -> Column:
    """Runs of lines with one level above 0, joined: an array of (level, body)."""
    empty = F.from_json(F.lit("[]"), "array<struct<level:int,body:string>>")
    marked = F.transform(lines, lambda x, i: F.struct(x["level"].alias("level"), x["body"].alias("body"), (F.coalesce(F.get(lines, i - 1)["level"], F.lit(-1)) != x["level"]).alias("new"), i.alias("i")))
    starts = F.filter(marked, lambda x: x["new"])
    bounds = F.transform(starts, lambda x, k: F.struct(x["level"].alias("level"), x["i"].alias("low"), F.coalesce(F.get(starts, k + 1)["i"], F.size(lines)).alias("high")))
    quoted = F.filter(bounds, lambda x: x["level"] > 0)
    out = F.transform(quoted, lambda x: F.struct(x["level"].alias("level"), F.array_join(F.transform(F.slice(lines, x["low"] + 1, x["high"] - x["low"]), lambda y: y["body"]), "\n").alias("body")))
    return F.coalesce(out, empty)


def _paragraphs(text: Column) -> Column:
    return F.split(text, r"\n\s*\n")


def _hashes(text: Column) -> Column:
    """Hashes of the lines that are not blank."""
    return F.transform(F.filter(F.transform(F.split(text, "\n"), _normal), lambda x: x != ""), lambda x: F.xxhash64(x))


def _units(body: Column) -> Column:
    """The parts by which a passage can link: (rank, part, run), the whole (2), paragraphs (1) and lines (0)."""
    unit = lambda rank: lambda x: F.struct(F.lit(rank).alias("rank"), _normal(x).alias("part"), _hashes(x).alias("run"))
    return F.concat(F.array(unit(2)(body)), F.transform(_paragraphs(body), unit(1)), F.transform(F.split(body, "\n"), unit(0)))


def _runs(hashes: Column, sizes: Column) -> Column:
    """Hashes of all runs of the given sizes."""
    starts = lambda n: F.when((n > 0) & (n <= F.size(hashes)), F.sequence(F.lit(1), F.size(hashes) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(sizes, lambda n: F.transform(starts(n), lambda i: F.xxhash64(F.slice(hashes, i, n)))))


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def threads(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, message (without quotes), quote_level (the deepest), n_quoted, n_linked, answers
    (the turn that the message answers), place and depth in the conversation's tree, and chat (role and message in one string)."""
    rows = messages.select(column(conv_col).cast("bigint").alias("conv_id"), column(turn_col).cast("bigint").alias("turn"), column(role_col).cast("string").alias("role"), F.coalesce(as_text(text_col), F.lit("")).alias("_text"))
    plain = ~F.contains("_text", F.lit(">"))
    lines = F.when(plain, F.array(F.struct(F.lit(0).alias("level"), F.col("_text").alias("body")))).otherwise(_lines(F.col("_text")))
    own = lambda x: F.array_join(F.transform(F.filter(x, lambda y: y["level"] == 0), lambda y: y["body"]), "\n")
    rows = rows.withColumn("_m", _let(lines, lambda x: F.struct(F.trim(F.regexp_replace(own(x), r"\n{3,}", "\n\n"), F.lit(" \n")).alias("message"), F.when(~plain, _passages(x)).alias("quoted"))))
    rows = rows.select("conv_id", "turn", "role", F.col("_m.message").alias("message"), F.col("_m.quoted").alias("quoted"))
    keyed = rows.where("conv_id is not null and turn is not null")
    text = F.col("message")
    sources = F.array_distinct(F.concat(F.array(text), _paragraphs(text), F.split(text, "\n")))
    # only conversations with quotes need their sources; runs of lines only in the lengths that are asked for
    passages = keyed.where(F.size("quoted") > 0).select("conv_id", "turn", F.explode("quoted").alias("q")).select("conv_id", "turn", F.col("q.body").alias("body"))
    passages = passages.withColumn("passage", F.xxhash64(_normal(F.col("body")))).withColumn("unit", F.explode(_units(F.col("body")))).select("conv_id", "turn", "passage", "unit.*").where("part <> ''").distinct()
    quotes = passages.select("conv_id", "turn", "passage", "rank", F.char_length("part").alias("length"), F.explode(F.array(F.xxhash64("part"), F.xxhash64("run"))).alias("hash"))
    asks = passages.groupBy("conv_id").agg(F.collect_set(F.size("run")).alias("sizes"))
    has = keyed.join(asks, "conv_id").select("conv_id", "turn", F.explode(F.concat(F.transform(F.filter(F.transform(sources, _normal), lambda p: p != ""), lambda p: F.xxhash64(p)), _runs(_hashes(text), F.col("sizes")))).alias("hash")).distinct()
    nothing = F.lit(None)
    events = has.select("conv_id", "hash", "turn", F.col("turn").alias("source"), F.lit(False).alias("asks"), nothing.cast("bigint").alias("passage"), nothing.cast("int").alias("rank"), nothing.cast("int").alias("length")).unionAll(quotes.select("conv_id", "hash", "turn", nothing.cast("bigint"), F.lit(True), "passage", "rank", "length"))
    found = _before(events, ["conv_id", "hash"], "source", "to").where("asks and to is not null")
    found = found.groupBy("conv_id", "turn", "passage").agg(F.max(F.struct("rank", "length", "to"))["to"].alias("to"))
    links = found.groupBy("conv_id", "turn").agg(F.max("to").alias("linked"), F.count("*").alias("n_linked"))
    turns = keyed.select("conv_id", "turn").distinct().withColumn("own", F.col("turn"))
    before = _before(turns, ["conv_id"], "own", "previous").select("conv_id", "turn", "previous")
    answered = before.join(links, ["conv_id", "turn"], "left").withColumn("answers", F.coalesce("linked", "previous"))
    placed = reply_order(written(answered, "answers"))
    out = rows.join(placed, ["conv_id", "turn"], "left")
    return out.select(
        "conv_id", "turn", "role", "message",
        F.coalesce(F.array_max(F.transform("quoted", lambda q: q["level"])), F.lit(0)).alias("quote_level"),
        F.coalesce(F.size("quoted"), F.lit(0)).alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"),
        "answers", "place", "depth",
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), "message").alias("chat"),
    ).orderBy("conv_id", "place", "turn", "message")


def _before(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """rows with the greatest value of their keys' rows of smaller turn. Ranges of SPAN turns are sorted by
    themselves; one row for each range then carries its greatest value on."""
    rows = rows.withColumn("span", F.floor(F.col("turn") / SPAN))
    inside = Window.partitionBy(*keys, "span").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    spans = rows.groupBy(*keys, "span").agg(F.max(value).alias("top"))
    carried = F.max("top").over(Window.partitionBy(*keys).orderBy("span").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("carried", carried).drop("top")
    return rows.withColumn("near", F.max(value).over(inside)).join(spans, [*keys, "span"]).withColumn(name, F.greatest("near", "carried")).drop("near", "carried", "span")


def reply_order(answered: DataFrame) -> DataFrame:
    """answered (conv_id, turn, previous, answers and more) with place (from 0) and depth of each turn."""
    starts = answered.where("previous is null or answers <> previous")
    # the run of each turn, by its first turn, and the turn's number in it
    own = answered.withColumn("start", F.when(F.col("previous").isNull() | (F.col("answers") != F.col("previous")), F.col("turn")))
    own = _before(own, ["conv_id"], "start", "earlier").withColumn("run", F.coalesce("start", "earlier"))
    span = F.floor(F.col("turn") / SPAN)
    inside = Window.partitionBy("conv_id", "run", "span").orderBy("turn")
    own = own.withColumn("span", span).withColumn("inner", F.row_number().over(inside))
    sizes = own.groupBy("conv_id", "run", "span").agg(F.count("*").alias("n"))
    carry = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id", "run").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = own.join(sizes.withColumn("carry", carry).drop("n"), ["conv_id", "run", "span"]).withColumn("at", F.col("inner") - 1 + F.col("carry")).drop("span", "inner", "carry", "earlier", "start")
    branches = starts.where("previous is not null").select("conv_id", F.col("turn").alias("run"), F.col("answers").alias("turn"))
    if branches.isEmpty():
        return own.withColumn("place", F.col("at")).withColumn("depth", F.col("at")).drop("run", "at")
    own = written(own, "runs")
    length = own.groupBy("conv_id", "run").agg(F.count("*").alias("n"))
    up = branches.join(own.select("conv_id", "turn", F.col("run").alias("parent"), F.col("at").alias("parent_at")), ["conv_id", "turn"]).drop("turn")
    runs = length.join(branches.select("conv_id").distinct(), "conv_id", "left_semi").join(up, ["conv_id", "run"], "left")
    # a run's branches are walked from its last message to its first
    kin = Window.partitionBy("conv_id", "parent").orderBy(F.desc("parent_at"), "run")
    runs = runs.withColumn("next", F.lead("run").over(kin)).withColumn("nth", F.row_number().over(kin))
    child = runs.where("parent is not null and nth = 1").select("conv_id", F.col("parent").alias("run"), F.col("run").alias("child"))
    runs = written(runs.join(child, ["conv_id", "run"], "left"), "tree")
    step = lambda kind, run: F.struct(F.lit(kind).alias("kind"), F.col(run).alias("run"))
    down = F.when(F.col("parent").isNull(), 0).otherwise(F.col("parent_at") + 1).cast("bigint")
    inward = F.when(F.col("child").isNotNull(), step("in", "child")).otherwise(step("out", "run"))
    outward = F.when(F.col("parent").isNull(), None).when(F.col("next").isNotNull(), step("in", "next")).otherwise(step("out", "parent"))
    enter = runs.select("conv_id", step("in", "run").alias("step"), inward.alias("ahead"), F.col("n").alias("places"), down.alias("deep"), down.alias("down"))
    walk = enter.unionAll(runs.select("conv_id", step("out", "run"), outward, F.lit(0).cast("bigint"), -down, down))
    while True:
        walk = written(walk, "walk")
        if walk.where("ahead is not null").isEmpty():
            break
        other = walk.select("conv_id", F.col("step").alias("ahead"), F.col("ahead").alias("then"), F.col("places").alias("more"), F.col("deep").alias("deeper"))
        sums = [(F.col(n) + F.coalesce(m, F.lit(0))).alias(n) for n, m in (("places", "more"), ("deep", "deeper"))]
        walk = walk.join(other, ["conv_id", "ahead"], "left").select("conv_id", "step", F.col("then").alias("ahead"), *sums, "down")
    # places and deep of a step sum up the walk from it to the end; the whole walk's depth is 0
    rest = walk.where("step.kind = 'in'").select("conv_id", F.col("step.run").alias("run"), "places", (F.col("down") - F.col("deep")).alias("base"))
    whole = own.join(branches.select("conv_id").distinct(), "conv_id", "left_semi").groupBy("conv_id").agg(F.count("*").alias("total"))
    first = rest.join(whole, "conv_id").select("conv_id", "run", (F.col("total") - F.col("places")).alias("first"), "base")
    joined = own.join(first, ["conv_id", "run"], "left")
    return joined.withColumn("place", F.col("at") + F.coalesce("first", F.lit(0))).withColumn("depth", F.col("at") + F.coalesce("base", F.lit(0))).drop("run", "at", "first", "base")


def conversations(threaded: DataFrame, size: int = PART) -> DataFrame:
    """conv_id, part and chat: the messages of threads in reply order, up to about `size` places in one text. Rows without a
    place are left out."""
    own = threaded.where("place is not null").select("conv_id", F.floor(F.col("place") / size).alias("part"), F.struct("place", "turn", "chat").alias("m"))
    chats = F.transform(F.array_sort(F.collect_list("m")), lambda m: m["chat"])
    return own.groupBy("conv_id", "part").agg(F.array_join(chats, "\n").alias("chat"))
