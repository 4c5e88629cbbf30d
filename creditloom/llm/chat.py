"""Quotation linking: conversations in reply order, without quoted text.

Lines that begin with one or more `>` are quoted, at as deep a level as there are marks. Quoted lines of a message's shallowest level are
normalised (lower case, blanks collapsed) and hashed; each is linked to the latest earlier message of the conversation that says it in its own
words. A message replies to the one that most of its lines are linked to (the later one in a tie). Messages that hang together by replies are a thread,
named by its first turn; a conversation is ordered by thread, then turn, so every reply follows what it replies to.

The latest earlier message is a running maximum over slices of the turns, so neither a line nor a conversation with any share of the rows is one task.

Edge cases: a null text is a message without lines and keeps a null body; a row with null conv_id or turn replies to nothing and is a thread of its own at
position 0; rows with the same conv_id and turn are one message for links and share a position; a quote that nobody said before
links to nothing but is still taken out; an empty table gives an empty result; extra columns pass through, and names that start with `_chat_` are reserved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom.llm.common import query, stash, table, unstash
from creditloom.operators.prefix import running_sums

MARKS = r"^[ \t]*(?:>[ \t]*+)++"
SLICE = 1024


def level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def normalised(line: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(F.regexp_replace(line, MARKS, "")), r"[ \t\r]+", F.lit(" ")))


def parsed(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, line) of every line that says something; level 0 is the writer's own."""
    lines = F.transform(F.split("text", "\n", -1), lambda x: F.struct(level(x).alias("level"), normalised(x).alias("line")))
    return messages.where("conv_id is not null and turn is not null").select("conv_id", "turn", F.inline(lines)).where("line <> ''")


def latest_before(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, turn, said) of rows (keys, turn, own, quoted): the latest turn strictly before with own, for the rows with quoted."""
    merged = rows.groupBy(*keys, "turn").agg(F.max("own").alias("own"), F.max("quoted").alias("quoted")).withColumn("_slice", F.floor(F.col("turn") / SLICE))
    own = F.when(F.col("own"), F.col("turn"))
    earlier = Window.unboundedPreceding, -1
    inside = merged.withColumn("_inside", F.max(own).over(Window.partitionBy(*keys, "_slice").orderBy("turn").rowsBetween(*earlier)))
    slices = merged.groupBy(*keys, "_slice").agg(F.max(own).alias("_last"))
    carried = slices.withColumn("_carried", F.max("_last").over(Window.partitionBy(*keys).orderBy("_slice").rowsBetween(*earlier))).drop("_last")
    return inside.where("quoted").join(carried, [*keys, "_slice"]).select(*keys, "turn", F.coalesce("_inside", "_carried").alias("said"))


def replies(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, parent) of the messages that quote an earlier one."""
    quoting = messages.where(F.contains("text", F.lit(">")))
    quoted = parsed(quoting).where("level > 0")
    first = quoted.groupBy("conv_id", "turn").agg(F.min("level").alias("level"))
    quoted = stash(quoted.join(first, ["conv_id", "turn", "level"]).select("conv_id", "turn", F.xxhash64("line").alias("_hash"), F.length("line").alias("_size")).distinct(), "quoted-lines")
    with_quotes = quoted.select("conv_id").distinct()
    own = (parsed(messages.join(with_quotes, "conv_id", "left_semi")).where("level = 0")
           .select("conv_id", "turn", F.xxhash64("line").alias("_hash"), F.length("line").alias("_size")))
    rows = own.withColumns({"own": F.lit(True), "quoted": F.lit(False)}).unionByName(quoted.withColumns({"own": F.lit(False), "quoted": F.lit(True)}))
    votes = latest_before(rows, ["conv_id", "_hash", "_size"]).where("said is not null").groupBy("conv_id", "turn", "said").agg(F.count("*").alias("votes"))
    return votes.groupBy("conv_id", "turn").agg(F.max_by("said", F.struct("votes", "said")).alias("parent"))


def threads(links: DataFrame) -> DataFrame:
    """(conv_id, turn, parent, thread) of links (conv_id, turn, parent), by pointer doubling: a round doubles the distance covered."""
    now = stash(links.withColumn("thread", F.col("parent")), "threads")
    while True:
        jump = now.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("further"))
        step = stash(now.join(jump, ["conv_id", "thread"], "left").select("conv_id", "turn", "parent", F.coalesce("further", "thread").alias("thread"), F.col("further").isNotNull().alias("moved")), "threads")
        unstash(now)
        moved = not step.where("moved").isEmpty()
        now = step
        if not moved:
            return now.drop("moved")


def reply_order(messages: DataFrame) -> DataFrame:
    """messages with `text` freed of quotes, and `reply_to`, `thread`, `position` (from 0 within the conversation) and `quoted_lines`."""
    found = threads(replies(messages))
    keyed = messages.select("conv_id", "turn").where("conv_id is not null and turn is not null")
    placed = keyed.join(found, ["conv_id", "turn"], "left").select("conv_id", "turn", "parent", F.coalesce("thread", "turn").alias("thread"))
    placed = stash(placed.groupBy("conv_id", "turn", "parent", "thread").agg(F.count("*").alias("n")), "placed")
    sizes = placed.groupBy("conv_id", "thread").agg(F.sum("n").alias("n"))
    before = running_sums(sizes, ["thread"], ["n"], keys=["conv_id"], merge=False, slice_width=SLICE).select("conv_id", "thread", F.col("n_before").alias("_chat_threads"))
    inner = running_sums(placed.select("conv_id", "thread", "turn", "n"), ["turn"], ["n"], keys=["conv_id", "thread"], merge=False, slice_width=SLICE).select("conv_id", "thread", "turn", F.col("n_before").alias("_chat_inner"))
    order = stash(placed.join(inner, ["conv_id", "thread", "turn"]).join(before, ["conv_id", "thread"])
                  .select("conv_id", "turn", F.col("parent").alias("_chat_parent"), F.col("thread").alias("_chat_thread"), (F.col("_chat_inner") + F.col("_chat_threads")).alias("_chat_position")), "reply-order")
    lines = F.split("text", "\n", -1)
    quotes = F.when(F.contains("text", F.lit(">")), F.size(F.filter(lines, lambda x: level(x) > 0))).otherwise(0)
    freed = F.btrim(F.array_join(F.filter(lines, lambda x: level(x) == 0), "\n"), F.lit("\n"))
    plain = [c for c in messages.columns if c not in ("reply_to", "thread", "position", "quoted_lines")]
    return (messages.select(*plain).join(order, ["conv_id", "turn"], "left")
            .withColumns({"quoted_lines": F.coalesce(quotes, F.lit(0)).cast("long"), "reply_to": F.col("_chat_parent"), "thread": F.coalesce("_chat_thread", "turn"), "position": F.coalesce("_chat_position", F.lit(0)).cast("long")})
            .withColumn("text", F.when(F.col("quoted_lines") > 0, freed).otherwise(F.col("text")))
            .select(*plain, "reply_to", "thread", "position", "quoted_lines"))


OP5_SQL = r"""
with recursive messages as (
  select conv_id, turn, role, text, row_number() over () as id from conversations
), lines as (
  select id, conv_id, turn, pos, l,
         length(regexp_replace(regexp_extract(l, '^[ \t]*(>[ \t]*)+'), '[^>]', '', 'g')) as level,
         trim(regexp_replace(lower(regexp_replace(l, '^[ \t]*(>[ \t]*)+', '')), '[ \t\r]+', ' ', 'g')) as line
  from (select id, conv_id, turn, unnest(string_split(text, chr(10))) as l, unnest(range(len(string_split(text, chr(10))))) as pos from messages)
), said as (
  select * from lines where line <> '' and conv_id is not null and turn is not null
), shallow as (
  select conv_id, turn, min(level) as level from said where level > 0 group by all
), quoted as (
  select distinct conv_id, turn, line from said join shallow using (conv_id, turn, level)
), linked as (
  select q.conv_id, q.turn, q.line, max(o.turn) as parent
  from quoted q join said o on o.conv_id = q.conv_id and o.line = q.line and o.level = 0 and o.turn < q.turn group by all
), replies as (
  select conv_id, turn, parent from (select conv_id, turn, parent, row_number() over (partition by conv_id, turn order by count(*) desc, parent desc) as k
  from linked group by conv_id, turn, parent) where k = 1
), up as (
  select conv_id, turn, parent as thread from replies
  union
  select up.conv_id, up.turn, r.parent from up join replies r on r.conv_id = up.conv_id and r.turn = up.thread
), roots as (
  select conv_id, turn, min(thread) as thread from up group by all
), bodies as (
  select id, count(*) filter (level > 0) as quoted_lines, coalesce(string_agg(l, chr(10) order by pos) filter (level = 0), '') as body from lines group by id
), placed as (
  select m.id, m.conv_id, m.turn, m.role, m.text, r.parent as reply_to, coalesce(t.thread, m.turn) as thread
  from messages m left join replies r on r.conv_id = m.conv_id and r.turn = m.turn left join roots t on t.conv_id = m.conv_id and t.turn = m.turn
)
select p.conv_id, p.turn, p.role, p.reply_to, p.thread,
       case when p.conv_id is null or p.turn is null then 0 else rank() over (partition by p.conv_id order by p.thread, p.turn) - 1 end::bigint as position,
       coalesce(b.quoted_lines, 0)::bigint as quoted_lines,
       case when coalesce(b.quoted_lines, 0) > 0 then trim(b.body, chr(10)) else p.text end as body
from placed p left join bodies b using (id)
"""


@query("op5_chat_formatting", OP5_SQL)
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reply_order(table(spark, sf_dir, "conversations"))
    return found.select("conv_id", "turn", "role", "reply_to", "thread", "position", "quoted_lines", F.col("text").alias("body"))
