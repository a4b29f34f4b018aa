"""Chat formatting with rotated perspectives.

For every participant of a conversation (every role but ``system``) the
dialogue is rendered once, with that participant as the assistant and the
others as named users. The result has one row per perspective and turn: the
rendered segment, its place in the whole rendered dialogue (in characters),
and the place of what the loss covers (the assistant's text and its end
mark; null for other turns). The segments in the order of ``seg_start`` are
the dialogue; ``assemble`` joins them for conversations that fit in a row.

Places are sums over all turns before. They are summed in two levels (within
chunks of ``CHUNK`` turn numbers, then over the chunks), so a conversation
with very many turns is split over tasks.

Turns are ordered by turn, role and text, nulls first. A null role is the
user ``unknown`` and no participant; null text is empty; a null conversation
is a conversation of its own. A conversation of system turns alone has no
perspective. Repeated rows are rendered as often as they come; extra columns
are ignored. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turn numbers of a chunk.
CHUNK = 512
BEGIN, END = "<|im_start|>", "<|im_end|>\n"
SYSTEM, UNKNOWN = "system", "unknown"


def header(speaker: Column, perspective: Column) -> Column:
    return F.when(speaker == perspective, F.lit(f"{BEGIN}assistant\n")) \
        .when(speaker == SYSTEM, F.lit(f"{BEGIN}system\n")) \
        .otherwise(F.concat(F.lit(f"{BEGIN}user name="), F.coalesce(speaker, F.lit(UNKNOWN)), F.lit("\n")))


def rotate(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """One row per perspective and turn."""
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    people = rows.where((F.col("role") != SYSTEM) & F.col("role").isNotNull()) \
        .select(F.col("conv_id").alias("c"), F.col("role").alias("perspective")).distinct()
    seen = rows.join(people, rows.conv_id.eqNullSafe(people.c)).drop("c")
    head = header(F.col("role"), F.col("perspective"))
    seen = seen.withColumn("head", F.length(head)).withColumn("segment", F.concat(head, "text", F.lit(END))) \
        .withColumn("n", F.length("segment").cast("long")) \
        .withColumn("chunk", F.floor(F.col("turn") / CHUNK))
    whole = ["conv_id", "perspective"]
    before = Window.partitionBy(*whole).orderBy(F.col("chunk").asc_nulls_first()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    chunks = seen.groupBy(*whole, "chunk").agg(F.sum("n").alias("sum")) \
        .select(F.col("conv_id").alias("c"), F.col("perspective").alias("p"), F.col("chunk").alias("k"),
                F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy(*whole, "chunk") \
        .orderBy(*[F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]) \
        .rowsBetween(Window.unboundedPreceding, -1)
    placed = seen.withColumn("in_chunk", F.coalesce(F.sum("n").over(inside), F.lit(0))) \
        .join(chunks, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("p"))
              & F.col("chunk").eqNullSafe(F.col("k")))
    start = F.col("base") + F.col("in_chunk")
    own = F.col("role") == F.col("perspective")
    return placed.select(
        "conv_id", "perspective", "turn", F.coalesce("role", F.lit(UNKNOWN)).alias("speaker"), "segment",
        start.alias("seg_start"), (start + F.col("n")).alias("seg_end"),
        F.when(own, start + F.col("head")).alias("mask_start"),
        F.when(own, start + F.col("n") - 1).alias("mask_end"))   # without the line feed


def assemble(segments: DataFrame) -> DataFrame:
    """Whole dialogues of ``rotate``: conv_id, perspective, dialogue and the
    masked spans. A dialogue is one row, so this is for conversations whose
    length is known to be bounded."""
    order = F.array_sort(F.collect_list(F.struct("seg_start", "segment", "mask_start", "mask_end")))
    return segments.groupBy("conv_id", "perspective").agg(order.alias("s")).select(
        "conv_id", "perspective", F.array_join(F.col("s.segment"), "").alias("dialogue"),
        F.transform(F.filter("s", lambda x: x["mask_start"].isNotNull()),
                    lambda x: F.struct(x["mask_start"].alias("start"), x["mask_end"].alias("end"))).alias("masks"))


ORACLE = f"""
with rows_ as (select conv_id, turn, role, coalesce(text, '') as text from conversations),
people as (select distinct conv_id as c, role as perspective from rows_ where role <> '{SYSTEM}'),
seen as (
  select conv_id, perspective, turn, role, text,
    case when role = perspective then '{BEGIN}assistant' || chr(10)
         when role = '{SYSTEM}' then '{BEGIN}system' || chr(10)
         else '{BEGIN}user name=' || coalesce(role, '{UNKNOWN}') || chr(10) end as head
  from rows_ join people on conv_id is not distinct from c),
cut as (select *, head || text || '{END[:-1]}' || chr(10) as segment from seen),
placed as (
  select *, coalesce(sum(length(segment)) over (
    partition by conv_id, perspective order by turn nulls first, role nulls first, text
    rows between unbounded preceding and 1 preceding), 0)::bigint as seg_start from cut)
select conv_id, perspective, turn, coalesce(role, '{UNKNOWN}') as speaker, segment, seg_start,
  seg_start + length(segment) as seg_end,
  case when role = perspective then seg_start + length(head) end as mask_start,
  case when role = perspective then seg_start + length(segment) - 1 end as mask_end
from placed
"""
