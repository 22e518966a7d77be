"""Logged conversations: collapse of cumulative snapshots, then chat formatting.

A chat that is logged after every turn leaves conversations that are prefixes
of longer ones. Turns are laid out in order and each prefix gets a rolling hash:
the sums, up to a turn, of two 40-bit hashes of (position, role, text), which
any split of a long conversation can add up piece by piece. A conversation goes
when its whole is a proper prefix of another (an anti-join on the prefixes that
go on), and of equal ones the smallest id stays. What stays is rendered turn by
turn and put together in parts of PART turns, so that a conversation of any
length never meets in one task.

Defined results: a repeated row (same conversation, turn, role and text) counts
once; turns of one number are ordered by role, then text; a null turn comes
last; null roles and texts count as empty; rows without a conversation id are
one conversation without id; control marks within a text are broken up by a
zero-width space, so that no text can open or close a turn. Extra columns are
not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, unplaced
from .prefix import deal, running

PART = 512
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
_NO_ID = -(1 << 63)
_MASK = (1 << 40) - 1


def turns(conversations: DataFrame) -> DataFrame:
    """(g, turn, role, text) of the distinct turns, g the id or _NO_ID."""
    c = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(_NO_ID)).alias("g"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return c.distinct()


def _hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "pos", "role", "text").bitwiseAND(F.lit(_MASK))


def prefixes(conversations: DataFrame) -> DataFrame:
    """Every turn with its position from 0 and its prefix's hashes h1 and h2."""
    order = [F.col("turn").asc_nulls_last(), F.col("role"), F.col("text")]
    dealt = deal(turns(conversations), "g", order)
    laid = running(dealt.withColumn("one", F.lit(1).cast("long")), "g", order, {"one": "upto"})
    laid = laid.withColumn("pos", F.col("upto") - 1).withColumn("v1", _hash(1)).withColumn("v2", _hash(2))
    hashed = running(laid, "g", order, {"v1": "h1", "v2": "h2"})
    return hashed.select("g", "pos", "role", "text", "h1", "h2")


def maximal(prefixed: DataFrame) -> DataFrame:
    """(kept, n_turns, n_logs): conversations that no other goes on from, equal ones once."""
    key = ["pos", "h1", "h2"]
    last = prefixed.groupBy("g").agg(F.max(F.struct(*key)).alias("e")).select("g", "e.*")
    ends = last.groupBy(*key).agg(F.min("g").alias("kept"), F.count("*").alias("n_logs"))
    passing = prefixed.groupBy(*key).agg(F.count("*").alias("n"))
    e, p = ends.alias("e"), passing.alias("p")
    same = [F.col(f"e.{k}") == F.col(f"p.{k}") for k in key]
    # more conversations pass through the prefix than end with it: some go on
    open_ended = e.join(p, same).filter("p.n > e.n_logs").select(*[F.col(f"e.{k}").alias(k) for k in key])
    return ends.join(open_ended, key, "left_anti").select("kept", (F.col("pos") + 1).alias("n_turns"), "n_logs")


def _safe(text: Column) -> Column:
    return F.replace(text, F.lit("<|im_"), F.lit("<​|im_"))


def rendered() -> Column:
    return F.concat(F.lit(OPEN), _safe(F.col("role")), F.lit("\n"), _safe(F.col("text")), F.lit(f"{CLOSE}\n"))


def chat_format(conversations: DataFrame) -> DataFrame:
    """conv_id, part, n_turns, n_logs, text of the conversations that stay.

    ``n_turns`` and ``n_logs`` are of the whole conversation: its turns, and the
    equal logs that were collapsed into it. The parts, in order, are its text.
    """
    prefixed = checkpoint(prefixes(conversations))
    stay = maximal(prefixed)
    turn_rows = prefixed.join(stay.select(unplaced("kept"), "n_turns", "n_logs"), F.col("g") == F.col("kept"))
    one = F.struct("pos", rendered().alias("t"))
    parts = turn_rows.groupBy("g", F.floor(F.col("pos") / PART).cast("int").alias("part"), "n_turns", "n_logs").agg(F.array_sort(F.collect_list(one)).alias("all"))
    conv_id = F.when(F.col("g") != _NO_ID, F.col("g"))
    return parts.select(conv_id.alias("conv_id"), "part", "n_turns", "n_logs", F.array_join(F.transform("all", lambda x: x["t"]), "").alias("text"))


ORACLE = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, encode(role), encode(text)) - 1 AS pos FROM t
), p AS (
  SELECT *, string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS prefix,
    max(pos) OVER (PARTITION BY conv_id) AS last FROM o
), e AS (
  SELECT prefix, min(conv_id) AS conv_id, count(*) AS n_logs FROM p WHERE pos = last GROUP BY prefix
), k AS (
  SELECT e.* FROM e WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.prefix = e.prefix AND p.pos < p.last)
)
SELECT o.conv_id, (o.pos // 512)::INTEGER AS part, (p.last + 1)::BIGINT AS n_turns, k.n_logs,
  string_agg('<|im_start|>' || replace(o.role, '<|im_', '<' || chr(8203) || '|im_') || chr(10) || replace(o.text, '<|im_', '<' || chr(8203) || '|im_') || '<|im_end|>' || chr(10), '' ORDER BY o.pos) AS text
FROM o JOIN k ON o.conv_id = k.conv_id JOIN p ON p.conv_id = o.conv_id AND p.pos = o.pos
GROUP BY o.conv_id, o.pos // 512, p.last, k.n_logs
"""
