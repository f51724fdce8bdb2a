"""Preference formatting: chosen and rejected conversations become one prompt and two masked completions.

DataFrame operations only. The longest common prefix of turns (equal role and text, in turn order) is rendered
once as the prompt; what follows in either conversation is a completion, whose mask lists the character spans
that a trainer takes loss on, the assistant's turns. A conversation is one training example and ends up in one
string, so its turns are gathered in one row; nothing larger than a pair of conversations ever is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._store import table


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(t["head"], t["body"])), "")


def _mask(turns: Column) -> Column:
    """Spans 'start:end' (end excluded) of the assistant's bodies in the rendered completion."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.length(t["head"])
        end = begin + F.length(t["body"])
        span = F.concat(begin.cast("string"), F.lit(":"), end.cast("string"))
        return F.struct(end.alias("at"), F.when(t["role"] == "assistant", F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.array_join(F.aggregate(turns, start, step, lambda acc: acc["spans"]), ",")


def preference_pairs(turns: DataFrame) -> DataFrame:
    """turns: pair_id, side (0 chosen, 1 rejected), turn, role, text. One row per pair_id.

    Null role is 'unknown' and null text empty. '<|' inside a text becomes '< |', so that no text can open a turn.
    Ties of turn go by role, then text; null turns come first. Repeated rows are repeated turns. A pair with one
    side only has status 'single' and its prompt is empty; equal conversations have status 'same' and empty
    completions. Rows without pair_id or side are left out. Other columns are ignored. Empty in, empty out.
    """
    role = F.coalesce("role", F.lit("unknown"))
    item = F.struct(
        F.col("turn").alias("turn"), role.alias("role"), F.concat(F.lit("<|"), role, F.lit("|>\n")).alias("head"),
        F.concat(F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")), F.lit("<|end|>\n")).alias("body"))
    sides = turns.filter(F.col("pair_id").isNotNull() & F.col("side").isin(0, 1)).groupBy("pair_id").agg(
        *[F.sort_array(F.collect_list(F.when(F.col("side") == s, item))).alias(name) for s, name in ((0, "c"), (1, "r"))])
    c, r = F.col("c"), F.col("r")
    shorter = F.least(F.size(c), F.size(r))
    differs = F.transform(F.sequence(F.lit(1), shorter), lambda i: (F.get(c, i - 1)["head"] != F.get(r, i - 1)["head"]) | (F.get(c, i - 1)["body"] != F.get(r, i - 1)["body"]))
    lcp = F.when(shorter == 0, F.lit(0)).otherwise(F.coalesce(F.nullif(F.array_position(differs, F.lit(True)), F.lit(0)) - 1, shorter)).cast("int")
    out = sides.withColumn("shared_turns", lcp)
    rest = [F.slice(F.col(x), F.col("shared_turns") + 1, F.size(x) - F.col("shared_turns")) for x in ("c", "r")]
    return out.select(
        "pair_id", "shared_turns", F.size(c).alias("chosen_turns"), F.size(r).alias("rejected_turns"),
        _rendered(F.slice(c, F.lit(1), F.col("shared_turns"))).alias("prompt"),
        _rendered(rest[0]).alias("chosen"), _mask(rest[0]).alias("chosen_mask"), _rendered(rest[1]).alias("rejected"), _mask(rest[1]).alias("rejected_mask"),
        F.when((F.size(c) == 0) | (F.size(r) == 0), "single").when((F.col("shared_turns") == F.size(c)) & (F.col("shared_turns") == F.size(r)), "same").otherwise("pair").alias("status"))


def swapped_replies(turns: DataFrame) -> DataFrame:
    """pair_id, side, turn, role, text: each conversation as chosen, and as rejected with its last assistant turn exchanged.

    The exchanged text is the last reply of the conversation with the next conv_id, empty if there is none. A
    conversation without assistant stays as it is. Ties of turn go by role, then text. Rows without conv_id go.
    """
    role, text = F.coalesce("role", F.lit("unknown")), F.coalesce("text", F.lit(""))
    given = turns.filter("conv_id IS NOT NULL").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    numbered = given.withColumn("k", F.row_number().over(order)).withColumn("last", F.max(F.when(F.col("role") == "assistant", F.col("k"))).over(W.partitionBy("conv_id")))
    replies = numbered.filter("k = last").select((F.col("conv_id") - 1).alias("conv_id"), F.col("text").alias("other"))
    rejected = numbered.join(replies, "conv_id", "left").withColumn("text", F.when(F.col("k") == F.col("last"), F.coalesce("other", F.lit(""))).otherwise(F.col("text")))
    side = lambda rows, n: rows.select(F.col("conv_id").alias("pair_id"), F.lit(n).alias("side"), "turn", "role", "text")
    return side(numbered, 0).unionByName(side(rejected, 1))


def op8_preference_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table marks no preferences: a conversation is chosen over itself with another's last reply."""
    return preference_pairs(swapped_replies(table(spark, sf_dir, "conversations")))


SQL = """
WITH g AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
m AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM g),
z AS (SELECT *, max(k) FILTER (role = 'assistant') OVER (PARTITION BY conv_id) AS last FROM m),
s AS (SELECT conv_id AS pair_id, 0 AS side, turn, role, text FROM z UNION ALL
      SELECT z.conv_id, 1, z.turn, z.role, CASE WHEN z.k = z.last THEN coalesce(o.text, '') ELSE z.text END
      FROM z LEFT JOIN (SELECT conv_id - 1 AS conv_id, text FROM z WHERE k = last) o ON z.conv_id = o.conv_id),
t AS (SELECT pair_id, side, turn, role, '<|' || role || '|>' || chr(10) AS head, replace(text, '<|', '< |') || '<|end|>' || chr(10) AS body FROM s),
n AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn NULLS FIRST, role, head, body) AS k FROM t),
c AS (SELECT * FROM n WHERE side = 0), r AS (SELECT * FROM n WHERE side = 1),
p AS (SELECT pair_id, count(*) FILTER (side = 0) AS chosen_turns, count(*) FILTER (side = 1) AS rejected_turns FROM n GROUP BY 1),
d AS (SELECT c.pair_id, min(c.k) FILTER (c.head <> r.head OR c.body <> r.body) AS k FROM c JOIN r ON c.pair_id = r.pair_id AND c.k = r.k GROUP BY 1),
l AS (SELECT p.*, coalesce(d.k - 1, least(chosen_turns, rejected_turns)) AS shared_turns FROM p LEFT JOIN d USING (pair_id)),
e AS (SELECT n.*, l.shared_turns, sum(length(head) + length(body)) OVER (PARTITION BY n.pair_id, n.side, n.k > l.shared_turns ORDER BY n.k) AS upto
      FROM n JOIN l USING (pair_id))
SELECT l.pair_id, CAST(l.shared_turns AS INTEGER) AS shared_turns, CAST(chosen_turns AS INTEGER) AS chosen_turns, CAST(rejected_turns AS INTEGER) AS rejected_turns,
  coalesce(string_agg(head || body, '' ORDER BY e.k) FILTER (side = 0 AND e.k <= l.shared_turns), '') AS prompt,
  coalesce(string_agg(head || body, '' ORDER BY e.k) FILTER (side = 0 AND e.k > l.shared_turns), '') AS chosen,
  coalesce(string_agg((upto - length(body)) || ':' || upto, ',' ORDER BY e.k) FILTER (side = 0 AND e.k > l.shared_turns AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(head || body, '' ORDER BY e.k) FILTER (side = 1 AND e.k > l.shared_turns), '') AS rejected,
  coalesce(string_agg((upto - length(body)) || ':' || upto, ',' ORDER BY e.k) FILTER (side = 1 AND e.k > l.shared_turns AND role = 'assistant'), '') AS rejected_mask,
  CASE WHEN chosen_turns = 0 OR rejected_turns = 0 THEN 'single' WHEN l.shared_turns = chosen_turns AND l.shared_turns = rejected_turns THEN 'same' ELSE 'pair' END AS status
FROM l JOIN e USING (pair_id) GROUP BY ALL
"""
