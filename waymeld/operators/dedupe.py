"""Registers in which one way stands several times: drawn twice, recorded by two authorities, or split differently by them.

A record goes only in favour of records that it lies wholly along, and those carry its id. Three passes, each on what
the one before left: lines that one authority holds twice; ways that one authority draws whole and another in pieces,
side held against side; one record against one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waymeld.functions import geo
from waymeld.operators import lines
from waymeld.operators.lineage import cut
from waymeld.operators.sizes import grown

#: Share of a record that lies along another for the two to be linked, and records in a split group at least.
LINK, GROUP = 0.8, 3


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) of undirected edges a, b. Nodes may be of any type that can be ordered; null ends are no edges.

    Each round takes the least label among neighbours, then the label of that label, so a chain of n nodes needs about log n rounds.
    """
    known = edges.filter("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    both = cut(known.unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    now = cut(both.groupBy("a").agg(F.least("a", F.min("b")).alias("component")).select(F.col("a").alias("node"), "component"))
    while True:
        around = both.join(now.select(F.col("node").alias("b"), F.col("component").alias("_l")), "b").groupBy(F.col("a").alias("node")).agg(F.min("_l").alias("_l"))
        step = now.join(around, "node").select("node", F.col("component").alias("_was"), F.least("component", "_l").alias("_mid"))
        jump = now.select(F.col("node").alias("_mid"), F.col("component").alias("_far"))
        after = cut(step.join(jump, "_mid").select("node", "_was", F.least("_mid", "_far").alias("component")))
        now = after.select("node", "component")
        if after.filter("component <> _was").isEmpty():
            return now


def _near(ways: DataFrame, key: str, line: str, kind: str, code: str, d: float) -> tuple[DataFrame, DataFrame]:
    """(a, b, ats): points of a within d metres of b, of one kind and another code; (a, n): the points of a."""
    # Kind and code go with the key, so that no table of ways is met, and a point is one number: its leg and its place in it.
    own = ways.filter(F.col(key).isNotNull()).select(F.struct(F.col(key).alias("key"), F.col(kind).alias("kind"), F.col(code).alias("code")).alias("_own"), line)
    legs = lines.segments(own, "_own", line).select("_own.*", "leg", "ax", "ay", "bx", "by")
    mine = lines.stepped(legs.select(F.col("key").alias("a"), F.col("kind").alias("_kind"), F.col("code").alias("_code"), "leg", "ax", "ay", "bx", "by"))
    theirs = legs.select(F.col("key").alias("b"), F.col("kind").alias("_kind"), F.col("code").alias("_other"), *[F.col(c).alias(f"s{c}") for c in ("ax", "ay", "bx", "by")])
    near = lines.near_bits(mine, theirs, ["a", "_code", "leg"], ["b"], d, on=("_kind",), where=F.col("_code") != F.col("_other"))
    near = near.groupBy("a", "b", "leg", "lo").agg(F.bit_or("_bits").alias("_bits")).filter("_bits <> 0")
    places = F.filter(F.sequence(F.lit(0), F.lit(lines.BLOCK - 1)), lambda j: F.getbit("_bits", j) == 1)
    ats = F.transform(places, lambda j: F.shiftleft(F.col("leg").cast("long"), 32) + F.col("lo") + j)
    met = near.groupBy("a", "b").agg(F.array_distinct(F.flatten(F.collect_list(ats))).alias("ats"))
    return met, mine.groupBy("a").agg(F.sum(F.col("last") - F.col("first") + 1).alias("n"))


def split_groups(ways: DataFrame, key: str, line: str, kind: str, code: str, rank: Column, d: float = lines.SAME, ratio: float = lines.RATIO) -> DataFrame:
    """key, kept: records of one authority that run along another's, although the two cut the way differently, and the records kept for each.

    Records of one kind are linked where most of one lies along one of another authority. Linked groups are settled side
    against side: lengths agree within `ratio`, and all of one side lies along the other, which is kept; where both do,
    the side of lesser rank, then the longer, then of the lesser code. A group of which a record has gone in an earlier
    one (by kind and codes) is left alone, as is one whose sides do not agree.
    """
    facts = cut(ways.filter(F.size(line) > 1).select(key, kind, code, rank.alias("_rank"), geo.length_m(F.col(line)).alias("_m")))
    near, counts = _near(ways, key, line, kind, code, d)
    near, counts = cut(near), cut(counts)
    shares = near.select("a", "b", F.size("ats").alias("hit")).join(grown(counts), "a").filter(F.col("hit") >= LINK * F.col("n"))
    one, two = (grown(facts).select(F.col(key).alias(k), F.col(kind).alias(f"_kind_{k}"), F.col(code).alias(f"_code_{k}")) for k in ("a", "b"))
    where = F.struct(F.col("_kind_a").alias("kind"), F.least("_code_a", "_code_b").alias("c1"), F.greatest("_code_a", "_code_b").alias("c2"))
    edges = shares.join(one, "a").join(two, "b").select(F.struct(where.alias("w"), F.col("a").alias("id")).alias("a"), F.struct(where.alias("w"), F.col("b").alias("id")).alias("b"))
    members = cut(components(edges).select(F.col("component").alias("g"), F.col("node.id").alias(key)).join(grown(facts), key))

    # Tables that several steps read are stored: plans stay small, and with them what the driver holds of them.
    sides = members.groupBy("g", code).agg(F.sum("_m").alias("m"), F.min("_rank").alias("rank"), F.count("*").alias("n"))
    held = near.join(members.select(F.col(key).alias("a"), "g"), "a").join(members.select(F.col(key).alias("b"), "g"), ["b", "g"])
    covered = held.groupBy("g", "a").agg(F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("hit")).join(grown(counts), "a").filter("hit = n").select("g", F.col("a").alias(key))
    whole = members.join(covered, ["g", key]).groupBy("g", code).agg(F.count("*").alias("_in")).join(sides, ["g", code]).filter("_in = n").select("g", F.col(code).alias("_gone"))
    fits = sides.groupBy("g").agg(F.sum("n").alias("n"), F.min("m").alias("lo"), F.max("m").alias("hi"), F.count("*").alias("c")).filter((F.col("n") >= GROUP) & (F.col("c") == 2) & (F.col("hi") > 0) & (F.col("lo") >= ratio * F.col("hi"))).select("g")
    choice = sides.join(fits, "g").join(whole, "g").filter(F.col(code) != F.col("_gone")).groupBy("g").agg(F.min(F.struct("rank", (-F.round("m", 3)).alias("less"), F.col(code).alias("keep"))).alias("o")).select("g", F.col("o.keep").alias("_keep"))

    pending, settled = cut(members.join(choice, "g").select("g", key, (F.col(code) != F.col("_keep")).alias("goes"))), None
    while not pending.isEmpty():
        first = pending.withColumn("_first", F.min("g").over(W.partitionBy(key)) == F.col("g")).groupBy("g").agg(F.min("_first").alias("now"))
        now = cut(pending.join(first.filter("now").select("g"), "g"))
        settled = now if settled is None else settled.unionByName(now)
        left = pending.join(first.filter("NOT now").select("g"), "g")
        spoilt = left.join(now.filter("goes").select(key), key, "left_semi").select("g").distinct()
        pending = cut(left.join(spoilt, "g", "left_anti"))
    if settled is None:
        return facts.filter("false").select(key, F.array(key).alias("kept"))
    gone, stays = settled.filter("goes").select("g", F.col(key).alias("a")), settled.filter("NOT goes").select("g", F.col(key).alias("b"))
    along = gone.join(stays, "g").join(near.select("a", "b"), ["a", "b"])
    return along.groupBy(F.col("a").alias(key)).agg(F.sort_array(F.collect_set("b")).alias("kept"))


def paired(ways: DataFrame, key: str, line: str, kind: str, rank: Column, d: float = lines.SAME, ratio: float = lines.RATIO) -> DataFrame:
    """key, kept: records that are another's twin, and that other. Of linked twins the one stays that most others lie along, then the lesser rank, the longer, more points, the lesser key."""
    found = lines.twins(ways, key, line, d, ratio)
    kinds = lambda k: grown(ways).select(F.col(key).alias(k), F.col(kind).alias(f"_{k}"))
    same = cut(found.join(kinds("a"), "a").join(kinds("b"), "b").filter("_a = _b"))
    on = lambda s, o: same.filter((F.col(f"{s}_off") <= d) & (F.col(f"{s}_along") >= lines.TRAVEL)).select(F.col(s).alias("goes"), F.col(o).alias("stays"))
    lies = on("a", "b").unionByName(on("b", "a"))
    groups = components(same.select("a", "b"))
    score = lies.groupBy("stays").agg(F.count("*").alias("_n")).select(F.col("stays").alias("node"), "_n")
    facts = grown(ways).select(F.col(key).alias("node"), rank.alias("_rank"), F.round(geo.length_m(F.col(line)), 3).alias("_m"), F.size(line).alias("_p"))
    order = F.struct((-F.coalesce("_n", F.lit(0))).alias("o1"), F.col("_rank").alias("o2"), (-F.col("_m")).alias("o3"), (-F.col("_p")).alias("o4"), F.col("node").alias("o5"))
    keepers = groups.join(score, "node", "left").join(facts, "node").groupBy("component").agg(F.min(order).alias("k")).select("component", F.col("k.o5").alias("stays"))
    out = groups.join(keepers, "component").select(F.col("node").alias("goes"), "stays").filter("goes <> stays").join(lies.distinct(), ["goes", "stays"])
    return out.select(F.col("goes").alias(key), F.array("stays").alias("kept"))


def merged(ways: DataFrame, key: str, line: str, kind: str, code: str, rank: Column | None = None, d: float = lines.SAME, ratio: float = lines.RATIO) -> tuple[DataFrame, DataFrame]:
    """(ways that stay with `also`: the records that went in their favour, in order; key, kept of those that went).

    `rank`: of two authorities the one of lesser rank keeps its record. Rows without key, or a line of two points, stay
    as they are. A double follows its twin: it went in favour of whatever the twin went for.
    """
    rank = F.lit(0) if rank is None else rank
    rows = ways.filter(F.col(key).isNotNull() & (F.size(line) > 1)).withColumn("_place", F.sha2(F.to_json(F.struct(line)), 256))
    doubles = cut(rows.withColumn("_stays", F.min(key).over(W.partitionBy(kind, code, "_place"))).filter(F.col(key) != F.col("_stays")).select(key, "_stays"))
    single = cut(rows.join(grown(doubles).select(key), key, "left_anti").drop("_place"))
    split = cut(split_groups(single, key, line, kind, code, rank, d, ratio))
    pairs = cut(paired(cut(single.join(split.select(key), key, "left_anti")), key, line, kind, rank, d, ratio))
    later = split.unionByName(pairs)
    # A record kept in the second pass may go in the third: what it was kept for goes along.
    final = later.select(key, F.explode("kept").alias("_k")).join(pairs.select(F.col(key).alias("_k"), F.col("kept").alias("_then")), "_k", "left").select(key, F.explode(F.coalesce("_then", F.array("_k"))).alias("_k")).groupBy(key).agg(F.sort_array(F.collect_set("_k")).alias("kept"))
    moved = doubles.join(final.select(F.col(key).alias("_stays"), "kept"), "_stays", "left").select(key, F.coalesce("kept", F.array("_stays")).alias("kept"))
    gone = cut(final.unionByName(moved))
    also = gone.select(F.col(key).alias("_gone"), F.explode("kept").alias(key)).groupBy(key).agg(F.sort_array(F.collect_set("_gone")).alias("also"))
    stay = ways.join(gone.select(key), key, "left_anti").join(also, key, "left")
    return stay, gone
