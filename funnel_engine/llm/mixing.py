"""Mixing sources to target weights down a domain-language-source tree.

Every node has an integer weight among its siblings and a capacity: its tokens
times the largest number of epochs. A budget goes from the root down; at each
node it is split among the children by weight, and what a child cannot use goes
to its siblings by their weights. A node never gets more than its whole subtree
can use, so only a shortage of all siblings together reaches the level above.

A leaf repeats its documents for as many whole epochs as its share holds, then
takes a prefix of one more epoch, whose order is seeded by the MD5 of seed,
epoch and document id. All arithmetic is on integers; shares are rounded down.

A document belongs to the prefix if its first token does; ``taken`` says how many
of its tokens do. Rows with one id in one leaf stand at the same place of the
order and go together. Documents without tokens are never taken; very long ones count
with all their tokens. Null level values are the node ``(none)``; a null id counts as an
empty one. Siblings with equal capacity per weight fill up together. An empty table gives
an empty mix.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, stored, table

LEVELS = ("domain", "lang", "source")
#: Target weights of the first two levels; other names and all sources weigh 1.
WEIGHTS: dict[str, dict[str, int]] = {
    "domain": {"web": 5, "forum": 3, "reference": 2},
    "lang": {"en": 6, "de": 2, "fr": 2},
}
MAX_EPOCHS = 3
#: The mix holds so many tokens for each hundred of the input.
PERCENT = 100
SEED = 7
#: Documents per piece of a leaf's order; a leaf has as many pieces as it needs.
PIECE = 4096

#: So many siblings are shared among in one task; of more, sums over ranges meet there.
SIBLINGS = 10_000
#: Ranges of capacity per weight to a doubling, in which siblings are summed up.
RANGES = 1024

_BIG = "decimal(38,0)"


def domain_of(source: Column) -> Column:
    """Domains of the test sources, by the last digit of their names."""
    last = F.substring(source, -1, 1)
    return F.when(last.between("0", "3"), "web").when(last.between("4", "6"), "forum").otherwise("reference")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _named(levels: Mapping[str, Column]) -> list[Column]:
    return [F.coalesce(c.cast("string"), F.lit("(none)")).alias(f"_{k}") for k, c in levels.items()]


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    w = F.lit(1)
    for name, x in (weights.get(level) or {}).items():
        w = F.when(F.col(f"_{level}") == name, F.lit(x)).otherwise(w)
    return w.cast("bigint")


def share_listed(nodes: DataFrame, parents: Sequence[str]) -> DataFrame:
    """Split ``budget`` (of each parent) among sibling rows by ``weight`` within their ``capacity``; adds ``given``.

    Siblings fill up in the order of capacity per weight. Those that the level
    reached so far fills get their capacity, the others share the rest by weight.
    Each parent's children meet in one task.
    """
    family = Window.partitionBy(*parents)
    before = family.orderBy(F.col("capacity").cast("double") / F.col("weight"), "name").rowsBetween(Window.unboundedPreceding, -1)
    big = lambda c: F.col(c).cast(_BIG)
    left = big("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    heavy = F.sum("weight").over(family) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rest = big("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(family), F.lit(0))
    rest_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(family)
    columns = nodes.columns
    nodes = nodes.where("weight > 0").withColumn("full", big("capacity") * heavy <= big("weight") * left)
    return _given(nodes.withColumn("rest", rest).withColumn("rest_weight", rest_weight), columns)


def _given(nodes: DataFrame, columns: Sequence[str]) -> DataFrame:
    part = F.expr(f"(cast(weight as {_BIG}) * cast(rest as {_BIG})) div cast(rest_weight as {_BIG})")
    return nodes.select(*columns, F.when(F.col("full"), F.col("capacity")).otherwise(part).cast("bigint").alias("given"))


def share_out(nodes: DataFrame, parents: Sequence[str]) -> DataFrame:
    """The same as ``share_listed``, for any number of siblings.

    The level is found from sums, not from a list of siblings: those with the same
    capacity and weight share one fate, and sums over ranges of capacity per weight
    (``RANGES`` to a doubling) tell which ranges fill up as a whole and which not at
    all. Only a range in which the level ends is looked at in detail.
    """
    family, columns = parents or ["_root"], nodes.columns
    nodes = nodes.where("weight > 0").withColumn("_ratio", F.col("capacity").cast("double") / F.col("weight"))
    if not parents:
        nodes = nodes.withColumn("_root", F.lit(0))
    big = lambda c: F.col(c).cast(_BIG)
    place = F.coalesce(F.floor(F.log2("_ratio") * RANGES), F.lit(-1))  # no logarithm of 0
    like = nodes.groupBy(*family, "capacity", "weight", "_ratio").agg(F.count("*").alias("_n"), F.any_value("budget").alias("budget"))
    like = stored(like.withColumn("_range", place).withColumn("_c", big("capacity") * F.col("_n")).withColumn("_w", big("weight") * F.col("_n")), "mix-siblings")
    ranges = like.groupBy(*family, "_range").agg(
        F.sum("_c").alias("_cs"), F.sum("_w").alias("_ws"), F.min("_ratio").alias("_lo"), F.max("_ratio").alias("_hi"), F.any_value("budget").alias("budget")
    )
    earlier = Window.partitionBy(*family).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_left", big("budget") - F.coalesce(F.sum("_cs").over(earlier), F.lit(0))).withColumn(
        "_heavy", F.sum("_ws").over(Window.partitionBy(*family)) - F.coalesce(F.sum("_ws").over(earlier), F.lit(0))
    )
    # Doubles decide only where a hair more or less would not matter.
    left, heavy = F.col("_left"), F.col("_heavy")
    none = F.col("_lo") * heavy.cast("double") * (1 - 1e-9) > left.cast("double")
    rest, rest_heavy = left - F.col("_cs"), heavy - F.col("_ws")
    every = (rest >= 0) & (F.col("_hi") * rest_heavy.cast("double") * (1 + 1e-9) <= rest.cast("double"))
    ranges = ranges.select(*family, "_range", "_left", "_heavy", F.when(every, True).when(~none, None).otherwise(False).alias("_all"))
    like = like.join(ranges, [*family, "_range"])
    before = Window.partitionBy(*family, "_range").orderBy("_ratio").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_left") - F.coalesce(F.sum("_c").over(before), F.lit(0))
    heavy = F.col("_heavy") - F.coalesce(F.sum("_w").over(before), F.lit(0))
    full = big("capacity") * heavy <= big("weight") * left
    kept = [*family, "capacity", "weight", "_c", "_w", "budget"]
    fate = like.where("_all IS NULL").select(*kept, full.alias("full")).union(like.where("_all IS NOT NULL").select(*kept, F.col("_all").alias("full")))
    fate = stored(fate, "mix-fates")
    rests = fate.groupBy(*family).agg(
        (F.any_value(big("budget")) - F.coalesce(F.sum(F.when(F.col("full"), F.col("_c"))), F.lit(0))).alias("rest"),
        F.sum(F.when(~F.col("full"), F.col("_w"))).alias("rest_weight"),
    )
    nodes = nodes.join(fate.select(*family, "capacity", "weight", "full"), [*family, "capacity", "weight"]).join(rests, family)
    return _given(nodes, columns)


def mix_plan(
    docs: DataFrame,
    levels: Mapping[str, Column],
    tokens: Column,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    percent: int = PERCENT,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    id_col: str = "doc_id",
    piece: int = PIECE,
    siblings: int = SIBLINGS,
) -> DataFrame:
    """One row per leaf: its share, whole epochs, and where the prefix of the next epoch ends."""
    names = [f"_{k}" for k in levels]
    rows = stored(docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), *_named(levels), tokens.alias("_tokens")), "mix-rows")
    leaves = stored(rows.groupBy(*names).agg(F.sum("_tokens").alias("tokens"), F.count("*").alias("docs")), "mix-leaves")
    total, n_leaves = leaves.agg(F.sum("tokens"), F.count("*")).first()
    total = total or 0
    # No parent has more children than there are leaves.
    few = n_leaves <= siblings
    plan = None
    for depth, level in enumerate(levels):
        parents, keys = names[:depth], names[: depth + 1]
        nodes = leaves.groupBy(*keys).agg((F.sum("tokens") * max_epochs).alias("capacity"))
        nodes = nodes.withColumn("weight", _weight(level, weights)).withColumn("name", F.col(names[depth]))
        if plan is None:
            nodes = nodes.withColumn("budget", F.lit(min(total * percent // 100, total * max_epochs)))
        else:
            nodes = nodes.join(plan, parents)
        plan = (share_listed(nodes, parents) if few else share_out(stored(nodes, "mix-nodes"), parents)).select(*keys, F.col("given").alias("budget"))
        plan = plan if few else stored(plan, "mix-shares")
    plan = stored(
        leaves.where("tokens > 0").join(plan, names).select(
            *names, "tokens", "docs", F.col("budget").alias("share"), F.expr("budget div tokens").alias("epochs"), F.expr("budget % tokens").alias("prefix")
        ),
        "mix-shares",
    )
    # Prefix sums in two steps, so that no window holds a whole leaf: pieces of the hash range, then ids within a piece.
    place = _place(F.lit(seed), F.col("epochs") + 1, F.col("_id"))
    pieces = F.ceil(F.col("docs") / piece)
    units = (
        rows.where("_tokens > 0").join(plan.where("prefix > 0"), names)
        .withColumn("place", place)
        .withColumn("piece", F.floor(F.conv(F.substring("place", 1, 8), 16, 10).cast("bigint") * pieces / F.lit(2**32)))
        .groupBy(*names, "piece", "place", "prefix")
        .agg(F.sum("_tokens").alias("n"))
    )
    sums = units.groupBy(*names, "piece").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy(*names).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*names, "piece", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy(*names, "piece").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("ahead") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    cuts = (
        units.join(sums, [*names, "piece"]).withColumn("at", ahead).where("at < prefix")
        .groupBy(*names)
        .agg(F.max(F.struct("place", (F.col("prefix") - F.col("at")).alias("left"))).alias("cut"))
    )
    return plan.join(cuts, names, "left").select(*names, "tokens", "share", "epochs", "prefix", F.col("cut.place").alias("last"), F.col("cut.left").alias("left"))


def _place(seed: Column, epoch: Column, doc: Column) -> Column:
    return F.md5(F.concat_ws(":", seed.cast("string"), epoch.cast("string"), doc))


def mix(
    docs: DataFrame,
    levels: Mapping[str, Column],
    tokens: Column,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    percent: int = PERCENT,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    id_col: str = "doc_id",
) -> DataFrame:
    """The chosen rows of ``docs`` with all their columns, once per epoch, and ``mix_epoch``, ``mix_tokens`` and ``mix_taken``
    (which replace input columns of these names)."""
    # One small row per leaf; read back so that the planner knows its size before it chooses the join.
    plan = stored(mix_plan(docs, levels, tokens, weights, percent, max_epochs, seed, id_col), "mix-plan")
    names = [f"_{k}" for k in levels]
    plan = plan.select(F.struct(*names).alias("_leaf"), F.struct("epochs", "last", "left").alias("_plan"))
    # The row travels as one struct, so that its columns clash with none made here.
    columns = [c for c in docs.columns if c.lower() not in ("mix_epoch", "mix_tokens", "mix_taken")]
    doc = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    own = docs.select(F.struct(*columns).alias("_doc"), F.struct(*_named(levels)).alias("_leaf"), tokens.alias("_tokens"), doc.alias("_id"))
    own = own.where("_tokens > 0").join(plan, "_leaf")
    epochs, at = F.col("_plan.epochs"), F.col("_plan.last")
    whole = F.transform(F.sequence(F.lit(1), epochs), lambda e: F.struct(e.cast("bigint").alias("epoch"), F.col("_tokens").alias("taken")))
    own = own.withColumn("_place", _place(F.lit(seed), epochs + 1, F.col("_id")))
    taken = F.when(F.col("_place") < at, F.col("_tokens")).when(F.col("_place") == at, F.least("_tokens", F.col("_plan.left").cast("bigint")))
    last = F.struct((epochs + 1).cast("bigint").alias("epoch"), taken.alias("taken"))
    none = F.array().cast("array<struct<epoch:bigint,taken:bigint>>")
    own = own.withColumn("_rows", F.concat(F.when(epochs > 0, whole).otherwise(none), F.when(taken.isNotNull(), F.array(last)).otherwise(none)))
    return own.select("_doc", "_tokens", F.inline("_rows").alias("_epoch", "_taken")).select(
        "_doc.*", F.col("_tokens").alias("mix_tokens"), F.col("_epoch").alias("mix_epoch"), F.col("_taken").alias("mix_taken")
    )


def document_levels() -> dict[str, Column]:
    return {"domain": domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return mix(docs, document_levels(), n_words(F.col("text"))).select("doc_id", "mix_epoch", "mix_tokens", "mix_taken")


def _share_sql(level: int) -> str:
    """The same water-filling for one level, over ``n<level>(keys, weight, capacity, budget)``."""
    keys = ", ".join(LEVELS[: level + 1])
    family = f"PARTITION BY {', '.join(LEVELS[:level])}" if level else ""
    before = f"({family} ORDER BY capacity::DOUBLE / weight, {LEVELS[level]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""
f{level} AS (SELECT *, capacity::HUGEINT * (sum(weight) OVER ({family}) - coalesce(sum(weight) OVER {before}, 0))
    <= weight::HUGEINT * (budget - coalesce(sum(capacity) OVER {before}, 0)) AS filled FROM n{level}),
r{level} AS (SELECT *, budget - coalesce(sum(CASE WHEN filled THEN capacity END) OVER ({family}), 0) AS rest,
    sum(CASE WHEN NOT filled THEN weight END) OVER ({family}) AS rest_weight FROM f{level}),
g{level} AS (SELECT {keys}, (CASE WHEN filled THEN capacity ELSE weight::HUGEINT * rest // rest_weight END)::BIGINT AS given FROM r{level})"""


def _weight_sql(level: str) -> str:
    return f"CASE {level} {' '.join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS[level].items())} ELSE 1 END" if WEIGHTS.get(level) else "1"


def _nodes_sql(level: int) -> str:
    keys = ", ".join(f"l.{k}" for k in LEVELS[: level + 1])
    budget = "g.given" if level else f"least((SELECT sum(tokens) * {PERCENT} // 100 FROM leaves), (SELECT sum(tokens) * {MAX_EPOCHS} FROM leaves))"
    join = f"JOIN g{level - 1} g USING ({', '.join(LEVELS[:level])})" if level else ""
    keys = ", ".join(LEVELS[: level + 1])
    return f"""
n{level} AS (SELECT {keys}, {_weight_sql(LEVELS[level])} AS weight, (sum(tokens) * {MAX_EPOCHS})::BIGINT AS capacity, any_value({budget}) AS budget
    FROM leaves {join} GROUP BY {keys}),"""


OP1_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
    CASE WHEN right(source, 1) BETWEEN '0' AND '3' THEN 'web' WHEN right(source, 1) BETWEEN '4' AND '6' THEN 'forum' ELSE 'reference' END AS domain,
    coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS n FROM documents
), leaves AS (SELECT domain, lang, source, sum(n)::BIGINT AS tokens FROM d GROUP BY ALL),
{','.join(_nodes_sql(k) + _share_sql(k) for k in range(3))},
p AS (SELECT domain, lang, source, given // tokens AS epochs, given % tokens AS prefix FROM leaves JOIN g2 USING (domain, lang, source) WHERE tokens > 0),
o AS (SELECT d.doc_id, d.n, epochs, prefix,
    sum(n) OVER (PARTITION BY domain, lang, source ORDER BY md5('{SEED}:' || (epochs + 1) || ':' || coalesce(doc_id::VARCHAR, ''))
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ahead
    FROM d JOIN p USING (domain, lang, source) WHERE n > 0)
SELECT doc_id, e::BIGINT AS mix_epoch, n AS mix_tokens, n AS mix_taken FROM o, unnest(range(1, epochs + 1)) AS t(e)
UNION ALL
SELECT doc_id, (epochs + 1)::BIGINT, n, least(n, prefix - coalesce(ahead, 0))::BIGINT FROM o WHERE coalesce(ahead, 0) < prefix
"""
