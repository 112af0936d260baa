"""Mixing sources to target weights by hierarchical budgets.

The tree is domain, language, source. A node's budget is dealt to its children by weight; a child that
cannot use its share (its tokens times the epochs allowed) takes what it can, and the rest goes to its
siblings by their weights. Only if all of them are short does a shortage reach the parent's siblings,
as a parent's own capacity is the sum of its children's. All of it is whole-number arithmetic.

A leaf's budget buys whole epochs first, then a prefix of one more: documents in the order of a seeded
hash of epoch and id, as long as the running total of tokens stays within the budget. Running totals go
over bins of that hash, at most `BINS` a leaf; only rows of the bin that the budget ends in are ordered
row by row. So a leaf with a third of all rows costs no more than its rows. Texts are not shuffled where
the table of leaves is small enough for Spark to broadcast it.

Defined results: a NULL language, source or domain is a node of its own; a NULL or blank text has no
tokens and is chosen with its epoch, or its place in the prefix; rows with the same id stand or fall
together in a prefix; a weight that is not given is 1, and a weight of 0 gets nothing; an empty table
gives an empty result; further columns stay in `mix` and are ignored in `plan_mix`.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronlake.llm.shared import Workspace, required, whole_text

BIN_BITS = 16
BINS = 1 << BIN_BITS
_HASH_BITS = 60


@dataclass(frozen=True)
class Mix:
    """`domains` maps sources to domains, `others` is the domain of the rest. Weights are whole numbers.
    The budget is `share` percent of all tokens; no document is used in more than `epochs` epochs."""

    domains: Mapping[str, str] = field(default_factory=dict)
    others: str = "other"
    domain_weights: Mapping[str, int] = field(default_factory=dict)
    lang_weights: Mapping[str, int] = field(default_factory=dict)
    source_weights: Mapping[str, int] = field(default_factory=dict)
    share: int = 100
    epochs: int = 1
    seed: int = 17

    def domain(self) -> Column:
        return self._lookup(self.domains, F.col("source"), F.lit(self.others))

    def weight(self, level: str) -> Column:
        given = {"domain": self.domain_weights, "lang": self.lang_weights, "source": self.source_weights}
        return self._lookup(given[level], F.col(level), F.lit(1)).cast("decimal(38,0)")

    @staticmethod
    def _lookup(given: Mapping, column: Column, default: Column) -> Column:
        if not given:
            return default
        pairs = [F.lit(x) for item in given.items() for x in item]
        return F.coalesce(F.element_at(F.create_map(*pairs), column), default)


def n_words(text_column: str = "text") -> Column:
    words = F.split(whole_text(text_column), r"[\x20\x09-\x0D]+")
    return F.size(F.array_remove(words, "")).cast("long")


def _deal(nodes: DataFrame, parents: DataFrame, by: list[str], level: str, mix: Mix) -> DataFrame:
    """Budgets of the children `by + [level]` from those of their parents `by`."""
    inside = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    weight = mix.weight(level)
    rows = nodes.groupBy(*by, level).agg(F.sum("capacity").alias("capacity")).withColumn("w", weight)
    if by:
        same = [rows[c].eqNullSafe(parents[c]) for c in by]
        rows = rows.join(parents, same).select(*[rows[c] for c in (*by, level, "capacity", "w")], "budget")
    else:
        rows = rows.withColumn("budget", parents.scalar())
    # in the order in which children fill up: those before are taken as full
    fill = F.when(F.col("w") > 0, F.col("capacity").cast("double") / F.col("w").cast("double"))
    ordered = inside.orderBy(F.asc_nulls_last(fill), F.asc_nulls_first(level))
    before = F.coalesce(F.sum("capacity").over(ordered.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("w").over(ordered.rowsBetween(0, W.unboundedFollowing))
    full = (F.col("w") > 0) & (
        F.col("capacity") * F.col("open_weight") <= (F.col("budget") - F.col("before")) * F.col("w")
    )
    rows = rows.withColumns({"before": before, "open_weight": open_weight}).withColumn("full", full)
    spent = F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(inside), F.lit(0))
    sharing = F.sum(F.when(~F.col("full"), F.col("w"))).over(inside)
    rows = rows.withColumns({"left": F.col("budget") - spent, "sharing": sharing})
    part = F.expr("`left` * w div nullif(sharing, 0)")
    dealt = F.when(F.col("full"), F.col("capacity")).otherwise(F.coalesce(part, F.lit(0)))
    return rows.select(*by, level, dealt.cast("decimal(38,0)").alias("budget"))


def leaf_budgets(supply: DataFrame, mix: Mix) -> DataFrame:
    """Budgets in tokens of leaves (domain, lang, source, tokens long)."""
    number = "decimal(38,0)"
    nodes = supply.withColumn("capacity", (F.col("tokens") * F.lit(mix.epochs)).cast(number))
    total = supply.agg(
        F.expr(f"coalesce(sum(cast(tokens as {number})), 0) * {mix.share} div 100").cast(number).alias("budget")
    )
    domains = _deal(nodes, total, [], "domain", mix)
    langs = _deal(nodes, domains, ["domain"], "lang", mix)
    leaves = _deal(nodes, langs, ["domain", "lang"], "source", mix)
    return leaves.withColumn("budget", F.col("budget").cast("long"))


def _place(mix: Mix, epoch: Column, doc: Column) -> Column:
    text = F.concat_ws(":", F.lit(mix.seed).cast("string"), epoch.cast("string"), F.coalesce(doc.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _leaf() -> Column:
    """One value for the leaf; NULLs are told from words."""
    return F.to_json(F.struct("domain", "lang", "source"))


def plan_mix(docs: DataFrame, mix: Mix, space: Workspace) -> tuple[DataFrame, DataFrame]:
    """(rows, cuts). rows: doc_id, domain, lang, source, leaf, n_tokens of all documents. cuts: by leaf,
    the whole epochs and the last (place, id) of the partial one that the budget buys."""
    narrow = required(docs, "doc_id", "lang", "source", "text")
    rows = space.put(
        "rows",
        narrow.select("doc_id", mix.domain().alias("domain"), "lang", "source", n_words().alias("n_tokens"))
        .withColumn("leaf", _leaf()),
    )
    supply = rows.groupBy("leaf", "domain", "lang", "source").agg(F.sum("n_tokens").alias("tokens"))
    supply = space.put("supply", supply)
    budgets = leaf_budgets(supply, mix).withColumn("leaf", _leaf())
    tokens = F.greatest(F.col("tokens"), F.lit(1))
    wanted = space.put(
        "wanted",
        supply.join(budgets.select("leaf", "budget"), "leaf").select(
            "leaf", F.expr("budget div greatest(tokens, 1)").alias("whole"), (F.col("budget") % tokens).alias("rest"),
        ),
    )
    placed = (
        rows.join(wanted, "leaf")
        .withColumn("place", _place(mix, F.col("whole") + 1, F.col("doc_id")))
        .withColumn("bin", F.shiftright("place", _HASH_BITS - BIN_BITS))
    )
    in_leaf = W.partitionBy("leaf").orderBy("bin")
    bins = placed.groupBy("leaf", "bin").agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"))
    ends = (
        bins.withColumn("upto", F.sum("n").over(in_leaf))
        .groupBy("leaf")
        .agg(
            F.min(F.when(F.col("upto") > F.col("rest"), F.struct("bin", (F.col("rest") - F.col("upto") + F.col("n")).alias("left")))).alias("end")
        )
        .select("leaf", F.col("end.bin").alias("last_bin"), F.col("end.left").alias("left"))
    )
    ends = space.put("ends", ends)
    id_order = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    inside = (
        placed.join(ends, "leaf").filter(F.col("bin") == F.col("last_bin"))
        .withColumn("id_order", id_order)
        .withColumn("upto", F.sum("n_tokens").over(
            W.partitionBy("leaf").orderBy(F.struct("place", "id_order")).rangeBetween(W.unboundedPreceding, W.currentRow)))
        .filter(F.col("upto") <= F.col("left"))
        .groupBy("leaf").agg(F.max(F.struct("place", "id_order")).alias("last"))
    )
    cuts = space.put(
        "cuts",
        wanted.join(ends, "leaf", "left").join(inside, "leaf", "left")
        .select("leaf", "whole", "rest", "last_bin", "last"),
    )
    return rows, cuts


def _chosen(rows: DataFrame, cuts: DataFrame, mix: Mix) -> DataFrame:
    """`rows` (doc_id, leaf, ...) once for each epoch they are used in, with `epoch`."""
    joined = rows.join(cuts.withColumnRenamed("leaf", "__leaf"), F.col("leaf") == F.col("__leaf")).drop("__leaf")
    place = _place(mix, F.col("whole") + 1, F.col("doc_id"))
    here = F.struct(place.alias("place"), F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("id_order"))
    bin_ = F.shiftright(place, _HASH_BITS - BIN_BITS)
    in_part = (F.col("rest") > 0) & (
        F.col("last_bin").isNull() | (bin_ < F.col("last_bin")) | F.coalesce(here <= F.col("last"), F.lit(False))
    )
    used = F.col("whole") + F.when(in_part, 1).otherwise(0)
    return (
        joined.filter((used > 0) & (F.col("whole") >= 0))
        .withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), used)))
        .drop("whole", "rest", "last_bin", "last")
    )


def mix_rows(docs: DataFrame, mix: Mix) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, epoch): every use of every chosen document."""
    space = Workspace(docs.sparkSession, "mix")
    rows, cuts = plan_mix(docs, mix, space)
    return _chosen(rows, cuts, mix).drop("leaf")


def mix(docs: DataFrame, spec: Mix) -> DataFrame:
    """The chosen documents with their own columns, once for each epoch."""
    space = Workspace(docs.sparkSession, "mix")
    _, cuts = plan_mix(docs, spec, space)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    leaves = docs.select("doc_id", spec.domain().alias("domain"), "lang", "source", own)
    leaves = leaves.select("doc_id", _leaf().alias("leaf"), "own")
    return _chosen(leaves, cuts, spec).select("own.*")
