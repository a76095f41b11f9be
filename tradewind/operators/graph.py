"""Flow graphs: links between countries, codes and ports, and numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.cube import pair_rollups
from tradewind.operators.dims import node_label
from tradewind.operators.filters import select_unit
from tradewind.operators.ordering import global_rank
from tradewind.sources.stage import stage

# Links in drawing order; the first name is the source.
FULL_INBOUND = (("country", "comcode"), ("comcode", "port"))
FULL_OUTBOUND = (("comcode", "country"), ("port", "comcode"))
COUNTRY_PORT_INBOUND = (("country", "port"),)
COUNTRY_PORT_OUTBOUND = (("port", "country"),)
EU_INBOUND = (("country", "comcode"),)
EU_OUTBOUND = (("comcode", "country"),)


def ends_of(steps) -> tuple[str, ...]:
    """The columns a graph needs of its cube; months are not among them."""
    return tuple(sorted({c for s in steps for c in s}))


def stack_links(cube: DataFrame, steps, unit: str = "price", zero_weight: str = "null") -> DataFrame:
    """``step, source, target, value`` over all months in the cube."""
    pairs = select_unit(pair_rollups(cube, steps, with_month=False), unit, zero_weight)

    def end(i: int):
        out = F.when(F.col("step") == 0, F.col(steps[0][i]))
        for n, s in enumerate(steps[1:], 1):
            out = out.when(F.col("step") == n, F.col(s[i]))
        return out

    return pairs.select("step", end(0).alias("source"), end(1).alias("target"), "value")


def graph_nodes(links: DataFrame) -> DataFrame:
    """``id, name``: names numbered from 0 by first appearance, all sources before all targets.

    Within a step links are sorted by source and target, so a name's first appearance is the least
    (step, source) as a source or (step, source, target) as a target: one aggregate, no sort of the links.
    """
    def end(name: str, kind: int, k2):
        at = F.struct(F.lit(kind).alias("kind"), "step", F.col("source").alias("k1"), k2.alias("k2"))
        return F.struct(F.col(name).alias("name"), at.alias("at"))

    ends = F.array(end("source", 0, F.lit("")), end("target", 1, F.col("target")))
    first = (links.select(F.explode(ends).alias("e"))
                  .groupBy(F.col("e.name").alias("name")).agg(F.min("e.at").alias("at"))
                  .select("name", "at.kind", "at.step", "at.k1", "at.k2"))
    return global_rank(first, ["kind", "step", "k1", "k2"]).select("id", "name")


def graph_links(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links with node numbers in place of names."""
    source = nodes.select(F.col("name").alias("source"), F.col("id").alias("source_id"))
    target = nodes.select(F.col("name").alias("target"), F.col("id").alias("target_id"))
    return links.join(source, "source").join(target, "target").select("source_id", "target_id", "value")


def flow_graph(cube: DataFrame, steps, lookup: DataFrame, unit: str = "price") -> tuple[DataFrame, DataFrame]:
    """Nodes (``id, name, label``) and links (``source_id, target_id, value``).

    Nodes and links both start from the stacked links, which are written once, like the nodes.
    """
    links = stage(stack_links(cube, steps, unit), "links")
    nodes = stage(graph_nodes(links), "nodes")
    return node_label(nodes, lookup), graph_links(links, nodes)
