"""Answers: field comparison, usage and timing, attempts, nodes of an inference graph."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafline.functions import identity, prompts
from sheafline.plans import schema as S


def as_fields(answer: Column) -> Column:
    """map<string, string> of canonical JSON by field of a variant; anything but an object is the one
    field ``value``. A field of JSON null is there, with the text null."""
    members = F.try_variant_get(answer, "$", "map<string,variant>")
    told = F.transform_values(members, lambda _, v: F.coalesce(F.to_json(v), F.lit("null")))
    is_object = F.coalesce(F.schema_of_variant(answer).startswith("OBJECT"), F.lit(False))
    return F.when(is_object, told).otherwise(F.create_map(F.lit("value"), F.coalesce(F.to_json(answer), F.lit("null"))))


def compare(left: DataFrame, right: DataFrame, key: str, fields: str = "fields") -> DataFrame:
    """(key, field, left, right, agrees, agreement): the fields of two answers met on their names.

    Equal on both sides agrees, null on both too; a field that one side lacks never does. left, right:
    (key, fields map<string, string>).
    """
    side = lambda df, name: df.select(key, F.explode(fields).alias("field", name)).withColumn(f"_{name}", F.lit(True))
    both = side(left, "left").join(side(right, "right"), [key, "field"], "full")
    there = F.col("_left").isNotNull() & F.col("_right").isNotNull()
    agrees = there & F.col("left").eqNullSafe(F.col("right"))
    return both.select(key, "field", "left", "right", agrees.alias("agrees"), agrees.cast("double").alias("agreement"))


def merge_usage(records: DataFrame, keys: list[str]) -> DataFrame:
    """Usage summed over what was measured; null where nothing was."""
    return records.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("input_tokens", "output_tokens", "total_tokens", "cached_tokens", "estimated_cost")])


def merge_provider_usage(records: DataFrame, keys: list[str], order: str) -> DataFrame:
    """(keys, provider_usage): maps merged, the last record's value of a name winning."""
    rows = records.select(*keys, order, F.explode("provider_usage").alias("name", "value"))
    last = rows.groupBy(*keys, "name").agg(F.max_by("value", order).alias("value"))
    return last.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("provider_usage"))


def merge_timing(records: DataFrame, keys: list[str]) -> DataFrame:
    """Times summed over what was measured; total_time is 0 where nothing was."""
    return records.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("queue_time", "load_time", "inference_time")],
        F.coalesce(F.sum("total_time"), F.lit(0.0)).alias("total_time"),
    )


def attempt_log(calls: DataFrame, keys: list[str], order: list[str], node: Column, limit: int = S.ATTEMPTS) -> DataFrame:
    """Attempts in order with number and id, up to the first that needs no other one.

    calls: (keys, order, error_type). A call stops after a success, a failure that no attempt mends, or
    the limit; what a log holds beyond that is left out.
    """
    by = Window.partitionBy(*keys).orderBy(*order)
    again = prompts.should_retry(F.col("error_type"), F.col("attempt"), F.lit(limit))
    # min over the earlier attempts: true if each of them asked for another.
    earlier = F.coalesce(F.min(F.col("_again")).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    return (
        calls.withColumn("attempt", F.row_number().over(by))
        .withColumn("_again", again)
        .withColumn("_open", earlier)
        .where("_open")
        .withColumn("attempt_id", identity.attempt_id(node, F.col("attempt")))
        .withColumn("validation", prompts.attempt_state(F.col("error_type")))
        .drop("_again", "_open")
    )


def cached_results(results: DataFrame, requests: DataFrame) -> DataFrame:
    """Results of nodes that a run may use again: good, valid, with an answer, under the same key."""
    good = results.where("status = 'SUCCESS' and result is not null and validation = 'VALID' and request_key is not null")
    return good.join(requests.select("node_id", "request_key"), ["node_id", "request_key"], "left_semi")


def contradictions(status: Column, attempts: Column, schema_valid: Column, violations: Column, errors: Column) -> Column:
    """array<string>: in which ways a result contradicts itself; one that does was never an answer."""
    rules = (
        ((status == "SUCCESS") & (attempts == 0), "a successful run recorded no attempt"),
        (schema_valid & (violations > 0), "a valid schema verdict carries violations"),
        (~schema_valid & (violations == 0), "an invalid schema verdict names no violation"),
        ((status == "FAILED") & (errors == 0), "a failed run recorded no typed error"),
    )
    return F.filter(F.array(*[F.when(holds, F.lit(told)) for holds, told in rules]), lambda x: x.isNotNull())


class GraphError(ValueError):
    """A graph that cannot be run as it is described."""


@dataclass(frozen=True)
class Node:
    node_id: str
    depends_on: tuple[str, ...]
    task: str
    template: str
    schema: str | Mapping | None


@dataclass(frozen=True)
class Graph:
    graph_id: str
    graph_version: str
    nodes: tuple[Node, ...]


def _name(value, field: str) -> str:
    if not isinstance(value, str) or not value.strip():
        raise GraphError(f"DEPENDENCY_ERROR: the graph descriptor states no {field}")
    return value


def _known(described: Mapping, keys: frozenset[str], what: str) -> None:
    unknown = sorted(set(described) - keys)
    if unknown:
        raise GraphError(f"DEPENDENCY_ERROR: {what} uses keys that are not supported: {', '.join(unknown)}")


def compile_graph(descriptor: Mapping | None) -> Graph:
    """A descriptor's nodes in their order; ``default_graph()`` is one. Whatever it leaves unclear is refused:
    no descriptor, id, version or nodes, unknown keys, a node without a template, an id that is repeated, a
    dependency that doesn't stand before."""
    if descriptor is None:
        raise GraphError("DEPENDENCY_ERROR: a graph run needs a graph descriptor")
    graph_id, version = _name(descriptor.get("graph_id"), "graph_id"), _name(descriptor.get("graph_version"), "graph_version")
    _known(descriptor, S.GRAPH_KEYS, f"the graph {graph_id}")
    declared = descriptor.get("nodes")
    if not isinstance(declared, list) or not declared:
        raise GraphError("DEPENDENCY_ERROR: the graph descriptor declares no nodes")
    found: dict[str, Node] = {}
    for entry in declared:
        if not isinstance(entry, Mapping):
            raise GraphError("DEPENDENCY_ERROR: a declared node is not a mapping")
        node = _name(entry.get("node_id"), "node_id")
        if node in found:
            raise GraphError(f"DEPENDENCY_ERROR: the graph declares {node} twice")
        _known(entry, S.NODE_KEYS, f"the node {node}")
        needs = entry.get("depends_on", [])
        if not isinstance(needs, list):
            raise GraphError(f"DEPENDENCY_ERROR: {node} declares a depends_on that is not a list")
        late = [str(n) for n in needs if n not in found]
        if late:
            raise GraphError(f"DEPENDENCY_ERROR: {node} depends on nodes that do not precede it: {', '.join(late)}")
        found[node] = Node(node, tuple(needs), _name(entry.get("task", node), "task"), _name(entry.get("template"), "template"), entry.get("schema"))
    return Graph(graph_id, version, tuple(found.values()))


def default_graph() -> dict:
    """The descriptor of the documented chain."""
    nodes = [{"node_id": n, "task": n, "template": "simple_extract", "schema": "simple", "depends_on": list(needs)} for n, needs in S.DEFAULT_GRAPH.items()]
    return {"graph_id": "default_inference", "graph_version": "1", "nodes": nodes}


def compared_pairs(graph: Graph) -> list[tuple[str, str, str]]:
    """(node, left, right): neighbours among what a node needs, whose answers are compared."""
    return [(n.node_id, a, b) for n in graph.nodes for a, b in zip(n.depends_on, n.depends_on[1:])]


def collect_deltas(deltas: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, channel, text): the pieces of streamed answers joined in their order, by channel."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda s: s["text"]), "")
    return deltas.groupBy(*keys, "channel").agg(joined.alias("text"))
