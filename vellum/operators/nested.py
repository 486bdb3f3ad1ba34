"""Problem 3: deeply nested records as related flat tables.

Every record's tree is walked depth first once; each element gets an interval label - its pre-order and its
post-order number - and goes into the node table of its type (pages, regions or blocks, lines, texts).  A
node encloses another if its pre-order number is smaller and its post-order number larger; a row's parent
is the nearest enclosing node of the parent type.  One pass over the nodes in pre-order finds it: a stack holds
the intervals that are still open, and those that end before a node are closed first (``enclosing``), so a record's
parents cost its nodes times its depth.

Of each key the latest well-formed record counts; NULL, empty or cut-off records are none, and a key without a
well-formed record gives no row.  Ids that are missing are ''; ids need to be unique under their parent only, as the
links are the interval labels.  Namespaces and unknown elements are passed over."""

from __future__ import annotations

from collections.abc import Iterator
from xml.etree import ElementTree
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.sources.tables import table

# Local names of the elements of each node table.
PAGES = {"Page"}
REGIONS = {"TextRegion", "ComposedBlock", "TextBlock"}
LINES = {"TextLine"}
TEXTS = {"String", "Unicode"}
_KIND = {**dict.fromkeys(PAGES, "page"), **dict.fromkeys(REGIONS, "region"), **dict.fromkeys(LINES, "line"), **dict.fromkeys(TEXTS, "text")}

_NODE = pa.struct([("kind", pa.string()), ("tag", pa.string()), ("id", pa.string()), ("pre", pa.int32()), ("post", pa.int32()), ("points", pa.string()), ("value", pa.string()), ("conf", pa.string()), ("up", pa.struct([(k, pa.struct([("pre", pa.int32()), ("id", pa.string())])) for k in ("page", "region", "line")]))])
_UP = "STRUCT<pre: INT, id: STRING>"
NODE_DDL = (
    "ARRAY<STRUCT<kind: STRING, tag: STRING, id: STRING, pre: INT, post: INT, points: STRING, value: STRING, conf: STRING, "
    f"up: STRUCT<page: {_UP}, region: {_UP}, line: {_UP}>>>"
)


def label_nodes(xml: str | None) -> list[dict] | None:
    """Interval-labelled nodes of a record in document order; None if it isn't well formed."""
    if not xml or not xml.strip():
        return None
    nodes: list[dict] = []
    stack: list[dict | None] = []
    state = {"pre": 0, "post": 0}
    parser = expat.ParserCreate(namespace_separator="}")
    parser.buffer_text = True

    def start(name: str, attrs: dict) -> None:
        tag = name.rsplit("}", 1)[-1].rsplit(":", 1)[-1]
        kind = _KIND.get(tag)
        node = None
        if kind:
            get = lambda *names: next((attrs[n] for n in names if n in attrs), None)
            node = {"kind": kind, "tag": tag, "id": get("id", "ID") or "", "pre": state["pre"], "post": 0, "points": None, "value": get("CONTENT", "imageFilename"), "conf": get("WC", "conf", "PC")}
            nodes.append(node)
        elif tag in ("Coords", "Polygon"):
            owner = next((x for x in reversed(stack) if x), None)
            if owner is not None and owner["points"] is None:
                owner["points"] = attrs.get("points") or attrs.get("POINTS")
        state["pre"] += 1
        stack.append(node)

    def end(_name: str) -> None:
        node = stack.pop()
        if node is not None:
            node["post"] = state["post"]
        state["post"] += 1

    def text(data: str) -> None:
        node = stack[-1] if stack else None
        if node is not None and node["tag"] == "Unicode":
            node["value"] = (node["value"] or "") + data

    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, text
    try:
        # a declared encoding says nothing of a string that is already decoded
        parser.Parse(xml.encode("utf-8", "surrogatepass") if "encoding=" not in xml[: xml.find("?>") + 1] else _without_declaration(xml), True)
    except (expat.ExpatError, ElementTree.ParseError, ValueError):
        return None
    return enclosing(nodes)


def enclosing(nodes: list[dict]) -> list[dict]:
    """The nodes, in pre-order, each with ``up``: for each type, the nearest node whose interval contains its own."""
    open_: list[dict] = []
    for node in nodes:
        while open_ and open_[-1]["post"] < node["post"]:
            open_.pop()
        around = open_[-1] if open_ else None
        up = dict(around["up"]) if around else dict.fromkeys(("page", "region", "line"))
        if around and around["kind"] in up:
            up[around["kind"]] = {"pre": around["pre"], "id": around["id"]}
        node["up"] = up
        open_.append(node)
    return nodes


def _without_declaration(xml: str) -> bytes:
    body = xml.lstrip("﻿ \t\r\n")
    end = body.find("?>")
    return (body[end + 2 :] if body.startswith("<?xml") and end >= 0 else body).lstrip().encode("utf-8", "surrogatepass")


def _label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes = pa.array([label_nodes(x) for x in batch.column("xml").to_pylist()], type=pa.list_(_NODE))
        keys = [c for c in batch.schema.names if c != "xml"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keys), nodes], names=[*keys, "nodes"])


def labelled_records(records: DataFrame, keys: list[str], latest_by: str, xml: str = "xml") -> DataFrame:
    """keys, nodes: the labelled nodes of the latest well-formed record of each key.

    Records of one key are ordered by ``latest_by`` (NULL first), ties by their text."""
    types = dict(records.dtypes)
    ddl = ", ".join(f"{k} {types[k]}" for k in [*keys, latest_by]) + f", tie BIGINT, nodes {NODE_DDL}"
    slim = records.select(*keys, latest_by, F.xxhash64(xml).alias("tie"), F.col(xml).alias("xml")).dropna(subset=[*keys, "xml"])
    parsed = slim.mapInArrow(_label, ddl).filter("nodes is not null")
    best = parsed.groupBy(*keys).agg(F.max_by("nodes", F.struct(F.col(latest_by).isNotNull(), F.col(latest_by), F.col("tie"))).alias("nodes"))
    return best


def node_table(labelled: DataFrame, keys: list[str], kind: str, parent: str) -> DataFrame:
    """keys, pre, post, id, tag, points, value, conf, parent_pre, parent_id of one node type; parent NULL if none."""
    rows = labelled.selectExpr(*keys, f"explode(filter(nodes, n -> n.kind = '{kind}')) as n")
    own = ("pre", "post", "id", "tag", "points", "value", "conf")
    return rows.selectExpr(*keys, *(f"n.{c}" for c in own), f"n.up.{parent}.pre as parent_pre", f"n.up.{parent}.id as parent_id")


KEYS = ["page_id", "xml_format"]


def _records(spark: SparkSession, data_dir: str) -> DataFrame:
    return labelled_records(table(spark, data_dir, "xml_out"), KEYS, "exported_at")


def p3_pages(spark: SparkSession, data_dir: str) -> DataFrame:
    return node_table(_records(spark, data_dir), KEYS, "page", "page")


def p3_regions(spark: SparkSession, data_dir: str) -> DataFrame:
    return node_table(_records(spark, data_dir), KEYS, "region", "region")


def p3_lines(spark: SparkSession, data_dir: str) -> DataFrame:
    return node_table(_records(spark, data_dir), KEYS, "line", "region")


def p3_texts(spark: SparkSession, data_dir: str) -> DataFrame:
    return node_table(_records(spark, data_dir), KEYS, "text", "line")


def p3_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """page_id, xml_format, elem_kind, elem_id, parent_id of every region or block and every line."""
    rows = _records(spark, data_dir).selectExpr(*KEYS, "explode(filter(nodes, n -> n.kind in ('region', 'line'))) as n")
    return rows.selectExpr(*KEYS, "n.kind as elem_kind", "n.id as elem_id", "coalesce(n.up.region.id, '') as parent_id")
