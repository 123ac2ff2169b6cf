"""Statute XML: one row per ``<section>`` with its place in the hierarchy."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions import fixed_values as fixed
from docketry.session import ship_package

_PATH = "array<struct<tag:string,num:string>>"


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _own_text(elements: Iterator[ET.Element]) -> Iterator[str]:
    """Text standing directly inside the given elements."""
    for element in elements:
        for part in (element.text, *(child.tail for child in element)):
            if part:
                yield part


def _texts(element: ET.Element) -> Iterator[str]:
    """All text inside an element in document order, without comments."""
    waiting: list[ET.Element | str] = [element]
    while waiting:
        item = waiting.pop()
        if isinstance(item, str):
            yield item
            continue
        parts = [item.text]
        for child in item:
            parts += [child if isinstance(child.tag, str) else None, child.tail]
        waiting.extend(p for p in reversed(parts) if p is not None)


def _sections(xml: str, namespace: str | None) -> list[tuple[tuple, str, str]]:
    """Path, heading and content of each section."""
    builder = ET.TreeBuilder(insert_comments=True, insert_pis=True)
    root = ET.fromstring(xml.encode("utf-8") if xml.startswith("<?xml") else xml,
                         parser=ET.XMLParser(target=builder))
    found: list[tuple[tuple, str, str]] = []
    # Depth first in document order; an explicit stack, since nesting is not bounded.
    stack: list[tuple[ET.Element, tuple]] = [(root, ())]
    while stack:
        element, path = stack.pop()
        if not isinstance(element.tag, str):
            continue
        name = _local(element.tag).lower()
        if name in fixed.HIERARCHY_TAGS:
            num = element.get("num")
            if not num and namespace:
                num = next(_own_text(element.iterfind(f"{{{namespace}}}num")), "")
            path = (*path, (name, num))
        if name == "section":
            if namespace:
                titles = element.iterfind(f"{{{namespace}}}heading")
            else:
                titles = (c for c in element if isinstance(c.tag, str) and _local(c.tag) == "heading")
            heading = next(_own_text(titles), "").strip()
            content = "\n".join(t.strip() for t in _texts(element) if t.strip(" \t\r\n"))
            found.append((path, heading, content))
        stack.extend((child, path) for child in reversed(element))
    return found


def _first(path: Column, tag: str, default: str | None) -> Column:
    named = F.filter(path, lambda p: p["tag"] == tag)
    return F.when(F.size(named) > 0, F.get(named, F.lit(0))["num"]).otherwise(F.lit(default))


def statute_sections(files: DataFrame, namespace: str | None = None,
                     path: str = "path", value: str = "value") -> DataFrame:
    """Sections of XML texts held one per row as ``path, value``."""

    ship_package(files.sparkSession)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Columns are filled one by one; rows as dictionaries would cost more than the parsing.
            file, ends, tags, nums, headings, contents = [], [0], [], [], [], []
            for i, xml in enumerate(batch.column("value").to_pylist()):
                for place, heading, content in _sections(xml, namespace) if xml else ():
                    file.append(i)
                    tags += [tag for tag, _ in place]
                    nums += [num for _, num in place]
                    ends.append(len(tags))
                    headings.append(heading)
                    contents.append(content)
            steps = pa.StructArray.from_arrays([pa.array(tags, pa.string()), pa.array(nums, pa.string())], ["tag", "num"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("source_file").take(pa.array(file, pa.int64())),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps),
                    pa.array(headings, pa.string()), pa.array(contents, pa.string()),
                ],
                names=["source_file", "path", "heading", "content"],
            )

    read = files.select(F.col(path).cast("string").alias("source_file"), F.col(value).cast("string").alias("value"))
    found = read.mapInArrow(parse, f"source_file string, path {_PATH}, heading string, content string")
    hierarchy = F.col("path")
    labels = F.transform(
        F.filter(hierarchy, lambda p: F.coalesce(p["num"], F.lit("")) != ""),
        lambda p: F.concat_ws("-", p["tag"], p["num"]),
    )
    return found.select(
        F.array_join(labels, "-").alias("id"),
        _first(hierarchy, "title", "").alias("title_num"),
        _first(hierarchy, "chapter", None).alias("chapter_num"),
        _first(hierarchy, "section", "").alias("section_num"),
        "heading",
        "content",
        "path",
        "source_file",
    )


def read_statutes(spark: SparkSession, root: str, namespace: str | None = None,
                  glob: str = "*.xml") -> DataFrame:
    raw = (
        spark.read.option("wholetext", "true")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .text(root)
        .select(F.col("_metadata.file_path").alias("path"), "value")
    )
    return statute_sections(raw, namespace)
