"""Commission, volume, chapter, section and paragraph: flattening, nesting, display order."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civicdocs.functions.text import chapter_label, localized, nz, section_kind, section_label, truthy
from civicdocs.operators.numbering import LOW
from civicdocs.sources.storage import passing, stored


def serial_order(serial: str = "serial", id_: str = "id") -> list[Column]:
    """Siblings stand by serial, null as 0, then by id."""
    return [F.coalesce(F.col(serial), F.lit(0)), F.col(id_)]


#: Places in the exports' arrays, from the top.
LISTED = ("book_pos", "file_name", "volume_pos", "chapter_pos", "section_pos")


def flatten_chapters(chapters: DataFrame, outer: bool = False) -> DataFrame:
    """Chapter trees -> one row for each section, and its paragraphs as they were; ``outer`` keeps chapters without sections.

    The section's place in its array comes along as section_pos, the places of
    chapter and volume and the volume's name where the chapters have them.
    """
    generate = F.posexplode_outer if outer else F.posexplode
    listed = [c for c in (*LISTED[:-1], "volume_name") if c in chapters.columns]
    return chapters.select(
        "book_id", F.col("volume_id") if "volume_id" in chapters.columns else F.lit(None).cast("long").alias("volume_id"), *listed,
        F.col("id").alias("chapter_id"), F.col("serial").alias("chapter_serial"), F.col("title").alias("chapter_title"), F.col("nameBangla").alias("chapter_bangla"),
        generate("sections").alias("section_pos", "s"),
    ).select("book_id", "volume_id", *listed, "chapter_id", "chapter_serial", "chapter_title", "chapter_bangla", "section_pos", F.col("s.id").alias("section_id"), "s.serial", "s.name", "s.nameBangla", "s.hasPdf", "s.pdfName", "s.header", "s.paragraphs")


def flatten_volumes(volumes: DataFrame) -> DataFrame:
    """Volume trees -> their chapters with volume_id, ready for flatten_chapters."""
    c = volumes.select("book_id", F.col("id").alias("volume_id"), F.explode("chapters").alias("c"))
    return c.select("book_id", "volume_id", *[F.col(f"c.{f}").alias(f) for f in ("id", "serial", "title", "nameBangla", "chapterName", "sections")])


def flatten_paragraphs(sections: DataFrame) -> DataFrame:
    """Flattened sections -> one row for each paragraph, for editors' pick lists and joins."""
    return sections.select("book_id", "chapter_id", "section_id", "header", F.explode("paragraphs").alias("p")).select("book_id", "chapter_id", "section_id", F.col("header").alias("section_header"), "p.*")


def branches(books: DataFrame, direct: DataFrame, by_volume: DataFrame) -> DataFrame:
    """Chapters of commissions with volumes from their volumes, of all others (an unknown flag, or no such column, included) directly."""
    flag = truthy("hasVolume") if "hasVolume" in books.columns else F.lit(False)
    flagged = books.select(F.col("id").alias("__book"), flag.alias("__volumes"))
    both = by_volume.withColumn("__held", F.lit(True)).unionByName(direct.withColumn("__held", F.lit(False)), allowMissingColumns=True)
    # not as an equality of flags: rows are dealt by commission alone, and a flag has two values
    right = F.when(F.col("__volumes"), F.col("__held")).otherwise(~F.col("__held"))
    return both.join(flagged, (F.col("book_id") == F.col("__book")) & right, "left_semi").drop("__held")


def book_chapters(books: DataFrame, chapters: DataFrame) -> DataFrame:
    return books.join(chapters, books["id"] == chapters["book_id"], "left")


def missing_payload(books: DataFrame, payload: DataFrame) -> DataFrame:
    """Commissions for which there is neither a chapter nor a volume file."""
    ids = payload.select(F.col("book_id").alias("id")).distinct()
    return books.join(ids, "id", "left_anti")


def chapter_wise_content(paragraphs: DataFrame, sections: DataFrame, chapters: DataFrame, chapter_id: int | None = None) -> DataFrame:
    """Paragraphs with their section and chapter, of one chapter if it is given."""
    c = chapters if chapter_id is None else chapters.filter(F.col("chapter_id") == F.lit(chapter_id).cast("long"))
    return paragraphs.join(sections, "section_id").join(c, "chapter_id")


def tree_order(nodes: DataFrame, parents: list[str], keys: list[str], levels: list[tuple[str, str]] = ()) -> DataFrame:
    """Position of each node among its siblings, and ``path``: an array of (serial, id), one for each of the levels from the top, by which the whole tree sorts."""
    w = Window.partitionBy(*parents).orderBy(*keys)
    steps = [F.struct(F.coalesce(F.col(serial), F.lit(0)).cast("int").alias("serial"), F.col(id_).cast("long").alias("id")) for serial, id_ in levels or [tuple(keys[:2])]]
    return nodes.withColumn("position", F.row_number().over(w).cast("long")).withColumn("path", F.array(*steps))


def tree_kinds(books: DataFrame, volumes: DataFrame, chapters: DataFrame, sections: DataFrame, paragraphs: DataFrame) -> list[DataFrame]:
    """The nodes of the collection as rows, a table of each kind: kind, id, path, from the top an array of (serial, id) by which the whole tree sorts.

    (id, serial) of commissions; volumes with book_id; (chapter_id, serial,
    book_id, volume_id) of chapters, of null volume_id where they hang from the
    commission itself; sections with chapter_id and section_key; paragraphs
    (id, serial) with section_key. A node whose parent isn't there is left out.
    """

    def step(id_: str) -> Column:
        return F.array(F.struct(F.coalesce("serial", F.lit(0)).cast("int").alias("serial"), F.col(id_).cast("long").alias("id")))

    def below(children: DataFrame, parents: DataFrame, key: str, id_: str, *keep: str) -> DataFrame:
        rows = children.select(key, F.col(id_).alias("id"), step(id_).alias("own"), *keep)
        return rows.join(parents.select(key, F.col("path").alias("above")), key).select("id", F.concat("above", "own").alias("path"), *keep)

    top = books.select("id", step("id").alias("path"), F.col("id").alias("book_id"))
    by_volume = below(volumes.withColumn("volume_id", F.col("id")), top, "book_id", "id", "volume_id")
    direct = below(chapters.filter("volume_id is null"), top, "book_id", "chapter_id", "chapter_id")
    chapter = direct.unionByName(below(chapters.filter("volume_id is not null"), by_volume, "volume_id", "chapter_id", "chapter_id"))
    section = below(sections, chapter, "chapter_id", "id", "section_key")
    paragraph = below(paragraphs, section, "section_key", "id")
    kinds = (("commission", top), ("volume", by_volume), ("chapter", chapter), ("section", section), ("paragraph", paragraph))
    return [nodes.select(F.lit(kind).alias("kind"), "id", "path") for kind, nodes in kinds]


def tree_nodes(*tables: DataFrame) -> DataFrame:
    """The nodes of ``tree_kinds`` in one table."""
    return reduce(DataFrame.unionByName, tree_kinds(*tables))


def _next_no_deeper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over a partition, its last node first: with __next, the __at of the node that follows next and is no deeper, null where the partition has none.

    Nodes of one path stand together and have the same next node; __twins tells how many of them stand before.
    """
    latest: dict[int, int] = {}  # of each depth
    held: list[pa.RecordBatch] = []

    def told(rows: pa.Table) -> pa.Table:
        depth, at, path = (rows[c].to_numpy() for c in ("__depth", "__at", "__path"))
        at = at & LOW
        first = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))  # of each path
        size = np.diff(np.append(first, len(path)))
        found = np.full(len(depth), -1)
        for k in np.unique(depth):
            mine = depth == k
            before = max((p for d, p in latest.items() if d <= k), default=-1)
            found[mine] = np.maximum.accumulate(np.concatenate([[before], np.where(depth <= k, at, -1)]))[:-1][mine]
        latest.update({int(k): int(at[depth == k][-1]) for k in np.unique(depth)})
        found = np.repeat(found[first], size)
        twins = np.repeat(at[first] + size - 1, size) - at
        return rows.drop_columns("__path").append_column("__next", pa.array(found, mask=found < 0)).append_column("__twins", pa.array(twins))

    for batch in batches:
        if batch.num_rows:
            rows = pa.Table.from_batches([*held, batch])
            path = rows["__path"].to_numpy()
            whole = len(path) - int(np.argmin(np.append(path[::-1] == path[-1], False)))  # the last path may go on
            held = rows.slice(whole).to_batches()
            if whole:
                yield from told(rows.slice(0, whole)).to_batches()
    if held:
        yield from told(pa.Table.from_batches(held)).to_batches()


def preorder(nodes: DataFrame | list[DataFrame], *keep: str) -> DataFrame:
    """Nodes with their ``path``, in one table or several that are worked out one after the other -> with rn, their number in display order from 1, and subtree_end, the number of the last node below; ``keep`` names the columns that stay, else all.

    The rows of a subtree are those from rn to subtree_end, so that a subtree is
    a range: it ends before the next node that is no deeper. Of nodes that share a path each
    counts all of them as its subtree, from its own number on. Nodes are dealt once, by range partitions of
    their paths, and read from the last to the first; where a partition has no
    such node, the first ones of later partitions tell, a row for each partition and depth.
    """
    nodes, *more = nodes if isinstance(nodes, list) else [nodes]
    spark = nodes.sparkSession
    kept = list(keep or nodes.columns)
    needed = ["path", *[c for c in kept if c != "path"]]
    order = F.desc("path")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with passing(nodes.select(needed), "nodes", "zstd", *[x.select(needed) for x in more]) as there:  # what made them is off the disk when they are dealt
        placed = there.withColumn("__depth", F.size("path")).repartitionByRange(n, order).sortWithinPartitions(order)
        placed = placed.withColumn("__at", F.monotonically_increasing_id()).select(*kept, "__depth", "__at", F.xxhash64("path").alias("__path"))
        schema = StructType([f for f in placed.schema if f.name != "__path"]).add("__next", "long").add("__twins", "long")
        held = stored(placed.mapInArrow(_next_no_deeper, schema), "numbered", "zstd")
    part, at = F.shiftright("__at", 33).alias("__part"), F.col("__at").bitwiseAND(F.lit(LOW))
    counts = held.groupBy(part, "__depth").agg(F.count("*").alias("n"), F.max(at).alias("first")).orderBy("__part").collect()
    # partitions go from the last nodes to the first, as do rows in them
    sizes: dict[int, int] = {}
    for r in counts:
        sizes[r["__part"]] = sizes.get(r["__part"], 0) + r["n"]
    total = left = sum(sizes.values())
    rows, nearest = [], {}  # of later partitions, the number of the first node of each depth
    for p, size in sizes.items():
        mine = [r for r in counts if r["__part"] == p]
        rows += [(p, r["__depth"], left, min((rn for d, rn in nearest.items() if d <= r["__depth"]), default=total + 1) - 1) for r in mine]
        nearest |= {r["__depth"]: left - r["first"] for r in mine}
        left -= size
    if not rows:
        return held.select(*kept, *[F.lit(None).cast("long").alias(c) for c in ("rn", "subtree_end")])
    columns = zip(("__part", "__depth", "__upto", "__after"), zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)
    table = spark.createDataFrame(pa.table({c: pa.array(values, kind) for c, values, kind in columns}))
    numbered = held.withColumn("__part", part).join(F.broadcast(table), ["__part", "__depth"])
    end = F.coalesce(F.col("__upto") - F.col("__next") - 1, "__after") + F.col("__twins")
    return numbered.select(*kept, (F.col("__upto") - at).alias("rn"), end.alias("subtree_end"))


def nest_sections(sections: DataFrame) -> DataFrame:
    """(chapter_id, id, serial, name, hasPdf, pdfName) -> chapter_id, sections: sorted and labelled."""
    item = F.struct(F.coalesce("serial", F.lit(0)).alias("serial"), "id", section_label("name").alias("label"), section_kind("hasPdf", "pdfName").alias("kind"))
    return sections.groupBy("chapter_id").agg(F.array_sort(F.collect_list(item)).alias("sections"))


def nest_chapters(chapters: DataFrame, sections: DataFrame, *parents: str) -> DataFrame:
    """Chapters of each parent, sorted, each with its sorted sections: the parents' columns, tree."""
    nested = chapters.select("chapter_id", *parents, "serial", "title", "chapterName").join(nest_sections(sections), "chapter_id", "left")
    none = F.array().cast("array<struct<serial:int,id:bigint,label:string,kind:string>>")
    item = F.struct(
        F.coalesce("serial", F.lit(0)).alias("serial"), F.col("chapter_id").alias("id"), chapter_label("title", "chapterName").alias("label"),
        F.coalesce("sections", none).alias("sections"),
    )
    return nested.groupBy(*parents).agg(F.array_sort(F.collect_list(item)).alias("tree"))


def nest_tree(chapters: DataFrame, sections: DataFrame) -> DataFrame:
    """Chapters of a commission, sorted, each with its sorted sections: book_id, tree."""
    return nest_chapters(chapters, sections, "book_id")


def nest_volumes(chapters: DataFrame, sections: DataFrame, volumes: DataFrame, lang: str = "bn") -> DataFrame:
    """Volumes of a commission, sorted, each with its chapters and those with their sections: book_id, tree.

    Chapters without a volume stand first, under a volume of null id and empty
    label; a volume without chapters stays, with none.
    """
    named = volumes.select(F.col("book_id").alias("of_book"), F.col("id").alias("of_volume"), F.col("serial").alias("volume_serial"), volume_label(lang).alias("label"))
    held = nest_chapters(chapters, sections, "book_id", "volume_id").withColumnRenamed("tree", "chapters")
    both = held.join(named, (F.col("book_id") == F.col("of_book")) & (F.col("volume_id") == F.col("of_volume")), "full")
    none = F.array().cast(held.schema["chapters"].dataType)
    item = F.struct(
        F.coalesce("volume_serial", F.lit(0)).alias("serial"), F.coalesce("volume_id", "of_volume").alias("id"), F.coalesce("label", F.lit("")).alias("label"),
        F.coalesce("chapters", none).alias("chapters"),
    )
    return both.groupBy(F.coalesce("book_id", "of_book").alias("book_id")).agg(F.array_sort(F.collect_list(item)).alias("tree"))


def descend(books: DataFrame, chapters: DataFrame, sections: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Commission, volume, chapter, section and paragraph of normalised tables as one row for each leaf; parents without children stay.

    The tables hold their parents' keys: book_id and, for commissions with
    volumes, volume_id; chapter_id; section_key. Nested input goes through
    ``flatten_chapters`` instead.
    """
    flags = books.select(F.col("id").alias("book_id"), truthy("hasVolume").alias("__volumes"))
    c = flags.join(chapters, "book_id", "left").withColumn("volume_id", F.when(F.col("__volumes"), F.col("volume_id"))).drop("__volumes")
    return c.join(sections, "chapter_id", "left").join(paragraphs, "section_key", "left")


def sort_nested(chapters: DataFrame) -> DataFrame:
    """Chapter trees with sections and paragraphs sorted where they are, without a shuffle."""

    def by(a: Column, b: Column) -> Column:
        x, y = (F.coalesce(v["serial"], F.lit(0)) for v in (a, b))
        return F.when(x < y, -1).when(x > y, 1).when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0)

    inner = F.transform("sections", lambda s: s.withField("paragraphs", F.array_sort(s["paragraphs"], by)))
    return chapters.withColumn("sections", F.array_sort(inner, by))


def volume_label(lang: str = "bn") -> Column:
    return F.coalesce(localized(lang, "nameBangla", "name"), F.lit(""))


def attachment_refs(entity: DataFrame, kind: str, fields: list[str], id_: str = "id") -> DataFrame:
    """All file names an entity refers to: owner_kind, owner_id, field, file_name."""
    rows = entity.select(F.col(id_).alias("owner_id"), *fields).unpivot("owner_id", fields, "field", "file_name")
    return rows.filter(nz("file_name").isNotNull()).select(F.lit(kind).alias("owner_kind"), "owner_id", "field", "file_name")
