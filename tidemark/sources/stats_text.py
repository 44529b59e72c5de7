"""Anatomical statistics files: discovery, text to long rows, sharded writing.

Every file is one row of text; the parsing is column expressions over its lines, so files are spread over tasks and no
text passes through Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import col, finite

# ---- fixed values: file formats and line patterns ---------------------------------------------------------------
COMPLETE_MARKER = "_complete.json"
MEASURE_PATTERN = r"^#\s*Measure\s+(.*)$"
HEADERS_PATTERN = r"^#\s*ColHeaders\s+(.*)$"
VERSION_PATTERN = r"^#\s*(?:FastSurfer_version|fs_version|cmdline_version)\s+(\S+)"
TABLECOL_PATTERN = r"^#\s*TableCol\s+(\d+)\s+(ColHeader|Units)\s+(.*)$"
CURVATURE_BLOCK_PATTERN = r"^(\S+) <mean> \+- <std> \(using '([^']+)'\):\s+(\S+) \+- (\S+)\s*(\S*)\s*$"
CURVATURE_METRIC_PATTERN = r"^\s+(\S+) (.+?):\s+(\S+)(.*)$"
TAIL_STD_PATTERN = r"^\s*\+-\s*(\S+)\s*(\S*)\s*$"
TAIL_VERTEX_PATTERN = r"^\s*at vertex\s+(\d+)\s*$"
TAIL_ACROSS_PATTERN = r"^\s*across\s+(\S+)\s+\(([\d.]+)%\)\s*(\S*)\s*$"
STRUCTURE_COLUMN = "StructName"
DROPPED_COLUMNS = ("Index",)
VOLUME_MEASURE = ("Volume_mm3", "mm^3")
# ---- end of fixed values ----------------------------------------------------------------------------------------


def file_format(name: str | Column) -> Column:
    """Parser of a file name: curvature before the generic statistics suffix, NULL when it is no statistics file."""
    n = col(name)
    return (
        F.when(n.endswith("curv.stats"), "curvature").when(n.endswith(".stats"), "freesurfer").when(n.endswith(".txt"), "volume_table")
    )


def to_number(token: str | Column) -> Column:
    """Number of a token; NaN, infinities and words are NULL."""
    return finite(col(token).try_cast("double"))


def complete_files(listing: DataFrame, path: str = "path", unit_depth: int = 2) -> DataFrame:
    """Files under units that hold a completion marker; `unit_depth` path parts name the unit. Adds `_unit`, `_name`."""
    parts = F.split(path, "/")
    df = listing.withColumn("_unit", F.array_join(F.slice(parts, 1, unit_depth), "/")).withColumn(
        "_name", F.element_at(parts, -1)
    )
    marked = df.filter((F.col("_name") == COMPLETE_MARKER) & (F.size(parts) == unit_depth + 1)).select("_unit").distinct()
    return df.filter(F.col("_name") != COMPLETE_MARKER).join(marked, "_unit", "left_semi")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Paths and sizes below a root, without reading any content."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("size"))


def read_texts(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").text(root, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def _lines(files: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    return files.select(*keys, F.posexplode(F.split(text, r"\r\n|\n|\r")).alias("line_number", "line"))


def declared_version(text: str | Column) -> Column:
    """Version a file declares in its header, '' when it declares none."""
    return F.regexp_extract(text, "(?m)" + VERSION_PATTERN, 1)


def parse_statistics(files: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """`# Measure` lines and the table below `# ColHeaders` as rows (keys, line_number, item, structure, measure, value, unit).

    A header without a structure column raises: no rows would look like an empty file."""
    t = F.col(text)
    headers = F.split(F.trim(F.regexp_extract(t, "(?m)" + HEADERS_PATTERN, 1)), r"\s+")
    has_table = t.rlike("(?m)" + HEADERS_PATTERN)
    # units are declared per column number, in two lines: name and unit
    column = F.regexp_extract_all(t, F.lit("(?m)" + TABLECOL_PATTERN), F.lit(1))
    attribute = F.regexp_extract_all(t, F.lit("(?m)" + TABLECOL_PATTERN), F.lit(2))
    value = F.regexp_extract_all(t, F.lit("(?m)" + TABLECOL_PATTERN), F.lit(3))
    declared = F.arrays_zip(column.alias("c"), attribute.alias("a"), value.alias("v"))
    names = F.filter(declared, lambda d: d["a"] == "ColHeader")
    unit_of = F.filter(declared, lambda d: d["a"] == "Units")
    units = F.map_from_entries(
        F.transform(
            names,
            lambda n: F.struct(
                F.trim(n["v"]),
                F.coalesce(F.get(F.transform(F.filter(unit_of, lambda u: u["c"] == n["c"]), lambda u: F.trim(u["v"])), F.lit(0)), F.lit("")),
            ),
        )
    )
    index = F.array_position("_h", STRUCTURE_COLUMN)
    checked = F.when(F.col("_t") & (index == 0), F.raise_error(F.lit(f"ColHeaders without {STRUCTURE_COLUMN}"))).otherwise(index)
    # the header is read once per file, and what a table's columns stand for is settled there
    prepared = files.select(*keys, text, headers.alias("_h"), units.alias("_u"), has_table.alias("_t"))
    columns = F.filter(
        F.transform("_h", lambda h, i: F.struct(i.alias("item"), h.alias("measure"), F.try_element_at("_u", h).alias("unit"))),
        lambda c: (c["item"] != F.col("_i") - 1) & ~c["measure"].isin(*DROPPED_COLUMNS),
    )
    columns = F.transform(columns, lambda c: F.struct(c["item"].alias("item"), c["measure"].alias("measure"), F.when(c["unit"] == "NA", "").otherwise(F.coalesce(c["unit"], F.lit(""))).alias("unit")))
    prepared = prepared.withColumn("_i", checked.cast("int"))
    prepared = prepared.withColumn("_c", columns)
    lines = _lines(prepared, [*keys, "_h", "_c", "_i", "_t"], text)
    line = F.col("line")
    # measure lines: structure and measure from the left, value and unit from the right
    is_measure = line.startswith("#") & line.rlike(MEASURE_PATTERN)
    split = F.transform(F.split(F.regexp_extract(line, MEASURE_PATTERN, 1), ","), lambda p: F.trim(p))
    body, size = F.col("_body"), F.size("_body")
    measure = F.when(
        body.isNotNull() & (size >= 4) & (F.get(body, F.lit(0)) != "") & (F.get(body, F.lit(1)) != ""),
        F.array(
            F.struct(
                F.lit(0).alias("item"), F.get(body, F.lit(0)).alias("structure"), F.get(body, F.lit(1)).alias("measure"),
                to_number(F.get(body, size - 2)).alias("value"), F.get(body, size - 1).alias("unit"),
            )
        ),
    )
    fields = F.col("_fields")
    is_row = fields.isNotNull() & (F.size(fields) == F.size("_h"))
    cells = F.transform(
        "_c",
        lambda c: F.struct(
            c["item"].alias("item"), F.get(fields, F.col("_i") - 1).alias("structure"), c["measure"].alias("measure"),
            to_number(F.get(fields, c["item"])).alias("value"), c["unit"].alias("unit"),
        ),
    )
    # a line is split once, before the generator that reads its parts for every cell
    parts = lines.select(
        *keys, "line_number", "_h", "_c", "_i", F.when(is_measure, split).alias("_body"),
        F.when(F.col("_t") & ~line.startswith("#") & (F.trim(line) != ""), F.split(F.trim(line), r"\s+")).alias("_fields"),
    )
    return parts.select(*keys, "line_number", F.inline(F.coalesce(measure, F.when(is_row, cells))))


def parse_curvature(files: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """Curvature text: block headers carry the surface for the indented metric lines below them.

    The blocks are found inside the text of the file itself (split at block headers), so no window is needed."""
    t = F.col(text)
    blocks = F.split(t, r"(?m)(?=^\S+ <mean> \+- <std> \(using ')")
    df = files.select(*keys, blocks.alias("_all")).select(*keys, "_all", F.posexplode("_all").alias("_b", "_block"))
    # line breaks in the blocks before this one
    before = F.aggregate(F.slice("_all", 1, F.col("_b")), F.lit(0), lambda n, b: n + F.regexp_count(b, F.lit("\n")))
    head = F.regexp_extract(F.col("_block"), r"^([^\n]*)", 1)
    field = {n: F.regexp_extract(head, CURVATURE_BLOCK_PATTERN, i) for i, n in enumerate(("type", "surface", "mean", "std", "unit"), 1)}
    df = df.filter(head.rlike(CURVATURE_BLOCK_PATTERN)).select(
        *keys, before.alias("_before"), *[c.alias(f"_{n}") for n, c in field.items()], F.posexplode(F.split("_block", r"\n")).alias("_l", "_line")
    )

    def row(item, measure, value, unit):
        return F.struct(
            F.lit(item).alias("item"), F.col("_surface").alias("structure"), measure.alias("measure"), to_number(value).alias("value"),
            (unit if isinstance(unit, Column) else F.lit(unit)).alias("unit"),
        )

    header_rows = F.array(
        row(0, F.concat("_type", F.lit("|mean")), F.col("_mean"), F.col("_unit")),
        row(1, F.concat("_type", F.lit("|std")), F.col("_std"), F.col("_unit")),
    )
    part = {n: F.regexp_extract("_line", CURVATURE_METRIC_PATTERN, i) for i, n in enumerate(("type", "label", "value", "tail"), 1)}
    name, tail = F.concat(part["type"], F.lit("|"), F.trim(part["label"])), part["tail"]
    is_std, is_vertex, is_across = (tail.rlike(p) for p in (TAIL_STD_PATTERN, TAIL_VERTEX_PATTERN, TAIL_ACROSS_PATTERN))
    std_unit = F.regexp_extract(tail, TAIL_STD_PATTERN, 2)
    own_unit = F.when(is_std, std_unit).when(is_vertex | is_across, "").otherwise(F.trim(tail))
    primary = row(0, name, part["value"], own_unit)
    metric_rows = (
        F.when(is_std, F.array(primary, row(1, F.concat(name, F.lit("|std")), F.regexp_extract(tail, TAIL_STD_PATTERN, 1), std_unit)))
        .when(is_vertex, F.array(primary, row(1, F.concat(name, F.lit("|vertex")), F.regexp_extract(tail, TAIL_VERTEX_PATTERN, 1), "")))
        .when(
            is_across,
            F.array(
                primary,
                row(1, F.concat(name, F.lit("|across")), F.regexp_extract(tail, TAIL_ACROSS_PATTERN, 1), F.regexp_extract(tail, TAIL_ACROSS_PATTERN, 3)),
                row(2, F.concat(name, F.lit("|across_pct")), F.regexp_extract(tail, TAIL_ACROSS_PATTERN, 2), "%"),
            ),
        )
        .otherwise(F.array(primary))
    )
    rows = F.when(F.col("_l") == 0, header_rows).when(F.col("_line").rlike(CURVATURE_METRIC_PATTERN), metric_rows)
    number = (F.col("_before") + F.col("_l")).alias("line_number")
    return df.select(*keys, number, F.inline(rows))


def parse_volume_table(files: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """Bare `name value` lines; lines of another shape are skipped."""
    fields = F.split(F.trim("line"), r"\s+")
    measure, unit = VOLUME_MEASURE
    lines = _lines(files, keys, text).filter((F.trim("line") != "") & (F.size(fields) == 2))
    return lines.select(
        *keys, "line_number", F.lit(0).alias("item"), fields[0].alias("structure"), F.lit(measure).alias("measure"),
        to_number(fields[1]).alias("value"), F.lit(unit).alias("unit"),
    )


def parse_all(files: DataFrame, keys: Sequence[str], name: str, text: str = "text") -> DataFrame:
    """Long rows of files of every format, with the version their text declares."""
    df = files.withColumn("_format", file_format(name)).withColumn("fs_version", declared_version(text))
    ids = [*keys, "fs_version"]
    parts = [
        parser(df.filter(F.col("_format") == fmt), ids, text)
        for fmt, parser in (("freesurfer", parse_statistics), ("curvature", parse_curvature), ("volume_table", parse_volume_table))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def with_shard(df: DataFrame, key: str, shards: int) -> DataFrame:
    """Stable shard of a unit: CRC-32 of its name, independent of the session and of the run."""
    return df.withColumn("shard", F.crc32(F.col(key).cast("binary")) % shards)


def write_shards(df: DataFrame, key: str, shards: int, path: str) -> None:
    """One folder per shard, replaced on its own, so a rerun of some units leaves the other shards alone."""
    sharded = with_shard(df, key, shards)
    sharded.hint("rebalance", F.col("shard")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "compression", "zstd"
    ).partitionBy("shard").parquet(path)
