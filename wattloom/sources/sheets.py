"""Ragged text sheets: preambles, footers, years or months across the columns.

A sheet is a table of lines ``(file, block, line_id, line)``.  Files are read
line by line and stay splittable: ``(block, line_id)`` orders the lines of a
file without bringing it into one task.  An index of the blocks (one row a
split) gives line numbers by prefix sums and carries what is known of a sheet,
its header say, to its lines: they are joined by file and block, so a file of
any size is spread over as many tasks as it has splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattloom.functions.scalars import parse_cn_month, parse_dirty_number, to_double
from wattloom.session import broadcast_if_small, materialize

# Fixed values.
MONTH_TOKEN = r"^\d{4}年\d{1,2}月$"
YEAR_TOKEN = r"(20\d{2})"
VALUE_LABEL = "当期值"
MIN_MONTH_TOKENS = 3
LAYOUT_LINES, MONTH_ROW_LINES, VERTICAL_HEADER_ROW = 10, 12, 2


def _order() -> Column:
    return F.struct("block", "line_id")


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines of all files under ``path`` with their order.

    A row id rises by one per line within a split, and a split belongs to one
    file block, so ids compare within a block and blocks within a file.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_id"), F.col("value").alias("line"),
    )
    return lines.withColumn("line", F.regexp_replace("line", "^\ufeff|\r$", ""))


def split_cells(c: Column | str) -> Column:
    """Comma-separated cells, quotes respected, tabs and outer blanks removed.

    A line whose quotes do not pair up is split at every comma.
    """
    line = F.col(c) if isinstance(c, str) else c
    paired = F.length(F.regexp_replace(line, '[^"]', "")) % 2 == 0
    quoted = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(r'((?:"[^"]*+"|[^,"]++)*+),'), F.lit(1))
    cells = F.when(paired, quoted).otherwise(F.split(line, ","))
    return F.transform(cells, lambda x: F.trim(F.regexp_replace(x, '[\t"]', "")))


def _has_words(line: Column, marker: str | Sequence[str]) -> Column:
    if isinstance(marker, str):
        return F.contains(line, F.lit(marker))
    cells = F.transform(split_cells(line), lambda x: F.lower(x))
    return F.size(F.array_except(F.array(*[F.lit(m) for m in marker]), cells)) == 0


def block_index(lines: DataFrame) -> DataFrame:
    """``(file, block, first, lines, before)``: first line id and number of lines of a block, and lines of the file before it.

    One row a split, written once; the prefix sums run over a file's blocks.
    """
    blocks = lines.groupBy("file", "block").agg(F.min("line_id").alias("first"), F.count(F.lit(1)).alias("lines"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(blocks.withColumn("before", F.coalesce(F.sum("lines").over(earlier), F.lit(0))))


def _with_blocks(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """Lines whose block is in ``blocks``, with its columns and ``line_no``, counted from 0 through the file."""
    number = F.col("before") + F.col("line_id") - F.col("first")
    known = [c for c in blocks.columns if c not in ("file", "block", "first", "lines", "before")]
    return lines.join(broadcast_if_small(blocks), ["file", "block"]).select(*lines.columns, *known, number.alias("line_no"))


def _numbered(lines: DataFrame, upto: int | None = None) -> DataFrame:
    """Lines with ``line_no``, only the first ``upto`` of each file if given."""
    blocks = block_index(lines)
    if upto is None:
        return _with_blocks(lines, blocks)
    return _with_blocks(lines, blocks.filter(F.col("before") < upto)).filter(F.col("line_no") < upto)


def with_header_marker(lines: DataFrame, marker: str | Sequence[str] | int, stop_marker: str | None = None) -> DataFrame:
    """Data lines below the header as ``(file, block, line_id, header, cells)``.

    The header is the first line containing the marker text, or holding every
    marker word as a cell, or the line of that number.  With ``stop_marker``
    the data ends at the first line whose leading cell contains it.  Sheets
    without a header have no data lines.
    """
    blocks = block_index(lines)
    if isinstance(marker, int):
        at = blocks.filter((F.col("before") <= marker) & (F.col("before") + F.col("lines") > marker))
        heads = _with_blocks(lines, at).filter(F.col("line_no") == marker)
    else:
        heads = lines.filter(_has_words(F.col("line"), marker))
    heads = heads.groupBy("file").agg(F.min(_order()).alias("at"), F.min_by("line", _order()).alias("header"))
    # from here on a row a block: those before the header are left out, the others know header and end
    blocks = materialize(blocks.join(heads, "file").filter(F.col("block") >= F.col("at.block")))
    if stop_marker is not None:
        below = _with_blocks(lines.filter(F.contains("line", F.lit(stop_marker))), blocks).filter(_order() > F.col("at"))
        below = below.filter(F.contains(split_cells("line")[0], F.lit(stop_marker)))
        ends = below.groupBy("file").agg(F.min(_order()).alias("end"))
        blocks = materialize(blocks.join(ends, "file", "left").filter(F.col("end").isNull() | (F.col("block") <= F.col("end.block"))))
    body = _with_blocks(lines, blocks).filter(_order() > F.col("at"))
    if stop_marker is not None:
        body = body.filter(F.col("end").isNull() | (_order() < F.col("end")))
    return body.select("file", "block", "line_id", split_cells("header").alias("header"), split_cells("line").alias("cells"))


def read_with_header_marker(spark: SparkSession, path, marker, stop_marker: str | None = None) -> DataFrame:
    return with_header_marker(read_lines(spark, path), marker, stop_marker)


def rows_to_columns(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Named columns of header-marked rows, looked up by header text."""
    position = lambda name: F.array_position(F.transform("header", lambda h: F.lower(h)), name)
    return rows.select("file", *[
        F.when(position(c) > 0, F.try_element_at("cells", F.nullif(position(c), F.lit(0)).cast("int"))).alias(c) for c in columns
    ])


def _cells_by_header(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    return rows.select(*keep, F.inline(F.arrays_zip(F.col("header").alias("head"), F.col("cells").alias("cell"))))


def melt_year_cells(rows: DataFrame, entity: str = "entity", pattern: str = YEAR_TOKEN) -> DataFrame:
    """Header-marked rows with years across to ``(file, entity, year, value)``."""
    named = rows.withColumn(entity, F.col("cells")[0]).filter(F.col(entity) != "")
    cells = _cells_by_header(named, ["file", entity])
    year = F.regexp_extract("head", pattern, 1)
    return cells.filter(year != "").select("file", entity, year.cast("int").alias("year"), parse_dirty_number("cell").alias("value"))


def melt_years(df: DataFrame, id_cols: Sequence[str], pattern: str = YEAR_TOKEN, lo: int = 0, hi: int = 9999) -> DataFrame:
    """Columns whose name holds a year to rows ``(ids, year, value)``."""
    import re

    years = {c: int(m.group(1)) for c in df.columns if c not in id_cols and (m := re.search(pattern, c))}
    kept = [c for c, y in years.items() if lo <= y <= hi]
    long = df.unpivot(list(id_cols), kept, "__name", "value")
    return long.select(*id_cols, F.regexp_extract("__name", pattern, 1).cast("int").alias("year"), "value")


def _month_tokens(cells: Column) -> Column:
    return F.size(F.filter(cells, lambda x: x.rlike(MONTH_TOKEN)))


def _heads(first_lines: DataFrame) -> DataFrame:
    """What the first lines say about each sheet: its layout and its row of months."""
    cells = first_lines.select("file", "line_no", split_cells("line").alias("cells"))
    enough = _month_tokens(F.col("cells")) >= MIN_MONTH_TOKENS
    is_month_row = enough & (F.col("line_no") < MONTH_ROW_LINES)
    return cells.groupBy("file").agg(
        F.coalesce(F.bool_or(enough & (F.col("line_no") < LAYOUT_LINES)), F.lit(False)).alias("wide"),
        F.min_by("cells", F.when(is_month_row, F.col("line_no"))).alias("header"),
    )


def _value_rows(lines: DataFrame, label: str) -> DataFrame:
    """The first line of each sheet whose leading cell contains ``label``."""
    named = lines.filter(F.contains("line", F.lit(label))).select("file", _order().alias("at"), split_cells("line").alias("cells"))
    return named.filter(F.contains(F.col("cells")[0], F.lit(label))).groupBy("file").agg(F.min_by("cells", "at").alias("cells"))


def _known(rows: DataFrame, month: Column, value: Column) -> DataFrame:
    out = rows.select("file", parse_cn_month(month).alias("ts"), to_double(value).alias("value"))
    return out.filter(F.col("ts").isNotNull() & F.col("value").isNotNull())


def _across(heads: DataFrame) -> DataFrame:
    pairs = _cells_by_header(heads, ["file"]).filter(F.col("head").rlike(MONTH_TOKEN))
    return _known(pairs, F.col("head"), F.col("cell"))


def _down(numbered: DataFrame, header_row: int) -> DataFrame:
    cells = numbered.filter(F.col("line_no") > header_row).select("file", split_cells("line").alias("cells"))
    return _known(cells, F.get("cells", F.lit(0)), F.get("cells", F.lit(1)))


_TOP = max(LAYOUT_LINES, MONTH_ROW_LINES)


def detect_layout(lines: DataFrame) -> DataFrame:
    """``(file, layout)``: horizontal when one of the first lines holds several months."""
    return _heads(_numbered(lines, _TOP)).select("file", F.when(F.col("wide"), "horizontal").otherwise("vertical").alias("layout"))


def melt_months(lines: DataFrame, label: str = VALUE_LABEL) -> DataFrame:
    """Months across, values in the first row whose label contains ``label``."""
    return _across(_heads(_numbered(lines, _TOP)).join(_value_rows(lines, label), "file"))


def melt_vertical(lines: DataFrame, header_row: int = VERTICAL_HEADER_ROW) -> DataFrame:
    """Dates in the first column, values in the second, below the header line."""
    return _down(_numbered(lines), header_row)


def melt_sheets(lines: DataFrame, label: str = VALUE_LABEL, header_row: int = VERTICAL_HEADER_ROW) -> DataFrame:
    """``(file, ts, value)`` of single-metric sheets in either layout."""
    blocks = block_index(lines)
    first = _with_blocks(lines, blocks.filter(F.col("before") < _TOP)).filter(F.col("line_no") < _TOP)
    heads = materialize(_heads(first))
    wide = heads.filter("wide").join(_value_rows(lines, label), "file")
    tall = blocks.join(heads.filter("not wide").select("file"), "file")
    return _across(wide).unionByName(_down(_with_blocks(lines, tall), header_row))
