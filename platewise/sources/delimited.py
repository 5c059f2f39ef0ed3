"""Delimited text: reading by header name, sheets with two header rows, writing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from platewise.contracts import CHOICE_COLUMNS, RATING_COLUMNS, USER_COLUMNS, keep_columns, require_columns
from platewise.functions.scalars import not_blank
from platewise.operators.joins import lookup_join
from platewise.session import materialize

_QUOTING = {"quote": '"', "escape": '"'}
BYTE_ORDER_MARK = "\ufeff"
MAX_LINES = 1000  # lines of one record; a file with a longer one is set aside, because some quote was never closed


def read_delimited(spark: SparkSession, path: str, columns: Iterable[str], required: Iterable[str] = (),
                   sep: str = ",") -> DataFrame:
    """The wanted columns of delimited files as text, found by header name.

    The schema comes from one header; ``enforceSchema`` is off, so a file of the same folder whose
    header differs stops the job instead of shifting its values into other columns.
    """
    options = {"header": True, "sep": sep, **_QUOTING}
    header = spark.read.options(**options).csv(path).schema
    names = [name.lstrip(BYTE_ORDER_MARK).strip() for name in header.fieldNames()]
    rows = spark.read.options(**options, enforceSchema=False).schema(header).csv(path).toDF(*names)
    return keep_columns(require_columns(rows, required), columns if isinstance(columns, dict) else list(columns))


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, RATING_COLUMNS, RATING_COLUMNS).where(not_blank("user_id"))


def read_choices(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, CHOICE_COLUMNS, CHOICE_COLUMNS).where(not_blank("user_id"))


def read_users(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    return read_delimited(spark, path, USER_COLUMNS, ["user_id"], sep).where(not_blank("user_id"))


def read_typed(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Good rows under the schema; and the lines that do not fit it, as ``record`` beside whatever of
    them could be read.

    Whole lines are parsed whatever columns are used later, so a line is good or bad once and for all.
    A header line that is not the expected one shows up among the bad lines.
    """
    checked = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", **_QUOTING}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in checked.fields)
    rows = (spark.read.text(path).where(not_blank("value") & (F.col("value") != sep.join(schema.fieldNames())))
            .select("value", F.from_csv("value", ddl, options).alias("row")))
    names = [F.col(f"row.`{name}`") for name in schema.fieldNames()]
    good = rows.where(F.col("row._bad").isNull()).select(*names)
    return good, rows.where(F.col("row._bad").isNotNull()).select(*names, F.col("value").alias("record"))


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    """Write with a header, replacing what the path held. Lists become '|' text."""
    flat = [F.array_join(f.name, "|").alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
            for f in df.schema.fields]
    df.select(flat).write.mode("overwrite").options(header=True, sep=sep, **_QUOTING).csv(path)


def merge_headers(first: Column, second: Column) -> Column:
    """One name per column: the second row's, else the first row's; ends before the first column that
    is blank in both, and never reaches past the first row."""
    def named(cell: Column) -> Column:
        return F.nullif(F.trim(cell), F.lit(""))

    both = F.slice(F.arrays_zip(first.alias("a"), second.alias("b")), 1, F.size(first))
    merged = F.transform(both, lambda c: F.coalesce(named(c["b"]), named(c["a"])))
    gap = F.array_position(F.transform(merged, lambda m: m.isNull()), True)
    return F.when(gap > 0, F.slice(merged, F.lit(1), (gap - 1).cast("int"))).otherwise(merged)


def file_lines(text: DataFrame) -> DataFrame:
    """Lines of text files with the file they come from and where their part of the file starts."""
    return text.select(F.col("_metadata.file_path").alias("sheet"),
                       F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def numbered(lines: DataFrame) -> DataFrame:
    """Add ``at``, which grows with the line within a file."""
    return lines.withColumn("at", F.monotonically_increasing_id())


def _quote_open(line: Column, sep: str, inside: bool) -> Column:
    """Is a quoted cell open at the end of the line, if the line starts ``inside`` one or not?"""
    plain = F.replace(line, F.lit('""'), F.lit(""))  # an escaped quote, or an empty cell
    start = f"(^|{_literal(sep)})\""
    rest = F.regexp_replace(plain, '^[^"]*"', "x") if inside else plain
    closed = F.regexp_replace(rest, f'{start}[^"]*"(?={_literal(sep)}|$)', "$1")
    still = closed.rlike(start)
    return F.when(~F.contains(plain, F.lit('"')), F.lit(inside)).otherwise(still)


def whole_records(lines: DataFrame, sep: str = ",") -> DataFrame:
    """Numbered lines with the lines of one record joined, where a quoted cell holds line breaks; ``torn`` marks files
    with a quote that nothing closes, or not within MAX_LINES lines.

    A line maps the state before it (inside a quoted cell or not) to the state after it: it keeps, swaps or sets it. These maps
    are composed inside each part of a file, then over the parts, so a file is never in one task. Files without a
    line that opens a cell, nearly all, are not shuffled. A line with only whole quoted cells sets the state, so one stray quote harms few lines.
    """
    opens = _quote_open(F.col("line"), sep, False)
    broken = materialize(lines.where(F.contains("line", F.lit('"')) & opens).select("sheet").distinct(), "open-sheets")
    if broken.isEmpty():
        return lines.withColumn("torn", F.lit(False))
    marked = lookup_join(lines, broken.withColumn("_open", F.lit(True)), "sheet", "left", stored=True)
    calm = marked.where(F.col("_open").isNull()).drop("_open")
    ranked = Window.partitionBy("sheet", "start").orderBy("at")
    upto, parts = ranked.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("sheet").orderBy("start")
    low, high = opens.cast("int"), _quote_open(F.col("line"), sep, True).cast("int")
    # The state after a line is (_set + _swaps) % 2, or (state before the part + _swaps) % 2 where no line has set it yet.
    states = marked.where("_open").drop("_open").withColumn("_low", low).withColumn("_high", high)
    states = states.withColumn("_swaps", F.sum(F.when(F.expr("_low = 1 and _high = 0"), 1).otherwise(0)).over(upto))
    states = states.withColumn("_set", F.last(F.when(F.expr("_low = _high"), (F.col("_low") + F.col("_swaps")) % 2), True).over(upto))
    states = materialize(states, "states")
    ends = states.groupBy("sheet", "start").agg(F.max("_swaps").alias("swaps"), F.max_by("_set", "at").alias("set"))
    ends = ends.withColumn("all", F.sum("swaps").over(parts)).withColumn("end", F.last(
        F.when(F.col("set").isNotNull(), (F.col("set") + F.col("swaps") + F.col("all")) % 2), True).over(parts))
    ends = ends.withColumn("end", (F.coalesce("end", F.lit(0)) + F.col("all")) % 2).select(
        "sheet", "start", F.lag("end", 1, 0).over(parts).alias("_carry"))
    after = (F.coalesce("_set", "_carry") + F.col("_swaps")) % 2
    states = states.join(ends, ["sheet", "start"]).withColumn("_after", after)
    states = states.withColumn("_before", F.coalesce(F.lag("_after").over(ranked), "_carry"))
    first = F.when(F.col("_before") == 0, F.struct("start", "at"))
    states = materialize(states.withColumn("_first", F.last(first, True).over(upto)).select(*lines.columns, "_before", "_after", "_first"), "records")
    # The first lines of a part may belong to a record of an earlier part.
    lasts = states.groupBy("sheet", "start").agg(F.max("_first").alias("_last")).select(
        "sheet", "start", F.last("_last", True).over(parts.rowsBetween(Window.unboundedPreceding, -1)).alias("_earlier"))
    states = states.join(lasts, ["sheet", "start"]).withColumn("_first", F.coalesce("_first", "_earlier")).drop("_earlier")
    long = states.groupBy("sheet", "_first").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MAX_LINES).select("sheet")
    unclosed = states.groupBy("sheet").agg(F.max_by("_after", F.struct("start", "at")).alias("open")).where("open = 1").select("sheet")
    torn = materialize(long.unionByName(unclosed).distinct().withColumn("torn", F.lit(True)), "torn")
    states = lookup_join(states, torn, "sheet", "left", stored=True).withColumn("torn", F.coalesce("torn", F.lit(False)))
    alone = F.col("torn") | ((F.col("_before") == 0) & (F.col("_after") == 0))
    others = [c for c in lines.columns if c not in ("sheet", "start", "at", "line")]
    whole = states.where(~alone).groupBy("sheet", "_first").agg(
        F.array_sort(F.collect_list(F.struct("start", "at", "line"))).alias("_lines"), *[F.first(c).alias(c) for c in others])
    whole = whole.select("sheet", F.col("_first.start").alias("start"), F.col("_first.at").alias("at"),
                         F.array_join("_lines.line", "\n").alias("line"), *others, F.lit(False).alias("torn"))
    kept = [*lines.columns, "torn"]
    return calm.withColumn("torn", F.lit(False)).select(*kept).unionByName(states.where(alone).select(*kept)).unionByName(whole.select(*kept))


def _heads(lines: DataFrame, names: list[str]) -> DataFrame:
    """The first lines of each file, one column each, and the place of the last of them.

    The places are least numbers per file, and the lines are fetched by them: a task holds one number for each of its files, where
    ranking the lines would sort all of a part.
    """
    places = materialize(lines.groupBy("sheet").agg(F.min("at").alias(names[0])), "places")
    for before, name in zip(names, names[1:]):
        later = lookup_join(lines.select("sheet", "at"), places.select("sheet", before), "sheet", stored=True).where(F.col("at") > F.col(before))
        places = materialize(places.join(later.groupBy("sheet").agg(F.min("at").alias(name)), "sheet", "left"), "places")
    top = lookup_join(lines.select("sheet", "at", "line"), places.select("sheet", F.array(*names).alias("_places")), "sheet").where(
        F.array_contains("_places", F.col("at")))
    return materialize(top.groupBy("sheet").agg(
        *[F.max(F.when(F.col("at") == F.col("_places")[n], F.col("line"))).alias(name) for n, name in enumerate(names)],
        F.max("at").alias("last")), "heads")


def rows_by_header(lines: DataFrame, sep: str = ",", header_rows: int = 1) -> DataFrame:
    """Rows of delimited files, out of numbered lines, each under its own header:
    ``(sheet, at, header, cells)``.

    Files of one folder may differ in their columns and in the column order. Only the first lines of
    each file are grouped; all other lines go through without a shuffle. Quoted cells may hold line breaks; a file with a quote
    that is never closed has an empty header, so that it is set aside.
    """
    lines = whole_records(lines, sep)
    names = [f"line{n}" for n in range(1, header_rows + 1)]
    heads = _heads(lines.where(F.col("start") == 0), names)

    def written(line: str) -> Column:
        return F.coalesce(F.size(F.split(line, _literal(sep))), F.lit(0))

    # Quotes can only lower the number of cells, so the widest header line bounds the cells of all.
    width = heads.agg(*[F.max(written(name)) for name in names]).first()
    width = max([w for w in width if w] or [1])
    schema, options = ", ".join(f"c{i} string" for i in range(width)), {"sep": sep, **_QUOTING}

    def cells(line: str) -> Column:
        """Only a line with quotes needs the CSV parser; others are split."""
        parsed = F.from_csv(F.col(line), schema, options)
        quoted = F.array(*[parsed[f"c{i}"] for i in range(width)])
        return F.when(F.contains(F.col(line), F.lit('"')), quoted).otherwise(F.split(line, _literal(sep), -1))

    if header_rows == 1:
        header = F.transform(cells("line1"), lambda name: F.trim(F.replace(name, F.lit(BYTE_ORDER_MARK), F.lit(""))))
    else:
        header = merge_headers(F.slice(cells("line1"), F.lit(1), written("line1")), cells("line2"))
    rows = lookup_join(lines.select("sheet", "start", "at", "line", "torn"), heads.withColumn("header", header), "sheet", stored=True)
    is_data = not_blank("line") & ((F.col("start") != 0) | (F.col("at") > F.col("last")))
    header = F.when(F.col("torn"), F.array().cast("array<string>")).otherwise(F.col("header"))
    return rows.where(is_data).select("sheet", "at", header.alias("header"), cells("line").alias("cells"))


def read_sheets(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Rows of sheet files with two header rows each."""
    return rows_by_header(numbered(file_lines(spark.read.text(path))), sep, 2)


def read_mixed(spark: SparkSession, path: str, columns: Iterable[str], required: Iterable[str] = (),
               sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Like ``read_delimited`` for folders whose files differ: each file is read by its own header, and
    files without a required column are set aside instead of stopping the others."""
    rows = rows_by_header(numbered(file_lines(spark.read.text(path))), sep)
    return project_sheets(rows, {name: name for name in columns}, required)


def _literal(sep: str) -> str:
    return "\\" + sep if sep in "|.^$*+?" else sep


def project_sheets(rows: DataFrame, names: dict, required: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Wanted columns of sheet rows by header name (null where a sheet lacks one), and the sheets left
    out because a required column is missing or a quote is not closed."""
    complete = F.size("header") > 0
    for name in required:
        complete = complete & F.array_contains("header", name)
    def cell(name: str) -> Column:
        place = F.nullif(F.array_position("header", F.lit(name)), F.lit(0)).cast("int")
        return F.nullif(F.try_element_at(F.col("cells"), place), F.lit(""))

    picked = [cell(src).alias(dst) for src, dst in names.items()]
    return rows.where(complete).select("sheet", "at", *picked), rows.where(~complete).select("sheet").distinct()
