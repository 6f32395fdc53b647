"""CSV scan of an order feed: every column as text, taken by header name.

One pass over the files' lines, before anything is parsed, tells for every
file its header, whether a quoted cell goes over a line end, and whether the
bytes are text in the feed's encoding. Files whose records are single lines
are then parsed by Spark's CSV scan, split as usual.

The others stay split too. What a line does to the quoting state is one of
four things: keep it, leave a quote open, leave none open, or turn it round.
Composed over a split's lines that gives the split's effect, composed over
the splits before it the state a split starts in, and from there every line's
record follows. Only such files' lines are shuffled, by split, and by record
those of the records that a split's border cuts.
"""

from __future__ import annotations

import csv
import os
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources.feeds import FeedSpec

MALFORMED = "_malformed_line"

# A cell that is complete, and a line whose last cell is quoted and not closed.
# A quote is special only where a cell begins, and inside a quoted cell.
_CELL = r'(?:"[^"]*+(?:""[^"]*+)*+"(?:[^",][^,]*+)?+|[^",][^,]*+|)'
_LEFT_OPEN = rf'\A(?:{_CELL},)*+"[^"]*+(?:""[^"]*+)*+\z'
_BLANKS = " \t\r\x0b\x0c"


def csv_schema(columns) -> str:
    return ", ".join(f"`{c.replace('`', '``')}` string" for c in [*columns, MALFORMED])


def _options(spec: FeedSpec) -> dict[str, str]:
    """How a feed's lines are parsed. Column pruning is off, since it hides a
    line's surplus cells from the parser."""
    return {"header": "true", "encoding": spec.encoding, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false", "mode": "PERMISSIVE", "columnPruning": "false", "columnNameOfCorruptRecord": MALFORMED}


def refuse_malformed(cells: DataFrame, spec: FeedSpec) -> DataFrame:
    """Fail the read on a record with more cells than the header rather than
    load it shifted. Records with fewer cells load with the rest missing."""
    columns = [c for c in cells.columns if c != MALFORMED]
    line = F.col(MALFORMED)
    unquoted = F.regexp_replace(line, r'"(?:[^"]|"")*"', "")
    bad = line.isNotNull() & (unquoted.contains('"') | (F.size(F.split(unquoted, ",")) > len(columns)))
    # The message names a cell too: a filter on the malformed line alone is refused by the CSV source.
    message = F.concat(F.lit(f"{spec.name}: line with surplus cells or an unbalanced quote: "),
                       F.substring(line, 1, 200), F.substring(F.coalesce(F.col(f"`{columns[0]}`"), F.lit("")), 1, 0))
    return cells.where(F.coalesce(F.when(bad, F.raise_error(message).cast("boolean")), F.lit(True))).select(
        *[f"`{c}`" for c in columns])


@dataclass(frozen=True)
class FeedFile:
    path: str
    header: tuple[str, ...]
    spans_lines: bool


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Physical lines as their bytes (in a string column), with file, split
    (its first byte) and an id that ascends by line within a split."""
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))


def left_open(line: Column) -> Column:
    """Whether a quoted cell is open at the end of a line that begins outside
    quotes. Of one that begins inside, prefix a quote."""
    return line.contains('"') & line.rlike(_LEFT_OPEN)


def _text(line: Column, spec: FeedSpec) -> Column:
    return F.decode(line.cast("binary"), spec.encoding)


def survey_files(spark: SparkSession, paths: Sequence[str], spec: FeedSpec) -> list[FeedFile]:
    """What one pass over the lines tells of each file that is not empty: one
    row a file comes back. Bytes that are not text in a UTF-8 feed stop the
    load here, as do a header with a line end in it and, in a file with quoted
    line ends, blank lines before the header."""
    line = F.col("value")
    full = F.btrim("value", F.lit(_BLANKS)) != ""
    within = line.contains('"') & F.regexp_replace(line, "\r$", "").contains("\r")
    invalid = ~F.is_valid_utf8("value") if spec.encoding.upper() == "UTF-8" else F.lit(False)
    first = lambda wanted: F.min(F.when(wanted, F.struct("block", "at", line.cast("binary").alias("bytes"))))
    rows = _lines(spark, paths).groupBy("file").agg(
        first(full).alias("header"), first(F.lit(True)).alias("start"), first(invalid).alias("invalid"),
        F.bool_or(left_open(line) | within).alias("spans")).collect()
    files = []
    for r in sorted(rows, key=lambda r: r.file):
        if r.invalid is not None:
            raise ValueError(f"{spec.name}: {r.file}: line that is not {spec.encoding}: {bytes(r.invalid.bytes)[:200]!r}")
        if r.header is None:
            continue
        text = bytes(r.header.bytes).decode(spec.encoding).removeprefix("﻿").rstrip("\r")
        if r.spans and (text.count('"') % 2 or r.header != r.start):
            raise ValueError(f"{spec.name}: {r.file}: header over more than one line, or blank lines before it: {text[:200]!r}")
        files.append(FeedFile(unquote(r.file), _distinct(next(csv.reader([text]))), r.spans))
    return files


def _distinct(names: Sequence[str]) -> tuple[str, ...]:
    """Column names; a repeated one is numbered, so the first is the column."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        n = seen[name] = seen.get(name, -1) + 1
        out.append(f"{name}.{n}" if n else name)
    return tuple(out)


def literal_path(path: str) -> str:
    """A path as itself where a reader expands patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _effect(lines: DataFrame) -> DataFrame:
    """``sets``: the state (1: in quotes) after the line whatever it was
    before; ``turns``: 1 if the line turns it round. Neither: kept."""
    opens, stays = left_open(F.col("value")), F.when(
        F.col("value").contains('"'), left_open(F.concat(F.lit('"'), F.col("value")))).otherwise(True)
    return lines.withColumn("opens", opens).withColumn("stays", stays).select(
        *lines.columns, F.when(F.col("opens") == F.col("stays"), F.col("opens").cast("int")).alias("sets"),
        (F.col("opens") & ~F.col("stays")).cast("int").alias("turns"))


def _state_after(rows: DataFrame, by: Sequence[str], order: str, start: Column) -> DataFrame:
    """``rows`` with ``after``: the state behind each, by the effects up to it."""
    so_far = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("turned", F.sum("turns").over(so_far))
    rows = rows.withColumn("fixed", F.last(F.when(F.col("sets").isNotNull(), F.struct("sets", "turned")), ignorenulls=True).over(so_far))
    return rows.withColumn("after", ((F.coalesce(F.col("fixed.sets"), start) + F.col("turned")
                                      - F.coalesce(F.col("fixed.turned"), F.lit(0))) % 2).cast("int")).drop("turned", "fixed")


def _splits(lines: DataFrame) -> DataFrame:
    """file, block, start (state the split begins in), before (records begun
    in earlier splits), begun (in this one) and after.

    The lines of a split that have an effect are folded in order: the split's
    own effect, and how many lines begin outside quotes if it starts so (with
    ``outside``), starts inside (``inside``), or either way (``always``)."""
    events = F.sort_array(F.collect_list(F.when((F.col("sets").isNotNull()) | (F.col("turns") == 1), F.struct("at", "sets", "turns"))))
    number = lambda c: c.cast("bigint")

    def through(acc: Column, at: Column) -> dict[str, Column]:
        lines = at - acc["at"]
        known, odd = acc["sets"].isNotNull(), acc["turns"] % 2 == 1
        none_open = (acc["sets"] + acc["turns"]) % 2 == 0
        return {"always": number(acc["always"] + F.when(known & none_open, lines).otherwise(0)),
                "outside": number(acc["outside"] + F.when(~known & ~odd, lines).otherwise(0)),
                "inside": number(acc["inside"] + F.when(~known & odd, lines).otherwise(0))}

    def state(at: Column, sets: Column, turns: Column, counts: dict[str, Column]) -> Column:
        return F.struct(at.alias("at"), sets.cast("int").alias("sets"), turns.cast("int").alias("turns"),
                        *[c.alias(n) for n, c in counts.items()])

    zero = F.lit(0).cast("bigint")
    begin = state(F.col("first") - 1, F.lit(None), F.lit(0), {"always": zero, "outside": zero, "inside": zero})
    step = lambda acc, e: state(e["at"], F.coalesce(e["sets"], acc["sets"]),
                                F.when(e["sets"].isNotNull(), 0).otherwise((acc["turns"] + e["turns"]) % 2), through(acc, e["at"]))
    folded = (lines.groupBy("file", "block").agg(events.alias("events"), F.min("at").alias("first"), F.max("at").alias("last"))
              .withColumn("acc", F.aggregate("events", begin, step))
              .withColumn("counts", F.struct(*[c.alias(n) for n, c in through(F.col("acc"), F.col("last")).items()]))
              .select("file", "block", ((F.col("acc.sets") + F.col("acc.turns")) % 2).alias("sets"),
                      F.when(F.col("acc.sets").isNull(), F.col("acc.turns")).otherwise(0).alias("turns"), "counts.*"))
    states = _state_after(folded, ["file"], "block", F.lit(0))
    in_file = Window.partitionBy("file").orderBy("block")
    states = states.withColumn("start", F.coalesce(F.lag("after").over(in_file), F.lit(0)))
    begun = F.col("always") + F.when(F.col("start") == 0, F.col("outside")).otherwise(F.col("inside"))
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    return states.withColumn("begun", begun).select(
        "file", "block", "start", "after", F.coalesce(F.sum("begun").over(earlier), F.lit(0)).alias("before"), "begun")


def records(spark: SparkSession, paths: Sequence[str], spec: FeedSpec) -> DataFrame:
    """file, record (1 for the header) and text of every record of files in
    which quoted cells go over line ends. A quote that is still open at the
    end of its file stops the load."""
    lines = _effect(_lines(spark, paths))
    # one small row a split, written because two steps read it
    folder = os.path.join(ensure_checkpoint_dir(spark), "csv_splits", uuid.uuid4().hex)
    _splits(lines).write.parquet(folder)
    splits = spark.read.parquet(folder)
    endless = splits.groupBy("file").agg(F.max_by("after", "block").alias("after")).where("after = 1").limit(1).collect()
    if endless:
        raise ValueError(f"{spec.name}: {endless[0].file}: a quote is still open at the end of the file")
    lines = _state_after(lines.join(splits.withColumnRenamed("after", "ends"), ["file", "block"]), ["file", "block"], "at", F.col("start"))
    in_split = Window.partitionBy("file", "block").orderBy("at")
    lines = lines.withColumn("begins", (F.coalesce(F.lag("after").over(in_split), F.col("start")) == 0).cast("int"))
    record = F.col("before") + F.sum("begins").over(in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # Where the lines are, by split, they become records; only those that a
    # split's border cuts, two a split at most, are put together by a shuffle.
    cut = ((F.col("start") == 1) & (F.col("record") == F.col("before"))) | (
        (F.col("ends") == 1) & (F.col("record") == F.col("before") + F.col("begun")))
    joined = lambda order, text: F.array_join(F.sort_array(F.collect_list(F.struct(order, text)))["text"], "\n")
    parts = lines.withColumn("record", record).withColumn("cut", cut).groupBy("file", "block", "record", "cut").agg(
        joined("at", _text(F.col("value"), spec).alias("text")).alias("text"))
    across = parts.where("cut").groupBy("file", "record").agg(joined("block", "text").alias("text"))
    return (parts.where("NOT cut").select("file", "record", "text").unionByName(across)
            .withColumn("text", F.regexp_replace("text", "\r\\z", "")))


def _scan(spark: SparkSession, paths: Sequence[str], names: Sequence[str], spec: FeedSpec) -> DataFrame:
    return spark.read.options(**_options(spec)).schema(csv_schema(names)).csv(list(paths))


def _parse(given: DataFrame, names: Sequence[str], spec: FeedSpec) -> DataFrame:
    options = _options(spec) | {"header": "false", "multiLine": "true"}
    body = given.where((F.col("record") > 1) & (F.btrim("text", F.lit(_BLANKS + "\n")) != ""))
    return body.select(F.from_csv("text", csv_schema(names), options).alias("cells")).select("cells.*")


def read_feed_csv(spark: SparkSession, path: str | Sequence[str], spec: FeedSpec) -> DataFrame:
    """Header CSV -> all-STRING DataFrame with the files' own column names.

    Quotes are escaped by doubling (``""``); white space is kept verbatim;
    quoted cells may hold line ends. Every file has its own header, and its
    columns are taken by name: files may order them differently, and a column
    that a file lacks is missing (null) there. Surplus cells, a quote that is
    never closed and bytes that are not text in the feed's encoding stop the
    load. One scan is planned for each distinct header.
    """
    paths = [path] if isinstance(path, str) else list(path)
    files = survey_files(spark, paths, spec)
    layouts = {(f.header, f.spans_lines) for f in files}
    parts = []
    for header, spans in sorted(layouts):
        own = paths if len(layouts) == 1 else [literal_path(f.path) for f in files if (f.header, f.spans_lines) == (header, spans)]
        cells = _parse(records(spark, own, spec), header, spec) if spans else _scan(spark, own, header, spec)
        parts.append(refuse_malformed(cells, spec))
    if not parts:
        return spark.createDataFrame([], ", ".join(f"`{h}` string" for h in spec.headers))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part, allowMissingColumns=True)
    return table
