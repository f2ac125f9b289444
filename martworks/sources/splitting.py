"""One large JSON or XML document read by many tasks.

A document can't be parsed from its middle, so a reader that parses whole files has one task for
a file of any size. What the middle lacks is little: whether it stands inside a string or a
comment, and how deep. Both are sums over what comes before. The file is read as rows that end
at every ``"`` (JSON) or ``<`` (XML), which splits like any text, and the rows of a block of the
file are never moved: the task that reads a block adds up its rows for either state it may begin
in; the blocks' totals, a few numbers each, are summed in order and tell every block its state
and depth. Then the task that reads a block knows each row's place and cuts the records out where
the depth says. The rows of a file are walked twice, whatever is done with the records, which are
staged; only the pieces of records that lie over a block's end are brought together. Each record
is parsed alone. A record is as large as it is, the document of any size.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.session import work_path

_BLOCK = ("file", "block")


class DocumentError(ValueError):
    """The document can't be cut into records."""


def _rows(spark: SparkSession, path: str, end: str) -> DataFrame:
    """(file, block, text): the file as rows that end at ``end``, in order within a block."""
    text = spark.read.option("lineSep", end).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("text"),
    )


def _earlier_blocks():
    by_file = Window.partitionBy("file").orderBy("block")
    return by_file.rowsBetween(Window.unboundedPreceding, -1)


def _sum(col: str, window) -> Column:
    return F.coalesce(F.sum(col).over(window), F.lit(0))


def _marked(net: Column, **marks: Column) -> Column:
    """One number for what a row adds to the depth (-1 to 1) and the ``marks``, as bits.

    A column costs each row some time on its way to the task's Python.
    """
    bits = [F.when(mark, 1 << n).otherwise(0) for n, mark in enumerate(marks.values(), 2)]
    return functools.reduce(lambda a, b: a + b, bits, net + 1).cast("int").alias("marks")


def _runs(batches: Iterator[pa.RecordBatch], marks: tuple) -> Iterator[tuple[bool, dict]]:
    """The batches' columns and ``marks``, cut where a block ends, and whether a block begins
    there."""
    last = None
    for batch in batches:
        block = batch.column("block").to_numpy()
        file = batch.column("file").dictionary_encode()
        names, file = file.dictionary, file.indices.to_numpy()
        cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(file) != 0)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for start, end in zip(edges[:-1], edges[1:]):
            if start == end:
                continue
            place = (names[int(file[start])].as_py(), int(block[start]))
            bits = batch.column("marks").slice(start, end - start).to_numpy()
            run = {name: (bits >> n) % 2 == 1 for n, name in enumerate(marks, 2)}
            run |= {"file": place[0], "block": place[1], "net": bits.astype(np.int64) % 4 - 1}
            if "text" in batch.schema.names:
                run["text"] = batch.column("text").slice(start, end - start)
                run["begin"] = batch.column("begin")[start].as_py()
            yield place != last, run
            last = place


def _before(values: np.ndarray) -> np.ndarray:
    """The sum of the values before each."""
    return np.cumsum(values) - values


def _net(run: dict, begins: bool) -> np.ndarray:
    net = run["net"]
    if begins and run["block"] == 0 and "element" in run:
        # what precedes the first '<' of a file is no tag
        net[0] = 0
    return net


def _alone(run: dict, turned: int) -> np.ndarray:
    """Rows that are the name looked for and the whole of a string: the row before opened it."""
    if "named" not in run:
        return np.zeros(len(run["turn"]), bool)
    return run["named"] & (np.concatenate([[turned], run["turn"][:-1]]) == 1)


_TOTALS = "file string, block long, turn long, net0 long, net1 long, rows long, turned int, alone boolean, named boolean"


def _totals(batches: Iterator[pa.RecordBatch], marks: tuple) -> Iterator[pa.RecordBatch]:
    """A row for each block: its turns, and what its rows add to the depth for either state
    that it may begin in; its last row's turn and whether that row is the name looked for."""
    out = []
    for begins, run in _runs(batches, marks):
        if begins:
            out.append({c: run[c] for c in _BLOCK} | {"turn": 0, "net0": 0, "net1": 0, "rows": 0, "turned": 0})
        sums = out[-1]
        turn, net = run["turn"].astype(np.int64), _net(run, begins)
        state = (sums["turn"] + _before(turn)) % 2
        sums["net0"] += int(net[state == 0].sum())
        sums["net1"] += int(net[state == 1].sum())
        sums["turn"] += int(turn.sum())
        sums["rows"] += len(turn)
        sums["alone"] = bool(_alone(run, sums["turned"])[-1])
        sums["named"] = "named" in run and bool(run["named"][-1])
        sums["turned"] = int(turn[-1])
    if out:
        fields = [f.split()[0] for f in _TOTALS.split(", ")]
        kinds = {"file": pa.string(), "turned": pa.int32(), "alone": pa.bool_(), "named": pa.bool_()}
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in out], kinds.get(c, pa.int64())) for c in fields], fields
        )


def _blocks(rows: DataFrame, marks: tuple) -> DataFrame:
    """How each block begins: (file, block, begin), from the rows' totals.

    ``begin`` is 8 times the depth and, as bits, whether the row before is a string and the name
    looked for (4), whether it changed the state (2), and the state (1).
    """
    blocks = rows.drop("text").mapInArrow(functools.partial(_totals, marks=marks), _TOTALS)
    in_order = Window.partitionBy("file").orderBy("block")
    blocks = blocks.withColumns(
        {
            "begins": _sum("turn", _earlier_blocks()) % 2,
            "before": F.coalesce(F.lag("turned").over(in_order), F.lit(0)),
        }
    )
    added = F.when(F.col("begins") == 0, F.col("net0")).otherwise(F.col("net1"))
    alone = F.when(F.col("rows") > 1, F.col("alone")).otherwise(F.col("named") & (F.col("before") == 1))
    blocks = blocks.withColumns({"added": added, "alone": alone})
    above = _sum("added", _earlier_blocks())
    came = F.coalesce(F.lag("alone").over(in_order), F.lit(False)).cast("int")
    begin = above * 8 + came * 4 + F.col("before") * 2 + F.col("begins")
    return blocks.select(*_BLOCK, begin.alias("begin"))


_CUT = (
    "file string, block long, number long, mine boolean, text binary, piece binary, "
    "state int, depth long, bad long, unsure long"
)
_CUT_TYPES = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("number", pa.int64()), ("mine", pa.bool_()),
     ("text", pa.binary()), ("piece", pa.binary()), ("state", pa.int32()), ("depth", pa.int64()),
     ("bad", pa.int64()), ("unsure", pa.int64())]
)
_UNKNOWN = -1


class _Block:
    """The rows of a block as they come: what is carried from batch to batch, what is cut."""

    def __init__(self, run: dict, level: int, find: Callable) -> None:
        if run["begin"] is None:
            raise DocumentError(f"{run['file']}: the file was split in other blocks than before")
        self.place = {c: run[c] for c in _BLOCK}
        self.level, self.find = level, find
        self.state, self.depth = run["begin"] & 1, run["begin"] >> 3
        self.turned, self.came = (run["begin"] >> 1) & 1, bool(run["begin"] & 4)
        self.number, self.mine, self.bad, self.unsure = 0, _UNKNOWN, 0, 0
        self.open, self.pieces = None, []
        self.last, self.out = self.state, []

    def add(self, run: dict, begins: bool) -> None:
        turn, net = run["turn"].astype(np.int64), _net(run, begins)
        state = (self.state + _before(turn)) % 2
        net[state == 1] = 0
        depth = self.depth + _before(net)
        alone = _alone(run, self.turned)
        came = np.concatenate([[self.came], alone[:-1]])
        if begins and run["block"] == 0 and "element" in run:
            run["element"][0] = False
        turns, value, starts, bad = self.find(run, state == 0, depth, came)
        # the last of the rows that say whether what follows is looked for
        at = np.maximum.accumulate(np.where(turns, np.arange(len(turns)), -1))
        mine = np.where(at >= 0, value[at].astype(np.int64), self.mine)
        number = self.number + np.cumsum(starts)
        self.bad += int((bad & (mine == 1)).sum())
        self.unsure += int((bad & (mine == _UNKNOWN)).sum())
        # a record is the row that opens it and all that is deeper
        member = (mine != 0) & (starts | (depth > self.level))
        numbers = number[member]
        if len(numbers):
            edges = np.concatenate([[0], np.flatnonzero(np.diff(numbers)) + 1, [len(numbers)]])
            lists = pa.ListArray.from_arrays(
                pa.array(edges, pa.int32()), run["text"].filter(pa.array(member))
            )
            texts = pc.binary_join(lists, b"").to_pylist()
            firsts = edges[:-1]
            if not member[0]:
                self.close()
            for n, m, text in zip(numbers[firsts].tolist(), mine[member][firsts].tolist(), texts):
                if self.open is None or self.open[0] != n:
                    self.close()
                    self.open = (n, m)
                self.pieces.append(text)
        if not member[-1]:
            self.close()
        self.last, self.state = int(state[-1]), int((state[-1] + turn[-1]) % 2)
        self.depth = int(depth[-1] + net[-1])
        self.turned, self.came = int(turn[-1]), bool(alone[-1])
        self.number, self.mine = int(number[-1]), int(mine[-1])

    def close(self, ended: bool = True) -> None:
        """Put out the record begun, as a piece if a part of it is, or may be, in another block."""
        if self.open is not None:
            number, mine = self.open
            whole = "text" if ended and number > 0 else "piece"
            self.out.append({"number": number, "mine": self.known(mine), whole: b"".join(self.pieces)})
        self.open, self.pieces = None, []

    def known(self, mine: int) -> bool | None:
        return None if mine == _UNKNOWN else bool(mine)

    def end(self) -> None:
        """One row that says how the block ends; ``state`` is that before its last row."""
        self.close(ended=False)
        self.out.append(
            {"number": self.number, "mine": self.known(self.mine), "state": self.last,
             "depth": self.depth, "bad": self.bad, "unsure": self.unsure}
        )

    def take(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        rows = [self.place | row for row in rows]
        return pa.RecordBatch.from_pylist(rows, _CUT_TYPES)


def _cut(
    batches: Iterator[pa.RecordBatch], level: int, marks: tuple, find: Callable
) -> Iterator[pa.RecordBatch]:
    """The records that begin and end in a block, the pieces of others, and the blocks' ends."""
    block = None
    for begins, run in _runs(batches, marks):
        if begins:
            if block is not None:
                block.end()
                yield block.take()
            block = _Block(run, level, find)
        block.add(run, begins)
        if block.out:
            yield block.take()
    if block is not None:
        block.end()
        yield block.take()


class _Cut:
    """The records of documents, cut by the tasks that read their blocks, and staged.

    ``rows`` has the columns ``file``, ``block``, ``text`` (binary) and ``marks``: what a row adds
    to the depth where the state before it is 0, and the bits ``marks``, of which ``turn`` is set
    where a row changes the state. ``find`` gives four columns: the rows that say whether the
    rows after them are looked for, what they say, the rows that open a record, and those that
    must not be among the rows looked for. A record opens at the depth ``level``.
    """

    def __init__(
        self, spark: SparkSession, rows: DataFrame, level: int, marks: tuple, find: Callable
    ) -> None:
        # a row for each block of the files; a block that it lacks raises
        placed = rows.join(F.broadcast(_blocks(rows, marks)), list(_BLOCK), "left")
        work = functools.partial(_cut, level=level, marks=marks, find=find)
        cut = placed.mapInArrow(work, _CUT)
        cut = cut.withColumns({c: F.col(c).cast("string") for c in ("text", "piece")})
        path = work_path(spark, "document-records")
        cut.write.parquet(path)
        self.rows = spark.read.schema(cut.schema).parquet(path)
        # (file, block, ..., base, came): how many records began in the blocks before, and
        # whether the rows before the block's first that says so are looked for
        ends = self.rows.where(F.col("state").isNotNull())
        came = F.last("mine", ignorenulls=True).over(_earlier_blocks())
        self.blocks = ends.select(
            *_BLOCK, "state", "depth", "bad", "unsure",
            _sum("number", _earlier_blocks()).alias("base"),
            F.coalesce(came, F.lit(False)).alias("came"),
        )

    def at_end(self) -> DataFrame:
        """Each file's end: (file, state, depth), the state before its last row."""
        last = F.max_by(F.struct("state", "depth"), "block").alias("z")
        return self.blocks.groupBy("file").agg(last).select("file", "z.*")

    def misfits(self) -> DataFrame:
        """The blocks with rows that must not be among those looked for."""
        return self.blocks.where((F.col("bad") > 0) | (F.col("came") & (F.col("unsure") > 0)))

    def texts(self) -> DataFrame:
        """(file, record, text) of the records."""
        blocks = F.broadcast(self.blocks.select(*_BLOCK, "base", F.col("came").alias("_came")))
        record = (F.col("number") + F.col("base")).alias("record")
        mine = F.coalesce("mine", "_came")
        whole = self.rows.where(F.col("text").isNotNull()).join(blocks, list(_BLOCK)).where(mine)
        pieces = self.rows.where(F.col("piece").isNotNull()).join(blocks, list(_BLOCK)).where(mine)
        pieces = pieces.select("file", record, "block", "piece")
        in_order = F.sort_array(F.collect_list(F.struct("block", "piece")))
        text = F.array_join(F.transform(in_order, lambda p: p["piece"]), "")
        return whole.select("file", record, "text").unionAll(
            pieces.groupBy("file", "record").agg(text.alias("text"))
        )


def _check(found: DataFrame, what: str) -> None:
    bad = found.first()
    if bad is not None:
        raise DocumentError(f"{bad['file']}: {what}")


# -- JSON ----------------------------------------------------------------------------------


def _find_json(run: dict, outside: np.ndarray, depth: np.ndarray, came: np.ndarray) -> tuple:
    # the top-level keys: where the array of the field begins, and the next key
    key = outside & (depth == 1) & run["colon"]
    starts = outside & (depth == 2) & run["brace"]
    loose = (depth == 2) & (~outside | run["solid"])
    keyed = (depth == 1) & run["beside"] & outside & ~key
    return key, came, starts, loose | keyed


def json_record_texts(spark: SparkSession, path: str, field: str) -> DataFrame:
    """(file, record, text): the objects of the array ``field`` of each file's one object.

    A file without the array, or with an empty one, has no rows. Strings and brackets that
    don't close raise, as elements that are no objects do.
    """
    rows = _rows(spark, path, '"')
    # a quote after an odd number of backslashes is part of the string
    quote = 1 - F.length(F.regexp_extract("text", r"(\\+)$", 1)) % 2
    units = F.split("text", r"(?<=[\[\]{}])|(?=[\[\]{}])")
    named = F.col("text") == field
    rows = rows.withColumns({"quote": quote, "size": F.size(units), "named": named})
    rows = rows.select(
        *_BLOCK, "quote", "size", "named", F.posexplode(units).alias("part", "text")
    )
    ends_row = F.col("part") == F.col("size") - 1
    text = F.col("text")
    net = F.when(text.isin("{", "["), 1).when(text.isin("}", "]"), -1).otherwise(0)
    piece = F.when(ends_row, F.concat(text, F.lit('"'))).otherwise(text)
    marks = {
        "turn": ends_row & (F.col("quote") == 1),
        "named": F.col("named"),
        "colon": text.rlike(r"^\s*:"),
        "brace": text == "{",
        "solid": text.rlike(r"[^\s,\[\]{}]"),
        "beside": text.rlike(r"[^\s,\[\]}]"),
    }
    rows = rows.select(*_BLOCK, _marked(net, **marks), piece.cast("binary").alias("text"))
    cut = _Cut(spark, rows, 2, tuple(marks), _find_json)
    # the last row of a file ends without a quote
    left = (F.col("state") != 0) | (F.col("depth") != 0)
    _check(cut.at_end().where(left), "a string or a bracket is not closed")
    _check(cut.misfits(), f"{field} is no array of objects")
    return cut.texts()


def read_large_json(
    spark: SparkSession,
    path: str,
    field: str,
    element_schema: T.StructType,
    position_col: str | None = None,
) -> DataFrame:
    """S3 on documents of any size: a row for each object of the array ``field``.

    As :func:`martworks.sources.readers.read_json_records` with ``multi_line``, which reads a
    file in one task; a malformed record fails the job.
    """
    texts = json_record_texts(spark, path, field)
    record = F.from_json("text", element_schema, {"mode": "FAILFAST"})
    return _records(texts, record, position_col)


def _records(texts: DataFrame, record: Column, position_col: str | None) -> DataFrame:
    place = F.struct("file", F.col("record").alias("pos"))
    parsed = texts.select(record.alias("_rec"), place.alias("_place"))
    if position_col is None:
        return parsed.select("_rec.*")
    return parsed.select("_rec.*", F.col("_place").alias(position_col))


# -- XML -----------------------------------------------------------------------------------


def _find_xml(run: dict, live: np.ndarray, depth: np.ndarray, came: np.ndarray) -> tuple:
    child = live & run["element"] & ~run["ends"] & (depth == 1)
    begins = child & run["record"]
    return child, begins, begins, np.zeros(len(child), bool)


def xml_record_texts(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    """(file, record, text): the ``row_tag`` children of each file's root element.

    Comments are passed over, whatever stands in them. A CDATA section that holds ``<`` raises:
    such files are read whole.
    """
    rows = _rows(spark, path, "<")
    text = F.col("text")
    opened, closed = text.startswith("!--"), text.contains("-->")
    _check(
        rows.where(text.startswith("![CDATA[") & ~text.contains("]]>")),
        "a CDATA section holds '<'; read the file whole",
    )
    tag = F.regexp_extract("text", r"^/?([^\s/>!?]+)", 1)
    element = (tag != "") & ~opened
    ends = text.startswith("/")
    alone = text.rlike(r"""^(?:[^>"']|"[^"]*"|'[^']*')*/>""")
    net = F.when(~element | alone, 0).when(ends, -1).otherwise(1)
    marks = {
        # a comment that a row opens and doesn't close, or closes and didn't open
        "turn": opened != closed,
        "element": element,
        "ends": ends,
        "record": tag == row_tag,
    }
    piece = F.concat(F.lit("<"), "text").cast("binary")
    rows = rows.select(*_BLOCK, _marked(net, **marks), piece.alias("text"))
    cut = _Cut(spark, rows, 1, tuple(marks), _find_xml)
    left = (F.col("state") == 0) & (F.col("depth") != 0)
    _check(cut.at_end().where(left), "an element is not closed")
    return cut.texts()


def read_large_xml(
    spark: SparkSession,
    path: str,
    row_tag: str,
    schema: T.StructType,
    ignore_surrounding_spaces: bool = False,
    position_col: str | None = None,
) -> DataFrame:
    """S4 on documents of any size: a row for each ``row_tag`` child of the root element.

    As :func:`martworks.sources.readers.read_xml_records` with ``direct_children_only``, which
    reads a file in one task; a malformed record fails the job.
    """
    options = {
        "mode": "FAILFAST",
        "rowTag": row_tag,
        "ignoreSurroundingSpaces": str(ignore_surrounding_spaces).lower(),
    }
    texts = xml_record_texts(spark, path, row_tag)
    return _records(texts, F.from_xml("text", schema, options), position_col)
