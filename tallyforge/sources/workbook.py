"""Workbooks (xlsx) as a data source: tasks stage parts of sheets, the commit puts them together, readers take a sheet each.

Writing is in two phases. Every task writes its rows as XML into files of a staging folder beside the target, under
names of its own attempt, so that a task that runs twice does no harm. Only the parts that the committed tasks name
are put together, sheet by sheet, into a draft that then takes the target's place in one move. If a task fails for
good, the staging folder goes and the old file stays as it was. While a target can't be replaced (somebody has it
open), the move is tried again, longer apart each time; at last the draft is kept under a ``_LOCKED_`` name.

Rows to write: ROWS. ``place`` orders the sheets, ``row`` the rows of a sheet; a cell is text, a number with so many
decimal places, or empty, in one of STYLES. Folders are any that pyarrow reaches and that all machines share.
"""

from __future__ import annotations

import re
import time
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import BooleanType, NumericType, Row, StructType

from tallyforge.sources.sinks import workbook_names

CELL = "struct<text: string, number: double, decimals: int, style: string>"
ROWS = f"place int, sheet string, row long, cells array<{CELL}>"
CELLS_READ = "place int, sheet string, row int, col int, text string, number double, style string"
#: What the format allows: rows of a sheet, characters of a cell.
MOST_ROWS, MOST_TEXT = 1_048_576, 32_767
TRIES, FIRST_WAIT_S, LONGER = 6, 0.7, 1.8
#: Fills of strong and moderate gaps, best contributions and the mirror row.
FILLS = {"red": "FFF2CBCB", "yellow": "FFFFF2CC", "green": "FFD9EAD3", "gray": "FFCDCDCD"}
#: name -> (fill, bold, italic); each style has a form with general numbers and one with two decimal places.
STYLES = {"": (None, False, False), "header": (None, True, False), "mirror": ("gray", False, True), **{name: (name, False, False) for name in FILLS}}
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_UNFIT = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")


def place_of(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def cell_xml(cell: Row | None) -> str:
    if cell is None:
        return "<c/>"
    names = list(STYLES)
    if cell["style"] and cell["style"] not in STYLES:
        raise ValueError(f"unknown style {cell['style']!r}: {names}")
    style = f' s="{2 * names.index(cell["style"] or "") + (cell["decimals"] == 2)}"'
    if cell["number"] is not None:
        n = cell["number"]
        return f"<c{style}><v>{int(n) if n == int(n) else n!r}</v></c>" if n - n == 0 else f"<c{style}/>"
    if cell["text"] is None:
        return f"<c{style}/>"
    if len(cell["text"]) > MOST_TEXT:
        raise ValueError(f"a cell holds {MOST_TEXT} characters at most")
    return f'<c{style} t="inlineStr"><is><t xml:space="preserve">{escape(_UNFIT.sub("", cell["text"]))}</t></is></c>'


@dataclass
class Part(WriterCommitMessage):
    """Files of one task: (place, sheet, first row, rows, file)."""

    files: list[tuple[int, str, int, int, str]] = field(default_factory=list)


class WorkbookWriter(DataSourceWriter):
    def __init__(self, path: str, copy: str | None):
        self.path, self.copy = path, copy
        self.staging = f"{path}.{uuid.uuid4().hex}.parts"

    def write(self, iterator: Iterator[Row]) -> Part:
        """Rows of a task, in order of place and row: a file for each sheet that it has rows of."""
        store, home = place_of(self.staging)
        store.create_dir(home, recursive=True)
        done, out, last = Part(), None, None
        try:
            for r in iterator:
                if last is None or r["place"] != last[0]:
                    if out:
                        out.close()
                    name = f"{home}/{r['place']}-{uuid.uuid4().hex}.xml"
                    out = store.open_output_stream(name)
                    done.files.append((r["place"], r["sheet"], r["row"], 0, name))
                elif (r["place"], r["row"]) < last:
                    raise ValueError("rows must come in order of place and row")
                last = (r["place"], r["row"])
                place, sheet, first, n, name = done.files[-1]
                if sheet != r["sheet"]:
                    raise ValueError(f"place {place} is of two sheets: {sheet!r} and {r['sheet']!r}")
                done.files[-1] = (place, sheet, first, n + 1, name)
                out.write(f"<row>{''.join(map(cell_xml, r['cells']))}</row>\n".encode())
        finally:
            if out:
                out.close()
        return done

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, home = place_of(self.staging)
        try:
            target = place_of(self.path)[1]
            draft = f"{target}.{uuid.uuid4().hex}.draft"
            sheets: dict[int, list] = {}
            for f in sorted(f for m in messages if m for f in m.files):
                sheets.setdefault(f[0], []).append(f)
            self.assemble(store, draft, [sheets[p] for p in sorted(sheets)])
            if self.copy:
                second = f"{draft}2"
                store.copy_file(draft, second)
                move(store, second, place_of(self.copy)[1])
            move(store, draft, target)
        finally:
            if store.get_file_info(home).type == fs.FileType.Directory:
                store.delete_dir(home)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, home = place_of(self.staging)
        if store.get_file_info(home).type == fs.FileType.Directory:
            store.delete_dir(home)

    def assemble(self, store: fs.FileSystem, draft: str, sheets: list[list]) -> None:
        for parts in sheets:
            if len({p[1] for p in parts}) > 1:
                raise ValueError(f"place {parts[0][0]} is of sheets {sorted({p[1] for p in parts})}")
            if sum(p[3] for p in parts) > MOST_ROWS:
                raise ValueError(f"sheet {parts[0][1]!r} has more than {MOST_ROWS} rows")
        names = workbook_names([parts[0][1] for parts in sheets])
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        override = lambda part, what: f'<Override PartName="{part}" ContentType="{kind}.{what}+xml"/>'
        numbers = range(1, len(sheets) + 1)
        with store.open_output_stream(draft) as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("[Content_Types].xml", f'<Types xmlns="{PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>{override("/xl/workbook.xml", "sheet.main")}{override("/xl/styles.xml", "styles")}{"".join(override(f"/xl/worksheets/sheet{i}.xml", "worksheet") for i in numbers)}</Types>')
            relation = lambda i, what, to: f'<Relationship Id="r{i}" Type="{RELATIONS}/{what}" Target="{to}"/>'
            z.writestr("_rels/.rels", f'<Relationships xmlns="{PACKAGE}/relationships">{relation(1, "officeDocument", "xl/workbook.xml")}</Relationships>')
            z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{RELATIONS}"><sheets>{"".join(f"<sheet name={quoteattr(n)} sheetId={quoteattr(str(i))} r:id={quoteattr(f"r{i}")}/>" for i, n in zip(numbers, names, strict=True))}</sheets></workbook>')
            z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{PACKAGE}/relationships">{"".join(relation(i, "worksheet", f"worksheets/sheet{i}.xml") for i in numbers)}{relation(len(sheets) + 1, "styles", "styles.xml")}</Relationships>')
            z.writestr("xl/styles.xml", styles_xml())
            for i, parts in zip(numbers, sheets, strict=True):
                with z.open(f"xl/worksheets/sheet{i}.xml", "w") as sheet:
                    sheet.write(f'<worksheet xmlns="{MAIN}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews><sheetData>\n'.encode())
                    for *_, name in sorted(parts, key=lambda p: p[2]):
                        with store.open_input_stream(name) as part:
                            while block := part.read(1 << 20):
                                sheet.write(block)
                    sheet.write(b"</sheetData></worksheet>")


def move(store: fs.FileSystem, draft: str, target: str) -> str:
    """Puts ``draft`` in the target's place, with patience; returns where it is."""
    for turn in range(TRIES):
        try:
            store.move(draft, target)
            return target
        except PermissionError:
            time.sleep(FIRST_WAIT_S * LONGER**turn)
    stem, dot, kind = target.rpartition(".")
    kept = f"{stem or target}_LOCKED_{datetime.now():%Y%m%d_%H%M%S}{dot}{kind if stem else ''}"
    store.move(draft, kept)
    return kept


def styles_xml() -> str:
    fills = "".join(f'<fill><patternFill patternType="solid"><fgColor rgb="{c}"/></patternFill></fill>' for c in FILLS.values())
    fonts = "".join(f"<font>{'<b/>' * b}{'<i/>' * i}</font>" for b, i in ((False, False), (True, False), (False, True)))
    places = {None: 0, **{name: 2 + i for i, name in enumerate(FILLS)}}
    form = lambda fill, bold, italic, n: f'<xf numFmtId="{n}" fontId="{1 if bold else 2 if italic else 0}" fillId="{places[fill]}" borderId="0" xfId="0" applyFill="1" applyFont="1" applyNumberFormat="1"/>'
    forms = "".join(form(*s, n) for s in STYLES.values() for n in (0, 2))
    return f'<styleSheet xmlns="{MAIN}"><fonts count="3">{fonts}</fonts><fills count="{2 + len(FILLS)}"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill>{fills}</fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="{2 * len(STYLES)}">{forms}</cellXfs></styleSheet>'


class Sheet(InputPartition):
    def __init__(self, place: int, name: str, file: str):
        self.place, self.name, self.file = place, name, file


class WorkbookReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Sheet]:
        """The workbook's sheets in order. Only the index of the archive is read here."""
        store, path = place_of(self.path)
        with store.open_input_file(path) as raw, zipfile.ZipFile(raw) as z:
            to = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
            sheets = ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{{{MAIN}}}sheet")
            return [Sheet(i, s.get("name"), f"xl/{to[s.get(f'{{{RELATIONS}}}id')].removeprefix('/xl/')}") for i, s in enumerate(sheets)]

    def read(self, partition: Sheet) -> Iterator[tuple]:
        """The cells of a sheet that aren't empty, row by row; only one row is held."""
        names, tag = list(STYLES), lambda x: f"{{{MAIN}}}{x}"
        store, path = place_of(self.path)
        with store.open_input_file(path) as raw, zipfile.ZipFile(raw) as z, z.open(partition.file) as part:
            row, rows = 0, None
            for event, x in ElementTree.iterparse(part, ("start", "end")):
                if event == "start":
                    rows = x if x.tag == tag("sheetData") else rows
                elif x.tag == tag("row"):
                    for col, c in enumerate(x.iter(tag("c"))):
                        style, text, value = int(c.get("s", 0)) // 2, c.find(f"{tag('is')}/{tag('t')}"), c.find(tag("v"))
                        if text is not None or value is not None:
                            yield (partition.place, partition.name, row, col, (text.text or "") if text is not None else None, float(value.text) if value is not None else None, names[style] if style < len(names) else "")
                    row += 1
                    rows.clear()


class Workbook(DataSource):
    """Format ``workbook``; options: path, and for writing copy (a second file that gets the same)."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return CELLS_READ

    def reader(self, schema: StructType) -> DataSourceReader:
        return WorkbookReader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if not overwrite and place_of(self.options["path"])[0].get_file_info(place_of(self.options["path"])[1]).type != fs.FileType.NotFound:
            raise ValueError(f"there is a file already: {self.options['path']}")
        return WorkbookWriter(self.options["path"], self.options.get("copy"))


def cells_of(df: DataFrame, columns: list[str], styles: dict[str, Column] | None = None) -> Column:
    """The cells of a row of ``df``: numbers as such, fractions with two places, all else as text; ``styles`` by column."""
    out = []
    for c in columns:
        kind, x = df.schema[c].dataType, F.col("`" + c.replace("`", "``") + "`")
        number = isinstance(kind, NumericType) and not isinstance(kind, BooleanType)
        decimals = 2 if kind.typeName() in ("double", "float", "decimal") else 0
        style = (styles or {}).get(c, F.lit(None).cast("string"))
        out.append(F.struct((F.lit(None) if number else x).cast("string").alias("text"), (x if number else F.lit(None)).cast("double").alias("number"), F.lit(decimals).alias("decimals"), style.alias("style")))
    return F.array(*out)


def header(columns: list[str]) -> Column:
    return F.array(*[F.struct(F.lit(c).alias("text"), F.lit(None).cast("double").alias("number"), F.lit(0).alias("decimals"), F.lit("header").alias("style")) for c in columns])


def sheet_rows(df: DataFrame, place: int, name: str, row: Column | None = None, styles: dict[str, Column] | None = None, columns: list[str] | None = None) -> DataFrame:
    """ROWS of one sheet: a header and the rows of ``df``, in its order or by a column of whole numbers of at least 0."""
    columns = columns or df.columns
    body = df.select(F.lit(place).alias("place"), F.lit(name).alias("sheet"), (F.monotonically_increasing_id() if row is None else row).cast("long").alias("row"), cells_of(df, columns, styles).alias("cells"))
    return df.sparkSession.range(1).select(F.lit(place).alias("place"), F.lit(name).alias("sheet"), F.lit(-1).cast("long").alias("row"), header(columns).alias("cells")).unionByName(body)


def write(rows: DataFrame, path: str, copy: str | None = None) -> None:
    """ROWS to a workbook at ``path``, which it replaces; ``copy`` gets the same."""
    rows.sparkSession.dataSource.register(Workbook)
    ready = rows.select("place", "sheet", "row", "cells").repartitionByRange(F.col("place"), F.col("row")).sortWithinPartitions("place", "row")
    to = ready.write.format("workbook").mode("overwrite")
    (to.option("copy", copy) if copy else to).save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """CELLS_READ of a workbook."""
    spark.dataSource.register(Workbook)
    return spark.read.format("workbook").load(path)
