"""S1–S7 — scans of vendor export files.

* CSV exports (S1/S3/S6): files are read in splits, whatever their size, also
  where quoted fields hold line breaks.  A first pass finds for every split how it
  turns the state at its start (inside quotes or not) into the state at its end;
  chaining these per file says where records begin, and the second pass cuts them.
  Files are then grouped by header line, so that each layout has its own column
  order.  What cannot be read goes to a quarantine table.
* JSON exports (S2): multi-line JSON, nested objects flattened to dotted
  column names.
* Preamble time series (S4) and audience sections (S5): whole files as
  rows, split into numbered lines with ``posexplode`` so file position is
  explicit, then parsed with native expressions.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.session import cut_lineage, stored
from pulsekit.sources import greek
from pulsekit.sources.normalize import normalize_export

# Fixed values that must equal the reference: account-level files that the
# post-export scan skips, and the encoding fallback orders.
ACCOUNT_FILES = {
    "follows.csv", "reach.csv", "views.csv", "visits.csv",
    "interactions.csv", "link_clicks.csv", "link clicks.csv", "audience.csv",
    "overview.csv", "viewers.csv", "followerhistory.csv",
    "followeractivity.csv", "followergender.csv",
    "followertopterritories.csv",
}
POST_ENCODINGS = ["utf-8", "utf-8-sig", "cp949", "euc-kr", "latin-1"]
TIKTOK_ENCODINGS = ["utf-8-sig", "utf-8", "utf-16", "cp1253", "latin-1"]


def _decode_first(encodings: list[str]):
    def run(it):
        for pdf in it:
            out = []
            for b in pdf["content"]:
                txt = None
                for enc in encodings:
                    try:
                        txt = bytes(b).decode(enc)
                        break
                    except (UnicodeDecodeError, LookupError):
                        continue
                out.append(txt.lstrip("\ufeff") if txt is not None else None)
            yield pd.DataFrame({"path": pdf["path"], "text": out})
    return run


def read_text_files(spark: SparkSession, path: str | list[str], encodings: list[str] = POST_ENCODINGS,
                    glob: str | None = None) -> DataFrame:
    """Whole files as (path, text), decoded with the first encoding that
    works (S1/S6).  Valid UTF-8 is decoded in the JVM; only the remaining
    files go through the Arrow-batched Python decoder."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    b = r.load(path).select("path", "content")
    utf8 = F.is_valid_utf8("content")
    jvm = b.where(utf8).select("path", F.regexp_replace(F.decode("content", "UTF-8"), "^\ufeff", "").alias("text"))
    other = b.where(~utf8).mapInPandas(_decode_first([e for e in encodings if not e.startswith("utf-8")]),
                                       "path string, text string")
    return jvm.unionByName(other)


def lines(texts: DataFrame) -> DataFrame:
    """(path, line_no, line) — explicit position inside each file."""
    return texts.select("path", F.posexplode(F.split(F.regexp_replace("text", "\r\n?", "\n"), "\n"))
                        .alias("line_no", "line"))


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested struct columns -> dotted top-level columns."""
    def walk(schema, prefix):
        out = []
        for f in schema.fields:
            name = f"{prefix}{f.name}"
            if isinstance(f.dataType, T.StructType):
                out += walk(f.dataType, name + ".")
            else:
                out.append(name)
        return out
    cols = walk(df.schema, "")
    return df.select(*[F.col(".".join(f"`{p}`" for p in c.split("."))).alias(c.replace(".", sep)) for c in cols])


def read_json_exports(spark: SparkSession, paths: list[str]) -> DataFrame:
    return flatten(spark.read.option("multiLine", True).json(paths)).withColumn("source_file", F.input_file_name())


CSV_GLOB, JSON_GLOB = "*.[cC][sS][vV]", "*.[jJ][sS][oO][nN]"
#: UTF-16 files are decoded whole; a larger one cannot be one cell and goes to quarantine.
CELL_BYTES = 2_000_000_000
QUARANTINE = "source_file string, position long, reason string, record string"


def _is_export(name: F.Column) -> F.Column:
    return ~name.startswith(".") & (name != "template.csv") & ~F.lower(name).isin(sorted(ACCOUNT_FILES))


# -- records of quoted CSV, in splits -----------------------------------------------

#: Complete fields of a line read from outside quotes; quotes within an unquoted field are ordinary characters.
_FIELD = rb'(?:"(?:[^"]|"")*+"[^,]*+|(?!")[^,]*+)'
_CLOSED = re.compile(rb"%s(?:,%s)*+" % (_FIELD, _FIELD))
#: The rest of a quoted field that began on an earlier line, up to its closing quote, and what follows it.
_REST = re.compile(rb'(?:[^"]|"")*+"[^,]*+(?:,%s)*+' % _FIELD)


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a line that begins inside (or outside) a quoted field ends inside one."""
    if b'"' not in line:
        return inside
    return (_REST if inside else _CLOSED).fullmatch(line) is None


def _text_lines(spark: SparkSession, root: str) -> DataFrame:
    """(uri, name, block, raw): the lines of all CSV files in splits, within a split in order."""
    return (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", CSV_GLOB).option("lineSep", "\n").text(root)
            .select(F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_name").alias("name"),
                    F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("raw")))


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[bytes] | list[bytes]]]:
    """Runs of lines of one (uri, block)."""
    for b in batches:
        uris, blocks, raws = b.column("uri").to_pylist(), b.column("block").to_pylist(), b.column("raw").to_pylist()
        lo = 0
        for hi in range(1, len(uris) + 1):
            if hi == len(uris) or uris[hi] != uris[lo] or blocks[hi] != blocks[lo]:
                yield (uris[lo], blocks[lo]), raws[lo:hi]
                lo = hi


def _scan(encodings: list[str]):
    """Per split: its end state from either start state, and the encodings (by bit) in which one of its lines does not decode."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, out, into, bad, marked = None, False, True, 0, False

        def summary() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"uri": [at[0]], "block": pa.array([at[1]], pa.int64()), "out": pa.array([int(out)], pa.int32()),
                                               "into": pa.array([int(into)], pa.int32()), "bad": pa.array([bad], pa.int64()), "marked": [marked]})
        for where, raws in _splits(batches):
            if where != at:
                if at is not None:
                    yield summary()
                at, out, into, bad, marked = where, False, True, 0, False
                marked = where[1] == 0 and raws[0][:2] in (b"\xff\xfe", b"\xfe\xff")
            for raw in raws:
                line = raw.removesuffix(b"\r")
                out, into = ends_inside(line, out), ends_inside(line, into) if into != out else ends_inside(line, out)
                if not raw.isascii():
                    for i, enc in enumerate(encodings):
                        if not bad >> i & 1:
                            try:
                                raw.decode(enc)
                            except (UnicodeDecodeError, LookupError):
                                bad |= 1 << i
        if at is not None:
            yield summary()
    return run


def _path_of(uri: str) -> str:
    """The path that reads the file of a uri and no other: unquoted, pattern characters escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(uri))


def _byte_encodings(encodings: list[str]) -> list[str]:
    """Those in which line ends, quotes and commas are single bytes."""
    return [e for e in encodings if not e.startswith("utf-16")]


def scan_splits(lines: DataFrame, encodings: list[str]) -> DataFrame:
    """(uri, block, inside, bad, marked): per split whether it begins inside a quoted field."""
    blocks = lines.select("uri", "block", "raw").mapInArrow(_scan(_byte_encodings(encodings)), "uri string, block long, out int, into int, bad long, marked boolean")
    # a split sends the state at its start to that at its end: it keeps it, swaps it, or ends alike from both
    before = Window.partitionBy("uri").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("uri").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = blocks.withColumn("swaps", F.sum(F.when(F.col("out") > F.col("into"), 1).otherwise(0)).over(upto))
    fixed = F.last(F.when(F.col("out") == F.col("into"), F.struct("out", "swaps")), ignorenulls=True).over(before)
    swaps = F.coalesce(F.last("swaps").over(before), F.lit(0))
    state = F.pmod(F.coalesce(fixed["out"], F.lit(0)) + swaps - F.coalesce(fixed["swaps"], F.lit(0)), F.lit(2))
    return blocks.select("uri", "block", (state == 1).alias("inside"), "bad", "marked")


def _ended(record: bytes) -> bytes:
    """A record without its line end; where that is CR LF, line breaks in its fields become LF, as in Spark's own reader."""
    return record[:-1].replace(b"\r\n", b"\n") if record.endswith(b"\r") else record


def _glued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw = [_ended(b"\n".join(x)) for x in b.column("raws").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("uri"), b.column("position"), pa.array(raw, pa.binary()), b.column("closed")], ["uri", "position", "raw", "closed"])


def _cut(inside: set[tuple[str, int]]):
    """Records of each split: whole ones, the opening piece of one that goes on in the next split, and the closing piece of one begun before.

    ``inside`` names the splits that begin inside a quoted field.
    """
    whole, opening, middle, closing = 0, 1, 2, 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, held, begun, seq = None, False, [], True, 0
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            rows = list(zip(*out)) if out else [[], [], [], [], []]
            out.clear()
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], ["uri", "block", "seq", "piece", "raw"])

        for where, raws in _splits(batches):
            if where != at:
                if held:
                    out.append((*at, seq, opening if begun else middle, b"\n".join(held)))
                at, state, held, seq = where, where in inside, [], 0
                begun = not state
            for raw in raws:
                state = ends_inside(raw.removesuffix(b"\r"), state)
                held.append(raw)
                if not state:
                    record = b"\n".join(held)
                    if not begun:
                        out.append((*at, seq, closing, record))
                        seq += 1
                    elif record := _ended(record):
                        out.append((*at, seq, whole, record))
                        seq += 1
                    held, begun = [], True
            if len(out) >= 2000:
                yield flush()
        if held:
            out.append((*at, seq, opening if begun else middle, b"\n".join(held)))
        yield flush()
    return run


def csv_records(spark: SparkSession, root: str, encodings: list[str] = POST_ENCODINGS, accept=_is_export) -> tuple[DataFrame, DataFrame]:
    """Records (uri, position, text, closed) of all CSV files under ``root``, and their files (uri, encoding, first).

    A file's encoding is the first in which all of it decodes and holds for its header and its records.
    Positions increase within a file.  ``closed`` is false for a record whose last quoted field has no end.
    UTF-16 files go by their mark and are decoded whole.  Empty lines are no records.
    """
    lines = _text_lines(spark, root).where(accept(F.col("name")))
    blocks = cut_lineage(scan_splits(lines, encodings))      # a row per split
    inside = {(r["uri"], r["block"]) for r in blocks.where("inside AND NOT marked").select("uri", "block").collect()}
    plain = _byte_encodings(encodings)
    name = F.lit(None).cast("string")
    for i, enc in reversed(list(enumerate(plain))):
        name = F.when(F.col("bad").bitwiseAND(F.lit(1 << i)) == 0, enc).otherwise(name)
    files = (blocks.groupBy("uri").agg(F.bit_or("bad").alias("bad"), F.bool_or("marked").alias("marked"))
             .select("uri", F.when(F.col("marked"), "utf-16").otherwise(name).alias("encoding")))
    files = stored(files)                                    # a row per file, of a size that Spark knows: records are not shuffled to meet it
    pieces = lines.select("uri", "block", "raw").mapInArrow(_cut(inside), "uri string, block long, seq long, piece int, raw binary")
    # the few records that cross splits are put together again, in the order of the splits
    position = F.col("block") + F.col("seq")
    number = F.sum(F.when(F.col("piece") == 1, 1).otherwise(0)).over(Window.partitionBy("uri").orderBy("block", "seq").rowsBetween(Window.unboundedPreceding, 0))
    crossing = (pieces.where("piece > 0").withColumn("_n", number).groupBy("uri", "_n")
                .agg(F.min(position).alias("position"), F.sort_array(F.collect_list(F.struct("block", "seq", "raw"))).alias("l"), F.max("piece").alias("_last")))
    crossing = (crossing.select("uri", "position", F.col("l.raw").alias("raws"), (F.col("_last") == 3).alias("closed"))
                .mapInArrow(_glued, "uri string, position long, raw binary, closed boolean"))
    utf8 = F.col("encoding").startswith("utf-8")

    def texts(some: str) -> DataFrame:
        raws = pieces.where(some).select("uri", position.alias("position"), "raw", F.lit(True).alias("closed")).unionByName(crossing)
        named = raws.join(files.where("encoding <> 'utf-16'"), "uri")
        text = named.where(utf8).select("uri", "position", F.col("raw").cast("string").alias("text"), "closed")
        return text.unionByName(named.where(~utf8).select("uri", "position", "raw", "closed", "encoding").mapInArrow(
            _decoded, "uri string, position long, text string, closed boolean"))
    # a file's first record is the first of its split or crosses splits, so no other has to be sorted to find it
    records, firsts = texts("piece = 0"), texts("piece = 0 AND seq = 0")
    # only these files are read whole: the name of every other one would bring its content along
    wide = [r["uri"] for r in blocks.where("marked").select("uri").distinct().orderBy("uri").collect()]
    if wide:
        whole = (spark.read.format("binaryFile").load([_path_of(uri) for uri in wide]).where(F.col("length") < CELL_BYTES)
                 .select(F.col("_metadata.file_path").alias("uri"), "content"))
        decoded = whole.mapInPandas(_wide_records, "uri string, position long, text string, closed boolean")
        records, firsts = records.unionByName(decoded), firsts.unionByName(decoded)
    bare = F.when(F.col("position") == 0, F.regexp_replace("text", "^\ufeff", "")).otherwise(F.col("text"))
    records, firsts = records.withColumn("text", bare), firsts.withColumn("text", bare)
    first = firsts.groupBy("uri").agg(F.min_by("text", "position").alias("first"))
    return records, files.join(first, "uri", "left")


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        text = [raw.decode(enc) for raw, enc in zip(b.column("raw").to_pylist(), b.column("encoding").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column("uri"), b.column("position"), pa.array(text, pa.string()), b.column("closed")], ["uri", "position", "text", "closed"])


def _wide_records(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records of whole UTF-16 files."""
    for pdf in frames:
        for uri, content in zip(pdf["uri"], pdf["content"]):
            try:
                text = bytes(content).decode("utf-16")
            except UnicodeDecodeError:
                continue
            rows, held, at, state = [], [], 0, False
            for n, line in enumerate([*text.split("\n"), None]):
                if line is not None:
                    state = ends_inside(line.removesuffix("\r").encode("utf-8", "surrogatepass"), state)
                    held.append(line)
                if held and (line is None or not state):
                    record = _ended("\n".join(held).encode("utf-8", "surrogatepass")).decode("utf-8", "surrogatepass")
                    if record:
                        rows.append((uri, at, record, not state))
                    held, at = [], n + 1
            yield pd.DataFrame(rows, columns=["uri", "position", "text", "closed"])


def _header(line: str) -> list[str]:
    names = next(csv.reader(io.StringIO(line.lstrip("\ufeff"), newline="")), [])
    return [n if n and n not in names[:i] else f"{n}_{i}" for i, n in enumerate(names)]


#: Holds what stands in a record beyond its header's columns.
_MORE = "_more_"


def csv_frames(spark: SparkSession, root: str, encodings: list[str] = POST_ENCODINGS, accept=_is_export) -> tuple[list[tuple[str, DataFrame]], DataFrame]:
    """(header line, records as columns with source_file and position) per header layout, and the quarantine.

    Only the distinct header lines reach the driver.  Quarantined are files that no encoding decodes, records whose
    last quoted field has no end, and records with more cells than their header; missing cells are null.
    """
    records, files = csv_records(spark, root, encodings, accept)
    files = stored(files)
    bad = [files.where("encoding IS NULL").select(F.col("uri").alias("source_file"), F.lit(0).cast("long").alias("position"),
                                                  F.lit("no encoding decodes the file").alias("reason"), F.lit(None).cast("string").alias("record")),
           files.where("encoding = 'utf-16' AND first IS NULL").select(F.col("uri").alias("source_file"), F.lit(0).cast("long").alias("position"),
                                                                       F.lit("UTF-16 file too large or broken").alias("reason"), F.lit(None).cast("string").alias("record")),
           records.where("NOT closed").select(F.col("uri").alias("source_file"), "position", F.lit("a quoted field has no end").alias("reason"), F.col("text").alias("record"))]
    out = []
    for (line,) in files.where("first IS NOT NULL").select("first").distinct().orderBy("first").collect():
        names = _header(line)
        ddl = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in [*names, _MORE])
        cells = F.from_csv("text", ddl, {"escape": '"'})
        mine = records.join(files.where(F.col("first") == line).select("uri"), "uri", "left_semi").where("closed AND position > 0")
        parsed = mine.select(F.col("uri").alias("source_file"), "position", "text", cells.alias("c"))
        out.append((line, parsed.where(F.col("c")[_MORE].isNull()).select(*[F.col("c")[n].alias(n) for n in names], "source_file", "position")))
        bad.append(parsed.where(F.col("c")[_MORE].isNotNull()).select("source_file", "position", F.lit("more cells than the header").alias("reason"), F.col("text").alias("record")))
    return out, reduce(lambda a, b: a.unionByName(b), bad)


def read_csv_exports(spark: SparkSession, path: str, encodings: list[str] = POST_ENCODINGS) -> DataFrame | None:
    """The CSV files under ``path``, all columns as strings and unioned by name, with source_file and position; None without any."""
    frames, _ = csv_frames(spark, path, encodings, accept=lambda name: ~name.startswith("."))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f for _, f in frames]) if frames else None


def scan_platform(spark: SparkSession, root: str, platform: str) -> tuple[DataFrame | None, DataFrame]:
    """S3 + N3: every post export of a platform folder, normalised and unioned by name, and the quarantine (QUARANTINE).

    Quarantined JSON files are those that do not parse; the others as in ``csv_frames``.
    """
    layouts, bad = csv_frames(spark, root, TIKTOK_ENCODINGS if platform == "tiktok" else POST_ENCODINGS)
    frames = []
    for line, raw in layouts:
        spec_name = platform
        if platform == "tiktok" and any(k in line.lower() for k in ("video title", "video link", "total views")):
            spec_name = "tiktok_content"
        frames.append(normalize_export(raw.drop("position"), spec_name, source_col="source_file"))
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", JSON_GLOB).load(root)
    if not listed.select("path").isEmpty():
        raw = (spark.read.option("multiLine", True).option("recursiveFileLookup", "true").option("pathGlobFilter", JSON_GLOB).json(root))
        raw = raw.withColumn("source_file", F.col("_metadata.file_path")).where(_is_export(F.col("_metadata.file_name")))
        if "_corrupt_record" in raw.columns:
            # Spark reads no column of corrupt records alone: their whole rows are kept aside
            raw = cut_lineage(raw)
            bad = bad.unionByName(raw.where(F.col("_corrupt_record").isNotNull()).select(
                "source_file", F.lit(0).cast("long").alias("position"), F.lit("JSON does not parse").alias("reason"), F.col("_corrupt_record").alias("record")))
            raw = raw.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
        if len(raw.columns) > 1:
            frames.append(normalize_export(flatten(raw), platform, source_col="source_file"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None, bad


def ingest_platform(spark: SparkSession, root: str, platform: str, quarantine: str | None = None) -> DataFrame | None:
    """The posts of ``scan_platform``; what could not be read is appended to the table at ``quarantine``, where one is named."""
    posts, bad = scan_platform(spark, root, platform)
    if quarantine:
        bad.withColumn("platform", F.lit(platform)).write.mode("append").parquet(quarantine)
    return posts


def parse_preamble_series(texts: DataFrame, metric: str) -> DataFrame:
    """Files like ``sep=,`` / title / ``Date,"Primary"`` / rows.  The
    header is the first line starting with ``date,``; col0 = date, col1 =
    value; unparseable dates dropped, bad values -> 0."""
    ln = lines(texts).withColumn("line", F.trim("line"))
    is_hdr = F.lower(F.col("line")).rlike(r'^"?date"?,')
    hdr = ln.where(is_hdr).groupBy("path").agg(F.min("line_no").alias("_h"))
    body = ln.join(hdr, "path").where((F.col("line_no") > F.col("_h")) & (F.col("line") != ""))
    cells = F.from_csv(F.col("line"), "c0 STRING, c1 STRING")
    b = body.select("path", "line_no", cells.alias("c"))
    ts = F.coalesce(F.to_timestamp_ntz(F.try_to_timestamp(F.col("c.c0")).cast("string")),
                    F.to_timestamp_ntz(F.try_to_date(F.col("c.c0")).cast("string")))
    return (b.select("path", F.to_date(ts).alias("date"), F.lit(metric).alias("metric"),
                     F.coalesce(F.col("c.c1").try_cast("double").cast("long"), F.lit(0)).alias("value"))
            .where(F.col("date").isNotNull()))


def parse_audience(texts: DataFrame) -> DataFrame:
    """Audience sections -> long rows (path, section, name, value,
    men, women).  'Top countries' / 'Top cities' = a names row and a
    percents row zipped (blank names dropped); 'Age & gender' = header then
    rows until the first cell has no digit; total = round(men + women, 1)."""
    ln = lines(texts).withColumn("line", F.trim("line"))
    low = F.lower(F.col("line"))
    tag = (F.when(low.startswith("top countries"), "countries").when(low.startswith("top cities"), "cities")
           .when(low.startswith("age & gender") | low.startswith("age and gender"), "age_gender"))
    w = Window.partitionBy("path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    t = (ln.withColumn("_tag", tag)
         .withColumn("section", F.last("_tag", ignorenulls=True).over(w))
         .withColumn("_start", F.last(F.when(F.col("_tag").isNotNull(), F.col("line_no")), ignorenulls=True).over(w))
         .withColumn("k", F.col("line_no") - F.col("_start")))
    cells = F.split(F.col("line"), ",")
    cells = F.transform(cells, lambda c: F.trim(F.regexp_replace(c, '"', "")))

    def num(c):
        return F.coalesce(c.try_cast("double"), F.lit(0.0))
    lists = t.where(F.col("section").isin("countries", "cities") & F.col("k").isin(1, 2))
    names = lists.where(F.col("k") == 1).select("path", "section", cells.alias("names"))
    pcts = lists.where(F.col("k") == 2).select("path", "section", cells.alias("pcts"))
    zipped = (names.join(pcts, ["path", "section"])
              .select("path", "section", F.explode(F.arrays_zip("names", "pcts")).alias("z"))
              .where(F.col("z.names").isNotNull() & (F.col("z.names") != "") & F.col("z.pcts").isNotNull())
              .select("path", "section", F.col("z.names").alias("name"), num(F.col("z.pcts")).alias("value"),
                      F.lit(None).cast("double").alias("men"), F.lit(None).cast("double").alias("women")))
    ag = t.where((F.col("section") == "age_gender") & (F.col("k") >= 2)).select("path", "line_no", cells.alias("c"))
    first_bad = (ag.where(~F.element_at("c", 1).rlike(r"\d")).groupBy("path").agg(F.min("line_no").alias("_stop")))
    ag = (ag.join(first_bad, "path", "left").where(F.col("_stop").isNull() | (F.col("line_no") < F.col("_stop")))
          .select("path", F.lit("age_gender").alias("section"), F.element_at("c", 1).alias("name"),
                  F.round(num(F.element_at("c", 2)) + num(F.element_at("c", 3)), 1).alias("value"),
                  num(F.element_at("c", 3)).alias("men"), num(F.element_at("c", 2)).alias("women")))
    return zipped.unionByName(ag)


def tiktok_series(spark: SparkSession, path: str, as_of, columns: dict[str, list[str]]) -> DataFrame:
    """S7 + N6: a TikTok daily export (Greek ``D Month`` dates), in any of its encodings, as
    (date, metric, value).  ``columns`` maps metric -> header candidates."""
    raw = read_csv_exports(spark, path, TIKTOK_ENCODINGS)
    empty = spark.createDataFrame([], "date date, metric string, value long")
    if raw is None:
        return empty
    from pulsekit.sources.normalize import build_column_map
    date_col = build_column_map(raw.columns, {"date": ["date"]}).get("date")
    if date_col is None:
        return empty
    cm = build_column_map(raw.columns, columns)
    idx = raw.withColumnsRenamed({"position": "row_no", "source_file": "file"})
    parsed = greek.parse_greek_dates(idx.withColumnRenamed(date_col, "value_raw"), as_of, value_col="value_raw")
    parsed = parsed.where(F.col("date").isNotNull())
    out = None
    for metric, col in cm.items():
        part = parsed.select("date", F.lit(metric).alias("metric"),
                             F.coalesce(F.col(f"`{col}`").try_cast("double").cast("long"), F.lit(0)).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out if out is not None else empty
