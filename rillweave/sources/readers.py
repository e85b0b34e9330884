"""File readers. Each returns text columns plus ``_ord``, the position of a row in its source.

Readers of text formats lose nothing: what cannot be parsed is a row of its own, with its text in
``_raw`` (null for good rows) and maybe its fault in ``_problem``; an empty file is such a row too,
with its name for text. A reader whose path does not exist gives an empty table (or
raises, ``on_missing="fail"``), so that one missing extract does not stop the others.
"""

from __future__ import annotations

import csv
import re
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillweave.functions.text import quote

_ROW_BITS = (1 << 33) - 1

PAYROLL_COLUMNS = (
    "employee_id", "source", "base_salary", "currency", "pay_frequency",
    "bonus_target_pct", "effective_date",
)
BENEFIT_COLUMNS = (
    "employee_id", "plan_type", "coverage_level", "enrollment_date",
    "premium_employee", "premium_employer",
)

ORD_TYPE = "struct<file:string,start:bigint,row:bigint>"
RAW = "_raw"
PROBLEM = "_problem"

_EMPTY, _CUT, _OPEN_QUOTE, _OPEN_ELEMENT = "file is empty", "file is cut off", "quote is not closed", "element is not closed"
#: Bytes at either end of a file that the driver looks at.
_END_BYTES = 1 << 20
#: Files whose ends the driver holds at a time.
_AT_ONCE = 64


def fence(df: DataFrame) -> DataFrame:
    """The same rows behind a generator.

    A predicate on computed columns would be pushed below their computation and repeat it;
    predicates on generated columns stay where they are.
    """
    return df.select(F.inline(F.array(F.struct("*"))))


def _file_order() -> Column:
    """Rows of one split are read in order and splits know their offset: a total order per file.

    Files follow each other by name, wherever their folder lies.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("row"),
    ).alias("_ord")


def _text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _key(url: str) -> str:
    """The name of a file as ``_metadata.file_path`` gives it."""
    return "file:/" + url.removeprefix("file:///") if url.startswith("file:///") else url


def _ends(spark: SparkSession, urls: Iterable[str], wanted: str) -> dict[str, str | None]:
    """The beginning (``wanted="head"``) or the end ("tail") of each file as text: one small read per file.

    A compressed file has a beginning alone.
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def read(url: str) -> str | None:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(url))
        system, codec = path.getFileSystem(conf), codecs.getCodec(path)
        if wanted == "tail" and codec is not None:
            return None
        stream = system.open(path)
        try:
            if wanted == "tail":
                stream.seek(max(0, system.getFileStatus(path).getLen() - _END_BYTES))
            source = stream if codec is None else codec.createInputStream(stream)
            bounded = jvm.org.apache.commons.io.input.BoundedInputStream(source, _END_BYTES)
            return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(bounded)).decode("utf-8", "replace").removeprefix("\ufeff")
        finally:
            stream.close()

    urls = sorted(urls)
    with ThreadPoolExecutor(16) as pool:
        return dict(zip(map(_key, urls), pool.map(read, urls), strict=True))


def _empty_files(spark: SparkSession, urls: Iterable[str]) -> list[str]:
    """The files without a byte, from one listing per folder."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    wanted = {_key(u) for u in urls}
    folders = {u.rsplit("/", 1)[0]: u for u in wanted}
    found = []
    for url in folders.values():
        folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(url)).getParent()
        for status in folder.getFileSystem(conf).listStatus(folder):
            name = status.getPath().toUri().toString()
            if status.getLen() == 0 and _key(name) in wanted:
                found.append(_key(name))
    return found


def _faulty_files(spark: SparkSession, files: dict[str, str], schema: T.StructType) -> DataFrame:
    """One row per file with a fault: its name, and what is wrong with it."""
    rows = spark.createDataFrame(sorted(files.items()), f"file string, {PROBLEM} string")
    place = F.expr(f"cast(struct(file, 0L, -1L) AS {ORD_TYPE})").alias("_ord")
    known = {RAW: F.col("file").alias(RAW), PROBLEM: F.col(PROBLEM), "_ord": place}
    return rows.select(*(known.get(f.name, F.lit(None).cast(f.dataType).alias(f.name)) for f in schema))


def _or_empty(
    spark: SparkSession, read: Callable[[], DataFrame], columns: Sequence[str], on_missing: str
) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if on_missing == "fail" or e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], _text_schema([*columns, RAW])).withColumn(
            "_ord", F.lit(None).cast(ORD_TYPE)
        )


def read_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    multi_line: bool = False,
    on_missing: str = "empty",
) -> DataFrame:
    """CSV with a header, every column as text; ``columns`` is the schema of a missing file.

    Each file has a header of its own, so columns may stand in another order or be absent in some. A line
    that equals it is a header, wherever it stands. A row with more or fewer fields than its header, or
    with a quote that is not closed, keeps its text in ``_raw``: without ``multi_line`` a row is a line,
    and the lines of a broken field are rows that do not fit. ``multi_line`` allows line breaks inside
    quoted fields; such files cannot be split between tasks, and share one header.
    """

    def read() -> DataFrame:
        if multi_line:
            return _whole_csv(spark, path)
        lines = spark.read.text(path)
        heads = _ends(spark, lines.inputFiles(), "head")
        headers = {f: next((x for x in t.splitlines() if x.strip()), None) for f, t in heads.items()}
        names = {h: _header_names(h) for h in headers.values() if h is not None}
        found = list(dict.fromkeys(n for h in names.values() for n in h)) or list(columns)
        of_file = spark.createDataFrame([(f, h) for f, h in headers.items() if h is not None], "file string, header string")
        placed = lines.where("trim(value) <> ''").select("value", _file_order())
        # A row per file; Spark's own size check decides how they are joined.
        rows = placed.join(of_file, F.col("_ord.file") == F.col("file")).where("value <> header")
        parsed = fence(rows.select(F.expr(_parsed(names, found)).alias("r"), "value", "_ord"))
        fields = [F.col(f"r.`{c}`") for c in found]
        open_ = F.when(F.expr(_OPEN), F.lit(_OPEN_QUOTE))
        good = parsed.select(
            *fields, F.coalesce(f"r.{RAW}", F.when(F.expr(_OPEN), F.col("value"))).alias(RAW),
            F.when(F.col(f"r.{RAW}").isNull(), open_).alias(PROBLEM), "_ord",
        )
        empty = {f: _EMPTY for f, h in headers.items() if h is None}
        return good.unionByName(_faulty_files(spark, empty, good.schema)) if empty else good

    return _or_empty(spark, read, columns, on_missing)


#: A field that begins with a quote and, once all closed ones are taken away, is still there.
_OPEN = r"""contains(value, '"') AND regexp_replace(value, '(^|,)"[^"]*+(?:""[^"]*+)*+"', '$1') RLIKE '(^|,)"'"""


def _header_names(header: str) -> list[str]:
    """Names of the fields; blank and repeated ones are told apart by their place."""
    fields = next(csv.reader([header]))
    taken = [f.lower() for f in fields]
    return [f"_c{i}" if not f else f"{f}{i}" if taken.count(f.lower()) > 1 else f for i, f in enumerate(fields)]


def _parsed(names: dict[str, list[str]], found: list[str]) -> str:
    """SQL for the fields of a line under the header of its file, as one struct of all columns."""
    options = f"map('escape', '\"', 'columnNameOfCorruptRecord', '{RAW}')"
    cases = []
    for header, fields in names.items():
        schema = ", ".join(f"`{c}` STRING" for c in (*fields, RAW))
        every = ", ".join(f"{quote(c)}, {f'r.`{c}`' if c in (*fields, RAW) else 'cast(NULL AS STRING)'}" for c in (*found, RAW))
        one = f"get(transform(array(from_csv(value, {quote(schema)}, {options})), r -> named_struct({every})), 0)"
        cases.append(f"WHEN header = {quote(header)} THEN {one}")
    empty = ", ".join(f"{quote(c)}, cast(NULL AS STRING)" for c in (*found, RAW))
    return f"CASE {' '.join(cases)} ELSE named_struct({empty}) END"


def _whole_csv(spark: SparkSession, path: str) -> DataFrame:
    options = {"header": True, "escape": '"', "multiLine": True}
    names = spark.read.options(**options).csv(path).columns
    frame = (
        spark.read.options(**options, enforceSchema=False, columnPruning=False, columnNameOfCorruptRecord=RAW)
        .schema(_text_schema([*names, RAW]))
        .csv(path)
    )
    return frame.select(*(F.col(f"`{c}`") for c in frame.columns), _file_order())


def read_parquet(
    spark: SparkSession, path: str, columns: Sequence[str], on_missing: str = "empty"
) -> DataFrame:
    """Columnar landing of a tabular extract; every column is read as text."""

    def read() -> DataFrame:
        frame = spark.read.parquet(path)
        return frame.select(
            *(F.col(f"`{c}`").cast("string").alias(c) for c in frame.columns), _file_order()
        )

    return _or_empty(spark, read, columns, on_missing)


def read_json_records(
    spark: SparkSession,
    path: str,
    layout: str = "document",
    array_path: str = "$.employees",
    on_missing: str = "empty",
) -> DataFrame:
    """Nested JSON as one variant column ``doc`` per record.

    A line or document that is no JSON, or a document without the array, is one row without
    ``doc``, its text in ``_raw``. So is an empty document.

    ``document``: each file holds one object with an array of records. A file is one row
    until its array is exploded, so it suits page files.

    ``large_document``: the same for files of any size, each read by several tasks and cut between
    its records. A record that is no JSON is one row with its own text, and a document whose frame
    around the records is none, or lacks the array, one row with the name of its file. ``array_path``
    names members only ("$.data.employees").

    ``lines``: one record per line.
    """

    def read() -> DataFrame:
        if layout == "large_document":
            return _split_documents(spark, path, array_path)
        if layout == "lines":
            lines = spark.read.text(path).where(F.trim("value") != "")
            return fence(lines.select(F.expr(_json("value")).alias("doc"), "value", _file_order())).selectExpr(
                "doc", f"CASE WHEN doc IS NULL THEN value END AS {RAW}", "_ord"
            )
        text = spark.read.text(path, wholetext=True)
        # The text goes into the one element of an unreadable document, never along with records.
        records = F.expr(
            f"""coalesce(
                transform(try_variant_get({_json("value")}, {quote(array_path)}, 'array<variant>'),
                    doc -> named_struct('doc', doc, 'raw', cast(NULL AS string))),
                array(named_struct('doc', cast(NULL AS variant), 'raw', value)))"""
        )
        documents = text.select(
            F.col("_metadata.file_path").alias("file"), F.posexplode(records).alias("pos", "record")
        ).select(
            "record.doc",
            F.col("record.raw").alias(RAW),
            F.struct("file", F.lit(0).cast("bigint").alias("start"), F.col("pos").cast("bigint").alias("row")).alias("_ord"),
        )
        # Files without a byte have no row in a text table.
        empty = _empty_files(spark, text.inputFiles())
        if not empty:
            return documents
        return documents.unionByName(_faulty_files(spark, dict.fromkeys(empty, _EMPTY), documents.schema))

    try:
        return read()
    except AnalysisException as e:
        if on_missing == "fail" or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"doc variant, {RAW} string, _ord {ORD_TYPE}")


def _json(text: str) -> str:
    """SQL for the variant of a text that is one JSON value, null for any other.

    The parser takes no notice of what follows a value, so the text stands inside an object and what
    follows it there has to be found.
    """
    whole = f"try_parse_json(concat('{{\"value\":', {text}, ',\"{_AFTER}\":1}}'))"
    return f"get(transform(array({whole}), v -> CASE WHEN try_variant_get(v, '$.{_AFTER}', 'int') = 1 THEN try_variant_get(v, '$.value', 'variant') END), 0)"


_AFTER = "after_" + uuid.uuid5(uuid.NAMESPACE_OID, __name__).hex

#: Salts of the join that gives pieces their place: one file may hold all records.
_SALTS = 64
#: Runs of records between two other pieces of a document go into its frame as one element with this key.
_RUN = "run_" + uuid.uuid5(uuid.NAMESPACE_OID, __name__).hex


def _split_documents(spark: SparkSession, path: str, array_path: str) -> DataFrame:
    """doc, _raw, _ord of the records of JSON documents.

    Files are read in chunks that end at a closing brace. Running sums of quotes tell which chunks begin
    inside a string, running sums of brackets how deep each ends; sums over a block of a file are taken
    in one task, and only a row per block is ordered along the file. Chunks up to one that ends at the
    depth of the records are a piece. A piece that is a comma and an object is a record. All others (with
    the first record of each array, since that comes with what precedes it) make up the frame.
    """
    inner = array_path.count(".") + 1
    lines = spark.read.option("lineSep", "}").text(path)
    urls = lines.inputFiles()
    tails = _ends(spark, urls, "tail")
    rows = lines.select("value", _file_order()).select("value", "_ord.*")

    within = ["file", "start"]
    block = Window.partitionBy(*within).orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    along = Window.partitionBy("file").orderBy("start")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)

    def number(text: Column, letters: str) -> Column:
        return (F.length(text) - F.length(F.translate(text, letters, ""))).cast("bigint")

    def rise(flip: int) -> Column:
        """How much deeper a chunk ends than it begins; ``flip``: its block begins inside a string."""
        begins = (F.col("quoted") + F.col("quotes") + flip) % 2 == 1
        text = F.concat(F.when(begins, F.lit('"')).otherwise(F.lit("")), F.col("plain"))
        bare = F.regexp_replace(text, r'"[^"]*("|\z)', "")
        closes = F.when((F.col("quoted") + flip) % 2 == 0, F.lit(1)).otherwise(F.lit(0))
        return number(bare, "{[") - number(bare, "}]") - closes

    chunks = (
        rows.withColumn("plain", F.regexp_replace("value", r"(?s)\\.", ""))
        .withColumn("quotes", number(F.col("plain"), '"') % 2)
        .withColumn("quoted", F.sum("quotes").over(block) % 2)
        .withColumns({"rise0": rise(0), "rise1": rise(1)})
        .drop("plain")
    )
    blocks = chunks.groupBy(*within).agg(
        F.sum("quotes").alias("quotes"), F.sum("rise0").alias("rise0"), F.sum("rise1").alias("rise1"), F.max("row").alias("end")
    )
    rises = F.when(F.col("flip") == 1, F.col("rise1")).otherwise(F.col("rise0"))
    blocks = (
        blocks.withColumn("flip", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
        .withColumn("above", F.coalesce(F.sum(rises).over(earlier), F.lit(0)))
        .withColumn("end", F.when(F.lead("start").over(along).isNull(), F.col("end")))
        .select(*within, "flip", "above", "end")
    )
    # The last chunk of a file has no brace.
    last = F.coalesce(F.col("row") == F.col("end"), F.lit(False))
    cut = ~last & (F.col("above") + F.sum(rises).over(block) == inner) & ((F.col("quoted") + F.col("flip")) % 2 == 0)
    deep = chunks.join(blocks, within).select(
        *within, "row", F.when(last, F.col("value")).otherwise(F.concat("value", F.lit("}"))).alias("text"), cut.cast("bigint").alias("cut")
    )
    cuts = deep.groupBy(*within).agg(F.sum("cut").alias("before")).select(
        *within, F.coalesce(F.sum("before").over(earlier), F.lit(0)).alias("before")
    )
    numbered = deep.join(cuts, within).withColumn("piece", F.col("before") + F.sum("cut").over(block) - F.col("cut"))
    # As many chunks as a record has closing braces.
    pieces = numbered.groupBy("file", "piece").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "row", "text"))), lambda c: c.text), "").alias("text"),
        (F.max("cut") == 1).alias("whole"),
    )
    is_record = (F.col("piece") > 0) & F.col("whole") & F.col("text").rlike(r"^\s*,\s*\{")

    closed = [(f, None if t is None else t.endswith("}")) for f, t in tails.items()]
    frame = pieces.where(~is_record).groupBy("file").agg(F.array_sort(F.collect_list(F.struct("piece", "text"))).alias("parts"))
    run = f"concat(',{{{chr(34)}{_RUN}{chr(34)}:[', p.piece, ',', parts[i + 1].piece, ']}}')"
    follows = "i + 1 < size(parts) AND parts[least(i + 1, size(parts) - 1)].piece > p.piece + 1"
    text = f"array_join(transform(parts, (p, i) -> concat(p.text, CASE WHEN {follows} THEN {run} ELSE '' END)), '')"
    # The end of a compressed file is not known beforehand: only one of the two can be JSON.
    whole, short = _json("concat(text, '}')"), _json("text")
    document = f"coalesce(CASE WHEN coalesce(closed, true) THEN {whole} END, CASE WHEN NOT coalesce(closed, false) THEN {short} END)"
    records = f"""coalesce(
        transform(try_variant_get({document}, {quote(array_path)}, 'array<variant>'),
            doc -> named_struct('doc', doc, 'raw', cast(NULL AS string))),
        array(named_struct('doc', cast(NULL AS variant), 'raw', file)))"""
    elements = (
        frame.select("file", F.expr(text).alias("text"))
        .join(spark.createDataFrame(closed, "file string, closed boolean"), "file")
        .select("file", F.posexplode(F.expr(records)).alias("pos", "record"))
        .select("file", "pos", "record.*", F.expr(f"try_variant_get(record.doc, '$.{_RUN}', 'array<bigint>')").alias("run"))
    )
    place = "cast(struct(file, {}, {}) AS " + ORD_TYPE + ") AS _ord"
    framed = elements.where("run IS NULL").selectExpr("doc", f"raw AS {RAW}", place.format("pos", "0L"))
    runs = (
        elements.where("run IS NOT NULL").groupBy("file")
        .agg(F.collect_list(F.expr("struct(run[0] AS head, run[1] AS next, pos)")).alias("runs"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    )
    found = pieces.where(is_record).withColumn("salt", (F.col("piece") % _SALTS).cast("int")).join(runs, ["file", "salt"])
    parsed = fence(
        found.selectExpr("file", "piece", r"regexp_replace(text, '^\\s*,\\s*', '') AS text", "filter(runs, r -> r.head < piece AND piece < r.next) AS own")
        .where("size(own) > 0")
        .selectExpr(f"{_json('text')} AS doc", "text", place.format("own[0].pos", "piece"))
    ).selectExpr("doc", f"CASE WHEN doc IS NULL THEN text END AS {RAW}", "_ord")
    documents = framed.unionByName(parsed)
    empty = _empty_files(spark, urls)
    return documents.unionByName(_faulty_files(spark, dict.fromkeys(empty, _EMPTY), documents.schema)) if empty else documents


def read_xml(
    spark: SparkSession,
    path: str,
    row_tag: str = "enrollment",
    columns: Sequence[str] = BENEFIT_COLUMNS,
    on_missing: str = "empty",
) -> DataFrame:
    """One row per ``row_tag`` element, at any depth.

    Files are cut at the end tags, so a large one is read by several tasks, and each element is parsed
    alone. One that is malformed or not closed is one row with its text in ``_raw``, and what follows it is
    read. A file that ends before its root element does is a row with its name. An end tag inside a comment
    or a CDATA section is taken for one. The end of a compressed file is not looked at.
    """

    def read() -> DataFrame:
        faults, open_ended = _xml_faults(spark, path, row_tag)
        elements = _elements(spark, path, row_tag, open_ended)
        schema = ", ".join(f"`{c}` STRING" for c in (*columns, RAW))
        options = f"map('rowTag', {quote(row_tag)}, 'columnNameOfCorruptRecord', '{RAW}')"
        parsed = fence(
            elements.select(F.expr(f"CASE WHEN closed THEN from_xml(element, {quote(schema)}, {options}) END").alias("r"), "element", "closed", "_ord")
        )
        rows = parsed.select(
            *(F.col(f"r.`{c}`") for c in columns), F.expr(f"if(closed, r.{RAW}, element)").alias(RAW),
            F.when(~F.col("closed"), F.lit(_OPEN_ELEMENT)).alias(PROBLEM), "_ord",
        )
        return rows.unionByName(_faulty_files(spark, faults, rows.schema)) if faults else rows

    return _or_empty(spark, read, columns, on_missing)


def _xml_faults(spark: SparkSession, path: str, row_tag: str) -> tuple[dict[str, str], list[str]]:
    """What is wrong with files as a whole, and which files end within an element of ``row_tag``.

    Tasks look at small files, whose number grows with the input, the driver at the ends of large and of
    compressed ones, some at a time.
    """
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"), "length", "content")
    suffixes = _codec_suffixes(spark)
    packed = reduce(Column.__or__, (F.col("file").endswith(x) for x in suffixes), F.lit(False))
    small = F.col("length") <= _END_BYTES
    fault_of = _xml_fault(row_tag)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (c.as_py().decode("utf-8", "replace").removeprefix("\ufeff") for c in batch.column(1))
            judged = [fault_of(t, t) for t in texts]
            faults, is_open = (pa.array([x[i] for x in judged], kind) for i, kind in enumerate((pa.string(), pa.bool_())))
            yield pa.record_batch([batch.column(0), faults, is_open], names=["file", "fault", "is_open"])

    looked = files.where(small & ~packed).select("file", "content").mapInArrow(run, "file string, fault string, is_open boolean")
    found = [tuple(r.values()) for r in looked.toArrow().to_pylist()]
    others = [r.file for r in files.where(~small | packed).select("file").collect()]
    for i in range(0, len(others), _AT_ONCE):
        some = others[i : i + _AT_ONCE]
        heads, tails = _ends(spark, some, "head"), _ends(spark, some, "tail")
        found += [(_key(f), *fault_of(heads[_key(f)], tails[_key(f)])) for f in some]
    # Files without a byte are listed but have no row.
    empty = set(map(_key, files.inputFiles())).difference(f for f, _, _ in found)
    faults = dict.fromkeys(empty, _EMPTY) | {f: fault for f, fault, _ in found if fault}
    return faults, [f for f, _, is_open in found if is_open]


def _codec_suffixes(spark: SparkSession) -> list[str]:
    """Ends of the names of compressed files."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    reflect = jvm.org.apache.hadoop.util.ReflectionUtils
    classes = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)
    return [reflect.newInstance(c, conf).getDefaultExtension() for c in classes]


def _xml_fault(row_tag: str) -> Callable[[str, str | None], tuple[str | None, bool]]:
    """Tells from the beginning and the end of a file what is wrong with it as a whole, and whether it ends within an element.

    A closure, so that tasks need not import this package.
    """

    def fault(head: str, tail: str | None) -> tuple[str | None, bool]:
        if not head.strip():
            return _EMPTY, False
        if tail is None:
            return None, False
        rest = tail.rpartition(f"</{row_tag}>")[2]
        if re.search(rf"<{re.escape(row_tag)}(?:\s[^>]*[^/>])?>", rest):
            return None, True
        root = re.search(r"<([A-Za-z_][\w:.-]*)", re.sub(r"<\?.*?\?>|<!--.*?-->|<!.*?>", "", head, flags=re.S))
        if root is None or root[1] == row_tag:
            return (_CUT if root is None else None), False
        end = rf"(?:</{re.escape(root[1])}\s*>|<{re.escape(root[1])}[^>]*/>)\s*(?:<!--.*?-->\s*|<\?.*?\?>\s*)*$"
        return (None if re.search(end, tail, flags=re.S) else _CUT), False

    return fault


def _elements(spark: SparkSession, path: str, row_tag: str, open_ended: list[str]) -> DataFrame:
    """element, closed, _ord of each element. The last part of each file of ``open_ended`` has no end tag.

    Those few files are sorted to find that part; the others are not.
    """
    end = f"</{row_tag}>"
    parts = spark.read.option("lineSep", end).text(path).select("value", _file_order())
    if open_ended:
        # Names alone, of files that the driver has to list anyway.
        names = F.broadcast(spark.createDataFrame([(f,) for f in open_ended], "file string"))
        along = Window.partitionBy("_ord.file").orderBy("_ord")
        is_open = F.col("_ord.file") == F.col("file")
        opened = parts.join(names, is_open, "left_semi").withColumn("last", F.lead("value").over(along).isNull())
        parts = parts.join(names, is_open, "left_anti").withColumn("last", F.lit(False)).unionByName(opened)
    else:
        parts = parts.withColumn("last", F.lit(False))
    tag = re.escape(row_tag)
    # From one start tag to the next. Only the last of them can have the end tag at which the file was cut.
    begun = f"filter(split(value, {quote(f'(?=<{tag}[{chr(92)}s/>])')}), x -> x RLIKE {quote(f'^<{tag}[{chr(92)}s/>]')})"
    alone, spaced = quote(rf"^<{tag}(?:\s[^>]*)?/>"), quote(rf"</{tag}\s+>")
    closed = (
        f"CASE WHEN x RLIKE {alone} THEN struct(regexp_extract(x, {alone}, 0) AS element, true AS closed)"
        f" WHEN i + 1 = size(begun) AND NOT last THEN struct(x || {quote(end)} AS element, true AS closed)"
        f" WHEN x RLIKE {spaced} THEN struct(regexp_replace(x, {quote(rf'(?s)</{tag}{chr(92)}s+>.*')}, {quote(end)}) AS element, true AS closed)"
        f" ELSE struct(x AS element, false AS closed) END"
    )
    return parts.withColumn("begun", F.expr(begun)).select(F.expr(f"inline(transform(begun, (x, i) -> {closed}))"), "_ord")
