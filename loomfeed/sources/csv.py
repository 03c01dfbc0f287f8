"""CSV reading: columns bound by name, every value text, missing words to null."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomfeed.functions.text import as_column, quoted
from loomfeed.operators.checks import REQUIRED, missing_columns
from loomfeed.session import fresh_path
from loomfeed.sources.headers import FileHeader, file_headers, pinned_session
from loomfeed.sources.records import SplitStarts, cut_records, split_starts

logger = logging.getLogger(__name__)

# The words that stand for a missing cell.
NA_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

CORRUPT = "_corrupt_record"
NUMBER = "_number"


def normalize_missing(col: Column | str, na_words: Sequence[str] = NA_WORDS) -> Column:
    """Null where the text is one of ``na_words``, else the text."""
    text = as_column(col)
    return F.when(~text.isin(*na_words), text)


@dataclass(frozen=True)
class CsvLayout:
    """What the header tells: column names in file order, and how to read on."""

    names: tuple[str, ...]
    multi_line: bool = True
    line_sep: str | None = None
    regular: bool = True

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, T.StringType()) for n in (*self.names, CORRUPT)])

    @property
    def options(self) -> dict[str, object]:
        """Reader options; a file whose header differs fails where the header is regular."""
        options = {
            **_dialect(self.multi_line),
            "header": True,
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": CORRUPT,
            "enforceSchema": not self.regular,
            # pruned columns would hide rows of the wrong length
            "columnPruning": False,
        }
        return {**options, "lineSep": self.line_sep} if self.line_sep else options

    def require(self, required: Sequence[str]) -> CsvLayout:
        missing = missing_columns(self.names, required)
        if missing:
            raise ValueError(f"missing required columns {missing}; needed are {list(required)}")
        return self


def _dialect(multi_line: bool) -> dict[str, object]:
    return {"multiLine": multi_line, "quote": '"', "escape": '"'}


def unique_names(raw: Sequence[str | None]) -> tuple[str, ...]:
    """Header names made distinct: blanks numbered by place, repeats by suffix.

    Spark compares names without case; a name that is required as written keeps
    its form and the other one gets the suffix.
    """
    names: list[str | None] = [None] * len(raw)
    taken: set[str] = set()
    for i, name in enumerate(raw):
        if name in REQUIRED and name not in taken:
            names[i] = name
            taken.add(name)
    for i, name in enumerate(raw):
        if names[i] is None:
            base = name or f"Unnamed: {i}"
            unique, repeats = base, 0
            while unique.lower() in taken:
                repeats += 1
                unique = f"{base}.{repeats}"
            names[i] = unique
            taken.add(unique.lower())
    return tuple(names)


def _layout(header: FileHeader | None, line_sep: str | None = None, multi_line: bool = True) -> CsvLayout:
    raw = header.fields if header else ()
    names = unique_names(raw)
    return CsvLayout(names, multi_line, line_sep, regular=names == raw)


def csv_layout(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True) -> CsvLayout:
    """Read the header at ``path``. Files there must agree in how their lines end,
    which :func:`read_examples` sees to and a stream needs."""
    headers = file_headers(spark, path)
    line_sep = None
    if multi_line:
        # Spark would turn CRLF inside quotes to LF unless told the separator
        ends = {h.line_sep for h in headers}
        if len(ends) > 1:
            raise ValueError(f"files with different line ends at {path}: give a stream files of one kind")
        line_sep = ends.pop() if ends else None
    return _layout(headers[0] if headers else None, line_sep, multi_line)


def _field_count(line: Column) -> Column:
    """Number of fields in a raw line; quoted fields are taken out before counting."""
    bare = F.regexp_replace(line, r'(^|,)"[^"]*+(?:""[^"]*+)*+"', "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def clean_rows(df: DataFrame, na_words: Sequence[str] = NA_WORDS, keep: Sequence[str] = ()) -> DataFrame:
    """Fail on a row with too many fields, keep short ones, null the missing words.

    Columns ``keep`` are no cells and go through as they are.
    """
    names = [n for n in df.columns if n != CORRUPT and n not in keep]
    line = F.col(CORRUPT)
    too_long = F.coalesce(_field_count(line) > len(names), F.lit(False))
    message = F.concat(
        F.lit(f"CSV row has more than {len(names)} fields, the first is "),
        F.coalesce(as_column(names[0]), F.lit("empty")),
        F.lit(": "),
        line,
    )
    kept = F.when(too_long, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return df.filter(kept).select(*keep, *[normalize_missing(n, na_words).alias(n) for n in names])


def _whole_files(spark: SparkSession, files: Sequence[str], layout: CsvLayout) -> DataFrame:
    return spark.read.options(**layout.options).schema(layout.schema).csv(list(files))


def _cut_files(spark: SparkSession, files: Sequence[FileHeader], layout: CsvLayout, starts: SplitStarts) -> DataFrame:
    """The same cells, read by many tasks per file, and the ``number`` of each row."""
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in _dialect(True).items()}
    options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    cells = F.from_csv("text", ", ".join(f"{quoted(n)} string" for n in layout.schema.names), options)
    records = cut_records(spark, files, starts)
    return records.select(F.col("number").alias(NUMBER), cells.alias("_cells")).select(NUMBER, "_cells.*")


def _kinds(headers: Sequence[FileHeader], required: Sequence[str]) -> dict[tuple[CsvLayout, bool], list[FileHeader]]:
    """The files by their layout, and whether they can be cut."""
    kinds: dict[tuple[CsvLayout, bool], list[FileHeader]] = {}
    for header in headers:
        layout = _layout(header, header.line_sep).require(required)
        kinds.setdefault((layout, header.can_cut), []).append(header)
    if not kinds:
        CsvLayout(()).require(required)
    return kinds


def _together(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of all layouts, columns bound by name; a column that a file lacks is missing there."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


@contextmanager
def _named_errors(path: str | Sequence[str]) -> Iterator[None]:
    try:
        yield
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            logger.error("no such input: %s", path)
            raise FileNotFoundError(path) from error
        logger.error("cannot read %s: %s", path, error)
        raise


def read_examples(
    spark: SparkSession,
    path: str | Sequence[str],
    required: Sequence[str] = REQUIRED,
    na_words: Sequence[str] = NA_WORDS,
    multi_line: bool = True,
    spread: int | None = None,
) -> DataFrame:
    """Read instruction CSV file(s) with a header.

    Every file has its own header: files may order their columns differently, and
    files with CRLF and with LF line ends are read each in its own way, in any
    mix. Two jobs look at the files, however many there are: one reads the
    beginning of each, one finds how quotes run over the splits.

    ``multi_line`` allows line breaks inside quotes. Files are cut into tasks all
    the same (see ``records``), but for files whose lines end with a carriage
    return alone: those are one task each, so give ``spread`` (a partition count)
    where they are big. Without ``multi_line`` the files must have one header.

    The files are scanned again by each job that uses the result, and must then be
    cut as they are now; :func:`ingest_examples` reads them once for all.
    """
    with _named_errors(path):
        if multi_line:
            kinds = _kinds(file_headers(spark, path), required)
            starts = split_starts(spark, [files for (_, cut), files in kinds.items() if cut])
            parts = [
                clean_rows(
                    _cut_files(spark, files, layout, starts).drop(NUMBER)
                    if cut
                    else _whole_files(spark, [f.path for f in files], layout),
                    na_words,
                )
                for (layout, cut), files in kinds.items()
            ]
        else:
            paths = [path] if isinstance(path, str) else list(path)
            layout = csv_layout(spark, paths, False).require(required)
            parts = [clean_rows(_whole_files(spark, paths, layout), na_words)]
    df = _together(parts)
    return df.repartition(spread) if spread else df


def ingest_examples(
    spark: SparkSession,
    path: str | Sequence[str],
    out: str | None = None,
    index: str = "row_index",
    required: Sequence[str] = REQUIRED,
    na_words: Sequence[str] = NA_WORDS,
) -> DataFrame:
    """Turn instruction CSV file(s) into a stored table whose rows are numbered.

    ``index`` counts rows from 0 without gaps, by file name and then by place in
    the file. The number comes from record counts of the splits, so no text is
    sorted or shuffled for it, and what is built on the table needs no key by
    content: give ``index="ex_id"`` to prepare it. All scans happen here and cut
    the files alike, whatever executors come or go in between. The table is
    written to ``out``, or to a new place in the shared folder.
    """
    session = pinned_session(spark)
    with _named_errors(path):
        kinds = _kinds(file_headers(spark, path), required)
        others, rows = {}, {}
        for (layout, cut), files in kinds.items():
            if not cut:
                rows[layout] = _numbered_in_files(session, files, layout, na_words)
                for r in rows[layout].groupBy("_file").agg(F.count(F.lit(1)).alias("n"), F.min(NUMBER).alias("first")).collect():
                    others[r["_file"]] = (r["n"], r["first"])
        uris = {f.number: f.uri for files in kinds.values() for f in files}
        sizes = {file: (uris[file], n) for file, (n, _) in others.items()}
        cuttable = [files for (_, cut), files in kinds.items() if cut]
        starts = split_starts(session, cuttable, sizes)
        parts = []
        for (layout, cut), files in kinds.items():
            if cut:
                cells = clean_rows(_cut_files(session, files, layout, starts), na_words, [NUMBER])
            else:
                # one row per file that can't be cut
                shifts = [(file, starts.before(uris[file]) - first) for file, (_, first) in others.items()]
                moved = session.createDataFrame(shifts, "_file long, _shift long")
                cells = rows[layout].join(F.broadcast(moved), "_file")
                cells = cells.withColumn(NUMBER, F.col(NUMBER) + F.col("_shift")).drop("_file", "_shift")
            parts.append(cells)
        place = out or fresh_path(spark, "examples")
        _together(parts).withColumnRenamed(NUMBER, index).write.parquet(place)
    return spark.read.parquet(place)


def _numbered_in_files(
    spark: SparkSession, files: Sequence[FileHeader], layout: CsvLayout, na_words: Sequence[str]
) -> DataFrame:
    """Rows of files that are one task each, in a stored table, numbered upwards in each file."""
    cells = _whole_files(spark, [f.path for f in files], layout).select(
        "*",
        F.xxhash64(F.col("_metadata.file_path")).alias("_file"),
        F.monotonically_increasing_id().alias(NUMBER),
    )
    place = fresh_path(spark, "numbered")
    clean_rows(cells, na_words, ["_file", NUMBER]).write.parquet(place)
    return spark.read.parquet(place)
