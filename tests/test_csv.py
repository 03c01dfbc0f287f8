import random

import pytest
from pyspark.sql import functions as F

from loomfeed.functions.text import content_key
from loomfeed.operators.augment import replicate
from loomfeed.operators.feed import split_by_hash
from loomfeed.operators.keys import content_keys
from loomfeed.operators.vocab import build_vocab, word_level_json
from loomfeed.operators.checks import REQUIRED
from loomfeed.plans.prepare import prepare_v1, prepare_v2, render_v2
from loomfeed.session import checkpoint
from loomfeed.sources import NA_WORDS, ingest_examples, read_examples, write_examples
from loomfeed.sources import csv
from loomfeed.sources.csv import CsvLayout, unique_names
from loomfeed.sources.headers import file_headers
from loomfeed.streaming import BatchReports, stream_examples, write_available, write_files_available
from tests.conftest import node_names

HEADER = "instruction,input,output\n"


@pytest.fixture
def read(spark, tmp_path):
    def run(text, multi_line=True, **options):
        path = tmp_path / "in.csv"
        path.write_bytes(text if isinstance(text, bytes) else text.encode())
        return read_examples(spark, str(path), multi_line=multi_line, **options)

    return run


def values(df):
    return [tuple(row) for row in df.collect()]


@pytest.mark.parametrize(
    "text, rows",
    [
        (HEADER + 'i,NA,"say ""hi""\nline2"\n', [("i", None, 'say "hi"\nline2')]),
        (HEADER + 'i,,o\ni,"",o\n', [("i", None, "o")] * 2),
        (HEADER + "None,nan,null\n", [(None, None, None)]),
        (HEADER + 'i,"  ",o\n', [("i", "  ", "o")]),
        (HEADER + "short,only\na,b,c\n", [("short", "only", None), ("a", "b", "c")]),
        (HEADER + '"a, ""q"" b",b,"c,d,e,f"\n"only, one"\n', [('a, "q" b', "b", "c,d,e,f"), ("only, one", None, None)]),
        (HEADER + "\nx,y,z\n\n\na,b,c\n", [("x", "y", "z"), ("a", "b", "c")]),
        (HEADER + 'a "b" c,d"e,f\n', [('a "b" c', 'd"e', "f")]),
        (HEADER + 'a\\,b,"c\\"\n', [("a\\", "b", "c\\")]),
        (HEADER + "Instruction: 요약 é,b,c\n", [("Instruction: 요약 é", "b", "c")]),
        (b"\xef\xbb\xbf" + HEADER.encode() + b"x,y,z\n", [("x", "y", "z")]),
        (HEADER.replace("\n", "\r\n") + 'x,y,"z\r\nw"\r\n', [("x", "y", "z\r\nw")]),
        (HEADER + 'x,y,"z\r\nw"\n', [("x", "y", "z\r\nw")]),
        (HEADER.replace("\n", "\r") + "x,y,z\r", [("x", "y", "z")]),
        (HEADER, []),
    ],
)
def test_cells(read, text, rows):
    assert values(read(text)) == rows


@pytest.mark.parametrize("multi_line", [True, False])
@pytest.mark.parametrize("row", ["a,b,c,d", "a,b,c,", '"a,a",b,c,"d"'])
def test_long_row_is_an_error_even_when_columns_are_pruned(read, row, multi_line):
    df = read(HEADER + "x,y,z\n" + row + "\n", multi_line)
    for use in (df.collect, df.count, df.select("output").collect):
        with pytest.raises(Exception, match="more than 3 fields"):
            use()


def test_all_missing_words_become_null(read):
    rows = "".join(f'x,"{word}",o\n' for word in NA_WORDS)
    assert values(read(HEADER + rows).select("input").distinct()) == [(None,)]
    assert values(read(HEADER + "x,nAn,o\n").select("input")) == [("nAn",)]


def test_columns_bind_by_name(read):
    df = read("output,extra,input,instruction\no,e,i,n\n")
    assert values(df.select("instruction", "input", "output")) == [("n", "i", "o")]


def test_index_and_repeated_columns(read):
    df = read(",instruction,input,output,output\n0,x,y,z,w\n")
    assert df.columns == ["Unnamed: 0", "instruction", "input", "output", "output.1"]
    assert values(df) == [("0", "x", "y", "z", "w")]


def test_unique_names_keep_required_forms():
    assert unique_names(["Input", "input", None, "a", "A"]) == ("Input.1", "input", "Unnamed: 2", "a", "A.1")


def test_files_order_their_columns_as_they_like(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "x,y,z\n")
    (tmp_path / "b.csv").write_text('more,output,input,"instruction"\nm,z2,y2,x2\n')
    (tmp_path / "c.csv").write_bytes(b"input,instruction,output\r\ny3,x3,z3\r\n")
    df = read_examples(spark, str(tmp_path))
    assert df.columns == ["instruction", "input", "output", "more"]
    assert sorted(values(df)) == [("x", "y", "z", None), ("x2", "y2", "z2", "m"), ("x3", "y3", "z3", None)]
    (tmp_path / "d.csv").write_text("output,input\nz,y\n")
    with pytest.raises(ValueError, match="'instruction'"):
        read_examples(spark, str(tmp_path))


def test_jobs_before_the_first_action_do_not_grow_with_the_files(spark, tmp_path):
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for n in (3, 12):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            end = "\r\n" if i % 2 else "\n"
            (folder / f"{i}.csv").write_bytes(f"input,instruction,output{end}a,b,{i}{end}".encode())
        spark.sparkContext.setJobGroup(f"files-{n}", "")
        df = read_examples(spark, str(folder))
        jobs.append(len(tracker.getJobIdsForGroup(f"files-{n}")))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert df.count() == n
    assert jobs[0] == jobs[1] <= 3


def test_only_the_beginning_of_a_file_is_read_for_its_header(spark, tmp_path):
    (tmp_path / "big.csv").write_text("\n\n" + '"instruction","in\nput",output\n' + "a,b,c\n" * 2_000_000)
    (header,) = file_headers(spark, str(tmp_path))
    assert header.fields == ("instruction", "in\nput", "output") and header.can_cut
    assert header.size > 12_000_000


def test_missing_column(read):
    with pytest.raises(ValueError, match="'input'"):
        read("instruction,output\na,b\n")


def test_missing_file(spark):
    with pytest.raises(FileNotFoundError, match="nowhere"):
        read_examples(spark, "/nowhere/in.csv")


def test_spread(read):
    df = read(HEADER + "x,y,z\na,b,c\n", spread=5)
    assert df.rdd.getNumPartitions() == 5 and df.count() == 2


def test_write_examples_by_split(spark, tmp_path):
    df = replicate(spark.range(10).withColumnRenamed("id", "ex_id"), 2).withColumn(
        "split", F.when(F.col("ex_id") < 3, "test").otherwise("train")
    )
    write_examples(df, str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {"split=test", "split=train"}
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(values(back.select(*df.columns))) == sorted(values(df))
    with pytest.raises(Exception, match="(?i)exists"):
        write_examples(df, str(tmp_path / "out"))


def test_files_per_folder(spark, tmp_path):
    df = replicate(spark.range(200).withColumnRenamed("id", "ex_id"), 2).repartition(16)
    df = df.withColumn("rank", (F.col("ex_id") % 3).cast("int"))
    write_examples(df, str(tmp_path / "out"), ("rank",), files_per_folder=2)
    for rank in range(3):
        assert len(list((tmp_path / "out" / f"rank={rank}").glob("*.parquet"))) <= 2
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(values(back.select(*df.columns))) == sorted(values(df))


def test_stream_equals_batch_and_takes_only_new_files(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    (tmp_path / "in").mkdir()
    rows = 'Instruction: a,NA,Output: "b"\nInstruction: a,,c\n"Instruction: x\ny",i,Output: z\n'
    (tmp_path / "in" / "1.csv").write_text(HEADER + rows)
    layout = CsvLayout(("instruction", "input", "output"))

    def batch():
        df = read_examples(spark, source)
        return render_v2(df.withColumn("ex_id", content_key(df.columns)))

    for more in (None, HEADER + "Instruction: late,NULL,Output: d\n"):
        if more:
            (tmp_path / "in" / "2.csv").write_text(more)
        write_available(render_v2(stream_examples(spark, source, layout)), out, progress).awaitTermination()
        assert sorted(values(spark.read.parquet(out))) == sorted(values(batch()))
    assert spark.read.parquet(out).count() == 4 * 3


def test_stream_to_model_input(spark, tmp_path):
    """Encoding and splitting work row by row, so they run on the stream too."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text(HEADER + "Instruction: a b,NA,Output: c\nd,e,f\n")
    df = content_keys(read_examples(spark, str(tmp_path / "in")))
    vocab = checkpoint(build_vocab(render_v2(df), size=50))
    for i, how in enumerate(({"vocab": vocab}, {"tokenizer_json": word_level_json(vocab)})):
        stream = stream_examples(spark, str(tmp_path / "in"))
        out = split_by_hash(prepare_v2(stream, max_length=8, **how), 0.5)
        paths = [str(tmp_path / f"{name}{i}") for name in ("out", "progress")]
        write_available(out, *paths).awaitTermination()
        want = split_by_hash(prepare_v2(df, max_length=8, **how), 0.5)
        assert sorted(values(spark.read.parquet(paths[0]))) == sorted(values(want))
        assert want.count() == 6


def test_stream_fails_on_other_header(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text("output,input,instruction\nx,y,z\n")
    layout = CsvLayout(("instruction", "input", "output"))
    query = write_available(
        stream_examples(spark, str(tmp_path / "in"), layout), str(tmp_path / "out"), str(tmp_path / "progress")
    )
    with pytest.raises(Exception):
        query.awaitTermination()


def test_stream_needs_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="'output'"):
        stream_examples(spark, str(tmp_path), CsvLayout(("instruction", "input")))


@pytest.mark.parametrize("first, second", [("\n", "\r\n"), ("\r\n", "\n")])
def test_files_with_different_line_ends(spark, tmp_path, first, second):
    folder = tmp_path / "mixed 1"
    folder.mkdir()
    for name, end in (("a b.csv", first), ("b.csv", second)):
        text = HEADER.replace("\n", end) + f'{name},y,"c\r\nd"{end}{name},y,"c\nd"{end}'
        (folder / name).write_bytes(text.encode())
    pattern = str(tmp_path / "mixed*")
    got = sorted(values(read_examples(spark, pattern)))
    assert got == [(n, "y", t) for n in ("a b.csv", "b.csv") for t in ("c\nd", "c\r\nd")]
    with pytest.raises(ValueError, match="line ends"):
        stream_examples(spark, pattern)


def csv_lines(rows):
    return [",".join('"' + c.replace('"', '""') + '"' if "\n" in c or '"' in c else c for c in r) for r in rows]


@pytest.fixture
def cut_into(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in names}

    def cut(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield cut
    for k, v in before.items():
        spark.conf.set(k, v)


LONG = [(f"i{i}", "x\ny, z" * (i % 4), f'say "{i}"\n\n,"end' if i % 3 else f"o{i}") for i in range(30)]
LONG += [("long", "line\n" * 100, "o"), ("last", "", "plain")]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [17, 64, 100000])
def test_records_across_splits(spark, tmp_path, cut_into, end, size):
    (tmp_path / "a.csv").write_bytes(end.join([HEADER.strip(), *csv_lines(LONG), ""]).encode())
    cut_into(size)
    df = read_examples(spark, str(tmp_path / "a.csv"))
    assert sorted(values(df)) == sorted((a, b or None, c) for a, b, c in LONG)
    assert size == 100000 or df.rdd.getNumPartitions() > 1


@pytest.mark.parametrize("size", [17, 64, 100000])
def test_rows_are_numbered_in_file_order(spark, tmp_path, cut_into, size):
    files = [("a.csv", "\n"), ("b.csv", "\r\n"), ("c.csv", "\r"), ("d.csv", "\n"), ("e.csv", "\r\n"), ("f.csv", "\n")]
    expected = []
    for i, (name, end) in enumerate(files):
        rows = [(f"{name} {a}", b, c) for a, b, c in LONG[: 32 - 5 * i]] if end != "\r" else [(f"{name} {j}", "b", "c") for j in range(9)]
        names = ["instruction", "input", "output"]
        if i % 2:
            rows, names = [r[::-1] for r in rows], names[::-1]
        blank = end if i == 3 else ""
        text = blank + end.join([",".join(names), *csv_lines(rows), ""]) + blank
        if name == "f.csv":
            text = ",".join(names) + end  # a header alone
        else:
            expected += rows if i % 2 == 0 else [r[::-1] for r in rows]
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "g.csv").write_text("")
    cut_into(size)
    df = ingest_examples(spark, str(tmp_path))
    got = df.orderBy("row_index").select("row_index", *REQUIRED).collect()
    assert [tuple(r) for r in got] == [(i, a, b or None, c) for i, (a, b, c) in enumerate(expected)]


def test_an_unfinished_record_is_kept(spark, tmp_path, cut_into):
    (tmp_path / "a.csv").write_text(HEADER + 'a,b,c\nd,e,"never closed\nx\n')
    for size in (20, 1000):
        cut_into(size)
        assert ingest_examples(spark, str(tmp_path)).count() == 2


def test_cuts_that_move_between_scans(spark, tmp_path, cut_into, monkeypatch):
    (tmp_path / "a.csv").write_text("\n".join([HEADER.strip(), *csv_lines(LONG), ""]))
    cut_into(64)
    lazy = read_examples(spark, str(tmp_path))
    whole = csv.split_starts

    def move_then(*args):
        found = whole(*args)
        cut_into(40)  # as if the number of cores had changed after the first scan
        return found

    monkeypatch.setattr(csv, "split_starts", move_then)
    df = ingest_examples(spark, str(tmp_path))
    assert [r["instruction"] for r in df.orderBy("row_index").collect()] == [r[0] for r in LONG]
    with pytest.raises(Exception, match="cut in other places"):
        lazy.collect()


def test_preparations_of_an_ingested_table_shuffle_nothing(spark, tmp_path, cut_into):
    (tmp_path / "a.csv").write_text("\n".join([HEADER.strip(), *csv_lines(LONG), ""]))
    cut_into(64)
    df = ingest_examples(spark, str(tmp_path), index="ex_id")
    vocab = checkpoint(build_vocab(render_v2(df), size=50))
    for prepared in (prepare_v1(df, vocab, max_length=16), prepare_v2(df, vocab, max_length=16)):
        # the vocabulary's lookup table is a subquery, nothing moves the rows
        assert not node_names(prepared) & {"Join", "Aggregate", "Sort", "Window", "Repartition", "RepartitionByExpression"}
        assert prepared.select("ex_id").distinct().count() == len(LONG)


def test_reader_equals_the_whole_file_reader_on_random_files(spark, tmp_path, cut_into):
    rng = random.Random(3)
    cells = ["", "a", "é", 'q"q', "x\ny", ",", '"', "\n", " s ", '""', "-"]
    rows = [tuple("".join(rng.choices(cells, k=rng.randrange(4))) or "v" for _ in range(3)) for _ in range(400)]
    (tmp_path / "a.csv").write_text("\n".join([HEADER.strip(), *[",".join('"' + c.replace('"', '""') + '"' for c in r) for r in rows], ""]))
    cut_into(97)
    got = ingest_examples(spark, str(tmp_path), na_words=())
    assert [tuple(r)[1:] for r in got.orderBy("row_index").collect()] == rows


def test_files_of_a_stream_are_cut_and_written_once(spark, tmp_path, cut_into):
    (tmp_path / "in").mkdir()
    lines = csv_lines(LONG)
    (tmp_path / "in" / "a [1].csv").write_bytes("\r\n".join([HEADER.strip(), *lines, ""]).encode())
    (tmp_path / "in" / "b%20.csv").write_text("output,input,instruction\nz,y,x\n")
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    cut_into(64)

    def expected():
        rows = content_keys(read_examples(spark, source).select(*REQUIRED))
        return sorted(map(str, values(render_v2(rows))))

    def run():
        write_files_available(spark, source, out, progress, render_v2).awaitTermination()
        return sorted(map(str, values(spark.read.parquet(out).drop("batch"))))

    assert run() == expected()
    assert len(list((tmp_path / "out" / "batch=0").glob("*.parquet"))) > 1
    for name in ("0", ".0.crc"):  # as if it had failed after writing
        (tmp_path / "progress" / "commits" / name).unlink()
    assert run() == expected() == run()
    (tmp_path / "in" / "late.csv").write_text(HEADER + "late,,o\n")
    assert run() == expected()


def test_reports_of_batches(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.csv").write_text(HEADER + "a,b,c\n" * (i + 1))
    stream = stream_examples(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    prompts = render_v2(stream, repeat_count=2, observation="augment")
    with BatchReports(spark, "augment") as reports:
        query = write_available(prompts, str(tmp_path / "out"), str(tmp_path / "progress"))
        query.awaitTermination()
        found = reports.of(query)
    assert sorted(c["rows_before"] for c in found.values()) == [1, 2, 3]
    assert all(c["rows_after"] == 2 * c["rows_before"] for c in found.values()) and list(found) == [0, 1, 2]
