"""Readers, writers and flows on small files."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalstrata.errors import DatasetError
from pedalstrata.operators import cleaning, quality
from pedalstrata.plans import flows
from pedalstrata.plans.lineitem_feed import hour_dirty, hour_raw
from pedalstrata.schemas import bronze_schema, raw_schema
from pedalstrata.sources import layers, readers, staging, tables, writers


def write_text(path: Path, text: str) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- readers -------------------------------------------------------------------------------


def test_reordered_header_fails(spark, tmp_path):
    path = write_text(tmp_path / "t.csv", "cnt,dteday\n5,2011-01-01\n")
    schema = "dteday string, cnt string"
    df = readers.scan_csv(spark, path, spark.createDataFrame([], schema).schema)
    with pytest.raises(Exception, match="CSV header does not conform"):
        df.collect()


def test_missing_or_empty_dataset(spark, tmp_path):
    with pytest.raises(DatasetError, match="no such dataset"):
        readers.scan_raw(spark, f"{tmp_path}/none.csv", raw_schema("hour"))
    header = ",".join(raw_schema("hour").names)
    with pytest.raises(DatasetError, match="no rows"):
        readers.scan_raw(spark, write_text(tmp_path / "empty.csv", header + "\n"), raw_schema("hour"))


def test_inference_after_na_tokens(spark, tmp_path):
    text = "a,b,c,d,e,f\n1,1.5,x,True,NA,2011-01-01\nNA,2,,False,null,2011-01-02\n3,n/a,-,true,,bad\n"
    df = readers.scan_csv_inferred(spark, write_text(tmp_path / "t.csv", text))
    types = ["bigint", "double", "string", "boolean", "string", "string"]
    assert [f.dataType.simpleString() for f in df.schema] == types
    assert rows(df) == [
        (1, 1.5, "x", True, None, "2011-01-01"),
        (None, 2.0, None, False, None, "2011-01-02"),
        (3, None, "-", True, None, "bad"),
    ]


def test_detection_is_compiled_however_many_columns(spark):
    """The JVM leaves methods of 8000 bytes and more to its interpreter."""
    wide = spark.createDataFrame([["1"] * 40], T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(40)]))
    for dates in (True, False):
        made = readers.cell_kinds(wide, dates)._jdf.queryExecution().debug().codegenToSeq()
        largest = max(made.apply(i)._3().maxMethodCodeSize() for i in range(made.size()))
        assert 0 < largest < 8000


def test_detection_of_odd_cells(spark):
    """Kinds and dates of a column from all its cells, blanks, nulls and tokens among them."""
    columns = {
        "digits": (["1", "9", "", None, "NA"], "bigint"),
        "signs": (["+1", " -2 ", "\t3"], "bigint"),
        "eight": (["20110101", "20110102"], "bigint"),
        "days": (["20110101", "2011-01-02", "NA", None], "date"),
        "no_days": (["20111301", "2011-01-02"], "string"),
        "no_day": (["20110230", "2011-01-02"], "string"),
        "short": (["7", "2011-01-02"], "string"),
        "decimal": (["1.5", "2011-01-02"], "string"),
        "half": ([".5", "-1e3", "inf", "4"], "double"),
        "big": (["9223372036854775808", "1"], "string"),
        "flags": (["True", "false", "null"], "boolean"),
        "mixed": (["True", "1"], "string"),
        "times": (["2011-01-02 10:00:00", "2011-01-02"], "string"),
        "nothing": (["", None, "NaN"], "string"),
    }
    n = max(len(cells) for cells, _ in columns.values())
    given = spark.createDataFrame(
        [[(cells + [None] * n)[i] for cells, _ in columns.values()] for i in range(n)],
        T.StructType([T.StructField(c, T.StringType()) for c in columns]),
    )
    found = given.select(*[F.expr(e).alias(c) for c, e in readers.inferred(given, True).items()])
    assert {f.name: f.dataType.simpleString() for f in found.schema} == {c: kind for c, (_, kind) in columns.items()}
    assert sorted(str(r.days) for r in found.collect()) == ["2011-01-01", "2011-01-02", "None", "None", "None"]


def test_optional_inputs(spark, tmp_path):
    with pytest.raises(DatasetError, match="no csv input"):
        readers.scan_optional(spark, str(tmp_path))
    write_text(tmp_path / "hour.csv", "dteday,cnt\n2011-01-01,5\n")
    assert list(readers.scan_optional(spark, str(tmp_path))) == ["hour"]


def test_discovery_by_format(spark, tmp_path):
    with pytest.raises(DatasetError, match="no processed files"):
        readers.scan_by_format(spark, str(tmp_path))
    write_text(tmp_path / "day.csv", "dteday,cnt\n2011-01-01,5\n")
    spark.range(3).write.parquet(f"{tmp_path}/hour.parquet")
    assert sorted(readers.scan_by_format(spark, str(tmp_path))) == ["day.csv", "hour.parquet"]


def test_external_table_reads_files_when_queried(spark, tmp_path, db):
    write_text(tmp_path / "raw" / "a.csv", "dteday,cnt\n2011-01-01,5\n")
    df = readers.external_csv_table(spark, f"{db}.bronze", f"{tmp_path}/raw")
    assert [f.dataType.simpleString() for f in df.schema] == ["date", "bigint"]
    write_text(tmp_path / "raw" / "b.csv", "dteday,cnt\n2011-01-02,6\n")
    again = readers.external_csv_table(spark, f"{db}.bronze", f"{tmp_path}/raw")
    assert again.count() == 2
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("dteday", "cnt")])
    text = readers.external_csv_table(spark, f"{db}.text", f"{tmp_path}/raw", schema)
    assert sorted(rows(text)) == [("2011-01-01", "5"), ("2011-01-02", "6")]
    spark.sql(f"DROP VIEW {db}.bronze")
    assert (tmp_path / "raw" / "a.csv").exists()


# --- writers -------------------------------------------------------------------------------


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_layer_round_trip_and_refresh(spark, sf_dir, tmp_path, fmt):
    df = hour_raw(spark, sf_dir)
    for _ in range(2):
        path = writers.write_layer(df, str(tmp_path), "hour", fmt)
    back = spark.read.parquet(path) if fmt == "parquet" else readers.scan_csv(spark, path, df.schema)
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="unknown format"):
        writers.write_layer(spark.range(1), "/nowhere", "t", "orc")


def test_publish_only_with_target(spark, tmp_path):
    df = spark.range(3)
    assert writers.publish_raw({"hour": df}, None) == {}
    assert writers.publish_raw({"hour": df}, str(tmp_path), skip=True) == {}
    assert not any(tmp_path.iterdir())
    paths = writers.publish_raw({"hour": df}, str(tmp_path), "parquet")
    assert paths == {"hour": layers.current(spark, f"{tmp_path}/raw/hour.parquet")}
    assert spark.read.parquet(paths["hour"]).count() == 3


def test_load_replaces_rows_and_schema(spark, db):
    writers.load_truncate(spark.range(3), f"{db}.t")
    out = writers.load_truncate(spark.range(5).withColumn("extra", F.lit(1)), f"{db}.t")
    assert out.count() == 5 and out.columns == ["id", "extra"]


def test_load_may_read_its_own_target(spark, db):
    writers.load_truncate(spark.range(3), f"{db}.t")
    out = writers.load_truncate(spark.table(f"{db}.t").where("id > 0"), f"{db}.t")
    assert sorted(rows(out)) == [(1,), (2,)]


def failing(spark):
    fault = F.when(F.col("id") > 500, F.raise_error(F.lit("halfway")).cast("long")).otherwise(F.col("id"))
    return spark.range(1000, numPartitions=4).select(fault.alias("id"), (F.col("id") % 2).alias("part"))


@pytest.mark.parametrize("partition_by", [(), ("part",)])
def test_failed_load_leaves_the_old_table(spark, db, tmp_path, partition_by):
    old = spark.range(10).withColumn("part", F.col("id") % 2)
    writers.load_truncate(old, f"{db}.t", partition_by)
    with pytest.raises(Exception, match="halfway"):
        writers.load_truncate(failing(spark), f"{db}.t", partition_by)
    assert sorted(rows(spark.table(f"{db}.t"))) == sorted(rows(old))
    writers.load_truncate(old.where("id < 4"), f"{db}.t", partition_by)
    assert spark.table(f"{db}.t").count() == 4
    assert len([p for p in (tmp_path / "db").iterdir() if not p.name.startswith(".")]) == 1


# --- tables that are replaced together --------------------------------------------------------


class Broken(Exception):
    pass


def failing_at(monkeypatch, module, name, number):
    """Have the ``number``-th call of a function fail."""
    calls, real = [], getattr(module, name)

    def called(*args):
        calls.append(args)
        if len(calls) == number:
            raise Broken(name)
        return real(*args)

    monkeypatch.setattr(module, name, called)


def names_in(spark, db):
    return sorted(t.name for t in spark.catalog.listTables(db))


def test_a_definition_that_the_catalog_refuses_leaves_the_old_table(spark, db, tmp_path, monkeypatch):
    writers.load_truncate(spark.range(10), f"{db}.t")
    # The rows are written; the catalog then refuses the definition, as for a name that it can't hold.
    monkeypatch.setattr(tables, "_NEW", "__new ?")
    with pytest.raises(Exception, match="INVALID_SCHEMA_OR_RELATION_NAME"):
        writers.load_truncate(spark.range(3).withColumn("more", F.lit(1)), f"{db}.t")
    assert spark.table(f"{db}.t").count() == 10 and names_in(spark, db) == ["t"]
    assert len([p for p in (tmp_path / "db").iterdir() if not p.name.startswith(".")]) == 1


def test_nested_names_with_blanks(spark, db):
    df = spark.range(3).select(F.struct(F.col("id").alias("a b"), F.lit("x").alias("c,d")).alias("s"), F.col("id").alias("k.x"))
    for _ in range(2):
        out = writers.load_truncate(df, f"{db}.t")
        assert out.schema.simpleString() == df.schema.simpleString()
        assert sorted(map(str, rows(out))) == sorted(map(str, rows(df)))


@pytest.mark.parametrize("step", [1, 2, 3, 4, 5, 6])
def test_a_failure_at_any_step_of_the_switch_leaves_all_tables(spark, db, monkeypatch, step):
    """Three tables, two renames each."""
    old = {f"gold_{n}": spark.range(n + 1) for n in range(3)}
    writers.load_layers("gold", {"gold": {n.removeprefix("gold_"): df for n, df in old.items()}}, db)
    failing_at(monkeypatch, tables, "_rename", step)
    with pytest.raises(Broken):
        writers.load_layers("gold", {"gold": {str(n): spark.range(50).withColumn("x", F.lit(n)) for n in range(3)}}, db)
    assert names_in(spark, db) == sorted(old)
    for name, df in old.items():
        assert sorted(rows(spark.table(f"{db}.{name}"))) == sorted(rows(df))


def test_a_failing_last_table_leaves_all_tables(spark, sf_dir, db):
    flows.medallion(hour_dirty(spark, sf_dir), db)
    before = {n: spark.table(f"{db}.{n}").count() for n in names_in(spark, db)}
    gold = {"first": spark.range(3), "last": failing(spark)}
    with pytest.raises(Exception, match="halfway"):
        writers.load_layers("both", {"silver": {"hour": spark.range(2)}, "gold": gold}, db)
    assert {n: spark.table(f"{db}.{n}").count() for n in names_in(spark, db)} == before


def test_a_load_puts_back_what_a_dead_driver_left(spark, db, tmp_path):
    writers.load_truncate(spark.range(4), f"{db}.t")
    run = "0123456789ab"
    spark.sql(f"ALTER TABLE {db}.t RENAME TO {db}.t{tables._SPARE}{run}")
    # Beside it, a table that had been prepared, one that had been switched, and others with like names.
    for name in (f"t{tables._NEW}{run}", "u", f"u{tables._SPARE}{run}", "v__old_one", "v__new_"):
        spark.range(3).write.saveAsTable(f"{db}.{name}", format="parquet", path=f"{tmp_path}/rows/{name}")
    assert tables.recover(spark, db) == ["t"] and spark.table(f"{db}.t").count() == 4
    assert names_in(spark, db) == ["t", "u", "v__new_", "v__old_one"]
    assert sorted(p.name for p in (tmp_path / "rows").iterdir()) == ["u", "v__new_", "v__old_one"]
    assert tables.recover(spark, db) == []


def test_prepared_rows_can_be_read_and_are_gone_without_commit(spark, db, tmp_path):
    with tables.TableLoad(spark) as load:
        prepared = load.add(spark.range(7), f"{db}.t")
        assert prepared.count() == 7 and not spark.catalog.tableExists(f"{db}.t")
        with pytest.raises(ValueError, match="in this load already"):
            load.add(spark.range(1), f"{db}.t")
    assert names_in(spark, db) == [] and not any((tmp_path / "db").glob("t-*"))


# --- committed layers ---------------------------------------------------------------------------


def read_back(spark, base):
    return {n: spark.read.parquet(layers.current(spark, f"{base}/{n}.parquet")).count() for n in ("day", "hour")}


@pytest.mark.parametrize(("function", "number", "after"), [("create_empty", 1, 10), ("create_empty", 2, 10), ("remove", 1, 3)])
def test_a_fault_at_any_step_leaves_complete_layers(spark, tmp_path, monkeypatch, function, number, after):
    """Before the commit, between two commits, and when the old version is to be deleted."""
    old = {"day": spark.range(10), "hour": spark.range(10)}
    writers.write_layers(old, str(tmp_path), "parquet")
    failing_at(monkeypatch, layers, function, number)
    with pytest.raises(Broken):
        writers.write_layers({"day": spark.range(3), "hour": spark.range(3)}, str(tmp_path), "parquet")
    assert read_back(spark, tmp_path) == {"day": after, "hour": after}
    monkeypatch.undo()
    writers.write_layers({"day": spark.range(5), "hour": spark.range(5)}, str(tmp_path), "parquet")
    assert read_back(spark, tmp_path) == {"day": 5, "hour": 5}


def test_no_folder_is_renamed(spark, tmp_path, monkeypatch):
    """Where renaming is a copy, or fails, layers still switch."""
    assert not hasattr(staging, "move")
    for n in (4, 6):
        path = writers.write_layer(spark.range(n), str(tmp_path), "hour", "parquet")
        assert spark.read.parquet(path).count() == n


def test_a_layer_of_another_writer_is_read_and_replaced(spark, tmp_path):
    path = f"{tmp_path}/hour.parquet"
    spark.range(4).write.parquet(path)
    assert layers.current(spark, path) == path and readers.scan_optional(spark, str(tmp_path), fmt="parquet")["hour"].count() == 4
    writers.write_layer(spark.range(2), str(tmp_path), "hour", "parquet")
    assert readers.scan_optional(spark, str(tmp_path), fmt="parquet")["hour"].count() == 2
    assert not list(Path(path).glob("part-*"))
    single = write_text(tmp_path / "day.csv", "a\n1\n")
    with pytest.raises(DatasetError, match="single file"):
        writers.write_layer(spark.range(2), str(tmp_path), "day")
    assert Path(single).read_text() == "a\n1\n"


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_failed_write_leaves_the_old_layer(spark, tmp_path, fmt):
    path = writers.write_layer(spark.range(10), str(tmp_path), "hour", fmt)
    with pytest.raises(Exception, match="halfway"):
        writers.write_layer(failing(spark), str(tmp_path), "hour", fmt)
    layer = f"{tmp_path}/hour.{fmt}"
    assert layers.current(spark, layer) == path
    assert spark.read.format(fmt).option("header", True).load(path).count() == 10
    path = writers.write_layer(spark.range(3), str(tmp_path), "hour", fmt)
    assert layers.current(spark, layer) == path
    assert spark.read.format(fmt).option("header", True).load(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == [f"hour.{fmt}"]
    assert sorted(p.name for p in Path(layer).iterdir()) == ["_commits", Path(path).name]


def test_csv_keeps_text(spark, tmp_path):
    texts = [" a ", "b ", '"', 'say "hi", ok', "\\", 'x\\"', ",", "\t", "#1", "'", " ", "é", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, `a.b` string")
    path = writers.write_layer(df, str(tmp_path), "t")
    assert sorted(rows(readers.scan_csv(spark, path, df.schema))) == sorted(rows(df))
    for text in ("a\nb", "a\rb"):
        with pytest.raises(Exception, match="line break"):
            writers.write_layer(spark.createDataFrame([(text,)], "t string"), str(tmp_path), "u")


def test_malformed_rows_are_loud(spark, tmp_path):
    schema = spark.createDataFrame([], "a long, b long").schema
    for bad in ("3,4,5", "x,6", "7"):
        path = write_text(tmp_path / f"{len(bad)}.csv", f"a,b\n1,2\n{bad}\n")
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            readers.scan_raw(spark, path, schema).collect()
        if not bad.startswith("x"):  # a cell is parsed only where its column is read
            with pytest.raises(Exception, match="MALFORMED_RECORD"):
                readers.scan_raw(spark, path, schema).select("b").collect()


def test_every_line_is_accounted_for(spark, tmp_path):
    lines = ["1,x,2011-01-01", "2,y", "3,z,2011-01-02,more", "four,u,2011-01-03", "5,\"a,b\",2011-01-04", "6,v,never",
             '7,"say ""hi"", ok",', '8,"a,b"']
    path = write_text(tmp_path / "t.csv", "\n".join(["n,t,`d", *lines]) + "\n")
    schema = spark.createDataFrame([], "n long, t string, ```d` date").schema
    told = readers.scan_csv_told(spark, path, schema)
    assert sorted(r.n for r in told.rows().collect()) == [1, 5, 7] and told.rows().schema == schema
    assert dict(rows(told.counts())) == {"none": 3, "short": 2, "long": 1, "unfit": 2}
    assert sorted(rows(told.aside())) == sorted(
        [(lines[1], "short"), (lines[2], "long"), (lines[3], "unfit"), (lines[5], "unfit"), (lines[7], "short")]
    )
    detected = readers.scan_csv_told(spark, path, dates=True)
    assert [f.dataType.simpleString() for f in detected.rows().schema] == ["string", "string", "string"]
    assert dict(rows(detected.counts())) == {"none": 5, "short": 2, "long": 1, "unfit": 0}


def test_cleaned_files_are_stored_once(spark, tmp_path, monkeypatch):
    """With a schema, the copy that is split is the only one."""
    stored = []
    monkeypatch.setattr(readers, "stage", lambda df: stored.append("read") or staging.stage(df))
    monkeypatch.setattr(cleaning, "stage", lambda df: stored.append("split") or staging.stage(df))
    write_text(tmp_path / "day.csv", "dteday,cnt\n2011-01-01,1\nbad,2\n2011-01-02\n,3\n")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("dteday", "cnt")])
    done = flows.clean_files(spark, str(tmp_path), f"{tmp_path}/out", schemas={"day": schema})
    assert stored == ["split"]
    assert [r.rows_out for r in done.report.collect()] == [1]
    assert sorted((r.status, r.line) for r in done.rejected["day"].collect()) == [("bad_date", None), ("malformed", "2011-01-02"), ("missing", None)]


def test_told_columns_do_not_hide_data(spark, tmp_path):
    path = write_text(tmp_path / "t.csv", "line,fault,status,dteday,cnt\na,b,c,2011-01-01,1\nd,e,f,bad,2\ng,h\n")
    parts = readers.scan_csv_told(spark, path)
    assert rows(parts.rows().select("line", "fault").where("cnt = 1")) == [("a", "b")]
    done = cleaning.split(parts.df, line=parts.line, fault=parts.fault)
    assert rows(done.rows.select("line", "fault", "status")) == [("a", "b", "c")]
    assert done.report.first().asDict() == {"rows_in": 3, "dropped_malformed": 1, "dropped_null": 0, "dropped_bad_date": 1, "rows_out": 1}
    assert done.rejected.count() == 2


def test_a_skipped_input_is_warned_of(spark, tmp_path, caplog):
    write_text(tmp_path / "hour.csv", "dteday,cnt\n2011-01-01,5\n")
    with caplog.at_level("WARNING"):
        readers.scan_optional(spark, str(tmp_path))
    assert f"no {tmp_path}/day.csv; skipped" in caplog.text


def test_external_table_with_tokens(spark, tmp_path, db):
    write_text(tmp_path / "raw" / "a.csv", "n,x,d,b,t,w\n1,NA,2011-01-01,true,a,2011-01-01 10:00:00\nn/a,2.5,null,NULL,-,\n")
    for _ in range(2):  # created again
        df = readers.external_csv_table(spark, f"{db}.bronze", f"{tmp_path}/raw")
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "double", "date", "boolean", "string", "string"]
    assert sorted(map(str, rows(spark.table(f"{db}.bronze")))) == sorted(map(str, rows(df)))
    write_text(tmp_path / "raw" / "b.csv", "n,x,d,b,t,w\nodd,1,2011-02-30,false,b,\n")
    spark.catalog.refreshTable(f"{db}.bronze_text")
    assert spark.table(f"{db}.bronze").where("t = 'b'").select("n", "x", "d").first() == (None, 1.0, None)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "nxdbtw"])
    assert readers.external_csv_table(spark, f"{db}.bronze", f"{tmp_path}/raw", schema).count() == 3


def test_inferred_dates_and_dotted_names(spark, tmp_path):
    text = "a.b,day,odd,when\n1,2011-01-01,2011-01-01,20110101\n2,NA,bad,20110102\n"
    path = write_text(tmp_path / "t.csv", text)
    df = readers.scan_csv_inferred(spark, path, dates=True)
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "date", "string", "bigint"]
    assert [f.dataType.simpleString() for f in readers.scan_csv_inferred(spark, path).schema][1] == "string"
    assert quality.schema_report(df).count() == 4 and df.count() == 2


def test_partitioned_load(spark, db, tmp_path):
    df = spark.range(1000).withColumn("year_flag", F.col("id") % 2)
    out = writers.load_truncate(df, f"{db}.p", ["year_flag"])
    assert out.count() == 1000 and out.where("year_flag = 1").count() == 500


def test_layer_routing(spark, db):
    tables = {"day": spark.range(2), "hour": spark.range(3)}
    layers = {"silver": tables, "gold": tables}
    assert list(writers.load_layers("silver", layers, db)) == ["silver_day", "silver_hour"]
    assert list(writers.load_layers("gold", layers, db)) == ["gold_day"]
    assert list(writers.load_layers("both", layers, db)) == ["silver_day", "silver_hour", "gold_day"]
    with pytest.raises(ValueError, match="unknown layer"):
        writers.load_layers("bronze", layers, db)


# --- staging -------------------------------------------------------------------------------


class FakeSession:
    def __init__(self, **conf):
        self._conf = {k.replace("_", "."): v for k, v in conf.items()}

    @property
    def conf(self):
        return self._conf


def test_shared_folder_comes_from_the_session(monkeypatch):
    monkeypatch.setattr(staging, "_FOLDERS", [])
    one, two = (staging.shared_dir(FakeSession(spark_checkpoint_dir="hdfs:/ckpt/", spark_master="yarn")) for _ in "ab")
    assert one.startswith("hdfs:/ckpt/pedalstrata/") and one != two


def test_no_local_folder_on_a_cluster(monkeypatch):
    monkeypatch.setattr(staging, "_FOLDERS", [])
    for master in ("spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            staging.shared_dir(FakeSession(spark_master=master))
    with pytest.raises(RuntimeError, match="one machine"):
        staging.shared_dir(FakeSession(spark_master="yarn", spark_checkpoint_dir="file:///tmp/x"))
    assert Path(staging.shared_dir(FakeSession(spark_master="local[2]"))).is_absolute()


def test_release_removes_copies_and_databases(spark):
    staged = staging.stage(spark.range(5))
    (folder,) = {f.rsplit("/", 1)[0].removeprefix("file:") for f in staged.inputFiles()}
    name = staging.own_database("released_db")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{staging.shared_dir(spark)}'")
    writers.load_truncate(spark.range(2), f"{name}.t")
    assert Path(folder.replace("//", "/")).exists()
    staging.release(spark)
    assert not Path(folder.replace("//", "/")).exists() and not spark.catalog.databaseExists(name)


def test_stage_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    staged = staging.stage(df)
    assert staged.schema == df.schema and sorted(map(str, rows(staged))) == sorted(map(str, rows(df)))
    assert "LocalTableScan" not in staged._jdf.queryExecution().toString()


# --- flows ---------------------------------------------------------------------------------


def test_nothing_is_written_unless_both_tables_are_valid(spark, sf_dir, tmp_path):
    few_days = hour_raw(spark, sf_dir).where("dteday < '1995-03-01'")
    assert few_days.count() >= 100 > few_days.select("dteday").distinct().count()
    with pytest.raises(DatasetError, match="day: too few rows"):
        flows.extract(few_days, str(tmp_path))
    assert not any(tmp_path.iterdir())
    with pytest.raises(DatasetError, match="no rows"):
        flows.extract(hour_raw(spark, sf_dir).where("false"), str(tmp_path))


def test_profile_from_the_rollup_equals_a_direct_one(spark, sf_dir):
    hours = hour_dirty(spark, sf_dir).withColumn("dteday", F.col("dteday").try_cast("date"))
    raw = flows.build_raw(hours)
    for name, df in raw.tables().items():
        want = quality.validate_dataset(df, name)
        assert rows(raw.report.where(F.col("dataset") == name)) == rows(want)
    assert raw.day.where("dteday is null").isEmpty()


def test_extract_publishes_what_it_wrote(spark, sf_dir, tmp_path):
    paths = flows.extract(hour_raw(spark, sf_dir), f"{tmp_path}/raw", "csv", publish_to=f"{tmp_path}/bucket")
    schema = bronze_schema("day")
    local = readers.scan_csv(spark, paths["day"], schema)
    published = readers.scan_csv(spark, f"{tmp_path}/bucket/raw/day.csv", schema)
    assert local.exceptAll(published).isEmpty() and published.count() == local.count() == 2289


def test_extract_clean_load(spark, sf_dir, tmp_path, db):
    flows.extract(hour_raw(spark, sf_dir), f"{tmp_path}/raw")
    flows.clean_files(spark, f"{tmp_path}/raw", f"{tmp_path}/processed")
    loaded = flows.load(spark, f"{tmp_path}/processed", "both", db)
    assert sorted(loaded) == [
        "loaded_gold_day", "loaded_gold_monthly", "loaded_gold_rental_metrics", "loaded_gold_weather_metrics",
        "loaded_gold_yearly", "loaded_silver_day", "loaded_silver_hour",
    ]
    assert loaded["loaded_silver_hour"].count() == 6000 and loaded["loaded_silver_day"].count() == 2289
    assert dict(loaded["loaded_silver_day"].dtypes)["dteday"] == "date"
    assert "loaded_gold_hour" not in [t.name for t in spark.catalog.listTables(db)]


def test_cleaning_is_accounted_for(spark, sf_dir, tmp_path):
    writers.write_layer(hour_dirty(spark, sf_dir), str(tmp_path), "hour")
    cleaned = flows.clean_files(spark, str(tmp_path), f"{tmp_path}/out", schemas={"hour": bronze_schema("hour")})
    (row,) = cleaned.report.collect()
    assert row.dataset == "hour" and row.rows_in == 6000 and row.rows_out == 4251
    assert row.rows_in == row.dropped_malformed + row.dropped_null + row.dropped_bad_date + row.rows_out
    assert cleaned.rejected["hour"].count() == row.rows_in - row.rows_out


def test_cleaning_reads_its_input_once(spark, sf_dir, tmp_path, monkeypatch):
    """Each file is scanned by one plan, the one that stores the rows with their status."""
    writers.write_layer(hour_dirty(spark, sf_dir), str(tmp_path), "hour")
    plans, real = [], staging.stage
    for module in (readers, cleaning):
        monkeypatch.setattr(module, "stage", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), real(df))[1])
    cleaned = flows.clean_files(spark, str(tmp_path), f"{tmp_path}/out", schemas={"hour": bronze_schema("hour")})
    assert sum(p.count("FileScan csv") for p in plans) == 1
    for df in (cleaned.report, *cleaned.rejected.values()):
        assert "FileScan csv" not in df._jdf.queryExecution().executedPlan().toString()


def test_counts_survive_a_repeated_task(spark, tmp_path):
    """Every task fails once after it has given out rows."""
    spark_master = spark.sparkContext.master
    mark = str(tmp_path / "failed")

    def fails_once(batches):
        import os

        from pyspark import TaskContext

        own = f"{mark}-{TaskContext.get().partitionId()}"
        yield from batches
        if spark_master.endswith("]") and TaskContext.get().attemptNumber() == 0 and not os.path.exists(own) and retries:
            open(own, "w").close()
            raise RuntimeError("lost")

    retries = int(spark.conf.get("spark.task.maxFailures", "1")) > 1
    df = spark.range(300, numPartitions=3).selectExpr("if(id % 3 = 0, null, '2011-01-01') as dteday", "id as cnt")
    done = cleaning.split(df.mapInArrow(fails_once, "dteday string, cnt bigint"))
    assert done.report.first().asDict() == {"rows_in": 300, "dropped_malformed": 0, "dropped_null": 100, "dropped_bad_date": 0, "rows_out": 200}
    assert done.rows.count() == 200


def test_medallion_then_load_keep_their_tables(spark, sf_dir, tmp_path, db):
    before = {n: (df.schema, df.count()) for n, df in flows.medallion(hour_dirty(spark, sf_dir), db).items()}
    writers.write_layer(hour_raw(spark, sf_dir), str(tmp_path), "hour", "parquet")
    loaded = flows.load(spark, str(tmp_path), "both", db)
    assert not before.keys() & loaded.keys()
    for name, (schema, n) in before.items():
        assert spark.table(f"{db}.{name}").schema == schema and spark.table(f"{db}.{name}").count() == n


def test_load_from_parquet_wins_over_csv(spark, tmp_path, db):
    write_text(tmp_path / "day.csv", "dteday,cnt\n2011-01-01,5\n")
    spark.range(3).write.parquet(f"{tmp_path}/day.parquet")
    assert flows.load(spark, str(tmp_path), "silver", db)["loaded_silver_day"].count() == 3


def test_medallion_tables(spark, sf_dir, db):
    loaded = flows.medallion(hour_dirty(spark, sf_dir), db, ["year_flag"])
    assert loaded["gold_monthly"].count() == 83
    assert loaded["silver_hour"].where("ride_date is null or total_rides is null").isEmpty()
    assert loaded["gold_day"].count() == loaded["silver_day"].count()
    report = {r.dataset: r for r in loaded["cleaning"].collect()}
    assert report["hour"].rows_out == 4251 and report["day"].rows_out == loaded["silver_day"].count()
