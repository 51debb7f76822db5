import gzip
import random
import zipfile
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.operators import joins
from ledgerloom.plans import ingest, load
from ledgerloom.sinks import tables
from ledgerloom.sources import archives, delimited, landing
from ledgerloom.streaming import files as streaming

LEDGER = "REG_ANS;DESCRICAO;VL_SALDO_FINAL"


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return path


def pack(path, entries):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in entries.items():
            archive.writestr(name, text)
    return path


@pytest.fixture()
def registry(spark):
    return spark.createDataFrame(
        [("7", "11222333000181", "Alfa"), ("8", "11222333000262", "Beta")],
        "registration string, entity_id string, entity_name string",
    )


# --- delimited ---------------------------------------------------------------------------


def test_read_delimited_infers_nothing(spark, tmp_path):
    write(tmp_path / "a.csv", "cnpj;ano\n00000000000012;2024\n;\n")
    rows = delimited.read_delimited(spark, str(tmp_path), ["cnpj", "ano"]).collect()
    assert [tuple(r) for r in rows] == [("00000000000012", "2024"), (None, None)]


def test_quoted_line_breaks(spark, tmp_path):
    write(tmp_path / "a.csv", 'cnpj;ano\n"1\n2";2024\n')
    done = delimited.read_delimited(spark, str(tmp_path), ["cnpj", "ano"], multi_line=True)
    assert [tuple(r) for r in done.collect()] == [("1\n2", "2024")]


def test_mixed_encodings_and_column_order(spark, tmp_path):
    write(tmp_path / "utf8.csv", "NOME;UF\nSAÚDE;SP\n")
    write(tmp_path / "bom.csv", "\ufeffNome;Uf\nÁGUA;MG\n")
    write(tmp_path / "latin1.csv", 'uf;nome;extra\nRJ;SAÚDE;1\nBA;"a;b";2\n', "latin-1")
    aliases = {"name": ("nome",), "region": ("uf", "sg_uf")}
    done = delimited.read_mixed_encoding(spark, str(tmp_path), aliases)
    got = {(r.name, r.region) for r in done.collect()}
    assert got == {("SAÚDE", "SP"), ("ÁGUA", "MG"), ("SAÚDE", "RJ"), ("a;b", "BA")}


def test_encoding_is_decided_per_file(spark, tmp_path):
    # 'Ã©' is valid UTF-8 on its own, but another line makes the file Latin-1
    write(tmp_path / "x.csv", "nome\nÃ©\nSAÚDE\n", "latin-1")
    done = delimited.read_mixed_encoding(spark, str(tmp_path), {"name": ("nome",)})
    assert {r.name for r in done.collect()} == {"Ã©", "SAÚDE"}


def test_same_rows_when_the_file_table_is_too_large_to_broadcast(spark, tmp_path, setting):
    for i in range(5):
        write(tmp_path / f"{i}.csv", f"nome;uf\nn{i};u{i}\n", "latin-1" if i % 2 else "utf-8")
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    done = delimited.read_mixed_encoding(spark, str(tmp_path), {"name": ("nome",)})
    assert sorted(r.name for r in done.collect()) == [f"n{i}" for i in range(5)]


# --- archives ----------------------------------------------------------------------------


def test_archives(spark, tmp_path):
    pack(tmp_path / "one.zip", {"sub/": "", "sub/a.csv": "h\r\n1\r\n", "b.TXT": "x\ny", "notes.pdf": "z"})
    write(tmp_path / "bad.zip", "not a zip")
    good, bad = archives.split_problems(archives.read_archives(spark, str(tmp_path)))
    rows = {(r.entry, r.line_no): bytes(r.raw) for r in good.collect()}
    assert rows == {("sub/a.csv", 1): b"h", ("sub/a.csv", 2): b"1", ("b.TXT", 1): b"x", ("b.TXT", 2): b"y"}
    problems = {(r.src_file.rsplit("/", 1)[1], r.entry, r.problem) for r in bad.collect()}
    assert problems == {
        ("one.zip", "notes.pdf", archives.UNSUPPORTED),
        ("bad.zip", None, archives.NOT_AN_ARCHIVE),
    }


def test_archives_of_any_name_and_many_lines(spark, tmp_path):
    lines = "\n".join(str(i) for i in range(50_000))
    for name in ("b c.zip", "d%20e.zip", "f#g.zip", "saúde.ZIP"):
        pack(tmp_path / name, {"a.csv": lines, "b.csv": "x"})
    rows = archives.read_archives(spark, str(tmp_path))
    counts = {(r.entry, r["count"]) for r in rows.groupBy("src_file", "entry").count().collect()}
    assert counts == {("a.csv", 50_000), ("b.csv", 1)} and rows.count() == 4 * 50_001
    assert rows.filter("entry = 'a.csv' and cast(raw as string) <> cast(line_no - 1 as string)").count() == 0


def test_damaged_entry_rejects_the_whole_archive(spark, tmp_path):
    path = pack(tmp_path / "a.zip", {"a.csv": "1;2\n" * 1000, "b.csv": "3;4\n" * 1000})
    raw = bytearray(path.read_bytes())
    at = raw.rindex(b"b.csv", 0, raw.index(b"PK\x01\x02")) + 8
    raw[at] ^= 0xFF
    path.write_bytes(bytes(raw))
    good, bad = archives.split_problems(archives.read_archives(spark, str(tmp_path)))
    assert good.count() == 0 and bad.count() == 1


# --- landing folder ------------------------------------------------------------------------


def test_formats_and_relevance(spark):
    names = ["Despesas.CSV", "3T2024.zip", "4T2024.zip", "x.txt", "eventos.xlsx", "notes.pdf", "plain"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(
        "n",
        landing.format_of("n").alias("kind"),
        landing.is_relevant("n", F.lit(2024), F.lit(3)).alias("relevant"),
    )
    got = {r.n: (r.kind, r.relevant) for r in df.collect()}
    assert got == {
        "Despesas.CSV": ("csv", True),
        "3T2024.zip": ("archive", True),
        "4T2024.zip": ("archive", False),
        "x.txt": ("csv", False),
        "eventos.xlsx": ("excel", True),
        "notes.pdf": (None, False),
        "plain": (None, False),
    }


def test_latest_periods_and_snapshot(spark, tmp_path):
    for name in ("1T2023.zip", "4T2023.zip", "2T2024.zip", "Relatorio_cadop.csv", "Relatorio_cadop_2.csv"):
        write(tmp_path / name, "x")
    files = landing.list_landing(spark, str(tmp_path))
    newest = landing.keep_latest_periods(files, 2).collect()
    assert {r.file_name for r in newest} == {"4T2023.zip", "2T2024.zip"}
    assert landing.latest_snapshot(files).first().file_name == "Relatorio_cadop_2.csv"


# --- ingest --------------------------------------------------------------------------------


def test_registry_reader(spark, tmp_path):
    write(
        tmp_path / "Relatorio_cadop.csv",
        "Registro_Operadora;CNPJ;Razao_Social;Modalidade;UF;x\n"
        " 7 ;11.222.333/0001-81;SAÚDE;Med;SP;1\n7;1;segunda;Med;RJ;1\n;2;sem;Med;RJ;1\n",
        "latin-1",
    )
    rows = ingest.read_registry(spark, str(tmp_path)).collect()
    assert [tuple(r)[:5] for r in rows] == [("11222333000181", "7", "SAÚDE", "Med", "SP")]
    assert set(S.FILE_ORDER) <= set(rows[0].__fields__)


def test_ingest_landing_end_to_end(spark, tmp_path, registry):
    pack(
        tmp_path / "2024" / "3T" / "3T2024.zip",
        {"sub/3T2024.csv": f"{LEDGER}\n007;EVENTO X;1,5\n8;Sinistro;1.234,56\n9;Evento;2,0\n7;OUTRO;9,9\n"},
    )
    write(
        tmp_path / "2024" / "2T" / "despesas_2T.csv",
        " CD_CNPJ ;Nm Razao Social;TRI;ANO_COMPETENCIA;Vl Despesa\n"
        "11.222.333/0001-81;SAÚDE;2;2024;10,00\n11.222.333/0001-81;OUTRO;2;2024;-1\n"
        "11.222.333/0001-81;SAÚDE;2;2024;10,00\n",
        "latin-1",
    )
    # the period comes from the path where the file does not give it
    write(tmp_path / "2024" / "1T" / "evento.txt", "cnpj;valor\n11222333000262;7,00\n")
    write(tmp_path / "2023" / "1T" / "despesas.csv", "cnpj;valor\n1;1\n")
    write(tmp_path / "2024" / "1T" / "clash_despesa.csv", "cnpj;eventos;sinistros\n1;2;3\n")
    write(tmp_path / "2024" / "1T" / "despesa_x.csv", "a;b\n1;2\n")
    write(tmp_path / "2024" / "1T" / "despesa.pdf", "x")
    write(tmp_path / "2024" / "1T" / "evento_bad.zip", "junk")
    write(tmp_path / "2024" / "1T" / "other.csv", "cnpj;valor\n3;3\n")

    done = ingest.ingest_landing(spark, str(tmp_path), registry, n_periods=3)
    rows = [(r.entity_id, r.entity_name, r.quarter, r.year, r.amount, r.issue_flags) for r in done.expense.collect()]
    alfa = "11222333000181"
    assert rows == [
        ("", None, 3, 2024, D("2.00"), "RAZAO_VAZIA;CNPJ_SEM_MATCH;CNPJ_INVALIDO"),
        (alfa, "Alfa", 3, 2024, D("1.50"), ""),
        ("11222333000262", "Beta", 3, 2024, D("1234.56"), ""),
        (alfa, "OUTRO", 2, 2024, D("-1.00"), "VALOR_NEGATIVO;CNPJ_RAZAO_DIVERGENTE"),
        (alfa, "SAÚDE", 2, 2024, D("10.00"), "CNPJ_RAZAO_DIVERGENTE"),
        ("11222333000262", None, 1, 2024, D("7.00"), "RAZAO_VAZIA"),
    ]
    rejects = {(r.src_file.rsplit("/", 1)[1], r.problem) for r in done.rejects.collect()}
    assert rejects == {
        ("clash_despesa.csv", ingest.AMBIGUOUS),
        ("despesa_x.csv", ingest.NO_KNOWN_COLUMN),
        ("despesa.pdf", archives.UNSUPPORTED),
        ("evento_bad.zip", archives.NOT_AN_ARCHIVE),
    }


def test_ledger_rows_survive_an_unknown_registration(spark, registry):
    df = spark.createDataFrame(
        [("9", "evento", "1,0", 2024, 1), ("7", "x", "1,0", 2024, 1)],
        "registration string, description string, amount string, year int, quarter int",
    )
    assert [tuple(r) for r in ingest.from_ledger(df, registry).collect()] == [(None, None, 2024, 1, D("1.00"))]


def test_excluded_files_are_not_opened(spark, tmp_path):
    for q in (1, 2, 3, 4):
        write(tmp_path / f"despesas={q}T2024" / "part-0.csv", "cnpj;valor\n1;1\n" * 50)
    write(tmp_path / "despesas=4T2024" / "part-1.pdf", "x")

    def keep(path):
        return landing.is_chosen(path, [(2024, 4), (2024, 3)])

    lines = delimited.read_lines(spark, str(tmp_path), landing.TEXT_FILES, keep)
    assert lines.count() == 200
    execution = lines._jdf.queryExecution().executedPlan()
    execution.executeCollect()
    scan = execution
    while scan.children().size():
        scan = scan.children().head()
    assert scan.metrics().get("numFiles").get().value() == 2


def test_scratch_removes_its_tables(spark):
    from pathlib import Path

    from ledgerloom import session

    with session.scratch(spark):
        df = session.materialize(spark.range(3), "t")
        folder = Path(df.inputFiles()[0].removeprefix("file://")).parent
        assert folder.exists()
    assert not folder.exists()


# --- sinks ---------------------------------------------------------------------------------


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame(
        [("1", "a", 1, 2024, D("1.50"), "X"), ("2", "", 2, 2024, None, ""), ("3", None, 2, 2023, D("-2"), "")],
        "entity_id string, entity_name string, quarter smallint, year smallint, amount decimal(18,2), issue_flags string",
    )


def test_csv_output(spark, tmp_path, rows):
    out = tmp_path / "out"
    tables.write_delimited(rows.coalesce(1), str(out), S.EXPENSE_COLUMNS, compression="gzip")
    (part,) = out.glob("*.csv.gz")
    assert gzip.decompress(part.read_bytes()).decode().splitlines() == [
        "entity_id;entity_name;quarter;year;amount",
        "1;a;1;2024;1.50",
        "2;;2;2024;",
        "3;;2;2023;-2.00",
    ]


def test_two_decimals(spark):
    df = spark.createDataFrame([(1.005, 2, 12.345)], "a double, b int, c double")
    row = tables.two_decimals(df).first()
    assert (row.b, row.c) == (2, D("12.35"))


def test_quarantine(spark, tmp_path, rows):
    assert tables.write_quarantine(rows, str(tmp_path / "q"))
    done = delimited.read_delimited(spark, str(tmp_path / "q"), [*S.EXPENSE_COLUMNS, "issue_flags"])
    assert [r.issue_flags for r in done.collect()] == ["X"]
    clean = rows.filter("issue_flags = ''")
    assert not tables.write_quarantine(clean, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_append_doubles_and_period_load_does_not(spark, tmp_path, rows):
    once, twice = str(tmp_path / "a"), str(tmp_path / "b")
    for _ in range(2):
        tables.append(rows, once)
        tables.load_periods(rows, twice)
    assert spark.read.parquet(once).count() == 6
    assert spark.read.parquet(twice).count() == 3
    tables.load_periods(rows.filter("year = 2023").withColumn("entity_name", F.lit("new")), twice)
    names = {r.entity_id: r.entity_name for r in spark.read.parquet(twice).collect()}
    assert names == {"1": "a", "2": "", "3": "new"}


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.reload(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), path)
    batch = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    for _ in range(2):
        tables.upsert_table(spark, path, batch, ["k"])
        assert {tuple(r) for r in spark.read.parquet(path).collect()} == {("a", 1), ("b", 3), ("c", 4)}
    with pytest.raises(ValueError, match="repeats keys"):
        tables.upsert_table(spark, path, batch.union(batch), ["k"])


def test_upsert_keeps_the_table_when_the_switch_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.reload(spark.createDataFrame([("a", 1)], "k string, v int"), path)
    batch = spark.createDataFrame([("a", 2)], "k string, v int")

    def fail(*_):
        raise OSError("no rename")

    monkeypatch.setattr(tables, "replace_folder", fail)
    with pytest.raises(OSError):
        tables.upsert_table(spark, path, batch, ["k"])
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("a", 1)]


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3)], "p int, k string, v int")
    rows.write.partitionBy("p").parquet(path)
    before = {f.name for f in (tmp_path / "t" / "p=2").glob("*.parquet")}
    batch = spark.createDataFrame([(1, "b", 9), (3, "z", 7)], "p int, k string, v int")
    tables.upsert_table(spark, path, batch, ["p", "k"], ["p"])
    got = {(r.p, r.k, r.v) for r in spark.read.parquet(path).collect()}
    assert got == {(1, "a", 1), (1, "b", 9), (2, "c", 3), (3, "z", 7)}
    assert {f.name for f in (tmp_path / "t" / "p=2").glob("*.parquet")} == before
    with pytest.raises(ValueError, match="among the keys"):
        tables.upsert_table(spark, path, batch, ["k"], ["p"])


def test_upsert_without_broadcast(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    target = spark.range(100).selectExpr("id as k", "0 as v")
    batch = spark.range(50, 150).selectExpr("id as k", "1 as v")
    done = tables.upsert(target, batch, ["k"])
    assert done.count() == 150 and done.filter("v = 1").count() == 100


def test_schema_evolution_and_stamp(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([("1" * 14, "n")], "entity_id string, entity_name string")
    old.write.parquet(path)
    tables.stamp(old.withColumn("region", F.lit("SP"))).write.mode("append").parquet(path)
    done = tables.read_evolved(spark, path, S.REGISTRY)
    assert done.columns == S.REGISTRY.names
    assert sorted(r.region or "" for r in done.collect()) == ["", "SP"]
    assert done.filter("imported_at is not null").count() == 1


# --- typed load --------------------------------------------------------------------------


def test_load_registry(spark):
    blank = dict.fromkeys(S.REGISTRY_STAGING, "")
    df = spark.createDataFrame(
        [
            {**blank, "cnpj": "11.222.333/0001-81", "uf": " SP ", "data_registro_ans": "05/03/2020"},
            {**blank, "cnpj": "123"},
        ],
        S.all_string(S.REGISTRY_STAGING),
    )
    (row,) = load.load_registry(df).collect()
    assert (row.entity_id, row.region, row.entity_name) == ("11222333000181", "SP", None)
    assert row.registered_on == date(2020, 3, 5)


def test_aggregated_text_round_trip(spark):
    row = (1, "A", "SP", D("600.50"), 200.17, 200.17, 100.0, 50.0, 3, False)
    df = spark.createDataFrame(
        [row],
        "rank int, entity_name string, region string, total decimal(38,2), mean double, "
        "mean_per_quarter double, std double, cv_pct double, n_quarters int, high_variability boolean",
    )
    text = load.stage_aggregated(df)
    assert tuple(text.first()) == ("1", "A", "SP", "600.50", "200.17", "200.17", "100.00", "50.00", "3", "false")
    back = load.load_aggregated(text).first()
    assert (back["rank"], back.total, back.mean, back.high_variability) == (1, D("600.50"), D("200.17"), False)


# --- streaming ---------------------------------------------------------------------------


NO_REGISTRY = "registration string, entity_id string, entity_name string, category string, region string"


def test_stream_sees_every_file_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    head = "cnpj;razao_social;trimestre;ano;valor"
    write(tmp_path / "in" / "a.csv", f"{head}\n11222333000181;A;1;2024;1.001,50\n\n11222333000181;B;1;2024;0\n")
    registry = spark.createDataFrame([], NO_REGISTRY)

    def run(place=state):
        stream = streaming.line_stream(spark, source, max_files=1)
        streaming.ingest_stream(stream, registry, target, place).awaitTermination()
        rows = streaming.read_ingested(spark, target).collect()
        return sorted((r.entity_name, str(r.amount), r.issue_flags) for r in rows)

    first = [("A", "1001.50", "CNPJ_RAZAO_DIVERGENTE"), ("B", "0.00", "VALOR_ZERADO;CNPJ_RAZAO_DIVERGENTE")]
    assert run() == first
    assert run() == first
    write(tmp_path / "in" / "b.csv", "valor;ano;trimestre;razao_social;cnpj\n-1;2024;9;SAÚDE;x\n1;2;3;4;5;6\n", "latin-1")
    new = [("SAÚDE", "-1.00", "CNPJ_SEM_MATCH;CNPJ_INVALIDO;VALOR_NEGATIVO;TRIMESTRE_INVALIDO")]
    assert run() == first + new
    assert [r.line for r in streaming.read_rejects(spark, target).collect()] == ["1;2;3;4;5;6"]
    # a second stream on the same target has folders of its own: nothing is lost
    assert run(str(tmp_path / "other")) == sorted(2 * (first + new))


# --- quoted line breaks -------------------------------------------------------------------------


def _as_read(text):
    """(fields of every record) by the standard library, or the lines where a quote stays open."""
    import csv
    import io

    return [row for row in csv.reader(io.StringIO(text, newline=""), delimiter=";") if any(c.strip() for c in row)]


@pytest.mark.parametrize("seed", range(4))
def test_records_over_splits(spark, tmp_path, setting, seed):
    """Random quoted fields, in files cut into splits of a few bytes, against the standard library."""
    draw = random.Random(seed)
    setting("spark.sql.files.maxPartitionBytes", "48")
    setting("spark.sql.files.openCostInBytes", "0")
    expected = {}
    for name in "ab":
        lines = ["k;v;w"]
        for i in range(25):
            text = "".join(draw.choices(["x", "é", ";", "\n", '""', " "], k=draw.randint(1, 12)))
            plain = draw.choice(["y", 'y"y', "", 'z"'])
            lines.append(f'{name}{i};"q{text}";{plain}' if draw.random() < 0.6 else f"{name}{i};{plain};w")
        body = "\n".join(lines) + "\n"
        (tmp_path / f"{name}.csv").write_bytes(body.encode("utf-8" if name == "a" else "latin-1"))
        expected |= {row[0]: [c or None for c in row[1:]] for row in _as_read(body)[1:]}
    done = delimited.read_mixed_encoding(spark, str(tmp_path), {c: (c,) for c in "kvw"})
    rows = done.orderBy("src_file", "line_at").collect()
    assert {r.k: [r.v, r.w] for r in rows} == expected
    assert [r.k for r in rows] == [f"{n}{i}" for n in "ab" for i in range(25)]
    assert all(r.malformed is None for r in rows)


def test_states_at_line_ends(values):
    lines = ["a;b", 'a;"b', 'a;b"c', '"a;""', '"a;"""', 'a";b', '";"', "", 'x;"y";"z', 'x;"y"z;"']
    assert values(delimited.leaves_open("v"), lines) == [False, True, False, True, False, False, False, False, True, True]
    assert values(delimited.leaves_open("v", True), lines) == [True, False, False, False, True, False, True, True, True, True]


def test_a_quote_that_is_never_closed(spark, tmp_path):
    (tmp_path / "1T2024_despesas.csv").write_text('cnpj;razao_social;valor_despesas\n1;"open;1,00\n2;b;2,00\n')
    (tmp_path / "1T2024_despesas_b.csv").write_text('cnpj;razao_social;valor_despesas\n3;"c\nd";3,00\n')
    registry = spark.createDataFrame([], S.REGISTRY)
    done = ingest.ingest_landing(spark, str(tmp_path), registry)
    assert [(r.entity_id, r.entity_name) for r in done.expense.collect()] == [("3", "c\nd")]
    assert [r.problem for r in done.rejects.collect()] == [ingest.UNCLOSED]


def test_wide_lines_are_told_by_their_fields(spark, tmp_path):
    good = ['1;2;3;""', '1;"2;x";3', 'a"b;c;d"e', "1;2;3;;;", "1;2", '1;"""";3; ']
    wide = ['a"b;c;d"e;f', '1;2;3;"x"', "1;2;3;;;x", '1;2;"3";;"a;b"']
    (tmp_path / "f.csv").write_text("\n".join(["x;y;z", *good, *wide]))
    rows = delimited.read_mixed_encoding(spark, str(tmp_path), {c: (c,) for c in "xyz"}).orderBy("line_at").collect()
    assert [r.malformed for r in rows] == [None] * len(good) + wide
    assert [r.y for r in rows[: len(good)]] == ["2", "2;x", "c", "2", "2", '"']


def test_records_over_chunks_of_two_lines(spark, tmp_path, setting, monkeypatch):
    """However few lines are looked at together, records that cross them are whole; no task gets a whole file."""
    monkeypatch.setattr(delimited, "CHUNK_BITS", 1)
    setting("spark.sql.adaptive.enabled", "false")
    body = "k;v\n" + "".join(f'{i};"a\n\n""{i}\n;b"\n{i + 100};plain\n' for i in range(30))
    (tmp_path / "a.csv").write_text(body)
    (tmp_path / "b.csv").write_text('k;v\n200;"x\ny"\n201;"open\n202;z\n')
    lines = delimited.read_lines(spark, str(tmp_path))
    sizes = []
    store = delimited.materialize

    def stored(df, label):
        if label == "quote-states":
            sizes.extend(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        return store(df, label)

    monkeypatch.setattr(delimited, "materialize", stored)
    rows = delimited.join_records(lines, tasks=16).orderBy("src_file", "line_at").collect()
    texts = [bytes(r.raw).decode() for r in rows if not r.unclosed]
    assert texts == ["k;v", *(t for i in range(30) for t in (f'{i};"a\n\n""{i}\n;b"', f"{i + 100};plain"))]
    assert [bytes(r.raw).decode() for r in rows if r.unclosed] == ["k;v", '200;"x', 'y"', '201;"open', "202;z"]
    assert sum(sizes) == lines.count() and len(sizes) > 8 and max(sizes) < 50


def test_rows_are_spread_before_they_are_grouped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "TASK_ROWS", 10)
    spark.range(0, 400, 1, 1).selectExpr("id % 2 AS v").write.parquet(str(tmp_path / "t"))
    spread = ingest._spread(spark.read.parquet(str(tmp_path / "t")))
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 400 and max(sizes) < 40
    assert spread.groupBy("v").count().orderBy("v").collect() == [(0, 200), (1, 200)]


def test_files_of_few_values_are_written_without_a_sort(spark, tmp_path):
    from ledgerloom.session import open_writers

    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    rows = spark.range(0, 90, 1, 3).selectExpr("id", "CAST(id % 3 AS INT) AS part")
    with open_writers(spark, 3):
        assert spark.conf.get(key) == "3"
        rows.repartitionById(3, "part").write.partitionBy("part").csv(str(tmp_path / "t"))
    assert spark.conf.get(key) == before
    assert [len(list((tmp_path / "t" / f"part={p}").glob("*.csv"))) for p in range(3)] == [1, 1, 1]
    assert spark.read.csv(str(tmp_path / "t")).count() == 90
    with pytest.raises(ZeroDivisionError), open_writers(spark, 3):
        1 / 0
    assert spark.conf.get(key) == before


def test_tasks_share_the_name_of_an_archive(spark, tmp_path, monkeypatch):
    """Rows of a name in several tasks, in any order, come back whole."""
    from bindings import packing

    monkeypatch.setattr(packing, "ARCHIVE_LINES", 7)
    names = [f"{q}T2020 despesas.zip" for q in (2, 4)]
    rows = spark.range(0, 100, 1, 4).selectExpr(
        f"'file:{tmp_path}/zip' AS place", f"IF(id % 2 = 0, '{names[0]}', '{names[1]}') AS name", "CAST(id AS string) AS line"
    )
    assert rows.mapInArrow(packing.write_archives, "files long").agg(F.sum("files")).first()[0] == len(list((tmp_path / "zip").iterdir()))
    found = archives.read_archives(spark, str(tmp_path / "zip")).where("line_no > 1")
    assert sorted(int(bytes(r.raw)) for r in found.collect()) == list(range(100))
    assert found.where("problem IS NOT NULL").isEmpty()


def test_lines_of_chosen_files_are_not_filtered_one_by_one(spark, tmp_path, monkeypatch):
    """The condition on the path is met by the list of files; names may hold what a glob would read otherwise."""
    for name in ("1T2024_a.csv", "1T2024 [b]{c,d}.csv", "1T2024_?*.csv", "2T2024_x.csv"):
        write(tmp_path / "sub" / name, f"{name}\ny\n")

    def keep(path):
        return path.rlike("1T2024")

    lines = delimited.read_lines(spark, str(tmp_path), "*.csv", keep)
    assert "RLIKE" not in lines._jdf.queryExecution().executedPlan().toString()
    found = sorted(bytes(r.raw).decode() for r in lines.collect())
    assert found == sorted(["1T2024_a.csv", "1T2024 [b]{c,d}.csv", "1T2024_?*.csv", "y", "y", "y"])
    monkeypatch.setattr(delimited, "NAMED_FILES", 2)
    assert sorted(bytes(r.raw).decode() for r in delimited.read_lines(spark, str(tmp_path), "*.csv", keep).collect()) == found
    assert delimited.read_lines(spark, str(tmp_path), "*.csv", lambda path: path.rlike("3T")).count() == 0


def test_put_together_files_are_not_read_again(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"k\nl";v\n1;"x\ny"\n2;z\n')

    def read(folder):
        lines = delimited.read_lines(spark, str(folder))
        records, files = delimited.whole_records(lines, ["src_file"], lambda d: d)
        return records, sorted(r.header_line for r in files.collect())

    records, headers = read(tmp_path)
    assert "Scan text" not in records._jdf.queryExecution().executedPlan().toString()
    assert headers == ['"k\nl";v'] and sorted(bytes(r.raw).decode() for r in records.collect()) == ['"k\nl";v', '1;"x\ny"', "2;z"]
    (tmp_path / "b.csv").write_text("k;v\n3;w\n")
    records, headers = read(tmp_path)
    assert headers == ['"k\nl";v', "k;v"] and records.count() == 5


@pytest.mark.parametrize("line_bytes", [4, 20_000])
def test_records_over_whole_chunks(spark, tmp_path, monkeypatch, line_bytes):
    """Chunks of thousands of lines, or fewer where lines are long; records and quotes without end in sight."""
    monkeypatch.setattr(delimited, "CHUNK_BYTES", 100_000)
    draw = random.Random(line_bytes)
    n = 12_000 if line_bytes < 100 else 60
    pad = "p" * line_bytes
    rows = [["k", "v", "w"]]
    for i in range(n):
        value = draw.choice([pad, f'{pad}\n"{pad}', f'\n\n;"{pad}', '"' * 9, "é;\n", "\n" * 5_000 if i % 997 == 5 else "u"])
        rows.append([str(i), value, draw.choice(["", "é", 'q"q'])])
    rows += [["x", '"' * 200_000, "y"], ["y", "; " * 100_000, "z"]]

    def cell(value):
        return '"' + value.replace('"', '""') + '"' if any(c in value for c in ';"\n') else value

    (tmp_path / "a.csv").write_bytes("".join(";".join(map(cell, r)) + "\n" for r in rows).encode("latin-1"))
    lines = delimited.read_lines(spark, str(tmp_path))
    records, _ = delimited.whole_records(lines, ["src_file"], lambda d: d)
    found = [bytes(r.raw).decode("latin-1") for r in records.orderBy("line_at").collect()]
    assert found == [";".join(map(cell, r)) for r in rows]
    # every record has the place of its first line
    place = {r.line_at: r.raw for r in lines.collect()}
    assert all(bytes(r.raw).startswith(bytes(place[r.line_at])) for r in records.collect())


def test_records_keep_other_columns(spark):
    raw = ["k;v", '1;"a', 'b";', "", "2;c"]
    lines = spark.createDataFrame([("f", r, (0, i), f"o{i}") for i, r in enumerate(raw)], "src_file string, raw string, line_at struct<file_block_start: bigint, at: bigint>, more string")
    rows = delimited.join_records(lines.withColumn("raw", F.col("raw").cast("binary"))).orderBy("line_at").collect()
    assert [(bytes(r.raw).decode(), r.line_at.at, r.more) for r in rows] == [("k;v", 0, "o0"), ('1;"a\nb";', 1, "o1"), ("", 3, "o3"), ("2;c", 4, "o4")]


def test_only_lines_of_ledgers_are_looked_up(spark, tmp_path, registry, monkeypatch):
    """Rows of other files are not dealt out for a registration they do not have."""
    looked_up, lookup = [], joins.lookup

    def seen(rows, *args, **named):
        looked_up.append(rows.count())
        return lookup(rows, *args, **named)

    monkeypatch.setattr(ingest.joins, "lookup", seen)
    write(tmp_path / "despesas_1T2024.csv", "cnpj;razao_social;trimestre;ano;valor\n1;A;1;2024;1\n1;B;1;2024;2\n;;;;\n1;2;3;4;5;6\n")
    write(tmp_path / "ledger_despesas_1T2024.csv", f"{LEDGER}\n7;EVENTOS/SINISTROS;1,5\n;EVENTOS/SINISTROS;2\n9;other;3\n1;2;3;4\n")
    done = ingest.ingest_lines(delimited.read_lines(spark, str(tmp_path)).withColumn("entry", F.lit("")), registry)
    assert looked_up == [3]
    rows = sorted((r.entity_id, r.entity_name or "", str(r.amount)) for r in done.rows.collect())
    assert rows == [("", "", "2.00"), ("", "", "None"), ("1", "A", "1.00"), ("1", "B", "2.00"), ("11222333000181", "Alfa", "1.50")]
    rejects = sorted((r.src_file.rsplit("/", 1)[1], r.problem, r.line) for r in done.rejects.collect())
    wide = "more fields than the header"
    assert rejects == [("despesas_1T2024.csv", wide, "1;2;3;4;5;6"), ("ledger_despesas_1T2024.csv", wide, "1;2;3;4")]


def test_a_stream_prepares_its_registry_once(spark, tmp_path, registry, monkeypatch):
    made, by_registration = [], ingest._by_registration
    monkeypatch.setattr(ingest, "_by_registration", lambda r: made.append(r) or by_registration(r))
    for i in range(3):
        write(tmp_path / "in" / f"{i}.csv", f"{LEDGER}\n{i + 6};EVENTOS/SINISTROS;{i},5\n")
    stream = streaming.line_stream(spark, str(tmp_path / "in"), max_files=1)
    streaming.ingest_stream(stream, registry, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    rows = streaming.read_ingested(spark, str(tmp_path / "out")).collect()
    assert sorted((r.entity_id, str(r.amount)) for r in rows) == [("", "0.50"), ("11222333000181", "1.50"), ("11222333000262", "2.50")]
    assert len(made) == 1


def test_unseen_rows_are_found_without_a_sort(spark, setting, monkeypatch):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.enabled", "false")
    monkeypatch.setattr(streaming, "HELD_DIGESTS", 10)
    rows = spark.range(0, 400).selectExpr("id AS first", "id * 7 AS second", "CAST(id % 3 AS INT) AS period", "concat('x', id) AS v")
    seen = spark.range(100, 300).selectExpr("id AS first", "id * 7 AS second", "'q' AS query", "1L AS batch", "CAST(id % 3 AS INT) AS period")
    new = streaming.unseen(rows, seen)
    assert sorted(r.first for r in new.collect()) == [*range(100), *range(300, 400)]
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Sort [" not in plan
    assert new.rdd.getNumPartitions() == 20  # each holds some ten of the digests


def test_first_filled_header_of_several(spark, tmp_path):
    write(tmp_path / "a.csv", 'b;a;c\n1;2;3\n1;;3\n;;3\n"";"4";\n')
    write(tmp_path / "b.csv", "c;b\n5;6\n")
    rows = delimited.read_mixed_encoding(spark, str(tmp_path), {"x": ("a", "b"), "y": ("c",), "z": ("d",)})
    found = sorted((r.src_file[-5:], r.x or "", r.y or "", r.z or "") for r in rows.collect())
    assert found == [("a.csv", "", "3", ""), ("a.csv", "1", "3", ""), ("a.csv", "2", "3", ""), ("a.csv", "4", "", ""), ("b.csv", "6", "5", "")]
    # no function is called for each place of each line
    assert "lambdafunction(_values" not in rows._jdf.queryExecution().executedPlan().toString()
