"""Monthly files: header and trailer, short records, rejects, archives, code lists."""

import io
import zipfile
import zlib

import pytest
from rows import rows
from pyspark.sql import functions as F

from tradewind.schema import ARRIVALS, CONTROL_COLUMNS, EXPORTS, IMPORTS
from tradewind.sources import archives, files, tables
from tradewind.sources import stage as stages


def import_line(code="0101210000", country="US", port="DOV", date="01/2009", value="100", q1="5"):
    f = [""] * 26
    f[0], f[6], f[7], f[9], f[23], f[24], f[25] = code, country, date, port, value, q1, "0"
    return "|".join(f)


def write(path, lines):
    path.write_text("\n".join(lines) + "\n")


def test_fact_files(spark, tmp_path):
    write(tmp_path / "SMKI190901", ["HEADER|x", import_line(), import_line(country="NA", q1="0"), "01012200|short", "TRAILER|2"])
    write(tmp_path / "SMKI190902", ["HEADER|x", import_line(code="02013000AB", date="02/2009"), "TRAILER|1"])
    df = files.read_fact_files(spark, str(tmp_path), IMPORTS)
    assert df.columns == ["file"] + files.safe_names(IMPORTS.columns)
    got = rows(df.select("comcode", "coo_alpha", "account_date", "value", "quantity_1"), "account_date", "quantity_1", "comcode")
    assert got == [("01012200", None, None, None, None), ("01012100", "NA", "01/2009", "100", "0"),
                   ("01012100", "US", "01/2009", "100", "5"), ("02013000", "US", "02/2009", "100", "5")]
    missing = files.read_fact_files(spark, str(tmp_path), IMPORTS, na_strings=["NA"])
    assert missing.where("coo_alpha = 'NA'").count() == 0 and missing.where("coo_alpha is null").count() == 2


@pytest.mark.parametrize("lines, left", [
    (["h", "a", "b", "t"], ["a", "b"]),
    (["h", "h", "a", "t", "t"], ["a", "h", "t"]),          # header and trailer texts occur as records too
    (["x", "x", "x"], ["x"]),                               # header and trailer alike
    (["x", "x"], []),
    (["only"], []),                                         # one record is header and trailer at once
    (["h", "t", "h", "a", "t", "h", "t"], ["a", "h", "h", "t", "t"]),
])
def test_only_first_and_last_go(spark, lines, left):
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)] + [("g", 0, "h"), ("g", 1, "a"), ("g", 2, "t")],
                               "file string, pos long, line string").repartition(3)
    out = files.drop_file_ends(df)
    assert sorted(r.line for r in out.where("file = 'f'").collect()) == left
    assert [r.line for r in out.where("file = 'g'").collect()] == ["a"]


def test_many_copies_of_a_header(spark):
    n = 120_001
    same = spark.range(n).select(F.lit("f").alias("file"), F.col("id").alias("pos"), F.lit("x").alias("line"))
    assert files.drop_file_ends(same).count() == n - 2


def test_split_files_keep_their_order(spark, tmp_path):
    body = [f"{i:05d}|" + "y" * 50 for i in range(4000)]
    write(tmp_path / "big", ["HEAD"] + body + ["TAIL"])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        lines = files.read_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 5
        left = files.drop_file_ends(lines)
        assert [r.line for r in left.orderBy("pos").collect()] == body
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_latin1_files(spark, tmp_path):
    (tmp_path / "f").write_bytes("H\nCAF\xc9|1\nT\n".encode("latin-1"))
    assert [r.line for r in files.drop_file_ends(files.read_lines(spark, str(tmp_path), "ISO-8859-1")).collect()] == ["CAFÉ|1"]


def test_control_files(spark, tmp_path):
    first = ["0101210000", *[" x "] * 25, "  HORSES "]
    split = ["0101300000", *["x"] * 25, "ASSES ", "AND 'MULES\""]
    odd = ["0102000000", *["x"] * 25, "CATTLE\x1a €"]
    write(tmp_path / "SMKA121101", ["HEAD", *["|".join(x) for x in (first, split, odd)], "TAIL"])
    df = files.read_control_files(spark, str(tmp_path))
    assert len(df.columns) == len(CONTROL_COLUMNS) + 2
    assert rows(df.select("mk_comcode", "mk_qty2_alpha", "mk_commodity_alpha_1"), "mk_comcode") == [
        ("01012100", "x", "HORSES"), ("01013000", "x", "ASSESAND 'MULES\""), ("01020000", "x", "CATTLE /")]


def test_cast_measures(spark):
    df = spark.createDataFrame([("a", "12", ""), ("b", "1x", "3"), ("c", None, "-4"), ("d", "5", "9.5"), ("e", "z", "y")],
                               "k string, value string, q string")
    good, rejects = files.cast_measures(df, ["value", "q"])
    assert rows(good, "k") == [("a", 12, None), ("c", None, -4)]
    assert dict(good.dtypes)["value"] == "bigint"
    assert [(r.k, r.rejected_columns) for r in rejects.orderBy("k").collect()] == [
        ("b", "value"), ("d", "q"), ("e", "value,q")]


def test_file_names(spark):
    raw = ["smke190901.txt", "SMKE19~1.TXT", "smka121405V2.txt", "SMKX461406v2", "SMKM461801"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "i int, x string")
    got = [r[0] for r in df.orderBy("i").select(files.normalise_file_name(F.col("x"))).collect()]
    assert got == ["SMKE190901", "SMKE190902", "SMKA121405", "SMKX461406", "SMKM461801"]


def test_archives(spark, tmp_path):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("smki190902.txt", "H\r\n" + import_line(date="02/2009") + "\r\nT\r\n")
    with zipfile.ZipFile(tmp_path / "SMKI19_2009archive.zip", "w") as z:
        z.writestr("SMKI190902.zip", inner.getvalue())
        z.writestr("months/SMKI190901.TXT", "\n".join(["H", *[import_line(value=str(i)) for i in range(250)], "T"]))
    lines = archives.expand_archives(spark, str(tmp_path / "*.zip"), batch=100)
    assert lines.where("file = 'SMKI190901'").count() == 252
    facts = files.parse_fact_lines(files.drop_file_ends(lines), IMPORTS)
    assert rows(facts.groupBy("file").count(), "file") == [("SMKI190901", 250), ("SMKI190902", 1)]
    assert facts.where("file = 'SMKI190902'").first().account_date == "02/2009"


def test_layouts():
    assert [len(x) for x in (ARRIVALS.columns, EXPORTS.columns, IMPORTS.columns, CONTROL_COLUMNS)] == [17, 22, 26, 27]
    for shape in (ARRIVALS, EXPORTS, IMPORTS):
        names = files.safe_names(shape.columns)
        assert {shape.code, shape.country, shape.period, *shape.integers, *[c for _, c in shape.measures]} <= set(names)


def test_code_lists(spark, tmp_path):
    nomen = tmp_path / "cn.csv"
    nomen.write_text('Order;Level;Code_1;Code_2;Parent_1;Parent_2;Unit;Description\n'
                     '1;1;I;;;;;SECTION I - LIVE ANIMALS\n2;2;01;;I;;;"CHAPTER 1; LIVE ANIMALS"\n'
                     '3;3;0101 21 00;;0101 21;;;Horses\n4;4;;;;;;note\n')
    assert [tuple(r)[1:] for r in tables.read_nomenclature(spark, str(nomen)).orderBy("line_no").collect()] == [
        ("I", None, "SECTION I - LIVE ANIMALS"), ("01", "I", "CHAPTER 1; LIVE ANIMALS"), ("01012100", "010121", "Horses")]

    for n, body in enumerate(['"","GB","DVR","","Dover","","","","","","5107N 00119E",""\n"","FR","CQF","","Calais","","","","","","5057N 00150E",""\n',
                              '"","GB","XXX","","Nowhere","","","","","","",""\n']):
        (tmp_path / f"2017 CodeListPart{n}.csv").write_text(body)
    got = rows(tables.read_locode(spark, str(tmp_path / "*CodeList*.csv")))
    assert [(c, n, round(a, 4), round(b, 4)) for c, n, a, b in got] == [("DVR", "Dover", 51.1167, 1.3167)]

    ports = tmp_path / "ports.csv"
    ports.write_text('portname.x,portcode,type,lat,long\nMoleshill,MLS,Airport,NA,NA\n"Baltic Wharf, Rochford",LON,Seaport,51.37,0.45\n')
    assert rows(tables.read_missing_ports(spark, str(ports)), "portcode") == [
        ("Baltic Wharf, Rochford", "LON", "Seaport", 51.37, 0.45), ("Moleshill", "MLS", "Airport", None, None)]

    sheet = tmp_path / "airports.csv"
    sheet.write_text("Airport codes,\nAberdeen Airport,ABZ\n,\nBristol Airport,BRS\n")
    assert rows(tables.read_code_list(spark, str(sheet), type_="Airport"), "portcode") == [
        ("Aberdeen Airport", "ABZ", "Airport"), ("Bristol Airport", "BRS", "Airport")]


def test_file_ends_after_blank_lines_and_sub(spark):
    rows = []
    for name, tail in (("a", [""]), ("b", ["\r"]), ("c", ["\x1a"]), ("d", [])):
        rows += [(name, i, x) for i, x in enumerate(["HEADER", "a", "b", "TRAILER\x1a" if name == "d" else "TRAILER", *tail])]
    rows += [("e", 0, "ONLY")]
    left = files.drop_file_ends(spark.createDataFrame(rows, "file string, pos long, line string")).collect()
    assert sorted((r.file, r.line) for r in left) == [(f, x) for f in "abcd" for x in "ab"]


def test_file_ends_of_archives_with_one_name(spark):
    rows = [(a, "F", i, x) for a in "xy" for i, x in enumerate([f"H{a}", f"{a}1", f"T{a}"])]
    left = files.drop_file_ends(spark.createDataFrame(rows, "archive string, file string, pos long, line string"))
    assert sorted(r.line for r in left.collect()) == ["x1", "y1"]


def zipped(*members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in members:
            z.writestr(name, content)
    return out.getvalue()


def test_members_have_tasks_of_their_own(spark, tmp_path):
    months = [(f"SMKI19090{m}.txt", "\n".join(["H", *[import_line(value=str(m))] * m, "T"])) for m in range(1, 9)]
    (tmp_path / "flat.zip").write_bytes(zipped(*months))
    (tmp_path / "deep.zip").write_bytes(zipped(*[(f"{n}.ZIP", zipped((n.replace("0901", "0909"), t))) for n, t in months], ("two.zip", zipped(*months[:2]))))
    paths = spark.read.format("binaryFile").load(str(tmp_path)).select("path")
    index = archives.archive_index(paths)
    assert index.where("size(chain) = 1").count() == 8 and index.where("size(chain) = 2").count() == 10
    dealt = index.repartitionByRange(18, "archive", "chain").mapInPandas(archives._unpack(archives.open_path, "latin-1", 100), archives._LINES)
    assert dealt.select(F.spark_partition_id().alias("p")).distinct().count() > 12
    lines, members = archives.read_members(paths)
    assert members.where("error IS NULL").count() == 18
    assert rows(lines.where("archive LIKE '%flat.zip'").groupBy("file").count(), "file") == [(f"SMKI19090{m}", m + 2) for m in range(1, 9)]
    assert files.fact_records(lines, IMPORTS).count() == 2 * 36 + 3


def test_damaged_members_are_set_aside(spark, tmp_path):
    body = "\n".join(["H", *[import_line(value=str(i * 7919 % 1000)) for i in range(3000)], "T"])
    good = zipped(("SMKI190901", body), ("notes/", ""))
    broken = bytearray(zipped(("SMKI190902", body), ("SMKI190903", body)))
    broken[200] ^= 0xFF                                    # inside the first member
    (tmp_path / "good.zip").write_bytes(good)
    (tmp_path / "half.zip").write_bytes(bytes(broken))
    (tmp_path / "cut.zip").write_bytes(good[: len(good) // 2])
    (tmp_path / "empty.zip").write_bytes(b"PK")
    (tmp_path / "deep.zip").write_bytes(zipped(("SMKI190904.zip", good[:500]), ("SMKI190905V2.txt", body), ("latin", "H\nCAF\xc9\nT".encode("latin-1"))))
    lines, members = archives.read_members(spark.read.format("binaryFile").load(str(tmp_path)).select("path"), encoding="UTF-8")
    found = {(r.archive.rsplit("/", 1)[-1], r.file): r.error and r.error.split(":")[0] for r in members.collect()}
    assert found == {("good.zip", "SMKI190901"): None, ("half.zip", "SMKI190902"): found["half.zip", "SMKI190902"], ("half.zip", "SMKI190903"): None,
                     ("cut.zip", None): "BadZipFile", ("empty.zip", None): "BadZipFile", ("deep.zip", "SMKI190904.ZIP"): "BadZipFile",
                     ("deep.zip", "SMKI190905"): None, ("deep.zip", "LATIN"): "UnicodeDecodeError"}
    assert found["half.zip", "SMKI190902"] in ("error", "BadZipFile", "EOFError")
    assert rows(lines.groupBy("file", "issue").count(), "file") == [("SMKI190901", 1, 3002), ("SMKI190903", 1, 3002), ("SMKI190905", 2, 3002)]


def test_no_archives(spark):
    none = spark.createDataFrame([], "path string")
    lines, members = archives.read_members(none)
    assert lines.count() == 0 and members.count() == 0


@pytest.mark.parametrize("nested", [False, True])
def test_archives_there_and_back(spark, tmp_path, nested):
    texts = spark.createDataFrame([(a, f"F{f}.txt", i, f"{a}{f}{i} é") for a in ("x.zip", "y.zip") for f in range(3) for i in range(4)],
                                  "archive string, file string, pos long, line string").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # tasks without archives, too
    paths = archives.write_archives(texts, f"file://{tmp_path}/out", nested)
    lines, members = archives.read_members(paths.unionByName(paths.limit(0)).repartition(9), encoding="UTF-8")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert members.count() == 6 and sorted(r.line for r in lines.collect()) == sorted(r.line for r in texts.collect())


@pytest.mark.parametrize("nested", [False, True])
def test_archive_is_written_by_many_tasks(spark, tmp_path, nested):
    """Findings 1 and 2: one task wrote a whole archive."""
    made = spark.range(900).selectExpr("'x.zip' AS archive", "if(id < 800, 'A.txt', 'B.txt') AS file", "id AS pos", "concat('é', id * 7919) AS line")
    mark = stages.staged_so_far()
    archives.write_archives(made.orderBy(F.rand(1)), f"file://{tmp_path}", nested, piece_lines=100)
    pieces = spark.read.parquet(next(x for x in stages.staged_since(mark) if "/pieces-" in x))
    assert pieces.where("file = 'A.txt'").select("pos").distinct().count() > 4
    with zipfile.ZipFile(tmp_path / "x.zip") as z:
        assert z.testzip() is None and z.namelist() == (["A.zip", "B.zip"] if nested else ["A.txt", "B.txt"])
        found = [z.read(n) for n in z.namelist()]
    if nested:
        found = [zipfile.ZipFile(io.BytesIO(x)) for x in found]
        assert [x.testzip() for x in found] == [None, None] and [x.namelist() for x in found] == [["A.txt"], ["B.txt"]]
        found = [x.read(x.namelist()[0]) for x in found]
    lines = [f"é{i * 7919}\n" for i in range(900)]
    assert [x.decode() for x in found] == ["".join(lines[:800]), "".join(lines[800:])]


def test_joined_checksums():
    for a, b in ((b"", b""), (b"a", b""), (b"", b"b"), (b"tradewind", b"\x00" * 70000), (bytes(range(256)), b"xyz")):
        assert archives.crc_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_lines_of_members_are_not_shuffled(spark, tmp_path, monkeypatch):
    """Lines met their members in a join that moved all of them; and lines across the ends of what is read at once."""
    monkeypatch.setattr(archives, "_READ", 3)
    (tmp_path / "a.zip").write_bytes(zipped(("SMKI190901", "é\r\r\n\n long ünd longer\nx\ry\nlast"), ("SMKI190902", ""), ("SMKI190903", "\n")))
    lines, members = archives.read_members(spark.read.format("binaryFile").load(str(tmp_path)).select("path"), encoding="UTF-8", batch=2)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning(source" not in plan
    assert rows(lines.select("file", "pos", "line"), "file", "pos") == [
        ("SMKI190901", 0, "é"), ("SMKI190901", 1, ""), ("SMKI190901", 2, " long ünd longer"), ("SMKI190901", 3, "x\ry"), ("SMKI190901", 4, "last"),
        ("SMKI190903", 0, "")]
    assert members.where("error IS NULL").count() == 3


def test_file_issues(spark):
    df = spark.createDataFrame([("SMKE191405V2.TXT", 2), ("smke191406v3", 3), ("SMKE191405", 1), ("SMKV2191405", 1), ("v2.txt", 2)], "x string, n int")
    assert df.where(files.file_issue(F.col("x")) != F.col("n")).count() == 0


def test_text_is_scanned_once(spark, tmp_path):
    write(tmp_path / "SMKI190901", ["H", import_line(), "T"])
    lines = files.read_lines(spark, str(tmp_path))
    plan = files.fact_records(lines, IMPORTS)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and files.fact_records(lines, IMPORTS).count() == 1
