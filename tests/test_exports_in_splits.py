"""CSV exports in splits: quoted line breaks, encodings, quarantine."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from pulsekit.sources import exports

ALL = lambda name: ~name.startswith(".")


def in_splits(spark, root, n_bytes, **kw):
    """Records and splits as they come with splits of ``n_bytes``."""
    keys = {"spark.sql.files.maxPartitionBytes": str(n_bytes), "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        records, files = exports.csv_records(spark, root, accept=ALL, **kw)
        rows = sorted((r["uri"].rsplit("/", 1)[1], r["position"], r["text"], r["closed"]) for r in records.collect())
        n = exports._text_lines(spark, root).select("uri", "block").distinct().count()
        return rows, n, {r["uri"].rsplit("/", 1)[1]: r["encoding"] for r in files.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def table(rng, n):
    def cell():
        kind = rng.randrange(8)
        if kind < 3:
            return f"plain {rng.randrange(10 ** 6)}"
        if kind == 3:
            return 'two "words", and\na line\r\n\nmore, "x'
        if kind == 4:
            return "\n" * rng.randrange(1, 30) + "," * rng.randrange(4)
        if kind == 5:
            return '"' * rng.randrange(1, 5)
        return "" if kind == 6 else "서울, été\nΧαρά"
    return [["id", "a", "b,\"c", "d"]] + [[str(i), cell(), cell(), cell()] for i in range(n)]


def written(rows, end="\r\n"):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_a_file_in_many_splits_equals_the_whole(spark, tmp_path, end):
    rows = table(random.Random(3), 1500)
    (tmp_path / "big.csv").write_bytes(written(rows, end).encode())
    size = (tmp_path / "big.csv").stat().st_size
    many, n, _ = in_splits(spark, str(tmp_path), size // 16)
    one, m, _ = in_splits(spark, str(tmp_path), 1 << 30)
    assert n >= 16 and m == 1
    assert [r[2:] for r in many] == [r[2:] for r in one] and all(r[3] for r in one)
    cell = (lambda c: c.replace("\r\n", "\n")) if end == "\r\n" else str      # as Spark's reader does
    assert [next(csv.reader(io.StringIO(r[2], newline=""))) for r in many] == [[cell(c) for c in row] for row in rows]
    # as Spark's own reader sees the file in one task
    frames, bad = exports.csv_frames(spark, str(tmp_path), accept=ALL)
    (line, got), = frames
    own = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path))
    names = own.columns
    assert sorted(map(str, got.select(*[F.col(f"`{c}`") for c in names]).collect())) == sorted(map(str, own.collect())) and bad.count() == 0


def test_records_larger_than_splits(spark, tmp_path):
    rows = [["id", "text"], ["1", "x\n" * 5000], ["2", "short"], ["3", '"\n,' * 3000], ["4", "end"]]
    (tmp_path / "long.csv").write_bytes(written(rows, "\n").encode())
    got, n, _ = in_splits(spark, str(tmp_path), 700)
    assert n > 16 and [next(csv.reader(io.StringIO(r[2], newline=""))) for r in got] == rows


def test_states_of_lines():
    cases = {b"a,b": (0, 1), b'"a': (1, 0), b'a"b,c': (0, 0), b'"a""b",c': (0, 0), b'"a","b': (1, 0), b'5" screen,"x': (1, 0), b'""': (0, 1), b'"': (1, 0),
             b'"a"b"c,d': (0, 0), b'""",': (1, 0), b',"",': (0, 1), b"": (0, 1), b'x,"': (1, 0), b'","': (0, 0)}
    for line, want in cases.items():
        brute = []
        for inside in (False, True):
            field = inside                      # inside a quoted field
            start, closed, i = not inside, False, 0
            while i < len(line):
                c = line[i:i + 1]
                if field:
                    if c == b'"':
                        if line[i + 1:i + 2] == b'"':
                            i += 1
                        else:
                            field, start, closed = False, False, True
                elif c == b",":
                    start = True
                    i += 1
                    continue
                elif start and c == b'"':
                    field = True
                start = False
                i += 1
            brute.append(field)
        got = (exports.ends_inside(line, False), exports.ends_inside(line, True))
        assert got == tuple(brute), line


def test_stray_quotes_and_lone_ends(spark, tmp_path):
    text = 'id,t\n1,5" screen\n\n2,"a\n\nb" tail\r\n\r\n3,\n4,"never ends\n5,x\n'
    (tmp_path / "a.csv").write_bytes(text.encode())
    for n in (6, 13, 1 << 20):
        got, _, _ = in_splits(spark, str(tmp_path), n)
        assert [r[2:] for r in got] == [("id,t", True), ('1,5" screen', True), ('2,"a\n\nb" tail', True), ("3,", True), ('4,"never ends\n5,x', False)]


def test_legacy_encodings_are_read_in_splits(spark, tmp_path):
    rows = [["제목", "좋아요"]] + [[f"서울\n여행 {i}", str(i)] for i in range(400)]
    (tmp_path / "kr.csv").write_bytes(written(rows).encode("cp949"))
    (tmp_path / "fr.csv").write_bytes("nom,n\nété,1\n\xff\xfe,2\n".encode("latin-1"))
    (tmp_path / "u16.csv").write_bytes(written(rows[:9]).encode("utf-16"))
    (tmp_path / "mark.csv").write_bytes(b"\xef\xbb\xbf" + written(rows[:3]).encode())
    got, n, encodings = in_splits(spark, str(tmp_path), 500)
    assert n > 16 and encodings == {"kr.csv": "cp949", "fr.csv": "latin-1", "u16.csv": "utf-16", "mark.csv": "utf-8"}
    cells = lambda name: [next(csv.reader(io.StringIO(r[2], newline=""))) for r in got if r[0] == name]
    assert cells("kr.csv") == rows and cells("u16.csv") == rows[:9] and cells("mark.csv") == rows[:3]
    assert cells("fr.csv") == [["nom", "n"], ["été", "1"], ["ÿþ", "2"]]


def test_what_cannot_be_read_goes_to_quarantine(spark, tmp_path):
    root, store = tmp_path / "in", str(tmp_path / "quarantine")
    root.mkdir()
    hdr = "Post ID,Description,Reach,Likes\n"
    (root / "a.csv").write_text(hdr + "1,good,10,2\n2,too,many,cells,here\n3,few\n4,\"open,1,1\n")
    (root / "b.json").write_text('{"post_id": "9", ')
    (root / "c.json").write_text('[{"post_id": "8", "likes": 3}]')
    (root / "template.csv").write_text(hdr + "7,not an export,1,1,1,1\n")
    got = {r["post_id"]: r["likes"] for r in exports.ingest_platform(spark, str(root), "instagram", quarantine=store).collect()}
    assert got == {"1": 2, "3": 0, "8": 3}
    bad = {(r["source_file"].rsplit("/", 1)[1], r["reason"]): r["record"] for r in spark.read.parquet(store).collect()}
    assert bad.keys() == {("a.csv", "more cells than the header"), ("a.csv", "a quoted field has no end"), ("b.json", "JSON does not parse")}
    assert bad["a.csv", "more cells than the header"] == "2,too,many,cells,here" and bad["a.csv", "a quoted field has no end"] == '4,"open,1,1'


def test_empty_folders_and_files(spark, tmp_path):
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "blank.csv").write_bytes(b"\n\r\n\n")
    assert exports.ingest_platform(spark, str(tmp_path), "instagram") is None


@pytest.mark.parametrize("enc", ["utf-8", "utf-8-sig", "utf-16", "cp1253"])
def test_series_files_in_every_encoding(spark, tmp_path, enc):
    (tmp_path / "Overview.csv").write_bytes('"Date","Video Views","Likes"\n"1 Μαρτίου","5","2"\n"2 Μαρτίου","x","3"\n'.encode(enc))
    got = exports.tiktok_series(spark, str(tmp_path / "Overview.csv"), "2026-03-10", {"views": ["video views"], "likes": ["likes"]})
    assert sorted((str(r["date"]), r["metric"], r["value"]) for r in got.collect()) == [
        ("2026-03-01", "likes", 2), ("2026-03-01", "views", 5), ("2026-03-02", "likes", 3), ("2026-03-02", "views", 0)]


def test_only_utf16_files_are_read_whole(spark, tmp_path):
    (tmp_path / "plain.csv").write_text('id,v\n1,"a\nb"\n2,c\n', encoding="utf-8")
    records, _ = exports.csv_records(spark, str(tmp_path))
    assert "binaryFile" not in records._jdf.queryExecution().toString() and records.count() == 3
    for name in ("wide [1] ü 50%25.csv", "wide 1 ü 50%25.csv", "wi*{a}?.csv"):
        (tmp_path / name).write_text(f'id,v\n3,"é\nb"\n', encoding="utf-16")
    records, files = exports.csv_records(spark, str(tmp_path))
    assert records.count() == 9 and records.where("position > 0").select("uri").distinct().count() == 4
    assert files.where("encoding = 'utf-16' AND first = 'id,v'").count() == 3
