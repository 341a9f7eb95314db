"""Archives as sources: nested members, broken ones, pruned columns."""

import gzip
import io
import tarfile
import zipfile

import pytest

from cargolens.sources import archives, scan

HEADER = ["Bill", "Vessel Name", "Note"]
A = 'x,y,z\n1,"EVER, ""GIVEN""",first\n2,,"two\nlines"\n3,??,\n'
B = "x,y,z\n4,b,n\n5,too,many,fields\n6,c,n\n"


@pytest.fixture
def folder(tmp_path):
    at = tmp_path / "raw" / "us"
    at.mkdir(parents=True)
    with zipfile.ZipFile(at / "201801.US.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("deep/er/a.csv", A)
        z.writestr("readme.txt", B)
        z.writestr("empty.csv", "")
        z.writestr("header.csv", "x,y,z\n")
    with tarfile.open(at / "201802(A).US.tar.gz", "w:gz") as t:
        for name, text in (("in/b.csv", B), ("c.txt", A)):
            info = tarfile.TarInfo(name)
            info.size = len(text.encode())
            t.addfile(info, io.BytesIO(text.encode()))
    return at


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_members_of_zip_and_tar(spark, folder):
    found = archives.unpacked(archives.files(spark, str(folder)), HEADER)
    assert {r["member"] for r in found.collect()} == {"deep/er/a.csv", "in/b.csv"}
    assert rows(found.select(*HEADER)) == [("1", 'EVER, "GIVEN"', "first"), ("2", None, "two\nlines"), ("3", "??", None), ("4", "b", "n"), ("6", "c", "n")]
    assert rows(archives.unpacked(archives.files(spark, str(folder), "*.zip"), HEADER, ["Note"]).select("Note")) == [("first",), ("two\nlines",), (None,)]


def test_manifests(spark, folder):
    got = scan.read_archived_manifests(archives.files(spark, str(folder)), HEADER, ["Bill", "Vessel Name"])
    assert got.columns == ["bill", "vessel_name", "report_month", "country_imp"]
    assert [tuple(map(str, r)) for r in rows(got)] == [("1", 'EVER, "GIVEN"', "2018-01-01", "US"), ("2", "None", "2018-01-01", "US"), ("3", "None", "2018-01-01", "US"), ("4", "b", "2018-02-01", "US"), ("6", "c", "2018-02-01", "US")]


def test_broken_members_and_archives(spark, folder):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as z:
        z.writestr("good.csv", "x,y,z\n7,g,g\n")
        z.writestr("bad.csv", "x,y,z\n8,bad,bad\n")
    (folder / "201803.zip").write_bytes(raw.getvalue().replace(b"8,bad", b"8,BAD", 1))
    (folder / "201804.tar.gz").write_bytes(gzip.compress(b"no tar at all")[:-6])
    (folder / "201805.zip").write_bytes(b"nothing")
    all_files = archives.files(spark, str(folder), "20180[345]*")
    assert rows(archives.unpacked(all_files, HEADER, broken="skip").select(*HEADER)) == [("7", "g", "g")]
    with pytest.raises(Exception, match="BadZipFile|Bad CRC|ReadError|tar"):
        archives.unpacked(all_files, HEADER).collect()
    with pytest.raises(ValueError):
        archives.unpacked(all_files, HEADER, broken="no")


def test_blocks_smaller_than_a_member(spark, tmp_path, monkeypatch):
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("big.csv", "x,y,z\n" + "".join(f"{i},v{i},n\n" for i in range(300_000)))
    found = archives.unpacked(archives.files(spark, str(tmp_path)), HEADER, ["Bill"])
    assert found.selectExpr("sum(cast(Bill as long)) as s", "count(*) as n").first() == (299_999 * 150_000, 300_000)
