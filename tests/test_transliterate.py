import unicodedata

from pyspark.sql import functions as F

from cargolens.functions.transliterate import ascii_text
from cargolens.operators import matching as M


def spelt(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    return [r["x"] for r in df.select("i", ascii_text(F.col("t")).alias("x")).orderBy("i").collect()]


def test_names_of_many_scripts(spark):
    want = {
        "Щербаков и Жуковский": "Shcherbakov i Zhukovskii", "Київ": "Kiyiv", "Ψαρός Ξένιος": "Psaros Ksenios", "Straße Łódź Ærø": "Strasse Lodz Aero",
        "サッポロ": "SAPPORO", "しゃしん": "SHASHIN", "きょうと": "KYOUTO", "マッチ": "MATCHI", "ｶﾅ": "KANA", "한국 주식회사": "HANGUG JUSIGHOESA",
        "ＡＢＣ①ﬁ": "ABC1fi", "漢字 Co": " Co", "école": "ecole", "O’Neil": "O'Neil", "𝐀𝟏": "A1", "plain ~ 1": "plain ~ 1", "": "", None: None, "っ": "", "ゃ": "YA",
    }
    assert dict(zip(want, spelt(spark, list(want)), strict=True)) == want


def test_every_syllable_and_decomposition(spark):
    hangul = [chr(c) for c in range(0xAC00, 0xD7A4)]
    assert spelt(spark, hangul) == [unicodedata.name(c).split(" ")[-1] for c in hangul]
    latin = [chr(c) for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))]
    plain = [unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode() for c in latin]
    assert all(got == p for got, p in zip(spelt(spark, latin), plain, strict=True) if p)


def test_one_company_in_four_scripts(spark):
    rows = [("КОНТРОЛ МЕТАЛ ГРУП", "a"), ("KONTROL METAL GRUP", "b"), ("ΚΟΝΤΡΟΛ ΜΕΤΑΛ ΓΡΟΥΠ", "c"), ("한국무역진흥공사", "d"), ("HANGUGMUYEOGJINHEUNGGONGSA", "e"), ("ヨコハマトレーディング", "f"), ("YOKOHAMATOREDEINGU", "g")]
    got = M.group_companies(spark.createDataFrame(rows, "name string, address string").withColumn("raw", F.col("name")), "name", "address").collect()
    names = {}
    for r in got:
        names.setdefault(r["name"], set()).add(r["raw"])
    assert {frozenset(v) for v in names.values()} >= {frozenset({"한국무역진흥공사", "HANGUGMUYEOGJINHEUNGGONGSA"})}
    assert any({"КОНТРОЛ МЕТАЛ ГРУП", "KONTROL METAL GRUP"} <= v for v in names.values())
