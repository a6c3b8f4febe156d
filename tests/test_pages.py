from pyspark.sql import functions as F

from strataframe.operators import pages as P


def messages(spark, *contents):
    rows = [([("system", "s"), ("user", c)],) for c in contents]
    return spark.createDataFrame(rows, "m array<struct<role:string,content:string>>")


def test_offline_answers(spark):
    got = [r[0] for r in messages(spark, "[1] a\n[2] b\n[3] c", "[1] a\n[2] b\n[3] c", "none", "[7] x [50] y").select(P.offline_answer(F.col("m"))).collect()]
    assert got[0] == got[1]
    one, two = got[0].split("\n\n")
    assert one.endswith("[^ev-1][^ev-2]") and two.endswith("[^ev-3][^ev-1]")
    assert got[2].count("[^ev-1]") == 2 and "[^ev-2]" not in got[2]
    assert got[3].split("\n\n")[1].endswith("[^ev-3][^ev-4]")
    assert messages(spark, "x").select(P.offline_answer(F.col("m"), 1)).first()[0] != messages(spark, "x").select(P.offline_answer(F.col("m"), 2)).first()[0]


def test_pages(spark):
    t = spark.createDataFrame([("s", "T")], "slug string, title string")
    e = spark.createDataFrame([("s", 1, "d1", "sec-1", "One", 4), ("s", 2, "d2", "sec-2", "Two", None)], "slug string, ev_no int, doc_id string, anchor string, section_title string, page_start int")
    r = spark.createDataFrame([("s", "a[^ev-2] b[^ev-1][^ev-9]")], "slug string, body string")
    p = P.pages(t, e, r, 1).first()
    assert (p.n_pins, p.n_unresolved) == (3, 1)
    assert p.markdown == "# T\n\n> Slug: `s` · Evidence sources: 2\n\na[^ev-2] b[^ev-1][^ev-9]\n\n[^ev-1]: [One (p.4)](../../kb/d1/main.md#sec-1)\n[^ev-2]: [Two](../../kb/d2/main.md#sec-2)\n[^ev-9]: (UNRESOLVED — evidence index 9 out of range)\n"


def test_items(spark):
    raw = spark.createDataFrame([("a", "T", " ", "x  y\nz", " w ", None, "5", None, "y z"), ("b", "T", "C", "x", None, "h", None, "d", "not there"), ("c", "T", "C", "a.b", None, None, None, None, "a+b")], "anchor string, section_title string, section_category string, body string, what string, how string, sample_size string, source_document string, quote string")
    a, b, c = P.coerced_items(raw).orderBy("evidence_ref").collect()
    assert (a.category, a.what, a.how, a.sample_size, a.evidence_quote) == ("Uncategorized", "w", P.DEFAULT_HOW, "5", "y\nz")
    assert (b.evidence_quote, b.how, b.source_document, c.evidence_quote) == ("", "h", "d", "")


def test_clients(spark):
    df = messages(spark, "x", "bad").select(F.sha2(F.col("m")[1]["content"], 256).alias("prompt_hash"), F.col("m").alias("messages"))

    def client(ms):
        if ms[1]["content"] == "bad":
            raise ValueError("no")
        return ms[0]["role"] + ms[1]["content"]

    got = sorted((r.response or "", r.error or "") for r in P.asked(df, client, 2).collect())
    assert got == [("", "ValueError('no')"), ("systemx", "")]
    have = spark.createDataFrame([(df.first().prompt_hash, "r")], "prompt_hash string, response string")
    assert P.missing(df, have).count() == 1 and P.answers(df, have).filter("response is null").count() == 1


def test_filters(spark):
    df = spark.createDataFrame([("abc", "assets/Logo_1.png", ""), ("x", "a/b.png", "Company MARK"), ("y", "a/c.png", None)], "sha string, path string, alt string")
    hit = P.is_logo(F.col("sha"), F.col("path"), F.col("alt"), ["zz"], ["logo_*"], ["*mark*"])
    assert [r[0] for r in df.select(hit).collect()] == [True, True, False]
    w = spark.createDataFrame([("pdf.scanned_page:p3",), ("pdf.scanned_page:p3 x",), ("odd",)], "warning string")
    assert P.unknown_warnings(w).count() == 2
    t = spark.createDataFrame([("a\n![x](assets/l.png)\nb", ["assets/l.png"])], "t string, p array<string>")
    assert t.select(P.without_lines(F.col("t"), F.col("p"))).first()[0] == "a\nb"
    assert spark.range(1).select(P.yaml_scalar(F.lit("a: b")), P.yaml_scalar(F.lit("ab"))).first() == ('"a: b"', "ab")
