"""Files, mails, providers, streams, pipelines and the SQL surface."""

import io
import zipfile

from pyspark.sql import functions as F

from leafmill.sources import files, providers
from leafmill.streaming import incremental as I

A = 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"'
W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def archive(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


PPTX = archive({"ppt/slides/slide1.xml": f"<s {A}><a:p><a:r><a:t>Next steps</a:t></a:r></a:p><a:p><a:r><a:t>Do it</a:t></a:r></a:p><a:tbl><a:tr><a:tc><a:p><a:t>c</a:t></a:p></a:tc></a:tr></a:tbl></s>", "ppt/slides/slide10.xml": f"<s {A}/>"})
DOCX = archive({"word/document.xml": f'<d {W}><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>Top</w:t></w:r></w:p><w:p/></d>'})


def test_office_files():
    assert files.pptx_slides(PPTX) == [(1, "Next steps", ["Next steps", "Do it"], [[["c"]]], ""), (2, "", [], [], "")]
    assert files.docx_paragraphs(DOCX) == [(0, "Heading1", "Top")]
    assert files.pptx_slides(b"not a deck") == [] and files.docx_paragraphs(b"") == [] and files.xlsx_rows(b"x") == []
    assert files.active_content(archive({"ppt/vbaProject.bin": "x"})) is True and files.active_content(b"") is None


def test_scan_has_a_size_gate(spark, tmp_path):
    (tmp_path / "a.pptx").write_bytes(PPTX)
    (tmp_path / "b.pptx").write_bytes(b"x" * 5000)
    found = files.scan(spark, str(tmp_path), ("pptx",), most_bytes=4000)
    assert [r.name for r in found.collect()] == ["a.pptx"]
    assert files.slides(found).count() == 2


MAIL = b"Message-ID: <1>\r\nFrom: Ann Lee <ann@x.example>\r\nTo: b@x.example\r\nSubject: Re: Plan\r\nDate: Mon, 01 Jan 2024 10:00:00 +0000\r\n\r\nHello\r\n"


def test_mail_source_batch_and_stream(spark, tmp_path):
    files.register(spark)
    (tmp_path / "1.eml").write_bytes(MAIL)
    row = spark.read.format("mail").load(str(tmp_path)).first()
    assert (row.subject, row.sender_email, row.to, row.body.strip()) == ("Re: Plan", "ann@x.example", ["b@x.example"], "Hello")
    q = spark.readStream.format("mail").load(str(tmp_path)).writeStream.format("memory").queryName("mails").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select count(*) n from mails").first().n == 1


def test_budget_is_planned(spark):
    df = spark.createDataFrame([("d", i, f"q{i}") for i in range(5)], "d string, i int, q string")
    out = providers.ask(df, providers.OfflineProvider(), "k", "q", "d", F.col("i"), 2).orderBy("i").collect()
    assert [r.status for r in out] == ["unavailable"] * 2 + ["over budget"] * 3


def test_retry_gives_up_with_null():
    class Failing:
        calls = 0

        def call(self, kind, requests):
            Failing.calls += 1
            raise TimeoutError

    assert providers.RetryingProvider(Failing(), 3, 0).call("k", ["a"]) == [None] and Failing.calls == 3


def test_changed_groups(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, g string")
    assert sorted(r.id for r in I.changed_groups(rows, rows.filter("id <> 2"), "id", "g").collect()) == [1, 2]


def test_history_stream(spark, tmp_path):
    source = spark.createDataFrame([("p", "phone", "2024-01-01 00:00:00", "1"), ("p", "phone", "2024-01-03 00:00:00", "2"), ("p", "phone", "2024-01-02 00:00:00", "")], "k string, f string, at string, v string").withColumn("at", F.col("at").cast("timestamp"))
    source.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(source.schema).parquet(str(tmp_path / "in"))
    q = I.history(stream, "k", "f", "at", "v").writeStream.format("memory").queryName("log").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert [(r.old, r.new) for r in spark.sql("select * from log").collect()] == [("1", "2")]


def test_history_forgets_what_is_older_than_the_delay(spark, tmp_path):
    def put(name, rows):
        df = spark.createDataFrame(rows, "k string, f string, at string, v string").withColumn("at", F.col("at").cast("timestamp"))
        df.write.mode("append").parquet(str(tmp_path / "in"))
        return df.schema

    schema = put("a", [("p", "phone", f"2020-01-{i:02} 00:00:00", str(i)) for i in range(1, 20)] + [("q", "phone", "2024-01-01 00:00:00", "9")])
    made = I.history(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "k", "f", "at", "v", delay="10 days")

    def run():
        q = made.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).outputMode("append").start()
        q.processAllAvailable()
        q.stop()

    run()
    # The last value before the mark is still known; those before it aren't.
    put("b", [("p", "phone", "2024-01-02 00:00:00", "20")])
    run()
    put("c", [("p", "phone", "2020-01-05 12:00:00", "x"), ("p", "phone", "2024-01-03 00:00:00", "21")])
    run()
    got = sorted((r.old, r.new) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert ("19", "20") in got and ("20", "21") in got and not any("x" in pair for pair in got) and len(got) == 20


def test_regroup_replaces_whole_groups(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, g string")
    rows.write.parquet(str(tmp_path / "in"))
    seen = []
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")).filter("id = 2")
    q = I.regroup(stream, lambda: rows, "g", lambda df, n: seen.append(sorted(r.id for r in df.collect()))).option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert seen == [[1, 2]]


def test_pipelines(spark):
    from leafmill.plans import pipelines as P

    body = "A study of long things in cells\nAnn Lee, Bob Ray\nAbstract\n" + "We looked at many cells. " * 12 + "\nMethods\n" + "We counted them. " * 10 + "\nResults\n" + "There were many. " * 10
    pages = spark.createDataFrame([("d", 0, body), ("d", 1, None), ("e", 0, "")], "doc string, n int, t string")
    paper = P.papers(pages, "doc", "n", "t").collect()
    assert len(paper) == 1 and paper[0].title.startswith("A study of long things") and paper[0].authors == ["Ann Lee", "Bob Ray"]
    assert "## Methods" in paper[0].markdown and paper[0].file.startswith("Lee_unknown_study")
    patent = P.patents(spark.createDataFrame([("p", 0, "WO 2020/123456\n1. A compound of x.\n2. The method of claim 1 with AB-1234.")], "doc string, n int, t string"), "doc", "n", "t").first()
    assert (patent.number, patent.claims, patent.independent, patent.trees) == ("WO2020123456A1", 2, 1, 1)
    slides = spark.createDataFrame([("k", i, ["compound assay", "Footer Ltd"], "T") for i in range(4)], "doc string, n int, b array<string>, t string")
    deck = P.decks(slides, "doc", "n", "b", "t").first()
    assert deck.slides == 4 and deck.text is None
    assert P.reports(spark.createDataFrame([("r", "Notes-June-2025.pdf", "para\n\nPage 1 of 2")], "i string, f string, t string"), "i", "f", "t").first().chunk == "para"


def test_mail_threads_and_contacts(spark):
    from leafmill.plans import pipelines as P

    schema = "entry_id string, subject string, sender_name string, sender_email string, received timestamp, body string, html_body string, thread_id string"
    import datetime

    at = lambda d: datetime.datetime(2024, 1, d)
    rows = [("1", "Plan", "Ann Lee", "a@x.example", at(1), "Hi, this is the plan\nBest regards\nAnn Lee\nPhone: +49 111 222", None, ""), ("2", "RE: plan", "Ann Lee", "a@x.example", at(2), None, "<p>Yes &amp; no</p>", None), ("3", "Re: Plan", "Ann Lee", "a@x.example", at(3), "Ok, that is fine now\nBest regards\nAnn\nPhone: +49 999 222", "", "")]
    mails = spark.createDataFrame(rows, schema)
    threads = P.mail_threads(mails).collect()
    assert len(threads) == 1 and threads[0].n == 3 and "Yes & no" in threads[0].markdown
    assert [(r.field, r.old, r.new) for r in P.contact_changes(mails).collect()] == [("phone", "+49 111 222", "+49 999 222")]


def test_sql_surface(spark):
    from leafmill import sql

    assert "lm_clean_doi" in sql.register(spark)
    row = spark.sql("SELECT lm_clean_doi('10.1000/x.') d, lm_fold('Ä') f, lm_grade(9.0D) g, size(lm_tokens('aaa bbb')) n").first()
    assert (row.d, row.f, row.g, row.n) == ("10.1000/x", "ae", "Excellent", 2)
    assert spark.sql("SELECT * FROM lm_paragraphs('a\\n\\nb')").count() == 2
