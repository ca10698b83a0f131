"""Cases of single functions: clean inputs, dirty ones, null and empty."""

import datetime

import pytest
from pyspark.sql import functions as F

from leafmill.functions import dates as D
from leafmill.functions import lines as L
from leafmill.functions import names as N
from leafmill.functions import predicates as P
from leafmill.functions import scoring as Q
from leafmill.functions import text as X


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("10.1038/s41568-019-0133-9", "10.1038/s41568-019-0133-9"),
        ("10.1038/s41568-019-0133-9.", "10.1038/s41568-019-0133-9"),
        ("(10.1038/abc)", "10.1038/abc"),
        ("10.1000/abc](https://doi.org/10.1000/abc)", "10.1000/abc"),
        ("10.1158/abc�**", "10.1158/abc"),
        ("10.1158/|", None),
        ("", None),
        (None, None),
        ("no doi here", None),
    ],
)
def test_clean_doi(spark, given, wanted):
    assert one(spark, X.clean_doi, given) == wanted


@pytest.mark.parametrize(
    "given, wanted",
    [("# The Great Paper", "The Great Paper"), ("**Nature Medicine**", "Nature Medicine"), ("A�B  c", "A B c"), ("", ""), (None, "")],
)
def test_sanitize_title(spark, given, wanted):
    assert one(spark, X.sanitize_title, given) == wanted


def test_tokens(spark):
    assert set(one(spark, X.tokens, "The Great Paper of RNA, SARS-CoV-2 spike")) == {"the", "great", "paper", "rna", "sars", "cov", "spike"}
    assert one(spark, X.tokens, None) == []


@pytest.mark.parametrize("given, wanted", [("Onvanser\ntib", "Onvanser tib"), ("a\t\t b", "a b"), (None, "")])
def test_clean_cell(spark, given, wanted):
    assert one(spark, X.clean_cell, given) == wanted


def test_escape_cell(spark):
    assert one(spark, X.escape_cell, "FOLFIRI | bevacizumab") == "FOLFIRI \\| bevacizumab"


def test_spacing_and_words(spark):
    assert one(spark, X.repair_spacing, "use ofthe drug.The next") == "use of the drug. The next"
    assert one(spark, X.repair_misread_words, "poiymer of ceii") == "polymer of cell"
    assert one(spark, X.clean_patent_text, "WO 2020/123456 PCT/EP2020/012345\n5 The cell\n\n\n\nA\n--\nend") == "The cell\n\nend"


def test_files_and_dates(spark):
    assert one(spark, X.safe_filename, None) == "unnamed"
    assert one(spark, X.safe_filename, "CON.txt") == "_CON.txt"
    assert len(one(spark, X.safe_filename, "x" * 300 + ".pdf")) == 200
    assert one(spark, D.file_date, "Series-June-2025") == datetime.date(2025, 6, 1)
    assert one(spark, D.file_date, "Series Q3-2024") == datetime.date(2024, 7, 1)
    assert one(spark, D.file_date, "20240131x") == datetime.date(2024, 1, 31)
    assert one(spark, D.file_date, "nothing") is None
    assert one(spark, D.long_date, "31 February 2024") is None
    assert one(spark, lambda c: F.struct(*X.paper_file(c)), "Miller et al. - 2024 - On cells.pdf") == ("Miller", "2024", "On cells")


def test_scores(spark):
    good = "The committee met on Monday to discuss the results of the study in some detail and agreed on the next steps to take."
    assert one(spark, Q.page_quality, good) > 0.8
    assert one(spark, Q.page_quality, None) == 0
    assert one(spark, Q.page_quality, "short") == 0
    assert [one(spark, Q.grade, s, "double") for s in (8.0, 5.5, 4.0, 3.99)] == ["Excellent", "Good", "Fair", "Poor"]


def test_predicates(spark):
    assert one(spark, P.smiles_valid, "CC(=O)N") is True
    assert one(spark, P.smiles_valid, "CC(=O") is False
    assert one(spark, P.smiles_valid, None) is False
    assert one(spark, P.ocr_page_class, None) == "figure"
    assert one(spark, P.content_type, "") == "template"
    assert one(spark, P.language, "Das ist der Weg und die Karte") == "de"
    assert one(spark, P.plausible_table, [["a", "b"], [None, ""]], "array<array<string>>") is True
    assert one(spark, P.plausible_table, [], "array<array<string>>") is False
    assert one(spark, lambda c: P.sensitivity(c, F.lit("non-confidential")), "deck.pptx") == "confidential"


def test_names(spark):
    assert one(spark, N.poster_number, "LB197.pdf") == "LB197"
    assert one(spark, N.poster_number, "A title - 348.pdf") == "348"
    assert one(spark, lambda c: N.talk_parts(c)["surname"], "04_ED03_C.Bunne_Toward x.pdf") == "Bunne"
    assert one(spark, lambda c: N.output_name("paper", "default", c, first_author=F.lit("Li"), year=F.lit(None)), "The Great Paper") == "Li_unknown_great_paper.md"


def test_quoted_mail_and_signature():
    mail = "Hello\n\nFrom: a@b.example\nSent: Monday\nTo: c\nSubject: x\n\nold"
    assert L.cut_quoted(mail) == "Hello"
    assert L.cut_quoted("From: here on, all is new") == "From: here on, all is new"
    body, signature = L.split_signature("Dear all,\nfine.\nBest regards,\nDr. Ann Lee\nSenior Scientist\nPhone: +49 123 4567\nann@x.example")
    assert body == "Dear all,\nfine."
    assert L.contact_fields(signature)["phone"] == "+49 123 4567"
    assert L.contact_fields(signature)["title"] == "Senior Scientist"
    assert L.contact_fields("") == {}


def test_invite_is_skipped_to_the_rule():
    assert L.strip_invite("a\nMicrosoft Teams meeting\njoin\n__________\nb") == "a\nb"


@pytest.mark.parametrize(
    "given, wanted",
    [('{"a": 1}', '{"a": 1}'), ('x ```json\n[1, 2]\n``` y', "[1, 2]"), ('so: {"a": "}"} done', '{"a": "}"}'), ('{"f": [{"n": 1}, {"n": 2}, {"n":', '{"f": [{"n": 1}, {"n": 2}]}'), ("none", None)],
)
def test_model_json(given, wanted):
    assert L.model_json(given) == wanted


def test_fold_and_slug():
    assert L.fold("Müller Ångstrom") == "mueller angstrom"
    assert L.person_slug("Dr. Zoë Weiß") == "dr_zoe_weiss"


def test_column_keeps_null(spark):
    assert one(spark, L.column(L.fold, "string"), None) is None
