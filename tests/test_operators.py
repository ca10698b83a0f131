"""Operators against brute force, with nulls, ties, repeated rows and empty tables."""

import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from leafmill.operators import generators as T
from leafmill.operators import matching as M
from leafmill.operators import merging as G
from leafmill.operators import posters as B
from leafmill.operators import render as K
from leafmill.operators import sequences as S


def test_trees_leave_out_orphans_and_cycles(spark):
    rows = [(1, None), (2, 1), (3, 2), (4, 9), (5, 6), (6, 5)]
    out = {(r.k, r.root, r.depth) for r in M.trees(spark.createDataFrame(rows, "k int, p int"), "k", "p").collect()}
    assert out == {(1, 1, 0), (2, 1, 1), (3, 1, 2)}


def test_trees_deep_chain_and_empty(spark):
    chain = spark.createDataFrame([(i, i - 1 if i else None) for i in range(300)], "k int, p int")
    assert {(r.root, r.depth) for r in M.trees(chain, "k", "p").filter("k = 299").collect()} == {(0, 299)}
    assert M.trees(spark.createDataFrame([], "k int, p int"), "k", "p").count() == 0


def test_similar_titles_equals_brute_force(spark):
    a = [(i, t) for i, t in enumerate(["alpha beta gamma delta", "alpha beta gamma", "one two three four five", "", None, "alpha beta gamma delta"])]
    b = [(i, t) for i, t in enumerate(["alpha beta gamma delta epsilon", "three four five one", "beta"])]
    got = {(r.x, r.y) for r in M.similar_titles(spark.createDataFrame(a, "x int, t string"), spark.createDataFrame(b, "y int, t string"), "x", "t", "y", "t", 0.75).collect()}
    words = lambda t: {w for w in (t or "").split() if len(w) > 2}
    want = {(i, j) for (i, s), (j, t) in itertools.product(a, b) if words(s) and words(t) and len(words(s) & words(t)) >= 0.75 * len(words(s) | words(t))}
    assert got == want


def test_unique_containment_needs_exactly_one(spark):
    a = spark.createDataFrame([(1, "A study of cells"), (2, "study of"), (3, None), (4, "Something else entirely")], "a int, t string")
    b = spark.createDataFrame([(10, "a study of cells in mice"), (11, "cells and more"), (12, "A STUDY OF CELLS"), (13, "something else entirely, revised")], "b int, t string")
    assert {(r.a, r.b) for r in M.unique_containment(a, b, "a", "t", "b", "t").collect()} == {(4, 13)}


def test_as_of_and_band(spark):
    left = spark.createDataFrame([("u", 5, 1), ("u", 1, 2), ("v", 9, 3)], "k string, t int, i int")
    right = spark.createDataFrame([("u", 2, "x"), ("u", 5, "y"), ("u", 5, "z")], "k string, t int, v string")
    assert {(r.i, r.v) for r in M.as_of(left, right, ["k"], "t", "v").collect()} == {(1, "z"), (2, None), (3, None)}
    bands = spark.createDataFrame([("k", "b", 0, 4), ("k", "c", 4, 40)], "k string, n string, lo int, hi int")
    points = spark.createDataFrame([("k", 4), ("k", 41)], "k string, x int")
    assert {(r.x, r.n) for r in M.within_band(points, bands, ["k"], "x", "lo", "hi", 3).collect()} == {(4, "b"), (4, "c")}


def test_patch_keeps_rows_without_update(spark):
    base = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    up = spark.createDataFrame([(1, None), (2, "b")], "k int, v string")
    assert sorted(tuple(r) for r in M.patch(base, up, ["k"], ["v"]).collect()) == [(1, "a"), (2, "b")]


def test_canonical_company(spark):
    rows = spark.createDataFrame([(" MSD ",), ("Acme",), (None,)], "c string").select(M.canonical_company(F.col("c")).alias("c"))
    assert [r.c for r in rows.collect()] == ["Merck & Co.", "Acme", None]


def test_axis_runs_and_fragments(spark):
    rows = spark.createDataFrame([(1, i, x) for i, x in enumerate(["1", "2.5", " 3 ", "word " * 10, "a", "b", "|c"])], "d int, i int, line string")
    axis = sorted((r.i, r.line) for r in S.collapse_axis_numbers(rows, "d", "i", "line").collect())
    assert axis[0] == (0, "[Chart axis: 1, 2.5, 3]") and len(axis) == 5
    assert (4, "a b") in {(r.i, r.line) for r in S.merge_fragments(rows, "d", "i", "line").collect()}


def test_change_log_doesnt_depend_on_arrival(spark):
    rows = [("p", datetime.date(2024, 1, i), i, v) for i, v in ((1, "a"), (2, "a"), (3, "b"), (4, ""), (5, None), (6, "a"))]
    want = [("a", "b"), ("b", "a")]
    for order in (rows, rows[::-1]):
        log = S.change_log(spark.createDataFrame(order, "k string, at date, n int, v string"), ["k"], "at", "n", "v")
        assert [(r.old, r.new) for r in log.orderBy("at").collect()] == want


def test_sections_in_text_order(spark):
    text = "Title\nAbstract\n" + "a" * 60 + "\n2. Methods\n" + "m" * 60 + "\nReferences\nshort"
    got = {(r.name, len(r.content)) for r in S.sections(spark.createDataFrame([(1, text), (2, None), (3, "")], "d int, t string"), "d", "t").collect()}
    assert got == {("abstract", 60), ("methods", 60)}


def test_chunks_carry_paragraphs_over(spark):
    text = "\n\n".join([c * 40 for c in "abcdef"])
    rows = S.chunks(spark.createDataFrame([(1, text), (2, None), (3, " ")], "d int, t string"), "d", "t", 100, 50).orderBy("chunk_no").collect()
    assert [r.chunk.split("\n\n")[0][0] for r in rows] == ["a", "b", "c", "d", "e"]
    assert all(len(p) <= 90 for p in (r.chunk for r in rows))


def test_claims(spark):
    text = "1. A compound of formula I.\n2. The method of claim 1, wherein x.\n2. The method according to any one of claims 1 to 2.\n"
    got = sorted((r.number, r.depends_on, r.category) for r in T.claims(spark.createDataFrame([(1, text), (2, None), (3, "none")], "d int, t string"), "d", "t").collect())
    assert got == [(1, None, "composition"), (2, 1, "method")]


def test_metrics_once_per_value(spark):
    got = [(r.kind, r.value) for r in T.metrics(spark.createDataFrame([(1, "5% and 5%, n = 12, p < 0.05, HR 0.7, 10 mg"), (2, None)], "d int, t string"), "d", "t").orderBy("ord").collect()]
    assert got == [("percentage", "5%"), ("sample_size", "n = 12"), ("p_value", "p < 0.05"), ("ratio", "HR 0.7"), ("dosage", "10 mg")]


def test_deals_and_lists(spark):
    rows = spark.createDataFrame([("g", 1, ["a", "b"], "Alpha buys Beta for 5"), ("g", 2, ["b", "a"], "alpha buys beta for 5"), ("g", 3, ["a"], "x"), ("g", 4, None, None), ("g", 5, None, None)], "g string, o int, p array<string>, d string")
    assert sorted(r.o for r in G.deduplicate_deals(rows, "g", "o", "p", "d").collect()) == [1, 3, 4, 5]
    lists = spark.createDataFrame([(1, 2, ["c", "a"]), (1, 1, ["a", "b"]), (2, 1, None)], "k int, o int, v array<string>")
    assert {r.k: r.v for r in G.union_in_order(lists, ["k"], "o", "v").collect()} == {1: ["a", "b", "c"]}


def test_merge_assets(spark):
    schema = "doc_id int, ord int, company string, name string, target string, payload string, stage string, indications array<string>, clinical_data array<string>, updates array<struct<text: string, indications: array<string>>>"
    rows = [(1, 1, "msd", "X-100", None, "", "I", ["a"], None, [("new", ["a"]), ("", ["z"])]), (1, 2, "Merck & Co.", "x-100", "T", "p", "II", ["b", "a"], ["d"], [("new", ["b"])]), (1, 3, "A", None, "T", "p", "II", [], [], [])]
    out = G.merge_assets(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.company, r.name, r.target, r.payload, r.stage, r.indications, r.clinical_data) == ("Merck & Co.", "X-100", "T", "p", "I", ["a", "b"], ["d"])
    assert [(u.text, u.indications) for u in r.updates] == [("new", ["a", "b"])]


def test_greedy_and_code_names(spark):
    rows = spark.createDataFrame([(1, "c", i, n) for i, n in enumerate(["DS-8201", "DS-8201a", "trastuzumab (DS-8201)", "other", None])], "doc_id int, company string, ord int, name string")
    assert [r.asset_no for r in G.greedy_assets(rows).orderBy("ord").collect()] == [0, 0, 0, 1, 2]
    full = {r.name: r.canonical for r in G.resolve_asset_codes(rows.filter("name is not null"), ["doc_id"], "name").collect()}
    assert full["DS-8201"] == "trastuzumab (ds-8201)" and full["other"] == "other"


def test_posters_and_talks(spark):
    posters = spark.createDataFrame([("160.pdf", "x"), ("a.pdf", "A long title about cells"), ("b.pdf", "Anoher long tittle on proteins"), ("c.pdf", "zzz")], "path string, title string")
    programme = spark.createDataFrame([("160", "first"), ("161", "A long title about cells and mice"), ("162", "Another long title on proteins"), (None, "q")], "n string, t string")
    assert {(r.path, r.number, r.how) for r in B.to_programme(posters, programme, "path", "title", "n", "t").collect()} == {("160.pdf", "160", "number"), ("a.pdf", "161", "title"), ("b.pdf", "162", "likeness")}
    talks = spark.createDataFrame([(1, "Bunne", "Toward virtual cells"), (2, "", "x")], "i int, s string, t string")
    abstracts = spark.createDataFrame([(7, "C. Bunne, A. B", "Virtual <i>cells</i> modelled"), (8, "Bunne C", "Other")], "j int, a string, t string")
    assert [(r.talk, r.abstract, r.score) for r in B.talks_to_abstracts(talks, abstracts, "i", "s", "t", "j", "a", "t").collect()] == [(1, 7, 2)]


def test_table_has_equal_pipes(spark):
    df = spark.createDataFrame([(["a", "b"], [["1"], ["2", "x | y", "cut"]])], "h array<string>, r array<array<string>>")
    lines = df.select(K.table(F.col("h"), F.col("r")).alias("t")).first().t.split("\n")
    assert len(lines) == 4 and {x.replace("\\|", "").count("|") for x in lines} == {3}


def test_write_files(spark, tmp_path):
    df = spark.createDataFrame([("a.md", "ä"), ("b.md", None)], "n string, t string")
    assert {(r.name, r.bytes) for r in K.write_files(df, "n", "t", str(tmp_path / "out")).collect()} == {("a.md", 2), ("b.md", 0)}
    assert (tmp_path / "out/a.md").read_text() == "ä"


@pytest.mark.parametrize("k", [3, 15])
def test_stride_sample(spark, k):
    rows = spark.createDataFrame([("g", i) for i in range(10)], "g string, i int")
    got = sorted(r.i for r in S.stride_sample(rows, ["g"], F.col("i"), k).collect())
    assert got == ([0, 3, 6] if k == 3 else list(range(10)))


def test_two_columns_are_read_one_after_the_other(spark):
    from leafmill.operators import layout as Y

    words = [("p", x, x + 90.0, 10.0 * r, f"{c}{r}{i}", 600.0) for r in range(5) for c, xs in (("l", (20.0, 120.0)), ("r", (330.0, 430.0))) for i, x in enumerate(xs)]
    words += [("q", x, x + 114.0, 0.0, f"w{i}", 600.0) for i, x in enumerate((0.0, 120.0, 240.0, 360.0))]
    df = spark.createDataFrame(words, "page string, x0 double, x1 double, top double, word string, page_width double")
    assert {r.page for r in Y.column_gap(df, ["page"]).collect()} == {"p"}
    text = {r.page: r.text for r in Y.page_text(df, ["page"]).collect()}
    assert text["p"].split("\n")[0] == "l00 l01" and text["p"].split("\n")[5] == "r00 r01" and text["q"] == "w0 w1 w2 w3"


def test_figures_and_attachments(spark):
    from leafmill.operators import layout as Y

    docs = spark.createDataFrame([("d", "One.\n\nSee Fig. 2 here.\n\nEnd."), ("e", "none")], "d string, t string")
    figures = spark.createDataFrame([("d", 2, "F2"), ("d", 9, "F9")], "d string, number int, block string")
    out = {r.d: r.t for r in Y.with_figures(docs, figures, "d", "t").collect()}
    assert out == {"d": "One.\n\nSee Fig. 2 here.\n\nF2\n\nEnd.\n\nF9", "e": "none"}
    rows = [("t", 1, "a.pdf", 100), ("t", 2, "a.pdf", 100), ("t", 3, "A.pdf", 200), ("t", 4, "image001.png", 90_000), ("t", 5, "big.pdf", 99_000_000), ("t", 6, "x.png", 20_000)]
    kept = Y.attachments(spark.createDataFrame(rows, "t string, i int, n string, s long"), "t", "n", "s", "i")
    assert {(r.i, r.stored_as) for r in kept.collect()} == {(1, "a.pdf"), (3, "A_1.pdf"), (6, "x.png")}
    assert [r.r for r in spark.createDataFrame([("a.PDF",), ("b.zip",), (None,)], "n string").select(Y.route(F.col("n")).alias("r")).collect()] == ["pdf", None, None]


def test_figure_pages_and_mirrored_lines(spark):
    from leafmill.operators import layout as Y

    pages = spark.createDataFrame([("d", 0, "Figure 1. x", "TEXT_PAGE", False), ("d", 1, "", "FIGURE_PAGE", True), ("d", 2, None, "FIGURE_PAGE", False), ("d", 3, "", "FIGURE_PAGE", False)], "d string, n int, t string, k string, tab boolean")
    assert sorted(r.n for r in Y.figure_pages(pages, "d", "n", "t", F.col("k"), F.col("tab"), 2).collect()) == [0, 2]
    lines = spark.createDataFrame([(["esnopser", "x1"],), (["response", "x1"],)], "l array<string>")
    assert [r.m for r in lines.select(Y.reversed_words(F.col("l"), ["response"]).alias("m")).collect()] == [True, False]


def test_documents_with_nulls_and_ties(spark):
    from leafmill.operators import documents as D

    pages = spark.createDataFrame([(1, "x" * 10), (1, None), (None, "")], "file_id long, text string").withColumn("other", F.lit(1))
    assert D.image_only(pages.limit(0), "file_id", F.length("text") > 5).count() == 0
    assert {r.file_id: r.image_only for r in D.image_only(pages, "file_id", F.length("text") > 50, 1).collect()} == {1: True, None: False}
    row = spark.createDataFrame([(None, "", "1. A thing\n2. The rest\n3. An end\n")], "a string, b string, c string").select(
        D.has_claims(F.col("a")).alias("a"), D.has_claims(F.col("c")).alias("c"), D.clean_signature(F.col("a")).alias("s"), D.marked(F.col("b"), "---X---").alias("m"), D.output_issues(F.col("a"), F.lit(None).cast("array<string>"), F.col("a"), F.col("a"), F.col("b")).alias("i"),
        D.deck_name(F.lit("Review 07Mar2021 final")).alias("d"), D.names_only(F.lit("Dr. Ann LEE"), F.lit("Lee, Ann B.")).alias("n"), D.text_cascade(F.col("a"), F.col("c"), F.lit(None).cast("boolean")).alias("t")).first()
    assert (row.a, row.c, row.s, row.m, row.n) == (False, True, None, None, True) and row.t.startswith("1. A")
    assert list(row.i) == [D.SHORT_TEXT, D.NO_RESULTS, D.NO_METHODS, D.NO_FIGURES] and (row.d.date, row.d.title) == ("2021-03-07", "Review")
    ties = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, 1.0), (2, 99.0), (3, None)], "g long, y double")
    assert [tuple(r) for r in D.first_cluster(ties, "g", "y", 30).collect()] == [(1, 5.0)]


def test_containment_inside_words_and_keyword_join(spark):
    from leafmill.operators import matching as M

    a = spark.createDataFrame([(1, "gene therap for all"), (2, None), (3, "short"), (4, "日本語の題名についての研究です")], "i long, t string")
    b = spark.createDataFrame([(7, "On gene therap for all patients"), (8, ""), (9, "新しい日本語の題名についての研究です。")], "j long, u string")
    assert sorted(tuple(r) for r in M.unique_containment(a, b, "i", "t", "j", "u").collect()) == [(1, 7), (4, 9)]
    left = spark.createDataFrame([(1, "common alpha alpha"), (2, "common common"), (3, None), (4, "nothing")], "i long, t string")
    right = spark.createDataFrame([(5, "common alpha"), (6, "alpha common"), (7, "common beta")], "j long, u string")
    assert sorted(tuple(r) for r in M.best_by_words(left, right, "i", "t", "j", "u").collect()) == [(1, 5, 3), (2, 5, 2)]
    assert M.best_by_words(left, right.limit(0), "i", "t", "j", "u").count() == 0


def test_jaccard_join_sizes_repeats_and_null_ids(spark):
    from leafmill.operators import matching as M

    draw = random.Random(3)
    words = [f"w{i:02d}" for i in range(14)] + [f"v{i:03d}" for i in range(60)]
    make = lambda: [" ".join(draw.sample(words[:14] if draw.random() < 0.7 else words, draw.choice([1, 2, 3, 5, 8, 13, 30, 40, 41, 55]) % 14 + 1)) for _ in range(60)]
    base = [draw.sample(words, n) for n in (29, 30, 31, 39, 40, 41, 54, 60)]
    long = lambda: [" ".join(t[: len(t) - draw.randrange(len(t) // 3)]) for t in base for _ in range(4)]
    left, right = [make() + long() + ["equal name here"] * 3 for _ in "ab"]
    a, b = [[(i or None, t) for i, t in enumerate(x)] for x in (left, right)]
    for least in (0.75, 0.5):
        got = sorted((r.x or 0, r.y or 0, r.common, r.total) for r in M.similar_titles(spark.createDataFrame(a, "x int, t string"), spark.createDataFrame(b, "y int, t string"), "x", "t", "y", "t", least).collect())
        sets = [[set(t.split()) for t in x] for x in (left, right)]
        want = sorted((i, j, len(s & t), len(s | t)) for i, s in enumerate(sets[0]) for j, t in enumerate(sets[1]) if len(s & t) >= least * len(s | t))
        assert got == want and len(got) > 9


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_generated_side_of_the_jaccard_join_is_broadcast(spark, data):
    from leafmill.plans import catalogue

    assert "BroadcastHashJoin" not in _plan(catalogue.QUERIES["j_jaccard_inverted"](spark, data))


def test_containment_join_broadcasts_nothing_and_counts_repeats(spark, data):
    from leafmill.operators import matching as M
    from leafmill.plans import catalogue

    assert "BroadcastHashJoin" not in _plan(catalogue.QUERIES["j_title_contains_unique"](spark, data))
    draw = random.Random(5)
    text = "".join(draw.choice("ab") for _ in range(400))
    cut = lambda: text[(i := draw.randrange(340)) : i + draw.randrange(9, 60)]
    a, b = [[(i, cut().upper()) for i in range(60)] + [(i + 100, text[30 + i : 42 + i]) for i in (0, 0, 7)] for _ in "ab"]
    b += [(200 + i, t) for i, t in b[-3:]] + [(300, text[100:230])]
    got = sorted(tuple(r) for r in M.unique_containment(spark.createDataFrame(a, "x int, t string"), spark.createDataFrame(b, "y int, t string"), "x", "t", "y", "t").collect())
    met = [(i, j) for i, s in a for j, t in b if len(s) > 9 and len(t) > 9 and (s.lower() in t.lower() or t.lower() in s.lower())]
    assert got == sorted(p for p in met if sum(i == p[0] for i, _ in met) == 1) and got
