"""Operators on records: names, survivors, matching, packing, mixing."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import matching as M
from leafmill.llm import mixing as X
from leafmill.llm import names as N
from leafmill.llm import packing as P
from leafmill.llm import survivors as V

# ---- names

PEOPLE = ["Samuel Bujuhotack", "S. Bujuhotak", "Sam Bujuhotack", "Bujuhotack, Samuel", "Dr. Samuel Bujuhotack, PhD", "Nathaniel Bujuhotack", "Nate Bujuhotack", "Vigdís Habroklejüt", "Vigdis Habroklejut", "Isabella N. Vobuchurand", "IN Vobuchurand", "Tariq Vobuchurand"]
FIRMS = ["Budorifil Therapeutics SA", "BUDORIFIL THERAPEUTICS", "Budorifil Tx", "Budorifil", "Bubroralind Oncology", "Bubroralind Biosciences", "Hahipeklot-Mitrotuzond Biologics", "Mitrotuzond/Hahipeklot Biologics", "HahipeklotMitrotuzondBiologics"]


def test_spellings_are_linked(spark):
    rows = [("author", p) for p in PEOPLE] + [("company", c) for c in FIRMS]
    df = spark.createDataFrame(rows * 2 + [("author", None), ("author", " "), ("company", "&"), ("author", "Dr."), ("author", "x" * 5000)], "kind string, name string")
    groups = {}
    for r in N.linked(df).collect():
        groups.setdefault((r.kind, r.cluster), set()).add(r.name)
    got = {frozenset(g) for g in groups.values() if len(g) > 1}
    assert got == {frozenset(PEOPLE[:5]), frozenset(PEOPLE[5:7]), frozenset(PEOPLE[7:9]), frozenset(PEOPLE[9:11]), frozenset(FIRMS[:4]), frozenset(FIRMS[6:])}
    pairs = N.linked_pairs(df).collect()
    assert len(pairs) == sum(len(g) * (len(g) - 1) // 2 for g in got) and all(r.name_a < r.name_b for r in pairs)
    assert N.linked(df.limit(0)).count() == 0


def test_similarity_join_equals_brute_force(spark):
    rng = random.Random(2)
    syllables = ["ba", "ke", "tru", "li", "mo", "sta", "ve", "nu"]
    names = sorted({"".join(rng.choice(syllables) for _ in range(4)).title() for _ in range(150)})
    df = spark.createDataFrame([("company", n) for n in names], "kind string, name string")
    got = {(r.a, r.b) for r in N.similar_pairs(df).collect()}
    sets = {n: N.features("company", n)[0] for n in names}
    count = {}
    for s in sets.values():
        for g in s:
            count[g] = count.get(g, 0) + 1
    sq = {g: round(np.log(1 + len(names) / c) ** 2 * 100) for g, c in count.items()}
    want = set()
    for a, b in itertools.combinations(names, 2):
        dot = sum(sq[g] for g in sets[a] & sets[b])
        if dot >= N.COSINE * np.sqrt(sum(sq[g] for g in sets[a]) * sum(sq[g] for g in sets[b])) and N.company_score(a, b) > 0:
            want.add((a, b))
    short = {(a, b) for a, b in itertools.combinations(names, 2) if N.stumps('company', a, {}) & N.stumps('company', b, {}) and N.company_score(a, b) > 0}
    assert got == want | short


def test_a_pair_is_judged_at_its_first_common_element(spark):
    e = lambda h, w: (h << 16) | w
    rows = [([e(1, 30), e(2, 50)], e(1, 30), 80.0), ([e(1, 30), e(2, 50)], e(2, 50), 10.0), ([e(1, 30)], e(1, 30), 30.5), ([], e(1, 30), 0.0)]
    df = spark.createDataFrame(rows, "common array<long>, el long, least double")
    assert [r.x for r in df.select(N._reaches(F.col("common"), F.col("el"), F.col("least")).alias("x")).collect()] == [True, False, False, True]


def test_average_linkage_equals_the_one_by_one_algorithm(spark):
    rng = random.Random(3)
    names = [f"n{i:02}" for i in range(24)]
    pairs = [("author", a, b, rng.random()) for a, b in itertools.combinations(names, 2) if rng.random() < 0.3]
    clusters = [{n} for n in names]
    score = {frozenset((a, b)): s for _, a, b, s in pairs}
    mean = lambda x, y: sum(score.get(frozenset((a, b)), 0) for a in x for b in y) / (len(x) * len(y))
    while True:
        best = max(((mean(x, y), i, j) for (i, x), (j, y) in itertools.combinations(enumerate(clusters), 2)), default=(0, 0, 0))
        if best[0] < N.LINK:
            break
        clusters[best[1]] |= clusters.pop(best[2])
    spellings = spark.createDataFrame([("author", n) for n in names], "kind string, name string")
    out = {}
    for r in N.average_linkage(spellings, spark.createDataFrame(pairs, "kind string, a string, b string, score double")).collect():
        out.setdefault(r.cluster, set()).add(r.name)
    assert {frozenset(c) for c in clusters} == {frozenset(c) for c in out.values()}


def test_short_forms_are_learned(spark):
    rng = random.Random(11)
    rows, given = [], ["William", *(f"{a}{b}" for a in ("Han", "Ori", "Pry", "Sor", "Tar", "Wen", "Chi", "Zol") for b in ("abel", "uko", "etti", "orma", "yzzi"))]
    for i in range(400):
        surname = f"Fam{i}ilo".replace("0", "a").replace("1", "e").replace("2", "i").replace("3", "o").replace("4", "u").replace("5", "ka").replace("6", "me").replace("7", "ri").replace("8", "to").replace("9", "zu")
        for g in rng.sample(given, 2):
            rows += [("author", f"{g} {surname}")] + ([("author", f"Bill {surname}")] if g == "William" else [])
    nick = N.nicknames(spark.createDataFrame(rows + [("author", None), ("author", "Solo"), ("company", "Bill Inc")], "kind string, name string"))
    assert nick == {"william": {"bill"}, "bill": {"william"}}
    assert N.person_score("Bill Nimuvastam", "William Nimuvastam", nick) >= N.LINK > N.person_score("Bill Nimuvastam", "William Nimuvastam")


def test_short_forms_are_learned_from_common_surnames(spark, monkeypatch):
    # Every surname has 16 given names, and no number of learned pairs is set.
    monkeypatch.setattr(N, "LEARNED", 1, raising=False)
    rng = random.Random(12)
    word = lambda i, tail: "".join("bdfgklmnpr"[int(c)] + "aeiou"[int(c) % 5] for c in str(i)) + tail
    given, rows = [word(100 + i, "zzi") for i in range(400)], []
    for i in range(500):
        two = rng.sample(["Xan", "Qoro"], 1)
        for g in [*rng.sample(given, 14), *{"Xan": ["Xander", "Sascha"], "Qoro": ["Robert", "Bob"]}[two[0]]] if i < 60 else rng.sample(given, 16):
            rows.append(("author", f"{g.title()} {word(1000 + i, 'vik').title()}"))
    df = spark.createDataFrame(rows, "kind string, name string")
    assert N.nicknames(df) == {"xander": {"sascha"}, "sascha": {"xander"}, "robert": {"bob"}, "bob": {"robert"}}
    # Pairs meet and are scored by the entries of their own words.
    few = spark.createDataFrame([("author", "Bob Nimuvastam"), ("author", "Robert Nimuvastam"), ("author", "Xander Nimuvastam")], "kind string, name string")
    scores = {(r.a, r.b): r.score for r in N.similar_pairs(few, nick=N.learned(df)).collect()}
    nick = N.nicknames(df)
    assert scores == {(a, b): N.person_score(a, b, nick) for a, b in [("Bob Nimuvastam", "Robert Nimuvastam")]} and min(scores.values()) >= N.LINK


def test_short_surnames_with_a_changed_letter_meet(spark):
    names = ["Anna Smith", "Anna Smyth", "Smith, A.", "Anna Jones", "Bert Smyth"]
    pairs = {(r.a, r.b) for r in N.similar_pairs(spark.createDataFrame([("author", n) for n in names], "kind string, name string")).collect()}
    want = {(a, b) for a, b in itertools.combinations(sorted(names), 2) if N.person_score(a, b) > 0}
    assert pairs == want and ("Anna Smith", "Anna Smyth") in want


@pytest.mark.parametrize("a, b, alike", [("Elisabeth L. Supabesand", "Elisabeth R. Supabesand", False), ("T. Brimiklafor", "Theodora Brimiklafor", True), ("Sam Nimuvastam", "Samuel Nimuvastam", True), ("B. Nimuvastam", "William Nimuvastam", False), ("Fabrazubul Hiroko", "Hiroko A. Fabrazubul", True)])
def test_person_score(a, b, alike):
    assert (N.person_score(a, b) >= N.LINK) is alike


# ---- survivors

META = "struct<title: string, authors: array<string>, journal: string, doi: string, year: string, volume: string, pages: string, crossref_verified: boolean>"
RUNS = f"result_id long, file_id long, metadata {META}, extraction_method string, quality_score struct<overall: double, grade: string>, processed_at timestamp"


def run(spark, rows):
    df = spark.createDataFrame([(i, f, m, how, (q, "x"), None) for i, f, m, how, q in rows], RUNS)
    return df.withColumn("processed_at", F.timestamp_seconds(F.col("result_id") * 1000))


def test_sound_values_survive(spark):
    good = ("A study of cells in mice", ["Ann Lee", "Bob Ray"], "Journal of Things", "10.1000/abc.1.2", "2020", "12", "3-9", True)
    cut = ("A study of ce", ["Ann Lee"], "Journal of", "10.1000/abc", "202", "�", "3-", False)
    none = ("Untitled", ["Unknown"], "N/A", "", "0000", "-", None, None)
    rows = [(1, 1, cut, "legacy", 4.0), (2, 1, none, "legacy", 3.0), (3, 1, good, "pdf_inspector", 9.0), (4, 1, cut, "tesseract", 4.0), (5, 2, none, "legacy", 2.0), (6, 2, cut, "legacy", 2.0), (7, None, good, "native", 9.0), (8, 3, None, None, None), (9, 3, None, None, None)]
    out = {(r.file_id, r.field): r.result_id for r in V.fuse(run(spark, rows)).collect()}
    assert all(out[1, f] == 3 for f in V.FIELDS)
    assert out[2, "title"] == 6 and out[2, "year"] in (5, 6)
    assert out[3, "title"] == 8 and len(out) == 21


def test_copied_votes_count_less(spark):
    old = lambda n: (f"Old title {n} of the work", ["A B"], "J", f"10.1000/{n}.1", "2019", "1", "1-2", False)
    new = lambda n: (f"New title {n} of the work", ["A B"], "J", f"10.1000/{n}.2", "2020", "2", "3-4", True)
    rows = []
    for n in range(30):
        rows += [(10 * n + k, n, old(n), "legacy", 4.0) for k in range(3)] + [(10 * n + 5, n, new(n), "pdf_inspector", 9.0)]
    out = V.fuse(run(spark, rows)).filter("field = 'title'").collect()
    assert all(r.value.startswith("New") for r in out) and len(out) == 30


def test_copiers_are_told_from_independent_sources(spark):
    # b repeats a's values, false ones too; c errs by itself.
    rng = random.Random(9)
    names = {"a": 1, "b": 2, "c": 3}
    rows = []
    for n in range(400):
        a = n if rng.random() < 0.7 else 10_000 + rng.randrange(10)
        c = n if rng.random() < 0.7 else 20_000 + rng.randrange(10)
        held = {}
        for s, v in (("a", a), ("b", a), ("c", c)):
            held.setdefault(v, []).append(names[s])
        rows += [(n, "title", sorted(voters), v == n) for v, voters in held.items()]
    judged = spark.createDataFrame(rows, "file_id long, field string, voters array<long>, right boolean")
    accuracy = spark.createDataFrame([(1, 0.7), (2, 0.7), (3, 0.7)], "s long, a double")
    got = {(r.lo, r.hi): r.copies for r in V.copying(judged, accuracy).collect()}
    assert got[1, 2] > 0.99 and got[1, 3] < 0.05 and got[2, 3] < 0.05
    patterns = spark.createDataFrame([([1, 2],), ([1, 3],), ([1],)], "voters array<long>")
    votes = {tuple(r.voters): r.votes for r in V._votes(patterns, accuracy, V.copying(judged, accuracy)).collect()}
    assert votes[1,] < votes[1, 2] < votes[1, 3] and votes[1, 2] < votes[1,] + 0.25 * (votes[1, 3] - votes[1,])


def test_fusion_of_nothing(spark):
    assert V.fuse(run(spark, [(1, 1, None, None, None)]).limit(0)).count() == 0


# ---- matching

RECORD = "id long, title string, names array<string>, year string, journal string, volume string, pages string, doi string"


def library(n=120):
    rng = random.Random(4)
    words = ["role", "binding", "inhibitor", "signature", "response", "melanoma", "leukaemia", "glioblastoma", "marrow", "plasma", "expression", "toxicity", "imaging", "cohort"]
    rows = []
    for i in range(n):
        title = f"{rng.choice(words)} of C{rng.randint(10, 99)}X{i} in {rng.choice(words)} and {rng.choice(words)} of patients"
        rows.append((1000 + i, title.title(), [f"Ann Sur{chr(97 + i % 26)}name{i}", f"Bob Other{i}"], str(2000 + i % 20), "Journal of Things", str(i), f"{i}-{i + 9}", f"10.1000/w.{i}"))
    return rows


def test_matches_and_sequels(spark):
    works = library()
    works.append((2000, works[5][1], works[5][2], works[5][3], works[5][4], works[5][5], works[5][6], works[5][7].upper()))
    works.append((2001, "Correction to: " + works[6][1], works[6][2], "2022", "Journal of Things", "999", "e1", "10.1000/c.6"))
    papers = [(i, w[1].upper(), [w[2][0].split()[1] + " A"], w[3], None, w[5], None, None if i % 3 else w[7]) for i, w in enumerate(works[:60])]
    papers += [(500, "Correction to: " + works[6][1], works[6][2], "2022", None, "999", None, None), (501, "Nothing like the others at all here", ["Zed Unknown"], "1999", None, None, None, None), (502, None, None, None, None, None, None, None), (503, "", [None, ""], "", "", "", "", "")]
    out = {}
    for r in M.match(spark.createDataFrame(papers, RECORD).withColumn("query", F.lit(1)), spark.createDataFrame(works, RECORD)).collect():
        out.setdefault(r.query, set()).add(r.record)
        assert 0.5 <= r.confidence <= 1
    assert out[5] == {1005, 2000} and out[500] == {2001} and not {501, 502, 503} & set(out)
    assert sum(out.get(i) == {1000 + i} for i in range(60) if i != 5) >= 57


def test_retrieval_equals_brute_force(spark):
    works = library(80)
    works += [(3000 + i, "An editorial", ["Ann Editor"], "2020", "Journal of Things", None, None, f"10.1000/e.{i}") for i in range(40)]
    works += [(4000 + i, w[1], w[2], w[3], w[4], w[5], w[6], w[7].upper()) for i, w in enumerate(works[:20])]
    papers = [(i, w[1], w[2], None, None, None, None, None) for i, w in enumerate(works[:30])]
    papers += [(100 + i, None, w[2], w[3], w[4], None, None, w[7]) for i, w in enumerate(works[30:50])] + [(200, "An editorial", None, "2020", None, None, None, None), (201, None, [], None, None, None, None, None)]
    q = spark.createDataFrame(papers, RECORD)
    r = spark.createDataFrame(works, RECORD).withColumn("thing", F.xxhash64(F.lower("doi")))
    got = {}
    for x in M.retrieve(q, r).collect():
        got.setdefault(x.query, []).append((round(x.score, 2), x.place))
    lists = {w[0]: M.terms(*w[1:]) for w in works}
    thing = {w[0]: w[7].lower() for w in works}
    count = [{}, {}, {}]
    sizes = [len({tuple(x[g]) for x in lists.values() if x[g]}) for g in range(3)]
    for g in range(3):
        for once in {tuple(x[g]) for x in lists.values()}:
            for t in once:
                count[g][t] = count[g].get(t, 0) + 1
    idf = [{t: 0.001 if g == 2 else round(np.log(1 + (sizes[g] - n + 0.5) / (n + 0.5)), 3) for t, n in count[g].items()} for g in range(3)]
    mean = np.mean([len(x[0]) + len(x[1]) for x in lists.values()])
    for p in papers:
        own, best = M.terms(*p[1:]), {}
        for k, x in lists.items():
            common = [set(own[g]) & set(x[g]) for g in range(3)]
            square = [sum(idf[g][t] ** 2 for t in own[g] if t in idf[g]) for g in range(3)]
            if any(square[g] and sum(idf[g][t] ** 2 for t in common[g]) >= M.FLOOR * (1 - 1e-9) * square[g] for g in range(3)):
                score = sum(idf[g][t] for g in (0, 1) for t in common[g]) * (M.K1 + 1) / (1 + M.K1 * (1 - M.B + M.B * (len(x[0]) + len(x[1])) / mean))
                best[thing[k]] = max(best.get(thing[k], 0.0), score)
        want = sorted(best.values(), reverse=True)[: M.K]
        assert np.allclose([s for s, _ in sorted(got.get(p[0], []), key=lambda x: x[1])], want, atol=0.02), p


def test_a_list_of_very_many_records_brings_them_up(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    name = lambda i: f"Ann Ed{letters[i // 676]}{letters[i // 26 % 26]}{letters[i % 26]}"
    works = library(30)
    works += [(3000 + i, "An editorial for spring", [name(i)] if i % 2 else None, None, None, None, None, f"10.1000/e.{i}") for i in range(1100)]
    # The author is one of them, all else is another work's: the author alone is too little of the list to bring up the editorial.
    w = works[3]
    papers = [(1, "An editorial for spring", [name(7)], *w[3:7], None), (2, "An editorial for spring", None, None, None, None, None, None), (3, "An editorial for spring", None, None, None, None, None, None)]
    r = spark.createDataFrame(works, RECORD).withColumn("thing", F.col("id"))
    got = {}
    for x in M.retrieve(spark.createDataFrame(papers, RECORD), r).collect():
        got.setdefault(x.query, {})[x.place] = x.record
    assert got[1][0] == 3007 and got[2] == got[3] == {0: 3000, 1: 3002}


def test_logistic_fit_starts_from_its_prior():
    prior = np.array([2.0, -1.0])
    assert np.allclose(M.fit_logistic(np.zeros((0, 1)), np.zeros(0), prior), prior, atol=1e-6)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 1))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(3 * x[:, 0] + 1)))).astype(float)
    assert np.allclose(M.fit_logistic(x, y, prior), [3, 1], atol=0.4)


def test_matching_of_nothing(spark):
    one = spark.createDataFrame([(1, "t", None, None, None, None, None, None)], RECORD)
    assert M.match(one.limit(0), one).count() == 0 and M.match(one, one.limit(0)).count() == 0


# ---- packing


def test_best_fit():
    assert sorted(map(sorted, P.best_fit([5, 5, 7, 3, 10, 0], 10))) in ([[0, 1], [2, 3], [4], [5]], [[0, 1], [2, 3], [4, 5]], [[0, 1, 5], [2, 3], [4]], [[0, 1], [2, 3, 5], [4]])
    assert P.best_fit([], 10) == []


def test_packing_in_groups_comes_near_one_group(spark):
    rng = random.Random(6)
    sizes = [(i, rng.randint(1, 700)) for i in range(3000)] + [(5000, 2500), (5001, 0), (5002, 512)]
    df = spark.createDataFrame(sizes, "doc_id long, tokens int").withColumn("item", F.lit("x"))
    out = P.pack(P.cut_items(df, "doc_id", [("small", 512, 0), ("over", 512, 100)]), group=200).toPandas()
    for name, rows in out.groupby("spec_name"):
        assert rows.groupby("container_id")["size"].sum().max() <= 512
        assert not rows.duplicated(["item", "piece_no"]).any() and rows["item"].nunique() == 3003
        assert rows.loc[rows["item"] == 5002, "size"].tolist() == [512]
        assert rows["container_id"].nunique() <= 1.03 * len(P.best_fit(rows["size"].tolist(), 512))
    small = out[out.spec_name == "small"]
    assert small["size"].sum() == sum(s for _, s in sizes)
    long = out[(out.spec_name == "over") & (out["item"] == 5000)].sort_values("piece_no")
    assert long["start_at"].tolist() == [0, 412, 824, 1236, 1648, 2060] and long["size"].iloc[-1] == 440
    assert P.pack(P.cut_items(df.limit(0), "doc_id", [("small", 512, 0)])).count() == 0
    assert P.fill(P.pack(P.cut_items(df, "doc_id", [("small", 512, 0)]))).first().fill > 0.97


def test_packing_joins_what_is_left_of_groups(spark):
    # Bins over half full that nothing fits into, and few small items that fit into the emptiest only.
    rows = [(i, 80) for i in range(600)] + [(1000 + i, 60) for i in range(20)] + [(2000 + i, 40) for i in range(20)] + [(3000 + i, 0) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, tokens int")
    out = P.pack(P.cut_items(df, "doc_id", [("s", 100, 0)]), group=30).toPandas()
    assert len(out) == len(rows) and out.groupby("container_id")["size"].sum().max() <= 100
    full = out[out["size"] > 0]
    assert full["container_id"].nunique() <= 620 + 5


# ---- mixing


def test_pivotal_keeps_the_total_and_the_expectation():
    rng = np.random.default_rng(0)
    w = [3, 5, 8, 13, 21, 34, 2, 9]
    p = [0.4] * 8
    mean = np.zeros(8)
    for _ in range(4000):
        out = X.pivotal(p, w, rng)
        assert sum(0 < x < 1 for x in out) <= 1
        assert abs(np.dot(out, w) - np.dot(p, w)) < 1e-6
        mean += out
    assert np.allclose(mean / 4000, 0.4, atol=0.04)


def test_mix_reaches_the_shares(spark):
    rng = random.Random(7)
    docs = [(i, s, rng.randint(50, 400)) for i, s in enumerate(["a"] * 3000 + ["b"] * 600 + ["c"] * 60 + ["x"] * 50 + [None] * 5)] + [(9999, "a", 0)]
    sized = spark.createDataFrame(docs, "doc_id long, source string, tokens int")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.1, 4), ("gone", 0.1, 3), (None, 0.2, 1)], "source string, target_share double, max_repeats int")
    mixed = X.mix(sized, targets, "doc_id", group=100)
    rows = mixed.toPandas()
    assert set(rows.source) == {"a", "b", "c"} and not rows.doc_id.duplicated().any()
    assert rows.groupby("source").copies.max().to_dict() == {"a": 1, "b": 2, "c": 4}
    got = {r.source: r.actual_share for r in X.shares(mixed, targets).collect()}
    assert got["gone"] == 0 and all(abs(got[s] - t / 0.9) < 0.01 for s, t in (("a", 0.5), ("b", 0.3), ("c", 0.1)))
    assert X.mix(sized.limit(0), targets, "doc_id").count() == 0 and X.mix(sized, targets.limit(0), "doc_id").count() == 0


def test_ngrams_of_a_reading_are_stored_once(spark, monkeypatch):
    made = {}
    keep = N.materialize
    monkeypatch.setattr(N, "materialize", lambda df, name="stage": made.setdefault(name, keep(df, name)))
    ends = ["Halvorsen", "Halvorson", "Halversen", "Kowalczyk", "Kowalcyk", "Ng", "Brandt", "Brand", "Lindqvist", "Lindquist"]
    people = [f"{g} {s}" for g in ("Anna", "A.", "Boris", "Clara Maria") for s in ends] + ["Halvorsen, Anna", "Ng"]
    got = {(r.a, r.b) for r in N.similar_pairs(spark.createDataFrame([("author", n) for n in people], "kind string, name string")).collect()}
    held = [df for df in made.values() if "els" in df.columns]
    assert held and sum(df.count() for df in held) == made["readings"].count()
    assert ("Anna Halversen", "Anna Halvorsen") in got
